import numpy as np
import pyarrow as pa
import pytest

from tests.llm import brute
from tramline.llm import near_dedup as nd
from tramline.llm.common import forest, table
from tramline.llm.queries import QUERIES


def test_fingerprints_equal_plain_ones():
    texts = [r[1] for r in brute.awkward()] + ["ÀÉÎ àéî straße", "a b a b a b c d e f g", "!!!"]
    f, n = nd.fingerprints(pa.array(texts))
    for t, (a, b), k in zip(texts, f.tolist(), n.tolist()):
        want = brute.fingerprint(t)
        assert (want is None) == (k == 0)
        assert want is None or want == a << 64 | b


def flipped(rng, f, n):
    g = f.copy()
    for at in rng.choice(128, n, replace=False):
        g[at // 64] ^= np.uint64(1) << np.uint64(at % 64)
    return g


def clustered(rng, n, apart):
    """n fingerprints, half of them `apart` bits or fewer from one of the other half."""
    base = rng.integers(0, 2**63, (n // 2, 2)).astype(np.uint64)
    other = np.stack([flipped(rng, f, k) for f, k in zip(base, rng.integers(1, apart + 1, len(base)))])
    return np.unique(np.concatenate([base, other]), axis=0)


def all_pairs(f, distance):
    return {(i, int(j)) for i in range(len(f)) for j in i + 1 + np.flatnonzero(np.bitwise_count(f[i + 1 :] ^ f[i]).sum(axis=1) <= distance)}


def test_a_near_pair_keeps_to_one_part():
    for distance in range(60):
        most = nd.most_of(distance)
        assert sum(m + 1 for m in most) == distance + 1 and max(most) - min(most) <= 1
    assert nd.most_of(24) == [3, 2, 2, 2, 2, 2, 2, 2]


@pytest.mark.parametrize("n, depths", [(300, (2, 5, 9)), (4000, (7, 10, 12, 14)), (12_000, (8, 13))])
def test_index_finds_all_pairs_at_any_depth(n, depths):
    f = clustered(np.random.default_rng(n), n, 40)
    want = all_pairs(f, 24)
    for depth in depths:
        got = set()
        for q in range(nd.PARTS):
            order = np.argsort(nd.part(f, q), kind="stable")
            for i, j in nd.near(f[order], f[order], q, depth, nd.most_of(24)[q], 24, True):
                got |= {(min(a, b), max(a, b)) for a, b in zip(order[i].tolist(), order[j].tolist())}
        assert got == want


@pytest.mark.parametrize("n, chunk", [(600, 60), (3000, 400)])
def test_edges_lose_no_pair(spark, n, chunk):
    f = clustered(np.random.default_rng(n + 1), n, 30)
    f[: n // 10, 0] &= np.uint64(0x00000000FFFFFFFF)  # hot first parts
    f = np.unique(f, axis=0)
    prints = spark.createDataFrame([(i, *x) for i, x in enumerate(f.view(np.int64).tolist())], "idx long, f0 long, f1 long")
    node, root = forest(*np.array(sorted(all_pairs(f, 24))).T)
    got = nd.edges_of(prints, len(f), chunk=chunk).toPandas()
    assert dict(zip(*(x.tolist() for x in forest(got.a.to_numpy(), got.b.to_numpy())))) == dict(zip(node.tolist(), root.tolist()))


def test_groups_equal_brute_force(spark, awkward, rows, tiny, clash):
    docs = [(r[0], r[1]) for r in awkward.select("doc_id", "text").collect()]
    got = [(-(2**63) if r[0] is None else r[0], r[1]) for r in nd.near_dedup(awkward).collect()]
    assert sorted(got) == brute.near_groups(docs)
    assert rows(nd.near_dedup(clash(awkward))) == rows(nd.near_dedup(awkward))


def test_query_on_the_whole_table(spark, tiny):
    docs = [(r[0], r[1]) for r in table(spark, tiny, "documents").select("doc_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op6_near_dedup"](spark, tiny).collect())) == brute.near_groups(docs)


def test_chunks_and_empty_table(spark, empty, rows):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**62, (400, 2))
    rows_ = [(i, int(a), int(b)) for i, (a, b) in enumerate(base)] + [(1000 + i, int(a) ^ 5, int(b)) for i, (a, b) in enumerate(base[:50])]
    prints = spark.createDataFrame(rows_, "idx long, f0 long, f1 long")
    edges = {tuple(sorted(r)) for r in nd.edges_of(prints, len(rows_), chunk=60).collect()}
    assert edges == {(i, 1000 + i) for i in range(50)}
    assert nd.near_dedup(empty).count() == 0


def test_stage_keeps_whole_rows(spark, awkward, clash, whole):
    docs = clash(awkward)
    got = nd.stage(spark, docs, "")
    whole(got, docs)
    assert got.count() == nd.near_dedup(awkward).count()


def test_dense_chunks_are_compared_by_their_leading_bits_alone(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 2).astype(np.uint64) & np.uint64(0xFFFFFF00FFFFFF00)
    one = base ^ (rng.integers(0, 2**63, (200, 2)).astype(np.uint64) & np.uint64(0x000000FF000000FF))
    two = one ^ np.uint64(0x0002020000020200)  # two bits of each quarter, past the leading ones
    prints = [(i + 1000 * k, int(a), int(b)) for k, f in enumerate((one, two)) for i, (a, b) in enumerate(f.view(np.int64))]
    edges = nd.edges_of(spark.createDataFrame(prints, "idx long, f0 long, f1 long"), len(prints), 8, chunk=60).collect()
    root = {i: i for i, _, _ in prints}
    for a, b in edges:
        a, b = root[a], root[b]
        root = {k: a if v == b else v for k, v in root.items()}
    assert [i for i in range(200) if root[i] != root[1000 + i]] == []


def test_the_least_of_repeated_rows_stays(spark):
    docs = [(1, "same text of more than five words", "en", s, 1) for s in ("src7", "src2", None, "src5")]
    for n in (1, 4):
        got = nd.stage(spark, spark.createDataFrame(docs, brute.SCHEMA).repartition(n), "").collect()
        assert [r["source"] for r in got] == [None]
        got = nd.stage(spark, spark.createDataFrame(docs, brute.SCHEMA).filter("source is not null").repartition(n), "").collect()
        assert [r["source"] for r in got] == ["src2"]


def test_heavy_words_and_long_texts():
    texts = ["word " * 200_000 + brute.passage(1, 50), brute.passage(2, 40_000), "la " * 100_000 + "lo", "la " * 100_000 + "lu"]
    f, n = nd.fingerprints(pa.array(texts))
    for t, (a, b) in zip(texts, f.tolist()):
        assert brute.fingerprint(t) == a << 64 | b
