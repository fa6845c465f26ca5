import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm import brute
from tramline.llm import binfit, packing, sharding
from tramline.llm.common import table
from tramline.llm.queries import QUERIES


def check_packs(rows, docs, seq_len):
    """Every token of every document once, no two pieces of a pack on the same place, none outside."""
    want = Counter((id_, len(brute.tokens(t))) for id_, t in docs)
    packs, got = defaultdict(list), defaultdict(list)
    for id_, segment, n, pack, start in rows:
        if pack is None:
            assert n == 0 and segment == 0 and start is None
            got[id_].append((segment, 0))
            continue
        assert 0 < n <= seq_len and start >= 0 and start + n <= seq_len
        packs[pack].append((start, start + n))
        got[id_].append((segment, n))
    for places in packs.values():
        places.sort()
        assert all(a[1] <= b[0] for a, b in zip(places, places[1:]))
    ids = {i for i, _ in want}
    for id_ in ids:
        assert sum(n for _, n in got[id_]) == sum(n * k for (i, n), k in want.items() if i == id_)
    return packs


def test_awkward_documents(spark, awkward, clash, rows):
    docs = [(r[0], r[1]) for r in brute.awkward()]
    a = rows(packing.pack(awkward))
    check_packs(a, docs, packing.SEQ_LEN)
    assert len({r[2:] for r in a if r[0] == 1}) == 2  # repeated rows have places of their own
    assert rows(packing.pack(clash(awkward))) == a


def test_empty(empty):
    assert packing.pack(empty).count() == 0
    assert sharding.shard(empty).count() == 0


def test_query_packs_the_whole_table(spark, tiny):
    docs = [(r[0], r[1]) for r in table(spark, tiny, "documents").select("doc_id", "text").collect()]
    packs = check_packs([tuple(r) for r in QUERIES["op1_best_fit_packing"](spark, tiny).collect()], docs, packing.SEQ_LEN)
    sizes = [min(packing.SEQ_LEN, n - s * packing.SEQ_LEN) for _, t in docs for n in [len(brute.tokens(t))] for s in range(max(1, -(-n // packing.SEQ_LEN))) if n]
    assert len(packs) <= len(brute.best_fit_bins(sizes, packing.SEQ_LEN)) * 1.02 + 1


@pytest.mark.parametrize("seed", range(4))
def test_plan_follows_the_fit(seed):
    """Every pattern pack has the classes of its pattern, as often as the fit says; no piece is lost or placed twice."""
    rng = random.Random(seed)
    seq_len, units = 256, 16
    counts = Counter(min(seq_len, 1 + int(rng.expovariate(1 / 60))) for _ in range(5000))
    runs, packs = packing.plan(counts, units, 3, seq_len)
    filled, ranks = defaultdict(list), Counter()
    for r in runs:
        for rank in range(r.lo, r.hi):
            filled[r.bin + (rank - r.lo) // r.per_bin].append((r.offset + (rank - r.lo) % r.per_bin * r.size, r.size))
            ranks[r.size, rank] += 1
    assert ranks == Counter((s, i) for s, k in counts.items() for i in range(k))
    assert sorted(filled) == list(range(packs))
    for places in filled.values():
        places.sort()
        assert places[0][0] == 0 and places[-1][0] + places[-1][1] <= seq_len and all(a + s <= b for (a, s), (b, _) in zip(places, places[1:]))
    shapes = packing.patterns(units, 3)
    a = np.array([[shape.count(k + 1) for shape in shapes] for k in range(units)], float)
    b = np.array([sum(n for s, n in counts.items() if -(-s // 16) == k + 1) for k in range(units)], float)
    weight = np.sqrt(np.arange(1, units + 1) / units)
    x = packing.nnls(a * weight[:, None], b * weight / b.sum()) * b.sum()
    left = Counter({k + 1: int(n) for k, n in enumerate(b)})
    for j in sorted(np.flatnonzero(x > 0), key=lambda j: (-x[j], j)):
        times = min(round(x[j]), *(left[s] // m for s, m in Counter(shapes[j]).items()))
        same = sum(tuple(sorted((-(-s // 16) for _, s in p[: len(shapes[j])]), reverse=True)) == shapes[j] for p in filled.values())
        assert same >= times
        for s in shapes[j]:
            left[s] -= times
    assert packs <= 1.02 * len(brute.best_fit_bins(list(counts.elements()), seq_len)) + 1


def test_patterns_and_nnls():
    found = packing.patterns(12, 3)
    assert len(found) == len(set(found)) == 19 and all(sum(p) == 12 and len(p) <= 3 for p in found)
    rng = np.random.default_rng(0)
    a, b = rng.random((8, 20)), rng.random(8)
    x = packing.nnls(a, b)
    slope = a.T @ (b - a @ x)
    assert (x >= 0).all() and (slope <= 1e-8).all() and np.abs(slope[x > 0]).max(initial=0) < 1e-8


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_equals_one_by_one(seed):
    rng = random.Random(seed)
    capacity = rng.choice([20, 64, 100])
    sizes = [rng.choice([1, 2, 3, 5, 8, 13, 21, capacity // 2, capacity, capacity + 3, rng.randint(1, capacity)]) for _ in range(300)]
    runs, n = binfit.best_fit(Counter(sizes), capacity)
    filled, ranks = defaultdict(list), Counter()
    for r in runs:
        for rank in range(r.lo, r.hi):
            filled[r.bin + (rank - r.lo) // r.per_bin].append((r.offset + (rank - r.lo) % r.per_bin * r.size, r.size))
            ranks[r.size, rank] += 1
    assert ranks == Counter((s, i) for s, k in Counter(sizes).items() for i in range(k))
    for places in filled.values():
        places.sort()
        assert all(a + s <= b for (a, s), (b, _) in zip(places, places[1:]))
    want = brute.best_fit_bins(sizes, capacity)
    assert n == len(filled) == len(want)
    assert sorted(sum(s for _, s in p) for p in filled.values()) == sorted(map(sum, want))


def test_shards_keep_groups_and_equal_brute_force(spark, awkward, clash, rows, tiny):
    for docs, capacity in ((awkward, 4096), (awkward, 64), (table(spark, tiny, "documents"), 1 << 16)):
        got = rows(sharding.shard(docs, capacity, 16))
        texts = docs.select("doc_id", "text").collect()
        assert Counter(r[0] for r in got) == Counter(r[0] for r in texts)
        size = Counter()
        for _, t in texts:
            size[t] += len((t or "").encode())
        units = {t: max(1, -(-n // 16)) for t, n in size.items()}
        want = brute.best_fit_bins(list(units.values()), capacity // 16)
        assert len({r[2] for r in got}) == len(want)
        shard_of = {}
        for id_, n, shard in got:
            shard_of.setdefault((id_, n), set()).add(shard)
        by_text = defaultdict(set)
        for id_, t in texts:
            by_text[t] |= shard_of[id_, size[t]] if sum(i == id_ for i, _ in texts) == 1 else set()
        assert all(len(s) <= 1 for s in by_text.values())
    assert rows(sharding.shard(clash(awkward))) == rows(sharding.shard(awkward))


def test_query_shards_the_whole_table(spark, tiny):
    got = QUERIES["op5_sharding"](spark, tiny)
    assert got.count() == table(spark, tiny, "documents").count()
