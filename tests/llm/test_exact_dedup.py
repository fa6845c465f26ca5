import hashlib

import numpy as np
import pytest

from tramline.llm import exact_dedup as ed
from tramline.llm.common import table


def digests(n, salt=""):
    raw = b"".join(hashlib.md5(f"{salt}{i}".encode()).digest() for i in range(n))
    return np.frombuffer(raw, np.uint64).reshape(-1, 2)


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000])
def test_perfect_hash_is_minimal_and_exact(n):
    keys = digests(n)
    made = ed.PerfectHash.load(ed.PerfectHash.build(keys, np.arange(n) * 7).dump())
    assert sorted(made.slots(keys).tolist()) == list(range(n))
    member, winner = made.find(keys)
    assert member.all() and (winner == np.arange(n) * 7).all()
    assert not made.find(digests(3000, "other"))[0].any()


def winners(docs, known):
    best = {}
    for id_, text in docs:
        key = id_ is None or id_ not in known, -(2**63) if id_ is None else id_
        if id_ is None:
            key = None not in known, -(2**63)
        best[text] = min(best.get(text, key), key)
    return sorted((None if k[1] == -(2**63) else k[1] for k in best.values()), key=repr)


@pytest.mark.parametrize("most", [0, 1 << 20])
def test_keeps_one_of_each_text(spark, awkward, labels, rows, most):
    docs = [(r[0], r[1]) for r in awkward.select("doc_id", "text").collect()]
    known = {r[0] for r in labels.collect()}
    d = ed.digests(awkward)
    got = ed.winners(d, ed.labelled(d, labels), per_shard=3, most_broadcast=most)
    ids = sorted((None if r[1] == -(2**63) else r[1] for r in got.collect()), key=repr)
    assert ids == winners(docs, known)


def test_edges(spark, awkward, empty, labels, clash, rows):
    assert ed.exact_dedup(empty, labels).count() == 0
    assert rows(ed.exact_dedup(clash(awkward), labels)) == rows(ed.exact_dedup(awkward, labels))
    none = ed.exact_dedup(awkward, labels.filter("false"))
    assert none.count() == awkward.select("text").distinct().count()


def test_stage_keeps_whole_rows(spark, awkward, labels, clash, tmp_path, rows, whole):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = clash(awkward)
    got = ed.stage(spark, docs, str(tmp_path))
    whole(got, docs)
    assert got.select("text").distinct().count() == got.count() == docs.select("text").distinct().count()


def test_whole_table(spark, tiny, rows):
    docs = table(spark, tiny, "documents")
    known = {r[0] for r in table(spark, tiny, "labels").select("doc_id").collect()}
    assert [r[0] for r in rows(ed.exact_dedup(docs, table(spark, tiny, "labels")))] == winners([(r[0], r[1]) for r in docs.select("doc_id", "text").collect()], known)
