from collections import Counter

import pytest

from tests.llm import brute
from tramline.llm import mixing as m
from tramline.llm.common import table


def chosen(df):
    return Counter((r["doc_id"], r["epoch"]) for r in df.collect())


@pytest.mark.parametrize("fraction, epochs", [(0.8, 2), (0.2, 1), (3.0, 2), (1.7, 3)])
def test_equals_brute_force(spark, awkward, tiny, fraction, epochs):
    for df in (awkward, table(spark, tiny, "documents")):
        docs = [tuple(r) for r in df.select("doc_id", "text", "lang", "source").collect()]
        assert chosen(m.mix_sources(df, fraction, epochs, "s")) == brute.mixture(docs, fraction, epochs, "s")


def test_other_targets(spark, awkward, tiny):
    targets = m.Targets({"a": ("src0", "src3"), "b": ("src1",), "c": ("src2", "src6", "src9")}, {"a": 0.2, "b": 0.7}, {"fr": 0.6, "en": 0.1}, 0.3, 0.02, {"src0": 5.0, "src9": 0.5}, 2.0)
    for df in (awkward, table(spark, tiny, "documents")):
        docs = [tuple(r) for r in df.select("doc_id", "text", "lang", "source").collect()]
        got = chosen(m.mix_sources(df, 0.6, 2, "s", targets))
        assert got == brute.mixture(docs, 0.6, 2, "s", targets)
        assert got != chosen(m.mix_sources(df, 0.6, 2, "s"))


def test_shortage_stays_among_siblings(spark):
    # books hold little English; its German takes over before web gets any of it
    docs = [(i, "w " * 10, "en", "src5", 0) for i in range(2)] + [(10 + i, "w " * 10, "de", "src6", 0) for i in range(50)] + [(100 + i, "w " * 10, "en", "src0", 0) for i in range(100)]
    got = m.mix_sources(spark.createDataFrame(docs, brute.SCHEMA), 0.2, 1).groupBy("domain", "lang").count().collect()
    count = {(r[0], r[1]): r[2] for r in got}
    assert count[("books", "en")] == 2
    assert count[("books", "de")] == 11  # 304 tokens of 1520, 3/7 to books: 130, less 20
    assert count[("web", "en")] == 17


def test_edges(spark, awkward, empty, clash, rows, whole):
    assert m.mix_sources(empty).count() == 0
    assert rows(m.mix_sources(clash(awkward))) == rows(m.mix_sources(awkward))
    assert m.mix_sources(awkward, 100.0, 2).count() == 2 * 15  # all that has tokens, twice
    got = m.stage(spark, clash(awkward), "")
    whole(got, clash(awkward))
    assert Counter(r[0] for r in got.select("doc_id").collect()) == Counter(r[0] for r in m.mix_sources(awkward).select("doc_id").collect())
