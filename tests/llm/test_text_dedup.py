import random
import time

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import brute
from tramline.llm import line_dedup as ld
from tramline.llm import substring_dedup as sd
from tramline.llm.common import table
from tramline.llm.queries import QUERIES


def texts(df):
    return [(r[0], r[1]) for r in df.select("doc_id", "text").collect()]


def test_places_survive_packing():
    rng = np.random.default_rng(1)
    for n in (1, 10, 3000):
        ids = np.sort(rng.integers(-(2**62), 2**62, n))
        at = np.sort(rng.integers(0, 10**9, n))
        got = sd.unsqueeze(sd.squeeze(ids, at))
        assert (got[0] == ids).all() and (got[1] == at).all()


@pytest.mark.parametrize("width", [1, 5, 50])
def test_intervals_equal_brute_force(spark, awkward, rows, width):
    assert set(rows(sd.substring_dedup(awkward, width, 1 << 16))) == brute.repeats(texts(awkward), width)


@pytest.mark.parametrize("fan", [2, 3])
def test_finer_parts_and_hot_windows(spark, rows, fan):
    hot = brute.passage(7, 12)
    docs = [(i % 50, " ".join([brute.passage(i, 5 + i % 7), hot, brute.passage(1000 + i, i % 4)]), None, None, None) for i in range(120)]
    df = spark.createDataFrame(docs, brute.SCHEMA).repartition(4)
    assert set(rows(sd.substring_dedup(df, 6, 100, fan))) == brute.repeats([d[:2] for d in docs], 6)


def test_windows_of_a_hot_passage_are_sent_once():
    hot, n = brute.passage(8, 60), 3000
    batch = pa.RecordBatch.from_pydict({"__id": list(range(n)), "text": [f"{hot} {brute.passage(i, 55)}" for i in range(n)]})
    sent = [len(b) // 8 for out in sd.window_blobs(50, 500)([batch]) for b in out.column("hashes").to_pylist() + out.column("reps").to_pylist()]
    assert sum(sent) <= 11 + n * (115 - 49 - 11)


def test_long_text_crosses_regions(spark, rows):
    long = brute.passage(9, 140_000)
    docs = [(1, long, None, None, None), (2, "x " + long, None, None, None), (1, long, None, None, None)]
    assert rows(sd.substring_dedup(spark.createDataFrame(docs, brute.SCHEMA))) == [(1, 0, 140_000), (2, 1, 140_001)]


def test_repeats_are_taken_out(spark, clash, rows):
    shared = brute.passage(2, 60)
    docs = spark.createDataFrame([(1, f"a  b\n{shared} c", "en", "s", 1), (2, f"{shared}", "en", "s", 1), (3, "d  e", None, None, None), (4, None, "en", "s", 1), (None, shared, None, None, 2)], brute.SCHEMA)
    got = sd.without_repeats(clash(docs), sd.substring_dedup(docs))
    assert got.columns == clash(docs).columns
    assert rows(got.select("doc_id", "text")) == sorted([(1, "a b c"), (2, ""), (3, "d  e"), (4, None), (None, shared)], key=repr)


def test_random_texts(spark, rows):
    rng = random.Random(5)
    docs = [(i, " ".join(rng.choice("abcde") for _ in range(rng.randint(0, 60))), None, None, None) for i in range(80)]
    df = spark.createDataFrame(docs, brute.SCHEMA)
    assert set(rows(sd.substring_dedup(df, 6))) == brute.repeats([d[:2] for d in docs], 6)


def test_substring_edges(awkward, empty, clash, rows):
    assert sd.substring_dedup(empty).count() == 0
    assert rows(sd.substring_dedup(clash(awkward))) == rows(sd.substring_dedup(awkward))


LINES = [f"User u{i} logged in from host alpha at noon" for i in range(6)] + ["User bob logged out", "Page 7 of 90", "Page 8 of 1", ""]


def test_templates_equal_brute_force(spark, rows, awkward):
    docs = [(i, "\n".join(LINES[i % 4 : i % 4 + 5]) + f"\nonly line{i} {brute.passage(i, 5)}", None, None, None) for i in range(12)] + [(3, LINES[0], None, None, None), (None, "Page 1 of 2\r\n", None, None, None)]
    df = spark.createDataFrame(docs, brute.SCHEMA).repartition(4)
    for alike, least in ((0.8, 3), (1.0, 2), (0.5, 5)):
        assert set(rows(ld.line_dedup(df, 3, alike, least))) == brute.line_templates([d[:2] for d in docs], 3, alike, least)
    assert set(rows(ld.line_dedup(awkward, min_docs=1))) == brute.line_templates(texts(awkward), ld.LEADING, ld.ALIKE, 1)


@pytest.mark.parametrize("alike, width", [(0.8, 9), (0.5, 6), (1.0, 4), (0.7, 12), (0.0, 5), (0.2, 3)])
def test_leaf_equals_comparing_all(alike, width):
    rng = random.Random(width)
    lines = sorted({" ".join(["a", "b", "c"][: min(3, width)] + [rng.choice("uvwxyz") * rng.choice([1, 1, 2]) for _ in range(width - 3)]) for _ in range(400)})
    leaf = ld.Leaf(width, 3, alike)
    got = [leaf.head(line, k) for k, line in enumerate(lines)]
    want = brute.line_templates([(k, line) for k, line in enumerate(lines)], 3, alike, 1)
    sizes = {k: sum(g == got[k] for g in got) for k in range(len(lines))}
    assert {(k, 0, n) for k, n in sizes.items()} == want


def test_a_popular_leaf_takes_linear_time():
    def took(n):
        rng = random.Random(n)
        lines = sorted(f"the same start {rng.randrange(10**9):x} {rng.randrange(10**9):x} {rng.randrange(10**9):x} {rng.randrange(10**9):x} {rng.randrange(10**9):x}" for _ in range(n))
        leaf, began = ld.Leaf(8, 3, 0.8), time.process_time()
        for k, line in enumerate(lines):
            leaf.head(line, k)
        return time.process_time() - began

    took(1000)
    assert took(100_000) < 40 * max(took(10_000), 0.05)


def test_lines_are_taken_out(spark, clash, rows):
    docs = spark.createDataFrame([(1, "keep\n Page 7 of 90\n\nend", "en", "s", 1), (2, "Page 3 of 4", "en", "s", 1), (3, "other\r\n", None, None, None), (4, None, "en", "s", 1), (None, "Page 1 of 2\nx", None, None, 2)], brute.SCHEMA)
    got = ld.without_lines(clash(docs), ld.line_dedup(docs, min_docs=3))
    assert got.columns == clash(docs).columns
    assert rows(got.select("doc_id", "text")) == sorted([(1, "keep\n\nend"), (2, ""), (3, "other\r\n"), (4, None), (None, "x")], key=repr)


def test_line_edges(awkward, empty, clash, rows):
    assert ld.line_dedup(empty).count() == 0
    assert rows(ld.line_dedup(clash(awkward), min_docs=2)) == rows(ld.line_dedup(awkward, min_docs=2))


def test_line_query_on_the_whole_table(spark, tiny, rows):
    docs = texts(table(spark, tiny, "documents"))
    assert set(rows(QUERIES["op4_line_dedup"](spark, tiny))) == brute.line_templates(docs, ld.LEADING, ld.ALIKE, ld.MIN_DOCS)
