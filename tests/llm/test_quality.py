import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tests.conftest import DATA
from tests.llm import brute
from tramline.llm import quality as q


def plain(text):
    """The statistics, one text at a time."""
    words = brute.folded_words(text)
    if not words:
        return None
    raw, n = text.encode(), len(words)
    size = [len(w) for w in words]
    mean = sum(size) / n
    count = Counter(words)
    letters = sum(chr(b).isalpha() if b < 128 else True for b in raw)
    stop, space = set(b".,;:?'\"-()"), set(b" \t\n\r")
    alnum = lambda b: b >= 128 or chr(b).isalnum()
    angle = lambda x: math.asin(math.sqrt(min(1, max(0, x))))
    return [
        math.log1p(n), math.log(mean + 0.1), math.log(max(0, sum(s * s for s in size) / n - mean**2) + 0.1), angle(sum(65 <= b <= 90 for b in raw) / max(1, letters)),
        angle(sum(48 <= b <= 57 for b in raw) / len(raw)), angle(sum(not alnum(b) and b not in stop and b not in space for b in raw) / len(raw)), angle(sum(b in stop for b in raw) / len(raw)),
        angle(sum(b in space for b in raw) / len(raw)), angle(sum(a == b for a, b in zip(words, words[1:])) / n), angle(max(count.values()) / n), angle(sum(c == 1 for c in count.values()) / n),
        math.log1p(len(count)) - 0.75 * math.log1p(n), math.log((raw.count(b"\n") + 1) / (n + 1)),
    ]


def test_statistics_equal_plain_ones():
    texts = [r[1] for r in brute.awkward()] + ["A\nB b b C 12 $$ %", "...", "x"]
    got = q.statistics(pa.array(texts))
    for t, row in zip(texts, got):
        want = plain(t) if t else None
        assert np.isnan(row).all() if want is None else np.allclose(row, want)


def test_score_is_the_log_density_ratio():
    rng = np.random.default_rng(0)
    x = {c: rng.normal(c, 1 + c, (400, q.FEATURES)) for c in (0, 1)}
    moments = {c: np.concatenate([[len(v)], v.sum(0), (v.T @ v).ravel()]) for c, v in x.items()}
    model = q.fit(moments, shrink=0.2, ridge=0.0)
    pooled = np.diag(sum(np.cov(v.T, bias=True) for v in x.values()) / 2) + 1e-6
    at, want = rng.normal(size=(50, q.FEATURES)), 0
    for c, sign in ((1, 1), (0, -1)):
        s = 0.8 * np.cov(x[c].T, bias=True) + 0.2 * np.diag(pooled)
        d = at - x[c].mean(0)
        want = want + sign * (-0.5 * np.linalg.slogdet(s)[1] - 0.5 * np.einsum("ni,ij,nj->n", d, np.linalg.inv(s), d) + math.log(0.5))
    assert np.allclose(model.score(at), want)


def plain_scores(docs, labels):
    """(id, score) of every document with words, one by one; docs: (id, text); labels: (id, quality)."""
    grade = {}
    for id_, g in labels:
        if g in (0, 1):
            grade[id_] = min(g, grade.get(id_, 1))
    rows = [(i, np.array(x)) for i, t in docs for x in [plain(t) if t else None] if x is not None]
    own = {c: np.array([x for i, x in rows if grade.get(i) == c]) for c in (0, 1)}
    n = {c: len(v) for c, v in own.items()}
    cov = {c: np.cov(v.T, bias=True) for c, v in own.items()}
    pooled = np.diag(sum(np.diag(cov[c]) * n[c] for c in (0, 1)) / sum(n.values()) + 1e-6)
    out = []
    for i, x in rows:
        density = []
        for c in (0, 1):
            s = (1 - q.SHRINK) * cov[c] + (q.SHRINK + q.RIDGE) * pooled
            d = x - own[c].mean(0)
            density.append(math.log(n[c] / sum(n.values())) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * d @ np.linalg.solve(s, d))
        out.append((i, density[1] - density[0]))
    return out


def test_whole_query_equals_brute_force(spark, tiny, awkward):
    long = spark.createDataFrame([(10**6, brute.passage(3, 60_000), "en", "src0", 1), (10**6 + 1, "buy now!!! $$$ " * 20_000, "en", "src0", 1)], brute.SCHEMA)
    docs = spark.read.parquet(f"{tiny}/documents.parquet").unionByName(long).unionByName(awkward.withColumn("doc_id", awkward.doc_id + 2 * 10**6))
    labels = spark.read.parquet(f"{tiny}/labels.parquet")
    want = plain_scores([(r[0], r[1]) for r in docs.select("doc_id", "text").collect()], [(r[0], r[1]) for r in labels.select("doc_id", "quality").collect()])
    want = sorted(((i, s) for i, s in want if s >= 0), key=repr)
    got = sorted(map(tuple, q.classify(docs, labels).collect()), key=repr)
    assert [i for i, _ in got] == [i for i, _ in want]
    assert np.allclose([s for _, s in got], [s for _, s in want])


def test_a_bounded_sample_of_labels(spark, tiny):
    docs, labels = (spark.read.parquet(f"{tiny}/{t}.parquet") for t in ("documents", "labels"))
    ids, classes = q.labelled(labels, 50)
    assert len(ids) == len(classes) == 50 and (np.diff(ids) > 0).all()
    whole = {r[0] for r in q.classify(docs, labels).collect()}
    part = {r[0] for r in q.classify(docs, labels, 100).collect()}
    assert len(whole & part) > 0.9 * len(whole)


def test_a_text_of_50_megabytes():
    text = brute.passage(4, 10_000) * 900
    x = q.statistics(pa.array([text, "x"]))
    assert len(text) > 50_000_000 and np.isclose(x[0, 0], math.log1p(len(brute.tokens(text))))


def test_held_out_accuracy(spark):
    path = DATA / "sf0.1"
    if not path.exists():
        pytest.skip("no test tables")
    labels = pq.read_table(path / "labels.parquet").to_pandas()
    docs = spark.read.parquet(str(path / "documents.parquet"))
    train = spark.createDataFrame(labels[labels.doc_id % 2 == 0])
    kept = {r[0] for r in q.classify(docs, train).collect()}
    held = labels[labels.doc_id % 2 == 1]
    right = [(i in kept) == bool(g) for i, g in zip(held.doc_id, held.quality)]
    assert sum(right) / len(right) > 0.98
    good = held[held.quality == 1].doc_id
    assert sum(i in kept for i in good) / len(good) > 0.99


def test_edges(spark, awkward, empty, labels, clash, rows, tmp_path, whole):
    assert q.classify(empty, labels).count() == 0
    got = rows(q.classify(awkward, labels))
    assert rows(q.classify(clash(awkward), labels)) == got
    unlabelled = rows(q.classify(awkward, labels.filter("quality = 1")))
    assert len(unlabelled) == 15 and all(r[1] is None for r in unlabelled)  # every text with words
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    stage = q.stage(spark, clash(awkward), str(tmp_path))
    whole(stage, clash(awkward))
    assert sorted((r[0] for r in stage.select("doc_id").collect()), key=repr) == sorted((r[0] for r in got), key=repr)
