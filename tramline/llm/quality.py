"""Quality classifier: regularised quadratic discriminant over statistics of documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_key, table
from .textvec import WORD_GAP, buffers, counted, fold, pieces, words

FEATURES = 13
SHRINK, RIDGE = 0.1, 1e-3
MOST_LABELS = 500_000

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = ~WORD_GAP
_LETTER[48:58] = False
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,;:?'\"-()"]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 13, 32]] = True
_SYMBOL = WORD_GAP & ~_STOP & ~_SPACE
_LINE = np.zeros(256, bool)
_LINE[10] = True


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of transformed statistics for each text; NaN for one without words.

    Logs of the number of words, their mean length and its variance; arcsines of square roots of the shares of
    capitals, digits, symbols, points, spaces, words that repeat the one before, the commonest word, and
    words that occur once; distinct words against length; lines against words.
    """
    data, offsets = buffers(texts)
    out = np.full((len(offsets) - 1, FEATURES), np.nan)
    for i, j in pieces(offsets):
        raw, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        hashes, start, end, first = words(fold(raw), at, WORD_GAP, True)
        n = np.diff(first).astype(float)
        if not n.sum():
            continue
        size = np.diff(at).astype(float)

        def share(of: np.ndarray, by: np.ndarray) -> np.ndarray:
            sums, filled = np.zeros(j - i), at[:-1] < at[1:]
            sums[filled] = np.add.reduceat(of[raw], at[:-1][filled], dtype=np.int64)
            return sums / np.maximum(by, 1)

        def per_text(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(values)])
            return np.diff(sums[edges])

        long = (end - start).astype(np.int64)
        many = np.maximum(n, 1)
        mean = per_text(long, first) / many
        spread = np.maximum(per_text(long * long, first) / many - mean**2, 0)
        again = np.zeros(len(hashes), np.int64)
        again[1:] = hashes[1:] == hashes[:-1]
        again[first[:-1][n > 0]] = 0
        _, count, edges = counted(hashes, first)
        top = np.zeros(j - i)
        some = np.flatnonzero(np.diff(edges))
        top[some] = np.maximum.reduceat(count, edges[:-1][some])
        distinct = np.diff(edges)
        letters = share(_LETTER, np.ones(j - i))
        angle = lambda x: np.arcsin(np.sqrt(np.clip(x, 0, 1)))
        out[i:j] = np.stack(
            [
                np.log1p(n),
                np.log(mean + 0.1),
                np.log(spread + 0.1),
                angle(share(_UPPER, letters)),
                angle(share(_DIGIT, size)),
                angle(share(_SYMBOL, size)),
                angle(share(_STOP, size)),
                angle(share(_SPACE, size)),
                angle(per_text(again, first) / many),
                angle(top / many),
                angle(per_text(count == 1, edges) / many),
                np.log1p(distinct) - 0.75 * np.log1p(n),
                np.log((share(_LINE, np.ones(j - i)) + 1) / (n + 1)),
            ],
            axis=1,
        )
        out[i:j][n == 0] = np.nan
    return out


class Discriminant:
    """Two Gaussians. Score: log density and prior of the good class less that of the bad one."""

    def __init__(self, means: np.ndarray, covariances: np.ndarray, counts: np.ndarray):
        self.means = means
        self.factors = [np.linalg.inv(np.linalg.cholesky(c)) for c in covariances]
        self.consts = [np.log(n / counts.sum()) + np.log(np.diag(f)).sum() for n, f in zip(counts, self.factors)]

    def score(self, x: np.ndarray) -> np.ndarray:
        bad, good = (c - 0.5 * (((x - m) @ f.T) ** 2).sum(axis=1) for m, f, c in zip(self.means, self.factors, self.consts))
        return good - bad


def fit(moments: dict[int, np.ndarray], shrink: float = SHRINK, ridge: float = RIDGE) -> Discriminant | None:
    """From (n, sums, sums of products) of either class; None unless both have two documents.

    Each covariance is shrunk towards the diagonal of the pooled one, then widened by `ridge` of it.
    """
    if any(moments.get(c, np.zeros(1))[0] < 2 for c in (0, 1)):
        return None
    n = np.array([moments[c][0] for c in (0, 1)])
    means = np.array([moments[c][1 : 1 + FEATURES] / moments[c][0] for c in (0, 1)])
    own = np.array([moments[c][1 + FEATURES :].reshape(FEATURES, FEATURES) / moments[c][0] - np.outer(m, m) for c, m in zip((0, 1), means)])
    pooled = np.diag(np.diag((own * (n / n.sum())[:, None, None]).sum(axis=0)) + 1e-6)
    return Discriminant(means, (1 - shrink) * own + (shrink + ridge) * pooled, n)


def labelled(labels: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted ids and their classes: all labelled documents, or if there are more than `most` those first by a hash of the id."""
    graded = labels.filter("quality in (0, 1)").groupBy(id_key().alias("__id")).agg(F.min("quality").cast("long").alias("__class"))
    found = graded.orderBy(F.xxhash64("__id"), "__id").limit(most).toArrow()  # at most 16 bytes times `most`
    ids, classes = (found.column(c).to_numpy() for c in ("__id", "__class"))
    order = np.argsort(ids)
    return ids[order], classes[order]


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELS) -> Discriminant | None:
    """Fitted on the labelled documents among docs: the sums of either class are added up in Spark.

    Only labelled texts are worked on, and no text is shuffled: the ids of at most `most` labels go to every task.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(labelled(labels, most))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, classes = shared.value
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            ids = batch.column("__id").to_numpy()
            at = np.minimum(np.searchsorted(known, ids), max(0, len(known) - 1))
            hit = known[at] == ids if len(known) else np.zeros(len(ids), bool)
            x, c = statistics(batch.column("text").filter(pa.array(hit))), classes[at[hit]] if len(known) else at[:0]
            filled = ~np.isnan(x[:, 0])
            for k in (0, 1):
                own = x[filled & (c == k)]
                total[k] = total.get(k, 0) + np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        yield pa.RecordBatch.from_pydict({"__class": pa.array(list(total), pa.int64()), "m": pa.array([list(v) for v in total.values()], pa.list_(pa.float64()))})

    sums = docs.select(id_key().alias("__id"), "text").mapInArrow(part, "__class long, m array<double>")
    sums = sums.select("__class", F.posexplode("m").alias("__at", "__v")).groupBy("__class", "__at").agg(F.sum("__v").alias("__v"))
    moments: dict[int, np.ndarray] = {}
    for c, at, v in sums.collect():  # two classes of 1 + FEATURES + FEATURES**2 numbers
        moments.setdefault(c, np.zeros(1 + FEATURES + FEATURES**2))[at] = v
    return fit(moments)


def classify(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELS) -> DataFrame:
    """(doc_id, score) of the documents that the classifier keeps: those with a score of 0 or more.

    It is fitted on all labelled documents (quality 1 or 0; the lower of several labels of one id counts), or on
    `most` of them, chosen by a hash of the id, if there are more. Every document is scored, over its whole text.

    A null, empty or wordless text is rejected. Unless both classes have two documents there is no
    classifier: every text with words is kept, with a null score. Repeated rows are scored each; a null doc_id is kept
    and has no label unless one is null, too. A score of 0, a tie, is kept. Very long texts are worked through in
    blocks. Other columns don't matter. An empty table gives no rows.
    """
    model = train(docs, labels, most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = statistics(batch.column("text"))
            filled = ~np.isnan(x[:, 0])
            score = np.full(len(x), np.nan)
            if model is not None:
                score[filled] = model.score(x[filled])
                filled &= ~(score < 0)
            out = pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "score": pa.array(score, mask=np.isnan(score))})
            yield out.filter(pa.array(filled))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of docs that `classify` keeps, with all of their columns.

    Texts are read twice, once to fit on the labelled ones and once to filter, and never shuffled. Null, empty and wordless
    texts go; repeated rows are judged each and stay or go together; an empty table gives no rows; no column's name can clash.
    """
    model = train(docs, table(spark, sf_dir, "labels"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = statistics(batch.column("text"))
            keep = ~np.isnan(x[:, 0])
            if model is not None:
                keep &= np.nan_to_num(model.score(x), nan=-1.0) >= 0
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
