"""Best-fit packing of documents into training sequences, by patterns fitted with non-negative least squares."""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .binfit import Run, best_fit, placed
from .common import materialise, ranked, token_count

SEQ_LEN, UNITS, PATTERN_DOCS = 2048, 64, 4


def patterns(units: int, most: int) -> list[tuple[int, ...]]:
    """Every non-increasing tuple of 1 to `most` positive lengths with the sum `units`."""
    found: list[tuple[int, ...]] = []

    def grow(head: tuple[int, ...], left: int, top: int) -> None:
        if not left:
            found.append(head)
        elif len(head) < most and top * (most - len(head)) >= left:
            for length in range(min(left, top), 0, -1):
                grow((*head, length), left - length, length)

    grow((), units, units)
    return found


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 with the least |ax - b| (Lawson and Hanson's active sets).

    It ends where no column that is out would lessen the rest. A column that rounding throws out again at once
    is passed over until another has made progress, so that it can't go round in circles.
    """
    x, active, useless = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool), np.zeros(a.shape[1], bool)
    while True:
        slope = a.T @ (b - a @ x)
        slope[active | useless] = -np.inf
        best = int(np.argmax(slope))
        if slope[best] <= 1e-10 * max(1.0, np.abs(b).max()):
            return x
        active[best] = True
        before = x.copy()
        while True:
            at = np.flatnonzero(active)
            s = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if (s > 0).all():
                x[:] = 0
                x[at] = s
                break
            low = s <= 0
            step = np.min(x[at][low] / np.maximum(x[at][low] - s[low], 1e-300))
            x[at] += step * (s - x[at])
            active[at[x[at] <= 1e-12]] = False
            x[~active] = 0
        if np.linalg.norm(a @ x - b) < np.linalg.norm(a @ before - b) * (1 - 1e-12):
            useless[:] = False
        else:
            x, active = before, before > 0
            useless[best] = True


class Pool:
    """The pieces of each class of lengths, longest first; they are taken in that order."""

    def __init__(self, counts: dict[int, int], step: int):
        self.lengths: dict[int, list[list[int]]] = {}
        self.left: Counter[int] = Counter()
        self.used: Counter[int] = Counter()
        for length, n in sorted(counts.items(), reverse=True):
            if n > 0:
                self.lengths.setdefault(-(-length // step), []).append([length, n])
                self.left[-(-length // step)] += n

    def take(self, kind: int, n: int) -> list[list[int]]:
        """(length, first rank within it, number) of the next n pieces."""
        out = []
        self.left[kind] -= n
        while n:
            length, there = self.lengths[kind][0]
            k = min(n, there)
            out.append([length, self.used[length], k])
            self.used[length] += k
            n -= k
            if k == there:
                self.lengths[kind].pop(0)
            else:
                self.lengths[kind][0][1] -= k
        return out


def plan(counts: dict[int, int], units: int, most_docs: int, seq_len: int) -> tuple[list[Run], int]:
    """Runs that pack counts[length] pieces of every length (1..seq_len), and the number of packs.

    Lengths are put into `units` classes for the fit. Patterns of classes that fill a pack are repeated as it
    says, rounded and held to the pieces there are. The pieces keep their true lengths: what room a pattern's pack
    has left, and the residual, go to the best fit, longest pieces first.
    """
    pool = Pool(counts, seq_len // units)
    runs: list[Run] = []
    packs, rooms = 0, []
    if pool.left:
        shapes = patterns(units, most_docs)
        a = np.zeros((units, len(shapes)))
        for j, shape in enumerate(shapes):
            for kind in shape:
                a[kind - 1, j] += 1
        b = np.array([pool.left.get(i + 1, 0) for i in range(units)], float)
        total = b.sum()
        weight = np.sqrt(np.arange(1, units + 1) / units)  # a long piece left over costs more than a short one
        x = nnls(a * weight[:, None], b * weight / total) * total
        for j in sorted(np.flatnonzero(x > 0), key=lambda j: (-x[j], j)):
            times = min(int(np.rint(x[j])), *(pool.left[s] // m for s, m in Counter(shapes[j]).items()))
            slots, at = [pool.take(kind, times) for kind in shapes[j]] if times > 0 else [], 0
            while at < times:  # as many packs as have the same lengths in all slots
                n, offset = min(slot[0][2] for slot in slots), 0
                for slot in slots:
                    length, rank, there = slot[0]
                    runs.append(Run(length, rank, rank + n, packs + at, 1, offset))
                    offset += length
                    slot[0][1:] = rank + n, there - n
                    if there == n:
                        slot.pop(0)
                if offset < seq_len:
                    rooms.append((seq_len - offset, packs + at, n))
                at += n
            packs += max(0, times)
    rest = {length: n for kinds in pool.lengths.values() for length, n in kinds}
    more, packs = best_fit(rest, seq_len, packs, pool.used, rooms)
    return runs + more, packs


def pack(docs: DataFrame, seq_len: int = SEQ_LEN, units: int = UNITS, most_docs: int = PATTERN_DOCS) -> DataFrame:
    """(doc_id, segment, tokens, pack_id, start): every document's pieces, each in a pack of seq_len tokens.

    A token is a run without blanks. A text longer than seq_len is cut into whole segments and a rest, so no token
    is lost or repeated. `start` is the piece's place in its pack, in tokens; pieces never overlap. The solver sees only
    the histogram of lengths, at most seq_len numbers.

    A null, empty or blank text has no tokens: one row, segment 0, with null pack_id and start. Repeated
    rows are packed each by itself; a null doc_id is kept. Which of several pieces of one length takes which place
    follows doc_id, then segment; rows equal in both are interchangeable. Other columns don't matter. An empty table
    gives no rows.
    """
    spark = docs.sparkSession
    if seq_len % units:
        raise ValueError("units must divide seq_len")
    sized = docs.select("doc_id", token_count("text").alias("n"))
    last = F.greatest(F.ceil(F.col("n") / seq_len) - 1, F.lit(0))
    cut = sized.select("doc_id", "n", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("segment"))
    cut = cut.select("doc_id", "segment", F.least(F.lit(seq_len), F.col("n") - F.col("segment") * seq_len).cast("long").alias("tokens"))
    cut = materialise(cut)
    counts = {r[0]: r[1] for r in cut.filter("tokens > 0").groupBy("tokens").count().collect()}  # at most seq_len
    runs, _ = plan(counts, units, most_docs, seq_len)
    rows = ranked(cut.filter("tokens > 0"), "tokens", ["doc_id", "segment"], max(counts.values(), default=0))
    rows = placed(spark, rows, "tokens", runs)
    rows = rows.select("doc_id", "segment", "tokens", F.col("__bin").cast("long").alias("pack_id"), F.col("__offset").cast("long").alias("start"))
    none = F.lit(None).cast("long")
    return rows.union(cut.filter("tokens = 0").select("doc_id", "segment", "tokens", none.alias("pack_id"), none.alias("start")))
