"""Best-fit-decreasing bin packing over a histogram of sizes.

Items of one size are alike, so a run of them is placed at once: the cost follows the number of distinct
sizes, which the capacity bounds, and not the number of items.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Run(NamedTuple):
    """Items of `size` ranked lo <= rank < hi go to bin + (rank - lo) // per_bin, at offset + (rank - lo) % per_bin * size."""

    size: int
    lo: int
    hi: int
    bin: int
    per_bin: int
    offset: int


class CapacityTree:
    """A balanced binary tree whose leaves are remaining capacities; finds the least that fits in O(log capacity)."""

    def __init__(self, capacity: int):
        self.width = 1
        while self.width < capacity + 1:
            self.width *= 2
        self.full = bytearray(2 * self.width)
        self.bins: dict[int, list[tuple[int, int]]] = {}

    def push(self, remaining: int, bin_: int, n: int) -> None:
        self.bins.setdefault(remaining, []).append((bin_, n))
        i = self.width + remaining
        while i and not self.full[i]:
            self.full[i] = 1
            i //= 2

    def pop(self, remaining: int) -> tuple[int, int]:
        run = self.bins[remaining].pop()
        if not self.bins[remaining]:
            del self.bins[remaining]
            i = self.width + remaining
            self.full[i] = 0
            i //= 2
            while i and not (self.full[2 * i] or self.full[2 * i + 1]):
                self.full[i] = 0
                i //= 2
        return run

    def tightest(self, size: int) -> int | None:
        i = self.width + size
        if size >= self.width:
            return None
        if self.full[i]:
            return size
        while i > 1:
            if not i % 2 and self.full[i + 1]:
                i += 1
                break
            i //= 2
        else:
            return None
        while i < self.width:
            i = 2 * i if self.full[2 * i] else 2 * i + 1
        return i - self.width


def best_fit(counts: dict[int, int], capacity: int, first_bin: int = 0, done: dict[int, int] | None = None, open_bins: list[tuple[int, int, int]] | None = None) -> tuple[list[Run], int]:
    """Runs that place counts[size] items of every size > 0, and the next free bin.

    open_bins: (remaining capacity, first bin, number of bins) of bins that are filled from their beginning up to that.

    Sizes go in decreasing order, each item to the bin with the least remaining capacity that holds it.
    An item above the capacity has a bin of its own. done[size]: items already placed, whose ranks come first.
    """
    tree, runs, next_bin = CapacityTree(capacity), [], first_bin
    for room, bin_, n in open_bins or ():
        tree.push(room, bin_, n)
    for size in sorted((s for s, n in counts.items() if n > 0), reverse=True):
        left, rank = counts[size], (done or {}).get(size, 0)
        if size > capacity:
            runs.append(Run(size, rank, rank + left, next_bin, 1, 0))
            next_bin += left
            continue
        while left:
            room = tree.tightest(size)
            if room is None:
                room, n = capacity, -(-left // (capacity // size))
                bin_, next_bin = next_bin, next_bin + n
            else:
                bin_, n = tree.pop(room)
            each = room // size
            full = min(n, left // each)
            if full:
                runs.append(Run(size, rank, rank + full * each, bin_, each, capacity - room))
                tree.push(room - each * size, bin_, full)
                rank, left = rank + full * each, left - full * each
            bin_, n = bin_ + full, n - full
            if n and left:
                runs.append(Run(size, rank, rank + left, bin_, left, capacity - room))
                tree.push(room - left * size, bin_, 1)
                rank, left, bin_, n = rank + left, 0, bin_ + 1, n - 1
            if n:
                tree.push(room, bin_, n)
    return runs, next_bin


def placed(spark: SparkSession, rows: DataFrame, size: str, runs: list[Run], most_broadcast: int = 1_000_000) -> DataFrame:
    """rows (with __rank within `size`) joined to their runs: adds __bin and __offset.

    The runs follow the number of distinct sizes, not the rows; they are broadcast up to `most_broadcast` of
    them (40 bytes each) and shuffled by size beyond it.
    """
    found = spark.createDataFrame(
        [tuple(map(int, r)) for r in runs], "__size long, __lo long, __hi long, __first long, __each long, __off long"
    )
    if len(runs) <= most_broadcast:
        found = F.broadcast(found)
    fits = (F.col(size) == F.col("__size")) & (F.col("__rank") >= F.col("__lo")) & (F.col("__rank") < F.col("__hi"))
    since = F.col("__rank") - F.col("__lo")
    return (
        rows.join(found, fits)
        .withColumn("__bin", F.col("__first") + F.floor(since / F.col("__each")))
        .withColumn("__offset", F.col("__off") + since % F.col("__each") * F.col("__size"))
        .drop("__size", "__lo", "__hi", "__first", "__each", "__off", "__rank")
    )
