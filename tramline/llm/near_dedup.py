"""SimHash near-dedup with a hierarchical index over fingerprints in Gray order."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, forest, id_key, keep_rows, materialise
from .textvec import WINDOW_MULT, WORD_GAP, U, buffers, counted, fold, mix, pieces, powers, words

DISTANCE = 24
MIN_WORDS = 5
CHUNK = 131_072
NODE, PARTS = 32, 8
STEP = 8192
BLOCK = 1 << 17
SECOND = U(0xA0761D6478BD642F)
EDGE = "a long, b long"


def votes_of(bits: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Sum over rows of weight times bits, for any weights; bits is overwritten."""
    small = np.minimum(weight, 255)
    heavy = np.flatnonzero(weight > 255)
    extra = (bits[heavy].astype(np.int64) * (weight[heavy] - 255)[:, None]).sum(axis=0)
    bits *= small.astype(np.uint8)[:, None]
    return bits.sum(axis=0, dtype=np.int64) + extra


def fingerprints(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of every text, as rows of two uint64, and its number of words.

    A distinct word votes on each bit with a weight of twice its length times the root of its count.
    A text of fewer than MIN_WORDS distinct words has a hash of its words in their order instead.
    """
    data, offsets = buffers(texts)
    out, n = np.zeros((len(offsets) - 1, 2), U), np.zeros(len(offsets) - 1, np.int64)
    for i, j in pieces(offsets):
        hashes, start, end, first = words(fold(data[offsets[i] : offsets[j]]), offsets[i : j + 1] - offsets[i], WORD_GAP, True)
        n[i:j] = np.diff(first)
        at, count, edges = counted(hashes, first)
        weight = (2 * (end - start)[at] * np.sqrt(count)).astype(np.int64)
        keys = hashes[at]

        def bits_of(lo: int, hi: int) -> np.ndarray:
            both = np.stack([keys[lo:hi], mix(keys[lo:hi] ^ SECOND)], axis=1)
            return np.unpackbits(both.view(np.uint8), axis=1)

        text = 0
        while text < j - i:  # as many texts at once as the cache holds
            stop = max(text + 1, int(np.searchsorted(edges, edges[text] + STEP, "right")) - 1)
            lo, hi = int(edges[text]), int(edges[stop])
            if hi > lo + STEP or (weight[lo:hi] > 255).any():
                for t in range(text, stop):
                    total = [votes_of(bits_of(x, min(x + STEP, edges[t + 1])), weight[x : min(x + STEP, edges[t + 1])]) for x in range(edges[t], edges[t + 1], STEP)]
                    if total:
                        out[i + t] = np.packbits(2 * np.sum(total, axis=0) > weight[edges[t] : edges[t + 1]].sum()).view(U)
            elif hi > lo:
                bits = bits_of(lo, hi)
                bits *= weight[lo:hi, None].astype(np.uint8)
                some = np.flatnonzero(np.diff(edges[text : stop + 1])) + text
                votes = np.add.reduceat(bits, edges[some] - lo, axis=0, dtype=np.int64)
                total = np.add.reduceat(weight[lo:hi], edges[some] - lo)
                out[i + some] = np.packbits(2 * votes > total[:, None], axis=1).view(U)
            text = stop
        for t in np.flatnonzero(np.diff(edges) < MIN_WORDS):
            own = sequence_hash(hashes[first[t] : first[t + 1]])
            out[i + t] = mix(own)[0], mix(own ^ SECOND)[0]
    return out, n


def sequence_hash(hashes: np.ndarray) -> np.ndarray:
    """One hash of hashes in their order."""
    total, base = U(len(hashes)), U(1)
    up, _ = powers(WINDOW_MULT, STEP + 1)
    with np.errstate(over="ignore"):
        for lo in range(0, len(hashes), STEP):
            part = hashes[lo : lo + STEP]
            total = total + base * (part * up[: len(part)]).sum(dtype=U)
            base = base * up[STEP]
    return mix(np.array([total], U))


def rows_of(docs: DataFrame) -> DataFrame:
    """(__id, __mark, f0, f1): the text's hash and fingerprint; the latter null without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f, n = fingerprints(batch.column("text"))
            f = f.view(np.int64)
            yield pa.RecordBatch.from_pydict(
                {"__id": batch.column("__id"), "__mark": batch.column("__mark"), "f0": pa.array(f[:, 0], mask=n == 0), "f1": pa.array(f[:, 1], mask=n == 0)}
            )

    rows = docs.select(id_key().alias("__id"), F.xxhash64("text").alias("__mark"), "text")
    return rows.mapInArrow(run, "__id long, __mark long, f0 long, f1 long")


def part(f: np.ndarray, q: int) -> np.ndarray:
    return (f[:, q // 4] >> U(16 * (3 - q % 4)) & U(0xFFFF)).astype(np.uint16)


class Nodes:
    """The nodes over fingerprints in Gray order, in two levels: runs with the same leading bits of the part, and
    runs of those with the same fewer bits. Each node has the mask and the pattern of all bits that its members share."""

    def __init__(self, f: np.ndarray, q: int, depth: int):
        word = part(f, q)

        def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            return first, np.append(first[1:], len(keys))

        lead = word >> np.uint16(16 - depth)
        self.first, self.end = runs(lead)
        self.mask, self.pattern = self.shared(f, self.first)
        self.lead = lead[self.first]
        upper = self.lead >> np.uint16(depth - depth // 2)
        self.up_first, self.up_end = runs(upper)
        self.up_lead = upper[self.up_first]

    @staticmethod
    def shared(f: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        every, some = np.bitwise_and.reduceat(f, first, axis=0), np.bitwise_or.reduceat(f, first, axis=0)
        return ~(every ^ some), every


def near(fa: np.ndarray, fb: np.ndarray, q: int, depth: int, most: int, distance: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of fa and fb within `distance` that differ in at most `most` bits of part q.

    Differences add up down the tree: a pair of upper nodes is left out when its leading bits differ in more than
    `most` places, then a pair of their nodes when theirs do, or when the bits that either shares differ in more than `distance`.
    """
    a, b = Nodes(fa, q, depth), Nodes(fb, q, depth)
    wa, wb = part(fa, q), part(fb, q)
    (a0, a1), (b0, b1) = np.ascontiguousarray(fa.T), np.ascontiguousarray(fb.T)
    for up in range(len(a.up_first)):
        near_up = np.flatnonzero(np.bitwise_count(b.up_lead ^ a.up_lead[up]) <= most)
        if not len(near_up):
            continue
        under = ranges(b.up_first[near_up], b.up_end[near_up])
        for k in range(a.up_first[up], a.up_end[up]):
            hit = under[np.bitwise_count(b.lead[under] ^ a.lead[k]) <= most]
            if same:
                hit = hit[hit >= k]
            shared = np.bitwise_count((b.pattern[hit] ^ a.pattern[k]) & b.mask[hit] & a.mask[k]).sum(axis=1)
            hit = hit[shared <= distance]
            if not len(hit):
                continue
            there = ranges(b.first[hit], b.end[hit])
            words_there = wb[there]
            step = max(1, BLOCK // len(there))
            for lo in range(a.first[k], a.end[k], step):
                hi = min(lo + step, a.end[k])
                at = np.flatnonzero(np.bitwise_count(wa[lo:hi, None] ^ words_there) <= most)
                edge = np.searchsorted(at, np.arange(1, hi - lo + 1) * len(there))
                i = np.repeat(np.arange(lo, hi), np.diff(edge, prepend=0))
                j = there[at - (i - lo) * len(there)]
                far = np.bitwise_count(a0[i] ^ b0[j])
                keep = np.flatnonzero(far <= distance)
                i, j = i[keep], j[keep]
                keep = far[keep] + np.bitwise_count(a1[i] ^ b1[j]) <= distance
                if same:
                    keep &= i < j
                if keep.any():
                    yield i[keep], j[keep]


def ranges(first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one after the other."""
    size = end - first
    return np.repeat(first - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())


def depth_of(n: int) -> int:
    """Leading bits of a node, so that one holds about NODE fingerprints; it changes the work, not the result."""
    return min(16, max(2, math.ceil(math.log2(max(1, n) / NODE))))


def most_of(distance: int) -> list[int]:
    """Bits in which each part may differ: a pair within `distance` keeps to at least one of them.

    If it kept to none, it would differ in at least sum(m + 1) = distance + 1 bits.
    """
    return [(distance + PARTS - q) // PARTS - 1 for q in range(PARTS)]


def edges_of(prints: DataFrame, n: int, distance: int = DISTANCE, chunk: int | None = None) -> DataFrame:
    """(a, b) of idx: a forest whose components are those of all pairs within `distance`.

    prints: (idx, f0, f1), different fingerprints. Each of the eight parts of 16 bits gives an order: the
    fingerprints sorted by the Gray rank of that part and cut into chunks. A task gets two chunks whose shared leading
    bits don't differ too much, builds the nodes over each, and compares what isn't pruned.

    No pair is missed: of the parts at least one differs in no more bits than most_of allows, and only
    pairs of nodes that differ in more are left out. Chunks grow with n up to a million fingerprints, since each is sent once
    for every chunk that it meets.
    """
    depth = depth_of(n)
    chunk = chunk or min(1 << 20, max(CHUNK, n // 16))
    each = max(1, math.ceil(n / chunk))
    allowed = most_of(distance)
    orders = [
        F.struct(F.lit(q).cast("long").alias("q"), F.shiftrightunsigned(f"f{q // 4}", 16 * (3 - q % 4)).bitwiseAND(F.lit(0xFFFF)).alias("g"))
        for q in range(PARTS)
        if allowed[q] >= 0
    ]
    rows = prints.select("idx", "f0", "f1", F.explode(F.array(*orders)).alias("__p")).select("idx", "f0", "f1", "__p.q", F.col("__p.g").alias("g"))
    for shift in (1, 2, 4, 8):  # a Gray code's rank
        rows = rows.withColumn("g", F.col("g").bitwiseXOR(F.shiftrightunsigned("g", shift)))
    ordered = rows.repartitionByRange(PARTS * each, "q", "g", "f0", "f1").sortWithinPartitions("q", "g", "f0", "f1")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(q: int, parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            ids, f = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            lead = part(f, q)
            same = 16 - (int(np.bitwise_or.reduce(lead ^ lead[0]))).bit_length()
            return pa.RecordBatch.from_pydict(
                {"q": pa.array([q], pa.int64()), "key": pa.array([int(ids[0])], pa.int64()), "bits": pa.array([same], pa.int64()), "lead": pa.array([int(lead[0])], pa.int64()), "ids": pa.array([ids.tobytes()], pa.binary()), "f": pa.array([f.tobytes()], pa.binary())}
            )

        now, parts, held = None, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            qs, ids = batch.column("q").to_numpy(), batch.column("idx").to_numpy()
            f = np.stack([batch.column("f0").to_numpy(), batch.column("f1").to_numpy()], axis=1).view(U)
            cuts = [0, *(np.flatnonzero(qs[1:] != qs[:-1]) + 1), len(qs)]
            for i, j in zip(cuts, cuts[1:]):
                if parts and (qs[i] != now or held + j - i > 2 * chunk):
                    yield made(now, parts)
                    parts, held = [], 0
                now = int(qs[i])
                parts.append((ids[i:j], f[i:j]))
                held += j - i
        if parts:
            yield made(now, parts)

    chunks = materialise(ordered.mapInArrow(cut, "q long, key long, bits long, lead long, ids binary, f binary"))
    light = chunks.select("q", "key", "bits", "lead")
    other = light.select(*[F.col(c).alias(f"{c}2") for c in light.columns])
    differ = F.bit_count(F.expr("shiftrightunsigned(lead ^ lead2, cast(16 - least(bits, bits2) as int))"))
    most = F.element_at(F.array(*[F.lit(m) for m in allowed]), (F.col("q") + 1).cast("int"))
    pairs = light.join(other, (F.col("q") == F.col("q2")) & (F.col("key") <= F.col("key2")) & (differ <= most)).select("q", "key", "key2")
    own = chunks.select("q", "key", "ids", "f")
    theirs = chunks.select("q", F.col("key").alias("key2"), F.col("ids").alias("ids2"), F.col("f").alias("f2"))
    tasks = pairs.join(own, ["q", "key"]).join(theirs, ["q", "key2"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                x = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                fa, fb = (np.frombuffer(x[c], U).reshape(-1, 2) for c in ("f", "f2"))
                ia, ib = (np.frombuffer(x[c], np.int64) for c in ("ids", "ids2"))
                a, b, waiting = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
                for i, j in near(fa, fb, x["q"], depth, allowed[x["q"]], distance, x["key"] == x["key2"]):
                    a.append(ia[i])
                    b.append(ib[j])
                    waiting += len(i)
                    if waiting > 1 << 20:  # a forest stands for all of its pairs
                        node, root = forest(np.concatenate(a), np.concatenate(b))
                        a, b, waiting = [node], [root], 0
                node, root = forest(np.concatenate(a), np.concatenate(b))
                yield pa.RecordBatch.from_pydict({"a": node, "b": root})

    return tasks.repartition("q", "key", "key2").mapInArrow(search, EDGE)


def winners(rows: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(__id, __mark, group_size) of each group's row with the least id, then mark; rows without words are alone."""
    worded = rows.filter("f0 is not null")
    prints = worded.groupBy("f0", "f1").agg(F.min(F.struct("__id", "__mark")).alias("__first"), F.count(F.lit(1)).alias("__n"))
    prints = materialise(prints.withColumn("idx", F.monotonically_increasing_id()))
    linked = components(edges_of(prints, prints.count(), distance))
    groups = prints.join(linked, F.col("idx") == F.col("node"), "left").groupBy(F.coalesce("root", "idx").alias("__root"))
    best = groups.agg(F.min("__first").alias("__first"), F.sum("__n").alias("group_size")).select("__first.*", "group_size")
    alone = rows.filter("f0 is null").select("__id", "__mark", F.lit(1).cast("long").alias("group_size"))
    return best.union(alone)


def near_dedup(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, group_size): one document of each group of near copies.

    Documents whose 128-bit SimHash differs in at most `distance` bits are near copies; groups are the connected
    components, and no pair is missed. Words are runs of letters and digits, in lower case; each character of scripts
    without blanks (U+3000 and on) is one. The document with the least doc_id stays. A text of fewer than MIN_WORDS
    distinct words is near only to texts of the same words in the same order.

    A null, empty or wordless text is near to no other and stays. Equal texts, and so repeated rows, are in
    one group. A null doc_id comes first. Other columns don't matter. An empty table gives no rows.
    """
    kept = winners(materialise(rows_of(docs)), distance)
    return kept.select(F.nullif("__id", F.lit(-(2**63))).alias("doc_id"), "group_size")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of docs that near_dedup keeps, with all of their columns.

    Null, empty and wordless texts stay. Of rows with the same id and text the least in all columns stays (see
    keep_rows). Ties go to the least doc_id, null first. An empty table gives no rows; no column's name can clash.
    """
    rows = materialise(rows_of(docs))
    kept = materialise(winners(rows))
    again = rows.groupBy("__id", "__mark").count().filter("count > 1").limit(1).count() > 0
    return keep_rows(docs, kept, F.xxhash64("text"), again)
