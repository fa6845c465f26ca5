"""Embedding near-dedup: a pigeonhole join over blocks of rotated vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, forest, id_key, materialise
from .textvec import few

COSINE, BLOCK, LEAF = 0.95, 8, 256
LEAST_CHUNK, MOST_CHUNK = 2048, 65_536
SLACK, VERIFY = 1e-5, 1e-6
EDGE = "a long, b long"


def unit_rows(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors (float64) and which rows have one: dim finite numbers, not all zero."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.array([len(v) if v is not None else -1 for v in column.to_pylist()]) if column.null_count else np.diff(column.offsets.to_numpy())
    ok = lengths == dim
    flat = column.filter(pa.array(ok)).flatten().cast(pa.float64())
    x = np.where(flat.is_valid().to_numpy(zero_copy_only=False), flat.fill_null(0).to_numpy(zero_copy_only=False), np.nan).reshape(-1, dim)
    norm = np.linalg.norm(x, axis=1)
    good = np.isfinite(norm) & (norm > 0)
    ok[np.flatnonzero(ok)[~good]] = False
    return x[good] / norm[good, None], ok


def rotation(vectors: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """The principal axes of all vectors, by decreasing variance, and the variances."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + dim + dim * dim)
        for batch in batches:
            x, _ = unit_rows(batch.column("embedding"), dim)
            total += np.concatenate([[len(x)], x.sum(axis=0), (x.T @ x).ravel()])
        yield pa.RecordBatch.from_pydict({"m": pa.array([total.tolist()], pa.list_(pa.float64()))})

    sums = vectors.select("embedding").mapInArrow(part, "m array<double>").select(F.posexplode("m").alias("at", "v"))
    got = {r[0]: r[1] for r in sums.groupBy("at").agg(F.sum("v")).collect()}  # 1 + dim + dim**2 numbers
    total = np.array([got.get(i, 0.0) for i in range(1 + dim + dim * dim)])
    n, mean = max(total[0], 1), total[1 : 1 + dim] / max(total[0], 1)
    values, axes = np.linalg.eigh(total[1 + dim :].reshape(dim, dim) / n - np.outer(mean, mean))
    return axes[:, ::-1], np.maximum(values[::-1], 0)


def boxes(y: np.ndarray, leaf: int) -> list[np.ndarray]:
    """Rows of y in boxes of up to `leaf`: halved along the widest side again and again."""
    out, todo = [], [np.arange(len(y))]
    while todo:
        at = todo.pop()
        if len(at) <= leaf:
            out.append(at)
            continue
        side = int(np.argmax(y[at].max(axis=0) - y[at].min(axis=0)))
        half = len(at) // 2
        at = at[np.argpartition(y[at, side], half)]
        todo += [at[:half], at[half:]]
    return out


def near(xa: np.ndarray, xb: np.ndarray, lo: int, hi: int, budget: float, cosine: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows whose block lo:hi is within `budget` (squared) and whose whole vectors are within `cosine`.

    The squared distances of two boxes' rows are one matrix product, |a|^2 + |b|^2 - 2ab, in single precision; SLACK
    is above its error, and what passes is checked on whole vectors in double precision.
    """
    ya, yb = xa[:, lo:hi], xb[:, lo:hi]
    box_a = boxes(ya, LEAF)
    box_b = box_a if same else boxes(yb, LEAF)
    one = np.ones((len(xa), 1), np.float32)
    left = np.concatenate([-2 * ya, (ya**2).sum(axis=1, keepdims=True), one], axis=1)
    right = np.concatenate([yb, np.ones((len(xb), 1), np.float32), (yb**2).sum(axis=1, keepdims=True)], axis=1)
    sorted_b = np.concatenate(box_b)
    right, edges = np.ascontiguousarray(right[sorted_b].T), np.concatenate([[0], np.cumsum([len(x) for x in box_b])])
    low = np.array([yb[x].min(axis=0) for x in box_b])
    high = np.array([yb[x].max(axis=0) for x in box_b])
    for k, at in enumerate(box_a):
        mine = ya[at]
        gap = np.maximum(0, np.maximum(low - mine.max(axis=0), mine.min(axis=0) - high))
        ok = (gap**2).sum(axis=1) <= budget
        if same:
            ok[:k] = False
        run = np.flatnonzero(np.diff(np.concatenate([[0], ok, [0]])))  # neighbouring boxes go together
        for p, q in zip(run[::2], run[1::2]):
            for s in range(edges[p], edges[q], 4096):
                e = min(s + 4096, edges[q])
                found = few((left[at] @ right[:, s:e] <= budget).ravel())
                i, j = at[found // (e - s)], sorted_b[s + found % (e - s)]
                if same:
                    i, j = i[i != j], j[i != j]
                for t in range(0, len(i), 1 << 16):
                    x, y = i[t : t + (1 << 16)], j[t : t + (1 << 16)]
                    fits = np.einsum("nd,nd->n", xa[x].astype(np.float64), xb[y].astype(np.float64)) >= cosine - VERIFY
                    if fits.any():
                        yield x[fits], y[fits]


def vector_dedup(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK, chunk: int | None = None) -> DataFrame:
    """(vec_id, group_size): one vector of each group of near copies, the one with the least vec_id.

    Vectors with a cosine of at least `cosine` are near; groups are the connected components. Unit vectors are
    rotated to their principal axes and split into blocks of `block` axes. The squared distance that the cosine
    allows is divided over the blocks in proportion to their variance, so a near pair keeps to the budget of at
    least one block: the union of the blocks' range joins holds every near pair, and each found pair is
    checked on whole vectors. No pair is missed.

    Vectors are sorted by their first axes and cut into chunks; two chunks meet, in one task for all blocks, unless
    their boxes are too far apart in every block. Within a task smaller boxes are left out in the same way. A vector is
    sent once for every chunk that its own meets. Equal vectors are joined beforehand by grouping, and a task returns
    a forest, not all pairs of a group.

    A null vector, one of another length than most, one with a null or not finite number, and a zero vector have no
    direction: each stays, alone. Rows of the same vec_id, null included, count as one vector if they are equal or near,
    else as several. Other columns don't matter. An empty table gives no rows.
    """
    rows = vectors.select(id_key("vec_id").alias("__id"), F.col("embedding").cast("array<float>").alias("embedding"))
    sizes = rows.filter("size(embedding) > 0").groupBy(F.size("embedding").alias("d")).count()
    common = sizes.orderBy(F.desc("count"), "d").first()
    dim = common[0] if common else 1
    axes, variances = rotation(rows, dim)
    blocks = [(i, min(i + block, dim)) for i in range(0, dim, block)]
    weight = np.array([variances[i:j].sum() for i, j in blocks]) + 1e-9
    budgets = (2 - 2 * cosine) * weight / weight.sum() + SLACK

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, ok = unit_rows(batch.column("embedding"), dim)
            y = np.zeros((len(ok), dim), np.float32)
            y[ok] = x @ axes
            raw = pa.array([v.tobytes() if k else None for v, k in zip(y, ok)], pa.binary())
            yield pa.RecordBatch.from_pydict({"__id": batch.column("__id"), "v": raw})

    turned = rows.mapInArrow(turn, "__id long, v binary")
    turned = materialise(turned.groupBy("v", F.when(F.col("v").isNull(), F.col("__id")).alias("__own")).agg(F.min("__id").alias("__id"), F.count(F.lit(1)).alias("__n")).drop("__own"))
    points = materialise(turned.filter("v is not null").withColumn("idx", F.monotonically_increasing_id()))
    n = points.count()
    chunk = chunk or min(MOST_CHUNK, max(LEAST_CHUNK, n // 12))
    each = max(1, math.ceil(n / chunk))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column("v").to_pylist()), np.float32).reshape(-1, dim)
            yield pa.RecordBatch.from_pydict({"y": pa.array(x[:, 0]), "idx": batch.column("idx"), "v": batch.column("v")})

    ordered = points.select("idx", "v").mapInArrow(keyed, "y float, idx long, v binary").repartitionByRange(each, "y", "idx").sortWithinPartitions("y", "idx")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(ids: list, vs: list) -> pa.RecordBatch:
            ids, raw = np.concatenate(ids), b"".join(vs)
            x = np.frombuffer(raw, np.float32).reshape(-1, dim).astype(np.float64)
            low, high = (pa.array([v.tolist()], pa.list_(pa.float64())) for v in (x.min(axis=0), x.max(axis=0)))
            return pa.RecordBatch.from_pydict({"key": pa.array([int(ids[0])], pa.int64()), "low": low, "high": high, "ids": pa.array([ids.tobytes()], pa.binary()), "x": pa.array([raw], pa.binary())})

        ids, vs, held = [], [], 0
        for batch in batches:
            for i in range(0, batch.num_rows, chunk):
                part = batch.slice(i, chunk)
                if ids and held + part.num_rows > chunk:
                    yield made(ids, vs)
                    ids, vs, held = [], [], 0
                ids.append(part.column("idx").to_numpy())
                vs.append(b"".join(part.column("v").to_pylist()))
                held += part.num_rows
        if ids:
            yield made(ids, vs)

    chunks = materialise(ordered.mapInArrow(cut, "key long, low array<double>, high array<double>, ids binary, x binary"))
    sides = F.array(*[F.struct(F.lit(k).alias("block"), F.slice("low", i + 1, j - i).alias("low"), F.slice("high", i + 1, j - i).alias("high")) for k, (i, j) in enumerate(blocks)])
    light = chunks.select("key", F.explode(sides).alias("__s")).select("key", "__s.*")
    other = light.select(*[F.col(c).alias(f"{c}2") for c in light.columns])
    gap = F.expr("aggregate(zip_with(zip_with(low, high2, (a, b) -> a - b), zip_with(low2, high, (a, b) -> a - b), (a, b) -> pow(greatest(a, b, 0D), 2)), 0D, (s, g) -> s + g)")
    allowed = F.element_at(F.array(*[F.lit(float(b)) for b in budgets]), F.col("block") + 1)
    pairs = light.join(other, (F.col("block") == F.col("block2")) & (F.col("key") <= F.col("key2")) & (gap <= allowed)).select("key", "key2").distinct()
    own = chunks.select("key", "ids", "x")
    theirs = chunks.select(F.col("key").alias("key2"), F.col("ids").alias("ids2"), F.col("x").alias("x2"))
    tasks = pairs.join(own, "key").join(theirs, "key2").repartition(max(1, each * (each + 1) // 2), "key", "key2")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                r = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                xa, xb = (np.frombuffer(r[c], np.float32).reshape(-1, dim) for c in ("x", "x2"))
                ia, ib = (np.frombuffer(r[c], np.int64) for c in ("ids", "ids2"))
                a, b, waiting = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
                for (lo, hi), most in zip(blocks, budgets):
                    for i, j in near(xa, xb, lo, hi, most, cosine, r["key"] == r["key2"]):
                        a.append(ia[i])
                        b.append(ib[j])
                        waiting += len(i)
                        if waiting > 1 << 20:
                            node, root = forest(np.concatenate(a), np.concatenate(b))
                            a, b, waiting = [node], [root], 0
                node, root = forest(np.concatenate(a), np.concatenate(b))
                yield pa.RecordBatch.from_pydict({"a": node, "b": root})

    linked = components(tasks.mapInArrow(search, EDGE))
    groups = points.join(linked, F.col("idx") == F.col("node"), "left").groupBy(F.coalesce("root", "idx").alias("__root"))
    best = groups.agg(F.min("__id").alias("__id"), F.sum("__n").alias("group_size")).select("__id", "group_size")
    alone = turned.filter("v is null").select("__id", F.col("__n").alias("group_size"))
    return best.union(alone).select(F.nullif("__id", F.lit(-(2**63))).alias("vec_id"), "group_size")
