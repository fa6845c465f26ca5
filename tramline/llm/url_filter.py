"""URL filter: a cascade of Bloom filters that is exact over every key of the corpus."""

from __future__ import annotations

import io
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from . import lookup
from .common import materialise
from .lookup import BROADCAST_BYTES
from .textvec import mix

U = np.uint64
LISTED = (
    "adult-x.example.com",
    "ads-track.example.com",
    "spam-farm.example.org",
    "cheap-pills.example.net",
    "casino-win.example.net",
    "free-bets.example.net",
)
PER_SHARD = 500_000


class Cascade:
    """Level 1 holds the listed keys, each further level the keys of the other kind that the one before lets pass."""

    def __init__(self, levels: list[tuple[np.ndarray, int, int]]):
        self.levels = levels

    @staticmethod
    def places(keys: np.ndarray, level: int, probes: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            a, b = mix(keys[:, 0] + U(level)), mix(keys[:, 1] ^ U(level)) | U(1)
            return (mix(a[:, None] + b[:, None] * np.arange(1, probes + 1, dtype=U)) % U(size)).astype(np.int64)

    @classmethod
    def passes(cls, keys: np.ndarray, level: int, filter_: tuple[np.ndarray, int, int]) -> np.ndarray:
        bits, probes, size = filter_
        at = cls.places(keys, level, probes, size)
        return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).all(axis=1)

    @classmethod
    def build(cls, listed: np.ndarray, other: np.ndarray) -> Cascade:
        """Keys: rows of two uint64, all different."""
        levels, inside, outside = [], listed, other
        while len(inside):
            if len(levels) > 120:
                raise ValueError("a key is both listed and not")
            rate = min(0.5, math.sqrt(0.5) * len(inside) / max(1, len(outside))) if not levels else 0.5
            probes = max(1, round(-math.log2(rate)))
            size = 8 * math.ceil(max(64, 1.4427 * probes * len(inside)) / 8)
            bits = np.zeros(size, bool)
            bits[cls.places(inside, len(levels), probes, size).ravel()] = True
            made = (np.packbits(bits, bitorder="little"), probes, size)
            wrong = outside[cls.passes(outside, len(levels), made)] if len(outside) else outside
            levels.append(made)
            inside, outside = wrong, inside
        return cls(levels)

    def listed(self, keys: np.ndarray) -> np.ndarray:
        """Whether each key is listed; exact for the keys that it was built over."""
        yes, left = np.zeros(len(keys), bool), np.arange(len(keys))
        for level, made in enumerate(self.levels):
            hit = self.passes(keys[left], level, made) if len(left) else np.zeros(0, bool)
            yes[left[~hit]] = level % 2 == 1
            left = left[hit]
        yes[left] = len(self.levels) % 2 == 1
        return yes

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, shape=np.array([x[1:] for x in self.levels], np.int64).reshape(-1, 2), **{f"b{i}": x[0] for i, x in enumerate(self.levels)})
        return out.getvalue()

    @classmethod
    def load(cls, blob: bytes) -> Cascade:
        x = np.load(io.BytesIO(blob))
        return cls([(x[f"b{i}"], int(p), int(s)) for i, (p, s) in enumerate(x["shape"])])


@lru_cache(maxsize=256)
def load(blob: bytes) -> Cascade:
    return Cascade.load(blob)


def with_keys(pages: DataFrame) -> DataFrame:
    """(page_id, url, __h): hashes of a URL's distinct keys: host and path, the host and its parents of two labels or more."""
    low = F.lower(F.coalesce("url", F.lit("")))
    bare = F.regexp_replace(F.regexp_replace(low, r"^[a-z][a-z0-9+.-]*://", ""), r"[?#].*$", "")
    rows = pages.select("page_id", "url", F.regexp_replace(F.regexp_replace(bare, r"^[^/@]*@", ""), r"/+$", "").alias("__rest"))
    host = F.regexp_replace(F.regexp_replace(F.split("__rest", "/")[0], r":[0-9]*$", ""), r"\.+$", "")
    rows = rows.withColumn("__labels", F.split(host, r"\."))
    size = F.size("__labels")
    cut = F.sequence(F.lit(1), F.greatest(F.lit(1), size - 1))
    suffix = lambda i: F.array_join(F.slice("__labels", i, size), ".")
    # hashed one by one: the suffixes of a host of very many labels would not fit in memory together
    parents = F.flatten(F.transform(cut, lambda i: F.when(F.length(suffix(i)) > 0, bits(suffix(i))).otherwise(F.array().cast("array<bigint>"))))
    rest = F.when((F.length("__rest") > 0) & (F.col("__rest") != suffix(F.lit(1))), bits(F.col("__rest"))).otherwise(F.array().cast("array<bigint>"))
    return rows.select("page_id", "url", F.concat(rest, parents).alias("__h"))


def bits(key: Column) -> Column:
    """A key's 128 bits, as two longs."""
    return F.array(F.xxhash64(key), F.xxhash64(key, F.lit(1)))


def hashed(keys: Column) -> Column:
    """Each key's 128 bits, as a flat array of longs."""
    return F.flatten(F.transform(keys, bits))


def pairs(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two uint64, and the row of each."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(U).reshape(-1, 2)
    sizes = np.diff(column.offsets.to_numpy()) // 2
    return flat, np.repeat(np.arange(len(column)), sizes)


def cascade_index(keys: DataFrame, listed: DataFrame, per_shard: int = PER_SHARD) -> tuple[DataFrame, int]:
    """(__shard, __blob) and the number of shards. keys: (__h) all of the corpus; listed: (__key)."""
    of = lambda rows, flag: rows.select(F.posexplode("__h").alias("__at", "__v"), "__h").filter("__at % 2 = 0").select(
        F.col("__v").alias("__a"), F.expr("__h[__at + 1]").alias("__b"), F.lit(flag).alias("__listed")
    )
    marked = listed.select(hashed(F.array(F.lower("__key"))).alias("__h")).filter("__h is not null")
    universe = of(keys, 0).union(of(marked, 1)).groupBy("__a", "__b").agg(F.max("__listed").alias("__listed"))
    universe = materialise(universe)
    shards = max(1, math.ceil(universe.count() / per_shard))

    def build(group: pa.Table) -> pa.Table:
        k = np.stack([group["__a"].to_numpy(), group["__b"].to_numpy()], axis=1).view(U)
        is_listed = group["__listed"].to_numpy() == 1
        made = Cascade.build(k[is_listed], k[~is_listed])
        return pa.table({"__shard": group["__shard"].slice(0, 1), "__blob": pa.array([made.dump()], pa.binary())})

    grouped = universe.withColumn("__shard", F.pmod("__a", F.lit(shards)).cast("long")).groupBy("__shard")
    return materialise(grouped.applyInArrow(build, "__shard long, __blob binary")), shards


def url_filter(pages: DataFrame, listed: DataFrame | None = None, per_shard: int = PER_SHARD, most_broadcast: int = BROADCAST_BYTES) -> DataFrame:
    """(page_id, url, listed): whether a key of the page's URL is on the list `listed` (__key: hosts, parents or host/path).

    The cascade is built over all distinct keys of the corpus and the list, in shards by hash, and is therefore
    exact for every page; pages are never joined or shuffled while its size, which is checked, is at most
    most_broadcast bytes. Beyond it each shard's cascade meets that shard's keys in tasks, and what they find is added
    up by row; a hot key's shard is dealt to several tasks.

    A null or blank URL has no key and isn't listed. Every row, repeated or with a null page_id, is
    returned. Keys are lower case, without scheme, user, port, query, fragment and trailing slashes. Other columns
    don't matter. Without pages there are no rows; with an empty list nothing is listed.
    """
    spark = pages.sparkSession
    if listed is None:
        listed = spark.createDataFrame([(k,) for k in LISTED], "__key string")
    rows = materialise(with_keys(pages).withColumn("__uid", F.monotonically_increasing_id()))
    index, shards = cascade_index(rows.select("__h"), listed, per_shard)
    if (index.agg(F.sum(F.octet_length("__blob"))).first()[0] or 0) <= most_broadcast:
        shared = spark.sparkContext.broadcast({r[0]: bytes(r[1]) for r in index.collect()})

        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys, row = pairs(batch.column("__h"))
                shard, yes = (keys[:, 0].view(np.int64) % shards), np.zeros(batch.num_rows, bool)
                for s in np.unique(shard):
                    at = shard == s
                    yes[row[at][load(shared.value[int(s)]).listed(keys[at])]] = True
                yield pa.RecordBatch.from_pydict({"page_id": batch.column("page_id"), "url": batch.column("url"), "listed": pa.array(yes)})

        return rows.drop("__uid").mapInArrow(near, "page_id long, url string, listed boolean")

    def answer(blob: bytes | None, batch: pa.RecordBatch) -> pa.RecordBatch:
        k = np.stack([batch.column("__a").to_numpy(), batch.column("__b").to_numpy()], axis=1).view(U)
        yes = load(blob).listed(k) if blob and len(k) else np.zeros(len(k), bool)
        return batch.select(["__uid"]).filter(pa.array(yes))

    keys = rows.select("__uid", F.posexplode("__h").alias("__at", "__a"), "__h").filter("__at % 2 = 0")
    keys = keys.select(F.pmod("__a", F.lit(shards)).cast("long").alias("__shard"), "__uid", "__a", F.expr("__h[__at + 1]").alias("__b"))
    hits = lookup.sharded(keys, index, answer, StructType([StructField("__uid", LongType())]), -1)
    both = rows.select("__uid", "page_id", "url", F.lit(False).alias("listed")).union(hits.select("__uid", F.lit(None).cast("long"), F.lit(None).cast("string"), F.lit(True)))
    return both.groupBy("__uid").agg(F.max("page_id").alias("page_id"), F.max("url").alias("url"), F.max("listed").alias("listed")).drop("__uid")
