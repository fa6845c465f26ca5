"""Exact dedup through a minimal perfect hash of the digests already seen."""

from __future__ import annotations

import io
import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, LongType, StructField, StructType

from . import lookup
from .common import id_key, keep_rows, materialise, table
from .textvec import mix

U = np.uint64
PER_SHARD = 250_000
LOAD = 1.5


class PerfectHash:
    """Levels of bits: a key sits at the first level where no other key left takes its bit; its slot is that bit's rank."""

    def __init__(self, bits: list[np.ndarray], sizes: np.ndarray, digests: np.ndarray, winners: np.ndarray):
        self.bits, self.sizes, self.digests, self.winners = bits, sizes, digests, winners
        self.ranks, seen = [], 0
        for level in bits:
            ones = np.bitwise_count(level).astype(np.int64)
            self.ranks.append(seen + np.cumsum(ones) - ones)
            seen += int(ones.sum())

    @staticmethod
    def places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (mix(keys[:, 0] ^ mix(keys[:, 1] + U(level + 1))) % U(size)).astype(np.int64)

    @classmethod
    def build(cls, digests: np.ndarray, winners: np.ndarray) -> PerfectHash:
        """digests: n different rows of two uint64."""
        bits, sizes, left = [], [], digests
        while len(left):
            if len(bits) > 200:
                raise ValueError("the digests aren't distinct")
            size = 64 * math.ceil(max(64, LOAD * len(left)) / 64)
            at = cls.places(left, len(bits), size)
            alone = np.bincount(at, minlength=size) == 1
            bits.append(np.packbits(alone, bitorder="little").view(U))
            sizes.append(size)
            left = left[~alone[at]]
        found = cls(bits, np.array(sizes, np.int64), digests, winners)
        slots = found.slots(digests)
        order = np.argsort(slots)
        assert np.array_equal(slots[order], np.arange(len(digests)))
        found.digests, found.winners = digests[order], winners[order]
        return found

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Each key's slot; -1 or any slot for a key that isn't in the table."""
        slot, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.bits, self.ranks)):
            at = self.places(keys[left], level, int(self.sizes[level]))
            word, bit = at >> 6, (at & 63).astype(U)
            hit = (bits[word] >> bit & U(1)).astype(bool)
            below = np.bitwise_count(bits[word[hit]] & ((U(1) << bit[hit]) - U(1))).astype(np.int64)
            slot[left[hit]] = ranks[word[hit]] + below
            left = left[~hit]
            if not len(left):
                break
        return slot

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(is a member, its winner). The slot's whole digest is compared."""
        member, winner = np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        if len(self.digests) and len(keys):
            slot = self.slots(keys)
            at = np.flatnonzero(slot >= 0)
            same = (self.digests[slot[at]] == keys[at]).all(axis=1)
            member[at[same]] = True
            winner[at[same]] = self.winners[slot[at[same]]]
        return member, winner

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, sizes=self.sizes, digests=self.digests, winners=self.winners, **{f"b{i}": b for i, b in enumerate(self.bits)})
        return out.getvalue()

    @classmethod
    def load(cls, blob: bytes) -> PerfectHash:
        x = np.load(io.BytesIO(blob))
        return cls([x[f"b{i}"] for i in range(len(x["sizes"]))], x["sizes"], x["digests"], x["winners"])


@lru_cache(maxsize=256)
def load(blob: bytes) -> PerfectHash:
    return PerfectHash.load(blob)


def keys_of(column: pa.Array) -> np.ndarray:
    """16-byte digests as rows of two uint64."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.frombuffer(b"".join(column.to_pylist()), U).reshape(-1, 2)


def digest(column: str = "text"):
    """16 bytes of the text; one value for null, another for the empty text."""
    return F.unhex(F.coalesce(F.md5(column), F.lit("0" * 32)))


def shard_of(n: int):
    return F.pmod(F.conv(F.hex(F.substring("__digest", 1, 4)), 16, 10).cast("long"), F.lit(n)).cast("long")


def history_index(history: DataFrame, per_shard: int = PER_SHARD) -> tuple[DataFrame, int]:
    """(__shard, __blob) and the number of shards, for history (__digest, __id): the least id wins."""
    distinct = materialise(history.groupBy("__digest").agg(F.min("__id").alias("__id")))
    shards = max(1, math.ceil(distinct.count() / per_shard))

    def build(group: pa.Table) -> pa.Table:
        made = PerfectHash.build(keys_of(group["__digest"]), group["__id"].to_numpy())
        return pa.table({"__shard": group["__shard"].slice(0, 1), "__blob": pa.array([made.dump()], pa.binary())})

    index = distinct.withColumn("__shard", shard_of(shards)).groupBy("__shard")
    return materialise(index.applyInArrow(build, "__shard long, __blob binary")), shards


def winners(rows: DataFrame, history: DataFrame, per_shard: int = PER_SHARD, most_broadcast: int = lookup.BROADCAST_BYTES) -> DataFrame:
    """(__digest, __id) of one row for every distinct digest of rows (__digest, __id).

    A digest of the history is won by the history's winner if rows hold it; others group separately, least id first.
    """
    index, shards = history_index(history, per_shard)

    def answer(blob: bytes | None, batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, ids = keys_of(batch.column("__digest")), batch.column("__id").to_numpy(zero_copy_only=False)
        member, winner = load(blob).find(keys) if blob else (np.zeros(len(ids), bool), ids)
        stays = ~member | (winner == ids)
        return pa.RecordBatch.from_pydict(
            {"__digest": batch.column("__digest").filter(pa.array(stays)), "__id": pa.array(ids[stays]), "__member": pa.array(member[stays])}
        )

    schema = StructType([StructField("__digest", BinaryType()), StructField("__id", LongType()), StructField("__member", BooleanType())])
    found = lookup.sharded(rows.select(shard_of(shards).alias("__shard"), "__digest", "__id"), index, answer, schema, most_broadcast)
    return found.groupBy("__digest").agg(F.min("__id").alias("__id"))


def digests(docs: DataFrame) -> DataFrame:
    return materialise(docs.select(digest().alias("__digest"), id_key().alias("__id")))


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The history of a corpus whose labelled documents were accepted before."""
    known = labels.select(id_key().alias("__id")).distinct()
    return rows.join(known, "__id", "left_semi").select("__digest", "__id")


def exact_dedup(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id): one document for every distinct text.

    The labelled documents are the history: their distinct digests have a minimal perfect hash, in shards, whose
    slots hold the whole digest and the winner's id (the least labelled one). A document whose digest is in the
    history stays only as its winner. The others are grouped by digest and the least id stays.

    Null texts are alike, as are empty ones, and the two differ. Of repeated rows one stays. A null doc_id
    comes before all others and stays null. Other columns don't matter. Without labels all is grouped.
    """
    rows = digests(docs)
    kept = winners(rows, labelled(rows, labels))
    return kept.select(F.nullif("__id", F.lit(-(2**63))).alias("doc_id"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of docs that exact_dedup keeps, with all of their columns.

    Null texts are alike, as are empty ones. Of rows with the same id and text the least in all columns stays (see
    keep_rows); among ids the history's winner, else the least, null first. An empty table gives no rows; no column's
    name can clash.
    """
    rows = digests(docs)
    kept = materialise(winners(rows, labelled(rows, table(spark, sf_dir, "labels"))).withColumn("__mark", F.col("__digest")))
    again = rows.groupBy("__digest", "__id").count().filter("count > 1").limit(1).count() > 0
    return keep_rows(docs, kept, digest(), again)
