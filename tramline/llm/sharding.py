"""Sharding: indivisible groups into the fewest shards of fixed capacity, best fit decreasing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .binfit import best_fit, placed
from .common import materialise, ranked

CAPACITY, UNIT = 16 << 20, 16


def shard(docs: DataFrame, capacity: int = CAPACITY, unit: int = UNIT) -> DataFrame:
    """(doc_id, group_bytes, shard_id): documents with the same text form a group that one shard holds whole.

    Groups enter by decreasing size the shard with the least remaining room that holds them, found in a
    balanced tree of remaining capacities. Sizes are bytes of UTF-8, rounded up to `unit`, so the driver sees a
    histogram of at most capacity / unit + 1 sizes and some runs of equal ones, however many groups there are.

    A group above the capacity has a shard of its own. Null texts form one group, as do empty ones; both count as
    one unit. Every row, repeated or with a null doc_id, is returned. Groups of equal size go by text
    digest. Other columns don't matter. An empty table gives no rows.
    """
    rows = docs.select("doc_id", F.md5("text").alias("__digest"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("__bytes"))
    rows = materialise(rows.withColumn("__digest", F.coalesce("__digest", F.lit(""))))
    groups = rows.groupBy("__digest").agg(F.sum("__bytes").alias("group_bytes"))
    units = F.least(F.greatest(F.ceil(F.col("group_bytes") / unit), F.lit(1)), F.lit(capacity // unit + 1))  # all too large are alike
    groups = materialise(groups.withColumn("__u", units.cast("long")))
    counts = {r[0]: r[1] for r in groups.groupBy("__u").count().collect()}
    runs, _ = best_fit(counts, capacity // unit)
    groups = placed(docs.sparkSession, ranked(groups, "__u", ["__digest"], max(counts.values(), default=0)), "__u", runs)
    groups = groups.select("__digest", "group_bytes", F.col("__bin").cast("long").alias("shard_id"))
    return rows.join(groups, "__digest").select("doc_id", "group_bytes", "shard_id")
