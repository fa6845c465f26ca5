"""Lookups in an index that is cut into shards, without a join."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import materialise

BROADCAST_BYTES = 64 << 20
PER_TASK = 5_000_000

Answer = Callable[[bytes | None, pa.RecordBatch], pa.RecordBatch]


def sharded(rows: DataFrame, index: DataFrame, answer: Answer, schema: StructType, most: int = BROADCAST_BYTES, per_task: int = PER_TASK) -> DataFrame:
    """answer(blob of the shard or None, its rows) over all rows. rows: (__shard, ...); index: (__shard, __blob).

    An index of up to `most` bytes in all is broadcast, and the rows aren't shuffled. A larger one meets the rows
    by shard: each task streams a shard's blob and then its rows, which needn't fit in memory. A shard of more than
    `per_task` rows, as a hot key makes one, is dealt to several tasks, each with a copy of the blob.
    """
    total = index.agg(F.sum(F.octet_length("__blob"))).first()[0] or 0
    arrow = to_arrow_schema(schema)
    if total <= most:
        shared = rows.sparkSession.sparkContext.broadcast({r[0]: bytes(r[1]) for r in index.collect()})

        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for shard in pc.unique(batch.column("__shard")).to_pylist():
                    part = batch if not batch.num_rows else batch.filter(pc.equal(batch.column("__shard"), shard))
                    yield answer(shared.value.get(shard), part).cast(arrow)

        return rows.mapInArrow(near, schema)
    rows = materialise(rows)
    # at most a row for every per_task rows: a few bytes for millions of them
    hot = rows.groupBy("__shard").agg(F.ceil(F.count(F.lit(1)) / per_task).cast("long").alias("__tasks")).filter("__tasks > 1")
    hot = F.broadcast(materialise(hot))
    tasks = F.coalesce("__tasks", F.lit(1).cast("long"))
    rows = rows.join(hot, "__shard", "left").withColumn("__salt", F.pmod(F.monotonically_increasing_id(), tasks)).drop("__tasks")
    index = index.join(hot, "__shard", "left").withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), tasks - 1))).drop("__tasks")
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema if f.name not in ("__shard", "__salt")]
    both = index.select("__shard", "__salt", F.lit(0).alias("__kind"), "__blob", *blank).unionByName(
        rows.select("__shard", "__salt", F.lit(1).alias("__kind"), F.lit(None).cast("binary").alias("__blob"), *[f"`{c}`" for c in rows.columns if c not in ("__shard", "__salt")])
    )

    def far(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blob = None, None
        for batch in batches:
            kinds, shards = batch.column("__kind").to_pylist(), list(zip(batch.column("__shard").to_pylist(), batch.column("__salt").to_pylist()))
            cut = [0, *(i for i in range(1, len(shards)) if (shards[i], kinds[i]) != (shards[i - 1], kinds[i - 1])), len(shards)]
            for i, j in zip(cut, cut[1:]):
                if i == j:
                    continue
                if shards[i] != now:
                    now, blob = shards[i], None
                if kinds[i] == 0:
                    blob = batch.column("__blob")[i].as_py()
                else:
                    yield answer(blob, batch.slice(i, j - i)).cast(arrow)

    return both.repartition("__shard", "__salt").sortWithinPartitions("__shard", "__salt", "__kind").mapInArrow(far, schema)
