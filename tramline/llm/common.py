"""Helpers shared by the training-data operators."""

from __future__ import annotations

import math
import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BLANK = " \t\n\r"
NULL_ID = -(2**63)
_own_dirs: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession) -> str:
    """The folder that all executors share; a temporary one only in local mode without the setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    if context.applicationId not in _own_dirs:
        _own_dirs[context.applicationId] = tempfile.mkdtemp(prefix="tramline-")
    return "file://" + _own_dirs[context.applicationId]


def written(df: DataFrame) -> tuple[DataFrame, str]:
    """df as a table in the shared folder, and its path."""
    spark = df.sparkSession
    path = f"{work_dir(spark)}/tramline-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialise(df: DataFrame) -> DataFrame:
    """df as a table written to the shared folder: computed once, and safe when an executor is lost."""
    return written(df)[0]


def token_count(text: Column | str) -> Column:
    """Number of maximal runs without blanks (space, tab, newline, return); null counts as 0."""
    trimmed = F.btrim(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), F.lit(BLANK))
    return F.when(F.length(trimmed) == 0, F.lit(0)).otherwise(F.size(F.split(trimmed, "[ \t\n\r]+"))).cast("long")


def id_key(column: str = "doc_id") -> Column:
    """The id, with one value for null, to join on."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NULL_ID))


def ranked(df: DataFrame, key: str, order: list[str], largest: int, per_task: int = 200_000) -> DataFrame:
    """Adds __rank, 0.. within each key.

    A key may hold most rows (a hot length), so its rows are spread over shards by a hash of `order`;
    each row's rank is the number of rows in earlier shards plus its place in its own.
    """
    shards = max(1, math.ceil(largest / per_task))
    rows = df.withColumn("__shard", F.pmod(F.xxhash64(*order), F.lit(shards)))
    counts = rows.groupBy(key, "__shard").agg(F.count(F.lit(1)).alias("__n"))
    before = W.partitionBy(key).orderBy("__shard").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select(key, "__shard", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    place = F.row_number().over(W.partitionBy(key, "__shard").orderBy(*order))
    return (
        rows.withColumn("__place", place)
        .join(counts, [key, "__shard"])
        .withColumn("__rank", F.col("__before") + F.col("__place") - 1)
        .drop("__shard", "__place", "__before")
    )


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges node -> least node of its component, one per node that isn't the least, for the edges a-b."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while len(i):
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if np.array_equal(label, before):
            break
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def discard(spark: SparkSession, path: str) -> None:
    """Removes an intermediate table that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of each component, for every node that isn't one itself.

    edges: (a, b) of long. Large-star and small-star rounds, each written to the shared folder, until
    nothing changes; the number of rounds grows with the logarithm of the largest component. The least neighbour
    is an aggregate, combined before its shuffle, and joined back, so that a hot node's edges are never sorted in one task.
    """
    spark = edges.sparkSession
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, path = written(pairs)
    mark = None
    while True:
        both = now.select("a", "b").union(now.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("m", "a").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large, large_path = written(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        after, next_path = written(small.filter("a <> b").distinct())
        discard(spark, path)
        discard(spark, large_path)
        now, path = after, next_path
        is_now = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if is_now == mark or not is_now[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = is_now


def keep_rows(docs: DataFrame, kept: DataFrame, mark: Column, repeats: bool) -> DataFrame:
    """The rows of docs whose (id, mark) is in kept (__id, __mark).

    If `repeats`, of several rows of one (id, mark) the least stays, compared column by column (a map as JSON text); rows
    that are equal in all columns are interchangeable. Columns are renamed by position, so no name of theirs clashes.
    """
    own = [f"__c{i}" for i in range(len(docs.columns))]
    rows = docs.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(docs.columns, own)], id_key().alias("__id"), mark.alias("__mark"))
    rows = rows.join(kept.select("__id", "__mark"), ["__id", "__mark"], "left_semi")
    if repeats:
        order = [F.to_json(F.struct(c)) if "map<" in kind or kind == "variant" else F.col(c) for c, kind in rows.select(*own).dtypes]
        place = F.row_number().over(W.partitionBy("__id", "__mark").orderBy(*order))
        rows = rows.withColumn("__place", place).filter("__place = 1")
    return rows.select(*own).toDF(*docs.columns)
