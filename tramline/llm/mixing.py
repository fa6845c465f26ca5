"""Mixing sources to target weights by hierarchical budgeting."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import BLANK, materialise, token_count

OTHER_DOMAIN, UNKNOWN = "reference", "unknown"


class Targets(NamedTuple):
    """The tree and its weights: each domain's sources, the weights of domains and of languages, and what others weigh."""

    domains: dict[str, tuple[str, ...]]
    domain_weights: dict[str, float]
    lang_weights: dict[str, float]
    domain_other: float = 0.05
    lang_other: float = 0.05
    source_weights: dict[str, float] = {}
    source_other: float = 1.0


DEFAULT = Targets(
    domains={
        "web": ("src0", "src1", "src2", "src3", "src4"),
        "books": ("src5", "src6", "src7", "src8", "src9"),
        "forum": ("src10", "src11", "src12", "src13", "src14"),
    },
    domain_weights={"web": 0.4, "books": 0.3, "forum": 0.1, "reference": 0.2},
    lang_weights={"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.1},
)
FRACTION, EPOCHS, SEED, BUCKET = 0.8, 2, "tramline", 3
TREE = ["domain", "lang_", "source_"]


def mapped(column: Column, values: dict[str, float], other: float) -> Column:
    out = F.lit(other)
    for k, v in values.items():
        out = F.when(column == k, F.lit(v)).otherwise(out)
    return out


def leaves(docs: DataFrame, targets: Targets) -> DataFrame:
    """docs with the path of each row in the tree."""
    domain = F.lit(OTHER_DOMAIN)
    for name, sources in targets.domains.items():
        domain = F.when(F.col("source_").isin(*sources), F.lit(name)).otherwise(domain)
    rows = docs.withColumns({"source_": F.coalesce("source", F.lit(UNKNOWN)), "lang_": F.coalesce("lang", F.lit(UNKNOWN))})
    return rows.withColumn("domain", domain)


def fill(rows: DataFrame, parent: list[str], budget: str, weight: str, capacity: str, out: str) -> DataFrame:
    """Adds `out`: each sibling's share of its parent's budget by weight, none above its capacity.

    What a full sibling can't take goes to the others by their weights; the siblings that fill up first are those
    with the least capacity for their weight, so running sums in that order find them.
    """
    order = W.partitionBy(*parent).orderBy(F.col("__need"), *TREE)
    rows = rows.withColumn("__need", F.col(capacity) / F.col(weight))
    earlier, later = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    rows = rows.withColumn("__taken", F.coalesce(F.sum(capacity).over(earlier), F.lit(0.0)))
    rows = rows.withColumn("__level", (F.col(budget) - F.col("__taken")) / F.sum(weight).over(later))
    first = F.min(F.when(F.col("__level") < F.col("__need"), F.struct("__need", "__level"))).over(W.partitionBy(*parent))
    level = first.getField("__level")
    rows = rows.withColumn(out, F.when(level.isNull(), F.col(capacity)).otherwise(F.least(F.col(capacity), level * F.col(weight))))
    return rows.drop("__need", "__taken", "__level")


def quotas(totals: DataFrame, fraction: float, epochs: int, targets: Targets) -> DataFrame:
    """(domain, lang_, source_, __full, __rest): whole epochs and the tokens of the next one, for each leaf.

    totals: (domain, lang_, source_, tokens). Budgets go down the tree; as no node gets more than its leaves
    hold in `epochs` epochs, a shortage is shared among siblings first and leaves them only once all are full.
    """
    rows = totals.withColumn("__cap", (F.col("tokens") * epochs).cast("double"))
    rows = rows.withColumn("__budget", F.sum("tokens").over(W.partitionBy(F.lit(0))) * F.lit(fraction))
    domains = rows.groupBy("domain").agg(F.sum("__cap").alias("__c"), F.first("__budget").alias("__budget"))
    domains = domains.withColumns({"lang_": F.lit(""), "source_": F.lit(""), "__none": F.lit(0), "__w": mapped(F.col("domain"), targets.domain_weights, targets.domain_other)})
    domains = fill(domains, ["__none"], "__budget", "__w", "__c", "__d").select("domain", "__d")
    langs = rows.groupBy("domain", "lang_").agg(F.sum("__cap").alias("__c")).join(domains, "domain")
    langs = langs.withColumns({"source_": F.lit(""), "__w": mapped(F.col("lang_"), targets.lang_weights, targets.lang_other)})
    langs = fill(langs, ["domain"], "__d", "__w", "__c", "__l").select("domain", "lang_", "__l")
    rows = rows.join(langs, ["domain", "lang_"]).withColumn("__w", mapped(F.col("source_"), targets.source_weights, targets.source_other))
    rows = fill(rows, ["domain", "lang_"], "__l", "__w", "__cap", "__s")
    quota = F.floor(F.col("__s") + 1e-6).cast("long")
    return rows.select(*TREE, F.floor(quota / F.col("tokens")).cast("long").alias("__full"), (quota % F.col("tokens")).cast("long").alias("__rest"))


def order_key(epoch: Column, seed: str) -> Column:
    """A row's place in an epoch: 32 hexadecimal digits from the seed, the epoch and the id."""
    return F.md5(F.concat_ws(":", F.lit(seed), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))


def choose(docs: DataFrame, fraction: float = FRACTION, epochs: int = EPOCHS, seed: str = SEED, targets: Targets = DEFAULT) -> DataFrame:
    """(domain, lang_, source_, __full, __last): every row has __full copies, and one more if its key is <= __last.

    A leaf's last epoch is a prefix in the order of its keys. Tokens are added up by the first digits of the key, and
    only the one bucket in which the quota ends is looked at row by row, so no leaf is ever sorted whole.
    """
    rows = materialise(leaves(docs, targets).select("doc_id", *TREE, token_count("text").alias("tokens")).filter("tokens > 0"))
    totals = rows.groupBy(*TREE).agg(F.sum("tokens").alias("tokens"))
    quota = materialise(quotas(totals, fraction, epochs, targets))
    keyed = rows.join(quota, TREE).select(*TREE, "__full", "__rest", "tokens", order_key(F.col("__full"), seed).alias("__key"))
    keyed = keyed.filter("__rest > 0").withColumn("__bucket", F.substring("__key", 1, BUCKET))
    buckets = keyed.groupBy(*TREE, "__bucket", "__rest").agg(F.sum("tokens").alias("__t"))
    running = W.partitionBy(*TREE).orderBy("__bucket").rowsBetween(W.unboundedPreceding, 0)
    buckets = buckets.withColumn("__end", F.sum("__t").over(running))
    # the whole buckets' last key, and the bucket in which the quota ends
    whole = buckets.filter("__end <= __rest").groupBy(*TREE).agg(F.max("__bucket").alias("__whole"))
    edge = buckets.filter("__end > __rest and __end - __t <= __rest").select(*TREE, "__bucket", (F.col("__rest") - F.col("__end") + F.col("__t")).alias("__room"))
    inside = keyed.join(edge, [*TREE, "__bucket"]).groupBy(*TREE, "__key", "__room").agg(F.sum("tokens").alias("__t"))
    inside = inside.withColumn("__end", F.sum("__t").over(W.partitionBy(*TREE).orderBy("__key").rowsBetween(W.unboundedPreceding, 0)))
    last = inside.filter("__end <= __room").groupBy(*TREE).agg(F.max("__key").alias("__edge"))
    found = quota.select(*TREE, "__full").join(whole, TREE, "left").join(last, TREE, "left")
    cut = F.coalesce("__edge", F.concat("__whole", F.lit("~")), F.lit(""))
    return materialise(found.select(*TREE, "__full", cut.alias("__last")))


def copies(docs: DataFrame, chosen: DataFrame, seed: str = SEED, targets: Targets = DEFAULT) -> DataFrame:
    """docs, each row once for every epoch that takes it, with __epoch."""
    none = F.length(F.btrim(F.coalesce("text", F.lit("")), F.lit(BLANK))) == 0
    rows = leaves(docs, targets).filter(~none).join(chosen, TREE)
    times = F.col("__full") + F.when(order_key(F.col("__full"), seed) <= F.col("__last"), 1).otherwise(0)
    rows = rows.withColumn("__times", times.cast("int")).filter("__times > 0")
    return rows.withColumn("__epoch", F.explode(F.sequence(F.lit(0), F.col("__times") - 1)))


def mix_sources(docs: DataFrame, fraction: float = FRACTION, epochs: int = EPOCHS, seed: str = SEED, targets: Targets = DEFAULT) -> DataFrame:
    """(doc_id, domain, lang, source, epoch): the mixture, a row for every time that a document is read.

    The budget is `fraction` of the corpus's tokens. It goes down a tree of domains (of sources), languages and
    sources by the weights of `targets`. A leaf holds at most `epochs` epochs; see quotas for shortages. Epoch 0, 1, ...
    each have their own seeded order, and the last is cut where the next document would exceed the leaf's quota.

    A null source or language is 'unknown'. Texts without tokens (null, empty, blank) are never chosen. Rows
    with the same doc_id in a leaf, null included, have one place in the order and are chosen together or not.
    Other columns don't matter. An empty table gives no rows.
    """
    rows = copies(docs.select("doc_id", "text", "lang", "source"), choose(docs, fraction, epochs, seed, targets), seed, targets)
    return rows.select("doc_id", "domain", F.col("lang_").alias("lang"), F.col("source_").alias("source"), F.col("__epoch").cast("long").alias("epoch"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of docs that mix_sources chooses, repeated as it says, with all of their columns. Texts are never shuffled.

    Texts without tokens go. Rows of one doc_id in a leaf are chosen together. A document of two epochs is two equal rows:
    the columns are those of docs, so none tells the epoch. An empty table gives no rows; no column's name can clash.
    """
    plain = docs.select(*[F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(docs.columns)], "doc_id", "text", "lang", "source")
    rows = copies(plain, choose(docs.select("doc_id", "text", "lang", "source")))
    return rows.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(docs.columns)])
