"""URL filters: a sort-merge range join of URLs with host and path rules.

A host is written label by label from the right, each label closed by a dot
(`m.example.net` -> `net.example.m.`). A rule's host and all its subdomains are then one
interval of keys, [k, k with the last dot raised), and intervals nest or are apart. The
boundaries of the intervals, each with the stack of rules that are active from there on,
are sorted together with the URLs; a running window carries the last stack to each URL,
which only has to look through the stack for rules whose path it starts with.

Pages are dealt by top label and slice, so a label with most of the pages is swept by many
tasks; the boundaries of a label are repeated for each of its slices (rules of the label x
slices rows). URLs of labels without rules meet no boundary and are dealt evenly.

Defined cases: a null URL or one without `://` has empty host and path and no rule. Repeated
pages and rules are judged row by row; of equal rules the one whose action sorts first
holds. An input column named like an output (host, path, rule, verdict) is replaced; all
other columns stay. Empty tables give empty results, no rules give the default verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import UPPER, partitions

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Top labels with rules that are broadcast (a few MB); beyond them pages meet them in a shuffle
#: that adaptive execution splits.
MAX_LABELS = 100_000
OUTPUTS = ("host", "path", "rule", "verdict")


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), URL, 1)
    return F.translate(found, UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), URL, 2)


def host_key(host: Column) -> Column:
    """Labels from the right, each with a dot behind it."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def top_label(key: Column) -> Column:
    return F.substring_index(key, ".", 1)


def boundaries(rules: DataFrame) -> DataFrame:
    """Each end of a rule's interval with the rules active from there on: (key, stack).

    The rules active at a boundary are those of the enclosing hosts, found by an equi-join
    with the prefixes of the key, so the table grows as rules x depth.
    """
    rules = rules.where("host is not null and path is not null and action is not null")
    named = rules.select(
        host_key(F.translate("host", UPPER, UPPER.lower())).alias("host_key"),
        F.struct(
            F.length(F.concat("host", "path")).alias("size"),
            F.concat("host", "path").alias("rule"),
            F.col("path").alias("path"),
            F.col("action").alias("action"),
        ).alias("entry"),
    ).distinct()
    labels = F.split(F.expr("substr(host_key, 1, length(host_key) - 1)"), r"\.")
    hosts = named.select("host_key").distinct()
    chain = hosts.select("host_key", F.posexplode(labels).alias("depth", "_"), labels.alias("labels")).select(
        "host_key",
        F.concat(F.array_join(F.slice("labels", F.lit(1), F.col("depth") + 1), "."), F.lit(".")).alias("outer"),
    )
    active = chain.join(named.withColumnRenamed("host_key", "outer"), "outer")
    begins = active.groupBy("host_key").agg(F.collect_list("entry").alias("stack"))
    ends = (
        active.groupBy("host_key")
        .agg(F.collect_list(F.when(F.col("outer") != F.col("host_key"), F.col("entry"))).alias("stack"))
        .select(
            top_label(F.col("host_key")).alias("label"),
            F.expr("concat(substr(host_key, 1, length(host_key) - 1), '/')").alias("key"),
            "stack",
        )
    )
    return begins.select(top_label(F.col("host_key")).alias("label"), F.col("host_key").alias("key"), "stack").unionByName(ends)


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url") -> DataFrame:
    """Adds host, path, rule (host + path of the longest that fits) and verdict to `pages`.

    `rules` has host, path and action ('allow' or 'block').
    """
    spark = pages.sparkSession
    kept = [c for c in pages.columns if c not in OUTPUTS]
    host, path = host_of(F.col(url)), path_of(F.col(url))
    judged = pages.select(
        F.struct(*kept).alias("page"),
        F.monotonically_increasing_id().alias("place"),
        host.alias("host"),
        path.alias("path"),
        host_key(host).alias("key"),
    ).withColumn("label", top_label(F.col("key")))

    stacks = boundaries(rules)
    ruled = stacks.select("label").distinct()
    # A slice holds about a quarter of one task's fair share of the pages.
    sizes = judged.groupBy("label").count()
    whole = sizes.agg(F.sum("count")).scalar()
    share = F.greatest(F.lit(1), F.ceil(whole / (4 * partitions(spark))))
    plan = sizes.join(ruled, "label").select("label", F.ceil(F.col("count") / share).cast("long").alias("slices"))
    if ruled.count() <= MAX_LABELS:
        # One row per top label with rules: small enough to spare the pages an exchange by label.
        plan = F.broadcast(plan)
    slices = F.coalesce(F.col("slices"), F.lit(1 << 40))
    dealt = judged.join(plan, "label", "left").select(
        "label",
        F.pmod("place", slices).alias("slice"),
        "key",
        F.lit(1).alias("kind"),
        "page",
        "host",
        "path",
        F.lit(None).cast(stacks.schema["stack"].dataType).alias("stack"),
    )
    marks = stacks.join(plan, "label").select(
        "label",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"),
        "key",
        F.lit(0).alias("kind"),
        F.lit(None).cast(dealt.schema["page"].dataType).alias("page"),
        F.lit(None).cast("string").alias("host"),
        F.lit(None).cast("string").alias("path"),
        "stack",
    )
    sweep = Window.partitionBy("label", "slice").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = (
        dealt.unionByName(marks)
        .withColumn("active", F.last("stack", ignorenulls=True).over(sweep))
        .where("kind = 1")
    )
    fitting = F.filter("active", lambda r: F.startswith(F.col("path"), r["path"]))
    best = F.array_sort(
        F.transform(
            fitting,
            lambda r: F.struct((-r["size"]).alias("order"), r["action"].alias("action"), r["rule"].alias("rule")),
        )
    )
    return swept.withColumn("best", F.get(best, F.lit(0))).select(
        "page.*",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.action", F.lit(default)).alias("verdict"),
    )
