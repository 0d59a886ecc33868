"""URL filters: host and path rules found by a sort-merge range join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newscov.llm.common import stored, working_columns

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bytes that UTF-8 never holds: one ends the host within a key, one closes an interval.
HOST_END, INTERVAL_END = "FE", "FF"
DEFAULT_VERDICT = "allow"


def host_of(url: Column) -> Column:
    """What lies between the first ``://`` and the next ``/``, ``?`` or ``#``, in lower ASCII letters."""
    at = F.instr(url, "://")
    host = F.regexp_extract(url.substr(at + 3, F.length(url)), "^[^/?#]*", 0)
    return F.when(at > 0, F.translate(host, UPPER, UPPER.lower())).otherwise("")


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    at = F.instr(url, "://")
    path = F.regexp_extract(url.substr(at + 3, F.length(url)), "^[^/?#]*([^?#]*)", 1)
    return F.when(at > 0, path).otherwise("")


def _bytes(text: str) -> Column:
    return F.unhex(F.lit(text))


def canonical_key(host: Column, path: Column) -> Column:
    """Reversed host labels, then the path: all that a rule covers starts with the rule's key."""
    reversed_host = F.array_join(F.reverse(F.split(host, r"\.")), ".")
    return F.concat(F.encode(reversed_host, "UTF-8"), _bytes(HOST_END), F.encode(path, "UTF-8"))


def _rule_events(rules: DataFrame) -> DataFrame:
    """Two events per rule, each with the stack of rules that are open after it.

    Rules nest or are disjoint, as their intervals come from prefixes, so the rules open
    inside one are those whose key starts its key. They are found by joining every prefix of
    a rule's key with the keys themselves: an equi-join over as many rows as the keys have bytes.
    """
    own = rules.withColumn("key", canonical_key(F.col("rule_host"), F.col("rule_path")))
    # of rules for the same host and path the smallest verdict holds, which is allow before block
    own = own.groupBy("key").agg(F.min(F.struct("rule", "verdict")).alias("r"))
    own = own.select("key", F.struct(F.octet_length("key").alias("size"), "r.rule", "r.verdict").alias("open"))
    cuts = own.select(
        F.col("key").alias("inner"), F.explode(F.sequence(F.lit(1), F.octet_length("key"))).alias("n")
    ).select("inner", F.substring("inner", F.lit(1), F.col("n")).alias("key"))
    stacks = (
        cuts.join(own, "key").groupBy("inner").agg(F.array_sort(F.collect_list("open")).alias("stack"))
    )
    opened = stacks.select(F.col("inner").alias("key"), "stack")
    closed = stacks.select(
        F.concat("inner", _bytes(INTERVAL_END)).alias("key"),
        F.slice("stack", F.lit(1), F.size("stack") - 1).alias("stack"),
    )
    return opened.unionByName(closed)


def active_rules(points: DataFrame, rules: DataFrame) -> DataFrame:
    """Add to ``points(key, ...)`` the ``stack`` of rules whose interval holds the key.

    Rule events and points are sorted together by key over range partitions, so equal keys
    of any number spread as well. Within a range the last event's stack holds; a range begins
    with the last stack of the ranges before it, a table with one row per partition.
    """
    carried = [c for c in points.columns if c != "key"]
    events = _rule_events(rules).withColumn("kind", F.lit(0)).withColumn("spread", F.lit(0))
    marked = points.withColumn("kind", F.lit(1)).withColumn("spread", F.xxhash64(*points.columns))
    together = marked.unionByName(events.select("key", "kind", "spread", "stack"), allowMissingColumns=True)
    order = ["key", "kind", "spread"]
    ranged = together.repartitionByRange(*order).withColumn("range", F.spark_partition_id())
    ranged = stored(ranged, "url-ranges")  # pins the ranges, which a second evaluation could cut elsewhere
    here = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ends = ranged.groupBy("range").agg(F.max_by("stack", F.when(F.col("kind") == 0, F.col("key"))).alias("end"))
    starts = ends.select("range", F.last("end", ignorenulls=True).over(earlier).alias("before"))
    swept = ranged.withColumn("stack", F.last("stack", ignorenulls=True).over(here)).where("kind = 1")
    none = F.expr("CAST(array() AS array<struct<size:int,rule:string,verdict:string>>)")
    return swept.join(F.broadcast(starts), "range").select(
        "key", *carried, F.coalesce("stack", "before", none).alias("stack")
    )


def judge_urls(
    df: DataFrame, rules: DataFrame, id_column: str = "page_id", url_column: str = "url", default: str = DEFAULT_VERDICT
) -> DataFrame:
    """Host, path, deciding rule and verdict of every row.

    ``rules(host, path, verdict)``: a rule covers its host and all subdomains where the path
    starts with the rule's; the longest host-and-path wins. Every URL asks once for each
    ending of its host that could be a rule's, and the answers meet again by row.

    A null URL or one without ``://`` has an empty host and path and gets ``default``; so does a
    URL no rule covers, with a null rule. Repeated rows return as often as they come. An empty
    table gives an empty result; an empty rule table gives ``default`` throughout. Columns
    besides the two named ones are not read.
    """
    rules = rules.select(
        F.translate("host", UPPER, UPPER.lower()).alias("rule_host"), F.col("path").alias("rule_path"), "verdict"
    ).where("rule_host IS NOT NULL AND rule_path IS NOT NULL")
    rules = rules.withColumn("rule", F.concat("rule_host", "rule_path"))
    # hosts are cut to as many endings as the deepest rule has labels, which no longer ending can match
    depth = rules.agg(F.coalesce(F.max(F.size(F.split("rule_host", r"\."))), F.lit(1))).first()[0]
    pages = working_columns(df, id=id_column, url=url_column).groupBy("id", "url").agg(F.count("*").alias("copies"))
    pages = pages.withColumn("host", F.coalesce(host_of(F.col("url")), F.lit("")))
    pages = pages.withColumn("path", F.coalesce(path_of(F.col("url")), F.lit("")))
    labels = F.slice(F.reverse(F.split("host", r"\.")), 1, depth)
    endings = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda n: F.array_join(F.reverse(F.slice(labels, 1, n)), ".")
    )
    asked = pages.withColumn("ending", F.explode(endings))
    points = asked.select(
        canonical_key(F.col("ending"), F.col("path")).alias("key"), "id", "url", "copies", "host", "path"
    )
    answered = active_rules(points, rules).withColumn("top", F.element_at("stack", -1))
    answered = answered.withColumn("top", F.when(F.size("stack") > 0, F.col("top")))
    best = answered.groupBy("id", "url", "copies", "host", "path").agg(F.max("top").alias("top"))
    return best.select(
        F.col("id").alias(id_column),
        "host",
        "path",
        F.col("top.rule").alias("rule"),
        F.coalesce("top.verdict", F.lit(default)).alias("verdict"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    ).drop("copy")
