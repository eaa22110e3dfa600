"""URL rules by a sort-merge range join.

A rule names a host and a path prefix; it fits that host and its subdomains. With
labels reversed (``example.net`` and ``/en/`` become ``net.example//en/``), a rule is the
interval of all keys that start with its own. A url is looked up once per suffix of its
host, by the key of that suffix and its path; suffixes with more labels than any rule
are left out. Keys and rules are sorted together over range partitions. A sweep in this
order keeps the last rule that has begun, together with the rules that enclose it: the
stack of rules that are open there. The rules that fit a key are those of the stack
that the key starts with; of all that fit a url the longest wins.

Everything is DataFrame code. Distinct (host, path) pairs are looked up, so a url that
holds a third of all rows costs one lookup; equal keys may stand in several range
partitions, each of which gets the last rule of those before it.

Defined results: a null url, or one without ``://``, has an empty host and path and no
rule; such and all other urls without a rule get ``DEFAULT``; of rules of equal length
the one with the longer host, then the lesser text wins; a rule given twice counts once
(the lesser verdict); repeated rows are judged alike; a null page_id is kept; empty
tables of urls or rules are fine; other columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import written

DEFAULT = "allow"
#: (host, path, verdict) of the registered query.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def _after(url):
    """The text after the first ``://``; null without one."""
    return F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)^.*?://", ""))


def host_of(url):
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_replace(_after(url), r"(?s)[/?#].*", ""), F.lit("")), _UPPER, _LOWER)


def path_of(url):
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_replace(F.regexp_replace(_after(url), r"(?s)[?#].*", ""), r"^[^/]*", ""), F.lit(""))


def _labels(host):
    return F.reverse(F.split(host, r"\."))


def _key(labels, path):
    """Hosts hold no slash, so the first one ends the host whatever the path is."""
    return F.concat(F.array_join(labels, "."), F.lit("/"), path)


def _stacks(rules: DataFrame) -> DataFrame:
    """(key, stack): each rule with the rules whose keys its own starts with, itself last."""
    rules = rules.groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
    own = rules.select(_key(_labels(F.col("host")), F.col("path")).alias("key"), F.struct("host", "path", "verdict").alias("entry"))
    sizes = own.select(F.length("key").alias("size")).distinct()
    cuts = own.join(F.broadcast(sizes), F.length("key") >= F.col("size")).select("key", F.expr("substring(key, 1, size)").alias("outer"))
    outer = own.select(F.col("key").alias("outer"), "entry")
    found = cuts.join(outer, "outer").groupBy("key")
    return found.agg(F.sort_array(F.collect_list(F.struct(F.length("outer").alias("size"), "outer", "entry"))).alias("stack"))


def judge(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages``."""
    urls = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url")).select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rules = rules.where("host IS NOT NULL AND path IS NOT NULL").select(F.translate("host", _UPPER, _LOWER).alias("host"), "path", "verdict")
    stacks = written(_stacks(rules), "url-rules")
    deepest = stacks.agg(F.max(F.size(F.split(F.substring_index("key", "/", 1), r"\."))).alias("n")).collect()[0]["n"] or 0

    targets = written(urls.select("host", "path").distinct(), "url-targets")
    labels = F.slice(_labels(F.col("host")), 1, max(1, deepest))
    probes = targets.where(F.length("host") > 0).select("host", "path", labels.alias("labels"))
    probes = probes.select("host", "path", F.explode(F.expr("transform(sequence(1, size(labels)), k -> slice(labels, 1, k))")).alias("suffix"))
    nothing = F.lit(None).cast(stacks.schema["stack"].dataType)
    events = probes.select(_key(F.col("suffix"), F.col("path")).alias("key"), F.lit(1).alias("kind"), "host", "path", nothing.alias("stack"))
    opens = stacks.select("key", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("host"), F.lit(None).cast("string").alias("path"), "stack")
    order = ["key", "kind", "host", "path"]
    # Written once, so that the partition numbers stay what they are.
    swept = written(events.unionAll(opens).repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "url-sweep")

    last = F.max(F.when(F.col("kind") == 0, F.struct("key", "stack")))
    ends = swept.groupBy("part").agg(last.alias("end"))  # a row per partition
    before = ends.select("part", F.max("end").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("open"))
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    open_here = F.last(F.when(F.col("kind") == 0, F.struct("key", "stack")), ignorenulls=True).over(inside)
    met = swept.withColumn("here", open_here).where("kind = 1").join(F.broadcast(before), "part")
    fits = F.filter(F.coalesce("here", "open")["stack"], lambda e: F.col("key").startswith(e["outer"]))
    best = met.select("host", "path", F.try_element_at(fits, F.lit(-1))["entry"].alias("entry")).where("entry IS NOT NULL")
    text = F.concat("entry.host", "entry.path")
    ranked = F.struct(F.length(text), F.length("entry.host"))
    winner = best.groupBy("host", "path").agg(F.max_by(F.struct(text.alias("rule"), F.col("entry.verdict").alias("verdict")), ranked).alias("win"))
    out = urls.join(winner, ["host", "path"], "left")  # AQE splits a url with very many rows
    return out.select(F.col("page_id").alias(page_id), "host", "path", F.col("win.rule").alias("rule"), F.coalesce("win.verdict", F.lit(DEFAULT)).alias("verdict"))
