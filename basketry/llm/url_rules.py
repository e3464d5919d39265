"""URL filters (operator 1): longest matching (host, path) rule for every url.

Method: sort-merge range join.  A rule's canonical key is its host with the
labels reversed, ``#``, and its path (``example.org`` + ``/en/1`` ->
``org.example#/en/1``); hosts never hold ``#``.  All keys with a rule's key as
prefix form one interval in sorted order, and two such intervals are nested or
disjoint.  A url asks once per suffix of its host (``a.example.org``,
``example.org``, ``org``), so subdomains are covered; asks and rules are merged in key
order, and a sweep keeps the stack of rules whose interval is still open: its
top is the longest rule that fits the ask.

Scale.  Asks are made for distinct (host, path) only, after a shuffle that
counts nothing twice.  Keys are split into ranges at sampled points (they affect
balance only, never results); a rule is sent to every range that its interval
meets (a split point lies inside at most as many intervals as the rules nest
deep).  The sweep holds one stack and one Arrow batch.  Rules are never
broadcast or collected.

Defined results: null urls and urls without ``://`` have empty host and path; an empty
path fits no rule with a path; of several fitting rules the longest text (host +
path) wins, then the longer host; of rules repeated with different verdicts
``block`` wins; rules with null or empty host are ignored, a null rule path is empty
and fits every path; no fitting rule: rule is null and the verdict is ``default``.
Columns of the url table that clash with a result column are replaced.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.tables import shuffle_width

#: (host, path, verdict)
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
DEFAULT = "allow"
SAMPLE_KEYS = 20_000
_LAST = "\U0010ffff"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def _reversed(labels: Column) -> Column:
    return F.array_join(F.reverse(labels), ".")


def _split_points(asks: DataFrame, ranges: int) -> list[str]:
    """Keys that split the asks evenly, from a bounded sample (balance only)."""
    if ranges < 2:
        return []
    some = asks.select("key").orderBy(F.xxhash64("key")).limit(SAMPLE_KEYS)
    keys = sorted(r[0] for r in some.collect())
    return sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if keys else []


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (range, key, rules first): the open rules are a stack."""
    stack: list[tuple[str, str, str]] = []
    here = None
    for batch in batches:
        out: dict[str, list] = {"host": [], "path": [], "rule": [], "verdict": []}
        cols = [batch.column(c).to_pylist() for c in ("range", "key", "is_ask", "host", "path", "verdict")]
        for part, key, is_ask, host, path, verdict in zip(*cols):
            if part != here:
                here, stack = part, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if not is_ask:
                stack.append((key, host + path, verdict))
            elif stack:
                out["host"].append(host)
                out["path"].append(path)
                out["rule"].append(stack[-1][1])
                out["verdict"].append(stack[-1][2])
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([(k, pa.string()) for k in out]))


def judge_urls(urls: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """``urls`` (url, ..) with host, path, rule and verdict."""
    spark = urls.sparkSession
    kept = [c for c in urls.columns if c not in ("host", "path", "rule", "verdict")]
    parsed = urls.select(*kept, host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    pairs = parsed.select("host", "path").where(F.col("host") != "").distinct()
    labels = F.split("host", r"\.", -1)
    suffix = F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)),
                                   lambda i: F.slice(labels, i, F.size(labels) - i + 1)))
    asks = pairs.select("host", "path", suffix.alias("_labels")) \
        .select("host", "path", F.concat(_reversed(F.col("_labels")), F.lit("#"), F.col("path")).alias("key"))
    clean = (rules.where(F.coalesce(F.col("host"), F.lit("")) != "")
             .select(F.lower("host").alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
             .groupBy("host", "path").agg(F.max(F.struct((F.col("verdict") == "block").alias("b"), "verdict")).alias("v"))
             .select("host", "path", F.col("v.verdict").alias("verdict"),
                     F.concat(_reversed(F.split("host", r"\.", -1)), F.lit("#"), F.col("path")).alias("key")))
    ranges = shuffle_width(spark)
    points = _split_points(asks, ranges)

    @F.pandas_udf(T.IntegerType())
    def range_of(keys):
        return keys.map(lambda k: bisect_right(points, k)).astype("int32")

    first, last = range_of(F.col("key")), range_of(F.concat(F.col("key"), F.lit(_LAST)))
    events = (asks.select(range_of(F.col("key")).alias("range"), "key", F.lit(True).alias("is_ask"),
                          "host", "path", F.lit("").alias("verdict"))
              .unionByName(clean.select(first.alias("first"), last.alias("last"), "key", F.lit(False).alias("is_ask"),
                                        "host", "path", "verdict")
                           .select(F.explode(F.sequence("first", "last")).alias("range"),
                                   "key", "is_ask", "host", "path", "verdict")))
    found = (events.repartition(ranges, "range").sortWithinPartitions("range", "key", "is_ask")
             .mapInArrow(_sweep, "host string, path string, rule string, verdict string"))
    slash = F.instr("rule", "/")
    host_end = F.when(slash > 0, slash).otherwise(F.length("rule") + 1)
    best = found.groupBy("host", "path").agg(
        F.max(F.struct(F.length("rule").alias("n"), host_end.alias("h"), "rule", "verdict")).alias("m")) \
        .select("host", "path", F.col("m.rule").alias("rule"), F.col("m.verdict").alias("_v"))
    return parsed.join(best, ["host", "path"], "left") \
        .select(*kept, "host", "path", "rule", F.coalesce("_v", F.lit(default)).alias("verdict"))
