"""Secret scans with multipart credential linking (operator 8, DataFrame functions only).

Base findings, leftmost and non-overlapping per kind over the whole text:
``assign`` (a key word, ``:`` or ``=``, a value of 12 or more characters), ``access``
(``AKIA..``, 18 or more) and ``hex`` (16 or more).  Positions are code points, end
exclusive: a text is split at the matches, and the lengths of pieces and matches
add up to the positions.

Method: multipart linking.  Parts that are too weak to report alone are

* ``assign_short``: an assigned value of 6 to 11 characters,
* ``access_short``: ``AKIA..`` of 16 or 17 characters,
* ``key40``: a run of exactly 40 of ``A-Za-z0-9/+`` with an upper-case letter, a
  lower-case letter and a digit.

An interval join inside each document (equal document, equal bin of ``scope``
characters, gap of at most ``scope``) looks for complementary parts: for a weak secret an
access identifier or an endpoint (``scheme://..``), for a weak identifier a secret.
Weak parts with a complement in scope are reported beside the base findings; others
are not, and endpoints never are.

Scale.  Texts are scanned once, where they are read; only positions are staged and
joined.  The join is a semi-join (no pairs come out), and only documents that hold
both a weak part and a complement take part.

Defined results: null text is empty: no findings; rows are told apart by (doc_id,
hash of text), so repeated doc_ids and repeated rows are each scanned; an empty table
gives an empty result; input columns that clash with result columns are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.tables import shared_table

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: maximal runs, so a least length in the pattern finds what filtering afterwards finds
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{16,}"
KEY = r"[A-Za-z0-9/+]{40,}"
ENDPOINT = r"""[A-Za-z][A-Za-z0-9+.-]*://[^\x20\x09-\x0D"'<>]+"""
SCOPE = 200
BASE_KINDS = ("assign", "access", "hex")
ADDED_KINDS = ("assign_short", "access_short", "key40")

_SPANS = "array<struct<start:long,rank:int,kind:string,end:long>>"
_PLACES = "array<struct<start:long,end:long,n:long,value:string>>"


def _places(text: Column, pattern: str, value_group: int = 0) -> Column:
    """Matches as array<(start, end, n, value)>: n and value are of ``value_group``."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("piece"), found.alias("match"), values.alias("value"))

    def step(acc, p):
        start = acc["at"] + F.length(p["piece"])
        end = start + F.length(p["match"])
        here = F.struct(start.cast("long").alias("start"), end.cast("long").alias("end"),
                        F.length(p["value"]).cast("long").alias("n"), p["value"].alias("value"))
        return F.struct(end.cast("long").alias("at"), F.concat(acc["out"], F.array(here)).alias("out"))

    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_PLACES).alias("out"))
    walked = F.aggregate(F.slice(parts, F.lit(1), F.size(found)), zero, step, lambda acc: acc["out"])
    return F.when(text.rlike(pattern), walked).otherwise(F.array().cast(_PLACES))


def _spans(places: Column, kind: str, keep) -> Column:
    rank = (BASE_KINDS + ADDED_KINDS).index(kind)
    return F.transform(F.filter(places, keep), lambda p: F.struct(
        p["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), p["end"].alias("end")))


def _parts(docs: DataFrame) -> DataFrame:
    """Base spans, weak parts and complements of each row; one scan of the text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    row = docs.select("doc_id", F.xxhash64(text).alias("_h"),
                      _places(text, ASSIGN, 2).alias("assign"), _places(text, ACCESS).alias("access"),
                      _places(text, HEX).alias("hex"), _places(text, KEY).alias("key"),
                      _places(text, ENDPOINT).alias("endpoint"))
    strong_secret = F.concat(_spans(F.col("assign"), "assign", lambda p: p["n"] >= 12),
                             _spans(F.col("hex"), "hex", lambda p: p["n"] >= 16))
    strong_access = _spans(F.col("access"), "access", lambda p: p["n"] >= 18)
    weak_access = _spans(F.col("access"), "access_short", lambda p: (p["n"] >= 16) & (p["n"] < 18))
    mixed = lambda p: ((p["n"] == 40) & p["value"].rlike("[A-Z]") & p["value"].rlike("[a-z]")
                       & p["value"].rlike("[0-9]"))
    weak_secret = F.concat(_spans(F.col("assign"), "assign_short", lambda p: (p["n"] >= 6) & (p["n"] < 12)),
                           _spans(F.col("key"), "key40", mixed))
    ends = lambda c: F.transform(c, lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end")))
    return row.select(
        "doc_id", "_h",
        F.array_sort(F.concat(strong_secret, strong_access)).cast(_SPANS).alias("base"),
        weak_secret.cast(_SPANS).alias("weak_secret"), weak_access.cast(_SPANS).alias("weak_access"),
        F.concat(ends(F.col("access")), ends(F.col("endpoint"))).alias("for_secret"),
        F.concat(ends(strong_secret), ends(weak_secret)).alias("for_access"))


def _bins(lo: Column, hi: Column, scope: int) -> Column:
    return F.sequence(F.floor(lo / scope), F.floor(hi / scope))


def _linked(parts: DataFrame, weak: str, complement: str, scope: int) -> DataFrame:
    """Weak spans with a complement at most ``scope`` characters away."""
    both = parts.where((F.size(weak) > 0) & (F.size(complement) > 0)).select("doc_id", "_h", weak, complement).distinct()
    w = both.select("doc_id", "_h", F.explode(weak).alias("span"))
    w = w.select("doc_id", "_h", "span", F.explode(_bins(F.col("span.start"), F.col("span.end"), scope)).alias("bin"))
    c = both.select(F.col("doc_id").alias("_d"), F.col("_h").alias("_g"), F.explode(complement).alias("other"))
    c = c.select("_d", "_g", "other", F.explode(_bins(F.col("other.start") - scope, F.col("other.end") + scope, scope)).alias("_b"))
    near = (F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_h") == F.col("_g")) & (F.col("bin") == F.col("_b"))
            & (F.col("other.start") - F.col("span.end") <= scope) & (F.col("span.start") - F.col("other.end") <= scope)
            & ((F.col("other.start") != F.col("span.start")) | (F.col("other.end") != F.col("span.end"))))
    return w.join(c, near, "left_semi").select("doc_id", "_h", "span").distinct()


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """One row per input row: doc_id, _h (hash of the text), base and spans, both sorted
    arrays of (start, rank, kind, end); spans holds the base and the linked findings."""
    parts = shared_table(_parts(docs), "secrets")
    linked = _linked(parts, "weak_secret", "for_secret", scope) \
        .unionByName(_linked(parts, "weak_access", "for_access", scope)) \
        .groupBy("doc_id", "_h").agg(F.collect_list("span").alias("added")) \
        .select(F.col("doc_id").alias("_d"), F.col("_h").alias("_g"), "added")
    on = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_h") == F.col("_g"))
    every = F.concat("base", F.coalesce("added", F.array().cast(_SPANS)))
    return parts.select("doc_id", "_h", "base").join(linked, on, "left") \
        .select("doc_id", "_h", "base", F.array_sort(every).alias("spans"))


def listing(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[n(k) for k in BASE_KINDS],
                        F.sha2(listing(F.col("base")), 256).alias("base_sha256"), listing(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]", scope: int = SCOPE) -> DataFrame:
    """``docs`` with every finding replaced by ``mark`` (n_chars follows the text).

    Documents without findings are returned as they are."""
    found = scan(docs, scope).where(F.size("spans") > 0).distinct() \
        .select(F.col("doc_id").alias("_d"), F.col("_h").alias("_g"), F.col("spans").alias("_spans"))
    keyed = docs.withColumn("_h", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    on = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_h") == F.col("_g"))

    def step(acc, s):
        fresh = F.when(s["start"] >= acc["at"],
                       F.concat(acc["out"], F.substring(F.col("text"), (acc["at"] + 1).cast("int"),
                                                        (s["start"] - acc["at"]).cast("int")), F.lit(mark))) \
            .otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), fresh.alias("out"))

    zero = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    clean = F.aggregate("_spans", zero, step, lambda acc: F.concat(
        acc["out"], F.substring(F.col("text"), (acc["at"] + 1).cast("int"), F.length("text"))))
    out = keyed.join(found, on, "left").withColumn("text", F.when(F.col("_spans").isNotNull(), clean).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_spans").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
