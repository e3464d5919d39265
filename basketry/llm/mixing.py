"""Mixing sources to target weights (operator 7, DataFrame functions only).

Method: Efraimidis-Spirakis weighted sampling without replacement.  Every
document draws an exponential key ``-ln(u) / weight`` (u from a hash of seed and
doc_id, so reruns agree); within a source the documents are put in key order
and taken until the source's word budget is used up.

Targets.  ``ratio`` times all words are shared over the sources in proportion to
their weights; no source goes above ``max_epochs`` times its own words, and
what it can't take is shared again among the others (water-filling, in closed
form over the one-row-per-source table).

Epochs.  A target of e whole epochs plus a rest takes every document e times,
then fills the rest in key order; the document at the edge is taken in part
(its first words), so a source misses its target by less than one word.

Scale.  Only (doc_id, source, words, key) is staged; prefix sums have two levels:
word sums of key ranges per source (about 2 sqrt(n) ranges for the largest
source), and document sums inside the one range that holds the edge.  A
source with a third of all rows is therefore never sorted in one task.  The
documents then meet one row per source (the edge), not each other.

Defined results: null text or text without words has size 0; null source is a
source of its own, ordered last; null doc_id sorts first; a null or non-positive
weight counts as 1; rows equal in (key, doc_id, size) share what is left for them
evenly, rounded down; an empty table gives an empty result.  Input columns
that clash with a result column's name are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.tables import shared_table
from basketry.llm.text import WORD_PATTERN

SOURCE_WEIGHTS = (5.0, 2.0, 1.0)
RATIO = 1.5
MAX_EPOCHS = 2
SEED = "mix-1"
_NO_ID = -(1 << 63)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def uniform(seed: str, ident: Column) -> Column:
    """In (0, 1), from 52 bits of md5 (the same in any engine)."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(ident.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2 ** 52))


def _with_keys(sized: DataFrame, seed: str) -> DataFrame:
    """(doc_id, source, size, _weight) -> + (_none, _src, _id, _key)."""
    w = F.when(F.col("_weight") > 0, F.col("_weight").cast("double")).otherwise(F.lit(1.0))
    return sized.select(
        "doc_id", "source", "size", F.col("source").isNull().alias("_none"),
        F.coalesce(F.col("source"), F.lit("")).alias("_src"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("_id"),
        (-F.log(uniform(seed, F.col("doc_id"))) / w).alias("_key"))


def source_targets(sizes: DataFrame, weights=SOURCE_WEIGHTS, ratio: float = RATIO,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source (_none, _src, source_size, n_docs) -> + target.

    The windows run over the source table, one row per source."""
    order = Window.orderBy("_none", "_src")
    n = len(weights)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(order) - 1) % n + 1).cast("int"))
    s = sizes.withColumn("_w", w).withColumn("_cap", F.lit(float(max_epochs)) * F.col("source_size"))
    everything = Window.partitionBy(F.lit(0))
    by_fill = Window.orderBy(F.col("_cap") / F.col("_w"), "_none", "_src")
    upto = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumns({
        "_total": F.lit(float(ratio)) * F.sum("source_size").over(everything),
        "_full": F.coalesce(F.sum("_cap").over(upto), F.lit(0.0)),
        "_wleft": F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(upto), F.lit(0.0)),
        "_at": F.row_number().over(by_fill),
    })
    s = s.withColumn("_rate", (F.col("_total") - F.col("_full")) / F.col("_wleft"))
    s = s.withColumn("_level", F.min(F.when(F.col("_cap") / F.col("_w") >= F.col("_rate"),
                                            F.struct("_at", "_rate"))).over(everything))
    target = F.when(F.col("_level").isNull(), F.col("_cap")).otherwise(
        F.least(F.col("_cap"), F.col("_level._rate") * F.col("_w")))
    return s.withColumn("target", target).select("_none", "_src", "source_size", "n_docs", "target")


def _edges(keyed: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: whole epochs, and the place in key order where the rest ends."""
    largest = targets.agg(F.max("n_docs")).first()[0] or 1
    ranges = max(16, int(2 * largest ** 0.5))
    part = F.least(F.lit(ranges - 1), F.floor(F.lit(ranges) * (F.lit(1.0) - F.exp(-F.col("_key")))))
    keyed = keyed.withColumn("_part", part.cast("int"))
    src = ["_none", "_src"]
    whole = F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1))).cast("long")
    t = targets.withColumn("_epochs", whole) \
        .withColumn("_rest", F.floor("target").cast("long") - F.col("_epochs") * F.col("source_size"))
    sums = keyed.groupBy(*src, "_part").agg(F.sum("size").alias("_psize"))
    run = Window.partitionBy(*src).orderBy("_part")
    edge_part = (sums.withColumn("_upto", F.sum("_psize").over(run))
                 .join(t, src)
                 .where((F.col("_upto") > F.col("_rest")) & (F.col("_upto") - F.col("_psize") <= F.col("_rest"))
                        & (F.col("_psize") > 0))
                 .select(*src, "_part", "_rest", (F.col("_upto") - F.col("_psize")).alias("_before")))
    peers = (keyed.where(F.col("size") > 0).join(edge_part, [*src, "_part"])
             .groupBy(*src, "_part", "_rest", "_before", "_key", "_id", "size").agg(F.count(F.lit(1)).alias("_peers")))
    inside = Window.partitionBy(*src, "_part").orderBy("_key", "_id", "size")
    got = F.col("size") * F.col("_peers")
    edge = (peers.withColumn("_upto", F.col("_before") + F.sum(got).over(inside))
            .where((F.col("_upto") > F.col("_rest")) & (F.col("_upto") - got <= F.col("_rest")))
            .select(*src, F.col("_key").alias("_ekey"), F.col("_id").alias("_eid"), F.col("size").alias("_esize"),
                    F.floor((F.col("_rest") - F.col("_upto") + got) / F.col("_peers")).cast("long").alias("_eleft")))
    return t.join(edge, src, "left").select(*src, "source_size", "target", "_epochs", "_ekey", "_eid", "_esize", "_eleft")


def quality_weights(sized: DataFrame, labels: DataFrame) -> DataFrame:
    """+ ``_weight``: 2 for labelled good quality, 1/2 for labelled poor, else 1."""
    best = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("_quality"))
    w = F.when(F.col("_quality") >= 1, F.lit(2.0)).when(F.col("_quality") < 1, F.lit(0.5)).otherwise(F.lit(1.0))
    return sized.join(best, "doc_id", "left").withColumn("_weight", w).drop("_quality")


def mix_plan(docs: DataFrame, labels: DataFrame | None = None, weights=SOURCE_WEIGHTS,
             ratio: float = RATIO, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, epochs, taken
    (the words the mix takes from it, repeats counted)."""
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    sized = sized.withColumn("_weight", F.lit(1.0)) if labels is None else quality_weights(sized, labels)
    keyed = shared_table(_with_keys(sized, seed), "mix")
    sizes = keyed.groupBy("_none", "_src").agg(F.sum("size").alias("source_size"),
                                              F.count(F.lit(1)).alias("n_docs"))
    edges = shared_table(_edges(keyed, source_targets(sizes, weights, ratio, max_epochs)), "mix-edges")
    here, edge = F.struct("_key", "_id", "size"), F.struct("_ekey", "_eid", "_esize")
    rest = (F.when(F.col("_ekey").isNull(), F.lit(0))
            .when(here < edge, F.col("size")).when(here == edge, F.col("_eleft")).otherwise(F.lit(0)))
    return keyed.join(edges, ["_none", "_src"]).select(
        "doc_id", "source", "size", "source_size", "target", F.col("_epochs").alias("epochs"),
        (F.col("_epochs") * F.col("size") + rest).cast("long").alias("taken"))


def mix_sources(docs: DataFrame, labels: DataFrame | None = None, **options) -> DataFrame:
    """``docs`` with the columns of its plan, without the documents the mix leaves out.

    Rows equal in (doc_id, source, size) have one decision, so the join back adds
    no rows."""
    kept = [c for c in docs.columns if c not in ("size", "source_size", "target", "epochs", "taken")]
    plan = mix_plan(docs, labels, **options).where(F.col("taken") > 0).distinct().select(
        F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("size").alias("_n"),
        "size", "source_size", "target", "epochs", "taken")
    sized = docs.select(*kept).withColumn("_words", word_count(F.col("text")))
    on = F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("source").eqNullSafe(F.col("_s")) & (F.col("_words") == F.col("_n"))
    return sized.join(plan, on).select(*kept, "size", "source_size", "target", "epochs", "taken")
