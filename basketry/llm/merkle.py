"""Merkle manifest of a table of documents (operator 11).

Every row is a leaf; a source's leaves, in doc_id order, form a tree of ``arity`` children per
node; the sources' roots (subroots), in source order, form one more tree.  The manifest has a
row per document with the digests and siblings that prove it: whoever holds only ``root``
can check a single document with its ``path``.

Method.  Sibling-shift self-joins: at every level each slot-zero node (index a multiple of the
arity) computes the indices of its siblings (index xor 1 in a binary tree, index plus each slot
offset otherwise) and meets them in an equijoin of the level with itself; it then
emits the parent, which keeps its children's digests.  All the siblings of a run are the same nodes,
so the other slots shift nothing and read them from the parent.  A level is 1 / arity of the one below.
Paths are handed down from the root: a parent gives each child its own path plus the
child's run and slot, again by an equijoin on computed indices.

Scale.  Only digests are shuffled, never texts.  Leaf numbers come from a range sort by
(source, doc_id, leaf), row numbers inside a partition and the counts of the partitions before
it, so a source with any share of the rows is spread over tasks like every other.  Nodes
are joined by (source, index), which is even whatever the sources are.  The driver sees a level's
node count, nothing else.  Every level is a table in the shared folder.

Defined results: a null field is ``-``, an empty one ``0:``; a null source is a source of its own and
comes first, other sources follow by UTF-8 bytes; a null doc_id comes first in its source; rows
with one doc_id follow each other by leaf digest, rows equal in all fields get one leaf each and any
order of them gives the same digests; a lone leaf is its source's subroot, a lone subroot the root; an
empty table gives an empty manifest.  Fields are the named columns alone; other columns
are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.tables import shared_table

ARITY = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

PATH = "array<struct<slot:int,run:array<string>>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts, end to end."""
    return F.sha2(F.concat(*parts), 256)


def run_digest(run: Column) -> Column:
    return F.sha2(F.array_join(run, ""), 256)


def field_text(value: Column) -> Column:
    """``-`` for null, else byte count, colon, value."""
    s = value.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_digest(fields: tuple[str, ...] = FIELDS, **replaced: Column) -> Column:
    """Digest of a row's fields; ``replaced`` gives other values for some of them."""
    return digest(*[field_text(replaced.get(f, F.col(f))) for f in fields])


def numbered(rows: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``rows`` with ``name``: 0, 1, .. within ``group`` in the order of ``order``, and ``n``, the
    group's size.  Sorted by range, so a group may span any number of partitions."""
    keys = [F.col(c).asc_nulls_first() for c in [*group, *order]]
    # the last key only spreads equal rows over partitions
    dealt = rows.withColumn("_spread", F.monotonically_increasing_id())
    part = (dealt.repartitionByRange(*keys, F.col("_spread")).sortWithinPartitions(*keys).drop("_spread")
            .withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()))
    part = shared_table(part, f"merkle-{name}")
    low, n = F.min("_at").alias("_low"), F.count(F.lit(1)).alias("_n")
    pieces = part.groupBy(*group, "_part").agg(low, n)
    # one row per (group, partition): the windows run over that, not over rows
    same = Window.partitionBy(*(group or [F.lit(0)]))
    before = same.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))) \
        .withColumn("n", F.sum("_n").over(same)).alias("p")
    meets = [F.col("r._part") == F.col("p._part"), *[F.col(f"r.{c}").eqNullSafe(F.col(f"p.{c}")) for c in group]]
    return (part.alias("r").join(pieces, meets)
            .select(*[F.col(f"r.{c}") for c in rows.columns], (F.col("_at") - F.col("_low") + F.col("_before")).alias(name),
                    F.col("n").alias("n")))


def sibling_indices(index: Column, arity: int) -> Column:
    """Indices of a slot-zero node's siblings."""
    if arity == 2:
        return F.array(index.bitwiseXOR(F.lit(1).cast("long")))
    return F.transform(F.sequence(F.lit(1), F.lit(arity - 1)), lambda d: index + d.cast("long"))


def parents(nodes: DataFrame, arity: int) -> DataFrame:
    """One level up: (tree, index, digest, n) of trees with more than one node
    -> (tree, index, run, digest, n) of their parents."""
    heads = nodes.where(F.col("index") % arity == 0).select(
        "tree", F.col("index").alias("head"), "n",
        F.explode(F.concat(F.array(F.col("index")), sibling_indices(F.col("index"), arity))).alias("index"))
    # siblings beyond a tree's end have no node to meet
    met = heads.join(nodes.select("tree", "index", "digest"), ["tree", "index"])
    run = F.transform(F.array_sort(F.collect_list(F.struct((F.col("index") - F.col("head")).alias("slot"), "digest"))), lambda x: x["digest"])
    up = met.groupBy("tree", "head", "n").agg(run.alias("run"))
    return up.select("tree", F.floor(F.col("head") / arity).cast("long").alias("index"), "run", run_digest(F.col("run")).alias("digest"),
                     F.ceil(F.col("n") / arity).cast("long").alias("n"))


def climb(leaves: DataFrame, arity: int, name: str) -> tuple[DataFrame, list[DataFrame]]:
    """(tree, index, digest, n) -> the trees' tops (tree, digest, levels) and the parents of each level."""
    nodes, levels, tops = leaves, [], []
    while True:
        tops.append(nodes.where("n = 1").select("tree", "digest", F.lit(len(levels)).alias("levels")))
        nodes = nodes.where("n > 1")
        if nodes.isEmpty():
            break
        levels.append(shared_table(parents(nodes, arity), f"merkle-{name}-{len(levels) + 1}"))
        nodes = levels[-1].select("tree", "index", "digest", "n")
    top = tops[0]
    for t in tops[1:]:
        top = top.unionByName(t)
    return top, levels


def descend(tops: DataFrame, levels: list[DataFrame], arity: int) -> DataFrame:
    """Paths of the leaves' parents, or of the leaf where it is the top: (tree, levels, path, extra
    columns) of the tops and ``climb``'s levels -> (tree, index, run, path, ...); ``run`` is null for a lone leaf."""
    extra = [c for c in tops.columns if c not in ("tree", "levels", "path")]

    def top(k):
        return tops.where(F.col("levels") == k).select("tree", F.lit(0).cast("long").alias("index"), "path", *extra)

    at = top(len(levels))
    for k in range(len(levels), 1, -1):
        down = levels[k - 1].select("tree", "index", "run").join(at, ["tree", "index"])
        # a slot may be the same digest as another: children are told by position
        kids = down.select("tree", F.col("index").alias("_up"), "run", "path", *extra, F.posexplode("run").alias("slot", "_digest"))
        step = F.array(F.struct(F.col("slot").cast("int").alias("slot"), "run"))
        at = kids.select("tree", (F.col("_up") * arity + F.col("slot")).alias("index"),
                         F.concat(step, F.col("path")).alias("path"), *extra).unionByName(top(k - 1))
    lone = F.lit(None).cast("array<string>").alias("run")
    if not levels:
        return at.select("tree", "index", lone, "path", *extra)
    runs = levels[0].select("tree", "index", "run").join(at, ["tree", "index"])
    return runs.select("tree", "index", "run", "path", *extra).unionByName(top(0).select("tree", "index", lone, "path", *extra))


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, arity: int = ARITY, carried: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, source, leaf, position, subroot, root, path, carried columns) of every row.

    ``path`` holds, from the leaf up to the root, the slot of the node and the digests of its run
    (itself included).  ``carried`` names further columns to keep, as expressions over ``docs``."""
    carried = carried or {}
    rows = docs.select("doc_id", "source", leaf_digest(fields).alias("leaf"), *[c.alias(n) for n, c in carried.items()])
    rows = numbered(rows, ["source"], ["doc_id", "leaf"], "position")
    # null sources need a value to be joined by; no source can be this text and the flag at once
    tree = F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name"))
    rows = shared_table(rows.withColumn("tree", tree), "merkle-leaves")
    subroots, levels = climb(rows.select("tree", F.col("position").alias("index"), F.col("leaf").alias("digest"), "n"), arity, "docs")
    subroots = shared_table(subroots, "merkle-subroots")

    # null sources first: their flag is turned round for the order
    ordered = numbered(subroots.withColumn("_named", ~F.col("tree.none")).withColumn("_name", F.col("tree.name")), [], ["_named", "_name"], "index")
    ordered = shared_table(ordered.select(F.col("tree").alias("source_tree"), "levels", "digest", "index", "n"), "merkle-sources")
    whole = F.lit(0).alias("tree")
    root, above = climb(ordered.select(whole, "index", "digest", "n"), arity, "sources")
    paths = descend(root.select("tree", "levels", F.array().cast(PATH).alias("path"), F.col("digest").alias("root")), above, arity)
    source_paths = paths.select(F.posexplode_outer("run").alias("slot", "_digest"), "index", "run", "path", "root").select(
        F.when(F.col("run").isNull(), F.col("index")).otherwise(F.col("index") * arity + F.col("slot")).alias("index"),
        F.when(F.col("run").isNull(), F.col("path")).otherwise(
            F.concat(F.array(F.struct(F.col("slot").cast("int").alias("slot"), "run")), F.col("path"))).alias("path"), "root")
    tops = ordered.join(source_paths, "index").select(F.col("source_tree").alias("tree"), "levels", "path", "root", F.col("digest").alias("subroot"))

    held = descend(shared_table(tops, "merkle-tops"), levels, arity)
    # a run's leaves meet it by the computed index of their parent
    up = F.when(F.col("n") > 1, F.floor(F.col("position") / arity)).otherwise(F.lit(0)).cast("long")
    leaves = rows.withColumn("index", up).withColumn("_slot", (F.col("position") % arity).cast("int"))
    step = F.array(F.struct(F.col("_slot").alias("slot"), "run"))
    return leaves.join(held, ["tree", "index"]).select(
        "doc_id", "source", "leaf", "position", "subroot", "root",
        F.when(F.col("run").isNull(), F.col("path")).otherwise(F.concat(step, F.col("path"))).alias("path"), *carried)


def proof_digest(path: Column) -> Column:
    """Digest of the siblings, level by level, left to right."""
    others = F.transform(path, lambda s: F.array_join(F.filter(s["run"], lambda d, i: i != s["slot"]), ""))
    return F.sha2(F.array_join(others, ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """Root recomputed from a leaf and its siblings."""
    return F.aggregate(path, leaf, lambda acc, s: run_digest(F.transform(s["run"], lambda d, i: F.when(i == s["slot"], acc).otherwise(d))))


def verify(listed: DataFrame, leaf: str) -> DataFrame:
    """``listed`` (from ``manifest``) with ``folded_root`` of the digests in column ``leaf``, and ``verified``."""
    out = listed.withColumn("folded_root", fold(F.col(leaf), F.col("path")))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
