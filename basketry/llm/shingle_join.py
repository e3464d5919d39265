"""N-gram Jaccard join (operator 2): documents whose shingle sets are alike, exactly.

Sets.  Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a text's set is its distinct
5-word shingles (64-bit hashes); fewer words make one shingle; no words, an empty set
that links with nothing.  Two sets link when 100 * intersection >= 80 * union.  Equal
sets are one node, known by the hash of the set, so copies cost one node.

Method: universe partition with the pigeonhole principle (after the partition-based exact
set similarity join).  Sizes fall into bands so narrow that a set links only inside its
band or with the next.  A band's scheme hashes shingles into segments; H bounds the
symmetric difference of any linked pair whose smaller set is in the band.  Segments carry
credits: 1 if only the segment's subset is indexed, 2 if its one-deletion neighbourhood
is indexed as well.  With H + 1 + E credits in all, a linked pair that shares no
signature would need more than H differences, unless more than E credits are lost on empty
segments (2 if a segment with deletions is empty, 1 if it holds one shingle), and these
must be empty in both sets.  Empty segments are therefore never indexed, and
only sets that lose more than E credits add signatures of their own: the shortest hash
prefix that two linked sets must share.  How many segments get deletions and how much
slack E to take is allocated per band by expected cost (signatures, extra signatures of
sets short of credits, chance matches).

Signatures go to buckets as packed arrays, one row per task and bucket, and are sorted
there.  Sets with a common signature form a group.  Verification (exact, on the
texts) runs in four steps, so that groups are never expanded into pairs of rows:
every set against the smallest set of its groups; then the other star links between
different components; then groups that still hold several components, in blocks of about
``BLOCK`` sets; then, between the blocks of groups that still do, the sets outside the largest
component with each other and with that component.  A block is one task's work: sets that may link (an exact lower bound on
the difference from parity sketches, about 1.25 bits a shingle, tells) are compared there and only a
spanning set of the links comes out, fewer than the block has sets.  Two sets with several common groups
are compared in the first.  A pair inside one component can't change the components, so nothing is lost.

Scale.  Rows shuffled are packed signatures (about n/4 + n/4 per document), each text at most
once, and the texts of sets that share a signature (to a block: that have a possible partner there).  A hub with many members is salted.  Joins of tables
that grow with the documents are sort-merge joins at every size, so that what a run
needs grows evenly.
Buckets hold about ``BUCKET_SIGNATURES`` signatures; equal sets are merged in the task that reads
them, before the shuffle.

Defined results: null text is empty; a null doc_id is a document of its own and sorts
last among the ids of a component; repeated rows give repeated result rows; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.components import forest_roots, merge_roots
from basketry.llm.tables import shared_table, shuffle_width
from basketry.llm.text import mix64, shingle_hashes, text_column, word_chunks

SHINGLE = 5
PERCENT = 80
BUCKET_SIGNATURES = 4_000_000
FLUSH_SIGNATURES = 4_000_000
HUB_MEMBERS = 200
BLOCK = 512
#: row pairs compared at a time in a task
PAIRS = 1 << 18
#: shingles of the sets of a block
BLOCK_SHINGLES = 1 << 20
#: first groups of a set that its rows carry
LOW = 8
LAST = 2 ** 63 - 1
#: what verifying a chance match costs, in signatures
CHECK_COST = 250
SKETCH_MIN = 256
_SEED = 0x9E3779B97F4A7C15
_WORD = 2 ** 64


# --- sets ---------------------------------------------------------------------------

def shingle_set(words: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    return np.unique(shingle_hashes(words, k))


def set_id(s: np.ndarray) -> int:
    """Hash of a set as a signed long; never that of another size by construction of the sum."""
    total = int(np.add.reduce(mix64(s ^ np.uint64(_SEED)))) + len(s) * 0xD1342543DE82EF95
    return int(mix64(np.array([total % _WORD], dtype=np.uint64)).view(np.int64)[0])


def parity_sketch(s: np.ndarray) -> np.ndarray:
    """Parity of the number of shingles per bin of the hash, as packed bits; the number of
    bins is the power of two from ``SKETCH_MIN`` on that is at least 1.25 times the set.

    Two sets differ by at least the number of bins of unequal parity (an exact lower bound)."""
    bins = SKETCH_MIN
    while 4 * bins < 5 * len(s):
        bins *= 2
    count = np.bincount((s & np.uint64(bins - 1)).astype(np.int64), minlength=bins)
    return np.packbits((count & 1).astype(np.uint8))


def folded(sketch: np.ndarray, size: int) -> np.ndarray:
    """The sketch of the same set over fewer bins (``size`` bytes)."""
    while len(sketch) > size:
        sketch = sketch[:len(sketch) // 2] ^ sketch[len(sketch) // 2:]
    return sketch


def may_link(least, na, nb, percent: int):
    """Whether sets of these sizes that differ by ``least`` shingles or more can link."""
    return (least * (100 + percent) <= (na + nb) * (100 - percent)) & (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb))


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    for w in word_chunks(text_column(batch, "text")):
        h = w.hashes()
        for i in range(w.hi - w.lo):
            yield w.lo + i, shingle_set(h[w.first[i]:w.first[i + 1]])


# --- schemes ------------------------------------------------------------------------

_SCHEMES: dict[tuple[int, int], tuple[int, int, int, int]] = {}


def band_start(j: int, percent: int = PERCENT) -> int:
    start = 1
    for _ in range(j):
        start = start * 100 // percent + 1
    return start


def band_of(n: int, percent: int = PERCENT) -> int:
    j, after = 0, 100 // percent + 1
    while after <= n:
        j, after = j + 1, after * 100 // percent + 1
    return j


def scheme(j: int, percent: int = PERCENT) -> tuple[int, int, int, int]:
    """(H, segments with deletions, all segments, slack E) of band j, by expected cost.

    H: a set of x <= y shingles linked at ``percent`` has x + y - 2 * common <= x * (100 -
    percent) / percent differences, x at most the band's last size."""
    if (j, percent) in _SCHEMES:
        return _SCHEMES[j, percent]
    lo, hi = band_start(j, percent), band_start(j + 1, percent) - 1
    h = hi * (100 - percent) // percent
    size = (lo + hi) / 2
    alike = min(0.5, 20 / size)  # chance that a shingle is also in an unrelated set of the size
    best = None
    for slack in sorted({*range(13), *(h * i // 64 for i in range(1, 24))}):
        for twos in sorted({0, 1, 2, 3, (h + 1 + slack) // 2}):
            ones = h + 1 + slack - 2 * twos
            if ones < 0 or ones + twos == 0:
                continue
            m = ones + twos
            part = size / m
            lost = math.exp(-part) * (ones + twos * (2 + part)) if m > 1 else 0.0
            short = 1 - sum(math.exp(i * math.log(lost) - lost - math.lgamma(i + 1)) for i in range(slack + 1)) if lost else 0.0
            cost = (ones * (1 + CHECK_COST * alike ** part) + short * (2 + 0.6 * size)
                    + twos * (1 + part) * (1 + CHECK_COST * alike ** max(part - 1, 0)))
            if best is None or cost < best[0]:
                best = (cost, twos, m, slack)
    _SCHEMES[j, percent] = h, best[1], best[2], best[3]
    return _SCHEMES[j, percent]


def signatures(s: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Signatures of a set: linked sets that differ have one in common."""
    n = len(s)
    if not n:
        return s[:0]
    out = []
    j = band_of(n, percent)
    for b in (j, j - 1):
        if b < 0:
            continue
        h, twos, m, slack = scheme(b, percent)
        if h == 0:
            continue  # only equal sets link
        salt = np.uint64((b + 1) * _SEED % _WORD)
        x = mix64(s ^ salt)
        seg = (((x >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(seg, kind="stable")
        x, seg = x[order], seg[order]
        first = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]]))
        sums, at = np.add.reduceat(x, first), seg[first]
        sizes = np.diff(np.append(first, n))
        tag = lambda i: mix64((i.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95) ^ salt)
        out.append(mix64(sums + tag(at)))
        lost = m - len(at)
        if twos:
            two = at < twos
            lost += twos - int(two.sum()) + int((two & (sizes == 1)).sum())
            inner = (seg < twos) & (np.repeat(sizes, sizes) > 1)
            out.append(mix64(np.repeat(sums, sizes)[inner] - x[inner] + tag(seg[inner])))
        if lost > slack:
            need = -(-n * percent // 100)
            out.append(mix64(np.partition(x, n - need)[:n - need + 1] ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
    return np.unique(np.concatenate(out)) if out else s[:0]


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common) and common > 0


# --- passes over the documents ----------------------------------------------------------

def set_table(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n (set size), sid (0 for the empty set), sketch."""
    def run(batches):
        for batch in batches:
            rows = [(len(s), set_id(s) if len(s) else 0, parity_sketch(s).tobytes()) for _, s in _sets(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.binary())], names=["doc_id", "n", "sid", "sketch"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .mapInArrow(run, "doc_id long, n long, sid long, sketch binary")


def _pack(sig: np.ndarray, sid: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes, bytes, bytes, bytes]]:
    """Per bucket: 48 signature bits (the rest of the bits chose the bucket), and the sets they
    are of, as ids and run lengths."""
    bucket = ((sig & np.uint64(0xFFFFFFFF)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    order = np.lexsort((sid, bucket))
    sig, sid, bucket = sig[order], sid[order], bucket[order]
    edge = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
    for lo, hi in zip(edge[:-1], edge[1:]):
        ids, runs = sid[lo:hi], np.flatnonzero(np.concatenate([[True], sid[lo + 1:hi] != sid[lo:hi - 1], [True]]))
        key = sig[lo:hi] >> np.uint64(16)
        yield (int(bucket[lo]), (key >> np.uint64(16)).astype(np.uint32).tobytes(), (key & np.uint64(0xFFFF)).astype(np.uint16).tobytes(),
               ids[runs[:-1]].tobytes(), np.diff(runs).astype(np.uint32).tobytes())


_PACKED = "bucket long, high binary, low binary, sids binary, runs binary"


def packed_signatures(docs: DataFrame, buckets: int, percent: int = PERCENT) -> DataFrame:
    """Signatures of the sets, packed per task and bucket; a set that a task meets again is
    not sent again."""
    def run(batches):
        seen: set[int] = set()
        sigs, sids, held = [], [], 0

        def flush():
            rows = list(_pack(np.concatenate(sigs), np.repeat(np.array(sids, np.int64), [len(x) for x in sigs]), buckets))
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()),
                                               *[pa.array([r[i] for r in rows], pa.binary()) for i in range(1, 5)]],
                                              names=["bucket", "high", "low", "sids", "runs"])
        for batch in batches:
            for _, s in _sets(batch):
                if len(s):
                    sid = set_id(s)
                    if sid not in seen:
                        seen.add(sid)
                        sigs.append(signatures(s, percent))
                        sids.append(sid)
                        held += len(sigs[-1])
                if held >= FLUSH_SIGNATURES:
                    yield flush()
                    sigs, sids, held = [], [], 0
        if held:
            yield flush()
    return docs.select("text").mapInArrow(run, _PACKED)


def _bucket_groups(key: np.ndarray, sid: np.ndarray):
    """Sorted distinct (key, sid) of keys with two sets or more, and where each key begins."""
    order = np.lexsort((sid, key))
    key, sid = key[order], sid[order]
    fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (sid[1:] != sid[:-1])])
    key, sid = key[fresh], sid[fresh]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(first, len(key)))
    keep = np.repeat(size > 1, size)
    size = size[size > 1]
    return sid[keep], np.cumsum(size) - size, size


def groups_of(packed: DataFrame, width: int) -> DataFrame:
    """(kind, a, b): kind 0, star links (smallest set of a group, other set); kind 1, members
    (group, set) of groups of three and more, equal groups of a bucket once."""
    def emit(parts):
        key = np.concatenate([np.frombuffer(p[0], np.uint32).astype(np.uint64) << np.uint64(16)
                              | np.frombuffer(p[1], np.uint16) for p in parts])
        sid = np.concatenate([np.repeat(np.frombuffer(p[2], np.int64), np.frombuffer(p[3], np.uint32)) for p in parts])
        sid, first, size = _bucket_groups(key, sid)
        if not len(sid):
            return None
        hub = np.repeat(sid[first], size)
        star = np.unique(np.stack([hub, sid], axis=1)[hub != sid], axis=0)
        name = np.repeat(mix64(np.add.reduceat(mix64(sid.view(np.uint64) ^ np.uint64(_SEED)), first)), size).view(np.int64)
        more = np.repeat(size > 2, size)
        member = np.unique(np.stack([name[more], sid[more]], axis=1), axis=0)
        kind = np.concatenate([np.zeros(len(star), np.int32), np.ones(len(member), np.int32)])
        rows = np.concatenate([star, member])
        return pa.RecordBatch.from_arrays([pa.array(kind), pa.array(rows[:, 0]), pa.array(rows[:, 1])], names=["kind", "a", "b"])

    def run(batches):
        bucket, parts = None, []
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if row[0] != bucket and parts:
                    out = emit(parts)
                    if out is not None:
                        yield out
                    parts = []
                bucket = row[0]
                parts.append(row[1:])
        if parts:
            out = emit(parts)
            if out is not None:
                yield out
    return packed.repartition(width, "bucket").sortWithinPartitions("bucket").mapInArrow(run, "kind int, a long, b long")


def set_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(sid, text) of the wanted sets; one text each, from the document with that id.  A
    sort-merge join at every size: the wanted sets grow with the documents."""
    def run(batches):
        for batch in batches:
            sid = pa.array([set_id(s) if len(s) else 0 for _, s in _sets(batch)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sid, batch.column(1)], names=["doc_id", "sid", "text"])
    every = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")) \
        .mapInArrow(run, "doc_id long, sid long, text string")
    on = every["sid"].eqNullSafe(wanted["sid"]) & every["doc_id"].eqNullSafe(wanted["doc_id"])
    return every.join(wanted.hint("merge"), on).select(every["sid"], "text")


# --- verification -----------------------------------------------------------------------

def plausible(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Distinct (a, b) pairs that sizes and sketches don't rule out."""
    side = lambda x: sets.select(F.col("sid").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"))
    both = pairs.select("a", "b").distinct().join(side("a").hint("merge"), "a").join(side("b").hint("merge"), "b").select("a", "b", "na", "nb", "sa", "sb")

    def run(batches):
        for batch in batches:
            na, nb = (batch.column(c).to_numpy() for c in (2, 3))
            least = np.zeros(batch.num_rows, np.int64)
            for i, (x, y) in enumerate(zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())):
                size = min(len(x), len(y))
                x, y = (folded(np.frombuffer(z, np.uint8), size) for z in (x, y))
                least[i] = np.bitwise_count(x ^ y).sum()
            yield batch.select(["a", "b"]).filter(pa.array(may_link(least, na, nb, percent)))
    return both.mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The (a, b) pairs whose sets link.  Members travel to their hub ``a``; a hub with many members
    is sent to several places, each with a share of them."""
    hubs = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / HUB_MEMBERS).cast("int").alias("salts"))
    members = pairs.join(hubs, "a").select(
        F.col("b").alias("sid"), F.col("a").alias("hub"), F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"), F.lit(1).alias("role"))
    heads = hubs.select(F.col("a").alias("sid"), F.col("a").alias("hub"),
                        F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("role"))
    sent = members.unionByName(heads).join(texts.hint("merge"), "sid")

    def run(batches):
        here, head = None, None
        for batch in batches:
            out = []
            hub, salt, role, sid = (batch.column(c).to_numpy() for c in ("hub", "salt", "role", "sid"))
            for i, s in _sets(batch):
                if (hub[i], salt[i]) != here:
                    here, head = (hub[i], salt[i]), None
                if role[i] == 0:
                    head = s
                elif head is not None and linked(head, s, percent):
                    out.append((int(hub[i]), int(sid[i])))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in (0, 1)], names=["a", "b"])
    width = shuffle_width(pairs.sparkSession)
    return sent.repartition(width, "hub", "salt").sortWithinPartitions("hub", "salt", "role").mapInArrow(run, "a long, b long").distinct()


def across(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose ends are not in one component yet."""
    r = roots.select("node", "root")
    x = pairs.join(r.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a", "left") \
        .join(r.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b", "left")
    return x.where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b")


def _low(col: pa.Array) -> np.ndarray:
    return col.flatten().to_numpy().reshape(-1, LOW)


def _met_before(low: np.ndarray, grp, left, right) -> np.ndarray:
    """Which row pairs have a common group before ``grp`` among their first groups; they are
    compared there."""
    x, y = low[left][:, :, None], low[right][:, None, :]
    return ((x == y) & (x < np.reshape(grp, (-1, 1, 1)))).any(axis=(1, 2))


def group_blocks(members: DataFrame, roots: DataFrame, sets: DataFrame, crossed: bool) -> DataFrame:
    """Members of groups that hold several components, dealt to blocks of about ``BLOCK`` members and at most
    about ``BLOCK_SHINGLES`` shingles: (grp, x, y, second, n, sid, root, sketch, low), where ``low`` are the
    set's first groups.

    Not crossed: every member to its own block.  Crossed, only groups of several blocks: the blocks of the members outside
    the group's largest component meet each other and the blocks of that component, which do not meet
    among themselves; so a group in one component but for a block's worth of sets sends every member
    a constant number of times on average."""
    m = members.join(roots.select(F.col("node").alias("sid"), "root"), "sid", "left") \
        .select("grp", "sid", F.coalesce("root", "sid").alias("root"))
    mixed = m.groupBy("grp").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("grp")
    m = shared_table(m.join(mixed.hint("merge"), "grp").join(sets.select("sid", "n", "sketch").hint("merge"), "sid"), "mixed")
    parts = m.groupBy("grp", "root").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("w"))
    whole = parts.groupBy("grp").agg(F.sum("k").alias("k"), F.sum("w").alias("w"), F.max(F.struct("k", "w", "root")).alias("big"))
    blocks = lambda k, w: F.greatest(F.ceil(k / BLOCK), F.ceil(w / BLOCK_SHINGLES), F.lit(1)).cast("int")
    whole = whole.select("grp", F.col("big.root").alias("big"), blocks(F.col("k"), F.col("w")).alias("blocks"),
                         blocks(F.col("big.k"), F.col("big.w")).alias("inner"),
                         blocks(F.col("k") - F.col("big.k"), F.col("w") - F.col("big.w")).alias("outer"))
    m = m.join((whole.where("blocks > 1") if crossed else whole).hint("merge"), "grp")
    first = F.slice(F.concat(F.array_sort(F.collect_set("grp")), F.array_repeat(F.lit(LAST), LOW)), 1, LOW)
    m = m.join(m.groupBy("sid").agg(first.alias("low")).hint("merge"), "sid")
    place = F.xxhash64("sid")
    if crossed:
        is_big = F.col("root") == F.col("big")
        own = F.when(is_big, F.col("outer") + F.pmod(place, F.col("inner"))).otherwise(F.pmod(place, F.col("outer"))).cast("int")
        others = F.sequence(F.lit(0), F.col("outer") - 1 + F.when(is_big, 0).otherwise(F.col("inner")))
        m = m.withColumn("own", own).withColumn("other", F.explode(others))
    else:
        m = m.withColumn("own", F.pmod(place, F.col("blocks")).cast("int")).withColumn("other", F.col("own"))
    return m.select("grp", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
                    (F.col("own") > F.col("other")).alias("second"), "n", "sid", "root", "sketch", "low")


def _block_pairs(size: np.ndarray, mid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of consecutive blocks: rows of a block with each other (mid 0), or its first
    ``mid`` rows with the others."""
    start = np.cumsum(size) - size
    row = np.arange(int(size.sum()))
    begin, end = np.repeat(start, size), np.repeat(start + size, size)
    cut = np.repeat(start + mid, size)
    one = np.repeat(mid == 0, size)
    lo = np.where(one, row + 1, np.where(row < cut, cut, end))
    n = end - lo
    left = np.repeat(row, n)
    return left, np.repeat(lo, n) + np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n)


def _with_partner(rows: dict, size: np.ndarray, mid: np.ndarray, percent: int) -> np.ndarray:
    """Which rows have a row of another component in their block that sizes and sketches allow and
    that they meet here first."""
    found = np.zeros(len(rows["sid"]), dtype=bool)
    length = np.array([len(x) for x in rows["sketch"]])
    at = 0
    while at < len(size):  # blocks, about PAIRS pairs at a time
        upto = at + max(1, int(np.searchsorted(np.cumsum(size[at:].astype(np.int64) ** 2 // 2 + 1), PAIRS)))
        lo = int(size[:at].sum())
        left, right = _block_pairs(size[at:upto], mid[at:upto])
        left, right = left + lo, right + lo
        ok = rows["root"][left] != rows["root"][right]
        left, right = left[ok], right[ok]
        ok = may_link(np.zeros(len(left), np.int64), rows["n"][left], rows["n"][right], percent)
        left, right = left[ok], right[ok]
        short = np.minimum(length[left], length[right])
        for width in np.unique(short):
            x, y = left[short == width], right[short == width]
            used, inv = np.unique(np.concatenate([x, y]), return_inverse=True)
            bits = np.stack([folded(np.frombuffer(rows["sketch"][i], np.uint8), width) for i in used]).view(np.uint64)
            for c in range(0, len(x), PAIRS // 8):
                i, j = x[c:c + PAIRS // 8], y[c:c + PAIRS // 8]
                least = np.bitwise_count(bits[inv[c:c + len(i)]] ^ bits[inv[len(x) + c:len(x) + c + len(i)]]).sum(axis=1, dtype=np.int64)
                ok = may_link(least, rows["n"][i], rows["n"][j], percent)
                i, j = i[ok], j[ok]
                ok = ~_met_before(rows["low"], rows["grp"][i], i, j)
                found[i[ok]] = found[j[ok]] = True
        at = upto
    return found


def promising(blocks: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The block rows whose sets may link with a set of another component in their block."""
    def run(batches):
        held = None
        for batch in _then_none(batches):
            if batch is not None:
                held = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            if held is None or not held.num_rows:
                continue
            grp, x, y = (held.column(c).to_numpy() for c in ("grp", "x", "y"))
            first = np.flatnonzero(np.concatenate([[True], (grp[1:] != grp[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])]))
            done = held.num_rows if batch is None else int(first[-1])  # the last block may go on
            if done:
                size = np.diff(np.append(first, held.num_rows))[:len(first) if batch is None else -1]
                part = held.slice(0, done)
                second = part.column("second").to_numpy(zero_copy_only=False)
                start = first[:len(size)]
                # rows of the first block; a block pair without rows from both has no pairs
                mid = np.where(x[start] == y[start], 0, size - np.add.reduceat(second.astype(np.int64), start))
                keep = (x[start] == y[start]) | ((mid > 0) & (mid < size))
                part = part.filter(pa.array(np.repeat(keep, size)))
                rows = {c: part.column(c).to_numpy() for c in ("grp", "n", "sid", "root")} \
                    | {"sketch": part.column("sketch").to_pylist(), "low": _low(part.column("low"))}
                found = _with_partner(rows, size[keep], mid[keep], percent)
                yield part.select(["grp", "x", "y", "second", "sid", "root", "low"]).filter(pa.array(found))
            held = None if batch is None else held.slice(done)
    return blocks.repartition(shuffle_width(blocks.sparkSession), "grp", "x", "y").sortWithinPartitions("grp", "x", "y", "second", "sid") \
        .mapInArrow(run, "grp long, x int, y int, second boolean, sid long, root long, low array<long>")


def block_links(grp: int, second: np.ndarray, sid: np.ndarray, root: np.ndarray, low: np.ndarray, sets: list[np.ndarray],
                crossed: bool, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links between components of one block, exactly verified: a spanning set, so fewer than the block has
    rows.  Crossed: only rows of the first block with rows of the second, which come last."""
    n = np.array([len(s) for s in sets])
    _, label = np.unique(root, return_inverse=True)
    known, code = np.unique(np.concatenate(sets), return_inverse=True)
    start = np.cumsum(n) - n
    sketches = [parity_sketch(s) for s in sets]
    width = min(len(x) for x in sketches)
    bits = np.stack([folded(x, width) for x in sketches]).view(np.uint64)
    here = np.zeros(len(known), dtype=bool)
    cut = int((~second).sum())
    out = []
    for i in range(cut if crossed else len(sets)):
        js = np.arange(cut if crossed else i + 1, len(sets))
        js = js[label[js] != label[i]]
        js = js[may_link(np.bitwise_count(bits[i] ^ bits[js]).sum(axis=1, dtype=np.int64), n[i], n[js], percent)]
        js = js[~_met_before(low, grp, np.full(len(js), i), js)]
        if not len(js):
            continue
        mine = code[start[i]:start[i] + n[i]]
        here[mine] = True
        first = np.cumsum(n[js]) - n[js]
        common = np.add.reduceat(here[code[np.repeat(start[js] - first, n[js]) + np.arange(int(n[js].sum()))]], first, dtype=np.int64)
        here[mine] = False
        for j in js[(100 * common >= percent * (n[i] + n[js] - common)) & (common > 0)]:
            if label[j] != label[i]:
                out.append((int(sid[i]), int(sid[j])))
                label[label == label[j]] = label[i]
    return out


def group_links(members: DataFrame, roots: DataFrame, sets: DataFrame, texts: DataFrame, percent: int = PERCENT,
                crossed: bool = False) -> DataFrame:
    """(a, b) links that join the components inside the blocks of every group.  Sketches find the sets that
    have a possible partner in their block; only these send their text there, and a block puts out
    a spanning set of its links."""
    sent = promising(group_blocks(members, roots, sets, crossed), percent)

    def run(batches):
        name, rows, held = None, [], []
        for batch in _then_none(batches):
            out = []
            if batch is not None:
                keys = list(zip(*[batch.column(c).to_pylist() for c in ("grp", "x", "y")]))
                rest = list(zip(*[batch.column(c).to_pylist() for c in ("second", "sid", "root")]))
                low = _low(batch.column("low"))
            for i, s in (_sets(batch) if batch is not None else [(None, None)]):
                if i is None or keys[i] != name:
                    if len(held) > 1:
                        second, sid, root, first = (np.array([r[c] for r in rows]) for c in range(4))
                        out += block_links(name[0], second, sid, root, first, held, name[1] != name[2], percent)
                    name, rows, held = None if i is None else keys[i], [], []
                if i is not None:
                    rows.append((*rest[i], low[i]))
                    held.append(s)
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in (0, 1)], names=["a", "b"])
    return sent.join(texts.hint("merge"), "sid").repartition(shuffle_width(sent.sparkSession), "grp", "x", "y") \
        .sortWithinPartitions("grp", "x", "y", "second", "sid").mapInArrow(run, "a long, b long").distinct()


def _then_none(batches):
    yield from batches
    yield None


def link_components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, sid, component_id."""
    return _linked(docs, percent).drop("stays")


def _linked(docs: DataFrame, percent: int) -> DataFrame:
    """The components, and whether a row is the one that stands for its component: that of the smallest
    (doc_id, sid), ids before nulls.  Empty texts stand for themselves."""
    spark = docs.sparkSession
    width = shuffle_width(spark)
    table = shared_table(set_table(docs), "sets")
    full = table.where("n > 0")
    total = full.agg(F.sum("n")).first()[0] or 0
    buckets = max(width, -(-int(total) // (2 * BUCKET_SIGNATURES)))
    found = shared_table(groups_of(packed_signatures(docs, buckets, percent), width), "groups")
    star = found.where("kind = 0").select("a", "b").distinct()
    members = found.where("kind = 1").select(F.col("a").alias("grp"), F.col("b").alias("sid")).distinct()
    nodes = shared_table(full.groupBy("sid").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"),
                                                 F.first("sketch").alias("sketch")), "nodes")
    star = shared_table(star, "star")
    hubs = shared_table(plausible(star.groupBy("b").agg(F.min("a").alias("a")), nodes, percent), "hubs")
    shared = star.select(F.col("a").alias("sid")).unionByName(star.select(F.col("b").alias("sid"))).distinct()
    texts = shared_table(set_texts(docs, nodes.join(shared, "sid").select("sid", "doc_id")), "texts")
    roots = forest_roots(verified(hubs, texts, percent).select(F.col("b").alias("node"), F.col("a").alias("up")))
    rest = shared_table(plausible(across(star, roots), nodes, percent), "star-rest")
    roots = merge_roots(roots, shared_table(verified(rest, texts, percent), "links-star"))
    roots = merge_roots(roots, shared_table(group_links(members, roots, nodes, texts, percent), "links-blocks"))
    roots = merge_roots(roots, shared_table(group_links(members, roots, nodes, texts, percent, crossed=True), "links-crossed"))
    least = nodes.join(roots.select(F.col("node").alias("sid"), "root"), "sid", "left") \
        .select("sid", "doc_id", F.coalesce("root", "sid").alias("root"))
    best = least.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "sid")).alias("best"))
    least = least.join(best, "root").select("sid", F.col("best.doc_id").alias("component_id"), F.col("doc_id").alias("least_id"),
                                            (F.col("sid") == F.col("best.sid")).alias("first"))
    stays = (F.col("n") == 0) | (F.col("first") & F.col("doc_id").eqNullSafe(F.col("least_id")))
    return table.join(least, "sid", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), "sid", F.coalesce("component_id", "doc_id").alias("component_id"), stays.alias("stays"))


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group of linked documents: the one with the
    smallest doc_id, and of several such the smallest set id; one without an id if none has one.
    Rows are told apart by (doc_id, set), so unlinked texts under one id all stay."""
    linked = shared_table(_linked(docs, percent), "linked")
    stay, named = linked.where("stays"), linked.where("doc_id is not null")
    ids = stay.where("doc_id is not null").select("doc_id").hint("merge")
    out = docs.join(ids, "doc_id", "left_semi").select(*docs.columns)
    many = named.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"), F.max("stays").alias("any")).where("rows > 1 and any").select("doc_id")
    many = shared_table(many, "repeated")
    if many.isEmpty() and linked.where("doc_id is null").isEmpty():
        return out

    def with_set(batches):
        for batch in batches:
            sid = pa.array([set_id(s) if len(s) else 0 for _, s in _sets(batch)], pa.int64())
            blank = pa.array([not len(s) for _, s in _sets(batch)], pa.bool_())
            yield pa.RecordBatch.from_arrays([*batch.columns, sid, blank], names=[*batch.schema.names, "__sid", "__blank"])

    unclear = docs.join(many.hint("merge"), "doc_id", "left_semi").select(*docs.columns).unionByName(docs.where("doc_id is null"))
    rows = unclear.mapInArrow(with_set, T.StructType([*docs.schema.fields, T.StructField("__sid", T.LongType()), T.StructField("__blank", T.BooleanType())]))
    wanted = stay.select(F.col("doc_id").alias("__id"), F.when(F.col("n_shingles") == 0, 0).otherwise(F.col("sid")).alias("__set")).hint("merge")
    rows = rows.join(wanted, rows["__sid"].eqNullSafe(wanted["__set"]) & rows["doc_id"].eqNullSafe(wanted["__id"]), "left_semi")
    alone = F.col("doc_id").isNull() & F.col("__blank")
    rows = rows.where(~alone).dropDuplicates(["doc_id", "__sid"]).unionByName(rows.where(alone)).select(*docs.columns)
    return out.join(many.hint("merge"), "doc_id", "left_anti").select(*docs.columns).unionByName(rows)
