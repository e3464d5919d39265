"""Language identification of mixed texts (operator 5).

Method.  Every word gets a score per language: the sum of its letter-trigram log
likelihoods (trigrams of the word with its borders, hashed into ``BUCKETS``).  The
script of the word (code point ranges) narrows the candidates to languages seen in
that script.  A Viterbi pass over the words of a text finds the labelling with the
best sum of scores less ``SWITCH`` per change of language; runs of equal labels are the
spans.  A text's language is the one that labels most of its bytes in words with
letters, its score that share.

Fitting.  Labelled rows only, and of these a bounded sample: rows whose hash falls under
``SAMPLE_DOCS / (rows of the language)``, about ``SAMPLE_DOCS`` whole texts per language.
The model (languages x ``BUCKETS`` floats, languages x scripts flags) doesn't grow with the
data.  Prediction reads whole texts; lang, source and doc_id are not its inputs.

Memory in a task: the words of one Arrow batch are scored in chunks of text, and the
Viterbi pass walks all texts of up to ``LATTICE`` word scores side by side (or one
longer text).

Defined results: null text or text without a letter gives ``und`` with score 0 and no
spans; ties go to the language that sorts first; if there is no labelled row
every text is ``und``; other columns pass through, result names replace clashing ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.text import byte_chunks, split_words, text_column

BUCKETS = 1 << 16
SAMPLE_DOCS = 1000
SMOOTH = 0.3
SWITCH = 10.0
MIN_SCRIPT_SHARE = 0.005
OUTSIDE = 30.0
LATTICE = 2_000_000
#: bytes of text that are scored together: a byte takes one row of scores per language while they are added up
TEXT_BYTES = 1 << 18
UNKNOWN = "und"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Unicode ranges of scripts (fixed values)
SCRIPTS = [
    ("latin", 0x41, 0x5A), ("latin", 0x61, 0x7A), ("latin", 0xC0, 0x24F), ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F), ("armenian", 0x530, 0x58F), ("hebrew", 0x590, 0x5FF),
    ("arabic", 0x600, 0x77F), ("devanagari", 0x900, 0x97F), ("bengali", 0x980, 0x9FF), ("tamil", 0xB80, 0xBFF),
    ("thai", 0xE00, 0xE7F), ("georgian", 0x10A0, 0x10FF), ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
]
SCRIPT_NAMES = list(dict.fromkeys(n for n, _, _ in SCRIPTS))


def _pair_scripts() -> np.ndarray:
    """Script number (0: none) by the first two UTF-8 bytes of a character."""
    out = np.zeros(65536, dtype=np.uint8)
    for name, lo, hi in SCRIPTS:
        k = SCRIPT_NAMES.index(name) + 1
        step = 1 if hi < 0x800 else 64
        for cp in [*range(lo, hi + 1, step), hi]:
            b = chr(cp).encode("utf-8", "surrogatepass")
            if len(b) == 1:
                out[b[0] * 256:b[0] * 256 + 256] = k
            else:
                out[b[0] * 256 + b[1]] = k
    return out


_SCRIPT_OF = _pair_scripts()


@dataclass
class LanguageModel:
    langs: list[str]
    table: np.ndarray     # (BUCKETS + 1, languages): the last row, for no trigram, is 0
    allowed: np.ndarray   # (scripts + 1, languages)


@dataclass
class Scored:
    """Trigram codes and scripts of the words of some rows."""

    row: np.ndarray       # row of each word
    start: np.ndarray     # its place in code points of the row
    end: np.ndarray
    size: np.ndarray      # bytes of the word if it has a letter, else 0
    script: np.ndarray
    codes: np.ndarray     # trigram bucket per byte, from the first word on
    cuts: np.ndarray      # where each word's codes begin


def _scan_words(raw: np.ndarray, off: np.ndarray) -> Scored:
    n = len(off) - 1
    row_of = np.repeat(np.arange(n), np.diff(off))
    buf = np.full(len(raw) + n + 1, 0x20, dtype=np.uint8)
    buf[np.arange(len(raw)) + row_of] = _LOWER[raw]
    moved = off + np.arange(n + 1)
    w = split_words(0, n, buf, np.append(moved[:-1], len(buf)))
    if not len(w.starts):
        none = np.zeros(0, dtype=np.int64)
        return Scored(none, none, none, none, none, none, none)
    space = buf <= 0x20
    b = np.where(space, 0x20, buf).astype(np.uint32)
    one, two = np.full(len(b), 0x20, np.uint32), np.full(len(b), 0x20, np.uint32)
    one[1:], two[2:] = b[:-1], b[:-2]
    two[one == 0x20] = 0x20
    codes = (((b | one << 8 | two << 16) * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int32)
    codes[(b == 0x20) & (one == 0x20)] = BUCKETS
    nxt = np.zeros(len(b), np.uint32)
    nxt[:-1] = b[1:]
    script = _SCRIPT_OF[b << 8 | nxt]
    row = np.searchsorted(moved, w.starts, side="right") - 1
    letters = np.cumsum((buf & 0xC0) != 0x80)
    base = np.where(moved[row] > 0, letters[np.maximum(moved[row], 1) - 1], 0)
    cuts = w.starts - w.starts[0]
    word_script = np.maximum.reduceat(script[w.starts[0]:], cuts)
    size = w.ends - w.starts
    return Scored(row, letters[w.starts] - 1 - base, letters[w.ends - 1] - base,
                  np.where((word_script > 0) | (np.maximum.reduceat(buf[w.starts[0]:], cuts) >= 0xC3), size, 0),
                  word_script, codes[w.starts[0]:], cuts)


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram and script counts of labelled texts, per language, of a partition."""
    grams: dict[str, np.ndarray] = {}
    scripts: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column(batch.schema.get_field_index("lang")).to_pylist(), dtype=object)
        for lo, hi, raw, off in byte_chunks(text_column(batch, "text")):
            s = _scan_words(raw, off)
            if not len(s.row):
                continue
            of_code = np.repeat(s.row, np.diff(np.append(s.cuts, len(s.codes))))
            for lang in set(langs[lo:hi]):
                mine = langs[lo:hi] == lang
                grams.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))[:] += np.bincount(s.codes[mine[of_code]], minlength=BUCKETS + 1)
                scripts.setdefault(lang, np.zeros(len(SCRIPT_NAMES) + 1, np.int64))[:] += np.bincount(
                    s.script[mine[s.row]], minlength=len(SCRIPT_NAMES) + 1)
    rows = [(lang, kind, int(i), int(c[i])) for kind, every in ((0, grams), (1, scripts))
            for lang, c in every.items() for i in np.flatnonzero(c)]
    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()),
                                      pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.int64())],
                                     names=["lang", "kind", "at", "n"])


def fit(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS) -> LanguageModel:
    """Model from (doc_id, text, lang) rows: about ``sample_docs`` whole texts a language."""
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return LanguageModel([], np.zeros((BUCKETS + 1, 0), np.float32), np.zeros((len(SCRIPT_NAMES) + 1, 0), bool))
    langs = sorted(sizes)
    u = (F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("language")) % 1_000_000 + 1_000_000) % 1_000_000
    share = F.element_at(F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(1e6 * sample_docs / sizes[k]))]), F.col("lang"))
    counts = rows.where(u < share).mapInArrow(_count_rows, "lang string, kind int, at int, n long") \
        .groupBy("lang", "kind", "at").agg(F.sum("n").alias("n")).toArrow()
    lang = np.searchsorted(np.array(langs, dtype=object), np.array(counts.column("lang").to_pylist(), dtype=object))
    kind, at, n = (counts.column(c).to_numpy() for c in ("kind", "at", "n"))
    grams = np.zeros((BUCKETS + 1, len(langs)))
    scripts = np.zeros((len(SCRIPT_NAMES) + 1, len(langs)))
    grams[at[kind == 0], lang[kind == 0]] = n[kind == 0]
    scripts[at[kind == 1], lang[kind == 1]] = n[kind == 1]
    grams[BUCKETS] = 0
    logp = np.log((grams + SMOOTH) / (grams.sum(axis=0) + SMOOTH * BUCKETS))
    logp -= logp.mean(axis=1, keepdims=True)
    logp[BUCKETS] = 0
    allowed = scripts >= MIN_SCRIPT_SHARE * np.maximum(scripts[1:].sum(axis=0), 1)
    allowed[0] = True
    allowed[~allowed.any(axis=1)] = True
    return LanguageModel(langs, logp.astype(np.float32), allowed)


def word_scores(s: Scored, model: LanguageModel) -> np.ndarray:
    if not len(s.row):
        return np.zeros((0, len(model.langs)), np.float32)
    out = np.add.reduceat(model.table[s.codes], s.cuts, axis=0)
    out[s.size == 0] = 0
    return np.where(model.allowed[s.script], out, out - np.float32(OUTSIDE))


def viterbi(scores: np.ndarray, first: np.ndarray, penalty: float = SWITCH) -> np.ndarray:
    """Best labels of many sequences at once: sequence i has rows first[i]..first[i+1]-1.

    Sequences advance side by side, longest first, so step t touches only those
    that are longer than t."""
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    begin, length = first[:-1][order], length[order]
    label = np.zeros(len(scores), dtype=np.int16)
    steps = int(length[0]) if len(length) else 0
    if not steps:
        return label
    live = np.searchsorted(-length, -np.arange(steps), side="left")  # sequences longer than t
    stay = np.ones(scores.shape, dtype=bool)
    lead = np.zeros(len(scores), dtype=np.int16)
    v = scores[begin[:live[0]]].astype(np.float64)
    lead[begin[:live[0]]] = v.argmax(axis=1)
    for t in range(1, steps):
        n = live[t]
        at = begin[:n] + t
        v = v[:n]
        top = v.max(axis=1, keepdims=True) - penalty
        stay[at] = v >= top
        v = np.maximum(v, top) + scores[at]
        v -= v.max(axis=1, keepdims=True)
        lead[at] = v.argmax(axis=1)
    now = np.zeros(len(begin), dtype=np.int16)
    for t in range(steps - 1, -1, -1):
        n = live[t]
        at = begin[:n] + t
        fresh = live[t + 1] if t + 1 < steps else 0
        now[fresh:n] = lead[at[fresh:]]
        if fresh:
            after = at[:fresh] + 1
            now[:fresh] = np.where(stay[after, now[:fresh]], now[:fresh], lead[at[:fresh]])
        label[at] = now[:n]
    return label


SPANS = pa.list_(pa.struct([("lang", pa.string()), ("begin", pa.int64()), ("end", pa.int64())]))


def _spans_of(names: np.ndarray, row: np.ndarray, label: np.ndarray, start: np.ndarray, end: np.ndarray, n: int) -> pa.Array:
    """Runs of words of one row and label as a list array over n rows."""
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (label[1:] != label[:-1])
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(row))[:len(at)] - 1
    runs = pa.StructArray.from_arrays([pa.array(names[label[at]].tolist(), pa.string()), pa.array(start[at], pa.int64()),
                                       pa.array(end[last], pa.int64())], names=["lang", "begin", "end"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row[at], np.arange(n + 1)), pa.int32()), runs)


def _decide(parts: list[Scored], scores: list[np.ndarray], n: int, letters: np.ndarray, model: LanguageModel):
    """Language, score and spans of n rows from the scored words of all of them."""
    k, names = len(model.langs), np.array(model.langs + [UNKNOWN], dtype=object)
    row = np.concatenate([p.row for p in parts] or [np.zeros(0, np.int64)]).astype(np.int64)
    label = viterbi(np.concatenate(scores), np.searchsorted(row, np.arange(n + 1))).astype(np.int64) if len(row) and k else np.zeros(len(row), np.int64)
    size = np.concatenate([p.size for p in parts] or [np.zeros(0)])
    share = np.bincount(row * k + label, weights=size, minlength=n * k).reshape(n, k) if len(row) and k else np.zeros((n, max(k, 1)))
    best, total = share.argmax(axis=1), share.sum(axis=1)
    known = letters & (k > 0)
    pred = names[np.where(known, best, k)]
    score = np.where(known & (total > 0), share.max(axis=1) / np.maximum(total, 1), 0.0)
    keep = known[row] if len(row) else np.zeros(0, bool)
    start = np.concatenate([p.start for p in parts] or [np.zeros(0, np.int64)])
    end = np.concatenate([p.end for p in parts] or [np.zeros(0, np.int64)])
    return pred, score, _spans_of(names, row[keep], label[keep], start[keep], end[keep], n)


def _has_letter(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    ascii_letter = np.concatenate([[0], np.cumsum(((raw | 0x20) >= 97) & ((raw | 0x20) <= 122) & (raw < 128))])
    out = ascii_letter[off[1:]] > ascii_letter[off[:-1]]
    for i in np.flatnonzero(~out & (np.diff(off) > 0)):
        out[i] = any(c.isalpha() for c in raw[off[i]:off[i + 1]].tobytes().decode("utf-8", "replace"))
    return out


def label_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` (text, ..) with lang_pred, lang_score and lang_spans (language, begin, end in
    code points of the text, end exclusive)."""
    kept = docs.select(*[c for c in docs.columns if c not in ("lang_pred", "lang_score", "lang_spans")])
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.table, model.allowed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = LanguageModel(*shared.value)
        limit = max(1, LATTICE // max(1, len(m.langs)))

        def out(batch, lo, hi, parts, scores, letters):
            pred, score, spans = _decide(parts, scores, hi - lo, np.concatenate(letters), m)
            part = batch.slice(lo, hi - lo)
            return pa.RecordBatch.from_arrays([*part.columns, pa.array(pred.tolist(), pa.string()), pa.array(score, pa.float64()), spans],
                                              names=[*batch.schema.names, "lang_pred", "lang_score", "lang_spans"])

        for batch in batches:
            since, words, parts, scores, letters = 0, 0, [], [], []
            for lo, hi, raw, off in byte_chunks(text_column(batch, "text"), TEXT_BYTES):
                s = _scan_words(raw, off)
                s.row = s.row + (lo - since)
                parts.append(s)
                scores.append(word_scores(s, m))
                s.codes = s.cuts = None
                letters.append(_has_letter(raw, off))
                words += len(s.row)
                if words >= limit or hi == batch.num_rows:
                    yield out(batch, since, hi, parts, scores, letters)
                    since, words, parts, scores, letters = hi, 0, [], [], []

    schema = T.StructType([*kept.schema.fields, *T._parse_datatype_string(
        "lang_pred string, lang_score double, lang_spans array<struct<lang:string,begin:long,end:long>>").fields])
    return kept.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id's text, modulo 3, is 1: rows never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fit_documents(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> LanguageModel:
    return fit(docs.where(~held_out(F.col("doc_id"))), sample_docs)
