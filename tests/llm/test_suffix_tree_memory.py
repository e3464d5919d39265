"""What the passes of the suffix tree hold at once, and that pieces do not change what they return."""

import collections
import math
import tracemalloc
import types

import numpy as np
import pyarrow as pa
import pytest

from basketry.llm import suffix_tree as st

MB = 1 << 20
BUCKETS = 16


class Sent:
    def __init__(self, value):
        self.value = value


@pytest.fixture(autouse=True)
def task(monkeypatch):
    monkeypatch.setattr("pyspark.TaskContext.get", lambda: types.SimpleNamespace(partitionId=lambda: 3))


@pytest.fixture(scope="module")
def rare():
    """10,000 rows, 20 MB, a million and a half words with few repeats."""
    rng = np.random.default_rng(1)
    letters = (rng.integers(0, 26, (10_000, 150, 13)) + 97).astype(np.uint8)
    letters[:, :, 12] = 32
    texts = [x.tobytes().decode() for x in letters]
    return pa.RecordBatch.from_arrays([pa.array(range(10_000), pa.int64()), pa.array([i % 10 == 0 for i in range(10_000)]), pa.array(texts)],
                                      names=["doc_id", "held_out", "text"])


def peak(batches):
    tracemalloc.start()
    try:
        n = sum(b.num_rows for b in batches)
        return n, tracemalloc.get_traced_memory()[1] / MB
    finally:
        tracemalloc.stop()


def score_pass(hot_grams=((), ()), hot=((), ())):
    arrays = [np.array(x, t) for x, t in zip((*hot_grams, *hot), (np.uint64, np.float32, np.uint64, np.int64))]
    return st._score_pass(st.DEPTH, Sent(tuple(arrays[:2])), (Sent(arrays[2]), Sent(arrays[3])), BUCKETS)


def test_counting_holds_a_bounded_number_of_codes(rare):
    rows, mb = peak(st._count_pass(st.DEPTH)(iter([rare.select(["text", "held_out"])])))
    assert rows > 10_000_000 and mb < 120


def test_scoring_sends_rare_words_and_grams_in_pieces(rare):
    rows, mb = peak(score_pass()(iter([rare])))
    assert rows > 2 * BUCKETS and mb < 80


def test_a_bucket_reads_its_grams_in_place():
    rng = np.random.default_rng(2)
    code = np.unique(rng.integers(0, 1 << 50, 100_000).astype(np.uint64))
    rows = [(BUCKETS, -1, st._ANSWERS, code.tobytes(), np.full(len(code), -1, np.float32).tobytes(), b"", b"")]
    rows += [(BUCKETS, i, st._GRAMS, rng.choice(code, 20_000).tobytes(), np.arange(20_000, dtype=np.uint32).tobytes(), b"", b"") for i in range(200)]
    batch = st._packed(rows)
    rows.clear()
    got, mb = peak(st._bucket_pass(iter([batch])))
    assert got == 200 and mb < 50


def whole(batches, model):
    """All three passes in this process."""
    names = [x.split()[0] for x in st._ROWS.split(", ")]
    packed = [r for b in model(iter(batches)) for r in b.to_pylist()]
    seen = sorted({int(c) for r in packed if r["kind"] == st._GRAMS for c in np.frombuffer(r["a"], np.uint64)})
    answers = pa.RecordBatch.from_arrays([pa.array(np.array(seen, np.uint64).view(np.int64)), pa.array(np.array([-1 - c % 7 / 8 for c in seen], np.float32))],
                                         names=["code", "logp"])
    packed += [r for b in st._answers(BUCKETS)(iter([answers])) for r in b.to_pylist()]
    packed.sort(key=lambda r: (r["place"], r["batch"], r["kind"]))
    sums = [r for b in st._bucket_pass(iter([st._packed([tuple(r[n] for n in names) for r in packed])])) for r in b.to_pylist()]
    sums.sort(key=lambda r: (r["batch"], r["kind"], r["place"]))
    return [r for b in st._batch_pass(iter([st._packed([tuple(r[n] for n in names) for r in sums])])) for r in b.to_pylist()]


def test_pieces_do_not_change_what_is_counted_and_summed(monkeypatch):
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.3, rng.integers(0, 60)) % 5000) for _ in range(300)] + [None, "", " "]
    held = [i % 7 == 0 for i in range(len(texts))]
    ids = [None, *range(1, len(texts))]
    batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(held), pa.array(texts)], names=["doc_id", "held_out", "text"])
    one = whole([batch], score_pass())
    for name, value in (("PIECE_BYTES", 300), ("COLD_ROWS", 40), ("SEND_PARTS", 2)):
        monkeypatch.setattr(st, name, value)
    assert sum(b.num_rows for b in score_pass()(iter([batch]))) > 10 * BUCKETS
    many = whole([batch], score_pass())
    count = collections.Counter(w for t, h in zip(texts, held) if not h for w in (t or "").split())
    assert len(one) == len(many) == len(texts)
    for a, b, t, h, i in zip(one, many, texts, held, ids):
        words = (t or "").split()
        assert (a["doc_id"], a["held_out"], a["n_tokens"], a["n_known"]) == (b["doc_id"], b["held_out"], b["n_tokens"], b["n_known"]) \
            == (i, h, len(words) + 1, sum(count[w] > 0 for w in words))
        assert math.isclose(a["raw_base"], b["raw_base"]) and math.isclose(a["score"], b["score"])
        assert math.isclose(a["raw_base"], sum(math.log10(count[w] + 0.1) for w in words), abs_tol=1e-9)


def test_what_a_counter_sends_adds_up(monkeypatch):
    monkeypatch.setattr(st, "FRESH_ROWS", 500)
    monkeypatch.setattr(st, "HELD_ROWS", 300)
    rng = np.random.default_rng(4)
    counter, want, got, seen, sent = st._Counter(), collections.Counter(), collections.Counter(), set(), 0
    for k in range(60):
        codes = (rng.zipf(1.2, rng.integers(0, 200)) % 4000).astype(np.uint64)
        weight = k % 3 and 1
        seen.update(codes.tolist())
        want.update({c: n * weight for c, n in collections.Counter(codes.tolist()).items()})
        out = [counter.add(codes, weight)] + ([counter.drain()] if k == 59 else [])
        for code, n in [x for x in out if x is not None]:
            assert (np.diff(code.astype(np.int64)) > 0).all()
            sent += 1
            got.update(dict(zip(code.tolist(), n.tolist())))
    assert sent > 3 and seen == set(got) and got == want
