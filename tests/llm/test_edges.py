"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib

import pytest

from basketry.llm import (chat, decontaminate, hamming, html_text, language, mixing, secrets, shingle_join,
                          suffix_tree, url_rules)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 97} of the {i % 13}" for i in range(30_000))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(0, None, None, None, None), (1, "", "en", "a", 0), (2, " \t\n ", "en", "a", 4), (3, "one", "en", None, 3),
            (4, "alpha beta gamma delta epsilon zeta", "en", "b", 35), (4, "alpha beta gamma delta epsilon zeta", "en", "b", 35),
            (5, "alpha beta gamma delta epsilon zeta", "de", "b", 35), (6, LONG, "en", "c", len(LONG)), (None, "no id here at all", "en", "c", 17),
            (7, "1234 5678 !!! ---", "en", "a", 17), (8, "\x00\x00 ünïcödé ÀÉ 漢字 text", "fr", "a", 20)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def by_id(rows):
    out = {}
    for r in rows:
        out.setdefault(r["doc_id"], []).append(r)
    return out


def test_jaccard(docs, none):
    assert shingle_join.link_components(none).count() == 0
    got = by_id(shingle_join.link_components(docs).collect())
    assert sum(map(len, got.values())) == 11
    assert {i: (r[0].n_shingles, r[0].component_id) for i, r in got.items()} == {
        0: (0, 0), 1: (0, 1), 2: (0, 2), 3: (1, 3), 4: (2, 4), 5: (2, 4), 6: (got[6][0].n_shingles, 6), None: (1, None), 7: (1, 7), 8: (1, 8)}
    kept = shingle_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, i) for i in (0, 1, 2, 3, 4, 6, 7, 8)] + [(True, 0)]


def test_keep_one_tells_rows_apart_by_id_and_text(spark):
    a, b, c, d, e = (" ".join(f"{x}{i}" for i in range(30)) for x in "abcde")
    rows = [(1, a), (1, b), (2, a), (3, c), (4, c), (4, d), (4, d), (None, e), (None, e), (None, a), (None, ""), (None, " "), (5, ""), (5, "")]
    kept = shingle_join.keep_one(spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)).collect()
    assert sorted((r.doc_id or 0, r.text.strip()) for r in kept) == [(0, ""), (0, ""), (0, e), (1, a), (1, b), (3, c), (4, d), (5, "")]


def test_lm_scores(docs, none):
    assert suffix_tree.score_documents(none).count() == 0
    rows = suffix_tree.score_documents(docs.withColumnRenamed("n_chars", "score")).collect()
    assert len(rows) == 11
    got = by_id(rows)
    assert got[0][0].n_tokens == got[1][0].n_tokens == got[2][0].n_tokens == 1
    assert got[6][0].n_tokens == len(LONG.split()) + 1
    assert all(r.score < 0 and r.base_score < 0 for r in rows)
    assert len({r.train_tokens for r in rows}) == 1
    assert got[4][0] == got[4][1]


def test_language(docs, none, spark):
    empty = language.fit_documents(none)
    assert [r.lang_pred for r in language.label_languages(docs, empty).collect()] == ["und"] * 11
    model = language.fit_documents(docs)
    assert language.label_languages(none, model).count() == 0
    out = language.label_languages(docs.withColumnRenamed("n_chars", "lang_score"), model)
    assert out.columns == ["doc_id", "text", "lang", "source", "lang_pred", "lang_score", "lang_spans"]
    got = by_id(out.collect())
    assert [got[i][0].lang_pred for i in (0, 1, 2, 7)] == ["und"] * 4
    assert got[0][0].lang_spans == [] and got[6][0].lang_pred in model.langs
    assert all(0 <= r.lang_score <= 1 for rs in got.values() for r in rs)
    spans = got[6][0].lang_spans
    assert spans[0].begin == 0 and spans[-1].end == len(LONG)


def test_mixing(docs, none, spark):
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 0), (None, 1, 1), (6, 0, 0)], "doc_id long, quality int, toxic int")
    assert mixing.mix_plan(none, labels).count() == 0
    rows = mixing.mix_plan(docs.withColumnRenamed("n_chars", "taken"), labels).collect()
    assert len(rows) == 11
    per = {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r["size"]
        per.setdefault(r.source, [r.target, 0, r.source_size])[1] += r.taken
    for target, taken, size in per.values():
        assert target <= 2 * size and target - 2 < taken <= target
    out = mixing.mix_sources(docs, labels)
    assert out.columns == [*docs.columns, "size", "source_size", "target", "epochs", "taken"]
    assert out.where("taken = 0").count() == 0
    assert sorted(r.taken for r in out.collect()) == sorted(r.taken for r in rows if r.taken)


def test_secrets(docs, none, spark):
    assert secrets.digest(secrets.scan(none)).count() == 0
    rows = secrets.digest(secrets.scan(docs.withColumnRenamed("n_chars", "spans"))).collect()
    assert len(rows) == 11 and all(r.spans == "" for r in rows)
    assert {r.base_sha256 for r in rows} == {hashlib.sha256(b"").hexdigest()}
    assert sorted(map(str, secrets.redact(docs).collect())) == sorted(map(str, docs.collect()))


def test_decontamination(docs, none, spark):
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta"), (1, "alpha beta gamma delta epsilon zeta"), (2, None), (3, ""),
                                   (4, "!!"), (None, "no id here at all")], "item_id long, text string")
    assert decontaminate.contaminated(none, items).count() == 0
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0
    rows = decontaminate.contaminated(docs, items).collect()
    assert sorted(r.doc_id for r in rows if r.item_id == 1) == [4, 4, 4, 4, 5, 5]
    assert [(r.doc_id, r.edits, r.begin, r.end) for r in rows if r.item_id is None] == [(None, 0, 0, 17)]
    left = decontaminate.drop_contaminated(docs.withColumnRenamed("n_chars", "hits"), items)
    assert left.count() == 7


def test_urls(spark):
    pages = spark.createDataFrame([(1, None, "x"), (2, "no scheme", "x"), (3, "http://A.Example.ORG/es/x?y#z", "x"), (3, "http://A.Example.ORG/es/x?y#z", "x"),
                                   (4, "http://example.org", "x"), (5, "x://b.com/fr/", "x"), (6, "http://com.net/fr/", "x"), (7, "://", "x"),
                                   (8, "http://" + "a." * 3000 + "org/" + "p" * 50_000, "x")], "page_id long, url string, verdict string")
    rules = url_rules.rule_table(spark)
    got = url_rules.judge_urls(pages, rules)
    assert got.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    assert sorted((r.page_id, r.rule, r.verdict) for r in got.collect() if r.rule) == [
        (3, "example.org/es/", "block"), (3, "example.org/es/", "block"), (5, "com/fr/", "allow"), (8, "org/", "allow")]
    assert {(r.host, r.path) for r in got.collect() if r.page_id in (1, 2, 7)} == {("", "")}
    assert got.where("rule is null and verdict = 'allow'").count() == 5
    assert url_rules.judge_urls(pages.limit(0), rules).count() == 0
    assert url_rules.judge_urls(pages, rules.limit(0)).where("rule is null").count() == 9
    odd = spark.createDataFrame([(None, "/x", "block"), ("ORG", None, "allow"), ("org", "/", "allow"), ("org", "/", "block")], "host string, path string, verdict string")
    assert {(r.page_id, r.rule, r.verdict) for r in url_rules.judge_urls(pages, odd).collect() if r.rule} == {
        (3, "org/", "block"), (4, "org", "allow"), (8, "org/", "block")}


def test_chat(spark):
    rows = spark.createDataFrame([(1, 0, "user", None, 9), (1, 1, "assistant", "a<|im_end|>", 9), (1, 1, "assistant", "a<|im_end|>", 9), (None, None, None, "x", 9),
                                  (2, 0, "odd\n<|im_start|>role", LONG, 9), (3, 0, "assistant", "", 9)], "conv_id long, turn long, role string, text string, formatted long")
    got = {r.conv_id: r for r in chat.conversation_digests(rows).collect()}
    assert set(got) == {1, 2, 3, None}
    text = "a<|im_end|>"
    assert got[1].n_turns == 3 and got[1].loss_chars == 2 * len(text)
    assert got[1].turns_sha256 == hashlib.sha256(f"user\n\nassistant\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert got[1].loss_sha256 == hashlib.sha256((text * 2).encode()).hexdigest()
    assert got[2].loss_chars == 0 and got[3].loss_sha256 == hashlib.sha256(b"").hexdigest()
    assert chat.conversation_digests(rows.limit(0)).count() == 0
    turns = chat.format_conversations(rows).where("conv_id = 1").orderBy("seq").collect()
    whole = "".join(t.formatted for t in turns)
    assert [whole[t.loss_start:t.loss_end] for t in turns if t.loss_start is not None] == ["a<\\|im_end|>"] * 2


def test_pages(spark):
    rows = spark.createDataFrame([(1, None, None, "t"), (2, "u", "", "t"), (3, "u", "<p>cut off <b", "t"), (3, "u", "<p>cut off <b", "t"),
                                  (4, "u", "<article><p>" + LONG + "</article>", "t"), (5, "u", "<nav>only menu</nav>", "t")], "page_id long, url string, html string, text string")
    weights = html_text.fit_weights(rows)
    out = html_text.extract_main_text(rows, weights)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.page_id, r.text if r.page_id != 4 else r.text == LONG, r.n_chars) for r in out.collect()) == [
        (1, "", 0), (2, "", 0), (3, "cut off", 7), (3, "cut off", 7), (4, True, len(LONG)), (5, "", 0)]
    assert html_text.extract_main_text(rows.limit(0), html_text.fit_weights(rows.limit(0))).count() == 0


def test_topk(spark):
    v = [1.0, -1.0, 1.0, -1.0] * 16
    rows = [(0, v, 1), (0, v, 2), (1, v, 1), (2, [-x for x in v], 1), (3, None, 1), (4, [], 1), (100, [None] * 64, 1), (None, v, 1),
            (200, [float("nan")] * 64, 1), (300, [1.0, 2.0], 1)]
    t = spark.createDataFrame(rows, "vec_id long, embedding array<float>, distance int")
    got = sorted((r.query_id, r.rank, r.vec_id, r.distance) for r in hamming.top_k(t).collect())
    assert got == [(0, 1, 1, 0), (0, 2, 100, 32), (0, 3, 200, 32), (0, 4, 2, 64), (100, 1, 200, 0), (100, 2, 0, 32), (100, 3, 1, 32),
                   (100, 4, 2, 32), (200, 1, 100, 0), (200, 2, 0, 32), (200, 3, 1, 32), (200, 4, 2, 32)]
    assert hamming.top_k(t.limit(0)).count() == 0
