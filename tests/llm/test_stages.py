"""Pipeline stages on nulls, empty texts, repeated rows, empty tables, unlabelled corpora and clashing columns."""

import pytest

import corpus_pipeline

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ", lang_pred string, component_id long, hits string, spans string, size long"
LONG = " ".join(f"word{i % 97} of the {i % 13}" for i in range(20_000))
ROWS = [(0, None, None, None, None), (1, "", "en", "a", 0), (2, " \t\n ", "en", "a", 4), (3, "one", None, None, 3),
        (4, "alpha beta gamma delta epsilon zeta", "en", "b", 35), (4, "alpha beta gamma delta epsilon zeta", "en", "b", 35),
        (6, LONG, "en", "c", len(LONG)), (None, "no id here at all", "en", "c", 17), (7, "1234 5678 !!! ---", "en", "a", 17), (8, "漢字 text", "fr", "a", 7)]


def ids(df):
    return sorted((r.doc_id is None, r.doc_id or 0) for r in df.collect())


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_on_odd_rows(spark, name, stage):
    plain = spark.createDataFrame(ROWS, DOCS)
    docs = spark.createDataFrame([(*r, "x", 1, "y", "z", 5) for r in ROWS], DOCS + CLASH)
    got, clash = stage(spark, plain, SF), stage(spark, docs, SF)
    want = {"language": [3, 4, 4, 6, 8], "near_duplicates": [0, 1, 2, 3, 4, 6, 7, 8], "mix": [3, 4, 4, 6, 7, 8]}.get(name, [0, 1, 2, 3, 4, 4, 6, 7, 8])
    assert ids(got) == [(False, i) for i in want] + [(True, 0)] == ids(clash)
    if name != "mix":
        assert got.columns == plain.columns and clash.columns == docs.columns
    assert stage(spark, plain.limit(0), SF).count() == 0


def test_an_unlabelled_corpus_keeps_every_text_with_a_letter(spark):
    docs = spark.createDataFrame([(i, t, None, "s", 1) for i, t in enumerate(["some words", "12 34", "é", None, "漢字", "...", "x"])], DOCS)
    out = corpus_pipeline.language_stage(spark, docs, SF).collect()
    assert sorted(r.doc_id for r in out) == [0, 2, 4, 6] and {r.lang for r in out} == {None}
