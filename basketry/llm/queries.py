"""Registered queries of the corpus operators and their DuckDB statements.

Each ``opN_<name>(spark, sf_dir)`` applies operator N with its production
parameters to the whole table and returns the full result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import (chat, decontaminate, hamming, html_text, language, merkle, mixing, periodic, repeats, secrets, shingle_join,
                          suffix_tree, url_rules)
from basketry.llm.tables import table
from basketry.llm.text import WORD_PATTERN

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes from each document."""
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "source", "epochs")


SQL["op7_mix_sources"] = r"""
WITH best AS (SELECT doc_id, max(quality) AS quality FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
docs AS (
  SELECT d.doc_id, d.source,
         coalesce(len(regexp_extract_all(d.text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         -ln((('0x' || substr(md5('mix-1:' || coalesce(d.doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE + 0.5)
             / 4503599627370496.0)
         / CASE WHEN b.quality >= 1 THEN 2.0::DOUBLE WHEN b.quality < 1 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS k
  FROM documents d LEFT JOIN best b ON d.doc_id = b.doc_id),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3
           WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w
  FROM docs GROUP BY source),
fill AS (
  SELECT source, source_size, w, 2.0::DOUBLE * source_size AS cap,
         1.5::DOUBLE * sum(source_size) OVER () AS total,
         coalesce(sum(2.0::DOUBLE * source_size) OVER o, 0) AS done,
         sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS wleft,
         row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / w, source IS NULL, source) AS pos
  FROM src
  WINDOW o AS (ORDER BY 2.0::DOUBLE * source_size / w, source IS NULL, source
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lev AS (SELECT arg_min((total - done) / wleft, pos) AS rate FROM fill WHERE cap / w >= (total - done) / wleft),
tgt AS (SELECT source, source_size,
               CASE WHEN (SELECT rate FROM lev) IS NULL THEN cap ELSE least(cap, (SELECT rate FROM lev) * w) END AS target
        FROM fill),
plan AS (SELECT *, floor(target / greatest(source_size, 1))::BIGINT AS epochs FROM tgt),
run AS (
  SELECT d.*, p.source_size, p.target, p.epochs,
         floor(p.target)::BIGINT - p.epochs * p.source_size AS rest,
         count(*) OVER (PARTITION BY d.source, d.k, d.doc_id, d.size) AS peers,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id NULLS FIRST, d.size) AS upto
  FROM docs d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + least(size, greatest(0, rest - (upto - size * peers)) // peers))::BIGINT AS taken,
       source, epochs
FROM run
"""


@query
def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of the longest fitting rule for every page's url."""
    urls = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge_urls(urls, url_rules.rule_table(spark)) \
        .select("page_id", "host", "path", "rule", "verdict")


SQL["op1_url_filters"] = r"""
WITH u AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r(rhost, rpath, rverdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
m AS (
  SELECT u.*, rhost || rpath AS rule, rverdict,
         row_number() OVER (PARTITION BY page_id, host, path
                            ORDER BY length(rhost || rpath) DESC NULLS LAST, length(rhost) DESC) AS n
  FROM (SELECT DISTINCT * FROM u) u LEFT JOIN r
    ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT u.page_id, u.host, u.path, m.rule, coalesce(m.rverdict, 'allow') AS verdict
FROM u JOIN m ON u.page_id IS NOT DISTINCT FROM m.page_id AND u.host = m.host AND u.path = m.path AND m.n = 1
"""


@query
def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, read back from its formatted text."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.conversation_digests(rows.unionByName(chat.control_conversation(spark)))


SQL["op9_chat_formatting"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'),
                   (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')),
esc AS (SELECT *, regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g') AS erole,
               regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') AS etext FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length('<|im_start|>' || replace(erole, chr(10), '<|nl|>') || chr(10) || etext || '<|im_end|>' || chr(10)))::BIGINT
         AS formatted_chars
FROM esc GROUP BY conv_id
"""


@query
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base findings and linked weak findings of every document."""
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text")))


SQL["op8_secret_scan"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
cut AS (
  SELECT r, 0 AS rank, 'assign' AS kind, string_split_regex(text, '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)') AS pieces,
         regexp_extract_all(text, '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 0) AS found,
         regexp_extract_all(text, '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2) AS val FROM d
  UNION ALL SELECT r, 1, 'access', string_split_regex(text, 'AKIA[A-Z0-9]+'),
         regexp_extract_all(text, 'AKIA[A-Z0-9]+'), regexp_extract_all(text, 'AKIA[A-Z0-9]+') FROM d
  UNION ALL SELECT r, 2, 'hex', string_split_regex(text, '[0-9a-f]{16,}'),
         regexp_extract_all(text, '[0-9a-f]{16,}'), regexp_extract_all(text, '[0-9a-f]{16,}') FROM d
  UNION ALL SELECT r, 5, 'key40', string_split_regex(text, '[A-Za-z0-9/+]{40,}'),
         regexp_extract_all(text, '[A-Za-z0-9/+]{40,}'), regexp_extract_all(text, '[A-Za-z0-9/+]{40,}') FROM d
  UNION ALL SELECT r, 9, 'endpoint', string_split_regex(text, '[A-Za-z][A-Za-z0-9+.-]*://[^\x20\x09-\x0D"''<>]+'),
         regexp_extract_all(text, '[A-Za-z][A-Za-z0-9+.-]*://[^\x20\x09-\x0D"''<>]+'),
         regexp_extract_all(text, '[A-Za-z][A-Za-z0-9+.-]*://[^\x20\x09-\x0D"''<>]+') FROM d),
one AS (SELECT r, rank, kind, unnest(found) AS m, unnest(val) AS v, unnest(range(1, len(found) + 1)) AS i, pieces, found
        FROM cut WHERE len(found) > 0),
hit AS (SELECT r, rank, kind, v, length(v) AS n, length(m) AS mlen,
               (list_sum(list_transform(pieces[1:i], lambda x: length(x)))
                + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0))::BIGINT AS s
        FROM one),
part AS (
  SELECT r, s, s + mlen AS e,
         CASE WHEN kind = 'assign' AND n >= 12 THEN 0 WHEN kind = 'access' AND n >= 18 THEN 1 WHEN kind = 'hex' THEN 2
              WHEN kind = 'assign' AND n >= 6 THEN 3 WHEN kind = 'access' AND n >= 16 THEN 4
              WHEN kind = 'key40' AND n = 40 AND regexp_matches(v, '[A-Z]') AND regexp_matches(v, '[a-z]')
                   AND regexp_matches(v, '[0-9]') THEN 5
              WHEN kind = 'endpoint' THEN 9 END AS k FROM hit),
shown AS (
  SELECT * FROM part WHERE k <= 2
  UNION ALL
  SELECT * FROM part w WHERE k IN (3, 4, 5) AND EXISTS (
    SELECT 1 FROM part c WHERE c.r = w.r AND c.s - w.e <= 200 AND w.s - c.e <= 200 AND (c.s <> w.s OR c.e <> w.e)
      AND ((w.k IN (3, 5) AND c.k IN (1, 4, 9)) OR (w.k = 4 AND c.k IN (0, 2, 3, 5))))),
txt AS (SELECT r, k, s, ['assign', 'access', 'hex', 'assign_short', 'access_short', 'key40'][k + 1] || ':' || s || ':' || e AS t FROM shown)
SELECT doc_id,
       count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access, count(*) FILTER (WHERE k = 2) AS n_hex,
       sha256(coalesce(string_agg(t, ',' ORDER BY s, k) FILTER (WHERE k <= 2), '')) AS base_sha256,
       coalesce(string_agg(t, ',' ORDER BY s, k), '') AS spans
FROM d LEFT JOIN txt USING (r) GROUP BY d.r, doc_id
"""


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text."""
    docs = table(spark, sf_dir, "documents")
    model = language.fit_documents(docs)
    return language.label_languages(docs.select("doc_id", "text"), model) \
        .select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


@query
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in documents, up to a quarter of the words edited."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document."""
    return shingle_join.link_components(table(spark, sf_dir, "documents").select("doc_id", "text")) \
        .select("doc_id", "n_shingles", "component_id")


@query
def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram base score and suffix-tree score of every document."""
    return suffix_tree.score_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract_main_text(pages, html_text.fit_weights(pages)).select("page_id", "url", "text", "n_chars")


@query
def op6_hamming_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest sign codes of every row whose id is divisible by 100."""
    return hamming.top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


SQL["op6_hamming_topk"] = r"""
WITH c AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: coalesce(x, 0) > 0) AS code FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0),
d AS (SELECT q.vec_id AS query_id, q.code AS query, c.vec_id,
             len(list_filter(list_zip(q.code, c.code), lambda p: p[1] <> p[2]))::INTEGER AS distance
      FROM c q JOIN c ON len(q.code) = len(c.code) AND q.vec_id <> c.vec_id
      WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id, query ORDER BY distance, vec_id)::INTEGER AS rank FROM d)
SELECT query_id, rank, vec_id, distance FROM r WHERE rank <= 10
"""


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root, proof and verdict of every document; every fifth checksum tells a document whose
    text is held against the manifest in lower case."""
    docs = table(spark, sf_dir, "documents")
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    seen = F.when(tampered, merkle.leaf_digest(text=lower)).otherwise(merkle.leaf_digest())
    listed = merkle.verify(merkle.manifest(docs, carried={"seen": seen}), "seen")
    return listed.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
                         "folded_root", "verified", "source", "position")


SQL["op11_merkle_manifest"] = r"""
WITH RECURSIVE txt AS (
  SELECT row_number() OVER () AS r, doc_id, source, lang, n_chars, text,
         CASE WHEN doc_id IS NULL THEN '-' ELSE length(doc_id::VARCHAR) || ':' || doc_id::VARCHAR END
         || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
         || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END
         || CASE WHEN n_chars IS NULL THEN '-' ELSE length(n_chars::VARCHAR) || ':' || n_chars::VARCHAR END AS head
  FROM documents),
-- crc32, bit by bit over the digits of the id
crc AS (
  SELECT doc_id, doc_id::VARCHAR AS s, 1 AS i, 4294967295::BIGINT AS c FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
  UNION ALL
  SELECT doc_id, s, i + 1, list_reduce(list_prepend(xor(c, ascii(s[i])::BIGINT), range(8)::BIGINT[]),
         lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END)
  FROM crc WHERE i <= length(s)),
sums AS (SELECT doc_id, xor(c, 4294967295::BIGINT) AS h FROM crc WHERE i = length(s) + 1),
low AS (SELECT *, coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS ltext FROM txt),
leaves AS (
  SELECT r, l.doc_id, source, sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
         CASE WHEN h % 5 = 0 THEN sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(ltext) || ':' || ltext END)
              ELSE sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) END AS seen
  FROM low l LEFT JOIN sums s ON l.doc_id = s.doc_id),
placed AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) AS t,
                  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves),
up AS (
  SELECT t, i, 0 AS lvl, leaf AS d, count(*) OVER (PARTITION BY t) AS n FROM placed
  UNION ALL
  SELECT t, i // 16, lvl + 1, sha256(string_agg(d, '' ORDER BY i)), (n + 15) // 16 FROM up WHERE n > 1 GROUP BY t, i // 16, lvl, n),
subs AS (SELECT t - 1 AS i, d AS subroot FROM up WHERE n = 1),
top AS (
  SELECT i, 0 AS lvl, subroot AS d, (SELECT count(*) FROM subs) AS n FROM subs
  UNION ALL
  SELECT i // 16, lvl + 1, sha256(string_agg(d, '' ORDER BY i)), (n + 15) // 16 FROM top WHERE n > 1 GROUP BY i // 16, lvl, n),
-- one tree per source, then tree 0 above them
node AS (SELECT t, lvl, i, d, n FROM up WHERE n > 1 UNION ALL SELECT 0, lvl, i, d, n FROM top WHERE n > 1),
run AS (SELECT t, lvl, i // 16 AS p, list(d ORDER BY i) AS ds FROM node GROUP BY t, lvl, i // 16),
depth AS (SELECT t, max(lvl) + 1 AS levels FROM node GROUP BY t),
fold AS (
  SELECT r, t AS src, t, 0 AS lvl, i, '' AS proof, seen AS acc FROM placed
  UNION ALL
  SELECT f.r, f.src, CASE WHEN f.lvl = coalesce(d.levels, 0) THEN 0 ELSE f.t END, CASE WHEN f.lvl = coalesce(d.levels, 0) THEN 0 ELSE f.lvl + 1 END,
         CASE WHEN f.lvl = coalesce(d.levels, 0) THEN f.src - 1 ELSE f.i // 16 END,
         CASE WHEN f.lvl = coalesce(d.levels, 0) THEN f.proof
              ELSE f.proof || array_to_string(run.ds[:f.i % 16], '') || array_to_string(run.ds[f.i % 16 + 2:], '') END,
         CASE WHEN f.lvl = coalesce(d.levels, 0) THEN f.acc
              ELSE sha256(array_to_string(run.ds[:f.i % 16], '') || f.acc || array_to_string(run.ds[f.i % 16 + 2:], '')) END
  FROM fold f LEFT JOIN depth d ON d.t = f.t LEFT JOIN run ON run.t = f.t AND run.lvl = f.lvl AND run.p = f.i // 16
  WHERE f.t > 0 OR f.lvl < coalesce((SELECT levels FROM depth WHERE t = 0), 0)),
done AS (SELECT r, proof, acc FROM fold WHERE t = 0 AND lvl = coalesce((SELECT levels FROM depth WHERE t = 0), 0)),
root AS (SELECT d AS root FROM top WHERE n = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = root AS verified, source, p.i AS position
FROM placed p JOIN subs ON subs.i = p.t - 1 JOIN done USING (r) CROSS JOIN root
"""


@query
def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stay when passages found in an earlier document go."""
    return repeats.find_repeats(table(spark, sf_dir, "documents")) \
        .select("doc_id", F.col("words").alias("n_words"), F.col("removed").alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


SQL["op12_substring_dedup"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
one AS (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS s FROM d WHERE len(w) >= 13),
win AS (SELECT r, doc_id, s, md5_number(array_to_string(w[s:s + 12], ' ')) AS h FROM one),
low AS (SELECT h, min(doc_id) AS first FROM win GROUP BY h),
hit AS (SELECT r, s FROM win JOIN low USING (h) WHERE first < doc_id OR (doc_id IS NULL AND first IS NOT NULL)),
gone AS (SELECT r, list_distinct(flatten(list(range(s, s + 13)))) AS lost FROM hit GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(lost), 0)::BIGINT AS n_removed,
       sha256(array_to_string(list_filter(w, lambda x, i: NOT list_contains(coalesce(lost, []), i)), ' ')) AS kept_sha256
FROM d LEFT JOIN gone USING (r)
"""


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """The documents of the contract: where crc32(doc_id) ends in 0, a part of a text's own words is repeated."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = docs.withColumn("_h", h).withColumn(
        "_w", F.when((F.col("_h") % 10 == 0) & F.col("text").isNotNull(), F.regexp_extract_all("text", F.lit(WORD_PATTERN), F.lit(0))))
    places = words.withColumn("_n", F.size("_w")).withColumn("_g", F.floor(F.col("_h") / 10)) \
        .withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n"))) \
        .withColumn("_p", 1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8)))
    again = F.transform(F.sequence(F.lit(0).cast("long"), F.col("_n") - F.lit(1).cast("long")),
                        lambda i: F.get("_w", F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p")).cast("int")))
    return places.withColumn("text", F.when(F.col("_a").isNotNull(), F.array_join(again, " ")).otherwise(F.col("text"))).select(*docs.columns)


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, and the text without their repeats."""
    docs = _with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic.find_runs(docs)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_best.start")).alias("start"), F.col("_best.length").alias("length"),
        (-F.col("_best.period")).alias("period"), F.floor(1000 * F.col("_best.length") / -F.col("_best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
