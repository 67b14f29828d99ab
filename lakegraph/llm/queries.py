"""The registered queries of this folder and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegraph.llm import (decontaminate, jaccard_join, langid, ngram_lm, nn_descent, packing, periodic, quality, suffix_dedup, token_files,
                           url_filter, warc, whiten)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of a public tokenizer file (same place on driver and executors)."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(read(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_hits(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), ["doc_id"])


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar(read(spark, sf_dir, "documents"))


def op3_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar(read(spark, sf_dir, "documents"), counted=True)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json")))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.judge(read(spark, sf_dir, "documents"), ("doc_id", "source"))
    return out.select("doc_id", *quality.MEASURES, "base_failed", "kept")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archive(read(spark, sf_dir, "pages"))
    return warc.read_records(index, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("held_out", langid.fold(F.col("doc_id"), 5, 1))
    return ngram_lm.score(docs, ngram_lm.build(docs.filter(~F.col("held_out"))))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.read_tokens(token_files.write_tokens(read(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json")))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("held_out", langid.fold(F.col("doc_id"), 4, 2))
    return langid.predict(docs, langid.train(docs.filter(~F.col("held_out"))))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(read(spark, sf_dir, "pages"), URL_RULES)


def repeated_words(docs: DataFrame) -> DataFrame:
    """doc_id and text of all documents; in a tenth of them, chosen by doc_id,
    the words from one on go round in a period."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    w = F.filter(F.split(F.when(h % 10 == 0, F.col("text")), r"[\x20\x09-\x0D]+"), lambda x: x != "")
    n = F.when(F.size("w") > 0, F.size("w"))
    rows = docs.select("doc_id", "text", g.alias("g"), w.alias("w")).withColumn("a", F.col("g") % n) \
        .withColumn("p", F.lit(1) + F.floor((n - F.col("a")) / (F.lit(3) + F.col("g") % 8)))
    turned = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("w", F.when(i < F.col("a"), i).otherwise(
        F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    return rows.select("doc_id", F.when(n.isNotNull(), F.array_join(turned, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic.find_runs(repeated_words(read(spark, sf_dir, "documents")))
    line = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                                                  r["period"].cast("string"), F.lit("\n")))
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    out = out.withColumns({"best": best, "lines": F.array_join(line, "")})
    length, period = -F.col("best.less"), F.col("best.period")
    return out.select("doc_id", "n_runs", F.col("best.start").alias("start"), length.alias("length"), period.alias("period"),
                      F.floor(F.lit(1000) * length / period).alias("exponent_milli"), F.sha2("lines", 256).alias("runs_sha256"),
                      F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.near_duplicates(read(spark, sf_dir, "embeddings")).drop("audit_recall")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.whiten(read(spark, sf_dir, "embeddings"))


JOBS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_suffix_dedup, op2_decontaminate, op3_jaccard_join, op3_jaccard_links, op4_best_fit_packing, op5_quality_rules,
                            op6_warc, op7_lm_scoring, op8_token_files, op9_language_id, op10_url_filter, op11_periodic_runs, op12_nn_descent, op13_whitening)}

_B32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_SPACE_WORD = r"[^\x20\x09-\x0D]+"
_ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _base32_sha1(text: str) -> str:
    """Base-32 of sha1(text): each 5 hex digits are 4 letters."""
    quarters = [f"substr('{_B32}', ((('0x' || substr(sha1({text}), {5 * k + 1}, 5))::INTEGER >> {shift}) & 31) + 1, 1)"
                for k in range(8) for shift in (15, 10, 5, 0)]
    return " || ".join(quarters)


def _rules_sql() -> str:
    rules = [f"('{h}', '{p}', '{a}', false)" for a, h, p in URL_RULES]
    return ", ".join(rules + [f"('{h}', '', 'block', true)" for h in url_filter.BLOCKED_HOSTS])


SQL: dict[str, str] = {
    "op2_decontaminate": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '{_ALNUM_WORD}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '{_ALNUM_WORD}') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d CROSS JOIN sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, item_id, i, dw.n FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
per_word AS (SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY doc_id),
per_item AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN per_word USING (doc_id) LEFT JOIN per_item USING (doc_id)""",
    "op3_jaccard_join": rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '{_SPACE_WORD}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, sh FROM (SELECT doc_id, array_to_string(w[i:i + 2], ' ') AS sh
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) AS i FROM d WHERE len(w) > 0))),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
  WHERE 100 * i >= {jaccard_join.PERCENT} * (nx.n + ny.n - i)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT e.y, r.c FROM r JOIN e ON r.doc_id = e.x)
SELECT r.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.c) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id""",
    "op5_quality_rules": rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_SPACE_WORD}') AS w FROM documents),
lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '{_SPACE_WORD}') GROUP BY doc_id),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 4)) AS i FROM d WHERE len(w) >= 5)),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + 4)) AS p FROM win
  JOIN (SELECT doc_id, s FROM win GROUP BY doc_id, s HAVING count(*) > 1) USING (doc_id, s)) GROUP BY doc_id),
m AS (SELECT d.doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
  len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(lines.n, 0)::BIGINT AS n_dup_lines,
  coalesce(rep.n, 0)::BIGINT AS n_repeat_words FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id)),
j AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m),
h AS (SELECT source, count(*)::DOUBLE AS n, sum(base_failed::INT)::DOUBLE AS f FROM j WHERE source IS NOT NULL GROUP BY source),
s AS (SELECT sum(n) AS n, (sum(f) + 0.5) / (sum(n) + 1) AS m, var_pop(f / n) AS v, avg(1 / n) AS inv FROM h),
k AS (SELECT n, m, v - m * (1 - m) * inv AS b FROM s),
p AS (SELECT m, greatest(least(CASE WHEN b > 0 THEN m * (1 - m) / b - 1 ELSE n END, n + 1), {quality.MIN_WEIGHT}) AS wt FROM k),
bad AS (SELECT source FROM h, p WHERE (f + m * wt) / (n + wt) > {quality.MAX_RATE})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND (source IS NULL OR source NOT IN (SELECT source FROM bad)) AS kept FROM j""",
    "op6_warc": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
t AS (SELECT h, max(page_id) AS top FROM p GROUP BY h)
SELECT page_id, octet_length(encode(p.h))::BIGINT AS payload_bytes, {_base32_sha1('p.h')} AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to FROM p JOIN t ON p.h = t.h""",
    "op10_url_filter": f"""
WITH p AS (SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), {_AZ}) AS host,
  regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r(rhost, rpath, action, listed) AS (VALUES {_rules_sql()}),
f AS (SELECT page_id, rhost, rpath, action, listed FROM u JOIN r
  ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)),
best AS (SELECT page_id, rhost || rpath AS rule, action FROM f WHERE NOT listed
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) = 1),
on_list AS (SELECT DISTINCT page_id FROM f WHERE listed)
SELECT page_id, host, path, rule, coalesce(action, CASE WHEN on_list.page_id IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM u LEFT JOIN best USING (page_id) LEFT JOIN on_list USING (page_id)""",
    "op12_nn_descent": f"""
WITH RECURSIVE e AS (SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
ok AS (SELECT * FROM e WHERE label IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0
  AND len(list_filter(x, lambda c: c <> 0)) > 0),
l AS (SELECT a.r AS x, b.r AS y FROM ok a JOIN ok b ON a.label = b.label AND len(a.x) = len(b.x) AND a.r <> b.r
  WHERE list_cosine_similarity(a.x, b.x) >= {nn_descent.THRESHOLD}),
n AS (SELECT x AS r, count(*) AS n FROM l GROUP BY x),
c AS (SELECT r, vec_id AS id FROM e UNION SELECT l.y, c.id FROM c JOIN l ON c.r = l.x),
m AS (SELECT r, min(id) AS id FROM c GROUP BY r)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, id AS component_id, vec_id = id AS kept FROM e JOIN m USING (r) LEFT JOIN n USING (r)""",
}
# op3's rows, with the number of links of each
SQL["op3_jaccard_links"] = SQL["op3_jaccard_join"].replace(
    "min(r.c) AS component_id", "min(r.c) AS component_id, (SELECT count(*) FROM e WHERE e.x = r.doc_id)::BIGINT AS n_links")
