"""Registered queries of the corpus operators: one thin query each, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import circulant, divergence, flat, html, mixing, ordermh, packing, pieces, quality, repair, search
from strata.llm import simhash, urls

# The file names of the public tokenizers.
PIECE_MODEL = "piece_bpe_32k.model"
BYTE_PAIR_RANKS = "byte_bpe_50k.tiktoken"
BYTE_PAIR_END = 50256

# Host and path rules and the mixing weights.
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
MIX_WEIGHTS = [3, 1, 2]
MIX_BUDGET, MIX_EPOCHS = 1.5, 2.0


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    coded = pieces.encode_texts(docs, tokenizer(PIECE_MODEL), keep=["doc_id"])
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read(spark, sf_dir, "documents")
    manifest = flat.write_flat_tokens(docs, tokenizer(BYTE_PAIR_RANKS), public_tokenizers.PATTERN, BYTE_PAIR_END)
    counts = flat.count_tokens(manifest.select("file", "bytes"), BYTE_PAIR_END)
    return flat.name_documents(counts, manifest)


def op4_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ordermh.edited_fingerprints(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        ordermh.as_text(F.col("fingerprint")).alias("fingerprint"),
        ordermh.as_text(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read(spark, sf_dir, "documents")
    ranks = tokenizer(BYTE_PAIR_RANKS)
    return packing.pack_documents(docs, BYTE_PAIR_END, context=2048, ranks_path=ranks, pattern=public_tokenizers.PATTERN)


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [urls.host_path_rule(rule, verdict) for rule, verdict in URL_RULES]
    fallback = [urls.host_word_rule(w) for w in urls.HOST_WORDS]
    judged = urls.judge_urls(read(spark, sf_dir, "pages").select("page_id", "url"), rules, fallback)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"), MIX_WEIGHTS, MIX_BUDGET, MIX_EPOCHS)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def quality_model(spark: SparkSession, sf_dir: str):
    allowed = ~quality.held_out(F.col("doc_id"))
    return quality.train(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), allowed=allowed)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights, bias = quality_model(spark, sf_dir)
    scored = quality.score(read(spark, sf_dir, "documents").select("doc_id", "text"), weights, bias)
    return scored.select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.extract_text(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def by_hundred(id_: Column) -> Column:
    return id_ % 100 == 0


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.top_k(read(spark, sf_dir, "documents"), by_hundred, k=10)


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return circulant.near_duplicates(read(spark, sf_dir, "documents"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(read(spark, sf_dir, "documents"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_conversations(repair.damage(read(spark, sf_dir, "conversations")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_token_counts": op3_token_counts,
    "op4_order_minhash": op4_order_minhash,
    "op5_packing": op5_packing,
    "op6_url_filters": op6_url_filters,
    "op7_mixing": op7_mixing,
    "op8_quality": op8_quality,
    "op9_html_text": op9_html_text,
    "op10_top_k": op10_top_k,
    "op11_minhash": op11_minhash,
    "op12_divergence": op12_divergence,
    "op13_repair": op13_repair,
    "pipeline": pipeline,
}

_RULE_ROWS = ", ".join(f"('{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}', '{v}')" for r, v in URL_RULES)
_WORDS = "|".join(urls.HOST_WORDS)

_SQL_URLS = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0
         THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') ELSE '' END AS whole
  FROM pages
), parts AS (
  SELECT page_id,
         translate(regexp_extract(whole, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         substr(whole, length(regexp_extract(whole, '^[^/]*')) + 1) AS path
  FROM cut
), rules(rule, rule_host, rule_path, verdict) AS (VALUES {_RULE_ROWS}),
judged AS (
  SELECT page_id, host, path,
         (SELECT max_by(r.rule, length(r.rule)) FROM rules r
          WHERE (host = r.rule_host OR ends_with(host, '.' || r.rule_host)) AND starts_with(path, r.rule_path)) AS rule
  FROM parts
)
SELECT page_id, host, path, j.rule AS rule,
       COALESCE(r.verdict, CASE WHEN regexp_matches(host, '(\\A|[^a-z0-9])({_WORDS})([^a-z0-9]|\\z)')
                                THEN 'block' ELSE 'allow' END) AS verdict
FROM judged j LEFT JOIN rules r ON j.rule = r.rule
"""

_SQL_MIXING = f"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(COALESCE(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5(concat_ws('|', '42', COALESCE(CAST(doc_id AS VARCHAR), ''), md5(COALESCE(text, '')))) AS place
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         {MIX_WEIGHTS}[(row_number() OVER (ORDER BY source IS NULL, source) - 1) % {len(MIX_WEIGHTS)} + 1] AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT source, source_size, weight, {MIX_EPOCHS} * source_size AS cap, {MIX_EPOCHS} * source_size / weight AS ratio,
         ({MIX_BUDGET} * sum(source_size) OVER ()
          - COALESCE(sum({MIX_EPOCHS} * source_size) OVER (ORDER BY {MIX_EPOCHS} * source_size / weight, source
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY {MIX_EPOCHS} * source_size / weight, source
                             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources
), targets AS (
  SELECT source, source_size,
         CAST(CASE WHEN (SELECT count(*) FROM levels WHERE level <= ratio) = 0 THEN cap
              ELSE least(cap, weight * (SELECT min_by(level, ratio) FROM levels WHERE level <= ratio)) END AS DOUBLE) AS target
  FROM levels
), runs AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         CAST(CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS BIGINT) AS whole,
         CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.place, s.doc_id
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - s.size AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(whole * size + greatest(0, least(size, CAST(floor(target) AS BIGINT) - whole * source_size - start)) AS BIGINT) AS taken
FROM runs
"""

_SQL_SEARCH = f"""
WITH tokens AS (
  SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS term FROM documents WHERE text IS NOT NULL
), counted AS (
  SELECT doc_id, term, count(*) AS tf FROM tokens GROUP BY doc_id, term
), lengths AS (
  SELECT d.doc_id, COALESCE(sum(c.tf), 0) AS words FROM documents d LEFT JOIN counted c ON d.doc_id = c.doc_id GROUP BY d.doc_id
), frequency AS (
  SELECT term, count(*) AS df FROM counted GROUP BY term
), stats AS (
  SELECT count(*) AS n, avg(words) AS mean FROM lengths
), scored AS (
  SELECT q.doc_id AS query_id, c.doc_id,
         round(sum(ln(1 + (s.n - f.df + 0.5) / (f.df + 0.5))
                   * c.tf * {search.K1 + 1} / (c.tf + {search.K1} * ({1 - search.B} + {search.B} * l.words / s.mean))), {search.DIGITS}) AS score
  FROM counted q JOIN counted c ON q.term = c.term AND q.doc_id % 100 = 0
  JOIN frequency f ON f.term = c.term JOIN lengths l ON l.doc_id = c.doc_id CROSS JOIN stats s
  GROUP BY q.doc_id, c.doc_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_SQL_MINHASH = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), {_LOWER}), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words
), sizes AS (
  SELECT d.doc_id, count(s.s) AS n FROM documents d LEFT JOIN shingles s ON d.doc_id = s.doc_id GROUP BY d.doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= {circulant.PERCENT} * (p.n + q.n - c)
), reached AS (
  SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x
), least AS (
  SELECT x, min(y) AS component_id FROM reached GROUP BY x
)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM sizes JOIN least ON x = doc_id
"""

_SQL_DIVERGENCE = f"""
WITH docs AS (
  SELECT row_number() OVER () AS d, COALESCE(lang, '') AS lang, COALESCE(source, '') AS source,
         translate(COALESCE(text, ''), {_LOWER}) AS text FROM documents
), tokens AS (
  SELECT d, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS total FROM tokens GROUP BY lang, term HAVING count(DISTINCT d) >= 3
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM tokens JOIN kept USING (lang, term) GROUP BY ALL
), langs AS (
  SELECT lang, count(*) AS v, sum(total) AS whole FROM kept GROUP BY lang
), groups AS (
  SELECT g.lang, g.source, COALESCE(l.v, 0) AS v, COALESCE(l.whole, 0) AS whole,
         COALESCE((SELECT sum(n) FROM counts c WHERE c.lang = g.lang AND c.source = g.source), 0) AS size
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN langs l ON l.lang = g.lang
), cells AS (
  SELECT g.lang, g.source, k.term, COALESCE(c.n, 0) AS n,
         CAST(1 + 1000000000::HUGEINT * (COALESCE(c.n, 0) + 1) // (g.size + g.v) AS HUGEINT) AS p,
         CAST(1 + 1000000000::HUGEINT * (k.total + 1) // (g.whole + g.v) AS HUGEINT) AS q
  FROM groups g JOIN kept k ON k.lang = g.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM cells a JOIN cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(COALESCE(s.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM cells WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM found
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""

ORACLES = {"op6_url_filters": _SQL_URLS, "op7_mixing": _SQL_MIXING, "op10_top_k": _SQL_SEARCH}
ORACLES |= {"op11_minhash": _SQL_MINHASH, "op12_divergence": _SQL_DIVERGENCE}
