"""Registered queries of the operators in this folder, with DuckDB SQL where SQL can express the result."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens import session
from marketlens.llm import (collocations, decontaminate, jaccard_join, language_model, lexical_search, line_dedup, packing, quality, secrets, token_files, toxicity, url_filter, wrapper)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name, with its SQL if there is one."""
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


@query("op2_token_files")
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, written to ORC and read back, with their checksums."""
    path = session.scratch(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), 1,
                             spaced=False)
    return token_files.with_checksum(token_files.read_tokens(spark, path))


@query("op7_sum_of_squares_packing")
def op7_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 ids, with checksums of the pieces."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2, spaced=True,
                        checksum=True).drop("ids")


URL_RULES = [url_filter.Rule("net", "/", "block"), url_filter.Rule("example.net", "/en/", "allow"),
             url_filter.Rule("example.com", "/de/", "block"), url_filter.Rule("org", "/fr/", "allow")]


@query("op10_url_filter")
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all page URLs."""
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


@query("op3_quality_rules")
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts and verdicts on all documents."""
    return quality.assess(table(spark, sf_dir, "documents")).drop("text_hash")


def _secret_sql() -> str:
    """DuckDB SQL of the secret spans: every rule tried on every text."""
    parts = []
    for number, rule in enumerate(secrets.RULES):
        p = rule.pattern.replace("'", "''")
        parts.append(f"""
  SELECT doc_id, {number} AS rule, '{rule.kind}' AS kind, unnest(range(1, len(hits) + 1)) AS k, gaps, hits, vals
  FROM (SELECT doc_id, string_split_regex(text, '{p}') AS gaps, regexp_extract_all(text, '{p}', 0) AS hits,
               regexp_extract_all(text, '{p}', {rule.group}) AS vals FROM d)""")
    least = "CASE rule " + " ".join(f"WHEN {n} THEN {r.min_chars}" for n, r in enumerate(secrets.RULES)) + " END"
    base = "rule < 3"
    joined = "coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rule){0}, '')"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), m AS ({" UNION ALL ".join(parts)}),
x AS (SELECT doc_id, rule, kind, vals[k] AS v, length(hits[k]) AS size,
             list_sum([length(g) for g in gaps[1:k]]) + coalesce(list_sum([length(g) for g in hits[1:k-1]]), 0) AS p
      FROM m),
y AS (SELECT doc_id, rule, kind, CAST(p AS BIGINT) AS s, CAST(p + size AS BIGINT) AS e FROM x WHERE length(v) >= {least})
SELECT d.doc_id, count(*) FILTER (rule = 0) AS n_assign, count(*) FILTER (rule = 1) AS n_access,
       count(*) FILTER (rule = 2) AS n_hex, sha256({joined.format(f" FILTER ({base})")}) AS base_sha256,
       {joined.format("")} AS spans
FROM d LEFT JOIN y ON d.doc_id = y.doc_id GROUP BY d.doc_id"""


@query("op5_secret_scan", _secret_sql())
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents."""
    found = secrets.scan(table(spark, sf_dir, "documents"))
    of = lambda *kinds: F.filter("secrets", lambda s: s["kind"].isin(*kinds))
    return found.select("doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in secrets.BASE_KINDS],
                        F.sha2(secrets.span_text(of(*secrets.BASE_KINDS)), 256).alias("base_sha256"),
                        secrets.span_text(F.col("secrets")).alias("spans"))


@query("op6_line_dedup", r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(range(1, len(lines) + 1)) AS k, unnest(lines) AS line FROM d),
x AS (SELECT doc_id, k, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, min(doc_id) AS first FROM x WHERE length(key) >= 10 GROUP BY key),
y AS (SELECT x.doc_id, x.k, x.line, coalesce(x.doc_id > f.first, false) AS gone FROM x LEFT JOIN f ON x.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT gone), '')) AS kept_sha256
FROM y GROUP BY doc_id""")
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents, and what is left after de-duplication."""
    docs = table(spark, sf_dir, "documents")
    lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("long")
    kept = line_dedup.apply_bitmaps(docs.select("doc_id", "text", lines.alias("n_lines")), line_dedup.keep_bitmaps(docs))
    return kept.select("doc_id", "n_lines", F.col("n_dropped").cast("long").alias("n_dropped"),
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op9_spaced_seeds")
def op9_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold passages of benchmark items: a row per document and item."""
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


@query("op1_kneser_ney_toxicity")
def op1_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from labels outside the held-out fold."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(toxicity.fold_of(F.col("doc_id"), 5) != 0))
    held_out = (toxicity.fold_of(F.col("doc_id"), 5) == 0).alias("held_out")
    return toxicity.score(docs, model).select("doc_id", held_out, "score", "predicted")


@query("op8_backoff_automaton")
def op8_backoff_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of those outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    fold = language_model.fold_of(F.col("doc_id"), 10)
    found = language_model.score(docs, docs.where(fold != 0))
    return found.select("doc_id", (fold == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op4_grouped_prefix_join", r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
             ELSE [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)] END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
      GROUP BY ALL),
e AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 90 * (x.n + y.n - common)),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id FROM c LEFT JOIN n USING (doc_id)""")
def op4_grouped_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents on three-word shingles."""
    linked = jaccard_join.link(table(spark, sf_dir, "documents"), shingle=3, percent=90)
    return linked.select(F.col("doc").alias("doc_id"), "n_shingles", F.col("first_doc").alias("component_id"))


@query("op12_phrase_collocations", r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
p AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM d),
s AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
g AS (SELECT lang, k, unnest([w[i:i + k - 1] for i in range(1, len(w) - k + 2)]) AS g FROM p, (VALUES (1), (2), (3), (4)) AS t(k)),
f AS (SELECT lang, k, g, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT x.lang, x.k, x.g, x.a, t.j, y.a AS l, z.a AS r, (2000000::HUGEINT * x.a) // (y.a + z.a) AS score
      FROM f x, (VALUES (1), (2), (3)) AS t(j), f y, f z
      WHERE t.j < x.k AND y.lang = x.lang AND z.lang = x.lang AND y.g = x.g[1:t.j] AND z.g = x.g[t.j + 1:x.k]),
b AS (SELECT lang, g, a, unnest(min_by({'l': l, 'r': r, 'score': score}, [score, j])) FROM c GROUP BY lang, g, a),
o AS (SELECT lang, g[i:i + m - 1] AS g, max(a) AS f FROM (SELECT lang, k, g, a, m, unnest(range(1, k - m + 2)) AS i
      FROM f, (VALUES (2), (3)) AS t(m) WHERE m < k) GROUP BY ALL),
q AS (SELECT b.* FROM b LEFT JOIN o ON o.lang = b.lang AND o.g = b.g WHERE o.f IS NULL OR 100 * o.f < 80 * b.a),
r AS (SELECT *, array_to_string(g, ' ') AS phrase, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC,
             array_to_string(g, ' ')) AS rank FROM q)
SELECT lang, rank, phrase, a, l, r.r AS r, s.n, CAST(score AS BIGINT) AS score FROM r JOIN s USING (lang) WHERE rank <= 2000""")
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first phrases of each language of all documents."""
    return collocations.phrases(table(spark, sf_dir, "documents"))


@query("op13_lexical_search", r"""
WITH d AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
g AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
m AS (SELECT doc_id, 10 + (90 * n * docs) // terms AS m FROM n, g),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
t AS (SELECT doc_id, term, count(*) AS tf FROM d WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM t GROUP BY term), g),
s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM q JOIN t USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY ALL),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
      FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10""")
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each benchmark item."""
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op11_wrapper_induction")
def op11_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return wrapper.extract(table(spark, sf_dir, "pages"))
