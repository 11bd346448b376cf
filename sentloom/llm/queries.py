"""Registered queries of the operators and, where SQL can express them, their statements."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentloom.llm.jaccard_join import jaccard_components
from sentloom.llm.lexical_search import search
from sentloom.llm.license_scan import scan_licenses
from sentloom.llm.main_text import extract
from sentloom.llm.multiprobe import nearest
from sentloom.llm.pii_scan import scan_pii
from sentloom.llm.piece_sampling import sample_segmentations
from sentloom.llm.pivot_search import top_k
from sentloom.llm.secret_scan import scan_secrets
from sentloom.llm.token_codes import token_codes
from sentloom.llm.toxicity import fit, held_out, labelled_texts, score
from sentloom.llm.whitening import whiten
from sentloom.llm.window_packing import pack

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_codes(_table(spark, sf_dir, "documents"), WORD_BPE)


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(_table(spark, sf_dir, "pages"))


def op3_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_segmentations(_table(spark, sf_dir, "documents"), PIECE_BPE, k=2)


def op4_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), BYTE_BPE)


def op5_multiprobe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"), k=20, every=20)


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"), n=3, num=90, den=100)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = fit(labelled_texts(docs, _table(spark, sf_dir, "labels")))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted", "weight", "words")


def op8_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_table(spark, sf_dir, "embeddings"), k=5, every=50, scale=256.0)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files ``source/lang/doc_id``."""
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return scan_licenses(_table(spark, sf_dir, "documents").withColumn("path", path))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(_table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_table(spark, sf_dir, "embeddings"), components=4, weights="one")


def op12_best_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=10)


def op13_pii_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_pii(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_codes,
        op2_main_text,
        op3_piece_sampling,
        op4_window_packing,
        op5_multiprobe,
        op6_jaccard_join,
        op7_toxicity,
        op8_pivot_search,
        op9_license_scan,
        op10_secret_scan,
        op11_whitening,
        op12_best_position,
        op13_pii_scan,
    )
}

_OP6 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY ALL HAVING 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, CAST(coalesce(least(m, doc_id), doc_id) AS BIGINT) AS component_id
FROM sets LEFT JOIN least ON a = doc_id
"""

_OP8 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""

# Stated on its own: kind, pattern, group that counts, its least length.
_OP10_RULES = r"""
  (0, 'assign', '(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
  (1, 'access', '(AKIA[A-Z0-9]+)()', 1, 20),
  (2, 'hex', '([0-9a-f]+)()', 1, 24),
  (3, 'private_key', '(-----BEGIN [A-Z ]*PRIVATE KEY( BLOCK)?-----)', 1, 0),
  (4, 'github', '(gh[opsur]_[A-Za-z0-9]{36,})()', 1, 0),
  (5, 'slack', '(xox[abprs]-[A-Za-z0-9-]{10,})()', 1, 0),
  (6, 'google', '(AIza[A-Za-z0-9_-]{35,})()', 1, 0),
  (7, 'stripe', '([sr]k_live_[A-Za-z0-9]{24,})()', 1, 0),
  (8, 'jwt', '(eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,})()', 1, 0)
"""


def _op10() -> str:
    per_rule = " UNION ALL ".join(
        f"SELECT doc_id, {k} AS k, '{kind}' AS kind, {least} AS least, string_split_regex(t, {pattern}) AS gaps, "
        f"regexp_extract_all(t, {pattern}, 0) AS hits, regexp_extract_all(t, {pattern}, {group}) AS vals "
        f"FROM texts WHERE regexp_matches(t, {pattern})"
        for k, kind, pattern, group, least in _rules()
    )
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
parts AS ({per_rule}),
each AS (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM parts),
spans AS (
  SELECT doc_id, k, kind, length(hits[i]) AS n,
    CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS a
  FROM each WHERE length(vals[i]) >= least),
said AS (
  SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
    coalesce(string_agg(kind || ':' || a || ':' || (a + n), ',' ORDER BY a, k) FILTER (k < 3), '') AS base,
    string_agg(kind || ':' || a || ':' || (a + n), ',' ORDER BY a, k) AS spans
  FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN said USING (doc_id)
"""


def _rules() -> list[tuple[int, str, str, int, int]]:
    """The rules above as SQL literals."""
    out = []
    for line in _OP10_RULES.strip().splitlines():
        k, kind, rest = line.strip().rstrip(",")[1:-1].split(", ", 2)
        pattern, group, least = rest.rsplit(", ", 2)
        out.append((int(k), kind.strip("'"), pattern, int(group), int(least)))
    return out


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
_OP12 = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS w FROM documents),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
total AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM d WHERE len(w) > 0),
held AS (
  SELECT row, doc_id, n, term, count(*) AS tf
  FROM (SELECT row, doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM held, total GROUP BY term),
scored AS (
  SELECT item_id, doc_id, row,
    CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)))) AS BIGINT) AS score
  FROM held JOIN weights USING (term) JOIN q USING (term), total GROUP BY item_id, doc_id, row)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""

ORACLES: dict[str, str] = {"op6_jaccard_join": _OP6, "op8_pivot_search": _OP8, "op10_secret_scan": _op10(), "op12_best_position": _OP12}
