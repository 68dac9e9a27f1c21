"""The registered queries of the text operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .bpe_codec import bpe_digests
from .decontamination import decontamination
from .jaccard_join import jaccard_join
from .lm_scores import lm_scores
from .merkle import lower_cased_text, merkle_manifest
from .packing import packed
from .quality_classifier import quality_classifier
from .quality_rules import quality_rules
from .shared import table
from .spelling import spelling_variants
from .suffix_dedup import suffix_dedup
from .token_counts import token_counts
from .toxicity import toxicity
from .warc import warc_round_trip


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_round_trip(table(spark, sf_dir, "pages"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("key")


def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))


def op9_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest(table(spark, sf_dir, "documents"), presented={"text": lower_cased_text()})


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_quality_rules, op3_toxicity, op4_warc, op5_decontamination, op6_bpe_codec, op7_quality_classifier, op8_jaccard_join,
    op9_lm_scores, op10_suffix_dedup, op11_merkle_manifest, op12_spelling_variants, op13_packing)}
ORACLE: dict[str, str] = {}

ORACLE["op4_warc"] = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages
), q AS (
  SELECT *, min(page_id) OVER (PARTITION BY digest) AS first_id FROM p
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id > first_id THEN first_id END AS refers_to
FROM q
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BENCH_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE["op5_decontamination"] = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {_BENCH_WORDS} AS ws FROM documents
), i AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_BENCH_WORDS} AS ws FROM benchmark
), j AS (
  SELECT item, ws, least(10, len(ws)) AS n, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS k FROM i WHERE len(ws) > 0
), w AS (
  SELECT DISTINCT item, n, array_to_string(ws[k:k + n - 1], ' ') AS win FROM j
), p AS (
  SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM w) WHERE len(ws) >= n
), q AS (
  SELECT r, n, k, array_to_string(ws[k:k + n - 1], ' ') AS win FROM p
), m AS (
  SELECT q.r, q.n, q.k, w.item FROM q JOIN w ON q.n = w.n AND q.win = w.win
), h AS (
  SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS x FROM (SELECT DISTINCT r, n, k FROM m)) GROUP BY r
), t AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM m) GROUP BY r
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)
"""

_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"

ORACLE["op8_jaccard_join"] = f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS ws FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT r, array_to_string(ws[k:k + 3], ' ') AS shingle
  FROM (SELECT r, ws, unnest(range(1, greatest(1, len(ws) - 3) + 1)) AS k FROM d WHERE len(ws) > 0)
), n AS MATERIALIZED (
  SELECT r, count(*) AS n FROM s GROUP BY r
), c AS (
  SELECT a.r AS r, b.r AS o, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.r <> b.r GROUP BY 1, 2
), l AS MATERIALIZED (
  SELECT c.r, c.o FROM c JOIN n x ON x.r = c.r JOIN n y ON y.r = c.o WHERE 100 * common >= 85 * (x.n + y.n - common)
), reach AS (
  SELECT r, r AS o FROM d UNION SELECT reach.r, l.o FROM reach JOIN l ON l.r = reach.o
), m AS (
  SELECT reach.r, min(d.doc_id) AS component_id FROM reach JOIN d ON d.r = reach.o GROUP BY reach.r
)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id FROM d JOIN m USING (r) LEFT JOIN n USING (r)
"""

ORACLE["op10_suffix_dedup"] = """
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), s AS MATERIALIZED (
  SELECT r, doc_id, unnest(range(0, length(h) // 2 - 49)) AS pos,
         hash(unnest(list_transform(range(0, length(h) // 2 - 49), lambda x: substr(h, 2 * x + 1, 100)))) AS str
  FROM d WHERE length(h) >= 100
), w AS (
  SELECT str, min(doc_id) AS least FROM s GROUP BY str
), g AS (
  SELECT s.r, s.pos, coalesce(s.pos - lag(s.pos) OVER (PARTITION BY s.r ORDER BY s.pos) > 50, true) AS begins
  FROM s JOIN w ON w.str = s.str WHERE w.least < s.doc_id
), i AS (
  SELECT r, pos, sum(CAST(begins AS INT)) OVER (PARTITION BY r ORDER BY pos) AS span FROM g
), j AS (
  SELECT r, min(pos) AS a, max(pos) + 50 AS b FROM i GROUP BY r, span
), k AS (
  SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS z FROM j
), t AS (
  SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS reach,
         string_agg(substr(h, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) AS front
  FROM k JOIN d USING (r) GROUP BY r
)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(front, '') || substr(h, 2 * coalesce(reach, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN t USING (r)
"""



def _crc32(text: str) -> str:
    """DuckDB expression: unsigned CRC-32 of the UTF-8 bytes of ``text``, half a byte a step (a byte enters at its first step)."""
    halves = []
    for c in range(16):
        for _ in range(4):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        halves.append(c)
    steps = (f"list_transform(range(2, 2 * strlen({text}) + 2), "
             f"lambda j: CASE WHEN j % 2 = 0 THEN ('0x' || substr(hex(encode({text})), j - 1, 2))::BIGINT ELSE 0 END)")
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}), "
            f"lambda c, b: xor(xor(c, b) >> 4, {halves}[(xor(c, b) & 15) + 1])), 4294967295)")


def _field(col: str) -> str:
    return f"CASE WHEN {col} IS NULL THEN '-' ELSE strlen(CAST({col} AS VARCHAR)) || ':' || {col} END"


def _merkle_sql(levels: int = 10) -> str:
    """Trees of eight children: ``levels`` levels of leaves by language, then as many of subroots (8 ** levels leaves at most)."""
    fields = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    plain = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    sql = f"""
WITH d AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, sha256({fields} || {_field('text')}) AS leaf,
         CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 3 = 0 THEN sha256({fields} || {_field(plain)}) ELSE NULL END AS tampered
  FROM documents
), x AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM d
), a0 AS MATERIALIZED (
  SELECT tree, i, n, leaf AS h FROM x
), pa0 AS MATERIALIZED (
  SELECT *, '' AS proof, coalesce(tampered, leaf) AS folded FROM x
)"""

    def ladder(a: str, p: str) -> str:
        out = ""
        for k in range(levels):
            out += f""", r{a}{k} AS MATERIALIZED (
  SELECT tree, i // 8 AS i, n, list(h ORDER BY i) AS run FROM {a}{k} GROUP BY tree, i // 8, n
), {a}{k + 1} AS MATERIALIZED (
  SELECT tree, i, (n + 7) // 8 AS n, CASE WHEN n > 1 THEN sha256(array_to_string(run, '')) ELSE run[1] END AS h FROM r{a}{k}
), {p}{k + 1} AS MATERIALIZED (
  SELECT p.* EXCLUDE (i, n, proof, folded), p.i // 8 AS i, (p.n + 7) // 8 AS n,
         CASE WHEN p.n > 1 THEN proof || array_to_string(run[:p.i % 8], '') || array_to_string(run[p.i % 8 + 2:], '') ELSE proof END AS proof,
         CASE WHEN p.n > 1 THEN sha256(array_to_string(run[:p.i % 8], '') || folded || array_to_string(run[p.i % 8 + 2:], '')) ELSE folded END AS folded
  FROM {p}{k} p JOIN r{a}{k} r ON p.tree = r.tree AND p.i // 8 = r.i
)"""
        return out

    sql += ladder("a", "pa")
    sql += f""", s AS MATERIALIZED (
  SELECT tree AS name, h, row_number() OVER (ORDER BY encode(tree)) - 1 AS i, count(*) OVER () AS n FROM a{levels}
), b0 AS MATERIALIZED (
  SELECT 0 AS tree, i, n, h FROM s
), pb0 AS MATERIALIZED (
  SELECT p.doc_id, p.leaf, p.proof, p.folded, s.h AS subroot, 0 AS tree, s.i, s.n FROM pa{levels} p JOIN s ON s.name = p.tree
)"""
    sql += ladder("b", "pb")
    return sql + f"""
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = h AS verified
FROM pb{levels} p JOIN b{levels} b ON b.tree = p.tree
"""


ORACLE["op11_merkle_manifest"] = _merkle_sql()

ORACLE["op12_spelling_variants"] = f"""
WITH RECURSIVE r AS (
  SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[A-Za-zÀ-ÿ]+')) AS run FROM documents
), c AS (
  SELECT doc_id, run, count(*) AS m FROM r WHERE length(run) >= 7 GROUP BY doc_id, run
), h AS (
  SELECT run, m, {_crc32("(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || run)")} AS h FROM c
), e AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, m FROM h
), w AS MATERIALIZED (
  SELECT word, CAST(sum(m) AS BIGINT) AS n FROM e WHERE length(word) >= 7 GROUP BY word HAVING sum(m) >= 2
), k AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)
), p AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM k a JOIN k b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT k.word, w.word, w.n FROM k JOIN w ON w.word = k.rest
  UNION SELECT w.word, k.word, k.n FROM k JOIN w ON w.word = k.rest
), q AS (
  SELECT *, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, encode(other)) AS rk, count(*) OVER (PARTITION BY word) AS n_near FROM p
), f AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * w.n THEN other END AS form,
         CASE WHEN other_n >= 10 * w.n THEN other_n END AS form_n
  FROM w LEFT JOIN q ON q.word = w.word AND q.rk = 1
), t AS (
  SELECT word, word AS root FROM f UNION ALL SELECT t.word, f.form FROM t JOIN f ON f.word = t.root WHERE f.form IS NOT NULL
), u AS (
  SELECT t.word, t.root FROM t JOIN f ON f.word = t.root WHERE f.form IS NULL
)
SELECT f.word, form, u.root, n, CAST(n_near AS BIGINT) AS n_near, form_n FROM f JOIN u USING (word)
"""
