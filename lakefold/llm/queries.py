"""Queries of the operators of this package, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakefold.llm import (
    bm25, collocations, decontam, html_text, licenses, manifest, mixing, near_dup, pii, quality, token_count, toxicity, vector_dup,
)
from lakefold.llm.common import LOWER, UPPER, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@register("op7_benchmark_decontamination", f"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + 9], ' ') AS win
  FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
spot AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM d, (SELECT DISTINCT size FROM win) s, unnest(range(1, len(w) - size + 2)) AS t(i)),
hit AS (SELECT spot.doc_id, spot.i, spot.size, win.item_id FROM spot JOIN win USING (size, win)),
words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM hit, unnest(range(i, i + size)) AS t(k) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids
  FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside a ten-word window of a benchmark item."""
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


@register("op10_token_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each document under the 32k piece vocabulary."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_count.with_token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@register("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from labels outside the held-out quarter."""
    return toxicity.with_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op6_quality_classifier")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt from labels outside the held-out fifth."""
    return quality.with_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op9_personal_data")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: pattern spans and tagged spans."""
    return pii.report(table(spark, sf_dir, "documents"))


MIX_WEIGHTS = [3.0, 1.0, 2.0]


@register("op4_source_mixing", f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
    (CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0 AS u
  FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, CAST(list_extract([3.0, 1.0, 2.0], (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1) AS DOUBLE) AS w, 2.0::DOUBLE * source_size AS most FROM s0),
s2 AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY most / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s1),
lv AS (SELECT arg_min(level, most / w) AS level FROM s2 WHERE level <= most / w),
t AS (SELECT source, source_size, least(most, coalesce((SELECT level FROM lv) * w, most)) AS target FROM s1),
e AS (
  SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN least(target * 1.0::DOUBLE / source_size, 2.0::DOUBLE) ELSE 0 END AS e
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
z AS (
  SELECT *, floor(e) AS whole, CASE WHEN e > floor(e) AND size > 0 THEN u * (1 - (e - floor(e))) / (u * (1 - (e - floor(e))) + (1 - u) * (e - floor(e))) END AS z,
    target - sum(size * floor(e)) OVER (PARTITION BY source) AS lack FROM e),
o AS (SELECT source, z, lack, sum(size) AS words, row_number() OVER (PARTITION BY source ORDER BY z) AS k FROM z WHERE z IS NOT NULL GROUP BY source, z, lack),
walk AS (
  SELECT source, z, k, words <= lack AS fits, CASE WHEN words <= lack THEN lack - words ELSE lack END AS gap FROM o WHERE k = 1
  UNION ALL
  SELECT o.source, o.z, o.k, o.words <= w.gap, CASE WHEN o.words <= w.gap THEN w.gap - o.words ELSE w.gap END
  FROM walk w JOIN o ON o.source IS NOT DISTINCT FROM w.source AND o.k = w.k + 1)
SELECT doc_id, size, source_size, target, CAST(size * (whole + CAST(coalesce(fits, false) AS INT)) AS BIGINT) AS taken
FROM z LEFT JOIN walk w ON w.source IS NOT DISTINCT FROM z.source AND w.z = z.z""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document."""
    return mixing.report(table(spark, sf_dir, "documents"), MIX_WEIGHTS)


@register("op3_near_duplicates", f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4]) END) AS shingle
  FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 75 * (x.n + y.n - i)),
walk AS (SELECT doc_id AS id, doc_id AS reach FROM d UNION SELECT w.id, l.b FROM walk w JOIN link l ON l.a = w.reach),
comp AS (SELECT id, min(reach) AS component_id FROM walk GROUP BY id)
SELECT doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM d JOIN comp ON comp.id = doc_id LEFT JOIN n USING (doc_id)""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose five-word shingles agree in three quarters."""
    return near_dup.duplicates(table(spark, sf_dir, "documents"))


@register("op2_html_extraction")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of every page."""
    return html_text.report(table(spark, sf_dir, "pages"))


@register("op1_top_k_search")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every document whose id is divisible by 20."""
    return bm25.similar(table(spark, sf_dir, "documents"), F.col("doc_id") % 20 == 0)


@register("op8_license_scan")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in every document."""
    return licenses.report(table(spark, sf_dir, "documents"))


def _field(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(text if c == "text" else c) for c in manifest.FIELDS) + ")"


# crc32 of the decimal id: per byte eight steps of the reflected polynomial (fixed value 3988292384).
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
  lambda acc, b: list_reduce(list_prepend(xor(acc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda x, z: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT)"""


def _tree(name: str, base: str, mine: str) -> str:
    """Nodes of all levels above ``base`` (g, pos, n, h, lvl 0), and with the digests beside them."""
    run = f"PARTITION BY {mine}lvl, pos // 16 ORDER BY pos ROWS BETWEEN"
    return f"""{name} AS (
  SELECT 0 AS lvl, {mine}pos, n, h FROM {base}
  UNION ALL
  SELECT lvl + 1, {mine}pos // 16, any_value((n + 15) // 16), sha256(string_agg(h, '' ORDER BY pos)) FROM {name}
  WHERE n > 1 GROUP BY {mine}lvl, pos // 16),
{name}_beside AS (
  SELECT *, coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name})"""


@register("op12_merkle_manifest", f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('=' || source, '') AS g, {_leaf("text")} AS h,
    CASE WHEN {_CRC} % 5 = 0 THEN {_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END AS other FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM leaves),
{_tree("own", "placed", "g, ")},
subs AS (SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM own WHERE n = 1),
{_tree("top", "subs", "")},
folded AS (
  SELECT doc_id, g, h AS leaf, pos, n, 0 AS lvl, coalesce(other, h) AS cur, '' AS proof FROM placed
  UNION ALL
  SELECT f.doc_id, f.g, f.leaf, f.pos // 16, (f.n + 15) // 16, f.lvl + 1, sha256(b.l || f.cur || b.r), f.proof || b.l || b.r
  FROM folded f JOIN own_beside b ON b.g = f.g AND b.lvl = f.lvl AND b.pos = f.pos WHERE f.n > 1),
whole AS (
  SELECT f.doc_id, f.leaf, s.h AS subroot, s.pos, s.n, 0 AS lvl, f.cur, f.proof FROM folded f JOIN subs s ON s.g = f.g WHERE f.n = 1
  UNION ALL
  SELECT f.doc_id, f.leaf, f.subroot, f.pos // 16, (f.n + 15) // 16, f.lvl + 1, sha256(b.l || f.cur || b.r), f.proof || b.l || b.r
  FROM whole f JOIN top_beside b ON b.lvl = f.lvl AND b.pos = f.pos WHERE f.n > 1),
root AS (SELECT h AS root FROM top WHERE n = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = root AS verified
FROM whole, root WHERE n = 1""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Merkle manifest of all documents, folded from rows of which a fifth are tampered with."""
    return manifest.lowered_fifth(table(spark, sf_dir, "documents"))


@register("op13_phrase_collocations", f"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS text FROM documents),
pieces AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\\n-\\r]')) AS piece FROM d),
words AS (SELECT lang, regexp_extract_all(piece, '[^ \\t]+') AS w FROM pieces),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, 1 AS size, unnest(w) AS phrase FROM words
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words WHERE len(w) >= 2
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM words WHERE len(w) >= 3),
f AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 10),
c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size >= 2),
sides AS (
  SELECT lang, phrase, a, 1 AS k, w[1] AS head, array_to_string(w[2:], ' ') AS rest FROM c
  UNION ALL SELECT lang, phrase, a, 2, w[1] || ' ' || w[2], w[3] FROM c WHERE size = 3),
cut AS (
  SELECT s.*, l.f AS l, r.f AS r, (1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f) AS score
  FROM sides s JOIN f l ON l.lang = s.lang AND l.phrase = head JOIN f r ON r.lang = s.lang AND r.phrase = rest),
lowest AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, phrase, max(a) AS b FROM (
    SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM c WHERE size = 3 UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM c WHERE size = 3)
  GROUP BY ALL),
kept AS (SELECT s.* FROM lowest s LEFT JOIN longer g ON g.lang = s.lang AND g.phrase = s.phrase WHERE b IS NULL OR 100 * b < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN total USING (lang) WHERE rank <= 2000""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 strongest collocations of each language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


@register("op11_embedding_near_duplicates", """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
u AS (
  SELECT vec_id, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS u FROM v
  WHERE len(v) > 0 AND list_bool_and(list_transform(v, lambda x: x IS NOT NULL AND isfinite(x))) AND list_dot_product(v, v) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.u) = len(b.u)
  WHERE list_dot_product(a.u, b.u) >= 0.95),
walk AS (SELECT vec_id AS id, vec_id AS reach FROM v UNION SELECT w.id, l.b FROM walk w JOIN link l ON l.a = w.reach),
comp AS (SELECT id, min(reach) AS component_id FROM walk GROUP BY id)
SELECT v.vec_id, (SELECT count(*) FROM link WHERE a = v.vec_id) AS n_links, component_id, component_id = v.vec_id AS kept
FROM v JOIN comp ON comp.id = v.vec_id""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of embeddings with a cosine of 0.95 or more."""
    return vector_dup.duplicates(table(spark, sf_dir, "embeddings"))
