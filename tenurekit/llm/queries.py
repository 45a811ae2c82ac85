"""The registered queries of this subpackage: each applies one operator, with
production parameters, to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, decontam, divergence, fim, html_main, kn_lm, lang_id, license_scan, mixing, near_dup, pii_weak, quality_fm, quality_rules
from .base import id_crc, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


# ---- 1 quality rules ----------------------------------------------------

_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(quality_rules.STOP_WORDS))

OP1_SQL = rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
win AS (
  SELECT r, i, list_slice(w, i, i + 7) AS x
  FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
rep AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, x) AS c FROM win) WHERE c > 1),
cover AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM rep) GROUP BY r),
f AS (
  SELECT d.doc_id, lang, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(l) AS n_lines,
         len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(cover.n, 0) AS n_repeat_words,
         len(regexp_extract_all(t, '[!?]')) AS n_marks, len(regexp_extract_all(t, '[A-Z]')) AS n_caps,
         len(list_filter(w, lambda x: list_contains([{_STOP}], lower(rtrim(x, '.,;:'))))) AS n_stop
  FROM d LEFT JOIN cover USING (r)),
g AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    list_filter([
      CASE WHEN n_words < 20 THEN 'too_short' END,
      CASE WHEN n_words > 0 AND n_repeat_words / n_words > 0.30 THEN 'repeats' END,
      CASE WHEN (CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END) NOT BETWEEN 2 AND 14 THEN 'word_length' END,
      CASE WHEN n_words > 0 AND n_symbols / n_words > 0.10 THEN 'symbols' END,
      CASE WHEN n_words > 0 AND n_marks / n_words > 0.25 THEN 'shouting' END,
      CASE WHEN word_chars > 0 AND n_caps / word_chars > 0.40 THEN 'capitals' END,
      CASE WHEN coalesce(lang IN ('en', 'de', 'fr', 'es'), TRUE) AND (n_words = 0 OR n_stop / n_words < 0.02) THEN 'few_stop_words' END,
      CASE WHEN n_lines > 0 AND n_dup_lines / n_lines > 0.50 THEN 'repeated_lines' END], lambda x: x IS NOT NULL) AS failed
  FROM f)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       array_to_string(failed, ',') AS failed_rules, NOT base_failed AND len(failed) = 0 AS kept
FROM g"""


@_register("op1_quality_rules", OP1_SQL)
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(table(spark, sf_dir, "documents"))


# ---- 2 quality classifier -------------------------------------------------


@_register("op2_quality_fm")
def op2_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_crc() % 4 == 2
    machine = quality_fm.train(docs.filter(~held_out), table(spark, sf_dir, "labels"))
    return quality_fm.score(docs, machine).select("doc_id", held_out.alias("held_out"), "score", "predicted")


# ---- 3 license scan -------------------------------------------------------


@_register("op3_license_scan")
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(table(spark, sf_dir, "documents"))
    spans = F.transform("spans", lambda x: F.concat_ws(":", x["label"], x["start_word"], x["end_word"], x["edits"]))
    return found.withColumn("spans", F.array_join(spans, ","))


# ---- 4 near duplicates ----------------------------------------------------

OP4_SQL = r"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT r, doc_id, array_to_string(list_slice(w, i, i + 3), ' ') AS s
  FROM (SELECT r, doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT r, doc_id, count(*) AS n FROM sh GROUP BY r, doc_id),
pairs AS (
  SELECT a.r AS ra, b.r AS rb, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.r < b.r
  WHERE a.doc_id IS NOT NULL AND b.doc_id IS NOT NULL GROUP BY ALL),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM pairs JOIN n x ON x.r = ra JOIN n y ON y.r = rb
  WHERE 100 * c >= 80 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT DISTINCT doc_id AS a, doc_id AS b FROM w WHERE doc_id IS NOT NULL
  UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, coalesce(w.doc_id = component_id, TRUE) AS kept
FROM w LEFT JOIN n USING (r) LEFT JOIN comp ON w.doc_id = comp.doc_id"""


@_register("op4_near_dup", OP4_SQL)
def op4_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.components(table(spark, sf_dir, "documents"))


# ---- 5 language model -------------------------------------------------------

OP5_SQL = r"""
WITH tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
         lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, list_append(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), ' end') AS w,
         xor(list_reduce(list_concat([4294967295], list_transform(list_filter(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda x: x <> ''), lambda x: ascii(x)::BIGINT)),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 7 = 2 AS held_out
  FROM documents, tab),
tok AS (
  SELECT r, held_out, unnest(w) AS w, unnest(list_prepend(' begin', list_slice(w, 1, len(w) - 1))) AS h FROM d),
c1 AS (SELECT w, count(*) AS c FROM tok WHERE NOT held_out GROUP BY w),
tot AS (SELECT coalesce(sum(c), 0)::BIGINT AS n, count(*) AS v FROM c1),
c2 AS (SELECT h, w, count(*) AS c FROM tok WHERE NOT held_out GROUP BY h, w),
ctx AS (SELECT h, sum(c) AS c, count_if(c = 1) AS n1, count_if(c = 2) AS n2, count_if(c >= 3) AS n3 FROM c2 GROUP BY h),
cont AS (SELECT w, count(*) AS a FROM c2 GROUP BY w),
coc AS (
  SELECT 'high' AS k, count_if(c = 1)::DOUBLE AS n1, count_if(c = 2)::DOUBLE AS n2, count_if(c = 3)::DOUBLE AS n3, count_if(c = 4)::DOUBLE AS n4 FROM c2
  UNION ALL SELECT 'low', count_if(a = 1), count_if(a = 2), count_if(a = 3), count_if(a = 4) FROM cont),
y AS (SELECT *, CASE WHEN n1 + n2 > 0 THEN n1 / (n1 + 2 * n2) ELSE 0.5 END AS y FROM coc),
disc AS (
  SELECT k, least(greatest(CASE WHEN n1 > 0 THEN 1 - 2 * y * n2 / n1 ELSE 0.5 END, 0), 1) AS d1,
         least(greatest(CASE WHEN n2 > 0 THEN 2 - 3 * y * n3 / n2 ELSE 1 END, 0), 2) AS d2,
         least(greatest(CASE WHEN n3 > 0 THEN 3 - 4 * y * n4 / n3 ELSE 1.5 END, 0), 3) AS d3 FROM y),
lo AS (
  SELECT sum(a)::DOUBLE AS total, (any_value(d1) * count_if(a = 1) + any_value(d2) * count_if(a = 2) + any_value(d3) * count_if(a >= 3)) / sum(a) AS rest
  FROM cont, disc WHERE k = 'low'),
low AS (SELECT w, (a - CASE WHEN a = 1 THEN d1 WHEN a = 2 THEN d2 ELSE d3 END) / total AS p FROM cont, disc, lo WHERE k = 'low'),
p AS (
  SELECT tok.r, coalesce(c1.c, 0) AS c, n, v,
         coalesce(low.p, 0) + coalesce(lo.rest, 1) / (v + 1) AS pl,
         CASE WHEN c2.c IS NULL THEN 0 ELSE (c2.c - CASE WHEN c2.c = 1 THEN d1 WHEN c2.c = 2 THEN d2 ELSE d3 END) / ctx.c END AS ph,
         CASE WHEN ctx.c IS NULL THEN 1 ELSE (d1 * ctx.n1 + d2 * ctx.n2 + d3 * ctx.n3) / ctx.c END AS g
  FROM tok CROSS JOIN tot CROSS JOIN lo JOIN disc ON disc.k = 'high' LEFT JOIN c1 USING (w) LEFT JOIN low USING (w)
  LEFT JOIN ctx ON ctx.h = tok.h LEFT JOIN c2 ON c2.h = tok.h AND c2.w = tok.w),
s AS (
  SELECT r, count(*) AS n_tokens, count_if(c > 0) AS n_known, any_value(n) AS n, sum(log10((c + 1) / (n + v + 1))) AS base, sum(log10(ph + g * pl)) AS score
  FROM p GROUP BY r)
SELECT doc_id, held_out, n_tokens::BIGINT AS n_tokens, n_known::BIGINT AS n_known, n AS train_tokens, base AS base_score, score FROM d JOIN s USING (r)"""


@_register("op5_kneser_ney", OP5_SQL)
def op5_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kn_lm.score(table(spark, sf_dir, "documents"))


# ---- 6 personal data --------------------------------------------------------


@_register("op6_pii_weak")
def op6_pii_weak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_weak.find_personal_data(table(spark, sf_dir, "documents"))


# ---- 7 benchmark decontamination ----------------------------------------

OP7_SQL = r"""
WITH dw AS MATERIALIZED (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bwin AS (
  SELECT DISTINCT item_id, len(x) AS n, array_to_string(x, ' ') AS x FROM (
    SELECT item_id, list_slice(w, i, i + 9) AS x FROM (
      SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM bw WHERE len(w) > 0))),
lens AS (SELECT DISTINCT n FROM bwin),
dwin AS (
  SELECT r, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS x FROM (
    SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, lens WHERE len(w) >= n)),
hit AS (SELECT r, item_id, i, dwin.n FROM dwin JOIN bwin ON dwin.x = bwin.x AND dwin.n = bwin.n),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS s
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS k FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words USING (r) LEFT JOIN items USING (r)"""


@_register("op7_decontamination", OP7_SQL)
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# ---- 8 language identification ----------------------------------------------


@_register("op8_lang_id")
def op8_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_crc() % 3 == 1
    model = lang_id.learn(docs.filter(~held_out))
    return lang_id.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


# ---- 9 main text of pages -----------------------------------------------------


@_register("op9_html_main")
def op9_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract_main_text(table(spark, sf_dir, "pages"))


# ---- 10 mixing ------------------------------------------------------------

OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         (('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (
  SELECT *, [5.0, 2.0, 1.0][1 + ((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3)::INT]::DOUBLE AS w FROM s0),
s2 AS (
  SELECT *, source_size * 2.0 / w AS lev, sum(source_size) OVER () * 1.5::DOUBLE AS tot, sum(w) OVER () AS wtot,
         coalesce(sum(source_size) OVER b, 0) * 2.0::DOUBLE AS full_size, coalesce(sum(w) OVER b, 0) AS full_w
  FROM s1 WINDOW b AS (ORDER BY source_size * 2.0 / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s3 AS (SELECT *, (tot - full_size)::DOUBLE / (wtot - full_w)::DOUBLE AS at_level FROM s2),
s4 AS (SELECT *, max(CASE WHEN at_level <= lev THEN at_level END) OVER () AS level FROM s3),
t AS (
  SELECT source, source_size, CASE WHEN level IS NULL OR lev <= level THEN source_size * 2.0::DOUBLE ELSE w * level END AS target FROM s4),
r AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS ratio FROM t),
x AS (
  SELECT d.*, source_size, target, floor(ratio) AS whole, ratio - floor(ratio) AS p, target - floor(ratio) * source_size AS rest,
         greatest(source_size // count(*) OVER (PARTITION BY d.source), 1) AS a
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source),
x2 AS (SELECT *, ((1000 * (a - size)) // (a + size)) AS sx FROM (SELECT * REPLACE (a::BIGINT AS a) FROM x)),
x3 AS (SELECT *, CASE WHEN source_size > 0 THEN (sum(size * sx) OVER (PARTITION BY source))::DOUBLE / source_size::DOUBLE ELSE 0 END AS mx FROM x2),
x4 AS (SELECT *, least(greatest(p + least(p, 1 - p) * (sx - mx) / 2000.0::DOUBLE, 1e-9::DOUBLE), (1 - 1e-9)::DOUBLE) AS pi FROM x3),
x5 AS (SELECT *, (u / (1 - u)) / (pi / (1 - pi)) AS q FROM x4),
y AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY q / (1 + q), doc_id, size
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size / 2 AS mid
  FROM x5 WHERE p > 0),
z AS (
  SELECT doc_id, size, source_size, target, whole + (CASE WHEN mid <= rest THEN 1 ELSE 0 END) AS copies FROM y
  UNION ALL SELECT doc_id, size, source_size, target, whole FROM x WHERE p <= 0)
SELECT doc_id, size, source_size, target, copies::BIGINT AS copies, (copies * size)::BIGINT AS taken FROM z"""


@_register("op10_mixing", OP10_SQL)
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


# ---- 11 source divergence audit ---------------------------------------------

OP11_SQL = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
t AS MATERIALIZED (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term, count(*) AS c FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
cnt AS (SELECT lang, source, term, count(*) AS c FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang),
n AS (SELECT g.lang, g.source, coalesce(sum(c), 0) AS n FROM g LEFT JOIN cnt USING (lang, source) GROUP BY ALL),
p AS MATERIALIZED (
  SELECT n.lang, n.source, kept.term, coalesce(cnt.c, 0) AS c,
         1 + (1000000000::HUGEINT * (coalesce(cnt.c, 0) + 1)) // (n.n + v.v)::HUGEINT AS p,
         1 + (1000000000::HUGEINT * (kept.c + 1)) // (v.n + v.v)::HUGEINT AS q
  FROM n JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN cnt ON cnt.lang = n.lang AND cnt.source = n.source AND cnt.term = kept.term),
pr AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pr.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pr ON pr.lang = a.lang AND pr.source = a.source AND pr.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM p WHERE c > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= 200"""


@_register("op11_source_divergence", OP11_SQL)
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


# ---- 12 byte-level BPE --------------------------------------------------------


def byte_bpe_path() -> str:
    """The production vocabulary file (the operator takes any path)."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@_register("op12_byte_bpe")
def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = byte_bpe.load(spark, byte_bpe_path())
    ids = byte_bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary)
    both = byte_bpe.decode(ids.select("doc_id", "ids"), vocabulary)
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


# ---- 13 fill in the middle ------------------------------------------------------

OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
x AS (
  SELECT *, len(w) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
         ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
y AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS z,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM x),
p AS (
  SELECT *, array_to_string(list_slice(w, 1, a), '') AS pre, array_to_string(list_slice(w, a + 1, z), '') AS mid,
         array_to_string(list_slice(w, z + 1, n), '') AS suf FROM y),
o AS (
  SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
            ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END AS out FROM p),
r AS (
  SELECT *, strpos(out, '<P>') AS ip, strpos(out, '<S>') AS si, strpos(out, '<M>') AS im FROM o)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars, sha256(out) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN out
         WHEN 'psm' THEN substr(out, 4, si - 4) || substr(out, im + 3) || substr(out, si + 3, im - si - 3)
         ELSE substr(out, ip + 3, im - ip - 3) || substr(out, im + 3) || substr(out, 4, ip - 4) END) AS restored_sha256
FROM r"""


@_register("op13_fill_in_middle", OP13_SQL)
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.transform(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text", "pieces")
    return fim.restore(made).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")
