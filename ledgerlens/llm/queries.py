"""Registered queries of this subpackage, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORD = "[^\\x20\\x09-\\x0D]+"


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


SHINGLES_SQL = f"""
w AS (SELECT doc_id, regexp_extract_all({LOWER}, '{WORD}') AS ws FROM {{docs}}),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1)"""

COMPONENTS_SQL = f"""{SHINGLES_SQL},
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(a, b) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY 1),
d AS (SELECT a, count(*) AS n_links FROM e GROUP BY 1)"""


@query("op1_ngram_jaccard", f"""
WITH RECURSIVE {COMPONENTS_SQL.format(docs='documents')}
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, w.doc_id) AS component_id, coalesce(d.n_links, 0) AS n_links
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.a = w.doc_id LEFT JOIN d ON d.a = w.doc_id""")
def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"))


@query("op2_deleted_interpolation")
def op2_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .interpolation_lm import interpolated_scores

    return interpolated_scores(table(spark, sf_dir, "documents"))


def _op4_sql() -> str:
    from .quality_rules import ALPHA, CUTOFFS, DELTA, RULES

    a = ALPHA / len(RULES)
    share = lambda x, y: f"CASE WHEN {y} > 0 THEN {x}::DOUBLE / {y} ELSE 0.0 END"
    values = {"symbols": share("n_symbols", "word_chars"), "dup_lines": share("n_dup_lines", "n_lines"), "repeats": share("n_repeat_words", "n_words"),
              "upper": share("n_upper", "word_chars"), "same_words": "CASE WHEN n_words > 0 THEN 1 - n_distinct::DOUBLE / n_words ELSE 0.0 END"}
    long = " UNION ALL ".join(f"SELECT doc_id, stratum, base_failed, '{r}' AS rule, {values[r]} AS x FROM m" for r in RULES)
    return f"""
WITH w AS (SELECT doc_id, coalesce('=' || lang, 'null') AS stratum, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(ws) - 3)) AS i, unnest(list_transform(range(1, len(ws) - 3), lambda i: ws[i:i + 4])) AS g FROM w WHERE len(ws) >= 5),
d AS (SELECT doc_id, g FROM g GROUP BY ALL HAVING count(*) > 1),
c AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM g JOIN d USING (doc_id, g), range(5) AS o(k) GROUP BY 1),
m0 AS (SELECT w.doc_id, stratum, len(ws) AS n_words, len(list_distinct(ws)) AS n_distinct, coalesce(length(array_to_string(ws, '')), 0) AS word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(regexp_extract_all(t, '\\p{{Lu}}')) AS n_upper, len(lines) AS n_lines,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words FROM w LEFT JOIN c USING (doc_id)),
m AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m0),
v AS ({long}),
good AS (SELECT v.* FROM v SEMI JOIN (SELECT doc_id FROM labels WHERE quality = 1) l USING (doc_id) WHERE NOT base_failed),
strata AS (SELECT count(DISTINCT stratum) AS s FROM good),
grid AS (SELECT unnest({list(CUTOFFS)}) AS cutoff, unnest(range({len(CUTOFFS)})) AS j),
k AS (SELECT stratum, rule, j, cutoff, count(*) AS n, count(*) FILTER (x > cutoff) AS k FROM good, grid GROUP BY ALL),
p AS (SELECT k.*, CASE WHEN k >= n * {a} THEN 1.0 ELSE (SELECT sum(exp(lgamma(n + 1.0) - lgamma(i + 1.0) - lgamma(n - i + 1.0) + i * ln({a}) + (n - i) * ln(1 - {a}))) FROM range(k + 1) AS o(i)) END AS p FROM k),
ok AS (SELECT *, min(CASE WHEN p <= {DELTA} / ({len(RULES)} * s) THEN 1 ELSE 0 END) OVER (PARTITION BY stratum, rule ORDER BY j) AS so_far FROM p, strata),
cut AS (SELECT stratum, rule, min(cutoff) AS cutoff FROM ok WHERE so_far = 1 GROUP BY ALL),
bad AS (SELECT DISTINCT doc_id FROM v JOIN cut USING (stratum, rule) WHERE x > cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM bad) AS kept FROM m"""


@query("op4_quality_rules", _op4_sql())
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import quality_verdicts

    verdicts, _ = quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return verdicts.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op8_license_scan")
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .license_rules import license_scan

    return license_scan(table(spark, sf_dir, "documents"))


@query("op10_secret_links")
def op10_secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .secret_links import secret_spans

    found = secret_spans(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


CONTAINED_SQL = f"""
iw AS (SELECT item_id, ws, least(len(ws), 5) AS k FROM (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '{WORD}') AS ws FROM benchmark) WHERE len(ws) > 0),
its AS (SELECT DISTINCT item_id, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS s FROM iw),
q AS (SELECT item_id, count(*) AS n_item FROM its GROUP BY 1),
dw AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '{WORD}') AS ws FROM {{docs}}),
ds AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS s FROM dw, (SELECT DISTINCT k FROM iw) WHERE len(ws) >= k),
hits AS (SELECT doc_id, item_id, n_item, n_found FROM (SELECT doc_id, item_id, count(*) AS n_found FROM ds JOIN its USING (s) GROUP BY ALL) JOIN q USING (item_id) WHERE 5 * n_found >= 4 * n_item)"""


@query("op3_benchmark_containment", f"WITH {CONTAINED_SQL.format(docs='documents')} SELECT * FROM hits")
def op3_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .decontaminate import contained_items

    found = contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "item_id", "n_item", "n_found")


LINES_SQL = """
l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM {docs} WHERE text IS NOT NULL),
f AS (SELECT line, min(doc_id) AS f FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY line HAVING count(DISTINCT source) >= 10),
x AS (SELECT l.*, f IS NOT NULL AND f <> doc_id AS gone FROM l LEFT JOIN f USING (line)),
cleaned AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text,
    NOT bool_or(gone) OR coalesce(bool_or(regexp_matches(line, '[^\\x20\\x09-\\x0D]')) FILTER (NOT gone), false) AS kept FROM x GROUP BY doc_id)"""


@query("op6_line_spread", f"WITH {LINES_SQL.format(docs='documents')} SELECT * FROM cleaned")
def op6_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_spread import deduplicated

    return deduplicated(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "kept", "text")


@query("op9_sentencepiece")
def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sentencepiece_codec import encoded_table

    return encoded_table(table(spark, sf_dir, "documents"))


@query("op5_personal_data")
def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .pii_crf import personal_data

    found = personal_data(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


@query("op7_knn_quality")
def op7_knn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .knn_quality import quality_scores

    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_FIELD = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "{n}", "text")) + ")"
_CRC32 = """xor(4294967295::BIGINT, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: list_reduce(list_concat([xor(a, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)))"""


@query("op12_merkle_manifest", f"""
WITH RECURSIVE l AS (SELECT doc_id, lang, {_LEAF.format(n='n_chars')} AS leaf, CASE WHEN {_CRC32} % 7 = 0 THEN {_LEAF.format(n='(n_chars + 1)')} END AS changed FROM documents),
o AS (SELECT *, row_number() OVER () AS row, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM l),
t(lang, lv, pos, h, n) AS (SELECT lang, 0, pos, leaf, n FROM o
    UNION ALL SELECT lang, lv + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM t WHERE n > 1 GROUP BY lang, lv, pos // 2, n),
g AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
u(lv, pos, h, n) AS (SELECT 0, pos, subroot, n FROM g
    UNION ALL SELECT lv + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM u WHERE n > 1 GROUP BY lv, pos // 2, n),
f(row, lang, lv, pos, n, sibs, h) AS (SELECT row, lang, 0, pos, n, '', coalesce(changed, leaf) FROM o
    UNION ALL SELECT row, f.lang, f.lv + 1, f.pos // 2, (f.n + 1) // 2, sibs || coalesce(t.h, ''), sha256(CASE WHEN f.pos % 2 = 1 THEN t.h || f.h ELSE f.h || coalesce(t.h, '') END)
    FROM f LEFT JOIN t ON t.lang IS NOT DISTINCT FROM f.lang AND t.lv = f.lv AND t.pos = xor(f.pos, 1) WHERE f.n > 1),
e(row, lv, pos, n, sibs, h) AS (SELECT row, 0, g.pos, g.n, sibs, h FROM f JOIN g ON f.lang IS NOT DISTINCT FROM g.lang WHERE f.n = 1
    UNION ALL SELECT row, e.lv + 1, e.pos // 2, (e.n + 1) // 2, sibs || coalesce(u.h, ''), sha256(CASE WHEN e.pos % 2 = 1 THEN u.h || e.h ELSE e.h || coalesce(u.h, '') END)
    FROM e LEFT JOIN u ON u.lv = e.lv AND u.pos = xor(e.pos, 1) WHERE e.n > 1)
SELECT doc_id, leaf, subroot, r.h AS root, sha256(sibs) AS proof_sha256, e.h AS folded_root, e.h = r.h AS verified
FROM o JOIN e USING (row) JOIN g ON o.lang IS NOT DISTINCT FROM g.lang, (SELECT h FROM u WHERE n = 1) r WHERE e.n = 1""")
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .merkle_manifest import document_manifest

    return document_manifest(table(spark, sf_dir, "documents"))


def _op13_sql() -> str:
    from .vector_codes import ENTRIES, PARTS, ROUNDS, SCALE

    def assigned(k: int) -> str:
        return f"""
a{k} AS MATERIALIZED (SELECT id, part, any_value(x) AS x, arg_min(e, d * {ENTRIES} + e) AS e, min(d) AS d
    FROM (SELECT id, part, x, b{k}.e, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM p JOIN b{k} USING (part)) GROUP BY id, part)"""

    def refined(k: int) -> str:
        return f""",
m{k} AS (SELECT part, e, i, sum(y) AS s, count(*) AS n FROM (SELECT part, e, unnest(x) AS y, unnest(range(len(x))) AS i FROM a{k}) GROUP BY part, e, i),
b{k + 1} AS MATERIALIZED (SELECT b.part, b.e, coalesce(u.c, b.c) AS c FROM b{k} b LEFT JOIN (
    SELECT part, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS c FROM m{k} GROUP BY part, e) u USING (part, e)),"""

    rounds = "".join(assigned(k) + refined(k) for k in range(ROUNDS)) + assigned(ROUNDS)
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS id, vec_id, label, list_transform(embedding, lambda x: floor({SCALE}.0 * x::DOUBLE)::BIGINT) AS q,
    row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS e FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT id, e, part, q[part * (len(q) // {PARTS}) + 1:(part + 1) * (len(q) // {PARTS})] AS x FROM v, range({PARTS}) r(part)),
b0 AS MATERIALIZED (SELECT part, e, x AS c FROM p WHERE e < {ENTRIES}),{rounds},
h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, e)) AS codebooks_sha256 FROM b{ROUNDS}),
o AS (SELECT id, string_agg(format('{{:02x}}', e), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a{ROUNDS} GROUP BY id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM v JOIN o USING (id), h"""


@query("op13_vector_codes", _op13_sql())
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .vector_codes import vector_codes

    return vector_codes(table(spark, sf_dir, "embeddings")).drop("label")


@query("op11_near_vectors", """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS row, vec_id, embedding::DOUBLE[] AS x,
    coalesce(len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false) AS ok FROM embeddings),
e AS MATERIALIZED (SELECT a.row AS a, b.row AS b FROM v a JOIN v b ON a.row <> b.row AND len(a.x) = len(b.x) WHERE a.ok AND b.ok AND CASE WHEN a.ok AND b.ok THEN list_cosine_similarity(a.x, b.x) >= 0.95 END),
r(a, b) AS (SELECT row, row FROM v UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT r.a AS row, min(v.vec_id) AS component_id FROM r JOIN v ON v.row = r.b GROUP BY 1),
d AS (SELECT a AS row, count(*) AS n FROM e GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept FROM v JOIN c USING (row) LEFT JOIN d USING (row)""")
def op11_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_vectors import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings"))
