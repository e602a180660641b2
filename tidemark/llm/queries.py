"""One query for each operator, over its whole table, and the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bytededup,
    decontamination,
    idfiles,
    jaccard,
    language,
    nearest,
    neardup,
    packing,
    pages,
    prefixtree,
    quality,
    repair,
    worddedup,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontamination.digest(found)


@query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), keep_ids=False)


def _fold(count: int) -> Column:
    """The remainder that says which rows are held out."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % count


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = F.coalesce(_fold(3) == 1, F.lit(False))
    model = language.fit(documents.where(~held_out))
    return language.predict(documents, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


@query
def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(_fold(4) == 2, F.lit(False))
    model = quality.fit(documents, labels.where(~held_out))
    predicted = (F.col("score") >= 0.7).cast("int").alias("predicted")
    return quality.scores(documents, model).select("doc_id", held_out.alias("held_out"), "score", predicted)


@query
def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytededup.digest(table(spark, sf_dir, "documents"))


@query
def op7_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idfiles.ids_of(table(spark, sf_dir, "documents"))


@query
def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "pages")
    return pages.extracted(raw, pages.fit(raw))


@query
def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0")


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return worddedup.digest(table(spark, sf_dir, "documents"))


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtree.prefix_tree(table(spark, sf_dir, "conversations")).drop("nx", "ny")


@query
def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repaired(table(spark, sf_dir, "conversations"))


@query
def op13_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def crc32_sql(text: str) -> str:
    """The CRC-32 of an ASCII text, bit by bit, as DuckDB has no function for it."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [CAST(ord(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))"
    bit = "CASE WHEN b >= 0 THEN xor(a, b) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {steps}), lambda a, b: {bit}), 4294967295)"


ORACLES["op9_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""

ORACLES["op11_prefix_trie"] = f"""
WITH own AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), h AS (
  SELECT conv_id, turns, {crc32_sql("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM own
), rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns[:c.h], []), c.turns[c.h + 1:]) AS turns
  FROM h c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100
), members AS (
  SELECT conv_id, turns[:d] AS path, d, len(turns) AS n FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT path, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
  FROM members GROUP BY path
), counted AS (
  SELECT n.*, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.path[:n.depth] = n.path) AS n_children,
    CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(path[depth].text) END AS saved
  FROM nodes n
), above AS (
  SELECT path[:d] AS path, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM counted) GROUP BY 1
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, a.n_leaves,
  CAST(a.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM counted n JOIN above a USING (path) LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.path = n.path[:n.depth - 1]
"""


def _step(item: str, cost: int, edit: str, role: str = "", text: str = "''") -> str:
    """An item of the repair after an edit; `role` is the SQL of the role that comes out, if a turn does."""
    out = f" || chr(10) || {role} || ':' || {text}" if role else ""
    return f"CASE WHEN {item} IS NOT NULL THEN {{'c': {item}.c + {cost}, 'a': {item}.a || '{edit}', 't': {item}.t{out}}} END"


def _least(*items: str) -> str:
    return f"list_sort(list_filter([{', '.join(items)}], lambda z: z IS NOT NULL))[1]"


def _edited(item: str, edit: str, role: str, when: str) -> str:
    """A row kept or given another role, where its fault allows it."""
    cost = 0 if edit == "K" else 2
    plain, cut = (_step(item, cost + more, edit, role, "text") for more in (0, 1))
    return f"CASE WHEN {when} AND fault = 0 THEN {plain} WHEN {when} AND fault = 3 THEN {cut} END"


def _repair_sql() -> str:
    """Items n, s, u, x: none, a system, a user's, an assistant's turn came last; after each row turns may be inserted."""
    into_user = [_edited(q, "K", "role", "ini = 'u'") for q in "nsx"] + [_edited(q, "R", "'user'", "true") for q in "nsx"]
    into_last = [_edited("u", "K", "role", "ini = 'a'"), _edited("u", "R", "'assistant'", "true")]
    to_user = _least("u", *[_step(q, 2, "I", "'user'") for q in "nsx"])
    return f"""
WITH RECURSIVE fated AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32_sql("concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS fate
  FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy
  FROM fated WHERE fate <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text), copy) AS i FROM damaged
), faulty AS (
  SELECT *, substr(role, 1, 1) AS ini,
    CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 1
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
      WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 3 ELSE 0 END AS fault,
    concat(lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i), substr(role, 1, 1)) AS pair
  FROM placed
), convs AS (
  SELECT conv_id, count(i) AS m, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
    count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN faulty USING (conv_id) GROUP BY conv_id
), items AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, {{'c': 0, 'a': '', 't': ''}} AS n, CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, t VARCHAR)) AS s,
    {{'c': 2, 'a': 'I', 't': chr(10) || 'user:'}} AS u, {{'c': 4, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS x
  FROM convs
  UNION ALL
  SELECT conv_id, i, n, s, u, {_least("x", _step("u", 2, "I", "'assistant'"))} AS x FROM (
    SELECT conv_id, i, n, s, {to_user} AS u, x FROM (
      SELECT conv_id, i, {_step("n", 3, "D")} AS n, {_least(_step("s", 3, "D"), _edited("n", "K", "role", "ini = 's'"))} AS s,
        {_least(_step("u", 3, "D"), *into_user)} AS u, {_least(_step("x", 3, "D"), *into_last)} AS x
      FROM (SELECT f.conv_id, f.i, f.role, f.text, f.ini, f.fault, q.n, q.s, q.u, q.x FROM items q JOIN faulty f ON f.conv_id = q.conv_id AND f.i = q.i + 1)
    )
  )
)
SELECT c.conv_id, c.gaps, c.blank, c.duplicate, c.truncated, c.illegal, CAST(best.c AS BIGINT) AS cost, best.a AS audit,
  sha256(substr(best.t, 2)) AS repaired_sha256
FROM (SELECT conv_id, i, {_least("n", "x")} AS best FROM items) q JOIN convs c ON c.conv_id = q.conv_id AND c.m = q.i
"""


ORACLES["op12_structure_repair"] = _repair_sql()

ORACLES["op13_ngram_jaccard_join"] = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM worded
), grams AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))
), reached AS (
  SELECT doc_id AS node, doc_id AS other FROM sets
  UNION SELECT r.node, l.b FROM reached r JOIN links l ON l.a = r.other
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, r.component_id
FROM sets s JOIN (SELECT node, min(other) AS component_id FROM reached GROUP BY node) r ON r.node = s.doc_id
"""


def _islands(starts: str, size: int) -> str:
    """Runs of units that windows of one size cover, from their starts (doc_id, p): doc_id, a (first), b (last + 1)."""
    return f"""
  SELECT doc_id, min(p) AS a, max(p) + {size} AS b FROM (
    SELECT *, sum(CASE WHEN p <= before + {size} THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) AS run
    FROM (SELECT *, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM ({starts}))
  ) GROUP BY doc_id, run"""


def _plain_words(table_: str, key: str) -> str:
    return rf"""SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {table_}"""


ORACLES["op1_benchmark_decontamination"] = f"""
WITH docs AS ({_plain_words("documents", "doc_id")}), items AS ({_plain_words("benchmark", "item_id")}), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS gram
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)
), grams AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS gram
  FROM (SELECT d.doc_id, d.w, s.size, unnest(range(1, len(d.w) - s.size + 2)) AS i FROM docs d, (SELECT DISTINCT size FROM windows) s WHERE len(d.w) >= s.size)
), hits AS (
  SELECT DISTINCT doc_id, i, g.size, item_id FROM grams g JOIN windows USING (size, gram)
), words AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS word FROM hits) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN named USING (doc_id)
"""
ORACLES["op4_minhash_near_dedup"] = f"""
WITH RECURSIVE docs AS ({_plain_words("documents", "doc_id")}), sets AS (
  SELECT doc_id, w, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM docs
), grams AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 10 * count(*) >= 8 * (any_value(a.n) + any_value(b.n) - count(*))
), reached AS (
  SELECT doc_id AS node, doc_id AS other FROM sets UNION SELECT r.node, l.b FROM reached r JOIN links l ON l.a = r.other
)
SELECT s.doc_id, r.class_id, CASE WHEN len(s.w) = 0 THEN s.doc_id ELSE min(s.doc_id) OVER (PARTITION BY s.w) END AS text_id
FROM sets s JOIN (SELECT node, min(other) AS class_id FROM reached GROUP BY node) r ON r.node = s.doc_id
"""
ORACLES["op6_suffix_array_dedup"] = f"""
WITH docs AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), windows AS (
  SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS win FROM (SELECT *, unnest(range(len(h) // 2 - 49)) AS p FROM docs WHERE len(h) >= 100)
), later AS (
  SELECT doc_id, p FROM (SELECT *, min(doc_id) OVER (PARTITION BY win) AS least FROM windows) WHERE least < doc_id
), spans AS ({_islands("SELECT * FROM later", 50)}
), kept AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM spans
  UNION ALL SELECT d.doc_id, coalesce(max(s.b), 0), any_value(len(d.h) // 2) FROM docs d LEFT JOIN spans s USING (doc_id) GROUP BY d.doc_id
)
SELECT d.doc_id, CAST(any_value(len(d.h)) // 2 AS BIGINT) AS n_bytes, CAST(any_value(coalesce(n.removed, 0)) AS BIGINT) AS n_removed,
  any_value(coalesce(n.spans, 0)) AS n_spans, sha256(unhex(string_agg(substr(d.h, 2 * k.a + 1, 2 * (k.b - k.a)), '' ORDER BY k.a))) AS kept_sha256
FROM docs d JOIN kept k USING (doc_id) LEFT JOIN (SELECT doc_id, sum(b - a) AS removed, count(*) AS spans FROM spans GROUP BY doc_id) n USING (doc_id)
GROUP BY d.doc_id
"""
ORACLES["op10_substring_dedup"] = rf"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, p, array_to_string(w[p + 1:p + 35], ' ') AS win FROM (SELECT *, unnest(range(len(w) - 34)) AS p FROM docs WHERE len(w) >= 35)
), again AS (
  SELECT doc_id, p FROM (SELECT *, count(*) OVER (PARTITION BY win) AS many FROM windows) WHERE many > 1
), spans AS ({_islands("SELECT * FROM again", 35)}
), kept AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM spans
  UNION ALL SELECT d.doc_id, coalesce(max(s.b), 0), any_value(len(d.w)) FROM docs d LEFT JOIN spans s USING (doc_id) GROUP BY d.doc_id
)
SELECT d.doc_id, CAST(any_value(len(d.w)) AS BIGINT) AS n_words, CAST(any_value(coalesce(n.removed, 0)) AS BIGINT) AS n_removed,
  sha256(coalesce(string_agg(array_to_string(d.w[k.a + 1:k.b], ' '), ' ' ORDER BY k.a) FILTER (k.b > k.a), '')) AS kept_sha256
FROM docs d JOIN kept k USING (doc_id) LEFT JOIN (SELECT doc_id, sum(b - a) AS removed FROM spans GROUP BY doc_id) n USING (doc_id)
GROUP BY d.doc_id
"""
