"""Registered queries of the corpus operators, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat import prefix_tree, read_back
from .decontaminate import contamination
from .jaccard import component_ids
from .lines import WORDS_FOR_AN_EDIT, dedup_lines
from .mixing import mix
from .packing import pack
from .pii import pseudonymize
from .quality import CASED_STOP_WORDS, judge_quality
from .repair import repair_report
from .sharding import shard_plan
from .shared import table
from .spelling import spelling_variants
from .topk import K, top_k
from .url_rules import judge_urls


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text", "broken_rules")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymize(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "text", "n_values")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return component_ids(table(spark, sf_dir, "documents").select("doc_id", "text"))


#: A conversation that speaks the template's own control strings.
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], turns.schema)
    return read_back(*prefix_tree(turns.unionByName(more)))


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = shard_plan(table(spark, sf_dir, "documents").select("doc_id", "text"), 40)
    return plan.select(
        F.col("key").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with the faults that op12 has to mend, dealt by a checksum of conversation and turn."""
    space = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    rows = turns.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("again")).drop("again")


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair_report(turns, damaged(turns))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_url_rules": op2_url_rules,
    "op3_quality_rules": op3_quality_rules,
    "op4_pii": op4_pii,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_chat_format": op6_chat_format,
    "op7_line_dedup": op7_line_dedup,
    "op8_sharding": op8_sharding,
    "op9_top_k": op9_top_k,
    "op10_packing": op10_packing,
    "op11_spelling": op11_spelling,
    "op12_repair": op12_repair,
    "op13_decontamination": op13_decontamination,
}

# Words by the ASCII white space characters, as DuckDB spells them.
_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_HOST = r"translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = rf"""
WITH p AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
q AS (
  SELECT row_number() OVER () AS row_no, page_id, {_HOST} AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r(rule_host, rule_path, said) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits AS (
  SELECT row_no, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    max_by(said, length(rule_host || rule_path)) AS said
  FROM q JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY row_no),
m AS (
  SELECT q.*, rule, said, regexp_matches(host || path,
    '/wp-login\.php|/(cart|checkout|login|signin|search)([^A-Za-z0-9_.%-]|$)|/feed([^A-Za-z0-9_.%-]|$)$'
    || '|^([^/]*\.)?doubleclick\.[\s\S]*([^A-Za-z0-9_.%-]|$)|^([^/]*\.)?adserver\.') AS junk
  FROM q LEFT JOIN fits USING (row_no))
SELECT page_id, host, path, rule, coalesce(said, CASE WHEN junk THEN 'block' ELSE 'allow' END) AS verdict FROM m
"""

_STOP = ", ".join(f"'{w}'" for w in CASED_STOP_WORDS)
OP3 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS body, {_WORDS} AS w FROM documents),
u AS (SELECT row_no, unnest(w) AS a, unnest(range(len(w))) AS pos, len(w) AS n FROM d),
g AS (SELECT row_no, pos, n, a, lead(a) OVER s AS b, lead(a, 2) OVER s AS c FROM u WINDOW s AS (PARTITION BY row_no ORDER BY pos)),
h AS (SELECT row_no, pos, pos <= n - 3 AND count(*) OVER (PARTITION BY row_no, a, b, c, pos <= n - 3) > 1 AS twice FROM g),
k AS (SELECT row_no, twice OR coalesce(lag(twice) OVER s, false) OR coalesce(lag(twice, 2) OVER s, false) AS covered
  FROM h WINDOW s AS (PARTITION BY row_no ORDER BY pos)),
covers AS (SELECT row_no, count(*) FILTER (covered) AS n_repeat_words FROM k GROUP BY row_no),
l AS (SELECT *, list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
m AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(list_filter(w, lambda x: x IN ({_STOP}))) AS n_stop_words,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) AS n_bullet_lines,
    len(list_filter(lines, lambda x: ends_with(x, '...') OR ends_with(x, '…'))) AS n_ellipsis_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM l LEFT JOIN covers USING (row_no)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND word_chars BETWEEN 2 * n_words AND 14 * n_words AND 10 * n_symbols <= 3 * n_words
  AND n_stop_words >= 2 AND 2 * n_dup_lines <= n_lines AND 10 * n_bullet_lines <= 9 * n_lines
  AND 10 * n_ellipsis_lines <= 3 * n_lines AS kept FROM b
"""

OP5 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_transform({_WORDS}, lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS w
  FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM d),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r AS (SELECT a, b FROM c UNION SELECT r.a, c.b FROM r JOIN c ON r.b = c.a),
m AS (SELECT a AS doc_id, min(b) AS least FROM r GROUP BY a)
SELECT doc_id, len(g) AS n_shingles, least(doc_id, coalesce(m.least, doc_id)) AS component_id FROM s LEFT JOIN m USING (doc_id)
"""

OP6 = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONTROL_TEXT}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TEXT}')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|im_start|>' || '<|im_end|>') + 2 + length(role)
    + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

# Lines that differ in one word, by the same variants that the operator makes, as texts.
OP7 = rf"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d),
w AS (
  SELECT doc_id, pos, list_filter(string_split_regex(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM l),
n AS (SELECT doc_id, pos, w, array_to_string(w, ' ') AS norm FROM w WHERE len(w) > 0),
u AS (SELECT norm, any_value(w) AS w, min((doc_id, pos)) AS first FROM n GROUP BY norm),
v AS (
  SELECT norm, first, i, array_to_string(list_concat(w[1:i - 1], w[i + 1:]), ' ') AS variant
  FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM u WHERE len(w) >= {WORDS_FOR_AN_EDIT})),
near AS (
  SELECT norm FROM (SELECT norm, first, min(first) OVER (PARTITION BY i, variant) AS least FROM v) WHERE least < first
  UNION SELECT v.norm FROM v JOIN u ON v.variant = u.norm WHERE u.first < v.first AND len(u.w) >= {WORDS_FOR_AN_EDIT}
  UNION SELECT u.norm FROM v JOIN u ON v.variant = u.norm WHERE v.first < u.first AND len(u.w) >= {WORDS_FOR_AN_EDIT}),
gone AS (
  SELECT doc_id, list(pos) AS lost FROM n JOIN u USING (norm)
  WHERE (doc_id, pos) <> first OR norm IN (SELECT norm FROM near) GROUP BY doc_id),
kept AS (
  SELECT doc_id, text, lines, coalesce(lost, []) AS lost,
    list_filter(lines, lambda x, i: NOT list_contains(coalesce(lost, []), i - 1)) AS rest FROM d LEFT JOIN gone USING (doc_id))
SELECT doc_id, CASE WHEN len(lost) = 0 THEN text ELSE array_to_string(rest, chr(10)) END AS text,
  coalesce(len(lines), 0) AS n_lines, len(lost) AS n_removed,
  len(lost) > 0 AND len(list_filter(rest, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) = 0 AS emptied
FROM kept
"""

OP9 = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS row_no, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.row_no, q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.row_no <> q.row_no),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY row_no ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}
"""

OP13 = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS row_no, doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
b AS (
  SELECT item_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
v AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS x
  FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM v),
u AS (
  SELECT row_no, i, n, array_to_string(w[i:i + n - 1], ' ') AS x
  FROM (SELECT row_no, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d JOIN sizes ON len(w) >= n)),
hits AS (SELECT row_no, i, u.n, item_id FROM u JOIN v ON u.n = v.n AND u.x = v.x),
spots AS (SELECT row_no, count(DISTINCT k) AS n_hit FROM (SELECT row_no, unnest(range(i, i + n)) AS k FROM hits) GROUP BY row_no),
found AS (SELECT row_no, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT row_no, item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY row_no)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN spots USING (row_no) LEFT JOIN found USING (row_no)
"""

#: The mix solves a dual, pseudonyms are keyed by a hash, and packing needs the vocabulary: no SQL.
ORACLES: dict[str, str] = {
    "op2_url_rules": OP2,
    "op3_quality_rules": OP3,
    "op5_jaccard_join": OP5,
    "op6_chat_format": OP6,
    "op7_line_dedup": OP7,
    "op9_top_k": OP9,
    "op13_decontamination": OP13,
}
