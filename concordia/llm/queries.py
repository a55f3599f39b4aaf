"""The registered queries of the operators, and DuckDB SQL where it can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordia.llm import byte_bpe, hard_negatives, learned_partitions, licenses, line_crf, near_dedup, packing, parity_join, prefix_trie, repetition, snapshots, token_store, url_cascade
from concordia.llm._cluster import ship

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_cascade(spark, sf_dir):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return url_cascade.url_filter(table(spark, sf_dir, "pages"), rules)


def op2_suffix_repetition(spark, sf_dir):
    return repetition.repetition_rules(table(spark, sf_dir, "documents"))


def op3_learned_partitions(spark, sf_dir):
    return learned_partitions.search(table(spark, sf_dir, "embeddings"))


def op4_snapshot_collapse(spark, sf_dir):
    return snapshots.render_maximal(table(spark, sf_dir, "conversations"))


def op5_best_fit_packing(spark, sf_dir):
    return packing.best_fit_packing(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_license_scan(spark, sf_dir):
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_join("sentence_ids", " ").alias("sentence_ids"), F.array_join("licenses", " ").alias("licenses"), "license")


def op7_byte_bpe(spark, sf_dir):
    return byte_bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=False)


def op8_minhash_odd_sketch(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), k=3, similarity=0.85)


def op9_line_crf_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return line_crf.score_documents(docs, line_crf.train(docs, table(spark, sf_dir, "labels")))


def op10_token_store(spark, sf_dir):
    store = token_store.write_store(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, end_id=2, vocabulary=50_257)
    return token_store.read_store(*store).withColumnRenamed("id", "doc_id")


def op11_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", label))


def op12_prefix_trie(spark, sf_dir):
    borrow = F.crc32(F.col("conv").cast("string").cast("binary")) % 9
    return prefix_trie.trie(table(spark, sf_dir, "conversations"), borrow, F.col("conv") - F.col("conv") % 5)


def op13_parity_join(spark, sf_dir):
    return parity_join.join_components(table(spark, sf_dir, "documents"), k=3, percent=90)


QUERIES = {f.__name__: f for f in (op1_url_cascade, op2_suffix_repetition, op3_learned_partitions, op4_snapshot_collapse, op5_best_fit_packing, op6_license_scan, op7_byte_bpe, op8_minhash_odd_sketch, op9_line_crf_quality, op10_token_store, op11_hard_negatives, op12_prefix_trie, op13_parity_join)}

_VALUES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
_KNOWN = ", ".join(f"('{v}', '{k}')" for k, v in licenses.SENTENCES.items())
_FIRED = ", ".join(f"CASE WHEN regexp_matches(line, '{licenses.rule_pattern(ids)}') THEN '{name}' END" for name, ids, *_ in licenses.RULES if set(ids) <= licenses.SENTENCES.keys())



def _components_sql(percent: int, kept: str) -> str:
    """Links between sets of three-word shingles by the words that they share, and all that links reach."""
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) END AS s FROM d),
sets AS (SELECT doc_id, unnest(s) AS x FROM g), n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM g),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sets a JOIN sets b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= {percent} * (na.n + nb.n - k)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.doc_id, ways.b FROM reach r JOIN ways ON ways.a = r.other)
SELECT doc_id, n AS n_shingles, component_id{kept} FROM n JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1) USING (doc_id)"""


SQL = {
    "op8_minhash_odd_sketch": _components_sql(85, ", doc_id = component_id AS kept"),
    "op13_parity_join": _components_sql(90, ""),
    "op1_url_cascade": f"""
WITH rules(rhost, rpath, verdict) AS (VALUES {_VALUES}),
cut AS (SELECT page_id, coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path, row_number() OVER () AS rn FROM pages),
hit AS (SELECT rn, rhost || rpath AS rule, verdict, row_number() OVER (PARTITION BY rn ORDER BY length(rhost || rpath) DESC) AS k
  FROM cut JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM cut LEFT JOIN (SELECT * FROM hit WHERE k = 1) USING (rn)""",
    "op4_snapshot_collapse": """
WITH t AS (SELECT conv_id, turn, role, text, row_number() OVER w AS n,
  string_agg(coalesce('r' || length(role) || ':' || role, 'n') || coalesce('t' || length(text) || ':' || text, 'n'), '') OVER (w ROWS UNBOUNDED PRECEDING) AS prefix,
  string_agg('<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || chr(10), '') OVER (w ROWS UNBOUNDED PRECEDING) AS rendered,
  lead(1) OVER w IS NULL AS is_last
  FROM conversations WHERE conv_id IS NOT NULL WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)),
whole AS (SELECT prefix, n, min(conv_id) AS conv_id, min(rendered) AS rendered FROM t WHERE is_last GROUP BY prefix, n)
SELECT conv_id, n AS n_turns, rendered FROM whole WHERE NOT EXISTS (SELECT 1 FROM t WHERE NOT t.is_last AND t.n = whole.n AND t.prefix = whole.prefix)""",
    "op6_license_scan": f"""
WITH known(sentence, id) AS (VALUES {_KNOWN}),
cut AS (SELECT doc_id, row_number() OVER () AS rn, regexp_split_to_array(coalesce(text, ''), '[.!?;]+(?:\\s+|$)|\\n+') AS parts FROM documents),
one AS (SELECT rn, unnest(parts) AS part, generate_subscripts(parts, 1) AS place FROM cut),
hit AS (SELECT rn, place, id FROM one JOIN known ON trim(regexp_replace(lower(part), '[^a-z0-9]+', ' ', 'g')) = sentence),
ids AS (SELECT rn, string_agg(id, ' ' ORDER BY place) AS ids FROM hit GROUP BY rn),
seq AS (SELECT doc_id, coalesce(ids, '') AS sentence_ids, ' ' || coalesce(ids, '') || ' ' AS line FROM cut LEFT JOIN ids USING (rn)),
fired AS (SELECT doc_id, sentence_ids, [x FOR x IN [{_FIRED}] IF x IS NOT NULL] AS f FROM seq)
SELECT doc_id, sentence_ids, coalesce(array_to_string([f[i] FOR i IN range(1, len(f) + 1) IF list_position(f, f[i]) = i], ' '), '') AS licenses, f[1] AS license FROM fired""",
    "op11_hard_negatives": """
WITH r AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
  coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])), 0)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
QUALIFY rank <= 10""",
    "op12_prefix_trie": """
WITH crc AS (SELECT DISTINCT conv_id AS c, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x))),
  lambda h, x: list_reduce(list_prepend(xor(h, x), range(8)), lambda y, i: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END))) % 9 AS h FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
counts AS (SELECT c, count(*) AS k FROM t GROUP BY c),
plan AS (SELECT crc.c, h, crc.c - crc.c % 5 AS base, least(h, coalesce(k, 0)) AS has FROM crc LEFT JOIN counts ON counts.c = crc.c - crc.c % 5),
r AS (SELECT plan.c, n AS d, role, text FROM plan JOIN t ON t.c = base AND n <= h UNION ALL SELECT plan.c, n - h + has, role, text FROM plan JOIN t ON t.c = plan.c AND n > h),
p AS (SELECT c, d, strlen(text) AS size, string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING) AS path FROM r
  UNION ALL SELECT c, 0, 0, '' FROM crc),
m AS (SELECT *, lag(path) OVER w AS up, lead(d) OVER w IS NULL AS is_last FROM p WINDOW w AS (PARTITION BY c ORDER BY d)),
node AS (SELECT path, d, min(up) AS up, min(c) AS conv_id, count(*) AS n, min(size) AS size,
  sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE is_last), '')) AS ends FROM m GROUP BY path, d),
kids AS (SELECT up AS path, count(*) AS k FROM node WHERE up IS NOT NULL GROUP BY up),
under AS (SELECT DISTINCT x.path, y.path AS low FROM m x JOIN m y ON x.c = y.c AND y.d >= x.d),
total AS (SELECT under.path, count(*) FILTER (WHERE k IS NULL) AS leaves, sum((n - 1) * size) AS saved FROM under JOIN node ON node.path = low LEFT JOIN kids ON kids.path = low GROUP BY under.path)
SELECT node.conv_id, node.d::BIGINT AS depth, parent.conv_id AS parent_conv_id, node.n AS n_convs, coalesce(k, 0) AS n_children, leaves AS n_leaves, saved::BIGINT AS saved_tokens, node.ends AS ends_sha256
FROM node LEFT JOIN node parent ON parent.path = node.up LEFT JOIN kids ON kids.path = node.path JOIN total ON total.path = node.path""",
}
