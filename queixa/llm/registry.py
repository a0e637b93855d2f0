"""The queries of this subpackage over the test tables, and the SQL some of them are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queixa.llm import alignment, bilinear, decontaminate, forest, licences, lines, minhash, mixture, quality, recompress, shards, tries, warc

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_merged_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archive_and_index(read(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op2_minmax_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op3_hash_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return forest.nearest(vectors, vectors.where("vec_id % 50 = 0"), k=5)


@query
def op4_suffix_array_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    found = decontaminate.find_leaks(docs.select("doc_id", "text"), items, window=10)
    return found.select(
        "doc_id", "n_words", decontaminate.hit_words().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        decontaminate.digest().alias("items_sha256"), (F.size("hit_spans") > 0).alias("contaminated"))


@query
def op5_line_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.repeated_lines(read(spark, sf_dir, "documents"), lines=3)
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


@query
def op5_repeated_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.repeated_lines(read(spark, sf_dir, "documents"), words=1)
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


@query
def op6_recompression_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = recompress.repeated_spans(read(spark, sf_dir, "documents"), window=50)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op7_subset_sum_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixture.mixture(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


@query
def op8_suffix_automaton_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan_licences(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                        F.concat_ws(",", "base_labels").alias("base_labels"), F.concat_ws(",", "labels").alias("labels"), "score")


@query
def op9_hierarchical_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    found = quality.judge(docs, read(spark, sf_dir, "labels"), columns=["doc_id"])
    return found.select("doc_id", F.round("evidence", 6).alias("evidence"), F.round("host_rate", 6).alias("host_rate"),
                        F.round("path_rate", 6).alias("path_rate"), F.round("posterior", 6).alias("posterior"),
                        (~F.col("rejected")).alias("kept"))


@query
def op10_label_propagation_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shards.shard_rows(read(spark, sf_dir, "documents"), shards=16)
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


# Vocabulary files of public tokenizers, read where the query is planned.
TOKENIZERS = "/opt/tokenizers"


@query
def op11_identity_map_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.align(read(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query
def op12_double_array_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tries.prefix_trie(read(spark, sf_dir, "conversations")).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


@query
def op13_log_bilinear_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bilinear.score_texts(read(spark, sf_dir, "documents")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACED = r"'[^\x20\x09-\x0D]+'"
LETTERS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def words_of(text: str, pattern: str, fold: bool) -> str:
    return f"regexp_extract_all({LOWER.format(text) if fold else text}, {pattern})"


SQL["op2_minmax_near_duplicates"] = f"""
WITH RECURSIVE words AS (SELECT doc_id, {words_of("coalesce(text, '')", SPACED, True)} AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM words),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))),
reach AS (
  SELECT doc_id, doc_id AS other FROM sets
  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other)
SELECT sets.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least_id AS component_id, sets.doc_id = least_id AS kept
FROM sets JOIN (SELECT doc_id, min(other) AS least_id FROM reach GROUP BY doc_id) USING (doc_id)"""

SQL["op4_suffix_array_leaks"] = f"""
WITH d AS (SELECT doc_id, {words_of("coalesce(text, '')", LETTERS, True)} AS w FROM documents),
i AS (SELECT item_id, {words_of("coalesce(text, '')", LETTERS, True)} AS w FROM benchmark),
lengths AS (SELECT DISTINCT least(len(w), 10) AS n FROM i WHERE len(w) > 0),
item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS x
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p
        FROM i WHERE len(w) > 0)),
doc_windows AS (
  SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS x
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, lengths WHERE len(w) >= n)),
hits AS (SELECT doc_id, item_id, p, n FROM doc_windows JOIN item_windows USING (n, x)),
hit_words AS (SELECT doc_id, count(DISTINCT p + k) AS n_hit FROM hits, range(0, 10) AS r(k) WHERE k < n GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)"""

SQL["op6_recompression_repeats"] = f"""
WITH d AS (SELECT doc_id, {words_of("coalesce(text, '')", SPACED, False)} AS w FROM documents),
places AS (
  SELECT doc_id, p, array_to_string(w[p:p + 49], ' ') AS x
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM d WHERE len(w) >= 50)),
firsts AS (SELECT x, min(doc_id) AS origin FROM places GROUP BY x HAVING count(DISTINCT doc_id) > 1),
gone AS (
  SELECT DISTINCT doc_id, p + k AS i FROM places JOIN firsts USING (x), range(0, 50) AS r(k) WHERE origin < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

SQL["op1_merged_warc_index"] = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
firsts AS (SELECT digest, min(page_id) AS first_page FROM p WHERE n >= 100 GROUP BY digest)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN first_page < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_page < page_id THEN first_page END AS refers_to
FROM p LEFT JOIN firsts USING (digest)"""

SQL["op5_line_suffix_array"] = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
raw AS (SELECT doc_id, unnest(l) AS line, unnest(range(0, len(l))) AS i FROM d),
counted AS (
  SELECT doc_id, line, i, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS p
  FROM raw WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
runs AS (
  SELECT a.doc_id, a.p, a.line AS x, b.line AS y, c.line AS z
  FROM counted a JOIN counted b ON a.doc_id = b.doc_id AND b.p = a.p + 1 JOIN counted c ON a.doc_id = c.doc_id AND c.p = a.p + 2),
ordered AS (SELECT doc_id, p, row_number() OVER (PARTITION BY x, y, z ORDER BY doc_id, p) AS n FROM runs),
gone AS (SELECT DISTINCT doc_id, p + k AS p FROM ordered, range(0, 3) AS r(k) WHERE n > 1),
gone_lines AS (SELECT doc_id, i FROM counted JOIN gone USING (doc_id, p)),
kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS text FROM raw ANTI JOIN gone_lines USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, (SELECT count(*) FROM counted c WHERE c.doc_id = d.doc_id) AS n_lines,
  (SELECT count(*) FROM gone_lines g WHERE g.doc_id = d.doc_id) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

SQL["op5_repeated_line_runs"] = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
raw AS (SELECT doc_id, unnest(l) AS line, unnest(range(0, len(l))) AS i FROM d),
counted AS (SELECT doc_id, line, i FROM raw WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
ordered AS (SELECT doc_id, i, row_number() OVER (PARTITION BY line ORDER BY doc_id, i) AS n FROM counted),
gone_lines AS (SELECT doc_id, i FROM ordered WHERE n > 1),
kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS text FROM raw ANTI JOIN gone_lines USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, (SELECT count(*) FROM counted c WHERE c.doc_id = d.doc_id) AS n_lines,
  (SELECT count(*) FROM gone_lines g WHERE g.doc_id = d.doc_id) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

# DuckDB has no crc32: the table is the polynomial's eight steps per byte.
SQL["op12_double_array_trie"] = r"""
WITH steps AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) AS r(i)),
own AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS said
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
taken AS (
  SELECT conv_id, said, xor(list_reduce(
    list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: CAST(ord(ch) AS BIGINT))),
    lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)])), 4294967295) % 4 AS h
  FROM own, steps),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(f.said[1:c.h], []), c.said[c.h + 1:]) AS path
  FROM taken c LEFT JOIN own f ON f.conv_id = c.conv_id - c.conv_id % 20),
prefixes AS (
  SELECT conv_id, len(path) AS n, unnest(range(0, len(path) + 1)) AS d, path FROM rebuilt),
nodes AS (
  SELECT path[1:d] AS node, d, min(conv_id) AS conv_id, count(*) AS n_convs,
    string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d) AS ends,
    CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * len(regexp_extract_all(any_value(path[d].t), '[^\x20\x09-\x0D]+')) END AS saved
  FROM prefixes GROUP BY path[1:d], d),
children AS (SELECT node[1:d - 1] AS node, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY node[1:d - 1], d - 1),
own_sums AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (node, d)),
subtree AS (
  SELECT node[1:k] AS node, k AS d, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM (SELECT node, saved, n_children, unnest(range(0, d + 1)) AS k FROM own_sums) GROUP BY node[1:k], k)
SELECT o.conv_id, CAST(o.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children, s.n_leaves,
  CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(o.ends, '')) AS ends_sha256
FROM own_sums o JOIN subtree s ON s.node = o.node AND s.d = o.d LEFT JOIN nodes p ON p.d = o.d - 1 AND p.node = o.node[1:o.d - 1]"""
