"""Registered queries of the training-data operators: ``opN_<name>`` applies
operator N with production parameters to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import byte_bpe, centroid_clusters, conversation_trie, embedding_dedup, html_text, jaccard_join, language_id, line_crf, mixing, quality_rules, suffix_dedup, toxic_passages, warc
from .common import Scratch


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def bpe_files() -> tuple[str, str]:
    """Path of the rank file and the pattern that splits text before merging."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op1_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_crf.quality(spark, _documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(_documents(spark, sf_dir), *bpe_files())


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(spark, spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(spark, _documents(spark, sf_dir))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(spark, _documents(spark, sf_dir))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_groups(spark, _documents(spark, sf_dir))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(spark, _documents(spark, sf_dir))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    with Scratch(spark, "op10") as scratch:
        mixed = mixing.mix(scratch, _documents(spark, sf_dir))
        return scratch.keep(mixed, "result", result=True)


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(spark, spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_toxic_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic_passages.toxicity(spark, _documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters.clusters(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {f.__name__: f for f in (op1_line_crf, op2_warc, op3_byte_bpe, op4_embedding_dedup, op5_html_text, op6_suffix_dedup, op7_language_id, op8_jaccard_join, op9_quality_rules, op10_source_mix,
                                    op11_conversation_trie, op12_toxic_passages, op13_centroid_clusters)}

ORACLE: dict[str, str] = {}

ORACLE["op10_source_mix"] = r"""
WITH texts AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         translate(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '') AS body
  FROM documents),
base AS (
  SELECT doc_id, source, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
         / greatest(0.05, length(translate(body, '0123456789#*$%&|<>{}[]=_~^', '')) / greatest(length(body), 1)) AS key
  FROM texts),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM base GROUP BY source),
sources AS (
  SELECT source, source_size,
         CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3
              WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS weight,
         1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE AS total
  FROM sizes),
levels AS (
  SELECT *, 2.0::DOUBLE * source_size / weight AS ratio,
         (total - coalesce(sum(2.0::DOUBLE * source_size) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source ASC NULLS LAST
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source ASC NULLS LAST
                     ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS here
  FROM sources),
targets AS (
  SELECT source, source_size,
         least(2.0::DOUBLE * source_size,
               coalesce((max(here) FILTER (WHERE here <= ratio) OVER ()) * weight, 2.0::DOUBLE * source_size)) AS target
  FROM levels),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs,
         target - CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END * source_size AS budget
  FROM targets),
tied AS (
  SELECT source, key, doc_id, size, count(*) * size AS words FROM base WHERE size > 0
  GROUP BY source, key, doc_id, size),
placed AS (
  SELECT *, coalesce(sum(words) OVER (PARTITION BY source ORDER BY key, doc_id NULLS FIRST, size
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM tied),
picked AS (
  SELECT p.* FROM placed p JOIN budgets b ON p.source IS NOT DISTINCT FROM b.source
  WHERE (b.budget - p.before) * 2 >= p.words)
SELECT d.doc_id, d.size, b.source_size, b.target,
       (d.size * CASE WHEN d.size = 0 THEN 0 WHEN b.epochs >= 2 THEN b.epochs
                      WHEN p.words IS NOT NULL THEN b.epochs + 1 ELSE b.epochs END)::BIGINT AS taken
FROM base d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source
LEFT JOIN picked p ON p.source IS NOT DISTINCT FROM d.source AND p.key = d.key
     AND p.doc_id IS NOT DISTINCT FROM d.doc_id AND p.size = d.size
"""

ORACLE["op2_warc"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
d AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(8), lambda g: list_reduce(list_transform([15, 10, 5, 0], lambda s:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(x, (g * 5 + 1)::BIGINT, 5))::BIGINT) >> s) & 31) + 1, 1)),
    lambda a, b: a || b)), '') AS payload_digest,
  min(page_id) OVER (PARTITION BY h) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
 CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
 CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM d
"""

ORACLE["op4_embedding_dedup"] = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
   AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
   AND list_max(list_transform(embedding, lambda x: abs(x))) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
   AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id,
 vec_id = least(vec_id, coalesce(b, vec_id)) AS kept
FROM embeddings LEFT JOIN counts ON counts.a = vec_id LEFT JOIN low ON low.a = vec_id
"""

ORACLE["op8_jaccard_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
   'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
   ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
s AS (SELECT doc_id, unnest(s) AS x FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
  WHERE 100 * n >= 80 * (len(x.s) + len(y.s) - n)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id
FROM sets LEFT JOIN low ON low.a = doc_id
"""


def _quality_sql() -> str:
    """The rules' counts, votes and EM rounds (always all of them) in SQL."""
    q = quality_rules
    votes = "\n UNION ALL ".join(
        f"SELECT doc_id, '{name}' AS rule, CASE WHEN n_words = 0 THEN 0 WHEN ({ratio})::DOUBLE <= {good} THEN 1 "
        f"WHEN ({ratio})::DOUBLE > {bad} THEN -1 ELSE 0 END AS vote FROM c"
        for name, (ratio, good, bad) in q.RULES.items())
    score = ("ln(any_value(share) / (1 - any_value(share))) + sum(CASE vote WHEN 1 THEN ln(on_good / (1 - on_bad)) "
             "WHEN -1 THEN ln((1 - on_good) / on_bad) ELSE 0 END)")
    clamp = f"least(greatest({{}}, {q.ACCURACY_RANGE[0]}), {q.ACCURACY_RANGE[1]})"
    right = [clamp.format("sum(n * {p}) FILTER (vote = {v}) / sum(n * {p}) FILTER (vote <> 0)".format(p=p, v=v))
             for p, v in (("p", 1), ("(1 - p)", -1))]
    some = ["sum(n * {p}) FILTER (vote <> 0) > 1e-9".format(p=p) for p in ("p", "(1 - p)")]
    return rf"""
WITH RECURSIVE t AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
   list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1),
   lambda i: array_to_string(w[i:i + 2], ' '))) AS x FROM t WHERE len(w) > 2),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, x) > 1),
hit AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, (VALUES (0), (1), (2)) o(k) GROUP BY doc_id),
c AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
   (length(t) - length(translate(t, '{q.SYMBOLS}', '')))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
   coalesce(n, 0)::BIGINT AS n_repeat_words, len(l) AS n_lines, len(list_distinct(w)) AS n_kinds,
   length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) AS n_upper, length(t) - length(translate(t, '0123456789', '')) AS n_digits
  FROM t LEFT JOIN hit USING (doc_id)),
votes AS ({votes}),
rules AS (SELECT DISTINCT rule FROM votes),
of_doc AS (SELECT doc_id, string_agg(vote::VARCHAR, ',' ORDER BY rule) AS pattern FROM votes GROUP BY doc_id),
patterns AS (SELECT pattern, rule, vote, count(*) AS n FROM of_doc JOIN votes USING (doc_id) GROUP BY ALL),
em(step, rule, on_good, on_bad, share) AS (
  SELECT 0, rule, {q.START_ACCURACY[0]}::DOUBLE, {q.START_ACCURACY[1]}::DOUBLE, {q.START_GOOD}::DOUBLE FROM rules
  UNION ALL
  SELECT step, rule, on_good, on_bad, least(greatest(sum(good) OVER () / sum(docs) OVER (), {q.GOOD_RANGE[0]}), {q.GOOD_RANGE[1]})
  FROM (SELECT any_value(step) + 1 AS step, rule, sum(n * p) AS good, sum(n) AS docs,
         CASE WHEN {some[0]} THEN {right[0]} ELSE {q.START_ACCURACY[0]} END AS on_good,
         CASE WHEN {some[1]} THEN {right[1]} ELSE {q.START_ACCURACY[1]} END AS on_bad
        FROM (SELECT pattern, any_value(step) AS step, 1 / (1 + exp(-({score}))) AS p
              FROM patterns JOIN em USING (rule) GROUP BY pattern) e JOIN patterns USING (pattern) GROUP BY rule)
  WHERE step <= {q.ROUNDS}),
last AS (SELECT * FROM em WHERE step = {q.ROUNDS}),
good AS (SELECT pattern, 1 / (1 + exp(-({score}))) AS p FROM (SELECT DISTINCT pattern, rule, vote FROM patterns) JOIN last USING (rule)
         GROUP BY pattern)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
 (n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
 NOT (n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words) AND p >= {q.KEEP_FROM} AS kept
FROM c JOIN of_doc USING (doc_id) JOIN good USING (pattern)
"""


ORACLE["op9_quality_rules"] = _quality_sql()


ORACLE["op11_conversation_trie"] = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
   md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
crc_table AS (
  SELECT list(v ORDER BY i) AS tb FROM (SELECT i, list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
   lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) r(i))),
c AS (
  SELECT conv_id AS c, conv_id - conv_id % 100 AS base, xor(list_reduce(
   list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
   lambda a, b: xor(a >> 8, tb[(xor(a, b) & 255) + 1])), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t), crc_table),
turns AS (
  SELECT c, 0 AS part, p, r, x FROM c JOIN t ON conv_id = base AND p <= h
  UNION ALL SELECT c, 1, p, r, x FROM c JOIN t ON conv_id = c AND p > h),
seqs AS (
  SELECT c.c, coalesce(list({'r': r, 'x': x} ORDER BY part, p) FILTER (p IS NOT NULL), []) AS l
  FROM c LEFT JOIN turns USING (c) GROUP BY c.c),
prefixes AS (SELECT c, d, len(l) AS n, l[1:d] AS pre FROM seqs, unnest(range(0, len(l) + 1)) u(d)),
member AS (SELECT c, d, n, pre, min(c) OVER (PARTITION BY d, pre) AS node FROM prefixes),
nodes AS (
  SELECT node, d, count(*) AS n_convs, CASE WHEN d = 0 THEN 0 ELSE length(any_value(pre)[-1].x) END AS chars,
   sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d), '')) AS ends_sha256
  FROM member GROUP BY node, d),
up AS (SELECT a.*, p.node AS parent FROM nodes a LEFT JOIN member p ON p.c = a.node AND p.d = a.d - 1),
kids AS (SELECT parent AS node, d - 1 AS d, count(*) AS k FROM up WHERE d > 0 GROUP BY ALL),
counted AS (SELECT nodes.*, coalesce(k, 0) AS k FROM nodes LEFT JOIN kids USING (node, d)),
below AS (
  SELECT m.node, m.d, sum((v.n_convs - 1) * v.chars) AS saved, count(*) FILTER (v.k = 0) AS leaves
  FROM counted v JOIN member m ON m.c = v.node AND m.d <= v.d GROUP BY m.node, m.d)
SELECT up.node AS conv_id, up.d AS depth, parent AS parent_conv_id, up.n_convs, counted.k AS n_children,
 leaves AS n_leaves, saved::BIGINT AS saved_tokens, up.ends_sha256
FROM up JOIN counted USING (node, d) JOIN below USING (node, d)
"""


def _clusters_sql() -> str:
    """The rounds one after the other; all values are whole numbers below 2^53."""
    m = centroid_clusters
    parts = [rf"""
v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding::DOUBLE[], lambda x: floor({m.SCALE} * x)) AS q
 FROM embeddings WHERE len(embedding) = {m.WIDTH}
  AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY s NULLS LAST, q) - 1 AS c, q FROM (
 SELECT sha256('{m.SALT}' || vec_id::VARCHAR) AS s, q FROM v) ORDER BY c LIMIT {m.K})"""]
    for i in range(m.ROUNDS + 1):
        parts.append(f"""
a{i} AS MATERIALIZED (SELECT rid, min((list_inner_product(v.q, v.q) - 2 * list_inner_product(v.q, c.q)
  + list_inner_product(c.q, c.q))::BIGINT * {m.K} + c.c) AS best FROM v, c{i} c GROUP BY rid)""")
        if i < m.ROUNDS:
            parts.append(f"""
s{i} AS (SELECT best % {m.K} AS c, k, floor(sum(q[k]) / count(*)) AS x FROM a{i} JOIN v USING (rid), range(1, {m.WIDTH + 1}) r(k)
 GROUP BY ALL),
c{i + 1} AS MATERIALIZED (SELECT c.c, coalesce(n.q, c.q) AS q FROM c{i} c LEFT JOIN (
 SELECT c, list(x ORDER BY k) AS q FROM s{i} GROUP BY c) n ON n.c = c.c)""")
    return "WITH " + ",".join(parts) + rf""",
f AS (SELECT vec_id, best % {m.K} AS cluster, best // {m.K} AS distance FROM a{m.ROUNDS} JOIN v USING (rid))
SELECT vec_id, cluster::INTEGER AS cluster, distance::BIGINT AS distance,
 (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
 sha256(array_to_string(list_transform(q, lambda x: x::BIGINT::VARCHAR), ',')) AS centroid_sha256
FROM f JOIN c{m.ROUNDS} ON c = cluster
"""


ORACLE["op13_centroid_clusters"] = _clusters_sql()
