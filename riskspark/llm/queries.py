"""Queries over whole tables, one for each operator, and their SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm import bpe, cotrain, kmeans_tree, lines, mining, nbsvm, packing, periods, setjoin, simhash, tokens, toolcalls, va_file
from riskspark.llm.common import table


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_va_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va_file.search(table(spark, sf_dir, "embeddings"))


def op4_bpe_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digest(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op1_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmeans_tree.search(table(spark, sf_dir, "embeddings"))


def op2_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotrain.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = toolcalls.whole_conversations(table(spark, sf_dir, "conversations"))
    return linked.withColumn("errors", F.array_join("errors", "; "))


def op6_simhash_bk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.query(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"), limit=4096)


def op8_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.query(table(spark, sf_dir, "documents"))


def op10_nbsvm_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbsvm.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_fagin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mining.query(table(spark, sf_dir, "embeddings"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.query(table(spark, sf_dir, "documents"))


def op13_vertical_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setjoin.components(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_kmeans_tree, op2_cotraining, op3_va_file, op4_bpe_index, op5_tool_calls, op6_simhash_bk, op7_token_counts,
    op8_best_fit, op9_line_dedup, op10_nbsvm_toxicity, op11_fagin, op12_periodic_runs, op13_vertical_join)}

_LINES = """
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
k AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
hot AS (
  SELECT key, max(doc_id) AS last_doc FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, coalesce(doc_id <> last_doc, false) AS lost FROM k LEFT JOIN hot USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(lost AS INT)) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

_CALLS = """
WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
u AS (
  SELECT *, conv_id || ':' || turn AS call_id, len(string_split(text, chr(10))) AS lines,
         CAST(len(list_filter(string_split(replace(text, chr(10), ' '), ' '), lambda w: w <> '')) AS BIGINT) AS words
  FROM t WHERE role = 'user'),
n AS (SELECT *, lines > 1 AND turn + 2 IN (SELECT turn FROM u x WHERE x.conv_id = u.conv_id) AS waits FROM u),
p AS (
  SELECT *, MIN(turn) FILTER (WHERE NOT waits) OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS place FROM n),
a AS (SELECT *, conv_id || ':' || (turn - 1) AS call_id FROM t WHERE role = 'assistant'),
j AS (
  SELECT coalesce(u.conv_id, a.conv_id) AS conv_id, coalesce(u.call_id, a.call_id) AS call_id, u.turn AS turn, a.turn AS result_turn,
         u.text AS prompt, a.text AS content, u.lines, u.words, u.lines > 1 AS block, u.place
  FROM p u FULL JOIN a ON u.conv_id = a.conv_id AND u.call_id = a.call_id),
e AS (
  SELECT *, CASE WHEN turn IS NULL THEN '' ELSE concat_ws('; ',
      CASE WHEN block AND lines > 6 THEN 'lines: out of range' END,
      CASE WHEN length(prompt) NOT BETWEEN 1 AND 400 THEN 'prompt: out of range' END,
      CASE WHEN words < 1 OR (NOT block AND words > 60) THEN 'words: out of range' END) END AS errors
  FROM j)
SELECT conv_id, call_id, CAST(turn AS BIGINT) AS turn, CAST(result_turn AS BIGINT) AS result_turn, CAST(place AS BIGINT) AS order_turn,
       CAST((place - turn) // 2 AS BIGINT) AS order_step,
       CASE WHEN turn IS NULL THEN 'no call' WHEN result_turn IS NULL THEN 'no result' ELSE 'linked' END AS status, errors,
       '{' || CASE WHEN turn IS NULL THEN '' ELSE '"arguments":{' || CASE WHEN block THEN '"lines":' || lines || ',' ELSE '' END
         || '"prompt":' || to_json(prompt) || ',"words":' || words || '},' END || '"call_id":' || to_json(call_id)
         || CASE WHEN turn IS NULL THEN '' WHEN block THEN ',"name":"reply_block"' ELSE ',"name":"reply"' END
         || CASE WHEN result_turn IS NULL THEN '' ELSE ',"result":' || to_json(content) END
         || ',"valid":' || CASE WHEN errors = '' THEN 'true' ELSE 'false' END || '}' AS json
FROM e
"""

_WHOLE = f"""
SELECT * FROM ({_CALLS}) UNION ALL
SELECT conv_id, CAST(NULL AS VARCHAR) AS call_id, CAST(turn AS BIGINT) AS turn, CAST(NULL AS BIGINT) AS result_turn, CAST(turn AS BIGINT) AS order_turn,
       CASE WHEN turn IS NOT NULL THEN CAST(0 AS BIGINT) END AS order_step, 'context' AS status, '' AS errors,
       '{{"content":' || to_json(coalesce(text, '')) || CASE WHEN role IS NULL THEN '' ELSE ',"role":' || to_json(role) END || '}}' AS json
FROM conversations WHERE role IS NULL OR role NOT IN ('user', 'assistant')
"""

_TOP = """
WITH w AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT vec_id AS query_id, v AS x FROM w WHERE vec_id % 20 = 0),
s AS (SELECT query_id, vec_id, CAST(list_dot_product(CAST(x AS DOUBLE[]), CAST(v AS DOUBLE[])) AS BIGINT) AS score FROM q JOIN w ON vec_id <> query_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INT) AS rank, vec_id, score FROM r WHERE n <= 20
"""

_HARD = """
WITH w AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, o.vec_id AS id, a.label = o.label AS same, CAST(list_dot_product(a.v, o.v) AS BIGINT) AS score
  FROM w a JOIN w o ON a.vec_id <> o.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (
  SELECT anchor_id, positive_id, positive_score, s.id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id) AS rank
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""

ORACLES: dict[str, str] = {"op3_va_file": _TOP, "op5_tool_calls": _WHOLE, "op9_line_dedup": _LINES,
                          "op11_fagin": _HARD}
