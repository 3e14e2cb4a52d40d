"""The operators over their whole tables with production parameters, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeweir.llm import (
    cycles,
    decontaminate,
    fixity,
    near,
    packing,
    quality,
    scoring,
    suffixes,
    toxicity,
    turns,
    urls,
    vectors,
    wavelet,
)
from tradeweir.llm.common import read

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = scoring.score(read(spark, sf_dir, "documents"))
    return scores.select("doc_id", "n_words", F.round("mean_log_score", 6).alias("mean_log_score"))


def op2_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages' records against a replica damaged by a rule: a byte's case flipped, a record lost or added."""
    records = fixity.warc_records(read(spark, sf_dir, "pages")).select("file", "offset", "page_id", "digest")
    damage = F.pmod(F.col("page_id") * 31 + 7, F.lit(97))
    digest = F.when(damage == 3, F.sha2(F.concat(F.lit("damaged"), "digest"), 256)).otherwise(F.col("digest"))
    replica = records.where(F.coalesce(damage != 5, F.lit(True))).withColumn("digest", digest)
    added = records.where(damage == 11).withColumn("offset", F.col("offset") + 1)
    return fixity.audit(records, replica.union(added.select(*replica.columns)))


def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept")


def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_suffix_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(read(spark, sf_dir, "documents")).drop("kept_text")


def op6_fourier_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("y"))
    return quality.classify(read(spark, sf_dir, "documents"), labels)


def op7_grouping_ga(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), TOKENIZER)


def op8_host_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read(spark, sf_dir, "pages"), read(spark, sf_dir, "documents").select("text"))


def op9_tiled_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(read(spark, sf_dir, "embeddings"))


def op10_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The categories that the labels have: junk (quality 0) comes first and informs toxic."""
    labels = read(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("junk"), "toxic")
    return toxicity.predict(read(spark, sf_dir, "documents"), labels, ["junk", "toxic"])


def op11_wavelet_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.encode_documents(read(spark, sf_dir, "documents"), TOKENIZER)


def op12_survivor_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations after damage by a rule."""
    conversations = read(spark, sf_dir, "conversations")
    return turns.audit_all(conversations, turns.damaged(conversations))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents, chosen by a hash of their ids, is made periodic from some word on."""
    docs = read(spark, sf_dir, "documents")
    return cycles.digest(cycles.repeated_runs(docs, plant=cycles.crc_of(F.col("doc_id"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_stupid_backoff,
        op2_merkle_fixity,
        op3_order_minhash,
        op4_winnowing,
        op5_suffix_merge,
        op6_fourier_quality,
        op7_grouping_ga,
        op8_host_words,
        op9_tiled_vectors,
        op10_toxicity_chain,
        op11_wavelet_matrix,
        op12_survivor_viterbi,
        op13_periodic_runs,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"



def _crc32(text: str) -> str:
    """SQL for the unsigned CRC-32 of a short ASCII text, bit by bit."""
    bit = "xor(x >> 1, CASE x & 1 WHEN 1 THEN 3988292384 ELSE 0 END)"
    byte = f"list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: {bit})"
    codes = f"list_transform(range(1, len({text}) + 1), lambda k: CAST(ascii(({text})[k]) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda c, b: {byte}), 4294967295)"


# States of a repaired conversation: 0 nothing yet, 1 after s, 2 after u, 3 after a. What follows a state by an insert is fixed.
_NEXT = "CASE {0} WHEN 2 THEN 3 ELSE 2 END"

ORACLE: dict[str, str] = {
    "op1_stupid_backoff": rf"""
WITH doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
word AS (SELECT doc_id, i, w[i] AS b, CASE WHEN i > 1 THEN w[i - 1] END AS a
         FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM doc)),
one AS (SELECT b AS x, count(*) AS n FROM word GROUP BY 1),
two AS (SELECT a, b, count(*) AS n FROM word WHERE a IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 2),
total AS (SELECT count(*) AS n FROM word),
score AS (
  SELECT doc_id, ln(CASE WHEN two.n IS NOT NULL THEN two.n / before.n
                         WHEN word.a IS NULL THEN own.n / total.n ELSE 0.4 * own.n / total.n END) AS s
  FROM word JOIN one own ON own.x = word.b LEFT JOIN one before ON before.x = word.a
  LEFT JOIN two ON two.a = word.a AND two.b = word.b CROSS JOIN total),
sums AS (SELECT doc_id, avg(s) AS s FROM score GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, round(s, 6) AS mean_log_score FROM doc LEFT JOIN sums USING (doc_id)""",
    "op2_merkle_fixity": """
WITH record AS (
  SELECT page_id, page_id // 1024 AS file,
         octet_length(encode('WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
           || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Length: '
           || octet_length(encode(coalesce(html, ''))) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '')
           || chr(13) || chr(10) || chr(13) || chr(10))) AS size
  FROM pages),
placed AS (
  SELECT page_id, file, (page_id * 31 + 7) % 97 AS damage, CAST(coalesce(sum(size) OVER (
    PARTITION BY file ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
  FROM record)
SELECT page_id, file, "offset", CASE damage WHEN 3 THEN 'changed' ELSE 'missing' END AS kind FROM placed WHERE damage IN (3, 5)
UNION ALL SELECT page_id, file, "offset" + 1, 'extra' FROM placed WHERE damage = 11""",
    "op4_winnowing": rf"""
WITH item AS (SELECT item_id, w, least(len(w), 10) AS m FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, m, array_to_string(w[s:s + m - 1], ' ') AS span
  FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM item)),
doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
hit AS (
  SELECT doc_id, s, d.m, item_id
  FROM (SELECT doc_id, m, s, array_to_string(w[s:s + m - 1], ' ') AS span
        FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS s
              FROM doc, (SELECT DISTINCT m FROM item) WHERE len(w) >= m)) d
  JOIN windows USING (span, m)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + m)) AS p FROM hit) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op12_survivor_viterbi": rf"""
WITH RECURSIVE plain AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS place
  FROM conversations),
hurt AS (SELECT *, {_crc32("place")} % 20 AS damage FROM plain),
kept AS (
  SELECT conv_id, turn, CASE damage WHEN 4 THEN 'user' ELSE role END AS role,
         CASE damage WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hurt, (SELECT unnest([1, 2]) AS copy) WHERE damage <> 0 AND (copy = 1 OR damage = 3)),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again) AS i,
         regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS bare
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS again FROM kept)),
judged AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN again > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
         lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair
  FROM numbered),
ids AS (SELECT DISTINCT conv_id, dense_rank() OVER (ORDER BY conv_id) AS c FROM conversations),
placed AS (SELECT c, j.* FROM judged j JOIN ids ON j.conv_id IS NOT DISTINCT FROM ids.conv_id),
step AS (
  SELECT c, 0 AS i, 0 AS state, CAST(0 AS BIGINT) AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS turns FROM ids
  UNION ALL
  SELECT c, i, state, min(cost) AS cost, arg_min(audit, (cost, audit)) AS audit, arg_min(turns, (cost, audit)) AS turns
  FROM (
    SELECT s.c, s.i + 1 AS i, s.cost + e.cost AS cost, s.audit || e.letter AS audit,
           CASE WHEN e.letter = 'D' THEN s.turns ELSE list_append(s.turns, e.role || ':' || r.text) END AS turns, e.state
    FROM (
      SELECT c, i, state, cost, audit, turns FROM step
      UNION ALL SELECT c, i, {_NEXT.format("state")}, cost + 2, audit || 'I', list_append(turns, CASE state WHEN 2 THEN 'assistant:' ELSE 'user:' END) FROM step
      UNION ALL SELECT c, i, CASE state WHEN 2 THEN 2 ELSE 3 END, cost + 4, audit || 'II',
                       turns || CASE state WHEN 2 THEN ['assistant:', 'user:'] ELSE ['user:', 'assistant:'] END FROM step
      UNION ALL SELECT c, i, {_NEXT.format("state")}, cost + 6, audit || 'III',
                       turns || CASE state WHEN 2 THEN ['assistant:', 'user:', 'assistant:'] ELSE ['user:', 'assistant:', 'user:'] END FROM step
    ) s JOIN placed r ON r.c = s.c AND r.i = s.i + 1,
    LATERAL (
      SELECT unnest([
        {{'letter': 'D', 'cost': 3, 'state': s.state, 'role': '', 'fits': true}},
        {{'letter': 'K', 'cost': 0, 'state': CASE r.role[1] WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END, 'role': r.role,
          'fits': (r.role[1] = 's' AND s.state = 0) OR (r.role[1] = 'u' AND s.state <> 2) OR (r.role[1] = 'a' AND s.state = 2)}},
        {{'letter': 'R', 'cost': 2, 'state': CASE s.state WHEN 2 THEN 3 ELSE 2 END, 'role': CASE s.state WHEN 2 THEN 'assistant' ELSE 'user' END,
          'fits': true}}], recursive := true)) AS e0(letter, cost, state, role, fits),
    LATERAL (SELECT e0.letter, e0.state, e0.role, e0.cost + CASE WHEN e0.letter <> 'D' AND r.fault = 'truncated' THEN 1 ELSE 0 END AS cost) AS e
    WHERE e0.fits AND (e0.letter = 'D' OR coalesce(r.fault, '') NOT IN ('blank', 'duplicate'))
  ) GROUP BY c, i, state),
final AS (
  SELECT c, cost, audit, turns FROM (SELECT *, max(i) OVER (PARTITION BY c) AS n FROM step) WHERE i = n AND state IN (0, 3)
  UNION ALL
  SELECT c, cost + CASE state WHEN 2 THEN 2 ELSE 4 END, audit || CASE state WHEN 2 THEN 'I' ELSE 'II' END,
         turns || CASE state WHEN 2 THEN ['assistant:'] ELSE ['user:', 'assistant:'] END
  FROM (SELECT *, max(i) OVER (PARTITION BY c) AS n FROM step) WHERE i = n AND state IN (1, 2)),
best AS (SELECT c, min(cost) AS cost, arg_min(audit, (cost, audit)) AS audit, arg_min(turns, (cost, audit)) AS turns FROM final GROUP BY c),
counts AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM placed GROUP BY c)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost, audit,
       sha256(array_to_string(turns, chr(10))) AS repaired_sha256
FROM ids JOIN best USING (c) LEFT JOIN counts USING (c)""",
    "op13_periodic_runs": rf"""
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {_crc32("CAST(doc_id AS VARCHAR)")} AS h FROM documents),
shape AS (SELECT *, len(w) AS n, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM doc),
period AS (SELECT *, CASE WHEN a IS NOT NULL THEN 1 + (n - a) // (3 + g % 8) END AS p FROM shape),
word AS (
  SELECT doc_id, n, i, CASE WHEN a IS NOT NULL AND i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END AS x
  FROM (SELECT *, unnest(range(0, n)) AS i FROM period)),
gram AS (
  SELECT doc_id, n, i, concat_ws(' ', x, lead(x, 1) OVER o, lead(x, 2) OVER o, lead(x, 3) OVER o, lead(x, 4) OVER o) AS x
  FROM word WINDOW o AS (PARTITION BY doc_id ORDER BY i) QUALIFY i + 5 <= n),
pair AS (
  SELECT a.doc_id, a.i, b.i - a.i AS q FROM gram a JOIN gram b ON a.doc_id = b.doc_id AND a.x = b.x AND a.i < b.i WHERE 4 * (b.i - a.i) <= a.n),
stretch AS (
  SELECT doc_id, q, min(i) AS start, count(*) + 4 + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pair) GROUP BY doc_id, q, island),
run AS (SELECT doc_id, start, length, min(q) AS period FROM stretch WHERE length >= greatest(6, 4 * q) GROUP BY 1, 2, 3),
dropped AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM run),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS text FROM word ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM run GROUP BY doc_id),
best AS (
  SELECT a.* FROM run a QUALIFY row_number() OVER (
    PARTITION BY doc_id ORDER BY CAST(length AS DECIMAL(38, 18)) / period DESC, start, period) = 1)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM doc LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)""",
}
