"""The queries of this subpackage and their SQL: the operators', and what of their results SQL can tell."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm import bpe_transducer, conversation_repair, jaccard_join, lm_scoring, mixing, neighbours, packing, periodic_runs, pii, quality_classifier, quality_rules, sharding, token_counts


def sharding_law(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row about op2: its law, rows, bytes, shards, whether counts are at most one apart and slots gapless."""
    shards = sharding.op2_sharding(spark, sf_dir).groupBy("law", "shard").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"), F.min("slot").alias("low"), F.max("slot").alias("high"), F.count_distinct("slot").alias("slots"))
    whole = F.bool_and((F.col("low") == 0) & (F.col("high") == F.col("n") - 1) & (F.col("slots") == F.col("n")))
    return shards.groupBy("law").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.count("*").alias("shards"), (F.max("n") - F.min("n") <= 1).alias("even"), whole.alias("gapless"))


def pii_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.op8_pii(spark, sf_dir).select("doc_id", "n_email", "n_ip", "n_card", "n_phone")


def mixing_law(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each source: its rows, how many are in their window, how many places of the schedule they take."""
    out = mixing.op9_mixing(spark, sf_dir)
    within = (F.col("release") <= F.col("slot")) & (F.col("slot") < F.col("deadline"))
    return out.groupBy("source").agg(F.count("*").alias("n"), F.count_if(within).alias("within"), F.count_distinct("slot", "place").alias("places"))


def lm_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10's counts and, in units of 10^-4, its base score."""
    out = lm_scoring.op10_lm_scoring(spark, sf_dir)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round(10_000 * F.col("base_score")).cast("long").alias("base"))


def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_transducer.op11_byte_bpe(spark, sf_dir).select("doc_id", "decoded_sha256")


def conversation_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13's counts of what is wrong; its repairs SQL does not tell."""
    return conversation_repair.op13_conversation_repair(spark, sf_dir).select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal")


SHARDING_SQL = "SELECT 'rows' AS law, count(*) AS n, CAST(sum(strlen(coalesce(text, '')) + 1) AS BIGINT) AS bytes, least(count(*), 8) AS shards, true AS even, true AS gapless FROM documents HAVING count(*) > 0"
MIXING_SQL = "SELECT source, count(*) AS n, count(*) AS within, count(*) AS places FROM documents GROUP BY source"
PII_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS (SELECT doc_id, regexp_extract_all(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+') AS e, regexp_extract_all(t, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)') AS i,
  list_transform(regexp_extract_all(t, '[0-9]([\x20-]?[0-9])+'), lambda x: regexp_replace(x, '[^0-9]', '', 'g')) AS c,
  list_transform(regexp_extract_all(t, '\+[0-9][\x20().0-9-]+[0-9]'), lambda x: length(regexp_replace(x, '[^0-9]', '', 'g'))) AS p FROM d)
SELECT doc_id, CAST(len(e) AS BIGINT) AS n_email,
  CAST(len(list_filter(i, lambda x: list_max(list_transform(string_split(x, '.'), lambda y: coalesce(TRY_CAST(y AS BIGINT), 999))) <= 255)) AS BIGINT) AS n_ip,
  CAST(len(list_filter(c, lambda x: length(x) BETWEEN 12 AND 19 AND list_sum(list_transform(generate_series(1, length(x)),
    lambda k: CASE WHEN k % 2 = 1 THEN CAST(x[length(x) + 1 - k] AS INT) ELSE CAST(x[length(x) + 1 - k] AS INT) * 2 - CASE WHEN CAST(x[length(x) + 1 - k] AS INT) > 4 THEN 9 ELSE 0 END END)) % 10 = 0)) AS BIGINT) AS n_card,
  CAST(len(list_filter(p, lambda x: x BETWEEN 9 AND 15)) AS BIGINT) AS n_phone FROM f"""
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
#: crc32 of the id's digits: a byte is mixed in, then eight shifts.
_CRC32 = "xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [256 + ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0])), lambda a, s: CASE WHEN s >= 256 THEN xor(a, s - 256) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295)"
LM_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_CRC32} % 7 = 2, false) AS held_out, {_WORDS} || ['</>end </>'] AS ws FROM documents),
tok AS (SELECT r, held_out, unnest(ws) AS w FROM d), voc AS (SELECT w, count(*) AS c FROM tok WHERE NOT held_out GROUP BY w), z AS (SELECT coalesce(sum(c), 0)::BIGINT AS n, count(*) AS v FROM voc),
s AS (SELECT r, count(*) AS n_tokens, count(c) AS n_known, sum(log10((coalesce(c, 0) + 1) / (n + v + 1)::DOUBLE)) AS b FROM tok LEFT JOIN voc USING (w) CROSS JOIN z GROUP BY r)
SELECT doc_id, held_out, n_tokens, n_known, n AS train_tokens, CAST(round(10000 * b) AS BIGINT) AS base FROM d JOIN s USING (r) CROSS JOIN z"""
JACCARD_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, sh FROM (SELECT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(generate_series(1, len(ws) - 4), lambda i: array_to_string(ws[i : i + 4], ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM n UNION SELECT reach.x, e.y FROM reach JOIN e ON e.x = reach.y)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.c, d.doc_id) AS component_id FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT x AS doc_id, min(y) AS c FROM reach GROUP BY x) m USING (doc_id)"""

ROUND_TRIP_SQL = "SELECT doc_id, sha256(coalesce(text, '')) AS decoded_sha256 FROM documents"
#: Stretches of words that equal those q before them; of one stretch the smallest q is the period.
RUNS_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_CRC32}, 1) AS h, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
g AS (SELECT *, len(ws) AS n, CASE WHEN h % 10 = 0 AND len(ws) > 0 THEN (h // 10) % len(ws) END AS a FROM d),
p AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM g),
t AS (SELECT r, doc_id, n, CASE WHEN a IS NULL THEN ws ELSE list_transform(generate_series(0, n - 1), lambda i: CASE WHEN i >= a THEN ws[a + (i - a) % p + 1] ELSE ws[i + 1] END) END AS ws FROM p),
w AS (SELECT r, n, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS i FROM t),
e AS (SELECT x.r, y.i - x.i AS q, x.i FROM w x JOIN w y ON x.r = y.r AND x.w = y.w AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
s AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM e),
f AS (SELECT r, min(i) AS start, count(*) + q AS length, q FROM s GROUP BY r, q, k HAVING count(*) + q >= greatest(6, 4 * q)),
u AS (SELECT r, start, length, min(q) AS period FROM f GROUP BY r, start, length),
o AS (SELECT DISTINCT r, unnest(generate_series(start + period, start + length - 1)) AS i FROM u),
c AS (SELECT w.r, string_agg(w.w, ' ' ORDER BY w.i) AS text FROM w LEFT JOIN o ON o.r = w.r AND o.i = w.i WHERE o.i IS NULL GROUP BY w.r),
b AS (SELECT r, count(*) AS n_runs, first(struct_pack(start, length, period) ORDER BY length DESC, start, period) AS best, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM u GROUP BY r)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(best.start AS BIGINT) AS start, CAST(best.length AS BIGINT) AS length, CAST(best.period AS BIGINT) AS period,
  CAST(1000 * best.length // best.period AS BIGINT) AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(c.text, '')) AS collapsed_sha256
FROM t LEFT JOIN b USING (r) LEFT JOIN c USING (r)"""
FAULTS_SQL = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC32.replace("doc_id::VARCHAR", "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS k FROM conversations),
m AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(CASE WHEN k = 3 THEN [1, 2] ELSE [1] END) AS copy FROM c WHERE k <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM m),
f AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS again, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair, regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS sign FROM o),
g AS (SELECT *, NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank FROM f),
s AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND again > 1) AS duplicate,
  count(*) FILTER (NOT blank AND again = 1 AND sign NOT IN ('.', '!', '?')) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM g GROUP BY conv_id)
SELECT conv_id, {", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in ("gaps", "blank", "duplicate", "truncated", "illegal"))} FROM (SELECT DISTINCT conv_id FROM conversations) e LEFT JOIN s USING (conv_id)"""

QUERIES = {
    f.__name__: f
    for f in (
        token_counts.op1_token_counts, sharding.op2_sharding, packing.op3_best_fit_packing, quality_rules.op4_quality_rules, quality_classifier.op5_quality_classifier,
        jaccard_join.op6_jaccard_join, neighbours.op7_nearest_neighbours, pii.op8_pii, mixing.op9_mixing, lm_scoring.op10_lm_scoring,
        bpe_transducer.op11_byte_bpe, periodic_runs.op12_periodic_runs, conversation_repair.op13_conversation_repair,
        sharding_law, pii_base_counts, mixing_law, lm_base_counts, bpe_round_trip, conversation_faults,
    )
}
SQL = {
    "op4_quality_rules": quality_rules.OP4_SQL, "op6_jaccard_join": JACCARD_SQL,
    "sharding_law": SHARDING_SQL, "pii_base_counts": PII_SQL, "mixing_law": MIXING_SQL, "lm_base_counts": LM_SQL,
    "op12_periodic_runs": RUNS_SQL, "bpe_round_trip": ROUND_TRIP_SQL, "conversation_faults": FAULTS_SQL,
}
