"""4. Quality rules, carried from documents to their hosts.

Each whole text gets its counts and fails some of RULES, once; they are kept as a narrow table. Each rule's failures
are summed by host, each host's rate of each rule is shrunk toward the corpus by a beta prior that the hosts' own rates
of that rule give (method of moments), and a host with a shrunk rate of at least `most` in any rule loses all its
documents. Two of the rules are the base; those of lines and symbols speak of hosts alone, a document is not lost by
its own failure in them. Clean documents of a mixed host stay.

Counts come from hashes of words, windows and lines, 64 bits each. Null and empty texts: no words, base_failed. Null
hosts: judged by the base rules alone. Repeated rows and ids: counted and judged each. A very long text takes a few
numbers a word. Ties at `most` are rejected. Other columns are ignored, whatever their names. Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm.common import WHITE, map_arrow, materialize, mix, small, steps, table, text_buffer, word_hashes, word_hashes_at

_SYMBOL, _LINE = np.zeros(256, bool), np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LINE[10] = True
#: Bytes that begin a code point of a word.
_CHAR = ~WHITE
_CHAR[0x80:0xC0] = False
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
#: What a document fails: too few words, or more than a share of repeated words, of repeated lines, of symbols a word.
RULES = {"few_words": "n_words < 50", "repeated_words": "100 * n_repeat_words > 50 * n_words", "repeated_lines": "100 * n_dup_lines > 30 * n_lines", "symbols": "100 * n_symbols > 10 * n_words"}
BASE = ["few_words", "repeated_words"]


def per_row(mask: np.ndarray, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many bytes of each row the mask has."""
    out = np.zeros(len(at) - 1, np.int64)
    for a in range(0, len(data), 1 << 22):
        total = np.concatenate([[0], np.cumsum(mask[data[a : a + (1 << 22)]], dtype=np.int64)])
        out += np.diff(total[np.clip(at - a, 0, len(total) - 1)])
    return out


def again(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    order = np.argsort(keys)
    keys = keys[order]
    same = keys[1:] == keys[:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out


def measures(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A row of MEASURES for each text."""
    n = len(at) - 1
    h, first = word_hashes(data, at, False)
    words = np.diff(first)
    row = np.repeat(np.arange(n), words)
    lines, line_first, starts = word_hashes_at(data, at, False, _LINE)
    line_row = np.repeat(np.arange(n), np.diff(line_first))
    chars = np.add.reduceat(~WHITE[data], starts) if len(starts) else np.zeros(0)  # newlines between lines are white
    own = lines[chars > 0] ^ mix(line_row[chars > 0].astype(np.uint64))
    _, kept = np.unique(own, return_index=True)
    n_lines = np.bincount(line_row[chars > 0], minlength=n)
    dup = n_lines - np.bincount(line_row[chars > 0][kept], minlength=n)
    repeated = np.zeros(len(h), bool)
    if len(h) > 2:
        i = np.flatnonzero(row[2:] == row[:-2])
        twice = i[again((h[i] * np.uint64(3) + mix(h[i + 1]) * np.uint64(5) + mix(mix(h[i + 2]))) ^ mix(row[i].astype(np.uint64)))]
        for d in range(3):
            repeated[twice + d] = True
    return np.stack([words, per_row(_CHAR, data, at), per_row(_SYMBOL, data, at), dup, np.bincount(row[repeated], minlength=n), n_lines], axis=1)


def rule_counts(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", host_col: str = "source") -> DataFrame:
    kinds = [docs.schema[c].dataType.simpleString() for c in (id_col, host_col)]

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            data, at = text_buffer(b.column(2))
            found = np.concatenate([np.zeros((0, len(MEASURES)), np.int64), *(measures(data[at[i] : at[j]], at[i : j + 1] - at[i]) for i, j in steps(at))])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(x) for x in found.T.astype(np.int64))], names=["doc_id", "host", *MEASURES])

    made = map_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), F.col(text_col).alias("text")), count, f"doc_id {kinds[0]}, host {kinds[1]}, " + ", ".join(f"{n} long" for n in MEASURES))
    return made.withColumn("base_failed", F.expr(" OR ".join(f"({RULES[r]})" for r in BASE)))


def host_rates(counted: DataFrame) -> DataFrame:
    """host, rule, n, failed, rate: for each rule the posterior mean under a beta prior fitted to all hosts by moments."""
    failures = [F.count_if(F.expr(test)).alias(rule) for rule, test in RULES.items()]
    sums = counted.filter("host is not null").groupBy("host").agg(F.count("*").alias("n"), *failures)
    hosts = sums.select("host", "n", F.explode(F.create_map(*[x for r in RULES for x in (F.lit(r), F.col(r))])).alias("rule", "failed"))
    # Of the rates p = failed / n: mean m (of all rows), variance v less the binomial part; strength m (1 - m) / v - 1.
    moments = hosts.groupBy("rule").agg(
        (F.sum("failed") / F.sum("n")).alias("m"), F.sum("n").alias("t"), F.count("*").alias("k"), F.sum(F.col("n") * F.pow(F.col("failed") / F.col("n"), 2)).alias("s2"),
    )
    spread = F.greatest(F.col("s2") / F.col("t") - F.pow("m", 2) - F.col("m") * (1 - F.col("m")) * F.col("k") / F.col("t"), F.lit(1e-9))
    prior = moments.select("rule", "m", F.least(F.greatest(F.col("m") * (1 - F.col("m")) / spread - 1, F.lit(1.0)), F.lit(1e6)).alias("strength"))
    rate = (F.col("failed") + F.col("m") * F.col("strength")) / (F.col("n") + F.col("strength"))
    return hosts.join(F.broadcast(prior), "rule").select("host", "rule", "n", "failed", rate.alias("rate"))  # a row a rule


def apply_rules(docs: DataFrame, most: float = 0.5, text_col: str = "text", id_col: str = "doc_id", host_col: str = "source", salts: int = 32) -> DataFrame:
    """The counts with base_failed, host_rules (by which the host is rejected, comma-joined), host_rejected and kept.

    Only rejected hosts travel: broadcast where they are few by a check of their size, else joined on host
    and a salt, so that a host with a third of the rows spreads over `salts` tasks.
    """
    counted = materialize(rule_counts(docs, text_col, id_col, host_col), "counted")
    failed = host_rates(counted).filter(F.col("rate") >= most)
    bad = materialize(failed.groupBy("host").agg(F.array_join(F.array_sort(F.collect_set("rule")), ",").alias("host_rules")), "hosts")
    spread = small(bad.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))), 256)
    joined = counted.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")).join(spread, ["host", "_salt"], "left").drop("_salt")
    joined = joined.withColumn("host_rules", F.coalesce("host_rules", F.lit(""))).withColumn("host_rejected", F.col("host_rules") != "")
    return joined.withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = apply_rules(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "host_rules")


OP4_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
c AS (SELECT r, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars, ws FROM w),
win AS (SELECT r, unnest(generate_series(1, n_words - 2)) AS i, ws FROM c WHERE n_words > 2),
tri AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS t FROM win),
rep AS (SELECT r, i, count(*) OVER (PARTITION BY r, t) AS n FROM tri),
pos AS (SELECT DISTINCT r, unnest([i, i + 1, i + 2]) AS p FROM rep WHERE n > 1),
nrep AS (SELECT r, count(*) AS n_repeat_words FROM pos GROUP BY r),
ln AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM ln WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (
  SELECT d.doc_id, d.source, c.n_words, c.word_chars,
    CAST(length(d.text) - length(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines
  FROM d JOIN c USING (r) LEFT JOIN dup USING (r) LEFT JOIN nrep USING (r)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, unnest([
  {'rule': 'few_words', 'fails': n_words < 50}, {'rule': 'repeated_words', 'fails': 100 * n_repeat_words > 50 * n_words},
  {'rule': 'repeated_lines', 'fails': 100 * n_dup_lines > 30 * n_lines}, {'rule': 'symbols', 'fails': 100 * n_symbols > 10 * n_words}]) AS told FROM m),
h AS (SELECT source, told.rule AS rule, CAST(count(*) AS DOUBLE) AS n, CAST(sum(CAST(told.fails AS INT)) AS DOUBLE) AS k FROM f WHERE source IS NOT NULL GROUP BY ALL),
mo AS (SELECT rule, sum(k) / sum(n) AS m, sum(n) AS t, count(*) AS c, sum(n * (k / n) * (k / n)) AS s2 FROM h GROUP BY rule),
pr AS (SELECT rule, m, least(greatest(m * (1 - m) / greatest(s2 / t - m * m - m * (1 - m) * c / t, 1e-9) - 1, 1.0), 1e6) AS s FROM mo),
bad AS (SELECT source, string_agg(rule, ',' ORDER BY rule) AS host_rules FROM h JOIN pr USING (rule) WHERE (k + m * s) / (n + s) >= 0.5 GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND host_rules IS NULL AS kept, n_lines, coalesce(host_rules, '') AS host_rules
FROM f LEFT JOIN bad USING (source) WHERE told.rule = 'few_words'
"""
