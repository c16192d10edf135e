"""History matching and baseline merge for wide exports (M-12, M-13)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftwell.functions.text import base_major, code, full_name, has_variant, major_name


def batch_score(p: dict[str, Column], h: dict[str, Column]) -> Column:
    """Agreement of batches: code, segment and text of plan and history, blank as null; -1 rules the pair out.

    Equal codes: 4 with equal segments (also none on either side), 3 where one lacks it. Without both codes the texts decide.
    """
    known, there = {}, lambda x: F.nullif(F.trim(x), F.lit(""))
    for side, row in (("p", p), ("h", h)):
        known[side] = {k: there(v.cast("string")) for k, v in row.items()}
    p, h = known["p"], known["h"]
    coded = F.when(p["code"] != h["code"], -1).when(p["segment"] != h["segment"], -1).when(p["segment"].eqNullSafe(h["segment"]), 4).otherwise(3)
    worded = F.when(p["text"].isNull() | h["text"].isNull(), 0).when(p["text"] == h["text"], 2).otherwise(-1)
    return F.when(p["code"].isNotNull() & h["code"].isNotNull(), coded).otherwise(worded)


def match_history(plans: DataFrame, past: DataFrame, years: list[int]) -> DataFrame:
    """The one history row for each plan and year, or none where several stay equally good.

    plans: plan_id, school_id, major_id, subject, full_name, canonical_name, school_code, group_code, major_code,
    batch_code, batch_segment, batch_text. past: history_id, year, official and the same, with min_rank, min_score,
    admitted_count, plan_count.
    """
    h = past.filter(F.col("year").isin(years))
    h = h.select(*[F.col(c).alias(f"h_{c}") for c in h.columns]).withColumn("_h", major_name(F.coalesce("h_canonical_name", "h_full_name")))
    p = plans.withColumn("_p", major_name(F.coalesce("canonical_name", "full_name")))
    scope = (p.school_id == h.h_school_id) & p.subject.eqNullSafe(h.h_subject)
    by_name = p.join(h, scope & (p["_p"] == h["_h"]) & (p["_p"] != "")).withColumn("_tier0", F.lit(0))
    by_id = p.join(h, scope & (p.major_id == h.h_major_id)).withColumn("_tier0", F.lit(1))
    c = by_name.unionByName(by_id.filter(~F.coalesce((F.col("_p") == F.col("_h")) & (F.col("_p") != ""), F.lit(False))))

    def given(x: str) -> Column:
        return F.coalesce(code(x), F.lit("")) != ""

    def same(x: str) -> Column:
        return given(x) & (code(x) == code(f"h_{x}"))

    def clash(x: str) -> Column:
        return given(x) & given(f"h_{x}") & (code(x) != code(f"h_{x}"))

    same_full = (full_name("full_name") == full_name("h_full_name")) & (full_name("full_name") != "")
    ids_differ = F.coalesce(F.col("major_id") != F.col("h_major_id"), F.lit(False))
    bases = F.coalesce(major_name(base_major("full_name")) != major_name(base_major("h_full_name")), F.lit(False))
    variants = F.coalesce(has_variant("full_name") & has_variant("h_full_name") & ~same_full, F.lit(False))
    ok = (~ids_differ | same("major_code") | same_full) & ~clash("school_code") & ~clash("group_code") & ~clash("major_code") & ~bases & (~variants | same("major_code"))
    b = batch_score({k: F.col(f"batch_{k}") for k in ("code", "segment", "text")}, {k: F.col(f"h_batch_{k}") for k in ("code", "segment", "text")})
    tier = F.when(same("school_code") & same("major_code"), 0).when(same("group_code") & same("major_code"), 1).when(same("major_code"), 2).when(same_full, 3).otherwise(4)
    identity = F.concat_ws("\x01", *[F.coalesce(code(f"h_{x}"), F.lit("")) for x in ("school_code", "group_code", "major_code")], full_name("h_full_name"))
    whole = sum(F.when(F.col(f"h_{x}").isNotNull(), 1).otherwise(0) for x in ("min_rank", "min_score", "admitted_count", "plan_count"))
    # what the choice needs goes to the plan and year, not the rows
    c = c.filter(ok).select("plan_id", "h_year", "h_history_id", "h_major_id", F.col("major_id").isNotNull().alias("_known"), b.alias("_batch"), tier.alias("_tier"), identity.alias("_identity"), whole.alias("_whole"), "h_official", "_tier0")
    key = Window.partitionBy("plan_id", "h_year")

    def one(x: str) -> Column:
        return F.coalesce(F.min(x).over(key) == F.max(x).over(key), F.lit(True))

    c = c.withColumn("_one", one("h_major_id")).filter(F.col("_known") | F.col("_one"))
    c = c.filter("_batch >= 0").withColumn("_best", F.max("_batch").over(key)).filter("_batch = _best")
    c = c.withColumn("_first", F.min("_tier").over(key)).filter("_tier = _first")
    c = c.withColumn("_one", one("_identity")).filter("_one")
    order = key.orderBy(F.col("_whole").desc(), F.col("h_official").desc(), "_tier0", F.col("h_major_id").asc_nulls_last(), "h_history_id")
    return c.withColumn("_rn", F.row_number().over(order)).filter("_rn = 1").select("plan_id", F.col("h_year").alias("year"), F.col("h_history_id").alias("history_id"))


def merge_baseline(generated: DataFrame, baseline: DataFrame, exact: list[str], name: list[str], replaced: list[str], order: list[str] | None = None) -> DataFrame:
    """Baseline rows with the generated block where one matches, then unmatched generated rows (M-13, H-6).

    Generated rows take their turn by `order` (columns of both tables; all columns, unless given). Each takes the only
    baseline row of its exact key that none has taken yet, else the only one of its name key, else it is new. Rows meet
    within the columns that both keys have in common, a group at a time, so groups do not wait for each other.
    """
    scope = [c for c in exact if c in name]
    if not scope:
        raise ValueError("the two keys need a column in common")
    kinds = baseline.schema

    def turns(_, left: pa.Table, right: pa.Table) -> pa.Table:
        def sorted_rows(t: pa.Table) -> list[dict]:
            return sorted(t.to_pylist(), key=lambda r: [(r[c] is None, r[c]) for c in order or t.column_names if not isinstance(r[c], dict | list)])

        rows, found = sorted_rows(right), sorted_rows(left)
        free, out = set(range(len(rows))), [dict(r) for r in rows]
        index: list[dict[tuple, list[int]]] = [{}, {}]
        for which, columns in zip(index, (exact, name)):
            for i, r in enumerate(rows):
                which.setdefault(tuple(r[c] for c in columns), []).append(i)
        for g in found:
            for which, columns in zip(index, (exact, name)):
                held = [i for i in which.get(tuple(g[c] for c in columns), []) if i in free]
                if len(held) == 1:
                    free.discard(held[0])
                    out[held[0]].update({c: g[c] for c in replaced})
                    break
            else:
                out.append({c: g.get(c) for c in right.column_names})
        return pa.Table.from_pylist(out, right.schema)

    return generated.groupBy(*scope).cogroup(baseline.groupBy(*scope)).applyInArrow(turns, kinds)
