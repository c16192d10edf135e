"""9. Mixing sources to target weights: Pfair scheduling.

Each source's rows, in hash order, form blocks of `block` rows. Weights become whole slots of a cycle of
`cycle` slots. Block i (from 0) of a source with a slots a cycle is released at floor(i * cycle / a) and
due at ceil((i + 1) * cycle / a); one SQL fold over the cycle gives each slot to the released block with
the earliest deadline, which meets every deadline, so at every slot each source that still has rows is
less than one block from its weight. Cycles repeat, so a row's slot follows from its rank in its source
by arithmetic and a join with the cycle. A source that has run out leaves its slots empty.

Every source has its own weight. Beyond `cycle` // 2 sources those due at least `OWN` slots keep slots
of the cycle, and the others are dealt by hash into lanes of about `LANE` sources. A lane weighs what its sources
weigh together, and has a cycle of its own that deals its slots to them by the same fold; lanes are nested
until few enough are left. Release and deadline are then those of the lane's slots, carried upwards.

No row is dropped or repeated: the decision is the order. Null sources are a source of their own, and
so are null ids; repeated rows and ids follow each other by a hash of the row, and rows that are alike are dealt
apart, so none of them makes a large task. Sources that given weights do not name have the smallest of them. Texts
of any length only travel along. The schedule's columns have names that no column has: underscores are added
(`schedule_names`). Empty table: no rows. All of it is DataFrame and SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm.common import bucket_rows, free, lengthened, materialize, small, table, with_rank

SCHEDULE = ("block", "release", "deadline", "slot", "place")
LANE = 64  # sources of a lane
OWN = 8  # slots that a source of average weight has in its lane, and that one outside of lanes has at least


def source_weights(docs: DataFrame, weights: dict[str | None, float] | None, source_col: str, power: float = 0.7) -> DataFrame:
    """_key, _w: each source's weight, as given or its rows to the `power`; keys are "=" and the name, or "" for null."""
    found = docs.groupBy(source_key(source_col).alias("_key")).count()
    if not weights:
        return found.select("_key", F.pow("count", F.lit(power)).alias("_w"))
    given = literal_rows(docs.sparkSession, [F.struct(F.lit("" if s is None else f"={s}").alias("_key"), F.lit(float(w)).alias("_w")) for s, w in weights.items()])
    return found.select("_key").join(given, "_key", "full").select("_key", F.coalesce("_w", F.lit(float(min(weights.values())))).alias("_w"))


def literal_rows(spark: SparkSession, rows: list[Column]) -> DataFrame:
    return spark.range(1).select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def source_key(source_col: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit(""))


def slots(weights: dict, cycle: int) -> list[tuple[str | None, int]]:
    """Whole slots of a cycle, one at least, by largest remainders; the sum is `cycle`."""
    total, names = sum(weights.values()), sorted(weights, key=lambda x: (x is not None, x or ""))
    exact = {s: weights[s] / total * (cycle - len(names)) for s in names}
    own = {s: 1 + int(exact[s]) for s in names}
    for s in sorted(names, key=lambda s: (int(exact[s]) - exact[s], s is not None, s or ""))[: cycle - sum(own.values())]:
        own[s] += 1
    return [(s, own[s]) for s in names]


def edf_cycles(lanes: DataFrame) -> DataFrame:
    """_key, _turns, _cycle, _up: each member's slots of its lane's cycle. lanes: _up, m (members: _key, _w), a (their slots)."""
    due = "(c + 1) * n DIV element_at(a, k + 1) + if((c + 1) * n % element_at(a, k + 1) = 0, 0, 1)"
    ready = f"filter(transform(st.c, (c, k) -> named_struct('d', {due}, 'k', k, 'r', c * n DIV element_at(a, k + 1))), x -> x.r <= t)"
    step = f"transform(array(array_min({ready})), b -> named_struct('c', transform(st.c, (c, k) -> if(k = b.k, c + 1, c)), 'out', concat(st.out, array(b.k))))[0]"
    fold = f"aggregate(sequence(0L, n - 1), named_struct('c', transform(a, x -> 0L), 'out', CAST(array() AS ARRAY<INT>)), (st, t) -> {step}, st -> st.out)"
    folded = lanes.selectExpr("_up", "m", "a", "aggregate(a, 0L, (x, y) -> x + y) AS n").selectExpr("_up", "m", "n", f"{fold} AS o")
    turns = "transform(filter(transform(o, (y, at) -> named_struct('k', y, 'at', CAST(at AS BIGINT))), y -> y.k = k), y -> y.at)"
    return folded.selectExpr("_up", "n AS _cycle", f"inline(transform(m, (x, k) -> named_struct('_key', x._key, '_turns', {turns})))")


def levels(weights: DataFrame, cycle: int, seed: int) -> tuple[DataFrame, list[DataFrame]]:
    """The cycle, for sources and outermost lanes by _key, and the lanes' own cycles from the inmost on."""
    spark, nested = weights.sparkSession, []
    top = [tuple(r) for r in weights.orderBy(F.desc("_w"), "_key").limit(cycle // 2 + 1).select("_key", "_w").collect()]
    if len(top) > cycle // 2:
        least = weights.agg(F.sum("_w")).collect()[0][0] / cycle * OWN
        top = [x for x in top if x[1] >= least]  # `cycle` // OWN at most
        members = weights.filter(F.col("_w") < least)
        lanes = -(-members.count() // LANE)
        members = members.withColumn("_lane", F.pmod(F.xxhash64(F.lit(seed), "_key"), F.lit(lanes)))
        while True:
            members = members.withColumn("_up", F.format_string("#%d/%d", F.lit(len(nested)), "_lane"))
            grouped = members.groupBy("_up").agg(F.sort_array(F.collect_list(F.struct("_key", "_w"))).alias("m"), F.sum("_w").alias("_all"))
            nested.append(materialize(edf_cycles(grouped.selectExpr("_up", "m", f"transform(m, x -> greatest(1L, CAST(round(x._w / _all * {OWN} * size(m)) AS BIGINT))) AS a")), "lanes"))
            members = members.groupBy(F.col("_up").alias("_key"), "_lane").agg(F.sum("_w").alias("_w"))
            if lanes <= max(1, cycle // 16):
                break
            members, lanes = members.withColumn("_lane", F.expr(f"_lane DIV {LANE}")), -(-lanes // LANE)
        top += [tuple(r) for r in members.select("_key", "_w").collect()]  # `cycle` // 16 at most, or one
    shares = slots(dict(top), cycle)
    one = spark.range(1).select(F.lit("").alias("_up"), F.array(*[F.struct(F.lit(k).alias("_key"), F.lit(0.0).alias("_w")) for k, _ in shares]).alias("m"), F.array(*[F.lit(n).cast("long") for _, n in shares]).alias("a"))
    return edf_cycles(one), nested


def climbed(rows: DataFrame, turns: DataFrame) -> DataFrame:
    """The slot, release and deadline of rows that have block numbers there, a level up."""
    up = rows.join(turns, "_key").withColumn("_a", F.size("_turns").cast("long"))
    up = up.withColumn("release", F.expr("release * _cycle DIV _a")).withColumn("deadline", F.expr("(deadline * _cycle + _a - 1) DIV _a"))
    return up.withColumn("slot", F.expr("slot DIV _a * _cycle + element_at(_turns, CAST(slot % _a AS INT) + 1)")).withColumn("_key", F.col("_up")).drop("_a", "_turns", "_cycle", "_up")


def schedule_names(columns: list[str]) -> dict[str, str]:
    """What the columns of SCHEDULE are called beside `columns`."""
    return {c: free(columns, c) for c in SCHEDULE}


def scheduled(columns: list[str], name: str) -> str:
    """The column of mix's result, whose columns are given, that is the schedule's `name`."""
    return lengthened(columns, name)[-1]


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, block: int = 8, cycle: int = 1000, seed: int = 1, source_col: str = "source", id_col: str = "doc_id") -> DataFrame:
    """All rows and columns of `docs` with block, release, deadline, slot and place (in its block).

    The mix is the order by slot and place.
    """
    own, names = docs.columns, schedule_names(docs.columns)
    sources = materialize(source_weights(docs, weights, source_col), "sources")
    if not weights and sources.isEmpty():
        return docs.select("*", *[F.lit(0).cast("long").alias(c) for c in names.values()])
    top, nested = levels(sources, cycle, seed)
    # The row's columns travel as one, so that none of the names below can meet theirs.
    keyed = docs.select(source_key(source_col).alias("_key"), F.xxhash64(F.lit(seed), id_col, *own).alias("hash"), F.pmod(F.monotonically_increasing_id(), F.lit(64)).alias("copy"), F.struct(*own).alias("of"))
    keyed = keyed.withColumn("hash", F.xxhash64("hash", "copy"))
    rows = docs.select(source_col).count()
    ranked = with_rank(keyed, ["_key"], [F.col("hash"), F.col("copy")], "rank", 1 + rows // bucket_rows(rows), "ranked")
    ranked = ranked.select("_key", "of", F.expr(f"rank DIV {block}").alias("block"), (F.col("rank") % block).alias("place")).withColumns({"slot": F.col("block"), "release": F.col("block"), "deadline": F.col("block") + 1})
    top = small(top, 64 + 16 * cycle)  # a row for each of `cycle` // 2 sources and lanes at most
    out = climbed(ranked, top)
    if nested:
        tail = ranked.join(small(top.select("_key")), "_key", "left_anti")
        for turns in nested:
            tail = climbed(tail, turns)
        out = out.unionByName(climbed(tail, top))
    return out.select(*[F.col("of")[c].alias(c) for c in own], *[F.col(c).alias(names[c]) for c in SCHEDULE])


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "source"))
