import datetime as dt

from pyspark.sql import functions as F

from siftwell.functions import hashing
from siftwell.operators import ledger, merge
from siftwell.plans import entities

T = dt.datetime(2024, 5, 1, 12)


def test_apply(spark):
    ddl = "province_id long, year int, subject_category_id long, score int, cumulative_count int"
    now = spark.createDataFrame([(1, 2024, None, 600, 5), (1, 2024, 2, 600, 7)], ddl)
    new = spark.createDataFrame([(1, 2024, None, 600, 6), (1, 2024, 2, 600, 7), (1, 1999, 2, 600, 7), (2, 2024, 2, 1, 1)], ddl)
    table, log, bad = entities.apply("score_segments", now, new)
    assert sorted(r.cumulative_count for r in table.collect()) == [1, 6, 7]
    assert sorted(r.change_type for r in log.collect()) == ["new", "unchanged", "updated"]
    assert [r.errors for r in bad.collect()] == [["year"]]


def test_null_strict_keys(spark):
    ddl = "code string, education_level string, name string"
    now = spark.createDataFrame([("1", None, "a")], ddl)
    table, _, bad = entities.apply("majors", now, spark.createDataFrame([("1", None, "b"), (" ", "x", "c")], ddl))
    assert sorted(r.name for r in table.collect()) == ["a", "b"] and [r.name for r in bad.collect()] == ["c"]


def test_plain_and_unknown(spark):
    ddl = "name string, education_level string, code string"
    now = spark.createDataFrame([("a", "x", "1")], ddl)
    table, log, _ = entities.apply("major_categories", now, spark.createDataFrame([("a", "x", "2")], ddl))
    assert [r.code for r in table.collect()] == ["2"] and log is None
    assert entities.apply("nothing", now, now)[2].collect()[0].errors == ["entity"]


def test_ledger(spark):
    hour = dt.timedelta(hours=1)
    rows = [("a", "majors", "running", T, 0, 0, None), ledger.finished("a", "majors", T, 5, 0), ("b", "majors", "running", T - 9 * hour, 0, 0, None), ledger.finished("c", "schools", T, 5, 1), ledger.finished("d", "timelines", T, 1, 0, "E")]
    log = spark.createDataFrame(rows, ledger.SCHEMA)
    assert {r.task_id: r.status for r in ledger.latest(log).collect()} == {"a": "success", "b": "running", "c": "success", "d": "failed"}
    (s,) = ledger.stale(log, T, 3600).collect()
    assert (s.task_id, s.status, s.error) == ("b", "failed", "stale")
    assert [r.task_id for r in ledger.recent(log, 2).collect()] == ["a", "c"]
    assert ledger.stable(log, "majors") and not ledger.stable(log, "schools") and not ledger.stable(log, "timelines") and not ledger.stable(log, "none")
    assert ledger.stable(log, "none", 10, 10)


def test_changes_by_one_join(spark):
    """Table and log of a batch come from one join, and are what three_state, upsert and snapshots give step by step."""
    held = spark.createDataFrame([(1, "a", 5, "x"), (2, "b", None, "y"), (None, "c", 7, None), (4, "d", 8, "z")], "k int, v string, n int, w string")
    batch = spark.createDataFrame([(1, "a", 5, "x"), (2, None, 3, "y"), (None, "c", 9, None), (5, "e", None, "q")], "k int, v string, n int, w string")
    for null_safe in (True, False):
        for current, incoming in [(held, batch), (held.withColumn("content_hash", hashing.content_hash(held)), batch), (held, batch.drop("w")), (held.limit(0), batch)]:
            spec, kept = merge.EntitySpec("t", ("k",), null_safe, preserve=("v",), conditional={"n": F.coalesce(F.col("n") > 4, F.lit(False))}), []
            after, log = merge.apply_changes(current, incoming, spec, "t", keep=lambda met: kept.append(met) or met)
            assert len(kept) == 1 and all(df._jdf.queryExecution().optimizedPlan().toString().count("Join ") <= 1 for df in (after, log))
            known = current if "content_hash" in current.columns else current.withColumn("content_hash", hashing.content_hash(current))
            changes = merge.three_state(known, incoming.withColumn("content_hash", hashing.content_hash(incoming)), spec)
            moved = changes.filter("change_type <> 'unchanged'").select(*[c for c in current.columns if c in changes.columns])
            for got, want in ((after, merge.upsert(current, moved, spec)), (log, merge.snapshots(current, changes, spec, "t"))):
                assert got.columns == want.columns and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
