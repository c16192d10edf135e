import time

from pyspark.sql import functions as F

from siftwell.plans import finders


def test_seeds(spark):
    held = spark.createDataFrame([(7, "辽宁", "old", None, None, None), (9, "别处", "x", None, None, None)], "id int, name string, code string, region string, exam_mode string, exam_mode_year int")
    out = {r.name: r for r in finders.seeded(held, finders.province_seeds(spark)).collect()}
    assert len(out) == 32 and out["辽宁"].id == 7 and out["辽宁"].code == "21" and out["别处"].code == "x" and sorted(r.id for r in out.values()) == [7, 9, *range(10, 40)]
    subjects = finders.seeded(spark.createDataFrame([], "id int, name string, category_type string"), finders.subject_seeds(spark))
    assert subjects.count() == 48 and subjects.filter("name = '物理类'").collect()[0].category_type == "new"


def test_finders(spark):
    p = spark.createDataFrame([(1, "a", "11"), (2, "b", ""), (3, "c", None)], "id int, name string, code string")
    assert {tuple(r) for r in finders.province_targets(p).collect()} == {(1, "a", "11"), (2, "b", "2"), (3, "c", "3")}
    assert {r.id for r in finders.province_targets(p, [" 11", "c", ""]).collect()} == {1, 3}
    q = spark.createDataFrame([("x",), ("y",), ("z",)], "k string")
    rows = spark.createDataFrame([(1, "x"), (2, "y"), (3, "y")], "id int, code string")
    assert {r.k: r.found for r in finders.only_match(q, q.k, rows, "code", "id", "found").collect()} == {"x": 1, "y": None, "z": None}
    majors = spark.createDataFrame([(1, "m", "u"), (2, "m", "v"), (3, "n", "u")], "id int, name string, education_level string")
    held = spark.createDataFrame([(10, 1), (10, 2), (11, 1)], "school_id int, major_id int")
    ask = spark.createDataFrame([(0, 10, "m", None), (1, 10, "m", "v"), (2, 11, "m", None), (3, 11, "n", None), (4, 11, "n", "v"), (5, 11, None, None)], "request int, school_id int, major_name string, education_level string")
    assert [r.major_id for r in finders.school_major_ids(ask, held, majors).orderBy("request").collect()] == [None, 2, 1, None, None, None]
    assert [r.major_id for r in finders.school_major_ids(ask, held, majors, True).orderBy("request").collect()] == [None, 2, 1, 3, None, None]


def test_majors_of_one_name(spark):
    """50,000 majors of one name and 500,000 requests for it: a request meets their count, not them."""
    majors = spark.range(50_000).select("id", F.lit("m").alias("name"), F.when(F.col("id") > 0, F.concat(F.lit("v"), (F.col("id") % 5).cast("string"))).alias("education_level"))
    ask = spark.range(500_000).select(F.col("id").alias("request"), (F.col("id") % 3).alias("school_id"), F.lit("m").alias("major_name"), F.when(F.col("id") % 2 == 0, "v0").alias("education_level"))
    held = spark.createDataFrame([(0, 0), (0, 5), (1, 5), (1, 10), (2, 0), (2, 0)], "school_id long, major_id long")
    began = time.time()
    found = finders.school_major_ids(ask, held, majors, True).groupBy("school_id", "education_level", "major_id").count().collect()
    assert {tuple(r)[:3] for r in found} == {(0, None, None), (0, "v0", 5), (1, None, None), (1, "v0", None), (2, None, 0), (2, "v0", None)}
    assert time.time() - began < 30
