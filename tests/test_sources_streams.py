import json

import pytest

from siftwell.operators.merge import EntitySpec
from siftwell.sources import html_tables, json_payloads, page_tables
from siftwell.streaming import ingest


def test_tables(spark):
    page = "<table><tr><th>年份</th><th>分</th></tr><tr><td>2023</td><td> 5<b>0</b>0 </td></tr></table><table><tr><td>x</td></tr></table>"
    df = spark.createDataFrame([(1, page), (2, None)], "id long, html string")
    rows = html_tables.table_rows(df, "html", "id")
    assert rows.count() == 3
    found = html_tables.with_headers(rows, "id", ["分"]).collect()
    assert [r.row for r in found] == [{"年份": "2023", "分": "500"}]


def test_payloads(spark):
    texts = ['{"data": [{"a": 1}, 5, null]}', '{"data": {"item": [{"a": 2}]}}', '{"data": {"g": {"item": [{"a": 3}, {"a": 4}]}}}', "{}"]
    df = spark.createDataFrame([(t,) for t in texts], "p string")
    assert sorted(r.a for r in json_payloads.plan_items(df, "p", "struct<a: int>").collect()) == [1, 2, 3, 4]


def test_ingest(spark, tmp_path):
    schema, spec = "k long, v string", EntitySpec("things", ("k",))
    land, table = f"{tmp_path}/land", f"{tmp_path}/table"
    for rows in ([(1, "a"), (2, "b")], [(2, "c"), (3, "d")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(land)
        ingest.ingest(spark, land, schema, table, spec, f"{tmp_path}/check")
    assert sorted(map(tuple, ingest.read(spark, table, schema).collect())) == [(1, "a"), (2, "c"), (3, "d")]
    log = spark.read.parquet(f"{table}_snapshots")
    assert sorted(r.change_type for r in log.collect()) == ["new", "new", "new", "updated"]


def test_ingest_retries(spark, tmp_path, monkeypatch):
    """A batch tried again, whether the crash came before or after the pointer moved; and a new stream's first batch."""
    schema, spec = "k long, v string", EntitySpec("things", ("k",))
    land, table, check = f"{tmp_path}/land", f"{tmp_path}/table", f"{tmp_path}/check"
    rows = lambda: sorted(map(tuple, ingest.read(spark, table, schema).collect()))
    spark.createDataFrame([(1, "a"), (2, "b")], schema).coalesce(1).write.parquet(land)
    move = ingest._point
    monkeypatch.setattr(ingest, "_point", lambda *a: 1 / 0)
    with pytest.raises(Exception):  # noqa: B017  before
        ingest.ingest(spark, land, schema, table, spec, check)
    assert rows() == [] and ingest.current_version(spark, table) == -1
    monkeypatch.setattr(ingest, "_point", move)
    ingest.ingest(spark, land, schema, table, spec, check)
    assert rows() == [(1, "a"), (2, "b")]
    for p in (tmp_path / "check" / "commits").iterdir():  # after
        if p.name in ("0", ".0.crc"):
            p.unlink()
    ingest.ingest(spark, land, schema, table, spec, check)
    assert rows() == [(1, "a"), (2, "b")] and ingest.current_version(spark, table) == 0
    spark.createDataFrame([(2, "c")], schema).coalesce(1).write.mode("append").parquet(land)
    ingest.ingest(spark, land, schema, table, spec, check)
    assert rows() == [(1, "a"), (2, "c")] and spark.read.parquet(f"{table}_snapshots").count() == 3
    spark.createDataFrame([(3, "d")], schema).coalesce(1).write.parquet(f"{tmp_path}/other")
    ingest.ingest(spark, f"{tmp_path}/other", schema, table, spec, f"{tmp_path}/check2")
    assert rows() == [(1, "a"), (2, "c"), (3, "d")]


def test_ingest_rewrites_only_what_it_touches(spark, tmp_path):
    schema, spec = "k long, v string", EntitySpec("things", ("k",))
    land, table = f"{tmp_path}/land", f"{tmp_path}/table"
    files = lambda: {str(p.relative_to(table)) for p in (tmp_path / "table").rglob("*.parquet")}
    spark.createDataFrame([(i, "a") for i in range(200)], schema).write.parquet(land)
    ingest.ingest(spark, land, schema, table, spec, f"{tmp_path}/check", buckets=8)
    before, first = files(), ingest.current(spark, table)
    assert len(first["folders"]) == 8
    spark.createDataFrame([(5, "b")], schema).coalesce(1).write.mode("append").parquet(land)
    ingest.ingest(spark, land, schema, table, spec, f"{tmp_path}/check")
    second = ingest.current(spark, table)
    moved = [b for b in second["folders"] if second["folders"][b] != first["folders"][b]]
    assert len(moved) == 1 and second["buckets"] == 8 and len(files() - before) == 1  # one file of eight is new
    assert sorted(map(tuple, ingest.read(spark, table, schema).collect())) == sorted((i, "b" if i == 5 else "a") for i in range(200))
    assert ingest.read(spark, table, schema, [int(moved[0])]).filter("k = 5").count() == 1
    spark.createDataFrame([(5, "c")], schema).coalesce(1).write.mode("append").parquet(land)
    ingest.ingest(spark, land, schema, table, spec, f"{tmp_path}/check")
    assert first["folders"][moved[0]] not in {f.rsplit("/", 1)[0] for f in files()}  # replaced two commits ago
    assert ingest.read(spark, table, schema).filter("v <> 'a'").collect() == [(5, "c")]


def test_two_writers(spark, tmp_path, monkeypatch):
    """Of two that begin from one version the second to commit fails, and loses nothing of the first's."""
    schema, spec, table = "k long, v string", EntitySpec("things", ("k",)), f"{tmp_path}/table"
    batch = lambda *rows: spark.createDataFrame(rows, schema)
    ingest.merge_batch(spark, table, batch((1, "a")), schema, spec, 4, None, "one", 0)
    point = ingest._point

    def meanwhile(*a):
        monkeypatch.setattr(ingest, "_point", point)
        ingest.merge_batch(spark, table, batch((2, "b")), schema, spec, 4, None, "two", 0)
        point(*a)

    monkeypatch.setattr(ingest, "_point", meanwhile)
    with pytest.raises(Exception, match="exists|FileAlreadyExists"):
        ingest.merge_batch(spark, table, batch((3, "c")), schema, spec, 4, None, "one", 1)
    ingest.merge_batch(spark, table, batch((3, "c")), schema, spec, 4, None, "one", 1)
    assert sorted(map(tuple, ingest.read(spark, table, schema).collect())) == [(1, "a"), (2, "b"), (3, "c")]
    assert ingest.vacuum(spark, table, 3600) == 0 and ingest.vacuum(spark, table, -5) == 1  # of the try that failed
    assert sorted(map(tuple, ingest.read(spark, table, schema).collect())) == [(1, "a"), (2, "b"), (3, "c")]


def test_ingest_sequence(spark, tmp_path):
    schema = "k long, v string, at long"
    land, table = f"{tmp_path}/land", f"{tmp_path}/table"
    for rows in ([(1, "a", 1), (1, "b", 2), (None, "x", 1), (None, "y", 2)], [(1, "c", 3), (1, "c", 4), (1, "d", 5)]):
        spark.createDataFrame(rows, schema).repartition(3).write.mode("append").parquet(land)
        ingest.ingest(spark, land, schema, table, EntitySpec("things", ("k",), null_safe=False), f"{tmp_path}/check", seq="at")
    assert sorted(((r.k or 0), r.v, r.at) for r in ingest.read(spark, table, schema).collect()) == [(0, "x", 1), (0, "y", 2), (1, "d", 5)]
    log = spark.read.parquet(f"{table}_snapshots").filter("k = 1").collect()
    assert sorted(r.change_type for r in log) == ["new", "unchanged", "updated", "updated", "updated"]
    assert sorted(json.loads(r.snapshot_data)["v"] for r in log if r.change_type == "updated") == ["a", "b", "c"]


def test_ingest_without_sequence(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (1, "b")], "k long, v string").coalesce(1).write.parquet(f"{tmp_path}/land")
    with pytest.raises(Exception, match="differing rows"):
        ingest.ingest(spark, f"{tmp_path}/land", "k long, v string", f"{tmp_path}/table", EntitySpec("things", ("k",)), f"{tmp_path}/check")


def _row(*cells, tag="td"):
    return "<tr>" + "".join(f"<{tag}>{c}</{tag}>" for c in cells) + "</tr>"


def test_admission_and_plan_tables(spark):
    head = _row("专业", "科类", "批次", "最低分", "最低位次", "备注", tag="th")
    page = f"<table><tr><td>x</td></tr></table><table>{head}{_row('数学', '物理类', '本科提前批A段', '6,01', '12', '要求政审,其他')}{_row('', '', '本科批', '1', '1', '')}{_row('a', 'b')}</table>"
    df = spark.createDataFrame([(1, page), (2, None), (3, "")], "id long, html string")
    (r,) = page_tables.admission_table(df, "html", "id").collect()
    assert (r.major_name_raw, r.batch_code, r.batch_segment, r.min_score, r.min_rank, r.min_rank_source) == ("数学", "early", "A段", 601, 12, "official")
    assert r.political_review_requirement == "要求政审" and r.quality_flags == ["missing_admitted_count"]
    classed = f"<table>{_row('专业', '计划数', tag='th')}{_row('p', '1', 'q')}</table><table class='x plan-table'>{_row('专业名称', '批次', '计划数', tag='th')}{_row('化学', '本科批', '3人')}</table>"
    found = page_tables.plan_table(spark.createDataFrame([(1, classed)], "id long, html string"), "html", "id").collect()
    assert [(x.major_name, x.plan_count, x.batch_code) for x in found] == [("化学", 3, "regular")]


def test_third_party_table(spark):
    page = f"<table>{_row('above', '2020', 'x')}{_row('年份', '省份', '类别', '专业名称', '最低分', '平均分')}{_row('2023', '辽宁', '物理', '数学', '500', '498.8')}{_row('', '辽宁', '物理', '化学', '-', '-')}</table>"
    df = spark.createDataFrame([(1, page, "2021年分数")], "id long, html string, around string")
    rows = {r.major_name_raw: r for r in page_tables.third_party_table(df, "html", "id", "around").collect()}
    assert (rows["数学"].year, rows["数学"].avg_score, rows["数学"].subject_category) == (2023, 498, "物理类")
    assert (rows["化学"].year, rows["化学"].min_score, rows["化学"].batch) == (2021, None, "物理")


def test_segments(spark):
    page = f"<table>{_row('分数段(分)', '本段人数', '累计人数')}{_row('700-750', '3', '3')}{_row('699', 'x', '4')}</table><table class='segment-table'>{_row('600', 'x', '9')}</table>"
    df = spark.createDataFrame([(1, page)], "id long, html string")
    assert [(r.score, r.cumulative_count, r.category) for r in page_tables.segment_table(df, "html", "id", "理科").collect()] == [(700, 3, "理科")]
    assert [(r.score, r.segment_count, r.cumulative_count) for r in page_tables.legacy_segments(df, "html", "id").collect()] == [(600, 0, 9)]


def test_timeline(spark):
    page = f"<table>{_row('批次', '填报时段')}{_row('本科批', '6月26日8：00至6月28日18:00')}{_row('征集志愿')}{_row('专科批', '7月1日9时至12时')}{_row('高职', '7月1日9:00至12:00')}</table><table>{_row('别批', '8月1日9:00至12:00')}</table>"
    df = spark.createDataFrame([(1, page, 2024)], "id long, html string, y int")
    found = {r.batch: (str(r.start_time), str(r.end_time)) for r in page_tables.timeline_table(df, "html", "id", "y").collect()}
    assert found["本科批"] == ("2024-06-26 08:00:00", "2024-06-28 18:00:00")
    assert found["高职(征集志愿)"] == ("2024-07-01 09:00:00", "2024-07-01 12:00:00") and "别批" in found


def test_satisfaction(spark):
    texts = ['{"msg": {"schappraisalinfo": [{"type": "综合", "avgRank": "4.5", "count": 7}, {"type": "环境", "avgRank": "x"}]}}', '{"msg": []}', '{"msg": {"schappraisalinfo": [{"type": "生活", "avgRank": ""}]}}', None]
    (r,) = page_tables.satisfaction(spark.createDataFrame([(t,) for t in texts], "p string"), "p").collect()
    assert (r.overall_score, r.environment_score, r.life_score, r.vote_count) == (4.5, None, None, 7)
