"""Page layouts, the catalogue walk, the workbook source and heartbeats."""

import time

import pytest
from pyspark.sql import functions as F

from siftwell.operators import ledger
from siftwell.operators.merge import EntitySpec
from siftwell.sources import catalogue_walk, page_layouts, workbook_source, workbooks
from siftwell.streaming import heartbeat, ingest

DETAIL = """<title>t_x</title><div class="content-header"> 关注12 <b>8</b> 测试大学 </div>
<div class="content-introduction"> 简介 <span>211</span><span style="Display: none">985</span><span> 一流双一流 </span><div class="department x"><span>甲</span><span> 教育部 </span></div><div class='yxtx'><span>综合</span><span>师范</span></div></div>
<div class="yxxx-header-img"><p><img src="/a.png?x=1&amp;y=2"></div><span class="b yxszd"> 沈阳 </span><span class="txdz"></span><a class="gfwz" href=" https://x.cn ">w</a>
<div class="content-info-item">隶属于 <span>隶属于</span><span>辽宁省</span></div><div class="content-info-item"><span>别的</span></div>"""


def test_school_detail(spark):
    pages = spark.createDataFrame([(1, DETAIL), (2, "<p>nothing"), (3, None), (4, "")], "id long, html string")
    fields = page_layouts.page_fields(pages, "html", page_layouts.SCHOOL_DETAIL, ["id"])
    found = {r.field: r.value for r in fields.collect()}
    assert {r.id for r in fields.collect()} == {1}
    assert found == {
        "name": "测试大学", "is_211": "true", "is_double_first": "true", "logo_url": "/a.png?x=1&y=2", "introduction": "简介 211 985 一流双一流 甲 教育部 综合 师范",
        "authority": "辽宁省", "school_type": "综合 | 师范", "city": "沈阳", "website": "https://x.cn",
    }
    (row,) = page_layouts.as_columns(fields, ["id"], ["name", "city", "phone"]).collect()
    assert tuple(row) == (1, "测试大学", "沈阳", None)



def test_references_cut_off(spark):
    """A title cut off within a reference: its signs stay where only closed references count."""
    rules = [page_layouts.Rule("title", "title", "first"), page_layouts.Rule("link", "a", "attr", "href"), page_layouts.Rule("text", "p", "join", " ")]
    html = '<title>a &amp; b&&& c&amp</title><a href="?x=1&amp;y&lt=&copy">w</a><p>&lt;&#65;&#66 &amp;lt; &nosuch; &<script>a && b</script></p>'
    pages = spark.createDataFrame([(1, html)], "id long, html string")
    found = lambda **how: {r.field: r.value for r in page_layouts.page_fields(pages, "html", rules, ["id"], **how).collect()}
    assert found(closed=True) == {"title": "a & b&&& c&amp", "link": "?x=1&y&lt=&copy", "text": "<A&#66 &lt; &nosuch; & a && b"}
    assert found()["title"] == "a & b&&& c&" and found()["text"] == "<AB &lt; &nosuch; & a && b"
    assert [tuple(r) for r in spark.sql("SELECT f.* FROM VALUES (1) AS t(k), LATERAL page_fields('<title>a&amp</title>', '[[\"title\", \"title\", \"first\"]]') f").collect()] == [("title", 0, "a&")]


def test_other_layouts(spark):
    read = lambda rules, html: {(f, k): v for f, k, v in page_layouts.reader(rules)(html)}
    page = read(page_layouts.SCHOOL_PAGE, "<title>名_信息库</title><p class='sch-level-tag'>本科</p><p class='a sch-level-tag'>双一流</p>")
    assert page == {("name", 0): "名_信息库", ("level", 0): "本科", ("level", 1): "双一流"}
    long = "<div class='content zszc-content UEditor'>" + "<p>章程&nbsp;内容" * 20 + "</div><div>rest</div>"
    assert len(read(page_layouts.CHARTER, long)["content", 0]) == 20 * 5 + 19 and read(page_layouts.CHARTER, long.replace("章程&nbsp;内容", "x")) == {}
    table = "<table class='myd-detail-table'><tbody><tr><td>数<b>学</b></td><td><input type=hidden value=' 4.5 '>x</td></tr><tr><td></td><td>1</td></tr><tr><td>物理</td><td>4</td></tr><tr><td>化学</td></tr></tbody></table>"
    rows = page_layouts.major_satisfaction(spark.createDataFrame([(7, table)], "school_id int, html string"), "html", ["school_id"])
    assert sorted(map(tuple, rows.collect()), key=str) == [(7, "数学", 4.5), (7, "物理", None)]


def test_catalogue_walk(spark):
    flat = [("本科", "05", '{"flag": true, "msg": [{"key": "A", "name": "工学"}, {"key": "", "name": "x"}, 7, null]}')]
    mid = [("A", '{"flag": 1, "msg": [{"key": "A1", "name": "机械类"}]}'), ("B", '{"flag": "", "msg": []}'), ("C", None), ("D", "[1]"), ("E", "nope")]
    leaf = [("A1", '{"flag": true, "msg": [{"zydm": " 080201 ", "zymc": "机械工程", "specId": 73, "zymyd": "4.2"}, {"zydm": "2", "zymc": "乙", "zymyd": "0.0"}, {"zydm": "3"}]}'), ("Z", '{"flag": true, "msg": [{"zydm": "9", "zymc": "no path"}]}'), ("Y", '{"flag": true, "msg": {"a": 1}}')]
    found, bad = catalogue_walk.walk(spark.createDataFrame(flat, "education_level string, key string, payload string"), *(spark.createDataFrame(x, "key string, payload string") for x in (mid, leaf)))
    assert sorted((r.code, r.name, r.source_id, r.satisfaction, r.category, r.subcategory, r.education_level) for r in found.collect()) == [("080201", "机械工程", "73", "4.2", "工学", "机械类", "本科"), ("2", "乙", None, None, "工学", "机械类", "本科")]
    assert {(r.level, r.key, r.reason) for r in bad.collect()} == {("subcategories", "B", "no flag"), ("subcategories", "C", "empty"), ("subcategories", "D", "no flag"), ("subcategories", "E", "no JSON"), ("majors", "Y", "no list")}


def test_workbook_source(spark, tmp_path):
    workbook_source.register(spark)
    for name, n in (("a", 5), ("b", 2)):
        workbooks.write(spark.range(n).select(F.col("id").alias("k"), F.lit("x").alias("v")), f"{tmp_path}/{name}.xlsx", ["k"])
    df = spark.read.format("workbook").load(str(tmp_path))
    assert df.schema.simpleString() == "struct<path:string,row_no:int,cells:array<string>>" and df.rdd.getNumPartitions() == 2
    want = sorted((r.path.rsplit("/", 1)[1], r.row_no, r.cells) for r in workbooks.read(spark, str(tmp_path)).collect())
    assert sorted((r.path.rsplit("/", 1)[1], r.row_no, r.cells) for r in df.collect()) == want
    again = spark.read.format("workbook").option("rowsPerTask", "2").load(f"file://{tmp_path}")
    assert sorted((r.path.rsplit("/", 1)[1], r.row_no, r.cells) for r in again.collect()) == want
    assert workbooks.baseline_rows(df, 3).count() == 7
    with pytest.raises(Exception, match="path"):
        spark.read.format("workbook").load().count()


def test_heartbeat(spark, tmp_path):
    beat = heartbeat.Heartbeat(spark, f"{tmp_path}/ledger", "things", seconds=0)
    spark.streams.addListener(beat)
    try:
        spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string").write.parquet(f"{tmp_path}/land")
        run = ingest.ingest(spark, f"{tmp_path}/land", "k long, v string", f"{tmp_path}/table", EntitySpec("things", ("k",)), f"{tmp_path}/check")
        rows = lambda: heartbeat.ledger_rows(spark, f"{tmp_path}/ledger").filter(F.col("task_id") == str(run.runId)).collect()
        for _ in range(60):
            if (tmp_path / "ledger").exists() and any(r.status == "success" for r in rows()):
                break
            time.sleep(0.5)
        found = rows()
        assert sum(r.status == "running" for r in found) >= 2 and max(r.total for r in found) == 2
        last = ledger.recent(heartbeat.ledger_rows(spark, f"{tmp_path}/ledger"), 1, "things").collect()[0]
        assert (last.status, last.total, last.error) == ("success", 2, None)
        assert ledger.stable(heartbeat.ledger_rows(spark, f"{tmp_path}/ledger"), "things")
    finally:
        spark.streams.removeListener(beat)


def test_heartbeat_of_a_failure(spark, tmp_path):
    beat = heartbeat.Heartbeat(spark, f"{tmp_path}/ledger", seconds=3600)
    for k in range(3):  # two of these fall into the interval
        beat.beat("run", f"2024-01-01T00:{k:02d}:00.000Z", 5)
    rows = heartbeat.ledger_rows(spark, f"{tmp_path}/ledger").collect()
    assert [(r.status, r.total) for r in rows] == [("running", 5)]
    beat.note("run", "failed", heartbeat.Heartbeat.moment("2024-01-01T01:00:00Z"), "SOME_CLASS")
    assert not ledger.stable(heartbeat.ledger_rows(spark, f"{tmp_path}/ledger"), "stream")
