from siftwell.sources import links


def test_links_and_majors(spark):
    page = "<div class='major-list'><a class='major-link' data-code='0701' href='/m?specId=9&x=1'> 数学 <b>国家级一流本科专业</b></a><a class='major-link' href=''>化学</a></div><a href='/z'>z</a><script>var a = '<a href=x>';</script>"
    df = spark.createDataFrame([(1, page), (2, None), (3, "")], "id long, html string")
    assert links.links(df, "html", "id").count() == 3
    a, b = links.major_links(df, "html", "id").orderBy("display_order").collect()
    assert (a.display_order, a.name, a.source_id, a.data_code, a.signal_level, a.strength_score) == (1, "数学", "9", "0701", "national", 100)
    assert (b.name, b.href, b.signal_type) == ("化学", None, None)


def test_article(spark):
    page = "<div class='content'> </div><div class='article'>短</div><div id='article'>正<p>文</p>&nbsp;a<script>no</script></div>"
    df = spark.createDataFrame([(1, page), (2, "<p>x</p>")], "id long, html string")
    assert [tuple(r) for r in links.article(df, "html", "id", [".content", ".article", "#article"], 3).collect()] == [(1, "短")]
    (r,) = links.article(df, "html", "id", [".content", ".article", "#article"], 3, 2).collect()
    assert r.content == "正 文"


def test_announcements(spark):
    page = "<a href='/a/1.html'>2024年招生公告 2024-05-01</a><a href='/a/1.html'>招生</a><a href='https://evil.example/x'>招生</a><a href='/b'>about</a>"
    df = spark.createDataFrame([(1, page)], "id long, html string")
    (r,) = links.announcements(df, "html", "id", "https://ok.example", ["OK.example"]).collect()
    assert (r.url, r.pos, r.date_text) == ("https://ok.example/a/1.html", 0, "2024-05-01")


def test_index_targets(spark):
    page = "<a href='/1'>2024年辽宁一分一段表</a><a href='/1'>2024年辽宁一分一段表</a><a href='/2'>2019年辽宁一分一段表</a><a href='/3'>2024年某地一分一段表</a>"
    provinces = spark.createDataFrame([(1, "辽宁"), (2, "宁")], "id long, name string")
    found = links.index_targets(spark.createDataFrame([(1, page)], "id long, html string"), "html", "id", provinces, [2023, 2024]).collect()
    assert [(r.href, r.province_name, r.year) for r in found] == [("/1", "辽宁", 2024)]


def test_timeline_text(spark):
    body = "旧批填报时间：6月1日9:00至12:00\n2023年志愿填报时间\n其中本科批填报时间：6月26日8:00至6月28日18:00。高考填报时间：6月1日9:00至12:00\n专科批填报时间：不详"
    df = spark.createDataFrame([(1, body, 2024), (2, "本科批填报时间:6月26日8:00至9:00", 2022)], "id long, body string, y int")
    found = {r.id: (r.batch, str(r.start_time)) for r in links.timeline_text(df, "id", "body", "y").collect()}
    assert found == {1: ("本科批", "2023-06-26 08:00:00"), 2: ("本科批", "2022-06-26 08:00:00")}


def test_catalogues(spark):
    p = '{"data": {"special": [{"special": [{"special_id": 1, "special_name": "数学", "nation_feature": "1", "xueke_rank": "0", "ruanke_rank": "3"}]}, 5], "1": [{"id": "1", "name": "again"}, {"name": "化学"}], "special_detail": {"2": [{"id": 7, "special_name": "物理", "nation_feature": "2"}]}}}'
    df = spark.createDataFrame([(1, p), (2, '{"data": []}'), (3, None)], "id long, p string")
    rows = {r.item_name: r for r in links.specials(df, "p", "id").collect()}
    assert set(rows) == {"数学", "化学", "物理"}
    assert rows["数学"].is_featured_major and rows["数学"].major_strength_rank == 3 and [e.type for e in rows["数学"].strength_evidence] == ["nation_feature", "ruanke_rank"]
    assert not rows["物理"].is_featured_major and rows["物理"].strength_evidence == []
    d = spark.createDataFrame([('{"msg": {"zyjs": {"versionDesc": " d "}, "jyfxInfo": {"jyfxList": [{"jyfx": "a"}, {"jyfx": ""}, {"jyfx": "b"}]}, "xlcc": "本科"}}',)], "p string")
    (r,) = links.major_details(d, "p").collect()
    assert (r.description, r.graduate_directions, r.degree) == ("d", "a、b", "本科")
