import pytest

from siftwell.__main__ import main
from siftwell.plans import phases
from siftwell.sources import workbooks


def test_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(2, "b<&>", None, "https://x.example/?a=1&b"), (1, "院校\x01", 1.5, None)], "k int, name string, v double, link string")
    assert workbooks.write(df, f"{tmp_path}/a.xlsx", ["k"], [("one", 2), ("two", 2)], "link") == 2
    rows = {r.row_no: r.cells for r in workbooks.read(spark, str(tmp_path)).collect()}
    assert rows == {1: ["one", None, "two"], 2: ["k", "name", "v", "link"], 3: ["1", "院校", "1.5"], 4: ["2", "b<&>", None, "https://x.example/?a=1&b"]}
    assert not list(tmp_path.glob("*.part"))
    base = workbooks.baseline_rows(workbooks.read(spark, str(tmp_path)), 5)
    assert sorted(r.cells[0] for r in base.collect()) == ["1", "2"] and all(len(r.cells) == 5 for r in base.collect())


def test_reference_list(spark):
    rows = spark.createDataFrame([("p", 1, ["t"] * 4), ("p", 3, ["n", " a ", "x", None]), ("p", 4, ["n", "a", "y", "c"]), ("p", 5, ["n"])], "path string, row_no int, cells array<string>")
    assert [tuple(r) for r in workbooks.reference_list(rows, 1, 2, 3).collect()] == [("a", "x", "")]


def test_column_names():
    assert [workbooks.column_name(i) for i in (0, 25, 26, 64, 701, 702)] == ["A", "Z", "AA", "BM", "ZZ", "AAA"]


def test_too_many_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workbooks, "MOST_ROWS", 3)
    with pytest.raises(ValueError):
        workbooks.write(spark.range(2), f"{tmp_path}/a.xlsx", ["id"])
    assert not list(tmp_path.iterdir())


def test_stages():
    def task(name):
        if name == "majors":
            raise RuntimeError("secret")
        return 0

    out = phases.run_stages([phases.CORE, phases.ASSOCIATIONS], task)
    assert (out.total, out.failed, out.skipped, out.errors) == (4, 1, (1,), ("majors: RuntimeError",)) and not out.successful
    assert phases.run_stages([phases.CORE, phases.ASSOCIATIONS], lambda n: 0).successful


def test_command_line(spark, tmp_path, capsys):
    assert main(["list"]) == 0 and "schools_view" in capsys.readouterr().out
    assert main(["export", "schools_view", "/root/testdata/sf0.001", f"{tmp_path}/s.xlsx"]) == 0
    assert workbooks.read(spark, str(tmp_path)).filter("row_no > 2").count() == 10
