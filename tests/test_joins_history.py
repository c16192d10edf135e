"""Joins and the baseline merge against plain Python."""

import random
import time

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siftwell.operators import joins, name_index, scan
from siftwell.plans import catalogue, history


def test_asof_floor(spark):
    rng = random.Random(1)
    points = [(rng.choice(["a", "b", None]), rng.choice([None, *range(20)]), rng.choice([None, *range(9)])) for _ in range(60)]
    probes = [(i, rng.choice(["a", "b", "c", None]), rng.choice([None, *range(-2, 25)])) for i in range(200)]
    p, q = spark.createDataFrame(points, "k string, x int, v int"), spark.createDataFrame(probes, "i int, k string, x int")

    def floor(k, x):
        held = [(y, v) for j, y, v in points if j == k and y is not None and v is not None and x is not None and y <= x]
        return max(held)[1] if held else None

    want = sorted((i, floor(k, x)) for i, k, x in probes)
    for most in (1000, 0):  # lists, and sorted together
        assert sorted((r.i, r.out) for r in joins.asof_floor(q, p, ["k"], "x", "v", "out", most).collect()) == want


NAMES = ["ab", "abc", "b", "bcd", "zz", "学", "大学", "", None]
TEXTS = [(0, "xabcd"), (1, "b"), (1, "xab"), (1, "zcd zz"), (2, ""), (3, None), (4, "北京大学"), (5, "zzab"), (6, "q"), (6, "q"), (7, "c"), (7, "bc")]


@pytest.mark.parametrize("most", [1 << 20, 0])
def test_contained(spark, most):
    """By automaton and by join; rows that share an id, or are alike, each for themselves."""
    texts, names = spark.createDataFrame(TEXTS, "i int, t string"), spark.createDataFrame([(n,) for n in NAMES], "n string")
    hits = lambda t: [n for n in NAMES if n and t and n in t]
    want = {"longest": lambda t: min(hits(t), key=lambda n: (-len(n), n), default=None), "first": lambda t: min(hits(t), key=lambda n: (t.index(n), -len(n)), default=None)}
    for which, best in want.items():
        got = [(r.i, r.t or "", r.found or "") for r in joins.contained(texts, "t", names, "n", "found", which, most).collect()]
        assert sorted(got) == sorted((i, t or "", best(t) or "") for i, t in TEXTS)
    assert {r.found for r in joins.contained(texts, "t", names.limit(0), "n", "found", most=most).collect()} == {None}
    assert joins.contained(texts.limit(0), "t", names, "n", "found", most=most).count() == 0


def test_contained_either_way(spark):
    got = joins.contained_either_way(spark.createDataFrame(TEXTS, "i int, t string"), "t", spark.createDataFrame([(n,) for n in NAMES], "n string"), "n", "found").collect()
    assert len(got) == len(TEXTS)
    found = {r.t: r.found for r in got}
    assert (found["c"], found["bc"], found["q"], found["xab"], found[""]) == ("abc", "b", None, "ab", None)


def test_contained_in_a_long_text(spark):
    began = time.time()
    text = spark.range(1).select(F.concat(F.repeat(F.lit("ab"), 500_000), F.lit("c")).alias("t"))
    names = spark.createDataFrame([("a" * k + "b",) for k in range(1, 300)] + [("abc",)], "n string")
    assert joins.contained(text, "t", names, "n", "found").collect()[0].found == "abc" and time.time() - began < 60


def test_scans_in_segments(spark):
    """One key has most rows; it lies in several segments."""
    rng = random.Random(7)
    rows = [(rng.choice(["hot"] * 6 + ["a", "b", None]), i if rng.random() < 0.9 else None, rng.choice([None, None, i])) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, x int, v int").repartition(5)
    order = [F.col("x").asc_nulls_first(), F.col("v").asc_nulls_first()]
    dealt, _ = scan._dealt(df, ["k"], order, 6)
    assert dealt.filter("k = 'hot'").select("_segment").distinct().count() > 2
    place = lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or 0)
    want, numbers = [], []
    for key in {r[0] for r in rows}:
        last = None
        for n, r in enumerate(sorted((r for r in rows if r[0] == key), key=place)):
            last = last if r[2] is None else r[2]
            want.append((*r, last))
            numbers.append((*r, n + 1))
    key = lambda r: tuple((x is not None, x or 0) if not isinstance(x, str) else (True, x) for x in r)
    got = scan.carry_forward(df, ["k"], order, F.col("v"), "last", 6).select("k", "x", "v", "last").collect()
    assert sorted(map(key, map(tuple, got))) == sorted(map(key, want))
    got = scan.number(df, ["k"], order, "n", 6).select("k", "x", "v", "n").collect()
    assert sorted((key(r[:3]), r[3]) for r in map(tuple, got)) == sorted((key(r[:3]), r[3]) for r in numbers)
    every = scan.number(df, [], order, "n", 6)
    assert sorted(r.n for r in every.collect()) == list(range(1, 401)) and scan.number(df.limit(0), [], order, "n").count() == 0
    assert scan.carry_forward(df.limit(0), ["k"], order, F.col("v"), "last").count() == 0


def test_merge_baseline(spark):
    rng = random.Random(2)
    base = [(i, f"s{rng.randint(0, 4)}", rng.choice(["1", "2"]), rng.choice(["m", "n"]), "old", i) for i in range(60)]
    made = [(i, f"s{rng.randint(0, 5)}", rng.choice(["1", "2"]), rng.choice(["m", "n"]), f"new{i}") for i in range(70)]
    merged, taken = [list(r) for r in base], set()
    for g in made:
        for key in ((1, 2), (1, 3)):
            held = [i for i, b in enumerate(base) if i not in taken and all(b[c] == g[c] for c in key)]
            if len(held) == 1:
                taken.add(held[0])
                merged[held[0]][4] = g[4]
                break
        else:
            merged.append([*g, None])
    out = history.merge_baseline(spark.createDataFrame(made, "pos int, school string, code string, name string, v string"), spark.createDataFrame(base, "pos int, school string, code string, name string, v string, x int"), ["school", "code"], ["school", "name"], ["v"], ["pos"])
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(repr(tuple(r)) for r in merged)


def test_batch_score(spark):
    def score(p, h):
        (pc, ps, pt), (hc, hs, ht) = p, h
        if pc and hc:
            return -1 if pc != hc or (ps and hs and ps != hs) else 4 if (ps or "") == (hs or "") else 3
        return 0 if not pt or not ht else 2 if pt == ht else -1

    values = [(c, s, t) for c in (None, "", "early", "regular") for s in (None, "", "A", "B") for t in (None, "", "x", "y")]
    rows = [(*p, *h, score(p, h)) for p in values for h in values]
    df = spark.createDataFrame(rows, "pc string, ps string, pt string, hc string, hs string, ht string, want int")
    found = history.batch_score(*({k: F.col(side + k[0]) for k in ("code", "segment", "text")} for side in "ph"))
    assert df.filter(~found.eqNullSafe(F.col("want"))).count() == 0


def test_priority_is_a_weight(spark, tmp_path):
    """As its SQL has it: beyond 10^12 / 10^5 orders a later order outweighs a return, beyond 10^5 parts a part an order."""
    lines = [(1, 10, 3, "R"), (1, 10_000_020, 4, "N"), (2, 5, 250_000, "N"), (2, 6, 1, "N"), (3, 1, 7, "R"), (3, 9, 8, "N"), (4, 2, 9, None)]
    spark.createDataFrame(lines, "l_suppkey long, l_orderkey long, l_partkey long, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = sorted(map(tuple, catalogue.QUERIES["priority_pick"](spark, str(tmp_path)).collect()))
    sql = catalogue.SQL["priority_pick"].replace("lineitem", f"'{tmp_path}/lineitem.parquet/*.parquet'")
    assert got == sorted(duckdb.sql(sql).fetchall()) == [(1, 4), (2, 250_000), (3, 7), (4, 9)]


@pytest.mark.parametrize("which", ["longest", "first"])
def test_contained_by_several_automata(spark, which):
    """Groups of names, the longest of which is more than a group, take turns at the texts; the best of all groups stays."""
    rng = random.Random(3)
    names = {"".join(rng.choice("ab学") for _ in range(rng.randint(1, 9))) for _ in range(80)}
    texts = [(i, "".join(rng.choice("ab学c") for _ in range(rng.randint(0, 60)))) for i in range(300)]
    groups = joins.name_groups(sorted(names), 16)
    assert len(groups) > 5 and [n for g in groups for n in g.split("\0")] == sorted(names) and all(len(g.encode()) < 16 or "\0" not in g for g in groups)
    key = (lambda t, n: (-len(n), n)) if which == "longest" else (lambda t, n: (t.index(n), -len(n)))
    want = sorted((i, min((n for n in names if n in t), key=lambda n: key(t, n), default="")) for i, t in texts)
    asked, held = spark.createDataFrame(texts, "i int, t string"), spark.createDataFrame([(n,) for n in names], "n string")
    assert sorted((r.i, r.found or "") for r in joins.contained(asked, "t", held, "n", "found", which, group=16).collect()) == want


def test_history_match_carries_little_to_its_choice(spark):
    """What goes to a plan and year is what the choice needs; items meet the few suppliers of a province before the orders."""
    import __spark_entry__

    def nodes(plan):
        yield plan
        for i in range(plan.children().size()):
            yield from nodes(plan.children().apply(i))

    plan = __spark_entry__.queries()["history_match"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan()
    windows = [n for n in nodes(plan) if n.nodeName() == "Window"]
    assert windows and max(n.output().size() for n in windows) <= 16
    joins = [n for n in nodes(plan) if n.nodeName() == "Join" and "o_orderkey" in n.condition().toString()]
    assert joins and all("s_suppkey" in n.children().apply(0).toString() for n in joins)


@pytest.mark.parametrize("which", ["longest", "first"])
@pytest.mark.parametrize("alike", [False, True])
def test_name_index_is_exact(monkeypatch, which, alike):
    """Names of all lengths, over steps of a few bytes and several indexes; also where all hashes are alike, so that only bytes tell."""
    rng = random.Random(5)
    names = {"".join(rng.choice("aé学😀") for _ in range(rng.choice([1, 2, 3, 7, 20, 90, 200]))) for _ in range(40)}
    texts = [None, "", *("".join(rng.choice([*sorted(names), "x", "\0", "a"]) for _ in range(rng.randint(0, 5))) for _ in range(60))]
    texts += [t[1:-1] for t in texts if t]
    if alike:
        monkeypatch.setattr(name_index, "_BYTES", name_index._BYTES * 0)
    monkeypatch.setattr(name_index, "STEP_BYTES", 64)
    monkeypatch.setattr(name_index, "BEGINNING", 5)
    asked, before = name_index.Texts(pa.array(texts), which == "longest"), 0
    for group in joins.name_groups(sorted(names, key=lambda n: (-len(n), n)), 2000):
        index = name_index.NameIndex(group.encode())
        asked.look_up(index, before)
        before += index.start.size
    key = (lambda t, n: (-len(n), n)) if which == "longest" else (lambda t, n: (t.index(n), -len(n)))
    assert before == len(names) and list(asked.found) == [min((n for n in names if t and n in t), key=lambda n: key(t, n), default=None) for t in texts]


def test_contained_among_many_names(spark):
    """More than 16 MB of names are looked up where the texts are: texts are not cut into pieces, nor dealt anew."""
    names = spark.range(1_300_000).select(F.concat(F.lit("n"), F.lpad(F.col("id").cast("string"), 12, "0")).alias("n"))
    texts = spark.range(0, 1_400_000, 7000).select("id", F.concat(F.lit("x n"), F.lpad(F.col("id").cast("string"), 12, "0"), F.lit("9")).alias("t"))
    found = joins.contained(texts, "t", names, "n", "found", keep=["id"])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Generate" not in plan
    assert sorted(map(tuple, found.collect())) == [(i, f"n{i:012}" if i < 1_300_000 else None) for i in range(0, 1_400_000, 7000)]
