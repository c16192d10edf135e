import glob
import os
import re

import duckdb
import pytest

from siftwell.functions import security
from siftwell.plans import audit_queries, catalogue, claim_queries, export_queries, scan_queries, source_queries  # noqa: F401

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{D}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_as_sql(spark, duck, name):
    out = catalogue.QUERIES[name](spark, D)
    rows = sorted(repr(tuple(r[c] for c in sorted(out.columns))) for r in out.collect())
    if name in catalogue.SQL:
        found = duck.sql(catalogue.SQL[name])
        names = [x[0] for x in found.description]
        assert sorted(names) == sorted(out.columns)
        assert rows == sorted(repr(tuple(r[names.index(c)] for c in sorted(names))) for r in found.fetchall())


def test_whole_tables(spark, duck):
    out = catalogue.QUERIES["cdc_in_batch_sequence"](spark, D)
    assert out.count() == duck.sql("SELECT count(*) FROM lineitem").fetchall()[0][0] and out.filter("k % 2 = 1").count() > 0


def test_redact_whole(spark):
    def brute(x):
        for p in security.SENSITIVE:
            x = re.sub(p, security.MARKER, x, flags=re.ASCII)
        return x

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{D}/documents.parquet").collect()}
    got = {r.doc_id: r.safe for r in catalogue.QUERIES["redact_text"](spark, D).collect()}
    assert got == {k: x and brute(x) for k, x in docs.items()}
    secrets = ["Authorization: Bearer abc.def", "bearer abc", "jwt ab.cd", "eyJab.cd", "api_key=xyz", "11010119900101123X", "12345678901", "a@b.co", "+86-13912345678"]
    assert all("abc" not in r.safe and security.MARKER in r.safe for r in spark.createDataFrame([(x,) for x in secrets], "text string").select(security.redact("text").alias("safe")).collect())
