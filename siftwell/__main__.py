"""Command line of the offline half (M-24): python -m siftwell list | show QUERY DIR | export QUERY DIR FILE.xlsx | audit DIR,
and over a folder of stored tables (NAME.parquet) audit-years DIR -p PROVINCE -y YEAR... and audit-majors DIR -p PROVINCE --plan-year YEAR."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from siftwell.functions.dates import normalize_years
from siftwell.plans import audits, catalogue
from siftwell.plans.adapters import t
from siftwell.session import session
from siftwell.sources import workbooks

#: Queries that the audit reports.
AUDITS = ["year_coverage", "year_plan_gaps", "readiness_summary", "match_diagnostics", "signal_diagnostics"]


#: Tables that the audits of a folder read.
STORED = ["provinces", "schools", "majors", audits.PLANS, audits.RESULTS, audits.TAUGHT, audits.SIGNALS]


def _audit(spark: SparkSession, a: argparse.Namespace) -> dict:
    tables = {name: t(spark, a.dir, name) for name in STORED}
    years = normalize_years(a.year, dt.date.today())
    if a.command == "audit-years":
        return {"year_coverage": audits.year_coverage(tables, a.province, years).orderBy("year"), "plan_gaps": audits.plan_gaps(tables, a.province, years, a.limit)}
    scope = (a.subject, a.batch)
    ready = audits.readiness(tables, a.province, a.plan_year, years, *scope)
    return {
        "summary": audits.readiness_summary(ready), "matches": audits.match_diagnostics(tables, a.province, a.plan_year, years, *scope),
        "strength": audits.strength_diagnostics(tables, a.province, a.plan_year, *scope), "gaps": audits.readiness_gaps(ready, a.limit),
    }


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser("siftwell")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("list")
    for name in ("show", "export"):
        q = sub.add_parser(name)
        q.add_argument("query", choices=sorted(catalogue.QUERIES))
        q.add_argument("dir")
        if name == "export":
            q.add_argument("file")
        else:
            q.add_argument("--rows", type=int, default=20)
    sub.add_parser("audit").add_argument("dir")
    for name in ("audit-years", "audit-majors"):
        q = sub.add_parser(name)
        q.add_argument("dir")
        q.add_argument("--province", "-p", required=True, help="code or name")
        q.add_argument("--year", "-y", type=int, action="append", help="a year to ask for; several times (the last three by default)")
        q.add_argument("--limit", "-n", type=int, default=50)
        if name == "audit-majors":
            q.add_argument("--plan-year", type=int, required=True)
            q.add_argument("--subject", type=int)
            q.add_argument("--batch")
    a = p.parse_args(argv)
    if a.command == "list":
        print("\n".join(sorted(catalogue.QUERIES)))
        return 0
    spark = spark or session()
    if a.command in ("audit-years", "audit-majors"):
        for name, found in _audit(spark, a).items():
            print(name)
            found.show(a.limit, truncate=False)
        return 0
    if a.command == "audit":
        for name in AUDITS:
            print(name)
            catalogue.QUERIES[name](spark, a.dir).show(truncate=False)
        return 0
    df = catalogue.QUERIES[a.query](spark, a.dir)
    if a.command == "show":
        df.show(a.rows, truncate=False)
    else:
        print(workbooks.write(df, a.file, df.columns))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
