"""Queries of ordered scans, of names in texts and of streams."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import functions as F

from siftwell.operators import joins, scan
from siftwell.operators.merge import EntitySpec
from siftwell.operators.rounds import checkpoint_dir
from siftwell.plans.adapters import t
from siftwell.plans.registry import query
from siftwell.streaming import ingest

_LINES = """l AS (SELECT CASE WHEN l_suppkey % 3 = 0 THEN 0 ELSE l_suppkey END k, CAST(floor(l_extendedprice) AS BIGINT) x, l_orderkey o, CAST(l_linenumber AS BIGINT) n, CASE WHEN l_quantity > 40 THEN l_partkey END v FROM lineitem)"""


def _lines(s, d):
    """One key has a third of all rows."""
    return t(s, d, "lineitem").select(
        F.when(F.col("l_suppkey") % 3 == 0, 0).otherwise(F.col("l_suppkey")).alias("k"), F.floor("l_extendedprice").cast("bigint").alias("x"), F.col("l_orderkey").alias("o"),
        F.col("l_linenumber").cast("bigint").alias("n"), F.when(F.col("l_quantity") > 40, F.col("l_partkey")).alias("v"),
    )


@query(f"""WITH {_LINES}, p AS (SELECT k, x, max(v) v FROM l WHERE v IS NOT NULL GROUP BY ALL) SELECT l.k, l.o, l.n, p.v AS found FROM l ASOF LEFT JOIN p ON l.k = p.k AND l.x >= p.x""")
def asof_floor_in_segments(s, d):
    """As-of join of a million probes and points without lists of points: the bound is 0."""
    lines = _lines(s, d)
    points = lines.filter("v IS NOT NULL").groupBy("k", "x").agg(F.max("v").alias("v"))
    return joins.asof_floor(lines.select("k", "x", "o", "n"), points, ["k"], "x", "v", "found", most=0).select("k", "o", "n", "found")


@query(f"""WITH {_LINES} SELECT k, o, n, last_value(v IGNORE NULLS) OVER (PARTITION BY k ORDER BY x, o, n, v ROWS UNBOUNDED PRECEDING) AS carried FROM l""")
def carry_forward_in_segments(s, d):
    return scan.carry_forward(_lines(s, d), ["k"], [F.col(c).asc() for c in ("x", "o", "n")] + [F.col("v").asc_nulls_last()], F.col("v"), "carried").select("k", "o", "n", "carried")


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS place FROM orders")
def number_in_segments(s, d):
    return scan.number(t(s, d, "orders").select("o_orderkey", "o_totalprice"), [], [F.col("o_totalprice").asc(), F.col("o_orderkey").asc()], "place").select("o_orderkey", F.col("place").cast("bigint").alias("place"))


#: Names that texts surely hold: the first and the second word of each document, and the two together.
_DOC_NAMES = r"SELECT DISTINCT unnest([w[1], w[2], w[1] || ' ' || w[2]]) AS nm FROM (SELECT string_split(substr(text, 1, 200), ' ') AS w FROM documents) WHERE w[2] IS NOT NULL"


def _documents_and_names(s, d):
    docs = t(s, d, "documents").select("doc_id", "text")
    w = F.split(F.substr("text", F.lit(1), F.lit(200)), " ")
    names = docs.select(w.alias("w")).filter(F.size("w") > 1).select(F.explode(F.array(F.col("w")[0], F.col("w")[1], F.concat_ws(" ", F.col("w")[0], F.col("w")[1]))).alias("nm"))
    return docs, names


@query(f"""WITH n AS ({_DOC_NAMES}) SELECT doc_id, (SELECT min(nm) FROM n WHERE length(nm) > 0 AND contains(text, nm) AND length(nm) = (SELECT max(length(nm)) FROM n WHERE contains(text, nm))) AS found FROM documents""")
def names_in_texts(s, d):
    docs, names = _documents_and_names(s, d)
    return joins.contained(docs, "text", names, "nm", "found", keep=["doc_id"])


@query(f"""WITH n AS ({_DOC_NAMES}) SELECT doc_id, (SELECT arg_min(nm, strpos(text, nm) * 100000 - length(nm)) FROM n WHERE length(nm) > 0 AND contains(text, nm)) AS found FROM documents""")
def first_name_in_texts(s, d):
    docs, names = _documents_and_names(s, d)
    return joins.contained(docs, "text", names, "nm", "found", "first", keep=["doc_id"])


#: Three waves of files: a key of the second may be new, changed or as it was; the third changes a third of the table.
_WAVES = ["y <= 1997", "y BETWEEN 1997 AND 1999", "o_orderkey % 3 = 0"]
_VALUES = ["o_orderstatus", "CASE WHEN o_orderkey % 4 = 0 THEN 'X' ELSE o_orderstatus END", "CASE WHEN o_orderkey % 2 = 0 THEN 'Y' ELSE o_orderstatus END"]


@query(f"""WITH o AS (SELECT *, year(o_orderdate) y FROM orders), w AS ({" UNION ALL ".join(f"SELECT CAST({i} AS BIGINT) AS batch, o_orderkey, {v} AS status FROM o WHERE {c}" for i, (c, v) in enumerate(zip(_WAVES, _VALUES)))}),
k AS (SELECT *, lag(status) OVER (PARTITION BY o_orderkey ORDER BY batch) AS was, row_number() OVER (PARTITION BY o_orderkey ORDER BY batch) AS time FROM w)
SELECT batch, CASE WHEN time = 1 THEN 'new' WHEN was = status THEN 'unchanged' ELSE 'updated' END AS change_type, count(*) AS n FROM k GROUP BY ALL
UNION ALL SELECT NULL, status, count(*) FROM (SELECT o_orderkey, arg_max(status, batch) AS status FROM w GROUP BY 1) GROUP BY ALL""")
def stream_ingest_counts(s, d):
    """Changes by batch that a stream over landing files logs, and the rows of the table after it by status."""
    top = f"{checkpoint_dir(s)}/ingest-{uuid.uuid4().hex}"
    jvm = s.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(top)
    files = path.getFileSystem(s.sparkContext._jsc.hadoopConfiguration())
    files.deleteOnExit(path)
    schema, spec = "o_orderkey long, status string", EntitySpec("orders", ("o_orderkey",))
    orders = t(s, d, "orders").withColumn("y", F.year("o_orderdate"))
    for where, value in zip(_WAVES, _VALUES):
        orders.filter(where).select("o_orderkey", F.expr(value).alias("status")).write.mode("append").parquet(f"{top}/land")
        ingest.ingest(s, f"{top}/land", schema, f"{top}/table", spec, f"{top}/check", files_per_trigger=1_000_000, buckets=int(s.conf.get("spark.sql.shuffle.partitions")))
    log = s.read.parquet(f"{top}/table_snapshots").groupBy(F.col("batch").cast("bigint").alias("batch"), "change_type").agg(F.count("*").alias("n"))
    after = ingest.read(s, f"{top}/table", schema).groupBy(F.col("status").alias("change_type")).agg(F.count("*").alias("n"))
    return log.unionByName(after.withColumn("batch", F.lit(None).cast("bigint")))
