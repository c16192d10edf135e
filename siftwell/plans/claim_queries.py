"""Queries of catalogues that claim names and ids in order; their SQL walks row by row."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftwell.functions import hashing
from siftwell.operators import claims
from siftwell.plans.adapters import t
from siftwell.plans.registry import query

#: The stored catalogue (parts) and the index (customers), the same for both engines: names and ids meet in all ways.
_HELD = """SELECT p_partkey AS id, concat(' N', CAST(p_partkey % 600 AS STRING)) AS name, CASE WHEN p_partkey % 4 = 1 THEN 50000 + p_partkey WHEN p_partkey % 4 = 2 AND p_partkey < 900 THEN p_partkey * 7 % 900 * 1000000 + 1 WHEN p_partkey % 8 = 3 THEN p_partkey % 600 ELSE -p_partkey END AS sch_id,
CASE WHEN p_partkey % 5 = 0 THEN p_partkey WHEN p_partkey % 35 = 4 THEN p_partkey % 600 * 3 + 1000000 END AS external_id, CASE WHEN p_partkey % 16 = 1 THEN 1 END AS crawl_task_id, p_partkey % 8 = 3 AS bare FROM part"""
_INDEX = """SELECT c_custkey AS ordinal, CASE WHEN c_custkey % 31 = 0 THEN ' ' ELSE concat('N', CAST(c_custkey * 13 % 700 AS STRING), ' ') END AS name,
CASE WHEN c_custkey % 37 = 0 THEN 'x' WHEN c_custkey % 41 = 0 THEN NULL WHEN c_custkey % 43 = 0 THEN '-3' WHEN c_custkey % 3 = 0 THEN CAST(c_custkey * 13 % 700 AS STRING) WHEN c_custkey % 29 = 1 THEN CAST(c_custkey * 13 % 700 * 3 + 1000000 AS STRING) ELSE CAST(c_custkey * 7 % 1100 AS STRING) END AS school_id FROM customer"""
_PROBE = "-(('0x' || substr(sha256({name}), 1, 8))::BIGINT % 20000 + 1)"

_SYNC = f"""WITH RECURSIVE held AS ({_HELD}), idx AS ({_INDEX}),
r AS (SELECT ordinal, trim(name) AS name, TRY_CAST(school_id AS BIGINT) AS ext, row_number() OVER (ORDER BY ordinal) AS i FROM idx),
walk AS (SELECT 0::BIGINT AS i, ['']::VARCHAR[] AS names, [0]::BIGINT[] AS ids, NULL::BIGINT AS ordinal, NULL::VARCHAR AS kind
  UNION ALL SELECT r.i, CASE WHEN k.kind = 'stands' THEN list_append(w.names, r.name) ELSE w.names END, CASE WHEN k.kind = 'stands' THEN list_append(w.ids, r.ext) ELSE w.ids END, r.ordinal, k.kind
  FROM walk w JOIN r ON r.i = w.i + 1, LATERAL (SELECT CASE WHEN r.name = '' OR r.name IS NULL OR r.ext IS NULL OR r.ext <= 0 THEN 'invalid'
    WHEN list_contains(w.names, r.name) AND list_position(w.names, r.name) = list_position(w.ids, r.ext) THEN 'duplicates' WHEN list_contains(w.names, r.name) OR list_contains(w.ids, r.ext) THEN 'conflicts' ELSE 'stands' END AS kind) k),
best AS (SELECT * FROM (SELECT *, trim(name) AS nm, row_number() OVER (PARTITION BY trim(name) ORDER BY (sch_id > 0 AND crawl_task_id IS NOT NULL) DESC, (sch_id > 0) DESC, (external_id IS NOT NULL) DESC, id) AS rn FROM held) WHERE rn = 1),
owner AS (SELECT external_id, max(id) AS oid, arg_max(trim(name), id) AS oname FROM held WHERE external_id IS NOT NULL GROUP BY 1),
m AS (SELECT r.*, w.kind, b.id, b.external_id AS own, o.oid, CASE WHEN w.kind <> 'stands' THEN w.kind WHEN b.id IS NULL THEN CASE WHEN oid IS NULL THEN 'added' ELSE 'conflicts' END
  WHEN b.external_id IS NOT NULL THEN CASE WHEN b.external_id = r.ext THEN 'already_present' ELSE 'conflicts' END
  WHEN oid IS NOT NULL AND oid <> b.id AND oname <> r.name THEN 'conflicts' WHEN b.bare AND b.sch_id = r.ext THEN 'migrated' ELSE 'linked' END AS outcome
  FROM r JOIN walk w ON w.ordinal = r.ordinal LEFT JOIN best b ON b.nm = r.name LEFT JOIN owner o ON o.external_id = r.ext),
out AS (SELECT *, CASE WHEN outcome IN ('linked', 'migrated') THEN id END AS row_id, CASE WHEN outcome IN ('linked', 'migrated') AND oid <> id THEN oid END AS unlink_id FROM m)"""


def _bare():
    return F.coalesce(F.col("bare"), F.lit(False))


def _synced(s, d):
    held, index = s.sql(_HELD.replace("FROM part", "FROM {part}"), part=t(s, d, "part")), s.sql(_INDEX.replace("FROM customer", "FROM {customer}"), customer=t(s, d, "customer"))
    return held, claims.catalogue_sync(held, index, _bare())


@query(f"{_SYNC} SELECT o.ordinal, idx.name, idx.school_id, outcome, row_id, unlink_id FROM out o JOIN idx ON idx.ordinal = o.ordinal")
def catalogue_sync(s, d):
    return _synced(s, d)[1]


@query(f"""{_SYNC}, asks AS (SELECT *, {_PROBE.format(name="name")} AS probe, row_number() OVER (ORDER BY ordinal) AS k FROM out WHERE outcome IN ('added', 'migrated')),
slots AS (SELECT 0::BIGINT AS k, list(sch_id)::BIGINT[] AS taken, NULL::BIGINT AS ordinal, NULL::BIGINT AS sch FROM held
  UNION ALL SELECT a.k, list_append(s.taken, f.sch), a.ordinal, f.sch FROM slots s JOIN asks a ON a.k = s.k + 1, LATERAL (SELECT list_filter(generate_series(a.probe, a.probe - 63, -1), lambda x: NOT list_contains(s.taken, x))[1] AS sch) f),
links AS (SELECT row_id, ext, sch FROM out LEFT JOIN slots USING (ordinal) WHERE row_id IS NOT NULL)
SELECT id, name, coalesce(sch, sch_id) AS sch_id, CASE WHEN ext IS NOT NULL THEN ext WHEN id NOT IN (SELECT unlink_id FROM out WHERE unlink_id IS NOT NULL) THEN external_id END AS external_id FROM held LEFT JOIN links ON row_id = id
UNION ALL SELECT NULL, name, sch, ext FROM out JOIN slots USING (ordinal) WHERE outcome = 'added'""")
def catalogue_synced_rows(s, d):
    held, synced = _synced(s, d)
    return claims.synced_rows(held, synced, hashing.synthetic_id(F.col("name"), 20_000))


_FOUND = "SELECT c_custkey AS ordinal, concat('N', CAST(c_custkey AS STRING)) AS name, CASE WHEN c_custkey % 4 = 0 THEN 50000 + c_custkey % 900 WHEN c_custkey % 4 = 1 THEN 700000 + c_custkey % 50 WHEN c_custkey % 4 = 2 THEN -5 END AS found_id, CASE WHEN c_custkey % 9 = 0 THEN 'other' ELSE concat('N', CAST(c_custkey AS STRING)) END AS official_name FROM customer"
#: Placeholders on ids about which new names will ask too, in one long run and here and there; some ids are free.
_PLACES = "SELECT p_partkey AS id, concat('N', CAST(p_partkey * 3 AS STRING), ' ') AS name, CASE WHEN p_partkey % 2 = 0 THEN 50000 + p_partkey % 450 ELSE -p_partkey END AS sch_id FROM part WHERE p_partkey % 2 = 1 OR p_partkey < 450"


@query(f"""WITH RECURSIVE held AS ({_PLACES}), found AS ({_FOUND}),
best AS (SELECT trim(name) AS name, arg_max(id, (CASE WHEN sch_id > 0 THEN 1e12 ELSE 0 END) - id) AS id, arg_max(sch_id, (CASE WHEN sch_id > 0 THEN 1e12 ELSE 0 END) - id) AS own FROM held GROUP BY 1),
a AS (SELECT f.*, b.id AS row_id, own, {_PROBE.format(name="f.name")} AS probe, CASE WHEN found_id > 0 AND official_name = f.name THEN found_id END AS safe FROM found f LEFT JOIN best b ON b.name = f.name),
q AS (SELECT *, row_number() OVER (ORDER BY ordinal) AS k FROM a WHERE coalesce(own, -1) <= 0),
walk AS (SELECT 0::BIGINT AS k, list(sch_id)::BIGINT[] AS taken, NULL::BIGINT AS ordinal, NULL::BIGINT AS sch FROM held
  UNION ALL SELECT q.k, list_append(list_filter(w.taken, lambda x: x IS DISTINCT FROM q.own), f.sch), q.ordinal, f.sch FROM walk w JOIN q ON q.k = w.k + 1,
  LATERAL (SELECT CASE WHEN NOT list_contains(w.taken, coalesce(q.safe, q.probe)) OR coalesce(q.safe, q.probe) = q.own THEN coalesce(q.safe, q.probe) WHEN q.own IS NOT NULL THEN q.own
    ELSE list_filter(generate_series(q.probe, q.probe - 2047, -1), lambda x: NOT list_contains(w.taken, x))[1] END AS sch) f)
SELECT a.ordinal, name, found_id, official_name, CASE WHEN own > 0 THEN 'already_present' WHEN row_id IS NULL THEN 'inserted' ELSE 'updated' END AS outcome, row_id, coalesce(CASE WHEN own > 0 THEN own END, sch) AS sch_id FROM a LEFT JOIN walk USING (ordinal)""")
def reference_reconcile(s, d):
    held, found = s.sql(_PLACES.replace("FROM part", "FROM {part}"), part=t(s, d, "part")), s.sql(_FOUND.replace("FROM customer", "FROM {customer}"), customer=t(s, d, "customer"))
    return claims.reference_reconcile(held, found, hashing.synthetic_id(F.col("name"), 20_000))
