"""Scans and reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellarium.model import sort_cells, text, text_view
from cellarium.operators.filters import All, ColumnValue, Raw, Value, ValueFound
from cellarium.operators.scan import (
    ScanSpec,
    as_of,
    estimated_size,
    exists_all,
    get_row,
    multi_get,
    page,
    resume_after,
    reversed_rows,
    scan,
)
from cellarium.plans.keyspace import KeySet, Span
from cellarium.plans.scratch import new_path
from cellarium.sources import manifest
from cellarium.workload.registry import query
from cellarium.workload.tables import SQL_CELLS, SQL_LATEST, event_cells, table

HEAD = f"WITH {SQL_CELLS}, {SQL_LATEST} "
SHOW = "SELECT row_key,family,qualifier,ts,value "
JAN_10, JAN_20 = 1704844800000, 1705708800000


def _top(n: int, source: str = "cells", order: str = "ORDER BY ts DESC") -> str:
    return f"""(SELECT * FROM {source} QUALIFY row_number() OVER
  (PARTITION BY row_key,family,qualifier {order})<={n})"""


@query("scan_full", HEAD + SHOW + "FROM latest")
def scan_full(spark, sf_dir):
    return text_view(sort_cells(scan(event_cells(spark, sf_dir))))


@query("scan_latest", HEAD + "SELECT row_key,family,qualifier,ts,value FROM latest WHERE family='nav'")
def scan_latest(spark, sf_dir):
    return text_view(scan(event_cells(spark, sf_dir), columns={"nav": None}))


@query("scan_max_versions", f"WITH {SQL_CELLS} {SHOW} FROM {_top(3)}")
def scan_max_versions(spark, sf_dir):
    return text_view(scan(event_cells(spark, sf_dir), max_versions=3))


@query("scan_row_range", HEAD + SHOW + "FROM latest WHERE row_key >= 'u00003' AND row_key < 'u00030'")
def scan_row_range(spark, sf_dir):
    return text_view(scan(event_cells(spark, sf_dir), rows=KeySet.between("u00003", "u00030")))


@query("scan_row_range_open", HEAD + SHOW + "FROM latest WHERE row_key > 'u00003' AND row_key <= 'u00030'")
def scan_row_range_open(spark, sf_dir):
    rows = KeySet.between("u00003", "u00030", start_inclusive=False, stop_inclusive=True)
    return text_view(scan(event_cells(spark, sf_dir), rows=rows))


@query("scan_point", f"WITH {SQL_CELLS} {SHOW} FROM cells WHERE row_key = 'u00007'")
def scan_point(spark, sf_dir):
    rows = KeySet.between("u00007", "u00007", stop_inclusive=True)
    return text_view(scan(event_cells(spark, sf_dir), rows=rows, max_versions=None))


@query("scan_prefix", HEAD + SHOW + "FROM latest WHERE starts_with(row_key, 'u0001')")
def scan_prefix(spark, sf_dir):
    return text_view(scan(event_cells(spark, sf_dir), rows=KeySet.prefix("u0001")))


@query(
    "scan_row_set",
    HEAD
    + SHOW
    + """FROM latest WHERE (row_key >= 'u00002' AND row_key < 'u00009')
  OR (row_key >= 'u00005' AND row_key <= 'u00012') OR row_key IN ('u00020','u00040')""",
)
def scan_row_set(spark, sf_dir):
    rows = (
        KeySet.between("u00002", "u00009")
        .union(KeySet.between("u00005", "u00012", stop_inclusive=True))
        .union(KeySet.points(["u00020", "u00040"]))
    )
    return text_view(scan(event_cells(spark, sf_dir), rows=rows))


# Every other user key up to 1,200: far more spans than a predicate should hold.
@query(
    "scan_row_set_large",
    HEAD
    + SHOW
    + "FROM latest WHERE row_key IN (SELECT printf('u%05d', r.i*2) FROM range(600) r(i))",
)
def scan_row_set_large(spark, sf_dir):
    rows = KeySet.points(f"u{2 * i:05d}" for i in range(600))
    return text_view(scan(event_cells(spark, sf_dir), rows=rows))


@query(
    "scan_row_set_ranges",
    HEAD
    + SHOW
    + """FROM latest l WHERE EXISTS (SELECT 1 FROM range(9999) r(i)
  WHERE l.row_key >= printf('u%05d', i*10+2) AND l.row_key < printf('u%05d', i*10+5))""",
)
def scan_row_set_ranges(spark, sf_dir):
    """Ten thousand spans of three neighbouring users each."""
    starts = range(2, 99_990, 10)
    rows = KeySet([Span(b"u%05d" % i, b"u%05d" % (i + 3)) for i in starts])
    return text_view(scan(event_cells(spark, sf_dir), rows=rows))


@query("get_row", HEAD + SHOW + "FROM latest WHERE row_key = 'u00011' AND family = 'nav'")
def get_one(spark, sf_dir):
    return text_view(get_row(event_cells(spark, sf_dir), "u00011", ScanSpec(columns={"nav": None})))


# One request per customer: many keys have no events, and must come back as misses.
SQL_REQUESTS = "req AS (SELECT c_custkey AS request, printf('u%05d', c_custkey*3) AS row_key FROM customer)"


def requests(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("request"),
        F.format_string("u%05d", F.col("c_custkey") * 3).cast("binary").alias("row"),
    )


@query(
    "multi_get",
    f"""WITH {SQL_CELLS}, {SQL_LATEST}, {SQL_REQUESTS}
SELECT request, req.row_key, family, qualifier, ts, value FROM req LEFT JOIN latest USING (row_key)""",
)
def many_gets(spark, sf_dir):
    return text_view(multi_get(event_cells(spark, sf_dir), requests(spark, sf_dir)), "request")


@query(
    "exists_all",
    f"""WITH {SQL_CELLS}, {SQL_REQUESTS}
SELECT request, row_key, row_key IN (SELECT row_key FROM cells WHERE qualifier='purchase') AS found FROM req""",
)
def exists_many(spark, sf_dir):
    found = exists_all(
        event_cells(spark, sf_dir),
        requests(spark, sf_dir),
        ScanSpec(columns={"tx": ["purchase"]}),
    )
    return found.select("request", text("row").alias("row_key"), "found")


@query(
    "scan_time_range",
    f"""WITH {SQL_CELLS} {SHOW} FROM
 (SELECT * FROM cells WHERE ts >= {JAN_10} AND ts < {JAN_20}
  QUALIFY row_number() OVER (PARTITION BY row_key,family,qualifier ORDER BY ts DESC) <= 2)""",
)
def scan_time_range(spark, sf_dir):
    return text_view(
        scan(event_cells(spark, sf_dir), time_range=(JAN_10, JAN_20), max_versions=2)
    )


@query(
    "scan_family_time_range",
    f"""WITH {SQL_CELLS} {SHOW} FROM {_top(4)}
WHERE family='tx' AND ts >= {JAN_10} AND ts < {JAN_20}""",
)
def scan_family_time_range(spark, sf_dir):
    return text_view(
        scan(
            event_cells(spark, sf_dir),
            max_versions=4,
            family_time_ranges={"tx": (JAN_10, JAN_20)},
        )
    )


@query("project_family", f"WITH {SQL_CELLS} {SHOW} FROM cells WHERE family='tx'")
def project_family(spark, sf_dir):
    return text_view(scan(event_cells(spark, sf_dir), columns={"tx": None}, max_versions=None))


@query(
    "project_columns",
    HEAD + SHOW + "FROM latest WHERE family='tx' OR (family='nav' AND qualifier IN ('view','error'))",
)
def project_columns(spark, sf_dir):
    return text_view(
        scan(event_cells(spark, sf_dir), columns={"tx": None, "nav": ["view", "error"]})
    )


@query("scan_reversed", HEAD + SHOW + "FROM latest WHERE row_key <= 'u00050' AND row_key > 'u00020'")
def scan_reversed(spark, sf_dir):
    spec = ScanSpec(rows=reversed_rows("u00050", "u00020"), reverse=True)
    return text_view(sort_cells(scan(event_cells(spark, sf_dir), spec), reverse=True))


@query(
    "scan_limit",
    HEAD + SHOW + "FROM latest WHERE row_key IN (SELECT DISTINCT row_key FROM cells ORDER BY 1 LIMIT 17)",
)
def scan_limit(spark, sf_dir):
    return text_view(scan(event_cells(spark, sf_dir), limit=17))


@query(
    "scan_reversed_limit",
    HEAD
    + SHOW
    + "FROM latest WHERE row_key IN (SELECT DISTINCT row_key FROM cells ORDER BY 1 DESC LIMIT 9)",
)
def scan_reversed_limit(spark, sf_dir):
    return text_view(scan(event_cells(spark, sf_dir), limit=9, reverse=True))


@query(
    "scan_page",
    HEAD
    + SHOW
    + """FROM latest WHERE row_key IN
  (SELECT DISTINCT row_key FROM cells WHERE row_key > 'u00017' ORDER BY 1 LIMIT 10)""",
)
def scan_page(spark, sf_dir):
    return text_view(page(event_cells(spark, sf_dir), 10, after="u00017"))


@query("scan_resume", HEAD + SHOW + "FROM latest WHERE row_key > 'u00100'")
def scan_resume(spark, sf_dir):
    return text_view(scan(event_cells(spark, sf_dir), rows=resume_after("u00100")))


@query(
    "filter_raw",
    HEAD + SHOW + "FROM latest WHERE ts % 2 = 0 AND length(value) = 4",
)
def filter_raw(spark, sf_dir):
    native = Raw((F.col("ts") % 2 == 0) & (F.octet_length("value") == 4))
    return text_view(scan(event_cells(spark, sf_dir), filter=native))


@query(
    "estimate_size",
    f"""WITH {SQL_CELLS} SELECT count(*) AS cells,
  CAST(coalesce(sum(length(row_key)+length(family)+length(qualifier)+length(value)+8),0) AS BIGINT) AS bytes
FROM cells WHERE row_key >= 'u00010'""",
)
def estimate_size(spark, sf_dir):
    return estimated_size(event_cells(spark, sf_dir), KeySet.between("u00010"))


def indexed_cells(spark, sf_dir):
    """The event cells as an export with its manifest, in files of a few thousand cells."""
    path, cells = new_path(spark, "indexed"), event_cells(spark, sf_dir)
    manifest.export_indexed(cells, path, parts=cells.count() // 5_000 + 1)
    return path


@query(
    "multi_get_indexed",
    f"""WITH {SQL_CELLS}, {SQL_LATEST}, {SQL_REQUESTS}
SELECT request, req.row_key, family, qualifier, ts, value FROM req LEFT JOIN latest USING (row_key)""",
)
def many_gets_indexed(spark, sf_dir):
    asked = requests(spark, sf_dir)
    cells = manifest.read_holding(spark, indexed_cells(spark, sf_dir), asked)
    return text_view(multi_get(cells, asked), "request")


@query(
    "exists_indexed",
    f"""WITH {SQL_CELLS}, {SQL_REQUESTS}
SELECT request, row_key, row_key IN (SELECT row_key FROM cells WHERE qualifier='purchase') AS found FROM req""",
)
def exists_many_indexed(spark, sf_dir):
    asked = requests(spark, sf_dir)
    cells = manifest.read_holding(spark, indexed_cells(spark, sf_dir), asked)
    found = exists_all(cells, asked, ScanSpec(columns={"tx": ["purchase"]}))
    return found.select("request", text("row").alias("row_key"), "found")


@query(
    "estimate_from_footers",
    f"""WITH {SQL_CELLS} SELECT (SELECT count(*) FROM cells) AS table_cells,
  count(*) AS cells, true AS bounded, true AS near FROM cells WHERE row_key >= 'u00010' AND row_key < 'u00040'""",
)
def estimate_from_footers(spark, sf_dir):
    """The whole table is told exactly; a range within its bounds, which are two row groups apart."""
    groups = manifest.read_manifest(spark, indexed_cells(spark, sf_dir))
    rows = KeySet.between("u00010", "u00040")
    cells = event_cells(spark, sf_dir)
    whole = manifest.estimated_size(groups, KeySet.all()).first()
    part = manifest.estimated_size(groups, rows).first()
    most = groups.agg(F.max("cells")).scalar()
    exact = estimated_size(cells, rows).select("cells")
    low, high = F.lit(part["cells_low"]), F.lit(part["cells_high"])
    return exact.select(
        F.lit(whole["cells"]).cast("bigint").alias("table_cells"),
        "cells",
        F.col("cells").between(low, high).alias("bounded"),
        (high - low <= 2 * F.coalesce(most, F.lit(0))).alias("near"),
    )


@query(
    "scan_spec",
    f"""WITH {SQL_CELLS}, lim AS (SELECT * FROM cells WHERE row_key >= 'u00005' AND ts >= {JAN_10}
  QUALIFY row_number() OVER (PARTITION BY row_key,family,qualifier ORDER BY ts DESC) <= 2),
keep AS (SELECT * FROM lim WHERE value LIKE '%7%' AND family='nav')
SELECT row_key,family,qualifier,ts,value FROM keep WHERE row_key IN
  (SELECT DISTINCT row_key FROM keep ORDER BY 1 LIMIT 40)""",
)
def scan_with_spec(spark, sf_dir):
    spec = ScanSpec(
        rows=KeySet.between("u00005"),
        columns={"nav": None},
        time_range=(JAN_10, None),
        max_versions=2,
        filter=ValueFound("7"),
        limit=40,
    )
    return text_view(scan(event_cells(spark, sf_dir), spec))


@query(
    "as_of",
    f"""WITH {SQL_CELLS} {SHOW} FROM (SELECT * FROM cells WHERE ts <= {JAN_10}
  QUALIFY row_number() OVER (PARTITION BY row_key,family,qualifier ORDER BY ts DESC)=1)""",
)
def table_as_of(spark, sf_dir):
    return text_view(as_of(event_cells(spark, sf_dir), JAN_10))


@query("sort_cells", f"WITH {SQL_CELLS} {SHOW} FROM cells")
def sorted_cells(spark, sf_dir):
    return text_view(sort_cells(event_cells(spark, sf_dir)))


@query(
    "range_intersect",
    HEAD + SHOW + "FROM latest WHERE row_key >= 'u00010' AND row_key < 'u00020' AND CAST(value AS BIGINT) % 10 = 3",
)
def range_intersect(spark, sf_dir):
    rows = KeySet.between("u00005", "u00020").intersect(KeySet.prefix("u0001"))
    spec = ScanSpec(rows=rows, filter=All(ValueFound("3$")))
    return text_view(scan(event_cells(spark, sf_dir), spec))


@query(
    "range_complement",
    HEAD + SHOW + "FROM latest WHERE NOT (row_key >= 'u00010' AND row_key < 'u00090') AND row_key <> 'u00003'",
)
def range_complement(spark, sf_dir):
    rows = KeySet.between("u00010", "u00090").union(KeySet.point("u00003")).complement()
    return text_view(scan(event_cells(spark, sf_dir), rows=rows))


@query(
    "flagship",
    f"""WITH {SQL_CELLS}, {SQL_LATEST}
SELECT row_key,family,qualifier,ts,value FROM latest WHERE starts_with(row_key,'u00')
QUALIFY max(CASE WHEN family='tx' AND qualifier='purchase' THEN CASE WHEN value > '5' THEN 1 ELSE 0 END END)
  OVER (PARTITION BY row_key) IS DISTINCT FROM 0""",
)
def flagship(spark, sf_dir):
    """Prefix scan, newest versions, rows kept by the value of one column."""
    spec = ScanSpec(
        rows=KeySet.prefix("u00"), filter=ColumnValue("tx", "purchase", Value(">", "5"))
    )
    return text_view(scan(event_cells(spark, sf_dir), spec))


