"""Export, import, snapshots, guards, and cutting work by key."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellarium.functions.bytewise import to_micros, to_millis
from cellarium.functions.bytewise import successor_of as successor
from cellarium.model import CELL, text, text_view
from cellarium.operators import importing as imp
from cellarium.operators import mutate as m
from cellarium.operators import splits as s
from cellarium.operators.filters import FamilyIs
from cellarium.operators.scan import ScanSpec
from cellarium.plans.scratch import new_path, settle
from cellarium.sources import tables as t
from cellarium.workload.mutations import SQL_ACTIONS, actions
from cellarium.workload.registry import query
from cellarium.workload.tables import (
    SPLIT,
    SQL_CELLS,
    SQL_DOCS,
    SQL_MIRROR,
    SQL_ORDER_CELLS,
    SQL_TYPED,
    document_cells,
    event_cells,
    line_cells,
    mirror_cells,
    order_cells,
    table,
    typed_cells,
    sql_bundles,
)

HEAD = f"WITH {SQL_CELLS} "
SHOW = "SELECT row_key,family,qualifier,ts,value "


@query(
    "export_import_roundtrip",
    f"""{HEAD} {SHOW} FROM cells WHERE family='nav' QUALIFY row_number() OVER
 (PARTITION BY row_key,family,qualifier ORDER BY ts DESC)<=3""",
)
def export_import_roundtrip(spark, sf_dir):
    path = new_path(spark, "export")
    spec = ScanSpec(max_versions=3, filter=FamilyIs("nav"))
    t.export_cells(event_cells(spark, sf_dir), path, spec)
    return text_view(t.import_cells(t.read_cells(spark, f"{path}/part-*")).select(*CELL))


SQL_LIVE = f"""{SQL_TYPED}, live AS (SELECT p.row_key,p.family,p.qualifier,p.ts,p.value,p.seq FROM typed p
 WHERE p.type='PUT' AND NOT EXISTS (SELECT 1 FROM typed d WHERE d.type<>'PUT' AND d.row_key=p.row_key AND d.family=p.family AND (
  (d.type='DELETE' AND d.qualifier=p.qualifier AND d.ts=p.ts) OR (d.type='DELETE_FAMILY_VERSION' AND d.ts=p.ts) OR
  (d.type='DELETE_COLUMN' AND d.qualifier=p.qualifier AND p.ts<=d.ts) OR (d.type='DELETE_FAMILY' AND p.ts<=d.ts))))"""


@query("mask_tombstones", f"{HEAD}, {SQL_LIVE} {SHOW} FROM live")
def mask_tombstones(spark, sf_dir):
    return text_view(imp.mask_tombstones(typed_cells(spark, sf_dir)))


@query(
    "import_cells",
    f"""{HEAD}, {SQL_LIVE} SELECT CASE family WHEN 'nav' THEN 'web' ELSE family END AS family,
  count(*) AS cells, count(DISTINCT row_key) AS rows FROM live WHERE row_key >= 'u00010' GROUP BY 1""",
)
def import_cells(spark, sf_dir):
    path = new_path(spark, "typed")
    typed_cells(spark, sf_dir).select(*CELL, "type").write.parquet(path)
    typed = t.read_cells(spark, path, typed=True)
    cells = t.import_cells(
        typed, row_test=F.col("row") >= F.lit(b"u00010"), family_names={"nav": "web"}
    )
    return cells.groupBy("family").agg(
        F.count(F.lit(1)).alias("cells"), F.count_distinct("row").alias("rows")
    )


@query(
    "import_filter",
    f"{HEAD} {SHOW} FROM cells WHERE regexp_matches(row_key,'[02468]$') AND qualifier IN ('click','view')",
)
def import_filter(spark, sf_dir):
    kept = imp.import_filter(
        event_cells(spark, sf_dir),
        F.col("row").cast("string").rlike("[02468]$"),
        F.col("qualifier").isin(b"click", b"view"),
    )
    return text_view(kept)


@query("import_spread", f"{HEAD} {SHOW} FROM cells")
def import_spread(spark, sf_dir):
    return text_view(t.spread(event_cells(spark, sf_dir), 16))


@query(
    "chunk_rows",
    f"""{HEAD} SELECT row_key, CAST(floor((n-1)/25) AS BIGINT) AS chunk, count(*) AS cells, min(ts) AS first_ts, max(ts) AS last_ts
 FROM (SELECT *, row_number() OVER (PARTITION BY row_key ORDER BY family,qualifier,ts DESC) AS n FROM cells) GROUP BY 1,2""",
)
def chunk_rows(spark, sf_dir):
    chunked = imp.chunk_rows(event_cells(spark, sf_dir), 25)
    return chunked.groupBy(text("row").alias("row_key"), "chunk").agg(
        F.count(F.lit(1)).alias("cells"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )


LIMITS = imp.Limits(row_key_bytes=11, cell_bytes=8_000, row_bytes=150_000, row_cells=60)
SQL_GUARDS = f"""WITH {SQL_DOCS},
 keyed AS (SELECT *, len > 8000 AS large FROM docs WHERE strlen(row_key) <= 11),
 totals AS (SELECT row_key, coalesce(sum(bytes) FILTER (NOT large),0) AS b, count(*) FILTER (NOT large) AS n,
   count(*) FILTER (large) AS l FROM keyed GROUP BY 1),
 bad AS (SELECT row_key FROM totals WHERE b > 150000 OR n > 60),
 read AS (SELECT *, sum(CASE WHEN large THEN 0 ELSE bytes END) OVER w AS sb, sum(CASE WHEN large THEN 0 ELSE 1 END) OVER w AS sn
   FROM keyed WINDOW w AS (PARTITION BY row_key ORDER BY qualifier ROWS UNBOUNDED PRECEDING))"""


@query(
    "size_guards",
    SQL_GUARDS
    + """ SELECT row_key, qualifier, CAST(len AS BIGINT) AS bytes FROM keyed
 WHERE NOT large AND row_key NOT IN (SELECT row_key FROM bad)""",
)
def size_guards(spark, sf_dir):
    kept = imp.size_guards(document_cells(spark, sf_dir), LIMITS)
    return kept.select(
        text("row").alias("row_key"),
        text("qualifier").alias("qualifier"),
        F.octet_length("value").cast("bigint").alias("bytes"),
    )


@query(
    "size_guard_counts",
    SQL_GUARDS
    + """ SELECT (SELECT count(DISTINCT row_key) FROM docs WHERE strlen(row_key) > 11) AS dropped_row_keys,
 (SELECT count(*) FROM read WHERE large AND (row_key NOT IN (SELECT row_key FROM bad) OR (sb <= 150000 AND sn <= 60))) AS dropped_cells,
 (SELECT count(*) FROM totals WHERE row_key IN (SELECT row_key FROM bad) OR n = 0) AS dropped_rows""",
)
def size_guard_counts(spark, sf_dir):
    return imp.size_guard_counts(document_cells(spark, sf_dir), LIMITS)


@query(
    "rename_families",
    f"{HEAD} SELECT CASE family WHEN 'tx' THEN 'trade' ELSE family END AS family, qualifier, count(*) AS cells FROM cells GROUP BY 1,2",
)
def rename_families(spark, sf_dir):
    renamed = imp.rename_families(event_cells(spark, sf_dir), {"tx": "trade", "other": "x"})
    return renamed.groupBy("family", text("qualifier").alias("qualifier")).agg(
        F.count(F.lit(1)).alias("cells")
    )


@query(
    "import_put_delete",
    f"""{HEAD}, {SQL_TYPED} SELECT row_key, seq, type,
 CASE type WHEN 'DELETE_FAMILY' THEN 0 WHEN 'PUT' THEN 1 ELSE 2 END AS step FROM typed""",
)
def import_put_delete(spark, sf_dir):
    steps = imp.write_steps(typed_cells(spark, sf_dir))
    return steps.select(text("row").alias("row_key"), "seq", "type", "step")


@query(
    "bulk_sorted",
    f"""WITH {SQL_ORDER_CELLS}, placed AS (SELECT *, CASE WHEN row_key >= '0000010000' THEN '0000010000'
  WHEN row_key >= '0000001000' THEN '0000001000' ELSE '' END AS region FROM order_cells)
SELECT region, count(*) AS cells, min(row_key) AS first_row, max(row_key) AS last_row FROM placed GROUP BY 1""",
)
def bulk_sorted(spark, sf_dir):
    """Order cells as sorted files per region of a table with two split points."""
    path = new_path(spark, "regions")
    splits = spark.createDataFrame([(b"",), (b"0000001000",), (b"0000010000",)], "start binary")
    t.write_regions(order_cells(spark, sf_dir), splits, path)
    stored = t.read_regions(spark, path).join(t.region_starts(spark, path), "region")
    return stored.groupBy(text("start").alias("region")).agg(
        F.count(F.lit(1)).alias("cells"),
        text(F.min("row")).alias("first_row"),
        text(F.max("row")).alias("last_row"),
    )


@query(
    "import_snapshots",
    f"""WITH {SQL_CELLS}, snaps AS (SELECT CASE WHEN ts < {SPLIT} THEN 'early' ELSE 'late' END AS snapshot, * FROM cells),
 sizes AS (SELECT snapshot, row_key, count(*) AS n FROM snaps GROUP BY 1,2)
SELECT CASE snapshot WHEN 'early' THEN 'events_before' ELSE 'events_after' END AS "table",
  count(DISTINCT row_key) AS rows, count(*) AS cells FROM snaps JOIN sizes USING (snapshot, row_key) WHERE n <= 50 GROUP BY 1""",
)
def import_snapshots(spark, sf_dir):
    """Two snapshots of the event table, wide rows dropped, each into its own table."""
    folder, path = new_path(spark, "snapshots"), new_path(spark, "tables")
    cells = event_cells(spark, sf_dir)
    name = F.when(F.col("ts") < SPLIT, "early").otherwise("late")
    cells.withColumn("snapshot", name).write.partitionBy("snapshot").parquet(folder)
    targets = t.snapshot_tables("early:events_before, late:events_after")
    t.import_snapshots(spark, folder, targets, imp.Limits(row_cells=50), path)
    return imp.multi_table_counts(t.read_tables(spark, path))


@query(
    "select_snapshots",
    "SELECT DISTINCT event_type AS snapshot, event_type AS \"table\" FROM events WHERE event_type LIKE 'c%' "
    "UNION ALL SELECT DISTINCT event_type, CASE event_type WHEN 'view' THEN 'seen' ELSE event_type END FROM events "
    "WHERE event_type IN ('view','error') UNION ALL SELECT DISTINCT event_type, event_type FROM events "
    "WHERE regexp_matches(event_type,'^.i.*k?')",
)
def select_snapshots(spark, sf_dir):
    """A prefix, an explicit list, and a regex, over the event types as snapshot names."""
    names = table(spark, sf_dir, "events").select(F.col("event_type").alias("snapshot")).distinct()
    picked = [t.select_snapshots(names, spec) for spec in ("c*", "view:seen,error", "^.i.*k?")]
    return picked[0].unionByName(picked[1]).unionByName(picked[2])


SQL_KEYED = f"""bounds AS (SELECT start, lead(start) OVER (ORDER BY start) AS stop FROM
 (SELECT '' AS start UNION ALL SELECT DISTINCT printf('u%05d', c_custkey*40) FROM customer)),
 sized AS (SELECT b.start, b.stop, CAST(coalesce(sum(24+length(row_key)+length(family)+length(qualifier)+length(value)),0) AS BIGINT) AS bytes
   FROM bounds b LEFT JOIN cells c ON c.row_key >= b.start AND (b.stop IS NULL OR c.row_key < b.stop) GROUP BY 1,2)"""


def _ranges(spark, sf_dir):
    """Ranges sampled from the customer keys, with repeats and an empty sample."""
    number = F.col("c_custkey") * 40
    key = F.format_string("u%05d", number)
    samples = table(spark, sf_dir, "customer").select(
        F.explode(F.array(key, key, F.lit(""))).alias("key")
    )
    return s.key_ranges(samples.select(F.col("key").cast("binary").alias("key")))


@query("key_ranges", f"WITH {SQL_CELLS}, {SQL_KEYED} SELECT start, stop FROM bounds")
def key_ranges(spark, sf_dir):
    ranges = _ranges(spark, sf_dir)
    return ranges.select(text("start").alias("start"), text("stop").alias("stop"))


@query("region_sizes", f"WITH {SQL_CELLS}, {SQL_KEYED} SELECT start, stop, bytes FROM sized")
def region_sizes(spark, sf_dir):
    sizes = s.region_sizes(event_cells(spark, sf_dir), settle(_ranges(spark, sf_dir), "ranges"))
    return sizes.select(text("start").alias("start"), text("stop").alias("stop"), "bytes")


TARGET = 90_000


@query(
    "balanced_splits",
    f"""WITH RECURSIVE {SQL_CELLS}, {SQL_KEYED},
 runs AS (SELECT *, bytes >= {TARGET} AS big, sum(CASE WHEN bytes >= {TARGET} THEN 1 ELSE 0 END) OVER (ORDER BY start) AS run FROM sized),
 smalls AS (SELECT * FROM runs WHERE NOT big),
 {sql_bundles("merged", "smalls", "run", "start", {"bytes": TARGET})},
 bundled AS (SELECT run, bundle, start, stop, bytes FROM merged UNION ALL SELECT run, -1, start, stop, bytes FROM runs WHERE big)
SELECT min(start) AS start, CASE WHEN count(stop)=count(*) THEN max(stop) END AS stop,
  CAST(sum(bytes) AS BIGINT) AS bytes, count(*) AS ranges FROM bundled GROUP BY run, bundle""",
)
def balanced_splits(spark, sf_dir):
    sizes = s.region_sizes(event_cells(spark, sf_dir), settle(_ranges(spark, sf_dir), "ranges"))
    splits = s.balanced_splits(settle(sizes, "sizes"), TARGET)
    return splits.select(text("start").alias("start"), text("stop").alias("stop"), "bytes", "ranges")


@query(
    "select_shard",
    f"{HEAD} {SHOW} FROM cells WHERE CAST('0x'||substr(md5(row_key),1,8) AS BIGINT) % 4 = 2",
)
def select_shard(spark, sf_dir):
    return text_view(s.select_shard(event_cells(spark, sf_dir), F.col("row"), 4, 2))


@query(
    "split_points",
    f"{HEAD} SELECT DISTINCT min(row_key) AS split FROM cells GROUP BY ts//3600000",
)
def split_points(spark, sf_dir):
    """First key of every bundle, the events of one hour being a bundle."""
    hour = F.floor(F.col("ts") / 3_600_000)
    return s.split_points(event_cells(spark, sf_dir), hour).select(text("split").alias("split"))


@query(
    "uniform_buckets",
    """WITH l AS (SELECT lpad(CAST(l_orderkey AS VARCHAR),10,'0') AS k, u.q||'#'||l_linenumber AS q, u.v AS v FROM lineitem,
  unnest([{'q':'l_partkey','v':CAST(l_partkey AS VARCHAR)},{'q':'l_suppkey','v':CAST(l_suppkey AS VARCHAR)},
   {'q':'l_returnflag','v':l_returnflag},{'q':'l_linestatus','v':l_linestatus},
   {'q':'l_quantity','v':CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)}]) AS t(u)),
 n AS (SELECT *, CAST('0x'||hex(k) AS HUGEINT) AS x FROM l), e AS (SELECT min(x) AS lo, max(x) AS hi FROM n)
SELECT CAST(least((x-lo)*16//(hi-lo), 15) AS BIGINT) AS bucket, count(*) AS cells,
  CAST(sum(24+16+1+length(q)+length(v)) AS BIGINT) AS bytes FROM n, e GROUP BY 1""",
)
def uniform_buckets(spark, sf_dir):
    """Even cuts between the first and the last key; all keys share their first six bytes or more."""
    cells = line_cells(spark, sf_dir).withColumn("row", F.concat(F.lit(b"order:"), "row"))
    return s.even_buckets(cells, 16)


def _multi(spark, sf_dir):
    """Cells of two tables, told apart by a table column."""
    events = event_cells(spark, sf_dir).withColumn("table", F.lit("events"))
    return events.unionByName(order_cells(spark, sf_dir).withColumn("table", F.lit("orders")))


SQL_MULTI = f"""WITH {SQL_CELLS}, {SQL_ORDER_CELLS}, multi AS (
 SELECT 'events' AS "table", row_key, family, qualifier, ts, value FROM cells
 UNION ALL SELECT 'orders', row_key, family, qualifier, ts, value FROM order_cells)"""


@query(
    "write_multi_table",
    SQL_MULTI + 'SELECT "table", count(DISTINCT row_key) AS rows, count(*) AS cells FROM multi GROUP BY 1',
)
def write_multi_table(spark, sf_dir):
    path = new_path(spark, "tables")
    t.write_tables(_multi(spark, sf_dir), path)
    return imp.multi_table_counts(t.read_tables(spark, path))


@query(
    "rename_tables",
    SQL_MULTI
    + """SELECT CASE "table" WHEN 'orders' THEN 'sales' ELSE "table" END AS "table", family, count(*) AS cells FROM multi
 WHERE regexp_full_match("table",'o.*|events') GROUP BY 1,2""",
)
def rename_tables(spark, sf_dir):
    chosen = imp.select_tables(_multi(spark, sf_dir), "o.*|events", {"orders": "sales"})
    return chosen.groupBy("table", "family").agg(F.count(F.lit(1)).alias("cells"))


@query(
    "write_counts",
    f"""WITH {SQL_CELLS}, {SQL_ACTIONS} SELECT CASE WHEN op='MERGE' THEN 'unknown operation'
  WHEN op='PUT' AND value IS NULL THEN 'empty put' WHEN op='DELETE_FAMILY' THEN 'scope delete at a timestamp'
  WHEN op='DELETE_VERSION' THEN 'delete of the single latest version' ELSE 'ok' END AS outcome, count(*) AS mutations
FROM actions GROUP BY 1""",
)
def write_counts(spark, sf_dir):
    return imp.failures_by_message(actions(spark, sf_dir).select(m.problem().alias("error")))


@query(
    "family_diff",
    f"""WITH {SQL_CELLS}, {SQL_ORDER_CELLS}, cur AS (SELECT family, count(*) AS current_cells FROM cells GROUP BY 1),
 want AS (SELECT family, count(*) AS wanted_cells FROM (SELECT family FROM cells WHERE family='tx'
   UNION ALL SELECT family FROM order_cells) GROUP BY 1)
SELECT family, CASE WHEN current_cells IS NULL THEN 'add' WHEN wanted_cells IS NULL THEN 'delete' ELSE 'keep' END AS action,
  current_cells, wanted_cells FROM cur FULL OUTER JOIN want USING (family)""",
)
def family_diff(spark, sf_dir):
    events = event_cells(spark, sf_dir)
    wanted = events.where(F.col("family") == "tx").unionByName(order_cells(spark, sf_dir))
    return imp.family_diff(events, wanted)


@query(
    "row_cell_counts",
    f"WITH {SQL_CELLS}, {SQL_MIRROR} SELECT count(DISTINCT row_key) AS rows, count(*) AS cells FROM mirror",
)
def row_cell_counts(spark, sf_dir):
    return imp.row_cell_counts(mirror_cells(spark, sf_dir))


# ---- byte functions inside jobs ---------------------------------------------


@query(
    "prefix_successors",
    f"""{HEAD} SELECT row_key, substr(row_key,1,5)||chr(ascii(substr(row_key,6,1))+1) AS after, count(*) AS cells FROM cells GROUP BY 1,2""",
)
def prefix_successors(spark, sf_dir):
    """Upper bound of the prefix range of every row key."""
    per_row = event_cells(spark, sf_dir).groupBy("row").agg(F.count(F.lit(1)).alias("cells"))
    return per_row.select(
        text("row").alias("row_key"), text(successor(F.col("row"))).alias("after"), "cells"
    )


@query(
    "timestamp_units",
    f"""{HEAD}, x AS (SELECT row_key, seq, CASE WHEN seq%7=0 THEN 9223372036854775807 - seq ELSE ts END AS ts FROM cells),
 y AS (SELECT *, CASE WHEN ts < 9223372036854775 THEN ts*1000 ELSE 9223372036854775000 END AS micros FROM x)
SELECT row_key, seq, micros, CASE WHEN micros >= 9223372036854775000 THEN 9223372036854775807 ELSE micros//1000 END AS millis FROM y""",
)
def timestamp_units(spark, sf_dir):
    """Milliseconds to microseconds and back; values past the range are clamped."""
    cells = event_cells(spark, sf_dir, seq=True)
    huge = F.lit(2**63 - 1) - F.col("seq")
    ts = F.when(F.col("seq") % 7 == 0, huge).otherwise(F.col("ts"))
    micros = cells.select(text("row").alias("row_key"), "seq", to_micros(ts).alias("micros"))
    return micros.withColumn("millis", to_millis(F.col("micros")))
