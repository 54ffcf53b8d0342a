"""Comparison of two copies of a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellarium.functions.bytewise import hash_share, short_hex
from cellarium.model import CELL, text, text_view
from cellarium.operators import compare as c
from cellarium.operators import mutate as m
from cellarium.operators.filters import newest
from cellarium.plans.scratch import settle
from cellarium.workload.mutations import SQL_ACTIONS, actions
from cellarium.workload.registry import query
from cellarium.workload.tables import SQL_CELLS, SQL_MIRROR, event_cells, mirror_cells, sql_bundles

HEAD = f"WITH {SQL_CELLS}, {SQL_MIRROR} "
SHOW = "SELECT row_key,family,qualifier,ts,value "
BATCH_BYTES = 3_000


def _digests(source: str, name: str) -> str:
    """Row digests as SQL: XOR of two 60-bit slices of the md5 of every cell."""
    return f"""{name}_md5 AS (SELECT row_key, 24+length(row_key)+length(family)+length(qualifier)+length(value) AS bytes,
   md5(hex(row_key)||'|'||hex(family)||'|'||hex(qualifier)||'|'||ts||'|'||hex(value)) AS h FROM {source}),
 {name} AS (SELECT row_key, count(*) AS cells, CAST(sum(bytes) AS BIGINT) AS bytes,
   bit_xor(CAST('0x'||substr(h,1,15) AS BIGINT)) AS a, bit_xor(CAST('0x'||substr(h,17,15) AS BIGINT)) AS b
   FROM {name}_md5 GROUP BY 1)"""


HASH = "printf('%015X',a)||printf('%015X',b)"
SQL_RANGES = f"""{_digests("cells", "src")},
 {sql_bundles("placed", "src", "0", "row_key", {"bytes": BATCH_BYTES})},
 grouped AS (SELECT bundle AS r, min(row_key) AS first, count(*) AS rows, CAST(sum(cells) AS BIGINT) AS cells,
   bit_xor(a) AS a, bit_xor(b) AS b FROM placed GROUP BY 1),
 ranges AS (SELECT CASE WHEN r=0 THEN '' ELSE first END AS start, rows, cells, {HASH} AS hash FROM grouped),
 bounds AS (SELECT *, lead(start) OVER (ORDER BY start) AS stop FROM ranges)"""


@query("hash_rows", f"WITH {SQL_CELLS}, {_digests('cells', 'src')} SELECT row_key, cells, {HASH} AS hash FROM src")
def hash_rows(spark, sf_dir):
    digests = c.hash_rows(event_cells(spark, sf_dir))
    return digests.select(text("row").alias("row_key"), "cells", "hash")


def _ranges(spark, sf_dir) -> DataFrame:
    return c.hash_ranges(event_cells(spark, sf_dir), BATCH_BYTES)


@query("hash_ranges", f"WITH RECURSIVE {SQL_CELLS}, {SQL_RANGES} SELECT start, rows, cells, hash FROM ranges")
def hash_ranges(spark, sf_dir):
    return _ranges(spark, sf_dir).withColumn("start", text("start"))


@query("hash_range_bounds", f"WITH RECURSIVE {SQL_CELLS}, {SQL_RANGES} SELECT start, stop, rows, cells, hash FROM bounds")
def hash_range_bounds(spark, sf_dir):
    bounds = c.range_bounds(_ranges(spark, sf_dir))
    return bounds.withColumn("start", text("start")).withColumn("stop", text("stop"))


SQL_SYNC = f"""WITH RECURSIVE {SQL_CELLS}, {SQL_MIRROR}, {SQL_RANGES}, {_digests("mirror", "dst")},
 theirs AS (SELECT start, bit_xor(a) AS a, bit_xor(b) AS b FROM bounds
   JOIN dst ON dst.row_key >= start AND (stop IS NULL OR dst.row_key < stop) GROUP BY 1),
 synced AS (SELECT bounds.start, stop, hash, hash IS NOT DISTINCT FROM ({HASH}) AS matches
   FROM bounds LEFT JOIN theirs USING (start))"""


@query("sync_ranges", SQL_SYNC + " SELECT start, stop, hash FROM synced WHERE NOT matches")
def sync_ranges(spark, sf_dir):
    """Ranges of the source whose rows differ in the mirror."""
    ranges = settle(c.range_bounds(_ranges(spark, sf_dir)), "ranges")
    synced = c.sync_ranges(ranges, mirror_cells(spark, sf_dir))
    return synced.where(~F.col("matches")).select(
        text("start").alias("start"), text("stop").alias("stop"), "hash"
    )


@query(
    "sync_range_counts",
    SQL_SYNC + " SELECT count(*) FILTER (matches) AS matches, count(*) FILTER (NOT matches) AS mismatches FROM synced",
)
def sync_range_counts(spark, sf_dir):
    ranges = settle(_ranges(spark, sf_dir), "ranges")
    return c.sync_counts(c.sync_ranges(ranges, mirror_cells(spark, sf_dir)))


def _diff_sql(left: str, right: str) -> str:
    return f"""diff AS (SELECT row_key, family, qualifier, ts, s.value AS source_value, t.value AS target_value,
   CASE WHEN s.value IS NULL THEN 'source missing' WHEN t.value IS NULL THEN 'target missing'
     WHEN s.value <> t.value THEN 'different' ELSE 'match' END AS verdict
   FROM {left} s FULL OUTER JOIN {right} t USING (row_key, family, qualifier, ts))"""


def _rank_sql(source: str) -> str:
    return f"""(SELECT row_key, family, qualifier, row_number() OVER
   (PARTITION BY row_key,family,qualifier ORDER BY ts DESC) AS ts, value FROM {source})"""


DIFF = "SELECT row_key,family,qualifier,ts,source_value,target_value,verdict FROM diff WHERE verdict<>'match'"
COUNTS = """, per_row AS (SELECT row_key, count(*) AS n, count(*) FILTER (verdict='source missing') AS s,
   count(*) FILTER (verdict='target missing') AS t, count(*) FILTER (verdict='different') AS d FROM diff GROUP BY 1)
 SELECT count(*) FILTER (s+t+d>0) AS rows_with_diffs, count(*) FILTER (s=n) AS source_missing_rows,
   count(*) FILTER (t=n) AS target_missing_rows, CAST(sum(s) AS BIGINT) AS source_missing_cells,
   CAST(sum(t) AS BIGINT) AS target_missing_cells, CAST(sum(d) AS BIGINT) AS different_values FROM per_row"""


def _shown(diff: DataFrame) -> DataFrame:
    return diff.select(
        text("row").alias("row_key"),
        "family",
        text("qualifier").alias("qualifier"),
        "ts",
        text("source_value").alias("source_value"),
        text("target_value").alias("target_value"),
        "verdict",
    )


@query("cell_diff", f"{HEAD}, {_diff_sql('cells', 'mirror')} {DIFF}")
def cell_diff(spark, sf_dir):
    return _shown(c.cell_diff(event_cells(spark, sf_dir), mirror_cells(spark, sf_dir)))


@query("cell_diff_counts", f"{HEAD}, {_diff_sql('cells', 'mirror')} {COUNTS}")
def cell_diff_counts(spark, sf_dir):
    return c.cell_diff_counts(event_cells(spark, sf_dir), mirror_cells(spark, sf_dir))


def _values_differ(part: int, differences) -> int:
    """A detector that deals with cells both sides have."""
    return sum(verdict == c.DIFFERENT for verdict in differences.column("verdict").to_pylist())


@query(
    "mismatch_delivery",
    f"""{HEAD}, {_diff_sql('cells', 'mirror')}, told AS ({DIFF})
SELECT count(*) AS differences, count(*) FILTER (verdict='{c.DIFFERENT}') AS handled FROM told""",
)
def mismatch_delivery(spark, sf_dir):
    """Every difference is handed to a detector, in tasks."""
    diff = c.cell_diff(event_cells(spark, sf_dir), mirror_cells(spark, sf_dir))
    told = c.deliver(diff, _values_differ)
    return told.agg(F.sum("differences").alias("differences"), F.sum("handled").alias("handled"))


@query("cell_diff_ignore_ts", f"{HEAD}, {_diff_sql(_rank_sql('cells'), _rank_sql('mirror'))} {DIFF}")
def cell_diff_ignore_ts(spark, sf_dir):
    return _shown(
        c.cell_diff(event_cells(spark, sf_dir), mirror_cells(spark, sf_dir), ignore_timestamps=True)
    )


@query(
    "cell_diff_report",
    f"""{HEAD}, {_diff_sql('cells', 'mirror')} SELECT verdict, CASE WHEN strlen(row_key)>4
  THEN substr(hex(row_key),1,4)||'...'||right(hex(row_key),4) ELSE hex(row_key) END AS row_hex, count(*) AS cells
FROM diff WHERE verdict<>'match' GROUP BY 1,2""",
)
def cell_diff_report(spark, sf_dir):
    """Differences per row, keys shown as shortened hex."""
    diff = c.cell_diff(event_cells(spark, sf_dir), mirror_cells(spark, sf_dir))
    return diff.groupBy("verdict", short_hex(F.col("row"), 4).alias("row_hex")).agg(
        F.count(F.lit(1)).alias("cells")
    )


@query("sync_repair", f"WITH {SQL_CELLS} {SHOW} FROM cells")
def sync_repair(spark, sf_dir):
    """The mirror after repair is the source."""
    repaired = c.repair(event_cells(spark, sf_dir), mirror_cells(spark, sf_dir), dry_run=False)
    return text_view(repaired)


@query(
    "sync_repair_puts_only",
    f"{HEAD} {SHOW} FROM cells UNION ALL {SHOW} FROM mirror m WHERE NOT EXISTS (SELECT 1 FROM cells c WHERE "
    "c.row_key=m.row_key AND c.family=m.family AND c.qualifier=m.qualifier AND c.ts=m.ts)",
)
def sync_repair_puts_only(spark, sf_dir):
    repaired = c.repair(
        event_cells(spark, sf_dir), mirror_cells(spark, sf_dir), dry_run=False, deletes=False
    )
    return text_view(repaired)


ROW_TEXT = "string_agg(family||'/'||qualifier||'/'||ts||'/'||value, ',' ORDER BY family,qualifier,ts DESC)"


def _verdict_sql(left: str, right: str) -> str:
    return f"""l AS (SELECT row_key, {ROW_TEXT} AS x FROM {left} GROUP BY 1),
 r AS (SELECT row_key, {ROW_TEXT} AS y FROM {right} GROUP BY 1),
 verdicts AS (SELECT row_key, CASE WHEN x IS NULL THEN 'source missing' WHEN y IS NULL THEN 'target missing'
   WHEN x = y THEN 'match' ELSE 'different' END AS verdict FROM l FULL OUTER JOIN r USING (row_key))"""


@query("rows_equal", f"{HEAD}, {_verdict_sql('cells', 'mirror')} SELECT row_key, verdict='match' AS equal FROM verdicts")
def rows_equal(spark, sf_dir):
    verdicts = c.compare_rows(event_cells(spark, sf_dir), mirror_cells(spark, sf_dir))
    return verdicts.select(text("row").alias("row_key"), (F.col("verdict") == c.MATCH).alias("equal"))


@query("scan_verify", f"{HEAD}, {_verdict_sql('cells', 'mirror')} SELECT verdict, count(*) AS rows FROM verdicts GROUP BY 1")
def scan_verify(spark, sf_dir):
    verdicts = c.compare_rows(event_cells(spark, sf_dir), mirror_cells(spark, sf_dir))
    return c.verdict_counts(verdicts)


SHARE = int(0.4 * 2**32)


def _sample(source: str) -> str:
    return f"(SELECT * FROM {source} WHERE CAST('0x'||substr(md5(row_key),1,8) AS BIGINT) < {SHARE})"


def _newest_sql(source: str) -> str:
    return f"""(SELECT * FROM {source} QUALIFY row_number() OVER
 (PARTITION BY row_key,family,qualifier ORDER BY ts DESC)=1)"""


@query(
    "verify_sample",
    f"""{HEAD}, sc AS {_sample('cells')}, sm AS {_sample('mirror')},
 a AS (WITH {_verdict_sql('sc', 'sm')} SELECT 'scan' AS operation, verdict FROM verdicts),
 g AS (WITH {_verdict_sql(_newest_sql('sc'), _newest_sql('sm'))} SELECT 'get' AS operation, verdict FROM verdicts)
SELECT operation, count(*) FILTER (verdict='match') AS matches, count(*) FILTER (verdict<>'match') AS mismatches
FROM (SELECT * FROM a UNION ALL SELECT * FROM g) GROUP BY 1""",
)
def verify_sample(spark, sf_dir):
    """A share of the reads is replayed on the mirror: gets of newest versions, scans of all."""
    picked = hash_share(F.col("row"), 0.4)
    source = event_cells(spark, sf_dir).where(picked)
    target = mirror_cells(spark, sf_dir).where(picked)
    kinds = {"scan": lambda cells: cells.select(*CELL), "get": newest}
    counts = [
        c.compare_rows(read(source), read(target)).select(F.lit(kind).alias("operation"), "verdict")
        for kind, read in kinds.items()
    ]
    ok = F.col("verdict") == c.MATCH
    return (
        reduce(DataFrame.unionByName, counts)
        .groupBy("operation")
        .agg(F.count_if(ok).alias("matches"), F.count_if(~ok).alias("mismatches"))
    )


@query(
    "reconcile_batches",
    f"""WITH {SQL_CELLS}, {SQL_ACTIONS}, judged AS (SELECT seq,
  NOT (op IN ('MERGE','DELETE_FAMILY','DELETE_VERSION') OR (op='PUT' AND value IS NULL)) AS p,
  NOT (op IN ('MERGE','GET') OR (op='PUT' AND coalesce(value,'9') >= '9')) AS s FROM actions)
SELECT seq, CASE WHEN p AND s THEN 'none' WHEN p THEN 'secondary' WHEN s THEN 'primary' ELSE 'both' END AS failed_on FROM judged""",
)
def reconcile_batches(spark, sf_dir):
    """The second copy never sees gets, and refuses other operations than the first."""
    log = actions(spark, sf_dir)
    primary = log.select("seq", m.problem().isNull().alias("ok"))
    refused = (F.col("op") == "MERGE") | (
        (F.col("op") == m.PUT) & (F.coalesce("value", F.lit(b"9")) >= F.lit(b"9"))
    )
    secondary = log.where(F.col("op") != m.GET).select("seq", (~refused).alias("ok"))
    return c.reconcile(primary, secondary)
