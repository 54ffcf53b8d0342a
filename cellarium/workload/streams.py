"""Replication of a change log, dual writes, streaming counters."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellarium.model import CELL_SCHEMA, bytes_lit, text
from cellarium.operators import mutate as m
from cellarium.plans.scratch import new_path
from cellarium.streaming import changes as ch
from cellarium.streaming import jobs as st
from cellarium.workload.mutations import shown
from cellarium.workload.registry import query
from cellarium.workload.tables import (
    LATEST,
    LOOP_TAG,
    ORIGIN_TAG,
    SQL_CELLS,
    SQL_ENTRIES,
    entries,
    entries_of,
    event_stream,
    sql_walk,
    sql_bundles,
)

HEAD = f"WITH {SQL_CELLS}, {SQL_ENTRIES}"

# The translation in SQL; the family delete window is five minutes.
SQL_CLASSIFIED = f"""{HEAD}, looped AS (SELECT entry FROM entry_cells WHERE qualifier='{LOOP_TAG}'),
 judged AS (SELECT *, entry IN (SELECT entry FROM looped) AS looped,
   type='DELETE_COLUMN' OR (type='DELETE' AND ts<>{LATEST}) OR (type='DELETE_FAMILY' AND ts={LATEST}) AS valid,
   type='DELETE_FAMILY' AND written>=ts AND written-ts<=300000 AS near, type LIKE 'DELETE%' AS del FROM entry_cells),
 classified AS (SELECT *, CAST(entry AS HUGEINT)*2147483648+place AS seq, CASE WHEN looped THEN NULL WHEN type='PUT' THEN 'PUT'
   WHEN type='DELETE' AND valid THEN 'DELETE_VERSION' WHEN type='DELETE_COLUMN' AND ts={LATEST} THEN 'DELETE_COLUMN'
   WHEN type='DELETE_COLUMN' THEN 'DELETE_COLUMN_TO' WHEN type='DELETE_FAMILY' AND (valid OR near) THEN 'DELETE_FAMILY' END AS op,
   NOT looped AND ts>=9223372036854775 AND ts<>{LATEST} AS overflow, NOT looped AND type='PUT' AND ts>written AS future,
   NOT looped AND del AND NOT valid AS bad_delete, NOT looped AND type='INCREMENT' AS unknown FROM judged)"""


def _classified(spark, sf_dir):
    return ch.classify(entries(spark, sf_dir), LOOP_TAG)


@query(
    "repl_loop_filter",
    f"""{HEAD} SELECT entry, "table", count(*) AS cells FROM entry_cells WHERE entry NOT IN
 (SELECT entry FROM entry_cells WHERE qualifier='{LOOP_TAG}') GROUP BY 1,2""",
)
def repl_loop_filter(spark, sf_dir):
    kept = ch.entry_filter(entries(spark, sf_dir), ~ch.came_back(LOOP_TAG))
    return kept.select("entry", "table", F.size("cells").cast("bigint").alias("cells"))


@query(
    "repl_classify",
    SQL_CLASSIFIED
    + ' SELECT CAST(seq AS VARCHAR) AS seq, "table", row_key, type, op, looped, overflow, future, bad_delete, unknown FROM classified',
)
def repl_classify(spark, sf_dir):
    return _classified(spark, sf_dir).select(
        F.col("seq").cast("string").alias("seq"), "table", text("row").alias("row_key"), "type", "op",
        "looped", "overflow", "future", "bad_delete", "unknown",
    )


@query(
    "repl_family_delete",
    SQL_CLASSIFIED
    + """ SELECT CAST(seq AS VARCHAR) AS seq, ts, written, op IS NOT NULL AS kept FROM classified WHERE type='DELETE_FAMILY' AND NOT looped""",
)
def repl_family_delete(spark, sf_dir):
    classified = _classified(spark, sf_dir)
    return classified.where((F.col("type") == "DELETE_FAMILY") & ~F.col("looped")).select(
        F.col("seq").cast("string").alias("seq"), "ts", "written", F.col("op").isNotNull().alias("kept")
    )


@query(
    "repl_future_puts",
    SQL_CLASSIFIED
    + """ SELECT "table", future, overflow, count(*) AS puts FROM classified WHERE op='PUT' GROUP BY 1,2,3""",
)
def repl_future_puts(spark, sf_dir):
    puts = _classified(spark, sf_dir).where(F.col("op") == m.PUT)
    return puts.groupBy("table", "future", "overflow").agg(F.count(F.lit(1)).alias("puts"))


@query(
    "repl_tag",
    SQL_CLASSIFIED
    + """, kept AS (SELECT * FROM classified WHERE op IS NOT NULL)
SELECT "table", row_key, arg_max(family, seq) AS family, CAST(max(seq)+1 AS VARCHAR) AS seq FROM kept GROUP BY 1,2""",
)
def repl_tag(spark, sf_dir):
    tags = ch.origin_tags(ch.to_log(_classified(spark, sf_dir)), ORIGIN_TAG)
    seq = F.col("seq").cast("string").alias("seq")
    return tags.select("table", text("row").alias("row_key"), "family", seq)


METRICS_SQL = """ SELECT metric, n FROM (SELECT count(*) FILTER (unknown) AS incompatible_mutations,
  count(*) FILTER (bad_delete) AS incompatible_deletes, count(*) FILTER (op IS NULL AND NOT looped) AS dropped_mutations,
  count(*) FILTER (overflow) AS timestamp_overflows, count(*) FILTER (future) AS puts_in_future,
  count(DISTINCT entry) FILTER (NOT looped) AS both_ways_eligible_entries, count(*) FILTER (NOT looped) AS both_ways_eligible_mutations,
  count(DISTINCT entry) FILTER (looped) AS both_ways_ineligible_entries,
  count(*) FILTER (looped) - count(DISTINCT entry) FILTER (looped) AS both_ways_ineligible_mutations FROM classified)
 UNPIVOT (n FOR metric IN (*))"""


@query("repl_metrics", SQL_CLASSIFIED + METRICS_SQL)
def repl_metrics(spark, sf_dir):
    return ch.metrics(_classified(spark, sf_dir), both_ways=True)


@query(
    "repl_metrics_one_way",
    f"""{HEAD}, c AS (SELECT count(DISTINCT entry) AS one_way_eligible_entries, count(*) AS one_way_eligible_mutations FROM entry_cells)
 SELECT metric, n FROM c UNPIVOT (n FOR metric IN (*))""",
)
def repl_metrics_one_way(spark, sf_dir):
    counted = ch.metrics(ch.classify(entries(spark, sf_dir)), both_ways=False)
    return counted.where(F.col("metric").startswith("one_way"))


@query("repl_dry_run", SQL_CLASSIFIED + METRICS_SQL)
def repl_dry_run(spark, sf_dir):
    """The counters of a stream that is classified but not written."""
    stream = entries_of(event_stream(spark, sf_dir))
    counters = st.dry_run(stream, new_path(spark, "progress"), LOOP_TAG)
    return spark.createDataFrame(list(counters.items()), "metric string, n bigint")


@query(
    "repl_entry_filter",
    f"""{HEAD} SELECT entry, count(*) AS cells FROM entry_cells WHERE "table"='web' AND family='nav' AND row_key<'u00100'
 AND entry NOT IN (SELECT entry FROM entry_cells WHERE type='INCREMENT') GROUP BY 1""",
)
def repl_entry_filter(spark, sf_dir):
    kept = ch.entry_filter(
        entries(spark, sf_dir),
        F.col("table") == "web",
        F.element_at("cells", 1)["row"] < bytes_lit("u00100"),
        ~F.exists("cells", lambda cell: cell["type"] == "INCREMENT"),
    )
    kept = ch.keep_families(kept, ["nav"])
    return kept.select("entry", F.size("cells").cast("bigint").alias("cells"))


@query(
    "repl_batches",
    SQL_CLASSIFIED.replace("WITH", "WITH RECURSIVE", 1)
    + """, rows AS (SELECT "table", row_key, CAST(sum(coalesce(24+length(row_key)+length(family)+length(qualifier)+length(value),0)) AS BIGINT) AS bytes,
   count(*) AS cells FROM classified WHERE op IS NOT NULL GROUP BY 1,2),
 """
    + sql_bundles("placed", "rows", '"table"', "row_key", {"bytes": 50_000, "cells": 700})
    + """ SELECT "table", bundle AS batch, count(*) AS rows, CAST(sum(cells) AS BIGINT) AS cells FROM placed GROUP BY 1,2""",
)
def repl_batches(spark, sf_dir):
    log = ch.to_log(_classified(spark, sf_dir))
    return ch.batches(log, 50_000, 700).groupBy("table", "batch").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("cells").alias("cells")
    )


def _replayed_sql(log: str, name: str = "log") -> str:
    return f"""{name} AS ({log}), puts AS (SELECT * FROM {name} WHERE op='PUT'),
 live AS (SELECT p.* FROM puts p WHERE NOT EXISTS (SELECT 1 FROM {name} d WHERE d."table"=p."table" AND d.row_key=p.row_key
  AND d.family=p.family AND d.seq>p.seq AND (d.op='DELETE_FAMILY' OR (d.qualifier=p.qualifier AND (d.op='DELETE_COLUMN'
   OR (d.op='DELETE_COLUMN_TO' AND p.ts<=d.ts) OR (d.op='DELETE_VERSION' AND p.ts=d.ts)))))),
 state AS (SELECT "table", row_key, family, qualifier, ts, arg_max(value, seq) AS value FROM live GROUP BY ALL)"""


@query(
    "replicate_stream",
    f"""{SQL_CLASSIFIED}, {_replayed_sql("SELECT * FROM classified WHERE op IS NOT NULL")}
SELECT row_key, family, qualifier, ts, value FROM state""",
)
def replicate_stream(spark, sf_dir):
    """Both tables after the whole log went through the stream."""
    copy = st.Copy(spark, new_path(spark, "copy"))
    stream = entries_of(event_stream(spark, sf_dir))
    st.replicate(stream, copy, new_path(spark, "progress"), LOOP_TAG, ORIGIN_TAG)
    return shown(copy.read("web").unionByName(copy.read("shop")))


def mutations_of(events):
    """All cells of all entries as a stream of mutations of one table."""
    cells = entries_of(events).select("entry", F.posexplode("cells").alias("place", "c"))
    kind, last = F.col("c.qualifier").cast("string"), F.col("c.ts") == LATEST
    counter = (F.col("c.family") == "tx") & (kind == "purchase")
    op = (
        F.when(F.col("c.type") == "DELETE_FAMILY", m.DELETE_FAMILY)
        .when((F.col("c.type") == "DELETE_COLUMN") & last, m.DELETE_COLUMN)
        .when(F.col("c.type") == "DELETE_COLUMN", m.DELETE_COLUMN_TO)
        .when(F.col("c.type") == "DELETE", m.DELETE_VERSION)
        .when(F.col("c.type") == "PUT", F.when(counter, m.INCREMENT).otherwise(m.PUT))
        .otherwise("MERGE")
    )
    increment = counter & (F.col("c.type") == "PUT")
    return cells.select(
        F.lit("events").alias("table"), "c.row", "c.family",
        F.when(counter, F.lit(b"total")).otherwise(F.col("c.qualifier")).alias("qualifier"),
        F.when(F.col("c.type") == "DELETE_FAMILY", F.lit(LATEST)).otherwise(F.col("c.ts")).alias("ts"),
        F.when(~increment, F.col("c.value")).alias("value"),
        (F.col("entry") * 4 + F.col("place")).alias("seq"), op.alias("op"),
        F.when(increment, F.col("c.value").cast("string").cast("bigint")).alias("amount"),
    )


SQL_MUTATIONS = f"""{HEAD.replace("WITH", "WITH RECURSIVE", 1)}, muts AS (SELECT 'events' AS "table", row_key, family,
  CASE WHEN counter THEN 'total' ELSE qualifier END AS qualifier,
  CASE WHEN type='DELETE_FAMILY' THEN {LATEST} ELSE ts END AS ts, CASE WHEN NOT (counter AND type='PUT') THEN value END AS value,
  entry*4 + place AS seq,
  CASE type WHEN 'DELETE_FAMILY' THEN 'DELETE_FAMILY'
    WHEN 'DELETE_COLUMN' THEN CASE WHEN ts={LATEST} THEN 'DELETE_COLUMN' ELSE 'DELETE_COLUMN_TO' END
    WHEN 'DELETE' THEN 'DELETE_VERSION' WHEN 'PUT' THEN CASE WHEN counter THEN 'INCREMENT' ELSE 'PUT' END ELSE 'MERGE' END AS op,
  CASE WHEN counter AND type='PUT' THEN CAST(value AS BIGINT) END AS amount
  FROM (SELECT *, family='tx' AND qualifier='purchase' AS counter FROM entry_cells)),
 good AS (SELECT * FROM muts WHERE op<>'MERGE' AND NOT (op='DELETE_VERSION' AND ts={LATEST})),
 base AS (SELECT row_key, family, qualifier, ts, value FROM muts WHERE false), {sql_walk("good", "base")},
 offered AS (SELECT * FROM good WHERE op<>'INCREMENT' UNION ALL
  SELECT 'events', row_key, family, qualifier, ts, value, seq, 'PUT', NULL FROM images)"""
REFUSED_SQL = "op='PUT' AND qualifier='click' AND value >= '9'"


def _refuses():
    """The second copy takes no clicks with a value from 9 up."""
    bad = (
        (F.col("op") == m.PUT)
        & (F.col("qualifier") == bytes_lit("click"))
        & (F.col("value") >= bytes_lit("9"))
    )
    return F.when(bad, F.lit("value out of range"))


def _dual(spark, sf_dir, stream=None, **how):
    primary, secondary = (st.Copy(spark, new_path(spark, side)) for side in ("first", "second"))
    letters = new_path(spark, "letters")
    stream = mutations_of(event_stream(spark, sf_dir)) if stream is None else stream
    progress = new_path(spark, "progress")
    st.dual_write(stream, primary, secondary, letters, progress, _refuses(), **how)
    return primary, secondary, letters


@query(
    "dual_write",
    f"""{SQL_MUTATIONS}, {_replayed_sql(f"SELECT * FROM offered WHERE NOT ({REFUSED_SQL})")}
SELECT row_key, family, qualifier, ts, value FROM state""",
)
def dual_write(spark, sf_dir):
    """The second copy after all writes, less what it refused."""
    _, secondary, _ = _dual(spark, sf_dir)
    return shown(secondary.read("events"))


LARGEST_PUT = 100


@query(
    "dual_write_concurrent",
    f"""{SQL_MUTATIONS}, odd AS (SELECT * REPLACE (CASE WHEN op<>'PUT' THEN value WHEN seq%13=0 THEN NULL
   WHEN seq%17=0 THEN repeat(value, 40) ELSE value END AS value) FROM muts WHERE op NOT IN ('INCREMENT','MERGE')),
 taken AS (SELECT * FROM odd WHERE op<>'PUT' OR (value IS NOT NULL AND
   20+strlen(row_key)+strlen(family)+strlen(qualifier)+strlen(value) <= {LARGEST_PUT})),
 {_replayed_sql(f"SELECT * FROM taken WHERE NOT ({REFUSED_SQL})")}
SELECT row_key, family, qualifier, ts, value FROM state""",
)
def dual_write_concurrent(spark, sf_dir):
    """The second copy where both are written at once; counters are left out of the stream.

    Some puts are empty and some too large: neither copy gets them.
    """
    stream = mutations_of(event_stream(spark, sf_dir)).where(F.col("op") != m.INCREMENT)
    value = F.when(F.col("op") != m.PUT, F.col("value")).when(F.col("seq") % 13 == 0, F.lit(None))
    value = value.when(F.col("seq") % 17 == 0, F.repeat(F.decode("value", "UTF-8"), 40).cast("binary"))
    stream = stream.withColumn("value", value.otherwise(F.col("value")))
    _, secondary, _ = _dual(spark, sf_dir, stream, concurrent=True, max_put_bytes=LARGEST_PUT)
    return shown(secondary.read("events"))


@query(
    "dead_letter_replay",
    f"""{SQL_MUTATIONS}, {_replayed_sql("SELECT * FROM offered")}
SELECT row_key, family, qualifier, ts, value FROM state""",
)
def dead_letter_replay(spark, sf_dir):
    """The second copy once the failure log is added back at its place in the order."""
    _, secondary, letters = _dual(spark, sf_dir)
    lost = st.read_dead_letters(spark, letters)
    log = secondary.log().drop("batch_id").unionByName(lost).drop("table")
    return shown(m.replay(spark.createDataFrame([], CELL_SCHEMA), log))


@query(
    "stream_counters",
    f"""{SQL_MUTATIONS} SELECT row_key, qualifier, CAST(sum(amount) AS BIGINT) AS total FROM muts WHERE op='INCREMENT' GROUP BY 1,2""",
)
def stream_counters(spark, sf_dir):
    """Totals of all increments, kept up to date by a stream."""
    path = new_path(spark, "totals")
    increments = mutations_of(event_stream(spark, sf_dir)).where(F.col("op") == m.INCREMENT)
    st.count_stream(increments, path, new_path(spark, "progress"))
    totals = st.read_counts(spark, path)
    return totals.select(text("row").alias("row_key"), text("qualifier").alias("qualifier"), "total")


@query(
    "stream_newest",
    f"""{SQL_MUTATIONS}, {_replayed_sql("SELECT * FROM offered")}
SELECT row_key, family, qualifier, ts, value FROM state
QUALIFY row_number() OVER (PARTITION BY row_key, family, qualifier ORDER BY ts DESC)=1""",
)
def stream_newest(spark, sf_dir):
    """The newest version of every column, by a stream of puts, deletes and increments."""
    path = new_path(spark, "newest")
    st.follow(mutations_of(event_stream(spark, sf_dir)), path, new_path(spark, "progress"))
    return shown(st.read_newest(spark, path))
