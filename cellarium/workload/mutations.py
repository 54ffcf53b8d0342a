"""Mutations, conditional mutations, retention."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellarium.functions.bytewise import bytes_to_long, put_cell_size
from cellarium.model import CELL, CELL_SCHEMA, COLUMN, LATEST, bytes_lit, text, text_view
from cellarium.operators import mutate as m
from cellarium.operators.conditional import check_and_mutate
from cellarium.plans.keyspace import KeySet
from cellarium.workload.registry import query
from cellarium.workload.tables import (
    DAY,
    SPLIT,
    SQL_CELLS,
    SQL_COUNTERS,
    SQL_LOG,
    counter_cells,
    event_cells,
    mutation_log,
    sql_log,
    sql_walk,
    stored_cells,
    table,
    user_key,
)

HEAD = f"WITH {SQL_CELLS}, {SQL_LOG} "
# With every event in the log and nothing stored before.
HEAD_ALL = f"WITH {SQL_CELLS}, {sql_log(0)} "
SHOW = "SELECT row_key,family,qualifier,ts,value "


@query(
    "apply_puts",
    HEAD
    + """, puts AS (SELECT row_key,family,qualifier,ts,value,-1 AS seq FROM stored UNION ALL
  SELECT row_key,family,qualifier,ts - ts%86400000,value,seq FROM log WHERE op='PUT')
SELECT row_key,family,qualifier,ts,arg_max(value,seq) AS value FROM puts GROUP BY 1,2,3,4""",
)
def apply_puts(spark, sf_dir):
    """Log timestamps are cut to the day, so versions are written more than once."""
    log = m.only(mutation_log(spark, sf_dir), m.PUT)
    daily = log.withColumn("ts", F.col("ts") - F.col("ts") % 86400000)
    return shown(m.apply_puts(stored_cells(spark, sf_dir), daily))


@query(
    "put_size_check",
    """SELECT lang, 20 + strlen(CAST(doc_id AS VARCHAR)) + 1 + strlen(lang) + strlen(text) > 4096 AS refused,
  count(*) AS n FROM documents GROUP BY 1, 2""",
)
def put_size_check(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    puts = documents.select(
        F.col("doc_id").cast("string").cast("binary").alias("row"),
        F.lit("d").alias("family"),
        F.col("lang").cast("binary").alias("qualifier"),
        F.col("text").cast("binary").alias("value"),
    )
    return puts.groupBy(text("qualifier").alias("lang"), (put_cell_size() > 4096).alias("refused")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _covered(op: str, match: str) -> str:
    return f"""{HEAD}, v AS (SELECT *, -1 AS seq FROM stored) {SHOW} FROM v p WHERE NOT EXISTS
  (SELECT 1 FROM log d WHERE d.op='{op}' AND d.row_key=p.row_key AND {match})"""


def _deletes(name: str, op: str, match: str) -> None:
    @query(name, _covered(op, match))
    def run(spark, sf_dir):
        log = m.only(mutation_log(spark, sf_dir), op)
        return text_view(m.apply_deletes(stored_cells(spark, sf_dir), log))


_deletes("delete_row", m.DELETE_ROW, "true")
_deletes("delete_family", m.DELETE_FAMILY, "d.family=p.family")
_deletes("delete_column", m.DELETE_COLUMN, "d.family=p.family AND d.qualifier=p.qualifier")


@query(
    "delete_column_to",
    f"""{HEAD}, v AS (SELECT row_key,family,qualifier,ts,value,-1 AS seq FROM stored UNION ALL
  SELECT row_key,family,qualifier,ts,value,seq FROM log WHERE op='PUT')
SELECT row_key,family,qualifier,ts,value FROM v p WHERE NOT EXISTS (SELECT 1 FROM log d
  WHERE d.op='DELETE_COLUMN_TO' AND d.row_key=p.row_key AND d.family=p.family AND d.qualifier=p.qualifier
  AND p.ts<=d.ts AND d.seq>p.seq)""",
)
def delete_column_to(spark, sf_dir):
    log = m.only(mutation_log(spark, sf_dir), m.PUT, m.DELETE_COLUMN_TO)
    return shown(m.replay(stored_cells(spark, sf_dir), log))


@query(
    "delete_version",
    f"""{HEAD}, v AS (SELECT row_key,family,qualifier,ts,value,-1 AS seq FROM stored UNION ALL
  SELECT row_key,family,qualifier,ts,value,seq FROM log WHERE op='PUT')
SELECT row_key,family,qualifier,ts,value FROM v p WHERE NOT EXISTS (SELECT 1 FROM log d
  WHERE d.op='DELETE_VERSION' AND d.row_key=p.row_key AND d.family=p.family AND d.qualifier=p.qualifier
  AND p.ts=d.ts AND d.seq>p.seq)""",
)
def delete_version(spark, sf_dir):
    log = m.only(mutation_log(spark, sf_dir), m.PUT, m.DELETE_VERSION)
    return shown(m.replay(stored_cells(spark, sf_dir), log))


SQL_BASE = f"""{SQL_COUNTERS},
base AS (SELECT row_key,family,qualifier,ts,value FROM stored
  UNION ALL SELECT row_key,family,qualifier,ts,CAST(n AS VARCHAR) FROM counters),
{sql_walk("log", "base")}"""


@query(
    "increment",
    f"""WITH RECURSIVE {SQL_CELLS}, {sql_log(0)}, {SQL_BASE}
SELECT row_key, ts, CAST(value AS BIGINT) AS n, seq FROM images WHERE op='INCREMENT'""",
)
def increment(spark, sf_dir):
    images = m.increments(counter_cells(spark, sf_dir), mutation_log(spark, sf_dir, since=0))
    return images.select(text("row").alias("row_key"), "ts", bytes_to_long(F.col("value")).alias("n"), "seq")


@query(
    "append",
    f"""WITH RECURSIVE {SQL_CELLS}, {SQL_LOG}, {SQL_BASE}
SELECT row_key, ts, value, seq FROM images WHERE op='APPEND'""",
)
def append(spark, sf_dir):
    images = m.appends(stored_cells(spark, sf_dir), mutation_log(spark, sf_dir))
    return images.select(text("row").alias("row_key"), "ts", text("value").alias("value"), "seq")


def shown(cells):
    """Counters as numbers, everything else as text."""
    value = F.when(
        F.col("qualifier") == bytes_lit("total"), bytes_to_long(F.col("value")).cast("string")
    ).otherwise(text("value"))
    return cells.select(
        text("row").alias("row_key"), "family", text("qualifier").alias("qualifier"), "ts",
        value.alias("value"),
    )


@query(
    "after_image_puts",
    f"""WITH RECURSIVE {SQL_CELLS}, {SQL_LOG}, {SQL_BASE}
SELECT row_key,family,qualifier,ts,value FROM images""",
)
def after_image_puts(spark, sf_dir):
    base = stored_cells(spark, sf_dir).unionByName(counter_cells(spark, sf_dir))
    return shown(m.after_images(base, mutation_log(spark, sf_dir)))


SQL_REPLAY = f"""WITH RECURSIVE {SQL_CELLS}, {SQL_LOG}, {SQL_BASE},
puts AS (SELECT row_key,family,qualifier,ts,value,-1 AS seq FROM base
  UNION ALL SELECT row_key,family,qualifier,ts,value,seq FROM log WHERE op='PUT'
  UNION ALL SELECT row_key,family,qualifier,ts,value,seq FROM images),
live AS (SELECT p.* FROM puts p WHERE NOT EXISTS (SELECT 1 FROM log d WHERE d.row_key=p.row_key AND d.seq>p.seq
  AND (d.op='DELETE_ROW' OR (d.op='DELETE_FAMILY' AND d.family=p.family)
   OR (d.op='DELETE_COLUMN' AND d.family=p.family AND d.qualifier=p.qualifier)
   OR (d.op='DELETE_COLUMN_TO' AND d.family=p.family AND d.qualifier=p.qualifier AND p.ts<=d.ts)
   OR (d.op='DELETE_VERSION' AND d.family=p.family AND d.qualifier=p.qualifier AND p.ts=d.ts)))),
replayed AS (SELECT row_key,family,qualifier,ts,arg_max(value,seq) AS value FROM live GROUP BY 1,2,3,4)"""


@query("replay_mutations", SQL_REPLAY + " SELECT * FROM replayed")
def replay_mutations(spark, sf_dir):
    base = stored_cells(spark, sf_dir).unionByName(counter_cells(spark, sf_dir))
    return shown(m.replay(base, mutation_log(spark, sf_dir)))


@query(
    "row_mutations",
    f"""{HEAD_ALL}, ops AS (SELECT * FROM log WHERE op IN ('PUT','DELETE_FAMILY','DELETE_VERSION')),
live AS (SELECT p.* FROM ops p WHERE op='PUT' AND NOT EXISTS (SELECT 1 FROM ops d WHERE d.row_key=p.row_key
  AND d.seq>p.seq AND ((d.op='DELETE_FAMILY' AND d.family=p.family) OR (d.op='DELETE_VERSION'
   AND d.family=p.family AND d.qualifier=p.qualifier AND p.ts=d.ts))))
SELECT row_key,family,qualifier,ts,value FROM live""",
)
def row_mutations(spark, sf_dir):
    """Ordered puts and deletes on rows that start empty."""
    log = mutation_log(spark, sf_dir, since=0)
    log = m.only(log, m.PUT, m.DELETE_FAMILY, m.DELETE_VERSION)
    return shown(m.replay(spark.createDataFrame([], CELL_SCHEMA), log))


def sql_actions(since: int = 0) -> str:
    return f"""actions AS (SELECT row_key, seq,
  CASE WHEN qualifier IN ('purchase','signup') OR (qualifier='error' AND seq%4=0) THEN 'tx' ELSE 'nav' END AS family,
  CASE WHEN qualifier='purchase' THEN 'total' WHEN qualifier='signup' AND seq%3<>0 THEN 'log' ELSE qualifier END AS qualifier,
  CASE qualifier WHEN 'view' THEN 'GET' WHEN 'click' THEN 'PUT' WHEN 'signup' THEN CASE WHEN seq%3=0 THEN 'PUT' ELSE 'APPEND' END
    WHEN 'purchase' THEN 'INCREMENT' ELSE ['DELETE_FAMILY','DELETE_VERSION','DELETE_ROW','MERGE'][1+seq%4] END AS op,
  CASE WHEN qualifier='click' OR (qualifier='signup' AND seq%3<>0) THEN value END AS value,
  CASE WHEN qualifier='purchase' THEN CAST(value AS BIGINT) END AS amount,
  CASE WHEN qualifier='error' AND seq%4 IN (1,2) THEN {LATEST} ELSE ts END AS ts
  FROM cells WHERE ts >= {since})"""


SQL_ACTIONS = sql_actions()


def actions(spark, sf_dir, since=0):
    """Events as a batch: gets, puts, increments, appends, and every kind of refusal."""
    events = event_cells(spark, sf_dir, seq=True).where(F.col("ts") >= since)
    kind, turn = F.col("qualifier").cast("string"), F.col("seq") % 4
    appended = (kind == "signup") & (F.col("seq") % 3 != 0)
    op = (
        F.when(kind == "view", m.GET)
        .when(appended, m.APPEND)
        .when(kind.isin("click", "signup"), m.PUT)
        .when(kind == "purchase", m.INCREMENT)
        .when(turn == 0, m.DELETE_FAMILY)
        .when(turn == 1, m.DELETE_VERSION)
        .when(turn == 2, m.DELETE_ROW)
        .otherwise("MERGE")
    )
    return events.select(
        "row",
        F.when(kind.isin("purchase", "signup") | ((kind == "error") & (turn == 0)), "tx")
        .otherwise("nav")
        .alias("family"),
        F.when(kind == "purchase", F.lit(b"total"))
        .when(appended, F.lit(b"log"))
        .otherwise(F.col("qualifier"))
        .alias("qualifier"),
        F.when((kind == "error") & turn.isin(1, 2), F.lit(LATEST)).otherwise(F.col("ts")).alias("ts"),
        F.when((kind == "click") | appended, F.col("value")).alias("value"),
        "seq",
        op.alias("op"),
        F.when(kind == "purchase", F.col("value").cast("string").cast("bigint")).alias("amount"),
    )


@query(
    "batch_results",
    f"""WITH RECURSIVE {SQL_CELLS}, {SQL_COUNTERS}, {sql_actions(SPLIT)},
judged AS (SELECT *, CASE WHEN op='MERGE' THEN 'unknown operation' WHEN op='PUT' AND value IS NULL THEN 'empty put'
  WHEN op='DELETE_FAMILY' THEN 'scope delete at a timestamp'
  WHEN op='DELETE_VERSION' THEN 'delete of the single latest version' END AS error FROM actions),
got AS (SELECT a.seq, (SELECT arg_max(c.value, c.ts) FROM cells c WHERE c.ts < {SPLIT} AND c.row_key=a.row_key
    AND c.family=a.family AND c.qualifier=a.qualifier) AS result FROM actions a WHERE op='GET'),
base AS (SELECT row_key,family,qualifier,ts,value FROM cells WHERE ts < {SPLIT}
  UNION ALL SELECT row_key,family,qualifier,ts,CAST(n AS VARCHAR) FROM counters),
good AS (SELECT * FROM judged WHERE error IS NULL AND op<>'GET'), {sql_walk("good", "base")},
res AS (SELECT * FROM got UNION ALL SELECT seq, value FROM images)
SELECT judged.seq, op, error IS NULL AS ok, error, result FROM judged LEFT JOIN res USING (seq)""",
)
def batch_results(spark, sf_dir):
    base = stored_cells(spark, sf_dir).unionByName(counter_cells(spark, sf_dir))
    out = m.batch_results(base, actions(spark, sf_dir, since=SPLIT))
    result = F.when(
        F.col("op") == m.INCREMENT, bytes_to_long(F.col("result")).cast("string")
    ).otherwise(text("result"))
    return out.select("seq", "op", "ok", "error", result.alias("result"))


# ---- conditional mutations --------------------------------------------------

NOW = 1706745600000  # 2024-02-01, after every event


def _flag_put(checks):
    return checks.select(
        "seq",
        "row",
        F.lit("tx").alias("family"),
        F.lit(b"flag").alias("qualifier"),
        F.lit(None).cast("bigint").alias("ts"),
        F.lit(b"hit").alias("value"),
        F.lit(m.PUT).alias("op"),
    )


def _checks(spark, sf_dir, op, expected):
    """One check per customer, on the view column of the user with the same number."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("seq"),
        user_key("c_custkey").alias("row"),
        F.lit("nav").alias("family"),
        F.lit(b"view").alias("qualifier"),
        op.alias("op"),
        expected.cast("binary").alias("expected"),
        F.lit(None).cast("bigint").alias("not_before"),
        F.lit(None).cast("bigint").alias("before"),
    )


SQL_VIEW = f"""view AS (SELECT row_key, arg_max(value, ts) AS stored FROM cells
  WHERE qualifier='view' AND ts < {SPLIT} GROUP BY 1)"""


@query(
    "check_compare_ops",
    f"""WITH {SQL_CELLS}, {SQL_VIEW}, c AS (SELECT c_custkey AS seq, printf('u%05d', c_custkey) AS row_key,
  ['=','!=','<','<=','>','>='][1 + c_custkey%6] AS op FROM customer)
SELECT seq, op, coalesce(CASE op WHEN '=' THEN '5' = stored WHEN '!=' THEN '5' <> stored WHEN '<' THEN '5' < stored
  WHEN '<=' THEN '5' <= stored WHEN '>' THEN '5' > stored ELSE '5' >= stored END, false) AS applied
FROM c LEFT JOIN view USING (row_key)""",
)
def check_compare_ops(spark, sf_dir):
    ops = F.array(*[F.lit(op) for op in ("=", "!=", "<", "<=", ">", ">=")])
    op = F.element_at(ops, (F.col("c_custkey") % 6 + 1).cast("int"))
    checks = _checks(spark, sf_dir, op, F.lit("5"))
    flags, _ = check_and_mutate(stored_cells(spark, sf_dir), checks, _flag_put(checks), NOW)
    return flags.join(checks.select("seq", "op"), ["seq"])


@query(
    "check_absent",
    f"""WITH {SQL_CELLS}, {SQL_VIEW}, c AS (SELECT c_custkey AS seq, printf('u%05d', c_custkey) AS row_key,
  CASE WHEN c_nationkey < 12 THEN '=' ELSE '!=' END AS op FROM customer)
SELECT row_key, 'tx' AS family, 'flag' AS qualifier, CAST({NOW} AS BIGINT) AS ts, 'hit' AS value
FROM c LEFT JOIN view USING (row_key) WHERE (op='=') = (stored IS NULL)""",
)
def check_absent(spark, sf_dir):
    """No expected value: put where the column is absent, or with "!=" present."""
    op = F.when(F.col("c_nationkey") < 12, "=").otherwise("!=")
    checks = _checks(spark, sf_dir, op, F.lit(None).cast("string"))
    _, applied = check_and_mutate(stored_cells(spark, sf_dir), checks, _flag_put(checks), NOW)
    return text_view(applied.select(*CELL))


@query(
    "check_and_put",
    f"""WITH {SQL_CELLS}, best AS (SELECT printf('u%05d', c_custkey) AS row_key,
   CAST(CAST(round(abs(c_acctbal)) AS BIGINT) AS VARCHAR) AS start FROM customer),
c AS (SELECT row_key, seq, value, start, max(value) OVER (PARTITION BY row_key ORDER BY seq
   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM cells LEFT JOIN best USING (row_key))
SELECT seq, coalesce(value > greatest(start, coalesce(prior, '')) AND start IS NOT NULL, false) AS applied FROM c""",
)
def check_and_put(spark, sf_dir):
    """A chain of checks per user: each event raises the user's record if it beats it."""
    base = table(spark, sf_dir, "customer").select(
        user_key("c_custkey").alias("row"),
        F.lit("tx").alias("family"),
        F.lit(b"best").alias("qualifier"),
        F.lit(0).cast("bigint").alias("ts"),
        F.round(F.abs("c_acctbal")).cast("bigint").cast("string").cast("binary").alias("value"),
    )
    events = event_cells(spark, sf_dir, seq=True)
    checks = events.select(
        "seq",
        "row",
        F.lit("tx").alias("family"),
        F.lit(b"best").alias("qualifier"),
        F.lit(">").alias("op"),
        F.col("value").alias("expected"),
        F.lit(None).cast("bigint").alias("not_before"),
        F.lit(None).cast("bigint").alias("before"),
    )
    puts = checks.select(
        "seq", *COLUMN, F.lit(None).cast("bigint").alias("ts"), F.col("expected").alias("value"),
        F.lit(m.PUT).alias("op"),
    )
    return check_and_mutate(base, checks, puts, NOW)[0]


# ---- whole tables -----------------------------------------------------------


@query("drop_prefix", f"WITH {SQL_CELLS} {SHOW} FROM cells WHERE NOT starts_with(row_key,'u0001')")
def drop_prefix(spark, sf_dir):
    return text_view(m.drop_rows(event_cells(spark, sf_dir), KeySet.prefix("u0001")))


@query("drop_family", f"WITH {SQL_CELLS} {SHOW} FROM cells WHERE family <> 'tx'")
def drop_family(spark, sf_dir):
    return text_view(m.drop_families(event_cells(spark, sf_dir), "tx"))


@query(
    "apply_retention",
    f"""WITH {SQL_CELLS}, r AS (SELECT *, row_number() OVER (PARTITION BY row_key,family,qualifier ORDER BY ts DESC) AS n FROM cells)
SELECT row_key,family,qualifier,ts,value FROM r WHERE CASE WHEN family='nav'
  THEN n <= 9 AND (ts >= {NOW - 12 * DAY} OR n <= 2) ELSE ts >= {NOW - 20 * DAY} OR n <= 1 END""",
)
def apply_retention(spark, sf_dir):
    rules = {"nav": (9, 2, 12 * DAY), "tx": (None, 1, 20 * DAY)}
    return text_view(m.apply_retention(event_cells(spark, sf_dir), rules, NOW))


@query(
    "fill_timestamps",
    HEAD_ALL
    + f"""SELECT row_key, seq, op, CASE WHEN op='PUT' AND seq%4=0 THEN {NOW} ELSE ts END AS ts FROM log""",
)
def fill_timestamps(spark, sf_dir):
    log = mutation_log(spark, sf_dir, since=0)
    unset = log.withColumn(
        "ts",
        F.when((F.col("op") == m.PUT) & (F.col("seq") % 4 == 0), F.lit(LATEST)).otherwise(F.col("ts")),
    )
    return m.fill_timestamps(unset, NOW).select(text("row").alias("row_key"), "seq", "op", "ts")


@query(
    "dedup_last",
    f"""{HEAD_ALL} SELECT row_key, qualifier, ts - ts%{DAY} AS day, arg_max(amount, seq) AS amount, max(seq) AS seq
FROM log WHERE op='INCREMENT' GROUP BY 1,2,3""",
)
def dedup_last(spark, sf_dir):
    """Increments of one day are one operation: of a repeated column the last counts."""
    log = m.only(mutation_log(spark, sf_dir, since=0), m.INCREMENT)
    daily = log.select("row", "qualifier", (F.col("ts") - F.col("ts") % DAY).alias("day"), "amount", "seq")
    last = m.last_of_each(daily, ["row", "qualifier", "day"])
    return last.select(
        text("row").alias("row_key"), text("qualifier").alias("qualifier"), "day", "amount", "seq"
    )


@query(
    "mutation_runs",
    f"""WITH {SQL_CELLS}, x AS (SELECT *, qualifier='error' AS del FROM cells),
y AS (SELECT *, CASE WHEN del IS DISTINCT FROM lag(del) OVER w THEN 1 ELSE 0 END AS b FROM x
  WINDOW w AS (PARTITION BY row_key ORDER BY seq)),
z AS (SELECT *, CAST(sum(b) OVER (PARTITION BY row_key ORDER BY seq) AS BIGINT) AS run FROM y)
SELECT row_key, run, any_value(del) AS is_delete, count(*) AS n FROM z GROUP BY 1,2""",
)
def mutation_runs(spark, sf_dir):
    log = event_cells(spark, sf_dir, seq=True)
    is_delete = F.col("qualifier") == bytes_lit("error")
    numbered = m.runs(log, is_delete)
    return numbered.groupBy(text("row").alias("row_key"), "run").agg(
        F.any_value(is_delete).alias("is_delete"), F.count(F.lit(1)).alias("n")
    )


