"""Cell tables and change logs derived from the given Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellarium.functions.bytewise import long_to_bytes
from cellarium.model import CELL, LATEST, from_wide
from cellarium.plans.skew import tune

SQL_CELLS = """cells AS (SELECT printf('u%05d', user_id) AS row_key,
  CASE WHEN event_type IN ('purchase','signup') THEN 'tx' ELSE 'nav' END AS family,
  event_type AS qualifier, epoch_us(ts)//1000 AS ts,
  CAST(CAST(round(value*100) AS BIGINT) AS VARCHAR) AS value, event_id AS seq FROM events)"""

SQL_LATEST = """latest AS (SELECT * FROM cells QUALIFY row_number() OVER
  (PARTITION BY row_key,family,qualifier ORDER BY ts DESC)=1)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tune(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def millis(column: str):
    """Whole milliseconds since 1970 of a timestamp without zone, in any session zone."""
    day = F.unix_date(F.to_date(column)) * F.lit(86_400_000).cast("bigint")
    second = F.hour(column) * 3600 + F.minute(column) * 60
    fraction = F.floor(F.date_part(F.lit("SECOND"), F.col(column)) * 1000).cast("bigint")
    return day + second * 1000 + fraction


def user_key(column: str):
    """``u`` and the number, padded to five digits."""
    number = F.col(column).cast("string")
    padded = F.when(F.length(number) < 5, F.lpad(number, 5, "0")).otherwise(number)
    return F.concat(F.lit("u"), padded).cast("binary")


def event_cells(spark: SparkSession, sf_dir: str, seq: bool = False) -> DataFrame:
    """One version per event: a user's row, two families, five qualifiers."""
    events = table(spark, sf_dir, "events")
    cells = events.select(
        user_key("user_id").alias("row"),
        F.when(F.col("event_type").isin("purchase", "signup"), "tx").otherwise("nav").alias("family"),
        F.col("event_type").cast("binary").alias("qualifier"),
        millis("ts").alias("ts"),
        F.round(F.col("value") * 100).cast("bigint").cast("string").cast("binary").alias("value"),
        F.col("event_id").alias("seq"),
    )
    return cells if seq else cells.select(*CELL)


ORDER_COLUMNS = ["o_custkey", "o_orderstatus", "o_orderpriority"]

SQL_ORDER_CELLS = """order_cells AS (
  SELECT lpad(CAST(o_orderkey AS VARCHAR),10,'0') AS row_key, 'o' AS family, u.q AS qualifier,
    epoch_us(o_orderdate)//1000 AS ts, u.v AS value
  FROM orders, unnest([{'q':'o_custkey','v':CAST(o_custkey AS VARCHAR)},
    {'q':'o_orderstatus','v':o_orderstatus},{'q':'o_orderpriority','v':o_orderpriority},
    {'q':'o_cents','v':CAST(CAST(round(o_totalprice*100) AS BIGINT) AS VARCHAR)}]) AS t(u)
  WHERE u.v IS NOT NULL)"""


def order_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One wide row per order, a single version of four columns."""
    orders = table(spark, sf_dir, "orders")
    columns = {("o", name): F.col(name) for name in ORDER_COLUMNS}
    columns[("o", "o_cents")] = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return from_wide(
        orders,
        F.lpad(F.col("o_orderkey").cast("string"), 10, "0"),
        columns,
        millis("o_orderdate"),
    )


def line_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as cells: one row per order, one qualifier per line and column."""
    lines = table(spark, sf_dir, "lineitem")
    names = ["l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_quantity"]
    values = [
        F.struct(
            F.concat_ws("#", F.lit(name), F.col("l_linenumber").cast("string"))
            .cast("binary")
            .alias("qualifier"),
            (F.col(name).cast("bigint") if name == "l_quantity" else F.col(name))
            .cast("string")
            .cast("binary")
            .alias("value"),
        )
        for name in names
    ]
    return lines.select(
        F.lpad(F.col("l_orderkey").cast("string"), 10, "0").cast("binary").alias("row"),
        F.lit("l").alias("family"),
        millis("l_shipdate").alias("ts"),
        F.inline(F.array(*values)),
    ).select(*CELL)


# ---- change logs ------------------------------------------------------------

SPLIT = 1704844800000  # 2024-01-10: earlier events are the stored table, later ones the log

SQL_COUNTERS = """counters AS (SELECT printf('u%05d', c_custkey) AS row_key, 'tx' AS family,
  'total' AS qualifier, CAST(0 AS BIGINT) AS ts, CAST(round(c_acctbal*100) AS BIGINT) AS n FROM customer)"""


def counter_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored counter per customer, at timestamp 0."""
    return table(spark, sf_dir, "customer").select(
        user_key("c_custkey").alias("row"),
        F.lit("tx").alias("family"),
        F.lit(b"total").alias("qualifier"),
        F.lit(0).cast("bigint").alias("ts"),
        long_to_bytes(F.round(F.col("c_acctbal") * 100).cast("bigint")).alias("value"),
    )


def stored_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_cells(spark, sf_dir).where(F.col("ts") < SPLIT)


DAY = 86_400_000


def sql_log(since: int) -> str:
    return f"""stored AS (SELECT row_key,family,qualifier,ts,value FROM cells WHERE ts < {since}),
late AS (SELECT row_key, qualifier AS kind, ts, value, seq AS id FROM cells WHERE ts >= {since}),
log AS (
 SELECT row_key, CASE WHEN kind IN ('purchase','signup') THEN 'tx'
     WHEN kind='error' AND id%4=3 AND id%12<>3 THEN 'tx' ELSE 'nav' END AS family,
   CASE WHEN kind='purchase' THEN 'total' WHEN kind='signup' THEN 'log' WHEN kind<>'error' THEN kind
     WHEN id%4=0 THEN 'view' WHEN id%4=2 THEN 'click' END AS qualifier,
   CASE WHEN kind='error' AND id%4<>0 THEN {LATEST} ELSE ts END AS ts,
   CASE WHEN kind IN ('view','click','signup') THEN value END AS value, id*2 AS seq,
   CASE WHEN kind IN ('view','click') THEN 'PUT' WHEN kind='purchase' THEN 'INCREMENT'
     WHEN kind='signup' THEN 'APPEND' WHEN id%4=0 THEN 'DELETE_COLUMN_TO' WHEN id%4=1 THEN 'DELETE_FAMILY'
     WHEN id%4=2 THEN 'DELETE_COLUMN' WHEN id%12=3 THEN 'DELETE_ROW' ELSE 'DELETE_FAMILY' END AS op,
   CASE WHEN kind='purchase' THEN CAST(value AS BIGINT) END AS amount
 FROM late
 UNION ALL
 SELECT row_key, 'nav', 'view', ts, NULL, id*2 + CASE WHEN id%10=0 THEN 1 ELSE -1 END, 'DELETE_VERSION', NULL
 FROM late WHERE kind='view' AND id%10 IN (0,5)
 UNION ALL
 SELECT row_key, 'tx', CASE WHEN kind='purchase' THEN 'total' ELSE 'log' END,
   CASE id%10 WHEN 3 THEN ts - {3 * DAY} WHEN 9 THEN ts + 1 ELSE ts END,
   CASE WHEN id%10 IN (3,9) THEN CAST(id AS VARCHAR) END, id*2 + 1,
   CASE id%10 WHEN 5 THEN 'DELETE_VERSION' WHEN 7 THEN 'DELETE_COLUMN_TO' ELSE 'PUT' END, NULL
 FROM late WHERE kind IN ('purchase','signup') AND id%10 IN (3,5,7,9))"""


SQL_LOG = sql_log(SPLIT)


def mutation_log(spark: SparkSession, sf_dir: str, since: int = SPLIT) -> DataFrame:
    """Later events as mutations of every kind.

    Views and clicks are puts, purchases increments, signups appends, errors deletes;
    some views are deleted again right after (or, without effect, right before) they
    are put.  Some increments and appends are followed by a put of an older or a newer
    version of their column, by a delete of the version they wrote, or of all up to it.
    """
    events = event_cells(spark, sf_dir, seq=True).where(F.col("ts") >= since)
    kind, number = F.col("qualifier").cast("string"), F.col("seq")
    error, turn = kind == "error", F.col("seq") % 4
    none = F.lit(None)
    main = F.struct(
        F.when(kind.isin("purchase", "signup"), "tx")
        .when(error & (turn == 3) & (number % 12 != 3), "tx")
        .otherwise("nav")
        .alias("family"),
        F.when(kind == "purchase", "total")
        .when(kind == "signup", "log")
        .when(~error, kind)
        .when(turn == 0, "view")
        .when(turn == 2, "click")
        .cast("binary")
        .alias("qualifier"),
        F.when(error & (turn != 0), F.lit(LATEST)).otherwise(F.col("ts")).alias("ts"),
        F.when(kind.isin("view", "click", "signup"), F.col("value")).alias("value"),
        (number * 2).alias("seq"),
        F.when(kind.isin("view", "click"), "PUT")
        .when(kind == "purchase", "INCREMENT")
        .when(kind == "signup", "APPEND")
        .when(turn == 0, "DELETE_COLUMN_TO")
        .when(turn == 1, "DELETE_FAMILY")
        .when(turn == 2, "DELETE_COLUMN")
        .when(number % 12 == 3, "DELETE_ROW")
        .otherwise("DELETE_FAMILY")
        .alias("op"),
        F.when(kind == "purchase", F.col("value").cast("string").cast("bigint")).alias("amount"),
    )
    point = F.struct(
        F.lit("nav").alias("family"),
        F.lit(b"view").alias("qualifier"),
        F.col("ts"),
        none.cast("binary").alias("value"),
        (number * 2 + F.when(number % 10 == 0, 1).otherwise(-1)).alias("seq"),
        F.when((kind == "view") & (number % 10).isin(0, 5), "DELETE_VERSION").alias("op"),
        none.cast("bigint").alias("amount"),
    )
    digit, counter = number % 10, kind == "purchase"
    written = F.when(counter, long_to_bytes(number)).otherwise(number.cast("string").cast("binary"))
    after = F.struct(
        F.lit("tx").alias("family"),
        F.when(counter, "total").otherwise("log").cast("binary").alias("qualifier"),
        (F.col("ts") + F.when(digit == 3, -3 * DAY).when(digit == 9, 1).otherwise(0)).alias("ts"),
        F.when(digit.isin(3, 9), written).alias("value"),
        (number * 2 + 1).alias("seq"),
        F.when(
            kind.isin("purchase", "signup") & digit.isin(3, 5, 7, 9),
            F.when(digit == 5, "DELETE_VERSION").when(digit == 7, "DELETE_COLUMN_TO").otherwise("PUT"),
        ).alias("op"),
        none.cast("bigint").alias("amount"),
    )
    return events.select("row", F.inline(F.array(main, point, after))).where(F.col("op").isNotNull())


def sql_walk(log: str, base: str) -> str:
    """CTEs up to ``images``: what each increment and append of ``log`` writes.

    Every such column is taken through its events in order, with the list of its live
    versions; ``base`` are cells with values as text.
    """
    same = "x.row_key=y.row_key AND x.family=y.family AND x.qualifier=y.qualifier"
    newest = "list_max(x.vs)"
    at = f"greatest(y.ts, coalesce({newest}.ts, y.ts))"
    value = f"""CASE y.op WHEN 'INCREMENT' THEN CAST(CAST(coalesce({newest}.v,'0') AS BIGINT) + y.amount AS VARCHAR)
      ELSE coalesce({newest}.v,'') || y.value END"""
    return f"""walked AS (SELECT DISTINCT row_key,family,qualifier FROM {log} WHERE op IN ('INCREMENT','APPEND')),
steps AS (SELECT w.row_key, w.family, w.qualifier, d.seq, d.op, d.ts, d.value, d.amount,
   row_number() OVER (PARTITION BY w.row_key, w.family, w.qualifier ORDER BY d.seq) AS n
  FROM walked w JOIN {log} d ON d.row_key=w.row_key AND (d.op='DELETE_ROW' OR (d.family=w.family AND (d.op='DELETE_FAMILY'
   OR (d.qualifier=w.qualifier AND d.op IN ('PUT','INCREMENT','APPEND','DELETE_COLUMN','DELETE_COLUMN_TO','DELETE_VERSION')))))),
walk AS (SELECT w.row_key, w.family, w.qualifier, CAST(0 AS BIGINT) AS n, CAST(-1 AS BIGINT) AS seq, '' AS op, CAST(NULL AS BIGINT) AS wts,
   CAST(NULL AS VARCHAR) AS result, coalesce((SELECT list({{'ts': b.ts, 'v': b.value}}) FROM {base} b WHERE b.row_key=w.row_key
    AND b.family=w.family AND b.qualifier=w.qualifier), CAST([] AS STRUCT(ts BIGINT, v VARCHAR)[])) AS vs FROM walked w
 UNION ALL
 SELECT y.row_key, y.family, y.qualifier, y.n, y.seq, y.op, {at}, {value}, CASE
   WHEN y.op='PUT' THEN list_append(list_filter(x.vs, lambda z: z.ts<>y.ts), {{'ts': y.ts, 'v': y.value}})
   WHEN y.op='DELETE_VERSION' THEN list_filter(x.vs, lambda z: z.ts<>y.ts)
   WHEN y.op='DELETE_COLUMN_TO' THEN list_filter(x.vs, lambda z: z.ts>y.ts)
   WHEN y.op IN ('INCREMENT','APPEND') THEN list_append(list_filter(x.vs, lambda z: z.ts<>{at}), {{'ts': {at}, 'v': {value}}})
   ELSE CAST([] AS STRUCT(ts BIGINT, v VARCHAR)[]) END
 FROM walk x JOIN steps y ON {same} AND y.n = x.n + 1),
images AS (SELECT row_key, family, qualifier, wts AS ts, result AS value, seq, op FROM walk WHERE op IN ('INCREMENT','APPEND'))"""


# ---- a second copy of the event table, with every kind of difference ---------

SQL_MIRROR = """mirror AS (
  SELECT row_key,family,qualifier,ts, CASE WHEN seq%97=0 THEN CAST(CAST(value AS BIGINT)+1 AS VARCHAR) ELSE value END AS value
    FROM cells WHERE CAST(substr(row_key,2) AS BIGINT)%15<>3 AND seq%89<>0
  UNION ALL SELECT row_key,family,qualifier,ts+1,value FROM cells
    WHERE seq%101=0 AND CAST(substr(row_key,2) AS BIGINT)%15<>3
  UNION ALL SELECT 'z'||row_key,family,qualifier,ts,value FROM cells WHERE seq%1999=7)"""


def mirror_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows missing, cells missing, values changed, cells added, rows added."""
    cells = event_cells(spark, sf_dir, seq=True)
    user = F.substring(F.col("row").cast("string"), 2, 9).cast("bigint")
    seq, value = F.col("seq"), F.col("value")
    more = (value.cast("string").cast("bigint") + 1).cast("string").cast("binary")
    copied = F.struct(
        (user % 15 != 3) & (seq % 89 != 0),
        F.col("row"),
        F.col("ts"),
        F.when(seq % 97 == 0, more).otherwise(value).alias("value"),
    )
    added = F.struct((user % 15 != 3) & (seq % 101 == 0), F.col("row"), F.col("ts") + 1, value)
    foreign = F.struct(seq % 1999 == 7, F.concat(F.lit(b"z"), F.col("row")), F.col("ts"), value)
    versions = F.array(*[v.cast("struct<keep:boolean,row:binary,ts:bigint,value:binary>")
                         for v in (copied, added, foreign)])
    return cells.select("family", "qualifier", F.inline(versions)).where("keep").select(*CELL)


# ---- exported cells with delete markers -------------------------------------

SQL_TYPED = f"""typed AS (SELECT row_key, family, CASE WHEN qualifier='error' THEN 'view' ELSE qualifier END AS qualifier,
  ts, value, CASE WHEN qualifier<>'error' THEN 'PUT' ELSE
    ['DELETE','DELETE_FAMILY_VERSION','DELETE_COLUMN','DELETE_FAMILY'][1 + seq%4] END AS type, seq FROM (
  SELECT row_key, family, qualifier, CASE WHEN qualifier IN ('error','view') AND seq%4 < 2 THEN ts - ts%43200000
    WHEN qualifier='error' AND ts >= 1704326400000 THEN ts - {30 * DAY} ELSE ts END AS ts, value, seq FROM cells) e)"""


def typed_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as exported cells: errors become delete markers of the four kinds.

    Exact markers, and half of the views, have timestamps cut to half a day, so that
    some meet; markers that reach back do so from the first days, later ones from a month before.
    """
    cells = event_cells(spark, sf_dir, seq=True)
    error, turn = F.col("qualifier") == F.lit(b"error"), F.col("seq") % 4
    half_day = (error | (F.col("qualifier") == F.lit(b"view"))) & (turn < 2)
    kinds = ["DELETE", "DELETE_FAMILY_VERSION", "DELETE_COLUMN", "DELETE_FAMILY"]
    marker = F.element_at(F.array(*[F.lit(kind) for kind in kinds]), (turn + 1).cast("int"))
    return cells.select(
        "row",
        "family",
        F.when(error, F.lit(b"view")).otherwise(F.col("qualifier")).alias("qualifier"),
        F.when(half_day, F.col("ts") - F.col("ts") % 43200000)
        .when(error & (F.col("ts") >= 1704326400000), F.col("ts") - 30 * DAY)
        .otherwise(F.col("ts"))
        .alias("ts"),
        "value",
        F.when(error, marker).otherwise("PUT").alias("type"),
        "seq",
    )


def document_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as large cells: one row per source and language, one cell per document."""
    return table(spark, sf_dir, "documents").select(
        F.concat_ws("/", "lang", "source").cast("binary").alias("row"),
        F.lit("d").alias("family"),
        F.lpad(F.col("doc_id").cast("string"), 9, "0").cast("binary").alias("qualifier"),
        F.col("n_chars").alias("ts"),
        F.col("text").cast("binary").alias("value"),
    )


SQL_DOCS = """docs AS (SELECT lang||'/'||source AS row_key, 'd' AS family, lpad(CAST(doc_id AS VARCHAR),9,'0') AS qualifier,
  n_chars AS ts, text AS value, 24+strlen(lang||'/'||source)+1+9+strlen(text) AS bytes, strlen(text) AS len FROM documents)"""


# ---- change-log entries -----------------------------------------------------

LOOP_TAG, ORIGIN_TAG = "FROM_COPY", "FROM_MAIN"

SQL_ENTRIES = f"""raw AS (SELECT row_key, family, qualifier AS kind, ts, value, seq AS id,
   CASE WHEN seq%53=0 THEN ts-1000 ELSE ts + (seq%7)*60000 END AS written FROM cells),
 main AS (SELECT id AS entry, CASE WHEN family='tx' THEN 'shop' ELSE 'web' END AS "table", written, 0 AS place, row_key, family,
   CASE WHEN kind<>'error' THEN kind WHEN id%4 IN (0,1) THEN 'view' ELSE '' END AS qualifier,
   CASE WHEN kind<>'error' THEN 'PUT' ELSE ['DELETE','DELETE_COLUMN','DELETE_FAMILY','INCREMENT'][1+id%4] END AS type,
   CASE WHEN id%59=0 THEN 9223372036854775 + id WHEN kind='error' AND id%4=0 AND id%3=0 THEN {LATEST} ELSE ts END AS ts,
   CASE WHEN kind<>'error' THEN value END AS value FROM raw),
 entry_cells AS (SELECT * FROM main
  UNION ALL SELECT id, 'shop', written, 1, row_key, 'tx', 'purchase', 'DELETE_COLUMN', {LATEST}, NULL FROM raw WHERE kind='signup'
  UNION ALL SELECT id, CASE WHEN family='tx' THEN 'shop' ELSE 'web' END, written, CASE WHEN kind='signup' THEN 2 ELSE 1 END,
   row_key, family, '{LOOP_TAG}', 'DELETE', 0, NULL FROM raw WHERE id%11=0)"""


def entries_of(events: DataFrame) -> DataFrame:
    """Events as log entries; works on a stream of events too.

    Signups also delete the purchases; errors are deletes of several kinds and one
    unknown kind; some entries carry the loop tag, come before their own cells, or
    have a timestamp past the supported range.
    """
    number, kind = F.col("event_id"), F.col("event_type")
    row = user_key("user_id")
    shop = kind.isin("purchase", "signup")
    family = F.when(shop, "tx").otherwise("nav")
    ts, turn, error = millis("ts"), number % 4, kind == "error"
    none = F.lit(None).cast("binary")
    value = F.round(F.col("value") * 100).cast("bigint").cast("string").cast("binary")
    kinds = F.array(*[F.lit(k) for k in ("DELETE", "DELETE_COLUMN", "DELETE_FAMILY", "INCREMENT")])
    main = F.struct(
        row.alias("row"),
        family.alias("family"),
        F.when(~error, kind).when(turn < 2, "view").otherwise("").cast("binary").alias("qualifier"),
        F.when(~error, "PUT").otherwise(F.element_at(kinds, (turn + 1).cast("int"))).alias("type"),
        F.when(number % 59 == 0, number + 9223372036854775)
        .when(error & (turn == 0) & (number % 3 == 0), F.lit(LATEST))
        .otherwise(ts)
        .alias("ts"),
        F.when(~error, value).alias("value"),
    )

    def extra(test, family, qualifier, kind, ts):
        cell = F.struct(
            row.alias("row"), family.alias("family"), F.lit(qualifier).cast("binary").alias("qualifier"),
            F.lit(kind).alias("type"), F.lit(ts).cast("bigint").alias("ts"), none.alias("value"),
        )
        return F.when(test, F.array(cell)).otherwise(F.array().cast(f"array<{cell_type}>"))

    # Joined arrays are compiled; dropping nulls from one array would evaluate all cells one by one.
    cell_type = "struct<row:binary,family:string,qualifier:binary,type:string,ts:bigint,value:binary>"
    cells = F.concat(
        F.array(main),
        extra(kind == "signup", F.lit("tx"), "purchase", "DELETE_COLUMN", LATEST),
        extra(number % 11 == 0, family, LOOP_TAG, "DELETE", 0),
    )
    written = F.when(number % 53 == 0, ts - 1000).otherwise(ts + number % 7 * 60000)
    return events.select(
        number.alias("entry"),
        F.when(shop, "shop").otherwise("web").alias("table"),
        written.alias("written"),
        cells.alias("cells"),
    )


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entries_of(table(spark, sf_dir, "events"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table as a stream of its files.

    The path is written as a pattern because a stream does not take a plain file.
    """
    schema = table(spark, sf_dir, "events").schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 64)
    return reader.parquet(f"{sf_dir}/events.parque[t]")


def sql_bundles(name: str, source: str, key: str, order: str, limits: dict[str, int]) -> str:
    """``source`` with ``bundle``: numbers from 0 in each key, closed by the row that fills a bundle.

    One step of the recursion per bundle: the next one ends where a sum from its first row on reaches a limit.
    """
    sums = ", ".join(f"sum({c}) OVER w AS upto_{c}" for c in limits)
    none = ", ".join("0" for _ in limits)
    full = " OR ".join(f"o.upto_{c} >= p.upto_{c} + {limit}" for c, limit in limits.items())
    return f"""{name}_rows AS (SELECT *, {key} AS _key, row_number() OVER w AS _at, {sums} FROM {source}
   WINDOW w AS (PARTITION BY {key} ORDER BY {order} ROWS UNBOUNDED PRECEDING)),
 {name}_ends AS (SELECT _key, max(_at) AS _end FROM {name}_rows GROUP BY 1),
 {name}_sums AS (SELECT _key, _at, {", ".join(f"upto_{c}" for c in limits)} FROM {name}_rows
   UNION ALL SELECT _key, 0, {none} FROM {name}_ends),
 {name}_cuts(_key, bundle, _first, _last) AS (
  SELECT _key, CAST(-1 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM {name}_ends
  UNION ALL
  SELECT c._key, c.bundle + 1, c._last + 1, coalesce(min(o._at), min(e._end)) FROM {name}_cuts c
   JOIN {name}_ends e ON e._key = c._key AND c._last < e._end
   JOIN {name}_sums p ON p._key = c._key AND p._at = c._last
   LEFT JOIN {name}_sums o ON o._key = c._key AND o._at > c._last AND ({full})
   GROUP BY c._key, c.bundle, c._last),
 {name} AS (SELECT r.*, c.bundle FROM {name}_rows r JOIN {name}_cuts c
   ON c._key = r._key AND r._at BETWEEN c._first AND c._last AND c.bundle >= 0)"""
