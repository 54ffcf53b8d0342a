"""Filters, one query per member of the algebra."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellarium.model import VERSION, text_view
from cellarium.operators import filters as f
from cellarium.operators.scan import scan
from cellarium.plans.keyspace import KeySet
from cellarium.workload.registry import query
from cellarium.workload.tables import (
    SQL_CELLS,
    SQL_LATEST,
    SQL_ORDER_CELLS,
    event_cells,
    order_cells,
)

HEAD = f"WITH {SQL_CELLS}, {SQL_LATEST} "
SHOW = "SELECT row_key,family,qualifier,ts,value "
ORDERS = f"WITH {SQL_ORDER_CELLS} "


def _events(name: str, sql: str, make, versions: int | None = 1) -> None:
    query(name, sql)(
        lambda spark, sf_dir: text_view(
            scan(event_cells(spark, sf_dir), filter=make(), max_versions=versions)
        )
    )


def _orders(name: str, sql: str, make) -> None:
    query(name, sql)(
        lambda spark, sf_dir: text_view(
            scan(order_cells(spark, sf_dir), filter=make(), max_versions=None)
        )
    )


def _cell_test(name: str, where: str, make) -> None:
    _events(name, HEAD + SHOW + "FROM latest WHERE " + where, make)


_cell_test("filter_row_eq", "row_key='u00042'", lambda: f.RowIs("u00042"))
_cell_test("filter_row_regex", "regexp_matches(row_key,'0[13]5')", lambda: f.RowFound("0[13]5"))
_cell_test("filter_prefix", "starts_with(row_key,'u0002')", lambda: f.RowPrefix("u0002"))
_cell_test(
    "filter_fuzzy_row",
    "(substr(row_key,1,3)='u00' AND substr(row_key,5,1)='3') OR (substr(row_key,6,1)='9')",
    lambda: f.FuzzyRow(
        [
            ("u00?3", [True, True, True, False, True]),
            ("?????9", [False] * 5 + [True]),
        ]
    ),
)
_cell_test(
    "filter_multi_range",
    "(row_key>='u00003' AND row_key<'u00008') OR (row_key>='u00060' AND row_key<='u00075')",
    lambda: f.RowIn(
        KeySet.between("u00003", "u00008").union(
            KeySet.between("u00060", "u00075", stop_inclusive=True)
        )
    ),
)
_cell_test(
    "filter_random_row",
    f"CAST('0x'||substr(md5(row_key||'s1'),1,8) AS BIGINT) < {int(0.25 * 2**32)}",
    lambda: f.RandomRow(0.25, "s1"),
)
_cell_test(
    "filter_family",
    "family='nav' AND regexp_matches(family,'a')",
    lambda: f.All(f.FamilyIs("nav"), f.FamilyFound("a")),
)
_cell_test(
    "filter_qualifier_cmp",
    "(family='nav' AND qualifier>='error') OR qualifier='signup'",
    lambda: f.Any(f.Qualifier(">=", "error", "nav"), f.Qualifier("=", "signup")),
)
_cell_test(
    "filter_qualifier_regex", "regexp_matches(qualifier,'c[lh]')", lambda: f.QualifierFound("c[lh]")
)
_cell_test("filter_col_prefix", "starts_with(qualifier,'p')", lambda: f.QualifierPrefix(["p"]))
_cell_test(
    "filter_multi_col_prefix",
    "starts_with(qualifier,'cl') OR starts_with(qualifier,'c') OR starts_with(qualifier,'v')",
    lambda: f.QualifierPrefix(["cl", "c", "v"]),
)
_cell_test(
    "filter_col_range",
    "family='nav' AND qualifier>'click' AND qualifier<='view'",
    lambda: f.QualifierRange("nav", "click", False, "view", True),
)
_events(
    "filter_timestamps",
    f"WITH {SQL_CELLS} {SHOW} FROM cells WHERE ts IN (1704067200000,1704153600000) OR ts % 1000 = 0",
    lambda: f.Any(f.Timestamps([1704067200000, 1704153600000]), f.Raw(F.col("ts") % 1000 == 0)),
    None,
)
_events(
    "filter_ts_range",
    f"WITH {SQL_CELLS} {SHOW} FROM cells WHERE ts >= 1704844800000 AND ts < 1705708800000",
    lambda: f.TimeRange(1704844800000, 1705708800000),
    None,
)
_cell_test(
    "filter_value_cmp",
    "(value>='5' AND value<'8') AND value<>'' ",
    lambda: f.All(f.Value(">=", "5"), f.Value("<", "8"), f.Value("!=", "")),
)
_cell_test("filter_value_regex", "regexp_matches(value,'4[0-4]$')", lambda: f.ValueFound("4[0-4]$"))
_cell_test("filter_block", "false", lambda: f.All(f.Pass(), f.Block()))

# ---- row tests --------------------------------------------------------------

PURCHASE = "family='tx' AND qualifier='purchase'"
BY_ROW = "OVER (PARTITION BY row_key)"


def _scv(flag: str, test: str) -> str:
    return f"{HEAD}{SHOW} FROM latest QUALIFY max(CASE WHEN {PURCHASE} THEN CASE WHEN {flag} THEN 1 ELSE 0 END END) {BY_ROW} {test}"


_events(
    "row_filter_scv",
    _scv("value>'5'", "IS DISTINCT FROM 0"),
    lambda: f.ColumnValue("tx", "purchase", f.Value(">", "5")),
)
_events(
    "row_filter_scv_missing",
    _scv("value>'5'", "= 1"),
    lambda: f.ColumnValue("tx", "purchase", f.Value(">", "5"), keep_if_missing=False),
)
_events(
    "row_filter_scv_any_version",
    f"""WITH {SQL_CELLS} {SHOW} FROM cells QUALIFY
  max(CASE WHEN {PURCHASE} THEN CASE WHEN value>'98' THEN 1 ELSE 0 END END) {BY_ROW} IS DISTINCT FROM 0""",
    lambda: f.ColumnValue("tx", "purchase", f.Value(">", "98"), any_version=True),
    None,
)
_events(
    "row_filter_scv_exclude",
    f"SELECT * FROM ({_scv(chr(39) + '5' + chr(39) + '<value', 'IS DISTINCT FROM 0')}) WHERE NOT ({PURCHASE})",
    lambda: f.ColumnValue("tx", "purchase", f.Value(">", "5"), drop_column=True),
)
_events(
    "filter_condition",
    f"""{HEAD}, hit AS (SELECT DISTINCT row_key FROM latest WHERE qualifier='error' AND value<'3')
SELECT row_key,family,qualifier,ts,value FROM latest WHERE CASE WHEN row_key IN (SELECT row_key FROM hit)
  THEN family='nav' ELSE qualifier='purchase' END""",
    lambda: f.Condition(
        f.All(f.Qualifier("=", "error"), f.Value("<", "3")),
        f.FamilyIs("nav"),
        f.Qualifier("=", "purchase"),
    ),
)
_events(
    "filter_while_match",
    f"""{HEAD}, fail AS (SELECT min(row_key) AS k FROM latest WHERE value LIKE '999%')
SELECT row_key,family,qualifier,ts,value FROM latest, fail WHERE k IS NULL OR row_key < k""",
    lambda: f.WhileMatch(f.Raw(~F.col("value").cast("string").startswith("999"))),
)
_events(
    "filter_while_match_positional",
    f"""WITH {SQL_CELLS}, fail AS (SELECT min(row_key) AS k FROM
    (SELECT row_key FROM cells GROUP BY row_key, family, qualifier HAVING count(*) > 20))
SELECT row_key,family,qualifier,ts,value FROM cells, fail WHERE k IS NULL OR row_key < k""",
    lambda: f.WhileMatch(f.Versions(20)),
    None,
)

# ---- positions --------------------------------------------------------------

IN_ROW = "OVER (PARTITION BY row_key ORDER BY family,qualifier,ts DESC)"

_orders(
    "filter_key_only",
    ORDERS + "SELECT row_key,family,qualifier,ts,'' AS value FROM order_cells",
    lambda: f.KeyOnly(),
)
_events(
    "filter_first_key",
    f"WITH {SQL_CELLS} {SHOW} FROM cells QUALIFY row_number() {IN_ROW}=1",
    lambda: f.FirstCells(1),
    None,
)
_events(
    "filter_col_count",
    HEAD + SHOW + f"FROM latest QUALIFY row_number() {IN_ROW}<=2",
    lambda: f.FirstColumns(2),
    None,
)
_orders(
    "filter_col_page",
    ORDERS + SHOW + f"FROM order_cells QUALIFY row_number() {IN_ROW} BETWEEN 2 AND 3",
    lambda: f.ColumnPage(2, offset=1),
)
_orders(
    "filter_col_page_from",
    ORDERS
    + SHOW
    + f"FROM order_cells WHERE qualifier>='o_custkey' QUALIFY row_number() {IN_ROW} <= 2",
    lambda: f.ColumnPage(2, start="o_custkey", family="o"),
)
_events(
    "filter_page",
    HEAD
    + SHOW
    + """FROM latest WHERE value<'3' AND row_key IN
  (SELECT DISTINCT row_key FROM latest WHERE value<'3' ORDER BY 1 LIMIT 25)""",
    lambda: f.All(f.Value("<", "3"), f.RowPage(25)),
)
_events(
    "cells_per_column",
    f"""WITH {SQL_CELLS} {SHOW} FROM cells QUALIFY row_number() OVER
  (PARTITION BY row_key,family,qualifier ORDER BY ts DESC)<=5""",
    lambda: f.Versions(5),
    None,
)
_events(
    "cells_per_row",
    f"WITH {SQL_CELLS} {SHOW} FROM cells QUALIFY row_number() {IN_ROW}<=7",
    lambda: f.FirstCells(7),
    None,
)
_events(
    "cells_per_row_offset",
    f"WITH {SQL_CELLS} {SHOW} FROM cells QUALIFY row_number() {IN_ROW}>30",
    lambda: f.SkipCells(30),
    None,
)

# ---- lists ------------------------------------------------------------------

_events(
    "filter_list_all",
    f"""{HEAD}, first2 AS (SELECT * FROM latest QUALIFY row_number() {IN_ROW}<=2)
SELECT row_key,family,qualifier,ts,value FROM first2 WHERE value > '5'""",
    lambda: f.All(f.FirstColumns(2), f.Value(">", "5")),
)
_events(
    "filter_list_all_turned",
    HEAD + SHOW + f"FROM (SELECT * FROM latest WHERE value > '5') QUALIFY row_number() {IN_ROW}<=2",
    lambda: f.All(f.Value(">", "5"), f.FirstColumns(2)),
)
_events(
    "filter_list_one",
    f"""WITH {SQL_CELLS}, first3 AS (SELECT * FROM cells QUALIFY row_number() {IN_ROW}<=3)
SELECT row_key,family,qualifier,ts,value FROM first3 UNION
SELECT row_key,family,qualifier,ts,value FROM cells WHERE value<'2' OR family='tx'""",
    lambda: f.Any(f.FirstCells(3), f.Value("<", "2"), f.FamilyIs("tx")),
    None,
)
_events(
    "filter_list_nested",
    f"""{HEAD}, a AS (SELECT * FROM (SELECT * FROM latest WHERE family='nav') QUALIFY row_number() {IN_ROW}<=1),
b AS (SELECT * FROM latest WHERE qualifier='signup' OR value>'8')
SELECT row_key,family,qualifier,ts,value FROM a WHERE row_key < 'u00100' UNION
SELECT row_key,family,qualifier,ts,value FROM b WHERE row_key < 'u00100'""",
    lambda: f.All(
        f.RowIn(KeySet.between(stop="u00100")),
        f.Any(
            f.All(f.FamilyIs("nav"), f.FirstCells(1)),
            f.Any(f.Qualifier("=", "signup"), f.Value(">", "8")),
        ),
    ),
)


@query(
    "dedup_cells",
    f"WITH {SQL_CELLS} {SHOW} FROM cells",
)
def dedup_cells(spark, sf_dir):
    """Two reads that overlap in family nav: every cell comes out once."""
    cells = event_cells(spark, sf_dir)
    both = scan(cells, columns={"nav": None}, max_versions=None).unionByName(cells)
    return text_view(both.dropDuplicates(VERSION))
