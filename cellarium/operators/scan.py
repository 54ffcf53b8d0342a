"""Reads of a cell table."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellarium.functions.bytewise import in_time_range
from cellarium.model import CELL, as_bytes
from cellarium.operators.filters import Filter, newest
from cellarium.plans.keyspace import KeySet, is_point
from cellarium.plans.scratch import settle
from cellarium.plans.skew import attach, first_rows, running

ALL_VERSIONS = None
# More spans than this are joined instead of written into the predicate.
PREDICATE_SPANS = 200
# Up to this many spans a record finds its own by comparing keys.
SEARCHED_SPANS_SETTING = "spark.cellarium.searchedSpans"
SEARCHED_SPANS_DEFAULT = 200


@dataclass(frozen=True)
class ScanSpec:
    """What to read.  ``columns`` maps a family to qualifiers, or to None for all."""

    rows: KeySet = field(default_factory=KeySet.all)
    columns: dict[str, list[bytes | str] | None] | None = None
    time_range: tuple[int | None, int | None] | None = None
    max_versions: int | None = 1
    filter: Filter | None = None
    family_time_ranges: dict[str, tuple[int | None, int | None]] | None = None
    reverse: bool = False
    limit: int | None = None


def scan(cells: DataFrame, spec: ScanSpec | None = None, **changes) -> DataFrame:
    """Cells selected by ``spec``, unordered; ``sort_cells`` gives scan order.

    The steps run in this order, since value filters must only see the versions
    the limit left:  [time range,] version limit, columns, filter, family time
    ranges, row limit.  A time range comes before the version limit.  The column
    choice commutes with the version limit and is made first to cut the input.
    """
    spec = replace(spec or ScanSpec(), **changes)
    rows = spec.rows
    if spec.filter is not None:
        rows = rows.intersect(spec.filter.keys())
    if not rows.is_all():
        cells = restrict_rows(cells, rows)
    if spec.columns is not None:
        cells = project(cells, spec.columns)
    if spec.time_range is not None:
        cells = cells.where(in_time_range(F.col("ts"), *spec.time_range))
    if spec.max_versions is not None:
        cells = newest(cells, spec.max_versions)
    if spec.filter is not None:
        cells = spec.filter.apply(cells, spec.reverse)
    if spec.family_time_ranges is not None:
        cells = family_time_ranges(cells, spec.family_time_ranges)
    if spec.limit is not None:
        cells = first_rows(cells, spec.limit, spec.reverse)
    return cells


def restrict_rows(cells: DataFrame, rows: KeySet) -> DataFrame:
    if len(rows.spans) <= PREDICATE_SPANS:
        return cells.where(rows.test(F.col("row")))
    spark = cells.sparkSession
    cells = cells.where(KeySet([rows.bounds()]).test(F.col("row")))
    if all(is_point(span) for span in rows.spans):
        keys = spark.createDataFrame([(span.start,) for span in rows.spans], "row binary")
        return attach(cells, keys, ["row"], "left_semi")
    # The row keys, not the cells, are put between the bounds.
    spans = spark.createDataFrame(
        [(span.start, span.stop) for span in rows.spans], "span_start binary, span_stop binary"
    )
    placed = locate(cells.select("row").distinct(), "row", spans)
    inside = F.col("span_stop").isNull() | (F.col("row") < F.col("span_stop"))
    keys = settle(placed.where(F.col("span_start").isNotNull() & inside).select("row"), "rows")
    return attach(cells, keys, ["row"], "left_semi")


def searched_spans(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(SEARCHED_SPANS_SETTING, str(SEARCHED_SPANS_DEFAULT)))


def locate(df: DataFrame, key: str, spans: DataFrame) -> DataFrame:
    """Gives every record the span that starts at or before its key.

    ``spans`` has span_start and further columns, and at most one span per start.  Up to
    ``spark.cellarium.searchedSpans`` of them are searched by every record where it lies.  More are
    merged with the records in key order and the newest span is carried forward, so there is no
    condition-only join and no pair of record and span is ever formed except the right one.
    """
    few = searched_spans(df)
    starts = spans.orderBy("span_start").limit(few + 1).toArrow()
    if starts.num_rows <= few:
        return _search(df, key, spans, starts)
    payload = F.struct(*[F.col(name) for name in spans.columns]).alias("_span")
    records = df.select(F.col(key).alias("_key"), F.lit(1).alias("_kind"),
                        F.struct(*df.columns).alias("_rec"),
                        F.lit(None).cast(spans.select(payload).schema[0].dataType).alias("_span"))
    starts = spans.select(F.col("span_start").alias("_key"), F.lit(0).alias("_kind"),
                          F.lit(None).cast(records.schema["_rec"].dataType).alias("_rec"),
                          payload)
    merged = running(
        records.unionByName(starts),
        [],
        [F.col("_key").asc(), F.col("_kind").asc()],
        {"_found": ("last", F.col("_span"))},
    )
    return merged.where("_kind = 1").select("_rec.*", "_found.*")


def _search(df: DataFrame, key: str, spans: DataFrame, found) -> DataFrame:
    """Binary search among the starts, as nested comparisons that give a span's place."""
    starts = found.column("span_start").to_pylist()

    def place(first: int, last: int) -> Column:
        """The place of the last start at or before the key; -1 if all lie after it."""
        if first == last:
            return F.lit(first - 1)
        middle = (first + last) // 2
        below = F.col(key) < F.lit(bytes(starts[middle]))
        return F.when(below, place(first, middle)).otherwise(place(middle + 1, last))

    numbered = [(k, *row.values()) for k, row in enumerate(found.to_pylist())]
    schema = T.StructType([T.StructField("_place", T.IntegerType()), *spans.schema.fields])
    listed = df.sparkSession.createDataFrame(numbered, schema)
    placed = df.withColumn("_place", place(0, len(starts)))
    return placed.join(F.broadcast(listed), "_place", "left").drop("_place")


def project(cells: DataFrame, columns: dict[str, list[bytes | str] | None]) -> DataFrame:
    """Union of whole families and single columns."""
    wanted = F.lit(False)
    for family, qualifiers in columns.items():
        test = F.col("family") == family
        if qualifiers is not None:
            test = test & F.col("qualifier").isin(*[as_bytes(q) for q in qualifiers])
        wanted = wanted | test
    return cells.where(wanted)


def family_time_ranges(cells: DataFrame, ranges: dict) -> DataFrame:
    """Each listed family has its own range; other families are dropped."""
    wanted = F.lit(False)
    for family, (start, stop) in ranges.items():
        wanted = wanted | (
            (F.col("family") == family) & in_time_range(F.col("ts"), start, stop)
        )
    return cells.where(wanted)


def get_row(cells: DataFrame, key: bytes | str, spec: ScanSpec | None = None) -> DataFrame:
    return scan(cells, spec or ScanSpec(), rows=KeySet.point(key))


def multi_get(
    cells: DataFrame, requests: DataFrame, spec: ScanSpec | None = None
) -> DataFrame:
    """One request per (request, row); a key without cells comes back with nulls.

    Requests of one filter are answered together, by one join.
    """
    wanted = attach(cells, requests.select("row").distinct(), ["row"], "left_semi")
    # Read twice below; the cells of a requested hot row are met by its requests in many tasks.
    got = settle(scan(wanted, spec), "got")
    found = attach(got, requests, ["row"], "inner").select("request", *CELL)
    missed = requests.join(got.select("row").distinct(), ["row"], "left_anti")
    blank = [F.lit(None).cast(got.schema[c].dataType).alias(c) for c in CELL if c != "row"]
    return found.unionByName(missed.select("request", "row", *blank))


def exists_all(cells: DataFrame, requests: DataFrame, spec: ScanSpec | None = None) -> DataFrame:
    """One answer per request.  Values are never read unless the filter needs them."""
    wanted = attach(cells, requests.select("row").distinct(), ["row"], "left_semi")
    present = scan(wanted, spec).select("row").distinct().withColumn("_hit", F.lit(True))
    return requests.join(present, ["row"], "left").select(
        "request", "row", F.coalesce("_hit", F.lit(False)).alias("found")
    )


def page(
    cells: DataFrame, size: int, after: bytes | str | None = None, spec: ScanSpec | None = None
) -> DataFrame:
    """The next ``size`` rows strictly after a key."""
    spec = spec or ScanSpec()
    if after is not None:
        spec = replace(spec, rows=spec.rows.intersect(resume_after(after, spec.reverse)))
    return scan(cells, spec, limit=size)


def resume_after(key: bytes | str, reverse: bool = False) -> KeySet:
    key = as_bytes(key)
    return KeySet.between(stop=key) if reverse else KeySet.between(start=key + b"\x00")


def reversed_rows(
    start: bytes | str = b"",
    stop: bytes | str = b"",
    start_inclusive: bool = True,
    stop_inclusive: bool = False,
) -> KeySet:
    """Bounds of a reversed scan: it begins at the larger key."""
    return KeySet.between(stop, start, stop_inclusive, start_inclusive)


def as_of(cells: DataFrame, ts: int) -> DataFrame:
    """The table as it stood at ``ts``: newest version at or before it."""
    return scan(cells, time_range=(None, ts + 1), max_versions=1)


def estimated_size(cells: DataFrame, rows: KeySet) -> DataFrame:
    """Cells and bytes in a key range."""
    sizes = [F.octet_length(name) for name in ("row", "family", "qualifier", "value")]
    total = sizes[0].cast("bigint") + sizes[1] + sizes[2] + sizes[3] + 8
    return restrict_rows(cells, rows).agg(
        F.count(F.lit(1)).alias("cells"),
        F.coalesce(F.sum(total), F.lit(0)).alias("bytes"),
    )

