"""The filter algebra.

A filter is one of

* a cell test: a Column over one cell.  Tests combine with AND/OR and reach the scan;
* a row test, a position or a value change: a DataFrame step over the cell table.

``All`` is a chain (each member sees what the one before left over); ``Any`` gives
every member the same input and unites the results without repeating a cell.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellarium.functions.bytewise import found, hash_share, in_time_range
from cellarium.model import COLUMN, VERSION, as_bytes, bytes_lit, cell_order, version_order
from cellarium.plans.keyspace import KeySet
from cellarium.plans.scratch import settle
from cellarium.plans.skew import attach, first_rows, measured, ranked, topmost

COMPARE = {
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    "=": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    ">=": lambda a, b: a >= b,
    ">": lambda a, b: a > b,
    "none": lambda a, b: F.lit(False),
}


def compare(subject: Column, op: str, value: bytes | str) -> Column:
    """Unsigned byte comparison; the operator "none" lets nothing through."""
    return COMPARE[op](subject, bytes_lit(value))


class Filter:
    def test(self) -> Column | None:
        """The filter as a test of one cell, or None if it is not one."""
        return None

    def keys(self) -> KeySet:
        """Row keys outside this set never pass."""
        return KeySet.all()

    def apply(self, cells: DataFrame, reverse: bool = False) -> DataFrame:
        return cells.where(self.test())


# ---- cell tests -------------------------------------------------------------


@dataclass
class Raw(Filter):
    """Any predicate of the caller's own over the cell columns."""

    predicate: Column

    def test(self):
        return self.predicate


class Pass(Filter):
    def test(self):
        return F.lit(True)


class Block(Filter):
    def test(self):
        return F.lit(False)

    def keys(self):
        return KeySet.none()


@dataclass
class RowIs(Filter):
    key: bytes | str

    def test(self):
        return F.col("row") == bytes_lit(self.key)

    def keys(self):
        return KeySet.point(self.key)


@dataclass
class RowFound(Filter):
    pattern: str

    def test(self):
        return found(F.col("row"), self.pattern)


@dataclass
class RowIn(Filter):
    """Row keys of a set of ranges; a prefix is such a set too."""

    allowed: KeySet

    def test(self):
        return self.allowed.test(F.col("row"))

    def keys(self):
        return self.allowed


def RowPrefix(prefix: bytes | str) -> RowIn:
    return RowIn(KeySet.prefix(prefix))


@dataclass
class FuzzyRow(Filter):
    """Keys matching any (template, fixed positions) pair; longer keys match too."""

    templates: list[tuple[bytes | str, list[bool]]]

    def test(self):
        if not self.templates:
            return F.lit(True)
        return reduce(lambda a, b: a | b, [self._one(*t) for t in self.templates])

    @staticmethod
    def _one(template, fixed):
        template, row = as_bytes(template), F.col("row")
        test = F.octet_length(row) >= len(template)
        at = 0
        while at < len(template):  # one comparison per run of fixed bytes
            end = at
            while end < len(template) and fixed[end]:
                end += 1
            if end > at:
                test = test & (F.substring(row, at + 1, end - at) == F.lit(template[at:end]))
            at = end + 1
        return test

    def keys(self):
        if not self.templates:
            return KeySet.all()
        out = KeySet.none()
        for template, fixed in self.templates:
            lead = fixed.index(False) if False in fixed else len(fixed)
            out = out.union(KeySet.prefix(as_bytes(template)[:lead]))
        return out


@dataclass
class RandomRow(Filter):
    """Whole rows, chosen by a hash of the key: the same rows on every run."""

    chance: float
    seed: str = ""

    def test(self):
        return hash_share(F.col("row"), self.chance, self.seed)


@dataclass
class FamilyIs(Filter):
    name: str

    def test(self):
        return F.col("family") == self.name


@dataclass
class FamilyFound(Filter):
    pattern: str

    def test(self):
        return F.col("family").rlike("(?s)" + self.pattern)


@dataclass
class Qualifier(Filter):
    """Compare the qualifier; with a family, other families do not pass."""

    op: str
    value: bytes | str
    family: str | None = None

    def test(self):
        test = compare(F.col("qualifier"), self.op, self.value)
        return test if self.family is None else (F.col("family") == self.family) & test


@dataclass
class QualifierFound(Filter):
    pattern: str

    def test(self):
        return found(F.col("qualifier"), self.pattern)


@dataclass
class QualifierPrefix(Filter):
    prefixes: list[bytes | str]

    def test(self):
        sets = [KeySet.prefix(p) for p in self.prefixes]
        return reduce(KeySet.union, sets, KeySet.none()).test(F.col("qualifier"))


@dataclass
class QualifierRange(Filter):
    """Qualifiers of one family between two ends; None is unbounded."""

    family: str
    start: bytes | str | None = None
    start_inclusive: bool = True
    stop: bytes | str | None = None
    stop_inclusive: bool = False

    def test(self):
        test = F.col("family") == self.family
        if self.start is not None:
            test = test & compare(
                F.col("qualifier"), ">=" if self.start_inclusive else ">", self.start
            )
        if self.stop is not None:
            test = test & compare(
                F.col("qualifier"), "<=" if self.stop_inclusive else "<", self.stop
            )
        return test


@dataclass
class Timestamps(Filter):
    stamps: list[int]

    def test(self):
        return F.col("ts").isin(*self.stamps) if self.stamps else F.lit(False)


@dataclass
class TimeRange(Filter):
    start: int | None = None
    stop: int | None = None

    def test(self):
        return in_time_range(F.col("ts"), self.start, self.stop)


@dataclass
class Value(Filter):
    op: str
    value: bytes | str

    def test(self):
        return compare(F.col("value"), self.op, self.value)


@dataclass
class ValueFound(Filter):
    pattern: str

    def test(self):
        return found(F.col("value"), self.pattern)


# ---- positions and versions -------------------------------------------------


def newest(cells: DataFrame, n: int = 1) -> DataFrame:
    """The newest n versions of every column."""
    if n == 1:
        # The largest (ts, ...) struct: a partial aggregate leaves one cell per task.
        rest = ["ts", *[name for name in cells.columns if name not in VERSION]]
        picked = cells.groupBy(*COLUMN).agg(F.max(F.struct(*rest)).alias("_new"))
        return picked.select(*COLUMN, "_new.*").select(*cells.columns)
    return topmost(cells, COLUMN, version_order(), n, "_rank").drop("_rank")


@dataclass
class Versions(Filter):
    n: int = 1

    def apply(self, cells, reverse=False):
        return newest(cells, self.n)


@dataclass
class FirstCells(Filter):
    """The first n cells of every row."""

    n: int = 1

    def apply(self, cells, reverse=False):
        return topmost(cells, ["row"], cell_order(), self.n, "_rank").drop("_rank")


@dataclass
class SkipCells(Filter):
    """All but the first n cells of every row."""

    n: int

    def apply(self, cells, reverse=False):
        placed = ranked(cells, ["row"], cell_order(), "_rank")
        return placed.where(F.col("_rank") > self.n).drop("_rank")


@dataclass
class FirstColumns(Filter):
    """Newest versions only, first n columns of every row."""

    n: int

    def apply(self, cells, reverse=False):
        return FirstCells(self.n).apply(newest(cells))


@dataclass
class ColumnPage(Filter):
    """Newest versions only: a page of columns, from an offset or from a qualifier."""

    limit: int
    offset: int = 0
    start: bytes | str | None = None
    family: str | None = None

    def apply(self, cells, reverse=False):
        if self.start is not None:
            cells = cells.where(QualifierRange(self.family, self.start).test())
            return FirstCells(self.limit).apply(newest(cells))
        end = self.offset + self.limit
        placed = topmost(newest(cells), ["row"], cell_order(), end, "_rank")
        return placed.where(F.col("_rank") > self.offset).drop("_rank")


@dataclass
class RowPage(Filter):
    """The first n rows in scan order."""

    n: int

    def apply(self, cells, reverse=False):
        return first_rows(cells, self.n, reverse)


# ---- value changes ----------------------------------------------------------


class Strip(Filter):
    """Cells without their values."""

    def apply(self, cells, reverse=False):
        return cells.withColumn("value", F.lit(b""))


class KeyOnly(Filter):
    """Newest version of each column, value emptied."""

    def apply(self, cells, reverse=False):
        return Strip().apply(newest(cells.withColumn("value", F.lit(b""))))


# ---- row tests --------------------------------------------------------------


@dataclass
class ColumnValue(Filter):
    """Keep or drop whole rows by the value of one column.

    Only the cells of that column are looked at, and only the keys of the rows to
    keep (or to drop) come out of them; they are written and measured, then joined.
    """

    family: str
    qualifier: bytes | str
    matches: Filter
    keep_if_missing: bool = True
    any_version: bool = False
    drop_column: bool = False

    def apply(self, cells, reverse=False):
        here = (F.col("family") == self.family) & (
            F.col("qualifier") == bytes_lit(self.qualifier)
        )
        column = cells.where(here)
        if not self.any_version:
            column = newest(column)
        hit = F.max(F.when(self.matches.test(), 1).otherwise(0))
        rows = column.groupBy("row").agg(hit.alias("_hit"))
        if self.keep_if_missing:
            failing = settle(rows.where("_hit = 0").select("row"), "rows")
            kept = attach(cells, failing, ["row"], "left_anti")
        else:
            passing = settle(rows.where("_hit = 1").select("row"), "rows")
            kept = attach(cells, passing, ["row"], "left_semi")
        return kept.where(~here) if self.drop_column else kept


@dataclass
class Condition(Filter):
    """Rows in which ``when`` leaves any cell take one branch, other rows the other."""

    when: Filter
    then: Filter = field(default_factory=Pass)
    otherwise: Filter = field(default_factory=Block)

    def apply(self, cells, reverse=False):
        rows = settle(self.when.apply(cells, reverse).select("row").distinct(), "rows")
        chosen = measured(rows)
        yes = self.then.apply(chosen.join(cells, ["row"], "left_semi"), reverse)
        no = self.otherwise.apply(chosen.join(cells, ["row"], "left_anti"), reverse)
        return yes.select(*cells.columns).unionByName(no.select(*cells.columns))


@dataclass
class WhileMatch(Filter):
    """Rows up to, and without, the first row from which ``inner`` removes a cell.

    Only the smallest failing key is needed, so there is no ordered pass over the
    table: one minimum, then a comparison.
    """

    inner: Filter

    def apply(self, cells, reverse=False):
        test = self.inner.test()
        if test is not None:
            failing = cells.where(~test)
        else:
            after = self.inner.apply(cells, reverse).groupBy("row").agg(_count("_after"))
            failing = (
                cells.groupBy("row")
                .agg(_count("_before"))
                .join(after, ["row"], "left")
                .where(F.col("_before") != F.coalesce("_after", F.lit(0)))
            )
        edge = F.max("row") if reverse else F.min("row")
        stop = failing.agg(edge.alias("_stop")).scalar()
        before = F.col("row") > stop if reverse else F.col("row") < stop
        kept = cells.where(stop.isNull() | before)
        return kept if test is not None else self.inner.apply(kept, reverse)


def _count(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


# ---- lists ------------------------------------------------------------------


class All(Filter):
    """A chain: the order of the members counts, and no members means no filter."""

    def __init__(self, *members: Filter):
        self.members = members

    def test(self):
        tests = [m.test() for m in self.members]
        if any(t is None for t in tests):
            return None
        return reduce(lambda a, b: a & b, tests, F.lit(True))

    def keys(self):
        return reduce(KeySet.intersect, [m.keys() for m in self.members], KeySet.all())

    def apply(self, cells, reverse=False):
        for member in self.members:
            cells = member.apply(cells, reverse)
        return cells


class Any(Filter):
    """Every member sees the same input; a cell two members keep comes out once."""

    def __init__(self, *members: Filter):
        self.members = members

    def test(self):
        tests = [m.test() for m in self.members]
        if any(t is None for t in tests):
            return None
        return reduce(lambda a, b: a | b, tests) if tests else F.lit(True)

    def keys(self):
        if not self.members:
            return KeySet.all()
        return reduce(KeySet.union, [m.keys() for m in self.members])

    def apply(self, cells, reverse=False):
        if self.test() is not None:
            return cells.where(self.test())
        tests = [m.test() for m in self.members if m.test() is not None]
        branches = [m.apply(cells, reverse) for m in self.members if m.test() is None]
        if tests:
            branches.insert(0, cells.where(reduce(lambda a, b: a | b, tests)))
        # A cell may come back changed (emptied); the earliest branch that has it wins.
        numbered = [b.withColumn("_branch", F.lit(i)) for i, b in enumerate(branches)]
        together = reduce(DataFrame.unionByName, numbered)
        rest = [name for name in cells.columns if name not in VERSION]
        return (
            together.groupBy(*VERSION)
            .agg(F.min(F.struct("_branch", *rest)).alias("_one"))
            .select(*VERSION, "_one.*")
            .select(*cells.columns)
        )

