"""Exact order statistics without a sort: the values and rows at given ranks.

A global sort, or a window over the whole table, would funnel every row through one ordering just
to read a few positions. Here each pass counts rows per equal-width bin inside the brackets that
still hold a wanted rank, and narrows those brackets to one bin. The driver only ever sees bin
counts, at most ``BINS`` per bracket, and rows are never shuffled: counts merge map-side. A value
shared by a third of all rows costs no more than any other, since it is one entry in one bin.
"""

import math
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions.time import epoch_micros, moment

BINS = 4096
SMALLEST = 5e-324


@dataclass(frozen=True)
class Located:
    """The value at a rank, with the number of rows below it and equal to it."""

    value: object
    below: int
    equal: int


def _present(df: DataFrame, column: Column) -> Column:
    """The column with NaN as missing."""
    is_float = df.select(column.alias("x")).schema["x"].dataType.typeName() in ("double", "float")
    return F.when(~F.isnan(column), column) if is_float else column


def _values(df: DataFrame, column: Column) -> DataFrame:
    """The column as ``x``, with NaN as missing."""
    return df.select(_present(df, column).alias("x"))


def count_and_range(df: DataFrame, column: Column) -> tuple[int, object, object]:
    """Count, least and greatest of the values that are present."""
    row = _values(df, column).agg(F.count("x").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    return row.n, row.lo, row.hi


def _infinities(values: DataFrame) -> tuple[int, int]:
    """Rows of minus and plus infinity."""
    if values.schema["x"].dataType.typeName() not in ("double", "float"):
        return 0, 0
    x = F.col("x")
    return tuple(values.agg(F.count_if(x == float("-inf")), F.count_if(x == float("inf"))).first())


def locate_ranks(df: DataFrame, column: Column, ranks: list[int], bounds=None, bins: int = BINS) -> dict[int, Located]:
    """Value at each 0-based rank of a numeric column in ascending order. Nulls do not count.

    ``bounds`` is (count, min, max) of the column where the caller already knows them. Infinite values are
    counted apart, since no bin can hold them; they are the first and the last ranks.
    """
    return locate_many(df, {"x": column}, {"x": ranks}, {"x": bounds} if bounds else None, bins)["x"]


@dataclass(frozen=True, order=True)
class Bracket:
    """Rows of one column between two values that still hold a wanted rank."""

    name: str
    lo: object
    hi: object
    below: int
    inside: int


def locate_many(
    df: DataFrame, columns: dict[str, Column], ranks: dict[str, list[int]], bounds: dict[str, tuple] | None = None, bins: int = BINS
) -> dict[str, dict[int, Located]]:
    """``locate_ranks`` of several columns at once: every pass over the rows narrows the brackets of all of them."""
    found: dict[str, dict[int, Located]] = {name: {} for name in columns}
    pending: dict[Bracket, list[int]] = {}
    for name, column in columns.items():
        values = _values(df, column)
        n, lo, hi = (bounds or {}).get(name) or count_and_range(df, column)
        for rank in ranks[name]:
            if not 0 <= rank < n:
                raise ValueError(f"rank {rank} outside 0..{n - 1}")
        low = high = 0
        if n and (math.isinf(lo) or math.isinf(hi)):
            low, high = _infinities(values)
            found[name].update({r: Located(float("-inf"), 0, low) for r in ranks[name] if r < low})
            found[name].update({r: Located(float("inf"), n - high, high) for r in ranks[name] if r >= n - high})
            lo, hi = values.filter(F.abs("x") < float("inf")).agg(F.min("x"), F.max("x")).first()
        inside = sorted({r for r in ranks[name] if low <= r < n - high})
        if inside:
            pending[Bracket(name, lo, hi, low, n - low - high)] = inside
    return _search(df, columns, pending, found, bins)


def _search(df: DataFrame, columns: dict[str, Column], pending: dict[Bracket, list[int]], found: dict, bins: int) -> dict:
    """Narrow the brackets until each holds one value."""
    while pending:
        for bracket, wanted in list(pending.items()):
            if bracket.lo == bracket.hi:
                found[bracket.name].update({r: Located(bracket.lo, bracket.below, bracket.inside) for r in wanted})
                del pending[bracket]
        if pending:
            pending = _narrowed(df, columns, pending, bins)
    return found


def locate_near(df: DataFrame, column: Column, rank: int, lo, hi, bounds: tuple) -> Located:
    """The value at a rank that is expected between two values: one pass tells, and the search goes on inside.

    Where the rank lies elsewhere after all, the whole range is searched.
    """
    within = column.between(lo, hi)
    below, inside, least, most = df.agg(
        F.count_if(column < lo), F.count_if(within), F.min(F.when(within, column)), F.max(F.when(within, column))
    ).first()
    if not below <= rank < below + inside:
        return locate_ranks(df, column, [rank], bounds)[rank]
    pending = {Bracket("x", least, most, below, inside): [rank]}
    return _search(df, {"x": column}, pending, {"x": {}}, BINS)["x"][rank]


def _narrowed(df: DataFrame, columns: dict[str, Column], pending: dict[Bracket, list[int]], bins: int) -> dict[Bracket, list[int]]:
    """One pass: count the rows of each bracket by bin, and keep the bins that hold a wanted rank."""
    brackets = sorted(pending)
    entries = []
    for i, bracket in enumerate(brackets):
        x, lo = columns[bracket.name], bracket.lo
        if isinstance(lo, float):
            # halves, so that the difference of two finite numbers stays finite
            width = max((bracket.hi / 2 - lo / 2) / bins, SMALLEST)
            offset = (x / 2 - F.lit(lo / 2)) / F.lit(width)
        elif bracket.hi - lo < 2**63:
            offset = (x - F.lit(lo)).cast("double") / F.lit(max(float(bracket.hi - lo) / bins, SMALLEST))
        else:
            width = (float(bracket.hi) - float(lo)) / bins
            offset = (x.cast("double") - F.lit(float(lo))) / F.lit(width)
        slot = F.least(F.floor(offset).cast("int"), F.lit(bins - 1))
        entries.append(F.when(x.between(lo, bracket.hi), F.struct(F.lit(i).alias("bracket"), slot.alias("bin"))))
    counted = {}
    for kind, names in _by_type(df, columns).items():
        mine = [i for i, b in enumerate(brackets) if b.name in names]
        if not mine:
            continue
        value = F.coalesce(*[F.when(F.col("hit.bracket") == i, columns[brackets[i].name]) for i in mine])
        hits = df.filter(reduce(lambda a, b: a | b, [columns[brackets[i].name].between(brackets[i].lo, brackets[i].hi) for i in mine]))
        hits = hits.withColumn("hit", F.explode(F.array_compact(F.array(*[entries[i] for i in mine]))))
        rows = hits.groupBy("hit").agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi"))
        for row in rows.collect():  # at most ``bins`` rows per bracket
            counted.setdefault(row.hit.bracket, []).append((row.hit.bin, row.n, row.lo, row.hi))
    narrowed: dict[Bracket, list[int]] = {}
    for i, bracket in enumerate(brackets):
        below = bracket.below
        for _, n, lo, hi in sorted(counted[i]):
            here = [rank for rank in pending[bracket] if below <= rank < below + n]
            if here:
                part = Bracket(bracket.name, lo, hi, below, n)
                if part == bracket:
                    raise RuntimeError(f"values between {lo} and {hi} cannot be told apart")
                narrowed[part] = here
            below += n
    return narrowed


def _by_type(df: DataFrame, columns: dict[str, Column]) -> dict[str, set[str]]:
    """Names of the columns of each type, so that values of one type meet in one expression."""
    fields = df.select(*[c.alias(name) for name, c in columns.items()]).schema.fields
    kinds: dict[str, set[str]] = {}
    for field in fields:
        kinds.setdefault(field.dataType.simpleString(), set()).add(field.name)
    return kinds


def quantiles_of(df: DataFrame, columns: dict[str, Column], probabilities: list[float]) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of several columns in shared passes; None for a column without values."""
    clean = {name: _present(df, column) for name, column in columns.items()}
    parts = [F.struct(F.count(c), F.min(c), F.max(c)).alias(name) for name, c in clean.items()]
    bounds = {name: tuple(value) for name, value in df.agg(*parts).first().asDict().items()}
    full = {name: c for name, c in clean.items() if bounds[name][0]}
    positions = {name: [p * (bounds[name][0] - 1) for p in probabilities] for name in full}
    ranks = {name: sorted({r for pos in at for r in (int(pos), min(int(pos) + 1, bounds[name][0] - 1))}) for name, at in positions.items()}
    found = locate_many(df, full, ranks, bounds) if full else {}
    result: dict[str, list[float | None]] = {name: [None for _ in probabilities] for name in columns}
    for name, at in positions.items():
        last = bounds[name][0] - 1
        for i, pos in enumerate(at):
            left, right = (float(found[name][r].value) for r in (int(pos), min(int(pos) + 1, last)))
            share = pos - int(pos)
            result[name][i] = left if left == right or not share else left * (1 - share) + right * share if math.isinf(right - left) else left + (right - left) * share
    return result


def exact_quantiles(df: DataFrame, column: Column, probabilities: list[float]) -> list[float | None]:
    """Linearly interpolated quantiles of the whole table, exact at any size and any skew."""
    return quantiles_of(df, {"x": column}, probabilities)["x"]


@dataclass(frozen=True)
class SortKey:
    """One ascending sort column: as stored, and as a number for rank selection.

    Cuts compare the stored column with a literal, so they reach the scan as pushed filters. Both
    must never be null.
    """

    column: Column
    number: Column
    literal: Callable[[object], Column] = F.lit

    @staticmethod
    def of(column: Column) -> "SortKey":
        return SortKey(column, column)

    @staticmethod
    def nullable(column: Column, blank) -> list["SortKey"]:
        """Two keys of a column that may be null: nulls first, then its values, ``blank`` standing in for null."""
        return [SortKey.of(column.isNotNull().cast("int")), SortKey.of(F.coalesce(column, F.lit(blank)))]

    @staticmethod
    def timestamp(name: str) -> "SortKey":
        """A zone-free timestamp column, numbered in microseconds since 1970."""

        def literal(micros: int) -> Column:
            return moment((datetime(1970, 1, 1) + timedelta(microseconds=micros)).isoformat(" "))

        return SortKey(F.col(name), epoch_micros(F.col(name)), literal)


def row_cuts(df: DataFrame, order: list[SortKey], ranks: list[int], bounds=None) -> list[list]:
    """Leading sort-key numbers of the row at each rank, under a multi-column ascending order.

    A returned key may be shorter than ``order``: it stops as soon as it separates the rows before
    the rank from the rest. Rows equal on every sort column are one unit and stay on the upper side
    of a cut. A group of rows that share the first key is narrowed by the next one, whatever its size.
    ``bounds`` is (count, min, max) of the first number where already known.
    """
    head = order[0]
    first = locate_ranks(df, head.number, ranks, bounds)
    cuts = []
    for rank in ranks:
        spot = first[rank]
        if rank == spot.below or len(order) == 1:
            cuts.append([spot.value])
        else:
            group = df.filter(head.column == head.literal(spot.value))
            cuts.append([spot.value, *row_cuts(group, order[1:], [rank - spot.below])[0]])
    return cuts


def at_or_after(order: list[SortKey], key: list) -> Column:
    """True for rows whose leading sort columns are lexicographically >= the key."""
    result = None
    for item, value in reversed(list(zip(order, key))):
        bound = item.literal(value)
        result = (item.column >= bound) if result is None else (item.column > bound) | ((item.column == bound) & result)
    return result
