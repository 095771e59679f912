"""Row positions defined by an explicit unique key.

Spark tables have no physical row order, so the operators that depend on row
position take ``order_by``: columns that together are unique and not null.  No
step sorts the table in one task.

``split`` needs only the key at the cut, and ``select_rows`` the keys at its
positions, so both end as filters on the key that reach the file scan.  The keys
are found by narrowing a window of keys around each position with exact counts,
reading only the key columns and shuffling no rows; many positions are read from
the sorted key columns instead.  Either way a key that repeats at a position
raises, and repeats elsewhere don't matter.  ``with_row_index`` gives every row a
position, so there any repeated key raises.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colfit.operators.stats import require_columns
from colfit.session import shared_folder, ship_package

# A window of keys this small is sorted and read directly.
SORT_LIMIT = 10_000
# Up to this many positions are looked up by narrowing.
NARROW_ROWS = 16
# Row lists up to this length are broadcast.
BROADCAST_ROWS = 100_000
# Relative rank error of percentile_approx is 1 / ACCURACY.
ACCURACY = 10_000
# Keys that are not one number are narrowed by a sample of about this many of a window.
SAMPLE_KEYS = 20_000
# Low bits of monotonically_increasing_id: the position inside a partition.
POSITION_BITS = 33

_NUMBERS = (T.IntegralType, T.FloatType, T.DoubleType)
NOT_UNIQUE = "the row key is not unique"


def with_row_index(
    df: DataFrame, order_by: str | Sequence[str], column: str = "row_index"
) -> DataFrame:
    """Add the 0-based position of each row in key order.

    The rows are range-partitioned and sorted by key, and written once to the
    shared checkpoint folder, which fixes the partitions.  The position is the
    row's place in its partition plus the sizes of the partitions before it.
    """
    keys = _keys(df, order_by)
    numbered, sizes = _numbered(df, keys)
    if _repeats(numbered, keys):
        raise ValueError(NOT_UNIQUE)
    starts = _starts(sizes)
    offsets = df.sparkSession.createDataFrame(
        list(starts.items()), "__part bigint, __start bigint"
    )
    return (
        numbered.withColumn("__part", F.shiftright("__place", POSITION_BITS))
        .join(F.broadcast(offsets), "__part")  # one row per partition
        .withColumn(
            column,
            F.col("__start") + F.col("__place").bitwiseAND(F.lit((1 << POSITION_BITS) - 1)),
        )
        .drop("__part", "__start", "__place")
    )


def select_rows(
    df: DataFrame, indices: Sequence[int], order_by: str | Sequence[str]
) -> DataFrame:
    """Rows at the given 0-based positions; repeated positions count once."""
    keys = _keys(df, order_by)
    wanted = sorted(set(indices))
    if wanted and wanted[0] < 0:
        raise IndexError(f"row index {wanted[0]} is negative")
    if not wanted:
        return df.limit(0)
    if len(wanted) <= NARROW_ROWS:
        rows = _count(df, keys)
        _check_range(wanted, rows)
        found = _narrow(df, keys, wanted, rows)
        same = reduce(lambda a, b: a | b, [_equal(df, keys, key) for key in found])
        # The leading column's values are implied; they are there for the file scan.
        return df.filter(same & _col(keys[0]).isin([key[0] for key in found]))
    numbered, sizes = _numbered(df.select(*map(_col, keys)), keys)
    places = _places(sizes, wanted)
    spark = df.sparkSession
    small = len(places) <= BROADCAST_ROWS

    def at(wanted_places: Sequence[int]) -> DataFrame:
        picked = spark.createDataFrame([(p,) for p in wanted_places], "__place bigint")
        return numbered.join(F.broadcast(picked) if small else picked, "__place", "left_semi")

    # Equal keys are neighbours in one partition, so a repeated key shows beside its place.
    near = at(sorted({q for p in places for q in (p - 1, p, p + 1)}))
    if not near.groupBy(*map(_col, keys)).count().where("count > 1").isEmpty():
        raise ValueError(NOT_UNIQUE)
    rows = at(places).drop("__place")
    return df.join(F.broadcast(rows) if small else rows, keys, "left_semi")


def split(
    df: DataFrame, train_size: float, order_by: str | Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """The first ``trunc(n * train_size)`` rows in key order, and the rest."""
    keys = _keys(df, order_by)
    if not train_size >= 0 or math.isinf(train_size):
        raise ValueError(f"train_size must be a finite number >= 0, got {train_size}")
    rows = _count(df, keys)
    cut = int(rows * train_size)
    if cut >= rows:
        return df, df.filter(F.lit(False))
    if cut == 0:
        return df.filter(F.lit(False)), df
    at_cut = key_at_rank(df, keys, cut, rows)
    if len(keys) == 1:
        before = _col(keys[0]) < at_cut[0]
        return df.filter(before), df.filter(~before)
    before = F.struct(*map(_col, keys)) < F.struct(*at_cut)
    # The single-column bound is implied; it is there for the file scan.
    return (
        df.filter(before & (_col(keys[0]) <= at_cut[0])),
        df.filter(~before & (_col(keys[0]) >= at_cut[0])),
    )


def key_at_rank(
    df: DataFrame, keys: Sequence[str], rank: int, rows: int
) -> list[Column]:
    """The key values of the row at a 0-based rank, as literals."""
    (key,) = _narrow(df, keys, [rank], rows)
    return _literals(df, keys, key)


def _literals(df: DataFrame, keys: Sequence[str], key: Sequence[Any]) -> list[Column]:
    types = [df.schema[k].dataType for k in keys]
    return [F.lit(v).cast(t) for v, t in zip(key, types, strict=True)]


def _equal(df: DataFrame, keys: Sequence[str], key: Sequence[Any]) -> Column:
    pairs = zip(keys, _literals(df, keys, key), strict=True)
    return reduce(lambda a, b: a & b, [_col(k) == v for k, v in pairs])


@dataclass(frozen=True)
class _Window:
    """A range of keys known to hold the key at a rank."""

    inside: Column
    least: Any
    most: Any
    size: int
    offset: int  # the rank within the window


class _Keys:
    """The key columns, compared as one value."""

    def __init__(self, df: DataFrame, keys: Sequence[str]):
        self.df, self.keys = df, keys
        self.table = df.select(*[_col(k).alias(f"k{i}") for i, k in enumerate(keys)])
        self.names = self.table.columns
        kind = df.schema[keys[0]].dataType
        self.one = len(keys) == 1
        self.number = self.one and isinstance(kind, _NUMBERS)
        self.whole = self.one and isinstance(kind, T.IntegralType)

    def compared(self, operator: str, key: Any) -> Column:
        """``columns operator key``; the leading column's bound is for the file scan."""
        if self.one:
            return getattr(F.col("k0"), operator)(_literals(self.df, self.keys, [key])[0])
        literals = _literals(self.df, self.keys, key)
        leading = "__ge__" if operator in ("__gt__", "__ge__") else "__le__"
        bound = getattr(F.col("k0"), leading)(literals[0])
        return bound & getattr(F.struct(*self.names), operator)(F.struct(*literals))

    def value(self, row: Sequence[Any]) -> Any:
        return row[0] if self.one else tuple(row)


def _narrow(df: DataFrame, keys: Sequence[str], ranks: Sequence[int], rows: int) -> list[tuple]:
    """The keys at the given ranks, by shrinking windows.

    Each round reads only the key columns: one pass for two guesses around each
    rank, one to count exactly.  A guess for one number is an approximate
    percentile, which shrinks a window about 2,500-fold; otherwise it comes from a
    sample and shrinks it about 50-fold.  One job reads the last, small windows.
    """
    k = _Keys(df, keys)
    least = most = None
    if k.number:
        least, most = k.table.agg(F.min("k0"), F.max("k0")).first()
    whole = F.lit(True)
    windows = [_Window(whole, least, most, rows, rank) for rank in ranks]
    rounds = 0
    while any(w.size > SORT_LIMIT for w in windows):
        wide = [w for w in windows if w.size > SORT_LIMIT]
        table = k.table.filter(reduce(lambda a, b: a | b, [w.inside for w in wide]))
        rounds += 1
        bounds = _bounds(table, wide, k.whole) if k.number else _sampled_bounds(table, k, wide, rounds)
        shrunk = iter(_shrunk(table, k, wide, bounds))
        windows = [next(shrunk) if w.size > SORT_LIMIT else w for w in windows]
    return _at_offsets(k, windows)


def _tagged(table: DataFrame, k: _Keys, windows: Sequence[_Window]) -> DataFrame:
    """``tag`` and key of the rows of each of the different windows, by place in the list."""
    first = _first_of_same(windows)
    tags = F.array(*[F.when(windows[i].inside, F.lit(i)) for i in sorted(set(first))])
    return table.select(F.explode(F.filter(tags, lambda t: t.isNotNull())).alias("tag"), *k.names)


def _first_of_same(windows: Sequence[_Window]) -> list[int]:
    """For each window the place of the first one with the same range."""
    places: dict[int, int] = {}
    return [places.setdefault(id(w.inside), i) for i, w in enumerate(windows)]


def _sampled_bounds(table: DataFrame, k: _Keys, windows: Sequence[_Window], seed: int) -> list[list]:
    """Keys of a sample a little below and above each window's rank; None beyond its ends."""
    different = set(_first_of_same(windows))
    share = min(1.0, SAMPLE_KEYS / min(windows[i].size for i in different))
    rows = _tagged(table, k, windows).sample(share, seed).orderBy("tag", *k.names).collect()
    sample: dict[int, list] = {}
    for row in rows:
        sample.setdefault(row["tag"], []).append(k.value(row[1:]))
    found = []
    for w, i in zip(windows, _first_of_same(windows), strict=True):
        keys = sample.get(i, [])
        place = w.offset / w.size * len(keys)
        margin = 1 if share == 1.0 else 3 * math.sqrt(len(keys)) / 2 + 2
        low, high = math.floor(place - margin), math.ceil(place + margin)
        found.append([keys[low] if low >= 0 and keys else None, keys[high] if high < len(keys) else None])
    return found


def _bounds(table: DataFrame, windows: Sequence[_Window], whole: bool) -> list[list]:
    """Numbers a little below and above each window's rank."""
    k, margin = F.col("k0"), 2.0 / ACCURACY
    decimal = "decimal(20,0)"
    sketches: dict[tuple, list[int]] = {}
    for i, w in enumerate(windows):  # windows with the same range share a sketch
        sketches.setdefault((w.least, w.most, w.size), []).append(i)
    columns = []
    for group in sketches.values():
        first = windows[group[0]]
        # Percentiles are computed in doubles, so large integers are taken
        # relative to the start of the window.
        start = F.lit(first.least).cast(decimal)
        value = (k.cast(decimal) - start).cast("double") if whole else k
        ranks = [windows[i].offset / first.size for i in group]
        shares = [min(max(r + side, 0.0), 1.0) for r in ranks for side in (-margin, margin)]
        sketch = F.percentile_approx(F.when(first.inside, value), shares, ACCURACY)
        columns.append(sketch.alias(f"p{len(columns)}"))
    found = [[]] * len(windows)
    for group, values in zip(sketches.values(), table.agg(*columns).first(), strict=True):
        for j, i in enumerate(group):
            w, pair = windows[i], values[2 * j : 2 * j + 2]
            found[i] = [min(w.least + int(v), w.most) for v in pair] if whole else pair
    return found


def _shrunk(
    table: DataFrame, k: _Keys, windows: Sequence[_Window], bounds: Sequence[Sequence]
) -> list[_Window]:
    """The part of each window, below, between or above its bounds, that holds its rank."""
    never, always = F.lit(False), F.lit(True)
    parts = []
    for w, (low, high) in zip(windows, bounds, strict=True):
        below = never if low is None else k.compared("__lt__", low)
        above = never if high is None else k.compared("__gt__", high)
        from_low = always if low is None else k.compared("__ge__", low)
        to_high = always if high is None else k.compared("__le__", high)
        parts.append([w.inside & below, w.inside & from_low & to_high, w.inside & above])
    columns = [F.count_if(c).alias(f"{n}{i}") for i, p in enumerate(parts) for n, c in zip("bm", p, strict=False)]
    counts = list(table.agg(*columns).first())
    result = []
    for i, (w, (low, high)) in enumerate(zip(windows, bounds, strict=True)):
        below, between = counts[2 * i : 2 * i + 2]
        if w.offset < below:
            new = _Window(parts[i][0], w.least, low, below, w.offset)
        elif w.offset < below + between:
            least, most = w.least if low is None else low, w.most if high is None else high
            new = _Window(parts[i][1], least, most, between, w.offset - below)
        else:
            size, offset = w.size - below - between, w.offset - below - between
            new = _Window(parts[i][2], high, w.most, size, offset)
        if new.size >= w.size and not (low is None and high is None):
            raise ValueError(NOT_UNIQUE)  # else the sample was too small; the next is another
        result.append(new)
    return result


def _at_offsets(k: _Keys, windows: Sequence[_Window]) -> list[tuple]:
    """The key at each window's offset; its neighbours show if it repeats."""
    table = k.table.filter(reduce(lambda a, b: a | b, [w.inside for w in windows]))
    rows: dict[int, list[tuple]] = {}
    for row in _tagged(table, k, windows).orderBy("tag", *k.names).collect():
        rows.setdefault(row["tag"], []).append(tuple(row[1:]))
    found = []
    for w, i in zip(windows, _first_of_same(windows), strict=True):
        near = rows[i][max(w.offset - 1, 0) : w.offset + 2]
        if len(set(near)) != len(near):
            raise ValueError(NOT_UNIQUE)
        found.append(rows[i][w.offset])
    return found


def _repeats(numbered: DataFrame, keys: Sequence[str]) -> bool:
    """Whether any key repeats; equal keys follow each other in a partition."""
    ship_package(numbered.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, found = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if last is not None and last == [c[0].as_py() for c in batch.columns]:
                found += 1
            pairs = [pc.equal(c.slice(1), c.slice(0, len(c) - 1)) for c in batch.columns]
            same = reduce(pc.and_, pairs)
            found += pc.sum(same.cast(pa.int64())).as_py() or 0
            last = [c[-1].as_py() for c in batch.columns]
        yield pa.RecordBatch.from_arrays([pa.array([found], pa.int64())], ["repeats"])

    counted = numbered.select(*map(_col, keys)).mapInArrow(run, "repeats bigint")
    return bool(counted.agg(F.sum("repeats")).first()[0])


def _numbered(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, dict[int, int]]:
    """Rows with ``__place`` (partition and position packed), and partition sizes."""
    shared_folder(df.sparkSession)
    ordered = (
        df.repartitionByRange(*map(_col, keys)).sortWithinPartitions(*map(_col, keys)).checkpoint()
    )
    numbered = ordered.withColumn("__place", F.monotonically_increasing_id())
    counts = (
        numbered.groupBy(F.shiftright("__place", POSITION_BITS).alias("part"))
        .agg(F.count("*").alias("n"), F.count_if(_has_null(keys)).alias("nulls"))
        .collect()  # one row per partition
    )
    if any(row["nulls"] for row in counts):
        raise ValueError(f"key {list(keys)} has nulls")
    return numbered, {row["part"]: row["n"] for row in sorted(counts, key=lambda r: r["part"])}


def _starts(sizes: dict[int, int]) -> dict[int, int]:
    starts, total = {}, 0
    for part, n in sizes.items():
        starts[part] = total
        total += n
    return starts


def _places(sizes: dict[int, int], wanted: Sequence[int]) -> list[int]:
    """Packed partition and position of each wanted (sorted) row position."""
    _check_range(wanted, sum(sizes.values()))
    places, parts = [], iter(_starts(sizes).items())
    part, start = next(parts)
    for index in wanted:
        while index >= start + sizes[part]:
            part, start = next(parts)
        places.append((part << POSITION_BITS) + index - start)
    return places


def _check_range(wanted: Sequence[int], rows: int) -> None:
    if wanted[-1] >= rows:
        raise IndexError(f"row index {wanted[-1]} out of range for {rows} rows")


def _count(df: DataFrame, keys: Sequence[str]) -> int:
    rows, nulls = df.agg(F.count("*"), F.count_if(_has_null(keys))).first()
    if nulls:
        raise ValueError(f"key {list(keys)} has nulls")
    return rows


def _has_null(keys: Sequence[str]) -> Column:
    missing = F.lit(False)
    for key in keys:
        missing = missing | _col(key).isNull()
    return missing


def _keys(df: DataFrame, order_by: str | Sequence[str]) -> list[str]:
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    if not keys:
        raise ValueError("order_by must name at least one column")
    require_columns(df, keys)
    return keys


def _col(name: str) -> Column:
    return F.col(f"`{name}`")
