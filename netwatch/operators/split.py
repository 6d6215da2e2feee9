"""Ordered splits: the rows before and after given ranks of a total order.

A split needs only the order values found at its cut ranks, not a position for every row. They are found
in two scans of the source. The first makes a quantile sketch of the leading order column, which says
between which two values each rank lies, give or take ``MARGIN`` of all rows. The second counts exactly how
many rows lie below these brackets and keeps the order values of the rows inside them, a small share of the
table, in a working table. All that follows reads this table: passes that group the candidates of a rank by
the high bits of one order column, keep the group the rank falls into, and go on with lower bits, then with the
next column. A pass is one aggregation of at most ``BINS`` groups per rank, so nothing is sorted and the driver
sees counts only. The split itself is then a plain comparison of each row with the cut values: no
shuffle, and the same answer whenever a task is run again.

The sketch only decides which rows are kept. Should it ever be further off than the margin, the exact counts
show it, and that cut is searched over the source instead.

Rows with equal order values are told apart by two hashes of the whole row, kept by a third scan, of the rows
with these values alone. Exact copies stay equal; when a cut falls among them, as many copies as belong to
each side are written from one of them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netwatch.functions.identity import row_hash
from netwatch.session import work_dir
from netwatch.sources.files import remove

SMALLEST, GREATEST = -(2**63), 2**63 - 1
# Groups per rank that one pass counts and the driver reads. Splits are for a few ranks, not for
# thousands of chunks: a pass makes at most this many groups for each.
BINS = 4096
# Size of the quantile sketch; its ranks are then off by up to 0.13 % of all rows in 99 of 100 cases. A
# bracket reaches three times as far to both sides.
SKETCH = 4096
MARGIN = 0.004
# Sketches of map tasks are merged in this many groups first, so that no task merges those of all.
GROUPS = 64


@dataclass
class Cut:
    """Where a rank falls: ``values`` of the leading levels, and bounds of the next while it is searched.

    ``base`` rows lie before the values and bounds, ``size`` rows are within them.
    """

    rank: int
    values: list[int] = field(default_factory=list)
    low: int | None = None
    high: int | None = None
    base: int = 0
    size: int = 0

    @property
    def inside(self) -> bool:
        """True when rows with equal values fall on both sides."""
        return self.base < self.rank

    def settled(self, levels: int) -> bool:
        """True when the values alone tell the sides apart, or no level is left to tell more."""
        return self.low is None and (len(self.values) == levels or not self.inside)

    def slot(self) -> tuple:
        return (*self.values, self.low, self.high)

    def narrow(self, low: int, high: int) -> None:
        """Takes closer bounds of the current level; equal bounds fix it."""
        if low == high:
            self.values = [*self.values, low]
            low = high = None
        self.low, self.high = low, high


def ordered_split(
    df: DataFrame, order: Sequence[str], fraction: float = 0.75
) -> tuple[DataFrame, DataFrame]:
    """The first ``int(fraction * n)`` rows by ``order``, and the rest."""
    parts = _number(df, order, lambda total: [int(total * fraction)], "_part")
    return parts.filter("_part = 0").drop("_part"), parts.filter("_part = 1").drop("_part")


def replay_chunks(
    df: DataFrame, order: Sequence[str], n: int = 4, name: str = "chunk"
) -> DataFrame:
    """Adds the number of the chunk a row is in: n equal runs by ``order``, the last takes the rest."""
    return _number(df, order, lambda total: [total // n * i for i in range(1, n)], name)


def _number(
    df: DataFrame, order: Sequence[str], ranks_of: Callable[[int], list[int]], name: str
) -> DataFrame:
    """Adds, as BIGINT, how many of the ranks lie at or below each row's own rank."""
    numbers = [_as_bigint(df, column) for column in order]
    seen = _survey(df, numbers)
    # NULL comes first: it stands one below the smallest number.
    floors = [max((smallest or 0) - 1, SMALLEST) for smallest in seen.smallest]
    levels = [F.coalesce(n, F.lit(floor)) for n, floor in zip(numbers, floors)]
    high = floors[0] if seen.greatest is None else seen.greatest

    total = seen.total
    ranks = ranks_of(total)
    rows = _Rows(df, order[0], floors[0])
    cuts = [Cut(r, low=floors[0], high=high, size=total) for r in ranks if 0 < r < total]
    missed = _find_near(rows, levels, cuts, seen)
    _find(rows.keys(levels), levels, missed)
    tied = [cut for cut in cuts if cut.inside]
    if tied:
        levels = levels + [row_hash(df, df.columns, seed) for seed in (1, 2)]
        with _Kept(rows.keys(levels)(tied).filter(_any_within(tied))) as kept:
            _find(lambda _: kept, levels, tied)

    # Ranks at or below 0 count for every row, those from the total on for none. A cut among copies
    # counts for the rows behind all of them; the copies themselves are numbered apart.
    always = F.lit(sum(r <= 0 for r in ranks)).cast("bigint")
    passed = [_after(levels, cut.values, strictly=cut.inside) for cut in cuts]
    placed = df.withColumn(name, _sum_true(always, passed))
    for cut in {tuple(cut.values): cut for cut in cuts if cut.inside}.values():
        same = _equal(levels, cut.values)
        copies = _copies(rows.near([cut]).filter(same), cut)
        passed = [F.col("_own") >= r for r in ranks if 0 < r < total]
        copies = copies.withColumn(name, _sum_true(always, passed)).drop("_own")
        placed = placed.filter(~same).unionByName(copies)
    return placed


@dataclass
class _Survey:
    """What the first scan finds: sizes, ends, and a sketch of the leading column, None without a number in it."""

    total: int
    valued: int
    smallest: list[int | None]
    greatest: int | None
    sketch: bytes | None


def _survey(df: DataFrame, numbers: list[Column]) -> _Survey:
    lead = numbers[0]
    lows = [F.min(n).alias(f"low{i}") for i, n in enumerate(numbers)]
    group = F.pmod(F.spark_partition_id(), F.lit(GROUPS))
    partial = df.groupBy(group.alias("_group")).agg(
        F.count(F.lit(1)).alias("total"),
        F.count(lead).alias("valued"),
        F.max(lead).alias("high"),
        F.kll_sketch_agg_bigint(lead, SKETCH).alias("sketch"),
        *lows,
    )
    # At most GROUPS rows are left. A sketch of no values is NULL or empty, by whether there were rows.
    found = partial.agg(
        F.coalesce(F.sum("total"), F.lit(0)).alias("total"),
        F.coalesce(F.sum("valued"), F.lit(0)).alias("valued"),
        F.max("high").alias("high"),
        F.kll_merge_agg_bigint(F.when(F.col("valued") > 0, F.col("sketch")), SKETCH).alias("sketch"),
        *(F.min(f"low{i}").alias(f"low{i}") for i in range(len(numbers))),
    ).first()
    smallest = [found[f"low{i}"] for i in range(len(numbers))]
    return _Survey(found.total, found.valued, smallest, found.high, found.sketch if found.valued else None)


def _bracket(cuts: list[Cut], seen: _Survey, spark: SparkSession) -> list[Cut]:
    """Gives the cuts closer bounds by the sketch. Brackets that meet become one, so that slots never overlap."""
    nulls = seen.total - seen.valued
    if seen.sketch is None:
        return cuts
    ends = [[(cut.rank - nulls) / seen.valued + side * MARGIN for side in (-1, 1)] for cut in cuts]
    asked = [F.lit(min(max(end, 0.0), 1.0)) for pair in ends for end in pair]
    sketch = spark.range(1, numPartitions=1).select(F.lit(bytearray(seen.sketch)).alias("sketch"))
    values = sketch.select(*(F.kll_sketch_get_quantile_bigint("sketch", q).alias(f"q{i}") for i, q in enumerate(asked))).first()
    found = []
    for i, (cut, (low, high)) in enumerate(zip(cuts, ends)):
        # Beyond the ends of the sketch the ends of the column hold, and the place of NULL before them.
        found.append((values[2 * i] if low > 0 else cut.low, values[2 * i + 1] if high < 1 else cut.high))
    joined: list[list[int]] = []
    for low, high in sorted(found):
        if joined and low <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], high)
        else:
            joined.append([low, high])
    near = []
    for cut, (low, _) in zip(cuts, found):
        low, high = next(pair for pair in joined if pair[0] <= low <= pair[1])
        near.append(Cut(cut.rank, low=low, high=high))
    return near


def _find_near(rows: _Rows, levels: list[Column], cuts: list[Cut], seen: _Survey) -> list[Cut]:
    """Finds the cuts inside the brackets of the sketch; returns those that are outside them, as they came."""
    if not cuts:
        return []
    near = _bracket(cuts, seen, rows.df.sparkSession)
    brackets = sorted({(cut.low, cut.high) for cut in near})
    lead = F.col("k0")
    # One task's counts are added once, however often it is run: the write that carries them has no shuffle.
    below = Observation()
    measures = []
    for i, (low, high) in enumerate(brackets):
        measures += [F.count_if(lead < low).alias(f"below{i}"), F.count_if(lead.between(low, high)).alias(f"inside{i}")]
    keys = rows.keys(levels)([]).observe(below, *measures)
    found, missed = [], []
    with _Kept(keys.filter(_any_within(near))) as kept:
        counts = below.get
        for cut, close in zip(cuts, near):
            number = brackets.index((close.low, close.high))
            base, size = counts[f"below{number}"], counts[f"inside{number}"]
            if base <= cut.rank < base + size:
                cut.base, cut.size = base, size
                cut.narrow(close.low, close.high)
                found.append(cut)
            else:
                missed.append(cut)
        _find(lambda _: kept, levels, found)
    return missed


class _Kept:
    """Keys written to a working table for as long as they are searched."""

    def __init__(self, keys: DataFrame) -> None:
        self.keys = keys
        self.path = work_dir(keys.sparkSession, "split")

    def __enter__(self) -> DataFrame:
        self.keys.write.parquet(self.path)
        return self.keys.sparkSession.read.schema(self.keys.schema).parquet(self.path)

    def __exit__(self, *_) -> None:
        remove(self.keys.sparkSession, self.path)


def _sum_true(start: Column, tests: Sequence[Column]) -> Column:
    return reduce(Column.__add__, (test.cast("bigint") for test in tests), start)


def _as_bigint(df: DataFrame, name: str) -> Column:
    data_type = df.schema[name].dataType
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(name).cast("timestamp"))
    if isinstance(data_type, T.DateType):
        return F.unix_date(name).cast("bigint")
    if isinstance(data_type, (T.IntegralType, T.BooleanType)):
        return F.col(name).cast("bigint")
    raise TypeError(f"cannot split by {name}: order by times, dates or whole numbers")


@dataclass
class _Rows:
    """The rows to be split, readable near some cuts only.

    The leading order column is compared as it is stored, so that a columnar source skips the blocks
    that hold no candidates. ``floor`` stands for NULL, of which a source cannot tell where it is.
    """

    df: DataFrame
    lead: str
    floor: int

    def keys(self, levels: Sequence[Column]) -> Callable[[Sequence[Cut]], DataFrame]:
        """The order values ``k0, k1, ...`` of the rows near given cuts; of all rows without cuts."""
        named = [level.alias(f"k{i}") for i, level in enumerate(levels)]
        return lambda cuts: (self.near(cuts) if cuts else self.df).select(*named)

    def near(self, cuts: Sequence[Cut]) -> DataFrame:
        ends = {(c.values[0], c.values[0]) if c.values else (c.low, c.high) for c in cuts}
        if any(low <= self.floor for low, _ in ends):
            return self.df
        lead = F.col(self.lead)
        return self.df.filter(
            reduce(Column.__or__, (lead.between(*map(self._stored, pair)) for pair in sorted(ends)))
        )

    def _stored(self, number: int) -> Column:
        data_type = self.df.schema[self.lead].dataType
        if isinstance(data_type, T.DateType):
            return F.date_from_unix_date(F.lit(number).cast("int"))
        if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
            return F.timestamp_micros(F.lit(number)).cast(data_type)
        return F.lit(number).cast(data_type)


def _find(keys: Callable[[Sequence[Cut]], DataFrame], levels: list[Column], cuts: list[Cut]) -> None:
    """Narrows the cuts down until each has a value for every level, or falls between two rows."""
    while True:
        open_cuts = [c for c in cuts if not c.settled(len(levels))]
        for cut in open_cuts:
            if cut.low is None and cut.size <= BINS:
                cut.narrow(SMALLEST, GREATEST)
        unbounded = [c for c in open_cuts if c.low is None]
        if unbounded:
            _bound(keys(unbounded), unbounded)
        elif open_cuts:
            _count(keys(open_cuts), open_cuts)
        else:
            return


def _slots(cuts: Sequence[Cut]) -> dict[tuple, Cut]:
    return {cut.slot(): cut for cut in cuts}


def _within(cut: Cut) -> Column:
    """Rows that are still candidates for the cut."""
    test = _equal([F.col(f"k{i}") for i in range(len(cut.values))], cut.values)
    if cut.low is not None:
        test &= F.col(f"k{len(cut.values)}").between(cut.low, cut.high)
    return test


def _any_within(cuts: Sequence[Cut]) -> Column:
    return reduce(Column.__or__, (_within(cut) for cut in cuts))


def _numbered(keys: DataFrame, slots: dict[tuple, Cut]) -> DataFrame:
    """Candidates only, each with the number of its slot. Slots never overlap."""
    tests = [_within(cut) for cut in slots.values()]
    slot = F.coalesce(*(F.when(test, i) for i, test in enumerate(tests)))
    return keys.filter(reduce(Column.__or__, tests)).withColumn("slot", slot)


def _bound(keys: DataFrame, cuts: list[Cut]) -> None:
    """Smallest and greatest value of the level each cut has reached."""
    slots = _slots(cuts)
    level = {i: F.col(f"k{len(cut.values)}") for i, cut in enumerate(slots.values())}
    value = F.coalesce(*(F.when(F.col("slot") == i, v) for i, v in level.items()))
    ends = _numbered(keys, slots).groupBy("slot").agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    found = {row.slot: row for row in ends.collect()}
    numbers = {slot: i for i, slot in enumerate(slots)}
    for cut in cuts:
        row = found[numbers[cut.slot()]]
        cut.narrow(row.lo, row.hi)


def _count(keys: DataFrame, cuts: list[Cut]) -> None:
    """One counting pass: each cut keeps the bin its rank falls into."""
    slots = _slots(cuts)
    shifts = []
    for cut in slots.values():
        shift = 0
        # Few rows have few values, whatever lies between these.
        while cut.size > BINS and (cut.high >> shift) - (cut.low >> shift) >= BINS:
            shift += 1
        shifts.append(shift)
    value = F.coalesce(
        *(
            F.when(F.col("slot") == i, F.shiftright(F.col(f"k{len(cut.values)}"), shifts[i]))
            for i, cut in enumerate(slots.values())
        )
    )
    bins = _numbered(keys, slots).groupBy("slot", value.alias("bin")).count().collect()
    numbers = {slot: i for i, slot in enumerate(slots)}
    for cut in cuts:
        number = numbers[cut.slot()]
        shift = shifts[number]
        for row in sorted((r for r in bins if r.slot == number), key=lambda r: r.bin):
            if cut.rank < cut.base + row["count"]:
                break
            cut.base += row["count"]
        cut.size = row["count"]
        cut.narrow(max(cut.low, row.bin << shift), min(cut.high, ((row.bin + 1) << shift) - 1))


def _equal(levels: Sequence[Column], values: Sequence[int]) -> Column:
    return reduce(Column.__and__, (k == v for k, v in zip(levels, values)), F.lit(True))


def _after(levels: Sequence[Column], values: Sequence[int], strictly: bool) -> Column:
    """Row comes after the values in the order of the levels, or, unless ``strictly``, is equal."""
    last = F.lit(not strictly)
    for level, value in reversed(list(zip(levels, values))):
        last = (level > value) | ((level == value) & last)
    return last


def _copies(rows: DataFrame, cut: Cut) -> DataFrame:
    """All ``cut.size`` copies of one row, each with its own rank as ``_own``.

    The one row is joined to a distributed range of ranks, so the copies are not in one task. That all
    of them are copies is tested first, NULLs and nested values included.
    """
    named = [F.to_json(F.struct(c), {"ignoreNullFields": "false"}) for c in rows.columns]
    ends = rows.agg(*(end(n) for n in named for end in (F.min, F.max))).first()
    if list(ends[::2]) != list(ends[1::2]):
        raise ValueError("different rows with equal hashes: add a column to the order")
    one = rows.limit(1).withColumn("_one", F.lit(0))
    own = rows.sparkSession.range(cut.base, cut.base + cut.size)
    own = own.select(F.col("id").alias("_own"), F.lit(0).alias("_one"))
    return own.join(F.broadcast(one), "_one").select(*rows.columns, "_own")
