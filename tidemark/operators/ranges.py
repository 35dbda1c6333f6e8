"""Ordered work without one hot task: range buckets, running totals, order statistics.

A plain ``Window.partitionBy(key).orderBy(time)`` puts a whole key into one task, and a
global ``orderBy`` window puts everything there. Here the order column is cut into ranges
of about equal row counts. Each range is scanned on its own, and what precedes it arrives
as one row of range totals. Only range totals, never rows, cross range borders.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterable, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tidemark.session import materialize, rows_per_range

RANGE = "_range"
COARSE = 1_000  # more than twice as many ranges are cut in two steps


def halo(
    df: DataFrame, width: int, back: int = 0, ahead: int = 0, us: str = "us"
) -> DataFrame:
    """Copy every row to the fixed time bucket it lies in and to a neighbour in reach.

    A row at time t sees rows in [t - back, t + ahead]. ``bucket`` is the copy's bucket
    and ``home`` tells the original from the copies; frames over (key, bucket) are then
    complete for the home rows. The reach must not exceed the bucket width, so there is
    at most one copy per direction.
    """
    if max(back, ahead) > width:
        raise ValueError("the bucket must be at least as wide as the frame")
    own = f"({us} - pmod({us}, {width}L)) div {width}L"
    places = [own]
    if back:
        places.append(f"if(pmod({us}, {width}L) >= {width - back}L, {own} + 1, null)")
    if ahead:
        places.append(f"if(pmod({us}, {width}L) <= {ahead}L, {own} - 1, null)")
    copies = df.selectExpr("*", f"explode(array_compact(array({', '.join(places)}))) as bucket")
    return copies.selectExpr("*", f"bucket = {own} as home")


class Cuts(list):
    """Inner borders of an order column's ranges, in order.

    ``heavy`` names the values that hold several ranges' worth of rows, with the number of
    ranges; each of them is a range of its own. ``ties`` cuts such a range further: (least and
    largest tie, inner borders) of the tie column.
    """

    def __init__(self, points=(), heavy=None, ties=None):
        super().__init__(points)
        self.heavy: dict[float, int] = heavy or {}
        self.ties: dict[float, tuple[float, float, list[float]]] = ties or {}

    def heavy_ranges(self) -> list[int]:
        """Range numbers of the heavy values (before ties cut them)."""
        return [self.index(v) + 1 for v in self.heavy]


def range_points(
    df: DataFrame, column: str, rows: int | None = None, tie: str | None = None
) -> Cuts:
    """Inner borders that cut ``column`` into ranges of about ``rows`` rows.

    Small tables need one count and give no border. The borders are plain numbers fixed
    before the real plan is built, so every branch of that plan cuts alike even when a
    lost executor makes Spark compute one of them again. A value that holds several ranges'
    worth of rows shows as a repeated border; with ``tie``, a numeric column, the rows
    of such a value are cut by percentiles of the tie among them.
    """
    rows = rows or rows_per_range(df.sparkSession)
    total = df.agg(F.count(column)).first()[0]
    ranges = math.ceil(total / rows)
    if ranges <= 1:
        return Cuts()
    found = sorted(_percentiles(df, column, ranges))
    heavy = {v: n + 1 for v, n in Counter(found).items() if n > 1}
    points = sorted({*found, *heavy, *(math.nextafter(v, math.inf) for v in heavy)})
    ties = _tie_points(df, column, tie, heavy) if tie and heavy else {}
    return Cuts(points, heavy, ties)


def _percentiles(df: DataFrame, column: str, ranges: int) -> list[float]:
    """About the values at i / ranges. Many are found in two steps, the second range by range."""
    value = F.col(column).cast("double")
    value = F.when(~F.isnan(value), value)
    if ranges <= 2 * COARSE:
        shares = [i / ranges for i in range(1, ranges)]
        return df.agg(F.percentile_approx(value, shares, 10 * ranges + 1000)).first()[0] or []
    points = sorted(set(_percentiles(df, column, COARSE)))
    inner = math.ceil(ranges / COARSE)
    shares = [i / inner for i in range(1, inner)]
    found = (
        assign_range(df.select(column), column, Cuts(points))
        .groupBy(RANGE)
        .agg(F.percentile_approx(value, shares, 10 * inner + 1000).alias("cuts"))
    )
    return points + [v for r in found.collect() for v in r["cuts"] or []]


def _tie_points(df: DataFrame, column: str, tie: str, heavy: dict[float, int]) -> dict:
    """Borders of the tie among the rows of each heavy value."""
    value, of = F.col(column).cast("double"), F.col(tie).cast("double")
    out = {}
    # Values that need about the same number of ranges are looked at together.
    for size in sorted({n.bit_length() for n in heavy.values()}):
        members = [v for v, n in heavy.items() if n.bit_length() == size]
        pieces = 1 << size
        shares = [i / pieces for i in range(1, pieces)]
        facts = df.where(value.isin(members)).groupBy(value.alias("v")).agg(
            F.min(of).alias("lo"), F.max(of).alias("hi"),
            F.percentile_approx(of, shares, 10 * pieces + 1000).alias("cuts"),
        )
        for r in facts.collect():
            if r["lo"] is not None and r["lo"] < r["hi"]:
                out[r["v"]] = (r["lo"], r["hi"], sorted(set(r["cuts"])))
    return out


def settled(
    df: DataFrame, column: str, at_most: int | None = None, tie: str | None = None
) -> tuple[DataFrame, Cuts]:
    """A table and the borders that cut it, without deriving it again and again.

    ``at_most`` bounds its rows; they are counted if it is not given. A table that fits one
    range needs no border. A larger one is written out first, since the borders, the range
    totals and the scan all read it: the input is scanned for the count and for the copy.
    """
    if (df.count() if at_most is None else at_most) <= rows_per_range(df.sparkSession):
        return df, Cuts()
    df = materialize(df)
    return df, range_points(df, column, tie=tie)


def numeric(df: DataFrame, column: str | None) -> bool:
    return column in df.columns and isinstance(df.schema[column].dataType, NumericType)


def _bucket(df: DataFrame, value: Column, splits: Sequence[float], out: str) -> DataFrame:
    """The interval of each row by binary search on the JVM side."""
    inf, name = float("inf"), "_range_value"
    cutter = Bucketizer(
        splits=[-inf, *splits, inf], inputCol=name, outputCol=out, handleInvalid="keep"
    )
    return cutter.transform(df.withColumn(name, value)).drop(name)


def assign_range(
    df: DataFrame,
    column: str,
    points: Sequence[float],
    tie: str | None = None,
    side: str | None = None,
) -> DataFrame:
    """Add the range number of each row.

    Ranges follow the order (column, side, tie): ``side`` is a column of 0 and 1, ``tie`` the one
    the borders were found with.
    """
    if not points:
        return df.withColumn(RANGE, F.lit(0))
    cut = _bucket(df, F.col(column).cast("double"), points, RANGE)
    ties = getattr(points, "ties", {})
    if ties and tie:
        # A place between the range's number and the next, rising with side and tie.
        low, scale, splits = [0.0] * (len(points) + 2), [0.0] * (len(points) + 2), set(range(1, len(points) + 1))
        for value, (lo, hi, borders) in ties.items():
            i = points.index(value) + 1
            low[i], scale[i] = lo, 1.0 / (hi - lo)
            places = [0.4 * min(1.0, max(0.0, (b - lo) * scale[i])) for b in borders]
            splits.update(i + p for p in places)
            if side:
                splits.update([i + 0.5, *(i + 0.5 + p for p in places)])
        at = F.col(RANGE).cast("int")
        share = (F.coalesce(F.col(tie).cast("double"), F.lit(-math.inf)) - F.get(F.lit(low), at)) * F.get(F.lit(scale), at)
        share = F.when(F.get(F.lit(scale), at) > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), share))).otherwise(0.0)
        half = 0.5 * F.col(side) if side else F.lit(0.0)
        place = F.col(RANGE) + half * (F.get(F.lit(scale), at) > 0).cast("double") + 0.4 * share
        cut = _bucket(cut.withColumn(RANGE, place), F.col(RANGE), sorted(splits), "_range_tied").drop(RANGE)
        cut = cut.withColumnRenamed("_range_tied", RANGE)
    return cut.withColumn(RANGE, F.col(RANGE).cast("int"))


# Frames of a running value: rows up to this one, before it, from it on, after it.
UPTO, BEFORE, FROM, AFTER = "upto", "before", "from", "after"
Value = tuple[str, Column, str]


def _over(keys: Sequence[str], order: Sequence[str], frame: str) -> str:
    by = f"partition by {', '.join(f'`{k}`' for k in keys)} " if keys else ""
    way = " desc" if frame in (FROM, AFTER) else ""
    end = "current row" if frame in (UPTO, FROM) else "1 preceding"
    line = ", ".join(f"`{c}`{way}" for c in order)
    return f"over ({by}order by {line} rows between unbounded preceding and {end})"


def _scan(keys: Sequence[str], order: Sequence[str], function: str, value: str, frame: str) -> Column:
    over = _over(keys, order, frame)
    if function != "last":
        return F.expr(f"{function}(`{value}`) {over}")
    if frame in (UPTO, BEFORE):
        return F.expr(f"last(`{value}`, true) {over}")
    # Looking ahead needs no second sort.
    ahead = f"lead(`{value}`) ignore nulls {_over(keys, order, UPTO).split(' rows between')[0]})"
    return F.expr(f"coalesce(`{value}`, {ahead})" if frame == FROM else ahead)


def sweep(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    levels: Sequence[tuple[Callable[[DataFrame], DataFrame] | None, dict[str, Value]]],
    points: Sequence[float] = (),
    tie: str | None = None,
    side: str | None = None,
) -> DataFrame:
    """Running values of each key in ``order``, level by level, over one exchange of the rows.

    A level is (preparation, values): the preparation adds columns, row by row, from what the levels
    before it gave; a value is (``sum``, ``max`` or ``last`` non-null, column, frame). With
    ``points``, order[0] is cut into ranges (``tie`` and ``side`` as for ``assign_range``) and
    every (key, range) is scanned on its own. Each level's state at the end of a range is
    one row; it is handed on to the ranges in reach, so that all levels keep the partitioning
    of the first. ``df`` is read once per level and once for the result: write a derived one out
    before (``settled``).
    """
    rows = assign_range(df, order[0], points, tie, side) if points else df
    keys = [*by, RANGE] if points else list(by)

    def prepared(out: DataFrame, level: int) -> DataFrame:
        prepare, values = levels[level]
        out = prepare(out) if prepare else out
        return out.withColumns({f"_in_{n}": c for n, (_, c, _) in values.items()})

    def done(out: DataFrame, level: int, carry: DataFrame | None) -> DataFrame:
        values = levels[level][1]
        out = out.withColumns({n: _scan(keys, order, f, f"_in_{n}", at) for n, (f, _, at) in values.items()})
        out = out.drop(*[f"_in_{n}" for n in values])
        if carry is None:
            return out
        return out.join(carry, keys, "left").withColumns(
            {n: _merge(f, at, F.col(n), F.col(f"_b_{n}")) for n, (f, _, at) in values.items()}
        ).drop(*[f"_b_{n}" for n in values])

    def upto(level: int) -> DataFrame:
        out = rows
        for i in range(level):
            out = done(prepared(out, i), i, carries[i])
        return out

    carries: list[DataFrame | None] = []
    for level, (_, values) in enumerate(levels):
        if not points:
            carries.append(None)
            continue
        totals = prepared(upto(level), level).groupBy(*keys).agg(
            *[_total(f, at, F.col(f"_in_{n}"), order).alias(f"_t_{n}") for n, (f, _, at) in values.items()]
        )
        outside = {UPTO: BEFORE, FROM: AFTER}
        carry = totals.select(
            *keys,
            *[_scan(by, [RANGE], f, f"_t_{n}", outside.get(at, at)).alias(f"_b_{n}") for n, (f, _, at) in values.items()],
        )
        carries.append(materialize(carry) if len(levels) > 1 else carry)
    return upto(len(levels)).drop(RANGE)


def _total(function: str, frame: str, value: Column, order: Sequence[str]) -> Column:
    if function != "last":
        return {"sum": F.sum, "max": F.max}[function](value)
    place = F.when(value.isNotNull(), F.struct(*order))
    return (F.min_by if frame in (FROM, AFTER) else F.max_by)(value, place)


def _merge(function: str, frame: str, own: Column, carried: Column) -> Column:
    if function == "sum":
        return F.when(own.isNull(), carried).otherwise(own + F.coalesce(carried, F.lit(0)))
    return F.greatest(own, carried) if function == "max" else F.coalesce(own, carried)


def running(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    values: dict[str, tuple[str, Column]],
    points: Sequence[float] | None = None,
    inclusive: bool = True,
    reverse: bool = False,
) -> DataFrame:
    """Running ``sum``, ``max`` or ``last`` (non-null) of each key in ``order``.

    ``values`` maps an output name to (function, column). ``order[0]`` must be numeric:
    it is cut into ranges, and so is ``order[1]`` within a value that holds several ranges' worth of
    rows. ``points`` are the borders if the caller already has them. With
    ``inclusive=False`` the current row is left out. ``reverse`` walks from the end, so
    that ``last`` without the current row is the next value. The ``by`` columns must not be
    null.
    """
    tie = order[1] if len(order) > 1 and numeric(df, order[1]) else None
    if points is None:
        df, points = settled(df, order[0], tie=tie)
    frame = {(True, False): UPTO, (False, False): BEFORE, (True, True): FROM, (False, True): AFTER}[inclusive, reverse]
    level = {n: (f, c, frame) for n, (f, c) in values.items()}
    return sweep(df, by, order, [(None, level)], points, tie)


def group_load(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """Rows in all and rows of the largest group (counted with a map-side half)."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    total, largest = counts.agg(F.sum("n"), F.max("n")).first()
    return total or 0, largest or 0


def by_group(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """Bring each group into one task.

    The number of tasks follows the row count: the rows multiply after this shuffle, so its
    bytes alone would call for too few tasks. Beyond the session's shuffle partitions there
    is one for each half range of rows.
    """
    spark = df.sparkSession
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(1, min(most, math.ceil(rows / 2_000)), math.ceil(2 * rows / rows_per_range(spark)))
    return df.repartition(tasks, *[F.col(c) for c in keys])


def global_rank(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """1-based position of each row among its key's rows in ``order``."""
    return running(df, by, order, {name: ("sum", F.lit(1).cast("bigint"))})


def order_statistics(
    df: DataFrame,
    column: str,
    ranks_of: Callable[[int], Iterable[int]],
    limit: int = 1_000_000,
) -> tuple[int, dict[int, float]]:
    """Exact values at the given 1-based ranks, and the number of values.

    ``ranks_of(n)`` names the wanted ranks once the count is known. Each rank is enclosed
    in a value interval that approximate percentiles narrow until it holds at most ``limit``
    rows. Each round also splits off the interval's two end values, however many rows they
    hold, so ties cannot keep it wide. Its rows are then counted per distinct value and read off
    exactly. The data is scanned a few times, nothing but the last small interval is shuffled,
    and only numbers reach the driver.
    """
    src = df.select(F.col(column).alias("v")).where(F.col("v").isNotNull())
    if dict(src.dtypes)["v"] == "double":
        src = src.where(~F.isnan("v"))
    total, low, high = src.agg(F.count("v"), F.min("v"), F.max("v")).first()
    wanted = sorted({r for r in ranks_of(total) if 1 <= r <= total})
    if not wanted:
        return total, {}
    box = {r: (low, high, 0, total) for r in wanted}

    v = F.col("v")
    accuracy = 10_000
    while wide := [r for r, (lo, hi, _, inside) in box.items() if inside > limit and lo < hi]:
        scan = src.where(v.between(min(box[r][0] for r in wide), max(box[r][1] for r in wide)))
        guess = scan.agg(*[_bracket(v, *box[r], r, accuracy).alias(str(r)) for r in wide]).first()
        counts = scan.agg(*[_interval(v, box[r], *guess[str(r)]).alias(str(r)) for r in wide]).first()
        for r in wide:
            lo, hi = guess[str(r)]
            below, inside = box[r][2] + counts[str(r)]["below"], counts[str(r)]["inside"]
            if not below < r <= below + inside:
                # The guess missed the rank: only the ends of the interval are split off.
                lo, hi, below, inside = box[r]
            box[r] = _split_ends(src, v, r, lo, hi, below, inside)

    out = {r: lo for r, (lo, hi, _, _) in box.items() if lo == hi}
    left = [r for r in wanted if r not in out]
    if left:
        rank = F.explode(
            F.array_compact(
                F.array(*[F.when(v.between(box[r][0], box[r][1]), F.lit(r)) for r in left])
            )
        )
        below = F.create_map(*[F.lit(x) for r in left for x in (r, box[r][2])])
        inside = src.select("v", rank.alias("rank")).groupBy("rank", "v").agg(
            F.count("*").alias("n")
        )
        upto = F.sum("n").over(Window.partitionBy("rank").orderBy("v")) + below[F.col("rank")]
        hit = inside.withColumn("upto", upto).where(
            (F.col("upto") - F.col("n") < F.col("rank")) & (F.col("rank") <= F.col("upto"))
        )
        out.update({r["rank"]: r["v"] for r in hit.select("rank", "v").collect()})
    return total, out


def _interval(v: Column, box: tuple, lo, hi) -> Column:
    """Rows of the box below ``lo``, and rows from ``lo`` to ``hi``."""
    return F.struct(
        F.count_if((v >= box[0]) & (v < lo)).alias("below"), F.count_if(v.between(lo, hi)).alias("inside")
    )


def _split_ends(src: DataFrame, v: Column, rank: int, lo, hi, below: int, inside: int) -> tuple:
    """The interval without its end values, or one value where the rank is among an end's rows."""
    if lo == hi:
        return lo, hi, below, inside
    between = F.when((v > lo) & (v < hi), v)
    least, most, first, last = src.where(v.between(lo, hi)).agg(
        F.min(between), F.max(between), F.count_if(v == lo), F.count_if(v == hi)
    ).first()
    if rank <= below + first:
        return lo, lo, below, first
    if rank > below + inside - last:
        return hi, hi, below + inside - last, last
    return least, most, below + first, inside - first - last


def _bracket(v: Column, lo, hi, below: int, inside: int, rank: int, accuracy: int) -> Column:
    """Approximate percentiles a little to both sides of the wanted rank."""
    share = (rank - below) / inside
    slack = 5 / accuracy
    return F.percentile_approx(
        F.when(v.between(lo, hi), v), [max(0.0, share - slack), min(1.0, share + slack)], accuracy
    )


def quantiles(df: DataFrame, column: str, shares: Sequence[float]) -> dict[float, float]:
    """Exact percentiles, linear between the two neighbouring values."""
    def place(n: int, p: float) -> tuple[int, float]:
        h = (n - 1) * p
        return math.floor(h), h - math.floor(h)

    def ranks(n: int):
        return [r for p in shares for r in (place(n, p)[0] + 1, place(n, p)[0] + 2)]

    total, values = order_statistics(df, column, ranks)
    out = {}
    for p in shares:
        at, part = place(total, p)
        low = values.get(at + 1)
        high = values.get(at + 2, low)
        out[p] = None if low is None else float(low + (high - low) * part)
    return out


def cut_keys(
    df: DataFrame, order: tuple[str, str], shares: Sequence[float]
) -> list[tuple | None]:
    """Order key (time, tie) of the row at each 0-based position ``int(n * share)``.

    None where the position is past the end.
    """
    time, tie = order
    total, at = order_statistics(df, time, lambda n: [int(n * s) + 1 for s in shares])
    wanted = [int(total * s) + 1 for s in shares]
    found = sorted({at[r] for r in wanted if r in at})
    if not found:
        return [None] * len(wanted)
    t = F.col(time)
    facts = df.agg(
        *[F.count_if(t < x).alias(f"b{i}") for i, x in enumerate(found)],
        *[F.count_if(t == x).alias(f"n{i}") for i, x in enumerate(found)],
        *[F.min(F.when(t == x, F.col(tie))).alias(f"m{i}") for i, x in enumerate(found)],
    ).first()
    out = []
    for r in wanted:
        if r not in at:
            out.append(None)
            continue
        i = found.index(at[r])
        within = r - facts[f"b{i}"]
        if facts[f"n{i}"] == 1 or within == 1:
            out.append((at[r], facts[f"m{i}"]))
            continue
        _, ties = order_statistics(df.where(t == at[r]), tie, lambda n, k=within: [k])
        out.append((at[r], ties[within]))
    return out
