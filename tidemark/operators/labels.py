"""Gap chunks, forward volatility and spike labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.ticks import priced
from tidemark.operators.features import SECOND, coarse, numbered
from tidemark.operators.ranges import (
    AFTER,
    BEFORE,
    FROM,
    UPTO,
    Cuts,
    by_group,
    group_load,
    halo,
    numeric,
    quantiles,
    range_points,
    running,
    settled,
    sweep,
)
from tidemark.session import materialize, rows_per_range


def gap_chunks(
    df: DataFrame, gap: float = 300, by: Sequence[str] = ("product_id",), tie: str = "seq"
) -> DataFrame:
    """Number the stretches of each key that no pause of more than ``gap`` seconds breaks."""
    named = tie if numeric(df, tie) else None
    df, points = settled(df, "us", tie=named)
    pause = F.expr(f"if(us - _prev > {int(gap * SECOND)}L, 1L, 0L)")
    levels = [
        (None, {"_prev": ("max", F.col("us"), BEFORE)}),
        (None, {"chunk_id": ("sum", pause, UPTO)}),
    ]
    return sweep(df, by, ["us", tie], levels, points, named).drop("_prev")


def forward_volatility(
    df: DataFrame,
    horizon: float = 60,
    gap: float = 300,
    by: Sequence[str] = ("product_id",),
    keep: Sequence[str] = (),
    tie: str = "seq",
    width: int | None = None,
) -> DataFrame:
    """Population deviation of the simple returns between ticks in (t, t + horizon].

    NULL with fewer than two such ticks, or when one of them has no usable price. Ticks past a pause of more than ``gap`` seconds
    are not looked at. The same sweep as for the rolling features: running totals are read
    just after t and just after the end of the horizon; a burst is cut into ranges.
    """
    h, g = int(horizon * SECOND), int(gap * SECOND)
    by = list(by)
    rows = df.select(
        *by, "us", F.col(tie).alias("seq"), priced(F.col("price")).alias("price"),
        *[F.col(c).alias(f"_keep_{c}") for c in keep],
    )
    width = width or 12 * h
    spark = df.sparkSession
    cells = rows.select(*by, "us", F.floor(F.col("us") / width).alias("bucket"))
    total, largest = group_load(cells, [*by, "bucket"])
    group, points, tied = [*by, "bucket"], Cuts(), "seq" if numeric(rows, "seq") else None
    rows = numbered(by_group(halo(rows, width, ahead=h), group, total), group)
    crowded = largest > rows_per_range(spark)

    end = f"us + {h}L"
    if g < h:
        order = ["us", "seq", "_row", "_copy"]
        if crowded:
            rows = materialize(rows)
            points = range_points(rows, "us", tie=tied)
        pause = F.expr(f"if(_later - us > {g}L, us, null)")
        levels = [
            (None, {"_later": ("last", F.col("us"), AFTER)}),
            (None, {"_stop": ("last", pause, FROM)}),
        ]
        rows = sweep(rows, group, order, levels, points, tied)
        end = f"least({end}, _stop)"

    marks = rows.selectExpr(
        "*",
        f"""inline(array_compact(array(
            named_struct('kind', 0, 'frame', 'own', 'at', us),
            if(home, named_struct('kind', 1, 'frame', 'from', 'at', us), null),
            if(home, named_struct('kind', 1, 'frame', 'to', 'at', {end}), null))))""",
    )
    if crowded:
        marks = materialize(marks)
        points = range_points(marks, "at", tie=tied)
    line = ["at", "kind", "seq", "_row", "_copy"]
    own = F.expr("if(kind = 0, named_struct('price', price), null)")
    # Totals of the return and its square, each in parts that add up without rounding.
    parts = _parts("x")
    levels = [
        (None, {"next": ("last", own, AFTER)}),
        (
            _returns,
            {
                "n": ("sum", F.expr("if(kind = 0, 1L, 0L)"), UPTO),
                "ok": ("sum", F.expr("if(kind = 0 and price is not null, 1L, 0L)"), UPTO),
                **{name: ("sum", F.expr(value), UPTO) for name, value in parts.items()},
                "tail": ("last", F.expr("if(kind = 0, x, null)"), UPTO),
            },
        ),
    ]
    totals = sweep(marks, group, line, levels, points, tied, side="kind").where("home")

    sums = totals.groupBy(*group, "us", "seq", "_row", "_copy").agg(
        F.expr("max(if(frame = 'own', price, null)) as price"),
        *[
            F.expr(f"sum(case frame when 'to' then {c} when 'from' then -{c} end) as {c}")
            for c in ("n", "ok", *parts)
        ],
        F.expr("max(if(frame = 'to', tail, null)) as tail"),
        *[F.expr(f"first(if(frame = 'own', `_keep_{c}`, null), true) as `{c}`") for c in keep],
    )
    # The last tick's pair ends past the horizon.
    whole = sums.selectExpr(
        "*",
        "n - 1 as pairs",
        *[f"{name} - ({value}) as inner_{name}" for name, value in _parts("tail").items()],
    ).selectExpr(
        "*",
        "(inner_r + inner_r_rest) / nullif(pairs, 0) as average",
        "(inner_rr + inner_rr_mid + inner_rr_rest) / nullif(pairs, 0) as square",
    )
    value = F.expr(
        "case when ok <> n then null when pairs = 1 then 0D "
        "when pairs > 1 then sqrt(greatest(square - average * average, 0D)) end"
    )
    return whole.select(
        *by,
        "us",
        F.col("seq").alias(tie),
        "price",
        value.alias("future_volatility"),
        *keep,
    )


def _returns(marks: DataFrame) -> DataFrame:
    """``x``: the return to the next tick, 0 where it is not finite."""
    return marks.selectExpr(
        "*", "if(kind = 0, (next.price - price) / price, 0D) as ratio"
    ).selectExpr("*", "if(abs(ratio) < double('infinity'), ratio, 0D) as x").drop("ratio")


def _parts(x: str) -> dict[str, str]:
    """SQL of a return and its square as multiples of coarse grains and small rests."""
    r, rr = coarse(x, 2.0**-20), coarse(f"{x} * {x}", 2.0**-8)
    rest = f"({x} * {x} - {rr})"
    return {
        "r": r,
        "r_rest": f"{x} - {r}",
        "rr": rr,
        "rr_mid": coarse(rest, 2.0**-38),
        "rr_rest": f"{rest} - {coarse(rest, 2.0**-38)}",
    }


def volatility_threshold(vol: DataFrame, percentile: float = 90) -> float | None:
    """Exact percentile of all valid forward volatilities.

    The values are rounded to 12 places here and where they are compared: the running
    totals leave noise below that.
    """
    rounded = vol.select(F.round("future_volatility", 12).alias("v"))
    return quantiles(rounded, "v", [percentile / 100])[percentile / 100]


def spike_label(
    df: DataFrame,
    horizon: float = 60,
    gap: float = 300,
    percentile: float = 90,
    by: Sequence[str] = ("product_id",),
    keep: Sequence[str] = (),
    drop_unlabeled: bool = False,
    threshold: float | None = None,
) -> DataFrame:
    """Add ``volatility_spike`` (1, 0, or NULL while the horizon is not covered).

    The threshold is the percentile over all products unless one is given (a stored one,
    for streams). A table that already has labels is returned as it is.
    """
    if "volatility_spike" in df.columns:
        return df
    vol = forward_volatility(df, horizon, gap, by, keep)
    if threshold is None:
        vol = materialize(vol)
        threshold = volatility_threshold(vol, percentile)
    spike = (F.round("future_volatility", 12) >= F.lit(threshold).cast("double")).cast("int")
    out = vol.withColumns(
        {"volatility_spike": spike, "label_threshold": F.lit(threshold).cast("double")}
    )
    return out.where(F.col("volatility_spike").isNotNull()) if drop_unlabeled else out


def label_backfill(
    stored: DataFrame,
    fresh: DataFrame,
    keys: Sequence[str] = ("product_id", "us", "seq"),
    label: str = "volatility_spike",
) -> DataFrame:
    """Keep the labels that exist and fill the missing ones from a later computation."""
    known = fresh.select(*keys, F.col(label).alias("_fresh"))
    return stored.join(known, list(keys), "left").withColumn(
        label, F.coalesce(F.col(label), F.col("_fresh"))
    ).drop("_fresh")


def out_of_order(
    df: DataFrame,
    tolerance: float = 1.0,
    by: Sequence[str] = (),
    arrival: str = "seq",
    against_max: bool = False,
) -> DataFrame:
    """Flag ticks more than ``tolerance`` seconds older than the one that arrived before.

    ``against_max`` compares with the newest tick seen so far instead.
    """
    kind = "max" if against_max else "last"
    rows = running(df, by, [arrival], {"_seen": (kind, F.col("us"))}, inclusive=False)
    late = (F.col("_seen") - F.col("us")) / SECOND
    return rows.withColumns(
        {
            "late_seconds": F.when(late > 0, late).otherwise(F.lit(0.0)),
            "out_of_order": F.coalesce(late > tolerance, F.lit(False)),
        }
    ).drop("_seen")
