"""Latency, error-rate and freshness figures of a request log, and alerts on them."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ranges import (
    BEFORE,
    UPTO,
    global_rank,
    halo,
    order_statistics,
    range_points,
    running,
    settled,
    sweep,
)
from tidemark.schema import LATENCY_BUCKETS
from tidemark.session import materialize

MINUTE = 60_000_000
# Service targets.
P95_TARGET_MS, SUCCESS_TARGET = 800.0, 99.0


def _exclusive(n: int, i: int, parts: int) -> tuple[int, int, float]:
    """Neighbour ranks and weight of the i-th of ``parts`` cut points at i (n + 1) / parts."""
    at = min(max(i * (n + 1) // parts, 1), n - 1)
    return at, at + 1, (i * (n + 1) - at * parts) / parts


def latency_summary(
    df: DataFrame, latency: str = "latency_ms", ok: Column | None = None,
    elapsed_seconds: float | None = None,
) -> DataFrame:
    """Counts, success rate, and exact min, mean, median, p95 and p99 of the latencies.

    Percentiles use the exclusive rule h = p (n + 1). With fewer than 20 (p95) or 100 (p99)
    values they are the maximum.
    """
    ok = F.col("success") if ok is None else ok

    def ranks(n: int):
        if n == 0:
            return []
        want = [(n + 1) // 2, n // 2 + 1]
        for least, i, parts in ((20, 19, 20), (100, 99, 100)):
            want += list(_exclusive(n, i, parts)[:2]) if n >= least else [n]
        return want

    n, values = order_statistics(df, latency, ranks)

    def cut(least: int, i: int, parts: int) -> float | None:
        if n == 0:
            return None
        if n < least:
            return values[n]
        low, high, part = _exclusive(n, i, parts)
        return values[low] * (1 - part) + values[high] * part

    median = (values[(n + 1) // 2] + values[n // 2 + 1]) / 2 if n else None
    base = df.agg(
        F.count("*").alias("total_requests"),
        F.count_if(ok).alias("successful_requests"),
        F.min(latency).alias("min_ms"),
        F.max(latency).alias("max_ms"),
        F.avg(latency).alias("mean_ms"),
    )
    total = F.col("total_requests")
    out = base.withColumns(
        {
            "failed_requests": total - F.col("successful_requests"),
            "success_rate": F.coalesce(
                F.try_divide(F.col("successful_requests") * 100.0, total), F.lit(0.0)
            ),
            "median_ms": F.lit(median).cast("double"),
            "p95_ms": F.lit(cut(20, 19, 20)).cast("double"),
            "p99_ms": F.lit(cut(100, 99, 100)).cast("double"),
        }
    )
    if elapsed_seconds:
        out = out.withColumn("per_second", total / F.lit(float(elapsed_seconds)))
    return out


def slo_verdict(summary: DataFrame) -> DataFrame:
    return summary.select(
        "p95_ms",
        "success_rate",
        (F.col("p95_ms") <= P95_TARGET_MS).alias("latency_ok"),
        (F.col("success_rate") >= SUCCESS_TARGET).alias("success_ok"),
    )


def inference_stats(df: DataFrame, milliseconds: str = "latency_ms") -> DataFrame:
    """Total, time, mean and throughput of a log of single predictions."""
    seconds = F.coalesce(F.sum(milliseconds) / 1000, F.lit(0.0))
    return df.agg(
        F.count("*").alias("total_predictions"), seconds.alias("total_time_seconds")
    ).withColumns(
        {
            "avg_inference_time_ms": F.coalesce(
                F.try_divide(F.col("total_time_seconds") * 1000, F.col("total_predictions")),
                F.lit(0.0),
            ),
            "throughput_per_second": F.coalesce(
                F.try_divide(F.col("total_predictions"), F.col("total_time_seconds")), F.lit(0.0)
            ),
        }
    )


def error_counts(df: DataFrame, error: str = "error") -> DataFrame:
    return df.where(F.col(error).isNotNull()).groupBy(error).agg(F.count("*").alias("n"))


def latency_shares(
    df: DataFrame, latency: str = "latency_ms", below: Sequence[float] = (50, 100, 500)
) -> DataFrame:
    return df.agg(
        *[
            F.avg((F.col(latency) < b).cast("double")).alias(f"below_{b:g}_ms")
            for b in below
        ]
    )


def latency_histogram(
    df: DataFrame, seconds: Column, by: Sequence[str] = (),
    buckets: Sequence[float] = tuple(LATENCY_BUCKETS),
) -> DataFrame:
    """Cumulative bucket counts (``le``, ``cumulative``), the last bucket being infinite."""
    bounds = [*buckets, float("inf")]
    rows = [
        F.struct(F.lit(b).alias("le"), F.count_if(seconds <= b).alias("cumulative"))
        for b in bounds
    ]
    return df.groupBy(*by).agg(F.array(*rows).alias("h")).select(*by, F.inline("h"))


def histogram_quantile(histogram: DataFrame, share: float, by: Sequence[str] = ()) -> DataFrame:
    """Quantile from cumulative buckets, linear inside the bucket.

    The first bucket starts at 0; a quantile in the infinite bucket is the highest finite
    bound. A key has one row per bucket, so its window is as small as the bucket list.
    """
    line = Window.partitionBy(*by).orderBy("le")
    whole = Window.partitionBy(*by)
    rows = histogram.select(
        *by,
        "le",
        "cumulative",
        F.coalesce(F.lag("le").over(line), F.lit(0.0)).alias("low"),
        F.coalesce(F.lag("cumulative").over(line), F.lit(0)).alias("below"),
        (F.max("cumulative").over(whole) * share).alias("rank"),
    )
    hit = rows.where((F.col("cumulative") >= F.col("rank")) & (F.col("rank") > 0))
    inside = F.col("low") + (F.col("le") - F.col("low")) * F.try_divide(
        F.col("rank") - F.col("below"), F.col("cumulative") - F.col("below")
    )
    value = F.when(F.col("le") == F.lit(float("inf")), F.col("low")).otherwise(inside)
    return hit.groupBy(*by).agg(F.min_by(value, F.col("le")).alias("quantile"))


def moving_rates(
    df: DataFrame, status: Column, by: Sequence[str] = (), minutes: int = 5
) -> DataFrame:
    """Requests, errors and their rates in windows of ``minutes`` that move by one minute.

    Rows are first counted per minute; only those counts are spread over the windows.
    """
    minute = F.floor(F.col("us") / MINUTE).cast("bigint")
    cells = df.groupBy(*by, minute.alias("_m")).agg(
        F.count("*").alias("n"),
        F.count_if(status >= 400).alias("e"),
        F.count_if(status >= 500).alias("e5"),
        F.count_if(status.between(200, 299)).alias("s"),
    )
    starts = F.sequence(F.col("_m") - (minutes - 1), F.col("_m"))
    spread = cells.withColumn("_w", F.explode(starts))
    sums = spread.groupBy(*by, "_w").agg(
        F.sum("n").alias("requests"), F.sum("e").alias("errors"),
        F.sum("e5").alias("server_errors"), F.sum("s").alias("successes"),
    )
    return sums.select(
        *by,
        (F.col("_w") * MINUTE).alias("window_us"),
        "requests",
        "errors",
        "server_errors",
        (F.col("errors") / F.col("requests")).alias("error_rate"),
        (F.col("successes") / F.col("requests")).alias("success_rate"),
        (F.col("requests") / (minutes * 60)).alias("per_second"),
    )


def alert_islands(
    series: DataFrame, condition: Column, hold_minutes: float, by: Sequence[str] = (),
    step_minutes: float = 1, time: str = "window_us", severity: str = "warning",
) -> DataFrame:
    """Stretches in which a condition holds at every step for at least ``hold_minutes``.

    A missing step ends a stretch.
    """
    step = int(step_minutes * MINUTE)
    rows, points = settled(series.withColumn("_on", F.coalesce(condition, F.lit(False))), time)
    state = F.struct(F.col(time).alias("t"), F.col("_on").alias("on"))
    goes_on = F.col("_before.on") & (F.col(time) - F.col("_before.t") <= step)
    start = (F.col("_on") & ~F.coalesce(goes_on, F.lit(False))).cast("bigint")
    levels = [
        (None, {"_before": ("last", state, BEFORE)}),
        (None, {"island": ("sum", start, UPTO)}),
    ]
    rows = sweep(rows, by, [time], levels, points).where("_on")
    islands = rows.groupBy(*by, "island").agg(
        F.min(time).alias("first_us"), F.max(time).alias("last_us"), F.count("*").alias("steps")
    )
    held = F.col("last_us") - F.col("first_us") >= int(hold_minutes * MINUTE)
    return islands.where(held).withColumn("severity", F.lit(severity)).drop("island")


def moving_quantile(
    df: DataFrame, seconds: Column, share: float, by: Sequence[str] = (), minutes: int = 5,
    buckets: Sequence[float] = tuple(LATENCY_BUCKETS),
) -> DataFrame:
    """Histogram quantile in windows of ``minutes`` that move by one minute.

    Rows become bucket counts per minute first, and only those are spread over the windows.
    """
    bounds = [*buckets, float("inf")]
    minute = F.floor(F.col("us") / MINUTE).cast("bigint")
    cells = df.groupBy(*by, minute.alias("_m")).agg(
        *[F.count_if(seconds <= b).alias(f"_{i}") for i, b in enumerate(bounds)]
    )
    starts = F.sequence(F.col("_m") - (minutes - 1), F.col("_m"))
    windows = cells.withColumn("_w", F.explode(starts)).groupBy(*by, "_w").agg(
        *[F.sum(f"_{i}").alias(f"_{i}") for i in range(len(bounds))]
    )
    rows = [
        F.struct(F.lit(b).alias("le"), F.col(f"_{i}").alias("cumulative"))
        for i, b in enumerate(bounds)
    ]
    histogram = windows.select(*by, "_w", F.inline(F.array(*rows)))
    return histogram_quantile(histogram, share, [*by, "_w"]).select(
        *by, (F.col("_w") * MINUTE).alias("window_us"), "quantile"
    )


# Alert limits (server errors per second, p95 seconds, requests per second,
# messages behind), minutes they must hold, and severities.
ALERTS = {
    "server_errors": (0.01, 5, "warning"),
    "latency": (0.8, 5, "warning"),
    "request_rate": (100.0, 5, "info"),
    "consumer_lag": (1000.0, 5, "warning"),
}


def service_alerts(
    df: DataFrame, status: Column, seconds: Column, by: Sequence[str] = (), minutes: int = 5,
    limits: dict[str, float] | None = None,
) -> DataFrame:
    """Stretches in which server errors, p95 latency or the request rate pass their limits."""
    limits = {name: limit for name, (limit, _, _) in ALERTS.items()} | (limits or {})
    rates = materialize(moving_rates(df, status, by, minutes))
    slow = materialize(moving_quantile(df, seconds, 0.95, by, minutes))
    series = {
        "server_errors": (rates, F.col("server_errors") / (minutes * 60)),
        "latency": (slow, F.col("quantile")),
        "request_rate": (rates, F.col("requests") / (minutes * 60)),
    }
    out = None
    for name, (table, value) in series.items():
        _, hold, severity = ALERTS[name]
        rows = alert_islands(table, value > limits[name], hold, by, severity=severity)
        rows = rows.select(*by, F.lit(name).alias("alert"), "first_us", "last_us", "steps", "severity")
        out = rows if out is None else out.unionByName(rows)
    return out


def lag_alerts(lags: DataFrame, by: Sequence[str] = ("topic",), limit: float | None = None) -> DataFrame:
    """Stretches in which a topic's total lag (rows of ``window_us``, ``lag``) is too high."""
    most, hold, severity = ALERTS["consumer_lag"]
    series = lags.groupBy(*by, "window_us").agg(F.sum("lag").alias("lag"))
    return alert_islands(series, F.col("lag") > (limit or most), hold, by, severity=severity)


def rolling_score(
    df: DataFrame, n: int = 100, by: Sequence[str] = ("model_variant",),
    order: Sequence[str] = ("us", "seq"),
) -> DataFrame:
    """Mean of the last ``n`` scores of each key.

    The rows' global ranks are cut into even blocks with ``n - 1`` rows of overlap.
    """
    ranked = global_rank(df, by, order, "_rank")
    blocks = halo(ranked, width=1000 * n, back=n - 1, us="_rank")
    line = Window.partitionBy(*by, "bucket").orderBy("_rank").rowsBetween(-(n - 1), 0)
    return (
        blocks.withColumn("rolling_score", F.avg("score").over(line))
        .where("home")
        .drop("bucket", "home", "_rank")
    )


def latest_score(
    df: DataFrame, by: Sequence[str] = ("model_variant",), order: Sequence[str] = ("us", "seq")
) -> DataFrame:
    return df.groupBy(*by).agg(F.max_by("score", F.struct(*order)).alias("latest_score"))


def freshness(
    df: DataFrame, now_us: int | Column, by: Sequence[str] = (), yellow: float = 2, red: float = 10
) -> DataFrame:
    """Seconds since the last row, and the colour of that age."""
    now = F.lit(now_us) if isinstance(now_us, int) else now_us
    age = df.groupBy(*by).agg(F.max("us").alias("last_us")).withColumn(
        "age_seconds", (now - F.col("last_us")) / 1_000_000
    )
    level = F.when(F.col("age_seconds") >= red, "red").when(F.col("age_seconds") >= yellow, "yellow")
    return age.withColumn("level", level.otherwise("green"))
