"""Drift between a reference and a current table, and data quality summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.ticks import add_return_range, analysis_columns, common_columns, known
from tidemark.operators.joins import asof_join
from tidemark.operators.ranges import running, settled
from tidemark.operators.splits import split_ratio, split_train_test
from tidemark.session import materialize

WASSERSTEIN_CUT = 0.1
STD_FLOOR = 0.001
# Severity bands of the drift score, and the shares that call for action.
SEVERE, MEDIUM = 2.0, 0.5
DETECTED_SHARE, ACTION_SHARE = 0.5, 0.75


def _long(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, side, x) rows of both tables without missing values."""
    def side(df: DataFrame, name: str) -> DataFrame:
        wide = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
        return wide.unpivot([], list(columns), "feature", "x").withColumn("side", F.lit(name))

    both = side(reference, "ref").unionByName(side(current, "cur"))
    return both.where(known(F.col("x")).isNotNull())


def _steps(long: DataFrame) -> DataFrame:
    """Both empirical distributions of each feature at every distinct value.

    Equal values are merged and written before anything is ordered: sizes and deviation come from
    the merged values, so both tables are read once. Running counts go by value ranges, so a
    feature is never ordered inside one task.
    """
    ref, cur = F.col("side") == "ref", F.col("side") == "cur"
    values = materialize(
        long.groupBy("feature", "x").agg(F.count_if(ref).alias("r"), F.count_if(cur).alias("c"))
    )
    sizes = values.groupBy("feature").agg(
        F.sum("r").alias("n_ref"), F.sum("c").alias("n_cur"),
        F.try_divide(F.sum(F.col("x") * F.col("r")), F.sum("r")).alias("_mean"),
    )
    off = F.col("x") - F.col("_mean")
    totals = (
        values.join(F.broadcast(sizes), "feature").groupBy("feature")
        .agg(
            F.first("n_ref").alias("n_ref"), F.first("n_cur").alias("n_cur"),
            F.sqrt(F.try_divide(F.sum(F.col("r") * off * off), F.sum("r"))).alias("ref_std"),
        )
    )
    values, points = settled(values, "x", values.count())
    steps = running(
        values,
        ["feature"],
        ["x"],
        {
            "r_below": ("sum", F.col("r")),
            "c_below": ("sum", F.col("c")),
            "x_below": ("max", F.col("x")),
        },
        points,
        inclusive=False,
    )
    return steps.join(F.broadcast(totals), "feature")


def drift_wasserstein(
    reference: DataFrame, current: DataFrame, columns: Sequence[str],
    cut: float = WASSERSTEIN_CUT,
) -> DataFrame:
    """Exact first Wasserstein distance in units of the reference deviation."""
    steps = _steps(_long(reference, current, columns))
    gap = F.abs(F.try_divide("r_below", "n_ref") - F.try_divide("c_below", "n_cur"))
    area = gap * (F.col("x") - F.col("x_below"))
    unit = F.greatest(F.first("ref_std"), F.lit(STD_FLOOR))
    # Without a value on one side there is no distance: NULL, and no verdict of drift.
    both = (F.first("n_ref") > 0) & (F.first("n_cur") > 0)
    found = steps.groupBy("feature").agg(
        F.when(both, F.coalesce(F.sum(area), F.lit(0.0)) / unit).alias("score")
    )
    return _all_columns(found, columns).withColumn("drifted", F.coalesce(F.col("score") >= cut, F.lit(False)))


def _all_columns(found: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``found`` with a row for each column, also for those without any value."""
    names = found.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, columns))).alias("feature"))
    return names.join(found, "feature", "left")


def drift_wasserstein_approx(
    reference: DataFrame, current: DataFrame, columns: Sequence[str],
    cut: float = WASSERSTEIN_CUT, points: int = 1000,
) -> DataFrame:
    """The same from percentile sketches: no ordering and no shuffle of the values."""
    grid = [(i + 0.5) / points for i in range(points)]
    ref, cur = F.col("side") == "ref", F.col("side") == "cur"
    sketch = _long(reference, current, columns).groupBy("feature").agg(
        F.percentile_approx(F.when(ref, F.col("x")), grid, 10 * points).alias("a"),
        F.percentile_approx(F.when(cur, F.col("x")), grid, 10 * points).alias("b"),
        F.stddev_pop(F.when(ref, F.col("x"))).alias("ref_std"),
    )
    apart = F.zip_with("a", "b", lambda x, y: F.abs(x - y))
    total = F.aggregate(apart, F.lit(0.0), lambda acc, x: acc + x) / points
    unit = F.greatest(F.col("ref_std"), F.lit(STD_FLOOR))
    found = sketch.select("feature", (total / unit).alias("score"))
    return _all_columns(found, columns).withColumn("drifted", F.coalesce(F.col("score") >= cut, F.lit(False)))


def drift_ks(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic, its asymptotic p-value and the drift band."""
    steps = _steps(_long(reference, current, columns))
    r = F.coalesce("r_below", F.lit(0)) + F.col("r")
    c = F.coalesce("c_below", F.lit(0)) + F.col("c")
    gap = F.abs(F.try_divide(r, F.col("n_ref")) - F.try_divide(c, F.col("n_cur")))
    out = steps.groupBy("feature").agg(
        F.max(gap).alias("statistic"), F.first("n_ref").alias("n_ref"), F.first("n_cur").alias("n_cur")
    )
    n = F.col("n_ref").cast("double") * F.col("n_cur") / (F.col("n_ref") + F.col("n_cur"))
    out = out.withColumn("_lambda", F.sqrt(n) * F.col("statistic"))
    out = out.withColumn("p_value", _kolmogorov(F.col("_lambda"))).drop("_lambda")
    band = F.when(F.col("p_value") > 0.05, "low").when(F.col("p_value") > 0.01, "medium")
    band = F.when(F.col("p_value").isNotNull(), band.otherwise("high"))
    return _all_columns(out.withColumn("band", band), columns)


def _kolmogorov(x: Column) -> Column:
    """Upper tail 2 * sum (-1)^(k-1) exp(-2 k^2 x^2); it is 1 to double precision below 0.2."""
    term = lambda k: F.when(k % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0)) * F.exp(-2 * k * k * x * x)
    total = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)), F.lit(0.0), lambda acc, k: acc + term(k)
    )
    return F.when(x < 0.2, F.lit(1.0)).otherwise(F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0)))


def drift_categorical(reference: DataFrame, current: DataFrame, column: str) -> DataFrame:
    """Total variation and Jensen-Shannon distance between the category shares."""
    both = reference.select(F.col(column).alias("v"), F.lit(1).alias("ref")).unionByName(
        current.select(F.col(column).alias("v"), F.lit(0).alias("ref"))
    ).where(F.col("v").isNotNull())
    counts = both.groupBy("v").agg(
        F.count_if(F.col("ref") == 1).alias("r"), F.count_if(F.col("ref") == 0).alias("c")
    )
    total = counts.agg(F.sum("r").alias("nr"), F.sum("c").alias("nc"))
    shares = counts.crossJoin(F.broadcast(total)).select(
        F.try_divide("r", "nr").alias("p"), F.try_divide("c", "nc").alias("q")
    )
    m = (F.col("p") + F.col("q")) / 2

    def part(p: str) -> Column:
        return F.when(F.col(p) > 0, F.col(p) * F.ln(F.col(p) / m)).otherwise(F.lit(0.0))

    return shares.agg(
        (F.sum(F.abs(F.col("p") - F.col("q"))) / 2).alias("total_variation"),
        F.when(
            (F.count("p") > 0) & (F.count("q") > 0),
            F.sqrt(F.greatest((F.sum(part("p")) + F.sum(part("q"))) / 2, F.lit(0.0))),
        ).alias("js_distance"),
    ).select(F.lit(column).alias("feature"), "*")


def dataset_drift(drift: DataFrame) -> DataFrame:
    """Share of drifted columns and the two verdicts on it."""
    counts = drift.agg(
        F.count("*").alias("columns"), F.count_if("drifted").alias("drifted_columns")
    )
    share = F.coalesce(F.try_divide(F.col("drifted_columns"), F.col("columns")), F.lit(0.0))
    return counts.withColumn("share", share).withColumns(
        {
            "drift_detected": F.col("share") > DETECTED_SHARE,
            "action_required": F.col("share") > ACTION_SHARE,
        }
    )


def drift_severity(drift: DataFrame, severe: float = SEVERE, medium: float = MEDIUM) -> DataFrame:
    band = (
        F.when(~F.col("drifted"), "none")
        .when(F.col("score") > severe, "high")
        .when(F.col("score") > medium, "medium")
        .otherwise("low")
    )
    return drift.withColumn("severity", band)


def retrain_trigger(
    summary: DataFrame, pr_auc: float | None = None, pr_auc_before: float | None = None,
    days_persisting: float = 0,
) -> DataFrame:
    """Retrain when most columns drift, the ranking quality drops by over 5 %, or drift lasts."""
    drop = (
        F.lit(False)
        if not pr_auc_before or pr_auc is None
        else F.lit((pr_auc_before - pr_auc) / pr_auc_before > 0.05)
    )
    return summary.withColumns(
        {
            "by_share": F.col("share") > ACTION_SHARE,
            "by_quality": drop,
            "by_duration": F.col("drift_detected") & F.lit(days_persisting > 14),
        }
    ).withColumn("retrain", F.col("by_share") | F.col("by_quality") | F.col("by_duration"))


def top_drift(drift: DataFrame, n: int = 3) -> DataFrame:
    return drift.orderBy(F.desc("score"), "feature").limit(n)


def dataset_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, columns, copies of whole rows, and columns with at most one value."""
    rows = df.select(*columns).groupBy(*columns).agg(F.count("*").alias("_n"))
    constant = sum(
        (F.min(c).eqNullSafe(F.max(c))).cast("bigint") for c in columns
    )
    return rows.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.lit(len(columns)).cast("bigint").alias("columns"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
        constant.alias("constant_columns"),
    )


def missing_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: nulls, NaNs, infinities and empty strings, from one pass."""
    types = dict(df.dtypes)
    kinds = ["nulls", "nans", "infinities", "empty_strings"]
    no = F.lit(False)
    found = []
    for c in columns:
        value = F.col(c)
        floating = types[c] in ("double", "float")
        text = types[c] == "string"
        found.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count("*").alias("rows"),
                F.count_if(value.isNull()).alias("nulls"),
                F.count_if(F.isnan(value) if floating else no).alias("nans"),
                F.count_if(
                    F.abs(value) == F.lit(float("inf")) if floating else no
                ).alias("infinities"),
                F.count_if(value == "" if text else no).alias("empty_strings"),
            )
        )
    rows = df.agg(F.array(*found).alias("c")).select(F.inline("c"))
    missing = sum(F.col(k) for k in kinds)
    return rows.withColumn("missing_share", F.coalesce(F.try_divide(missing, F.col("rows")), F.lit(0.0)))


def drift_report(
    reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None,
    prediction: str | None = None,
) -> DataFrame:
    """Summary, missing values, column and dataset drift as (section, column, metric, value)."""
    reference, current = add_return_range(reference), add_return_range(current)
    columns = common_columns(
        reference, current, list(columns or analysis_columns(reference))
    )
    drift = materialize(drift_wasserstein(reference, current, columns))
    parts = [
        _tidy(drift.withColumn("drifted", F.col("drifted").cast("int")), "column_drift",
              F.col("feature"), ["score", "drifted"]),
        _tidy(_flags(dataset_drift(drift)), "dataset_drift", F.lit("*"),
              ["columns", "drifted_columns", "share", "drift_detected", "action_required"]),
    ]
    for name, df in (("reference", reference), ("current", current)):
        parts.append(
            _tidy(dataset_summary(df, columns), f"{name}_summary", F.lit("*"),
                  ["rows", "columns", "duplicate_rows", "constant_columns"])
        )
        parts.append(
            _tidy(missing_values(df, columns), f"{name}_missing", F.col("column"),
                  ["nulls", "nans", "infinities", "missing_share"])
        )
    if prediction and prediction in reference.columns and prediction in current.columns:
        parts.append(
            _tidy(drift_categorical(reference, current, prediction), "prediction_drift",
                  F.col("feature"), ["total_variation", "js_distance"])
        )
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def with_predictions(
    features: DataFrame, predictions: DataFrame, tolerance: float = 1, by: Sequence[str] = ()
) -> DataFrame:
    """Features with the score and prediction closest in time (for prediction drift)."""
    return asof_join(
        features, predictions, ["score", "prediction"], by=by,
        tolerance=int(tolerance * 1_000_000),
    )


def early_late_report(df: DataFrame, ratio: float = 0.5, **kw) -> DataFrame:
    """The report on the early against the late part of one table."""
    parts = split_ratio(df, ratio)
    return drift_report(
        parts.where("split = 'reference'"), parts.where("split = 'current'"), **kw
    )


def train_test_report(df: DataFrame, val: float = 0.15, test: float = 0.15, **kw) -> DataFrame:
    """The report on the training against the test part of one table."""
    parts = split_train_test(df, val, test)
    return drift_report(parts.where("split = 'train'"), parts.where("split = 'test'"), **kw)


def _flags(df: DataFrame) -> DataFrame:
    flags = [n for n, t in df.dtypes if t == "boolean"]
    return df.withColumns({n: F.col(n).cast("int") for n in flags})


def _tidy(df: DataFrame, section: str, column: Column, metrics: Sequence[str]) -> DataFrame:
    wide = df.select(
        F.lit(section).alias("section"),
        column.alias("feature"),
        *[F.col(m).cast("double").alias(f"_m_{m}") for m in metrics],
    ).toDF("section", "feature", *metrics)
    return wide.unpivot(["section", "feature"], list(metrics), "metric", "value")
