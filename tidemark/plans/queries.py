"""Every operator as a query over the given tables, with its check SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import ticks as tk
from tidemark.operators import drift as dr
from tidemark.operators import joins, labels, metrics, models, quality, sketches, slo, splits, stats
from tidemark.operators.features import tick_features
from tidemark.operators.scoring import baseline_score, baseline_scorer, fit_baseline, score_table
from tidemark.plans import sql as q
from tidemark.plans import tape as v
from tidemark.plans.registry import query, r, rounded, sr
from tidemark.schema import FEATURE_ALIASES, MODEL_FEATURES
from tidemark.session import materialize, scratch_path
from tidemark.sources import feed, files, messages, replay, sinks

KEY = ["product_id", "us", "seq"]
NOW_US = 1_706_659_200_000_000  # 2024-01-31 00:00 UTC, just after the last event
SPIKE = "cast(volatility_spike as double) as volatility_spike"
DRIFT_COLUMNS = ["price", "best_ask", "bid_qty", "trade_size"]


def features(spark: SparkSession, sf: str, keep=()) -> DataFrame:
    return tick_features(v.tape(spark, sf), v.TAPE_FRAMES, keep=keep)


def rounded_features(df: DataFrame) -> DataFrame:
    return df.withColumns({n: r(n, q.places(n)) for n, t in df.dtypes if t == "double"})


def labelled(spark: SparkSession, sf: str, keep=()) -> DataFrame:
    return labels.spike_label(v.tape(spark, sf), v.HORIZON, v.GAP, keep=keep)


# --- sources and projections -------------------------------------------------------------


@query(
    "decode_feed",
    f"""WITH {q.TAPE}
    SELECT seq, product_id, us, price,
           CASE WHEN seq % 3 <> 2 THEN best_bid END AS best_bid,
           CASE WHEN seq % 3 <> 2 THEN best_ask END AS best_ask,
           CASE WHEN seq % 3 = 0 THEN bid_qty END AS bid_qty,
           CASE WHEN seq % 3 = 0 THEN ask_qty END AS ask_qty,
           CASE WHEN seq % 3 <> 2 THEN trade_size END AS volume_24h,
           CASE WHEN seq % 3 <> 0 THEN trade_size END AS trade_size
    FROM tape WHERE seq % 97 <> 0 AND seq % 50 <> 0""",
)
def decode_feed(spark, sf):
    decoded = feed.decode_feed(v.envelopes(spark, sf))
    ticks = feed.drop_invalid_times(feed.parse_ticks(decoded))
    return ticks.select(
        "seq", "product_id", "us", "price", "best_bid", "best_ask", "bid_qty", "ask_qty",
        "volume_24h", "trade_size",
    )


@query(
    "decode_ticks_top_level",
    f"""WITH {q.TAPE}
    SELECT seq, product_id, us, price, CASE WHEN seq % 4 <> 3 THEN bid_qty END AS bid_qty,
           CASE WHEN seq % 4 <> 3 THEN ask_qty END AS ask_qty, trade_size FROM tape""",
)
def decode_ticks_top_level(spark, sf):
    """Tick JSON with quantities and sizes in ``raw``, beside the price, in both, and only half there."""
    t, kind = v.tape(spark, sf), F.col("seq") % 4
    raw, top = (kind == 0), (kind == 1)
    text = {c: F.col(c).cast("string") for c in ("price", "bid_qty", "ask_qty", "trade_size")}
    inner = F.struct(
        F.when(raw | (kind > 1), text["bid_qty"]).alias("best_bid_quantity"),
        F.when(raw, text["ask_qty"]).alias("best_ask_quantity"),
        F.when(raw, text["trade_size"]).alias("size"),
        F.when(kind == 3, text["trade_size"]).alias("volume"),
    )
    value = F.to_json(
        F.struct(
            tk.iso_utc(F.timestamp_micros("us")).alias("timestamp"),
            "product_id",
            text["price"].alias("price"),
            F.when(top, text["bid_qty"]).alias("best_bid_quantity"),
            F.when(top | (kind == 2), text["ask_qty"]).alias("best_ask_quantity"),
            F.when(top, text["trade_size"]).alias("trade_size"),
            F.when(kind == 2, text["trade_size"]).alias("size"),
            inner.alias("raw"),
        )
    )
    ticks = feed.ticks_from_json(t.select("seq", value.alias("value")))
    return ticks.select("seq", "product_id", "us", "price", "bid_qty", "ask_qty", "trade_size")


@query(
    "prediction_log_roundtrip",
    f"""WITH {q.PREDS}
    SELECT p.product_id, p.us, p.model_version, 'ml' AS model_variant, p.score, p.prediction, 2 AS schema_version,
           t.price, t.price / 1000 AS log_return_300s, CAST(p.k AS DOUBLE) AS trade_intensity_300s,
           CASE WHEN p.k % 3 = 0 THEN t.price / 7 END AS spread_mean_60s
    FROM preds AS p JOIN tape AS t ON p.seq = t.seq""",
)
def prediction_log_roundtrip(spark, sf):
    """The prediction log, written by day and read back from its files."""
    p, t = v.predictions(spark, sf), v.tape(spark, sf).select("seq", "price")
    given = {
        "log_return_300s": F.col("price") / 1000,
        "trade_intensity_300s": F.col("k").cast("double"),
        "spread_mean_60s": F.when(F.col("k") % 3 == 0, F.col("price") / 7),
    }
    empty = {f: F.lit(0.0) for f in MODEL_FEATURES if f not in given}
    scored = p.join(t, "seq").withColumns({**given, **empty, "model_variant": F.lit("ml")})
    path = scratch_path(spark, "prediction-log")
    sinks.write_prediction_log(scored, path, files_per_day=2)
    log = files.prediction_files(spark, path)
    return log.select(
        "product_id", "us", "model_version", "model_variant", "score", "prediction",
        "schema_version", "price", *[F.col(f"features.{f}").alias(f) for f in given],
    )


@query(
    "decode_feature_messages",
    f"""WITH {q.TAPE}
    SELECT CASE WHEN seq % 97 = 0 THEN 'broken' WHEN seq % 50 = 0 THEN 'empty'
                WHEN seq % 31 = 0 THEN 'time' ELSE 'ok' END AS reason,
           count(*) AS messages, count(CASE WHEN seq % 97 > 0 AND seq % 50 > 0 AND k % 5 > 0 THEN 1 END) AS spreads,
           sum(CASE WHEN seq % 97 > 0 AND seq % 50 > 0 THEN k ELSE 0 END) AS intensity
    FROM tape GROUP BY 1""",
)
def decode_feature_messages(spark, sf):
    """Feature messages among broken ones, with quoted, unusable and missing numbers."""
    t, k, i = v.tape(spark, sf), F.col("k"), F.col("seq")
    time = F.when(i % 31 == 0, "soon").otherwise(tk.iso_utc(F.timestamp_micros("us")))
    spread = F.when(k % 5 == 1, F.col("price").cast("string")).when(k % 5 == 0, "n/a").otherwise("1")
    good = F.to_json(
        F.struct(
            time.alias("timestamp"), "product_id", "price", spread.alias("spread_mean_60s"),
            k.alias("trade_intensity_300s"),
        )
    )
    value = F.when(i % 97 == 0, '{"timestamp": ').when(i % 50 == 0, " ").otherwise(good)
    rows = messages.read_features(t.select(value.alias("value")))
    return rows.groupBy(F.coalesce("reason", F.lit("ok")).alias("reason")).agg(
        F.count("*").alias("messages"),
        F.count("spread_mean_60s").alias("spreads"),
        F.coalesce(F.sum("trade_intensity_300s"), F.lit(0.0)).cast("bigint").alias("intensity"),
    )


_PROPS = "CASE WHEN event_id % 97 = 0 THEN '{\"k\": ' WHEN event_id % 50 = 0 THEN '  ' ELSE props END"


@query(
    "json_quarantine",
    """SELECT CASE WHEN event_id % 97 = 0 THEN 'broken' WHEN event_id % 50 = 0 THEN 'empty'
                   ELSE 'ok' END AS reason, count(*) AS n
       FROM events GROUP BY 1""",
)
def json_quarantine(spark, sf):
    rows = v.table(spark, sf, "events").select(F.expr(_PROPS).alias("value"))
    good, bad = feed.json_quarantine(rows)
    both = good.withColumn("reason", F.lit("ok")).unionByName(bad)
    return both.groupBy("reason").agg(F.count("*").alias("n"))


@query(
    "retime",
    f"""WITH {q.TAPE}
    SELECT seq, us - (SELECT min(us) FROM tape) + {NOW_US} AS us FROM tape""",
)
def retime(spark, sf):
    return replay.retime(v.tape(spark, sf).select("seq", "us"), NOW_US)


@query(
    "iso_time",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS iso, epoch_us(ts) AS parsed_us
       FROM events""",
)
def iso_time(spark, sf):
    rows = v.table(spark, sf, "events").select("event_id", tk.iso_utc(F.col("ts")).alias("iso"))
    parsed = tk.event_time(F.col("iso"), F.lit(None))
    return rows.select("event_id", "iso", tk.micros(parsed).alias("parsed_us"))


@query(
    "midprice",
    f"""WITH {q.TAPE}
    SELECT seq, {sr("CASE WHEN k % 4 = 0 THEN price WHEN k % 4 = 1 THEN NULL "
                    "WHEN best_bid > 0 AND best_ask > 0 THEN (best_bid + best_ask) / 2 END", "price", 9)}
    FROM tape""",
)
def midprice(spark, sf):
    """Tick JSON with a price, a broken price, and without the price key."""
    t, k = v.tape(spark, sf), F.col("k")
    bid, ask = (F.col(c).cast("string").alias(c) for c in ("best_bid", "best_ask"))
    time = tk.iso_utc(F.timestamp_micros("us")).alias("timestamp")
    with_price = F.to_json(F.struct(time, F.col("price").cast("string").alias("price"), bid, ask))
    unusable = F.to_json(F.struct(time, F.lit("n/a").alias("price"), bid, ask))
    without = F.to_json(F.struct(time, bid, ask))
    text = F.when(k % 4 == 0, with_price).when(k % 4 == 1, unusable).otherwise(without)
    ticks = feed.ticks_from_json(t.select("seq", text.alias("value")))
    return ticks.select("seq", r("price", 9).alias("price"))


@query(
    "spread",
    f"""WITH {q.TAPE}
    SELECT seq, {sr("CASE WHEN best_bid > 0 AND best_ask > 0 THEN best_ask - best_bid END", "spread")},
           {sr("CASE WHEN (best_bid + best_ask) / 2 > 0 THEN (best_ask - best_bid)"
               " / ((best_bid + best_ask) / 2) * 10000 END", "spread_bps")}
    FROM tape""",
)
def spread(spark, sf):
    bid, ask = F.col("best_bid"), F.col("best_ask")
    return v.tape(spark, sf).select(
        "seq", r(tk.spread(bid, ask)).alias("spread"), r(tk.spread_bps(bid, ask)).alias("spread_bps")
    )


@query(
    "obi_row",
    f"""WITH {q.TAPE}
    SELECT seq, {sr("CASE WHEN bid_qty + ask_qty > 0 THEN bid_qty / (bid_qty + ask_qty) END", "book_imbalance")}
    FROM tape""",
)
def obi_row(spark, sf):
    book = tk.book_imbalance(F.col("bid_qty"), F.col("ask_qty"))
    return v.tape(spark, sf).select("seq", r(book).alias("book_imbalance"))


@query(
    "trade_size",
    f"""WITH {q.TAPE}
    SELECT seq, CASE k % 3 WHEN 0 THEN trade_size WHEN 1 THEN trade_size + 1 ELSE trade_size + 2 END
                AS trade_size FROM tape""",
)
def trade_size(spark, sf):
    """The size stands in one of three fields; the others are empty or missing."""
    k, size = F.col("k") % 3, F.col("trade_size")
    return v.tape(spark, sf).select(
        "seq",
        tk.number(
            tk.first_truthy(
                F.when(k == 0, size.cast("string")).otherwise(F.lit("")),
                F.when(k == 1, (size + 1).cast("string")),
                (size + 2).cast("string"),
            )
        ).alias("trade_size"),
    )


@query(
    "sanitize",
    f"""WITH {q.BROKEN}
    SELECT seq, CASE WHEN x IS NULL THEN NULL WHEN isnan(x) OR isinf(x) THEN 0.0 ELSE x END AS x
    FROM broken""",
)
def sanitize(spark, sf):
    return tk.sanitize(v.broken_values(spark, sf)).select("seq", "x")


@query(
    "select_features",
    f"""WITH {q.ROWS}
    SELECT seq, {sr("coalesce(log_return_300s, 0)", "log_return_300s")},
           {sr("coalesce(order_book_imbalance_30s, 0)", "order_book_imbalance_30s")}
    FROM rows_in""",
)
def select_features(spark, sf):
    rows = v.request_rows(spark, sf).drop("spread_mean_60s")
    return rounded(tk.select_features(rows, keep=["seq"]))


def _filled_sql() -> str:
    alias = {
        "log_return_300s": "coalesce(log_return_300s, ret_mean, 0)",
        "realized_volatility_300s": "coalesce(ret_std, 0)",
        "trade_intensity_300s": "n",
        "order_book_imbalance_30s": "coalesce(order_book_imbalance_30s, 0.5)",
        "spread_mean_60s": "coalesce(TRY_CAST(spread_mean_60s AS DOUBLE), 0)",
    }
    default = {f: "0.5" if f.startswith("order_book") else "0" for f in MODEL_FEATURES}
    return ", ".join(sr(alias.get(f, default[f]), f) for f in MODEL_FEATURES)


@query("default_fill", f"WITH {q.ROWS} SELECT seq, {_filled_sql()} FROM rows_in")
def default_fill(spark, sf):
    rows = tk.default_fill(tk.alias_map(v.request_rows(spark, sf)))
    return rounded(rows.select("seq", *MODEL_FEATURES))


@query(
    "alias_map",
    f"""WITH {q.ROWS}
    SELECT seq, {sr("coalesce(log_return_300s, ret_mean)", "log_return_300s")},
           {sr("ret_std", "realized_volatility_300s")}, {sr("n", "trade_intensity_300s")},
           {sr("coalesce(log_return_300s, ret_mean, 0)", "ret_mean")},
           {sr("coalesce(ret_std, 0)", "ret_std")}, CAST(n AS BIGINT) AS n
    FROM rows_in""",
)
def alias_map(spark, sf):
    rows = tk.alias_back(tk.alias_map(v.request_rows(spark, sf)))
    return rounded(rows.select("seq", *FEATURE_ALIASES.values(), *FEATURE_ALIASES))


@query(
    "range_col",
    f"WITH {q.TAPE} SELECT seq, {sr('price * 1.01 - price * 0.99', 'return_range_60s')} FROM tape",
)
def range_col(spark, sf):
    rows = v.tape(spark, sf).select(
        "seq",
        (F.col("price") * 1.01).alias("return_max_60s"),
        (F.col("price") * 0.99).alias("return_min_60s"),
    )
    return tk.add_return_range(rows).select("seq", r("return_range_60s").alias("return_range_60s"))


# --- filters, limits, splits, sets -------------------------------------------------------


@query(
    "time_slice",
    """SELECT event_id, value FROM events
       WHERE ts BETWEEN TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 240 HOUR
                    AND TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 90 MINUTE""",
)
def time_slice(spark, sf):
    now = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    events = v.table(spark, sf, "events")
    return splits.time_slice(events, now, 240, 90).select("event_id", "value")


@query(
    "pair_filter",
    f"WITH {q.TAPE} SELECT seq, product_id, price FROM tape WHERE product_id IN ('purchase', 'view')",
)
def pair_filter(spark, sf):
    kept = splits.pair_filter(v.tape(spark, sf), ["purchase", "view"])
    return kept.select("seq", "product_id", "price")


@query("first_n", f"WITH {q.TAPE} SELECT seq, us, price FROM tape ORDER BY us, seq LIMIT 1000")
def first_n(spark, sf):
    return splits.first_n(v.tape(spark, sf), 1000).select("seq", "us", "price")


@query(
    "split_ratio",
    f"""WITH {q.HALVES}
    SELECT seq, CASE side WHEN 'ref' THEN 'reference' ELSE 'current' END AS split FROM halves""",
)
def split_ratio(spark, sf):
    return splits.split_ratio(v.tape(spark, sf)).select("seq", "split")


@query(
    "split_train_test",
    f"""WITH {q.TAPE}, numbered AS (
      SELECT seq, row_number() OVER (ORDER BY us, seq) AS rn, count(*) OVER () AS total FROM tape)
    SELECT seq, CASE WHEN rn <= CAST(floor(total * 0.7) AS BIGINT) THEN 'train'
                     WHEN rn <= CAST(floor(total * 0.85) AS BIGINT) THEN 'val'
                     ELSE 'test' END AS split
    FROM numbered""",
)
def split_train_test(spark, sf):
    return splits.split_train_test(v.tape(spark, sf)).select("seq", "split")


@query(
    "split_ties",
    """WITH numbered AS (
      SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn,
             count(*) OVER () AS total FROM orders)
    SELECT o_orderkey, CASE WHEN rn <= CAST(floor(total * 0.5) AS BIGINT) THEN 'reference'
                            ELSE 'current' END AS split
    FROM numbered""",
)
def split_ties(spark, sf):
    """Split by day-resolution times, so that the cut falls among equal times."""
    orders = v.table(spark, sf, "orders").select(
        "o_orderkey", tk.micros(F.col("o_orderdate")).alias("us")
    )
    return splits.split_ratio(orders, order=("us", "o_orderkey")).select("o_orderkey", "split")


@query(
    "split_stratified",
    f"""WITH {q.PREDS}, numbered AS (
      SELECT label, row_number() OVER (PARTITION BY label ORDER BY seq) - 1 AS rn,
             count(*) OVER (PARTITION BY label) AS total FROM preds)
    SELECT label, CASE WHEN rn / total < 0.7 THEN 'train' WHEN rn / total < 0.85 THEN 'val'
                       ELSE 'test' END AS split, count(*) AS n
    FROM numbered GROUP BY 1, 2""",
)
def split_stratified(spark, sf):
    parts = splits.split_stratified(v.predictions(spark, sf), "label", ["seq"])
    return parts.groupBy("label", "split").agg(F.count("*").alias("n"))


@query(
    "split_stratified_rows",
    f"""WITH {q.PREDS}, numbered AS (
      SELECT seq, k % 7 AS class, row_number() OVER w AS rn, count(*) OVER (PARTITION BY k % 7) AS total
      FROM preds WINDOW w AS (PARTITION BY k % 7 ORDER BY CAST('0x' || substr(md5(CAST(seq AS VARCHAR)), 1, 15) AS BIGINT)))
    SELECT seq, class, CASE WHEN rn <= ceil(total * 0.7) THEN 'train'
                            WHEN rn <= ceil(total * 0.85) THEN 'val' ELSE 'test' END AS split
    FROM numbered""",
)
def split_stratified_rows(spark, sf):
    """Row by row, cut by a hash that both sides compute."""
    rows = v.predictions(spark, sf).select("seq", (F.col("k") % 7).alias("class"))
    digest = F.conv(F.substring(F.md5(F.col("seq").cast("string")), 1, 15), 16, 10)
    return splits.split_stratified(rows, "class", ["seq"], spread=digest.cast("bigint"))


# A store of the rows before the last tenth, and incoming rows that repeat its newest part
# and come twice themselves.
_STORE = f"""{q.TAPE}, numbered AS (
  SELECT seq, product_id, us, price, row_number() OVER (ORDER BY us, seq) AS rn, count(*) OVER () AS total
  FROM tape
), stored AS (SELECT seq, product_id, us, price FROM numbered WHERE rn <= CAST(floor(total * 0.9) AS BIGINT)),
late AS (SELECT seq, product_id, us, price FROM numbered WHERE rn > CAST(floor(total * 0.8) AS BIGINT)),
incoming AS (SELECT * FROM late UNION ALL SELECT seq + 1000000000, product_id, us, price FROM late)"""


def _store(spark, sf):
    t = v.tape(spark, sf).select("seq", "product_id", "us", "price")
    parts = splits.time_split(t, [0.8, 0.9], ["old", "both", "new"])
    stored = parts.where("split <> 'new'").drop("split")
    late = parts.where("split <> 'old'").drop("split")
    return stored, late.unionByName(late.withColumn("seq", F.col("seq") + 1_000_000_000))


@query(
    "dedup_append",
    f"""WITH {_STORE}
    SELECT * FROM stored UNION ALL
    SELECT min(seq) AS seq, product_id, us, min(price) AS price FROM incoming
    WHERE (us, product_id) NOT IN (SELECT (us, product_id) FROM stored) GROUP BY product_id, us""",
)
def dedup_append(spark, sf):
    return joins.dedup_append(*_store(spark, sf))


@query(
    "dup_keys",
    f"""WITH {_STORE}
    SELECT us, product_id FROM incoming INTERSECT SELECT us, product_id FROM stored""",
)
def dup_keys(spark, sf):
    return joins.duplicate_keys(*_store(spark, sf))


@query(
    "consolidate",
    f"""WITH {_STORE}, merged AS (
      SELECT min(seq) AS seq, product_id, us, min(price) AS price
      FROM (SELECT * FROM stored UNION ALL SELECT * FROM incoming) GROUP BY product_id, us
    ), spaced AS (SELECT *, us - lag(us) OVER (PARTITION BY product_id ORDER BY us) AS gap FROM merged)
    SELECT seq, product_id, us, price FROM spaced WHERE gap IS NULL OR gap >= 60000000""",
)
def consolidate(spark, sf):
    return joins.consolidate(list(_store(spark, sf)), 60_000_000)


# --- windows -----------------------------------------------------------------------------


@query("tick_features", f"WITH {q.FEATURES} SELECT {q.feature_columns()} FROM features")
def tick_features_query(spark, sf):
    return rounded_features(features(spark, sf).drop("price"))


for _name, _columns in {
    "feat_log_return": ["log_return_300s"],
    "feat_spread_mean": ["spread_mean_60s", "spread_mean_300s"],
    "feat_obi": [
        "order_book_imbalance_30s", "order_book_imbalance_60s", "order_book_imbalance_300s",
    ],
    "feat_intensity": ["trade_intensity_300s"],
    "feat_realized_vol": ["realized_volatility_60s", "realized_volatility_300s"],
    "feat_velocity": ["price_velocity_300s"],
}.items():

    @query(_name, f"WITH {q.FEATURES} SELECT {q.feature_columns(*_columns)} FROM features")
    def _feature(spark, sf, columns=tuple(_columns)):
        return rounded_features(features(spark, sf).select(*KEY, *columns))


@query("gap_chunks", f"WITH {q.CHUNKS} SELECT product_id, us, seq, chunk_id FROM chunks")
def gap_chunks(spark, sf):
    return labels.gap_chunks(v.tape(spark, sf), v.GAP).select(*KEY, "chunk_id")


@query(
    "chunk_sizes",
    f"""WITH {q.CHUNKS} SELECT product_id, chunk_id, count(*) AS n, min(us) AS first_us,
    max(us) AS last_us FROM chunks GROUP BY product_id, chunk_id""",
)
def chunk_sizes(spark, sf):
    return stats.chunk_sizes(labels.gap_chunks(v.tape(spark, sf), v.GAP))


@query(
    "fwd_vol", f"WITH {q.LABELS} SELECT product_id, us, seq, {sr('vol', 'future_volatility')} FROM vols"
)
def fwd_vol(spark, sf):
    vol = labels.forward_volatility(v.tape(spark, sf), v.HORIZON, v.GAP)
    return rounded(vol.select(*KEY, "future_volatility"))


@query(
    "vol_threshold",
    f"""WITH {q.LABELS} SELECT {sr('quantile_cont(vol, 0.9)', 'threshold')}, count(vol) AS n FROM vols""",
)
def vol_threshold(spark, sf):
    vol = materialize(
        labels.forward_volatility(v.tape(spark, sf), v.HORIZON, v.GAP).select("future_volatility")
    )
    cut = labels.volatility_threshold(vol)
    return vol.agg(
        r(F.lit(cut).cast("double")).alias("threshold"), F.count("future_volatility").alias("n")
    )


@query("spike_label", f"WITH {q.LABELS} SELECT product_id, us, seq, CAST(volatility_spike AS DOUBLE) AS volatility_spike FROM labeled")
def spike_label(spark, sf):
    return labelled(spark, sf).selectExpr(*KEY, SPIKE)


@query(
    "label_dist",
    f"""WITH {q.LABELS}, known AS (SELECT * FROM labeled WHERE volatility_spike IS NOT NULL)
    SELECT volatility_spike, count(*) AS n, {sr('count(*) / (SELECT count(*) FROM known)', 'share')}
    FROM known GROUP BY volatility_spike""",
)
def label_dist(spark, sf):
    known = labelled(spark, sf).where("volatility_spike is not null")
    return rounded(stats.label_distribution(known, "volatility_spike"))


@query(
    "label_backfill",
    f"""WITH {q.LABELS}
    SELECT product_id, us, seq, CAST(CASE WHEN k % 2 = 0 THEN k % 4 // 2 ELSE volatility_spike END
           AS DOUBLE) AS volatility_spike FROM labeled""",
)
def label_backfill(spark, sf):
    """Half of the rows hold a label already, which stays."""
    fresh = labelled(spark, sf)
    k = F.col("k")
    old = F.when(k % 2 == 0, (k % 4 / 2).cast("int"))
    stored = v.tape(spark, sf).select(*KEY, old.alias("volatility_spike"))
    return labels.label_backfill(stored, fresh).selectExpr(*KEY, SPIKE)


# Arrival order differs from time order: every third message is up to two hours late.
_ARRIVALS = f"""{q.TAPE}, arrivals AS (
  SELECT seq, product_id, CASE WHEN k % 3 = 0 THEN us - (k % 8) * CAST(900000000 AS BIGINT) ELSE us END AS us FROM tape)"""


@query(
    "out_of_order",
    f"""WITH {_ARRIVALS}, seen AS (
      SELECT *, lag(us) OVER (ORDER BY seq) AS before,
             max(us) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest
      FROM arrivals)
    SELECT seq, coalesce((before - us) / 1e6 > 1, false) AS out_of_order,
           coalesce((newest - us) / 1e6 > 1, false) AS behind_newest,
           {sr('greatest(coalesce((before - us) / 1e6, 0), 0)', 'late_seconds')} FROM seen""",
)
def out_of_order(spark, sf):
    k = F.col("k")
    us = F.when(k % 3 == 0, F.col("us") - (k % 8).cast("bigint") * 900_000_000).otherwise(F.col("us"))
    arrivals = v.tape(spark, sf).select("seq", us.alias("us"))
    newest = labels.out_of_order(arrivals, against_max=True).select(
        "seq", "us", F.col("out_of_order").alias("behind_newest")
    )
    return rounded(labels.out_of_order(newest).drop("us"))


@query(
    "rolling_score",
    f"""WITH {q.PREDS}
    SELECT seq, {sr('avg(score) OVER (PARTITION BY model_version ORDER BY us, seq '
                    'ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)', 'rolling_score', 10)} FROM preds""",
)
def rolling_score(spark, sf):
    preds = v.predictions(spark, sf).select("seq", "us", "model_version", "score")
    return rounded(slo.rolling_score(preds, by=["model_version"]).select("seq", "rolling_score"), 10)


@query(
    "latest_score",
    f"""WITH {q.PREDS}
    SELECT model_version, arg_max(score, (us, seq)) AS latest_score FROM preds GROUP BY model_version""",
)
def latest_score(spark, sf):
    return slo.latest_score(v.predictions(spark, sf), by=["model_version"])


@query(
    "session_agg",
    f"""WITH {q.CHUNKS}
    SELECT product_id, count(*) AS n, min(us) AS first_us, max(us) AS last_us
    FROM chunks GROUP BY product_id, chunk_id""",
)
def session_agg(spark, sf):
    return stats.session_summary(v.tape(spark, sf), v.GAP)


# --- joins -------------------------------------------------------------------------------


@query(
    "asof_nearest",
    f"""WITH {q.PREDS}, back AS (
      SELECT p.seq, p.us, t.us AS tat, t.price, t.seq AS tick FROM preds AS p ASOF LEFT JOIN tape AS t
      ON p.product_id = t.product_id AND p.us >= t.us
    ), fwd AS (
      SELECT p.seq, p.us, t.us AS tat, t.price, t.seq AS tick FROM preds AS p ASOF LEFT JOIN tape AS t
      ON p.product_id = t.product_id AND p.us <= t.us
    ), near AS (
      SELECT b.seq, b.us,
             CASE WHEN f.tat IS NULL OR b.us - b.tat <= f.tat - b.us THEN b.tat ELSE f.tat END AS tat,
             CASE WHEN f.tat IS NULL OR b.us - b.tat <= f.tat - b.us THEN b.tick ELSE f.tick END AS tick
      FROM back AS b JOIN fwd AS f USING (seq))
    SELECT seq, CASE WHEN abs(tat - us) <= 30000000 THEN CAST(tick AS DOUBLE) END AS tick,
           CASE WHEN abs(tat - us) <= 30000000 THEN CAST(tat - us AS DOUBLE) END AS distance_us FROM near""",
)
def asof_nearest(spark, sf):
    t = v.tape(spark, sf).select("product_id", "us", F.col("seq").alias("tick"))
    out = joins.asof_join(
        v.predictions(spark, sf).select("product_id", "us", "seq"), t, ["tick"],
        by=["product_id"], tolerance=30_000_000, tie="tick", distance="distance_us",
    )
    return out.select(
        "seq", F.col("tick").cast("double"), F.col("distance_us").cast("double")
    )


def _asof_orders(direction: str):
    """Ship dates against order dates: days, so both sides are full of ties."""

    def run(spark, sf):
        left = v.table(spark, sf, "lineitem").select(
            "l_orderkey", "l_linenumber", tk.micros(F.col("l_shipdate")).alias("us")
        )
        right = v.table(spark, sf, "orders").select(
            tk.micros(F.col("o_orderdate")).alias("us"), "o_orderkey"
        )
        out = joins.asof_join(
            left, right, ["o_orderkey"], direction=direction, tie="o_orderkey",
            tolerance=3 * 86_400_000_000,
        )
        return out.select("l_orderkey", "l_linenumber", "us", F.col("o_orderkey").cast("double"))

    return run


for _direction, _pick, _op in (("backward", "max", ">="), ("forward", "min", "<=")):
    query(
        f"asof_{_direction}",
        f"""WITH days AS (
          SELECT epoch_us(o_orderdate) AS tat, {_pick}(o_orderkey) AS o_orderkey FROM orders GROUP BY 1
        ), ships AS (SELECT l_orderkey, l_linenumber, epoch_us(l_shipdate) AS us FROM lineitem)
        SELECT l_orderkey, l_linenumber, us,
               CASE WHEN abs(tat - us) <= 259200000000 THEN CAST(o_orderkey AS DOUBLE) END AS o_orderkey
        FROM ships ASOF LEFT JOIN days ON ships.us {_op} days.tat""",
    )(_asof_orders(_direction))


# --- aggregates --------------------------------------------------------------------------


@query(
    "mode_version",
    f"""WITH {q.PREDS}, c AS (SELECT model_version, count(*) AS n FROM preds GROUP BY 1)
    SELECT model_version AS mode, n FROM c ORDER BY n DESC, model_version LIMIT 1""",
)
def mode_version(spark, sf):
    return stats.mode_value(v.predictions(spark, sf), "model_version")


@query(
    "range_overlap",
    f"""WITH {q.PREDS}
    SELECT a.*, b.*, CASE WHEN left_last < right_first THEN 'before'
                          WHEN left_first > right_last THEN 'after' ELSE 'overlap' END AS verdict
    FROM (SELECT min(us) AS left_first, max(us) AS left_last, count(*) AS left_n FROM preds) AS a,
         (SELECT min(epoch_us(o_orderdate)) AS right_first, max(epoch_us(o_orderdate)) AS right_last,
                 count(*) AS right_n FROM orders) AS b""",
)
def range_overlap(spark, sf):
    orders = v.table(spark, sf, "orders").select(tk.micros(F.col("o_orderdate")).alias("us"))
    return stats.range_overlap(v.predictions(spark, sf), orders)


@query(
    "score_stats",
    f"""WITH {q.PREDS}
    SELECT count(*) AS n, max(score) AS max, {sr('avg(score)', 'mean')},
           {sr('quantile_cont(score, 0.5)', 'median')}, {sr('quantile_cont(score, 0.9)', 'p90')},
           {sr('quantile_cont(score, 0.95)', 'p95')}, {sr('quantile_cont(score, 0.99)', 'p99')}
    FROM preds""",
)
def score_stats(spark, sf):
    return rounded(stats.score_distribution(v.predictions(spark, sf)))


_SUMMARY = f"""{q.REQUESTS}, s AS (
  SELECT list(latency_ms ORDER BY latency_ms) AS l, count(*) AS n, count(*) FILTER (status = 200) AS ok,
         avg(latency_ms) AS mean FROM requests
), summary AS (
  SELECT n AS total_requests, ok AS successful_requests, l[1] AS min_ms, l[n] AS max_ms, mean AS mean_ms,
         n - ok AS failed_requests, ok * 100.0 / n AS success_rate,
         (l[(n + 1) // 2] + l[n // 2 + 1]) / 2 AS median_ms,
         l[19 * (n + 1) // 20] * (1 - (19 * (n + 1) % 20) / 20) + l[19 * (n + 1) // 20 + 1] * ((19 * (n + 1) % 20) / 20) AS p95_ms,
         l[99 * (n + 1) // 100] * (1 - (99 * (n + 1) % 100) / 100) + l[99 * (n + 1) // 100 + 1] * ((99 * (n + 1) % 100) / 100) AS p99_ms
  FROM s)"""


@query(
    "latency_summary",
    f"""WITH {_SUMMARY} SELECT total_requests, successful_requests, failed_requests,
    {', '.join(sr(c, c) for c in ('min_ms', 'max_ms', 'mean_ms', 'success_rate', 'median_ms', 'p95_ms', 'p99_ms'))},
    {sr('total_requests / 3600.0', 'per_second')} FROM summary""",
)
def latency_summary(spark, sf):
    log = v.requests(spark, sf)
    return rounded(
        slo.latency_summary(log, ok=F.col("status") == 200, elapsed_seconds=3600)
    )


@query(
    "slo_verdict",
    f"""WITH {_SUMMARY} SELECT {sr('p95_ms', 'p95_ms')}, {sr('success_rate', 'success_rate')},
    p95_ms <= 800 AS latency_ok, success_rate >= 99 AS success_ok FROM summary""",
)
def slo_verdict(spark, sf):
    log = v.requests(spark, sf)
    return rounded(slo.slo_verdict(slo.latency_summary(log, ok=F.col("status") == 200)))


@query(
    "inference_stats",
    f"""WITH {q.REQUESTS} SELECT count(*) AS total_predictions,
    {sr('sum(latency_ms) / 1000', 'total_time_seconds')}, {sr('avg(latency_ms)', 'avg_inference_time_ms')},
    {sr('count(*) / (sum(latency_ms) / 1000)', 'throughput_per_second')} FROM requests""",
)
def inference_stats(spark, sf):
    return rounded(slo.inference_stats(v.requests(spark, sf)))


@query(
    "error_counts",
    f"WITH {q.REQUESTS} SELECT error, count(*) AS n FROM requests WHERE error IS NOT NULL GROUP BY 1",
)
def error_counts(spark, sf):
    return slo.error_counts(v.requests(spark, sf))


@query(
    "prediction_counts",
    f"WITH {q.PREDS} SELECT model_version, prediction, count(*) AS n FROM preds GROUP BY 1, 2",
)
def prediction_counts(spark, sf):
    return stats.counts_by(v.predictions(spark, sf), "model_version", "prediction")


@query(
    "request_counts",
    f"""WITH {q.REQUESTS} SELECT method, endpoint, status, count(*) AS n FROM requests
    GROUP BY 1, 2, 3""",
)
def request_counts(spark, sf):
    return stats.counts_by(v.requests(spark, sf), "method", "endpoint", "status")


_HIST = f"""{q.REQUESTS}, bounds AS (
  SELECT unnest([0.001, 0.005, 0.01, 0.05, 0.1, 0.5, 1.0, CAST('inf' AS DOUBLE)]) AS le
), hist AS (
  SELECT endpoint, le, count(*) FILTER (latency_ms / 1000 <= le) AS cumulative
  FROM requests CROSS JOIN bounds GROUP BY endpoint, le)"""


@query("latency_hist", f"WITH {_HIST} SELECT endpoint, le, cumulative FROM hist")
def latency_hist(spark, sf):
    return slo.latency_histogram(
        v.requests(spark, sf), F.col("latency_ms") / 1000, by=["endpoint"]
    )


@query(
    "hist_quantile",
    f"""WITH {_HIST}, h AS (
      SELECT *, coalesce(lag(le) OVER w, 0) AS low, coalesce(lag(cumulative) OVER w, 0) AS below,
             max(cumulative) OVER (PARTITION BY endpoint) * 0.95 AS rank
      FROM hist WINDOW w AS (PARTITION BY endpoint ORDER BY le)
    ), hit AS (
      SELECT endpoint, arg_min(CASE WHEN isinf(le) THEN low
                               ELSE low + (le - low) * (rank - below) / (cumulative - below) END, le) AS value
      FROM h WHERE cumulative >= rank GROUP BY endpoint)
    SELECT endpoint, {sr('value', 'quantile')} FROM hit""",
)
def hist_quantile(spark, sf):
    hist = latency_hist(spark, sf)
    return rounded(slo.histogram_quantile(hist, 0.95, by=["endpoint"]))


@query(
    "latency_shares",
    f"""WITH {q.REQUESTS} SELECT {', '.join(
        sr(f'avg(CASE WHEN latency_ms < {b} THEN 1 ELSE 0 END)', f'below_{b}_ms') for b in (50, 100, 500)
    )} FROM requests""",
)
def latency_shares(spark, sf):
    return rounded(slo.latency_shares(v.requests(spark, sf)))


_RATES = f"""{q.REQUESTS}, cells AS (
  SELECT us // 60000000 AS m, count(*) AS n, count(*) FILTER (status >= 400) AS e,
         count(*) FILTER (status >= 500) AS e5,
         count(*) FILTER (status BETWEEN 200 AND 299) AS s FROM requests GROUP BY 1
), spread AS (SELECT n, e, e5, s, unnest(range(m - {{back}}, m + 1)) AS w FROM cells
), rates AS (
  SELECT w * 60000000 AS window_us, CAST(sum(n) AS BIGINT) AS requests, CAST(sum(e) AS BIGINT) AS errors,
         CAST(sum(e5) AS BIGINT) AS server_errors,
         sum(e) / sum(n) AS error_rate, sum(s) / sum(n) AS success_rate, sum(n) / ({{back}} + 1) / 60 AS per_second
  FROM spread GROUP BY w)"""


@query(
    "error_rate_5m",
    f"""WITH {_RATES.format(back=4)} SELECT window_us, requests, errors, server_errors,
    {', '.join(sr(c, c) for c in ('error_rate', 'success_rate', 'per_second'))} FROM rates""",
)
def error_rate_5m(spark, sf):
    return rounded(slo.moving_rates(v.requests(spark, sf), F.col("status")))


@query(
    "alert_islands",
    f"""WITH {_RATES.format(back=59)}, marked AS (
      SELECT *, errors > 0.3 * requests AS on_ FROM rates
    ), edges AS (
      SELECT *, CASE WHEN lag(on_) OVER w AND window_us - lag(window_us) OVER w <= 60000000
                THEN 0 ELSE 1 END AS start_ FROM marked WINDOW w AS (ORDER BY window_us)
    ), islands AS (SELECT *, sum(start_) OVER (ORDER BY window_us) AS island FROM edges WHERE on_
    ), spans AS (
      SELECT island, min(window_us) AS first_us, max(window_us) AS last_us, count(*) AS steps
      FROM islands GROUP BY island)
    SELECT first_us, last_us, steps, 'warning' AS severity FROM spans
    WHERE last_us - first_us >= 300000000""",
)
def alert_islands(spark, sf):
    rates = slo.moving_rates(v.requests(spark, sf), F.col("status"), minutes=60)
    return slo.alert_islands(rates, F.col("errors") > 0.3 * F.col("requests"), hold_minutes=5)


_P95 = """cell_hist AS (
  SELECT us // 60000000 AS m, latency_ms / 1000 AS s FROM requests
), windows AS (SELECT s, unnest(range(m - {back}, m + 1)) AS w FROM cell_hist
), bounds AS (
  SELECT unnest([0.001, 0.005, 0.01, 0.05, 0.1, 0.5, 1.0, CAST('inf' AS DOUBLE)]) AS le
), whist AS (
  SELECT w, le, count(*) FILTER (s <= le) AS c FROM windows CROSS JOIN bounds GROUP BY w, le
), wrank AS (
  SELECT *, coalesce(lag(le) OVER x, 0) AS low, coalesce(lag(c) OVER x, 0) AS below,
         max(c) OVER (PARTITION BY w) * 0.95 AS rank
  FROM whist WINDOW x AS (PARTITION BY w ORDER BY le)
), p95 AS (
  SELECT w * 60000000 AS window_us, arg_min(CASE WHEN isinf(le) THEN low
         ELSE low + (le - low) * (rank - below) / (c - below) END, le) AS p95
  FROM wrank WHERE c >= rank GROUP BY w)"""


@query(
    "latency_p95_5m",
    f"WITH {q.REQUESTS}, {_P95.format(back=4)} SELECT window_us, {sr('p95', 'quantile')} FROM p95",
)
def latency_p95_5m(spark, sf):
    return rounded(slo.moving_quantile(v.requests(spark, sf), F.col("latency_ms") / 1000, 0.95))


def _islands(name: str, table: str, condition: str, severity: str) -> str:
    return f"""{name}_m AS (SELECT window_us, {condition} AS on_ FROM {table}
    ), {name}_e AS (
      SELECT *, CASE WHEN lag(on_) OVER w AND window_us - lag(window_us) OVER w <= 60000000
                THEN 0 ELSE 1 END AS start_ FROM {name}_m WINDOW w AS (ORDER BY window_us)
    ), {name}_i AS (SELECT *, sum(start_) OVER (ORDER BY window_us) AS island FROM {name}_e WHERE on_
    ), {name}_a AS (
      SELECT '{name}' AS alert, min(window_us) AS first_us, max(window_us) AS last_us,
             count(*) AS steps, '{severity}' AS severity
      FROM {name}_i GROUP BY island HAVING max(window_us) - min(window_us) >= 300000000)"""


@query(
    "service_alerts",
    f"""WITH {_RATES.format(back=59)}, {_P95.format(back=59)},
    {_islands('server_errors', 'rates', 'server_errors / 3600 > 0.001', 'warning')},
    {_islands('latency', 'p95', 'p95 > 0.3', 'warning')},
    {_islands('request_rate', 'rates', 'requests / 3600 > 0.005', 'info')}
    SELECT * FROM server_errors_a UNION ALL SELECT * FROM latency_a
    UNION ALL SELECT * FROM request_rate_a""",
)
def service_alerts(spark, sf):
    """Hourly windows and limits that fit the sparse test log."""
    return slo.service_alerts(
        v.requests(spark, sf), F.col("status"), F.col("latency_ms") / 1000, minutes=60,
        limits={"server_errors": 0.001, "latency": 0.3, "request_rate": 0.005},
    )


@query(
    "freshness",
    f"""WITH {q.PREDS}, a AS (
      SELECT product_id, max(us) AS last_us, ({NOW_US} - max(us)) / 1e6 AS age FROM preds GROUP BY 1)
    SELECT product_id, last_us, {sr('age', 'age_seconds')},
           CASE WHEN age >= 10 THEN 'red' WHEN age >= 2 THEN 'yellow' ELSE 'green' END AS level FROM a""",
)
def freshness(spark, sf):
    return rounded(slo.freshness(v.predictions(spark, sf), NOW_US, by=["product_id"]))


@query(
    "msg_rate",
    f"""WITH {q.TAPE} SELECT product_id, us // 3600000000 * 3600000000 AS window_us, count(*) AS n,
    {sr('count(*) / 3600.0', 'per_second')} FROM tape GROUP BY 1, 2""",
)
def msg_rate(spark, sf):
    return rounded(stats.message_rate(v.tape(spark, sf), 3600, by=["product_id"]))


_CHECKS = f"""{q.ROWS}, scored AS (
  SELECT round(1 / (1 + exp(-(price - 50) / 40)), 4) + CASE WHEN k % 20 = 0 THEN 1 ELSE 0 END AS score FROM tape
), checks AS (
  SELECT 'ret_mean_present' AS rule, count(*) AS n_checked, count(*) FILTER (ret_mean IS NULL) AS n_failed FROM rows_in
  UNION ALL SELECT 'ret_std_present', count(*), count(*) FILTER (ret_std IS NULL) FROM rows_in
  UNION ALL SELECT 'n_present', count(*), count(*) FILTER (n IS NULL) FROM rows_in
  UNION ALL SELECT 'score_numeric', count(*), count(*) FILTER (score IS NULL OR isnan(score)) FROM scored
  UNION ALL SELECT 'score_in_unit_interval', count(*), count(*) FILTER (NOT score BETWEEN 0 AND 1) FROM scored
  UNION ALL SELECT 'score_count', (SELECT count(*) FROM rows_in), 0)"""


def _checks(spark, sf):
    rows = v.request_rows(spark, sf)
    preds = v.predictions(spark, sf)
    scored = preds.withColumn("score", F.col("score") + (F.col("k") % 20 == 0).cast("int"))
    return (
        quality.expectations(rows, quality.request_rules())
        .unionByName(quality.expectations(scored, quality.score_rules()))
        .unionByName(quality.count_match(scored, rows))
    )


@query("expectations", f"WITH {_CHECKS} SELECT * FROM checks")
def expectations(spark, sf):
    return _checks(spark, sf)


@query(
    "validation_status",
    f"""WITH {_CHECKS}, s AS (
      SELECT count(*) AS total, count(*) FILTER (n_failed = 0) AS passed FROM checks)
    SELECT *, CASE WHEN passed = total THEN 'PASSED' WHEN passed >= total * 0.8
              THEN 'PASSED WITH WARNINGS' ELSE 'FAILED' END AS status FROM s""",
)
def validation_status(spark, sf):
    return quality.validation_status(_checks(spark, sf))


# --- scoring -----------------------------------------------------------------------------


@query(
    "baseline_fit",
    f"""WITH {q.BASELINE} SELECT {', '.join(
        sr(f'{f}_{s}', f'{f}_{s}', 5) for f in MODEL_FEATURES for s in ('mean', 'std')
    )}, {sr('composite_mean', 'composite_mean', 5)}, {sr('composite_std', 'composite_std', 5)}
    FROM m CROSS JOIN cm""",
)
def baseline_fit(spark, sf):
    return rounded(fit_baseline(materialize(features(spark, sf))), 5)


@query(
    "baseline_score",
    f"""WITH {q.BASELINE} SELECT product_id, us, seq, {sr('z', 'z_score', 5)},
    {sr('1 / (1 + exp(-z))', 'probability', 5)}, CASE WHEN z >= 2 THEN 1 ELSE 0 END AS prediction
    FROM scored""",
)
def baseline_score_query(spark, sf):
    table = materialize(features(spark, sf))
    scored = baseline_score(table, fit_baseline(table))
    return rounded(scored.select(*KEY, "z_score", "probability", "prediction"), 5)


@query(
    "score_table",
    f"""WITH {q.BASELINE}, p AS (SELECT *, round(1 / (1 + exp(-z)), 4) AS score FROM scored)
    SELECT product_id, us, seq, score, CASE WHEN score >= 0.7 THEN 1 ELSE 0 END AS prediction,
           score >= 0.7 AS alert, 'baseline' AS model_variant, 'v1.2-baseline' AS model_version FROM p""",
)
def score_table_query(spark, sf):
    table = materialize(features(spark, sf))
    scorers = {"baseline": baseline_scorer(fit_baseline(table))}
    out = score_table(table, scorers, threshold=0.7)
    return out.select(*KEY, "score", "prediction", "alert", "model_variant", "model_version")


def _training(spark, sf):
    table = features(spark, sf)
    known = labelled(spark, sf).select(*KEY, "volatility_spike")
    return materialize(table.join(known, KEY).where("volatility_spike is not null"))


@query("rf_score")
def rf_score(spark, sf):
    from tidemark.operators.scoring import pipeline_scorer

    rows = _training(spark, sf)
    model = models.train(rows)
    out = score_table(rows, {"ml": pipeline_scorer(model)}, "ml", 0.5)
    return out.select(*KEY, "score", "prediction", "volatility_spike")


@query("feature_importance")
def feature_importance(spark, sf):
    rows = _training(spark, sf)
    return rounded(models.feature_importance(rows, models.train(rows)))


@query("logistic_score")
def logistic_score(spark, sf):
    from tidemark.operators.scoring import pipeline_scorer

    rows = _training(spark, sf)
    out = score_table(rows, {"ml": pipeline_scorer(models.train(rows, kind="logistic"))}, "ml", 0.5)
    return out.select(*KEY, "score", "prediction", "volatility_spike")


@query("boosted_score")
def boosted_score(spark, sf):
    from tidemark.operators.scoring import pipeline_scorer

    rows = _training(spark, sf)
    model = models.train(rows, kind="boosted", trees=10)
    out = score_table(rows, {"ml": pipeline_scorer(model)}, "ml", 0.5)
    return out.select(*KEY, "score", "prediction", "volatility_spike")


@query(
    "best_f1",
    f"""WITH {q.PREDS}{q.curve('preds')}, t AS (SELECT sum(pos) AS p FROM groups),
    f AS (SELECT *, round(2.0 * cum_pos / (cum_n + p), 12) AS f1 FROM curve CROSS JOIN t)
    SELECT score AS threshold, {sr('cum_pos / cum_n', 'precision')}, {sr('cum_pos / p', 'recall')},
           {sr('f1', 'f1_score')}, CAST(cum_n AS BIGINT) AS predicted_positive
    FROM f ORDER BY f1 DESC, score LIMIT 1""",
)
def best_f1(spark, sf):
    return rounded(metrics.best_f1(v.predictions(spark, sf)))


@query(
    "rate_threshold",
    f"""WITH {q.PREDS}, c AS (SELECT quantile_cont(score, 0.9) AS threshold FROM preds),
    s AS (SELECT threshold, count(*) AS n, count(*) FILTER (score >= threshold) AS pp,
                 count(*) FILTER (label = 1) AS p, count(*) FILTER (score >= threshold AND label = 1) AS tp
          FROM preds CROSS JOIN c GROUP BY threshold)
    SELECT {sr('threshold', 'threshold')}, {sr('tp / pp', 'precision')}, {sr('tp / p', 'recall')},
           {sr('2.0 * tp / (pp + p)', 'f1_score')}, {sr('pp / n', 'predicted_rate')} FROM s""",
)
def rate_threshold(spark, sf):
    return rounded(metrics.rate_threshold(v.predictions(spark, sf), 0.1))


# --- metrics -----------------------------------------------------------------------------


@query(
    "average_precision",
    f"WITH {q.PREDS}{q.curve('preds')} SELECT {sr(q.AP, 'average_precision')} FROM curve",
)
def average_precision(spark, sf):
    return rounded(metrics.average_precision(v.predictions(spark, sf)))


@query("roc_auc", f"WITH {q.PREDS}{q.curve('preds')} SELECT {sr(q.AUC, 'roc_auc')} FROM curve")
def roc_auc(spark, sf):
    return rounded(metrics.roc_auc(v.predictions(spark, sf)))


_COUNTS = """count(*) FILTER ({y} = 1 AND {p} = 1) AS true_positives,
  count(*) FILTER ({y} = 0 AND {p} = 1) AS false_positives,
  count(*) FILTER ({y} = 0 AND {p} = 0) AS true_negatives,
  count(*) FILTER ({y} = 1 AND {p} = 0) AS false_negatives"""
_RATIOS = """coalesce(true_positives / nullif(true_positives + false_positives, 0), 0) AS precision_,
  coalesce(true_positives / nullif(true_positives + false_negatives, 0), 0) AS recall_,
  coalesce(2.0 * true_positives / nullif(2 * true_positives + false_positives + false_negatives, 0), 0) AS f1_,
  true_positives + false_positives + true_negatives + false_negatives AS total_samples,
  true_positives + false_negatives AS positive_samples, false_positives + true_negatives AS negative_samples"""
_METRICS = ", ".join(
    [sr("precision_", '"precision"'), sr("recall_", "recall"), sr("f1_", "f1_score"),
     "total_samples", "positive_samples", "negative_samples",
     sr("positive_samples / total_samples", "spike_rate")]
)


@query(
    "confusion",
    f"SELECT {_COUNTS.format(y='quality', p='1 - toxic')} FROM labels",
)
def confusion(spark, sf):
    rows = v.table(spark, sf, "labels").withColumn("p", 1 - F.col("toxic"))
    return metrics.confusion(rows, "quality", "p")


@query(
    "prf1",
    f"""WITH {q.PREDS}, c AS (SELECT {_COUNTS.format(y='label', p='prediction')} FROM preds),
    d AS (SELECT *, {_RATIOS} FROM c)
    SELECT true_positives, false_positives, true_negatives, false_negatives, {_METRICS} FROM d""",
)
def prf1(spark, sf):
    return rounded(metrics.precision_recall(metrics.confusion(v.predictions(spark, sf))))


_BY_DAY = f"""{q.PREDS}, days AS (SELECT *, us // 86400000000 * 86400000000 AS window_us FROM preds)
{q.curve('days', by='window_us')}, ap AS (
  SELECT window_us, {q.AP} AS ap, coalesce({q.AUC}, 0) AS auc FROM curve GROUP BY window_us
), c AS (SELECT window_us, {_COUNTS.format(y='label', p='prediction')} FROM days GROUP BY window_us
), d AS (SELECT *, {_RATIOS} FROM c JOIN ap USING (window_us))"""


@query(
    "metrics_by_window",
    f"""WITH {_BY_DAY}
    SELECT window_us, {sr('ap', 'pr_auc')}, {sr('auc', 'roc_auc')}, true_positives, false_positives,
           true_negatives, false_negatives, {_METRICS} FROM d""",
)
def metrics_by_window(spark, sf):
    return rounded(metrics.metrics_by_window(v.predictions(spark, sf), 86400))


_HISTORY = {
    "pr_auc": "ap", "precision": "precision_", "recall": "recall_", "f1_score": "f1_",
    **{m: m for m in metrics.HISTORY[4:]},
}


@query(
    "metric_history",
    f"WITH {_BY_DAY} "
    + " UNION ALL ".join(
        f"SELECT window_us, '{m}' AS metric, {sr(c, 'value')} FROM d" for m, c in _HISTORY.items()
    ),
)
def metric_history(spark, sf):
    daily = metrics.metrics_by_window(v.predictions(spark, sf), 86400)
    return rounded(metrics.metric_history(daily, ["window_us"]))


@query(
    "metric_lift",
    f"""WITH {q.PREDS}{q.curve('preds')}, a AS (SELECT {q.AP} AS ap FROM curve),
    b AS (SELECT avg(label) AS base FROM preds)
    SELECT {sr('ap', 'pr_auc')}, {sr('base', 'random_ap')}, {sr('ap / base', 'lift_random')},
           {sr('ap / 0.424', 'lift_baseline')} FROM a CROSS JOIN b""",
)
def metric_lift(spark, sf):
    all_metrics = metrics.classification_metrics(v.predictions(spark, sf))
    return rounded(metrics.metric_lift(all_metrics, 0.424))


_LIVE = f"""{q.LABELS}, {q.PREDS[q.PREDS.index("preds AS"):]}, known AS (
  SELECT us AS tat, product_id, seq AS lseq, volatility_spike FROM labeled WHERE volatility_spike IS NOT NULL
), recent AS (
  SELECT * FROM preds WHERE us BETWEEN {NOW_US} - 480 * CAST(3600000000 AS BIGINT) AND {NOW_US} - 60 * CAST(60000000 AS BIGINT)
), back AS (
  SELECT p.*, k2.tat, k2.volatility_spike AS y FROM recent AS p ASOF LEFT JOIN known AS k2
  ON p.product_id = k2.product_id AND p.us >= k2.tat
), fwd AS (
  SELECT p.seq, k2.tat AS fat, k2.volatility_spike AS fy FROM recent AS p ASOF LEFT JOIN known AS k2
  ON p.product_id = k2.product_id AND p.us <= k2.tat
), near AS (
  SELECT b.*, CASE WHEN fat IS NULL OR us - tat <= fat - us THEN tat ELSE fat END AS nat,
         CASE WHEN fat IS NULL OR us - tat <= fat - us THEN y ELSE fy END AS ny
  FROM back AS b JOIN fwd USING (seq)
), matched AS (SELECT * FROM near WHERE abs(nat - us) <= 30000000)
{q.curve('matched', y='ny')}, ap AS (SELECT {q.AP} AS ap, coalesce({q.AUC}, 0) AS auc FROM curve),
c AS (SELECT {_COUNTS.format(y='ny', p='prediction')} FROM matched),
d AS (SELECT *, {_RATIOS} FROM c CROSS JOIN ap),
ver AS (SELECT model_version FROM matched GROUP BY 1 ORDER BY count(*) DESC, model_version LIMIT 1)"""


@query(
    "live_performance",
    f"""WITH {_LIVE}
    SELECT {sr('ap', 'pr_auc')}, {sr('auc', 'roc_auc')}, true_positives, false_positives,
           true_negatives, false_negatives, {_METRICS}, model_version,
           (SELECT count(*) FROM recent) AS predictions_count,
           (SELECT count(*) FROM known) AS features_count, 'success' AS status
    FROM d CROSS JOIN ver""",
)
def live_performance(spark, sf):
    preds = v.predictions(spark, sf).drop("label")
    return rounded(
        metrics.live_performance(
            preds, labelled(spark, sf), NOW_US, hours=480, buffer_minutes=60,
            by=["product_id"],
        )
    )


# --- drift and data quality --------------------------------------------------------------


@query(
    "drift_wasserstein",
    f"WITH {q.HALVES} SELECT feature, {sr('score', 'score')}, score >= 0.1 AS drifted FROM drift",
)
def drift_wasserstein(spark, sf):
    return rounded(dr.drift_wasserstein(*v.drift_tables(spark, sf), DRIFT_COLUMNS))


@query(
    "drift_sketch",
    f"""WITH {q.HALVES}, ks AS (
      SELECT feature, max(gap) AS d, any_value(n_ref) AS n_ref, any_value(n_cur) AS n_cur FROM steps GROUP BY feature)
    SELECT feature, n_ref, n_cur, TRUE AS score_within, TRUE AS statistic_within, TRUE AS useful FROM ks""",
)
def drift_sketch(spark, sf):
    """Daily sketches of each half, merged, against the exact distances: within the stated error,
    which for the statistic is below 0.01."""
    path = scratch_path(spark, "sketches")
    sides = v.drift_tables(spark, sf)
    for name, df in zip("ab", sides):
        sketches.store_sketches(df, DRIFT_COLUMNS, f"{path}/{name}")
    a, b = (
        sketches.period(sketches.stored_sketches(spark, f"{path}/{name}"), "2000-01-01", "2100-01-01")
        for name in "ab"
    )
    near = sketches.drift_from_sketches(a, b)
    exact = dr.drift_wasserstein(*sides, DRIFT_COLUMNS).select("feature", F.col("score").alias("exact"))
    ks = dr.drift_ks(*sides, DRIFT_COLUMNS).select("feature", F.col("statistic").alias("exact_ks"))
    both = near.join(exact, "feature").join(ks, "feature")
    return both.select(
        "feature", "n_ref", "n_cur",
        (F.abs(F.col("score") - F.col("exact")) <= F.col("score_error")).alias("score_within"),
        (F.abs(F.col("statistic") - F.col("exact_ks")) <= F.col("statistic_error")).alias("statistic_within"),
        (F.col("statistic_error") < 0.01).alias("useful"),
    )


@query("drift_wasserstein_approx")
def drift_wasserstein_approx(spark, sf):
    return rounded(dr.drift_wasserstein_approx(*v.drift_tables(spark, sf), DRIFT_COLUMNS), 3)


@query(
    "drift_ks",
    f"""WITH {q.HALVES}, ks AS (
      SELECT feature, max(gap) AS d, any_value(n_ref) AS n_ref, any_value(n_cur) AS n_cur
      FROM steps GROUP BY feature
    ), l AS (SELECT *, sqrt(CAST(n_ref AS DOUBLE) * n_cur / (n_ref + n_cur)) * d AS x FROM ks
    ), p AS (
      SELECT *, CASE WHEN x < 0.2 THEN 1.0 ELSE least(greatest(list_sum(list_transform(range(1, 101),
        lambda i: (CASE WHEN i % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(-2 * i * i * x * x))), 0.0), 1.0)
        END AS p_value FROM l)
    SELECT feature, {sr('d', 'statistic')}, n_ref, n_cur, {sr('p_value', 'p_value')},
           CASE WHEN p_value > 0.05 THEN 'low' WHEN p_value > 0.01 THEN 'medium' ELSE 'high' END AS band
    FROM p""",
)
def drift_ks(spark, sf):
    return rounded(dr.drift_ks(*v.drift_tables(spark, sf), DRIFT_COLUMNS))


_PREDICTION_DRIFT = f"""{q.HALVES}, cats AS (
  SELECT side, round(1 / (1 + exp(-(price - 50) / 40)), 4) >= 0.7 AS p FROM halves
), shares AS (
  SELECT p, count(*) FILTER (side = 'ref') / (SELECT count(*) FROM cats WHERE side = 'ref') AS a,
         count(*) FILTER (side = 'cur') / (SELECT count(*) FROM cats WHERE side = 'cur') AS b
  FROM cats GROUP BY p
), pd AS (
  SELECT sum(abs(a - b)) / 2 AS tv,
         sqrt(sum(a * ln(a / ((a + b) / 2)) + b * ln(b / ((a + b) / 2))) / 2) AS js FROM shares)"""


def _with_prediction(df: DataFrame) -> DataFrame:
    score = F.round(1 / (1 + F.exp(-(F.col("price") - 50) / 40)), 4)
    return df.withColumn("prediction", (score >= 0.7).cast("int"))


@query(
    "drift_prediction",
    f"""WITH {_PREDICTION_DRIFT} SELECT 'prediction' AS feature, {sr('tv', 'total_variation')},
    {sr('js', 'js_distance')} FROM pd""",
)
def drift_prediction(spark, sf):
    ref, cur = (_with_prediction(df) for df in v.drift_tables(spark, sf))
    return rounded(dr.drift_categorical(ref, cur, "prediction"))


_DATASET = f"""{q.HALVES}, ds AS (
  SELECT count(*) AS columns_, count(*) FILTER (score >= 0.1) AS drifted_columns FROM drift)"""


@query(
    "drift_dataset",
    f"""WITH {_DATASET} SELECT columns_ AS columns, drifted_columns, {sr('drifted_columns / columns_', 'share')},
    drifted_columns / columns_ > 0.5 AS drift_detected, drifted_columns / columns_ > 0.75 AS action_required
    FROM ds""",
)
def drift_dataset(spark, sf):
    drift = dr.drift_wasserstein(*v.drift_tables(spark, sf), DRIFT_COLUMNS)
    return rounded(dr.dataset_drift(drift))


@query(
    "drift_severity",
    f"""WITH {q.HALVES} SELECT feature, {sr('score', 'score')}, score >= 0.1 AS drifted,
    CASE WHEN score < 0.1 THEN 'none' WHEN score > 2 THEN 'high' WHEN score > 0.5 THEN 'medium'
         ELSE 'low' END AS severity FROM drift""",
)
def drift_severity(spark, sf):
    drift = dr.drift_wasserstein(*v.drift_tables(spark, sf), DRIFT_COLUMNS)
    return rounded(dr.drift_severity(drift))


@query(
    "top_drift",
    f"""WITH {q.HALVES} SELECT feature, {sr('score', 'score')}, score >= 0.1 AS drifted FROM drift
    ORDER BY drift.score DESC, feature LIMIT 3""",
)
def top_drift(spark, sf):
    drift = dr.drift_wasserstein(*v.drift_tables(spark, sf), DRIFT_COLUMNS)
    return rounded(dr.top_drift(drift))


@query(
    "retrain_trigger",
    f"""WITH {_DATASET} SELECT columns_ AS columns, drifted_columns, {sr('drifted_columns / columns_', 'share')},
    drifted_columns / columns_ > 0.5 AS drift_detected, drifted_columns / columns_ > 0.75 AS action_required,
    drifted_columns / columns_ > 0.75 AS by_share, true AS by_quality,
    drifted_columns / columns_ > 0.5 AS by_duration, true AS retrain FROM ds""",
)
def retrain_trigger(spark, sf):
    drift = dr.drift_wasserstein(*v.drift_tables(spark, sf), DRIFT_COLUMNS)
    return rounded(dr.retrain_trigger(dr.dataset_drift(drift), 0.85, 0.9, 20))


@query(
    "dataset_summary",
    """SELECT (SELECT count(*) FROM orders) AS rows, CAST(3 AS BIGINT) AS columns,
       (SELECT count(*) FROM orders) - count(*) AS duplicate_rows, CAST(1 AS BIGINT) AS constant_columns
       FROM (SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders)""",
)
def dataset_summary(spark, sf):
    orders = v.table(spark, sf, "orders").select(
        "o_orderstatus", "o_orderpriority", F.lit("x").alias("one")
    )
    return dr.dataset_summary(orders, orders.columns)


@query(
    "missing_values",
    f"""WITH {q.BROKEN}, m AS (
      SELECT 'x' AS "column", count(*) AS rows, count(*) FILTER (x IS NULL) AS nulls,
             count(*) FILTER (isnan(x)) AS nans, count(*) FILTER (isinf(x)) AS infinities,
             CAST(0 AS BIGINT) AS empty_strings FROM broken
      UNION ALL
      SELECT 's', count(*), count(*) FILTER (s IS NULL), 0, 0, count(*) FILTER (s = '') FROM broken)
    SELECT *, {sr('(nulls + nans + infinities + empty_strings) / rows', 'missing_share')} FROM m""",
)
def missing_values(spark, sf):
    return rounded(dr.missing_values(v.broken_values(spark, sf), ["x", "s"]))


def _report_sql() -> str:
    columns = DRIFT_COLUMNS
    parts = [
        f"SELECT 'column_drift' AS section, feature, 'score' AS metric, {sr('score', 'value')} FROM drift",
        "SELECT 'column_drift', feature, 'drifted', CASE WHEN score >= 0.1 THEN 1 ELSE 0 END FROM drift",
    ]
    for m, e in {
        "columns": "columns_", "drifted_columns": "drifted_columns",
        "share": "drifted_columns / columns_",
        "drift_detected": "CASE WHEN drifted_columns / columns_ > 0.5 THEN 1 ELSE 0 END",
        "action_required": "CASE WHEN drifted_columns / columns_ > 0.75 THEN 1 ELSE 0 END",
    }.items():
        parts.append(f"SELECT 'dataset_drift', '*', '{m}', {sr(e, 'value')} FROM ds")
    for name, side in (("reference", "ref"), ("current", "cur")):
        rows = f"(SELECT count(*) FROM halves WHERE side = '{side}')"
        distinct = (
            f"(SELECT count(*) FROM (SELECT DISTINCT {', '.join(columns)} FROM halves WHERE side = '{side}'))"
        )
        for m, e in {
            "rows": rows, "columns": "4", "duplicate_rows": f"{rows} - {distinct}", "constant_columns": "0",
        }.items():
            parts.append(f"SELECT '{name}_summary', '*', '{m}', {sr(e, 'value')}")
        for c in columns:
            for m in ("nulls", "nans", "infinities", "missing_share"):
                parts.append(f"SELECT '{name}_missing', '{c}', '{m}', CAST(0 AS DOUBLE)")
    for m, e in {"total_variation": "tv", "js_distance": "js"}.items():
        parts.append(f"SELECT 'prediction_drift', 'prediction', '{m}', {sr(e, 'value')} FROM pd")
    body = " UNION ALL ".join(parts)
    return f"WITH {_PREDICTION_DRIFT}, {_DATASET[_DATASET.index('ds AS'):]} {body}"


def _parts_sql(reference: str, current: str) -> str:
    """The report's SQL over other parts of the unscaled table; ``rn`` numbers its ``total`` rows in time."""
    sql = _report_sql().replace(
        """CASE WHEN rn > CAST(floor(total * 0.5) AS BIGINT) AND product_id = 'purchase'
              THEN price * 1.2 ELSE price END AS price
  FROM numbered""",
        f"price FROM numbered WHERE ({reference}) OR ({current})",
    )
    return sql.replace("rn <= CAST(floor(total * 0.5) AS BIGINT)", reference)


@query("report_early_late", _parts_sql("rn <= CAST(floor(total * 0.4) AS BIGINT)", "rn > CAST(floor(total * 0.4) AS BIGINT)"))
def report_early_late(spark, sf):
    table = _with_prediction(v.tape(spark, sf))
    return rounded(dr.early_late_report(table, 0.4, columns=DRIFT_COLUMNS, prediction="prediction"))


@query("report_train_test", _parts_sql("rn <= CAST(floor(total * 0.7) AS BIGINT)", "rn > CAST(floor(total * 0.85) AS BIGINT)"))
def report_train_test(spark, sf):
    table = _with_prediction(v.tape(spark, sf))
    return rounded(dr.train_test_report(table, columns=DRIFT_COLUMNS, prediction="prediction"))


@query("drift_report", _report_sql())
def drift_report(spark, sf):
    ref, cur = (_with_prediction(df) for df in v.drift_tables(spark, sf))
    return rounded(dr.drift_report(ref, cur, DRIFT_COLUMNS, "prediction"))
