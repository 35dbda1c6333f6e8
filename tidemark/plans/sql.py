"""Common table expressions of the check SQL."""

from tidemark.plans.registry import sr
from tidemark.schema import MODEL_FEATURES

US = 1_000_000

TAPE = """
tape AS (
  SELECT event_type AS product_id, epoch_us(ts) AS us, event_id AS seq, value AS price, k,
         CASE WHEN k % 17 = 0 THEN CAST(0 AS DOUBLE) ELSE value * (1 - (k % 7 + 1) * 1e-4) END AS best_bid,
         value * (1 + (k % 5 + 1) * 1e-4) AS best_ask,
         CAST(k % 11 AS DOUBLE) AS bid_qty, CAST((k * 7) % 13 AS DOUBLE) AS ask_qty,
         CAST(k % 9 AS DOUBLE) AS trade_size
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) AS e
)"""

FEATURES = (
    TAPE
    + """,
ticks AS (
  SELECT *, nullif(price, 0) AS p,
         CASE WHEN best_bid > 0 AND best_ask > 0 THEN best_ask - best_bid END AS spread,
         CASE WHEN bid_qty + ask_qty > 0 THEN bid_qty / (bid_qty + ask_qty) END AS book
  FROM tape
), pairs AS (
  SELECT product_id, us, seq, p, ln(p / lag(p) OVER w) AS r, abs(p - lag(p) OVER w) AS dp,
         us - lag(us) OVER w AS dt
  FROM ticks WHERE p IS NOT NULL
  WINDOW w AS (PARTITION BY product_id ORDER BY us, seq)
), lists AS (
  SELECT product_id, us, seq,
         (list({'r': r, 'dp': dp, 'dt': dt}) OVER w60)[2:] AS l60,
         (list({'r': r, 'dp': dp, 'dt': dt}) OVER w300)[2:] AS l300,
         first_value(p) OVER w300 AS p0
  FROM pairs
  WINDOW w60 AS (PARTITION BY product_id ORDER BY us RANGE BETWEEN 3600000000 PRECEDING AND CURRENT ROW),
         w300 AS (PARTITION BY product_id ORDER BY us RANGE BETWEEN 18000000000 PRECEDING AND CURRENT ROW)
), banded AS (
  SELECT *, list_filter(l60, lambda x: x.dt BETWEEN 450000000 AND 1350000000) AS b60,
         list_filter(l300, lambda x: x.dt BETWEEN 450000000 AND 1350000000) AS b300
  FROM lists
), moves AS (
  SELECT product_id, us, seq, p0,
         list_transform(CASE WHEN len(b60) > 0 THEN b60 ELSE l60 END, lambda x: x.r) AS r60,
         list_transform(CASE WHEN len(b300) > 0 THEN b300 ELSE l300 END, lambda x: x.r) AS r300,
         list_transform(CASE WHEN len(b300) > 0 THEN b300 ELSE l300 END, lambda x: x.dp) AS d300
  FROM banded
), frames AS (
  SELECT *, count(p) OVER w30 AS n30, count(p) OVER w60 AS n60, count(p) OVER w300 AS n300,
         count(*) OVER w300 AS ticks300,
         avg(spread) OVER w60 AS spread60, avg(spread) OVER w300 AS spread300,
         avg(book) OVER w30 AS book30, avg(book) OVER w60 AS book60, avg(book) OVER w300 AS book300
  FROM ticks
  WINDOW w30 AS (PARTITION BY product_id ORDER BY us RANGE BETWEEN 1800000000 PRECEDING AND CURRENT ROW),
         w60 AS (PARTITION BY product_id ORDER BY us RANGE BETWEEN 3600000000 PRECEDING AND CURRENT ROW),
         w300 AS (PARTITION BY product_id ORDER BY us RANGE BETWEEN 18000000000 PRECEDING AND CURRENT ROW)
), features AS (
  SELECT f.product_id, f.us, f.seq, f.p AS price, f.k,
    CASE WHEN n300 > 1 AND p IS NOT NULL THEN ln(p / p0) ELSE 0.0 END AS log_return_300s,
    CASE WHEN n300 > 1 AND p IS NOT NULL THEN coalesce(spread300, 0.0) ELSE 0.0 END AS spread_mean_300s,
    CASE WHEN n300 > 1 AND p IS NOT NULL THEN ticks300 ELSE 0 END AS trade_intensity_300s,
    CASE WHEN n300 > 1 AND p IS NOT NULL THEN coalesce(book300, 0.5) ELSE 0.5 END AS order_book_imbalance_300s,
    CASE WHEN n60 > 1 AND p IS NOT NULL THEN coalesce(spread60, 0.0) ELSE 0.0 END AS spread_mean_60s,
    CASE WHEN n60 > 1 AND p IS NOT NULL THEN coalesce(book60, 0.5) ELSE 0.5 END AS order_book_imbalance_60s,
    CASE WHEN n300 > 1 AND p IS NOT NULL THEN coalesce(list_avg(d300), 0.0) ELSE 0.0 END AS price_velocity_300s,
    CASE WHEN n300 > 1 AND p IS NOT NULL THEN coalesce(list_stddev_pop(r300), 0.0) ELSE 0.0 END AS realized_volatility_300s,
    CASE WHEN n30 > 1 AND p IS NOT NULL THEN coalesce(book30, 0.5) ELSE 0.5 END AS order_book_imbalance_30s,
    CASE WHEN n60 > 1 AND p IS NOT NULL THEN coalesce(list_stddev_pop(r60), 0.0) ELSE 0.0 END AS realized_volatility_60s
  FROM frames AS f LEFT JOIN moves AS m ON f.product_id = m.product_id AND f.us = m.us AND f.seq = m.seq
)"""
)


def places(name: str) -> int:
    """Spreads have six places, so the mean of two of them would be a rounding tie at six."""
    return 11 if name.startswith("spread_mean") else 6


def feature_columns(*names: str) -> str:
    """Key columns and rounded features."""
    parts = ["product_id", "us", "seq"]
    for n in names or MODEL_FEATURES:
        parts.append(f"CAST({n} AS BIGINT) AS {n}" if n.startswith("trade") else sr(n, n, places(n)))
    return ", ".join(parts)


CHUNKS = (
    TAPE
    + """,
gaps AS (
  SELECT *, us - lag(us) OVER (PARTITION BY product_id ORDER BY us, seq) AS gap FROM tape
), chunks AS (
  SELECT *, CAST(sum(CASE WHEN gap > 6000000000 THEN 1 ELSE 0 END)
                 OVER (PARTITION BY product_id ORDER BY us, seq) AS BIGINT) AS chunk_id
  FROM gaps
)"""
)

LABELS = (
    CHUNKS
    + """,
ahead AS (
  SELECT *, list(price) OVER (PARTITION BY product_id, chunk_id ORDER BY us
                              RANGE BETWEEN 1 FOLLOWING AND 3600000000 FOLLOWING) AS l
  FROM chunks
), vols AS (
  SELECT product_id, us, seq, price, k, chunk_id,
         CASE WHEN len(l) >= 2 AND NOT list_contains(l, 0.0) THEN
           list_stddev_pop(list_transform(range(2, len(l) + 1), lambda i: (l[i] - l[i - 1]) / l[i - 1]))
         END AS vol
  FROM ahead
), cut AS (
  SELECT quantile_cont(round(vol, 12), 0.9) AS threshold FROM vols WHERE vol IS NOT NULL
), labeled AS (
  SELECT v.*, threshold, CASE WHEN vol IS NULL THEN NULL
                              WHEN round(vol, 12) >= threshold THEN 1 ELSE 0 END AS volatility_spike
  FROM vols AS v CROSS JOIN cut
)"""
)

PREDS = (
    TAPE
    + """,
preds AS (
  SELECT us + (seq % 5 - 2) * 1000000 AS us, us AS event_us, product_id, seq, k,
         'v' || CAST(k % 3 AS VARCHAR) AS model_version,
         round(1 / (1 + exp(-(price - 50) / 40)), 4) AS score,
         CASE WHEN round(1 / (1 + exp(-(price - 50) / 40)), 4) >= 0.7 THEN 1 ELSE 0 END AS prediction,
         CASE WHEN (k * 31 + seq) % 10 < 3 THEN 1 ELSE 0 END AS label
  FROM tape
)"""
)

CURVE = """,
groups AS (
  SELECT {by}score, CAST(sum({y}) AS BIGINT) AS pos, count(*) AS n FROM {table} GROUP BY {by}score
), curve AS (
  SELECT *, sum(pos) OVER w AS cum_pos, sum(n) OVER w AS cum_n
  FROM groups WINDOW w AS ({part} ORDER BY score DESC)
)"""


def curve(table: str, y: str = "label", by: str = "") -> str:
    part = f"PARTITION BY {by}" if by else ""
    return CURVE.format(table=table, y=y, by=f"{by}, " if by else "", part=part)


AP = "coalesce(sum(pos * CAST(cum_pos AS DOUBLE) / cum_n) / nullif(sum(pos), 0), 0)"
AUC = (
    "1 - (sum(pos * CAST((cum_n - cum_pos) - (n - pos) AS DOUBLE)) + sum(pos * CAST(n - pos AS DOUBLE)) / 2)"
    " / nullif(sum(pos) * CAST(sum(n - pos) AS DOUBLE), 0)"
)

REQUESTS = """
requests AS (
  SELECT epoch_us(ts) AS us, event_type AS endpoint, 'POST' AS method,
         CASE event_type WHEN 'error' THEN 500 ELSE 200 END AS status, value AS latency_ms,
         CASE WHEN event_type = 'error'
              THEN 'code ' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 AS VARCHAR)
         END AS error
  FROM events
)"""

ROWS = (
    TAPE
    + """,
rows_in AS (
  SELECT seq, price / 1000 AS ret_mean, CASE WHEN k % 5 <> 0 THEN price / 500 END AS ret_std, k AS n,
         CASE WHEN k % 3 = 0 THEN price / 900 END AS log_return_300s,
         CASE WHEN k % 7 <> 0 THEN k / CAST(100 AS DOUBLE) END AS order_book_imbalance_30s,
         CASE WHEN k % 11 = 0 THEN 'n/a' ELSE CAST(k AS VARCHAR) END AS spread_mean_60s
  FROM tape
)"""
)

BROKEN = (
    TAPE
    + """,
broken AS (
  SELECT seq, product_id,
         CASE k % 10 WHEN 0 THEN CAST('nan' AS DOUBLE) WHEN 1 THEN CAST('inf' AS DOUBLE)
              WHEN 2 THEN CAST('-inf' AS DOUBLE) WHEN 3 THEN NULL ELSE price END AS x,
         CASE k % 6 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE product_id END AS s
  FROM tape
)"""
)

# Early half as reference; late half, with dearer purchases, as current.
HALVES = (
    TAPE
    + """,
numbered AS (
  SELECT *, row_number() OVER (ORDER BY us, seq) AS rn, count(*) OVER () AS total FROM tape
), halves AS (
  SELECT seq, CASE WHEN rn <= CAST(floor(total * 0.5) AS BIGINT) THEN 'ref' ELSE 'cur' END AS side,
         product_id, best_ask, bid_qty, trade_size,
         CASE WHEN rn > CAST(floor(total * 0.5) AS BIGINT) AND product_id = 'purchase'
              THEN price * 1.2 ELSE price END AS price
  FROM numbered
), long AS (
  SELECT side, feature, x FROM (
    SELECT side, price, best_ask, bid_qty, trade_size FROM halves
  ) UNPIVOT (x FOR feature IN (price, best_ask, bid_qty, trade_size))
), points AS (
  SELECT feature, x, count(*) FILTER (side = 'ref') AS rn, count(*) FILTER (side = 'cur') AS cn
  FROM long GROUP BY feature, x
), sizes AS (
  SELECT feature, count(*) FILTER (side = 'ref') AS n_ref, count(*) FILTER (side = 'cur') AS n_cur,
         stddev_pop(x) FILTER (side = 'ref') AS sd
  FROM long GROUP BY feature
), steps AS (
  SELECT p.feature, x, n_ref, n_cur, sd, lead(x) OVER w - x AS dx,
         abs(sum(rn) OVER w / n_ref - sum(cn) OVER w / n_cur) AS gap
  FROM points AS p JOIN sizes AS s ON p.feature = s.feature
  WINDOW w AS (PARTITION BY p.feature ORDER BY x)
), drift AS (
  SELECT feature, coalesce(sum(gap * dx), 0) / greatest(any_value(sd), 0.001) AS score
  FROM steps GROUP BY feature
)"""
)

Z = """,
f AS (SELECT * FROM features), m AS (SELECT {means} FROM f),
comp AS (SELECT f.*, ({sum}) / {n} AS c FROM f CROSS JOIN m),
cm AS (SELECT avg(c) AS composite_mean, greatest(stddev_samp(c), 1e-8) AS composite_std FROM comp),
scored AS (SELECT comp.*, (c - composite_mean) / (composite_std + 1e-8) AS z FROM comp CROSS JOIN cm)
""".format(
    means=", ".join(
        f"avg({f}) AS {f}_mean, greatest(stddev_samp({f}), 1e-8) AS {f}_std" for f in MODEL_FEATURES
    ),
    sum=" + ".join(f"({f} - {f}_mean) / ({f}_std + 1e-8)" for f in MODEL_FEATURES),
    n=len(MODEL_FEATURES),
)
BASELINE = FEATURES + Z
