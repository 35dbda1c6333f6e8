"""Plain-Python forms of the operators, one row at a time."""

import math

import numpy as np

from tidemark.schema import MODEL_FEATURES

SECOND = 1_000_000
TICKS = (
    "product_id string, us bigint, seq bigint, price double, best_bid double, "
    "best_ask double, bid_qty double, ask_qty double"
)


def random_ticks(n, seed=0, products=("A", "B"), mean_gap=0.8, nulls=True):
    rng = np.random.default_rng(seed)
    rows, us, price = [], {p: 0 for p in products}, {p: 100.0 for p in products}
    for i in range(n):
        p = products[int(rng.integers(len(products)))]
        step = rng.choice([0.0, 0.5, 1.0, 1.5, rng.exponential(mean_gap), 40.0], p=[.1, .1, .2, .1, .47, .03])
        us[p] += int(step * SECOND)
        price[p] = max(1.0, price[p] * math.exp(rng.normal(0, 0.01)))
        value = price[p]
        if nulls and rng.random() < 0.08:
            value = [None, 0.0, float("nan")][int(rng.integers(3))]
        bid = 0.0 if rng.random() < 0.1 else price[p] - 0.1
        ask = None if rng.random() < 0.1 else price[p] + 0.1 * rng.random()
        qty = [float(x) for x in rng.integers(0, 4, 2)]
        rows.append((p, us[p], i, value, bid, ask, qty[0], qty[1] if rng.random() > 0.1 else None))
    return rows


def usable(price):
    return None if price is None or math.isnan(price) or price == 0 else price


def brute_features(rows, short=30, mid=60, long=300, band=(0.5, 1.5)):
    """Features of every tick from the list of its frame."""
    out = {}
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    for product, ticks in by.items():
        ticks = sorted(ticks, key=lambda r: (r[1], r[2]))
        for i, now in enumerate(ticks):
            f = {}
            for name, w in (("30s", short), ("60s", mid), ("300s", long)):
                frame = [t for t in ticks[: i + 1] if t[1] >= now[1] - w * SECOND]
                priced = [(usable(t[3]), t[1]) for t in frame if usable(t[3]) is not None]
                ready = len(priced) > 1 and usable(now[3]) is not None
                spreads = [
                    t[5] - t[4] for t in frame if t[4] is not None and t[5] is not None and t[4] > 0 and t[5] > 0
                ]
                books = [
                    t[6] / (t[6] + t[7]) for t in frame
                    if t[6] is not None and t[7] is not None and t[6] + t[7] > 0
                ]
                p = np.array([x for x, _ in priced])
                dt = np.diff([u for _, u in priced]) / SECOND
                near = (dt >= band[0]) & (dt <= band[1])
                pick = near if near.any() else np.ones(len(dt), bool)
                r = np.log(p[1:] / p[:-1])[pick] if len(p) > 1 else np.array([])
                d = np.abs(np.diff(p))[pick] if len(p) > 1 else np.array([])
                f[f"order_book_imbalance_{name}"] = float(np.mean(books)) if ready and books else 0.5
                f[f"spread_mean_{name}"] = float(np.mean(spreads)) if ready and spreads else 0.0
                f[f"realized_volatility_{name}"] = float(np.std(r)) if ready and len(r) > 1 else 0.0
                f[f"price_velocity_{name}"] = float(np.mean(d)) if ready and len(d) else 0.0
                f[f"log_return_{name}"] = math.log(p[-1] / p[0]) if ready else 0.0
                f[f"trade_intensity_{name}"] = len(frame) if ready else 0
            out[now[2]] = {k: f[k] for k in MODEL_FEATURES}
    return out


def brute_forward(rows, horizon=60, gap=300):
    out, by = {}, {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    for ticks in by.values():
        ticks = sorted(ticks, key=lambda r: (r[1], r[2]))
        chunk, chunks = 0, []
        for i, t in enumerate(ticks):
            if i and t[1] - ticks[i - 1][1] > gap * SECOND:
                chunk += 1
            chunks.append(chunk)
        for i, t in enumerate(ticks):
            ahead = [
                u[3] for u, c in zip(ticks, chunks)
                if c == chunks[i] and t[1] < u[1] <= t[1] + horizon * SECOND
            ]
            if len(ahead) < 2 or any(usable(x) is None for x in ahead):
                out[t[2]] = None
                continue
            a = np.array(ahead)
            out[t[2]] = float(np.std(np.diff(a) / a[:-1]))
    return out
