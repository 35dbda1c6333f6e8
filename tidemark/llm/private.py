"""Personal data in texts, in DataFrame functions only.

Patterns propose spans: of each kind the leftmost matches that do not overlap. Validators confirm
them (Luhn sums of cards, mod-97 of account numbers, ranges of address parts, digit counts), and
words near a span raise or lower its score. Matches of the four base kinds that their validator
confirms always stay; a span of a further kind stays if its score reaches the threshold.

A text is marked around its matches and split there, so a match's place is the running total of
the lengths before it, and the parts beside it are its context. The patterns look at each
character a bounded number of times: runs are taken possessively and entered at their start only.

NULL or empty text holds nothing. Rows that repeat get the same answer each, NULL ids are kept, extra
columns are ignored, and an empty table gives no rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.5
CONTEXT = 48  # characters on either side
BLOCK = 256  # parts that one running total takes at a time
_MARK, _OTHER = "\x01", "\x02"  # no pattern takes either character

# kind: pattern, score of a confirmed match.
BASE = {
    "email": (
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        0.9,
    ),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 0.6),
    # Runs of fewer than 13 digits are no card and need not be proposed.
    "card": (r"[0-9](?:[\x20-]?+[0-9]){12,}+", 0.8),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", 0.7),
}
# kind: pattern, score, what may not stand beside it.
FURTHER = {
    "iban": (r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?", 0.8, "[A-Za-z0-9]"),
    "ssn": (r"[0-9]{3}-[0-9]{2}-[0-9]{4}", 0.3, "[0-9-]"),
    "local_phone": (r"[(]?[0-9]{3}[)]?[ .-]?[0-9]{3}[ .-][0-9]{4}", 0.3, "[0-9+]"),
}
# Words that raise a score by 0.3 and words that lower it by 0.2.
NEAR = {
    "email": ("mail|contact|write", "example"),
    "ip": ("address|server|host|login", "version|release"),
    "card": ("card|visa|master|payment|credit", "isbn|tracking|order"),
    "phone": ("phone|call|tel|fax|mobile", "isbn|order"),
    "iban": ("iban|account|bank|transfer", "part|serial"),
    "ssn": ("ssn|social security|taxpayer", "isbn|order|part"),
    "local_phone": ("phone|call|tel|fax|mobile", "isbn|order|part"),
}
SIGN = {"email": "@", "phone": "+"}  # texts without it need not be searched
IP_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?:\.|$)){4}$"
KINDS = [*BASE, *FURTHER]


def _running(lengths: str) -> str:
    """SQL of the running totals before each entry of an array, ``BLOCK`` entries at a time."""
    add = "(a, x) -> concat(a, array(element_at(a, -1) + x))"
    blocks = f"transform(sequence(0, (size({lengths}) - 1) div {BLOCK}), b -> slice({lengths}, int(b) * {BLOCK} + 1, {BLOCK}))"
    before = f"aggregate(transform({blocks}, b -> aggregate(b, 0L, (s, x) -> s + x)), array(0L), {add})"
    return f"flatten(zip_with({blocks}, slice({before}, 1, (size({lengths}) - 1) div {BLOCK} + 1), (b, s) -> slice(aggregate(b, array(s), {add}), 1, size(b))))"


def _proposed(df: DataFrame, text: str, kind: str, pattern: str) -> DataFrame:
    """Adds ``<kind>``: array of (start, end, text, before, after), and ``<kind>_parts``.

    Parts stand in turn outside and inside matches; a text without a match has none.
    """
    parts, at = f"{kind}_parts", f"{kind}_at"
    marked = F.regexp_replace(F.col(text), pattern, f"{_MARK}$0{_MARK}")
    split = lambda m: F.when(F.contains(m, F.lit(_MARK)), F.split(m, _MARK)).otherwise(F.array().cast("array<string>"))
    found = F.element_at(F.transform(F.array(marked), split), 1)
    if kind in SIGN:
        found = F.when(F.contains(text, F.lit(SIGN[kind])), found).otherwise(F.array().cast("array<string>"))
    df = df.withColumn(parts, found)
    places = f"transform(array(transform({parts}, x -> bigint(length(x)))), l -> {_running('l')})[0]"
    df = df.withColumn(at, F.expr(f"if(size({parts}) > 0, {places}, array())"))
    span = (
        f"struct({at}[k] as start, {at}[k] + length({parts}[k]) as end, {parts}[k] as text, "
        f"right({parts}[k - 1], {CONTEXT}) as before, left({parts}[k + 1], {CONTEXT}) as after)"
    )
    found = f"transform(if(size({parts}) > 0, sequence(1, size({parts}) - 2, 2), array()), k -> {span})"
    return df.withColumn(kind, F.expr(found)).drop(at)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _mod97(text: Column) -> Column:
    """Remainder of an account number: its first four characters last, letters as 10 to 35."""
    compact = F.replace(text, F.lit(" "), F.lit(""))
    moved = F.concat(F.substring(compact, 5, 40), F.substring(compact, 1, 4))
    value = lambda c: F.ascii(c) - F.when(c >= "A", 55).otherwise(48)
    return F.aggregate(
        F.split(moved, ""),
        F.lit(0),
        lambda total, c: F.when(c == "", total).otherwise(
            F.pmod(total * F.when(c >= "A", 100).otherwise(10) + value(c), F.lit(97))
        ),
    )


def _confirmed(kind: str, span: Column) -> Column:
    text = span["text"]
    if kind == "ip":
        return text.rlike(IP_PARTS)
    if kind == "card":
        digits = _digits(text)
        return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(_digits(text)).between(9, 15)
    if kind == "iban":
        return F.length(F.replace(text, F.lit(" "), F.lit(""))).between(15, 34) & (_mod97(text) == 1)
    if kind == "ssn":
        return ~text.rlike("^(?:000|666|9[0-9][0-9])|-00-|-0000$")
    return F.lit(True)


def _score(kind: str, span: Column, score: float) -> Column:
    near = F.translate(
        F.concat(span["before"], F.lit(" "), span["after"]), string.ascii_uppercase, string.ascii_lowercase
    )
    up, down = NEAR[kind]
    return F.round(
        F.greatest(
            F.lit(0.0),
            F.least(
                F.lit(1.0),
                F.lit(score) + F.when(near.rlike(up), 0.3).otherwise(0.0) - F.when(near.rlike(down), 0.2).otherwise(0.0),
            ),
        ),
        2,
    )


def _spans(kind: str, score: float, border: str | None, threshold: float) -> Column:
    """The confirmed spans of a kind as (kind, start, end, text, score)."""
    ok = F.filter(F.col(kind), lambda s: _confirmed(kind, s))
    if border:
        ok = F.filter(
            ok, lambda s: ~F.right(s["before"], F.lit(1)).rlike(border) & ~F.left(s["after"], F.lit(1)).rlike(border)
        )
    out = F.transform(
        ok,
        lambda s: F.struct(
            F.lit(kind).alias("kind"), s["start"], s["end"], s["text"], _score(kind, s, score).alias("score")
        ),
    )
    return F.filter(out, lambda s: s["score"] >= threshold) if border else out


def find(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id and one array per kind of (kind, start, end, text, score), in order of start.

    Places are code points from 0, ends are exclusive. Further kinds are looked for outside
    telephone numbers.
    """
    text = F.coalesce("text", F.lit(""))
    text = F.when(F.contains(text, F.lit(_MARK)), F.translate(text, _MARK, _OTHER)).otherwise(text)
    df = docs.select("doc_id", text.alias("text"))
    for kind, (pattern, score) in BASE.items():
        df = _proposed(df, "text", kind, pattern).withColumn(kind, _spans(kind, score, None, threshold))
    blank = f"transform(phone_parts, (x, i) -> if(i % 2 = 1, repeat('{_OTHER}', length(x)), x))"
    df = df.withColumn("text", F.when(F.size("phone_parts") > 0, F.array_join(F.expr(blank), "")).otherwise(F.col("text")))
    for kind, (pattern, score, border) in FURTHER.items():
        df = _proposed(df, "text", kind, pattern).withColumn(kind, _spans(kind, score, border, threshold))
    return df.select("doc_id", *KINDS)


def _joined(kinds: list[str]) -> Column:
    """kind:start:end of all spans, by kind, then start."""
    every = F.concat(*(F.col(k) for k in kinds))
    places = F.transform(
        every, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(places, ",")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every row."""
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in BASE]
    base = F.sha2(_joined(list(BASE)).cast("binary"), 256)
    return find(docs).select("doc_id", *counts, base.alias("base_sha256"), _joined(KINDS).alias("spans"))
