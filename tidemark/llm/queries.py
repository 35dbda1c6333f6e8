"""The operators as queries over whole tables, and the SQL that must give the same rows."""

from __future__ import annotations

import corpus_pipeline
from tidemark.llm import (
    decontaminate,
    jaccard,
    language,
    neighbours,
    pages,
    phrases,
    pieces,
    private,
    quality,
    shards,
    spans,
    toxicity,
    whitening,
)
from tidemark.llm.common import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


QUERIES["pipeline"] = corpus_pipeline.run


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


@query("op1_quality_classifier")
def op1(spark, sf):
    return quality.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op5_language_id")
def op5(spark, sf):
    return language.identify(table(spark, sf, "documents"))


@query("op10_sentencepiece")
def op10(spark, sf):
    return pieces.round_trip(table(spark, sf, "documents"))


WORDS_SQL = r"""list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""


@query(
    "op3_decontamination",
    f"""WITH d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
    i AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark),
    lens AS (SELECT DISTINCT least(len(w), 10) AS l FROM i WHERE len(w) > 0),
    iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS l, array_to_string(w[s : s + least(len(w), 10) - 1], ' ') AS t
      FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
    dw AS (SELECT doc_id, l, s, array_to_string(w[s : s + l - 1], ' ') AS t
      FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS s FROM d, lens WHERE len(w) >= l)),
    hit AS (SELECT dw.doc_id, dw.s, dw.l, iw.item_id FROM dw JOIN iw USING (l, t)),
    pos AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(s, s + l)) AS p FROM (SELECT DISTINCT doc_id, s, l FROM hit)) GROUP BY 1),
    it AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY 1)
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(pos.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(it.n, 0) AS BIGINT) AS n_items,
      sha256(coalesce(it.ids, '')) AS items_sha256, coalesce(pos.n, 0) > 0 AS contaminated
    FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)""",
)
def op3(spark, sf):
    return decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op8_nearest_neighbours")
def op8(spark, sf):
    return neighbours.search(table(spark, sf, "embeddings"))


@query("op9_html_text")
def op9(spark, sf):
    return pages.extract(table(spark, sf, "pages"))


ASCII_WORDS_SQL = r"""list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"""
LOWER_SQL = ASCII_WORDS_SQL.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")


@query(
    "op4_jaccard_join",
    f"""WITH RECURSIVE d AS (SELECT doc_id, {LOWER_SQL} AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
    shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
    linked AS (SELECT a, b FROM shared JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
    both_ AS (SELECT a, b FROM linked UNION SELECT b, a FROM linked),
    reach(a, b) AS (SELECT a, b FROM both_ UNION SELECT r.a, e.b FROM reach AS r JOIN both_ AS e ON r.b = e.a)
    SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(r.low, d.doc_id)) AS component_id
    FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY 1) AS r USING (doc_id)""",
)
def op4(spark, sf):
    return jaccard.groups(table(spark, sf, "documents"))


@query(
    "op6_substring_dedup",
    f"""WITH d AS (SELECT doc_id, {ASCII_WORDS_SQL} AS w FROM documents),
    win AS (SELECT doc_id, s, array_to_string(w[s : s + 12], ' ') AS t
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS s FROM d WHERE len(w) >= 13)),
    low AS (SELECT t, min(doc_id) AS low FROM win GROUP BY 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS p FROM win JOIN low USING (t) WHERE low < doc_id),
    word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
    kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS k, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY 1)
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (doc_id)""",
)
def op6(spark, sf):
    return spans.removal(table(spark, sf, "documents"))


@query("op2_toxicity")
def op2(spark, sf):
    return toxicity.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op7_shards")
def op7(spark, sf):
    return shards.assign(table(spark, sf, "documents"))


def _pii_sql() -> str:
    """Every kind's matches are marked, split off, checked, and joined in order."""
    base = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    further = {kind: pattern for kind, (pattern, _, _) in private.FURTHER.items()}

    def parts(k: int, kind: str, pattern: str, source: str) -> str:
        marked = f"regexp_replace(t, '{pattern}', chr(1) || '\\0' || chr(1), 'g')"
        return f"SELECT r, {k} AS k, '{kind}' AS kind, string_split({marked}, chr(1)) AS p FROM {source}"

    own = " UNION ALL ".join(parts(i, k, v, "d") for i, (k, v) in enumerate(base.items()))
    more = " UNION ALL ".join(parts(i + 4, k, v, "rest") for i, (k, v) in enumerate(further.items()))
    digits = "regexp_replace(x, '[^0-9]', '', 'g')"
    compact = "replace(x, ' ', '')"
    luhn = (
        f"list_sum(list_transform(range(1, length({digits}) + 1), lambda i: "
        f"[[0, 1, 2, 3, 4, 5, 6, 7, 8, 9], [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]][2 - i % 2][CAST(reverse({digits})[i] AS INT) + 1])) % 10 = 0"
    )
    mod97 = (
        f"list_reduce(list_prepend(0, list_transform(string_split(substr({compact}, 5) || left({compact}, 4), ''), "
        "lambda c: ascii(c) - CASE WHEN c >= 'A' THEN 55 ELSE 48 END)), "
        "lambda a, v: (a * CASE WHEN v >= 10 THEN 100 ELSE 10 END + v) % 97) = 1"
    )
    checks = {
        "email": "true",
        "ip": "len(list_filter(string_split(x, '.'), lambda y: CAST(y AS HUGEINT) > 255)) = 0",
        "card": f"length({digits}) BETWEEN 13 AND 19 AND {luhn}",
        "phone": f"length({digits}) BETWEEN 9 AND 15",
        "iban": f"length({compact}) BETWEEN 15 AND 34 AND {mod97}",
        "ssn": "NOT regexp_matches(x, '^(?:000|666|9[0-9][0-9])|-00-|-0000$')",
        "local_phone": "true",
    }
    for kind, (_, score, border) in private.FURTHER.items():
        up, down = private.NEAR[kind]
        near = "translate(bef || ' ' || aft, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        mark = f"{score} + CASE WHEN regexp_matches({near}, '{up}') THEN 0.3 ELSE 0 END - CASE WHEN regexp_matches({near}, '{down}') THEN 0.2 ELSE 0 END"
        checks[kind] += (
            f" AND NOT regexp_matches(right(bef, 1), '{border}') AND NOT regexp_matches(left(aft, 1), '{border}') AND {mark} >= {private.THRESHOLD}"
        )
    valid = " ".join(f"WHEN kind = '{k}' THEN {v}" for k, v in checks.items())
    name = "kind || ':' || s || ':' || (s + length(x))"
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in base)
    return f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), chr(1), chr(2)) AS t FROM documents),
    own AS ({own}),
    rest AS (SELECT r, array_to_string(list_transform(p, lambda x, i: CASE WHEN i % 2 = 0 THEN repeat(chr(2), length(x)) ELSE x END), '') AS t FROM own WHERE kind = 'phone'),
    every AS (SELECT * FROM own UNION ALL {more}),
    places AS (SELECT r, k, kind, p, unnest(range(2, len(p), 2)) AS i FROM every WHERE len(p) > 1),
    m AS (SELECT r, k, kind, CAST(list_sum(list_transform(p[1 : i - 1], lambda x: length(x))) AS BIGINT) AS s, p[i] AS x, right(p[i - 1], 48) AS bef, left(p[i + 1], 48) AS aft FROM places),
    ok AS (SELECT * FROM m WHERE CASE {valid} END),
    sums AS (SELECT r, {counts}, string_agg({name}, ',' ORDER BY k, s) FILTER (k < 4) AS base, string_agg({name}, ',' ORDER BY k, s) AS spans FROM ok GROUP BY 1)
    SELECT doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in base)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN sums USING (r)"""


@query("op11_pii", _pii_sql())
def op11(spark, sf):
    return private.report(table(spark, sf, "documents"))


@query("op12_whitening")
def op12(spark, sf):
    return whitening.whiten(table(spark, sf, "embeddings"))


@query(
    "op13_phrases",
    r"""WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
    g AS (SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS t, count(*) AS f
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3)) AS v(k) WHERE len(w) >= k) GROUP BY 1, 2, 3),
    n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g WHERE k = 1 GROUP BY 1),
    c AS (SELECT lang, k, t, f AS a, string_split(t, ' ') AS s FROM g WHERE k > 1 AND f >= 10),
    inside AS (SELECT lang, t, max(a) AS most FROM (SELECT lang, a, unnest([array_to_string(s[1 : 2], ' '), array_to_string(s[2 : 3], ' ')]) AS t FROM c WHERE k = 3) GROUP BY 1, 2),
    cut AS (SELECT lang, k, t, a, j, array_to_string(s[1 : j], ' ') AS one, array_to_string(s[j + 1 : k], ' ') AS two FROM (SELECT *, unnest(range(1, k)) AS j FROM c)),
    marked AS (SELECT cut.lang, cut.k, cut.t, a, j, x.f AS l, y.f AS r, CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
      FROM cut JOIN g AS x ON x.lang = cut.lang AND x.t = one JOIN g AS y ON y.lang = cut.lang AND y.t = two),
    best AS (SELECT * FROM marked QUALIFY row_number() OVER (PARTITION BY lang, t ORDER BY score, j) = 1),
    left_ AS (SELECT best.* FROM best LEFT JOIN inside USING (lang, t) WHERE k = 3 OR most IS NULL OR 100 * most < 50 * a),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, t) AS rank FROM left_)
    SELECT lang, rank, t AS phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000""",
)
def op13(spark, sf):
    return phrases.phrases(table(spark, sf, "documents"))
