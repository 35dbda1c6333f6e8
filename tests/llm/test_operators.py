"""The operators against brute force, round trips and held-out rows, and their defined edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

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
from tidemark.llm.common import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
VOCABULARY = [f"{a}{b}" for a in ("ba", "du", "ki", "lo", "me", "so", "ta", "vu") for b in ("r", "n", "s", "lt", "", "mp")]


def corpus(seed=3, rows=60):
    """Texts with copies, near copies, shared passages, and the odd rows every operator must stand."""
    rng = random.Random(seed)
    passage = rng.choices(VOCABULARY, k=40)
    base = [rng.choices(VOCABULARY, k=rng.choice([2, 12, 13, 40, 120])) for _ in range(rows)]
    texts = []
    for i, words in enumerate(base):
        if i % 4 == 1:
            words = list(base[i - 1])
            for _ in range(i % 3):
                words[rng.randrange(len(words))] = "changed"
        if i % 5 == 2:
            words = words[: len(words) // 2] + passage[: 10 + i % 30] + words[len(words) // 2 :]
        texts.append(rng.choice([" ", "  ", "\n"]).join(words))
    texts += ["", None, "one", "one two", "one two", "É é ÀB ab", " \t\n", "x " * 30_000]
    out = [(i * 7 % 101, t, "en", "s", 0) for i, t in enumerate(texts)]
    return [*out, out[0], out[0], (None, texts[0], None, None, None), (None, None, "en", "s", 0)]


def frame(spark, rows, extra=False):
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        for name in ("key", "n", "h", "ids", "spans", "item", "score", "hit_id", "cut_spans", "root"):
            df = df.withColumn(name, df["source"])
    return df


def answers(df):
    return Counter(tuple(r) for r in df.collect())


def ascii_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_groups(rows, n, percent):
    def shingles(text):
        w = ascii_words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()

    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[find(i)] = min(low.get(find(i), r[0]), r[0])
    return Counter((r[0], len(sets[i]), low.get(find(i))) for i, r in enumerate(rows))


@pytest.mark.parametrize(("n", "percent", "seed"), [(3, 90, 3), (5, 80, 4), (2, 60, 5)])
def test_jaccard_groups(spark, n, percent, seed):
    rows = corpus(seed)
    assert answers(jaccard.groups(frame(spark, rows, True), n, percent)) == brute_groups(rows, n, percent)


def test_jaccard_finds_links_that_leaders_miss(spark):
    """A chain: neighbours are linked, the ends and the common leader are not."""
    rng = random.Random(1)
    words = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    rows = [(i, " ".join(words[4 * i : 4 * i + 120]), "en", "s", 0) for i in range(40)]
    assert answers(jaccard.groups(frame(spark, rows), 3, 90)) == brute_groups(rows, 3, 90)


def test_jaccard_hot_group(spark):
    """Near copies of one text: rows between operators stay in proportion to the group."""
    rng = random.Random(2)
    words = rng.choices(VOCABULARY, k=200)
    rows = [(i, " ".join([*words[: i % 150], f"own{i}", *words[i % 150 :]]), "en", "s", 0) for i in range(300)]
    out = jaccard.groups(frame(spark, rows), 3, 90).collect()
    assert {r.component_id for r in out} == {0}


def brute_removal(rows, window):
    low = {}
    words = [ascii_words(r[1]) for r in rows]
    for r, w in zip(rows, words):
        if r[0] is not None:
            for i in range(len(w) - window + 1):
                key = tuple(w[i : i + window])
                low[key] = min(low.get(key, r[0]), r[0])
    out = []
    for r, w in zip(rows, words):
        gone = set()
        if r[0] is not None:
            for i in range(len(w) - window + 1):
                if low[tuple(w[i : i + window])] < r[0]:
                    gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((r[0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("seed", [3, 6])
def test_span_removal(spark, seed):
    rows = corpus(seed)
    assert answers(spans.removal(frame(spark, rows, True))) == brute_removal(rows, 13)


def test_span_removal_branching_paths(spark):
    """Passages that overlap, nest, repeat inside a document and start or end in its middle."""
    rng = random.Random(5)
    base = rng.choices(VOCABULARY, k=120)
    rows = []
    for i in range(40):
        words = []
        for _ in range(rng.randrange(1, 4)):
            a = rng.randrange(100)
            words += base[a : a + rng.randrange(8, 60)] + rng.choices(VOCABULARY, k=rng.randrange(3))
        rows.append((rng.randrange(60), " ".join(words), "en", "s", 0))
    assert answers(spans.removal(frame(spark, rows))) == brute_removal(rows, 13)


def test_repeats_cut_from_texts(spark):
    rows = corpus(3)
    df = frame(spark, rows, True)
    out = spans.without_repeats(df)
    assert out.columns == df.columns and out.count() == len(rows)
    digests = Counter((r[0], hashlib.sha256(" ".join(ascii_words(r[1])).encode()).hexdigest()) for r in out.collect())
    assert digests == Counter({(k[0], k[3]): 0 for k in ()}) + Counter(
        (k[0], k[3]) for k in brute_removal(rows, 13).elements()
    )


def brute_contamination(rows, items):
    windows = {}
    for id_, text in items:
        w = plain_words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(id_)
    out = []
    for r in rows:
        w, hit, found = plain_words(r[1]), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                ids = windows.get(tuple(w[i : i + n]))
                if ids:
                    hit.update(range(i, i + n))
                    found |= ids
        names = sorted(str(x) for x in found if x is not None)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        out.append((r[0], len(w), len(hit), len(names), digest, bool(hit)))
    return Counter(out)


@pytest.mark.parametrize("short", [False, True])
def test_contamination(spark, short):
    rows = corpus(7)
    words = plain_words(rows[4][1])
    items = [(i, " ".join(plain_words(rows[i * 3][1])[i : i + 25]).upper()) for i in range(12)]
    items += [(40, " ".join(words[:10])), (40, None), (None, " ".join(words[1:14])), (41, ""), (12, "x " * 30)]
    if short:
        items += [(50 + n, " ".join(VOCABULARY[n : 2 * n])) for n in range(1, 9)] + [(70, "ÀB"), (71, "one two")]
    else:
        items = [(i, t) for i, t in items if len(plain_words(t)) >= 10 or not plain_words(t)]
    table = spark.createDataFrame(items, "item_id long, text string")
    assert answers(decontaminate.contamination(frame(spark, rows, True), table)) == brute_contamination(rows, items)
    clean = decontaminate.clean(frame(spark, rows, True), table)
    want = [k[0] for k in brute_contamination(rows, items).elements() if not k[5]]
    assert Counter(r[0] for r in clean.collect()) == Counter(want)


def test_contamination_without_items(spark):
    rows = corpus(7)
    table = spark.createDataFrame([], "item_id long, text string")
    assert answers(decontaminate.contamination(frame(spark, rows), table)) == brute_contamination(rows, [])


@pytest.fixture(scope="module")
def model():
    return pieces.Pieces.load(pieces.VOCABULARY)


def test_pieces_round_trip(spark, model):
    rows = corpus(3) + [(200, "tab\there  two\n\nlines — 梦 🙂 e.g. (x),\"y\" 1.5² $$.a", "en", "s", 0)]
    out = pieces.round_trip(frame(spark, rows, True)).collect()
    assert len(out) == len(rows) and all(r.same_text for r in out)
    coded = pieces.decode(pieces.encode(frame(spark, rows, True)))
    assert all(r.text == r.decoded for r in coded.collect())


def best_split(model, word):
    best, back = [0.0], [0]
    for end in range(1, len(word) + 1):
        options = [(best[end - 1] + model.lowest, end - 1)]
        options += [(best[s] + model.score[word[s:end]], s) for s in range(end) if word[s:end] in model.score]
        top = max(options, key=lambda o: (o[0], -o[1]))
        best.append(top[0])
        back.append(top[1])
    return best[-1]


def test_pieces_against_plain_search(model):
    """Cuts and shared prefixes lose nothing against one search over the whole marked text."""
    rng = random.Random(9)
    alphabet = "abcdeé .,\n\t(-)²1▁梦🙂THE"
    for _ in range(60):
        text = "".join(rng.choices(alphabet, k=rng.randrange(1, 40)))
        marked = pieces.MARK + text.replace(" ", pieces.MARK)
        total = 0.0
        ids = model.encode([text])[0].tolist()
        i = 0
        while i < len(ids):
            if ids[i] in model.byte_of:
                n = next(n for n in range(1, 5) if _is_char(model, ids[i : i + n]))
                total += model.lowest
                i += n
            else:
                total += model.score[model.text[ids[i]]]
                i += 1
        assert total == pytest.approx(best_split(model, marked))


def _is_char(model, ids):
    try:
        return len(bytes(model.byte_of[i] for i in ids).decode()) == 1
    except UnicodeDecodeError:
        return False


def labelled_docs(rows=400):
    rng = random.Random(11)
    docs, labels = [], []
    insults = ["stupid", "idiot", "worthless", "scum"]
    for i in range(rows):
        words = rng.choices(VOCABULARY, k=rng.randrange(20, 60))
        good, toxic = i % 4 != 0, i % 5 == 0
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(insults)
        text = " ".join(words if good else [w + "###" for w in words])
        docs.append((i, text, "en", "s", 0))
        labels.append((i, int(good), int(toxic)))
    docs += [(None, "text", None, None, 0), (1000, None, "en", "s", 0), (1001, "", "en", "s", 0), docs[3]]
    return docs, [*labels, (None, 1, 1), (5000, 0, 1), (1, None, None)]


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_classifiers(spark, operator):
    docs, labels = labelled_docs()
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = operator.classify(frame(spark, docs, True), table).collect()
    assert len(out) == len(docs) and all(0 <= r.score <= 1 for r in out)
    column, mod, held = (1, 5, 0) if operator is quality else (2, 3, 1)
    truth = {x[0]: x[column] for x in labels if x[0] is not None and x[column] is not None}
    tested = [(r.predicted, truth[r.doc_id]) for r in out if r.held_out and r.doc_id in truth]
    assert len(tested) > 40 and np.mean([a == b for a, b in tested]) > 0.97
    for r in out:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % mod == held)


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_classifiers_without_rows(spark, operator):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = frame(spark, [(1, "a text", "en", "s", 0), (2, None, None, None, None)])
    assert len(operator.classify(docs, none).collect()) == 2
    assert operator.classify(docs.limit(0), none).count() == 0


def test_label_model_follows_accurate_voters():
    rng = np.random.default_rng(0)
    truth = rng.random(3000) < 0.2
    votes = np.zeros((3000, 4), int)
    for j, (hit, false) in enumerate([(0.8, 0.01), (0.7, 0.02), (0.3, 0.3)]):
        votes[:, j] = rng.random(3000) < np.where(truth, hit, false)
    votes[:, 3] = -(votes[:, :2].sum(1) == 0).astype(int)
    post = toxicity.label_model(votes, np.full(3000, -1))
    assert np.mean((post > 0.5) == truth) > 0.93


def test_label_model_rises_and_finds_dependent_voters():
    """The likelihood never falls, a copied voter counts as one, and the vote of the majority is beaten."""
    rng = np.random.default_rng(4)
    truth = rng.random(4000) < 0.25
    votes = np.zeros((4000, 6), int)
    for j, (hit, false) in enumerate([(0.85, 0.02), (0.75, 0.03), (0.8, 0.04), (0.5, 0.45)]):
        votes[:, j] = rng.random(4000) < np.where(truth, hit, false)
    votes[:, 4] = np.where(rng.random(4000) < 0.97, votes[:, 3], 1 - votes[:, 3])
    votes[:, 5] = -(rng.random(4000) < np.where(truth, 0.05, 0.6)).astype(int)
    history = []
    post = toxicity.label_model(votes, np.full(4000, -1), history=history)
    assert all(b[2] >= a[2] - 1e-6 for a, b in zip(history, history[1:]) if a[:2] == b[:2])
    assert {3, 4} in [set(e) for e in history[-1][1]]
    majority = np.mean((votes.sum(1) > 0) == truth)
    assert np.mean((post > 0.5) == truth) > max(majority, 0.95)
    # Counted patterns give the same posteriors as the rows.
    every, at, times = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    assert np.allclose(toxicity.label_model(every, np.full(len(every), -1), times)[at.ravel()], post, atol=1e-5)


BASE_PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def brute_pii(text):
    out = []
    for kind, pattern in BASE_PII.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(x) <= 255 for x in m.group().split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_private_data(spark):
    rng = random.Random(1)
    bits = ["a", "@", ".", "b.c", "1", "23", "4", "5.6", "+", " ", "-", "(", "_", "é", "🙂", "\x01", "4111111111111111",
            "4111 1111-1111 1111", "10.0.0.1", "999", "x@y.zz", "+1 555 123 4567", "007.00.0.255", "256.1.1.1"]
    texts = [None, "", "a@b.c_x@d.e", "1.2.3.4.5.6.7.8", "mail a@b.c+d@e.f"] + ["".join(rng.choices(bits, k=rng.randrange(60))) for _ in range(400)]
    texts += ["1." * 20_000, "a." * 20_000 + "@b", "+1 " * 20_000, "x@y.zz " * 3_000]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)] + [(None, "a@b.c", None, None, None), (2, texts[2], "en", "s", 0)]
    out = private.report(frame(spark, rows, True)).collect()
    assert len(out) == len(rows)
    text = dict((r[0], r[1]) for r in rows)
    for r in out:
        want = brute_pii(text[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(r.spans.split(","))
        for kind in BASE_PII:
            assert r[f"n_{kind}"] == sum(w.startswith(kind) for w in want)
    assert private.report(frame(spark, rows).limit(0)).count() == 0


def test_private_data_beyond_patterns(spark):
    """Checksums confirm, borders and nearby words decide."""
    cases = [
        ("pay to GB82 WEST 1234 5698 7654 32 now", "iban:7:34"), ("pay to GB83 WEST 1234 5698 7654 32 now", ""),
        ("xGB82WEST12345698765432", ""), ("my SSN is 123-45-6789.", "ssn:10:21"), ("part 123-45-6789.", ""),
        ("ssn 000-45-6789", ""), ("call (555) 123-4567 now", "local_phone:5:19"), ("size (555) 123-4567 now", ""),
        ("call +1 (555) 123-4567", "phone:5:22"),
    ]
    rows = [(i, t, "en", "s", 0) for i, (t, _) in enumerate(cases)]
    found = {r.doc_id: r for r in private.report(frame(spark, rows)).collect()}
    assert [found[i].spans for i in range(len(cases))] == [want for _, want in cases]
    spans_ = private.find(frame(spark, rows)).where("doc_id = 3").first().ssn
    assert [(s.text, s.score) for s in spans_] == [("123-45-6789", 0.6)]


def brute_whitening(rows, keep=8):
    c = np.array([r[1] for r in rows], "float32").astype("float64")
    x = np.floor(1024 * c).astype("int64") + 100_000
    n, s = len(x), x.sum(0)
    values, axes = np.linalg.eigh(np.cov(x.T.astype("float64"), bias=True))
    values, axes = values[::-1][:keep], axes[:, ::-1][:, :keep]
    return ((n * x - s) ** 2).sum(1), ((x - s / n) @ axes) / np.sqrt(values), values / np.trace(np.cov(x.T, bias=True))


def test_whitening(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(500, 12)) * np.arange(1, 13)
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(base)]
    rows += [rows[3], (None, rows[4][1], 0)]
    odd = [(900, None, 0), (901, [1.0] * 11 + [None], 0), (902, [float("nan")] * 12, 0), (903, [float("inf")] + [0.0] * 11, 0), (904, [1.0], 0), (905, [], 0)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, n int").repartition(3)
    out = whitening.whiten(df).collect()
    far, white, share = brute_whitening(rows)
    assert len(out) == 8 * len(rows) and {r.n for r in out} == {len(rows)}
    for k in range(8):
        got = {r.vec_id: r for r in out if r.component == k + 1}
        sign = np.sign(got[0].whitened * white[0, k])
        for i in range(500):
            assert got[i].deviation == far[i]
            assert abs(sign * got[i].whitened - white[i, k]) < 1e-10
            assert abs(got[i].explained - share[k]) < 1e-12 and got[i].identity_error < 1e-9


def test_whitening_of_few_and_equal_rows(spark):
    schema = "vec_id long, embedding array<double>"
    cross = [(i, [float(i == j) - float(i == j + 4) for j in range(4)]) for i in range(8)]
    out = whitening.whiten(spark.createDataFrame(cross, schema)).collect()
    assert len(out) == 32 and {round(r.explained, 12) for r in out} == {0.25}
    assert max(r.identity_error for r in out) < 1e-12
    line = [(i, [float(i), 2.0 * i, 0.0]) for i in range(5)]
    out = whitening.whiten(spark.createDataFrame(line, schema)).collect()
    assert len(out) == 5 and {r.component for r in out} == {1} and out[0].explained == 1.0
    huge = [(i, [4e11 * (-1) ** i, float(i)]) for i in range(6)]
    out = whitening.whiten(spark.createDataFrame(huge, schema)).collect()
    assert len(out) == 12 and {r.deviation for r in out} == {None}
    for rows in ([(1, [1.0, 2.0])] * 3, []):
        assert whitening.whiten(spark.createDataFrame(rows, schema)).count() == 0


def test_characteristic_polynomial(spark):
    rng = np.random.default_rng(1)
    for d in (1, 2, 5, 9):
        a = rng.integers(-10**6, 10**6, (d, d))
        a = (a @ a.T).tolist()
        poly = whitening.polynomial(spark, a)
        # Faddeev and LeVerrier's way, in whole numbers.
        m, want = [[0] * d for _ in range(d)], [1]
        for k in range(1, d + 1):
            m = [[sum(a[i][t] * (m[t][j] + want[-1] * (t == j)) for t in range(d)) for j in range(d)] for i in range(d)]
            want.append(-sum(m[i][i] for i in range(d)) // k)
        assert poly == want[::-1]


def brute_phrases(rows, least, percent, top):
    count, n = Counter(), Counter()
    for r in rows:
        lang = r[2] or "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1] or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                count.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    out = {}
    for (lang, *w), a in count.items():
        if len(w) < 2 or a < least:
            continue
        if len(w) == 2 and any(
            len(x) == 4 and x[0] == lang and b >= least and (list(x[1:3]) == w or list(x[2:4]) == w) and 100 * b >= percent * a
            for x, b in count.items()
        ):
            continue
        cuts = [(10**6 * a * a // (count[(lang, *w[:k])] * count[(lang, *w[k:])]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), count[(lang, *w[:k])], count[(lang, *w[k:])]))
    return Counter(
        (lang, i + 1, p.decode(), -a, left, right, n[lang], -s)
        for lang, found in out.items() for i, (s, a, p, left, right) in enumerate(sorted(found)[:top])
    )


@pytest.mark.parametrize("stretch", [phrases.STRETCH, 50])
def test_phrases(spark, monkeypatch, stretch):
    monkeypatch.setattr(phrases, "STRETCH", stretch)
    monkeypatch.setattr(phrases, "CHARS_PER_BUCKET", 2000)
    monkeypatch.setattr(phrases, "BLOCK", 4)
    rng = random.Random(6)
    line = "the quick brown fox jumps over the lazy dog and runs away from it all day long".split()
    rows = []
    for i in range(40):
        words = rng.choices(VOCABULARY[:12], k=60) + line[: 5 + i % 12] + ["go"] * (i % 6)
        rng.random() < 0.5 and words.insert(rng.randrange(len(words)), "Stop.")
        rows.append((i, rng.choice([" ", "  ", "\t"]).join(words) + rng.choice(["!", "\n", ""]), rng.choice(["en", "de", None]), "s", 0))
    rows += [(90, None, "en", "s", 0), (91, "", None, "s", 0), (92, " .,;\n", "xx", "s", 0), (None, "É é Go go", "en", None, 0), rows[0]]
    got = answers(phrases.phrases(frame(spark, rows, True), 5, 50, 30))
    assert got == brute_phrases(rows, 5, 50, 30)
    assert phrases.phrases(frame(spark, rows).limit(0)).count() == 0


def test_phrases_share_no_hash(spark, monkeypatch):
    """Words that share a hash are told apart with another seed."""
    plain = phrases.xxhash.xxh64_intdigest
    monkeypatch.setattr(phrases.xxhash, "xxh64_intdigest", lambda w, seed=0: plain(w, seed=seed) % (8 if seed < 2 else 2**64))
    rows = [(i, "one two three four five six seven eight nine ten", "en", "s", 0) for i in range(12)]
    assert answers(phrases.phrases(frame(spark, rows), 5, 50, 30)) == brute_phrases(rows, 5, 50, 30)


def test_language(spark):
    rng = random.Random(1)
    parts = {"aa": ["tion", "ing", "er", "the"], "bb": ["ción", "ñ", "rr", "los"], "cc": ["sch", "ü", "ver", "ung"]}
    rows = [
        (i, " ".join("".join(rng.choices(parts[lang], k=3)) for _ in range(40)), lang, "s", 0)
        for i, lang in enumerate(sorted(parts) * 60)
    ]
    odd = [(900, None, "aa", "s", 0), (901, "12 .. !", "bb", "s", 0), (None, "tioning", None, None, 0), (902, "", "aa", "s", 0)]
    out = language.identify(frame(spark, rows + odd, True)).collect()
    by = {r.doc_id: r for r in out}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (900, 901, 902))
    assert np.mean([by[r[0]].lang_pred == r[2] for r in rows if by[r[0]].held_out]) == 1
    assert language.identify(frame(spark, odd[:2])).count() == 2


def test_language_of_few_long_texts(spark):
    """A language of three very long texts is learned, and numbers that Unicode calls words are no letters."""
    rng = random.Random(2)
    parts = {"aa": ["tion", "ing", "er"], "bb": ["ción", "ñ", "rr"]}
    long = [(i, " ".join("".join(rng.choices(parts["bb"], k=3)) for _ in range(60_000)), "bb", "s", 0) for i in (1, 2, 3)]
    many = [(i, " ".join("".join(rng.choices(parts["aa"], k=3)) for _ in range(40)), "aa", "s", 0) for i in range(10, 200)]
    odd = [(500, "² ½ ① Ⅷ", "aa", "s", 0), many[0]]
    assert any(zlib.crc32(str(i).encode()) % 4 != 2 for i in (1, 2, 3))
    out = {r.doc_id: r for r in language.identify(frame(spark, long + many + odd)).collect()}
    assert all(out[r[0]].lang_pred == r[2] for r in long + many) and out[500].lang_pred == "und"


def test_one_giant_labelled_text(spark):
    """It costs the other rows of the sample nothing."""
    docs, labels = labelled_docs(200)
    docs.append((900, "ba###x du###y " * 300_000, "en", "s", 0))
    known = spark.createDataFrame([(x[0], x[1]) for x in labels if x[1] is not None and x[0] is not None] + [(900, 0)], "doc_id long, label int")
    rows = quality.sample(frame(spark, docs), known, 300, 60_000)
    assert len({r[0] for r in rows}) == 201 and sum(len(r[1]) for r in rows) <= 60_000
    assert [r[1] for r in rows if r[0] == 7] == [d[1] for d in docs if d[0] == 7]


def test_language_code_lengths_add_up():
    """The chances of all bytes after a context, escapes included, add up to at most one."""
    tree = language.Tree(Counter({"banana": 3, "bandana": 1}))
    for context in (b"", b" ", b" b", b"an", b"zz"):
        assert sum(2 ** -tree.cost(context, s) for s in range(256)) <= 1 + 1e-9


def test_neighbours(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 12))
    x = centres[rng.integers(20, size=1500)] + 0.3 * rng.normal(size=(1500, 12))
    x[100:400] = x[100]
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(x)]
    rows += [(2000, None, 0), (2100, [0.0] * 12, 0), (2200, [1.0] * 11 + [None], 0), (2300, [float("nan")] * 12, 0), (None, rows[0][1], 0), (2400, [1.0], 0), rows[5]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    out = neighbours.search(df).toPandas()
    hits = []
    for q in range(0, 1500, 100):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        want = np.lexsort((np.arange(1500), d))[:10]
        got = out[out.query_id == q].sort_values("rank")
        assert list(got["rank"]) == list(range(1, 11))
        assert np.array_equal(got.score.to_numpy(), d[got.vec_id.to_numpy()])
        hits.append(len(set(want) & set(got.vec_id)) / 10)
    assert set(out.query_id) == set(range(0, 1500, 100)) and np.mean(hits) >= 0.9
    assert list(out[out.query_id == 100].sort_values("rank").vec_id) == list(range(101, 111))


def test_neighbours_few_rows(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], schema)
    assert [(r.query_id, r.vec_id) for r in neighbours.search(few).orderBy("rank").collect()] == [(0, 2), (0, 1)]
    assert neighbours.search(few.limit(0)).count() == 0
    assert neighbours.search(few.where("vec_id = 0")).count() == 0


def test_probes_come_in_order():
    hashes = neighbours.Hashes(4, 2, 4, 1.0)
    place = np.array([0.3, 0.9, 5.2, -1.4])
    out = hashes.probes(place, 30)
    cost = []
    for bucket in out:
        move = bucket - np.floor(place)
        part = place - np.floor(place)
        cost.append(sum(p * p if m < 0 else (1 - p) ** 2 for p, m in zip(part, move) if m))
    assert len(np.unique(out, axis=0)) == 30 and cost == sorted(cost)


def test_pages(spark):
    html = (
        "<html><head><title>T</title><style>p{}</style></head><body><header>Top</header><nav><ul><li><a href='/'>Home</a></li></ul></nav>"
        "<!-- <p>no</p> --><div class='cookie-notice'><p>We use cookies on this site a lot.</p></div><article><h1>Name &amp; more</h1>"
        "<p>First\n  part <b>bold</b>ly<br>second &#65;&eacute;</p><aside>Side box text</aside><script>var a='<p>x</p>';</script>"
        "<div id='comments'><p>Nice article, thanks a lot for it.</p></div><p>A <a href='u'>link</a> here</p></article>"
        "<form><p>Sign up</p></form><footer>&copy; me</footer></body></html>"
    )
    rows = [(1, "u", html, 0), (2, None, None, 0), (3, "v", "", 0), (None, "w", "<p>Just one long paragraph with nothing else around it at all.", 0), (1, "u", html, 0)]
    out = pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    by = {r.page_id: r for r in out}
    assert by[1].text == "Name & more First part boldly second Aé A link here" and by[1].n_chars == len(by[1].text)
    assert by[2].text == "" and by[3].text == "" and by[None].text.startswith("Just one") and len(out) == 5
    tree = pages.train()
    assert all(pages.decide(tree, r[:-1]) == r[-1] for r in pages.TABLE)
    for odd in ("<" * 3000, "<div>" * 20_000 + "x", "</p>" * 3000, "<p <p <p", "<script>never closed", "a<b>c"):
        pages.main_text(odd, tree)


def test_short_articles_are_whole():
    tree = pages.train()
    for a in range(14):
        for b in (1, 2, 4, 7, 10, 14):
            for c in (0, 3, 6, 11):
                parts = "".join(f"<p>{' '.join(['w'] * n)}</p>" for n in (a, b, c) if n)
                page = f"<nav><a href=x>Home page</a></nav><article>{parts}</article><footer>&copy; A B C</footer>"
                assert pages.main_text(page, tree) == " ".join(["w"] * (a + b + c)), (a, b, c)
    page = "<article><h1>Bridge closed again</h1><p>The bridge was closed on Monday.</p></article>"
    assert pages.main_text(page, tree) == "Bridge closed again The bridge was closed on Monday."


def test_neighbours_decide_on_unmarked_pages():
    """One and the same block is kept between paragraphs and dropped between links."""
    tree = pages.train()
    block, long = "<p>" + "same " * 22 + "</p>", "<p>" + "other " * 40 + "</p>"
    link = "<div><a href=x>more</a></div>"
    assert "same" in pages.main_text(long + block + long, tree)
    assert "same" not in pages.main_text(link + block + link, tree)


def test_long_and_empty_pages(spark):
    page = "<article>" + "<p>word here and more</p>" * 30_000 + "</article>"
    rows = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    assert pages.extract(rows).first().n_chars == 30_000 * 19 - 1
    assert pages.extract(rows.limit(0)).count() == 0


def test_shards(spark):
    rows = corpus(3, 200) + [(300 + i, "same text " * 20, "en", "s", 0) for i in range(150)]
    for df, n in ((frame(spark, rows, True), len(rows)), (frame(spark, rows).limit(0), 0)):
        out = shards.assign(df).collect()
        assert len(out) == n
    out = shards.assign(frame(spark, rows, True)).toPandas()
    text = {r[0]: r[1] or "" for r in rows if r[0] is not None}
    for _, part in out.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    known = out[out.doc_id.notna()]
    homes = {}
    for r in known.itertuples():
        homes.setdefault((r.text_crc32, getattr(r, "size")), set()).add(r.shard)
    assert all(len(h) == 1 for h in homes.values())
    want = Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows if r[0] is not None)
    assert Counter(zip(known.doc_id.astype(int), known["size"], known.text_crc32)) == want
    # All but the shard of the largest group come out near equal.
    total = sorted(out.groupby("shard")["size"].sum())
    assert len(total) == 24 and total[-2] - total[0] <= out["size"].max()


def test_packing():
    rng = random.Random(1)
    sizes = [rng.randrange(1, 1000) for _ in range(3000)]
    placed, bins = shards.pack(sizes, 5000)
    rooms = [0] * bins
    for s, b in zip(sizes, placed):
        rooms[b] += s
    assert max(rooms) <= 5000 and bins <= -(-sum(sizes) // 5000) + 1
    # The tree gives the same bins as a plain scan for the tightest one.
    free, plain = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [(room, b) for b, room in enumerate(free) if room >= sizes[i]]
        b = min(fits)[1] if fits else len(free)
        if not fits:
            free.append(5000)
        free[b] -= sizes[i]
        plain[i] = b
    assert [plain[i] for i in range(len(sizes))] == placed
    total = [0] * 24
    for s, b in zip([*sizes, 10**6], shards.spread([*sizes, 10**6], 24)):
        total[b] += s
    rest = sorted(total)[:-1]
    assert max(total) == 10**6 and max(rest) - min(rest) < 0.01 * max(rest)


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(150), rng.randrange(150)) for _ in range(90)] + [(i, i + 1) for i in range(200, 260)] + [(5, 5)]
    out = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    assert out == {i: find(i) for i in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline(spark, tmp_path):
    """Each stage against brute force on what its predecessor kept, and run() against them."""
    docs, labels = labelled_docs(160)
    docs = [d for d in docs if d[0] is not None]
    rng = random.Random(8)
    item = " ".join(rng.choices(VOCABULARY, k=30))
    span = " ".join(rng.choices(VOCABULARY, k=60))
    for i in range(300, 312):
        own = " ".join(rng.choices(VOCABULARY, k=80))
        docs.append((i, f"{own} {item if i % 4 == 0 else span}", "en", "s", 0))
        docs.append((i + 100, docs[-1][1] + " tail", "en", "s", 0))
    frame(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    sf, now, seen = str(tmp_path), spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, sf)
        before, after = [tuple(r) for r in now.collect()], [tuple(r) for r in out.collect()]
        if name == "quality_classifier":
            model = quality.fit(now, spark.read.parquet(f"{sf}/labels.parquet"))
            assert Counter(after) == Counter(r for r in before if model.score(r[1]) >= 0.3)
        if name == "near_duplicates":
            gone = {k[0] for k in brute_groups(before, 5, 80) if k[0] != k[2]}
            assert Counter(after) == Counter(r for r in before if r[0] not in gone)
        if name == "benchmark_decontamination":
            hit = {k[0] for k in brute_contamination(before, [(1, item)]) if k[5]}
            assert hit and Counter(after) == Counter(r for r in before if r[0] not in hit)
        if name == "sentencepiece_codes":
            assert {r[0] for r in after} == {r[0] for r in before} and all(r[4] for r in after)
        else:
            assert out.columns == now.columns
        seen[name] = len(after)
        now = spark.createDataFrame(after, out.schema)
    final = corpus_pipeline.run(spark, sf)
    assert answers(final.drop("ids")) == answers(now.drop("ids"))
    assert seen["quality_classifier"] > seen["near_duplicates"] > seen["benchmark_decontamination"] > 0
