"""Toxicity by weak supervision.

Voters look at a text: word lists (general insults by kind and language, and lists learned from
a bounded sample of labelled rows), patterns, and two that vote for clean. The votes of all rows are
counted by pattern, and a generative label model estimates from these counts alone how accurate
the voters are and which depend on each other: each class draws the votes along a forest of
significantly correlated voters, fitted by expectation maximisation from the majority vote. A
linear classifier over words and votes is then trained on the posterior labels
(follow-the-regularised-leader, which leaves few weights), and scores every whole text.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, fold
from tidemark.llm.quality import sample

SAMPLE_ROWS, SAMPLE_CHARS = 4_000, 16_000_000  # labelled rows
LEARNED = 80  # words in the learned lists
LISTS = 4
ROUNDS = 60
FORESTS = 6
SMOOTH = 0.1  # added to every count of a table
SURE, LABEL = 3.0, 4.0  # log odds: the most that the label model may claim, and a label's vote
EPOCHS = 4
LEXICONS = {
    "mind": "stupid idiot idiots idiotic moron morons moronic dumb imbecile imbeciles fool fools dimwit halfwit brainless clown clowns",
    "worth": "worthless useless pathetic loser losers failure nobody waste",
    "disgust": "disgusting trash garbage scum filth filthy vermin vile repulsive gross rat rats pig pigs",
    "hate": "hate hates hateful despise loathe detest",
    "threat": "kill murder strangle stab burn rape lynch exterminate",
    "profane": "damn crap shit shitty fuck fucking fucker bitch bitches bastard bastards asshole ass dick prick slut whore cunt",
    "fr": "idiote imbécile crétin connard connasse salaud salope merde débile abruti ordure minable",
    "es": "idiota estúpido estúpida imbécil basura mierda cabrón puta pendejo asqueroso inútil tonto",
    "de": "idiot dummkopf arschloch scheiße schlampe abschaum wertlos dreck trottel blödmann widerlich",
}
PATTERNS = {
    "address": r"\byou(?: are|'re) (?:such )?an? ?\w* ?(?:idiot|moron|loser|clown|fool|disgrace|joke)\b",
    "shut": r"\b(?:shut up|get lost|go to hell|drop dead|kill yourself)\b",
    "hidden": r"\b(?:[sf]\W?[*#@]+\W?\w+|(?:i[.\-_*]d[.\-_*]i[.\-_*]o[.\-_*]t)|st[*u]p[*!1]d|m[o0]r[o0]n)\b",
}
_LETTERS = re.compile(r"[^\W\d_]+")
_PATTERNS = [re.compile(p) for p in PATTERNS.values()]
_FIXED = [frozenset(v.split()) for v in LEXICONS.values()]


def words(text: str | None) -> frozenset:
    return frozenset(_LETTERS.findall((text or "").lower()))


class Voters:
    """Votes of all voters: 1 toxic, -1 clean, 0 abstains."""

    def __init__(self, learned: list[frozenset]):
        self.lists = [*_FIXED, *learned]
        self.every = frozenset().union(*self.lists)
        self.fixed = frozenset().union(*_FIXED)
        self.size = len(self.lists) + len(_PATTERNS) + 3

    def votes(self, text: str | None, found: frozenset) -> list[int]:
        hits = found & self.every
        low = (text or "").lower()
        out = [int(not hits.isdisjoint(x)) for x in self.lists] if hits else [0] * len(self.lists)
        out += [int(p.search(low) is not None) for p in _PATTERNS]
        out.append(int(len(hits & self.fixed) > 1))
        out.append(-int(hits.isdisjoint(self.fixed)))
        out.append(-int(not hits))
        return out


def learn_lists(rows: list[frozenset], labels: np.ndarray) -> list[frozenset]:
    """Words far more frequent in toxic rows, dealt to ``LISTS`` lists."""
    count: dict[str, list[int]] = {}
    for found, y in zip(rows, labels, strict=True):
        for w in found:
            count.setdefault(w, [0, 0])[y] += 1
    n = np.bincount(labels, minlength=2) + 1.0
    scored = [
        (np.log((b + 0.5) / n[1]) - np.log((a + 0.5) / n[0]), w)
        for w, (a, b) in count.items()
        if b >= 4 and b > 3 * a * n[1] / n[0]
    ]
    top = [w for s, w in sorted(scored, key=lambda x: (-x[0], x[1]))[:LEARNED] if s > 2.5]
    return [frozenset(top[i::LISTS]) for i in range(LISTS)]


def label_model(
    votes: np.ndarray, known: np.ndarray, weights: np.ndarray | None = None, history: list | None = None
) -> np.ndarray:
    """Posterior of class 1 for each row of ``votes`` (-1, 0, 1), which counts ``weights`` times.

    A class draws the votes along a forest: each voter has a table of its own or one joint with the
    voter it depends on. Edges are the pairs whose votes share significantly more than the class
    explains, the strongest first; they are found again under what expectation maximisation with
    their tables gives, until the forest stays (``FORESTS`` times at most). There are two starts from the
    majority vote: with no edges (pairs that only the vote links are not taken for
    dependent) and with those found under it (two voters that copy each other do not pass for the
    class). The likelier outcome counts, less the usual penalty of its tables (half the logarithm of
    the rows for each parameter). ``known`` is 0, 1 or -1 (not known); a known row keeps its class.
    ``history`` collects the (start, edges, log likelihood) of every round; it does not fall while
    the edges stay.
    """
    n = len(votes)
    w = np.ones(n) if weights is None else weights.astype(float)
    lead = (votes == 1).sum(1) - (votes == -1).sum(1)
    first = np.where(known >= 0, known, 1 / (1 + np.exp(-np.clip(2.0 * lead - 1, -30, 30))))
    if n == 0:
        return first
    v, best = votes + 1, None
    for start in (0, 1):
        post, before = first, None
        edges = _edges(v, w, post) if start else []
        for _ in range(FORESTS):
            post, rounds = _maximised(v, w, post, known, edges)
            if history is not None:
                history += [(start, tuple(edges), r) for r in rounds]
            value = rounds[-1] - 4 * len(edges) * np.log(w.sum() + 1)
            before, edges = edges, _edges(v, w, post)
            if edges == before:
                break
        if best is None or value > best[0]:
            best = (value, post)
    return best[1]


def _maximised(
    v: np.ndarray, w: np.ndarray, post: np.ndarray, known: np.ndarray, edges: list[tuple[int, int]]
) -> tuple[np.ndarray, list[float]]:
    """The posterior that expectation maximisation ends in, and the likelihood of each round."""
    parents = {child: parent for parent, child in edges}
    rounds = []
    for _ in range(ROUNDS):
        both = np.stack([w * (1 - post), w * post])
        score = np.repeat((np.log(both.sum(1) + 1) - np.log(w.sum() + 2))[:, None], len(v), 1)
        for j in range(v.shape[1]):
            # A voter given its parent, or alone: counts per class, smoothed.
            i = parents.get(j)
            cell = v[:, j] if i is None else 3 * v[:, i] + v[:, j]
            table = np.stack([np.bincount(cell, x, 3 if i is None else 9) for x in both]) + SMOOTH
            table = table.reshape(2, -1, 3)
            score = score + np.log(table / table.sum(2, keepdims=True)).reshape(2, -1)[:, cell]
        total = np.logaddexp(score[0], score[1])
        rounds.append(float((w * total).sum()))
        new = np.where(known >= 0, known, np.exp(score[1] - total))
        moved, post = np.abs(new - post).max(), new
        if moved < 1e-6:
            break
    return post, rounds


def _edges(v: np.ndarray, w: np.ndarray, post: np.ndarray) -> list[tuple[int, int]]:
    """(parent, child) pairs of a forest of the voters that agree beyond what the class explains."""
    m = v.shape[1]
    found = []
    for i in range(m):
        for j in range(i + 1, m):
            shared = 0.0
            for part in (w * (1 - post), w * post):
                joint = np.bincount(3 * v[:, i] + v[:, j], part, 9).reshape(3, 3)
                alone = joint.sum(1, keepdims=True) * joint.sum(0, keepdims=True) / max(joint.sum(), 1e-12)
                at = joint > 1e-9
                shared += float((joint[at] * np.log(joint[at] / alone[at])).sum())
            # Twice this is about chi-square with 8 degrees of freedom; 26 is its upper thousandth.
            if 2 * shared > 26:
                found.append((shared, i, j))
    root = list(range(m))

    def top(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    near: dict[int, list[int]] = {}
    for _, i, j in sorted(found, key=lambda x: (-x[0], x[1:])):
        if top(i) != top(j):
            root[top(i)] = top(j)
            near.setdefault(i, []).append(j)
            near.setdefault(j, []).append(i)
    out, seen = [], set()
    for start in sorted(near):
        line = [start] if start not in seen else []
        seen.add(start)
        while line:
            i = line.pop()
            for j in near[i]:
                if j not in seen:
                    seen.add(j)
                    out.append((i, j))
                    line.append(j)
    return out


def linear(rows: list[list[int]], targets: np.ndarray, size: int, l1: float = 1.0, seed: int = 0):
    """Weights and bias of a logistic model over binary features, by follow-the-regularised-leader."""
    z, n, w = np.zeros(size), np.zeros(size), np.zeros(size)
    bias, seen = 0.0, 1.0
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            at = rows[i]
            own = np.where(np.abs(z[at]) <= l1, 0.0, -(z[at] - np.sign(z[at]) * l1) / ((1.0 + np.sqrt(n[at])) / 0.5 + 0.1))
            p = 1 / (1 + np.exp(-np.clip(own.sum() + bias, -35, 35)))
            g = p - targets[i]
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / 0.5
            z[at] += g - sigma * own
            n[at] += g * g
            seen += g * g
            bias -= 0.3 * g / np.sqrt(seen)
    w = np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((1.0 + np.sqrt(n)) / 0.5 + 0.1))
    return w, bias


class Model:
    def __init__(self, voters: Voters, weights: dict[str, float], votes: np.ndarray, bias: float):
        self.voters, self.weights, self.of_votes, self.bias = voters, weights, votes, bias
        self.keys = frozenset(weights)

    def score(self, text: str | None) -> float:
        found = words(text)
        margin = self.bias + sum(self.weights[w] for w in sorted(found & self.keys))
        margin += float(np.dot(self.voters.votes(text, found), self.of_votes))
        return float(1 / (1 + np.exp(-np.clip(margin, -60, 60))))


def patterns(texts: DataFrame, voters: Voters) -> tuple[np.ndarray, np.ndarray]:
    """The distinct votes over all rows of ``texts``, and how many rows cast each.

    They follow the voters, not the rows: few of the combinations ever occur.
    """

    def run(batches):
        count: dict[bytes, int] = {}
        for batch in batches:
            for text in batch.column(0):
                cast = np.array(voters.votes(text.as_py(), words(text.as_py())), "int8").tobytes()
                count[cast] = count.get(cast, 0) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(count), pa.binary()), pa.array(list(count.values()), pa.int64())], names=["votes", "n"]
        )

    found = texts.select("text").mapInArrow(run, "votes binary, n long").groupBy("votes").agg(F.sum("n").alias("n"))
    rows = sorted((bytes(r[0]), r[1]) for r in found.collect())
    votes = np.frombuffer(b"".join(r[0] for r in rows), "int8").astype(int).reshape(len(rows), voters.size)
    return votes, np.array([r[1] for r in rows], float)


def train(texts: list[str | None], labels: list[int], cast: Callable[[Voters], tuple[np.ndarray, np.ndarray]]) -> Model:
    """``labels`` (0, 1) teach the learned lists and count as one more vote on their row.

    ``cast`` gives the votes of all rows with their counts; the label model is fitted on these alone.
    The classifier's targets are the posteriors of both.
    """
    rows, known = [words(t) for t in texts], np.array(labels, int)
    voters = Voters(learn_lists(rows, known))
    votes = np.array([voters.votes(t, r) for t, r in zip(texts, rows, strict=True)], int).reshape(len(rows), voters.size)
    every, times = cast(voters)
    post = dict(zip(map(tuple, every.tolist()), label_model(every, np.full(len(every), -1), times), strict=True))
    model = np.clip([post.get(tuple(v), 0.0) for v in votes.tolist()], 1e-9, 1 - 1e-9)
    odds = np.clip(np.log(model / (1 - model)), -SURE, SURE) + np.where(known == 1, LABEL, -LABEL)
    targets = 1 / (1 + np.exp(-odds))
    count: dict[str, int] = {}
    for found in rows:
        for w in found:
            count[w] = count.get(w, 0) + 1
    vocabulary = sorted(w for w, c in count.items() if c > 2)
    index = {w: i + voters.size for i, w in enumerate(vocabulary)}
    features = [
        [*np.flatnonzero(v).tolist(), *(index[w] for w in sorted(found) if w in index)] for v, found in zip(votes, rows, strict=True)
    ]
    # A voter's feature is its vote being cast; clean voters have a weight of their own sign.
    weights, bias = linear(features, targets, voters.size + len(vocabulary))
    sign = np.ones(voters.size)
    sign[-2:] = -1
    kept = {w: float(weights[i]) for w, i in index.items() if weights[i]}
    return Model(voters, kept, weights[: voters.size] * sign, bias)


def fit(docs: DataFrame, labels: DataFrame, mod: int = 3, held: int = 1) -> Model:
    """Train outside the held-out fold: about ``SAMPLE_ROWS`` labelled texts and the votes of all rows."""
    known = labels.where(F.col("toxic").isin(0, 1)).select("doc_id", F.col("toxic").cast("int").alias("label"))
    texts = docs.where(fold("doc_id", mod) != held).select("doc_id", "text")
    rows = sample(texts, known, SAMPLE_ROWS, SAMPLE_CHARS)
    return train([r[1] for r in rows], [r[2] for r in rows], lambda voters: patterns(texts, voters))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; NULL or empty text scores as clean text does.

    Rows with a NULL id are not held out and teach nothing; an id labelled twice counts twice.
    """
    model = fit(docs, labels)

    def run(batch: pa.RecordBatch):
        scores = [model.score(t.as_py()) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = arrow_map(docs.select("doc_id", "text"), f"doc_id {kind}, score double", run)
    return scored.select(
        "doc_id",
        F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
