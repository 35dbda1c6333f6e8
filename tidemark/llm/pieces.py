"""SentencePiece encoding and decoding by a shared-prefix Viterbi search.

Text is marked (a mark before the text and in place of each space) and cut before every run of
marks that follows another character, around line ends, and between a letter or digit and a
symbol that follows none inside any piece. No piece of the vocabulary crosses such a cut, so the
best split of the text is the best splits of its words, one after the other. The distinct new words of
a batch are sorted, which is the depth-first order of their trie, and the forward scores of the
prefix that a word shares with its predecessor are kept: only the rest is searched.

A split's score is the sum of its pieces' scores; of equal ones the piece that starts first wins,
at the last place where they differ. A character of no piece costs ``UNKNOWN`` below the lowest
score and becomes its UTF-8 bytes where the vocabulary has byte pieces, else the unknown id.
The text is not normalised otherwise. Decoding joins pieces, turns marks into spaces and drops the
first one; it returns the text unless that holds the mark character itself (it becomes a space).
"""

from __future__ import annotations

import hashlib
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tidemark.llm.common import arrow_map

MARK = "▁"
UNKNOWN = 10.0
CACHE = 400_000
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


class Pieces:
    """A vocabulary with the search over it. ``words`` keeps the splits of recent words."""

    def __init__(self, rows: list[tuple[int, str, float]], bytes_: dict[int, int], unknown: int):
        self.id = {piece: i for i, piece, _ in rows}
        self.score = {piece: score for _, piece, score in rows}
        self.text = {i: piece for i, piece, _ in rows}
        self.bytes = bytes_
        self.byte_of = {i: b for b, i in bytes_.items()}
        # What stands for itself wherever it occurs: pieces and ASCII bytes.
        self.plain = self.text | {i: chr(b) for b, i in bytes_.items() if b < 128}
        self.unknown = unknown
        self.longest = max(map(len, self.id), default=1)
        self.lowest = min(self.score.values(), default=0.0) - UNKNOWN
        self.words: dict[str, bytes] = {}
        self.cuts = self._cuts()

    def _cuts(self) -> re.Pattern:
        """The pattern of a word. Vocabularies with marks or line ends inside pieces are refused."""
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in self.id):
            raise ValueError("a piece crosses a word border")
        pairs = {x for p in self.id for x in zip(p, p[1:], strict=False) if x[0].isalnum() and not x[1].isalnum()}
        tail = ""
        if pairs:
            before, after = (re.escape("".join(sorted(set(x)))) for x in zip(*pairs, strict=True))
            tail = f"(?:(?<=[{before}])[{after}]+[^\\W_]*)*"
        word = f"{MARK}*(?:[^\\W_]+{tail}|(?:[\\W_](?<![{MARK}\n]))+[^\\W_]*{tail})"
        return re.compile(f"{word}|{MARK}+|\n")

    @classmethod
    def load(cls, path: str) -> Pieces:
        """Read the pieces of a SentencePiece model file on the driver."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        rows, bytes_ = [], {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                bytes_[int(_BYTE.fullmatch(piece)[1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                rows.append((i, piece, model.get_score(i)))
        return cls(rows, bytes_, model.unk_id())

    def learn(self, words: set[str]) -> None:
        """Search all words, in the depth-first order of their trie."""
        ids, score, longest, lowest = self.id, self.score, self.longest, self.lowest
        best, back = [0.0], [0]
        last = ""
        for word in sorted(words):
            shared = 0
            for x, y in zip(last, word, strict=False):
                if x != y:
                    break
                shared += 1
            del best[shared + 1 :], back[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                top, at = best[end - 1] + lowest, end - 1
                for start in range(max(0, end - longest), end):
                    gain = score.get(word[start:end])
                    if gain is not None:
                        total = best[start] + gain
                        if total > top or (total == top and start < at):
                            top, at = total, start
                best.append(top)
                back.append(at)
            last = word
            out: list[int] = []
            end = len(word)
            while end:
                piece = word[back[end] : end]
                i = ids.get(piece)
                if i is not None:
                    out.append(i)
                else:
                    raw = piece.encode("utf-8", "surrogatepass")
                    out.extend([self.bytes.get(b, self.unknown) for b in reversed(raw)])
                end = back[end]
            self.words[word] = array("i", out[::-1]).tobytes()

    def marked(self, text: str) -> list[str]:
        return self.cuts.findall(MARK + text.replace(" ", MARK)) if text else []

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.marked(t) for t in texts]
        new = set().union(*split) - self.words.keys() if split else set()
        if len(self.words) + len(new) > CACHE:
            self.words.clear()
            new = set().union(*split)
        self.learn(new)
        words = self.words
        return [np.frombuffer(b"".join(map(words.__getitem__, ws)), "int32") for ws in split]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ``ids``; unknown ids give U+2047, broken bytes U+FFFD."""
        try:
            text = "".join(map(self.plain.__getitem__, ids.tolist()))
        except KeyError:
            text = self._decode_bytes(ids)
        text = text.replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text

    def _decode_bytes(self, ids: np.ndarray) -> str:
        """As ``decode``, with runs of bytes read as UTF-8."""
        out: list[str] = []
        raw = bytearray()
        for i in [*ids.tolist(), None]:
            if i in self.byte_of:
                raw.append(self.byte_of[i])
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            if i is not None:
                out.append(self.text.get(i, "⁇"))
        return "".join(out)


def _parts(column: pa.Array, size: int = 1_000_000):
    """The texts of a column in runs of about ``size`` characters, which bounds what is held."""
    begin = total = 0
    for i, n in enumerate(pc.fill_null(pc.utf8_length(column), 0).to_pylist()):
        total += n
        if total >= size:
            yield begin, column.slice(begin, i + 1 - begin).to_pylist()
            begin, total = i + 1, 0
    if begin < len(column):
        yield begin, column.slice(begin).to_pylist()


def encode(
    docs: DataFrame, text: str = "text", ids: str = "ids", path: str = VOCABULARY
) -> DataFrame:
    """``docs`` with an array of piece ids. NULL text gives NULL, empty text an empty array.

    One map over the rows: nothing is shuffled and copies cost what their words cost. An
    existing column of the name ``ids`` is replaced.
    """
    model = Pieces.load(path)
    base = docs.drop(ids)

    def run(batch: pa.RecordBatch):
        for begin, texts in _parts(batch.column(at)):
            column = _lists(texts, model.encode([t or "" for t in texts]))
            part = batch.slice(begin, len(texts))
            yield pa.RecordBatch.from_arrays([*part.columns, column], names=[*names, ids])

    at, names = base.columns.index(text), base.columns
    return arrow_map(base, _schema(base, f"`{ids}` array<int>"), run)


def decode(
    docs: DataFrame, ids: str = "ids", text: str = "decoded", path: str = VOCABULARY
) -> DataFrame:
    """``docs`` with the text of an array of ids; NULL gives NULL, an empty array ''."""
    model = Pieces.load(path)
    base = docs.drop(text)

    def run(batch: pa.RecordBatch):
        column = [
            None if x is None else model.decode(np.array([-1 if v is None else v for v in x], "int64"))
            for x in batch.column(at).to_pylist()
        ]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(column, pa.string())], names=[*names, text]
        )

    at, names = base.columns.index(ids), base.columns
    return arrow_map(base, _schema(base, f"`{text}` string"), run)


def _schema(df: DataFrame, more: str) -> str:
    own = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema]
    return ", ".join([*own, more])


def _lists(texts: list, split: list[np.ndarray]) -> pa.Array:
    """The id arrays as an Arrow list column, NULL where the text is."""
    offsets, total = [], 0
    for text, ids in zip(texts, split, strict=True):
        offsets.append(None if text is None else total)
        total += len(ids)
    offsets.append(total)
    values = np.concatenate(split) if split else np.zeros(0, "int32")
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def round_trip(docs: DataFrame, path: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """Per row: doc_id, n_pieces, ids_sha256 (ids joined by commas), decoded_sha256, same_text.

    Encodes every whole text and decodes the ids again, in one map; NULL text counts as none
    (0 pieces, NULL digests). ``with_ids`` adds the ids themselves.
    """
    model = Pieces.load(path)

    def run(batch: pa.RecordBatch):
        for begin, texts in _parts(batch.column(1)):
            split = model.encode([t or "" for t in texts])
            back = [None if t is None else model.decode(x) for t, x in zip(texts, split, strict=True)]
            ids = [_lists(texts, split)] if with_ids else []
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(begin, len(texts)),
                    pa.array(map(len, split), pa.int64()),
                    pa.array([_digest(None if t is None else ",".join(map(str, x.tolist()))) for t, x in zip(texts, split, strict=True)], pa.string()),
                    pa.array(map(_digest, back), pa.string()),
                    pa.array([t == b for t, b in zip(texts, back, strict=True)], pa.bool_()),
                    *ids,
                ],
                names=names,
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_pieces", "ids_sha256", "decoded_sha256", "same_text"] + ["ids"] * with_ids
    schema = "n_pieces long, ids_sha256 string, decoded_sha256 string, same_text boolean"
    schema += ", ids array<int>" * with_ids
    return arrow_map(docs.select("doc_id", "text"), f"doc_id {kind}, {schema}", run)


def _digest(text: str | None) -> str | None:
    return None if text is None else hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
