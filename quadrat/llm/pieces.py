"""SentencePiece (merge-type) encoding and decoding by a table of unique last pieces.

Every prefix of a text has one encoding, and so one last piece. An automaton reports the
pieces that end at a position; the one that belongs there is the only one that fits the last
piece of the prefix before it. Two pieces fit when merging their joined characters gives
the two back. Ids are recovered from the end of the text to its beginning.

A text is cut before each space mark that follows another character, where no piece of the
vocabulary can reach across, so that words repeated within a task are looked up.
"""

from __future__ import annotations

import codecs
import functools
import re
import struct

import ahocorasick
import numpy as np
import sentencepiece
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, functions as F

from quadrat.llm.rows import append_columns

SPACE = "▁"
WORDS_KEPT = 150_000  # words remembered per task; only speed depends on it
PAIRS_KEPT = 500_000
LONGEST_KEPT = 64


class Vocabulary:
    """Pieces of a merge-type model with byte fallback that does not alter texts."""

    def __init__(self, model: bytes):
        m = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(m.get_piece_size())
        self.begin, self.end, self.unknown = m.bos_id(), m.eos_id(), m.unk_id()
        self.control = {i for i in ids if m.is_control(i)}
        self.bytes = {int(m.id_to_piece(i)[3:5], 16): i for i in ids if m.is_byte(i)}
        self.text = {i: m.id_to_piece(i) for i in ids if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))}
        self.score = {p: m.get_score(i) for i, p in self.text.items()}
        self.id = {p: i for i, p in self.text.items()}
        letters = {p for p in self.id if len(p) == 1}
        if len(self.bytes) != 256 or any(c not in letters for p in self.id for c in p) or m.normalize("ﬁ  x ") != f"{SPACE}ﬁ{SPACE}{SPACE}x{SPACE}":
            raise ValueError("only merge-type models with byte fallback and the identity normaliser are supported")
        self.apart = not any(SPACE in p.lstrip(SPACE) for p in self.id)  # no piece reaches across the start of a word
        self.cut = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if self.apart else "(?s).+")


class Encoder:
    """Texts to little-endian 32-bit ids, with begin and end ids."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.automaton = ahocorasick.Automaton()
        self.right_edge: dict[int, list[tuple[float, str]]] = {}
        self.left_edge: dict[int, list[tuple[float, str]]] = {}
        shared: dict[tuple[float, str], tuple[float, str]] = {}  # pieces end in few different ways: equal steps are kept once
        for piece, i in vocabulary.id.items():
            self.automaton.add_word(piece, (i, len(piece)))
            merges, final = self._merged(piece)
            if final == 1:  # else the piece never comes out of merging its own characters
                left = _edge(piece[0], [(cost, at_left, joined) for cost, at_left, _, joined in merges])
                right = _edge(piece[-1], [(cost, at_right, joined) for cost, _, at_right, joined in merges])
                self.left_edge[i], self.right_edge[i] = ([shared.setdefault(s, s) for s in edge] for edge in (left, right))
        self.automaton.make_automaton()
        self.length = {i: len(p) for i, p in vocabulary.text.items()}
        self.begin, self.end = struct.pack("<I", vocabulary.begin), struct.pack("<I", vocabulary.end)
        self.begins = dict.fromkeys(self.left_edge, True)  # after nothing, or after a character outside the vocabulary
        self.rows: dict[int, dict[int, bool]] = {i: {} for i in vocabulary.text}
        self.pairs = 0
        self.words = _Words(self)

    def _merged(self, text: str) -> tuple[list[tuple[float, bool, bool, str]], int]:
        """Join adjacent symbols, best score first and leftmost among equals, while a join is a piece.

        Returns the joins in their order, as (cost, reaches the left end, reaches the right
        end, joined), and how many symbols remain.
        """
        parts, merges = list(text), []
        while True:
            best = min(((-self.v.score[p], k) for k, p in enumerate(map("".join, zip(parts, parts[1:]))) if p in self.v.score), default=None)
            if best is None:
                return merges, len(parts)
            cost, k = best
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
            merges.append((cost, k == 0, k == len(parts) - 1, parts[k]))

    def _fit(self, left: int, right: int) -> bool:
        """Whether merging the joined characters of two pieces leaves the two as they are.

        The joins inside either piece run in their own order; of the next joins the cheaper
        one comes first, the left one among equals. Only a join across the seam that is
        cheaper than what must happen before its symbols change can tear the pieces apart.
        """
        a, b, score = self.right_edge.get(left), self.left_edge.get(right), self.v.score
        if a is None or b is None:
            return False
        i = j = 0
        while True:
            cost_a, x = a[i]
            cost_b, y = b[j]
            seam = score.get(x + y)
            if seam is not None and -seam < cost_a and -seam <= cost_b:
                return False
            if cost_a == cost_b == _NEVER:
                return True
            if cost_a <= cost_b:
                i += 1
            else:
                j += 1

    def _learn(self, left: int, right: int) -> bool:
        if self.pairs >= PAIRS_KEPT:
            self.pairs = 0
            for row in self.rows.values():
                row.clear()
        self.pairs += 1
        fits = self.rows[left][right] = self._fit(left, right)
        return fits

    def word(self, text: str) -> bytes:
        """Ids of one stretch of text."""
        rows, begin, size_of = self.rows, self.begins, len(text)
        found = [0] * size_of  # last piece of the prefix that ends here
        fits = [begin] * size_of + [begin]  # which pieces may follow it; the extra one stands before the text
        for end, (i, size) in self.automaton.iter(text):  # the longest piece ending here comes first
            if not found[end]:
                fit = fits[end - size].get(i)
                if fit is None:
                    start = end - size
                    fit = self._learn(found[start], i) if start >= 0 and found[start] else False
                if fit:
                    found[end] = i
                    fits[end] = rows[i]
        ids, end = [], size_of - 1
        while end >= 0:
            i = found[end]
            if i:
                ids.append(i)
                end -= self.length[i]
            else:  # a character outside the vocabulary; nothing merges with it
                ids.extend(self.v.bytes[b] for b in reversed(text[end].encode()))
                end -= 1
        ids.reverse()
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        middle = b""
        if text:
            if "  " in text or text[0] == " " or SPACE in text or not self.v.apart:
                words = self.v.cut.findall(SPACE + text.replace(" ", SPACE))
            else:
                words = (SPACE + text.replace(" ", " " + SPACE)).split(" ")
            middle = b"".join(map(self.words.__getitem__, words))
            if len(self.words) > WORDS_KEPT:
                self.words.turn()
        return self.begin + middle + self.end


class _Words(dict):
    """Ids of recent words. When full, the words of the time before the last are forgotten."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder, self.before = encoder, {}
        self.line = encoder.word("\n") if "\n" not in encoder.v.id and encoder.v.apart else None

    def __missing__(self, word: str) -> bytes:
        ids = self.before.get(word)
        if ids is None:
            if self.line and "\n" in word:  # the line end is a character outside the vocabulary
                return self.line.join([self[w] if w else b"" for w in word.split("\n")])
            ids = self.encoder.word(word)
        if len(word) <= LONGEST_KEPT:
            self[word] = ids
        return ids

    def turn(self) -> None:
        self.before = dict(self)
        self.clear()


_NEVER = float("inf")


def _edge(symbol: str, merges: list[tuple[float, bool, str]]) -> list[tuple[float, str]]:
    """The symbols that stand at one end of a piece in turn, each with the dearest join that must run before it changes."""
    steps, dearest = [], -_NEVER
    for cost, changes, joined in merges:
        dearest = max(dearest, cost)
        if changes:
            steps.append((dearest, symbol))
            symbol, dearest = joined, -_NEVER
    return [*steps, (_NEVER, symbol)]


codecs.register_error("quadrat_each_byte", lambda e: ("�" * (e.end - e.start), e.end))


class Decoder:
    """Little-endian 32-bit ids to texts."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.surface = {i: p.replace(SPACE, " ").encode() for i, p in vocabulary.text.items()}
        self.surface |= {i: bytes([b]) for b, i in vocabulary.bytes.items()}
        self.surface |= dict.fromkeys(vocabulary.control, b"") | {vocabulary.unknown: " ⁇ ".encode()}
        self.opening = {i for i, p in vocabulary.text.items() if p.startswith(SPACE)}

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, "<u4").tolist()
        first = next((i for i in ids if i not in self.v.control), self.v.unknown)
        text = b"".join(map(self.surface.__getitem__, ids))
        if first in self.opening:
            text = text[1:]
        return text.decode("utf-8", "quadrat_each_byte")


@functools.lru_cache(maxsize=2)
def _encoder(name: str) -> Encoder:
    """Kept by a Python worker between its tasks."""
    with open(SparkFiles.get(name), "rb") as f:
        return Encoder(Vocabulary(f.read()))


@functools.lru_cache(maxsize=2)
def _decoder(name: str) -> Decoder:
    with open(SparkFiles.get(name), "rb") as f:
        return Decoder(Vocabulary(f.read()))


def _shipped(df: DataFrame, path: str) -> str:
    """Send the model file of the driver to every executor; its name there."""
    df.sparkSession.sparkContext.addFile(path)
    return path.rstrip("/").rsplit("/", 1)[-1]


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids``: the ids of every whole text as little-endian 32-bit integers.

    A null text counts as empty: begin and end id only. Rows, repeated ones too, are kept one
    to one; no row is needed by another. A column called like ``ids`` is replaced.
    """
    name = _shipped(df, path)

    def make():
        encoder = _encoder(name)
        return lambda texts: [(encoder.encode(t or ""),) for t in texts]

    return append_columns(df, text, f"`{ids}` binary", make)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add ``text``: what the ids say. Null ids give an empty text; ids outside the vocabulary fail."""
    name = _shipped(df, path)

    def make():
        decoder = _decoder(name)
        return lambda packed: [(decoder.decode(p or b""),) for p in packed]

    return append_columns(df, ids, f"`{text}` string", make)


def encode_decode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``encode`` and ``decode`` in one pass: the ids of every whole text, and the text they say."""
    name = _shipped(df, path)

    def make():
        encoder, decoder = _encoder(name), _decoder(name)
        return lambda texts: [(packed, decoder.decode(packed)) for packed in (encoder.encode(t or "") for t in texts)]

    return append_columns(df, text, f"`{ids}` binary, `{decoded}` string", make)


def digest(c: str | Column) -> Column:
    return F.sha2(F.col(c) if isinstance(c, str) else c, 256)


def token_report(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, number of ids, and digests of the ids and of the text decoded from them."""
    coded = encode_decode(df.select(key, text), path, text)
    return coded.select(key, (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), digest("ids").alias("ids_sha256"),
                        digest(F.col("decoded").cast("binary")).alias("decoded_sha256"))
