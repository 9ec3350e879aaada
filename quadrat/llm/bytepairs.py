"""Byte-level BPE encoding and decoding.

A text is cut by the tokenizer's pattern, in Spark. The words of an Arrow batch go on as a
dictionary and indices: each distinct word is folded once a batch, and the ids of all its
places are gathered with numpy. A fold joins the adjacent pieces of lowest rank, the leftmost
first, until no two have a rank. A task remembers at most ``REMEMBERED`` words of at most
``SHORT`` bytes between batches; what is remembered decides on the work, never on the ids.
Nothing is shuffled or gathered, and the ranks go to the tasks as they are, not as part of
the plan, whose text the driver keeps.

The fold joins one pair a step and looks at all pieces for it, which would be quadratic for a
word of a million characters. Longer words than ``WINDOW`` bytes are therefore taken window by
window: the last pieces so far and the next bytes are folded together. If the first of those
pieces comes out again, every two neighbours are as they would be alone, and so the pieces
are those of the whole; if not, more pieces are folded again, in the end all of them.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Callable, Iterator, Mapping
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from quadrat.llm.rows import STEP

WINDOW = 256
OVERLAP = 4  # pieces folded again at first
REMEMBERED = 1 << 17
SHORT = 32

# Code points that are letters or numbers in Unicode 16, as the tokenizer library has it, and not
# yet in the Unicode 13 of older Java versions.
LATER_LETTERS = """
870-887 889-88E 8B5 8C8-8C9 C5D CDD 170D 171F 1B4C 1C89-1C8A 2C2F 2C5F 9FFD-9FFF A7C0-A7C1 A7CB-A7CD A7D0-A7D1 A7D3 A7D5-A7DC
A7F2-A7F4 10570-1057A 1057C-1058A 1058C-10592 10594-10595 10597-105A1 105A3-105B1 105B3-105B9 105BB-105BC 105C0-105F3
10780-10785 10787-107B0 107B2-107BA 10D4A-10D65 10D6F-10D85 10EC2-10EC4 10F70-10F81 11071-11072 11075 1123F-11240 11380-11389
1138B 1138E 11390-113B5 113B7 113D1 113D3 11740-11746 11AB0-11ABF 11BC0-11BE0 11F02 11F04-11F10 11F12-11F33 12F90-12FF0 1342F
13441-13446 13460-143FA 16100-1611D 16A70-16ABE 16D40-16D6C 18CFF 1AFF0-1AFF3 1AFF5-1AFFB 1AFFD-1AFFE 1B11F-1B122 1B132 1B155
1DF00-1DF1E 1DF25-1DF2A 1E030-1E06D 1E290-1E2AD 1E4D0-1E4EB 1E5D0-1E5ED 1E5F0 1E7E0-1E7E6 1E7E8-1E7EB 1E7ED-1E7EE 1E7F0-1E7FE
2A6DE-2A6DF 2B735-2B739 2EBF0-2EE5D 31350-323AF
"""
LATER_NUMBERS = "10D40-10D49 116D0-116E3 11BF0-11BF9 11F50-11F59 16130-16139 16AC0-16AC9 16D70-16D79 1CCF0-1CCF9 1D2C0-1D2D3 1E4F0-1E4F9 1E5F1-1E5FA"


def _ranges(codes: str) -> str:
    return "".join("-".join(rf"\x{{{c}}}" for c in r.split("-")) for r in codes.split())


def java_pattern(pattern: str) -> str:
    """The tokenizer's pattern in Java's syntax, with the library's letters, numbers and white space."""
    letters, numbers, space = _ranges(LATER_LETTERS), _ranges(LATER_NUMBERS), r"\p{IsWhite_Space}"
    made = pattern.replace(r"[^\s\p{L}\p{N}]", "<other>").replace(r"\p{L}", "<letter>").replace(r"\p{N}", "<number>")
    if "[" in made or r"\w" in made or r"\d" in made:
        raise ValueError("a pattern of letters, numbers, white space and the rest is supported")
    made = made.replace(r"\s", space).replace(r"\S", r"\P{IsWhite_Space}")
    later = lambda extra: rf"[\x{{870}}-\x{{10FFFF}}&&[{extra}]]"  # noqa: E731 (one test for common characters)
    return (made.replace("<other>", rf"[[^{space}\p{{L}}\p{{N}}]&&[[\x{{0}}-\x{{86F}}][^{letters}{numbers}]]]")
            .replace("<letter>", rf"[\p{{L}}{later(letters)}]").replace("<number>", rf"[\p{{N}}{later(numbers)}]"))


class Ranks:
    """Rank by byte string, read from a file of base64 tokens and ranks."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.of = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        if any(bytes([b]) not in self.of for b in range(256)):
            raise ValueError("every byte must have a rank")
        self.size = max(self.of.values()) + 1
        if any(_fold(token, self.of) != [token] for token in self.of):
            raise ValueError("every token must come out of joining its own bytes")

    def surfaces(self) -> Column:
        """Array of byte strings by rank."""
        by_rank = [""] * self.size
        for token, rank in self.of.items():
            by_rank[rank] = token.decode("latin-1")
        return F.from_json(F.lit(json.dumps(by_rank)), "array<string>")


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _fold(word: bytes, of: Mapping[bytes, int]) -> list[bytes]:
    """Pieces of a byte string by ranked joins."""
    none = float("inf")
    pieces = [word[i:i + 1] for i in range(len(word))]
    ranks = [of.get(a + b, none) for a, b in zip(pieces, pieces[1:])]  # of every piece with the next one
    while ranks and (best := min(ranks)) < none:
        at = ranks.index(best)
        pieces[at:at + 2] = [pieces[at] + pieces[at + 1]]
        del ranks[at]
        if at:
            ranks[at - 1] = of.get(pieces[at - 1] + pieces[at], none)
        if at < len(ranks):
            ranks[at] = of.get(pieces[at] + pieces[at + 1], none)
    return pieces


def _fold_long(word: bytes, of: Mapping[bytes, int]) -> list[bytes]:
    """``_fold`` window by window."""
    done: list[bytes] = []
    for i in range(0, len(word), WINDOW):
        size = min(OVERLAP, len(done))
        while True:
            again = done[len(done) - size:]
            found = _fold(b"".join(again) + word[i:i + WINDOW], of)
            if size == len(done) or found[0] == again[0]:
                break
            size = min(16 * size, len(done))
        done[len(done) - size:] = found
    return done


def _encoded(word: str, of: Mapping[bytes, int]) -> list[int]:
    """Ids of one word: its own rank if it has one, else those of its folded pieces."""
    whole = word.encode()
    if whole in of:
        return [of[whole]]
    return [of[piece] for piece in (_fold if len(whole) <= WINDOW else _fold_long)(whole, of)]


def _lists(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All values of an array of lists, and where the list of each row begins and the last one ends."""
    ends = np.cumsum(column.value_lengths().fill_null(0).to_numpy(), dtype="int64")
    return column.flatten(), np.concatenate([[0], ends])


def _last_column(df: DataFrame, name: str, kind: str, make: Callable[[], Callable[[pa.Array], pa.Array]]) -> DataFrame:
    """``df`` with its last column replaced by ``name``, computed from it in Arrow; ``make`` runs once per task."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = make()
        for whole in batches:
            for at in range(0, whole.num_rows, STEP):
                batch = whole.slice(at, STEP)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], made(batch.columns[-1])], names=[*batch.schema.names[:-1], name])

    return df.mapInArrow(step, T.StructType([*df.schema[:-1], *T._parse_datatype_string(f"`{name}` {kind}")]))


def words(text: Column, pattern: str) -> Column:
    """The matches of the tokenizer's pattern, which together are the whole text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(java_pattern(pattern)), F.lit(0))


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", most: int = REMEMBERED) -> DataFrame:
    """Add ``ids``: the ids (array of int) of every whole text, without special tokens.

    A null or empty text has none. Rows, repeated ones too, are kept one to one; no row is
    needed by another. A column called like ``ids`` in any letter case is replaced. A task
    remembers the ids of at most ``most`` words.
    """
    of = Ranks(path).of

    def make() -> Callable[[pa.Array], pa.Array]:
        known: dict[str, list[int]] = {}

        def ids_of(word: str) -> list[int]:
            found = known.get(word)
            if found is None:
                found = _encoded(word, of)
                if len(known) < most and len(word) <= SHORT:
                    known[word] = found
            return found

        def coded(column: pa.Array) -> pa.Array:
            said, begins = _lists(column)
            said = said.dictionary_encode()
            folded = [ids_of(w) for w in said.dictionary.to_pylist()]
            sizes = np.fromiter(map(len, folded), "int64", len(folded))
            flat = np.fromiter(chain.from_iterable(folded), "int32", int(sizes.sum()))
            at = said.indices.to_numpy()
            upto = np.concatenate([[0], np.cumsum(sizes[at])])  # ids before each word
            place = np.repeat((np.cumsum(sizes) - sizes)[at] - upto[:-1], sizes[at]) + np.arange(upto[-1])
            return pa.ListArray.from_arrays(pa.array(upto[begins], pa.int32()), pa.array(flat[place], pa.int32()))

        return coded

    kept = [f"`{c}`" for c in df.columns if c.lower() != ids.lower()]
    return _last_column(df.select(*kept, words(F.col(text), pattern).alias(ids)), ids, "array<int>", make)


def decode(df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add ``decoded``: the bytes that the ids say, in order. Null ids give no bytes; an id outside the vocabulary gives none."""
    said = _let(Ranks(path).surfaces(), lambda by_rank: F.array_join(F.transform(F.coalesce(F.col(ids), F.array().cast("array<int>")), lambda i: F.get(by_rank, i)), ""))
    return df.select(*[f"`{c}`" for c in df.columns if c.lower() != decoded.lower()], F.encode(said, "ISO-8859-1").alias(decoded))


def token_report(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, number of ids, and digests of the ids and of the bytes decoded from them."""
    coded = decode(encode(df.select(F.col(key).alias("key"), F.col(text).alias("text")), path, pattern), path)
    report = coded.select("key", F.size("ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"), "ids")

    def digests(column: pa.Array) -> pa.Array:
        all_ids, begins = _lists(column)
        numbers = all_ids.to_numpy().astype("<u4")
        return pa.array([hashlib.sha256(numbers[a:b].tobytes()).hexdigest() for a, b in zip(begins, begins[1:])], pa.string())

    return _last_column(report, "ids_sha256", "string", lambda: digests).select(F.col("key").alias(key), "n_tokens", "ids_sha256", "decoded_sha256")
