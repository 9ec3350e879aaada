"""Batched model work with the model injected as a function.

The defaults need no download: a hashed bag of words for vectors and a
capitalised-term extractor for entities.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from quadrat.functions.missing import all_present
from quadrat.functions.text import first_tokens, join_components, prefixed
from quadrat.session import fan_out

# Input orders: variant name -> text components (fixed values).
INPUT_TYPES: Mapping[str, Sequence[str]] = {
    "titleAbstract": ("title", "abstract"),
    "titleRefs": ("title", "references"),
    "titleFOS": ("title", "fos"),
    "titleAbstractRefs": ("title", "abstract", "references"),
    "titleRefsFOS": ("title", "references", "fos"),
    "titleAbstractFOS": ("title", "abstract", "fos"),
    "titleAbstractRefsFOS": ("title", "abstract", "references", "fos"),
}
# Words put before a component (fixed values).
COMPONENT_PREFIX: Mapping[str, str] = {"references": "References:", "fos": "Fields of Study:"}
SEPARATOR = "[SEP]"
MAX_TOKENS = 512

EmbedFn = Callable[[Sequence[str]], np.ndarray]


def compose_inputs(
    df: DataFrame, key: str, input_types: Mapping[str, Sequence[str]] = INPUT_TYPES, sep: str = SEPARATOR,
    spread: bool = True,
) -> DataFrame:
    """(variant, key, text) for every variant whose components are all present; one scan.

    Without ``spread`` the rows stay in the partitions they come in.
    """
    def part(c: str):
        return prefixed(c, COMPONENT_PREFIX[c]) if c in COMPONENT_PREFIX else F.col(c)

    variants = F.array(*[
        F.when(all_present(cs), F.struct(
            F.lit(v).alias("variant"), join_components([part(c) for c in cs], sep).alias("text")
        ))
        for v, cs in input_types.items()
    ])
    return (fan_out(df) if spread else df).select(key, F.explode(F.filter(variants, lambda x: x.isNotNull())).alias("i")).select(
        "i.variant", key, "i.text"
    )


def hashed_words(dimensions: int = 64) -> EmbedFn:
    """Default vector: word counts hashed into ``dimensions`` slots, unit length."""
    slots: dict[str, int] = {}

    def slot(word: str) -> int:
        if word not in slots:
            if len(slots) > 500_000:
                slots.clear()
            slots[word] = int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % dimensions
        return slots[word]

    def embed(texts: Sequence[str]) -> np.ndarray:
        out = np.zeros((len(texts), dimensions))
        for i, text in enumerate(texts):
            hits = [slot(w) for w in text.lower().split(" ") if w]
            if hits:
                out[i] = np.bincount(hits, minlength=dimensions)
                out[i] /= np.linalg.norm(out[i])
        return out

    return embed


def embed_texts(
    df: DataFrame, keys: Sequence[str], text: str, load: Callable[[], EmbedFn] = hashed_words,
    batch_rows: int = 16, max_tokens: int = MAX_TOKENS, spread: bool = True,
) -> DataFrame:
    """keys + ``embedding``; the model is loaded once per task and fed in small batches.

    Without ``spread`` the rows stay in the partitions they come in.
    """
    schema = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys) + ", embedding array<float>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        embed = load()
        for batch in batches:
            texts = batch["__t"].tolist()
            vectors = [
                v for at in range(0, len(texts), batch_rows) for v in embed(texts[at:at + batch_rows])
            ]
            yield batch[list(keys)].assign(embedding=[np.asarray(v, dtype="float32") for v in vectors])

    given = df.select(*keys, text)
    ready = (fan_out(given) if spread else given).select(*keys, first_tokens(F.coalesce(F.col(text), F.lit("")), max_tokens).alias("__t"))
    return ready.mapInPandas(run, schema)


# Chat layout of the generation model (fixed value).
CHAT_TEMPLATE = (
    "<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\n{system}<|eot_id|>\n"
    "<|start_header_id|>user<|end_header_id|>\n\n{user}<|eot_id|>\n"
    "<|start_header_id|>assistant<|end_header_id|>\n\n"
)
_NAME = re.compile(r"\b[A-Z][a-z]+\b", re.ASCII)


def capitalised_terms(column: str, out: str = "ner") -> Callable[[], Callable[[pd.DataFrame], pd.DataFrame]]:
    """Default extractor: all capitalised words in order."""
    def load():
        def extract(batch: pd.DataFrame) -> pd.DataFrame:
            found = [", ".join(_NAME.findall(t)) for t in batch[column]]
            return batch.assign(**{out: found})

        return extract

    return load
