"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundloom.functions.frames import frame

#: Vocabulary of a byte-level tokenizer, present on every machine; its path is a parameter everywhere.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The published splitting pattern of that vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@functools.cache
def encoding(vocabulary: str = VOCABULARY):
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(text: str | None, vocabulary: str = VOCABULARY) -> int:
    """Tokens of the whole text; a null or empty text has none."""
    return len(encoding(vocabulary).encode_ordinary(text)) if text else 0


def measured(df: DataFrame, key: str, text: str, keep: tuple[str, ...] = (), vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, *keep, prompt_tokens, answer_tokens): the tokens of each text up to its first paragraph break, and the others.

    Their sum is the size of the whole text.

    A text of one paragraph is all answer. The texts themselves do not leave
    the scan's tasks: only their sizes are passed on.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    kept = [key, *keep]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            prompts, answers = [], []
            for t in f["__text"]:
                first, gap, rest = ("", "", "") if t is None or t != t else t.partition("\n\n")
                prompts.append(token_count(first + gap, vocabulary) if rest else 0)
                answers.append(token_count(t if gap else first, vocabulary) - prompts[-1])
            yield frame(**{k: f[k] for k in kept}, prompt_tokens=prompts, answer_tokens=answers)

    schema = ", ".join(f"`{k}` {types[k]}" for k in kept) + ", prompt_tokens bigint, answer_tokens bigint"
    return df.select(*kept, F.col(text).alias("__text")).mapInPandas(run, schema)
