"""Token counts of texts by a public byte-level tokenizer."""

from __future__ import annotations

import base64
import importlib.util
import os

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Vocabulary file; a parameter of every operator that counts tokens.
DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that parts a text into the units of this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters encoded at a time, so that a huge text is never one call; cut at line ends.
PIECE = 1 << 20

_LOADED: dict[str, object] = {}


def encoding(path: str):
    """The tokenizer of a vocabulary file, loaded once per Python worker."""
    if path not in _LOADED:
        import tiktoken

        if not os.path.exists(path) and importlib.util.find_spec("public_tokenizers"):
            import public_tokenizers

            path = public_tokenizers.path(os.path.basename(path))
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _LOADED[path] = tiktoken.Encoding("marquee", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[path]


def count_tokens(text: str | None, path: str = DEFAULT_VOCABULARY) -> int:
    """Tokens of a whole text; a null one has none.

    A text beyond ``PIECE`` characters is cut before a word that follows a single space or line
    end and a letter, where the pattern parts units anyway, so the count is that of one call.
    """
    if not text:
        return 0
    enc, total, at = encoding(path), 0, 0
    while at < len(text):
        end = min(len(text), at + PIECE)
        while end < len(text) and not (text[end] == " " and text[end - 1].isalpha() and text[end + 1 : end + 2].isalpha()):
            end += 1
        total += len(enc.encode_ordinary(text[at:end]))
        at = end
    return total


def with_tokens(docs: DataFrame, *, text: str = "text", name: str = "n_tokens", vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """``docs`` with the token count of ``text`` as ``name`` in place of the text."""

    @F.pandas_udf("long")
    def counted(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: count_tokens(t, vocabulary))

    return docs.withColumn(name, counted(F.col(text))).drop(text)
