"""Token counts with a whole-token shortcut.

Before any text is read it is proved which strings of the vocabulary encode alone, as one pre-token, to
exactly one token.  A pre-token of a text that is one of them counts 1; only the others are merged by the
tokenizer's model.  Results equal those of the library:

* Texts of characters below U+0180 (without U+0130) are normalised and cut by rules that are valid there:
  no composition happens, and letters, digits and white space are the fixed ranges below.
* Other texts are normalised and cut by the tokenizer itself, then counted the same way.
* A text that may hold a special string goes to the tokenizer whole, as its default treats those strings.

NULL and empty texts have 0 tokens.  Rows are counted one by one, so repeated rows stay repeated, and further
columns are kept.  No rows move between tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The pre-token pattern of the vocabulary, for characters below U+0180 after lower-casing.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ſ"
_DIGITS = "0-9²³¹¼½¾"
_SPACE = "\t-\r \x85\xa0"
_SPLIT = f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^{_SPACE}{_LETTERS}{_DIGITS}]+"
_HARD = "[^\x00-įı-ſ]"  # leaves U+0130 to the tokenizer too: its lower case is two characters

MERGED_WORDS = 1_000_000  # merged pre-tokens a worker remembers before it starts again


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(moved)}


class Counter(dict):
    """Tokens of a pre-token; a missing one is merged once and remembered."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self.whole = self._prove()
        self.update(self.whole)
        self.specials = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(self.specials) or "(?!)")
        self.split = re.compile(_SPLIT)
        self.hard = re.compile(_HARD)

    def _prove(self) -> dict[str, int]:
        """Vocabulary strings that are one pre-token and encode alone to one token."""
        back = {letter: byte for byte, letter in self.letters.items()}
        strings = []
        for entry in self.tokenizer.get_vocab(with_added_tokens=False):
            entry = entry.removesuffix("</w>")
            if entry and all(c in back for c in entry):
                try:
                    strings.append(bytes(back[c] for c in entry).decode())
                except UnicodeDecodeError:  # a part of a character
                    continue
        strings = sorted(set(strings))
        found = self.tokenizer.encode_batch(strings, add_special_tokens=False)
        return {
            s: 1
            for s, e in zip(strings, found, strict=True)
            if len(e.ids) == 1 and e.offsets[0] == (0, len(s)) and self._pieces(s) == [s]
        }

    def _pieces(self, text: str) -> list[str]:
        """Pre-tokens by the tokenizer itself, as text."""
        text = self.tokenizer.normalizer.normalize_str(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def __missing__(self, piece: str) -> int:
        if len(self) > MERGED_WORDS + len(self.whole):
            self.clear()
            self.update(self.whole)
        n = len(self.tokenizer.model.tokenize("".join(map(self.letters.__getitem__, piece.encode()))))
        if len(piece) <= 64:
            self[piece] = n
        return n

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.special.search(text):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if self.hard.search(text):
            return sum(map(self.__getitem__, self._pieces(text)))
        return sum(map(self.__getitem__, self.split.findall(text.lower())))


@lru_cache(maxsize=4)
def counter(path: str) -> Counter:
    return Counter(path)


def token_count(text: Column, vocabulary: str = "word_bpe_49k.json") -> Column:
    """Number of tokens of ``text``; ``vocabulary`` names a file known to ``public_tokenizers``, or is a path."""

    @F.pandas_udf("long")
    def counted(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import public_tokenizers

        own = counter(vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary))
        for texts in series:
            yield pd.Series([own.count(t) for t in texts], dtype="int64")

    return counted(text)


def token_counts(docs: DataFrame, text: str = "text", limit: int = 2048, vocabulary: str = "word_bpe_49k.json"):
    """``docs`` with n_bytes, n_tokens and over_limit; columns of these names are replaced."""
    filled = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumn("n_bytes", F.octet_length(filled).cast("long"))
    out = out.withColumn("n_tokens", token_count(filled, vocabulary))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
