"""Exact token counts at every prefix by dynamic programming over byte pair encodings.

A sequence of tokens is the encoding of its text exactly if every pair of neighbours
encodes to itself. So the encoding of each prefix of a word has one last token, found
from the last tokens of the shorter prefixes; its count is theirs plus one. No prefix
is encoded again. Words are independent, so the counts of a document are the running
sum over its words, and a cut inside a word is answered from that word's own table.
"""

from __future__ import annotations

import functools
import json
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the vocabulary file: how its pre-tokenizer finds the pieces of a text.
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
WORD_END = "</w>"

# A worker forgets the words it knows once they are this many.
_KNOWN_WORDS = 400_000
_ROWS = 512


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Pairs:
    """Which neighbours stay two tokens: merges applied to the pair alone."""

    def __init__(self, merges: list) -> None:
        pairs = (tuple(m.split(" ") if isinstance(m, str) else m) for m in merges)
        self.rank = {pair: k for k, pair in enumerate(pairs)}
        self.known: dict[tuple[str, str], bool] = {}

    def merge(self, symbols: list[str]) -> list[str]:
        while len(symbols) > 1:
            ranks = [self.rank.get(pair, 1 << 60) for pair in zip(symbols, symbols[1:])]
            at = ranks.index(min(ranks))
            if ranks[at] == 1 << 60:
                break
            symbols = [*symbols[:at], symbols[at] + symbols[at + 1], *symbols[at + 2 :]]
        return symbols

    @staticmethod
    def letters(token: str) -> list[str]:
        if token.endswith(WORD_END) and len(token) > len(WORD_END):
            body = token[: -len(WORD_END)]
            return [*body[:-1], body[-1] + WORD_END]
        return list(token)

    def stay(self, left: str, right: str) -> bool:
        """left may be empty: then right has to be one token by itself."""
        pair = (left, right)
        if (found := self.known.get(pair)) is None:
            found = self.merge(self.letters(left) + self.letters(right)) == ([left, right] if left else [right])
            self.known[pair] = found
        return found


class PrefixCounter(dict):
    """piece -> number of tokens; unknown pieces are worked out on first use."""

    def __init__(self, path: str) -> None:
        super().__init__()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.vocab = set(spec["model"]["vocab"])
        self.longest = max(map(len, self.vocab))
        self.pairs = Pairs(spec["model"]["merges"])
        self.byte = byte_letters()
        self.find = regex.compile(PIECE).findall
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")")
        self.reach: dict[str, int] = {}

    def _table(self, letters: str) -> tuple[list[int], list[str]]:
        """Count and last token of every prefix that goes on, in tokens inside a word."""
        stay, vocab = self.pairs.stay, self.vocab
        counts, last = [0], [""]
        for end in range(1, len(letters) + 1):
            for start in range(max(0, end - self.longest), end):
                token = letters[start:end]
                if token in vocab and stay(last[start], token):
                    counts.append(counts[start] + 1)
                    last.append(token)
                    break
        return counts, last

    def _closed(self, letters: str, end: int, counts: list[int], last: list[str]) -> int:
        """Count of the prefix that ends the word at ``end``."""
        for start in range(max(0, end - self.longest), end):
            token = letters[start:end] + WORD_END
            if token in self.vocab and self.pairs.stay(last[start], token):
                return counts[start] + 1
        raise ValueError(f"the vocabulary does not cover {letters[:end]!r}")

    def __missing__(self, piece: str) -> int:
        letters = "".join(map(self.byte.__getitem__, piece.encode()))
        counts, last = self._table(letters[:-1])
        self[piece] = found = self._closed(letters, len(letters), counts, last)
        return found

    def within(self, piece: str) -> list[int]:
        """Token counts of the piece cut after 0, 1, ... characters."""
        letters = "".join(map(self.byte.__getitem__, piece.encode()))
        counts, last = self._table(letters)
        found, end = [0], 0
        for char in piece:
            end += len(char.encode())
            found.append(self._closed(letters, end, counts, last))
        return found

    def normal(self, text: str) -> str:
        text = text if text.isascii() else unicodedata.normalize("NFC", text)
        # a capital sigma becomes the same letter everywhere, as case is mapped letter by letter
        return "".join(map(str.lower, text)) if "Σ" in text else text.lower()

    def pieces(self, text: str) -> list[str]:
        """Pieces in order; special strings stay whole."""
        if "<|" not in text:
            return self.find(self.normal(text))
        found: list[str] = []
        for k, part in enumerate(self.special.split(text)):
            if k % 2:
                self[part] = 1
                found.append(part)
            else:
                found += self.find(self.normal(part))
        return found

    def prefixes(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """For every piece: where it ends, in characters without white space, and the tokens up to there."""
        pieces = self.pieces(text) if text else []
        n = len(pieces)
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int32, n), dtype=np.int32)
        return ends, np.cumsum(np.fromiter(map(self.__getitem__, pieces), np.int32, n), dtype=np.int32)

    def forget(self) -> None:
        if len(self) > _KNOWN_WORDS:
            self.clear()
        if len(self.pairs.known) > _KNOWN_WORDS:
            self.pairs.known.clear()


@functools.lru_cache(2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def fits(counts: PrefixCounter, text: str, budget: int) -> int:
    """How many characters other than white space fit into ``budget`` tokens.

    One look-up in the stored prefixes, then the table of the one piece that is cut.
    """
    ends, tokens = counts.prefixes(text)
    k = bisect_right(tokens, budget)
    whole = int(ends[k - 1]) if k else 0
    if k == len(ends):
        return whole
    piece, spent = counts.pieces(text)[k], int(tokens[k - 1]) if k else 0
    if counts.special.fullmatch(piece):
        return whole
    return whole + max(i for i, n in enumerate(counts.within(piece)) if spent + n <= budget)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, np.int32), *parts])))


def count_tokens(docs: DataFrame, vocabulary: str, text: str = "text", carry: tuple[str, ...] | None = None) -> DataFrame:
    """Token counts at every prefix of every text, in one pass without a shuffle.

    Columns: ``record`` (struct of the ``carry`` columns, default all), ``n_bytes``
    (UTF-8), ``n_tokens`` and the prefix arrays ``ends`` (characters other than white
    space up to the end of each piece) and ``tokens`` (tokens up to there). A budget is
    answered by a search in ``tokens``; ``fits`` also goes inside a piece.

    ``vocabulary`` is the path of a word-end byte pair file, readable on every executor.
    Null and empty texts have 0 bytes, 0 tokens and empty arrays. Special strings count as
    their one token. Rows are independent, so ties and repeated rows change nothing.
    """
    rows = docs.select(
        F.struct(*[F.col(c) for c in (carry or docs.columns)]).alias("record"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"),
        F.col(text).alias("text"),
    )
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType(
        [*rows.schema.fields[:2], T.StructField("n_tokens", T.LongType()), T.StructField("ends", ints), T.StructField("tokens", ints)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(vocabulary)
        for whole in batches:
            for start in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(start, _ROWS)
                found = [counts.prefixes(t) for t in batch.column(2).to_pylist()]
                counts.forget()
                n = pa.array([int(t[-1]) if len(t) else 0 for _, t in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), n, _lists([e for e, _ in found]), _lists([t for _, t in found])],
                    ["record", "n_bytes", "n_tokens", "ends", "tokens"],
                )

    return rows.mapInArrow(run, schema)
