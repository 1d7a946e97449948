"""Toxicity of texts whose words may be disguised.

A disguised word is the noisy copy of a plain one: letters written as look-alikes
("1d10t"), separated ("i.d.i.o.t", "i d i o t") or repeated ("idiooot"). Every suspicious
token becomes a lattice of readings; Viterbi picks the most probable one under a
character trigram model of the whole corpus and the costs of the disguises. The restored
words are then scored with a lexicon learnt from labelled documents.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from renown.llm.memory import tidy
from renown.session import stage

# Which letters a look-alike may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
# Natural logs of how likely a disguise is.
LOOKALIKE_COST, DROP_COST, REPEAT_COST = -1.5, -1.0, -0.5
# ... and that a gap between single characters ends a word
BREAK_COST = -1.0

# letter classes of the model: 0 outside a word, 1-26 a-z, 27 any other letter
_CLASSES = 28
_RUN = re.compile(r"(.)\1\1")
_EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
# a single character, which marks may enclose; possessive, so that long rows of marks take linear time
_SINGLE = rf"(?:[{re.escape(_EDGE)}]*+\w[{re.escape(_EDGE)}]*+|[{re.escape(_EDGE)}€£])(?!\S)"
_SPACED = re.compile(rf"(?<!\S){_SINGLE}(?:\s+{_SINGLE})+")
_PREFIXES = (4, 5, 6)
_CLEAN_COST = 3
# a worker forgets the tokens it knows once they are this many
_KNOWN_TOKENS = 30_000
_ROWS = 512


def _byte_classes() -> np.ndarray:
    table = np.zeros(256, np.int32)
    for k in range(26):
        table[ord("a") + k] = table[ord("A") + k] = k + 1
    table[0xC3:] = 27  # a letter beyond ASCII is counted once, at its first byte
    return table


def character_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Counts of letter trigrams over all texts; at most 28**3 sums reach the driver."""
    table = _byte_classes()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_CLASSES**3, np.int64)
        for whole in batches:
            for start in range(0, whole.num_rows, _ROWS):
                texts = whole.column(0).slice(start, _ROWS).drop_null().to_pylist()
                raw = np.frombuffer(" ".join(["", *texts, " "]).encode(), np.uint8)
                code = table[raw[(raw < 0x80) | (raw >= 0xC0)]]
                total += np.bincount(code[:-2] * _CLASSES**2 + code[1:-1] * _CLASSES + code[2:], minlength=_CLASSES**3)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["code", "n"])

    rows = docs.select(text).mapInArrow(tidy(count), "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(_CLASSES**3, np.int64)
    for row in rows:
        counts[row["code"]] = row["n"]
    return counts.reshape(_CLASSES, _CLASSES, _CLASSES)


def trigram_logs(counts: np.ndarray) -> np.ndarray:
    """log P(third | first two), interpolated with bigrams and an even share."""
    three = counts + 0.0
    two = three.sum(0)
    low = (two + 0.5) / (two + 0.5).sum(1, keepdims=True)
    return np.log((three + 20.0 * low[None]) / (three.sum(2, keepdims=True) + 20.0))


class Restorer:
    """Viterbi decoding of single tokens."""

    def __init__(self, logs: np.ndarray) -> None:
        self.logs = logs.tolist()

    @staticmethod
    def _class(char: str) -> int:
        return ord(char) - 96 if "a" <= char <= "z" else 27

    def _readings(self, char: str, before: str) -> list[tuple[str, float]]:
        if char.isalpha():
            return [(char, 0.0), ("", REPEAT_COST)] if char == before else [(char, 0.0)]
        found = [(letter, LOOKALIKE_COST) for letter in LOOKALIKES.get(char, "")]
        return found + [("", REPEAT_COST if char == before else DROP_COST)]

    def decode(self, token: str) -> str:
        best: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
        before = ""
        for char in token:
            after: dict[tuple[int, int], tuple[float, str]] = {}
            readings = self._readings(char, before)
            for (a, b), (score, text) in best.items():
                for letter, cost in readings:
                    if letter:
                        c = self._class(letter)
                        state, value = (b, c), (score + cost + self.logs[a][b][c], text + letter)
                    else:
                        state, value = (a, b), (score + cost, text)
                    if state not in after or value > after[state]:
                        after[state] = value
            best, before = after, char
        return max((score + self.logs[a][b][0], text) for (a, b), (score, text) in best.items())[1]

    def decode_spaced(self, run: str) -> list[str]:
        """Words of a run of single characters; every gap is an edge inside a word or between two."""
        best: dict[tuple[int, int], tuple[float, tuple[str, ...]]] = {(0, 0): (0.0, ("",))}
        before = ""
        for k, token in enumerate(run.split()):
            char = token.strip(_EDGE) or token[0]
            readings = self._readings(char, before)
            after: dict[tuple[int, int], tuple[float, tuple[str, ...]]] = {}
            for (a, b), (score, words) in best.items():
                starts = [(a, b, score, words)]
                if k and words[-1]:
                    starts.append((0, 0, score + BREAK_COST + self.logs[a][b][0], (*words, "")))
                for p, q, value, found in starts:
                    for letter, cost in readings:
                        if letter:
                            c = self._class(letter)
                            state, option = (q, c), (value + cost + self.logs[p][q][c], (*found[:-1], found[-1] + letter))
                        else:
                            state, option = (p, q), (value + cost, found)
                        if state not in after or option > after[state]:
                            after[state] = option
            best, before = after, char
        return [w for w in max((score + self.logs[a][b][0], words) for (a, b), (score, words) in best.items())[1] if w]

    def restore(self, token: str) -> str:
        """The plain word; a token with one reading only needs no search."""
        core = token.strip(_EDGE)
        # a mark in front of a letter can be a letter in disguise
        front = token[0] in LOOKALIKES and token[1:2].isalpha() and not token[0].isalnum()
        if core.isalpha() and not front and not _RUN.search(core):
            return core
        if any(c.isalpha() for c in core):
            return self.decode(token.rstrip(_EDGE) if front else core)
        return core

    def words(self, text: str | None, known: dict[str, str]) -> set[str]:
        """Distinct restored words of a text."""
        low = (text or "").lower()
        found = set()
        for token in set(low.split()):
            word = known.get(token)
            if word is None:
                word = known[token] = self.restore(token)
            found.add(word)
        for run in spaced_runs(low):
            found.update(self.decode_spaced(run))
        found.discard("")
        return found


def spaced_runs(text: str) -> list[str]:
    """Runs of two or more single characters, each with any marks around it."""
    return _SPACED.findall(text)


def features(word: str) -> list[str]:
    """The word itself and its beginnings, so that inflected forms count together."""
    return [word, *(word[:k] + "*" for k in _PREFIXES if len(word) > k)]


@dataclass
class ToxicityModel:
    logs: np.ndarray
    weights: dict[str, float] = field(default_factory=dict)  # lexicon entry -> share of toxic documents
    base: float = 0.5  # share of toxic documents without any entry


def _signature(words: list[str]) -> int:
    """Near copies mostly share their smallest word hash; it tells independent documents apart."""
    return min((zlib.crc32(w.encode()) for w in words), default=0)


def _cover(toxic: list[tuple[int, set[str]]], seen: dict[str, tuple[int, int]], least: int) -> list[str]:
    """Entries that explain most of the toxic documents not explained before.

    Support counts signatures, not documents, and each clean document with the entry costs
    ``_CLEAN_COST``. A word that only rides along in a toxic document explains nothing new once
    the entry behind it is chosen. Whole words that are never clean and widely spread follow.
    """
    holds = defaultdict(set)
    for k, (_, entries) in enumerate(toxic):
        for entry in entries:
            holds[entry].add(k)
    spread = {e: len({toxic[k][0] for k in at}) for e, at in holds.items()}
    chosen: list[str] = []
    left = {e: set(at) for e, at in holds.items()}

    def value(entry: str) -> tuple:
        new = len({toxic[k][0] for k in left[entry]})
        n, bad = seen[entry]
        return new - _CLEAN_COST * (n - bad), not entry.endswith("*"), entry

    while left:
        entry = max(left, key=value)
        if value(entry)[0] < least:
            break
        chosen.append(entry)
        covered = set(left[entry])
        left = {e: at - covered for e, at in left.items() if at - covered}
    sure = [e for e in holds if not e.endswith("*") and spread[e] >= 4 * least and seen[e][1] >= 0.98 * seen[e][0]]
    return chosen + sorted(set(sure) - set(chosen))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    label_rows: int = 20_000,
    precision: float = 0.8,
    least: int = 5,
) -> ToxicityModel:
    """Character model from all ``docs``; lexicon from about ``label_rows`` labelled ones.

    ``labels`` holds the rows that may be learnt from. Above the bound an even share of
    them, chosen by a hash of the key, is used; so the join, the lexicon and the driver see
    bounded data. Rows with a null key or label are ignored, a repeated key takes its
    largest label. Repeated texts count once. Without labels the lexicon stays empty.
    """
    logs = trigram_logs(character_counts(docs, text))
    usable = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key).agg(F.max(label).alias("_toxic"))
    n = usable.count()
    share = min(1.0, label_rows / max(n, 1))
    picked = usable.where(F.pmod(F.xxhash64(key), F.lit(1 << 20)) < F.lit(share * (1 << 20)))
    restorer = Restorer(logs)

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, str] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                part = batch.slice(start, _ROWS)
                found = [sorted(restorer.words(t, known)) for t in part.column(1).to_pylist()]
                if len(known) > _KNOWN_TOKENS:
                    known.clear()
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(found, pa.list_(pa.string()))], ["toxic", "text_key", "words"])

    # about label_rows pairs of numbers, whatever the input
    rows = docs.join(F.broadcast(picked), key).select(
        F.col("_toxic").cast("int").alias("toxic"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.xxhash64(text).alias("text_key")
    )
    sample = stage(rows.mapInArrow(tidy(tokens), "toxic int, text_key long, words array<string>"), "toxicity-sample")
    once = sample.groupBy("text_key").agg(F.max("toxic").alias("toxic"), F.first("words").alias("words"))

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every: Counter[str] = Counter()
        bad: Counter[str] = Counter()
        for batch in batches:
            for toxic, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                entries = {entry for word in words for entry in features(word)}
                every.update(entries)
                if toxic:
                    bad.update(entries)
        names = list(every)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([every[e] for e in names], pa.int64()), pa.array([bad[e] for e in names], pa.int64())],
            ["entry", "n", "bad"],
        )

    tallies = once.select("toxic", "words").mapInArrow(tidy(counts), "entry string, n long, bad long")
    strong = (
        tallies.groupBy("entry").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        .where((F.col("bad") >= least) & (F.col("bad") >= precision * F.col("n")))
    )
    seen = {r["entry"]: (r["n"], r["bad"]) for r in strong.collect()}
    toxic = [
        (_signature(r["words"]), {entry for word in r["words"] for entry in features(word) if entry in seen})
        for r in once.where("toxic > 0").select("words").toLocalIterator()
    ]
    chosen = _cover(toxic, seen, least)
    documents, bad = once.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    explained = sum(1 for _, entries in toxic if entries & set(chosen))
    base = (bad - explained + 1) / (documents - explained + 2)
    return ToxicityModel(logs, {e: (seen[e][1] + 1) / (seen[e][0] + 2) for e in chosen}, min(base, 0.49) if chosen else base)


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", carry: tuple[str, ...] | None = None) -> DataFrame:
    """Score every whole text in one pass without a shuffle.

    Columns: ``record`` (struct of the ``carry`` columns, default all), ``score`` in 0..1
    (each lexicon entry found makes the document toxic with its own probability) and
    ``evidence`` (the entries found). Null and empty texts have no evidence and get the base
    share. Rows are scored one by one, so ties and repeated rows get equal scores.
    """
    rows = docs.select(F.struct(*[F.col(c) for c in (carry or docs.columns)]).alias("record"), F.col(text).alias("text"))
    schema = T.StructType(
        [rows.schema.fields[0], T.StructField("score", T.DoubleType()), T.StructField("evidence", T.ArrayType(T.StringType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, weights = Restorer(model.logs), model.weights
        known: dict[str, list[str]] = {}

        def entries(word: str) -> list[str]:
            return [e for e in features(word) if e in weights]

        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                part = batch.slice(start, _ROWS)
                scores, evidence = [], []
                for value in part.column(1).to_pylist():
                    low = (value or "").lower()
                    found: set[str] = set()
                    for token in set(low.split()):
                        hit = known.get(token)
                        if hit is None:
                            hit = known[token] = entries(restorer.restore(token))
                        if hit:
                            found.update(hit)
                    for gap in spaced_runs(low):
                        for word in restorer.decode_spaced(gap):
                            found.update(entries(word))
                    clean = math.log1p(-model.base) + sum(math.log1p(-weights[e]) for e in sorted(found))
                    scores.append(-math.expm1(clean))
                    evidence.append(sorted(found))
                if len(known) > _KNOWN_TOKENS:
                    known.clear()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(scores, pa.float64()), pa.array(evidence, pa.list_(pa.string()))], ["record", "score", "evidence"]
                )

    return rows.mapInArrow(tidy(run), schema)
