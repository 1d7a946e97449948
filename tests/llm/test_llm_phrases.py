import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from renown.llm import collocations, queries
from renown.llm.superkmers import to_blob
from workload.check import compare

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, top, least):
    count: dict[str, Counter] = {}
    for lang, text in rows:
        own = count.setdefault(lang or "und", Counter())
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            own.update(tuple(words[i : i + m]) for m in range(1, 5) for i in range(len(words) - m + 1))
    out = []
    for lang, f in count.items():
        n = sum(a for g, a in f.items() if len(g) == 1)
        wanted = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        most: dict[tuple, int] = {}
        for g, a in wanted.items():
            for s in range(2, len(g)):
                for i in range(len(g) - s + 1):
                    most[g[i : i + s]] = max(most.get(g[i : i + s], 0), a)
        found = []
        for g, a in wanted.items():
            if 100 * most.get(g, 0) >= 80 * a:
                continue
            score, k = min((2_000_000 * a // (f[g[:k]] + f[g[k:]]), k) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def prose(seed, n):
    """Skewed words with phrases of their own, some inside longer ones, in three languages."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["É", "the", "of", "a\x0bb"]
    weight = [1 / (i + 1) for i in range(len(words))]
    fixed = [[rng.choice(words) for _ in range(rng.randint(2, 5))] for _ in range(25)] + [["new", "york", "city"], ["x1", "x2"]]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 30)):
            parts += rng.choice(fixed) if rng.random() < 0.3 else rng.choices(words, weight)
            parts.append(rng.choice(["", "", "", "", ".", "!", "\n", "\t", "?;"]))
        text = " ".join(parts)
        rows.append((rng.choice(["en", "en", "de", None]), text.upper() if rng.random() < 0.1 else text))
    return [*rows, ("en", None), ("fr", ""), ("fr", "too rare to count"), (None, " \t .,")]


def result(spark, rows, **options):
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    return sorted(map(tuple, collocations.collocations(docs, **options).collect()))


def test_phrases_match_brute_force_over_chunks_and_batches(spark):
    rows = prose(1, 500)
    assert result(spark, rows, least=6, chunk_bytes=8000) == brute(rows, 2000, 6)
    # a line so high that it has to be lowered again and again
    assert result(spark, rows, top=12, least=6, chunk_bytes=20_000, growth=2) == brute(rows, 12, 6)


def test_phrases_that_only_a_lower_line_finds(spark):
    """Pairs at the top are all covered by longer phrases, so the first line settles nothing."""
    rng = random.Random(3)
    long = [[f"l{k}a", f"l{k}b", f"l{k}c", f"l{k}d", f"l{k}e"] for k in range(30)]
    rows = [("en", " ".join(rng.choice(long))) for _ in range(900)] + [("en", f"common w{rng.randint(0, 9)}") for _ in range(2000)]
    assert result(spark, rows, top=20, least=10, growth=2) == brute(rows, 20, 10)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r["lang"], r["text"]) for r in odd_docs.collect()]
    clash = odd_docs.selectExpr("*", "1 as chunk", "2 as key", "3 as n", "4 as a", "5 as score", "6 as rank")
    assert sorted(map(tuple, collocations.collocations(clash, least=2).collect())) == brute(rows, 2000, 2)
    assert collocations.collocations(no_docs).count() == 0


def test_ratio_is_exact_beyond_64_bits(spark):
    a, l, r = 7_000_000_000_000_003, 7_000_000_000_000_019, 9_000_000_000_000_001
    df = spark.createDataFrame([(a, l, r)], "a long, l long, r long")
    assert df.select(collocations._ratio(df.a, df.l, df.r)).first()[0] == 2_000_000 * a // (l + r)


def test_grown_joins_neighbours():
    places = np.array([0, 1, 0, 1, -1, 1, 0])
    longer, left, right, n = collocations.grown(places, (places[:-1] >= 0) & (places[1:] >= 0), 2)
    assert longer.tolist() == [0, 1, 0, -1, -1, 1]
    assert list(zip(left.tolist(), right.tolist(), n.tolist())) == [(0, 1, 2), (1, 0, 2)]


def test_what_travels_is_small_and_whole():
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{k}" for k in rng.zipf(1.3, 20_000) % 30_000).encode() for _ in range(4)]
    row = collocations._numbered(0, "en", texts).to_pylist()[0]
    places, words = collocations._placed(row["places"]), collocations._grams(row["grams"])
    assert [words.column("key")[int(p)].as_py() for p in places if p >= 0] == b" ".join(texts).split()
    assert len(row["places"]) < 1.7 * len(places)
    left = np.sort(rng.integers(0, 1 << 40, 50_000))
    table = collocations._phrases(left, left[::-1], np.ones(50_000, np.int64), left % 7, left % 2_000_000)
    back = collocations._grams(to_blob(table))
    assert all((back.column(c).to_numpy() == x).all() for c, x in (("left", left), ("right", left[::-1]), ("n", 1), ("pb", left % 7), ("sb", left % 2_000_000)))
    batch = pa.table({"lang": ["en"], "chunk": [0], "grams": [to_blob(table)]}).to_batches()[0]
    sent = list(collocations._prints(2)(iter([batch])))
    assert sum(len(b) for x in sent for b in x.column("blob").to_pylist()) < 2.2 * 50_000


def test_an_empty_chunk_travels():
    row = collocations._numbered(0, "en", [b""]).to_pylist()[0]
    assert len(collocations._placed(row["places"])) == 0 and collocations._grams(row["grams"]).num_rows == 0
    none = np.empty(0, np.int64)
    assert collocations._grams(to_blob(collocations._phrases(none, none, none, none, none))).num_rows == 0


def test_query_matches_sql(spark, tables):
    assert compare(queries.QUERIES["op12_collocations"](spark, tables), tables, queries.ORACLES["op12_collocations"]) == ""
