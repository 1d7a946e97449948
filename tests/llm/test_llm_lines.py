import random
from collections import Counter, defaultdict

import numpy as np

from renown.llm import line_dedup, queries
from renown.llm.hashing import byte_hashes
from workload.check import compare

SPACES = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def last(key):
    return 1 << 62 if key is None else key


def brute(rows, least=10):
    holders = defaultdict(set)
    split = [(key, (text or "").split("\n")) for key, text in rows]
    name = lambda line: line.strip(SPACES).translate(LOWER)
    for key, lines in split:
        for line in lines:
            if len(name(line)) >= least:
                holders[name(line)].add(last(key))
    out = []
    for key, lines in split:
        kept = [x for x in lines if min(holders.get(name(x), {last(key)})) == last(key)]
        out.append((key, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


def result(df):
    return Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in df.collect())


def test_lines_match_brute_force_over_many_chunks(spark):
    rng = random.Random(5)
    pool = [f"Common line number {i} é" for i in range(12)] + ["short", "  ", "", "exactly10!", "ninechars"]
    rows = []
    for i in range(300):
        lines = [rng.choice(pool) if rng.random() < 0.4 else f"own {i} {j} {rng.random()}" for j in range(rng.randint(0, 12))]
        lines = [rng.choice(["", "  ", "\t"]) + (x.upper() if rng.random() < 0.2 else x) + rng.choice(["", "\r", " "]) for x in lines]
        rows.append((i, "\n".join(lines)))
    rows += [(None, "Common line number 1 é"), (None, "only in rows without a key"), (7, "Common line number 2 é\n" * 3), (400, None), (401, ""), (402, "\n\n")]
    rows += [(500, "x" * 300_000 + "\n" + "y" * 20), (501, "X" * 300_000)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(line_dedup.remove_repeats(docs)) == brute(rows)
    assert result(line_dedup.remove_repeats(docs, chunk_bytes=20_000)) == brute(rows)


def test_odd_rows_and_extra_columns(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    clash = odd_docs.selectExpr("*", "1 as chunk", "2 as blob", "'x' as line", "3 as slice", "4 as first", "5 as low")
    assert result(line_dedup.remove_repeats(clash)) == brute(rows)
    assert line_dedup.remove_repeats(no_docs).count() == 0


def test_filters_never_miss_a_repeat():
    rng = np.random.default_rng(1)
    filters = line_dedup.Filters(1 << 12)
    prints = rng.integers(0, 1 << 40, 3000).astype(np.uint64)
    for k in range(0, 3000, 300):
        filters.add(prints[k : k + 300], np.zeros(300, bool))
    filters.add(prints[100:200], np.zeros(100, bool))
    filters.add(np.uint64([7]), np.ones(1, bool))
    assert filters.suspects(prints[100:200]).all() and filters.suspects(np.uint64([7])).all()
    calm = line_dedup.Filters()
    calm.add(prints, np.zeros(3000, bool))
    assert not calm.suspects(prints).any()


def test_hashes_tell_structured_words_apart():
    word = np.array([bin(i).count("1") % 2 for i in range(1024)], np.uint8) + 97
    for size in (8, 64, 200, 1024):
        one, two = word[:size], 195 - word[:size]
        raw = np.concatenate([one, two, one])
        a, b, c = byte_hashes(raw, np.array([0, size, 2 * size]), np.array([size, 2 * size, 3 * size]))
        assert a != b and a == c


def test_query_matches_sql(spark, tables):
    df = queries.QUERIES["op11_line_dedup"](spark, tables)
    assert compare(df, tables, queries.ORACLES["op11_line_dedup"]) == ""
