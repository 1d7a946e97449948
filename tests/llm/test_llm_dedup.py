import hashlib
import math
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from renown.llm import queries, setsketch, substring_dedup, suffix_dedup
from renown.llm.components import components
from renown.llm.superkmers import byte_runs, to_blob


def sequence(rng, n, alphabet):
    return " ".join(rng.choice(alphabet) for _ in range(n))


def copied_docs(spark, seed=1):
    """Texts that share passages with each other and repeat themselves."""
    rng = random.Random(seed)
    alphabet = [f"{a}{b}" for a in "abcdefgh" for b in "xyzé"]
    passages = [sequence(rng, 40, alphabet) for _ in range(4)]
    rows = []
    for i in range(60):
        parts = [sequence(rng, rng.randint(0, 60), alphabet)]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(passages), sequence(rng, rng.randint(0, 20), alphabet)]
        rows.append((i, rng.choice(["  ", "\n", " "]).join(parts)))
    rows += [(100 + i, "periodic " * 80) for i in range(2)] + [(200, "ab" * 700), (201, "\x00" * 450)]
    return spark.createDataFrame(rows, "doc_id long, text string"), rows


def last(key):
    return 1 << 62 if key is None else key


def brute_words(rows, k=13):
    split = [(key, (text or "").encode().split()) for key, text in rows]
    least = {}
    for key, words in split:
        for i in range(len(words) - k + 1):
            window = tuple(words[i : i + k])
            least[window] = min(least.get(window, 1 << 63), last(key))
    out = []
    for key, words in split:
        gone = set()
        for i in range(len(words) - k + 1):
            if least[tuple(words[i : i + k])] < last(key):
                gone.update(range(i, i + k))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((key, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def brute_bytes(rows, k=200):
    raw = [(key, (text or "").encode()) for key, text in rows]
    count = Counter(b[i : i + k] for _, b in raw for i in range(len(b) - k + 1))
    out = []
    for key, b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - k + 1):
            if count[b[i : i + k]] > 1:
                gone[i : i + k] = True
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((key, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def words_result(df, **options):
    kept = substring_dedup.remove_repeats(df, **options)
    return Counter((r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in kept.collect())


def bytes_result(df, **options):
    kept = suffix_dedup.remove_repeats(df, **options)
    return Counter((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest()) for r in kept.collect())


def test_word_windows_against_brute_force(spark, odd_docs, no_docs):
    docs, rows = copied_docs(spark)
    assert words_result(docs, chunk_bytes=4000) == words_result(docs) == brute_words(rows)
    clash = odd_docs.withColumn("key", F.lit(1)).withColumn("chunk", F.lit("x")).withColumn("blob", F.lit("y"))
    assert words_result(clash, chunk_bytes=1000) == brute_words(pairs(odd_docs))
    assert words_result(no_docs) == Counter()


def test_byte_strings_against_brute_force(spark, odd_docs, no_docs):
    docs, rows = copied_docs(spark)
    assert bytes_result(docs, chunk_bytes=4000) == bytes_result(docs) == brute_bytes(rows)
    assert bytes_result(odd_docs, chunk_bytes=1000) == brute_bytes(pairs(odd_docs))
    assert bytes_result(no_docs) == Counter()


def test_first_copy_can_stay(spark):
    docs, rows = copied_docs(spark)
    count, owner = defaultdict(int), {}
    raw = [(k, t.encode()) for k, t in rows]
    for key, b in raw:
        for i in range(len(b) - 199):
            owner.setdefault(b[i : i + 200], (key, i))
            count[b[i : i + 200]] += 1
    for r in suffix_dedup.remove_repeats(docs, keep_first=True, chunk_bytes=4000).collect():
        b, gone = dict(raw)[r["doc_id"]], set()
        for i in range(len(b) - 199):
            if owner[b[i : i + 200]] != (r["doc_id"], i):
                gone.update(range(i, i + 200))
        assert r["n_removed"] == len(gone)


def brute_components(rows, n, percent):
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), 1 << 62), last(key))
    return Counter((key, len(sets[i]), None if least[root(i)] == 1 << 62 else least[root(i)]) for i, (key, _) in enumerate(rows))


def near_result(df, n, percent):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in setsketch.near_duplicates(df, n=n, percent=percent).collect())


def test_near_copies_in_a_continuum(spark, odd_docs, no_docs):
    """Edits of one text, so many pairs lie just below and above the limit and heads of bands miss links."""
    rng = random.Random(3)
    base = [f"v{rng.randint(0, 400)}" for _ in range(120)]
    rows = []
    for i in range(420):
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 6])):
            words[rng.randrange(len(words))] = f"u{rng.randint(0, 9)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert near_result(docs, 3, 85) == brute_components(rows, 3, 85)
    assert near_result(odd_docs, 5, 80) == brute_components(pairs(odd_docs), 5, 80)
    assert near_result(no_docs, 5, 80) == Counter()


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(0)
    a, b = (rng.integers(0, 1 << 63, 4000, dtype=np.uint64) for _ in range(2))
    left, right = np.concatenate([a, b[:1000]]), np.concatenate([a, b[1000:2000]])
    x, y = setsketch.registers(left), setsketch.registers(right)
    assert (setsketch.merge(x, y) == setsketch.registers(np.unique(np.concatenate([left, right])))).all()
    found = setsketch.similarity(np.array([(x > y).sum()]), np.array([(x < y).sum()]), np.array([5000.0]), np.array([5000.0]))
    assert abs(found[0] - 4000 / 6000) < 0.15


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(90, 91), (91, 90), (95, 95)], "a long, b long")
    found = {r["node"]: r["component"] for r in components(links).collect()}
    assert found == {**{i: 0 for i in range(51)}, 90: 90, 91: 90}


def test_suffix_query(spark, tables):
    rows = pairs(spark.read.parquet(f"{tables}/documents.parquet"))
    assert Counter(tuple(r) for r in queries.op3_suffix_dedup(spark, tables).collect()) == brute_bytes(rows)


def test_estimates_lose_no_more_pairs_than_stated():
    for limit, most in ((0.85, 1e-9), (0.8, 1e-8)):
        low = (limit - setsketch.MARGIN) * setsketch.REGISTERS
        lost = sum(math.comb(128, k) * limit**k * (1 - limit) ** (128 - k) for k in range(129) if k < low)
        assert setsketch.REGISTERS == 128 and lost < most


def structured_words(n=1024):
    """Two different words that polynomial hashes modulo a power of two can't tell apart."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_structured_words_are_not_taken_for_each_other(spark):
    one, two = structured_words()
    fill = [f"w{i}" for i in range(12)]
    rows = [(1, " ".join([one, *fill])), (2, " ".join([two, *fill]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for parts in (1, 2):
        kept = substring_dedup.remove_repeats(docs.repartition(parts, "doc_id")).collect()
        assert [r["n_removed"] for r in kept] == [0, 0]
    close = [(1, f"{one} x y z"), (2, f"{two} x y z")]
    found = setsketch.near_duplicates(spark.createDataFrame(close, "doc_id long, text string"), n=3, percent=40).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {1: 1, 2: 2}


def test_equal_windows_keep_their_lead_where_places_turn():
    """A passage with equal short stretches lies once early and once across place 2**20 of a piece."""
    rng = np.random.default_rng(5)
    raw = rng.integers(97, 123, (1 << 20) + 4000, dtype=np.uint8)
    passage = np.tile(rng.integers(97, 123, 80, dtype=np.uint8), 5)
    copies = [1000, *((1 << 20) - far for far in (90, 150, 210, 270, 330))]
    for at in copies[1:]:
        raw[1000:1400] = raw[at : at + 400] = passage
        runs = byte_runs([raw.tobytes()], 200, 32)
        window = np.concatenate([runs.first[i] + np.arange(runs.windows[i]) for i in range(len(runs.first)) if runs.first[i] < 2000 or runs.first[i] > (1 << 20) - 1000])
        run = np.searchsorted(runs.first, window, "right") - 1
        known = dict(zip(window.tolist(), zip((runs.lead[run] - (window - runs.first[run])).tolist(), runs.minimiser[run].tolist())))
        assert [known[1000 + i] for i in range(201)] == [known[at + i] for i in range(201)]


def test_a_crowd_under_one_minimiser_is_matched_in_little_memory():
    """Strings that differ on both sides of one minimiser; many share a window, few share all."""
    rng = np.random.default_rng(6)
    centre, n, k = rng.integers(0, 256, 150, dtype=np.uint8).tobytes(), 5000, 200
    sides = [(rng.integers(97, 99, 90, dtype=np.uint8).tobytes(), rng.integers(97, 99, 90, dtype=np.uint8).tobytes()) for _ in range(n)]
    sides += [(sides[i][0], sides[n - 1 - i][1]) for i in range(300)] + sides[:200]
    texts = [a[-(40 + i % 50) :] + centre + b[: 30 + i % 30] for i, (a, b) in enumerate(sides)]
    lead = np.array([min(len(a), 40 + i % 50) for i, (a, _) in enumerate(sides)]) + 10
    names = {t: i for i, t in enumerate(dict.fromkeys(texts))}
    name, rows = np.array([names[t] for t in texts]), np.arange(len(texts))
    columns = {"bucket": rows * 0, "chunk": rows % 7, "name": name, "value": rows * 0 + 5, "lead": lead, "key": rows, "place": rows * 0, "copies": rows * 0 + 1, "text": texts}
    table = pa.table([pa.array(c) for c in columns.values()], schema=suffix_dedup._STRETCHES)
    windows = sum(len(t) - k + 1 for t in texts)
    assert windows > suffix_dedup._SORTED_WINDOWS
    tracemalloc.start()
    found = suffix_dedup._matched(k, False)(table).to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    count = Counter(t[i : i + k] for t in texts for i in range(len(t) - k + 1))
    expected = {(c, names[t], i) for t, c in zip(texts, (rows % 7).tolist()) for i in range(len(t) - k + 1) if count[t[i : i + k]] > 1}
    assert {(r["chunk"], r["name"], i) for r in found for i in range(r["from"], r["to"])} == expected and len(expected) < windows
    assert peak < 200e6 + 100 * windows


def test_a_chunk_sends_a_row_for_each_stretch_and_none_for_what_repeats_whole(spark):
    """Small chunks have many buckets; what moves must follow the stretches, not chunks times buckets."""
    rng = random.Random(7)
    shared = ["".join(rng.choice("abcdefgh ") for _ in range(500)) for _ in range(3)]
    rows = [(i, "".join(rng.choice("abcdefgh ") for _ in range(300)) + shared[i % 3] + "".join(rng.choice("abcdefgh ") for _ in range(300))) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    blob = to_blob(pa.table([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], ["key", "text"]))
    chunk = pa.record_batch([pa.array([3]), pa.array([blob], pa.binary())], ["chunk", "blob"])
    (counted,) = suffix_dedup._minimisers(200, 32)(iter([chunk]))
    assert 0 < sum(n > 1 for n in counted["strings"].to_pylist()) < sum(n > 1 for n in counted["n"].to_pylist())
    sent = suffix_dedup._packed(pa.Table.from_batches([chunk]), counted["value"].to_numpy(), np.empty(0, np.int64), 200, 32, 1000)
    assert sent.num_rows == len(set(sent["name"].to_pylist())) and sum(sent["copies"].to_pylist()) == sum(counted["n"].to_pylist())
    assert bytes_result(docs, chunk_bytes=1000) == bytes_result(docs) == brute_bytes(rows)


def test_windows_of_crowded_minimisers_travel_one_by_one(spark, odd_docs, monkeypatch):
    docs, rows = copied_docs(spark)
    whole = bytes_result(docs, keep_first=True)
    monkeypatch.setattr(suffix_dedup, "_CROWD", 1)
    assert bytes_result(docs, chunk_bytes=4000) == bytes_result(docs) == brute_bytes(rows)
    assert bytes_result(docs, chunk_bytes=4000, keep_first=True) == bytes_result(docs, keep_first=True) == whole
    assert bytes_result(odd_docs, chunk_bytes=1000) == brute_bytes(pairs(odd_docs))


def test_the_same_strings_in_many_chunks_are_no_crowd(spark):
    kind = [(1, c, -2, 40_000, c) for c in range(4)] + [(2, c, -2, 40_000, 7) for c in range(4)] + [(3, 0, 0, None, None), (4, 0, -1, None, None)]
    often = spark.createDataFrame(kind, "value long, chunk long, kind long, strings long, name long")
    assert {(r["value"], r["kind"]) for r in suffix_dedup._crowded(often).collect()} == {(1, -2), (2, 0), (3, 0), (4, -1)}
