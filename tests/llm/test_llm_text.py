import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from renown.llm import attention_lm, queries, spaced_seeds, token_prefix, toxicity

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
PATH = str(public.path("word_bpe_49k.json"))


# token counts


@pytest.fixture(scope="module")
def library():
    tokenizer = tokenizers.Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_prefix_counts_equal_the_library(library):
    counts = token_prefix.counter(PATH)
    rng = random.Random(4)
    letters = "abcdeéÀİßΣσ漢字한글'’stT1२½ \t\n\x0b\x1c\x1f\x85\xa0　-_.,!?#@<|>😀ّ́"
    for i in range(1500):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        if i % 3 == 0:
            text += rng.choice(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>"]) + text[:5]
        _, tokens = counts.prefixes(text)
        assert (int(tokens[-1]) if len(tokens) else 0) == library(text), text
    for word in ("thndhainonsh", "unbelievably", "éçmentelle"):
        assert counts.within(word) == [library(word[:k]) for k in range(len(word) + 1)]


def test_budgets_are_answered_without_encoding(library):
    counts = token_prefix.counter(PATH)
    text = "The unbelievably longwinded thndhainonsh, 42 times; ok"
    dense = "".join(text.split())
    for budget in range(library(text) + 2):
        fits = token_prefix.fits(counts, text, budget)
        # the same characters of the text, with its white space
        cut, seen = "", 0
        for char in text:
            if not char.isspace():
                if seen == fits:
                    break
                seen += 1
            cut += char
        assert library(cut) <= budget and (fits == len(dense) or budget < library(text))


def test_token_columns(odd_docs, no_docs, library):
    clash = odd_docs.withColumn("tokens", F.lit(1)).withColumn("record", F.lit("x"))
    rows = token_prefix.count_tokens(clash, PATH).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        text = r["record"]["text"] or ""
        assert (r["n_bytes"], r["n_tokens"]) == (len(text.encode()), library(text))
        assert (r["tokens"][-1] if r["tokens"] else 0) == r["n_tokens"] and len(r["ends"]) == len(r["tokens"])
    assert token_prefix.count_tokens(no_docs, PATH).count() == 0


def test_token_query(spark, tables, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    rows = queries.op10_token_counts(spark, tables).collect()
    want = {k: (len(t.encode()), library(t), library(t) > 2048) for k, t in texts.items()}
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows} == want


# toxicity


@pytest.fixture(scope="module")
def insults(spark):
    """Clean filler, and documents with one of two insults; the second one is inflected."""
    rng = random.Random(6)
    parts = ["to", "re", "in", "ma", "lo", "ne", "ti", "sa", "der", "un", "ka", "pel", "or", "vi"]
    filler = [a + b + c for a in parts for b in parts for c in ("", "ra", "lin")]
    rows, labels = [], []
    for i in range(600):
        words = [rng.choice(filler) for _ in range(30)]
        bad = i % 6 == 0
        if bad:
            words[rng.randrange(30)] = "grobian" if i % 12 == 0 else "schuft" + rng.choice(["ig", "en", "erei", "s"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    # copies of one toxic text carry rare words along
    rows += [(1000 + i, "grobian zufallswort nebenbei " + " ".join(filler[:60])) for i in range(30)]
    labels += [(1000 + i, 1) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int")
    return docs, labels, toxicity.fit(docs, labels)


def test_lexicon_holds_insults_only(insults):
    *_, model = insults
    assert {e.rstrip("*")[:4] for e in model.weights} == {"grob", "schu"}


def test_disguises_are_seen_through(spark, insults):
    docs, _, model = insults
    shown = ["grobian", "GROBIAN!!", "gr0bian", "g.r.o.b.i.a.n", "g r o b i a n", "grooobiaaan", "$chuftig", "schuft3n"]
    clean = ["tolo rene", "", None, "1234 5678", "a b c d e f", "&&& %%% $$$", "x" * 5000]
    df = spark.createDataFrame([(i, t if t is None else f"tolo {t} reti" if t in shown else t) for i, t in enumerate(shown + clean)],
                               "doc_id long, text string")
    scores = {r["record"]["doc_id"]: r["score"] for r in toxicity.score(df, model).collect()}
    assert not [shown[i] for i in range(len(shown)) if scores[i] < 0.5]
    assert all(0 <= scores[i] < 0.5 for i in range(len(shown), len(shown) + len(clean))), scores


def test_spaced_insults_beside_marks_and_words_are_seen_through(spark, insults):
    _, _, model = insults
    shown = ["g r o b i a n.", "g r o b i a n!", '"g r o b i a n', "g  r  o\nb i a n", "a g r o b i a n", "such a g r 0 b i a n.", "g r o b i a n s c h u f t e n"]
    clean = ["a b c d e f", "a . b , c", "1 2 3 4", "x"]
    df = spark.createDataFrame(list(enumerate(shown + clean)), "doc_id long, text string")
    scores = {r["record"]["doc_id"]: r["score"] for r in toxicity.score(df, model).collect()}
    assert not [shown[i] for i in range(len(shown)) if scores[i] < 0.5]
    assert all(scores[i] < 0.5 for i in range(len(shown), len(shown) + len(clean)))


def test_toxicity_of_odd_rows(odd_docs, no_docs, insults):
    _, labels, model = insults
    clash = odd_docs.withColumn("score", F.lit("x")).withColumn("record", F.lit(1)).withColumn("evidence", F.lit(1))
    rows = toxicity.score(clash, model).collect()
    assert len(rows) == odd_docs.count() and all(r["score"] < 0.5 for r in rows)
    assert toxicity.score(no_docs, model).count() == 0
    nothing = toxicity.fit(no_docs, labels.limit(0))
    assert nothing.weights == {} and toxicity.score(odd_docs, nothing).count() == len(rows)


def test_held_out_accuracy(spark, tables):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{tables.replace('sf0.001', 'sf0.01')}/labels.parquet").collect()}
    rows = queries.op6_toxicity(spark, tables.replace("sf0.001", "sf0.01")).collect()
    judged = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and labels.get(r["doc_id"]) is not None]
    assert sum(p == t for p, t in judged) / len(judged) > 0.95
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)


# decontamination


def test_masks_find_every_window_with_two_substitutions():
    for i in range(spaced_seeds.WINDOW):
        for j in range(i):
            assert any(
                not {i, j} & {shift + p for p in mask}
                for mask in spaced_seeds.MASKS for shift in range(spaced_seeds.WINDOW - mask[-1])
            )


def test_items_are_found_with_substitutions(spark, no_docs):
    rng = random.Random(8)
    words = [f"t{i}" for i in range(2000)]
    item = [rng.choice(words) for _ in range(30)]
    short = ["seven", "words", "only", "here", "and", "no", "more"]

    def changed(source, *places):
        return [("other" if k in places else w) for k, w in enumerate(source)]

    cases = {
        1: item, 2: changed(item, 5, 17, 29), 3: changed(item, *range(0, 30, 4)), 4: item[:12], 5: item[:9],
        6: short, 7: changed(short, 3), 8: [w.upper() + "!!" for w in item], 9: changed(item[:12], 0, 11), 10: changed(item[:12], 0, 5, 11),
    }
    rows = [(k, " ".join(["lead", *w, "tail"]), "x") for k, w in cases.items()] + [(20, None, "x"), (21, "", "x"), (1, " ".join(item), "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hits string")
    tests = [(7, " ".join(item)), (8, " ".join(short)), (9, None), (10, ""), (7, " ".join(item))]
    benchmark = spark.createDataFrame(tests, "item_id long, text string")

    def found(**options):
        rows = spaced_seeds.contamination(docs, benchmark, **options).collect()
        assert len(rows) == docs.count()
        return Counter((r["record"]["doc_id"], h["item_id"], h["n_words"], h["first_word"]) for r in rows for h in r["hits"])

    got = found()
    assert {(k, i) for k, i, *_ in got} == {(1, 7), (2, 7), (4, 7), (6, 8), (8, 7), (9, 7)}
    assert got[(1, 7, 30, 1)] == 2 and got[(1, 7, 30, 0)] == 2  # the item stands twice in the benchmark
    assert got[(4, 7, 13, 1)] == 2 and got[(6, 8, 7, 1)] == 1
    assert found(slice_bytes=60) == got  # several passes, the same hits
    assert spaced_seeds.contamination(no_docs, benchmark).count() == 0
    assert all(not r["hits"] for r in spaced_seeds.contamination(docs, benchmark.limit(0)).collect())


# language model


def test_window_positions_cover_every_token_once():
    rng = random.Random(2)
    lengths = [1, 2, 31, 32, 33, 55, 56, 57, 200] + [rng.randint(1, 300) for _ in range(40)]
    start = np.concatenate([[0], np.cumsum(lengths)])
    places = attention_lm.Positions(*([np.zeros(start[-1], np.int64)] * 3), start, np.zeros(start[-1], np.int64))
    seen = np.concatenate([place[scored] for place, scored in attention_lm.batches_of(places)])
    assert sorted(seen.tolist()) == list(range(start[-1]))


def test_attention_is_causal_and_its_gradient_right():
    rng = np.random.default_rng(1)
    size = sum(int(np.prod(s)) for s in attention_lm._SHAPES.values())
    weights = rng.standard_normal(size) * 0.3
    first, last = (rng.integers(0, attention_lm.INPUTS, (3, attention_lm.WIDTH)) for _ in range(2))
    target = rng.integers(0, attention_lm.CLASSES, (3, attention_lm.WIDTH))
    counted = rng.random((3, attention_lm.WIDTH)) < 0.7
    logits = attention_lm.forward(attention_lm.unflat(weights), first, last)["logits"].reshape(3, attention_lm.WIDTH, -1)
    later = first.copy()
    later[:, 20:] = 7
    assert np.allclose(attention_lm.forward(attention_lm.unflat(weights), later, last)["logits"].reshape(logits.shape)[:, :20], logits[:, :20])

    def loss(w):
        found = attention_lm.log_shares(attention_lm.forward(attention_lm.unflat(w), first, last)["logits"], target.ravel())
        return -found[counted.ravel()].sum() / counted.sum()

    grad = attention_lm.gradient(attention_lm.unflat(weights), first, last, target, counted)
    used = np.flatnonzero(np.abs(grad) > 1e-4)
    for at in rng.choice(used, 40, replace=False):
        step = np.zeros(size)
        step[at] = 1e-5
        assert (loss(weights + step) - loss(weights - step)) / 2e-5 == pytest.approx(grad[at], rel=2e-3, abs=1e-6)


def test_attention_sees_all_of_its_window_and_nothing_later():
    rng = np.random.default_rng(3)
    width, cut = attention_lm.WIDTH, attention_lm.WIDTH // 2
    w = attention_lm.unflat(rng.standard_normal(sum(int(np.prod(s)) for s in attention_lm._SHAPES.values())) * 0.3)
    first, last = (rng.integers(8, attention_lm.INPUTS, (3, width)) for _ in range(2))

    def moved(*places):
        other = first.copy()
        other[:, places] = 7
        before, after = (attention_lm.forward(w, ids, last)["logits"].reshape(3, width, -1) for ids in (first, other))
        return ~np.isclose(before, after, rtol=0, atol=1e-9).all((0, 2))

    assert moved(*range(cut, width)).tolist() == [k >= cut for k in range(width)]
    # the cut at 20 of the test above lies inside the window, and the first token reaches a position 24 later
    assert moved(*range(20, width))[20:].any() and moved(0)[24:].any()


def some_counts(width=1500):
    """Counts of first units, most of them never seen, and no later units."""
    rng = np.random.default_rng(4)
    unit = np.arange(0, width - 1, 3)
    n = rng.integers(1, 50, len(unit))
    once = unit[n == 1]
    code, sums = np.concatenate([unit, width + once, 2 * width + unit]), np.concatenate([n, np.ones(len(once), int), np.ones(len(unit), int)])
    return attention_lm.Counts.of(code, sums, width, int(n.sum()) + 9, len(unit) + 1, 9)


def test_first_units_share_all_probability():
    counts = some_counts()
    width = len(counts.klass)
    w = attention_lm.initial(counts)
    w["fine"] += np.random.default_rng(5).standard_normal(w["fine"].shape)
    assert len(w["first"]) > width  # no two units share an input row
    ids = np.random.default_rng(6).integers(0, len(w["first"]), (1, attention_lm.WIDTH))
    f = attention_lm.forward(w, ids, ids)
    for place in (0, attention_lm.WIDTH - 1):
        logits, hidden = np.repeat(f["logits"][place][None], width, 0), np.repeat(f["hidden"].reshape(-1, attention_lm.DIMS)[place][None], width, 0)
        logs = attention_lm.log_shares(logits, counts.klass)
        logs = logs + attention_lm.fine_shares(w, counts.block, hidden, counts.klass, counts.slot, np.ones(width, bool))
        assert (10.0 ** (logs / np.log(10) + counts.first)).sum() == pytest.approx(1, abs=1e-4)


def test_gradient_of_the_second_level():
    counts, rng = some_counts(), np.random.default_rng(7)
    w = {k: x.astype(float) for k, x in attention_lm.initial(counts).items()}
    w["fine"] += rng.standard_normal(w["fine"].shape)
    shape = (3, attention_lm.WIDTH)
    first, last = (rng.integers(0, 40, shape) for _ in range(2))
    unit = rng.integers(0, len(counts.klass), shape)
    target, slot, counted = counts.klass[unit], counts.slot[unit], rng.random(shape) < 0.7

    def loss():
        f = attention_lm.forward(w, first, last)
        logs = attention_lm.log_shares(f["logits"], target.ravel())
        logs = logs + attention_lm.fine_shares(w, counts.block, f["hidden"].reshape(-1, attention_lm.DIMS), target.ravel(), slot.ravel(), counted.ravel())
        return -logs[counted.ravel()].sum() / counted.sum()

    grads = attention_lm.gradients(w, first, last, target, counted, slot, counts.block)
    for name in ("fine", "level", "mix", "out", "first"):
        grad = grads[name]
        if name == "first":
            grad = np.zeros_like(w[name])
            grad[grads[name][0]] = grads[name][1]
        for at in rng.choice(np.flatnonzero(np.abs(grad) > 1e-4), 5):
            found = []
            for step in (1e-5, -2e-5):
                w[name].ravel()[at] += step
                found.append(loss())
            w[name].ravel()[at] += 1e-5
            assert (found[0] - found[1]) / 2e-5 == pytest.approx(grad.ravel()[at], rel=2e-3, abs=1e-6)


def test_second_level_equals_class_by_class_however_uneven():
    """A class with most of the positions, classes with none and classes of different lengths."""
    rng = np.random.default_rng(8)
    block = np.concatenate([[0, 0], np.cumsum([3, 1, 7, 4])])
    w = {"fine": rng.standard_normal((15, attention_lm.DIMS)), "level": rng.standard_normal(15)}
    target = np.array([1] * 40 + [4] * 3 + [0] * 5 + [3] * 9)
    slot = np.where(target > 0, block[target] + rng.integers(0, 99, len(target)) % np.maximum(1, np.diff(block)[target]), -1)
    hidden, counted = rng.standard_normal((len(target), attention_lm.DIMS)), rng.random(len(target)) < 0.8
    for one_counted in (counted, np.zeros(len(target), bool)):
        expected = np.zeros(len(target))
        for i in np.flatnonzero(one_counted & (slot >= 0)):
            low, high = block[target[i]], block[target[i] + 1]
            logits = w["fine"][low:high] @ hidden[i] + w["level"][low:high]
            expected[i] = logits[slot[i] - low] - np.log(np.exp(logits).sum())
        assert np.allclose(attention_lm.fine_shares(w, block, hidden, target, slot, one_counted), expected)
    lanes = attention_lm.Lanes.of(target, slot, block)
    assert lanes.laid(hidden).reshape(-1, attention_lm.DIMS)[lanes.cell].tolist() == hidden[lanes.at].tolist()
    sums = [hidden[target == c].sum(0) for c in (1, 3, 4)]
    assert np.allclose(lanes.by_class(lanes.laid(hidden).sum(1)), sums)


def test_masked_attention_is_nothing_and_only_asked_positions_get_logits():
    """Weights next to nothing give denormal products, on which a step took twice as long."""
    rng = np.random.default_rng(9)
    w = attention_lm.unflat(rng.standard_normal(sum(int(np.prod(s)) for s in attention_lm._SHAPES.values())) * 0.3)
    first, last = (rng.integers(0, attention_lm.INPUTS, (3, attention_lm.WIDTH)) for _ in range(2))
    whole, at = attention_lm.forward(w, first, last), np.array([0, 5, 40, 95])
    assert not whole["seen"][:, ~attention_lm._CAUSAL].any()
    some = attention_lm.forward(w, first, last, at)
    assert np.allclose(some["logits"], whole["logits"][at]) and len(some["logits"]) == 4


def test_every_token_is_trained_on(monkeypatch):
    seen = []
    monkeypatch.setattr(attention_lm.Adam, "step", lambda self, grads: None)
    monkeypatch.setattr(attention_lm, "gradients", lambda w, first, last, target, counted, *rest: seen.append(int(counted.sum())))
    start = np.concatenate([[0], np.cumsum([101] * 40)])
    p = attention_lm.Positions(*([np.zeros(start[-1], np.int64)] * 3), start, *([np.zeros(start[-1], np.int64)] * 2))
    monkeypatch.setattr(attention_lm, "_opened", lambda *a: [(None, None, None, p)])
    list(attention_lm._train(some_counts(), attention_lm.initial(some_counts()), 0, 7, 2)(iter([])))
    assert sum(seen) == start[-1]


def brute_base(rows):
    split = [(k, (t or "").encode().lower().split() + [None]) for k, t in rows]
    trained = lambda k: zlib.crc32(b"" if k is None else str(k).encode()) % 7 != 2
    count = Counter(w for k, words in split if trained(k) for w in words)
    n, v = sum(count.values()), len(count)
    return Counter(
        (k, not trained(k), len(w), sum(count[x] > 0 for x in w), n, round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), 6))
        for k, w in split
    )


def scored(df, **options):
    rows = attention_lm.score_texts(df, PATH, **options).collect()
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in rows)
    return Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows)


def test_scores_of_odd_rows(odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    clash = odd_docs.withColumn("key", F.lit(1)).withColumn("word", F.lit("x")).withColumn("score", F.lit("y"))
    assert scored(clash, chunk_bytes=20_000) == scored(clash) == brute_base(rows)
    assert scored(no_docs) == Counter()
    assert scored(odd_docs.where("doc_id = 1").withColumn("doc_id", F.lit(1))) == Counter(
        {next(iter(brute_base([(1, rows[0][1])]))): 1}
    )


def test_model_beats_unigrams_on_texts_it_has_not_seen(spark, tables):
    rows = queries.op5_language_model(spark, tables).where("held_out and n_known = n_tokens").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)
