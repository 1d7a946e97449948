import functools
import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from renown.llm import conversation_repair as repair
from renown.llm import queries
from workload.check import compare

SPACE = " \t\n\x0b\x0c\r"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def expected(rows):
    """Summary and repaired lines of one conversation, from (turn, role, text) rows."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
    seen, faults = set(), []
    for _, role, text in rows:
        solid = text.strip(SPACE)
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated")
        seen.add((role, text))
    initials = [r[1][:1] for r in rows]

    @functools.cache
    def best(k, state, inserted=0):
        """Cost and string from row k on; every choice is tried."""
        found = [(0, "")] if k == len(rows) and state in ("", "a") else []
        if inserted < 3:
            cost, string = best(k, NEXT[state], inserted + 1)
            found.append((cost + 3, "I" + string))
        if k < len(rows):
            cost, string = best(k + 1, state)
            found.append((cost + 4, "D" + string))
            if faults[k] in ("", "truncated"):
                more = 3 * (faults[k] == "truncated")
                cost, string = best(k + 1, NEXT[state])
                found.append((cost + 3 + more, "R" + string))
                if initials[k] == NEXT[state] or (initials[k] == "s" and state == ""):
                    cost, string = best(k + 1, initials[k])
                    found.append((cost + more, "K" + string))
        return min(found) if found else (1 << 40, "")

    cost, audit = best(0, "")
    out, k, state = [], 0, ""
    for letter in audit:
        if letter == "I":
            state = NEXT[state]
            out.append(("user" if state == "u" else "assistant") + ":")
            continue
        _, role, text = rows[k]
        k += 1
        if letter == "K":
            state = role[0]
            out.append(f"{role}:{text}")
        elif letter == "R":
            state = NEXT[state]
            out.append(("user" if state == "u" else "assistant") + ":" + text)
    turns = {r[0] for r in rows if r[0] is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit), out


def made(seed, n, longest):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "cut of", "", "  ", None, "What?", "Well. \n", "é …", "Fine . "]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, "", "User", "usher"]
    rows = []
    for conv in [*range(n), None]:
        for turn in range(rng.randint(1, longest)):
            where = rng.choice([turn, turn, turn, turn + rng.randint(0, 3), None])
            rows.append((conv, where, rng.choice(roles[: rng.choice([2, 5, 10])]), rng.choice(texts) if rng.random() < 0.6 else f"Text {turn}{rng.choice(['.', ''])}"))
    return rows


def check(spark, rows, **options):
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    done = repair.repair(turns, **options)
    summary = {r[0]: tuple(r)[1:] for r in done.summary.collect()}
    digests = {r[0]: r[1] for r in repair.digest(done.rows).collect()}
    convs = {r[0] for r in rows}
    assert set(summary) == convs
    for conv in convs:
        want, lines = expected([r[1:] for r in rows if r[0] == conv])
        assert summary[conv] == want, conv
        assert digests.get(conv, hashlib.sha256(b"").hexdigest()) == hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_repair_matches_brute_force(spark):
    check(spark, made(3, 150, 9))


def test_long_conversations_are_cut_into_blocks(spark):
    check(spark, made(4, 12, 70), block_rows=5)


def test_odd_rows(spark):
    schema = "conv_id string, turn int, role string, text string, block string, at string, seq string"
    rows = [(None, None, None, None, "x", "x", "x")] * 3 + [("a", None, "user", "Hi.", "x", "x", "x")] * 2 + [("b", 4, "assistant", "x" * 200_000, None, None, None)]
    done = repair.repair(spark.createDataFrame(rows, schema))
    found = {r["conv_id"]: r for r in done.summary.collect()}
    assert found[None]["audit"] == "DDD" and found[None]["blank"] == 3 and found[None]["gaps"] == 0
    assert found["a"]["audit"] == "KDI" and found["a"]["duplicate"] == 1
    assert found["b"]["audit"] == "D" and found["b"]["truncated"] == 1
    nothing = repair.repair(spark.createDataFrame([], schema))
    assert nothing.summary.count() == 0 and nothing.rows.count() == 0 and repair.digest(nothing.rows).count() == 0


def entries(symbols):
    """All cheapest strings of a sequence for each pair of states, by trying every edit."""
    best = {}
    for inserted in itertools.product(range(4), repeat=len(symbols)):
        for start in range(4):
            stack = [(start, 0, "")]
            for count, symbol in zip(inserted, symbols):
                after = []
                for state, cost, string in stack:
                    for _ in range(count):
                        state = repair._INSERTED[state]
                    after += [(end, cost + 3 * count + c, string + "I" * count + letter) for letter, c, end in repair._edits(symbol, state)]
                stack = after
            for end, cost, string in stack:
                best[start, end] = min(best.get((start, end), (1 << 60, "")), (cost, string))
    return best


@pytest.mark.parametrize("seed", range(4))
def test_rules_give_the_same_strings_in_any_bracketing(seed):
    rng = random.Random(seed)
    symbols = [rng.randrange(repair.TERMINALS) for _ in range(4)]
    grammar = repair.Grammar()
    left, right = grammar.add(*symbols[:2]), grammar.add(*symbols[2:])
    whole = grammar.add(left, right)
    for given in (symbols, [left, right], [whole], [symbols[0], grammar.add(symbols[1], symbols[2]), symbols[3]]):
        matrix, strings = grammar.product(given)
        for (start, end), (cost, string) in entries(symbols).items():
            assert (matrix.cost[start * 4 + end], strings[start * 4 + end]) == (cost, string)


def test_grammar_expands_to_what_it_was_made_from(spark):
    rng = random.Random(2)
    given = {"".join(rng.choice("ABFIJM") for _ in range(rng.randint(1, 30))): rng.randint(1, 9) for _ in range(80)}
    rows = [(s, n, [ord(c) - 65 for c in s]) for s, n in given.items()]
    compressed, grammar = repair.re_pair(spark.createDataFrame(rows, "seq string, n long, symbols array<int>"))

    def expand(symbol):
        if symbol < repair.TERMINALS:
            return chr(65 + symbol)
        return "".join(map(expand, grammar.rules[symbol - repair.TERMINALS]))

    found = compressed.collect()
    assert {r["seq"] for r in found} == set(given)
    assert all("".join(map(expand, r["symbols"])) == r["seq"] for r in found)
    assert sum(len(r["symbols"]) for r in found) < sum(map(len, given)) / 2


def test_pairs_of_a_round_do_not_overlap():
    assert repair.choose([(1, 2), (2, 3), (3, 1), (1, 4), (5, 5), (5, 6)]) == [(1, 2), (1, 4), (5, 5)]
    assert repair.replace([1, 2, 1, 2, 2], {(1, 2): 9}) == [9, 9, 2]


def test_query_matches_sql(spark, tables):
    assert compare(queries.QUERIES["op13_conversation_repair"](spark, tables), tables, queries.ORACLES["op13_conversation_repair"]) == ""


def test_damage_follows_the_hash(spark):
    turns = spark.createDataFrame([(c, t, "assistant", "A. b!") for c in [None, *range(40)] for t in [None, 0, 1]], "conv_id long, turn long, role string, text string")
    fates = turns.withColumn("fate", F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" "))).cast("binary")) % 20)
    count = {r["fate"]: r["count"] for r in fates.groupBy("fate").count().collect()}
    rows = queries.damaged(turns)
    assert rows.count() == turns.count() - count.get(0, 0) + count.get(3, 0)
    assert rows.where("text = ''").count() == count.get(1, 0) and rows.where("text = 'A b'").count() == count.get(2, 0)
    assert rows.where("role = 'user'").count() == count.get(4, 0)
