"""Repair of conversation structure by dynamic programming over a grammar.

A conversation is a sequence of symbols, one for each row: the initial of its role and its fault. Edits
lead the roles through an automaton; a symbol is a min-plus matrix over its states.
Re-Pair replaces frequent neighbours by rules, over all conversations at once; the matrix of a rule is
the product of its two halves and is computed once. Conversations then multiply few matrices.

Every entry of a matrix stands for a string of edits. Strings are kept as ropes: an entry
knows the state in which its left half meets its right half. Ties go to the smaller
string, and no strings are needed to decide that. Each string ends with the edit of the last row,
and all strings of a matrix edit the same number of rows, so none is the beginning of another.
Which of two strings from one state is smaller is therefore decided inside them, and
ranks of the halves give ranks of the whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renown.session import stage

# states: nothing yet, after system, after user, after assistant
STATES, FAR = 4, 1 << 60
CLASSES, FAULTS = "suax", ("", "truncated", "duplicate", "blank")
KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
# edits that end a conversation from each state
TAILS = ("", "II", "I", "")
TERMINALS = len(CLASSES) * len(FAULTS)

_INSERTED = (2, 2, 3, 2)  # state after an inserted row
_LEGAL = {"su", "ua", "au"}


@dataclass(frozen=True)
class Matrix:
    """For each pair of states: cost, state between the halves, and rank among the ends of one start."""

    cost: tuple[int, ...]
    mid: tuple[int, ...]
    rank: tuple[int, ...]


def _ranked(cost: list[int], mid: list[int], order: list) -> Matrix:
    rank = [0] * STATES**2
    for i in range(STATES):
        ends = sorted((j for j in range(STATES) if cost[i * STATES + j] < FAR), key=lambda j: order[i * STATES + j])
        for place, j in enumerate(ends):
            rank[i * STATES + j] = place
    return Matrix(tuple(cost), tuple(mid), tuple(rank))


def _edits(symbol: int, state: int) -> Iterator[tuple[str, int, int]]:
    """Edits of a row: letter, cost and next state."""
    role, fault = CLASSES[symbol // len(FAULTS)], FAULTS[symbol % len(FAULTS)]
    yield "D", DELETE, state
    if fault in ("duplicate", "blank"):
        return
    more = CUT if fault == "truncated" else 0
    yield "R", REROLE + more, _INSERTED[state]
    if role == "s" and state == 0:
        yield "K", KEEP + more, 1
    elif role in "ua" and _INSERTED[state] == (2 if role == "u" else 3):
        yield "K", KEEP + more, _INSERTED[state]


def terminal(symbol: int) -> tuple[Matrix, tuple[str, ...]]:
    """Matrix and strings of one row with the rows inserted in front of it."""
    best: list[tuple[int, str]] = [(FAR, "")] * STATES**2
    for start in range(STATES):
        state = start
        for inserted in range(STATES):
            for letter, cost, end in _edits(symbol, state):
                at = start * STATES + end
                best[at] = min(best[at], (INSERT * inserted + cost, "I" * inserted + letter))
            state = _INSERTED[state]
    return _ranked([c for c, _ in best], [0] * STATES**2, [s for _, s in best]), tuple(s for _, s in best)


def compose(left: Matrix, right: Matrix) -> Matrix:
    """The min-plus product, ties to the smaller string."""
    cost, mid, order = [FAR] * STATES**2, [0] * STATES**2, [(0, 0)] * STATES**2
    for i in range(STATES):
        for j in range(STATES):
            found = min(
                (min(left.cost[i * STATES + k] + right.cost[k * STATES + j], FAR), left.rank[i * STATES + k], k) for k in range(STATES)
            )
            at, k = i * STATES + j, found[2]
            cost[at], mid[at], order[at] = found[0], k, (found[1], right.rank[k * STATES + j])
    return _ranked(cost, mid, order)


class Grammar:
    """Rules over symbols; the matrix of each is known as soon as it is added."""

    def __init__(self) -> None:
        made = [terminal(s) for s in range(TERMINALS)]
        self.matrices = [m for m, _ in made]
        self.leaves = [s for _, s in made]
        self.rules: list[tuple[int, int]] = []
        self._strings: dict[tuple[int, int], str] = {}

    def add(self, left: int, right: int) -> int:
        self.rules.append((left, right))
        self.matrices.append(compose(self.matrices[left], self.matrices[right]))
        return len(self.matrices) - 1

    def string(self, symbol: int, at: int) -> str:
        """The rope of an entry, laid out."""
        if symbol < TERMINALS:
            return self.leaves[symbol][at]
        known = self._strings.get((symbol, at))
        if known is None:
            (left, right), k = self.rules[symbol - TERMINALS], self.matrices[symbol].mid[at]
            known = self.string(left, at // STATES * STATES + k) + self.string(right, k * STATES + at % STATES)
            self._strings[symbol, at] = known
        return known

    def product(self, symbols: list[int]) -> tuple[Matrix, list[str | None]]:
        """Matrix of a sequence and the string of each entry."""
        steps = [self.matrices[symbols[0]]]
        for symbol in symbols[1:]:
            steps.append(compose(steps[-1], self.matrices[symbol]))
        strings: list[str | None] = []
        for at in range(STATES**2):
            if steps[-1].cost[at] >= FAR:
                strings.append(None)
                continue
            start, end, parts = at // STATES * STATES, at % STATES, []
            for symbol, step in zip(symbols[:0:-1], steps[:0:-1]):
                k = step.mid[start + end]
                parts.append(self.string(symbol, k * STATES + end))
                end = k
            parts.append(self.string(symbols[0], start + end))
            strings.append("".join(parts[::-1]))
        return steps[-1], strings


def choose(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The pairs, most frequent first, without those that could overlap an earlier one."""
    lefts: set[int] = set()
    rights: set[int] = set()
    taken = []
    for left, right in pairs:
        if left in rights or right in lefts or (left == right and (left in lefts or right in rights)):
            continue
        lefts.add(left)
        rights.add(right)
        taken.append((left, right))
    return taken


def replace(symbols: list[int], rules: dict[tuple[int, int], int]) -> list[int]:
    """The sequence with the pairs of the rules replaced, from left to right."""
    out, k = [], 0
    while k < len(symbols):
        rule = rules.get((symbols[k], symbols[k + 1])) if k + 1 < len(symbols) else None
        out.append(symbols[k] if rule is None else rule)
        k += 1 if rule is None else 2
    return out


def re_pair(sequences: DataFrame, rounds: int = 8, rules_a_round: int = 256) -> tuple[DataFrame, Grammar]:
    """Compress the column ``symbols`` of ``sequences``, whose rows count ``n`` times.

    A round counts the pairs of all sequences and turns the most frequent ones that cannot overlap into
    rules, until no pair occurs twice. The two limits bound the grammar, and with it what tasks are
    sent; what it leaves uncompressed is multiplied symbol by symbol.
    """
    grammar = Grammar()
    for _ in range(rounds):
        size = F.size("symbols")
        neighbours = F.when(size > 1, F.transform(F.sequence(F.lit(1), size - 1), lambda k: F.struct(F.element_at("symbols", k).alias("l"), F.element_at("symbols", k + 1).alias("r"))))
        counted = sequences.select("n", F.explode(neighbours).alias("pair")).groupBy("pair").agg(F.sum("n").alias("n")).where("n > 1")
        best = counted.orderBy(F.desc("n"), "pair").limit(rules_a_round).collect()
        rules = {pair: grammar.add(*pair) for pair in choose([(r["pair"]["l"], r["pair"]["r"]) for r in best])}
        if not rules:
            break

        def run(batches: Iterator[pa.RecordBatch], rules: dict = rules) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                symbols = pa.array([replace(s, rules) for s in batch.column(2).to_pylist()], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), symbols], ["seq", "n", "symbols"])

        sequences = stage(sequences.select("seq", "n", "symbols").mapInArrow(run, "seq string, n long, symbols array<int>"), "turn-grammar")
    return sequences, grammar


_VALUES = "seq string, cost array<long>, rank array<int>, audits array<string>, illegal long, first string, last string"


def _evaluated(grammar: Grammar):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for seq, symbols in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                matrix, strings = grammar.product(symbols)
                roles = "".join(CLASSES[(ord(c) - 65) // len(FAULTS)] for c in seq)
                illegal = sum(a + b not in _LEGAL for a, b in zip(roles, roles[1:]))
                rows.append((seq, list(matrix.cost), list(matrix.rank), strings, illegal, roles[0], roles[-1]))
            types = [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.string()), pa.int64(), pa.string(), pa.string()]
            columns = zip(*rows) if rows else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["seq", "cost", "rank", "audits", "illegal", "first", "last"])

    return run


class _Path:
    """The cheapest way through the blocks of one conversation, from the state before it."""

    def __init__(self) -> None:
        self.cost, self.rank = [0, FAR, FAR, FAR], [0, 0, 0, 0]
        self.back: list[tuple[int, list[int]]] = []
        self.illegal, self.last = 0, ""

    def add(self, block: int, cost: list[int], rank: list[int], first: str, last: str) -> None:
        self.illegal += bool(self.last) and self.last + first not in _LEGAL
        self.last = last
        found = [min((min(self.cost[k] + cost[k * STATES + j], FAR), self.rank[k], k) for k in range(STATES)) for j in range(STATES)]
        order = sorted(range(STATES), key=lambda j: (found[j][1], rank[found[j][2] * STATES + j]))
        self.cost = [f[0] for f in found]
        self.rank = [order.index(j) for j in range(STATES)]
        self.back.append((block, [f[2] for f in found]))

    def steps(self) -> tuple[int, str, list[dict]]:
        """Cost, edits behind the last row, and start and end state of every block."""
        cost, _, end = min((self.cost[j] + INSERT * len(TAILS[j]), self.rank[j], j) for j in range(STATES))
        tail, steps = TAILS[end], []
        for block, back in reversed(self.back):
            steps.append({"block": block, "start": back[end], "end": end})
            end = back[end]
        return cost, tail, steps[::-1]


def _paths(conv_type: pa.DataType):
    steps_type = pa.list_(pa.struct([("block", pa.int64()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, current, rows = None, None, []

        def flush() -> pa.RecordBatch:
            columns = zip(*rows) if rows else [[]] * 5
            types = [conv_type, pa.int64(), pa.int64(), pa.string(), steps_type]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["conv", "between", "cost", "tail", "steps"])

        for batch in batches:
            for conv, block, cost, rank, first, last in zip(*(c.to_pylist() for c in batch.columns)):
                if path is None or conv != current:
                    if path is not None:
                        rows.append((current, path.illegal, *path.steps()))
                    path, current = _Path(), conv
                path.add(block, cost, rank, first, last)
            yield flush()
            rows = []
        if path is not None:
            rows.append((current, path.illegal, *path.steps()))
        yield flush()

    return run


def _edited(conv_type: pa.DataType):
    """Rows of the repaired conversation, each with the place of its source or, inserted, none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, block, state, audit, runs in zip(*(c.to_pylist() for c in batch.columns)):
                # of the rows of a run only the first can stay
                places = [(r["at"], r["system"]) if k == 0 else (None, False) for r in runs for k in range(r["n"])]
                row = 0
                for k, letter in enumerate(audit):
                    if letter == "I":
                        state = _INSERTED[state]
                        rows.append((conv, block, k, None, "user" if state == 2 else "assistant"))
                        continue
                    (at, system), row = places[row], row + 1
                    if letter != "D":
                        state = 1 if letter == "K" and system else _INSERTED[state]
                        new = None if letter == "K" else "user" if state == 2 else "assistant"
                        rows.append((conv, block, k, at, new))
            types = [conv_type, pa.int64(), pa.int64(), pa.int64(), pa.string()]
            columns = zip(*rows) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["conv", "block", "step", "at", "new_role"])

    return run


def solid(text: Column) -> Column:
    """Whether the text holds more than ASCII white space."""
    return text.rlike(r"[^\x20\x09-\x0D]")


@dataclass
class Repair:
    summary: DataFrame
    rows: DataFrame


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", block_rows: int = 4096) -> Repair:
    """Cheapest edits that make the roles of each conversation ``(system? (user assistant)+)?``.

    ``summary``: the conversation, ``gaps`` (missing numbers between its turns), ``blank``, ``duplicate``,
    ``truncated``, ``illegal``, ``cost`` and ``audit`` (K keep, R rerole, D delete, I insert; of equal
    cost the smallest string). ``rows``: the repaired rows (conversation, block, step, role, text) in the
    order of block and step; ``at`` is null where a row was inserted.

    Rows stand in order of turn, nulls first; rows that share a turn follow each other by role and
    digest of the text. A null role or text is one space, so a null text is blank. A null conversation
    is one of its own. A role counts by its first letter; one that is none of s, u and a can only be
    changed or deleted. An empty table gives no rows.

    No step needs a whole conversation in one task: rows are sorted by range over all tasks and
    cut into blocks of ``block_rows``, first occurrences are found by an aggregate over role and text, and a
    conversation is put together from one small matrix for each of its blocks.
    """
    conv_type = turns.schema[conv].dataType
    arrow = _arrow_type(turns, conv)
    blank_space = lambda c: F.coalesce(F.col(c), F.lit(" "))
    plain = turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), blank_space(role).alias("role"), blank_space(text).alias("text"))
    same = ["conv", "turn", "role", "digest"]
    runs = stage(
        plain.withColumn("digest", F.sha2("text", 256)).groupBy(*same).agg(F.count(F.lit(1)).alias("n"), F.first("text").alias("text"))
        .withColumn("solid", solid(F.col("text"))),
        "turn-runs",
    )
    when = F.struct(F.col("turn").isNotNull().alias("later"), "turn")
    firsts = runs.where("solid").groupBy("conv", "role", "digest").agg(F.min(when).alias("when")).select(*[F.col(c).alias(f"f_{c}") for c in ("conv", "role", "digest")], F.col("when.turn").alias("f_turn"))
    met = [F.col(c).eqNullSafe(F.col(f"f_{c}")) for c in same]
    fault = (
        F.when(~F.col("solid"), 3).when(F.col("f_role").isNull(), 2)
        .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), 1).otherwise(0)
    )
    letter = F.substring("role", 1, 1)
    kind = F.when(letter == "s", 0).when(letter == "u", 1).when(letter == "a", 2).otherwise(3) * len(FAULTS)
    repeated = kind + F.when(F.col("solid"), 2).otherwise(3)
    code = lambda c: F.chr(c + 65)
    parts = max(int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    marked = runs.join(firsts, met[0] & met[1] & met[2] & met[3], "left").select(
        *same, "text", "n", F.concat(code(kind + fault), F.repeat(code(repeated), (F.col("n") - 1).cast("int"))).alias("seq")
    )
    ordered = stage(
        marked.repartitionByRange(parts, *same).sortWithinPartitions(*same).withColumn("at", F.monotonically_increasing_id())
        .withColumn("block", F.floor(F.col("at") / block_rows).cast("bigint")),
        "turn-order",
    )
    line = F.array_sort(F.collect_list(F.struct("at", "n", "seq")))
    blocks = stage(
        ordered.groupBy("conv", "block").agg(line.alias("line")).select(
            "conv", "block", F.array_join("line.seq", "").alias("seq"),
            F.transform("line", lambda r: F.struct(r["at"].alias("at"), r["n"].alias("n"), F.substring(r["seq"], 1, 1).isin(list("ABCD")).alias("system"))).alias("runs"),
        ),
        "turn-blocks",
    )
    sequences = blocks.groupBy("seq").agg(F.count(F.lit(1)).alias("n")).withColumn("symbols", F.transform(F.split("seq", ""), lambda c: F.ascii(c) - 65))
    compressed, grammar = re_pair(stage(sequences, "turn-sequences"))
    values = stage(compressed.select("seq", "symbols").mapInArrow(_evaluated(grammar), _VALUES), "turn-values")
    parts_of = stage(blocks.join(values, "seq").select("conv", "block", "seq", "cost", "rank", "audits", "illegal", "first", "last"), "turn-parts")
    conv_ddl = conv_type.simpleString()
    paths = stage(
        parts_of.select("conv", "block", "cost", "rank", "first", "last").repartition(parts, "conv").sortWithinPartitions("conv", "block")
        .mapInArrow(_paths(arrow), f"conv {conv_ddl}, between long, cost long, tail string, steps array<struct<block:long,start:int,end:int>>"),
        "turn-paths",
    )
    # blocks are numbered over all conversations, so a block and the hash of its conversation find a part
    step = paths.select("conv", F.explode("steps").alias("step")).select(F.col("conv").alias("_conv"), F.col("step.block").alias("_block"), "step.start", "step.end")
    here = (F.col("block") == F.col("_block")) & F.col("conv").eqNullSafe(F.col("_conv"))
    audits = stage(
        parts_of.select("conv", "block", "audits").join(step, here).select("conv", "block", "start", F.element_at("audits", F.col("start") * STATES + F.col("end") + 1).alias("audit")),
        "turn-audits",
    )

    count = lambda fault: F.sum(F.length("seq") - F.length(F.translate("seq", "".join(chr(65 + k * len(FAULTS) + fault) for k in range(len(CLASSES))), "")))
    facts = [
        runs.groupBy("conv", "turn").agg(F.lit(1).alias("_")).groupBy("conv").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("bigint").alias("gaps")),
        parts_of.groupBy("conv").agg(count(3).alias("blank"), count(2).alias("duplicate"), count(1).alias("truncated"), F.sum("illegal").alias("inside")),
        paths.select("conv", "between", "cost", "tail"),
        audits.groupBy("conv").agg(F.array_join(F.array_sort(F.collect_list(F.struct("block", "audit")))["audit"], "").alias("edits")),
    ]
    together = facts[0]
    for more in facts[1:]:
        together = together.unionByName(more, allowMissingColumns=True)
    summary = together.groupBy("conv").agg(*[F.max(c).alias(c) for c in together.columns if c != "conv"]).select(
        F.col("conv").alias(conv), "gaps", "blank", "duplicate", "truncated", (F.col("inside") + F.col("between")).alias("illegal"), "cost", F.concat("edits", "tail").alias("audit")
    )

    lists = blocks.select(F.col("conv").alias("_conv"), F.col("block").alias("_block"), "runs")
    tails = paths.where("tail <> ''").select("conv", F.lit((1 << 63) - 1).alias("block"), F.when(F.length("tail") == 2, 1).otherwise(2).alias("start"), F.col("tail").alias("audit"), F.array().cast(blocks.schema["runs"].dataType).alias("runs"))
    edits = stage(
        audits.join(lists, here).select("conv", "block", "start", "audit", "runs").unionByName(tails)
        .mapInArrow(_edited(arrow), f"conv {conv_ddl}, block long, step long, at long, new_role string"),
        "turn-edits",
    )
    kept = edits.where("at is not null").join(ordered.select("at", "role", "text"), "at").select("conv", "block", "step", "at", F.coalesce("new_role", "role").alias("role"), "text")
    added = edits.where("at is null").select("conv", "block", "step", "at", F.col("new_role").alias("role"), F.lit("").alias("text"))
    return Repair(summary, kept.unionByName(added).withColumnRenamed("conv", conv))


def _arrow_type(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)


def digest(rows: DataFrame, conv: str = "conv_id") -> DataFrame:
    """SHA-256 of the repaired ``role:text`` lines of each conversation.

    The hash is sequential, so the lines of a conversation stream through one task in
    their order; none are held.
    """
    arrow, ddl = _arrow_type(rows, conv), rows.schema[conv].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        state, current = None, None
        for batch in batches:
            done = []
            for key, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if state is None or key != current:
                    if state is not None:
                        done.append((current, state.hexdigest()))
                    state, current = hashlib.sha256(line.encode()), key
                else:
                    state.update(b"\n" + line.encode())
            yield _digests(done, arrow)
        if state is not None:
            yield _digests([(current, state.hexdigest())], arrow)

    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    lines = rows.repartition(parts, conv).sortWithinPartitions(conv, "block", "step").select(conv, F.concat_ws(":", "role", "text").alias("line"))
    return lines.mapInArrow(run, f"{conv} {ddl}, repaired_sha256 string")


def _digests(done: list, arrow: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], arrow), pa.array([d[1] for d in done], pa.string())], ["key", "digest"])
