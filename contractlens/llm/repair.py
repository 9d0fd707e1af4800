"""Repair of damaged conversations by the cheapest edits, told as an audit string.

A repaired conversation is empty or goes system?, (user, assistant)+. Turns are kept (K),
get another role (R), are deleted (D), and empty turns are inserted (I). A node is a
place between turns with the state of the pattern read so far; a cost DP from the end
gives every node its least cost, and only arcs that keep to it are left. Of the many
cheapest audits the least is wanted: nodes are ranked by their least audits of 1, 2, 4,
... letters, where the rank of twice the length comes from the ranks of a node and of
the nodes its shorter audits lead to. The ranks choose each node's next arc, and the
audits are read through pointers that are doubled the same way.

Many conversations are solved at once in numpy. Ordinary ones are brought together by
conv_id. Conversations of more turns than a task should hold are cut into segments: the
cost of crossing a segment is a small matrix, matrices are composed from the end, and
then every segment is solved by itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from contractlens.llm.common import slices
from contractlens.operators.grouping import split_by_group_size
from contractlens.session import cut_lineage

# Costs of the edits, fixed by the task.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Turns of a conversation, and of a segment, that a task holds at once.
LONGEST = 4096
#: White space of the task: ASCII blanks and line ends.
BLANKS = " \t\n\x0b\x0c\r"
#: States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
#: By state: the state after an inserted or reroled turn.
FOLLOWING = np.array([USER, USER, ASSISTANT, USER])
#: By state and initial (none of them, s, u, a): the state after a kept turn, or -1.
KEPT = np.array([[-1, SYSTEM, USER, -1], [-1, -1, USER, -1], [-1, -1, -1, ASSISTANT], [-1, -1, USER, -1]])
#: The letters in ASCII order; 0 stands for the end of an audit.
LETTERS = "DIKR"
D, I, K, R = 1, 2, 3, 4
FAR = np.int64(1) << np.int64(60)
#: The costs at the end of a conversation, by state.
END = np.array([0, FAR, FAR, 0])


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text of the turns after the damage that the task plans.

    crc32 of `conv_id:turn` modulo 20 says what happens: 0 drops a turn, 1 empties its
    text, 2 removes its `[.!?]`, 3 repeats it, 4 makes it the user's. Nulls count as one
    space; conv_id and turn stay null in the rows.
    """
    space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    name = F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")
    rows = conversations.select(
        "conv_id", "turn", space("role").alias("role"), space("text").alias("text"),
        (F.crc32(name) % 20).alias("harm"),
    ).filter("harm <> 0")
    text = F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.translate("text", ".!?", ""))
    copies = F.array_repeat(F.lit(1), F.when(F.col("harm") == 3, 2).otherwise(1))
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("harm") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"), F.explode(copies).alias("copy"),
    ).drop("copy")


def described(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text (nulls as one space), initial (0 to 3), blank, open: ends
    without `[.!?]`."""
    space = lambda name: F.coalesce(F.col(name), F.lit(" ")).alias(name)
    end = F.rtrim("text", F.lit(BLANKS))
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", 1).when(first == "u", 2).when(first == "a", 3).otherwise(0)
    return turns.select("conv_id", "turn", space("role"), space("text")).select(
        "conv_id", "turn", "role", "text", initial.alias("initial"), (end == "").alias("blank"),
        (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("open"),
    )


#: The order of a conversation's turns; nulls come first.
ORDER = ["turn", "role", "text"]


@dataclass
class Turns:
    """Turns of many segments, one after the other; starts has one more entry than there
    are segments. gone: must be deleted."""

    initial: np.ndarray
    gone: np.ndarray
    open: np.ndarray
    starts: np.ndarray


@dataclass
class Nodes:
    """Least costs by node, and the arcs that keep to them. Node base[s] + 4 * i + state is
    before turn i of segment s."""

    base: np.ndarray
    cost: np.ndarray
    source: np.ndarray
    letter: np.ndarray
    target: np.ndarray


def _inserted(cost: np.ndarray) -> np.ndarray:
    """Costs by state (last axis) when turns may be inserted first. One more turn after two
    leads back to a state, so two steps are enough."""
    step = INSERT + cost[..., FOLLOWING]
    user = np.minimum(cost[..., USER], step[..., USER])
    out = cost.copy()
    out[..., ASSISTANT] = np.minimum(cost[..., ASSISTANT], step[..., ASSISTANT])
    for state in (START, SYSTEM, USER):
        out[..., state] = user if state == USER else np.minimum(cost[..., state], INSERT + user)
    return out


def _arcs(turns: Turns, at: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """letter, state, states reached, costs and whether it may be taken, for turns `at`."""
    initial, gone, more = turns.initial[at], turns.gone[at], TRUNCATED * turns.open[at].astype(np.int64)
    every = np.ones(len(at), bool)
    for state in range(STATES):
        kept = KEPT[state][initial]
        yield D, state, np.full(len(at), state), np.full(len(at), DELETE, np.int64), every
        yield K, state, np.maximum(kept, 0), more, ~gone & (kept >= 0)
        yield R, state, np.full(len(at), FOLLOWING[state]), REROLE + more, ~gone


def least_costs(turns: Turns, ends: np.ndarray, final: np.ndarray) -> Nodes:
    """The cost DP from the last turns to the first, all segments side by side.

    ends: costs by state at each segment's end; turns are inserted there only where the
    conversation ends (final), else before the next segment's first turn.
    """
    lengths = np.diff(turns.starts)
    base = STATES * (turns.starts[:-1] + np.arange(len(lengths)))
    cost = np.full(int(STATES * (turns.starts[-1] + len(lengths))), FAR, np.int64)
    layers = cost.reshape(-1, STATES)  # a view: one row for each place
    last = base // STATES + lengths
    layers[last] = np.where(final[:, None], _inserted(ends), ends)
    for back in range(1, int(lengths.max(initial=0)) + 1):
        active = np.flatnonzero(lengths >= back)
        here = last[active] - back
        at = turns.starts[active] + lengths[active] - back
        after, best = layers[here + 1], np.full((len(active), STATES), FAR, np.int64)
        rows = np.arange(len(active))
        for _, state, reached, price, allowed in _arcs(turns, at):
            best[:, state] = np.minimum(best[:, state], np.where(allowed, price + after[rows, reached], FAR))
        layers[here] = _inserted(np.minimum(best, FAR))
    # the arcs that keep to the least costs
    place = np.repeat(base // STATES, lengths) + np.arange(turns.starts[-1]) - np.repeat(turns.starts[:-1], lengths)
    found = []
    for letter, state, reached, price, allowed in _arcs(turns, np.arange(turns.starts[-1])):
        source, target = STATES * place + state, STATES * (place + 1) + reached
        keeps = allowed & (cost[source] < FAR) & (cost[source] == price + cost[target])
        found.append((source[keeps], letter, target[keeps]))
    spots = np.concatenate([place, last[final]])
    for state in range(STATES):
        source, target = STATES * spots + state, STATES * spots + FOLLOWING[state]
        keeps = (cost[source] < FAR) & (cost[source] == INSERT + cost[target])
        found.append((source[keeps], I, target[keeps]))
    letter = np.concatenate([np.full(len(s), n, np.int64) for s, n, _ in found])
    return Nodes(base, cost, np.concatenate([s for s, _, _ in found]), letter, np.concatenate([t for _, _, t in found]))


def audit_ranks(nodes: Nodes) -> np.ndarray:
    """Every node's rank by its least audit, by prefix doubling.

    ranks order the nodes by their least audits of 2^k letters (0 letters are left at an
    end); leads are pairs of a node and a node that such an audit leads to. The audit of
    twice the length goes on from the leads of least rank. Once no rank splits, none
    splits later.
    """
    count = len(nodes.cost)
    rank = np.full(count, len(LETTERS) + 1, np.int64)
    np.minimum.at(rank, nodes.source, nodes.letter)
    rank[rank > len(LETTERS)] = 0
    least = nodes.letter == rank[nodes.source]
    ended = np.flatnonzero(rank == 0)
    leads = _pairs(np.concatenate([nodes.source[least], ended]), np.concatenate([nodes.target[least], ended]), count)
    classes = len(np.unique(rank))
    while True:
        source, target = leads
        starts = np.searchsorted(source, np.arange(count + 1))
        then = np.minimum.reduceat(rank[target], starts[:-1])  # every node has a lead
        values, doubled = np.unique(rank * (count + 1) + then, return_inverse=True)
        chosen = rank[target] == then[source]
        source, target = source[chosen], target[chosen]
        size = np.diff(starts)[target]
        into = np.repeat(starts[:-1][target], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        leads = _pairs(np.repeat(source, size), leads[1][into], count)
        rank = doubled.astype(np.int64)
        if len(values) == classes:
            return rank
        classes = len(values)


def _pairs(source: np.ndarray, target: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    return np.divmod(np.unique(source * count + target), count)


def least_audits(nodes: Nodes, starts: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The least cheapest audits from these nodes, and the nodes where they end."""
    count, rank = len(nodes.cost), audit_ranks(nodes)
    letter, pointer = np.zeros(count, np.int64), np.arange(count)
    # by node, then letter, then the rank of where the arc leads: the first one is taken
    order = np.lexsort((rank[nodes.target], nodes.letter, nodes.source))
    source, first = np.unique(nodes.source[order], return_index=True)
    letter[source], pointer[source] = nodes.letter[order][first], nodes.target[order][first]
    doubled = [pointer]
    while not np.array_equal(nxt := doubled[-1][doubled[-1]], doubled[-1]):
        doubled.append(nxt)
    path = starts[:, None]
    for jump in reversed(doubled[:-1]):
        path = np.stack([path, jump[path]], axis=2).reshape(len(starts), -1)
    text = np.frombuffer(("\0" + LETTERS).encode(), np.uint8)[letter[path]]
    return [bytes(row).rstrip(b"\0").decode() for row in text], doubled[-1][starts]


def solve(turns: Turns, ends: np.ndarray, final: np.ndarray, entry: int | None = START):
    """By segment: least costs by entry state; audits and exit states from `entry`, or
    from every state (segment by segment) if it is None."""
    nodes = least_costs(turns, ends, final)
    states = np.arange(STATES) if entry is None else np.array([entry])
    starts = (nodes.base[:, None] + states).ravel()
    audits, stops = least_audits(nodes, starts)
    costs = nodes.cost[nodes.base[:, None] + np.arange(STATES)]
    return costs, audits, stops % STATES


def crossing(turns: Turns) -> np.ndarray:
    """For each segment the least costs from entry to exit state, without turns inserted
    at its end."""
    count = len(turns.starts) - 1
    out = np.empty((count, STATES, STATES), np.int64)
    for stop in range(STATES):
        ends = np.full((count, STATES), FAR, np.int64)
        ends[:, stop] = 0
        nodes = least_costs(turns, ends, np.zeros(count, bool))
        out[:, :, stop] = nodes.cost[nodes.base[:, None] + np.arange(STATES)]
    return out


class Walk:
    """The turns that an audit leaves, as (letter, role, text), row by row."""

    def __init__(self, audit: str):
        self.letters, self.state = iter(audit), START

    def _empty(self) -> tuple[str, str, str]:
        self.state = int(FOLLOWING[self.state])
        return "I", "user" if self.state == USER else "assistant", ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """What stands before this row, and the row if it stays."""
        while (letter := next(self.letters)) == "I":
            yield self._empty()
        if letter == "K":
            self.state = int(KEPT[self.state]["_sua".find(role[:1])])
            yield letter, role, text
        elif letter == "R":
            yield letter, self._empty()[1], text

    def rest(self) -> Iterator[tuple[str, str, str]]:
        for _ in self.letters:
            yield self._empty()


def _illegal(initial: np.ndarray) -> int:
    """Neighbours that start neither su, ua nor au."""
    one, two = initial[:-1], initial[1:]
    return int(((two != 2) | (one == 0) | (one == 2)).sum() - ((one == 2) & (two == 3)).sum())


def _gaps(turns: list[int | None]) -> int:
    known = {t for t in turns if t is not None}
    return max(known) - min(known) + 1 - len(known) if known else 0


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
REPORT = ", ".join(f"{name} long" for name in COUNTS) + ", audit string, repaired_sha256 string"
NO_TURNS = hashlib.sha256(b"").hexdigest()


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[tuple]]]:
    """conv_id and rows (turn, role, text, initial, blank, open) of rows that come sorted."""
    name, held = None, []
    for batch in slices(batches):
        for conv, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and conv != name:
                yield name, held
                held = []
            name = conv
            held.append(row)
    if held:
        yield name, held


def _report(found: list[tuple[object, list[tuple]]], kind: pa.DataType) -> pa.RecordBatch:
    """Whole conversations, solved together."""
    starts = np.cumsum([0, *(len(rows) for _, rows in found)])
    gone, counts = [], []
    for _, rows in found:
        seen, blank, again, cut = set(), 0, 0, 0
        for _, role, text, _, is_blank, is_open in rows:
            is_again = not is_blank and (role, text) in seen
            seen.add((role, text))
            gone.append(is_blank or is_again)
            blank, again, cut = blank + is_blank, again + is_again, cut + (is_open and not gone[-1])
        counts.append([_gaps([r[0] for r in rows]), blank, again, cut, _illegal(np.array([r[3] for r in rows]))])
    flat = [row for _, rows in found for row in rows]
    turns = Turns(
        np.array([r[3] for r in flat], np.int64), np.array(gone, bool), np.array([r[5] for r in flat], bool), starts
    )
    costs, audits, _ = solve(turns, np.tile(END, (len(found), 1)), np.ones(len(found), bool))
    digests = []
    for (_, rows), audit in zip(found, audits, strict=True):
        walk = Walk(audit)
        left = [turn for r in rows for turn in walk.row(r[1], r[2])] + list(walk.rest())
        digests.append(hashlib.sha256("\n".join(f"{role}:{text}" for _, role, text in left).encode()).hexdigest())
    columns = [pa.array([name for name, _ in found], kind)]
    columns += [pa.array([c[i] for c in counts], pa.int64()) for i in range(5)]
    columns += [pa.array(costs[:, START], pa.int64()), pa.array(audits, pa.string()), pa.array(digests, pa.string())]
    return pa.RecordBatch.from_arrays(columns, ["conv_id", *COUNTS, "audit", "repaired_sha256"])


def _parts(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _ordinary(turns: DataFrame) -> DataFrame:
    """The report of conversations that a task can hold."""
    kind = to_arrow_type(turns.schema["conv_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, longest = [], 0
        for name, rows in _conversations(batches):
            longest = max(longest, len(rows))
            # as many as their audits, side by side, need little room
            if found and (len(found) + 1) * longest > 16 * LONGEST:
                yield _report(found, kind)
                found, longest = [], len(rows)
            found.append((name, rows))
        if found:
            yield _report(found, kind)

    rows = turns.repartition(_parts(turns), "conv_id").sortWithinPartitions("conv_id", *ORDER)
    return rows.mapInArrow(run, f"conv_id {dict(turns.dtypes)['conv_id']}, {REPORT}")


def _segments(turns: DataFrame, longest: int) -> DataFrame:
    """conv_id, seg and kinds: a byte for each turn (initial, +4 if blank, +8 if it came
    before, +16 if open). seg ascends in the order of turns and is unique.

    Ranges of (conv_id, turn, role, text) go to tasks, so turns of one conversation, even
    turns without a number, go to many. Equal rows are counted first and stay a run.
    """
    kind = to_arrow_type(turns.schema["conv_id"].dataType)
    key = ["conv_id", "role", "digest"]
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    runs = turns.groupBy("conv_id", "turn", "role", "text", "initial", "blank", "open").agg(
        F.count(F.lit(1)).alias("copies")
    )
    runs = cut_lineage(runs.withColumn("digest", F.sha2("text", 256)).withColumn("place", place))
    firsts = runs.groupBy(*[F.col(name).alias(f"of_{name}") for name in key]).agg(F.min("place").alias("first"))
    same = F.lit(True)
    for name in key:
        same = same & F.col(name).eqNullSafe(F.col(f"of_{name}"))
    rows = runs.join(firsts, same).withColumn("again", F.col("place") > F.col("first"))
    rows = rows.repartitionByRange(
        _parts(turns), "conv_id", "turn", "role", F.substring("text", 1, 64)
    ).sortWithinPartitions("conv_id", *ORDER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, number, name, held = TaskContext.get().partitionId() << 32, 0, None, bytearray()

        def segment() -> pa.RecordBatch:
            columns = [pa.array([name], kind), pa.array([first + number], pa.int64()), pa.array([bytes(held)], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["conv_id", "seg", "kinds"])

        for batch in slices(batches):
            for conv, initial, blank, again, is_open, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and conv != name:
                    yield segment()
                    number, held = number + 1, bytearray()
                name = conv
                for copy in range(copies):
                    held.append(initial + 4 * blank + 8 * (again or copy > 0) + 16 * is_open)
                    if len(held) >= longest:
                        yield segment()
                        number, held = number + 1, bytearray()
        if held:
            yield segment()

    narrow = rows.select("conv_id", "initial", "blank", "again", "open", "copies")
    return narrow.mapInArrow(run, f"conv_id {dict(turns.dtypes)['conv_id']}, seg long, kinds binary")


def _unpacked(kinds: list[bytes]) -> Turns:
    each = np.frombuffer(b"".join(kinds), np.uint8).astype(np.int64)
    starts = np.cumsum([0, *map(len, kinds)])
    return Turns(each & 3, (each & 12) > 0, (each & 16) > 0, starts)


def _crossed(segments: DataFrame) -> DataFrame:
    """seg, conv_id, matrix, first and last initial, and counts of each segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=16):
            kinds = batch["kinds"].to_pylist()
            each = [np.frombuffer(k, np.uint8) for k in kinds]
            blank = [int(((k & 4) > 0).sum()) for k in each]
            again = [int(((k & 12) == 8).sum()) for k in each]
            cut = [int(((k & 28) == 16).sum()) for k in each]
            ends = [int(k[0] & 3) for k in each], [int(k[-1] & 3) for k in each]
            matrix = crossing(_unpacked(kinds)).reshape(len(kinds), -1)
            columns = [pa.array(c, pa.int64()) for c in (blank, again, cut, [_illegal(k & 3) for k in each], *ends)]
            yield pa.RecordBatch.from_arrays(
                [batch["conv_id"], batch["seg"], *columns, pa.array(matrix.tolist(), pa.list_(pa.int64()))],
                ["conv_id", "seg", "blank", "duplicate", "truncated", "illegal", "first", "last", "matrix"],
            )

    kind = dict(segments.dtypes)["conv_id"]
    counts = ", ".join(f"{name} long" for name in ("blank", "duplicate", "truncated", "illegal", "first", "last"))
    return segments.mapInArrow(run, f"conv_id {kind}, seg long, {counts}, matrix array<long>")


def _from_the_end(group: pd.DataFrame) -> pd.DataFrame:
    """For the segments of one conversation: costs by state at each one's end, the cost from
    the start before it, and whether the turns on either side of its start clash."""
    group = group.sort_values("seg")
    after, out = _inserted(END[None])[0], []
    before = [None, *group["last"].tolist()[:-1]]
    for place in range(len(group) - 1, -1, -1):
        row = group.iloc[place]
        final = place == len(group) - 1
        matrix = np.array(row["matrix"], np.int64).reshape(STATES, STATES)
        costs = np.minimum(matrix + after[None, :], FAR).min(axis=1)
        clash = 0 if before[place] is None else _illegal(np.array([before[place], row["first"]]))
        out.append((int(row["seg"]), [int(c) for c in (END if final else after)], final, int(costs[START]), clash))
        after = costs
    return pd.DataFrame(out, columns=["seg", "ends", "final", "cost", "clash"])


def _solved(segments: DataFrame, ends: DataFrame) -> DataFrame:
    """conv_id, seg, exits and audits of each segment, by the state it is entered with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=16):
            turns = _unpacked(batch["kinds"].to_pylist())
            final = np.array(batch["final"].to_pylist(), bool)
            _, audits, exits = solve(turns, np.array(batch["ends"].to_pylist(), np.int64), final, None)
            by_state = [audits[i : i + STATES] for i in range(0, len(audits), STATES)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["conv_id"], batch["seg"],
                    pa.array(exits.reshape(-1, STATES).tolist(), pa.list_(pa.int32())),
                    pa.array(by_state, pa.list_(pa.string())),
                ],
                ["conv_id", "seg", "exits", "audits"],
            )

    rows = segments.join(ends.select("seg", "ends", "final"), "seg").select("conv_id", "seg", "kinds", "ends", "final")
    return rows.mapInArrow(run, f"conv_id {dict(segments.dtypes)['conv_id']}, seg long, exits array<int>, audits array<string>")


def _from_the_start(group: pd.DataFrame) -> pd.DataFrame:
    """The state that each segment of a conversation is entered with."""
    group, state, entries = group.sort_values("seg"), START, []
    for exits in group["exits"]:
        entries.append(state)
        state = int(exits[state])
    return pd.DataFrame({"seg": group["seg"], "entry": entries})


def _walked(turns: DataFrame, audits: DataFrame, digests: bool) -> DataFrame:
    """The turns that the audits (conv_id, audit) leave: conv_id, place, edit, role, text; or
    conv_id and the digest of these turns.

    A conversation's turns pass a task one by one, after its audit.
    """
    kind = to_arrow_type(turns.schema["conv_id"].dataType)
    none = F.lit(None)
    heads = audits.select(
        "conv_id", F.lit(0).alias("kind"), none.cast(dict(turns.dtypes)["turn"]).alias("turn"),
        F.lit("").alias("role"), F.col("audit").alias("text"),
    )
    rows = turns.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text").unionByName(heads)
    rows = rows.repartition(_parts(turns), "conv_id").sortWithinPartitions("conv_id", "kind", *ORDER)

    def left(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        """(conv_id, letter, role, text) row by row; letter is None at a conversation's end."""
        walk, name = None, None
        for batch in slices(batches):
            for conv, is_turn, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if is_turn:
                    yield [(conv, *turn) for turn in walk.row(role, text)]
                    continue
                if walk:
                    yield [*((name, *turn) for turn in walk.rest()), (name, None, "", "")]
                walk, name = Walk(text), conv
        if walk:
            yield [*((name, *turn) for turn in walk.rest()), (name, None, "", "")]

    def turns_left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, place, size = [], 0, 0

        def block() -> pa.RecordBatch:
            kinds = [kind, pa.int64(), pa.string(), pa.string(), pa.string()]
            columns = [pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(columns, ["conv_id", "place", "edit", "role", "text"])

        for some in left(batches):
            for conv, letter, role, text in some:
                if letter is None:
                    place = 0
                    continue
                held.append((conv, place, letter, role, text))
                place, size = place + 1, size + len(text)
                if len(held) >= 512 or size > 4 << 20:
                    yield block()
                    held, size = [], 0
        if held:
            yield block()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, first = hashlib.sha256(), True
        for some in left(batches):
            for conv, letter, role, text in some:
                if letter is None:
                    columns = [pa.array([conv], kind), pa.array([state.hexdigest()], pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, ["conv_id", "repaired_sha256"])
                    state, first = hashlib.sha256(), True
                    continue
                state.update((("" if first else "\n") + f"{role}:{text}").encode())
                first = False

    rows = rows.select("conv_id", F.col("kind"), "role", "text")
    name = f"conv_id {dict(turns.dtypes)['conv_id']}"
    if digests:
        return rows.mapInArrow(digest, f"{name}, repaired_sha256 string")
    return rows.mapInArrow(turns_left, f"{name}, place long, edit string, role string, text string")


def _long(turns: DataFrame, longest: int) -> DataFrame:
    """The report of conversations of any length."""
    segments = cut_lineage(_segments(turns, longest))
    crossed = cut_lineage(_crossed(segments))
    ends = cut_lineage(
        crossed.select("conv_id", "seg", "first", "last", "matrix").groupBy("conv_id")
        .applyInPandas(_from_the_end, "seg long, ends array<long>, final boolean, cost long, clash long")
    )
    solved = cut_lineage(_solved(segments, ends))
    entries = solved.select("conv_id", "seg", "exits").groupBy("conv_id").applyInPandas(_from_the_start, "seg long, entry int")
    audits = solved.join(entries, "seg").select(
        "conv_id", "seg", F.get("audits", F.col("entry")).alias("audit")
    )
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seg", "audit"))), lambda s: s["audit"]), "")
    audits = cut_lineage(audits.groupBy("conv_id").agg(whole.alias("audit")))
    sums = crossed.join(ends.select("seg", "cost", "clash"), "seg").groupBy("conv_id").agg(
        *[F.sum(name).alias(name) for name in ("blank", "duplicate", "truncated")],
        (F.sum("illegal") + F.sum("clash")).alias("illegal"), F.min_by("cost", "seg").alias("cost"),
    )
    wide = lambda c: c.cast("decimal(38,0)")
    span = wide(F.max("turn")) - wide(F.min("turn")) + 1 - F.count_distinct("turn")
    gaps = turns.groupBy("conv_id").agg(F.coalesce(span.try_cast("bigint"), F.lit(0)).alias("gaps"))
    out = gaps
    for other in (sums, audits, _walked(turns, audits, digests=True)):
        side = other.withColumnRenamed("conv_id", "of")
        out = out.join(side, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
    return out.select("conv_id", *COUNTS, "audit", "repaired_sha256")


def repair_conversations(turns: DataFrame, ids: DataFrame | None = None, longest: int = LONGEST) -> DataFrame:
    """What is wrong with each conversation, and its cheapest repair.

    turns: conv_id, turn, role, text. Returns conv_id, gaps (turn numbers missing between
    the least and the greatest), blank, duplicate and truncated (turns whose first fault
    it is), illegal (neighbours whose roles start neither su, ua nor au), cost, audit
    (the least of the cheapest edits' letters) and repaired_sha256 (of the repaired turns
    `role:text`, joined by line ends). `repaired_turns` gives the repaired turns.

    Defined cases: a null role or text counts as one space; rows are ordered by turn (nulls
    first), then role, then text; repeated rows are duplicates; a null conv_id is a
    conversation like others; the conversations of `ids` (a table with conv_id) that
    have no turns are reported with zeros, an empty audit and the digest of an empty
    string; further columns are left out; empty tables give no rows.

    Conversations of up to `longest` turns are held by a task; of longer ones a task holds a
    segment of so many turns. Of these, what meets in one place is a small matrix for
    each segment, and the audit, which is one value. A digest is made turn by turn.
    """
    rows = described(turns)
    small, large = split_by_group_size(rows, ["conv_id"], longest)
    report = _ordinary(small)
    if large is not None:
        report = report.unionByName(_long(large, longest))
    if ids is None:
        return report
    report = cut_lineage(report).withColumnRenamed("conv_id", "of")
    out = ids.select("conv_id").distinct().join(report, F.col("conv_id").eqNullSafe(F.col("of")), "left")
    return out.select(
        "conv_id", *[F.coalesce(name, F.lit(0)).cast("bigint").alias(name) for name in COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(NO_TURNS)).alias("repaired_sha256"),
    )


def repaired_turns(turns: DataFrame, report: DataFrame) -> DataFrame:
    """conv_id, place (from 0), edit (K, R or I), role and text of the repaired turns.

    `report` is what repair_conversations says of the same turns.
    """
    rows = described(turns)
    known = rows.select("conv_id").distinct().withColumnRenamed("conv_id", "of")
    audits = report.join(known, F.col("conv_id").eqNullSafe(F.col("of")), "left_semi")
    return _walked(rows, audits.select("conv_id", "audit"), digests=False)


def repair_sql(table: str = "conversations") -> str:
    """The damage and its repair in SQL: from the last turn to the first, every state keeps
    its cheapest edits, the least audit among them."""
    return rf"""
WITH RECURSIVE codes AS MATERIALIZED (
  SELECT list(c ORDER BY n) AS code FROM (
    SELECT n, list_reduce([n::ubigint] || [0, 0, 0, 0, 0, 0, 0, 0]::ubigint[],
      lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::ubigint) ELSE c >> 1 END) AS c
    FROM range(256) AS r(n))),
named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') AS name FROM {table}),
harmed AS (
  SELECT conv_id, turn, role, text, xor(list_reduce([4294967295::ubigint]
    || list_transform(range(1, len(name) + 1), lambda i: ascii(substr(name, i::bigint, 1))::ubigint),
    lambda c, b: xor(c >> 8, code[(xor(c, b) & 255::ubigint)::bigint + 1])), 4294967295::ubigint) % 20 AS harm
  FROM named, codes),
turns AS (
  SELECT conv_id, turn, CASE harm WHEN 4 THEN 'user' ELSE role END AS role,
    CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE harm WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM harmed WHERE harm <> 0),
placed AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS initial,
    right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again
  FROM turns),
faults AS MATERIALIZED (
  SELECT conv_id, turn, role, text, initial, i, last = '' AS blank, last <> '' AND again AS duplicate,
    last = '' OR again AS gone, last NOT IN ('.', '!', '?') AS open,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
    count(*) FILTER (open AND NOT gone) AS truncated,
    count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM faults GROUP BY conv_id),
inserts(q, q1, c, a, t) AS (VALUES
  (0, 0, 0, '', []::varchar[]), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
  (0, 2, 3, 'I', ['user:']), (0, 3, 6, 'II', ['user:', 'assistant:']), (1, 2, 3, 'I', ['user:']),
  (1, 3, 6, 'II', ['user:', 'assistant:']), (2, 3, 3, 'I', ['assistant:']), (3, 2, 3, 'I', ['user:'])),
arcs(q1, q2, letter, initial) AS (VALUES
  (0, 0, 'D', ''), (1, 1, 'D', ''), (2, 2, 'D', ''), (3, 3, 'D', ''),
  (0, 1, 'K', 's'), (0, 2, 'K', 'u'), (1, 2, 'K', 'u'), (2, 3, 'K', 'a'), (3, 2, 'K', 'u'),
  (0, 2, 'R', ''), (1, 2, 'R', ''), (2, 3, 'R', ''), (3, 2, 'R', '')),
best AS (
  SELECT conv_id, n + 1 AS i, q, {{'c': c, 'a': a, 't': t}} AS found
  FROM counts, inserts WHERE (q = 0 AND q1 = 0) OR (q > 0 AND q1 = 3)
  UNION ALL
  SELECT f.conv_id, f.i, s.q, min({{
    'c': s.c + CASE letter WHEN 'D' THEN 4 ELSE CASE letter WHEN 'R' THEN 3 ELSE 0 END + CASE WHEN f.open THEN 3 ELSE 0 END END
      + b.found.c,
    'a': s.a || letter || b.found.a,
    't': list_concat(list_concat(s.t, CASE letter WHEN 'D' THEN [] WHEN 'K' THEN [f.role || ':' || f.text]
      ELSE [CASE r.q2 WHEN 2 THEN 'user:' ELSE 'assistant:' END || f.text] END), b.found.t)}})
  FROM best b JOIN faults f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.i = b.i - 1
    JOIN arcs r ON r.q2 = b.q AND (letter = 'D' OR NOT f.gone) AND (letter <> 'K' OR r.initial = f.initial)
    JOIN inserts s ON s.q1 = r.q1
  GROUP BY f.conv_id, f.i, s.q)
SELECT o.conv_id, coalesce(gaps, 0)::bigint AS gaps, coalesce(blank, 0)::bigint AS blank,
  coalesce(duplicate, 0)::bigint AS duplicate, coalesce(truncated, 0)::bigint AS truncated,
  coalesce(illegal, 0)::bigint AS illegal, coalesce(b.found.c, 0)::bigint AS cost, coalesce(b.found.a, '') AS audit,
  sha256(coalesce(array_to_string(b.found.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM {table}) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id AND b.i = 1 AND b.q = 0"""
