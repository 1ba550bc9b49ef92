"""Chat formatting with minimum-cost role repair.

A conversation is legal if it is an optional system turn, then user and assistant turns in alternation, the user first
and the assistant last. A dynamic program over that automaton chooses, turn by turn, to keep a turn, merge it into the
turn before it, change its role, or put empty turns before it, at the least total cost. The result is rendered as ChatML.

Conversations are cut into segments, none longer than ``SEGMENT`` turns, in range partitions of conversation and turn.
The steps through a segment are one small matrix of least costs from state to state; matrices are chained per
conversation, then each segment is repaired between the states so found. So the longest conversation is shared by many
tasks, and a row is given per turn, never one per conversation.

Defined results. Turns are ordered by number, role and a hash of the text, nulls first; equal rows stay as many. Role names are taken
in lower case without outer spaces; a null or unknown role may become either role at no cost beyond that of relabelling. A
null text renders as an empty one. A null conversation id is an id. A conversation of system turns alone gets an empty
user and an empty assistant turn. Other columns are not read.
"""

from collections.abc import Callable
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from uttera.session import materialize

SEGMENT = 2048
ROLES = ("system", "user", "assistant")
START = 3
#: Costs of joining a turn to the one before, of a new role, and of an empty turn.
MERGE, RELABEL, INSERT = 1, 3, 4
_BIG = 1 << 40
#: Which role may follow each state; index 3 is the beginning.
NEXT = {0: (1,), 1: (2,), 2: (1,), START: (0, 1)}


def _ways() -> dict[tuple[int, int], tuple[int, ...]]:
    """Roles of the empty turns put between state a and a new turn of role b, the fewest."""
    ways = {}
    for a in NEXT:
        for b in range(3):
            for empty in chain([()], ((x,) for x in range(3)), ((x, y) for x in range(3) for y in range(3))):
                path = (a, *empty, b)
                if all(y in NEXT[x] for x, y in zip(path, path[1:], strict=False)):
                    ways[a, b] = empty
                    break
    return ways


WAYS = _ways()
#: Roles of the empty turns that end a conversation in each state.
ENDINGS = {0: (1, 2), 1: (2,), 2: (), START: ()}


def moves(role: int) -> list[tuple[int, int, int, str]]:
    """(state before, state after, cost, action) for a turn of a role; -1 is an unknown role. The cheapest first of each pair."""
    found = {}
    for a in NEXT:
        for b in range(3):
            changed = RELABEL * (role != b)
            options = []
            if a == b:
                options.append((MERGE + changed, "merge"))
            if (a, b) in WAYS:
                options.append((INSERT * len(WAYS[a, b]) + changed, "turn"))
            if options:
                found[a, b] = min(options)
    return [(a, b, *found[a, b]) for a, b in found]


MOVES = {role: moves(role) for role in (-1, 0, 1, 2)}


def step_matrix(role: int) -> np.ndarray:
    matrix = np.full((4, 4), _BIG, np.int64)
    for a, b, cost, _ in MOVES[role]:
        matrix[a, b] = cost
    return matrix


STEPS = {role: step_matrix(role) for role in MOVES}


def least(costs: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Product in which costs add up and the least remains."""
    return np.minimum((costs[..., :, None] + matrix).min(axis=-2), _BIG)


def through(roles: list[int]) -> np.ndarray:
    """Least cost from each state to each over a segment."""
    total = np.where(np.eye(4, dtype=bool), 0, _BIG)
    for role in roles:
        total = least(total, STEPS[role])
    return total


def choose(matrices: list[np.ndarray]) -> list[int]:
    """The state before each segment and the one after the last, on a way of least total cost."""
    costs = [np.array([_BIG, _BIG, _BIG, 0])]
    for matrix in matrices:
        costs.append(least(costs[-1], matrix))
    last = costs[-1] + np.array([INSERT * len(ENDINGS[s]) for s in range(4)])
    states = [int(np.argmin(last))]
    for matrix, entering in zip(reversed(matrices), reversed(costs[:-1]), strict=True):
        states.append(int(np.argmin(entering + matrix[:, states[-1]])))
    return states[::-1]


def repair(roles: list[int], entering: int, leaving: int) -> list[tuple[int, int, str, int]]:
    """(state before, state after, action, cost) per turn of a segment."""
    costs = [np.where(np.arange(4) == entering, 0, _BIG)]
    for role in roles:
        costs.append(least(costs[-1], STEPS[role]))
    state, done = leaving, []
    for role, before in zip(reversed(roles), reversed(costs[:-1]), strict=True):
        options = [(int(before[a]) + cost, a, action, cost) for a, b, cost, action in MOVES[role] if b == state]
        _, a, action, cost = min(options)
        done.append((a, state, action, cost))
        state = a
    return done[::-1]


def rendered(before: int, after: int, action: str, text: str, final: bool) -> str:
    """The turn's share of the conversation's ChatML: all shares in order make the whole."""
    if action == "merge":
        out = "\n" + text
    else:
        out = "" if before == START else "<|im_end|>\n"
        out += "".join(f"<|im_start|>{ROLES[r]}\n<|im_end|>\n" for r in WAYS[before, after])
        out += f"<|im_start|>{ROLES[after]}\n{text}"
    if final:
        out += "<|im_end|>\n" + "".join(f"<|im_start|>{ROLES[r]}\n<|im_end|>\n" for r in ENDINGS[after])
    return out


def over_runs(rows: DataFrame, by: int, function: Callable, schema: str) -> DataFrame:
    """``function(run, rest of its rows)`` for each run of equal first ``by`` columns; a run lies in one partition, together.

    Rows stream through; only one run is held at a time.
    """
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def packed(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)

    def stream(batches):
        flat = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
        out: list[tuple] = []
        for run, group in groupby(flat, key=lambda row: row[:by]):
            out += function(run, [row[by:] for row in group])
            if len(out) >= 1000:
                yield packed(out)
                out = []
        if out:
            yield packed(out)

    return rows.mapInArrow(stream, schema)


_OUT = "turn bigint, role_in string, role_out string, action string, inserted int, cost int, rendered string"


def format_chats(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A row per turn: role before and after, action, empty turns before (and, at the end, after) it, cost, rendered share.

    ``place`` orders the rows of a conversation.
    """
    code = F.coalesce(F.array_position(F.array(*map(F.lit, ROLES)), F.lower(F.trim(F.col("role")))) - 1, F.lit(-1)).cast("int")
    rows = turns.select(F.col(key).alias("key"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    # Range partitioning samples its keys to the driver, so whole texts are none of them.
    rows = rows.withColumn("tie", F.xxhash64("text"))
    order = ["key", "turn", "role", "tie"]
    count = max(1, int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = rows.repartitionByRange(count, *order).withColumn("part", F.spark_partition_id()).withColumn("code", code)
    # What a range partition holds may differ between runs of a plan, so it is written before it is read twice.
    placed = materialize(placed, "turns")
    number = F.row_number().over(Window.partitionBy("part", "key").orderBy(*order)) - 1
    placed = placed.withColumn("number", number).withColumn("block", F.floor(F.col("number") / SEGMENT).cast("int"))

    def matrix(run, segment):
        return [(*run, through([code for (code,) in segment]).reshape(-1).tolist())]

    kind = turns.schema[key].dataType.simpleString()
    # The window left each segment's rows together and in order, and no segment is longer than its bound.
    matrices = over_runs(placed.select("key", "part", "block", "code"), 3, matrix, f"key {kind}, part int, block int, matrix array<bigint>")

    def states(run, segments):
        passed = choose([np.array(m, np.int64).reshape(4, 4) for _, _, m in segments])
        last = len(segments) - 1
        return [(*run, part, block, passed[i], passed[i + 1], i == last) for i, (part, block, _) in enumerate(segments)]

    chained = matrices.repartition("key").sortWithinPartitions("key", "part", "block")
    bounds = over_runs(chained, 1, states, f"key {kind}, part int, block int, entering int, leaving int, final boolean")
    bounds = materialize(bounds, "bounds").withColumnsRenamed({"key": "_key", "part": "_part", "block": "_block"})
    same = [placed["key"].eqNullSafe(bounds["_key"]), placed["part"] == bounds["_part"], placed["block"] == bounds["_block"]]
    bounded = placed.join(bounds, same).repartition("key", "part", "block").sortWithinPartitions("key", "part", "block", "number")

    def repaired(run, segment):
        *_, entering, leaving, final = segment[0]
        done = repair([row[4] for row in segment], entering, leaving)
        out = []
        for i, ((number, turn, role, text, code, *_), (a, b, action, cost)) in enumerate(zip(segment, done, strict=True)):
            end = final and i == len(segment) - 1
            said = action if action == "merge" else "keep" if code == b else "relabel"
            empty = 0 if action == "merge" else len(WAYS[a, b])
            after = len(ENDINGS[b]) if end else 0
            share = rendered(a, b, action, text or "", end)
            out.append((run[0], (run[1] << 40) + number, turn, role, ROLES[b], said, empty + after, int(cost) + INSERT * after, share))
        return out

    chosen = bounded.select("key", "part", "block", "number", "turn", "role", "text", "code", "entering", "leaving", "final")
    return over_runs(chosen, 3, repaired, f"key {kind}, place bigint, {_OUT}").withColumnRenamed("key", key)
