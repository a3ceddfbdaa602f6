"""Roles of transcript lines by a hidden Markov model, and the canonical form of turns.

A transcript is an ordered stream of lines. Every line is the first or a further one of a turn of one
role; these are the states. What is seen of a line is its speaker marker, whether it is blank or follows
a blank one, whether it asks, and its length. Probabilities are counted on transcripts whose roles are known.
Viterbi finds the likeliest states of all lines; lines of one turn are then rendered with the role's header.

A transcript may be longer than one task can hold. It is cut into blocks of source rows. Of every block
the best score from each state before it to each state at its end is computed, which is a small matrix
whatever the block's length. The matrices of a transcript are chained to find the states at all block
ends, and each block is decoded between its own two states. That is exactly what one pass over the
whole transcript gives. Rows are numbered over all transcripts by range partitions with counted offsets,
and a block is at most so many rows of a transcript, whatever their turns are. Matrices are multiplied (best
of sums) up a tree and the states are handed down it, so that no task sees all blocks of a transcript.

A turn that reaches over a block's end comes as several pieces in order; the pieces that go on have
``begins`` false, and the rendered pieces joined give the rendered transcript. Null text is a blank
line; a null turn comes first; rows that repeat are further lines; rows with the same turn are ordered
by text. A null conversation id is one conversation. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketfold.llm.common import staged, whole_text

ROLES = ("system", "user", "assistant")
STATES = 2 * len(ROLES)  # 2 * role for the first line of a turn, one more for the others

# Words that name a speaker before a colon or in brackets.
SPEAKERS = {
    "system": 0, "instruction": 0, "instructions": 0, "context": 0,
    "user": 1, "human": 1, "q": 1, "question": 1, "customer": 1, "prompter": 1,
    "assistant": 2, "ai": 2, "bot": 2, "a": 2, "answer": 2, "model": 2, "agent": 2,
}
MARKER = re.compile(
    r"\s*(?:(?:#+\s*|\*\*)?(\w+)\s*(?:\*\*)?:|[\[<(]\|?(\w+)\|?[\])>]:?)[ \t]*", re.IGNORECASE
)

# What a line shows: marker 4, blank 2 x after a blank 2, question 2, length 4.
WIDTHS = (4, 4, 2, 4)
END = "\n<|end|>\n"
BLOCK_TURNS = 256
FAN_IN = 64  # blocks, or products of them, that are multiplied in one group

# A last line that is blank, as ``str.strip`` sees it.
ENDS_BLANK = r"(^|\n)[\s\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]*\z"
MADE_UP = 0.5  # added to every count


def marker(line: str) -> tuple[int, int]:
    """The role a line's marker names, 3 without a marker, and where the line goes on after it."""
    found = MARKER.match(line)
    name = (found[1] or found[2]).lower() if found else None
    return (SPEAKERS[name], found.end()) if name in SPEAKERS else (3, 0)


def features(lines: list[str], after_blank: bool) -> np.ndarray:
    """One row of small numbers for each line."""
    rows = []
    for line in lines:
        blank = not line.strip()
        length = min(3, len(line) // 80)
        rows.append((marker(line)[0], 2 * blank + after_blank, line.rstrip().endswith("?"), length))
        after_blank = blank
    return np.array(rows, np.int64).reshape(-1, len(WIDTHS))


@dataclass(frozen=True)
class Model:
    """Log probabilities: of the first state, of the next state, and of each feature by state."""

    start: np.ndarray
    step: np.ndarray
    shows: tuple[np.ndarray, ...]

    def emission(self, seen: np.ndarray) -> np.ndarray:
        return sum(table[:, seen[:, i]].T for i, table in enumerate(self.shows))


def train(lines: DataFrame) -> Model:
    """From (before, state, f0..f3) rows; ``before`` is null at the start of a transcript."""
    counts = {"step": np.full((STATES, STATES), MADE_UP), "start": np.full(STATES, MADE_UP)}
    for before, state, n in lines.groupBy("before", "state").count().collect():
        if before is None:
            counts["start"][state] += n
        else:
            counts["step"][before, state] += n
    shows = []
    for i, width in enumerate(WIDTHS):
        table = np.full((STATES, width), MADE_UP)
        for state, value, n in lines.groupBy("state", f"f{i}").count().collect():
            table[state, value] += n
        shows.append(np.log(table / table.sum(axis=1, keepdims=True)))
    # A transcript begins a turn, and no turn goes on in another role.
    allowed = np.array([[b % 2 == 0 or b // 2 == a // 2 for b in range(STATES)] for a in range(STATES)])
    step = np.where(allowed, counts["step"], 1e-300)
    start = np.where(np.arange(STATES) % 2 == 0, counts["start"], 1e-300)
    return Model(
        np.log(start / start.sum()), np.log(step / step.sum(axis=1, keepdims=True)), tuple(shows)
    )


def transfer(model: Model, emission: np.ndarray) -> np.ndarray:
    """Best score of a block from each state before it (row) to each state at its end (column).

    The last row stands for a block that begins the transcript.
    """
    best = np.concatenate((model.step, model.start[None])) + emission[0]
    for shown in emission[1:]:
        best = (best[:, :, None] + model.step[None]).max(axis=1) + shown
    return best


def decode(model: Model, emission: np.ndarray, before: int | None, end: int | None) -> list[int]:
    """The likeliest states of a block between its two states; of a whole transcript if unset."""
    first = model.start if before is None else model.step[before]
    score = first + emission[0]
    back = []
    for shown in emission[1:]:
        reached = score[:, None] + model.step
        back.append(reached.argmax(axis=0))
        score = reached.max(axis=0) + shown
    path = [int(score.argmax()) if end is None else end]
    for pointers in reversed(back):
        path.append(int(pointers[path[-1]]))
    return path[::-1]


def labelled_lines(turns: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """Training rows of :func:`train` from (conv, turn, role, text) rows with known roles."""
    placed = turns.select(
        "conv", F.col("turn").cast("long").alias("turn"), whole_text("text").alias("text"), "role"
    )
    role = F.array_position(F.array(*map(F.lit, ROLES)), F.col("role")) - 1
    state = (2 * role + F.col("text").contains("\n").cast("int")).cast("int")
    placed, _ = _in_blocks(placed, block_turns)
    return _with_line_before(placed, state).groupBy("conv", "block").applyInArrow(
        _label, "before int, state int, f0 int, f1 int, f2 int, f3 int"
    )


def parse(rows: DataFrame, model: Model, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """Turns of transcripts: (conv, turn, line, role, begins, text, rendered).

    ``rows`` has (conv, turn, text): a transcript's source rows in order of ``turn``, each with one or
    more lines. ``turn`` and ``line`` of the result tell where a piece begins.
    """
    kind = rows.schema["conv"].dataType.simpleString()
    placed = rows.select(
        "conv", F.col("turn").cast("long").alias("turn"), whole_text("text").alias("text")
    )
    placed, number = _in_blocks(placed, block_turns)
    blocks = staged(_with_line_before(placed, F.lit(0)))
    matrices = staged(
        blocks.groupBy("conv", "block").applyInArrow(
            lambda table: _transfer(table, model), f"conv {kind}, block long, best array<double>"
        )
    )
    bounds = _bounds(matrices, number, kind)
    return _null_safe(blocks, bounds).groupBy("conv", "block").applyInArrow(
        lambda table: _pieces(table, model),
        f"conv {kind}, turn long, line int, role string, begins boolean, text string, rendered string",
    )


def _in_blocks(rows: DataFrame, block_turns: int) -> tuple[DataFrame, int]:
    """Rows with their place ``at`` in the order of all and their ``block``, and how many blocks there are.

    The blocks of a transcript follow each other without a gap. Rows that are the same in everything
    are told apart by any number, so that they too are dealt over many tasks.
    """
    order = [*rows.columns, "tie"]
    dealt = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order)
    dealt = dealt.sortWithinPartitions(*order).drop("tie")
    dealt = staged(dealt.withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33).cast("int")
    # One row for every partition that has rows.
    sizes = dict(map(tuple, dealt.groupBy(part).count().collect()))
    offsets, total = [], 0
    for i in range(max(sizes, default=0) + 1):
        offsets.append(total)
        total += sizes.get(i, 0)
    first = F.get(F.array(*[F.lit(n).cast("long") for n in offsets]), part)
    dealt = dealt.withColumn("at", first + F.col("at").bitwiseAND((1 << 33) - 1))
    return dealt.withColumn("block", F.floor(F.col("at") / block_turns)), total // block_turns + 1


def _with_line_before(placed: DataFrame, state: Column) -> DataFrame:
    """Adds what is known of the last line before the block: its state, and whether it is blank.

    A transcript begins after a blank line and after no state.
    """
    last = F.struct(state.alias("state"), F.col("text").rlike(ENDS_BLANK).alias("blank"))
    ends = placed.groupBy("conv", "block").agg(F.max_by(last, "at").alias("last"))
    following = ends.select(
        F.col("conv").alias("conv_r"), (F.col("block") + 1).alias("block_r"), F.col("last")
    )
    same = F.col("conv").eqNullSafe(F.col("conv_r")) & (F.col("block") == F.col("block_r"))
    return placed.join(following, same, "left").select(
        *placed.columns,
        F.col("last.state").alias("state_before"),
        F.coalesce("last.blank", F.lit(True)).alias("after_blank"),
    )


def _bounds(matrices: DataFrame, number: int, kind: str) -> DataFrame:
    """(conv, block, before, end, final) of every block: its states on the best path of its transcript."""
    levels = [matrices]
    while number > 1:
        number = -(-number // FAN_IN)
        up = levels[-1].withColumn("parent", F.floor(F.col("block") / FAN_IN))
        product = up.groupBy("conv", "parent").applyInArrow(
            _product, f"conv {kind}, block long, best array<double>"
        )
        levels.append(staged(product))
    columns = f"conv {kind}, block long, before int, end int, final boolean"
    bounds = levels.pop().mapInArrow(_roots, columns)
    for level in reversed(levels):
        parents = staged(bounds).withColumnsRenamed({"conv": "conv_r", "block": "block_r"})
        down = level.withColumn("parent", F.floor(F.col("block") / FAN_IN))
        same = F.col("conv").eqNullSafe(F.col("conv_r")) & (F.col("parent") == F.col("block_r"))
        down = down.join(parents, same).drop("conv_r", "block_r")
        bounds = down.groupBy("conv", "parent").applyInArrow(_hand_down, columns)
    return staged(bounds)


def render(role: str, text: str, begins: bool, first: bool, last: bool) -> str:
    """A piece of a turn in canonical form; the pieces of a transcript in order make it up.

    ``first`` and ``last`` tell whether it is the first or the last piece of the transcript.
    """
    head = f"{'' if first else END}<|{role}|>\n" if begins else "\n"
    return head + text + (END if last else "")


def _null_safe(left: DataFrame, right: DataFrame) -> DataFrame:
    right = right.withColumnsRenamed({"conv": "conv_r", "block": "block_r"})
    same = F.col("conv").eqNullSafe(F.col("conv_r")) & (F.col("block") == F.col("block_r"))
    return left.join(right, same).drop("conv_r", "block_r")


def _in_order(table: pa.Table) -> pa.Table:
    return table.sort_by("at")


def _split(table: pa.Table) -> tuple[list[str], list[tuple[int | None, int]]]:
    lines, where = [], []
    for turn, text in zip(table["turn"].to_pylist(), table["text"].to_pylist(), strict=True):
        for i, line in enumerate((text or "").split("\n")):
            lines.append(line)
            where.append((turn, i))
    return lines, where


def _label(table: pa.Table) -> pa.Table:
    table = _in_order(table)
    states, lines = [], []
    for role, text in zip(table["role"].to_pylist(), table["text"].to_pylist(), strict=True):
        own = (text or "").split("\n")
        lines += own
        base = 2 * ROLES.index(role)
        states += [base] + [base + 1] * (len(own) - 1)
    seen = features(lines, table["after_blank"][0].as_py())
    before = [table["state_before"][0].as_py(), *states[:-1]]
    columns = {"before": pa.array(before, pa.int32()), "state": pa.array(states, pa.int32())}
    columns |= {f"f{i}": pa.array(seen[:, i], pa.int32()) for i in range(len(WIDTHS))}
    return pa.table(columns)


def _emission(table: pa.Table, model: Model) -> tuple[np.ndarray, list[str], list]:
    lines, where = _split(_in_order(table))
    return model.emission(features(lines, bool(table["after_blank"][0].as_py()))), lines, where


def _transfer(table: pa.Table, model: Model) -> pa.Table:
    best = transfer(model, _emission(table, model)[0])
    head = table.select(["conv", "block"]).slice(0, 1)
    return head.append_column("best", pa.array([best.ravel().tolist()], pa.list_(pa.float64())))


def _matrices(table: pa.Table) -> list[np.ndarray]:
    return [np.array(m).reshape(STATES + 1, STATES) for m in table["best"].to_pylist()]


def _product(table: pa.Table) -> pa.Table:
    table = table.sort_by("block")
    first, *others = _matrices(table)
    for matrix in others:
        first = (first[:, :, None] + matrix[None, :-1]).max(axis=1)
    head = table.select(["conv", "parent"]).slice(0, 1).rename_columns(["conv", "block"])
    return head.append_column("best", pa.array([first.ravel().tolist()], pa.list_(pa.float64())))


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bounds of whole transcripts; there is no state before them."""
    for batch in batches:
        ends = [int(matrix[-1].argmax()) for matrix in _matrices(batch)]
        yield pa.RecordBatch.from_arrays(
            [
                batch["conv"],
                batch["block"],
                pa.nulls(len(ends), pa.int32()),
                pa.array(ends, pa.int32()),
                pa.array([True] * len(ends), pa.bool_()),
            ],
            ["conv", "block", "before", "end", "final"],
        )


def _hand_down(table: pa.Table) -> pa.Table:
    """Bounds of blocks from the bounds of their product."""
    table = table.sort_by("block")
    before, end = table["before"][0].as_py(), table["end"][0].as_py()
    matrices = _matrices(table)
    score, back = matrices[0][STATES if before is None else before], []
    for matrix in matrices[1:]:
        reached = score[:, None] + matrix[:-1]
        back.append(reached.argmax(axis=0))
        score = reached.max(axis=0)
    ends = [end]
    for pointers in reversed(back):
        ends.append(int(pointers[ends[-1]]))
    ends = ends[::-1]
    final = [False] * (len(ends) - 1) + [table["final"][0].as_py()]
    return (
        table.select(["conv", "block"])
        .append_column("before", pa.array([before, *ends[:-1]], pa.int32()))
        .append_column("end", pa.array(ends, pa.int32()))
        .append_column("final", pa.array(final, pa.bool_()))
    )


def _pieces(table: pa.Table, model: Model) -> pa.Table:
    emission, lines, where = _emission(table, model)
    before, end = table["before"][0].as_py(), table["end"][0].as_py()
    states = decode(model, emission, before, end)
    starts = [i for i, state in enumerate(states) if i == 0 or state % 2 == 0]
    out = []
    for a, b in zip(starts, [*starts[1:], len(states)], strict=True):
        role, begins = ROLES[states[a] // 2], states[a] % 2 == 0
        own = list(lines[a:b])
        if begins:
            own[0] = own[0][marker(own[0])[1] :]
        text = "\n".join(own)
        first = a == 0 and before is None
        last = b == len(states) and table["final"][0].as_py()
        out.append((*where[a], role, begins, text, render(role, text, begins, first, last)))
    conv = table["conv"].combine_chunks().take(pa.array([0] * len(out)))
    names = ["turn", "line", "role", "begins", "text", "rendered"]
    kinds = [pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.string(), pa.string()]
    columns = [pa.array(column, kind) for column, kind in zip(zip(*out, strict=True), kinds, strict=True)]
    return pa.table([conv, *columns], ["conv", *names])
