"""Chat transcripts: roles of unlabelled lines by a hidden Markov model, then canonical turns.

States are a role and whether the line begins a turn or goes on with it. A line emits features: the kind of speaker
marker it opens with, its length, how it ends and how it begins. Transitions and emissions are smoothed
counts over labelled transcripts; Viterbi finds the best states of a conversation.

A long conversation is cut into blocks of counted lines, so that none is too large for a task. Each block becomes a matrix of best scores
from the state before it to its last state; the products of these small matrices give the states at
the borders, and each block is then solved between its own, which gives the same path as one run over all lines.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skygrain.llm.common import bounds, grouped
from skygrain.operators.selection import sorted_table
from skygrain.session import durable, small_side

ROLES = ["user", "assistant", "system"]
STATES = 2 * len(ROLES)  # role * 2, plus 1 where the line goes on with a turn
# Lines of a conversation that are solved together.
BLOCK_LINES = 4096
_NO_KEY = -(1 << 63)
_WORDS = {"user": 0, "human": 0, "customer": 0, "prompt": 0, "instruction": 0, "question": 0, "q": 0,
          "assistant": 1, "ai": 1, "bot": 1, "model": 1, "response": 1, "answer": 1, "a": 1, "system": 2, "context": 2}
_MARKER = re.compile(r"\s*(?:#{1,6}\s*|\*\*|<\|?|\[)?\s*(" + "|".join(sorted(_WORDS, key=len, reverse=True)) + r")\s*(?:[:>\]]|\|>|\*\*)+\s*", re.IGNORECASE)
# Values of each feature: marker (a role, or none), length, end, beginning.
SIZES = [4, 8, 4, 4]


def marker(line: str) -> tuple[int, int]:
    """Role a line's marker names, 3 for none, and the marker's length."""
    found = _MARKER.match(line)
    return (_WORDS[found[1].lower()], found.end()) if found else (3, 0)


def features(lines: list[str]) -> np.ndarray:
    """Values of the features of each line."""
    out = np.zeros((len(lines), len(SIZES)), np.int64)
    for k, line in enumerate(lines):
        role, end = marker(line)
        rest = line[end:].strip()
        last = 0 if not rest else 1 if rest[-1] == "?" else 2 if rest[-1] in ".!" else 3
        first = 0 if not rest else 1 if rest[0].isupper() else 2 if rest[0].isalpha() else 3
        out[k] = role, min(7, len(rest).bit_length() // 2 + (len(rest) > 0)), last, first
    return out


@dataclass(frozen=True)
class Model:
    start: np.ndarray  # log probabilities of the first state
    move: np.ndarray  # of a state after a state
    emit: list[np.ndarray]  # of a feature's value in a state

    def scores(self, lines: list[str]) -> np.ndarray:
        """Log probability of each line's features in each state."""
        values = features(lines)
        return sum((table[:, values[:, k]] for k, table in enumerate(self.emit)), np.zeros((STATES, len(lines)))).T

    def transfer(self, lines: list[str], first: bool) -> np.ndarray:
        """Best score from each state before the lines to each state of the last; in the first row only, if nothing is before."""
        scores = self.scores(lines)
        best = np.full((STATES, STATES), -np.inf)
        if first:
            best[0] = self.start + scores[0]
        else:
            best = self.move + scores[0]
        for row in scores[1:]:
            best = (best[:, :, None] + self.move[None]).max(axis=1) + row
        return best

    def viterbi(self, lines: list[str], before: int | None = None, last: int | None = None) -> np.ndarray:
        """Best states, after the state ``before`` and with the last state ``last``, where these are given."""
        scores = self.scores(lines)
        best = (self.start if before is None else self.move[before]) + scores[0]
        back = np.zeros((len(lines), STATES), np.int64)
        for k in range(1, len(lines)):
            through = best[:, None] + self.move
            back[k] = through.argmax(axis=0)
            best = through.max(axis=0) + scores[k]
        states = np.zeros(len(lines), np.int64)
        states[-1] = best.argmax() if last is None else last
        for k in range(len(lines) - 1, 0, -1):
            states[k - 1] = back[k, states[k]]
        return states


def transcripts(turns: DataFrame) -> DataFrame:
    """Unlabelled lines of conversations, with the true ``role`` and ``begins`` beside them for learning and testing.

    ``turns``: ``conv_id, turn, role, text``. Each conversation has a style of speaker markers; a fifth of the
    turns, by hash, has none. Text is split at line ends; a null text is an empty line.
    """
    styles = [("User: ", "Assistant: ", "System: "), ("Human: ", "AI: ", "Context: "), ("### Instruction:\n", "### Response:\n", "### System:\n"), ("[user] ", "[assistant] ", "[system] ")]
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(styles)))
    mark = F.lit("")
    for s, names in enumerate(styles):
        for role, name in zip(ROLES, names):
            mark = F.when((style == s) & (F.col("role") == role), F.lit(name)).otherwise(mark)
    bare = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(5)) == 0
    text = F.concat(F.when(bare, F.lit("")).otherwise(mark), F.coalesce(F.col("text"), F.lit("")))
    rows = turns.select("conv_id", F.coalesce("turn", F.lit(-1)).cast("long").alias("turn"), "role", F.posexplode(F.split(text, "\n")).alias("at", "line"))
    return rows.select("conv_id", (F.col("turn") * (1 << 20) + F.col("at")).alias("line_no"), "line", "role", (F.col("at") == 0).alias("begins"))


def _numbered(lines: DataFrame, *more: str | Column) -> DataFrame:
    """Lines with the block of ``BLOCK_LINES`` of their conversation that each is in: ``conv, line_no, line, place, block, blocks``.

    Lines are put in order and counted (``sorted_table``), so a block has that many lines whatever their numbers are: a conversation that holds a third
    of them, and lines of one number, fill as many blocks as others.
    """
    rows = lines.select(F.coalesce(F.col("conv_id").cast("long"), F.lit(_NO_KEY)).alias("conv"), F.coalesce("line_no", F.lit(-1)).cast("long").alias("line_no"),
                        F.coalesce("line", F.lit("")).alias("line"), *more)
    placed = durable(sorted_table(rows, ["conv", "line_no", "line"], "place"), "lines")
    ends = durable(placed.groupBy("conv").agg(F.min("place").alias("start"), F.count("*").alias("n")), "conversations")
    whole = F.expr(f"(n - 1) div {BLOCK_LINES} + 1").alias("blocks")
    return placed.join(small_side(ends.select("conv", "start", whole)), "conv").withColumn("block", F.expr(f"(place - start) div {BLOCK_LINES}")).drop("start")


def _dealt(numbered: DataFrame) -> DataFrame:
    """Lines in order within blocks; a block is in one partition."""
    return numbered.repartition("conv", "block").sortWithinPartitions("conv", "block", "place")


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Each block's lines."""
    for table in grouped(batches, ["conv", "block"]):
        ends = bounds(np.stack([table.column(k).to_numpy() for k in ("conv", "block")], axis=1))
        for a, b in zip(ends, ends[1:]):
            yield table.slice(a, b - a)


def learn(lines: DataFrame) -> Model:
    """Model of labelled lines (``conv_id, line_no, line, role, begins``); lines of other roles are skipped.

    Counts cover all lines; the step from one block of a conversation to the next is not counted. Without lines
    every path is alike.
    """
    cells = STATES + STATES * STATES + STATES * sum(SIZES)
    known = lines.filter(F.col("role").isin(ROLES))
    state = F.array_position(F.array(*[F.lit(r) for r in ROLES]), F.col("role")) * 2 - 2 + F.when(F.col("begins"), 0).otherwise(1)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells)
        for table in _groups(batches):
            states = table.column("state").to_numpy().astype(int)
            total[states[0]] += 1
            np.add.at(total, STATES + states[:-1] * STATES + states[1:], 1)
            at = STATES + STATES * STATES
            for size, column in zip(SIZES, features(table.column("line").to_pylist()).T):
                np.add.at(total, at + states * size + column, 1)
                at += STATES * size
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], ["cell", "n"])

    counts = _dealt(_numbered(known, state.cast("int").alias("state"))).mapInArrow(run, "cell long, n double").groupBy("cell").agg(F.sum("n").alias("n"))
    total = np.zeros(cells)
    for r in counts.collect():  # at most as many as there are cells
        total[r.cell] = r.n

    def logs(table: np.ndarray) -> np.ndarray:
        return np.log((table + 0.1) / (table + 0.1).sum(axis=-1, keepdims=True))

    emit, at = [], STATES + STATES * STATES
    for size in SIZES:
        emit.append(logs(total[at:at + STATES * size].reshape(STATES, size)))
        at += STATES * size
    return Model(logs(total[:STATES]), logs(total[STATES:STATES + STATES * STATES].reshape(STATES, STATES)), emit)


def _borders(numbered: DataFrame, model: Model) -> DataFrame | None:
    """``conv, block, before, last`` of the blocks of conversations that have more than one, or None.

    ``before`` is null in a first block. A conversation's blocks meet in one task: 36 numbers for each block.
    """
    mine = numbered.filter("blocks > 1")
    if mine.isEmpty():
        return None

    def transfers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            block = table.column("block")[0].as_py()
            matrix = model.transfer(table.column("line").to_pylist(), block == 0)
            yield pa.RecordBatch.from_arrays([pa.array([table.column("conv")[0].as_py()]), pa.array([block]), pa.array([matrix.tobytes()])], ["conv", "block", "matrix"])

    matrices = _dealt(mine).mapInArrow(transfers, "conv long, block long, matrix binary")

    def solve(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        matrices = [np.frombuffer(m).reshape(STATES, STATES) for m in table.column("matrix").to_pylist()]
        best, back = matrices[0][0], []
        for matrix in matrices[1:]:
            through = best[:, None] + matrix
            back.append(through.argmax(axis=0))
            best = through.max(axis=0)
        last = [int(best.argmax())]
        for step in reversed(back):
            last.append(int(step[last[-1]]))
        last.reverse()
        return pa.table({"conv": table.column("conv"), "block": table.column("block"),
                         "before": pa.array([None, *last[:-1]], pa.int32()), "last": pa.array(last, pa.int32())})

    return durable(matrices.groupBy("conv").applyInArrow(solve, "conv long, block long, before int, last int"), "borders")


def render(role: Column, text: Column) -> Column:
    """Canonical form of a turn."""
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), text, F.lit("<|im_end|>\n"))


def parse(lines: DataFrame, model: Model) -> DataFrame:
    """``conv_id, turn_line, role, n_lines, rendered``: the turns found in the lines, by the number of their first line.

    ``lines``: ``conv_id, line_no, line``; other columns are not read. Lines of a conversation are taken in
    the order of their numbers, equal numbers in the order of their texts, repeats included. A null line is an empty one,
    a null number comes before 0, lines without a ``conv_id`` are one conversation. The marker of a turn's
    first line is left out where it names the role found. An empty table has no turns.
    """
    numbered = durable(_numbered(lines), "numbered")
    borders = _borders(numbered, model)
    if borders is None:
        rows = _dealt(numbered.withColumn("before", F.lit(None).cast("int")).withColumn("last", F.lit(None).cast("int")))
    else:
        rows = _dealt(numbered.join(small_side(borders), ["conv", "block"], "left"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        for table in _groups(batches):
            texts, numbers, places = (table.column(c).to_pylist() for c in ("line", "line_no", "place"))
            before, last = table.column("before")[0].as_py(), table.column("last")[0].as_py()
            states = model.viterbi(texts, before, last)
            conv, block = table.column("conv")[0].as_py(), table.column("block")[0].as_py()
            begins = [k for k, s in enumerate(states) if s % 2 == 0 or k == 0 and before is None]
            starts = begins if begins and begins[0] == 0 else [0, *begins]
            for a, b in zip(starts, [*starts[1:], len(texts)]):
                role = int(states[a]) // 2
                some = texts[a:b]
                named, end = marker(some[0])
                if a in begins and named == role:
                    some[0] = some[0][end:]
                    some = some[1:] if not some[0] and len(some) > 1 else some
                found.append((conv, block, places[a], places[a] if a in begins else None, numbers[a], ROLES[role], b - a, "\n".join(some), last is not None))
            if len(found) >= 2000:
                yield _turns(found)
                found = []
        if found:
            yield _turns(found)

    parts = rows.mapInArrow(run, _TURNS)
    if borders is not None:
        parts = _joined(durable(parts, "turn-parts"))
    conv_id = F.when(F.col("conv") != _NO_KEY, F.col("conv"))
    return parts.select(conv_id.alias("conv_id"), "turn_line", "role", "n_lines", render(F.col("role"), F.col("text")).alias("rendered"))


_TURNS = "conv long, block long, place long, begin long, turn_line long, role string, n_lines int, text string, cut boolean"


def _turns(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [*[pa.int64()] * 5, pa.string(), pa.int32(), pa.string(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [f.split()[0] for f in _TURNS.split(", ")])


def _joined(parts: DataFrame) -> DataFrame:
    """Turns whose parts are in several blocks, put together; the others as they are."""
    whole, cut = parts.filter("not cut"), parts.filter("cut")
    ends = cut.groupBy("conv", "block").agg(F.max("begin").alias("latest"))
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = durable(ends.select("conv", "block", F.last("latest", ignorenulls=True).over(earlier).alias("carried")), "carried")
    # a turn goes by the place of its first line, as numbers may repeat
    cut = cut.join(carried, ["conv", "block"]).withColumn("begin", F.coalesce("begin", "carried"))
    ordered = F.sort_array(F.collect_list(F.struct("block", "place", "text", "n_lines", "role", "turn_line")))
    cut = cut.groupBy("conv", "begin").agg(ordered.alias("p")).select(
        "conv", F.expr("p[0].turn_line").alias("turn_line"), F.expr("p[0].role").alias("role"), F.expr("aggregate(p, 0, (n, x) -> n + x.n_lines)").alias("n_lines"), F.array_join("p.text", "\n").alias("text"))
    columns = ["conv", "turn_line", "role", "n_lines", "text"]
    return whole.select(*columns).union(cut.select(*columns))
