"""Chat formatting: raw transcripts to turns with roles, by a hidden Markov model.

A transcript is lines. Each line has one observation: its speaker marker, if
any (``User:``, ``### Assistant``, ``[system]``, ``<|user|>``, ``Q:`` ...), and
whether it follows an empty line, is empty, ends in a question mark, or is
long. The states are a role that begins a turn or goes on with it. Start,
transition and emission probabilities are counted, with add-one smoothing, over
transcripts whose roles are known; Viterbi recovers the others' states, and
each run of lines from a beginning on is a turn, rendered canonically as
``<|role|>``, its text without marker, ``<|end|>``.

No task holds a transcript whole. Lines are range-sorted, so a transcript that
holds a third of all rows spans many tasks, and cut into blocks of at most
``BLOCK`` lines. A block's best scores from every state before it to every
state at its end are one small matrix. The matrices of a transcript, streamed
forward and then backward in order, fix the states at all block borders, and
each block is decoded between its own. The result is the exact Viterbi path.

Defined results: null and empty texts are one empty line; null ids are one
transcript; rows of a transcript are ordered by the order column, then text
(nulls first), repeated rows kept; extra columns are ignored; an unknown role
teaches nothing; a model without training rows goes by smoothing alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.functions.expressions import col
from tablesmith.llm.common import MAX_ID_BYTES, ByValue, saved, saved_for_join, shuffle_partitions

ROLES = ("system", "user", "assistant", "tool")
#: Speaker words and the role that each usually names (fixed values).
SPEAKERS = {"system": "system", "instruction": "system", "context": "system",
            "user": "user", "human": "user", "customer": "user", "question": "user", "q": "user",
            "assistant": "assistant", "ai": "assistant", "bot": "assistant", "agent": "assistant", "answer": "assistant",
            "a": "assistant", "tool": "tool", "function": "tool", "observation": "tool"}
MARKER = re.compile(r"\s*(?:#{1,6}\s*|\*\*|\[|<\||-\s*)?(" + "|".join(sorted(SPEAKERS, key=len, reverse=True))
                    + r")\s*(?:\*\*\s*:?|\]\s*:?|\|>|[:>]\s*(?:\*\*)?|$)\s*", re.IGNORECASE | re.ASCII)
BARE = re.compile(r"\s*(?:#{1,6}\s*|\*\*|\[|<\||-\s*)")
LONG = 80
BLOCK = 2048
#: States: role r begins (2r) or goes on (2r + 1); before the first line: START.
STATES, START = 2 * len(ROLES), 2 * len(ROLES)
OBSERVATIONS = (len(ROLES) + 1) * 16


def observe(lines: list[str], after_empty: bool = True) -> tuple[list[int], list[str], bool]:
    """Observation numbers and marker-free texts of consecutive lines; whether the last one is empty."""
    numbers, texts = [], []
    for line in lines:
        m = MARKER.match(line)
        if m and not line[m.end(1):].strip() and not BARE.match(line):
            m = None                        # a lone speaker word in running text is no marker
        role = ROLES.index(SPEAKERS[m[1].lower()]) + 1 if m else 0
        text = line[m.end():] if m else line
        empty = not line.strip()
        numbers.append(((((role * 2 + after_empty) * 2 + empty) * 2 + text.rstrip().endswith("?")) * 2) + (len(text) > LONG))
        texts.append(text)
        after_empty = empty
    return numbers, texts, after_empty


class Model(ByValue):
    """Log probabilities: start and transitions (STATES + 1 rows, the last one START), emissions."""

    def __init__(self, transitions: np.ndarray, emissions: np.ndarray) -> None:
        allowed = np.zeros((STATES + 1, STATES), dtype=bool)
        allowed[:, 0::2] = True                                     # any role may begin a turn
        for r in range(len(ROLES)):
            allowed[[2 * r, 2 * r + 1], 2 * r + 1] = True           # only its own role goes on with one
        counts = np.where(allowed, transitions + 1.0, 0.0)
        with np.errstate(divide="ignore"):
            self.move = np.log(counts / counts.sum(axis=1, keepdims=True))
        # A role that begins shares its marker counts with nothing; smoothing keeps unseen lines possible.
        self.emit = np.log((emissions + 0.5) / (emissions + 0.5).sum(axis=1, keepdims=True))

    def span(self, numbers: np.ndarray) -> np.ndarray:
        """Best score from each state before the lines to each state at the last one: (STATES + 1, STATES)."""
        best = self.move + self.emit[:, numbers[0]]
        inner = self.move[:STATES]
        for o in numbers[1:]:
            best = (best[:, :, None] + inner).max(axis=1) + self.emit[:, o]
        return best

    def decode(self, numbers: np.ndarray, before: int, last: int) -> np.ndarray:
        """The best states of the lines between the state ``before`` and the state ``last`` of the last line."""
        best, inner, back = self.move[before] + self.emit[:, numbers[0]], self.move[:STATES], []
        for o in numbers[1:]:
            scores = best[:, None] + inner
            back.append(scores.argmax(axis=0))
            best = scores.max(axis=0) + self.emit[:, o]
        path = [last]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        return np.array(path[::-1])


def blocks(rows: DataFrame, *, id_col: str = "conv_id", order_col: str = "turn", text_col: str = "text",
           role_col: str | None = None) -> DataFrame:
    """conv, block (ascending along a transcript), numbers, texts and truth (states, -1 unknown) of at most BLOCK lines."""
    own = rows.select(col(id_col).cast("string").alias("conv"), col(order_col).cast("long").alias("place"),
                      col(text_col).cast("string").alias("text"),
                      (col(role_col).cast("string") if role_col else F.lit(None).cast("string")).alias("role"))
    ordered = own.repartitionByRange(shuffle_partitions(rows.sparkSession), "conv", "place", "text") \
        .sortWithinPartitions("conv", "place", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made = TaskContext.get().partitionId() << 32, 0
        conv, numbers, texts, truth, empty = None, [], [], [], True

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array([conv], pa.string()), pa.array([first + made], pa.int64()), pa.array([numbers], pa.list_(pa.int32())),
                 pa.array([texts], pa.list_(pa.string())), pa.array([truth], pa.list_(pa.int32()))],
                names=["conv", "block", "numbers", "texts", "truth"])

        for batch in batches:
            for c, text, role in zip(*(batch.column(x).to_pylist() for x in ("conv", "text", "role"))):
                if c != conv and numbers:
                    yield out()
                    made, numbers, texts, truth = made + 1, [], [], []
                if c != conv:
                    conv, empty = c, True
                state = 2 * ROLES.index(role) if role in ROLES else -1
                got, plain, empty = observe((text or "").split("\n"), empty)
                numbers, texts = numbers + got if numbers else got, texts + plain if texts else plain
                truth = truth + [state, *[state + (state >= 0)] * (len(got) - 1)]
                while len(numbers) > BLOCK:
                    rest = numbers[BLOCK:], texts[BLOCK:], truth[BLOCK:]
                    numbers, texts, truth = numbers[:BLOCK], texts[:BLOCK], truth[:BLOCK]
                    yield out()
                    made, (numbers, texts, truth) = made + 1, rest
        if numbers:
            yield out()

    return ordered.mapInArrow(run, "conv string, block long, numbers array<int>, texts array<string>, truth array<int>")


def train(labelled: DataFrame) -> Model:
    """Counts over blocks with known states, summed by Spark; transitions inside blocks, and into their first lines from START."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moves, emits = np.zeros((STATES + 1, STATES), np.int64), np.zeros((STATES, OBSERVATIONS), np.int64)
        for batch in batches:
            for numbers, truth in zip(batch.column("numbers").to_pylist(), batch.column("truth").to_pylist()):
                o, s = np.array(numbers), np.array(truth)
                known = s >= 0
                np.add.at(emits, (s[known], o[known]), 1)
                both = known[1:] & known[:-1]
                np.add.at(moves, (s[:-1][both], s[1:][both]), 1)
                if known[0] and s[0] % 2 == 0:
                    moves[START, s[0]] += 1
        counts = np.concatenate((moves.ravel(), emits.ravel()))
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())], names=["cell", "n"])

    counts = np.zeros((STATES + 1) * STATES + STATES * OBSERVATIONS)
    for r in labelled.mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        counts[r["cell"]] = r["n"]
    cut = (STATES + 1) * STATES
    return Model(counts[:cut].reshape(STATES + 1, STATES), counts[cut:].reshape(STATES, OBSERVATIONS))


def _streamed(rows: DataFrame, step, schema: str, ascending: bool) -> DataFrame:
    """``step(state, row) -> (state, output row)`` along the blocks of each transcript, in order; one row is held at a time."""
    names = rows.columns
    ordered = rows.repartition(F.xxhash64("conv")).sortWithinPartitions("conv", F.col("block").asc() if ascending else F.col("block").desc())
    out_names = [f.strip().split()[0] for f in schema.split(",")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, begun = None, None, False
        for batch in batches:
            out = []
            for row in zip(*(batch.column(c).to_pylist() for c in names)):
                row = dict(zip(names, row))
                if not begun or row["conv"] != conv:
                    conv, state, begun = row["conv"], None, True
                state, made = step(state, row)
                out.append(made)
            kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], kinds[f.strip().split()[1]])
                                              for i, f in enumerate(schema.split(","))], names=out_names)

    return ordered.mapInArrow(run, schema)


def _small(per_block: DataFrame, what: str) -> DataFrame:
    """A few numbers per block, stored; broadcast when measured to be small, so that the blocks' texts stay where they are."""
    return saved_for_join(per_block, what, 24, MAX_ID_BYTES)


def turns(cut: DataFrame, model: Model) -> DataFrame:
    """conv, turn (from 0), role, text and rendered, of blocks that are a stored table."""
    shared = cut.sparkSession.sparkContext.broadcast(model)

    def spans(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.span(np.array(n)).tobytes() for n in batch.column("numbers").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("block"), pa.array(found, pa.binary())],
                                             names=["conv", "block", "span"])

    def forward(state, row):
        before = np.append(np.full(STATES, -np.inf), 0.0) if state is None else state
        after = (before[:, None] + np.frombuffer(row["span"]).reshape(STATES + 1, STATES)).max(axis=0)
        after = np.append(after - after.max(), -np.inf)
        return after, (row["conv"], row["block"], row["span"], before.tobytes(), int(after[:STATES].argmax()))

    def backward(state, row):
        last = row["best"] if state is None else state
        before = int((np.frombuffer(row["before"]) + np.frombuffer(row["span"]).reshape(STATES + 1, STATES)[:, last]).argmax())
        return before, (row["conv"], row["block"], before, last)

    measured = cut.select("conv", "block", "numbers").mapInArrow(spans, "conv string, block long, span binary")
    scored = _streamed(measured, forward, "conv string, block long, span binary, before binary, best int", True)
    borders = _small(_streamed(scored, backward, "conv string, block long, entry int, last int", False).drop("conv"), "borders")

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, block, numbers, texts, entry, last in zip(*(batch.column(c).to_pylist() for c in
                                                                   ("conv", "block", "numbers", "texts", "entry", "last"))):
                states = shared.value.decode(np.array(numbers), entry, last)
                begins = np.flatnonzero(states % 2 == 0).tolist()
                for k, (a, b) in enumerate(zip([0, *[x for x in begins if x]], [*[x for x in begins if x], len(texts)])):
                    # A part before the block's first beginning belongs to the turn before: part number -1.
                    out.append((conv, block, k if 0 in begins else k - 1, len(begins), ROLES[states[a] // 2], "\n".join(texts[a:b])))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(
                (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string()))],
                names=["conv", "block", "part", "begins", "role", "text"])

    parts = saved(cut.select("conv", "block", "numbers", "texts").join(borders, "block")
                  .select("conv", "block", "numbers", "texts", "entry", "last")
                  .mapInArrow(decode, "conv string, block long, part int, begins int, role string, text string"), "turn-parts")

    def number(state, row):
        return (state or 0) + row["begins"], (row["conv"], row["block"], state or 0)

    numbered = _small(_streamed(parts.select("conv", "block", "begins").distinct(), number,
                                "conv string, block long, so_far long", True).drop("conv"), "turn-numbers")
    whole = parts.join(numbered, "block") \
        .groupBy("conv", (F.col("so_far") + F.col("part")).alias("turn")) \
        .agg(F.sort_array(F.collect_list(F.struct("block", "role", "text"))).alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["text"]), "\n")
    trimmed = F.regexp_replace(text, r"^\s*\n|\s+$", "")
    return whole.select("conv", "turn", F.col("parts")[0]["role"].alias("role"), trimmed.alias("text")) \
        .withColumn("rendered", F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.col("text"), F.lit("\n<|end|>\n")))


def recover(transcripts: DataFrame, model: Model, **columns: str) -> DataFrame:
    """The turns of raw transcripts (id, order and text columns): conv, turn, role, text, rendered."""
    return turns(saved(blocks(transcripts, **columns), "chat-blocks"), model)
