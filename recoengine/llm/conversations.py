"""Repair of conversation structure with the cheapest edits.

Every row of a conversation is kept, given another role, or deleted, and empty
user or assistant rows may be inserted, so that the roles' initials read
``(s?(ua)+)?``. The roles put out so far leave one of four states (nothing, after
a system, a user, an assistant row), so the cheapest edits are a shortest path.

Secondary-sorted streaming: rows are dealt by conversation and sorted by turn,
last first; ``mapInPandas`` carries, across Arrow batches, the cost of the best
edits from here to the end for each state. Each row leaves a backpointer of one
byte: the first letter of the best edits in each of the four states, ASCII-least
among equals. Reading the backpointers from the first row on gives the edits. A
conversation of up to ``BUFFER_ROWS`` rows and ``BUFFER_BYTES`` of text is read back in
the same task. A longer one is not held: its rows and backpointers are spilled
to a table in the shared folder and streamed once more, first row first. Either
way a task holds the buffer at most, and the result is the same. The SHA-256 of
a repaired conversation is a chain over its rows, so one task reads through a
giant conversation, row by row; whether a row repeats an earlier one is settled
before, by a join that splits hot conversations.

Defined results: a null role or text counts as one space, a null conversation id
is a conversation of its own; null turns come first; rows of one turn are
ordered by role, then text (UTF-8 bytes); repeated rows are duplicates; a role
whose initial is not s, u or a can't be kept; an empty table gives no rows;
further columns stay unread. Very long texts: a row is read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recoengine.llm.common import save, table

BUFFER_ROWS = 100_000
BUFFER_BYTES = 16 << 20

SPACES = " \t\n\v\f\r"
FULL_STOPS = "[.!?]"

START, SYSTEM, USER, ASSISTANT = range(4)
#: Role that each state asks for next, and the state after it.
WANTED = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
AFTER = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: (state, initial of a kept role): the state after it.
KEEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
LEGAL_PAIRS = {"su", "ua", "au"}
COST = {"D": 3, "I": 2, "K": 0, "R": 2}
LETTERS = "DIKR"
TRUNCATED = 1
#: Cost from each state to the end when no row is left, and the edits.
END_COST = (0, 4, 2, 0)
END_EDITS = ("", "II", "I", "")

def damaged(rows: DataFrame) -> DataFrame:
    """The rows as a lossy store might return them, one way by each row's own
    hash: dropped (a flag here), emptied, without full stops, repeated, or with
    role user."""
    space = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    return rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, FULL_STOPS, "")).otherwise(text).alias("text"),
        (kind == 0).alias("dropped"), F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))


def with_faults(rows: DataFrame) -> DataFrame:
    """Adds each row's first fault: blank, duplicate, truncated or none. A
    (conversation, role, text) is reduced to its first place before the shuffle,
    by digest, and joined back from a table, so a hot one is split."""
    digest = F.unhex(F.sha2(F.concat(F.sha2("role", 256), "text"), 256))
    numbered = save(rows.withColumns({"digest": digest, "row": F.monotonically_increasing_id()}), "numbered")
    place = F.struct(F.col("turn").isNotNull(), "turn", "row")
    live = numbered.where(~F.col("dropped"))
    first = live.groupBy("conv_id", "digest").agg(F.min(place).alias("p"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = save(first.select(F.col("conv_id").alias("_conv"), F.col("digest").alias("_digest"), F.col("p.row").alias("_first")), "first-places")
    joined = numbered.join(first, numbered["conv_id"].eqNullSafe(first["_conv"]) & (numbered["digest"] == first["_digest"]), "left")
    ending = F.rtrim("text", F.lit(SPACES))
    fault = (F.when(ending == "", "blank").when(F.col("_first") != F.col("row"), "duplicate")
             .when(~F.substring(ending, -1, 1).rlike(FULL_STOPS), "truncated"))
    return joined.select(*rows.columns, fault.alias("fault"))


@dataclass
class Repair:
    """What is known of one conversation, filled while its rows go by from the
    last to the first."""
    cost: tuple[int, ...] = END_COST
    counts: dict[str, int] = field(default_factory=lambda: {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0})
    turns: int = 0
    highest: int | None = None
    lowest: int | None = None
    next_initial: str = ""

    def before(self, role: str, fault: str | None, turn: int | None) -> int:
        """Take the row before; its backpointer."""
        if fault:
            self.counts[fault] += 1
        initial = role[:1]
        if self.next_initial and initial + self.next_initial not in LEGAL_PAIRS:
            self.counts["illegal"] += 1
        self.next_initial = initial or " "
        if turn is not None:
            if turn != self.lowest:
                self.turns += 1
            self.highest = turn if self.highest is None else self.highest
            self.lowest = turn
        keep, late = fault not in ("blank", "duplicate"), TRUNCATED if fault == "truncated" else 0
        options: list[dict[str, int]] = []
        for state in range(4):
            o = {"D": COST["D"] + self.cost[state]}
            if keep:
                o["R"] = COST["R"] + late + self.cost[AFTER[state]]
                if (state, initial) in KEEP:
                    o["K"] = COST["K"] + late + self.cost[KEEP[state, initial]]
            options.append(o)
        best = [min(o.values()) for o in options]
        for _ in range(3):  # an inserted row leaves another state before the same row
            best = [min(b, COST["I"] + best[AFTER[s]]) for s, b in enumerate(best)]
        pointer = 0
        for state, o in enumerate(options):
            o["I"] = COST["I"] + best[AFTER[state]]
            letter = min(x for x, c in o.items() if c == best[state])
            pointer |= LETTERS.index(letter) << 2 * state
        self.cost = tuple(best)
        return pointer

    def gaps(self) -> int:
        return 0 if self.highest is None else self.highest - self.lowest + 1 - self.turns


class Edits:
    """Reads the backpointers from the first row on."""

    def __init__(self) -> None:
        self.state, self.letters, self.sha, self.empty = START, [], hashlib.sha256(), True

    def _put(self, role: str, text: str) -> None:
        self.sha.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
        self.empty = False

    def _insert(self) -> None:
        self._put(WANTED[self.state], "")
        self.state = AFTER[self.state]

    def row(self, role: str, text: str, pointer: int) -> None:
        while (letter := LETTERS[pointer >> 2 * self.state & 3]) == "I":
            self.letters.append("I")
            self._insert()
        self.letters.append(letter)
        if letter == "K":
            self._put(role, text)
            self.state = KEEP[self.state, role[:1]]
        elif letter == "R":
            self._put(WANTED[self.state], text)
            self.state = AFTER[self.state]

    def end(self) -> tuple[str, str]:
        for letter in END_EDITS[self.state]:
            self.letters.append(letter)
            self._insert()
        return "".join(self.letters), self.sha.hexdigest()


SUMMARY = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
#: What the first pass emits: rows of giant conversations (``seq`` up to 0, last
#: row 0), their summaries (1) and finished conversations (2). Numbers that may be
#: missing travel as strings: pandas would turn them into doubles.
PASSED = {"conv_id": "string", "seq": "long", "role": "string", "text": "string", "pointer": "int",
          "summary": "string", "audit": "string", "repaired_sha256": "string"}


def _backward(buffer_rows: int, buffer_bytes: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """First pass, last rows first."""
    def kernel(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, repair, held, size, seq, spilled = None, None, [], 0, 0, False
        out: list[tuple] = []

        def spill() -> None:
            nonlocal held, size, seq, spilled
            for role, text, pointer in held:
                out.append((current, seq, role, text, pointer, None, None, None))
                seq -= 1
            held, size, spilled = [], 0, True

        def finish() -> None:
            nonlocal held, size
            c = repair.counts
            summary = ",".join(map(str, (repair.gaps(), *c.values(), repair.cost[START])))
            if spilled:
                spill()
                out.append((current, 1, None, None, 0, summary, None, None))
                return
            edits = Edits()
            for role, text, pointer in reversed(held):
                edits.row(role, text, pointer)
            out.append((current, 2, None, None, 0, summary, *edits.end()))

        def flush() -> pd.DataFrame:
            nonlocal out
            frame, out = pd.DataFrame(out, columns=list(PASSED)), []
            return frame

        for batch in batches:
            for conv, turn, role, text, fault, dropped in batch.itertuples(index=False):
                if repair is None or conv != current:
                    if repair is not None:
                        finish()
                    current, repair, held, size, seq, spilled = conv, Repair(), [], 0, 0, False
                if dropped:
                    continue
                pointer = repair.before(role, fault, None if turn is None else int(turn))
                held.append((role, text, pointer))
                size += len(text)
                if len(held) >= buffer_rows or size >= buffer_bytes:
                    spill()
                if len(out) >= 10_000:
                    yield flush()
            if out:
                yield flush()
        if current is not None:
            finish()
            yield flush()
    return kernel


def _forward(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Second pass, over giant conversations: rows first to last, then the summary."""
    edits = Edits()
    for batch in batches:
        done = []
        for r in batch.itertuples(index=False):
            if r.seq <= 0:
                edits.row(r.role, r.text, int(r.pointer))
            else:
                done.append((r.conv_id, r.summary, *edits.end()))
                edits = Edits()
        if done:
            yield pd.DataFrame(done, columns=["conv_id", "summary", "audit", "repaired_sha256"])


def repaired(rows: DataFrame, buffer_rows: int = BUFFER_ROWS, buffer_bytes: int = BUFFER_BYTES) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256) of (conv_id, turn, role, text, fault, dropped) rows."""
    again = F.coalesce(F.col("fault") == "duplicate", F.lit(False))
    dealt = rows.select(F.col("conv_id").cast("string"), "turn", "role", "text", "fault", "dropped").repartition("conv_id")
    backwards = dealt.sortWithinPartitions("conv_id", F.col("turn").desc_nulls_last(), F.col("role").desc(), F.col("text").desc(), again.desc())
    backwards = backwards.withColumn("turn", F.col("turn").cast("string"))
    passed = save(backwards.mapInPandas(_backward(buffer_rows, buffer_bytes), ", ".join(f"{c} {t}" for c, t in PASSED.items())), "backpointers")
    giant = passed.where("seq < 2").repartition("conv_id").sortWithinPartitions("conv_id", "seq")
    columns = ["conv_id", "summary", "audit", "repaired_sha256"]
    done = passed.where("seq = 2").select(*columns).unionByName(giant.mapInPandas(_forward, ", ".join(f"{c} string" for c in columns)))
    numbers = F.split("summary", ",")
    return done.select(F.col("conv_id").cast(rows.schema["conv_id"].dataType),
                       *[numbers[i].cast("long").alias(c) for i, c in enumerate(SUMMARY)], "audit", "repaired_sha256")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(with_faults(damaged(table(spark, sf_dir, "conversations"))))
