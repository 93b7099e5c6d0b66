"""Packing documents into sequences by bounded-space online packing.

Each partition keeps ``open_windows`` partly filled windows. A document's whole
windows go out at once; the rest of it is placed into the open window that it
fills best. When none has room and no more may be opened, the fullest window is
filled up with the head of the piece and emitted. The windows still open at a
partition's end are leftovers: groups of partitions' leftovers are packed
again, round by round, until one group remains; its last tokens are cut into
windows whose lengths are powers of two, which take no padding.

Only leftovers carry their ids on (``open_windows`` windows a partition);
emitted pieces are digests, written once.

Defined results: a null or empty text is the end id alone; rows with equal ids
are packed each; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recoengine.llm.common import byte_chunks, save, table
from recoengine.llm.tokens import default_tokenizer, encoder

WINDOW = 1024
OPEN_WINDOWS = 32
#: Partitions whose leftovers meet in one task of a merge round.
MERGED = 64

PIECE = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                   ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                   ("group", pa.int64()), ("ids", pa.binary())])
PIECE_DDL = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
             "group long, ids binary")
# sequence_id: merge round, task of the round, number within the task
_ROUND, _TASK = 1 << 58, 1 << 28


class Packer:
    """The open windows of one task. A piece is (doc_id, start, ids, doc_tokens),
    with ids as bytes of 4 a token."""

    def __init__(self, window: int, open_windows: int, first_id: int) -> None:
        self.size, self.limit, self.next_id = 4 * window, open_windows, first_id
        self.room: list[tuple[int, int]] = []  # (free bytes, window), ascending
        self.held: dict[int, list[tuple]] = {}
        self.opened = 0
        self.out: list[tuple] = []

    def emit(self, pieces: list[tuple]) -> None:
        at = 0
        for doc, start, ids, n in pieces:
            self.out.append((doc, start, len(ids) // 4, zlib.crc32(ids), n, self.next_id, at // 4, None, None))
            at += len(ids)
        self.next_id += 1

    def add(self, doc: int | None, start: int, ids: bytes, n: int) -> None:
        at = 0
        while len(ids) - at >= self.size:
            self.emit([(doc, start + at // 4, ids[at:at + self.size], n)])
            at += self.size
        while at < len(ids):
            need = len(ids) - at
            k = bisect_left(self.room, (need, -1))  # the fullest with room: best fit
            if k == len(self.room) and len(self.room) < self.limit:
                self.opened += 1
                self.held[self.opened] = []
                self.room.append((self.size, self.opened))
            elif k == len(self.room):
                k = 0  # none has room: fill up the fullest
            free, w = self.room.pop(k)
            take = min(free, need)
            self.held[w].append((doc, start + at // 4, ids[at:at + take], n))
            at += take
            if take == free:
                self.emit(self.held.pop(w))
            else:
                insort(self.room, (free - take, w))

    def leftovers(self, group: int) -> None:
        for _, w in self.room:
            for doc, start, ids, n in self.held[w]:
                self.out.append((doc, start, len(ids) // 4, None, n, None, None, group, ids))

    def finish(self) -> None:
        """Emit all: full windows, then one for each binary digit of the rest."""
        pieces = [p for _, w in self.room for p in self.held[w]]
        left = sum(len(p[2]) for p in pieces)
        row: list[tuple] = []
        want = 0
        for doc, start, ids, n in pieces:
            at = 0
            while at < len(ids):
                if not want:
                    want = self.size if left >= self.size else 4 << ((left // 4).bit_length() - 1)
                take = min(want, len(ids) - at)
                row.append((doc, start + at // 4, ids[at:at + take], n))
                at, want, left = at + take, want - take, left - take
                if not want:
                    self.emit(row)
                    row = []

    def drain(self) -> pa.RecordBatch:
        columns = list(zip(*self.out)) or [()] * len(PIECE)
        self.out = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PIECE)], schema=PIECE)


def _merge(turn: int, final: bool, window: int, open_windows: int, merged: int) -> Callable[[pa.Table], pa.Table]:
    def merge(rows: pa.Table) -> pa.Table:
        group = rows.column("group")[0].as_py() // merged
        packer = Packer(window, open_windows, turn * _ROUND + group * _TASK)
        rows = rows.sort_by([("doc_id", "ascending"), ("start", "ascending")])
        for doc, start, ids, n in zip(*(rows.column(c).to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens"))):
            packer.add(doc, start, ids, n)
        packer.finish() if final else packer.leftovers(group)
        return pa.Table.from_batches([packer.drain()])

    return merge


def pack(docs: DataFrame, window: int = WINDOW, open_windows: int = OPEN_WINDOWS, merged: int = MERGED,
         tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a piece: (doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset)."""
    if merged < 2:
        raise ValueError("merged has to be 2 at least")
    tokenizer = tokenizer or default_tokenizer()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, enc = TaskContext.get().partitionId(), encoder(tokenizer)
        packer = Packer(window, open_windows, task * _TASK)
        for chunk in byte_chunks(batches, "text", 8 << 20, keep_units=True):
            for doc, ids in zip(chunk.column("doc_id").to_pylist(), enc(chunk.column("text").to_pylist())):
                packer.add(doc, 0, ids, len(ids) // 4)
            yield packer.drain()
        packer.leftovers(task)
        yield packer.drain()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    packed = save(rows.mapInArrow(encode, PIECE_DDL), "packed")
    done, turn = [packed], 0
    while True:
        left = done[-1].where("group is not null")
        last = left.agg(F.max("group")).first()[0]  # the number of groups, not rows
        if last is None:
            break
        turn += 1
        final = last < merged

        done.append(save(left.groupBy(F.floor(F.col("group") / merged).alias("_g")).applyInArrow(
            _merge(turn, final, window, open_windows, merged), PIECE_DDL), "packed"))
        if final:
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.where("group is null").drop("group", "ids")


def op3_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
