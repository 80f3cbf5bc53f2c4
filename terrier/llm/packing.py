"""Bounded-space online packing of documents into sequences.

Every partition keeps a fixed number of open windows. A piece goes to the open window
that it leaves the least room in. Where none has room, the fullest window takes as much
of the piece as it holds and is emitted, and a new one opens for the rest; so an
emitted window is full. What is left open at the end of a partition is merged: groups of
partitions pack their open windows in the same way, level by level, until one task is
left; its last windows are joined and the rest is cut at powers of two, which need no
padding.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrier.llm.blocks import blocks
from terrier.llm.wordpieces import word_vocabulary
from terrier.session import cut_lineage

FIELDS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
PIECE = ", ".join(f"{x} long" for x in FIELDS)
OPEN = "doc_id long, start long, doc_tokens long, ids binary"
TYPES = pa.schema([(x, pa.int64()) for x in FIELDS] + [("ids", pa.binary())])


class Packer:
    """Open windows of one task. ``first`` is the id of its first sequence."""

    def __init__(self, first: int, capacity: int, windows: int):
        self.next, self.capacity, self.windows = first, capacity, windows
        self.open: list[list] = []          # [room, [(doc_id, start, doc_tokens, ids), ...]]
        self.rows: list[tuple] = []

    def add(self, doc: int, start: int, total: int, ids: np.ndarray) -> None:
        while len(ids) >= self.capacity:    # whole windows of a long document
            self._emit([(doc, start, total, ids[: self.capacity])])
            start, ids = start + self.capacity, ids[self.capacity:]
        if not len(ids):
            return
        fit = min((w for w in self.open if w[0] >= len(ids)), key=lambda w: w[0], default=None)
        if fit is None and len(self.open) < self.windows:
            fit = [self.capacity, []]
            self.open.append(fit)
        if fit is None:
            fullest = min(self.open, key=lambda w: w[0])
            room = fullest[0]
            self.open.remove(fullest)
            self._emit([*fullest[1], (doc, start, total, ids[:room])])
            start, ids = start + room, ids[room:]
            fit = [self.capacity, []]
            self.open.append(fit)
        fit[0] -= len(ids)
        fit[1].append((doc, start, total, ids))
        if not fit[0]:
            self.open.remove(fit)
            self._emit(fit[1])

    def _emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, total, ids in pieces:
            data = ids.astype("<u4").tobytes()
            self.rows.append((doc, start, len(ids), zlib.crc32(data), total, self.next, offset, None))
            offset += len(ids)
        self.next += 1

    def leave(self) -> None:
        """Hand the open windows' pieces on, with their ids."""
        for _, pieces in self.open:
            self.rows += [(doc, start, len(ids), None, total, None, None, ids.astype("<u4").tobytes()) for doc, start, total, ids in pieces]
        self.open = []

    def finish(self) -> None:
        """Emit what is open: whole windows, then sequences of powers of two."""
        pieces = [p for w in self.open for p in w[1]]
        left = sum(len(p[3]) for p in pieces)
        while left:
            size = min(self.capacity, 1 << (left.bit_length() - 1))
            part, need = [], size
            while need:
                doc, start, total, ids = pieces.pop(0)
                part.append((doc, start, total, ids[:need]))
                if len(ids) > need:
                    pieces.insert(0, (doc, start + need, total, ids[need:]))
                need -= len(part[-1][3])
            self._emit(part)
            left -= size
        self.open = []

    def batch(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(TYPES)], schema=TYPES)


def pack(docs: DataFrame, path: str, end_id: int = 1, capacity: int = 2048, windows: int = 16, fan_in: int = 64) -> DataFrame:
    """One row per piece: document, place in it, digest of its ids, sequence, offset there.

    NULL and empty texts are the end id alone. Every id of a document lies in one piece;
    repeated rows are packed each by itself. Texts of any length keep the memory of a
    task at its open windows and one block of texts. Extra columns are not read. An empty
    table gives no rows. ``capacity`` is a power of two, so that the last windows, cut at
    powers of two, need no padding.

    Sequence ids are the level, the task and a count, so a repeated task gives the same.
    No shuffle of texts: only open windows (at most ``windows`` per task) move. The pieces
    of a level are written to the shared folder, so texts are encoded once.
    """
    def first_level(batches):
        words = word_vocabulary(path)
        packer = Packer(TaskContext.get().partitionId() << 32, capacity, windows)
        for block in blocks(batches, "text", 8 << 20):
            ids, counts = words.encode(block)
            ends = np.cumsum(counts)
            for doc, stop, n in zip(block.rows.column("doc_id").to_pylist(), ends, counts):
                packer.add(doc, 0, int(n) + 1, np.append(ids[stop - n: stop], end_id))
                if len(packer.rows) > 20_000:
                    yield packer.batch()
        packer.leave()
        yield packer.batch()

    def next_level(level: int, last: bool):
        def run(batches):
            packer = Packer(level << 56 | TaskContext.get().partitionId() << 32, capacity, windows)
            for batch in batches:
                for row in batch.to_pylist():
                    packer.add(row["doc_id"], row["start"], row["doc_tokens"], np.frombuffer(row["ids"], "<u4"))
                yield packer.batch()
            packer.finish() if last else packer.leave()
            yield packer.batch()
        return run

    schema = PIECE + ", ids binary"
    tasks = max(1, docs.rdd.getNumPartitions())
    made = cut_lineage(docs.select("doc_id", "text").mapInArrow(first_level, schema), "pieces")
    out, level = made.where("ids IS NULL").select(*FIELDS), 0
    while True:
        level += 1
        tasks = -(-tasks // fan_in)
        left = made.where("ids IS NOT NULL").select("doc_id", "start", "doc_tokens", "ids")
        dealt = left.repartition(tasks, F.xxhash64("doc_id", "start")) if tasks > 1 else left.coalesce(1)
        merged = dealt.mapInArrow(next_level(level, tasks == 1), schema)
        if tasks == 1:
            return out.unionByName(merged.select(*FIELDS))
        made = cut_lineage(merged, "pieces")
        out = out.unionByName(made.where("ids IS NULL").select(*FIELDS))
