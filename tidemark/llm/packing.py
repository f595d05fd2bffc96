"""Packing of token sequences by bounded-space online packing (operator 1).

Every task keeps a fixed number of open windows. A document gives full windows first; its
rest goes to the open window that it fits best. If it fits none, the fullest window takes
as much of the rest as it holds and is emitted full, and what remains is placed again. A
window is opened while fewer than the fixed number are open. At a task's end its open
windows are merged: the pieces of the emptiest fill up the fullest, so one window a task is
left over. Left-overs of many tasks are merged in the same way in groups of a fixed size,
again and again until one group is left; their rows are bounded by the window's length a
task. Only the last left-over window is padded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import bpe
from tidemark.llm.common import by_bytes, staged, unstage

#: left-over windows that one merge task takes
MERGE = 512
_LEVEL = 1 << 55        # sequence ids: merge level, then task or group, then a counter
_TASK = 1 << 31


class Piece:
    __slots__ = ("doc", "start", "ids", "total")

    def __init__(self, doc, start: int, ids: np.ndarray, total: int):
        self.doc, self.start, self.ids, self.total = doc, start, ids, total

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.start, self.ids[:n], self.total), Piece(self.doc, self.start + n, self.ids[n:], self.total)


class Packer:
    """Open windows of ``length`` tokens, at most ``n_open`` of them."""

    def __init__(self, length: int, n_open: int):
        self.length, self.n_open = length, n_open
        self.windows: list[list[Piece]] = []
        self.used: list[int] = []
        self.full: list[list[Piece]] = []

    def add(self, piece: Piece) -> None:
        while len(piece.ids) >= self.length:
            head, piece = piece.cut(self.length)
            self.full.append([head])
        while len(piece.ids):
            need, room = len(piece.ids), self.length - np.array(self.used, np.int64)
            fits = np.flatnonzero(room >= need)
            if len(fits):
                at = int(fits[np.argmin(room[fits])])
            elif len(self.windows) < self.n_open:
                at = len(self.windows)
                self.windows.append([])
                self.used.append(0)
            else:
                at = int(np.argmin(room))
            head, piece = piece.cut(min(need, self.length - self.used[at]))
            self._put(at, head)

    def _put(self, at: int, piece: Piece) -> None:
        self.windows[at].append(piece)
        self.used[at] += len(piece.ids)
        if self.used[at] == self.length:
            self.full.append(self.windows.pop(at))
            self.used.pop(at)

    def merge(self) -> list[Piece]:
        """Close all windows but one into full ones; returns what the last one holds."""
        while len(self.windows) > 1:
            least = int(np.argmin(self.used))
            pieces = self.windows.pop(least)
            self.used.pop(least)
            for piece in pieces:
                while len(piece.ids):
                    if not self.windows:
                        self.windows.append([])
                        self.used.append(0)
                    at = int(np.argmax(self.used))
                    head, piece = piece.cut(min(len(piece.ids), self.length - self.used[at]))
                    self._put(at, head)
        return self.windows[0] if self.windows else []


def _rows(windows: list[tuple[int | None, list[Piece]]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Piece rows; a window with sequence id None is a left-over."""
    for k in range(0, len(windows), 2048):
        doc, start, ids, total, seq, offset = [], [], [], [], [], []
        for number, pieces in windows[k:k + 2048]:
            at = 0
            for p in pieces:
                doc.append(p.doc)
                start.append(p.start)
                ids.append(p.ids)
                total.append(p.total)
                seq.append(number)
                offset.append(at)
                at += len(p.ids)
        ends = np.cumsum([0, *map(len, ids)])
        flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc, schema[0].type), pa.array(start, pa.int64()), bpe.binary_slices(flat, ends), pa.array(total, pa.int64()),
             pa.array(seq, pa.int64()), pa.array(offset, pa.int64()), pa.array([0] * len(doc), pa.int64())], schema=schema)


def pack(df: DataFrame, path: str, *, length: int = 1024, n_open: int = 64, end_id: int = 0,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack all texts into sequences of at most ``length`` tokens.

    One row per piece: the id column, ``start`` (the document's ids before it), ``ids``
    (binary: little-endian unsigned 32-bit integers), ``doc_tokens``, ``sequence_id``, ``offset`` in the sequence. A document's
    ids are those of its whole text followed by ``end_id``; each lies in exactly one piece.
    A null or empty text is ``end_id`` alone. Null ids are packed like others, repeated rows
    are packed each, other columns are not read, an empty table gives an empty one. A text
    longer than any window is cut. Results depend on how the input is dealt to tasks, and
    are the same if a task is run again.
    """
    spark = df.sparkSession
    tables, key = bpe.shared_tables(spark, path)
    source = df.select(F.col(id_col), F.col(text_col).cast("string").alias(text_col))
    schema = T.StructType([
        source.schema[id_col], T.StructField("start", T.LongType()), T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()), T.StructField("left_over", T.LongType())])

    def arrow(batch_id: pa.DataType) -> pa.Schema:
        return pa.schema([(id_col, batch_id), ("start", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()),
                          ("sequence_id", pa.int64()), ("offset", pa.int64()), ("left_over", pa.int64())])

    def left(pieces: list[Piece], number: int, kind: pa.Schema) -> Iterator[pa.RecordBatch]:
        for b in _rows([(None, pieces)], kind) if pieces else ():
            yield b.set_column(6, "left_over", pa.array([number] * b.num_rows, pa.int64()))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, packer, kind = bpe.encoder(tables, key), Packer(length, n_open), None
        task, count = TaskContext.get().partitionId(), 0
        for batch in batches:
            kind = arrow(batch.schema.field(0).type)
            for part in by_bytes(batch, text_col, bpe.SLICE):
                flat, ends = coder.encode(part.column(text_col).fill_null(""))
                for doc, a, b in zip(part.column(id_col).to_pylist(), ends[:-1], ends[1:]):
                    packer.add(Piece(doc, 0, np.append(flat[a:b], np.uint32(end_id)), int(b - a) + 1))
                done, packer.full = packer.full, []
                yield from _rows([(task * _TASK + count + i, w) for i, w in enumerate(done)], kind)
                count += len(done)
        if kind is not None:
            rest = packer.merge()
            yield from _rows([(task * _TASK + count + i, w) for i, w in enumerate(packer.full)], kind)
            yield from left(rest, task, kind)

    def again(level: int):
        def run(key_: tuple, table: pa.Table) -> pa.Table:
            kind = arrow(table.schema.field(id_col).type)
            group = key_[0].as_py()
            table = table.select(kind.names).sort_by([("left_over", "ascending"), ("offset", "ascending")])
            packer = Packer(length, n_open)
            for doc, start, ids, total in zip(*(table.column(c).to_pylist() for c in kind.names[:4])):
                packer.add(Piece(doc, start, np.frombuffer(ids, "<u4"), total))
            rest = packer.merge()
            out = list(_rows([(level * _LEVEL + group * _TASK + i, w) for i, w in enumerate(packer.full)], kind))
            return pa.Table.from_batches([*out, *left(rest, group, kind)], kind)
        return run

    parts = [staged(source.mapInArrow(first, schema), "packed")]
    level = 0
    while True:
        rest = parts[-1].where("left_over IS NOT NULL AND sequence_id IS NULL")
        if rest.agg(F.countDistinct("left_over")).first()[0] <= 1:
            break
        level += 1
        grouped = rest.withColumn("_group", F.floor(F.col("left_over") / MERGE).cast("long"))
        parts.append(staged(grouped.groupBy("_group").applyInArrow(again(level), schema), "merged"))
    done = [p.where("sequence_id IS NOT NULL") for p in parts]
    done.append(parts[-1].where("sequence_id IS NULL").withColumn("sequence_id", F.lit((level + 1) * _LEVEL)))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.drop("left_over")
