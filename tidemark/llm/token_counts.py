"""Token counts of sections by offset-mapped attribution (operator 9).

Each whole text is encoded once. Byte-level tokens spell the text without gaps, so their
byte spans are the running sum of their lengths. Sections are spans too; both are sorted,
so one interval join (a binary search of the token starts among the section starts) finds
each token's section. A token that crosses a boundary counts for the section that holds its
first byte, and is counted as crossing there; counts of a text's sections add up to the
tokens of the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import bpe
from tidemark.llm.common import by_bytes


def line_starts(text: bytes) -> np.ndarray:
    """Byte offset of each line's start; a line holds the line feed that ends it."""
    at = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    return np.concatenate([[0], at[at < len(text)]]).astype(np.int64)


def paragraph_starts(text: bytes) -> np.ndarray:
    """Byte offset of each paragraph's start: a line after a blank one, and the text's start."""
    starts = line_starts(text)
    blank = np.array([not text[a:b].strip() for a, b in zip(starts, [*starts[1:], len(text)])], bool)
    begins = np.concatenate([[True], blank[:-1] & ~blank[1:]])
    return starts[begins]


SECTIONS = {"line": line_starts, "paragraph": paragraph_starts}


def count_tokens(df: DataFrame, path: str, *, section: str = "line", id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per section: id, ``section`` (from 0), ``start`` and ``end`` (code points, end
    exclusive), ``n_tokens``, ``n_crossing`` (of these, tokens that end beyond the section).

    A null or empty text is one empty section with no tokens. A text that ends in a line
    feed has no empty line after it. Null ids are kept, repeated rows give repeated
    sections, other columns are not read, an empty table gives an empty one.
    """
    tables, key = bpe.shared_tables(df.sparkSession, path)
    starts_of = SECTIONS[section]
    source = df.select(F.col(id_col), F.col(text_col).cast("string").alias(text_col))
    schema = T.StructType([source.schema[id_col], *(T.StructField(c, T.LongType()) for c in (
        "section", "start", "end", "n_tokens", "n_crossing"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe.encoder(tables, key)
        for batch in batches:
            for part in by_bytes(batch, text_col, bpe.SLICE):
                texts = part.column(text_col).fill_null("")
                flat, ends = coder.encode(texts)
                sizes = coder.t.length[flat]
                rows, out = [], [[], [], [], [], []]
                for i, text in enumerate(texts.to_pylist()):
                    raw = text.encode()
                    size = sizes[ends[i]:ends[i + 1]]
                    stop = np.cumsum(size)
                    begins = starts_of(raw)
                    limits = np.append(begins[1:], len(raw))
                    own = np.searchsorted(begins, stop - size, side="right") - 1
                    n = len(begins)
                    crossing = stop > limits[own] if len(size) else np.zeros(0, bool)
                    chars = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
                    rows.append(np.full(n, i))
                    for to, x in zip(out, (np.arange(n), chars[begins], chars[limits],
                                           np.bincount(own, minlength=n), np.bincount(own[crossing], minlength=n))):
                        to.append(x)
                at = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [part.column(id_col).take(at), *(pa.array(np.concatenate(x), pa.int64()) for x in out)], names=schema.names)
    return source.mapInArrow(run, schema)
