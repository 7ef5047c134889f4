"""Packing: documents into token sequences of a fixed length, online and in bounded space.

Each partition keeps a fixed number of open windows. A document is placed where it leaves the least room; when it fits
nowhere, the fullest window is closed: its room is filled with the head of the document where that is worth a cut, and
the rest is placed anew. Windows still open at the end of the partitions are merged, a bounded number at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tallycube.llm.common import fresh, quoted, slices, tidy, written
from tallycube.llm.tokens import codec

LENGTH = 2048
OPEN_WINDOWS = 16
MIN_CUT = 24  # a window with less room than this is closed with padding instead of a cut
MERGED_PARTITIONS = 64
SLICE = 500_000  # bytes encoded at once
END = np.array([1], "<u4").tobytes()
PER_PARTITION = 33  # bits for the windows of a partition

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("window", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("closed", T.BooleanType()),
    ]
)
IDS = T.StructField("ids", T.ArrayType(T.IntegerType()))


class Packer:
    """Open windows of one partition. `place` gives (start, length, window, offset) for each piece of a document."""

    def __init__(self, first: int, length: int, open_windows: int, min_cut: int):
        self.next, self.length, self.most, self.min_cut = first, length, open_windows, min_cut
        self.used: dict[int, int] = {}

    def _open(self) -> int:
        self.next += 1
        return self.next - 1

    def place(self, tokens: int) -> list[tuple[int, int, int, int]]:
        pieces, start = [], 0
        while tokens - start >= self.length:
            pieces.append((start, self.length, self._open(), 0))
            start += self.length
        while start < tokens:
            rest = tokens - start
            best = max((w for w, used in self.used.items() if used + rest <= self.length), key=self.used.__getitem__, default=None)
            if best is None and len(self.used) >= self.most:
                fullest = max(self.used, key=self.used.__getitem__)
                used = self.used.pop(fullest)
                if self.length - used >= self.min_cut:
                    pieces.append((start, self.length - used, fullest, used))
                    start += self.length - used
                    continue
            if best is None:
                best = self._open()
                self.used[best] = 0
            pieces.append((start, rest, best, self.used[best]))
            self.used[best] += rest
            if self.used[best] == self.length:
                del self.used[best]
            start = tokens
        return pieces


@tidy
def _pack_partition(batches: Iterator[pa.RecordBatch], path: str, with_ids: bool, shape: tuple[int, int, int]) -> Iterator[pa.RecordBatch]:
    # Rows are yielded as they come; windows that stay open to the end are told by a last row without a document.
    packer = Packer(TaskContext.get().partitionId() << PER_PARTITION, *shape)
    words = codec(path)
    for batch in fresh(batches, keep=path):
        docs = batch.column(0).to_pylist()
        encoded = (raw for _, texts in slices(batch.column(1), SLICE) for raw in words.encode(texts))
        rows: list[tuple] = []
        ids = []
        for doc, raw in zip(docs, encoded, strict=True):
            raw += END
            total = len(raw) // 4
            for start, length, window, offset in packer.place(total):
                part = raw[4 * start : 4 * (start + length)]
                rows.append((doc, start, length, zlib.crc32(part), total, window, offset, True))
                if with_ids:
                    ids.append(np.frombuffer(part, "<u4").astype(np.int32))
        yield _batch(rows, ids if with_ids else None)
    left = [(None, None, used, None, None, window, None, False) for window, used in packer.used.items()]
    if left:
        yield _batch(left, [None] * len(left) if with_ids else None)


def _batch(rows: list[tuple], ids: list | None) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in PIECES.fields]
    arrays = [pa.array(c, pa.bool_() if f.name == "closed" else pa.int64()) for c, f in zip(columns, PIECES.fields, strict=True)]
    if ids is not None:
        arrays.append(pa.array(ids, pa.list_(pa.int32())))
    return pa.RecordBatch.from_arrays(arrays, PIECES.names + (["ids"] if ids is not None else []))


def merge_windows(left: pd.DataFrame, length: int) -> pd.DataFrame:
    """Best fit, longest first: which window each of the left ones moves into, and how far its pieces shift."""
    room: dict[int, int] = {}
    moves = []
    for window, used in left.sort_values(["used", "window"], ascending=[False, True])[["window", "used"]].itertuples(index=False):
        best = min((w for w, free in room.items() if free >= used), key=lambda w: (room[w], w), default=None)
        if best is None:
            room[window] = length - used
        else:
            moves.append((window, best, length - room[best]))
            room[best] -= used
    return pd.DataFrame(moves, columns=["window", "host", "shift"])


def pack(
    documents: DataFrame,
    vocabulary: str,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    open_windows: int = OPEN_WINDOWS,
    min_cut: int = MIN_CUT,
    with_ids: bool = True,
) -> DataFrame:
    """Pieces of documents in sequences of `length` tokens, each token in exactly one piece.

    `vocabulary` is the path of the vocabulary file, the same on every machine. A null text is empty and gives the
    end token alone; a null id stays null; repeated rows are packed each; other columns are left out; an empty table
    gives no rows. A text longer than a sequence fills sequences of its own, and its rest is placed like a document.
    `sequence_id` is unique but not dense. `ids` holds the tokens unless `with_ids` is off.
    """
    schema = T.StructType([*PIECES.fields, *([IDS] if with_ids else [])])
    source = documents.select(quoted(doc_id).cast("long").alias("doc_id"), quoted(text).cast("string").alias("text"))
    shape = (length, open_windows, min_cut)
    rows = written(source.mapInArrow(lambda batches: _pack_partition(batches, vocabulary, with_ids, shape), schema), "packed")
    left = rows.filter(~F.col("closed")).select("window", F.col("length").alias("used"))
    bundle = F.shiftrightunsigned("window", PER_PARTITION + MERGED_PARTITIONS.bit_length() - 1)
    moves = left.groupBy(bundle.alias("bundle")).applyInPandas(
        lambda frame: merge_windows(frame, length), "window long, host long, shift long"
    )
    return (
        rows.filter("closed")
        .join(moves, "window", "left")
        .select(
            "doc_id",
            "start",
            "length",
            "ids_crc32",
            "doc_tokens",
            F.coalesce("host", "window").alias("sequence_id"),
            (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
            *(["ids"] if with_ids else []),
        )
    )
