"""Packing documents into token windows with a bounded number of open windows.

Every partition reads its documents once, in the order of its files, and keeps a fixed number of
open windows. Whole windows of a long document are emitted at once; what is left over goes into the
open window that it fills best. When it fits none and no further window may be opened, the fullest
one is emitted: if it has more than a little room, the document is cut to fill it. Memory is that
of one document and the open windows' fill levels. What is still open at the end of the partitions
(at most ``open_windows`` small rows each) is merged by best fit in groups of bounded size.

Token ids are those of the byte-level BPE vocabulary, whose ranks file gives the same ids several
times faster; texts that spell a special token take the slower path, which knows those.

Defined cases: a null text counts as empty; an empty document is its end token alone; a document of
any length is packed whole, each of its ids in exactly one piece; rows with equal keys are packed
one by one; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut, small

WINDOW = 2048
OPEN_WINDOWS = 64
#: The fullest window is emitted as it is if it has less room than this.
LEAST_PIECE = 16
END_ID = 1
#: Leftover windows that are merged together.
MERGED = 8192
VOCABULARY = "byte_bpe_50k"
MERGED_BIT = 1 << 62


class Tokenizer:
    """Ids of texts; made once in a task. ``vocabulary`` is a name or the path of the files, without ending."""

    def __init__(self, vocabulary: str = VOCABULARY):
        import public_tokenizers
        import tiktoken

        stem = vocabulary if "/" in vocabulary else public_tokenizers.path(f"{vocabulary}.json").removesuffix(".json")
        self._json = f"{stem}.json"
        with open(f"{stem}.tiktoken", "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self._fast = tiktoken.Encoding(
            stem.rsplit("/", 1)[-1], pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self._exact = None

    def ids(self, text: str) -> np.ndarray:
        if "<|" in text:
            if self._exact is None:
                from tokenizers import Tokenizer as Loaded

                self._exact = Loaded.from_file(self._json)
            return np.array(self._exact.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return self._fast.encode_to_numpy(text, disallowed_special=()).astype(np.uint32)


class Windows:
    """Open windows by the room they have left; ``place`` says where the next tokens go."""

    def __init__(self, window: int, most: int, least_piece: int):
        self.window, self.most, self.least_piece = window, most, least_piece
        self.open: list[tuple[int, int]] = []
        self.made = 0

    def _new(self) -> int:
        self.made += 1
        return self.made - 1

    def _put(self, number: int, used: int) -> None:
        if used < self.window:
            bisect.insort(self.open, (self.window - used, number))

    def place(self, length: int) -> Iterator[tuple[int, int, int]]:
        """Pieces ``(window number, offset, length)`` for ``length`` tokens."""
        while length >= self.window:
            yield self._new(), 0, self.window
            length -= self.window
        while length:
            at = bisect.bisect_left(self.open, (length, -1))
            if at < len(self.open):
                room, number = self.open.pop(at)
                yield number, self.window - room, length
                self._put(number, self.window - room + length)
                return
            if len(self.open) < self.most:
                number = self._new()
                yield number, 0, length
                self._put(number, length)
                return
            room, number = self.open.pop(0)
            if room >= self.least_piece:
                yield number, self.window - room, room
                length -= room

    def left(self) -> list[tuple[int, int]]:
        return [(number, self.window - room) for room, number in self.open]


def merge_left(used: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Best fit of leftover windows, fullest first: the merged window and the offset of each."""
    number, offset = np.zeros(len(used), np.int64), np.zeros(len(used), np.int64)
    rooms: list[tuple[int, int]] = []
    made = 0
    for i in np.argsort(-used, kind="stable"):
        size = int(used[i])
        at = bisect.bisect_left(rooms, (size, -1))
        if at < len(rooms):
            room, number[i] = rooms.pop(at)
            offset[i] = window - room
        else:
            room, number[i] = window, made
            made += 1
        bisect.insort(rooms, (room - size, int(number[i])))
    return number, offset


PIECE = pa.schema(
    [
        ("key", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("part", pa.int64()),
        ("number", pa.int64()),
        ("offset", pa.int64()),
        ("open", pa.bool_()),
    ]
)
PIECE_DDL = "key long, start long, length long, ids_crc32 long, doc_tokens long, part long, number long, offset long, open boolean"


def _packer(window: int, open_windows: int, least_piece: int, vocabulary: str, end_id: int, with_ids: bool):
    schema = PIECE.append(pa.field("ids", pa.list_(pa.int32()))) if with_ids else PIECE

    def pack_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        tokenizer, windows = None, Windows(window, open_windows, least_piece)
        end = np.array([end_id], dtype=np.uint32)
        for batch in batches:
            tokenizer = tokenizer or Tokenizer(vocabulary)
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.concatenate([tokenizer.ids(text.as_py() or ""), end]).astype("<u4")
                start = 0
                for number, offset, length in windows.place(len(ids)):
                    piece = ids[start : start + length]
                    row = (key, start, length, zlib.crc32(piece.tobytes()), len(ids), part, number, offset, False)
                    rows.append((*row, piece.astype(np.int32)) if with_ids else row)
                    start += length
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        # What is open: a row of the fill level for each window.
        left = [(None, None, used, None, None, part, number, None, True) for number, used in windows.left()]
        if left:
            left = [(*row, None) for row in left] if with_ids else left
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*left), schema)], schema=schema)

    return pack_partition


def pack(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
    least_piece: int = LEAST_PIECE,
    vocabulary: str = VOCABULARY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """A row for each piece of a document: where it starts there, and its sequence and offset.

    Columns: ``doc_id``, ``start``, ``length``, ``ids_crc32`` (of the ids as little-endian unsigned
    32-bit numbers), ``doc_tokens``, ``sequence_id``, ``offset``, and ``ids`` if asked for.
    """
    packer = _packer(window, open_windows, least_piece, vocabulary, end_id, with_ids)
    ddl = PIECE_DDL + (", ids array<int>" if with_ids else "")
    # Written once: a window's number is that of this one run of its partition.
    packed = cut(docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(packer, ddl))
    left = packed.where("open").select("part", "number", F.col("length").alias("used"))
    n_left = left.count()
    groups = max(1, -(-n_left // MERGED))
    grouped = left.withColumn("bin", F.pmod(F.xxhash64("part", "number"), F.lit(groups)))

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["used", "part", "number"], ascending=[False, True, True])
        number, offset = merge_left(frame["used"].to_numpy(), window)
        return frame.assign(merged=number, base=offset)[["part", "number", "bin", "merged", "base"]]

    merged = grouped.groupBy("bin").applyInPandas(merge, "part long, number long, bin long, merged long, base long")
    pieces = packed.where("NOT open").alias("p")
    same = (F.col("p.part") == F.col("m.part")) & (F.col("p.number") == F.col("m.number"))
    moved = F.col("m.merged").isNotNull()
    sequence = F.when(moved, F.lit(MERGED_BIT) + F.shiftleft("m.bin", 32) + F.col("m.merged")).otherwise(
        F.shiftleft("p.part", 32) + F.col("p.number")
    )
    return pieces.join(small(merged, n_left * 64).alias("m"), same, "left").select(
        F.col("p.key").alias("doc_id"),
        "p.start",
        "p.length",
        "p.ids_crc32",
        "p.doc_tokens",
        sequence.alias("sequence_id"),
        (F.col("p.offset") + F.coalesce("m.base", F.lit(0))).alias("offset"),
        *(["p.ids"] if with_ids else []),
    )
