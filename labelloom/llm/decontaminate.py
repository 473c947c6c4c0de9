"""Benchmark decontamination: windows of benchmark items that occur in documents, found by a prefix-filtered join.

A window is ``WINDOW`` consecutive words of an item, or all of a shorter item. It is a set of
word shingles; to hold a window, a document must hold them all. Shingles are put in the order of how
often the documents have them, the rarest first, and a set that has to be contained whole needs only
its first one joined: a window is looked for where its rarest shingle stands. Where that is, the
window would have to begin at one place; it must begin and end inside the document (position and
length bounds), and its words must be those of the document there (exact check).

The documents are read twice: for the counts of the benchmark's shingles, and for the places of the
rarest ones with the words around them. Both passes look hashes up in a bitmap of fixed size, and
shuffle only what the benchmark shares with the documents. Documents of one pattern of windows are matched with
items once, so a passage that very many documents hold costs a row for each of them.

Words: maximal runs of ASCII letters and digits and all characters beyond ASCII, with A-Z in lower case.

Defined cases: null and empty texts have no words, and an item without words no windows; texts and
words of any length are taken whole; every row of the documents gives one row, equal rows too; items
with one id are one item with the windows of all its rows; an item without id marks what it hits, but
is not counted or listed; empty tables: no rows, or no hits; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bitmaps import bitmap, holds
from .shared import bytes_of, cut, small
from .shingles import Hasher
from .text_bytes import LOWERED, chunks, runs

#: Words of a window, and of a shingle.
WINDOW, SHINGLE = 10, 5
#: Text bytes that are worked on together.
CHUNK = 1 << 20

SEPARATOR = np.ones(256, dtype=bool)
SEPARATOR[0x30:0x3A] = SEPARATOR[0x41:0x5B] = SEPARATOR[0x61:0x7B] = SEPARATOR[0x80:] = False
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("item_id", pa.int64()), ("window", pa.string()), ("n", pa.int32())])
    for batch in batches:
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = _WORD.findall((text or "").encode("utf-8").lower())
            size = min(WINDOW, len(words))
            if not size:
                continue
            found = list(dict.fromkeys(b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([item] * len(found), pa.int64()), pa.array(found).cast(pa.string()), pa.array([size] * len(found), pa.int32())], schema=schema
            )


def _window_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("wid", pa.int64()), ("offset", pa.int32()), ("shingle", pa.int64())])
    hasher = Hasher(separators=SEPARATOR)
    for batch in batches:
        rows = []
        for wid, window in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            data = np.frombuffer(window.encode("utf-8"), dtype=np.uint8)
            hashes, _ = hasher.words(data, np.array([len(data)]))
            found = hasher.shingles(hashes, min(SHINGLE, len(hashes))).view(np.int64)
            rows += [(wid, i, int(h)) for i, h in enumerate(found)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


class _Scan:
    """Places of wanted shingles in chunks of texts."""

    def __init__(self, bits, sizes: list[int]):
        self.bits, self.sizes, self.hasher = bits, sizes, Hasher(separators=SEPARATOR)

    def hits(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray]]]:
        """Number of words up to the end of each text, and ``(size, places, hashes)`` of the wanted shingles, by place among all words."""
        hashes, upto = self.hasher.words(data, ends)
        found = []
        for size in self.sizes:
            if len(hashes) < size:
                continue
            shingles = self.hasher.shingles(hashes, size)
            at = np.flatnonzero(holds(self.bits, shingles))
            # Not those that reach into a next text.
            at = at[at + size <= upto[np.searchsorted(upto, at, side="right")]]
            found.append((size, at, shingles[at]))
        return upto, found


def _counts(bits, sizes: list[int]):
    schema = pa.schema([("shingle", pa.int64()), ("n", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = _Scan(bits.value, sizes)
        for batch in batches:
            for _, data, ends in chunks(batch.column(0), CHUNK):
                for _, _, hashes in scan.hits(data, ends)[1]:
                    if len(hashes):
                        distinct, counts = np.unique(hashes, return_counts=True)
                        yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(counts.astype(np.int64))], schema=schema)

    return read


HIT = pa.struct([("shingle", pa.int64()), ("at", pa.int64()), ("begin", pa.int64()), ("words", pa.string())])


def _places(bits, sizes: list[int]):
    """Every document with the places of wanted shingles and the words that a window around them can have."""
    schema = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("hits", pa.list_(HIT))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = _Scan(bits.value, sizes)
        for batch in batches:
            for row, data, ends in chunks(batch.column(1), CHUNK):
                upto, found = scan.hits(data, ends)
                hits: list[list[dict] | None] = [None] * len(ends)
                if any(len(at) for _, at, _ in found):
                    low, starts = LOWERED[data], np.concatenate([[0], upto[:-1]])
                    first, last = runs(~SEPARATOR[data], ends)
                    for size, at, hashes in found:
                        for text, place, h in zip(np.searchsorted(upto, at, side="right").tolist(), at.tolist(), hashes.view(np.int64).tolist()):
                            begin = int(starts[text])
                            near = max(begin, place - (WINDOW - size)), min(int(upto[text]), place + WINDOW)
                            words = b" ".join(low[a:b].tobytes() for a, b in zip(first[slice(*near)].tolist(), last[slice(*near)].tolist()))
                            hit = {"shingle": h, "at": place - begin, "begin": near[0] - begin, "words": words.decode("utf-8")}
                            hits[text] = hits[text] or []
                            hits[text].append(hit)
                n_words = np.diff(upto, prepend=0).astype(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(ends)), pa.array(n_words), pa.array(hits, pa.list_(HIT))], schema=schema)

    return read


def _merged(spans: DataFrame) -> DataFrame:
    """``row, spans``: the union of the ``[start, end)`` of every row."""
    ordered = Window.partitionBy("row").orderBy("start", "end")
    before = F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    fresh = spans.select("row", "start", "end", F.coalesce(F.col("start") > before, F.lit(True)).cast("int").alias("fresh"))
    numbered = fresh.select("row", "start", "end", F.sum("fresh").over(ordered.rowsBetween(Window.unboundedPreceding, 0)).alias("number"))
    joined = numbered.groupBy("row", "number").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return joined.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))


def contaminated_spans(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``id, n_words, spans, items`` of every document.

    ``spans`` are the runs of words, from the first up to the one behind the last, that windows of items cover; ``items`` are the
    ids of the items that have these windows, sorted as strings.
    """
    rows = items.select(F.col(item_key).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    held = cut(rows.mapInArrow(_item_windows, "item_id long, window string, n int"))
    windows = cut(held.select("window", "n").distinct().withColumn("wid", F.monotonically_increasing_id()))
    sizes = sorted(r["size"] for r in windows.select(F.least("n", F.lit(SHINGLE)).alias("size")).distinct().collect())
    shingles = cut(windows.select("wid", "window").mapInArrow(_window_shingles, "wid long, offset int, shingle long"))
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    counted = texts.select("text").mapInArrow(_counts(bitmap(shingles, "shingle"), sizes), "shingle long, n long")
    frequent = counted.groupBy("shingle").agg(F.sum("n").alias("n"))
    # A shingle that no document has is the rarest of its windows: they are nowhere.
    rarest = shingles.join(frequent, "shingle", "left").groupBy("wid").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "offset")).alias("least"))
    prefixes = cut(
        rarest.where("least.n > 0").join(windows, "wid").select("wid", "least.shingle", "least.offset", "n", F.split("window", " ").alias("wanted"))
    )
    told = texts.mapInArrow(_places(bitmap(prefixes, "shingle"), sizes), "id long, n_words long, hits array<struct<shingle:long,at:long,begin:long,words:string>>")
    judged = cut(told.withColumn("row", F.monotonically_increasing_id()))
    places = judged.where("hits IS NOT NULL").select("row", "n_words", F.explode("hits").alias("hit")).select("row", "n_words", "hit.*")
    prefix_bytes = bytes_of(prefixes.select(F.array_join("wanted", " ").alias("w")), ["w"], 512)
    start = F.col("at") - F.col("offset")
    bounded = places.join(small(prefixes, prefix_bytes), "shingle").where((start >= 0) & (start + F.col("n") <= F.col("n_words")))
    same = F.slice(F.split("words", " "), (start - F.col("begin") + 1).cast("int"), F.col("n")) == F.col("wanted")
    found = cut(bounded.where((start >= F.col("begin")) & same).select("row", start.alias("start"), (start + F.col("n")).alias("end"), "wid").distinct())
    spans = _merged(found.select("row", "start", "end").distinct())
    patterned = cut(found.groupBy("row").agg(F.array_sort(F.collect_set("wid")).alias("wids")))
    patterns = cut(patterned.select("wids").distinct().withColumn("pattern", F.monotonically_increasing_id()))
    owners = held.where("item_id IS NOT NULL").join(windows, ["window", "n"]).select("wid", "item_id").distinct()
    named = patterns.select("pattern", F.explode("wids").alias("wid")).join(owners, "wid").select("pattern", "item_id").distinct()
    as_text = F.transform(F.array_sort(F.collect_list(F.col("item_id").cast("string"))), lambda x: x.cast("long"))
    items_of = patterns.join(named.groupBy("pattern").agg(as_text.alias("items")), "pattern", "left").select("wids", "items")
    hit = cut(patterned.join(items_of, "wids").select("row", "items").join(spans, "row"))
    width = F.coalesce(F.size("items"), F.lit(0)) * 8 + F.size("spans") * 32 + 64
    hit_bytes = int(hit.agg(F.coalesce(F.sum(width.cast("long")), F.lit(0))).first()[0])
    none = F.array().cast("array<long>"), F.array().cast("array<struct<start:long,end:long>>")
    return judged.select("row", "id", "n_words").join(small(hit, hit_bytes), "row", "left").select(
        "id", "n_words", F.coalesce("spans", none[1]).alias("spans"), F.coalesce("items", none[0]).alias("items")
    )


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every document."""
    found = contaminated_spans(docs, items, key, text, item_key, item_text)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    ids = F.array_join(F.transform("items", lambda x: x.cast("string")), ",")
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(ids.cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
