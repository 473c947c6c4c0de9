"""Removing lines that repeat, exactly or up to one word, across all documents.

A line is its words, with A-Z in lower case. Of equal lines the earliest stays (by document, then
place). Of lines within the edit bound of each other, those that have an earlier such neighbour go.
The bound is one word more, less, or another, but no more than a third of the words: lines of one or two words are
near only if they are equal.

Neighbours are found by deletion variants: a line with one word left out, for every word. Two lines
within one word share a variant, or one is a variant of the other; equal variants meet as equal
64-bit hashes, and the words of a met pair are then compared. Within a set of lines that differ in
the same word every line needs only the earliest, so a set of any size costs one aggregation and
yields one pair for each line. Variants are emitted only for lines that can have a neighbour: one
edit leaves the first or the last part of a line as it is, so a line of which no other line shares
such a part has none, and an edit is outside of the part. Parts are looked up in a bitmap; what it lets pass wrongly meets nothing
later. Words of lines are needed only for those that pass: a second reading of the texts finds them by row and line number.

Defined cases: a null text has no lines and stays null; lines without a word stay; a text of any length is
treated whole; null keys come last; of rows equal in key and text one is the first, and the others
lose all lines that have a word; an empty table gives no rows; input columns named like a result column give way to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bitmaps import bitmap, fitting_bits, holds
from .sharding import prefix_sums
from .shared import cut, first_copies, numbered, only, small
from .shingles import BASE, SPACE, Hasher, U, mixed
from .text_bytes import LOWERED, chunks

#: A line may differ in one word of at least this many.
WORDS_FOR_AN_EDIT = 3
#: Lengths that first and last parts may have: steps small enough that a part is a third of its line.
PART_LENGTHS = np.array([1, *(w * 2**e for e in range(40) for w in (2, 3))])
#: Text bytes that are worked on together: what is made of them fits a core's cache.
CHUNK = 1 << 17
#: Bitmaps that far more hashes are looked up in than they hold have this many times the bits, up to the same bound.
SPARSITY = 16
#: Makes a second, independent hash of a line's words.
SECOND = U(0xC2B2AE3D27D4EB4F)


def words_of(line: str) -> list[bytes]:
    return line.encode("utf-8", "surrogatepass").lower().split()


def part_length(n: np.ndarray) -> np.ndarray:
    """Length of the parts of lines of ``n`` words: the largest step up to half of it."""
    return PART_LENGTHS[np.maximum(np.searchsorted(PART_LENGTHS, n // 2, side="right") - 1, 0)]


class Places:
    """All lines of texts laid end to end, with a word or not: where each ends, its text, and its number there."""

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        feeds = np.flatnonzero(data == 0x0A)
        upto = np.searchsorted(feeds, ends)
        self.closes = np.zeros(len(ends) + len(feeds), dtype=bool)
        self.closes[upto + np.arange(len(ends))] = True
        #: The line feed behind each line, or the end of its text.
        self.end = np.empty(len(self.closes), dtype=np.int64)
        self.end[self.closes], self.end[~self.closes] = ends, feeds
        self.text = np.cumsum(self.closes) - self.closes
        began = np.concatenate([[0], upto[:-1]]) + np.arange(len(ends))
        self.number = np.arange(len(self.end)) - began[self.text]

    def begins(self) -> np.ndarray:
        """First byte of each line."""
        return np.concatenate([[0], (self.end + ~self.closes)[:-1]])


class Lines:
    """The lines with a word of texts laid end to end, and hashes of any stretch of their words."""

    def __init__(self, hasher: Hasher, data: np.ndarray, ends: np.ndarray):
        self.first_byte, self.last_byte, hashes = hasher.spans(data, ends)
        places = Places(data, ends)
        upto = np.searchsorted(self.first_byte, places.end)
        n = np.diff(upto, prepend=0)
        worded = np.flatnonzero(n)
        #: Of each line: its first word, how many it has, its text, and its number there.
        self.at, self.n = (upto - n)[worded], n[worded]
        self.text, self.number = places.text[worded], places.number[worded]
        self.down = hasher.down
        self.sums = [np.concatenate([[U(0)], np.cumsum(values * hasher.up[: len(hashes)])]) for values in (hashes, mixed(hashes ^ SECOND))]

    def stretch(self, at: np.ndarray, n: np.ndarray, which: int = 0) -> np.ndarray:
        """Hashes of ``n`` words from the word ``at`` on."""
        sums = self.sums[which]
        return mixed((sums[at + n] - sums[at]) * self.down[at] + n.astype(np.uint64))

    def parts(self) -> np.ndarray:
        """Hashes of first and last parts, in the lengths that a line and a neighbour can have in common: four rows."""
        found = []
        for n in (part_length(self.n), part_length(self.n - 1)):
            found.append(mixed(self.stretch(self.at, n) ^ U(1)))
            found.append(mixed(self.stretch(self.at + self.n - n, n) ^ U(2)))
        return np.stack(found)

    def edits(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each line the places where an edit leaves a shared part whole: those before the first, or from the second on."""
        (first, last, shorter_first, shorter_last), n, p, q = holds(shared, self.parts()), self.n, part_length(self.n), part_length(self.n - 1)
        before = np.maximum(np.where(last, n - p, 0), np.where(shorter_last, n - q, 0))
        return before, np.minimum(np.where(first, p, n), np.where(shorter_first, q, n))

    def spelled(self, data: np.ndarray) -> pa.Array:
        """The lines as lower-cased words with a space between them."""
        final = self.at + self.n - 1
        # The byte behind a word stands for the space, but not behind the last one of a line.
        gaps = np.delete(self.last_byte, final)
        kept, low = ~SPACE[data], LOWERED[data]
        kept[gaps], low[gaps] = True, 0x20
        offsets = np.zeros(len(self.at) + 1, dtype=np.int64)
        np.cumsum(np.add.reduceat(self.last_byte - self.first_byte, self.at) + self.n - 1, out=offsets[1:])
        return pa.Array.from_buffers(pa.large_string(), len(self.at), [None, pa.py_buffer(offsets), pa.py_buffer(low[kept])]).cast(pa.string())


def _line_batches(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray, Lines]]:
    hasher = Hasher()
    for batch in batches:
        for row, data, ends in chunks(batch.column(column), CHUNK):
            yield batch, row, data, Lines(hasher, data, ends)


PLACE = "h1 long, h2 long, none boolean, key long, text_hash long, line int, spot long"
OCCURRENCE = "key long, text_hash long, line int, head boolean, h1 long, h2 long, parts array<long>"


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every line with a word; ``head`` marks the first one of its row, ``parts`` are those of lines that may have an edit."""
    schema = pa.schema(
        [("key", pa.int64()), ("text_hash", pa.int64()), ("line", pa.int32()), ("head", pa.bool_()), ("h1", pa.int64()), ("h2", pa.int64()), ("parts", pa.list_(pa.int64()))]
    )
    for batch, row, _, lines in _line_batches(batches, 2):
        if not len(lines.at):
            continue
        place = pa.array(row + lines.text)
        head = np.ones(len(lines.at), dtype=bool)
        head[1:] = lines.text[1:] != lines.text[:-1]
        hashes = [pa.array(lines.stretch(lines.at, lines.n, which).view(np.int64)) for which in (0, 1)]
        edits = lines.n >= WORDS_FOR_AN_EDIT
        offsets = np.concatenate([[0], np.cumsum(4 * edits)]).astype(np.int32)
        parts = pa.ListArray.from_arrays(pa.array(offsets), pa.array(lines.parts()[:, edits].T.ravel().view(np.int64)))
        columns = [batch.column(0).take(place), batch.column(1).take(place), pa.array(lines.number.astype(np.int32)), pa.array(head), *hashes, parts]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def spots(key: pa.Array, text_hash: pa.Array, row: np.ndarray, line: np.ndarray) -> np.ndarray:
    """A hash of where each line stands: in the row ``row`` of the columns, as its line ``line``."""
    of_row = mixed(key.fill_null(0).to_numpy().view(np.uint64)) ^ text_hash.to_numpy().view(np.uint64)
    return mixed(mixed(of_row[row]) ^ line.astype(np.uint64))


def _candidates(shared):
    """Of distinct lines, their first places and parts, those that may have a part in common with another one, with their spots."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column("parts")
            offsets = parts.offsets.to_numpy()
            line = np.repeat(np.arange(len(parts)), np.diff(offsets))
            hit = np.zeros(len(parts), dtype=bool)
            hit[line[holds(shared.value, parts.values.to_numpy()[offsets[0] : offsets[-1]])]] = True
            if hit.any():
                found = batch.drop_columns(["parts"]).filter(pa.array(hit))
                spot = spots(found.column("key"), found.column("text_hash"), np.arange(len(found)), found.column("line").to_numpy())
                yield found.append_column("spot", pa.array(spot.view(np.int64)))

    return read


def _first_lines(bits):
    """Words of the lines whose spots may be in the bitmap; only these lines are cut into words."""
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("words", pa.string())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for row, data, ends in chunks(batch.column(2), CHUNK):
                places = Places(data, ends)
                hit = holds(bits.value, spots(batch.column(0), batch.column(1), row + places.text, places.number))
                if not hit.any():
                    continue
                begins, stops = places.begins()[hit], places.end[hit]
                own = np.concatenate([data[a:b] for a, b in zip(begins.tolist(), stops.tolist())])
                lines = Lines(hasher, own, np.cumsum(stops - begins))
                if not len(lines.at):
                    continue
                h1, h2 = (lines.stretch(lines.at, lines.n, which).view(np.int64) for which in (0, 1))
                # Equal lines of a stretch of texts are handed on once.
                once = pa.array(np.unique(h1, return_index=True)[1])
                yield pa.RecordBatch.from_arrays([pa.array(h1), pa.array(h2), lines.spelled(own)], schema=schema).take(once)

    return read


def variant_hashes(lines: Lines, before: np.ndarray, behind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all lines: which line, the place left out (-1: none), and the hash of what is left.

    Places are left out that stand before ``before``, or at ``behind`` or later.
    """
    sums, base, end = lines.sums[0], lines.sums[0][lines.at], lines.sums[0][lines.at + lines.n]
    line = np.repeat(np.arange(len(lines.at)), lines.n)
    word = np.arange(len(line))
    place = word - lines.at[line]
    edited = (place < before[line]) | (place >= behind[line])
    line, word, place = line[edited], word[edited], place[edited]
    # What stands behind the word left out moves one place to the front.
    kept = (sums[word] - base[line]) + (end[line] - sums[word + 1]) * U(pow(BASE, -1, 1 << 64))
    without = mixed(kept * lines.down[lines.at[line]] + (lines.n[line] - 1).astype(np.uint64))
    whole = lines.stretch(lines.at, lines.n)
    places = np.concatenate([np.full(len(whole), -1), place])
    return np.concatenate([np.arange(len(whole)), line]), places, np.concatenate([whole, without])


def _variants(shared, bits):
    """``(variant, place, rank)``: the line itself with place -1, and without the word at each place where it may differ.

    A neighbour has a part in common, so an edit is outside of one that is in the bitmap ``shared``. With ``bits``
    only variants that may be in that bitmap.
    """
    schema = pa.schema([("variant", pa.int64()), ("place", pa.int32()), ("rank", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, row, _, lines in _line_batches(batches, 1):
            ranks = batch.column(0).to_numpy()[row + lines.text]
            # All places outside of the part: a neighbour may differ in any of them. A word more that is inside of it repeats up
            # to the part's end, and the word behind that is equal: left out there, the same is left.
            line, places, variants = variant_hashes(lines, *lines.edits(shared.value))
            if bits is not None:
                hit = holds(bits.value, variants)
                line, places, variants = line[hit], places[hit], variants[hit]
            if len(line):
                yield pa.RecordBatch.from_arrays([pa.array(variants.view(np.int64)), pa.array(places.astype(np.int32)), pa.array(ranks[line])], schema=schema)

    return read


def _met_lines(bits):
    """Of numbered lines, the number first, those that may be in the bitmap."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = holds(bits.value, batch.column(0).to_numpy())
            if hit.any():
                yield batch.filter(pa.array(hit))

    return read


def within_one(a: list[str], b: list[str]) -> bool:
    """Whether one word less, more or other turns ``a`` into ``b``."""
    if abs(len(a) - len(b)) > 1:
        return False
    short = min(len(a), len(b))
    first = next((i for i in range(short) if a[i] != b[i]), short)
    last = next((i for i in range(short - first) if a[-1 - i] != b[-1 - i]), short - first)
    return first + last >= max(len(a), len(b)) - 1


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, _, own, other = (c.to_pylist() for c in batch.columns)
        good = [i for i in range(len(own)) if within_one(own[i].split(" "), other[i].split(" "))]
        if good:
            yield batch.select([0, 1]).take(pa.array(good))


def _first_of(key: str = "key") -> Column:
    return F.min(F.struct(F.col(key).isNull().alias("none"), key, "text_hash", "line")).alias("first")


def removed_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``text_hash``, ``lines``, ``judged`` of the documents that lose lines: the numbers of those, from 0.

    ``judged`` is set for rows equal in key and text: what all but the first of them lose.
    """
    bare = docs.select(F.col(key).cast("long").alias("key"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    seen = cut(bare.mapInArrow(_occurrences, OCCURRENCE))
    distinct = cut(seen.groupBy("h1", "h2").agg(_first_of(), F.count("*").alias("n"), F.first("parts").alias("parts")))
    near = _near_lines(bare, distinct)
    # Lines that have something to lose: further copies, or an earlier neighbour.
    losing = distinct.drop("parts").join(near.withColumn("near", F.lit(True)), ["h1", "h2"], "left").where("n > 1 OR near")
    met = seen.select("key", "text_hash", "line", "h1", "h2").join(losing.select("h1", "h2", "first", "near"), ["h1", "h2"])
    own = F.struct(F.col("key").isNull().alias("none"), "key", "text_hash", "line")
    gone = met.where(F.coalesce("near", F.lit(False)) | ~own.eqNullSafe(F.col("first")))
    lost = gone.groupBy("key", "text_hash").agg(F.sort_array(F.collect_set("line")).alias("lines"))
    repeated = cut(seen.where("head").groupBy("key", "text_hash").agg(F.count("*").alias("rows")).where("rows > 1"))
    none = F.lit(None).cast("array<int>")
    n_repeated = repeated.count()
    if not n_repeated:
        return lost.select("*", none.alias("judged"))
    same = F.col("s.key").eqNullSafe(F.col("c.key")) & (F.col("s.text_hash") == F.col("c.text_hash"))
    copied = seen.alias("s").join(small(repeated, n_repeated * 64).alias("c"), same, "left_semi")
    judged = copied.groupBy("key", "text_hash").agg(F.sort_array(F.collect_set("line")).alias("judged"))
    both = cut(lost).select("*", none.alias("judged")).unionByName(judged.select("*", none.alias("lines")))
    return both.groupBy("key", "text_hash").agg(F.max("lines").alias("lines"), F.max("judged").alias("judged"))


def _near_lines(bare: DataFrame, distinct: DataFrame) -> DataFrame:
    """``h1``, ``h2`` of the lines that have an earlier neighbour."""
    parts = distinct.select(F.explode(F.array_distinct("parts")).alias("part")).groupBy("part").count()
    twice = cut(parts.where("count > 1").select("part"))
    shared = bitmap(twice, "part", fitting_bits(twice.count() * SPARSITY))
    # A line's number in the order of first places: it stands for the line, and tells which is earlier. It is found without words.
    placed = cut(distinct.select("h1", "h2", "first.*", "parts").mapInArrow(_candidates(shared), PLACE))
    spot = bitmap(placed, "spot", fitting_bits(placed.count() * SPARSITY))
    places = placed.drop("spot")
    order = [F.col(c) for c in ("none", "key", "text_hash", "line")]
    numbers = prefix_sums(places, order, F.lit(1)).select("h1", "h2", F.col("_rows_before").alias("rank"))
    hits = bare.mapInArrow(_first_lines(spot), "h1 long, h2 long, words string")
    worded = hits.groupBy("h1", "h2").agg(F.first("words").alias("words"))
    ranked = cut(worded.join(numbers, ["h1", "h2"]).select("rank", "h1", "h2", "words"))
    emitted = "variant long, place int, rank long"
    texts = ranked.select("rank", "words")
    twice = texts.mapInArrow(_variants(shared, None), emitted).groupBy("variant").count().where("count > 1")
    # Variants that a single line makes meet nothing; they are not shuffled as rows.
    met_twice = cut(twice.select("variant"))
    variants = cut(texts.mapInArrow(_variants(shared, bitmap(met_twice, "variant", fitting_bits(met_twice.count() * SPARSITY))), emitted))
    # Another word at the same place: the earliest line of the set is a neighbour of all others.
    several = variants.where("place >= 0").groupBy("variant", "place").agg(F.min("rank").alias("other"), F.count("*").alias("n"))
    swapped = variants.join(several.where("n > 1"), ["variant", "place"]).select("rank", "other")
    # A word more or less: a line and the lines of which it is a variant.
    whole = variants.where("place = -1").select("variant", F.col("rank").alias("whole"))
    longer = variants.where("place >= 0").join(whole, "variant")
    first_longer = longer.groupBy("whole").agg(F.min("rank").alias("other"))
    links = swapped.unionAll(longer.select("rank", F.col("whole").alias("other"))).unionAll(first_longer.select("whole", "other"))
    nearest = cut(links.where("other < rank").groupBy("rank").agg(F.min("other").alias("other")))
    # Only words of lines that are in a pair are shuffled.
    paired = cut(nearest.select(F.explode(F.array("rank", "other")).alias("rank")).distinct())
    spelled = cut(ranked.mapInArrow(_met_lines(bitmap(paired, "rank", fitting_bits(paired.count()))), "rank long, h1 long, h2 long, words string"))
    pairs = nearest.join(spelled.withColumnRenamed("words", "own"), "rank").join(
        spelled.select(F.col("rank").alias("other"), F.col("words").alias("others")), "other"
    )
    return pairs.select("h1", "h2", "own", "others").mapInArrow(_verified, "h1 long, h2 long")


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with the text that is left, ``n_lines``, ``n_removed``, and ``emptied``.

    ``emptied`` is true if there was a line with a word and every such line has gone.
    """
    lost = cut(removed_lines(docs, key, text))
    repeated = lost.agg(F.count("judged")).first()[0]
    rows = docs.select(F.struct("*").alias("_row"), F.col(key).cast("long").alias("key"), F.xxhash64(text).alias("text_hash"))
    same = F.col("d.key").eqNullSafe(F.col("l.key")) & (F.col("d.text_hash") == F.col("l.text_hash"))
    # Nearly every document has a line to lose: one way for every size.
    met = rows.alias("d").join(lost.hint("merge").alias("l"), same, "left").select("d.*", "l.lines", "l.judged")
    if repeated:
        copies = numbered(met.where("judged IS NOT NULL"), "_row")
        first = first_copies(copies, ["key", "text_hash"]).withColumn("_is_first", F.lit(True))
        told = copies.join(first, ["_look", "_number"], "left")
        told = told.withColumn("lines", F.when(F.col("_is_first"), F.col("lines")).otherwise(F.col("judged")))
        met = met.where("judged IS NULL").unionAll(told.select(*met.columns))
    whole = F.col("_row")[text]
    met = met.select("_row", F.split(whole, "\n").alias("_lines"), F.col("lines").alias("_lost"))
    stays = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_lost"))
    met = met.withColumn("_left", F.when(F.col("_lost").isNotNull(), F.transform(stays, lambda i: F.get("_lines", i))))
    worded = F.exists("_left", lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    new = {
        text: F.when(F.col("_left").isNotNull(), F.array_join("_left", "\n")).otherwise(whole),
        "n_lines": F.coalesce(F.size("_lines"), F.lit(0)).cast("long"),
        "n_removed": F.coalesce(F.size("_lost"), F.lit(0)).cast("long"),
        "emptied": F.coalesce(~worded, F.lit(False)),
    }
    columns = [F.col("_row")[c].alias(c) for c in docs.columns if c.lower() not in new]
    return met.select(*columns, *[c.alias(n) for n, c in new.items()])


def left_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with what is left of their texts, without those of which no line with a word is left though there was one."""
    wrapped = docs.select(F.struct("*").alias("row"), F.col(key).alias("k"), F.col(text).alias("t"))
    columns = [(F.col("t") if c == text else F.col("row")[c]).alias(c) for c in docs.columns]
    return only(dedup_lines(wrapped, "k", "t"), ~F.col("emptied"), F.struct(*columns))
