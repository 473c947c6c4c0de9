"""Spelling variants: words one edit apart, found by walking a trie of all words level by level.

The trie is a table of edges ``(node, char, child)``. A search state is ``(word, position, node,
edits)``. Words that begin alike share their states: a word up to a position is the trie node of its
first code points, so a state is a pair of nodes ``(mine, node)``. States without an edit pair a
node with itself; they are the nodes, and need no join. With the first edit a state goes to a pair of
two children of a node (another code point) or of a child and its parent (one code point more). From there
both sides must read the same: the frontier is joined with the edges of ``mine`` and the edges of
``node``, one code point a level. Edits are symmetric, so each pair of nodes is walked once.

A word that is alone below a node leaves the trie there: its rest is one edge. A state that comes to
such an edge knows the one word that could be its other half, and looks it up by its hash. An end
mark closes every word, so a word that begins another one is such an edge, too.

Nodes and words are 64-bit polynomial hashes; every pair found is checked on the words themselves, so
hashes that clash cost a comparison and lose nothing. Levels go as deep as two words or more run on
below both sides of a state. A group of siblings is bounded by the alphabet; a word has at most some dozens of
near words for each of its places. Counts are aggregated in each task before they are shuffled.

Words: see ``vocabulary``. Near words differ by one inserted, deleted or replaced code point.

Defined cases: null and empty texts have no words; texts and runs of any length are taken whole; a
null id is written as nothing before the colon; repeated rows count again; ties of ``n`` go to the
word first in code-point order; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bitmaps import bitmap, holds
from .shared import cut
from .shingles import BASE, U, mixed, powers
from .text_bytes import LOWERED, chunks, runs, strings

#: Code points and occurrences that a word has at least, and how many times as frequent a form is.
LEAST_LENGTH, LEAST_COUNT, FORM_TIMES = 6, 5, 5
#: One occurrence in this many loses a code point.
DAMAGED = 199
#: Text bytes that are counted together.
CHUNK = 1 << 23
#: Runs up to this many bytes have the shift of their checksum worked out once for a text.
SHORT = 64

LETTER = np.zeros(256, dtype=bool)
LETTER[0x41:0x5B] = LETTER[0x61:0x7B] = True
#: U+00C0 to U+00FF are the characters whose first byte is this one.
LATIN = 0xC3


def letters(data: np.ndarray) -> np.ndarray:
    """Bytes of the code points ``A-Za-z`` and U+00C0 to U+00FF."""
    inside = LETTER[data]
    lead = data == LATIN
    inside |= lead
    inside[1:] |= lead[:-1]
    return inside


def _checksums(texts: np.ndarray, lengths: np.ndarray, keys: list[int], of_word: np.ndarray) -> np.ndarray:
    """CRC-32 of key and run for every occurrence, from those of the keys and of the runs alone.

    The checksum of two strings in a row is that of the second, xor a linear function of that of the
    first which depends on the second's length only.
    """
    found = of_word.copy()
    width = int(lengths.max(initial=0)) + 1
    zeros = bytes(width)
    plain = [zlib.crc32(zeros[:n]) for n in range(width)]
    shift = np.zeros((len(keys), width), dtype=np.uint32)
    pairs = np.unique(texts * width + lengths)
    for text, n in zip((pairs // width).tolist(), (pairs % width).tolist()):
        shift[text, n] = zlib.crc32(zeros[:n], keys[text]) ^ plain[n]
    found ^= shift[texts, lengths]
    return found


def count_words(ids: list[int | None], data: np.ndarray, ends: np.ndarray) -> tuple[pa.Array, np.ndarray, Counter]:
    """Distinct runs and their counts as they stand, and the counts of what damaged occurrences became."""
    inside = letters(data)
    first, last = runs(inside, ends)
    encoded = strings(LOWERED[data], inside, first, last).dictionary_encode()
    words, which = encoded.dictionary, encoded.indices.to_numpy()
    if not len(words):
        return words, np.zeros(0, np.int64), Counter()
    counts = np.bincount(which, minlength=len(words))
    spelled = words.to_pylist()
    of_word = np.fromiter((zlib.crc32(w.encode()) for w in spelled), np.uint32, len(words))
    texts = np.searchsorted(ends, first, side="right")
    lengths = last - first
    keys = [zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids]
    short = lengths <= SHORT
    sums = np.zeros(len(which), dtype=np.uint32)
    sums[short] = _checksums(texts[short], lengths[short], keys, of_word[which[short]])
    for at in np.flatnonzero(~short).tolist():
        sums[at] = zlib.crc32(spelled[which[at]].encode(), keys[texts[at]])
    hit = np.flatnonzero(sums % np.uint32(DAMAGED) == 0)
    np.subtract.at(counts, which[hit], 1)
    became: Counter = Counter()
    for word, h in zip(which[hit].tolist(), sums[hit].tolist()):
        whole = spelled[word]
        at = h % len(whole)
        became[whole[:at] + whole[at + 1 :]] += 1
    return words, counts, became


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("word", pa.large_string()), ("n", pa.int64())])
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for at, data, ends in chunks(batch.column(1), CHUNK):
            words, counts, became = count_words(ids[at : at + len(ends)], data, ends)
            left = np.flatnonzero(counts)
            if len(left):
                yield pa.RecordBatch.from_arrays([words.take(pa.array(left)), pa.array(counts[left])], schema=schema)
            if became:
                yield pa.RecordBatch.from_arrays([pa.array(list(became), pa.large_string()), pa.array(list(became.values()))], schema=schema)


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n``: the words of at least ``LEAST_LENGTH`` code points that occur ``LEAST_COUNT`` times or more.

    Words are maximal runs of ``A-Za-z`` and U+00C0 to U+00FF with A-Z in lower case. An occurrence whose CRC-32 of ``<key>:<word>`` is
    divisible by ``DAMAGED`` counts for the word without the code point at that number modulo its length.
    """
    rows = docs.select(F.col(key).cast("long"), F.col(text))
    counted = rows.mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where((F.col("n") >= LEAST_COUNT) & (F.char_length("word") >= LEAST_LENGTH))


def _codes(word: str) -> np.ndarray:
    """Values of the code points of a word and of its end mark."""
    points = np.frombuffer((word + "\0").encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    return mixed((points + U(1)) * U(0xD1342543DE82EF95))


def prefix_hashes(word: str) -> np.ndarray:
    """Hashes of all beginnings of a word, from the empty one to the word with its end mark."""
    codes = _codes(word)
    found = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(codes * powers(BASE, len(codes)), out=found[1:])
    return found


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words -> ``(node, char, child, whole)``: every step of every word; ``whole`` is the word's hash."""
    schema = pa.schema([(n, pa.int64()) for n in ("node", "char", "child", "whole")])
    for batch in batches:
        held: list[tuple] = []
        size = 0
        for word in batch.column(0).to_pylist():
            hashes = prefix_hashes(word).view(np.int64)
            points = np.frombuffer((word + "\0").encode("utf-32-le"), dtype="<u4").astype(np.int64)
            held.append((hashes[:-1], points, hashes[1:], np.full(len(points), hashes[-1])))
            size += len(points)
            if size > 1 << 18:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], schema=schema)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], schema=schema)


def trie_edges(words: DataFrame) -> DataFrame:
    """``node, char, child, whole`` of the trie: ``whole`` is the hash of the word that is alone below ``child``, or null.

    Nodes with one word below have no edges of their own. ``char`` 0 is the end mark.
    """
    steps = words.select("word").mapInArrow(_prefixes, "node long, char long, child long, whole long")
    one = F.when(F.min("whole") == F.max("whole"), F.min("whole"))
    counted = cut(steps.groupBy("node", "char", "child").agg(one.alias("whole")))
    # Only a child with several words below has edges; so has the root, if there is a word.
    inner = counted.where("whole IS NULL").select(F.col("child").alias("node")).distinct()
    rooted = inner.unionByName(words.sparkSession.range(1).select(F.lit(0).cast("long").alias("node"))).distinct()
    return cut(counted.join(rooted, "node", "left_semi"))


def _needed(bits):
    """States with a word that is alone on a side -> ``(whole, other)``: the hash of the word that its other half would have."""
    schema = pa.schema([("whole", pa.int64()), ("other", pa.int64())])
    back = U(pow(BASE, -1, 1 << 64))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mine, node = (batch.column(i).to_numpy().view(np.uint64) for i in (0, 1))
            longer = batch.column(2).to_numpy(zero_copy_only=False)
            own, others = (batch.column(i).fill_null(0).to_numpy().view(np.uint64) for i in (3, 4))
            alone = batch.column(3).is_valid().to_numpy(zero_copy_only=False)
            # The rest of one side's word behind the beginning of the other side, one place nearer or further if lengths differ.
            by_own = node + (own - mine) * np.where(longer, back, U(1))
            by_other = mine + (others - node) * np.where(longer, U(BASE), U(1))
            whole, other = np.where(alone, own, others), np.where(alone, by_own, by_other)
            fits = holds(bits.value, other) & (~(alone & batch.column(4).is_valid().to_numpy(zero_copy_only=False)) | (other == others))
            yield pa.RecordBatch.from_arrays([pa.array(c[fits].view(np.int64)) for c in (whole, other)], schema=schema)

    return read


STATE = ["mine", "node", "longer", "own", "others"]


def _first_edits(edges: DataFrame) -> DataFrame:
    """States right behind the edit."""
    a, b = edges.where("char <> 0").alias("a"), edges.where("char <> 0").alias("b")
    # Siblings: a node has one for each code point of the alphabet at most.
    replaced = a.join(b, (F.col("a.node") == F.col("b.node")) & (F.col("a.char") < F.col("b.char"))).select(
        F.col("a.child").alias("mine"), F.col("b.child").alias("node"), F.lit(False).alias("longer"), F.col("a.whole").alias("own"), F.col("b.whole").alias("others")
    )
    more = edges.where("char <> 0").select(F.col("child").alias("mine"), "node", F.lit(True).alias("longer"), F.col("whole").alias("own"), F.lit(None).cast("long").alias("others"))
    return replaced.unionByName(more)


def _next_level(states: DataFrame, edges: DataFrame) -> DataFrame:
    """Both sides of every state read one more code point, the same one."""
    a = edges.select(F.col("node").alias("mine"), "char", F.col("child").alias("mine_next"), F.col("whole").alias("own"))
    b = edges.select("node", "char", F.col("child").alias("node_next"), F.col("whole").alias("others"))
    read = states.select("mine", "node", "longer").join(a, "mine").join(b, ["node", "char"])
    return read.select(F.col("mine_next").alias("mine"), F.col("node_next").alias("node"), "longer", "own", "others")


def near_words(words: DataFrame) -> DataFrame:
    """``word, n, other, other_n``: every pair of near words of a stored ``word, n`` table, in both directions."""
    edges = trie_edges(words)
    known = cut(words.mapInArrow(_whole, "whole long, word string, n long"))
    bits = bitmap(known, "whole")
    inner = F.col("own").isNull() & F.col("others").isNull()
    met = []
    states = cut(_first_edits(edges))
    while True:
        met.append(states.where(~inner).select(*STATE).mapInArrow(_needed(bits), "whole long, other long"))
        walking = states.where(inner)
        if not walking.take(1):
            break
        states = cut(_next_level(walking, edges))
    pairs = met[0]
    for more in met[1:]:
        pairs = pairs.unionByName(more)
    looked = pairs.distinct().join(known, "whole").join(
        known.select(F.col("whole").alias("other"), F.col("word").alias("other_word"), F.col("n").alias("other_n")), "other"
    )
    checked = cut(looked.where(F.levenshtein("word", "other_word", 1) == 1).select("word", "n", F.col("other_word").alias("other"), "other_n").distinct())
    back = checked.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    # A state and its mirror image may both have come to a pair.
    return checked.unionByName(back).distinct()


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("whole", pa.int64()), ("word", pa.string()), ("n", pa.int64())])
    for batch in batches:
        words = batch.column(0).to_pylist()
        hashes = np.fromiter((prefix_hashes(w)[-1] for w in words), np.uint64, len(words)).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(words, pa.string()), batch.column(1).cast(pa.int64())], schema=schema)


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the vocabulary.

    ``form`` is the near word of largest ``n``, if that is ``FORM_TIMES`` times the word's; ``root`` is where forms lead.
    """
    words = cut(vocabulary(docs, key, text))
    best = F.min(F.struct((-F.col("other_n")).alias("n"), "other"))
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    frequent = F.col("best").isNotNull() & (-F.col("best.n") >= FORM_TIMES * F.col("n"))
    formed = cut(
        words.join(near, "word", "left").select(
            "word",
            F.when(frequent, F.col("best.other")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(frequent, -F.col("best.n")).cast("long").alias("form_n"),
        )
    )
    # Each hop makes n five times as large, so chains are short; every round doubles what a word has jumped.
    roots = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = cut(roots.join(further, "root", "left"))
        if not jumped.where("next IS NOT NULL").take(1):
            break
        roots = jumped.select("word", F.coalesce("next", "root").alias("root"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
