"""Similarity join of documents by their word shingles, and the groups that the links make.

Sets of shingle hashes are put in one global order, frequent shingles last, so that two sets with a
Jaccard similarity of at least t must share one of their first ``n - ceil(t n) + 1`` elements, and a
certain number of them. Candidates are found on these prefixes alone. Then the sets of the candidates
are stored in prefix trees: a set that is looked up walks down the tree, counts its overlap once for
all sets that share the way, and leaves a subtree as soon as the elements that remain on either side
cannot bring the overlap up to what the least set below needs.

Any fixed order gives the same links; a good one has what no other document shares in front. Of the
shingles with the least hashes (``REGION`` of all, more than a prefix takes) it is counted exactly
which ones two documents have. First come those that only one has, so documents that share less than
about half of their text have nothing in their prefixes that could meet; then all beyond the region, then the shared ones. Very frequent
shingles come last, by a count sketch of fixed size over all documents. The four leading bits of an element
are its level in this order.

What keeps hot groups linear: equal sets are one class. In a prefix element every class is first
compared with one of them, the one with the least share of shingles of its own, so that the elements of a group agree on it;
what that links is one component. Pairs are made only across components, and only if lengths and places of the shared element allow a link:
in front of it stands what the other set has not. For them the sets are ordered anew, by exact counts among the classes that are left:
what only one component has comes first. While these make many more pairs than members, classes are compared with a few centres
of their groups and the components joined; pairs are made of what then is left. Trees are built for groups of bounded size.

Elements are 60 bits of a hash and 4 bits of level. Equal sets are told by two 64-bit sums.

Defined cases: null and empty texts and texts without words have an empty set and link with nothing;
a text with fewer words than a shingle is one shingle; texts of any length are taken whole; rows equal
in id and text are one document; a null id never names a group while another id can; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bitmaps import bitmap, fitting_bits, holds
from .components import components, joined
from .shared import cut, first_copies, numbered, small
from .shingles import Hasher, U, text_sets

#: Similarity from which two documents link, as a fraction.
LINK = (4, 5)
#: Slots of the frequency sketch, and those summed up together.
SLOTS, BLOCK = 1 << 22, 1 << 16
#: Sketches that are summed up in one group.
SUMMED = 64
#: Counts that a slot has besides noise before its shingles count as frequent.
FREQUENT = 8
#: Bare hashes below this are counted exactly: a share of all that is larger than a prefix.
REGION = int(0.35 * (1 << 60))
#: Levels of the order: what only one document has, what was not counted, what two or more have; frequent ones follow.
ALONE, UNCOUNTED, SHARED = range(3)
#: Set elements in a group of a tree.
TREE_ELEMENTS = 1 << 20
#: Pairs for a member of a group that are made at once; with more, members are first compared with centres.
PAIRS_AT_ONCE = 16
#: Centres that an element has in the first turn, and how many times more in each further one.
CENTRES = 8


def least_overlap(n: int, m: int) -> int:
    """Common elements that sets of ``n`` and ``m`` elements need to link."""
    top, bottom = LINK
    return -(-top * (n + m) // (top + bottom))


def prefix_length(n: int) -> int:
    top, bottom = LINK
    return n - -(-top * n // bottom) + 1


def ordered(hashes: np.ndarray, levels: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Hashes as elements in the global order."""
    bare = hashes >> U(4)
    level = np.full(len(bare), UNCOUNTED, dtype=np.uint64)
    counted = bare < U(REGION)
    level[counted] = np.where(holds(shared, bare[counted]), U(SHARED), U(ALONE))
    frequent = levels[(bare & U(SLOTS - 1)).astype(np.int64)].astype(np.uint64)
    level = np.where(frequent > 0, U(SHARED) + np.minimum(frequent, U(15 - SHARED)), level)
    return np.sort(bare | level << U(60))


def _sketch(seed: int):
    schema = pa.schema([("block", pa.int32()), ("part", pa.int64()), ("counts", pa.binary())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, counts = Hasher(seed), np.zeros(SLOTS, dtype=np.int64)
        for batch in batches:
            held: list[np.ndarray] = []
            for found in text_sets(batch.column(0), hasher):
                held.append(found)
                if sum(map(len, held)) > 1 << 18:
                    _count(counts, held)
            _count(counts, held)
        if counts.any():
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(SLOTS // BLOCK), pa.int32()),
                    pa.array([part] * (SLOTS // BLOCK), pa.int64()),
                    pa.array([pack_counts(c) for c in counts.reshape(-1, BLOCK)], pa.binary()),
                ],
                schema=schema,
            )

    return count


def _count(counts: np.ndarray, held: list[np.ndarray]) -> None:
    if held:
        slots = ((np.concatenate(held) >> U(4)) & U(SLOTS - 1)).astype(np.int64)
        np.add.at(counts, slots, 1)
        held.clear()


def pack_counts(counts: np.ndarray) -> bytes:
    return zlib.compress(counts.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpack_counts(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").ravel()


def _summed(table: pa.Table) -> pa.Table:
    """The sum of the counts of one block."""
    total = np.zeros(BLOCK, dtype=np.int64)
    for packed in table["counts"]:
        total += unpack_counts(packed.as_py())
    return pa.table({"block": table["block"][:1], "part": pa.array([table["part"][0].as_py() // SUMMED], pa.int64()), "counts": pa.array([pack_counts(total)], pa.binary())})


def frequency_levels(texts: DataFrame, seed: int) -> np.ndarray:
    """The level (0 to 15) of each slot: how often twice as frequent as noise its count is.

    Sketches of the tasks are summed up in a tree; what reaches the driver has a fixed size (64
    packed blocks), whatever the table.
    """
    ddl = "block int, part long, counts binary"
    sketch = cut(texts.mapInArrow(_sketch(seed), ddl))
    while (sketch.agg(F.max("part")).first()[0] or 0) > 0:
        group = F.floor(F.col("part") / SUMMED)
        sketch = cut(sketch.groupBy("block", group.alias("group")).applyInArrow(_summed, ddl))
    counts = np.zeros(SLOTS, dtype=np.int64)
    for row in sketch.toLocalIterator():
        counts[row["block"] * BLOCK : (row["block"] + 1) * BLOCK] += unpack_counts(bytes(row["counts"]))
    noise = FREQUENT + 2 * counts.mean()
    return np.clip(np.floor(np.log2(np.maximum(counts / noise, 0.5))) + 1, 0, 15).astype(np.uint8)


def fingerprint(elements: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums of a set."""
    with np.errstate(over="ignore"):
        one = (elements * U(0xA0761D6478BD642F) ^ (elements >> U(29))) * U(0xE7037ED1A0B428DB)
        two = (elements * U(0x8EBC6AF09C88C6E3) ^ (elements >> U(32))) * U(0x589965CC75374CC3)
        sums = np.array([one.sum(), two.sum() + U(len(elements))], dtype=np.uint64)
    return tuple(int(x) for x in sums.view(np.int64))


def _region(seed: int):
    """The counted shingles of all texts, and how many documents have each; exact for a stretch of texts."""
    schema = pa.schema([("element", pa.int64()), ("n", pa.int32())])

    def made(held: list[np.ndarray]) -> pa.RecordBatch:
        distinct, counts = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(counts.astype(np.int32))], schema=schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(seed)
        for batch in batches:
            held, size = [], 0
            for found in text_sets(batch.column(0), hasher):
                bare = np.unique(found[found < U(REGION << 4)] >> U(4))
                held.append(bare)
                size += len(bare)
                if size > 1 << 17:
                    yield made(held)
                    held, size = [], 0
            if size:
                yield made(held)

    return read


PROFILE = "id long, text_hash long, n int, cid long, second long, first long, own int, shared array<long>"


def _profiles(seed: int, levels: Broadcast, shared: Broadcast):
    """For each text its set's size and fingerprint, and the prefix elements that others may share, behind ``own`` that none has."""
    names = [("id", pa.int64()), ("text_hash", pa.int64()), ("n", pa.int32()), ("cid", pa.int64()), ("second", pa.int64()), ("first", pa.int64()), ("own", pa.int32())]
    schema = pa.schema([*names, ("shared", pa.list_(pa.int64()))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(seed)
        for batch in batches:
            rows = []
            for found in text_sets(batch.column(2), hasher):
                elements = ordered(found, levels.value, shared.value)
                if not len(elements):
                    rows.append((0, None, None, None, None, []))
                    continue
                head = elements[: prefix_length(len(elements))]
                # In front are those that no other document has.
                own = int(np.searchsorted(head, U(UNCOUNTED << 60)))
                rows.append((len(elements), *fingerprint(elements), int(elements[:1].view(np.int64)[0]), own, head[own:].view(np.int64)))
            columns = list(zip(*rows)) or [[]] * 6
            arrays = [batch.column(0), batch.column(1), *(pa.array(c, f.type) for c, f in zip(columns, list(schema)[2:]))]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return read


def _whole_sets(seed: int, levels: Broadcast, shared: Broadcast, wanted: Broadcast):
    """The whole sets of the classes that may be wanted, in the global order."""
    schema = pa.schema([("cid", pa.int64()), ("elements", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(seed)
        for batch in batches:
            rows, size = {}, 0
            for found in text_sets(batch.column(0), hasher):
                if not len(found):
                    continue
                elements = ordered(found, levels.value, shared.value)
                cid = fingerprint(elements)[0]
                if cid not in rows and holds(wanted.value, np.array([cid], dtype=np.int64))[0]:
                    rows[cid] = elements.tobytes()
                    size += len(rows[cid])
                if size > 1 << 21:
                    yield pa.RecordBatch.from_arrays([pa.array(list(rows)), pa.array(list(rows.values()), pa.binary())], schema=schema)
                    rows, size = {}, 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(rows)), pa.array(list(rows.values()), pa.binary())], schema=schema)

    return read


def _spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each element of a class."""
    for batch in batches:
        for row, packed in enumerate(batch.column(3)):
            elements = np.frombuffer(packed.as_py(), dtype=np.int64)
            for at in range(0, len(elements), 1 << 16):
                part = pa.array(elements[at : at + (1 << 16)])
                place = pa.array(np.full(len(part), row))
                columns = [batch.column(c).take(place) for c in range(3)]
                yield pa.RecordBatch.from_arrays([*columns, part], names=["cid", "n", "label", "element"])


class Node:
    """A stretch of elements that all sets below share."""

    __slots__ = ("children", "ends", "least", "most", "stretch")

    def __init__(self, stretch: np.ndarray, size: int):
        self.stretch, self.children, self.ends, self.least, self.most = stretch, {}, [], size, size


class PrefixTree:
    """Sets in the global order, with equal beginnings stored once."""

    def __init__(self):
        self.root = Node(np.zeros(0, np.uint64), 0)
        self.root.least, self.root.most = 1 << 62, 0

    def add(self, name: int, elements: np.ndarray) -> None:
        node, at, size = self.root, 0, len(elements)
        while True:
            node.least, node.most = min(node.least, size), max(node.most, size)
            if at == size:
                node.ends.append(name)
                return
            child = node.children.get(int(elements[at]))
            if child is None:
                child = node.children[int(elements[at])] = Node(elements[at:], size)
                child.ends.append(name)
                return
            common = min(len(child.stretch), size - at)
            other = np.flatnonzero(child.stretch[:common] != elements[at : at + common])
            common = int(other[0]) if len(other) else common
            if common < len(child.stretch):
                # The stretch forks here: its rest becomes a node of its own.
                rest = Node(child.stretch[common:], 0)
                rest.children, rest.ends, rest.least, rest.most = child.children, child.ends, child.least, child.most
                child.stretch, child.children, child.ends = child.stretch[:common], {int(rest.stretch[0]): rest}, []
            node, at = child, at + common

    def links(self, elements: np.ndarray) -> Iterator[tuple[int, int]]:
        """``(name, overlap)`` of the stored sets that link with ``elements``."""
        n = len(elements)
        top, bottom = LINK
        stack = [(self.root, 0, 0)]
        while stack:
            node, at, overlap = stack.pop()
            if node.most * bottom < top * n or top * node.least > n * bottom:
                continue
            need = least_overlap(n, max(node.least, -(-top * n // bottom)))
            step, alive = 16, True
            done = 0
            while done < len(node.stretch):
                part = node.stretch[done : done + step]
                place = np.searchsorted(elements, part)
                overlap += int((elements[np.minimum(place, n - 1)] == part).sum())
                done += len(part)
                # What either side has left behind the last element looked at.
                left = min(node.most - at - done, n - int(np.searchsorted(elements, part[-1], side="right")))
                if overlap + left < need:
                    alive = False
                    break
                step *= 2
            if not alive:
                continue
            at += len(node.stretch)
            for name in node.ends:
                if overlap >= least_overlap(n, at):
                    yield name, overlap
            stack += [(child, at, overlap) for child in node.children.values()]


def _found(parents: dict[int, int], x: int) -> int:
    while parents.setdefault(x, x) != x:
        parents[x] = parents[parents[x]]
        x = parents[x]
    return x


def tree_links(stored: list[tuple[int, np.ndarray]], looked_up: list[tuple[int, np.ndarray]]) -> list[tuple[int, int]]:
    """Links between looked-up and stored sets; of those within one component no more than connect it."""
    tree, parents, found = PrefixTree(), {}, []
    for name, elements in stored:
        tree.add(name, elements)
    for name, elements in looked_up:
        for other, _ in tree.links(elements):
            a, b = _found(parents, name), _found(parents, other)
            if a != b:
                parents[a] = b
                found.append((name, other))
    return found


def _tree_group(table: pa.Table) -> pa.Table:
    sides = ([], [])
    for cid, stored, elements in zip(table["cid"].to_pylist(), table["stored"].to_pylist(), table["elements"]):
        sides[0 if stored else 1].append((cid, np.frombuffer(elements.as_py(), dtype=np.uint64)))
    found = tree_links(*sides)
    a, b = zip(*found) if found else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


class _Corpus:
    """The texts with their order: what the passes over them have in common."""

    def __init__(self, rows: DataFrame):
        self.rows = rows
        self.texts = rows.select("text")
        self.spark = rows.sparkSession
        seed = 0
        while True:
            self.seed = seed
            self.levels = self.spark.sparkContext.broadcast(frequency_levels(self.texts, seed))
            counted = self.texts.mapInArrow(_region(seed), "element long, n int").groupBy("element").agg(F.sum("n").alias("n"))
            twice = cut(counted.where("n > 1").select("element"))
            self.shared = bitmap(twice, "element", fitting_bits(twice.count()))
            self.profiles = cut(rows.select("id", "text_hash", "text").mapInArrow(_profiles(seed, self.levels, self.shared), PROFILE))
            classes = self.profiles.where("cid IS NOT NULL").groupBy("cid")
            self.classes = cut(
                classes.agg(
                    F.first("n").alias("n"),
                    F.first("first").alias("first"),
                    F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("doc"),
                    (F.min("second") != F.max("second")).alias("mixed"),
                )
            )
            # Two different sets with one fingerprint: hash all anew.
            if not self.classes.where("mixed").take(1):
                return
            seed += 1

    def sets(self, wanted: DataFrame) -> DataFrame:
        """The whole sets of the ``wanted`` classes, from one pass over the texts."""
        read = self.texts.mapInArrow(_whole_sets(self.seed, self.levels, self.shared, bitmap(wanted, "cid", fitting_bits(wanted.count()))), "cid long, elements binary")
        # Copies of a text give its set once.
        return cut(read.join(wanted, "cid", "left_semi").dropDuplicates(["cid"]))

    def verified(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """The links ``(a, b)`` among stored ``pairs``, through prefix trees."""
        known = self.classes.select("cid", "n", "first")
        sized = pairs.join(known.select(F.col("cid").alias("b"), F.col("first").alias("tree"), F.col("n").alias("nb")), "b").join(
            known.select(F.col("cid").alias("a"), F.col("n").alias("na")), "a"
        )
        # A tree for the sets that begin with one element, cut where its sets, or those looked up in it, are too many.
        stored = sized.select("tree", "b", "nb").distinct().groupBy("tree").agg(F.ceil(F.sum("nb") / TREE_ELEMENTS).alias("ways"))
        part = F.pmod(F.xxhash64("b"), F.col("ways")).alias("part")
        placed = cut(sized.join(stored, "tree").select("a", "b", "na", "tree", part))
        looked = placed.select("tree", "part", "a", "na").distinct().groupBy("tree", "part").agg(F.ceil(F.sum("na") / TREE_ELEMENTS).alias("turns"))
        turn = F.pmod(F.xxhash64("a"), F.col("turns")).alias("turn")
        grouped = placed.join(looked, ["tree", "part"]).select("a", "b", "tree", "part", turn)
        sides = F.explode(F.array(F.struct(F.col("b").alias("cid"), F.lit(True).alias("stored")), F.struct(F.col("a").alias("cid"), F.lit(False).alias("stored"))))
        routes = grouped.select("tree", "part", "turn", sides.alias("side")).select("tree", "part", "turn", "side.*").distinct()
        met = routes.join(sets, "cid")
        return met.groupBy("tree", "part", "turn").applyInArrow(_tree_group, "a long, b long")

    def labels(self) -> DataFrame:
        """``node`` and ``label`` of all classes that have a link."""
        spread = self.profiles.select("cid", "n", "own", F.posexplode("shared").alias("i", "element")).distinct()
        held = cut(spread.select("cid", "n", "element", (F.col("own") + F.col("i")).alias("at"), (F.col("own") / F.col("n")).alias("apart")))
        # The same centre for all elements of a group, as far as they have it: the class that has least of its own.
        centre = F.min(F.struct("apart", F.xxhash64("cid").alias("h"), "cid", "n", "at")).alias("one")
        many = held.groupBy("element").agg(F.count("*").alias("m"), centre).where("m > 1")
        members = cut(held.drop("apart").join(many, "element"))
        star = members.where((F.col("cid") != F.col("one.cid")) & _may_link("n", "at", "one.n", "one.at"))
        near = cut(star.select(F.col("cid").alias("a"), F.col("one.cid").alias("b")).distinct())
        first = cut(self.verified(near, self.sets(_classes_of(near))))
        known = components(first)
        named = known.withColumnRenamed("node", "cid")
        # Of an element with two classes nothing is left to compare.
        larger = members.where("m > 2").select("element", "cid", "n", "at").join(named, "cid", "left")
        left, n_members, n_pairs = _open_members(larger.select("cid", "n", F.coalesce("label", "cid").alias("label"), "element", "at"))
        if not n_members:
            return known
        if n_pairs <= PAIRS_AT_ONCE * n_members:
            pairs = _pairs_across(left, left, F.col("x.cid") < F.col("y.cid"), _either_way(near))
            return joined(known, cut(self.verified(pairs, self.sets(_classes_of(pairs)))))
        classes = cut(left.select("cid", "n", "label").distinct())
        sets = self.sets(classes.select("cid"))
        return self._across(_ordered_anew(classes, sets), sets, _either_way(near), known)

    def _across(self, members: DataFrame, sets: DataFrame, compared: DataFrame, known: DataFrame) -> DataFrame:
        """The components ``known``, with what connects those of ``members`` further."""
        centres = CENTRES
        while True:
            members, n_members, n_pairs = _open_members(members)
            if not n_members:
                return known
            if n_pairs <= max(PAIRS_AT_ONCE, centres) * n_members:
                pairs = _pairs_across(members, members, F.col("x.cid") < F.col("y.cid"), compared)
                return joined(known, cut(self.verified(pairs, sets)))
            # Of those with least before the element, that can link with most; a few for the elements of one group.
            look = F.struct(F.floor(F.col("at") * 40 / F.col("n")).alias("step"), F.xxhash64("cid", F.pmod(F.xxhash64("element"), F.lit(4))).alias("h"))
            seat = F.pmod(F.xxhash64("cid", F.lit(centres)), F.lit(centres)).alias("seat")
            centre = F.min(F.struct(look.alias("look"), "cid", "n", "at", "label")).alias("one")
            chosen = cut(members.where("able").groupBy("element", seat).agg(centre).select("element", "one.*"))
            pairs = _pairs_across(members, chosen, F.lit(True), compared)
            known = joined(known, cut(self.verified(pairs, sets)))
            compared = cut(compared.unionByName(pairs))
            named = known.select(F.col("node").alias("cid"), F.col("label").alias("known"))
            # A centre has met all others of the element.
            left = members.join(chosen, ["element", "cid"], "left_anti").join(named, "cid", "left")
            members = left.select("cid", "n", F.coalesce("known", "label").alias("label"), "element", "at")
            centres *= CENTRES


def _classes_of(pairs: DataFrame) -> DataFrame:
    return cut(pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct())


def _either_way(pairs: DataFrame) -> DataFrame:
    """Stored ``pairs``, the lesser class first."""
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _open_members(members: DataFrame) -> tuple[DataFrame, int, int]:
    """The members of groups that may link with one of another component, how many these groups have, and a bound of the pairs.

    The smaller one of a linking pair is ``able`` to link with its like; without such a one a group has no pairs.
    """
    told = cut(members.withColumn("able", _may_link("n", "at", "n", "at")))
    alike = told.groupBy("element", "label").agg(F.count("*").alias("m"), F.count_if("able").alias("c"), F.min(F.when(F.col("able"), F.col("n"))).alias("least"))
    pairs = F.sum("m") * F.sum("c") - F.sum(F.col("m") * F.col("c"))
    groups = cut(alike.groupBy("element").agg(F.sum("m").alias("m"), pairs.alias("pairs"), F.min("least").alias("least")).where("pairs > 0"))
    n_members, n_pairs = groups.agg(F.coalesce(F.sum("m"), F.lit(0)), F.coalesce(F.sum("pairs"), F.lit(0))).first()
    met = told.join(groups.select("element", "least"), "element").where(F.col("able") | _left_for("n", "at", "least"))
    return cut(met.drop("least")), n_members, n_pairs


def _pairs_across(members: DataFrame, others: DataFrame, which: Column, compared: DataFrame) -> DataFrame:
    """Pairs of ``members`` and ``others`` that may link components and are not ``compared`` yet, the lesser class first."""
    across = (F.col("x.element") == F.col("y.element")) & (F.col("x.label") != F.col("y.label")) & which
    met = members.alias("x").join(others.alias("y"), across & _may_link("x.n", "x.at", "y.n", "y.at"))
    pairs = met.select(F.least("x.cid", "y.cid").alias("a"), F.greatest("x.cid", "y.cid").alias("b")).distinct()
    return cut(pairs.join(compared, ["a", "b"], "left_anti"))


def _ordered_anew(classes: DataFrame, sets: DataFrame) -> DataFrame:
    """``cid``, ``n``, ``label``, ``element``, ``at`` of the prefixes of ``classes``, in an order for these alone.

    No two components share what only one has: it comes first, then what the fewest classes have.
    """
    spread = cut(sets.join(classes, "cid").select("cid", "n", "label", "elements").mapInArrow(_spelled, "cid long, n int, label long, element long"))
    met = spread.groupBy("element").agg(F.count("*").alias("m"), F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    common = spread.join(met.select("element", "m"), "element").groupBy("cid", "n", "label").agg(F.sort_array(F.collect_list(F.struct("m", "element"))).alias("common"))
    top, bottom = LINK
    own = F.col("n") - F.size("common")
    length = F.col("n") - F.ceil(F.col("n") * top / bottom).cast("int") + 1
    fronts = common.select("cid", "n", "label", own.alias("own"), F.slice("common", F.lit(1), F.greatest(length - own, F.lit(0))).alias("front"))
    places = fronts.select("cid", "n", "label", "own", F.posexplode("front").alias("i", "one"))
    return cut(places.select("cid", "n", "label", F.col("one.element").alias("element"), (F.col("own") + F.col("i")).alias("at")))


def _left_for(n: str, i: str, m: str):
    """Whether a set of ``n`` elements has enough from place ``i`` on to link with one of ``m``."""
    top, bottom = LINK
    return (F.col(n) - F.col(i)) * (top + bottom) >= (F.col(n) + F.col(m)) * top


def _may_link(n: str, i: str, m: str, j: str):
    """Whether sets of ``n`` and ``m`` elements can link if an element at places ``i`` and ``j`` is the first that they share.

    What is before it is not common; so a linking pair passes at its first common element, if nowhere else.
    """
    top, bottom = LINK
    lengths = F.least(n, m) * bottom >= F.greatest(n, m) * top
    return lengths & _left_for(n, i, m) & _left_for(m, j, n)


def similar_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``text_hash``, ``n_shingles``, ``class_id``, ``first_doc`` of every row.

    ``class_id`` is shared by documents of equal sets. ``first_doc`` (id, text hash) is the first
    document that links reach, by id, then hash.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    corpus = _Corpus(rows)
    labels = corpus.labels()
    named = corpus.classes.select("cid", "doc").join(labels.withColumnRenamed("node", "cid"), "cid", "left").select(
        "cid", "doc", F.coalesce("label", "cid").alias("label")
    )
    firsts = named.groupBy("label").agg(F.min("doc").alias("first_doc"))
    found = cut(named.join(firsts, "label").select("cid", "first_doc"))
    own = F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")
    return corpus.profiles.join(found, "cid", "left").select(
        "id", "text_hash", F.col("n").cast("long").alias("n_shingles"), F.col("cid").alias("class_id"), F.coalesce("first_doc", own).alias("first_doc")
    )


def component_ids(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    found = similar_documents(docs, key, text)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("first_doc.id").alias("component_id"))


def first_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group: the first document, once if several rows are equal in id and text."""
    found = similar_documents(docs, key, text)
    later = ~F.col("first_doc.id").eqNullSafe(F.col("id")) | (F.col("first_doc.text_hash") != F.col("text_hash"))
    counted = found.where("n_shingles > 0").groupBy("id", "text_hash", later.alias("later")).agg(F.count("*").alias("n"))
    judged = cut(counted.where("later OR n > 1").select("id", "text_hash", "later"))
    n_judged, n_repeated = judged.agg(F.count("*"), F.count(F.when(~F.col("later"), 1))).first()
    rows = docs.select(F.struct("*").alias("row"), F.col(key).cast("long").alias("key"), F.xxhash64(text).alias("hash"))
    same = F.col("r.key").eqNullSafe(F.col("g.id")) & (F.col("r.hash") == F.col("g.text_hash"))
    hinted = small(judged, n_judged * 64).alias("g")
    left = rows.alias("r").join(hinted, same, "left_anti").select("row")
    if n_repeated:
        firsts = rows.alias("r").join(hinted, same).where("NOT g.later").select("r.row", "r.key", "r.hash")
        copies = numbered(firsts, "row")
        left = left.unionAll(copies.join(first_copies(copies, ["key", "hash"]), ["_look", "_number"], "left_semi").select("row"))
    return left.select("row.*")
