"""Random pairs of rows that share no tag, drawn exactly from counted tag sets.

Rows with the same set of tags are alike here, so the pairs to draw from are counted on distinct sets:
two sets without a common tag give as many ordered row pairs as the product of their rows. Sets lie
in blocks of bounded size, and two blocks make a cell. The total of every cell is worked out first. A
draw is a number below the sum of all totals: it names a cell, in the cell a pair of sets, and
of these two a row each. No draw is rejected, however few pairs there are.

The work follows the square of the number of distinct tag sets, which the vocabulary bounds, not that of the rows.
"""

from __future__ import annotations

import sys
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.draw import draw
from .lineage import cut_lineage
from .positions import with_position

# What runs in tasks travels whole, so that workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Sets of a block, and draws that one group serves.
SETS_PER_BLOCK = 2048
DRAWS_PER_GROUP = 1 << 17
DRAW_BITS = 60


class Cell:
    """The pairs of sets of two blocks that share no tag; sets are given as ids joined by commas."""

    def __init__(self, left: list[tuple[str, int]], right: list[tuple[str, int]]):
        self.left, self.right = left, right
        ids = {t: i for i, t in enumerate(sorted({t for s, _ in (*left, *right) for t in s.split(",") if t}))}

        def hot(sets: list[tuple[str, int]]) -> np.ndarray:
            found = np.zeros((len(sets), max(1, len(ids))), dtype=np.float32)
            for row, (s, _) in enumerate(sets):
                found[row, [ids[t] for t in s.split(",") if t]] = 1
            return found

        sizes = np.array([n for _, n in right], dtype=np.int64)
        apart = hot(left) @ hot(right).T == 0
        # A row is no partner of itself: a set without tags is apart from itself, too.
        own = {s: i for i, (s, _) in enumerate(right)}
        self.same = np.array([own[s] if s == "" and s in own else -1 for s, _ in left])
        self.partners = np.where(apart, sizes[None], 0)
        rows = np.flatnonzero(self.same >= 0)
        self.partners[rows, self.same[rows]] -= 1
        self.weights = [n * int(p) for (_, n), p in zip(left, self.partners.sum(1))]
        self.starts = list(accumulate(self.weights, initial=0))

    @property
    def total(self) -> int:
        return self.starts[-1]

    def pair(self, number: int) -> tuple[str, int, str, int]:
        """Set and row of either side of a numbered pair."""
        at = bisect_right(self.starts, number) - 1
        name, n = self.left[at]
        partner, i = divmod(number - self.starts[at], n)
        before = np.cumsum(self.partners[at])
        other = int(np.searchsorted(before, partner, side="right"))
        j = partner - int(before[other] - self.partners[at, other])
        if other == self.same[at] and j >= i:
            j += 1
        return name, i, self.right[other][0], j


def _sides(table: pa.Table) -> tuple[list, list]:
    sides: tuple[list, list] = ([], [])
    order = np.argsort(table["rank"].to_numpy(), kind="stable")
    sets, sizes, right = (table[c].to_pylist() for c in ("set", "n", "right"))
    for i in order.tolist():
        sides[right[i]].append((sets[i], sizes[i]))
    return sides


def _total(table: pa.Table) -> pa.Table:
    return pa.table({"a": table["a"][:1], "b": table["b"][:1], "total": pa.array([str(Cell(*_sides(table)).total)])})


def _drawn(draws: pa.Table, sets: pa.Table) -> pa.Table:
    cell = Cell(*_sides(sets)) if len(draws) else None
    found = [(c, *cell.pair(int(x))) for c, x in zip(draws["c"].to_pylist(), draws["number"].to_pylist())]
    columns = list(zip(*found)) or [[]] * 5
    kinds = {"c": pa.int64(), "a_set": pa.string(), "a_idx": pa.int64(), "b_set": pa.string(), "b_idx": pa.int64()}
    return pa.table([pa.array(v, t) for v, t in zip(columns, kinds.values())], names=list(kinds))


def _numbers(cells: list[tuple[int, int, int]]):
    """60-bit draws -> the cell that each falls in, and the number of the pair in it."""
    schema = pa.schema([("c", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("number", pa.string())])
    starts = list(accumulate((t for _, _, t in cells), initial=0))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for c, x in zip(batch["c"].to_pylist(), batch["x"].to_pylist()):
                number = x * starts[-1] >> DRAW_BITS
                at = bisect_right(starts, number) - 1
                rows.append((c, cells[at][0], cells[at][1], str(number - starts[at])))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), schema)], schema=schema)

    return read


def disjoint_draws(positions: DataFrame, num_pairs: int, seed: int, tasks: int | None = None) -> DataFrame:
    """``c, a_set, a_idx, b_set, b_idx``: ``num_pairs`` random ordered pairs of rows whose sets share nothing.

    ``positions`` has a row for each row of the table: its ``set`` (sorted tag ids joined by commas), and
    ``idx`` in it. Draws are independent, so a pair may come more than once. An error if there is no such pair.
    """
    spark = positions.sparkSession
    counted = cut_lineage(positions.groupBy("set").agg(F.count("*").alias("n")))
    ranked = with_position(counted, "set", name="rank", tasks=tasks)
    sets = cut_lineage(ranked.withColumn("block", F.expr(f"rank div {SETS_PER_BLOCK}")))
    blocks = -(-sets.count() // SETS_PER_BLOCK)
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))) if blocks else F.explode(F.array().cast("array<long>"))
    left = sets.select("set", "n", "rank", F.col("block").alias("a"), every.alias("b"), F.lit(0).alias("right"))
    right = sets.select("set", "n", "rank", every.alias("a"), F.col("block").alias("b"), F.lit(1).alias("right"))
    sided = left.unionByName(right)
    totals = sided.groupBy("a", "b").applyInArrow(_total, "a long, b long, total string").collect()
    # One row for each cell: blocks squared.
    cells = sorted((r["a"], r["b"], int(r["total"])) for r in totals if r["total"] != "0")
    if num_pairs > 0 and not cells:
        raise ValueError("no two rows are without a common tag")
    numbered = spark.range(num_pairs).select(F.col("id").alias("c"), draw(seed, "p", F.col("id")).alias("x"))
    placed = cut_lineage(numbered.mapInArrow(_numbers(cells), "c long, a long, b long, number string"))
    turn = F.expr(f"c div {DRAWS_PER_GROUP}").alias("turn")
    grouped = placed.select("*", turn)
    wanted = sided.join(placed.select("a", "b", turn).distinct(), ["a", "b"])
    met = grouped.groupBy("a", "b", "turn").cogroup(wanted.groupBy("a", "b", "turn"))
    return met.applyInArrow(_drawn, "c long, a_set string, a_idx long, b_set string, b_idx long")
