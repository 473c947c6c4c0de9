"""Mixing sources to token targets by entropy balancing.

Every document gets a rate, the copies expected of it. Among all rates that give each source its
target of words and stay within ``[0, cap]``, entropy balancing takes those closest (in relative
entropy) to one copy each. They have the form ``min(cap, exp(lambda * size / mean size))`` with one
multiplier for each source: the solution of the convex dual. Newton's method finds the multipliers,
guarded by a bracket. Each step is one aggregation of a table that counts documents by (source,
size), so a source with a third of all rows is as short as any other.

Rates become copies by systematic rounding: along the sizes of a source the running sum of the
rates is rounded, so what a source takes differs from its target by at most about its longest
document. Which documents of equal source and size get the further copy is decided by a hash: the
threshold of each (source, size) is its n-th smallest hash, found through counts of hash ranges.
Rows that tie at the threshold are numbered, and as many of them get a copy as are left to give.

Defined cases: null text: size 0; null source: a source of its own, the last in order; documents
without words keep one copy; rows equal in key and text are told apart by their other columns, and
rows equal in all columns are interchangeable; an empty table gives no rows; input columns named like a result column give way to it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sharding import prefix_sums
from .shared import bytes_of, cut, numbered, small, words

#: Weights of the sources by their order, again and again.
WEIGHTS = (5, 2, 1)
#: Words of the mix, as a share of all words.
SHARE = 1.5
#: Most copies of a document, and most words of a source, in its sizes.
CAP = 2.0
#: Newton steps end when every source is this close to its target (relative).
TOLERANCE = 1e-9
STEPS_PER_JOB = 4
MAX_JOBS = 30
#: Rounds of moving a single copy of each source towards its target.
SETTLING = 2
#: Documents of one (source, size) that are ranked together.
RANKED = 4096


def _size(text: str) -> Column:
    return F.size(words(F.col(text))).cast("long")


def _hash(key: str, text: str) -> Column:
    return F.xxhash64(key, text)


def source_targets(counts: DataFrame) -> DataFrame:
    """``source``, ``source_size``, ``target`` of a table with ``source``, ``size`` and ``n``.

    Sources share ``SHARE`` of all words by weight; a target stops at ``CAP`` times its source's
    size and the others share the excess, until none is above.
    """
    sizes = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    ranked = prefix_sums(sizes, [F.col("source")], F.lit(1))
    weight = F.get(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.col("_rows_before") % len(WEIGHTS)).cast("int"))
    weighed = cut(ranked.select("source", "source_size", weight.alias("w")))
    most = F.col("source_size") * CAP
    total = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] * SHARE
    # The level, words for a unit of weight, only rises; each round caps further sources or ends.
    level, capped = 0.0, -1
    while True:
        above = most <= level * F.col("w")
        row = weighed.agg(
            F.coalesce(F.sum(F.when(above, most)), F.lit(0.0)).alias("full"),
            F.coalesce(F.sum(F.when(~above, F.col("w"))), F.lit(0.0)).alias("open"),
            F.count(F.when(above, 1)).alias("n"),
        ).first()
        if row["n"] == capped or not row["open"]:
            break
        capped, level = row["n"], (total - row["full"]) / row["open"]
    return weighed.select("source", "source_size", F.least(most, F.col("w") * level).cast("double").alias("target"))


def _rate(size: Column) -> Column:
    """Copies expected of a document, given its source's state."""
    tilted = F.least(F.lit(CAP), F.exp(F.least(F.col("tilt") * size / F.col("mean"), F.lit(math.log(CAP) + 1))))
    return F.when(F.col("full"), F.lit(CAP)).otherwise(tilted)


def _same_source(a: str, b: str) -> Column:
    return F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))


def _newton_step(counts: DataFrame, state: DataFrame) -> DataFrame:
    columns = [F.col(f"s.{c}") for c in state.columns]
    met = counts.alias("c").join(state.alias("s"), _same_source("c", "s")).select(*columns, "c.size", "c.n")
    words_of = F.col("n") * F.col("size")
    rate = _rate(F.col("size"))
    slope = F.when(rate < CAP, words_of * F.col("size") / F.col("mean") * rate).otherwise(0.0)
    sums = met.groupBy(*state.columns).agg(F.sum(words_of * rate).alias("taken"), F.sum(slope).alias("slope"))
    gap = F.col("taken") - F.col("target")
    low = F.when(gap < 0, F.col("tilt")).otherwise(F.col("low"))
    high = F.when(gap >= 0, F.col("tilt")).otherwise(F.col("high"))
    step = F.col("tilt") - F.try_divide(gap, F.col("slope"))
    inside = F.coalesce((step > low) & (step < high), F.lit(False))
    ends = F.col("full") | (F.abs(gap) <= TOLERANCE * F.col("target"))
    tilt = F.when(ends, F.col("tilt")).when(inside, step).otherwise((low + high) / 2)
    fixed = [c for c in state.columns if c not in ("tilt", "low", "high", "ends")]
    return sums.select(*fixed, tilt.alias("tilt"), low.alias("low"), high.alias("high"), ends.alias("ends"))


def balance(counts: DataFrame, targets: DataFrame) -> DataFrame:
    """The state of each source: its target and its multiplier ``tilt``."""
    counted = counts.where("size > 0")
    stats = counted.groupBy("source").agg(
        (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"), F.min("size").alias("least")
    )
    met = targets.alias("t").join(stats.alias("c"), _same_source("t", "c"), "left")
    share = F.col("t.target") / F.col("t.source_size")
    reach = F.col("c.mean") / F.col("c.least")
    # With every rate above or below its share, the target lies between these multipliers.
    low = F.when(share < 1, reach * F.log(share)).otherwise(0.0)
    high = F.when(share < 1, 0.0).otherwise(reach * math.log(CAP))
    start = met.select(
        "t.source",
        "t.source_size",
        "t.target",
        F.coalesce("c.mean", F.lit(1.0)).alias("mean"),
        (F.col("t.target") >= F.col("t.source_size") * CAP).alias("full"),
        F.lit(0.0).alias("tilt"),
        F.coalesce(low, F.lit(0.0)).alias("low"),
        F.coalesce(high, F.lit(0.0)).alias("high"),
        F.lit(False).alias("ends"),
    )
    # A source without words has nothing to balance.
    empty = cut(start.where("source_size = 0"))
    state = cut(start.where("source_size > 0"))
    for _ in range(MAX_JOBS):
        stepped = state
        for _ in range(STEPS_PER_JOB):
            stepped = _newton_step(counted, stepped)
        state = cut(stepped)
        if not state.where("NOT ends").take(1):
            break
    return state.unionByName(empty)


def _settled(bins: DataFrame) -> DataFrame:
    """Move single copies where that brings a source's words nearer to its target.

    What rounding leaves is about a document long; one copy more or less of a document of about that
    size takes most of it away.
    """
    source = Window.partitionBy("source")
    for _ in range(SETTLING):
        held = F.col("whole") * F.col("n") + F.col("extra")
        gap = F.col("target") - F.sum(held * F.col("size")).over(source)
        measured = bins.withColumn("held", held).withColumn("gap", gap)
        room = F.when(F.col("gap") > 0, F.col("held") < CAP * F.col("n")).otherwise(F.col("held") > 0)
        miss = F.abs(F.col("size") - F.abs("gap"))
        helps = room & (F.col("size") > 0) & (miss < F.abs("gap"))
        judged = measured.withColumn("choice", F.when(helps, F.struct(miss.alias("miss"), "size")))
        chosen = F.coalesce(F.col("choice") == F.min("choice").over(source), F.lit(False))
        moved = F.col("held") + F.when(chosen, F.signum("gap")).otherwise(0).cast("long")
        # All of a bin at two copies is two whole ones and none further.
        whole = F.floor(moved / F.col("n"))
        bins = judged.select(*bins.columns, moved.alias("held"), whole.alias("_whole")).select(
            *[c for c in bins.columns if c not in ("whole", "extra")],
            F.col("_whole").alias("whole"),
            (F.col("held") - F.col("_whole") * F.col("n")).alias("extra"),
        )
    return bins


def _thresholds(narrow: DataFrame, bins: DataFrame, bins_bytes: int) -> DataFrame:
    """``last_hash`` of each (source, size) of which some documents, not all, get a copy more: its ``extra``-th smallest.

    ``tied`` rows have that hash, and ``share`` of them get the copy.
    """
    wanted = bins.where("extra > 0 AND extra < n").select("source", "size", "n", "extra")
    same = _same_source("d", "b") & (F.col("d.size") == F.col("b.size"))
    rows = narrow.alias("d").join(small(wanted, bins_bytes).alias("b"), same)
    # Ranges of the hash, in its order, of about RANKED documents each.
    ranges = F.ceil(F.col("b.n") / RANKED)
    spread = F.shiftright((F.shiftright("d.hash", 32) + F.lit(1 << 31)) * ranges, 32)
    rows = rows.select("d.source", "d.size", "d.hash", "b.extra", spread.alias("range"))
    here = ["source", "size", "range"]
    counts = rows.groupBy(*here, "extra").agg(F.count("*").alias("m"))
    earlier = Window.partitionBy("source", "size").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("m").over(earlier), F.lit(0))
    holding = counts.withColumn("before", before).where("before < extra AND before + m >= extra")
    match = _same_source("r", "h") & (F.col("r.size") == F.col("h.size")) & (F.col("r.range") == F.col("h.range"))
    last = rows.alias("r").join(holding.alias("h"), match).select("r.*", "h.before")
    # Rows of one hash are counted, however many they are.
    hashes = last.groupBy(*here, "hash", "extra", "before").agg(F.count("*").alias("tied"))
    upto = F.col("before") + F.sum("tied").over(Window.partitionBy(*here).orderBy("hash"))
    found = hashes.withColumn("upto", upto).where("upto >= extra AND upto - tied < extra")
    return found.select("source", "size", F.col("hash").alias("last_hash"), (F.expr("extra - (upto - tied)")).alias("share"), "tied")


def _shared_out(ties: DataFrame, bins_bytes: int) -> DataFrame:
    """Rows of tied hashes with ``more``: 1 for the first ``share`` of each (source, size), in a range partitioned order."""
    rows = numbered(ties, "_row")
    order = ["source", "size", "_look", "_number"]
    placed = prefix_sums(rows.select(*order), [F.col(c) for c in order], F.lit(1))
    starts = placed.groupBy("source", "size").agg(F.min("_rows_before").alias("start"))
    same = _same_source("r", "s") & (F.col("r.size") == F.col("s.size"))
    met = placed.alias("r").join(small(starts, bins_bytes).alias("s"), same)
    places = met.select("r._number", (F.col("r._rows_before") - F.col("s.start")).alias("_place"))
    more = F.when(F.col("_place") < F.col("share"), 1).otherwise(0)
    return rows.join(places, "_number").select(*ties.columns, more.alias("more"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Every row with ``size``, ``source_size``, ``target``, ``rate``, ``copies`` and ``taken``."""
    narrow = cut(docs.select(F.col(source).alias("source"), _size(text).alias("size"), _hash(key, text).alias("hash")))
    counts = cut(narrow.groupBy("source", "size").agg(F.count("*").alias("n")))
    state = cut(balance(counts, source_targets(counts)))
    met = counts.alias("c").join(state.alias("s"), _same_source("c", "s"))
    rated = met.select("s.*", "c.size", "c.n").withColumn("rate", _rate(F.col("size")))
    whole = F.floor("rate")
    part = F.col("n") * (F.col("rate") - whole)
    # A source has as many rows here as it has sizes.
    upto = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    running = rated.withColumn("upto", F.sum(part).over(upto))
    extra = F.floor(F.col("upto") + 0.5) - F.floor(F.col("upto") - part + 0.5)
    kept = ["source", "source_size", "target", "size", "n", "rate"]
    bins = cut(_settled(running.select(*kept, whole.alias("whole"), F.least(extra, F.col("n")).alias("extra"))))
    bins_bytes = bytes_of(bins, ["source"], 160)
    last = _thresholds(narrow, bins, bins_bytes)
    same = _same_source("b", "l") & (F.col("b.size") == F.col("l.size"))
    plan = cut(bins.alias("b").join(last.alias("l"), same, "left").select("b.*", "l.last_hash", "l.share", "l.tied"))
    rows = docs.select(
        F.struct("*").alias("_row"), F.col(source).alias("source"), _size(text).alias("size"), _hash(key, text).alias("hash")
    )
    same = _same_source("d", "p") & (F.col("d.size") == F.col("p.size"))
    met = rows.alias("d").join(small(plan, bins_bytes).alias("p"), same).select("d._row", "d.hash", "p.*")
    more = F.when(F.col("extra") >= F.col("n"), 1).when(F.col("hash") <= F.col("last_hash"), 1).otherwise(0)
    torn = F.expr("coalesce(share < tied AND hash = last_hash, false)")
    if plan.where("share < tied").take(1):
        met = met.where(~torn).withColumn("more", more).unionAll(_shared_out(met.where(torn), bins_bytes))
    else:
        met = met.withColumn("more", more)
    copies = (F.col("whole") + F.col("more")).cast("long")
    new = {
        "size": F.col("size"),
        "source_size": F.col("source_size"),
        "target": F.col("target"),
        "rate": F.col("rate"),
        "copies": copies,
        "taken": copies * F.col("size"),
    }
    columns = [F.col("_row")[c].alias(c) for c in docs.columns if c.lower() not in new]
    return met.select(*columns, *[c.alias(n) for n, c in new.items()])


def mixed_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: each row as often as it is taken, with the columns of ``docs``."""
    wrapped = docs.select(F.struct("*").alias("row"), *[F.col(c).alias(n) for c, n in ((key, "k"), (text, "t"), (source, "s"))])
    mixed = mix(wrapped, "k", "t", "s").where("copies > 0")
    return mixed.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
