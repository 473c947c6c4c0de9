"""Pairs of whole rows of a token-tag dataset, and pairs of pairs.

All pairs of n rows are n * (n - 1) / 2 results, which no cluster can write for a large table. With
``partners`` = k the row at position i of the key order meets the rows at i + 1, ..., i + k, as far
as there are any: every row takes part, the output grows with the rows, and k = n - 1 is the whole.

Without ``partners`` the operators take a page of all pairs in the order (0,1), (0,2), ..., (1,2),
...: ``first`` pair number and ``count``. Pages are exact and disjoint, together they are the whole,
and the work of a page follows its own size: pair numbers are turned into positions in closed form,
with no cross join.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import OUTSIDE, entity_ids, entity_sentences, label_names, same_tag_at_same_position
from ..functions.tokens import sentence
from .disjoint_draws import disjoint_draws
from .entity_pairs import NOT_SIMILAR, SIMILAR, similar_entity_pairs
from .gather import USES_PER_SLOT, gather_pairs, row_bytes
from .lineage import cut_lineage
from .positions import shuffle_tasks, with_position, with_position_of_key


def _anchor(q: int, n: int) -> tuple[int, int]:
    """First row of pair number ``q`` among ``n`` rows, and the number of its first pair."""

    def start(i: int) -> int:
        return i * (2 * n - i - 1) // 2

    i = max(0, (2 * n - 1 - math.isqrt((2 * n - 1) ** 2 - 8 * q)) // 2 - 1)
    while start(i + 1) <= q:
        i += 1
    return i, start(i)


def pair_page(
    df: DataFrame,
    order_by: str | Sequence[str],
    first: int,
    count: int,
    payload: dict[str, Column],
) -> DataFrame:
    """Pairs ``first <= number < first + count`` as ``i, j, a, b`` with a struct per row."""
    if first < 0 or count < 0:
        raise ValueError("first and count must not be negative")
    spark = df.sparkSession
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    measured = tuple(df.agg(F.count("*"), row_bytes(df, keys)).first())
    n = measured[0]
    stop = min(first + count, n * (n - 1) // 2)
    if first >= stop:
        anchors, offset, i0 = spark.range(0), 0, 0
        count = 0
    else:
        i0, start = _anchor(first, n)
        i1, _ = _anchor(stop - 1, n)
        offset, count = first - start, stop - first
        anchors = spark.range(i1 - i0 + 1)
    # Numbers below are relative to the first pair of row i0, so they stay within a page.
    d = F.col("id")
    begin = d * (n - 1 - i0) - F.expr("id * (id - 1) div 2")
    pairs = (
        anchors.select(
            (d + i0).alias("i"),
            F.expr(f"id div {USES_PER_SLOT}").alias("block"),
            F.greatest(F.lit(0), offset - begin).alias("lo"),
            F.least(n - 1 - i0 - d, offset + count - begin).alias("hi"),
        )
        .where("lo < hi")
        .withColumn("slot", F.expr(f"explode(sequence(lo div {USES_PER_SLOT}, (hi - 1) div {USES_PER_SLOT}))"))
        .repartition(shuffle_tasks(df), "i", "slot")
        .withColumn(
            "j",
            F.explode(
                F.sequence(
                    F.col("i") + 1 + F.greatest(F.col("lo"), F.col("slot") * USES_PER_SLOT),
                    F.col("i") + F.least(F.col("hi"), (F.col("slot") + 1) * USES_PER_SLOT),
                )
            ),
        )
    )
    placed = pairs.select(
        "i",
        "j",
        F.col("i").alias("a_idx"),
        F.col("slot").alias("a_slot"),
        F.col("j").alias("b_idx"),
        F.col("block").alias("b_slot"),
    )
    met = gather_pairs(df, placed, count, order_by, payload, ["a", "b"], (), measured[1])
    return met.select("i", "j", "a", "b")


def next_pairs(
    df: DataFrame,
    order_by: str | Sequence[str],
    partners: int,
    payload: dict[str, Column],
) -> DataFrame:
    """Every row with its next ``partners`` rows, as ``i, j, a, b`` with a struct per row."""
    if partners < 1:
        raise ValueError("partners must be positive")
    spark = df.sparkSession
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    total, key_bytes = df.agg(F.count("*"), row_bytes(df, keys)).first()
    reach = F.least(F.lit(partners).cast("long"), total - 1 - F.col("i"))
    pairs = (
        spark.range(max(0, total - 1))
        .withColumnRenamed("id", "i")
        .withColumn("step", F.explode(F.sequence(F.lit(1).cast("long"), reach)))
    )
    slot = F.expr(f"(step - 1) div {USES_PER_SLOT}")
    placed = pairs.select(
        "i",
        (F.col("i") + F.col("step")).alias("j"),
        F.col("i").alias("a_idx"),
        slot.alias("a_slot"),
        (F.col("i") + F.col("step")).alias("b_idx"),
        slot.alias("b_slot"),
    )
    met = gather_pairs(
        df, placed, total * min(partners, total), order_by, payload, ["a", "b"], (), key_bytes
    )
    return met.select("i", "j", "a", "b")


def _met(df, order_by, first, count, partners, payload) -> DataFrame:
    if partners is not None:
        if first is not None or count is not None:
            raise ValueError("give either partners or first and count")
        return next_pairs(df, order_by, partners, payload)
    if first is None or count is None:
        raise ValueError("give either partners or first and count")
    return pair_page(df, order_by, first, count, payload)


def _tagged_rows(df, order_by, first, count, partners, names, tokens, tags) -> DataFrame:
    payload = {
        "tags": F.col(tags),
        "sentence": sentence(F.col(tokens)),
        "entities": entity_sentences(F.col(tags), names),
    }
    return _met(df, order_by, first, count, partners, payload)


def _positional_label(names: Sequence[str]) -> Column:
    outside = names.index(OUTSIDE) if OUTSIDE in names else -1
    hit = same_tag_at_same_position(F.col("a.tags"), F.col("b.tags"), outside)
    return F.when(hit, SIMILAR).otherwise(NOT_SIMILAR)


def row_pairs(
    df: DataFrame,
    order_by: str,
    first: int | None = None,
    count: int | None = None,
    names: Sequence[str] | None = None,
    tokens: str = "tokens",
    tags: str = "ner_tags",
    partners: int | None = None,
) -> DataFrame:
    """Row pairs, similar if some position holds the same tag other than ``O``."""
    names = list(names) if names is not None else label_names(df, tags)
    met = _tagged_rows(df, order_by, first, count, partners, names, tokens, tags)
    return met.select(
        F.col("a.sentence").alias("sentence1"),
        F.col("b.sentence").alias("sentence2"),
        _positional_label(names).alias("label"),
    )


def row_pairs_with_entities(
    df: DataFrame,
    order_by: str,
    first: int | None = None,
    count: int | None = None,
    names: Sequence[str] | None = None,
    tokens: str = "tokens",
    tags: str = "ner_tags",
    partners: int | None = None,
) -> DataFrame:
    """Row pairs, each followed by the entity pairs of both rows.

    ``i, j, block, nth`` give the sequence: block 0 is the row pair, 1 and 2 the entities of the
    first and second row in name order.
    """
    names = list(names) if names is not None else label_names(df, tags)
    met = _tagged_rows(df, order_by, first, count, partners, names, tokens, tags)

    def entities(side: str, block: int) -> Column:
        return F.transform(
            F.array_sort(F.col(f"{side}.entities")),
            lambda e, k: F.struct(
                F.lit(block).alias("block"),
                k.alias("nth"),
                F.col(f"{side}.sentence").alias("sentence1"),
                e.alias("sentence2"),
                F.lit(SIMILAR).alias("label"),
            ),
        )

    own = F.array(
        F.struct(
            F.lit(0).alias("block"),
            F.lit(0).alias("nth"),
            F.col("a.sentence").alias("sentence1"),
            F.col("b.sentence").alias("sentence2"),
            _positional_label(names).alias("label"),
        )
    )
    return met.select(
        "i", "j", F.explode(F.concat(own, entities("a", 1), entities("b", 2))).alias("_pair")
    ).select("i", "j", "_pair.*")


def entity_pair_copies(
    df: DataFrame,
    order_by: str,
    names: Sequence[str] | None = None,
    tokens: str = "tokens",
    tags: str = "ner_tags",
) -> DataFrame:
    """The entity pairs of both rows of *every* row pair, as distinct pairs with a count.

    Each row takes part in n - 1 row pairs, so each of its entity pairs occurs n - 1 times: the
    whole result in linear space.
    """
    names = list(names) if names is not None else label_names(df, tags)
    copies = df.count() - 1
    if copies < 1:
        df = df.limit(0)
    pairs = similar_entity_pairs(df, names, tokens, tags, [order_by])
    return pairs.withColumn("n_copies", F.lit(copies).cast("long"))


def dissimilar_from_pairs(
    pairs: DataFrame,
    order_by: str | Sequence[str],
    first: int | None = None,
    count: int | None = None,
    partners: int | None = None,
) -> DataFrame:
    """Pairs of pairs p, q (p before q): first sentence of p, second sentence of q.

    Partners and pair numbers count all (p, q); those whose two pairs are both similar give nothing.
    """
    payload = {c: F.col(c) for c in ("sentence1", "sentence2", "label")}
    met = _met(pairs, order_by, first, count, partners, payload)
    both_similar = F.coalesce((F.col("a.label") == SIMILAR) & (F.col("b.label") == SIMILAR), F.lit(False))
    return met.where(~both_similar).select(
        F.col("a.sentence1").alias("sentence1"),
        F.col("b.sentence2").alias("sentence2"),
        F.lit(NOT_SIMILAR).alias("label"),
    )


def all_row_pairs(
    df: DataFrame,
    order_by: str,
    row_page: tuple[int | None, int | None] = (None, None),
    pair_page: tuple[int | None, int | None] = (None, None),
    names: Sequence[str] | None = None,
    tokens: str = "tokens",
    tags: str = "ner_tags",
    partners: int | None = None,
) -> DataFrame:
    """Row pairs, their entity pairs, and the dissimilar pairs made from that sequence.

    ``partners`` holds for both levels; else ``row_page`` and ``pair_page`` are ``(first, count)`` of
    the two. The sequence is written once: it is counted, ordered and read twice.
    """
    made = cut_lineage(
        row_pairs_with_entities(df, order_by, *row_page, names, tokens, tags, partners)
    )
    columns = ["sentence1", "sentence2", "label"]
    more = dissimilar_from_pairs(made, ["i", "j", "block", "nth"], *pair_page, partners)
    return made.select(*columns).unionByName(more)


def dissimilar_pair_counts(pairs: DataFrame, order_by: str | Sequence[str], tasks: int | None = None) -> DataFrame:
    """What :func:`dissimilar_from_pairs` makes of *all* pairs of pairs, as ``side, sentence, n_pairs``.

    How often a sentence stands first (or second) among the pairs made: for each pair the later (or
    earlier) ones that it meets are counted by prefix sums, so the whole result takes space in proportion to the
    pairs. Each side sums up to C(P, 2) - C(S, 2) for P pairs of which S are similar.
    """
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    similar = F.coalesce((F.col("label") == SIMILAR).cast("long"), F.lit(0)).alias("_similar")
    ranked = with_position(pairs.select(*keys, similar), keys, name="_at", unique=True, tasks=tasks)
    placed = cut_lineage(with_position(ranked, keys, name="_before", weight="_similar", tasks=tasks))
    n, n_similar, key_bytes = placed.agg(F.count("*"), F.coalesce(F.sum("_similar"), F.lit(0)), row_bytes(placed, keys)).first()
    alike = F.col("_similar") == 1
    earlier, later = F.col("_at"), n - 1 - F.col("_at")
    first = later - F.when(alike, n_similar - F.col("_before") - 1).otherwise(0)
    second = earlier - F.when(alike, F.col("_before")).otherwise(0)
    counted = placed.select(*keys, first.alias("_first"), second.alias("_second"))
    met = with_position_of_key(pairs.select(*keys, "sentence1", "sentence2"), counted, keys, key_bytes + 16, n)
    sides = F.array(
        F.struct(F.lit("first").alias("side"), F.col("sentence1").alias("sentence"), F.col("_first").alias("n")),
        F.struct(F.lit("second").alias("side"), F.col("sentence2").alias("sentence"), F.col("_second").alias("n")),
    )
    told = met.select(F.explode(sides).alias("s")).select("s.*").where("n > 0")
    return told.groupBy("side", "sentence").agg(F.sum("n").alias("n_pairs"))


def random_dissimilar_pairs(
    df: DataFrame,
    num_pairs: int,
    order_by: str,
    names: Sequence[str] | None = None,
    tokens: str = "tokens",
    tags: str = "ner_tags",
    seed: int = 42,
    tasks: int | None = None,
) -> DataFrame:
    """``num_pairs`` random pairs of rows that share no tag other than ``O``.

    Independent draws from all such ordered pairs, each as likely as any other. That there is none is an
    error; see :mod:`disjoint_draws`. Rows without tags, and null tags, share nothing with any row.
    """
    names = list(names) if names is not None else label_names(df, tags)
    ids = F.array_sort(F.array_compact(entity_ids(F.col(tags), names)))
    rows = df.withColumn("set", F.coalesce(F.array_join(ids.cast("array<string>"), ","), F.lit("")))
    positions = with_position(rows.select("set", order_by), order_by, ["set"], unique=True, tasks=tasks)
    drawn = disjoint_draws(positions, num_pairs, seed, tasks)
    # A row that is drawn very often is split over slots of draws.
    slot = F.expr(f"c div {USES_PER_SLOT}")
    placed = cut_lineage(drawn.select("c", "a_set", "a_idx", slot.alias("a_slot"), "b_set", "b_idx", slot.alias("b_slot")))
    payload = {"sentence": sentence(F.col(tokens))}
    out = gather_pairs(rows, placed, num_pairs, order_by, payload, ["a", "b"], ["set"], positions=positions)
    return out.select(
        F.col("a.sentence").alias("sentence1"),
        F.col("b.sentence").alias("sentence2"),
        F.lit(NOT_SIMILAR).alias("label"),
    )
