"""Similar and dissimilar sentence pairs from text-class rows.

In the order of the key, the row at position i of a label with n rows meets the rows at positions
i + 1, ..., i + k (mod n), where k is ``partners`` or n - 1 if that is less. So every row of a label
with two rows or more is the first sentence of a pair, the output grows with the rows, and no row is
in more than 2 k similar pairs. Each similar pair brings one dissimilar pair: its first sentence with
a random row of a random other label.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.draw import draw
from .gather import USES_PER_SLOT, gather_branches, row_bytes
from .lineage import cut_lineage
from .positions import small, with_position

SIMILAR = "similar"
DISSIMILAR = "dissimilar"
PARTNERS = 1


def label_counts(df: DataFrame, label: str = "label", by: Sequence[str] = (), *more: Column) -> DataFrame:
    """Rows per label (and ``more`` aggregates): one map-side combined pass, not a scan per label."""
    return df.where(F.col(label).isNotNull()).groupBy(*by, label).agg(F.count("*").alias("n_examples"), *more)


def pair_plan(
    df: DataFrame, partners: int = PARTNERS, label: str = "label", by: Sequence[str] = (), *more: Column
) -> DataFrame:
    """Per label: rows, number of labels, and similar pairs (as many dissimilar ones follow)."""
    counts = label_counts(df, label, by, *more)
    labels = counts.groupBy(*by).agg(F.count("*").alias("n_labels"))
    planned = counts.join(labels, list(by)) if by else counts.withColumn("n_labels", labels.scalar())
    n = F.col("n_examples")
    return planned.withColumn("num_pairs", n * F.least(F.lit(partners).cast("long"), n - 1))


def text_pairs(
    df: DataFrame,
    order_by: str,
    text: str = "text",
    label: str = "label",
    split: str | None = None,
    partners: int = PARTNERS,
    seed: int = 42,
    kinds: Sequence[str] = (SIMILAR, DISSIMILAR),
    pair_key: str | None = None,
) -> DataFrame:
    """``(split,) sentence1, sentence2, label`` pairs, ``partners`` of each kind for a row.

    ``order_by`` is unique in a split and label and not null. ``pair_key`` names a further column,
    unique per pair of a split, for sampling the pairs and batching them. Rows without a label are
    left out. A label that needs dissimilar pairs but has no other label to draw from is an error.
    """
    if partners < 1:
        raise ValueError("partners must be positive")
    by = [split] if split else []
    rows = df.where(F.col(label).isNotNull())
    # A row for each label, read for the facts, the pairs and the draws.
    plan = cut_lineage(pair_plan(rows, partners, label, by, row_bytes(rows, [*by, label, order_by]).alias("bytes")))
    facts = plan.agg(
        F.count("*").alias("labels"),
        F.coalesce(F.sum("n_examples"), F.lit(0)).alias("rows"),
        F.count(F.when((F.col("n_labels") == 1) & (F.col("num_pairs") > 0), 1)).alias("alone"),
        F.coalesce(F.max("bytes"), F.lit(0)).alias("bytes"),
    ).first()
    if DISSIMILAR in kinds and facts["alone"]:
        raise ValueError("dissimilar pairs need at least two labels")
    # One row for each label of a split.
    plan = plan.drop("bytes").withColumn(
        "label_rank", (F.row_number().over(Window.partitionBy(*by).orderBy(label)) - 1).cast("long")
    )
    plan_bytes = facts["labels"] * (64 + facts["bytes"])
    # Found once, for the pairs and for the rows that they fetch.
    positions = with_position(rows.select(*by, label, order_by), order_by, [*by, label], unique=True)
    placed = positions.withColumnRenamed("idx", "i")
    reach = F.least(F.lit(partners).cast("long"), F.col("n_examples") - 1)
    pairs = (
        placed.drop(order_by)
        .join(small(plan, plan_bytes), [*by, label])
        .where("num_pairs > 0")
        .withColumn("step", F.explode(F.sequence(F.lit(1).cast("long"), reach)))
        .withColumn("q", F.col("i") * reach + F.col("step") - 1)
    )
    slot = F.expr(f"(step - 1) div {USES_PER_SLOT}")
    sides = ["a"]
    place = {"a": (F.col(label), F.col("i"), slot)}
    if SIMILAR in kinds:
        sides.append("b")
        place["b"] = (F.col(label), (F.col("i") + F.col("step")) % F.col("n_examples"), slot)
    if DISSIMILAR in kinds:
        sides.append("c")
        pairs = _draw_other_label(pairs, plan, plan_bytes, by, label, seed)
        pick = draw(seed, "r", F.col(label), F.col("q"))
        place["c"] = (F.col("other_label"), pick % F.col("other_n"), F.col("q") % F.col("other_slots"))
    wanted = pairs.select(
        *by,
        F.concat_ws("-", "label_rank", "q").alias("_number"),
        *[
            column.alias(f"{s}_{name}")
            for s in sides
            for name, column in [*[(c, F.col(c)) for c in by], *zip((label, "idx", "slot"), place[s])]
        ],
    )
    seconds = [(kind, s) for kind, s in ((SIMILAR, "b"), (DISSIMILAR, "c")) if s in sides]
    met = gather_branches(
        rows,
        wanted,
        facts["rows"] * partners,
        order_by,
        {"text": F.col(text)},
        [["a", s] for _, s in seconds],
        [*by, label],
        facts["bytes"],
        positions,
    )
    made = []
    for (kind, s), pair in zip(seconds, met):
        keyed = [F.concat_ws("-", "_number", F.lit(kind)).alias(pair_key)] if pair_key else []
        texts = [F.col("a.text").alias("sentence1"), F.col(f"{s}.text").alias("sentence2")]
        made.append(pair.select(*by, *keyed, *texts, F.lit(kind).alias("label")))
    return reduce(DataFrame.unionByName, made)


def _draw_other_label(
    pairs: DataFrame, plan: DataFrame, plan_bytes: int, by: list[str], label: str, seed: int
) -> DataFrame:
    """Add a random other label per pair: ``other_label``, its rows ``other_n`` and ``other_slots``.

    Labels are drawn evenly, so the few rows of a small label are drawn often; ``other_slots``
    splits the uses of such rows.
    """
    draws = F.sum("num_pairs").over(Window.partitionBy(*by)) / F.greatest(F.col("n_labels") - 1, F.lit(1))
    others = plan.select(
        *by,
        F.col("label_rank").alias("other"),
        F.col(label).alias("other_label"),
        F.col("n_examples").alias("other_n"),
        F.ceil(draws / F.col("n_examples") / USES_PER_SLOT).alias("other_slots"),
    )
    drawn = draw(seed, "d", F.col(label), F.col("q")) % (F.col("n_labels") - 1)
    return (
        pairs.withColumn("other", drawn)
        .withColumn("other", F.col("other") + F.when(F.col("other") >= F.col("label_rank"), 1).otherwise(0))
        .join(small(others, plan_bytes), [*by, "other"])
    )
