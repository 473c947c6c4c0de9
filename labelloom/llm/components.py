"""Connected components of a link table, by labels that only fall."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``label`` (the least node of its component) of all nodes that have a link.

    In each round a node takes the least node around it, follows these to the end, and becomes one with what it
    has come to; links within one node are dropped, so the next round has fewer of them. A node that is left
    has a lesser one around it in the next round, or has taken in all around it: nodes halve in two rounds.
    """
    both = cut(
        links.select(F.col(a).alias("node"), F.col(b).alias("other"))
        .unionAll(links.select(F.col(b).alias("node"), F.col(a).alias("other")))
        .distinct()
    )
    labels = None
    while True:
        least = both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("label"))
        ends = _ends(cut(least))
        labels = ends if labels is None else cut(_followed(labels, ends))
        at = ends.select(F.col("node").alias("other"), F.col("label").alias("to"))
        met = both.join(ends, "node").join(at, "other").where("label < to").select(F.col("label").alias("node"), F.col("to").alias("other"))
        across = cut(met.distinct())
        if not across.take(1):
            return labels
        both = across.unionAll(across.select(F.col("other").alias("node"), F.col("node").alias("other")))


def joined(labels: DataFrame, links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """The components ``labels`` with further stored ``links``: only what joins two of them is worked on."""
    nodes = links.select(F.explode(F.array(a, b)).alias("node")).distinct()
    known = cut(labels.unionByName(nodes.join(labels, "node", "left_anti").select("node", F.col("node").alias("label"))))
    ends = links.select(a, b)
    for side in (a, b):
        ends = ends.join(known.select(F.col("node").alias(side), F.col("label").alias(f"of_{side}")), side)
    across = cut(ends.select(F.col(f"of_{a}").alias("a"), F.col(f"of_{b}").alias("b")).where("a <> b").distinct())
    return cut(_followed(known, components(across)))


def _followed(labels: DataFrame, further: DataFrame) -> DataFrame:
    """``labels``, each replaced by that of ``further`` for it, if there is one."""
    onward = further.select(F.col("node").alias("label"), F.col("label").alias("onward"))
    return labels.join(onward, "label", "left").select("node", F.coalesce("onward", "label").alias("label"))


def _ends(labels: DataFrame) -> DataFrame:
    """Where each node comes to by the labels of labels; every step doubles what it has gone."""
    while True:
        onward = labels.select(F.col("node").alias("label"), F.col("label").alias("onward"))
        gone = cut(labels.join(onward, "label").select("node", "label", "onward"))
        if not gone.where("onward < label").take(1):
            return labels
        labels = gone.select("node", F.col("onward").alias("label"))
