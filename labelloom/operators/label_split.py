"""Split a labelled dataset in two by label sets."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TAGS = "ner_tags"


def is_token_tag(df: DataFrame, tags: str = TAGS) -> bool:
    """Token-tag datasets are told apart from text-class ones by their tag column."""
    return tags in df.columns


def _label_in(label: Column, wanted: Iterable) -> Column:
    """Plain predicates, so that they are pushed into the scan; null labels fall out of a filter."""
    wanted = list(wanted)
    values = [w for w in wanted if w is not None]
    hit = label.isin(values) if values else F.lit(False)
    return hit | label.isNull() if None in wanted else hit


def _tags_hit(tags: Column, wanted: Iterable) -> Column:
    """Some tag is wanted. ``arrays_overlap`` gives null next to null tags, hence the coalesce."""
    wanted = list(wanted)
    values = [w for w in wanted if w is not None]
    hit = F.lit(False)
    if values:
        hit = F.coalesce(F.arrays_overlap(tags, F.array(*[F.lit(v) for v in values])), F.lit(False))
    if None in wanted:
        hit = hit | F.coalesce(F.exists(tags, lambda t: t.isNull()), F.lit(False))
    return hit


def wanted_tags(tags: Column, wanted: Iterable) -> Column:
    """The wanted tags that a row holds, as a set."""
    return F.array_intersect(tags, F.array(*[F.lit(w) for w in wanted]))


def split_by_labels(
    df: DataFrame,
    labels_1: Iterable,
    labels_2: Iterable,
    exclusion: bool = False,
    label: str = "label",
    tags: str = TAGS,
) -> tuple[DataFrame, DataFrame]:
    """Rows holding a label of the first set, and rows holding one of the second.

    A row may be in both. With ``exclusion`` a token-tag row that hits both sets is in neither.
    Both results are filters over one input; nothing is shuffled.
    """
    if not is_token_tag(df, tags):
        return df.where(_label_in(F.col(label), labels_1)), df.where(_label_in(F.col(label), labels_2))
    in_1, in_2 = _tags_hit(F.col(tags), labels_1), _tags_hit(F.col(tags), labels_2)
    if exclusion:
        return df.where(in_1 & ~in_2), df.where(in_2 & ~in_1)
    return df.where(in_1), df.where(in_2)
