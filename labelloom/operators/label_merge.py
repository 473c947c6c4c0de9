"""Merge token-tag datasets whose label vocabularies differ.

Vocabularies are metadata: the new ids are worked out from the name lists, and each dataset is
then remapped by one literal lookup in a projection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.labels import (
    is_iob_name,
    label_names,
    names_to_ids,
    remap_ids,
    to_iob_name,
    with_label_names,
)
from .lineage import cut_lineage
from .positions import with_position, with_position_of_key
from .schemas import cast_to_schema, concatenate, require_same_features, token_tag_schema


def merged_vocabulary(vocabularies: Sequence[Sequence[str]]) -> list[str]:
    """Names by new id: labels of all datasets sorted, then each dataset's others in its own order.

    A label of some but not all datasets keeps the first id it gets.
    """
    shared = set.intersection(*[set(v) for v in vocabularies])
    merged = dict.fromkeys(sorted(shared))
    for vocabulary in vocabularies:
        merged.update(dict.fromkeys(vocabulary))
    return list(merged)


def sorted_vocabulary(vocabularies: Sequence[Sequence[str]]) -> list[str]:
    return sorted(set().union(*vocabularies))


def label_catalog(df: DataFrame, dataset: str, label: str) -> DataFrame:
    """Labels that occur per dataset: ``dataset, name``."""
    return (
        df.where(F.col(label).isNotNull())
        .select(F.col(dataset).alias("dataset"), F.col(label).alias("name"))
        .distinct()
    )


def common_labels(catalog: DataFrame) -> DataFrame:
    """Names that every dataset of a label catalog has."""
    n = catalog.select("dataset").distinct().count()
    return catalog.groupBy("name").agg(F.countDistinct("dataset").alias("_n")).where(F.col("_n") == n).select("name")


def label_union(catalog: DataFrame) -> DataFrame:
    """Distinct names with their position in sorted order."""
    return with_position(catalog.select("name").distinct(), "name", name="id").select("id", "name")


def label_inventory(labels: DataFrame) -> DataFrame:
    """Over ``model, id, label`` rows: every label with the models that have it and the ids it has there, and how many labels there are."""
    found = (
        labels.where(F.col("label").isNotNull())
        .groupBy("label")
        .agg(F.countDistinct("model").alias("n_models"), F.count("*").alias("n_ids"))
    )
    return found.withColumn("n_labels", found.agg(F.count("*")).scalar())


def iob_check(catalog: DataFrame) -> DataFrame:
    """Per dataset: whether every name is ``B-...``, ``I-...`` or ``O``."""
    return catalog.groupBy("dataset").agg(F.bool_and(is_iob_name(F.col("name"))).alias("is_iob"))


def iob_names(labels: DataFrame) -> DataFrame:
    """``id, name`` -> ``id, iob_name``: names as they are if all are IOB, else ``B-`` added."""
    all_iob = labels.agg(F.bool_and(is_iob_name(F.col("name")))).first()[0]
    name = F.col("name") if all_iob else to_iob_name(F.col("name"))
    return labels.select("id", name.alias("iob_name"))


def update_tags(df: DataFrame, names: Sequence[str], tags: str = "ner_tags") -> DataFrame:
    """Integer tags stay, string tags become their ids in ``names``."""
    if isinstance(df.schema[tags].dataType.elementType, T.StringType):
        df = df.withColumn(tags, names_to_ids(F.col(tags), names))
    else:
        df = df.withColumn(tags, F.col(tags).cast("array<int>"))
    return with_label_names(df, tags, names)


def remap_tags(df: DataFrame, names: Sequence[str], tags: str = "ner_tags") -> DataFrame:
    """Move a dataset to another vocabulary that holds all its names."""
    ids = {n: i for i, n in enumerate(names)}
    moved = df.withColumn(tags, remap_ids(F.col(tags), [ids[n] for n in label_names(df, tags)]))
    return with_label_names(moved, tags, names)


def sorted_concat(
    datasets: Sequence[DataFrame],
    sort_by: str,
    tiebreak: Sequence[str] = (),
    tasks: int | None = None,
) -> DataFrame:
    """Datasets one after the other, each sorted by ``sort_by`` (nulls last), which is renumbered.

    Rows of equal ``sort_by`` go by ``tiebreak`` columns, then by a hash of the row; rows that are equal in
    everything are interchangeable. A stored number stands for each row, so that any number of copies or null ids is
    spread over tasks. Whole rows are written once and get their place by that number; only keys are sorted.
    """
    columns = datasets[0].columns
    merged = concatenate(
        [
            df.select(*columns, F.lit(number).alias("_part"), F.col(sort_by).isNull().alias("_last"))
            for number, df in enumerate(datasets)
        ]
    )
    stored = cut_lineage(merged.withColumn("_number", F.monotonically_increasing_id()))
    order = ["_part", "_last", sort_by, *tiebreak, "_look", "_number"]
    keys = stored.select("_part", "_last", sort_by, *tiebreak, F.xxhash64(*columns).alias("_look"), "_number")
    placed = with_position(keys, order, name="_place", tasks=tasks).select("_number", "_place")
    found = with_position_of_key(stored, placed, ["_number"], 16, stored.count())
    return found.select(*[F.col("_place").alias(c) if c == sort_by else F.col(c) for c in columns])


def merge_reindexed(datasets: Sequence[DataFrame], tiebreak: Sequence[str] = (), tasks: int | None = None) -> DataFrame:
    """Merge ``tokens, ner_tags, document_id`` datasets under one vocabulary, renumbered 0..n-1.

    ``document_id`` is a 64-bit integer.
    """
    names = merged_vocabulary([label_names(df, "ner_tags") for df in datasets])
    schema = token_tag_schema(names)
    extra = [c for c in datasets[0].columns if c not in schema.names]
    if extra and not set(extra) <= set(tiebreak):
        raise ValueError(f"columns do not match: extra {extra}")
    moved = [remap_tags(df, names) for df in datasets]
    merged = sorted_concat(moved, "document_id", tiebreak, tasks)
    return cast_to_schema(merged.select(*schema.names), schema)


def merge_strict(datasets: Sequence[DataFrame], keep_ids: bool = False) -> DataFrame:
    """Merge datasets of equal features under the sorted union of their names.

    Integer tags are moved to the new ids. ``keep_ids`` leaves them as they are while the names
    change, so ids change meaning wherever vocabularies differ.
    """
    require_same_features(datasets)
    names = sorted_vocabulary([label_names(df, "ner_tags") for df in datasets])

    def move(df: DataFrame) -> DataFrame:
        strings = isinstance(df.schema["ner_tags"].dataType.elementType, T.StringType)
        return update_tags(df, names) if strings or keep_ids else remap_tags(df, names)

    return concatenate([move(df) for df in datasets])
