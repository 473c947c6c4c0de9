"""Schema-level operators. A catalog has one row per column: dataset, position, column, kind."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.labels import NAMES, find_label_names

CATALOG_SCHEMA = "dataset string, position int, column string, kind string, type string"


def text_column(df: DataFrame) -> str | None:
    """The first string column, else the first column whose type mentions strings."""
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            return f.name
    for f in df.schema.fields:
        if "string" in f.dataType.simpleString():
            return f.name
    return None


def text_of(df: DataFrame, column: str) -> Column:
    """The column as text; arrays of strings are joined by a space."""
    if isinstance(df.schema[column].dataType, T.ArrayType):
        return F.array_join(F.col(column).cast("array<string>"), " ")
    return F.col(column).cast("string")


def drop_empty_text(df: DataFrame, column: str = "text") -> DataFrame:
    return df.where(F.col(column).isNotNull() & (F.col(column) != ""))


def column_kind(field: T.StructField) -> str:
    if isinstance(field.dataType, T.ArrayType):
        return "Sequence"
    return "ClassLabel" if find_label_names(field) is not None else "Value"


def _exact_type(field: T.StructField) -> str:
    labelled = find_label_names(field) is not None
    if isinstance(field.dataType, T.ArrayType):
        return "Sequence(ClassLabel)" if labelled else f"Sequence({field.dataType.elementType.simpleString()})"
    return "ClassLabel" if labelled else field.dataType.simpleString()


def schema_catalog(spark: SparkSession, datasets: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Catalog of the declared schemas; no data is read."""
    rows = [
        (name, i, f.name, column_kind(f), _exact_type(f))
        for name, df in datasets
        for i, f in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def compatible_datasets(catalog: DataFrame) -> DataFrame:
    """``dataset_1, dataset_2`` where 2 may be merged with 1.

    Both have equally many columns and every kind of 1 occurs in 2. The relation has a direction:
    kinds of 2 that 1 lacks do not matter.
    """
    shapes = catalog.groupBy("dataset").agg(F.count("*").alias("n"), F.collect_set("kind").alias("kinds"))
    one = shapes.select(F.col("dataset").alias("dataset_1"), "n", F.col("kinds").alias("kinds_1"))
    two = shapes.select(F.col("dataset").alias("dataset_2"), "n", F.col("kinds").alias("kinds_2"))
    return (
        one.join(two, "n")
        .where("dataset_1 <> dataset_2")
        .where(F.size(F.array_except("kinds_1", "kinds_2")) == 0)
        .select("dataset_1", "dataset_2")
    )


def equal_shape_datasets(catalog: DataFrame) -> DataFrame:
    """Strict form: the exact column types of both match one to one, names aside."""
    shapes = catalog.groupBy("dataset").agg(F.array_sort(F.collect_list("type")).alias("types"))
    one = shapes.select(F.col("dataset").alias("dataset_1"), "types")
    two = shapes.select(F.col("dataset").alias("dataset_2"), "types")
    return one.join(two, "types").where("dataset_1 <> dataset_2").select("dataset_1", "dataset_2")


def group_mergeable(
    spark: SparkSession, datasets: Sequence[tuple[str, DataFrame]], strict: bool = False
) -> list[list[str]]:
    """Group dataset names in input order: each opens a group unless it already sits in one.

    By default the earlier of two datasets decides their compatibility, groups are not transitive,
    and a later dataset may join more than one group. ``strict`` compares exact types and puts
    each dataset in one group. The loop runs over dataset names, not data.
    """
    names = [name for name, _ in datasets]
    catalog = schema_catalog(spark, datasets)
    fits = equal_shape_datasets(catalog) if strict else compatible_datasets(catalog)
    pairs = {(r["dataset_1"], r["dataset_2"]) for r in fits.collect()}
    groups: list[list[str]] = []
    placed: set[str] = set()
    for i, name in enumerate(names):
        if name in placed:
            continue
        members = [name] + [
            other for other in names[i + 1 :] if (name, other) in pairs and not (strict and other in placed)
        ]
        placed.update(members)
        groups.append(members)
    return groups


def merge_groups(spark: SparkSession, datasets: Sequence[tuple[str, DataFrame]], strict: bool = False) -> DataFrame:
    """The groups as a table ``group_id, position, dataset``."""
    rows = [
        (g, p, name)
        for g, members in enumerate(group_mergeable(spark, datasets, strict), 1)
        for p, name in enumerate(members)
    ]
    return spark.createDataFrame(rows, "group_id int, position int, dataset string")


def cast_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns, cast, with the declared label names."""
    have, want = set(df.columns), {f.name for f in schema.fields}
    if have != want:
        raise ValueError(f"columns do not match: missing {sorted(want - have)}, extra {sorted(have - want)}")
    return df.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata or {}) for f in schema.fields]
    )


def token_tag_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType(
        [
            T.StructField("tokens", T.ArrayType(T.StringType())),
            T.StructField("ner_tags", T.ArrayType(T.IntegerType()), metadata={NAMES: list(names)}),
            T.StructField("document_id", T.LongType()),
        ]
    )


def _features(df: DataFrame, ignore: str | None = None) -> set[tuple]:
    found = set()
    for f in df.schema.fields:
        names = find_label_names(f)
        if f.name == ignore and names is not None:
            continue
        found.add((f.name, f.dataType.simpleString(), tuple(names) if names is not None else None))
    return found


def require_same_features(datasets: Sequence[DataFrame], ignore: str = "ner_tags") -> None:
    """All datasets have the columns and types of the first, the label column aside."""
    first = _features(datasets[0], ignore)
    for i, df in enumerate(datasets[1:], 1):
        if _features(df, ignore) != first:
            raise ValueError(f"dataset {i} does not have the features of the first: {_features(df, ignore) ^ first}")


def concatenate(datasets: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name. Types must match: a union would widen them silently and fail at run time."""

    def types(df: DataFrame) -> dict[str, str]:
        return {f.name: f.dataType.simpleString() for f in df.schema.fields}

    merged = datasets[0]
    for df in datasets[1:]:
        if types(df) != types(merged):
            raise ValueError(f"column types differ: {types(merged)} and {types(df)}")
        merged = merged.unionByName(df)
    return merged


def row_counts(datasets: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """``dataset, n_rows``; one shuffle for all datasets, empty ones included."""
    spark = datasets[0][1].sparkSession
    counted = spark.createDataFrame([(name, 0) for name, _ in datasets], "dataset string, one long")
    for name, df in datasets:
        counted = counted.unionByName(df.select(F.lit(name).alias("dataset"), F.lit(1).cast("long").alias("one")))
    return counted.groupBy("dataset").agg(F.sum("one").alias("n_rows"))
