"""Class labels: an integer column (or integer array) whose names sit in the field metadata.

Metadata survives filters and parquet, is dropped by ``transform``, and ``union`` keeps only the
left side's. Every operator that changes labels therefore re-attaches them with
:func:`with_label_names`.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NAMES = "names"
OUTSIDE = "O"


def with_label_names(df: DataFrame, column: str, names: Sequence[str]) -> DataFrame:
    """Attach the ordered label names to an id column."""
    names = list(names)
    if len(set(names)) != len(names):
        raise ValueError(f"label names of {column!r} are not unique: {names}")
    return df.withMetadata(column, {NAMES: names})


def find_label_names(field: T.StructField) -> list[str] | None:
    names = (field.metadata or {}).get(NAMES)
    return list(names) if names is not None else None


def label_names(df: DataFrame, column: str) -> list[str]:
    """Ordered names of a class-label column; an error if it is not one."""
    names = find_label_names(df.schema[column])
    if names is None:
        raise ValueError(f"column {column!r} is not a class label: it carries no label names")
    return names


def label_map(df: DataFrame, column: str) -> DataFrame:
    """``(id, name)`` of a class-label column, as a table."""
    names = label_names(df, column)
    return df.sparkSession.range(1).select(
        F.posexplode(F.array(*[F.lit(n) for n in names])).alias("id", "name")
    )


def _lookup(values: list, what: str):
    """Function from an id column to ``values[id]`` that raises on unknown or null ids."""
    table = F.array(*[F.lit(v) for v in values])
    last = len(values) - 1

    def at(i: Column) -> Column:
        return F.when(i.between(0, last), F.element_at(table, i.cast("int") + 1)).otherwise(
            F.raise_error(F.concat(F.lit(f"unknown {what}: "), F.coalesce(i.cast("string"), F.lit("null"))))
        )

    return at


def id_to_name(ids: Column, names: Sequence[str]) -> Column:
    return _lookup(list(names), "label id")(ids)


def ids_to_names(tags: Column, names: Sequence[str]) -> Column:
    """Array of ids -> array of names; an unknown id is an error, never a silent null."""
    return F.transform(tags, _lookup(list(names), "label id"))


def remap_ids(tags: Column, new_ids: Sequence[int]) -> Column:
    """Array of old ids -> array of new ids, ``new_ids[old]``."""
    return F.transform(tags, _lookup([int(i) for i in new_ids], "label id"))


def _hash_table(names: Sequence[str]) -> Column:
    """``names`` with their ids as an array of small maps, by CRC-32 of the name: a literal that is parsed once."""
    buckets: list[dict[str, int]] = [{} for _ in range(max(1, len(names)))]
    for i, n in enumerate(names):
        buckets[zlib.crc32(n.encode("utf-8")) % len(buckets)].setdefault(n, i)
    return F.from_json(F.lit(json.dumps(buckets)), "array<map<string,int>>")


def _named(names: Sequence[str]):
    """Function from a name column to its id that raises on unknown or null names; a lookup reads one bucket."""
    table, n = _hash_table(names), max(1, len(names))

    def at(name: Column) -> Column:
        bucket = F.get(table, (F.crc32(name.cast("binary")) % n).cast("int"))
        return F.coalesce(
            F.try_element_at(bucket, name),
            F.raise_error(F.concat(F.lit("unknown label: "), F.coalesce(name, F.lit("null")))).cast("int"),
        )

    return at


def name_to_id(name: Column, names: Sequence[str]) -> Column:
    """Name -> id; an unknown name is an error."""
    return _named(names)(name)


def names_to_ids(tags: Column, names: Sequence[str]) -> Column:
    return F.transform(tags, _named(names))


def strip_iob(name: Column) -> Column:
    """Remove ``B-`` and ``I-`` wherever they occur in a label name."""
    return F.replace(F.replace(name, F.lit("B-"), F.lit("")), F.lit("I-"), F.lit(""))


def is_iob_name(name: Column) -> Column:
    return name.startswith("B-") | name.startswith("I-") | (name == OUTSIDE)


def to_iob_name(name: Column) -> Column:
    """``B-`` before a plain name; ``O`` stays."""
    return F.when(name == OUTSIDE, name).otherwise(F.concat(F.lit("B-"), name))


def distinct_tags(tags: Column) -> Column:
    """Distinct tag names of a row without ``O``."""
    return F.array_remove(F.array_distinct(tags), OUTSIDE)


def entity_ids(tags: Column, names: Sequence[str]) -> Column:
    """Distinct tag ids of a row without the id of ``O``: the id form of :func:`distinct_tags`.

    Names are unique, so distinct ids are distinct names; only these few are then looked up.
    """
    ids = F.array_distinct(tags)
    names = list(names)
    return F.array_remove(ids, names.index(OUTSIDE)) if OUTSIDE in names else ids


def entity_sentences(tags: Column, names: Sequence[str]) -> Column:
    """Entity names of a row, ``B-``/``I-`` stripped *after* taking distinct tags.

    A row with ``B-person`` and ``I-person`` gives ``person`` twice: that is intended.
    """
    at = _lookup(list(names), "label id")
    return F.transform(entity_ids(tags, names), lambda t: strip_iob(at(t)))


def same_tag_at_same_position(tags_a: Column, tags_b: Column, outside) -> Column:
    """True if some position holds the same tag other than ``outside`` in both arrays.

    ``arrays_zip`` pads the shorter side with nulls, for which ``exists`` gives null, hence the
    coalesce.
    """
    same = F.exists(F.zip_with(tags_a, tags_b, lambda a, b: (a == b) & (a != F.lit(outside))), lambda hit: hit)
    return F.coalesce(same, F.lit(False))
