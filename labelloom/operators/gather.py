"""Fetch rows by position and put them together into pairs.

Pair operators first decide, on positions alone, which rows meet. This module then brings in the
wide columns (texts, tokens): positions are computed on the narrow key columns, and the wide table
is read once and joined with the positions wanted, never sorted or shuffled as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .positions import shuffle_tasks, small, with_position

#: Uses of one row that travel together. A row used a million times is split over 245 slots.
USES_PER_SLOT = 4096


def row_bytes(df: DataFrame, columns: Sequence[str]) -> Column:
    """Aggregate: an upper bound on the bytes that any row of ``columns`` takes."""
    strings = [c for c in columns if isinstance(df.schema[c].dataType, (T.StringType, T.BinaryType))]
    bound = F.lit(48 + 8 * len(columns))
    for c in strings:
        bound = bound + F.coalesce(F.max(F.octet_length(c)), F.lit(0))
    return bound


def gather_pairs(
    df: DataFrame,
    pairs: DataFrame,
    pair_count: int,
    order_by: str | Sequence[str],
    payload: dict[str, Column],
    sides: Sequence[str],
    group_by: Sequence[str] = (),
    key_bytes: int | None = None,
    positions: DataFrame | None = None,
) -> DataFrame:
    """``pairs`` with a struct of ``payload`` columns per side, named like the side.

    For each side ``s``, ``pairs`` says which row stands there: ``s_idx`` (a position), ``s_<g>``
    for each group column, and ``s_slot``, which splits the uses of one row. ``pair_count`` bounds
    its rows. ``order_by`` columns are unique in a group and not null. ``key_bytes``
    (:func:`row_bytes` of the group and key columns) is measured if not given, and ``positions`` (group
    columns, key columns, ``idx``) are worked out.
    """
    return gather_branches(df, pairs, pair_count, order_by, payload, [sides], group_by, key_bytes, positions)[0]


def gather_branches(
    df: DataFrame,
    pairs: DataFrame,
    pair_count: int,
    order_by: str | Sequence[str],
    payload: dict[str, Column],
    branches: Sequence[Sequence[str]],
    group_by: Sequence[str] = (),
    key_bytes: int | None = None,
    positions: DataFrame | None = None,
) -> list[DataFrame]:
    """What :func:`gather_pairs` gives for each list of sides in ``branches``.

    Every join moves the rows of the sides before it, so sides that need not stand together are kept apart.
    """
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    groups = list(group_by)
    if key_bytes is None:
        key_bytes = df.agg(row_bytes(df, [*groups, *keys])).first()[0]
    if positions is None:
        positions = with_position(df.select(*groups, *keys), keys, groups, "idx", unique=True)
    columns = df.select(*groups, *keys, *[c.alias(f"_p_{k}") for k, c in payload.items()])
    row = F.struct(*[F.col(f"_p_{k}").alias(k) for k in payload]).alias("_row")
    at = [*groups, "idx", "slot"]
    every_side = list(dict.fromkeys(s for sides in branches for s in sides))
    rows = _wanted_rows(columns, row, pairs, pair_count, keys, every_side, groups, positions, key_bytes)
    found = []
    for sides in branches:
        met = pairs
        for s in sides:
            met = met.join(
                rows.alias(f"{s}_side"),
                reduce(and_, [F.col(f"{s}_{c}") == F.col(f"{s}_side._{c}") for c in at]),
            ).select(*met.columns, F.col(f"{s}_side._row").alias(s))
        found.append(met)
    return found


def _wanted_rows(columns, row, pairs, pair_count, keys, sides, groups, positions, key_bytes) -> DataFrame:
    """The rows that ``pairs`` asks for, keyed by position and slot.

    The final repartition makes one exchange that the joins of all sides reuse, so the wide table
    is read once.
    """
    at = [*groups, "idx", "slot"]
    uses = pairs.select(
        F.explode(F.array(*[F.struct(*[F.col(f"{s}_{c}").alias(c) for c in at]) for s in sides])).alias("use")
    )
    wanted = uses.select("use.*").distinct()
    byte_bound = pair_count * len(sides) * (key_bytes + 16)
    placed = positions.join(small(wanted, byte_bound), [*groups, "idx"]).select(*at, *keys)
    rows = columns.select(*groups, *keys, row).join(small(placed, byte_bound), [*groups, *keys])
    named = rows.select(*[F.col(c).alias(f"_{c}") for c in at], "_row")
    return named.repartition(shuffle_tasks(columns), *[f"_{c}" for c in at])
