"""Sentence-entity pairs from token-tag rows.

A sentence is similar to the name of every entity tagged in it and not similar to every other
entity of its split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import entity_ids, entity_sentences, id_to_name, label_names, strip_iob
from ..functions.tokens import lowercase_some, sentence
from .gather import row_bytes
from .positions import small
from .sampling import flag_every_kth

SIMILAR = "similar"
NOT_SIMILAR = "not_similar"


def _names(df: DataFrame, tags: str, names: Sequence[str] | None) -> list[str]:
    return list(names) if names is not None else label_names(df, tags)


def entity_vocabulary(
    df: DataFrame, names: Sequence[str] | None = None, tags: str = "ner_tags", by: Sequence[str] = ()
) -> DataFrame:
    """Distinct entity names, per split if ``by`` names one; reads the tag column only."""
    names = _names(df, tags, names)
    seen = df.select(*by, F.explode(entity_ids(F.col(tags), names)).alias("_id")).distinct()
    return seen.select(*by, strip_iob(id_to_name(F.col("_id"), names)).alias("entity")).distinct()


def similar_entity_pairs(
    df: DataFrame, names: Sequence[str] | None = None, tokens: str | Column = "tokens", tags: str = "ner_tags",
    by: Sequence[str] = (),
) -> DataFrame:
    """One pair per distinct tag of the row; ``B-x`` and ``I-x`` in one row give two equal pairs."""
    names = _names(df, tags, names)
    tokens = F.col(tokens) if isinstance(tokens, str) else tokens
    entities = entity_sentences(F.col(tags), names)
    return _exploded(df, by, sentence(tokens), entities, SIMILAR)


def _exploded(df: DataFrame, by: Sequence[str], said: Column, entities: Column, label: str) -> DataFrame:
    """The sentence is made in a projection of its own: once per row, not once per pair."""
    rows = df.select(*by, said.alias("sentence1"), entities.alias("_entities"))
    return rows.select(*by, "sentence1", F.explode("_entities").alias("sentence2"), F.lit(label).alias("label"))


def dissimilar_entity_pairs(
    df: DataFrame, names: Sequence[str] | None = None, tokens: str = "tokens", tags: str = "ner_tags",
    by: Sequence[str] = (),
) -> DataFrame:
    """One pair per entity of the split's vocabulary that the row does not hold.

    The vocabulary is one array per split. It holds at most the label names, which bounds what is
    broadcast.
    """
    names = _names(df, tags, names)
    if by:
        vocabulary = (
            entity_vocabulary(df, names, tags, by)
            .groupBy(*[F.col(c).alias(f"_v_{c}") for c in by])
            .agg(F.collect_list("entity").alias("_vocabulary"))
        )
        splits, split_bytes = df.select(*by).distinct().agg(F.count("*"), row_bytes(df, by)).first()
        byte_bound = splits * (split_bytes + sum(16 + len(n.encode()) for n in names))
        same_split = [F.col(c).eqNullSafe(F.col(f"_v_{c}")) for c in by]
        joined, words = df.join(small(vocabulary, byte_bound), same_split), F.col("_vocabulary")
    else:
        seen = [r["entity"] for r in entity_vocabulary(df, names, tags).collect()]
        joined, words = df, F.array(*[F.lit(e) for e in seen]).cast("array<string>")
    others = F.array_except(words, entity_sentences(F.col(tags), names))
    return _exploded(joined, by, sentence(F.col(tokens)), others, NOT_SIMILAR)


def entity_pairs(
    df: DataFrame,
    order_by: str,
    names: Sequence[str] | None = None,
    tokens: str = "tokens",
    tags: str = "ner_tags",
    split: str | None = None,
    augment_lower_case: int = 5,
    seed: int = 42,
) -> DataFrame:
    """Similar and not-similar pairs per split.

    Rows 0, k, 2k, ... of a split (``k = augment_lower_case``) have tokens lowercased at random in
    their similar pairs; not-similar pairs always use the plain tokens.
    """
    by = [split] if split else []
    names = _names(df, tags, names)
    # Only the keys are ranked; tokens and tags are read where their pairs are made.
    flagged = flag_every_kth(df.select(*by, order_by, tokens, tags), order_by, augment_lower_case, by, "_flag")
    augmented = F.when(
        F.col("_flag"), lowercase_some(F.col(tokens), seed, F.col(order_by))
    ).otherwise(F.col(tokens))
    return similar_entity_pairs(flagged, names, augmented, tags, by).unionByName(
        dissimilar_entity_pairs(df, names, tokens, tags, by)
    )
