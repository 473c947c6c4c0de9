"""Whole jobs over saved datasets: load, build, save."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.entity_pairs import entity_pairs
from ..operators.label_merge import merge_reindexed
from ..operators.sampling import SPLIT_70_15_15, assign_splits
from ..operators.text_pairs import PARTNERS, text_pairs
from ..operators.training import training_examples
from ..sources.tables import SPLIT, UNCITED, UNDESCRIBED, read_dataset, read_split, write_dataset, write_versioned
from ..sources.text_files import LINES_PER_FILE, write_text_files


def build_text_pairs(
    spark: SparkSession,
    path: str,
    save_path: str,
    order_by: str,
    partners: int = PARTNERS,
    seed: int = 42,
) -> None:
    """Saved ``text, label`` dataset -> saved sentence pairs, split by split."""
    rows = read_dataset(spark, path)
    write_dataset(text_pairs(rows, order_by, split=SPLIT, partners=partners, seed=seed), save_path)


def build_entity_pairs(
    spark: SparkSession,
    path: str,
    save_path: str,
    order_by: str = "document_id",
    augment_lower_case: int = 5,
    seed: int = 42,
) -> None:
    """Saved token-tag dataset -> saved sentence-entity pairs, split by split."""
    rows = read_dataset(spark, path)
    write_dataset(
        entity_pairs(rows, order_by, split=SPLIT, augment_lower_case=augment_lower_case, seed=seed), save_path
    )


def merge_and_save(
    datasets: Sequence[DataFrame],
    output_dir: str,
    description: str = UNDESCRIBED,
    citation: str = UNCITED,
    tiebreak: Sequence[str] = (),
    fractions: dict[str, float] = SPLIT_70_15_15,
    seed: int = 42,
) -> str:
    """Merge token-tag datasets, split them exactly and save the next ``merged_dataset_n``.

    The merged ids are 0..n-1, so the splits are cut on that range and the merge runs once.
    """
    merged = merge_reindexed(datasets, tiebreak)
    ids = merged.sparkSession.range(sum(df.count() for df in datasets)).withColumnRenamed("id", "document_id")
    split = assign_splits(merged, "document_id", seed, fractions, keys=ids)
    return write_versioned(split, output_dir, "merged_dataset", description, citation)


def convert_to_text_files(
    spark: SparkSession,
    paths: dict[str, str],
    output_dir: str,
    order_by: str,
    lines_per_file: int = LINES_PER_FILE,
    split: str = "train",
) -> None:
    """One split of each saved dataset (name -> path) -> text files of ``lines_per_file`` rows."""
    write_text_files(
        [(name, read_split(spark, path, split), order_by) for name, path in paths.items()], output_dir, lines_per_file
    )


def read_training_examples(spark: SparkSession, path: str, split: str = "train") -> DataFrame:
    """One split of a saved pair dataset as training examples."""
    return training_examples(read_split(spark, path, split))
