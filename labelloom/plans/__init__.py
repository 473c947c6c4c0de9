"""Whole jobs: load, build, save."""

from .jobs import (
    build_entity_pairs,
    build_text_pairs,
    convert_to_text_files,
    merge_and_save,
    read_training_examples,
)

__all__ = [
    "build_entity_pairs",
    "build_text_pairs",
    "convert_to_text_files",
    "merge_and_save",
    "read_training_examples",
]
