"""The registered queries: every operator on the given tables.

``documents`` serves as a text-class dataset (label ``lang``), ``conversations`` and ``benchmark``
as token-tag datasets whose tags are derived from token lengths.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import labels as L
from ..functions.labels import with_label_names
from ..functions.tokens import lowercase_some, sentence
from ..functions.vectors import unit_score
from ..operators import embedding as E
from ..operators import entity_pairs as EP
from ..operators import label_merge as M
from ..operators import label_split as LS
from ..operators import row_pairs as R
from ..operators import sampling as S
from ..operators import schemas as C
from ..operators import text_pairs as TP
from ..operators import training as TR
from ..operators import wide_pca as W
from ..operators.lineage import scratch_path
from ..sources import tables, text_files, tsv
from . import jobs

# Label names of the token-tag examples.
ENTITY_NAMES = ["O", "art", "building", "event", "location", "organization", "other", "person", "product"]
IOB_NAMES = [
    "O", "B-art", "I-art", "B-building", "I-building", "B-event", "I-event", "B-location", "I-location",
    "B-organization", "I-organization", "B-other", "I-other", "B-person", "I-person", "B-product", "I-product",
]
ROLE_NAMES = {
    "user": ENTITY_NAMES,
    "assistant": ["O", "person", "place", "art", "event", "animal", "location", "product", "food"],
    "system": ["O", "art", "food", "law", "person", "building", "animal", "event", "other"],
}
PARTNERS = 2
DIMS = (48, 32, 16)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", F.col("lang").alias("label"))


def turn_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations with their role as label."""
    return table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("document_id"), "text", F.col("role").alias("label")
    )


def class_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with the class id of their language."""
    names = ["de", "en", "es", "fr"]
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", L.name_to_id(F.col("lang"), names).alias("label"))
    return with_label_names(docs, "label", names)


def _tags(tokens: Column, kinds: int) -> Column:
    return F.transform(
        tokens, lambda t: F.when(F.length(t) >= 9, 1 + F.length(t) % kinds).otherwise(F.lit(0)).cast("int")
    )


def token_tags(spark: SparkSession, sf_dir: str, iob: bool = False) -> DataFrame:
    names = IOB_NAMES if iob else ENTITY_NAMES
    rows = (
        table(spark, sf_dir, "conversations")
        .select((F.col("conv_id") * 1000 + F.col("turn")).alias("document_id"), "role", F.split("text", " ").alias("tokens"))
        .withColumn("ner_tags", _tags(F.col("tokens"), len(names) - 1))
    )
    return with_label_names(rows, "ner_tags", names)


def benchmark_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = (
        table(spark, sf_dir, "benchmark")
        .select(F.col("item_id").alias("document_id"), F.split("text", " ").alias("tokens"))
        .withColumn("ner_tags", _tags(F.col("tokens"), len(IOB_NAMES) - 1))
    )
    return with_label_names(rows, "ner_tags", IOB_NAMES)


def role_datasets(spark: SparkSession, sf_dir: str, roles: list[str]) -> list[DataFrame]:
    rows = token_tags(spark, sf_dir)
    picked = []
    for role in roles:
        part = rows.where(F.col("role") == role).select("tokens", "ner_tags", "document_id")
        picked.append(with_label_names(part, "ner_tags", ROLE_NAMES[role]))
    return picked


def next_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pair table: each turn with the next one; similar after an even turn."""
    turns = table(spark, sf_dir, "conversations")
    first = turns.select("conv_id", "turn", F.col("text").alias("sentence1"))
    second = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("sentence2"))
    return first.join(second, ["conv_id", "turn"]).select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("pair_id"),
        "sentence1",
        "sentence2",
        F.when(F.col("turn") % 2 == 0, "similar").otherwise("dissimilar").alias("label"),
    )


def embedding_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring vectors, gold 1 if their labels agree."""
    vectors = table(spark, sf_dir, "embeddings")
    a = vectors.select("vec_id", F.col("embedding").alias("u"), F.col("label").alias("label_u"))
    b = vectors.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("v"), F.col("label").alias("label_v"))
    return a.join(b, "vec_id").select(
        "vec_id", "u", "v", (F.col("label_u") == F.col("label_v")).cast("double").alias("gold")
    )


def all_tables(spark: SparkSession, sf_dir: str) -> list[tuple[str, DataFrame]]:
    """The given tables; ``quality``, ``toxic`` and the label of ``embeddings`` are class labels."""
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
    names += ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
    found = []
    for name in names:
        df = table(spark, sf_dir, name)
        if name == "labels":
            df = with_label_names(with_label_names(df, "quality", ["low", "good"]), "toxic", ["no", "yes"])
        if name == "embeddings":
            df = with_label_names(df, "label", [f"c{i}" for i in range(10)])
        found.append((name, df))
    return found


def _joined(column: str) -> Column:
    return F.array_join(F.col(column).cast("array<string>"), ",")


# --- sources and sinks -------------------------------------------------------------------------


def saved_dataset(spark, sf_dir):
    """Split, save, and read one split back."""
    path = scratch_path(spark, "dataset")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    tables.write_dataset(S.assign_splits(docs, "doc_id"), path)
    return tables.read_split(spark, path, "validation").select("doc_id", "text", "lang")


def merged_and_saved(spark, sf_dir):
    """Merge, attach info, split, save under the next free version, read back."""
    path = jobs.merge_and_save(
        role_datasets(spark, sf_dir, list(ROLE_NAMES)), scratch_path(spark, "merged"), "roles", "none"
    )
    info = tables.read_info(spark, path)
    return (
        tables.read_dataset(spark, path)
        .groupBy("split")
        .agg(F.count("*").alias("n_rows"), F.sum("document_id").alias("sum_id"), F.sum(F.size("tokens")).alias("n_tokens"))
        .withColumn("directory", F.lit(path.rsplit("/", 1)[1]))
        .withColumn("description", F.lit(info["description"]))
    )


def scored_tsv(spark, sf_dir):
    """Write a gzip TSV without quoting, read it back, take the scored rows of one split."""
    path = scratch_path(spark, "tsv")
    rows = table(spark, sf_dir, "part").select(
        F.when(F.col("p_partkey") % 2 == 0, "test").otherwise("dev").alias("split"),
        (F.col("p_size") / 10).alias("score"),
        F.concat(F.lit('"'), "p_name").alias("sentence1"),
        F.concat("p_brand", F.lit("\\"), "p_type").alias("sentence2"),
    )
    writer = rows.write.option("sep", "\t").option("header", True).option("compression", "gzip")
    writer.option("quote", "\u0000").option("escapeQuotes", False).csv(path)
    return TR.scored_sentences(tsv.read_tsv(spark, path))


def text_chunks(spark, sf_dir):
    return text_files.text_chunks(table(spark, sf_dir, "documents"), "doc_id", column="text")


def text_files_written(spark, sf_dir):
    """Two datasets to text files, as they are; per file the length and digest of what it holds."""
    path = scratch_path(spark, "text")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    turns = token_tags(spark, sf_dir).select("document_id", F.array_join("tokens", " ").alias("text"))
    text_files.write_text_files([("documents", docs, "doc_id"), ("conversations", turns, "document_id")], path, 100)
    return text_files.read_text_files(spark, path).select(
        "dataset", "file_index", F.length("content").alias("n_chars"), F.md5("content").alias("digest")
    )


def saved_text_files(spark, sf_dir):
    """The job from a saved dataset to text files: the training split of the documents."""
    saved, path = scratch_path(spark, "docs"), scratch_path(spark, "files")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    tables.write_dataset(S.assign_splits(docs, "doc_id"), saved)
    jobs.convert_to_text_files(spark, {"docs": saved}, path, "doc_id", 50)
    return text_files.read_text_files(spark, path).select("dataset", "file_index", F.md5("content").alias("digest"))


def saved_text_pairs(spark, sf_dir):
    """The job from a saved text-class dataset to saved sentence pairs."""
    saved, path = scratch_path(spark, "turns"), scratch_path(spark, "pairs")
    tables.write_dataset(S.assign_splits(turn_class(spark, sf_dir), "document_id"), saved)
    jobs.build_text_pairs(spark, saved, path, "document_id", PARTNERS)
    return tables.read_dataset(spark, path)


def saved_entity_pairs(spark, sf_dir):
    """The job from a saved token-tag dataset to saved sentence-entity pairs."""
    saved, path = scratch_path(spark, "tags"), scratch_path(spark, "pairs")
    rows = token_tags(spark, sf_dir, iob=True).select("document_id", "tokens", "ner_tags")
    tables.write_dataset(S.assign_splits(rows, "document_id"), saved)
    jobs.build_entity_pairs(spark, saved, path)
    return tables.read_dataset(spark, path)


# --- projections and filters -------------------------------------------------------------------


def _both_parts(parts, *columns):
    return parts[0].select(F.lit(1).alias("part"), *columns).unionByName(parts[1].select(F.lit(2).alias("part"), *columns))


def split_text_class(spark, sf_dir):
    return _both_parts(LS.split_by_labels(class_ids(spark, sf_dir), [0, 1], [1, 2]), "doc_id", "label")


def split_token_tags(spark, sf_dir):
    return _both_parts(LS.split_by_labels(token_tags(spark, sf_dir), [1, 2], [3, 4]), "document_id", _joined("ner_tags").alias("tags"))


def split_token_tags_exclusive(spark, sf_dir):
    parts = LS.split_by_labels(token_tags(spark, sf_dir, iob=True), [1, 2], [3, 4], exclusion=True)
    return _both_parts(parts, "document_id", _joined("ner_tags").alias("tags"))


def task_detection(spark, sf_dir):
    """Which split runs on which dataset, with the rows it keeps."""
    found = []
    for name, df in (("documents", class_ids(spark, sf_dir)), ("conversations", token_tags(spark, sf_dir))):
        task = "token-tag" if LS.is_token_tag(df) else "text-class"
        one, two = LS.split_by_labels(df, [1], [2])
        found.append(
            one.agg(F.count("*").alias("rows_1"))
            .select(F.lit(name).alias("dataset"), F.lit(task).alias("task"), F.lit(1).alias("part"), F.col("rows_1").alias("n_rows"))
        )
        found.append(
            two.agg(F.count("*").alias("rows_2"))
            .select(F.lit(name).alias("dataset"), F.lit(task).alias("task"), F.lit(2).alias("part"), F.col("rows_2").alias("n_rows"))
        )
    return C.concatenate(found)


def text_columns(spark, sf_dir):
    """The text column found in each dataset, with its text volume."""
    picked = [
        ("documents", table(spark, sf_dir, "documents")),
        ("pages", table(spark, sf_dir, "pages")),
        ("conversations", token_tags(spark, sf_dir).select("document_id", "ner_tags", "tokens")),
        ("events", table(spark, sf_dir, "events")),
    ]
    found = []
    for name, df in picked:
        column = C.text_column(df)
        text = df.select(C.text_of(df, column).alias("text"))
        found.append(
            text.agg(F.count("text").alias("n_rows"), F.sum(F.length("text")).alias("n_chars")).select(
                F.lit(name).alias("dataset"), F.lit(column).alias("column_name"), "n_rows", "n_chars"
            )
        )
    return C.concatenate(found)


def non_empty_text(spark, sf_dir):
    text = F.when(F.col("lang") == "fr", "").when(F.col("lang") == "es", None).otherwise(F.col("text"))
    return C.drop_empty_text(table(spark, sf_dir, "documents").select("doc_id", text.alias("text")))


def rows_per_label(spark, sf_dir):
    return TP.label_counts(table(spark, sf_dir, "documents"), "lang", ["source"]).withColumnRenamed("lang", "label")


def training_examples(spark, sf_dir):
    rows = TR.training_examples(next_turns(spark, sf_dir))
    return rows.select("pair_id", F.array_join("texts", " || ").alias("texts"), "label")


def declared_schema(spark, sf_dir):
    schema = T.StructType(
        [
            T.StructField("document_id", T.IntegerType()),
            T.StructField("label", T.IntegerType(), metadata={L.NAMES: ["de", "en", "es", "fr"]}),
            T.StructField("text", T.StringType()),
        ]
    )
    return C.cast_to_schema(class_ids(spark, sf_dir).withColumnRenamed("doc_id", "document_id"), schema)


def updated_tags(spark, sf_dir):
    """String tags are looked up; integer tags stay."""
    rows = token_tags(spark, sf_dir)
    names = list(reversed(ENTITY_NAMES))
    strings = rows.withColumn("ner_tags", L.ids_to_names(F.col("ner_tags"), ENTITY_NAMES))
    looked_up = M.update_tags(strings, names).select(F.lit("strings").alias("given"), "document_id", _joined("ner_tags").alias("tags"))
    kept = M.update_tags(rows, names).select(F.lit("ids").alias("given"), "document_id", _joined("ner_tags").alias("tags"))
    return looked_up.unionByName(kept)


# --- pairs -------------------------------------------------------------------------------------


def pair_plan(spark, sf_dir):
    """Planned and generated similar pairs of every label and split."""
    turns = S.assign_splits(turn_class(spark, sf_dir), "document_id")
    plan = TP.pair_plan(turns, PARTNERS, by=["split"])
    labelled = turns.select("document_id", "label", "split", F.concat_ws("|", "label", "document_id").alias("text"))
    made = TP.text_pairs(labelled, "document_id", split="split", partners=PARTNERS, kinds=[TP.SIMILAR])
    first = F.split("sentence1", "\\|")[0]
    counted = made.groupBy("split", first.alias("label")).agg(F.count("*").alias("generated"), F.countDistinct("sentence1").alias("firsts"))
    return plan.join(counted, ["split", "label"], "left").select(
        "split", "label", "n_examples", "n_labels", "num_pairs", F.coalesce("generated", F.lit(0)).alias("generated"), F.coalesce("firsts", F.lit(0)).alias("firsts")
    )


def similar_pairs(spark, sf_dir):
    return TP.text_pairs(text_class(spark, sf_dir), "doc_id", partners=PARTNERS, kinds=[TP.SIMILAR])


def dissimilar_pairs(spark, sf_dir):
    return TP.text_pairs(text_class(spark, sf_dir), "doc_id", partners=PARTNERS, kinds=[TP.DISSIMILAR])


def text_pairs_by_split(spark, sf_dir):
    """The text of every turn paired within and across roles, per split."""
    turns = S.assign_splits(turn_class(spark, sf_dir), "document_id")
    return TP.text_pairs(turns, "document_id", split="split", partners=PARTNERS)


def similar_entity_pairs(spark, sf_dir):
    return EP.similar_entity_pairs(token_tags(spark, sf_dir, iob=True))


def dissimilar_entity_pairs(spark, sf_dir):
    return EP.dissimilar_entity_pairs(token_tags(spark, sf_dir, iob=True))


def entity_pairs_by_split(spark, sf_dir):
    rows = S.assign_splits(token_tags(spark, sf_dir, iob=True), "document_id")
    return EP.entity_pairs(rows, "document_id", split="split")


def row_pairs(spark, sf_dir):
    return R.row_pairs(token_tags(spark, sf_dir), "document_id", partners=PARTNERS)


def row_pair_entities(spark, sf_dir):
    return R.entity_pair_copies(token_tags(spark, sf_dir, iob=True), "document_id")


def row_pairs_with_entities(spark, sf_dir):
    return R.row_pairs_with_entities(benchmark_tags(spark, sf_dir), "document_id", partners=PARTNERS).select(
        "i", "j", "block", "sentence1", "sentence2", "label"
    )


def dissimilar_from_pairs(spark, sf_dir):
    pairs = next_turns(spark, sf_dir)
    return R.dissimilar_from_pairs(pairs, "pair_id", partners=PARTNERS)


def dissimilar_pair_counts(spark, sf_dir):
    """The whole bag of pairs of pairs, counted by sentence."""
    return R.dissimilar_pair_counts(next_turns(spark, sf_dir), "pair_id")


def all_row_pairs(spark, sf_dir):
    return R.all_row_pairs(benchmark_tags(spark, sf_dir), "document_id", partners=PARTNERS)


def random_dissimilar_pairs(spark, sf_dir):
    return R.random_dissimilar_pairs(token_tags(spark, sf_dir), 1000, "document_id")


def remapped_tags(spark, sf_dir):
    roles = list(ROLE_NAMES)
    names = M.merged_vocabulary([ROLE_NAMES[r] for r in roles])
    parts = [
        M.remap_tags(df, names).select(F.lit(r).alias("role"), "document_id", _joined("ner_tags").alias("tags"))
        for r, df in zip(roles, role_datasets(spark, sf_dir, roles))
    ]
    return C.concatenate(parts)


# --- aggregations ------------------------------------------------------------------------------


def entity_vocabulary(spark, sf_dir):
    return EP.entity_vocabulary(token_tags(spark, sf_dir, iob=True), by=["role"])


def _language_catalog(spark, sf_dir):
    return M.label_catalog(table(spark, sf_dir, "documents"), "source", "lang")


def common_labels(spark, sf_dir):
    return M.common_labels(_language_catalog(spark, sf_dir))


def label_union(spark, sf_dir):
    return M.label_union(_language_catalog(spark, sf_dir))


def distinct_sentences(spark, sf_dir):
    return TR.distinct_sentences(next_turns(spark, sf_dir))


def row_counts(spark, sf_dir):
    return C.row_counts(all_tables(spark, sf_dir))


def label_inventory(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(
        F.col("source").alias("model"), F.col("doc_id").alias("id"), F.concat_ws("-", "source", "lang").alias("label")
    )
    return M.label_inventory(rows)


# --- order, splits, samples --------------------------------------------------------------------


def sorted_and_renumbered(spark, sf_dir):
    merged = M.sorted_concat(role_datasets(spark, sf_dir, list(ROLE_NAMES)), "document_id")
    return merged.select("document_id", F.array_join("tokens", " ").alias("sentence"))


def split_70_15_15(spark, sf_dir):
    return S.assign_splits(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")


def split_80_10_10(spark, sf_dir):
    return S.assign_splits(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", fractions=S.SPLIT_80_10_10)


def random_examples(spark, sf_dir):
    return S.sample_exactly(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", 20)


def shuffled_sample(spark, sf_dir):
    return S.sample_up_to(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 10_000)


def sampled_sentences(spark, sf_dir):
    """Distinct sentences of a pair table, then a random sample of them."""
    return S.sample_up_to(TR.distinct_sentences(next_turns(spark, sf_dir)), "sentence", 300)


def sampled_training_examples(spark, sf_dir):
    """Saved text pairs, read back as training examples, of which 20 are drawn for evaluation."""
    pairs = TP.text_pairs(text_class(spark, sf_dir), "doc_id", partners=PARTNERS, pair_key="pair")
    path = scratch_path(spark, "pairs")
    tables.write_dataset(pairs.withColumn(tables.SPLIT, F.lit("train")), path)
    drawn = S.sample_exactly(jobs.read_training_examples(spark, path, "train"), "pair", 20)
    return drawn.select("pair", F.array_join("texts", " || ").alias("texts"), "label")


def shuffled_batches(spark, sf_dir):
    return S.shuffled_batches(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", 32)


def every_fifth_row(spark, sf_dir):
    return S.flag_every_kth(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", 5, ["lang"])


# --- merging -----------------------------------------------------------------------------------


def concatenated(spark, sf_dir):
    return C.concatenate([df.drop("ner_tags") for df in role_datasets(spark, sf_dir, list(ROLE_NAMES))]).select(
        "document_id", F.array_join("tokens", " ").alias("sentence")
    )


def _merged(df):
    return df.select("document_id", F.array_join("tokens", " ").alias("sentence"), _joined("ner_tags").alias("tags"))


def merged_two(spark, sf_dir):
    return _merged(M.merge_reindexed(role_datasets(spark, sf_dir, ["user", "assistant"])))


def merged_three(spark, sf_dir):
    merged = M.merge_reindexed(role_datasets(spark, sf_dir, list(ROLE_NAMES)))
    names = L.label_names(merged, "ner_tags")
    named = merged.withColumn("ner_tags", L.ids_to_names(F.col("ner_tags"), names))
    return _merged(named)


def merged_strict(spark, sf_dir):
    return _merged(M.merge_strict(role_datasets(spark, sf_dir, list(ROLE_NAMES))))


def merged_strict_keep_ids(spark, sf_dir):
    merged = M.merge_strict(role_datasets(spark, sf_dir, list(ROLE_NAMES)), keep_ids=True)
    named = merged.withColumn("ner_tags", L.ids_to_names(F.col("ner_tags"), L.label_names(merged, "ner_tags")))
    return _merged(named)


def compatible_tables(spark, sf_dir):
    """Which given tables may be merged by schema, with the rows a merge would have."""
    datasets = all_tables(spark, sf_dir)
    rows = C.row_counts(datasets)
    fits = C.compatible_datasets(C.schema_catalog(spark, datasets))
    return (
        fits.join(rows.select(F.col("dataset").alias("dataset_1"), F.col("n_rows").alias("n_1")), "dataset_1")
        .join(rows.select(F.col("dataset").alias("dataset_2"), F.col("n_rows").alias("n_2")), "dataset_2")
        .select("dataset_1", "dataset_2", (F.col("n_1") + F.col("n_2")).alias("n_rows"))
    )


def mergeable_groups(spark, sf_dir):
    """Groups of given tables, with the rows of each group."""
    datasets = all_tables(spark, sf_dir)
    groups = C.merge_groups(spark, datasets)
    return (
        groups.join(C.row_counts(datasets), "dataset")
        .groupBy("group_id")
        .agg(
            F.array_join(
                F.transform(F.array_sort(F.collect_list(F.struct("position", "dataset"))), lambda m: m["dataset"]), ","
            ).alias("datasets"),
            F.sum("n_rows").alias("n_rows"),
        )
    )


def wanted_tags(spark, sf_dir):
    rows = token_tags(spark, sf_dir)
    return rows.select("document_id", F.array_join(F.array_sort(LS.wanted_tags(F.col("ner_tags"), [1, 2, 3, 4])), ",").alias("tags"))


# --- scalar functions --------------------------------------------------------------------------


def sentences(spark, sf_dir):
    return token_tags(spark, sf_dir).select("document_id", sentence(F.col("tokens")).alias("sentence"))


def lowercased_tokens(spark, sf_dir):
    rows = token_tags(spark, sf_dir)
    return rows.select("document_id", F.array_join(lowercase_some(F.col("tokens"), 42, F.col("document_id")), " ").alias("sentence"))


def _tag_catalog(spark, sf_dir):
    """Raw tag names seen per role: IOB names for assistants, plain names for the others."""
    plain = token_tags(spark, sf_dir).where("role <> 'assistant'")
    iob = token_tags(spark, sf_dir, iob=True).where("role = 'assistant'")
    return C.concatenate(
        [
            df.select("role", F.explode(F.array_distinct(L.ids_to_names(F.col("ner_tags"), names))).alias("name"))
            for df, names in ((plain, ENTITY_NAMES), (iob, IOB_NAMES))
        ]
    )


def stripped_names(spark, sf_dir):
    names = M.label_catalog(_tag_catalog(spark, sf_dir), "role", "name")
    return names.select("dataset", "name", L.strip_iob(F.col("name")).alias("entity"))


def iob_check(spark, sf_dir):
    return M.iob_check(M.label_catalog(_tag_catalog(spark, sf_dir), "role", "name"))


def iob_names(spark, sf_dir):
    """Names of all roles, and of the assistants alone, whose names are IOB as they are."""
    names = M.label_catalog(_tag_catalog(spark, sf_dir), "role", "name")
    found = [("all", names), ("assistant", names.where("dataset = 'assistant'"))]
    return C.concatenate([M.iob_names(M.label_union(n)).select(F.lit(of).alias("of"), "id", "iob_name") for of, n in found])


def label_map(spark, sf_dir):
    """Ids and names of a class-label column, with the rows of each class."""
    docs = class_ids(spark, sf_dir)
    n = docs.groupBy(F.col("label").alias("id")).agg(F.count("*").alias("n_rows"))
    return L.label_map(docs, "label").join(n, "id", "left").select("id", "name", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def named_tags(spark, sf_dir):
    rows = token_tags(spark, sf_dir, iob=True)
    return rows.select("document_id", F.array_join(L.ids_to_names(F.col("ner_tags"), IOB_NAMES), " ").alias("tags"))


def label_ids(spark, sf_dir):
    return class_ids(spark, sf_dir).select("doc_id", "label")


def distinct_tags(spark, sf_dir):
    rows = token_tags(spark, sf_dir)
    tags = L.distinct_tags(L.ids_to_names(F.col("ner_tags"), ENTITY_NAMES))
    return rows.select("document_id", F.array_join(F.array_sort(tags), ",").alias("tags"))


def same_position_tags(spark, sf_dir):
    """Neighbouring turns compared tag by tag."""
    rows = token_tags(spark, sf_dir)
    nxt = rows.select((F.col("document_id") - 1).alias("document_id"), F.col("ner_tags").alias("next_tags"))
    return rows.join(nxt, "document_id").select(
        "document_id", L.same_tag_at_same_position(F.col("ner_tags"), F.col("next_tags"), 0).alias("same")
    )


def rescaled_scores(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.round(unit_score(F.col("p_size"), 5.0), 6).alias("score"))


# --- embeddings --------------------------------------------------------------------------------


def cosine_of_pairs(spark, sf_dir):
    pairs = E.cosine_pairs(embedding_pairs(spark, sf_dir), "u", "v")
    return pairs.select("vec_id", F.round("cosine", 6).alias("cosine"), "gold")


def similarity_pearson(spark, sf_dir):
    pairs = E.cosine_pairs(embedding_pairs(spark, sf_dir), "u", "v")
    return E.pearson(pairs, "cosine", "gold").select(F.round("pearson", 6).alias("pearson"))


def similarity_spearman(spark, sf_dir):
    pairs = E.cosine_pairs(embedding_pairs(spark, sf_dir), "u", "v")
    return E.spearman(pairs, "cosine", "gold").select(F.round("spearman", 6).alias("spearman"))


def cosine_loss(spark, sf_dir):
    pairs = E.cosine_pairs(embedding_pairs(spark, sf_dir), "u", "v")
    return E.cosine_loss(pairs, "cosine", "gold").select(F.round("loss", 6).alias("loss"))


def _full_rank(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    dim = vectors.select(F.max(F.size("embedding"))).first()[0]
    return dim, E.fit_reducer(vectors, dim)


def _axis_model(spark, sf_dir, k):
    """Components of vectors whose axes are known.

    Axis c has two vectors, at plus and minus the root of the sum of squares of all embeddings there. The mean is zero and the
    covariance diagonal, so the components are the axes, ranked by their sum of squares.
    """
    parts = table(spark, sf_dir, "embeddings").select(F.posexplode("embedding").alias("c", "x"))
    axes = parts.groupBy("c").agg(F.sqrt(F.sum(F.col("x").cast("double") * F.col("x").cast("double"))).alias("r"))
    wide = axes.withColumn("n", axes.agg(F.count("*")).scalar())
    signed = wide.select("n", "c", F.explode(F.array(F.col("r"), -F.col("r"))).alias("r"))
    on_axis = F.transform(F.sequence(F.lit(0), F.col("n").cast("int") - 1), lambda i: F.when(i == F.col("c"), F.col("r")).otherwise(0.0))
    return E.fit_reducer(signed.select(on_axis.alias("embedding")), k)


def pca_fit(spark, sf_dir):
    """Variances of all components: their sum, and their sum of squares, which is that of all covariances."""
    dim, model = _full_rank(spark, sf_dir)
    reduced = E.reduce_embeddings(table(spark, sf_dir, "embeddings"), model)
    variance = reduced.select("vec_id", F.posexplode("reduced").alias("component", "x")).groupBy("component").agg(
        F.var_samp("x").alias("v")
    )
    return variance.agg(
        F.count("*").alias("n_components"),
        F.round(F.sum("v"), 4).alias("total_variance"),
        F.round(F.sum(F.col("v") * F.col("v")), 5).alias("squared_variances"),
    )


def wide_pca_fit(spark, sf_dir):
    """The same variances, found without a covariance matrix."""
    vectors = table(spark, sf_dir, "embeddings")
    dim = vectors.select(F.max(F.size("embedding"))).first()[0]
    model = W.fit_wide_reducer(vectors, dim)
    reduced = W.reduce_wide_embeddings(vectors.select("vec_id", "embedding"), model)
    variance = reduced.select(F.posexplode("reduced").alias("component", "x")).groupBy("component").agg(F.var_samp("x").alias("v"))
    return variance.agg(
        F.count("*").alias("n_components"), F.round(F.sum("v"), 4).alias("total_variance"), F.round(F.sum(F.col("v") * F.col("v")), 5).alias("squared_variances")
    )


def pca_projection(spark, sf_dir):
    """Projection on the leading axes, as lengths: components have no sign."""
    model = _axis_model(spark, sf_dir, max(DIMS))
    reduced = E.reduce_embeddings(table(spark, sf_dir, "embeddings"), model, k=min(DIMS))
    return reduced.select("vec_id", F.posexplode("reduced").alias("component", "value")).select(
        "vec_id", "component", F.round(F.abs("value"), 5).alias("length")
    )


def pca_projection_norms(spark, sf_dir):
    """Projection on all components keeps every length."""
    _, model = _full_rank(spark, sf_dir)
    reduced = E.reduce_embeddings(table(spark, sf_dir, "embeddings"), model)
    norm = F.sqrt(F.aggregate("reduced", F.lit(0.0), lambda a, x: a + x * x))
    return reduced.select("vec_id", F.round(norm, 4).alias("norm"))


def dimension_sweep(spark, sf_dir):
    model = _axis_model(spark, sf_dir, max(DIMS))
    return E.sweep_dimensions(embedding_pairs(spark, sf_dir), model, DIMS).select("k", F.round("score", 5).alias("score"))


def dimension_sweep_full(spark, sf_dir):
    """At full dimension the projection is a rotation: the score is that of the embeddings."""
    dim, model = _full_rank(spark, sf_dir)
    scores = E.sweep_dimensions(embedding_pairs(spark, sf_dir), model, [dim])
    return scores.select("k", F.round("score", 4).alias("score"))


def encoded_sentences(spark, sf_dir):
    """A user's encoder over whole texts, made once in each worker; here three letter counts stand for a model."""

    def load():
        letters = ("a", "e", " ")
        return lambda texts: np.array([[t.count(x) for x in letters] for t in texts], dtype="float32").reshape(-1, 3)

    encoded = E.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", factory=load)
    return encoded.select("doc_id", *[F.col("embedding")[i].cast("long").alias(f"e{i}") for i in range(3)])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        saved_dataset, merged_and_saved, scored_tsv, text_chunks, text_files_written,
        saved_text_files, saved_text_pairs, saved_entity_pairs,
        split_text_class, split_token_tags, split_token_tags_exclusive, task_detection, text_columns,
        non_empty_text, rows_per_label, training_examples, declared_schema, updated_tags,
        pair_plan, similar_pairs, dissimilar_pairs, text_pairs_by_split,
        similar_entity_pairs, dissimilar_entity_pairs, entity_pairs_by_split,
        row_pairs, row_pair_entities, row_pairs_with_entities, dissimilar_from_pairs, dissimilar_pair_counts, all_row_pairs,
        random_dissimilar_pairs, remapped_tags,
        entity_vocabulary, common_labels, label_union, distinct_sentences, row_counts, label_inventory,
        sorted_and_renumbered, split_70_15_15, split_80_10_10, random_examples, shuffled_sample,
        sampled_sentences, sampled_training_examples,
        shuffled_batches, every_fifth_row,
        concatenated, merged_two, merged_three, merged_strict, merged_strict_keep_ids,
        compatible_tables, mergeable_groups, wanted_tags,
        sentences, lowercased_tokens, stripped_names, iob_check, iob_names, label_map, named_tags,
        label_ids, distinct_tags, same_position_tags, rescaled_scores,
        cosine_of_pairs, similarity_pearson, similarity_spearman, cosine_loss,
        pca_fit, wide_pca_fit, pca_projection, pca_projection_norms, dimension_sweep, dimension_sweep_full,
        encoded_sentences,
    )
}
