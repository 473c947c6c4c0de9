import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from labelloom.functions.labels import with_label_names
from labelloom.operators import entity_pairs as EP
from labelloom.operators import positions

NAMES = ["O", "B-person", "I-person", "B-art", "B-SUB-CLASS"]
ROWS = [
    (1, ["Ann", "Lee", "Sings"], [1, 2, 0], "train"),
    (2, ["Old", "Art"], [0, 3], "train"),
    (3, ["None", "Here"], [0, 0], "train"),
    (4, ["Deep", "Class", "x"], [4, 4], "test"),
    (5, [], [], "test"),
    (6, ["Ann"], [1], "test"),
    (7, ["A", "B"], [3, 1], "train"),
    (8, ["Q"], [2], "train"),
    (9, ["Six", "Th"], [0, 2], "train"),
]


def entities(tags):
    return [NAMES[t].replace("B-", "").replace("I-", "") for t in set(tags) - {0}]


def brute(rows, k=None, seed=42):
    out = Counter()
    for split in {r[3] for r in rows}:
        here = sorted(r for r in rows if r[3] == split)
        vocabulary = {e for r in here for e in entities(r[2])}
        for p, (key, tokens, tags, _) in enumerate(here):
            said = tokens
            if k and p % k == 0:
                said = [
                    t.lower() if int(hashlib.md5(f"{seed}|l|{key}|{i}".encode()).hexdigest()[:15], 16) % 2 == 0 else t
                    for i, t in enumerate(tokens)
                ]
            for e in entities(tags):
                out[(split, " ".join(said), e, "similar")] += 1
            for e in vocabulary - set(entities(tags)):
                out[(split, " ".join(tokens), e, "not_similar")] += 1
    return out


@pytest.fixture
def rows(spark):
    df = spark.createDataFrame(ROWS, "document_id int, tokens array<string>, ner_tags array<int>, split string")
    return with_label_names(df, "ner_tags", NAMES)


def bag(df):
    return Counter((r.split, r.sentence1, r.sentence2, r.label) for r in df.collect())


def test_stripping_is_anywhere_and_keeps_duplicates(rows):
    got = Counter(r.sentence2 for r in EP.similar_entity_pairs(rows.where("document_id in (1, 4)")).collect())
    assert got == {"person": 2, "SUCLASS": 1}


@pytest.mark.parametrize("k,partitions", [(1, 16), (2, 3), (5, 1)])
def test_pairs_per_split_against_loops(rows, k, partitions):
    df = rows.repartition(partitions)
    got = EP.entity_pairs(df, "document_id", split="split", augment_lower_case=k, names=NAMES)
    assert bag(got) == brute(ROWS, k)


def test_vocabulary_join_without_broadcast(rows, monkeypatch):
    monkeypatch.setattr(positions, "BROADCAST_BYTES", -1)
    got = EP.dissimilar_entity_pairs(rows, by=["split"])
    assert bag(got) == Counter({p: n for p, n in brute(ROWS).items() if p[3] == "not_similar"})


def test_whole_dataset_vocabulary(rows):
    one = rows.withColumn("split", F.lit("all"))
    got = EP.dissimilar_entity_pairs(one).withColumn("split", F.lit("all"))
    want = brute([(*r[:3], "all") for r in ROWS])
    assert bag(got) == Counter({p: n for p, n in want.items() if p[3] == "not_similar"})


def test_vocabulary(rows):
    got = {(r.split, r.entity) for r in EP.entity_vocabulary(rows, by=["split"]).collect()}
    assert got == {("train", "person"), ("train", "art"), ("test", "SUCLASS"), ("test", "person")}


def test_no_entities_at_all(rows):
    none = rows.where("document_id = 3")
    assert EP.entity_pairs(none, "document_id", names=NAMES).count() == 0


def test_unknown_tag_missing_names_and_null_token_are_errors(spark, rows):
    bad = spark.createDataFrame([(1, ["a"], [9], "x")], rows.schema)
    with pytest.raises(Exception, match="unknown label id: 9"):
        EP.similar_entity_pairs(bad, NAMES).collect()
    with pytest.raises(ValueError, match="not a class label"):
        EP.similar_entity_pairs(spark.createDataFrame(ROWS, "document_id int, tokens array<string>, ner_tags array<int>, split string"))
    null_token = spark.createDataFrame([(1, ["a", None], [1, 1], "x")], rows.schema)
    with pytest.raises(Exception, match="null token"):
        EP.similar_entity_pairs(null_token, NAMES).collect()
    with pytest.raises(ValueError):
        EP.entity_pairs(rows, "document_id", augment_lower_case=0)


def test_sentence_is_made_below_the_explode(rows):
    plan = EP.similar_entity_pairs(rows)._jdf.queryExecution().executedPlan().toString().splitlines()
    made = next(i for i, line in enumerate(plan) if "array_join" in line)
    exploded = next(i for i, line in enumerate(plan) if "Generate" in line)
    assert made > exploded


def test_no_cross_join(rows):
    plan = EP.dissimilar_entity_pairs(rows, by=["split"])._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
