"""Rows that are equal in key and text, with and without a key."""

from __future__ import annotations

from collections import Counter

from labelloom.llm import jaccard, lines, mixing

TEXT = "one two three four five six seven"
SCHEMA = "doc_id long, text string, source string"


def test_one_row_is_left_of_each_group(spark):
    rows = [(3, TEXT, "a"), (3, TEXT, "a"), (3, TEXT, "b"), (4, TEXT, "a"), (None, TEXT, "a")]
    rows += [(None, "eight nine ten eleven twelve", "c")] * 50 + [(7, "by itself it stays as it is", "d")]
    rows += [(None, "", "e"), (None, "", "e"), (8, None, "e")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    left = Counter((r["doc_id"], r["text"]) for r in jaccard.first_documents(docs).collect())
    assert left == {(3, TEXT): 1, (None, "eight nine ten eleven twelve"): 1, (7, "by itself it stays as it is"): 1, (None, ""): 2, (8, None): 1}
    again = jaccard.first_documents(docs.coalesce(1)).where("doc_id = 3").collect()
    assert again == jaccard.first_documents(docs).where("doc_id = 3").collect()


def test_lines_stay_once_of_repeated_rows(spark):
    rows = [(1, f"{TEXT}\nyes\nof its own here", s) for s in "aab"] + [(None, "eight nine ten\n\nno", "c")] * 50
    rows += [(None, f"{TEXT}\nsome other line", "d"), (5, "yes", "e"), (5, "yes", "e"), (6, None, "e"), (6, None, "e")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = lines.dedup_lines(docs).collect()
    got = Counter((r["doc_id"], r["text"], r["n_lines"], r["n_removed"], r["emptied"]) for r in found)
    assert got == {
        (1, f"{TEXT}\nyes\nof its own here", 3, 0, False): 1,
        (1, "", 3, 3, True): 2,
        (None, "eight nine ten\n\nno", 3, 0, False): 1,
        (None, "", 3, 2, True): 49,
        (None, "some other line", 2, 1, False): 1,
        (5, "", 1, 1, True): 2,
        (6, None, 0, 0, False): 2,
    }
    assert Counter(r["doc_id"] for r in lines.left_documents(docs).collect()) == {1: 1, None: 2, 6: 2}


def test_tied_rows_share_the_further_copies(spark):
    rows = [(None, TEXT, "a")] * 100 + [(1, TEXT, "b")] * 30 + [(i, TEXT, "b") for i in range(20)] + [(None, TEXT, None)] * 9
    found = mixing.mix(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert len(found) == len(rows)
    for source in ("a", "b", None):
        mine = [r for r in found if r["source"] == source]
        # All documents have seven words: what is taken can be within one of them of the target.
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 7
        assert {r["copies"] for r in mine} <= {0, 1, 2}
