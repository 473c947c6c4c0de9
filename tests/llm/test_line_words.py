"""Words of lines: numbered without them, and compared only where a pair has met."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from labelloom.llm import lines


def bare_lines() -> list[tuple[int, str]]:
    """Many lines that share a first part and are far apart, and some within one word of an earlier one."""
    rng = random.Random(5)
    rows, texts = [], []
    for i in range(300):
        start = f"start{i % 20} of many lines"
        texts.append(start + "".join(f" w{rng.randrange(10**6)}" for _ in range(4)))
    for i in range(20):
        words = texts[i].split()
        words[i % len(words)] = "other"
        texts.append(" ".join(words))
    for i in range(0, len(texts), 4):
        rows.append((i, "\n".join(texts[i : i + 4])))
    return rows


def gone(rows: list[tuple[int, str]]) -> dict[int, list[int]]:
    earlier, found = [], {}
    for key, text in rows:
        for number, line in enumerate(text.split("\n")):
            words = line.split()
            if any(lines.within_one(words, other) for other in earlier):
                found.setdefault(key, []).append(number)
            earlier.append(words)
    return found


def test_words_are_not_numbered_and_only_those_of_pairs_are_compared(spark, monkeypatch):
    rows, numbered, stored = bare_lines(), [], []
    prefix_sums, cut = lines.prefix_sums, lines.cut

    def seen(df, *more):
        numbered.append(df.columns)
        return prefix_sums(df, *more)

    def kept(df):
        found = cut(df)
        if "words" in found.columns:
            stored.append(found.count())
        return found

    monkeypatch.setattr(lines, "prefix_sums", seen)
    monkeypatch.setattr(lines, "cut", kept)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = lines.removed_lines(docs).where("lines IS NOT NULL").select("key", "lines").collect()
    assert {r["key"]: r["lines"] for r in found} == gone(rows)
    assert numbered and not any("words" in columns for columns in numbered)
    # All lines share a part with another one; 20 pairs have 40 lines.
    assert stored == [320, 40]


def test_order_of_first_places_has_null_keys_last(spark):
    line = "one two three four five six seven"
    rows = [(None, line), (7, line.replace("two", "too")), (-3, line.replace("six", "sicks")), (9, line + " eight")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = lines.dedup_lines(docs).where(F.col("n_removed") == 0).select("doc_id").collect()
    # -3 is the first; 7 differs from it in two words and from the null row's in one.
    assert sorted(r["doc_id"] for r in left) == [-3, 7, 9]
