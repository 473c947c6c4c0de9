"""Benchmark windows in documents against loops written from the definition."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from labelloom.llm import decontaminate

SCHEMA = "doc_id long, text string"
ITEMS = "item_id long, text string"


def words_of(text):
    return re.findall(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").encode().lower())


def brute(docs, items):
    windows = []
    for item, text in items:
        w = words_of(text)
        n = min(10, len(w))
        windows += [(item, w[i : i + n]) for i in range(len(w) - n + 1) if n]
    found = Counter()
    for key, text in docs:
        w, hit, ids = words_of(text), set(), set()
        for item, x in windows:
            for i in range(len(w) - len(x) + 1):
                if w[i : i + len(x)] == x:
                    hit |= set(range(i, i + len(x)))
                    ids.add(item)
        named = sorted(str(x) for x in ids if x is not None)
        found[(key, len(w), len(hit), len(named), hashlib.sha256(",".join(named).encode()).hexdigest(), bool(hit))] += 1
    return found


def got(docs, items):
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return Counter(tuple(r) for r in decontaminate.contamination(docs, items).select(*columns).collect())


def test_random_texts(spark):
    rng = np.random.default_rng(8)
    items = [(i, " ".join(f"w{x}" for x in rng.integers(0, 30, n))) for i, n in enumerate((1, 2, 3, 4, 5, 6, 9, 10, 11, 14, 30, 31))]
    items += [(50, items[10][1]), (51, items[10][1] + " more"), (7, "seven is here twice")]
    docs = []
    for i in range(60):
        parts = []
        for _ in range(int(rng.integers(0, 5))):
            w = items[rng.integers(0, len(items))][1].split(" ")
            a = int(rng.integers(0, max(1, len(w) - 10)))
            parts += [*w[a : a + int(rng.integers(8, 25))], *(f"W{x}" for x in rng.integers(0, 30, 3))]
        docs.append((i, ", ".join(parts) if i % 2 else " \n".join(parts).upper()))
    d, b = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, ITEMS)
    want = brute(docs, items)
    assert got(d.repartition(3), b) == want == got(d.coalesce(1), b.repartition(2))
    assert sum(n for (*_, hit), n in want.items() if hit) > 20


def test_odd_rows(spark):
    line = "Zwölf Boxkämpfer jagen Viktor quer über den großen Sylter Deich und 12 weitere."
    items = [(1, line), (None, "nobody owns this one"), (2, None), (3, ""), (4, " -- "), (10, line), (9, "a a a a a a a a a a a"), (9, "x"), (9, "x")]
    long = " ".join(f"word{i % 997}" for i in range(20_000))
    docs = [(1, None), (2, ""), (3, "... \n"), (4, "a"), (5, " ".join("a" * 40)), (6, f"{long} {line} {long}"), (None, line.replace(" ", "--")), (None, line)]
    docs += [(7, "nobody owns this one, x"), (7, "nobody owns this one, x"), (8, line[:40]), (8, "x" * 100_000), (9, "x_y X y x ")]
    extra = ["row", "spans", "items", "hits", "wid", "n", "id", "window", "item_id"]
    d = spark.createDataFrame(docs, SCHEMA).select("*", *[F.lit(1).alias(c) for c in extra])
    b = spark.createDataFrame(items, ITEMS).select("*", *[F.lit(1).alias(c) for c in extra if c != "item_id"])
    assert got(d, b) == brute(docs, items)
    spans = {r["id"]: r["spans"] for r in decontaminate.contaminated_spans(d, b).where("id IN (6, 7)").collect()}
    assert [tuple(s) for s in spans[6]] == [(20_000, 20_013)] and [tuple(s) for s in spans[7]] == [(0, 5)]
    assert got(d, b.limit(0)) == brute(docs, []) and got(d.limit(0), b) == Counter()


def test_one_passage_in_very_many_documents(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = spark.range(6000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.concat(F.lit("own"), F.col("id"), F.lit(" " + passage)).alias("text"))
    items = spark.createDataFrame([(i, passage) for i in range(40)] + [(100, "p0 p1 p2")], ITEMS)
    found = decontaminate.contamination(rows, items).groupBy("n_words", "n_hit", "n_items").count().collect()
    assert [tuple(r) for r in found] == [(61, 60, 41, 6000)]
