"""Spelling variants against loops written from the definition."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from labelloom.llm import queries, spelling

SF = "/root/testdata/sf0.001"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def within_one_edit(a: str, b: str) -> bool:
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    counted = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(UPPER)
            h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if h % 199 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counted[word] += 1
    n = {w: c for w, c in counted.items() if len(w) >= 6 and c >= 5}
    met, near = defaultdict(set), defaultdict(set)
    for w in n:
        for key in {w, *(w[:i] + w[i + 1 :] for i in range(len(w))), *(f"{w[:i]}?{w[i + 1 :]}" for i in range(len(w)))}:
            met[key].add(w)
    for group in met.values():
        for a in group:
            near[a] |= {b for b in group if within_one_edit(a, b)}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= 5 * n[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n}


def found(docs):
    got = spelling.spelling_variants(docs).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len(got) == len({tuple(r) for r in got})
    return {tuple(r) for r in got}


def test_query_equals_loops(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    want = brute([tuple(r) for r in docs.collect()])
    got = {tuple(r) for r in queries.QUERIES["op11_spelling"](spark, SF).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    assert got == want and any(n for *_, n, _ in got) and any(f for _, f, *_ in got)


def test_odd_words(spark):
    long = "ab" * 300
    near_long = long[:299] + "é" + long[300:]
    words = ["letter"] * 140 + ["leter"] * 30 + ["lettter"] * 28 + ["letttter"] * 5 + ["letters"] * 6 + ["Letter", "LETTER", "lettér", "lettÉr", "lettÉr"]
    words += ["aaaaaa"] * 5 + ["aaaaaaa"] * 5 + ["aaaaaaaa"] * 30 + ["abcdef"] * 5 + ["bcdefg"] * 5 + ["straße"] * 5 + ["strasse"] * 25 + ["lettÉr"] * 5
    words += [long] * 5 + [near_long] * 5 + [long + "a"] * 5 + ["×÷×÷×÷"] * 5
    rows = [(i, "1 ".join(words[i::7]) + "\n-ỳ_ðþỳ") for i in range(7)] + [(None, None), (None, ""), (8, "  \t"), (9, "x"), (None, "letter letter"), (None, "letter letter")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit(1).alias(c) for c in ("word", "n", "node", "whole", "form", "char")])
    want = brute(rows)
    assert found(docs.repartition(3)) == want == found(docs.coalesce(1))
    near = {w: k for w, _, _, _, k, _ in want}
    assert near["aaaaaaa"] == 2 and near[long] == 2 and near["abcdef"] == 0
    assert spelling.spelling_variants(docs.limit(0)).count() == 0
    assert spelling.spelling_variants(docs.where("doc_id = 9")).count() == 0


@pytest.mark.parametrize("n", [1, 2, 5, 64])
def test_checksums_of_joined_strings(n):
    import numpy as np

    words = [b"a", b"abc", "é".encode() * n, b"z" * 60]
    keys = [b"1:", b"", b"-77:"]
    which = np.array([0, 1, 2, 3] * 3)
    texts = np.repeat([0, 1, 2], 4)
    lengths = np.array([len(w) for w in words])[which]
    of_word = np.array([zlib.crc32(w) for w in words], np.uint32)[which]
    got = spelling._checksums(texts, lengths, [zlib.crc32(k) for k in keys], of_word)
    assert got.tolist() == [zlib.crc32(keys[t] + words[w]) for t, w in zip(texts, which)]
