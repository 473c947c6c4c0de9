"""Groups of near copies, of which many are too far from the centre to link with it."""

from __future__ import annotations

import random

import pytest

from labelloom.llm import jaccard


def near_copies(n: int, kind: str) -> list[tuple[int, str]]:
    rng = random.Random(3)
    base = [f"w{rng.randrange(3000)}" for _ in range(120)]
    rows = []
    for i in range(n):
        words = []
        for w in base:
            if rng.random() >= 0.02:
                words.append(w)
            elif kind == "replaced":
                words.append(f"w{rng.randrange(3000)}")
        rows.append((i, " ".join(words)))
    return rows


def first_reached(rows: list[tuple[int, str]]) -> dict[int, int]:
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    least = {i: i for i in sets}
    for i in sets:
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) and least[i] != least[j]:
                low, high = sorted((least[i], least[j]))
                least = {k: low if v == high else v for k, v in least.items()}
    return least


@pytest.mark.parametrize("kind", ["replaced", "left out"])
def test_pairs_and_links_do_not_grow_with_the_square(spark, monkeypatch, kind):
    rows, counts = near_copies(400, kind), []
    verified = jaccard._Corpus.verified

    def counted(self, pairs, *more):
        links = jaccard.cut(verified(self, pairs, *more))
        counts.append((pairs.count(), links.count()))
        return links

    monkeypatch.setattr(jaccard._Corpus, "verified", counted)
    found = jaccard.component_ids(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == first_reached(rows)
    pairs, links = (sum(c) for c in zip(*counts))
    assert pairs <= jaccard.PAIRS_AT_ONCE * len(rows)
    assert links <= 8 * len(rows)
