"""Components of graphs of all shapes, at once and in turns, and links that are worked on once."""

from __future__ import annotations

import random

import pytest

from labelloom.llm import components as module
from labelloom.llm import jaccard
from labelloom.llm.components import components

from .test_near_groups import first_reached, near_copies


def least_nodes(links: list[tuple[int, int]]) -> dict[int, int]:
    label = {n: n for link in links for n in link}
    for a, b in links:
        low, high = sorted((label[a], label[b]))
        label = {n: low if v == high else v for n, v in label.items()}
    return label


def shapes() -> dict[str, list[tuple[int, int]]]:
    rng = random.Random(11)
    names = [rng.getrandbits(64) - 2**63 for _ in range(60)]
    return {
        "nothing": [],
        "loop": [(3, 3), (3, 4), (4, 3)],
        "star of the largest": [(99, i) for i in range(40)],
        "star of the least": [(i, -1) for i in range(40)],
        "path": list(zip(names, names[1:])),
        "comb": [link for i in range(20) for link in ((i, i + 1), (i + 1, 100 - i))],
        "cliques": [(i, j) for k in (0, 10, 20) for i in range(k, k + 6) for j in range(k, i)],
        "random": [(rng.randrange(80), rng.randrange(80)) for _ in range(55)],
    }


@pytest.mark.parametrize("shape", list(shapes()))
def test_components_of_shapes_at_once_and_in_turns(spark, shape):
    links = shapes()[shape]
    made = lambda part: spark.createDataFrame(part, "a long, b long")
    whole = least_nodes(links)
    assert {r["node"]: r["label"] for r in components(made(links)).collect()} == whole
    found = components(made(links[::3]))
    for start in (1, 2):
        found = module.joined(found, made(links[start::3]))
    rows = found.collect()
    assert len(rows) == len(whole) and {r["node"]: r["label"] for r in rows} == whole


def test_links_of_near_copies_are_worked_on_once(spark, monkeypatch):
    rows, worked_on, verified = near_copies(400, "replaced"), [], []
    for name in ("components", "joined"):
        if known := getattr(jaccard, name, None):

            def counted(*args, known=known):
                worked_on.append(args[-1].count())
                return known(*args)

            monkeypatch.setattr(jaccard, name, counted)
    made = jaccard._Corpus.verified

    def kept(self, *args):
        links = jaccard.cut(made(self, *args))
        verified.append(links.count())
        return links

    monkeypatch.setattr(jaccard._Corpus, "verified", kept)
    found = jaccard.component_ids(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == first_reached(rows)
    assert len(verified) > 1 and sum(worked_on) == sum(verified)
