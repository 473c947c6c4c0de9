import hashlib
import itertools
import math
import random
from collections import Counter

import pytest

from labelloom.functions.labels import with_label_names
from labelloom.operators import positions
from labelloom.operators import disjoint_draws as DD
from labelloom.operators import row_pairs as R

NAMES = ["O", "B-x", "I-x", "B-y", "z"]
ROWS = [
    (3, ["a", "b"], [1, 2]),
    (1, ["c"], [0]),
    (7, ["d", "e", "f"], [1, 0, 3]),
    (4, ["g", "h"], [4, 2]),
    (9, [], []),
    (5, ["i", "j"], [3, 0]),
]


def names_of(tags):
    return [NAMES[t] for t in tags]


def entities(tags):
    return sorted(n.replace("B-", "").replace("I-", "") for n in set(names_of(tags)) - {"O"})


def brute_rows(rows):
    """The sequence of row pairs and their entity pairs, by loops."""
    out = []
    for (_, t1, g1), (_, t2, g2) in itertools.combinations(sorted(rows), 2):
        s1, s2 = " ".join(t1), " ".join(t2)
        same = any(a == b != 0 for a, b in zip(g1, g2))
        out.append((s1, s2, "similar" if same else "not_similar"))
        out += [(s1, e, "similar") for e in entities(g1)]
        out += [(s2, e, "similar") for e in entities(g2)]
    return out


def brute_pairs(pairs):
    return [
        (p[0], q[1], "not_similar") for p, q in itertools.combinations(pairs, 2) if not p[2] == q[2] == "similar"
    ]


def bag(df):
    return Counter((r.sentence1, r.sentence2, r.label) for r in df.collect())


@pytest.fixture
def rows(spark):
    return with_label_names(
        spark.createDataFrame(ROWS, "document_id int, tokens array<string>, ner_tags array<int>"), "ner_tags", NAMES
    )


@pytest.fixture(params=["broadcast", "shuffled"])
def path(request, monkeypatch):
    if request.param == "shuffled":
        monkeypatch.setattr(positions, "BROADCAST_BYTES", -1)
        monkeypatch.setattr(R, "USES_PER_SLOT", 2)


@pytest.mark.parametrize("n", range(0, 40, 3))
def test_anchor_closed_form(n):
    for q, (i, j) in enumerate(itertools.combinations(range(n), 2)):
        anchor, start = R._anchor(q, n)
        assert (anchor, q - start) == (i, j - i - 1)


def test_anchor_of_a_huge_table():
    n = 10**11
    for q in (0, n - 2, n - 1, n * (n - 1) // 2 - 1):
        i, start = R._anchor(q, n)
        assert start <= q < start + n - 1 - i
    assert R._anchor(n * (n - 1) // 2 - 1, n)[0] == n - 2


def test_whole_row_pairs(rows, path):
    got = bag(R.row_pairs(rows, "document_id", 0, 100))
    want = Counter(p for p in brute_rows(ROWS) if p[1] in {" ".join(t) for _, t, _ in ROWS})
    assert sum(got.values()) == 15
    assert got == want


@pytest.mark.parametrize("size", [4])
def test_pages_make_up_the_whole(rows, path, size):
    total = Counter()
    for first in range(0, 15, size):
        page = R.row_pairs(rows, "document_id", first, size)
        got = bag(page)
        assert sum(got.values()) == min(size, 15 - first)
        total += got
    assert total == bag(R.row_pairs(rows, "document_id", 0, 15))
    assert R.row_pairs(rows, "document_id", 15, 5).count() == 0
    with pytest.raises(ValueError):
        R.row_pairs(rows, "document_id", -1, 5)


def test_row_pairs_with_entities(rows, path):
    got = R.row_pairs_with_entities(rows, "document_id", 0, 100)
    assert bag(got) == Counter(brute_rows(ROWS))
    ordered = sorted(got.collect(), key=lambda r: (r.i, r.j, r.block, r.nth))
    assert [(r.sentence1, r.sentence2, r.label) for r in ordered] == brute_rows(ROWS)


def test_entity_pair_copies_count_the_whole(rows):
    sentences = {" ".join(t) for _, t, _ in ROWS}
    got = Counter()
    for r in R.entity_pair_copies(rows, "document_id").collect():
        got[(r.sentence1, r.sentence2, r.label)] += r.n_copies
    assert got == Counter(p for p in brute_rows(ROWS) if p[1] not in sentences)
    assert R.entity_pair_copies(rows.where("document_id = 3"), "document_id").count() == 0


def test_pairs_of_pairs(spark, path):
    pairs = [(k, f"s{k}", f"t{k}", "similar" if k % 3 else "not_similar") for k in range(9)]
    df = spark.createDataFrame(pairs, "k int, sentence1 string, sentence2 string, label string")
    want = Counter(brute_pairs([p[1:] for p in pairs]))
    assert bag(R.dissimilar_from_pairs(df, "k", 0, 1000)) == want
    pages = Counter()
    for first in range(0, 36, 13):
        pages += bag(R.dissimilar_from_pairs(df, "k", first, 13))
    assert pages == want


def test_all_row_pairs(rows):
    some = [r for r in ROWS if r[0] in (3, 1, 7, 4)]
    made = brute_rows(some)
    got = bag(R.all_row_pairs(rows.where("document_id in (3, 1, 7, 4)"), "document_id", (0, 100), (0, 100_000)))
    assert got == Counter(made) + Counter(brute_pairs(made))
    p, s = len(made), sum(m[2] == "similar" for m in made)
    assert sum(got.values()) - p == p * (p - 1) // 2 - s * (s - 1) // 2


def near(n, k):
    return [(i, j) for i, j in itertools.combinations(range(n), 2) if j - i <= k]


@pytest.mark.parametrize("k", [1, 2, 5, 50])
def test_next_rows(rows, path, k):
    made, ordered = [], sorted(ROWS)
    for i, j in near(len(ROWS), k):
        made += brute_rows([ordered[i], ordered[j]])
    got = R.row_pairs_with_entities(rows, "document_id", partners=k)
    assert bag(got) == Counter(made)
    pairs = {(r.i, r.j) for r in got.collect()}
    # Every row takes part, and enough partners make the whole.
    assert pairs == set(near(len(ROWS), k)) and {x for p in pairs for x in p} == set(range(len(ROWS)))
    sentences = {" ".join(t) for _, t, _ in ROWS}
    want = Counter(m for m in made if m[1] in sentences)
    for df in (rows.repartition(1), rows.repartition(7)):
        assert bag(R.row_pairs(df, "document_id", partners=k)) == want
    if k >= len(ROWS) - 1:
        assert want == bag(R.row_pairs(rows, "document_id", 0, 100))


def test_next_pairs_of_pairs(spark, rows, path):
    pairs = [(k, f"s{k}", f"t{k}", "similar" if k % 3 else "not_similar") for k in range(9)]
    df = spark.createDataFrame(pairs, "k int, sentence1 string, sentence2 string, label string")
    want = Counter(m for i, j in near(9, 2) for m in brute_pairs([pairs[i][1:], pairs[j][1:]]))
    assert bag(R.dissimilar_from_pairs(df, "k", partners=2)) == want
    ordered = sorted(ROWS)
    made = [m for i, j in near(len(ROWS), 2) for m in brute_rows([ordered[i], ordered[j]])]
    more = Counter(m for i, j in near(len(made), 2) for m in brute_pairs([made[i], made[j]]))
    assert bag(R.all_row_pairs(rows, "document_id", partners=2)) == Counter(made) + more


def test_next_rows_of_few_or_bad_rows(spark, rows):
    for few in (rows.limit(0), rows.where("document_id = 3")):
        assert R.row_pairs(few, "document_id", partners=2, names=NAMES).count() == 0
    with pytest.raises(ValueError):
        R.row_pairs(rows, "document_id", partners=0)
    with pytest.raises(ValueError):
        R.row_pairs(rows, "document_id")
    with pytest.raises(ValueError):
        R.row_pairs(rows, "document_id", 0, 5, partners=2)


def drawn_pairs(rows, n, seed=42):
    """The n draws by hand: rows are (key, sentence, set of tags)."""
    sets = {}
    for key, said, tags in sorted(rows):
        sets.setdefault(",".join(str(t) for t in sorted(tags)), []).append(said)
    names = sorted(sets)
    pairs = []
    for a in names:
        block = []
        for b in names:
            if not set(filter(None, a.split(","))) & set(filter(None, b.split(","))):
                block += [(j, b) for j in range(len(sets[b]) - (a == b))]
        # By partner first, then by row.
        for j, b in block:
            pairs += [(sets[a][i], sets[b][j + (a == b and j >= i)]) for i in range(len(sets[a]))]
    found = []
    for c in range(n):
        x = int(hashlib.md5(f"{seed}|p|{c}".encode()).hexdigest()[:15], 16) * len(pairs) >> 60
        found.append((*pairs[x], "not_similar"))
    return found, pairs


def plain_rows(table):
    return [(r[0], " ".join(r[1]), set(r[2]) - {0}) for r in table]


def test_random_dissimilar_pairs(rows, path):
    want, pairs = drawn_pairs(plain_rows(ROWS), 25)
    # Every ordered pair of different rows without a common tag, once.
    tagged = plain_rows(ROWS)
    assert Counter(pairs) == Counter((a[1], b[1]) for a in tagged for b in tagged if a[0] != b[0] and not a[2] & b[2])
    for df in (rows, rows.repartition(5)):
        assert bag(R.random_dissimilar_pairs(df, 25, "document_id")) == Counter(want)


def test_one_tag_on_almost_every_row(spark, rows):
    """999 of 1,000 rows share a tag: each of 3,000 draws is found, and none is drawn in vain."""
    table = [(i, [f"w{i}"], [2 if i == 500 else 1]) for i in range(1000)]
    df = spark.createDataFrame(table, rows.schema).repartition(3)
    got = R.random_dissimilar_pairs(df, 3000, "document_id", NAMES).collect()
    assert len(got) == 3000 and all((r.sentence1 == "w500") != (r.sentence2 == "w500") for r in got)
    firsts = sum(r.sentence1 == "w500" for r in got)
    assert 1350 < firsts < 1650 and len({(r.sentence1, r.sentence2) for r in got}) > 1200
    assert bag(spark.createDataFrame(got)) == Counter(drawn_pairs(plain_rows(table), 3000)[0])


def test_draws_over_many_cells(spark, monkeypatch):
    monkeypatch.setattr(DD, "SETS_PER_BLOCK", 3)
    monkeypatch.setattr(DD, "DRAWS_PER_GROUP", 100)
    rng = random.Random(5)
    sets = [",".join(map(str, sorted(rng.sample(range(1, 7), rng.randrange(0, 4))))) for _ in range(60)]
    positions, seen = [], Counter()
    for s in sets:
        positions.append((s, seen[s]))
        seen[s] += 1
    assert len(seen) > 10
    df = spark.createDataFrame(positions, "set string, idx long")
    got = DD.disjoint_draws(df, 4000, 1).collect()
    tags = {s: set(filter(None, s.split(","))) for s in seen}
    allowed = {(a, b) for a in positions for b in positions if a != b and not tags[a[0]] & tags[b[0]]}
    drawn = Counter(((r.a_set, r.a_idx), (r.b_set, r.b_idx)) for r in got)
    assert sorted(r.c for r in got) == list(range(4000)) and set(drawn) <= allowed
    # Evenly over the pairs: each comes about 4000 / n times.
    assert len(drawn) > 0.8 * min(len(allowed), 4000) and max(drawn.values()) < 12 + 4 * 4000 / len(allowed)


def test_random_dissimilar_pairs_fail_loudly(spark, rows):
    same = spark.createDataFrame([(i, ["a"], [1]) for i in range(4)], rows.schema)
    with pytest.raises(ValueError, match="common tag"):
        R.random_dissimilar_pairs(same, 3, "document_id", NAMES)
    with pytest.raises(ValueError, match="common tag"):
        R.random_dissimilar_pairs(rows.where("document_id = 3"), 1, "document_id")
    assert R.random_dissimilar_pairs(same, 0, "document_id", NAMES).count() == 0


def test_rows_without_tags_share_nothing(spark, rows):
    df = spark.createDataFrame([(1, ["a"], [1]), (2, ["b"], None), (3, ["c"], []), (4, ["d"], [0])], rows.schema)
    got = {(r.sentence1, r.sentence2) for r in R.random_dissimilar_pairs(df, 400, "document_id", NAMES).collect()}
    assert got == {(x, y) for x in "abcd" for y in "abcd" if x != y}


@pytest.mark.parametrize("seed", range(6))
def test_counted_pairs_of_pairs(spark, seed):
    """The whole bag, counted by sentence, against the loops; ten inputs for each seed in one table."""
    rng = random.Random(seed)
    for _ in range(2):
        n = rng.randrange(0, 30)
        table = [(i * 3, rng.choice("abcdef"), rng.choice("uvwxyz"), rng.choice(["similar", "similar", "not_similar", "dissimilar", None])) for i in range(n)]
        df = spark.createDataFrame(table, "k int, sentence1 string, sentence2 string, label string").repartition(3)
        want = Counter()
        for p, q in itertools.combinations(table, 2):
            if not (p[3] == q[3] == "similar"):
                want["first", p[1]] += 1
                want["second", q[2]] += 1
        got = {(r.side, r.sentence): r.n_pairs for r in R.dissimilar_pair_counts(df, "k", tasks=4).collect()}
        assert got == dict(want)
        similar = sum(r[3] == "similar" for r in table)
        assert sum(v for (side, _), v in got.items() if side == "first") == math.comb(n, 2) - math.comb(similar, 2)


def test_no_cross_join(rows, path):
    plan = R.row_pairs(rows, "document_id", 2, 6)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
