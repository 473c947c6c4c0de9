"""Every corpus operator against loops written from its definition, and on rows that are out of the ordinary."""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from labelloom.llm import chat, jaccard, lines, mixing, packing, pii, quality, queries, sharding, topk, url_rules
from labelloom.llm.components import components
from labelloom.llm.shingles import Hasher, text_sets

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 997}" for i in range(20_000))
ODD = [
    (1, None, "a"),
    (2, "", "a"),
    (3, "one two three four five six seven", None),
    (4, "one two three four five six seven", "b"),
    (4, "one two three four five six seven", "b"),
    (None, "of the one and the other is in that house", "b"),
    (None, None, None),
    (5, LONG, "a"),
    (6, "  \n\t \n", "a"),
    (7, "x", "c"),
]
SCHEMA = "doc_id long, text string, source string"
EXTRA = {"size": 1, "host": "h", "n_words": 2, "copies": 3, "rank": 4, "shard": 5, "label": 6, "id": 7, "key": 8, "n": 9, "first": 10, "h1": 11}


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ODD, SCHEMA)
    return df.select("*", *[F.lit(v).alias(c) for c, v in EXTRA.items()])


@pytest.fixture(scope="module")
def sample(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.sql(queries.ORACLES[name])
    got = queries.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert Counter(tuple(r[c] for c in columns) for r in got.collect()) == Counter(want.select(*columns).fetchall())


def test_every_query_has_the_contract_columns(spark):
    wanted = {
        "op1_mixing": "doc_id size source_size target taken",
        "op2_url_rules": "page_id host path rule verdict",
        "op8_sharding": "doc_id size text_crc32 law shard slot grown_shard",
        "op10_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    }
    for name, columns in wanted.items():
        assert set(columns.split()) <= set(queries.QUERIES[name](spark, SF).columns)


def test_quality_of_odd_rows(odd):
    found = quality.judge_quality(odd)
    assert found.count() == len(ODD)
    by_id = {r["doc_id"]: r for r in found.collect()}
    assert by_id[1]["n_words"] == by_id[2]["n_words"] == by_id[6]["n_words"] == 0
    assert by_id[5]["n_words"] == 20_000 and by_id[5]["n_repeat_words"] == 20_000
    assert [r["doc_id"] for r in quality.keep_good(odd).collect()] == []
    assert quality.keep_good(odd).columns == odd.columns


def test_quality_repeated_windows_are_exact(spark):
    rows = [(i, t) for i, t in enumerate(["a b c a b c", "a b a b a b", "a b c d", "a a a a", "a b c x a b c y b c y"])]
    got = {r["doc_id"]: r["n_repeat_words"] for r in quality.judge_quality(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        w = t.split()
        grams = Counter(tuple(w[j : j + 3]) for j in range(len(w) - 2))
        covered = {j + d for j in range(len(w) - 2) if grams[tuple(w[j : j + 3])] > 1 for d in range(3)}
        assert got[i] == len(covered)


@pytest.mark.parametrize(
    "url, host, path, rule, verdict",
    [
        (None, "", "", None, "allow"),
        ("no scheme/en/", "", "", None, "allow"),
        ("https://EXAMPLE.com/en/1?x#y", "example.com", "/en/1", "example.com/en/", "block"),
        ("https://www.example.com/en/1", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
        ("https://a.example.com/en/", "a.example.com", "/en/", "example.com/en/", "block"),
        ("https://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
        ("https://example.com", "example.com", "", None, "allow"),
        ("http://x.net/es/?q", "x.net", "/es/", "net/es/", "block"),
        ("http://x.net/ES/", "x.net", "/ES/", None, "allow"),
        ("http://x.org/login", "x.org", "/login", None, "block"),
        ("a://b://c.com/d", "b:", "//c.com/d", None, "allow"),
    ],
)
def test_url_rules(spark, url, host, path, rule, verdict):
    df = spark.createDataFrame([(1, url, "taken")], "page_id long, url string, host string")
    (row,) = url_rules.judge_urls(df).collect()
    assert (row["host"], row["path"], row["rule"], row["verdict"]) == (host, path, rule, verdict)


def test_url_rules_without_rules_or_rows(spark, odd):
    df = spark.createDataFrame([(1, "http://a.com/x")], "page_id long, url string")
    assert url_rules.judge_urls(df, rules=()).first()["verdict"] == "allow"
    assert url_rules.judge_urls(df.limit(0)).count() == 0
    assert url_rules.whole_tokens("||example.com/en/") == ["com", "en", "example"]
    assert url_rules.whole_tokens("/half*way^") == []


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        open_weight = sum(weight[s] for s in sizes if s not in full)
        level = (total - sum(2 * sizes[s] for s in full)) / open_weight if open_weight else 0
        more = {s for s in sizes if s not in full and level * weight[s] > 2 * sizes[s]}
        if not more:
            return {s: 2.0 * sizes[s] if s in full else level * weight[s] for s in sizes}
        full |= more


def test_mixing_targets_and_taken(sample):
    rows = mixing.mix(sample).collect()
    sizes, taken = Counter(), Counter()
    for r in rows:
        assert r["size"] == len(words_of(r["text"])) and r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
    wanted = brute_targets(dict(sizes))
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(wanted[r["source"]])
    longest = max(r["size"] for r in rows)
    assert all(abs(taken[s] - wanted[s]) <= longest for s in sizes)
    # Rates of open sources are exp(tilt * size), so their logarithms follow the sizes.
    by_source = defaultdict(list)
    for r in rows:
        if r["size"] and r["rate"] < 2:
            by_source[r["source"]].append((np.log(r["rate"]) / r["size"]))
    assert all(np.ptp(v) < 1e-9 for v in by_source.values())
    again = Counter((r["doc_id"], r["copies"]) for r in mixing.mix(sample.repartition(5)).collect())
    assert again == Counter((r["doc_id"], r["copies"]) for r in rows)


def test_mixing_odd_rows(odd):
    assert mixing.mix(odd).count() == len(ODD)
    assert mixing.mix(odd.limit(0)).count() == 0
    assert mixing.mixed_rows(odd).columns == odd.columns


def test_pii_round_trip_and_links(spark, sample):
    rows = [
        (1, "mail me@mail7.example.com or 97.51.17.173, card 4417744280351547 and 4417-7442-8035-1547"),
        (2, '+1 (017) 555-7713, 2024-02-29, 31.12.1999, 078-05-1120, token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"'),
        (3, "me@mail7.example.com again"),
        (4, "no number: 4417744280351548, 2023-02-30, 999.1.1.1, 12345"),
        (5, None),
        (6, ""),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    made = pii.pseudonymize(df, key="k")
    got = {r["doc_id"]: r for r in made.collect()}
    for value in ("me@mail7", "97.51.17.173", "4417744280351547", "555-7713", "2024-02-29", "31.12.1999", "078-05-1120", "04dbebab91"):
        assert all(value not in (r["text"] or "") for i, r in got.items() if i != 4)
    assert got[4]["text"] == rows[3][1] and got[4]["n_values"] == 0
    assert got[5]["text"] is None and got[6]["text"] == ""
    assert got[3]["text"].split("@")[0] == got[1]["text"].split(" ")[1].split("@")[0]
    cards = re.findall(r"card (\S+) and (\S+)", got[1]["text"])[0]
    assert cards[0] == cards[1].replace("-", "")
    back = pii.pseudonymize(made.drop("n_values", "kinds"), key="k", inverse=True)
    assert {r["doc_id"]: r["text"] for r in back.collect()} == dict(rows)
    assert got[1]["text"] != pii.pseudonymize(df, key="other").where("doc_id = 1").first()["text"]
    restored = pii.pseudonymize(pii.pseudonymize(sample).drop("n_values", "kinds"), inverse=True)
    assert Counter(texts(restored)) == Counter(texts(sample))


def test_pii_keeps_long_and_odd_texts(odd):
    assert Counter(texts(pii.pseudonymize(odd))) == Counter(texts(odd))


def brute_components(rows):
    sets = []
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets.append((i, frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()))
    label = [i for i, _ in sets]
    changed = True
    while changed:
        changed = False
        for x, (_, a) in enumerate(sets):
            for y, (_, b) in enumerate(sets):
                if a and b and 100 * len(a & b) >= 80 * len(a | b) and label[y] < label[x]:
                    label[x], changed = label[y], True
    return Counter((i, len(s), k) for (i, s), k in zip(sets, label))


def test_jaccard_join_by_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = []
    for g in range(12):
        base = [f"w{x}" for x in rng.integers(0, 400, 60 + 10 * g)]
        for _ in range(6):
            copy = list(base)
            for at in rng.integers(0, len(copy), rng.integers(0, 4)):
                copy[at] = f"W{rng.integers(0, 400)}"
            rows.append((int(rng.integers(0, 10**9)), " ".join(copy)))
    shared = " ".join(f"shared{i}" for i in range(55))
    rows += [(10**9 + i, shared + " " + " ".join(f"own{i}x{j}" for j in range(i % 7))) for i in range(80)]
    rows += [(5, "a b"), (6, "A  B"), (7, ""), (8, None), (9, "a b c")]
    got = jaccard.component_ids(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert Counter(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()) == brute_components(rows)


def test_jaccard_odd_rows(odd):
    found = jaccard.component_ids(odd)
    assert found.count() == len(ODD)
    assert {r["component_id"] for r in found.where("doc_id IN (3, 4)").collect()} == {3}
    kept = jaccard.first_documents(odd)
    assert kept.columns == odd.columns and kept.where("doc_id = 4").count() == 0 and kept.count() == len(ODD) - 2
    assert jaccard.component_ids(odd.limit(0)).count() == 0


def test_prefix_tree_finds_all_links():
    rng = np.random.default_rng(1)
    base = [np.sort(rng.choice(2000, 100, replace=False)).astype(np.uint64) for _ in range(5)]
    sets = [np.unique(np.concatenate([b[rng.random(100) > 0.06], rng.choice(2000, 3).astype(np.uint64)])) for b in base for _ in range(12)]
    tree = jaccard.PrefixTree()
    for i, s in enumerate(sets):
        tree.add(i, s)
    for i, s in enumerate(sets):
        want = {j: len(np.intersect1d(s, t)) for j, t in enumerate(sets)}
        want = {j: o for j, o in want.items() if 5 * o >= 4 * (len(s) + len(sets[j]) - o)}
        assert dict(tree.links(s)) == want


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    assert {r["node"]: r["label"] for r in components(links).collect()} == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}


def test_shingles_ignore_case_and_white_space():
    import pyarrow as pa

    a, b, c, d = text_sets(pa.array(["The cat sat on a mat", " the\tCAT\nsat on  a mat ", "É cat sat on a mat", "é cat sat on a mat"]), Hasher())
    assert list(a) == list(b) and len(a) == 2 and list(c) != list(d)


def brute_lines(rows):
    seen, order = {}, []
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        for at, line in enumerate((text or "").split("\n")):
            w = tuple(lines.words_of(line))
            if w:
                order.append((w, i, at))
                seen.setdefault(w, (i is None, i, at))
    long = [w for w in seen if len(w) >= 3]
    near = {w for w in long for v in long if seen[v] < seen[w] and lines.within_one(list(v), list(w))}
    gone = defaultdict(set)
    for w, i, at in order:
        if w in near or seen[w] != (i is None, i, at):
            gone[i].add(at)
    return {i: "\n".join(x for at, x in enumerate(t.split("\n")) if at not in gone[i]) if t is not None else None for i, t in rows}


def test_line_dedup_by_brute_force(spark):
    rng = np.random.default_rng(5)
    pool = [" ".join(f"w{x}" for x in rng.integers(0, 50, n)) for n in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 16, 31, 64)]
    rows = []
    for i in range(60):
        own = []
        for _ in range(6):
            w = pool[rng.integers(0, len(pool))].split()
            if (kind := rng.integers(0, 4)) == 1:
                w[rng.integers(0, len(w))] = f"W{rng.integers(0, 50)}"
            elif kind == 2:
                w.insert(int(rng.integers(0, len(w) + 1)), "more")
            elif kind == 3:
                del w[int(rng.integers(0, len(w)))]
            own.append(" ".join(w))
        rows.append((i, "\n".join([*own, "", "yes"])))
    rows += [(90, None), (91, ""), (None, pool[4]), (92, "A\tb\x0bc d\r\na b  c\n\n a  B c d"), (93, "é ü ß\né Ü ß\nÉ ü ß")]
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert dict(texts(got)) == brute_lines(rows)


def test_line_dedup_odd_rows(odd):
    found = lines.dedup_lines(odd)
    assert found.count() == len(ODD) and "host" in found.columns
    assert lines.left_documents(odd).columns == odd.columns
    assert lines.dedup_lines(odd.limit(0)).count() == 0


def test_shards_are_contiguous_and_balanced(spark, sample, odd, tmp_path):
    rows = sharding.shard_plan(sample, 8).orderBy("key").collect()
    assert [r["shard"] for r in rows] == sorted(r["shard"] for r in rows)
    size, slots = Counter(), defaultdict(list)
    text = dict(texts(sample))
    for r in rows:
        assert r["size"] == len(text[r["key"]].encode()) + 16 and r["text_crc32"] == zlib.crc32(text[r["key"]].encode())
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    longest = max(r["size"] for r in rows)
    assert all(abs(b - sum(size.values()) / 8) <= longest for b in size.values())
    assert all(s == list(range(len(s))) for s in slots.values())
    assert sharding.shard_plan(odd, 3).count() == len(ODD) and sharding.shard_plan(odd.limit(0), 3).count() == 0
    sharding.write_shards(sample, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter(texts(back)) == Counter(texts(sample)) and back.select("shard").distinct().count() == 4


def test_top_k_by_brute_force(spark):
    rng = np.random.default_rng(2)
    vectors = rng.normal(0, 0.3, (300, 8)).round(2).tolist()
    rows = [(i, v, 0) for i, v in enumerate(vectors)] + [(300, vectors[7], 0), (301, None, 0), (302, [None] * 8, 0), (303, [float("nan")] * 8, 0), (None, vectors[0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    whole = {i: [int(np.floor(float(np.float32(x)) * 256)) for x in v] for i, v, _ in rows[:301]}
    want = []
    for q in range(0, 301, 50):
        scored = sorted((-sum(a * b for a, b in zip(whole[q], w)), i) for i, w in whole.items() if i != q)
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:5])]
    assert sorted(tuple(r) for r in topk.top_k(df).collect()) == want
    assert topk.top_k(df.limit(0)).count() == 0
    assert topk.top_k(df.where("vec_id IN (0, 3)")).count() == 1


def test_top_k_of_repeated_ids_and_large_numbers(spark):
    rows = [(1, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.5, 0.5]), (50, [1.0, 1.0]), (50, [1.0, 1.0]), (100, [-1e30, 1e30]), (0, [3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select("*", *[F.lit(1).alias(c) for c in ("row", "v", "d", "block", "cell")])
    whole = [(i, [int(np.floor(x * 256)) for x in v] + [0] * (2 - len(v))) for i, v in rows]
    want = Counter()
    for at, (q, v) in enumerate(whole):
        if q % 50 == 0:
            scored = sorted((-max(min(sum(a * b for a, b in zip(v, w)), 2**63 - 1), -(2**63)), i) for j, (i, w) in enumerate(whole) if j != at)[:5]
            want.update((q, r + 1, i, -s) for r, (s, i) in enumerate(scored))
    assert Counter(tuple(r) for r in topk.top_k(df).collect()) == want == Counter(tuple(r) for r in topk.top_k(df.repartition(4)).collect())
    assert want[(50, 2, 1, 131072)] == 2


def test_top_k_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 20)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk, "STEP", 4)
    rng = np.random.default_rng(9)
    vectors = np.concatenate([rng.normal(c, 0.2, (150, 6)) for c in (0, 2, -2)]).round(1)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    whole = np.floor(256 * vectors).astype(int)
    want = []
    for q in range(0, 450, 10):
        scored = sorted((-int(whole[q] @ w), i) for i, w in enumerate(whole) if i != q)[:5]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    assert sorted(tuple(r) for r in topk.top_k(df.repartition(3), every=10).collect()) == want


def test_top_k_leaves_candidates_and_blocks_out():
    import pyarrow as pa

    rng = np.random.default_rng(4)
    points = np.floor(np.concatenate([rng.normal(c, 5, (200, 16)) for c in (0, 300, -300, 600)]))
    pivots = topk.choose_pivots(points, 16)
    distances = np.sqrt(((points[:, None] - pivots[None]) ** 2).sum(2))

    def side(rows):
        columns = {"row": rows, "id": rows, "v": points[rows].tolist(), "norm": (points[rows] ** 2).sum(1), "d": distances[rows].tolist()}
        return topk.Side(pa.table(columns), 16)

    found, evaluated = topk.search_block(side([799]), side(np.arange(800)), np.array([-np.inf]), 5)
    assert evaluated < 400
    scores = points @ points[-1]
    want = sorted((-s, i) for i, s in enumerate(scores) if i != 799)[:5]
    assert found == [(799, 799, i, int(-s)) for s, i in want]
    quarters = distances.reshape(4, 200, -1)
    largest = (points**2).sum(1).reshape(4, 200).max(1)
    bounds = topk.block_bounds((points[-1:] ** 2).sum(1), distances[-1:], quarters.min(1), quarters.max(1), largest)[0]
    assert all(bounds[b] >= scores[200 * b : 200 * b + 200].max() for b in range(4)) and (bounds < -want[-1][0]).sum() >= 2


def test_chat_round_trip(spark):
    control = "<|im_end|><|im_start|>assistant ok"
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", control), (1, 2, "user", "<\\|x|> \\ <\\\\| é😀"),
        (2, 0, "user", "hi"), (2, 1, "assistant", control), (2, 2, "user", "other"),
        (3, 0, "user", "hi"), (3, 1, "assistant", control), (3, 2, "user", "<\\|x|> \\ <\\\\| é😀"),
        (4, 0, "user", "hi"), (5, 0, None, None), (6, 1, "assistant", ""), (6, 0, "a\nb\\n<|", "x\n"), (None, 0, "user", "hi"),
    ]
    turns = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, depth int")
    chains, readings = chat.prefix_tree(turns)
    got = {r["conv_id"]: r for r in chat.read_back(chains, readings).collect()}
    for conv in {r[0] for r in rows}:
        mine = sorted((t, r or "", x or "") for c, t, r, x in rows if c == conv)
        said = "".join(f"{r}\n{x}\n" for _, r, x in mine)
        learned = "".join(x for _, r, x in mine if r == "assistant")
        want = (len(mine), hashlib.sha256(said.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())
        assert tuple(got[conv])[1:5] == want
        assert got[conv]["formatted_chars"] == sum(len(chat.segment(r, x)[0]) for _, r, x in mine)
    emitted = {r["chain"]["id"]: r for r in chains.collect()}
    # Equal turns are emitted once: 3 repeats 1, and 4 is its beginning.
    assert set(emitted) == {1, 2, 5, 6}
    assert emitted[2]["ancestors"][0]["start"] == emitted[1]["start"]
    assert emitted[2]["position"] == emitted[2]["ancestors"][0]["end"] - emitted[2]["ancestors"][0]["start"]
    assert emitted[2]["start"] == emitted[1]["start"] + emitted[1]["length"]
    spans = sorted((r["start"], r["length"]) for r in emitted.values())
    assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
    assert chat.read_back(*chat.prefix_tree(turns.limit(0))).count() == 0


def test_packing_round_trip(spark, sample):
    from tokenizers import Tokenizer

    import public_tokenizers

    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    odd = [(10**6, None), (10**6 + 1, ""), (10**6 + 2, LONG), (10**6 + 3, "a <|endoftext|> b"), (10**6 + 4, "é 😀\n\n x")]
    docs = sample.select("doc_id", "text").unionAll(spark.createDataFrame(odd, "doc_id long, text string"))
    pieces = packing.pack(docs, with_ids=True).collect()
    held, places = defaultdict(list), defaultdict(list)
    for r in pieces:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and len(r["ids"]) == r["length"]
        held[r["doc_id"]].append((r["start"], r["ids"]))
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, text in texts(docs):
        ids = [x for _, piece in sorted(held[i]) for x in piece]
        assert ids == exact.encode(text or "", add_special_tokens=False).ids + [1]
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    assert sum(len(r["ids"]) for r in pieces) / (2048 * len(places)) > 0.95
    assert packing.pack(docs.limit(0)).count() == 0


def test_open_windows_are_bounded():
    windows = packing.Windows(100, 4, 10)
    rng = np.random.default_rng(0)
    used = Counter()
    for n in rng.integers(1, 250, 500):
        for number, offset, length in windows.place(int(n)):
            assert offset == used[number]
            used[number] += length
        assert len(windows.open) <= 4
    assert max(used.values()) <= 100 and sum(used.values()) / (100 * len(used)) > 0.93


def test_pipeline_stages_take_effect(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.cut(stage(spark, docs, SF))
        kept[name] = docs
    good = {r["doc_id"] for r in quality.judge_quality(spark.read.parquet(f"{SF}/documents.parquet")).where("kept").collect()}
    assert {r["doc_id"] for r in kept["quality_rules"].collect()} == good
    rows = texts(kept["quality_rules"])
    left = dict(texts(kept["line_dedup"]))
    want = brute_lines(rows)
    # A document goes if lines went and none with a word is left.
    emptied = {i for i, t in rows if want[i] != t and not words_of(want[i])}
    assert left == {i: t for i, t in want.items() if i not in emptied}
    firsts = {i for i, _, k in brute_components(list(left.items())) if i == k}
    assert {r["doc_id"] for r in kept["near_duplicates"].collect()} == firsts
    copies = Counter(r["doc_id"] for r in kept["source_mix"].collect())
    assert set(copies) <= firsts and max(copies.values()) <= 2
    assert kept["source_mix"].columns == kept["quality_rules"].columns
    assert sum(r["length"] for r in kept["packing"].collect()) > sum(len(words_of(r["text"])) for r in kept["source_mix"].collect())


def test_no_import_from_the_rest():
    root = os.path.join(os.path.dirname(__file__), "..", "..", "labelloom")
    for folder, _, names in os.walk(root):
        if not folder.endswith("llm"):
            for n in names:
                if n.endswith(".py"):
                    with open(os.path.join(folder, n)) as f:
                        assert "llm" not in f.read()
