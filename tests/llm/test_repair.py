"""Repair of conversations against all edits tried out."""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from labelloom.llm import queries, repair

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
FORM = re.compile(r"(s?(ua)+)?")


def faults(rows):
    seen, found = set(), []
    for role, text in rows:
        said = text.strip(" \t\n\v\f\r")
        found.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else None)
        seen.add((role, text))
    return found


def tried_out(rows):
    """``(cost, audit, turns)``: the least of all edits with up to as many insertions as can pay."""
    best = None
    judged = faults(rows)
    for kinds in itertools.product("DKR", repeat=len(rows)):
        cost, slots = 0, []
        for kind, fault in zip(kinds, judged):
            if kind != "D" and fault in ("blank", "duplicate"):
                break
            cost += {"D": 2, "K": 0, "R": 1}[kind] + (5 if kind != "D" and fault == "truncated" else 0)
        else:
            for n in range(2 * len(rows) // 5 + 1):
                for at in itertools.combinations_with_replacement(range(len(rows) + 1), n):
                    edits = []
                    for i in range(len(rows) + 1):
                        edits += ["I"] * at.count(i) + ([kinds[i]] if i < len(rows) else [])
                    audit = "".join(edits)
                    if best is not None and (cost + 5 * n, audit) >= best[:2]:
                        continue
                    # Roles that may be chosen stand for either; kept ones for themselves.
                    left, rest, slots = [], iter(rows), 0
                    for e in edits:
                        if e == "I":
                            left.append(("?", ""))
                        else:
                            row = next(rest)
                            if e != "D":
                                left.append((row[0] if e == "K" else "?", row[1]))
                    for names in itertools.product(("user", "assistant"), repeat=sum(r == "?" for r, _ in left)):
                        chosen = iter(names)
                        turns = [(next(chosen) if r == "?" else r, x) for r, x in left]
                        if FORM.fullmatch("".join(r[:1] or " " for r, _ in turns)):
                            best = (cost + 5 * n, audit, turns)
                            break
    return best


def report(conv, turns):
    """``turns``: (turn, role, text) in order."""
    rows = [(r, x) for _, r, x in turns]
    cost, audit, left = tried_out(rows)
    judged = Counter(faults(rows))
    numbers = [t for t, _, _ in turns if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    initials = [r[:1] or " " for r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    said = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in left).encode()).hexdigest()
    return (conv, gaps, judged["blank"], judged["duplicate"], judged["truncated"], illegal, cost, audit, said)


def brute(originals, turns):
    held = defaultdict(list)
    for conv, turn, role, text in turns:
        role, text = " " if role is None else role, " " if text is None else text
        look = np.uint64(xxhash.xxh64_intdigest(text.encode(), 42)).astype(np.int64)
        held[conv].append(((turn is not None, turn or 0, role.encode(), look), (turn, role, text)))
    return {report(c, [x for _, x in sorted(held[c], key=lambda r: r[0])]) for c in {r[0] for r in originals}}


def got(originals, turns):
    rows = repair.repair_report(originals, turns).collect()
    assert len(rows) == len({r["conv_id"] for r in rows})
    return {tuple(r[c] for c in "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()) for r in rows}


def test_query_equals_loops(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    after = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        row = (conv, turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
        after += [row] * {0: 0, 3: 2}.get(kind, 1)
    found = queries.QUERIES["op12_repair"](spark, SF)
    columns = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    assert {tuple(r[c] for c in columns) for r in found.collect()} == brute(rows, after)
    damaged = queries.damaged(spark.read.parquet(f"{SF}/conversations.parquet"))
    assert Counter(tuple(r) for r in damaged.collect()) == Counter(after)


def test_random_conversations(spark):
    rng = np.random.default_rng(6)
    roles, said = ["user", "assistant", "system", "tool", "u", "", None], ["Yes.", "No!", "open", " ", "", None, "Why? \n", "é."]
    rows = []
    for conv in range(120):
        for turn in range(int(rng.integers(1, 6))):
            number = None if rng.random() < 0.1 else int(turn + rng.integers(0, 3))
            rows.append((conv, number, roles[rng.choice(7, p=[0.35, 0.3, 0.12, 0.08, 0.05, 0.05, 0.05])], said[rng.choice(8, p=[0.3, 0.2, 0.1, 0.05, 0.05, 0.05, 0.15, 0.1])]))
    rows += [(None, 3, "user", "Hi."), (None, 5, "assistant", "Hi."), (None, 5, "assistant", "Hi."), (200, 2**63 - 1, "user", "x."), (201, -(2**63), "user", None)]
    turns = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(1).alias(c) for c in ("block", "at", "head", "audit", "look", "number")])
    want = brute([*rows, (500,)], rows)
    ids = turns.select("conv_id").unionAll(spark.createDataFrame([(500,), (500,)], "conv_id long"))
    assert got(ids, turns.repartition(5)) == want == got(ids, turns.coalesce(1))
    assert (500, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in want
    assert got(turns.limit(0), turns.limit(0)) == set()


def test_a_conversation_in_many_blocks(spark):
    """A third of all rows in one conversation without an id: its blocks say what one block says."""
    rng = np.random.default_rng(7)
    names = ["user", "assistant", "system", "tool"]
    rows = [(None, i, names[rng.choice(4, p=[0.5, 0.44, 0.03, 0.03])], f"said {i % 2900}" + ("" if rng.random() < 0.1 else ".")) for i in range(3000)]
    rows += [(i, j, names[j % 2], f"{j}.") for i in range(1500) for j in range(4)]
    turns = spark.createDataFrame(rows, SCHEMA).repartition(6)
    hot = [(r, x) for c, _, r, x in rows if c is None]
    items = [(r[:1], f) for (r, _), f in zip(hot, faults(hot))]
    cost, audit = min((repair.lightest(items, repair.NONE, repair.GOALS)).values())
    judgements, repaired = repair.repair(turns)
    told = {r["conv_id"]: r for r in judgements.collect()}
    assert (told[None]["cost"], told[None]["audit"]) == (cost, audit) and told[None]["duplicate"] == faults(hot).count("duplicate") > 0
    left = repaired.where("conv_id IS NULL").orderBy("block", "place").collect()
    assert len({r["block"] for r in left}) > 3
    assert [(r["role"], r["text"], r["edit"]) for r in left] == repair.applied(hot, audit, repair.NONE)
    assert FORM.fullmatch("".join(r["role"][0] for r in left))
    assert {(r["cost"], r["audit"]) for c, r in told.items() if c is not None} == {(0, "KKKK")} and len(told) == 1501


@pytest.mark.parametrize("size", [1, 2, 3, 7])
def test_blocks_join_to_the_whole(size):
    rng = np.random.default_rng(size)
    for _ in range(150):
        rows = [("suax"[rng.integers(0, 4)], [None, None, "blank", "duplicate", "truncated"][rng.integers(0, 5)]) for _ in range(int(rng.integers(1, 15)))]
        want = min(repair.lightest(rows, repair.NONE, repair.GOALS).values())
        blocks = []
        for i in range(0, len(rows), size):
            part = rows[i : i + size]
            blocks.append([(s, to, *w) for s in range(4) for to, w in repair.lightest(part, s, (0, 1, 2, 3)).items()])
        cost, path = repair.join_blocks(iter(blocks))
        assert (cost, "".join(a for _, a in path)) == want and len(path) == len(blocks)
