"""Conversation structure repair: the cheapest edits that make a conversation's roles alternate.

The roles of a repaired conversation read ``(s?(ua)+)?`` by their initials: system or nothing, then
user and assistant in turn, or nothing at all. Rows may be kept, given another role or deleted, and empty turns inserted.

Repair is deduction with weights (Knuth's generalisation of Dijkstra's algorithm). An item
``(i, state)`` says that the first i rows are repaired and end in a state; an axiom is an edit of one
row, or an insertion. A deduction joins an item and an axiom to a further item, and its weight is a
superior function of theirs: costs are added, audits (the initials of the edits) are put one after the other, so
no weight is less than that of a premise. An agenda pops items by (cost, audit); the first time an item is popped its weight
is final, and the search ends when the goal item is. Two derivations of one item have audits of which neither begins the other, or other
costs, so the order of their extensions is theirs, and ties go to the ASCII-least audit.

Rows are put in order by a range partitioning, so a conversation of any size lies in as many tasks as
it needs, in blocks of bounded size. A block's derivations are items of two
states, ``(from, to)``; those of following blocks join at the state between them. So a hot
conversation is repaired block by block, in parallel, and one task per conversation only joins the blocks' at most
sixteen weights. The part of the audit that all states agree on is not carried along.

Faults: a row's first one counts. Blank: no character but white space; duplicate: a row before it
has its role and text; truncated: the last character but white space is none of ``.!?``. A fault of
a row is found by its own content, and duplicates by one aggregation over digests of role and text.

Defined cases: a null id is a conversation of its own; null roles and texts are one space, as is an
empty role; rows of one turn go by role, then text, and turns without a number come first; repeated rows are rows (duplicates);
texts of any length are taken whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut, small, tasks

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
#: Cost of an edit, and of a truncated row that is not deleted.
COSTS = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED_COST = 5
#: States: nothing yet, and what the last turn is.
NONE, SYSTEM, USER, ASSISTANT = range(4)
#: From which states a turn with an initial may follow.
FOLLOWS = {"s": {NONE: SYSTEM}, "u": {NONE: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
#: States in which a conversation may end.
GOALS = (NONE, ASSISTANT)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Rows, and bytes of text, of a block.
BLOCK_ROWS, BLOCK_BYTES = 512, 1 << 22

Row = tuple[str, str | None]  # initial of the role, fault


def axioms(row: Row) -> list[tuple[int, str, dict[int, int]]]:
    """``(cost, initial, state -> next state)`` of the edits of one row."""
    initial, fault = row
    edits = [(COSTS[DELETE], DELETE, {s: s for s in range(4)})]
    if fault not in ("blank", "duplicate"):
        more = TRUNCATED_COST if fault == "truncated" else 0
        if initial in FOLLOWS:
            edits.append((COSTS[KEEP] + more, KEEP, FOLLOWS[initial]))
        edits.append((COSTS[REROLE] + more, REROLE, FOLLOWS["u"] | FOLLOWS["a"]))
    return edits


INSERTIONS = [(COSTS[INSERT], INSERT, FOLLOWS["u"] | FOLLOWS["a"])]


def lightest(rows: list[Row], start: int, goals: tuple[int, ...]) -> dict[int, tuple[int, str]]:
    """The lightest ``(cost, audit)`` from a state before the rows to each of the ``goals`` behind them."""
    of_row = [axioms(r) for r in rows]
    agenda, final, found = [(0, "", 0, start)], set(), {}
    while agenda and len(found) < len(goals):
        cost, audit, i, state = heapq.heappop(agenda)
        if (i, state) in final:
            continue
        final.add((i, state))
        if i == len(rows) and state in goals:
            found[state] = (cost, audit)
        for step, edits in ((1, of_row[i] if i < len(rows) else ()), (0, INSERTIONS)):
            for more, initial, follows in edits:
                after = follows.get(state)
                if after is not None and (i + step, after) not in final:
                    heapq.heappush(agenda, (cost + more, audit + initial, i + step, after))
    return found


def applied(rows: list[tuple[str, str]], audit: str, state: int) -> list[tuple[str, str, str]]:
    """``(role, text, edit)`` of the turns that an audit makes of ``(role, text)`` rows, from a state on."""
    turns, at = [], 0
    for edit in audit:
        if edit == DELETE:
            at += 1
            continue
        if edit == KEEP:
            role, text = rows[at]
            state = FOLLOWS[role[:1]][state]
        else:
            state = (FOLLOWS["u"] | FOLLOWS["a"])[state]
            role, text = NAMES[state], "" if edit == INSERT else rows[at][1]
        at += edit != INSERT
        turns.append((role, text, edit))
    return turns


def join_blocks(blocks: Iterator[list[tuple[int, int, int, str]]]) -> tuple[int, list[tuple[int, str]]]:
    """Cost, and ``(state before, audit)`` of each block, of the lightest way through blocks in order.

    ``blocks`` give ``(from, to, cost, audit)``. Derivations with one state are compared by their audits as a whole.
    """
    ways: dict[int, tuple[int, tuple[str, ...], tuple[int, ...]]] = {NONE: (0, (), ())}
    settled: list[tuple[int, str]] = []
    for items in blocks:
        further: dict[int, tuple[int, str, tuple]] = {}
        for start, to, cost, audit in items:
            if start not in ways:
                continue
            before, audits, states = ways[start]
            weight = (before + cost, "".join(audits) + audit, ((*audits, audit), (*states, start)))
            if to not in further or weight[:2] < further[to][:2]:
                further[to] = weight
        ways = {to: (cost, *path) for to, (cost, _, path) in further.items()}
        # What all ways have in common is decided, and no longer compared.
        paths = [list(zip(states, audits)) for _, audits, states in ways.values()]
        common = 0
        while paths and all(common < len(p) and p[common] == paths[0][common] for p in paths):
            common += 1
        settled += paths[0][:common] if paths else []
        ways = {to: (cost, audits[common:], states[common:]) for to, (cost, audits, states) in ways.items()}
    cost, audits, states = min((w for s, w in ways.items() if s in GOALS), key=lambda w: (w[0], "".join(w[1])))
    return cost, settled + list(zip(states, audits))


PLACED = "conv_id long, turn long, role string, text string, at long, block long, head boolean"


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ordered rows -> with ``at``, the place of a row, and ``block``, the place of its block's first row.

    ``head`` is set where a conversation surely begins with this block: not at the start of a task's
    rows, whose conversation may have begun before.
    """
    more = [("at", pa.int64()), ("block", pa.int64()), ("head", pa.bool_())]
    at = TaskContext.get().partitionId() << 33
    now, block, size, head, begun = None, at, 0, False, False
    for batch in batches:
        convs, sizes = batch["conv_id"].to_pylist(), pc.binary_length(batch["text"]).to_pylist()
        first, blocks, heads = at, [], []
        for conv, n in zip(convs, sizes):
            if not begun or conv != now:
                now, block, size, head, begun = conv, at, 0, begun, True
            elif at - block >= BLOCK_ROWS or size > BLOCK_BYTES:
                block, size, head = at, 0, False
            size += n
            blocks.append(block)
            heads.append(head)
            at += 1
        schema = pa.schema([*batch.schema, *(pa.field(*f) for f in more)])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(range(first, at), pa.int64()), pa.array(blocks, pa.int64()), pa.array(heads, pa.bool_())], schema=schema)


BLOCK = "conv_id long, block long, illegal long, first string, last string, weights array<struct<from:int,to:int,cost:long,audit:string>>"
WEIGHT = pa.struct([("from", pa.int32()), ("to", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])


def _summed(conv: int | None, block: int, head: bool, rows: list[Row]) -> tuple:
    initials = [r[0] for r in rows]
    weights = []
    for start in (NONE,) if head else range(4):
        for to, (cost, audit) in sorted(lightest(rows, start, (NONE, SYSTEM, USER, ASSISTANT)).items()):
            weights.append({"from": start, "to": to, "cost": cost, "audit": audit})
    return conv, block, _illegal(initials), initials[0], initials[-1], weights


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of blocks in order -> blocks with the lightest derivations between states."""
    schema = pa.schema(
        [("conv_id", pa.int64()), ("block", pa.int64()), ("illegal", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("weights", pa.list_(WEIGHT))]
    )
    now, rows = None, []
    for batch in batches:
        made = []
        for conv, block, head, initial, fault in zip(*(batch[c].to_pylist() for c in ("conv_id", "block", "head", "initial", "fault"))):
            if rows and now[1] != block:
                made.append(_summed(*now, rows))
                rows = []
            now = conv, block, head
            rows.append((initial, fault))
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), schema)], schema=schema)
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(_summed(*now, rows)), schema)], schema=schema)


WAY = "conv_id long, illegal long, cost long, parts array<struct<block:long,state:int,audit:string>>"


def _ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in order -> the lightest way through every conversation."""
    part = pa.struct([("block", pa.int64()), ("state", pa.int32()), ("audit", pa.string())])
    schema = pa.schema([("conv_id", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("parts", pa.list_(part))])

    def rows() -> Iterator[dict]:
        for batch in batches:
            yield from batch.to_pylist()

    for conv, blocks in itertools.groupby(rows(), key=lambda r: r["conv_id"]):
        illegal, last, numbers = 0, None, []

        def weights(blocks=blocks) -> Iterator[list[tuple[int, int, int, str]]]:
            nonlocal illegal, last
            for b in blocks:
                illegal += b["illegal"] + (last is not None and _illegal([last, b["first"]]))
                last = b["last"]
                numbers.append(b["block"])
                yield [(w["from"], w["to"], w["cost"], w["audit"]) for w in b["weights"]]

        cost, path = join_blocks(weights())
        parts = [{"block": n, "state": s, "audit": a} for n, (s, a) in zip(numbers, path)]
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((conv, illegal, cost, parts), schema)], schema=schema)


REPAIRED = "conv_id long, block long, place int, role string, text string, edit string"


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every block its audit, then its rows -> the turns that are left or made."""
    schema = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("place", pa.int32()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])
    head, rows = None, []

    def made():
        conv, block, state, audit = head
        found = [(conv, block, i, *turn) for i, turn in enumerate(applied(rows, audit, state))]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)

    for batch in batches:
        for conv, block, at, role, text, state, audit in zip(*(batch[c].to_pylist() for c in ("conv_id", "block", "at", "role", "text", "state", "audit"))):
            if at < 0:
                if head is not None:
                    yield from made()
                head, rows = (conv, block, state, audit), []
            else:
                rows.append((role, text))
    if head is not None:
        yield from made()


def _streamed(df: DataFrame, by: str, *then: str) -> DataFrame:
    """Rows of a key together and in order, to be read one after the other."""
    return df.repartition(tasks(df), by).sortWithinPartitions(by, *then)


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations and repaired turns of a table with ``conv_id``, ``turn``, ``role``, ``text``.

    Conversations: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``. Turns:
    ``conv_id``, ``block`` and ``place`` (their order), ``role, text, edit``.
    """
    space = F.lit(" ")
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    # A number tells equal rows apart, so that a range can end between them; it is stored before it is used.
    stored = cut(rows.select("*", F.xxhash64("text").alias("look"), F.monotonically_increasing_id().alias("number")))
    order = ["conv_id", "turn", "role", "look", "number"]
    ranged = stored.repartitionByRange(tasks(stored), *order).sortWithinPartitions(*order).drop("look", "number")
    placed = cut(ranged.mapInArrow(_placed, PLACED))
    narrow = placed.select(
        "conv_id", "turn", "at", "block", "head",
        F.when(F.col("role") == "", space).otherwise(F.substring("role", 1, 1)).alias("initial"),
        (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("open"),
        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256).alias("digest"),
    )
    narrow = cut(narrow)
    again = cut(narrow.groupBy("conv_id", "digest").agg(F.min("at").alias("earliest"), F.count("*").alias("n")).where("n > 1").drop("n"))
    same = F.col("r.conv_id").eqNullSafe(F.col("g.conv_id")) & (F.col("r.digest") == F.col("g.digest"))
    met = narrow.alias("r").join(small(again, again.count() * 192).alias("g"), same, "left").select("r.*", "g.earliest")
    fault = F.when(F.col("blank"), "blank").when(F.col("at") > F.col("earliest"), "duplicate").when(F.col("open"), "truncated")
    judged = cut(met.select("conv_id", "turn", "at", "block", "head", "initial", fault.alias("fault")))
    blocks = _streamed(judged.select("conv_id", "block", "at", "head", "initial", "fault"), "block", "at").mapInArrow(_blocks, BLOCK)
    ways = cut(_streamed(blocks, "conv_id", "block").mapInArrow(_ways, WAY))
    n_turns = F.countDistinct("turn")
    gaps = F.when(n_turns == 0, 0).otherwise(F.coalesce(F.try_add(F.try_subtract(F.max("turn"), F.min("turn")), 1 - n_turns), F.lit(2**63 - 1)))
    counted = judged.groupBy("conv_id").agg(
        gaps.cast("long").alias("gaps"), *[F.count(F.when(F.col("fault") == f, 1)).alias(f) for f in ("blank", "duplicate", "truncated")]
    )
    audit = F.array_join(F.col("parts.audit"), "").alias("audit")
    judgements = counted.alias("c").join(ways.alias("w"), F.col("c.conv_id").eqNullSafe(F.col("w.conv_id"))).select("c.*", "illegal", "cost", audit)
    parts = ways.select("conv_id", F.explode("parts").alias("part")).select("conv_id", "part.block", F.lit(-1).cast("long").alias("at"), "part.state", "part.audit")
    none = {"state": F.lit(None).cast("int"), "audit": F.lit(None).cast("string")}
    texts = placed.select("conv_id", "block", "at", "role", "text", *[c.alias(n) for n, c in none.items()])
    told = parts.select("conv_id", "block", "at", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), "state", "audit")
    repaired = _streamed(texts.unionByName(told), "block", "at").mapInArrow(_repaired, REPAIRED)
    return judgements, repaired


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
    now, digest = None, None
    for batch in batches:
        rows = []
        for conv, role, text in zip(*(batch[c].to_pylist() for c in ("conv_id", "role", "text"))):
            if digest is None or conv != now:
                if digest is not None:
                    rows.append((now, digest.hexdigest()))
                now, digest = conv, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([digest.hexdigest()])], schema=schema)


def repair_report(originals: DataFrame, turns: DataFrame) -> DataFrame:
    """A row for every conversation of ``originals``: what :func:`repair` says of its ``turns``, and the digest of its repaired lines."""
    judgements, repaired = repair(turns)
    digests = _streamed(repaired.select("conv_id", "block", "place", "role", "text"), "conv_id", "block", "place").mapInArrow(_digests, "conv_id long, repaired_sha256 string")
    all_ids = originals.select(F.col("conv_id").cast("long")).distinct()
    met = all_ids.alias("o").join(judgements.alias("j"), F.col("o.conv_id").eqNullSafe(F.col("j.conv_id")), "left").join(
        digests.alias("d"), F.col("o.conv_id").eqNullSafe(F.col("d.conv_id")), "left"
    )
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return met.select("o.conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))
