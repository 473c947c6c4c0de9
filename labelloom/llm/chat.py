"""Chat formatting as a prefix tree: turns that conversations share at their start are emitted once.

Every turn becomes a segment of the template. Conversations with the same first turns share these
segments. A node of the tree is the hash of all segments up to it; it belongs to the least
conversation that passes through it, so that every conversation owns the (maybe empty) last run of
its own path: its chain. A conversation reads the first part of one chain, of a next one that
branches off there, and so on, and then its own chain.

Chains are emitted depth first: a chain, then the chains that branch off it, those that branch off
latest first. In that order a global prefix sum gives every chain its interval in the output. With
each chain come its first position id (the length of what is before it on its path; its own
characters count on from there) and its ancestor intervals: what its characters may attend to
besides their own chain's earlier ones.

The unit is the character (code point) of the formatted text. No task holds a tree: hashes are
chained along each conversation by streaming its turns, owners are one aggregation over all turns,
and a hot first turn is one row of it for each task.

The template: ``<|im_start|>`` role, line feed, text, ``<|im_end|>``, line feed. Inside a text or role
``<`` + backslashes + ``|`` gets one more backslash, so no control string is left and the way back is
exact; roles also spell backslash and line feed by an escape.

Defined cases: null role or text: empty; rows without conversation id: one conversation, the last in
order; turns in order of (turn, role, text), null first; repeated rows are repeated turns; an empty
table gives no rows; turns are streamed, and only what a conversation owns, its chain, makes one row
of text; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sharding import prefix_sums
from .shared import cut, tasks

# Fixed control strings of the template.
START, END = "<|im_start|>", "<|im_end|>"
LEARNED = "assistant"

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text) if "<" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text) if "<" in text else text


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def segment(role: str, text: str) -> tuple[str, tuple[int, int] | None]:
    """A formatted turn, and the interval in it that is learned."""
    head, body = f"{START}{escape_role(role)}\n", escape(text)
    learned = (len(head), len(head) + len(body)) if role == LEARNED else None
    return f"{head}{body}{END}\n", learned


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """The turns of a formatted conversation: role and text."""
    for m in _TURN.finditer(formatted):
        yield unescape_role(m[1]), unescape(m[2])


NODES = "conv_id long, depth int, node binary, formatted string, length long, learned_from int, learned_to int"


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns -> nodes: each with the hash of its path, carried on from the turn before."""
    schema = pa.schema(
        [("conv_id", pa.int64()), ("depth", pa.int32()), ("node", pa.binary()), ("formatted", pa.string()), ("length", pa.int64())]
        + [("learned_from", pa.int32()), ("learned_to", pa.int32())]
    )
    now, depth, path = object(), 0, b""
    for batch in batches:
        rows = []
        for conv, role, text in zip(batch["conv_id"].to_pylist(), batch["role"].to_pylist(), batch["text"].to_pylist()):
            if conv != now:
                now, depth, path = conv, 0, b""
            formatted, learned = segment(role or "", text or "")
            path = hashlib.blake2b(path + formatted.encode("utf-8", "surrogatepass"), digest_size=16).digest()
            rows.append((conv, depth, path, formatted, len(formatted), *(learned or (None, None))))
            depth += 1
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _ranked(conv: str) -> Column:
    """Order of conversations: null last."""
    return F.struct(F.col(conv).isNull().alias("none"), F.col(conv).alias("id"))


def prefix_tree(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chains and readings of a table with ``conv_id``, ``turn``, ``role``, ``text``.

    Chains, one for each conversation that owns turns: ``chain`` (its conversation), ``start`` and
    ``length`` in the output, ``position`` of its first character, ``ancestors`` (intervals of the
    output), ``formatted`` (the text), ``learned`` (intervals in the chain under the loss mask).
    Readings, one for each conversation: ``conv_id``, ``n_turns`` and ``hops``, the chains it reads in order and
    how many characters of each.
    """
    dealt = turns.select("conv_id", "turn", "role", "text").repartition(tasks(turns), "conv_id")
    ordered = dealt.sortWithinPartitions("conv_id", "turn", "role", "text")
    nodes = cut(ordered.select("conv_id", "role", "text").mapInArrow(_nodes, NODES))
    owners = nodes.groupBy("node").agg(F.min(_ranked("conv_id")).alias("owner"))
    owned = cut(nodes.select("conv_id", "depth", "node", "length").join(owners, "node").drop("node"))
    # A conversation's path, cut where the owner changes: one hop for each chain that it reads.
    hops = owned.groupBy("conv_id", "owner").agg(
        F.min("depth").alias("from"), F.sum("length").alias("chars"), F.count("*").alias("turns")
    )
    hop = F.struct("from", F.col("owner").alias("chain"), "chars", "turns")
    readings = cut(
        hops.groupBy("conv_id").agg(F.array_sort(F.collect_list(hop)).alias("hops"), F.sum("turns").alias("n_turns"))
    )
    # The chain of a conversation sorts by its hops: later branches before earlier ones, behind their chain.
    own = readings.where(F.element_at("hops", -1)["chain"] == _ranked("conv_id"))
    path = F.transform("hops", lambda h: F.struct((-h["from"]).alias("branch"), h["chain"].alias("chain")))
    before = F.slice("hops", 1, F.size("hops") - 1)
    chains = own.select(
        F.element_at("hops", -1)["chain"].alias("chain"), F.element_at("hops", -1)["chars"].alias("length"), before.alias("before"), path.alias("path")
    )
    placed = cut(
        prefix_sums(chains, [F.col("path")], F.col("length")).select("chain", "length", "before", F.col("_before").alias("start"))
    )
    position = F.aggregate("before", F.lit(0).cast("long"), lambda total, h: total + h["chars"])
    above = placed.select("chain", F.explode("before").alias("hop")).alias("c").join(
        placed.select(F.col("chain").alias("up"), F.col("start").alias("up_start")), F.col("c.hop.chain") == F.col("up")
    )
    interval = F.struct(F.col("up_start").alias("start"), (F.col("up_start") + F.col("c.hop.chars")).alias("end"))
    ancestors = above.groupBy("c.chain").agg(F.array_sort(F.collect_list(interval)).alias("ancestors"))
    # The text of a chain: the turns that its conversation owns.
    mine = nodes.withColumn("chain", _ranked("conv_id")).join(owners, "node").where("owner = chain")
    turn = F.struct("depth", "formatted", "length", "learned_from", "learned_to")
    spelled = mine.groupBy("chain").agg(F.array_sort(F.collect_list(turn)).alias("segments"))
    texts = spelled.select("chain", F.array_join("segments.formatted", "").alias("formatted"), _masked("segments").alias("learned"))
    return (
        placed.withColumn("position", position).drop("before").join(ancestors, "chain", "left").join(texts, "chain").select(
            "chain", "start", "length", "position", F.coalesce("ancestors", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("ancestors"),
            "formatted", "learned",
        ),
        readings,
    )


def _masked(segments: str) -> Column:
    """Learned intervals of joined segments."""
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    state = F.struct(F.lit(0).cast("long").alias("at"), none.alias("found"))

    def step(s: Column, x: Column) -> Column:
        own = F.array(F.struct((s["at"] + x["learned_from"]).alias("start"), (s["at"] + x["learned_to"]).alias("end")))
        return F.struct((s["at"] + x["length"]).alias("at"), F.when(x["learned_from"].isNotNull(), F.concat(s["found"], own)).otherwise(s["found"]).alias("found"))

    return F.aggregate(segments, state, step, lambda s: s["found"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of conversations in order -> what they say, read back."""
    schema = pa.schema(
        [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
    )

    def summed(conv, n_turns, turns, loss_chars, loss, chars):
        return conv, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars

    now, state = object(), None
    for batch in batches:
        rows = []
        for conv, formatted, learned in zip(*(batch[c].to_pylist() for c in ("conv_id", "formatted", "learned"))):
            if conv != now:
                if state:
                    rows.append(summed(*state))
                now, state = conv, [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in parse(formatted):
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            for span in learned:
                text = unescape(formatted[span["start"] : span["end"]])
                state[3] += len(text)
                state[4].update(text.encode("utf-8", "surrogatepass"))
            state[5] += len(formatted)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    if state:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(summed(*state)), schema)], schema=schema)


def read_back(chains: DataFrame, readings: DataFrame) -> DataFrame:
    """Digests of every conversation, from the emitted chains alone."""
    hops = readings.select("conv_id", F.explode("hops").alias("hop"))
    # The first part of a chain is cut once, however many conversations read it.
    wanted = hops.select("hop.chain", "hop.chars").distinct()
    part = F.substring("formatted", F.lit(1), F.col("chars").cast("int"))
    parts = wanted.join(chains.select("chain", "formatted", "learned"), "chain").select(
        "chain", "chars", part.alias("formatted"), F.filter("learned", lambda x: x["end"] <= F.col("chars")).alias("learned")
    )
    met = hops.alias("h").join(
        parts.alias("p"), (F.col("h.hop.chain") == F.col("p.chain")) & (F.col("h.hop.chars") == F.col("p.chars"))
    )
    rows = met.select("h.conv_id", F.col("h.hop.from").alias("from"), "p.formatted", "p.learned")
    ordered = rows.repartition(tasks(rows), "conv_id").sortWithinPartitions("conv_id", "from")
    ddl = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return ordered.select("conv_id", "formatted", "learned").mapInArrow(_digests, ddl)
