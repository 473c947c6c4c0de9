"""The passes over lines: where they stand, what words they have, and which variants can meet."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from labelloom.llm import lines
from labelloom.llm.shingles import Hasher

ODD = ["", "\n", "a", "A b\n\n c\t d \n", None, " \n \n", "\nx\n", "y", "\n\n", "é É x\x0b\x0cZ\n.. ..", "q\r\n\nr s", "end"]


def edited_pairs() -> list[list[str]]:
    """Two lines within one word of each other, for every length and place; no word is in two pairs, many are in runs."""
    rng = random.Random(11)
    pairs = []
    for n in range(3, 27):
        for place in range(n):
            run = rng.choice([1, 1, 2, 3, 7])
            line = [f"w{len(pairs)}x{i // run}" for i in range(n)]
            kind = rng.choice(["more", "less", "other"] if n > 3 else ["more", "other"])
            edit = {"more": [line[place]] * 2, "less": [], "other": ["other"]}[kind]
            pair = [" ".join(line), " ".join(line[:place] + edit + line[place + 1 :])]
            rng.shuffle(pair)
            pairs.append(pair)
    return pairs


def test_an_edit_is_found_at_every_place_of_lines_of_every_length(spark):
    pairs = edited_pairs()
    rows = [(i, "\n".join([pair[0], f"of its own {i}", "", pair[1]])) for i, pair in enumerate(pairs)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r["key"]: r["lines"] for r in lines.removed_lines(docs).where("lines IS NOT NULL").collect()}
    # Lines "of its own" differ from the first of them in one word.
    assert found == {i: [3] if i == 0 else [1, 3] for i in range(len(pairs))}


def test_only_variants_outside_of_a_shared_part_are_made(spark, monkeypatch):
    rng = random.Random(3)
    made = spark.sparkContext.accumulator(0)
    variants = lines._variants

    def counted(*args):
        read = variants(*args)

        def all_of(batches):
            for batch in read(batches):
                made.add(batch.num_rows)
                yield batch

        return all_of if args[-1] is None else read

    monkeypatch.setattr(lines, "_variants", counted)
    texts = [f"these lines begin alike {i % 4} and" + "".join(f" w{rng.randrange(10**9)}" for _ in range(7)) for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert lines.removed_lines(docs).count() == 0
    # 13 words, of which the first six are shared: the line itself, and seven variants.
    assert made.value == 40 * 8


def test_places_and_words_of_odd_texts():
    texts = ODD * 3
    key, text_hash = pa.array([None, *range(1, len(texts))], pa.int64()), pa.array(range(len(texts)), pa.int64())
    batch = pa.RecordBatch.from_arrays([key, text_hash, pa.array(texts)], ["key", "text_hash", "text"])
    want = [(i, j, lines.words_of(line)) for i, text in enumerate(texts) for j, line in enumerate((text or "").split("\n"))]
    want = [(i, j, b" ".join(words).decode()) for i, j, words in want if words]
    for _, row, data, found in lines._line_batches(iter([batch]), 2):
        assert list(zip((row + found.text).tolist(), found.number.tolist(), found.spelled(data).to_pylist())) == want

    class Bits:
        value = np.zeros(1 << 17, dtype=np.uint8)

    assert list(lines._first_lines(Bits)(iter([batch]))) == []
    chosen = [want[0], want[2], want[-1]]
    spot = lines.spots(key, text_hash, np.array([i for i, _, _ in chosen]), np.array([j for _, j, _ in chosen]))
    at = spot & np.uint64(len(Bits.value) * 8 - 1)
    np.bitwise_or.at(Bits.value, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
    got = pa.Table.from_batches(lines._first_lines(Bits)(iter([batch.slice(0, 7), batch.slice(7)]))).to_pylist()
    assert sorted(r["words"] for r in got) == sorted(words for _, _, words in chosen)
    for r in got:
        data = np.frombuffer(r["words"].encode(), np.uint8)
        one = lines.Lines(Hasher(), data, np.array([len(data)]))
        assert [r["h1"], r["h2"]] == [int(one.stretch(one.at, one.n, k).view(np.int64)[0]) for k in (0, 1)]
