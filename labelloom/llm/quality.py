"""Quality rules: a table of thresholds, compiled into one projection of built-in functions.

Each rule bounds one ratio of a text. The counts behind the ratios (words, characters, symbols,
stop words, lines, repeated lines, words in repeated three-word windows) are array and string
functions, so a document is judged where it is read: no shuffle, no Python.

Repeated windows are found inside the row: each window becomes a 64-bit hash, the hashes are sorted
with their positions, and neighbours of equal hash are candidates. Candidates are then compared by
their words, so a hash collision changes nothing.

Defined cases: a null or empty text has no words and fails; a text of any length is judged whole;
repeated rows are judged alike; input columns named like a result column give way to it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import only, words

# Symbols, and frequent function words of English, French, German and Spanish.
SYMBOLS = "[#*$%&|<>]"
STOP_WORDS = (
    "the be to of and in that have with is it for on "
    "le la les de des du et un une en que est pour pas dans "
    "der die das und in zu den von mit ist nicht ein eine "
    "el los las y del por con una es no se"
).split()
CASED_STOP_WORDS = sorted({form for w in STOP_WORDS for form in (w, w.capitalize())})

#: Word of the text -> count column; every ratio divides two of these.
COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_stop_words",
    "n_lines",
    "n_dup_lines",
    "n_bullet_lines",
    "n_ellipsis_lines",
    "n_repeat_words",
)


@dataclass(frozen=True)
class Rule:
    """``low <= numerator / denominator <= high``; no denominator means one."""

    name: str
    numerator: str
    denominator: str | None = None
    low: float | None = None
    high: float | None = None

    def passes(self) -> Column:
        top = F.col(self.numerator).cast("double")
        bottom = F.lit(1.0) if self.denominator is None else F.col(self.denominator).cast("double")
        checks = F.lit(True)
        if self.low is not None:
            checks = checks & (top >= self.low * bottom)
        if self.high is not None:
            checks = checks & (top <= self.high * bottom)
        return checks


#: Both must hold, whatever the other rules say.
BASE_RULES = (
    Rule("enough_words", "n_words", low=50),
    Rule("few_repeated_windows", "n_repeat_words", "n_words", high=0.5),
)
RULES = (
    Rule("word_length", "word_chars", "n_words", low=2.0, high=14.0),
    Rule("symbols", "n_symbols", "n_words", high=0.3),
    Rule("stop_words", "n_stop_words", low=2),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=0.5),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", high=0.9),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", high=0.3),
)


def _near_equal(array: str, x: Column, i: Column, fields: Sequence[str]) -> Column:
    """Whether the element before or behind has the same ``fields`` in a sorted array."""

    def same(other: Column) -> Column:
        return reduce(and_, [other[f] == x[f] for f in fields])

    # Beyond either end this is null, which a filter takes as false.
    return same(F.get(F.col(array), i - 1)) | same(F.get(F.col(array), i + 1))


def text_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """The columns of :data:`COUNTS` (long) for every row, besides ``_row``, the row itself."""
    body = F.coalesce(F.col(text), F.lit(""))
    base = df.select(F.struct("*").alias("_row"), body.alias("_text"), words(F.col(text)).alias("_w"))
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    hashes = F.transform("_w", lambda x, i: F.xxhash64(x, F.get("_w", i + 1), F.get("_w", i + 2)))
    base = base.select("_row", "_text", "_w", lines.alias("_lines"), hashes.alias("_h"))
    at = F.sequence(F.lit(0), F.size("_h") - 1)
    places = F.sort_array(F.arrays_zip(F.col("_h").alias("h"), at.alias("at")))
    none = F.array_repeat(F.struct(F.lit(0).cast("long").alias("h"), F.lit(0).alias("at")), 0)
    repeats = F.size(F.array_distinct("_h")) < F.size("_h")
    base = base.select(
        "_row", "_text", "_w", "_lines", F.when(repeats, places).otherwise(none).alias("_places")
    )
    alike = F.filter("_places", lambda x, i: _near_equal("_places", x, i, ["h"]))
    windows = F.sort_array(
        F.transform(
            alike,
            lambda x: F.struct(
                F.get("_w", x["at"]).alias("a"),
                F.get("_w", x["at"] + 1).alias("b"),
                F.get("_w", x["at"] + 2).alias("c"),
                x["at"].alias("at"),
            ),
        )
    )
    base = base.select("_row", "_text", "_w", "_lines", windows.alias("_windows"))
    equal = F.filter("_windows", lambda x, i: _near_equal("_windows", x, i, ["a", "b", "c"]))
    starts = F.sort_array(F.transform(equal, lambda x: x["at"]))
    base = base.select("_row", "_text", "_w", "_lines", starts.alias("_starts"))
    # A window covers three words, or as many as there are up to the next repeated window.
    covered = F.aggregate(
        F.transform("_starts", lambda x, i: F.least(F.lit(3), F.coalesce(F.get("_starts", i + 1) - x, F.lit(3)))),
        F.lit(0),
        lambda total, x: total + x,
    )
    counts = {
        "n_words": F.size("_w"),
        "word_chars": F.length(F.array_join("_w", "")),
        "n_symbols": F.length("_text") - F.length(F.regexp_replace("_text", SYMBOLS, "")),
        "n_stop_words": F.size(F.filter("_w", lambda x: x.isin(CASED_STOP_WORDS))),
        "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_bullet_lines": F.size(F.filter("_lines", lambda x: x.rlike(r"^[\x20\x09-\x0D]*[-*•]"))),
        "n_ellipsis_lines": F.size(F.filter("_lines", lambda x: x.endswith("...") | x.endswith("…"))),
        "n_repeat_words": covered,
    }
    return base.select("_row", *[c.cast("long").alias(n) for n, c in counts.items()])


def _all(rules: Sequence[Rule]) -> Column:
    return reduce(and_, [rule.passes() for rule in rules], F.lit(True))


def judge_quality(
    df: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, base: Sequence[Rule] = BASE_RULES
) -> DataFrame:
    """Every row with its counts, ``base_failed``, ``kept``, and the names of the rules it breaks.

    ``kept`` is true if the base rules and all others hold.
    """
    counted = text_counts(df, text)
    broken = F.filter(
        F.array(*[F.when(~r.passes(), F.lit(r.name)) for r in (*base, *rules)]), lambda x: x.isNotNull()
    )
    judged = {n: F.col(n) for n in COUNTS} | {
        "base_failed": ~_all(base),
        "kept": _all(base) & _all(rules),
        "broken_rules": broken,
    }
    # Behind a generator: a filter on a result column stays above it, and no count is worked out again in its condition.
    made = F.struct(F.col("_row"), *[c.alias(f"_out_{n}") for n, c in judged.items()])
    named = counted.select(F.explode(F.array(made)).alias("_made"))
    taken = {n.lower() for n in judged}
    kept = [F.col("_made._row")[c].alias(c) for c in df.columns if c.lower() not in taken]
    return named.select(*kept, *[F.col(f"_made._out_{n}").alias(n) for n in judged])


def keep_good(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows that pass, with their own columns and nothing else."""
    return only(text_counts(df, text), _all(BASE_RULES) & _all(RULES), F.col("_row"))
