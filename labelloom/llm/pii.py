"""Pseudonyms for personal numbers, dates and addresses that keep their format.

Each value found is checked (check digit, calendar, ranges), taken apart into positions, each with
its own number of possible values (ten digits, 26 letters, 256 bytes of an address, ...), and sent
through a keyed Feistel network over these positions: the two halves take turns in being shifted by
a hash of the other half. That is a permutation of all values of the format, so different values
stay different, equal values get the same pseudonym in every document, and whoever holds the key
can turn it back. Check digits are worked out anew; days stay days of the calendar.

All of it is string and array functions on the row: one pass, no shuffle, no Python.

Kinds: e-mail address (every letter and digit of the part before the ``@``), card number (13 to 19
digits, Luhn digit and an issuer digit of 2 to 6, which stays), social security number,
telephone number (its national digits), IPv4 address (its bytes), ISO and day-first date (days of
1900 to 2099), and secrets (32 to 128 hexadecimal digits). A number that fails its check is left
alone: it is no personal number.

Defined cases: null text stays null, empty text empty; a text of any length is treated whole;
overlapping finds cannot occur, the leftmost and then the first kind in the pattern counts; input
columns named like a result column give way to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_KEY = "labelloom"
ROUNDS = 8

# Fixed formats. An address is bounded so that the search is linear in the text.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
SECRET = r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,128}+|[0-9A-F]{32,128}+)(?![A-Za-z0-9])"
IPV4 = r"(?<![A-Za-z0-9.])(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}(?![A-Za-z0-9]|\.[0-9])"
ISO_DATE = r"(?<![A-Za-z0-9-])(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}(?![A-Za-z0-9]|-[0-9])"
DAY_FIRST = r"(?<![A-Za-z0-9./])[0-9]{2}[./][0-9]{2}[./](?:19|20)[0-9]{2}(?![A-Za-z0-9]|[./][0-9])"
SSN = r"(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9]|-[0-9])"
PHONE = r"(?<![A-Za-z0-9])\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}(?![A-Za-z0-9])|(?<![A-Za-z0-9])\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![A-Za-z0-9])"
CARD = r"(?<![A-Za-z0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![A-Za-z0-9])"
KINDS = {
    "email": EMAIL,
    "secret": SECRET,
    "ipv4": IPV4,
    "iso_date": ISO_DATE,
    "day_first": DAY_FIRST,
    "ssn": SSN,
    "phone": PHONE,
    "card": CARD,
}
ANY = "|".join(f"(?:{p})" for p in KINDS.values())

# The days of 1900 to 2099 are 17 * 4297.
FIRST_DAY, DAYS, DAY_RADICES = "1900-01-01", 73049, (17, 4297)
# Areas 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999.
SSN_RADICES = (898, 99, 9999)


DIGITS = "0123456789"
LOWER, UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER_HEX, UPPER_HEX = "0123456789abcdef", "0123456789ABCDEF"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _shift(own: Column, other: Column, radices: Column, key: str, kind: Column, turn: int, sign: int) -> Column:
    """``own`` positions, each moved within its radix by a keyed hash of all ``other`` positions."""
    seed = F.sha2(F.concat_ws("|", F.lit(key), kind, F.lit(str(turn)), F.array_join(radices, ","), F.array_join(other, ",")), 256)
    return _let(
        seed,
        lambda s: F.transform(
            own, lambda x, i: F.pmod(x + sign * F.pmod(F.xxhash64(s, i), F.get(radices, i)), F.get(radices, i))
        ),
    )


def _turn(key: str, kind: Column, turn: int, sign: int):
    def step(s: Column) -> Column:
        left, right = s["l"], s["r"]
        if turn % 2 == 0:
            left = _shift(left, right, s["lr"], key, kind, turn, sign)
        else:
            right = _shift(right, left, s["rr"], key, kind, turn, sign)
        return F.struct(left.alias("l"), right.alias("r"), s["lr"].alias("lr"), s["rr"].alias("rr"))

    return step


def feistel(positions: Column, radices: Column, key: str, kind: Column, inverse: bool = False) -> Column:
    """A keyed permutation of arrays of longs, position i in 0 .. radix i - 1. One position: a shift."""
    half = F.ceil(F.size(positions) / 2).cast("int")
    left, right = F.slice(positions, 1, half), F.slice(positions, half + 1, F.size(positions))
    left_radix, right_radix = F.slice(radices, 1, half), F.slice(radices, half + 1, F.size(radices))
    state = F.struct(left.alias("l"), right.alias("r"), left_radix.alias("lr"), right_radix.alias("rr"))
    for turn in reversed(range(ROUNDS)) if inverse else range(ROUNDS):
        state = _let(state, _turn(key, kind, turn, -1 if inverse else 1))
    return _let(state, lambda s: F.concat(s["l"], s["r"]))


def _characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _pure_digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _longs(digits: Column) -> Column:
    return F.transform(_characters(digits), lambda c: c.cast("long"))


def luhn_sum(digits: Column) -> Column:
    """Sum of the digits, every second one from the right doubled."""
    doubled = F.transform(
        F.reverse(_longs(digits)),
        lambda x, i: F.when(i % 2 == 0, x).otherwise(x * 2 - F.when(x > 4, F.lit(9)).otherwise(F.lit(0))),
    )
    return F.aggregate(doubled, F.lit(0).cast("long"), lambda total, x: total + x)


def _day(match: Column, kind: Column) -> Column:
    """The day that a date names, as days since FIRST_DAY; null if there is none."""
    iso = F.when(kind == "iso_date", match).otherwise(
        F.concat(F.substring(match, 7, 4), F.lit("-"), F.substring(match, 4, 2), F.lit("-"), F.substring(match, 1, 2))
    )
    return F.datediff(F.try_to_date(iso, "yyyy-MM-dd"), F.lit(FIRST_DAY).cast("date")).cast("long")


def _kind(match: Column) -> Column:
    """The kind of a find that passes its check; null for any other."""
    checks = {
        "ipv4": F.forall(F.split(match, r"\."), lambda x: x.cast("int") <= 255),
        "iso_date": _day(match, F.lit("iso_date")).isNotNull(),
        "day_first": _day(match, F.lit("day_first")).isNotNull(),
        "ssn": match.rlike("^(?!000|666|9)...-(?!00)..-(?!0000)"),
        "phone": F.length(_pure_digits(match)).between(8, 15),
        "card": match.rlike("^[2-6]") & (luhn_sum(_pure_digits(match)) % 10 == 0),
    }
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(KINDS.items()):
        checked = F.when(checks[name], F.lit(name)) if name in checks else F.lit(name)
        kind = F.when(match.rlike(f"^(?:{pattern})$"), checked).otherwise(kind)
    return kind


def _alphabet(c: Column, kind: Column, match: Column) -> Column:
    """The characters that may stand in the place of ``c``; null if it stays."""
    digits_of = F.when(match.rlike("[A-F]"), F.lit(UPPER_HEX)).otherwise(F.lit(LOWER_HEX))
    plain = F.when(c.rlike("^[0-9]$"), F.lit(DIGITS)).when(c.rlike("^[a-z]$"), F.lit(LOWER)).when(c.rlike("^[A-Z]$"), F.lit(UPPER))
    return F.when(kind == "secret", digits_of).otherwise(plain)


def _taken_apart(find: Column) -> Column:
    """A find as ``head`` + what is permuted + ``tail``, the latter as ``positions`` and ``radices``."""
    match, kind = find["match"], find["kind"]
    country = F.regexp_extract(match, r"^\+(?:[0-9]{1,3}(?=[ .(-]))?", 0)
    digits = _pure_digits(match)
    head = F.when(kind == "phone", country).otherwise("")
    body = (
        F.when(kind == "email", F.substring_index(match, "@", 1))
        .when(kind == "phone", F.substring(match, F.length(country) + 1, F.length(match)))
        .otherwise(match)
    )
    tail = F.when(kind == "email", F.concat(F.lit("@"), F.substring_index(match, "@", -1))).otherwise("")
    part = F.struct(match.alias("match"), kind.alias("kind"), head.alias("head"), body.alias("body"), tail.alias("tail"))
    area = F.substring(match, 1, 3).cast("long")
    one = F.lit(1).cast("long")

    def places(p: Column) -> Column:
        alphabets = F.transform(_characters(p["body"]), lambda c: _alphabet(c, kind, match))
        spelled = F.transform(
            F.arrays_zip(_characters(p["body"]).alias("c"), alphabets.alias("a")),
            lambda x: F.when(x["a"].isNotNull(), F.position(x["c"], x["a"]) - 1).otherwise(0).cast("long"),
        )
        sizes = F.transform(alphabets, lambda a: F.coalesce(F.length(a), F.lit(1)).cast("long"))
        day = _day(match, kind)
        positions = (
            F.when(kind.isin("email", "secret"), spelled)
            .when(kind == "ipv4", F.transform(F.split(match, r"\."), lambda x: x.cast("long")))
            .when(kind.isin("iso_date", "day_first"), F.array(F.floor(day / DAY_RADICES[1]), day % DAY_RADICES[1]))
            .when(
                kind == "ssn",
                F.array(
                    area - 1 - F.when(area > 666, one).otherwise(0),
                    F.substring(match, 5, 2).cast("long") - 1,
                    F.substring(match, 8, 4).cast("long") - 1,
                ),
            )
            .when(kind == "phone", _longs(_pure_digits(p["body"])))
            .otherwise(_longs(F.substring(digits, F.lit(2), F.length(digits) - 2)))
        )
        radices = (
            F.when(kind.isin("email", "secret"), sizes)
            .when(kind == "ipv4", F.array_repeat(F.lit(256).cast("long"), 4))
            .when(kind.isin("iso_date", "day_first"), F.array(*[F.lit(r).cast("long") for r in DAY_RADICES]))
            .when(kind == "ssn", F.array(*[F.lit(r).cast("long") for r in SSN_RADICES]))
            .otherwise(F.transform(positions, lambda x: F.lit(10).cast("long")))
        )
        return F.struct(*[p[f].alias(f) for f in ("match", "kind", "head", "body", "tail")], positions.alias("positions"), radices.alias("radices"))

    return _let(part, places)


def _filled(template: Column, digits: Column) -> Column:
    """The template with its digits replaced, one after the other."""
    return F.array_join(
        F.transform(
            _characters(template),
            lambda c, i: F.when(
                c.rlike("^[0-9]$"), F.substring(digits, F.length(_pure_digits(F.substring(template, F.lit(1), i + 1))), F.lit(1))
            ).otherwise(c),
        ),
        "",
    )


def _put_together(p: Column) -> Column:
    """The pseudonym of a find whose positions have been permuted."""
    kind, at, body = p["kind"], p["positions"], p["body"]
    spelled = F.array_join(
        F.transform(
            F.arrays_zip(_characters(body).alias("c"), at.alias("x")),
            lambda z: F.coalesce(F.substring(_alphabet(z["c"], kind, p["match"]), (z["x"] + 1).cast("int"), F.lit(1)), z["c"]),
        ),
        "",
    )
    number = F.array_join(at, "")
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), (F.get(at, F.lit(0)) * DAY_RADICES[1] + F.get(at, F.lit(1))).cast("int"))
    sign = F.substring(body, 3, 1)
    first_digits = F.concat(F.substring(body, 1, 1), number)
    check_digit = F.pmod(10 - luhn_sum(F.concat(first_digits, F.lit("0"))) % 10, F.lit(10)).cast("string")
    area = F.get(at, F.lit(0)) + 1
    value = (
        F.when(kind.isin("email", "secret"), spelled)
        .when(kind == "ipv4", F.array_join(at, "."))
        .when(kind == "iso_date", F.date_format(day, "yyyy-MM-dd"))
        .when(kind == "day_first", F.concat(F.date_format(day, "dd"), sign, F.date_format(day, "MM"), sign, F.date_format(day, "yyyy")))
        .when(
            kind == "ssn",
            F.concat_ws(
                "-",
                F.lpad((area + F.when(area >= 666, 1).otherwise(0)).cast("string"), 3, "0"),
                F.lpad((F.get(at, F.lit(1)) + 1).cast("string"), 2, "0"),
                F.lpad((F.get(at, F.lit(2)) + 1).cast("string"), 4, "0"),
            ),
        )
        .when(kind == "phone", _filled(body, number))
        .when(kind == "card", _filled(body, F.concat(first_digits, check_digit)))
    )
    return F.concat(p["head"], value, p["tail"])


def pseudonymize(df: DataFrame, key: str = DEFAULT_KEY, text: str = "text", inverse: bool = False) -> DataFrame:
    """Every row with its values replaced in ``text``, the number ``n_values`` of them and their ``kinds``.

    ``inverse`` turns pseudonyms made with the same ``key`` back.
    """
    # Every kind holds a digit or an at sign; other texts skip the search.
    any_value = F.col(text).rlike("[0-9@]")
    matches = F.when(any_value, F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))
    kinds = F.transform(matches, lambda m: F.struct(m.alias("match"), _kind(m).alias("kind")))
    found = df.select(F.struct("*").alias("_row"), F.col(text).alias("_text"), kinds.alias("_finds"))
    apart = F.transform("_finds", lambda f: F.when(f["kind"].isNotNull(), _taken_apart(f)))
    moved = F.transform(
        apart,
        lambda p: F.when(
            p.isNotNull(),
            F.struct(
                *[p[f].alias(f) for f in ("match", "kind", "head", "body", "tail")],
                feistel(p["positions"], p["radices"], key, p["kind"], inverse).alias("positions"),
            ),
        ),
    )
    named = F.transform(moved, lambda p: F.when(p.isNotNull(), _put_together(p)))
    found = found.select("_row", "_text", "_finds", named.alias("_names"))
    # What stands between the finds, and after each its pseudonym or itself.
    fillers = F.zip_with("_names", "_finds", lambda n, f: F.coalesce(n, f["match"]))
    rebuilt = F.array_join(
        F.zip_with(F.split("_text", ANY), F.concat(fillers, F.array(F.lit(""))), lambda between, filler: F.concat(between, filler)), ""
    )
    good = F.filter("_finds", lambda f: f["kind"].isNotNull())
    new = {
        text: F.when(F.size("_finds") > 0, rebuilt).otherwise(F.col("_text")),
        "n_values": F.greatest(F.size(good), F.lit(0)).cast("long"),
        "kinds": F.coalesce(F.array_sort(F.array_distinct(good["kind"])), F.array().cast("array<string>")),
    }
    kept = [F.col("_row")[c].alias(c) for c in df.columns if c.lower() not in new]
    return found.select(*kept, *[c.alias(n) for n, c in new.items()])
