"""Format-preserving pseudonyms for personal data, by keyed Feistel networks.

Values are found by one pattern and validated (calendar, octet ranges, digit
counts); each is replaced by another value of the same format, by a permutation
that depends on the key and the format only, so equal values stay equal across
documents and different values stay different.

* Characters: a Feistel network over the two halves of the value.  A round adds
  a key stream, derived by SHA-512 from the key, the format, the round and the
  other half, to every character of a half, each within its own alphabet.
  Characters outside the alphabets (separators) keep their place.
* ``number`` (13 to 19 digits, optionally grouped): all digits but the last are
  permuted; the last keeps its distance to the Luhn check digit, so valid card
  numbers become valid card numbers and others do not.
* ``phone``: the country code stays, all other digits are permuted.
* ``ssn``, ``local`` (ddd-dddd), ``secret`` (hexadecimal, 32 characters or more,
  in pieces of 64) and the local part of an ``email``: permuted within digits,
  lower-case and upper-case letters.
* ``ip``: the 32 bits of the address are permuted.
* ``date`` (y-m-d with ``-``, ``/`` or ``.``; d.m.y and d/m/y; m/d/y where d/m/y
  is no date): a Gregorian cycle of 400 years has 146097 = 189 * 773 days; the
  day within its cycle is permuted by a Feistel network over these two factors,
  so every valid date becomes a valid date.  Days and months of one digit and
  the order m/d/y are kept by permuting on (cycle walking) to the next date that
  is written so.  What is not in the calendar is left alone.

A phone that starts with + has 7 to 15 digits and a number at most 19.  In the fixed
layouts neither runs on into a value that follows; groups in any other layout
may be taken together with digits after a space.

Separators and spacing do not count as part of a value: ``1234 5678 ...`` and
``1234-5678-...`` are linked.

Scale: expressions only, one narrow pass, no shuffle; a text without digits and
``@`` is passed on after one scan.

Defined cases: a null text stays null; empty texts and texts without a value
are unchanged byte for byte; any other column is carried unchanged by
``pseudonymised``; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
CYCLE_DAYS, _A, _B = 146097, 189, 773
#: steps to a date of the same layout: at least 22 % of all dates are, so all but 1e-27 end
WALK = 256

DIGITS = "0123456789"
LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
HEX, HEX_UPPER = DIGITS + "abcdef", DIGITS + "ABCDEF"

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_GAP = r"[ .-]?"


def _behind(least: int, most: int) -> str:
    """Between "+" and here are so many digits (Java bounds no repeated group here)."""
    digit, more = r"[0-9][ .()-]{0,2}", ""
    for _ in range(most - least):
        more = f"(?:{digit}{more})?"
    return rf"(?<=\+{digit * least}{more})"


#: after "+": ten digits in fixed groups, or groups of two to four digits with 7
#: to 15 digits in all that end before another value or a year
_PHONE_FIXED = rf"\+(?:1{_GAP}[0-9]{{3}}|[0-9]{{1,3}}{_GAP}\([0-9]{{3}}\)){_GAP}[0-9]{{3}}{_GAP}[0-9]{{4}}"
_OTHER = (rf"{_OCTET}(?:\.{_OCTET}){{3}}(?![0-9])|[0-9]{{1,4}}[./-][0-9]{{1,2}}[./-][0-9]{{2,4}}(?![0-9])|[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}"
          rf"|[0-9]{{13}}|[0-9]{{4}}(?:[ -][0-9]{{4}}){{3}}|[0-9]{{4}}[ -][0-9]{{6}}[ -][0-9]{{5}}|{_behind(11, 15)}(?:19|20)[0-9]{{2}}(?![0-9]|[ .-][0-9])")
_PHONE_FREE = (rf"\+[0-9]{{1,3}}{_GAP}(?:\([0-9]{{2,4}}\)|[0-9]{{2,4}})(?:(?:[.-]?| (?!{_OTHER}))[0-9]{{2,4}}){{1,4}}"
               rf"{_behind(7, 15)}")
#: formats in order of precedence; none matches the empty string
FORMATS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "secret": r"(?<![A-Za-z0-9])[0-9A-Fa-f]{32,}(?![A-Za-z0-9])",
    "ip": rf"(?<![0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9]|\.[0-9])",
    "date": r"(?<![0-9./-])(?:[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([/.])[0-9]{1,2}\2[0-9]{4})(?![0-9]|[./-][0-9])",
    "phone": rf"(?<![0-9+])(?:(?:{_PHONE_FIXED}|{_PHONE_FREE})(?![0-9]|[.-][0-9])|(?:{_PHONE_FIXED}|{_PHONE_FREE})(?![0-9])"
             r"|(?:\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9]))",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    # compact, in fours, as 4-6-5, or grouped in any other way
    "number": r"(?<![0-9])(?![0-9]{1,6} [0-9]{13,19}(?![0-9])|(?:19|20)[0-9]{2}(?: [0-9]{4}){4}(?![0-9]))"
              r"(?:[0-9]{13,19}|[0-9]{4}(?:[ -]?[0-9]{4}){3}(?:[ -][0-9]{1,3}(?![0-9]|[ ./-][0-9]))?|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}"
              r"|[0-9](?:[ -]?[0-9]){12,18}(?![0-9]|[./-][0-9])|[0-9](?:[ -]?[0-9]){12,18})(?![0-9])",
    "local": r"(?<![0-9-])[0-9]{3}-[0-9]{4}(?![0-9]|-[0-9])",
}


def _pattern() -> str:
    """All formats as alternatives, their back references renumbered."""
    out, groups = [], 0
    for p in FORMATS.values():
        own = p.count("([")  # the capturing groups: a set of separators each
        for g in range(own, 0, -1):
            p = p.replace(f"\\{g}", f"\\{g + groups}")
        groups += own
        out.append(p)
    return "|".join(f"(?:{p})" for p in out)


ANY = _pattern()


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _chars(s: Column) -> Column:
    return F.when(F.length(s) > 0, F.transform(F.sequence(F.lit(1), F.length(s)), lambda j: F.substring(s, j, F.lit(1)))
                  ).otherwise(F.array().cast("array<string>"))


def _stream(key: str, domain: str | Column, step: Column, half: Column) -> Column:
    """128 hexadecimal digits that depend on all arguments."""
    return F.sha2(F.concat_ws("\x1f", F.lit(key), domain if isinstance(domain, Column) else F.lit(domain), step.cast("string"), half, F.lit(key)), 512)


def _at(stream: Column, j: Column) -> Column:
    """Number j of a stream: four hexadecimal digits."""
    return F.conv(F.substring(stream, (j % 32) * 4 + 1, F.lit(4)), 16, 10).cast("int")


def _shifted(s: Column, stream: Column, alphabets: tuple[str, ...], sign: int) -> Column:
    def one(c: Column, j: Column) -> Column:
        out = c
        for a in alphabets:
            place = F.position(c, F.lit(a))
            moved = F.pmod(place - 1 + sign * _at(stream, j), F.lit(len(a)))
            out = F.when(place > 0, F.substring(F.lit(a), moved + 1, F.lit(1))).otherwise(out)
        return out

    return F.array_join(F.transform(_chars(s), one), "")


def permuted(s: Column, key: str, domain: str | Column, alphabets: tuple[str, ...], inverse: bool = False) -> Column:
    """Feistel permutation of a string within the alphabets of its characters."""
    half = F.floor(F.length(s) / 2).cast("int")
    start = F.struct(F.substring(s, F.lit(1), half).alias("l"), F.substring(s, half + 1, F.length(s)).alias("r"))
    steps = F.sequence(F.lit(0), F.lit(ROUNDS - 1))

    def forward(x: Column, i: Column) -> Column:
        moved = _let(_stream(key, domain, i, x["r"]), lambda k: _shifted(x["l"], k, alphabets, 1))
        return F.struct(x["r"].alias("l"), moved.alias("r"))

    def backward(x: Column, i: Column) -> Column:
        moved = _let(_stream(key, domain, ROUNDS - 1 - i, x["l"]), lambda k: _shifted(x["r"], k, alphabets, -1))
        return F.struct(moved.alias("l"), x["l"].alias("r"))

    return F.aggregate(steps, start, backward if inverse else forward, lambda x: F.concat(x["l"], x["r"]))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _refilled(layout: Column, digits: Column) -> Column:
    """``layout`` with its digits replaced, in order, by ``digits``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))
    return F.aggregate(_chars(layout), start, lambda x, c: F.when(
        c.rlike("[0-9]"), F.struct(F.concat(x["out"], F.substring(digits, x["k"], F.lit(1))).alias("out"),
                                   (x["k"] + 1).alias("k"))
    ).otherwise(F.struct(F.concat(x["out"], c).alias("out"), x["k"].alias("k"))), lambda x: x["out"])


def luhn_digit(payload: Column) -> Column:
    """The digit that makes ``payload`` + digit pass the Luhn check."""
    total = F.aggregate(_chars(F.reverse(payload)), F.struct(F.lit(0).alias("sum"), F.lit(True).alias("twice")),
                        lambda x, c: _let(c.cast("int"), lambda d: F.struct(
                            (x["sum"] + F.when(x["twice"], F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)).alias("sum"),
                            (~x["twice"]).alias("twice"))), lambda x: x["sum"])
    return F.pmod(-total, F.lit(10))


def _number(m: Column, key: str, inverse: bool) -> Column:
    def of(d: Column) -> Column:
        payload = F.substring(d, F.lit(1), F.length(d) - 1)
        off = F.substring(d, F.length(d), F.lit(1)).cast("int") - luhn_digit(payload)
        return _let(permuted(payload, key, "number", (DIGITS,), inverse), lambda p: F.concat(
            p, F.pmod(luhn_digit(p) + off, F.lit(10)).cast("string")))

    return _refilled(m, _let(_digits(m), of))


def _phone(m: Column, key: str, inverse: bool) -> Column:
    country = F.regexp_extract(m, r"^(\+[0-9]{1,3}(?=[ .(-])|\+1|\+[0-9]{2}|)", 1)
    rest = F.substring(m, F.length(country) + 1, F.length(m))
    return F.concat(country, _refilled(rest, permuted(_digits(rest), key, "phone", (DIGITS,), inverse)))


def _ip(m: Column, key: str, inverse: bool) -> Column:
    bits = F.array_join(F.transform(F.split(m, r"\."), lambda o: F.lpad(F.lower(F.conv(o, 10, 16)), 2, "0")), "")
    moved = permuted(bits, key, "ip", (HEX,), inverse)
    return _let(moved, lambda h: F.array_join(F.transform(
        F.sequence(F.lit(1), F.lit(7), F.lit(2)), lambda j: F.conv(F.substring(h, j, F.lit(2)), 16, 10)), "."))


def _date(m: Column, key: str, inverse: bool) -> Column:
    """The date moved within its 400-year cycle; null if it is no valid date."""
    sep = F.regexp_extract(m, r"([-/.])", 1)
    iso = m.rlike(r"^[0-9]{4}")
    p = F.split(m, r"[-/.]")
    year, month, day = [F.when(iso, F.element_at(p, i)).otherwise(F.element_at(p, 4 - i)) for i in (1, 2, 3)]

    def read(mo: Column, da: Column) -> Column:
        text = F.concat_ws("-", year, F.lpad(mo, 2, "0"), F.lpad(da, 2, "0"))
        found = F.when(year != "0000", F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date"))
        return F.datediff(found, F.lit("1800-01-01").cast("date"))

    plain, swapped = read(month, day), F.when(~iso & (sep == "/"), read(day, month))
    days, us = F.coalesce(plain, swapped), plain.isNull()
    # widths of month and day as they are written
    wide_mo, wide_da = [F.length(F.when(us, a).otherwise(b)) == 2 for a, b in ((day, month), (month, day))]
    steps = F.sequence(F.lit(0), F.lit(ROUNDS - 1))

    def moved(n: Column) -> Column:
        inside = F.pmod(n, F.lit(CYCLE_DAYS))
        start = F.struct(F.floor(inside / _B).cast("int").alias("a"), (inside % _B).cast("int").alias("b"))

        def one(x: Column, i: Column) -> Column:
            i = ROUNDS - 1 - i if inverse else i
            k = lambda half: (-1 if inverse else 1) * _at(_stream(key, "date", i, half.cast("string")), F.lit(0))
            return F.when(i % 2 == 0, F.struct(F.pmod(x["a"] + k(x["b"]), F.lit(_A)).alias("a"), x["b"].alias("b"))
                          ).otherwise(F.struct(x["a"].alias("a"), F.pmod(x["b"] + k(x["a"]), F.lit(_B)).alias("b")))

        to = F.aggregate(steps, start, one, lambda x: x["a"] * _B + x["b"])
        return F.date_add(F.lit("1800-01-01").cast("date"), (n - inside + to).cast("int"))

    def fits(d: Column) -> Column:
        return (wide_mo | (F.month(d) < 10)) & (wide_da | (F.dayofmonth(d) < 10)) & (~us | (F.dayofmonth(d) > 12))

    def walked(d: Column) -> Column:
        again = F.when(wide_mo & wide_da & ~us, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), F.lit(WALK)))
        return F.aggregate(again, d, lambda x, _: F.when(fits(x), x).otherwise(
            moved(F.datediff(x, F.lit("1800-01-01").cast("date")))))

    def written(d: Column) -> Column:
        y = F.date_format(d, "yyyy")
        mo, da = (F.when(wide, F.date_format(d, two)).otherwise(F.date_format(d, one))
                  for wide, two, one in ((wide_mo, "MM", "M"), (wide_da, "dd", "d")))
        return (F.when(iso, F.concat(y, sep, mo, sep, da)).when(us, F.concat(mo, sep, da, sep, y))
                .otherwise(F.concat(da, sep, mo, sep, y)))

    return F.when(days.isNotNull(), _let(walked(moved(days)), written))


def _secret(m: Column, key: str, inverse: bool) -> Column:
    """Lower or upper case over 16 characters, mixed case within digits and letters."""
    def of(alphabets: tuple[str, ...]) -> Column:
        pieces = F.transform(F.regexp_extract_all(m, F.lit(".{1,64}"), F.lit(0)), lambda s, i: permuted(
            s, key, F.when(i == 0, "secret").otherwise(F.concat(F.lit("secret "), i.cast("string"))), alphabets, inverse))
        return F.array_join(pieces, "")

    lower, upper = m.rlike("[a-f]"), m.rlike("[A-F]")
    return (F.when(lower & upper, of((DIGITS, "abcdef", "ABCDEF"))).when(lower, of((HEX,))).otherwise(of((HEX_UPPER,))))


def pseudonym(m: Column, key: str, inverse: bool = False) -> Column:
    """The pseudonym of one found value (itself if it does not validate)."""
    is_a = {name: m.rlike(f"^(?:{p})$") for name, p in FORMATS.items()}
    local = F.regexp_extract(m, "^([^@]*)@", 1)
    email = F.concat(permuted(local, key, "email", (DIGITS, LOWER, UPPER), inverse),
                     F.substring(m, F.length(local) + 1, F.length(m)))
    digits = lambda name: _refilled(m, permuted(_digits(m), key, name, (DIGITS,), inverse))
    return (F.when(is_a["email"], email)
            .when(is_a["secret"], _secret(m, key, inverse))
            .when(is_a["ip"], _ip(m, key, inverse))
            .when(is_a["date"], F.coalesce(_date(m, key, inverse), m))
            .when(is_a["phone"], _phone(m, key, inverse))
            .when(is_a["ssn"], digits("ssn"))
            .when(is_a["number"], _number(m, key, inverse))
            .otherwise(digits("local")))


def values(text: Column) -> Column:
    """All values found in a text, in order."""
    return F.when(text.rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(
        F.array().cast("array<string>"))


def pseudonymised(docs: DataFrame, key: str, text_col: str = "text", inverse: bool = False) -> DataFrame:
    """``docs`` with the values in ``text_col`` replaced; same columns and rows."""
    text = F.col("doc")[text_col]
    found = docs.select(F.struct("*").alias("doc")).withColumn("found", values(text))
    parts = F.split(text, ANY, -1)
    swapped = F.concat(F.transform("found", lambda m: pseudonym(m, key, inverse)), F.array(F.lit("")))
    new = F.when(F.size("found") > 0, F.array_join(F.zip_with(parts, swapped, lambda a, b: F.concat(a, b)), "")).otherwise(text)
    return found.select(*[new.alias(c) if c == text_col else F.col("doc")[c].alias(c) for c in docs.columns])
