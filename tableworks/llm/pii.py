"""Format-preserving pseudonyms for personal data, in DataFrame functions only.

Card numbers (Luhn), phone numbers, social security numbers, IPv4 addresses
(octet range) and dates (calendar) are found by one regular expression and
validated; what fails its check stays as it is.  A valid value is replaced by a
keyed permutation of its own format: its digits go through an alternating
Feistel network whose halves are added to modulo 10^u and 10^v (2^16 for
addresses, 270 for dates), so the pseudonym has the same length and
punctuation, passes the same validation, and equal values get equal pseudonyms
in all documents.  Without the key the permutation can't be undone; with it,
``inverse=True`` restores the values.  An e-mail address has no numeric format;
it becomes a keyed digest.

Forms that are found: ISO dates, also before a time (``T10:00``), dd.MM.yyyy and
dd/MM/yyyy; what can't be dd/MM/yyyy is read as MM/dd/yyyy and permuted among the
dates that can't either, so it reads the same way again.  Phone numbers with a
country code (8 to 15 digits, in one run, in groups of 3 and 4, or in pairs), and
national ones with an area code: in parentheses, as 3-3-4 digits, or with a
leading 0 (groups of 3 and 4, pairs, or one group behind the area code).  Local
numbers without area code, dates with one-digit or named parts or two-digit
years, and dates before 1900 or after spring 2099 stay.

Everything is evaluated inside the row: no shuffle, no join.

Defined results: a null text stays null, an empty one empty; a text without
findings is returned unchanged; equal rows give equal rows; an empty table gives
an empty one; all other columns, whatever their names, pass unchanged (except
that ``with_counts`` adds columns and refuses names already there).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
DEFAULT_KEY = "tableworks-pseudonyms"  # a parameter: production passes its own secret

# The formats.  Java regular expressions; possessive quantifiers
# and look-behinds keep them linear in the text.
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@(?:[\p{L}\p{N}-]++\.){1,126}\p{L}{2,}+"
IPV4 = r"(?<![\w.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\w]|\.\d)"
_ABROAD = (
    r"\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
    r"|\+\d{1,3}(?:[ .-]?\(0\))?[ .-]?(?:\(\d{2,4}\)|\d{1,4})(?:(?:[ .-]\d{2}){3,5}|(?:[ .-]\d{3}){3}|(?:[ .-]?\d{3,4}){2}|[ .-]\d{5,8})(?!\d)"
    r"|\+\d{8,15}(?!\d)"
)
_AT_HOME = (
    r"\(\d{2,5}\)[ .-]?(?:\d{3,4}[ .-]?\d{3,4}|\d{2}(?:[ .-]\d{2}){2,3}|\d{5})(?![\w]|[.-]\d)"
    r"|(?:1[ .-])?\d{3}(?: \d{3} |-\d{3}-|\.\d{3}\.)\d{4}(?![\w]|[ .-]\d)"
    r"|0\d(?:[ .-]\d{2}){4}(?![\w]|[ .-]\d)"
    r"|0\d{2,4}(?:[ /-]\d{3,4}[ -]\d{3,4}|[ /-]\d{6,8})(?![\w]|[ .-]\d)"
)
PHONE = rf"(?<![\w+])(?:{_ABROAD})|(?<![\w.+/-])(?<!\d )(?:{_AT_HOME})"
DATE = r"(?<![\w./-])(?:\d{4}-\d{2}-\d{2}(?=[Tt]\d{2})|(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![\w]|[./-]\d))"
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w]|-\d)"
CARD = r"(?<![\w.])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}[ -]\d{6}[ -]\d{5})(?![\w]|-\d)"
KINDS = {"email": EMAIL, "ipv4": IPV4, "phone": PHONE, "date": DATE, "ssn": SSN, "card": CARD}
FINDINGS = "|".join(f"(?:{p})" for p in KINDS.values())
FIRST_DAY, DAY_BASE = "1900-01-01", 270  # dates are permuted within 270 * 270 days
LATE_BASE = 210  # and those after the 12th of a month, where they are MM/dd/yyyy, within 210 * 210

_DIGITS = "0123456789"


def _keyed(key: str, tweak: str, step: Column, value: Column) -> Column:
    """A keyed pseudo-random number below 2^60."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(tweak), step.cast("string"), value.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def feistel(left: Column, right: Column, left_base: Column, right_base: Column, key: str, tweak: str, inverse: bool = False) -> Column:
    """A struct (l, r): the pair permuted within [0, left_base) x [0, right_base).

    Even rounds add a keyed function of the right half to the left, odd rounds
    the other way round; the inverse subtracts in reverse order.
    """
    steps = F.sequence(F.lit(ROUNDS - 1), F.lit(0), F.lit(-1)) if inverse else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    sign = -1 if inverse else 1

    def turn(acc: Column, i: Column) -> Column:
        l, r = acc["l"], acc["r"]
        on_left = i % 2 == 0
        f = _keyed(key, tweak, i, F.when(on_left, r).otherwise(l))
        base = F.when(on_left, left_base).otherwise(right_base)
        moved = F.pmod(F.when(on_left, l).otherwise(r) + sign * F.pmod(f, base), base)
        return F.struct(F.when(on_left, moved).otherwise(l).alias("l"), F.when(on_left, r).otherwise(moved).alias("r"))

    return F.aggregate(steps, F.struct(left.cast("long").alias("l"), right.cast("long").alias("r")), turn)


def permute_digits(digits: Column, key: str, tweak: str, inverse: bool = False) -> Column:
    """A string of 2 to 18 digits permuted among the strings of its length."""
    n = F.length(digits)
    u = (n / 2).cast("int")
    base_l, base_r = F.pow(F.lit(10.0), u).cast("long"), F.pow(F.lit(10.0), n - u).cast("long")
    tweaked = F.transform(
        F.array(feistel(F.substring(digits, F.lit(1), u), F.substring(digits, u + 1, n - u), base_l, base_r, key, tweak, inverse)),
        lambda p: F.concat(F.lpad(p["l"].cast("string"), u, "0"), F.lpad(p["r"].cast("string"), n - u, "0")),
    )
    return tweaked[0]


def only_digits(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "")


def refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, in order, by ``digits``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))

    def put(acc: Column, c: Column) -> Column:
        is_digit = c.between("0", "9") & (F.length(c) == 1)
        return F.struct(
            F.concat(acc["out"], F.when(is_digit, F.substring(digits, acc["k"], F.lit(1))).otherwise(c)).alias("out"),
            (acc["k"] + F.when(is_digit, 1).otherwise(0)).alias("k"),
        )

    return F.aggregate(F.split(shape, ""), start, put, lambda acc: acc["out"])


def luhn_sum(digits: Column) -> Column:
    """Luhn's sum with the last digit counted once."""
    chars = F.split(F.reverse(digits), "")

    def weigh(c: Column, i: Column) -> Column:
        d = c.cast("int")
        doubled = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(doubled > 9, doubled - 9).otherwise(doubled))

    return F.aggregate(F.transform(chars, weigh), F.lit(0), lambda a, x: a + x)


def _card(m: Column, key: str, inverse: bool) -> Column:
    """All digits but the check digit are permuted; the check digit follows."""
    digits = only_digits(m)
    body = permute_digits(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card", inverse)
    check = F.transform(F.array(body), lambda b: F.concat(b, F.pmod(10 - luhn_sum(F.concat(b, F.lit("0"))) % 10, F.lit(10)).cast("string")))[0]
    return F.when(luhn_sum(digits) % 10 == 0, F.transform(F.array(check), lambda d: refill(m, d))[0])


def _digits_after(prefix: str, tweak: str) -> Callable[[Column, str, bool], Column]:
    """Permutes the digits behind ``prefix`` (a country code), within the shape."""

    def run(m: Column, key: str, inverse: bool) -> Column:
        head = F.regexp_extract(m, prefix, 0)
        rest = F.substring(m, F.length(head) + 1, F.length(m))
        fresh = permute_digits(only_digits(rest), key, tweak, inverse)
        return F.concat(head, F.transform(F.array(fresh), lambda d: refill(rest, d))[0])

    return run


# a country code (with its (0)), the trunk's 1, or the leading 0 (which 3-3-4 digits need not have)
_phone = _digits_after(r"^\+\d{1,3}[ .-]?\(0\)|^\+\d{1,3}(?=[ .(-])|^\+\d|^1(?=[ .-])|^0(?!\d\d([ .-])\d{3}\1\d{4}$)", "phone")


def _ssn(m: Column, key: str, inverse: bool) -> Column:
    return _digits_after("^", "ssn")(m, key, inverse)


def _ipv4(m: Column, key: str, inverse: bool) -> Column:
    o = F.transform(F.split(m, r"\."), lambda x: x.cast("int"))
    valid = F.forall(o, lambda x: x <= 255)
    base = F.lit(65536).cast("long")
    pair = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], base, base, key, "ipv4", inverse)
    text = F.transform(
        F.array(pair),
        lambda p: F.concat_ws(".", *[x.cast("string") for h in (p["l"], p["r"]) for x in (F.shiftright(h, 8), h % 256)]),
    )[0]
    return F.when(valid, text)


def _date(m: Column, key: str, inverse: bool) -> Column:
    formats = (("-", "yyyy-MM-dd"), ("/", "dd/MM/yyyy"), (".", "dd.MM.yyyy"))
    out = None
    for sign, fmt in formats:
        # taken apart by hand: an impossible date is null in every ANSI mode
        y, d = (F.substring(m, 1, 4), F.substring(m, 9, 2)) if sign == "-" else (F.substring(m, 7, 4), F.substring(m, 1, 2))
        mo = F.substring(m, 6, 2) if sign == "-" else F.substring(m, 4, 2)
        day = F.concat_ws("-", y, mo, d).try_cast("date")
        n = F.datediff(day, F.lit(FIRST_DAY).cast("date"))
        base = F.lit(DAY_BASE).cast("long")
        pair = feistel((n / DAY_BASE).cast("int"), n % DAY_BASE, base, base, key, "date", inverse)
        fresh = F.transform(F.array(pair), lambda p: F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), (p["l"] * DAY_BASE + p["r"]).cast("int")), fmt))[0]
        mine = m.contains(sign)
        value = F.when(n.between(0, DAY_BASE * DAY_BASE - 1), fresh)
        out = F.when(mine, value) if out is None else out.when(mine, value)
    return F.coalesce(out, F.when(m.contains("/"), _month_first(m, key, inverse)))


def _month_first(m: Column, key: str, inverse: bool) -> Column:
    """An MM/dd/yyyy date whose day is after the 12th, permuted among such dates.

    Their rank leaves out 12 days of every month; a rank's month is found by the
    mean of 400 years, which is less than a month off.
    """
    origin, base = F.lit(FIRST_DAY).cast("date"), F.lit(LATE_BASE).cast("long")
    day = F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 1, 2), F.substring(m, 4, 2)).try_cast("date")
    months = (F.year(day) - 1900) * 12 + F.month(day)
    rank = F.when(F.dayofmonth(day) > 12, F.datediff(day, origin) - 12 * months)
    pair = feistel((rank / LATE_BASE).cast("int"), rank % LATE_BASE, base, base, key, "date", inverse)

    def written(r: Column) -> Column:
        near = F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda i: F.add_months(origin, (F.floor(r / 18.436875) + i).cast("int")))
        starts = F.transform(near, lambda d: F.struct((F.datediff(d, origin) - 12 * F.floor(F.months_between(d, origin)).cast("int")).alias("rank"), d.alias("day")))
        return F.transform(
            F.array(F.array_max(F.filter(starts, lambda x: x["rank"] <= r))),
            lambda x: F.date_format(F.date_add(x["day"], (12 + r - x["rank"]).cast("int")), "MM/dd/yyyy"),
        )[0]

    fresh = F.transform(F.array(pair), lambda p: written(p["l"] * LATE_BASE + p["r"]))[0]
    return F.when(rank.between(0, LATE_BASE * LATE_BASE - 1), fresh)


def _email(m: Column, key: str, inverse: bool) -> Column:
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(m)), 256)
    return m if inverse else F.concat(F.lit("user"), F.substring(digest, 1, 16), F.lit("@mail.invalid"))


def kind_of(m: Column) -> Column:
    """Which format a match has; the patterns exclude each other by their signs."""
    return (
        F.when(m.contains("@"), "email")
        .when(m.startswith("+") | m.rlike(f"^(?:{_AT_HOME})$"), "phone")
        .when(m.rlike(r"^\d{4}-\d{2}-\d{2}$|^\d{2}/\d{2}/\d{4}$|^\d{2}\.\d{2}\.\d{4}$"), "date")
        .when(m.contains("."), "ipv4")
        .when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .otherwise("card")
    )


_REPLACE = {"email": _email, "phone": _phone, "date": _date, "ipv4": _ipv4, "ssn": _ssn, "card": _card}


def pseudonym(m: Column, key: str, inverse: bool = False) -> Column:
    """The pseudonym of a match; null if the match isn't valid."""
    kind, out = kind_of(m), None
    for name, replace in _REPLACE.items():
        value = replace(m, key, inverse)
        out = F.when(kind == name, value) if out is None else out.when(kind == name, value)
    return out


def pseudonymize(
    docs: DataFrame, text_col: str = "text", key: str = DEFAULT_KEY, with_counts: bool = False, inverse: bool = False
) -> DataFrame:
    """``docs`` with the personal data of ``text_col`` replaced.

    ``with_counts`` adds ``n_<kind>``: how many values of each kind were replaced.
    """
    names = [f"n_{k}" for k in KINDS]
    if with_counts and set(names) & set(docs.columns):
        raise ValueError(f"columns already there: {sorted(set(names) & set(docs.columns))}")
    text = F.col(f"`{text_col}`")
    has = text.rlike("[0-9@]")
    found = F.when(has, F.regexp_extract_all(text, F.lit(FINDINGS), F.lit(0)))
    # struct per match: what it was, what it becomes (null: stays)
    pairs = F.transform(found, lambda m: F.struct(m.alias("was"), pseudonym(m, key, inverse).alias("now")))
    work = docs.withColumn("__pairs", pairs)
    pair = F.col("__pairs")
    gaps = F.split(text, FINDINGS, -1)
    fills = F.concat(F.transform(pair, lambda p: F.coalesce(p["now"], p["was"])), F.array(F.lit("")))
    joined = F.array_join(F.zip_with(gaps, fills, lambda g, f: F.concat(g, f)), "")
    out = {text_col: F.when(F.size(pair) > 0, joined).otherwise(text)}
    if with_counts:
        for k in KINDS:
            hit = F.filter(pair, lambda p: p["now"].isNotNull() & (kind_of(p["was"]) == k))  # noqa: B023
            out[f"n_{k}"] = F.coalesce(F.size(hit), F.lit(0)).cast("long")
            out[f"n_{k}"] = F.when(pair.isNull(), F.lit(0).cast("long")).otherwise(out[f"n_{k}"])
    return work.withColumns(out).drop("__pairs")
