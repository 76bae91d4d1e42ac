"""Format-preserving pseudonyms for personal data, in DataFrame functions only.

Candidates are found by regular expressions and validated by kind:

* ``card``: 13 to 19 digits (single blanks or hyphens between groups of any
  size) with a correct check digit;
* ``iban``: country, check digits and account with remainder 1 of 97, in the
  length of the country;
* ``ssn``: 3-2-4 digits of an assignable number;
* ``phone``: North American numbers (assignable, or written with a plus sign or
  brackets), and other international numbers with a plus sign;
* ``ipv4``: four octets;
* ``ipv6``: eight groups, or fewer around one ``::`` with a digit among them;
* ``date``: a calendar date from 1900 to 2099, written year-month-day (a time
  may follow behind a T) or day.month.year or day/month/year, and
  month/day/year where it cannot be day/month/year;
* ``email``: local part and domain, of any script;
* ``secret``: access keys and tokens with a known beginning; what is assigned to
  a password, passphrase, token, secret or api key, in capitals or not: 16
  letters and digits or more, or 16 characters (for passwords 6) or more with a
  letter and a digit among them.

Each value is permuted within its own format by a keyed Feistel network: its
digits are read as a pair of numbers (left, right) modulo sizes that cover
exactly the valid values, and rounds add a keyed hash of the one side to the
other. That is a bijection, so different values keep different pseudonyms and
equal values, in whatever document, the same one; ``invert=True`` takes it back. Check
digits are computed anew, so pseudonyms validate again. Dates are permuted as
day numbers; month/day/year dates among those that can be nothing else. An
``ipv6`` is permuted as 128 bits and written out in full, so that ``invert``
gives the address, not its short form. Separators stay where they are; digits are compared without them,
so the same number written in two ways stays linked. An address has no number
format: its local part becomes a keyed hash (not invertible) and its domain a
reserved one. A secret becomes keyed hex digits of the same length.

Candidates that fail validation are left as they are, and numbers inside or
across them are tried. Of overlapping valid numbers the first one counts, at one
place the first kind in the order of ``NUMBERS`` and the longest. A pseudonym
depends on its value alone, so it can happen to make an overlapping number in
front of it valid; ``invert`` then needs the column ``pii``.

The key reaches the executors as the value of a scalar subquery: neither
``explain()`` nor the event log shows it.

Not found, as the writing does not tell them from other numbers or words: bare
ten-digit phone numbers, passwords without a digit, names and postal addresses.

Defined cases: null text stays null with no findings; empty text stays empty;
values next to letters or digits are no candidates; the result columns
``n_pii`` and ``pii`` (kind and pseudonym in order) replace columns of the same
name.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordmill.llm.common import quoted, unused_name

ROUNDS = 8
# Spark itself redacts settings with "secret" in their name in its event log.
KEY_CONF = "spark.wordmill.pii.secret"
DEMO_KEY = f"demonstration key; set {KEY_CONF}"

LOCAL = r"\p{L}\p{M}\p{N}._%+-"
EMAIL = rf"[{LOCAL}]++@[\p{{L}}\p{{M}}\p{{N}}-]++(?:\.[\p{{L}}\p{{M}}\p{{N}}-]++)+"
# What tokens of well-known services begin with.
MARKED = r"A[KS]IA(?=[0-9A-Z]{16})|gh[opsur]_(?=[A-Za-z0-9]{16})|github_pat_|glpat-|xox[abeprs]-|sk-(?=[A-Za-z0-9_-]*[0-9])|eyJ(?=[A-Za-z0-9_-]+\.eyJ)"
PASSWORD = r"(?i:password|passwd|passphrase|pwd)"
NAMED = r"(?i:password|passwd|passphrase|pwd|token|secret|api[_-]?key|access[_-]?key)"
ASSIGNED = r"[\"']? ?[=:] ?[\"']?"
MIXED = r"(?=[^\s\"',;]*[0-9])(?=[^\s\"',;]*[A-Za-z])"
LONG = r"[A-Za-z0-9_+/=~.-]{15,}[A-Za-z0-9_=+/-]"
SECRET = (
    rf"(?:{MARKED})[A-Za-z0-9_-]{{10,}}+(?:\.[A-Za-z0-9_-]{{10,}}+)*|{PASSWORD}{ASSIGNED}(?!/){MIXED}[^\s\"',;]{{5,}}[^\s\"',;.:)]"
    rf"|{NAMED}{ASSIGNED}(?!/)(?:{MIXED}{LONG}|[A-Za-z0-9]{{16,}}+)(?![A-Za-z0-9_@]|[.-][0-9])"
)
# Addresses and credentials, of any length; they are cut out of the text first.
TEXTS = rf"(?<![{LOCAL}])(?:{EMAIL})(?!@)|(?<![A-Za-z0-9])(?:{SECRET})"

IBAN_COUNTRIES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_spans() -> list[str]:
    """Countries of the list by their length, other countries by any."""
    listed, by_length = "|".join(" ".join(IBAN_COUNTRIES.values()).split()), []
    for length, countries in IBAN_COUNTRIES.items():
        fours, rest = divmod(length - 4, 4)
        tail = f" ?[A-Z0-9]{{{rest}}}" if rest else ""
        by_length.append(f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{fours}}}{tail}")
    other = f"(?!{listed})[A-Z]{{2}}[0-9]{{2}}"
    ends = [f"(?: ?[A-Z0-9]{{4}}){{{n}}}{tail}" for n in range(7, 1, -1) for tail in (" ?[A-Z0-9]{1,3}", "")]
    return ["(?=[A-Z]{2}[0-9]{2})(?:" + "|".join(by_length) + ")"] + [other + end for end in ends]


# For each kind of number the spans that a candidate may have, in the order in
# which they are tried; a span ends where AFTER holds.
SPANS = {
    "date": [r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4}"],
    "ipv4": [r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"],
    "ipv6": [
        r"[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}",
        r"(?=[A-Fa-f:]*[0-9])(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?",
    ],
    "ssn": [r"[0-9]{3}-[0-9]{2}-[0-9]{4}"],
    "phone": [r"(?:\+1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"]
    + [rf"\+[0-9]{{1,3}}(?:[ .-]?[0-9]{{2,5}}){{{n}}}" for n in range(5, 1, -1)],
    "iban": _iban_spans(),
    "card": [rf"[0-9](?:[ -]?[0-9]){{{n - 1}}}" for n in range(19, 12, -1)],
}
# No letter, digit or part of a longer number around a candidate.
BEFORE = r"(?<![A-Za-z0-9])(?<![0-9][.-])"
AFTER = r"(?![A-Za-z0-9@]|[.-][0-9])"
# A time may follow a date, and no further group an address.
AFTER_KIND = {"date": r"(?![A-SU-Za-z0-9@]|T(?![0-9]{2})|[.-][0-9])", "ipv6": AFTER + r"(?!:[0-9A-Fa-f:])"}
# What a kind's spans have in common, to try them only there.
QUICK = {kind: "(?:" + "|".join(f"(?:{s})" for s in spans) + ")" + AFTER_KIND.get(kind, AFTER) for kind, spans in SPANS.items()} | {
    "card": "[0-9](?:[ -]?[0-9]){12,18}" + AFTER,
    "ipv6": "(?<!:)" + "(?:" + "|".join(f"(?:{s})" for s in SPANS["ipv6"]) + ")" + AFTER_KIND["ipv6"],
}
# The places where candidates start, overlapping ones too: texts are cut there.
# The first look ahead only saves time.
STARTS = "(?=[0-9+(]|[A-Z]{2}[0-9]|[A-Fa-f0-9]{0,4}:[0-9A-Fa-f:])" + BEFORE + "(?=" + "|".join(QUICK.values()) + ")"
WINDOW = 64  # characters; no span is longer than 42

FIRST_DAY = "1900-01-01"
DAY_SIZES = (17, 4297)  # 73,049 days to 2099-12-31
LATE_SIZES = (59, 750)  # 44,249 of these days and one: behind the 12th of a month


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def keyed_hash(key: str | Column, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), *parts), 256)


def keyed_number(key: str | Column, *parts: Column) -> Column:
    """A keyed 60-bit hash of the parts."""
    hashed = keyed_hash(key, *(p.cast("string") for p in parts))
    return F.conv(F.substring(hashed, 1, 15), 16, 10).cast("bigint")


def feistel(left: Column, right: Column, size_left: Column, size_right: Column, tweak: Column, key: str | Column, invert: bool) -> Column:
    """``struct(l, r)``: the pair permuted within its sizes. Odd rounds change
    the left side by a hash of the right, even rounds the other way round."""
    rounds = F.sequence(F.lit(ROUNDS), F.lit(1), F.lit(-1)) if invert else F.sequence(F.lit(1), F.lit(ROUNDS))
    sign = -1 if invert else 1

    def turn(pair: Column, n: Column) -> Column:
        odd = n % 2 == 1
        by_right = F.pmod(pair["l"] + sign * (keyed_number(key, tweak, n, pair["r"]) % size_left), size_left)
        by_left = F.pmod(pair["r"] + sign * (keyed_number(key, tweak, n, pair["l"]) % size_right), size_right)
        return F.struct(F.when(odd, by_right).otherwise(pair["l"]).alias("l"), F.when(odd, pair["r"]).otherwise(by_left).alias("r"))

    start = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))
    return F.aggregate(rounds, start, turn)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _padded(number: Column, width: Column) -> Column:
    text = number.cast("string")
    return F.concat(F.repeat(F.lit("0"), (width - F.length(text)).cast("int")), text)


def permute_digits(digits: Column, tweak: Column, key: str | Column, invert: bool) -> Column:
    """Digits of the same number, for any number of 2 to 36 digits."""
    n = F.length(digits)
    half = F.floor(n / 2).cast("int")
    rest = (n - half).cast("int")
    size = lambda k: F.pow(F.lit(10.0), k).cast("bigint")  # noqa: E731  exact up to 10**18
    left = F.substr(digits, F.lit(1), half).cast("bigint")
    right = F.substr(digits, half + 1, rest).cast("bigint")
    mixed = feistel(left, right, size(half), size(rest), F.concat_ws("/", tweak, n), key, invert)
    return _let(mixed, lambda p: F.concat(_padded(p["l"], half), _padded(p["r"], rest)))


def into_format(original: Column, digits: Column) -> Column:
    """``original`` with its digits replaced in order."""

    def at(i: Column) -> Column:
        mark = F.substr(original, i, F.lit(1))
        place = F.length(digits_of(F.substr(original, F.lit(1), i)))
        return F.when(mark.between("0", "9"), F.substr(digits, place, F.lit(1))).otherwise(mark)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(original)), at), "")


def luhn_digit(body: Column) -> Column:
    """The check digit that follows ``body``."""
    n = F.length(body)

    def weighted(i: Column) -> Column:
        d = F.substr(body, i, F.lit(1)).cast("int")
        doubled = d * 2
        return F.when((n - i) % 2 == 0, F.when(doubled > 9, doubled - 9).otherwise(doubled)).otherwise(d)

    total = F.aggregate(F.transform(F.sequence(F.lit(1), n), weighted), F.lit(0), lambda a, x: a + x)
    return ((10 - total % 10) % 10).cast("string")


def _card(value: Column, key: str | Column, invert: bool) -> Column:
    digits = digits_of(value)
    body = F.substr(digits, F.lit(1), F.length(digits) - 1)
    new = _let(permute_digits(body, F.lit("card"), key, invert), lambda b: F.concat(b, luhn_digit(b)))
    valid = F.length(digits).between(13, 19) & (luhn_digit(body) == F.substr(digits, F.length(digits), F.lit(1)))
    return F.when(valid, into_format(value, new))


def _mod97(text: Column) -> Column:
    """Remainder by 97 of a string of digits and capital letters (A is 10)."""

    def step(acc: Column, c: Column) -> Column:
        n = F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        return F.when(n > 9, (acc * 100 + n) % 97).otherwise((acc * 10 + n) % 97).cast("int")

    return F.aggregate(F.split(text, ""), F.lit(0), step)


def _iban(value: Column, key: str | Column, invert: bool) -> Column:
    plain = F.replace(value, F.lit(" "), F.lit(""))
    country, account = F.substr(plain, F.lit(1), F.lit(2)), F.substr(plain, F.lit(5), F.length(plain))
    valid = _mod97(F.concat(account, F.substr(plain, F.lit(1), F.lit(4)))) == 1
    digits = digits_of(account)
    new_digits = F.when(F.length(digits) > 1, permute_digits(digits, F.concat(F.lit("iban"), country), key, invert)).otherwise(digits)
    new = into_format(account, new_digits)
    check = _let(new, lambda a: F.lpad((98 - _mod97(F.concat(a, country, F.lit("00")))).cast("string"), 2, "0"))
    return F.when(valid, into_format(value, F.concat(check, digits_of(new))))


def _early_days(month: Column) -> Column:
    """Days behind the 12th from FIRST_DAY to the start of a month (months
    counted from there)."""
    first = F.lit(FIRST_DAY).cast("date")
    return F.date_diff(F.add_months(first, month), first) - 12 * month


def _month_first(day: Column, key: str | Column, invert: bool) -> Column:
    """The days behind the 12th of a month permuted among themselves: they are
    counted without the others. They are one less than the pairs of the network;
    a value that is sent to the pair left over is sent on."""
    a, b = LATE_SIZES
    start = F.lit(FIRST_DAY).cast("date")
    index = F.date_diff(day, start) - 12 * (F.months_between(F.trunc(day, "month"), start).cast("int") + 1)

    def once(i: Column) -> Column:
        mixed = feistel(F.floor(i / b).cast("bigint"), i % b, F.lit(a), F.lit(b), F.lit("month first"), key, invert)
        return _let(mixed, lambda p: p["l"] * b + p["r"])

    def to_date(i: Column) -> Column:
        guess = F.floor(i * 2400 / (a * b - 1)).cast("int")  # 2,400 months; the guess is less than two off
        near = F.sequence(F.greatest(guess - 2, F.lit(0)), F.least(guess + 2, F.lit(2399)))
        month = F.array_max(F.filter(near, lambda m: _early_days(m) <= i))
        return _let(month, lambda m: F.date_add(F.add_months(start, m), (i - _early_days(m) + 12).cast("int")))

    left_over = F.lit(a * b - 1).cast("bigint")
    return _let(_let(once(index), lambda i: F.when(i == left_over, once(left_over)).otherwise(i)), to_date)


def _date(value: Column, key: str | Column, invert: bool) -> Column:
    iso = F.substr(value, F.lit(5), F.lit(1)) == "-"
    mark = F.substr(value, F.lit(3), F.lit(1))
    year, second, first = (F.substr(value, F.lit(i), F.lit(n)) for i, n in ((7, 4), (4, 2), (1, 2)))
    day = F.date_diff(F.when(iso, value).otherwise(F.concat_ws("-", year, second, first)).try_cast("date"), F.lit(FIRST_DAY).cast("date")).cast("bigint")
    a, b = DAY_SIZES
    left, right = F.floor(day / b).cast("bigint"), day % b
    mixed = feistel(left, right, F.lit(a), F.lit(b), F.lit("date"), key, invert)
    new = _let(mixed, lambda p: F.date_add(F.lit(FIRST_DAY).cast("date"), (p["l"] * b + p["r"]).cast("int")))
    text = F.when(iso, F.date_format(new, "yyyy-MM-dd")).otherwise(
        F.concat(F.date_format(new, "dd"), mark, F.date_format(new, "MM"), mark, F.date_format(new, "yyyy"))
    )
    american = F.when((mark == "/") & day.isNull() & year.between("1900", "2099"), F.concat_ws("-", year, first, second).try_cast("date"))
    flipped = F.date_format(_month_first(american, key, invert), "MM/dd/yyyy")
    return F.when(day.between(0, a * b - 1), text).otherwise(F.when(american.isNotNull(), flipped))


def _ipv4(value: Column, key: str | Column, invert: bool) -> Column:
    octets = F.transform(F.split(value, r"\."), lambda o: o.cast("bigint"))
    left, right = (F.element_at(octets, i) * 256 + F.element_at(octets, i + 1) for i in (1, 3))
    mixed = feistel(left, right, F.lit(65536), F.lit(65536), F.lit("ipv4"), key, invert)
    new = _let(mixed, lambda p: F.concat_ws(".", *(x for s in (p["l"], p["r"]) for x in (F.floor(s / 256).cast("string"), (s % 256).cast("string")))))
    return F.when(F.forall(octets, lambda o: o <= 255), new)


def _ipv6(value: Column, key: str | Column, invert: bool) -> Column:
    """All 128 bits, in halves of 64 that are combined by exclusive or."""
    count = lambda text: F.when(text == "", F.lit(0)).otherwise(F.size(F.split(text, ":")))
    head, tail = F.split_part(value, F.lit("::"), F.lit(1)), F.split_part(value, F.lit("::"), F.lit(2))
    left_out = 8 - count(head) - count(tail)
    zeros = F.repeat(F.lit("0:"), F.greatest(left_out, F.lit(0)))
    full = F.when(value.contains("::"), F.concat(F.when(head == "", "").otherwise(F.concat(head, F.lit(":"))), zeros, tail)).otherwise(value)
    groups = F.filter(F.split(full, ":"), lambda g: g != "")
    digits = F.array_join(F.transform(groups, lambda g: F.lpad(g, 4, "0")), "")
    half = lambda i: F.conv(F.substr(digits, F.lit(i), F.lit(16)), 16, -10).cast("bigint")
    rounds = F.sequence(F.lit(ROUNDS), F.lit(1), F.lit(-1)) if invert else F.sequence(F.lit(1), F.lit(ROUNDS))

    def mask(n: Column, other: Column) -> Column:
        hashed = keyed_hash(key, F.lit("ipv6"), n.cast("string"), other.cast("string"))
        return _let(hashed, lambda h: F.conv(F.substring(h, 1, 16), 16, -10).cast("bigint"))

    def turn(pair: Column, n: Column) -> Column:
        odd = n % 2 == 1
        return F.struct(
            F.when(odd, pair["l"].bitwiseXOR(mask(n, pair["r"]))).otherwise(pair["l"]).alias("l"),
            F.when(odd, pair["r"]).otherwise(pair["r"].bitwiseXOR(mask(n, pair["l"]))).alias("r"),
        )

    mixed = F.aggregate(rounds, F.struct(half(1).alias("l"), half(17).alias("r")), turn)
    bits = _let(mixed, lambda p: F.concat(*(F.lower(F.lpad(F.hex(p[side]), 16, "0")) for side in ("l", "r"))))
    new = F.rtrim(F.regexp_replace(bits, "(.{4})", "$1:"), F.lit(":"))
    one_gap = ~value.contains("::") | ((left_out >= 1) & (F.locate("::", value, 1) > 0))
    return F.when((F.size(groups) == 8) & (~value.contains("::") | (left_out > 0)), new)


def _ssn(value: Column, key: str | Column, invert: bool) -> Column:
    area, group, serial = (F.substr(value, F.lit(i), F.lit(n)).cast("bigint") for i, n in ((1, 3), (5, 2), (8, 4)))
    # Assignable areas are 1 to 899 without 666: 898 of them, counted from 0.
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    index = F.when(area > 666, area - 2).otherwise(area - 1)
    mixed = feistel(index * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999), F.lit("ssn"), key, invert)

    def text(p: Column) -> Column:
        i = F.floor(p["l"] / 99)
        area = F.when(i >= 665, i + 2).otherwise(i + 1)
        return F.concat(_padded(area, F.lit(3)), F.lit("-"), _padded(p["l"] % 99 + 1, F.lit(2)), F.lit("-"), _padded(p["r"] + 1, F.lit(4)))

    return F.when(valid, _let(mixed, text))


def _phone(value: Column, key: str | Column, invert: bool) -> Column:
    digits = digits_of(value)
    american = ~value.startswith("+") | (value.startswith("+1") & (F.length(digits) == 11))
    national = F.substr(digits, F.length(digits) - 9, F.lit(10))
    area, exchange, line = (F.substr(national, F.lit(i), F.lit(n)).cast("bigint") for i, n in ((1, 3), (4, 3), (7, 4)))
    # Assignable numbers are permuted among themselves, and so are the others,
    # which count only where the writing marks a phone number.
    valid = (area >= 200) & (exchange >= 200)
    marked = value.startswith("+") | value.contains("(")
    index = (
        F.when(valid, (area - 200) * 800 + exchange - 200)
        .when(area < 200, area * 1000 + exchange)
        .otherwise(200_000 + (area - 200) * 200 + exchange)
    )
    size = F.when(valid, 640_000).otherwise(360_000)
    mixed = feistel(index, line, size, F.lit(10_000), F.concat_ws("/", F.lit("phone"), size), key, invert)

    def number(p: Column) -> Column:
        i = p["l"]
        new_area = F.when(valid, F.floor(i / 800) + 200).when(i < 200_000, F.floor(i / 1000)).otherwise(F.floor((i - 200_000) / 200) + 200)
        new_exchange = F.when(valid, i % 800 + 200).when(i < 200_000, i % 1000).otherwise((i - 200_000) % 200)
        return F.concat(_padded(new_area, F.lit(3)), _padded(new_exchange, F.lit(3)), _padded(p["r"], F.lit(4)))

    ours = into_format(value, F.concat(F.substr(digits, F.lit(1), F.length(digits) - 10), _let(mixed, number)))
    # Other countries: all digits behind the first two.
    lead = F.substr(digits, F.lit(1), F.lit(2))
    other = into_format(value, F.concat(lead, permute_digits(F.substr(digits, F.lit(3), F.length(digits)), F.concat(F.lit("phone"), lead), key, invert)))
    return F.when(american, F.when(valid | marked, ours)).otherwise(F.when(F.length(digits).between(8, 15), other))


def _email(value: Column, key: str | Column) -> Column:
    name = F.substring(keyed_hash(key, F.lit("email"), F.lower(value)), 1, 16)
    return F.concat(F.lit("u"), name, F.lit("@masked.invalid"))


def _secret(value: Column, key: str | Column) -> Column:
    """The credential behind the name, replaced by keyed hex digits."""
    name = F.regexp_extract(value, f"^(?:{MARKED}|{NAMED}{ASSIGNED})", 0)
    rest = F.length(value) - F.length(name)
    # Hex blocks of 64 digits, as many as the credential is long.
    block = lambda i: keyed_hash(key, F.lit("secret"), i.cast("string"), value)
    stream = F.array_join(F.transform(F.sequence(F.lit(0), F.floor(rest / 64).cast("int")), block), "")
    return F.concat(name, F.substr(F.when(name.rlike("^A[KS]IA"), F.upper(stream)).otherwise(stream), F.lit(1), rest))


NUMBERS = {"date": _date, "ipv4": _ipv4, "ipv6": _ipv6, "ssn": _ssn, "phone": _phone, "iban": _iban, "card": _card}
FOUND = "array<struct<kind:string,value:string>>"
PARTS = "array<struct<text:string,kind:string,value:string>>"


def _part(text: Column, kind: Column | None = None, value: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(text.alias("text"), (none if kind is None else kind).alias("kind"), (none if value is None else value).alias("value"))


def hashed(value: Column, key: str | Column, invert: bool) -> Column:
    """The part of an address or credential; ``invert`` leaves it as it is."""
    if invert:
        return _part(value)
    kind = F.when(value.rlike(f"^(?:{EMAIL})$"), F.lit("email")).otherwise(F.lit("secret"))
    return _let(F.when(kind == "email", _email(value, key)).otherwise(_secret(value, key)), lambda v: _part(v, kind, v))


def number_at(window: Column, key: str | Column, invert: bool, known: Column | None) -> Column:
    """``struct(kind, size, value)`` of the number with which ``window``
    begins, or null: the first kind and the first span that validate count.
    With ``known``, only spans among these values do."""
    options = []
    for kind, replace in NUMBERS.items():
        spans = F.filter(F.array(*(F.regexp_extract(window, f"^(?:{s}){AFTER_KIND.get(kind, AFTER)}", 0) for s in SPANS[kind])), lambda v: v != "")
        if known is not None:
            spans = F.filter(spans, lambda v: F.array_contains(known, v))
        named = lambda v: F.struct(F.lit(kind).alias("kind"), F.length(v).alias("size"), replace(v, key, invert).alias("value"))  # noqa: B023, E731
        made = F.transform(spans, named)
        options.append(F.when(window.rlike("^" + QUICK[kind]), F.get(F.filter(made, lambda m: m["value"].isNotNull()), F.lit(0))))
    return F.coalesce(*options)


def numbers(text: Column, is_first: Column, key: str | Column, invert: bool, known: Column | None) -> Column:
    """The parts of a text between addresses and credentials (``is_first``:
    nothing stands before it). From the left, the first valid number counts,
    and what it covers is not tried again."""

    def tried(piece: Column, i: Column, heads: Column) -> Column:
        window = F.left(F.array_join(F.slice(heads, i + 1, F.lit(WINDOW)), ""), F.lit(WINDOW))
        number = F.when((i > 0) | is_first, _let(window, lambda w: number_at(w, key, invert, known)))
        return F.struct(piece.alias("text"), number.alias("number"))

    def step(state: Column, piece: Column) -> Column:
        text, number, covered = piece["text"], piece["number"], state["covered"]
        size = F.length(text)
        hit = (covered == 0) & number.isNotNull()
        rest = F.substr(text, F.when(hit, number["size"]).otherwise(covered) + 1, size)
        part = F.when(hit, _part(F.concat(number["value"], rest), number["kind"], number["value"])).otherwise(_part(rest))
        return F.struct(
            F.when(hit, F.greatest(number["size"] - size, F.lit(0))).otherwise(F.greatest(covered - size, F.lit(0))).cast("int").alias("covered"),
            F.when(covered >= size, state["parts"]).otherwise(F.concat(state["parts"], F.array(part))).alias("parts"),
        )

    start = F.struct(F.lit(0).alias("covered"), F.array().cast(PARTS).alias("parts"))
    heads_of = lambda pieces: F.transform(pieces, lambda p: F.left(p, F.lit(WINDOW)))
    all_tried = lambda pieces: _let(heads_of(pieces), lambda heads: F.transform(pieces, lambda p, i: tried(p, i, heads)))
    return F.aggregate(_let(F.split(text, STARTS, -1), all_tried), start, step, lambda s: s["parts"])


def pii_key(spark: SparkSession) -> str:
    key = spark.conf.get(KEY_CONF, None)
    if not key:
        warnings.warn(f"{KEY_CONF} is not set: pseudonyms are made with a published key", stacklevel=2)
    return key or DEMO_KEY


def _hidden(spark: SparkSession, key: str) -> Column:
    """The key as a scalar subquery over a one-row table, whose rows plans do
    not show."""
    return spark.createDataFrame([(key,)], "key string").scalar()


def pseudonymize(docs: DataFrame, key: str, text_col: str = "text", invert: bool = False) -> DataFrame:
    """``docs`` with pseudonyms in the text, ``n_pii`` and ``pii``. Texts
    without a candidate pass through unchanged. ``invert`` restores numbers
    and dates that were permuted with the same key; where numbers overlap, it
    needs the column ``pii`` to tell which of them was replaced."""
    text = quoted(text_col).cast("string")
    key_name = unused_name(docs, "pii_key")
    hidden = _hidden(docs.sparkSession, key)
    key = F.col(key_name)
    known = F.col("pii")["value"] if invert and dict(docs.dtypes).get("pii") == FOUND else None
    parts = unused_name(docs, "pii_parts")
    gaps = F.transform(
        F.split(text, TEXTS, -1),
        lambda g, i: F.when(g.rlike(STARTS), numbers(g, i == 0, key, invert, known)).otherwise(F.array(_part(g))),
    )
    hits = F.transform(F.regexp_extract_all(text, F.lit(TEXTS), F.lit(0)), lambda v: hashed(v, key, invert))
    # One gap more than hits: the text is gap, hit, gap, ..., gap.
    all_parts = F.flatten(F.zip_with(gaps, hits, lambda g, h: F.when(h.isNull(), g).otherwise(F.concat(g, F.array(h)))))
    parted = docs.withColumn(key_name, hidden).withColumn(parts, F.when(text.rlike(TEXTS) | text.rlike(STARTS), all_parts))
    pii = F.transform(F.filter(F.col(parts), lambda h: h["kind"].isNotNull()), lambda h: F.struct(h["kind"], h["value"]))
    return parted.withColumns(
        {
            text_col: F.when(F.col(parts).isNotNull(), F.array_join(F.col(parts)["text"], "")).otherwise(text),
            "pii": F.coalesce(pii, F.array()).cast(FOUND),
            "n_pii": F.coalesce(F.size(pii), F.lit(0)).cast("bigint"),
        }
    ).drop(parts, key_name)
