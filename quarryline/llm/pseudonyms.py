"""Format-preserving Feistel pseudonyms, in DataFrame operations only.

Values are found by pattern and validated (card numbers by their check digit, dates by the calendar, octets and number
ranges by value). A valid value is a number in a finite set, that set is a product of two ranges, and a keyed Feistel
network of `rounds` rounds over the pair of ranges permutes it: the result is again a valid value of the same format,
different values stay different, and equal values become equal ones in every document, so records stay linked. Round
functions are SHA-256 of key, kind, round and half. Without the key nothing is reversed; with it, `feistel(decrypt=True)`
undoes the permutation.

    card       13-19 digits in an issuer's range and length that pass the Luhn check: the digits between the first four and
               the last are permuted, the check digit is set anew
    iban       two letters, check digits that are right, 11-30 characters: the digits are permuted, the check set anew
    phone      +country code and 7-14 digits: the digits after the country code; (309) 555-7741 and 309-555-7741: all ten
    ipv4       four octets: the 32 bits
    ipv6       the hexadecimal digits after the first group, in the notation that the text has
    ssn        AAA-GG-SSSS in valid ranges: the index among all valid ones
    date       yyyy-mm-dd (a time may follow), dd/mm/yyyy, mm/dd/yyyy where the other is none, or dd.mm.yyyy that exists,
               years 1000 to 9999: the day within its year
    email      the part before @, in lower case, becomes a keyed digest of 80 bits, the domain stays
    secret     access keys (AKIA, ghp_), password, token and api_key values in any case: a keyed digest in the same format

E-mails and secrets are no numbers and get one-way digests, of which two may meet by chance only. What fails its validation is left alone. Separators within a
value stay where they are. The key is a scalar subquery's value: plans, the web interface and event logs don't show it.

Nulls: a null text stays null, with no counts. Empty texts stay empty. Rows keep their number and order within the
partition, repeated rows are treated alike, and other columns are passed on where `keep_columns` is set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name

KINDS = ("email", "ssn", "date", "ipv4", "ipv6", "phone", "card", "iban", "secret")

_BEFORE = r"(?<![0-9A-Za-z.+/-])"
_HEX = "[0-9A-Fa-f]{1,4}"
PATTERNS = {
    "secret": r"\bAKIA[0-9A-Z]{16}\b|\bghp_[0-9A-Za-z]{20,255}\b|(?<![0-9A-Za-z])(?i:password|passwd|pwd|secret|token|api[_-]?key) ?[=:] ?\"?[0-9A-Za-z+/_-]{12,}\"?",
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9](?:[A-Za-z0-9-]{0,62}[A-Za-z0-9])?(?:\.[A-Za-z0-9-]{1,63}){0,6}\.[A-Za-z]{2,24}\b",
    "phone": r"(?<![0-9A-Za-z+])\+[0-9]{1,3}[ .-]?\(?[0-9]{1,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9A-Za-z])|" + _BEFORE + r"(?:\([0-9]{3}\) ?|[0-9]{3}-)[0-9]{3}-[0-9]{4}(?![0-9A-Za-z-])",
    "date": _BEFORE + r"(?:[1-9][0-9]{3}-[01][0-9]-[0-3][0-9]|[0-3][0-9]/[0-3][0-9]/[1-9][0-9]{3}|[0-3][0-9]\.[01][0-9]\.[1-9][0-9]{3})(?!(?!T[0-2][0-9]:)[0-9A-Za-z])",
    "ssn": _BEFORE + r"[0-8][0-9]{2}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "ipv4": _BEFORE + r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9A-Za-z]|\.[0-9])",
    "ipv6": rf"(?<![0-9A-Za-z:])(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}:){{1,6}}(?::{_HEX}){{1,6}})(?![0-9A-Za-z:])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])",
    "card": _BEFORE + r"[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])",
}
#: The ranges and lengths in which payment card numbers are issued.
ISSUED = r"^(?:4(?:[0-9]{12}|[0-9]{15}|[0-9]{18})|5[0-9]{15}|2(?:22[1-9]|2[3-9][0-9]|[3-6][0-9]{2}|7[01][0-9]|720)[0-9]{12}|3[47][0-9]{13}|3[0689][0-9]{12,17}|35[0-9]{14,17}|6[0-9]{15,18})$"
_ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())


def _column(key: Column | str) -> Column:
    return key if isinstance(key, Column) else F.lit(key)


def _digest_long(*parts) -> Column:
    """60 bits of the SHA-256 of the parts, never negative."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", *[p if isinstance(p, Column) else F.lit(p) for p in parts]), 256), 1, 15), 16, 10).cast("long")


def feistel(left: Column, right: Column, a: Column, b: Column, key: Column | str, tweak: Column, rounds: int = 10, decrypt: bool = False) -> Column:
    """struct(left, right): a permutation of 0 <= left < a, 0 <= right < b. An even number of rounds; each adds a keyed
    function of one side to the other, so it can be undone."""
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    steps = F.array(*[F.lit(i) for i in (reversed(range(rounds)) if decrypt else range(rounds))])

    def step(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        told = _digest_long(key, tweak, i.cast("string"), F.when(even, s["r"]).otherwise(s["l"]).cast("string"), key)
        add = F.when(F.lit(decrypt), -(told % F.when(even, a).otherwise(b))).otherwise(told % F.when(even, a).otherwise(b))
        return F.struct(F.when(even, F.pmod(s["l"] + add, a)).otherwise(s["l"]).cast("long").alias("l"), F.when(even, s["r"]).otherwise(F.pmod(s["r"] + add, b)).cast("long").alias("r"))

    return F.aggregate(steps, start, step)


def _let(value: Column, f) -> Column:
    """f of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _power(n: Column) -> Column:
    return F.round(F.pow(F.lit(10.0), n), 0).cast("long")


def permute_digits(digits: Column, key: Column | str, tweak: Column, rounds: int = 10, decrypt: bool = False) -> Column:
    """A permutation of the digit strings of each length from 2 to 34: each half is a number of at most 17 digits."""
    half = (F.length(digits) / 2).cast("int")
    rest = F.length(digits) - half
    pair = feistel(F.substr(digits, F.lit(1), half).cast("long"), F.substr(digits, half + 1).cast("long"), _power(half), _power(rest), key, F.concat(tweak, F.length(digits).cast("string")), rounds, decrypt)
    return _let(pair, lambda p: F.concat(F.lpad(p["l"].cast("string"), half, "0"), F.lpad(p["r"].cast("string"), rest, "0")))


def luhn_sum(digits: Column, doubled_last: bool) -> Column:
    """Luhn sum of a digit string; doubled_last: whether the last digit counts double (it does before a check digit)."""
    places = F.sequence(F.lit(1), F.length(digits))

    def one(i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when(i % 2 == (1 if doubled_last else 0), twice).otherwise(d)

    return F.aggregate(F.transform(places, one), F.lit(0), lambda s, x: s + x)


def _permute_hex(digits: Column, key: Column | str, tweak: Column, rounds: int = 10) -> Column:
    """A permutation of the strings of each length from 2 to 28 hexadecimal digits, in lower case."""
    half = (F.length(digits) / 2).cast("int")
    rest = F.length(digits) - half
    number = lambda x: F.conv(x, 16, 10).cast("long")
    size = lambda n: F.round(F.pow(F.lit(16.0), n), 0).cast("long")
    shown = lambda x, n: F.lpad(F.lower(F.hex(x)), n, "0")
    pair = feistel(number(F.substr(digits, F.lit(1), half)), number(F.substr(digits, half + 1)), size(half), size(rest), key, F.concat(tweak, F.length(digits).cast("string")), rounds)
    return _let(pair, lambda p: F.concat(shown(p["l"], half), shown(p["r"], rest)))


def _mod_97(text: Column) -> Column:
    """The remainder by 97 of digits and capital letters, which stand for 10 to 35."""
    value = lambda c: F.when(c <= "9", F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.split(text, ""), F.lit(0), lambda s, c: F.when(c == "", s).otherwise((s * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97))


def _refill(shape: Column, digits: Column, kinds: str = "0123456789") -> Column:
    """The characters of `shape`, its digits (characters of kinds) replaced in order by those of `digits`."""
    start = F.struct(F.lit(1).alias("k"), F.lit("").alias("out"))

    def step(s: Column, c: Column) -> Column:
        is_digit = (F.length(c) == 1) & F.lit(kinds).contains(c)
        return F.struct((s["k"] + is_digit.cast("int")).alias("k"), F.concat(s["out"], F.when(is_digit, F.substr(digits, s["k"], F.lit(1))).otherwise(c)).alias("out"))

    return F.aggregate(F.split(shape, ""), start, step, lambda s: s["out"])


def _only_digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def pseudonym(m: Column, key: Column | str, rounds: int = 10) -> Column:
    """struct(kind, value): the kind of a match that is valid and its pseudonym, else null and the match itself."""
    full = lambda kind: m.rlike(f"^(?:{PATTERNS[kind]})$")
    none = F.struct(F.lit(None).cast("string").alias("kind"), m.alias("value"))
    made = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("value"))

    digits = _only_digits(m)
    inner = lambda d: F.substr(d, F.lit(5), F.length(d) - 5)
    card = F.when(digits.rlike(ISSUED) & (luhn_sum(digits, False) % 10 == 0), made("card", _let(F.concat(F.substr(digits, F.lit(1), F.lit(4)), permute_digits(inner(digits), key, F.concat(F.lit("card"), F.substr(digits, F.lit(1), F.lit(4))), rounds)), lambda d: _refill(m, F.concat(d, ((10 - luhn_sum(d, True) % 10) % 10).cast("string")))))).otherwise(none)

    country = F.regexp_extract(m, r"^\+[0-9]{1,3}(?=[ .(-])|^\+[0-9]|^", 0)
    local = F.substr(m, F.length(country) + 1)
    n = F.length(_only_digits(local))
    phone = F.when(n.between(7, 14), made("phone", F.concat(country, _refill(local, permute_digits(_only_digits(local), key, F.concat(F.lit("phone"), country), rounds))))).otherwise(none)

    body = F.substr(m, F.lit(5))
    bban_digits = _only_digits(body)
    checks = lambda rest: 98 - _mod_97(F.concat(F.regexp_replace(rest, " ", ""), F.substring(m, 1, 2), F.lit("00")))
    told = lambda rest: F.concat(F.substring(m, 1, 2), F.lpad(checks(rest).cast("string"), 2, "0"), rest)
    new_body = lambda: _refill(body, permute_digits(bban_digits, key, F.concat(F.lit("iban"), F.substring(m, 1, 2)), rounds))
    iban = F.when((F.length(bban_digits) >= 2) & (F.length(F.regexp_replace(m, " ", "")).between(15, 34)) & (F.lpad(checks(body).cast("string"), 2, "0") == F.substring(m, 3, 2)), made("iban", _let(new_body(), told))).otherwise(none)

    group = F.regexp_extract(m, "^[0-9A-Fa-f]+", 0)
    after = F.substr(m, F.length(group) + 1)
    hexes = F.lower(F.regexp_replace(after, "[^0-9A-Fa-f]", ""))
    ipv6 = F.when(F.length(hexes) >= 2, made("ipv6", F.concat(group, _refill(after, _permute_hex(hexes, key, F.concat(F.lit("ipv6"), F.lower(group)), rounds), "0123456789abcdefABCDEF")))).otherwise(none)

    octet = lambda i: F.element_at(F.split(m, r"\."), i).cast("long")
    as_ip = lambda p: F.concat_ws(".", F.shiftright(p["l"], 8), p["l"] % 256, F.shiftright(p["r"], 8), p["r"] % 256)
    side = F.lit(65536).cast("long")
    ipv4 = F.when((octet(1) < 256) & (octet(2) < 256) & (octet(3) < 256) & (octet(4) < 256), made("ipv4", _let(feistel(octet(1) * 256 + octet(2), octet(3) * 256 + octet(4), side, side, key, F.lit("ipv4"), rounds), as_ip))).otherwise(none)

    area, group, serial = (F.element_at(F.split(m, "-"), i).cast("long") for i in (1, 2, 3))
    index = F.when(area > 666, area - 2).otherwise(area - 1) * 99 + group - 1
    areas, serials = F.lit(898 * 99).cast("long"), F.lit(9999).cast("long")

    def as_ssn(p: Column) -> Column:
        at = F.floor(p["l"] / 99)
        return F.concat_ws("-", F.lpad(F.when(at >= 665, at + 2).otherwise(at + 1).cast("string"), 3, "0"), F.lpad((p["l"] % 99 + 1).cast("string"), 2, "0"), F.lpad((p["r"] + 1).cast("string"), 4, "0"))

    ssn = F.when((area > 0) & (area != 666) & (group > 0) & (serial > 0), made("ssn", _let(feistel(index, serial - 1, areas, serials, key, F.lit("ssn"), rounds), as_ssn))).otherwise(none)

    iso = m.contains("-")
    first, second = F.substring(m, 1, 2), F.substring(m, 4, 2)
    month_first = m.contains("/") & (second > "12")
    plain = F.when(iso, m).otherwise(F.concat_ws("-", F.substring(m, 7, 4), F.when(month_first, first).otherwise(second), F.when(month_first, second).otherwise(first)))
    day = F.try_to_date(plain, "yyyy-MM-dd")
    year = F.year(day)
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    a, b = F.when(leap, F.lit(6)).otherwise(F.lit(5)).cast("long"), F.when(leap, F.lit(61)).otherwise(F.lit(73)).cast("long")
    number = F.dayofyear(day) - 1
    new_day = _let(feistel(F.floor(number / b), number % b, a, b, key, F.concat(F.lit("date"), year.cast("string")), rounds), lambda p: F.date_add(F.make_date(year, F.lit(1), F.lit(1)), (p["l"] * b + p["r"]).cast("int")))
    shown = _let(new_day, lambda d: F.when(iso, F.date_format(d, "yyyy-MM-dd")).when(month_first, F.date_format(d, "MM/dd/yyyy")).when(m.contains("/"), F.date_format(d, "dd/MM/yyyy")).otherwise(F.date_format(d, "dd.MM.yyyy")))
    date = F.when(day.isNotNull(), made("date", shown)).otherwise(none)

    token = lambda text, kind: F.sha2(F.concat_ws("|", _column(key), F.lit(kind), text, _column(key)), 256)
    name = F.regexp_extract(m, "^([^@]*)@", 1)
    email = made("email", F.concat(F.lit("u"), F.substring(token(F.lower(name), "email"), 1, 20), F.substr(m, F.length(name) + 1)))
    label = F.regexp_extract(m, r"^(?:AKIA|ghp_|[A-Za-z_-]+ ?[=:] ?\"?)", 0)
    body = F.regexp_extract(F.substr(m, F.length(label) + 1), r"^[0-9A-Za-z+/_-]*", 0)
    repeated = F.repeat(token(body, "secret"), F.ceil(F.length(body) / 64).cast("int"))
    secret = made("secret", F.concat(label, F.when(m.startswith("AKIA"), F.upper(F.substr(repeated, F.lit(1), F.length(body)))).otherwise(F.substr(repeated, F.lit(1), F.length(body))), F.substr(m, F.length(label) + F.length(body) + 1)))

    return F.when(m.startswith("AKIA") | m.startswith("ghp_") | full("secret"), secret).when(m.contains("@"), email).when(m.startswith("+") | full("phone"), phone).when(full("date"), date).when(full("ssn"), ssn).when(full("ipv4"), ipv4).when(full("ipv6"), ipv6).when(full("iban"), iban).when(full("card"), card).otherwise(none)


def pseudonymise(docs: DataFrame, key: str, rounds: int = 10, id_col: str = "doc_id", text_col: str = "text", keep_columns: bool = False) -> DataFrame:
    """`docs` with every valid value replaced: doc_id, text and n_<kind>, or with keep_columns the columns of docs alone.

    One narrow pass: nothing is shuffled, so no key can be hot.
    """
    if rounds % 2 or rounds < 4:
        raise ValueError("rounds must be even and at least 4")
    found, new, matches, secret = (free_name(c, docs) for c in ("found", "new", "matches", "secret"))
    # The key comes from a subquery over rows that live outside the plan, so it is no literal of any expression.
    told = docs.sparkSession.createDataFrame([(key,)], "k string").scalar()
    # A text without a digit, @ or secret label has no candidate; it is not searched further.
    likely = F.col(text_col).rlike("[0-9@]|AKIA|ghp_|(?i:passw|pwd|secret|token|api[_-]?key)")
    none = F.array().cast("array<string>")
    searched = docs.withColumns({matches: F.when(likely, F.regexp_extract_all(F.col(text_col), F.lit(_ANY), F.lit(0))).otherwise(none), secret: told})
    searched = searched.withColumn(found, F.transform(matches, lambda m: pseudonym(m, F.col(secret), rounds)))
    between = F.split(F.col(text_col), _ANY)
    values = F.concat(F.transform(found, lambda x: x["value"]), F.array(F.lit("")))
    rebuilt = F.when(F.size(found) > 0, F.array_join(F.zip_with(between, values, lambda x, y: F.concat(x, y)), "")).otherwise(F.col(text_col))
    if keep_columns:
        return searched.withColumn(text_col, rebuilt).select(docs.columns)

    def n_of(kind: str) -> Column:
        return F.size(F.filter(found, lambda x: x["kind"] == kind)).cast("long")

    return searched.withColumn(new, rebuilt).select(F.col(id_col).cast("long").alias("doc_id"), F.col(new).alias("text"), *[F.when(F.col(text_col).isNull(), F.lit(0).cast("long")).otherwise(n_of(k)).alias(f"n_{k}") for k in KINDS])
