"""Format-preserving pseudonyms for personal numbers, dates and addresses.

What is found is checked (check digits, calendar, number ranges) and permuted
within its own format by a keyed Feistel network: the value is split into a pair
of numbers below two moduli whose product is the size of the format, and each
round adds a keyed hash of one number to the other. Any such round can be undone,
so different values have different pseudonyms, and equal values have equal ones
in every document. Check digits are computed anew. Built-in functions only; a row
is changed in place and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

ROUNDS = 8
FIRST_DAY, LAST_DAY = "1900-01-01", "2099-12-31"
# Days from the first to the last are 17 * 4297.
DAY_MODULI = (17, 4297)
# Area numbers 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999.
SSN_MODULI = (898 * 99, 9999)
# Telephone numbers of ten digits, by what they keep: assigned ones (area and exchange from
# 200), those of a lower area, those of a lower exchange. First area, areas, first exchange, exchanges.
PHONE_CLASSES = ((200, 800, 200, 800), (0, 200, 0, 1000), (200, 800, 0, 200))
# Leading digits of the card networks.
NETWORKS = "^(?:4|5[1-5]|3[47]|6|2[2-7])"
BLOCK = 24

LETTERS = "abcdefghijklmnopqrstuvwxyz"
BASE26 = "0123456789abcdefghijklmnop"

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
KEY_ID = r"AKIA[A-Z0-9]{16}(?![A-Za-z0-9])"
SECRET = r"""(?:(?i:password|passwd|secret|token|api_key)\s?[=:]\s?"?)[0-9A-Fa-f]{16,}(?![A-Za-z0-9])"""
# Characters of an IBAN by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
_END = "(?![A-Za-z0-9])"


def _iban_of(length: int, countries: str) -> str:
    """Groups of four and the rest, as many as the country has."""
    groups, rest = divmod(length - 4, 4)
    tail = f" ?[A-Z0-9]{{{rest}}}" if rest else ""
    return rf"(?:{countries.replace(' ', '|')})\d{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}{tail}{_END}"


# The length of the country, so that no following word is taken; any other form after that.
IBAN = (
    r"(?=[A-Z]{2}\d{2})(?:" + "|".join(_iban_of(n, c) for n, c in IBAN_LENGTHS.items())
    + r"|[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?" + _END + ")"
)
ADDRESS = r"\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)"
DATE = r"(?:\d{4}-\d{2}-\d{2}|\d{2}[./]\d{2}[./]\d{4})(?![\w]|[./-]\d)"
SSN = r"\d{3}-\d{2}-\d{4}(?![\w-])"
PHONE = r"(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w])"
CARD = r"(?:\d{4}-\d{4}-\d{4}-\d{4}|\d{4} \d{4} \d{4} \d{4}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})(?![\w])"
KINDS = ("email", "key_id", "secret", "iban", "address", "date", "ssn", "phone", "card")
# A find starts where no other word does.
FOUND = "(?<![A-Za-z0-9._%+@-])(?:" + "|".join([EMAIL, KEY_ID, SECRET, IBAN, ADDRESS, DATE, SSN, PHONE, CARD]) + ")"


def _whole(pattern: str) -> str:
    return f"^(?:{pattern})$"


def keyed(key: str, kind: str, round_: Column, value: Column, modulus: Column) -> Column:
    """Keyed hash of a number, below ``modulus``."""
    text = F.concat(F.lit(f"{key}|{kind}|"), round_.cast("string"), F.lit("|"), value.cast("string"), F.lit("|"), modulus.cast("string"))
    return F.pmod(F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long"), modulus)


def feistel(key: str, kind: str, left: Column, right: Column, a: Column, b: Column) -> Column:
    """Permuted pair (l, r) of numbers below the moduli ``a`` and ``b``."""
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    def step(at: Column, i: Column) -> Column:
        l, r = at["l"], at["r"]
        even = i % 2 == 0
        new_l = F.when(even, F.pmod(l + keyed(key, kind, i, r, a), a)).otherwise(l)
        new_r = F.when(even, r).otherwise(F.pmod(r + keyed(key, kind, i, l, b), b))
        return F.struct(new_l.alias("l"), new_r.alias("r"))

    return F.aggregate(F.array(*[F.lit(i) for i in range(ROUNDS)]), start, step)


def _number(digits: Column, base: int) -> Column:
    return F.when(F.length(digits) == 0, F.lit(0).cast("long")).otherwise(F.conv(digits, base, 10).cast("long"))


def _digits(number: Column, base: int, width: Column) -> Column:
    text = F.lower(F.conv(number.cast("string"), 10, base))
    return F.when(width == 0, F.lit("")).otherwise(F.lpad(text, width, F.lit("0")))


def _power(base: int, n: Column) -> Column:
    return F.pow(F.lit(float(base)), n).cast("long")  # exact: all are below 2^60 and multiples of 2^k or 5^k


def permuted_block(key: str, kind: str, text: Column, base: int) -> Column:
    """A string of at most ``BLOCK`` digits of ``base``, permuted among those of its length."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    rest = (n - half).cast("int")
    left, right = F.substring(text, F.lit(1), half), F.substring(text, half + 1, rest)
    pair = feistel(key, f"{kind}{base}", _number(left, base), _number(right, base), _power(base, half), _power(base, rest))
    return let(pair, lambda p: F.concat(_digits(p["l"], base, half), _digits(p["r"], base, rest)))


def permuted(key: str, kind: str, text: Column, base: int, block: int) -> Column:
    """A string of digits of ``base`` of any length, block by block."""
    begin = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)), F.lit(block))
    return F.array_join(F.transform(begin, lambda i: permuted_block(key, kind, F.substring(text, i, F.lit(block)), base)), "")


def refill(form: Column, characters: str, fresh: Column) -> Column:
    """``form`` with its characters of a class replaced, in order, by those of ``fresh``."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("k"))

    def step(at: Column, c: Column) -> Column:
        hit = c.rlike(characters)
        out = F.concat(at["out"], F.when(hit, F.substring(fresh, at["k"] + 1, F.lit(1))).otherwise(c))
        return F.struct(out.alias("out"), (at["k"] + hit.cast("int")).alias("k"))

    return F.aggregate(F.split(form, ""), start, step, lambda at: at["out"])


def luhn(digits: Column, first_doubled: bool) -> Column:
    """Sum of the digits, every second one from the right doubled and its digits added."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = (i % 2) == F.lit(0 if first_doubled else 1)
        return total + F.when(twice, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add)


def mod97(text: Column) -> Column:
    """Digits and letters (A is 10) read as one decimal number, modulo 97."""

    def add(total: Column, c: Column) -> Column:
        digit = c.rlike("[0-9]")
        return F.when(digit, (total * 10 + c.cast("int")) % 97).otherwise((total * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(F.split(text, ""), F.lit(0), add)


def email(key: str, m: Column) -> Column:
    """Letters and digits before the sign are permuted, each among themselves; the domain stays."""
    local = F.lower(F.substring_index(m, "@", 1))
    letters = F.translate(F.regexp_replace(local, "[^a-z]", ""), LETTERS, BASE26)
    numbers = F.regexp_replace(local, "[^0-9]", "")
    new = refill(local, "[a-z]", F.translate(permuted(key, "email", letters, 26, 16), BASE26, LETTERS))
    return F.concat(refill(new, "[0-9]", permuted(key, "email", numbers, 10, BLOCK)), F.lit("@"), F.substring_index(m, "@", -1))


def key_id(key: str, m: Column) -> Column:
    return F.concat(F.lit("AKIA"), F.upper(permuted_block(key, "key_id", F.substring(m, 5, 16), 36)))


def secret(key: str, m: Column) -> Column:
    value = F.regexp_extract(m, "([0-9A-Fa-f]+)$", 1)
    new = permuted(key, "secret", value, 16, BLOCK)
    return F.concat(F.substring(m, F.lit(1), F.length(m) - F.length(value)), F.when(value == F.upper(value), F.upper(new)).otherwise(new))


def iban(key: str, m: Column) -> Column:
    plain = F.regexp_replace(m, " ", "")
    numbers = F.regexp_replace(F.substring(plain, F.lit(5), F.length(plain)), "[^0-9]", "")
    account = refill(F.substring(plain, F.lit(5), F.length(plain)), "[0-9]", permuted(key, "iban", numbers, 10, BLOCK))
    new = let(account, lambda a: F.concat(
        F.substring(plain, 1, 2), F.lpad((F.lit(98) - mod97(F.concat(a, F.substring(plain, 1, 2), F.lit("00")))).cast("string"), 2, "0"), a
    ))
    valid = mod97(F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))) == 1
    return F.when(valid & (F.length(plain) >= 15), refill(m, "[A-Z0-9]", new)).otherwise(m)


def address(key: str, m: Column) -> Column:
    o = F.transform(F.split(m, r"\."), lambda x: x.cast("int"))
    pair = lambda o: feistel(key, "address", o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65536).cast("long"), F.lit(65536).cast("long"))
    told = lambda p: F.concat_ws(".", *[F.pmod(F.floor(p[s] / k), F.lit(256)).cast("string") for s in ("l", "r") for k in (256, 1)])
    return let(o, lambda o: F.when(F.array_max(o) <= 255, let(pair(o), told)).otherwise(m))


def date(key: str, m: Column) -> Column:
    """Year-month-day with dashes, day and month first with points or strokes."""
    iso = m.contains("-")
    sign = F.when(m.contains("."), ".").otherwise("/")
    same = iso | (F.substring(m, 3, 1) == F.substring(m, 6, 1))
    day = F.when(iso, F.try_to_date(m, "yyyy-MM-dd")).otherwise(F.try_to_date(F.regexp_replace(m, r"[./]", "-"), "dd-MM-yyyy"))
    a, b = (F.lit(x).cast("long") for x in DAY_MODULI)
    n = F.datediff(day, F.lit(FIRST_DAY).cast("date"))
    pair = feistel(key, "date", F.floor(n / b), F.pmod(n, b), a, b)
    new = let(pair, lambda p: F.date_add(F.lit(FIRST_DAY).cast("date"), (p["l"] * b + p["r"]).cast("int")))
    told = let(new, lambda d: F.when(iso, F.date_format(d, "yyyy-MM-dd")).otherwise(F.replace(F.date_format(d, "dd-MM-yyyy"), F.lit("-"), sign)))
    return F.when(same & day.between(F.lit(FIRST_DAY).cast("date"), F.lit(LAST_DAY).cast("date")), told).otherwise(m)


def ssn(key: str, m: Column) -> Column:
    part = [F.split(m, "-")[i].cast("long") for i in range(3)]
    area = part[0] - F.when(part[0] > 666, 2).otherwise(1)
    a, b = (F.lit(x).cast("long") for x in SSN_MODULI)
    pair = feistel(key, "ssn", area * 99 + part[1] - 1, part[2] - 1, a, b)

    def told(p: Column) -> Column:
        area = F.floor(p["l"] / 99) + 1
        parts = ((area + F.when(area >= 666, 1).otherwise(0), 3), (F.pmod(p["l"], F.lit(99)) + 1, 2), (p["r"] + 1, 4))
        return F.concat_ws("-", *[F.lpad(x.cast("string"), n, "0") for x, n in parts])

    valid = (part[0] > 0) & (part[0] < 900) & (part[0] != 666) & (part[1] > 0) & (part[2] > 0)
    return F.when(valid, let(pair, told)).otherwise(m)


def phone(key: str, m: Column) -> Column:
    """Numbers are permuted within their class, so that assigned ones stay assigned; a country prefix stays."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    own = F.right(digits, F.lit(10))
    prefix = F.substring(digits, F.lit(1), F.length(digits) - 10)
    area, exchange, line = (F.substring(own, at, n).cast("long") for at, n in ((1, 3), (4, 3), (7, 4)))

    def within(first_area: int, areas: int, first_exchange: int, exchanges: int) -> Column:
        n = ((area - first_area) * exchanges + exchange - first_exchange) * 10_000 + line
        a, b = F.lit(areas * 100).cast("long"), F.lit(exchanges * 100).cast("long")

        def told(p: Column) -> Column:
            v = p["l"] * b + p["r"]
            head = F.floor(v / 10_000)
            parts = ((F.floor(head / exchanges) + first_area, 3), (F.pmod(head, F.lit(exchanges)) + first_exchange, 3), (F.pmod(v, F.lit(10_000)), 4))
            return F.concat(prefix, *[F.lpad(x.cast("string"), k, "0") for x, k in parts])

        return let(feistel(key, "phone", F.floor(n / b), F.pmod(n, b), a, b), told)

    assigned, low_area, low_exchange = (within(*c) for c in PHONE_CLASSES)
    new = F.when(area < 200, low_area).when(exchange < 200, low_exchange).otherwise(assigned)
    return refill(m, "[0-9]", new)


def card(key: str, m: Column) -> Column:
    """The first two digits, which tell the network, stay; the check digit is new."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    inner = F.substring(digits, F.lit(3), F.length(digits) - 3)
    body = F.concat(F.substring(digits, 1, 2), permuted_block(key, "card", inner, 10))
    new = let(body, lambda b: F.concat(b, F.pmod(F.lit(0) - luhn(b, True), F.lit(10)).cast("string")))
    return F.when((luhn(digits, False) % 10 == 0) & digits.rlike(NETWORKS), refill(m, "[0-9]", new)).otherwise(m)


def pseudonym(key: str, m: Column) -> Column:
    """What stands for a find; a find that fails its check stays."""
    rules = (
        (m.contains("@"), email), (m.rlike(_whole(KEY_ID)), key_id), (m.rlike(_whole(SECRET)), secret), (m.rlike(_whole(ADDRESS)), address),
        (m.rlike(_whole(DATE)), date), (m.rlike(_whole(SSN)), ssn), (m.rlike(_whole(PHONE)), phone), (m.rlike(_whole(CARD)), card),
    )
    out = F.when(rules[0][0], rules[0][1](key, m))
    for test, rule in rules[1:]:
        out = out.when(test, rule(key, m))
    return out.otherwise(iban(key, m))


def pseudonymised(text: Column, key: str) -> tuple[Column, Column]:
    """Finds of a text and, from a column ``finds`` of them, what stands for each."""
    return F.regexp_extract_all(text, F.lit(FOUND), F.lit(0)), F.transform("finds", lambda m: pseudonym(key, m))


def pseudonyms(docs: DataFrame, key: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, text with pseudonyms, n_found, n_replaced.

    A null text stays null with no finds. Other columns are not read, rows and
    doc_ids are kept as they are, an empty table gives no rows. Dates outside
    1900 to 2099, numbers whose check fails and malformed addresses stay.
    """
    finds, fresh = pseudonymised(F.col("text"), key)
    df = docs.select("doc_id", "text").withColumn("finds", finds).withColumn("fresh", F.when(F.size("finds") > 0, fresh))
    between = F.split("text", FOUND)
    joined = F.array_join(F.zip_with(between, "fresh", lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    changed = F.filter(F.zip_with("finds", "fresh", lambda a, b: a != b), lambda x: x)
    return df.select(
        "doc_id",
        F.when(F.size("finds") > 0, joined).otherwise(F.col("text")).alias("text"),
        F.greatest(F.size("finds"), F.lit(0)).cast("long").alias("n_found"),
        F.coalesce(F.size(changed), F.lit(0)).cast("long").alias("n_replaced"),
    )
