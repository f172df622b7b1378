"""Personal data replaced by keyed pseudonyms of the same format. DataFrame functions only.

A value is recognised by a pattern, validated (checksum, calendar, ranges), and permuted within its format by a
Feistel network whose round function is a keyed hash. Equal values become equal pseudonyms everywhere, different
ones of a format different pseudonyms. Separators, letter case and length stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The length of an IBAN by country. Other countries' may have any.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR",
    27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG SM TD", 28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_pattern() -> str:
    """By country, so that no word after a number counts as its end; then of any length."""
    ends = lambda n: r"(?: ?[A-Z0-9]{4}){%d}" % (n // 4 - 1) + (r" ?[A-Z0-9]{%d}" % (n % 4) if n % 4 else "")
    by_country = "|".join(f"(?:{names.replace(' ', '|')})[0-9]{{2}}{ends(n)}(?![0-9A-Za-z])" for n, names in IBAN_LENGTHS.items())
    return rf"(?<![0-9A-Za-z])(?=[A-Z]{{2}}[0-9]{{2}})(?:{by_country}|[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?(?![0-9A-Za-z]))"


# The patterns, by kind, in the order in which they are tried at a place.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9][A-Za-z0-9-]{0,62}\.){1,127}[A-Za-z]{2,24}(?![A-Za-z0-9-])",
    "iban": _iban_pattern(),
    "date": r"(?<![0-9A-Za-z./-])(?:(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}|[0-9]{2}([./])[0-9]{2}\1(?:19|20)[0-9]{2})(?![0-9A-Za-z])(?![./-][0-9])",
    "ip": r"(?<![0-9A-Za-z])(?<![0-9]\.)[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z])(?!\.[0-9])",
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\2[0-9]{4}\2[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\3[0-9]{5})(?![0-9A-Za-z])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z])(?!-[0-9])",
    "phone": r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}"
    r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}([.-])[0-9]{3}\4[0-9]{4})(?![0-9A-Za-z])",
}
# One pattern for all; a group for each kind would only slow it, the kind is told from the match.
PATTERN = "|".join(PATTERNS.values())
ROUNDS = 10
# 1900-01-01 to 2099-12-31: days, as a product of two radices.
FIRST_DAY, DAYS = "1900-01-01", (17, 4297)
_DIGITS = "0123456789"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _keyed(key: str, tweak: str, i: Column, other: Column) -> Column:
    """512 hash bits of a round as hex digits."""
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(tweak), i.cast("string"), other), 512)


def _number(hex_digits: Column) -> Column:
    """A long below 2^60 from the first 15 hex digits."""
    return F.conv(F.substring(hex_digits, 1, 15), 16, 10).cast("long")


def permute_number(value: Column, radices: tuple[int, int], key: str, tweak: str) -> Column:
    """Keyed permutation of 0 .. a*b-1: Feistel rounds that add modulo a and b in turn."""
    a, b = radices
    start = F.struct(F.floor(value / F.lit(b)).cast("long").alias("x"), F.pmod(value, F.lit(b)).cast("long").alias("y"))

    def turn(s, i):
        add = lambda part, other, n: F.pmod(part + F.pmod(_number(_keyed(key, tweak, i, other.cast("string"))), F.lit(n)), F.lit(n)).cast("long")
        even = i % 2 == 0
        return F.struct(
            F.when(even, add(s["x"], s["y"], a)).otherwise(s["x"]).alias("x"),
            F.when(even, s["y"]).otherwise(add(s["y"], s["x"], b)).alias("y"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda s: s["x"] * F.lit(b) + s["y"])


def _shift(text: Column, hex_digits: Column) -> Column:
    """Each letter or digit moved on within its own alphabet by the bytes of the hash; others stay."""

    def moved(c, k):
        step = F.conv(F.substring(hex_digits, 1 + 3 * (k % 42), F.lit(3)), 16, 10).cast("int")
        code = F.ascii(c)
        within = lambda base, n: F.char(F.lit(base) + F.pmod(code - base + step, F.lit(n)))
        return (
            F.when(c.between("0", "9"), within(48, 10)).when(c.between("a", "z"), within(97, 26)).when(c.between("A", "Z"), within(65, 26)).otherwise(c)
        )

    return F.array_join(F.transform(F.split(text, ""), moved), "")


def permute_text(value: Column, key: str, tweak: str) -> Column:
    """Keyed permutation of the texts of one shape (digits, small and capital letters, and other signs at the same places)."""
    half = F.floor(F.length(value) / 2).cast("int")
    start = F.struct(F.substring(value, F.lit(1), half).alias("x"), F.substring(value, half + 1, F.length(value)).alias("y"))

    def turn(s, i):
        even = i % 2 == 0
        return F.struct(
            F.when(even, _shift(s["x"], _keyed(key, tweak, i, s["y"]))).otherwise(s["x"]).alias("x"),
            F.when(even, s["y"]).otherwise(_shift(s["y"], _keyed(key, tweak, i, s["x"]))).alias("y"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda s: F.concat(s["x"], s["y"]))


def _refill(shape: Column, digits: Column) -> Column:
    """The digits put back in the places of the shape's digits."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))

    def step(s, c):
        own = c.between("0", "9")
        return F.struct(
            F.concat(s["out"], F.when(own, F.substring(digits, s["k"], F.lit(1))).otherwise(c)).alias("out"),
            F.when(own, s["k"] + 1).otherwise(s["k"]).alias("k"),
        )

    return F.aggregate(F.split(shape, ""), start, step, lambda s: s["out"])


def luhn_sum(digits: Column) -> Column:
    """Weighted digit sum of a card number; valid if divisible by 10."""

    def weight(c, k):
        twice = c.cast("int") * 2
        return F.when(k % 2 == 0, c.cast("int")).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), weight), F.lit(0), lambda a, b: a + b)


def mod97(text: Column) -> Column:
    """Remainder by 97 of an account number's letters and digits, letters as 10 to 35."""

    def step(acc, c):
        letter = c.between("A", "Z")
        value = F.when(letter, F.ascii(c) - 55).otherwise(F.ascii(c) - 48)
        return F.pmod(acc * F.when(letter, 100).otherwise(10) + value, F.lit(97)).cast("int")

    return F.aggregate(F.split(text, ""), F.lit(0), step)


def _card(h: Column, key: str) -> Column:
    d = _digits(h)
    inner = permute_text(F.substring(d, F.lit(2), F.length(d) - 2), key, "card")
    body = F.concat(F.substring(d, 1, 1), inner)
    check = F.pmod(F.lit(10) - F.pmod(luhn_sum(F.concat(body, F.lit("0"))), F.lit(10)), F.lit(10)).cast("string")
    return F.when(F.pmod(luhn_sum(d), F.lit(10)) == 0, _refill(h, F.concat(body, check)))


def _iban(h: Column, key: str) -> Column:
    plain = F.regexp_replace(h, " ", "")
    country, body = F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.length(plain))
    valid = mod97(F.concat(body, F.substring(plain, 1, 4))) == 1
    new = permute_text(body, key, "iban")
    check = F.lpad((F.lit(98) - mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
    # Spaces go back by blocks of the original: each character of the shape but a space takes the next one.
    flat = F.concat(country, check, new)
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))
    step = lambda s, c: F.struct(
        F.concat(s["out"], F.when(c == " ", c).otherwise(F.substring(flat, s["k"], F.lit(1)))).alias("out"),
        F.when(c == " ", s["k"]).otherwise(s["k"] + 1).alias("k"),
    )
    return F.when(valid, F.aggregate(F.split(h, ""), start, step, lambda s: s["out"]))


def _date(h: Column, key: str) -> Column:
    def of(fmt: str) -> Column:
        day = F.try_to_timestamp(h, F.lit(fmt)).cast("date")
        new = permute_number(F.datediff(day, F.lit(FIRST_DAY).cast("date")).cast("long"), DAYS, key, "date")
        return F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), new.cast("int")), fmt)

    return (
        F.when(h.rlike("^[0-9]{4}-"), of("yyyy-MM-dd")).when(h.contains("."), of("dd.MM.yyyy"))
        .otherwise(F.coalesce(of("MM/dd/yyyy"), of("dd/MM/yyyy")))
    )


def _ip(h: Column, key: str) -> Column:
    parts = F.transform(F.split(h, r"\."), lambda x: x.cast("long"))
    number = F.aggregate(parts, F.lit(0).cast("long"), lambda a, b: a * 256 + b)
    new = permute_number(number, (1 << 16, 1 << 16), key, "ip")
    octet = lambda k: F.pmod(F.floor(new / F.lit(1 << 8 * k)), F.lit(256)).cast("string")
    return F.when(F.forall(parts, lambda x: x <= 255), F.concat_ws(".", octet(3), octet(2), octet(1), octet(0)))


def _ssn(h: Column, key: str) -> Column:
    area, group, serial = (F.split(h, "-")[k].cast("long") for k in range(3))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    rank = (area - F.when(area > 666, 2).otherwise(1)) * (99 * 9999) + (group - 1) * 9999 + serial - 1
    new = permute_number(rank, (898 * 99, 9999), key, "ssn")
    block = F.floor(new / 9999).cast("long")
    low = F.floor(block / 99).cast("long")
    digits = F.concat_ws(
        "-", F.lpad((low + F.when(low >= 665, 2).otherwise(1)).cast("string"), 3, "0"),
        F.lpad((F.pmod(block, F.lit(99)) + 1).cast("string"), 2, "0"), F.lpad((F.pmod(new, F.lit(9999)) + 1).cast("string"), 4, "0"),
    )
    return F.when(valid, digits)


def _phone(h: Column, key: str) -> Column:
    d = _digits(h)
    code = F.when(h.startswith("+"), F.length(F.regexp_extract(h, r"^\+([0-9]{1,3})", 1))).otherwise(0)
    own = F.substring(d, code + 1, F.length(d))
    new = F.concat(F.substring(d, F.lit(1), code), permute_text(own, key, "phone"))
    return F.when(F.length(d).between(7, 15), _refill(h, new))


def _email(h: Column, key: str) -> Column:
    own = F.regexp_replace(h, r"\.[A-Za-z]+$", "")
    return F.concat(permute_text(own, key, "email"), F.substring(h, F.length(own) + 1, F.length(h)))


def kind_of(h: Column) -> Column:
    """The kind of a match, told from its shape."""
    only = lambda pattern: "^(?:" + pattern + ")$"
    plain = lambda kind: only(PATTERNS[kind].replace(r"\2", r"\1").replace(r"\3", r"\2").replace(r"\4", r"\1"))
    out = F.when(h.contains("@"), "email")
    for kind in list(PATTERNS)[1:]:
        out = out.when(h.rlike(plain(kind)), kind)
    return out


def pseudonym(h: Column, key: str) -> Column:
    """What a match becomes; itself if it doesn't hold as a value of its kind."""
    makers = {"email": _email, "iban": _iban, "date": _date, "ip": _ip, "card": _card, "ssn": _ssn, "phone": _phone}
    kind, out = kind_of(h), None
    for name, make in makers.items():
        out = F.when(kind == name, make(h, key)) if out is None else out.when(kind == name, make(h, key))
    return F.coalesce(out, h)


def pseudonymise(df: DataFrame, key: str, text_col: str = "text", out_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``df`` with the personal data of ``text_col`` replaced, in ``out_col``; with ``count_col`` also how many were.

    All columns of ``df`` stay; only ``out_col`` and ``count_col`` are set. Null stays null (count 0), texts
    without a match stay as they are, however long. Keep ``key`` secret: it links equal values across runs.
    Kinds: see ``PATTERNS``. Numbers that fail their checksum or range, and dates that aren't in the
    calendar, stay.
    """
    text = F.col(text_col)
    pattern = F.lit(PATTERN)
    able = text.rlike(r"[0-9]{2}|@|[0-9]\.[0-9]")
    found = F.when(able, F.regexp_extract_all(text, pattern, F.lit(0))).otherwise(F.array().cast("array<string>"))
    rows = df.withColumn("_found", found)
    rows = rows.withColumn("_new", F.when(F.size("_found") > 0, F.transform("_found", lambda h: pseudonym(h, key))))
    pieces = F.zip_with(F.split(text, PATTERN, -1), F.col("_new"), lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    rows = rows.withColumn("_out", F.when(F.size("_found") > 0, F.array_join(pieces, "")).otherwise(text))
    if count_col:
        changed = F.size(F.filter(F.arrays_zip(F.col("_found").alias("a"), F.col("_new").alias("b")), lambda p: p["a"] != p["b"]))
        rows = rows.withColumn(count_col, F.when(F.size("_found") > 0, changed).otherwise(0).cast("long"))
    return rows.withColumn(out_col, F.col("_out")).drop("_found", "_new", "_out")
