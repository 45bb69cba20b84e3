"""Format-preserving pseudonyms for personal numbers, dates and mail names.

A pattern finds candidates, a rule for each kind validates them, and a keyed
Feistel network permutes the valid values within their format: card numbers
become card numbers that pass the Luhn test, dates become dates. Equal values
get equal pseudonyms in all documents, and the key gives the values back. All in
DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm.common import column, table

ROUNDS = 10
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
ISO_DATE = r"(?<![\d./-])\d{4}(?<iso>[-/.])\d{2}\k<iso>\d{2}(?![\d-]|[./]\d)"
DATE = r"(?<![\d./-])\d{1,2}(?<day>[-/.])\d{1,2}\k<day>\d{4}(?![\d-]|[./]\d)"
IPV4 = r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
PLUS_PHONE = r"(?<![\d+])\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\d)|(?<![\d+])\+\d{1,3}(?:[ .()-]{0,2}\d){7,12}(?!\d)"
PHONE = r"(?<![\d(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.-])\d{3}[ .-]\d{3}[ .-]\d{4}(?![\d-])"
CARD = r"(?<!\d)\d(?:[ -]?\d){12,18}(?!\d)"
CANDIDATE = "|".join([EMAIL, IBAN, ISO_DATE, DATE, IPV4, SSN, PLUS_PHONE, PHONE, CARD])
#: The longest candidate from each place where one starts, also inside others.
AHEAD = f"(?=({CANDIDATE}))"
#: How cards are mostly written: taken before other runs of groups.
TIGHT = r"^(?:\d{13,19}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}|\d{4}[ -]\d{6}[ -]\d{4,5})$"
#: Lengths of cards, the likelier first.
CARD_LENGTHS = (16, 15, 14, 13, 19, 18, 17)
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH CR HR LI LV", 22: "BG BH DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
#: Country codes of two digits, by their first digit; 1 and 7 are of one digit, all others of three.
TWO_DIGIT_CODES = {"2": "07", "3": "0123469", "4": "013456789", "5": "12345678", "6": "0123456", "8": "1246", "9": "0123458"}
#: Dates of so many years from this one on.
FIRST_YEAR, YEARS = 1900, 200
#: Areas 001-899 but 666, groups 01-99, serials 0001-9999.
SSN_PARTS = (898 * 99, 9999)


def long(x: int) -> Column:
    return F.lit(x).cast("long")


def hashed(key: str, tweak: Column, turn: Column, other: Column) -> Column:
    """The keyed round function: 60 bits."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), tweak, turn.cast("string"), other.cast("string")), 256), 1, 15), 16, 10).cast("long")


def feistel(a: Column, b: Column, size_a: Column, size_b: Column, key: str, tweak: Column, back: bool) -> Column:
    """A permutation of the pairs (a, b) below the two sizes: each part in turn is shifted by a hash of the other."""
    sign = -1 if back else 1
    turns = F.array(*[F.lit(k) for k in (range(ROUNDS, 0, -1) if back else range(1, ROUNDS + 1))])
    return F.aggregate(
        turns,
        F.struct(a.cast("long").alias("a"), b.cast("long").alias("b")),
        lambda s, turn: F.when(
            turn % 2 == 1,
            F.struct(F.pmod(s["a"] + sign * F.pmod(hashed(key, tweak, turn, s["b"]), size_a), size_a).alias("a"), s["b"].alias("b")),
        ).otherwise(F.struct(s["a"].alias("a"), F.pmod(s["b"] + sign * F.pmod(hashed(key, tweak, turn, s["a"]), size_b), size_b).alias("b"))),
    )


def power(n: Column) -> Column:
    return F.concat(F.lit("1"), F.repeat(F.lit("0"), n)).cast("long")


def permuted_digits(digits: Column, key: str, kind: Column, back: bool) -> Column:
    """Another string of as many digits; up to 36."""
    return let(digits, lambda d: let(F.char_length(d), lambda n: _permuted(d, n, key, kind, back)))


def _permuted(digits: Column, n: Column, key: str, kind: Column, back: bool) -> Column:
    u = F.floor(n / 2).cast("int")
    v = n - u
    a = F.when(u > 0, digits.substr(F.lit(1), u)).otherwise(F.lit("0")).cast("long")
    b = digits.substr(u + 1, v).cast("long")
    new = feistel(a, b, power(u), power(v), key, F.concat(kind, n.cast("string")), back)

    def joined(x: Column) -> Column:
        low = F.lpad(x["b"].cast("string"), v, F.lit("0"))
        return F.when(u > 0, F.concat(F.lpad(x["a"].cast("string"), u, F.lit("0")), low)).otherwise(low)

    return let(new, joined)


def digits_of(x: Column) -> Column:
    return F.regexp_replace(x, r"[^0-9]", "")


def filled(shape: Column, digits: Column) -> Column:
    """The shape with its digits replaced in order."""
    return F.aggregate(
        F.split(shape, ""),
        F.struct(F.lit("").alias("text"), F.lit(0).alias("k")),
        lambda s, c: F.when(c.rlike("^[0-9]$"), F.struct(F.concat(s["text"], digits.substr(s["k"] + 1, F.lit(1))).alias("text"), (s["k"] + 1).alias("k"))).otherwise(
            F.struct(F.concat(s["text"], c).alias("text"), s["k"].alias("k"))
        ),
    )["text"]


def luhn(digits: Column, first_doubled: bool) -> Column:
    """The Luhn sum from the right; first_doubled: for digits that still lack their check digit."""
    ds = F.reverse(F.split(digits, ""))
    terms = F.transform(ds, lambda d, i: F.when((i % 2 == 1) != F.lit(first_doubled), F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), d.cast("int") + 1)).otherwise(d.cast("int")))
    return F.aggregate(terms, F.lit(0), lambda s, x: s + x)


def mod97(text: Column) -> Column:
    """Of letters and digits read as a number, letters as 10 to 35."""
    return F.aggregate(
        F.split(text, ""),
        F.lit(0),
        lambda s, c: F.when(c.rlike("^[0-9]$"), (s * 10 + F.ascii(c) - 48) % 97).otherwise((s * 100 + F.ascii(c) - 55) % 97),
    )


def card(m: Column, key: str, back: bool) -> Column:
    digits = digits_of(m)
    n = F.char_length(digits)
    body = permuted_digits(digits.substr(F.lit(1), n - 1), key, F.lit("card"), back)
    check = F.pmod(10 - luhn(body, True) % 10, F.lit(10)).cast("string")
    return F.when(n.between(13, 19) & (luhn(digits, False) % 10 == 0), filled(m, F.concat(body, check))).otherwise(m)


def iban(m: Column, key: str, back: bool) -> Column:
    flat = F.regexp_replace(m, " ", "")
    country, account = flat.substr(1, 2), flat.substr(F.lit(5), F.char_length(flat))
    digits = digits_of(account)
    valid = F.char_length(flat).between(15, 34) & (F.char_length(digits) > 0) & (mod97(F.concat(account, flat.substr(1, 4))) == 1)
    new = filled(account, permuted_digits(digits, key, F.lit("iban"), back))
    check = F.lpad((98 - mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
    return F.when(valid, filled(m, digits_of(F.concat(check, new)))).otherwise(m)


def ssn(m: Column, key: str, back: bool) -> Column:
    area, group, serial = (m.substr(a, n).cast("int") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group >= 1) & (serial >= 1)
    place = area - F.when(area > 666, 2).otherwise(1)
    new = feistel(place * 99 + group - 1, serial - 1, long(SSN_PARTS[0]), long(SSN_PARTS[1]), key, F.lit("ssn"), back)
    low = F.floor(new["a"] / 99) + 1
    parts = (low + F.when(low >= 666, 1).otherwise(0), new["a"] % 99 + 1, new["b"] + 1)
    text = F.concat_ws("-", *[F.lpad(p.cast("string"), n, "0") for p, n in zip(parts, (3, 2, 4), strict=True)])
    return F.when(valid, text).otherwise(m)


def ipv4(m: Column, key: str, back: bool) -> Column:
    o = F.split(m, r"\.")
    part = lambda k: F.element_at(o, k).cast("int")
    valid = F.forall(o, lambda x: (x.cast("int") <= 255) & (x == x.cast("int").cast("string")))
    new = feistel(part(1) * 256 + part(2), part(3) * 256 + part(4), long(65536), long(65536), key, F.lit("ipv4"), back)
    text = F.concat_ws(".", *[y.cast("string") for p in (new["a"], new["b"]) for y in (F.floor(p / 256), p % 256)])
    return F.when(valid, text).otherwise(m)


def country_code(digits: Column) -> Column:
    """Of a number written after a plus; no code is the beginning of another."""
    two = F.regexp_extract(digits, "^(?:" + "|".join(f"{a}[{b}]" for a, b in TWO_DIGIT_CODES.items()) + ")", 0)
    return F.when(digits.rlike("^[17]"), digits.substr(1, 1)).when(two != "", two).otherwise(digits.substr(1, 3))


def phone(m: Column, key: str, back: bool) -> Column:
    """The number within its country is permuted; the country code stays. Without a plus the code is 1. A zero in brackets is no digit of the number."""
    plus = m.startswith("+")

    def written(x: Column) -> Column:
        own = F.when(plus, x["digits"].substr(F.char_length(x["code"]) + 1, F.char_length(x["digits"]))).otherwise(x["digits"])
        valid = F.when(x["code"] == "1", F.char_length(own) == 10).otherwise(F.char_length(x["digits"]).between(8, 15))
        new = permuted_digits(own, key, F.concat(F.lit("phone"), x["code"], F.lit(":")), back)
        return F.when(valid, F.replace(filled(x["shape"], F.concat(F.when(plus, x["code"]).otherwise(F.lit("")), new)), F.lit("\uE000"), F.lit("0"))).otherwise(m)

    shape = F.regexp_replace(m, r"\(0\)", "(\uE000)")
    read = lambda s: F.struct(s.alias("shape"), digits_of(s).alias("digits"), F.when(plus, country_code(digits_of(s))).otherwise(F.lit("1")).alias("code"))
    return let(let(shape, read), written)


def another_day(day: Column, key: str, back: bool) -> Column:
    """Permuted among the days that are written as widely and read alike: months up to the 9th or later, days up to the 9th, the 12th, or later.

    What is no day, like the 30th of February, is walked over.
    """
    def start(first: Column) -> Column:
        months, days = F.when(first["m"] > 9, 3).otherwise(9), F.when(first["d"] > 12, 19).when(first["d"] > 9, 3).otherwise(9)
        return F.struct(
            ((F.year(day) - FIRST_YEAR) * months + F.month(day) - first["m"]).cast("long").alias("a"), (F.dayofmonth(day) - first["d"]).cast("long").alias("b"),
            first["m"].alias("first_month"), months.alias("months"), first["d"].alias("first_day"), days.alias("days"),
        )

    firsts = F.struct(F.when(F.month(day) > 9, 10).otherwise(1).alias("m"), F.when(F.dayofmonth(day) > 12, 13).when(F.dayofmonth(day) > 9, 10).otherwise(1).alias("d"))
    year = lambda s: (F.floor(s["a"] / s["months"]) + FIRST_YEAR).cast("int")
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    made = lambda s: F.try_to_date(F.concat_ws("-", year(s).cast("string"), two(s["a"] % s["months"] + s["first_month"]), two(s["b"] + s["first_day"])), "yyyy-MM-dd")

    def step(s: Column) -> Column:
        kind = F.concat_ws("|", F.lit("date"), s["first_month"].cast("string"), s["first_day"].cast("string"))
        new = feistel(s["a"], s["b"], s["months"].cast("long") * YEARS, s["days"].cast("long"), key, kind, back)
        return F.transform(F.array(new), lambda n: F.struct(n["a"].alias("a"), n["b"].alias("b"), *[s[c].alias(c) for c in ("first_month", "months", "first_day", "days")]))[0]

    return F.aggregate(F.sequence(F.lit(1), F.lit(64)), let(firsts, start), lambda s, k: F.when((k == 1) | made(s).isNull(), step(s)).otherwise(s), made)


def let(value: Column, body) -> Column:
    """body of a value that is made, and written into the plan, once."""
    return F.transform(F.array(value), body)[0]


def dated(m: Column, key: str, back: bool) -> Column:
    """Year first, or day first, or, if that is no date, month first: one day in any of these gets one day."""

    def written(p: Column) -> Column:
        made = lambda y, mo, d: F.try_to_date(F.concat_ws("-", p[y], F.lpad(p[mo], 2, "0"), F.lpad(p[d], 2, "0")), "yyyy-MM-dd")
        read = F.when(F.char_length(p[0]) == 4, F.struct(F.lit("y").alias("order"), made(0, 1, 2).alias("day"))).otherwise(
            let(made(2, 1, 0), lambda first: F.when(first.isNotNull(), F.struct(F.lit("d").alias("order"), first.alias("day"))).otherwise(F.struct(F.lit("m").alias("order"), made(2, 0, 1).alias("day"))))
        )
        full = (F.char_length(p[0]) == 2) & (F.char_length(p[1]) == 2)
        number = lambda x: F.when(full, F.lpad(x.cast("string"), 2, "0")).otherwise(x.cast("string"))
        shown = lambda order, x: F.when(order == "y", F.date_format(x, "yyyy-MM-dd")).otherwise(
            F.concat_ws("-", F.when(order == "d", number(F.dayofmonth(x))).otherwise(number(F.month(x))), F.when(order == "d", number(F.month(x))).otherwise(number(F.dayofmonth(x))), F.lpad(F.year(x).cast("string"), 4, "0"))
        )
        inside = lambda r: F.year(r["day"]).between(FIRST_YEAR, FIRST_YEAR + YEARS - 1)
        return let(read, lambda r: F.when(inside(r), let(another_day(r["day"], key, back), lambda x: shown(r["order"], x))))

    sign = F.regexp_extract(m, r"[-/.]", 0)
    return F.coalesce(F.replace(let(F.split(m, r"[-/.]"), written), F.lit("-"), sign), m)


def shifted(chars: Column, other: Column, turn: Column, key: str, sign: int) -> Column:
    """Letters and digits of one half moved on within their kind by hashes of the other half."""
    text = F.lower(F.array_join(other, ""))  # so that a name in capitals stays linked
    move = lambda i: hashed(key, F.concat(F.lit("mail"), i.cast("string")), turn, text)

    def within(c: Column, i: Column, first: int, size: int) -> Column:
        return F.char((F.lit(first) + F.pmod(F.ascii(c) - first + sign * F.pmod(move(i), long(size)), long(size))).cast("int"))

    return F.transform(
        chars,
        lambda c, i: F.when(c.rlike("^[0-9]$"), within(c, i, 48, 10)).when(c.rlike("^[a-z]$"), within(c, i, 97, 26)).when(c.rlike("^[A-Z]$"), within(c, i, 65, 26)).otherwise(c),
    )


def email(m: Column, key: str, back: bool) -> Column:
    """The name before the sign; the domain stays."""
    name = F.substring_index(m, "@", 1)
    chars = F.split(name, "")
    half = F.floor(F.size(chars) / 2).cast("int")
    rounds = 6
    turns = F.array(*[F.lit(k) for k in (range(rounds, 0, -1) if back else range(1, rounds + 1))])
    sign = -1 if back else 1
    new = F.aggregate(
        turns,
        F.struct(F.slice(chars, F.lit(1), half).alias("a"), F.slice(chars, half + 1, F.size(chars)).alias("b")),
        lambda s, turn: F.when(turn % 2 == 1, F.struct(s["a"].alias("a"), shifted(s["b"], s["a"], turn, key, sign).alias("b"))).otherwise(
            F.struct(shifted(s["a"], s["b"], turn, key, sign).alias("a"), s["b"].alias("b"))
        ),
    )
    return F.concat(F.array_join(F.concat(new["a"], new["b"]), ""), m.substr(F.char_length(name) + 1, F.char_length(m)))


KINDS = [
    (r"@", email),
    (r"^[A-Z]{2}\d{2}", iban),
    (r"^(?:\d{4}([-/.])\d{2}\1\d{2}|\d{1,2}([-/.])\d{1,2}\2\d{4})$", dated),
    (r"^\d{1,3}(?:\.\d{1,3}){3}$", ipv4),
    (r"^\d{3}-\d{2}-\d{4}$", ssn),
    (r"^(?:\+|\(|\d{3}[ .-]\d{3}[ .-]\d{4}$)", phone),
    (r"", card),
]


def pseudonym(m: Column, key: str, back: bool = False) -> Column:
    """A candidate's pseudonym, or itself if it isn't valid. back: the value of a pseudonym."""
    out = None
    for pattern, rule in KINDS[:-1]:
        out = (F.when if out is None else out.when)(m.rlike(pattern), rule(m, key, back))
    return out.otherwise(KINDS[-1][1](m, key, back))


def starts_of(m: Column, end: str) -> Column:
    """The candidate cut at each end of a group, the whole last. end: what follows a group."""
    length = F.char_length(m)
    ends = F.filter(F.sequence(F.lit(13), length), lambda k: ((k == length) | m.substr(k + 1, F.lit(1)).rlike(end)) & ~m.substr(k, F.lit(1)).rlike(end))
    return F.transform(ends, lambda k: m.substr(F.lit(1), k))


def cards_in(m: Column) -> Column:
    """The cuts of a candidate that are cards, the likelier lengths first."""
    digits = F.transform(starts_of(m, "[ -]"), lambda x: F.struct(F.array_position(F.array(*[F.lit(n) for n in CARD_LENGTHS]), F.char_length(digits_of(x))).alias("place"), x.alias("x"), digits_of(x).alias("digits")))
    valid = F.filter(digits, lambda c: (c["place"] > 0) & (luhn(c["digits"], False) % 10 == 0))
    return F.transform(F.array_sort(valid), lambda c: c["x"])


def iban_in(m: Column) -> Column:
    """The cut of a candidate that is an IBAN: of its country's length, else the longest; null if none is."""
    lengths = F.create_map(*[F.lit(x) for n, countries in IBAN_LENGTHS.items() for c in countries.split() for x in (c, n)])
    flat = F.transform(starts_of(m, " "), lambda x: F.struct(x.alias("x"), F.regexp_replace(x, " ", "").alias("flat")))
    valid = F.filter(flat, lambda c: F.char_length(c["flat"]).between(15, 34) & (mod97(F.concat(c["flat"].substr(F.lit(5), F.char_length(c["flat"])), c["flat"].substr(1, 4))) == 1))
    right = F.filter(valid, lambda c: F.char_length(c["flat"]) == lengths[m.substr(1, 2)])
    return F.get(F.concat(right, F.reverse(valid)), F.lit(0))["x"]


def chosen(rows: DataFrame, key: str, back: bool) -> DataFrame:
    """_found (longest candidates by start) and _pieces (the text from each start to the next) -> _value, _new: what is taken at each start, else null.

    Values are taken from left to right without overlap: first all kinds, of cards
    those written tightly; then other cards within what is left between them.
    """
    none = F.array().cast("array<string>")
    is_iban = lambda m: m.rlike(KINDS[1][0]) & ~m.contains("@")
    is_card = lambda m: m.rlike(r"^[\d -]+$") & ~F.exists(F.array(*[F.lit(p) for p, _ in KINDS[2:-1]]), lambda p: F.regexp_like(m, p))
    rows = rows.withColumn("_cards", F.transform("_found", lambda m: F.when(is_card(m), cards_in(m))))
    first = lambda m, cards: F.when(cards.isNotNull(), F.get(F.filter(cards, lambda x: x.rlike(TIGHT)), F.lit(0))).when(is_iban(m), iban_in(m)).otherwise(m)
    rows = rows.withColumn("_first", F.zip_with("_found", "_cards", first))
    rows = rows.withColumn("_as", F.transform("_first", lambda m: pseudonym(m, key, back)))
    size = lambda x: F.coalesce(F.char_length(x), F.lit(0))
    rows = rows.withColumn("_items", F.arrays_zip(F.col("_pieces").alias("piece"), F.col("_first").alias("x"), F.col("_as").alias("y"), F.col("_cards").alias("cards")))
    taken = F.aggregate(
        "_items",
        F.struct(F.lit(0).alias("used"), none.alias("all")),
        lambda s, i: F.when(
            (s["used"] <= 0) & (i["x"] != i["y"]), F.struct((size(i["x"]) - size(i["piece"])).alias("used"), F.concat(s["all"], F.array(i["x"])).alias("all"))
        ).otherwise(F.struct((F.greatest(s["used"], F.lit(0)) - size(i["piece"])).alias("used"), F.concat(s["all"], F.array(F.lit(None).cast("string"))).alias("all"))),
    )["all"]
    rows = rows.withColumn("_taken", taken)
    free = F.aggregate(  # characters from each start to the next taken value, from the right
        F.reverse(F.arrays_zip(F.col("_pieces").alias("piece"), F.col("_taken").alias("x"))),
        F.struct(F.lit(1_000_000_000).alias("room"), F.array().cast("array<int>").alias("all")),
        lambda s, i: F.struct(F.when(i["x"].isNotNull(), F.lit(0)).otherwise(s["room"] + size(i["piece"])).alias("room"), F.concat(s["all"], F.array(s["room"] + size(i["piece"]))).alias("all")),
    )["all"]
    loose = F.exists(F.arrays_zip(F.col("_cards").alias("cards"), F.col("_taken").alias("x")), lambda i: i["x"].isNull() & (F.size(i["cards"]) > 0))
    rows = rows.withColumn("_rooms", F.when(loose, F.reverse(free)))
    fitting = lambda i: F.get(F.filter(i["cards"], lambda c: F.char_length(c) <= i["room"]), F.lit(0))
    late = F.aggregate(
        F.arrays_zip(F.col("_pieces").alias("piece"), F.col("_taken").alias("x"), F.col("_cards").alias("cards"), F.col("_rooms").alias("room")),
        F.struct(F.lit(0).alias("used"), none.alias("all")),
        lambda s, i: F.transform(
            F.array(F.when(i["x"].isNotNull(), i["x"]).when(s["used"] <= 0, fitting(i))),
            lambda x: F.struct((F.greatest(s["used"], size(x)) - size(i["piece"])).alias("used"), F.concat(s["all"], F.array(x)).alias("all")),
        )[0],
    )["all"]
    rows = rows.withColumn("_value", F.when(loose, late).otherwise(F.col("_taken")))
    new = lambda v, i: F.when(v.isNull(), F.lit(None)).when(v == i["x"], i["y"]).otherwise(card(v, key, back))
    return rows.withColumn("_new", F.zip_with("_value", "_items", new))


def rewritten(pieces: Column, values: Column, new: Column) -> Column:
    """The pieces with the values at their starts replaced; a value may reach over pieces."""
    skips = F.aggregate(
        F.arrays_zip(pieces.alias("piece"), values.alias("x")),
        F.struct(F.lit(0).alias("used"), F.array().cast("array<int>").alias("all")),
        lambda s, i: F.struct(
            F.greatest(F.coalesce(F.char_length(i["x"]), s["used"]) - F.char_length(i["piece"]), F.lit(0)).alias("used"),
            F.concat(s["all"], F.array(F.coalesce(F.char_length(i["x"]), s["used"]))).alias("all"),
        ),
    )["all"]
    left = F.zip_with(pieces, skips, lambda p, n: p.substr(n + 1, F.char_length(p)))
    return F.array_join(F.zip_with(new, left, lambda y, rest: F.concat(F.coalesce(y, F.lit("")), rest)), "")


def pseudonymize(docs: DataFrame, key: str, text: str = "text", count: str = "n_pseudonyms", back: bool = False) -> DataFrame:
    """Replaces the personal values in `text` and adds `count`, how many were replaced.

    Found: mail addresses (their name), IBANs (mod 97), dates of 1900 to 2099,
    IPv4 addresses, social security numbers, phone numbers (after a plus of 8 to 15
    digits, of country 1 and without a plus of 10), and card numbers of 13 to 19
    digits (Luhn). A value is linked however it is written: a phone number with or
    without its code 1, brackets and signs, a day in any order of its parts (day
    first where both could be), a card or IBAN with or without spaces, a mail name
    in any case. What fails its test stays as it is, and
    what starts inside it is tested too. Of digits in groups each run of whole
    groups may be a card. With back, the same key gives the values back; only a
    card in groups next to further groups may be lost to another run, where
    pseudonyms make one pass the Luhn test by chance.

    Whole texts, row by row without a shuffle. Null texts stay null and empty
    ones empty, with a count of 0; repeated rows stay and get the same text; an
    empty table stays empty; a column already named `count` is replaced. A value
    may by chance be its own pseudonym.
    """
    kept = [c for c in docs.columns if c.lower() != count.lower()]
    t = F.col("text")
    has = t.rlike(CANDIDATE)
    rows = docs.select(F.struct(*[column(c) for c in kept if c != text]).alias("row") if len(kept) > 1 else F.lit(0).alias("row"), column(text).alias("text"))
    rows = rows.select("row", "text", F.when(has, F.regexp_extract_all(t, F.lit(AHEAD), F.lit(1))).alias("_found"), F.when(has, F.split(t, AHEAD, -1)).alias("_split"))
    extra = F.size("_split") - F.size("_found")  # 1 unless a candidate starts the text
    rows = rows.withColumn("_head", F.when(extra == 1, F.col("_split")[0]).otherwise(F.lit("")))
    rows = rows.withColumn("_pieces", F.when(F.col("_found").isNotNull(), F.slice("_split", extra + 1, F.size("_found"))))
    rows = chosen(rows, key, back)
    changed = F.size(F.filter(F.arrays_zip(F.col("_value").alias("a"), F.col("_new").alias("b")), lambda x: x["a"] != x["b"]))
    new = F.when(F.col("_new").isNotNull(), F.concat("_head", rewritten(F.col("_pieces"), F.col("_value"), F.col("_new")))).otherwise(t)
    return rows.select(*[(new if c == text else F.col("row").getField(c)).alias(c) for c in kept], F.when(F.col("_new").isNotNull(), changed).otherwise(0).cast("long").alias(count))


#: Where a deployment keeps its secret; without it the queries take the key below, which whoever has this file can use.
KEY_SETTING, DEMONSTRATION_KEY = "spark.geoloom.pseudonym.key", "key of the queries in this repository"


def session_key(spark: SparkSession) -> str:
    """The key that the session sets, else the demonstration key."""
    return spark.conf.get(KEY_SETTING, DEMONSTRATION_KEY)


def op1_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal values replaced, under the session's key."""
    return pseudonymize(table(spark, sf_dir, "documents").select("doc_id", "text"), session_key(spark))
