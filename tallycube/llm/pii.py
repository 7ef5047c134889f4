"""Format-preserving pseudonyms for validated numbers, dates and mail addresses in text.

A match is taken apart into symbols, each from a range of its own (a digit, a letter, a number of an address, a year).
A Feistel network over the two halves of the symbols, keyed by SHA-256, permutes all values of one format among
themselves: a value has the same pseudonym wherever it occurs, two values never share one, and a pseudonym is valid where
the value was (check digits are computed anew, dates exist). Everything is a Spark SQL expression.

Cards and IBANs with blanks stand beside other groups of digits or letters. A match of theirs is a whole run of groups;
every part of it that starts and ends at a border of groups is tested, and what is not valid in it stays. A card has an
issuer's prefix and that issuer's length, is printed in one run or in the groups of cards, and passes its check digit: a row
of numbers is no card because some of them happen to pass the check.

Blanks and dashes of cards and IBANs, and the layout of dates, do not belong to the value: it is permuted without them and
laid out again, so it has one pseudonym in all layouts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tallycube.llm.common import quoted, shielded
from tallycube.sources.tables import literal_table

ROUNDS = 8
FIRST_YEAR, YEARS = 1900, 200  # dates of other years are not taken for dates of persons
OUTPUT = ["pii_kinds"]

OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
DATE = r"(?<![\w./-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4})(?![\w/-])"
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
IPV4 = rf"(?<![\w.])(?:{OCTET}\.){{3}}{OCTET}(?![\w]|\.\d)"
LOCAL_PHONE = r"\d{3}[-.]\d{3}[-.]\d{4}(?![\w-])"
# Groups of digits up to a date, a number or an address of another kind.
OTHER = rf"(?:{DATE}|{SSN}|{IPV4}|{LOCAL_PHONE}|\d++[\w@])"
DIGITS = rf"(?!{LOCAL_PHONE})\d++(?!\w)(?:(?: (?!{OTHER})|-)\d++(?!\w))*+"
# Patterns of candidates, in order of preference. A candidate is replaced only if it is valid, too.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+",
    "iban": rf"(?<!\w)[A-Z]{{2}}\d{{2}}(?:[A-Z0-9]{{11,30}}(?!\w)|(?: [A-Z0-9]{{4}}){{2,7}}(?: [A-Z0-9]{{1,3}})?(?![\w@%+/-]|\.\w)(?:(?: (?!{OTHER})|-){DIGITS})?)",
    "ipv4": IPV4,
    "date": DATE,
    "ssn": SSN,
    "card": rf"(?<![\w+-])(?=(?:\d[ -]?){{12}}\d){DIGITS}",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}|\(\d{3}\) ?\d{3}[-. ]\d{4}|\d{3}[-.]\d{3}[-.]\d{4})(?!\w)",
}
CANDIDATE = "|".join(f"(?:{p})" for p in PATTERNS.values())
# Groups as they are printed on cards.
CARD_FORM = r"^(?:\d+|\d{4}([ -])\d{4}\1\d{4}\1\d{4}(?:\1\d{3})?|\d{4}([ -])\d{6}\2\d{4,5}|\d{4}([ -])\d{4}\3\d{5})$"
# Prefixes of card issuers, each with the lengths of their numbers.
ISSUERS = [
    r"4\d{12}(?:\d{3}){0,2}",
    r"5[1-5]\d{14}",
    r"(?:222[1-9]|22[3-9]\d|2[3-6]\d{2}|27[01]\d|2720)\d{12}",
    r"3[47]\d{13}",
    r"(?:30[0-5]\d|36\d{2}|3[89]\d{2})\d{10,12}",
    r"35(?:2[89]|[3-8]\d)\d{12,15}",
    r"(?:6011|64[4-9]\d|65\d{2}|62\d{2})\d{12,15}",
]
ISSUED = "^(?:" + "|".join(ISSUERS) + ")$"
MOST_FOURS = 12  # groups of four digits in a row, those of three cards
FOURS_BEFORE, FOURS_AFTER = r"(?:(?<!\d)\d{4}[ -])*$", r"^(?:[ -]\d{4}(?!\d))*"
COUNTRY_CODE = r"^\+\d{1,3}(?=[ .(-])|^\+\d"


def ints(values: list[int]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def pick(*cases: tuple[Column, Column]) -> Column:
    """The value of the first case that holds, or null."""
    out = F.when(*cases[0])
    for condition, value in cases[1:]:
        out = out.when(condition, value)
    return out


def number(text: Column) -> Column:
    return text.try_cast("int")


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda s, x: s + x)


def digits_of(m: Column) -> Column:
    return F.transform(F.split(F.regexp_replace(m, "[^0-9]", ""), ""), number)


def luhn_sum(digits: Column) -> Column:
    """Sum of the digits with every second from the right, the last left out, doubled and its digits added."""
    n = F.size(digits)
    return total(F.transform(digits, lambda d, i: F.when((n - i) % 2 == 0, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)))


def mod97(text: Column) -> Column:
    """Remainder of the number that the characters spell, letters as 10 to 35."""

    def step(s: Column, c: Column) -> Column:
        return F.when(c.between("0", "9"), (s * 10 + number(c)) % 97).otherwise((s * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(F.split(text, ""), F.lit(0), step)


def unspaced(m: Column) -> Column:
    return F.regexp_replace(m, "[ -]", "")


def laid_out(text: Column, m: Column) -> Column:
    """The characters of `text` with the blanks and dashes of `m` between them."""
    before = lambda i: F.length(unspaced(F.substring(m, F.lit(1), i)))
    return F.array_join(F.transform(F.split(m, ""), lambda c, i: F.when(c.isin(" ", "-"), c).otherwise(F.substring(text, before(i) + 1, F.lit(1)))), "")


def permuted(x: Column, key: Column) -> Column:
    """New values of the symbols in `form`. Odd rounds shift the first half by a hash of the second half, even rounds the
    other way round, each symbol within its range: every round can be undone."""
    form = x["form"]
    n = F.size(form)
    half = F.floor(n / 2).cast("int")

    def round_(state: Column, r: Column) -> Column:
        first = r % 2 == 1
        other = F.array_join(F.when(first, F.slice(state, half + 1, n - half)).otherwise(F.slice(state, F.lit(1), half)), ",")

        def shifted(v: Column, i: Column) -> Column:
            h = F.sha2(F.concat_ws("|", key, x["format"], r, i, other), 256)
            by = F.conv(F.substring(h, 1, 12), 16, 10).cast("long")
            size = F.get(form, i)["size"]
            return F.when(((i < half) == first) & (size > 1), F.pmod(v + by, size).cast("int")).otherwise(v)

        return F.transform(state, shifted)

    values = F.transform(form, lambda s: s["value"])
    return F.when(form.isNotNull(), F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), values, round_))


def date_parts(m: Column) -> Column:
    """struct(y, m, d, day_first, iso, told): parts of a date; slashes are month first where that gives a month, so that
    only a day over 12 tells that it is first."""
    p = F.transform(F.split(m, "[-./]"), number)
    a, b, c = p[0], p[1], p[2]
    iso = m.rlike(r"^\d{4}-")
    day_first = m.contains(".") | (a > 12)
    year = F.when(iso, a).otherwise(c)
    month = F.when(iso, b).when(day_first, b).otherwise(a)
    day = F.when(iso, c).when(day_first, a).otherwise(b)
    return F.struct(year.alias("y"), month.alias("m"), day.alias("d"), (~iso & day_first).alias("day_first"), iso.alias("iso"), (m.contains("/") & (a > 12)).alias("told"))


def month_days(p: Column) -> Column:
    leap = ((p["y"] % 4 == 0) & (p["y"] % 100 != 0)) | (p["y"] % 400 == 0)
    return F.when(p["m"] == 2, F.when(leap, 29).otherwise(28)).when(p["m"].isin(4, 6, 9, 11), 30).otherwise(31)


def iban_rest(m: Column) -> Column:
    """Remainder of an IBAN; 1 if it is valid. Blanks do not count."""
    plain = F.replace(m, F.lit(" "), F.lit(""))
    return mod97(F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4)))


def parts_of(x: Column) -> Column:
    """Structs (gap, m, kind) of a match: for a card or an IBAN, each valid part of it with what stands before, and the
    rest; of parts that overlap, the IBAN or the longer one is taken. Other matches are one struct."""
    kind, m = x["kind"], x["m"]
    n, chars = F.size(x["chars"]), x["chars"]
    blank = lambda k: F.get(chars, k).isin(" ", "-")
    starts = F.filter(F.sequence(F.lit(1), n), lambda s: (s == 1) | blank(s - 2))

    def ending(s: Column) -> Column:
        ends = F.filter(F.sequence(s + 12, F.least(n, s + 41)), lambda e: (e == n) | blank(e))
        return F.when(s + 12 <= n, F.transform(ends, lambda e: F.struct(s.alias("s"), e.alias("e"), F.substring(m, s, e - s + 1).alias("m"))))

    def named(p: Column) -> Column:
        plain = unspaced(p["m"])
        n_chars = F.length(plain)
        # Groups of four before and after: cards may stand one behind the other, but a long row of such groups is no card.
        begin = F.greatest(F.lit(1), p["s"] - 5 * MOST_FOURS - 5)
        fours = F.length(F.regexp_extract(F.substring(m, begin, p["s"] - begin), FOURS_BEFORE, 0)) / 5
        more = F.length(F.regexp_extract(F.substring(m, p["e"] + 1, F.lit(5 * MOST_FOURS + 5)), FOURS_AFTER, 0)) / 5
        alone = fours + 4 + more <= MOST_FOURS
        card = plain.rlike(ISSUED) & p["m"].rlike(CARD_FORM) & (alone | ~p["m"].rlike(r"^\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}"))
        iban = (p["s"] == 1) & p["m"].rlike(r"^[A-Z]{2}\d{2}[A-Z0-9 ]+$") & n_chars.between(15, 34)
        found = F.when(card, F.when(luhn_sum(digits_of(p["m"])) % 10 == 0, "card")).when(iban, F.when(iban_rest(p["m"]) == 1, "iban"))
        rank = F.when(found == "iban", 0).otherwise(1)
        return F.struct(rank.alias("rank"), (-n_chars).alias("size"), p["s"].alias("s"), p["e"].alias("e"), p["m"].alias("m"), found.alias("kind"))

    whole = F.flatten(F.filter(F.transform(starts, ending), lambda e: e.isNotNull()))
    ranked = F.array_sort(F.filter(F.transform(whole, named), lambda p: p["kind"].isNotNull()))
    apart = lambda some, p: ~F.exists(some, lambda q: (q["s"] <= p["e"]) & (p["s"] <= q["e"]))
    none = F.array().cast("array<struct<s:int,e:int,m:string,kind:string>>")
    picked = F.array_sort(F.aggregate(ranked, none, lambda some, p: F.when(apart(some, p), F.concat(some, F.array(F.struct(p["s"], p["e"], p["m"], p["kind"])))).otherwise(some)))

    def split(some: Column) -> Column:
        after = lambda k: F.coalesce(F.get(some, k - 1)["e"], F.lit(0))
        own = F.transform(some, lambda p, k: F.struct(F.substring(m, after(k) + 1, p["s"] - after(k) - 1).alias("gap"), p["m"].alias("m"), p["kind"].alias("kind")))
        rest = F.struct(F.lit("").alias("gap"), F.substring(m, after(F.size(some)) + 1, n).alias("m"), F.lit(None).cast("string").alias("kind"))
        return F.concat(own, F.array(rest))

    parts = F.get(F.transform(F.array(picked), split), F.lit(0))
    return F.when(kind.isin("card", "iban"), parts).otherwise(F.array(F.struct(F.lit("").alias("gap"), m.alias("m"), kind.alias("kind"))))


def valid(x: Column) -> Column:
    kind, m, p = x["kind"], x["m"], x["date"]
    fields = F.transform(F.split(m, "-"), number)
    n_digits = F.length(F.regexp_replace(m, "[^0-9]", ""))
    return pick(
        (kind.isin("email", "ipv4", "card", "iban"), F.lit(True)),  # cards and IBANs are tested by their parts
        (kind == "date", p["y"].between(FIRST_YEAR, FIRST_YEAR + YEARS - 1) & p["m"].between(1, 12) & p["d"].between(1, month_days(p))),
        (kind == "ssn", fields[0].between(1, 899) & (fields[0] != 666) & (fields[1] > 0) & (fields[2] > 0)),
        (kind == "phone", n_digits.between(8, 15)),
    )


# Months that have a day 31, and those that have a day 29 and 30 in every year.
LONG_MONTHS = [1, 3, 5, 7, 8, 10, 12]
SAFE_MONTHS = [1, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12]


def date_form(p: Column) -> tuple[Column, Column]:
    """Symbols of a date and their ranges. Days to 28 go with any month and year; a later day is kept, and its month moves
    among those that have it. Where only a day over 12 tells the day from the month, the day stays over 12."""
    year = p["y"] - FIRST_YEAR
    low = F.when(p["told"], 13).otherwise(1)
    leap_day = (p["m"] == 2) & (p["d"] == 29)
    late = lambda months: F.array(year, F.array_position(months, p["m"]).cast("int") - 1)
    values = (
        F.when(p["d"] <= 28, F.array(year, p["m"] - 1, p["d"] - low))
        .when(leap_day, F.array(F.floor((p["y"] - 1904) / 4).cast("int")))
        .when(p["d"] == 31, late(ints(LONG_MONTHS)))
        .otherwise(late(ints(SAFE_MONTHS)))
    )
    sizes = (
        F.when(p["d"] <= 28, F.array(F.lit(YEARS), F.lit(12), 29 - low))
        .when(leap_day, ints([49]))
        .when(p["d"] == 31, ints([YEARS, 7]))
        .otherwise(ints([YEARS, 11]))
    )
    return values, sizes


def date_text(m: Column, p: Column, v: Column) -> Column:
    leap_day = (p["m"] == 2) & (p["d"] == 29)
    low = F.when(p["told"], 13).otherwise(1)
    year = F.when(leap_day, 1904 + 4 * v[0]).otherwise(FIRST_YEAR + v[0])
    month = (
        F.when(leap_day, 2)
        .when(p["d"] <= 28, F.get(v, F.lit(1)) + 1)
        .when(p["d"] == 31, F.get(ints(LONG_MONTHS), F.get(v, F.lit(1))))
        .otherwise(F.get(ints(SAFE_MONTHS), F.get(v, F.lit(1))))
    )
    day = F.when(p["d"] <= 28, F.get(v, F.lit(2)) + low).otherwise(p["d"])
    parts = F.split(m, "[-./]")
    # A part that had two digits, or needs them, has two; a single digit stays single where it can.
    two = lambda x, was: F.when(F.length(was) == 2, F.lpad(x.cast("string"), 2, "0")).otherwise(x.cast("string"))
    sep = F.regexp_extract(m, "[-./]", 0)
    return F.when(p["iso"], F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), two(month, parts[1]), two(day, parts[2]))).otherwise(
        F.concat(two(F.when(p["day_first"], day).otherwise(month), parts[0]), sep, two(F.when(p["day_first"], month).otherwise(day), parts[1]), sep, year.cast("string"))
    )


def char_form(kind: Column, m: Column) -> Column:
    """One struct(value, size, base) for each character; characters that stay have size 1. `base` is the code of value 0."""
    chars = F.split(m, "")
    n = F.length(m)
    keep = pick((kind == "phone", F.length(F.regexp_extract(m, COUNTRY_CODE, 0))), (kind == "iban", F.lit(4)), (kind.isin("email", "card"), F.lit(0)))
    tail = pick((kind == "email", n - F.instr(m, "@") + 1), (kind == "card", F.lit(1)), (kind.isin("iban", "phone"), F.lit(0)))

    def symbol(c: Column, i: Column) -> Column:
        code = F.ascii(c)
        free = (i >= keep) & (i < n - tail)
        digit = c.between("0", "9")
        # A leading digit of a group of a telephone number stays among 0 and 1, or among 2 to 9.
        leads = (kind == "phone") & digit & ~F.substring(m, i, F.lit(1)).between("0", "9")
        base = F.when(leads & (c >= "2"), 50).when(digit, 48).when(c.between("a", "z"), 97).when(c.between("A", "Z"), 65).otherwise(code)
        size = F.when(~free, 1).when(leads & (c >= "2"), 8).when(leads, 2).when(digit, 10).when(c.rlike("^[A-Za-z]$"), 26).otherwise(1)
        return F.struct((code - base).alias("value"), size.alias("size"), base.alias("base"))

    return F.transform(chars, symbol)


def octet_base(v: Column) -> Column:
    """Numbers of an address move among those of as many digits."""
    return F.when(v >= 100, 100).when(v >= 10, 10).otherwise(0)


def form_of(x: Column) -> Column:
    """struct(value, size, base) for each symbol of a valid match."""
    kind, m = x["kind"], x["m"]
    octets = F.transform(F.split(m, r"\."), number)
    octet_size = lambda v: F.when(v >= 100, 156).when(v >= 10, 90).otherwise(10)
    ssn = F.transform(F.split(m, "-"), number)
    values, sizes = date_form(x["date"])
    plain = lambda v, n: F.struct(v.alias("value"), n.alias("size"), F.lit(0).alias("base"))
    return pick(
        (kind.isin("email", "iban", "card", "phone"), char_form(kind, m)),
        (kind == "ipv4", F.transform(octets, lambda v: F.struct((v - octet_base(v)).alias("value"), octet_size(v).alias("size"), octet_base(v).alias("base")))),
        (kind == "date", F.zip_with(values, sizes, plain)),
        (kind == "ssn", F.zip_with(F.array(ssn[0] - F.when(ssn[0] > 666, 2).otherwise(1), ssn[1] - 1, ssn[2] - 1), ints([898, 99, 9999]), plain)),
    )


def format_of(x: Column) -> Column:
    """What stays as it is belongs to the format: the kind, the ranges, and characters that do not move."""
    same = F.when(x["kind"].isin("email", "iban", "card", "phone"), F.array_join(F.transform(x["form"], lambda s: F.when(s["size"] == 1, F.char(s["base"] + s["value"])).otherwise("*")), ""))
    return F.concat_ws("/", x["kind"], F.array_join(F.transform(x["form"], lambda s: s["size"]), "."), same)


def rendered(x: Column) -> Column:
    """Text of the permuted symbols; check digits are put right by `checked`."""
    kind, m, v = x["kind"], x["m"], x["v"]
    area = v[0] + F.when(v[0] >= 665, 2).otherwise(1)
    return pick(
        (kind.isin("email", "iban", "card", "phone"), F.array_join(F.zip_with(x["form"], v, lambda s, y: F.char(s["base"] + y)), "")),
        (kind == "ipv4", F.array_join(F.zip_with(x["form"], v, lambda s, y: s["base"] + y), ".")),
        (kind == "date", date_text(m, x["date"], v)),
        (kind == "ssn", F.concat_ws("-", F.lpad(area.cast("string"), 3, "0"), F.lpad((v[1] + 1).cast("string"), 2, "0"), F.lpad((v[2] + 1).cast("string"), 4, "0"))),
    )


def checked(x: Column) -> Column:
    text, m, kind = x["text"], x["m"], x["kind"]
    head = F.substring(text, F.lit(1), F.length(m) - 1)
    luhn = (10 - luhn_sum(digits_of(F.concat(head, F.lit("0")))) % 10) % 10
    bban, country = F.substring(text, 5, 40), F.substring(m, 1, 2)
    mod = F.lpad((98 - mod97(F.concat(F.replace(bban, F.lit(" "), F.lit("")), country, F.lit("00")))).cast("string"), 2, "0")
    return F.when(kind == "card", F.concat(head, luhn.cast("string"))).when(kind == "iban", F.concat(country, mod, bban)).otherwise(text)


def kind_of(m: Column) -> Column:
    """Name of the first pattern that the whole match has; the order is that of the candidates."""
    out = F.when(m.contains("@"), "email")
    for name in list(PATTERNS)[1:]:
        out = out.when(m.rlike(f"^(?:{PATTERNS[name]})$"), name)
    return out


def pseudonymise(documents: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Documents with `text` replaced, and `pii_kinds`, the kind of each replaced value in order.

    Lengths stay, but for a day or month of one digit that becomes two. A null text stays null and has no kinds, an
    empty one stays empty; other columns and repeated rows pass as they are; a column named `pii_kinds` is replaced;
    an empty table gives no rows. Candidates that are not valid (no check digit, no such date) are left alone. Of the
    groups in a row of numbers, four of four digits may be a card by chance if the row has few more: about three in two
    hundred. The key comes as a table of one row, and so stands in no plan.
    """
    secret = literal_table(documents.sparkSession, [(key,)], "secret string")
    return shielded(documents, OUTPUT, [text], lambda plain, name: _pseudonymise(plain, secret, name))


def _pseudonymise(documents: DataFrame, secret: DataFrame, text: str) -> DataFrame:
    columns_ = documents.columns
    source, key = documents.join(F.broadcast(secret)), F.col("secret")
    t = quoted(text).cast("string")
    some = t.rlike("[0-9@]")
    found = source.withColumn("_found", F.when(some, F.regexp_extract_all(t, F.lit(CANDIDATE), F.lit(0))))

    # Each step adds to the structs of the matches, so that no expression is written out twice.
    def step(of, **fields):
        return F.transform("_found", lambda x: F.struct(*[x[c].alias(c) for c in of], *[f(x).alias(c) for c, f in fields.items()]))

    isdate = lambda x: F.when(x["kind"] == "date", date_parts(x["m"]))
    def with_gap(g, parts):
        return F.transform(parts, lambda p, i: F.struct(F.when(i == 0, F.concat(g, p["gap"])).otherwise(p["gap"]).alias("gap"), p["m"].alias("m"), p["kind"].alias("kind")))

    gaps = F.split(t, CANDIDATE, -1)
    steps = [
        F.transform("_found", lambda m: F.struct(m.alias("m"), kind_of(m).alias("kind"))),
        step(["m", "kind"], chars=lambda x: F.when(x["kind"].isin("card", "iban"), F.split(x["m"], ""))),
        F.transform("_found", parts_of),
        F.flatten(F.zip_with(F.slice(gaps, F.lit(1), F.size("_found")), "_found", with_gap)),
        step(["gap", "kind"], shown=lambda x: x["m"], m=lambda x: F.when(x["kind"].isin("card", "iban"), unspaced(x["m"])).otherwise(x["m"])),
        step(["gap", "shown", "m", "kind"], date=isdate),
        step(["gap", "shown", "m", "date"], kind=lambda x: F.when(valid(x), x["kind"])),
        step(["gap", "shown", "m", "kind", "date"], form=form_of),
        step(["gap", "shown", "m", "kind", "date", "form"], format=format_of),
        step(["gap", "shown", "m", "kind", "date", "form"], v=lambda x: permuted(x, key)),
        step(["gap", "shown", "m", "kind"], text=rendered),
        step(["gap", "shown", "kind"], text=checked),
        step(["gap", "kind"], text=lambda x: F.coalesce(F.when(x["kind"].isin("card", "iban"), laid_out(x["text"], x["shown"])).otherwise(x["text"]), x["shown"])),
    ]
    done = found
    for s in steps:
        done = done.withColumn("_found", F.when(F.size("_found") > 0, s))
    new = F.concat(F.array_join(F.transform("_found", lambda x: F.concat(x["gap"], x["text"])), ""), F.element_at(gaps, -1))
    kinds = F.filter(F.transform("_found", lambda x: x["kind"]), lambda k: k.isNotNull())
    columns = [F.when(F.col("_found").isNotNull(), new).otherwise(t).alias(text) if c == text else quoted(c) for c in columns_]
    return done.select(*columns, F.coalesce(kinds, F.array().cast("array<string>")).alias("pii_kinds"))
