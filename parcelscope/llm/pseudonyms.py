"""Format-preserving pseudonyms for private values, in DataFrame expressions only.

Values are found by pattern, validated (Luhn sum, remainder of an IBAN, octets, calendar, social
security ranges), and
replaced by a keyed permutation of the value space of their format: a card number becomes another
card number with a right check digit, a date another date. A permutation keeps equal values equal
and different values different, in every document. Of cards, IBANs and phone numbers the digits are
permuted without what stands between them, so that a number written in two ways stays linked, a
North American one also with and without +1.

The permutation is an alternating Feistel network over a value's units (digits, letters, octets,
day parts): in each round the units of one half are shifted by amounts drawn from the other half,
each within its own unit's size, so any mix of sizes stays a permutation. The shifts come from
SHA-256 of key, kind, round, place and the other half.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelscope.llm.text import own_name

ROUNDS = 8
HEX = "0123456789abcdef"
# Days 1800-01-01 to 2199-12-31: one whole Gregorian cycle of 146,097 = 189 * 773 days.
FIRST_DAY = "1800-01-01"
DAY_UNITS = (189, 773)
SECRET_NAME = r"(?i:token|secret|password|passwd|api[_-]?key)"
# Countries with IBANs.
IBAN_COUNTRIES = (
    "AD AE AL AT AZ BA BE BG BH BR BY CH CR CY CZ DE DK DO EE EG ES FI FO FR GB GE GI GL GR GT HR HU IE IL IS IT JO KW KZ LB LC "
    "LI LT LU LV MC MD ME MK MR MT MU NL NO PK PL PS PT QA RO RS SA SC SE SI SK SM ST SV TL TN TR UA VA VG XK"
).split()
# Keys that their first characters give away, which stay.
KEY_FRONT = r"(?:AKIA(?=[A-Z0-9]{16}\b)|gh[pousr]_(?=[A-Za-z0-9]{36}))"

# Kind: pattern. The first that matches a found value and validates it decides.
PATTERNS = {
    "secret": rf"\b{SECRET_NAME}[\"']?\s{{0,3}}[=:]\s{{0,3}}[\"']?[A-Za-z0-9_\-]{{16,}}",
    "key": rf"(?<![A-Za-z0-9_]){KEY_FRONT}[A-Za-z0-9]{{16,}}",
    "iban": rf"(?<![A-Za-z0-9])(?:{'|'.join(IBAN_COUNTRIES)})\d{{2}}(?:(?: [A-Z0-9]{{4}}){{2,7}}(?: [A-Z0-9]{{1,3}})?|[A-Z0-9]{{11,30}})(?![A-Za-z0-9])",
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.)++[A-Za-z]{2,}",
    "phone": r"(?<![\w+])(?:(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[.-])\d{3}[ .-]\d{4}(?!\d)"
    r"|\+(?=(?:[ .()-]{0,2}\d){9})\d{1,3}(?:[ .-]?\(\d{1,4}\))?(?:(?:[ -]?\d{1,4}){2,5}|(?:\.\d{1,4}){2,5})(?!\d|\.\d))",
    "ip": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "date": r"(?<![\d/.-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![\d/-])",
    # all numbers in a row, up to one that begins an address or a date with points or slashes
    "card": r"(?<![\d.])(?=(?:[ -]?\d){13})\d[\d -]*\d(?!\d|\.\d{1,3}\.\d|/\d{2}/\d{2})",
}
CARD = r"^\d(?:[ -]?\d){12,18}$"
# What may stand in a row of numbers, and the shapes of it that are usual.
IN_ROW = r"^(?:\d(?:[ -]?\d){12,18}|\d{3}-\d{2}-\d{4}|\d{4}-\d{2}-\d{2}|\d{3}-\d{3}[ -]\d{4})$"
USUAL = r"^(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}[ -]\d{6}[ -]\d{5}|\d{3}-.*|\d{4}-\d{2}-\d{2})$"
MOST_GROUPS = 19
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
DATE_FORMATS = {
    r"^\d{4}-\d{2}-\d{2}$": "yyyy-MM-dd",
    r"^\d{4}/\d{2}/\d{2}$": "yyyy/MM/dd",
    r"^\d{2}\.\d{2}\.\d{4}$": "dd.MM.yyyy",
    r"^(?:1[3-9]|[23]\d)/\d{2}/\d{4}$": "dd/MM/yyyy",
    r"^\d{2}/\d{2}/\d{4}$": "MM/dd/yyyy",
}


def let(value: Column, body) -> Column:
    """``body`` of ``value``, computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def permuted(values: Column, sizes: Column, kind: Column, key: str) -> Column:
    """The units ``values``, each below its entry of ``sizes``, permuted by the keyed network."""
    half = F.floor(F.size(values) / 2).cast("int")
    rest = F.size(values) - half

    def shifted(units: Column, own_sizes: Column, other: Column, r: Column) -> Column:
        seen = F.concat_ws("|", F.lit(key), kind, r.cast("string"), F.array_join(other.cast("array<string>"), ","))
        draw = lambda i: F.conv(F.substring(F.sha2(F.concat_ws("|", seen, i.cast("string")), 256), 1, 12), 16, 10)
        return F.transform(
            units,
            lambda x, i: F.when(F.get(own_sizes, i) > 1, F.pmod(x + draw(i).cast("long"), F.get(own_sizes, i))).otherwise(x),
        )

    start = F.struct(F.slice(values, F.lit(1), half).alias("l"), F.slice(values, half + 1, rest).alias("r"))
    left, right = F.slice(sizes, F.lit(1), half), F.slice(sizes, half + 1, rest)
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(ROUNDS - 1)),
        start,
        lambda s, n: F.when(
            n % 2 == 0, F.struct(shifted(s["l"], left, s["r"], n).alias("l"), s["r"].alias("r"))
        ).otherwise(F.struct(s["l"].alias("l"), shifted(s["r"], right, s["l"], n).alias("r"))),
        lambda s: F.concat(s["l"], s["r"]),
    )


def digits_of(value: Column) -> Column:
    return F.transform(F.split(F.regexp_replace(value, "[^0-9]", ""), ""), lambda c: c.cast("int"))


def luhn_sum(digits: Column, doubled: int) -> Column:
    """Sum of the digits, every second one doubled, from the last (0) or the one before it (1) on."""
    return F.aggregate(
        F.transform(
            F.reverse(digits),
            lambda d, i: F.when(i % 2 == doubled, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d),
        ),
        F.lit(0),
        lambda a, b: a + b,
    )


def remainder(iban: Column) -> Column:
    """An IBAN by 97, with its first four characters last and letters as 10 to 35; 1 if it is valid."""
    bare = F.regexp_replace(iban, " ", "")
    turned = F.concat(F.substring(bare, F.lit(5), F.length(bare)), F.substring(bare, 1, 4))
    return F.aggregate(
        F.split(turned, ""),
        F.lit(0),
        lambda left, c: F.pmod(
            F.when(c.rlike("[A-Z]"), left * 100 + F.ascii(c) - 55).otherwise(left * 10 + c.try_cast("int")), F.lit(97)
        ),
    )


def _longs(*numbers) -> Column:
    return F.array(*[(F.lit(n) if isinstance(n, int) else n).cast("long") for n in numbers])


def _date_format(value: Column) -> Column:
    form = None
    for shape, name in DATE_FORMATS.items():
        form = F.when(value.rlike(shape), name) if form is None else form.when(value.rlike(shape), name)
    return form


def classified(value: Column) -> Column:
    """A found value as (kind, was, form, day): null kind if it is none after all; a date also with
    its format and its day number, which is null if the calendar has no such day."""

    def decided(d: Column) -> Column:
        fits = lambda kind: value.rlike(f"^(?:{PATTERNS[kind]})$")
        octets = F.split(value, r"\.").cast("array<int>")
        ssn = r"^(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}$"
        kind = (
            F.when(fits("secret"), "secret")
            .when(fits("key"), "key")
            .when(fits("iban") & (F.length(value) <= 42) & (remainder(value) == 1), "iban")
            .when(fits("email"), "email")
            .when(fits("ip") & F.forall(octets, lambda o: o <= 255), "ip")
            .when(value.rlike(ssn), "ssn")
            .when(d["day"].between(0, DAY_UNITS[0] * DAY_UNITS[1] - 1), "date")
            .when(fits("phone"), "phone")
            .when(value.rlike(CARD) & (luhn_sum(digits_of(value), 1) % 10 == 0), "card")
        )
        return F.struct(kind.alias("kind"), value.alias("was"), d["form"].alias("form"), d["day"].alias("day"))

    day = F.datediff(F.try_to_timestamp(value, _date_format(value)).cast("date"), F.lit(FIRST_DAY).cast("date"))
    return let(F.struct(_date_format(value).alias("form"), day.cast("long").alias("day")), decided)


def _laid_out(v: Column) -> Column:
    """The parts of a classified value: text before and after, and the characters to permute (none
    for values that are numbers), with whether they are all lower-case hex digits."""
    was, kind = v["was"], v["kind"]
    cut = lambda first, n: F.substring(was, first, n)
    name = F.length(F.regexp_extract(was, rf"^({SECRET_NAME}[\"']?\s*[=:]\s*[\"']?|{KEY_FRONT})", 1))
    before = F.when(kind.isin("secret", "key"), name).when(kind == "iban", 4).otherwise(0)
    length = (
        F.when(kind == "email", F.instr(was, "@") - 1).when(kind == "card", F.length(was) - 1).otherwise(F.length(was) - before)
    )

    def parts(n: Column) -> Column:
        body = cut(n["before"] + 1, n["length"])
        spelt = kind.isin("secret", "key", "iban", "email", "phone", "card")
        # of numbers the digits alone are permuted, so that every way to write one gets the same digits
        bare = F.when(kind.isin("phone", "card", "iban"), F.regexp_replace(body, "[^0-9A-Z]", "")).otherwise(body)
        kept = (
            F.when(kind == "card", 1)
            .when((kind == "phone") & body.startswith("+1") & (F.length(bare) == 11), 1)
            .when((kind == "phone") & body.startswith("+"), 2)
            .otherwise(0)
        )
        return F.struct(
            kind.alias("kind"), was.alias("was"), v["form"].alias("form"), v["day"].alias("day"),
            cut(F.lit(1), n["before"]).alias("front"), body.alias("body"),
            F.substring(bare, F.lit(1), kept).alias("kept"),
            F.when(spelt, F.split(F.substring(bare, kept + 1, F.length(bare)), "")).alias("chars"),
            F.when(kind == "email", cut(F.instr(was, "@"), F.length(was))).otherwise("").alias("back"),
            body.rlike("^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$").alias("hex"),
        )

    return let(F.struct(before.alias("before"), length.alias("length")), parts)


def _units(p: Column) -> tuple[Column, Column]:
    """Units and sizes of a laid-out value. Characters that do not change have size one. Social security
    areas are 001 to 899 without 666."""
    kind, low = p["kind"], DAY_UNITS[0]
    octets = F.split(p["was"], r"\.").cast("array<long>")
    part = F.split(p["was"], "-").cast("array<long>")
    area = F.get(part, F.lit(0))
    numbers = _longs(area - F.when(area > 666, 2).otherwise(1), F.get(part, F.lit(1)) - 1, F.get(part, F.lit(2)) - 1)
    value = lambda c: (
        F.when(p["hex"], F.instr(F.lit(HEX), c) - 1)
        .when(c.rlike("[0-9]"), c.cast("int"))
        .when(c.rlike("[a-z]"), F.ascii(c) - 97)
        .when(c.rlike("[A-Z]"), F.ascii(c) - 65)
        .otherwise(0)
        .cast("long")
    )
    size = lambda c: (
        F.when(p["hex"], 16)
        .when(c.rlike("[0-9]"), 10)
        .when(c.rlike("[A-Za-z]"), 26)
        .otherwise(1)
        .cast("long")
    )
    values = (
        F.when(kind == "ip", octets)
        .when(kind == "ssn", numbers)
        .when(kind == "date", _longs(F.pmod(p["day"], F.lit(low)), F.floor(p["day"] / low)))
        .otherwise(F.transform(p["chars"], value))
    )
    sizes = (
        F.when(kind == "ip", _longs(256, 256, 256, 256))
        .when(kind == "ssn", _longs(898, 99, 9999))
        .when(kind == "date", _longs(*DAY_UNITS))
        .otherwise(F.transform(p["chars"], size))
    )
    return values, sizes


def _written(p: Column, units: Column) -> Column:
    """The text of permuted units in the format of the laid-out value."""
    kind = p["kind"]
    letter = lambda c, u: (
        F.when(p["hex"], F.substring(F.lit(HEX), (u + 1).cast("int"), F.lit(1)))
        .when(c.rlike("[0-9]"), u.cast("string"))
        .when(c.rlike("[a-z]"), F.char(u + 97))
        .when(c.rlike("[A-Z]"), F.char(u + 65))
        .otherwise(c)
    )
    unit = lambda i: F.get(units, F.lit(i))
    area = unit(0) + 1
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), (unit(0) + unit(1) * DAY_UNITS[0]).cast("int"))
    def numbers_laid_out(t: Column) -> Column:
        """Digits and capitals of a number in the places where those of the value were."""
        place = lambda i: F.length(F.regexp_replace(F.substring(p["body"], F.lit(1), i + 1), "[^0-9A-Z]", ""))
        return F.array_join(
            F.transform(F.split(p["body"], ""), lambda c, i: F.when(c.rlike("[0-9A-Z]"), F.substring(t, place(i), F.lit(1))).otherwise(c)), ""
        )

    def check_digits(t: Column) -> Column:
        """An IBAN's country, and the check digits that its new number needs."""
        country = F.substring(p["was"], 1, 2)
        return F.concat(country, F.lpad((F.lit(98) - remainder(F.concat(country, F.lit("00"), t))).cast("string"), 2, "0"))

    spelt = let(
        F.concat(p["kept"], F.array_join(F.zip_with(p["chars"], units, letter), "")),
        lambda t: F.when(
            kind == "card", F.concat(numbers_laid_out(t), F.pmod(-luhn_sum(digits_of(t), 0), F.lit(10)).cast("string"))
        )
        .when(kind == "iban", F.concat(check_digits(t), numbers_laid_out(t)))
        .when(kind == "phone", numbers_laid_out(t))
        .otherwise(F.concat(p["front"], t, p["back"])),
    )
    return (
        F.when(kind == "ip", F.array_join(units.cast("array<string>"), "."))
        .when(kind == "ssn", F.format_string("%03d-%02d-%04d", F.when(area >= 666, area + 1).otherwise(area), unit(1) + 1, unit(2) + 1))
        .when(kind == "date", F.call_function("date_format", day, p["form"]))
        .otherwise(spelt)
    )


def pseudonym(value: Column, key: str) -> Column:
    """A struct (kind, text): what a found value is and what stands for it; nulls if it is invalid."""

    def of_parts(p: Column) -> Column:
        values, sizes = _units(p)
        return let(
            F.struct(values.alias("values"), sizes.alias("sizes")),
            lambda u: let(
                permuted(u["values"], u["sizes"], p["kind"], key),
                lambda done: F.struct(p["kind"].alias("kind"), _written(p, done).alias("text")),
            ),
        )

    return let(classified(value), lambda v: F.when(v["kind"].isNotNull(), let(_laid_out(v), of_parts)))


def _in_row(groups: Column) -> Column:
    """The valid values in a row of digit groups, as (first, size, usual) structs that do not overlap:
    those of a usual shape come first, then those further left, then longer ones."""

    def spans(i: Column) -> Column:
        text = lambda n: F.regexp_replace(F.array_join(F.slice(groups, i + 1, n), ""), "^[ -]+", "")
        sizes = F.sequence(F.lit(1), F.least(F.lit(MOST_GROUPS), F.size(groups) - i))
        made = F.transform(sizes, lambda n: F.struct(i.alias("first"), n.alias("size"), text(n).alias("text")))
        fit = F.filter(made, lambda s: F.when(s["text"].rlike(IN_ROW), classified(s["text"])["kind"].isNotNull()).otherwise(False))
        return F.transform(
            fit, lambda s: F.struct((~s["text"].rlike(USUAL)).alias("odd"), s["first"], (-s["size"]).alias("less"), s["size"])
        )

    places = F.sequence(F.lit(0), F.size(groups) - 1)
    ordered = F.array_sort(F.flatten(F.transform(places, spans)))
    free = lambda taken, s: ~F.exists(
        taken, lambda t: (t["first"] < s["first"] + s["size"]) & (s["first"] < t["first"] + t["size"])
    )
    return F.aggregate(ordered, F.slice(ordered, F.lit(1), F.lit(0)), lambda taken, s: F.when(free(taken, s), F.concat(taken, F.array(s))).otherwise(taken))


def pseudonyms(value: Column, key: str) -> Column:
    """A struct (kinds, text) of a found value: of a row of numbers that is none as a whole, those of
    its parts between group borders that are valid are replaced."""

    def of_row(groups: Column) -> Column:
        def pieces(taken: Column) -> Column:
            def piece(g: Column, i: Column) -> Column:
                own = F.get(F.filter(taken, lambda t: (t["first"] <= i) & (i < t["first"] + t["size"])), F.lit(0))
                whole = F.array_join(F.slice(groups, i + 1, own["size"]), "")
                lead = F.regexp_extract(whole, "^[ -]*", 0)
                made = let(pseudonym(F.regexp_replace(whole, "^[ -]+", ""), key), lambda m: F.struct(m["kind"].alias("kind"), F.concat(lead, m["text"]).alias("text")))
                none = F.lit(None).cast("string").alias("kind")
                return (
                    F.when(own.isNull(), F.struct(none, g.alias("text")))
                    .when(own["first"] == i, made)
                    .otherwise(F.struct(none, F.lit("").alias("text")))
                )

            return let(F.transform(groups, piece), lambda ps: F.struct(
                F.filter(F.transform(ps, lambda x: x["kind"]), lambda k: k.isNotNull()).alias("kinds"),
                F.array_join(F.transform(ps, lambda x: x["text"]), "").alias("text"),
            ))

        return let(_in_row(groups), lambda taken: F.when(F.size(taken) > 0, let(taken, pieces)))

    def decided(m: Column) -> Column:
        one = F.struct(F.array(m["kind"]).alias("kinds"), m["text"].alias("text"))
        row = value.rlike(r"^\d[\d -]*[ -][\d -]*\d$")
        return F.when(m.isNotNull(), one).when(row, let(F.regexp_extract_all(value, F.lit("[ -]*[0-9]+"), F.lit(0)), of_row))

    return let(pseudonym(value, key), decided)


def with_pseudonyms(docs: DataFrame, key: str, text: str = "text", length: str = "n_chars", kinds: str = "pii_kinds") -> DataFrame:
    """``docs`` with private values of ``text`` replaced, and the ``kinds`` found, in order.

    Invalid look-alikes (a 16-digit number with a wrong check sum, an octet above 255, 30 February)
    stay. A null text stays null and has no kinds. ``length``, if it is a column, is counted anew
    where the text changed. Other columns are kept; one that is called like ``kinds`` is replaced.
    """
    found = F.when(
        F.col(f"`{text}`").rlike("[0-9@=:]"),
        F.transform(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(ANY), F.lit(0)), lambda v: F.struct(v.alias("was"), pseudonyms(v, key).alias("now"))),
    )

    def rebuilt(values: Column) -> Column:
        gaps = F.split(F.col(f"`{text}`"), ANY, -1)
        new = lambda i: F.coalesce(F.get(values, i)["now"]["text"], F.get(values, i)["was"], F.lit(""))
        valid = F.filter(values, lambda v: v["now"].isNotNull())
        return F.struct(
            F.when(F.size(valid) > 0, F.array_join(F.transform(gaps, lambda g, i: F.concat(g, new(i))), ""))
            .otherwise(F.col(f"`{text}`")).alias("text"),
            F.flatten(F.transform(valid, lambda v: v["now"]["kinds"])).alias("kinds"),
        )

    none = F.struct(F.col(f"`{text}`").alias("text"), F.array().cast("array<string>").alias("kinds"))
    made = let(F.coalesce(let(found, lambda v: F.when(v.isNotNull(), rebuilt(v))), none), lambda m: m)
    columns, new = [], own_name(docs, "_made")
    inner = docs.select("*", made.alias(new))
    for c in docs.columns:
        if c == text:
            columns.append(F.col(f"{new}.text").alias(c))
        elif c == length:
            changed = F.size(f"{new}.kinds") > 0
            columns.append(F.when(changed, F.length(f"{new}.text")).otherwise(F.col(f"`{c}`")).cast(docs.schema[c].dataType).alias(c))
        elif c != kinds:
            columns.append(F.col(f"`{c}`"))
    return inner.select(*columns, F.col(f"{new}.kinds").alias(kinds))
