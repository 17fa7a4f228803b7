"""Format-preserving pseudonyms for personal data by keyed Feistel networks, in DataFrame functions only.

One pattern finds candidates; each is validated (check digits, octet ranges, calendar, number plan) and, if valid, turned
into small numbers with one modulus each.  A Feistel network adds to one half of them a keyed digest of the other half,
half by half for ``ROUNDS`` rounds, and the result is written back in the same format.  It is a permutation of all valid
values of that format: equal values stay linked across documents, different ones stay different, and the key is needed
to go back.

=========  =====================================================  ==============================================
kind       valid if                                               what is permuted
=========  =====================================================  ==============================================
email      local part and domain with a top level                 local part, letters and digits by class
secret     key or password with its known prefix; long hex        all after the prefix
iban       remainder 97                                           account characters; check digits anew
phone      national or international form                         digits after the country code
ssn        area, group and serial in use                          all three among valid ones
date       in the calendar                                        the day within its 400 years (189 x 773 days)
ip         octets to 255, first 1 to 223                          all four octets
card       13 to 19 digits with Luhn check digit                  digits between the first and the check digit
=========  =====================================================  ==============================================

IBANs may have single blanks inside, ISO dates a time behind them, national phone numbers blanks (3-3-4 digits, or ten or
eleven from 0 on).  Secrets of more than ``BLOCK`` characters are permuted block by block.

Whatever is not valid stays as it is.  A null text stays null, an empty one empty; rows and other columns pass through,
and repeated rows get equal texts.  A date with slashes is month first unless only day first is in the calendar.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from timelane.llm.common import read

KEY, ROUNDS = "pseudonyms", 8

EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,126}[A-Za-z]{2,63}"
SECRET = r"AKIA[0-9A-Z]{16}|password=[^\s\"']+|[0-9a-f]{32,}"
#: Account characters by country; with these a printed IBAN, single blanks inside, ends where it should.
ACCOUNTS = {
    11: "NO", 12: "BE", 14: "DK FI FK FO GL NL SD", 15: "MK SI", 16: "AT BA EE KZ LT LU MN XK", 17: "CH HR LI LV",
    18: "BG BH CR DE GB GE IE ME RS VA", 19: "AE GI IL IQ OM SO TL", 20: "AD CZ ES MD PK RO SA SE SK TN VG", 21: "LY PT ST", 22: "IS TR",
    23: "BI DJ FR GR IT MC MR SM", 24: "AL AZ BY CY DO GT HN HU LB NI PL SV", 25: "BR EG PS QA UA", 26: "JO KW MU YE", 27: "MT SC", 28: "LC", 29: "RU",
}
KNOWN = "|".join("|".join(c.split()) for c in ACCOUNTS.values())
IBAN = (
    r"(?=[A-Z]{2}[0-9]{2})(?:"
    + "|".join(f"(?:{'|'.join(c.split())})[0-9]{{2}}(?: ?[A-Z0-9]){{{n}}}" for n, c in ACCOUNTS.items())
    + rf"|(?!{KNOWN})[A-Z]{{2}}[0-9]{{2}}(?: [A-Z0-9]{{4}}){{2,7}}(?: [A-Z0-9]{{1,3}})?|[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{11,30}})"
)
PHONE = r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}|0[1-9](?=(?: ?[0-9]){8,9}(?! ?[0-9]))[0-9]{0,3}(?: [0-9]{2,4}){2,4}"
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
DATE = r"[0-9]{4}[-/][0-9]{2}[-/][0-9]{2}|[0-9]{1,2}[./-][0-9]{1,2}[./-][0-9]{4}"
IP = r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}"
CARD = r"[0-9](?:[ -]?[0-9]){12,18}"
KINDS = {"email": EMAIL, "secret": SECRET, "iban": IBAN, "phone": PHONE, "ssn": SSN, "date": DATE, "ip": IP, "card": CARD}
#: A value starts and ends where no letter or digit goes on, and no number does behind a point; only a date may have a time behind it.
PATTERN = r"(?<![\p{L}\p{N}])(?:(?:" + "|".join(KINDS.values()) + r")(?![\p{L}\p{N}]|\.[0-9])|[0-9]{4}[-/][0-9]{2}[-/][0-9]{2}(?=[Tt][0-9]{2}))"
#: Longer secrets are permuted block by block, as the work of one network grows with the square of its length.
BLOCK = 128

DIGITS, LOWER, UPPER, HEX = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdef"
#: Days of 400 years of the calendar, always the same number, as a product.
DAYS_HIGH, DAYS_LOW = 189, 773
FIRST_DAY = "1800-01-01"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def feistel(values: Column, moduli: Column, kind: str, key: str) -> Column:
    """Permutation of number lists with the given moduli."""

    def one_round(v: Column, r: Column) -> Column:
        half = (F.size(v) / 2).cast("int")
        left_turn = r % 2 == 0
        other = F.when(left_turn, F.slice(v, half + 1, F.size(v) - half)).otherwise(F.slice(v, F.lit(1), half))

        def step(x: Column, i: Column) -> Column:
            digest = F.sha2(F.concat_ws(",", F.lit(key), F.lit(kind), r.cast("string"), i.cast("string"), F.array_join(F.transform(other, lambda o: o.cast("string")), ".")), 256)
            stream = F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint")
            return F.when((i < half) == left_turn, F.pmod(x + stream, F.get(moduli, i))).otherwise(x)

        return F.transform(v, step)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), values, one_round)


def chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def by_alphabet(text: Column, alphabet: Callable[[Column, Column], Column], kind: str, key: str) -> Column:
    """``text`` with every character permuted inside the alphabet given for it (empty: it stays)."""

    def write(cs: Column) -> Column:
        def with_sets(sets: Column) -> Column:
            picked = F.filter(F.arrays_zip(cs.alias("c"), sets.alias("s")), lambda p: p["s"] != "")
            pairs = let(picked, lambda p: permuted(p))
            return let(pairs, lambda new: F.array_join(fill(cs, sets, new), ""))

        def permuted(p: Column) -> Column:
            values = F.transform(p, lambda x: position(x["s"], x["c"]))
            moduli = F.transform(p, lambda x: F.length(x["s"]).cast("bigint"))
            moved = feistel(values, moduli, kind, key)
            return F.transform(moved, lambda v, i: F.substring(F.get(p, i)["s"], (v + 1).cast("int"), F.lit(1)))

        def fill(cs: Column, sets: Column, new: Column) -> Column:
            place = lambda i: F.size(F.filter(F.slice(sets, F.lit(1), i + 1), lambda s: s != "")) - 1
            return F.transform(cs, lambda c, i: F.when(F.get(sets, i) == "", c).otherwise(F.get(new, place(i))))

        return let(F.transform(cs, lambda c, i: alphabet(c, F.get(cs, i - 1))), with_sets)

    return let(chars(text), write)


def position(alphabet: Column, char: Column) -> Column:
    return (F.position(char, alphabet) - 1).cast("bigint")


def classes(c: Column, _: Column) -> Column:
    return F.when(c.between("0", "9"), DIGITS).when(c.between("a", "z"), LOWER).when(c.between("A", "Z"), UPPER).otherwise("")


def dialled(c: Column, before: Column) -> Column:
    """Digits; the first of a group keeps to 2-9 or to 0-1, as number plans tell these apart."""
    first = F.coalesce(~before.between("0", "9"), F.lit(True))
    return F.when(~c.between("0", "9"), "").when(~first, DIGITS).when(c.between("2", "9"), "23456789").otherwise("01")


def digit_list(text: Column) -> Column:
    return F.transform(chars(F.regexp_replace(text, "[^0-9]", "")), lambda c: c.cast("bigint"))


def luhn_sum(digits: Column, doubled: int) -> Column:
    """Luhn sum; from the right, digits at odd (0) or even (1) distance from the end are doubled."""
    n = F.size(digits)
    parts = F.transform(digits, lambda d, i: F.when((n - 1 - i + doubled) % 2 == 1, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d))
    return F.aggregate(parts, F.lit(0).cast("bigint"), lambda a, d: a + d)


def card(m: Column, key: str) -> Column:
    def write(d: Column) -> Column:
        n = F.size(d)
        body = F.slice(d, F.lit(2), n - 2)
        moved = feistel(body, F.transform(body, lambda _: F.lit(10).cast("bigint")), "card", key)
        front = let(F.concat(F.slice(d, 1, 1), moved), lambda f: F.concat(f, F.array(F.pmod(-luhn_sum(f, 1), F.lit(10).cast("bigint")))))
        ok = (luhn_sum(d, 0) % 10 == 0) & n.between(13, 19)
        return F.when(ok, let(front, lambda f: digits_into(m, f))).otherwise(m)

    return let(digit_list(m), write)


def digits_into(m: Column, digits: Column) -> Column:
    """The digits in the places of those of ``m``."""

    def write(cs: Column) -> Column:
        place = lambda i: F.size(F.filter(F.slice(cs, F.lit(1), i + 1), lambda c: c.between("0", "9"))) - 1
        return F.array_join(F.transform(cs, lambda c, i: F.when(c.between("0", "9"), F.get(digits, place(i)).cast("string")).otherwise(c)), "")

    return let(chars(m), write)


def remainder_97(text: Column) -> Column:
    """Of the number that an account's characters spell (A = 10 .. Z = 35)."""
    value = lambda c: F.when(c.between("0", "9"), c.cast("bigint")).otherwise((F.ascii(c) - 55).cast("bigint"))
    step = lambda a, c: F.pmod(a * F.when(c.between("0", "9"), 10).otherwise(100) + value(c), F.lit(97).cast("bigint"))
    return F.aggregate(chars(text), F.lit(0).cast("bigint"), step)


def iban(m: Column, key: str) -> Column:
    def write(bare: Column) -> Column:
        country, account = F.substring(bare, 1, 2), F.substring(bare, F.lit(5), F.length(bare) - 4)
        ok = remainder_97(F.concat(account, F.substring(bare, 1, 4))) == 1
        moved = by_alphabet(account, classes, "iban", key)
        whole = let(moved, lambda a: F.concat(country, F.lpad((98 - remainder_97(F.concat(a, country, F.lit("00")))).cast("string"), 2, "0"), a))
        # Behind a word that only looks like the head of an IBAN may stand a card.
        other = F.when(m.rlike(f"^[A-Z]{{2}}[0-9]{{2}} {CARD}$"), behind(m, "^.{5}", lambda rest: card(rest, key))).otherwise(m)
        return F.when(ok, let(whole, lambda w: around_blanks(m, w))).otherwise(other)

    return let(F.replace(m, F.lit(" "), F.lit("")), write)


def around_blanks(m: Column, bare: Column) -> Column:
    """The characters of ``bare`` in the places of those of ``m`` that are no blanks."""

    def write(cs: Column) -> Column:
        place = lambda i: F.size(F.filter(F.slice(cs, F.lit(1), i + 1), lambda c: c != " "))
        return F.array_join(F.transform(cs, lambda c, i: F.when(c == " ", c).otherwise(F.substring(bare, place(i), F.lit(1)))), "")

    return let(chars(m), write)


def in_blocks(text: Column, body: Callable[[Column], Column]) -> Column:
    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)), body), "")


def ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.substring(m, *p).cast("bigint") for p in ((1, 3), (5, 2), (8, 4)))
    ok = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    # 898 areas in use, without 666.
    values = F.array(area - F.when(area > 666, 2).otherwise(1), group - 1, serial - 1)
    moved = feistel(values, F.array(*[F.lit(x).cast("bigint") for x in (898, 99, 9999)]), "ssn", key)
    pad = lambda v, width: F.lpad(v.cast("string"), width, "0")
    text = let(moved, lambda v: F.concat_ws("-", pad(F.get(v, F.lit(0)) + F.when(F.get(v, F.lit(0)) >= 665, 2).otherwise(1), 3), pad(F.get(v, F.lit(1)) + 1, 2), pad(F.get(v, F.lit(2)) + 1, 4)))
    return F.when(ok, text).otherwise(m)


def date(m: Column, key: str) -> Column:
    mark = F.regexp_extract(m, "[./-]", 0)

    def write(p: Column) -> Column:
        a, b, c = (F.get(p, F.lit(i)) for i in range(3))
        day_of = lambda y, mo, d: F.try_to_date(F.concat_ws("-", y, F.lpad(mo, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")
        year_first = F.length(a) == 4
        month_first = ~year_first & (mark == "/") & day_of(c, a, b).isNotNull()
        day = F.when(year_first, day_of(a, b, c)).when(month_first, day_of(c, a, b)).otherwise(day_of(c, b, a))

        def moved(days: Column) -> Column:
            span = DAYS_HIGH * DAYS_LOW
            inside = F.pmod(days, F.lit(span)).cast("bigint")
            values = F.array((inside / DAYS_LOW).cast("bigint"), inside % DAYS_LOW)
            new = feistel(values, F.array(F.lit(DAYS_HIGH).cast("bigint"), F.lit(DAYS_LOW).cast("bigint")), "date", key)
            return let(new, lambda v: F.date_add(F.to_date(F.lit(FIRST_DAY)), (days - inside + F.get(v, F.lit(0)) * DAYS_LOW + F.get(v, F.lit(1))).cast("int")))

        def spelt(d: Column) -> Column:
            size = lambda n, like: F.when(F.length(like) == 2, F.lpad(n.cast("string"), 2, "0")).otherwise(n.cast("string"))
            year = F.lpad(F.year(d).cast("string"), 4, "0")
            usual = F.concat(size(F.dayofmonth(d), a), mark, size(F.month(d), b), mark, year)
            return F.when(year_first, F.concat(year, mark, size(F.month(d), b), mark, size(F.dayofmonth(d), c))).when(
                month_first, F.concat(size(F.month(d), a), mark, size(F.dayofmonth(d), b), mark, year)
            ).otherwise(usual)

        days = F.datediff(day, F.to_date(F.lit(FIRST_DAY))).cast("bigint")
        return F.when(day.isNull(), m).otherwise(let(days, lambda n: let(moved(n), spelt)))

    return let(F.split(m, "[./-]"), write)


def ip(m: Column, key: str) -> Column:
    def write(o: Column) -> Column:
        ok = F.forall(o, lambda x: x <= 255) & F.get(o, F.lit(0)).between(1, 223)
        values = F.transform(o, lambda x, i: F.when(i == 0, x - 1).otherwise(x))
        moved = feistel(values, F.array(*[F.lit(x).cast("bigint") for x in (223, 256, 256, 256)]), "ip", key)
        text = F.array_join(F.transform(moved, lambda x, i: F.when(i == 0, x + 1).otherwise(x).cast("string")), ".")
        return F.when(ok, text).otherwise(m)

    return let(F.transform(F.split(m, r"\."), lambda x: x.cast("bigint")), write)


def behind(m: Column, pattern: str, body: Callable[[Column], Column]) -> Column:
    """``m`` with ``body`` of what follows its fixed head."""
    head = F.regexp_extract(m, pattern, 0)
    return let(head, lambda h: F.concat(h, body(F.substring(m, F.length(h) + 1, F.length(m)))))


def pseudonym(m: Column, key: str) -> Column:
    is_kind = {kind: m.rlike(f"^(?:{pattern})$") for kind, pattern in KINDS.items()}
    local = F.substring_index(m, "@", 1)
    hexed = lambda c, _: F.lit(HEX)
    return (
        F.when(is_kind["email"], F.concat(by_alphabet(local, classes, "email", key), F.substring(m, F.length(local) + 1, F.length(m))))
        .when(m.rlike("^[0-9a-f]{32,}$"), in_blocks(m, lambda b: by_alphabet(b, hexed, "hex", key)))
        .when(is_kind["secret"], behind(m, "^(?:AKIA|password=)", lambda rest: in_blocks(rest, lambda b: by_alphabet(b, classes, "secret", key))))
        .when(is_kind["iban"], iban(m, key))
        .when(is_kind["ssn"], ssn(m, key))
        .when(is_kind["date"], date(m, key))
        .when(is_kind["ip"], ip(m, key))
        .when(is_kind["phone"], behind(m, r"^(?:\+[0-9]{1,3}(?=[^0-9]))?", lambda rest: by_alphabet(rest, dialled, "phone", key)))
        .when(is_kind["card"], card(m, key))
        .otherwise(m)
    )


def masked(text: Column, key: str = KEY) -> Column:
    """``text`` with every valid value replaced: the stretches between the matches, and the pseudonyms of these."""

    def replace(found: Column) -> Column:
        gaps = F.split(text, PATTERN, -1)
        parts = F.zip_with(gaps, F.transform(found, lambda m: pseudonym(m, key)), lambda gap, new: F.concat(gap, F.coalesce(new, F.lit(""))))
        return F.when(F.size(found) == 0, text).otherwise(F.array_join(parts, ""))

    found = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
    return F.when(text.rlike("[0-9@=]"), let(found, replace)).otherwise(text)


def pseudonymise(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with pseudonyms in ``text``; all other columns as they are."""
    return docs.withColumn("text", masked(F.col("text").cast("string"), key))


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return pseudonymise(docs)
