r"""Personal data under format-preserving Feistel pseudonyms.

Spans that look like a number, a date or an address are validated, and each valid one is replaced
by a valid one of the same format under a keyed permutation, so that equal values get equal
pseudonyms in every document, different values different ones, and the key holder can go back.

=====  ============================================  ============================================
kind   valid if                                      permuted
=====  ============================================  ============================================
card   13 to 19 digits, Luhn sum right; in groups    all digits but the last, which is the new sum
       4-4-4-n, 4-4-4-4-n, 4-6-5 or none
ip     four numbers of at most 255                   the 32 bits
phone  10 digits, area code in brackets, after a     the 10 digits; country code and signs stay
       country code, or 3-3-4 between - or .
ssn    3-2-4 digits                                  the 9 digits
iban   its country's length, remainder 1 modulo 97   the account; check digits are the new ones
date   a day of the calendar, years 1600 to 2399;    the days of its 400 years (189 x 773)
       a time may follow (T and two digits)
email  local part, domain                            letters and digits of the local part
=====  ============================================  ============================================

Characters go through an eight-round Feistel network over the halves of the bare value (without
blanks and signs): a round adds SHA-256 values of key, kind, round and the other half to each
character, digits modulo 10, letters modulo 26.  Addresses and dates do the same with two numbers.

Everything is column expressions on one text at a time.  A regular expression that looks ahead finds
a candidate at every place one can start, overlapping ones too, and the text is split at these
places.  Of the valid candidates the leftmost is taken, then the next that begins behind it; one
that fails validation takes nothing from those that overlap it.  Of a card of five groups the first
four are tried before the whole.  No row leaves its partition.

Edge cases: a null text gives an empty one; a text without a valid span comes back as it is; spans
that fail validation stay; rows that share an id are treated each on its own.  The way back is
exact unless a pseudonym makes a candidate valid that overlaps it from the left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.common import doc_text

ROUNDS = 8
KINDS = ("card", "ip", "phone", "ssn", "iban", "date", "email")
# Lengths of the account numbers of the countries that have IBANs.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
EMAIL = (r"(?<![A-Za-z0-9])[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9_%+-])?"
         r"@[A-Za-z0-9](?:[A-Za-z0-9-]{0,62}\.)+[A-Za-z]{2,24}")
IBAN = "|".join(rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]){{{length - 4}}}"
                for length, countries in IBAN_LENGTHS.items())
ISO = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
DATE = rf"{ISO}|[0-9]{{2}}(?<dot>[./])[0-9]{{2}}\k<dot>[0-9]{{4}}"
IP = r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
PHONE = (r"(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
         r"|\+[0-9]{1,3}[ .-]?[0-9]{3}[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
         r"|[0-9]{3}(?<sign>[-.])[0-9]{3}\k<sign>[0-9]{4}")
CARD = (r"[0-9]{13,19}|[0-9]{4}(?<gap>[ -])[0-9]{4}\k<gap>[0-9]{4}\k<gap>"
        r"(?:[0-9]{4}\k<gap>[0-9]{1,3}(?![0-9A-Za-z_])|[0-9]{1,7})"
        r"|[0-9]{4}(?<space>[ -])[0-9]{6}\k<space>[0-9]{5}")
# Check digits vouch for cards and accounts, so a point or hyphen and a digit may follow them.
CANDIDATE = (f"{EMAIL}|(?<![A-Za-z0-9_]|[0-9][.])(?:{IBAN}|{CARD})(?![0-9A-Za-z_])"
             rf"|(?<![A-Za-z0-9_.+])(?:{DATE}|{IP}|{SSN}|{PHONE})(?![0-9A-Za-z_]|[.-][0-9])"
             rf"|(?<![A-Za-z0-9_.+]){ISO}(?=T[0-9]{{2}})")
# What every candidate holds: an at sign, two points between digits, or seven digits close by.
_GATE = r"@|[0-9]\.[0-9]{1,3}\.[0-9]|[0-9](?:[ .()/+-]{0,3}[0-9]){6}|[A-Z]{2}[0-9]{2} ?[A-Z0-9]"
LOW_DAYS, HIGH_DAYS = 189, 773  # together the 146,097 days of 400 years


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _hash(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), *parts), 256)


def _number(digest: Column, at: Column | int, width: int) -> Column:
    at = F.lit(at) if isinstance(at, int) else at
    return F.conv(F.substring(digest, at, F.lit(width)), 16, 10).cast("long")


def _shifted(part: Column, key: str, kind: str, k: Column, other: Column, back: bool) -> Column:
    """Every character of a half moved within its class by what key and other half say."""
    def moved(i: Column) -> Column:
        digest = _hash(key, F.lit(kind), k.cast("string"),
                       F.floor((i - 1) / 8).cast("string"), other)
        by = _number(digest, F.lit(1) + 8 * ((i - 1) % 8), 8)
        by = -by if back else by

        def put(code: Column) -> Column:
            def within(low: int, size: int) -> Column:
                return F.char(low + F.pmod(code - low + by, F.lit(size)))

            return (F.when(code.between(48, 57), within(48, 10))
                    .when(code.between(65, 90), within(65, 26)).otherwise(within(97, 26)))

        return let(F.ascii(F.substring(part, i, F.lit(1))).cast("long"), put)

    return F.when(F.length(part) > 0, F.array_join(
        F.transform(F.sequence(F.lit(1), F.length(part)), moved), "")).otherwise("")


def permute(bare: Column, key: str, kind: str, back: bool = False) -> Column:
    """Keyed permutation of ASCII letters and digits that keeps each character's class."""
    half = F.floor(F.length(bare) / 2).cast("int")
    start = F.struct(F.substring(bare, F.lit(1), half).alias("l"),
                     F.substring(bare, half + 1, F.length(bare)).alias("r"))

    def turn(s: Column, k: Column) -> Column:
        left = F.when(k % 2 == 0, _shifted(s["l"], key, kind, k, s["r"], back)).otherwise(s["l"])
        right = F.when(k % 2 == 1, _shifted(s["r"], key, kind, k, s["l"], back)).otherwise(s["r"])
        return F.struct(left.alias("l"), right.alias("r"))

    rounds = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)
    return F.aggregate(F.array(*[F.lit(k) for k in rounds]), start, turn,
                       lambda s: F.concat(s["l"], s["r"]))


def permute_pair(low: Column, high: Column, sizes: tuple[int, int], key: str, kind: str,
                 back: bool = False) -> Column:
    """The same for two numbers below ``sizes``: struct (l, r)."""
    def turn(s: Column, k: Column) -> Column:
        def moved(part, other, size):
            by = _number(_hash(key, F.lit(kind), k.cast("string"), other.cast("string")), 1, 12)
            return F.pmod(part + (-by if back else by), F.lit(size))

        return F.struct(
            F.when(k % 2 == 0, moved(s["l"], s["r"], sizes[0])).otherwise(s["l"]).alias("l"),
            F.when(k % 2 == 1, moved(s["r"], s["l"], sizes[1])).otherwise(s["r"]).alias("r"))

    rounds = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)
    return F.aggregate(F.array(*[F.lit(k) for k in rounds]),
                       F.struct(low.cast("long").alias("l"), high.cast("long").alias("r")), turn)


def _bare(span: Column) -> Column:
    return F.regexp_replace(span, "[^0-9A-Za-z]", "")


def _refill(span: Column, bare: Column) -> Column:
    """``span`` with its letters and digits taken from ``bare`` in order."""
    def at(i: Column) -> Column:
        own = F.substring(span, i, F.lit(1))
        place = F.length(_bare(F.substring(span, F.lit(1), i)))
        return F.when(own.rlike("[0-9A-Za-z]"), F.substring(bare, place, F.lit(1))).otherwise(own)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(span)), at), "")


def _digit(text: Column, i: Column) -> Column:
    return F.ascii(F.substring(text, i, F.lit(1))).cast("long") - 48


def luhn(digits: Column, doubled: int) -> Column:
    """Luhn sum; ``doubled`` = 1 if the last digit but one is doubled first, 0 if the last is."""
    n = F.length(digits)

    def value(i: Column) -> Column:
        d = _digit(digits, i)
        return F.when((n - i) % 2 == doubled, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)

    return F.aggregate(F.transform(F.sequence(F.lit(1), n), value), F.lit(0).cast("long"),
                       lambda a, b: a + b)


def _card(span: Column, key: str, back: bool) -> Column:
    def made(digits: Column) -> Column:
        body = permute(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card", back)
        return F.when(luhn(digits, 1) % 10 == 0, let(body, lambda b: _refill(span, F.concat(
            b, F.pmod(-luhn(b, 0), F.lit(10)).cast("string")))))

    return let(_bare(span), made)


def _shorter(span: Column) -> Column:
    """A card of five groups without the last one."""
    return F.when(span.rlike(r"^[0-9]{4}(?:[ -][0-9]{4}){3}[ -]"), F.substring(span, 1, 19))


def _mod97(text: Column) -> Column:
    """Remainder of the number that text gives with A = 10 to Z = 35."""
    def step(total: Column, i: Column) -> Column:
        code = F.ascii(F.substring(text, i, F.lit(1))).cast("long")
        return F.when(code < 58, (total * 10 + code - 48) % 97).otherwise(
            (total * 100 + code - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(text)), F.lit(0).cast("long"), step)


def _iban(span: Column, key: str, back: bool) -> Column:
    def made(bare: Column) -> Column:
        country, account = F.substring(bare, 1, 2), F.substring(bare, F.lit(5), F.length(bare))
        valid = _mod97(F.concat(account, F.substring(bare, 1, 4))) == 1

        def whole(a: Column) -> Column:
            check = 98 - _mod97(F.concat(a, country, F.lit("00")))
            return _refill(span, F.concat(country, F.lpad(check.cast("string"), 2, "0"), a))

        return F.when(valid, let(permute(account, key, "iban", back), whole))

    return let(_bare(span), made)


def _phone(span: Column, key: str, back: bool) -> Column:
    def made(digits: Column) -> Column:
        code = F.substring(digits, F.lit(1), F.length(digits) - 10)
        return let(permute(F.substring(digits, F.length(digits) - 9, F.lit(10)), key, "phone", back),
                   lambda d: _refill(span, F.concat(code, d)))

    return let(_bare(span), made)


def _ip(span: Column, key: str, back: bool) -> Column:
    def made(o: Column) -> Column:
        pair = permute_pair(256 * o[0] + o[1], 256 * o[2] + o[3], (65536, 65536), key, "ip", back)
        return F.when(F.forall(o, lambda v: v <= 255), let(pair, lambda p: F.concat_ws(
            ".", *[x.cast("string") for x in (F.floor(p["l"] / 256), p["l"] % 256,
                                              F.floor(p["r"] / 256), p["r"] % 256)])))

    return let(F.transform(F.split(span, r"\."), lambda v: v.cast("long")), made)


def _date(span: Column, key: str, back: bool) -> Column:
    iso = F.substring(span, 5, 1) == "-"
    year = F.when(iso, F.substring(span, 1, 4)).otherwise(F.substring(span, 7, 4)).cast("int")
    month = F.when(iso, F.substring(span, 6, 2)).otherwise(F.substring(span, 4, 2)).cast("int")
    day = F.when(iso, F.substring(span, 9, 2)).otherwise(F.substring(span, 1, 2)).cast("int")
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    last = F.when(month == 2, F.when(leap, 29).otherwise(28)).when(
        month.isin(4, 6, 9, 11), 30).otherwise(31)
    valid = year.between(1600, 2399) & month.between(1, 12) & (day >= 1) & (day <= last)

    def made(days: Column) -> Column:
        cycle = days - days % (LOW_DAYS * HIGH_DAYS)
        place = days - cycle
        pair = permute_pair(place % LOW_DAYS, F.floor(place / LOW_DAYS), (LOW_DAYS, HIGH_DAYS),
                            key, "date", back)
        new = let(pair, lambda p: F.date_add(F.lit("1600-01-01").cast("date"), (
            cycle + p["l"] + LOW_DAYS * p["r"]).cast("int")))
        sign = F.substring(span, 3, 1)
        return let(new, lambda d: F.when(iso, F.date_format(d, "yyyy-MM-dd")).otherwise(
            F.concat(F.date_format(d, "dd"), sign, F.date_format(d, "MM"), sign,
                     F.date_format(d, "yyyy"))))

    days = F.datediff(F.make_date(year, month, day), F.lit("1600-01-01").cast("date"))
    return F.when(valid, let(days.cast("long"), made))


def _email(span: Column, key: str, back: bool) -> Column:
    local = F.substring_index(span, "@", 1)
    new = let(_bare(local), lambda b: let(permute(b, key, "email", back),
                                          lambda p: _refill(local, p)))
    return F.concat(new, F.lit("@"), F.substring_index(span, "@", -1))


def _kind(span: Column) -> Column:
    bare = F.length(_bare(span))
    return (F.when(F.contains(span, F.lit("@")), "email")
            .when(span.rlike(f"^(?:{IP})$"), "ip").when(span.rlike(f"^(?:{DATE})$"), "date")
            .when(span.rlike(f"^(?:{SSN})$"), "ssn").when(span.rlike(f"^(?:{PHONE})$"), "phone")
            .when(span.rlike("^[A-Z]"), "iban").when(bare.between(13, 19), "card"))


def pseudonym(span: Column, key: str, back: bool = False) -> Column:
    """struct (kind, text, length) of a candidate; kind is null where it is not valid.

    ``length``: characters of the candidate that ``text`` replaces.
    """
    def made(k: Column) -> Column:
        new = (F.when(k == "email", _email(span, key, back)).when(k == "ip", _ip(span, key, back))
               .when(k == "date", _date(span, key, back))
               .when(k == "ssn", _refill(span, permute(_bare(span), key, "ssn", back)))
               .when(k == "phone", _phone(span, key, back)).when(k == "iban", _iban(span, key, back))
               .when(k == "card", _card(span, key, back)))

        def result(text: Column, length: Column) -> Column:
            return F.struct(F.when(text.isNotNull(), k).alias("kind"), text.alias("text"),
                            length.alias("length"))

        whole = let(new, lambda t: result(t, F.length(span)))
        less = _shorter(span)
        return F.when((k == "card") & less.isNotNull(), let(
            _card(less, key, back),
            lambda t: F.when(t.isNotNull(), result(t, F.length(less))).otherwise(whole))
        ).otherwise(whole)

    return let(_kind(span), made)


def _covered(new: Column, body: Column) -> Column:
    """For each candidate -1 if it is taken, else the characters behind its start already covered.

    ``body``: the text from each candidate's start to the next one's.
    """
    def step(state: Column, i: Column) -> Column:
        here, size = F.get(new, i), F.length(F.get(body, i))
        hidden = state["left"] > 0
        taken = ~hidden & here["kind"].isNotNull()
        reach = F.when(taken, here["length"]).otherwise(state["left"])
        return F.struct(
            F.greatest(reach - size, F.lit(0)).alias("left"),
            F.concat(state["out"], F.array(F.when(taken, -1).otherwise(state["left"]))).alias("out"))

    start = F.struct(F.lit(0).alias("left"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(F.sequence(F.lit(0), F.size(new) - 1), start, step, lambda s: s["out"])


def pseudonymise(docs: DataFrame, key: str, back: bool = False) -> DataFrame:
    """One row per document: doc_id, text with pseudonyms, n_spans and a count for each kind.

    ``back`` inverts the permutation under the same key.
    """
    text, ahead = F.col("text"), f"(?=({CANDIDATE}))"
    n = F.size("found")
    found = (doc_text(docs)
             .withColumn("found", F.when(text.rlike(_GATE), F.regexp_extract_all(
                 text, F.lit(ahead), F.lit(1))).otherwise(F.array().cast("array<string>")))
             .withColumn("new", F.transform("found", lambda s: pseudonym(s, key, back)))
             .withColumn("parts", F.when(n > 0, F.split(text, f"(?={CANDIDATE})", -1)))
             .withColumn("body", F.slice("parts", F.size("parts") - n + 1, n)))
    # Candidates that end before the next one starts need no comparison.
    apart = F.forall(F.sequence(F.lit(0), n - 1), lambda i: F.coalesce(
        F.get("new", i)["kind"].isNull()
        | (F.get("new", i)["length"] <= F.length(F.get("body", i))), F.lit(True)))
    found = found.withColumn("covered", F.when(n > 0, F.when(apart, F.transform(
        "new", lambda s: F.when(s["kind"].isNotNull(), -1).otherwise(0))).otherwise(
        _covered(F.col("new"), F.col("body")))))

    def put(i: Column) -> Column:
        piece, cut, here = F.get("body", i), F.get("covered", i), F.get("new", i)
        rest = lambda k: F.substring(piece, k + 1, F.length(piece))
        return F.when(cut < 0, F.concat(here["text"], rest(here["length"]))).otherwise(rest(cut))

    head = F.when(F.size("parts") > n, F.get("parts", F.lit(0))).otherwise("")
    joined = F.concat(head, F.array_join(F.transform(F.sequence(F.lit(0), n - 1), put), ""))
    made = found.select(
        "doc_id", F.when(n > 0, joined).otherwise(text).alias("text"),
        F.when(n > 0, F.transform(F.filter(F.arrays_zip("covered", "new"),
                                           lambda z: z["covered"] < 0), lambda z: z["new"]["kind"]))
        .otherwise(F.array().cast("array<string>")).alias("kinds"))
    count = lambda k: F.size(F.filter("kinds", lambda s: s == k)).cast("long")
    return made.select("doc_id", "text", F.size("kinds").cast("long").alias("n_spans"),
                       *[count(k).alias(f"n_{k}") for k in KINDS])
