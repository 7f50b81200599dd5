"""Format-preserving pseudonyms for personal numbers and dates.

Numbers and dates are found by one pattern, validated by their kind, and permuted within
the valid values of the kind by a keyed Feistel network (ten rounds that add a keyed
SHA-256 value to one half, modulo the size of the half).  The permutation depends on the
key, the kind and the value alone: equal values get equal pseudonyms in every document,
different values of a kind different ones, and the key holder can undo it.

kind   validated by                         permuted within
card   13 to 19 digits, Luhn, also beside   all digits but the last; Luhn digit set anew
       other digit groups
phone  North America: ten digits with +1,   800 areas x 800 exchanges x 10,000 lines; numbers
       1 or neither, in groups              that no exchange has, among their like
       + and a country code, or a trunk 0,  numbers of that length behind the code or the 0
       in groups
ssn    area 001-899 without 666, group,     898 areas x 99 groups x 9,999 serials
       serial not 0
ip     four octets to 255                   2^32 addresses
date   real day from 1800 to 2158, ISO,     2^17 days, written in the same form
       day/month/year or day.month.year
       to 2199, with one-digit day or       400 years x the days that are written so
       month, or month/day/year where
       day/month/year is no day
email  -                                    the part before @ by a keyed digest

Separators stay where they are.  What does not validate stays as it is.  E-mail addresses
are no numbers; their names go to a digest in the same call, so that a text with its
numbers replaced does not keep them.

Nulls and edges: a null text stays null, an empty one empty; repeated rows are replaced
alike; an empty table gives an empty result; further columns are carried by ``replace``.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart.llm.common import let

ROUNDS = 10
#: fixed values: how personal numbers and dates are written
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
#: usual groupings of a card, with one separator
GROUPED = "|".join(
    rf"[0-9]{{{sizes[0]}}}" + "".join(rf"{sep}[0-9]{{{n}}}" for n in sizes[1:])
    for sizes in ((4, 4, 4, 4, 3), (4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 5))
    for sep in " -"
)
_NATIONAL = r"[2-9][0-9]{2}"
#: +1; other countries; North America without +1; numbers that begin with a trunk 0
PHONE = "|".join([
    r"\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])",
    r"\+[2-9][0-9]{0,2}(?:[ ./-]?\(?[0-9]\)?){6,13}(?![0-9])",
    r"(?<![0-9A-Za-z./+-])(?:1[ .-])?(?:"
    + "|".join(
        [rf"\({_NATIONAL}\) ?{_NATIONAL}[ .-][0-9]{{4}}"]
        + [rf"{_NATIONAL}{sep}{_NATIONAL}{sep}[0-9]{{4}}" for sep in ("-", r"\.", " ")]
    )
    + r")(?![0-9A-Za-z]|[.-][0-9])",
    rf"(?<![0-9A-Za-z./+-])(?!(?:{GROUPED})(?![0-9A-Za-z]))(?:"
    r"0[1-9](?:(?: [0-9]{2}){4}|(?:\.[0-9]{2}){4}|(?:-[0-9]{2}){4})"
    r"|(?:\(0[1-9][0-9]{1,3}\) ?|0[1-9][0-9]{1,3}[ /-])(?:[0-9]{3,4}[ -][0-9]{3,4}|[0-9]{5,8})"
    r")(?![0-9A-Za-z]|[.-][0-9])",
])
DATE = (
    r"(?<![0-9/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}"
    r"|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}(?!\.[0-9]))(?![0-9/-])"
)
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
IP = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"
_GROUP = rf"(?:(?:{GROUPED})(?![0-9A-Za-z])|[0-9]++(?![A-Za-z]))"
#: digit groups from 13 digits on, up to the next value of another kind
CARD = (
    rf"(?<![0-9A-Za-z])(?=[0-9](?:[ -]?[0-9]){{12}}){_GROUP}"
    rf"(?:(?! (?:{PHONE}|{DATE}|{SSN}|{IP}))[ -]{_GROUP})*+"
)
#: how one card is written among such groups, the surest form first
BARE = r"(?<![0-9])[0-9]{13,19}(?![0-9])"
LONGEST = r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])"
ANY = "|".join([EMAIL, PHONE, DATE, SSN, IP, CARD])
KINDS = ["email", "phone", "date", "ssn", "ip", "card"]
FIRST_DAY = "1800-01-01"
FIRST_YEAR, YEARS = 1800, 400
#: country codes of one and two digits; the others have three
COUNTRY = r"^(7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"


def _keyed(key: str, *parts) -> Column:
    """52 bits of a keyed digest."""
    text = F.concat_ws(":", F.lit(key), *[p.cast("string") for p in parts], F.lit(key))
    return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("long")


def feistel(
    left: Column, right: Column, left_size: Column, right_size: Column, key: str, kind: str,
    undo: bool = False,
) -> Column:
    """Keyed permutation of the pairs (left < left_size, right < right_size) as a struct l, r."""

    def turn(state, i):
        add_left = F.pmod(_keyed(key, F.lit(kind), right_size, i, state["r"]), left_size)
        add_right = F.pmod(_keyed(key, F.lit(kind), left_size, i, state["l"]), right_size)
        sign = F.lit(-1 if undo else 1)
        even = i % 2 == 0
        return F.struct(
            F.when(even, F.pmod(state["l"] + sign * add_left, left_size)).otherwise(state["l"]).alias("l"),
            F.when(even, state["r"]).otherwise(F.pmod(state["r"] + sign * add_right, right_size)).alias("r"),
        )

    order = range(ROUNDS - 1, -1, -1) if undo else range(ROUNDS)
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.array(*[F.lit(i) for i in order]), start, turn)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _refill(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced in order by ``digits``."""

    def put(state, c):
        digit = c.rlike("^[0-9]$")
        return F.struct(
            F.concat(state["out"], F.when(digit, F.substring(digits, state["k"], F.lit(1))).otherwise(c)).alias("out"),
            (state["k"] + digit.cast("int")).alias("k"),
        )

    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))
    return F.aggregate(F.split(value, ""), start, put, lambda s: s["out"])


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of digits that lack their check digit."""
    reversed_digits = F.split(F.reverse(digits), "")
    doubled = F.transform(
        reversed_digits,
        lambda c, i: F.when(
            i % 2 == 0, (c.cast("int") * 2 / 10).cast("int") + c.cast("int") * 2 % 10
        ).otherwise(c.cast("int")),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x)


def _check_digit(digits: Column) -> Column:
    return (F.pmod(10 - _luhn_sum(digits) % 10, F.lit(10))).cast("string")


def _padded(number: Column, width) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def _one_card(value: Column, key: str, undo: bool) -> Column:
    def swap(digits):
        n = F.length(digits)
        body = F.substring(digits, F.lit(1), n - 1)
        split = ((n - 1) / 2).cast("int")
        size = lambda k: F.pow(F.lit(10.0), k).cast("long")
        moved = feistel(
            F.substring(body, F.lit(1), split).cast("long"),
            F.substring(body, split + 1, n).cast("long"),
            size(split), size(n - 1 - split), key, "card", undo,
        )
        return let(
            let(moved, lambda s: F.concat(_padded(s["l"], split), _padded(s["r"], n - 1 - split))),
            lambda b: F.concat(b, _check_digit(b)),
        )

    return _refill(value, let(_digits(value), swap))


def _luhn(value: Column) -> Column:
    def valid(digits):
        n = F.length(digits)
        return _check_digit(F.substring(digits, F.lit(1), n - 1)) == F.substring(digits, n, F.lit(1))

    return let(_digits(value), valid)


def _spot(card: Column) -> Column:
    return F.concat(F.lit("(?<![0-9])"), card, F.lit("(?![0-9])"))


def _cards(value: Column) -> Column:
    """The valid cards among the digit groups of ``value``: struct of them and of their number.

    Bare digits come first, then the usual groupings at any place, then the longest run of
    13 to 19 digits, and last the runs that begin or end with it.
    """
    every = lambda pattern, i=0: F.regexp_extract_all(value, F.lit(pattern), F.lit(i))

    def shorter(run):
        part = lambda pattern: F.regexp_extract(run, pattern, 1)
        return F.array(*[
            part(pattern) for n in range(18, 12, -1)
            for pattern in (
                rf"^([0-9](?:[ -]?[0-9]){{{n - 1}}})[ -]", rf"[ -]([0-9](?:[ -]?[0-9]){{{n - 1}}})$",
            )
        ])

    def chosen(candidates):
        start = F.struct(
            value.alias("rest"), F.array().cast("array<string>").alias("cards"), F.lit(0).alias("n")
        )

        def take(state, card):
            times = F.regexp_count(state["rest"], _spot(card))
            return F.when(times > 0, F.struct(
                F.regexp_replace(state["rest"], _spot(card), F.lit("x")).alias("rest"),
                F.concat(state["cards"], F.array(card)).alias("cards"),
                (state["n"] + times).alias("n"),
            )).otherwise(state)

        return F.aggregate(F.filter(candidates, lambda c: (c != "") & _luhn(c)), start, take)

    candidates = let(every(LONGEST), lambda runs: F.array_distinct(F.concat(
        every(BARE), every(rf"(?<![0-9])(?=((?:{GROUPED})(?![0-9])))", 1), runs,
        F.flatten(F.transform(runs, shorter)),
    )))
    return let(candidates, chosen)


def _card(value: Column, key: str, undo: bool) -> Column:
    # what is done is held in letters, so that no later card meets its digits
    def put(text, card):
        fresh = F.translate(_one_card(card, key, undo), "0123456789", "abcdefghij")
        return F.regexp_replace(text, _spot(card), fresh)

    return F.aggregate(
        _cards(value)["cards"], value, put, lambda text: F.translate(text, "abcdefghij", "0123456789")
    )


def _american(value: Column, key: str, undo: bool) -> Column:
    """Numbers that can be dialled stay so; the others move among their like."""

    def swap(digits):  # area, exchange, line
        area = F.substring(digits, 1, 3).cast("long")
        rest = F.substring(digits, 4, 7).cast("long")
        no_area, no_exchange = area < 200, rest < 2_000_000
        low_area = F.when(no_area, 0).otherwise(200)
        low_rest = F.when(no_area | no_exchange, 0).otherwise(2_000_000)
        areas = F.when(no_area, 200).otherwise(800)
        rests = F.when(no_area, 10_000_000).when(no_exchange, 2_000_000).otherwise(8_000_000)
        moved = feistel(area - low_area, rest - low_rest, areas, rests, key, "phone", undo)
        return let(moved, lambda s: F.concat(
            _padded(s["l"] + low_area, 3), _padded(s["r"] + low_rest, 7)
        ))

    digits = _digits(value)
    # the country's 1 is or is not written
    return _refill(value, let(digits, lambda d: F.concat(
        F.substring(d, F.lit(1), F.length(d) - 10), swap(F.right(d, F.lit(10)))
    )))


def _abroad(value: Column, key: str, undo: bool) -> Column:
    """Country code or trunk 0 stay; the others move within their length, a leading 0 stays one."""

    def swap(digits):
        code = F.when(value.startswith("+"), F.regexp_extract(digits, COUNTRY, 1)).otherwise("0")

        def move(code):
            own = F.substring(digits, F.length(code) + 1, F.length(digits))
            n = F.length(own)
            split = (n / 2).cast("int")
            power = lambda k: F.pow(F.lit(10.0), k).cast("long")
            left = F.substring(own, F.lit(1), split).cast("long")
            low = F.when(own.startswith("0"), F.lit(0).cast("long")).otherwise(power(split - 1))
            size = F.when(own.startswith("0"), power(split - 1)).otherwise(9 * power(split - 1))
            moved = feistel(
                left - low, F.substring(own, split + 1, n).cast("long"), size, power(n - split),
                f"{key}:abroad", "phone", undo,
            )
            return let(moved, lambda s: F.concat(
                code, _padded(s["l"] + low, split), _padded(s["r"], n - split)
            ))

        return let(code, move)

    return _refill(value, let(_digits(value), swap))


def _phone(value: Column, key: str, undo: bool) -> Column:
    american = value.startswith("+1") | value.rlike(r"^(?:1[ .-])?\(?[2-9]")
    return F.when(american, _american(value, key, undo)).otherwise(_abroad(value, key, undo))


def _ssn(value: Column, key: str, undo: bool) -> Column:
    def swap(digits):
        area, group, serial = (
            F.substring(digits, at, n).cast("long") for at, n in ((1, 3), (4, 2), (6, 4))
        )
        rest = (group - 1) * 9_999 + serial - 1
        place = area - F.when(area > 666, 2).otherwise(1)
        moved = feistel(place, rest, F.lit(898), F.lit(99 * 9_999), key, "ssn", undo)
        fresh = let(moved, lambda s: F.concat(
            _padded(s["l"] + F.when(s["l"] < 665, 1).otherwise(2), 3),
            _padded(F.floor(s["r"] / 9_999) + 1, 2), _padded(s["r"] % 9_999 + 1, 4),
        ))
        valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
        return F.when(valid, fresh).otherwise(digits)

    return _refill(value, let(_digits(value), swap))


def _ip(value: Column, key: str, undo: bool) -> Column:
    def swap(octets):
        a, b, c, d = (F.get(octets, F.lit(i)).cast("long") for i in range(4))
        valid = (F.greatest(a, b, c, d) <= 255) & ~value.rlike(r"(^|\.)0[0-9]")
        moved = feistel(a * 256 + b, c * 256 + d, F.lit(65_536), F.lit(65_536), key, "ip", undo)
        fresh = let(moved, lambda s: F.concat_ws(
            ".", *[x.cast("string") for h in ("l", "r") for x in (F.floor(s[h] / 256), s[h] % 256)]
        ))
        return F.when(valid, fresh).otherwise(value)

    return let(F.split(value, r"\."), swap)


def _day_number(found: Column, key: str, undo: bool) -> Column:
    """Another day of the 2^17 from ``FIRST_DAY`` on; null for days beyond them."""
    first = F.lit(FIRST_DAY).cast("date")

    def swap(n):
        moved = feistel(F.floor(n / 256), n % 256, F.lit(512), F.lit(256), key, "date", undo)
        return F.when(n.between(0, 2**17 - 1), let(moved, lambda s: F.date_add(
            first, (s["l"] * 256 + s["r"]).cast("int")
        )))

    return let(F.datediff(found, first).cast("long"), swap)


def _short_date(value: Column, key: str, undo: bool) -> Column:
    """Dates with one-digit days or months or with the month first, among those written alike.

    A year moves among 400, month and day among those that the width of both allows (and,
    month first, that can't be read day first); 29 February stays one in another leap year.
    """
    days = [31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31]
    every = [(m + 1, d + 1) for m in range(12) for d in range(days[m])]
    leaps = [
        y for y in range(FIRST_YEAR, FIRST_YEAR + YEARS) if y % 4 == 0 and (y % 100 or y % 400 == 0)
    ]

    def listed(keep):
        return F.array(*[F.lit(100 * m + d) for m, d in every if keep(m, d)])

    def swap(part):
        one, two, year = (F.get(part, F.lit(i)) for i in range(3))
        real = lambda m, d: F.try_to_date(
            F.concat_ws("-", year, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd"
        ).isNotNull()
        day_first = real(two, one)
        month_first = ~day_first & value.contains("/") & real(one, two)
        month, day = (F.when(day_first, x).otherwise(y) for x, y in ((two, one), (one, two)))
        short_month, short_day = F.length(month) == 1, F.length(day) == 1
        among = (
            F.when(month_first & short_month, listed(lambda m, d: d > 12 and m < 10))
            .when(month_first, listed(lambda m, d: d > 12))
            .when(short_month & short_day, listed(lambda m, d: d < 10 and m < 10))
            .when(short_month, listed(lambda m, d: m < 10))
            .otherwise(listed(lambda m, d: d < 10))
        )
        kind = F.concat_ws(
            "-", F.when(month_first, "month").otherwise("day"), F.length(month), F.length(day)
        )

        def move(among):
            spot = F.array_position(among, (month.cast("int") * 100 + day.cast("int")))
            leap = spot == 0
            at = F.array_position(F.array(*[F.lit(y) for y in leaps]), year.cast("int"))
            moved = feistel(
                F.when(leap, at - 1).otherwise(year.cast("long") - FIRST_YEAR),
                F.when(leap, 0).otherwise(spot - 1),
                F.when(leap, len(leaps)).otherwise(YEARS), F.when(leap, 1).otherwise(F.size(among)),
                key, kind, undo,
            )

            def write(s):
                years = F.when(leap, F.get(F.array(*[F.lit(y) for y in leaps]), s["l"].cast("int")))
                new = F.when(leap, 229).otherwise(F.get(among, s["r"].cast("int")))
                m = _padded(F.floor(new / 100), 2)
                d = _padded(new % 100, 2)
                m, d = F.right(m, F.length(month)), F.right(d, F.length(day))
                sign = F.when(value.contains("/"), "/").otherwise(".")
                return F.concat(
                    F.when(day_first, d).otherwise(m), sign, F.when(day_first, m).otherwise(d), sign,
                    F.coalesce(years, (s["l"] + FIRST_YEAR).cast("int")).cast("string"),
                )

            return let(moved, write)

        valid = (day_first | month_first) & year.cast("int").between(FIRST_YEAR, FIRST_YEAR + YEARS - 1)
        return F.when(valid, let(among, move)).otherwise(value)

    return let(F.split(value, "[/.]"), swap)


def _date(value: Column, key: str, undo: bool) -> Column:
    out = F.when(value.contains("-"), F.coalesce(
        F.date_format(_day_number(F.try_to_date(value, "yyyy-MM-dd"), key, undo), "yyyy-MM-dd"), value
    ))
    for form in ("dd/MM/yyyy", "dd.MM.yyyy"):
        found = F.when(F.length(value) == 10, F.try_to_date(value, form))
        moved = F.date_format(_day_number(found, key, undo), form)
        out = out.when(found.isNotNull(), F.coalesce(moved, value))
    return out.otherwise(_short_date(value, key, undo))


def _email(value: Column, key: str) -> Column:
    # 128 bits: no two people share a pseudonym
    name = F.substring(F.sha2(F.concat_ws(":", F.lit(key), F.lower(value)), 256), 1, 32)
    return F.concat(F.lit("user-"), name, F.lit("@"), F.substring_index(value, "@", -1))


def kind_of(value: Column) -> Column:
    kind = F.when(value.contains("@"), "email").when(value.startswith("+"), "phone")
    for name, pattern in (("phone", PHONE), ("date", DATE), ("ssn", SSN), ("ip", IP)):
        kind = kind.when(value.rlike(f"^(?:{pattern})$"), name)
    return kind.otherwise("card")


def pseudonym(value: Column, key: str, undo: bool = False) -> Column:
    """The replacement of one found value; ``undo`` gives numbers and dates back."""

    def swap(kind):
        out = F.when(kind == "email", value if undo else _email(value, key))
        for name, permute in (
            ("phone", _phone), ("date", _date), ("ssn", _ssn), ("ip", _ip), ("card", _card),
        ):
            out = out.when(kind == name, permute(value, key, undo))
        return out

    return let(kind_of(value), swap)


def _swapped(docs: DataFrame, key: str, undo: bool = False) -> DataFrame:
    """``docs`` (with a column text) with found, swapped and fresh."""
    found = docs.withColumn("found", F.regexp_extract_all("text", F.lit(ANY), F.lit(0)))
    swapped = found.withColumn("swapped", F.transform("found", lambda v: pseudonym(v, key, undo)))
    # the pieces between the values, and the values: one piece more than values
    pieces = F.split("text", ANY, -1)
    joined = F.array_join(
        F.zip_with(pieces, "swapped", lambda piece, v: F.concat(piece, F.coalesce(v, F.lit("")))), ""
    )
    return swapped.withColumn("fresh", F.when(F.size("found") > 0, joined).otherwise(F.col("text")))


def digest(docs: DataFrame, key: str) -> DataFrame:
    """doc_id, the whole text with pseudonyms, and the number of values replaced by kind."""
    rows = _swapped(docs.select("doc_id", "text"), key)
    changed = F.filter(
        F.arrays_zip("found", "swapped"), lambda x: x["found"] != x["swapped"]
    )

    def kinds_of(found):
        return let(kind_of(found), lambda kind: F.array_repeat(
            kind, F.when(kind == "card", _cards(found)["n"]).otherwise(1)
        ))

    kinds = F.flatten(F.transform(changed, lambda x: kinds_of(x["found"])))

    def count(name: str) -> Column:
        own = F.size(F.filter("kinds", lambda k: k == name))
        return F.coalesce(own, F.lit(0)).alias(f"n_{name}")

    counts = [count(name) for name in KINDS]
    return rows.withColumn("kinds", kinds).select("doc_id", F.col("fresh").alias("text"), *counts)


def replace(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with the values in ``text`` replaced."""
    rows = _swapped(docs.select(F.struct("*").alias("doc"), "text"), key)
    return rows.withColumn("doc", F.col("doc").withField("text", F.col("fresh"))).select("doc.*")
