"""Scalar column expressions."""

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart import constants as C


def same_row(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equal in all ``keys``, nulls being equal."""
    return functools.reduce(Column.__and__, [left[k].eqNullSafe(right[k]) for k in keys])


def event_time(millis: Column) -> Column:
    """Epoch milliseconds to a real timestamp (sub-second part kept)."""
    return F.timestamp_millis(millis)


def event_order(event_ts: Column, event_id: Column) -> Column:
    """A number that orders events by time and the first eight bytes of their id.

    Minima of numbers stay in hash aggregation, those of structs and texts need sorted rows.
    """
    prefix = F.rpad(F.hex(F.substring(F.encode(event_id, "utf-8"), 1, 8)), 16, "0")
    number = F.coalesce(F.conv(prefix, 16, 10).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    shift = F.lit("1" + "0" * 20).cast("decimal(21,0)")
    return F.unix_micros(event_ts).cast("decimal(18,0)") * shift + number


def event_hash(user_id: Column, timestamp: Column) -> Column:
    """md5 of user and epoch milliseconds; an absent value reads ``None``."""
    absent = F.lit("None")
    return F.md5(
        F.concat(
            F.coalesce(user_id.cast("string"), absent),
            F.coalesce(timestamp.cast("string"), absent),
        )
    )


_OCTET = r"(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_GROUP = r"[0-9a-f]{1,4}"
#: an IPv4 address is the IPv6 address ::ffff:a.b.c.d
IPV4_HEAD = "0" * 20 + "ffff"


def _ipv4_hex(ip: Column) -> Column:
    """Eight hexadecimal digits of a dotted address; null when it is not one."""
    octets = F.split(F.when(ip.rlike(rf"^{_OCTET}(\.{_OCTET}){{3}}$"), ip), r"\.")
    return F.concat(*[F.lpad(F.lower(F.hex(octets.getItem(i).cast("bigint"))), 2, "0") for i in range(4)])


def _ipv6_hex(ip: Column) -> Column:
    """32 hexadecimal digits of a colon address; null when it is not one."""
    low = F.lower(ip)
    # a dotted tail stands for the last two groups
    tail = _ipv4_hex(F.substring_index(low, ":", -1))
    groups_only = F.when(
        low.contains("."),
        F.concat(
            F.regexp_replace(low, r"[^:]*$", ""), F.substring(tail, 1, 4), F.lit(":"), F.substring(tail, 5, 4)
        ),
    ).otherwise(low)
    well_formed = groups_only.rlike(rf"^({_GROUP}(:{_GROUP})*)?(::({_GROUP}(:{_GROUP})*)?)?$")
    halves = F.split(F.when(well_formed, groups_only), "::")

    def padded(half: Column) -> Column:
        return F.transform(
            F.filter(F.split(F.coalesce(half, F.lit("")), ":"), lambda g: g != ""), lambda g: F.lpad(g, 4, "0")
        )

    left, right = padded(F.get(halves, F.lit(0))), padded(F.get(halves, F.lit(1)))
    missing = F.lit(8) - F.size(left) - F.size(right)
    # "::" stands for one group of zeros at least
    right_count = F.when(F.size(halves) == 2, missing >= 1).otherwise(missing == 0)
    zeros = F.array_repeat(F.lit("0000"), F.greatest(missing, F.lit(0)))
    return F.when(right_count, F.array_join(F.concat(left, zeros, right), ""))


def ip_key(ip: Column) -> Column:
    """Address of either family as 32 hexadecimal digits that compare like the number."""
    four = F.concat(F.lit(IPV4_HEAD), _ipv4_hex(ip))
    return F.when(ip.contains(":"), _ipv6_hex(ip)).otherwise(four)


def ip_number_key(number: Column) -> Column:
    """The same for an IPv4 address that is given as a number."""
    return F.concat(F.lit(IPV4_HEAD), F.lpad(F.lower(F.hex(number.cast("bigint"))), 8, "0"))


def month_diff(start: Column, end: Column) -> Column:
    """Calendar-month boundaries crossed (Jan 31 to Feb 1 is one)."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def interaction_rating(event_type: Column) -> Column:
    return (
        F.when(event_type == C.PURCHASE, F.lit(C.RATING_PURCHASE))
        .when(event_type == C.CART_ADD, F.lit(C.RATING_CART_ADD))
        .otherwise(F.lit(C.RATING_OTHER))
    )


def exact_ratio(total: Column, count: Column, result_type) -> Column:
    """Decimal quotient rounded once, half up; null when ``count`` is 0."""
    return F.try_divide(total, count).cast(result_type)


def is_purchase(event_type: Column) -> Column:
    return event_type == F.lit(C.PURCHASE)
