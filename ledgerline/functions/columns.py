"""Small column expressions shared by several operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Class ladders, lower bounds are exclusive, highest class first.
SCORING_LADDER = ((20, "star"), (15, "good"), (10, "average"))
QUALITY_LADDER = ((8, "star"), (7, "good"), (6, "average"))
LOWEST_CLASS = "bad"
CLASS_RANK = {"bad": 0, "average": 1, "good": 2, "star": 3}

# 32-day activity masks, today is the highest bit.
DATELIST_WIDTH = 32
DAY_MASK = 0x80000000
WEEK_MASK = 0xFE000000
PREVIOUS_WEEK_MASK = 0x01FC0000

# Referrer substrings in the order they are tried.
CHANNEL_RULES = (
    ("linkedin", "Linkedin"),
    ("t.co", "Twitter"),
    ("google", "Google"),
    ("lnkd", "Linkedin"),
)


def ladder(value: Column, steps: Sequence[tuple[float, str]], otherwise: str = LOWEST_CLASS) -> Column:
    """First label whose bound is strictly below ``value``; null takes the last label."""
    label = F.lit(otherwise)
    for bound, name in sorted(steps):
        label = F.when(value > F.lit(bound), F.lit(name)).otherwise(label)
    return label


def class_rank(label: Column, ranks: dict[str, int] = CLASS_RANK) -> Column:
    """Position of an ordered class label; null for an unknown label."""
    pairs = [F.lit(part) for item in ranks.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), label)


def changed(now: Column, before: Column) -> Column:
    """True when two values differ, null counting as a value of its own."""
    return ~now.eqNullSafe(before)


def ratio(top: Column, bottom: Column) -> Column:
    """Double division giving null, not an error, for a zero divisor."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def clock_minutes(text: Column) -> Column:
    """``MM:SS`` as fractional minutes; missing or bad seconds count as zero."""
    minutes = F.split_part(text, F.lit(":"), F.lit(1)).try_cast("double")
    seconds = F.split_part(text, F.lit(":"), F.lit(2)).try_cast("double")
    return minutes + F.coalesce(seconds, F.lit(0.0)) / F.lit(60.0)


def mentions(text: Column, word: str) -> Column:
    """True when ``text`` holds ``word``; null text is false."""
    return F.coalesce(F.instr(text, word) > 0, F.lit(False))


def channel(
    referrer: Column,
    rules: Sequence[tuple[str, str]] = CHANNEL_RULES,
    own_hosts: Sequence[str] = (),
    own_label: str = "On Site",
) -> Column:
    """Label of the first rule whose substring occurs, else the referrer itself.

    ``own_hosts``, the caller's sites, come before all rules.
    """
    rules = [*((host, own_label) for host in own_hosts), *rules]
    label = referrer
    for needle, name in reversed(rules):
        label = F.when(referrer.contains(needle), F.lit(name)).otherwise(label)
    return label


def bits_of_dates(dates: Column, as_of: Column, width: int = DATELIST_WIDTH) -> Column:
    """One bit per active day up to ``as_of``, today highest, as a long."""

    def add(bits: Column, day: Column) -> Column:
        age = F.datediff(as_of, day)
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.lit(width - 1) - age)
        return F.when(age.between(0, width - 1), bits.bitwiseOR(bit)).otherwise(bits)

    return F.aggregate(dates, F.lit(0).cast("long"), add)


def days_in_mask(bits: Column, mask: int) -> Column:
    """How many bits of ``mask`` are set."""
    return F.bit_count(bits.bitwiseAND(F.lit(mask).cast("long"))).cast("long")


def dates_of_bits(bits: Column, as_of: Column, width: int = DATELIST_WIDTH) -> Column:
    """The active days of a bit list in ascending order (inverse of ``bits_of_dates``)."""
    ages = F.sequence(F.lit(width - 1), F.lit(0))
    active = F.filter(ages, lambda age: F.getbit(bits, F.lit(width - 1) - age) == 1)
    return F.transform(active, lambda age: F.date_sub(as_of, age))


def ip_number(ip: Column) -> Column:
    """Dotted IPv4 text as a long; null unless it is four numbers from 0 to 255."""
    parts = F.split(ip, r"\.")
    total = F.lit(0).cast("long")
    for place in range(4):
        octet = F.get(parts, F.lit(place)).try_cast("long")
        total = total * 256 + F.when(octet.between(0, 255), octet)
    return F.when(F.size(parts) == 4, total)


def hash_percent(salt: str, unit: Column, cells: int = 100) -> Column:
    """Stable slot 0..cells-1 from the first 8 hex digits of md5(salt, unit)."""
    digest = F.md5(F.concat(F.lit(salt), F.lit(":"), unit.cast("string")))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(cells))


def empty_array(element_type: str) -> Column:
    return F.array().cast(f"array<{element_type}>")
