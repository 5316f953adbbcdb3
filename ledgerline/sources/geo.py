"""IP address to place, from a table of address ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import ip_number

NO_PLACE = "{}"


def covered_prefixes(ranges: DataFrame, prefix_bits: int = 20) -> DataFrame:
    """Each range once per address prefix it touches, so it can join on equality."""
    size = 1 << (32 - prefix_bits)
    first = F.floor(F.col("ip_from") / size)
    last = F.floor(F.col("ip_to") / size)
    return ranges.withColumn("_prefix", F.explode(F.sequence(first, last)))


def locate(
    events: DataFrame, ranges: DataFrame, ip: str = "ip", name: str = "geodata", prefix_bits: int = 20, parts: int = 8
) -> DataFrame:
    """Add a JSON text with country, state and city; ``{}`` when no range holds the address.

    ``ranges`` has ``ip_from``, ``ip_to`` (inclusive, as numbers, not
    overlapping), ``country``, ``state``, ``city``. The join is an equality on
    the address prefix with the range test as a residual. A stream cannot split
    a busy prefix while it runs, so the events of a prefix are dealt over
    ``parts`` by a hash of the row, and each range stands once in every part.
    """
    size = 1 << (32 - prefix_bits)
    e = events.withColumn("_ip", ip_number(F.col(ip))).withColumn("_e_prefix", F.floor(F.col("_ip") / size))
    e = e.withColumn("_e_part", F.pmod(F.xxhash64(*events.columns), F.lit(parts)))
    numbers = F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))
    r = covered_prefixes(ranges, prefix_bits).withColumn("_part", F.explode(numbers))
    same = (F.col("_e_prefix") == F.col("_prefix")) & (F.col("_e_part") == F.col("_part"))
    inside = same & F.col("_ip").between(F.col("ip_from"), F.col("ip_to"))
    place = F.to_json(F.struct("country", "state", "city"), {"ignoreNullFields": "false"})
    found = F.when(F.col("ip_from").isNotNull(), place).otherwise(F.lit(NO_PLACE))
    return e.join(r, inside, "left").select(*events.columns, found.alias(name))
