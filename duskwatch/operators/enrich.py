"""Geographic enrichment by address range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clock import bind
from ..functions.net import ipv4_to_long, is_private_ip
from ..functions.numbers import floor_div
from ..schema import GEO_KEYS
from ..sources.checkpoint import checkpointed
from .lookup import attach

# Ranges of at least 2^16 addresses are keyed by /16 block, smaller ones by /24.
WIDE_BITS, NARROW_BITS = 16, 8
_LEVEL = 1 << 40


def _blocks(lo: Column, hi: Column, bits: int) -> Column:
    level = F.lit(bits * _LEVEL)
    return F.sequence(level + floor_div(lo, 1 << bits), level + floor_div(hi, 1 << bits))


def ranges_by_block(ranges: DataFrame) -> DataFrame:
    """One row per address block a range touches, so that range lookup is an equi-join.

    With disjoint ranges an address meets at most 256 ranges in its /24 block
    and 2 in its /16 block, whatever the distribution of addresses.
    """
    lo, hi = F.col("start_ip"), F.col("end_ip")
    wide = hi - lo + 1 >= (1 << WIDE_BITS)
    blocks = F.when(wide, _blocks(lo, hi, WIDE_BITS)).otherwise(_blocks(lo, hi, NARROW_BITS))
    return ranges.where(lo <= hi).withColumn("block", F.explode(blocks))


def geo_lookup(sources: DataFrame, ranges: DataFrame) -> DataFrame:
    """source -> geo columns for the public addresses in ``sources``, one row per source.

    A public address without a range gets an empty country, as a miss does in
    the address database.  Overlapping ranges resolve to the narrowest one.
    Columns of ``sources`` other than ``source`` are kept.
    """
    kept = [c for c in sources.columns if c != "source"]
    ip = F.col("source")
    named = sources.where((ip != "localhost") & (ip != ""))
    read = bind(named, {"ip_n": ipv4_to_long(ip), "ip_private": is_private_ip(ip)})
    public = read.where(~F.col("ip_private"))
    number = F.col("ip_n")
    keys = F.concat(_blocks(number, number, WIDE_BITS), _blocks(number, number, NARROW_BITS))
    keyed = public.select("source", *kept, "ip_n", F.explode_outer(keys).alias("block"))
    best = (
        keyed.alias("k")
        .join(
            ranges_by_block(ranges).alias("r"),
            (F.col("k.block") == F.col("r.block")) & F.col("k.ip_n").between(F.col("r.start_ip"), F.col("r.end_ip")),
            "left",
        )
        .groupBy("source", *kept)
        .agg(
            F.min_by(
                F.struct("country", "country_name", "city", "lat", "lon"),
                F.when(F.col("start_ip").isNotNull(), F.struct(F.col("end_ip") - F.col("start_ip"), "start_ip")),
            ).alias("g")
        )
    )
    return best.select("source", *kept, *_geo_columns("g"))


def _geo_columns(record: str) -> list:
    lat, lon = F.col(f"{record}.lat"), F.col(f"{record}.lon")
    located = (lat != 0) & (lon != 0)
    return [
        F.coalesce(f"{record}.country", F.lit("")).alias("country"),
        F.coalesce(f"{record}.country_name", F.lit("")).alias("country_name"),
        F.col(f"{record}.city").alias("city"),
        F.when(located, F.format_string("%.4f", lat)).alias("latitude"),
        F.when(located, F.format_string("%.4f", lon)).alias("longitude"),
    ]


def enrich_geo(events: DataFrame, ranges: DataFrame) -> DataFrame:
    """Set the geo columns of events whose source is a public address.

    The range join runs over distinct addresses, which the map side reduces
    first, so a source that owns a third of the events costs one row there.
    The result goes back to the events by ``attach``, which splits hot sources.
    """
    bare = events.drop(*GEO_KEYS)
    per_source = bare.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    lookup = checkpointed(geo_lookup(per_source, ranges))
    return attach(bare, lookup, "source", "left").select(*dict.fromkeys([*events.columns, *GEO_KEYS]))


def disjoint_ranges(ranges: DataFrame) -> DataFrame:
    """``ranges`` cut where one begins or ends inside another; of those over a piece the narrowest stays.

    A sweep over the borders in each /16 block on its own, so no step sees more than the borders within 65,536 addresses.
    Ties go to the lower start, as in ``geo_lookup``.
    """
    record = [c for c in ranges.columns if c not in ("start_ip", "end_ip")]
    size = 1 << WIDE_BITS
    lo, hi = F.col("start_ip"), F.col("end_ip")
    parts = (
        ranges.where(lo <= hi)
        .withColumn("block", F.explode(F.sequence(floor_div(lo, size), floor_div(hi, size))))
        .select(
            "block",
            F.greatest(lo, F.col("block") * size).alias("lo"),
            F.least(hi, F.col("block") * size + size - 1).alias("hi"),
            F.struct((hi - lo).alias("width"), lo.alias("from")).alias("rank"),
            F.struct(*record).alias("record"),
        )
    )
    borders = parts.select("block", F.explode(F.array("lo", F.col("hi") + 1)).alias("at")).distinct()
    following = F.lead("at").over(Window.partitionBy("block").orderBy("at"))
    pieces = borders.withColumn("upto", following - 1).where(F.col("upto").isNotNull())
    over = (F.col("p.block") == F.col("r.block")) & F.col("p.at").between(F.col("r.lo"), F.col("r.hi"))
    narrowest = F.min_by("r.record", "r.rank").alias("record")
    return (
        pieces.alias("p").join(parts.alias("r"), over)
        .groupBy(F.col("p.at").alias("start_ip"), F.col("p.upto").alias("end_ip"))
        .agg(narrowest)
        .select("start_ip", "end_ip", "record.*")
    )


def enrich_geo_stream(events: DataFrame, ranges: DataFrame) -> DataFrame:
    """The streaming form: two stream-static joins, one per block size, with ranges cut into disjoint ones.

    Nothing is counted up front; Spark broadcasts the ranges while their size
    allows it and shuffles each micro-batch otherwise.
    """
    ranges = checkpointed(disjoint_ranges(ranges))
    bare = bind(events.drop(*GEO_KEYS), {"ip_n": ipv4_to_long(F.col("source")), "ip_private": is_private_ip(F.col("source"))})
    record = F.struct("country", "country_name", "city", "lat", "lon")
    keyed = ranges_by_block(ranges)
    joined = bare
    for name, bits in (("narrow", NARROW_BITS), ("wide", WIDE_BITS)):
        side = keyed.select(
            F.col("block").alias(f"{name}_block"), F.col("start_ip").alias(f"{name}_lo"),
            F.col("end_ip").alias(f"{name}_hi"), record.alias(name),
        )
        number = F.col("ip_n")
        block = F.element_at(_blocks(number, number, bits), 1)
        joined = joined.join(
            side, (block == F.col(f"{name}_block")) & number.between(F.col(f"{name}_lo"), F.col(f"{name}_hi")), "left"
        )
    public = ~F.col("ip_private") & ~F.col("source").isin("localhost", "")
    joined = joined.withColumn("g", F.coalesce("narrow", "wide"))
    geo = [F.when(public, c).alias(k) for k, c in zip(GEO_KEYS, _geo_columns("g"))]
    return joined.select(*bare.drop("ip_n", "ip_private").columns, *geo).select(
        *dict.fromkeys([*events.columns, *GEO_KEYS])
    )
