"""Detectors without state: pattern rules and the address watchlist."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import META_KEYS, meta, metadata_map, micros
from ..sources.checkpoint import checkpointed
from ..sources.rules import load_rules, rules_frame
from .lookup import BROADCAST_ROWS, attach

# Rule sets up to this size become constant predicates of one projection.
INLINE_RULES = 256
# Beyond that they are joined: broadcast up to this many rows, else spread over salts.
BROADCAST_RULES = 10_000
RULE_SALTS = 64


def where_rule(rule: tuple) -> Column:
    """One rule as a predicate over event columns; never NULL.

    A field that is not ``metadata.<key>`` is skipped, an absent key fails, and
    so does any operator other than contains and equals.
    """
    event_type, conditions = rule[5], rule[6]
    test = F.col("event_type") == event_type
    for name, operator, value in conditions:
        part = name.split(".")
        if len(part) != 2 or part[0] != "metadata":
            continue
        column = meta(part[1])
        if operator == "contains":
            test = test & column.contains(value)
        elif operator == "equals":
            test = test & (column == value)
        else:
            test = test & F.lit(False)
    return F.coalesce(test, F.lit(False))


def conditions_hold(conditions: Column, values: Column) -> Column:
    """The same test for conditions held in a column, against a metadata map column."""

    def holds(c: Column) -> Column:
        part = F.split(c["field"], r"\.", -1)
        skipped = (F.size(part) != 2) | (F.get(part, F.lit(0)) != "metadata")
        value = F.try_element_at(values, F.get(part, F.lit(1)))
        test = (
            F.when(c["operator"] == "contains", F.contains(value, c["value"]))
            .when(c["operator"] == "equals", value == c["value"])
            .otherwise(False)
        )
        return skipped | F.coalesce(test, F.lit(False))

    return F.forall(conditions, holds)


def _used_keys(rules: list[tuple]) -> set[str]:
    parts = [c[0].split(".") for r in rules for c in r[6]]
    return {p[1] for p in parts if len(p) == 2 and p[0] == "metadata"}


def _join_rules(typed: DataFrame, rules: list[tuple]) -> DataFrame:
    used = _used_keys(rules)
    known = tuple(k for k in META_KEYS if k in used)
    valued = typed.withColumn("_values", metadata_map(known, bool(used - set(known))))
    table = rules_frame(typed.sparkSession, rules).withColumnRenamed("event_type", "rule_type")
    test = (F.col("event_type") == F.col("rule_type")) & conditions_hold(F.col("conditions"), F.col("_values"))
    if len(rules) <= BROADCAST_RULES:
        return valued.join(F.broadcast(table), test)
    # Event types are few and uneven, so the type alone would not spread a shuffle.
    spread = table.withColumn("rule_salt", F.explode(F.sequence(F.lit(0), F.lit(RULE_SALTS - 1))))
    salt = F.pmod(F.xxhash64("host", "seq"), F.lit(RULE_SALTS).cast("long")).cast("int")
    return valued.withColumn("salt", salt).join(spread, test & (F.col("salt") == F.col("rule_salt")))


def _inline_rules(typed: DataFrame, rules: list[tuple]) -> DataFrame:
    names = ("rule_idx", "name", "description", "technique_id", "severity")
    matched = [F.when(where_rule(r), F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r)])) for r in rules]
    return typed.select("*", F.inline(F.array_compact(F.array(*matched))))


def pattern_hits(events: DataFrame, rules: list[tuple] | None = None) -> DataFrame:
    """Every (event, rule) pair whose type matches and whose conditions hold.

    One pass over the events of the types that some rule names, no shuffle.
    """
    rules = load_rules() if rules is None else rules
    typed = events.where(F.col("event_type").isin(sorted({r[5] for r in rules})) if rules else F.lit(False))
    joined = _inline_rules(typed, rules) if 0 < len(rules) <= INLINE_RULES else _join_rules(typed, rules)
    return joined.select(
        "host",
        micros().alias("us"),
        "seq",
        "source",
        "rule_idx",
        "name",
        "description",
        "technique_id",
        "severity",
        "pid",
        "command",
        "process_name",
    )


def listed(events: DataFrame, watchlist: DataFrame) -> DataFrame:
    """Events whose source is on a list of unknown size.

    Streams leave the choice of join to Spark, per micro-batch.
    """
    addresses = watchlist.select(F.col("ip").alias("source"))
    if events.isStreaming:
        return events.join(addresses, "source", "left_semi")
    if addresses.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return events.join(F.broadcast(addresses), "source", "left_semi")
    seen = events.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return attach(events, checkpointed(seen.join(addresses, "source", "left_semi")), "source", "inner")


def watchlist_hits(events: DataFrame, watchlist: DataFrame) -> DataFrame:
    """Every event of any type whose source is listed."""
    return listed(events.where(F.col("source") != ""), watchlist).select(
        "host", micros().alias("us"), "seq", "source", "event_type"
    )
