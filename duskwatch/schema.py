"""Table layouts.

Metadata keys that the parsers and the geo step produce are stored as flat
nullable columns (NULL = key absent), so a Parquet scan reads only the keys a
query uses.  Keys added by custom parsers go to the ``extra`` map.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FAILED_LOGIN = "SSHD_Failed_Password"
ACCEPTED_LOGIN = "SSHD_Accepted_Password"
PROCESS = "Process_Executed"

LOGIN_KEYS = ("user", "sshd_pid")
PROCESS_KEYS = ("uid", "process_name", "pid", "ppid", "return_code", "command")
GEO_KEYS = ("country", "country_name", "city", "latitude", "longitude")
META_KEYS = LOGIN_KEYS + PROCESS_KEYS + GEO_KEYS

# Keys the event store matches exactly; every other key is matched by token.
KEYWORD_KEYS = ("process_name", "pid", "ppid", "uid", "user", "sshd_pid")

EXTRA_TYPE = T.MapType(T.StringType(), T.StringType())

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("host", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
    + [T.StructField(k, T.StringType()) for k in META_KEYS]
    + [T.StructField("extra", EXTRA_TYPE)]
)

ALERT_SCHEMA = T.StructType(
    [
        T.StructField("rule_order", T.IntegerType()),
        T.StructField("rule_name", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("source", T.StringType()),
        T.StructField("host", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("metadata", EXTRA_TYPE),
    ]
)


def meta(key: str) -> Column:
    """The value of one metadata key, NULL when the event does not carry it."""
    if key in META_KEYS:
        return F.col(key)
    return F.try_element_at(F.col("extra"), F.lit(key))


def micros(ts: str | Column = "ts") -> Column:
    """Event time as BIGINT microseconds; independent of the session time zone."""
    return F.unix_micros(ts)


def conform(df: DataFrame) -> DataFrame:
    """Project onto EVENT_SCHEMA, filling absent columns with NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in EVENT_SCHEMA.fields
        ]
    )


def metadata_map(keys: tuple[str, ...] = META_KEYS, with_extra: bool = True) -> Column:
    """Rebuild the open key/value map of an event, keys in ascending order."""
    none = F.array().cast("array<struct<key:string,value:string>>")
    known = [F.struct(F.lit(k).alias("key"), F.col(k).alias("value")) for k in sorted(keys)]
    present = F.filter(F.array(*known), lambda e: e["value"].isNotNull()) if known else none
    if with_extra:
        rest = F.coalesce(F.map_entries("extra"), none)
        present = F.array_sort(F.concat(present, rest))
    return F.map_from_entries(present)
