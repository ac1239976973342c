"""Attack chains: two or three stages linked by a key and a time bound."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clock import HOUR, MINUTE
from ..functions.numbers import floor_div
from ..functions.text import contains_any, fields, first_field_with_prefix
from ..schema import ACCEPTED_LOGIN, PROCESS, micros
from ..sources.checkpoint import checkpointed
from .asof import consume_once, latest_before

# Commands and paths the chains look for.
EVASION_PATTERNS = ("history -c", "unset HISTFILE", "rm /root/.bash_history")
ESCALATION_PATTERNS = ("sudo su", "su -", "sudo -i", "sudo bash", "sudo sh")
DOWNLOADERS = ("wget", "curl")
STAGING_PREFIXES = ("/tmp/", "/dev/shm")

SALTS = 32

EVASION_WINDOW = 5 * MINUTE
EXECUTE_WINDOW = 2 * MINUTE
NEW_ACCOUNT_WINDOW = 1 * HOUR
ESCALATION_WINDOW = 10 * MINUTE


def _processes(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == PROCESS)


def _logins(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == ACCEPTED_LOGIN)


# --- new account, then a login with it -------------------------------------------------


def created_accounts(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    words = fields(F.col("command"))
    return (
        _processes(events)
        .where((F.col("process_name") == "useradd") & (F.size(words) > 1))
        .select("host", F.element_at(words, -1).alias("user"), micros().alias("us"), "seq", *keep)
    )


def account_logins(events: DataFrame) -> DataFrame:
    return (
        _logins(events)
        .where(F.coalesce("user", F.lit("")) != "")
        .select("host", "user", micros().alias("us"), "seq", "source")
    )


def _with_carried(openers: DataFrame, carried: DataFrame | None) -> DataFrame:
    """Openers of these events, and those that earlier events left open."""
    return openers if carried is None else openers.unionByName(carried.select(*openers.columns))


def new_account_hits(events: DataFrame, window_us: int = NEW_ACCOUNT_WINDOW, carried: DataFrame | None = None) -> DataFrame:
    """An account created on a host and used for a login there within the window."""
    created = _with_carried(created_accounts(events), carried)
    return consume_once(created, account_logins(events), ["host", "user"], window_us).select(
        "host", "us", "seq", "source", "user", (F.col("us") - F.col("opener.us")).alias("gap_us")
    )


# --- login from a new country, then privilege escalation -------------------------------


def escalation_attempts(events: DataFrame, link_col: str) -> DataFrame:
    return (
        _processes(events)
        .where(contains_any(F.col("command"), ESCALATION_PATTERNS))
        .select(F.col(link_col).alias("link"), micros().alias("us"), "seq", "host", "source")
    )


def login_escalation_hits(
    events: DataFrame,
    new_countries: DataFrame,
    link_col: str = "source",
    window_us: int = ESCALATION_WINDOW,
    carried: DataFrame | None = None,
) -> DataFrame:
    """A new-country login followed by an escalation command on the same ``link_col``.

    ``source`` links by address as written in the log; ``host`` links the login
    to the machine it happened on, process events having a loopback source.
    """
    if link_col not in ("source", "host"):
        raise ValueError("link_col must be 'source' or 'host'")
    logins = _with_carried(new_countries.select(F.col(link_col).alias("link"), "us", "seq"), carried)
    return consume_once(logins, escalation_attempts(events, link_col), ["link"], window_us).select(
        "host", "us", "seq", "source", (F.col("us") - F.col("opener.us")).alias("gap_us")
    )


# --- brute force, then a login, then covering tracks ------------------------------------


def session_logins(events: DataFrame) -> DataFrame:
    return _logins(events).select("source", micros().alias("us"), "seq", "host", "sshd_pid")


def armed_sessions(events: DataFrame, brute_force: DataFrame) -> DataFrame:
    """The first accepted login from an address after each failed-login alert for it."""
    alerts = brute_force.select("source", "us", "seq")
    return (
        consume_once(alerts, session_logins(events), ["source"], None)
        .where(F.coalesce("sshd_pid", F.lit("")) != "")
        .select("host", F.col("sshd_pid").alias("pid"), "us", "seq", "source")
    )


def evasions(events: DataFrame) -> DataFrame:
    return (
        _processes(events)
        .where(contains_any(F.col("command"), EVASION_PATTERNS) & F.col("ppid").isNotNull())
        .select("host", F.col("ppid").alias("pid"), micros().alias("us"), "seq", "command")
    )


def session_evasion_hits(events: DataFrame, sessions: DataFrame, window_us: int = EVASION_WINDOW) -> DataFrame:
    """An evasion command whose parent is one of the ``sessions``."""
    return consume_once(sessions, evasions(events), ["host", "pid"], window_us).select(
        "host", "us", "seq", F.col("opener.source").alias("source"), "command", F.col("pid").alias("ppid")
    )


def brute_force_evasion_hits(
    events: DataFrame, brute_force: DataFrame, window_us: int = EVASION_WINDOW
) -> DataFrame:
    """An evasion command whose parent is the session of a login after a brute force."""
    # One row per login after a brute force, read twice by the match.
    return session_evasion_hits(events, checkpointed(armed_sessions(events, brute_force)), window_us)


# --- download, then execution of the file -----------------------------------------------


def staged_downloads(events: DataFrame) -> DataFrame:
    return (
        _processes(events)
        .where(F.col("process_name").isin(*DOWNLOADERS))
        .select(
            "host",
            first_field_with_prefix(F.col("command"), STAGING_PREFIXES).alias("path"),
            micros().alias("us"),
            "seq",
        )
        .where(F.col("path").isNotNull())
    )


def _named_paths(events: DataFrame, downloads: DataFrame, window_us: int) -> DataFrame:
    """(execution, path) for every text inside a command that may equal a staged path.

    A staged path has no white space and begins with a staging prefix, so
    inside a command it is the start of some run that begins with one.  Cutting
    those runs to the lengths of paths staged on that host around that time
    turns "command contains path" into an equality, so no execution is ever
    compared with every download.
    """
    span = floor_div(F.col("us"), window_us)
    lengths = (
        downloads.select("host", F.explode(F.array(span, span + 1)).alias("span"), F.length("path").alias("n"))
        .groupBy("host", "span")
        .agg(F.collect_set("n").alias("lengths"))
        # A few short rows, repeated so that a busy host and time is shared by several tasks.
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    runs = F.regexp_extract_all("command", F.lit(r"(?U)(?=(/tmp/\S*|/dev/shm\S*))"), F.lit(1))
    executions = (
        _processes(events)
        .where(
            ~F.coalesce("process_name", F.lit("")).isin(*DOWNLOADERS)
            & contains_any(F.col("command"), STAGING_PREFIXES)
        )
        .select("host", micros().alias("us"), "seq", "source", "command")
        .withColumn("span", span)
        .withColumn("salt", F.pmod(F.xxhash64("seq"), F.lit(SALTS).cast("long")).cast("int"))
    )
    cut = F.flatten(
        F.transform(
            runs,
            lambda r: F.transform(
                F.filter("lengths", lambda n: n <= F.length(r)), lambda n: F.substring(r, F.lit(1), n)
            ),
        )
    )
    return executions.join(lengths, ["host", "span", "salt"]).select(
        "host", F.explode(F.array_distinct(cut)).alias("path"), "us", "seq", "source", "command"
    )


def _islands(items: DataFrame, window_us: int) -> DataFrame:
    """``items`` (host, path, dus, dseq, until_us) with ``island``: the start of the run of intervals they overlap in.

    An interval goes from a download to the last command that may use it, a window later at most, so an
    island begins where no interval of this or the previous window-long cell is still open.  Cells are
    handled on their own; only the last beginning is carried on, one row per host and cell.
    """
    cell = floor_div(F.col("dus"), window_us)
    celled = items.withColumn("cell", cell)
    ends = celled.groupBy("host", (F.col("cell") + 1).alias("cell")).agg(F.max("until_us").alias("before_us"))
    so_far = Window.partitionBy("host", "cell").orderBy("dus", "dseq", "path")
    earlier = so_far.rowsBetween(Window.unboundedPreceding, -1)
    open_until = F.greatest("before_us", F.max("until_us").over(earlier))  # nulls are skipped
    begins = open_until.isNull() | (F.col("dus") > open_until)
    begun = (
        celled.join(ends, ["host", "cell"], "left")
        .withColumn("begins", begins)
        .withColumn("island", F.max(F.when(F.col("begins"), F.col("dus"))).over(so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    )
    by_cell = Window.partitionBy("host").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = begun.groupBy("host", "cell").agg(F.max("island").alias("last"))
    carried = cells.select("host", "cell", F.max("last").over(by_cell).alias("carried"))
    return begun.join(carried, ["host", "cell"]).select(*items.columns, F.coalesce("island", "carried").alias("island"))


def _parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(host, island, path, part): paths that commands name together, directly or by way of others, are one part."""
    for batch in batches:
        out = []
        for host, island, sets in zip(batch["host"], batch["island"], batch["sets"], strict=True):
            root: dict[str, str] = {}

            def find(path: str) -> str:
                while root.setdefault(path, path) != path:
                    root[path] = path = root[root[path]]
                return path

            for named in sets:
                for path in named:
                    a, b = sorted((find(named[0]), find(path)))
                    root[b] = a
            out += [(host, island, path, find(path)) for path in list(root)]
        yield pd.DataFrame(out, columns=["host", "island", "path", "part"])


def _settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Executions in order: each takes its latest download that is still unused."""
    group, used = None, set()
    for batch in batches:
        out = []
        for row in batch.itertuples(index=False):
            if (row.host, row.island, row.part) != group:
                group, used = (row.host, row.island, row.part), set()
            free = [
                (dus, dseq, path)
                for dus, dseq, path in zip(row.dus, row.dseq, row.paths)
                if (dseq, path) not in used
            ]
            if free:
                dus, dseq, path = max(free)
                used.add((dseq, path))
                out.append((row.host, path, row.us, row.seq, row.source, row.command, dus, dseq))
        yield pd.DataFrame(out, columns=["host", "path", "us", "seq", "source", "command", "dus", "dseq"])


def download_execute_hits(events: DataFrame, window_us: int = EXECUTE_WINDOW, carried: DataFrame | None = None) -> DataFrame:
    """A downloaded file named by a later command on the host, each download and command used once.

    Commands that can only use one download need no ordering against each
    other: the earliest takes it.  Only commands with several usable downloads,
    and the commands competing with them, are settled in order: by islands, at whose
    borders no such download is both staged and still to be used, and within them by the paths that are named together.
    """
    downloads = _with_carried(staged_downloads(events), carried)
    pairs = latest_before(
        downloads, _named_paths(events, downloads, window_us), ["host", "path"], window_us
    ).select(
        "host",
        "path",
        "us",
        "seq",
        "source",
        "command",
        F.col("opener.us").alias("dus"),
        F.col("opener.seq").alias("dseq"),
    )
    per_command = Window.partitionBy("host", "us", "seq")
    # Real matches only; read several times below.
    counted = checkpointed(pairs.withColumn("options", F.count(F.lit(1)).over(per_command)))
    item = ["host", "path", "dus", "dseq"]
    row = F.struct("us", "seq", "source", "command")
    # A download is gone after its first single-option command, so later commands never get it.
    firsts = (
        counted.where(F.col("options") == 1)
        .groupBy(*item)
        .agg(F.min_by(row, F.struct("us", "seq")).alias("one"))
    )
    single = firsts.select(*item, "one.*")
    result = ["host", "us", "seq", "source", "command", "path", (F.col("us") - F.col("dus")).alias("gap_us"), "dseq"]
    if counted.where(F.col("options") > 1).isEmpty():
        return single.select(*result)
    rivals = (
        counted.where(F.col("options") > 1)
        .join(firsts, item, "left")
        .where(F.col("one").isNull() | (F.struct("us", "seq") < F.struct("one.us", "one.seq")))
        .select(*item, "us", "seq", "source", "command")
    )
    rivals = checkpointed(rivals)
    contested = rivals.select(*item).distinct()
    plain = single.join(contested, item, "left_anti").select(
        "host", "path", "us", "seq", "source", "command", "dus", "dseq"
    )
    disputed = rivals.unionByName(single.join(contested, item, "left_semi"))
    disputed = checkpointed(disputed)
    intervals = disputed.groupBy(*item).agg(F.max("us").alias("until_us"))
    commands = (
        disputed.join(_islands(intervals, window_us).drop("until_us"), item)
        .groupBy("host", "us", "seq")
        .agg(
            F.first("source").alias("source"),
            F.first("command").alias("command"),
            F.first("island").alias("island"),  # all of a command's downloads are open at its time
            F.sort_array(F.collect_list(F.struct("path", "dus", "dseq"))).alias("options"),
        )
    )
    commands = checkpointed(commands)
    # As many rows an island as different sets of paths are named in it.
    sets = commands.select("host", "island", F.col("options.path").alias("named")).distinct()
    parts = (
        sets.groupBy("host", "island")
        .agg(F.collect_list("named").alias("sets"))
        .mapInPandas(_parts, "host string, island long, path string, part string")
    )
    settled = (
        commands.withColumn("path", F.col("options")[0]["path"])
        .join(parts, ["host", "island", "path"])
        .select("host", "island", "part", "us", "seq", "source", "command", *(F.col(f"options.{c}").alias(a) for c, a in (("dus", "dus"), ("dseq", "dseq"), ("path", "paths"))))
        .repartition("host", "island", "part")
        .sortWithinPartitions("host", "island", "part", "us", "seq")
        .mapInPandas(
            _settle,
            "host string, path string, us long, seq long, source string, command string, dus long, dseq long",
        )
    )
    return plain.unionByName(settled).select(*result)
