"""The rule set: a registry of detectors, and the union of all their alerts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import chains, stateless
from ..operators import thresholds as th
from ..operators.enrich import enrich_geo
from ..schema import ACCEPTED_LOGIN
from ..sources.checkpoint import checkpointed
from . import alerts as fmt


@dataclass
class DetectionContext:
    """Events, reference data and parameters; shared intermediate hits are built once.

    Events may be enriched already.  If ``geo_ranges`` is given instead, only
    the logins are enriched, as no other detector reads a geo column.
    """

    events: DataFrame
    geo_ranges: DataFrame | None = None
    watchlist: DataFrame | None = None
    rules: list[tuple] | None = None
    link_col: str = "source"
    failed_login: th.FailedLoginParams = field(default_factory=th.FailedLoginParams)
    spray: th.SprayParams = field(default_factory=th.SprayParams)
    rapid: th.RapidParams = field(default_factory=th.RapidParams)
    evasion_window_us: int = chains.EVASION_WINDOW
    execute_window_us: int = chains.EXECUTE_WINDOW
    account_window_us: int = chains.NEW_ACCOUNT_WINDOW
    escalation_window_us: int = chains.ESCALATION_WINDOW
    # Set when several detectors read the same hits, which are then computed once.
    share: bool = False

    @cached_property
    def brute_force(self) -> DataFrame:
        hits = th.failed_login_hits(self.events, self.failed_login)
        return checkpointed(hits) if self.share else hits

    @cached_property
    def new_countries(self) -> DataFrame:
        logins = self.events
        if self.geo_ranges is not None:
            logins = enrich_geo(logins.where(F.col("event_type") == ACCEPTED_LOGIN), self.geo_ranges)
        hits = th.new_country_hits(logins)
        return checkpointed(hits) if self.share else hits


Detector = Callable[[DetectionContext], DataFrame]

DETECTORS: dict[str, Detector] = {}
# Detectors that read the hits of another one, and read them more than once.
CHAINED = {"brute_force_evasion", "login_escalation"}


def register_detector(name: str) -> Callable[[Detector], Detector]:
    """Add a detector (context -> alerts) to the rule set under a name."""

    def add(fn: Detector) -> Detector:
        DETECTORS[name] = fn
        return fn

    return add


@register_detector("rules_stateless")
def _patterns(ctx: DetectionContext) -> DataFrame:
    return fmt.pattern_alerts(stateless.pattern_hits(ctx.events, ctx.rules))


@register_detector("failed_logins")
def _failed(ctx: DetectionContext) -> DataFrame:
    return fmt.failed_login_alerts(ctx.brute_force)


@register_detector("new_country_login")
def _country(ctx: DetectionContext) -> DataFrame:
    return fmt.new_country_alerts(ctx.new_countries)


@register_detector("rapid_process")
def _rapid(ctx: DetectionContext) -> DataFrame:
    return fmt.rapid_process_alerts(th.rapid_process_hits(ctx.events, ctx.rapid))


@register_detector("ip_watchlist")
def _watchlist(ctx: DetectionContext) -> DataFrame:
    watchlist = ctx.watchlist
    if watchlist is None:
        watchlist = ctx.events.sparkSession.createDataFrame([], "ip string")
    return fmt.watchlist_alerts(stateless.watchlist_hits(ctx.events, watchlist))


@register_detector("password_spray")
def _spray(ctx: DetectionContext) -> DataFrame:
    return fmt.spray_alerts(th.spray_hits(ctx.events, ctx.spray))


@register_detector("brute_force_evasion")
def _evasion(ctx: DetectionContext) -> DataFrame:
    hits = chains.brute_force_evasion_hits(ctx.events, ctx.brute_force, ctx.evasion_window_us)
    return fmt.brute_force_evasion_alerts(hits)


@register_detector("download_execute")
def _download(ctx: DetectionContext) -> DataFrame:
    return fmt.download_execute_alerts(chains.download_execute_hits(ctx.events, ctx.execute_window_us))


@register_detector("new_account_use")
def _account(ctx: DetectionContext) -> DataFrame:
    return fmt.new_account_alerts(chains.new_account_hits(ctx.events, ctx.account_window_us))


@register_detector("login_escalation")
def _escalation(ctx: DetectionContext) -> DataFrame:
    hits = chains.login_escalation_hits(ctx.events, ctx.new_countries, ctx.link_col, ctx.escalation_window_us)
    return fmt.login_escalation_alerts(hits)


def detect(ctx: DetectionContext, names: list[str] | None = None) -> DataFrame:
    """Alerts of the named detectors, or of all of them, as one bag."""
    chosen = DETECTORS if names is None else {n: DETECTORS[n] for n in names}
    ctx.share = ctx.share or len(chosen) > 1 or not CHAINED.isdisjoint(chosen)
    return reduce(DataFrame.unionByName, [fn(ctx) for fn in chosen.values()])


def in_evaluation_order(alerts: DataFrame) -> DataFrame:
    """Alerts as a sequential evaluation would list them: by event, then by rule."""
    return alerts.orderBy("ts", "seq", "rule_order")
