"""Business labels: channel names, funnel stages, score bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ad platform to acquisition channel, funnel order, band names and cut points, calendar order.
PLATFORM_CHANNEL = {"Google Ads": "Google", "Meta Ads": "Meta"}
PAID_CHANNELS = ("Google", "Meta")
STAGES = ("page_view", "view_item", "add_to_cart", "begin_checkout", "purchase")
STAGE_TITLES = ("Page View", "View Item", "Add to Cart", "Begin Checkout", "Purchase")
BROWSE_STAGES = ("page_view", "view_item")
HIGH, MEDIUM = "0.5", "0.3"
CHURN_BANDS = ("Low Risk", "Medium Risk", "High Risk")
NO_CHURN_BAND = "N/A (not subscriber)"
PROPENSITY_BANDS = ("Low", "Medium", "High")


def channel_clean(platform: Column) -> Column:
    """Acquisition channel of an ad platform; NULL for a platform without one."""
    choice = None
    for name, channel in PLATFORM_CHANNEL.items():
        test = platform == name
        choice = F.when(test, channel) if choice is None else choice.when(test, channel)
    return choice


def position(value: Column, ordered: tuple[str, ...]) -> Column:
    """1-based place of ``value`` in a short fixed list; NULL when absent."""
    return F.nullif(F.array_position(F.array(*[F.lit(v) for v in ordered]), value).cast("int"), F.lit(0))


def stage_order(event_name: Column) -> Column:
    return position(event_name, STAGES)


def _banded(score: Column, names: tuple[str, str, str], high: str, medium: str) -> Column:
    score = score.cast("decimal(5,4)")  # as stored: 0.49996 is 0.5000 and therefore high
    low_name, medium_name, high_name = names
    return (
        F.when(score >= F.lit(high).cast("decimal(5,4)"), high_name)
        .when(score >= F.lit(medium).cast("decimal(5,4)"), medium_name)
        .when(score.isNotNull(), low_name)
    )


def churn_band(score: Column, high: str = HIGH, medium: str = MEDIUM) -> Column:
    """Risk band; NULL without a score."""
    return _banded(score, CHURN_BANDS, high, medium)


def propensity_band(score: Column, suffix: str = "", high: str = HIGH, medium: str = MEDIUM) -> Column:
    """Propensity band; a missing score counts as low."""
    names = tuple(name + suffix for name in PROPENSITY_BANDS)
    return F.coalesce(_banded(score, names, high, medium), F.lit(names[0]))
