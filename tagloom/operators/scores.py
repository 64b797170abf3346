"""RFM, RFE and PSM features and scores."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.bands import Band, score_bands
from tagloom.functions.recency import AsOf, epoch_day, recency_days, text_day
from tagloom.operators.profiles import log_profile, order_totals

Bands = Sequence[Band]

# The default score bands.
RFM_RECENCY = (Band(1, lo=16), Band(2, lo=10), Band(3, lo=7), Band(4, lo=4), Band(5, lo=1))
RFM_FREQUENCY = (
    Band(1, lo=1, hi=49),
    Band(2, lo=50, hi=99),
    Band(3, lo=100, hi=149),
    Band(4, lo=150, hi=199),
    Band(5, lo=200),
)
RFM_MONETARY = (
    Band(1, hi=100_000, hi_open=True),
    Band(2, lo=100_000, hi=350_000, hi_open=True),
    Band(3, lo=350_000, hi=500_000, hi_open=True),
    Band(4, lo=500_000, hi=850_000, hi_open=True),
    Band(5, lo=850_000),
)
RFE_RECENCY = (
    Band(5, lo=0, hi=15),
    Band(4, lo=16, hi=30),
    Band(3, lo=31, hi=80),
    Band(2, lo=81, hi=95),
    Band(1, lo=95, lo_open=True),
)
RFE_FREQUENCY = (
    Band(5, lo=560, lo_open=True),
    Band(4, lo=530, hi=560),
    Band(3, lo=400, hi=529),
    Band(2, lo=250, hi=399),
    Band(1, hi=250, hi_open=True),
)
# Exactly 49 pages falls between the last two bands and scores 0.
RFE_ENGAGEMENTS = (
    Band(5, lo=260, lo_open=True),
    Band(4, lo=240, hi=260),
    Band(3, lo=220, hi=239),
    Band(2, lo=50, hi=219),
    Band(1, hi=49, hi_open=True),
)


@dataclass(frozen=True)
class RfmBands:
    recency: Bands = RFM_RECENCY
    frequency: Bands = RFM_FREQUENCY
    monetary: Bands = RFM_MONETARY


@dataclass(frozen=True)
class RfeBands:
    recency: Bands = RFE_RECENCY
    frequency: Bands = RFE_FREQUENCY
    engagements: Bands = RFE_ENGAGEMENTS


RFM_COLUMNS = ("recency", "frequency", "monetary")
RFE_COLUMNS = ("recency", "frequency", "engagements")
PSM_COLUMNS = ("psm",)


def quantile_bands(
    features: DataFrame, columns: dict[str, bool], scores: int = 5, accuracy: int = 100_000
) -> dict[str, Bands]:
    """Bands that deal the users of ``features`` evenly over the scores 1 to ``scores``.

    ``columns`` says for each feature whether more of it is better. Cut points come from a
    quantile sketch, all in one pass; with at most ``accuracy`` users they are exact, beyond
    that off by at most one ``accuracy``-th of the ranks. Users with one value get one score,
    so scores may be missing where values are few; nulls count in no band.
    """
    shares = [i / scores for i in range(1, scores)]
    cuts = features.agg(
        *[F.percentile_approx(F.col(c).cast("double"), shares, accuracy).alias(c) for c in columns]
    ).first()
    bands = {}
    for c, more_is_better in columns.items():
        above = [
            Band(i + 2 if more_is_better else scores - 1 - i, lo=cut, lo_open=True)
            for i, cut in enumerate(cuts[c] or ())
        ]
        bands[c] = (*reversed(above), Band(1 if more_is_better else scores))
    return bands


def add_rfm_features(profile: DataFrame, as_of: AsOf) -> DataFrame:
    return profile.withColumns(
        {
            "recency": recency_days(epoch_day(F.col("last_finish")), as_of),
            "frequency": F.col("orders"),
            "monetary": F.col("amount"),
        }
    )


def add_rfe_features(profile: DataFrame, as_of: AsOf) -> DataFrame:
    return profile.withColumns(
        {
            "recency": recency_days(text_day(F.col("last_log")), as_of),
            "frequency": F.col("views"),
            "engagements": F.col("pages"),
        }
    )


# The names of the four PSM features.
PSM_FEATURES = ("tdon", "ton", "tda", "tra")


def add_psm_features(profile: DataFrame) -> DataFrame:
    return profile.withColumns(
        {
            "tdon": F.col("coupon_orders"),
            "ton": F.col("orders"),
            "tda": F.col("coupon_amount"),
            "tra": F.col("amount"),
        }
    )


def rfm_features(orders: DataFrame, as_of: AsOf, user_id: str = "memberid") -> DataFrame:
    """``(userId, recency, frequency, monetary)`` per member."""
    return add_rfm_features(order_totals(orders, user_id), as_of).select("userId", *RFM_COLUMNS)


def rfe_features(logs: DataFrame, as_of: AsOf, user_id: str = "global_user_id") -> DataFrame:
    """``(userId, recency, frequency, engagements)`` per visitor."""
    return add_rfe_features(log_profile(logs, user_id), as_of).select("userId", *RFE_COLUMNS)


def psm_features(orders: DataFrame, user_id: str = "memberid") -> DataFrame:
    """``(userId, tdon, ton, tda, tra)``: coupon orders, orders, coupon total, amount total."""
    return add_psm_features(order_totals(orders, user_id)).select(
        "userId", *PSM_FEATURES
    )


def rfm_scores(features: DataFrame, bands: RfmBands = RfmBands()) -> DataFrame:
    """Replace the three features by their scores; other columns stay."""
    return features.withColumns(
        {c: score_bands(c, getattr(bands, c)) for c in RFM_COLUMNS}
    )


def rfe_scores(features: DataFrame, bands: RfeBands = RfeBands()) -> DataFrame:
    """Replace the three features by their scores; other columns stay."""
    return features.withColumns(
        {c: score_bands(c, getattr(bands, c)) for c in RFE_COLUMNS}
    )


def add_psm_score(features: DataFrame) -> DataFrame:
    """Add ``psm``, null where any divisor is zero or null."""
    tdon, ton, tda, tra = (F.col(c) for c in PSM_FEATURES)
    coupon_share = F.try_divide(tdon, ton)
    coupon_depth = F.try_divide(F.try_divide(tda, tdon), F.try_divide(tra, ton))
    amount_share = F.try_divide(tda, tra)
    return features.withColumn("psm", coupon_share + coupon_depth + amount_share)


def psm_score(features: DataFrame) -> DataFrame:
    """``(userId, psm)``; users without a score, such as those who never used a coupon, go."""
    return add_psm_score(features).select("userId", "psm").filter(F.col("psm").isNotNull())
