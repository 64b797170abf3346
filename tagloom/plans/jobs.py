"""The tag jobs. Each turns business data and tag values into ``(userId, tagsId)``."""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml.clustering import KMeansModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.recency import AsOf, as_of_today, epoch_day, recency_days
from tagloom.operators.clusters import (
    PREDICT,
    assign_cluster_tags,
    fit_clusters,
    nearest_centre,
)
from tagloom.operators.match import explode_label, label_equal, label_range, no_tags
from tagloom.operators.modal import modal_value_window
from tagloom.operators.profiles import log_profile, order_profile, order_totals
from tagloom.operators.scores import (
    PSM_COLUMNS,
    RFE_COLUMNS,
    RFM_COLUMNS,
    RfeBands,
    RfmBands,
    add_psm_features,
    add_psm_score,
    add_rfe_features,
    add_rfm_features,
    rfe_scores,
    rfm_scores,
)
from tagloom.sources.rules import TagValues
from tagloom.stores.hadoop import scratch_folder, written
from tagloom.stores.models import ModelStore

# Ids of the tag definitions.
GENDER = 4
PROFESSION = 7
AGE = 14
CONSUMPTION_CYCLE = 23
PAYMENT = 29
RFM = 37
RFE = 45
PSM = 50
POLITICAL_AFFILIATION = 61
MARITAL_STATUS = 65

# Days between today and the reference date of each recency, by default.
RFM_OFFSET_DAYS = 1140
CYCLE_OFFSET_DAYS = 1125
RFE_OFFSET_DAYS = 1428

# Cluster counts.
RFM_CLUSTERS = 7
RFE_CLUSTERS = 4
PSM_CLUSTERS = 5

USERS, ORDERS, LOGS = "users", "orders", "logs"


class TagJob(ABC):
    """Extension point: a tag is its definition id and a ``compute``."""

    level4_id: int

    @abstractmethod
    def compute(self, business: DataFrame, values: TagValues) -> DataFrame:
        """New tags, ``(userId, tagsId)``."""


class ProfileJob(TagJob):
    """A tag read off a one-row-per-user profile of its business data.

    Jobs over one source can share the profile, and with it the scan and the shuffle.
    """

    source: str

    @abstractmethod
    def profile(self, business: DataFrame) -> DataFrame:
        """``userId`` and the columns this job needs."""

    @abstractmethod
    def label(self, profile: DataFrame, values: TagValues, out: str) -> DataFrame:
        """Add label ``out``, as in ``explode_label``; keep all other columns and rows."""

    def compute(self, business: DataFrame, values: TagValues) -> DataFrame:
        return explode_label(self.label(self.profile(business), values, "tags"))

    def must_fit(self) -> bool:
        """Whether ``label`` is going to read the whole profile to fit a model."""
        return False


@dataclass(frozen=True)
class AttributeJob(ProfileJob):
    """A user attribute equal to a rule value."""

    level4_id: int
    attribute: str
    user_id: str = "id"
    source: str = USERS

    def profile(self, business: DataFrame) -> DataFrame:
        return user_profile(business, [self.attribute], self.user_id)

    def label(self, profile: DataFrame, values: TagValues, out: str) -> DataFrame:
        return label_equal(profile, F.col(self.attribute), values, out)


@dataclass(frozen=True)
class AgeJob(ProfileJob):
    """Birthday, without dashes, inside a ``yyyyMMdd-yyyyMMdd`` rule; compared as text."""

    level4_id: int = AGE
    attribute: str = "birthday"
    user_id: str = "id"
    source: str = USERS

    def profile(self, business: DataFrame) -> DataFrame:
        return user_profile(business, [self.attribute], self.user_id)

    def label(self, profile: DataFrame, values: TagValues, out: str) -> DataFrame:
        birth = F.replace(F.col(self.attribute).cast("string"), F.lit("-"), F.lit(""))
        return label_range(profile, birth, values, out)


@dataclass(frozen=True)
class ConsumptionCycleJob(ProfileJob):
    """Days since the last finished order inside a ``start-end`` rule."""

    as_of: AsOf | None = None
    level4_id: int = CONSUMPTION_CYCLE
    source: str = ORDERS

    def profile(self, business: DataFrame) -> DataFrame:
        return order_totals(business)

    def label(self, profile: DataFrame, values: TagValues, out: str) -> DataFrame:
        as_of = as_of_today(CYCLE_OFFSET_DAYS) if self.as_of is None else self.as_of
        days = recency_days(epoch_day(F.col("last_finish")), as_of)
        return label_range(profile, days, values, out, numeric=True)


@dataclass(frozen=True)
class PaymentJob(ProfileJob):
    """The most used payment code equal to a rule value."""

    level4_id: int = PAYMENT
    source: str = ORDERS

    def profile(self, business: DataFrame) -> DataFrame:
        by_member = business.select(
            F.col("memberid").cast("string").alias("userId"), F.col("paymentcode").alias("payment")
        )
        return modal_value_window(by_member, "userId", "payment")

    def label(self, profile: DataFrame, values: TagValues, out: str) -> DataFrame:
        return label_equal(profile, F.col("payment"), values, out)


class MiningJob(ProfileJob):
    """Features, scores, k-means, and one tag per cluster in order of value."""

    columns: Sequence[str]
    k: int
    seed: int
    models: ModelStore
    model_name: str

    @abstractmethod
    def score(self, profile: DataFrame) -> DataFrame:
        """Add the columns to cluster on. A row with a null in one is dropped by the job."""

    def must_fit(self) -> bool:
        return not self.models.exists(self.model_name)

    def compute(self, business: DataFrame, values: TagValues) -> DataFrame:
        profile = self.profile(business)
        if self.must_fit():
            # Read twice, for the fit and for the labels.
            profile = written(profile, scratch_folder(profile.sparkSession))
        return explode_label(self.label(profile, values, "tags"))

    def _scored(self) -> Column:
        return reduce(Column.__and__, [F.col(c).isNotNull() for c in self.columns])

    def model(self, profile: DataFrame) -> KMeansModel:
        def fit() -> KMeansModel:
            scored = self.score(profile).filter(self._scored())
            return fit_clusters(scored, self.columns, self.k, self.seed)

        return self.models.fit_or_load(self.model_name, fit)

    def label(self, profile: DataFrame, values: TagValues, out: str) -> DataFrame:
        centres = self.model(profile).clusterCenters()
        placed = nearest_centre(self.score(profile), self.columns, centres)
        tagged = assign_cluster_tags(placed, centres, values, "__tag")
        label = F.when(self._scored(), F.array("__tag")).otherwise(no_tags())
        return tagged.select(*profile.columns, label.alias(out))


@dataclass(frozen=True)
class RfmJob(MiningJob):
    """Recency, frequency and monetary value of orders."""

    models: ModelStore
    as_of: AsOf | None = None
    bands: RfmBands = field(default_factory=RfmBands)
    k: int = RFM_CLUSTERS
    seed: int = 1
    model_name: str = "rfm"
    level4_id: int = RFM
    source: str = ORDERS
    columns: Sequence[str] = RFM_COLUMNS

    def profile(self, business: DataFrame) -> DataFrame:
        return order_totals(business)

    def score(self, profile: DataFrame) -> DataFrame:
        as_of = as_of_today(RFM_OFFSET_DAYS) if self.as_of is None else self.as_of
        return rfm_scores(add_rfm_features(profile, as_of), self.bands)


@dataclass(frozen=True)
class RfeJob(MiningJob):
    """Recency, frequency and engagement of page views."""

    models: ModelStore
    as_of: AsOf | None = None
    bands: RfeBands = field(default_factory=RfeBands)
    k: int = RFE_CLUSTERS
    seed: int = 1
    model_name: str = "rfe"
    level4_id: int = RFE
    source: str = LOGS
    columns: Sequence[str] = RFE_COLUMNS

    def profile(self, business: DataFrame) -> DataFrame:
        return log_profile(business)

    def score(self, profile: DataFrame) -> DataFrame:
        as_of = as_of_today(RFE_OFFSET_DAYS) if self.as_of is None else self.as_of
        return rfe_scores(add_rfe_features(profile, as_of), self.bands)


@dataclass(frozen=True)
class PsmJob(MiningJob):
    """Price sensitivity from coupon use; members without a score get no tag."""

    models: ModelStore
    k: int = PSM_CLUSTERS
    seed: int = 1
    model_name: str = "psm"
    level4_id: int = PSM
    source: str = ORDERS
    columns: Sequence[str] = PSM_COLUMNS

    def profile(self, business: DataFrame) -> DataFrame:
        return order_totals(business)

    def score(self, profile: DataFrame) -> DataFrame:
        return add_psm_score(add_psm_features(profile))


def user_profile(users: DataFrame, attributes: Sequence[str], user_id: str = "id") -> DataFrame:
    names = list(dict.fromkeys(attributes))
    return users.select(F.col(user_id).cast("string").alias("userId"), *names)


def shares_profile(job: TagJob) -> bool:
    """Whether the job reads one of the standard profiles, which ``shared_profile`` unites.
    A job with a profile of its own is computed by itself."""
    standard = (AttributeJob, AgeJob, ConsumptionCycleJob, PaymentJob, RfmJob, RfeJob, PsmJob)
    return getattr(type(job), "profile", None) in {kind.profile for kind in standard}


def shared_profile(jobs: Sequence[ProfileJob], business: DataFrame) -> DataFrame:
    """One profile that serves all of ``jobs``, which have one source."""
    if len(jobs) == 1:
        return jobs[0].profile(business)
    source = jobs[0].source
    if source == USERS:
        return user_profile(business, [job.attribute for job in jobs], jobs[0].user_id)
    if source == LOGS:
        return log_profile(business)
    if any(isinstance(job, PaymentJob) for job in jobs):
        return order_profile(business)
    return order_totals(business)


def match_jobs() -> list[ProfileJob]:
    return [
        AttributeJob(GENDER, "gender"),
        AttributeJob(PROFESSION, "job"),
        AgeJob(),
        AttributeJob(POLITICAL_AFFILIATION, "politicalface"),
        AttributeJob(MARITAL_STATUS, "marriage"),
    ]


def statistics_jobs(as_of: AsOf | None = None) -> list[ProfileJob]:
    return [ConsumptionCycleJob(as_of), PaymentJob()]


def mining_jobs(
    models: ModelStore, orders_as_of: AsOf | None = None, logs_as_of: AsOf | None = None
) -> list[ProfileJob]:
    return [RfmJob(models, orders_as_of), RfeJob(models, logs_as_of), PsmJob(models)]
