"""Test queries: each takes ``(spark, sf_dir)`` and returns a frame over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.bands import Band
from tagloom.functions.recency import as_of_today
from tagloom.functions.rule_text import parse_rule, range_bounds
from tagloom.functions.tags import merge_tags
from tagloom.operators import clusters, match, merge, modal, profiles, scores
from tagloom.plans.jobs import (
    GENDER,
    AgeJob,
    AttributeJob,
    PsmJob,
    RfeJob,
    RfmJob,
    TagJob,
    match_jobs,
    mining_jobs,
    statistics_jobs,
)
from tagloom.plans.run import compute_job, run_all, run_job, tag_counts
from tagloom.queries import standins
from tagloom.queries.standins import EVENTS_AS_OF, ORDERS_AS_OF, RULES
from tagloom.sources.rules import RuleBook, TagValues, local_frame, read_rules
from tagloom.sources.spec import SourceSpec, read_source
from tagloom.stores.hadoop import scratch_folder
from tagloom.stores.models import ModelStore
from tagloom.stores.persona import SnapshotPersonaStore
from tagloom.stores.profiles import LogProfileStore, OrderProfileStore

Query = Callable[[SparkSession, str], DataFrame]

# Quintiles of the sf0.01 orders, highest recency threshold first.
QUINTILE_BANDS = scores.RfmBands(
    recency=(Band(1, lo=220), Band(2, lo=122), Band(3, lo=53), Band(4, lo=14), Band(5, lo=1)),
    frequency=(Band(5, lo=14), Band(4, lo=11), Band(3, lo=9), Band(2, lo=7), Band(1, lo=1)),
    monetary=(
        Band(5, lo=3254294),
        Band(4, lo=2673204),
        Band(3, lo=2230460),
        Band(2, lo=1709416),
        Band(1, lo=0),
    ),
)
# Centres in (recency, frequency, monetary) score space.
FIXED_CENTRES = ((1.0, 1.0, 1.0), (4.0, 4.0, 4.0), (2.0, 3.0, 2.0), (4.0, 2.0, 3.0), (5.0, 1.0, 1.0))


def rule_book(spark: SparkSession) -> RuleBook:
    import pyarrow as pa

    columns = ("id", pa.int32()), ("pid", pa.int32()), ("rule", pa.string())
    return RuleBook(local_frame(spark, RULES, *columns))


def values(spark: SparkSession, level4_id: int) -> TagValues:
    return TagValues.local(spark, [(id_, rule) for id_, pid, rule in RULES if pid == level4_id])


def standin_reader(sf_dir: str):
    """Read business data by the name in its definition, from the test tables."""

    def read(spark: SparkSession, spec: SourceSpec) -> DataFrame:
        wanted = spec.columns
        if spec.index == "users":
            with_birthday = "birthday" in wanted
            frame = (standins.users if with_birthday else standins.customers)(spark, sf_dir)
        elif spec.index == "orders":
            frame = standins.orders(spark, sf_dir, coupons="couponcodevalue" in wanted)
        else:
            frame = standins.logs(spark, sf_dir)
        return frame.select(*wanted)

    return read


# Sources and rules.


def source_scan_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = (
        f"inType=parquet##esNodes={sf_dir}##esIndex=customer.parquet"
        "##selectFields=c_custkey, c_mktsegment"
    )
    rules = spark.createDataFrame([(7, 2, rule)], "id int, pid int, rule string")
    return read_source(spark, SourceSpec.from_map(RuleBook(rules).rule_for(7)))


def rule_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = F.concat(
        F.lit("inType=parquet##esNodes="),
        "p_brand",
        F.lit("##esIndex="),
        "p_name",
        F.lit("##selectFields="),
        "p_type",
        F.lit("="),
        F.col("p_size").cast("string"),
        F.lit("##esNodes="),
        "p_type",
    )
    part = standins.table(spark, sf_dir, "part")
    return part.select("p_partkey", F.explode(parse_rule(rule)).alias("rule_key", "rule_value"))


def rule_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("string")
    rule = F.when(F.col("p_size") > 40, size).otherwise(
        F.concat(size, F.lit("-"), F.floor("p_retailprice").cast("string"))
    )
    start, end = range_bounds(rule)
    low, high = range_bounds(rule, numeric=True)
    return standins.table(spark, sf_dir, "part").select(
        "p_partkey",
        start.alias("range_start"),
        end.alias("range_end"),
        low.alias("range_low"),
        high.alias("range_high"),
    )


def part_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule table as large as ``part``: one value per part under its brand number."""
    return standins.table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("id"),
        F.substring("p_brand", 7, 10).cast("int").alias("pid"),
        F.col("p_name").alias("rule"),
    )


def rule_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RuleBook(part_rules(spark, sf_dir)).values_for(7).frame.select("id", "rule")


def rules_from_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values of one tag from a rule table that lies in a file of another format."""
    path = f"{scratch_folder(spark)}/rules"
    part_rules(spark, sf_dir).write.json(path)
    return RuleBook(read_rules(spark, "json", path)).values_for(7).frame.select("id", "rule")


# Matching.


def match_equal_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = standins.customers(spark, sf_dir)
    return match.match_equal(people, F.col("job"), values(spark, 7))


def match_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = standins.customers(spark, sf_dir)
    return match.match_equal(people, F.col("politicalface"), values(spark, 61), how="inner")


def match_equal_many_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rule per customer, treated as a rule table of unproven size."""
    customer = standins.table(spark, sf_dir, "customer")
    rules = customer.select(F.col("c_custkey").cast("int").alias("id"), F.col("c_name").alias("rule"))
    name = F.format_string("Customer#%09d", F.col("o_custkey") + 10)
    buyers = standins.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), name.alias("name")
    )
    return match.match_equal(buyers, F.col("name"), TagValues(rules, None))


def match_range_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    birth = F.replace(F.col("birthday"), F.lit("-"), F.lit(""))
    return match.match_range(standins.users(spark, sf_dir), birth, values(spark, 14))


def match_range_many_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One numeric range per supplier, treated as a rule table of unproven size."""
    low = F.floor(F.abs("s_acctbal"))
    rules = standins.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("int").alias("id"),
        F.concat(low.cast("string"), F.lit("-"), (low + 50).cast("string")).alias("rule"),
    )
    customer = standins.table(spark, sf_dir, "customer")
    return match.match_range(
        customer, F.floor("c_acctbal"), TagValues(rules, None), "c_custkey", numeric=True
    )


def match_range_many_text_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text range per supplier over customer names, treated as of unproven size."""
    number = F.col("s_suppkey").cast("bigint") * 12
    rules = standins.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("int").alias("id"),
        F.concat(
            F.format_string("Customer#%09d", number),
            F.lit("-"),
            F.format_string("Customer#%09d", number + 14),
        ).alias("rule"),
    )
    customer = standins.table(spark, sf_dir, "customer")
    return match.match_range(customer, F.col("c_name"), TagValues(rules, None), "c_custkey")


def match_range_outlying_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranges of ``match_range_many_text_rules``, with one around all the others."""
    number = F.col("s_suppkey").cast("bigint") * 12
    name = "Customer#%09d"
    rules = standins.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("int").alias("id"),
        F.when(F.col("s_suppkey") == 1, F.lit("A-Z"))
        .otherwise(F.concat(F.format_string(name, number), F.lit("-"), F.format_string(name, number + 14)))
        .alias("rule"),
    )
    customer = standins.table(spark, sf_dir, "customer")
    return match.match_range(customer, F.col("c_name"), TagValues(rules, None), "c_custkey")


# Tag lists.


def tags_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = F.col("politicalface")
    old = (
        F.when(nation < 5, F.lit(None))
        .when(nation < 10, F.lit("9,9"))
        .otherwise(F.concat(nation.cast("string"), F.lit(",10,2")))
    )
    people = standins.customers(spark, sf_dir)
    new = match.label_equal(people, F.col("job"), values(spark, 7), "new")
    return new.select(
        F.col("id").cast("string").alias("userId"), merge_tags(F.get("new", F.lit(0)), old).alias("tagsId")
    )


def stored_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored persona: the customers with a non-negative balance."""
    return standins.table(spark, sf_dir, "customer").filter("c_acctbal >= 0").select(
        F.col("c_custkey").cast("string").alias("userId"),
        F.concat(F.col("c_nationkey").cast("string"), F.lit(",100,20")).alias("tagsId"),
    )


def new_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New tags: several rows per customer who ordered, and none for the others."""
    return standins.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("userId"),
        F.substring("o_orderpriority", 1, 1).alias("tagsId"),
    )


def merge_new_with_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_with_store(new_tags(spark, sf_dir), stored_tags(spark, sf_dir))


def new_store(spark: SparkSession) -> SnapshotPersonaStore:
    return SnapshotPersonaStore(spark, f"{scratch_folder(spark)}/persona")


def persona_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replace the tags of the batch's users, keep the others."""
    store = new_store(spark)
    store.upsert(stored_tags(spark, sf_dir))
    store.upsert(new_tags(spark, sf_dir))
    return store.read_tags_id()


def persona_merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unite the tags of the batch's users with the stored ones, keep the others."""
    store = new_store(spark)
    store.upsert(stored_tags(spark, sf_dir))
    store.merge_upsert(new_tags(spark, sf_dir))
    return store.read_tags_id()


def persona_merge_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``merge_new_with_store`` against a store, of which only the batch's buckets are read."""
    store = new_store(spark)
    store.upsert(stored_tags(spark, sf_dir))
    return store.merged(new_tags(spark, sf_dir))


def persona_two_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store of more buckets than there are tasks, a small update of few buckets, and a
    large one of all."""
    store = SnapshotPersonaStore(spark, f"{scratch_folder(spark)}/persona", buckets=32)
    store.upsert(stored_tags(spark, sf_dir))
    urgent = standins.table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("userId"), F.lit("300").alias("tagsId")
    )
    store.merge_upsert(urgent)
    store.merge_upsert(new_tags(spark, sf_dir))
    return store.read_tags_id()


# Statistics.


def consumption_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = statistics_jobs(ORDERS_AS_OF)[0]
    return job.compute(standins.orders(spark, sf_dir, coupons=False), values(spark, 23))


def payway_modal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modal.modal_value(
        standins.orders(spark, sf_dir, coupons=False), "memberid", "paymentcode"
    )


def payway_modal_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modal.modal_value_window(
        standins.orders(spark, sf_dir, coupons=False), "memberid", "paymentcode"
    )


def payway_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = statistics_jobs()[1]
    return job.compute(standins.orders(spark, sf_dir, coupons=False), values(spark, 29))


def order_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.order_profile(standins.orders(spark, sf_dir)).select(
        "userId",
        "payment",
        "last_finish",
        "orders",
        F.round("amount", 2).alias("amount"),
        "coupon_orders",
        F.round("coupon_amount", 4).alias("coupon_amount"),
    )


def order_profile_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``order_profile`` of orders that come in two batches, by time."""
    store = OrderProfileStore(spark, f"{scratch_folder(spark)}/orders")
    orders = standins.orders(spark, sf_dir)
    early = F.col("finishtime") < 883612800  # 1998 began
    store.add(orders.filter(early))
    store.add(orders.filter(~early | F.col("finishtime").isNull()))
    return store.profile().select(
        "userId",
        "payment",
        "last_finish",
        "orders",
        F.round("amount", 2).alias("amount"),
        "coupon_orders",
        F.round("coupon_amount", 4).alias("coupon_amount"),
    )


# Features, scores and clusters.


def rfm_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = scores.rfm_features(standins.orders(spark, sf_dir, coupons=False), ORDERS_AS_OF)
    return features.withColumn("monetary", F.round("monetary", 2))


def rfm_features_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seen from a week ago, as a job without a date of its own would."""
    features = scores.rfm_features(standins.orders(spark, sf_dir, coupons=False), as_of_today(7))
    return features.withColumn("monetary", F.round("monetary", 2))


def rfm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores.rfm_scores(rfm_features(spark, sf_dir))


def rfm_scores_quintile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores.rfm_scores(rfm_features(spark, sf_dir), QUINTILE_BANDS)


def rfe_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores.rfe_features(standins.logs(spark, sf_dir), EVENTS_AS_OF)


def rfe_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores.rfe_scores(rfe_features(spark, sf_dir))


def rfe_scores_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bands from the visitors themselves, so that each score occurs. Each user's events are
    those of six visitors, since a user is on the site nearly every day."""
    features = scores.rfe_features(standins.logs(spark, sf_dir, visitors=6), EVENTS_AS_OF)
    better = {"recency": False, "frequency": True, "engagements": True}
    return scores.rfe_scores(features, scores.RfeBands(**scores.quantile_bands(features, better)))


def rfe_features_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimated distinct pages, from logs added to a store in two batches, beside the exact
    ones: whether they are within a tenth and one page."""
    store = LogProfileStore(spark, f"{scratch_folder(spark)}/logs")
    logs = standins.logs(spark, sf_dir)
    odd = F.crc32("log_time") % 2 == 1
    store.add(logs.filter(odd))
    store.add(logs.filter(~odd))
    estimated = scores.add_rfe_features(store.profile(), EVENTS_AS_OF)
    exact = rfe_features(spark, sf_dir).select("userId", F.col("engagements").alias("exact"))
    near = F.abs(F.col("engagements") - F.col("exact")) <= F.col("exact") / 10 + 1
    return estimated.join(exact, "userId").select("userId", "recency", "frequency", near.alias("near"))


def psm_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores.psm_features(standins.orders(spark, sf_dir)).select(
        "userId", "tdon", "ton", F.round("tda", 4).alias("tda"), F.round("tra", 2).alias("tra")
    )


def psm_orders_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders where cheap ones carry no coupon and low-priority ones no amount."""
    coupon = F.when(F.col("orderamount") > 250_000, F.col("couponcodevalue")).otherwise(0.0)
    amount = F.when(F.col("paymentcode") == "5-LOW", 0.0).otherwise(F.col("orderamount"))
    return standins.orders(spark, sf_dir).withColumns(
        {"couponcodevalue": coupon, "orderamount": amount}
    )


def psm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = scores.psm_features(psm_orders_with_gaps(spark, sf_dir))
    return scores.psm_score(features).withColumn("psm", F.round("psm", 6))


def nearest_centre_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = rfm_scores_quintile(spark, sf_dir)
    return clusters.nearest_centre(scored, scores.RFM_COLUMNS, FIXED_CENTRES, "cluster").select(
        "userId", "cluster"
    )


def cluster_tag_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags of ranked clusters. Four tags for five clusters leave the lowest one null."""
    placed = nearest_centre_fixed(spark, sf_dir).withColumnRenamed("cluster", clusters.PREDICT)
    tagged = clusters.assign_cluster_tags(placed, FIXED_CENTRES, values(spark, 45))
    return tagged.select("userId", "tagsId")


def _mined(position: int) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        models = ModelStore(spark, f"{scratch_folder(spark)}/models")
        job = mining_jobs(models, ORDERS_AS_OF, EVENTS_AS_OF)[position]
        return compute_job(spark, job, rule_book(spark), standin_reader(sf_dir))

    return query


class _Planted:
    """A mining job whose scores are moved apart by user number, so that the groups that
    k-means should find, and their order, are known. Each keeps its natural spread."""

    def score(self, profile: DataFrame) -> DataFrame:
        moved = self.columns[-1]
        group = F.pmod(F.col("userId").cast("bigint"), F.lit(self.k))
        return super().score(profile).withColumn(moved, F.col(moved) + 1000 * group)


class PlantedRfm(_Planted, RfmJob):
    pass


class PlantedRfe(_Planted, RfeJob):
    pass


class PlantedPsm(_Planted, PsmJob):
    pass


def _planted(kind: type, business: Query, *as_of: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        job = kind(ModelStore(spark, f"{scratch_folder(spark)}/models"), *as_of)
        rows = business(spark, sf_dir)
        job.model(job.profile(rows))  # fitted and saved, and loaded by what follows
        return job.compute(rows, values(spark, job.level4_id))

    return query


# Jobs and runs.


def _job(level4_id: int) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        job = next(j for j in match_jobs() if j.level4_id == level4_id)
        return compute_job(spark, job, rule_book(spark), standin_reader(sf_dir))

    return query


def persona_job_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three jobs, run one after the other into one store."""
    store = new_store(spark)
    for job in (AttributeJob(4, "gender"), AgeJob(), AttributeJob(7, "job")):
        run_job(spark, job, rule_book(spark), store, standin_reader(sf_dir))
    return store.read_tags_id()


def persona_all_match_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All match and statistics jobs in one run, merged into a store that has tags already."""
    store = new_store(spark)
    store.upsert(stored_tags(spark, sf_dir))
    jobs = match_jobs() + statistics_jobs(ORDERS_AS_OF)
    run_all(spark, jobs, rule_book(spark), store, standin_reader(sf_dir))
    return store.read_tags_id()


def persona_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every job in one run."""
    store = new_store(spark)
    models = ModelStore(spark, f"{scratch_folder(spark)}/models")
    jobs = match_jobs() + statistics_jobs(ORDERS_AS_OF)
    jobs += mining_jobs(models, ORDERS_AS_OF, EVENTS_AS_OF)
    run_all(spark, jobs, rule_book(spark), store, standin_reader(sf_dir))
    return store.read_tags_id()


class DividesJob(TagJob):
    """A job of a user's own: a tag for the users whose number a divisor divides."""

    level4_id = GENDER

    def __init__(self, divisor: int):
        self.divisor = divisor

    def compute(self, business: DataFrame, values: TagValues) -> DataFrame:
        return business.filter(F.col("id") % self.divisor == 0).select(
            F.col("id").alias("userId"), F.lit(str(200 + self.divisor)).alias("tagsId")
        )


def persona_own_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight jobs of a user's own in one run, into a stored persona."""
    store = new_store(spark)
    store.upsert(stored_tags(spark, sf_dir))
    jobs = [DividesJob(divisor) for divisor in range(2, 10)]
    run_all(spark, jobs, rule_book(spark), store, standin_reader(sf_dir))
    return store.read_tags_id()


def persona_tag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = new_store(spark)
    jobs = match_jobs() + statistics_jobs(ORDERS_AS_OF)
    run_all(spark, jobs, rule_book(spark), store, standin_reader(sf_dir))
    return tag_counts(store.read())


QUERIES: dict[str, Query] = {
    "source_scan_by_rule": source_scan_by_rule,
    "rule_parse": rule_parse,
    "rule_ranges": rule_ranges,
    "rule_values": rule_values,
    "rules_from_file": rules_from_file,
    "match_equal_segment": match_equal_segment,
    "match_inner": match_inner,
    "match_equal_many_rules": match_equal_many_rules,
    "match_range_string": match_range_string,
    "match_range_many_rules": match_range_many_rules,
    "match_range_many_text_rules": match_range_many_text_rules,
    "match_range_outlying_rule": match_range_outlying_rule,
    "tags_merge": tags_merge,
    "merge_new_with_store": merge_new_with_store,
    "persona_upsert": persona_upsert,
    "persona_merge_upsert": persona_merge_upsert,
    "persona_merge_read": persona_merge_read,
    "persona_two_updates": persona_two_updates,
    "persona_own_jobs": persona_own_jobs,
    "consumption_cycle": consumption_cycle,
    "payway_modal": payway_modal,
    "payway_modal_window": payway_modal_window,
    "payway_tags": payway_tags,
    "order_profile": order_profile,
    "order_profile_incremental": order_profile_incremental,
    "rfm_features": rfm_features,
    "rfm_features_today": rfm_features_today,
    "rfm_scores": rfm_scores,
    "rfm_scores_quintile": rfm_scores_quintile,
    "rfe_features": rfe_features,
    "rfe_features_approx": rfe_features_approx,
    "rfe_scores": rfe_scores,
    "rfe_scores_quantile": rfe_scores_quantile,
    "psm_features": psm_features,
    "psm_score": psm_score,
    "nearest_centre_fixed": nearest_centre_fixed,
    "cluster_tag_rank": cluster_tag_rank,
    "rfm_cluster_tags": _mined(0),
    "rfe_cluster_tags": _mined(1),
    "psm_cluster_tags": _mined(2),
    "rfm_planted_groups": _planted(PlantedRfm, standins.orders, ORDERS_AS_OF),
    "rfe_planted_groups": _planted(PlantedRfe, standins.logs, EVENTS_AS_OF),
    "psm_planted_groups": _planted(PlantedPsm, psm_orders_with_gaps),
    "gender_tags": _job(4),
    "profession_tags": _job(7),
    "age_tags": _job(14),
    "political_affiliation_tags": _job(61),
    "marital_status_tags": _job(65),
    "persona_job_run": persona_job_run,
    "persona_all_match_stat": persona_all_match_stat,
    "persona_all": persona_all,
    "persona_tag_counts": persona_tag_counts,
}
