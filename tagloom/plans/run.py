"""Running tag jobs against a rule table and a persona store."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.tags import canonical, without_nulls
from tagloom.operators.match import no_tags
from tagloom.operators.merge import as_tag_lists, one_row_per_user, unite_batches
from tagloom.plans.jobs import LOGS, ORDERS, ProfileJob, TagJob, shared_profile, shares_profile
from tagloom.sources.rules import RuleBook
from tagloom.sources.spec import SourceSpec, read_source
from tagloom.stores.hadoop import scratch_folder, scratch_scope, written

# Sources whose profile has one row per user by construction.
AGGREGATED = (ORDERS, LOGS)

Reader = Callable[[SparkSession, SourceSpec], DataFrame]


def _checked(job: TagJob, new: object) -> DataFrame:
    if not isinstance(new, DataFrame):
        raise TypeError(f"job of tag {job.level4_id} returned {type(new).__name__}, not a frame")
    return new.select(F.col("userId").cast("string"), F.col("tagsId").cast("string"))


def compute_job(
    spark: SparkSession, job: TagJob, rules: RuleBook, read: Reader = read_source
) -> DataFrame:
    """New tags of one job: find its definition, read the data it names, match."""
    spec = SourceSpec.from_map(rules.rule_for(job.level4_id))
    values = rules.values_for(job.level4_id)
    return _checked(job, job.compute(read(spark, spec), values))


def run_job(
    spark: SparkSession, job: TagJob, rules: RuleBook, store, read: Reader = read_source
) -> None:
    """Compute one job's tags, merge them with the stored ones, and upsert."""
    with scratch_scope(spark):
        store.merge_upsert(compute_job(spark, job, rules, read))


def run_all(
    spark: SparkSession,
    jobs: Sequence[TagJob],
    rules: RuleBook,
    store,
    read: Reader = read_source,
) -> None:
    """Run many jobs with one merge and one upsert.

    Jobs that read one data set share a single scan and, for orders and logs, a single
    per-user aggregate. The stored result equals that of ``run_job`` for each in turn.
    """
    with scratch_scope(spark):
        store.merge_upsert_lists(compute_all(spark, jobs, rules, read))


def compute_all(
    spark: SparkSession,
    jobs: Sequence[TagJob],
    rules: RuleBook,
    read: Reader = read_source,
    scratch: str | None = None,
) -> DataFrame:
    """New tags of all jobs, ``(userId, tags)`` with one row per user.

    A profile that a model is to be fitted on is written to ``scratch`` first, and the
    result reads it from there.

    Aggregated profiles leave their rows hash-partitioned by user, and a union of equally
    partitioned frames keeps that, so the final reduction moves no data again.
    """
    batches = []
    for group in _groups(jobs, rules):
        if isinstance(group, TagJob):
            new = compute_job(spark, group, rules, read)
            batches.append(one_row_per_user(as_tag_lists(new)))
        else:
            spec, members = group
            batch = _compute_group(members, rules, read(spark, spec), scratch)
            aggregated = members[0].source in AGGREGATED
            batches.append(batch if aggregated else one_row_per_user(batch))
    if not batches:
        raise ValueError("no jobs to run")
    return batches[0] if len(batches) == 1 else unite_batches(*batches)


def _groups(jobs: Sequence[TagJob], rules: RuleBook) -> list:
    """Single jobs, and ``(spec, jobs)`` for profile jobs over one data set."""
    groups: list = []
    shared: dict = defaultdict(list)
    definitions = rules.rules_for([job.level4_id for job in jobs])
    for job in jobs:
        if not shares_profile(job):
            groups.append(job)
            continue
        spec = SourceSpec.from_map(definitions[job.level4_id])
        where = (job.source, getattr(job, "user_id", None), replace(spec, fields=None))
        shared[where].append((spec, job))
    for (_, _, where), members in shared.items():
        all_named = all(spec.columns for spec, _ in members)
        fields = dict.fromkeys(c for spec, _ in members for c in spec.columns)
        spec = replace(where, fields=",".join(fields) if all_named else None)
        groups.append((spec, [job for _, job in members]))
    return groups


def _compute_group(
    jobs: list[ProfileJob], rules: RuleBook, business: DataFrame, scratch: str | None
) -> DataFrame:
    profile = shared_profile(jobs, business)
    if any(job.must_fit() for job in jobs):
        profile = written(profile, scratch or scratch_folder(profile.sparkSession))
    labels = [f"__label_{i}" for i in range(len(jobs))]
    labelled = profile
    for job, label in zip(jobs, labels):
        labelled = job.label(labelled, rules.values_for(job.level4_id), label)
    every = F.concat(*labels)
    tags = canonical(without_nulls(every))
    return labelled.filter(F.size(every) > 0).select(
        "userId", F.nullif(tags, no_tags()).alias("tags")
    )


def tag_counts(persona: DataFrame) -> DataFrame:
    """Run report: stored users per tag, from ``(userId, tags)``."""
    return (
        persona.select(F.explode("tags").alias("tagsId"))
        .groupBy("tagsId")
        .agg(F.count(F.lit(1)).alias("users"))
    )
