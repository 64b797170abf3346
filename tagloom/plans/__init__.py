"""Tag jobs and their runs."""

from tagloom.plans.jobs import TagJob, match_jobs, mining_jobs, statistics_jobs
from tagloom.plans.run import compute_all, compute_job, run_all, run_job, tag_counts

__all__ = [
    "TagJob",
    "compute_all",
    "compute_job",
    "match_jobs",
    "mining_jobs",
    "run_all",
    "run_job",
    "statistics_jobs",
    "tag_counts",
]
