"""Column expressions used by the operators; all native, no Python UDF."""

from tagloom.functions.bands import Band, score_bands
from tagloom.functions.recency import as_of_today, epoch_day, recency_days, text_day
from tagloom.functions.rule_text import parse_rule, range_bounds
from tagloom.functions.tags import canonical, merge_tag_lists, merge_tags, to_tag_list, to_tags_id

__all__ = [
    "Band",
    "as_of_today",
    "canonical",
    "epoch_day",
    "merge_tag_lists",
    "merge_tags",
    "parse_rule",
    "range_bounds",
    "recency_days",
    "score_bands",
    "text_day",
    "to_tag_list",
    "to_tags_id",
]
