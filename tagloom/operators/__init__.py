"""DataFrame operators."""

from tagloom.operators.clusters import (
    assign_cluster_tags,
    assign_clusters,
    fit_clusters,
    nearest_centre,
    rank_clusters,
)
from tagloom.operators.match import match_equal, match_range
from tagloom.operators.merge import merge_with_store, one_row_per_user
from tagloom.operators.modal import modal_value, modal_value_window
from tagloom.operators.profiles import log_profile, order_profile, order_totals
from tagloom.operators.scores import (
    RfeBands,
    RfmBands,
    psm_features,
    psm_score,
    rfe_features,
    rfe_scores,
    rfm_features,
    rfm_scores,
)

__all__ = [
    "RfeBands",
    "RfmBands",
    "assign_cluster_tags",
    "assign_clusters",
    "fit_clusters",
    "log_profile",
    "match_equal",
    "match_range",
    "merge_with_store",
    "modal_value",
    "modal_value_window",
    "nearest_centre",
    "one_row_per_user",
    "order_profile",
    "order_totals",
    "psm_features",
    "psm_score",
    "rank_clusters",
    "rfe_features",
    "rfe_scores",
    "rfm_features",
    "rfm_scores",
]
