"""User tagging on Spark: rules, per-user statistics and clusters to a persona table."""
