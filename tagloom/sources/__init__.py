"""Readers for rules and business data."""

from tagloom.sources.rules import MalformedRule, MissingRule, RuleBook, TagValues, read_rules
from tagloom.sources.spec import SourceSpec, read_source

__all__ = [
    "MalformedRule",
    "MissingRule",
    "RuleBook",
    "SourceSpec",
    "TagValues",
    "read_rules",
    "read_source",
]
