"""Tag lists: merge, canonical order, and the comma-separated text form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TAG_SEPARATOR = ","


def without_nulls(tags: Column) -> Column:
    """Distinct tags of an array that are not null; an expression Spark compiles, which a
    lambda is not."""
    return F.array_except(tags, F.array(F.lit(None).cast("string")))


def canonical(tags: Column) -> Column:
    """Sort a tag array: whole numbers by value, then other text. Duplicates stay.

    There is no branch, so that Spark works out each repeated part once per row.
    """
    numbers = tags.try_cast("array<bigint>")
    # Text comes first here, since it has no number and nulls sort first.
    pairs = F.sort_array(F.arrays_zip(numbers.alias("number"), tags.alias("tag")))
    ordered = pairs["tag"]
    texts = (F.array_position(pairs["number"], F.array_min(numbers)) - 1).cast("int")
    numbers_first = F.concat(
        F.slice(ordered, texts + 1, F.size(ordered)), F.slice(ordered, 1, texts)
    )
    # Without any number ``texts`` is null.
    return F.coalesce(numbers_first, ordered)


def merge_tag_lists(new: Column, old: Column) -> Column:
    """Union of two tag arrays. A null side passes the other one through untouched."""
    return F.coalesce(canonical(F.array_union(new, old)), new, old)


def to_tag_list(tags_id: Column) -> Column:
    return F.split(tags_id.cast("string"), TAG_SEPARATOR)


def to_tags_id(tags: Column) -> Column:
    return F.array_join(tags, TAG_SEPARATOR)


def merge_tags(new: Column, old: Column) -> Column:
    """``merge_tag_lists`` over comma-separated text."""
    return to_tags_id(merge_tag_lists(to_tag_list(new), to_tag_list(old)))
