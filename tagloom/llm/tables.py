"""Small helpers the corpus operators share: scratch tables, checked broadcasts, ASCII text."""

from __future__ import annotations

import string
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.stores.hadoop import delete_folder, scratch_folder, written

ASCII_SPACE = " \t\n\x0b\x0c\r"
BROADCAST_ROWS = 1_000_000


class Scratch:
    """Written tables of one operator run, in the folder all executors share.

    A written table cuts lineage, so a lost executor costs at most the tasks that were
    running on it. The folder goes when the session ends, since the result may be read
    until then.
    """

    def __init__(self, frame: DataFrame):
        self.folder = scratch_folder(frame.sparkSession)

    def write(self, frame: DataFrame, **options: str) -> DataFrame:
        return written(frame, self.folder, **options)

    def small_side(self, frame: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
        """The written frame, marked for broadcast only if its counted rows are at most
        ``max_rows``; beyond that the join shuffles, with the same result. For narrow rows
        of fixed width."""
        table = self.write(frame)
        return F.broadcast(table) if table.count() <= max_rows else table


@contextmanager
def brief_scratch(frame: DataFrame) -> Iterator[Scratch]:
    """Scratch whose folder goes at the end, on error as well, for tables that only other
    written tables are made of."""
    scratch = Scratch(frame)
    try:
        yield scratch
    finally:
        delete_folder(frame.sparkSession, scratch.folder)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def whole_row(frame: DataFrame) -> Column:
    """All columns as one struct, so that no working column can clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in frame.columns]).alias("row")


def digest(text: Column) -> Column:
    """128 bits that stand for a text."""
    return F.unhex(F.md5(text))
