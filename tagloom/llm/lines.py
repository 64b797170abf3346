"""Line dedup: lines that many documents share are removed everywhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.tables import ASCII_SPACE, Scratch, ascii_lower, digest, or_empty, whole_row


def line_hashes(text: Column, min_length: int) -> Column:
    """The hash of each line's key, in order; null for keys shorter than ``min_length``."""

    def hashed(line: Column) -> Column:
        key = F.btrim(line, F.lit(ASCII_SPACE))
        return F.when(F.length(key) >= min_length, F.xxhash64(key))

    return F.transform(F.split(ascii_lower(text), "\n", -1), hashed)


def without_positions(lines: Column, positions: Column) -> Column:
    """The lines except those at the ascending 0-based positions, in linear time: the runs
    between two dropped lines are sliced out and joined up."""
    last = F.size(positions)

    def run(i: Column) -> Column:
        before = F.when(i == 0, F.lit(-1)).otherwise(F.get(positions, i - 1))
        after = F.when(i == last, F.size(lines)).otherwise(F.get(positions, i))
        return F.slice(lines, before + 2, after - before - 1)

    return F.flatten(F.transform(F.sequence(F.lit(0), last), run))


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_length: int = 1) -> DataFrame:
    """Drop every line whose key is found in at least ``min_docs`` documents.

    A text is split at ``\\n``; a line's key is the line without ASCII white space at its
    ends and with A-Z lower-cased. Keys under ``min_length`` code points are never dropped.
    Keys are compared by their 64-bit hash.

    Returns the columns of ``docs`` with ``text`` replaced, and ``n_lines`` and
    ``n_dropped``; columns of these names are overwritten, others kept whatever their name.
    A null text counts as empty: one empty line. Each row is a document, so repeated rows
    and rows without a doc_id count. An empty table gives an empty result.

    Hashes are counted per map task before they are shuffled. Positions to drop are found
    once per distinct text, so a text that a third of the rows share is one row there.
    """
    scratch = Scratch(docs)
    text = or_empty(F.col("text"))
    hashes = docs.select(digest(text).alias("text_id"), line_hashes(text, min_length).alias("hashes"))
    shared = (
        hashes.select(F.explode(F.array_distinct("hashes")).alias("hash"))
        .filter(F.col("hash").isNotNull())
        .groupBy("hash")
        .agg(F.count(F.lit(1)).alias("docs"))
        .filter(F.col("docs") >= min_docs)
        .select("hash")
    )
    # Written, so that the join below reads both sides through a shuffle of its own and a
    # text that many rows share can be split there.
    dropped = scratch.write(
        hashes.select("text_id", F.posexplode("hashes").alias("position", "hash"))
        .join(scratch.small_side(shared), "hash")
        .groupBy("text_id")
        .agg(F.array_sort(F.collect_set("position")).alias("positions"))
    )
    lines = F.split(F.col("own_text"), "\n", -1)
    kept = F.when(F.col("positions").isNull(), F.col("own_text")).otherwise(
        F.array_join(without_positions(lines, F.col("positions")), "\n")
    )
    own = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    return (
        docs.select(whole_row(docs), text.alias("own_text"), digest(text).alias("text_id"))
        .join(dropped, "text_id", "left")
        .select(
            *[F.col(f"row.`{c}`") for c in own],
            kept.alias("text"),
            F.size(lines).cast("long").alias("n_lines"),
            F.coalesce(F.size("positions"), F.lit(0)).cast("long").alias("n_dropped"),
        )
    )


def line_dedup_digest(docs: DataFrame) -> DataFrame:
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def without_shared_lines(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with the shared lines gone and ``n_chars`` brought up to date."""
    cleaned = dedup_lines(docs)
    columns = [F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns]
    return cleaned.select(*columns)
