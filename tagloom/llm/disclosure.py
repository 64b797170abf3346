"""Personal data, and the words that give it away.

Base spans follow fixed patterns. Corpus co-occurrence tells how much a word reveals of an
entity in the same document: the pointwise mutual information of word and entity as a share
of the entity's own information. Words over a threshold are generalised, those over a
higher one removed, wherever they occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.llm.tables import Scratch, digest, or_empty, whole_row

# The given patterns, written so that no start is tried twice and nothing is backtracked
# over: runs are possessive and begin where a run begins, or where the last match ended.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
MARK = {"email": "@", "phone": "+"}  # no match without it
KINDS = tuple(PATTERNS)
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
TERM = r"\p{L}++"
OUTSIDE = r"(?<![\p{L}\x00])\p{L}++(?!\x00)"  # words that touch no address, each replaced by a zero
MIN_TEXTS = 3  # different texts in which a word and an entity must meet, unless the word is found with the entity only
GENERALISE, REMOVE = 0.8, 0.95
BLOCK = 256


def _scan(first: Column, numbers: Column) -> Column:
    """Totals before each number, starting from ``first``."""
    zero = F.struct(first.cast("long").alias("total"), F.array().cast("array<bigint>").alias("before"))
    return F.aggregate(
        numbers,
        zero,
        lambda s, x: F.struct((s["total"] + x).alias("total"), F.concat(s["before"], F.array(s["total"])).alias("before")),
        lambda s: s["before"],
    )


def totals_before(numbers: Column) -> Column:
    """Running totals of a long array, in blocks, so that the work stays near linear."""
    blocks = F.transform(
        F.sequence(F.lit(0), F.ceil(F.size(numbers) / BLOCK).cast("int") - 1, F.lit(1)),
        lambda b: F.slice(numbers, b * BLOCK + 1, F.lit(BLOCK)),
    )
    sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("long"), lambda s, x: s + x))
    return F.flatten(F.zip_with(blocks, _scan(F.lit(0), sums), lambda b, first: _scan(first, b)))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")
    if kind == "card":
        digits = _digits(value)
        return F.when(F.length(digits).between(12, 19), F.call_function("luhn_check", digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _found(kind: str, text: Column) -> Column:
    every = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), 0)
    none = F.array().cast("array<string>")
    return F.when(F.contains(text, F.lit(MARK[kind])), every).otherwise(none) if kind in MARK else every


def _located(matches: Column, pieces: Column) -> Column:
    """``(start, value)`` of matches, from the text between them."""
    lengths = F.zip_with(
        F.slice(pieces, F.lit(1), F.size(matches)), matches, lambda p, m: (F.length(p) + F.length(m)).cast("long")
    )
    starts = F.zip_with(
        totals_before(lengths), F.slice(pieces, F.lit(1), F.size(matches)), lambda t, p: t + F.length(p)
    )
    zipped = F.arrays_zip(
        starts.alias("start"),
        matches.alias("value"),
    )
    return zipped


def base_spans(docs: DataFrame) -> DataFrame:
    """``docs`` and ``spans``, an array of ``(start, rank, kind, end, value)`` by start and
    kind. Needs ``text`` without nulls."""
    found = docs.select("*", *[_found(k, F.col("text")).alias(f"found_{k}") for k in KINDS])
    kinds = [_spans_of(kind, rank) for rank, kind in enumerate(KINDS)]
    return found.select(*docs.columns, F.array_sort(F.concat(*kinds)).alias("spans"))


def _spans_of(kind: str, rank: int) -> Column:
    matches = F.col(f"found_{kind}")
    located = _located(matches, F.split("text", PATTERNS[kind], -1))
    spans = F.transform(
        F.filter(located, lambda m: _valid(kind, m["value"])),
        lambda m: F.struct(
            m["start"].alias("start"),
            F.lit(rank).alias("rank"),
            F.lit(kind).alias("kind"),
            (m["start"] + F.length(m["value"])).alias("end"),
            m["value"].alias("value"),
        ),
    )
    return F.when(F.size(matches) > 0, spans).otherwise(F.array().cast(SPANS))


SPANS = "array<struct<start:bigint,rank:int,kind:string,end:bigint,value:string>>"


def _entity(span: Column) -> Column:
    """The same for one address or number however it is written."""
    written = F.lower(span["value"])
    return F.xxhash64(span["kind"], F.when(span["kind"].isin("card", "phone"), _digits(written)).otherwise(written))


def _terms(text: Column) -> Column:
    """The distinct words outside addresses, hashed."""
    outside = F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, PATTERNS["email"], "\0")).otherwise(text)
    return F.array_distinct(F.transform(F.regexp_extract_all(outside, F.lit(OUTSIDE), 0), _term))


def _term(word: Column) -> Column:
    return F.xxhash64(F.lower(word))


def _disclosing(spans: DataFrame, scratch: Scratch) -> DataFrame:
    """``(term, kind)`` of words that reveal too much of an entity, by the rows of ``spans``."""
    n = float(spans.count())
    texts = scratch.write(
        spans.filter(F.size("spans") > 0)
        .groupBy("text_id")
        .agg(F.count(F.lit(1)).alias("rows"), F.first("spans").alias("spans"), F.first("words").alias("words"))
        .select("text_id", "rows", F.array_distinct(F.transform("spans", _entity)).alias("entities"), "words")
    )
    places = texts.select("text_id", "rows", F.explode("entities").alias("entity"))
    # Entities that stand in the same texts meet the same words as often, so one of them is
    # enough: a log of many addresses costs its words once, not once for each address.
    standing = scratch.small_side(
        places.groupBy("entity")
        .agg(
            F.sum("rows").alias("of_entity"),
            F.bit_xor(F.xxhash64("text_id")).alias("same"),
            F.bit_xor(F.xxhash64("text_id", F.lit(1))).alias("texts"),
        )
        .groupBy("of_entity", "same", "texts")
        .agg(F.min("entity").alias("entity"))
        .select("entity", "of_entity")
    )
    most = standing.agg(F.max("of_entity")).first()[0] or 0

    # A share of GENERALISE needs of_term <= both * (n / of_entity) ** (1 - GENERALISE), and
    # both is of_entity at most; words beyond that cannot disclose.
    def limit(of_entity):
        return of_entity**GENERALISE * n ** (1 - GENERALISE) * (1 + 1e-9)

    terms = (
        spans.select(F.explode("words").alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("of_term"))
        .filter(F.col("of_term") <= limit(most))
    )
    together = (
        places.join(standing, "entity")
        .join(texts.select("text_id", "words"), "text_id")
        .select("entity", "of_entity", "rows", F.explode("words").alias("term"))
        .groupBy("entity", "of_entity", "term")
        .agg(F.sum("rows").alias("both"), F.count(F.lit(1)).alias("texts"))
        .join(terms, "term")
        .filter(F.col("of_term") <= limit(F.col("of_entity")))
    )
    information = -F.ln(F.col("of_entity") / n)
    mutual = F.ln(F.col("both") * n / (F.col("of_entity") * F.col("of_term")))
    share = F.when(information > 0, mutual / information)
    often, certain = F.col("texts") >= MIN_TEXTS, F.col("both") == F.col("of_term")
    return (
        together.withColumn("share", share)
        .filter((F.col("share") >= GENERALISE) & (often | certain))
        .groupBy("term")
        .agg(F.when(F.max(F.when(often, F.col("share"))) >= REMOVE, "remove").otherwise("generalise").alias("kind"))
    )


def _marked(keyed: DataFrame, spans: DataFrame, disclosing: DataFrame, scratch: Scratch) -> DataFrame:
    """``(doc_id, text_id, start, end, kind)``: every place of a disclosing word, in all texts.

    Only a document's own disclosing words are located in it, by a pattern of these words.
    """
    document = ["doc_id", "text_id"]
    key = F.coalesce("doc_id", F.lit(-1)).alias("doc_id")
    disclosing = scratch.small_side(disclosing)
    having = scratch.write(
        spans.select(key, "text_id", F.explode("words").alias("term"))
        .join(disclosing, "term")
        .groupBy(*document)
        .agg(F.collect_set("term").alias("own"))
    )
    text, pattern = F.col("text"), F.col("pattern")
    written = F.filter(
        F.array_distinct(F.regexp_extract_all(text, F.lit(TERM), 0)), lambda w: F.array_contains("own", _term(w))
    )
    alone = F.concat(F.lit(r"(?<!\p{L})(?:"), F.array_join(written, "|"), F.lit(r")(?!\p{L})"))
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    return (
        keyed.select(key, "text_id", "text")
        .join(having, document)
        .select(*document, "text", alone.alias("pattern"))
        .select(*document, matches.alias("matches"), F.split(text, pattern, -1).alias("pieces"))
        .select(*document, F.explode(_located(F.col("matches"), F.col("pieces"))).alias("w"))
        .select(*document, _term(F.col("w.value")).alias("term"), "w.start", (F.col("w.start") + F.length("w.value")).alias("end"))
        .join(disclosing, "term")
        .select(*document, "start", "end", "kind")
        .distinct()
    )


def _clear_of_base(terms: DataFrame, spans: DataFrame) -> DataFrame:
    """Word spans that touch no base span, by one ordered pass each way per document."""
    document = ["doc_id", "text_id"]
    base = (
        spans.join(terms.select(*document).distinct(), document, "left_semi")
        .select(*document, F.explode("spans").alias("span"))
        .select(*document, "span.start", "span.end", F.lit(None).cast("string").alias("kind"))
    )
    both = terms.select(*document, "start", "end", "kind").unionByName(base.distinct())
    is_base = F.col("kind").isNull()
    forth = W.partitionBy(*document).orderBy("start", is_base.desc()).rowsBetween(W.unboundedPreceding, -1)
    back = W.partitionBy(*document).orderBy(F.desc("start"), is_base).rowsBetween(W.unboundedPreceding, -1)
    return (
        both.withColumn("ended", F.max(F.when(is_base, F.col("end"))).over(forth))
        .withColumn("begins", F.min(F.when(is_base, F.col("start"))).over(back))
        .filter(~is_base & (F.coalesce("ended", F.lit(-1)) <= F.col("start")) & (F.col("end") <= F.coalesce("begins", "end")))
        .select(*document, "start", "end", "kind")
    )


def _found_spans(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """``(doc_id, text_id, spans, terms)``, a row for each row of ``(doc_id, text)``."""
    keyed = texts.select("doc_id", digest(F.col("text")).alias("text_id"), "text")
    spans = scratch.write(base_spans(keyed).withColumn("words", _terms(F.col("text"))).drop("text"))
    # A row's key: rows that share doc_id and text share their spans. Rows without an id count apart.
    known = spans.filter(F.size("spans") > 0).withColumn("doc_id", F.coalesce("doc_id", F.lit(-1))).dropDuplicates(["doc_id", "text_id"])
    terms = scratch.write(_marked(keyed, spans, _disclosing(spans, scratch), scratch))
    terms = _clear_of_base(terms, known)
    of_document = terms.groupBy(F.col("doc_id").alias("key_id"), F.col("text_id").alias("key_text")).agg(
        F.array_sort(F.collect_list(F.struct("start", F.lit(len(KINDS)).alias("rank"), "kind", "end"))).alias("terms")
    )
    same = (F.coalesce("doc_id", F.lit(-1)) == F.col("key_id")) & (F.col("text_id") == F.col("key_text"))
    plain = F.transform("spans", lambda s: F.struct(s["start"], s["rank"], s["kind"], s["end"]))
    none = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    return spans.select("doc_id", "text_id", plain.cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>").alias("spans")).join(
        of_document, same, "left"
    ).select("doc_id", "text_id", "spans", F.coalesce("terms", none).alias("terms"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), or_empty(F.col("text")).alias("text"))


def personal_data(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)`` for each row.

    Base spans are the leftmost non-overlapping matches of each kind that pass its test;
    kinds may overlap each other. The method adds spans of kind ``generalise`` and
    ``remove``: words whose mutual information with an entity, over the rows of the whole
    table, is at least 0.8 or 0.95 of the entity's information. A share is trusted if both
    meet in at least ``MIN_TEXTS`` different texts. With fewer, as for an entity of a single
    text, only a word that is in no document without the entity counts: it gives the entity
    away for certain, and is generalised. The largest share over all entities counts. Such a
    word is marked wherever it touches no base span, at any distance from an entity and in
    documents without one as well.

    Positions are code points, ends exclusive. A null text counts as empty. Rows without a
    doc_id are handled like others and told apart by text. Repeated rows have the same
    result each. Other columns are ignored. An empty table gives an empty result.

    Texts are scanned in place, and once more where they have a word to mark; only spans and
    hashed words are shuffled, and sums are combined before that.
    """
    found = _found_spans(_texts(docs), Scratch(docs))

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(number, KINDS),
        F.sha2(_listed(F.col("spans")), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat("spans", "terms"))).alias("spans"),
    )


def sanitised(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with ``text`` sanitised: base spans and generalised words
    become their kind in brackets, ``[email]`` or ``[word]``, and removed words go."""
    found = _found_spans(_texts(docs), Scratch(docs))
    every = F.array_sort(F.concat("spans", "terms"))
    # Spans that overlap become one, under the first one's kind.
    apart = F.aggregate(
        every,
        F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>"),
        lambda kept, s: F.when(
            (F.size(kept) > 0) & (s["start"] < F.coalesce(F.try_element_at(kept, F.lit(-1))["end"], F.lit(-1))),
            F.concat(
                F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0))),
                F.array(
                    F.struct(
                        F.try_element_at(kept, F.lit(-1))["start"].alias("start"),
                        F.try_element_at(kept, F.lit(-1))["rank"].alias("rank"),
                        F.try_element_at(kept, F.lit(-1))["kind"].alias("kind"),
                        F.greatest(F.try_element_at(kept, F.lit(-1))["end"], s["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(kept, F.array(s))),
    )
    found = found.select("doc_id", "text_id", apart.alias("apart")).dropDuplicates(["doc_id", "text_id"])
    text, spans = F.col("own_text"), F.col("apart")

    def part(i: Column) -> Column:
        begin = F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get(spans, i - 1)["end"])
        span = F.get(spans, i)
        until = F.coalesce(span["start"], F.length(text).cast("long"))
        kind = span["kind"]
        label = F.when(kind == "remove", "").when(kind == "generalise", "[word]").otherwise(F.concat(F.lit("["), kind, F.lit("]")))
        gap = F.substr(text, (begin + 1).cast("int"), (until - begin).cast("int"))
        return F.concat(gap, F.coalesce(label, F.lit("")))

    # A slot after the last span takes the rest of the text.
    clean = F.array_join(F.transform(F.sequence(F.lit(0), F.size(spans)), part), "")
    rows = docs.select(
        whole_row(docs), F.col("doc_id").cast("long").alias("own_id"), or_empty(F.col("text")).alias("own_text")
    ).withColumn("own_digest", digest(F.col("own_text")))
    same = F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_digest") == F.col("text_id"))
    own = [clean.alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns]
    return rows.join(found, same, "left").select(*own)
