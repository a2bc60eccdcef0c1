"""Document fingerprints by I-Match: terms inside a band of document frequency, sorted, hashed per randomised lexicon.

A document's terms are its distinct lower-case words. Those in the band [min_share, max_share] of all documents, that is
inverse document frequencies from ln(1 / max_share) to ln(1 / min_share), form the lexicon. It is small by arithmetic, not
by a cap: a term of the lexicon is in min_share of all documents, so there are at most (mean distinct terms of a
document) / min_share of them, some 300,000 with the default band. Its size is counted; beyond BROADCAST terms it is
joined by shuffling instead of being broadcast.

The randomised lexicons come in families. Lexicon j of a family keeps the terms whose hash shares its first j bits with
the family's number, so a share of 2^-j of all terms, each lexicon inside the one before. How large a share should be
depends on the document: a lexicon with many of its terms changes with every edit, one with none says nothing. So a
document is marked, per family, by the smallest lexicon that has a term of it, mostly by one or two terms. Two documents
are marked alike in about as many families as they share terms.

A document with less than one in FEW of its terms in the band (one of a large group of near copies, whose terms are all too
common, or of a rare language, whose terms are all too rare) is marked by lexicons over all its terms.

Defined results: a null text is empty; repeated ids are ordered by text; null ids come last; an empty table gives no rows.
"""

from __future__ import annotations

from hashlib import sha256

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.storage import stored

SPACE = r"[\x20\x09-\x0D]+"
#: Families of lexicons.
FAMILIES = 12
#: The largest lexicon that is broadcast, in terms of eight bytes.
BROADCAST = 4_000_000
#: With less than one in FEW of its terms in the band a document is marked over all its terms.
FEW = 8


def terms_of(text: Column) -> Column:
    return F.filter(F.array_distinct(F.split(F.lower(text), SPACE)), lambda t: t != "")


def lexicon(documents: DataFrame, min_share: float, max_share: float) -> DataFrame:
    """Hashes (`term`) of the terms whose share of the documents is in the band."""
    n = documents.count()
    counts = (
        documents.select(F.explode(terms_of(F.col("text"))).alias("word"))
        .groupBy(F.xxhash64("word").alias("term"))
        .agg(F.count(F.lit(1)).alias("df"))
    )
    return counts.filter((F.col("df") >= min_share * n) & (F.col("df") <= max_share * n)).select("term")


#: What xxhash64 gives for an empty array: the mark of a document without terms.
NO_TERM = 42


def numbers(families: int) -> list[int]:
    """A fixed number of 63 bits per family; the first bits of any two of up to 16 families differ."""
    return [int.from_bytes(sha256(f"family {k}".encode()).digest()[:8]) >> 5 | (k * 5 % 16) << 59 for k in range(families)]


def marks_of(terms: Column, families: int) -> Column:
    """One hash per family: of the sorted terms in the smallest of its lexicons that has a term of the document.

    Bits that agree with the family's number are zero in `apart`, so that lexicon holds the terms whose highest set bit is
    that of the least: x & least > x ^ least just if the highest bits of both are the same.
    """
    def mark(number: Column) -> Column:
        apart = F.transform(terms, lambda t: t.bitwiseXOR(number).bitwiseAND((1 << 63) - 1))
        bound = F.transform(F.array(apart), lambda a: F.struct(a.alias("apart"), F.array_min(a).alias("least")))
        kept = F.transform(bound, lambda b: F.filter(b["apart"], lambda x: x.bitwiseAND(b["least"]) >= x.bitwiseXOR(b["least"])))
        return F.xxhash64(F.sort_array(F.get(kept, 0)))

    return F.transform(F.array(*map(F.lit, numbers(families))), mark)


def marks_or_all(marks: Column, in_band: Column, n_terms: Column, of_all: Column) -> Column:
    """The marks; those over all terms if less than one in FEW of the terms is in the band."""
    return F.when((in_band * FEW < n_terms) | (in_band == 0), of_all).otherwise(marks)


def likeness(a: Column, b: Column) -> Column:
    """Share of the families, among those that mark either document, that mark both alike."""
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: (x == y) & (x != NO_TERM)), lambda e: e))
    either = F.size(F.filter(F.zip_with(a, b, lambda x, y: (x != NO_TERM) | (y != NO_TERM)), lambda e: e))
    return equal.cast("double") / F.greatest(either, F.lit(1))


def fingerprint_text(marks: Column) -> Column:
    return F.concat_ws("-", F.transform(marks, lambda m: F.hex(m)))


def _splits(documents: DataFrame, n: int) -> list[int]:
    """Ids that cut the table into about n even ranges, ascending, the largest id last."""
    shares = F.array(*[F.lit(i / n) for i in range(1, n)]) if n > 1 else F.array(F.lit(0.5))
    found = documents.agg(F.percentile_approx("doc_id", shares, 100 * n).alias("at"), F.max("doc_id").alias("last")).first()
    return [] if found["last"] is None else sorted({*found["at"], found["last"]})


def with_next(documents: DataFrame) -> DataFrame:
    """Rows of (range, row, ahead, doc_id, text, next_text) where next is the following document by descending id.

    The table is cut into ranges of ids. The document behind each range (at the end: the first of all) is sent along with
    it, marked `ahead`, so every window sees one range and nothing passes a single task.
    """
    spark = documents.sparkSession
    splits = _splits(documents, 8 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    id_, text = F.col("doc_id"), F.coalesce("text", F.lit(""))
    if splits:
        values = F.array(*[F.lit(s).cast("long") for s in splits])
        steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(splits).bit_length()))])
        # binary search: how many splits lie below the id
        below = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(values, at + step - 1) < id_, at + step).otherwise(at))
        mine = F.when(id_.isNull(), 0).otherwise(below)
        is_split = F.array_contains(values, id_)
        behind = F.when(id_ == splits[-1], 0).otherwise(mine + 1)
        places = F.when(is_split, F.array(F.struct(mine.alias("range"), F.lit(0).alias("ahead")), F.struct(behind.alias("range"), F.lit(1).alias("ahead")))).otherwise(
            F.array(F.struct(mine.alias("range"), F.lit(0).alias("ahead")))
        )
    else:
        places = F.array(F.struct(F.lit(0).alias("range"), F.lit(0).alias("ahead")))
    dealt = documents.select(id_, text.alias("text"), F.explode(places).alias("place")).select("place.range", "place.ahead", "doc_id", "text")
    order = Window.partitionBy("range").orderBy("ahead", F.col("doc_id").desc_nulls_last(), "text")
    return dealt.withColumn("row", F.row_number().over(order)).withColumn(
        "next_text", F.coalesce(F.lead("text").over(order), F.first("text").over(order))
    )


def imatch_report(
    documents: DataFrame, min_share: float = 0.001, max_share: float = 0.1, families: int = FAMILIES
) -> DataFrame:
    """Fingerprints of every document and of its edited text, whose second half is the start of the next document's."""
    documents = documents.select("doc_id", "text")
    kind_of_id = documents.schema["doc_id"].dataType.simpleString()
    known = stored(lexicon(documents, min_share, max_share), "lexicon")
    small = known.count() <= BROADCAST
    known = known.withColumn("known", F.lit(True))
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.char_length("text") - half), F.substring(F.col("next_text"), F.lit(1), half)
    )
    rows = with_next(documents).select("range", "row", "ahead", "doc_id", "text", edited.alias("edited"))
    rows = rows.withColumn("terms", terms_of(F.col("text"))).withColumn(
        "edited_terms", F.when(F.col("ahead") == 0, terms_of(F.col("edited"))).otherwise(F.array().cast("array<string>"))
    )
    hashes = [F.transform(F.col(c), lambda t: F.xxhash64(t)).alias(f"{c}_hashes") for c in ("terms", "edited_terms")]
    rows = rows.select("*", *hashes)
    base = F.struct(
        "ahead",
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.size("terms").alias("n_terms"),
        F.size("edited_terms").alias("edited_n_terms"),
        marks_of(F.col("terms_hashes"), families).alias("of_all"),
        marks_of(F.col("edited_terms_hashes"), families).alias("edited_of_all"),
    )
    nothing = F.lit(None).cast(
        "struct<ahead:int,doc_id:%s,n_chars:bigint,edited_sha256:string,"
        "n_terms:int,edited_n_terms:int,of_all:array<bigint>,edited_of_all:array<bigint>>" % kind_of_id
    )

    def items(terms: str, kind: int) -> Column:
        return F.transform(
            F.col(terms), lambda t: F.struct(F.lit(kind).alias("kind"), F.xxhash64(t).alias("term"), nothing.alias("base"))
        )

    of_document = F.array(F.struct(F.lit(2).alias("kind"), F.lit(None).cast("long").alias("term"), base.alias("base")))
    exploded = rows.select("range", "row", F.explode(F.concat(items("terms", 0), items("edited_terms", 1), of_document)).alias("item"))
    exploded = exploded.select("range", "row", "item.*")
    found = exploded.join(F.broadcast(known) if small else known, "term", "left").filter(F.col("known") | (F.col("kind") == 2))
    # `range` is already what the rows are dealt by, so this needs no further shuffle.
    gathered = found.groupBy("range", "row").agg(
        F.max("base").alias("base"),
        F.collect_list(F.when(F.col("kind") == 0, F.col("term"))).alias("terms"),
        F.collect_list(F.when(F.col("kind") == 1, F.col("term"))).alias("edited_terms"),
    )
    marked = gathered.select(
        "range", "row", "base", "terms", "edited_terms",
        marks_of(F.col("terms"), families).alias("marks"), marks_of(F.col("edited_terms"), families).alias("edited_marks"),
    ).select(
        "range",
        "row",
        "base",
        marks_or_all(F.col("marks"), F.size("terms"), F.col("base.n_terms"), F.col("base.of_all")).alias("marks"),
        marks_or_all(F.col("edited_marks"), F.size("edited_terms"), F.col("base.edited_n_terms"), F.col("base.edited_of_all")).alias("edited_marks"),
    )
    order = Window.partitionBy("range").orderBy("row")
    paired = marked.withColumn("next_marks", F.coalesce(F.lead("marks").over(order), F.first("marks").over(order)))
    return paired.filter("base.ahead = 0").select(
        "base.doc_id",
        "base.n_chars",
        "base.edited_sha256",
        fingerprint_text(F.col("marks")).alias("fingerprint"),
        fingerprint_text(F.col("edited_marks")).alias("edited_fingerprint"),
        likeness(F.col("marks"), F.col("edited_marks")).alias("near_edited"),
        likeness(F.col("marks"), F.col("next_marks")).alias("near_next"),
    )
