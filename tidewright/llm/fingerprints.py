"""Document fingerprints: threshold-scaled sketches of word shingles, in DataFrame functions alone.

A sketch holds every distinct shingle hash below a fixed fraction of the hash range, so it grows with its text and
two sketches are samples of one and the same part of the range, however unequal the texts. Counts of common hashes
therefore estimate the likeness of two texts and the share of one that the other holds, and the sketch of
two texts together is the union of theirs. A text with no hash below the bound keeps its least hash, which
merges alike: the least of all is kept until one below the bound comes.

Hashes are the first 64 bits of the shingle's MD5 as hexadecimal digits, so that other engines get the same
sketches, and digits compare as the numbers do. A fingerprint is its sketch in ascending order, 16 digits a hash.

The next document of each is found without a sort in one task: ids and text hashes alone are range-partitioned,
and the first key of each range (a value per shuffle partition) cuts the documents into buckets. A window runs over each
bucket; the first row of the following bucket lies at its end as a guest. Texts are shuffled once.

Defined results: words are cut at blanks, with A-Z in lower case; fewer words than a shingle are one shingle; a
null, empty or blank text has an empty sketch, which is like another empty one (1) and unlike any other (0), and
is held by every text. Documents follow each other by descending id, null ids last, equal ids by a hash of their texts;
equal rows are interchangeable. A single document is its own next one. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewright.llm.base import BLANK

#: Words of a shingle, and the part of all hashes that a sketch holds.
SHINGLE, FRACTION = 5, 1 / 8
DIGITS = 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _let(value: Column, body) -> Column:
    """body(value) with value computed once a row."""
    return F.transform(F.array(value), body)[0]


def _below(fraction: float) -> str:
    """The least hash that is too large, as digits; 'g' follows all digits."""
    return f"{int(fraction * (1 << 64)):016x}" if fraction < 1 else "g"


def _kept(hashes: Column, fraction: float) -> Column:
    """Those below the bound, in order and once each; the least one where none is."""
    few = F.array_sort(F.array_distinct(F.filter(hashes, lambda h: h < _below(fraction))))
    return _let(few, lambda x: F.when((F.size(x) > 0) | (F.size(hashes) == 0), x).otherwise(F.array(F.array_min(hashes))))


def sketch(text: Column, shingle: int = SHINGLE, fraction: float = FRACTION) -> Column:
    """The retained shingle hashes of a text, in order."""
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    words = F.array_remove(F.split(lower, BLANK + "+"), "")

    def hashed(w: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.size(w) - (shingle - 1), F.lit(1)))
        hashes = F.transform(places, lambda i: F.md5(F.array_join(F.slice(w, i, shingle), " ")))
        return _let(hashes, lambda h: F.transform(_kept(h, fraction), lambda x: F.substring(x, 1, DIGITS)))

    return _let(words, lambda w: F.when(F.size(w) == 0, F.array().cast("array<string>")).otherwise(hashed(w)))


def merge(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """The sketch of two texts' shingles together."""
    return _let(F.array_union(a, b), lambda both: _kept(both, fraction))


def fingerprint(of: Column) -> Column:
    return F.array_join(of, "")


def likeness(a: Column, b: Column) -> Column:
    """Estimate of the Jaccard similarity of two texts' shingles."""
    common = F.size(F.array_intersect(a, b))
    return _let(common, lambda c: F.when(F.size(a) + F.size(b) == 0, 1.0).otherwise(c / (F.size(a) + F.size(b) - c)))


def containment(a: Column, b: Column) -> Column:
    """Estimate of the share of a's shingles that b has."""
    return F.when(F.size(a) == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def document_sketches(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, sketch."""
    return docs.select(F.col(id_col), sketch(F.col(text)).alias("sketch"))


def _last_at_most(starts: Column, key: Column, steps: int) -> Column:
    """Position (from 0) of the last of the sorted starts that is no greater than the key, by bisection."""
    begin = F.struct(F.lit(0).alias("a"), F.size(starts).alias("b"))

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["a"] + s["b"]) / 2).cast("int")
        right = F.get(starts, middle) <= key
        # With b = a + 1 the middle is a itself, which stays.
        return F.struct(F.when(right, middle).otherwise(s["a"]).alias("a"), F.when(right, s["b"]).otherwise(middle).alias("b"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), begin, halve, lambda s: s["a"])


def with_next(rows: DataFrame, buckets: int) -> tuple[DataFrame, W]:
    """Rows (i, t, h) in buckets, for windows over them: with `guest`, true for rows that lie at the end of a
    bucket only to be the next ones of its last row."""
    nulls, descending = F.col("i").isNull().alias("nul"), F.coalesce(-F.col("i"), F.lit(0)).alias("d")
    rows = rows.select("i", "t", F.struct(nulls, descending, F.col("h").alias("h")).alias("k"))
    ranged = rows.select("k").repartitionByRange(buckets, "k").groupBy(F.spark_partition_id()).agg(F.min("k").alias("k"))
    starts = ranged.agg(F.sort_array(F.collect_list("k"))).scalar()  # a key for each range, `buckets` at most
    rows = rows.withColumn("starts", starts)
    place = _last_at_most(F.col("starts"), F.col("k"), buckets.bit_length() + 1)
    rows = rows.withColumn("s", F.struct(place.alias("at"), F.size("starts").alias("n")))
    placed = rows.withColumn("first", F.get("starts", F.col("s.at")) == F.col("k"))
    own = F.struct(F.col("s.at").alias("b"), F.lit(False).alias("guest"))
    guest = F.struct(F.pmod(F.col("s.at") - 1, F.col("s.n")).alias("b"), F.lit(True).alias("guest"))
    laid = placed.select("i", "t", "k", F.explode(F.when(F.col("first"), F.array(own, guest)).otherwise(F.array(own))).alias("x"))
    return laid.select("i", "t", "k", "x.b", "x.guest"), W.partitionBy("b").orderBy("guest", "k", "t")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its fingerprint, and that of its text with the last third of its characters replaced by the first
    as many (or all) of the next document, by descending id and around to the first.

    Columns: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next (likeness to the edited
    text and to the next document), held_by_edited, held_by_next (the share of this text that the other holds).
    """
    buckets = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).alias("i"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    laid, window = with_next(rows.withColumn("h", F.xxhash64("t")), buckets)
    n, third = F.length("t"), F.floor(F.length("t") / 3).cast("int")
    edited = F.concat(F.substring(F.col("t"), F.lit(1), n - third), F.substring(F.col("u"), F.lit(1), third))
    texts = laid.withColumn("u", F.coalesce(F.lead("t").over(window), F.lit(""))).withColumn("e", edited)
    hashed = texts.withColumn("a", sketch(F.col("t"))).withColumn("c", sketch(F.col("e")))
    out = hashed.withColumn("z", F.lead("a").over(window)).filter(~F.col("guest"))
    return out.select(
        F.col("i").alias(id_col),
        F.length("t").cast("long").alias("n_chars"),
        F.sha2("e", 256).alias("edited_sha256"),
        fingerprint(F.col("a")).alias("fingerprint"),
        fingerprint(F.col("c")).alias("edited_fingerprint"),
        likeness(F.col("a"), F.col("c")).alias("near_edited"),
        likeness(F.col("a"), F.col("z")).alias("near_next"),
        containment(F.col("a"), F.col("c")).alias("held_by_edited"),
        containment(F.col("a"), F.col("z")).alias("held_by_next"),
    )
