"""Threshold-scaled document sketches, DataFrame functions only (operator 9).

A sketch keeps every shingle hash below a fixed fraction of the hash space
(FRACTION = 1/8 of the shingles of five words; with fewer words the whole sequence
is one shingle), and always the smallest one, so only a text without words has an
empty sketch.  As the threshold is the same for all documents, sketches of unequal
texts compare directly, and the sketch of a union is the union of the sketches
(below the threshold, or else the smaller minimum).  Hashes are the first 48 bits
of MD5 in hexadecimal; a fingerprint is the sorted hashes joined.

``neighbours`` pairs every row with the next one in descending id order without a
global sort in one task: rows are cut into ranges of ids at weighted quantiles, the head of
each range is appended to the range before it, and a window looks ahead within
a range.  Texts are shuffled once.  Only the heads' ids are broadcast (one row a
range, at most about 400,000).

Defined cases.  NULL text counts as empty.  Empty sketches are alike only among
themselves (likeness 1).  NULL ids come last, ties are ordered by a hash of the text,
then the text.  After the last row comes the first, so a single row is its own next.
NULL text comes back as empty.  Repeated rows are rows of their own; copies of one text under one
id stay in one range, other rows of a repeated id spread over several.  Texts of any length are used whole.  Empty
table: empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common

WIDTH = 5
#: Kept share of the hash space, as the first hash that is not kept (hexadecimal), and hash length.
BOUND, DIGITS = "2", 12
#: Bytes of one id range (texts, and so much for a row itself), marks drawn for one range, and a bound on ranges.
RANGE_BYTES, ROW_BYTES, MARKS, RANGES = 4 << 20, 64, 16, 200_000


def hashes(words: Column) -> Column:
    """Shingle hashes of a word array, in order, with repeats."""
    few = F.when(F.size(words) > 0, F.array(F.md5(F.concat_ws(" ", words)))).otherwise(F.array().cast("array<string>"))
    many = F.transform(F.sequence(F.lit(1), F.size(words) - (WIDTH - 1)),
                       lambda i: F.md5(F.concat_ws(" ", F.slice(words, i, WIDTH))))
    return F.when(F.size(words) < WIDTH, few).otherwise(many)


def sketch(words: Column) -> Column:
    """Fingerprint of a word array (a column that was computed before, not an expression)."""
    def keep(h: Column) -> Column:
        low = F.filter(h, lambda x: x < BOUND)
        least = F.when(F.size(h) > 0, F.array(F.array_min(h))).otherwise(F.array().cast("array<string>"))
        kept = F.transform(F.when(F.size(low) > 0, low).otherwise(least), lambda x: F.substring(x, 1, DIGITS))
        return F.array_join(F.sort_array(F.array_distinct(kept)), "")
    return F.transform(F.array(hashes(words)), keep)[0]


def word_array(text: Column) -> Column:
    return F.filter(F.split(text, common.SPACE), lambda w: w != "")


def members(fingerprint: Column) -> Column:
    return F.regexp_extract_all(fingerprint, F.lit(f"(.{{{DIGITS}}})"), 1)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard estimate from two fingerprints."""
    both = F.size(F.array_intersect(members(a), members(b)))
    sizes = (F.length(a) + F.length(b)) / DIGITS
    return F.when(a == b, F.lit(1.0)).when((a == "") | (b == ""), F.lit(0.0)).otherwise(both / (sizes - both))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` has."""
    both = F.size(F.array_intersect(members(a), members(b)))
    return F.when(a == "", F.lit(1.0)).otherwise(both / (F.length(a) / DIGITS))


def fingerprint(df: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``df`` with the fingerprint of its text."""
    t = F.coalesce(F.col(common.quoted(text)), F.lit(""))
    rows = df.select(common.others(df).alias("row"), word_array(t).alias("w"))
    return common.restore(df, rows.select("row", sketch(F.col("w")).alias("fp")), {name: "fp"})


def merge(a: Column, b: Column) -> Column:
    """Fingerprint of the union of two shingle sets."""
    every = F.sort_array(F.array_union(members(a), members(b)))
    low = F.filter(every, lambda x: x < BOUND)
    return F.array_join(F.when(F.size(low) > 0, low).otherwise(F.slice(every, 1, 1)), "")


def _cuts_below(cuts: list[str], kind: str, x: Column, equal: bool) -> Column:
    """How many of the sorted ``cuts`` lie below ``x`` (or equal it): first among every width-th one, then in one block."""
    width = math.isqrt(len(cuts)) + 1
    array = lambda values: F.split(F.lit("\x01".join(values)), "\x01").cast(f"array<{kind}>")
    count = lambda values: F.size(F.filter(values, lambda v: v <= x if equal else v < x))
    blocks = count(array(cuts[::width]))
    start = F.greatest(blocks - 1, F.lit(0)) * width
    return F.when(blocks == 0, F.lit(0)).otherwise(start + count(F.slice(array(cuts), start + 1, F.lit(width))))


def id_ranges(df: DataFrame, doc_id: str, size: Column, tie: Column) -> Column:
    """Range number of a row, falling with (id, tie); a range holds about RANGE_BYTES of ``size``.

    Ranges are cut at quantiles of the ids, weighted by size, so their widths follow the ids, outlying ones
    too.  The quantiles come from marks that rows draw in proportion to their size, MARKS a range: they
    place the cuts only, every row gets its range from its id.  An id that several quantiles fall on (a
    repeated one) has as many ranges, cut by ``tie`` (a 64-bit hash); so have NULL ids, which come last.
    There are at most about RANGES of either, so ranges grow beyond RANGE_BYTES for very large tables.
    The driver holds the cuts.
    """
    at, weight = F.col(common.quoted(doc_id)), size.cast("double") + ROW_BYTES
    known, unknown = df.agg(F.sum(F.when(at.isNotNull(), weight)), F.sum(F.when(at.isNull(), weight))).first()
    number, nulls = (min(RANGES, int((total or 0) // RANGE_BYTES) + 1) for total in (known, unknown))
    part = tie.cast("double") / F.lit(2.0 ** 64) + F.lit(0.5)
    place = F.lit(0)
    if number > 1:
        marks = F.floor(weight * F.lit(MARKS * number / known) + F.rand(1))
        drawn = df.select(at.alias("id"), marks.alias("marks")).filter("id IS NOT NULL AND marks > 0").groupBy("id").agg(F.sum("marks").alias("marks"))
        upto = F.sum("marks").over(W.orderBy("id").rowsBetween(W.unboundedPreceding, W.currentRow))    # MARKS rows a range
        crossed = F.floor(F.col("upto") / MARKS) - F.floor((F.col("upto") - F.col("marks")) / MARKS)
        found = drawn.withColumn("upto", upto).select("id", crossed.alias("n")).filter("n > 0").orderBy("id")
        cuts = [r.id for r in found.select(F.col("id").cast("string").alias("id"), "n").collect() for _ in range(r.n)]
        if cuts:
            kind = df.select(at.alias("id")).schema["id"].dataType.simpleString()
            less, upto = _cuts_below(cuts, kind, at, False), _cuts_below(cuts, kind, at, True)
            place = less + F.least(F.floor(part * (upto - less + 1)), upto - less)
    last = F.floor((1 - part) * nulls)
    return F.when(at.isNotNull(), -place.cast("long")).otherwise(F.lit(1 << 40) + last)


def neighbours(df: DataFrame, doc_id: str = "doc_id", text: str = "text",
               derived: dict[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """``df`` with ``next_text``, the text of the next row in descending id order.

    ``derived`` names columns computed once from each row's word array; every row also gets
    them from the next one, as ``next_<name>``.
    """
    derived = derived or {}
    t = F.coalesce(F.col(common.quoted(text)), F.lit(""))
    tie = common.text_key(text)
    rows = df.select(common.others(df, text).alias("row"), t.alias("text"), F.col(common.quoted(doc_id)).alias("id"), tie.alias("tie"),
                     id_ranges(df, doc_id, F.octet_length(t), tie).alias("range"), F.lit(False).alias("ghost"))
    order = F.struct(F.col("id").isNotNull().alias("known"), F.col("id"), F.col("tie"))
    heads = rows.groupBy("range").agg(F.max(order).alias("head"))
    every = W.orderBy("range")                  # one row a range
    whole = every.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    before = F.coalesce(F.lag("range").over(every), F.last("range").over(whole))
    heads = heads.select(F.col("head.id").alias("hid"), F.col("head.tie").alias("htie"), before.alias("into"))
    ghosts = (rows.join(F.broadcast(heads), F.col("id").eqNullSafe(F.col("hid")) & (F.col("tie") == F.col("htie")))
              .withColumns({"range": F.col("into"), "ghost": F.lit(True)}).select(rows.columns).dropDuplicates(["range"]))
    both = rows.unionByName(ghosts).withColumn("w", word_array(F.col("text")))
    both = both.select("row", "id", "tie", "range", "ghost", F.struct(
        "text", *(make(F.col("w")).alias(c) for c, make in derived.items())).alias("own"))
    ahead = W.partitionBy("range").orderBy("ghost", F.desc_nulls_last("id"), F.desc("tie"), F.desc("own.text"))
    done = both.withColumn("next", F.lead("own").over(ahead)).filter(~F.col("ghost"))
    got = done.select("row", F.col("own.text").alias("own_text"), F.col("next.text").alias("next_text"),
                      *(F.col(f"own.{c}").alias(f"own_{c}") for c in derived),
                      *(F.col(f"next.{c}").alias(f"next_{c}") for c in derived))
    return common.restore(df, got, {text: "own_text", "next_text": "next_text", **{c: f"own_{c}" for c in derived},
                                    **{f"next_{c}": f"next_{c}" for c in derived}})


def half_edited(text: Column, other: Column) -> Column:
    """The last half (rounded down) of the code points replaced by as many first ones of ``other``, or all it has."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(other, F.lit(1), half))
