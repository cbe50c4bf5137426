"""Exact duplicates by distributed most-significant-digit radix partitioning.

Normalised texts are split by successive digits of bytes: rows of one group that share the next
digit (and whether the text ends in it) form the groups of the next round.  A group of one row, or
one whose texts have ended, is finished.  A digit is a run of bytes, 64 at first and sixteen times
as many in each later round, so that the number of rounds follows the logarithm of the longest
text; groups are compared by the very bytes, never by a digest.

Each round counts the digits (partial aggregation before the shuffle, so a group that holds a third
of all rows sends one row per task), stores the groups of two or more, and joins the rows to them.
The groups are a stored table, so Spark can split the rows of a hot group over many tasks.  Rows
carry only the bytes not read yet, and leave the rounds as soon as their group is finished.

Null texts count as empty, and empty texts equal one another.  A null id comes after every other
one.  Rows are counted, not ids: of equal texts under one id one row stays.  An empty table
gives an empty result; further columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import stored

#: Bytes of the first digit, growth of a digit from round to round, and its largest size.
FIRST_DIGIT, GROWTH, LARGEST_DIGIT = 64, 16, 1 << 20

#: Length of "all that is left" for ``substring``.
_REST = (1 << 31) - 1

WHITE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """The text with each run of white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def _head(text: Column, size: int) -> Column:
    """Bytes that begin the normalised text: ``size`` and one more where it is longer.

    A code point has one byte at least, so ``size + 1`` code points are enough; the pattern reads
    no further into a long text."""
    runs = F.regexp_extract(F.coalesce(text, F.lit("")), rf"^(?:{WHITE}|[^\x20\x09-\x0D])" + f"{{0,{size + 1}}}", 0)
    return F.substring(F.regexp_replace(runs, WHITE, " ").cast("binary"), 1, size + 1)


def _split(rows: DataFrame, groups: DataFrame, rest: Column) -> DataFrame:
    """Rows with the size, the smallest id and the number of their group; none of them for a single row.

    Always a shuffled join, which Spark can split by rows; the groups have no size bound."""
    keys = ["parent", "digit", "ended"]
    return rows.join(groups.hint("merge"), keys, "left").select(
        "row", "doc_id", "sha", "n", "first", "stays", "child", F.when(F.col("child").isNotNull(), rest).alias("rest"))


def exact_duplicates(docs: DataFrame, text: str = "text", first_digit: int = FIRST_DIGIT, growth: int = GROWTH,
                     largest_digit: int = LARGEST_DIGIT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``keep_id`` (id of the row that stays),
    ``group_size``, ``kept`` and ``text_sha256`` of the normalised text."""
    keys = ["parent", "digit", "ended"]
    row_id = F.monotonically_increasing_id()
    # First round.  Its digit is counted without normalising whole texts, and every group of two or
    # more goes on: a text that has ended meets the empty digit in the second round.
    head = _head(F.col(text), first_digit)
    counted = docs.select(F.lit(0).alias("parent"), F.substring(head, 1, first_digit).alias("digit"), (F.octet_length(head) <= first_digit).alias("ended"))
    none = F.lit(None).cast("long")
    groups = stored(counted.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(
        *keys, "n", F.lit(None).cast(docs.schema["doc_id"].dataType).alias("first"), none.alias("stays"), row_id.alias("child")), "radix-groups")
    rows = docs.select("doc_id", row_id.alias("row"), normalised(F.col(text)).cast("binary").alias("bytes")).select(
        "doc_id", "row", "bytes", F.sha2("bytes", 256).alias("sha"), F.lit(0).alias("parent"), F.substring("bytes", 1, first_digit).alias("digit"),
        (F.octet_length("bytes") <= first_digit).alias("ended"))
    tables = [stored(_split(rows, groups, F.substring(F.col("bytes"), first_digit + 1, _REST)), "radix-rows")]
    width = first_digit
    while not tables[-1].where("child is not null").isEmpty():
        width = min(width * growth, largest_digit)
        rows = tables[-1].where("child is not null").select(
            "row", "doc_id", "sha", "rest", F.col("child").alias("parent"), F.substring("rest", 1, width).alias("digit"),
            (F.octet_length("rest") <= width).alias("ended"))
        found = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min("doc_id").alias("first"),
                                        F.coalesce(F.min_by("row", "doc_id"), F.min("row")).alias("stays"))
        groups = stored(found.where("n > 1").withColumn("child", F.when(~F.col("ended"), row_id)), "radix-groups")
        tables.append(stored(_split(rows, groups, F.substring(F.col("rest"), width + 1, _REST)), "radix-rows"))
    done = reduce(DataFrame.unionByName, [t.where("child is null") for t in tables])
    one = F.col("n").isNull()
    return done.select("doc_id", F.when(one, F.col("doc_id")).otherwise(F.col("first")).alias("keep_id"),
                       F.coalesce("n", F.lit(1).cast("long")).alias("group_size"), (one | (F.col("row") == F.col("stays"))).alias("kept"),
                       F.col("sha").alias("text_sha256"))
