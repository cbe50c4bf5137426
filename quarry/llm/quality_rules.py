"""Document quality rules: one Spark projection of ratios against a threshold table.

Every rule is a row ``(name, numerator, denominator, low, high)`` over the measures below;
the table is compiled into a single native projection (no user function runs).  A document
is kept when no base rule and no threshold fails; a ratio with a zero denominator passes.

Measures (words are runs without white space ``[\\x20\\x09-\\x0D]``):
``n_words``, ``word_chars`` (code points in words), ``n_symbols`` (``#*$%&|<>``),
``n_lines`` (lines with a word), ``n_dup_lines`` (of them, those equal to an earlier line),
``n_repeat_words`` (words inside five-word windows found twice or more), ``n_stop_words``,
``n_upper`` (upper-case code points), ``n_words_over_50`` (``n_words`` less 50, zero at least:
a stop-word ratio says little about a short text).

A null text has no words; an empty text likewise: both fail the base rule.  A very long
text costs n log n (five-word window hashes are sorted inside the row).  Only the id and
the text column are read, so other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import let

#: Fixed: the characters that count as symbols.
SYMBOLS = "#*$%&|<>"
SPACES = "\t\n\x0b\x0c\r"
WINDOW = 5

#: Frequent short words of English, German, French and Spanish.
STOP_WORDS = ("the of and to in a is that for it was on be as are with der die und das den von zu mit im ein "
              "de la le les et des un une que du est en el los las y se por con no para es una").split()

#: name, numerator, denominator, lowest and highest ratio allowed (None: open).
Threshold = tuple[str, str, str, float | None, float | None]
DEFAULT_THRESHOLDS: tuple[Threshold, ...] = (
    ("word_length", "word_chars", "n_words", 2.0, 12.0),
    ("symbols", "n_symbols", "n_words", None, 0.2),
    ("duplicate_lines", "n_dup_lines", "n_lines", None, 0.5),
    ("stop_words", "n_stop_words", "n_words_over_50", 0.02, None),
    ("capitals", "n_upper", "word_chars", None, 0.4),
)


def _repeat_words(words: Column) -> Column:
    """Words covered by a five-word window that occurs twice or more.

    Window hashes are sorted with their positions; equal neighbours are repeated, and the
    sorted start positions of those add min(5, distance to the next) words each."""
    def counted(sorted_: Column) -> Column:
        starts = F.filter(
            F.transform(sorted_, lambda x, j: F.when(
                ((j > 0) & (F.get(sorted_, j - 1)["h"] == x["h"])) | F.coalesce(F.get(sorted_, j + 1)["h"] == x["h"], F.lit(False)), x["i"])),
            lambda i: i.isNotNull())
        return let(F.sort_array(starts), lambda s: F.aggregate(
            s, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).cast("int").alias("at")),
            lambda acc, i: F.struct((acc["n"] + F.least(F.lit(WINDOW), i - acc["at"])).cast("long").alias("n"), i.alias("at")),
            lambda acc: acc["n"]))

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: F.struct(
        F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]).alias("h"), i.alias("i")))
    return F.when(F.size(words) > WINDOW, let(F.sort_array(windows), counted)).otherwise(F.lit(0)).cast("long")


def measures(text: Column) -> dict[str, Column]:
    """The measures of a text column, each a long."""
    body = F.coalesce(text, F.lit(""))
    spaced = F.translate(body, SPACES, " " * len(SPACES))
    words = F.array_remove(F.split(spaced, " "), "")
    lines = F.filter(F.split(body, "\n"), lambda s: F.btrim(s, F.lit(" " + SPACES)) != "")
    counted = let(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        _repeat_words(w).alias("n_repeat_words"),
        F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))).cast("long").alias("n_stop_words")))
    lined = let(lines, lambda s: F.struct(
        F.size(s).cast("long").alias("n_lines"), (F.size(s) - F.size(F.array_distinct(s))).cast("long").alias("n_dup_lines")))
    return {
        "counted": counted, "lined": lined,
        "word_chars": F.length(F.translate(body, " " + SPACES, "")).cast("long"),
        "n_symbols": (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long"),
        "n_upper": F.length(F.regexp_replace(body, r"\P{Lu}+", "")).cast("long"),
    }


def judge(docs: DataFrame, thresholds: Sequence[Threshold] = DEFAULT_THRESHOLDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, the measures, base_failed, kept)`` for every document."""
    measured = docs.select(F.col(id_col), *[c.alias(n) for n, c in measures(F.col(text_col)).items()])
    cols = {n: F.col(n) for n in ("word_chars", "n_symbols", "n_upper")}
    cols |= {n: F.col("counted")[n] for n in ("n_words", "n_repeat_words", "n_stop_words")}
    cols |= {n: F.col("lined")[n] for n in ("n_lines", "n_dup_lines")}

    cols["n_words_over_50"] = F.greatest(cols["n_words"] - 50, F.lit(0))

    def passes(rule: Threshold) -> Column:
        _, top, bottom, low, high = rule
        ok = F.lit(True)
        if low is not None:
            ok = ok & (cols[top] >= F.lit(low) * cols[bottom])
        if high is not None:
            ok = ok & (cols[top] <= F.lit(high) * cols[bottom])
        return ok

    base_failed = (cols["n_words"] < 10) | (100 * cols["n_repeat_words"] > 20 * cols["n_words"])
    kept = ~base_failed & reduce(lambda a, b: a & b, map(passes, thresholds), F.lit(True))
    order = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words", "n_upper")
    return measured.select(id_col, *[cols[n].alias(n) for n in order], base_failed.alias("base_failed"), kept.alias("kept"))
