"""Column -> Column text helpers: tokenising, filters, log-line shaping.

All of these are built-in Spark expressions, so they run inside whole-stage
codegen on the executors; none is a Python UDF.

Tokenising follows Java ``String.split`` where it matters: Spark's ``split``
keeps trailing empty strings, Java drops them and keeps a leading one.
:func:`tokens` does the same; readers that skip leading blanks trim first.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for the same results.
# ---------------------------------------------------------------------------
# Word-count stop list (kept or dropped by ``stop_word_filter``).
STOP_WORDS = ["is", "you", "to", "your", "the", "a", "of"]
# Words never counted by the stream word counter (matched case-insensitively;
# the empty string is in the list on purpose).
BANNED_WORDS = ["rt", "", "a", "the", "to", "de", "and", "que", "i",
                "of", "you", "in", "is", "me", "this", "for", "on", "la", "no"]
# Keywords searched as whole tokens in log lines.
LOG_KEYWORDS = ["reboot", "error", "reboots", "total reboots", "failed", "traceback"]
# Severity filter: line kept when shorter than this and holding one of the
# wanted tokens but none of the unwanted ones.
SEVERITY_MAX_LEN = 210
SEVERITY_WANTED = ["error", "warning"]
SEVERITY_UNWANTED = ["info"]
# Time of day, ``HH:MM`` with optional ``:SS``; first match in the line.
TIME_PATTERN = r"([0-9]{2})(:[0-9]{2})(:[0-9]{2})?"
# ---------------------------------------------------------------------------


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Java's \s: blank, tab, newline, vertical tab, form feed, carriage return.
WHITESPACE = " \t\n\u000b\f\r"


def strip_ws(c: Column | str) -> Column:
    """Trim all leading/trailing whitespace (``trim`` only removes blanks)."""
    return F.btrim(_c(c), F.lit(WHITESPACE))


def tokens(c: Column | str, sep: str = r"\s+") -> Column:
    """Tokens of a line as Java splits it: no empty token at the end, an empty first one
    when the line starts with a separator.  ``sep`` is a run of white space or one blank."""
    return F.split(F.rtrim(_c(c), F.lit(" " if sep == " " else WHITESPACE)), sep)


def word_tokens(c: Column | str) -> Column:
    """``lower(line)`` with every non-word character turned into a blank, split
    on runs of blanks (F5 + P14 tokenisation)."""
    return F.split(F.regexp_replace(F.lower(_c(c)), r"\W", " "), r"\s+")


def keyword_filter(c: Column | str, keywords: Iterable[str] = LOG_KEYWORDS,
                   phrases: bool = False) -> Column:
    """True when any keyword equals a token of the line.

    A keyword holding a blank can never equal one token; with ``phrases=True``
    such keywords are searched as a blank-separated phrase instead.
    """
    kws = list(keywords)
    single = [k for k in kws if " " not in k]
    cond = F.arrays_overlap(word_tokens(c), F.array(*[F.lit(k) for k in single])) if single else F.lit(False)
    if phrases:
        norm = F.concat(F.lit(" "), F.array_join(word_tokens(c), " "), F.lit(" "))
        for k in kws:
            if " " in k:
                cond = cond | norm.contains(f" {k} ")
    return cond


def severity_filter(c: Column | str, max_len: int = SEVERITY_MAX_LEN,
                    wanted: Iterable[str] = SEVERITY_WANTED,
                    unwanted: Iterable[str] = SEVERITY_UNWANTED) -> Column:
    """Short line, holding a wanted token and no unwanted token.

    Tokens are ``lower(line)`` split on single non-word characters.
    """
    toks = F.split(F.lower(_c(c)), r"\W")
    want = F.arrays_overlap(toks, F.array(*[F.lit(w) for w in wanted]))
    bad = F.arrays_overlap(toks, F.array(*[F.lit(w) for w in unwanted]))
    return (F.length(_c(c)) < max_len) & want & ~bad


def stop_word_filter(word: Column | str, mode: str = "keep",
                     stop_words: Iterable[str] = STOP_WORDS) -> Column:
    """``mode='keep'`` keeps only the stop words (what the reference's job
    does), ``mode='drop'`` removes them (what its comment asks for)."""
    inlist = _c(word).isin(list(stop_words))
    if mode == "keep":
        return inlist
    if mode == "drop":
        return ~inlist
    raise ValueError(f"mode must be 'keep' or 'drop', not {mode!r}")


def stream_word_filter(word: Column | str, banned: Iterable[str] = BANNED_WORDS) -> Column:
    """No ``#`` in the word and not a banned word (case-insensitive)."""
    return ~_c(word).contains("#") & ~F.lower(_c(word)).isin(list(banned))


def hashtag_filter(word: Column | str) -> Column:
    """The word holds a ``#`` anywhere."""
    return _c(word).contains("#")


def first_time(c: Column | str, pattern: str = TIME_PATTERN, default: str | None = "0") -> Column:
    """first ``HH:MM[:SS]`` in the line, else ``default`` (``"0"`` as in the
    reference; pass ``None`` for a NULL)."""
    m = F.regexp_extract(_c(c), pattern, 0)
    hit = F.when(m != "", m)
    return hit if default is None else F.coalesce(hit, F.lit(default))


# The shaping functions below take a line, or (``toks=``) its tokens already
# computed with :func:`tokens`, so several shapes of one line split it once.

def _toks(c, toks):
    return toks if toks is not None else tokens(c)


def _tail(t: Column, n: int) -> Column:
    return F.slice(t, n + 1, F.greatest(F.size(t) - n, F.lit(0)))


def drop_tokens(c: Column | str | None, n: int, toks: Column | None = None) -> Column:
    """F8: tokens after the first ``n``, re-joined by single blanks ('' when short)."""
    return F.array_join(_tail(_toks(c, toks), n), " ")


def stamp_prefix(c: Column | str | None, min_tokens: int = 4, toks: Column | None = None) -> Column:
    """token 1 when the line has at least ``min_tokens`` tokens, else ''."""
    t = _toks(c, toks)
    return F.when(F.size(t) >= min_tokens, F.get(t, 1)).otherwise(F.lit(""))


def shape_severity_line(c: Column | str | None, drop: int = 6, toks: Column | None = None) -> Column:
    """F10 + F8: ``stamp + "> " + tokens[drop:]``."""
    t = _toks(c, toks)
    return F.concat(stamp_prefix(None, toks=t), F.lit("> "), drop_tokens(None, drop, toks=t))


def shape_memory_line(c: Column | str | None, drop: int = 5, toks: Column | None = None) -> Column:
    """F10 + F8: ``stamp + " " + tokens[drop:]``."""
    t = _toks(c, toks)
    return F.concat(stamp_prefix(None, toks=t), F.lit(" "), drop_tokens(None, drop, toks=t))


def stamp_and_tail(c: Column | str | None, first_kept: int = 9, toks: Column | None = None) -> Column:
    """token 1, a blank, then every token from index ``first_kept`` on, each
    followed by one blank."""
    t = _toks(c, toks)
    tail = _tail(t, first_kept)
    return F.concat(F.coalesce(F.get(t, 1), F.lit("")), F.lit(" "), F.array_join(tail, " "),
                    F.when(F.size(tail) > 0, F.lit(" ")).otherwise(F.lit("")))


# A blank-delimited token made only of ASCII letters and not holding "RT"
# (an alphabetic token can hold neither "#" nor "@"); possessive, so a
# failing token is given up without backtracking.
CLEAN_TOKEN = r"(?<![^ ])(?:[a-zA-QS-Z]|R(?!T))++(?![^ ])"


def clean_message(c: Column | str) -> Column:
    """split on single blanks, drop tokens holding ``#``, ``@`` or ``RT``,
    keep purely alphabetic tokens, join with blanks.  One regex pass over the
    text (no per-token lambda, so it stays in generated code)."""
    return F.array_join(F.regexp_extract_all(_c(c), F.lit(CLEAN_TOKEN), 0), " ")


def like_pieces_pattern(pieces: Iterable[str], escape: str = "\\", raw: bool = False) -> str:
    """``%p1%p2%...%`` with ``%``, ``_`` and the escape char escaped inside
    each piece (``raw=True`` keeps them as wildcards, like the reference)."""
    def esc(p: str) -> str:
        if raw:
            return p
        return p.replace(escape, escape * 2).replace("%", escape + "%").replace("_", escape + "_")
    return "%" + "%".join(esc(p) for p in pieces) + "%"


def like_pieces(c: Column | str, pieces: Iterable[str], raw: bool = False) -> Column:
    """True when the pieces occur in order (P11), via SQL ``LIKE ... ESCAPE``."""
    pat = like_pieces_pattern(pieces, raw=raw)
    return F.like(_c(c), F.lit(pat), F.lit("\\")) if not raw else _c(c).like(pat)


def int_div_mean(total: Column, count: Column) -> Column:
    """Integer mean, truncating toward zero, NULL on an empty group."""
    return F.when(count != 0, F.call_function("div", total.cast("bigint"), count.cast("bigint")))


def to_fahrenheit(tenths_celsius: Column) -> Column:
    """tenths of a degree Celsius to Fahrenheit, exact in decimal."""
    dec = tenths_celsius.cast("decimal(18,2)")
    return (dec * F.lit(18).cast("decimal(4,0)") / F.lit(100).cast("decimal(4,0)") + F.lit(32)).cast("decimal(18,4)")


def format_fixed(c: Column | str, places: int = 2, suffix: str = "") -> Column:
    """``f"{x:.2f}{suffix}"`` computed exactly: round half-up in decimal,
    then print the decimal (``format_string('%.2f')`` rounds the binary
    double instead)."""
    dec = F.round(_c(c).cast("decimal(38,10)"), places).cast(f"decimal(38,{places})")
    return F.concat(dec.cast("string"), F.lit(suffix))


def line_timestamp(c: Column | str, year: int, pattern: str = "MM-dd HH:mm:ss.SSS") -> Column:
    """The stamp a log line begins with as a timestamp (session time zone); NULL when it is not one.

    The stamp has as many characters as ``pattern`` and no year."""
    line = F.col(c) if isinstance(c, str) else c
    return F.try_to_timestamp(F.concat(F.lit(f"{year:04d} "), F.substring(line, 1, len(pattern))), F.lit(f"yyyy {pattern}"))
