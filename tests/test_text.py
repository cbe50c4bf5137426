"""Column functions: tokenising, filters, shaping, hashing."""

import pytest
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.functions.ids import hash23


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "v string").select(expr.alias("x")).first()["x"]


def java_hash23(s: str) -> int:
    h = 0
    for ch in s:
        h = (h * 31 + ord(ch)) & 0xFFFFFFFF
    return h & 0x7FFFFF


def test_first_time(spark):
    assert one(spark, "no time here", T.first_time("v")) == "0"
    assert one(spark, "no time here", T.first_time("v", default=None)) is None
    assert one(spark, "at 12:34 only", T.first_time("v")) == "12:34"
    assert one(spark, "x 01:02:03 then 04:05:06", T.first_time("v")) == "01:02:03"


def test_drop_tokens_and_shapes(spark):
    line = "01-02 12:34:56.789 p t W tag: Error reading x"
    assert one(spark, line, T.drop_tokens("v", 3)) == "t W tag: Error reading x"
    assert one(spark, "a b", T.drop_tokens("v", 3)) == ""
    assert one(spark, line, T.shape_severity_line("v")) == "12:34:56.789> Error reading x"
    assert one(spark, line, T.shape_memory_line("v")) == "12:34:56.789 tag: Error reading x"
    assert one(spark, "a b c", T.shape_severity_line("v")) == "> "
    big = "01-02 12:34:56.1 a b c d e f g data more"
    assert one(spark, big, T.stamp_and_tail("v")) == "12:34:56.1 data more "


def test_keyword_filter_case_punctuation_phrase(spark):
    assert one(spark, "Boot: Error: disk", T.keyword_filter("v")) is True
    assert one(spark, "errors everywhere", T.keyword_filter("v")) is False
    assert one(spark, "Total Reboots: 3", T.keyword_filter("v", ["total reboots"])) is False
    assert one(spark, "Total Reboots: 3", T.keyword_filter("v", ["total reboots"], phrases=True)) is True


def test_severity_filter_length_edge(spark):
    base = "warning: "
    line209 = base + "x" * (209 - len(base))
    line210 = base + "x" * (210 - len(base))
    assert one(spark, line209, T.severity_filter("v")) is True
    assert one(spark, line210, T.severity_filter("v")) is False
    assert one(spark, "ERROR then info", T.severity_filter("v")) is False


def test_clean_message(spark):
    msg = "RT @a good morning #sun Friday x1 ok"
    assert one(spark, msg, T.clean_message("v")) == "good morning Friday ok"
    edge = "ART R TR aRTb  two\nlines end. Rx RRT ok"
    want = " ".join(w for w in edge.split(" ")
                    if w.isascii() and w.isalpha() and "RT" not in w)
    assert one(spark, edge, T.clean_message("v")) == want == "R TR Rx ok"


def test_like_pieces_escape(spark):
    assert one(spark, "a_b then c%d", T.like_pieces("v", ["a_b", "c%d"])) is True
    assert one(spark, "axb then cxd", T.like_pieces("v", ["a_b", "c%d"])) is False
    assert one(spark, "axb then cxd", T.like_pieces("v", ["a_b", "c%d"], raw=True)) is True
    assert one(spark, "c%d a_b", T.like_pieces("v", ["a_b", "c%d"])) is False   # order matters


def test_stop_and_stream_filters(spark):
    df = spark.createDataFrame([(w,) for w in ["the", "cat", "#tag", "RT", "", "La"]], "w string")
    keep = {r.w for r in df.where(T.stop_word_filter("w", "keep")).collect()}
    drop = {r.w for r in df.where(T.stop_word_filter("w", "drop")).collect()}
    assert keep == {"the"} and drop == {"cat", "#tag", "RT", "", "La"}
    stream = {r.w for r in df.where(T.stream_word_filter("w")).collect()}
    assert stream == {"cat"}
    tags = {r.w for r in df.where(T.hashtag_filter("w")).collect()}
    assert tags == {"#tag"}
    with pytest.raises(ValueError):
        T.stop_word_filter("w", "other")


@pytest.mark.parametrize("s", ["", "a", "Maple", "Customer#000000001", "Ünïcode ßtring", "x" * 300,
                               "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"])
def test_hash23_equals_java(spark, s):
    assert one(spark, s, hash23("v")) == java_hash23(s)


def test_int_mean_truncates(spark):
    df = spark.createDataFrame([("a", 3), ("a", 4), ("b", 5)], "k string, v int")
    from quarry.operators.relational import int_mean_by
    got = {r.k: r.int_mean for r in int_mean_by(df, "k", "v").collect()}
    assert got == {"a": 3, "b": 5}


def test_format_fixed_rounds_half_up(spark):
    df = spark.createDataFrame([(1.005,), (32.045,), (-0.125,)], "v double")
    got = [r.x for r in df.select(T.format_fixed(F.col("v").cast("decimal(10,3)"), 2, " F").alias("x")).collect()]
    assert got == ["1.01 F", "32.05 F", "-0.13 F"]


def test_tokens_follow_java_split(spark):
    assert one(spark, " a b c d e f g h ", T.tokens("v")) == ["", "a", "b", "c", "d", "e", "f", "g", "h"]
    assert one(spark, " a b c d e f g h", T.stamp_prefix("v")) == "a"
    assert one(spark, "a  b c  d  ", T.tokens("v", " ")) == ["a", "", "b", "c", "", "d"]
    assert one(spark, "a b", T.tokens("v")) == ["a", "b"]


def test_line_timestamp_is_permissive(spark):
    rows = [("01-31 23:59:58.123 x",), ("13-45 00:00:00.000 x",), ("02-30 00:00:00.000",), ("short",), (None,), ("",)]
    df = spark.createDataFrame(rows, "line string")
    got = [r.t for r in df.select(T.line_timestamp("line", 2024).cast("string").alias("t")).collect()]
    assert got == ["2024-01-31 23:59:58.123", None, None, None, None, None]
