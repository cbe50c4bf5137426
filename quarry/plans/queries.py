"""Named queries over the driver tables, each with its DuckDB oracle SQL.

Every query reads whole tables (or frames Spark derives from them); limits
appear only where the feature is a top-k.  Column names and types are aligned
with the oracle: counts are bigint, money is decimal, cosine scores are
rounded to 9 places.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.functions.arrays import array_stats, label_map
from quarry.functions.ids import hash23
from quarry.operators import graph, joins, positional, recommend, regression, relational, similarity
from quarry.plans.tables import (CHAIN_EDGES_SQL, DOC_LINES_SQL, EVENT_LINES_SQL, RATINGS_SQL,
                                 chain_edges, doc_lines, event_lines, ratings, table)
from quarry.session import scratch_path
from quarry.sources import readers, sinks
from quarry.streaming import windows

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def reg(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return reg


# Query parameters (ours; the reference's own constants live next to the operators).
HISTORY_CUSTOMER = 1
SIMILAR_ITEM = 1
SIMILAR_MIN_SCORE = 0.75
SIMILAR_MIN_PAIRS = 250
NTH_HIT = 103
CORRELATE_WINDOW_S = 60
ALS_USER = 1
EVENT_TYPE = "purchase"
LIKE_PIECES = ["the", "of", "and"]
SUBSTRING = "###"
DOC_STREAM_WINDOW_S = 300
DOC_STREAM_SLIDE_S = 60
TOPK_WINDOW_S = 300
TOPK_SLIDE_S = 60

desc, asc = F.desc, F.asc


# ---------------------------------------------------------------------------
# 1. relational core
# ---------------------------------------------------------------------------
def _item_counts(spark, d):
    li = table(spark, d, "lineitem")
    return relational.count_by(li, F.col("l_partkey").alias("item_id"))


def _top_items(spark, d, k=10):
    return relational.top_k(_item_counts(spark, d), k, [desc("n"), asc("item_id")])


TOP_ITEMS_SQL = """(SELECT l_partkey AS item_id, count(*) AS n FROM lineitem
  GROUP BY l_partkey ORDER BY n DESC, item_id LIMIT 10)"""


@query("q01_popular_items", f"""
SELECT c.item_id, p.p_name AS name, c.n
FROM {TOP_ITEMS_SQL} c LEFT JOIN part p ON p.p_partkey = c.item_id""")
def q01(spark, d):
    top = _top_items(spark, d)
    out = joins.lookup(top, table(spark, d, "part"), "item_id", "p_partkey", ["p_name"],
                       df_is_bounded=True)
    return out.select("item_id", F.col("p_name").alias("name"), "n")


@query("q02_popular_items_under", """
SELECT item_id, n FROM (SELECT l_partkey AS item_id, count(*) AS n FROM lineitem GROUP BY l_partkey)
WHERE n < 30 ORDER BY n DESC, item_id LIMIT 10""")
def q02(spark, d):
    _item_counts(spark, d).createOrReplaceTempView("quarry_item_counts")
    return spark.sql("SELECT item_id, n FROM quarry_item_counts WHERE n < :cap ORDER BY n DESC, item_id LIMIT 10",
                     args={"cap": 30})


@query("q03_spend_by_customer", """
SELECT o_custkey AS customer_id,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS spend
FROM orders GROUP BY o_custkey ORDER BY spend DESC, customer_id LIMIT 20""")
def q03(spark, d):
    od = table(spark, d, "orders")
    spend = (od.groupBy(F.col("o_custkey").alias("customer_id"))
             .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(38,2)").alias("spend")))
    return relational.top_k(spend, 20, [desc("spend"), asc("customer_id")])


@query("q04_int_mean", """
SELECT p_brand, CAST(sum(p_size) // count(p_size) AS BIGINT) AS int_mean FROM part GROUP BY p_brand""")
def q04(spark, d):
    return relational.int_mean_by(table(spark, d, "part"), "p_brand", "p_size")


@query("q05_real_mean_join", """
SELECT a.l_partkey AS part_id, p.p_name AS name, round(a.mean_qty, 9) AS mean_qty
FROM (SELECT l_partkey, avg(l_quantity) AS mean_qty FROM lineitem GROUP BY l_partkey
      HAVING avg(l_quantity) > 25) a
JOIN part p ON p.p_partkey = a.l_partkey
WHERE p.p_name LIKE 's%'""")
def q05(spark, d):
    means = relational.having(relational.mean_by(table(spark, d, "lineitem"), "l_partkey",
                                                 "l_quantity", "mean_qty"), F.col("mean_qty") > 25)
    part = table(spark, d, "part").where(F.col("p_name").like("s%"))
    return (means.join(part, means.l_partkey == part.p_partkey)
            .select(F.col("l_partkey").alias("part_id"), F.col("p_name").alias("name"),
                    F.round("mean_qty", 9).alias("mean_qty")))


@query("q06_extreme_by_key", f"""
SELECT user_id, min(f) AS min_f, max(f) AS max_f,
       printf('%.2f F', min(f)) AS min_text, printf('%.2f F', max(f)) AS max_text
FROM (SELECT user_id,
             CAST(round(CAST(value AS DECIMAL(18,2)) * CAST(0.18 AS DECIMAL(4,2)) + 32, 2) AS DECIMAL(18,2)) AS f
      FROM events WHERE event_type = '{EVENT_TYPE}')
GROUP BY user_id""")
def q06(spark, d):
    ev = table(spark, d, "events").where(F.col("event_type") == EVENT_TYPE)
    f = F.round(T.to_fahrenheit(F.col("value")), 2).cast("decimal(18,2)")
    ext = relational.extremes_by(ev.select("user_id", f.alias("f")), "user_id", "f", "min_f", "max_f")
    return ext.select("user_id", "min_f", "max_f",
                      T.format_fixed("min_f", 2, " F").alias("min_text"),
                      T.format_fixed("max_f", 2, " F").alias("max_text"))


@query("q07_sum_all_numeric", """
SELECT p_size, CAST(sum(p_partkey) AS BIGINT) AS sum_p_partkey, CAST(sum(p_size) AS BIGINT) AS sum_p_size,
       round(sum(p_retailprice), 2) AS sum_p_retailprice
FROM part GROUP BY p_size""")
def q07(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_size", "p_retailprice")
    return (relational.sum_all_numeric(part, "p_size")
            .withColumn("sum_p_retailprice", F.round("sum_p_retailprice", 2)))


@query("q08_group_count", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment")
def q08(spark, d):
    return relational.count_by(table(spark, d, "customer"), "c_mktsegment")


@query("q09_project_arith", "SELECT p_partkey, p_name, p_size + 10 AS size_plus_10 FROM part")
def q09(spark, d):
    return table(spark, d, "part").select("p_partkey", "p_name", (F.col("p_size") + 10).alias("size_plus_10"))


@query("q10_where_expr", "SELECT p_partkey, p_name, p_size FROM part WHERE p_size < 21")
def q10(spark, d):
    return table(spark, d, "part").where("p_size < 21").select("p_partkey", "p_name", "p_size")


@query("q11_sql_range", """
SELECT p_partkey, p_name, p_size FROM part WHERE p_size >= 13 AND p_size <= 19 AND p_size <> 19""")
def q11(spark, d):
    table(spark, d, "part").createOrReplaceTempView("quarry_people")
    teens = spark.sql("SELECT p_partkey, p_name, p_size FROM quarry_people WHERE p_size >= :lo AND p_size <= :hi",
                      args={"lo": 13, "hi": 19})
    return teens.filter("p_size != 19")


@query("q12_typed_filter_tag", """
SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, 1 AS tag FROM part WHERE p_size > 40""")
def q12(spark, d):
    part = table(spark, d, "part")
    tagged = part.where(F.col("p_size") > 40).select(F.struct(*part.columns).alias("row"), F.lit(1).alias("tag"))
    return tagged.select("row.*", "tag")


@query("q13_sum_sql_rank", """
SELECT l_suppkey AS supp_id, CAST(sum(l_quantity) AS BIGINT) AS sum_qty
FROM lineitem GROUP BY l_suppkey ORDER BY sum(l_quantity) DESC, supp_id""")
def q13(spark, d):
    table(spark, d, "lineitem").createOrReplaceTempView("quarry_lines")
    return spark.sql("SELECT l_suppkey AS supp_id, CAST(SUM(l_quantity) AS BIGINT) AS sum_qty FROM quarry_lines "
                     "GROUP BY l_suppkey ORDER BY SUM(l_quantity) DESC, supp_id")


@query("q14_top1", """
SELECT c.supp_id, s.s_name AS name, c.n
FROM (SELECT l_suppkey AS supp_id, count(*) AS n FROM lineitem GROUP BY l_suppkey
      ORDER BY n DESC, supp_id LIMIT 1) c
LEFT JOIN supplier s ON s.s_suppkey = c.supp_id""")
def q14(spark, d):
    counts = relational.count_by(table(spark, d, "lineitem"), F.col("l_suppkey").alias("supp_id"))
    top = relational.top_k(counts, 1, [desc("n"), asc("supp_id")])
    out = joins.lookup(top, table(spark, d, "supplier"), "supp_id", "s_suppkey", ["s_name"], df_is_bounded=True)
    return out.select("supp_id", F.col("s_name").alias("name"), "n")


@query("q15_multi_like", f"""
SELECT doc_id, line_no FROM {DOC_LINES_SQL}
WHERE line LIKE '{T.like_pieces_pattern(LIKE_PIECES)}' ESCAPE '\\'""")
def q15(spark, d):
    return doc_lines(spark, d).where(T.like_pieces("line", LIKE_PIECES)).select("doc_id", "line_no")


@query("q16_cast_permissive", """
SELECT event_id, TRY_CAST(replace(split_part(props, ' ', 2), '}', '') AS INTEGER) AS k,
       TRY_CAST(event_type AS INTEGER) AS type_as_int
FROM events""")
def q16(spark, d):
    ev = table(spark, d, "events")
    tok = F.regexp_replace(F.get(F.split("props", " "), 1), "}", "")
    return ev.select("event_id", tok.try_cast("int").alias("k"),
                     F.col("event_type").try_cast("int").alias("type_as_int"))


@query("q17_history", f"""
SELECT o.o_orderkey, l.l_linenumber, l.l_partkey, p.p_name, l.l_quantity
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
LEFT JOIN part p ON p.p_partkey = l.l_partkey
WHERE o.o_custkey = {HISTORY_CUSTOMER}""")
def q17(spark, d):
    od = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    lines = li.join(od, li.l_orderkey == od.o_orderkey)
    hist = recommend.user_history(lines, "o_custkey", HISTORY_CUSTOMER, "l_partkey",
                                  table(spark, d, "part"), "p_partkey", "p_name")
    return hist.select("o_orderkey", "l_linenumber", "l_partkey", "p_name", "l_quantity")


# ---------------------------------------------------------------------------
# 2. text and logs
# ---------------------------------------------------------------------------
def _words(spark, d):
    return table(spark, d, "documents").select(F.explode(F.split(F.lower("text"), r"\W+")).alias("word"))


WORDS_SQL = "(SELECT unnest(regexp_split_to_array(lower(text), '\\W+')) AS word FROM documents)"
STOP_SQL = ", ".join(f"'{w}'" for w in T.STOP_WORDS)


@query("q18_word_count", f"""
SELECT word, count(*) AS n FROM {WORDS_SQL} WHERE word IN ({STOP_SQL})
GROUP BY word ORDER BY n, word LIMIT 30""")
def q18(spark, d):
    w = _words(spark, d).where(T.stop_word_filter("word", "keep"))
    return relational.top_k(relational.count_by(w, "word"), 30, [asc("n"), asc("word")])


@query("q19_word_count_drop", f"""
SELECT word, count(*) AS n FROM {WORDS_SQL} WHERE word NOT IN ({STOP_SQL}) AND word <> ''
GROUP BY word ORDER BY n DESC, word LIMIT 30""")
def q19(spark, d):
    w = _words(spark, d).where(T.stop_word_filter("word", "drop") & (F.col("word") != ""))
    return relational.top_k(relational.count_by(w, "word"), 30, [desc("n"), asc("word")])


TIME_SQL = f"coalesce(nullif(regexp_extract(line, '{T.TIME_PATTERN}', 0), ''), '0')"


@query("q20_log_lines", f"SELECT event_id, line, {TIME_SQL} AS time_key FROM {EVENT_LINES_SQL}")
def q20(spark, d):
    return event_lines(spark, d).select("event_id", "line", T.first_time("line").alias("time_key"))


def _toks_sql(col: str) -> str:
    return f"string_split_regex(regexp_replace({col}, '\\s+$', '', 'g'), '\\s+')"


@query("q21_message_counts", f"""
SELECT msg, count(*) AS n
FROM (SELECT array_to_string(list_slice(string_split(rtrim(line, ' '), ' '), 4, 1000000), ' ') AS msg FROM {EVENT_LINES_SQL})
GROUP BY msg ORDER BY n DESC, msg LIMIT 10""")
def q21(spark, d):
    msgs = event_lines(spark, d).select(T.drop_tokens(None, 3, toks=T.tokens("line", " ")).alias("msg"))
    return relational.top_k(relational.count_by(msgs, "msg"), 10, [desc("n"), asc("msg")])


KEYWORDS_SQL = ", ".join(f"'{k}'" for k in T.LOG_KEYWORDS)
KEYWORD_HIT_SQL = (f"list_has_any(string_split_regex(regexp_replace(lower(line), '\\W', ' ', 'g'), '\\s+'), "
                   f"[{KEYWORDS_SQL}])")


def _hits(spark, d):
    return event_lines(spark, d).where(T.keyword_filter("line"))


@query("q22_keyword_filter", f"SELECT event_id, line FROM {EVENT_LINES_SQL} WHERE {KEYWORD_HIT_SQL}")
def q22(spark, d):
    return _hits(spark, d).select("event_id", "line")


@query("q23_severity_filter", f"""
SELECT event_id, line FROM {EVENT_LINES_SQL}
WHERE length(line) < {T.SEVERITY_MAX_LEN}
  AND list_has_any(string_split_regex(lower(line), '\\W'), ['error', 'warning'])
  AND NOT list_has_any(string_split_regex(lower(line), '\\W'), ['info'])""")
def q23(spark, d):
    return event_lines(spark, d).where(T.severity_filter("line")).select("event_id", "line")


def _stamp_sql(t: str) -> str:
    return f"(CASE WHEN len({t}) >= 4 THEN {t}[2] ELSE '' END)"


@query("q24_substring_filter", f"""
SELECT doc_id, line_no, {_stamp_sql('t')} || ' ' || array_to_string(t[6:], ' ') AS shaped
FROM (SELECT doc_id, line_no, {_toks_sql('line')} AS t FROM {DOC_LINES_SQL}
      WHERE contains(line, '{SUBSTRING}'))""")
def q24(spark, d):
    lines = doc_lines(spark, d).where(F.col("line").contains(SUBSTRING))
    return lines.select("doc_id", "line_no", T.shape_memory_line("line").alias("shaped"))


@query("q25_one_per_second", f"""
SELECT time_key, arg_min(line, event_id) AS line
FROM (SELECT event_id, line, {TIME_SQL} AS time_key FROM {EVENT_LINES_SQL} WHERE {KEYWORD_HIT_SQL})
GROUP BY time_key""")
def q25(spark, d):
    hits = _hits(spark, d).withColumn("time_key", T.first_time("line"))
    return relational.any_one_by(hits, "time_key", "line", "event_id")


@query("q26_shape_line", f"""
SELECT doc_id, line_no,
       {_stamp_sql('t')} || '> ' || array_to_string(t[7:], ' ') AS severity_shape,
       {_stamp_sql('t')} || ' ' || array_to_string(t[6:], ' ') AS memory_shape,
       coalesce(t[2], '') || ' ' || array_to_string(list_transform(t[10:], lambda x: x || ' '), '') AS stamp_tail
FROM (SELECT doc_id, line_no, {_toks_sql('line')} AS t FROM {DOC_LINES_SQL})""")
def q26(spark, d):
    t = F.col("t")
    return (doc_lines(spark, d).select("doc_id", "line_no", T.tokens("line").alias("t"))
            .select("doc_id", "line_no",
                    T.shape_severity_line(None, toks=t).alias("severity_shape"),
                    T.shape_memory_line(None, toks=t).alias("memory_shape"),
                    T.stamp_and_tail(None, toks=t).alias("stamp_tail")))


@query("q27_nth_line", f"""
SELECT event_id, line FROM (
  SELECT event_id, line, row_number() OVER (ORDER BY event_id) AS rn
  FROM {EVENT_LINES_SQL} WHERE {KEYWORD_HIT_SQL})
WHERE rn = {NTH_HIT}""")
def q27(spark, d):
    return positional.nth_row(_hits(spark, d).select("event_id", "line"), [F.col("event_id")], NTH_HIT)


@query("q28_time_correlate", f"""
SELECT event_id, line FROM (SELECT event_id, line, substr({TIME_SQL}, 1, 5) AS minute
                            FROM {EVENT_LINES_SQL} WHERE event_type = '{EVENT_TYPE}')
WHERE minute = (SELECT substr({TIME_SQL}, 1, 5) FROM {EVENT_LINES_SQL} WHERE {KEYWORD_HIT_SQL}
                ORDER BY event_id LIMIT 1 OFFSET {NTH_HIT - 1})""")
def q28(spark, d):
    nth = positional.nth_row(_hits(spark, d).select("event_id", "line"), [F.col("event_id")], NTH_HIT)
    key = nth.select(F.substring(T.first_time("line"), 1, 5).alias("minute"))
    b = (event_lines(spark, d).where(F.col("event_type") == EVENT_TYPE)
         .withColumn("minute", F.substring(T.first_time("line"), 1, 5)))
    return joins.scalar_join(b, key, "minute").select("event_id", "line")


@query("q29_time_window_correlate", f"""
SELECT a.event_id AS a_id, b.event_id AS b_id
FROM events a JOIN events b
  ON b.ts BETWEEN a.ts - INTERVAL {CORRELATE_WINDOW_S} SECOND AND a.ts + INTERVAL {CORRELATE_WINDOW_S} SECOND
WHERE a.event_type = 'error' AND b.event_type = '{EVENT_TYPE}'""")
def q29(spark, d):
    ev = table(spark, d, "events")
    a = ev.where(F.col("event_type") == "error").select(F.col("event_id").alias("a_id"), F.col("ts").alias("a_ts"))
    b = ev.where(F.col("event_type") == EVENT_TYPE).select(F.col("event_id").alias("b_id"), F.col("ts").alias("b_ts"))
    return joins.within_seconds(a, b, "a_ts", "b_ts", CORRELATE_WINDOW_S, [F.col("a_id"), F.col("b_id")])


@query("q30_clean_text", """
SELECT doc_id, cleaned, length(cleaned) AS clean_len
FROM (SELECT doc_id, array_to_string(list_filter(string_split(text, ' '),
        lambda x: NOT (contains(x, '#') OR contains(x, '@') OR contains(x, 'RT'))
             AND regexp_full_match(x, '[a-zA-Z]+')), ' ') AS cleaned
      FROM documents)
WHERE length(cleaned) > 0""")
def q30(spark, d):
    docs = table(spark, d, "documents").select("doc_id", T.clean_message("text").alias("cleaned"))
    return (docs.where(F.length("cleaned") > 0)
            .select("doc_id", "cleaned", F.length("cleaned").cast("bigint").alias("clean_len")))


# ---------------------------------------------------------------------------
# 3. similarity
# ---------------------------------------------------------------------------
SCORE_SQL = ("CASE WHEN sqrt(sum(x*x)) * sqrt(sum(y*y)) <> 0 "
             "THEN sum(x*y) / (sqrt(sum(x*x)) * sqrt(sum(y*y))) ELSE 0 END")


@query("q31_similarity_all", f"""
WITH r AS {RATINGS_SQL}
SELECT a.i AS item1, b.i AS item2, round({SCORE_SQL}, 9) AS score, count(*) AS n
FROM (SELECT u, i, x FROM r) a JOIN (SELECT u, i, x AS y FROM r) b ON a.u = b.u AND a.i < b.i
GROUP BY a.i, b.i""")
def q31(spark, d):
    sims = similarity.item_similarity(ratings(spark, d), "user_id", "item_id", "rating")
    return sims.select("item1", "item2", F.round("score", 9).alias("score"), "n")


@query("q32_similar_to_item", f"""
WITH r AS {RATINGS_SQL},
s AS (SELECT b.i AS other, {SCORE_SQL} AS score, count(*) AS n
      FROM (SELECT u, x FROM r WHERE i = {SIMILAR_ITEM}) a
      JOIN (SELECT u, i, x AS y FROM r WHERE i <> {SIMILAR_ITEM}) b ON a.u = b.u
      GROUP BY b.i)
SELECT s.other, sp.s_name AS name, round(s.score, 9) AS score, s.n
FROM (SELECT * FROM s WHERE score > {SIMILAR_MIN_SCORE} AND n > {SIMILAR_MIN_PAIRS}
      ORDER BY score DESC, n DESC, other LIMIT 10) s
LEFT JOIN supplier sp ON sp.s_suppkey = s.other""")
def q32(spark, d):
    top = similarity.similar_to_item(ratings(spark, d), "user_id", "item_id", "rating", SIMILAR_ITEM,
                                     SIMILAR_MIN_SCORE, SIMILAR_MIN_PAIRS, 10)
    named = joins.lookup(top, table(spark, d, "supplier"), "other", "s_suppkey", ["s_name"], df_is_bounded=True)
    return named.select("other", F.col("s_name").alias("name"), F.round("score", 9).alias("score"), "n")


@query("q33_similarity_string_ids", f"""
WITH r AS (SELECT trim(c.c_name) AS u, trim(s.s_name) AS i, l.l_quantity AS x
           FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
           JOIN customer c ON c.c_custkey = o.o_custkey
           JOIN supplier s ON s.s_suppkey = l.l_suppkey)
SELECT a.i AS item1, b.i AS item2, round({SCORE_SQL}, 9) AS score, count(*) AS n
FROM (SELECT u, i, x FROM r) a JOIN (SELECT u, i, x AS y FROM r) b ON a.u = b.u AND a.i < b.i
GROUP BY a.i, b.i""")
def q33(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    od = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    cu = _numbered(table(spark, d, "customer"), "c_custkey", "c_name", "user_no")
    su = _numbered(table(spark, d, "supplier"), "s_suppkey", "s_name", "business_no")
    # ids in the order of the names stand for them until the pairs are aggregated
    r = (li.join(od, li.l_orderkey == od.o_orderkey)
         .join(cu, F.col("o_custkey") == cu.c_custkey)
         .join(su, F.col("l_suppkey") == su.s_suppkey)
         .select("user_no", "business_no", F.col("l_quantity").alias("stars")))
    sims = similarity.item_similarity(r, "user_no", "business_no", "stars")
    names = su.select("business_no", "name").distinct()
    first = names.select(F.col("business_no").alias("item1"), F.col("name").alias("name1"))
    second = names.select(F.col("business_no").alias("item2"), F.col("name").alias("name2"))
    return (sims.join(first, "item1").join(second, "item2")
            .select(F.col("name1").alias("item1"), F.col("name2").alias("item2"), F.round("score", 9).alias("score"), "n"))


def _numbered(dim, key, name, id_col):
    """``(key, name, id)``: a long id for every distinct trimmed name, in name order."""
    named = dim.select(key, F.trim(name).alias("name"))
    return named.join(positional.dense_ids(named, "name", id_col), "name")


# ---------------------------------------------------------------------------
# 4. graph
# ---------------------------------------------------------------------------
@query("q34_degree_rank", """
WITH s AS (SELECT l_orderkey, count(*) AS c FROM lineitem GROUP BY l_orderkey),
d AS (SELECT l.l_partkey AS vertex, CAST(sum(s.c - 1) AS BIGINT) AS degree
      FROM lineitem l JOIN s ON s.l_orderkey = l.l_orderkey
      GROUP BY l.l_partkey ORDER BY degree DESC, vertex LIMIT 10)
SELECT d.vertex, p.p_name AS name, d.degree FROM d LEFT JOIN part p ON p.p_partkey = d.vertex""")
def q34(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    sizes = relational.count_by(li, "l_orderkey", "c")
    deg = (li.join(sizes, "l_orderkey")
           .groupBy(F.col("l_partkey").alias("vertex"))
           .agg(F.sum(F.col("c") - 1).cast("bigint").alias("degree")))
    top = relational.top_k(deg, 10, [desc("degree"), asc("vertex")])
    out = joins.lookup(top, table(spark, d, "part"), "vertex", "p_partkey", ["p_name"], df_is_bounded=True)
    return out.select("vertex", F.col("p_name").alias("name"), "degree")


START_SQL = f"(SELECT src FROM {CHAIN_EDGES_SQL} GROUP BY src ORDER BY count(*) DESC, src LIMIT 1)"
TARGET_SQL = (f"(SELECT dst FROM {CHAIN_EDGES_SQL} WHERE dst <> {START_SQL} "
              f"GROUP BY dst ORDER BY count(*) DESC, dst LIMIT 1)")
BFS_SQL = f"""WITH RECURSIVE e AS {CHAIN_EDGES_SQL},
bfs(vertex, d) AS (
  SELECT (SELECT * FROM {START_SQL}), 0
  UNION
  SELECT e.dst, bfs.d + 1 FROM bfs JOIN e ON e.src = bfs.vertex WHERE bfs.d < 40),
dist AS (SELECT vertex, CAST(min(d) AS INTEGER) AS distance FROM bfs GROUP BY vertex)"""


def _bfs_start(edges):
    return edges.groupBy("src").count().orderBy(desc("count"), asc("src")).limit(1).first()["src"]


def _bfs_start_target(edges):
    start = _bfs_start(edges)
    tgt = (edges.where(F.col("dst") != start).groupBy("dst").count()
           .orderBy(desc("count"), asc("dst")).limit(1).first())
    return start, (tgt["dst"] if tgt else None)


@query("q35_bfs_distances", f"{BFS_SQL}\nSELECT vertex, distance FROM dist")
def q35(spark, d):
    edges = chain_edges(spark, d).select("src", "dst").checkpoint()
    return graph.bfs(edges, _bfs_start(edges)).distances


@query("q36_bfs_target", f"""{BFS_SQL}
SELECT t.vertex AS target, t.distance AS hit_round, count(*) AS hits
FROM dist t JOIN dist f ON f.distance = t.distance - 1
JOIN e ON e.src = f.vertex AND e.dst = t.vertex
WHERE t.vertex = (SELECT * FROM {TARGET_SQL}) AND t.distance > 0
GROUP BY t.vertex, t.distance""")
def q36(spark, d):
    edges = chain_edges(spark, d).select("src", "dst").checkpoint()
    start, target = _bfs_start_target(edges)
    res = graph.bfs(edges, start, target=target)
    return graph.target_report(spark, res, target)


# ---------------------------------------------------------------------------
# 5. windows and streaming
# ---------------------------------------------------------------------------
def _pane_sql(value_sql: str, window_s: int, slide_s: int, keys: str = "event_type",
              source: str = "events", ts: str = "ts") -> str:
    k = window_s // slide_s
    us = slide_s * 1_000_000
    key_sel = f", {keys}" if keys else ""
    return f"""(SELECT unnest(range(pane - {k - 1}, pane + 1)) AS wp{key_sel}, s, c FROM (
      SELECT CAST(floor(epoch_us({ts}) / {us}) AS BIGINT) AS pane{key_sel},
             sum({value_sql}) AS s, count(*) AS c
      FROM {source} GROUP BY ALL))"""


def _window_cols_sql(window_s: int, slide_s: int) -> str:
    us = slide_s * 1_000_000
    return (f"make_timestamp(wp * {us}) AS window_start, "
            f"make_timestamp(wp * {us} + {window_s * 1_000_000}) AS window_end")


SLIDING_COUNTS_SQL = f"""
SELECT {_window_cols_sql(300, 2)}, event_type, CAST(sum(c) AS BIGINT) AS n
FROM {_pane_sql('1', 300, 2)} GROUP BY ALL"""


@query("q37_sliding_counts", SLIDING_COUNTS_SQL)
def q37(spark, d):
    return windows.sliding_counts(table(spark, d, "events"), "ts", ["event_type"],
                                  windows.COUNT_WINDOW_S, windows.COUNT_SLIDE_S)


SLIDING_MEAN_SQL = f"""
SELECT {_window_cols_sql(300, 4)}, CAST(sum(s) AS BIGINT) AS total, CAST(sum(c) AS BIGINT) AS n,
       CAST(sum(s) // sum(c) AS BIGINT) AS int_mean
FROM {_pane_sql('length(props)', 300, 4, keys='')} GROUP BY ALL"""


@query("q38_sliding_mean", SLIDING_MEAN_SQL)
def q38(spark, d):
    return windows.sliding_int_mean(table(spark, d, "events"), "ts", F.length("props"),
                                    windows.MEAN_WINDOW_S, windows.MEAN_SLIDE_S)


WINDOW_TOPK_SQL = f"""
SELECT * FROM (
  SELECT window_start, window_end, event_type, n,
         CAST(row_number() OVER (PARTITION BY window_start ORDER BY n DESC, event_type) AS INTEGER) AS rank
  FROM (SELECT {_window_cols_sql(TOPK_WINDOW_S, TOPK_SLIDE_S)}, event_type, CAST(sum(c) AS BIGINT) AS n
        FROM {_pane_sql('1', TOPK_WINDOW_S, TOPK_SLIDE_S)} GROUP BY ALL))
WHERE rank <= 3"""


@query("q39_window_topk", WINDOW_TOPK_SQL)
def q39(spark, d):
    counts = windows.sliding_counts(table(spark, d, "events"), "ts", ["event_type"], TOPK_WINDOW_S, TOPK_SLIDE_S)
    return windows.window_top_k(counts, 3, "event_type")


# Files of a table that one micro-batch of a back-fill reads.
STREAM_FILES = 1000


@query("q40_stream_vs_batch", SLIDING_COUNTS_SQL)
def q40(spark, d):
    schema = table(spark, d, "events").schema
    stream = windows.table_stream(spark, f"{d.rstrip('/')}/events.parquet", schema, files_per_trigger=STREAM_FILES)
    panes = windows.run_to_table(windows.stream_pane_counts(stream, "ts", ["event_type"], watermark=None),
                                 ["event_type"], "q40")
    return windows.panes_to_windows(panes, ["event_type"], windows.COUNT_WINDOW_S, windows.COUNT_SLIDE_S)


# ---------------------------------------------------------------------------
# 6. learning and ids
# ---------------------------------------------------------------------------
@query("q41_als_recommend")
def q41(spark, d):
    r = ratings(spark, d, item="l_partkey")
    model = recommend.train_als(r, "user_id", "item_id", "rating", ratings_per_block=recommend.SMALL_EXECUTOR_RATINGS)
    users = spark.range(1).select(F.lit(ALS_USER).cast("int").alias("user_id"))
    recs = recommend.recommend_for_users(model, users, 10)
    named = joins.lookup(recs, table(spark, d, "part"), "item", "p_partkey", ["p_name"], df_is_bounded=True)
    return named.select("user", "item", F.col("p_name").alias("name"), "predicted", "rank")


NAMES_SQL = """(SELECT DISTINCT name FROM (SELECT c_name AS name FROM customer UNION ALL
  SELECT p_name FROM part UNION ALL SELECT s_name FROM supplier) WHERE name IS NOT NULL)"""


@query("q42_hash_ids", f"""
SELECT name, h, count(*) OVER (PARTITION BY h) AS same_h FROM (
  SELECT name, CAST(list_reduce(list_transform(string_split(name, ''), lambda ch: CAST(ord(ch) AS BIGINT)),
                                lambda acc, x: (acc * 31 + x) & 8388607, CAST(0 AS BIGINT)) AS INTEGER) AS h
  FROM {NAMES_SQL})""")
def q42(spark, d):
    names = (table(spark, d, "customer").select(F.col("c_name").alias("name"))
             .unionByName(table(spark, d, "part").select(F.col("p_name").alias("name")))
             .unionByName(table(spark, d, "supplier").select(F.col("s_name").alias("name")))
             .where(F.col("name").isNotNull()).distinct())
    hashed = names.select("name", hash23("name").alias("h"))
    per_h = relational.count_by(hashed, "h", "same_h")
    return hashed.join(per_h, "h").select("name", "h", "same_h")


@query("q43_dense_ids", f"""
SELECT name, CAST(dense_rank() OVER (ORDER BY name) - 1 AS BIGINT) AS id FROM {NAMES_SQL}""")
def q43(spark, d):
    names = (table(spark, d, "customer").select(F.col("c_name").alias("name"))
             .unionByName(table(spark, d, "part").select(F.col("p_name").alias("name")))
             .unionByName(table(spark, d, "supplier").select(F.col("s_name").alias("name"))))
    return positional.dense_ids(names, "name", "id")


@query("q44_sgd_weight", f"""
WITH RECURSIVE m AS (
  SELECT CAST(count(*) AS DOUBLE) AS n, sum((l_tax * 10) * (l_tax * 10)) AS sxx,
         sum((l_tax * 10) * l_quantity) AS sxy FROM lineitem),
it(i, w, done) AS (
  SELECT 0, CAST(0 AS DOUBLE), false
  UNION ALL
  SELECT i + 1, nw, (i + 1 >= 2 AND abs(nw - w) < {regression.SGD_TOLERANCE} * greatest(abs(nw), 1.0))
  FROM (SELECT it.i, it.w, it.done,
               it.w * (1 - ({regression.SGD_STEP} / sqrt(it.i + 1)) * {regression.SGD_REG})
               - ({regression.SGD_STEP} / sqrt(it.i + 1)) * (m.sxx * it.w - m.sxy) / m.n AS nw
        FROM it, m) s
  WHERE NOT done AND i < {regression.SGD_ITERATIONS})
SELECT round(w, 6) AS weight, CAST(i AS INTEGER) AS rounds FROM it ORDER BY i DESC LIMIT 1""")
def q44(spark, d):
    li = table(spark, d, "lineitem").select((F.col("l_tax") * 10).alias("x"), F.col("l_quantity").alias("y"))
    w, rounds = regression.sgd_ridge(li, ["x"], "y")
    return spark.createDataFrame([(round(float(w[0]), 6), int(rounds))], "weight double, rounds int")


@query("q45_elastic_net")
def q45(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount",
                                            "l_tax", F.col("l_extendedprice").alias("label"))
    train, test = regression.hash_split(li, ["l_orderkey", "l_linenumber"])
    feats = ["l_quantity", "l_discount", "l_tax"]
    model = regression.elastic_net(regression.assemble(train, feats))
    return regression.predict(model, regression.assemble(test, feats), keep=["l_orderkey", "l_linenumber"])


LABEL_NAMES = ["zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine"]


@query("q46_array_map_ops", f"""
SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n,
       CAST(list_max(embedding) AS DOUBLE) AS max_v, CAST(list_min(embedding) AS DOUBLE) AS min_v,
       round(list_reduce(list_transform(embedding, lambda x: CAST(x AS DOUBLE)), lambda a, b: a + b), 9) AS sum_v,
       CAST(len(list_filter(embedding, lambda x: x > 0)) AS INTEGER) AS n_pos,
       CAST(embedding[-1] AS DOUBLE) AS last_v, CAST(embedding[1] AS DOUBLE) AS head_v,
       CAST(len(embedding[2:]) AS INTEGER) AS tail_n,
       CAST(len(list_distinct(embedding)) AS INTEGER) AS n_distinct,
       list_contains(embedding, embedding[1]) AS has_head,
       CAST(len(list_concat(embedding, list_reverse(embedding))) AS INTEGER) AS n_concat,
       CASE label {' '.join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(LABEL_NAMES))} END AS label_name
FROM embeddings""")
def q46(spark, d):
    emb = table(spark, d, "embeddings")
    m = label_map(list(range(len(LABEL_NAMES))), LABEL_NAMES)
    out = emb.select("vec_id", *array_stats("embedding"), F.try_element_at(m, F.col("label")).alias("label_name"))
    return out.withColumn("sum_v", F.round("sum_v", 9))


# ---------------------------------------------------------------------------
# 7. file formats
# ---------------------------------------------------------------------------
@query("q47_file_round_trip", """
SELECT 'csv' AS fmt, CAST(o_custkey AS BIGINT) AS key, count(*) AS n,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total
FROM orders GROUP BY o_custkey
UNION ALL
SELECT 'tsv', CAST(o.o_custkey AS BIGINT), count(*), CAST(sum(CAST(l.l_quantity AS DECIMAL(18,2))) AS DECIMAL(38,2))
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey GROUP BY o.o_custkey
UNION ALL
SELECT 'json', l_suppkey, count(*), CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DECIMAL(38,2))
FROM lineitem GROUP BY l_suppkey
UNION ALL
SELECT 'pipe', p_partkey, length(p_name), NULL FROM part""")
def q47(spark, d):
    base = scratch_path(spark, "q47")
    od = table(spark, d, "orders")
    li = table(spark, d, "lineitem")
    # CSV purchases: customer_id,item_id,amount
    sinks.write_text(od.select(F.concat_ws(",", F.col("o_custkey").cast("string"),
                                           F.col("o_orderkey").cast("string"),
                                           F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("v")),
                     f"{base}/purchases")
    pur = readers.read_purchases(spark, f"{base}/purchases")
    csv = pur.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"),
                                         F.sum("amount").cast("decimal(38,2)").alias("total"))
    # TSV ratings: user \t item \t rating \t extra
    rt = li.join(od.select("o_orderkey", "o_custkey"), li.l_orderkey == od.o_orderkey)
    sinks.write_text(rt.select(F.concat_ws("\t", F.col("o_custkey").cast("string"), F.col("l_partkey").cast("string"),
                                           F.col("l_quantity").cast("string"), F.lit("0")).alias("v")),
                     f"{base}/ratings", compression="gzip")
    rat = readers.read_ratings(spark, f"{base}/ratings")
    tsv = rat.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"),
                                     F.sum(F.col("rating").cast("decimal(18,2)")).cast("decimal(38,2)").alias("total"))
    # NDJSON reviews
    li.select(F.col("l_orderkey").cast("string").alias("user_id"),
              F.col("l_suppkey").cast("string").alias("business_id"),
              F.col("l_discount").alias("stars")).write.mode("overwrite").json(f"{base}/reviews")
    rev = readers.read_json(spark, f"{base}/reviews", readers.REVIEW_SCHEMA)
    js = rev.groupBy("business_id").agg(F.count(F.lit(1)).alias("n"),
                                        F.sum(F.col("stars").cast("decimal(18,2)")).cast("decimal(38,2)").alias("total"))
    # pipe-separated names
    sinks.write_text(table(spark, d, "part").select(
        F.concat_ws("|", F.col("p_partkey").cast("string"), "p_name", F.lit("x")).alias("v")), f"{base}/names")
    names = readers.read_pipe_names(spark, f"{base}/names")
    pipe = names.select(F.lit("pipe").alias("fmt"), F.col("item_id").cast("bigint").alias("key"),
                        F.length("name").cast("bigint").alias("n"), F.lit(None).cast("decimal(38,2)").alias("total"))
    return (csv.select(F.lit("csv").alias("fmt"), F.col("customer_id").cast("bigint").alias("key"), "n", "total")
            .unionByName(tsv.select(F.lit("tsv").alias("fmt"), F.col("user_id").cast("bigint").alias("key"), "n", "total"))
            .unionByName(js.select(F.lit("json").alias("fmt"), F.col("business_id").cast("bigint").alias("key"), "n", "total"))
            .unionByName(pipe))


DOC_TS_SQL = "(SELECT doc_id, text, make_timestamp(1704067200000000 + doc_id * 1000000) AS ts FROM documents)"
DOC_WORDS_SQL = f"(SELECT ts, unnest(string_split(text, ' ')) AS word FROM {DOC_TS_SQL})"
BANNED_SQL = ", ".join(f"'{w}'" for w in T.BANNED_WORDS)


@query("q48_stream_words", f"""
SELECT {_window_cols_sql(DOC_STREAM_WINDOW_S, DOC_STREAM_SLIDE_S)}, kind, word, CAST(sum(c) AS BIGINT) AS n
FROM {_pane_sql('1', DOC_STREAM_WINDOW_S, DOC_STREAM_SLIDE_S, keys='kind, word',
                source=f'''(SELECT ts, CASE WHEN contains(word, '#') THEN 'hashtag' ELSE 'word' END AS kind, word
                           FROM {DOC_WORDS_SQL}
                           WHERE contains(word, '#') OR lower(word) NOT IN ({BANNED_SQL}))''')}
GROUP BY ALL""")
def q48(spark, d):
    schema = table(spark, d, "documents").schema
    docs = windows.table_stream(spark, f"{d.rstrip('/')}/documents.parquet", schema, files_per_trigger=STREAM_FILES)
    stamped = docs.select(F.timestamp_micros(F.lit(1704067200000000) + F.col("doc_id") * 1_000_000).alias("ts"),
                          "text")
    words = windows.stream_words(stamped, "text", "ts")
    panes = windows.run_to_table(
        windows.stream_pane_counts(words, "ts", ["kind", "word"], slide_s=DOC_STREAM_SLIDE_S, watermark=None),
        ["kind", "word"], "q48")
    return windows.panes_to_windows(panes, ["kind", "word"], DOC_STREAM_WINDOW_S, DOC_STREAM_SLIDE_S)


@query("q49_id_lookup", f"""
SELECT ids.item_id, p.p_name AS name,
       (SELECT count(*) FROM part q
        WHERE CAST(q.p_partkey AS VARCHAR) LIKE '%' || CAST(ids.item_id AS VARCHAR) || '%') AS like_matches
FROM {TOP_ITEMS_SQL} ids LEFT JOIN part p ON p.p_partkey = ids.item_id""")
def q49(spark, d):
    ids = _top_items(spark, d).select("item_id")
    part = table(spark, d, "part")
    named = joins.lookup(ids, part, "item_id", "p_partkey", ["p_name"], df_is_bounded=True)
    legacy = joins.substring_matches(part, "p_partkey", ids, "item_id", "like_matches",
                                     needles_are_bounded=True)
    return (named.join(F.broadcast(legacy), "item_id", "left")
            .select("item_id", F.col("p_name").alias("name"), "like_matches"))


@query("q50_numbered_topk", f"""
SELECT CAST(row_number() OVER (ORDER BY c.n DESC, c.item_id) AS INTEGER) AS rank, c.item_id, p.p_name AS name, c.n
FROM {TOP_ITEMS_SQL} c LEFT JOIN part p ON p.p_partkey = c.item_id""")
def q50(spark, d):
    top = relational.numbered_top_k(_item_counts(spark, d), 10, [desc("n"), asc("item_id")])
    out = joins.lookup(top, table(spark, d, "part"), "item_id", "p_partkey", ["p_name"], df_is_bounded=True)
    return out.select("rank", "item_id", F.col("p_name").alias("name"), "n")


@query("q51_graph_from_text", f"""
SELECT dg.vertex, p.p_name AS name, dg.degree
FROM (SELECT src AS vertex, count(*) AS degree FROM {CHAIN_EDGES_SQL} GROUP BY src
      ORDER BY degree DESC, vertex LIMIT 10) dg
LEFT JOIN part p ON p.p_partkey = dg.vertex""")
def q51(spark, d):
    base = scratch_path(spark, "q51")
    edges = chain_edges(spark, d)
    sinks.write_text(graph.adjacency_lines(edges, ["o", "src_line"], max_neighbours=50), f"{base}/graph")
    sinks.write_text(table(spark, d, "part").select(
        F.format_string('%d "%s"', "p_partkey", "p_name").alias("v")), f"{base}/names")
    deg = readers.line_degrees(spark, f"{base}/graph")
    top = relational.top_k(deg, 10, [desc("degree"), asc("vertex")])
    names = readers.read_quoted_names(spark, f"{base}/names")
    out = joins.lookup(top, names, "vertex", "id", ["name"], df_is_bounded=True)
    return out.select("vertex", "name", "degree")


@query("q52_weather_extremes", f"""
SELECT CAST(user_id AS VARCHAR) AS station, count(*) AS n,
       min(CAST(CAST(value AS DECIMAL(18,2)) * 100 AS INTEGER)) AS min_value,
       max(CAST(CAST(value AS DECIMAL(18,2)) * 100 AS INTEGER)) AS max_value
FROM events WHERE event_type = '{EVENT_TYPE}' GROUP BY user_id""")
def q52(spark, d):
    """Weather lines written from the events, read back, extremes of one entry type per station."""
    path = scratch_path(spark, "q52")
    ev = table(spark, d, "events").select(
        F.col("user_id").cast("string").alias("station"), F.date_format("ts", "yyyyMMdd").alias("day"), "event_type",
        (F.col("value").cast("decimal(18,2)") * 100).cast("int").cast("string").alias("value"), F.lit("").alias("rest"))
    sinks.write_text(ev.select(F.concat_ws(",", *ev.columns)), path)
    weather = readers.read_weather(spark, path).where(F.col("entry_type") == EVENT_TYPE)
    return weather.groupBy("station").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("min_value"),
                                          F.max("value").alias("max_value"))


@query("q53_friends_by_age", """
SELECT p_size AS age, count(*) AS n, CAST(sum(p_partkey % 500) // count(*) AS BIGINT) AS int_mean
FROM part GROUP BY p_size""")
def q53(spark, d):
    """People lines written from the parts, read back, integer mean of friends per age."""
    path = scratch_path(spark, "q53")
    part = table(spark, d, "part").select("p_partkey", "p_brand", "p_size", (F.col("p_partkey") % 500).alias("friends"))
    sinks.write_text(part.select(F.concat_ws(",", *[F.col(c).cast("string") for c in part.columns])), path)
    people = readers.read_people(spark, path)
    return people.groupBy("age").agg(F.count(F.lit(1)).alias("n"),
                                     T.int_div_mean(F.sum("num_friends"), F.count("num_friends")).alias("int_mean"))


@query("q54_scaled_points", """
SELECT l_quantity AS label, count(*) AS n,
       round(min((l_tax - m) / s), 6) AS min_scaled, round(max((l_tax - m) / s), 6) AS max_scaled
FROM lineitem, (SELECT avg(l_tax) AS m, stddev_samp(l_tax) AS s FROM lineitem)
GROUP BY l_quantity""")
def q54(spark, d):
    """Labelled points written from the order lines, read back and scaled."""
    from pyspark.ml.functions import vector_to_array
    path = scratch_path(spark, "q54")
    li = table(spark, d, "lineitem")
    sinks.write_text(li.select(F.concat_ws(",", F.col("l_quantity").cast("string"),
                                           F.concat_ws(" ", F.col("l_tax").cast("string"), F.col("l_discount").cast("string")))), path)
    scaled = regression.scale(readers.read_labeled_points(spark, path))
    x = scaled.select("label", vector_to_array("scaled")[0].alias("x"))
    return x.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.round(F.min("x"), 6).alias("min_scaled"),
                                  F.round(F.max("x"), 6).alias("max_scaled"))


@query("q55_upper_names", "SELECT p_partkey, upper(p_name) AS name FROM part")
def q55(spark, d):
    return table(spark, d, "part").select("p_partkey", F.upper("p_name").alias("name"))


@query("q56_other_of_pair", f"""
WITH r AS {RATINGS_SQL}
SELECT b.i AS other, round({SCORE_SQL}, 9) AS score, count(*) AS n
FROM (SELECT u, x FROM r WHERE i = {SIMILAR_ITEM}) a
JOIN (SELECT u, i, x AS y FROM r WHERE i <> {SIMILAR_ITEM}) b ON a.u = b.u
GROUP BY b.i""")
def q56(spark, d):
    """the partners of one item in the full matrix."""
    sims = similarity.item_similarity(ratings(spark, d), "user_id", "item_id", "rating")
    mine = sims.where((F.col("item1") == SIMILAR_ITEM) | (F.col("item2") == SIMILAR_ITEM))
    return mine.select(similarity.other_of_pair("item1", "item2", SIMILAR_ITEM).alias("other"),
                       F.round("score", 9).alias("score"), "n")


@query("q57_around_nth_hit", f"""
SELECT b.event_id, b.line FROM {EVENT_LINES_SQL} b
WHERE b.event_type = '{EVENT_TYPE}'
  AND abs(epoch_us(b.ts) - (SELECT epoch_us(ts) FROM {EVENT_LINES_SQL} WHERE {KEYWORD_HIT_SQL}
                            ORDER BY event_id LIMIT 1 OFFSET {NTH_HIT - 1})) <= {CORRELATE_WINDOW_S * 1_000_000}""")
def q57(spark, d):
    """The purchases around the n-th keyword hit."""
    nth = positional.nth_row(_hits(spark, d).select("event_id", "ts"), [F.col("event_id")], NTH_HIT)
    b = event_lines(spark, d).where(F.col("event_type") == EVENT_TYPE)
    return joins.around(b, nth, "ts", "ts", CORRELATE_WINDOW_S).select("event_id", "line")


@query("q58_least_squares", """
WITH m AS (SELECT regr_slope(l_extendedprice, l_quantity) AS s, regr_intercept(l_extendedprice, l_quantity) AS i
           FROM lineitem WHERE l_orderkey % 100 < 50)
SELECT l_orderkey, l_linenumber, round(s * l_quantity + i, 1) AS prediction, l_extendedprice AS label
FROM lineitem, m WHERE l_orderkey % 100 >= 50""")
def q58(spark, d):
    """M11-M13, J9 without a penalty: the closed form is known; predictions beside labels of the test half."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.col("l_extendedprice").alias("label"))
    train, test = regression.modulo_split(li, "l_orderkey")
    model = regression.elastic_net(regression.assemble(train, ["l_quantity"]), reg=0.0, mix=0.0)
    out = regression.predict(model, regression.assemble(test, ["l_quantity"]), keep=["l_orderkey", "l_linenumber"])
    return out.withColumn("prediction", F.round("prediction", 1))


@query("q59_als_invariants", """
SELECT CAST(10 AS BIGINT) AS n_items, CAST(10 AS BIGINT) AS n_distinct, true AS in_order, true AS beats_mean""")
def q59(spark, d):
    """M6, M7: ten distinct items in order of their prediction, and a lower error than the mean rating's."""
    r = ratings(spark, d, item="l_partkey").select(F.col("user_id").cast("int").alias("user_id"),
                                                   F.col("item_id").cast("int").alias("item_id"), "rating")
    model = recommend.train_als(r, "user_id", "item_id", "rating", ratings_per_block=recommend.SMALL_EXECUTOR_RATINGS)
    users = spark.range(1).select(F.lit(ALS_USER).cast("int").alias("user_id"))
    recs = recommend.recommend_for_users(model, users, 10)
    ranked = recs.agg(F.count(F.lit(1)).alias("n_items"), F.countDistinct("item").alias("n_distinct"),
                      F.sort_array(F.collect_list(F.struct("rank", "predicted"))).alias("l"))
    drops = F.transform(F.sequence(F.lit(1), F.size("l") - 1), lambda i: F.get("l", i - 1)["predicted"] >= F.get("l", i)["predicted"])
    fit = model.transform(r).agg(
        (F.avg(F.pow(F.col("prediction") - F.col("rating"), 2)) < F.var_pop("rating")).alias("beats_mean"))
    return (ranked.select("n_items", "n_distinct", F.forall(drops, lambda x: x).alias("in_order"))
            .withColumn("beats_mean", fit.scalar()))


@query("q60_stream_sliding_mean", SLIDING_MEAN_SQL)
def q60(spark, d):
    schema = table(spark, d, "events").schema
    stream = windows.table_stream(spark, f"{d.rstrip('/')}/events.parquet", schema, files_per_trigger=STREAM_FILES)
    panes = windows.run_to_table(windows.stream_pane_counts(stream, "ts", [], windows.MEAN_SLIDE_S, watermark=None,
                                                            value=F.length("props")), [], "q60")
    return windows.panes_to_means(panes)


@query("q61_stream_window_topk", WINDOW_TOPK_SQL)
def q61(spark, d):
    schema = table(spark, d, "events").schema
    stream = windows.table_stream(spark, f"{d.rstrip('/')}/events.parquet", schema, files_per_trigger=STREAM_FILES)
    panes = windows.run_to_table(windows.stream_pane_counts(stream, "ts", ["event_type"], TOPK_SLIDE_S, watermark=None),
                                 ["event_type"], "q61")
    counts = windows.panes_to_windows(panes, ["event_type"], TOPK_WINDOW_S, TOPK_SLIDE_S)
    return windows.window_top_k(counts, 3, "event_type")
