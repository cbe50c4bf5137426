"""Driver tables and the frames derived from them.

The driver's tables stand in for the reference's inputs:

* ratings  – user = ``o_custkey``, item = ``l_suppkey`` (or ``l_partkey``),
  rating = ``l_quantity``;
* log lines – one line per ``events`` row:
  ``MM-dd HH:mm:ss.SSS user_id event_type props``;
* text lines – ``documents.text`` split on newlines, numbered from 0;
* graph – chain edges: each order line points to the part of the next line of
  the same order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    line = F.concat_ws(" ", F.date_format("ts", "MM-dd"), F.date_format("ts", "HH:mm:ss.SSS"),
                       F.col("user_id").cast("string"), "event_type", "props")
    return ev.select("event_id", "ts", "event_type", line.alias("line"))


EVENT_LINES_SQL = """(SELECT event_id, ts, event_type,
    concat_ws(' ', strftime(ts, '%m-%d'), strftime(ts, '%H:%M:%S.%g'),
              CAST(user_id AS VARCHAR), event_type, props) AS line
  FROM events)"""


def doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


DOC_LINES_SQL = """(SELECT doc_id, CAST(generate_subscripts(arr, 1) - 1 AS INTEGER) AS line_no,
    unnest(arr) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS arr FROM documents))"""


def ratings(spark: SparkSession, sf_dir: str, item: str = "l_suppkey") -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", item, "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .select(F.col("o_custkey").alias("user_id"), F.col(item).alias("item_id"),
                    F.col("l_quantity").alias("rating")))


RATINGS_SQL = """(SELECT o.o_custkey AS u, l.l_suppkey AS i, l.l_quantity AS x
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey)"""


def chain_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edge per pair of consecutive order lines.  The join key includes the line
    number, so even a huge order spreads over many join keys."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    a = li.select(F.col("l_orderkey").alias("o"), (F.col("l_linenumber") + 1).alias("ln"),
                  F.col("l_partkey").alias("src"), F.col("l_linenumber").alias("src_line"))
    b = li.select(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("ln"),
                  F.col("l_partkey").alias("dst"))
    return a.join(b, ["o", "ln"]).select("src", "dst", "o", "src_line")


CHAIN_EDGES_SQL = """(SELECT a.l_partkey AS src, b.l_partkey AS dst
  FROM lineitem a JOIN lineitem b
    ON b.l_orderkey = a.l_orderkey AND b.l_linenumber = a.l_linenumber + 1)"""
