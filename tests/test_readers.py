"""Readers and sinks on small files shaped like FIXTURES.md."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from quarry.sources import readers, sinks


def test_weather_positional_and_modes(spark, write_file):
    p = write_file("1800.csv", "ST001,20240101,TMIN,-75,,\nST001,20240102,TMAX,12\n"
                               "\nST002,20240101,TMIN,abc\nST003,20240101\n")
    df = readers.read_weather(spark, p, mode="permissive")
    rows = sorted((r.station, r.entry_type, r.value) for r in df.collect())
    # blank line skipped, extra trailing fields ignored, bad number and short row -> NULL
    assert rows == sorted([("ST001", "TMIN", -75), ("ST001", "TMAX", 12),
                           ("ST002", "TMIN", None), ("ST003", None, None)], key=lambda r: (r[0], r[1] or ""))
    rej = readers.count_rejects(df, ["entry_type", "value"]).first()["rejects"]
    assert rej == 2
    with pytest.raises(Exception):
        readers.read_weather(spark, p, mode="strict").collect()


def test_people_and_purchases(spark, write_file):
    p = write_file("fakefriends.csv", "0,Ana,33,385\n1,Bo,19,2\n2,Cy,13,100\n")
    people = readers.read_people(spark, p)
    assert people.columns == ["id", "name", "age", "num_friends"]
    assert people.where("age >= 13 AND age <= 19").count() == 2
    q = write_file("purchases.csv", "44,8602,37.19\n44,1,0.01\n3,2,10.50\n")
    pur = readers.read_purchases(spark, q)
    assert dict(pur.dtypes)["amount"] == "decimal(18,2)"
    tot = {r.customer_id: r.t for r in pur.groupBy("customer_id").agg(F.sum("amount").alias("t")).collect()}
    assert str(tot[44]) == "37.20" and str(tot[3]) == "10.50"


def test_ratings_tsv_trailing_fields(spark, write_file):
    p = write_file("u.data", "196\t242\t3\t881250949\n186\t302\t3\t891717742\n196\t242\t5\t1\n")
    r = readers.read_ratings(spark, p)
    assert r.columns == ["user_id", "item_id", "rating"]
    assert r.where("user_id = 196").count() == 2


def test_pipe_names_bad_utf8_short_rows_last_wins(spark, write_file):
    content = (b"1|First item (1995)|x\n"
               b"2|Caf\xe9 broken|y\n"
               b"short\n"
               b"1|Second name|z\n")
    p = write_file("u.item", content)
    names = {r.item_id: r.name for r in readers.read_pipe_names(spark, p).collect()}
    assert names[1] == "Second name"          # duplicate id: last line wins
    assert "�" in names[2]               # malformed byte replaced, row kept
    assert set(names) == {1, 2}               # short row skipped


def test_quoted_names(spark, write_file):
    p = write_file("names.txt", '14 "ADAM"\n 15 "EVE ROSE"\nno quote here\n14 "ADAM 2"\n')
    names = {r.id: r.name for r in readers.read_quoted_names(spark, p).collect()}
    assert names == {14: "ADAM 2", 15: "EVE ROSE"}


def test_adjacency_multi_line_and_blanks(spark, write_file):
    p = write_file("graph.txt", "5988 748 1722 3752\n5988  12 \n\n12 5988\n7\n")
    deg = {r.vertex: r.degree for r in readers.line_degrees(spark, p).collect()}
    # a vertex spanning two lines sums its degrees; double/trailing blanks ignored
    assert deg == {5988: 4, 12: 1, 7: 0}
    edges = readers.read_edges(spark, p)
    assert edges.where("src = 5988").count() == 4


def test_labeled_points(spark, write_file):
    p = write_file("regression.txt", "-1.74,1.66\n1.24,-1.18\n")
    df = readers.read_labeled_points(spark, p)
    rows = df.collect()
    assert [r.label for r in rows] == [-1.74, 1.24]
    assert list(rows[0].features) == [1.66]


def test_json_explicit_schema(spark, write_file):
    p = write_file("review.json", '{"user_id":"u1","business_id":"b1","stars":4.0,"extra":1}\n'
                                  '{"user_id":"u2","business_id":"b1","stars":2}\n')
    df = readers.read_json(spark, p, readers.REVIEW_SCHEMA)
    assert df.columns == ["user_id", "business_id", "stars"]
    assert df.agg(F.avg("stars")).first()[0] == 3.0
    with pytest.raises(ValueError):
        readers.read_json(spark, p)


def test_write_text_single_file_and_codec(spark, tmp_path):
    df = spark.range(100).select(F.col("id").cast("string").alias("v"))
    out = str(tmp_path / "single")
    sinks.write_text(df, out, single_file=True, compression="gzip")
    parts = [f for f in os.listdir(out) if f.startswith("part-")]
    assert len(parts) == 1 and parts[0].endswith(".gz")
    with gzip.open(os.path.join(out, parts[0]), "rt") as fh:
        assert len(fh.read().splitlines()) == 100
    # overwrite replaces
    sinks.write_text(df.limit(3), out)
    assert spark.read.text(out).count() == 3


def test_batch_dirs_upsert(spark, tmp_path):
    base = str(tmp_path / "batches")
    w = sinks.batch_dirs_writer(base)
    w(spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int"), 0)
    w(spark.createDataFrame([("a", 5)], "k string, n int"), 1)
    w(spark.createDataFrame([("a", 5)], "k string, n int"), 1)   # retried batch: idempotent
    got = {r.k: r.n for r in sinks.read_batch_dirs(spark, base, ["k"]).collect()}
    assert got == {"a": 5, "b": 2}


def test_strict_lookup_fails_on_missing_key(spark):
    from quarry.operators.joins import lookup
    facts = spark.createDataFrame([(1, 5), (2, 7)], "item_id long, n long")
    dim = spark.createDataFrame([(1, "one")], "id long, name string")
    loose = {r.item_id: r.name for r in lookup(facts, dim, "item_id", "id", ["name"]).collect()}
    assert loose == {1: "one", 2: None}
    bounded = lookup(facts, dim, "item_id", "id", ["name"], df_is_bounded=True)
    assert {r.item_id: r.name for r in bounded.collect()} == loose
    with pytest.raises(Exception, match="no dimension row"):
        lookup(facts, dim, "item_id", "id", ["name"], strict=True).collect()
    ok = lookup(facts.where("item_id = 1"), dim, "item_id", "id", ["name"], strict=True).collect()
    assert ok[0].name == "one"


def test_substring_matches_equals_like(spark):
    from quarry.operators.joins import substring_matches
    hay = spark.createDataFrame([(3124,), (12,), (312,), (7,), (1212,)], "k long")
    needles = spark.createDataFrame([(12,), (3,), (99,)], "id long")
    got = {r.id: r.m for r in substring_matches(hay, "k", needles, "id", "m").collect()}
    want = {n: sum(1 for (h,) in [(3124,), (12,), (312,), (7,), (1212,)] if str(n) in str(h)) for n in (12, 3, 99)}
    assert got == want == {12: 4, 3: 2, 99: 0}


def test_within_seconds_matches_brute_force(spark):
    import datetime as dt
    import random

    from quarry.operators.joins import within_seconds
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    a = [(i, base + dt.timedelta(seconds=rnd.randint(0, 3000), microseconds=rnd.randint(0, 999999)))
         for i in range(120)]
    b = [(j, base + dt.timedelta(seconds=rnd.randint(0, 3000))) for j in range(150)]
    b += [(1000, a[0][1] + dt.timedelta(seconds=60)), (1001, a[0][1] - dt.timedelta(seconds=60)),
          (1002, a[0][1] + dt.timedelta(seconds=60, microseconds=1))]     # both edges in, just past out
    A = spark.createDataFrame(a, "a_id long, a_ts timestamp_ntz")
    B = spark.createDataFrame(b, "b_id long, b_ts timestamp_ntz")
    got = {(r.a_id, r.b_id) for r in within_seconds(A, B, "a_ts", "b_ts", 60, [F.col("a_id"), F.col("b_id")]).collect()}
    want = {(i, j) for i, ta in a for j, tb in b if abs((tb - ta).total_seconds()) <= 60}
    assert got == want
    assert (0, 1000) in got and (0, 1001) in got and (0, 1002) not in got


def test_publish_text_makes_one_file(spark, tmp_path):
    from quarry.sources.sinks import publish_text
    path = tmp_path / "out.txt"
    for n in (5000, 0, 3):  # replaced each time
        publish_text(spark.range(n).repartition(4).orderBy("id"), str(path))
        assert path.is_file() and path.read_text().split() == [str(i) for i in range(n)]
    publish_text(spark.range(100).repartition(3), str(tmp_path / "out.gz"), compression="gzip")
    assert spark.read.text(str(tmp_path / "out.gz")).count() == 100
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")) == ["out.gz", "out.txt"]
