"""Similarity and graph operators against brute force on small fixtures."""

import itertools
import math
import random
from collections import defaultdict

from pyspark.sql import functions as F

from quarry.operators import graph, positional, similarity


def brute_similarity(rows):
    """Reference semantics: every pair of raw rows of one user with item1 < item2."""
    by_user = defaultdict(list)
    for u, i, r in rows:
        by_user[u].append((i, r))
    acc = defaultdict(lambda: [0.0, 0.0, 0.0, 0])
    for items in by_user.values():
        for (i1, r1), (i2, r2) in itertools.product(items, items):
            if i1 < i2:
                a = acc[(i1, i2)]
                a[0] += r1 * r1
                a[1] += r2 * r2
                a[2] += r1 * r2
                a[3] += 1
    out = {}
    for k, (xx, yy, xy, n) in acc.items():
        den = math.sqrt(xx) * math.sqrt(yy)
        out[k] = (xy / den if den else 0.0, n)
    return out


def fixture_rows(seed=7, users=30, items=12, per_user=8):
    rnd = random.Random(seed)
    rows = []
    for u in range(users):
        for _ in range(rnd.randint(1, per_user)):
            rows.append((u, rnd.randrange(items), float(rnd.randint(1, 5))))
    rows.append((0, 3, 4.0))       # a user rating one item twice
    rows.append((0, 3, 0.0))
    rows += [(99, 50, 0.0), (99, 51, 0.0)]   # zero rating vectors -> score 0.0
    return rows


def as_dict(df):
    return {(r.item1, r.item2): (r.score, r.n) for r in df.collect()}


def close(a, b):
    return set(a) == set(b) and all(abs(a[k][0] - b[k][0]) < 1e-12 and a[k][1] == b[k][1] for k in a)


def test_similarity_matches_brute_force_and_chunking(spark):
    rows = fixture_rows()
    df = spark.createDataFrame(rows, "u long, i long, r double")
    expect = brute_similarity(rows)
    plain = as_dict(similarity.item_similarity(df, "u", "i", "r", chunk_items=None))
    chunked = as_dict(similarity.item_similarity(df, "u", "i", "r", chunk_items=2))   # every user is "hot"
    assert close(plain, expect)
    assert close(chunked, expect)
    assert plain[(50, 51)] == (0.0, 1)
    assert all(0.0 <= s <= 1.0 + 1e-12 for s, _ in plain.values())


def test_similarity_string_ids_and_single_item_mode(spark):
    rows = [(f"u{u}", f"it_{i}%", r) for u, i, r in fixture_rows(seed=3)]
    df = spark.createDataFrame(rows, "u string, i string, r double")
    full = as_dict(similarity.item_similarity(df, "u", "i", "r"))
    assert close(full, brute_similarity(rows))
    target = "it_3%"
    single = similarity.similar_to_item(df, "u", "i", "r", target, -1.0, 0, k=1000)
    got = {r.other: (r.score, r.n) for r in single.collect()}
    filtered = (similarity.item_similarity(df, "u", "i", "r")
                .where((F.col("item1") == target) | (F.col("item2") == target))
                .select(similarity.other_of_pair("item1", "item2", target).alias("other"), "score", "n"))
    want = {r.other: (r.score, r.n) for r in filtered.collect()}
    assert set(got) == set(want)
    assert all(abs(got[k][0] - want[k][0]) < 1e-12 and got[k][1] == want[k][1] for k in got)


def bfs_brute(edges, start, rounds):
    adj = defaultdict(list)
    for s, d in edges:
        adj[s].append(d)
    dist = {start: 0}
    frontier = [start]
    for r in range(1, rounds + 1):
        nxt = []
        for v in frontier:
            for w in adj[v]:
                if w not in dist:
                    dist[w] = r
                    nxt.append(w)
        frontier = nxt
    return dist


def test_bfs_edge_cases(spark):
    # 1 -> 2, 1 -> 3, both reach 4 in the same round (4 is touched twice);
    # 9 unreachable; 6 sits beyond the round cap.
    edges = [(1, 2), (1, 3), (2, 4), (3, 4), (4, 5), (5, 6), (9, 1), (2, 2)]
    df = spark.createDataFrame(edges, "src long, dst long")
    res = graph.bfs(df, 1, max_rounds=3, target=4)
    assert (res.hit_round, res.hits) == (2, 2)
    full = graph.bfs(df, 1, max_rounds=3)
    got = {r.vertex: r.distance for r in full.distances.collect()}
    assert got == bfs_brute(edges, 1, 3) == {1: 0, 2: 1, 3: 1, 4: 2, 5: 3}
    near = graph.bfs(df, 1, max_rounds=10, target=2)       # target next to the start
    assert (near.hit_round, near.hits) == (1, 1)
    none = graph.bfs(df, 1, max_rounds=10, target=9)
    assert none.hit_round is None


def test_bfs_random_graph_property(spark):
    rnd = random.Random(11)
    und = {(rnd.randrange(60), rnd.randrange(60)) for _ in range(90)}
    edges = sorted(und | {(b, a) for a, b in und})
    df = spark.createDataFrame(edges, "src long, dst long")
    got = {r.vertex: r.distance for r in graph.bfs(df, 0, max_rounds=10).distances.collect()}
    assert got == bfs_brute(edges, 0, 10)
    for a, b in edges:   # BFS layering on undirected edges
        if a in got and b in got and got[a] < 10 and got[b] < 10:
            assert abs(got[a] - got[b]) <= 1


def test_adjacency_lines_round_trip(spark, tmp_path):
    rows = [(1, d, i) for i, d in enumerate(range(100, 130))] + [(2, 7, 99)]
    edges = spark.createDataFrame(rows, "src long, dst long, k long")
    lines = graph.adjacency_lines(edges, ["k"], max_neighbours=8)
    texts = [r.value for r in lines.collect()]
    assert max(len(t.split()) - 1 for t in texts) <= 16        # hub spread over several lines
    assert sum(1 for t in texts if t.startswith("1 ")) >= 4
    out = str(tmp_path / "adj")
    lines.write.text(out)
    from quarry.sources.readers import line_degrees
    deg = {r.vertex: r.degree for r in line_degrees(spark, out).collect()}
    assert deg == {1: 30, 2: 1}


def test_global_index_and_nth(spark):
    rnd = random.Random(5)
    vals = rnd.sample(range(10_000), 500)
    df = spark.createDataFrame([(v,) for v in vals], "v long")
    idx = {r.v: r.idx for r in positional.with_global_index(df, [F.col("v")], "idx", partitions=7).collect()}
    assert idx == {v: i for i, v in enumerate(sorted(vals))}
    small = positional.nth_row(df, [F.col("v")], 123).first().v
    large = positional.nth_row(df, [F.col("v")], 123, heap_rows=10).first().v
    assert small == large == sorted(vals)[122]
    assert positional.nth_row(df, [F.col("v")], 501).count() == 0
    assert positional.nth_row(df, [F.col("v")], 501, heap_rows=10).count() == 0
    names = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("c",)], "s string")
    ids = {r.s: r.id for r in positional.dense_ids(names, "s").collect()}
    assert ids == {"a": 0, "b": 1, "c": 2}


def test_bfs_hub_vertex_is_salted_and_exact(spark):
    # vertex 0 holds most edges (salt = 8 with 8 partitions); results stay exact
    edges = [(0, d) for d in range(1, 400)] + [(d, d + 1000) for d in range(1, 50)] + [(1007, 0), (7, 1007)]
    df = spark.createDataFrame(edges, "src long, dst long")
    res = graph.bfs(df, 7, max_rounds=10, target=0, stop_at_target=False, partitions=8)
    got = {r.vertex: r.distance for r in res.distances.collect()}
    assert got == bfs_brute(edges, 7, 10)
    assert (res.hit_round, res.hits) == (2, 1)
    hub = graph.bfs(df, 0, max_rounds=3, target=1005, partitions=8)
    assert (hub.hit_round, hub.hits) == (2, 1)


def test_bfs_leaves_the_session_alone(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    edges = spark.createDataFrame([(1, 2), (2, 3)], "src long, dst long")
    got = graph.bfs(edges, 1, partitions=3).distances
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert got.sparkSession is spark or got.join(edges, got.vertex == edges.src).count() == 2
    assert {(r.vertex, r.distance) for r in got.collect()} == {(1, 0), (2, 1), (3, 2)}


def test_substring_matches_brute_force(spark):
    from quarry.operators.joins import substring_matches
    hay = ["1", "11", "121", "a%b", "", None, "_", "12"]
    needles = ["1", "12", "%", "_", "zzz"]
    h = spark.createDataFrame([(x,) for x in hay], "t string")
    n = spark.createDataFrame([(x,) for x in needles], "k string")
    want = {k: sum(k in x for x in hay if x is not None) for k in needles}
    for bounded in (False, True):
        got = {r.k: r.matches for r in substring_matches(h, "t", n, "k", needles_are_bounded=bounded).collect()}
        assert got == want
    assert substring_matches(h, "t", n.limit(0), "k").count() == 0


def test_around_one_anchor(spark):
    from quarry.operators.joins import around
    rows = spark.createDataFrame([(i, f"2024-01-01 00:00:{i:02d}") for i in range(0, 60, 10)], "i int, s string")
    rows = rows.select("i", F.col("s").cast("timestamp").alias("ts"))
    assert {r.i for r in around(rows, rows.where("i = 30"), "ts", "ts", 10).collect()} == {20, 30, 40}
    assert around(rows, rows.where("i = 31"), "ts", "ts", 10).count() == 0
