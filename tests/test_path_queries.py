import random

import duckdb

import __spark_entry__ as E
from tracknet.operators import paths as P
from tracknet.operators.model import GraphTables

CHAIN = 60


def chain(spark):
    nodes = spark.range(CHAIN).selectExpr("id AS station_id", "concat('S', id) AS name")
    rels = spark.range(CHAIN - 1).selectExpr("id AS src_id", "id + 1 AS dst_id", "concat('L', id % 2) AS rel_type")
    return GraphTables(nodes.cache(), rels.cache())


def test_bounded_paths_reach_five_hops_from_fifty_stations(spark, monkeypatch):
    g = chain(spark)
    monkeypatch.setattr(E, "_g", lambda s, sf: g)
    rows = {(r.src_id, r.dst_id, r.hops) for r in E.queries()["shortest_path_bounded"](spark, None).collect()}
    # all inner stations have two connections; the smaller ids come first
    assert rows == {(a, b, abs(a - b)) for a in range(1, 51) for b in range(CHAIN) if 0 < abs(a - b) <= 5}


def test_named_pairs_with_route_and_lines(spark, monkeypatch):
    g = chain(spark)
    monkeypatch.setattr(E, "_g", lambda s, sf: g)
    monkeypatch.setattr(E, "NAMED_PAIRS", [("S3", "S8"), ("S3", "S9"), ("S7", "S5"), ("S1", "S1"), ("S1", "nowhere")])
    rows = sorted(tuple(r) for r in E.queries()["shortest_path_named"](spark, None).collect())
    assert rows == [("S3", "S8", 5, [3, 4, 5, 6, 7, 8], ["L1", "L0", "L1", "L0", "L1"]), ("S7", "S5", 2, [7, 6, 5], ["L0", "L1"])]


def test_path_queries_match_sql(spark):
    con = duckdb.connect()
    for t in ["customer", "nation", "orders"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{E.SMOKE_DIR}/{t}.parquet')")
    queries, oracles = E.queries(), E.oracle_sql()
    for name, sources in [("shortest_path_hops", 50), ("shortest_path_named", None)]:
        df = queries[name](spark, E.SMOKE_DIR)
        got = sorted(tuple(r) for r in df.collect())
        assert got == sorted(con.execute(f"SELECT {', '.join(df.columns)} FROM ({oracles[name]})").fetchall()) and got
        assert sources is None or len({r[0] for r in got}) == sources


def graph(spark, edges):
    rels = spark.createDataFrame([(a, b, "L") for a, b in edges], "src_id long, dst_id long, rel_type string")
    nodes = spark.createDataFrame([(i, f"s{i}") for i in sorted({x for e in edges for x in e})], "station_id long, name string")
    return GraphTables(nodes, rels)


def one_sided(edges, pairs):
    """Distance and route by a search from the source: the smallest predecessor of each station."""
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    out = {}
    for s, t in pairs:
        dist, todo = {s: 0}, [s]
        for u in todo:
            for v in sorted(near[u]):
                if v not in dist:
                    dist[v] = dist[u] + 1
                    todo.append(v)
        if t in dist and s != t:
            route = [t]
            while route[0] != s:
                route.insert(0, min(u for u in near[route[0]] if dist.get(u) == dist[route[0]] - 1))
            out[s, t] = (dist[t], route)
    return out


def test_pairs_from_both_ends_are_those_from_one(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(170)] + [(200, 201)] + [(300, 300 + k) for k in range(1, 40)]
    edges = [(a, b) for a, b in edges if a != b]
    ids = sorted({x for e in edges for x in e})
    pairs = {(rng.choice(ids), rng.choice(ids)) for _ in range(150)} | {(ids[0], x) for x in ids} | {(200, 201), (200, ids[0]), (301, 302)}
    pairs = {p for p in pairs if p[0] != p[1]}
    wanted = spark.createDataFrame(sorted(pairs), "src_id long, dst_id long")
    adj = P.adjacency(graph(spark, edges).relationships)
    got = {(r.src_id, r.dst_id): (r.hops, r.stations) for r in P.PairSearch(adj, wanted).paths().collect()}
    want = one_sided(edges, pairs)
    assert got == want and len(want) > 150
    bounded = P.PairSearch(adj, wanted, max_hops=3)
    assert {(r.src_id, r.dst_id): r.hops for r in bounded.hops().collect()} == {p: h for p, (h, _) in want.items() if h <= 3}


def test_a_far_pair_expands_a_small_part_of_a_grid(spark):
    n = 40
    edges = [(r * n + c, r * n + c + 1) for r in range(n) for c in range(n - 1)] + [(r * n + c, r * n + n + c) for r in range(n - 1) for c in range(n)]
    a, b = 20 * n + 14, 20 * n + 24
    search = P.PairSearch(P.adjacency(graph(spark, edges).relationships), spark.createDataFrame([(a, b)], "src_id long, dst_id long"))
    assert [tuple(r) for r in search.paths().select("hops", "stations").collect()] == [(10, list(range(a, b + 1)))]
    # two balls of radius 5 instead of one of radius 10 (220 stations)
    assert search.expanded <= 120


def test_a_long_chain_and_a_long_loop_are_ranked_in_few_rounds(spark):
    stops = list(range(10_000))
    random.Random(7).shuffle(stops)
    chain_edges = list(zip(stops, stops[1:]))
    loop = [20_000 + k for k in stops[:3_000]]
    edges = chain_edges + list(zip(loop, loop[1:] + loop[:1])) + [(50_000, 50_001)]
    rounds = []
    got = {r.station_id: (r.component, r.stop) for r in P.trace_line(graph(spark, edges), rounds.append).collect()}
    if stops[0] > stops[-1]:
        stops.reverse()
    assert all(got[x] == (0, k) for k, x in enumerate(stops))
    low = loop.index(min(loop))
    assert all(got[x] == (min(loop), min((k - low) % 3_000, (low - k) % 3_000)) for k, x in enumerate(loop))
    assert got[50_000] == (50_000, 0) and got[50_001] == (50_000, 1) and len(got) == 13_002
    assert len(rounds) <= 20


def test_branched_parts_and_loops_with_a_tail(spark):
    edges = [(1, 2), (2, 3), (3, 1), (3, 4), (4, 5),        # a loop with a tail: the terminal is the start
             (10, 11), (11, 12), (12, 13), (13, 10),        # a loop
             (20, 21), (20, 22), (20, 23), (23, 24),        # a star
             (30, 31), (31, 32), (32, 33), (33, 30), (30, 32),   # branched without a terminal
             (42, 41), (41, 40)]
    got = {r.station_id: (r.component, r.stop) for r in P.trace_line(graph(spark, edges)).collect()}
    assert got == {5: (1, 0), 4: (1, 1), 3: (1, 2), 1: (1, 3), 2: (1, 3), 10: (10, 0), 11: (10, 1), 13: (10, 1), 12: (10, 2),
                   21: (20, 0), 20: (20, 1), 22: (20, 2), 23: (20, 2), 24: (20, 3), 30: (30, 0), 31: (30, 1), 32: (30, 1), 33: (30, 1),
                   40: (40, 0), 41: (40, 1), 42: (40, 2)}


def test_branched_parts_are_not_ranked_by_doubling(spark):
    edges = [(1, 2), (2, 3), (3, 4), (4, 1), (1, 3), (4, 5), (5, 6), (6, 7), (20, 21), (20, 22), (20, 23), (23, 24)]
    rounds = []
    got = {r.station_id: (r.component, r.stop) for r in P.trace_line(graph(spark, edges), rounds.append).collect()}
    assert got == {7: (1, 0), 6: (1, 1), 5: (1, 2), 4: (1, 3), 1: (1, 4), 3: (1, 4), 2: (1, 5),
                   21: (20, 0), 20: (20, 1), 22: (20, 2), 23: (20, 2), 24: (20, 3)}
    assert not rounds


def test_components_of_a_long_chain_take_few_rounds(spark, monkeypatch):
    stops = list(range(3_000))
    random.Random(5).shuffle(stops)
    tables, plain = [], P.cut
    monkeypatch.setattr(P, "cut", lambda *a, **k: tables.append(1) or plain(*a, **k))
    adj = P.adjacency(graph(spark, list(zip(stops, stops[1:])) + [(5_000, 5_001)]).relationships, ["rel_type"])
    got = {(r.rel_type, r.node): r.component for r in P.connected_components(adj, ["rel_type"]).collect()}
    assert {c for (_, node), c in got.items() if node < 5_000} == {0} and len(got) == 3_002
    assert got[next(iter(got))[0], 5_001] == 5_000
    assert len(tables) <= 60


def test_sources_of_a_word_follow_an_edge_once(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(150), rng.randrange(150)) for _ in range(260)] + [(0, k) for k in range(1, 150, 2)] + [(900, 901)]
    edges = [(a, b) for a, b in edges if a != b]
    ids = sorted({x for e in edges for x in e})
    g = graph(spark, edges)
    want = one_sided(edges, {(s, t) for s in ids for t in ids})
    rows = P.reach_from(g, g.nodes.select("station_id"), None, True).collect()
    assert {(r.src_id, r.dst_id): (r.hops, r.stations) for r in rows} == want and len(rows) == len(want)
    rows = P.reach_from(g, g.nodes.select("station_id"), 2).collect()
    assert {(r.src_id, r.dst_id): r.hops for r in rows} == {p: h for p, (h, _) in want.items() if h <= 2} and len(rows) < len(want)
    # the first step: an offer for each edge, station and word, not for each source
    dealt, words, n = P._words(g.nodes.selectExpr("station_id AS src_id"), [])
    adj = P.adjacency(g.relationships)
    everywhere = g.nodes.selectExpr("station_id AS node").crossJoin(words.select("word")).selectExpr("word", "node", "-1L AS mask")
    assert n == -(-len(ids) // 64) and P.Sweep(adj, [], False, n).offers(everywhere).count() == n * adj.count()
