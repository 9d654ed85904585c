"""Connected identities against union-find."""

import random

from eventloom.operators import person_graph as P


def roots(edges):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            low, high = sorted((find(a), find(b)))
            up[high] = low
    return {x: find(x) for x in up}


def test_components_equal_union_find(spark, monkeypatch):
    rnd = random.Random(3)
    chain = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(150)]
    hub = [("h", f"h{i}") for i in range(300)]
    mixed = [(f"r{rnd.randrange(200)}", f"r{rnd.randrange(200)}") for _ in range(150)]
    edges = chain + hub + mixed + [("s", "s"), (None, "x"), ("y", None), chain[0], tuple(reversed(chain[1]))]
    rnd.shuffle(edges)
    rounds = []
    once = P._large_star
    monkeypatch.setattr(P, "_large_star", lambda e: rounds.append(1) or once(e))
    got = {r.node: r.root for r in P.connected(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == roots(edges)
    assert len(rounds) <= 10  # for a chain of 150


def test_people_of_chained_users(spark):
    links = [("anon1", "bob"), ("anon2", "bob"), ("anon2", "alice"), ("anon3", "zoe"), ("anon4", "zoe")]
    graph = P.person_graph(spark.createDataFrame(links, "anonymous_id string, user_id string"))
    assert {(r.kind, r.id): r.person_id for r in graph.collect()} == {
        **{("anonymous", f"anon{i}"): "alice" if i < 3 else "zoe" for i in range(1, 5)}, ("user", "bob"): "alice", ("user", "alice"): "alice", ("user", "zoe"): "zoe"}
    events = spark.createDataFrame(
        [(1, "anon1", None), (1, "anon1", "bob"), (2, "anon2", None), (3, "unknown", "zoe"), (4, "unknown", None), (5, "anon9", None), (None, "anon3", None)],
        "device_id long, anonymousId string, userId string")
    got = {r.person_id: (r.n_ids, r.n_devices, r.n_events) for r in P.people(events, graph).collect()}
    assert got == {"alice": (4, 2, 3), "zoe": (3, 1, 2)}
    assert P.person_graph(spark.createDataFrame([], "anonymous_id string, user_id string")).count() == 0


def test_links_that_change(spark):
    rows = [(1, 1, "a", None, "track"), (1, 2, "a", "u1", "alias"), (1, 3, "a", None, "track"), (1, 4, "a", "u2", "alias"), (1, 5, "a", "x", "track"),
            (1, 6, "unknown", "u3", "alias"), (1, 7, "unknown", None, "track"), (2, 1, "b", "u1", "identify")]
    df = spark.createDataFrame(rows, "device_id long, seq long, anonymousId string, userId string, type string")
    for width in (0, 2):
        got = {(r.device_id, r.seq): (r.person_id, r.link_no) for r in P.journeys_asof(df, width=width).collect()}
        assert got == {(1, 1): ("a", 0), (1, 2): ("u1", 1), (1, 3): ("u1", 1), (1, 4): ("u2", 2), (1, 5): ("u2", 2), (1, 6): ("u3", 0),
                       (1, 7): ("unknown", 0), (2, 1): ("u1", 0)}
