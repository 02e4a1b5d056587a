"""Link trust against numpy, role repair against trying everything."""

import random
from collections import Counter, defaultdict
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from riskloom.llm import chat, link_trust

URLS = [
    ("http://a.example.net/en/1", "a.example.net", "/en/1", "example.net/en/", "allow"),
    ("https://B.Example.NET/de/1?x#y", "b.example.net", "/de/1", "net/", "block"),
    ("http://net/", "net", "/", "net/", "block"),
    ("http://net", "net", "", None, None),
    ("http://example.com/de/", "example.com", "/de/", "example.com/de/", "block"),
    ("http://www.example.com/de", "www.example.com", "/de", None, None),
    ("http://notexample.com/de/", "notexample.com", "/de/", None, None),
    ("ftp://x.org/fr/q#?", "x.org", "/fr/q", "org/fr/", "allow"),
    ("http://x.org?a/fr/", "x.org", "", None, None),
    ("http://x.org#/fr/", "x.org", "", None, None),
    ("x.org/fr/", "", "", None, None), (None, "", "", None, None), ("", "", "", None, None),
    ("http://", "", "", None, None), ("http:///fr/", "", "/fr/", None, None),
    ("http://a.b://c/d", "a.b:", "//c/d", None, None), ("http://É.ORG/fr/\nz", "É.org", "/fr/\nz", "org/fr/", "allow"),
    ("http://exNET.example.net.evil.org/x", "exnet.example.net.evil.org", "/x", None, None),
]
PAGES = "page_id long, url string, html string"


def test_hosts_paths_and_rules(spark):
    rows = [(i, u[0], None) for i, u in enumerate(URLS)]
    table = spark.createDataFrame(rows, PAGES).withColumn("host", F.lit("clash")).withColumn("good", F.lit(1))
    found = {r.page_id: r for r in link_trust.judge(table).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(URLS):
        r = found[i]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
        if not host:
            assert r.verdict == "allow"


def test_edges(spark):
    html = ('<a href="http://Y.org/1"><A class=x HREF=//z.a.b.com/q>t</a><a href="/local">'
            "<a href='https://x.org/self'><a href='mailto:q@w'>")
    rows = [(1, "http://x.org/", html), (2, "http://x.org/2", html), (3, "http://c.example.com", None), (4, None, html)]
    got = {(r.src, r.dst): r.weight for r in link_trust.host_edges(spark.createDataFrame(rows, PAGES)).collect()}
    up = [("c.example.com", "example.com"), ("z.a.b.com", "a.b.com"), ("a.b.com", "b.com")]
    want = {("x.org", "y.org"): 2, ("x.org", "z.a.b.com"): 2}
    want |= {e: 1 for a, b in up for e in ((a, b), (b, a))}
    assert got == want


def limits(hosts, edges, seeds, damping):
    """Trust and distrust of each host, where the walks' sums end: a linear system."""
    import numpy as np

    w = np.array([[edges.get((a, b), 0.0) for b in hosts] for a in hosts])
    found = []
    for flow, at in ((w, 0), (w.T, 1)):
        flow = flow / np.maximum(flow.sum(1, keepdims=True), 1e-300)
        seed = np.array([seeds.get(h, (0, 0))[at] for h in hosts], float)
        seed /= max(seed.sum(), 1)
        found.append(np.linalg.solve(np.eye(len(hosts)) - damping * flow.T, (1 - damping) * seed))
    return found


@pytest.mark.parametrize("seed", [1, 2])
def test_verdicts_are_those_of_the_limit(spark, seed):
    rng = random.Random(seed)
    hosts = [f"h{i}" for i in range(30)]
    edges = {(a, b): float(rng.randrange(1, 5)) for a in hosts for b in hosts if a != b and rng.random() < 0.06}
    seeds = {"h0": (3, 0), "h1": (1, 2), "h5": (0, 4)}
    got = link_trust.propagate(
        spark.createDataFrame([(*e, w) for e, w in edges.items()], "src string, dst string, weight double"),
        spark.createDataFrame([(h, *seeds.get(h, (0, 0)), 1) for h in hosts], "host string, good long, bad long, open long")).collect()
    trust, distrust = limits(hosts, edges, seeds, link_trust.DAMPING)
    assert {r.host for r in got} == set(hosts)
    for r in got:
        i = hosts.index(r.host)
        assert r.trust <= trust[i] + 1e-12 and r.distrust <= distrust[i] + 1e-12
        assert (r.trust > 0, r.distrust > 0) == (trust[i] > 1e-300, distrust[i] > 1e-300)
        assert r.trust == pytest.approx(trust[i], abs=0.05) and r.distrust == pytest.approx(distrust[i], abs=0.05)
        if abs(distrust[i] - trust[i]) > 1e-5 * (distrust[i] + trust[i]):
            assert (r.distrust > r.trust) == (distrust[i] > trust[i])


def test_long_ways_to_a_blocked_host(spark):
    """However many links lead to a blocked host, those that lead nowhere else are blocked."""
    link = lambda h: f'<a href="http://{h}/">'
    names = [f"h{i}.info" for i in range(15)] + ["bad.net"]
    rows = [(i, f"http://{h}/", link(names[i + 1]) if i + 1 < len(names) else None) for i, h in enumerate(names)]
    rows += [(100, "http://good.org/fr/", link("fine.info")), (101, "http://fine.info/", link("h0.info"))]
    got = {r.page_id: r.verdict for r in link_trust.judge(spark.createDataFrame(rows, PAGES)).collect()}
    trust, distrust = limits(*_graph(names), link_trust.DAMPING)
    want = dict(zip([*range(len(names)), 100, 101], (distrust > trust).tolist()))
    assert {i: v == "block" for i, v in got.items()} == want | {len(names) - 1: True, 100: False}
    alone = spark.createDataFrame(rows[:len(names)], PAGES)
    assert {r.verdict for r in link_trust.judge(alone).collect()} == {"block"}


def _graph(names):
    hosts = [*names, "good.org", "fine.info"]
    edges = {(a, b): 1.0 for a, b in zip(names, names[1:])} | {("good.org", "fine.info"): 1.0, ("fine.info", "h0.info"): 1.0}
    return hosts, edges, {"bad.net": (0, 1), "good.org": (1, 0)}


def test_a_tie_is_allowed(spark):
    """A host as far from a trusted as from a blocked one."""
    link = lambda h: f'<a href="http://{h}/">'
    rows = [(1, "http://good.org/fr/", link("mid.info")), (2, "http://mid.info/", link("bad.net")), (3, "http://bad.net/", None)]
    got = {r.page_id: r for r in link_trust.judge(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[2].trust > 0 and got[2].trust == pytest.approx(got[2].distrust) and got[2].verdict == "allow"


def test_links_from_trusted_and_to_blocked_hosts(spark):
    """What trusted hosts link to is allowed; what links to blocked hosts is blocked."""
    link = lambda h: f'<a href="http://{h}/">'
    rows = [(1, "http://good.org/fr/", link("friend.info")), (2, "http://friend.info/", link("next.info")), (3, "http://next.info/", None),
            (4, "http://farm.info/", link("bad.net") * 3), (5, "http://bad.net/", link("friend.info")), (6, "http://alone.info/", "")]
    got = {r.page_id: r.verdict for r in link_trust.judge(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {1: "allow", 2: "allow", 3: "allow", 4: "block", 5: "block", 6: "allow"}


def test_no_pages(spark):
    assert link_trust.judge(spark.createDataFrame([], PAGES)).collect() == []


TURNS = "conv_id long, turn long, role string, text string"
NAMES = ["user", "assistant", "system", "tool", None]


def least_cost(roles):
    """By trying every state after every turn, with every choice of one inserted turn."""
    legal = {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}

    @lru_cache(None)
    def rest(state, i):
        if i == len(roles):
            return {"": 0, "system": 4, "user": 2, "assistant": 0}[state]
        own = (roles[i] or "").strip().lower()
        costs = [(1 if own == state else 4) + rest(state, i + 1)] if state else []
        for b in legal[state]:
            costs.append((0 if own == b else 3) + rest(b, i + 1))
            costs += [2 + (0 if own == c else 3) + rest(c, i + 1) for c in legal[b]]
        return min(costs)

    return rest("", 0)


def conversations(seed, count, longest):
    rng = random.Random(seed)
    return {c: [rng.choices(NAMES, [8, 8, 1, 1, 1])[0] for _ in range(rng.randint(1, longest))] for c in range(count)}


def check_repair(spark, talks, bits):
    rows = [(c, t, role, f"text {c} {t}") for c, roles in talks.items() for t, role in enumerate(roles)]
    random.Random(1).shuffle(rows)
    table = spark.createDataFrame(rows, TURNS).withColumn("above", F.lit(1)).withColumn("entry", F.lit(2)).repartition(5)
    found = defaultdict(list)
    for r in chat.repair(table, bits).collect():
        found[r.conv_id].append(r)
    assert set(found) == set(talks)
    for c, turns in found.items():
        turns.sort(key=lambda r: r.turn)
        assert [r.role for r in turns] == talks[c]
        assert sum(r.cost for r in turns) == least_cost(tuple(talks[c]))
        shown = "".join(r.rendered for r in turns)
        pieces = shown.split("<|end|>\n")
        assert pieces[-1] == ""
        made = [p.split("|>\n", 1) for p in pieces[:-1]]
        order = [p[0].removeprefix("<|") for p in made]
        assert order[-1] == "assistant" and order[1 if order[0] == "system" else 0] == "user"
        plain = order[order[0] == "system":]
        assert all(a != b for a, b in zip(plain, plain[1:])) and set(plain) <= {"user", "assistant"}
        assert [x for p in made for x in p[1].split("\n") if x] == [f"text {c} {t}" for t in range(len(turns))]


def test_repair_costs_least(spark):
    check_repair(spark, conversations(1, 300, 9), chat.BLOCK_BITS)


def test_blocks_of_blocks(spark, monkeypatch):
    """Blocks of two turns, and of four blocks, so that costs go up and states down several levels."""
    monkeypatch.setattr(chat, "BLOCK_BITS", 2)
    check_repair(spark, conversations(2, 12, 150) | {99: ["user", "user"] * 200, 98: ["assistant"]}, 1)


def test_awkward_turns(spark):
    rows = [(None, 1, "user", None), (None, None, "assistant", "last"), (5, 1, " USER ", "a"), (5, 1, "assistant", "b"),
            (6, -3, "user", "early"), (6, 2, "Assistant", "late"), (7, 0, None, None)]
    found = chat.repair(spark.createDataFrame(rows, TURNS)).collect()
    by = defaultdict(list)
    for r in found:
        by[r.conv_id].append(r)
    assert sum(r.cost for r in by[None]) == 0 and {r.turn for r in by[None]} == {1, None}
    assert sum(r.cost for r in by[6]) == 0
    assert Counter(r.action for r in by[7]) == {"relabel": 1} and by[7][0].cost == 5
    assert sum(r.cost for r in by[5]) == 0  # equal turns follow by role: a space comes first
    assert chat.repair(spark.createDataFrame([], TURNS)).collect() == []


def test_equal_turn_numbers_are_cut_into_blocks(spark):
    """Many turns with null or equal numbers, of no conversation and of one, in blocks of four."""
    rows = [(c, t, NAMES[i % 2], f"text {i:03}") for c, t in ((None, None), (None, 3), (7, 3)) for i in range(40)]
    table = spark.createDataFrame(rows + [(8, 0, "user", "a")], TURNS).repartition(5)
    turns = table.withColumns({"number": F.coalesce("turn", F.lit(99)), "kind": F.lit(2)})
    blocks, _ = chat.in_blocks(turns, 2)
    sizes = [r["count"] for r in blocks.groupBy("conv_id", "above").count().collect()]
    assert max(sizes) == 4 and sum(sizes) == 121
    by = defaultdict(list)
    for r in chat.repair(table, 2).collect():
        by[r.conv_id].append(r)
    assert {c: len(v) for c, v in by.items()} == {None: 80, 7: 40, 8: 1}
    for c, turns in by.items():
        turns.sort(key=lambda r: (r.turn is None, r.turn, r.role, r.rendered.split("text ")[-1]))
        assert sum(r.cost for r in turns) == least_cost(tuple(r.role for r in turns))
