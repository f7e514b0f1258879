"""Operator 12: urls, rules and the spread of trust against plain code, and the defined cases."""

import random
import re
from collections import defaultdict

from seatloom.llm import host_trust as h

SCHEMA = "page_id long, url string, html string"


def plain(table, rules=h.RULES, steps=h.STEPS):
    """The docstring's rules, page by page and edge by edge, in whole numbers."""
    pages = []
    for page, url, html in table:
        rest = url.split("://", 1)[1] if url is not None and "://" in url else ""
        own = re.match("[^/?#]*", rest)[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in own)
        path = re.match("[^?#]*", rest[len(own) :])[0]
        fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        pages.append((page, host, path, max(fits, key=lambda r: len(r.host + r.path), default=None), html or ""))
    weight = defaultdict(int)
    for _, host, _, _, html in pages:
        for target in {x.lower() for x in re.findall(r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'>\s]*)""", html)} - {"", host} if host else ():
            weight[host, target] += 1
    hosts = ({host for _, host, *_ in pages} | {b for _, b in weight}) - {""}
    for x in hosts:
        if "." in x and x.split(".", 1)[1] in hosts:
            weight[x, x.split(".", 1)[1]] += 1
            weight[x.split(".", 1)[1], x] += 1
    judged = sum(r is not None for _, _, _, r, _ in pages)
    known = []
    for verdict, edges in (("allow", weight), ("block", {(b, a): w for (a, b), w in weight.items()})):
        pages_of, all_ = defaultdict(int), defaultdict(int)
        for _, host, _, r, _ in pages:
            pages_of[host] += r is not None and r.verdict == verdict
        for (a, _), w in edges.items():
            all_[a] += w
        start = {x: n * h.SCALE // judged for x, n in pages_of.items() if n}
        now = dict(start)
        for _ in range(steps):
            new = defaultdict(int, {x: v * (100 - h.DAMPING) // 100 for x, v in start.items()})
            for (a, b), w in edges.items():
                new[b] += now.get(a, 0) * w * h.DAMPING // (100 * all_[a])
            now = new
        known.append(now)
    out = []
    for page, host, path, r, _ in pages:
        trust, distrust = (k.get(host, 0) for k in known)
        out.append((page, host, path, r and r.host + r.path, r.verdict if r else "block" if distrust > trust else "allow", trust, distrust))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def table(seed, n=300):
    rng = random.Random(seed)
    hosts = [f"{a}.{b}" for a in ("x", "www.x", "m.y", "y", "blog.z", "example") for b in ("com", "net", "org", "example.com")]
    rows = []
    for i in range(n):
        links = "".join(rng.choice(['<a href="/de">r</a>', f'<A class=q HREF = "http://{rng.choice(hosts).upper()}/p?a">t</a>', f"<a href='//{rng.choice(hosts)}'>", f'<a data-x="1" href=https://{rng.choice(hosts)}#t>', f'<link href="http://{rng.choice(hosts)}/">']) for _ in range(rng.randrange(5)))
        rows.append((i // 2, f"http{'s' * (i % 2)}://{rng.choice(hosts)}{rng.choice(['/en/1', '/es/2?x', '/fr/3#t', '/', '', '?q=/es/', '#x'])}", links))
    return rows


def test_random_graphs(spark):
    rows = table(0)
    assert got(h.judge(spark.createDataFrame(rows, SCHEMA))) == plain(rows)
    for steps in (0, 1, 5):
        seeds = spark.createDataFrame([("a", 3, 0), ("b", 1, 2), ("c", 0, 7)], "host string, allowed long, blocked long")
        links = spark.createDataFrame([("a", "b", 2), ("b", "c", 1), ("c", "a", 5), ("c", "d", 1)], "src string, dst string, weight long")
        found = {r.host: (r.trust, r.distrust) for r in h.spread(seeds, links, steps).collect()}
        assert set(found) == set("abcd"[: 3 + (steps > 2)]) and sum(map(sum, found.values())) <= h.SCALE


def test_other_rules_and_a_hot_host(spark):
    rules = (h.Rule("block", "bad.org", "/"), h.Rule("allow", "good.org", "/"))
    rows = [(i, f"http://hub.org/{i}", '<a href="http://bad.org/">') for i in range(600)] + [(1000, "http://bad.org/", None), (1001, "http://good.org/", '<a href="http://fine.org">'), (1002, "http://fine.org/x", "")]
    found = {x[0]: x for x in got(h.judge(spark.createDataFrame(rows, SCHEMA), rules))}
    assert list(map(repr, sorted(found.values(), key=repr))) == list(map(repr, plain(rows, rules)))
    assert found[5][4] == "block" and found[1002][4] == "allow" and found[1002][5] > 0


def test_defined_cases(spark):
    rows = [(1, None, None), (2, "no scheme.com/x", '<a href="http://a.com/">'), (3, "://", ""), (4, "http://A.COM/en/", None), (4, "http://A.COM/en/", None), (None, "ftp://É.net/es/x?y", "<a href=//>"), (5, "a://b://www.example.com/en/", ""), (6, "http://www.example.com/en/", ""), (7, "http://example.com:80/en/", ""), (8, "x://net/es/", "<a href='http://b.net'" + "x" * 100_000), (9, "http://xnet/es/", ""), (10, "http://a.net\n/es/", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(h.judge(df)) == plain(rows)
    assert got(h.judge(df.selectExpr("*", "1 AS host", "2 AS path", "3 AS r", "4 AS trust", "5 AS rest"))) == plain(rows)
    assert h.judge(spark.createDataFrame([], SCHEMA)).count() == 0
    assert got(h.judge(df.where("page_id < 4"))) == plain(rows[:3])  # no judged page
