import random

from parcelkit.llm.url_filter import judge_urls, merged_branches, path_templates, smoothed_shares, with_host_path


def judged(spark, urls, **kw):
    df = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)], "page_id bigint, url string, host string, rule string")
    return {r.page_id: r for r in judge_urls(df, **kw).collect()}


def test_host_path_and_rules(spark):
    urls = ["http://Example.COM/en/1", "http://www.example.com/en/1?x#y", "https://a.www.example.com/en/2", "http://x.com/", "http://x.com",
            "http://foo.net/es/1", "http://net/fr/", "http://foonet/es/1", "ftp://É.net/fr/x#/y", None, "no scheme", "", "http://?q", "a://b://c/d",
            "http://xcom/", "http://notexample.com/en/1"]
    got = judged(spark, urls)
    want = {0: ("example.com", "/en/1", "example.com/en/", "block"), 1: ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
            2: ("a.www.example.com", "/en/2", "www.example.com/en/", "allow"), 3: ("x.com", "/", "com/", "allow"), 4: ("x.com", "", None, "allow"),
            5: ("foo.net", "/es/1", "net/es/", "block"), 6: ("net", "/fr/", "net/fr/", "block"), 7: ("foonet", "/es/1", None, "allow"),
            8: ("É.net", "/fr/x", "net/fr/", "block"), 9: ("", "", None, "allow"), 10: ("", "", None, "allow"), 11: ("", "", None, "allow"),
            12: ("", "", None, "allow"), 13: ("b:", "//c/d", None, "allow"), 14: ("xcom", "/", None, "allow"), 15: ("notexample.com", "/en/1", "com/", "allow")}
    assert {i: (r.host, r.path, r.rule, r.verdict) for i, r in got.items()} == want
    assert judged(spark, []) == {}


def chains(spark, paths):
    df = spark.createDataFrame(paths, "host string, path string, n long")
    return {(r.host, r.path): r.chain for r in path_templates(df).collect()}


def test_variable_segments_become_wildcards(spark):
    paths = [("h", f"/blog/{i}.html", 1) for i in range(50)] + [("h", f"/user/u{i}x/about", 1) for i in range(50)] + [("h", "/a/b/c/d/e/f", 1)]
    got = chains(spark, paths + [("g", "/x/y", 3), ("g", "", 1), ("", "", 2)])
    assert {c[-1] for (h, _), c in got.items() if h == "h"} == {"/blog/#", "/user/*/about", "/*/**"}
    assert got["h", "/blog/7.html"] == ["", "/blog", "/blog/#"] and got["h", "/a/b/c/d/e/f"] == ["", "/*", "/*/**"]
    assert got["g", "/x/y"] == ["", "/**"] and got["g", ""] == [""] and got["", ""] == [""] and len(got) == 104


def test_paths_that_go_on_together_are_split_at_any_depth(spark):
    deep = "/d" * 12
    got = chains(spark, [("h", f"{deep}/{k}/{i}", 1) for k in ("x", "y") for i in range(30)] + [("h", "/z" * 300, 1)])
    assert {c[-1] for c in got.values()} == {f"{deep}/x/#", f"{deep}/y/#", "/*/**"}


def test_impure_templates_are_rejected(spark):
    rules = (("block", "bad.org/spam/x"), ("allow", "bad.org/news/a"))
    urls = [f"http://bad.org/spam/x{i}" for i in range(40)] + [f"http://bad.org/spam/y{i}" for i in range(5)]
    urls += [f"http://bad.org/news/a{i}" for i in range(40)] + [f"http://bad.org/news/b{i}" for i in range(5)] + ["http://bad.org/other/1", "http://new.org/spam/1"]
    got = judged(spark, urls, rules=rules)
    assert {got[i].verdict for i in range(45)} == {"block"} and got[42].rule is None
    assert {got[i].verdict for i in range(45, 92)} == {"allow"}
    labels = spark.createDataFrame([("new.org", "/spam/1", 1)] * 20, "host string, path string, blocked int")
    assert judged(spark, urls, rules=rules, labels=labels)[91].verdict == "block"


def test_similar_branches_merge(spark):
    rows = [("h", "", "/a", 100, 95), ("h", "", "/b", 100, 97), ("h", "", "/c", 100, 10), ("h", "", "/d", 0, 0), ("h", "/a", "/a/x", 100, 96),
            ("g", "", "/a", 100, 95)]
    df = spark.createDataFrame(rows, "host string, parent string, template string, labelled long, blocked long")
    got = {(r.host, r.template): (r._l, r._b) for r in merged_branches(df).collect()}
    assert got == {("h", "/a"): (200, 192), ("h", "/b"): (200, 192), ("h", "/c"): (100, 10), ("h", "/d"): (0, 0), ("h", "/a/x"): (100, 96),
                   ("g", "/a"): (100, 95)}


def test_evidence_comes_from_parents_and_from_like_templates(spark):
    """Hosts without labels: their templates are judged as the same templates are elsewhere; a blocked parent rejects its children."""
    rules = (("block", "bad.org/ads/"), ("allow", "bad.org/news/"), ("block", "worse.org/"))
    urls = [f"http://bad.org/ads/{i}" for i in range(60)] + [f"http://bad.org/news/{i}" for i in range(60)]
    urls += [f"http://new.net/ads/{i}" for i in range(9)] + [f"http://new.net/news/{i}" for i in range(9)]
    got = judged(spark, urls, rules=rules)
    assert {got[i].verdict for i in range(120, 129)} == {"block"} and {got[i].verdict for i in range(129, 138)} == {"allow"}
    assert {got[i].rule for i in range(120, 138)} == {None} and got[120].template == "/ads/#"
    # below a node whose labels are all blocked, a branch of its own without labels is rejected as well
    urls = [f"http://h.org/en/{k}/{i}" for k in ("a", "b") for i in range(30)]
    labels = spark.createDataFrame([("h.org", f"/en/a/{i}", 1) for i in range(30)], "host string, path string, blocked int")
    got = judged(spark, urls, rules=(), labels=labels)
    assert got[40].template == "/en/b/#" and got[40].rejected_share > 0.8 and {r.verdict for r in got.values()} == {"block"}


def plain_shares(leaves, prior=1.0, z=1.96):
    """The shares worked out node by node. ``leaves``: (host, chain, labelled, blocked)."""
    own, world, parent = {}, {}, {}
    for host, chain, n, b in leaves:
        for k, t in enumerate(chain):
            for table, key in ((own, (host, t)), (world, t)):
                table[key] = tuple(x + y for x, y in zip(table.get(key, (0, 0)), (n, b)))
            parent[host, t] = chain[k - 1] if k else None
    pooled = dict(own)
    for host, up in {(h, p) for (h, _), p in parent.items()}:
        kin = sorted((own[h, t][1] / own[h, t][0], t) for (h, t), p in parent.items() if (h, p) == (host, up) and own[h, t][0])
        group = []
        for at, (share, t) in enumerate(kin):
            if at:
                (n0, b0), (n1, b1) = own[host, kin[at - 1][1]], own[host, t]
                p = (b0 + b1) / (n0 + n1)
                if abs(b1 / n1 - b0 / n0) > z * (p * (1 - p) * (1 / n0 + 1 / n1)) ** 0.5:
                    group = []
            group = [*group, t]
            for m in group:
                pooled[host, m] = tuple(sum(own[host, x][i] for x in group) for i in (0, 1))
    out = {}
    for host, chain, _, _ in leaves:
        everywhere, here = 0.5, None
        for t in chain:
            everywhere = (world[t][1] + prior * everywhere) / (world[t][0] + prior)
            around = everywhere if here is None else (here + everywhere) / 2
            here = (pooled[host, t][1] + prior * around) / (pooled[host, t][0] + prior)
        out[host, chain[-1]] = here
    return out


def test_shares_against_plain_python(spark):
    rng = random.Random(8)
    paths = sorted({(f"h{rng.randrange(4)}", "".join(f"/{rng.choice('abc9')}" for _ in range(rng.randrange(5)))) for _ in range(160)})
    rows = []
    for h, p in paths:
        n = rng.randrange(1, 4)
        labelled = rng.choice([0, n])
        rows.append((h, p, n, labelled, rng.randint(0, labelled)))
    tree = path_templates(spark.createDataFrame(rows, "host string, path string, n long, labelled long, blocked long"))
    leaves = [(r.host, r.chain, r.labelled, r.blocked) for r in tree.collect()]
    got = {(r.host, r.template): r.rejected_share for r in smoothed_shares(tree).collect()}
    want = plain_shares(leaves)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_odd_urls(spark):
    rows = [(1, None), (1, None), (None, "http://h.org/a"), (2, "http://h.org/" + "x/" * 3000), (2, "http://h.org/" + "y" * 100_000), (3, "")]
    df = spark.createDataFrame([(i, u, "t", 1.0) for i, u in rows], "page_id bigint, url string, template string, rejected_share double")
    got = judge_urls(df).collect()
    assert len(got) == 6 and all(0 < r.rejected_share < 1 and r.verdict == "allow" for r in got)


def test_native_plan(spark):
    df = spark.createDataFrame([(1, "http://a.net/es/1")], "page_id bigint, url string")
    plan = judge_urls(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan
    assert with_host_path(df).columns == ["page_id", "url", "host", "path"]
