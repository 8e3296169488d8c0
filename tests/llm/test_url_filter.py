import math
from collections import Counter

from viewer_insights.llm import url_filter as u


def judge(url):
    """Host, path and rule straight from the definitions."""
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    rest = rest[cut:]
    path = rest[:min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fits = [(len(h + p), h + p) for _, h, p in u.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1] if fits else None


URLS = [None, "", "no scheme", "://", "http://", "http://EXAMPLE.net/en/1", "http://a.example.net/en/?x", "http://badexample.net/en/", "http://x.net",
        "http://x.net/a#b", "http://www.example.com/de/1", "http://example.com/en/", "https://a.org/fr/2?q=://b.net/", "http://org/fr/", "http://é.org/fr/ü",
        "ftp://h?p=/a", "http://host#f/", "http://x.net/" + "long/" * 4000, *(f"http://s{i}.example.{'net/en' if i % 2 else 'com/de'}/{i}" for i in range(60)),
        *(f"http://t{i}.shop.com/buy/{i}" for i in range(20))]


def table(spark, urls):
    return spark.createDataFrame([(i, x, "x", 1, "y") for i, x in enumerate(urls)], "page_id long, url string, host string, score int, gram string")


def test_rules_and_scores_equal_brute_force(spark):
    import hashlib

    urls = [*URLS, *URLS[:8], *["http://hot.net/x"] * 200]
    got = {r["page_id"]: r for r in u.filter_urls(table(spark, urls)).collect()}
    assert len(got) == len(urls)
    verdict = {h + p: v for v, h, p in u.RULES}
    side = {x or "": {"allow": 1, "block": -1}.get(verdict.get(judge(x)[2]), 0) for x in urls}
    uses = Counter(x or "" for x in urls)
    held = {x for x in uses if hashlib.md5(x.encode()).hexdigest()[0] in "012"}
    counts = {1: Counter(), -1: Counter()}

    def grams(x):
        chars = "\x02" * 3 + x + "\x03"
        return [chars[i:i + 4] for i in range(len(chars) - 3)]

    for x, n in uses.items():
        if side[x] and x not in held:
            for g in grams(x):
                for k in range(1, 5):
                    counts[side[x]][g[-k:]] += n
                    counts[side[x]]["^" + g[-k:-1]] += n  # uses of the context, of each length

    def p(s, g):
        out = 1 / 256
        for k in range(1, 5):
            out = (counts[s][g[-k:]] + 4 * out) / (counts[s]["^" + g[-k:-1]] + 4)
        return out

    micro = {g: round((math.log(p(1, g)) - math.log(p(-1, g))) * 1e6) for x in uses for g in grams(x)}
    score = {x: sum(micro[g] for g in grams(x)) / len(grams(x)) for x in uses}
    means = [[score[x] for x in held if side[x] == s] for s in (1, -1)]
    assert all(means)
    cut = sum(sum(m) / len(m) for m in means) / 2
    for i, x in enumerate(urls):
        host, path, rule = judge(x)
        r = got[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert abs(r["score"] - score[x or ""]) <= 1 and abs(r["threshold"] - cut) <= 2
        assert r["verdict"] == (verdict[rule] if rule else "allow" if r["score"] >= r["threshold"] else "block")


def test_without_both_kinds_everything_else_is_allowed(spark):
    got = u.filter_urls(table(spark, ["http://x.com/1", None, "http://y.net/"])).collect()
    assert sorted((r["page_id"], r["verdict"], r["score"]) for r in got) == [(0, "allow", 0), (1, "allow", 0), (2, "block", 0)]


def test_empty_table(spark):
    assert u.filter_urls(table(spark, [])).collect() == []


def test_no_python_in_the_plan(spark):
    plan = u.filter_urls(table(spark, URLS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
