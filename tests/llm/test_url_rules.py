import random

from quernstone.llm.url_rules import judge_urls

from .frames import clashing


def brute(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if h and p is not None and v is not None and (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fits:
        return host, path, None, default
    top = max(f[:3] for f in fits)
    return host, path, *min((f[3], f[4]) for f in fits if f[:3] == top)


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("b.net", "/e", "allow"), ("net", "/esx/", "allow"), ("a.org", "", "block"), ("a.org", "", "allow"), (None, "/", "block"), ("c.org", None, "block"), ("com", "/", "allow")]
URLS = [None, "", "nothing", "://", "http://", "http://Example.COM", "http://www.example.com/en/x?y#z", "https://a.example.com/en/", "http://example.com/en", "http://xexample.com/en/", "http://b.net/es/1", "http://net/esx/1", "http://a.org", "ftp://q.a.org#f/en/", "http://com./", "http://u:p@com:80/", "http://x.com/a://b.net/es/", "http://com/\n/en/"]


def test_equals_brute_force(spark):
    r = random.Random(2)
    hosts = ["com", "example.com", "www.example.com", "a.b.net", "b.net", "net", "a.org", "x.c.org", "..com"]
    urls = URLS + [f"http://{r.choice(hosts)}{r.choice(['', '/', '/en/', '/es/', '/esx/', '/e'])}{r.choice(['', '1', '?q', '#f'])}" for _ in range(300)]
    rows = [(k if k % 9 else None, u) for k, u in enumerate(urls)] + [(1, URLS[1])]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = judge_urls(clashing(pages, "host", "__n"), rules).collect()
    key = lambda x: tuple(str(y) for y in x)
    assert sorted(((g.page_id, g.host, g.path, g.rule, g.verdict) for g in got), key=key) == sorted(((p, *brute(u, RULES)) for p, u in rows), key=key)


def test_empty(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert judge_urls(pages.limit(0), rules).count() == 0
    assert [(r.rule, r.verdict) for r in judge_urls(pages, rules.limit(0), "block").collect()] == [(None, "block")]
