import random

from strandlake.llm import url_rules as ur

HOSTS = ["org", "example.org", "a.example.org", "x.com", "com", "b.x.com", "notexample.org", "EXAMPLE.org", "", "org.", "u@h.org:80"]
PATHS = ["", "/", "/es/", "/es/x", "/en/1", "/en/12?q=/es/", "/fr/#/de/", "/é/ü", "/en"]
RULES = [
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"),
    ("allow", "x.com", "/"), ("block", "x.com", "/e"), ("allow", "x.com", "/en/"), ("block", "X.com", "/en/12"), ("block", "org", ""), ("allow", "example.org", "/es/"), ("allow", "com", "/é"),
]


def judge(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest] + [len(rest)])
    host, tail = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
    path = tail[: min([tail.index(c) for c in "?#" if c in tail] + [len(tail)])]
    fit = [(len(h) + len(p), len(h), h + p, a) for a, h, p in ((a, h.lower(), p) for a, h, p in rules) if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fit:
        return host, path, None, "allow"
    best = max(fit)
    return host, path, best[2], best[3]


def test_same_as_brute_force(spark):
    rng = random.Random(1)
    urls = [f"{s}{h}{p}" for h in HOSTS for p in PATHS for s in ("http://", "")] + [None, "", "://", "http://org", "http://org?x/", "no scheme", "a://b://org/"]
    urls += rng.choices(urls, k=50)
    pages = spark.createDataFrame([(i, u, "r") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    rules = ur.rules_frame(spark, [*RULES, (None, "org", "/zz"), ("allow", None, "/")])
    for lanes in (1, 5):
        rows = ur.judge_urls(pages, rules, lanes=lanes).collect()
        assert len(rows) == len(urls)
        for r in rows:
            assert (r["host"], r["path"], r["rule"], r["verdict"]) == judge(urls[r["page_id"]], RULES), urls[r["page_id"]]


def test_long_hosts(spark):
    """Hosts of thousands of labels, with and without a rule for their end."""
    import time

    urls = ["http://" + ".".join(f"l{i}" for i in range(n)) + end + "/es/x" for n in (2_000, 20_000) for end in (".example.org", ".nowhere")] + ["http://" + "x" * 1_000_000 + ".org/" + "p" * 1_000_000]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    began = time.perf_counter()
    for r in ur.judge_urls(pages, ur.rules_frame(spark)).collect():
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == judge(urls[r["page_id"]], list(ur.RULES))
    assert time.perf_counter() - began < 30


def test_no_rows_and_no_rules(spark):
    pages = spark.createDataFrame([(1, "http://org/"), (1, "http://org/")], "page_id long, url string")
    none = ur.rules_frame(spark).limit(0)
    assert [r["verdict"] for r in ur.judge_urls(pages, none, "block").collect()] == ["block", "block"]
    assert ur.judge_urls(pages.limit(0), ur.rules_frame(spark)).count() == 0
