from datetime import date, timedelta

import numpy as np
from pyspark.sql import functions as F

from conftest import rows
from tributary.llm import url_lists

DAY = lambda n: date(2024, 1, 1) + timedelta(int(n))


def covers(kind, pattern, host, path):
    if kind == "domain":
        return host == pattern or host.endswith("." + pattern)
    whole = host + ("/" + path if path else "")
    return whole == pattern or whole.startswith(pattern + "/")


def brute(captures, entries):
    """Each capture against the whole log."""
    out = []
    for i, url, at in captures:
        best = None
        if url and "://" in url and at:
            rest = url.split("://", 1)[1]
            cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
            host = rest[:cut].split("@")[-1].split(":")[0].rstrip(".").lower()
            path = rest[cut:].split("?")[0].split("#")[0].strip("/")
            for name, kind, pattern, _, _, _ in set(entries):
                log = [e for e in entries if e[:3] == (name, kind, pattern) and None not in e and e[5] <= at]
                if pattern is None or not log or not host or not covers(kind, pattern, host, path):
                    continue
                last = max(e[5] for e in log)
                now = [e for e in log if e[5] == last]
                if any(e[3] == "remove" for e in now):
                    continue
                deny = any(e[4] == "deny" for e in now)
                depth = len(pattern.split(".")) if kind == "domain" else pattern.count("/")
                key = (kind != "prefix", -depth, not deny, name, pattern, last)
                best = min(best or key, key)
        verdict = "unlisted" if best is None else "allow" if best[2] else "deny"
        out.append((i, url, at, verdict, best and best[4], best and best[3], best and best[5]))
    return sorted(out, key=repr)


def test_equal_to_the_whole_log(spark):
    rng = np.random.default_rng(9)
    hosts = ["a.com", "b.a.com", "c.b.a.com", "x.org", "hot.net"]
    paths = ["", "/", "/p", "/p/q", "/p/q/r", "/pq"]
    pick = lambda some: some[int(rng.integers(0, len(some)))]
    entries = [
        (pick(["l1", "l2"]), *pick([("domain", pick([*hosts, "com"])), ("prefix", pick(hosts) + pick(["/p", "/p/q", ""]))]),
         pick(["add", "add", "remove"]), pick(["deny", "allow"]), DAY(rng.integers(0, 40)))
        for _ in range(120)
    ]
    entries += [entries[0]] * 3 + [("l1", "domain", None, "add", "deny", DAY(1)), ("l1", "domain", "x.org", "add", "deny", None)]
    captures = [(k, "http://" + (pick(hosts) if k % 3 else "hot.net") + pick(paths) + pick(["", "?q=/p", "#f"]), DAY(rng.integers(0, 50))) for k in range(300)]
    captures += [(1, "https://U:pw@B.A.com.:80/p/q?x", DAY(30)), (1, "no url", DAY(3)), (None, None, DAY(3)), (2, "http://x.org/p", None), captures[5], captures[5]]
    c = spark.createDataFrame(captures, "page_id long, url string, fetched date").withColumn("key", F.lit(1)).withColumn("list", F.lit(1))
    e = spark.createDataFrame(entries, "list string, kind string, pattern string, action string, verdict string, at date")
    assert rows(url_lists.judge(c, e)) == brute(captures, entries)
    assert rows(url_lists.judge(c.limit(0), e)) == []
    assert {r["verdict"] for r in url_lists.judge(c, e.limit(0)).collect()} == {"unlisted"}


def test_boundaries_of_an_interval(spark):
    log = [("l", "domain", "a.com", "add", "deny", DAY(5)), ("l", "domain", "a.com", "remove", "deny", DAY(8))]
    e = spark.createDataFrame(log, "list string, kind string, pattern string, action string, verdict string, at date")
    c = spark.createDataFrame([(n, "http://a.com/", DAY(n)) for n in (4, 5, 7, 8, 9)], "page_id long, url string, fetched date")
    assert [(r[0], r[3]) for r in rows(url_lists.judge(c, e))] == [(4, "unlisted"), (5, "deny"), (7, "deny"), (8, "unlisted"), (9, "unlisted")]
