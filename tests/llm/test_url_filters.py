"""URL rules and cascades against plain matching and plain sets."""

import random

import numpy as np
import oracle_check
import pytest
from pyspark.sql import functions as F
from tilewright.llm import queries, url_filters
from tilewright.session import local_frame

SF = "/root/testdata/sf0.01"
URLS = [
    None, "", "no scheme", "http://", "http:///es/x", "http://ORG/", "https://a.Example.ORG/es/1?q#f", "x://org",
    "x://org?a/", "x://notorg/", "x://example.org/en/1", "x://example.org/en/12", "x://example.org/en/2",
    "x://my.example.org/EN/1", "x://myexample.org/es/", "x://com/fr/", "x://a.com/de/q#/fr/", "x://a.com/x://b.org/",
    "x://a.com:80/fr/", "x://u@org/", "x://.org/", "x://org./", "x://a..com/de/", "x://mirror.com/de/1",
    "x://mirror.com/de/1", "x://mirror.com/fr/1", "x://mirror.net/anything", "x://mirror.net", "x://fair.com/de/",
    "x://fair.com/fr/", "x://fair.net/", "x://example.org/es/é\n/z", "x://" + "a." * 3000 + "org/" + "p" * 50_000,
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[end:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), path


def expected(urls, rules=url_filters.RULES):
    """(host, path, rule, verdict, listed) of every url."""
    rows, votes = [], {}
    for url in urls:
        host, path = parts(url)
        fitting = []
        for rule in rules:
            verdict, key = rule.split(" ")
            name, start = key[: key.index("/")], key[key.index("/") :]
            if (host == name or host.endswith("." + name)) and path.startswith(start):
                fitting.append((len(key), len(name), verdict == "block", key))
        best = max(fitting, default=None)
        site = host.rpartition(".")[0]
        rows.append((host, path, best and best[3], best and best[2], site))
        votes[site] = votes.get(site, 0) + (0 if best is None else 1 if best[2] else -1)
    listed = {site for site, n in votes.items() if site and n > 0}
    return [
        (host, path, rule, "block" if (site in listed if blocked is None else blocked) else "allow", site in listed)
        for host, path, rule, blocked, site in rows
    ]


def judged(spark, urls, rules=url_filters.RULES):
    rows = [(i, u, "h", "p", True) for i, u in enumerate(urls)]
    pages = local_frame(spark, rows, "page_id long, url string, host string, keys string, listed boolean")
    found = url_filters.judge_urls(pages, url_filters.rule_frame(pages, rules))
    got = sorted(found.collect(), key=lambda r: r.page_id)
    assert [r.page_id for r in got] == list(range(len(urls)))
    return [tuple(r)[1:] for r in got]


def test_sql(spark):
    df = queries.op13_url_filters(spark, SF)
    assert oracle_check.differences(oracle_check.connect(SF), df, queries.ORACLE["op13_url_filters"]) is None


def test_odd_urls(spark):
    assert judged(spark, URLS) == expected(URLS)


def test_other_rules(spark):
    rules = ["block org/", "allow a.org/x", "allow org/xyz", "block a.b.org/", "allow a.b.org/", "allow zz/"]
    rng = random.Random(2)
    hosts = ["org", "a.org", "b.org", "a.b.org", "c.a.b.org", "zz", "q.zz", "xorg"]
    urls = [f"s://{rng.choice(hosts)}{rng.choice(['', '/', '/x', '/xy', '/xyz', '/xyzz', '/y'])}" for _ in range(300)]
    assert judged(spark, urls, rules) == expected(urls, rules)


def test_repeated_rows_and_empty_table(spark):
    pages = local_frame(spark, [(None, "x://a.org/")] * 3, "page_id long, url string")
    rules = url_filters.rule_frame(pages, url_filters.RULES)
    assert [r.rule for r in url_filters.judge_urls(pages, rules).collect()] == ["org/"] * 3
    assert url_filters.judge_urls(pages.limit(0), rules).collect() == []
    none = url_filters.judge_urls(pages, rules.limit(0)).collect()
    assert [(r.rule, r.verdict) for r in none] == [(None, "allow")] * 3


def hashes(spark, count, listed):
    first, second = url_filters.hashed(F.concat(F.lit("key"), F.col("id")))
    return spark.range(count).select(first.alias("first"), second.alias("second"), listed.alias("listed"))


@pytest.mark.parametrize("share, shard_bytes", [(3, 1 << 20), (3, 700), (700, 1 << 20), (5000, 1 << 20)])
def test_cascade_is_exact(spark, share, shard_bytes):
    keys = hashes(spark, 20_000, F.col("id") % share == 0)
    cascade = url_filters.build_cascade(keys, shard_bytes=shard_bytes)
    rows = keys.toPandas()
    found = np.zeros(len(rows), bool)
    for shard in range(len(cascade.shards)):
        found |= cascade.holds(shard, rows["first"].to_numpy(), rows["second"].to_numpy())
    assert (found == rows["listed"].to_numpy()).all()
    assert (len(cascade.shards) > 1) == (shard_bytes < 1000)
    bits = sum(level.bits for levels in cascade.shards for level in levels)
    assert bits <= 64 * 64 + 30 * rows["listed"].sum()


def test_all_or_nothing_listed(spark):
    for listed in (True, False):
        keys = hashes(spark, 500, F.lit(listed))
        cascade = url_filters.build_cascade(keys)
        rows = keys.toPandas()
        assert (cascade.holds(0, rows["first"].to_numpy(), rows["second"].to_numpy()) == listed).all()


def test_shards_are_tested_in_turn(spark):
    """Flags of earlier shards stay; the lists of a row may be empty."""
    keys = hashes(spark, 3000, F.col("id") % 2 == 0)
    cascade = url_filters.build_cascade(keys, shard_bytes=300)
    assert len(cascade.shards) > 3
    lists = spark.range(3000).select("id", F.array(F.concat(F.lit("key"), "id"), F.concat(F.lit("key"), F.col("id") * 0 + 1)).alias("keys"))
    lists = lists.withColumn("keys", F.when(F.col("id") < 10, F.array().cast("array<string>")).otherwise(F.col("keys")))
    got = url_filters.mark_keys(url_filters._with_hashes(lists), cascade, "firsts", "seconds", "in_list").collect()
    assert all(r.in_list == ([] if r.id < 10 else [r.id % 2 == 0, False]) for r in got)
