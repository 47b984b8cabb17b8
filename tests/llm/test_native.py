"""URL filters and chat formatting: the operators in built-in functions, and the SQL of their queries."""

from __future__ import annotations

import math
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from cardtide.llm.oracle import ORACLE
from cardtide.llm.perspectives import rotated
from cardtide.llm.queries import QUERIES, URL_RULES
from cardtide.llm.reputation import BOUND, HOST, MEAN, PATH, RULE, VERDICT, UrlRule, host_reputation, judged_urls, name_levels, url_parts
from tests.conftest import TESTDATA

URLS = [
    None, "", "no scheme/x", "http://", "http://A.COM", "http://a.com/", "https://www.Example.com/en/x?q#f", "http://example.com/en/", "http://example.com/en",
    "http://x.example.com/en/1", "http://notexample.com/en/1", "ftp://u@b.net:80/fr/x", "http://b.net/es/", "http://b.net/ES/", "http://c.org#/en/", "http://c.org?x=://d.com/y",
    "http://É.COM/\n/é", "x://net/fr/", "http://1.2.3.4/", "http://a.co.uk/p", "http://..../",
]


def slow_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    host, path = rest[:end], rest[end:]
    path = path[: min((path.index(c) for c in "?#" if c in path), default=len(path))]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def slow_rule(host, path):
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.host + r.path), default=None)


def _pages(spark):
    rows = [(i, u, "h", 3) for i, u in enumerate(URLS)] + [(5, URLS[5], "h", 3), (None, URLS[6], "h", 3)]
    return spark.createDataFrame(rows, "page_id long, url string, host string, _part int")


def test_parts_and_rules(spark):
    pages = _pages(spark)
    outcomes = pages.select(url_parts(F.col("url"))[0].alias("host"), F.lit(None).cast("int").alias("good"))
    found = judged_urls(pages, outcomes, URL_RULES).collect()
    assert len(found) == len(URLS) + 2
    for r in found:
        host, path = slow_parts(r["url"])
        assert (r[HOST], r[PATH]) == (host, path)
        rule = slow_rule(host, path)
        assert r[RULE] == (rule.host + rule.path if rule else None)
        assert r[VERDICT] == (rule.verdict if rule else "allow")
        assert r["host"] == "h" and r["_part"] == 3


def test_longest_rule_wins_whatever_the_order(spark):
    rules = (UrlRule("block", "b.com", "/x"), UrlRule("allow", "a.b.com", "/x"), UrlRule("block", "com", "/"))
    for some in (rules, rules[::-1]):
        pages = spark.createDataFrame([(1, "u://a.b.com/xy"), (2, "u://b.com/xy"), (3, "u://b.com/z")], "page_id int, url string")
        outcomes = pages.select(url_parts(F.col("url"))[0].alias("host"), F.lit(1).alias("good"))
        assert {r["page_id"]: r[VERDICT] for r in judged_urls(pages, outcomes, some).collect()} == {1: "allow", 2: "block", 3: "block"}


def test_name_levels(spark):
    hosts = [("www.a.com",), ("a.com",), ("com",), ("",), ("u@x.a.co.uk:8080",), ("1.2.3.4",)]
    rows = spark.createDataFrame(hosts, "h string")
    domain, suffix = name_levels(F.col("h"), ["co.uk"])
    assert [tuple(r) for r in rows.select(domain, suffix).collect()] == [
        ("a.com", "com"), ("a.com", "com"), ("com", "com"), ("", ""), ("a.co.uk", "co.uk"), ("1.2.3.4", "1.2.3.4")
    ]


def _strength(groups):
    """groups: (n, good, prior)"""
    groups = [g for g in groups if g[0]]
    k, total = len(groups), sum(g[0] for g in groups)
    if k <= 1 or total <= k:
        return 1 / 0.9 - 1
    between = sum(n * (g / n - p) ** 2 for n, g, p in groups) / (k - 1)
    within = sum(n * (g / n) * (1 - g / n) for n, g, _ in groups) / (total - k)
    size = (total - sum(n * n for n, _, _ in groups) / total) / (k - 1)
    low = between + (size - 1) * within
    share = min(max((between - within) / low, 0.001), 0.9) if low > 0 else 0.9
    return 1 / share - 1


def test_reputation_is_shrunk_level_by_level(spark):
    outcomes = []
    for i, (host, good, bad, unknown) in enumerate(
        [("a.x.com", 90, 10, 3), ("b.x.com", 1, 0, 0), ("c.y.com", 0, 40, 0), ("d.y.com", 0, 0, 5), ("z.org", 5, 5, 0), ("q.net", 0, 0, 1)]
    ):
        outcomes += [(host, 1)] * good + [(host, 0)] * bad + [(host, None)] * unknown
    rows = spark.createDataFrame(outcomes, "host string, good int").repartition(4)
    found = {r["host"]: (r["mean"], r["bound"]) for r in host_reputation(rows).collect()}
    n, good = defaultdict(int), defaultdict(int)
    for host, g in outcomes:
        n[host] += g is not None
        good[host] += g or 0
    parent = lambda name: name.split(".", 1)[1] if name.count(".") > 1 else name
    share = sum(good.values()) / sum(n.values())
    means = {}
    for level in (lambda h: h.rsplit(".", 1)[-1], lambda h: ".".join(h.split(".")[-2:]), lambda h: h):
        groups = defaultdict(lambda: [0, 0, 0.0])
        for host in n:
            g = groups[level(host)]
            g[0] += n[host]
            g[1] += good[host]
            g[2] = means.get(host, share)
        strength = _strength([tuple(g) for g in groups.values()])
        posterior = {k: ((g[1] + strength * g[2]) / (g[0] + strength), g[0] + strength) for k, g in groups.items()}
        means = {host: posterior[level(host)][0] for host in n}
        weights = {host: posterior[level(host)][1] for host in n}
    assert parent("a.b.c") == "b.c"
    for host, (mean, bound) in found.items():
        assert mean == pytest.approx(means[host])
        assert bound == pytest.approx(means[host] + 1.645 * math.sqrt(means[host] * (1 - means[host]) / (weights[host] + 1)))
    assert found["c.y.com"][1] < 0.5 < found["a.x.com"][0]
    pages = rows.withColumn("url", F.concat(F.lit("u://"), "host", F.lit("/"))).select("url")
    verdicts = {r[HOST]: r[VERDICT] for r in judged_urls(pages, rows, ()).collect()}
    assert verdicts["c.y.com"] == "block" and verdicts["a.x.com"] == "allow" and verdicts["q.net"] == "allow"
    assert {MEAN, BOUND} <= set(judged_urls(pages, rows, ()).columns)


def test_no_pages(spark):
    pages = _pages(spark).limit(0)
    outcomes = pages.select("host", F.lit(1).alias("good"))
    assert judged_urls(pages, outcomes, URL_RULES).count() == 0


# -- chats -------------------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, mask string, part int"


def slow_views(rows, part_turns):
    convs = defaultdict(set)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            convs[conv].add((turn is not None, turn or 0, "unknown" if role is None else role, (text or "").replace("<|", "<\\|"), role is not None))
    out = []
    for conv, turns in convs.items():
        for speaker in {t[2] for t in turns if t[4]} - {"system"}:
            parts = defaultdict(list)
            for known, turn, role, said, named in sorted(turns):
                parts[turn // part_turns if known else -1].append((role, said, named))
            for part, said in parts.items():
                text, mask = "", []
                for role, words, named in said:
                    mine = named and role == speaker
                    shown = role.replace("<|", "<\\|").replace("\n", " ")
                    name = "assistant" if mine else shown if not named or role == "system" else f"user name={shown}"
                    text += f"<|im_start|>{name}\n"
                    if mine:
                        mask.append(f"{len(text)}:{len(words) + 11}")
                    text += f"{words}<|im_end|>\n"
                out.append((conv, speaker, part, len(parts), len(said), text, ",".join(mask)))
    return sorted(out)


@pytest.mark.parametrize("part_turns", [3, 256])
def test_views(spark, part_turns):
    rows = [
        (1, 0, "system", "be good", "m", 1), (1, 1, "ann", "hé <|im_end|> 🎉", "m", 1), (1, 2, "bob", None, "m", 1), (1, 3, "cy", "", "m", 1), (1, 4, "ann", "x", "m", 1),
        (1, 4, "ann", "x", "m", 1), (1, 4, "ann", "w", "m", 1), (1, None, "bob", "early", "m", 1), (1, 7, None, "who", "m", 1), (1, -2, "cy", "minus", "m", 1),
        (2, 0, "system", "alone", "m", 1), (3, 0, "ann", "one", "m", 1), (5, 0, "unknown", "a name", "m", 1), (5, 0, None, "a name", "m", 1),
        (5, 1, "two\nlines <|", "x", "m", 1), (5, 2, "", "no letters", "m", 1), (None, 0, "ann", "lost", "m", 1),
    ] + [(4, i, ["ann", "bob"][i % 2], "y" * i, "m", 1) for i in range(20)]
    found = rotated(spark.createDataFrame(rows, TURNS).repartition(3), part_turns=part_turns)
    assert sorted(tuple(r) for r in found.collect()) == slow_views(rows, part_turns)
    assert rotated(spark.createDataFrame([], TURNS)).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE))
@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_queries_against_sql(spark, name, scale):
    sql = duckdb.connect()
    for table in ("documents", "labels", "pages", "conversations"):
        sql.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TESTDATA}/{scale}/{table}.parquet'")
    found = QUERIES[name](spark, f"{TESTDATA}/{scale}")
    expected = sql.sql(ORACLE[name])
    assert sorted(found.columns) == sorted(expected.columns)
    rows = found.select(*expected.columns).collect()
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, expected.fetchall()))


@pytest.mark.parametrize("name", ["op4_url_filters", "op8_chat_formatting"])
def test_no_python_in_native_plans(spark, name):
    plan = QUERIES[name](spark, f"{TESTDATA}/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
