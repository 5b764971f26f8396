"""URL filters against a plain version of the rules and of the mining, and edge cases."""

import itertools

from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.helpers import SF, collected, rows
from tickroll.llm import url_filter as u
from tickroll.llm.catalog import QUERIES
from tickroll.session import shared_dir

SCHEMA = "page_id long, url string, row int, tokens string, html string"


def judged(spark, pages, labels=()):
    df = spark.createDataFrame([(*p, 1, "t", "h") for p in pages], SCHEMA)
    marks = spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int, host string")
    return u.judge_urls(df, marks)


def check_rules(got, pages):
    found = sorted(((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"] if r["rule"] else None) for r in got.collect()), key=repr)
    assert found == sorted(((p, *brute.url_rule(url)) for p, url in pages), key=repr)


def test_query_on_the_pages(spark):
    check_rules(QUERIES["op10_url_filter"](spark, SF), rows("pages", "page_id", "url"))


URLS = [None, "", "no scheme/x", "http://", "http://ORG/", "http://org", "http://a.org?x/y", "https://x.EXAMPLE.org/es/1#f", "https://example.org/es",
        "https://badexample.org/es/1", "http://example.org/en/1234", "http://a.com/fr/1", "http://a.com/de/?q", "http://com/de/", "http://a.com.net/de/",
        "a://b://c/d", "http://é.com/fr/日?x=#", "http://a.com/FR/", "http://u:p@a.org:80/x", "http://a.org/x\ny?z", "http://" + "a." * 5000 + "org/" + "p/" * 5000]


def test_edge_cases(spark):
    pages = [(None if i == 3 else i, x) for i, x in enumerate(URLS)] * 2
    got = judged(spark, pages, [(1, None, None, "x"), (None, 0, 0, "x"), (4, 0, 0, "x"), (4, 1, 1, "x")])
    check_rules(got, pages)
    assert all(r["verdict"] in ("allow", "block") for r in got.collect())


def test_mined_rules_equal_a_plain_search(spark):
    pages, labels = [], []
    for i in range(120):
        bad = i % 3 == 0
        site = "casino" if bad and i % 2 else f"site{chr(97 + i % 7)}"
        pages.append((i, f"https://{site}.example.net/{'win' if bad else 'news'}/{i}?{'ref' if i % 5 else 'page'}=1"))
        labels.append((i, 0 if bad else 1, 0, "x"))
    df = spark.createDataFrame([(*p, 1, "t", "h") for p in pages], SCHEMA)
    urls = u.parsed(df)
    sets = {r["page_id"]: set(r["tokens"]) for r in urls.collect()}
    labelled = urls.select("page_id", "tokens").join(
        spark.createDataFrame(labels, "page_id long, q int, t int, h string").select("page_id", (F.col("q") == 0).alias("bad")), "page_id")
    got = {tuple(r["tokens"]): round(r["confidence"], 9) for r in u.mine_rules(labelled, 0.05, 5, 0.75).collect()}
    items = sorted(set().union(*sets.values()))
    sure = {}
    for n in range(1, 8):
        for combo in itertools.combinations(items, n):
            has = [i for i, s in sets.items() if s.issuperset(combo)]
            hit = sum(i % 3 == 0 for i in has)
            if has and hit >= 6 and hit / len(has) >= 0.75:
                if not any(set(x) < set(combo) and c >= hit / len(has) for x, c in sure.items()):
                    sure[combo] = hit / len(has)
    assert got == {k: round(v, 9) for k, v in sure.items()} and got
    blocked = {r["page_id"] for r in judged(spark, pages, labels).filter("verdict = 'block'").collect()}
    assert blocked == {i for i in range(120) if i % 3 == 0}


def test_mined_rules_decide_the_query(spark):
    """Bad urls share 14 tokens that always come together; any of them blocks, list rules still go first."""
    keys = [f"k{chr(97 + i)}" for i in range(14)]
    bad = [f"https://a.net/x/{i}?" + "&".join(f"{k}={i}" for k in keys) for i in range(30)]
    good = [f"https://a.net/x/{i}?page={i}&ref={i}" for i in range(60)]
    unseen = [("https://b.net/other?kc=1", "block"), ("https://b.net/other?kz=1", "allow"), ("http://m.com/fr/?kb=2", "allow"),
              ("http://a.org/de/?page=1", "allow"), (None, "allow")]
    folder = shared_dir(spark, "url-rules-test")
    urls = bad + good + [u_ for u_, _ in unseen]
    spark.createDataFrame([(i, x, 1, "t", "h") for i, x in enumerate(urls)], SCHEMA).write.parquet(f"{folder}/pages.parquet")
    spark.createDataFrame([(i, 0 if i < 30 else 1, 0, "x") for i in range(90)], "doc_id long, quality int, toxic int, host string").write.parquet(
        f"{folder}/labels.parquet")
    got = {r["page_id"]: r for r in QUERIES["op10_url_filter"](spark, folder).collect()}
    assert [got[i]["verdict"] for i in range(90)] == ["block"] * 30 + ["allow"] * 60
    assert [(got[90 + i]["verdict"]) for i in range(len(unseen))] == [v for _, v in unseen]
    assert {(got[i]["n_rules"], got[i]["confidence"]) for i in (*range(30), 90, 92)} == {(1, 1.0)}
    rules = u.mine_rules(u.parsed(spark.read.parquet(f"{folder}/pages.parquet")).filter("page_id < 90").select("tokens", (F.col("page_id") < 30).alias("bad")))
    assert collected(rules, "confidence") == [(1.0,)] * 14 and {tuple(r["tokens"]) for r in rules.collect()} == {(f"query:{k}",) for k in keys}


def test_a_token_of_every_page_is_a_rule_only_by_the_base_rate(spark):
    rows_ = [(["all", "a"] if i % 2 else ["all"], i > 1) for i in range(20)]
    found = lambda data: sorted(tuple(r["tokens"]) for r in u.mine_rules(spark.createDataFrame(data, "tokens array<string>, bad boolean")).collect())
    assert found(rows_) == [("a",), ("all",)]
    assert found([(t, i < 5) for i, (t, _) in enumerate(rows_)]) == []


def test_rules_match_only_whole_token_sets(spark):
    df = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["a", "c"]), (3, []), (4, ["b"])], "row long, tokens array<string>")
    rules = spark.createDataFrame([(["a", "b"], 0.9, 0.1), (["c"], 0.8, 0.1), (["zz"], 0.8, 0.1)], "tokens array<string>, confidence double, support double")
    assert collected(u.matched_rules(df, rules), "row", "n_rules", "confidence") == [(1, 2, 0.9), (2, 1, 0.8)]


def test_empty_tables(spark):
    assert collected(judged(spark, [], [(1, 0, 0, "x")])) == []
    assert [r["verdict"] for r in judged(spark, [(1, "http://a.net/")]).collect()] == ["allow"]
