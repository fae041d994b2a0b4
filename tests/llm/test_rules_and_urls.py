"""Quality rules, their learner, and URL rules."""

import random
import re
from collections import Counter

import duckdb
from conftest import SF
from edge_rows import edge, nothing  # noqa: F401

from arenamart.llm import quality_rules as q
from arenamart.llm import url_filter as u

NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def brute(text):
    text = text or ""
    w = re.findall("[^\x20\x09-\x0d]+", text)
    triples = list(zip(w, w[1:], w[2:]))
    count, covered, seen, repeated = Counter(triples), set(), set(), 0
    for i, t in enumerate(triples):
        if count[t] > 1:
            covered |= {i, i + 1, i + 2}
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            repeated += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered))


def test_statistics(spark, edge):  # noqa: F811
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    hard = ["a a a a a", "a b c a b c", "x y z x y", "<a>\r\n<a>\n <a>\n<a>", "é # é # é # é", "a\x0bb\x0cc a b c", "\n\n", "#" * 50]
    more = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(hard)], docs.schema)
    for df in (docs.union(more), edge):
        for r in q.with_statistics(df).collect():
            assert tuple(r[n] for n in NAMES) == brute(r["text"]), r["doc_id"]
    assert q.with_statistics(edge).columns.count("n_words") == 1


def test_query(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for r in q.op3_quality_rules(spark, SF).collect():
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
        if not r.base_failed and labels.get(r.doc_id) == 1:
            assert r.kept


def test_learner_finds_a_conjunction():
    rnd = random.Random(5)
    rows = [({"a": rnd.random(), "b": rnd.random(), "c": rnd.random()}, 0) for _ in range(900)]
    rows = [(r, int(r["a"] > 0.7 and r["b"] <= 0.5)) for r, _ in rows]
    rules = q.learn_list(rows, ["a", "b", "c"])
    fresh = [{"a": rnd.random(), "b": rnd.random(), "c": rnd.random()} for _ in range(900)]
    right = sum(any(x.covers(r) for x in rules) == (r["a"] > 0.7 and r["b"] <= 0.5) for r in fresh)
    assert right > 850 and all(len(x.conditions) <= 3 for x in rules)
    assert q.learn_list([], ["a"]) == [] and q.learn_list([(r, 0) for r in fresh], ["a"]) == []


def test_verdict_follows_the_list(spark, edge, nothing):  # noqa: F811
    rules = [q.Rule((q.Condition("words", True, 150_000.0),)), q.Rule((q.Condition("symbols_per_char", True, 0.5), q.Condition("words", False, 10.0)))]
    got = q.with_statistics(edge).select("doc_id", q.verdict(rules).alias("kept")).collect()
    assert {r.doc_id for r in got if r.kept} == {1, 2, 3}
    assert q.with_statistics(nothing).select(q.verdict(rules)).count() == 0
    assert q.learn(nothing, nothing.selectExpr("doc_id", "score as quality")) == []


def parts(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return ("".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")


def judged(url):
    host, path = parts(url)
    best = None
    for r in u.RULES:
        h, slash, p = r.name.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith(slash + p) and (best is None or len(r.name) > len(best.name)):
            best = r
    own = any(re.search(rf"(^|[.-]){w}([.-]|$)", host) for w in u.HOST_WORDS)
    return (host, path, best.name if best else None, best.verdict if best else "block" if own else "allow")


URLS = [
    None, "", "no scheme", "http://", "http://com/", "http://com", "http://www.Example.com/en/x?y#z", "http://a.www.example.com/en/",
    "https://example.com/EN/", "https://example.com/en", "x://bexample.com/en/", "x://a.net/es/b://c.com/", "x://net/fr/", "x://net/de/",
    "http://spam-farm.example.org/en/", "http://casino.org", "http://antispam.org/", "http://a.com?b", "http://é.net/es/ü", "http://a.com/en/\nx", "a\nb://c.com/d",
]


def test_urls(spark):
    pages = spark.createDataFrame([(i % 7, x, i) for i, x in enumerate(URLS * 2)], "page_id int, url string, host int")
    got = sorted((tuple(r) for r in u.judge(pages).collect()), key=str)
    assert got == sorted(((i % 7, *judged(x)) for i, x in enumerate(URLS * 2)), key=str)
    assert u.judge(pages.limit(0)).count() == 0


def test_rules_stand_under_their_rarest_token(spark):
    urls = spark.createDataFrame([(["com", "example", "en", ""],), (["com", "www", ""],), (["com", "example"],)], "_tokens array<string>")
    index = {r._rule: r._token for r in u.rule_index(urls, (*u.RULES, u.prefix_rule("x", "block"))).collect()}
    assert index["example.com/en/"] == "en" and index["com/"] == "com" and index["net/es/"] in ("net", "es")
    # the token that ends a rule may go on in a url
    assert index["x"] == "" and u.prefix_rule("a.b/c", "allow").tokens == ("a", "b")


def test_sql_agrees(spark):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{SF}/pages.parquet'")
    found = con.execute(u.OP5_SQL)
    got = u.op5_url_filter(spark, SF)
    assert [x[0] for x in found.description] == got.columns
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(found.fetchall(), key=str)


def test_path_is_behind_the_first_host(spark):
    urls = ["http://x.net?r=http://y.org/es/1", "http://x.net#http://y.org/es/1", "http://x.com?u=x://a/b", "x://", "x://a/b?c://d/e", "x://?a://b/c", "\n:/://a.net/es/x"]
    urls += ["http://x.net?" + "a" * 200_000 + "://y/es/", "a" * 200_000, "a" * 200_000 + "://net/es/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    got = sorted(tuple(r) for r in u.judge(pages).collect())
    assert got == [(i, *judged(x)) for i, x in enumerate(urls)]
    assert got[0] == (0, "x.net", "", None, "allow")
