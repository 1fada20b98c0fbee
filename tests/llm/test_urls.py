"""The URL automaton against regular expressions and a plain reading of the rules."""

import re

import duckdb
from hypothesis import example, given, settings
from hypothesis import strategies as st

from starmart.llm import urls
from starmart.llm.oracle import ORACLES
from starmart.llm.queries import op13_shift_and_urls
from starmart.llm.urls import Automaton, allowed, compile_filter, encoded, filter_urls, parse_glob

SCHEMA = "page_id long, url string, host string, verdict int"


def regex_of(glob):
    out, i = "", 0
    while i < len(glob):
        c = glob[i]
        if glob[i:i + 2] == "**":
            out, i = out + ".*", i + 2
            continue
        if c == "[" and "]" in glob[i + 2:]:
            end = glob.index("]", i + 2)
            inside = glob[i + 1:end]
            neg = inside.startswith("^")
            out += "[" + "^" * neg + re.escape(inside.lstrip("^") if neg else inside) + "]"
            i = end + 1
            continue
        if c == "\\" and i + 1 < len(glob):
            i += 1
            out += re.escape(encoded(glob[i]).decode())
        else:
            out += {"*": "[^/]*", "?": "[^/]"}.get(c) or re.escape(encoded(c).decode())
        i += 1
    return re.compile(out, re.S)


globs = st.lists(st.text(st.sampled_from("ab./*?-é"), max_size=90), min_size=1, max_size=9)
paths = st.lists(st.text(st.sampled_from("ab./-é"), max_size=30), min_size=1, max_size=9)


@settings(max_examples=200, deadline=None)
@given(globs, paths)
@example(["a" * 63 + "*b", "a" * 200 + "**", "*" + "[^ab]?" + "\\*"], ["a" * 90 + "b", "a" * 300, "xy*"])
def test_automaton_equals_regular_expressions(globs, texts):
    auto = Automaton([parse_glob(g) for g in globs])
    got = auto.first_match([encoded(t) for t in texts])
    patterns = [regex_of(g) for g in globs]
    for t, k in zip(texts, got.tolist()):
        fits = [i for i, p in enumerate(patterns) if p.fullmatch(encoded(t).decode())]
        assert k == min(fits, default=len(globs))


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), path


def judged(url, rules):
    host, path = split(url)
    fit = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fit, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[0] == "block"), default=None)
    return host, path, best and best[1] + best[2], best and best[0]


URLS = ["http://a.ORG/x", "https://example.org/es/1", "https://www.example.org/en/12?q=/es/",
        "http://badexample.org/es/", "http://x.com/fr/1", "http://x.com/de/1#a", "ftp://x.com/de",
        "http://x.org", "http://x.org?y=/", "x.org/", None, "", "://org/", "http://org/",
        "http://a.com/.example.org/es/", "http://casino-win.net/en/", "http://thecasinos.net/en/",
        "http://www.casino-win.example.org/en/3", "http://ÉÀ.com/fr/é", "a://b://c.org/d",
        "http://x.com/fr/" + "y" * 100_000, "http://x.edu/cgi-bin/a", "http://h.net/a.exe",
        "http://h.net/a\nb.exe", "http://casino/", "http://a.com:80/fr/1"]


def test_rules_like_a_plain_reading(spark):
    rows = [(i, u, "h", 1) for i, u in enumerate(URLS + URLS[:3])] + [(None, URLS[0], None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for r, url in zip(sorted(filter_urls(df).collect(), key=lambda r: (r[0] is None, r[0])),
                      [r[1] for r in rows]):
        host, path, rule, verdict = judged(url, urls.RULES)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), url
        assert verdict is None or r["verdict"] == verdict
    kept = allowed(df)
    assert kept.columns == df.columns
    assert kept.count() == filter_urls(df).where("verdict = 'allow'").count()


def test_method_where_no_rule_fits(spark):
    df = spark.createDataFrame([(i, u, None, None) for i, u in enumerate(URLS)], SCHEMA)
    got = {URLS[r["page_id"]]: (r["glob"], r["verdict"]) for r in filter_urls(df).collect()}
    assert got["http://casino-win.net/en/"] == ("*[.-]casino[.-]**", "block")
    assert got["http://thecasinos.net/en/"] == (None, "allow") == got[None]
    assert got["http://x.edu/cgi-bin/a"] == ("**/cgi-bin/**", "block") and got["http://h.net/a.exe"][1] == "block"
    assert got["http://h.net/a\nb.exe"][1] == "block"
    blocked = filter_urls(df, rules=[], globs=[], default="block")
    assert blocked.where("verdict = 'block'").count() == len(URLS)


def test_ranks_and_names():
    f = compile_filter([("allow", "b.com", "/x/"), ("block", "a.b.com", "/")], [("allow", "**ab"), ("block", "**a")])
    assert f.rules[:2] == ["a.b.com/", "b.com/x/"] and f.globs[2:4] == ["**a", "**ab"]
    star = compile_filter([("block", "a.com", "/*")], [])
    assert star.automaton.first_match([b".a.com/b", b".a.com/*b"]).tolist() == [1, 0]


def test_empty_table(spark):
    assert filter_urls(spark.createDataFrame([], SCHEMA)).collect() == []


def test_sql(spark):
    from tests.conftest import SF001
    got = op13_shift_and_urls(spark, SF001)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF001}/pages.parquet'")
    rel = con.execute(ORACLES["op13_shift_and_urls"])
    names = [d[0] for d in rel.description]
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r) for r in got.select(*names).collect()), key=key) == sorted(rel.fetchall(), key=key)
    assert got.columns == names
    rows = list(enumerate(URLS))
    con.execute("CREATE OR REPLACE TABLE own (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO own VALUES (?, ?)", rows)
    want = con.execute(ORACLES["op13_shift_and_urls"].replace("FROM pages", "FROM own")).fetchall()
    mine = filter_urls(spark.createDataFrame(rows, "page_id long, url string")).select(*names)
    assert sorted((tuple(r) for r in mine.collect()), key=key) == sorted(want, key=key)
