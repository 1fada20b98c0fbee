"""Operator 3: structure, repeats over a host, awkward markup."""

import html
import random
import re

import pytest

from starmart.llm import pages as P

DATA = "/root/testdata/sf0.1"


def naive_repeats(streams):
    """Tokens in a run of DEPTH that starts on two or more pages, by comparing all runs."""
    where = {}
    for p, s in enumerate(streams):
        for i in range(len(s) - P.DEPTH + 1):
            where.setdefault(tuple(s[i:i + P.DEPTH]), set()).add(p)
    out = []
    for s in streams:
        mark = [False] * len(s)
        for i in range(len(s) - P.DEPTH + 1):
            if len(where[tuple(s[i:i + P.DEPTH])]) > 1:
                mark[i:i + P.DEPTH] = [True] * P.DEPTH
        out.append(mark)
    return out


@pytest.mark.parametrize("seed", range(5))
def test_suffix_array_against_all_runs(seed):
    rng = random.Random(seed)
    streams = []
    shared = [rng.choice("abc") for _ in range(25)]
    for _ in range(12):
        s = [rng.choice("abcdefgh") for _ in range(rng.choice([0, 3, 30, 80]))]
        if rng.random() < .6:
            a = rng.randrange(20)
            s[len(s) // 2:len(s) // 2] = shared[a:]
        streams.append(s)
    assert [m.tolist() for m in P.covered(streams)] == naive_repeats(streams)


def test_nothing_to_sort():
    assert [len(m) for m in P.covered([])] == [] and [len(m) for m in P.covered([[], []])] == [0, 0]


def page(body, title="t"):
    return f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style></head><body>{body}</body></html>"


def test_marked_articles():
    body = ('<nav><ul><li>Home</li></ul></nav><div class="ad">Buy</div><aside>side</aside>'
            '<article><h1>Head &amp; more</h1><p>One <b>bo</b>ld&nbsp;x<br>next<p>Two &lt;3 &#233; &unknown;'
            '<ul><li>a<li>b</ul><div id="cookie-notice">cookies</div><form>f<input></form>'
            '<script>if (a<b) "</p>"</script><section class="comments"><p>nice!</p></section>'
            '<figure><figcaption>Cap</figcaption></figure></article><footer>&copy; x</footer>')
    assert P.extract([page(body)])[0] == "Head & more One bold x next Two <3 é &unknown; a b Cap"


def test_odd_markup():
    cases = {None: "", "": "", "plain text": "plain text", "<p>open": "open", "a < b and c > d": "a < b and c > d",
             "<article><p>cut off <b>here": "cut off here", "<!-- x --><p>y</p><!-- never ends": "y",
             "<p>a</b></i></p></div>b": "a b", "<main><p>m</p></main><p>out</p>": "m",
             "<script>never ends": "", "<p title='a>b'>c</p>": "c", "<P CLASS=Ad>x</P><p>y": "y",
             "<div hidden>h</div><div style='display: none'>n</div>v": "v", "<textarea>t</textarea>z": "z",
             "<article class='comment'>c</article><p>w</p>": "w", "\n\t <p>  a \n b </p>": "a b",
             "<p>" + "long " * 50000 + "</p>": ("long " * 50000).strip()}
    for raw, want in cases.items():
        assert P.extract([raw])[0] == want, raw and raw[:60]


def test_unmarked_pages_keep_their_unique_runs():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(6))
    own = [" ".join(word() for _ in range(40)) for _ in range(6)]
    chrome = "<div class='x1'><p>Welcome to the site of all the good things we sell here</p></div>"
    tail = "<div class='x2'><p>Write to us at any time of the day or of the night</p></div>"
    got = P.extract([page(f"{chrome}<div class='x3'><p>{t}</p></div>{tail}") for t in own])
    assert got == own
    # A single page repeats nothing and keeps all.
    assert "Welcome" in P.extract([page(f"{chrome}<p>{own[0]}</p>")])[0]


def test_template_container_inside_articles():
    box = "<div class='x9'><p>Join our readers and get all the stories each day by mail</p></div>"
    got = P.extract([page(f"<article><p>unique {i} story</p>{box}<p>a passage that all of the articles quote "
                          f"word for word</p></article>") for i in range(4)])
    for i, t in enumerate(got):
        assert t == f"unique {i} story a passage that all of the articles quote word for word"


def test_articles_of_the_given_pages(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    raw = {r["page_id"]: r["html"] for r in pages.collect()}
    got = P.main_text(pages).collect()
    assert sorted(r["page_id"] for r in got) == sorted(raw)
    for r in got:
        m = re.search(r"<article>(.*?)</article>", raw[r["page_id"]], re.S)[1]
        m = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)\b[^>]*>", " ", m))
        assert r["text"] == " ".join(html.unescape(m).split()) and r["n_chars"] == len(r["text"])


def test_awkward_rows_and_large_hosts(spark, monkeypatch):
    monkeypatch.setattr(P, "PORTION", 500)
    body = "<article><p>text number {}</p></article>"
    rows = [(i, "http://Big.example/x", page(body.format(i)), "h", 1, 2) for i in range(40)]
    rows += [(50, None, page(body.format(50)), "", 0, 0), (None, "http://a.b/c?d", None, "", 0, 0),
             (51, "no host", "", "", 0, 0), rows[3], (2**60 + 1, "//h/", page("x"), "", 0, 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, bytes int, chunk int")
    got = P.main_text(pages).select("page_id", "url", "text", "n_chars").collect()
    want = [(p, u, "" if not h else "x" if "article" not in h else f"text number {p}") for p, u, h, *_ in rows]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(((r["page_id"], r["url"], r["text"]) for r in got), key=key) == sorted(want, key=key)
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert P.main_text(pages.limit(0)).collect() == []


def test_copies_of_a_page_are_one_page():
    plain = page("<div class='x1'><p>some words that are told on this one page of the host only</p></div>")
    article = page("<article class='post'><p>the whole story of this one page is told here and nowhere else</p></article>")
    alone = P.extract([plain]) + P.extract([article])
    assert all(alone)
    assert P.extract([plain] * 2) == alone[:1] * 2 and P.extract([article] * 3) == alone[1:] * 3
    # Equal streams of different html, beside another page.
    spaced = [article.replace("<p>", f"<p  id='{'i' * i}'>") for i in range(1, 4)]
    assert P.extract([*spaced, plain])[:3] == P.extract([article, plain])[:1] * 3
    assert [m.any() for m in P.covered([list("abcdefghij")] * 3)] == [False] * 3


def test_large_hosts_are_compared_whole(spark, monkeypatch):
    rng = random.Random(7)
    text = lambda n: " ".join(rng.choice("abcdefghijklmnop") + str(rng.randrange(60)) for _ in range(n))
    rare, chrome, boxes = text(20), text(15), [f"<div class='b{i}'><p>{text(14)}</p></div>" for i in range(12)]
    html_of = []
    for i in range(36):  # each box on three pages, each quote on two: far apart once dealt
        html_of.append(page(f"<article class='post'><p>{text(30)}</p>{boxes[i % 12]}<p>{rare}</p></article>"))
        html_of.append(page(f"<div><p>{text(30)}</p></div><div><p>{chrome if i < 2 else text(12)}</p></div>"))
    copy = page(f"<article class='once'><p>{text(40)}</p></article>")
    plain = page(f"<p>{text(40)}</p>")
    html_of += [copy] * 9 + [copy.replace("<p>", f"<p id='{'i' * i}'>") for i in range(5)] + [plain] * 9 + [None, "", "x"]
    html_of.append(page(f"<p>{text(3000)}</p><div><p>{chrome}</p></div>"))
    rows = [(i, f"http://{host}/{i}", h) for host in ("one.example", "two.example") for i, h in enumerate(html_of)]
    want = {(f"http://{host}/{i}", t) for host in ("one.example", "two.example")
            for i, t in enumerate(P.extract(html_of))}
    assert any(boxes[0][19:-10] in (h or "") for h in html_of) and not any(boxes[0][19:-10] in w[1] for w in want)
    rows += [(900, "http://small.example/", plain)]
    want |= {("http://small.example/", P.extract([plain])[0])}
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for chunk in (600, 5000):
        monkeypatch.setattr(P, "PORTION", chunk)
        got = P.main_text(pages).collect()
        assert {(r["url"], r["text"]) for r in got} == want and len(got) == len(rows)
        assert all(r["n_chars"] == len(r["text"]) for r in got)


def mixed_pages(rng, n):
    text = lambda k: " ".join(rng.choice("abcdefghij") + str(rng.randrange(40)) for _ in range(k))
    chrome, box, quote = text(16), text(12), text(14)
    out = []
    for i in range(n):
        own = "".join(f"<p>{text(rng.choice([3, 12, 25]))}</p>" for _ in range(rng.randrange(1, 4)))
        if i % 3:
            out.append(page(f"<div class='q'><p>{chrome}</p></div><div>{own}</div><p>{quote if i % 2 else text(9)}</p>"))
        else:
            out.append(page(f"<p>{chrome}</p><article>{own}<p>{quote}</p><div class='z'><p>{box}</p></div></article>"))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_repeats_decide_as_by_comparing_all_runs(seed, monkeypatch):
    """Extraction with every run compared with every other; without repeats, texts differ."""
    import numpy as np
    pages = mixed_pages(random.Random(seed), 18)
    pages += pages[:2]
    got = P.extract(pages)

    def naive(streams):
        distinct = list(dict.fromkeys(map(tuple, streams)))
        marks = dict(zip(distinct, naive_repeats(distinct)))
        return [np.array(marks[tuple(s)], bool) for s in streams]

    monkeypatch.setattr(P, "covered", naive)
    assert P.extract(pages) == got
    monkeypatch.setattr(P, "covered", lambda streams: [np.zeros(len(s), bool) for s in streams])
    off = P.extract(pages)
    assert sum(a != b for a, b in zip(got, off)) > len(pages) / 2


def test_portions_of_any_size_give_the_same_texts(spark, monkeypatch):
    pages = mixed_pages(random.Random(9), 30)
    rows = [(i, f"http://h{i % 2}.example/{i}", p) for i, p in enumerate(pages)]
    want = {}
    for h in (0, 1):
        mine = [r for r in rows if r[0] % 2 == h]
        want |= {r[0]: t for r, t in zip(mine, P.extract([r[2] for r in mine]))}
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for portion, parts in ((1, 1), (3000, 4), (1 << 20, 1)):
        monkeypatch.setattr(P, "PORTION", portion)
        got = P.main_text(df.repartition(parts)).collect()
        assert {r["page_id"]: r["text"] for r in got} == want


def test_packed_columns():
    import numpy as np
    cols = [np.array([0, 5, (1 << 48) - 1]), np.array([7, 0, 1 << 40])]
    assert [c.tolist() for c in P._unpacked(P._packed(*cols), 2)] == [c.tolist() for c in cols]
    assert [len(c) for c in P._unpacked(P._packed(cols[0][:0], cols[1][:0]), 2)] == [0, 0]
