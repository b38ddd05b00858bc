from __future__ import annotations

import random
import re
import time
import tracemalloc
from collections import Counter

import pytest

from ledgerstrata.llm.pages import deduce, extract, extract_one, numbered, parse, tokens

SCHEMA = "page_id long, url string, html string, host string, text string, container string"


def page(body, notice=""):
    return f'<html><head><title>t</title></head><body><nav><ul><li><a href="/">Home</a></li></ul></nav>{notice}{body}<footer>f</footer></body></html>'


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA)
    return {r["page_id"]: r for r in extract(df).collect()}, df.count()


@pytest.mark.parametrize(("given", "expected"), [
    ("", ""),
    ("plain &amp; text", "plain & text"),
    ("<article><h1>T</h1><p>a  b\n c<br>d<p>e <b>f</b>g</article>", "T a b c d e fg"),
    ('<script>if (a<b) "</p>";</script><article>x</article><style>p{}</style>', "x"),
    ('<main><p>one</p><div class="ad">buy</div><form>mail <input></form><p>two &lt;3 &#233;</main>', "one two <3 é"),
    ('<article><p>one</p><section id="comments"><article class="comment"><p>nice</article></section></article>', "one"),
    ("<nav>menu <article><p>body</p></article>", "body"),
    ("<article><header><h1>T</h1><p>by me</p></header><p>x</p><footer>tags</footer></article>", "T x"),
    ("<div hidden>no</div><div style='display: none'>no</div><aside>no</aside><p>yes</p>", "yes"),
    ("<p title='a>b'>x</p><!-- <p>no</p> --><p>y", "x y"),
    ("<article><p>a</p><p></p></article", "a"),
    ("<p>un<closed", "un"),
    ("<p>1 < 2 & 3 > 2</p>", "1 < 2 & 3 > 2"),
])
def test_one_page(given, expected):
    assert extract_one(given, None, frozenset()) == expected


def test_hosts(spark):
    """Without an article element the container comes from the template; constant text of a host is left out."""
    rows = [(i, f"http://A.example/{i}", page(
        f"<div class=c><p>story {i} about things that differ from page to page</p><ul><li>point {i}</li></ul></div>",
        "<div class=x>We keep to our rules on every page</div>")) for i in range(20)]
    rows += [(100 + i, "http://b.example/", page("<article><p>the same story</p></article>")) for i in range(20)]
    rows += [(200, None, None), (201, "no url", ""), (202, "http://c.example", page("<p>alone</p>")), (None, None, "<p>x"), rows[0]]
    found, n = run(spark, rows)
    assert n == len(rows)
    for i in range(20):
        assert found[i]["text"] == f"story {i} about things that differ from page to page point {i}"
        assert found[100 + i]["text"] == "the same story"
    assert (found[200]["text"], found[200]["n_chars"], found[201]["text"], found[202]["text"]) == ("", 0, "", "alone")
    assert found[None]["text"] == "x" and found[0]["url"] == "http://A.example/0"


def test_equivalence_classes():
    def member(token, parent, name, c=0, k=0):
        return {"token": token, "parent": parent, "name": name, "chars": c, "links": k}

    classes = [
        {"on": 10, "least": 1, "most": 1, "members": [member(1, 0, "body"), member(2, 1, "div", 5), member(3, 2, "div", 900),
                                                      member(-1, 1, "#")]},
        {"on": 10, "least": 2, "most": 9, "members": [member(4, 3, "p", 4000), member(5, 6, "li", 8000, 8000)]},
        {"on": 10, "least": 1, "most": 2, "members": [member(6, 1, "ul")]},
        {"on": 7, "least": 1, "most": 1, "members": [member(-2, 1, "#")]},
    ]
    assert deduce(10, classes) == (3, [-1])


def test_paths():
    counts, paths, _ = parse('<ul class="a b"><li>1<li>2</ul><p>x<p>y')
    above = numbered(0, "ul.a")
    assert counts == {above: 1, numbered(above, "li"): 2, numbered(0, "p"): 2}
    assert paths[numbered(above, "li")] == (above, "li")


def vectors(pages):
    """Occurrence vectors by brute force: every path and block of text, as written out, over all pages."""
    found = {}
    for k, page in enumerate(pages):
        stack, seen = [], Counter()
        for tag, word in re.findall(r"<(/?\w+)[^>]*>|([^<>]+)", page):
            if word.strip():
                seen["/".join(stack) + "#" + word.strip()] += 1
            elif tag.startswith("/"):
                while stack and stack.pop() != tag[1:]:
                    pass
            elif tag:
                stack.append(tag)
                seen["/".join(stack)] += 1
        for token, n in seen.items():
            found.setdefault(token, [0] * len(pages))[k] = n
    return found


def test_tokens_have_the_vectors_of_brute_force(spark):
    rng = random.Random(4)
    given = []
    for _ in range(12):
        items = "".join(f"<section><h2>{rng.choice('ab')}</h2><div>{rng.choice('cde')} text</div></section>" for _ in range(rng.randrange(1, 5)))
        given.append(f"<html><body><div>same</div>{items}<section>last</section></body></html>")
    df = spark.createDataFrame([("h", i, g) for i, g in enumerate(given)], "host string, page_id long, html string")
    rows = tokens(df).collect()
    ours = {}
    for r in rows:
        ours.setdefault(r["token"], [0] * len(given))[r["page_id"]] = r["n"]
    assert sorted(ours.values()) == sorted(vectors(given).values())


def test_template_decides_inside_articles(spark):
    """Boilerplate inside the article, under names no list knows, goes; two pages are enough."""
    def body(i):
        return (f'<div class="zq1"><article><div class="zq2">Read our magazine every week</div><p>story {i} of its own</p>'
                f'<p class="zq3">All rights with us</p></article></div><div class="zq4">teaser {i} for something else</div>')

    rows = [(i, "http://two.example/", page(body(i))) for i in range(2)]
    rows += [(9, "http://one.example/", page(body(9)))]
    found, _ = run(spark, rows)
    assert [found[i]["text"] for i in range(2)] == ["story 0 of its own", "story 1 of its own"]
    # one page alone says nothing about its host
    assert found[9]["text"] == "Read our magazine every week story 9 of its own All rights with us"


def test_copies_of_a_page_are_no_template(spark):
    found, _ = run(spark, [(i, "http://b.example/", page("<article><p>the same</p><p>story</p></article>")) for i in range(3)])
    assert {r["text"] for r in found.values()} == {"the same story"}


@pytest.mark.parametrize("unit", ["<div>x", "<b>x", "<section><p>x", "<custom>x</other>", "<a><h1><li>x"])
def test_deep_pages_take_time_and_memory_in_proportion(unit):
    def cost(n):
        tracemalloc.start()
        started = time.process_time()
        found = extract_one(unit * n, None, frozenset())
        spent = time.process_time() - started
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert found.count("x") == n
        return spent, peak

    (t1, m1), (t2, m2) = cost(3000), cost(24_000)
    assert m2 < 12 * m1 and t2 < 25 * t1 + 1


def test_ends_below_the_deepest_path():
    """Beyond DEEPEST elements are still opened and closed."""
    deep = "<div>" * 2000
    given = f"{deep}<p>one</p><aside>no</aside><article><nav>no</nav>two</article>"
    assert extract_one(given, None, frozenset()) == "two"
    assert extract_one(f"{deep}<p>one</p><aside>no</aside><p>two", None, frozenset()) == "one two"


def test_empty(spark):
    assert extract(spark.createDataFrame([], SCHEMA)).collect() == []


def test_end_tag_far_behind_an_article():
    """A comment list that is closed more than 1 MiB later stays apart."""
    for size in (10, 1 << 21):
        comment = f'<article class="comment"><p>{"nice " * (size // 5)}</p></article>'
        given = f'<main><p>one</p><section id="comments">{comment}</section></main>'
        assert extract_one(given, None, frozenset()) == "one"
        given = f'<section id="comments"><article><p>{"nice " * (size // 5)}</p></article></section><article>one</article>'
        assert extract_one(given, None, frozenset()) == "one"
