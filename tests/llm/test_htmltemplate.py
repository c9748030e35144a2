"""HTML extraction on planted hosts, broken markup and the given pages."""

import html
import re

from conftest import SF_SMALL
from pyspark.sql import functions as F

from scorecast.llm import htmltemplate as H

SCHEMA = "page_id long, url string, html string"


def page(i, body):
    return (f'<!DOCTYPE html><html><head><title>T{i}</title><style>p{{}}</style><script>var a="<p>no</p>";</script></head><body class="home">'
            f'<header><h1>Site</h1></header><nav><ul><li><a href="/a">Home {i}</a></li></ul></nav><!-- <p>hidden</p> -->{body}'
            f'<div class="cookie-notice">We use cookies</div><aside>Side {i}</aside><section id="comments-{i}"><p>Great post!</p></section>'
            f"<form><p>Mail</p><input></form><footer>&copy; {i}</footer></body></html>")


def texts(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).select("*", F.lit("x").alias("host"), F.lit(1).alias("n_chars"), F.lit(2).alias("token"))
    return {r["page_id"]: r for r in H.extract(df).collect()}


def test_article_without_boilerplate(spark):
    rows = [(i, f"https://h.example/{i}", page(i, f"<article><header>By me<h2>Head {i}</h2></header><p>One &amp;  two\n{i}</p><p><b>bold<br>line<p>last</article>"))
            for i in range(6)]
    got = texts(spark, rows)
    for i in range(6):
        want = f"Head {i}\n\nOne & two {i}\n\nbold line\n\nlast"
        assert (got[i]["text"], got[i]["n_chars"], got[i]["url"]) == (want, len(want), f"https://h.example/{i}")


def test_template_texts_and_link_slots_go(spark):
    body = "<div class='top'>Welcome to our site</div><div class='body'><p>Story {i} tells more.</p></div><div class='more'><a href='x'>Link {i}</a> <a>Other {i}</a></div>"
    got = texts(spark, [(i, f"http://t.example/{i}", page(i, body.format(i=i))) for i in range(8)])
    assert [got[i]["text"] for i in range(8)] == [f"Story {i} tells more." for i in range(8)]
    # a small host proves no constant text
    got = texts(spark, [(i, f"http://t.example/{i}", page(i, body.format(i=i))) for i in range(2)])
    assert got[0]["text"] == "Welcome to our site\n\nStory 0 tells more."


def test_repeated_articles_stay(spark):
    rows = [(i, "http://m.example/x", page(0, "<main><p>The same article on every page.</p></main>")) for i in range(9)]
    assert {r["text"] for r in texts(spark, rows).values()} == {"The same article on every page."}


def test_template_decides_inside_main(spark):
    body = ("<article><p>Story {i} tells more.</p><p>Subscribe to our letter for daily news.</p><p class='more'><a href='{i}'>Read {i}</a></p>"
            "<p><a href='x'>Link {i}</a> opens a paragraph of prose.</p></article>")
    got = texts(spark, [(i, f"http://c.example/{i}", page(i, body.format(i=i))) for i in range(40)])
    assert [got[i]["text"] for i in range(40)] == [f"Story {i} tells more.\n\nLink {i} opens a paragraph of prose." for i in range(40)]
    # many copies of one article are one page and prove nothing, with or without a telling tag
    for tag in ("main", "div"):
        copies = [(i, f"http://c.example/{i}", page(0, f"<{tag}><p>The same article.</p></{tag}>")) for i in range(40)]
        others = [(100 + i, f"http://c.example/o{i}", page(i, f"<{tag}><p>Article {i}</p></{tag}>")) for i in range(20)]
        got = texts(spark, copies + others)
        assert got[7]["text"] == "The same article." and got[107]["text"] == "Article 7"


def test_body_outside_a_short_article(spark):
    body = "<article><p>Teaser {i}</p></article><div class='body'><p>Story {i} tells much more than its teaser does.</p></div>"
    got = texts(spark, [(i, f"http://b.example/{i}", page(i, body.format(i=i))) for i in range(6)])
    assert [got[i]["text"] for i in range(6)] == [f"Teaser {i}\n\nStory {i} tells much more than its teaser does." for i in range(6)]


def test_a_name_is_no_proof_against_the_page():
    def text(x):
        return H.main_text(x, set(), set(), set())

    long = "A long story that holds most of the text of its page."
    assert text(f'<main class="content has-sidebar"><p>{long}</p></main>') == long
    assert text(f'<article class="post comments"><p>{long}</p><div class="share-links">Share</div></article>') == long
    assert text(f'<div id="page-header-footer-wrap"><p>{long}</p><div class="site-footer">Imprint</div></div>') == long
    assert text(f'<div class="widget"><article><p>{long}</p></article></div>') == long
    for tag in ("form", "noscript", "object", 'div class="widget"'):
        assert text(f"<{tag}><nav>Home</nav><p>{long}</p></{tag.split()[0]}>") == long
    # beside the main text the same elements stay out, however long
    for tag in ("form", "noscript", "object", 'div class="post-comments"', 'div role="navigation"'):
        assert text(f"<article><p>{long}</p></article><{tag}>{long * 5}</{tag.split()[0]}>") == long
        assert text(f"<article><p>{long}</p><{tag}>{long * 5}</{tag.split()[0]}></article>") == long


def test_raw_elements():
    def text(x):
        return H.main_text(x, set(), set(), set())

    assert text("<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> hold") == "Let x=1 hold"
    for tag in ("svg", "object", "select", "button", "iframe"):
        assert text(f"<p>before <{tag} class='x'><p>after the open tag</p>") == "before\n\nafter the open tag"
    for tag in ("object", "noscript", "form"):
        assert text(f"<article><p>much text before</p><{tag}><p>as much after it</p></article>") == "much text before\n\nas much after it"
    assert text("<p>a</p><svg><text>b</text></svg><style>c") == "a"


def test_edges(spark):
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    rows = [(1, None, None), (2, "nonsense", ""), (None, "http://e.example", "<p>no id"), (4, "http://e.example/4", "a < b & c &lt; d"),
            (5, "http://e.example/5", "<p>cut <!-- never closed <p>x"), (6, "http://e.example/6", "<p>a</p><script>open <p>b"), (7, "http://E.example/7", deep),
            (8, "http://e.example/8", '<p title="unclosed>x</p><p>y'), (9, "http://e.example/9", "<p>" + "word " * 50_000), (9, "http://e.example/9", "<p>" + "word " * 50_000),
            (10, "http://e.example/10", "</div></p>stray<table><tr><td>1<td>2<tr><td>3</table>&nbsp;&#x41;&eacute;\x00")]
    got = texts(spark, rows)
    assert got[1]["text"] == "" and got[1]["n_chars"] == 0 and got[2]["text"] == "" and got[None]["text"] == "no id"
    assert got[4]["text"] == "a < b & c < d" and got[5]["text"] == "cut" and got[6]["text"] == "a" and got[7]["text"] == "deep"
    assert got[9]["n_chars"] == 5 * 50_000 - 1 and got[10]["text"].startswith("stray\n\n1\n\n2\n\n3\n\nAé")
    assert H.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_broken_tags_take_linear_time():
    assert H.main_text("<" * 200_000, set(), set(), set()) == "<" * 200_000
    assert list(H.walk("<a b='" * 20_000)) is not None


def test_classes_have_equal_vectors(spark):
    rows = [(i, "http://c.example", "<div><b>x</b></div>" * (i + 1) + "<i>once</i>") for i in range(4)]
    df = spark.createDataFrame(rows, SCHEMA).select(H.host_of(F.col("url")).alias("host"), "html")
    found = [sorted(m["token"] for m in r["members"]) for r in H.classes(H.tokens(df)).collect()]
    assert sorted([H._h(">div"), H._h(">div>b"), H._text_token(">div>b", "x")]) in found
    assert sorted([H._h(">i"), H._text_token(">i", "once")]) in found


def two_page_types():
    """48 story pages and 12 of a second type with markup and constants of its own, none of them named; the side box stands
    before or after the body, and three paragraphs are shared by ten stories."""
    shared = "".join(f"<p>Shared passage {k} of some agency.</p>" for k in range(3))
    pages = []
    for i in range(60):
        side = "<div class='x1'><p>Find us in town.</p></div>"
        if i % 5:
            body = f"<div class='story'><h1>Head {i}</h1><p>Story {i} tells more.</p>{shared if i % 6 == 1 else ''}<p>The end of story {i}.</p></div>"
        else:
            body = (f"<div class='ware'><div class='lead'>Our catalogue in brief</div><h1>Ware {i}</h1><p>Ware {i} is well made.</p><p>It lasts {i} years.</p>"
                    "<div class='tail'><b>Order</b> by phone or letter</div></div>")
        pages.append(f"<html><body><div class='top'>Our house</div>{side + body if i % 2 else body + side}<div class='low'>Since 1900</div></body></html>")
    return pages


def test_a_rarer_page_type_is_template(spark):
    got = texts(spark, [(i, f"http://two.example/{i}", x) for i, x in enumerate(two_page_types())])
    for i in range(60):
        shared = "".join(f"Shared passage {k} of some agency.\n\n" for k in range(3)) if i % 6 == 1 else ""
        want = f"Head {i}\n\nStory {i} tells more.\n\n{shared}The end of story {i}." if i % 5 else f"Ware {i}\n\nWare {i} is well made.\n\nIt lasts {i} years."
        assert got[i]["text"] == want


def brute_classes(pages):
    """Valid classes by whole occurrence vectors, token sequences and slots."""
    seqs = [[(e.path, t) for e, t, _ in H.walk(x)] for x in pages]
    vector = {t: tuple(s.count(t) for s in seqs) for s in seqs for t in s}
    by_vector = {}
    for t, v in vector.items():
        by_vector.setdefault(v, set()).add(t)

    def on(v):
        return sum(n > 0 for n in v)

    def template(members, v):
        large = len(members) >= H.LARGE and any(t is None for _, t in members) and on(v) >= max(H.PAGES, H.TYPE_SUPPORT * len(pages))
        return on(v) >= H.SUPPORT * len(pages) or large

    possible = {v: m for v, m in by_vector.items() if template(m, v)}

    def places(members):
        out = {}
        for s in seqs:
            seen = dict.fromkeys(members, 0)
            for t in s:
                if t in members:
                    out.setdefault(t, set()).add(tuple(sorted((repr(u), seen[u] - seen[t]) for u in members)))
                    seen[t] += 1
        return out

    root = possible[max((v for v in possible if max(v) == 1), key=lambda v: (on(v), len(possible[v])))]
    steady = {t for t, at in places(root).items() if len(at) == 1}
    valid = []
    for v, members in possible.items():
        at, slots = places(members), {}
        for s in seqs:
            seen, start = dict.fromkeys(members, 0), 0
            for i, t in enumerate(s):
                if t in members and root & set(s):
                    start = i if seen[t] == max(seen.values()) else start
                    seen[t] += 1
                    slots.setdefault(t, set()).add(frozenset(steady & set(s[start:i])))
        parts = {}
        for t in members:
            fit = len(at[t]) == 1 and len(slots.get(t, [0])) == 1
            parts.setdefault((fit, frozenset(slots.get(t, [])) if fit else t), set()).add(t)
        valid += [frozenset(m) for m in parts.values() if template(m, v)]
    return sorted(valid, key=repr)


def test_classes_equal_brute_force(spark):
    for pages in (two_page_types(), ["<ul>" + "<li><i>a</i><b>x</b>" * (i % 4 + 1) + "</ul><b>y</b>" + "<i>q</i><u>r</u>" * (i % 3) for i in range(12)],
                  ["<p>a</p><div>b</div>" if i % 2 else "<div>b</div><p>a</p>" for i in range(8)]):
        df = spark.createDataFrame([(i, "http://b.example", x) for i, x in enumerate(pages)], SCHEMA).select(H.host_of(F.col("url")).alias("host"), "html")
        df = df.repartition(5)
        found = H.valid_classes(df, H.classes(H.tokens(df))).collect()
        named = {H._h(e.path) if t is None else H._text_token(e.path, t): (e.path, t) for x in pages for e, t, _ in H.walk(x)}
        got = sorted((frozenset(named[m["token"]] for m in r["members"]) for r in found), key=repr)
        assert sorted(map(sorted_repr, got)) == sorted(map(sorted_repr, brute_classes(pages)))


def sorted_repr(members):
    return sorted(map(repr, members))


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    source = {r["page_id"]: r["html"] for r in pages.collect()}
    rows = H.extract(pages).collect()
    assert len(rows) == len(source)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", source[r["page_id"]], re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n\n".join(x for x in blocks if x)
