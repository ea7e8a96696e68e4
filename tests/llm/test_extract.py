import html
import math
import random
import re
import time

import pytest

from tesserae.llm import extract as module
from tesserae.llm.extract import extract, main_text, smoothed

PAGE = """<html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href=x>Menu</a></ul></nav><!-- no --><div class="ad">Buy</div>
<article><h1>Head &amp; tail</h1><p>One  <b>bold</b>
text.<p>Two<br>lines <a href=y>link</a>.<div class="share-bar">Share</div><aside>Side</aside><form><p>Name</form>
<ul><li>first<li>second</ul><p>Short.</article><section id="comments"><p>A long comment of a reader that says a lot of things about nothing.</section>
<footer>&copy; me</footer></body></html>"""


def test_article():
    assert main_text(PAGE) == "Head & tail\nOne bold text.\nTwo lines link.\nfirst\nsecond\nShort."


def test_without_article():
    body = "".join(f"<p>{'Real words of a long paragraph. ' * 8}</p>" for _ in range(6))
    links = "".join(f"<div><a href={i}>x{i}</a> <a href=y>y</a></div>" for i in range(12))
    got = main_text(f"<body>{links}<div>{body}</div>{links}</body>")
    assert got.count("Real words") == 48 and "x3" not in got


def test_text_beside_article_cards():
    body = "".join(f"<div>{'Real words of a long paragraph. ' * 8}</div>" for _ in range(6))
    cards = "".join(f"<article><a href={i}>Card {i}</a></article>" for i in range(4))
    links = "".join(f"<div><a href={i}>x{i}</a> <a href=y>y</a></div>" for i in range(12))
    got = main_text(f"<body>{links}{body}{links}{cards}</body>")
    assert got.count("Real words") == 48 and "x6" not in got and "Card 3" not in got


def test_links_beside_an_article():
    text = f"<article>{'<p>' + 'Real words of a long paragraph. ' * 8}</article>"
    assert main_text(f"<div><a href=x>x</a></div>{text}<div><a href=y>y</a></div>") == ("Real words of a long paragraph. " * 8).strip()


def test_unclosed_and_broken():
    assert main_text("<article><p><b>One<br><p>Two</article><footer>no") == "One\nTwo"
    assert main_text("<article>a &lt; b &#233; &nope; <") == "a < b é &nope; <"
    assert main_text("<article></b></p>x</i></article>") == "x"


def test_long_page():
    text = main_text("<article>" + "<p>" + "word " * 200_000 + "</p>" + "<p>ab</p>" * 20_000 + "</article>")
    assert len(text) == 200_000 * 5 - 1 + 20_000 * 3


def test_rows(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (None, None, None), (2**60 + 1, "v", ""), (3, "w", "plain text only")]
    df = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = sorted((r["page_id"] or 0, r["url"], r["text"], r["n_chars"]) for r in extract(df).collect())
    want = main_text(PAGE)
    assert got == [(0, None, "", 0), (1, "u", want, len(want)), (1, "u", want, len(want)), (3, "w", "plain text only", 15), (2**60 + 1, "v", "", 0)]
    assert extract(df.where("false")).count() == 0


@pytest.mark.parametrize("n", [1, 2, 9])
def test_smoothing_keeps_constants(n):
    import numpy as np

    assert np.allclose(smoothed(np.full(n, 3.0)), 3.0)


def article_of(page):
    """The blocks of a given page's article, by splitting its text."""
    article = page.split("<article>")[1].split("</article>")[0]
    lines = [" ".join(html.unescape(re.sub("<[^>]+>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1|ul|li)>", article)]
    return "\n".join(x for x in lines if x)


@pytest.mark.parametrize("wrapper", ["article", "div", "main", "section", 'div class="post-body"'])
def test_given_pages_under_any_wrapper(spark, sf_dir, wrapper):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").toPandas()
    for page in pages["html"]:
        own = page.replace("<article>", f"<{wrapper}>").replace("</article>", f"</{wrapper.split()[0]}>")
        assert main_text(own) == article_of(page)


def test_given_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    want = {r["page_id"]: article_of(r["html"]) for r in pages.collect()}
    assert {r["page_id"]: r["text"] for r in extract(pages).collect()} == want


@pytest.mark.parametrize("feed", [1, 7, 1000])
def test_a_page_in_pieces(feed):
    for page in (PAGE, "<p>a &amp; b &#233; &nope; <b>x</b", "<script>" + "x<y " * 50 + "</script><p>t"):
        one, other = ([(x.text, x.tags, x.linked, x.dropped, x.title, x.section) for x in module.parsed(page, n)[0]] for n in (feed, 1 << 20))
        assert one == other


def test_one_block_is_one_line():
    assert main_text("<article><p>foo <script>x</script> bar</p></article>") == "foo bar"
    assert main_text("<article><p>foo <span class='ad'>Buy</span> bar <button>go</button> on</p></article>") == "foo bar on"
    assert main_text("<article><p>See <a class='share'>this</a> now</p></article>") == "See this now"
    assert main_text("<article><p>foo <span class='note-free'>x</span> bar</p></article>") == "foo x bar"


def test_names_do_not_overrule_the_text():
    text = "<p>" + "Real words of a long paragraph. " * 8 + "</p>"
    for name in ("comment-free notice", "with-sidebar", "notice", "no-comments article-body"):
        got = main_text(f"<nav><a href=x>Menu</a></nav><article><h1>Title</h1><section class='{name}'>{text * 4}</section></article>")
        assert got.startswith("Title\n") and got.count("Real words") == 32, name
    got = main_text(f"<article>{text * 4}<div class='notice'>Please note this.</div></article><div class='comment-list'>{text * 30}</div><div id='site-footer'>{text}</div>")
    assert got.count("Real words") == 32 and "note" not in got


def test_title_over_the_text():
    text = "<p>" + "Real words of a long paragraph. " * 8 + "</p>"
    assert main_text(f"<main><h1>Title</h1><article>{text}</article></main>").startswith("Title\nReal")
    assert main_text(f"<body><header><h1>Site</h1></header><h1>Title</h1><div class='wrap'>{text}</div>").startswith("Title\nReal")
    assert main_text(f"<body><h1>Site</h1><article><h1>Own</h1>{text}</article>").startswith("Own\nReal")


def brute_force(page):
    """The same choice by plain loops, for well-formed pages of div, article, p, ul, li and a without attributes but class."""
    stack, lines, sections, n = [("", 0, False)], [], [None], [0]
    text, tags, linked = "", 0, 0

    def flush(tags_after):
        nonlocal text, tags, linked
        clean = " ".join(text.split())
        if clean:
            lines.append((clean, tags, linked, stack[-1][1], stack[-1][2]))
            tags = 0
        text, linked, tags = "", 0, tags + tags_after

    for token in re.findall(r"<[^>]+>|[^<]+", page):
        name = re.match(r"</?([a-z0-9]+)", token)
        if not name:
            text += token
            linked += len("".join(token.split())) if any(x[0] == "a" for x in stack) else 0
        elif token[1] == "/":
            tags += 1
            if name[1] != "a":
                flush(0)
            stack.pop()
        else:
            if name[1] != "a":
                flush(0)
            tags += 1
            section, dropped = stack[-1][1], stack[-1][2] or name[1] == "nav"
            if name[1] in ("div", "article") and not dropped:
                sections.append((section, name[1] == "article" or bool(sections[section] and sections[section][1])))
                section = len(sections) - 1
            stack.append((name[1], section, dropped))
            if name[1] != "a":
                flush(1)
    ratio = [0 if d else min(80, (len(t) - t.count(" ") - k) / max(1, g)) * (2 if sections[s] and sections[s][1] else 1) for t, g, k, s, d in lines]
    smooth = []
    for i, line in enumerate(lines):
        own = [j for j, other in enumerate(lines) if other[3] == line[3] and not other[4]]
        near = [(ratio[j], math.exp(-((own.index(j) - own.index(i)) ** 2) / 2)) for j in own if abs(own.index(j) - own.index(i)) <= 3] if i in own else [(0, 1)]
        smooth.append(sum(r * w for r, w in near) / sum(w for _, w in near))
    mean = sum(smooth) / len(smooth)
    cut = math.sqrt(sum((x - mean) ** 2 for x in smooth) / len(smooth))
    chosen = set()
    for x, line in zip(smooth, lines):
        if x > 0 and x >= cut - 1e-9:
            s = line[3]
            chosen.add(s)
            while s and sections[s] and sections[sections[s][0]] and sections[sections[s][0]][1]:
                s = sections[s][0]
                if sections[s][1]:
                    chosen.add(s)

    def taken(s):
        return s in chosen or (s > 0 and sections[s][0] > 0 and taken(sections[s][0]))

    return "\n".join(t for t, _, _, s, d in lines if not d and taken(s))


def test_ratio_path_by_plain_loops():
    rng = random.Random(4)
    for _ in range(200):
        def block(depth):
            kind = rng.random()
            if kind < 0.25 and depth < 4:
                name = "article" if rng.random() < 0.2 and depth == 1 else "div"
                return f"<{name}>" + "".join(block(depth + 1) for _ in range(rng.randint(1, 5))) + f"</{name}>"
            if kind < 0.35:
                return "<ul>" + "".join(f"<li><a>link {rng.randint(0, 99)}</a></li>" for _ in range(rng.randint(1, 6))) + "</ul>"
            if kind < 0.4:
                return "<nav><a>menu</a></nav>"
            return f"<p>{'word ' * rng.choice([1, 3, 8, 30, 90])}{rng.randint(0, 9)}</p>"

        page = "<div>" + "".join(block(1) for _ in range(rng.randint(1, 9))) + "</div>"
        assert main_text(page) == brute_force(page), page


LONG = "Real words of a long paragraph that go on. " * 11


@pytest.mark.parametrize("opened", ["<section class='comment-on-law'>", "<section id='related-work'>", "<div class='search-results'>", "<div class='ad-hoc-networks'>", "<section class='discussion'>", "<div id='discussion'>"])
def test_names_in_an_article_are_weighed(opened):
    closed = opened[1:].split()[0]
    got = main_text(f"<nav><a href=x>Menu</a></nav><article><h1>Title</h1><p>{LONG}</p><p>{LONG}</p>{opened}<h2>Part</h2><p>Own {LONG}</p></{closed}></article>")
    assert got.count("Real") == 33 and "Own Real" in got and "\nPart\n" in got


@pytest.mark.parametrize("heading", ["<h2 id='menu'>The menu</h2>", "<h2 id='Advertising'>Advertising</h2>", "<h3 class='comments'>Comments on the law</h3>"])
def test_headings_are_not_judged_by_name(heading):
    got = main_text(f"<article><h1>Title</h1><p>{LONG}</p>{heading}<p>{LONG}</p></article>")
    assert re.sub("<[^>]+>", "", heading) in got.split("\n")


@pytest.mark.parametrize("talk", ["<div class=discussion><div><b>Ann</b><p>{}</p></div><div><b>Bob</b><p>{}</p></div></div>", "<ol class=discussion><li>Ann: {}<li>Bob: {}</ol>", "<div class='comment-list'><div class=c><p>{}</div><div class=c><p>{}</div></div>", "<div class='reply-list'><ul><li>{}<li>{}</ul></div>", "<div class='related-posts'><p><a href=x>{}</a></p></div>"])
@pytest.mark.parametrize("inside", [True, False])
def test_what_readers_say_goes(talk, inside):
    said = "What a reader has to say about all of this. " * 12
    talk = talk.format(said, said)
    got = main_text(f"<article><h1>Title</h1><p>{LONG}</p><p>{LONG}</p>{talk if inside else ''}</article>{'' if inside else talk}")
    assert "reader" not in got and got.count("Real") == 22


@pytest.mark.parametrize("part", ["<a ", "<!--", "<p>", "&", "</", "<!", "<?", "<![", "<a href='", '<a b="', "<script>", "<a/", "</a ", "<div ", "&#", "<p title", "<![CDATA[", "<x>y", "<li>", "<b a='>"])
def test_time_is_linear(part):
    began = time.time()
    main_text("<article><p>Words. " + part * (1_000_000 // len(part)))
    assert time.time() - began < 20


def test_what_is_left_open():
    for left in ("<b", "<b c", "</b", "<!-- c", "<!x", "<?p", "<![CDATA[ y", "<b a='"):
        assert main_text(f"<article><p>x {left}") == "x", left
    assert main_text("<article>x <b a='<i>y</i> z") == "x y z"
    assert main_text("<article>x <!-- c <p>a</p>b") == "x\na\nb"
    assert main_text("<article>x < y &am") == "x < y &am"
    assert main_text("<article>x <![if IE]>y<![endif]> z <![![> w") == "x y z w"
    assert main_text("<article>x<script>y < z <p>w") == "x"
