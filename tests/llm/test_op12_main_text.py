import random
import time

import pytest

from llm_fixtures import same_rows
from wattlake.llm import labelled_pages
from wattlake.llm import main_text as M

SCORES = M.fitted({}, 0)
BODY = ("<h1>The long walk</h1><p>We set out &amp; walked for <b>nine</b> days\n along the old wall.</p>"
        "<p>It rained <a href='/r'>twice</a>.</p><p>Yes.</p><ul><li>bread</li><li>tea</li></ul><p>Then home.</p>")
TEXT = ("The long walk\nWe set out & walked for nine days along the old wall.\nIt rained twice.\nYes.\nbread\ntea\n"
        "Then home.")
NAV = "<nav><ul><li><a href='/'>Home</a></li><li><a href='/b'>Boots and bags</a></li></ul></nav>"
FOOT = "<footer><p>Copyright the walkers and their many friends</p></footer>"

SHAPES = {
    "article": f"{NAV}<article>{BODY}</article>{FOOT}",
    "main": f"<header><p>Walkers weekly</p></header>{NAV}<main>{BODY}</main>{FOOT}",
    "plain div": f"{NAV}<div id='content'>{BODY}</div>{FOOT}",
    "no names": f"<div><a href='/'>Home</a> <a href='/b'>Bags</a></div><div>{BODY}</div><div><a href='/p'>Privacy</a></div>",
    "advert inside": f"<article>{BODY.replace('<p>Yes', '<div class=ad><p>Buy nine pairs of boots now</p></div><p>Yes')}"
                     f"</article>",
    "comments": f"<article>{BODY}</article><section id='user-comments'><h2>Comments</h2><p>{'so true ' * 80}</p></section>",
    "comments inside": f"<main>{BODY}<div class='comments-area'><article><p>{'so true ' * 80}</p></article></div></main>",
    "form around all": f"<form id='aspnet'><div class='has-sidebar'>{NAV}<div class='post'>{BODY}</div></div></form>",
    "form inside": f"<article>{BODY}<form><p>Your name</p><input><button>Send it</button></form></article>",
    "notice": f"<div class='cookie-notice'><p>{'we use cookies ' * 30}</p></div><article>{BODY}</article>",
    "sidebar": f"<div class='wrapper'><div class='leftSidebar'><p>{'old news ' * 50}</p></div><div>{BODY}</div></div>",
    "article header": f"<article><header class='entry-header'>{BODY}</header></article>",
    "scripts": f"<head><title>No</title><style>p>a{{}}</style></head><script>var a='</p><p>no';</script><article>{BODY}"
               f"</article><!-- <p>no</p> -->",
    "cut off in a tag": f"{NAV}<article>{BODY}<a href='/unfin",
    "cut off in a comment": f"{NAV}<article>{BODY}<!-- and",
    "upper case": f"<NAV><A HREF=/>Home</A></NAV><ARTICLE CLASS=post>{BODY}</ARTICLE>",
    "hidden": f"<article>{BODY}<p hidden>never</p><p style='display: none'>seen</p></article>",
}


@pytest.mark.parametrize("shape", SHAPES)
def test_shapes_of_pages(shape):
    assert M.extract(f"<!DOCTYPE html><html><body>{SHAPES[shape]}</body></html>", SCORES) == TEXT


def test_labelled_pages_give_their_article():
    for page in labelled_pages.PAGES:
        parts = [p.split(f"<!--{labelled_pages.END}-->")[0] for p in page.split(f"<!--{labelled_pages.START}-->")[1:]]
        assert M.extract(page, SCORES) == "\n".join(M.extract(f"<article>{p}</article>", SCORES) for p in parts)


def test_references_white_space_and_signs():
    html = ("<article><p> a\t&lt;b&gt;&nbsp;&#x41;&eacute;&am 1 < 2 <3 </p>\n<p>x<br>y<b>z</b></p><p> </p>"
            "<p>q &amp;amp; r</p></article>")
    assert M.extract(html, SCORES) == "a <b> Aé&am 1 < 2 <3\nx yz\nq &amp; r"


@pytest.mark.parametrize("html", [None, "", " ", "<", "<p", "</", "<!", "<!--", "<script>", "&", "<nav>only menus</nav>",
                                  "<article></article>", "</p></div></b>"])
def test_pages_without_text(html):
    assert M.extract(html, SCORES) == {"<": "<", "&": "&", "</": ""}.get(html, "")


def test_run_of_largest_sum_against_all_runs():
    rnd = random.Random(7)
    tags = ["p", "div", "li", "a", "h2", "td", "span"]
    for _ in range(150):
        html = "".join(rnd.choice([f"<{t}>", f"</{t}>", f"{rnd.choice('abc')} {'w ' * rnd.randrange(4)}"])
                       for t in (rnd.choice(tags) for _ in range(30)))
        page = M.read(html)
        gone = M.cut(page, SCORES)
        run = [(text, (SCORES.tokens[False].get(kind, 0.0) if text else SCORES.tokens[False].get(kind, M.UNKNOWN_TAG))
                * (len(text.split()) if text else 1)) for kind, text, _ in M.items(page, gone, [])]
        sums = {(i, j): sum(s for _, s in run[i:j]) for i in range(len(run)) for j in range(i + 1, len(run) + 1)}
        best = max(sums.values(), default=0)
        near = {"\n".join(t for t, _ in run[i:j] if t) for (i, j), s in sums.items() if s > best - 1e-9} if best > 0 else {""}
        assert M.extract(html, SCORES) in near


@pytest.mark.parametrize("html", ["<div>" * 100_000, "<b>" * 100_000 + "</i>" * 100_000, "<" * 500_000, "<p x='" * 100_000,
                                  "<!-- " * 100_000, "<li>a" * 100_000, "<p><b>" * 100_000, "</div>" * 200_000,
                                  "<div class=comments><p>x" * 60_000, "<script>" * 100_000, "<a href=\"" * 100_001])
def test_work_stays_linear(html):
    began = time.time()
    M.extract(html, SCORES)
    assert time.time() - began < 6


SCHEMA = "page_id long, url string, html string, text string, n_chars string, kind string, score double"


def test_table_with_nulls_repeats_and_clashing_names(spark):
    page = f"{NAV}<article>{BODY}</article>{FOOT}"
    long = f"<main>{'<p>word and word</p>' * 30_000}</main>"
    rows = [(1, "http://a", page), (1, "http://a", page), (2, None, None), (None, "u", ""), (3, "u", "no tags at all"),
            (4, "u", long)]
    df = spark.createDataFrame([(*r, "x", "y", "z", 0.5) for r in rows], SCHEMA)
    got = [tuple(r) for r in M.main_texts(df).collect()]
    want = [(1, "http://a", TEXT)] * 2 + [(2, None, ""), (None, "u", ""), (3, "u", "no tags at all"),
                                           (4, "u", "\n".join(["word and word"] * 30_000))]
    same_rows(got, want)
    assert M.main_texts(spark.createDataFrame([], SCHEMA)).collect() == []


def test_names_of_own_pages_are_learned(spark):
    """Names that the labelled pages do not know, seen only outside (or only inside) marked articles."""
    marked = [f"<div class='zzbar'>{'buy this ' * 20}</div><article><div class='zzbody'>{BODY}</div></article>"] * 5
    bare = f"<div class='zzbar'><p>{'buy this ' * 200}</p></div><div class='zzbody'>{BODY}</div>"
    rows = [(i, "u", h, "", "", "", 0.0) for i, h in enumerate([*marked, bare])]
    got = {r["page_id"]: r["text"] for r in M.main_texts(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[5] == TEXT and got[0] == TEXT
    assert "buy this" in M.extract(bare, SCORES)
    sampled = {r["page_id"]: r["text"] for r in M.main_texts(spark.createDataFrame(rows, SCHEMA), bound=4).collect()}
    assert sampled[0] == TEXT
