from __future__ import annotations

import html as entities
import json
import re

import pytest
from data import prose

from propensa.llm import html_wrappers as wrappers
from propensa.llm.catalog import op3_html_text
from propensa.llm.tables import read

COLUMNS = "page_id long, url string, html string"


def page(body, head="<title>t</title><style>p{}</style><script>var t='</p>';</script>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


def sites():
    """Pages of four hosts with the text that each should give."""
    rows = []
    for i in range(12):
        paras = [prose(i * 20 + k, 20 + k).replace("\n", " ") for k in range(1 + i % 4)]
        ps = "".join(f"<p>{p}</p>" for p in paras)
        notes = f'<div class="cookie-notice">We use cookies {i}</div>' if i % 2 else ""
        rows.append(("a.example.com", page(
            f"<nav><ul><li><a href='/x'>Home</a></li><li>News</li></ul></nav>{notes}<article><h1>T{i}</h1>{ps}"
            f"<aside>More</aside></article><section class='comments'><p>Nice {i}</p></section><footer>&copy; a</footer>"), ["T%d" % i, *paras]))
        lis = "".join(f"<li>{p}" for p in paras)
        rows.append(("b.example.org", page(
            f"<div id=top class='site-header'>Menu {i}</div><div class='content'><h2>H {i}</h2><ul>{lis}</ul><form>Mail <input></form></div>"
            f"<div class='sidebar'><p>{prose(9000 + i, 15)}</p></div>"), [f"H {i}", *paras]))
        rows.append(("c.example.net", page(
            f"<div class=x1><div>{''.join(f'<p>{p}<br>line &amp; &lt;{k}&gt;' for k, p in enumerate(paras))}</div></div>"
            f"<div class=x2><a href=/1>One {i}</a> <a href=/2>Two</a></div><div>Read our terms</div>"),
            [f"{p} line & <{k}>" for k, p in enumerate(paras)]))
        rows.append(("d.example.com", page(f"<main><p><b>Bold {i}<br><p>{paras[0]}<table><tr><td>x<td>y {i}</table></main>", head="<title>d"), None))
    return [(n, f"https://{host}/p/{n}?q=1", source, want) for n, (host, source, want) in enumerate(rows)]


def extracted(spark, rows):
    from pyspark.sql import functions as F

    pages = spark.createDataFrame([r[:3] for r in rows], COLUMNS).withColumn("text", F.lit("odd")).withColumn("host", F.lit(1))
    return {r.page_id: r.text for r in wrappers.extract(pages).collect()}


def test_hosts_of_different_make(spark):
    rows = [r for r in sites() if r[3] is not None]
    got = extracted(spark, rows)
    for n, _, _, want in rows:
        assert got[n] == "\n\n".join(re.sub(r"\s+", " ", w).strip() for w in want), n


def test_templates_of_one_host(spark):
    rows = []
    for i in range(40):
        text = prose(400 + i, 30).replace("\n", " ")
        inner = (f"<article><p>{text}</p></article>", f"<main><p>{text}</p></main>", f"<div class=content><p>{text}</p></div>",
                 f"<section><p>{text} {text}</p></section>", f"<div class=z><table><tr><td>{text}</table></div>")[max(i % 8 - 3, 0)]
        want = f"{text} {text}" if i % 8 == 6 else text
        rows.append((i, f"https://mixed/{i}", page(f"<nav>Menu</nav>{inner}<footer>f {i}</footer>"), want))
    got = extracted(spark, rows)
    assert got == {n: want for n, _, _, want in rows}


def test_copies_and_near_copies_keep_their_text(spark):
    def text(seed):
        return prose(seed, 30).replace("\n", " ")

    rows = []
    for i in range(8):
        rows.append((i, f"https://copies/{i}", page(f"<article><p>{text(500)}</p></article>"), text(500)))
        rows.append((10 + i, f"https://bare/{i}", page(f"<div><p>{text(501)}</p></div>"), text(501)))
        rows.append((20 + i, f"https://near/{i}", page(f"<article><p>{text(502)}</p></article><p>{i} views</p>"), text(502)))
        quoted = page(f"<div><p>{text(503)}</p><blockquote>{text(504)}</blockquote></div>")
        rows.append((30 + i, f"https://quote/{i}", quoted, f"{text(503)}\n\n{text(504)}"))
        rows.append((40 + i, f"https://quote/o{i}", page(f"<div><p>{text(510 + i)}</p></div>"), text(510 + i)))
    assert extracted(spark, [r[:4] for r in rows]) == {n: want for n, _, _, want in rows}


def test_given_pages_hold_their_article(spark, sf_dir):
    got = {r.page_id: r for r in op3_html_text(spark, sf_dir).collect()}
    pages = read(spark, sf_dir, "pages").collect()
    assert len(got) == len(pages)
    for p in pages:  # these pages name their article
        inner = re.search(r"<article>(.*)</article>", p.html, re.S)[1]
        blocks = [entities.unescape(re.sub(r"<[^>]*>", "", re.sub(r"<br>", " ", b))) for b in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n\n".join(b for b in (re.sub(r"\s+", " ", b).strip() for b in blocks) if b)
        assert got[p.page_id].text == want and got[p.page_id].n_chars == len(want)


def test_odd_pages(spark):
    long = page("<article>" + "".join(f"<p>{prose(i, 40)}</p>" for i in range(2000)) + "</article>")
    deep = "<div>" * 5000 + "deep" + "</div>" * 5000
    rows = [(0, None, None), (1, "", ""), (2, "not a url", "plain text"), (3, "https://h/", "<"), (4, "https://h/", "<p>a < b > c &notanentity; &#x41;"),
            (5, "https://long/", long), (6, "https://deep/", deep), (7, "https://h/", "<script>x"), (8, "https://h/", "<!-- open"),
            (None, "https://h/", "<p>a < b > c &notanentity; &#x41;"), (4, "https://h/", "<p>a < b > c &notanentity; &#x41;"), (9, "https://E/", "</p></div><p class=\"a>b\">q</p>")]
    pages = spark.createDataFrame(rows, COLUMNS)
    got = wrappers.extract(pages).collect()
    texts = {r.page_id: r.text for r in got}
    assert len(got) == len(rows)
    assert texts[0] == texts[1] == texts[7] == texts[8] == ""
    assert texts[2] == "plain text" and texts[4] == "a < b > c ¬anentity; A" and texts[6] == "deep" and texts[9] == "q"
    assert texts[5].count("\n\n") == 1999
    assert wrappers.extract(pages.limit(0)).count() == 0


def holds(expression, node):
    """Whether an expression holds a page's node, by matching its children greedily."""
    key, _, children = expression
    if key != node[0]:
        return False
    at = 0
    for child in children:
        n = 0
        while at < len(node[1]) and (n == 0 or "+" in child[1] or "*" in child[1]) and node[1][at][0] == child[0] and holds(child, node[1][at]):
            at, n = at + 1, n + 1
        if n == 0 and child[1] not in ("?", "*"):
            return False
    return at == len(node[1])


@pytest.mark.parametrize("host", ["a.example.com", "b.example.org", "c.example.net", "d.example.com"])
def test_a_wrapper_holds_its_pages(host):
    trees = [wrappers.Page(source).tree for _, url, source, _ in sites() if host in url]
    expressions = [json.dumps(wrappers.expression(t)) for t in trees]
    whole = json.loads(wrappers.fold(expressions))
    assert all(holds(whole, t) for t in trees)
    # In two steps, as in Spark, the pages are held as well.
    parts = [wrappers.fold(expressions[i::3]) for i in range(3)]
    assert all(holds(json.loads(wrappers.fold(parts)), t) for t in trees)


def test_mismatches_become_optional_or_repeated():
    one = ["r", "", [["a", "", []], ["b", "", []]]]
    two = ["r", "", [["a", "", []], ["c", "", []], ["b", "+", []]]]
    assert wrappers.align(one, two) == ["r", "", [["a", "", []], ["c", "?", []], ["b", "+", []]]]


@pytest.mark.parametrize("outer", [
    "<body class='no-sidebar'><article>{}</article>", "<body><div class='content with-sidebar'><article>{}</article></div>",
    "<body><article class='post has-comments'>{}</article>", "<body class='single post'><div><p>Buy now {n}</p></div><section><h2>x</h2></section><div>{}</div>",
    "<body><div class='page sidebar-left'><nav>Menu</nav><article>{}</article></div><p>Up</p>"])
def test_names_of_layout_empty_no_page(spark, outer):
    rows = []
    for i in range(12):
        text = [prose(600 + 20 * i + k, 40).replace("\n", " ") for k in range(2 + i % 3)]
        body = outer.replace("{n}", str(i)).replace("{}", "".join(f"<p>{t}</p>" for t in text))
        rows.append((i, f"https://names/{i}", f"<html>{body}<div class=comments><article>Nice {i}</article></div></html>", "\n\n".join(text)))
    assert extracted(spark, rows) == {n: want for n, _, _, want in rows}


def test_siblings_of_one_key_are_told_apart_by_position(spark):
    rows = []
    for i in range(3):  # as few pages as may be: what is a notice does not depend on a count
        text = prose(700 + i, 60).replace("\n", " ")
        menu = f"<div>Offer {i}</div>" if i else ""
        rows.append((i, f"https://place/{i}", page(f"{menu}<section>Chosen for you {i}</section><div>{text}</div><div class=z>All rights reserved</div>"), text))
    assert extracted(spark, rows) == {n: want for n, _, _, want in rows}


def test_every_page_has_a_place_in_its_wrapper():
    for host in ("a.example.com", "b.example.org", "c.example.net", "d.example.com"):
        pages = [wrappers.Page(source) for _, url, source, _ in sites() if host in url]
        whole = wrappers.Wrapper(json.loads(wrappers.fold([json.dumps(wrappers.expression(p.tree)) for p in pages])))
        for p in pages:
            p.match(whole)
            for leaf, _, _ in p.blocks:
                assert whole.keys[leaf[2]] == "#"
