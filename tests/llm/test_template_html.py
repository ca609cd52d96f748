import html
import re

import pandas as pd

from fennec.llm import template_html as T
from fennec.llm.queries import QUERIES


def article(page):
    inner = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    inner = re.sub(r"<(/?p|/?h1|br)>", " ", inner)
    return " ".join(html.unescape(re.sub(r"<!--.*?-->|<[^>]*>", "", inner, flags=re.S)).split())


def test_query_against_the_articles(spark):
    sf = "/root/testdata/sf0.1"
    pages = pd.read_parquet(f"{sf}/pages.parquet").set_index("page_id")
    got = QUERIES["op8_main_text"](spark, sf).toPandas().set_index("page_id")
    assert sorted(got.index) == sorted(pages.index)
    for i, r in got.iterrows():
        assert r.text == article(pages.html[i]) and r.n_chars == len(r.text) and r.url == pages.url[i]


def test_other_parts_of_pages():
    page = """<!doctype html><html><head><title>T</title><script>var a = "<p>x</p>";</script></head>
    <body class="has-sidebar"><header>Site</header><div class="cookie-notice">We use</div><main><h1>T &amp; x&nbsp;&#233;</h1>
    <p>a<b>b</b>c<br>d <!-- no --> e</p><div class=sidebar>no</div><ul><li>one<li>two</ul><table><tr><td>1<td>2<tr><td>3</table>
    <section id="comments"><p>first!</section></main><form>q <input value="z"></form><noscript>n</noscript><footer>f</footer></body></html>"""
    assert T.main_text(page) == "T & x é abc d e one two 1 2 3"
    with_article = page.replace("<main>", "<main><p>around</p><article><header><h1>Own title</h1></header><p>in</article>")
    assert T.main_text(with_article) == "Own title in"
    assert T.main_text("<p>one<p>two &lt;b&gt; < 3") == "one two <b> < 3"
    assert T.main_text("""<article style="overflow:hidden" title="the hidden class=ad"><div class="article-header"><h1>H</h1></div>
        <p data-id="ad">x</p><p hidden>no</p><p class='Share-Bar'>no</p></article>""") == "H x"
    assert T.main_text("<div><!-- open <p>gone") == "" and T.main_text("plain") == "plain" and T.main_text("") == ""


def test_templates_are_removed_where_there_is_no_article(spark):
    pages = [(i, f"http://a.org/{i}", f"<html><body><div id=top>Welcome to A</div><div class=x><p>Text {i} of its own</p></div>"
                                      f"<div id=end>All about A</div></body></html>") for i in range(12)]
    pages += [(50, "http://b.org/", "<body><p>alone</p></body>"), (51, None, None), (52, "", ""), (52, "", "")]
    df = spark.createDataFrame(pages, "page_id int, url string, html string").selectExpr("*", "'z' AS token", "1 AS h")
    got = {r.page_id: (r.text, r.n_chars) for r in T.extract(df).collect()}
    assert all(got[i] == (f"Text {i} of its own", len(f"Text {i} of its own")) for i in range(12))
    assert got[50] == ("alone", 5) and got[51] == ("", 0) and got[52] == ("", 0)
    shuffled = {r.page_id: (r.text, r.n_chars) for r in T.extract(df, broadcast_tokens=0).collect()}
    assert shuffled == got
    assert T.extract(df).count() == len(pages) and T.extract(df.limit(0)).count() == 0


def test_classes_share_vectors(spark):
    pages = [(i, "http://a.org/", f"<div><p>same</p>{'<i>x</i><p class=rare>r</p>' if i < 2 else ''}<p>{i}</p></div>") for i in range(8)]
    df = spark.createDataFrame(pages, "page_id int, url string, html string")
    tokens = set(T.templates(df).first().tokens)
    counted, _ = T.walk(pages[0][2])
    div = next(k for k, n in T.walk("<div></div>")[0].items())
    assert div in tokens and len(tokens) == 2  # the division and the text all pages share
    assert not tokens & (set(counted) - set(T.walk(pages[5][2])[0]))


def test_long_and_broken_pages():
    long = "<article>" + "<p>word</p>" * 50_000 + "<div" + " a='b" * 10
    assert T.main_text(long).startswith("word word") and len(T.main_text(long)) >= 5 * 50_000 - 1
    assert T.main_text("</p></div><article><b>x</article></b>y") == "x"
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    assert T.main_text(deep) == "x"


def test_boilerplate_inside_articles_goes(spark):
    def page(i, layout):
        own = f"<p>Story {i} is told here</p><p>and {i} ends</p>"
        if layout == "shop":  # 10 of 50 pages
            return f"<body><article class=shop><div class=price>Price {i}</div><div class=x>Orders leave within a day</div>{own}</article></body>"
        return f"<body><article><p>Read all about it in our paper</p>{own}<div>Call us any time</div></article></body>"

    pages = [(i, "http://a.org/", page(i, "shop" if i < 10 else "news")) for i in range(50)]
    pages += [(50 + i, "http://b.org/", "<body><article><h1>One</h1><p>text on all pages</p></article></body>") for i in range(9)]
    df = spark.createDataFrame(pages, "page_id int, url string, html string")
    got = {r.page_id: r.text for r in T.extract(df).collect()}
    for i in range(50):
        assert got[i] == (f"Price {i} " if i < 10 else "") + f"Story {i} is told here and {i} ends"
    assert all(got[50 + i] == "One text on all pages" for i in range(9))


def test_near_copies_keep_their_articles(spark):
    pages, want, page_id = [], {}, 0
    for host, (all_pages, copies) in enumerate([(4, 4), (8, 4), (68, 8), (68, 34), (1000, 100), (1000, 1000)]):
        for i in range(all_pages):
            copy = i < copies
            story = [f"Paragraph {j} of the story {'that many tell' if copy else i} in host {host}" for j in range(11)]
            own = f"Edition {i}"
            extra = "<blockquote>As told by the agency</blockquote>" if copy else ""
            body = "".join(f"<p>{x}</p>" for x in story) + extra
            pages.append((page_id, f"http://h{host}.org/{i}", f"<body><div>Site</div><article><h1>{own}</h1>{body}</article></body>"))
            want[page_id] = " ".join([own, *story, *(["As told by the agency"] if copy else [])])
            page_id += 1
    df = spark.createDataFrame(pages, "page_id int, url string, html string")
    assert {r.page_id: r.text for r in T.extract(df).collect()} == want
