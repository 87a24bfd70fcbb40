"""Main texts against the standard library's parser, and boilerplate against brute force."""

import random
import time
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketeer.llm import pages
from docketeer.llm.queries import QUERIES

INLINE = {"b", "i", "a", "em", "strong", "span"}


class Article(HTMLParser):
    """What stands in <article>, a blank for every block tag."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.out = 0, []

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        self.out.append("" if tag in INLINE else " ")

    def handle_endtag(self, tag):
        self.depth -= tag == "article"
        self.out.append("" if tag in INLINE else " ")

    def handle_data(self, data):
        if self.depth:
            self.out.append(data)


def article(page):
    parser = Article()
    parser.feed(page or "")
    parser.close()
    return " ".join("".join(parser.out).split())


def test_query_against_parser(spark):
    folder = "/root/testdata/sf0.01"
    want = {r.page_id: article(r.html) for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = QUERIES["op2_pages"](spark, folder).collect()
    assert {r.page_id: r.text for r in rows} == want and len(rows) == len(want)
    assert all(r.n_chars == len(r.text) for r in rows) and min(len(t) for t in want.values()) > 0


def text(page):
    words, tokens = pages.read_page(page)
    return " ".join(words) or " ".join(w[1:] for w in tokens if w[:1] == pages.OPEN)


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("", ""),
        ("plain &amp; simple&nbsp;text &copy 2 &#233;&bogus;", "plain & simple text \xa9 2 \xe9&bogus;"),
        ("<body><nav>menu</nav><p>One<b>two</b> three</p>four<footer>foot</footer></body>", "Onetwo three four"),
        ("<header>top</header><article><header><h1>Title</h1></header><p>Body</article>after", "Title Body"),
        ("<main><p>a<div class='comments'><p>say</p></div><p>b</main><p>c", "a b"),
        ("<article>x<article>y</article>z</article>", "x y z"),
        ("<article><p>a</p><aside>side<p>more</aside><form>f<input>g</form>b</article>", "a b"),
        ("<div id=cookie-notice>c</div><div class='post content'>real</div><div role=alert>no</div>", "real"),
        ("<article>1 < 2 and <script>if (a < b) '</p>'</script>3 <!-- x > y -->4<![CDATA[ <5 ]]></article>", "1 < 2 and 3 4 <5"),
        ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table><p>e<br>f<p>g", "a b c d e f g"),
        ("<nav><ul><li>never closed <p>x", ""),
        ("<div><nav>closed by parent</div><p>kept</p>", "kept"),
        ("<article><p title='a > b'>q</p><p style='display:none'>z</p></article", "q </article"),
        ("<body class='has sidebar'><p>kept</p><div class='sidebar'>no</div>", "kept"),
        ("<script>never closed <p>x</p>", ""),
        ("<p>heading</p><p class=advertisement>buy</p><style>p{}</style><title>t</title>", "heading"),
    ],
)
def test_structure(page, want):
    assert text(page) == want


def test_boilerplate_against_brute_force():
    draw = random.Random(8)
    for _ in range(60):
        streams = [[draw.choice("abc") for _ in range(draw.randrange(14))] for _ in range(draw.randrange(1, 8))]
        sites = np.array([draw.randrange(2) for _ in streams])
        want = []
        for i, s in enumerate(streams):
            gone = [False] * len(s)
            for k in range(len(s) - 2):
                held = [
                    j for j, t in enumerate(streams)
                    if sites[j] == sites[i] and any(t[x : x + 3] == s[k : k + 3] for x in range(len(t) - 2))
                ]
                if len(held) >= 2:
                    gone[k : k + 3] = [True] * 3
            want.append(gone)
        got = pages.boilerplate(streams, sites, run=3, pages=2)
        assert [g.tolist() for g in got] == want


def test_hosts(spark):
    """Without an article, what a host repeats goes, and what one page alone says stays."""
    frame = "<p>Welcome to the example site of all good things</p><p>{}</p><p>Call us at any time, all day and all night long</p>"
    rows = [(i, f"https://Site.example/{i}", frame.format(f"a{i} story{i} told of é{i} and b{i}"), 1) for i in range(6)]
    rows += [(10, "http://other.example/x", frame.format("alone"), 1), (11, None, None, 1), (12, "not a url", "", 1)]
    rows += [(None, "http://other.example/y", "<article>a  b</article>", 1), (13, "u://h", "<p>" + "long text " * 30_000, 1)]
    rows += [(0, *rows[0][1:])]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text long")
    found = pages.main_text(table)
    got = sorted((str(r.id), r.text) for r in found.collect())
    assert len(got) == len(rows)
    by_id = dict(got)
    assert all(by_id[str(i)] == f"a{i} story{i} told of é{i} and b{i}" for i in range(6))
    assert by_id["10"].startswith("Welcome") and by_id["10"].endswith("long") and by_id["None"] == "a b"
    assert by_id["11"] == by_id["12"] == "" and len(by_id["13"]) == 299_999
    assert pages.main_text(table.limit(0)).count() == 0
    assert found.where(F.col("text").isNull()).count() == 0


def test_copies_are_one_page(spark):
    """Exact and near copies of an unmarked page keep their text, beside pages with the same frame or alone."""
    frame = "<p>Welcome to the example site of all good things</p>{}<p>Call us at any time, all day and all night long</p>"
    body = " ".join(f"word{i}" for i in range(60))
    rows = [(i, f"http://alone.example/{i}", f"<p>{body}</p>") for i in range(3)]
    rows += [(i, f"http://many.example/{i}", f"<p>{body}</p>") for i in range(100, 1100)]
    rows += [(i, f"http://near.example/{i}", f"<p>{body} read on day{i}</p>") for i in range(2000, 2005)]
    rows += [(i, f"http://frame.example/{i}", frame.format(f"<p>{body} read on day{i % 3}</p>")) for i in range(3000, 3007)]
    own = {i: " ".join(f"own{i}x{k}" for k in range(20)) for i in range(4000, 4004)}
    rows += [(i, f"http://frame.example/{i}", frame.format(f"<p>{said}</p>")) for i, said in own.items()]
    got = {r.id: r.text for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    want = {i: body for i in [*range(3), *range(100, 1100)]} | own
    want |= {i: f"{body} read on day{i}" for i in range(2000, 2005)}
    want |= {i: f"{body} read on day{i % 3}" for i in range(3000, 3007)}
    assert got == want


def test_size_of_sites_decides_nothing(spark, monkeypatch):
    """A notice on three pages of a host goes, however many sites the host is worked through in."""
    notice = "<p>This notice stands on three pages of the whole large host</p>"
    rows = []
    for i in range(60):
        said = " ".join(f"own{i}x{k}" for k in range(20))
        rows.append((i, f"http://large.example/{i}", f"<p>{said}</p>" + notice * (i in (3, 30, 50))))
    rows += [(i, "http://large.example/copy", rows[7][2]) for i in range(60, 70)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    whole = {r.id: r.text for r in pages.main_text(table).collect()}
    monkeypatch.setattr(pages, "SITE_PAGES", 2)
    parts = {r.id: r.text for r in pages.main_text(table).collect()}
    assert whole == parts == {i: text(page.replace(notice, "")) for i, _, page in rows}


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<main><p>a b c d e</main><section><article>card one</article><article>card two</article></section>", "a b c d e"),
        ("<div>a b c d e</div><article class='comment depth-1'>say this and that and more</article>", "a b c d e"),
        ("<div>a b c d e</div><article class=related>x y z</article>", "a b c d e"),
        ("<div>a b c d e</div><article>x y</article>", "a b c d e x y"),
        ("<main>intro<article class='post has-sidebar comments-open'>a b c</article></main>", "a b c"),
    ],
)
def test_articles_that_are_not_the_text(page, want):
    assert text(page) == want


@pytest.mark.parametrize("piece", ["<a ", "<a", "<", "<a \"", "<a '\" ", "<a x='", "<!", "<!-- ", "<script></script ", "<p>", "<p id='x'>y ", "</a", "<a b=\"c\" "])
def test_a_page_of_what_is_left_open(piece):
    """1 MB of tags that never close takes no longer than other pages do."""
    page = "<article>first words</article>" + piece * (1_000_000 // len(piece)) + " last"
    begin = time.perf_counter()
    pages.read_page(page)
    assert time.perf_counter() - begin < 5


def test_where_tags_end():
    found = lambda p: [t[3:] for t in iter_tags(p)]
    assert found("<a b='>' c=\">\">x</A >") == [("a", " b='>' c=\">\""), ("a", " ")]
    # An open quote makes text of the tag, and of those that come to the same quote.
    assert found("<a b='c <b> <i \"x\"> y") == [("b", ""), ("i", ' "x"')]
    assert found("a < b <1> <i>") == [("i", "")]
    assert found("<!-- <a> --><![CDATA[<b>]]><!doctype x><?y><b>") == [("", ""), ("", "<b>"), ("", ""), ("", ""), ("b", "")]


def iter_tags(page):
    tags, at = pages._Tags(page), 0
    while (found := tags.find(at)) is not None:
        yield found
        at = found[1]


def test_notices_inside_articles(spark, monkeypatch):
    """In marked articles the host's runs decide too: what over half of them hold goes, what few hold stays."""
    notice, quote = "Subscribe now to our daily letter for more stories", "a quoted line that three of these articles have in common"
    body = {i: " ".join(f"own{i}x{k}" for k in range(30)) for i in range(40)}
    rows, want = [], {}
    for i, said in body.items():
        tail = f" {quote}" if i < 3 else ""
        rows.append((i, f"http://one.example/{i}", f"<nav>menu</nav><article><p>{said}</p>{f'<p>{notice}</p>' if i % 4 else ''}<p>{tail}</p></article>"))
        want[i] = said + tail
    # Half of the articles and no more; few articles; near copies, all alike but for a word; copies count once.
    rows += [(100 + i, f"http://half.example/{i}", f"<main>{said} {notice if i % 2 else ''}</main>") for i, said in body.items()]
    want |= {100 + i: said + (f" {notice}" if i % 2 else "") for i, said in body.items()}
    rows += [(200 + i, f"http://few.example/{i}", f"<article>{body[i]} {notice}</article>") for i in range(9)]
    want |= {200 + i: f"{body[i]} {notice}" for i in range(9)}
    rows += [(300 + i, f"http://near.example/{i}", f"<article>{body[0]} day{i}</article>") for i in range(12)]
    want |= {300 + i: f"{body[0]} day{i}" for i in range(12)}
    rows += [(400 + i, f"http://copies.example/{i}", f"<article>{body[i % 9]} {notice}</article>") for i in range(90)]
    want |= {400 + i: f"{body[i % 9]} {notice}" for i in range(90)}
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.id: r.text for r in pages.main_text(table).collect()} == want
    monkeypatch.setattr(pages, "SITE_PAGES", 7)
    assert {r.id: r.text for r in pages.main_text(table.repartition(3)).collect()} == want


def test_stretches_hold_all_frequent_runs(monkeypatch):
    """The runs that over half of a site's streams hold are found in the stretches, as often as in the streams."""
    monkeypatch.setattr(pages, "RUN", 3)
    draw = random.Random(3)
    for _ in range(200):
        streams = [[draw.choice("aaabbcd") for _ in range(draw.randrange(1, 14))] for _ in range(draw.randrange(1, 8))]
        sites = np.unique([draw.randrange(2) for _ in streams], return_inverse=True)[1]
        held, stream = pages._stretches(streams, sites)

        def frequent(parts, of):
            on = {}
            for words, i in zip(parts, of, strict=True):
                for k in range(len(words) - 2):
                    on.setdefault((int(sites[i]), *words[k : k + 3]), set()).add(int(i))
            return {run: at for run, at in on.items() if 2 * len(at) > int((sites == run[0]).sum())}

        assert frequent(held, stream) == frequent(streams, range(len(streams)))
