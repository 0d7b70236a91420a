import random
from html import unescape
from html.parser import HTMLParser

import pytest

from fieldbook.llm import maintext

A = "The river rose in the night and by morning the lower fields were under water, as they had been in most years."
B = "Nobody in the village was surprised. Some had moved their sheep to the hill two days before."
C = "Please read what we do with your data and how long we keep it before you go on to use this site and its services."

#: Pages unlike the labelled ones in names and nesting, with the blocks of their articles.
UNSEEN = [
    (
        f'<html><head><title>x</title></head><body><div class="site-nav"><a href=1>Home</a> | <a href=2>News</a></div><div class="container"><div class="row"><div class="col-md-8"><div class="post-body">'
        f'<h1>Flood</h1><p>{A}</p><div class="ad-slot">Buy now! {C}</div><p>{B}</p></div></div><div class="col-md-4 sidebar-right"><h4>Popular</h4><p>{C}</p></div></div></div>'
        f'<div id="disqus_thread" class="comments"><p>{B}</p><p>{A}</p></div><div class="site-footer">{C}</div></body></html>',
        ["Flood", A, B],
    ),
    (
        f"<body><div id=cookie-consent>{C}</div><main><h1>Flood</h1><p>{A}<br>{B}</p><table><tr><td>a</td><td>b</td></tr></table><form>{C}</form><p>&lt;b&gt; &amp; &#233;&nbsp;x</p></main><footer>{C}</footer>",
        ["Flood", A + " " + B, "a b", "<b> & é x"],
    ),
    (f"<BODY><NAV><A HREF=x>One</A></NAV><ARTICLE><H1>Flood</H1><P>{A}<P>{B}</ARTICLE><ASIDE><P>{C}</ASIDE>", ["Flood", A, B]),
    (
        f'<body><header class="top"><a href="/">My Site</a><p>Tagline of the site</p></header><article class="hentry"><h1>Flood</h1><p>{A}</p><aside>{C}</aside><p>{B}</p><ul><li>one</li><li>two</li></ul>'
        f'<nav><a href=p>Prev</a></nav></article><section class="reader-comments"><h2>3 comments</h2><div class="comment"><p>{A}</p></div><div><p>{B}</p></div></section></body>',
        ["Flood", A, B, "one", "two"],
    ),
    (
        f'<body><div class="menu"><ul><li><a href=1>A</a></li></ul></div><div id="story"><h1>Flood</h1><p>{A}</p><p>{B}</p><p>{A}</p></div><div class="subscribe-box"><p>{C}</p></div>'
        f'<div class="user-comments"><p>{A}</p><p>{A}</p><p>{A}</p></div></body>',
        ["Flood", A, B, A],
    ),
    (
        f'<body><script>var a="<p>{C}</p>";</script><style>p{{}}</style><!-- <p>{C}</p> --><noscript>{C}</noscript><article><p>{A}</p><script>x()</script><p>{B}</p></article></body>',
        [A, B],
    ),
    (f'<body><div class="header-menu">M</div><div class="text-block"><p>{A}</p></div><div class="text-block"><p>{B}</p></div><div class="footer-links"><a href=1>Imprint</a></div></body>', [A, B]),
    ("<body><nav><ul>" + "<li><a href=1>Some very long navigation entry with many words in it</a></li>" * 60 + f"</ul></nav><article><h1>F</h1><p>{B}</p></article><footer>{(C + ' ') * 20}</footer></body>", ["F", B]),
    (f'<body><article><h1>F</h1><p>{B}</p><div class="comments"><p>{(C + " ") * 20}</p></div></article></body>', ["F", B]),
    (f'<body><div class="nav">x</div><p>{A}</p><div class="sidebar">{C}</div><p>{B}</p><div class="footer">y</div></body>', [A, B]),
    (f'<body><article><p>{A}</p><p hidden>{C}</p><div style="display:none">{C}</div><p>{B}</p></article></body>', [A, B]),
]


@pytest.fixture(scope="module")
def weights():
    return maintext.learn()


@pytest.mark.parametrize("k", range(len(UNSEEN)))
def test_pages_unlike_the_labelled_ones(weights, k):
    html, blocks = UNSEEN[k]
    assert maintext.main_text(html, weights).split("\n\n") == blocks


class Plain(HTMLParser):
    """Blocks within the article element, read by the standard library's parser."""

    def __init__(self):
        super().__init__()
        self.within, self.blocks = False, [""]

    def handle_starttag(self, tag, attrs):
        if tag == "article":
            self.within = True
        if tag in ("p", "h1", "article"):
            self.blocks.append("")
        if tag == "br":
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        if tag == "article":
            self.within = False
        if tag in ("p", "h1", "article"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.within:
            self.blocks[-1] += data


def plain_text(html):
    parser = Plain()
    parser.feed(html)
    parser.close()
    return "\n\n".join(x for x in (" ".join(b.split()) for b in parser.blocks) if x)


def test_all_given_pages_equal_a_plain_reading_of_their_articles(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    got = maintext.main_texts(pages).collect()
    assert len(got) == len(html) and all(r.n_chars == len(r.text) for r in got)
    assert {r.page_id: r.text for r in got} == {k: plain_text(h) for k, h in html.items()}


def test_region_equals_all_stretches():
    rng = random.Random(5)
    for _ in range(500):
        x = [rng.choice([-3, -2, -1, -0.5, 0, 0.5, 1, 2]) for _ in range(rng.randrange(12))]
        sums = [(sum(x[i:j]), j - i, -i) for i in range(len(x)) for j in range(i + 1, len(x) + 1)]
        best = max(sums, default=(0, 0, 0))
        assert maintext.region(x) == ((-best[2], -best[2] + best[1]) if best[0] > 0 else (0, 0)), x


def test_labelled_pages_are_learned(weights):
    right = total = 0
    for page in maintext.PAGES:
        marked = maintext._labelled(page, weights)
        begin, end = maintext.region([maintext.score(kind, odds, words, weights.factor) for kind, _, odds, words, _, _ in marked])
        for i, (_, _, odds, words, _, inside) in enumerate(marked):
            total += words
            right += words * (inside == (begin <= i < end and maintext.probability(odds) >= maintext.LEAST))
    assert right / total > 0.99
    assert weights.of["<footer>"] < -1 < 1 < weights.of["<article>"]


def test_other_labelled_pages_give_other_weights():
    pages = tuple(f"<body><{a}><p>{C}</p></{a}><{b}>[[<p>{A}</p><p>{B}</p>]]</{b}></body>" for a, b in [("left", "right")] * 4)
    assert maintext.main_text(f"<left>{A}</left><right>{B}</right>", maintext.learn(pages)) == B


def test_odd_pages(spark):
    long = f"<article><p>{A}</p>" + "<p>word</p>" * 30_000 + "</article>"
    rows = [
        (1, "u", None), (2, "u", ""), (3, None, "<p"), (4, "u", A), (5, "u", "   \n "), (6, "u", f"<article><p>{A}"), (None, "u", f"<p>{B}</p>"), (7, "u", long),
        (8, "u", "<nav>only</nav>"), (9, "u", f"<article><p>{A} 1 < 2 and <3 &am &amp &copy; &#x1F600;</p></article>"), (9, "u", f"<article><p title='a>b' x=\"c>d\">{B}</p></article>"),
        (10, "u", f'<article><p a="never ends>{A}</p></article>'), (11, "u", f"<article><p>{A}</p><!-- {C}"), (12, "u", f"<article><p>{A}</p><script>{C}"), (13, "u", "<" * 5000 + "a" + '"' * 5000),
    ]
    clashing = [(*r, "x", "y", "z") for r in rows]
    pages = spark.createDataFrame(clashing, "page_id long, url string, html string, text string, n_chars string, score string")
    got = {}
    for r in maintext.main_texts(pages).collect():
        got.setdefault(r.page_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows) and got[3][0].url is None
    assert all(got[k][0].text == "" and got[k][0].n_chars == 0 for k in (1, 2, 3, 5))
    assert got[4][0].text == got[6][0].text == got[11][0].text == got[12][0].text == A
    assert got[None][0].text == B and got[7][0].text.count("word") == 30_000
    assert {r.text for r in got[9]} == {f"{A} 1 < 2 and <3 &am & © 😀", B}
    assert maintext.main_texts(spark.createDataFrame([], pages.schema)).count() == 0


def test_references_are_decoded_before_white_space_is_joined(weights):
    text = "a&nbsp;&#10; b&Tab;&thinsp;c " * 3
    assert maintext.main_text(f"<article><p>{text}</p></article>", weights) == " ".join(unescape(text).split())
