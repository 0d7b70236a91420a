"""Labelled pages: small pages of common layouts, the main text between ``[[`` and ``]]``.

The weights of ``maintext`` are learned from them. A page has one region, or none; what lies
within the region but is no article text stands between ``{{`` and ``}}``.
"""

from __future__ import annotations

#: A sentence or two for places where any words do.
WORDS = "Some words of ordinary length stand here, and a few more follow. They go on for another line or so."
P = f"<p>{WORDS}</p>"
LINKS = '<li><a href="/a">One</a></li><li><a href="/b">Two words</a></li><li><a href="/c">Three</a></li>'

PAGES = [
    # An article element between navigation and footer.
    f"<body><nav><ul>{LINKS}</ul></nav><article>[[<h1>Some title</h1>{P}{P}<h2>Part</h2><p>One.</p>]]</article><footer>Site, all rights reserved. {WORDS}</footer></body>",
    f'<body><header><a href="/">Site</a><nav><ul>{LINKS}</ul></nav></header><main><article>[[<header><h1>Some title</h1></header>{P}<p>Short.</p>{P}'
    f'{{{{<footer><p>By someone, filed under things</p></footer>}}}}]]</article></main><aside><h3>Also</h3><ul>{LINKS}</ul></aside><footer><p>{WORDS}</p></footer></body>',
    # A main element, sections within; a notice before, a form after.
    f'<body><div class="cookie-banner"><p>This site uses cookies. {WORDS}</p><button>Accept</button></div><header class="site-header"><h1>Site</h1></header>'
    f'<main>[[<h1>Title of it</h1><section><h2>Part</h2>{P}<ul><li>An item of a list</li><li>Another item</li></ul></section><section>{P}<blockquote>{P}</blockquote></section>]]</main>'
    f'<form class="newsletter-signup"><label>Your address</label><input><p>{WORDS}</p><button>Subscribe</button></form><footer class="site-footer">{WORDS}</footer></body>',
    # Containers known only by class and id.
    f'<body><div id="header"><div class="logo">Site</div><div class="menu"><ul>{LINKS}</ul></div></div><div id="wrapper"><div class="breadcrumbs"><a href="/">Home</a> <a href="/x">Things</a></div>'
    f'<div id="content" class="post">[[<h1>Some title</h1>{P}{P}{{{{<div class="ad"><p>{WORDS}</p></div>}}}}{P}]]</div><div id="sidebar"><h3>Recent</h3><ul>{LINKS}</ul><p>{WORDS}</p></div></div>'
    f'<div id="comments"><h3>Two comments</h3><div class="comment"><p>{WORDS}</p><a href="#">Reply</a></div><div class="comment">{P}</div></div><div id="footer"><p>{WORDS}</p></div></body>',
    f'<body><div class="navbar navigation"><a href="/">Site</a>{LINKS}</div><div class="container"><div class="entry-content">[[<h2>Title here</h2>{P}{P}<pre>some code here</pre><table><tr><td>A</td><td>B</td></tr></table>]]</div>'
    f'<div class="share social-links"><a href="/s">Share</a> <a href="/t">Send</a></div><div class="related-posts"><h3>Related</h3><ul>{LINKS}</ul>{P}</div></div><div class="copyright legal">{WORDS}</div></body>',
    f'<body><div role="banner">Site</div><div role="navigation"><ul>{LINKS}</ul></div><div role="main">[[<h1>Some title</h1>{P}<p>Last one.</p>]]</div><div role="complementary"><p>{WORDS}</p></div><div role="contentinfo">{WORDS}</div></body>',
    f'<body><div class="topbar"><a href="/login">Log in</a></div><div class="article-body story" itemprop="articleBody">[[{P}{P}{{{{<div class="promo sponsored"><p>{WORDS}</p></div>}}}}{P}{{{{<aside class="pullout"><p>{WORDS}</p></aside>}}}}{P}]]</div>'
    f'<section class="comments-area"><article class="comment-body"><p>{WORDS}</p></article><article class="comment-body">{P}</article><form id="respond"><p>{WORDS}</p><textarea></textarea></form></section></body>',
    # Reader comments as articles within the article's page.
    f'<body><header>Site. {WORDS}</header><article class="post">[[<h1>Some title</h1>{P}{P}]]<section id="comments" class="discussion"><h2>Replies</h2><article class="comment reply"><p>{WORDS}</p></article></section></article><div class="advertisement">{WORDS}</div></body>',
    f'<body><div class="alert notice"><p>{WORDS}</p></div><article>[[<h1>Title</h1>{P}{{{{<div class="advert banner">{WORDS}</div>}}}}{P}{{{{<form><p>{WORDS}</p><button>Send</button></form>}}}}{P}<p>End.</p>]]</article><div class="disclaimer gdpr consent modal popup">{WORDS}</div></body>',
    # Plain markup without names: link lists around paragraphs.
    f"<body><div><a href='/a'>One</a> <a href='/b'>Two</a> <a href='/c'>Three</a></div><div>[[<h1>Some title</h1>{P}{P}{P}]]</div><div><a href='/d'>Four</a> <a href='/e'>Five</a></div></body>",
    f"<body><table><tr><td><a href='/a'>One</a><br><a href='/b'>Two</a></td><td>[[<h1>Some title</h1>{P}{P}{P}]]</td></tr></table><div><a href='/c'>About</a> <a href='/d'>Legal</a></div></body>",
    f"<body>[[<h1>Title</h1>{P}{P}<h3>Part</h3>{P}<ol><li>First item of it</li><li>Second item</li></ol><dl><dt>Word</dt><dd>Its meaning</dd></dl>]]</body>",
    f"<body>[[{P}]]</body>",
    f"<body>[[{WORDS}]]</body>",
    # Nothing but navigation.
    f'<body><nav><ul>{LINKS}</ul></nav><div class="menu sidebar widget"><ul>{LINKS}</ul></div><footer>{WORDS}</footer></body>',
    # Menus, headers and footers of sections; author boxes and paging.
    f'<body><div class="masthead">Site</div><section class="content main-content"><div class="text">[[<h1>Some title</h1>{P}<figure><img><figcaption>What the picture shows</figcaption></figure>{P}]]</div>'
    f'<div class="author-bio byline"><p>{WORDS}</p></div><div class="pagination pager"><a href="/1">1</a> <a href="/2">2</a></div><div class="tags meta"><a href="/t">Thing</a></div></section>'
    f'<div class="newsletter subscribe signup"><p>{WORDS}</p></div><div class="widget toolbar search"><p>{WORDS}</p></div><footer>{WORDS}</footer></body>',
    f'<body><nav><ul>{LINKS}</ul></nav><div class="ad">{WORDS}</div><article>[[<h1>Some title</h1><p><b>Words in bold<br><p>{WORDS}</p><p>One.</p>{P}<p>A.</p>]]</article><footer>&copy; site. {WORDS}</footer>',
    f'<body><div class="page"><div class="header"><p>{WORDS}</p></div><div class="body">[[<h1>Some title</h1>{P}<p>See <a href="/x">that page</a> and <a href="/y">this</a>. {WORDS}</p>{P}]]</div><div class="footer"><p>{WORDS}</p><ul>{LINKS}</ul></div></div></body>',
    # Frames around everything, which say nothing by themselves.
    f'<body class="page single site"><div class="container wrapper"><div class="row"><div class="col inner"><ul class="nav">{LINKS}</ul></div></div><div class="row"><div class="col inner box">[[<h1>Some title</h1>{P}{P}<p>End of it.</p>]]</div>'
    f'<div class="col side sidebar"><p>{WORDS}</p></div></div><div class="row"><div class="col footer"><p>{WORDS}</p></div></div></div></body>',
    f'<body class="home blog page"><div class="site wrapper outer" id="page"><div class="container inner"><header class="header"><p>{WORDS}</p></header><div class="row grid"><section class="col column">[[<h2>Some title</h2>{P}{P}]]</section>'
    f'<section class="col column related"><h3>More</h3><ul>{LINKS}</ul><p>{WORDS}</p></section></div></div><div class="container"><div class="comments thread">{P}{P}</div></div></div></body>',
    f'<body><section class="section"><div class="container">[[<h1>Some title</h1>{P}<section><h2>Part</h2>{P}</section>{P}]]</div></section><section class="section newsletter"><div class="container"><h2>Join</h2><p>{WORDS}</p></div></section>'
    f'<section class="section comments"><div class="container"><h2>Comments</h2>{P}{P}</div></section></body>',
    f'<body><header><div class="container"><h1>Site</h1><p>{WORDS}</p></div></header><div class="container content-wrapper"><main class="main">[[{P}<h2>Part</h2>{P}<ul><li>Item one of it</li></ul>]]</main><aside class="aside"><h2>About</h2>{P}</aside></div><footer><div class="container">{P}</div></footer></body>',
    f'<body><div class="page-header"><h1>Site</h1></div><div class="post-content article single">[[<div><h1>Some title</h1></div><div><div>{P}</div><div>{P}</div></div>]]</div><div class="post-comments"><ol><li><p>{WORDS}</p></li><li><p>{WORDS}</p></li></ol></div>'
    f'<div class="notification warning cookie-notice"><h3>Notice</h3><p>{WORDS}</p></div></body>',
    f'<body><section><h1>Site</h1><ul>{LINKS}</ul></section><article>[[<section>{P}<h3>Part</h3>{P}</section>{{{{<section class="comments"><h3>Replies</h3>{P}</section>}}}}]]</article><section><h3>Others</h3><ul>{LINKS}</ul></section></body>',
]

#: Names given to what surrounds or interrupts an article, to articles, and to mere frames.
AROUND = (
    "nav navbar navigation menu header masthead topbar footer sidebar aside widget breadcrumb pagination pager toolbar banner ad ads advert "
    "advertisement adsense sponsor sponsored promo promotion cookie consent gdpr notice notification alert disclaimer popup modal overlay "
    "newsletter subscribe signup login register search share social related recommended popular trending comment comments reply respond "
    "discussion disqus feedback copyright legal byline author bio tag meta toc skip"
).split()
ARTICLE = "article content main post entry story text body blog news maincontent page-content entry-content post-body article-body".split()
FRAMES = "container wrapper row col inner outer page site box grid column block panel section center layout".split()
OPENINGS = ["h1", "h2", "h3"]
TAGS_AROUND = ["nav", "footer", "aside", "form", "header"]
LIST = "<ul><li>One</li><li>Two</li></ul>"


def _around(k: int, name: str) -> str:
    """An article with one named element before, within, and after it."""
    frame, inner, title = FRAMES[k % len(FRAMES)], ARTICLE[k % len(ARTICLE)], OPENINGS[k % 3]
    other = AROUND[(k * 7 + 3) % len(AROUND)]
    body = [P, LIST, P, "<p>Short.</p>", f"<ol><li>{WORDS}</li><li>Three.</li></ol>"]
    opening, closing = [("<article>", "</article>"), ("<main>", "</main>"), (f'<div class="{inner}">', "</div>"), ("<div>", "</div>")][k % 4]
    return (
        f'<body><div class="{frame}"><div class="{name}"><p>{WORDS}</p></div><div class="{frame}">{opening}[[<{title}>Title</{title}>{P}{{{{<div class="{other}"><p>{WORDS}</p></div>}}}}'
        f'{body[k % 5]}{body[(k + 2) % 5]}]]{closing}</div><div id="{name}">{WORDS}</div></div></body>'
    )


def _tagged(k: int, name: str, opening: str, closing: str) -> str:
    """An article with one element that needs no name before, within, and after it."""
    return f"<body><{name}><p>{WORDS}</p></{name}>{opening}[[<h1>Title</h1>{P}{{{{<{name}><p>{WORDS}</p></{name}>}}}}{LIST}{P}<p>End.</p>]]{closing}<{name}>{WORDS}</{name}></body>"


PAGES += [_around(k, name) for k, name in enumerate(AROUND)]
PAGES += [
    _tagged(k, name, *around)
    for k, name in enumerate(TAGS_AROUND)
    for around in [("<article>", "</article>"), ("<main>", "</main>"), ('<div class="content">', "</div>"), ("<div>", "</div>")]
    if name != "header"
]
PAGES += [f'<body><nav><ul>{LINKS}</ul></nav><div class="{name}"><{opening}>[[<h1>Title</h1>{P}{LIST}{P}<p>End.</p>]]</{opening}></div><footer>{WORDS}</footer></body>' for name in [*FRAMES, *ARTICLE] for opening in ("article", "div")]
PAGES += [
    f'<body><header><p>{WORDS}</p></header><{opening} class="{name}">[[<header><h1>Title</h1></header>{P}{{{{<div class="{aside}">{WORDS}</div>}}}}{P}{{{{<footer>{WORDS}</footer>}}}}]]</{opening}><aside>{P}</aside></body>'
    for name, aside in zip(ARTICLE * 5, AROUND) for opening in ("article", "main")
]
