"""Web pages labelled by hand, from which the extraction model is trained.

Each layout is a page as sites of its kind are built, with ``data-main`` on the
elements whose own text is main text. ``{5-20}`` stands for so many words,
``{.5-20}`` for sentences of them, ``((...))2-6`` for so many repetitions; the
words themselves are never features, only their number and punctuation are. A
share of the drawn pages loses all class and id attributes, so that the model
also learns to judge by structure alone.
"""

from __future__ import annotations

import random
import re

LAYOUTS = [
    # A news site
    """<body class="news"><div id="cookie-banner" class="consent"><p>{.8-30}</p><button>{1-2}</button></div><header class="masthead"><a href="/" class="logo">{1-2}</a><nav class="primary-nav"><ul>((<li><a href="/s">{1-2}</a></li>))4-9</ul></nav></header>
<main><article class="story"><h1 data-main>{4-12}</h1><div class="byline">{2-6}</div><div class="story-body"><p data-main class="lead">{.15-50}</p>((<p data-main>{.20-90}</p>))2-7<div class="ad advertisement"><span>{1-12}</span></div><h2 data-main>{2-7}</h2>((<p data-main>{.20-90}</p>))1-5<blockquote><p data-main>{.8-30}</p></blockquote><figure><img src="x"><figcaption data-main>{.5-20}</figcaption></figure></div>
<div class="share-tools"><ul>((<li><a href="/s">{1-2}</a></li>))2-4</ul></div></article><aside class="related-stories"><h3>{1-3}</h3><ul>((<li><a href="/s">{4-10}</a></li>))3-6</ul></aside></main><section id="comments" class="comments"><h3>{1-2}</h3>((<div class="comment"><span class="author">{1-2}</span><p>{.5-60}</p></div>))0-5</section><footer class="site-footer"><p>{4-15}</p><ul>((<li><a href="/f">{1-3}</a></li>))2-6</ul></footer></body>""",
    # A blog engine's default theme
    """<body><div id="page" class="hfeed site"><header id="masthead" class="site-header"><p class="site-title"><a href="/">{1-4}</a></p><p class="site-description">{3-9}</p><nav id="site-navigation" class="main-navigation"><ul id="menu" class="menu">((<li class="menu-item"><a href="/m">{1-3}</a></li>))2-8</ul></nav></header>
<div id="content" class="site-content"><div id="primary" class="content-area"><main><article id="post-1" class="post hentry"><header class="entry-header"><h1 data-main class="entry-title">{2-12}</h1><div class="entry-meta">{3-8}</div></header><div class="entry-content">((<p data-main>{.10-80}</p>))1-8<ul>((<li data-main>{.3-25}</li>))0-5</ul>((<p data-main>{.10-80}</p>))0-4</div><footer class="entry-footer"><span>{1-6}</span> <a href="/t">{1-2}</a></footer></article>
<nav class="post-navigation"><a href="/p">{2-6}</a><a href="/n">{2-6}</a></nav><div id="comments" class="comments-area"><h2>{2-6}</h2><ol class="comment-list">((<li class="comment"><article><footer>{1-3}</footer><div><p>{.4-70}</p></div></article></li>))0-4</ol><div id="respond"><form><label>{1-3}</label><input><p>{4-15}</p></form></div></div></main></div>
<div id="secondary" class="widget-area"><section class="widget"><h2>{1-3}</h2><ul>((<li><a href="/w">{2-8}</a></li>))2-6</ul></section><section class="widget widget_text"><p>{.5-40}</p></section></div></div><footer id="colophon" class="site-footer"><div>{4-10}</div></footer></div></body>""",
    # An encyclopedia
    """<body class="mediawiki"><div id="mw-head"><ul>((<li><a href="/v">{1-2}</a></li>))3-7</ul></div><div id="mw-panel"><h3>{1-2}</h3><ul>((<li><a href="/p">{1-3}</a></li>))5-12</ul></div><div id="content" class="mw-body"><div id="siteNotice" class="notice"><p>{.5-30}</p></div><h1 data-main id="firstHeading">{1-6}</h1><div id="bodyContent"><div id="mw-content-text"><p data-main>{.20-120}</p><div id="toc" class="toc"><ul>((<li><a href="#a">{1-4}</a></li>))3-9</ul></div>((<h2 data-main>{1-5}</h2><p data-main>{.20-120}</p>))1-5<ul>((<li data-main>{.4-20}</li>))2-6</ul><table><tr><th data-main>{1-3}</th><td data-main>{1-8}</td></tr><tr><th data-main>{1-3}</th><td data-main>{1-8}</td></tr></table></div><div id="catlinks"><ul>((<li><a href="/c">{1-4}</a></li>))1-5</ul></div></div></div><div id="footer"><ul><li>{5-12}</li><li>{5-25}</li></ul></div></body>""",
    # Technical documentation
    """<body><div class="topbar navbar"><a href="/">{1-2}</a><form><input></form></div><div class="container"><div class="sidebar toctree"><p>{1-2}</p><ul>((<li><a href="/d">{1-5}</a><ul>((<li><a href="/e">{1-5}</a></li>))0-4</ul></li>))4-9</ul></div><div class="document"><div class="breadcrumbs"><a href="/">{1-2}</a> <a href="/d">{1-3}</a></div><section><h1 data-main>{1-6}</h1><p data-main>{.10-60}</p><pre data-main>{4-30}</pre><div class="admonition"><p data-main>{.5-30}</p></div><h2 data-main>{1-6}</h2><p data-main>{.10-60}</p><dl>((<dt data-main>{1-3}</dt><dd data-main>{.4-30}</dd>))1-4</dl></section><div class="prev-next pagination"><a href="/a">{1-4}</a><a href="/b">{1-4}</a></div></div></div><footer><p>{3-12}</p></footer></body>""",
    # Plain old pages
    """<body><h1 data-main>{2-8}</h1>((<p data-main>{.10-80}</p>))1-9<hr><p><a href="/">{1-3}</a> | <a href="/b">{1-3}</a></p></body>""",
    """<body><p data-main>{.3-60}</p></body>""",
    """<body><div><p data-main>{.3-60}</p></div></body>""",
    """<body><div><div><div>((<p data-main>{.5-60}</p>))1-8</div></div></div></body>""",
    """<article><div><p data-main>{.3-30}</p></div></article>""",
    """<article>((<p data-main>{.5-60}</p>))1-8</article>""",
    """<div data-main>{.8-90}</div>""",
    """<body><nav><ul>((<li><a href="/a">{1-2}</a></li>))2-9</ul></nav><article><h1 data-main>{2-10}</h1><div><p data-main>{.3-40}</p></div></article><footer>{2-12}</footer></body>""",
    """<body><nav><ul>((<li><a href="/a">{1-2}</a></li>))10-40</ul></nav><div><h1 data-main>{2-10}</h1><p data-main>{.10-60}</p><p data-main>{1-4}</p><p data-main>{.10-60}</p></div></body>""",
    # Layout tables
    """<body><table><tr><td><a href="/">{1-3}</a></td></tr><tr><td><ul>((<li><a href="/a">{1-3}</a></li>))4-9</ul></td><td><h2 data-main>{2-8}</h2>((<p data-main>{.15-80}</p>))2-6</td></tr><tr><td>{3-10}</td></tr></table></body>""",
    # A shop's article page
    """<body><div class="promo-bar promo">{3-10}</div><header><nav><ul>((<li><a href="/a">{1-2}</a></li>))3-8</ul></nav></header><div class="wrapper"><ol class="breadcrumb"><li><a href="/">{1}</a></li><li><a href="/b">{1-3}</a></li></ol><section class="guide"><h1 data-main>{2-9}</h1>((<div class="row"><div class="col"><p data-main>{.15-70}</p></div></div>))2-6<div class="banner sponsored"><a href="/x">{2-9}</a></div></section><section class="recommended"><h2>{2-4}</h2>((<div class="card"><a href="/c">{2-6}</a><span>{1-2}</span></div>))2-6</section></div><div class="newsletter subscribe"><h3>{2-5}</h3><p>{.4-20}</p><form><input><label>{1-3}</label></form></div><footer><div>{3-9}</div></footer></body>""",
    # A forum thread whose first post is the text
    """<body><div id="header"><h2><a href="/">{1-3}</a></h2></div><div id="wrap"><div class="post first"><h3 data-main>{3-10}</h3><div class="content"><p data-main>{.15-90}</p><p data-main>{.15-90}</p></div><div class="signature"><a href="/u">{1-3}</a></div></div><div class="replies comments">((<div class="reply comment"><div class="author">{1-2}</div><div class="text"><p>{.5-60}</p></div></div>))1-6</div></div><div id="footer" class="legal copyright">{3-12}</div></body>""",
    # Utility classes that say nothing
    """<body class="bg-white"><div class="flex"><a href="/" class="p-4">{1-2}</a>((<a href="/b" class="p-4">{1-2}</a>))2-6</div><div class="max-w-2xl mx-auto"><h1 data-main class="text-4xl font-bold">{2-9}</h1><p class="text-sm">{2-5}</p><div class="prose">((<p data-main class="mt-4">{.10-80}</p>))2-8<ol>((<li data-main>{.4-20}</li>))0-4</ol></div></div><div class="flex p-4"><p>{2-9}</p>((<a href="/c">{1-3}</a>))1-4</div></body>""",
    # Interstitial things
    """<body><div class="modal popup overlay" style="display: none"><h2>{2-6}</h2><p>{.5-25}</p></div><div class="alert notice gdpr" role="alert">{.5-30}</div><div id="main" role="main"><article><h1 data-main>{3-10}</h1><p data-main>{.20-80}</p><div class="ad-slot ads">{1-14}</div><p data-main>{.20-80}</p><aside class="pullquote"><p>{4-15}</p></aside><p data-main>{.20-80}</p></article></div><div role="complementary" class="rail"><div class="widget"><h4>{1-3}</h4><p>{.4-30}</p></div></div><footer role="contentinfo">{3-12}</footer></body>""",
    # A page with adverts before the text and no class words inside
    """<body><nav><ul>((<li><a href="/a">{1-2}</a></li>))3-8</ul></nav><div class="ad">{.3-14}</div><article><h1 data-main>{3-14}</h1><p data-main><b>{.10-60}</b></p>((<p data-main>{.10-90}</p>))1-6</article><footer>{1-8}</footer></body>""",
    """<body><header><h1><a href="/">{1-3}</a></h1><p>{2-8}</p></header><nav>((<a href="/a">{1-2}</a> ))3-7</nav><main><h2 data-main>{2-9}</h2>((<p data-main>{.10-70}</p>))1-6<form><p>{2-10}</p><input></form></main><aside><h3>{1-3}</h3><p>{.5-40}</p><ul>((<li><a href="/l">{2-6}</a></li>))2-5</ul></aside><footer><p>{3-15}</p></footer></body>""",
    # A recipe
    """<body><div class="skip-link"><a href="#c">{2-4}</a></div><header class="banner"><nav class="menu">((<a href="/m">{1-2}</a>))3-6</nav></header><div id="recipe" class="content"><h1 data-main>{2-7}</h1><p data-main>{.10-40}</p><h3 data-main>{1-2}</h3><ul>((<li data-main>{2-7}</li>))3-9</ul><h3 data-main>{1-2}</h3><ol>((<li data-main>{.5-30}</li>))2-7</ol></div><div class="social share"><a href="/f">{1}</a><a href="/t">{1}</a></div><div class="tags"><a href="/t">{1}</a><a href="/u">{1}</a></div><div class="disqus comments"><p>{.5-40}</p></div><div class="footer">{2-10}</div></body>""",
    # A press release with a contact form
    """<body><div class="header top"><ul>((<li><a href="/n">{1-2}</a></li>))3-6</ul></div><div class="page"><div class="main-column"><h1 data-main>{4-12}</h1>((<div data-main>{.15-70}</div>))2-6</div><div class="side-column"><div class="box"><b>{1-3}</b><ul>((<li><a href="/b">{3-8}</a></li>))2-6</ul></div><div class="search"><form><input></form></div></div></div><form class="contact"><fieldset><legend>{1-3}</legend><label>{1-2}</label><p>{3-12}</p></fieldset></form><div class="bottom footer"><p>{3-12}</p></div></body>""",
    # Related links inside the text's own element
    """<body><main><article><header><h1 data-main>{3-11}</h1><p class="meta">{2-6}</p></header>((<p data-main>{.15-70}</p>))1-4<section class="related"><h4>{1-3}</h4><ul>((<li><a href="/r">{3-8}</a></li>))2-4</ul></section>((<p data-main>{.15-70}</p>))1-4<p data-main><a href="/more">{2-6}</a></p><footer><p>{2-12}</p></footer></article><section class="comments"><h2>{1-3}</h2>((<div class="comment"><p>{.4-60}</p></div>))1-5</section></main></body>""",
    # Small print in paragraphs of their own
    """<body><div class="brand"><a href="/">{1-3}</a></div><div class="text"><h1 data-main>{2-8}</h1>((<p data-main>{.10-80}</p>))1-5</div><p class="copyright legal">{3-12}</p></body>""",
    """<body><p class="tagline">{2-6}</p><h1 data-main>{2-8}</h1>((<p data-main>{.10-80}</p>))2-6<p class="legal">{3-9}</p><p class="imprint copyright"><a href="/i">{1-2}</a> {2-5}</p></body>""",
    # Hardly any text between much else
    """<body><nav><ul>((<li><a href="/a">{1-2}</a></li>))3-9</ul></nav><div class="ad">{.3-14}</div><article><h1 data-main>{1-3}</h1><p data-main>{1-3}</p></article><footer>{.5-30}</footer></body>""",
    """<body><header><p>{.4-20}</p></header><main><p data-main>{.1-6}</p></main><aside><p>{.5-40}</p></aside><footer><p>{.8-40}</p></footer></body>""",
    # Sections of one long text
    """<body><nav class="toc"><ol>((<li><a href="#s">{1-5}</a></li>))3-9</ol></nav><div class="text">((<section><h2 data-main>{1-6}</h2><div><p data-main>{.15-80}</p><p data-main>{.15-80}</p></div></section>))2-7</div><div class="pager"><a href="/p">{1-2}</a><a href="/n">{1-2}</a></div></body>""",
]

_TIMES = re.compile(r"\(\(((?:(?!\(\().)*?)\)\)(\d+)-(\d+)", re.S)
_WORDS = re.compile(r"\{(\.?)(\d+)(?:-(\d+))?\}")
_NAMED = re.compile(r'\s(?:class|id|role)="[^"]*"')
BARE_SHARE = 0.3


def _text(r: random.Random, sentences: bool, n: int) -> str:
    words = ["".join(r.choice("abcdefghilmnoprstu") for _ in range(r.randint(2, 9))) for _ in range(n)]
    if sentences:
        for i in range(r.randint(6, 14), n, 12):
            words[i - 1] += r.choice(".,.")
        words[-1] += "."
    return " ".join(words)


def drawn_page(seed: int) -> str:
    """A page of one of the layouts, still with its labels."""
    r = random.Random(seed)
    html = LAYOUTS[seed % len(LAYOUTS)]
    while _TIMES.search(html):
        html = _TIMES.sub(lambda m: m.group(1) * r.randint(int(m.group(2)), int(m.group(3))), html)
    if r.random() < BARE_SHARE:
        html = _NAMED.sub("", html)
    return _WORDS.sub(lambda m: _text(r, bool(m.group(1)), r.randint(int(m.group(2)), int(m.group(3) or m.group(2)))), html)
