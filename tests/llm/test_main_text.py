"""Blocks of hand-made pages: what the page's own text is, as a reader would say."""

import pytest

from tidegauge.llm.html_main import SITE, blocks, main_text

ARTICLE = "<article><h1>Title</h1><p>real text</p></article>"
# name -> (page, lines that stay)
PAGES = {
    "body classes": (f'<html><body class="single no-sidebar"><nav>menu</nav>{ARTICLE}</body></html>', ["Title", "real text"]),
    "html classes": (f'<html class="no-cookies has-header"><body id="nav">{ARTICLE}<footer>f</footer>', ["Title", "real text"]),
    "wrapper": (f'<body><div class="post-content share-enabled">{ARTICLE}</div><div class="share">s</div>', ["Title", "real text"]),
    "article in a named wrapper": (f'<body><div class="header-wrapper">{ARTICLE}<p>slogan</p></div>', ["Title", "real text"]),
    "article classes": ('<body><article class="with-sidebar no-comments"><p>own</p></article>', ["own"]),
    "advert in the article": ('<body><main><p>a</p><div class="ad">buy</div><div class="ad-slot x">buy</div><p>b</p></main>', ["a", "b"]),
    "site parts": (
        '<body><div class="site-header">h</div><div id="main-nav">n</div><div class="cookie-notice">c</div>'
        '<main>text</main><div class="related-posts">r</div><div class="sidebar">s</div>', ["text"],
    ),
    "comments as articles": (
        f'<body>{ARTICLE}<section class="comments"><article>first!</article></section>'
        '<section id="comment-list"><main>no</main></section>', ["Title", "real text"],
    ),
    "article named away": ('<body><main><p>a</p><article class="related">r</article></main>', ["a"]),
    "roles": ('<body><div role="navigation">n</div><div role="main"><p>x</p></div><div role="contentinfo">c</div>', ["x"]),
    "words inside words": ('<body><article><p class="shareholder headers-up">kept</p><p class="address">too</p></article>', ["kept", "too"]),
    "nothing": ("", []),
    "long": ("<body><article>" + "<p>one line of it</p>" * 20_000 + "</article>", ["one line of it"] * 20_000),
}


@pytest.mark.parametrize("name", list(PAGES))
def test_blocks(name):
    page, want = PAGES[name]
    assert [line for role, line in blocks(page) if role != SITE] == want


def test_pages(spark):
    rows = [(i, f"http://h{i}.example/p", page) for i, (page, _) in enumerate(PAGES.values())] + [(99, None, None)]
    found = {r.page_id: r for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(found) == len(rows) and found[99].text == ""
    for i, (_, want) in enumerate(PAGES.values()):
        assert found[i].text == "\n".join(want) and found[i].n_chars == len(found[i].text)
