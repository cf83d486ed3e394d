"""Articles inside elements that are named like boilerplate, and what stands beside the long paragraphs."""

import pytest

from newsmart.llm import tagpath

LONG = [f"Paragraph {n} is long, has commas, and goes on for a while. It tells, in detail, what happened on day {n}." for n in "abc"]
ARTICLE = "<h1>The headline</h1>" + "".join(f"<p>{x}</p>" for x in LONG)
TEXT = "\n".join(["The headline", *LONG])
BESIDE = (
    "<nav><a href=/>Home</a></nav><div class='comment-list'><p>I disagree, strongly. You are wrong, says a reader.</p></div>"
    "<div class='ad'>Buy now, cheap!</div><form><p>Subscribe, please.</p></form>"
)
WRAPPERS = [
    "<div class='wrapper overflow-hidden'>", "<div class='layout with-sidebar'>", "<div class=has-banner>", "<div class='nav-fixed'>",
    "<div id=no-comments>", "<div class='page sidebar'>", "<form action=/ method=post>", "<div class=modal>", "<fieldset>",
]


@pytest.mark.parametrize("wrapper", WRAPPERS)
@pytest.mark.parametrize("inner", ["div", "article"])
def test_page_wide_wrappers_keep_the_article(wrapper, inner):
    beside = BESIDE.replace("<form>", "<div class=newsletter>").replace("</form>", "</div>")
    end = wrapper[1:].split()[0].rstrip(">")
    page = f"<html><body>{wrapper}<{inner}>{ARTICLE}</{inner}>{beside}</{end}></body></html>"
    assert tagpath.main_text(page) == TEXT


@pytest.mark.parametrize("inner", ["div", "article", "main"])
def test_named_elements_beside_the_article_still_go(inner):
    comments = "<div id=comments>" + "".join(f"<p>Reader {n} says, at length, that this is wrong.</p>" for n in range(20)) + "</div>"
    assert tagpath.main_text(f"<body>{BESIDE}<{inner}>{ARTICLE}<p class='ad banner'>Buy, now.</p></{inner}>{comments}</body>") == TEXT


def test_the_container_is_completed_before_and_after_the_long_paragraphs():
    tail = "<h2>In short</h2><ul><li>one point</li><li>two</li></ul>"
    lead = "<p>By A. Writer</p>"
    inner = f"{lead}{ARTICLE}{tail}"
    expected = "\n".join(["By A. Writer", TEXT, "In short", "one point", "two"])
    tagline = "<div class=tagline><p>The site's tagline</p></div>"
    for page in (f"<body>{tagline}<div>{inner}</div>{tagline}</body>", f"<body>{tagline}{inner}{tagline}</body>", inner):
        assert tagpath.main_text(page) == expected
    links = "<ul><li><a href=1>Another story</a></li><li><a href=2>One more</a></li></ul>"
    assert tagpath.main_text(f"<body><div>{inner}{links}</div></body>") == expected
    parts = f"<div><section><p>Short.</p>{ARTICLE}</section><section>{''.join(f'<p>{x}</p>' for x in LONG)}<p>End.</p></section></div>"
    assert tagpath.main_text(f"<body>{tagline}{parts}</body>") == "\n".join(["Short.", TEXT, *LONG, "End."])
