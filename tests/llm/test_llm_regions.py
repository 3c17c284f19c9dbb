"""The clustered lines choose the region of a page, whatever its articles."""

import time

import numpy as np
import pytest

from veinworks.llm import html_content as H

LONG = "This is a paragraph with many words and without a tag, so that its ratio of text to tags is high. " * 3
MENU = "".join(f"<li><a href='/{k}'>Item {k}</a></li>" for k in range(12))
BODY = [f"{k} {LONG}".strip() for k in range(3)]


def paragraphs(rows):
    return "".join(f"<p>{x}</p>" for x in rows)


def test_a_teaser_article_does_not_replace_the_body():
    for teaser in ("<div class=related><article><p>Teaser</p></article></div>", "<article><p>Teaser</p></article>"):
        assert H.main_text(f"<ul>{MENU}</ul><div id=content>{paragraphs(BODY)}</div>{teaser}") == "\n\n".join(BODY)


def test_sibling_articles_are_joined():
    page = "<div>" + "".join(f"<article>{paragraphs([x])}</article>" for x in BODY) + "</div>"
    assert H.main_text(page) == "\n\n".join(BODY)


def test_comment_articles_stay_out():
    comments = f"<section id=comments><article>{paragraphs([LONG])}</article></section><article class=comment>{paragraphs([LONG])}</article>"
    assert H.main_text(f"<article>{paragraphs(BODY)}{comments}</article>") == "\n\n".join(BODY)


@pytest.mark.parametrize(
    "before, after",
    [
        ('<div class="page has-comments"><article>', "</article></div>"), ('<div class="single-post comments-open"><main><article>', "</article></main></div>"),
        ("<form id=f><article>", "</article></form>"), ('<article class="promo-story">', "</article>"), ('<article><div class="overflow-hidden">', "</div></article>"),
        ('<article><div class="elementor-widget-text">', "</div></article>"), ('<article><section id="social-policy">', "</section></article>"),
        ('<div class="no-sidebar">', "</div>"), ('<div id="content" class="site-content">', "</div>"),
    ],
)
def test_names_that_only_sound_like_other_parts(before, after):
    page = f"<body><nav><ul>{MENU}</ul></nav>{before}{paragraphs([*BODY, LONG.strip()])}{after}<footer>{paragraphs(['Imprint'])}</footer></body>"
    assert H.main_text(page) == "\n\n".join([*BODY, LONG.strip()])


def test_long_comments_stay_out():
    comments = "".join(f"<div class=comment>{paragraphs([f'{k} {LONG}'])}</div>" for k in range(6))
    assert H.main_text(f"<article>{paragraphs(BODY)}</article><div id=comments>{comments}</div>") == "\n\n".join(BODY)


def test_clusters_choose_the_text_of_pages_without_clean_markup(monkeypatch):
    links = "".join(f"<div><a href=/{k}>Go {k}</a> <a href=/x>x</a></div>" for k in range(8))
    page = f"<body>{links}{''.join(f'<div>{x}</div>' for x in BODY)}{links}</body>"
    assert H.main_text(page) == "\n\n".join(BODY)
    monkeypatch.setattr(H, "selected", lambda lines: np.ones(len(lines), bool))
    assert H.main_text(page) != "\n\n".join(BODY)


def plain_selected(ratios):
    """Weighted means of up to three neighbours on either side, then two means from the extremes."""
    n, smooth = len(ratios), []
    for i in range(n):
        near = [(j, np.exp(-((i - j) ** 2) / 2)) for j in range(max(0, i - 3), min(n, i + 4))]
        smooth.append(sum(ratios[j] * w for j, w in near) / sum(w for _, w in near))
    low, high = min(smooth), max(smooth)
    for _ in range(50):
        upper = [x >= (low + high) / 2 for x in smooth]
        low, high = (np.mean([x for x, u in zip(smooth, upper, strict=True) if u == side]) for side in (False, True))
    return [x >= (low + high) / 2 or low >= 0.3 * high for x in smooth]


def test_marked_lines_equal_their_definition():
    draw = np.random.default_rng(2)
    for _ in range(20):
        lines = [H.Line("x" * int(draw.integers(1, 400)), int(draw.integers(1, 9)), (), (), False) for _ in range(int(draw.integers(2, 40)))]
        assert H.selected(lines).tolist() == plain_selected([len(x.text) / x.tags for x in lines])


def test_time_grows_with_the_page():
    for piece in ("<b>x ", "<div>x ", "</i>x ", "<b><p>x"):
        start = time.perf_counter()
        H.main_text(piece * (20_000 if "div" not in piece else 3_000))
        assert time.perf_counter() - start < 10
