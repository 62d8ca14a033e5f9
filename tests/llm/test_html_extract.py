"""Pages whose head is left open, and pages with flagged wrappers."""

import itertools
import random
import time

import pytest

from logweir.llm.html_extract import costs, main_text, minimum_cut, read_blocks, smoothness

TEXT = "These are the many words of a long paragraph that belongs to the article of the page."


@pytest.mark.parametrize("start", ["<article>", "<div>", "<img src=a.png>", "<p>", ""])
def test_an_open_head_ends_where_it_must(start):
    page = f"<html><head><meta charset=utf-8><title>T</title><script>1</script>{start}{TEXT}"
    assert main_text(page) == TEXT
    assert main_text(f"<head><noscript><p>no</p></noscript><template><p>no</p></template>{start}{TEXT}") == TEXT


@pytest.mark.parametrize(
    "page",
    [
        '<body><div class="content-sidebar-wrap"><main><p>{}</main></div>',
        '<body><div class="layout with-sidebar"><article><p>{}</article></div>',
        '<body><form id="aspnetForm"><div><p>{}</div></form>',
        '<body><div class="sidebar"><article><p>{}</article></div>',
        '<body class="x"><div class="page has-sidebar"><div><p>{}</div></div>',
        '<body><form role="form"><main><p>{}</main></form>',
        '<body><div class="social tags"><div role="main"><p>{}</div></div>',
    ],
)
def test_a_flagged_wrapper_keeps_its_main_part(page):
    assert main_text(page.format(TEXT) + f'<div class="sidebar"><p>{TEXT}</div>') == TEXT


def test_boilerplate_stays_out():
    article = f"<article><p>{TEXT}</article>"
    for other in ('<div class="comments"><article><p>{}</article></div>', "<aside><article><p>{}</article></aside>",
                  "<form><p>Your mail {}</form>", '<div class="sidebar-wrapper"><p>{}</div>'):
        assert main_text(f"<body>{article}{article}" + other.format(TEXT)) == TEXT + "\n" + TEXT


@pytest.mark.parametrize(
    "part",
    [
        '<div class="social-history"><p>{}</p></div>',
        '<div class="tags-intro text"><p>{}</p></div>',
        '<div id="comment-policy-body"><p>{}</p></div>',
        "<p>{} <math><mi>x</mi><mo>=</mo><mn>1</mn></math></p>",
    ],
)
def test_a_word_in_a_name_does_not_outweigh_an_articles_text(part):
    page = f"<body><article><h1>Head</h1><p>{TEXT}</p>{part.format(TEXT)}<p>{TEXT}</p></article>"
    more = " x=1" if "math" in part else ""
    assert main_text(page) == "\n".join(["Head", TEXT, TEXT + more, TEXT])


@pytest.mark.parametrize("name", ["comments", "comment-body", "social-share", "related-posts", "ad-box", "newsletter-signup"])
def test_names_that_say_what_an_element_is(name):
    assert main_text(f'<body><article><p>{TEXT}</p></article><div class="{name}"><p>{TEXT} other</p></div>') == TEXT


def energy(blocks, labels):
    total = sum(costs(*block)[0 if not keep else 1] for block, keep in zip(blocks, labels))
    return total + sum(c for i, j, c in smoothness(blocks) if labels[i] != labels[j])


def test_extraction_is_the_cheapest_labelling_of_random_trees():
    rnd = random.Random(4)
    for _ in range(150):
        open_, page, n = [], "<body>", 0
        while n < 10:
            kind = rnd.random()
            if kind < 0.35:
                tag = rnd.choice(["div", "section", "article", "aside", "ul", 'div class="comments"', 'div class="social-notes"', "form"])
                open_.append(tag.split()[0])
                page += f"<{tag}>"
            elif kind < 0.55 and open_:
                page += f"</{open_.pop()}>"
            else:
                words = " ".join(rnd.choice("abcdef") * 3 for _ in range(rnd.choice([2, 5, 12, 30])))
                page += rnd.choice(["<p>{}</p>", "<h2>{}</h2>", "<p><a href=x>{}</a></p>", "{}"]).format(words)
                n += 1
        blocks = read_blocks(page)
        content, boilerplate = zip(*(costs(*block) for block in blocks))
        chosen = minimum_cut(content, boilerplate, smoothness(blocks))
        least = min(energy(blocks, labels) for labels in itertools.product([False, True], repeat=len(blocks)))
        assert energy(blocks, chosen) == pytest.approx(least)
        assert main_text(page) == "\n".join(text for (text, _, _), keep in zip(blocks, chosen) if keep)


def seconds(page):
    start = time.process_time()
    main_text(page)
    return time.process_time() - start


@pytest.mark.parametrize(
    "unit, close",
    [
        (f'<p>{TEXT}</p><div class="ad"><p>Buy this now</p></div>', ""),
        (f'<p>{TEXT}</p><aside><p>{TEXT}</p></aside><ul><li><a href=x>Link</a></ul>', ""),
        ("<b><i>", ""),
        (f"<b><p>{TEXT[:20]}", ""),
        ("<form><div>" + TEXT, ""),
        ("<p>x<td>", ""),
    ],
)
def test_time_grows_with_the_page(unit, close):
    n = max(200, 120_000 // len(unit))
    seconds(unit * 50)
    small = min(seconds("<body>" + unit * n) for _ in range(3))
    large = min(seconds("<body>" + unit * 2 * n) for _ in range(3))
    assert large < 2.5 * small + 0.05
