"""Main text: messages against enumeration, held-out pages, awkward pages."""

import itertools
import random

import numpy as np
import pytest

from minekit.llm.html import PageText, features, kinds, parse

TEXT = "The river ran along the old garden wall, and nobody had walked there for a long time."


WORDS = TEXT.replace(",", "").replace(".", "").split()


def paragraphs(i):
    """Paragraphs of one to six sentences of one to twenty words."""
    draw = random.Random(i)

    def sentence():
        words = [draw.choice(WORDS) for _ in range(draw.randint(1, 20))]
        return " ".join([words[0].title(), *[w + "," * (draw.random() < 0.1) for w in words[1:]]]) + "."

    return [" ".join(sentence() for _ in range(draw.randint(1, 6))) for _ in range(draw.randint(1, 8))]


def page(i, inner, tag="article"):
    body = "".join(f"<p>{p}</p>" for p in paragraphs(i))
    return (
        f'<!DOCTYPE html><html><head><title>t</title><script>var a="</p>";</script></head><body><nav><ul><li><a href="#">Home {i}</a></li></ul></nav>'
        f'<div class="ad">Buy {i}</div><{tag}><h1>Title {i}</h1>{body}{inner}</{tag}><footer>&copy; site {i}</footer></body></html>'
    )


def wanted(i):
    return "\n".join([f"Title {i}", *paragraphs(i)])


@pytest.fixture(scope="module")
def fitted(spark):
    rows = [(i, f"http://x/{i}", page(i, "")) for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return PageText().fit(pages)


def test_marginals_equal_enumeration(fitted):
    tree = parse('<div class="post"><p>one</p><div class="ad">two</div></div><nav>three</nav>')
    ratio = features(tree) @ fitted.weights[:-1] + fitted.weights[-1]
    kind, n = kinds(tree), len(tree.parent)
    mass = np.zeros((n, 2))
    for state in itertools.product((0, 1), repeat=n):
        log = fitted.root[state[0]] + sum(r for r, s in zip(ratio, state) if s)
        log += sum(fitted.step[kind[i], state[tree.parent[i]], state[i]] for i in range(1, n))
        for i, s in enumerate(state):
            mass[i, s] += np.exp(log)
    assert np.allclose(fitted.marginals([tree])[0], mass[:, 1] / mass.sum(1), atol=1e-9)


def test_pages_of_the_same_and_other_sites(fitted):
    extra = '<section id="comments"><h2>Comments</h2><div class="comment"><p>I like this very much, thanks for it.</p></div></section>'
    for i in range(1000, 1020):
        assert fitted.extract([page(i, "")]) == [wanted(i)]
        assert fitted.extract([page(i, extra, "main")]) == [wanted(i)]
        other = page(i, "", 'div class="entry-content"').replace("</div class=\"entry-content\">", "</div>")
        side = '<aside class="sidebar"><p>Something long enough to look like text, really, is here.</p></aside><form><p>Subscribe</p></form>'
        assert fitted.extract([other.replace("<footer>", side + "<footer>")]) == [wanted(i)]


def test_white_space_references_and_unclosed_markup(fitted):
    html = "<article><h1>A&amp;B  \n x</h1><p>First &lt;b&gt; <b>bold</b>\n text, that goes on for a while.<p>Second<br>line, &eacute;t&eacute; and more of it.<a hre"
    assert fitted.extract([html]) == ["A&B x\nFirst <b> bold text, that goes on for a while.\nSecond line, été and more of it."]


def test_no_text_is_lost_to_unclosed_elements_and_lone_quotes():
    def texts(page):
        return [t for t in parse(page).text if t is not None]

    for tag in "button select object canvas svg math".split():
        assert texts(f"<article><p>one</p><{tag}><p>two</p></article><p>three</p>") == ["one", "two", "three"]
    for tag in ("math", "object", "canvas"):
        assert texts(f"<article><{tag}>one</{tag}></article>") == ["one"]
    for tag in "button select svg script style noscript template".split():
        assert texts(f"<p>a</p><{tag}>one</{tag}><p>b</p>") == ["a", "b"]
    assert texts("<p title=Don't>one</p><p>two isn't</p>") == ["one", "two isn't"]
    assert texts("<p title='a>b' class=\"c>d\">one</p>") == ["one"]
    assert texts("<p " + 'a="b" ' * 200) == []


def test_awkward_rows(spark, fitted):
    long = "<article>" + f"<p>{TEXT}</p>" * 3000 + "</article>"
    rows = [(1, None, None), (2, "u", ""), (3, "u", "<!-- only"), (4, "u", long), (4, "u", long), (None, "u", "<nav>x</nav>")]
    pages = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id bigint, url string, html string, text string, n_chars int")
    got = PageText().run(pages, fitted).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 0), (1, 0), (2, 0), (3, 0), (4, 3000 * (len(TEXT) + 1) - 1), (4, 3000 * (len(TEXT) + 1) - 1)]
    assert all(len(r.text) == r.n_chars for r in got)
    none = pages.where("false")
    assert PageText().run(none, PageText().fit(none)).collect() == []
