from __future__ import annotations

import html as htmllib
import random

import pytest

from caseload.llm import html_text as ht

TREE = ht.train_tree(*ht.labelled_rows())


def text_of(page):
    found = ht.blocks(page)
    return " ".join(b.text for b, k in zip(found, ht.classify(TREE, ht.features(found))) if k)


def page(body, head="<title>t</title><style>p{}</style><script>var x='<p>no</p>';</script>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


ARTICLE = "<article><h1>A fine title</h1><p>First paragraph &amp; more   words\n here, quite a number of them in all.</p><p>Short.</p></article>"
MAIN = "A fine title First paragraph & more words here, quite a number of them in all. Short."


def test_labelled_table_is_learned():
    rows, labels = ht.labelled_rows()
    assert (ht.classify(TREE, rows) == labels).mean() >= 0.98 and len(rows) < 330


def test_article_without_the_rest():
    nav = "<nav><ul><li><a href=/>Home</a></li><li><a href=/x>News</a></li></ul></nav>"
    ad = "<div class=\"ad\">Buy now, this is only for you.</div>"
    foot = "<footer>&copy; site &middot; some words that stand below every page</footer>"
    assert text_of(page(nav + ad + ARTICLE + foot)) == MAIN
    more = ("<header><div>Site name</div></header><aside><p>Words at the side that are many enough to look like a text of their own, "
            "and more of them, and more.</p></aside><form><label>Your mail</label><input><button>Send</button></form>"
            "<div class='cookie-notice'>We use cookies.</div><!-- <p>gone</p> -->")
    comments = "<section id=comments><h2>Comments</h2><p>I think that this article is a very good one and I read it twice, really.</p></section>"
    assert text_of(page(more + nav + ARTICLE + comments + foot)) == MAIN
    inside = ARTICLE.replace("<p>Short.", "<div class=advert><p>Buy it.</p></div><ul class='share'><li><a>Share</a></ul><p>Short.")
    assert text_of(page(nav + inside + foot)) == MAIN


def test_unclosed_tags_inline_markup_and_breaks():
    body = "<article><p><b>Bold <i>and</i> not<br>next line of the first block<p>sec<em>ond</em> block <a href=x>link</a> here</article>"
    assert text_of(page(body)) == "Bold and not next line of the first block second block link here"


def test_pages_without_article_element():
    words = "this is a sentence of a longer paragraph that goes on for a while and has no links at all in it, "
    body = f"<ul><li><a>One</a></li><li><a>Two</a></li></ul><div><p>{words * 3}</p><p>{words * 2}</p></div><div><a>About</a> <a>Terms</a></div>"
    got = text_of(page(body))
    assert got == " ".join((words * 3).split()) + " " + " ".join((words * 2).split())


def test_random_articles_keep_every_word():
    rng = random.Random(3)
    for _ in range(60):
        paragraphs = [" ".join(rng.choice(["a", "be", "über", "x&y", "<5>", "“q”"]) for _ in range(rng.randint(1, 60))) for _ in range(rng.randint(1, 8))]
        body = "<nav><a>N</a></nav><article>" + "".join(f"<p>{htmllib.escape(p)}</p>\n" for p in paragraphs) + "</article><footer>f g</footer>"
        assert text_of(page(body)) == " ".join(paragraphs)


def test_broken_pages():
    for text in ("", "<", "<p", "</p>", "<script>never closed <p>x</p>", "<!-- open <p>x</p>", "<a href='x", "&am", "<p a=\"", "<!DOCTYPE html"):
        text_of(text)
    assert text_of("<article><p>cut off in the mid") == "cut off in the mid"
    assert text_of("<article><p>one &am") == "one &am"
    deep = "<div>" * 5000 + "<article><p>deep words</p></article>"
    assert text_of(deep) == "deep words"


def test_extract_text(spark):
    rows = [(1, "u1", page(ARTICLE), 1), (2, "u2", None, 2), (3, None, "", 3), (None, "u4", page(ARTICLE), 4), (1, "u1", page(ARTICLE), 1),
            (5, "u5", page("<article><p>" + "many words " * 50_000 + "</p></article>"), 9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text long")
    got = ht.extract_text(df).collect()
    assert len(got) == 6 and all(r.n_chars == len(r.text) for r in got)
    assert [r.text for r in got if r.page_id == 1] == [MAIN, MAIN] and {r.text for r in got if r.page_id in (2, 3)} == {""}
    assert next(r for r in got if r.page_id == 5).n_chars == 50_000 * 11 - 1
    assert ht.extract_text(df.where("page_id > 100")).count() == 0


def test_names_are_features_of_whole_tokens():
    for name in ("layout no-sidebar", "content-with-sidebar", "has-comments", "page-header-fixed", "search-result", "read-more", "sidebar"):
        assert text_of(page(f'<nav><a href=/>Home</a></nav><div class="{name}">{ARTICLE}</div>')) == MAIN, name
    warned = ARTICLE.replace("<p>Short.", '<p class="warning">Short.')
    assert text_of(page(warned)) == MAIN
    for name in ("sidebar", "site-footer", "cookie-notice"):
        assert text_of(page(f"{ARTICLE}<div class={name}><p>A few words that are not the article's.</p></div>")) == MAIN
    words = " ".join(["this paragraph is long and has no links"] * 12)
    assert text_of(page(f"<div class=legal><p>{words}</p></div>")) == words
    assert text_of(page(f"<aside><p>{words}</p></aside>")) == ""


LONG = " ".join(["these words were not written by the author of the article"] * 8)
BOXES = ("comments comment reader-comments comment-list comments-section comment-body commentList advert ad ad-slot adSlot ad-container advertisement adsbygoogle "
         "newsletter newsletter-box cookie-notice cookie-bar cookie-consent related related-posts promo-box share-buttons sponsored-content "
         "post__comments js-ad_banner social-links").split()


@pytest.mark.parametrize("name", BOXES)
def test_boxes_go_whatever_their_length(name):
    for words in ("Only four words here.", " ".join(LONG.split()[:35]), LONG, LONG * 5):
        for box in (f"<div class='{name}'><p>{words}</p></div>", f"<section id={name}><h3>Title</h3><div><p>{words}</p><p>More.</p></div></section>"):
            assert text_of(page(ARTICLE + box)) == MAIN
            assert text_of(page(ARTICLE.replace("<p>Short.", f"{box}<p>Short."))) == MAIN


def test_comments_that_are_articles():
    for box in (f"<article class=comment><p>{LONG}</p></article>", f"<div id=comments><article><p>{LONG}</p></article></div>",
                f"<section class=comment-list><article id=c1><header>Reader</header><p>{LONG}</p></article></section>"):
        assert text_of(page(ARTICLE + box)) == MAIN


def test_an_articles_own_parts_stay():
    for name in ("more", "related", "sponsored", "sidebar", "share", "post comments-open", "has-ads", "no-comments"):
        assert text_of(page(ARTICLE.replace("<article>", f"<article class='{name}'>"))) == MAIN, name
        assert text_of(page(f"<main class='{name}'>{ARTICLE}</main>")) == MAIN, name
    headed = ARTICLE.replace("<h1>A fine title</h1>", "<header><h1>A fine title</h1><p>By A. Writer</p></header>")
    assert text_of(page(f"<header><p>Site name</p></header>{headed}")) == MAIN.replace("title", "title By A. Writer")
    assert text_of(page(headed.replace("article>", "main>"))) == MAIN.replace("title", "title By A. Writer")


def test_references_of_an_article_stay():
    links = "".join(f"<li><a href=/{k}>Another source with number {k} here</a></li>" for k in range(7))
    got = text_of(page(ARTICLE.replace("</article>", f"<h2>References</h2><ul>{links}</ul></article>")))
    assert got == MAIN + " References " + " ".join(f"Another source with number {k} here" for k in range(7))
    assert text_of(page(ARTICLE.replace("</article>", f"<div class=related-links><ul>{links}</ul></div></article>"))) == MAIN


def test_short_blocks_near_text_without_an_article_element():
    words = "this is a sentence of a longer paragraph that goes on for a while and has no links at all in it, "
    menu = "<ul><li><a>One</a></li><li><a>Two</a></li><li><a>Three more</a></li></ul>"
    body = (f"{menu}<div><h1>The headline of it</h1><p>By A. Writer</p><p>{words * 3}</p><p>Short one.</p><ul><li>first point</li><li>second point</li></ul>"
            f"<p>{words * 2}</p><h2>Next part</h2><p>{words * 2}</p></div>{menu}<div><a>About</a> <a>Terms</a></div>")
    expected = f"The headline of it By A. Writer {words * 3} Short one. first point second point {words * 2} Next part {words * 2}"
    assert text_of(page(body)) == " ".join(expected.split())


def slow_features(found):
    """The features by their definition, one block at a time."""
    out = []
    for i, b in enumerate(found):
        def near(k):
            return (float(found[k].words), found[k].link_words / found[k].words) if 0 <= k < len(found) else (0.0, 0.0)

        def running(k):
            return found[k].words >= 15 and found[k].link_words / found[k].words < 0.35 and not found[k].apart
        before = next((d for d in range(1, 6) if i - d >= 0 and running(i - d)), 6)
        after = next((d for d in range(1, 6) if i + d < len(found) and running(i + d)), 6)
        out.append((*near(i), *near(i - 1), *near(i + 1), b.apart, b.article, b.heading, b.listed, before, after))
    return out


def test_features_are_those_of_one_block_at_a_time():
    rng = random.Random(8)
    for _ in range(60):
        found = []
        for _ in range(rng.randint(0, 25)):
            words = rng.choice([1, 3, 14, 15, 16, 80])
            found.append(ht.Block("", words, rng.randint(0, words), rng.choice([0, 0, 1, 2]), rng.randint(0, 1), rng.randint(0, 1), rng.randint(0, 1)))
        assert ht.features(found).tolist() == [list(map(float, r)) for r in slow_features(found)]


def test_formulas_and_objects_are_read():
    body = ("<article><p>The area <math><mi>a</mi><mo>=</mo><msup><mi>r</mi><mn>2</mn></msup><annotation>a=r^2</annotation></math> holds.</p>"
            "<object data=x.pdf><p>Words instead of the object.</p></object></article>")
    assert text_of(page(body)) == "The area a=r2 holds. Words instead of the object."
