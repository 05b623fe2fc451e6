"""Page text: the tree on its table, hand-made pages, edge cases."""

import html
import re

from cohortalloc.llm import html_blocks as H

SF = "/root/testdata/sf0.001"
TREE = H.trained_tree()
PAGE = """<html><head><title>t</title><style>p{}</style></head><body class="page content"><header><h1>Site</h1></header>
<div id="cookie-notice">We use cookies on this site.</div><nav><a href=x>Home</a></nav><main><article class="post">
<h1>Title &amp; more</h1><p>One&nbsp;two <a href=q>three</a> four<b>five</b>.<script>var x = "</p>";</script></p>
<aside>side stuff here</aside><div class="advert">buy now</div><p>A < b and c</p><blockquote>Quote</blockquote>
<form><input name=a><label>Mail</label></form><table><tr><td>x</td><td>y</td></tr></table><ul><li>item one<li>item two</ul>
</article><section id="comments"><p>Great article, I like it very much and so on.</p></section></main>
<div class="sidebar"><p>Related long text with many words in it so that it looks like text to a reader</p></div>
<footer>(c) 2020</footer>"""


def test_tree_learns_its_table():
    assert all(H.decide(TREE, r[:-1]) == bool(r[-1]) for r in H.labelled_rows())


def test_hand_made_page():
    assert H.main_text(PAGE, TREE) == (
        "Title & more One two three fourfive. A < b and c Quote x y item one item two"
    )


def test_page_without_main_container():
    long, more = "word " * 40, "more " * 30
    page = f"<div><a href=a>a</a><a href=b>b</a></div><div><p>{long}</p><p>short one</p><p>{more}</p></div><p><a href=x>link</a></p>"
    assert H.main_text(page, TREE) == f"{long}short one {more}".strip()


def test_given_pages_give_their_article(spark):
    rows = H.op6_html_blocks(spark, SF).join(spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html"), "page_id")
    for r in rows.collect():
        article = re.sub(r"</?(?:b|a)\b[^>]*>", "", re.search(r"<article>(.*)</article>", r.html, re.S)[1])
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", article)).split())
        assert (r.text, r.n_chars) == (want, len(want))


def test_edge_cases(spark):
    pages = [(1, None, None), (None, "u", ""), (2, "u", "<article>" + "x " * 100_000), (2, "u", "<p"), (3, "u", "<!-- <article>a"),
             (4, "u", "</div></article>plain text <b>only"), (5, "u", "<article><p>&#x26;amp; &bogus; &eacute;</p></article>")]
    df = spark.createDataFrame([(*p, "c") for p in pages], "page_id long, url string, html string, text string")
    got = sorted((str(r.page_id), r.text) for r in H.extract(df).collect())
    assert len(got) == 7 and ("5", "&amp; &bogus; é") in got and ("2", ("x " * 100_000).strip()) in got
    assert H.extract(df.limit(0)).count() == 0


def test_attribute_values_and_topics_do_not_lose_an_article():
    from cohortalloc.llm import html_blocks as B

    tree = B.trained_tree()
    text = "A paragraph of the article with more than a few words in it, as such pages have."
    page = lambda attrs: f"<html><body><article><div {attrs}><p>{text}</p></div></article></body></html>"
    for attrs in ('title="A hidden gem"', 'style="overflow: hidden !important"', 'class="post category-legal"',
                  "class='entry tag-search more'", 'data-note="display: none"'):
        assert B.main_text(page(attrs), tree) == text, attrs
    for attrs in ("hidden", 'hidden=""', "HIDDEN class=post", 'style="color:red; display : none"', "aria-hidden=true",
                  'class="cookie content"', 'class="related-posts"', 'class="post comments"'):
        assert B.main_text(page(attrs), tree) == "", attrs


def sentence(n):
    return " ".join(["Plain", *["words"] * (n - 2), "here."])


def test_paragraphs_of_fifteen_words_need_no_container():
    text = " ".join(sentence(15) for _ in range(4))
    page = "<div><a href=a>Home</a></div><div><a href=b>About us</a></div>" + "".join(
        f"<p>{sentence(15)}</p>" for _ in range(4)) + "<div>Copyright 2024 Example</div><div><a href=c>Imprint</a></div>"
    assert H.main_text(page, TREE) == text


def test_a_copyright_line_is_no_article():
    page = f"<p>{sentence(18)}</p><p>Short.</p><p>{sentence(16)}</p><div>All rights reserved.</div><div><a href=x>Top</a></div>"
    assert H.main_text(page, TREE) == f"{sentence(18)} Short. {sentence(16)}"


def test_boilerplate_within_an_article_by_many_names():
    text = sentence(20)
    page = "<html><body><article><p>{0}</p><div class={1}><p>{2}</p></div><p>{0}</p></article></body></html>"
    for name in ("commentlist", "CommentSection", "user-reviews", "cookiebar", "adsbygoogle", "navlinks", "further-reading",
                 "commentForm", "reader-reviews", "social-links", "read-next", "'post comments'", "social"):
        assert H.main_text(page.format(text, name, sentence(25)), TREE) == f"{text} {text}", name
    for name in ("social-science", "commentary", "navarra", "'post social-history'", "adsorption", "reviewed"):
        assert H.main_text(page.format(text, name, sentence(25)), TREE) == f"{text} {sentence(25)} {text}", name


def test_a_slash_in_an_unquoted_value_closes_nothing():
    text = sentence(20)
    page = f"<article><p>{text}</p><div class=menu/><p>{sentence(25)}</p></div><p>{text}</p><br/><div class='menu' /><p>{text}</p></article>"
    assert H.main_text(page, TREE) == f"{text} {text} {text}"


def test_link_lists_within_an_article_go():
    links = "".join(f"<li><a href=x{i}>{'Another story to read now ' * 3}</a></li>" for i in range(4))
    page = f"<article><p>{sentence(30)}</p><ul>{links}</ul><p>{sentence(30)}</p></article>"
    text = H.main_text(page, TREE)
    assert text.startswith(sentence(30)) and text.endswith(sentence(30)) and text.count("Another") <= 2 * 3
