"""Main-text extraction on small pages, and the minimum cut against brute force."""

import random
from itertools import product

from millrace.llm.html_extract import TEXT_PRIOR, extract, fit, labelled, main_text, min_cut, ties

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header><h1>Site name</h1></header><nav><ul><li><a href=/>Home</a><li><a href=/b>Blog</a></ul></nav>
<div class="cookie-notice"><p>We use cookies to make this page a better place for you. Accept them all, please.</p></div>
<div id=sidebar><p>Some other long story that is told in the sidebar, with sentences. It goes on and on.</p></div>
<article><header><h1>The &lt;real&gt; title</h1></header><p>First&nbsp;paragraph,
 with <b>bold</b>ness and <a href=x>a link</a>.<p>Short.<div class="ad">Buy this now, it is the very best thing there is.</div>
<ul><li>one<li>two</ul><form><p>Your mail address here, please, and send it to us now.</p><input></form><blockquote>Quoted &copy words.</blockquote>
<section class="comments"><h3>Comments</h3><p>I have read this long article and I liked it a lot. Thank you so much!</p></section></article>
<footer><p>&copy; 2024 The owner of this page. All rights reserved.</p></footer></body></html>"""


def test_article_without_its_surroundings():
    assert main_text(PAGE) == "The <real> title\nFirst paragraph, with boldness and a link.\nShort.\none\ntwo\nQuoted © words."


def test_odd_pages():
    assert main_text(None) == main_text("") == main_text("<p></p>") == main_text("<script>x") == ""
    assert main_text("Just a text without any markup, but with words in it.") == "Just a text without any markup, but with words in it."
    assert main_text("<article><p>Open <b>bold<p>Next one</article>") == "Open bold\nNext one"
    assert main_text("<article>" + "<div>deep " * 5000) == "\n".join(["deep"] * 5000)
    assert main_text("<article><p>a < b & c</p><!-- <p>no</p> --><p>x</p><!-- open") == "a < b & c\nx"


def test_names_of_parts():
    page = '<body class="has-sidebar"><div class="layout with-sidebar"><div class="page-header">Site</div><div class="post"><div class="entry-header"><h1>Title here</h1></div><p>Some words of the story, with an end.</p><div class="post-comments"><p>I think that this is a very good story, really.</p></div></div></div>'
    assert main_text(page) == "Title here\nSome words of the story, with an end."


def test_markup_that_misleads():
    assert main_text('<p title="5" screen">Hello to all of you, this is a text.</p>') == "Hello to all of you, this is a text."
    assert main_text('<body><form action=/x><input type=hidden><div><h1>A title here</h1><p>The whole page is in a form, as some servers do it.</p></div></form></body>') == "A title here\nThe whole page is in a form, as some servers do it."
    assert main_text("<article><p>The sum <math><mi>a</mi><mo>+</mo><mi>b</mi></math> is known to all of us by now.</p></article>") == "The sum a+b is known to all of us by now."
    work = "<article><p>This is what the article is about, in a few words.</p><section id='related-work'><p>Others did this before us, and they did it in a better way.</p></section></article>"
    assert main_text(work).count("\n") == 1
    assert main_text("<article><p>" + "<b>" * 60 + "Words deep inside of inline elements, but a paragraph.</p></article>") == "Words deep inside of inline elements, but a paragraph."
    assert main_text("<div id='acme-sidebar'><p>A story of something else, told beside the page.</p></div><article><p>The story itself, told at the right place.</p></article>") == "The story itself, told at the right place."


def test_parts_around_the_article():
    story = "<p>The story itself, told at the right place and at some length.</p><p>It goes on with a second paragraph, as stories do.</p>"
    side = "<div class=sidebar><p>Something else.</p></div>"
    told = "The story itself, told at the right place and at some length.\nIt goes on with a second paragraph, as stories do."
    assert main_text(f'<div class="content-sidebar-wrap"><main>{story}</main>{side}</div>') == told
    assert main_text(f'<article>{story}</article><div class="content-sidebar-wrapper"><p>A story of something else, told beside the page.</p></div>') == told
    for comments in ('<section class="responses"><p>I think that this is a very good story, really.</p></section>', '<ol class="commentlist"><li>I think that this is a very good story, really.</li></ol>'):
        assert main_text(f"<article>{story}</article>{comments}") == main_text(f"<article>{story}{comments}</article>") == told
    assert main_text(f'<header class="main-header"><p>The site of all stories.</p></header><header class="entry-header"><h1>Its title</h1></header><article>{story}</article>') == "Its title\n" + told
    assert main_text(f'<div class="main-header"><p>The site of all stories.</p></div><article>{story}</article>') == told
    assert main_text(f"<div><p>We use cookies to make this page better for you.</p></div><article>{story}</article>") == told
    assert main_text("<article><p>Long ago a page used cookies. We use cookies to bake a house.</p></article>") == "Long ago a page used cookies. We use cookies to bake a house."


def test_forms_inside_text():
    assert main_text("<article><p>Choose <select><option>a<option selected>b</select> end</p></article>") == "Choose end"
    assert main_text("<article><p>Choose <select><optgroup label=x><option>a</option></optgroup></select> end</p></article>") == "Choose end"
    assert main_text("<article><p>Choose <input list=l><datalist id=l><option>a</datalist> end</p></article>") == "Choose end"


def test_pages_without_elements():
    assert main_text("just text") == "just text" and main_text("  a\n b <!-- c --> ") == "a b" and main_text("&copy; 2020") == "© 2020"


def test_linked_siblings_say_something():
    line = "<li>Read all about it here, at last, in full</li>"
    assert main_text(f"<ul><li><a href=/>Home page of all</a>{line}<li><a href=/b>All about us and more</a></ul>") == ""
    assert main_text(f"<ul>{line}{line}{line}</ul>".replace("here", "here, and then in very many more words that are written there, so that it is a long one")) != ""


def test_the_cut_decides_where_texts_say_little():
    prose = "<p>A paragraph of the story with quite a few words in it, so that it is long enough to be sure of, and then some more of them.</p>"
    page = f"<body><div>{prose}{prose}<div>Stop</div>{prose}{prose}</div><ul><li><a href=/>Home page</a><li>Shop<li><a href=/b>All about us</a></ul></body>"
    blocks, kept = labelled(page)
    alone = [b.score > 0 for b in blocks]
    assert alone == [True, True, False, True, True, False, False, False]
    stronger = labelled(page, strength=1.2)[1]
    assert [b.text for b, k in zip(blocks, stronger, strict=True) if k][2] == "Stop" and stronger.count(True) == 5 and kept[5:] == [False] * 3


def test_whole_pages_equal_brute_force():
    r = random.Random(6)
    bits = ["<p>Some words of a story, told in a sentence.</p>", "<li><a href=/>Home</a>", "<div>Stop</div>", "<nav>Menu", "</nav>", "<article>", "</article>", "<div>", "</div>", "<h2>Title</h2>", "<p>Ok", "<footer>&copy; 2020 x</footer>", "<td>cell", "<form>", "</form>"]
    flipped = 0
    for _ in range(150):
        page = "".join(r.choice(bits) for _ in range(r.randint(1, 12)))
        strength = r.choice([0.6, 2.0])
        blocks, kept = labelled(page, TEXT_PRIOR, strength)
        edges = list(ties(blocks, strength))

        def cost(x, blocks=blocks, edges=edges):
            return sum(abs(b.score) for b, k in zip(blocks, x, strict=True) if (b.score > 0) != k) + sum(w for a, b, w in edges if x[a] != x[b])

        assert abs(cost(kept) - min(cost(x) for x in product([False, True], repeat=len(blocks)))) < 1e-6
        assert main_text(page, TEXT_PRIOR, strength) == "\n".join(b.text for b, k in zip(blocks, kept, strict=True) if k)
        flipped += sum((b.score > 0) != k for b, k in zip(blocks, kept, strict=True))
    assert flipped > 10


def test_fitted_weights(spark):
    rows = [(i, f"u{i}", f"<nav><a>Home {i}</a> <a>Go</a></nav><article><p>{'word ' * (i % 30 + 3)}end.</p></article><footer>&copy; {i} someone</footer>") for i in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    w = fit(df)
    assert w != TEXT_PRIOR and w[2] < 0 < w[1] and fit(df.repartition(5)) == w
    assert fit(df.limit(0)) == TEXT_PRIOR and fit(df.select("page_id", "url").selectExpr("*", "'<p>plain</p>' AS html")) == TEXT_PRIOR
    assert all(r.text.endswith("end.") and "\n" not in r.text for r in extract(df).collect())


def test_cut_is_minimal():
    r = random.Random(4)
    for _ in range(60):
        n = r.randint(1, 7)
        cap = [r.uniform(-3, 3) for _ in range(n)]
        edges = [(a, b, r.uniform(0, 2)) for a in range(n) for b in range(a + 1, n) if r.random() < 0.5]

        def cost(x, cap=cap, edges=edges):
            return sum(c if c > 0 and not k else -c if c < 0 and k else 0 for c, k in zip(cap, x, strict=True)) + sum(w for a, b, w in edges if x[a] != x[b])

        best = min(cost(x) for x in product([False, True], repeat=n))
        assert abs(cost(min_cut(cap, iter(edges))) - best) < 1e-6


def test_extract_table(spark):
    rows = [(1, "u", PAGE, "x", 3), (1, "u", PAGE, "x", 3), (2, None, None, "", 0), (None, "v", "", "", 0), (4, "w", "<article><p>" + "word " * 60_000, "", 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = extract(df).collect()
    assert len(got) == 5 and all(r.n_chars == len(r.text) for r in got)
    assert {r.n_chars for r in got if r.page_id == 4} == {60_000 * 5 - 1} and extract(df.limit(0)).count() == 0
