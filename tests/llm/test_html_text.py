import numpy as np
import pytest
from pyspark.sql import functions as F

from admere.llm import html_text
from admere.llm.ship import ship

CASES = {
    "<article><h1>T</h1><p>One <b>bo</b>ld &amp; two&nbsp; x.<br>y<p>second</article><footer>no</footer>": "T One bold & two x. y second",
    "<nav><ul><li><a href=x>Home</a></ul></nav><article><p>a</p><aside>no</aside><form><p>no</p></form><section class='comments'><p>no</p></section><div id='ad-1'>no</div></article>": "a",
    "<html><head><title>no</title><style>p{}</style><script>var t='</p>';</script></head><body><header>no</header><main><p>yes, it is.</p><script>no</script></main></body></html>": "yes, it is.",
    "<body><div class='menu'><a href=/>Home</a> <a href=/>More</a></div><div class=content><h2>T</h2><p>Long text, with stops. More of it, and more.</p><p>second, para.</p></div><div class='cookie-notice'><p>We use cookies, and so on, and more, and more.</p></div></body>": "T Long text, with stops. More of it, and more. second, para.",
    "<div class='has-sidebar'><article>yes</article></div>": "yes",
    "<article>cut <p>off <!-- open": "cut off",
    "<article><table><tr><td>a<td>b<tr><td>c</table><ul><li>d<li>e</ul></article>": "a b c d e",
    "<article>1 < 2 and 3 > 2 &lt;p&gt; &#x41;&#66; &bogus;</article>": "1 < 2 and 3 > 2 <p> AB &bogus;",
    "<article title=\"a>b\"><textarea><p>no</textarea>yes</ARTICLE>": "yes",
    "plain text": "plain text",
    "": "",
    "<p></p>": "",
    "<a " * 5000: "",
}


@pytest.mark.parametrize("page", CASES)
def test_pages(page):
    assert html_text.main_text(page) == CASES[page]


def test_every_page_and_all_columns(spark):
    long = "<article>" + "<p>some text, here.</p>" * 20_000 + "</article>"
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<article>é日</article>"), (3, "u", long), (3, "u", long)]
    pages = ship(spark).createDataFrame(rows, "page_id long, url string, html string")
    found = {(r.page_id, r.url): (r.text, r.n_chars) for r in html_text.extract_pages(pages).collect()}
    assert found[1, "u"] == ("", 0) and found[2, None] == ("", 0) and found[None, "u"] == ("é日", 2)
    assert found[3, "u"][0] == " ".join(["some text, here."] * 20_000)
    wide = html_text.extract(pages.select(F.lit(1).alias("added"), "html", F.lit(2).alias("c0")))
    assert wide.columns == ["added", "html", "c0", "text"] and wide.count() == 5
    assert html_text.extract_pages(pages.limit(0)).collect() == []


STORY = "".join(f"<p>Paragraph {i} of the story, long enough to count. It goes on, and on; then it ends here.</p>" for i in range(10))
TOLD = " ".join(f"Paragraph {i} of the story, long enough to count. It goes on, and on; then it ends here." for i in range(10))
TEASERS = "".join(f"<article class=teaser><h3><a href=/{i}>Other story {i}</a></h3><p>Read it, soon.</p></article>" for i in range(5))


@pytest.mark.parametrize("element", ["main", "div"])
@pytest.mark.parametrize("teasers", [TEASERS, TEASERS.replace(" class=teaser", ""), TEASERS.replace(" class=teaser", " class=card")])
def test_articles_beside_the_story(element, teasers):
    story = f"<{element}><h1>Title</h1>{STORY}</{element}>"
    assert html_text.main_text(f"<body>{story}{teasers}</body>") == "Title " + TOLD
    assert html_text.main_text(f"<body><div class=more>{teasers}</div>{story}</body>") == "Title " + TOLD


def test_quote_article_in_the_story():
    assert html_text.main_text(f"<body><main>{STORY}<article class=quote><p>Said so.</p></article><p>End.</p></main></body>") == TOLD + " Said so. End."


@pytest.mark.parametrize("element", ["div class=content", "main", "article"])
def test_lists_quotes_and_tables_of_the_story(element):
    parts = "<ul><li>short one<li>two</ul><ol><li>three</ol><blockquote><p>Quoted.</p></blockquote><table><tr><th>a<td class=num>1</table><dl><dt>t<dd>d</dl>"
    page = f"<body><div class=menu><a href=/>Home</a></div><{element}>{STORY}{parts}<p>End.</p><ul><li><a href=/1>More here</a><li><a href=/2>And here</a></ul></{element.split()[0]}></body>"
    found = html_text.main_text(page)
    assert found.startswith(TOLD + " short one two three Quoted. a 1 t d End.") and "Home" not in found
    assert ("More here" in found) is False


def test_names_that_share_a_word_with_furniture():
    page = (
        f"<article>{STORY}<h2 id='social-impact'>Impact</h2><p>It had some.</p><section id='related-work'><p>Others did it, too.</p></section>"
        "<div class='order-form-guide'><p>How to order.</p></div><section class='related-posts'><a href=/1>Next</a> <a href=/2>Last</a></section><div class='comments-area'><p>I disagree. Really, I do.</p></div></article>"
    )
    assert html_text.main_text(page) == TOLD + " Impact It had some. Others did it, too. How to order."


def test_many_nested_paths_take_linear_time():
    assert len(html_text.main_text("<div>word, " * 20_000)) == 20_000 * 6 - 1


def paragraphs(n, start=0):
    return "".join(f"<p>Paragraph {i} of the story, long enough to count. It goes on, and on; then it ends here.</p>" for i in range(start, start + n))


def told(n, start=0):
    return " ".join(f"Paragraph {i} of the story, long enough to count. It goes on, and on; then it ends here." for i in range(start, start + n))


@pytest.mark.parametrize("more", [1, 2, 3, 4])
@pytest.mark.parametrize("element", ["article", "main", "div class=content"])
def test_short_second_part_of_the_story(element, more):
    page = f"<body><nav><a href=/>Home</a></nav><{element}><div class=part1>{paragraphs(10)}</div><div class=part2>{paragraphs(more, 10)}</div></{element.split()[0]}><div class=side><a href=/1>Other one</a> <a href=/2>Other two</a></div></body>"
    assert html_text.main_text(page) == told(10 + more)


@pytest.mark.parametrize("element", ["article", "main"])
def test_headline_lede_and_conclusion_in_elements_of_their_own(element):
    parts = f"<h1>Title</h1><div class=lede><p>What it is about, in short.</p></div><div class=text>{STORY}</div><div class=conclusion><p>So it ends, at last.</p></div>"
    assert html_text.main_text(f"<body><{element}>{parts}</{element}></body>") == f"Title What it is about, in short. {TOLD} So it ends, at last."
    sibling = f"<div class=title><h1>Title</h1></div><div class=text>{STORY}</div>"
    assert html_text.main_text(f"<body><{element}>{sibling}</{element}></body>") == "Title " + TOLD


def test_names_inside_the_story_of_an_article():
    inner = (
        "<header><h1>Title</h1></header><p class=teaser>First of all, this.</p>" + STORY + "<p class=comment>As she said, it is so.</p>"
        "<section class=content-banner><p>More of it, told here.</p></section><section id=menu><p>Soup, bread, and wine.</p></section>"
    )
    gone = "<div class=notice><p>We moved. Call us, please.</p></div><div class=ad-text><p>Buy now, it is cheap.</p></div><div class=comment><p>I disagree. Really, I do.</p></div><footer>By me.</footer>"
    found = html_text.main_text(f"<body><header>Site</header><article>{inner}{gone}</article></body>")
    assert found == f"Title First of all, this. {TOLD} As she said, it is so. More of it, told here. Soup, bread, and wine."


def brute_ratios(paths, lengths, stops):
    def mean(values, path):
        mine = [v for p, v in zip(paths, values, strict=True) if p == path]
        return sum(mine) / len(mine)

    return [(mean(lengths, p), mean(stops, p)) for p in paths]


def test_path_ratios_decide(monkeypatch):
    labels = "".join(f"<div class=row>Label {i}</div>" for i in range(100))
    page = f"<body><div class=a>{labels}</div><div class=b>{STORY}</div></body>"
    assert html_text.main_text(page) == TOLD
    read = html_text.read(page)
    paths = [read.places[b.place][1] for b in read.blocks]
    lengths, stops = [len(b.text) for b in read.blocks], [len(html_text._STOPS.findall(b.text)) for b in read.blocks]
    assert np.allclose(html_text.ratios(paths, lengths, stops), brute_ratios(paths, lengths, stops))
    assert html_text.smoothed([(0.0, 4.0), (4.0, 0.0)]) == [(1.0, 3.0), (3.0, 1.0)]
    monkeypatch.setattr(html_text, "ratios", lambda paths, lengths, stops: [(1.0, 1.0)] * len(paths))
    assert html_text.main_text(page) != TOLD


def test_poor_containers_beside_the_story_go():
    page = f"<body><main><div class=x>{STORY}</div><div class=y><span>Tag one</span></div><div class=z><div>12</div><div>34</div></div></main></body>"
    assert html_text.main_text(page) == TOLD
