import random
import time
from html.parser import HTMLParser

from starloom.llm.html_extract import extract_main_text, main_text

PROSE = "This is a paragraph of the story, and it is long enough to be seen as prose by the rules of the page."
PAGE = f"""<!DOCTYPE html><html><head><title>No</title><style>p{{}}</style></head><body class="no-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/x">Menu</a></ul></nav>
<div class="cookie-notice">We use cookies and that is all there is to it for you and for me to know about this.</div>
<div class="post"><h2>A &amp; B&nbsp;title</h2><p>{PROSE}<p>Short<br>one.<p>{PROSE}</div>
<aside><p>{PROSE}</p></aside><form>Name of the one who is to be told of this, and the mail of this one too <input></form>
<div id="comments"><p>{PROSE}</p></div><script>var t="</p>";</script><!-- <p>no</p> --><footer>&copy; x</footer>"""


def test_page_without_article():
    assert main_text(PAGE)[0] == f"A & B title {PROSE} Short one. {PROSE}"


def test_article_keeps_everything_inside():
    page = "<nav><a>m</a></nav><div class=ad>buy of the</div><article><h1>T</h1><p>a<p>b <b>c</b>d</article><footer>f</footer>"
    assert main_text(page)[0] == "T a b cd"
    nested = f"<article><p>{PROSE}</p><div class='comment-list'><p>{PROSE}</p></div><p>End.</article>"
    assert main_text(nested)[0] == f"{PROSE} End."


def test_broken_pages():
    for page in (None, "", "<", "<p", "<!--", "<script>", "</div></div>", "<p class='x", "<a href=\"x><p>"):
        assert isinstance(main_text(page)[0], str)
    assert main_text("<article>" + "<p>word " * 20000)[0] == " ".join(["word"] * 20000)
    assert main_text("<div>" * 3000 + PROSE)[0] == PROSE


def test_skipped_elements_end_where_they_end():
    for icon in ('<svg class="i"/>', "<svg/>", "<math />", "<svg><title/><path d='x'/></svg>", "<svg><g><path>no</g></svg>"):
        assert main_text(f"<article><p>one {icon} two</p><p>three</p></article>")[0] == "one two three"
    for name in ("select-box", "template-part", "object-view", "title-bar", "style-x", "svg.icon"):
        assert main_text(f"<article><{name}>one</{name}><p>two</p></article>")[0] == "one two"
    for name in ("svg", "math", "object", "select", "template", "noscript"):
        assert main_text(f"<article><p>one <{name}>no <b>no</p><p>two</article>")[0] == "one two"
        assert main_text(f"<article><p>one <span><{name}>no</span> two</p></article>")[0] == "one two"
        assert main_text(f"<article><p>one <{name}>no<i>no</i> no</{name}> two</p></article>")[0] == "one two"
    assert main_text("<article><svg><path d=''><p>one</p><p>two</p></article>")[0] == "one two"
    assert main_text("<article>one <object>no<object>no</object>no</object> two</article>")[0] == "one two"
    assert main_text("<article>one <script>'</p>'</script > two<style>no")[0] == "one two"


def test_article_is_not_cut_by_names_of_headings_or_links():
    for slug in ("related-work", "legal-status", "social-impact", "search-algorithms", "share-price", "naval-history", "navajo"):
        for page in (f"<section id={slug}><h2>T</h2><p>a</section>", f"<h2 id={slug} class={slug}>T</h2><p>a", f"<div class={slug}>T a</div>"):
            assert main_text(f"<article>{page}</article>")[0] == "T a"
    for mark in ("related-posts", "comment-list", "post-navigation", "nav", "share-buttons", "x sidebar"):
        assert main_text(f"<article><p>a<div class='{mark}'>no</div><p>b<p>c</article>")[0] == "a b c"
    assert main_text("<article><h1><a>T</a></h1><p><a>all link</a><p>b<ul><li>x, <a>one</a>, 1<li><a>two</a></ul></article>")[0] == (
        "T all link b x, one , 1 two".replace(" ,", ",")
    )
    assert main_text("<article><p>a<ul><li><a>m</a><li><a>n</a><li><a>o</a></ul><div role=navigation>no</div></article>")[0] == "a"


ITALIAN = "Ogni mattina il vecchio pescatore usciva dal porto prima che sorgesse sole, remando piano verso isole lontane."
RUSSIAN = "Каждое утро старый рыбак выходил из гавани ещё до восхода солнца и медленно грёб к далёким островам."
CHINESE = "每天早晨老渔夫都在日出之前离开港口，慢慢地划向远方的岛屿，然后在那里撒下他的渔网，等待鱼群的到来。"
JAPANESE = "毎朝、年老いた漁師は日の出前に港を出て、遠くの島へゆっくりと漕ぎ、そこで網を下ろして魚の群れを待っていた。"


def test_page_without_article_in_any_language():
    for prose in (ITALIAN, RUSSIAN, CHINESE, JAPANESE):
        page = f"<nav><a>m</a></nav><div><p>{prose}</p><p>{prose}</p></div><ul><li><a>{prose}</a></ul><footer>{prose}</footer>"
        assert main_text(page)[0] == f"{prose} {prose}"
        both = f"<div><p>{PROSE}</p><p>{prose}</p></div>"  # in scripts that stop words do not judge
        assert prose == ITALIAN or main_text(both)[0] == f"{PROSE} {prose}"
    keywords = "cheap shoes boots sandals leather rubber brown black white large small shop price sale offer best"
    assert main_text(f"<p>{PROSE}</p><div>{keywords}</div><p>{PROSE}</p>")[0] == f"{PROSE} {PROSE}"


def test_page_of_short_blocks():
    page = "<nav>Menu</nav><h1>Title</h1><p>A short one.<p>- And you?<p>- So am I.<div class=ad>buy</div><p><a>more</a>"
    assert main_text(page)[0] == "Title A short one. - And you? - So am I."


def test_comments_and_sidebars_inside_the_article():
    cuts = [
        f"<{tag} {mark}><p>{PROSE}</p></{tag}>"
        for tag in ("div", "section")
        for mark in ("id=comments", 'id="sidebar"', "id=respond", "id='footer'", "id=comment-12", "class=comment-body")
        + ('class="ad-unit"', "class=google-ads", "class=adBox", "class='x commentList'", "id=disqus_thread")
    ]
    for cut in cuts:
        for main in ("article", "main"):
            assert main_text(f"<{main}><p>one</p>{cut}<p>two</p></{main}>")[0] == "one two", cut
    comment = f"<article class='comment byuser'><p>{PROSE}</p></article>"
    assert main_text(f"<article><p>story</p></article>{comment * 3}<article id=comment-7>no</article>")[0] == "story"
    assert main_text(f"<main><article>a</article><article class=commentItem>{PROSE}</article></main>")[0] == "a"
    assert main_text("<article class='post category-comments has-ads'><p id=comments-on-law>a<h2 id=comments>b</h2></article>")[0] == "a b"


def test_role_main_is_main():
    page = f"<div role='banner'>x</div><div role=\"main\"><p>Short.<p>{PROSE}</div><p>Copyright 2020 of the one and all of us here</p>"
    assert main_text(page)[0] == f"Short. {PROSE}"


def test_unmatched_tags_take_linear_time():
    n = 200_000
    for page in ("<div>" * n + "</p>" * n, "<svg>" + "<g>" * n + "</p>" * n, "<p><b>" * n, "</li>" * n):
        start = time.process_time()
        main_text(page + "word")
        assert time.process_time() - start < 10


class Labeller(HTMLParser):
    """A plain second reading of well-formed articles: what stands in no marked element."""

    def __init__(self, page):
        super().__init__()
        self.depth, self.out, self.stack = 0, [], []
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        bad = tag in ("nav", "aside", "footer", "form", "script") or a.get("id") in ("comments", "sidebar") or a.get("class") == "ad"
        self.stack.append((tag, bad))
        self.depth += bad
        self.out.append("" if tag == "script" else " ")

    def handle_endtag(self, tag):
        _, bad = self.stack.pop()
        self.depth -= bad
        self.out.append("" if tag == "script" else " ")

    def handle_data(self, data):
        if not self.depth and any(t == "article" for t, _ in self.stack):
            self.out.append(data)


def test_against_a_plain_reading():
    rng = random.Random(5)

    def tree(depth):
        if depth == 0 or rng.random() < 0.3:
            return " ".join(rng.choices(["ant", "b&amp;b", "cé", "&lt;d", "e"], k=rng.randrange(1, 5)))
        tag = rng.choice(["div", "p2", "section", "nav", "aside", "footer", "form", "blockquote", "table", "script"])
        mark = rng.choice(["", "", "", ' id="comments"', ' id="sidebar"', ' class="ad"', ' class="x"', ' id="intro"'])
        inner = "var x" if tag == "script" else "".join(tree(depth - 1) for _ in range(rng.randrange(4)))
        return f"<{tag}{mark}>{inner}</{tag}>"

    for _ in range(300):
        page = f"<html><body><div>out</div><article><h1>T</h1>{''.join(tree(4) for _ in range(4))}</article><p>out</p></body></html>"
        assert main_text(page)[0] == " ".join("".join(Labeller(page).out).split()), page


def test_dataframe(spark):
    rows = [(1, "u", PAGE, "t"), (1, "u", PAGE, "t"), (2, None, None, None), (None, "v", "", "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = [(r["row"]["page_id"], r["row"]["text"], r["text"], r["n_chars"]) for r in extract_main_text(pages).collect()]
    want = main_text(PAGE)[0]
    assert sorted(got, key=str) == sorted(
        [(1, "t", want, len(want)), (1, "t", want, len(want)), (2, None, "", 0), (None, "x", "", 0)], key=str
    )
    assert extract_main_text(pages.limit(0)).count() == 0
