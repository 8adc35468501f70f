"""Main text of pages."""
import html as entities
import re

from tollgate.llm import extract as X
from tollgate.llm.queries import op3_html_extraction

SF = "/root/testdata/sf0.01"


def article(page):
    """What the pages of the tables mark as their article (no other markup occurs in it)."""
    inside = re.search("<article>(.*?)(?:</article>|$)", page or "", re.S)
    blocks = (entities.unescape(re.sub("<[^>]*>", "", b)) for b in re.split(r"</?(?:p|h1)>", inside[1])) if inside else []
    return "\n\n".join(b for b in (re.sub(r"\s+", " ", b).strip() for b in blocks) if b)


def test_tables(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = op3_html_extraction(spark, SF).collect()
    assert len(rows) == len(pages) and all(r.n_chars == len(r.text) for r in rows)
    assert sum(r.text == article(pages[r.page_id]) for r in rows) == len(rows)


def test_best_run():
    import numpy as np

    rng = np.random.default_rng(0)
    for _ in range(200):
        s = rng.integers(-4, 5, 12).astype(float)
        b, e = X.best_run(s)
        assert s[b:e].sum() == max([0.0] + [s[i:j].sum() for i in range(12) for j in range(i + 1, 13)])
    assert X.best_run(np.empty(0)) == (0, 0)


BODY = "<p>" + "good words of the story &amp; more " * 8 + "</p>"


def test_prior_alone():
    w = X.Weights({})
    page = f"""<html><head><title>T</title><style>p{{}}</style><script>if (a<b) "<p>bad</p>"</script></head><body><nav><ul><li><a href=/>Home page</a></ul></nav>
    <div class="cookie-notice">We use cookies</div><div id=main><h1>Head   line</h1>{BODY}<!-- <p>bad</p> --><aside><p>see also these stories</p></aside>{BODY}
    <div class='ad'><p>buy</p></div><form><p>Your name</p><input></form></div><div class="comments"><p>first!</p></div><footer>&copy; someone</footer></body>"""
    text = "good words of the story & more " * 8
    assert X.extract(page, w) == "\n\n".join(["Head line", text.strip(), text.strip()])
    assert X.extract(None, w) == X.extract("", w) == X.extract("<nav>a b c</nav>", w) == X.extract("<<<>>> <!-- x", w).strip("< >") == ""
    assert X.extract("just plain text", w) == "just plain text"
    assert X.extract("<p>cut off <b>in a ta", w) == "cut off in a ta" and X.extract("<p>one<br>two<p>three", w) == "one two\n\nthree"


#: What the given tables teach: tags of menus and adverts never stand in an article.
LEARNED = X.Weights({"block:p": (50_000, 0), "block:h1": (2_000, 0), "tag:p": (2_000, 0), "tag:/p": (2_000, 0), "tag:h1": (500, 0), "tag:/h1": (500, 0),
                     **{f"mark:{m}": (0, 5_000) for m in ("nav", "div.ad", "footer")},
                     **{f"tag:{x}{t}": (0, 2_000) for t in ("div", "nav", "ul", "li", "a", "footer") for x in ("", "/")}})


def test_long_adverts_do_not_part_an_article():
    lead, close = "the lead of this short story has just a few words", "and so it ended"
    for weights in (X.Weights({}), LEARNED):
        for begin, end in (('<div class="newsletter">', "</div>"), ("<div class=ad>", "</div>"), ("<aside>", "</aside>"), ("<form>", "</form>"),
                           ('<div class="share"><ul>', "</ul></div>")):
            for n in (8, 40, 2_000):
                advert = f"{begin}\n" + "<p>sign up <b>today</b> for our weekly mail</p>\n" * n + end
                page = (f"<html><body><nav><ul><li><a href=/>Home page</a></ul></nav><article><h1>The head line</h1>{advert}<p>{lead}</p>{advert}{BODY}{advert}"
                        f"<p>{close}</p></article><footer>{'about us and our terms ' * 30}</footer></body></html>")
                assert X.extract(page, weights) == "\n\n".join(["The head line", lead, ("good words of the story & more " * 8).strip(), close])


STORY = ("good words of the story & more " * 8).strip()


def page_of(inner, before="", after=""):
    return f"<html><body><nav><ul><li><a href=/>Home page</a></ul></nav>{before}{inner}{after}<footer>about us and our terms</footer></body></html>"


def test_names_that_hold_the_article():
    for weights in (X.Weights({}), LEARNED):
        for name in ('class="content has-sidebar"', "class=social-ready", 'id="main-with-menu"', 'class="no-ads post"', 'class="page header-fixed"', "role=search"):
            assert X.extract(page_of(f"<div {name}>{BODY}{BODY}</div>"), weights) == f"{STORY}\n\n{STORY}", name
            inner = f'<div {name}><h1>The head line</h1>{BODY}<div class="sidebar"><p>see also</p></div>{BODY}</div><div class="comments"><p>{"first! " * 900}</p></div>'
            assert X.extract(page_of(inner), weights) == f"The head line\n\n{STORY}\n\n{STORY}", name
        form = f'<form action=/><div class="ad"><p>buy</p></div><h1>The head line</h1>{BODY}<div class="newsletter"><p>sign up</p></div>{BODY}</form>'
        assert X.extract(f"<html><body>{form}</body></html>", weights) == f"The head line\n\n{STORY}\n\n{STORY}"
        assert X.extract(page_of(f"<form action=/>{BODY}</form>"), weights) == STORY
        for header in ('<div class="post-header"><h1>The head line</h1></div>', "<header><h1>The head line</h1></header>"):
            assert X.extract(page_of(header + BODY), weights) == f"The head line\n\n{STORY}"
        site = "<header><h1>The Site</h1><nav><a href=/a>Sport</a></nav></header>"
        assert X.extract(page_of(f"<article>{BODY}</article>", before=site), weights) == STORY
        for rest in (f'<section class="discussion"><p>{"what I think of it " * 30}</p></section>', f'<div id="comments"><article><p>{"no, I think " * 300}</p></article></div>'):
            assert X.extract(page_of(f"<div><h2>The head line</h2>{BODY}</div>", after=rest), weights) == f"The head line\n\n{STORY}"


def test_breaks_and_odd_attributes():
    for weights in (X.Weights({}), LEARNED):
        assert X.extract(f"<p>here<br>line<br/> and<img src=x>more so<wbr>ft {STORY}", weights) == f"here line and more soft {STORY.replace('&amp;', '&')}"
        for odd in ("title=it's", 'title="it', "title='", "a=b/c'd", "= x", 'data-x="a>b" y', "x='a>b'", 'href=http://a/?q="r'):
            for page in (f"<p {odd}>one two</p>{BODY}", f"<p>one two</p><p {odd}>{STORY}</p>"):
                assert X.extract(page, weights) == f"one two\n\n{STORY}", (odd, page)


def test_unmatched_end_tags_are_linear():
    import time

    begin = time.time()
    X.Page("<div>" * 40_000 + "</section>" * 40_000)
    assert time.time() - begin < 5


def test_landmark_costs():
    page = X.Page("<p>one two</p><aside><p>" + "w " * 500 + "</p></aside><p>three</p><div class=ad></div>")
    weights = X.Weights({})
    scores = X.feature_scores(page, weights)
    marked = [i for i, f in enumerate(page.features) if f[2] == "aside"]
    assert len(marked) == 5 and scores[marked].tolist() == [-X.LANDMARK_COST, 0, 0, 0, 0]
    assert scores[-2:].tolist() == [-X.LANDMARK_COST, 0]


def test_rows(spark):
    rows = [(1, "u", None, "t"), (None, None, BODY, "t"), (2, "u", "", "t"), (2, "u", "", "t"), (3, "v", BODY * 3000, "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = X.main_text(df, X.learn(df)).collect()
    assert sorted((str(r.page_id), r.n_chars > 0) for r in got) == [("1", False), ("2", False), ("2", False), ("3", True), ("None", True)]
    empty = df.where("false")
    assert X.main_text(empty, X.learn(empty)).collect() == []
