"""Main-text extraction: hand-made pages, edge rows, and the tables' articles."""
import html as entities
import re
from collections import Counter

from lakeshore.llm import maintext
from lakeshore.llm.common import table

from .cases import SF

P = "This paragraph has quite a few words so that it counts as text of the article itself."
PAGES = {
    "plain": (f"<html><body><nav><ul><li><a href=x>Home</a></li><li><a>News</a></li></ul></nav><article><h1>Title &amp; more</h1><p>{P}"
              f"<p>Second\n\n  one: {P}</p></article><footer>&copy; somebody 2020</footer></body></html>", f"Title & more\n{P}\nSecond one: {P}"),
    "no article": (f"<body><div class='menu'><a>One</a> <a>Two</a></div><div id=content><h2>Head</h2><p>{P}</p><p>{P}</p></div>"
                   f"<div class='sidebar'><p>Buy this now and read that too</p></div><div id='comments'><p>I think {P}</p></div></body>",
                   f"Head\n{P}\n{P}"),
    "inside": (f"<article><p>{P}</p><aside>Related things</aside><form>Your mail <input></form><div class='ad-box ad'>Advert</div>"
               f"<script>var a = '</p>';</script><!-- hidden > --><p>{P} <a href='y'>link</a> 1&lt;2</p>"
               f"<section class=comments><p>Reader says {P}</p></section></article>", f"{P}\n{P} link 1<2"),
    "cut off": (f"<article><h1>T</h1><p>{P}</p><p>{P} and the rest &am", f"T\n{P}\n{P} and the rest &am"),
    "cut tag": (f"<article><p>{P}</p><p>{P}<a hre", f"{P}\n{P}"),
    "unclosed": (f"<article><p><b>{P}<br><p>{P}</article>", f"{P}\n{P}"),
}


def test_pages():
    learned = maintext.weights(sum((maintext.count(PAGES["plain"][0]) for _ in range(40)), start=maintext.Counter()))
    for name, (page, want) in PAGES.items():
        assert maintext.extract(page, learned, {}) == want, name
        if name != "cut off":
            assert maintext.extract(page, {}, {}) == want, f"{name}, without weights"


def test_edges(spark):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (3, "u", "   <>< <b", "x"), (3, "u", "   <>< <b", "x"), (4, "u", "<div>" * 5000 + P, "x"),
            (5, "u", f"<article>{'<p>' + P + '</p>' * 1}" * 3000, "x"), (None, "u", PAGES["plain"][0], "x")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, kind string").repartition(2)
    out = maintext.main_text(df, maintext.fit(df))
    assert out.columns == [*df.columns, "text"] and out.count() == len(rows)
    got = {r.page_id: r.text for r in out.collect()}
    assert got[1] == got[2] == "" and got[4] == P and got[None] == PAGES["plain"][1]
    none = df.limit(0)
    assert maintext.main_text(none, maintext.fit(none)).count() == 0


def test_tables(spark):
    def article(page):
        m = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)
        blocks = re.split(r"</?(?:p|h\d)\b[^>]*>", m[1]) if m else []
        texts = [re.sub(r"<[^>]*(?:>|\Z)", lambda t: " " if t[0].startswith("<br") else "", b) for b in blocks]
        return "\n".join(t for t in (" ".join(entities.unescape(x).split()) for x in texts) if t)

    want = {r.page_id: article(r.html) for r in table(spark, SF, "pages").collect()}
    got = {r.page_id: (r.text, r.n_chars) for r in maintext.query(spark, SF).collect()}
    assert got == {k: (v, len(v)) for k, v in want.items()}


def test_wrappers_and_comment_articles():
    """Names and forms that wrap the page are no veto; articles in closed noise sections are no main text."""
    body = f"<h2>A heading of seven words or so</h2><p>{P}</p><p>{P}</p>"
    want = f"A heading of seven words or so\n{P}\n{P}"
    side = "<div class='sidebar'><p>Buy this now</p></div>"
    for open_, close in (("<div class='content-with-sidebar'>", "</div>"), ("<div class=has-sidebar>", "</div>"),
                         ("<div id='layout-banner'>", "</div>"), ("<div class='page-sidebar-left'>", "</div>"),
                         ("<form id='aspnetForm' method=post>", "</form>"), ("<form><fieldset>", "</fieldset></form>")):
        page = f"<body><nav><a>Home</a></nav>{open_}{body}{side}{close}<footer>Somebody</footer></body>"
        assert maintext.extract(page, {}, {}) == want, open_
    cards = f"<article><p>Reader says {P}</p></article>" * 6
    for open_, close in (("<aside>", "</aside>"), ("<section class='comments'>", "</section>"), ("<div class='comments-area'>", "</div>")):
        page = f"<body><div>{body}</div>{open_}{cards}{close}</body>"
        assert maintext.extract(page, {}, {}) == want, open_
        assert maintext.extract(f"<body><article>{body}</article>{open_}{cards}{close}</body>", {}, {}) == want, open_
    small = f"<body><div>{body}</div><form>Your mail <input></form><div class='ad-box'>Advert</div></body>"
    assert maintext.extract(small, {}, {}) == want
    for start in ("<nav><ul><li><a>Home</a>", "<div id=wrap><div class=menu><a>Home</a>", "<div class=menu><a>Home</a>"):
        assert maintext.extract(f"<body>{start}<article>{body}</article></div></body>" if "wrap" in start
                                else f"<body>{start}<article>{body}</article></body>", {}, {}) == want, start
    assert maintext.extract(f"<body><form><article>{body}</article></form><div>{'other words ' * 9}</div></body>", {}, {}).startswith(want)


NAMES = ("search", "legal", "social", "tags", "toc", "banner", "reply", "login", "notices", "comments", "sidebar", "menu", "share",
         "widget", "promo", "overlay", "copyright", "related", "discussion", "pagination")


def test_names_round_the_article():
    """A whole name of noise round the page's text does not empty it; beside the text it is noise as before."""
    head = "A heading of seven words or so"
    body, want = f"<h2>{head}</h2><p>{P}</p><p>{P}</p>", f"{head}\n{P}\n{P}"
    top, foot = "<nav><a>Home</a> <a>News</a></nav>", "<div class='footer'>Somebody wrote this</div><aside>More</aside>"
    for name in NAMES:
        for open_, close in ((f"<div class='{name}'>", "</div>"), (f"<section id={name}>", "</section>"),
                             (f"<div class='page {name}'><div>", "</div></div>"), (f"<div class={name}><main>", "</main></div>")):
            assert maintext.extract(f"<body>{top}{open_}{body}{close}{foot}</body>", {}, {}) == want, open_
            inner = f"{open_}{body}{close}".replace("<main>", "").replace("</main>", "")
            assert maintext.extract(f"<body>{top}<main>{inner}</main>{foot}</body>", {}, {}) == want, ("main", open_)
        noise = f"<div class='{name}'><p>Words that are no article, {P}</p></div>"
        for article in (f"<div>{body}</div>", f"<article>{body}</article>", f"<main>{body}</main>", f"<div class=post>{body}</div>"):
            assert maintext.extract(f"<body>{top}{article}{noise}{foot}</body>", {}, {}) == want, (name, article)
            assert maintext.extract(f"<body>{top}{article}{noise * 12}{foot}</body>", {}, {}) == want, (name, article, "many")
            assert maintext.extract(f"<body>{top}{article.replace('</p><p>', '</p>' + noise + '<p>')}{foot}</body>", {}, {}) == want, (name, article)
    # a long thread of comments below a short text is not the page's text
    thread = f"<div class=comments>{f'<div class=reply><p>{P} {P}</p></div>' * 30}</div>"
    assert maintext.extract(f"<body>{top}<article>{body}</article>{thread}</body>", {}, {}) == want


def test_articles_without_the_element(spark):
    """Recall on the tables' pages with their article element taken away (and put under a name of noise)."""
    rows = table(spark, SF, "pages").select("page_id", "html").collect()
    learned = maintext.fit(table(spark, SF, "pages"))
    for tag in ("<div>", "<div class='social'>"):
        found = words = extra = 0
        for r in rows:
            page = r.html or ""
            truth = Counter(maintext.extract(page, learned, {}).split())
            got = Counter(maintext.extract(page.replace("<article>", tag).replace("</article>", "</div>"), learned, {}).split())
            words, found, extra = words + truth.total(), found + (truth & got).total(), extra + (got - truth).total()
        print(tag, len(rows), found / words, extra / words)
        assert found >= 0.9 * words and extra <= 0.1 * words, tag


def test_embedded_elements():
    """Icons and media before the article take nothing of it, closed or not; what is closed is left out."""
    want = f"{P}\n{P}"
    rest = f"<p>{P}</p><p>{P}</p>"
    for start in ("<svg class='i'/>", "<math display=block />", "<svg class='i'><path d='M0'>", "<math><mi>x", "<select><option>A<option>B",
                  "<object data=x><param name=y>", "<canvas id=c>", "<audio src=a>", "<video src='a>b'>", "<video-player src=a></video-player>",
                  "<svg><title>Icon</title><style/><path/></svg>", "<select><option>A</select>", "<template><p>No</p></template>",
                  "<object><p>No</p><object><p>No</p></object></object>", "<video>No video</video>", "<svg/><svg><text>No</text></svg>"):
        for end in ("", "<svg><text>No</text></svg><video src=b>No video</video>"):
            assert maintext.extract(f"<body><article>{start}{rest}{end}</article></body>", {}, {}) == want, start
            assert maintext.extract(f"<body><div>{start}</div><article>{rest}</article>{end}</body>", {}, {}) == want, start
    for raw in ("script", "style", "textarea", "title", "iframe", "noscript"):
        assert maintext.extract(f"<article>{rest}<{raw}><p>No</p></{raw}></article><{raw}><p>{P}", {}, {}) == want, raw
