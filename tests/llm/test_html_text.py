import pytest

from sensorium.llm.html_text import SURGE_CHARS, SURGE_PART, WINDOW, extract, lines_of, main_text

ARTICLE = "<article><h1>Head &amp; line</h1><p><b>One  two\n three.<br><p>Ti.</p><p>Long text &lt;b&gt; with &eacute;.</p></article>"
WANT = "Head & line\nOne two three.\nTi.\nLong text <b> with é."
PAGE = ('<!DOCTYPE html><html lang="en"><head><title>T</title><style>p{margin:0}</style><script>var t="</p>";</script></head><body>'
        '<nav><ul><li><a href="/x">Menu</a></li></ul></nav><!-- ad 0 --><div class="ad">Buy this very long advert text now, please.</div>{}'
        "<footer>&copy; 2020 &middot; somebody\nelse.</footer></body></html>")


def test_page_like_the_given_ones():
    assert main_text(PAGE.replace("{}", ARTICLE)) == WANT


@pytest.mark.parametrize("extra", [
    '<aside>Side text that is long enough to look like a paragraph of the article.</aside>',
    '<div class="sidebar"><div>nested</div> more text of a sidebar</div>', '<div id="cookie-notice">We use cookies, a lot of them.</div>',
    '<form><label>Name</label><input name=x><textarea>type</textarea></form>', '<section class="comments"><p>First comment!</p><p>Second.</p></section>',
    '<header><h1>Site</h1></header>', "<script>if (a < b) { document.write('<p>no</p>') }</script>", "<noscript><p>enable</p></noscript>",
    '<div hidden>secret</div>', "<ul class='menu'><li>a<li>b</ul>", "<!-- <p>gone</p> -->", "<style>.a{content:'<p>'}</style>"])
@pytest.mark.parametrize("where", ["before", "after", "inside"])
def test_other_parts_are_left_out(extra, where):
    body = {"before": extra + ARTICLE, "after": ARTICLE + extra, "inside": ARTICLE.replace("<p>Ti.", extra + "<p>Ti.")}[where]
    assert main_text(PAGE.replace("{}", body)) == WANT


def test_without_an_article_element():
    long = "A paragraph of the article that goes on for quite a while, so that it stands out. "
    body = f"<div class='content has-sidebar no-comments'><h2>Title</h2><p>{long * 3}</p><p>Short.</p><div class=ad>buy</div><p>{long}</p></div>"
    assert main_text(PAGE.replace("{}", body)) == f"Title\n{long.strip()} {long.strip()} {long.strip()}\nShort.\n{long.strip()}"


@pytest.mark.parametrize(("page", "want"), [
    ("", ""), ("just text &am", "just text &am"), ("<p>a &amp b", "a & b"), ("<article><p>cut off <foot", "cut off"), ("<article><p>x</p><p>y <a hr", "x\ny"),
    ('<article><p title="a > b">x</p></article>', "x"), ("<article><p title=\"odd>x</p></article>", "x"), ("<nav>never closed<article><p>x</p></article>", "x"),
    ("<article>1 < 2 and 3 > 2</article>", "1 < 2 and 3 > 2"), ("<ARTICLE><P>x<P>y</ARTICLE>", "x\ny"), ("<div class=ad>only an advert</div>", ""),
    ("<article><p>" + "word " * 100_000 + "</p></article>", ("word " * 100_000).strip()), ("<article><p>a&nbsp; b</p></article>", "a b"),
    ("<article><ul><li><a href=x>all link</a></li></ul><p>t</p></article>", "all link\nt")])
def test_odd_pages(page, want):
    assert main_text(page) == want


@pytest.mark.parametrize("n", [1, 8, 20])
@pytest.mark.parametrize("raw", ["<script>var a = 1;</script>", "<STYLE>p{}</Style >", "<svg><text>x</text></svg>"])
def test_letters_that_grow_in_lower_case(n, raw):
    assert main_text(f"<article><p>{'\u0130' * n}</p>{raw}<div class=ad>buy this</div><p>Text.</p></article>") == "\u0130" * n + "\nText."


LONG = "A paragraph of the article that goes on for quite a while, so that it stands out from all else on the page."
BODY = f"<div class=content><h2>A title of the article that is so long</h2><p>{LONG}</p><p>{LONG}</p></div>"
BODY_TEXT = f"A title of the article that is so long\n{LONG}\n{LONG}"


@pytest.mark.parametrize(("page", "want"), [
    (BODY + "<article class=comment><p>First comment!</p></article><article class='comment odd'><p>Second.</p></article>", BODY_TEXT),
    ("<article class=teaser><h3>Other</h3><p>Read on.</p></article>" + BODY + "<article class=teaser><p>More.</p></article>", BODY_TEXT),
    (BODY + "<aside><article><p>Related</p></article><article><p>Other</p></article></aside>", BODY_TEXT),
    (BODY + "<section class=comments><article><p>c1</p></article><article><p>c2</p></article></section>", BODY_TEXT),
    (BODY + "<article><h3>Read this</h3><p>A short teaser.</p></article>", BODY_TEXT),
    (f"<article><p>{LONG}</p><section class=comments><article>c1</article><article>c2</article></section><p>End.</p></article>", LONG + "\nEnd."),
    (f"<article><p>{LONG}</p><div class=comments><article><div>c1</div></article><div>c2</div></div></article><p>Out.</p>", LONG),
    (f"<article class='post category-social tag-ads'><p>{LONG}</p></article>", LONG),
    (f"<main><article><p>{LONG}</p></article><article class=teaser><p>Other</p></article><p>End.</p></main>", LONG + "\nEnd."),
    (f"<div><div class=sidebar>never closed<article><p>{LONG}</p></article></div>", LONG),
    (f"<article><p>One <span class=ad>buy <span>this</span> now</span> line.</p><p>Two <b class=promo>buy</p><p>{LONG}</p></article>",
     f"One line.\nTwo\n{LONG}"),
    (f"<article><p>{LONG}</div><p>Stray end.</p><nav><ul><li>a</div></ul><p>menu</p></nav><p>End.</p></article><p>Out.</p>", f"{LONG}\nStray end.\nEnd.")])
def test_article_elements_among_others(page, want):
    assert main_text(PAGE.replace("{}", page)) == want


VERSES = "".join(f"<p>Verse {i}.</p>" for i in range(12))


@pytest.mark.parametrize(("body", "want"), [
    (f"<div class=content><h1>The headline of the article</h1><p>By somebody</p><p>2 May 2020</p><p>{LONG * 3}</p></div>",
     f"The headline of the article\nBy somebody\n2 May 2020\n{LONG * 3}"),
    (f"<div class=content><h1>Headline</h1><div>By x</div><p>Day</p><p>Standfirst.</p><ul><li>One</li><li>Two</li></ul><p>{LONG}</p></div>",
     f"Headline\nBy x\nDay\nStandfirst.\nOne\nTwo\n{LONG}"),
    (f"<div class=top><h1>Headline</h1><p>By x</p><p>Day</p></div><div class=text><p>A.</p><p>B.</p><p>{LONG}</p></div>", f"Headline\nBy x\nDay\nA.\nB.\n{LONG}"),
    (f"<div>{VERSES}<p>{LONG}</p>{VERSES}</div>", "\n".join([*(f"Verse {i}." for i in range(12)), LONG, *(f"Verse {i}." for i in range(12))])),
    (f"<div>Welcome!</div><div><p>Low.</p><p>By x</p><p>Day</p><p>{LONG}</p></div>", f"Low.\nBy x\nDay\n{LONG}")])
def test_what_leads_up_to_the_surge_is_kept(body, want):
    assert main_text(PAGE.replace("{}", body)) == want


@pytest.mark.parametrize("name", ["id=related-work", "id='market-share'", "id=form-factor", "id=search-algorithms", "class=side-effects",
                                  "class='section has-sidebar'", "id=header-files", "class=socialism"])
def test_names_of_sections(name):
    body = f"<article><h1>Title</h1><p>{LONG}</p><section {name}><h2>A section</h2><p>Its text.</p></section><p>End.</p></article>"
    assert main_text(PAGE.replace("{}", body)) == f"Title\n{LONG}\nA section\nIts text.\nEnd."


@pytest.mark.parametrize("name", ["class=adBox", "class=ad1", "class='x ad-unit-7'", "id=postComments", "class=kommentare", "class=share-buttons", "id=related_posts",
                                  "class='side-bar'", "class=siteHeader", "id=searchForm", "class=comment-body", "role=complementary"])
def test_names_of_other_parts(name):
    body = f"<article><h1>Title</h1><p>{LONG}</p><div {name}><p>Something else that is about as long as a paragraph.</p></div><p>End.</p></article>"
    assert main_text(PAGE.replace("{}", body)) == f"Title\n{LONG}\nEnd."


def test_a_header_that_opens_an_article():
    body = f"<article><header><h1>Headline</h1><p>By x</p></header><p>{LONG}</p><header><p>Site.</p></header><p>End.</p></article>"
    assert main_text(PAGE.replace("{}", body)) == f"Headline\nBy x\n{LONG}\nEnd."


def test_links_within_a_text_do_not_end_it():
    links = "".join(f"<p><a href=/{i}>A link of some words {i}</a></p>" for i in range(4))
    body = f"<div class=content><h1>Title</h1><p>{LONG}</p>{links}<p>The end.</p></div><div>Copyright.</div>"
    assert main_text(PAGE.replace("{}", body)) == f"Title\n{LONG}\nThe end."


def plain(page):
    """The windows in plain Python: sums are added up anew for each, and the ends follow from their definition."""
    lines = lines_of(page)
    inside = any(w and i for _, w, i, _, _ in lines)
    weights = [w if i or not inside else 0 for _, w, i, _, _ in lines]
    sums = [sum(weights[k:k + WINDOW]) for k in range(len(weights))]
    top = max(sums, default=0)
    if not top:
        return ""
    least = 1 if inside else min(SURGE_CHARS, SURGE_PART * top)
    surged = [k for k, s in enumerate(sums) if s >= least]
    end = surged[-1]
    while end < len(sums) and sums[end]:
        end += 1
    kept = [lines[k][0] for k in range(surged[0], end) if weights[k]]
    return "\n".join(kept)


def test_windows_match_a_plain_version():
    import random
    rnd = random.Random(3)
    for _ in range(300):
        blocks = "".join(rnd.choice(["<p>{}</p>", "<p><a href=x>{}</a></p>", "<h2>{}</h2>", "<nav><p>{}</p></nav>"]).format("word " * rnd.choice([1, 2, 30])) for _ in range(20))
        page = rnd.choice(["<article>{}</article>", "{}"]).replace("{}", blocks)
        got, want = main_text(page).split("\n"), plain(page).split("\n")
        # beside the windows' lines only those that adjoin the surge come before
        assert got[len(got) - len(want):] == want
        if page.startswith("<article>"):
            assert got == want


def test_operator(make):
    df = make("page_id long, url string, html string, text string", [(1, "u", PAGE.replace("{}", ARTICLE), "clash"), (None, None, None, None), (1, "u", "", "")])
    assert sorted(map(tuple, extract(df).collect()), key=str) == sorted([(1, "u", WANT, len(WANT)), (None, None, "", 0), (1, "u", "", 0)], key=str)
    assert extract(make("page_id long, url string, html string", [])).count() == 0
