import html
import random
import re

import pyarrow.parquet as pq

from ledgerlark.llm import html_text as H

GOOD = ("This is a paragraph of the article with many of the words that are in all the texts and it is as long as it "
        "has to be for the first pass to see that it is good and not some part of a menu or of a list of links. ") * 2
BAD = "lorem ipsum dolor amet consectetur adipiscing elit sed eiusmod tempor incididunt labore dolore magna aliqua " * 2


def test_article_pages():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";if(a<b){}</script></head>
    <body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href="/x">Menu</a></li></ul></nav>
    <div class="cookie-notice"><p>We use cookies on this site and so on.</p></div><!-- <p>hidden</p> -->
    <article><header><h1>Title &amp; more</h1><span>by me</span></header><p>One&nbsp;two<br>three <b>bo</b>ld.
    <p>Next &lt;tag&gt; &eacute; &#x41;&am<aside>Side</aside><div id="ad-7">Buy</div><form><p>in</p></form>
    <p hidden>gone</p><p style="display: none">gone</p><ul><li>item</li></ul>
    <section class="reader comments"><p>A reader says something.</p></section><p title="a > b">End.</p></article>
    <div class="related"><p>Other things to read.</p></div><footer>&copy; me</footer></body></html>"""
    assert H.main_text(page) == "Title & more\n\nOne two three bold.\n\nNext <tag> é A&am\n\nitem\n\nEnd."


def test_unmarked_pages():
    page = (f"<div><a href=x>Home</a> <a href=y>About</a></div><h2>Heading</h2><p>{GOOD}</p><p>Short.</p><p>{GOOD}</p>"
            f"<p>{BAD}</p><p>Tail.</p><div>{BAD}</div>")
    good = " ".join(GOOD.split())
    assert H.main_text(page) == f"{good}\n\nShort.\n\n{good}"


def para(n):
    return " ".join(f"{n} {GOOD}".split())


def test_body_in_divs_with_article_cards():
    cards = "".join(f'<article class="card"><h3>Card {i}</h3><p>A short line on card {i}.</p></article>' for i in range(6))
    page = f"<div class=body><div>{para(1)}</div><div>{para(2)}</div><div>{para(3)}</div></div><div>{cards}</div>"
    assert H.main_text(page) == "\n\n".join(map(para, (1, 2, 3)))
    assert H.main_text(f"<main>{page}</main>") == "\n\n".join(map(para, (1, 2, 3)))
    # cards beside a marked article
    assert H.main_text(f"<article><p>{para(1)}</p><p>{BAD}</p></article>{cards}") == f"{para(1)}\n\n{' '.join(BAD.split())}"
    # nothing but cards
    assert H.main_text(cards).count("A short line") == 6


def test_names_count_as_a_whole():
    kept = ["share-price", "ad-hoc", "commentary", "social-history", "noticeable", "footerless", "cookie-recipe"]
    gone = ["ad", "ad-7", "ads_top", "cookie-notice", "siteFooter", "share-buttons", "comments", "newsletter-signup", "related-posts"]
    page = "<article><p>Start.</p>" + "".join(f'<div class="x {c}"><p>About {c}.</p></div>' for c in kept + gone) + "</article>"
    assert H.main_text(page) == "\n\n".join(["Start.", *(f"About {c}." for c in kept)])


def test_two_articles():
    page = f"<div>Outside.</div><article><h2>One</h2><p>{para(1)}</p></article><article><h2>Two</h2><p>{para(2)}</p><p>End</p></article>"
    assert H.main_text(page) == f"One\n\n{para(1)}\n\nTwo\n\n{para(2)}\n\nEnd"
    assert H.main_text("<div>Outside.</div><article><p>One.</p></article><article><p>Two.</p></article>") == "One.\n\nTwo."
    assert H.main_text(f"<main><h1>Title</h1><article><p>{para(1)}</p></article></main>") == f"Title\n\n{para(1)}"


def brute(page):
    """Both passes over the blocks, each rule spelt out and each neighbour
    searched for."""
    found, parts = H.blocks(page)

    def first(b):
        words = re.findall(r"[^\W\d_]+", b.text.lower())
        share = sum(w in H.STOP_WORDS for w in words) / len(words) if words else 0
        if b.out or 2 * b.link_chars > len(b.text):
            return "bad"
        if len(b.text) < 70:
            return "?"
        if share >= 0.3:
            return "good" if len(b.text) > 200 else "?"
        return "few" if share < 0.15 else "?"

    label = [first(b) for b in found]
    live = [i for i, b in enumerate(found) if not b.out]
    inside, outside = (sum(len(found[i].text) for i in live if label[i] == "good" and (found[i].part > 0) == x) for x in (True, False))
    marked = any(found[i].part for i in live) and inside >= outside
    whole = set()
    if marked:
        for p in range(1, len(parts)):
            own = [i for i in live if found[i].part == p]
            links, chars = sum(found[i].link_chars for i in own), sum(len(found[i].text) for i in own)
            if any(label[i] == "good" for i in own) or not (parts[p].card or 2 * links > chars):
                whole.add(p)
        whole = whole or set(range(1, len(parts)))
        label = ["bad" if b.part not in whole else "?" if x == "few" else x for b, x in zip(found, label)]
    label = ["bad" if x == "few" else x for x in label]
    out = []
    for i, b in enumerate(found):
        if label[i] == "?":
            side = []
            for step in (-1, 1):
                j = i + step
                while 0 <= j < len(found) and (found[j].part != b.part or found[j].out or label[j] == "?"):
                    j += step
                side.append((abs(j - i) if 0 <= j < len(found) else 10 ** 9, label[j] == "good" if 0 <= j < len(found) else b.part in whole))
            (d, was), (e, comes) = side
            good = was or comes if b.part in whole else was and comes if d == e else was if d < e else comes
        else:
            good = label[i] == "good"
        out.append(good)
    return [b.text for b, good in zip(found, out) if good]


def test_both_passes_against_brute_force():
    rnd = random.Random(4)
    texts = [GOOD, GOOD[:150], BAD, BAD[:100], "short", "a link", GOOD[:60], "x " * 50]
    for n in range(400):
        page, open_parts = "", []
        for _ in range(rnd.randrange(1, 25)):
            r = rnd.random()
            if r < .12:
                tag = rnd.choice(["article", "main", "article class=card"])
                page += f"<{tag}>"
                open_parts.append(tag.split()[0])
            elif r < .2 and open_parts:
                page += f"</{open_parts.pop()}>"
            else:
                text = rnd.choice(texts)
                if rnd.random() < .25:
                    text = f"<a href=x>{text}</a>"
                page += f"<{rnd.choice(['p', 'div', 'li', 'aside', 'div class=ad', 'h2'])}>{text}</p></div></li></aside></h2>"
        assert [b.text for b, good in H.judged(page) if good] == brute(page), page


def test_broken_markup():
    assert H.main_text("<article><p>One<p>Two <b>three") == "One\n\nTwo three"
    assert H.main_text("<article><p>One</p><p>Two &am") == "One\n\nTwo &am"
    assert H.main_text("<article><p>One</p><p cla") == "One"
    assert H.main_text("<article><p>One <a href=\"x>y</p><p>a < b and c</p>").startswith("One")
    assert H.main_text("<article><p>One</p><!-- never closed <p>x</p>") == "One"
    assert H.main_text("<article><script>never closed <p>x</p>") == ""
    assert H.main_text(None) == H.main_text("") == H.main_text("<nav>x</nav>") == ""


def test_long_page_is_linear():
    page = "<article>" + "<p>word <b>" * 30_000
    assert H.main_text(page).count("\n\n") == 29_999


def test_query_rows(spark):
    df = spark.createDataFrame([(1, "u", "<article><p>A 日 </p><p>b</p></article>", "x"), (1, "u", None, "y"), (None, None, "", "z")],
                               "page_id long, url string, html string, text string")
    got = sorted((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in H.extract(df).collect())
    assert got == [(0, "", "", 0), (1, "u", "", 0), (1, "u", "A 日\n\nb", 6)]
    assert H.extract(df.limit(0)).count() == 0


def test_articles_of_the_table():
    rows = pq.read_table("/root/testdata/sf0.01/pages.parquet").to_pylist()
    for r in rows:
        body = re.search(r"<article>(.*?)(?:</article>|\Z)", r["html"], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", body)]
        assert H.main_text(r["html"]) == "\n\n".join(p for p in parts if p)
