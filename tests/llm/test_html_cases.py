"""Pages that once lost their article, an independent reader, and time in proportion to size."""

import random
import time
from html.parser import HTMLParser

import pytest

from tallyframe.llm.html import BlockRules, main_text

P1 = "The first paragraph of the article has quite a number of words, and it says what there is to say about the matter in some length for the reader."
P2 = "This is the second one, which is about as long as the first and has the usual share of words that are found in all of the prose of this kind."
MENU = "<nav><a href='/'>Home</a> <a href='/x'>Other</a></nav>"
RULES = BlockRules()


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<body><form action='/post'>{MENU}<article><p>{P1}</p><p>{P2}</p></article><input></form></body>", f"{P1}\n{P2}"),
        (f"<body><form>{MENU}<div><p>{P1}</p><p>{P2}</p></div></form></body>", f"{P1}\n{P2}"),
        (f"<article><p>{P1}</p><form><p>{P2}</p></form></article>", P1),
        (f"<p>{P1}</p><p>{P1} {P2}</p><form><label>Name</label><p>{P2}</p></form>", f"{P1}\n{P1} {P2}"),
        (f"<article><a name=top><p>{P1}</p><p>{P2}</p></article>", f"{P1}\n{P2}"),
        (f"<article><p>{P1}</p><p><a href='/r'>{P2}</a></p></article>", f"{P1}\n{P2}"),
        (f"<article><p>{P1}</p><ul><li><a href='/r'>Somebody and others, a paper on some matter, 1999</a></li></ul></article>", f"{P1}\nSomebody and others, a paper on some matter, 1999"),
        (f"<article><p>{P1}</p><ul><li><a href=a>One</a><li><a href=b>Two</a><li><a href=c>Three</a></ul><p>{P2}</p></article>", f"{P1}\n{P2}"),
        (f"<article><p>{P1} <a href=\"x\"\">there</a></p></article>", f"{P1} there"),
        (f"<article><p title=it's>{P1}</p><p class='a\"b'>{P2}</p></article>", f"{P1}\n{P2}"),
        (f"<article><p>{P1} <math><mi>x</mi></math> <label>word</label> end</p></article>", f"{P1} x word end"),
    ],
)
def test_pages_that_lost_text(page, text):
    assert main_text(page, RULES) == text


class Reader(HTMLParser):
    """Blocks of the article by a parser of its own; for pages whose markup is closed throughout."""

    def __init__(self):
        super().__init__()
        self.blocks, self.now, self.inside, self.skip = [], "", 0, 0

    def cut(self):
        text = " ".join(self.now.split())
        if text:
            self.blocks.append(text)
        self.now = ""

    def handle_starttag(self, tag, attrs):
        if tag in ("p", "h1", "h2", "li", "ul", "article", "blockquote", "nav", "aside", "footer", "div"):
            self.cut()
        self.inside += tag == "article"
        self.skip += tag in ("nav", "aside", "footer", "script", "button")

    def handle_endtag(self, tag):
        if tag in ("p", "h1", "h2", "li", "ul", "article", "blockquote", "nav", "aside", "footer", "div"):
            self.cut()
        self.inside -= tag == "article"
        self.skip -= tag in ("nav", "aside", "footer", "script", "button")

    def handle_data(self, data):
        if self.inside and not self.skip:
            self.now += data


def test_articles_equal_an_independent_reader():
    rng = random.Random(4)
    words = "the of and to a in is that for was on are with as be by at this from or an not but have river city paper &amp; &eacute;t&eacute; caf&#233;".split()

    def prose(n):
        out = [rng.choice(words) for _ in range(n)]
        for _ in range(n // 12):
            i = rng.randrange(len(out))
            out[i] = rng.choice([f"<b>{out[i]}</b>", f"<a href='/w'>{out[i]}</a>", f"<em class=x>{out[i]}</em>", f"{out[i]}<br>"])
        return rng.choice([" ", "\n  "]).join(out)

    for _ in range(60):
        body = []
        for _ in range(rng.randint(1, 8)):
            kind = rng.choice(["p", "p", "p", "blockquote", "h2", "li", "aside", "button", "script"])
            text = prose(rng.randint(25, 80))
            body.append({"li": f"<ul><li>{text}</li></ul>", "script": "<script>if (a < b) { x('<p>no</p>'); }</script>"}.get(kind, f"<{kind}>{text}</{kind}>"))
        page = f"<html><head><title>t</title></head><body>{MENU}<div class='ad'>Buy it now</div><article>{''.join(body)}</article><footer>{prose(30)}</footer></body></html>"
        reader = Reader()
        reader.feed(page)
        reader.close()
        assert main_text(page, RULES) == "\n".join(reader.blocks)


@pytest.mark.parametrize(
    "page",
    [
        lambda n: "<article>" + "".join(f"<p>w{i}</p>" for i in range(n)) + "</article>",
        lambda n: "<table>" + "<tr><td>1<td>2" * n + "</table>",
        lambda n: "<p>" + "<b>x <i>y " * n + "</p>" + "<p>z</p>" * n,
        lambda n: "<div><span>" * n + "text" + "</em>" * n,
    ],
)
def test_time_grows_with_the_page(page):
    def took(n):
        start = time.process_time()
        main_text(page(n), RULES)
        return time.process_time() - start

    took(500)
    assert took(16_000) < 4 * 4 * max(took(4_000), 0.02)
