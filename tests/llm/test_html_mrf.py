import html as stdlib_html
import itertools
import math
import random
import re

import numpy as np
import pytest

from tickforge.llm import html_mrf as hm
from tickforge.llm import queries

from tests.conftest import SF001 as SF


@pytest.fixture(scope="module")
def model():
    return hm.default_model()


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    parent = [-1, 0, 1, 1, 0, 4, 4, 6]
    n = len(parent)
    f, sort = rng.normal(size=(n, hm.N_FEATURES)), rng.integers(0, 3, n)
    m = hm.TreeModel(rng.normal(size=hm.N_FEATURES) * 0.3, rng.normal(size=(3, 2, 2)))
    weight = {}
    for y in itertools.product((0, 1), repeat=n):
        s = sum(y[v] * (f[v] @ m.w) for v in range(n))
        weight[y] = math.exp(s + sum(m.pair[sort[v], y[parent[v]], y[v]] for v in range(1, n)))
    z = sum(weight.values())
    content, edges, log_z = m.marginals(parent, f, sort)
    assert abs(log_z - math.log(z)) < 1e-9
    for v in range(n):
        assert abs(content[v] - sum(w for y, w in weight.items() if y[v]) / z) < 1e-9
        for a, b in itertools.product((0, 1), repeat=2):
            if v:
                want = sum(w for y, w in weight.items() if (y[parent[v]], y[v]) == (a, b)) / z
                assert abs(math.exp(edges[v][a][b]) - want) < 1e-9


def test_training_raises_the_likelihood_and_reruns_agree():
    pages = hm.labelled_pages(20, seed=5)
    def likelihood(m):
        total = 0.0
        for p in pages:
            parent, tag, attrs, texts, share, y = hm.states(p)
            f, sort, _ = hm.features(parent, tag, attrs, texts, share)
            _, _, log_z = m.marginals(parent, f, sort)
            total += (f @ m.w) @ np.array(y) - log_z + sum(
                m.pair[sort[v], y[parent[v]], y[v]] for v in range(1, len(parent)))
        return total
    one, two = hm.train(pages, rounds=3), hm.train(pages, rounds=25)
    assert likelihood(two) > likelihood(one) > likelihood(hm.TreeModel(np.zeros(hm.N_FEATURES), np.zeros((3, 2, 2))))
    again = hm.train(pages, rounds=3)
    assert (again.w == one.w).all() and (again.pair == one.pair).all()


def test_held_out_templates(model):
    wrong = total = 0
    for page in hm.labelled_pages(100, seed=991):
        parent, tag, attrs, texts, share, y = hm.states(page)
        f, sort, leaf = hm.features(parent, tag, attrs, texts, share)
        content, _, _ = model.marginals(parent, f, sort)
        wrong += sum((c > 0.5) != s for c, s, is_text in zip(content, y, leaf) if is_text)
        total += sum(leaf)
    assert wrong / total < 0.02


def test_blocks_and_references(model):
    page = """<html><head><title>No</title><style>p{}</style><script>var t="</p>";x()</script></head><body>
    <nav><ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li></ul></nav><!-- <p>hidden</p> -->
    <div class="ad">Buy this now!</div>
    <article><h1>Big &amp; small &lt;news&gt;</h1><p><b>The first   paragraph,\n\t&eacute;t&#233; and more of it.<br>
    <p>Second one with <a href=/x>a link</a> inside, it goes on &mdash; for long.</p>
    <ul><li>Item one is here.<li>Item two is here.</ul>
    <section class="comments"><p>Nice article, thanks!</p><p>I do not agree at all.</p></section></article>
    <aside><p>Read also this story.</p></aside>
    <form><label>Your mail</label><input><button>Send</button></form>
    <footer>&copy; 2020 somebody &middot; all rights.</footer></body></html>"""
    assert model.extract(page) == "\n\n".join([
        "Big & small <news>", "The first paragraph, été and more of it.",
        "Second one with a link inside, it goes on — for long.", "Item one is here.", "Item two is here."])


def test_omitted_end_tags_of_silent_elements(model):
    first = "The first paragraph is here, and it goes on for a while."
    second = "The second paragraph is here, with more of the same text."
    body = f"<article><h1>A title of some length</h1><p>{first}<p>{second}</article>"
    want = "\n\n".join(["A title of some length", first, second])
    for start in ("<head><title>x</title><body>", "<html><head><meta charset=utf-8><title>x</title><style>p{}</style>",
                  "<body><datalist><option>a<option>b</datalist>", "<body><select><optgroup><option>a<option>b</select>",
                  "<body><div><button>Menu</div>", "<body><button>Menu", "<body><div><video src=x></div>",
                  "<body><object data=x>", "<body><svg><path d=x>", "<body><div><svg><g></div><svg></svg>",
                  "<body><svg><title>Icon</title><path/></svg>", "<body><video>", "<body><p><option>a<option>b</p>"):
        assert model.extract(start + body) == want, start
    # What is closed stays silent, whatever it holds.
    for silent in ("<video><p>Your browser is too old for this film.</p></video>", "<noscript><p>Switch on the scripts.</p></noscript>",
                   "<template><div><article><p>A pattern of a page.</p></article></div></template>",
                   "<button><div>Press this button now.</div></button>", "<textarea><p>Write here.</p></textarea>"):
        assert model.extract("<body>" + silent + body) == want, silent
    formula = "<math><mrow><mi>E</mi><mo>=</mo><mi>m</mi></mrow><annotation>tex</annotation></math>"
    got = model.extract(f"<article><h1>A title of some length</h1><p>{first} It says {formula} of all bodies.<p>{second}</article>")
    assert f"{first} It says E=m of all bodies." in got


def test_broken_and_deep_pages(model):
    for page in (None, "", "   ", "<", "<p", "</div></div>", "<!--", "<script>x", "&amp;&bogus;&#0;", "<a></b><i>",
                 "<div>" * 3000 + "x" + "</div>" * 10, "<p><b>" * 500 + "t", "plain text only " * 200):
        assert isinstance(model.extract(page), str)
    rng = random.Random(1)
    bits = ["<p>", "</p>", "<div class=x>", "</div>", "<li>", "<b>", "</b>", "text ", "<br>", "<td>", "<script>",
            "</script>", "<article>", "</article>", "&lt;", "<!--", "-->", "<table>", "</table>", "<a href=x>", "</a>"]
    for _ in range(300):
        model.extract("".join(rng.choice(bits) for _ in range(60)))


def test_whole_table(spark):
    """Brute force: the article of the table's pages by regular expressions."""
    got = queries.op9_html_text(spark, SF).collect()
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(got) == len(pages)
    same = 0
    for r in got:
        inner = re.search(r"<article>(.*)</article>", pages[r["page_id"]], re.S)[1]
        blocks = [" ".join(stdlib_html.unescape(re.sub(r"<[^>]+>", " ", b)).split())
                  for b in re.split(r"</?p>|</?h1>", inner)]
        same += r["text"] == "\n\n".join(b for b in blocks if b)
        assert r["n_chars"] == len(r["text"])
    assert same >= 0.99 * len(pages)


def test_frame_edges(spark, model):
    schema = "page_id long, url string, html string"
    rows = [(1, None, None), (None, "u", ""), (2, "u", "<article><p>Hello there, this is a text.</p></article>"),
            (2, "u", "<article><p>Hello there, this is a text.</p></article>")]
    got = hm.main_text(spark.createDataFrame(rows, schema), model).collect()
    assert len(got) == 4 and sum(r["text"] == "" for r in got) == 2
    assert hm.main_text(spark.createDataFrame([], schema), model).count() == 0
    clash = hm.main_text(spark.createDataFrame(rows, schema), model, out="url")
    assert clash.columns == ["page_id", "html", "url"] and clash.count() == 4


def test_short_pages_keep_their_text(model):
    for page, want in [("<body><p>Hello world, this is a short page.</p></body>", "Hello world, this is a short page."),
                       ("<p>One line</p>", "One line"),
                       ("<html><head><title>x</title></head><body><h1>Title</h1><p>And a line of text.</p></body></html>",
                        "Title\n\nAnd a line of text.")]:
        assert model.extract(page) == want, page


def test_names_of_article_parts_are_read_word_by_word(model):
    first, second = "We follow the usual design and report all results of the trial here.", "Others have found the same, with more patients."
    start = f"<body><nav><a href=/a>Home</a> <a href=/b>News</a></nav><article><h1>A trial</h1><p>{first} {second}</p>"
    for mark in ('class="related-work"', 'id="discussion"', 'class="side-effects"', 'id="social-history"', 'class="legal-history"'):
        got = model.extract(f"{start}<section {mark}><h2>A heading</h2><p>{second}</p><p>{first}</p></section></article><footer>© A site</footer></body>")
        assert got == "\n\n".join(["A trial", f"{first} {second}", "A heading", second, first]), mark
    for mark in ('class="related-posts"', 'class="comments"', 'id="siteFooter"', 'class="discussion"'):
        inner = f'<div class="comment"><span>Ann</span><p>{second}</p></div>' * 2 if "r" not in mark or "disc" in mark or "comm" in mark \
            else "<ul><li><a href=/c>Other page</a></li><li><a href=/d>Third page</a></li></ul>"
        got = model.extract(f"{start}</article><section {mark}>{inner}</section></body>")
        assert got == f"A trial\n\n{first} {second}", mark
    assert hm.marks_of({"class": "relatedPosts x"})[1] and not hm.marks_of({"class": "related-work headline"})[1]
