"""Main text of web pages by a tree-structured graphical model over DOM nodes.

A page becomes a tree: block elements, and under them the text blocks (runs of inline
content). Every node has a hidden state, content or not. A node's features (tag, words in
class and id, length, share of link text, punctuation, depth, place) give its own potential, and each
parent-child pair has a potential by the child's sort. Sum-product message passing, once
upward and once downward, yields each node's exact marginal; text blocks that are content
with more than one half form the text, in page order.

The potentials are trained from labelled pages by gradient ascent on the log-likelihood, whose
gradient is the difference of observed and expected counts, from the same messages. Labelled
pages are generated from varied templates (:func:`labelled_pages`); pages of the own corpus
that mark their article can be added. A page is one row, held by one task at a time.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tickforge.llm.bpe import small_batches
from tickforge.llm.common import python_map
from tickforge.llm.training import Adam

#: Fixed values of HTML: elements without end tag, inline elements, elements that hold no text.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
             "strong sub sup time tt u var br wbr img math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded "
             "mphantom mfenced menclose msub msup msubsup munder mover munderover mmultiscripts mtable mtr mtd maction "
             "semantics".split())
SILENT = set("script style noscript template svg annotation annotation-xml iframe object canvas audio video select "
             "datalist optgroup option textarea button title".split())
#: Silent elements whose content is plain text up to their own end tag.
RAW = set("script style textarea title iframe".split())
SECTIONS = set("article main section nav header footer aside h1 h2 h3 h4 h5 h6 body".split())
BLOCKS = SECTIONS | set("address blockquote center dd details dialog dir div dl dt fieldset figcaption figure form hgroup "
                        "li menu ol p pre summary table tbody td tfoot th thead tr ul".split())
#: Start tags that a silent element cannot hold: they show that its end tag was left out.
BREAKS = {"svg": BLOCKS, **dict.fromkeys("select datalist optgroup option button".split(), BLOCKS - {"div"}),
          **dict.fromkeys("object canvas audio video".split(), SECTIONS)}
_END = re.compile(rf"</({'|'.join(sorted(SILENT, key=len, reverse=True))})(?=[\s/>])", re.I)
#: Start tags that end an open element of the given kinds (only inside the nearest container).
ENDS = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
        "td": {"td", "th", "p"}, "th": {"td", "th", "p"}}
CONTAINERS = set("ul ol dl table tbody thead tfoot div section article main aside body html".split())
TAGS = ("article main section div nav header footer aside form ul ol li dl table tr td p blockquote pre figure "
        "h1 h2 h3 h4 body html").split()
TAG_AT = {t: i for i, t in enumerate(TAGS)}

#: Words of class and id names, in the singular. A name of several words (``related-posts``) says something
#: bad only if all its words are known, so ``related-work`` and ``side-effects`` say nothing.
GOOD = set("article content main post entry story body text prose page".split())
BAD = set("nav navbar navigation topnav menu side sidebar foot footer head header masthead ad advert advertisement advertising promo "
          "promotion banner sponsor sponsored cookie notice consent alert share sharing social related recommend recommended "
          "recommendation subscribe subscription newsletter form login signup crumb breadcrumb copyright legal popup modal widget "
          "toolbar".split())
TALK = set("comment commenter reply replies disqus".split())
#: Of comments only if something inside is marked as one.
MAYBE_TALK = set("discussion response respond reader".split())
NEUTRAL = GOOD | set("site top bottom left right box list item link wrap wrapper container section block area bar panel col column "
                     "row inner outer primary secondary global user sign up more also you may like read button btn icon title "
                     "heading search new group region".split())
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[^\W\d_]+")


def marks_of(attrs: dict) -> tuple[bool, bool, bool, bool]:
    """What the class, id and role names of an element say: good, bad, of comments, perhaps of comments."""
    good = bad = talk = maybe = False
    for name in f"{attrs.get('class') or ''} {attrs.get('id') or ''} {attrs.get('role') or ''}".split():
        words = [w[:-1] if len(w) > 3 and w.endswith("s") and w[:-1] in BAD | TALK | MAYBE_TALK | NEUTRAL or w == "ads" else w
                 for w in map(str.lower, _WORDS.findall(name))]
        known = all(w in BAD or w in TALK or w in MAYBE_TALK or w in NEUTRAL or len(w) < 3 for w in words)
        good |= any(w in GOOD for w in words)
        bad |= known and any(w in BAD for w in words)
        talk |= known and any(w in TALK for w in words)
        maybe |= known and any(w in MAYBE_TALK for w in words)
    return good, bad, talk, maybe


_N_TAG = len(TAGS) + 1
N_FEATURES = _N_TAG + 15
SORTS = 3  # of a child: element of known meaning, plain element, text block


class Tree(HTMLParser):
    """Nodes in page order, parents before children: parent, tag, attributes, text blocks.

    A silent element without an end tag ends with its parent, or at a start tag that it cannot hold (at any
    block if no end tag of its kind is left in the page). Tags of ``head`` say nothing: all that may stand
    in a head is silent or void.
    """

    def __init__(self, ends: Counter | None = None):
        super().__init__(convert_charrefs=True)
        self.parent, self.tag, self.attrs, self.text, self.linked = [], [], [], [], []
        self.open: list[tuple[str, int]] = []  # element name, its node (inline elements: -1)
        self.silent: list[str] = []  # the outermost open silent element and what is open inside it
        self.ends = Counter() if ends is None else ends  # end tags of silent elements that are still to come
        self.block = -1  # text block that is being filled
        self.in_link = 0
        self._node(-1, "html", {})
        self.open.append(("html", 0))

    def _node(self, parent: int, tag: str, attrs: dict) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.attrs.append(attrs)
        self.text.append([])
        self.linked.append(0)
        return len(self.parent) - 1

    def _top(self) -> int:
        for _, node in reversed(self.open):
            if node >= 0:
                return node
        return 0

    def handle_starttag(self, tag, attrs):
        if self.silent:
            if self.silent[-1] in RAW:
                return
            if tag in ("option", "optgroup") and self.silent[-1] == "option":
                self.silent.pop()
            if self._breaks(tag):
                self.silent.clear()
        if self.silent or tag in SILENT:
            if tag not in VOID:
                self.silent.append(tag)
            return
        if tag == "head":
            return
        if tag in INLINE or tag in VOID:
            if tag in ("br", "hr") and self.block >= 0:
                self.text[self.block].append(" ")
            if tag not in VOID:
                self.open.append((tag, -1))
                self.in_link += tag == "a"
            return
        attrs = dict(attrs)
        if tag in ("html", "body") and any(t == tag for t, _ in self.open):
            self.attrs[0] |= attrs if tag == "html" else {}
            return
        ends = ENDS.get(tag, {"p"})
        for k in range(len(self.open) - 1, 0, -1):
            name, node = self.open[k]
            if name in ends:
                self._close_to(k)
                break
            if name in CONTAINERS:
                break
        self.block = -1
        self.open.append((tag, self._node(self._top(), tag, attrs)))

    def _breaks(self, tag: str) -> bool:
        """Does the start tag end the open silent element?"""
        if not self.silent or {"foreignobject", "template"} & set(self.silent):
            return False
        outer = self.silent[0]
        return tag in (BREAKS.get(outer, ()) if self.ends[outer] > 0 else BLOCKS)

    def _close_to(self, k: int) -> None:
        """Close the open elements from place ``k`` on; open inline elements end with their block."""
        for name, node in self.open[k:]:
            self.in_link -= name == "a" and node < 0
            if node >= 0:
                self.block = -1
        del self.open[k:]

    def handle_endtag(self, tag):
        if tag in SILENT:
            self.ends[tag] -= 1
        if self.silent:
            if self.silent[-1] in RAW and tag != self.silent[-1]:
                return
            if tag in self.silent:
                while self.silent.pop() != tag:
                    pass
                return
            if "template" in self.silent:
                return
        if tag in ("html", "body", "head"):
            return
        for k in range(len(self.open) - 1, 0, -1):
            name, node = self.open[k]
            if name == tag:
                self.silent.clear()  # ends with its parent
                self._close_to(k)
                return
            if tag in INLINE and node >= 0:
                return  # an end tag of inline kind never closes a block

    def handle_startendtag(self, tag, attrs):
        if tag not in SILENT:
            self.handle_starttag(tag, attrs)
            if tag not in VOID:
                self.handle_endtag(tag)

    def handle_data(self, data):
        if self.silent:
            return
        if self.block < 0:
            if not data.strip():
                return
            self.block = self._node(self._top(), "#text", {})
        self.text[self.block].append(data)
        if self.in_link:
            self.linked[self.block] += len(data)


def parse(html: str) -> tuple[list[int], list[str], list[dict], list[str], list[float]]:
    """Parents, tags, attributes, texts (white space as single spaces) and shares of link text."""
    t = Tree(Counter(x.lower() for x in _END.findall(html)))
    t.feed(html)
    t.close()
    texts = [" ".join("".join(x).split()) for x in t.text]
    share = [min(1.0, k / max(1, len(s))) for k, s in zip(t.linked, texts)]
    return t.parent, t.tag, t.attrs, texts, share


def features(parent, tag, attrs, texts, share) -> tuple[np.ndarray, np.ndarray, list[bool]]:
    """Feature rows, sorts of the nodes (as children) and which nodes are text blocks."""
    n = len(parent)
    f = np.zeros((n, N_FEATURES), dtype=np.float64)
    sort = np.zeros(n, dtype=np.int64)
    leaf = [t == "#text" for t in tag]
    total = sum(map(len, texts)) or 1
    size, linked, kids = [0] * n, [0.0] * n, [0] * n
    marks = [(False,) * 4 if leaf[v] else marks_of(attrs[v]) for v in range(n)]
    talk = [m[2] for m in marks]  # of comments, or around them
    for v in range(n - 1, -1, -1):
        if leaf[v]:
            size[v], linked[v] = len(texts[v]), share[v] * len(texts[v])
        if parent[v] >= 0:
            talk[parent[v]] |= talk[v]
        if parent[v] >= 0:
            size[parent[v]] += size[v]
            linked[parent[v]] += linked[v]
            kids[parent[v]] += 1
    before = 0
    for v in range(n):
        x = f[v]
        good, bad, comments, maybe = marks[v]
        if leaf[v]:
            sort[v] = 2
            s = texts[v]
            words = s.count(" ") + 1
            x[_N_TAG] = 1
            x[_N_TAG + 1] = min(1.0, math.log1p(len(s)) / 7)
            x[_N_TAG + 2] = len(s) < 25
            x[_N_TAG + 3] = share[v]
            x[_N_TAG + 4] = s[-1:] in ".!?:;\"'”»…"
            x[_N_TAG + 5] = min(1.0, 10 * (s.count(",") + s.count(".")) / words)
            x[_N_TAG + 6] = "©" in s or "copyright" in s.lower()
            x[_N_TAG + 14] = len(s) / total
            before += len(s)
        else:
            at = TAG_AT.get(tag[v], _N_TAG - 1)
            sort[v] = 0 if tag[v] in ("article", "main", "nav", "header", "footer", "aside", "form") else 1
            x[at] = 1
            x[_N_TAG + 3] = linked[v] / max(1, size[v])
            x[_N_TAG + 7] = good
            x[_N_TAG + 8] = bad
            x[_N_TAG + 9] = comments or maybe and talk[v]
            x[_N_TAG + 10] = size[v] / total
            x[_N_TAG + 11] = size[v] < 40
            if x[_N_TAG + 8] or x[_N_TAG + 9]:
                sort[v] = 0
        x[_N_TAG + 12] = before / total
        x[_N_TAG + 13] = 1
    return f, sort, leaf


class TreeModel:
    """Potentials: ``w`` weighs a node's features for content, ``pair[sort, parent, child]`` its edge."""

    def __init__(self, w: np.ndarray, pair: np.ndarray):
        self.w, self.pair = w, pair

    def marginals(self, parent: list[int], f: np.ndarray, sort: np.ndarray):
        """Marginal of content of every node, pair marginals of every node with its parent, log Z."""
        n = len(parent)
        own = [(0.0, u) for u in (f @ self.w).tolist()]
        pair, sorts = self.pair.tolist(), sort.tolist()
        up = [list(x) for x in own]                 # log messages gathered at a node
        sent: list[tuple[float, float]] = [(0.0, 0.0)] * n
        for v in range(n - 1, 0, -1):               # upward
            p, (a, b), u = pair[sorts[v]], up[v], up[parent[v]]
            m0, m1 = _lse(p[0][0] + a, p[0][1] + b), _lse(p[1][0] + a, p[1][1] + b)
            sent[v] = (m0, m1)
            u[0] += m0
            u[1] += m1
        log_z = _lse(*up[0])
        full = [list(x) for x in up]                # downward: adds what comes from the parent
        content, edges = [0.0] * n, [None] * n
        content[0] = math.exp(full[0][1] - log_z)
        for v in range(1, n):
            p, q, s, (a, b) = pair[sorts[v]], full[parent[v]], sent[v], up[v]
            out0, out1 = q[0] - s[0], q[1] - s[1]   # parent without this child
            d0, d1 = _lse(out0 + p[0][0], out1 + p[1][0]), _lse(out0 + p[0][1], out1 + p[1][1])
            full[v] = [a + d0, b + d1]
            content[v] = math.exp(full[v][1] - log_z)
            edges[v] = ((out0 + p[0][0] + a - log_z, out0 + p[0][1] + b - log_z),
                        (out1 + p[1][0] + a - log_z, out1 + p[1][1] + b - log_z))
        return content, edges, log_z

    def extract(self, html: str | None) -> str:
        """Content blocks of a whole page, joined by empty lines; empty for a null page."""
        if not html:
            return ""
        parent, tag, attrs, texts, share = parse(html)
        f, sort, leaf = features(parent, tag, attrs, texts, share)
        content, _, _ = self.marginals(parent, f, sort)
        return "\n\n".join(t for t, is_text, p in zip(texts, leaf, content) if is_text and t and p > 0.5)


def _lse(a: float, b: float) -> float:
    return a + math.log1p(math.exp(b - a)) if a > b else b + math.log1p(math.exp(a - b))


def states(html: str, content: str = "data-content", other: str = "data-other"):
    """Tree and observed states of a labelled page: a node is content if, of itself and its ancestors,
    the nearest that carries one of the two attributes carries ``content``."""
    parent, tag, attrs, texts, share = parse(html)
    y: list[int] = []
    for v, p in enumerate(parent):
        y.append(1 if content in attrs[v] else 0 if other in attrs[v] else y[p] if p >= 0 else 0)
    return parent, tag, attrs, texts, share, y


def train(pages: list[str], rounds: int = 90, rate: float = 0.8, seed: int = 11, blind: float = 0.25) -> TreeModel:
    """Maximum likelihood on labelled pages (see :func:`states`); reruns agree.

    In a part of the visits (``blind``) tags and attribute words of a page are hidden, so the
    other features and the edges learn to carry pages that mark nothing.
    """
    rng = random.Random(seed)
    trees = []
    for html in pages:
        parent, tag, attrs, texts, share, y = states(html)
        f, sort, _ = features(parent, tag, attrs, texts, share)
        trees.append((parent, f, sort, np.array(y)))
        if rng.random() < blind:
            g, plain = f.copy(), sort.copy()
            plain[plain == 0] = 1
            hide = [TAG_AT[t] for t in ("article", "main", "nav", "header", "footer", "aside", "form", "section")]
            g[:, TAG_AT["div"]] = np.maximum(g[:, TAG_AT["div"]], g[:, hide].max(axis=1))
            g[:, hide] = 0
            g[:, _N_TAG + 7:_N_TAG + 10] = 0
            trees.append((parent, g, plain, np.array(y)))
    model = TreeModel(np.zeros(N_FEATURES), np.zeros((SORTS, 2, 2)))
    params = {"w": model.w, "pair": model.pair}
    adam = Adam(params, rate)
    for step in range(rounds):
        gw, gp, n = np.zeros(N_FEATURES), np.zeros((SORTS, 2, 2)), 0
        for parent, f, sort, y in trees:
            content, edges, _ = model.marginals(parent, f, sort)
            gw += f.T @ (y - np.array(content))
            par = np.array(parent[1:])
            np.add.at(gp, (sort[1:], y[par], y[1:]), 1)
            e = np.exp(np.array(edges[1:])) if len(parent) > 1 else np.zeros((0, 2, 2))
            for k in range(SORTS):
                gp[k] -= e[sort[1:] == k].sum(axis=0)
            n += len(parent)
        # The optimiser goes downhill: the negative log-likelihood with a little shrinkage.
        adam.update({"w": 1e-4 * model.w - gw / n, "pair": 1e-4 * model.pair - gp / n}, 1.0 - 0.8 * step / rounds)
    return model


def labelled_pages(n: int = 180, seed: int = 2) -> list[str]:
    """Pages from varied templates whose parts carry ``data-content`` or ``data-other``.

    Words are made of random syllables, so nothing depends on a language; the templates differ in
    elements, attribute words, order, nesting and in closing their elements.
    """
    rng = random.Random(seed)

    def word() -> str:
        return "".join(rng.choice(["ta", "re", "on", "li", "sha", "er", "ing", "mo", "é", "ku", "st"])
                       for _ in range(rng.randint(1, 4)))

    def words(a: int, b: int) -> str:
        return " ".join(word() for _ in range(rng.randint(a, b)))

    def sentence() -> str:
        s = words(4, 18)
        tail = rng.choice([".", ".", ".", "!", "?", "", "***", " |"])
        return s[:1].upper() + s[1:] + (", " + words(2, 6) if rng.random() < 0.4 else "") + tail

    def prose(a: int = 1, b: int = 7) -> str:
        if rng.random() < 0.12:  # poor text is text of the page all the same
            return rng.choice([" ".join([word()] * rng.randint(5, 80)), words(20, 120), " | ".join(words(1, 2) for _ in range(20)),
                               words(10, 40).upper(), "© " + sentence(), words(1, 3)])
        s = " ".join(sentence() for _ in range(rng.randint(a, b)))
        r = rng.random()
        if r < 0.15:
            return f"<b>{s}<br>"
        if r < 0.3:
            return s + f' <a href="/{word()}">{words(1, 3)}</a> ' + sentence()
        return s + ("<em>" + words(1, 2) + "</em>." if r < 0.4 else "")

    def links(n_: int) -> str:
        sep = rng.choice(["li", "li", "span", "div"])
        items = "".join(f'<{sep}><a href="/{word()}">{words(1, 3)}</a></{sep}>' for _ in range(n_))
        return f"<ul>{items}</ul>" if sep == "li" else items

    def part(kind: str) -> str:
        no = "data-other=1"
        short = rng.choice([sentence, lambda: prose(1, 2), lambda: words(2, 6)])
        names = {"menu": ["menu", "navbar", "top-nav", "main-menu"], "side": ["sidebar", "side", "widget"],
                 "ad": ["ad", "ads", "advert", "banner", "sponsored", "promo"],
                 "notice": ["cookie-notice", "notice", "consent", "alert"], "foot": ["footer", "site-footer", "legal"],
                 "head": ["header", "masthead", "site-header"], "talk": ["comments", "comment-list", "discussion", "replies"],
                 "form": ["newsletter", "subscribe", "search-form", "login"], "share": ["share", "social", "related"]}
        mark = f'{rng.choice(["class", "class", "id"])}="{rng.choice(names[kind])}"'
        if kind == "menu":
            tag = rng.choice(["nav", "nav", "div", "ul"])
            return f"<{tag} {mark if tag != 'nav' or rng.random() < .3 else ''} {no}>{links(rng.randint(3, 9))}</{tag}>"
        if kind == "side":
            tag = rng.choice(["aside", "aside", "div"])
            inner = rng.choice([lambda: f"<h3>{words(1, 3)}</h3>{links(4)}", lambda: f"<p>{prose(1, 3)}</p>", lambda: short()])()
            return f"<{tag} {mark if tag == 'div' else ''} {no}>{inner}</{tag}>"
        if kind == "ad":
            return f"<div {mark} {no}>{rng.choice([short(), '<p>' + short() + '</p>'])}</div>"
        if kind == "notice":
            tag = rng.choice(["div", "section", "p"])
            return f"<{tag} {mark} {no}>{short()} <button>{word()}</button></{tag}>"
        if kind == "foot":
            tag = rng.choice(["footer", "footer", "div"])
            return f"<{tag} {mark if tag == 'div' else ''} {no}>{rng.choice(['&copy; ', '', 'Copyright '])}{short()}</{tag}>"
        if kind == "head":
            tag = rng.choice(["header", "header", "div"])
            return f"<{tag} {mark if tag == 'div' else ''} {no}>{rng.choice([words(1, 4), '<h2>' + words(1, 4) + '</h2>' + short()])}</{tag}>"
        if kind == "talk":
            tag = rng.choice(["section", "div", "ol"])
            inner = "".join(f'<div class="comment"><span>{word()}</span><p>{prose(1, 3)}</p></div>'
                            for _ in range(rng.randint(1, 4)))
            return f"<{tag} {mark} {no}>{'<h3>' + words(1, 2) + '</h3>' if rng.random() < .5 else ''}{inner}</{tag}>"
        if kind == "form":
            return f"<form {mark if rng.random() < .6 else ''} {no}><label>{words(1, 4)}</label><input name=q>" \
                   f"{rng.choice(['', '<p>' + short() + '</p>'])}<button>{word()}</button></form>"
        return f"<div {mark} {no}>{rng.choice([links(3), short()])}</div>"

    pages = []
    for _ in range(n):
        article = [f"<h1>{words(2, 9)}</h1>"] if rng.random() < 0.8 else []
        brief = rng.random() < 0.3
        for _ in range(1 if brief else rng.randint(1, 12)):
            r = rng.random() * (0.7 if brief else 1)
            end = "</p>" if rng.random() < 0.8 else ""
            article.append(
                f"<p>{prose(1, 1 if brief else 7)}{end}" if r < 0.75 else f"<h2>{words(1, 6)}</h2>" if r < 0.82
                else f"<ul>{''.join('<li>' + sentence() + '</li>' for _ in range(3))}</ul>" if r < 0.88
                else f"<blockquote><p>{prose(1, 3)}</p></blockquote>" if r < 0.93
                else f"<table><tr><td>{words(1, 3)}</td><td>{words(1, 4)}</td></tr></table>" if r < 0.96
                else f"<div>{prose()}</div>")
        if rng.random() < 0.2:  # parts of the article whose names sound like something else
            name = rng.choice(["related-work", "discussion", "side-effects", "sharing-economy", "social-history", "legal-history",
                               "reader-response", "header-files", "notice-periods", "comment-on-method", "response"])
            article.append(f'<section {rng.choice(["class", "id"])}="{name}"><h2>{words(1, 4)}</h2>'
                           + "".join(f"<p>{prose(1, 4)}</p>" for _ in range(rng.randint(1, 4))) + "</section>")
        for kind in ("ad", "share", "form", "notice", "side"):
            if rng.random() < 0.12:
                article.insert(rng.randint(1, len(article)), part(kind))
        if rng.random() < 0.2:
            article.append(part("talk"))
        r = rng.random()
        open_ = "<article data-content=1>" if r < 0.55 else "<main data-content=1>" if r < 0.7 else \
            f'<div class="{rng.choice(["content", "post-body", "entry-content", "story", "article-text"])}" data-content=1>' \
            if r < 0.9 else "<div data-content=1>"
        if rng.random() < 0.1:  # the article's parts lie in the body
            open_ = "<"
            article = [x if "data-other" in x.split(">")[0] else re.sub(r"^<(\w+)", r"<\1 data-content=1", x)
                       for x in article]
        body = "".join(article) if open_ == "<" else open_ + "".join(article) + "</" + open_[1:].split()[0].rstrip(">") + ">"
        if rng.random() < 0.25:
            body = rng.choice(["<div>", '<div id="wrapper">', "<main>"]) + body + "</div>"
        front = [part(k) for k in ("head", "menu", "ad", "notice", "form") if rng.random() < 0.55]
        rear = [part(k) for k in ("side", "share", "talk", "ad", "form", "foot") if rng.random() < 0.45]
        if rng.random() < 0.15:
            front, rear = [], []
        rng.shuffle(front)
        pages.append(f"<!DOCTYPE html><html><head><title>{words(1, 5)}</title></head><body>"
                     + "".join(front) + body + "".join(rear) + "</body></html>")
    for _ in range(n // 6):  # nothing but a short text
        bare = [f"<h1 data-content=1>{words(1, 5)}</h1>"] if rng.random() < 0.3 else []
        tag = rng.choice(["p", "p", "p", "div", "blockquote"])
        bare += [f"<{tag} data-content=1>{rng.choice([sentence(), sentence(), words(1, 4), prose(1, 2)])}</{tag}>" for _ in range(rng.choice([1, 1, 1, 2, 3]))]
        whole = "".join(bare)
        if rng.random() < 0.3:
            whole = f"<div data-content=1>{whole}</div>"
        pages.append(rng.choice([f"<body>{whole}</body>", f"<html><head><title>{words(1, 3)}</title></head><body>{whole}</body></html>", whole]))
    return pages


_MODELS: dict[tuple, TreeModel] = {}


def default_model() -> TreeModel:
    """The model trained from :func:`labelled_pages`, trained once a process."""
    if () not in _MODELS:
        _MODELS[()] = train(labelled_pages())
    return _MODELS[()]


def main_text(pages: DataFrame, model: TreeModel | None = None, html: str = "html", out: str = "text",
              max_bytes: int = 4_000_000) -> DataFrame:
    """Add the main text (``out``) of every whole page; all columns pass through, one that is called ``out`` already is replaced.

    A null or empty page, and a page without content, give an empty text. Broken markup is read as far as
    HTML's rules of implied ends go; nothing is shuffled.
    """
    pages = pages.drop(out)
    model = model or default_model()
    at = pages.columns.index(html)
    schema = T.StructType([*pages.schema.fields, T.StructField(out, T.StringType())])

    def run(batches):
        for b in small_batches(batches, at, max_bytes):
            texts = [model.extract(h) for h in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*b.schema.names, out])

    return python_map(pages, run, schema)
