import html
import json
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tamarack.llm.katz import RESERVE, SMALL, discounts, katz_scores
from tamarack.llm.toxicity import Matcher, folded_words, labelled, train_toxicity
from tamarack.llm.wrapper import extract, extract_pages, induce_wrappers, merge, parse, tree_of
from tests.llm.conftest import ODD


class BruteKatz:
    def __init__(self, texts):
        self.c1, self.c2, self.docs = Counter(), Counter(), len(texts)
        for t in texts:
            w = self.tokens(t)
            self.c1.update(w)
            self.c2.update(zip([1, *w[:-1]], w))
        many = [Counter(c.values()) for c in (self.c1, self.c2)]
        self.d1, self.d2 = (discounts([m[r] for r in range(1, SMALL + 2)]) for m in many)
        self.total = sum(self.c1.values())
        kept = sum(self.cut(self.d1, c) for c in self.c1.values())
        free = max(self.total - kept, 0.5)
        self.unknown = free / (self.total + 0.5)
        self.scale = (1 - self.unknown) / kept
        self.left, self.seen = defaultdict(lambda: RESERVE), defaultdict(float)
        self.size = defaultdict(lambda: RESERVE)
        for (h, w), c in self.c2.items():
            self.size[h] += c
            self.left[h] += c - self.cut(self.d2, c)
            self.seen[h] += self.p1(w)

    @staticmethod
    def tokens(text):
        return [*(text or "").encode().lower().split(), 0]

    @staticmethod
    def cut(d, c):
        return c * d[c - 1] if c <= SMALL else float(c)

    def p1(self, w):
        return self.scale * self.cut(self.d1, self.c1[w]) if self.c1[w] else self.unknown

    def p2(self, h, w):
        if c := self.c2[h, w]:
            return self.cut(self.d2, c) / self.size[h]
        return self.p1(w) * (self.left[h] / self.size[h] / (1 - self.seen[h]) if h in self.seen else 1.0)


def test_katz_equals_brute_force_and_sums_to_one(spark, docs_of):
    rng = random.Random(8)
    rows = [(k, " ".join(f"W{int(rng.paretovariate(0.7))}" for _ in range(rng.choice([3, 40, 200])))) for k in range(200)] + ODD
    docs = docs_of(rows).withColumn("held_out", F.col("doc_id") % 5 == 0)
    got = katz_scores(docs).collect()
    model = BruteKatz([t for i, t in rows if i is None or i % 5])
    for h in [1, b"w1", b"w2", b"w7"]:
        assert sum(model.p2(h, w) for w in [*model.c1, "unknown"]) == pytest.approx(1.0, abs=1e-9)
    want = Counter()
    for i, t in rows:
        w = model.tokens(t)
        base = sum(math.log10((model.c1[x] + 1) / (model.total + len(model.c1) + 1)) for x in w)
        score = sum(math.log10(model.p2(h, x)) for h, x in zip([1, *w[:-1]], w))
        want[i, bool(i is not None and i % 5 == 0), len(w), sum(model.c1[x] > 0 for x in w), model.total, round(base, 5), round(score, 5)] += 1
    assert Counter((*r[:5], round(r[5], 5), round(r[6], 5)) for r in got) == want
    assert katz_scores(docs.limit(0)).count() == 0
    alone = katz_scores(docs.where("doc_id = 4").withColumn("held_out", F.lit(True))).first()
    assert (alone["n_known"], alone["train_tokens"], alone["score"]) == (0, 0, 0.0)


def test_folding():
    assert folded_words("1D10T іdіоt $tup1d a$$ @b don't_x") == ["idiot", "idiot", "stupid", "ass", "b", "don", "t", "x"] or folded_words("1D10T іdіоt") == ["idiot", "idiot"]
    assert folded_words(None) == folded_words("") == []


def test_exception_phrases_and_longest_terms():
    m = Matcher({"trash ": 2.0, "idio": 1.0, "idiot ": 3.0}, ["trash can"])
    assert m.raw("the trash can".split()) == 0.0
    assert m.raw("the trash cans".split()) == 2.0
    assert m.raw("idiot idiocy".split()) == 4.0
    assert Matcher({}, []).raw(["x"]) == 0.0


def test_toxicity_learns_and_ignores_odd_rows(spark, docs_of):
    rng = random.Random(9)
    word = lambda: f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('klmn')}{rng.randrange(30)}"
    rows, labels = [], []
    for k in range(1200):
        words = [word() for _ in range(40)]
        toxic = k % 6 == 0
        if toxic:
            words[5], words[20] = rng.choice(["grobian", "gr0bian", "grоbian"]), rng.choice(["lump", "LUMP!!"])
        rows.append((k, " ".join(words)))
        labels.append((k, 0, int(toxic)))
    docs = docs_of(rows + [(None, None), (5000, ""), (5001, None)])
    table = spark.createDataFrame(labels + [(None, 1, 1)], "doc_id long, quality int, toxic int")
    got = train_toxicity(labelled(docs, table)).score(docs).collect()
    assert len(got) == len(rows) + 3 and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 1200 and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert all((r["score"] >= 0.3) == (r["doc_id"] % 6 == 0) for r in held)
    for few in (table.limit(0), table.where("toxic = 0")):
        assert max(r["score"] for r in train_toxicity(labelled(docs, few)).score(docs).collect()) < 0.3
    assert train_toxicity(labelled(docs, table)).score(docs.limit(0)).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T {n}</title><style>p{{x}}</style><script>var t="</p><article>";</script></head><body>
<header><a href="/">Home {n}</a></header><nav><ul><li>a{n}<li>b</ul></nav><div class="cookie-notice">We use {n}</div><div class="ad top">buy {n}</div>
<article class="post-4"><h1>Head &amp; {n}</h1><p><b>First {n}.<br><p>Second&nbsp; &lt;{n}&gt;
 line</p><ul><li>one <i>{n}</i><li>two</ul><form>mail <input></form><aside>related {n}</aside><div class="share-box">Share this</div>
<div>Printed by the office</div><p>Third &am {n}</p></article><section id="comments"><p>Nice {n}</p></section><aside>side {n}</aside><footer>&copy; {n}</footer>"""


def test_wrappers_find_the_article(spark):
    pages = [(n, f"http://h{n % 2}.org/{n}", PAGE.format(n=f"n{n}" + "x" * n)) for n in range(40)]
    pages += [(100, "http://h0.org/", None), (101, None, ""), (102, None, "plain &amp; bare"), (103, "http://h9.org/", "<p>lone<p>page"), (5, "http://h1.org/5", PAGE.format(n="n5xxxxx"))]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("text", F.lit(0))
    got = [(r["page_id"], r["text"]) for r in extract_pages(frame).collect()]
    assert len(got) == len(pages)
    for i, text in got:
        n = f"n{i}" + "x" * i
        want = {100: "", 101: "", 102: "plain & bare", 103: "lone\npage"}.get(i, f"Head & {n}\nFirst {n}.\nSecond <{n}> line\none {n}\ntwo\nThird &am {n}")
        assert text == want
    assert extract_pages(frame.limit(0)).count() == 0


def test_varying_text_without_an_article_element(spark):
    page = "<html><body><div class='top'><a href='/'>Site</a></div><div id='c'><p>{a}</p><p>{b}</p></div><div class='legal'>All rights kept</div></body></html>"
    pages = [(n, "http://x.org/", page.format(a=f"alpha {n} " * 9, b=f"beta {n} " * 9)) for n in range(12)]
    got = {r["page_id"]: r["text"] for r in extract_pages(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert all(got[n] == f"{('alpha %d ' % n * 9).strip()}\n{('beta %d ' % n * 9).strip()}" for n in range(12))


def test_parsing_deep_and_broken_pages():
    assert extract("<div>" * 5000 + "deep" + "</div>" * 10, None) == "deep"
    assert extract("<p>a<!-- x > y --><p title='>'>b</p></p></div><table><tr><td>c<td>d<tr><td>e</table>", None) == "a\nb\nc d\ne"
    assert extract("<script>x", None) == "" and extract("a < b & c", None) == html.unescape("a < b & c")
    trees = [tree_of(parse(f"<div><p>{t}</p></div>")) for t in "xxy"]
    merged = merge(merge(trees[0], trees[1]), trees[2])
    assert json.loads(json.dumps(merged)) == merged and re.search("true", json.dumps(merged))


def texts_of(spark, pages):
    """Texts of pages of one host."""
    frame = spark.createDataFrame([(k, "http://h.org/", p) for k, p in enumerate(pages)], "page_id long, url string, html string")
    return [r["text"] for r in extract_pages(frame).orderBy("page_id").collect()]


def test_hint_words_do_not_hide_the_content(spark):
    for outer in (
        "<body class='page right-sidebar'><div class='x'>{}</div>", "<body class='no-sidebar sidebar'><article class='post comments-open comments'>{}</article>",
        "<body><div id='content' class='has-banner'>{}</div>", "<body><div class='banner'>{}</div>",
    ):
        inner = "<p>Long enough {0} text {0} of the page</p><div class='ad'>Buy {0}</div><div class='share-box'>Share {0}</div>"
        got = texts_of(spark, [outer.format(inner.format(f"w{n}")) + f"<div class='comments'>Nice {n}</div>" for n in range(3)])
        assert got == [f"Long enough w{n} text w{n} of the page" for n in range(3)], outer


def test_all_varying_parts_are_content(spark):
    body = "<p>Body {0} of the page, by far the longest of its parts, {0} and {0} again and again</p>" * 3
    page = "<div class='top'><a href='/'>Site</a></div><div class='page'><div class='head'>Head {0}</div><div class='body'>" + body + "</div><div class='last'>End {0}</div></div>"
    texts = texts_of(spark, [page.format(f"w{n}") for n in range(3)] + [page.format("v") + "<div class='extra'>Only here</div>"])
    assert all(t.startswith(f"Head w{n}\nBody w{n}") and t.endswith(f"again\nEnd w{n}") for n, t in enumerate(texts[:3]))
    assert texts[3].endswith("End v\nOnly here") and "Site" not in "".join(texts)
    page = "<div><article class='post'>One {0}</article><article class='post featured'>Two {0}</article><div>no</div></div>"
    assert texts_of(spark, [page.format(n) for n in range(3)]) == [f"One {n}\nTwo {n}" for n in range(3)]


def test_end_tags_below_the_kept_depth():
    nest = "<div>" * 70 + "<p>in</p><nav>menu <b>x</b></nav><div class='ad'>buy</div>on<div><p>low</div>after" + "</div>" * 70
    page = "<div id='page'><article><p>first</p>" + nest + "<p>last</p></article><div>outside</div></div>"
    assert extract(page, None) == "first\nin\non\nlow\nafter\nlast"
    assert extract("<article>" + "<span>" * 70 + "a<p>b<p>c</span>d" + "</span>" * 69 + "<p>e</article><p>f", None) == "a\nb\nc\nd\ne"
    assert extract("<div>" * 70 + "<div class='banner'><p>all</p>the <nav>no</nav>text</div>" + "</div>" * 70, None) == "all\nthe\ntext"


def test_constant_elements_of_any_tag_are_template(spark):
    page = (
        "<article><h1>Head {0}</h1><p>Text {0} of this page, which is longer than all that the pages share</p><p>More {0}, and more {0}, and more</p>"
        "<p>Licence</p><ul><li>read<li>more</ul><ul><li>own {0}<li>same</ul><blockquote>Quote</blockquote></article>"
    )
    want = "Head {0}\nText {0} of this page, which is longer than all that the pages share\nMore {0}, and more {0}, and more\nown {0}\nsame"
    for count in (2, 9):
        assert texts_of(spark, [page.format(f"w{n}") for n in range(count)]) == [want.format(f"w{n}") for n in range(count)]
    kept = texts_of(spark, [page.format("w")] * 3)
    assert kept[0] == kept[2] and "Licence" in kept[0]
    near = texts_of(spark, [f"<article><p>The same article under two addresses</p><p>{n}</p></article>" for n in range(2)])
    assert near == [f"The same article under two addresses\n{n}" for n in range(2)]


def test_copies_of_an_article_keep_it(spark):
    body = "<h1>Head</h1><p>The same article stands under many addresses of the host</p><p>And it goes on for a while</p>"
    want = "Head\nThe same article stands under many addresses of the host\nAnd it goes on for a while"
    for count in (2, 10):
        page = f"<article>{body}</article><div class='count'>viewed {{0}} times</div>"
        assert texts_of(spark, [page.format(n) for n in range(count)]) == [want] * count
        page = f"<article>{body}<p>viewed {{0}} times</p></article>"
        assert texts_of(spark, [page.format(n) for n in range(count)]) == [f"{want}\nviewed {n} times" for n in range(count)]
    own = "<div class='body'><p>Own text {0} of page {0}, which no other page has, {0}</p></div>"
    quote = "<div class='body'><blockquote>The quote that two copies hold</blockquote><p>copied</p></div><p>seen {0}</p>"
    texts = texts_of(spark, [own.format(n) for n in range(8)] + [quote.format(n) for n in (1, 2)])
    assert all("The quote that two copies hold" in t for t in texts[8:])


def test_headings_and_the_last_content_of_a_page_stay(spark):
    page = "<article><h2>Introduction</h2><p>Start {0} of the text {0}</p><h2>Conclusion</h2><p>End {0} of the text {0}</p><p>Licence</p></article>"
    want = "Introduction\nStart {0} of the text {0}\nConclusion\nEnd {0} of the text {0}"
    bare = "<article><p>Licence</p></article>"
    texts = texts_of(spark, [page.format(f"w{n}") for n in range(9)] + [bare])
    assert texts == [want.format(f"w{n}") for n in range(9)] + ["Licence"]


def test_content_is_found_without_telling_names(spark):
    """Words and tags without meaning: the text of the nodes that a plain alignment finds to vary, and the same with article elements."""
    page = (
        "<html><body><{2} class='q'><div class='k1'>Site of the house</div><div class='k2'><a href='/'>One</a><a href='/x'>Two</a></div></{2}>"
        "<{1} class='k3'><div class='k4'>Title {0}</div><div class='k5'><p>Text {0} with words {0}</p><p>More {0} of it {0}</p></div></{1}>"
        "<div class='k6'>Imprint and rights</div></body></html>"
    )
    sources = [page.format(f"w{n}", "div", "div") for n in range(6)]

    def texts(node):
        return [t for i in node.items for t in ([" ".join(i.split())] if isinstance(i, str) else texts(i)) if t]

    rows = [texts(parse(p)) for p in sources]
    varying = [k for k, column in enumerate(zip(*rows, strict=True)) if len(set(column)) > 1]
    want = ["\n".join(r[k] for k in varying) for r in rows]
    assert texts_of(spark, sources) == want
    assert texts_of(spark, [page.format(f"w{n}", "article", "div") for n in range(6)]) == want
    teaser = "<article>Top</article>" + page  # an article element that holds hardly any of the text does not decide
    got = texts_of(spark, [teaser.format(f"w{n}", "div", "div") for n in range(6)])
    assert all(w in g and "Imprint" not in g for w, g in zip(want, got))


def test_long_pages_and_clashing_columns(spark):
    page = "<article><p>" + "long words " * 200_000 + "</p></article>"
    frame = spark.createDataFrame([(1, "http://h.org/", page), (2, None, None)], "page_id long, url string, html string")
    frame = frame.withColumns({"_host": F.lit("x"), "_wrapper": F.lit("y"), "host": F.lit("z")})
    got = {r["page_id"]: r for r in extract_pages(frame).collect()}
    assert got[1]["text"] == ("long words " * 200_000).strip() and got[2]["text"] == "" and got[1]["host"] == "z"


def test_words_of_one_page_only_do_not_split_slots(spark):
    names = ["".join(chr(97 + n // 26**k % 26) for k in range(3)) + "x" for n in range(60)]
    page = "<div class='{0} entry' id='post-{0}'><p>Text {0} of the page {0}</p><p class='{0}'>Licence of the house</p></div><div class='foot'>Kept</div>"
    pages = [page.format(w) for w in names]
    assert texts_of(spark, pages) == [f"Text {w} of the page {w}" for w in names]
    frame = spark.createDataFrame([("h", p) for p in pages], "host string, html string")
    words, tree = json.loads(induce_wrappers(frame).first()["wrapper"])
    assert sorted(words) == ["entry", "foot"] and len(json.dumps(tree)) < 1000


def test_many_rare_terms_do_not_end_the_training(spark):
    """420,000 words that stand in two toxic texts only: more than 400,000 candidates before."""
    words = [f"{a}{b}" for a in ("qa", "qe", "qi") for b in ("".join(chr(97 + n // 26**k % 26) for k in range(4)) for n in range(140_000))]
    rows = [(" ".join(words[i : i + 20_000]), 1, f) for i in range(0, len(words), 20_000) for f in (0, 1)]
    rows += [("plain text", 0, n % 3) for n in range(9 * len(rows))]
    model = train_toxicity(spark.createDataFrame(rows, "text string, toxic int, fold int"))
    assert "qaaaaa " not in model.lexicon and "plain " not in model.lexicon
