"""HTML extraction, quality, toxicity and the pipeline: plain versions, held-out accuracy, odd rows."""

import zlib
from collections import Counter

import numpy as np
import pytest

from millrace.llm import html, quality, toxicity
from millrace.llm.html import extract, main_text
from millrace.llm.quality import quality_scores
from millrace.llm.toxicity import toxicity_scores

ARTICLE = "<article><h1>Title  here</h1><p>First &amp; <b>bold</b>\n text.<br><p>Second &lt;p&gt;</article>"


@pytest.mark.parametrize("page, text", [
    ("", ""),
    ("plain  text &copy", "plain text ©"),
    (f"<html><body><nav><ul><li>Menu</ul></nav>{ARTICLE}<footer>foot</footer></body></html>", "Title here\n\nFirst & bold text.\n\nSecond <p>"),
    ("<script>var t='</p>'</script><style>p{}</style><p>a<p>b<script>x", "a\n\nb"),
    ("<div class='ad'><p>buy</p></div><div class='no-ad'><p>keep</p></div>", "keep"),
    ("<article><p>x <span class=ad>no <span>n</span> no</span> y<button>b</button></p><div id=comments><p>c</p></div></article>", "x y"),
    ("<article class='post'><header><h1>T</h1></header><p>t</p></article><article class=comment>c</article>", "T\n\nt"),
    ("<header><h1>Site</h1></header><main><p>m</p><form>f<p>g</form></main><aside>a</aside>", "m"),
    ("<p title='a > b'>quoted</p><!-- <p>no</p> --><p>yes 1 < 2", "quoted\n\nyes 1 < 2"),
    ("<p>cut <a href='x", "cut"),
    ("<p>cut &am", "cut &am"),
    ("<ul><li>one<li>two<ul><li>in</ul></ul><table><tr><td>a<td>b<tr><td>c</table>", "one\n\ntwo\n\nin\n\na b\n\nc"),
    ("<div>" * 3000 + "deep" + "</div>" * 3000 + "<p>after", "deep\n\nafter"),
    ("<div class='cookie-notice'>c</div><div role=navigation>n</div><p hidden>h</p><section><p>s</section>", "s"),
    ("<div class='article-header'><h1>T</h1></div><div class='site-header'>S</div><p>p", "T\n\np"),
    ("</p></div>stray</b><p>x</p", "stray\n\nx"),
])
def test_main_text(page, text):
    assert main_text(page, set()) == text


@pytest.mark.parametrize("tag, levels", [("div", 255), ("div", 300), ("section", 3000)])
def test_what_is_dropped_is_dropped_at_any_depth(tag, levels):
    inner = "<p>a <span class=ad>no <span>n</span> no</span> b</p><nav><div>no</div><p>no</nav><div class='ad'><div>no</div>no</div><form>no</form><ul><li class=ad>no<li>c</ul>"
    for end in ("", f"</{tag}>" * levels):
        assert main_text(f"<{tag}>" * levels + inner + end + "<p>d<aside>no</aside>", set()) == "a b\n\nc\n\nd"


def test_templates_of_a_host_go(spark):
    box = "<div><p>Call us now</p></div>"
    own = [(i, f"https://a.com/{i}", f"<body>{box}<div><p>page {i}</p></div></body>") for i in range(12)]
    copies = [(100 + i, "http://A.com/x", "<body><article><p>same</p><p>copy</p></article></body>") for i in range(9)]
    other = [(200, "http://b.org", f"<body>{box}</body>"), (201, None, box), (202, "http://b.org/e", None), (203, "no url", "")]
    frame = spark.createDataFrame([(*r, 1, "x") for r in own + copies + other + [other[0]]], "page_id int, url string, html string, n_chars int, hash string")
    got = sorted((r.page_id, r.text, r.n_chars) for r in extract(frame).collect())
    want = [(i, f"page {i}") for i in range(12)] + [(100 + i, "same\n\ncopy") for i in range(9)]
    want += [(200, "Call us now")] * 2 + [(201, "Call us now"), (202, ""), (203, "")]
    assert got == [(i, t, len(t)) for i, t in want]
    assert extract(frame.limit(0)).collect() == []


@pytest.mark.parametrize("article", [True, False])
def test_copies_of_a_page_are_no_template(spark, article):
    def page(i, body):
        body = f"<article>{body}</article>" if article else f"<div>{body}</div>"
        return i, f"https://a.com/{i}", f"<body><nav>{i}</nav>{'' if article else '<div><p>Call us</p></div>'}{body}</body>", 0

    copies = [page(i, "<h1>T</h1><p>same</p><p>copy</p>") for i in range(30)]
    own = [page(i, f"<p>page {i}</p>{'<p>copy</p>' if i == 35 else ''}") for i in range(30, 40)]
    frame = spark.createDataFrame(copies + own, "page_id int, url string, html string, n_chars int")
    got = {r.page_id: r.text for r in extract(frame).collect()}
    assert got == {i: "T\n\nsame\n\ncopy" if i < 30 else f"page {i}" + ("\n\ncopy" if i == 35 else "") for i in range(40)}


LONG_TEXT = "A long paragraph that many pages of this site have in common, " * 6


@pytest.mark.parametrize("article, near, others", [(True, 40, 0), (True, 40, 40), (False, 6, 44), (False, 30, 10)])
def test_near_copies_keep_their_text(spark, article, near, others):
    """Pages that differ by one line are no template, whatever their number; a box around them is."""
    tag = "article" if article else "div"
    box = "" if article else "<div><p>Call us now</p></div>"

    def page(i, body):
        return i, f"https://a.com/{i}", f"<body>{box}<{tag}>{body}</{tag}></body>", 0

    rows = [page(i, f"<h1>Heading</h1><p>{LONG_TEXT}</p><p>Own number {i}</p>") for i in range(near)]
    rows += [page(i, f"<p>Another text, {i}, of its own: {i * 7919}.</p>") for i in range(near, near + others)]
    frame = spark.createDataFrame(rows, "page_id int, url string, html string, n_chars int")
    got = {r.page_id: r.text for r in extract(frame).collect()}
    want = {i: f"Heading\n\n{LONG_TEXT.strip()}\n\nOwn number {i}" for i in range(near)}
    assert got == want | {i: f"Another text, {i}, of its own: {i * 7919}." for i in range(near, near + others)}


@pytest.mark.parametrize("long", [False, True])
def test_boxes_inside_articles_go(spark, long):
    """A box in most articles of a host goes, but never what is most of an article's text."""
    box = f"<div><p>{LONG_TEXT if long else 'Read more of this in our shop'}</p></div>"
    rows = [(i, "https://a.com/", f"<article><p>{f'Own words of number {i} of the pages. ' * 20}</p>{box}</article>", 0) for i in range(40)]
    rows += [(99, "https://a.com/", f"<article>{box}<p>Short.</p></article>", 0)]
    frame = spark.createDataFrame(rows, "page_id int, url string, html string, n_chars int")
    got = {r.page_id: r.text for r in extract(frame).collect()}
    assert all(got[i] == (f"Own words of number {i} of the pages. " * 20).strip() for i in range(40))
    assert got[99] == (f"{LONG_TEXT.strip()}\n\nShort." if long else "Read more of this in our shop\n\nShort.")


@pytest.mark.parametrize("name, kept", [
    ("form-factor", True), ("modal-verbs", True), ("social-history", True), ("share-prices", True), ("cookie-recipes", True), ("header-files", True),
    ("ad", False), ("ad-slot", False), ("adSlot", False), ("site-footer", False), ("cookie-notice", False), ("social-share-buttons", False),
    ("comment-list", False), ("comment-body", False), ("main-menu", False), ("related-articles", False), ("search-form", False),
    ("article-header", True), ("post-header", True), ("has-sidebar", True), ("newsletter_signup", False), ("ad-300x250", True),
])
def test_names_are_matched_whole(name, kept):
    inner = f"<div class='x {name}'><p>inner</p></div>"
    for page in (f"<p>outer</p>{inner}", f"<article><p>outer</p>{inner}</article>"):
        assert main_text(page, set()) == ("outer\n\ninner" if kept else "outer")


def plain_templates(pages):
    """The hashes that recur by the rules of the module, of pages of one host, counted one by one."""
    classes = {}
    for _, _, page in pages:
        tops, found, inside, digest = html._trees(page)
        classes.setdefault((inside, html._alike(tops, digest)), []).append({v for v, _, _ in found})
    around, rows = Counter(), Counter()
    for (inside, _), members in classes.items():
        for value in set().union(*members):
            around[value, inside] += 1
            rows[value, inside] += sum(value in m for m in members)
    n = len(classes)
    least = {True: max(html.INSIDE_PAGES, html.INSIDE_SHARE * n), False: max(min(html.TEMPLATE_PAGES, n / 3), html.OUTSIDE_SHARE * n)}
    return {v for (v, inside), k in around.items() if n >= html.TEMPLATE_PAGES and k > 1 and rows[v, inside] >= html.TEMPLATE_PAGES and k >= least[inside]}


@pytest.mark.parametrize("seed", range(4))
def test_templates_against_a_plain_count(spark, seed):
    """Boxes inside and outside of articles, copies and near copies, of a host."""
    rng = np.random.default_rng(seed)
    pages = []
    for i in range(90):
        parts = [f"<div><p>box {k}</p></div>" for k in range(5) if rng.random() < (0.15, 0.3, 0.55, 0.7, 0.95)[k]]
        own = f"<p>{LONG_TEXT if rng.random() < 0.2 else f'own {i} ' * int(rng.integers(1, 60))}</p>"
        tag = "article" if rng.random() < 0.6 else "section"
        pages.append((i, "http://h/x", f"{parts[0] if parts else ''}<{tag}>{''.join(parts[1:])}{own}</{tag}>"))
    pages += [pages[5]] * 12
    frame = spark.createDataFrame(pages, "i int, _html_host string, _html string").select("_html_host", "_html")
    found = html.templates(frame).collect()
    want = plain_templates(pages)
    assert want and set(found[0]["_html_template"]) == want


def test_subtrees_are_counted_like_a_plain_count(spark):
    pages = [(i, "http://h/x", f"<div><p>{i % 3}</p><p>x</p></div><div><p>{i % 2}</p></div>") for i in range(40)]
    frame = spark.createDataFrame(pages, "i int, _html_host string, _html string").select("_html_host", "_html")
    plain = Counter(v for _, _, p in pages for v in html.subtrees(p))
    want = {v for (v, inside), n in plain.items() if n >= 5 and not inside}
    assert set(html.templates(frame).first()["_html_template"]) == want


# -- labels


def held(id, divisor, rest):
    return zlib.crc32(str(id).encode()) % divisor == rest


def labelled_rows(seed=0, n=1500):
    rng = np.random.default_rng(seed)
    rows, labels = [], []
    for i in range(n):
        words = [f"w{int(x)}" for x in rng.zipf(1.3, int(rng.integers(5, 300))) % 5000]
        toxic, good = rng.random() < 0.15, rng.random() < 0.7
        if not good:
            words = [f"{w}***" for w in words] if rng.random() < 0.5 else [w for w in words[:20] for _ in range(8)]
        if toxic:
            for _ in range(int(rng.integers(2, 6))):
                words.insert(int(rng.integers(0, len(words) + 1)), f"{rng.choice(['Vile', 'nasty', 'awful', 'crude'])}{rng.choice(['', '.', '!'])}")
        rows.append((i, " ".join(words), "en", "s", 0))
        if rng.random() < 0.8:
            labels.append((i, int(good), int(toxic)))
    return rows, labels, {x[0]: x for x in labels}


DOCS, LABELS = "doc_id bigint, text string, lang string, source string, n_chars bigint", "doc_id bigint, quality int, toxic int"


def accuracy(got, truth, column):
    known = [(r, truth[r.doc_id][column]) for r in got if r.held_out and r.doc_id in truth]
    assert len(known) > 100
    positive = np.array([r.score for r, y in known if y == 1])
    negative = np.array([r.score for r, y in known if y == 0])
    area = (positive[:, None] > negative[None, :]).mean()
    return area, np.mean([r.predicted == y for r, y in known])


@pytest.mark.parametrize("scores, column, divisor, rest", [(quality_scores, 1, 5, 0), (toxicity_scores, 2, 4, 2)])
def test_held_out_accuracy(spark, scores, column, divisor, rest):
    rows, labels, truth = labelled_rows()
    docs, known = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)
    got = scores(docs, known, keep=["doc_id"]).collect()
    assert all(r.held_out == held(r.doc_id, divisor, rest) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    area, right = accuracy(got, truth, column)
    assert area > 0.97 and right > 0.93
    # Labels of held-out ids are not looked at.
    turned = spark.createDataFrame([(i, 1 - q, 1 - t) if held(i, divisor, rest) else (i, q, t) for i, q, t in labels], LABELS)
    again = {r.doc_id: r.score for r in scores(docs, turned, keep=["doc_id"]).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-9 for r in got)


@pytest.mark.parametrize("scores", [quality_scores, toxicity_scores])
def test_odd_rows_are_scored(spark, scores):
    rows, labels, _ = labelled_rows(1, 300)
    rows += [(1000, None, None, None, None), (1001, "", "en", "s", 0), (None, "a b", None, None, None), rows[0], (1002, "x" * 3_000_000 + " y" * 500_000, "en", "s", 0)]
    labels += [(0, 0, 0), (0, 1, 1), (2, None, None), (None, 1, 1), (7777, 1, 1)]
    wide = spark.createDataFrame([(*r, 5.0, "x", "y") for r in rows], f"{DOCS}, score double, word string, before string")
    got = scores(wide, spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.held_out is not None for r in got)
    assert got[0].asDict().keys() >= {"word", "before", "predicted"}
    none = spark.createDataFrame([], LABELS)
    without = scores(wide, none, keep=["doc_id"]).collect()
    assert len(without) == len(rows) and len({r.score for r in without}) == 1
    assert scores(spark.createDataFrame([], DOCS), none).collect() == []


def test_model_shards_give_the_same_scores(spark, monkeypatch):
    rows, labels, _ = labelled_rows(2, 400)
    docs, known = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)
    want = {r.doc_id: r.score for r in toxicity_scores(docs, known, keep=["doc_id"]).collect()}
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 300)
    got = toxicity_scores(docs, known, keep=["doc_id"]).collect()
    assert len(got) == 400 and all(abs(want[r.doc_id] - r.score) < 1e-6 for r in got)


def plain_ratios(rows):
    """{(before or None, word): log ratio} of (label, words) by the formulas, and that of other words."""
    pairs = {0: Counter(), 1: Counter()}
    for t, words in rows:
        pairs[t].update(zip(["", *words], words))
    pooled = pairs[0] + pairs[1]
    neighbours = lambda c: Counter(w for _, w in c)
    n, n0, n1 = neighbours(pooled), neighbours(pairs[0]), neighbours(pairs[1])
    d = toxicity.DISCOUNT
    if not n0 or not n1:
        return {}, None
    rest = {c: sum(min(x, d) for x in m.values()) / sum(m.values()) for c, m in ((0, n0), (1, n1))}
    base = {w: (n[w] + 1) / (sum(n.values()) + len(n) + 1) for w in n}
    p = {c: {w: max(m[w] - d, 0) / sum(m.values()) + rest[c] * base[w] for w in n} for c, m in ((0, n0), (1, n1))}
    out = {(None, w): np.log(p[1][w] / p[0][w]) for w in n if n0[w] >= toxicity.RARE or n1[w] >= toxicity.RARE}
    follow = {c: Counter() for c in (0, 1)}
    taken = Counter()
    for c in (0, 1):
        for (v, _), x in pairs[c].items():
            follow[c][v] += x
    for (v, _), x in pooled.items():
        taken[v] += min(x, d)
    for (v, w), x in pooled.items():
        if v and max(pairs[0][v, w], pairs[1][v, w]) >= toxicity.EXPRESSION:
            g = taken[v] / (follow[0][v] + follow[1][v])
            q = [(1 - g) * max(pairs[c][v, w] - d, 0) / max(follow[c][v], 1) + g * p[c][w] for c in (0, 1)]
            out[v, w] = np.log(q[1] / q[0])
    return out, np.log(rest[1] / rest[0])


def word_hashes(words):
    return {int(h[0].view(np.int64)): w for w in words for _, (h,) in toxicity.hashed([w.encode()], toxicity.MARKS)}


@pytest.mark.parametrize("folds", [lambda i: i % 3, lambda i: 0])
def test_kneser_ney_models_against_plain_ones(spark, folds):
    """The models of all rows, and of the rows without each fold."""
    rows, _, truth = labelled_rows(3, 300)
    data = [(truth[r[0]][2], folds(r[0]), r[1]) for r in rows if r[0] in truth]
    table, others = toxicity.model(spark.createDataFrame(data, "_label int, _fold int, _toxic_text string").repartition(3))
    name = word_hashes({w for *_, t in data for w in toxicity_words(t)}) | {None: None}
    found = table.collect()
    for kind in toxicity.KINDS:
        want, other = plain_ratios([(t, toxicity_words(x)) for t, k, x in data if str(k) != kind])
        got = {(name[r.before], name[r.word]): r[f"value_{kind}"] for r in found if r[f"value_{kind}"] is not None}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-4 for k in want)
        assert (kind in others) == (other is not None) and (other is None or abs(others[kind] - other) < 1e-9)
        assert kind != "all" or any(v for v, _ in want)


def test_scores_by_cross_fitting_against_a_plain_version(spark):
    """The whole path of the query: folds, models, summaries, weights, scores."""
    from pyspark.sql import functions as F

    from millrace.llm.labelled import logistic, sigmoid

    rows, labels, truth = labelled_rows(6, 240)
    learned = {i: t for i, _, t in labels if not held(i, 4, 2)}
    fold = {r.id: r.fold for r in spark.range(240).select("id", F.expr("pmod(xxhash64('fold', id), 3) AS fold")).collect()}
    words = {r[0]: toxicity_words(r[1]) for r in rows}

    def summary(ratio):
        n = len(ratio)
        best = [max(sum(ratio[i : i + min(width, n)]) / width for i in range(n - min(width, n) + 1)) for width in toxicity.WINDOWS]
        high = sum(x > 3 for x in ratio)
        return [sum(ratio) / n, *best, np.log1p(high), high / n] if n else [0.0] * (len(toxicity.WINDOWS) + 3)

    def summaries(ids, model):
        values, other = model
        return [summary([values.get((v, w), values.get((None, w), other)) for v, w in zip(["", *words[i]], words[i])]) for i in ids]

    x, y = [], []
    for k in range(3):
        own = [i for i in learned if fold[i] == k]
        x += summaries(own, plain_ratios([(t, words[i]) for i, t in learned.items() if fold[i] != k]))
        y += [learned[i] for i in own]
    x, y = np.array(x), np.array(y, dtype=float)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    weights = logistic(np.c_[(x - mean) / scale, np.ones(len(x))], y, ridge=toxicity.RIDGE, constant=True)
    every = np.array(summaries(words, plain_ratios([(t, words[i]) for i, t in learned.items()])))
    want = dict(zip(words, sigmoid(((every - mean) / scale) @ weights[:-1] + weights[-1])))
    got = toxicity_scores(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS), keep=["doc_id"]).collect()
    assert len(got) == 240 and all(abs(r.score - want[r.doc_id]) < 1e-3 for r in got)


def test_scores_without_weights(spark):
    """One toxic row: no model without its fold is of both labels, and the rest are of one label only."""
    rows = [(i, f"plain words of number {i} and more", "en", "s", 0) for i in range(60)] + [(100, "and zork more zork plain zork words zork of zork number zork", "en", "s", 0), (101, "vex zork zork", "en", "s", 0)]
    labels = [(i, 0, 0) for i in range(60)] + [(100, 0, 1)]
    got = {r.doc_id: r.score for r in toxicity_scores(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS), divisor=1, held=1, keep=["doc_id"]).collect()}
    assert got[100] > max(got[i] for i in range(60)) and got[101] > max(got[i] for i in range(60))
    assert all(0 <= s <= 1 for s in got.values())


def test_toxic_words_of_every_training_row_count(spark):
    """A word that only the rows of one fold hold is known to the model that scores."""
    from pyspark.sql import functions as F

    rows, labels, truth = labelled_rows(4, 600)
    fold = {r.id: r.fold for r in spark.range(600).select("id", F.expr("pmod(xxhash64('fold', id), 3) AS fold")).collect()}
    marked = {i for i, _, t in labels if t and fold[i] == 0}
    rows = [(i, f"{t} w1 zork w2 zork w3 zork w4 zork" if i in marked else t, *x) for i, t, *x in rows]
    clean = "w1 w2 w3 w4 w5 w1 w2 w1"
    rows += [(1000, clean, "en", "s", 0), (1001, clean.replace("w5", "zork"), "en", "s", 0), (1002, clean.replace("w5", "unseen"), "en", "s", 0)]
    got = {r.doc_id: r.score for r in toxicity_scores(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS), keep=["doc_id"]).collect()}
    assert len(marked) > 10 and got[1001] > got[1002] + 0.1 and got[1001] > got[1000]


def test_frequent_expressions_of_words_with_one_neighbour_count(spark):
    rows = [(1, i % 3, f"a{i} absolute xyz b{i % 3}") for i in range(9)] + [(0, i % 3, f"a{i} plain vwx b{i % 4}") for i in range(9)]
    table, others = toxicity.model(spark.createDataFrame(rows, "_label int, _fold int, _toxic_text string"))
    key, other = {w: k for k, w in word_hashes(["absolute", "xyz", "plain", "vwx"]).items()}, others["all"]
    value = {(r.before, r.word): r.value_all for r in table.where("value_all IS NOT NULL").collect()}
    assert (None, key["xyz"]) not in value
    assert value[key["absolute"], key["xyz"]] > 2 + other and value[key["plain"], key["vwx"]] < other - 2


def toxicity_words(text):
    import re

    return re.findall("[^\\W_]+", text.lower())


@pytest.mark.parametrize("good, bad", [(40, 25), (60, 1500), (1500, 60)])
def test_ranking_against_all_preference_pairs(good, bad):
    """Weights as from every pair of rows of unlike label, at any number of labels: no row is left out."""
    rng = np.random.default_rng(good)
    true = np.array([1.5, -1.0, 0.3, 0.0])
    label = np.r_[np.ones(good, int), np.zeros(bad, int)]
    x = (rng.normal(size=(len(label), 4)) + 0.8 * np.outer(label, true)).astype(np.float32)
    found = quality.fit(x, label)
    z = (x - x.mean(axis=0)) / (x.std(axis=0) + 1e-6)
    d = (z[label == 1][:, None, :] - z[label == 0][None, :, :]).reshape(-1, 4)
    w = np.zeros(4)
    for _ in range(50):  # plain Newton steps on the logistic loss of all differences
        p = 1 / (1 + np.exp(-d @ w))
        w += np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d + 1e-4 * len(d) * np.eye(4), d.T @ (1 - p) - 1e-4 * len(d) * w)
    assert found.weights @ w / np.linalg.norm(found.weights) / np.linalg.norm(w) > 0.97
    assert np.corrcoef(found.raw(x), z @ w)[0, 1] > 0.97


def test_threshold_is_the_quantile_of_all_labelled_rows(spark):
    """With a sample of a few rows, the threshold still parts all rows as their labels do."""
    rows, labels, truth = labelled_rows(8, 500)
    got = quality_scores(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS), sample=30, keep=["doc_id"]).collect()
    learned = [r for r in got if r.doc_id in truth and not r.held_out]
    low = sum(truth[r.doc_id][1] == 0 for r in learned)
    assert abs(sum(r.score < 0.3 for r in learned) - low) <= 1


def test_features_see_junk():
    x = {k: quality.features(t.encode()) for k, t in {"prose": "A plain sentence, with words. " * 3, "loud": "BUY!! NOW!! " * 9, "same": "go " * 40, "none": ""}.items()}
    assert len({v.shape for v in x.values()}) == 1 and all(np.isfinite(v).all() for v in x.values())
