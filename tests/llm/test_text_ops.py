"""HTML, languages, PII, quality, mixing, packing."""
import collections
import random
import re
import zlib

import numpy as np
import pytest

from ledgerline.llm import html, langid, mixing, packing, pii, quality

PAGE = ("<html><head><title>T</title><style>p{}</style><script>var t='</p>words words';</script></head><body>"
        "<nav><ul><li><a href='/x'>Home page of all</a></li></ul></nav><!-- note <p>no</p> --><div class=\"ad top\">Buy this now"
        " please</div><article><h1>Title &amp; more</h1><p>First  <b>bold</b>\n text &#233;&eacute;.</p><aside>side words</aside>"
        "<p>Second &lt;tag&gt; text<form><input>Send me</form></p><div id='comments'><p>nice read</p></div></article>"
        "<div>stray words here</div><footer>&copy; me</footer></body></html>")
WANT = "Title & more\nFirst bold text éé.\nSecond <tag> text"


def test_html(spark):
    rows = [(i, f"u{i}", PAGE) for i in range(40)] + [(50, None, None), (51, "u", ""), (52, "u", "<p><nav>x"), (None, "v", PAGE),
                                                      (53, "u", "plain words only"), (54, "u", "<article><p>" + "long " * 200_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "1 AS n_chars")
    got = html.extract(df).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by = {r.page_id: r.text for r in got}
    assert by[0] == by[None] == WANT and by[50] == by[51] == "" and by[53] == "plain words only"
    assert by[54] == ("long " * 200_000).strip()
    assert html.extract(df.limit(0)).count() == 0
    w = html.learn(df)
    assert w("p") > w("div") and w("div") < -20
    assert html.main_text("<p>a</p>", html.UNTRAINED) == "a"


BODY = "<article><h1>The title of it</h1><p>First words of it.</p><p>Second words here.</p></article>"
BODY_TEXT = "The title of it\nFirst words of it.\nSecond words here."


@pytest.mark.parametrize("around", [
    '<div class="layout with-sidebar">%s</div>', '<div class="no-comments">%s</div>', "<div id=nav-open>%s</div>",
    '<div class="sidebar">%s</div>', '<section class="page widget"><div class="header">%s</div></section>',
    '<form action="/x">%s</form>', '<div role="banner">%s</div>', '<div class="comments">%s</div>', '<nav><ul>%s</ul>',
    '<div data-class="menu">%s</div>'])
def test_html_keeps_what_holds_the_article(around):
    for body in (BODY, BODY.replace("article>", "main>")):
        assert html.main_text("<body>" + around % body + "<footer>us</footer></body>", html.Weights({"p": 9}, {}, 20.0)) == BODY_TEXT


@pytest.mark.parametrize("name", ["article-header", "entry-header", "header", "site-header", "title no-comments"])
def test_html_keeps_the_title_in_the_article(name):
    page = BODY.replace("<h1>The title of it</h1>", f'<div class="{name}"><h1>The title of it</h1></div>')
    assert html.main_text(page, html.Weights({"p": 9, "h1": 9, "div": 9}, {}, 20.0)) == BODY_TEXT


@pytest.mark.parametrize("notice", [
    '<div class="cookie-banner">take some cookies with us</div>', '<div id="comments"><article>a nice read</article></div>',
    '<aside><article>another page</article></aside>', '<ul class="big nav-list"><li>Home</ul>', '<div class="ad">buy</div>',
    '<div class="related_links"><article>more</article></div>', '<div class="header">site name</div>'])
def test_html_still_drops_notices(notice):
    assert html.main_text("<body>" + notice + BODY + "</body>", html.Weights({"p": 9}, {}, 20.0)) == BODY_TEXT


def test_html_one_outlier_page_sets_no_weight(spark):
    page = "<html><body><div>some words outside</div>" + BODY + "%s<div>more words outside here</div></body></html>"
    usual = [(i, "u", page % ("<p>late note</p>" if i % 20 == 0 else "")) for i in range(60)]
    outlier = page % ("<p>" + "far " * 5000 + "</p><p>off</p>" * 200)
    odd = "<html><body><article>" + "<div>words in it</div>" * 5000 + "</article><p>x</p></body></html>"
    make = lambda rows: spark.createDataFrame(rows, "page_id long, url string, html string")
    plain = html.learn(make(usual))
    for more in ([(100, "u", outlier)], [(101, "u", odd)]):
        w = html.learn(make(usual + more))
        assert all(abs(w(t) - plain(t)) < 2 for t in ("p", "h1", "div", "body")), more[0][0]
        assert html.main_text(usual[1][2], w) == BODY_TEXT
        text = {r.page_id: r.text for r in html.extract(make(usual + more)).collect()}
        assert all(text[i] == BODY_TEXT for i in range(60) if i % 20), more[0][0]


LONG = "<p>" + "words of the page itself " * 9 + "</p>"
LONG_TEXT = ("words of the page itself " * 9).strip()


@pytest.mark.parametrize("page, text", [
    ('<body><form id="aspnetForm"><input>' + LONG + "</form></body>", LONG_TEXT),
    ('<body><div class="widget">' + LONG + "</div></body>", LONG_TEXT),
    ('<body>' + LONG + '<form>Your name <input></form></body>', LONG_TEXT),
    ('<body>' + LONG + '<div class="comments">' + LONG * 3 + "</div></body>", LONG_TEXT),
    ('<body><p class="x"">' + LONG_TEXT + '</p><p id="y">more</p></body>', LONG_TEXT + "\nmore"),
    ("<body><p title=don't>" + LONG_TEXT + "</p><p>it's the end</p></body>", LONG_TEXT + "\nit's the end"),
    ("<body><!-->" + LONG + "<!-- no --><p>yes</p><!--->" + "</body>", LONG_TEXT + "\nyes"),
    ("<body><article><h1>Head</h1><ul>" + "<li>one</li>" * 6 + "</ul>" + LONG + "<li>z</li></article></body>",
     "Head\n" + "one\n" * 6 + LONG_TEXT + "\nz"),
    ("<body><p>far</p><nav>" + LONG + "</nav><main>" + LONG + "</main></body>", LONG_TEXT),
    ('<body><div a="1"b=\'2\'c=>' + LONG + "</div></body>", LONG_TEXT)])
def test_html_malformed_and_framed_pages(page, text):
    assert html.main_text(page, html.Weights({"p": 9}, {}, 20.0)) == text


def best_region(scores):
    """Every region, by plain sums: of the largest the one that ends first, and of these the shortest."""
    best = (0.0, 0, 0)
    for j in range(1, len(scores) + 1):
        for i in range(j - 1, -1, -1):
            if sum(scores[i:j]) > best[0]:
                best = (sum(scores[i:j]), i, j)
    return best


def test_html_region_equals_all_regions():
    rnd = random.Random(9)
    w = html.Weights({"p": 3, "b": 1, "div": 1}, {"div": 3, "li": 5, "b": 1}, 3.0)
    for _ in range(300):
        page = "".join(rnd.choice(["<p>", "</p>", "<div>", "</div>", "<li>", "<b>", "</b>", "word ", "two words ", "&amp; ", "<br>"])
                       for _ in range(rnd.randrange(40)))
        toks = html.tokens(page)
        scores = [float(len(v.split())) if k == "text" else w(n) for k, n, v in toks]
        _, i, j = best_region(scores)
        blocks, at = [[]], i
        for k, n, v in toks[i:j]:
            if k == "text":
                blocks[-1].append(v)
            elif n in html.BLOCK:
                blocks.append([])
        want = "\n".join(x for x in (" ".join("".join(b).replace("&amp;", "&").split()) for b in blocks) if x)
        assert html.main_text(page, w) == want, page


WORDS = {"aa": "the of and that with for", "bb": "der die und nicht mit auf", "cc": "les des une pour dans est"}


def language_rows():
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choices(WORDS[k].split(), k=30)).title(), k, None, None)
            for i, k in enumerate(rnd.choices(list(WORDS), k=400))]
    return rows + [(900, None, "aa", None, None), (901, "", "aa", None, None), (902, "12 34 !!", "bb", None, None),
                   (903, "the of", None, None, None), (None, "der die und", None, None, None), (904, "漢字" * 60_000, None, None, None)]


def test_languages(spark, docs_of):
    df = docs_of(language_rows()).selectExpr("*", "1 AS score", "'q' AS lang_pred")
    got = {r.doc_id: r for r in langid.identify(df).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in got if i is not None)
    assert all(got[i].lang_pred == k and 0 <= got[i].score <= 1 for i, _, k, *_ in language_rows() if i is not None and i < 400)
    assert [got[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3
    assert got[903].lang_pred == "aa" and got[None].lang_pred == "bb" and got[904].lang_pred in WORDS
    assert langid.identify(df.limit(0)).count() == 0
    assert {r.lang_pred for r in langid.identify(df.where("lang IS NULL")).collect()} == {"und"}


def test_language_kernel_is_the_shared_grams():
    cols = np.arange(1 << langid.BITS) % langid.GRAMS
    a, b = (set(cols[langid.spectrum(t)].tolist()) for t in ("ab c", "abc"))
    p = langid.presence([langid.spectrum("ab c"), langid.spectrum("abc")], cols)
    assert np.isclose(float(p[0] @ p[1]), len(a & b) / np.sqrt(len(a) * len(b)))


SCRIPTS = {"el": "και το να της με για από δεν", "ru": "и в не на что как это но", "uk": "і в не на що як це але",
           "ja": "の に は を た が で て", "he": "של את על לא הוא עם זה", "en": "the of and to in is it", "fr": "le de et un être que dans",
           "de": "der die und in den von zu", "es": "el de la que y en un", "tr": "ve bir bu da için çok"}


def test_languages_of_many_scripts(spark, docs_of):
    rnd = random.Random(6)
    letters = {k: sorted(set(w.replace(" ", ""))) for k, w in SCRIPTS.items()}
    # two thirds invented words of the language's letters, so that no letter can be merged with another's
    word = lambda k: rnd.choice(SCRIPTS[k].split()) if rnd.random() < 0.3 else "".join(rnd.choices(letters[k], k=4))
    rows = [(i, " ".join(word(k) for _ in range(25)), k, None, None) for i, k in enumerate(rnd.choices(list(SCRIPTS), k=900))]
    got = {r.doc_id: r for r in langid.identify(docs_of(rows)).collect()}
    held = [(got[i].lang_pred == k) for i, _, k, *_ in rows if got[i].held_out]
    assert len(held) > 150 and sum(held) / len(held) > 0.97


def test_language_scores_equal_kernel_ridge():
    """With every fitted text as a landmark the scores are those of plain kernel ridge regression."""
    rnd = random.Random(7)
    langs = [rnd.choice("ab") for _ in range(60)]
    texts = [" ".join(rnd.choices(WORDS[k * 2].split(), k=8)) for k in langs]
    grams = [langid.spectrum(t) for t in texts]
    model = langid.KernelRidge.fit(grams, langs)
    held = {g: i for i, g in enumerate(sorted(set(np.concatenate(grams).tolist())))}
    x = np.zeros((len(texts), len(held)))
    for i, g in enumerate(grams):
        x[i, [held[c] for c in g.tolist()]] = 1
    x /= np.sqrt(x.sum(1, keepdims=True))
    y = np.array(langs)
    for name in "ab":  # weighted ridge in the dual: weights of 1 / rows of the language, free intercept
        d = np.where(y == name, 1.0, -1.0)
        share = 1.0 / np.array([(y == v).sum() for v in y])
        z = np.hstack([x, np.ones((len(x), 1))])
        lam = langid.RIDGE / len(x)
        alpha = np.linalg.solve(z @ z.T + lam * np.diag(1 / share), d)
        want = z @ z.T @ alpha
        kernel = langid.presence(grams, model.columns) @ model.landmarks.T
        got = (kernel @ model.weights[:-1] + model.weights[-1])[:, model.langs.index(name)]
        assert np.abs(got - want).max() < 5e-3


def plain_spans(text):
    def luhn(d):
        return sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(d))) % 10 == 0
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return [(a, b, k) for a, k, b in sorted(out)]


def test_pii_base_equals_plain_patterns():
    rnd = random.Random(11)
    parts = ["a@b.cd", "x@a.b_c@d.ef", "@", ".", "a", "+49 (30) 123-4567", "1.2.3.4", "300.1.1.1", "4111 1111 1111 1111",
             "4111-1111", " ", "-", "+1", "0001.2.3.4.5.6.7.8", "é", "%", "9" * 25, "١", "x@y", "b@c@d.e"]
    for _ in range(4000):
        t = "".join(rnd.choices(parts, k=rnd.randint(1, 9)))
        assert sorted(pii.base_spans(t), key=lambda s: (s[0], s[2])) == plain_spans(t), t


def test_pii_field_spreads_labels(spark, docs_of):
    card, mail = "4111 1111 1111 1111", "jane.doe@mail.example"
    rows = [(i, f"call +49 30 1234567{i % 10} or {mail}, card {card} from 10.0.0.{i}", None, None, None) for i in range(80)]
    rows += [(100, "reach me: +49 30 12345678 or 49-30-12345678, thanks", None, None, 50), (101, None, None, None, None),
             (102, "", None, None, 0), (103, "order 4111111111111112 and again 4111111111111112", None, None, None),
             (104, "words " * 100_000 + mail, None, None, None), (104, "clean text", None, None, None)]
    df = docs_of(rows).selectExpr("*", "1 AS spans", "2 AS n_ip")
    got = {(r.doc_id, r.n_email): r for r in pii.find_pii(df).collect()}
    t = rows[80][1]
    spans = [(k, t[int(a):int(b)]) for k, a, b in (s.split(":") for s in got[100, 0].spans.split(","))]
    assert spans == [("phone", "+49 30 12345678"), ("phone", "49-30-12345678")] and got[100, 0].n_phone == 1
    assert got[101, 0].spans == got[102, 0].spans == got[103, 0].spans == got[104, 0].spans == ""
    assert got[104, 1].spans == f"email:600000:{600000 + len(mail)}"
    out = {(r.doc_id, (r.text or "")[:5]): r for r in pii.mask_pii(df).collect()}
    assert out[100, "reach"].text == "reach me: [PHONE] or [PHONE], thanks" and out[100, "reach"].n_chars == 36
    assert out[101, ""].text is None and out[104, "clean"].text == "clean text"
    assert pii.mask_pii(df).columns == df.columns and pii.find_pii(df.limit(0)).count() == 0


def added_spans(other, text):
    """What the field, fitted on ``other`` texts and ``text``, adds to the base spans of ``text``."""
    (base, spans), = pii.SkipChain(pii.count_batch([*other, text])).find([text])
    return [text[a:b] for a, b, k in spans if (a, b, k) not in base]


def other_texts(n):
    return [f"call +1 ({i % 900 + 100}) 555-{1000 + i % 9000} now, code {2000000 + i} and part {i} of ten" for i in range(n)]


@pytest.mark.parametrize("size", [3, 3000])
@pytest.mark.parametrize("repeats", [1, 2, 10, 50])
def test_pii_label_holds_over_repeats(size, repeats):
    other = other_texts(size)
    said = "write to +1 (017) 555-7713 please" + " then some words 5557713 follow" * repeats
    assert added_spans(other, said) == ["5557713"] * repeats
    rows = "write to +1 (017) 555-7713 please\n" + "".join(f"{i + 10}, 5557713, {i * 3}\n" for i in range(repeats))
    assert added_spans(other, rows) == ["5557713"] * repeats
    assert added_spans(other, "write to +1 (017) 555-7713 please" + " then some words 5557714 follow" * repeats) == []


@pytest.mark.parametrize("sure, again", [
    ("+1 (017) 555-7713", ["017 555 7713", "(017) 555-7713", "017.555.7713", "1 (017) 555 7713", "555-7713", "5557713", "555 77 13"]),
    ("+49 30 12345678", ["030 12345678", "0049 30 12345678", "(030) 1234-5678", "49 (0)30 1234 5678", "30-1234-5678"]),
    ("4111 1111 1111 1111", ["4111.1111.1111.1111", "4111 1111.1111 - 1111", "4111 1111  1111 1111"])])
def test_pii_repeats_with_other_separators(sure, again):
    for form in again:
        for text in (f"first {sure} then in words {form} and more", f"words {form}, later {sure}; {form}",
                     f"room 12 {form} 7 or: {sure}!" + f" Fax{form}.\nNext 7 of {form} (2)" * 10):
            n = text.replace(sure, "").count(form)
            assert added_spans(other_texts(5), text) == [form] * n, (form, text)
    assert added_spans(other_texts(5), f"first {sure} then 017 555 7714, 030 1234 5679 and 4111.1111.1111.1112") == []


def test_pii_area_code_is_masked(spark, docs_of):
    text = "write to +1 (017) 555-7713 please, or dial (017) 555-7713 or 017 555 7713 today"
    got = pii.mask_pii(docs_of([(1, text, None, None, len(text))])).collect()[0]
    assert got.text == "write to [PHONE] please, or dial [PHONE] or [PHONE] today" and got.n_chars == len(got.text)


def test_pii_nodes_cover_each_token_once():
    rnd = random.Random(5)
    parts = ["a@b.cd", "+49 (30) 123-4567", "(30) 123-4567", "030 123 4567", "1.2.3.4", "234.101.220.113", "234 101 220 113",
             "4111 1111 1111 1111", "4111.1111", "1111", " ", "-", "x", "(", ")", ". ", "\n", "7", "0", "00", "@"]
    for _ in range(4000):
        t = "".join(rnd.choices(parts, k=rnd.randint(1, 12)))
        base = pii.base_spans(t)
        found, links, same = pii.nodes(t, base)
        ends = [0, *(n[1] for n in found)]
        assert all(a <= n[0] < n[1] for a, n in zip(ends, found)) and len(same) == len(found), t
        assert all(any(n[0] <= s[0] and s[1] <= n[1] and n[4] for n in found) for s in base), t


def quality_rows():
    rnd = random.Random(6)
    rows, labels = [], []
    for i in range(600):
        good = rnd.random() < 0.75
        w = [rnd.choice("lorem ipsum dolor sit amet consetetur".split()) + str(rnd.choice(["", "s", "en"])) for _ in range(60)]
        rows.append((i, " ".join(w) + "." if good else "!! ".join(w).upper() if i % 2 else "### $$$ ".join(w), "en", f"s{i % 9}", 400))
        if i % 2 == 0 or i < 200:
            labels.append((i, int(good), 0))
    return rows, labels


def test_quality(spark, docs_of):
    rows, labels = quality_rows()
    lab = spark.createDataFrame([*labels, (None, 1, 0), (3, None, 0), (4, 7, 0)], "doc_id long, quality int, toxic int")
    df = docs_of([*rows, (700, None, None, None, None), (701, "", "x", "y", -5), (702, "fine words " * 50_000, "en", "s1", None),
                  (None, rows[0][1], None, None, None)]).selectExpr("*", "1 AS y", "2 AS id")
    model = quality.fit_quality(df, lab)
    got = quality.score_quality(df, model, out="s")
    assert got.columns == [*df.columns, "s"]
    s = {r.doc_id: r.s for r in got.select("doc_id", "s").collect()}
    right = sum((s[r[0]] >= 0.5) == r[1].islower() * (not re.search("[#!]", r[1])) for r in rows)
    assert right >= 0.98 * len(rows) and s[700] == s[701] == 0 and 0 <= s[702] <= 1
    none = quality.fit_quality(df, lab.limit(0))
    assert {r.score for r in quality.score_quality(df.where("doc_id < 5"), none).collect()} == {1.0}
    assert quality.score_quality(df.limit(0), quality.fit_quality(df.limit(0), lab)).count() == 0
    with pytest.raises(ValueError):
        quality.score_quality(df, none, out="TEXT")


def test_views_teach_each_other():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 600)
    t = np.stack([y + rng.normal(0, 0.2, 600), rng.normal(0, 1, 600)], axis=1)
    m = np.stack([y + rng.normal(0, 0.2, 600)], axis=1)
    given = np.where(np.arange(600) < 24, y, -1)
    model = quality.co_train(t, m, given, np.arange(600) % 4)
    assert ((model.score(t, m) > 0.5) == y).mean() > 0.97


OTHER_NUMBERS = [("call +1 (017) 555-7713 now", n) for n in ("order 998865557713", "id 4475557713", "20005557713", "x-4475557713-y")] + \
    [("card 4111 1111 1111 1111 here", n) for n in ("serial 99991111111", "total 1111111", "111 1111 111 1111", "1111-1111")]


@pytest.mark.parametrize("first, other", OTHER_NUMBERS)
def test_other_numbers_of_the_same_ending_stay(spark, docs_of, first, other):
    text = f"{first} and {other}, then {other} again"
    field = pii.fit_skip_chain(docs_of([(i, text, "en", "s", 1) for i in range(20)]))
    (base, spans), = field.find([text])
    assert len(base) == 1 and spans == base
    again = first.split()[1:-1]
    whole = " ".join(again).lstrip("+").replace(" ", "")
    (_, spans), = field.find([f"{first} and {whole} again"])  # the whole number written once more
    assert len(spans) == 2


def test_pii_result_is_the_same_under_any_batching(spark, docs_of):
    rnd = random.Random(3)
    num = lambda: f"+49 30 {rnd.randrange(10 ** 7, 10 ** 8)}"
    texts = []
    for _ in range(60):
        n = num()
        bare = n.replace("+49 ", "0")
        texts.append(" ".join(rnd.choices([n, bare, bare.replace(" ", ""), "tel", "12 34", "x@y.de", "ref 99", "10.0.0.1"], k=rnd.randrange(2, 30))))
    field = pii.fit_skip_chain(docs_of([(i, t, "de", "s", 1) for i, t in enumerate(texts)]))
    alone = [field.find([t])[0] for t in texts]
    assert field.find(texts) == alone and field.find(texts[::-1]) == alone[::-1]


def test_pii_long_words_and_tokens_are_read_whole():
    assert pii.word_before("a " + "x" * 40 + ": 12", 44) == "x" * 40 and pii.word_before("tel_ 5", 5) == ""
    a, b = ("1-" * 60 + "a", "1-" * 60 + "(a")
    assert pii.shape(a) != pii.shape(b)


@pytest.mark.parametrize("sharp", [0.95, 0.6, 0.55, 0.505])
def test_soft_membership_meets_targets(spark, sharp):
    rng = np.random.default_rng(3)
    p = np.clip(np.where(rng.random(400) < 0.7, sharp, 1 - sharp) + rng.normal(0, 0.001, 400), 0, 1)
    rows = [(float(t), [float(x), float(1 - x)], 1.0) for t, x in zip(rng.integers(1, 90, 400), p, strict=True)]
    state = spark.createDataFrame(rows, "tokens double, posterior array<double>, rate double")
    sums = [sum(t * q[i] for t, q, _ in rows) for i in range(2)]
    goal = [sums[0] * 0.97 + sums[1] * 0.02, sums[1] * 0.98 + sums[0] * 0.03]
    out, steps, gap = mixing.fit_rates(state, sums, goal)
    got = out.collect()
    assert gap < 1e-6 and all(r.rate >= 0 for r in got)
    for i in range(2):  # against plain sums
        assert abs(sum(r.rate * r.tokens * r.posterior[i] for r in got) - goal[i]) < 2e-6 * sums[i]


def test_rates_at_zero_and_targets_out_of_reach(spark):
    from itertools import product
    rng = np.random.default_rng(4)
    p = rng.dirichlet([0.5, 0.5, 0.5], 300)
    t = rng.integers(1, 50, 300).astype(float)
    state = spark.createDataFrame([(float(a), [float(x) for x in q], 1.0) for a, q in zip(t, p, strict=True)],
                                  "tokens double, posterior array<double>, rate double")
    sums = (t[:, None] * p).sum(0)
    out, _, gap = mixing.fit_rates(state, list(sums), list(sums * [0.02, 1.0, 1.6]))
    rate = np.array([r.rate for r in out.collect()])
    assert gap < 1e-6 and (rate >= 0).all() and (rate == 0).any()
    # a domain that never stands alone can't be all there is: the gap is the least over a grid of rates
    two = spark.createDataFrame([(1.0, [0.6, 0.4], 1.0), (1.0, [0.5, 0.5], 1.0)], "tokens double, posterior array<double>, rate double")
    out, _, gap = mixing.fit_rates(two, [1.1, 0.9], [1.1, 0.0])
    left = lambda a, b: ((0.6 * a + 0.5 * b - 1.1) / 1.1) ** 2 + ((0.4 * a + 0.5 * b) / 0.9) ** 2
    r = [x.rate for x in out.collect()]
    assert gap > 0.1 and left(*r) < min(left(a / 50, b / 50) for a, b in product(range(150), repeat=2)) + 1e-3


def test_mixing_meets_targets(spark, docs_of):
    rows = [*language_rows()[:400], *[r for r in language_rows()[400:]]]
    df = docs_of(rows).selectExpr("*", "1 AS tokens", "2 AS rate", "3 AS _mix_words")
    labelled = df.where("doc_id % 2 = 0").selectExpr("text", "lang AS domain")
    want = {"aa": 0.5, "bb": 0.3, "cc": 0.2}
    mix, state = mixing.fit_mixture(df, labelled, id_cols=("doc_id",), weights=want)
    got = state.collect()
    p = np.array([r.posterior for r in got])
    assert np.allclose(p.sum(1), 1) and all(r.rate >= 0 for r in got) and len(got) == len(rows)
    total = (np.array([r.tokens * r.rate for r in got])[:, None] * p).sum(0)
    assert np.allclose(total / total.sum(), [want[d] for d in mix.domains], atol=1e-4)
    keep, _ = mixing.fit_mixture(df, labelled, keep_all=True)
    out = mixing.mix_rows(df, keep)
    assert out.columns == df.columns and {r.doc_id for r in out.collect()} == {r[0] for r in rows}
    one, state = mixing.fit_mixture(df, labelled.where("domain = 'aa'"))
    assert one.model is None and {r.rate for r in state.collect()} == {1.0}
    _, state = mixing.fit_mixture(df.limit(0), labelled)
    assert state.count() == 0 and mixing.mix_rows(df.limit(0), keep).count() == 0


TOKENIZER = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def test_word_encoder_equals_the_tokenizer(docs_of):
    from tokenizers import Tokenizer
    import pyarrow as pa
    texts = ["", None, "It's we'll don't", "ábc É́ Ñandú,", "K Å", "x\x1cy\x85z\xa0w", "ΣΑΣ ς", "日本語", "<|endoftext|>a",
             "a.b,c!! ..''s", "ẞ İi", "12 3.4%", "́ x", "ﬁ ½ ² µ ª", "Aa " * 9000, "x" * 500]
    full = Tokenizer.from_file(str(TOKENIZER))
    for t, ids in zip(texts, packing.encoder(str(TOKENIZER)).texts(pa.array(texts, pa.string())), strict=True):
        assert ids.tolist() == full.encode(t or "", add_special_tokens=False).ids, t


def test_packing(spark, docs_of):
    from tokenizers import Tokenizer
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choices(["alpha", "Beta,", "gamma"], k=rnd.choice([0, 1, 9, 30, 200]))), None, None, None)
            for i in range(300)] + [(5, "alpha", None, None, None)] * 40 + [(900, None, None, None, None), (None, "alpha", None, None, None)]
    df = docs_of(rows).selectExpr("*", "1 AS length", "2 AS piece")
    out = packing.pack(df, str(TOKENIZER), capacity=64, with_ids=True).collect()
    full = Tokenizer.from_file(str(TOKENIZER))
    want = collections.Counter()
    for i, t, *_ in rows:
        ids = [*full.encode(t or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 64):
            part = ids[k:k + 64]
            want[i, k // 64, k, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes()), tuple(part)] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in out) == want
    seqs = collections.defaultdict(list)
    for r in out:
        seqs[r.sequence_id].append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 64
    assert len(seqs) <= 1.02 * sum(r.length for r in out) / 64 + 1
    assert packing.pack(df.limit(0), str(TOKENIZER)).count() == 0


@pytest.mark.parametrize("seed", range(25))
def test_plan_places_every_piece(seed):
    rnd = random.Random(seed)
    hist = collections.Counter(rnd.choice([rnd.randint(1, 60), 20, 41]) for _ in range(rnd.choice([0, 1, 40, 3000])))
    used, ranks = collections.defaultdict(list), collections.defaultdict(list)
    for n, first, many, seq, off in packing.best_plan(dict(hist), 60):
        ranks[n].append((first, many))
        for q in range(many):
            used[seq + q].append((off, n))
    for n, c in hist.items():
        at = 0
        for first, many in sorted(ranks[n]):
            assert first == at
            at += many
        assert at == c
    for s in used.values():
        assert sum(n for _, n in s) <= 60 and [o for o, _ in sorted(s)] == [sum(n for x, n in s if x < o) for o, _ in sorted(s)]


def test_quality_by_words_alone(spark, docs_of):
    rnd = random.Random(12)
    good, bad = ["river", "stone", "light", "table", "green"], ["cheap", "click", "prize", "bonus", "deals"]
    rows = [(i, " ".join(rnd.choices(bad if i % 2 else good, k=40)), "en", "s", 239) for i in range(800)]
    lab = spark.createDataFrame([(i, 1 - i % 2) for i in range(300)], "doc_id long, quality int")
    df = docs_of(rows).selectExpr("*", "'x' AS score", "7 AS y")
    got = quality.score_quality(df, quality.fit_quality(df, lab), out="s2").collect()
    assert np.mean([(r.s2 >= 0.5) == (r.doc_id % 2 == 0) for r in got if r.doc_id >= 300]) > 0.98


def test_quality_query_and_stage_with_a_score_column(spark, docs_of, tmp_path):
    import corpus_pipeline
    from ledgerline.llm import queries
    rows = [(i, "good text here " * 9 if i % 2 else "### %% junk ### " * 9, "en", "s", 100) for i in range(120)]
    df = docs_of(rows).selectExpr("*", "9 AS score", "8 AS _score", "'q' AS keep")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = queries.op10_quality_co_training(spark, str(tmp_path))
    assert got.columns == ["doc_id", "score", "keep"]
    assert all(r.keep == (r.doc_id % 2 == 1) and 0 <= r.score <= 1 for r in got.collect())
    kept = corpus_pipeline.good_quality(spark, df, str(tmp_path))
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == list(range(1, 120, 2))
