"""The other operators against brute force or exact round trips, and their corner cases."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from meterwise.llm import decontaminate as D
from meterwise.llm import html_extract as H
from meterwise.llm import lang_id as I
from meterwise.llm import mixing as M
from meterwise.llm import quality_classifier as C
from meterwise.llm import quality_rules as R
from meterwise.llm import token_counts as T
from meterwise.llm import warc
from meterwise.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, size int, kept string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing names."""
    rows = [(1, "Some words, and a few more of them here. " * 5, "en", "a", 1, "x"), (2, None, "en", "a", 1, None), (3, "", None, None, None, "y"),
            (None, "Ein Text ohne Nummer, der hier steht.", "de", "b", 2, "z"), (4, "## $$ %%\n| |\n| |", "de", None, 3, ""),
            (5, "wort " * 40000, "de", "b", 3, ""), (6, "same row", "en", "c", 0, ""), (6, "same row", "en", "c", 0, ""),
            (7, "é" * 30000 + " 😀 " + "\n" * 500, "fr", "c", 0, "")]
    return spark.createDataFrame(rows, DOCS)


def test_language_of_held_out_rows_and_corner_cases(spark, odd, empty):
    assert I.identify_languages(empty).count() == 0
    got = {(r.doc_id, r.lang_pred) for r in I.identify_languages(odd).collect() if r.doc_id in (2, 3, 4)}
    assert got == {(2, "und"), (3, "und"), (4, "und")}
    assert {r.lang_pred for r in I.identify_languages(odd.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")).collect()} == {"und"}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = I.identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows) and all(0 <= r.score <= 1 for r in rows)


def test_language_sample_does_not_prefer_long_texts(spark):
    rnd = random.Random(11)
    text = lambda n: " ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(n))
    rows = [(i, text(400 if i % 2 else 4), "en") for i in range(1000)]
    sample = I.training_sample(spark.createDataFrame(rows, "key long, text string, lang string"), 64)
    assert len(sample) == 64
    for part in (sample, sample[:32]):
        assert 0.25 < sum(len(row[0]) < 500 for _, row in part) / len(part) < 0.75


def test_very_long_texts_are_told_apart():
    rnd = random.Random(12)
    alphabets = {"a": [chr(0x4E00 + i) for i in range(3000)], "b": [chr(0x4E00 + i) for i in range(1500, 4500)]}
    grams = I.Grams()
    text = lambda lang, n: "".join(rnd.choice(alphabets[lang]) for _ in range(n))
    model = I.fit([(lang, grams.row(text(lang, 2000))) for lang in "ab" for _ in range(40)])
    long = [grams.row(text(lang, 200_000)) for lang in "ab"]
    assert len(long[0][0]) > 0.99 * I.BINS  # presence alone says nothing
    assert [model.names[i] for i in model.scores(long).argmax(axis=1)] == ["a", "b"]
    assert all(abs(float(w @ w) - 1) < 1e-4 for _, w in long) and grams.row("12 !") is None


def test_bins_do_not_depend_on_blocks(monkeypatch):
    grams = I.Grams()
    text = "Über die  123 Brücke, l'été été. " * 40
    whole = grams.bins(text).tolist()
    monkeypatch.setattr(I, "BLOCK", 7)
    assert grams.bins(text).tolist() == whole


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, out, left = 1.5 * sum(sizes.values()), {}, set(names)
    while left:
        share = (total - sum(out.values())) / sum(weight[s] for s in left)
        full = {s for s in left if share * weight[s] > 2 * sizes[s]}
        out |= {s: 2 * sizes[s] if s in full else share * weight[s] for s in full or left}
        left -= full or left
    return out


def test_mix_meets_its_targets(spark, odd, empty):
    assert M.mix_sources(empty).count() == 0
    rnd = random.Random(4)
    rows = [(i, "w " * rnd.choice([1, 5, 40, 200]), rnd.choice("abcd") if i % 3 else "hot") for i in range(600)] + [(900, None, None), (901, "u v", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first = sorted(M.mix_sources(docs).collect(), key=lambda r: r.doc_id)
    again = sorted(M.mix_sources(docs.repartition(7)).collect(), key=lambda r: r.doc_id)
    assert first == again and len(first) == len(rows)
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    wanted, taken = brute_targets(sizes), Counter()
    for r in first:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(wanted[r.source])
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - wanted[s]) <= max(3, 0.01 * wanted[s]) for s in wanted)
    got = M.mix_sources(odd).collect()
    assert len(got) == 9 and sum(r.doc_id == 6 for r in got) == 2


def test_mix_is_unbiased(spark):
    rows = [(i, "w " * 10, s) for s in "ab" for i in range(30 * (s == "b"), 30 + 60 * (s == "b"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").cache()
    n = [sum(r.taken for r in M.mix_sources(docs, seed=k).collect() if r.source == "b" and r.doc_id < 60) for k in range(6)]
    share = sum(n) / 6 / sum(r.taken for r in M.mix_sources(docs).collect() if r.source == "b")
    assert 0.35 < share < 0.65


def test_warc_round_trip(spark, tmp_path):
    rnd = random.Random(1)
    page = "<html>" + " ".join(str(rnd.random()) for _ in range(100)) + "é</html>"
    rows = [(i, f"http://h/{i}\r\nx y", page.replace("html", "html lang=en") + str(i % 5)) for i in range(40)]
    rows += [(100, None, None), (101, "u", "short"), (102, "u", "short"), (None, "u", page), (103, "u", page), (103, "u", page), (None, "v", page + "!"),
             (None, "v", page + "!"), (104, "big", "z" * 3_000_000)]
    pages = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, digest string")
    folder, manifest = warc.write_archives(pages, roll_bytes=2000)
    got = warc.read_archives(spark, folder, manifest).collect()
    assert manifest.count() > 5 and len(got) == len(rows)
    last = {}
    for p, _, h in rows:
        if h and len(h.encode()) >= 1000 and p is not None:
            last[h] = max(p, last.get(h, -1))
    expected = []
    for p, _, h in rows:
        data = (h or "").encode()
        refers = last.get(h) if h in last and p != last[h] else None
        expected.append((str(p), len(data), hashlib.sha1(data).hexdigest(), "revisit" if refers is not None else "response",
                         str(refers), None if refers is not None else data))
    assert sorted(map(str, expected)) == sorted(str((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to),
                                                     None if r.payload is None else bytes(r.payload))) for r in got)


def test_warc_of_no_pages_and_without_dictionary(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    folder, manifest = warc.write_archives(none)
    assert warc.read_archives(spark, folder, manifest).count() == 0
    folder, manifest = warc.write_archives(spark.createDataFrame([(1, "u", "x")], none.schema))
    assert [r.payload for r in warc.read_archives(spark, folder, manifest).collect()] == [b"x"]


def test_archive_starts_with_its_dictionary():
    dictionary = warc.train_dictionary([f"record number {i} of a page with text {i * 7}".encode() * 20 for i in range(200)], 2048)
    head = warc.archive_head(dictionary)
    (magic, frame), = warc.frames(memoryview(head))
    assert dictionary and magic == warc.DICT_MAGIC and len(frame) == len(head)


def test_token_counts_equal_greedy_longest_match(spark, odd, empty):
    rnd = random.Random(3)
    vocabulary = ["▁", *"abcd", "ab", "abc", "bcd", "▁a", "▁ab", "cdab", "▁abcda", "dd", "ddd", "abcdabcd"]
    automaton = T.LongestMatch(vocabulary)

    def greedy(word):
        text, n, at = "▁" + word, 0, 0
        while at < len(text):
            size = next((k for k in range(8, 0, -1) if text[at:at + k] in vocabulary), None)
            if size is None:
                return -1
            n, at = n + 1, at + size
        return n
    for _ in range(3000):
        word = "".join(rnd.choice("abcde" if rnd.random() < 0.1 else "abcd") for _ in range(rnd.randint(1, 14)))
        assert automaton.count(word) == greedy(word), word
    assert T.token_counts(empty, vocabulary).count() == 0
    got = {r.doc_id: r for r in T.token_counts(odd, vocabulary, cache_words=2).collect()}
    assert (got[2].n_words, got[3].n_tokens, got[5].n_words) == (0, 0, 40000)
    assert got[5].n_tokens == got[5].n_unknown_words == 40000


def test_rule_counts_equal_brute_force(spark, odd, empty):
    assert R.quality_by_rules(empty).count() == 0
    rnd = random.Random(6)
    rows = [(i, rnd.choice([" ", "\n", "  "]).join(rnd.choice(["a", "b", "c", "#x", "D$"]) for _ in range(rnd.randint(0, 60)))) for i in range(80)]
    rows += [(r.doc_id, r.text) for r in odd.collect() if r.doc_id]
    got = R.quality_by_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    expected = []
    for d, text in rows:
        w = WORD.findall(text or "")
        wins = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
        times = Counter(wins)
        repeat = len({j for i, x in enumerate(wins) if times[x] > 1 for j in range(i, i + 5)})
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        failed = len(w) < 10 or 100 * repeat > 20 * len(w)
        expected.append((d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), repeat, failed))
    assert sorted(expected) == sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got)
    assert all(0 <= r.quality <= 1 and not (r.base_failed and r.kept) for r in got)


def test_rule_accuracies_follow_agreement(spark):
    patterns = spark.createDataFrame([(1, -1, 0, 5), (1, 0, 1, 100), (-1, -1, -1, 60), (-1, 0, -1, 30)], "a int, b int, c int, count long")
    accuracy = R.fit_votes(patterns, ["a", "b", "c"])
    assert accuracy["a"] > 0.9 and accuracy["c"] > 0.9 and all(0.4 < x < 1 for x in accuracy.values())


def test_rule_accuracies_converge(spark):
    rows = [(1, 0, 8400), (-1, 0, 690), (1, -1, 56), (0, -1, 8)]
    a = [R.ACCURACY] * 2
    for _ in range(1000):
        right, given = [0.0, 0.0], [0, 0]
        for *votes, n in rows:
            odds = R.GOOD / (1 - R.GOOD)
            for v, x in zip(votes, a):
                odds *= (x / (1 - x)) ** v
            for i, v in enumerate(votes):
                given[i] += n * abs(v)
                right[i] += n * (odds if v > 0 else 1) / (1 + odds) if v else 0
        a = [(r / g + R.PRIOR_WEIGHT * R.ACCURACY) / (1 + R.PRIOR_WEIGHT) for r, g in zip(right, given)]
    got = R.fit_votes(spark.createDataFrame(rows, "a int, b int, count long"), ["a", "b"], tol=1e-13)
    assert [got["a"], got["b"]] == pytest.approx(a, rel=0, abs=1e-12)


def test_classifier_learns_and_shrinks(spark, odd, empty):
    labels = spark.createDataFrame([(None, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    assert C.classify_quality(empty, labels).count() == 0
    got = C.classify_quality(odd, labels).collect()
    assert len(got) == 9 and {r.evidence for r in got} == {0.0} and all(r["size"] in (None, 0, 1, 2, 3) for r in got)
    rnd = random.Random(8)
    good = lambda: " ".join("".join(rnd.choice("etaoinshr") for _ in range(5)) for _ in range(60)) + "."
    rows = [(i, good() if i % 3 else good().replace(" ", " $$ ## "), f"http://{'x' if i % 3 else 'y'}.org/a/{i}?q") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taught = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(0, 400, 2)], "doc_id long, quality int")
    found = C.classify_quality(docs, taught).collect()
    assert all(r.kept == (r.doc_id % 3 > 0) for r in found)
    prior = {r.host: r.site_prior for r in found}
    assert prior["x.org"] > prior["y.org"] and {r.path for r in found} == {"x.org/a", "y.org/a"}


def test_site_posterior_equals_brute_force(spark, monkeypatch):
    """Hosts of one and of several paths, dense and sparse, against the formula row by row."""
    rnd = random.Random(12)
    sites = [("good.org", ["a", "b", "c"], 0.95, 60), ("bad.org", ["a", "b"], 0.1, 60), ("mixed.org", ["x", "y"], None, 60),
             ("one.org", ["only"], 0.9, 40), ("tiny.org", ["q"], 0.0, 1), ("tiny2.org", ["q", "r"], 1.0, 1)]
    rows, truth = [], {}
    for host, paths, share, n in sites:
        for path in paths:
            p = share if share is not None else {"x": 0.95, "y": 0.05}[path]
            for _ in range(n):
                i = len(rows)
                truth[i] = rnd.random() < p
                words = [("".join(rnd.choice("etaoinshr") for _ in range(5)) + ("" if truth[i] or rnd.random() < 0.5 else " #")) for _ in range(12)]
                rows.append((i, " ".join(words), f"http://{host}/{path}/{i}", 1, 2, 3))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _n int, _good int, host_n int")
    labels = spark.createDataFrame([(i, int(t)) for i, t in truth.items() if i % 3 == 0], "doc_id long, quality int")
    seen = []
    strength = C._strength
    monkeypatch.setattr(C, "_strength", lambda *a: seen.append((strength(*a), a[3])) or seen[-1][0])
    found = C.classify_quality(docs, labels).collect()
    (host_strength, mean), (path_strength, _) = seen
    share = (sum(truth[i] for i in range(0, len(rows), 3)) + 1) / (len(range(0, len(rows), 3)) + 2)
    own = {r.doc_id: 1 / (1 + math.exp(-r.evidence) * (1 - share) / share) for r in found}
    at = lambda level: {k: [own[r.doc_id] for r in found if r[level] == k] for k in {r[level] for r in found}}
    hosts, paths, changed = at("host"), at("path"), 0
    for r in found:
        h, p, me = hosts[r.host], paths[r.path], own[r.doc_id]
        prior = (sum(h) - me + host_strength * mean) / (len(h) - 1 + host_strength)
        if len(p) < len(h):
            prior = (sum(p) - me + path_strength * prior) / (len(p) - 1 + path_strength)
        odds = math.exp(r.evidence) * prior / (1 - prior)
        assert r.site_prior == pytest.approx(prior) and r.quality == pytest.approx(odds / (1 + odds))
        changed += r.kept != (odds * (1 - prior) / prior * share / (1 - share) >= 0.5)
        assert (r["_n"], r["_good"], r.host_n) == (1, 2, 3)
    assert changed > 0  # the sites change decisions that the text alone would make
    one = {r.path: r.site_prior for r in found if r.host == "mixed.org"}
    assert one["mixed.org/x"] > one["mixed.org/y"]


def test_kernel_and_ridge_equal_a_dense_version():
    """Nystroem features and one-versus-rest ridge from plain n-gram sets, on texts of one piece."""
    rnd = random.Random(5)
    make = lambda letters: " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(2, 6))) for _ in range(20))
    samples = [(lang, make(letters)) for lang, letters in (("a", "abcde"), ("b", "defgh"), ("c", "hijka")) for _ in range(20)]
    grams = I.Grams()
    sets = [set(grams.bins(t).tolist()) for _, t in samples]
    kernel = lambda x, y: len(x & y) / math.sqrt(len(x) * len(y))
    marks = [s for i, s in enumerate(sets) if i % 20 < 8]
    k = np.array([[kernel(x, y) for y in marks] for x in marks])
    values, vectors = np.linalg.eigh(k)
    root = vectors / np.sqrt(values) @ vectors.T
    z = np.array([[kernel(x, y) for y in marks] for x in sets]) @ root
    model = I.fit([(lang, grams.row(t)) for lang, t in samples], landmarks_per_language=8)
    for j, name in enumerate("abc"):
        y = np.array([float(lang == name) for lang, _ in samples])
        mean = z.mean(axis=0)
        w = np.linalg.solve((z - mean).T @ (z - mean) / len(z) + 1e-2 * np.eye(len(marks)), (z - mean).T @ (y - y.mean()) / len(z))
        new = [make("abcde"), make("hijka"), make("defgh")]
        want = [np.array([kernel(set(grams.bins(t).tolist()), m) for m in marks]) @ root @ w + y.mean() - mean @ w for t in new]
        assert model.scores([grams.row(t) for t in new])[:, j] == pytest.approx(want, abs=1e-3)


PAGE = """<html><head><title>T</title></head><body><header><a href=/>Site</a><p>Tagline here.</p></header>
<div class="cookie-banner"><p>We use cookies, to make this site better. Read our policy.</p></div><nav><ul><li><a href=a>A</a><li><a href=b>B</a></ul></nav>
<article><h1>The &amp; title</h1><p>First   paragraph,<br>with &eacute; and enough text to be content.<script>var x = "</p>";</script>
<p>Second <b>one</b>.<div class="ad">Buy this now, please, it is very good indeed.</div><ul><li>item one<li>item two</ul>
<section id="comments"><h3>Comments</h3><p>I do not agree with this at all, it is a long comment.</p></section></article>
<aside>Related things, to read.</aside><form><label>Mail</label><input></form><footer>&copy; me</footer>"""


def test_main_text(spark):
    assert H.main_text(PAGE) == ("The & title\n\nFirst paragraph, with é and enough text to be content.\n\nSecond one.\n\nitem one\n\nitem two")
    rows = [(1, "u", PAGE), (2, None, None), (None, "v", ""), (4, "w", "<p>" * 5000 + "x" * 100000 + "<a <b '"), (4, "w", "<!-- never closed")]
    got = H.extract_main_text(spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")).collect()
    assert [(r.page_id, r.url, r.n_chars == len(r.text)) for r in got] == [(a, b, True) for a, b, _ in rows]
    assert [r.text for r in got][1:3] == ["", ""]
    assert H.extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_marks_of_wrappers_do_not_empty_a_page():
    article = "<h1>The title</h1>" + "".join(f"<p>Paragraph {i}, with enough words in it to be content, as one sees.</p>" for i in range(6))
    text = H.main_text(f"<article>{article}</article>")
    assert text.count("Paragraph") == 6
    ad, card = '<div class="ad">Buy this now, please, it is very good indeed.</div>', "<article><p>Another story, to read after this one, of some length.</p></article>"
    remarks = '<section id="comments"><article><p>I do not agree with this at all, it is a long comment.</p></article></section>' * 3
    for opened in ('<div class="layout has-sidebar">', "<div id=form-page role=search>", "<form action=x>", '<main><div class="no-sidebar">'):
        page = f"<body>{opened}<article>{article}{ad}{remarks}</article><div class='related'>{card * 3}</div><div class=sidebar><p>A word, on us.</p></div>"
        assert H.main_text(page) == text, opened
    for opened in ('<div class="has-sidebar">', '<main><h1>The title</h1><div class="has-sidebar">'):
        assert H.main_text(f"{opened}<div>{article}</div>").count("Paragraph") == 6, opened
    assert H.main_text(f"<article>{article}</article><div class=related>{card * 3}</div>") == text
    assert H.main_text(f"<div title='hidden gems' data-hidden alt='class=ad' x-role=menu><article>{article}</article></div>") == text
    for opened in ("<div hidden>", '<div style="display: none">', "<aside>", "<nav>"):
        assert H.main_text(f"{opened}<article>{article}</article>") == ""
    assert H.main_text('<div class="cookie-banner"><p>We use cookies, to make this site better. Read our policy.</p></div>') == ""


def test_soft_marks_weigh_on_an_article_without_settling_it():
    long = "This is the first sentence of a long paragraph, which goes on. Here is another one, with words; and a third follows it."
    article = f"<h1>The title</h1><p>{long}</p>"
    for mark in ("share", "Form", "promo-code"):
        for page in (f"<article>{article}<div class='{mark}'><p>{long}</p></div><p>{long}</p></article>",
                     f"<main>{article}<p>{long}</p><div class='{mark}'>{long}</div></main>"):
            assert H.main_text(page).count("a third") == 3, (mark, page)
        assert H.main_text(f"<article>{article}<div class='{mark}'>Share this</div><p>{long}</p></article>").count("Share") == 0
        assert H.main_text(f"<div class='{mark}'><p>{long}</p></div><article>{article}</article>").count("a third") == 1
    assert H.main_text(f"<article>{article}<section id=comments><p>{long * 3}</p></section></article>").count("a third") == 1


def test_the_cut_turns_blocks_that_the_classifier_gets_wrong():
    article = "<article><h1>T</h1><p>Short</p><ul><li><a href=x>one</a><li><a href=y>two</a></ul><table><tr><td>1<td>2</table></article>"
    menu = "<nav><ul><li><a href=a>A</a><li>B</ul></nav>"
    blocks = H.page_blocks(f"<body>{menu}{article}<footer>&copy; me</footer></body>")
    labels, turned = H.label_blocks(blocks)
    assert [t for (t, _, _), x in zip(blocks, labels) if x] == ["T", "Short", "one", "two", "1", "2"] and turned >= 2
    # Without an article, blocks between content blocks go with them.
    prose = "<p>A paragraph of some length, with commas, and with stops. It goes on, as they do.</p>"
    blocks = H.page_blocks(f"<div>{prose}<div>so it was</div>{prose}</div>")
    labels, turned = H.label_blocks(blocks)
    assert labels == [True] * 3 and turned == 1


@pytest.mark.parametrize("hidden", [False, True])
def test_fitted_costs_on_pages_whose_article_is_hidden(spark, hidden):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    weights = H.fit_weights(H.sample_pages(pages, 64, 32768))
    assert weights != H.WEIGHTS and weights[list(H.PRIOR).index("paragraph")] > 0
    right = wrong = missed = 0
    for page in (r.html for r in pages.select("html").collect()):
        truth = [box.article for _, box, _ in H.page_blocks(page)]
        seen = H.page_blocks(page.replace("<article>", "<div>").replace("</article>", "</div>") if hidden else page)
        for want, got in zip(truth, H.label_blocks(seen, weights)[0], strict=True):
            right += want and got
            wrong += got and not want
            missed += want and not got
    assert right / (right + wrong) >= 0.99 and right / (right + missed) >= 0.99


def test_pages_without_an_article_keep_the_stated_weights(spark):
    pages = spark.createDataFrame([(1, "<p>One, two.</p>"), (2, None), (None, "")], "page_id long, html string")
    assert H.sample_pages(pages, 8, 1000) == [] and H.fit_weights([]) == H.WEIGHTS
    many = spark.range(400).selectExpr("id AS page_id", "concat('<article><p>Page ', id, '.</p></article><p>x</p>') AS html")
    found = H.sample_pages(many, 16, 1000)
    assert len(found) == 16 == len(set(found)) and found == H.sample_pages(many.repartition(7), 16, 1000)
    assert H.sample_pages(many, 16, 10) == []


def test_minimum_cut_is_minimal():
    rnd = random.Random(7)
    for _ in range(300):
        n = rnd.randint(1, 8)
        weight = [rnd.uniform(-2, 2) for _ in range(n)]
        edges = {(i, j): rnd.random() * 1.5 for i in range(n) for j in range(i + 1, n) if rnd.random() < 0.4}
        cost = lambda labels: sum(abs(w) for w, x in zip(weight, labels) if (w > 0) != x) + sum(
            c for (i, j), c in edges.items() if labels[i] != labels[j])
        best = min(cost([bool(k >> i & 1) for i in range(n)]) for k in range(2 ** n))
        assert cost(H.minimum_cut(weight, edges)) == pytest.approx(best)


def brute_hits(text, items):
    w = D.normal_words(text)
    hit, found = set(), set()
    for item, t in items:
        for win in D.item_windows(t, 10):
            p = list(win)
            for i in range(len(w) - len(p) + 1):
                if w[i:i + len(p)] == p:
                    hit.update(range(i, i + len(p)))
                    found |= {item} if item is not None else set()
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("max_nodes", [1_000_000, 1000])
def test_benchmark_text_equals_brute_force(spark, odd, empty, max_nodes):
    rnd = random.Random(9)
    text = lambda n: " ".join(rnd.choice(["Ab", "c-d", "é", "x1", "Q"]) for _ in range(n))
    items = [(i, text(rnd.choice([1, 3, 12, 25]))) for i in range(5, 15)] + [(3, None), (4, "!!"), (None, "é é é é"), (5, "another answer")]
    rows = [(i, text(rnd.randint(0, 200)) + "\n" + rnd.choice(items)[1].__str__() + "!") for i in range(40)] + [(50, None), (51, "")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_hit int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r for r in D.find_benchmark_text(docs, bench, max_nodes=max_nodes).collect()}
    for d, t in rows:
        n, hits, found = brute_hits(t, items)
        r = got[d]
        assert (r.n_words, r.n_hit, r["items"], r.contaminated) == (n, hits, found, hits > 0)
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        for a, b in D.original_offsets(t, [tuple(s) for s in r.spans]) if t else []:
            assert D.normal_words(t[a:b])
    assert D.find_benchmark_text(empty, bench).count() == 0
    assert not any(r.contaminated for r in D.find_benchmark_text(odd, bench.limit(0)).collect())


def test_benchmark_scan_gives_the_automaton_only_stretches_that_can_hold_a_window():
    class Counting:
        def __init__(self, automaton):
            self.automaton, self.letters = automaton, 0

        def iter(self, letters):
            self.letters += len(letters)
            return self.automaton.iter(letters)

    item = " ".join(f"w{i}" for i in range(40))
    numbers, automaton, *rest = D.build_automaton([(7, item)], 10)
    counting = Counting(automaton)
    text = " ".join(f"w{i * 7 % 40}" for i in range(2000)) + " " + item + " plain words" * 1000  # known words, other neighbours
    assert D.scan(numbers, counting, *rest, text) == (4040, [(2000, 2039)], {7})
    assert counting.letters == 40


def test_benchmark_scan_equals_brute_force_for_windows_of_any_length():
    rnd = random.Random(4)
    text = lambda n: "".join(rnd.choice(["Ab", "c", "é", "x1", "Ω"]) + rnd.choice([" ", "-", "\t", "\x00", "\x7f\n"]) for _ in range(n))
    for _ in range(200):
        items = [(i, text(rnd.choice([0, 1, 2, 3, 9, 10, 11, 14]))) for i in range(rnd.randint(0, 4))] + [(None, text(2))] * rnd.randint(0, 1)
        windows = D.build_automaton(items, 10)
        for t in [text(rnd.randint(0, 30)) + (items[-1][1] if items else "") + text(3), "", "!", None]:
            n, spans, found = D.scan(*windows, t)
            assert (n, sum(b - a + 1 for a, b in spans), sorted(found)) == brute_hits(t, items)
            assert all(b + 1 < c for (_, b), (c, _) in zip(spans, spans[1:]))
    odd = "".join(map(chr, range(0x300))) + "\u2028\u3000\U0001F600"
    assert odd.encode().translate(D.TO_WORDS).split() == [w.encode() for w in D.normal_words(odd)]


def test_every_operator_has_a_query():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
