import base64
import hashlib
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import measures
from firelark.llm import html_text, mixing, quality_crf, quality_rules, token_counts, toxicity, warc
from firelark.llm.shared import new_path


CLASH = ["_id", "y", "_rows", "host", "token", "sig", "score", "passages", "n_words", "t", "w", "g", "s", "first", "d", "d2", "first_", "page", "quality", "kept", "_prose", "n_bytes", "count"]


def wide(df):
    """df with more columns, named like those that operators use within."""
    return df.select("*", *(F.lit(3).alias(c) for c in CLASH if c not in df.columns))


def test_clashing_columns_and_repeated_ids(spark, make, corpus, vocabulary):
    """The same rows from a table with clashing columns and repeated ids as from a plain one."""
    rows = [*corpus.items(), *list(corpus.items())[:30], (5, "another text"), (None, "no id"), (200, "long " * 100_000)]
    plain, labels = make(rows).select("doc_id", "text"), spark.createDataFrame([(i, i % 2, i % 3 == 0, 1) for i in range(100)] + [(5, 0, True, 1)], "doc_id long, quality int, toxic boolean, text int").withColumn("toxic", F.col("toxic").cast("int"))
    same = lambda f: sorted(map(str, f(plain).collect())) == sorted(map(str, f(wide(make(rows))).collect()))
    model = toxicity.Model({"w1": 1.0}, -0.5, weights=(-2.0, 0.4, 0.6))
    for f in (lambda d: toxicity.toxicity_scores(d, model), lambda d: toxicity.without_toxic(d, model).select("doc_id", "text"), lambda d: quality_rules.quality_rules(d), lambda d: token_counts.token_counts(d, vocabulary)):
        assert same(f)
    assert toxicity.fit(wide(make(rows)), labels).weights == toxicity.fit(plain, labels).weights
    a, b = (quality_crf.fit(d, labels) for d in (plain, wide(make(rows))))
    assert np.allclose(a.weights, b.weights) and same(lambda d: quality_crf.quality_scores(d, a))
    pages = spark.createDataFrame([(i % 7, f"http://h/{i % 5}", f"<p>one {i % 3}</p>") for i in range(20)] + [(2**62, None, None), (-5, "u", "<b>")], "page_id long, url string, html string")
    for f in (lambda p: html_text.main_text(p), lambda p: warc.capture_history(p).drop("archive", "record_offset")):
        assert sorted(map(str, f(pages).collect())) == sorted(map(str, f(wide(pages)).collect())) and f(pages).count() == 22


# toxicity


def brute_segments(s):
    """Maximal scoring segments by their definition: the best segment, then the same on both sides of it."""
    out = []

    def go(lo, hi):
        best = None
        for a in range(lo, hi):
            t = 0.0
            for b in range(a, hi):
                t += s[b]
                if t > 1e-9 and (best is None or t > best[2] + 1e-9):
                    best = (a, b + 1, t)
        if best:
            go(lo, best[0])
            out.append(best)
            go(best[1], hi)

    go(0, len(s))
    return out


def test_segments():
    rnd = np.random.default_rng(2)
    for n in range(0, 60):
        s = np.round(rnd.normal(-0.2, 1, n), 3)
        got = toxicity.segments(s)
        want = brute_segments(s)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert np.allclose([x[2] for x in got], [x[2] for x in want])


def labelled(make, spark, bad, n=240):
    rnd = random.Random(8)
    texts, labels = [], []
    for i in range(n):
        w = [f"word{rnd.choice('abcdefghij')}{rnd.choice('klmnop')}" for _ in range(rnd.randrange(20, 60))]
        y = i % 4 == 0
        texts.append((i, bad(rnd, w) if y else " ".join(w)))
        labels.append((i, int(y), int(not y)))
    return make(texts), spark.createDataFrame([*labels, (None, 1, 1), (5000, None, None)], "doc_id long, toxic int, quality int")


def insult(rnd, w):
    for _ in range(4):
        w[rnd.randrange(len(w))] = rnd.choice(["vileword", "nastyword", "badword"])
    return " ".join(w)


def test_toxicity(spark, make):
    docs, labels = labelled(make, spark, insult)
    model = toxicity.fit(docs, labels.where(~toxicity.held_out("doc_id", 4, 2)))
    got = {r["doc_id"]: r for r in toxicity.toxicity_scores(docs, model).collect()}
    assert all((got[i]["score"] >= 0.3) == (i % 4 == 0) for i in got)
    assert all(got[i]["passages"] for i in got if i % 4 == 0)
    odd = make([(1, None), (1, None), (2, ""), (3, "12 !!"), (4, "vileword nastyword " * 20_000)])
    scores = [r["score"] for r in toxicity.toxicity_scores(odd, model).orderBy("doc_id").collect()]
    assert len(scores) == 5 and all(0 <= s < 0.3 for s in scores[:4]) and scores[4] > 0.9
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i in range(240) if i % 4}
    none = toxicity.fit(docs, labels.where("false"))
    assert {r["score"] for r in toxicity.toxicity_scores(docs, none).collect()} < {x for x in [toxicity.Model({}, -1).score(0, [])]} | {0.0}
    assert toxicity.toxicity_scores(docs.where("false"), model).collect() == []


def test_toxicity_by_brute_force(make, corpus):
    """Scores and passages of short texts from the definitions: best segments by search, chance by the law, logistic of both."""
    import math

    terms = {"vile": 2.0131, "nasty": 1.4717, "badwo-": 1.0371, "badw-": 0.7113, "w1": 0.4}
    m = toxicity.Model(terms, -0.5179, 1.2, 0.3, (-2.0, 0.4, 0.6), 0.05)
    rnd = random.Random(3)
    texts = {i: " ".join(rnd.choice(["vile", "Nasty", "badword", "badwx", "badwxyz", "plain", "x", "w1", "12"]) for _ in range(rnd.randrange(40))) for i in range(60)} | {100: None, 101: ""}

    def plain(text):
        words = re.findall(r"[^\W\d_]+", (text or "").lower())
        of = lambda w: terms[w] if w in terms else next((terms[w[:n] + "-"] for n in (7, 6, 5, 4) if len(w) > n and w[:n] + "-" in terms), -0.5179)
        segs = brute_segments([of(w) for w in words])
        chance = lambda s: 0.3 * len(words) * math.exp(-1.2 * s)
        some = [x for x in segs if chance(x[2]) < 0.05]
        a = -math.log(max(1 - math.exp(-chance(max(x[2] for x in segs))), 1e-12)) if segs else 0.0
        return 1 / (1 + math.exp(-(-2 + 0.4 * a + 0.6 * (math.log1p(sum(x[2] for x in some)) if segs else 0.0)))), [(a, b) for a, b, _ in some]

    got = {r["doc_id"]: r for r in toxicity.toxicity_scores(make(texts.items()), m).collect()}
    assert set(got) == set(texts) and any(r["passages"] for r in got.values())
    for i, t in texts.items():
        score, passages = plain(t)
        assert abs(got[i]["score"] - score) < 1e-9 and [(p["start"], p["end"]) for p in got[i]["passages"]] == passages


# quality by lines


def test_quality_by_enumeration(make):
    """Document scores from all labellings of a text's lines."""
    import itertools
    import math

    rnd = np.random.default_rng(9)
    m = quality_crf.Model(rnd.normal(size=2 * quality_crf.N_OWN), rnd.normal(size=(2, 2)), (-0.3, 0.5, 0.7))
    pick = random.Random(4)
    texts = {i: "\n".join(pick.choice(["A plain line.", "JUNK!! JUNK!!", "a | b | c", "12 34", "", "word " * 9]) for _ in range(pick.randrange(1, 7))) for i in range(25)}
    got = {r["doc_id"]: r for r in quality_crf.quality_scores(make(texts.items()), m).collect()}
    for i, text in texts.items():
        f, size = quality_crf.line_features(text)
        assert [len(x) for x in text.split("\n") if x.strip()] == size.tolist()
        around = np.array([sum((f[j] / 2 for j in (k - 1, k + 1) if 0 <= j < len(f)), np.zeros(f.shape[1])) for k in range(len(f))]).reshape(len(f), -1)
        u = np.concatenate((f, around), axis=1) @ m.weights if len(f) else []
        good, total = np.zeros(len(f)), 0.0
        for y in itertools.product((0, 1), repeat=len(f)):
            p = math.exp(sum(a * b for a, b in zip(u, y)) + sum(m.transition[a, b] for a, b in zip(y, y[1:])))
            good, total = good + p * np.array(y), total + p
        p = np.clip(good / total, 1e-4, 1 - 1e-4) if len(f) else np.array([0.5])
        w = size if len(f) else np.array([1.0])
        z = -0.3 + 0.5 * (np.average(np.log(p / (1 - p)), weights=w) if len(f) else 0) + 0.7 * np.average(p, weights=w)
        assert abs(got[i]["score"] - 1 / (1 + math.exp(-z))) < 1e-5 and got[i]["n_lines"] == len(f)


def test_marginals_by_enumeration():
    rnd = np.random.default_rng(1)
    for n in (1, 2, 5):
        u, t = rnd.normal(size=n), rnd.normal(size=(2, 2))
        want, total = np.zeros(n), 0.0
        for code in range(1 << n):
            y = [(code >> i) & 1 for i in range(n)]
            p = np.exp(sum(u[i] * y[i] for i in range(n)) + sum(t[a, b] for a, b in zip(y, y[1:])))
            want += p * np.array(y)
            total += p
        assert np.allclose(quality_crf.marginals(u, t), want / total)


def junk(rnd, w):
    return "\n".join(" ".join(x.upper() + "!!" for x in w[i : i + 6]) for i in range(0, len(w), 6)) + "\nplain end line"


def test_quality(spark, make):
    docs, labels = labelled(make, spark, junk)
    model = quality_crf.fit(docs, labels.where(~toxicity.held_out("doc_id", 5, 0)))
    got = {r["doc_id"]: r["score"] for r in quality_crf.quality_scores(docs, model).collect()}
    assert np.mean([(got[i] >= 0.3) == bool(i % 4) for i in got]) > 0.98
    odd = make([(1, None), (2, ""), (2, " \n "), (3, "a line\n" * 30_000), (4, "x" * 200_000)])
    assert all(0 <= r["score"] <= 1 for r in quality_crf.quality_scores(odd, model).collect())
    assert quality_crf.quality_scores(docs.where("false"), model).collect() == []
    assert quality_crf.fit(docs, labels.where("false")).score((0.0, 0.5)) < 0.01


# tokens


@pytest.fixture(scope="module")
def vocabulary():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def test_token_counts(make, corpus, vocabulary):
    from tokenizers import Tokenizer

    texts = dict(corpus) | {200: "a<|endoftext|>  b\n\n c", 201: "it's we'll I'M ''s", 202: " \x85　 x\x1cy", 203: "x" * 5000, 204: "日本語 漢字 ١٢٣ ² Ⅷ", 205: "  lead and trail  \n", 206: "<|endoftext|>"}
    t = Tokenizer.from_file(vocabulary)
    want = {i: len(t.encode(x or "", add_special_tokens=False).ids) for i, x in texts.items()}
    got = {r["doc_id"]: r for r in token_counts.token_counts(make(texts.items()), vocabulary, 50).collect()}
    assert {i: r["n_tokens"] for i, r in got.items()} == want
    assert all(r["n_bytes"] == len((texts[i] or "").encode()) and r["over_limit"] == (want[i] > 50) for i, r in got.items())
    assert all(r["cut_byte"] == r["n_bytes"] for r in got.values() if not r["over_limit"])
    ends = {r["doc_id"]: r for r in token_counts.prefix_table(make(texts.items()), vocabulary).collect()}
    assert all((r["tokens"] or [0])[-1] == want[i] for i, r in ends.items())


def test_every_prefix_of_a_piece(vocabulary):
    from tokenizers import Tokenizer

    t, c = Tokenizer.from_file(vocabulary), token_counts.counter(vocabulary)
    for word in (" internationalization", "aaaaaaaaaaaa", "donaudampfschiff", "thththeereror"):
        counts, _ = c.table(word.encode())
        assert counts[1:] == [len(t.encode(word[:i], add_special_tokens=False).ids) for i in range(1, len(word) + 1)]


# rules


def test_measures(make, corpus):
    got = quality_rules.quality_rules(make(corpus.items())).collect()
    for r in got:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == measures(corpus[r["doc_id"]])
        assert r["base_failed"] == (r["n_words"] < 50 or 2 * r["n_repeat_words"] > r["n_words"])
        assert not (r["kept"] and r["base_failed"])
    assert len(got) == len(corpus)


def test_rules_keep_and_drop(make):
    rnd = random.Random(2)
    prose = lambda: " ".join(f"word{rnd.randrange(400)}" for _ in range(80))
    texts = {i: prose() for i in range(80)} | {i: " ".join(w + "###" for w in prose().split()) for i in range(80, 100)} | {i: prose().upper().replace(" ", "!! ") for i in range(100, 106)}
    kept = {r["doc_id"] for r in quality_rules.quality_rules(make(texts.items())).where("kept").collect()}
    assert kept == set(range(80))
    assert quality_rules.quality_rules(make([]).where("false")).collect() == []


def test_learned_accuracies_fit_the_labels(spark, sf):
    """What EM learns without labels about the rules is near what the labels say."""
    docs, labels = spark.read.parquet(f"{sf}/../sf0.01/documents.parquet"), spark.read.parquet(f"{sf}/../sf0.01/labels.parquet")
    rules = quality_rules.votes()
    voted = quality_rules.measures(docs).where("n_words > 0").select("doc_id", F.struct(*(v.alias(r) for r, v in rules.items())).alias("v"))
    share, right = quality_rules.fit([(r["v"].asDict(), r["count"]) for r in voted.groupBy("v").count().collect()], list(rules))
    rows = voted.join(labels, "doc_id").where("quality IS NOT NULL").collect()
    for r in rules:
        good, bad = ([x["v"][r] for x in rows if x["quality"] == q and x["v"][r]] for q in (1, 0))
        assert abs(right[r][0] - np.mean([v > 0 for v in good])) < 0.05 and abs(right[r][1] - np.mean([v < 0 for v in bad])) < 0.25, (r, right[r])


def test_verdicts_by_brute_force(make):
    """EM and posteriors of whole documents, one by one instead of by pattern, from counts of their own."""
    rnd = random.Random(12)
    prose = lambda n=80: " ".join(f"word{rnd.randrange(400)}" for _ in range(n))
    texts = {i: prose() for i in range(50)} | {i: " ".join(w + "###" for w in prose().split()) for i in range(50, 62)} | {i: prose().upper().replace(" ", "!! ") for i in range(62, 70)}
    texts |= {i: "same line here\n" * 30 for i in range(70, 74)} | {i: prose(10) for i in range(74, 77)} | {77: None, 78: "", 79: prose() + "!! A#"}

    def votes(t):
        n, chars, symbols, dup, again = measures(t)
        w, lines, n1, c1 = (t or "").split(), [x for x in (t or "").split("\n") if x.strip()], max(n, 1), max(chars, 1)
        shouts, capitals = (t or "").count("!!"), sum(c.isupper() for c in t or "")
        tri = lambda bad, good: -1 if bad else int(good)
        size, kinds = chars / n1, len(set(w)) / n1
        return {
            "symbols": tri(symbols / n1 > 0.25, symbols / n1 < 0.02), "symbol_chars": tri(symbols / c1 > 0.05, symbols / c1 < 0.004), "shouts": tri(shouts / n1 > 0.15, shouts / n1 < 0.02),
            "capitals": tri(capitals / c1 > 0.4, capitals / c1 < 0.2), "repeats": tri(again / n1 > 0.35, again / n1 < 0.15), "lines": tri(dup >= 4 and dup * 5 > len(lines), dup == 0),
            "variety": tri(n >= 50 and kinds < 0.08, n >= 50 and kinds > 0.2), "word_length": tri(size > 14 or size < 2, 3 <= size <= 9),
        }

    seen = {i: votes(t) for i, t in texts.items()}
    known = [v for i, v in seen.items() if measures(texts[i])[0]]
    share, on_good, on_bad = 0.8, dict.fromkeys(known[0], 0.99), dict.fromkeys(known[0], 0.3)

    def posterior(v):
        like = [share, 1 - share]  # of good and bad, by the product of all votes
        for r, x in v.items():
            if x:
                like[0] *= on_good[r] if x > 0 else 1 - on_good[r]
                like[1] *= on_bad[r] if x < 0 else 1 - on_bad[r]
        return like[0] / sum(like)

    for _ in range(40):
        p, m = [posterior(v) for v in known], 0.05 * len(known)
        share = min(0.99, max(0.01, sum(p) / len(p)))
        for r in known[0]:
            who = [(q, v[r]) for q, v in zip(p, known) if v[r]]
            on_good[r] = min(0.999, max(0.5, (sum(q for q, x in who if x > 0) + 0.99 * m) / (sum(q for q, _ in who) + m)))
            on_bad[r] = min(0.95, max(0.02, (sum(1 - q for q, x in who if x < 0) + 0.3 * m * (1 - share)) / (sum(1 - q for q, _ in who) + m * (1 - share))))
    for r in quality_rules.quality_rules(make(texts.items())).collect():
        n, _, _, _, again = measures(texts[r["doc_id"]])
        want = posterior(seen[r["doc_id"]]) if n else 0.0
        assert abs(r["quality"] - want) < 1e-9 and r["kept"] == (n >= 50 and 2 * again <= n and want >= 0.5)


# WARC


def test_loser_tree():
    rnd = random.Random(3)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted((rnd.randrange(50), "x", i) for _ in range(rnd.randrange(30))) for i in range(k)]
        runs = [[(a, b, c) for a, b, c in r] for r in runs]
        assert [r[0] for r in warc.loser_tree(runs)] == sorted(x[0] for r in runs for x in r)


def test_warc(spark, monkeypatch):
    html = {0: "<p>a</p>", 1: None, 2: "", 3: "<p>a</p>", 4: "é🌍" * 50_000, 5: "<p>a</p>", 6: "WARC/1.1\r\n\r\nx", 7: "é🌍" * 50_000}
    url = {i: f"http://www.Host{i % 3}.example.com:80/p/{9 - i}#f" for i in html} | {6: None}
    pages = spark.createDataFrame([(i, url[i], html[i], "x") for i in html] + [(None, "u", "h", "x")], "page_id long, url string, html string, first string").repartition(5)
    first = {}
    for i in sorted(html):
        first.setdefault(html[i] or "", i)
    for fan in (256, 2):
        monkeypatch.setattr(warc, "FAN_IN", fan)
        monkeypatch.setattr(warc, "SPARSE", 2)
        rows = warc.capture_history(pages, tasks=3).collect()
        assert [(r["url_key"], r["timestamp"]) for r in rows] == sorted((r["url_key"], r["timestamp"]) for r in rows)
        assert sorted(r["page_id"] for r in rows) == sorted(html)
        for r in rows:
            raw, one = (html[r["page_id"]] or "").encode(), first[html[r["page_id"]] or ""]
            assert r["payload_bytes"] == len(raw) and r["payload_digest"] == base64.b32encode(hashlib.sha1(raw).digest()).decode()
            assert (r["record_type"], r["refers_to"]) == (("response", None) if one == r["page_id"] else ("revisit", one))
    assert warc.url_key("http://www.Host0.example.com:80/p/9#f") == "com,example,host0)/p/9"
    assert all(r["record_type"] == "response" for r in warc.capture_history(pages, min_bytes=10**9).collect())
    assert warc.capture_history(pages.where("false")).collect() == []


def test_archive_round_trip(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", "text %d" % i * i) for i in range(50)], "page_id long, url string, html string")
    folder = new_path(spark, "t")
    files = warc.write_archives(pages, folder)
    system, path = warc._open(folder)
    got = {}
    for name, _ in files:
        with system.open_input_stream(f"{path}/{name}") as f:
            for _, h, block in warc.read_records(f):
                got[h["WARC-Record-ID"]] = block.partition(b"\r\n\r\n")[2].decode()
    assert got == {f"<urn:page:{i}>": "text %d" % i * i for i in range(50)}


# HTML


PAGE = """<html><head><title>T{i}</title><style>p{{x:1}}</style><script>var t="</p>";</script></head><body><header><h2>Site</h2></header>
<nav><ul><li><a href="/a{i}">menu{i}</a></li></ul></nav><div class="cookie-notice">We use cookies</div><!-- c {i} --><div class="ad">buy {i}</div>
<article><h1>Head &amp; {i}</h1><p><b>First  <i>para</i>{i}<br>after<p>Second &eacute; {i}</p><form><input><p>sign up</p></form><div class="comments"><p>reader {i}</p></div></article>
<aside>side {i}</aside><footer>&copy; {i}</footer></body></html>"""


def test_main_text(spark):
    rows = [(i, f"http://h.example/{i}", PAGE.format(i=i)) for i in range(12)] + [(50, "http://o/", None), (51, None, ""), (52, "bad url", "plain <b>te</b>xt"), (53, "http://h.example/x", "<div class=content>one<div>two</div>three" + " four" * 30_000)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, host string")
    got = {r["page_id"]: r for r in html_text.main_text(pages).collect()}
    for i in range(12):
        assert got[i]["text"] == f"Head & {i}\nFirst para{i}\nafter\nSecond é {i}"
    assert got[50]["text"] == got[51]["text"] == "" and got[52]["text"] == "plain text"
    assert got[53]["text"].startswith("one\ntwo\nthree four four") and all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert html_text.main_text(pages.where("false")).collect() == []


def test_template_text_goes(spark):
    """Text of a valid class is template even where no tag says so."""
    page = "<html><body><div><p>Welcome to our site</p><p>Top stories today</p><p>unique {i} text</p><p>All rights kept</p></div></body></html>"
    pages = spark.createDataFrame([(i, f"http://t.example/{i}", page.format(i=i)) for i in range(9)], "page_id long, url string, html string")
    assert {r["text"] for r in html_text.main_text(pages).collect()} == {f"unique {i} text" for i in range(9)}


def html_texts(spark, pages):
    rows = spark.createDataFrame([(i, f"http://t.example/{i}", "<html><body>" + p + "</body></html>") for i, p in enumerate(pages)], "page_id long, url string, html string")
    return [r["text"] for r in html_text.main_text(rows).orderBy("page_id").collect()]


def test_repeated_template_text_goes(spark):
    """A class of several occurrences a page nests in the frame: its text goes, the text between its tokens stays."""
    item = "<section><h3>title {i} {j}</h3><blockquote>body {i} {j}</blockquote><h4>Read more</h4></section>"
    pages = ["<p>Welcome</p><p>Top stories</p>" + "".join(item.format(i=i, j=j) for j in range(2 + i % 4)) + "<p>All rights kept</p>" for i in range(9)]
    assert html_texts(spark, pages) == ["\n".join(f"title {i} {j}\nbody {i} {j}" for j in range(2 + i % 4)) for i in range(9)]
    # rounds that differ in order are no template
    mixed = ["<p>Welcome</p><p>Top stories</p><p>All rights kept</p>" + "".join(f"<p>{x}</p>" * 2 for x in (["Uno", "Due", "Tre"] if i % 2 else ["Tre", "Due", "Uno"])) for i in range(8)]
    assert all("Uno" in t and "Welcome" not in t for t in html_texts(spark, mixed))


def test_template_by_order_not_place(spark):
    """1 to 50 paragraphs before an unmarked footer: the tokens' order holds, their places do not."""
    pages = ["<p>Welcome</p><p>Top stories</p>" + "".join(f"<p>para {i} {j}</p>" for j in range(1 + 7 * i)) + "<p>All rights kept</p>" for i in range(8)]
    assert html_texts(spark, pages) == ["\n".join(f"para {i} {j}" for j in range(1 + 7 * i)) for i in range(8)]


@pytest.mark.parametrize("page, text", [
    ("<div>story</div><aside><article>teaser</article></aside>", "story"),
    ("<div>story</div><section class=comments><article>I agree</article></section>", "story"),
    ("<div>story</div><article class=comment>I agree</article><article class='card teaser'>more</article>", "story"),
    ("<article>story</article><article class=comment>I agree</article>", "story"),
    ("<article>story<article class='comment reply'>I agree</article></article>", "story"),
    ("<article class='post category-social tag-ads has-sidebar'>story</article><div>beside</div>", "story"),
    ("<main><p>lead</p><article>story</article></main><div>beside</div>", "lead\nstory"),
    ("<main><p>story</p><article class=comment>I agree</article></main><div>beside</div>", "story"),
    ("<div>beside</div><nav><main>menu</main></nav>", "beside"),
    ("<article>story</article><main><nav>menu</nav></main>", "story"),
    ('<div class="wrap has-sidebar"><article><p>Main words here</p></article></div>', "Main words here"),
    ('<p>Site</p><div class="page-with-sidebar"><article><p>Main words here</p></article></div>', "Main words here"),
    ('<div id="search-algorithms"><p>Sorting and searching</p></div><div class="site-footer">about</div>', "Sorting and searching"),
    ('<div>story</div><div class="comments"><article>I agree at length with all of it</article></div>', "story"),
    ('<article><header><h1>Title</h1></header><p>story</p><footer>tags</footer></article>', "Title\nstory"),
    ("<header><h1>Site</h1></header><p>story</p>", "story"),
    ("<p>a\u200bb \ufeffc</p>", "a\u200bb \ufeffc"),
    ('<div class="nav">menu</div><div class="site-footer">about</div>', ""),
    ("<p>a < b and <a href=x>c</a></p><p>1 <2</p>", "a < b and c\n1 <2"),
])
def test_scope(page, text):
    assert html_text.extract(f"<html><body>{page}</body></html>") == text


@pytest.mark.parametrize("piece", ["<a ", "<a href='", '<a "', "<div>", "<!-- ", "<p", "</x>", "<b>&", "<div class=nav><p>"])
def test_pages_are_read_in_linear_time(piece):
    took = []
    for n in (4_000, 16_000):
        t = time.perf_counter()
        html_text.extract(piece * n)
        took.append(time.perf_counter() - t)
    assert took[1] < 12 * took[0] + 0.05


def brute_template(pages, min_pages=5, min_share=0.5, min_class=3):
    """Text tokens of the valid classes of a host's pages, from whole occurrence vectors and orders."""
    seqs = [html_text.blocks(p) for p in pages]
    texts = {b.token for _, found in seqs for b in found}
    counts = [Counter(tokens) for tokens, _ in seqs]
    vector = {t: tuple(c[t] for c in counts) for c in counts for t in c}
    frequent = [t for t, v in vector.items() if sum(map(bool, v)) >= max(min_pages, min_share * len(pages))]
    classes = {}
    for t in frequent:
        classes.setdefault(vector[t], set()).add(t)
    classes = {v: c for v, c in classes.items() if len(c) >= min_class}
    single = {v: c for v, c in classes.items() if max(v) == 1}

    def order(c, i):
        return [t for t in seqs[i][0] if t in c]

    def ordered(v, c):
        own = [order(c, i) for i in range(len(pages)) if v[i]]
        m = len(c)
        return all(len(o) % m == 0 and o == own[0][:m] * (len(o) // m) for o in own)

    valid = {v: c for v, c in classes.items() if ordered(v, c)}
    if len(single) == 1 and next(iter(single)) in valid:  # the frame: rounds lie within one of its slots
        frame = next(iter(single.values()))
        for v, c in list(valid.items()):
            if c is frame or max(v) == 1:
                continue
            for i, (tokens, _) in enumerate(seqs):
                slots, at = [], 0
                for t in tokens:
                    at += t in frame
                    if t in c:
                        slots.append(at)
                if any(len(set(slots[k : k + len(c)])) > 1 for k in range(0, len(slots), len(c))):
                    valid.pop(v, None)
    return {t for c in valid.values() for t in c if t in texts}


def test_template_by_brute_force(spark):
    """Templates of small random hosts without <article>: a frame, repeated parts, texts of their own, pages of other kinds."""
    rnd = random.Random(13)
    hosts = {}
    for h in range(12):
        head, foot = ([f"{x} {h} {i}" for i in range(rnd.randrange(1, 4))] for x in ("top", "end"))
        part = [f"part {h} {i}" for i in range(rnd.randrange(1, 5))]
        pages = []
        for i in range(rnd.randrange(5, 11)):
            middle = "".join(f"<p>own {h} {i} {j}</p>" + ("".join(f"<blockquote>{x}</blockquote>" for x in (part if rnd.random() < 0.9 or h % 3 else part[::-1])) if j % 2 else "") for j in range(rnd.randrange(1, 7)))
            pages.append("".join(f"<h2>{x}</h2>" for x in head) + middle + "".join(f"<h3>{x}</h3>" for x in foot))
        hosts[f"h{h}.example"] = pages
    rows = [(i, f"http://{h}/{i}", p, h) for h, pages in hosts.items() for i, p in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got: dict = {h: set() for h in hosts}
    for r in html_text.templates(df).collect():
        got[r["host"]].add(r["token"])
    want = {h: {html_text._hash(t) for t in brute_template(pages)} for h, pages in hosts.items()}
    assert got == want and sum(map(len, want.values())) > 20


# mixing


def test_cycle_meets_all_deadlines():
    rnd = random.Random(6)
    for _ in range(60):
        a = mixing.shares({i: rnd.random() + 0.01 for i in range(rnd.randrange(1, 12))}, 120)
        q, seen = sum(a.values()), dict.fromkeys(a, 0)
        for t, (s, k) in enumerate(mixing.one_cycle(a), 1):
            assert k == seen[s]
            seen[s] += 1
            assert all(abs(seen[x] * q - t * a[x]) < q for x in a)
        assert seen == a


def test_mixed(make):
    rnd = random.Random(9)
    source = {i: rnd.choice(["big"] * 6 + ["mid"] * 2 + ["low", None]) for i in range(700)}
    texts = [(i, f"t{i}") for i in range(700)]
    docs = make(texts, source)
    got = mixing.mixed(docs, {"big": 3.0, "mid": 2.0, "gone": 9.0}, block=4, cycle=20, piece=50).collect()
    assert sorted(r["mix_position"] for r in got) == list(range(700)) and {r["doc_id"] for r in got} == set(range(700))
    slots = {}
    for r in got:
        slots.setdefault(r["mix_slot"], set()).add((r["source"], r["mix_block"]))
    assert sorted(slots) == list(range(len(slots))) and all(len(x) == 1 for x in slots.values())
    counts = {s: sum(1 for x in source.values() if x == s) for s in set(source.values())}
    a = mixing.shares({s: {"big": 3.0, "mid": 2.0}.get(s, 2.0) for s in counts}, 20)
    q, seen, blocks = sum(a.values()), dict.fromkeys(counts, 0), {s: -(-n // 4) for s, n in counts.items()}
    for t in sorted(slots):
        (s, b), = slots[t]
        assert b == seen[s]
        seen[s] += 1
        assert all(abs(seen[x] * q - (t + 1) * a[x]) < q for x in a)
        if seen[s] == blocks[s]:
            break  # the first source ends: a new phase
    one_by_one(got, counts, {s: {"big": 3.0, "mid": 2.0}.get(s, 2.0) for s in counts}, 4, 20)
    assert mixing.mixed(docs.where("false")).collect() == []
    twice = mixing.mixed(make([(1, "a"), (1, "a"), (1, "b"), (None, None)]))
    assert sorted(r["mix_position"] for r in twice.collect()) == [0, 1, 2, 3]


def one_by_one(got, counts, weights, block, cycle):
    """All phases of a mix by a plain schedule that looks at every source in every slot."""
    a = mixing.shares(weights, cycle)
    left = {s: -(-n // block) for s, n in counts.items()}
    taken, place, slot = dict.fromkeys(counts, 0), 0, 0
    by_slot = {}
    for r in got:
        by_slot.setdefault(r["mix_slot"], []).append(r)
    while any(left.values()):
        live = [s for s in left if left[s]]
        q, t, mine = sum(a[s] for s in live), 0, dict.fromkeys(live, 0)
        while all(left[s] for s in live):
            released = [s for s in live if mine[s] * q // a[s] <= t]
            s = min(released, key=lambda s: (-(-(mine[s] + 1) * q // a[s]), str(s)))
            rows = sorted(by_slot[slot], key=lambda r: r["mix_position"])
            assert all((r["source"], r["mix_block"]) == (s, taken[s]) for r in rows)
            assert [r["mix_position"] for r in rows] == list(range(place, place + len(rows)))
            assert len(rows) == min(block, counts[s] - taken[s] * block)
            assert all(abs((mine[x] + (x == s)) * q - (t + 1) * a[x]) < q for x in live)
            place, slot, t = place + len(rows), slot + 1, t + 1
            taken[s], mine[s], left[s] = taken[s] + 1, mine[s] + 1, left[s] - 1


def test_mixed_edges(make):
    """Columns named like those used within, very many sources, blocks that grow, one long text."""
    texts = [(i % 900, f"t{i}") for i in range(1000)] + [(None, "x " * 300_000)]
    docs = make(texts)
    names = ["o", "p", "r", "s", "b", "t", "at", "before", "parts", "_o", "_p", "mix_slot"]
    wide = docs.select("*", *(F.concat(F.lit(c), F.col("text")).alias(c) for c in names))
    out = mixing.mixed(wide).collect()
    assert all(r[c] == c + r["text"] for r in out for c in names if c != "mix_slot") and len(out) == 1001
    many = docs.withColumn("source", F.concat(F.lit("s"), F.col("text").substr(1, 4)))
    rows = mixing.mixed(many, block=1).collect()
    assert sorted(r["mix_position"] for r in rows) == list(range(1001))


def test_blocks_grow(make, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_BLOCKS", 10)
    rows = mixing.mixed(make([(i, f"t{i}") for i in range(1000)])).collect()
    assert max(r["mix_slot"] for r in rows) == 9 and sorted(r["mix_position"] for r in rows) == list(range(1000))


def test_deviation_from_unrounded_weights(make):
    weights = {"a": 0.001, "b": 0.3333, "c": 0.6657}
    source = {i: "a" if i < 20 else "b" if i < 700 else "c" for i in range(2000)}
    rows = mixing.mixed(make([(i, f"t{i}") for i in source], source), weights, block=1).orderBy("mix_slot").collect()
    seen = dict.fromkeys(weights, 0)
    for t, r in enumerate(rows, 1):
        seen[r["source"]] += 1
        assert r["mix_slot"] == r["mix_position"] == t - 1 and all(abs(seen[s] - w * t) < 1 + 1e-6 for s, w in weights.items())
        if seen[r["source"]] == sum(x == r["source"] for x in source.values()):
            break
    # 21 sources of 3 million documents in blocks of 32, a third in one, weights by their roots
    counts = {f"s{i}": 1_000_000 if not i else 100_000 for i in range(21)}
    total = sum(n**0.5 for n in counts.values())
    weights = {s: n**0.5 / total for s, n in counts.items()}
    blocks = {s: n // 32 for s, n in counts.items()}
    slots = mixing.schedule(blocks, mixing.shares(weights, mixing.FINE))
    assert sorted(t for x in slots.values() for t in x) == list(range(sum(blocks.values())))
    end = min(x[-1] for x in slots.values())
    assert end > 50_000
    for s, x in slots.items():
        # before and after each of its blocks
        assert all(abs(k - weights[s] * t) < 1 + 1e-6 and abs(k + 1 - weights[s] * (t + 1)) < 1 + 1e-6 for k, t in enumerate(x) if t <= end)
