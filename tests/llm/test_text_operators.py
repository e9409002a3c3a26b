from __future__ import annotations

import gzip
import hashlib
import json
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import table  # noqa: F401
from pyspark.sql import functions as F

from wardmill.llm import arc_to_warc as A
from wardmill.llm import main_text as H
from wardmill.llm import mixing as M
from wardmill.llm import preferences as P
from wardmill.llm import quality as Q
from wardmill.llm import toxicity as X
from wardmill.llm import url_filter as U
from wardmill.llm.queries import QUERIES

# --- archives -------------------------------------------------------------------------------------------------------

LONG = "<p>é</p>\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" + "x" * 150


def pages():
    return [(5, "http://a/ b", LONG), (3, None, LONG), (9, "http://c", LONG), (1, "http://d", "small"), (2, "http://e", "small"), (4, "", None),
            (6, "http://f", ""), (7, "http://g", "y" * 300_000), (5, "http://a/ b", LONG), (None, "http://n", LONG)]


def test_pages_through_archives(spark, table, tmp_path):
    rows = [(*r, "k", 1) for r in pages()]
    got = A.pages_through_archives(table(rows, "page_id long, url string, html string, key string, record int"), path=f"{tmp_path}/warc").collect()
    assert len(got) == len(rows)
    for r in got:
        text = next(h for i, _, h in pages() if str(i) == str(r["key"])) or ""
        raw = text.encode()
        assert (r["payload_bytes"], r["payload_digest"]) == (len(raw), hashlib.sha256(raw).hexdigest())
        again = text == LONG and r["key"] != "3"
        assert (r["record_type"], r["refers_key"]) == (("revisit", "3") if again else ("response", None))
    whole = A.read_warc(spark, f"{tmp_path}/warc", payloads=True).where("record_type = 'response'").collect()
    assert {r["payload"] for r in whole} == {(h or "").encode() for _, _, h in pages()}
    assert A.pages_through_archives(table(rows, "page_id long, url string, html string, key string, record int").limit(0), path=f"{tmp_path}/none").count() == 0


def test_arc_files_of_both_versions(spark, tmp_path):
    body = b"HTTP/1.0 200 OK\r\nX: 1\r\n\r\n<p>hi</p>"
    raw = b"\xff\xfe\n\nbinary"
    one = b"filedesc://a.arc 0.0.0.0 19990102030405 text/plain 19\n1 0 Origin\nURL IP\n\n" + b"\n"
    one += b"http://x/ 1.2.3.4 19990102030405 text/html %d\n%s\n" % (len(body), body) + b"dns:x 1.2.3.4 199901020304 text/dns %d\n%s\n" % (len(raw), raw)
    two = b"filedesc://b.arc 0.0.0.0 20050607080910 text/plain 200 - - 0 b.arc 11\n2 0 Origin\n\n"
    two += b"http://y/ 1.2.3.4 2005 text/html 200 AB - 12 b.arc %d\n%s\n" % (len(body), body) + b"http://cut/ 1.2.3.4 20050607 text/html 200 - - 0 b.arc 999\nshort"
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.arc").write_bytes(one)
    (tmp_path / "in/b.arc.gz").write_bytes(gzip.compress(two))
    arc = A.parsed(A.read_arc(spark, f"{tmp_path}/in"))
    found = {r["uri"]: r for r in A.converted(arc).collect()}
    assert {u: r["warc_type"] for u, r in found.items()} == {
        "filedesc://a.arc": "warcinfo", "filedesc://b.arc": "warcinfo", "http://x/": "response", "http://y/": "response", "dns:x": "resource", "http://cut/": "resource"}
    assert bytes(found["http://x/"]["payload"]) == b"<p>hi</p>" and bytes(found["dns:x"]["payload"]) == raw
    assert [found[u]["warc_date"] for u in ("http://x/", "dns:x", "http://cut/", "http://y/")] == [
        "1999-01-02T03:04:05Z", "1999-01-02T03:04:00Z", "2005-06-07T00:00:00Z", "1970-01-01T00:00:00Z"]
    assert {r["url"]: r["complete"] for r in arc.collect()}["http://cut/"] is False
    A.write_warc(A.with_revisits(A.converted(arc), 1), f"{tmp_path}/out")
    back = {r["uri"]: r for r in A.read_warc(spark, f"{tmp_path}/out", payloads=True).collect()}
    assert back["dns:x"]["payload"] == raw and sorted(r["record_type"] for r in back.values()).count("revisit") == 1
    ids = [r["record_id"] for r in A.converted(arc).collect()]
    assert len(set(ids)) == 6 and all(len(i) == 47 for i in ids)


# --- preferences ----------------------------------------------------------------------------------------------------


def test_pairs_and_masks(spark, table):
    turns = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "A"), (1, 2, "user", "more"), (1, 3, "assistant", "B"), (1, 4, "user", "left"),
        (2, 0, "user", "hi"), (2, 1, "assistant", "A"), (2, 2, "user", "other"), (2, 3, "assistant", "C"),
        (3, 0, "user", "alone"), (3, 1, "assistant", None), (4, 0, "user", "no reply"), (None, 0, "user", "x"), (5, None, "assistant", "first"), (5, 7, None, "q"),
    ]
    talks = P.conversations(table([(*t, "x") for t in turns], "conv_id long, turn long, role string, text string, turns string"))
    got = {r["chosen_id"]: r for r in P.formatted(P.pairs(talks)).collect()}
    assert set(got) == {1, 2, 3, 5}
    r = got[2]
    assert (r["rejected_id"], r["n_common"], r["prompt"]) == (1, 2, "<|user|>\nhi<|end|>\n<|assistant|>\nA<|end|>\n")
    assert r["chosen_text"] == "<|user|>\nother<|end|>\n<|assistant|>\nC<|end|>\n" and "more" in r["rejected_text"]
    assert [r["chosen_text"][s["start"]:s["end"]] for s in r["chosen_spans"]] == ["C<|end|>"]
    one = got[1]
    assert one["rejected_id"] is None and one["n_common"] == 3 and [one[f"{s}_text"] for s in ("chosen", "rejected")] == ["<|assistant|>\nB<|end|>\n", "<|assistant|>\nA<|end|>\n"]
    assert got[3]["n_common"] == 2 and got[3]["chosen_text"] == "" == got[3]["rejected_text"]
    assert got[5]["n_common"] == 0 and got[5]["rejected_text"] == "<|assistant|>\n<|end|>\n"
    assert P.formatted(P.pairs(talks.limit(0))).count() == 0


# --- urls -----------------------------------------------------------------------------------------------------------

RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"))


def test_hosts_rules_and_words(spark, table):
    assert U.host_and_path("HTTP://Ä.B.Com/X?y=://z/") == ("Ä.b.com", "/X") and U.host_and_path("a://b?c#d") == ("b", "") == U.host_and_path("x://b#/y")
    assert U.host_and_path(None) == U.host_and_path("no url") == ("", "")
    rules = U.Rules(RULES)
    assert rules.find("a.example.com", "/en/1") == ("example.com/en/", "block") and rules.find("www.example.com", "/en/1") == ("www.example.com/en/", "allow")
    assert rules.find("myexample.com", "/en/") == ("com/", "allow") and rules.find("com", "") == (None, None) and rules.find("", "") == (None, None)
    model = U.fit({"spam": 5, "farm": 50, "the": 900, "rain": 40, "therapist": 20})
    assert model.segment("cheappillsonline") == ("cheap", "pills", "online") and model.segment("therapist") == ("therapist",) and "".join(model.segment("qxzvb")) == "qxzvb"
    urls = ["https://x.cheappills.org/en/1", "http://museum-guide.org/art", None, "", "https://spam-farm.example.org/es/750", "http://a.net/es/x"]
    got = {r["url"]: r for r in U.judged(table([(u, "old", 3) for u in urls], "url string, host string, score int"), RULES, model).collect()}
    assert [got[u]["verdict"] for u in urls] == ["block", "allow", "allow", "allow", "block", "block"] and got[urls[5]]["rule"] == "net/es/"
    counts = U.word_counts(spark.createDataFrame([("The the Rain",), (None,), ("rain ÉTÉ",)], "t string"), "t", 3)
    assert counts == {"rain": 2, "the": 2}


def test_words_of_the_whole_page_count(spark, tmp_path):
    page = "<title>Some title &amp; more</title><style>no</style><nav>Home</nav><article><p>A word on free<b>dom</b> of the <svg><text>no</text></svg>press<br>end</article><script>no()"
    assert H.whole_text(page).split() == "Some title & more Home A word on freedom of the press end".split() and H.whole_text(None) == ""
    rows = [(1, "https://freedom-press.org/a", page), (2, "https://spam-farm.org/a", None), (3, "https://freepills.org/", ""), (4, None, page)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r["page_id"]: r["verdict"] for r in QUERIES["op4_url_words"](spark, str(tmp_path)).collect()}
    assert got == {1: "allow", 2: "block", 3: "block", 4: "allow"}


def test_rare_words_stay_in_a_large_table(spark, tmp_path):
    pages = [(1, "https://freedom-press.org/a", "freedom press " + "the " * 120_000), (2, "https://spam-farm.org/a", None)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert {r["page_id"]: r["verdict"] for r in QUERIES["op4_url_words"](spark, str(tmp_path)).collect()} == {1: "allow", 2: "block"}


def test_the_table_judges_as_the_model_in_memory(spark, table):
    rng = random.Random(4)
    pieces = ["free", "dom", "freedom", "pills", "map", "s", "x", "live", "liver", "pool", "art", "party", "news", "sex", "essex", "the", "é", "qx"]
    name = lambda: "".join(rng.choice(pieces) for _ in range(rng.randint(1, 5)))
    urls = [f"https://{name()}.{name()}-{name()}.{rng.choice(['org', 'com', 'net'])}/{rng.choice(['en', 'es', name()])}/{name()}?q={name()}" for _ in range(300)]
    texts = [(" ".join(rng.choices(["freedom", "liver", "The", "pool", "essex", "map", "party", "maps", "I"], k=40)),), (None,)]
    counts = U.count_table(spark.createDataFrame(texts, "t string"), "t")
    model = U.fit({r["word"]: r["n"] for r in counts.collect()})
    rows = table([(u, "old") for u in [*urls, urls[0], None, "", "no url", "https://a.b/1"]], "url string, host string")
    kept = ("url", "host", "path", "rule", "verdict")
    small, large = U.judged(rows, RULES, model).select(*kept).collect(), U.judged_by_table(rows, RULES, counts).select(*kept).collect()
    assert sorted(map(str, small)) == sorted(map(str, large)) and {r["verdict"] for r in large if r["rule"] is None} == {"block", "allow"}


# --- classifiers ----------------------------------------------------------------------------------------------------


def labelled(seed=1, n=160):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = [f"w{rng.randrange(200)}" for _ in range(rng.choice([20, 60, 300]))]
        bad = i % 4 == 0
        if bad:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), "grobian" + rng.choice(["", "en", "us", "isch"]))
        docs.append((i, " ".join(words)))
        labels.append((i, 0 if rng.random() < 0.5 else 1, int(bad)))
    return docs, labels


def test_toxicity_by_stem_and_swap(spark, table):
    docs, labels = labelled()
    frame, marks = table([(*d, 1) for d in docs], "doc_id long, text string, label int"), table(labels + [(None, 1, 1), (9999, 0, 0), (0, 1, 1), (1, 0, None)], "doc_id long, quality int, toxic int")
    model = X.train(frame, marks)
    test = [(1, "w1 w2 grobianchen w3 w4 grobianer"), (2, "w1 w2 w3 w4"), (3, ""), (4, None), (5, "w9 " * 50_000)]
    got = {r["doc_id"]: r["score"] for r in X.with_scores(table([(*t, 0.5) for t in test], "doc_id long, text string, score double"), model).collect()}
    assert got[1] > 0.5 > max(got[k] for k in (2, 3, 4, 5)) and got[3] == got[4] and all(0 <= v <= 1 for v in got.values())
    again = X.train(frame, marks)
    assert (again.weights == model.weights).all() and again.intercept == model.intercept


def test_swapping_identity_terms_removes_their_weight():
    rng = random.Random(3)
    rows = [("%s said w%d" % (rng.choice(["muslim", "christian"]) if y == 0 or rng.random() < 0.2 else "muslim", rng.randrange(50)), y) for y in [0, 1] * 100]
    batch = pa.RecordBatch.from_pydict({"text": pa.array([x for x, _ in rows]), "label": pa.array([y for _, y in rows], pa.int32())})
    found = list(X._features("text", X.IDENTITY, X.SIZES, 14)([batch]))
    columns = pa.Table.from_batches(found)
    buckets, bounds = X.gathered(columns.column("buckets"))
    mentions = [np.array(m, dtype=np.int64) for m in columns.column("mentions").to_pylist()]
    assert all(len(m) == 1 for m in mentions)
    gap = {}
    for weight in (0.0, 5.0):
        model = X.fit(columns.column("label").to_numpy().astype(int), buckets.astype(np.int64), bounds, mentions, bits=14, l1=1e-4, swap_weight=weight)
        s = model.logits(pa.array(["muslim said", "christian said", "said"]))
        gap[weight] = (abs(s[0] - s[1]), abs(s[0] - s[2]))
    assert gap[5.0][0] < 0.3 * gap[0.0][0] and gap[5.0][1] < 0.5


def test_swaps_take_every_term_whatever_the_seed():
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["muslim said a", "christian said b"]), "label": pa.array([1, 0], pa.int32())})
    columns = pa.Table.from_batches(list(X._features("text", X.IDENTITY, X.SIZES, 14)([batch])))
    buckets, bounds = X.gathered(columns.column("buckets"))
    mentions = [np.array(m, dtype=np.int64) for m in columns.column("mentions").to_pylist()]
    one, two = (X.fit(np.array([1, 0]), buckets.astype(np.int64), bounds, mentions, bits=14, epochs=3, seed=s).weights for s in (1, 2))
    assert np.any(one) and np.allclose(one, two)


def test_quality_learns_words_pairs_and_runs(spark, table):
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(120):
        words = [f"v{rng.randrange(300)}" for _ in range(80)]
        kind = i % 4
        if kind == 0:
            words = [w + "%%%" for w in words]
        elif kind == 1:
            words[10:50] = [rng.choice("mnopq") * 3] * 40
        docs.append((i, " ".join(words)))
        labels.append((i, int(kind > 1)))
    model = Q.train(table(docs, "doc_id long, text string"), table(labels, "doc_id long, quality int"))
    fresh = " ".join(f"v{k}" for k in range(60))
    test = [(1, fresh), (2, fresh.replace(" ", "%%% ")), (3, fresh[:60] + " zz" * 50), (4, ""), (5, None)]
    got = {r["doc_id"]: r["score"] for r in X.with_scores(table(test, "doc_id long, text string"), model).collect()}
    assert got[1] > 0.5 > max(got[2], got[3]) and got[4] == got[5]
    piece = next(Q.scan(pa.array([docs[0][1]]), Q.VISIBLE_BYTES, lower=False))
    buckets, shares, _ = Q._row_features(piece, model.sizes, model.bits)
    logits = (shares @ model.vectors[buckets]) @ model.output + model.bias
    odds = np.exp(logits - logits.max())
    assert np.isclose(model.scores(pa.array([docs[0][1]]))[0], odds[1] / odds.sum())


@pytest.mark.parametrize("train, label, none", [(X.train, "toxic", 0), (Q.train, "quality", 1)])
def test_too_few_labels(spark, train, label, none):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    empty = spark.createDataFrame([], f"doc_id long, {label} int")
    assert round(float(train(docs, empty).scores(pa.array(["a"]))[0])) == none
    one = train(docs, spark.createDataFrame([(1, 1)], f"doc_id long, {label} int"))
    assert one.scores(pa.array(["a", ""]))[0] > 0.5
    assert X.with_scores(docs.limit(0), one).count() == 0


# --- main text ------------------------------------------------------------------------------------------------------

PROSE = "It is one of the things that we have to say about this, and it was the best of them all as far as they had been in the place. " * 3


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<p>", ""), ("<nav><a href=x>Home</a></nav><article><h1>T</h1><p>a &amp;lt; b&nbsp;c<br>d</article><footer>f</footer>", "T\na &lt; b c d"),
    ("<div class='ad'><p>buy<article><p>one<p>two</article>", "one\ntwo"),
    (f"<body class='x sidebar'><div><a href=1>a</a> <a href=2>b</a></div><h2>Head</h2><p>{PROSE}</p><p>short</p><p>{PROSE}</p><ul><li><a href=3>link text</a></ul>", f"Head\n{PROSE.strip()}\nshort\n{PROSE.strip()}"),
    (f"<article><p>body text<section class=comments><article><p>{PROSE}</article></section></article>", "body text"),
    (f"<p>{PROSE}</p><form><p>{PROSE}</p></form><aside>{PROSE}</aside><div style='display:none'>{PROSE}</div>", PROSE.strip()),
    ("<article><script>var a='</p><p>no';</script><!-- <p>no --><style>p{}</style><p>1 < 2 & 3</p><noscript>no</noscript>", "1 < 2 & 3"),
    ("<article><p>the <span class='ad'>buy</span> end</p></article>", "the\nend"),
])
def test_main_text(page, text):
    assert H.main_text(page) == text


@pytest.mark.parametrize("attributes, shown", [
    ('style="overflow:hidden"', True), ('style="overflow: hidden; color: red"', True), ('class="hidden md:block"', True), ('title="Hidden costs of x"', True),
    ('title="a hidden thing"', True), ('data-class="ad"', True), ('title="display:none"', True), ('style="display:none;display:block"', True),
    ('aria-hidden="false"', True), ("hidden", False), ('hidden=""', False), ("HIDDEN=hidden", False), ("id=x hidden", False), ('aria-hidden="true"', False),
    ("aria-hidden=TRUE", False), ('style="color:red; Display : None !important"', False), ("style=visibility:hidden", False), ('class="ad"', False),
])
def test_hidden_is_read_by_attribute(attributes, shown):
    for page in (f"<article {attributes}><p>{PROSE}</p></article>", f"<div {attributes}><p>{PROSE}</p></div>"):
        assert H.main_text(page) == (PROSE.strip() if shown else "")


@pytest.mark.parametrize("inside, text", [
    ("<svg class='i'/><p>end", "end"), ("<math/><p>end", "end"), ("<svg><title/><style/><path d='1'/></svg><p>end", "end"), ("<svg><title>t</svg><p>end", "end"),
    ("<svg-icon></svg-icon><p>end", "end"), ("<button-group>x</button-group><p>end", "x\nend"), ("<video-player src=x></video-player><p>end", "end"),
    ("<audio-note/><title-bar></title-bar><p>end", "end"), ("<p><button>a<p>one<p><button>b</button>two", "a\none\ntwo"), ("<div><object data=x></div><p>end", "end"),
    ("<object data=x><p>end", "end"), ("<canvas><div><p>one</div><noscript><p>two", "one\ntwo"), ("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds", "so x=2 holds"),
    ("<p>a <button><div>no</div></button> b<svg><g><text>no</text></g></svg> c", "a b c"), ("<p>a<object><object>no</object>no</object><select><option>no</select> b", "a b"),
    ("<iframe src=x><p>a<iframe src=y>no</iframe><template><article><p>no</article></template>", "a"), ("<p>a<script/>no", "a"), ("<p>a<textarea>no<p>no", "a"),
])
def test_dropped_elements_end_where_they_end(inside, text):
    assert H.main_text(f"<article>{inside}") == text
    assert H.main_text(f"<article>{inside}<svg>" + "<button>" * 3 + "<b>" * 3) == text


@pytest.mark.parametrize("page, text", [
    (f'<article><section id="discussion"><h2>4. Discussion</h2><p>short</p><p>{PROSE}</p></section></article>', f"4. Discussion\nshort\n{PROSE.strip()}"),
    (f'<article class="post legal"><header><h1>T</h1></header><p>{PROSE}</p><p>short</article>', f"T\n{PROSE.strip()}\nshort"),
    (f'<article><p>one</p><div id="related-work"><h2>Earlier</h2><p>{PROSE}</p></div></article>', f"one\nEarlier\n{PROSE.strip()}"),
    (f'<div class="elementor-widget"><p>{PROSE}</p></div>', PROSE.strip()),
    ('<article><h2 id="discussion">Discussion</h2><p>a</p><h2><span id="Feedback">Feedback</span>[edit]</h2><p>b</article>', "Discussion\na\nFeedback[edit]\nb"),
    ('<article><section id=search><div>\n<h3>Search</h3></div><p>short</section></article>', "Search\nshort"),
    ('<article><p>a</p><div class="share"><p>Share this</div><div id=related><h3>More</h3><a href=x>b</a> c</div></article>', "a"),
    (f'<article><p>a</p><div class="related"><p><a href=x>{PROSE}</a></div></article>', "a"),
    (f'<p>{PROSE}</p><div class="cookie"><p>{PROSE}</div><div id=comments><h2>Comments</h2><p>{PROSE}</div><div class=nav>{PROSE}</div>', PROSE.strip()),
    (f'<article><p>a</p><div class="legal"><p>{PROSE}</p><div class="share"><p>Share this</div></div></article>', f"a\n{PROSE.strip()}"),
])
def test_weak_words_are_a_prior(page, text):
    assert H.main_text(page) == text


def test_main_text_of_a_table(spark, table):
    rows = [(1, "<article><p>x</article>", "o"), (2, None, "o"), (3, "<article>" + "<p>y z</p>" * 20_000, "o"), (1, "<article><p>x</article>", "o")]
    got = sorted((r["page_id"], len(r["text"])) for r in H.with_main_text(table(rows, "page_id long, html string, text string")).collect())
    assert got == [(1, 1), (1, 1), (2, 0), (3, 79_999)]


# --- mixing ---------------------------------------------------------------------------------------------------------


def filled(words, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Targets by repeated sharing."""
    order = sorted((s for s in words if s is not None)) + [s for s in words if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, left = dict.fromkeys(order, 0.0), set(order), share * sum(words.values())
    while True:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if cap * words[s] <= left * weight[s] / total + 1e-9} if total else set()
        if not full:
            return target | {s: left * weight[s] / total for s in open_}
        for s in full:
            target[s] = cap * words[s]
            left -= target[s]
        open_ -= full


def test_mix_against_brute_force(spark, table):
    rng = random.Random(6)
    docs = [(i, " ".join("w" * rng.randrange(1, 4) for _ in range(rng.choice([0, 1, 5, 70, 700]))), rng.choice(["a"] * 6 + ["b", "ä", "Z", None]), 1) for i in range(400)]
    docs += [(7, docs[7][1], docs[7][2], 1), (None, "some words", "b", 1), (500, None, "a", 1), (501, "only", "tiny", 1), (502, "", "empty", 1), (503, "w " * 60_000, "b", 1)]
    frame = table(docs, "doc_id long, text string, source string, size int")
    mixture = M.mix(frame, part_rows=50, shard_slots=200)
    words = defaultdict(int)
    for _, x, s, _ in docs:
        words[s] += len((x or "").split())
    expected = filled(words)
    order = sorted((s for s in words if s is not None)) + [None]
    for s, one in zip(order, mixture.sources, strict=True):
        assert one.words == words[s] and np.isclose(one.target, expected[s])
    got = mixture.taken().collect()
    assert Counter((r["id"], r["size"]) for r in got) == Counter((i, len((x or "").split())) for i, x, _, _ in docs)
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    taken = Counter()
    for r in got:
        taken[order[r["src"]]] += r["taken"]
    for s in order:
        assert abs(taken[s] - expected[s]) <= 2 * M.BLOCK
    again = M.mix(frame.repartition(7), part_rows=50, shard_slots=200).taken()
    assert sorted(map(str, again.collect())) == sorted(map(str, got))


def test_equal_rows_and_rows_without_an_id_share_no_part(spark, table):
    """20,000 rows without an id and 5,000 repeats of one row are spread over the parts, and stay as many."""
    rows = [(None, "one two three", "a")] * 20_000 + [(4, "four five", "b")] * 5_000 + [(i, "w " * (i % 9), "b") for i in range(5, 500)]
    mixture = M.mix(table(rows, "doc_id long, text string, source string", 4), part_rows=1000)
    sizes = [r["count"] for r in mixture.sized.groupBy("src", "part").count().collect()]
    assert sum(sizes) == len(rows) and len(sizes) > 40 and max(sizes) < 1500
    got = mixture.taken().collect()
    assert Counter((r["id"], r["size"]) for r in got) == Counter((i, len(x.split())) for i, x, _ in rows)
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    again = M.mix(table(rows[::-1], "doc_id long, text string, source string"), part_rows=1000).taken().collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_plan_uses_each_block_evenly_and_spans_fill_the_slots(spark, table):
    docs = [(i, " ".join(["w"] * (20 + i % 90)), "ab"[i % 5 == 0]) for i in range(300)]
    mixture = M.mix(table(docs, "doc_id long, text string, source string"), shard_slots=64)
    plan = mixture.plan.groupBy("src", "block").count().collect()
    for i, s in enumerate(mixture.sources):
        uses = [r["count"] for r in plan if r["src"] == i]
        assert sum(uses) == s.slots and max(uses) - min(uses, default=0) <= 1 and max(uses) <= 2
    shards = mixture.plan.groupBy("shard", "src").count().collect()
    assert len({r["count"] for r in shards if r["src"] == 0}) > 3                   # counts are drawn, not dealt out evenly
    spans = mixture.spans().groupBy("shard", "slot").agg(F.sum("words").alias("n")).collect()
    assert len(spans) == sum(s.slots for s in mixture.sources) and sum(r["n"] < M.BLOCK for r in spans) <= 4
    assert M.mix(table([], "doc_id long, text string, source string", 1)).taken().count() == 0


def test_spark_plan_has_no_python(spark, table):
    mixture = M.mix(table([(1, "a b", "x")], "doc_id long, text string, source string"))
    talks = P.conversations(table([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string"))
    for frame in (mixture.taken(), P.formatted(P.pairs(talks))):
        text = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "Arrow" not in text
    assert json.dumps(M.WEIGHTS) == "[3, 1, 2]"
