"""The operators on text against brute force, and on odd rows."""

import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from quadloom.llm import bpe, forest, html, lines, neardup, packing, quality, sketches, toxicity, urls
from quadloom.llm.automaton import Automaton
from quadloom.llm.queries import QUERIES, URL_RULES, VOCABULARY

SF_DIR = "/root/testdata/sf0.001"
KINDS = "doc_id long, text string, lang string, source string, n_chars long, score string"
LONG = " ".join(f"word{i % 977}x{i}" for i in range(9000))
SHARED = "This very line is in several of the documents."
ODD = [
    (1, None, None, None, None, "clash"),
    (2, "", "en", "a", 0, None),
    (3, "   \t\n", "en", "a", 5, "x"),
    (4, SHARED + "\nfour\n" + SHARED, "en", "a", 60, "x"),
    (5, "  " + SHARED.upper() + "\t\nfive five five", "en", "a", 60, "x"),
    (6, "six\n" + SHARED, "de", "a", 50, "x"),
    (6, "six\n" + SHARED, "de", "a", 50, "x"),
    (7, LONG, "en", "b", len(LONG), "x"),
    (8, LONG + " tail", "en", "b", len(LONG) + 5, "x"),
    (9, "a b c", "fr", None, 5, "x"),
    (10, "A  B\nc", "fr", None, 6, "x"),
    (None, SHARED, "en", "a", 9, "x"),
    (11, "naïve <|endoftext|> ΑΣ 漢字 don't!!", "xx", "c", 30, "x"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, KINDS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], KINDS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF_DIR}/labels.parquet")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def rows(df):
    return [r.asDict() for r in df.collect()]


def texts_of(df):
    return {r["doc_id"]: r["text"] or "" for r in df.select("doc_id", "text").collect()}


def shingles(text):
    words = text.encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def alike(a, b):
    return 1.0 if not a | b else len(a & b) / len(a | b)


def components(sets):
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


# --- lines


def test_lines_on_odd_rows(odd):
    got = rows(lines.dedup_lines(odd))
    assert len(got) == len(ODD) and {"score", "lang", "n_lines", "n_dropped"} <= set(got[0])
    by = {r["doc_id"]: r for r in got}
    assert (by[1]["text"], by[1]["n_lines"], by[2]["n_lines"], by[3]["text"]) == ("", 1, 1, "   \t\n")
    assert by[4]["text"] == "four" and by[4]["n_dropped"] == 2 and by[5]["text"] == "five five five"
    assert by[6]["text"] == "six\n" + SHARED and by[6]["n_dropped"] == 0
    assert by[None]["text"] == SHARED and by[7]["text"] == LONG


def test_bitmaps_cover_long_documents(spark):
    many = "\n".join([SHARED, *["short"] * 200, SHARED, "end"])
    df = spark.createDataFrame([(1, many), (2, many), (3, many)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in rows(lines.dedup_lines(df))}
    assert got[1]["text"] == "\n".join(["short"] * 200 + ["end"]) and got[3]["text"] == many
    words = {r["doc_id"]: r["dropped"] for r in rows(lines.keep_bitmaps(df))}
    assert [(w["word"], w["bits"]) for w in words[2]] == [(0, 1), (3, 1 << (201 - 189))] and 3 not in words


# --- neighbours


def test_neighbours_on_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    given = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.5]), (2, [1.0, 0.5]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [3.0, 0.0]), (None, [1.0, 0.0]), (9, [1.0])]
    df = spark.createDataFrame([(i, v, "z") for i, v in given], "vec_id long, embedding array<float>, score string")
    got = rows(forest.nearest(df, df.where("vec_id % 3 = 0 or vec_id is null"), "vec_id", "embedding", 10))
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: (r["query_id"], r["rank"]))] == [(0, 1, 1, 0.5), (0, 2, 2, 0.5), (0, 3, 8, 2.0)]
    assert rows(forest.nearest(df.limit(0), df.limit(0), "vec_id", "embedding", 10)) == []


def test_recall_of_neighbours(spark):
    data = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    ids = np.array([r["vec_id"] for r in data])
    held = np.array([r["embedding"] for r in data], float)
    found = collections.defaultdict(dict)
    for r in rows(QUERIES["op2_nearest"](spark, SF_DIR)):
        found[r["query_id"]][r["vec_id"]] = r["score"]
    hits = total = 0
    for q in ids[ids % 100 == 0]:
        far = np.sqrt(((held - held[ids == q][0]) ** 2).sum(1))
        far[ids == q] = np.inf
        best = np.lexsort((ids, far))[:10]
        hits += sum(int(ids[b]) in found[q] for b in best)
        total += 10
        assert len(found[q]) == 10 and all(abs(s - far[ids == i][0]) < 1e-12 for i, s in found[q].items())
    assert hits / total >= 0.9


def test_a_prefix_holds_what_is_equal():
    rng = np.random.default_rng(3)
    held = rng.standard_normal((500, 8))
    tree = forest.Forest(np.arange(500), held)
    for q, found in enumerate(tree.candidates(held[:20], 0.05)):
        assert q in found and forest.LEAST <= len(found) < 500


# --- tokens and packing


def test_automaton_follows_the_library():
    own, library = Automaton(VOCABULARY), Tokenizer.from_file(VOCABULARY)
    rng = np.random.default_rng(5)
    letters = list("abcdefghilmnorstuéàßñσςΣİ漢🙂 '.,!-_<>/w019²\n\u0301")
    texts = ["", "a" * 300, "don't we'll I'd", "<|startoftext|>x<|endoftext|>", *("".join(rng.choice(letters, 25)) for _ in range(3000))]
    for text, ids in zip(texts, own.encode_all(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, text
        assert own.decode(ids).decode() == library.decode(want, skip_special_tokens=False)
        if text:
            assert own.encode(text) == ids


def test_arcs_are_the_pairs_that_merging_keeps():
    own, library = Automaton(VOCABULARY), Tokenizer.from_file(VOCABULARY)
    for word in ("lower", "thinking", "aaaa", "internationalization", "zzzzzz"):
        ids = library.encode(word, add_special_tokens=False).ids
        assert all(own._arc(a, b) for a, b in zip(ids, ids[1:]))


def test_bpe_on_odd_rows(odd, empty):
    library = Tokenizer.from_file(VOCABULARY)
    got = rows(bpe.decode(bpe.encode(odd, VOCABULARY), VOCABULARY))
    want = collections.Counter()
    for i, t, *_ in ODD:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[i, np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False).encode()] += 1
    assert collections.Counter((r["doc_id"], bytes(r["ids"]), bytes(r["decoded"])) for r in got) == want
    assert rows(bpe.digests(empty, VOCABULARY)) == []


def check_packed(placed, documents):
    library = Tokenizer.from_file(VOCABULARY)
    pieces, sequences = collections.Counter(), collections.defaultdict(list)
    for r in placed:
        pieces[r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]] += 1
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    want = collections.Counter()
    for i, text in documents:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for k in range(0, len(ids), 2048):
            part = ids[k : k + 2048]
            want[i, k // 2048, k, len(part), zlib.crc32(part.tobytes())] += 1
    assert pieces == want
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    return len(sequences), sum(r["length"] for r in placed)


def test_packing_on_odd_rows(odd, empty):
    used, total = check_packed(rows(packing.pack(odd, VOCABULARY)), [r[:2] for r in ODD])
    assert used <= -(-total // 2048) + 1
    assert rows(packing.pack(empty, VOCABULARY)) == []


def test_packed_sequences_hold_the_ids(spark, documents):
    placed = QUERIES["op3_packing"](spark, SF_DIR).cache()
    used, total = check_packed(rows(placed), list(texts_of(documents).items()))
    assert used <= 1.01 * total / 2048 + 1
    whole = {r["doc_id"]: bytes(r["ids"]) for r in rows(bpe.encode(documents, VOCABULARY))}
    out = rows(packing.sequences(documents, placed, VOCABULARY))
    assert sum(len(r["ids"]) for r in out) == 4 * total and all(len(r["ids"]) <= 4 * 2048 for r in out)
    single = next(r for r in out if len(set(r["doc_ids"])) == len(r["doc_ids"]) and all(len(whole[d]) < 8000 for d in r["doc_ids"]))
    assert bytes(single["ids"]) == b"".join(whole[d] + bytes(4) for d in single["doc_ids"])


@pytest.mark.parametrize("seed", range(4))
def test_fit_uses_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    lengths = np.clip(rng.lognormal(3 + seed, 1.0, 3000).astype(int) + 1, 1, 256)
    counts = np.bincount(lengths, minlength=257)
    made = np.zeros(257, int)
    fitted = packing.fit(counts)
    for pattern, repeats in fitted:
        assert sum(pattern) <= 256
        np.add.at(made, list(pattern), repeats)
    assert (made == counts).all()
    assert sum(n for _, n in fitted) <= 1.02 * sum(n for _, n in packing._best_fit(counts.copy())) + 1


# --- pages and URLs


def test_main_text():
    page = """<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><a href=a>Home</a></nav>
    <div id="sidebar"><p>Side, with. many, words.</p></div><div class="cookie-notice">We use, cookies.</div>
    <article><h1>Big &amp; small</h1><p>One <b>bo</b>ld,\n  text.<br>More<p>Two &eacute;.<script>var t="</p>";</script></p><ul><li>x, y<li>z</ul></article>
    <form>Search</form><div class="comments"><p>Nice, really!</p></div><!-- <p>gone</p> --><footer>&copy; all</footer></body></html>"""
    assert html.main_text(page) == "Big & small One bold, text. More Two é. x, y z"
    assert html.main_text(page[: page.index("<ul>")] + "<p tit") == "Big & small One bold, text. More Two é."
    assert [html.main_text(x) for x in (None, "", "<br>", "a < b", '<p title="a>b">x</p>')] == ["", "", "", "a < b", "x"]


def test_pages_without_an_article_element():
    page = "<body><div class=menu><p>Menu, one.</p></div><div><h2>Head</h2><p>" + "Long text, with words. " * 20 + "</p><p>Short.</p></div><div class=footer>f</div></body>"
    assert html.main_text(page) == "Head " + ("Long text, with words. " * 20).strip() + " Short."


def test_pages_of_several_sections():
    intro, methods, results = ("Intro, some words. " * 16).strip(), ("Methods, more words. " * 140).strip(), ("Results, other words. " * 90).strip()
    page = f"<body><div class=content><h1>Title</h1><section id=intro><p>{intro}</section><section id=methods><p>{methods}</section><section id=results><p>{results}</section></div></body>"
    assert html.main_text(page) == f"Title {intro} {methods} {results}"
    page = f"<body><nav><a href=a>Home</a></nav><div class=lead><p>{intro}</p></div><div class=body><p>{methods}</p><p>End.</p></div></body>"
    assert html.main_text(page) == f"{intro} {methods} End."
    page = f"<body><p>Not in them.</p><article id=a><p>{results}</p></article><article id=b><p>{methods}</p></article></body>"
    assert html.main_text(page) == f"{results} {methods}"


def test_wrappers_with_names_of_what_surrounds_an_article():
    text = ["Long text, with words. " * 20 + f"Part {i}." for i in range(4)]
    body, around = "<h1>Head</h1>" + "".join(f"<p>{t}" for t in text), "<nav><a href=a>Home</a></nav><div class=sidebar><p>Side, words.</div>"
    whole = " ".join(["Head", *text])
    names = ("content has-sidebar", "page no-sidebar", "article-body with-comments", "main-content related", "social-policy")
    for page in (f"<form>{around}<div>{body}</div></form>", *(f'<div class="{n}">{around}<div>{body}</div></div>' for n in names)):
        assert html.main_text(f"<body>{page}<footer>All rights.</footer></body>") == whole
    # nested, with a heading outside, and an article in a form next to more of other text
    assert html.main_text(f'<form><main><h2>Top</h2><div class="content has-sidebar">{around}{body}</div></main></form>') == "Top " + whole
    assert html.main_text(f"<form><article>{body}</article></form><div class=comments><p>{'Nice, really! ' * 300}</p></div>") == whole
    # nothing else on the page; the head left open
    assert html.main_text("<body><form><p>Only, this.</p></form></body>") == "Only, this."
    assert html.main_text(f"<html><head><title>T</title><body><div>{body}</div></body></html>") == whole
    # an article outside keeps long comments out, and a footer isn't the text of a page of links
    assert html.main_text(f"<article>{body}</article><div class=comments>{'<p>Nice, really! A long, long comment.' * 300}</div>") == whole
    assert html.main_text("<div>" + "<p><a href=a>Some page</a>" * 50 + "</div><footer><p>All rights.<p>Imprint.</footer>") == ""


def test_pages_query(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    got = rows(QUERIES["op4_main_text"](spark, SF_DIR))
    assert {r["page_id"] for r in got} == set(pages) and all(r["n_chars"] == len(r["text"]) for r in got)
    for r in got:
        body = pages[r["page_id"]]["html"].partition("<article>")[2].partition("</article>")[0]
        body = re.sub(r"<[a-z/][^>]*$|</?b>", "", body)
        assert r["text"].split() == html.html.unescape(re.sub(r"<[^>]*>", " ", body)).split()
    odd = spark.createDataFrame([(None, None, None, 1), (1, "u", "<p>x", 2)], "page_id long, url string, html string, text int")
    assert sorted((r["n_chars"], r["text"]) for r in rows(html.extract(odd))) == [(0, ""), (1, "x")]
    assert rows(html.extract(odd.limit(0))) == []


def test_url_rules(spark):
    given = [None, "no scheme", "http://a.NET/x", "https://www.example.net/en/1", "http://example.net/en", "http://example.com/de/", "http://xexample.com/de/", "http://b.org/fr/?q", "http://b.org?x=/fr/", "x://net/", "http://net#/"]
    df = spark.createDataFrame([(i, u, "z") for i, u in enumerate(given)], "page_id long, url string, verdict string")
    got = [(r["host"], r["path"], r["rule"], r["verdict"]) for r in sorted(rows(urls.judge_urls(df, URL_RULES)), key=lambda r: r["page_id"])]
    assert got == [
        ("", "", None, "allow"), ("", "", None, "allow"), ("a.net", "/x", "net/", "block"), ("www.example.net", "/en/1", "example.net/en/", "allow"),
        ("example.net", "/en", "net/", "block"), ("example.com", "/de/", "example.com/de/", "block"), ("xexample.com", "/de/", None, "allow"),
        ("b.org", "/fr/", "org/fr/", "allow"), ("b.org", "", None, "allow"), ("net", "/", "net/", "block"), ("net", "", None, "allow"),
    ]
    assert rows(urls.judge_urls(df.limit(0), URL_RULES)) == []


def test_equal_digests_are_told_apart(tmp_path, monkeypatch):
    monkeypatch.setattr(urls.xxhash, "xxh64_intdigest", lambda b: len(b))
    file = tmp_path / "rules"
    file.write_bytes(urls.build([("block", "aa", "/"), ("allow", "bb", "/"), ("block", "cc", "/")]))
    assert urls.Rules(str(file)).judge([("bb", "/"), ("cc", "/"), ("dd", "/")]) == [("bb/", False), ("cc/", True), None]


# --- sketches and near copies


def test_fingerprints_query(spark, documents):
    order = sorted(texts_of(documents).items())
    got = {r["doc_id"]: r for r in rows(QUERIES["op6_fingerprints"](spark, SF_DIR))}
    assert len(got) == len(order)
    for k, (i, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        gone = len(text) // 4
        changed = text[: len(text) - gone] + after[:gone]
        r = got[i]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert abs(r["near_edited"] - alike(shingles(text), shingles(changed))) < 0.15
        assert abs(r["near_next"] - alike(shingles(text), shingles(after))) < 0.15
        assert abs(r["n_distinct"] - len(shingles(text))) <= 0.3 * len(shingles(text))


def test_sketches_merge_and_estimate(spark, odd, empty):
    got = {r["doc_id"]: r for r in rows(sketches.fingerprints(odd))}
    assert got[1]["sketch"] == got[2]["sketch"] == got[3]["sketch"] == [] and got[9]["sketch"] == got[10]["sketch"] and got[9]["n_distinct"] == 1
    assert len(got[7]["sketch"]) == sketches.K and abs(got[7]["n_distinct"] / len(shingles(LONG)) - 1) < 0.25
    assert rows(sketches.fingerprints(empty)) == []
    pair = spark.createDataFrame([(" ".join(f"w{i}" for i in range(3000)), " ".join(f"w{i}" for i in range(1000, 3000)))], "a string, b string")
    a, b = (sketches.sketch(sketches.shingles(F.col(c))) for c in "ab")
    r = pair.select(sketches.resemblance(a, b).alias("j"), sketches.containment(b, a).alias("c"), sketches.resemblance(sketches.merge(a, b), a).alias("u"), sketches.resemblance(F.array().cast("array<bigint>"), a).alias("z")).first()
    assert abs(r["j"] - 2 / 3) < 0.12 and r["c"] > 0.85 and r["u"] == 1 and r["z"] == 0
    parts = spark.createDataFrame([(t,) for t in ("a b c d e f", "d e f g h i")], "t string").select(sketches.sketch(sketches.shingles(F.col("t"))).alias("s"))
    assert len(parts.agg(sketches.merged("s").alias("s")).first()["s"]) == 4


def test_near_duplicates_query(spark, documents):
    sets = {i: shingles(t) for i, t in texts_of(documents).items()}
    want = components(sets)
    got = {r["doc_id"]: r for r in rows(QUERIES["op7_near_duplicates"](spark, SF_DIR))}
    assert {i: (len(s), want[i], want[i] == i) for i, s in sets.items()} == {i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in got.items()}


def test_near_duplicates_on_odd_rows(odd, empty):
    got = collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in rows(neardup.near_duplicates(odd)))
    n = len(shingles(LONG))
    assert got == collections.Counter([(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 10, 4, True), (5, 8, 5, True), (6, 6, 6, True), (6, 6, 6, True), (7, n, 7, True), (8, n + 1, 7, False), (9, 1, 9, True), (10, 1, 9, False), (None, 5, None, True), (11, 1, 11, True)])
    assert rows(neardup.near_duplicates(empty)) == []
    once = rows(neardup.one_of_each(odd))
    assert sorted(r["doc_id"] or 0 for r in once) == [0, 1, 2, 3, 4, 5, 6, 7, 9, 11] and "score" in once[0]


def test_large_groups_are_compared_in_parts(spark, monkeypatch):
    monkeypatch.setattr(neardup, "PART_SETS", 7)
    rng = np.random.default_rng(9)
    base = [f"w{i}" for i in range(120)]
    docs = {}
    for i in range(60):
        words = list(base)
        for at in rng.choice(120, rng.integers(0, 9), replace=False):
            words[at] = f"x{i}y{at}"
        docs[i] = " ".join(words)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    want = components({i: shingles(t) for i, t in docs.items()})
    assert {r["doc_id"]: r["component_id"] for r in rows(neardup.near_duplicates(df))} == want


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 1 << 63, 4000, np.uint64)
    x, y = neardup.registers(a[:3000]), neardup.registers(a[500:])
    assert (np.maximum(x, y) == neardup.registers(a)).all()
    guess = neardup.likely(np.array([(x == y).sum()]), np.array([(x > y).sum()]), 3000, np.array([3500]))
    assert abs(guess[0] - 2500 / 4000) < neardup.MARGIN


# --- classifiers


@pytest.fixture(scope="module")
def larger(spark):
    at = "/root/testdata/sf0.01"
    return at, {r["doc_id"]: r for r in spark.read.parquet(f"{at}/labels.parquet").collect()}


def test_quality_of_held_out_documents(spark, larger):
    at, known = larger
    got = {r["doc_id"]: r for r in rows(QUERIES["op9_quality"](spark, at))}
    asked = [r for i, r in got.items() if r["held_out"] and i in known]
    assert len(got) == 1000 and np.mean([r["kept"] == known[r["doc_id"]]["quality"] for r in asked]) >= 0.9
    assert np.mean([r["kept"] for r in asked if known[r["doc_id"]]["quality"] == 1]) >= 0.95


def test_toxicity_of_held_out_documents(spark, larger):
    at, known = larger
    got = {r["doc_id"]: r for r in rows(QUERIES["op10_toxicity"](spark, at))}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for i, r in got.items())
    asked = [(r["predicted"], known[i]["toxic"]) for i, r in got.items() if r["held_out"] and i in known]
    assert np.mean([p == t for p, t in asked]) >= 0.92


def test_a_risk_below_zero_is_taken_back():
    rng = np.random.default_rng(4)
    toxic = [np.array(sorted({1, *rng.integers(100, 2000, 20).tolist()}), np.int32) for _ in range(200)]
    plain = [np.array(sorted(set(rng.integers(100, 2000, 20).tolist())), np.int32) for _ in range(900)]
    model = toxicity.learn(toxic[:100], plain + toxic[100:], 0.1)
    assert model.raw(toxic).min() > model.raw(plain).max()


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_classifiers_on_odd_rows(spark, odd, empty, labels, operator):
    first = rows(operator.score(odd, labels))
    assert len(first) == len(ODD) and all(0 <= r["score"] <= 1 for r in first)
    keep = quality.keep_good if operator is quality else toxicity.keep_clean
    assert set(keep(odd, labels).columns) == set(odd.columns)
    assert rows(operator.score(empty, labels)) == [] and rows(keep(empty, labels.limit(0))) == []
    # nothing is learnt from no labels: nothing is rejected
    assert keep(odd, labels.limit(0)).count() == len(ODD)


# --- pipeline


def test_pipeline_stages(spark, documents):
    docs, names = documents, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF_DIR)
        assert after.columns == documents.columns
        rows_ = after.collect()
        docs = spark.createDataFrame(rows_, documents.schema)
        names.append((name, len(rows_)))
    assert [n for n, _ in names] == ["quality", "toxicity", "line_dedup", "near_dedup"]
    counts = [c for _, c in names]
    assert documents.count() > counts[0] > counts[1] == counts[2] > counts[3]
    sets = {i: shingles(t) for i, t in texts_of(docs).items()}
    assert components(sets) == {i: i for i in sets}
    used, total = check_packed(rows(corpus_pipeline.run(spark, SF_DIR)), list(texts_of(docs).items()))
    assert used <= 1.02 * total / 2048 + 1


def test_pipeline_on_odd_rows(spark, odd, empty):
    for start in (odd, empty):
        docs = start
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF_DIR)
        docs.collect()
