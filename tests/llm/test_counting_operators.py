"""Whitening, repeated strings and phrases against brute force, and on odd rows."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quadloom.llm import blocks, lines, phrases, quality, repeats, toxicity, whitening
from quadloom.llm.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"
KINDS = "doc_id long, text string, lang string, kept string, spans long, block long"


def passage(seed, words=40):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(words))


LONG = passage(1, 9000)
SHARED = passage(2)
ODD = [
    (1, None, None, None, 1, 1),
    (2, "", "en", "clash", 1, 1),
    (3, "  \t\n .,;", "en", "x", 1, 1),
    (4, SHARED + "\nfour. " + SHARED, "en", "x", 1, 1),
    (5, "before " + SHARED + " between " + SHARED[:70] + " after", "en", "x", 1, 1),
    (6, SHARED[20:100] + "é漢" + SHARED, "de", "x", 1, 1),
    (6, SHARED[20:100] + "é漢" + SHARED, "de", "x", 1, 1),
    (6, "another text of six " + SHARED[:60], "de", "x", 1, 1),
    (7, LONG, "en", "x", 1, 1),
    (8, LONG + " tail", "en", "x", 1, 1),
    (9, LONG[7:49_000] + "X" + LONG[49_001:], None, "x", 1, 1),
    (None, SHARED, "en", "x", 1, 1),
    (10, "a" * 400, "fr", None, 1, 1),
    (11, "b" + "a" * 300 + "c", "fr", None, 1, 1),
    (12, "éé" * 30, "fr", None, 1, 1),
    (13, "é" + "éé" * 30, "fr", None, 1, 1),
    (-5, SHARED[:51], "en", None, 1, 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, KINDS).repartition(4).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], KINDS)


# -- whitening -------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, x string, n long, whitened long"


def plain_whitening(rows, most, by_count=False):
    """The contract, on the driver."""
    ids, grids = [], []
    for i, v in rows:
        if v and all(c is not None and np.isfinite(c) for c in v):
            ids.append(i)
            grids.append([int(np.floor(256 * float(np.float32(c)))) for c in v])
    distinct = collections.Counter(map(tuple, grids))
    weights = np.array([c if by_count else 1 for c in distinct.values()])
    x = np.array(list(distinct))
    n = int(weights.sum())
    sums = (x * weights[:, None]).sum(0)
    centred = x - sums / n
    v = (centred * weights[:, None]).T @ centred / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:most], u[:, ::-1][:, :most]
    return n, sums, {k: (np.abs((np.array(g) - sums / n) @ u / np.sqrt(e)), sum((n * a - s) ** 2 for a, s in zip(g, sums.tolist()))) for k, g in enumerate(grids)}, ids, e / np.trace(v)


@pytest.mark.parametrize("by_count", [False, True])
def test_whitening_is_what_the_plain_computation_gives(spark, by_count):
    r = np.random.default_rng(3)
    base = r.normal(size=(60, 6)).astype(np.float32)
    rows = [(i, base[i % 40 if i % 3 else 0].tolist()) for i in range(200)]
    rows += [(200, None), (201, []), (202, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (203, [float("nan")] + [0.0] * 5), (204, [float("inf")] + [0.0] * 5), (205, [0.0] * 6), (None, [0.5] * 6), (205, [0.0] * 6)]
    rows += [(206, [1.0, 2.0]), (207, [1e30] + [0.0] * 5), (208, [-0.0] * 6)]
    df = spark.createDataFrame([(i, v, "clash", 1, 1) for i, v in rows], VECTORS).repartition(5)
    out = whitening.whiten(df, most=3, by_count=by_count)
    got = [g.asDict() for g in out.collect()]
    used = [(i, v) for i, v in rows if not (v and (len(v) != 6 or (v[0] is not None and v[0] == 1e30)))]
    n, sums, want, ids, share = plain_whitening(used, 3, by_count)
    assert sorted(str(g["vec_id"]) for g in got) == sorted(map(str, ids))
    assert {g["n"] for g in got} == {n} and all(g["identity_error"] < 1e-9 for g in got)
    for g in got:
        k = next(k for k, i in enumerate(ids) if i == g["vec_id"] )
        assert g["deviation"] == want[k][1]
        assert np.allclose(np.abs(g["whitened"]), want[k][0], atol=1e-9)
        assert np.allclose(g["explained"], share, rtol=1e-9)
    per = whitening.per_component(out).collect()
    assert len(per) == 3 * len(got) and {r["component"] for r in per} == {1, 2, 3}


def test_whitening_without_variance_or_rows(spark):
    none = spark.createDataFrame([], VECTORS)
    assert whitening.per_component(whitening.whiten(none)).count() == 0
    same = spark.createDataFrame([(i, [1.0, 2.0], "x", 1, 1) for i in range(5)], VECTORS)
    assert whitening.per_component(whitening.whiten(same)).count() == 0
    flat = spark.createDataFrame([(i, [float(i % 2), 2.0], "x", 1, 1) for i in range(6)], VECTORS)
    got = whitening.per_component(whitening.whiten(flat)).collect()
    assert {r["component"] for r in got} == {1} and {round(abs(r["whitened"]), 9) for r in got} == {1.0}


def test_whitening_of_large_entries_is_exact(spark):
    big = [(1, [3e7, 1.0]), (2, [-3e7, 2.0]), (3, [1e7, -5.0])]
    df = spark.createDataFrame([(i, v, "x", 1, 1) for i, v in big], VECTORS)
    grids = {i: [int(np.floor(256 * float(np.float32(c)))) for c in v] for i, v in big}
    sums = [sum(g[d] for g in grids.values()) for d in range(2)]
    want = {i: sum((3 * c - s) ** 2 for c, s in zip(g, sums)) for i, g in grids.items()}
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(df).collect()}
    assert got == {i: d if d < 2**63 else None for i, d in want.items()}


def test_op11_on_the_table(spark):
    got = QUERIES["op11_whitening"](spark, SF_DIR).collect()
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    n, _, want, ids, share = plain_whitening(rows, 4)
    at = {i: k for k, i in enumerate(ids)}
    assert len(got) == 4 * len(ids)
    for r in got:
        assert r["n"] == n and r["deviation"] == want[at[r["vec_id"]]][1] and r["identity_error"] < 1e-4
        assert abs(abs(r["whitened"]) - want[at[r["vec_id"]]][0][r["component"] - 1]) < 1e-8
        assert abs(r["explained"] - share[r["component"] - 1]) < 1e-9


# -- repeated strings ------------------------------------------------------------------


def plain_removal(rows, length):
    first = {}
    raw = [(i, (t or "").encode()) for i, t in rows]
    for i, b in raw:
        for k in range(len(b) - length + 1) if i is not None else ():
            w = b[k : k + length]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, b in raw:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1) if i is not None else ():
            if first[b[k : k + length]] < i:
                gone[k : k + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]]).astype(int)))
        spans = [(int(a), int(z - a)) for a, z in zip(edges[::2], edges[1::2])]
        out.append((i, bytes(np.frombuffer(b, np.uint8)[~gone]), len(b), int(gone.sum()), spans))
    return sorted(out, key=repr)


def removal(df, length):
    got = repeats.remove_repeats(df, length).collect()
    return sorted([(r["doc_id"], bytes(r["kept"]), r["n_bytes"], r["n_removed"], [tuple(s) for s in r["spans"]]) for r in got], key=repr)


@pytest.mark.parametrize("length", [50, 33])
def test_removal_on_odd_rows(odd, length):
    assert removal(odd, length) == plain_removal([(r[0], r[1]) for r in ODD], length)


def test_removal_on_documents_and_on_few_blocks(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    want = plain_removal([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()], 50)
    monkeypatch.setattr(repeats, "SHARD", 50)
    assert removal(docs, 50) == want
    assert sum(bool(w[4]) for w in want) > 20
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 10_000)
    assert removal(docs.repartition(7), 50) == want


def test_removal_of_nothing(empty):
    assert removal(empty, 50) == []
    with pytest.raises(ValueError):
        repeats.remove_repeats(empty, 10)


def plain_smallest(rows, low, length):
    best = {}
    texts = [bytes(r[: r[-1]]) for r in rows]
    for t, d in zip(texts, low):
        for i in range(len(t) - length + 1):
            best[t[i : i + length]] = min(best.get(t[i : i + length], 1 << 62), d)
    return [best[t[i : i + length]] for t in texts for i in range(len(t) - length + 1)]


@pytest.mark.parametrize("letters", [b"ab", b"a\0\xff", b"abcdefgh"])
def test_merged_transforms_find_every_repeated_interval(letters):
    r = random.Random(len(letters))
    for trial in range(40):
        length = r.choice([32, 50])
        width = 2 * length - repeats.GRAM
        base = bytes(r.choice(letters) for _ in range(400))
        rows = []
        for _ in range(r.randint(1, 40)):
            n = r.randint(length, width)
            s = r.randint(0, 400 - n)
            t = bytearray(base[s : s + n])
            if r.random() < 0.3:
                t[r.randrange(n)] = r.choice(letters)
            rows.append(list(t) + [0] * (width - n) + [n])
        rows = np.array(rows, np.uint8)
        rows = rows[repeats.distinct_rows(rows)[1]]
        low = np.array([r.randint(0, 30) for _ in rows])
        got, _ = repeats.smallest_docs(rows, low, length, shard=r.choice([1, 3, 7, 100]))
        assert got.tolist() == plain_smallest(rows, low, length)


def test_a_transform_is_that_of_sorted_suffixes():
    texts = [b"banana" * 6, b"ananas" * 6, b"banana" * 6 + b"s"]
    rows = np.zeros((3, 49), np.uint8)
    for k, t in enumerate(texts):
        rows[k, : len(t)] = list(t)
        rows[k, -1] = len(t)
    shard = repeats.Transform(rows, 32)
    suffixes = sorted((t[o:], k, o) for k, t in enumerate(texts) for o in range(len(t) + 1))
    assert [(int(k), int(o)) for k, o in zip(shard.text, shard.offset)] == [(k, o) for _, k, o in suffixes]
    assert shard.bwt.tolist() == [texts[k][o - 1] + 1 if o else 0 for _, k, o in suffixes]
    places = {(k, o): i for i, (_, k, o) in enumerate(suffixes)}
    assert all(shard.back[i] == places[k, o - 1] for i, (_, k, o) in enumerate(suffixes) if o)


# -- phrases ---------------------------------------------------------------------------


def plain_phrases(rows, max_words, min_count, percent, best):
    counts, n = collections.Counter(), collections.Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text, lang in rows:
        lang = lang or "und"
        n[lang] += 0
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                counts.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    found = {p: f for p, f in counts.items() if f >= min_count and len(p) > 2}
    inside = collections.defaultdict(int)
    for (lang, *w), f in found.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                inside[(lang, *w[i : i + k])] = max(inside[(lang, *w[i : i + k])], f)
    out = collections.defaultdict(list)
    for (lang, *w), a in found.items():
        if 100 * inside[(lang, *w)] >= percent * a and inside[(lang, *w)]:
            continue
        cuts = [(1000000 * a * a // (counts[(lang, *w[:k])] * counts[(lang, *w[k:])]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        phrase = " ".join(w)
        out[lang].append((-score, -a, phrase.encode(), phrase, counts[(lang, *w[:k])], counts[(lang, *w[k:])]))
    rows = []
    for lang, found in out.items():
        for rank, (score, a, _, phrase, l, r) in enumerate(sorted(found)[:best], 1):
            rows.append((lang, rank, phrase, -a, l, r, n[lang], -score))
    return sorted(rows)


def mined(df, *args):
    got = phrases.collocations(df, *args)
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in got.collect())


@pytest.mark.parametrize("args", [(3, 2, 50, 2000), (3, 3, 80, 5), (4, 2, 60, 30), (2, 10, 50, 2000)])
def test_phrases_on_odd_rows(odd, args):
    assert mined(odd, *args) == plain_phrases([(r[1], r[2]) for r in ODD], *args)


def test_phrases_in_small_segments_and_blocks(spark, monkeypatch):
    """Words and phrases across the borders of segments; fingerprints dealt out in parts."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    want = plain_phrases([(r["text"], r["lang"]) for r in docs.select("text", "lang").collect()], 3, 4, 50, 300)
    assert mined(docs, 3, 4, 50, 300) == want
    flat = np.frombuffer(b"one two  three.four\tfive six,seven " * 50 + b"x" * 500, np.uint8)
    whole = collections.Counter()
    for _, grams in phrases.n_grams(flat, np.array([0, 40, len(flat)]), np.zeros(2, np.uint64), 3):
        for k, (_, numbers) in grams.found.items():
            whole.update((k, int(x)) for x in numbers)
    monkeypatch.setattr(phrases, "SEGMENT", 64)
    parts = collections.Counter()
    for _, grams in phrases.n_grams(flat, np.array([0, 40, len(flat)]), np.zeros(2, np.uint64), 3):
        for k, (_, numbers) in grams.found.items():
            parts.update((k, int(x)) for x in numbers)
    assert parts == whole and sum(whole.values()) > 700


def test_phrases_are_counted_by_their_texts(spark):
    """Fingerprints only say where to look: with all of them as answers the counts are the same."""
    docs = spark.createDataFrame([(k, "aa bb cc dd " * 6 + "ee ff gg", "en") for k in range(3)], "doc_id long, text string, lang string")
    want = mined(docs, 3, 5, 50, 100)

    table = blocks.blocks(docs.select(F.col("text").cast("binary").alias("text"), "lang"), "colliding")
    true = {(r["n_words"], r["phrase"]): r["f"] for r in phrases.counted(table, all_answers(table, 3), 3).collect() if r["f"] >= 5 and r["n_words"]}
    assert {(len(p.split()), p) for _, _, p, *_ in want} <= set(true)
    assert true[1, "aa"] == 18 and true[2, "dd aa"] == 15


def all_answers(table, max_words):
    """Every fingerprint of every block as an answer: nothing is told apart but by the texts."""
    return blocks.frequent(phrases.fingerprints(table, 8, max_words), 1)


def test_phrases_of_nothing(empty):
    assert mined(empty) == []


def test_queries_are_registered():
    assert {"op11_whitening", "op12_repeats", "op13_phrases"} <= set(QUERIES)
    assert {"op12_repeats", "op13_phrases"} <= set(SQL) and "op11_whitening" not in SQL


# -- line dedup: the plan ------------------------------------------------------------------


def test_first_occurrences_come_from_the_sorted_stream(spark):
    """Ranges of (key, document), sorted by position, and a window over them; no exchange in between."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    plan = lines.shared_keys(lines.occurrences(docs))._jdf.queryExecution().executedPlan().toString()
    window, sort, dealt = plan.index("Window [lag(pos"), plan.index("Sort [h1"), plan.index("rangepartitioning(h1")
    assert window < sort < dealt and "Exchange" not in plan[window:sort]
    assert "Python" not in plan and "Arrow" not in plan


def test_bitmaps_of_a_very_long_document(spark):
    rows = [(k, "\n".join(f"a shared line of text number {i}" if i % 50 == 0 else f"own line {k} of many, number {i}" for i in range(20_000))) for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in lines.dedup_lines(docs).collect()}
    assert [got[k]["n_dropped"] for k in range(3)] == [400, 400, 0]
    assert got[0]["text"] == "\n".join(x for x in rows[0][1].split("\n") if not x.startswith("a shared"))
    assert got[2]["text"] == rows[2][1]


# -- classifiers: what they gather ---------------------------------------------------------


def test_classifiers_gather_one_row_per_document(spark, monkeypatch):
    """A doc_id on very many rows weighs no more than another one."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    first = labels.where("toxic = 1").select("doc_id").first()["doc_id"]
    many = docs.limit(1).select(F.lit(first).alias("doc_id"), F.explode(F.sequence(F.lit(1), F.lit(3000))).alias("k"), "lang", "source", "n_chars")
    crowded = docs.unionByName(many.select("doc_id", F.concat(F.lit("text number "), F.col("k").cast("string")).alias("text"), "lang", "source", "n_chars"))
    gathered, gather = [], type(docs).toArrow

    def counted(df):
        table = gather(df)
        gathered.append(table.num_rows)
        return table

    monkeypatch.setattr(type(docs), "toArrow", counted)
    quality.train(crowded, labels)
    toxicity.train(crowded, labels)
    ids = docs.select("doc_id").distinct().count()
    assert len(gathered) == 5 and max(gathered) <= ids
