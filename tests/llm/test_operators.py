"""Every operator on small tables with nulls, empty and long texts, ties, repeated rows and foreign columns."""

import itertools
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from sluice.llm import components, fertility, jaccard, langid, linedup, topk, toxicity, urlfilter

ODD = [(900, None), (901, ""), (902, " \n\t "), (903, "word"), (904, "x" * 30_000), (905, "twin text here"), (905, "twin text here"), (906, "1234 !!")]


def docs(spark, rows, n=3):
    """A documents table with odd rows and columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "en", 1, "z") for i, t in [*rows, *ODD]], "doc_id long, text string, lang string, size int, runs string").repartition(n)


def words(rng, n, letters="abcdefgh"):
    return ["".join(rng.choices(letters, k=rng.randint(2, 6))) for _ in range(n)]


# language


def test_languages(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(words(rng, 30, ("abcdefg", "qrstuvw", "ßöäüxyz")[i % 3]))) for i in range(150)]
    df = spark.createDataFrame([(i, t, "abq"[i % 3]) for i, t in rows] + [(i, t, None) for i, t in ODD], "doc_id long, text string, lang string")
    model = langid.fit(df.where("doc_id < 120"))
    got = {r.doc_id: r for r in langid.predict(df, model).collect()}
    assert all(got[i].lang_pred == "abq"[i % 3] for i in range(120, 150))
    assert all(0 <= r.score <= 1 for r in got.values())
    assert {i for i, r in got.items() if r.lang_pred == "und"} == {900, 901, 902, 906}
    assert all(got[i].rejected for i in (900, 901, 902, 906)) and not any(got[i].rejected for i in range(150))
    kept = langid.keep(df, model)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} >= set(range(150))
    none = langid.fit(df.limit(0))
    assert {r.lang_pred for r in langid.predict(df, none).collect()} == {"und"}
    far = spark.createDataFrame([(1, "漢字仮名交" * 100, None)], "doc_id long, text string, lang string")
    assert langid.predict(far, model).first().rejected


# toxicity


def test_toxicity(spark):
    rng = random.Random(2)
    rows = []
    for i in range(600):
        w = words(rng, 40)
        if i % 5 == 0:
            w[7:9] = ["villain", "scoundrel"]
        rows.append((i, " ".join(w)))
    df = docs(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(0, 450) if i % 3] + [(3, None), (None, 1), (5, 1), (5, 0)], "doc_id long, toxic int")
    model = toxicity.fit(df.where("doc_id < 450 or doc_id >= 900"), labels)
    got = {r.doc_id: r.score for r in toxicity.score(df, model).collect()}
    assert all((got[i] >= 0.5) == (i % 5 == 0) for i in range(450, 600))
    assert all(0 <= s <= 1 for s in got.values()) and not any(got[i] >= 0.5 for i, _ in ODD)
    kept = toxicity.keep(df, model)
    assert kept.columns == df.columns and kept.where("doc_id < 600").count() == 480
    empty = toxicity.fit(df, labels.limit(0))
    assert {r.score for r in toxicity.score(df, empty).collect()} == {0.0}
    assert toxicity.score(df.limit(0), model).count() == 0


# near duplicates


def brute_components(rows, n, percent):
    """(id, set size, component) of each row; rows of one id are one document."""
    sets = []
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets.append((i, set([tuple(w[k : k + n]) for k in range(len(w) - n + 1)] if len(w) >= n else [tuple(w)] if w else [])))
    parent = {i: i for i, _ in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (a, s), (b, t) in itertools.combinations(sets, 2):
        common = len(s & t)
        if common and 100 * common >= percent * (len(s) + len(t) - common):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return sorted((i, len(s), find(i)) for i, s in sets)


def linked(df, n, percent):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.link(df, n=n, percent=percent).collect())


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80), (1, 50), (1, 60), (1, 70), (2, 100)])
def test_signature_trees_match_brute_force(spark, n, percent):
    rng = random.Random(n)
    rows = []
    for _ in range(6):  # families of near copies, some chains of small edits
        base = words(rng, rng.randint(20, 150))
        for _ in range(18):
            rows.append((len(rows), " ".join(base)))
            base = [w if rng.random() > 0.012 else "edit" + str(rng.random()) for w in base]
    rows += [(len(rows) + k, " ".join(words(rng, 40))) for k in range(40)]
    pool = words(rng, 40)
    rows += [(len(rows) + k, " ".join(rng.choices(pool, k=rng.randint(1, 30)))) for k in range(60)]  # much in common, all sizes
    rows += [(len(rows) + k, "common line of many words here " + " ".join(words(rng, 5))) for k in range(30)]
    df = docs(spark, rows)
    assert linked(df, n, percent) == brute_components([*rows, *ODD], n, percent)


def test_many_parts_and_hot_buckets(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PART", 7)
    monkeypatch.setattr(jaccard, "FAN", 3)
    rng = random.Random(9)
    base, other = words(rng, 120), words(rng, 60)
    rows = [(i, " ".join(w if rng.random() > 0.015 else "e" + str(rng.random()) for w in base)) for i in range(60)]
    rows += [(60 + i, " ".join(w if rng.random() > 0.04 else "e" + str(rng.random()) for w in other)) for i in range(60)]  # few of them link
    rows += [(7, rows[100][1]), (7, ""), (3, rows[30][1])]  # ids of several texts
    assert linked(docs(spark, rows), 3, 90) == brute_components([*rows, *ODD], 3, 90)
    nameless = docs(spark, rows).union(docs(spark, [(None, rows[0][1])]).limit(0)).union(spark.createDataFrame([(None, rows[0][1], "en", 1, "z")], docs(spark, []).schema))
    assert jaccard.link(nameless, n=3, percent=90).where("doc_id is null").collect()[0].component_id is None
    assert jaccard.link(docs(spark, rows).limit(0), n=3, percent=90).count() == 0


def test_links_join_a_room_without_listing_pairs():
    rng = random.Random(10)
    base = [rng.getrandbits(63) for _ in range(300)]
    sets = [np.sort(np.asarray([x if rng.random() > 0.02 else rng.getrandbits(63) for x in base], np.uint64)) for _ in range(100)]
    names = np.arange(100) + 1000
    u, v = jaccard.forest(names, names, np.full(100, 3), sets, 80)
    assert len(u) == 99 and set(u) == set(range(1001, 1100)) and set(v) == {1000}
    sides = np.repeat([1, 2], 50)
    u, v = jaccard.forest(names, np.minimum(names, 1049), sides, sets, 80)
    assert set(u) == set(range(1001, 1050)) and set(v) == {1000}
    assert len(jaccard.forest(names, np.full(100, 5), sides, sets, 80)[0]) == 0


def test_one_row_of_each_component_stays(spark):
    rng = random.Random(11)
    a, b, c = (" ".join(words(rng, 40)) for _ in range(3))
    rows = [(5, a, 1), (5, a, 2), (9, a, 3), (None, a, 4), (7, b, 5), (7, a, 6), (None, b, 7), (None, c, 8), (None, c, 9), (3, "", 10), (4, "", 11), (4, None, 12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, text_hash long").repartition(3)
    got = jaccard.keep_one(df)
    assert got.columns == df.columns
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    assert kept == sorted([(5, a), (7, b), (None, c), (3, ""), (4, ""), (4, None)], key=str)
    assert jaccard.keep_one(df.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    root = {}
    for a, b in edges:
        root.setdefault(a, a), root.setdefault(b, b)
    for _ in range(100):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.u: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {k: v for k, v in root.items() if k != v}


def test_word_hashes_follow_words():
    for raw in (b"", b" \t", b"a b a", b"  lead trail ", b"y" * 500 + b" z", "é à é".encode()):
        parts, h = raw.split(), jaccard.word_hashes(raw)
        assert len(h) == len(parts)
        assert [parts.index(p) for p in parts] == [h.tolist().index(x) for x in h.tolist()]


# line runs


def brute_lines(rows, min_words):
    """Deletes by the definition: every line of a qualifying run with an earlier copy."""
    out, seqs = {}, []
    for i, text in sorted({(i, t) for i, t in rows if t is not None}):
        lines = [x.strip(linedup._SPACE) for x in text.split("\n")]
        seqs.append((i, text, [(k, x) for k, x in enumerate(lines) if x]))
    seen = set()
    for i, text, seq in seqs:
        gone, fresh = set(), []
        for a in range(len(seq)):
            for b in range(a + 1, len(seq) + 1):
                run = tuple(x for _, x in seq[a:b])
                if sum(len(x.split()) for x in run) >= min_words:
                    if run in seen:
                        gone |= set(range(a, b))
                    seen.add(run)
                fresh.append(run)
        cut = {k for p in range(len(seq)) if p in gone for k in range(seq[p][0], (seq[p + 1][0] if p + 1 in gone else seq[p][0] + 1))}
        out[i] = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in cut)
    return out


def test_line_runs_match_brute_force(spark):
    rng = random.Random(5)
    pool = [" ".join(words(rng, rng.randint(1, 6))) for _ in range(25)] + ["", "  "]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 14)))) for i in range(60)]
    rows += [(60 + k, rows[k][1]) for k in range(10)]
    df = docs(spark, rows)
    got = linedup.remove(df, min_words=8)
    assert got.columns == [*df.columns, "_n_lines", "_n_removed"]
    texts = {r.doc_id: r.text for r in got.collect()}
    want = brute_lines([*rows, *ODD], 8)
    assert {i: t for i, t in texts.items() if t is not None} == want and texts[900] is None
    assert got.count() == df.count()
    assert linedup.remove(df.limit(0)).count() == 0


# quality


def test_fertility_counts(spark):
    rng = random.Random(6)
    rows = [(i, "\n".join(" ".join(rng.choices(words(rng, 9) + ["a#", "<b>"], k=rng.randint(0, 12))) for _ in range(6))) for i in range(40)]
    rows += [(50, " ".join(["one two three four five six seven eight nine"] * 3)), (51, "same line\nsame line\n\nsame line")]
    got = {r.doc_id: r for r in fertility.query(docs(spark, rows), public_tokenizers.path("piece_bpe_32k.model")).collect()}
    for i, text in [*rows, *ODD]:
        text = text or ""
        w = text.split()
        grams = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
        twice = {g for g in grams if grams.count(g) > 1}
        covered = {k + j for k, g in enumerate(grams) if g in twice for j in range(8)}
        lines = [x for x in text.split("\n") if x.strip()]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text))
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 20 or 100 * len(covered) > 30 * len(w))
        assert r.kept is False if r.base_failed else r.kept in (True, False)
    assert fertility.query(docs(spark, []).limit(0), public_tokenizers.path("piece_bpe_32k.model")).count() == 0


def test_fertility_bands_reject_odd_texts(spark):
    rng = random.Random(7)
    rows = [(i, " ".join(words(rng, 100, "etaoinshr"))) for i in range(300)] + [(400, " ".join(["漢字仮名"[k % 4] * 3 + "ᚠᛇ" for k in range(100)]))]
    df = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
    got = {r.doc_id: r.kept for r in fertility.query(df, public_tokenizers.path("piece_bpe_32k.model")).collect()}
    assert not got[400] and sum(got[i] for i in range(300)) >= 297


# URLs


def test_url_rules(spark):
    urls = ["http://Example.ORG/es/x?q", "https://a.example.org/en/12#t", "http://example.org", "x.com/de/", None, "", "http://m.shop.com/de/1", "http://com/fr/", "ftp://notexample.org/es/", "http://spam-farm.example.net/p", "http://x.example.org/en/2", "a://b://c.com/de/", "http://spam-farm.example.com/de/1"]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)] + [(3, "x.com/de/", "x")], "page_id long, url string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.query(pages).collect()}
    assert got[0] == ("example.org", "/es/x", "example.org/es/", "block")
    assert got[1] == ("a.example.org", "/en/12", "example.org/en/1", "block")
    assert got[2] == ("example.org", "", None, "allow")
    assert got[3] == got[4] == got[5] == ("", "", None, "allow")
    assert got[6] == ("m.shop.com", "/de/1", "com/de/", "block")
    assert got[7] == ("com", "/fr/", "com/fr/", "allow")
    assert got[8] == ("notexample.org", "/es/", "org/", "allow")
    assert got[9] == ("spam-farm.example.net", "/p", None, "block")
    assert got[10] == ("x.example.org", "/en/2", "org/", "allow")
    assert got[11] == ("b:", "//c.com/de/", None, "allow")
    assert got[12] == ("spam-farm.example.com", "/de/1", "com/de/", "block")
    assert urlfilter.query(pages.limit(0)).count() == 0
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r.verdict for r in urlfilter.judge(pages, none).collect()} == {"allow"}


def test_bloom_passes_every_key_and_few_others(spark, monkeypatch):
    n = 100_000
    keys = spark.range(n).select(F.concat(F.lit("k"), "id").alias("key"))
    tried = spark.range(2 * n).select(F.concat(F.lit("k"), "id").alias("key"), "id")
    for most in (urlfilter.MAX_BLOCKS, 8):  # broadcast, or exchanged by block
        monkeypatch.setattr(urlfilter, "MAX_BLOCKS", most)
        passed = urlfilter.passing(tried, keys, n)
        hits, wrong = passed.where(f"id < {n}").count(), passed.where(f"id >= {n}").count()
        assert hits == n and wrong < 0.03 * n


def test_hosts_of_many_labels_and_lists_of_many_lengths(spark):
    listed = spark.range(3000).select(F.lit("far.net").alias("host"), F.concat(F.lit("/"), F.repeat(F.lit("a"), F.col("id").cast("int"))).alias("path"), F.lit("block").alias("verdict"))
    rows = [(1, "http://" + "x." * 20_000 + "far.net/aaaab"), (2, "http://far.net/"), (3, "http://" + "y." * 9_000 + "near.net/"), (4, "http://far.net/" + "a" * 5_000)]
    got = {r.page_id: (r.rule, r.verdict) for r in urlfilter.judge(spark.createDataFrame(rows, "page_id long, url string"), listed).collect()}
    assert got == {1: ("far.net/aaaa", "block"), 2: ("far.net/", "block"), 3: (None, "allow"), 4: ("far.net/" + "a" * 2999, "block")}


# top k


def test_top_k_matches_brute_force(spark):
    rng = np.random.default_rng(8)
    rows = [(int(i), [float(x) for x in rng.normal(size=12)]) for i in range(900)]
    rows += [(1000, rows[3][1]), (1001, rows[3][1]), (1002, [0.0] * 12), (1003, None), (1004, [1.0, None]), (1005, [float("nan")] * 12), (1006, [float("inf")] * 12), (1100, rows[3][1]), (1200, [0.5] * 3), (1300, [])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, rank int").repartition(5)
    got = {}
    for r in topk.query(df).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    whole = {i: np.pad(np.floor(1024 * np.asarray(v, float)).astype(np.int64), (0, 12 - len(v))) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)}
    assert set(got) == {i for i in whole if i % 100 == 0}
    for q, found in got.items():
        best = sorted(((-int(whole[q] @ v), i) for i, v in whole.items() if i != q))[:10]
        assert sorted(found) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
    few = df.where("vec_id in (100, 101, 102)")
    assert topk.query(few).count() == 2
    # ids of several rows: a repeated query counts once, another vector is ranked for itself
    twice = df.where("vec_id in (100, 1, 2, 3)").unionByName(df.where("vec_id = 100")).unionByName(df.where("vec_id = 5").withColumn("vec_id", F.lit(100).cast("long"))).unionByName(df.where("vec_id = 1"))
    got = sorted((r["rank"], r.vec_id, r.score) for r in topk.query(twice).collect())
    want = [(k + 1, i, -s) for q in (100, 5) for k, (s, i) in enumerate(sorted((-int(whole[q] @ whole[i]), i) for i in (1, 1, 2, 3)))]
    assert got == sorted(want)
    assert topk.query(df.limit(0)).count() == 0
