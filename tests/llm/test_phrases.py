"""Phrases beside a plain count over small texts."""

import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from sluice.llm import phrases

SCHEMA = "doc_id long, text string, lang string, chunk int, places string, key string"


def plain(rows, min_count, longest, top):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", low):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    found = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= min_count}
    out = defaultdict(list)
    for (lang, p), a in found.items():
        around = [b for (other, q), b in found.items() if other == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
        if any(100 * b >= 80 * a for b in around):
            continue
        cuts = [(2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
        score, _, left, right = min(cuts)
        out[lang].append((-score, -a, " ".join(p).encode(), left, right))
    return {(lang, i, p.decode(), -a, left, right, n[lang], -score) for lang, of in out.items() for i, (score, a, p, left, right) in enumerate(sorted(of)[:top], 1)}


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, g, 1, "x", "y") for i, (t, g) in enumerate(rows)], SCHEMA).repartition(parts)


def found(df, **how):
    return {tuple(r) for r in phrases.collocations(df, **how).collect()}


@pytest.mark.parametrize("block", [40, 1 << 20])
def test_beside_plain_counts(spark, block):
    rng = random.Random(block)
    rows = []
    for i in range(120):
        words = rng.choices(["a", "B", "ÄÖ", "d", "ee", " ", "x" * 30], weights=[6, 5, 4, 3, 2, 1, 1], k=rng.randint(0, 40))
        rows.append(("".join(w + rng.choice([" ", " ", " ", "\t", "  ", ". ", ";", "\n", "\x0b"]) for w in words), rng.choice(["en", "fr", None])))
    rows += [(None, "en"), ("", None), (" \t\n", "xx"), ("one two three", "rare"), *[("same words here again", "en")] * 5, ("go on " * 4000, "en")]
    want = plain(rows, 4, 4, 12)
    assert want and found(frame(spark, rows), min_count=4, top=12, block=block) == want
    assert found(frame(spark, rows), min_count=4, longest=3, top=500, block=block) == plain(rows, 4, 3, 500)


def test_overlaps_ties_and_nothing(spark):
    rows = [("la la la la", "en")] * 3 + [("b c", "en")] * 9 + [("c d", "en")] * 9
    assert found(frame(spark, rows), min_count=2, top=50) == plain(rows, 2, 4, 50)
    assert found(frame(spark, rows).limit(0), min_count=2) == set()
    assert found(frame(spark, [("few words", "en"), (None, None)]), min_count=2) == set()


def test_long_texts_are_cut_where_pieces_end():
    raw = b"one two. three four; five, " * 50 + b"z" * 400 + b". end"
    parts = list(phrases.stretches(raw, 60))
    pieces = lambda x: [p.split() for p in re.split(rb"[.,;:!?\n-\r]", x) if p.split()]
    assert [p for part in parts for p in pieces(part)] == pieces(raw)
    assert all(len(p) <= 60 or b"z" in p for p in parts)


def test_names_of_rare_phrases_are_not_exchanged(spark, monkeypatch):
    monkeypatch.setattr(phrases, "HELD", 50)
    rows = [(f"rare{i} word{i}", "en") for i in range(300)] + [("often seen", "en")] * 7 + [("often seen", "fr")] * 2
    lists = phrases.word_lists(frame(spark, rows).select("lang", "text"), 400).cache()
    keys = phrases.frequent_keys(lists, 1, 7)
    shared = spark.sparkContext.broadcast(phrases.bloom(keys))
    named = phrases.list_lengths(lists, 1, shared).groupBy("lang", "phrase").sum("f").collect()
    assert {("en", "often", 7), ("en", "seen", 7)} <= {tuple(r) for r in named} and len(named) < 20
    assert keys.groupBy().sum("n").first()[0] == 2
    assert found(frame(spark, rows), min_count=7, top=50, block=400) == plain(rows, 7, 4, 50)


def test_packed_numbers_come_back():
    x = phrases.np.array([0, 1, 255, 256, 2**32 - 1])
    assert phrases._unpacked(phrases._packed(x)).tolist() == x.tolist()


@pytest.mark.parametrize("words, named_as_text", [(1 << 18, [1]), (3, [1, 2, 3, 4]), (0, [1, 2, 3, 4])])
def test_phrases_of_numbered_words_are_not_exchanged_as_text(spark, monkeypatch, words, named_as_text):
    sizes, lengths = [], phrases.list_lengths
    monkeypatch.setattr(phrases, "WORDS", words, raising=False)
    monkeypatch.setattr(phrases, "HELD", 60)
    monkeypatch.setattr(phrases, "list_lengths", lambda lists, size, *how: sizes.append(size) or lengths(lists, size, *how))
    rng = random.Random(7)
    rows = [(" ".join(rng.choices(["a", "b", "Ü", "dd", "e" * 140], k=25)) + ". " + " ".join(rng.choices("xyz", k=9)), rng.choice(["en", "fr", None])) for _ in range(150)]
    assert found(frame(spark, rows), min_count=6, top=400, block=300) == plain(rows, 6, 4, 400)
    assert sizes == [1, 2, 3, 4]  # the word of 140 bytes has no number
    sizes.clear()
    rows = [(text.replace("e" * 140, "e"), lang) for text, lang in rows]
    assert found(frame(spark, rows), min_count=6, top=400, block=300) == plain(rows, 6, 4, 400)
    assert sizes == named_as_text


def test_exact_names_come_back():
    for size in (2, 3, 4):
        of = phrases.np.random.default_rng(size).integers(0, 1 << 64 // size, (500, size))
        of[0], of[1] = 0, (1 << 64 // size) - 1
        names = phrases.exact_names(of)
        assert (phrases.named_words(names, size) == of).all() and len(set(names.tolist())) == len({tuple(x) for x in of.tolist()})
    big = phrases.np.array([0, 2**32, 2**64 - 1], phrases.np.uint64)
    assert phrases._unpacked(phrases._packed(big, 8), 8).tolist() == big.tolist()


def test_words_that_share_a_hash_have_one_number(monkeypatch):
    monkeypatch.setattr(phrases, "word_hashes", lambda raw: phrases.np.array([len(x) for x in raw.split()], phrases.np.uint64))
    words = phrases.pa.array([b"ccc", b"a", b"ddd", b"bb"])
    numbers = phrases.Numbers(words)
    assert numbers(phrases.pa.array([b"a", b"bb", b"ddd", b"ccc", b"zz", b"eeeee"])).tolist() == [1, 2, -1, 0, -1, -1]


def test_lists_take_a_few_bytes_a_word(spark, monkeypatch):
    written, materialise = {}, phrases.materialise

    def watched(df, label, **how):
        out = materialise(df, label, **how)
        written[label] = max(written.get(label, 0), sum(Path(x.removeprefix("file:")).stat().st_size for x in out.inputFiles()))
        return out

    monkeypatch.setattr(phrases, "materialise", watched)
    rng = random.Random(3)
    texts = [" ".join(f"w{min(int(rng.paretovariate(0.7)), 3000)}" for _ in range(500)) for _ in range(200)]
    phrases.frequencies(frame(spark, [(t, "en") for t in texts], 1))
    # plain numbers of 32 bits: 416,109 bytes of word lists
    assert written["word-lists"] < 3 * 100_000 and written["phrase-lists"] < 5 * 100_000


def test_packed_lists_come_back():
    np = phrases.np
    rng = np.random.default_rng(1)
    for size, lists, most in ((1, 1, 1), (2, 40, 300), (3, 2000, 70_000), (2, 5, 1 << 24)):
        codes = rng.integers(0, most, (lists, size))
        lengths = rng.integers(1, 9, lists)
        starts = np.append(0, np.cumsum(lengths))
        places = np.concatenate([np.sort(rng.choice(most * 9, n, replace=False)) for n in lengths])
        batch = phrases._pack("en", "ä b".encode(), codes, starts, places.astype(np.int32))
        ((lang, words, *back),) = phrases._unpack(batch, size)
        assert (lang, phrases.split_words(words).to_pylist(), phrases.joined_words(phrases.split_words(words))) == ("en", ["ä".encode(), b"b"], words)
        assert all(np.array_equal(a, b) for a, b in zip(back, (codes, starts, places)))
        ((*_, starts_again, none),) = phrases._unpack(batch.select(phrases.NAMED), size)
        assert none is None and np.array_equal(starts_again, starts)
    for most in (1, 1 << 16, 1 << 20, 1 << 50):
        x = rng.integers(0, most, 5000)
        assert np.array_equal(phrases.in_order(x), np.argsort(x, kind="stable"))
    assert len(phrases.in_order(np.zeros(0, np.int64))) == 0


def test_lengths_of_a_task_are_added_up_more_than_once(spark, monkeypatch):
    monkeypatch.setattr(phrases, "HELD", 600)
    phrases.small_batches(spark)
    named = spark.range(0, 4000, 1, 1).selectExpr("'en' AS lang", "concat('a b', id % 7) AS phrase", "id AS f")
    want = {(f"a b{k}", sum(range(k, 4000, 7))) for k in range(7)}
    assert {(r["phrase"], r["f"]) for r in phrases.text_lengths(named).collect()} == want
