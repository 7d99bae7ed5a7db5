"""The divergence audit beside a plain computation with Python's integers."""

import random
import re
from collections import Counter, defaultdict

import pytest
from sluice.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, shard int, term string, n string"


def plain(rows, min_docs, first):
    count, seen, groups = Counter(), defaultdict(set), defaultdict(set)
    for i, (text, lang, source) in enumerate(rows):
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        for term in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text or ""):
            term = "".join(c.lower() if c < "\x7f" else c for c in term)
            count[lang, source, term] += 1
            seen[lang, term].add(i)
    out = set()
    for lang, sources in groups.items():
        kept = sorted(t for (g, t), docs in seen.items() if g == lang and len(docs) >= min_docs)
        if kept:
            every = [sum(count[lang, s, t] for s in sources) for t in kept]
        weigh = lambda c: [1 + 10**9 * (x + 2) // (sum(c) + 2 * len(kept)) for x in c]
        p = {s: weigh([count[lang, s, t] for t in kept]) for s in sources} if kept else {}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(-sum(map(f, p[s], p[o])) if kept else 0, o.encode()) for o in sources if o != s]
            terms = [(-f(a, b), t.encode()) for t, a, b in zip(kept, p[s], weigh(every)) if count[lang, s, t] and a > b] if kept else []
            out |= {(lang, s, part, o.decode(), -v, i) for part, of in (("pair", sorted(pairs)), ("term", sorted(terms)[:first])) for i, (v, o) in enumerate(of, 1)}
    return out


@pytest.mark.parametrize("shard", [3, 10_000])
def test_beside_plain_integers(spark, shard):
    rng = random.Random(shard)
    rows = []
    for i in range(300):
        lang, source = rng.choice(["en", "fr", None, "few"]), rng.choice(["a", "b", "c", "Ä", None])
        words = rng.choices(["The", "the", "of", "naïve", "Été", "x_y", "b2b", "rare%d" % i, "of-" + str(source)], k=rng.randint(0, 25))
        rows.append((" ".join(words), lang, source))
    rows += [(None, "en", "silent"), ("", "none", "a"), ("123 !!", "none", "b"), ("alone", "one", "a"), *[("twin text", "en", "a")] * 12, ("the " * 9_000, "en", "long")]
    df = spark.createDataFrame([(i, *r, 7, "t", "n") for i, r in enumerate(rows)], SCHEMA).repartition(3)
    want = plain(rows, 10, 4)
    got = [tuple(r) for r in divergence.audit(df, first=4, shard=shard).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert {tuple(r) for r in divergence.audit(df, min_docs=1, first=500, shard=shard).collect()} == plain(rows, 1, 500)


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0
    assert divergence.audit(spark.createDataFrame([(1, "one", None, None, 1, "", "")], SCHEMA)).count() == 0
