"""Rooms of many unlinked members: what is sent grows with the members, and no link is lost."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from sluice.llm import jaccard


def pages(n, changed, seed, words=300):
    rng = random.Random(seed)
    template = [f"w{rng.randrange(10**9)}" for _ in range(words)]
    out = []
    for _ in range(n):
        page = list(template)
        for at in rng.sample(range(words), changed):
            page[at] = f"x{rng.randrange(10**12)}"
        out.append(" ".join(page))
    return out


def plain(texts, n, percent):
    sets = [set(jaccard.shingles(t, n).tolist()) for t in texts]
    least = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                a, b = least[i], least[j]
                least = [min(a, b) if x in (a, b) else x for x in least]
    return dict(enumerate(least))


def cells(spark, texts, percent):
    """The rows that are sent with their sets in one room of all texts."""
    rows = [(i, jaccard.shingles(t, 3)) for i, t in enumerate(texts)]
    sets = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in rows], "node long, set binary")
    tagged = spark.createDataFrame([(0, i, i, len(s)) for i, s in rows], "room long, node long, root long, size long")
    wide = spark.createDataFrame([(0, -1)], "room long, main long")
    return jaccard._wide_cells(tagged, wide, sets, percent)


def test_unlinked_templates_grow_in_proportion(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PART", 40)
    for n in (400, 800, 1600):
        assert cells(spark, pages(n, 8, n), 90).count() <= 2 * n


@pytest.mark.parametrize("percent", [85, 90])
def test_no_link_is_lost(spark, monkeypatch, percent):
    monkeypatch.setattr(jaccard, "PART", 25)
    rng = random.Random(percent)
    texts = pages(150, 8, 1, 120) + pages(60, 2, 1, 120) + pages(60, 4, 1, 120)
    for i in range(0, 40, 2):  # near copies of single pages
        words = texts[i].split()
        words[rng.randrange(len(words))] = "other"
        texts.append(" ".join(words))
    texts += [t + " tail end" for t in texts[:10]] + texts[5:15]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in jaccard.link(df, n=3, percent=percent).collect()}
    assert got == plain(texts, 3, percent)
    assert len(set(got.values())) > 25
