"""Texts of rare lengths, languages and scripts are judged too, whatever the corpus holds."""

import random

import public_tokenizers

from sluice.llm import fertility

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_sparse_classes_are_judged(spark):
    rng = random.Random(12)
    own = ["".join(rng.choices("etaoinshr", k=rng.randint(2, 7))) for _ in range(3000)]
    text = lambda n: " ".join(rng.choices(own, k=n))
    junk = lambda n: " ".join(rng.choices("bcdfghjklmnpqrstvwxz", k=n))
    rows = [(i, text(int(40 * 2 ** (i % 50 / 8))), "en") for i in range(1500)]
    clean = [(2000, text(20_000), "en"), (2001, text(200), "rare"), (2002, text(200), None)]
    odd = [(3000, junk(9000), "en"), (3001, junk(200), "other"), (3002, junk(200), None), (3003, junk(9000), "other")]
    df = spark.createDataFrame(rows + clean + odd, "doc_id long, text string, lang string").repartition(3)
    got = {r.doc_id: r for r in fertility.query(df, MODEL).collect()}
    assert len(got) == len(rows + clean + odd)
    assert not any(got[i].base_failed or got[i].kept for i, _, _ in odd)
    assert all(got[i].kept for i, _, _ in clean)


def test_sets_hold_enough_texts(spark):
    counted = [*[(f"l{i}", "Latin", 30, 1) for i in range(2)], ("en", "Latin", 10, 150), ("en", "Latin", 11, 60), ("en", "Latin", 14, 30), ("de", "Latin", 10, 5), ("ja", "Kana", 20, 7)]
    got = {(r.group, r.length_class): r for r in fertility._sets(spark.createDataFrame(counted, "group string, script string, length_class int, n long"), 100).collect()}
    n = {}
    for g, _, c, k in counted:
        for band in got[g, c].within:
            n[band] = n.get(band, 0) + k
    assert {k: n[r.band] for k, r in got.items()} == {("en", 10): 150, ("en", 11): 210, ("en", 14): 240, ("de", 10): 155, ("ja", 20): 254, ("l0", 30): 247, ("l1", 30): 247}
