"""Long texts that are in no language of the model are rejected, whatever they share with it by chance."""

import base64
import random

from sluice.llm import langid


def _text(rng, letters, n, vocabulary=400):
    own = ["".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(vocabulary)]
    return lambda: " ".join(rng.choices(own, k=n))


def test_unknown_languages_scripts_and_noise_are_rejected(spark):
    rng = random.Random(11)
    known = [_text(rng, letters, n) for letters in ("etaoinshrd", "aeiouplmnt") for n in (60, 500)]
    rows = [(i, known[i % 4](), "ab"[i % 4 // 2]) for i in range(800)]
    rows[3] = (3, rows[2][1], "a")  # texts may have a wrong label
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = langid.fit(train)
    kept = langid.keep(train, model)
    assert kept.count() >= 790
    latin = lambda n: " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(n))
    odd = [_text(rng, "gkvwzyjcub", n)() for n in (300, 3000)]
    odd += [_text(rng, "".join(map(chr, range(a, b))), n, 2000)() for a, b in ((0x3B1, 0x3CA), (0x430, 0x450), (0x4E00, 0x9000)) for n in (300, 3000)]
    odd += [latin(300), latin(3000), base64.b64encode(rng.randbytes(20_000)).decode()]
    unknown = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    got = {r.doc_id: r for r in langid.predict(unknown, model).collect()}
    assert [i for i, r in got.items() if not r.rejected] == []
    assert langid.keep(unknown, model).count() == 0


def test_floors_of_sparse_classes():
    assert langid._merged({20: (99, 0.8)}) is None
    floors = langid._merged({16: (60, 0.7), 20: (500, 0.8), 26: (50, 0.9)})
    at = lambda c: round(floors[c] / langid.MARGIN, 6)
    assert at(20) == 0.8 and at(40) == 0.8 and at(26) == 0.8
    assert at(16) == round(min(0.7, 0.8 / 2), 6) and at(12) == round(0.8 / 4, 6)
