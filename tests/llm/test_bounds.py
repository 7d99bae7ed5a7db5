"""Bounds of memory and of what the driver holds, repeated ids, and brute-force versions of verdicts."""

import random
import types
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from compare import DATA
from sluice.llm import bitpack, common, fertility, langid, queries, topk, toxicity


def test_memo_is_bounded_by_bytes():
    made = []
    memo = common.Memo(lambda k: made.append(k) or b"x" * 1000, 20_000)
    for i in range(500):
        memo[f"k{i % 250}"]
        assert memo.held <= 20_000 + 1300 and len(memo) < 20
    long = "y" * 100
    memo[long], memo[long]
    assert long not in memo and made.count(long) == 2


def test_scratch_folder():
    session = lambda master: types.SimpleNamespace(conf=types.SimpleNamespace(get=lambda *_: None), sparkContext=types.SimpleNamespace(master=master, applicationId="a"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        common.scratch_dir(session("spark://host:7077"))
    local = session("local[2]")
    assert common.scratch_dir(local) == common.scratch_dir(local)


def test_discarded_tables_are_gone(spark):
    df = common.materialise(spark.range(3), "kept")
    gone = common.materialise(spark.range(3), "gone")
    common.discard(gone, spark.range(1))
    assert df.count() == 3
    with pytest.raises(Exception):
        spark.read.parquet(gone.inputFiles()[0]).count()


def test_toxicity_is_bounded_with_repeated_ids(spark):
    rows = [(i, "villain scoundrel rogue" if i < 10 else f"plain words number {i}") for i in range(30)]
    docs = spark.createDataFrame(rows + [(7, f"villain copy {k}") for k in range(600)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 10)) for i in range(30)] + [(7, 1)] * 50, "doc_id long, toxic int")
    counted = toxicity._word_counts(docs, labels.select("doc_id", F.col("toxic").alias("y")).groupBy("doc_id").agg(F.max("y").alias("y")))
    got = {r.w: (r.a, r.b) for r in counted.collect()}
    assert got[None] == (610, 630) and got["villain"] == (610, 610) and got["plain"] == (0, 20)
    model = toxicity.fit(docs, labels)
    assert toxicity.score(docs, model).count() == 630


def test_token_files_with_repeated_ids(spark, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rows = [(5, "some text"), (5, "another text here"), (5, "some text"), (1, "first"), (None, "none"), (9, "last"), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen = []
    for n in (1, 4):
        bitpack.write(docs.repartition(n), str(tmp_path / f"t{n}"), path, 2, block_tokens=3)
        seen.append(sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in bitpack.documents(bitpack.read(spark, str(tmp_path / f"t{n}"))).collect()))
    assert seen[0] == seen[1]
    assert [i for _, i, _, _ in seen[0]] == [None, 1, 5, 5, 5, 9, 9]
    want = sorted(zlib.crc32(np.asarray([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()) for _, t in rows)
    assert sorted(c for *_, c in seen[0]) == want
    blocks = spark.read.parquet(str(tmp_path / "t4")).collect()
    assert all(b.first_doc == min((i for i in b.doc_ids if i is not None), default=None) for b in blocks)
    ids = [*library.encode("first", add_special_tokens=False).ids, 2]
    assert bitpack.token_range(spark, str(tmp_path / "t4"), 1, 0, 9).tolist() == ids


def test_lots_of_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROWS", 50)
    monkeypatch.setattr(topk, "LOT", 120)
    monkeypatch.setattr(topk, "QUERIES", 3)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(700, 6))
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, embedding array<double>").repartition(3)
    whole = np.floor(1024 * x).astype(np.int64)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.query(df).collect()}
    for q in range(0, 700, 100):
        best = sorted((-int(whole[q] @ v), i) for i, v in enumerate(whole) if i != q)[:10]
        assert [got[q, k + 1] for k in range(10)] == [(i, -s) for s, i in best]


def naive_cosines(text, model):
    """The vector by its definition, n-gram by n-gram."""
    letters, cleaned, last = 0, " ", True
    for ch in text.lower():
        if ch.isalpha():
            cleaned, last, letters = cleaned + ch, False, letters + 1
        elif not last or cleaned == " " and not letters and len(cleaned) > 1:
            cleaned, last = cleaned + " ", True
    count = {}
    for n in (1, 2, 3):
        for i in range(len(cleaned) - n + 1):
            h = ord(cleaned[i])
            for k in range(1, n):
                h = (h * 0x01000193 + ord(cleaned[i + k]) + k) % 2**32
            place = (h * 0x9E3779B1 % 2**32) >> (32 - langid.DIM.bit_length() + 1)
            count[place] = count.get(place, 0) + 1
    v = np.zeros(langid.DIM)
    for place, c in count.items():
        v[place] = np.log1p(c) * model.idf[place]
    return model.centroids @ (v / np.linalg.norm(v))


def test_nearest_centroid_by_definition(spark):
    rng = random.Random(5)
    pools = [["".join(rng.choices(a, k=rng.randint(2, 6))) for _ in range(200)] for a in ("abcdefg", "hijklmnö")]
    rows = [(i, " ".join(rng.choices(pools[i % 2], k=40)), "xy"[i % 2]) for i in range(120)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(train)
    for r in langid.predict(train.limit(40), model).collect():
        found = naive_cosines(rows[r.doc_id][1], model)
        best = int(found.argmax())
        assert r.lang_pred == model.languages[model.owner[best]] and r.cosine == pytest.approx(float(found.max()), abs=1e-5)


def test_fertility_verdicts_by_definition(spark):
    """Bands recomputed from the measured texts in plain Python, on the provided table."""
    got = fertility.query(spark.read.parquet(f"{DATA}/documents.parquet"), public_tokenizers.path("piece_bpe_32k.model")).toPandas()
    measured = fertility.measure(spark.read.parquet(f"{DATA}/documents.parquet"), public_tokenizers.path("piece_bpe_32k.model")).toPandas()
    d = got.merge(measured[["doc_id", "group", "script"]], on="doc_id")
    d["c"] = np.floor(2 * np.log2(d.n_tokens.clip(lower=1))).astype(int)
    good = d[~d.base_failed]
    sets = lambda r: [good[good.group == r.group], good[good.script == r.script], good]
    for r in d.itertuples():
        if r.base_failed:
            assert not r.kept
            continue
        own = next((s for s in sets(r) if len(s) >= 100), good)
        reach = 0
        while (abs(own.c - r.c) <= reach).sum() < min(100, len(own)) and reach < 128:
            reach += 1
        band = own[abs(own.c - r.c) <= reach]
        slope, centre = (np.polyfit(band.c, band.entropy, 1)[0] if band.c.nunique() > 1 else 0.0), band.c.mean()

        def inside(value, values, least, trend=0.0):
            values = np.sort(values)
            low, high = (values[max(0, int(np.ceil(q * len(values))) - 1)] for q in (0.25, 0.75))
            spread = 3.0 * max(high - low, least)
            return low - spread <= value - trend <= high + spread, min(abs(value - trend - low + spread), abs(value - trend - high - spread))

        one, two = inside(r.chars_per_token, band.chars_per_token, 0.03), inside(r.entropy, band.entropy, 0.005, slope * (r.c - centre))
        if min(one[1], two[1]) > 1e-6:  # not on an edge, where rounding decides
            assert r.kept == (one[0] and two[0] and r.byte_share <= 0.2), r


def test_toxicity_quality_on_held_out_labels(spark):
    folder = DATA.replace("0.001", "0.01")
    got = queries.queries()["op3_pu_toxicity"](spark, folder).toPandas().merge(pd.read_parquet(f"{folder}/labels.parquet"), on="doc_id")
    out = got[got.held_out]
    toxic, clean = out[out.toxic == 1].score, out[out.toxic == 0].score
    above = (toxic.to_numpy()[:, None] > clean.to_numpy()).mean() + 0.5 * (toxic.to_numpy()[:, None] == clean.to_numpy()).mean()
    assert above > 0.6 and (out[out.predicted == 1].toxic == 1).mean() > 0.8
