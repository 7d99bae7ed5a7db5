"""The pipeline on a small corpus: what goes, what stays, and whole sequences at the end."""

import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from packing_check import check_packing


def test_pipeline(spark, tmp_path):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 7)))
    rows = [(i, "\n".join(" ".join(word() for _ in range(30)) for _ in range(3))) for i in range(300)]
    for i in range(0, 300, 6):
        rows[i] = (i, rows[i][1] + " villain scoundrel villain")
    passage = " ".join(word() for _ in range(60))
    rows[11], rows[13] = (11, rows[11][1] + "\n" + passage), (13, passage + "\n" + rows[13][1])
    rows += [(300, rows[7][1]), (301, rows[8][1].replace("\n", " ") + " x"), (302, rows[8][1].replace("\n", " ")), (303, None), (304, "12 34")]
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], columns).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(0, 300, 2)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    ids = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialise(stage(spark, docs, str(tmp_path)), "test")
        assert docs.schema.names == columns.replace(" long", "").replace(" string", "").split(", ")
        ids.append({r.doc_id for r in docs.select("doc_id").collect()})
    toxic = {i for i in range(0, 300, 6)}
    assert ids[0] == {i for i, _ in rows} - toxic
    assert ids[1] == ids[0] - {303, 304}
    assert ids[2] == ids[1] - {300}
    kept = {r.doc_id: r for r in docs.collect()}
    assert passage in kept[11].text and passage not in kept[13].text and kept[13].n_chars == len(kept[13].text)
    assert ids[3] == ids[2] - {301, 302}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: np.asarray([*tokenizer.encode(r.text, add_special_tokens=False).ids, 1], "<u4") for i, r in kept.items()}
    assert check_packing(corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect(), want) == 0


def test_pipeline_of_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
