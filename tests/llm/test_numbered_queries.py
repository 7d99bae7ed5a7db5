"""The numbered queries on the smallest tables: beside their SQL, or by what their columns promise."""

import hashlib
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from compare import DATA, same
from packing_check import check_packing
from sluice.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    same(queries.queries()[name](spark, DATA), queries.oracle_sql()[name])


def rows_of(spark, name):
    return queries.queries()[name](spark, DATA).toPandas().set_index("doc_id").sort_index()


@pytest.fixture(scope="module")
def texts():
    return pd.read_parquet(f"{DATA}/documents.parquet").set_index("doc_id").sort_index()


def test_languages_held_out(spark, texts):
    got = rows_of(spark, "op1_nearest_centroid")
    assert len(got) == len(texts) and got.score.between(0, 1).all()
    out = got[got.held_out].join(texts[["lang"]]).dropna(subset=["lang"])
    assert (out.lang_pred == out.lang).mean() > 0.95


def test_toxicity_held_out(spark, texts):
    got = rows_of(spark, "op3_pu_toxicity")
    assert len(got) == len(texts) and ((got.score >= 0.5) == (got.predicted == 1)).all()


def test_base_counts(spark, texts):
    got = rows_of(spark, "op5_fertility_rules")
    assert len(got) == len(texts) and not (got.base_failed & got.kept).any()
    for doc, text in texts.text.items():
        words = [w for w in (text or "").encode().split()]
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        twice, hit = {w for w in windows if windows.count(w) > 1}, set()
        for i, w in enumerate(windows):
            hit |= set(range(i, i + 8)) if w in twice else set()
        r = got.loc[doc]
        assert (r.n_words, r.n_repeat_words) == (len(words), len(hit))
        assert r.word_chars == sum(len(w.decode()) for w in words)
        assert r.base_failed == (len(words) < 20 or 100 * len(hit) > 30 * len(words))


def test_byte_bpe_digests(spark, texts):
    import tiktoken

    import base64

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = rows_of(spark, "op7_byte_bpe")
    for doc, text in texts.text.items():
        ids = library.encode_ordinary(text or "")
        r = got.loc[doc]
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_token_files(spark, texts):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got, start = rows_of(spark, "op8_token_bitpack"), 0
    for doc, text in texts.text.items():
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        r = got.loc[doc]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes()))
        start += len(ids)


def test_packed_sequences(spark, texts):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {doc: np.asarray([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4") for doc, text in texts.text.items()}
    rows = queries.queries()["op9_bin_slack_packing"](spark, DATA).collect()
    assert check_packing(rows, want) == 0
