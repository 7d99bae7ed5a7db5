"""Byte BPE, bit packing and packing against the public libraries and round trips."""

import base64
import hashlib
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from packing_check import check_packing
from sluice.llm import bitpack, bpe, chunks, hf, packing

TEXTS = [
    (0, "The quick, brown fox's  tail.\n\nNext line \n x\t y"),
    (1, ""),
    (2, None),
    (3, "a" * 50_000),
    (4, "éau ÀÉ ß 中文 　 İstanbul é \x1c x <|endoftext|> ΑΣ Σ ΑΣ."),
    (5, "same text\nsame text."),
    (6, "same text\nsame text."),
    (7, " \n"),
    (8, "word " * 3000),
    (9, "don't !!! foo*** 12345 x2 ²½ \r\n end"),
    (10, "\nlead"),
    (11, "x <|endoftext|> y<|endoftext|>\n<|startoftext|> z <|ENDOFTEXT|>, <|endoftext|>."),
    (12, "<|endoftext|><|endoftext|>  two"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "x") for i, t in TEXTS], "doc_id long, text string, length string").repartition(3)


def test_byte_bpe_matches_tiktoken(docs):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = {r["doc_id"]: r for r in bpe.digests(docs, path, public_tokenizers.PATTERN).collect()}
    for i, text in TEXTS:
        ids = own.encode_ordinary(text or "")
        assert rows[i]["n_tokens"] == len(ids)
        assert rows[i]["ids_sha256"] == hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest()
        assert rows[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    encoded = bpe.encode(docs, path, public_tokenizers.PATTERN)
    back = {r["doc_id"]: bytes(r["text_bytes"]) for r in bpe.decode(encoded, path, public_tokenizers.PATTERN).collect()}
    assert back == {i: (t or "").encode() for i, t in TEXTS}


def test_minimal_perfect_hash_is_minimal_and_perfect():
    for n in (1, 2, 7, 1000):
        keys = [b"k%d" % i for i in range(n)]
        table = bpe.MinimalPerfectHash(keys)
        assert sorted(table.value) == list(range(n))
        assert [table.slot_value(k) for k in keys] == list(range(n))


@pytest.mark.parametrize("kind", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_chunk_encoders_match_the_library(kind):
    path = public_tokenizers.path(kind)
    tokenizer = Tokenizer.from_file(path)
    encode = (hf.byte_level if kind.startswith("byte") else hf.lower_words)(path)
    for _, text in TEXTS:
        assert np.frombuffer(encode(text or ""), "<u4").tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("bits", [1, 5, 15, 16, 17, 31])
def test_bit_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 70_001).astype("<u4")
    raw = bitpack.pack(ids, bits)
    assert len(raw) == -(-len(ids) * bits // 8)
    for start, stop in ((0, 70_001), (0, 0), (3, 4), (65_535, 65_537), (70_000, 70_001)):
        assert bitpack.unpack(raw, bits, start, stop).tolist() == ids[start:stop].tolist()


def test_token_files_read_back(spark, docs, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    bitpack.write(docs, str(tmp_path / "t"), path, 2, block_tokens=40)
    rows = {r["doc_id"]: r for r in bitpack.documents(bitpack.read(spark, str(tmp_path / "t"))).collect()}
    at = 0
    for i, text in TEXTS:
        ids = np.asarray([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        assert (rows[i]["start"], rows[i]["n_tokens"], rows[i]["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    ids = [*tokenizer.encode(TEXTS[4][1], add_special_tokens=False).ids, 2]
    assert bitpack.token_range(spark, str(tmp_path / "t"), 4, 2, 5).tolist() == ids[2:5]
    bitpack.write(docs.limit(0), str(tmp_path / "e"), path, 2)
    assert bitpack.documents(bitpack.read(spark, str(tmp_path / "e"))).count() == 0


def test_packing_is_whole_and_tight(docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    ids = {i: np.asarray([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in TEXTS}
    rows = packing.pack(docs, path, 1).collect()
    assert check_packing(rows, ids) == 0
    assert packing.pack(docs.limit(0), path, 1).count() == 0


def test_fill_finds_the_closest_sum():
    rng = np.random.default_rng(3)
    for _ in range(200):
        counts = {int(n): int(c) for n, c in zip(rng.integers(1, 40, 5), rng.integers(1, 4, 5))}
        target = int(rng.integers(1, 80))
        sums = {0}
        for n, c in counts.items():
            sums = {s + n * k for s in sums for k in range(c + 1)}
        best = max(s for s in sums if s <= target)
        taken = packing.fill(counts, target)
        assert sum(n * c for n, c in taken.items()) == best
        assert all(c <= counts[n] for n, c in taken.items())


def test_plain_words_take_the_short_path_and_give_the_library_s_ids():
    words = "Thst inñgo œuvre Äpfel ŒUF ǅ ŉa ſo İx don naïve thst.%% Äpfel, ßen!? ª ²x Ωm и́ é straße*** <|x|>".split()
    texts = [" ".join(words), "\n".join(words), "", None, words[0], " ".join(words) + "  two", "\n" + " ".join(reversed(words)) + "\n"]
    for of, name in ((hf.byte_level, "byte_bpe_50k.json"), (hf.lower_words, "word_bpe_49k.json")):
        library, encode = Tokenizer.from_file(public_tokenizers.path(name)), of(public_tokenizers.path(name))
        want = [np.asarray(library.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        assert encode.texts(pa.array(texts, pa.string())) == want
        assert encode.texts(pa.array(["x", *texts, "y"], pa.string()).slice(1, len(texts))) == want
        assert encode.texts(pa.array([], pa.string())) == []

    asked = []
    encode = chunks.ChunkEncoder(lambda t: asked.append(t) or b"1234", lambda t: b"5678")
    assert encode("Thst inñgo\nÄpfel. thst") == b"5678" * 2 + b"1234" + b"5678" + b"1234" + b"5678"
    assert asked == ["\n", "."]


def test_pipeline_packs_with_a_small_memo(docs, monkeypatch):
    import corpus_pipeline

    given = {}
    real = packing.pack
    monkeypatch.setattr(corpus_pipeline.packing, "pack", lambda *a, **how: given.update(how) or real(*a, **how))
    rows = sorted(map(tuple, corpus_pipeline.pack_sequences(docs.sparkSession, docs, "").collect()))
    assert given["memo"] <= 32 << 20 and hf.byte_level(corpus_pipeline.TOKENIZER, given["memo"]).chunks.limit == given["memo"]
    assert rows == sorted(map(tuple, real(docs, corpus_pipeline.TOKENIZER, 1, memo=1000).collect()))
