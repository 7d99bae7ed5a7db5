"""Bounded memos keep what is frequent; op2's filter beyond its broadcast bound; op7 on odd tables."""

import random

import public_tokenizers
from sluice.llm import bpe, linedup, urlfilter
from sluice.llm.common import Memo


def test_memo_keeps_frequent_keys_within_its_bound():
    made = []
    memo = Memo(lambda k: made.append(k) or b"v" * 20, 20_000)
    rng = random.Random(1)
    for i in range(20_000):
        assert memo["often" if i % 3 == 0 else f"rare{rng.randrange(10**9)}"] == b"v" * 20
        assert memo.held + sum(Memo.ENTRY + len(k) + 20 for k in memo.older) <= 20_000 + 2 * (Memo.ENTRY + 40)
    assert made.count("often") == 1
    assert Memo(len, 10)["x" * 500] == 500


def test_line_filter_beyond_the_broadcast_bound(spark, monkeypatch):
    rng = random.Random(2)
    line = lambda: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(30))
    shared = [line() for _ in range(20)]
    rows = [(i, "\n".join([line(), shared[i % 20], line()]), "x") for i in range(200)] + [(900, None, "x"), (901, "", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string").repartition(3)
    want = sorted(map(tuple, linedup.remove(df).collect()), key=lambda r: r[0])
    assert sum(r[-1] for r in want) == 180
    monkeypatch.setattr(urlfilter, "MAX_BLOCKS", 4)
    out = linedup.remove(df)
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().optimizedPlan().toString().split("Aggregate")[0]
    assert sorted(map(tuple, out.collect()), key=lambda r: r[0]) == want


def test_bpe_on_odd_tables(spark):
    path, schema = public_tokenizers.path("byte_bpe_50k.tiktoken"), "doc_id long, text string, ids string"
    none = bpe.digests(spark.createDataFrame([], schema), path, public_tokenizers.PATTERN)
    assert none.count() == 0 and none.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    rows = [(1, "ab" * 60_000, "x"), (1, "ab" * 60_000, "x"), (None, "one two", "x"), (3, "é　 漢字" * 3_000, "x"), (4, " " * 5_000, "x"), (5, None, "x")]
    df = spark.createDataFrame(rows, schema)
    decoded = bpe.decode(bpe.encode(df, path, public_tokenizers.PATTERN), path, public_tokenizers.PATTERN)
    assert sorted(bytes(r.text_bytes) for r in decoded.collect()) == sorted((t or "").encode() for _, t, _ in rows)
    import tiktoken

    ranks = bpe.load_ranks(path)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {(r.doc_id, tuple(r.ids)) for r in bpe.encode(df, path, public_tokenizers.PATTERN).collect()}
    assert got == {(i, tuple(library.encode_ordinary(t or ""))) for i, t, _ in rows}
