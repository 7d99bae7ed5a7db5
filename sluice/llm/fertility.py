"""Quality rules from a public tokeniser's fertility, beside exact base counts.

Words are runs outside [\\x20\\x09-\\x0D]. A vocabulary with byte fallback encodes each word; a text's characters per
token, share of byte-fallback tokens and entropy of its tokens (over the logarithm of their number, so that lengths
compare) must lie within the bands of its language, or of its dominant script where the language is null. Bands are
fences around the quartiles of all texts of the group that pass the base rules, so they follow any corpus and cover
it whole.

Every text that passes the base rules is judged. Its band is that of its group and length class (half an octave of
tokens), widened by as many classes on both sides as it takes to hold ``min_group`` texts. A group of fewer texts in
all takes the band of its script in the same way, a script of fewer texts that of all texts; a corpus of fewer texts has
one band, of all of them. In a widened band entropy is compared less its trend over the length classes. Quartiles are
those of the rows of the whole set, not means of smaller sets' quartiles.

Null and empty texts have zero counts and fail the base rule. Repeated rows, and rows that share an id or have none, are
judged each and count each for the bands; equal values at a fence are kept. An empty table gives no rows. Columns
besides id, text and group are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import Memo, materialise, small_batches

SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
#: First code points of letters beyond Latin, and their scripts.
SCRIPTS = [(0, "Latin"), (0x370, "Greek"), (0x400, "Cyrillic"), (0x530, "Armenian"), (0x590, "Hebrew"), (0x600, "Arabic"), (0x900, "Indic"), (0xE00, "Thai"), (0x1100, "Hangul"), (0x1E00, "Latin"), (0x2000, "Other"), (0x3040, "Kana"), (0x3400, "Han"), (0xA000, "Other"), (0xAC00, "Hangul"), (0xD800, "Other")]
_STARTS = np.asarray([s for s, _ in SCRIPTS], np.uint32)
WINDOW = 8
SCHEMA = "doc_id long, group string, script string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_tokens long, n_byte_tokens long, entropy double"


@functools.cache
def vocabulary(path: str):
    """(token ids of a word as bytes, which ids are byte fallbacks) of a sentencepiece model, memoised per process."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    bytewise = np.asarray([model.is_byte(i) for i in range(model.get_piece_size())])
    return Memo(lambda word: np.asarray(model.encode(word.decode()), "<i4").tobytes(), 32 << 20), bytewise


def script(text: str) -> str:
    """The script of most code points that are no ASCII non-letters."""
    if text.isascii():
        return "Latin"
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    counts = np.bincount(np.searchsorted(_STARTS, points[points >= 65], "right") - 1, minlength=len(SCRIPTS))
    return SCRIPTS[int(counts.argmax())][1]


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in windows of ``window`` words found twice or more, the first included.

    Hashes find candidate windows; the words themselves decide.
    """
    n = len(words) - window + 1
    if n < 2:
        return 0
    hashed, sums = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64), np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(window):
            sums = sums * np.uint64(0x9E3779B97F4A7C15) + hashed[i : i + n]
    ordered = np.sort(sums)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    starts: dict[tuple, list[int]] = {}
    for i in np.flatnonzero(np.isin(sums, twice)).tolist():
        starts.setdefault(tuple(words[i : i + window]), []).append(i)
    steps = np.zeros(len(words) + 1, np.int64)
    for own in starts.values():
        if len(own) > 1:
            np.add.at(steps, own, 1)
            np.add.at(steps, np.asarray(own) + window, -1)
    return int((np.cumsum(steps) > 0).sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


def entropy(ids: np.ndarray) -> float:
    """Entropy of the ids over its largest value for as many ids; 1 for fewer than two."""
    if len(ids) < 2:
        return 1.0
    counts = np.bincount(ids) if len(ids) > 4000 else np.unique(ids, return_counts=True)[1]
    share = counts[counts > 0] / len(ids)
    return float(-(share * np.log2(share)).sum() / np.log2(len(ids))) + 0.0


def measure(docs: DataFrame, model: str, *, id_col: str = "doc_id", text_col: str = "text", group_col: str | None = "lang") -> DataFrame:
    """The counts of every whole text, in one pass without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, bytewise = vocabulary(model)
        for batch in batches:
            rows = []
            for doc, text, group in zip(*(c.to_pylist() for c in batch.columns)):
                text = text or ""
                words = text.encode().split()
                ids = np.frombuffer(b"".join(map(pieces.__getitem__, words)), "<i4")
                chars = len(text) - sum(map(text.count, SPACES)) if words else 0
                own = script(text)
                rows.append((doc, group or f"script {own}", own, len(words), chars, sum(map(text.count, SYMBOLS)), repeated_lines(text), repeated_words(words), len(ids), int(bytewise[ids].sum()), entropy(ids)))
            kinds = [pa.int64(), pa.string(), pa.string(), *[pa.int64()] * 7, pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=[x.split()[0] for x in SCHEMA.split(", ")])

    small_batches(docs.sparkSession)
    group = F.col(group_col).cast("string") if group_col else F.lit(None).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), group.alias("group")).mapInArrow(run, SCHEMA)


def judge(measured: DataFrame, *, min_words: int = 20, max_repeat_share: int = 30, reach: float = 3.0, max_byte_share: float = 0.2, min_group: int = 100) -> DataFrame:
    """Adds base_failed, the bands' verdicts and kept.

    A band reaches ``reach`` interquartile ranges beyond the quartiles of the texts of the group whose number of
    tokens is alike (within half an octave, or the widening above), as entropy falls with length and short texts
    scatter more.
    ``measured`` is read twice, so pass a table.
    """
    words, repeats = F.col("n_words"), F.col("n_repeat_words")
    scored = measured.withColumns(
        {
            "base_failed": (words < min_words) | (100 * repeats > max_repeat_share * words),
            "chars_per_token": F.try_divide("word_chars", "n_tokens"),
            "byte_share": F.coalesce(F.try_divide("n_byte_tokens", "n_tokens"), F.lit(0.0)),
            "length_class": F.floor(2 * F.log2(F.greatest("n_tokens", F.lit(1)))).cast("int"),
        }
    )
    fences = lambda c: F.percentile_approx(c, F.array(F.lit(0.25), F.lit(0.75)), F.lit(2000))
    good, kind = scored.where(~F.col("base_failed")), ["group", "script", "length_class"]
    counted = materialise(good.groupBy(*kind).agg(F.count("*").alias("n")), "band-counts")
    sets = materialise(_sets(counted, min_group), "band-sets")
    # a row counts in every set that holds its class
    bands = good.join(sets, kind).select(F.explode("within").alias("band"), "length_class", "chars_per_token", "entropy").groupBy("band")
    bands = bands.agg(fences("chars_per_token").alias("c"), fences("entropy").alias("e"), F.regr_slope("entropy", "length_class").alias("slope"), F.avg("length_class").alias("centre"))
    both = scored.join(sets.select(*kind, "band"), kind, "left").join(materialise(bands, "bands"), "band", "left")

    def within(value: Column, quartiles: str, least: float):
        q = F.col(quartiles)
        spread = F.greatest(q[1] - q[0], F.lit(least)) * reach
        return F.coalesce(value.between(q[0] - spread, q[1] + spread), F.lit(True))

    # across the classes of a widened band; none in a single class
    trend = F.coalesce(F.nanvl("slope", F.lit(0.0)) * (F.col("length_class") - F.col("centre")), F.lit(0.0))
    both = both.withColumns({"fertility_ok": within(F.col("chars_per_token"), "c", 0.03), "entropy_ok": within(F.col("entropy") - trend, "e", 0.005), "bytes_ok": F.col("byte_share") <= max_byte_share})
    return both.withColumn("kept", ~F.col("base_failed") & F.col("fertility_ok") & F.col("entropy_ok") & F.col("bytes_ok")).drop("c", "e", "slope", "centre", "band", "script", "length_class")


#: Length classes are half octaves of a number of tokens, fewer than so many.
CLASSES = 128


def _sets(counted: DataFrame, min_group: int) -> DataFrame:
    """For each group, script and length class (with n texts): the name of its band, and of all bands that its texts count in.

    A key is a group, a script or all texts; of each at most CLASSES counts meet in a row. Keys are joined by hash, so their
    number has no bound.
    """
    kind = ["group", "script", "length_class"]
    keys = [F.concat(F.lit("group "), "group"), F.concat(F.lit("script "), "script"), F.lit("all")]
    every = counted.select(*kind, "n", F.posexplode(F.array(*keys)).alias("wide", "key"))
    held = every.groupBy("key", "length_class").agg(F.sum("n").alias("n"))
    held = held.groupBy("key").agg(F.collect_list(F.struct("length_class", "n")).alias("counts"))

    def widen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, counts in zip(*(c.to_pylist() for c in batch.columns)):
                n = np.zeros(CLASSES, np.int64)
                for x in counts:
                    n[x["length_class"]] += x["n"]
                for c in np.flatnonzero(n).tolist():
                    reach = 0
                    while n[max(0, c - reach) : c + reach + 1].sum() < min_group and reach < CLASSES:
                        reach += 1
                    out.append((key, c, int(n.sum()), max(0, c - reach), min(CLASSES - 1, c + reach)))
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)] if out else [pa.array([], t) for t in kinds], names=["key", "length_class", "total", "low", "high"])

    ranges = materialise(held.mapInArrow(widen, "key string, length_class int, total long, low int, high int"), "band-ranges")
    name = F.concat_ws(" ", "key", "low", "high").alias("band")
    # the narrowest key with enough texts, or all
    fit = every.join(ranges, ["key", "length_class"]).where((F.col("total") >= min_group) | (F.col("key") == "all"))
    own = fit.groupBy(*kind).agg(F.min_by(F.struct("key", "low", "high", name), "wide").alias("x")).select(*kind, "x.*")
    own = materialise(own, "own-bands")
    used = own.select("key", "low", "high", "band").distinct()
    within = every.join(used, "key").where(F.col("length_class").between(F.col("low"), F.col("high"))).groupBy(*kind).agg(F.collect_set("band").alias("within"))
    return own.select(*kind, "band").join(within, kind)


def query(docs: DataFrame, model: str) -> DataFrame:
    """Measures once, then judges."""
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_tokens", "chars_per_token", "byte_share", "entropy"]
    return judge(materialise(measure(docs, model), "fertility")).select(*columns)
