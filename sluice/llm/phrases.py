"""Phrase collocations from vertical positional inverted lists.

Texts are lower-cased (A-Z), split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and these at blanks and tabs into words. A phrase is two
to ``longest`` words that follow each other in a piece. All counts are per language, null counting as ``und``.

Method. Texts are gathered in blocks of about ``BLOCK`` bytes and one language. In a block every word has its inverted list,
the ascending places where it occurs; a place that no word has lies between pieces, so only words of one piece have
adjacent places. A phrase's list is that of the places where it begins. The lists of frequent phrases are extended by a
merge join of the places behind their occurrences with the adjacent postings: for two words these are the lists of the
frequent words, from three words on those of the frequent phrases that begin one word later, as a phrase is only
frequent if they are. The length of a list over all blocks is the phrase's exact frequency.

A phrase's list stays in pieces, one for each block, and a level is done block by block where the lists are, so no list,
however frequent its phrase, is gathered or sent anywhere. Lists are written as differences in few bytes and compressed; steps that only
count leave places unread. Words are first added up by keys of 40 bits of their hashes (as Park, Chen
and Yu prune candidates by buckets), and then as text, if their key reaches the least count. For each longer size the most frequent
words of the phrases found before (at most ``WORDS``, and ``BYTES`` of text) are numbered by language and sent to all tasks. A phrase
of two to four numbered words is named exactly by 64 bits, and lengths are added up by these names, of which sorted ones take a few bytes
for each phrase and task. Phrases with a word that has no number are added up as words are. If all those words have
numbers, phrases with another word are not frequent and are not counted.

Blocks learn what to extend by a Bloom filter of the keys that reach the least count, of four bits for each and of at most
``SLOTS`` words of 64 bits (8 MB), whatever their number. A list that it lets through wrongly costs work but changes nothing: no phrase
is more frequent than its parts, so what is built on it is not frequent either and falls by its own exact count.

Score. A cut of a candidate (frequency a) after k words has l and r, the frequencies of both sides, and the score
floor(2000000 * a / (l + r)), in decimals of 38 digits. The lowest-scoring cut counts, ties to the smallest k. Candidates
within a longer one of at least 80 percent of their frequency are left out, whether that one stays or not.

Null and empty texts have no words; repeated rows count each. Ties are settled by frequency, then by the phrase's bytes.
An empty table, or one without a frequent phrase, gives no rows. A text longer than a block is cut at the end of a piece; a piece
that is longer still is a block of its own. Columns besides text and language are not read.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import discard, materialise, small_batches
from sluice.llm.jaccard import _mix, word_hashes

MIN_COUNT, LONGEST, TOP, WITHIN_PERCENT = 30, 4, 2_000, 80
#: Bytes of text in a block, about.
BLOCK = 1 << 20
#: A block's lists are one row of up to some MB; files hold few of them together, so readers and writers do as well.
ROW_GROUPS = {"parquet.block.row.count.limit": "4", "parquet.page.size.row.check.min": "1", "parquet.enable.dictionary": "false"} | {
    "compression": "zstd",
    "parquet.compression.codec.zstd.level": "1",
}
#: Most words of a filter, and words in a slice of it.
SLOTS, SLICE = 1 << 20, 1 << 12
#: Bits of a key, of which the first 8 number its slice; keys that a task holds, about, before it adds them up and sends them.
KEY, HELD = 40, 1 << 20
#: Most words with numbers; bytes of one and of all at most; words of a phrase that is named by numbers, of 64 bits together.
WORDS, LONG, BYTES, NUMBERED = 1 << 18, 128, 8 << 20, 4
_BREAK = re.compile(rb"[.,;:!?\n-\r]+")


class Codes(dict):
    """Numbers the words from 0 as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


def stretches(raw: bytes, most: int = BLOCK) -> Iterator[bytes]:
    """A text in parts of at most ``most`` bytes, cut where pieces end; longer pieces stay whole."""
    while len(raw) > most:
        ends = [m.start() for m in _BREAK.finditer(raw, max(0, most - (1 << 16)), most)]
        at = ends[-1] if ends else (m.start() if (m := _BREAK.search(raw, most)) else len(raw))
        yield raw[:at]
        raw = raw[at:].lstrip(b".,;:!?\n\x0b\x0c\r")
    if raw:
        yield raw


def in_order(x: np.ndarray) -> np.ndarray:
    """The stable ascending order of numbers from 0, by 16 bits of them at a time."""
    order = np.argsort((x & 0xFFFF).astype(np.uint16), kind="stable")
    for shift in range(16, int(x.max(initial=0)).bit_length(), 16):
        order = order[np.argsort((x[order] >> shift & 0xFFFF).astype(np.uint16), kind="stable")]
    return order


class Block:
    """The words of some texts of one language by place."""

    def __init__(self):
        self.codes, self.parts, self.size = Codes({b".": 0}), [], 0

    def add(self, raw: bytes) -> None:
        # a break is a word of its own, which no text has
        words = _BREAK.sub(b" . ", raw.lower()).split()
        self.parts.append(np.fromiter(map(self.codes.__getitem__, words), np.int32, len(words)))
        self.parts.append(np.zeros(1, np.int32))
        self.size += len(raw) + 1

    def lists(self) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Words, where each one's list begins, and all lists after each other."""
        at = np.concatenate(self.parts)
        order = in_order(at).astype(np.int32)
        starts = np.searchsorted(at[order], np.arange(1, len(self.codes) + 1))
        return [w for w in self.codes if w != b"."], starts, order


#: A block's lists: its language, how many places they have, its words with a blank between them, of each list the words' numbers, its
#: length, and all lists after each other. Numbers are packed as differences.
PACKED = "lang string, n long, words binary, codes binary, lengths binary, places binary"
#: What is read where places are not.
NAMED = ["lang", "words", "codes", "lengths"]


def _pack(lang: str, words: bytes, codes: np.ndarray, starts: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
    lengths, first = np.diff(starts), starts[:-1]
    step = np.diff(places, prepend=0)
    step[first] = places[first]
    # one column of codes after the other; signs are the lowest bit
    turn = np.diff(codes.T.ravel().astype(np.int64), prepend=0)
    raw = [pa.array([x], pa.binary()) for x in (words, _narrow(turn << 1 ^ turn >> 63), _narrow(lengths), _narrow(step))]
    return pa.RecordBatch.from_arrays([pa.array([lang], pa.string()), pa.array([len(places)], pa.int64()), *raw], names=["lang", "n", "words", "codes", "lengths", "places"])


def _unpack(batch: pa.RecordBatch, size: int) -> Iterator[tuple[str, bytes, np.ndarray, np.ndarray, np.ndarray | None]]:
    """Language, words, codes (lists x ``size``), starts and, if they were read, places of each block."""
    for i in range(batch.num_rows):
        row = {name: batch.column(name)[i] for name in batch.schema.names}
        turn, lengths = (_widened(row[name].as_buffer()).astype(np.int64) for name in ("codes", "lengths"))
        codes = np.cumsum(turn >> 1 ^ -(turn & 1)).reshape(size, -1).T
        starts, places = np.append(0, np.cumsum(lengths)), None
        if "places" in row:
            step = _widened(row["places"].as_buffer()).astype(np.int64)
            places = np.cumsum(step)
            places -= np.repeat(places[starts[:-1]] - step[starts[:-1]], lengths)
        yield row["lang"].as_py(), row["words"].as_py(), codes, starts, places


def _narrow(x: np.ndarray) -> bytes:
    """Numbers from 0 below 2^32 by their first, second, ... bytes, as many as the largest one needs; that many comes first."""
    size = max(1, (int(x.max(initial=0)).bit_length() + 7) // 8)
    return bytes([size]) + x.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :size].T.tobytes()


def _widened(raw: bytes) -> np.ndarray:
    raw = np.frombuffer(raw, np.uint8)
    size = int(raw[0])
    out = np.zeros(((len(raw) - 1) // size, 4), np.uint8)
    out[:, :size] = raw[1:].reshape(size, -1).T
    return out.view("<u4").ravel()


def split_words(words: bytes) -> pa.Array:
    """The words that ``joined_words`` gave."""
    return pc.split_pattern(pa.array([words], pa.binary()), b" ").values


def joined_words(words: pa.Array) -> bytes:
    """Words with a blank between them; they hold none themselves."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), b" ")[0].as_py()


def word_lists(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The inverted lists of words in each block, packed; ``docs`` has lang and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Block] = {}
        size = 0

        def flush():
            for lang, own in held.items():
                words, starts, places = own.lists()
                if words:
                    # lists begin behind that of the breaks
                    yield _pack(lang, b" ".join(words), np.arange(len(words))[:, None], starts - starts[0], places[starts[0] :])
            held.clear()

        for batch in batches:
            for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                for raw in stretches((text or "").encode("utf-8", "replace"), block):
                    if lang not in held:
                        held[lang] = Block()
                    held[lang].add(raw)
                    size += len(raw)
                    if size >= block:
                        yield from flush()
                        size = 0
        yield from flush()

    return docs.mapInArrow(run, PACKED)


def extended(starts: np.ndarray, names: np.ndarray, places: np.ndarray, words: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge join: of the occurrences (starts, names) those with a posting (places, words) ``step`` places on.

    Gives starts, names and the posting's word. Starts and places are ascending.
    """
    at = np.searchsorted(places, starts + step)
    met = at < len(places)
    met[met] = places[at[met]] == starts[met] + step
    return starts[met], names[met], words[at[met]]


def phrase_hashes(lang: str, words: bytes, codes: np.ndarray) -> np.ndarray:
    """64-bit hashes of phrases given by their words' numbers."""
    return joined_hashes(lang, word_hashes(words), codes)


def joined_hashes(lang: str, own: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """64-bit hashes of phrases given by their words' numbers, of words given by their hashes."""
    out = np.full(len(codes), word_hashes(b"_" + lang.encode("utf-8", "replace").hex().encode())[0], np.uint64)
    with np.errstate(over="ignore"):
        for k in range(codes.shape[1]):
            out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + own[codes[:, k]])
    return out


def phrase_keys(lang: str, words: bytes, codes: np.ndarray) -> np.ndarray:
    """The first ``KEY`` bits of phrases' hashes."""
    return phrase_hashes(lang, words, codes) >> np.uint64(64 - KEY)


def _bits(keys: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each key its slot in a filter, and its four bits there."""
    with np.errstate(over="ignore"):
        hashes = _mix(keys * np.uint64(0x9E3779B97F4A7C15))
    bits = np.zeros(len(hashes), np.uint64)
    for shift in (0, 6, 12, 18):
        bits |= np.uint64(1) << ((hashes >> np.uint64(shift)) & np.uint64(63))
    return ((hashes >> np.uint64(24)) % np.uint64(slots)).astype(np.int64), bits


def _packed(x: np.ndarray, size: int = 4) -> bytes:
    """Unsigned numbers of 4 or 8 bytes by their first, second, ... bytes: small ones leave runs of zeros to compress."""
    return x.astype(f"<u{size}").view(np.uint8).reshape(-1, size).T.tobytes()


def _unpacked(raw: bytes, size: int = 4) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(f"<u{size}").ravel()


def added_up(keys: np.ndarray, counts: np.ndarray, most: int = np.iinfo(np.int64).max) -> tuple[np.ndarray, np.ndarray]:
    """The keys once each, ascending, and the sums of their counts, at most ``most``."""
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.minimum(np.add.reduceat(counts, first), most) if len(first) else counts


class Numbers:
    """The numbers of a language's words, from 0 by falling frequency; none for words that share a hash with an earlier one."""

    def __init__(self, words: pa.Array):
        hashes, of = np.unique(word_hashes(b" ".join(words.to_pylist())), return_index=True)
        kept = np.sort(of)
        self.words = words.take(pa.array(kept))
        self.sorted, self.of = hashes, np.searchsorted(kept, of)
        self.hashes = np.empty_like(hashes)
        self.hashes[self.of] = hashes

    def __call__(self, words: pa.Array) -> np.ndarray:
        """Each word's number, or -1."""
        own = word_hashes(joined_words(words))
        at = np.minimum(np.searchsorted(self.sorted, own), len(self.sorted) - 1)
        found = self.of[at]
        same = pc.equal(self.words.take(pa.array(found)), words).to_numpy(zero_copy_only=False)
        return np.where(same, found, -1)


def numbered_words(frequent: DataFrame, size: int) -> tuple[dict[str, Numbers], bool]:
    """Numbers, for phrases of ``size`` words, of the most frequent words in ``frequent`` (lang, phrase, f) by language, and
    whether none is left without."""
    words = frequent
    if size > 2:
        words = frequent.select("lang", F.explode(F.split("phrase", " ")).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    most = words.where(F.octet_length("phrase") <= LONG).orderBy(F.desc("f"), "lang", "phrase").limit(WORDS).select("lang", F.col("phrase").cast("binary").alias("word")).toArrow().combine_chunks()
    out = {}
    if most.num_rows:
        langs = pc.dictionary_encode(most["lang"].combine_chunks())
        codes, names = langs.indices.to_numpy(), most["word"].combine_chunks()
        codes = codes[: np.searchsorted(np.cumsum(pc.binary_length(names).to_numpy()), BYTES, "right")]
        order = np.argsort(codes, kind="stable")
        for lang, of in zip(langs.dictionary.to_pylist(), np.split(order, np.cumsum(np.bincount(codes))[:-1])):
            out[lang] = Numbers(names.take(pa.array(of[: 1 << 64 // size])))
    return out, sum(len(x.words) for x in out.values()) == words.count()


def numbers_of(lang: str, words: bytes, codes: np.ndarray, numbers: dict[str, Numbers]) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the words of each phrase, and which phrases have one for every word."""
    if lang not in numbers or not len(codes) or codes.shape[1] > NUMBERED:
        return codes, np.zeros(len(codes), bool)
    of = numbers[lang](split_words(words))[codes]
    return of, (of >= 0).all(1)


def exact_names(of: np.ndarray) -> np.ndarray:
    """Phrases of two to four numbered words as one number of 64 bits each: four bits of the second word follow the first word."""
    of, bits = of.astype(np.uint64), np.uint64(64 // of.shape[1])
    out = of[:, 0] << bits | (of[:, 1] & np.uint64(15)) << bits - np.uint64(4) | of[:, 1] >> np.uint64(4)
    for k in range(2, of.shape[1]):
        out = out << bits | of[:, k]
    return out


def named_words(names: np.ndarray, size: int) -> np.ndarray:
    """The words' numbers of ``exact_names``."""
    bits = 64 // size
    of = [names >> np.uint64(bits * k) & np.uint64((1 << bits) - 1) for k in range(size - 1, -1, -1)]
    of[1] = of[1] >> np.uint64(bits - 4) | (of[1] & np.uint64((1 << bits - 4) - 1)) << np.uint64(4)
    return np.stack(of, axis=1).astype(np.int64)


def numbered_counts(lists: DataFrame, size: int, min_count: int, shared) -> DataFrame:
    """(lang, names, counts, hashes, n): phrases of numbered words that occur ``min_count`` times, packed, with the keys for the filter.

    Tasks add up the counts of their blocks and send sorted names by the first word and four bits of the second, so that
    differences stay small and no word's phrases are all in one slice.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        new: dict[str, list] = {}
        n = 0

        def merge() -> int:
            for lang, of in new.items():
                held[lang] = added_up(*map(np.concatenate, zip(*([held[lang]] if lang in held else []), *of)))
            new.clear()
            return sum(len(names) for names, _ in held.values())

        def dealt() -> Iterator[pa.RecordBatch]:
            for lang, (names, counts) in held.items():
                with np.errstate(over="ignore"):
                    of = (_mix((names >> np.uint64(64 // size * (size - 1) - 4)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)).astype(np.int64)
                order = np.argsort(of, kind="stable")  # names stay ascending in each slice
                names, counts = names[order], counts[order]
                ends = np.append(0, np.cumsum(np.bincount(of, minlength=256)))
                parts = {i: slice(a, b) for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())) if b > a}
                raw = [pa.array([_packed(x(p), 8) for p in parts.values()], pa.binary()) for x in (lambda p: np.diff(names[p], prepend=np.uint64(0)), lambda p: counts[p])]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(parts), pa.string()), pa.array(list(parts), pa.int32()), *raw], names=["lang", "slice", "names", "counts"])
            held.clear()

        for batch in batches:
            for lang, words, codes, starts, _ in _unpack(batch, size):
                of, all_ = numbers_of(lang, words, codes, shared.value)
                if all_.any():
                    new.setdefault(lang, []).append((exact_names(of[all_]), np.diff(starts)[all_].astype(np.int64)))
                    n += int(all_.sum())
                if n >= HELD:
                    n = 0
                    if merge() >= HELD:
                        yield from dealt()
        merge()
        yield from dealt()

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, new, n = None, (np.zeros(0, np.uint64), np.zeros(0, np.int64)), [], 0

        def found() -> Iterator[pa.RecordBatch]:
            names, counts = added_up(*map(np.concatenate, zip(held, *new)))
            names, counts = names[counts >= min_count], counts[counts >= min_count]
            if len(names):
                hashes = joined_hashes(at[0], shared.value[at[0]].hashes, named_words(names, size)) >> np.uint64(64 - KEY)
                raw = [pa.array([x], pa.binary()) for x in (_packed(names, 8), _packed(counts, 8), hashes.astype("<u8").tobytes())]
                yield pa.RecordBatch.from_arrays([pa.array([at[0]], pa.string()), *raw, pa.array([len(names)], pa.int64())], names=["lang", "names", "counts", "hashes", "n"])

        for batch in batches:
            for lang, k, names, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if (lang, k) != at:
                    if at is not None:
                        yield from found()
                    at, held, new, n = (lang, k), (np.zeros(0, np.uint64), np.zeros(0, np.int64)), [], 0
                names = np.cumsum(_unpacked(names, 8), dtype=np.uint64)
                new.append((names, _unpacked(counts, 8).astype(np.int64)))
                n += len(names)
                if n >= HELD + len(held[0]):
                    held, new, n = added_up(*map(np.concatenate, zip(held, *new))), [], 0
        if at is not None:
            yield from found()

    dealt = lists.select(NAMED).mapInArrow(count, "lang string, slice int, names binary, counts binary").repartition("lang", "slice").sortWithinPartitions("lang", "slice")
    return dealt.mapInArrow(total, "lang string, names binary, counts binary, hashes binary, n long")


def spelled(counted: DataFrame, size: int, shared) -> DataFrame:
    """(lang, phrase, f) of ``numbered_counts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, names, counts in zip(*(c.to_pylist() for c in batch.columns)):
                of, counts, words = named_words(_unpacked(names, 8), size), _unpacked(counts, 8).astype(np.int64), shared.value[lang].words.cast(pa.string())
                yield from _named(lang, words, of, counts)

    return counted.select("lang", "names", "counts").mapInArrow(run, "lang string, phrase string, f long")


def _named(lang: str, words: pa.Array, codes: np.ndarray, lengths: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(codes), 50_000):
        part = codes[at : at + 50_000]
        named = [words.take(pa.array(part[:, k])) for k in range(codes.shape[1])]
        phrase = pc.binary_join_element_wise(*named, " ") if len(named) > 1 else named[0]
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.string()), phrase, pa.array(lengths[at : at + 50_000])], names=["lang", "phrase", "f"])


def frequent_keys(lists: DataFrame, size: int, min_count: int, numbers=None) -> DataFrame:
    """(hashes, n): keys of ``KEY`` bits that phrases of together ``min_count`` occurrences at least share, packed by slice;
    if the broadcast ``numbers`` are given, only of phrases with a word that has none.

    Tasks add up the counts of their blocks and send each slice of the keys as the sorted keys' differences and the counts.
    Every frequent phrase's key is among them, as a sum of counts is not below any of them.
    """

    def send(slices: dict[int, np.ndarray], counts: dict[int, np.ndarray]) -> pa.RecordBatch:
        raw = [pa.array([_packed(x) for x in of.values()], pa.binary()) for of in (slices, counts)]
        return pa.RecordBatch.from_arrays([pa.array(list(slices), pa.int32()), *raw], names=["slice", "keys", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, new, n = (np.zeros(0, np.uint64), np.zeros(0, np.int64)), [], 0

        def dealt() -> pa.RecordBatch:
            keys, counts = held
            ends = np.searchsorted(keys >> np.uint64(32), np.arange((1 << KEY - 32) + 1))
            parts = {i: slice(a, b) for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())) if b > a}
            low = (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
            return send({i: np.diff(low[x], prepend=0) for i, x in parts.items()}, {i: counts[x] for i, x in parts.items()})

        for batch in batches:
            for lang, words, codes, starts, _ in _unpack(batch, size):
                lengths = np.diff(starts).astype(np.int64)
                if numbers:
                    of = ~numbers_of(lang, words, codes, numbers.value)[1]
                    codes, lengths = codes[of], lengths[of]
                new.append((phrase_keys(lang, words, codes), lengths))
                n += len(codes)
                if n >= HELD:
                    held, new, n = added_up(*map(np.concatenate, zip(held, *new)), min_count), [], 0
                    if len(held[0]) >= HELD:
                        yield dealt()
                        held = (held[0][:0], held[1][:0])
        held = added_up(*map(np.concatenate, zip(held, *new)), min_count)
        if len(held[0]):
            yield dealt()

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, new, n = None, (np.zeros(0, np.uint32), np.zeros(0, np.int64)), [], 0

        def found() -> pa.RecordBatch:
            keys, counts = added_up(*map(np.concatenate, zip(held, *new)), min_count)
            keys = keys[counts >= min_count].astype(np.uint64) | np.uint64(at << 32)
            return pa.RecordBatch.from_arrays([pa.array([keys.astype("<u8").tobytes()], pa.binary()), pa.array([len(keys)], pa.int64())], names=["hashes", "n"])

        for batch in batches:
            for k, keys, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if k != at:
                    if at is not None:
                        yield found()
                    at, held, new, n = k, (np.zeros(0, np.uint32), np.zeros(0, np.int64)), [], 0
                keys = np.cumsum(_unpacked(keys), dtype=np.uint64).astype(np.uint32)
                new.append((keys, _unpacked(counts).astype(np.int64)))
                n += len(keys)
                if n >= HELD + len(held[0]):
                    held, new, n = added_up(*map(np.concatenate, zip(held, *new)), min_count), [], 0
        if at is not None:
            yield found()

    dealt = lists.select(NAMED).mapInArrow(count, "slice int, keys binary, counts binary").repartition("slice").sortWithinPartitions("slice")
    return dealt.mapInArrow(total, "hashes binary, n long")


def bloom(frequent: DataFrame) -> np.ndarray:
    """The filter of keys (hashes, n): tasks build it in slices, which are or-combined before they reach the driver."""
    slots = min(SLOTS, max(SLICE, 1 << int((frequent.agg(F.sum("n")).first()[0] or 0) // 4).bit_length()))

    def send(slices: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(slices), pa.int32()), pa.array([x.tobytes() for x in slices.values()], pa.binary())], names=["slice", "bits"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(slots, np.uint64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                np.bitwise_or.at(held, *_bits(np.frombuffer(raw, "<u8"), slots))
        parts = held.reshape(-1, SLICE)
        yield send({i: parts[i] for i in np.flatnonzero(parts.any(1)).tolist()})

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(*(c.to_pylist() for c in batch.columns)):
                held[k] = held.get(k, np.uint64(0)) | np.frombuffer(raw, np.uint64)
        if held:
            yield send(held)

    out, schema = np.zeros(slots, np.uint64), "slice int, bits binary"
    for r in frequent.select("hashes").mapInArrow(build, schema).repartition("slice").mapInArrow(combine, schema).collect():
        out[r["slice"] * SLICE : (r["slice"] + 1) * SLICE] = np.frombuffer(bytes(r["bits"]), np.uint64)
    return out


def passed(lang: str, words: bytes, codes: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Which phrases the filter lets through."""
    slot, bits = _bits(phrase_keys(lang, words, codes), len(held))
    return (held[slot] & bits) == bits


def extend_block(lang: str, words: bytes, codes: np.ndarray, starts: np.ndarray, places: np.ndarray, held: np.ndarray):
    """One level for one block: the lists that the filter passes give the lists of phrases one word longer."""
    names = split_words(words)
    lengths = np.diff(starts)
    lists = np.repeat(np.arange(len(codes)), lengths)[of := np.repeat(passed(lang, words, codes, held), lengths)]
    own = places[of]
    order = in_order(own)
    own, lists = own[order], lists[order]
    begins, left, right = extended(own, lists, own, lists, 1)
    last = codes[right, -1].astype(np.int64)
    key = left * np.int64(len(names) + 1) + last
    order = in_order(key)  # places stay ascending in each list
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    longer = np.concatenate([codes[left[order[first]]], last[order[first], None]], axis=1)
    used, longer_codes = np.unique(longer, return_inverse=True)
    return joined_words(names.take(pa.array(used))), longer_codes.reshape(longer.shape), np.append(first, len(key)), begins[order]


def longer_lists(lists: DataFrame, size: int, shared) -> DataFrame:
    """The packed lists of phrases of ``size`` + 1 words from those of ``size`` words that the broadcast filter passes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, words, codes, starts, places in _unpack(batch, size):
                longer = extend_block(lang, words, codes, starts, places, shared.value)
                if len(longer[1]):
                    yield _pack(lang, *longer)

    return lists.mapInArrow(run, PACKED)


def list_lengths(lists: DataFrame, size: int, shared, numbers=None) -> DataFrame:
    """(lang, phrase, f): name and length of each list that the broadcast filter passes, a row for each block that has the phrase;
    if the broadcast ``numbers`` are given, only of phrases with a word that has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, words, codes, starts, _ in _unpack(batch, size):
                of = passed(lang, words, codes, shared.value)
                if numbers:
                    of &= ~numbers_of(lang, words, codes, numbers.value)[1]
                yield from _named(lang, split_words(words).cast(pa.string()), codes[of], np.diff(starts)[of].astype(np.int64))

    return lists.select(NAMED).mapInArrow(run, "lang string, phrase string, f long")


def text_lengths(named: DataFrame) -> DataFrame:
    """(lang, phrase, f): lengths (lang, phrase, f) added up by phrase.

    Tasks add up their own and send sorted phrases as one text for each of 64 slices, so that they compress well.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def merged() -> pa.Table:
            return pa.Table.from_batches(held).group_by(["lang", "slice", "phrase"]).aggregate([("f", "sum")]).rename_columns({"f_sum": "f"}).select(["lang", "phrase", "f", "slice"]).combine_chunks()

        def dealt(of: pa.Table) -> Iterator[pa.RecordBatch]:
            of = of.sort_by([("lang", "ascending"), ("slice", "ascending"), ("phrase", "ascending")]).combine_chunks()
            langs, slices, f = pc.dictionary_encode(of["lang"].combine_chunks()), of["slice"].to_numpy(), of["f"].combine_chunks()
            group = langs.indices.to_numpy().astype(np.int64) << 6 | slices
            starts = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(of)).astype(np.int32)
            phrases = pc.binary_join(pa.ListArray.from_arrays(pa.array(starts), of["phrase"].combine_chunks()), "\n")
            first = pa.array(starts[:-1])
            yield pa.RecordBatch.from_arrays([of["lang"].combine_chunks().take(first), of["slice"].combine_chunks().take(first), phrases, pa.ListArray.from_arrays(pa.array(starts), f)], names=["lang", "slice", "phrases", "lengths"])

        for batch in batches:
            if batch.num_rows:
                slices = word_hashes(pc.binary_join(pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), pc.replace_substring(batch.column(1), " ", "_")), " ")[0].as_buffer()) >> np.uint64(58)
                held.append(pa.RecordBatch.from_arrays([*batch.columns, pa.array(slices.astype(np.int32))], names=["lang", "phrase", "f", "slice"]))
                n += batch.num_rows
            if n >= HELD:
                of = merged()
                held, n = of.to_batches(), 0
                if len(of) >= HELD:
                    yield from dealt(of)
                    held = []
        if held:
            yield from dealt(merged())

    sent = named.mapInArrow(run, "lang string, slice int, phrases string, lengths array<long>").repartition("lang", "slice")
    each = sent.select("lang", "slice", F.inline(F.arrays_zip(F.split("phrases", "\n").alias("phrase"), F.col("lengths").alias("f"))))
    return each.groupBy("lang", "slice", "phrase").agg(F.sum("f").alias("f")).drop("slice")


def frequencies(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, longest: int = LONGEST, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(lang, words, phrase, f) of all phrases of up to ``longest`` words that occur ``min_count`` times, and (lang, n)."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    lists = materialise(word_lists(docs, block), "word-lists", **ROW_GROUPS)
    total = materialise(lists.groupBy("lang").agg(F.sum("n").alias("n")), "words")
    found, numbers, complete, broadcast = [], None, False, docs.sparkSession.sparkContext.broadcast
    for size in range(1, longest + 1):
        tables = []
        if 2 <= size <= NUMBERED:
            tables.append(materialise(numbered_counts(lists, size, min_count, numbers), "numbered-counts"))
        plain = size > NUMBERED or not complete
        if plain:
            tables.append(materialise(frequent_keys(lists, size, min_count, numbers), "frequent-keys"))
        shared = broadcast(bloom(functools.reduce(DataFrame.unionByName, [x.select("hashes", "n") for x in tables])))
        counted = [spelled(tables[0], size, numbers)] if 2 <= size <= NUMBERED else []
        if plain:
            counted.append(text_lengths(list_lengths(lists, size, shared, numbers)).where(F.col("f") >= min_count))
        found.append(materialise(functools.reduce(DataFrame.unionByName, counted), "frequent"))
        discard(*tables)
        if size < min(longest, NUMBERED):
            # the words of a frequent phrase are in shorter frequent ones
            numbers, complete = numbered_words(found[-1], size + 1)
            numbers = broadcast(numbers)
        if size < longest:
            longer = materialise(longer_lists(lists, size, shared), "phrase-lists", **ROW_GROUPS)
            discard(lists)
            lists = longer
    discard(lists)
    every = found[0].select("lang", F.lit(1).alias("words"), "phrase", "f")
    for size, df in enumerate(found[1:], 2):
        every = every.unionByName(df.select("lang", F.lit(size).alias("words"), "phrase", "f"))
    return every, total


def _exact(c: str) -> Column:
    return F.col(c).cast("decimal(19,0)").cast("decimal(38,0)")


def collocations(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, longest: int = LONGEST, top: int = TOP, block: int = BLOCK) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: of each language the first ``top`` phrases by score, frequency, bytes."""
    spark = docs.sparkSession
    every, total = frequencies(docs, text_col=text_col, lang_col=lang_col, min_count=min_count, longest=longest, block=block)
    candidates = every.where("words >= 2").select("lang", "words", "phrase", F.col("f").alias("a"))

    # every cut with the frequencies of its sides, which occur as often at least and so are there
    parts = F.split("phrase", " ")
    cut = candidates.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    side = lambda at, n: F.array_join(F.slice(parts, at, n), " ")
    cut = cut.select("lang", "phrase", "a", "k", side(F.lit(1), F.col("k")).alias("left"), side(F.col("k") + 1, F.col("words") - F.col("k")).alias("right"))
    for name, f in (("left", "l"), ("right", "r")):
        cut = cut.join(every.select("lang", F.col("phrase").alias(name), F.col("f").alias(f)), ["lang", name])
    score = F.expr("(cast(2000000 as decimal(38,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    cut = cut.withColumn("score", score).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("x"))
    scored = cut.select("lang", "phrase", "x.a", "x.l", "x.r", "x.score")

    # what a longer phrase holds
    places = F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.col("words") - n + 1), lambda at: side(at, n)))
    inner = candidates.where("words >= 3").select("lang", F.explode(F.flatten(places)).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    kept = scored.join(inner, ["lang", "phrase"], "left").where(F.col("around").isNull() | (_exact("around") * 100 < _exact("a") * WITHIN_PERCENT))
    # ranked in parts first, so that no task sorts all phrases of a language
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.row_number().over(Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order))
    first = kept.withColumn("rank", part).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(docs: DataFrame) -> DataFrame:
    return collocations(docs)


ORACLE = """
WITH p AS (
  SELECT row_number() OVER () AS piece, coalesce(lang, 'und') AS lang, regexp_extract_all(x, '[^\\x20\\x09]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS x FROM documents)),
t AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p),
g AS (SELECT lang, w[i : i + k - 1] AS ws, k FROM t, (SELECT unnest(range(1, 5)) AS k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, array_to_string(ws, ' ') AS phrase, any_value(ws) AS ws, k, count(*) AS f FROM g GROUP BY lang, phrase, k HAVING count(*) >= 30),
n AS (SELECT lang, count(*) AS n FROM t GROUP BY lang),
c AS (SELECT lang, phrase, ws, k, f AS a FROM f WHERE k >= 2),
s AS (
  SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, j, CAST((2000000::HUGEINT * c.a) // (x.f + y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1 : j], ' ') JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[j + 1 :], ' ')
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, j) = 1),
h AS (
  SELECT lang, array_to_string(ws[i : i + m - 1], ' ') AS phrase, max(a) AS around
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c)) GROUP BY ALL)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank, s.phrase, a, l, r, n.n, score
FROM s JOIN n ON n.lang = s.lang LEFT JOIN h ON h.lang = s.lang AND h.phrase = s.phrase WHERE around IS NULL OR 100 * around < 80 * a
QUALIFY rank <= 2000
"""
