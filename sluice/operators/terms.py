"""Which terms of a table texts hold: the first hit, and passages around hits.

An automaton over the terms finds all occurrences in one pass over a text, however many terms there are. It is built once in
a worker from a broadcast list whose size is checked: more than ``TERM_BYTES`` of terms are dealt by hash over several lists,
each with a pass of its own over the texts, and the hits of a text are united; so neither driver nor workers hold more at a time.
"""

from __future__ import annotations

import bisect
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.staging import staged

#: Bytes of terms in one automaton; it takes some twenty times as much in a worker.
TERM_BYTES = 8 << 20
#: What ends a sentence, and so a passage.
STOPS = re.compile(r"[.!?\n]")

_AUTOMATA: dict[str, object] = {}


def _automaton(name: str, shared):
    if name not in _AUTOMATA:
        import ahocorasick

        _AUTOMATA.clear()  # a worker serves one list at a time
        found = ahocorasick.Automaton()
        for term in shared.value:
            found.add_word(term, len(term))
        found.make_automaton()
        _AUTOMATA[name] = found
    return _AUTOMATA[name]


def passages(text: str, hits: dict[int, int], before: int, after: int, most: int) -> list[str]:
    """Up to ``most`` passages from the left without overlap: a term (where it begins and ends is in ``hits``) with up to
    ``before`` and ``after`` characters of its sentence. Of several terms within ``before`` characters the last is the passage's own."""
    starts, out, at = sorted(hits), [], 0
    stop = lambda i: m.start() if (m := STOPS.search(text, i)) else len(text)
    while len(out) < most and (k := bisect.bisect_left(starts, at)) < len(starts):
        sentence = max((m.end() for m in STOPS.finditer(text, max(at, starts[k] - before), starts[k])), default=0)
        begin = max(at, sentence, starts[k] - before)
        own = starts[bisect.bisect_right(starts, min(begin + before, stop(begin))) - 1]
        end = hits[own]
        at = min(end + after, stop(end))
        out.append(text[begin:at])
    return out


def find_terms(docs: DataFrame, terms: DataFrame, key: str, text_col: str, term_col: str, *, before: int = 80, after: int = 120, most: int = 20) -> DataFrame:
    """(key, first_term, hits, passages): a row for each row of ``docs`` with a hit; ``key`` is unique there.

    Equal terms count once, null and empty ones not at all. At one place the longest term counts.
    """
    spark = docs.sparkSession
    words = staged(terms.select(F.col(term_col).cast("string").alias("term")).where("term <> ''").distinct(), "terms")
    size = words.agg(F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).first()[0]
    lists = max(1, -(-size // TERM_BYTES))
    rows = docs.select(F.col(key).alias("key"), F.col(text_col).alias("text")).where("text is not null")
    kind = rows.schema["key"].dataType.simpleString()
    found = None
    for i in range(lists):
        part = words.where(F.pmod(F.xxhash64("term"), F.lit(lists)) == i) if lists > 1 else words
        shared = spark.sparkContext.broadcast(sorted(r["term"] for r in part.collect()))

        def run(batches: Iterator[pa.RecordBatch], shared=shared, name=uuid.uuid4().hex) -> Iterator[pa.RecordBatch]:
            if not shared.value:
                return
            automaton = _automaton(name, shared)
            for batch in batches:
                keep, starts, ends = [], [], []
                for n, text in enumerate(batch.column(1).to_pylist()):
                    hits: dict[int, int] = {}
                    for last, length in automaton.iter(text):
                        at = last + 1 - length
                        hits[at] = max(hits.get(at, 0), last + 1)
                    if hits:
                        keep.append(n)
                        starts.append(list(hits))
                        ends.append(list(hits.values()))
                kept = batch.take(pa.array(keep, pa.int64()))
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(starts, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32()))], names=["key", "text", "starts", "ends"])

        of = rows.mapInArrow(run, f"key {kind}, text string, starts array<int>, ends array<int>")
        if lists > 1:
            of = staged(of, "hits")
            shared.unpersist(blocking=True)
        found = of if found is None else found.unionByName(of)
    if lists > 1:
        found = found.groupBy("key").agg(F.first("text").alias("text"), F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("ends")).alias("ends"))

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, count, shown = [], [], []
            for text, starts, ends in zip(*(batch.column(c).to_pylist() for c in (1, 2, 3))):
                hits: dict[int, int] = {}
                for at, end in zip(starts, ends):
                    hits[at] = max(hits.get(at, 0), end)
                first.append(text[min(hits) : hits[min(hits)]])
                count.append(len(hits))
                shown.append(passages(text, hits, before, after, most))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(first, pa.string()), pa.array(count, pa.int32()), pa.array(shown, pa.list_(pa.string()))], names=["key", "first_term", "hits", "passages"])

    return found.select("key", "text", "starts", "ends").mapInArrow(told, f"key {kind}, first_term string, hits int, passages array<string>").withColumnRenamed("key", key)
