"""How the sources of a language differ in their terms, by DuckDB aggregation of shards.

Terms are the matches of ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+``, A-Z lower-cased; null text, language and source read as ''. A language keeps
the terms that occur in at least ``min_docs`` of its rows (V of them). Every occurring (language, source) and every language
gives each kept term p = 1 + floor(10^9 (count + 2) / (N + 2 V)), N being its occurrences of kept terms. Two such weights of
a term diverge by f = floor((p - q)^2 / (p + q)), all in integers (128 bits where products need them).

Method. Texts are counted by (language, source, term) in DuckDB, a bounded batch at a time, and Spark adds these counts up, in each
task before the exchange, so a term or source that is everywhere is no burden. The terms are then dealt by the hash of
language and term over shards of about ``SHARD`` counts. In a shard DuckDB finds the kept terms, which gives Spark N and V
as sums over shards; and from these in a second round the shard's share of every pair's sum and its first terms of every
source. Spark adds the sums up and merges the rankings.

Only occurring terms are joined, and so pairs of sources are only met where both have the term: with z the weight of an
absent term, the sum over all kept terms is that of f(p, q) - f(p, z) - f(q, z) + f(z, z) over the terms that both have,
of f(p, z) - f(z, z) over those of either, and V f(z, z). The pairs of sources themselves are the result, and each shard
receives the one row of N and V of each group.

Repeated rows count each. Groups without terms take part in ``pair``; a language without kept terms has the value 0
there and no ``term``. Ties go by the item's bytes. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import duckdb
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import discard, materialise, small_batches

MIN_DOCS, FIRST = 10, 10
#: Bytes of text that a batch of the first counts holds, and counts in a shard, about.
BATCH, SHARD = 4 << 20, 250_000
#: What is no part of a term becomes a blank, A-Z lower case.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

COUNT = """
SELECT lang, source, term, CAST(sum(n) AS BIGINT) AS n, count(*) AS docs
FROM (SELECT doc, term, count(*) AS n FROM tokens GROUP BY doc, term) JOIN texts USING (doc) GROUP BY lang, source, term
"""

#: The kept terms of a shard: a row for each source that has the term, and one without a source for the language.
KEEP = """
WITH k AS (SELECT lang, term, CAST(sum(n) AS BIGINT) AS n FROM counts GROUP BY lang, term HAVING sum(docs) >= {min_docs})
SELECT shard, lang, source, term, c.n FROM counts c JOIN k USING (lang, term)
UNION ALL SELECT (SELECT any_value(shard) FROM counts), lang, NULL, term, n FROM k
"""

_F = "(({0} - {1}) * ({0} - {1})) // ({0} + {1})"

#: A shard's share of the pairs' sums (source < item) and its first terms of each source.
SHARES = f"""
WITH g AS (SELECT *, CAST(1 + 2000000000::HUGEINT // (total + 2 * v) AS BIGINT) AS z FROM groups WHERE v > 0),
k AS (SELECT kept.lang, kept.source, term, n, CAST(1 + (1000000000::HUGEINT * (n + 2)) // (total + 2 * v) AS BIGINT) AS p, z
      FROM kept JOIN g ON g.lang = kept.lang AND g.source IS NOT DISTINCT FROM kept.source),
q AS (SELECT lang, term, p AS q FROM k WHERE source IS NULL),
s AS (SELECT * FROM k WHERE source IS NOT NULL),
both_have AS (
  SELECT a.lang, a.source, b.source AS item,
         sum({_F.format('a.p', 'b.p')} - {_F.format('a.p', 'b.z')} - {_F.format('b.p', 'a.z')} + {_F.format('a.z', 'b.z')}) AS value
  FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source < b.source GROUP BY ALL),
h AS (SELECT lang, source, p, z, count(*) AS m FROM s GROUP BY ALL),
either_has AS (
  SELECT h.lang, least(h.source, g.source) AS source, greatest(h.source, g.source) AS item, sum(m * ({_F.format('h.p', 'g.z')} - {_F.format('h.z', 'g.z')})) AS value
  FROM h JOIN g ON g.lang = h.lang AND g.source <> h.source GROUP BY ALL),
n AS (SELECT lang, count(*) AS v FROM q GROUP BY lang),
neither AS (
  SELECT a.lang, a.source, b.source AS item, n.v * ({_F.format('a.z', 'b.z')}) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source < b.source JOIN n ON n.lang = a.lang),
first_terms AS (
  SELECT lang, source, term AS item, {_F.format('p', 'q')} AS value FROM s JOIN q USING (lang, term) WHERE p > q
  QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) <= {{first}})
SELECT lang, source, 'pair' AS part, item, CAST(sum(value) AS BIGINT) AS value
FROM (FROM both_have UNION ALL FROM either_has UNION ALL FROM neither) GROUP BY lang, source, item
UNION ALL SELECT lang, source, 'term', item, CAST(value AS BIGINT) FROM first_terms
"""


def database() -> duckdb.DuckDBPyConnection:
    """A database in a task's own memory: one thread, no files."""
    return duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "400MB", "temp_directory": "", "preserve_insertion_order": False})


def ask(db: duckdb.DuckDBPyConnection, sql: str, **tables: pa.Table) -> pa.Table:
    """The answer of one query over Arrow tables."""
    for name, rows in tables.items():
        db.register(name, rows)
    out = db.sql(sql).to_arrow_table()
    for name in tables:
        db.unregister(name)
    return out


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and rows of each term, by batches of texts; ``docs`` has lang, source, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        db = database()
        schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
        held, size = [], 0

        def flush():
            doc, term, lengths = range(len(held)), [], []
            for _, _, raw in held:
                found = raw.split()
                lengths.append(len(found))
                term += found
            texts = pa.table({"doc": pa.array(doc, pa.int32()), "lang": pa.array([x[0] for x in held], pa.string()), "source": pa.array([x[1] for x in held], pa.string())})
            of = pa.array([i for i, n in enumerate(lengths) for _ in range(n)], pa.int32())
            tokens = pa.table({"doc": of, "term": pa.array(term, pa.binary()).cast(pa.string())})
            held.clear()
            yield from ask(db, COUNT, texts=texts, tokens=tokens).cast(schema).to_batches(50_000)

        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
                held.append((lang, source, (text or "").encode("utf-8", "replace").translate(_TABLE)))
                size += len(held[-1][2])
                if size >= BATCH:
                    yield from flush()
                    size = 0
        if held:
            yield from flush()
        db.close()

    return docs.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def audit(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS, first: int = FIRST, shard: int = SHARD) -> DataFrame:
    """lang, source, part, item, value, rank: all other sources (``pair``), and the ``first`` terms (``term``) of each source."""
    small_batches(docs.sparkSession)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    docs = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"))
    counts = term_counts(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = materialise(counts, "term-counts")
    shards = max(1, -(-counts.count() // shard))
    counts_of = counts.withColumn("shard", F.pmod(F.xxhash64("lang", "term"), F.lit(shards)).cast("int"))

    def keep(rows: pa.Table) -> pa.Table:
        with database() as db:
            return ask(db, KEEP.format(min_docs=int(min_docs)), counts=rows)

    kept = materialise(counts_of.groupBy("shard").applyInArrow(keep, "shard int, lang string, source string, term string, n long"), "kept-terms")
    discard(counts)

    # N and V of every group, those without a kept term included; the language's own row has no source
    total = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("terms"))
    size = total.where("source is null").select("lang", F.col("terms").alias("v"))
    every = docs.select("lang", "source").distinct()
    groups = every.join(total.where("source is not null").select("lang", "source", "total"), ["lang", "source"], "left").unionByName(total.where("source is null").select("lang", "source", "total"))
    groups = groups.join(size, "lang", "left").select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v"))
    groups = materialise(groups, "groups")

    def share(rows: pa.Table, known: pa.Table) -> pa.Table:
        with database() as db:
            return ask(db, SHARES.format(first=int(first)), kept=rows, groups=known)

    to_all = groups.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("of"), F.col("lang").alias("lang"), F.col("source").alias("source"), "total", "v")
    shares = kept.groupBy("shard").cogroup(to_all.groupBy("of")).applyInArrow(share, "lang string, source string, part string, item string, value long")
    shares = materialise(shares, "shares")
    discard(kept)

    sources = groups.where("source is not null").select("lang", "source")
    pairs = sources.join(sources.withColumnRenamed("source", "item"), "lang").where("source <> item")  # the pairs are the result
    summed = shares.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    turned = summed.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    pairs = pairs.join(summed.unionByName(turned), ["lang", "source", "item"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item")))
    terms = shares.where("part = 'term'").withColumn("rank", place).where(F.col("rank") <= first)
    return pairs.withColumn("rank", place).unionByName(terms)


def query(docs: DataFrame) -> DataFrame:
    return audit(docs)


ORACLE = """
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (SELECT doc, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT g.lang, g.source, k.term, coalesce(x.n, 0) AS n FROM g JOIN k USING (lang) LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL) x USING (lang, source, term)),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
p AS (SELECT lang, source, term, n, CAST(1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS BIGINT) AS p FROM c JOIN v USING (lang)),
q AS (SELECT lang, term, CAST(1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * v) AS BIGINT) AS q FROM k JOIN v USING (lang)),
s AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
term AS (SELECT lang, source, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pair
UNION ALL SELECT lang, source, 'term', item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM term QUALIFY rank <= 10
"""
