"""Deleting later copies of repeated line runs, with DataFrame functions only.

A document is the sequence of its lines with a word, each an id (128 bits of hash of the trimmed line). A run is a
stretch of such lines within one document; it qualifies with at least ``min_words`` words. Every line that lies in a
qualifying run with an earlier copy (in the order of document id, then place) is deleted, so the first copy of every
line stays. Blank lines go with the lines around them if both are of one deleted stretch, and stay otherwise.

Method. Lines that occur once in the corpus end a run and are left out first; what is left are stretches of line ids.
Their suffixes are ordered by prefix doubling: the distinct names of a round are sorted over ranges of all tasks and
numbered in that order, and the next round's names are pairs of a suffix's number and that of the suffix 2^k lines on.
As every line counts a word, a run of ``min_words`` lines qualifies, so doubling ends once names cover as many. The
suffix array is the order by the last numbers, ties by place; a suffix's common-prefix length with the one before it is
counted in lines, up to ``min_words``. An interval of depth m holds the suffixes between two places where that length
falls below m: those are the copies of one run of m lines. Of an interval the earliest suffix is the original, the
others are later copies, and overlapping or adjacent copies of a document make its maximal repeated runs.

For each suffix the interval at the depth of the shortest qualifying run from its line is looked up, and for each line
that of the shortest one that ends there; their union is the union of all longer ones. A longer repeated run has
``min_words`` words in all. The run looked up from a line of it ends within it if enough words follow there, and is a
copy as the longer one is; the run looked up to a line starts within it likewise. A line with too few words both behind
and before it lies in the run looked up from the first line of the longer run, which is long enough to end behind it.

Groups of equal lines or names, however many documents share them, are only ever reduced to a count, a number or their
first place, with partial sums before the exchange, and joined back; AQE splits such joins. The order is by ranges that
split ties by place, so a frequent run spreads over tasks. Broadcast are a row for each range (task), and the blocks of
a filter that keeps the texts without a repeated run out of the last join: up to 2^18 blocks; a larger one is exchanged.

Null texts stay null, empty ones empty, an empty table empty. Rows that repeat both id and text count as one document and are treated alike.
Rows with a null id are never changed. Other columns pass through untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import discard, materialise
from sluice.llm.urlfilter import flagged

MIN_WORDS = 25
_SPACE, _SALT = " \t\v\f\r", 7_919


def _pair(*parts: Column) -> Column:
    """128 bits of hash."""
    return F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit(_SALT), *parts).alias("b"))


def _lines(text: Column) -> Column:
    """The lines with a word, as structs of line number and trimmed line."""
    numbered = F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("at"), F.btrim(x, F.lit(_SPACE)).alias("line")))
    return F.filter(numbered, lambda x: x["line"] != "")


def repeated_runs(docs: DataFrame, *, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash and runs: the deleted stretches (first, last) counted in lines with a word, as an array."""
    doc = ["doc_id", "text_hash"]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.posexplode(_lines(F.col(text_col))).alias("seq", "x"))
    rows = materialise(rows.select(*doc, "seq", F.regexp_count("x.line", F.lit(r"[^\x20\x09-\x0D]+")).alias("words"), _pair(F.col("x.line")).alias("name0")), "lines")

    # written, so that the join has a plain exchange on each side and a very frequent line can be split
    again = materialise(rows.groupBy("name0").agg(F.count("*").alias("n")).where("n > 1").select("name0"), "repeated-lines")
    shared = rows.join(again, "name0", "left_semi").dropDuplicates([*doc, "seq"])
    by_doc = Window.partitionBy(*doc).orderBy("seq")
    shared = shared.withColumn("stretch", F.col("seq") - F.row_number().over(by_doc))

    # the shortest qualifying run from each line, and to each line, as lengths in lines
    stretch = Window.partitionBy(*doc, "stretch")
    by_line = stretch.orderBy("seq")
    shared = shared.withColumn("before", F.coalesce(F.sum("words").over(by_line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("upto", F.col("before") + F.col("words"))
    all_of, first, last = F.sum("words").over(stretch), F.min("seq").over(stretch), F.max("seq").over(stretch)
    stop = F.min("seq").over(stretch.orderBy("before").rangeBetween(min_words, Window.unboundedFollowing))
    start = F.max("seq").over(stretch.orderBy("upto").rangeBetween(Window.unboundedPreceding, -min_words))
    stop = F.coalesce(stop, F.when(all_of - F.col("before") >= min_words, last + 1))
    start = F.coalesce(start + 1, F.when(F.col("upto") >= min_words, first))
    lines = materialise(shared.select(*doc, "stretch", "seq", "name0", (stop - F.col("seq")).alias("ahead"), start.alias("start")), "stretches")

    ranked = _ranks(lines, doc, min_words)
    order = [F.col("rank"), *map(F.col, doc), F.col("seq")]
    array = materialise(_suffix_array(ranked, lines, doc, order, min_words), "suffix-array")
    discard(rows, again, lines, ranked)

    # the interval of each looked-up run; those of one length and one start in the order are one interval
    ahead = array.where("ahead is not null").select(*doc, "seq", F.col("ahead").alias("m"), "starts")
    wanted = array.where("start is not null").select(*doc, F.col("start").alias("seq"), (F.col("seq") + 1 - F.col("start")).alias("m")).distinct()
    behind = wanted.join(array.select(*doc, "seq", "starts"), [*doc, "seq"]).select(*doc, "seq", "m", "starts")
    runs = ahead.union(behind).select(*doc, F.col("seq").alias("s"), "m", F.col("starts")[F.col("m").cast("int") - 1].alias("interval"))
    runs = materialise(runs.distinct(), "line-runs")

    place = F.struct(*doc, "s")
    origin = materialise(runs.groupBy("m", "interval").agg(F.min(place).alias("origin"), F.count("*").alias("n")).where("n > 1").select("m", "interval", "origin"), "line-origins")
    copies = runs.join(origin, ["m", "interval"]).where(place > F.col("origin")).select(*doc, "s", (F.col("s") + F.col("m") - 1).alias("e"))

    # overlapping or adjacent copies of a document become one stretch
    reach = F.max("e").over(Window.partitionBy(*doc).orderBy("s", "e").rowsBetween(Window.unboundedPreceding, -1))
    part = F.sum("new").over(Window.partitionBy(*doc).orderBy("s", "e"))
    merged = copies.withColumn("new", F.when(F.col("s") <= reach + 1, 0).otherwise(1)).withColumn("part", part)
    merged = merged.groupBy(*doc, "part").agg(F.min("s").alias("first"), F.max("e").alias("last"))
    out = materialise(merged.groupBy(*doc).agg(F.collect_list(F.struct("first", "last")).alias("runs")), "deleted-runs")
    discard(array, runs, origin)
    return out


def _ranks(lines: DataFrame, doc: list[str], depth: int) -> DataFrame:
    """Every suffix (doc, stretch, seq) with its rank among the prefixes of ``depth`` lines or more, by prefix doubling."""
    by_line = Window.partitionBy(*doc, "stretch").orderBy("seq")
    place = [*doc, "stretch", "seq"]

    def numbered(names: DataFrame, *by: str) -> DataFrame:
        """Distinct names in sorted ranges; partition and row number together grow with the order."""
        return materialise(materialise(names.distinct(), "names").repartitionByRange(*by).sortWithinPartitions(*by).withColumn("rank", F.monotonically_increasing_id()), "ranks")

    ranks = numbered(lines.select("name0"), "name0")
    held, covered = materialise(lines.select(*place, "name0").join(ranks, "name0").select(*place, "rank"), "ranked"), 1
    while covered < depth:
        pairs = held.select(*place, F.col("rank").alias("a"), F.coalesce(F.lead("rank", covered).over(by_line), F.lit(-1)).alias("b"))
        pairs = materialise(pairs, "pairs")
        ranks = numbered(pairs.select("a", "b"), "a", "b")
        following = materialise(pairs.join(ranks, ["a", "b"]).select(*place, "rank"), "ranked")
        discard(held, pairs, ranks)
        held, covered = following, 2 * covered
    return held


def _suffix_array(ranked: DataFrame, lines: DataFrame, doc: list[str], order: list[Column], depth: int) -> DataFrame:
    """Suffixes with ``starts``: for each depth up to ``depth`` where in the suffix array the suffix's interval begins."""
    prefix = Window.partitionBy(*doc, "stretch").orderBy("seq").rowsBetween(0, depth - 1)
    own = lines.join(ranked, [*doc, "stretch", "seq"]).withColumn("lines", F.collect_list(F.col("name0")["a"]).over(prefix))
    own = own.select(*doc, "seq", "ahead", "start", "rank", "lines")
    sorted_ = own.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"range": F.spark_partition_id(), "at": F.monotonically_increasing_id()})
    sorted_ = materialise(sorted_, "sorted-suffixes")
    within = Window.partitionBy("range").orderBy("at")

    # what a range takes over from those before it: its last suffix, then the last place where the length fell below each depth
    ends = sorted_.groupBy("range").agg(F.max_by("lines", "at").alias("lines"))
    ranges = Window.orderBy("range")  # a row for each task
    handed = ends.select("range", F.lag("lines").over(ranges).alias("handed"))
    before = F.coalesce(F.lag("lines").over(within), F.col("handed"))
    equal = F.transform(F.arrays_zip("lines", F.col("before").alias("other")), lambda x: x["lines"] == x["other"])
    length = F.coalesce(F.array_position(F.transform(equal, lambda x: F.coalesce(x, F.lit(False))), False) - 1, F.lit(0))
    length = F.when(F.col("before").isNull(), 0).when(length < 0, F.size("lines")).otherwise(length)
    with_length = sorted_.join(F.broadcast(handed), "range").withColumn("before", before).withColumn("length", length).drop("before", "handed", "lines")
    with_length = materialise(with_length, "common-prefixes")
    falls = [F.when(F.col("length") < d, F.col("at")) for d in range(1, depth + 1)]
    last = with_length.groupBy("range").agg(*[F.max(c).alias(f"d{d}") for d, c in enumerate(falls, 1)])
    earlier = ranges.rowsBetween(Window.unboundedPreceding, -1)
    last = last.select("range", F.array(*[F.max(f"d{d}").over(earlier) for d in range(1, depth + 1)]).alias("taken"))
    here = F.array(*[F.max(c).over(within.rowsBetween(Window.unboundedPreceding, 0)) for c in falls])
    out = with_length.withColumn("here", here).join(F.broadcast(last), "range")
    starts = F.zip_with("here", "taken", lambda x, y: F.coalesce(x, y))
    return out.select(*doc, "seq", "ahead", "start", starts.alias("starts"))


def remove(docs: DataFrame, *, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with the text's later copies deleted, and _n_lines, _n_removed (lines with a word)."""
    runs = repeated_runs(docs, min_words=min_words, id_col=id_col, text_col=text_col)
    runs = runs.select(F.col("doc_id").alias("_run_doc"), F.col("text_hash").alias("_run_hash"), "runs")
    # a row's own id and text are the join's key; other columns may have any name
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    text = F.col("_row")[text_col]
    # rows that certainly have no run keep out of the join
    keyed = packed.withColumn("key", F.xxhash64(F.col("_row")[id_col], F.xxhash64(text)))
    marked = flagged(keyed, runs.select(F.xxhash64("_run_doc", "_run_hash").alias("key")), runs.count(), "_may")
    hit = marked.where("_may").select("_row").join(runs, (F.col("_row")[id_col] == F.col("_run_doc")) & (F.xxhash64(text) == F.col("_run_hash")), "left").select("_row", "runs")
    joined = marked.where("not _may").select("_row", F.lit(None).cast(runs.schema["runs"].dataType).alias("runs")).unionByName(hit)
    lines = _lines(text)
    cuts = F.transform("runs", lambda r: F.struct(lines[r["first"]]["at"].alias("a"), lines[r["last"]]["at"].alias("b")))
    joined = joined.withColumn("_cuts", F.when(F.col("runs").isNotNull(), cuts))
    kept = F.filter(F.split(text, "\n"), lambda x, i: ~F.exists("_cuts", lambda c: (i >= c["a"]) & (i <= c["b"])))
    removed = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"] + 1)
    new_text = F.when(F.col("_cuts").isNotNull(), F.array_join(kept, "\n")).otherwise(text)
    own = [new_text.alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in docs.columns]
    return joined.select(*own, F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("_n_lines"), F.coalesce(removed, F.lit(0)).cast("long").alias("_n_removed"))


def query(docs: DataFrame) -> DataFrame:
    out = remove(docs.select("doc_id", "text"))
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"), "text")


ORACLE = f"""
WITH l AS (
  SELECT doc_id, CAST(i AS BIGINT) AS pos, trim(x, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line, x AS raw
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)),
w AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS seq,
         len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS words
  FROM l WHERE line <> ''),
c AS (SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY seq) AS upto FROM w),
ahead AS (
  SELECT a.doc_id, a.seq AS s, min(b.seq) AS e FROM c a JOIN c b
  ON a.doc_id = b.doc_id AND b.seq >= a.seq AND b.upto - a.upto + a.words >= {MIN_WORDS} GROUP BY ALL),
behind AS (
  SELECT b.doc_id, max(a.seq) AS s, b.seq AS e FROM c a JOIN c b
  ON a.doc_id = b.doc_id AND b.seq >= a.seq AND b.upto - a.upto + a.words >= {MIN_WORDS} GROUP BY b.doc_id, b.seq),
runs AS (
  SELECT r.doc_id, r.s, r.e, string_agg(c.line, chr(10) ORDER BY c.seq) AS content
  FROM (SELECT * FROM ahead UNION SELECT * FROM behind) r JOIN c ON c.doc_id = r.doc_id AND c.seq BETWEEN r.s AND r.e GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, s) AS k FROM runs),
copies AS (SELECT * FROM ranked WHERE k > 1),
gone AS (SELECT DISTINCT c.doc_id, c.seq, c.pos FROM c JOIN copies r ON c.doc_id = r.doc_id AND c.seq BETWEEN r.s AND r.e),
-- a blank line goes if the lines with a word on both its sides are gone
marked AS (
  SELECT l.doc_id, l.pos, l.raw, l.line, (g.pos IS NOT NULL) AS hit,
         last_value(CASE WHEN l.line <> '' THEN g.pos IS NOT NULL END IGNORE NULLS) OVER (PARTITION BY l.doc_id ORDER BY l.pos) AS left_hit,
         first_value(CASE WHEN l.line <> '' THEN g.pos IS NOT NULL END IGNORE NULLS) OVER (PARTITION BY l.doc_id ORDER BY l.pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS right_hit
  FROM l LEFT JOIN gone g USING (doc_id, pos)),
kept AS (
  SELECT doc_id, count(*) FILTER (line <> '') AS n_lines, count(*) FILTER (hit) AS n_removed,
         string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT hit AND NOT (line = '' AND coalesce(left_hit, false) AND coalesce(right_hit, false))) AS text
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text
FROM documents d LEFT JOIN kept k USING (doc_id)
"""
