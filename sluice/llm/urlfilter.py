"""URL rules over a list of canonical URLs, with DataFrame functions only.

A canonical URL is host + path: the host behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; the path from there up to ``?``, ``#`` or the end. Null URLs and those without ``://`` have both empty.
A listed entry (host, path, verdict) fits its host and all subdomains where the URL's path starts with the entry's
path. The longest fitting entry (host plus path, then the longer host) wins; equal entries that disagree block. URLs
that no entry fits get the default verdict.

The list is held twice, by host and by entry: a blocked Bloom filter passes possible hits, and an exact hash join with the
list removes the false positives. First the distinct hosts of the URLs: of each the suffixes at dots, no more labels than
the longest listed host has. Then the distinct URLs of hosts with a listed suffix: that suffix with the path's prefixes
of the lengths that are listed for it. A filter has a block of 64 bits for four keys of the list. Up to MAX_BLOCKS blocks it
is broadcast, and only possible hits are exchanged; a larger one is exchanged by block, as the keys then are. The list may
have any number of entries, hosts and path lengths. An empty list or table gives the default, or no rows. Duplicate page
ids are judged row by row. Columns besides id and URL are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits set for a key in its block of 64 bits; keys of the list for each block; most blocks of a filter that is broadcast.
PROBES, KEYS_A_BLOCK, MAX_BLOCKS = 4, 4, 1 << 18
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffixes(host: Column, most: int) -> Column:
    """The host and its parent domains of at most ``most`` labels."""
    labels = F.split(host, r"\.")
    labels = F.slice(labels, F.greatest(F.lit(1), F.size(labels) - most + 1), F.lit(most))
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def sized(keys: int) -> int:
    """Blocks of a filter for so many keys."""
    return max(16, 1 << (keys // KEYS_A_BLOCK).bit_length())


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), key), F.lit(blocks))


def mask_of(key: Column) -> Column:
    h = F.xxhash64(F.lit(2), key)
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(PROBES)]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    return mask


def bloom(keys: DataFrame, blocks: int) -> DataFrame:
    """(block, bits) of the column ``key``: at most ``blocks`` rows."""
    return keys.select(block_of(F.col("key"), blocks).alias("block"), mask_of(F.col("key")).alias("m")).groupBy("block").agg(F.bit_or("m").alias("bits"))


def passing(tried: DataFrame, keys: DataFrame, n: int) -> DataFrame:
    """The rows of ``tried`` whose ``key`` may be one of the ``n`` in ``keys``."""
    blocks = sized(n)
    held = bloom(keys, blocks)
    held = F.broadcast(held) if blocks <= MAX_BLOCKS else held
    hit = F.col("bits").bitwiseAND(mask_of(F.col("key"))) == mask_of(F.col("key"))
    return tried.withColumn("block", block_of(F.col("key"), blocks)).join(held, "block").where(hit).drop("block", "bits")


def flagged(tried: DataFrame, keys: DataFrame, n: int, name: str) -> DataFrame:
    """``tried`` with ``name``: whether the column ``key`` may be one of the ``n`` in ``keys``; bounded as ``passing``."""
    blocks = sized(n)
    held = bloom(keys, blocks).withColumnsRenamed({"block": "_block", "bits": "_bits"})
    held = F.broadcast(held) if blocks <= MAX_BLOCKS else held
    out = tried.join(held, block_of(F.col("key"), blocks) == F.col("_block"), "left")
    return out.withColumn(name, F.coalesce(F.col("_bits").bitwiseAND(mask_of(F.col("key"))) == mask_of(F.col("key")), F.lit(False))).drop("_block", "_bits")


def judge(pages: DataFrame, listed: DataFrame, *, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """page_id, host, path, rule (the winning entry's host + path, or null), verdict.

    ``listed`` has host, path and verdict (allow or block) as canonical strings; null entries are left out. With a column
    ``priority`` (int), fitting entries of higher priority win whatever their length.
    """
    if "priority" not in listed.columns:
        listed = listed.withColumn("priority", F.lit(0))
    entries = listed.where("host is not null and path is not null and verdict is not null").select(
        F.translate("host", _UPPER, _LOWER).alias("h"), F.col("path").alias("p"), "verdict", F.coalesce("priority", F.lit(0)).alias("priority")
    )
    entries = entries.groupBy("h", "p").agg(F.max(F.struct("priority", "verdict")).alias("x")).select(F.concat_ws("\n", "h", "p").alias("key"), "h", "p", "x.*")  # block > allow
    hosts = entries.groupBy("h").agg(F.collect_set(F.length("p")).alias("lengths"))  # no more than the longest path has characters
    about = entries.agg(F.count("*").alias("n"), F.count_distinct("h").alias("hosts"), F.max(F.size(F.split("h", r"\."))).alias("labels")).first()

    urls = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    known = urls.select("host").distinct().select("host", F.explode(suffixes(F.col("host"), about["labels"] or 1)).alias("key"))
    known = passing(known, hosts.select(F.col("h").alias("key")), about["hosts"]).join(hosts, F.col("key") == F.col("h")).select("host", "h", "lengths")
    # each distinct URL once, with the prefixes of its path that its host's entries can have
    tried = urls.select("host", "path").distinct().join(known, "host")
    prefixes = F.transform(F.filter("lengths", lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    tried = tried.select("host", "path", F.explode(F.transform(prefixes, lambda p: F.concat_ws("\n", "h", p))).alias("key"))
    size = F.length("h") + F.length("p")
    best = passing(tried, entries.select("key"), about["n"]).join(entries, "key")
    best = best.groupBy("host", "path").agg(F.max_by(F.struct(F.concat("h", "p").alias("rule"), "verdict"), F.struct("priority", size, F.length("h"))).alias("best"))
    out = urls.join(best, ["host", "path"], "left")
    return out.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


#: The rules of the query.
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
#: The query's list: hosts of two words that unwanted sites join (gambling, medicines, adult, advertising, spam, fraud) under the
#: domains of documentation. It is a rule in place of a published list; a real one is passed as a table.
FIRST = "ads adult best bets bonus buy casino cheap click crack cash dating easy escort fake fast free hack hot keygen loan lotto lucky malware money nude online pharma phish pills poker porn promo quick replica rx scam sex slots spam super top track viagra warez win xxx".split()
SECOND = "4u ads banner bets bonus cams cash casino chat click club codes crack deals download farm games girls hack keys links loans lotto mall market money movies now offers online pills play poker pro promo sale shop sites slots spin store stream track tube vip win x zone".split()
DOMAINS = ["example.com", "example.net", "example.org"]


def unwanted_hosts(spark: SparkSession) -> DataFrame:
    """The query's list as host, path, verdict; built from constants in the JVM."""
    words = lambda x: F.explode(F.array(*map(F.lit, x)))
    out = spark.range(1).select(words(FIRST).alias("a")).select("a", words(SECOND).alias("b")).select("a", "b", words(DOMAINS).alias("d"))
    return out.select(F.concat("a", F.lit("-"), "b", F.lit("."), "d").alias("host"), F.lit("/").alias("path"), F.lit("block").alias("verdict"))


def query(pages: DataFrame, listed: DataFrame | None = None) -> DataFrame:
    """The rules decide first; listed URLs are the method's own verdict, with a null rule.

    ``listed`` is a table of host, path and verdict of any size; without it the list is ``unwanted_hosts``.
    """
    spark = pages.sparkSession
    listed = unwanted_hosts(spark) if listed is None else listed
    rules = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in RULES])))
    entries = rules.withColumn("priority", F.lit(1)).unionByName(listed.select("host", "path", "verdict", F.lit(0).alias("priority")))
    ruled = judge(pages, entries)
    own = F.col("rule").isin([h + p for h, p, _ in RULES])
    return ruled.select("page_id", "host", "path", F.when(own, F.col("rule")).alias("rule"), "verdict", F.when(~own, F.col("rule")).alias("listed"))


ORACLE = f"""
WITH u AS (
  SELECT page_id,
         CASE WHEN contains(url, '://') THEN translate(regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*'),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
r(rh, rp, verdict, ruled) AS (
  VALUES ('org', '/', 'allow', true), ('example.org', '/es/', 'block', true), ('example.org', '/en/1', 'block', true),
         ('com', '/fr/', 'allow', true), ('com', '/de/', 'block', true)
  UNION ALL SELECT a || '-' || b || '.' || d, '/', 'block', false
  FROM (SELECT unnest({FIRST}) AS a), (SELECT unnest({SECOND}) AS b), (SELECT unnest({DOMAINS}) AS d)),
best AS (
  SELECT page_id, host, path, rh, rp, r.verdict, ruled,
         row_number() OVER (PARTITION BY page_id ORDER BY ruled DESC NULLS LAST, length(rh) + length(rp) DESC, length(rh) DESC) AS k
  FROM u LEFT JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, host, path, CASE WHEN ruled THEN rh || rp END AS rule, coalesce(verdict, 'allow') AS verdict,
       CASE WHEN NOT ruled THEN rh || rp END AS listed
FROM best WHERE k = 1
"""
