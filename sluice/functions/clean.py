"""Cleaning expressions. Each takes a column and gives one; nulls in give nulls out unless said otherwise."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.values import LATITUDES, LONGITUDES, NULL_TOKENS, REGION_NAMES

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^[+-]?[iI][nN][fF]([iI][nN][iI][tT][yY])?$"
#: Date patterns beside ISO ones; each is tried where the text has its shape.
_DATES = {r"^\d{4}/\d{1,2}/\d{1,2}$": "yyyy/M/d", r"^\d{4}\.\d{1,2}\.\d{1,2}$": "yyyy.M.d", r"^\d{4}-\d{1,2}-\d{1,2}$": "yyyy-M-d", r"^\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{2}(:\d{2})?$": "yyyy/M/d H:m[:s]", r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{2}$": "yyyy-M-d H:m"}
_DIGITS = {8: "yyyyMMdd", 12: "yyyyMMddHHmm", 14: "yyyyMMddHHmmss"}

#: White space of Unicode, as patterns have it.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Without white space of any script at both ends; looks at the ends only, which a pattern does not."""
    return F.trim(c, F.lit(WHITE))


def null_token(c: Column, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """Whether the value is null or a text that means so; never null itself."""
    return c.isNull() | F.coalesce(F.lower(strip(c)).isin(*tokens), F.lit(False))


def normalize(c: Column, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """Trimmed text; null for the tokens."""
    text = strip(c)
    return F.when(~F.lower(text).isin(*tokens), text)


def normalize_nulls(df: DataFrame, tokens: Iterable[str] = NULL_TOKENS) -> DataFrame:
    """``normalize`` on every string column; all are trimmed in one projection and compared in the next."""
    strings = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    trimmed = df.select(*[strip(F.col(f"`{c}`")).alias(c) if c in strings else F.col(f"`{c}`") for c in df.columns])
    return trimmed.select(*[F.when(~F.lower(f"`{c}`").isin(*tokens), F.col(f"`{c}`")).alias(c) if c in strings else F.col(f"`{c}`") for c in df.columns])


def without_commas(c: Column) -> Column:
    return strip(F.regexp_replace(c.cast("string"), ",", ""))


def number_of(text: Column) -> Column:
    """A double from trimmed text without separators; null where it is no plain number."""
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def integer_of(text: Column) -> Column:
    """A long from such text; null where the number is not integral, never a truncation."""
    value = number_of(text)
    return F.when(value % 1 == 0, value.try_cast("long"))


def moment_of(text: Column) -> Column:
    """A timestamp without zone from trimmed text; null for other shapes, offsets, impossible dates and years outside 1700..2200.

    The shape chooses the pattern, so there is one parse, and little code, for all of them.
    """
    shapes = {rf"^\d{{{n}}}$": fmt for n, fmt in _DIGITS.items()} | _DATES
    pattern = reduce(lambda e, kv: e.when(text.rlike(kv[0]), kv[1]), list(shapes.items())[1:], F.when(text.rlike(next(iter(shapes))), next(iter(shapes.values()))))
    iso = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}:\d{2}(\.\d+)?)?$"), text.try_cast("timestamp_ntz"))
    year = F.substring(text, 1, 4).try_cast("int")
    return F.when(year.between(1700, 2200), F.coalesce(iso, F.try_to_timestamp(text, pattern).cast("timestamp_ntz")))


#: A conversion as (what makes its text, what reads the text): two projections, so the text is made once a row and the
#: generated code holds each expression once.
NUMBER, INTEGER, MOMENT = (without_commas, number_of), (without_commas, integer_of), (strip, moment_of)


def number(c: Column) -> Column:
    """A double without thousands separators; null where the text is no plain number."""
    return number_of(without_commas(c))


def integer(c: Column) -> Column:
    """A long; null where the number is not integral, never a truncation."""
    return integer_of(without_commas(c))


def moment(c: Column) -> Column:
    """``moment_of`` the trimmed text."""
    return moment_of(strip(c))


def normalized(df: DataFrame, to: dict[str, str], tokens: Iterable[str] = NULL_TOKENS) -> DataFrame:
    """Adds each new column as its source's normal text, trimmed in one projection and compared in the next."""
    df = df.withColumns({new: strip(F.col(f"`{source}`").cast("string")) for new, source in to.items()})
    return df.withColumns({new: F.when(~F.lower(F.col(new)).isin(*tokens), F.col(new)) for new in to})


def read_as(df: DataFrame, to: dict[str, tuple[str, tuple]]) -> DataFrame:
    """Adds each new column as its source read by a staged conversion."""
    texts = {f"_text_{new}": prepare(F.col(f"`{source}`")) for new, (source, (prepare, _)) in to.items()}
    return df.withColumns(texts).withColumns({new: of(F.col(f"_text_{new}")) for new, (_, (_, of)) in to.items()}).drop(*texts)


def instant(c: Column) -> Column:
    """A timestamp in UTC from ISO text with or without offset, without one read as UTC; null otherwise."""
    return strip(c).try_cast("timestamp")


def mapped(c: Column, names: dict[str, str] = REGION_NAMES, *, strict: bool = False) -> Column:
    """The trimmed text's standard name; others stay, or are null if ``strict`` and no standard name themselves."""
    text = strip(c)
    found = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[text]
    return F.coalesce(found, F.when(text.isin(*set(names.values())), text) if strict else text)


def in_box(lat: Column, lon: Column, latitudes=LATITUDES, longitudes=LONGITUDES) -> Column:
    """Whether both lie within the inclusive bounds; null if a null leaves it open."""
    return lat.between(*latitudes) & lon.between(*longitudes)


def coordinate(c: Column, bound: float) -> Column:
    """A finite double of at most ``bound``; null otherwise."""
    value = number(c)
    return F.when(~F.isnan(value) & (F.abs(value) <= bound), value)


def blank_pair(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Nulls both members of a pair that is surely invalid; a good member beside a null stays."""
    bad = ~in_box(F.col(lat), F.col(lon))
    return df.withColumns({c: F.when(bad, None).otherwise(F.col(c)) for c in (lat, lon)})


def any_null(df: DataFrame, columns: Iterable[str]) -> Column:
    """Whether one of the columns that exist is null; false if none exists."""
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns if c in df.columns], F.lit(False))


def equals(c: Column, value: str) -> Column:
    """Equality that is false for null."""
    return F.coalesce(c == value, F.lit(False))


def existing(df: DataFrame, columns: Iterable[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def preferred(df: DataFrame, order: Iterable[str]) -> DataFrame:
    """The preferred columns that exist, then the rest."""
    first = existing(df, order)
    return df.select(*first, *[c for c in df.columns if c not in first])


def rename_free(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Renames where the source exists and the target does not."""
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns and b not in df.columns})


def complete(df: DataFrame, columns: Iterable[str], value=None) -> DataFrame:
    """Adds the columns that are missing."""
    return df.withColumns({c: F.lit(value).cast("string") for c in columns if c not in df.columns})


def first_word(*c: Column) -> Column:
    """The first word of the first text that is not null."""
    return F.split(strip(F.coalesce(*c)), r"(?U)\s+")[0]


def last_segment(c: Column, separator: str = " > ") -> Column:
    return F.element_at(F.split(c, separator), -1)


def any_blank(columns: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(strip(F.col(c).cast("string")), F.lit("")) == "" for c in columns])


def observation_key(measured: Column, collected: Column) -> Column:
    """``measured:<iso>`` or else ``collected:<iso>``; null where neither is a moment."""
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    return F.coalesce(F.concat(F.lit("measured:"), iso(measured)), F.concat(F.lit("collected:"), iso(collected)))


def area_json(c: Column) -> Column:
    """Compact JSON of a Polygon or MultiPolygon with coordinates; null otherwise."""
    parsed = F.try_parse_json(c)
    kind = F.get_json_object(c, "$.type").isin("Polygon", "MultiPolygon")
    filled = F.json_array_length(F.get_json_object(c, "$.coordinates")) > 0
    return F.when(parsed.isNotNull() & kind & filled, F.to_json(parsed))


def empty_columns(raw: DataFrame, processed: DataFrame, keep: Iterable[str] = ("needs_review",)) -> list[str]:
    """Columns of both frames without any value in either; one aggregate a frame, none for empty frames."""
    both = [c for c in processed.columns if c in raw.columns and c not in set(keep)]
    if not both:
        return []
    held = lambda df, test: df.agg(F.count("*").alias("_n"), *[F.count_if(~test(F.col(f"`{c}`").cast("string"))).alias(c) for c in both]).first()
    before, after = held(raw, null_token), held(processed, lambda c: c.isNull())
    return [c for c in both if before["_n"] and after["_n"] and not before[c] and not after[c]]


# What tells of a spent daily allowance, and result codes of answers by what they mean.
DAILY_LIMIT = r'LIMITED_NUMBER_OF_SERVICE_REQUESTS_EXCEEDS_ERROR|"returnReasonCode": ?"22"'
RESULT_OK, RESULT_EMPTY, RESULT_TRANSIENT, RESULT_UNSUPPORTED, RESULT_STOP = ("00", "0", "0000"), "03", "99", "10", ("30", "31", "32")


def status_class(status: Column, code: Column, body: Column) -> Column:
    """What a source's answer means: global_stop, transient, empty, unsupported, permanent or ok.

    The status decides first, any but 200 being an error; then the result code, of which only those of success are ok.
    """
    code = F.coalesce(strip(code), F.lit(""))
    return (
        F.when((status == 429) & F.coalesce(body.rlike(DAILY_LIMIT), F.lit(False)), "global_stop")
        .when((status == 429) | (status >= 500), "transient")
        .when(status.isNull() | (status != 200), "permanent")
        .when(code == RESULT_EMPTY, "empty")
        .when(code == RESULT_TRANSIENT, "transient")
        .when(code == RESULT_UNSUPPORTED, "unsupported")
        .when(code.isin(*RESULT_STOP), "global_stop")
        .when(code.isin(*RESULT_OK), "ok")
        .otherwise("permanent")
    )
