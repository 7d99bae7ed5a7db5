"""Table processors: from raw text columns to typed ones, as tagging transformations.

A processor takes a raw frame with a place column (``_ingest_seq``: where the row came in its source) and returns all
its rows, typed, with the reasons for which rows are removed and the columns whose value was lost. ``accepted`` drops
these rows and marks. Text is trimmed, read and judged in projections of their own, so generated code holds no expression
twice. Processors that compare rows, or must refuse some, write their converted rows once and read these.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions import clean, text
from sluice.functions.values import HOTSPOT_LATITUDES, IN_OPERATION, LATITUDES, LONGITUDES
from sluice.operators import dedup, lineage, select
from sluice.operators.staging import staged

SEQ = "_ingest_seq"


@dataclass(frozen=True)
class Rules:
    """What a plain processor does, in this order; columns that a frame lacks are passed over, but for ``box``."""

    doubles: tuple[str, ...] = ()
    longs: tuple[str, ...] = ()
    moments: tuple[str, ...] = ()
    regions: tuple[str, ...] = ()
    review: tuple[str, ...] | None = None
    box: tuple[str, str] | None = None
    pairs: tuple[tuple[str, str], ...] = ()
    keys: tuple[str, ...] = ()
    select: tuple[str, ...] = ()
    name: str = ""


def convert(df: DataFrame, rules: Rules) -> DataFrame:
    kinds = ((rules.doubles, clean.NUMBER), (rules.longs, clean.INTEGER), (rules.moments, clean.MOMENT))
    return lineage.convert_all(df, {c: how for columns, how in kinds for c in clean.existing(df, columns)})


def numbers(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Doubles in place of text, without a mark of what was lost."""
    read = clean.read_as(df, {f"_value_{c}": (c, clean.NUMBER) for c in columns})
    return read.withColumns({c: F.col(f"_value_{c}") for c in columns}).drop(*[f"_value_{c}" for c in columns])


def within_box(df: DataFrame, lat: str, lon: str, reason: str, latitudes=LATITUDES) -> DataFrame:
    """Numbers for the coordinates, and a reason for rows outside the bounds or without them."""
    if missing := {lat, lon} - set(df.columns):
        raise ValueError(f"coordinates {sorted(missing)} are missing")
    df = numbers(df, (lat, lon))
    return lineage.remove_unless(df, clean.in_box(F.col(lat), F.col(lon), latitudes, LONGITUDES), reason)


def plain(rules: Rules) -> Callable[[DataFrame], DataFrame]:
    """A processor that follows ``rules``."""

    def process(raw: DataFrame) -> DataFrame:
        df = lineage.start_tags(clean.normalize_nulls(raw))
        if rules.box:
            df = within_box(df, *rules.box, f"{rules.name}_invalid_or_missing_korea_coordinates")
        for lat, lon in rules.pairs:
            if {lat, lon} <= set(df.columns):
                df = clean.blank_pair(numbers(df, (lat, lon)), lat, lon)
        df = convert(df, rules)
        df = df.withColumns({c: clean.mapped(F.col(c)) for c in clean.existing(df, rules.regions)})
        if keys := clean.existing(df, rules.keys):
            df = lineage.remove_earlier(df, keys, [F.col(SEQ)], f"{rules.name}_duplicate")
        if rules.review is not None:
            df = df.withColumn("needs_review", clean.any_null(df, rules.review))
        if rules.select:
            df = df.select(*clean.existing(df, rules.select), *[c for c in df.columns if c.startswith("_")])
        return df

    return process


def facility(raw: DataFrame) -> DataFrame:
    """Facilities in operation with valid coordinates, the last row of each code."""
    df = lineage.start_tags(clean.normalize_nulls(raw))
    if "faci_stat_nm" in df.columns:
        df = lineage.remove_unless(df, clean.equals(F.col("faci_stat_nm"), IN_OPERATION), "facility_status_not_normal_operation")
    df = within_box(df, "faci_lat", "faci_lot", "facility_invalid_or_missing_korea_coordinates")
    df = convert(df, Rules(doubles=("faci_gfa",), moments=("base_ymd", "reg_dt", "updt_dt")))
    if "faci_cd" in df.columns:
        df = lineage.remove_earlier(df, ["faci_cd"], [F.col(SEQ)], "facility_duplicate_faci_cd")
    # The columns that are published.
    columns = ("faci_cd", "faci_nm", "faci_stat_nm", "ftype_nm", "fcob_nm", "inout_gbn_nm", "cp_nm", "cpb_nm", "addr_emd_nm", "faci_road_addr", "faci_addr", "faci_lat", "faci_lot", "faci_gfa", "base_ymd", "reg_dt", "updt_dt")
    return df.select(*clean.existing(df, columns), *[c for c in df.columns if c.startswith("_")])


def public_open_facility(raw: DataFrame) -> DataFrame:
    """Region from the address, and flags on coordinates and address."""
    df = lineage.start_tags(clean.normalize_nulls(raw)).drop("sido")
    df = clean.complete(df, ("rdnmadr", "lnmadr"))
    df = df.withColumn("sido_raw", clean.first_word(F.col("rdnmadr"), F.col("lnmadr"))).withColumn("sido_standard", clean.mapped(F.col("sido_raw")))
    df = within_box(df, "latitude", "longitude", "public_open_facility_invalid_or_missing_korea_coordinates")
    return df.withColumns({"coordinate_exists": F.lit(True), "coordinate_valid": F.lit(True), "address_valid": F.col("sido_raw").isNotNull()}).withColumn("needs_review", ~F.col("address_valid"))


def air_quality(raw: DataFrame) -> DataFrame:
    """Observations by their natural identity; the undated take the time of their capture."""
    times = ("dataTime", "collected_at")
    df = clean.read_as(lineage.start_tags(clean.normalize_nulls(raw)), {f"_value_{c}": (c, clean.MOMENT) for c in times})
    known = [F.col(c).isNotNull() & F.col(f"_value_{c}").isNull() for c in times]
    key = clean.observation_key(*[F.col(f"_value_{c}") for c in times])
    failed = F.raise_error(F.lit("an observation has no usable time"))
    # malformed times must stop the load, not become another identity
    df = df.withColumn("observation_time_key", F.when(known[0] | known[1] | key.isNull(), failed.cast("string")).otherwise(key))
    df = convert(lineage.take(df, times), Rules(doubles=("o3Value",), longs=("pm10Value", "pm25Value", "khaiValue", "pm10Grade", "pm25Grade", "khaiGrade")))
    df = lineage.remove_earlier(df, ["sidoName", "stationName", "observation_time_key"], [F.col(SEQ)], "air_quality_duplicate_observation")
    return df.withColumn("needs_review", clean.any_null(df, ("dataTime", "pm10Value", "pm25Value", "o3Value", "khaiValue")))


def weather(raw: DataFrame) -> DataFrame:
    """Observations and forecasts; rain amounts stay text, other forecast values must be numbers."""
    df = convert(lineage.start_tags(clean.normalize_nulls(raw)), Rules(doubles=("obsrValue",), longs=("nx", "ny")))
    if {"fcstValue", "category"} <= set(df.columns):
        df = clean.read_as(df, {"_number": ("fcstValue", clean.NUMBER)})
        df = lineage.convert(df, "fcstValue", F.when(clean.equals(F.col("category"), "RN1"), F.col("fcstValue")).otherwise(F.col("_number").cast("string"))).drop("_number")
    df = convert(df, Rules(moments=("baseDate", "fcstDate", "collected_at")))
    keys = clean.existing(df, ("baseDate", "baseTime", "fcstDate", "fcstTime", "nx", "ny", "category"))
    return lineage.remove_earlier(df, keys, [F.col(SEQ)], "weather_duplicate_observation") if keys else df


def require_key(df: DataFrame, key: str, *, unique: bool = True) -> None:
    """Raises for a missing column, a null or a duplicate; one aggregate."""
    if key not in df.columns:
        raise ValueError(f"{key} is missing")
    counts = df.groupBy(key).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("nulls"), F.count_if((F.col("n") > 1) & F.col(key).isNotNull()).alias("twice")).first()
    if counts["nulls"] or (unique and counts["twice"]):
        raise ValueError(f"{key}: {counts['nulls']} nulls, {counts['twice']} duplicate values")


def trails(raw: DataFrame) -> DataFrame:
    df = staged(convert(lineage.start_tags(clean.normalize_nulls(raw)), Rules(moments=("createdtime", "modifiedtime", "collected_at"))), "trails")
    require_key(df, "routeIdx")
    return df.withColumn("needs_review", clean.any_null(df, ("routeIdx", "themeNm")))


def segments(raw: DataFrame) -> DataFrame:
    df = convert(lineage.start_tags(clean.normalize_nulls(raw)), Rules(doubles=("crsDstnc",), longs=("crsLevel",), moments=("createdtime", "modifiedtime", "collected_at")))
    df = staged(df, "segments")
    require_key(df, "crsIdx")
    require_key(df, "routeIdx", unique=False)
    return df.withColumn("needs_review", clean.any_null(df, ("routeIdx", "crsIdx", "crsKorNm", "crsDstnc")))


def weather_warning(raw: DataFrame) -> DataFrame:
    df = convert(lineage.start_tags(clean.normalize_nulls(raw)), Rules(longs=("tmSeq",), moments=("tmFc", "collected_at")))
    return lineage.remove_earlier(df, ["stnId", "tmFc", "tmSeq"], [F.col(SEQ)], "weather_warning_duplicate_stn_tmfc_tmseq")


def weather_warning_status(raw: DataFrame) -> DataFrame:
    """A row for each warning that the latest bulletin names; a bulletin fans out to several rows of one lineage."""
    needed = ("t6", "t7", "tmEf", "tmFc", "tmSeq", "collected_at")
    if missing := set(needed) - set(raw.columns):
        raise ValueError(f"{sorted(missing)} are missing")
    last = select.latest(clean.normalize_nulls(raw), [clean.number(F.col("tmFc")), clean.number(F.col("tmSeq")), F.col(SEQ)])
    extra = tuple(clean.existing(raw, (SEQ, lineage.ROW_ID)))
    both = text.active_warnings(last, extra=extra).union(text.preliminary_warnings(last, SEQ, extra=extra))
    df = convert(lineage.start_tags(both), Rules(longs=("tmSeq",), moments=("tmEf", "tmFc", "collected_at")))
    keys = ["warning_type", "warning_level", "warning_status", "area_name", "area_type", "tmEf", "tmFc", "tmSeq"]
    return lineage.remove_earlier(df, keys, [F.col(SEQ)], "weather_warning_status_duplicate")


# Names of the hotspot table's columns before and after, and which of them must have a value.
HOTSPOT_NAMES = {"request_year": "search_year", "request_sido": "si_do", "request_gugun": "gu_gun", "request_province_name": "province_name", "request_district_name": "district_name", "lo_crd": "longitude", "la_crd": "latitude"}
HOTSPOT_COUNTS = ("occrrnc_cnt", "caslt_cnt", "dth_dnv_cnt", "se_dnv_cnt", "sl_dnv_cnt", "wnd_dnv_cnt")
HOTSPOT_CRITICAL = ("afos_fid", "afos_id", "search_year", "si_do", "gu_gun", "spot_nm", "latitude", "longitude", "occrrnc_cnt")


def bicycle(raw: DataFrame) -> DataFrame:
    """Accident hotspots; counts that are no numbers, negative counts, foreign keys and lost times are errors."""
    df = clean.rename_free(lineage.start_tags(clean.normalize_nulls(raw)), HOTSPOT_NAMES)
    if missing := set(HOTSPOT_CRITICAL) - set(df.columns):
        raise ValueError(f"{sorted(missing)} are missing")
    df = df.withColumns({c: F.col(c).cast("string") for c in clean.existing(df, ("afos_fid", "afos_id", "bjd_cd", "spot_cd", "si_do", "gu_gun"))})
    counts = clean.existing(df, HOTSPOT_COUNTS)
    df = convert(df, Rules(doubles=("longitude", "latitude"), longs=("search_year", *HOTSPOT_COUNTS, "request_page_no")))
    if "collected_at" in df.columns:
        df = lineage.convert(df, "collected_at", clean.instant(F.col("collected_at")))
    df = staged(df, "hotspots")
    lost = [c for c in df.columns if c.startswith(lineage.LOSS)]
    faults = {
        "values that are no numbers or times": sum((F.col(c).cast("int") for c in lost), F.lit(0)) > 0,
        "negative counts": sum((F.coalesce(F.col(c) < 0, F.lit(False)).cast("int") for c in counts), F.lit(0)) > 0,
        "rows without a critical value": clean.any_null(df, [c for c in HOTSPOT_CRITICAL if c not in ("latitude", "longitude")]),
        "rows of another area": ~F.coalesce(F.col("afos_id") == F.col("expected_afos_id"), F.lit(True)) if "expected_afos_id" in df.columns else F.lit(False),
    }
    found = df.agg(*[F.count_if(c).alias(k) for k, c in faults.items()]).first().asDict()
    if bad := {k: n for k, n in found.items() if n}:
        raise ValueError(f"hotspots: {bad}")
    df = df.withColumn("coordinate_valid", F.coalesce(clean.in_box(F.col("latitude"), F.col("longitude"), HOTSPOT_LATITUDES), F.lit(False)))
    df = lineage.remove_unless(df, F.col("coordinate_valid"), "bicycle_invalid_coordinates")
    if "geom_json" in df.columns:
        df = df.withColumn("geom_json", clean.area_json(F.col("geom_json"))).withColumn("polygon_valid", F.col("geom_json").isNotNull())
    payload = [c for c in df.columns if not c.startswith("_") and c not in ("afos_fid", "collected_at", "request_page_no")]
    if bad := dedup.conflicts(df.where(lineage.live()), ["afos_fid"], payload).limit(5).collect():
        raise ValueError(f"hotspots with conflicting rows: {[r['afos_fid'] for r in bad]}")
    df = lineage.remove_earlier(df, ["afos_fid"], [F.col(SEQ)], "bicycle_duplicate", last=False)
    df = df.withColumn("needs_review", clean.any_null(df, ("afos_fid", "spot_nm", "latitude", "longitude", "occrrnc_cnt")))
    return clean.preferred(df, ("afos_fid", "afos_id", "bjd_cd", "spot_cd", "sido_sgg_nm", "spot_nm", "search_year", "si_do", "gu_gun", "province_name", "district_name", "longitude", "latitude", *HOTSPOT_COUNTS))


# The columns of the culture tables by what is done with them.
_FIVE = range(1, 6)
CULTURE = {
    "public_sports_facilities": Rules(box=("FCLTY_LA", "FCLTY_LO"), doubles=("FCLTY_AR_CO",), longs=("ACMD_NMPR_CO", "ADTM_CO"), regions=("POSESN_MBY_CTPRVN_NM", "ROAD_NM_CTPRVN_NM"), review=("FCLTY_NM", "FCLTY_TY_NM", "RDNMADR_NM")),
    "public_sports_facility_programs": Rules(
        box=("FCLTY_LA", "FCLTY_LO"),
        pairs=tuple((f"PBTRNSP_FCLTY_{i}R_LA", f"PBTRNSP_FCLTY_{i}R_LO") for i in _FIVE),
        doubles=tuple(f"{k}_DSTNC_{i}R_VALUE" for k in ("STRT", "WLKG") for i in _FIVE),
        longs=(*(f"WLKG_MVMN_{i}R_TIME" for i in _FIVE), "PROGRM_RCRIT_NMPR_CO"),
        moments=("PROGRM_BEGIN_DE", "PROGRM_END_DE"),
        regions=("CTPRVN_NM",),
        review=("FCLTY_NM", "PROGRM_NM", "PROGRM_TY_NM", "FCLTY_LA", "FCLTY_LO"),
    ),
    "sports_facility_nearby_public_transport": Rules(box=("ALSFC_LA", "ALSFC_LO"), pairs=(("PBTRNSP_FCLTY_LA", "PBTRNSP_FCLTY_LO"),), doubles=("STRT_DSTNC_VALUE", "WLKG_DSTNC_VALUE"), longs=("WLKG_MVMN_TIME",), regions=("ALSFC_CTPRVN_NM",), review=("ALSFC_NM", "ALSFC_ADDR", "PBTRNSP_FCLTY_SDIV_NM")),
    "national_sports_facility_status": Rules(
        box=("FCLTY_LA", "FCLTY_LO"),
        doubles=("FCLTY_AR_CO",),
        longs=("ADTM_CO", "ACMD_NMPR_CO"),
        moments=("FCLTY_CRTN_STDR_DE", "ALSFC_REGIST_DE", "COMPET_DE", "SSS_DE", "OPER_CLSBIZ_DE", "REGIST_DT", "UPDT_DT"),
        regions=("CTPRVN_NM", "FCLTY_MANAGE_CTPRVN_NM", "POSESN_MBY_CTPRVN_NM"),
        review=("FCLTY_NM", "FCLTY_TY_NM", "CTPRVN_NM", "SIGNGU_NM"),
    ),
    "location_fitness_measurement_prescriptions": Rules(box=("CNTER_LA", "CNTER_LO"), longs=("MESURE_AGE_CO",), moments=("MESURE_DE",), regions=("CTPRVN_NM",), review=("CNTER_NM", "MESURE_DE", "MESURE_AGE_CO")),
    "open_school_sports_facilities": Rules(longs=("BASE_YEAR", "SHWERRM_CO", "TOILET_CO", "LOCKERRM_CO"), regions=("ALSFC_CTPRVN_NM",), review=("BASE_YEAR", "SCHUL_NM", "ALSFC_ADDR", "OPER_ITEM_CN")),
    "sports_facility_safety_inspections": Rules(box=("FCLTY_CRDNT_LA", "FCLTY_CRDNT_LO"), doubles=("FCLTY_TOTAR_CO",), moments=("OPER_CLSBIZ_DE", "FCLTY_INFO_UPDT_DE", "SAFECHK_DE", "SAFECHK_OTHBC_DE", "FCLTY_INFO_REGIST_DE"), regions=("CMPTNC_CTPRVN_NM",), review=("FCLTY_NM", "FCLTY_CL_NM", "OPER_STATE_NM", "SAFECHK_GNRLZ_GRAD_NM")),
    "fitness_measurement_prescriptions": Rules(longs=("MESURE_AGE_CO",), moments=("MESURE_DE",), review=("CNTER_NM", "MESURE_DE", "MESURE_AGE_CO", "MVM_PRSCRPTN_CN")),
}

PROCESSORS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "weather": weather,
    "air_quality": air_quality,
    "weather_warning": weather_warning,
    "weather_warning_status": weather_warning_status,
    "trails": trails,
    "segments": segments,
    "facility": facility,
    "public_open_facility": public_open_facility,
    "aed": plain(Rules(box=("wgs84Lat", "wgs84Lon"), keys=("serialSeq",), name="aed")),
    "bicycle": bicycle,
    "culture_base": plain(Rules(name="culture")),
    **{f"culture_{k}": plain(Rules(**{**r.__dict__, "name": f"culture_{k}"})) for k, r in CULTURE.items()},
}


def dealt(raw: DataFrame) -> DataFrame:
    """The rows over all cores by their place: a file of some MB is one task, however much there is to do for each row."""
    return raw.repartition(4 * raw.sparkSession.sparkContext.defaultParallelism, SEQ) if SEQ in raw.columns else raw


def process(name: str, raw: DataFrame, *, allow_empty: bool = False, drop_empty_columns: bool = True) -> DataFrame:
    """Accepted rows of a processor; unknown names, and no rows unless allowed, are errors."""
    if name not in PROCESSORS:
        raise KeyError(f"no processor {name}")
    out = staged(lineage.accepted(PROCESSORS[name](dealt(raw))).drop(SEQ), "processed")
    if not allow_empty and out.isEmpty():
        raise ValueError(f"{name}: no row is left")
    if drop_empty_columns and (empty := clean.empty_columns(raw, out)):
        out = out.drop(*empty)
    if not out.columns:
        raise ValueError(f"{name}: no column is left")
    return out
