"""Opening hours and feasibility, with explicit unknown states; times are local and without zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.clean import normalize
from sluice.functions.values import FEATURE_NULL_TOKENS, OPEN_ALL_YEAR, PUBLIC_HOLIDAYS, RULE_SEPARATORS, WEEKDAYS, WEEKEND

TOO_LATE_BELOW, CLOSING_SOON_UPTO = 30, 60


def clock(c: Column) -> Column:
    """Minutes of the day from HH:MM or HHMM; 24:00 is 1440; null otherwise."""
    text = normalize(c, FEATURE_NULL_TOKENS)
    hour = F.regexp_extract(text, r"^(\d{2}):?(\d{2})$", 1).try_cast("int")
    minute = F.regexp_extract(text, r"^(\d{2}):?(\d{2})$", 2).try_cast("int")
    return F.when((hour == 24) & (minute == 0), 1440).when((hour < 24) & (minute < 60), hour * 60 + minute)


def closed_on(rule: Column, day: Column, holiday: Column | None = None) -> Column:
    """Whether a closing-day rule closes the day: true, false, or null where a part of it is not understood.

    ``holiday`` says whether the day is a public holiday; without it rules about these stay unknown.
    """
    text = F.regexp_replace(normalize(rule, FEATURE_NULL_TOKENS), r"(?U)\s+", "")
    weekday = F.weekday(day)
    holiday = F.lit(None).cast("boolean") if holiday is None else holiday

    def closes(token: Column) -> Column:
        name = F.regexp_replace(token, "요일$", "")
        index = F.instr(F.lit(WEEKDAYS), name) - 1
        return F.when((F.length(name) == 1) & (index >= 0), weekday == index).when(name == WEEKEND, weekday >= 5).when(name.isin(*PUBLIC_HOLIDAYS), holiday)

    return F.when(text == OPEN_ALL_YEAR, False).when(text != "", F.exists(F.split(text, RULE_SEPARATORS), closes))


def _at(day: Column, minutes: Column) -> Column:
    return day.cast("timestamp_ntz") + F.make_dt_interval(mins=minutes)


def add_feasibility(df: DataFrame, now: Column, travel: Column, rule: Column, hours: dict[str, Column], holidays: tuple[Column, Column, Column] | None = None) -> DataFrame:
    """Adds ``feasibility``: struct of open_now, closes_at, arrival, remaining, usable, state, urgency and known.

    ``holidays`` says of yesterday, today and tomorrow whether they are public holidays. Yesterday's hours that run
    past midnight count, today's closing beats them, and a closing tomorrow ends hours at midnight. Each step is a
    projection of its own, so that no expression holds another one many times over.
    """
    h = holidays or (None, None, None)
    c = lambda name: F.col(f"_s_{name}")
    add = lambda df, **columns: df.withColumns({f"_s_{k}": v for k, v in columns.items()})
    none = F.lit(None).cast("boolean")
    df = add(df, now=now, today=now.cast("date"), travel=travel, rule=rule, **{k: clock(v) for k, v in hours.items()})
    df = add(df, past=F.date_sub(c("today"), 1), next=F.date_add(c("today"), 1))
    df = add(df, **{f"{d}_closed": closed_on(c("rule"), c(d), x) for d, x in zip(("past", "today", "next"), h)})
    for d in ("past", "today"):
        week = F.weekday(c(d)) < 5
        df = add(df, a=F.when(week, c("week_open")).otherwise(c("weekend_open")), b=F.when(week, c("week_close")).otherwise(c("weekend_close")))
        df = add(df, known=F.coalesce(~c(f"{d}_closed") & (c("a") != c("b")) & (c("a") != 1440), F.lit(False)))
        df = add(df, **{f"{d}_known": c("known"), f"{d}_start": F.when(c("known"), _at(c(d), c("a"))), f"{d}_stop": F.when(c("known"), _at(c(d), F.when(c("b") < c("a"), c("b") + 1440).otherwise(c("b"))))})
    within = lambda d: F.coalesce((c(f"{d}_start") <= c("now")) & (c("now") < c(f"{d}_stop")), F.lit(False))
    df = add(df, ran=within("past"), runs=within("today"))
    closed_today = F.coalesce(c("today_closed"), F.lit(False))
    past_unknown = ~c("past_known") & ~F.coalesce(c("past_closed"), F.lit(False))
    df = add(
        df,
        open=F.when(closed_today, False).when(~c("today_known"), none).when(c("ran") | c("runs"), True).when(past_unknown & (c("now") < c("today_start")), none).otherwise(False),
        stop=F.when(c("ran"), c("past_stop")).when(c("runs"), c("today_stop")),
        midnight=c("next").cast("timestamp_ntz"),
        arrival=c("now") + F.make_dt_interval(secs=(F.when((c("travel") >= 0) & (c("travel") < 1e6), c("travel")) * 60).cast("decimal(18,6)")),
    )
    over = c("stop") > c("midnight")
    closes = F.when(over & c("next_closed").isNull(), F.lit(None).cast("timestamp_ntz")).when(over & c("next_closed"), c("midnight")).otherwise(c("stop"))
    df = add(df, closes=F.when(c("open"), closes))
    minutes = lambda late, early: F.timestamp_diff("MICROSECOND", early, late) / 60e6
    df = add(df, remaining=minutes(c("closes"), c("now")), usable=F.when(c("closes").isNotNull() & c("arrival").isNotNull(), F.greatest(F.lit(0.0), minutes(c("closes"), c("arrival")))))
    df = add(df, state=F.when(~c("open"), "CLOSED").when(c("usable").isNull(), "UNKNOWN").when(c("usable") < TOO_LATE_BELOW, "TOO_LATE").otherwise("AVAILABLE"))
    urgency = F.when((c("state") == "AVAILABLE") & (c("usable") <= CLOSING_SOON_UPTO), "CLOSING_SOON").otherwise(c("state"))
    known = c("open").isNotNull() & (~c("open") | c("closes").isNotNull())
    out = F.struct(c("open").alias("open_now"), c("closes").alias("closes_at"), *[c(k).alias(k) for k in ("arrival", "remaining", "usable", "state")], urgency.alias("urgency"), known.alias("known"))
    df = df.withColumn("feasibility", out)
    return df.drop(*[k for k in df.columns if k.startswith("_s_")])


def combine(states: Column) -> Column:
    """CAUTION if any, FAVORABLE if all of at least one, else UNKNOWN."""
    return (
        F.when(F.coalesce(F.array_contains(states, "CAUTION"), F.lit(False)), "CAUTION")
        .when((F.size(states) > 0) & F.coalesce(F.forall(states, lambda s: s == "FAVORABLE"), F.lit(False)), "FAVORABLE")
        .otherwise("UNKNOWN")
    )


def observation_base(now: Column) -> tuple[Column, Column]:
    """Base date and time (HH00) of the observation an hour ago."""
    at = now - F.expr("INTERVAL 1 HOUR")
    return F.date_format(at, "yyyyMMdd"), F.date_format(at, "HH'00'")


def forecast_base(now: Column) -> tuple[Column, Column]:
    """Base date and time (HH30) of the forecast: this hour's from minute 45, else the one before."""
    at = F.when(F.minute(now) >= 45, now).otherwise(now - F.expr("INTERVAL 1 HOUR"))
    return F.date_format(at, "yyyyMMdd"), F.date_format(at, "HH'30'")
