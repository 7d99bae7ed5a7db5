"""Three-valued states of a key over all of its rows."""

from pyspark.sql import functions as F

from compare import DATA, same
from sluice.plans import queries

SQL = """
WITH s AS (SELECT user_id, CASE event_type WHEN 'view' THEN 'FAVORABLE' WHEN 'click' THEN 'FAVORABLE' WHEN 'error' THEN 'CAUTION' END AS state FROM events)
SELECT user_id, CASE WHEN bool_or(state = 'CAUTION') THEN 'CAUTION' WHEN bool_and(coalesce(state = 'FAVORABLE', false)) THEN 'FAVORABLE' ELSE 'UNKNOWN' END AS combined FROM s GROUP BY 1
"""


def test_all_events_are_combined(spark):
    state = F.when(F.col("event_type").isin("view", "click"), "FAVORABLE").when(F.col("event_type") == "error", "CAUTION")
    same(queries.combine_by(queries.t(spark, DATA, "events"), "user_id", state), SQL)


def test_groups_are_bounded(spark):
    plan = queries.three_valued_combine(spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" in plan and "collect_list" not in plan
