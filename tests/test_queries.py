"""Every registered query beside its SQL, and the entry module without the training-text operators."""

import pytest

from compare import DATA, same
from sluice.plans import queries


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_sql(spark, name):
    df = queries.QUERIES[name](spark, DATA)
    if name in queries.SQL:
        same(df, queries.SQL[name])
    else:
        df.collect()
