"""Property tests: keep-first dedup vs pandas, exact quantiles vs numpy."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from basketry.operators.dedup import keep_first
from basketry.operators.quantile import exact_quantiles

rows = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 50), st.floats(-1e6, 1e6, allow_nan=False)),
                min_size=1, max_size=60)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows)
def test_keep_first_equals_pandas_in_order(spark, data):
    data = [(k, i, v) for i, (k, _, v) in enumerate(data)]          # position = file order
    df = spark.createDataFrame(data, "k int, pos int, v double")
    got = sorted(tuple(r) for r in keep_first(df, "k", ["pos"]).collect())
    want = sorted(map(tuple, pd.DataFrame(data, columns=["k", "pos", "v"])
                      .drop_duplicates(subset="k").itertuples(index=False)))
    assert got == want


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows, st.sampled_from([0.0, 0.25, 0.5, 0.9, 1.0]), st.booleans())
def test_exact_quantiles_equal_numpy(spark, data, p, wide):
    df = spark.createDataFrame(data, "g int, x int, v double")
    got = {r.g: r.q for r in exact_quantiles(df, "v", [p], ["q"], by=["g"], wide=wide).collect()}
    frame = pd.DataFrame(data, columns=["g", "x", "v"])
    for g, grp in frame.groupby("g"):
        assert got[g] == pytest.approx(float(np.quantile(grp["v"].to_numpy(), p)), rel=1e-9, abs=1e-9)
