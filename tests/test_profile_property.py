"""Property test: dtype, missing and duplicate flags agree with pandas
``read_csv`` for random columns drawn from tricky cell texts."""

import io

import pandas as pd
from conftest import text_frame
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tablewright.operators import profile as P

TOKENS = ["1", "007", "-3", "+5", " 5", "1.0", "2.5", "1e3", "1000", "inf", "-Infinity", "True", "false", "TRUE",
          "x", "NA", "", "nan", "1,000", "0", "-0", ".5", "5.", "2020-01-01", "None-like"]

columns = st.lists(st.lists(st.sampled_from(TOKENS), min_size=4, max_size=4), min_size=20, max_size=20)


def _csv(cols):
    names = [f"c{i}" for i in range(len(cols))] + ["z"]
    lines = [",".join(names)]
    for r in range(4):
        cells = []
        for col in cols:
            v = col[r]
            cells.append('"' + v + '"' if "," in v else v)
        lines.append(",".join(cells + ["z"]))
    return "\n".join(lines) + "\n"


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(columns)
def test_flags_agree_with_pandas(spark, cols):
    pdf = pd.read_csv(io.StringIO(_csv(cols)))
    df = text_frame(spark, {f"c{i}": [None if v == "" else v for v in col] for i, col in enumerate(cols)})
    got = {r["column_name"]: r for r in P.profile(df, order="_o", columns=[f"c{i}" for i in range(len(cols))]).collect()}
    for i in range(len(cols)):
        s = pdf[f"c{i}"]
        name = f"c{i}"
        assert got[name]["pandas_column_dtype"] == str(s.dtype), (name, cols[i])
        assert got[name]["missing_data_flag_list"] == bool(s.isna().any()), (name, cols[i])
        vc = s.value_counts()
        assert got[name]["duplicate_data_flag_list"] == bool(vc.sum() != len(vc)), (name, cols[i])
