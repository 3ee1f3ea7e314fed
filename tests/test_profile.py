"""O-16, O-18, O-20 … O-29: inference parity with pandas read_csv."""

import io

import pandas as pd
import pytest
from conftest import text_frame

from tablewright.operators import profile as P

CASES = {
    "ints": ["1", "2", "3"],
    "lead0": ["007", "5", "6"],
    "spaceint": [" 5", "6 ", "7"],
    "plus": ["+5", "-3", "4"],
    "intmiss": ["1", None, "3"],
    "float": ["1e3", "2.5", "3"],
    "inf": ["inf", "1", "-Infinity"],
    "bool": ["True", "false", "TRUE"],
    "boolmiss": ["True", None, "False"],
    "mixed": ["T", "0", "x"],
    "comma": ["1,000", "2", "3"],
    "date": ["2020-01-01", "2020-01-02", "2020-01-03"],
    "allmiss": [None, None, None],
    "tokens": ["NULL", "NA", "nan"],
    "spNA": [" NA", "1", "2"],
    "dupf": ["1", "1.0", "2"],
    "dupi": ["7", "007", "8"],
    "dupt": ["a", "a", "b"],
    "textvariants": ["007", "7", "x"],
    "textdup_noncanon": ["007", "007", "x"],
    "neg0": ["-0", "0", "1"],
    "missing_twice": [None, None, "1"],
    "big": ["18446744073709551615", "1", "2"],
    "bigger": ["184467440737095516150", "1", "2"],
}


def pandas_profile(cases):
    cols = list(cases)
    lines = [",".join(cols)]
    for i in range(3):
        cells = []
        for c in cols:
            v = cases[c][i]
            v = "" if v is None else v
            cells.append('"' + v + '"' if "," in v else v)
        lines.append(",".join(cells))
    df = pd.read_csv(io.StringIO("\n".join(lines) + "\n"))
    out = {}
    for c in cols:
        s = df[c]
        out[c] = {
            "dtype": str(s.dtype),
            "missing": bool(s.isna().sum() != 0),
            "dup": bool(s.value_counts().sum() != len(s.value_counts())),
        }
    return out


@pytest.fixture(scope="module")
def prof(spark):
    df = text_frame(spark, CASES)
    return {r["column_name"]: r for r in P.profile(df, order="_o", columns=list(CASES)).collect()}


def test_dtypes_match_pandas(prof):
    expect = pandas_profile(CASES)
    for c, e in expect.items():
        assert prof[c]["pandas_column_dtype"] == e["dtype"], c
        assert prof[c]["missing_data_flag_list"] == e["missing"], c
        assert prof[c]["duplicate_data_flag_list"] == e["dup"], c


def test_tags_and_mixed(prof):
    assert prof["ints"]["AWS_column_dtype"] == "N"
    assert prof["float"]["AWS_column_dtype"] == "N"
    assert prof["bool"]["AWS_column_dtype"] == "BOOL"
    assert prof["date"]["AWS_column_dtype"] == "S"
    assert prof["big"]["AWS_column_dtype"] == "N"  # uint64: our decision
    assert prof["date"]["mixed_datatype_flag_list"] is True
    assert prof["ints"]["mixed_datatype_flag_list"] is False


def test_example_items_render_by_type(prof):
    assert prof["lead0"]["example_item_list"] == "7"  # D3: ints without .0
    assert prof["intmiss"]["example_item_list"] == "1.0"  # float column
    assert prof["bool"]["example_item_list"] == "True"
    assert prof["allmiss"]["example_item_list"] is None
    assert prof["date"]["example_item_list"] == "2020-01-01"


def test_minimal_equals_full_subset(spark, prof):
    df = text_frame(spark, CASES)
    m = {r["column_name"]: r for r in P.profile_minimal(df, order="_o", columns=list(CASES)).collect()}
    for c in CASES:
        for f in ("AWS_column_dtype", "pandas_column_dtype", "example_item_list"):
            assert m[c][f] == prof[c][f], (c, f)


def test_null_counts(spark):
    df = text_frame(spark, {"a": ["1", None, "NA"], "b": ["x", "y", " NA"]})
    r = {x["column_name"]: x for x in P.null_counts(df, columns=["a", "b"]).collect()}
    assert r["a"]["null_count"] == 2 and r["b"]["null_count"] == 0


def test_key_flags(spark):
    cases = {
        "keys_ok": ["1", "2", "3"],
        "keys_missing": ["1", None, "3"],
        "keys_dup": ["1", "1", "3"],
        "keys_text": ["a", "b", "c"],
        "keys_all": ["a", "a", None],
    }
    got = {}
    for name, cells in cases.items():
        df = text_frame(spark, {name: cells})
        got[name] = P.primary_key_flags(df, key=name).first()["warning_flags"]
    assert got["keys_ok"] == []
    assert got["keys_missing"] == ["missing_data_flag"]
    assert got["keys_dup"] == ["duplicate_data_flag"]
    assert got["keys_text"] == ["mixed_datatype_flag"]  # D1, strict
    assert got["keys_all"] == ["mixed_datatype_flag", "missing_data_flag", "duplicate_data_flag"]
    lax = P.primary_key_flags(text_frame(spark, {"k": ["a", "b"]}), key="k", strict=False).first()
    assert lax["warning_flags"] == []
    with pytest.raises(P.PrimaryKeyError):
        P.require_primary_key(text_frame(spark, {"k": ["1", "1"]}), key="k")


def test_profile_by_file_groups(spark):
    df = text_frame(spark, {"f": ["a", "a", "b"], "x": ["1", "1", "x"]})
    r = {x["f"]: x for x in P.profile(df, order="_o", by=["f"], columns=["x"]).collect()}
    assert r["a"]["pandas_column_dtype"] == "int64" and r["a"]["duplicate_data_flag_list"] is True
    assert r["b"]["pandas_column_dtype"] == "object" and r["b"]["duplicate_data_flag_list"] is False


def test_one_scan_plan_matches_default(spark, prof):
    df = text_frame(spark, CASES)
    one = {r["column_name"]: r for r in P.profile(df, order="_o", columns=list(CASES), plan="one_scan").collect()}
    for c in CASES:
        assert one[c].asDict() == prof[c].asDict(), c
    grouped = text_frame(spark, {"f": ["a", "a", "b"], "x": ["007", "7", "x"]})
    a = P.profile(grouped, order="_o", by=["f"], columns=["x"], n_groups=2, plan="one_scan").orderBy("f").collect()
    b = P.profile(grouped, order="_o", by=["f"], columns=["x"], n_groups=2).orderBy("f").collect()
    assert [r.asDict() for r in a] == [r.asDict() for r in b]
