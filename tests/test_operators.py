"""O-12 … O-17, O-30 … O-32, O-40 … O-43, O-50, O-61, O-03 … O-11, O-70 … O-72."""

import re

import pytest
from conftest import text_frame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tablewright.functions.cells import parse_collection, table_name_of
from tablewright.operators import items, ordinal, sets, split, upsert
from tablewright.sinks import ledger
from tablewright.sources import catalog


def test_ordinal_matches_single_partition_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") % 37).alias("a"), (F.col("id") % 11).alias("b"), F.col("id").alias("c"))
    df = df.repartition(7)
    got = ordinal.with_ordinal(df, ["a", "b", "c"], "n", num_partitions=5)
    ref = df.withColumn("m", F.row_number().over(Window.orderBy("a", "b", "c")) - 1)
    diff = got.join(ref, ["a", "b", "c"]).filter(F.col("n") != F.col("m")).count()
    assert diff == 0 and got.select("n").distinct().count() == 5000


def test_ordinal_with_duplicate_rows_and_hot_key(spark):
    # one value holds most rows, and rows repeat whole: numbers stay dense
    df = spark.range(0, 3000).select(F.when(F.col("id") < 2000, F.lit(1)).otherwise(F.col("id")).alias("k"))
    got = ordinal.with_ordinal(df, ["k"], "n", num_partitions=6)
    r = got.agg(F.min("n"), F.max("n"), F.countDistinct("n")).first()
    assert tuple(r) == (0, 2999, 3000)


def test_row_key_and_prefixed_key(spark):
    df = spark.createDataFrame([(30, "c"), (10, "a"), (20, "b")], "k long, v string")
    rk = ordinal.add_row_key(df, "k").orderBy("Row_Number").collect()
    assert [tuple(r) for r in rk] == [(1, 10, "a"), (2, 20, "b"), (3, 30, "c")]
    assert rk[0].__fields__[0] == "Row_Number"
    pk = ordinal.add_prefixed_key(df, "Test", "k").orderBy("k").collect()
    assert [r["custom_primary_key"] for r in pk] == ["Test_1", "Test_2", "Test_3"]


def test_row_range_half_open(spark):
    df = spark.range(0, 100).withColumnRenamed("id", "k")
    small = ordinal.row_range(df, "k", 10, 15).collect()
    assert [r["k"] for r in small] == [10, 11, 12, 13, 14]
    big = ordinal.row_range(df, "k", 10, 15, ordinal_name="pos").orderBy("pos").collect()
    assert [(r["pos"], r["k"]) for r in big] == [(i, i) for i in range(10, 15)]
    with pytest.raises(ValueError):
        ordinal.row_range(df, "k", 5, 2)


def test_row_range_ties_keep_scan_order(spark):
    # the order column is one value: positions follow the scan, whatever the slice's length
    df = spark.range(0, 40, numPartitions=4).selectExpr("id AS k", "0 AS o")
    out = ordinal.row_range(df, "o", 5, 10)
    assert sorted(r["k"] for r in out.collect()) == [5, 6, 7, 8, 9]
    long = ordinal.row_range(df, "o", 5, 10**12)
    assert sorted(r["k"] for r in long.collect()) == list(range(5, 40))


@pytest.mark.parametrize(
    "n,t,k",
    [(0, 10000, 0), (1, 10000, 0), (10000, 10000, 0), (10001, 10000, 1), (19998, 10000, 1), (20000, 10000, 2), (60000, 10000, 3)],
)
def test_split_plan(n, t, k):
    assert split.split_plan(n, t) == k  # D4, D5


def test_split_bounds_sizes():
    b = split.split_bounds(60000, 3)
    assert [hi - lo for _, lo, hi in b] == [7498, 7500, 7499, 7502, 7498, 7501, 7500, 7502]
    for n in range(0, 5000, 97):
        for t in (20, 100, 1000):
            k = split.split_plan(n, t)
            parts = split.split_bounds(n, k)
            assert sum(hi - lo for _, lo, hi in parts) == n
            assert all(hi - lo <= t for _, lo, hi in parts)


def test_part_names():
    assert split.part_names("b", 2) == ["b_split__001.csv", "b_split__002.csv", "b_split__003.csv", "b_split__004.csv"]
    assert split.part_name("b", 1000) == "b_split__1000.csv"
    with pytest.raises(ValueError):
        split.part_name("b", 0)
    with pytest.raises(ValueError):
        split.split_plan(10**9, 10)


def test_split_plan_has_no_cap(spark):
    sizes = [5_000_000, 6_000_000, 12_000_000, 10**9, 10**15]
    df = spark.createDataFrame([(n,) for n in sizes], "n long").select("n", split.split_plan_col("n", 10_000).alias("k"))
    assert {r["n"]: r["k"] for r in df.collect()} == {n: split.split_plan(n, 10_000) for n in sizes}
    rows = spark.range(0, 5000).select(F.col("id"), split.part_of("id", 5000, 11).alias("part")).groupBy("part").agg(F.min("id").alias("lo"), F.count("*").alias("n")).collect()
    want = {p: (lo, hi - lo) for p, lo, hi in split.split_bounds(5000, 11) if hi > lo}
    assert {r["part"]: (r["lo"], r["n"]) for r in rows} == want and max(want) > 999


def test_file_ordinal_needs_no_sort(spark, tmp_path):
    from tablewright.sources import delimited as D

    for name, n in (("a", 3000), ("b", 10), ("c", 1)):  # splits of unequal length
        (tmp_path / f"{name}.csv").write_text("id\n" + "".join(f"{name}{i}\n" for i in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = ordinal.with_ordinal(D.read_delimited(spark, str(tmp_path), file_order=True), D.FILE_ORDER, "pos")
        assert "rangepartitioning" not in df._jdf.queryExecution().executedPlan().toString()
        got = {r["pos"]: r["id"] for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = [f"a{i}" for i in range(3000)] + [f"b{i}" for i in range(10)] + ["c0"]
    assert got == dict(enumerate(want))


def test_float_text_and_quoted_sets(spark):
    from tablewright.functions import cells

    texts = ["1e7", "100000005e-1", "1.2e-4", "123456789", "0.001", "1e16", "1.5e-5", "-2.5E10", "inf", "0.1", "12345678901234567e-20"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: r["x"] for r in df.select("i", cells.float_text(F.col("t").cast("double")).alias("x")).collect()}
    assert [got[i] for i in range(len(texts))] == [str(float(t)) for t in texts]
    sets = spark.createDataFrame([("'a,b','c'",), ("x, y",)], "t string").select(cells.parse_collection("t", "SS").alias("s")).collect()
    assert sorted(r["s"] for r in sets) == [["a,b", "c"], ["x", "y"]]


def test_assign_parts_contiguous(spark):
    df = spark.range(0, 2500).withColumnRenamed("id", "k")
    got = split.assign_parts(df, "k", 1000, ordinal_col="pos")
    rows = got.groupBy("part").agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"), F.count("*").alias("n")).orderBy("part").collect()
    bounds = split.split_bounds(2500, split.split_plan(2500, 1000))
    assert [(r["part"], r["lo"], r["hi"] + 1) for r in rows] == bounds


def test_apply_metadata_short_sidecar(spark):
    df = text_frame(spark, {"a": ["1", "2"], "b": ["x", "NA"], "c": ["1.5", "2"]}).drop("_o")
    out = items.apply_metadata(df, [("id", "N", "int64"), ("name", "S")])
    assert out.columns == ["id", "name"]
    assert dict(out.dtypes) == {"id": "bigint", "name": "string"}
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(1, "x"), (2, None)]


def test_tagged_cells_and_item(spark):
    df = text_frame(spark, {"k": ["1", "2"], "v": ["007", None], "s": ["a", ""]}).drop("_o")
    meta = [("k", "N", "int64"), ("v", "N", "int64"), ("s", "S", "object")]
    cells = sorted(tuple(r) for r in items.tagged_cells(df, meta).collect())
    assert cells == [("1", "k", "N", "1"), ("1", "s", "S", "a"), ("1", "v", "N", "7"), ("2", "k", "N", "2")]
    it = {r["k"]: r["item"] for r in items.tagged_item(df, meta).collect()}
    assert set(it["2"].keys()) == {"k"} and it["1"]["v"]["value"] == "7"


def test_parse_collections(spark):
    df = spark.createDataFrame([("'one','two','one'", '{"a": 1}', '["x","y"]', "1, 2.5, 1")], "ss string, m string, l string, ns string")
    r = df.select(
        parse_collection("ss", "SS").alias("ss"), parse_collection("m", "M").alias("m"),
        parse_collection("l", "L").alias("l"), parse_collection("ns", "NS").alias("ns"),
    ).first()
    assert sorted(r["ss"]) == ["one", "two"] and r["m"] == {"a": "1"} and r["l"] == ["x", "y"] and sorted(r["ns"]) == [1.0, 2.5]


def test_combine_parts_missing_column(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(2,)], "k int")
    out = sets.combine_parts([b, a], ["p2", "p1"], part_col="part").orderBy("k").collect()
    assert [tuple(r) for r in out] == [(1, "x", "p1"), (2, None, "p2")]


def test_upsert_last_row_wins_whole_item(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, s string, n int")
    batch = spark.createDataFrame([(2, "b1", 21, 1), (2, None, 22, 2), (3, "c", 30, 1)], "k int, s string, n int, o int")
    out = {r["k"]: tuple(r) for r in upsert.upsert(target, batch, "k", order="o").collect()}
    assert out == {1: (1, "a", 10), 2: (2, None, 22), 3: (3, "c", 30)}


def test_catalog_relations(spark):
    names = ["sales.csv", "metadata_sales.csv", "bulk_split__001.csv", "bulk_split__002.csv", "x y.csv", "ab.csv"]
    listing = spark.createDataFrame([(f"/in/{n}", 1) for n in names], "path string, length long")
    cat = catalog.catalog_from_paths(listing)
    assert sorted(r[0] for r in catalog.tables_to_load(cat).collect()) == ["ab", "bulk", "sales", "x y"]
    assert sorted(r["name"] for r in catalog.files_without_metadata(cat).collect()) == [
        "ab.csv", "bulk_split__001.csv", "bulk_split__002.csv", "x y.csv"]
    assert sorted(r[0] for r in catalog.invalid_table_names(cat).collect()) == ["ab", "x y"]
    existing = spark.createDataFrame([("bulk",)], "table_name string")
    assert [r[0] for r in catalog.name_collisions(cat, existing).collect()] == ["bulk"]
    assert sorted(r[0] for r in catalog.tables_to_create(cat, existing).collect()) == ["ab", "sales", "x y"]
    parts = {r["name"]: r["part"] for r in cat.collect()}
    assert parts["bulk_split__002.csv"] == 2 and parts["sales.csv"] is None
    assert spark.range(1).select(table_name_of(F.lit("t_split__012.csv"))).first()[0] == "t"


def test_ledger_report(spark):
    names = ["/in/aaa.csv", "/in/bbb.csv", "/in/ccc.csv"]
    cat = catalog.catalog_from_paths(spark.createDataFrame([(p, 1) for p in names], "path string, length long")).withColumn("n_rows", F.lit(5))
    led = spark.createDataFrame([("/in/aaa.csv", "done"), ("/in/bbb.csv", "failed")], "path string, status string")
    rep = {(r["table_name"], r["status"]): r["n_files"] for r in ledger.run_report(cat, led).collect()}
    assert rep == {("aaa", "done"): 1, ("bbb", "failed"): 1, ("ccc", "pending"): 1}
    assert [r["path"] for r in catalog.remaining_files(cat, led).orderBy("path").collect()] == ["/in/bbb.csv", "/in/ccc.csv"]


def test_preview_dtypes_and_options(spark):
    from tablewright.options import LoadOptions
    from tablewright.session import cluster_conf
    from tablewright.sources.delimited import dedupe_names, dtypes, preview

    df = spark.range(0, 50).withColumnRenamed("id", "k")
    assert preview(df, 3).count() == 3
    assert [tuple(r) for r in dtypes(df).collect()] == [("k", "bigint")]
    assert dedupe_names(["a", "a", "", "a"]) == ["a", "a.1", "Unnamed: 2", "a.2"]
    with pytest.raises(ValueError):
        LoadOptions(input_path="in/", output_path="out/", split=True, row_range=(0, 5))
    with pytest.raises(ValueError):
        LoadOptions(input_path="", output_path="out/")
    conf = cluster_conf(100 * (1 << 40), 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600


def test_ordinal_stores_agree_and_void_falls_back(spark):
    from pyspark.sql import functions as F

    df = spark.range(0, 500, numPartitions=4).select((F.col("id") % 7).alias("a"), F.col("id").alias("b"))
    got = {}
    for store in ("parquet", "checkpoint"):
        out, n = ordinal.with_ordinal_and_count(df, ["a", "b"], "pos", 4, True, store)
        assert int(n) == 500
        got[store] = sorted((r["pos"], r["a"], r["b"]) for r in out.collect())
    assert got["parquet"] == got["checkpoint"]
    assert [p for p, _, _ in got["parquet"]] == list(range(500))
    voided = df.withColumn("v", F.lit(None))
    out = ordinal.with_ordinal(voided, ["a", "b"], "pos", 4)
    assert sorted(r["pos"] for r in out.collect()) == list(range(500))


def test_ordinal_of_a_scan_needs_no_copy(spark, tmp_path):
    """Hot values, nulls, identical rows and long texts over several files."""
    rows = [(None if i % 7 == 0 else "hot" if i % 3 == 0 else f"{'long ' * 80}{i % 11}", float("nan") if i % 13 == 0 else -0.5 * (i % 5), i % 2 == 0) for i in range(3000)]
    spark.createDataFrame(rows + rows[:500], "a string, b double, c boolean").repartition(4).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    for order in (["a"], None, ["b", "a"], [F.upper("a"), "c"]):
        out, n = ordinal.with_ordinal_and_count(df, order, "n", 6)
        assert int(n) == 3500 and n.in_order
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "tw-scratch" not in plan and plan.count("Exchange") == 1
        got = out.orderBy("n").collect()
        assert [r["n"] for r in got] == list(range(3500))
        keys = df.columns if order is None else order
        want = df.orderBy(*keys).select(*df.columns).collect()
        only = [k for k in keys if isinstance(k, str)]
        assert [repr([r[k] for k in only]) for r in got] == [repr([r[k] for k in only]) for r in want]
    sizes = [r[0] for r in ordinal.with_ordinal(df, ["a"], "n", 6).groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert max(sizes) < 2 * 3500 / 6 + 300  # a hot value is split
    desc, n = ordinal.with_ordinal_and_count(df, [F.desc("b")], "n", 6)
    assert not n.in_order and desc.count() == 3500


def test_row_range_reads_little_more_than_the_slice(spark, tmp_path):
    spark.range(200_000).selectExpr("(id * 7919) % 200000 AS k", "id AS v").repartition(5).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    out = ordinal.row_range(df, "k", 120_000, 120_050, "n", 8)
    assert [(r["k"], r["n"]) for r in out.orderBy("n").collect()] == [(i, i) for i in range(120_000, 120_050)]
    plan = out._jdf.queryExecution()
    assert "GreaterThanOrEqual(k" in plan.executedPlan().toString()  # the scan skips the rest
    low = max(int(x) for x in re.findall(r"k#\d+L >= (\d+)", plan.optimizedPlan().toString()))
    high = min(int(x) for x in re.findall(r"k#\d+L <= (\d+)", plan.optimizedPlan().toString()))
    assert low <= 120_000 and high >= 120_049 and high - low <= 12_000
    assert ordinal.row_range(df, "k", 300_000, 300_010).count() == 0 and ordinal.row_range(df, "k", 199_990, 10**9).count() == 10


def test_part_of_takes_whole_batches(spark):
    """Parts as the list of bounds has them, also with a plan per row, and no fold of steps for each row."""
    from tablewright.operators import split

    for n, k in ((5000, 11), (7, 3), (1003, 5), (1, 0)):
        got = {r["id"]: r["part"] for r in spark.range(n).withColumn("part", split.part_of("id", n, k)).collect()}
        assert got == {i: p for p, lo, hi in split.split_bounds(n, k) for i in range(lo, hi)}
    rows = spark.createDataFrame([(i, n, k) for n, k in ((100, 3), (37, 0), (64, 2)) for i in range(n)], "o long, n long, k int")
    out = rows.withColumn("part", split.part_of("o", F.col("n"), F.col("k")))
    assert "lambda" not in out._jdf.queryExecution().optimizedPlan().toString()
    for r in out.collect():
        assert next(p for p, lo, hi in split.split_bounds(r["n"], r["k"]) if lo <= r["o"] < hi) == r["part"]
