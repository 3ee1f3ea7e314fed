"""Sources, sinks, flows and streaming: O-01, O-02, O-04, O-35, O-44, O-60 … O-65, O-73."""

import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

from tablewright.operators import profile
from tablewright.options import LoadOptions
from tablewright.plans import folder
from tablewright.sinks import ledger, tables
from tablewright.sources import delimited as D
from tablewright.streaming.ingest import ingest_stream


def _write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)


def test_quotes_multiline_and_names(spark, tmp_dir):
    p = f"{tmp_dir}/q.csv"
    _write(p, 'a,a,b\n"x""y,1",2,"line1\nline2"\n3,,NA\n')
    df = D.read_delimited(spark, p, multi_line=True)
    assert df.columns == ["a", "a.1", "b"]
    rows = [tuple(r) for r in df.collect()]
    assert rows[0] == ('x"y,1', "2", "line1\nline2")
    assert rows[1] == ("3", None, "NA")
    tsv = f"{tmp_dir}/t.tsv"
    _write(tsv, "a\tb\n1\t2\n")
    assert [tuple(r) for r in D.read_delimited(spark, tsv, sep="\t").collect()] == [("1", "2")]


def test_encoding_choice(spark, tmp_dir):
    _write(f"{tmp_dir}/enc/u.csv", "k,v\n1,café\n", "utf-8")
    _write(f"{tmp_dir}/enc/l.csv", "k,v\n2,café\n", "latin-1")
    enc = {os.path.basename(r["path"]): r["encoding"] for r in D.choose_encoding(spark, f"{tmp_dir}/enc").collect()}
    assert enc == {"u.csv": "UTF-8", "l.csv": "ISO-8859-1"}
    df = D.read_with_encodings(spark, [f"{tmp_dir}/enc/u.csv", f"{tmp_dir}/enc/l.csv"])
    assert sorted(r["v"] for r in df.collect()) == ["café", "café"]


def test_metadata_roundtrip(spark, tmp_dir):
    p = f"{tmp_dir}/salary.csv"
    _write(p, "row_number,Years_Experience,Salary\n1,1.1,39343\n2,1.1,46205\n3,2.0,37731\n")
    df = D.read_delimited(spark, p, file_order=True)
    meta = profile.profile(df, order=[F.col(c) for c in D.FILE_ORDER], columns=["row_number", "Years_Experience", "Salary"])
    tables.write_metadata(meta, f"{tmp_dir}/metadata_salary.csv")
    assert os.path.isfile(f"{tmp_dir}/metadata_salary.csv")  # the catalogue lists it
    back = D.read_metadata(spark, f"{tmp_dir}/metadata_salary.csv")
    rows = [(r["column_name"], r["AWS_column_dtype"], r["pandas_column_dtype"], r["duplicate_data_flag_list"]) for r in back.orderBy("column_index").collect()]
    assert rows == [("row_number", "N", "int64", "false"), ("Years_Experience", "N", "float64", "true"), ("Salary", "N", "int64", "false")]
    minimal = f"{tmp_dir}/metadata_min.csv"
    _write(minimal, "column_name,AWS_column_dtype,\nrow_number,N,\nSalary,N\n")
    assert [r["column_name"] for r in D.read_metadata(spark, minimal).orderBy("column_index").collect()] == ["row_number", "Salary"]


def test_upsert_table_swap_is_idempotent(spark, tmp_dir):
    path = f"{tmp_dir}/tbl"
    b1 = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k long, v string, o int")
    tables.upsert_table(spark, path, b1, "k", order="o")
    b2 = spark.createDataFrame([(2, "b2", 1), (2, "b3", 2), (3, "c", 1)], "k long, v string, o int")
    tables.upsert_table(spark, path, b2, "k", order="o")
    tables.upsert_table(spark, path, b2, "k", order="o")  # a retried batch
    got = sorted(tuple(r) for r in tables.read_table(spark, path).collect())
    assert got == [(1, "a", 1), (2, "b3", 2), (3, "c", 1)]  # the order column is data too


def test_write_parts(spark, tmp_dir):
    from tablewright.operators.split import write_parts

    df = spark.range(0, 2500).withColumnRenamed("id", "k")
    from tablewright.operators.split import split_bounds

    parts = write_parts(df, f"{tmp_dir}/parts", 1000, order="k", table="nums").collect()
    names = [f"nums_split__00{i}.csv" for i in (1, 2, 3, 4)]
    assert [p["name"] for p in parts] == names
    rows = [sum(([int(r["k"]) for r in D.read_delimited(spark, p["path"]).collect()] for p in parts if p["name"] == n), []) for n in names]
    assert [len(r) for r in rows] == [hi - lo for _, lo, hi in split_bounds(2500, 2)] and max(map(len, rows)) <= 1000
    assert sum(rows, []) == list(range(2500))
    # a call that stopped before its list leaves nothing that is read; the next one goes through
    shutil.rmtree(f"{tmp_dir}/parts/_parts")
    again = write_parts(df, f"{tmp_dir}/parts", 1000, order="k", table="nums").collect()
    assert len(again) == len(parts) and not {p["path"] for p in again} & {p["path"] for p in parts}


def test_stream_ingest_two_runs(spark, tmp_dir):
    land, arch = f"{tmp_dir}/landing", f"{tmp_dir}/archive"
    _write(f"{land}/a.csv", "k,v\n1,x\n2,y\n")
    _write(f"{land}/b.csv", "k,v\n2,z\n")
    args = dict(names=["k", "v"], table_path=f"{tmp_dir}/t", checkpoint=f"{tmp_dir}/ck", ledger_path=f"{tmp_dir}/led",
                meta=[("k", "N", "int64"), ("v", "S")], archive_dir=arch)
    ingest_stream(spark, land, **args)
    _write(f"{land}/c.csv", "k,v\n3,w\n1,q\n")
    ingest_stream(spark, land, **args)
    got = sorted(tuple(r) for r in tables.read_table(spark, f"{tmp_dir}/t").collect())
    assert got[0][0] == 1 and got[0][1] == "q" and len(got) == 3
    files = ledger.read_ledger(spark, f"{tmp_dir}/led").select("path").distinct().count()
    assert files == 3  # each file delivered once


def test_load_folder_flow(spark, tmp_dir):
    inp, out = f"{tmp_dir}/in", f"{tmp_dir}/wh"
    _write(f"{inp}/people_split__001.csv", "id,name,score\n1,ann,1.5\n2,bob,\n")
    _write(f"{inp}/people_split__002.csv", "id,name,score\n3,cy,2\n2,bo,3\n")
    _write(f"{inp}/orders.csv", "oid,amount\n10,5\n11,6\n")
    _write(f"{inp}/notes.txt", "ignored")
    rep = folder.load_folder(spark, LoadOptions(input_path=inp, output_path=out))
    r = {(x["table_name"], x["status"]): x["n_files"] for x in rep.collect()}
    assert r == {("people", "done"): 2, ("orders", "done"): 1}
    people = sorted(tuple(x) for x in tables.read_table(spark, f"{out}/people").collect())
    assert people == [(1, "ann", 1.5), (2, "bo", 3.0), (3, "cy", 2.0)]
    # a rerun loads nothing new
    rep2 = folder.load_folder(spark, LoadOptions(input_path=inp, output_path=out, append=True))
    assert {x["status"] for x in rep2.collect()} == {"done"}


def test_key_gate_refuses_duplicates(spark, tmp_dir):
    inp, out = f"{tmp_dir}/in2", f"{tmp_dir}/wh2"
    _write(f"{inp}/dups.csv", "id,v\n1,a\n1,b\n")
    rep = folder.load_folder(spark, LoadOptions(input_path=inp, output_path=out))
    assert [x["status"] for x in rep.collect()] == ["failed"]


def test_profile_folder_and_add_key(spark, tmp_dir):
    inp = f"{tmp_dir}/in3"
    _write(f"{inp}/sm_salary6.csv", "YearsExperience,Salary\n1.1,39343\n1.3,46205\n")
    prof = folder.profile_folder(spark, inp)
    rows = {r["column_name"]: r for r in prof.collect()}
    assert rows["Salary"]["pandas_column_dtype"] == "int64" and rows["Salary"]["example_item_list"] == "39343"
    assert rows["YearsExperience"]["key_warnings"] == ""
    folder.add_key_to_file(spark, f"{inp}/sm_salary6.csv", f"{tmp_dir}/keyed", name="id", prefix="Test")
    back = spark.read.option("header", True).csv(f"{tmp_dir}/keyed").orderBy("id").collect()
    assert [(r["id"], r["Salary"]) for r in back] == [("Test_1", "39343"), ("Test_2", "46205")]


def test_profile_folder_groups_files_by_header(spark, tmp_dir):
    inp = f"{tmp_dir}/in4"
    _write(f"{inp}/day1.csv", "id,v\n1,a\n2,b\n")
    _write(f"{inp}/day2.csv", "id,v\n3,c\n3,d\n")
    _write(f"{inp}/other.csv", "k,flag\nx,True\n")
    groups = D.header_groups(spark, inp)
    assert sorted(len(g) for g in groups) == [1, 2]
    prof = folder.profile_folder(spark, inp)
    rows = {(r["table_name"], r["column_name"]): r for r in prof.collect()}
    assert rows[("day1", "id")]["key_warnings"] == "" and rows[("day2", "id")]["key_warnings"] == "duplicate_data_flag"
    assert rows[("other", "flag")]["pandas_column_dtype"] == "bool"


def test_file_facts_one_scan_headers_and_encodings(spark, tmp_dir):
    inp = f"{tmp_dir}/facts"
    _write(f"{inp}/a.csv", "id,v\n1,café\n", "utf-8")
    _write(f"{inp}/b.csv", "id,v\n2,café\n", "latin-1")
    _write(f"{inp}/c.csv", "k,w\r\nx,y\r\n")
    # a file cut into several splits: only its first split's first line counts
    _write(f"{inp}/d.csv", "id,v\n" + "".join(f"{i},row{i}\n" for i in range(20000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        facts = {os.path.basename(r["path"]): (r["header"], r["encoding"]) for r in D.file_facts(spark, inp).collect()}
        groups, enc = D.header_groups(spark, inp, with_encodings=True)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert facts == {
        "a.csv": ("id,v", "UTF-8"),
        "b.csv": ("id,v", "ISO-8859-1"),
        "c.csv": ("k,w", "UTF-8"),
        "d.csv": ("id,v", "UTF-8"),
    }
    assert sorted(sorted(os.path.basename(p) for p in g) for g in groups) == [["a.csv", "b.csv", "d.csv"], ["c.csv"]]
    df = D.read_with_encodings(spark, groups[0], encodings=enc)
    assert sorted(r["v"] for r in df.filter("v LIKE 'caf%'").collect()) == ["café", "café"]


def test_upsert_rewrites_only_touched_buckets(spark, tmp_dir):
    path = f"{tmp_dir}/bk"
    first = spark.range(0, 1000).selectExpr("id AS k", "'v0' AS v")
    tables.upsert_table(spark, path, first, "k", n_buckets=16)
    before = tables._manifest(spark, path)["folders"]
    assert len(before) == 16
    upd = spark.createDataFrame([(5, "v1")], "k long, v string")
    assert tables.upsert_table(spark, path, upd, "k") == 1
    after = tables._manifest(spark, path)["folders"]
    assert len([b for b in after if after[b] != before[b]]) == 1
    got = {r["k"]: r["v"] for r in tables.read_table(spark, path).collect()}
    assert len(got) == 1000 and got[5] == "v1" and got[6] == "v0"
    # one file per bucket
    assert len(tables.read_table(spark, path).inputFiles()) == 16


def test_buckets_grow_and_old_versions_go(spark, tmp_dir):
    path = f"{tmp_dir}/grow"
    for i in range(6):
        tables.upsert_table(spark, path, spark.range(i * 100, i * 100 + 100).withColumnRenamed("id", "k"), "k", rows_per_bucket=100)
    held = tables._manifest(spark, path)
    assert held["buckets"] == 8 and tables.read_table(spark, path).count() == 600 and sum(held["rows"].values()) == 600
    assert tables._versions(spark, path) == [5, 6]


def test_a_large_batch_after_a_small_one_is_many_buckets(spark, tmp_dir):
    path = f"{tmp_dir}/sudden"
    tables.upsert_table(spark, path, spark.range(5).withColumnRenamed("id", "k"), "k", rows_per_bucket=1000)
    tables.upsert_table(spark, path, spark.range(100_000).withColumnRenamed("id", "k"), "k", rows_per_bucket=1000)
    held = tables._manifest(spark, path)
    assert held["buckets"] == 128 and len(held["folders"]) == 128 and sum(held["rows"].values()) == 100_000


def test_a_reader_keeps_the_version_it_began_with(spark, tmp_dir):
    path = f"{tmp_dir}/versions"
    tables.upsert_table(spark, path, spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string"), "k", n_buckets=2)
    reader = tables.read_table(spark, path)
    tables.upsert_table(spark, path, spark.createDataFrame([(1, "new"), (3, "c")], "k long, v string"), "k")
    assert sorted(tuple(r) for r in reader.collect()) == [(1, "a"), (2, "b")]
    assert sorted(tuple(r) for r in tables.read_table(spark, path).collect()) == [(1, "new"), (2, "b"), (3, "c")]


def test_put_widens_adds_and_refuses(spark, tmp_dir):
    import pytest

    path = f"{tmp_dir}/types"
    tables.upsert_table(spark, path, spark.createDataFrame([(1, 5, 1)], "k long, v long, ver int"), "k", order="ver")
    assert tables.read_table(spark, path).columns == ["k", "v", "ver"]  # an order column is data too
    tables.upsert_table(spark, path, spark.createDataFrame([(2, 2.7, "x")], "k long, v double, extra string"), "k")
    got = sorted((r["k"], r["v"], r["extra"]) for r in tables.read_table(spark, path).collect())
    assert got == [(1, 5.0, None), (2, 2.7, "x")]
    with pytest.raises(ValueError):
        tables.upsert_table(spark, path, spark.createDataFrame([(3, "text")], "k long, v string"), "k")
    with pytest.raises(Exception):  # 2**53 + 1 is not exact as a double
        tables.upsert_table(spark, path, spark.createDataFrame([(3, 9007199254740993)], "k long, v long"), "k")
    assert tables.read_table(spark, path).count() == 2


def test_load_fails_misfit_and_ragged_files_with_counts(spark, tmp_dir):
    inp, out = f"{tmp_dir}/in 6", f"{tmp_dir}/wh6"
    _write(f"{inp}/ragged.csv", "id,a\n1,2\n2,3,4\n")
    _write(f"{inp}/short.csv", "id,a\n1,2\n2\n")  # missing cells are allowed
    _write(f"{inp}/misfit.csv", "id,a\n1,2.5\n2,abc\n3,4\n")
    _write(f"{inp}/metadata_misfit.csv", "column_name,AWS_column_dtype,pandas_column_dtype\nid,N,int64\na,N,int64\n")
    _write(f"{inp}/empty.csv", "id,a\n")
    rep = {r["table_name"]: r["status"] for r in folder.load_folder(spark, LoadOptions(input_path=inp, output_path=out)).collect()}
    assert rep == {"ragged": "failed", "short": "done", "misfit": "failed", "empty": "done"}
    why = {r["table_name"]: r["message"] for r in ledger.read_ledger(spark, f"{out}/_ledger").collect()}
    assert why["ragged"].startswith("1 rows longer") and "2 cells" in why["misfit"]
    assert tables.read_table(spark, f"{out}/short").count() == 2 and tables.read_table(spark, f"{out}/empty").count() == 0


def test_each_part_uses_its_own_sidecar_and_split_load(spark, tmp_dir):
    inp, out = f"{tmp_dir}/in7", f"{tmp_dir}/wh7"
    _write(f"{inp}/people_split__001.csv", "id,n\n1,5\n")
    _write(f"{inp}/people_split__002.csv", "key,label\n2,6\n")
    _write(f"{inp}/metadata_people_split__002.csv", "column_name,AWS_column_dtype,pandas_column_dtype\nid,N,int64\nn,N,int64\n")
    folder.load_folder(spark, LoadOptions(input_path=inp, output_path=out))
    assert sorted(tuple(r) for r in tables.read_table(spark, f"{out}/people").collect()) == [(1, 5), (2, 6)]
    _write(f"{tmp_dir}/in8/big.csv", "id,v\n" + "".join(f"{i},x{i}\n" for i in range(50)))
    rep = folder.load_folder(spark, LoadOptions(input_path=f"{tmp_dir}/in8", output_path=f"{tmp_dir}/wh8", split=True, max_rows_per_part=20))
    assert [(r["status"], r["n_rows"]) for r in rep.collect()] == [("done", 50)]
    assert tables.read_table(spark, f"{tmp_dir}/wh8/big").count() == 50


def test_quoted_line_breaks_load(spark, tmp_dir):
    _write(f"{tmp_dir}/in9/notes.csv", 'id,t\n1,"a\nb"\n2,"c"\n')
    opts = LoadOptions(input_path=f"{tmp_dir}/in9", output_path=f"{tmp_dir}/wh9", multi_line=True)
    folder.load_folder(spark, opts)
    assert sorted(tuple(r) for r in tables.read_table(spark, f"{tmp_dir}/wh9/notes").collect()) == [(1, "a\nb"), (2, "c")]


def test_write_profiles_and_split_folder(spark, tmp_dir):
    inp = f"{tmp_dir}/in5"
    _write(f"{inp}/alpha.csv", "id,v\n" + "".join(f"{i},x{i}\n" for i in range(25)))
    _write(f"{inp}/beta.csv", "id,w\n1,2\n")
    _write(f"{inp}/metadata_beta.csv", "column_name,AWS_column_dtype\nid,N\nw,N\n")
    written = folder.write_profiles(spark, inp, f"{tmp_dir}/side")
    assert [w.rsplit("/", 1)[-1] for w in written] == ["metadata_alpha.csv"]  # beta already has one
    side = D.read_metadata(spark, written[0]).orderBy("column_index").collect()
    assert [(r["column_name"], r["AWS_column_dtype"]) for r in side] == [("id", "N"), ("v", "S")]
    listed = folder.split_folder(spark, inp, f"{tmp_dir}/parts", max_rows=10).where("table_name = 'alpha'").collect()
    parts = [[int(r["id"]) for r in D.read_delimited(spark, p["path"]).collect()] for p in listed]
    assert max(map(len, parts)) <= 10 and sum(parts, []) == list(range(25))  # rows stay in order


def test_upsert_refuses_foreign_folder(spark, tmp_dir):
    import pytest

    spark.range(3).write.parquet(f"{tmp_dir}/plain")
    with pytest.raises(ValueError):
        tables.upsert_table(spark, f"{tmp_dir}/plain", spark.range(1).withColumnRenamed("id", "k"), "k")


def test_union_table_and_load_new_refuses_existing(spark, tmp_dir):
    import pytest

    from tablewright.operators import sets

    _write(f"{tmp_dir}/u/t_split__001.csv", "id,v\n1,a\n")
    _write(f"{tmp_dir}/u/t_split__002.csv", "id,v\n2,b\n3,c\n")
    whole = sets.union_table(spark, [f"{tmp_dir}/u/t_split__001.csv", f"{tmp_dir}/u/t_split__002.csv"], D.read_delimited)
    assert sorted((r["id"], r["v"]) for r in whole.collect()) == [("1", "a"), ("2", "b"), ("3", "c")]
    tables.load_new(whole, f"{tmp_dir}/new_t")
    assert spark.read.parquet(f"{tmp_dir}/new_t").count() == 3
    with pytest.raises(Exception):
        tables.load_new(whole, f"{tmp_dir}/new_t")


def test_put_resumes_after_a_failed_driver(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/resume"
    rows = spark.range(0, 200).selectExpr("id AS k", "concat('v', id) AS v")
    tables.upsert_table(spark, path, rows, "k", n_buckets=4)
    real = tables._publish

    def lost(*a):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(tables, "_publish", lost)
    try:
        tables.upsert_table(spark, path, spark.createDataFrame([(0, "new")], "k long, v string"), "k")
    except RuntimeError:
        pass
    assert {r["v"] for r in tables.read_table(spark, path).where("k = 0").collect()} == {"v0"}  # nothing was published
    monkeypatch.setattr(tables, "_publish", real)
    tables.upsert_table(spark, path, spark.createDataFrame([(0, "new")], "k long, v string"), "k")  # the rerun
    back = {r["k"]: r["v"] for r in tables.read_table(spark, path).collect()}
    assert len(back) == 200 and back[0] == "new" and back[199] == "v199"


def _statuses(report):
    return {(r["table_name"], r["status"]): (r["n_files"], r["n_rows"]) for r in report.collect()}


def test_split_load_reads_each_file_by_its_header(spark, tmp_dir):
    inp, out = f"{tmp_dir}/in10", f"{tmp_dir}/wh10"
    _write(f"{inp}/tab_split__001.csv", "id,a,b\n" + "".join(f"{i},{i * 10},x{i} \n" for i in range(30)))
    _write(f"{inp}/tab_split__002.csv", "id,b,a\n" + "".join(f"{i},\" y{i}\",{i * 10}\n" for i in range(30, 40)))
    _write(f"{inp}/tab_split__003.csv", "id,a\n1,2\n2,3,4\n")  # a record longer than its header
    _write(f"{inp}/unused.csv", "k,v\n")
    _write(f"{inp}/side.csv", "x,y\n1,5\n2,6\n3,7\n")
    _write(f"{inp}/metadata_side.csv", "column_name,AWS_column_dtype\nkey,N\nlabel,S\n")
    opts = LoadOptions(input_path=inp, output_path=out, split=True, max_rows_per_part=8)
    rep = _statuses(folder.load_folder(spark, opts))
    assert rep[("tab", "failed")][0] == 1 and rep[("unused", "done")] == (1, 0) and rep[("tab", "done")][1] == 40 and rep[("side", "done")][1] == 3
    got = sorted((r["id"], r["a"], r["b"]) for r in tables.read_table(spark, f"{out}/tab").collect())
    assert got == [(i, i * 10, f"x{i} " if i < 30 else f" y{i}") for i in range(40)]  # blanks in cells stay
    assert sorted(tuple(r) for r in tables.read_table(spark, f"{out}/side").collect()) == [(1, "5"), (2, "6"), (3, "7")]
    why = {os.path.basename(r["path"]): r["message"] for r in ledger.read_ledger(spark, f"{out}/_ledger").where("status = 'failed'").collect()}
    assert why == {"tab_split__003.csv": "1 rows longer than the header"}
    # a file that comes later is split and loaded by the next run, a mended one too
    _write(f"{inp}/tab_split__003.csv", "id,a\n100,2\n")
    _write(f"{inp}/tab_split__004.csv", "b,id\n" + "".join(f"z{i},{i}\n" for i in range(36, 50)))
    rep = _statuses(folder.load_folder(spark, opts))
    assert not [k for k in rep if k[1] != "done"] and rep[("tab", "done")][1] == 55
    got = {r["id"]: (r["a"], r["b"]) for r in tables.read_table(spark, f"{out}/tab").collect()}
    assert len(got) == 51 and got[36] == (None, "z36") and got[35] == (350, " y35") and got[100] == (2, None)  # the later file's rows win


def test_a_split_that_stopped_is_done_again(spark, tmp_dir, monkeypatch):
    inp, out = f"{tmp_dir}/in11", f"{tmp_dir}/wh11"
    _write(f"{inp}/first.csv", "id,v\n" + "".join(f"{i},a{i}\n" for i in range(25)))
    _write(f"{inp}/second.csv", "id,v\n" + "".join(f"{i},b{i}\n" for i in range(25)))
    opts = LoadOptions(input_path=inp, output_path=out, split=True, max_rows_per_part=10)
    real, calls = folder.split.list_parts, []

    def lost(spark, where, table, *more):
        calls.append(table)
        if table == "second":
            raise RuntimeError("driver lost")
        return real(spark, where, table, *more)

    monkeypatch.setattr(folder.split, "list_parts", lost)
    rep = _statuses(folder.load_folder(spark, opts))
    assert rep[("first", "done")][1] == 25 and ("second", "failed") in rep
    monkeypatch.setattr(folder.split, "list_parts", real)
    rep = _statuses(folder.load_folder(spark, opts))
    assert rep == {("first", "done"): rep[("first", "done")], ("second", "done"): (4, 25)}
    assert sorted(r["v"] for r in tables.read_table(spark, f"{out}/second").collect()) == sorted(f"b{i}" for i in range(25))
    assert sorted(calls) == ["first", "second"]  # the second run did not split a again


def test_tables_are_profiled_by_header(spark, tmp_dir):
    inp = f"{tmp_dir}/in12"
    _write(f"{inp}/t_split__001.csv", "id,a,b\n1,x,10\n")
    _write(f"{inp}/t_split__002.csv", "id,b,a\n2,20,y\n3,-,z\n")
    prof = {r["column_name"]: r for r in folder.profile_folder(spark, inp, per_file=False, na_tokens=("-",)).collect()}
    assert {c: r["pandas_column_dtype"] for c, r in prof.items()} == {"id": "int64", "a": "object", "b": "float64"}
    assert prof["b"]["missing_data_flag_list"] and prof["a"]["example_item_list"] == "x"
    written = folder.write_profiles(spark, inp, f"{tmp_dir}/side12", na_tokens=("-",))
    side = D.read_metadata(spark, written[1]).orderBy("column_index").collect()
    assert [(r["column_name"], r["AWS_column_dtype"]) for r in side] == [("id", "N"), ("b", "N"), ("a", "S")]


def test_headers_of_two_lines(spark, tmp_dir):
    inp = f"{tmp_dir}/in13"
    _write(f"{inp}/t_split__001.csv", 'id,"two\nlines",c\n1,a,x\n')
    _write(f"{inp}/t_split__002.csv", 'id,"two\nother",c\n2,b,"y\ny"\n')
    _write(f"{inp}/t_split__003.csv", 'c,id,"two\nlines"\nz,3,c\n')
    df = D.read_by_header(spark, inp, multi_line=True)
    assert df.columns == ["id", "two\nlines", "c", "two\nother"]
    assert sorted(tuple(r) for r in df.collect()) == [("1", "a", "x", None), ("2", None, "y\ny", "b"), ("3", "c", "z", None)]


def test_a_load_reads_its_text_three_times(spark, tmp_dir, monkeypatch):
    """Headers and encodings; the gate with the types; the put."""
    _write(f"{tmp_dir}/in14/tab.csv", "id,a\n" + "".join(f"{i},{i}.5\n" for i in range(50)))
    listener, scans = [], []
    real = profile.column_stats

    def counted(df, *a, **k):
        out = real(df, *a, **k)
        listener.append(out._jdf.queryExecution().executedPlan().toString().count("FileScan csv"))
        return out

    monkeypatch.setattr(folder.profile, "column_stats", counted)
    put = tables.upsert_table
    monkeypatch.setattr(folder.tables, "upsert_table", lambda s, p, frame, *a, **k: (scans.append(frame._jdf.queryExecution().executedPlan().toString().count("FileScan csv")), put(s, p, frame, *a, **k))[1])
    folder.load_folder(spark, LoadOptions(input_path=f"{tmp_dir}/in14", output_path=f"{tmp_dir}/wh14"))
    assert listener == [1] and scans == [1]  # beside the pass of file_facts
    assert tables.read_table(spark, f"{tmp_dir}/wh14/tab").count() == 50


def test_whole_numbers_that_doubles_round_fail_their_file(spark, tmp_dir):
    inp, out = f"{tmp_dir}/in15", f"{tmp_dir}/wh15"
    _write(f"{inp}/tab_split__001.csv", "id,a\n1,9007199254740993\n")
    _write(f"{inp}/tab_split__002.csv", "id,a\n2,0.5\n3,\n")
    _write(f"{inp}/big.csv", "id,a\n1,9007199254740993\n")
    rep = _statuses(folder.load_folder(spark, LoadOptions(input_path=inp, output_path=out)))
    assert rep == {("tab", "failed"): (1, None), ("tab", "done"): (1, 2), ("big", "done"): (1, 1)}
    assert [tuple(r) for r in tables.read_table(spark, f"{out}/big").collect()] == [(1, 9007199254740993)]


def test_stream_checks_each_file(spark, tmp_dir):
    land = f"{tmp_dir}/landing"
    _write(f"{land}/a.csv", "k,a,b\n1,10,x\n2,20,y\n")
    _write(f"{land}/b.csv", "k,b,a\n3,z,30\n")  # another order
    _write(f"{land}/c.csv", "k,a,b\n4,5,6,7\n")  # a record longer than the header
    _write(f"{land}/d.csv", "k,a\n5,1\n")  # a column is not there
    _write(f"{land}/e.csv", "k,a,b\n6,1,p\n6,2,q\n")  # a key twice
    _write(f"{land}/f.csv", "k,a,b\n7,abc,p\n")  # not a number
    _write(f"{land}/g.csv", "k,a,b\n8,80,café\n", "latin-1")
    _write(f"{land}/h.csv", "")  # no bytes: the source does not deliver it
    _write(f"{land}/i.csv", "k,a,b\n")
    ingest_stream(spark, land, ["k", "a", "b"], f"{tmp_dir}/t", f"{tmp_dir}/ck", f"{tmp_dir}/led", meta=[("key", "N", "int64"), ("a", "N", None), ("b", "S")], max_files_per_trigger=4, archive_dir=f"{tmp_dir}/archive")
    got = sorted(tuple(r) for r in tables.read_table(spark, f"{tmp_dir}/t").collect())
    assert got == [(1, 10, "x"), (2, 20, "y"), (3, 30, "z"), (8, 80, "café")]
    log = {os.path.basename(r["path"])[0]: r for r in ledger.read_ledger(spark, f"{tmp_dir}/led").collect()}
    assert {k: r["status"] for k, r in log.items()} == {k: "done" if k in "abgi" else "failed" for k in "abcdefgi"}
    assert log["c"]["message"].startswith("1 rows longer") and "columns" in log["d"]["message"] and "duplicate" in log["e"]["message"]
    assert "1 cells" in log["f"]["message"] and log["b"]["n_rows"] == 1 and log["b"]["table_name"] == "b"


BITS = ["a", "é", "x y", ",", '"', "\n", "\n\n", '""', "12", "\t", "  ", ',"', "z" * 50, "\r\n"]


def test_records_with_line_breaks_are_read_by_many_tasks(spark, tmp_dir):
    import csv
    import random

    rng = random.Random(3)
    rows = [[str(i), *("".join(rng.choice(BITS) for _ in range(rng.randrange(8))) for _ in range(3))] for i in range(1500)]
    rows.insert(700, ["long", "\n".join(f"line {k}" for k in range(3000)), "b", "c"])  # over many blocks
    rows.insert(900, ["longer", ('say ""' * 25_000 + "\n") * 8, "b", "c"])
    rows.insert(1200, ["quotes", '"' * 9001, "b\n", "c"])
    for name, end in (("n", "\n"), ("rn", "\r\n")):
        path = f"{tmp_dir}/{name}.csv"
        with open(path, "w", newline="", encoding="utf-8") as f:
            out = csv.writer(f, lineterminator=end)
            out.writerow(["id", "two\nlines", "b", "c"])
            out.writerows(rows)
            f.write(end * 3 + 'open,"never\nclosed')
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "30000")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        for name in ("n", "rn"):
            df = D.read_delimited(spark, f"{tmp_dir}/{name}.csv", multi_line=True, file_order=True)
            assert df.columns[:4] == ["id", "two\nlines", "b", "c"] and df.rdd.getNumPartitions() > 20
            got = [[r[0], *(x or "" for x in r[1:4])] for r in df.orderBy(*D.FILE_ORDER).collect()]
            assert got == [*rows, ["open", "never\nclosed", "", ""]]
            from tablewright.operators.ordinal import with_ordinal

            numbered = with_ordinal(df, D.FILE_ORDER, "n").select("n", "id").orderBy("n").collect()
            assert [r["n"] for r in numbered] == list(range(len(rows) + 1)) and [r["id"] for r in numbered][:-1] == [r[0] for r in rows]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_stray_quotes_and_long_records_of_multi_line_files(spark, tmp_dir):
    path = f"{tmp_dir}/stray.csv"
    _write(path, 'id,a\n1,5" pipe\n2,"x"y"\n3,"p\nq",r,"s\nt"\n \n4,"u""v"\n')
    df = D.read_delimited(spark, path, multi_line=True, file_order=True, corrupt=True)
    plain = spark.read.option("header", True).option("escape", '"').option("multiLine", True).schema("id string, a string").csv(path)
    assert sorted(tuple(r)[:2] for r in df.collect()) == sorted(tuple(r) for r in plain.where("trim(id) <> ''").collect())
    ragged = D.read_by_header(spark, path, multi_line=True, ragged=True).where("_ragged").collect()
    assert [r["id"] for r in ragged] == ["3"]


def test_long_rows_make_more_buckets(spark, tmp_dir, monkeypatch):
    """A bucket is one task's, so it is bounded in bytes, not in rows alone; a bucket is still one file."""
    monkeypatch.setattr(tables, "BYTES_PER_BUCKET", 100_000)
    path = f"{tmp_dir}/t"
    rows = lambda a, b: spark.range(a, b).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 992).alias("text"))
    tables.upsert_table(spark, path, rows(0, 400), "k")
    held = tables._manifest(spark, path)
    assert held["buckets"] == 4 and sum(held["bytes"].values()) == pytest.approx(400_000, abs=4)
    assert all(len(glob.glob(f"{path}/{f}/*.parquet")) == 1 for f in held["folders"].values())
    tables.upsert_table(spark, path, rows(300, 1000), "k")
    held = tables._manifest(spark, path)
    assert held["buckets"] == 16 and tables.read_table(spark, path).select("k").distinct().count() == 1000
    tables.upsert_table(spark, path, spark.createDataFrame([(5, "new")], "k long, text string"), "k")
    assert tables._manifest(spark, path)["buckets"] == 16 and tables.read_table(spark, path).where("text = 'new'").count() == 1


def test_folder_load_bounds_buckets_by_file_length(spark, tmp_dir, monkeypatch):
    from tablewright.options import LoadOptions
    from tablewright.plans.folder import load_folder

    monkeypatch.setattr(tables, "BYTES_PER_BUCKET", 10_000)
    rows = spark.range(100).select("id", F.repeat(F.lit("x\n"), 250).alias("text"))
    tables.land_as_files(spark, rows, f"{tmp_dir}/landing", "notes")
    load_folder(spark, LoadOptions(input_path=f"{tmp_dir}/landing", output_path=f"{tmp_dir}/out", multi_line=True)).collect()
    assert tables._manifest(spark, f"{tmp_dir}/out/notes")["buckets"] >= 5
    assert tables.read_table(spark, f"{tmp_dir}/out/notes").where(F.length("text") == 500).count() == 100


def test_workers_take_lines_in_slices():
    import pyarrow as pa

    from tablewright.sources import records

    batch = pa.RecordBatch.from_pydict({"value": ["x" * (1 << 20)] * 40})
    parts = list(records.slices([batch, batch.slice(0, 0), batch.slice(0, 1)]))
    assert sum(len(p) for p in parts) == 41 and max(p.nbytes for p in parts) <= records.SLICE_BYTES + (1 << 20)


def test_landing_queries_use_more_than_one_task(spark, tmp_dir, monkeypatch):
    """The landed tables of these queries are not written by one task."""
    from tablewright.workloads import flow_queries as Q

    seen = []
    land = Q.land_as_files
    monkeypatch.setattr(Q, "land_as_files", lambda s, df, folder, name, **kw: seen.append(len(out := land(s, df, folder, name, **kw))) or out)
    d = spark.range(0, 400, 1, 4).select(F.col("id").alias("doc_id"), F.concat(F.lit('a "b"\n'), F.col("id")).alias("text"), F.lit("en").alias("lang"), F.lit("w").alias("source"), F.lit(5).cast("bigint").alias("n_chars"))
    d.write.parquet(f"{tmp_dir}/documents.parquet")
    got = Q.read_multiline_documents(spark, tmp_dir)
    assert seen[0] > 1 and sorted(got.collect()) == sorted(d.collect())
    o = spark.range(0, 2000, 1, 4).selectExpr("id AS o_orderkey", "id AS o_custkey", "'O' AS o_orderstatus", "1.5D AS o_totalprice", "timestamp_ntz'2020-01-01' AS o_orderdate", "'1' AS o_orderpriority")
    o.write.parquet(f"{tmp_dir}/orders.parquet")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert sorted(r[0] for r in Q.load_two_ranges_orders(spark, tmp_dir).collect()) == list(range(900))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert seen[1] > 1


def test_scanned_paths_are_spelled_as_listed(spark, tmp_dir):
    """Paths with and without characters that the scan's metadata encodes."""
    from tablewright.sources import delimited as D

    for name in ("plain+x", "a b+c%20d"):
        tables.land_as_files(spark, spark.range(2), tmp_dir, name)
    listed = {r["path"] for r in spark.read.format("binaryFile").load(f"{tmp_dir}/*.csv").select("path").collect()}
    assert {r[0] for r in D.read_delimited(spark, tmp_dir, names=["id"], file_order=True).select(D.FILE_COL).distinct().collect()} <= listed
