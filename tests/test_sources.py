"""Sanitiser rules, folder ingest and catalog on hand-made file layouts."""

import decimal
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tablewatch.plans.catalog import catalog_report, list_tables, list_views, run_sql
from tablewatch.sources.footers import schema_census
from tablewatch.sources.ingest import file_manifest, register_folders
from tablewatch.sources.sanitize import (TO_DECIMAL, TO_TIMESTAMP, plan_casts, sanitize,
                                         sanitize_summary)

BIG = 2**64 - 5


def write(path, table):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(table, path)


def counters_tree(root):
    t = pa.table({
        "timestamp": pa.array([1_700_000_000_000_000, 1_700_000_001_000_000], pa.uint64()),
        "in_octets": pa.array([BIG, None], pa.uint64()),
        "status": pa.array([1, 2], pa.uint8()),
        "nested": pa.array([{"u": 1}, {"u": 2}], pa.struct([("u", pa.uint64())])),
    })
    write(f"{root}/counters/a.parquet", t)
    dec = pa.table({"timestamp": pa.array([decimal.Decimal(1_700_000_000_000_000)],
                                          pa.decimal128(20, 0)),
                    "d17": pa.array([decimal.Decimal(5)], pa.decimal128(17, 0))})
    write(f"{root}/counters/sub/b.PRQ", dec)
    keep = pa.table({"timestamp": pa.array([decimal.Decimal("1.50")], pa.decimal128(20, 2)),
                     "x": pa.array([1], pa.int64())})
    write(f"{root}/other/c.prq", keep)
    with open(f"{root}/other/readme.txt", "w") as f:
        f.write("not parquet")


def test_plan_casts_rules(spark, tmp):
    counters_tree(tmp)
    plan = {(r["rel_dir"], r["column"]): (r["from_type"], r["to_type"])
            for r in plan_casts(schema_census(spark, tmp)).collect()}
    assert plan[("counters", "timestamp")] == ("uint64", TO_TIMESTAMP)
    assert plan[("counters", "in_octets")] == ("uint64", TO_DECIMAL)
    assert plan[("counters/sub", "timestamp")][1] == TO_TIMESTAMP
    assert ("counters", "status") not in plan and ("counters", "nested") not in plan
    assert ("counters/sub", "d17") not in plan and ("other", "timestamp") not in plan


def test_sanitize_writes_changed_files_and_refuses_overwrite(spark, tmp):
    src, out = f"{tmp}/in", f"{tmp}/out"
    counters_tree(src)
    dry = sanitize(spark, src, out, dry_run=True)
    assert dry.count() == 3 and not os.path.exists(out)
    with open(f"{src}/other/broken.parquet", "w") as f:
        f.write("not parquet")
    report = sanitize(spark, src, out)
    assert report.filter("written").count() == 3
    bad = report.filter("error IS NOT NULL").collect()
    assert len(bad) == 1 and bad[0]["path"].endswith("broken.parquet")
    got = spark.read.parquet(f"{out}/counters")
    types = dict(got.dtypes)
    assert types["timestamp"] == "timestamp" and types["in_octets"] == "decimal(20,0)"
    assert types["status"] == "smallint"
    vals = sorted((r["in_octets"] for r in got.collect()), key=lambda v: (v is None, v))
    assert vals[0] == decimal.Decimal(BIG) and vals[1] is None
    assert not os.path.exists(f"{out}/other")        # unchanged files are not rewritten
    with pytest.raises(Exception):
        sanitize(spark, src, out)
    sanitize(spark, src, out, overwrite=True)
    again = sanitize(spark, out, f"{tmp}/out2", dry_run=True)
    assert again.count() == 0                         # idempotent
    census = schema_census(spark, src)
    s = sanitize_summary(census, plan_casts(census)).first()
    assert (s["files_scanned"], s["files_changed"], s["casts"]) == (4, 2, 3)


def trip_tree(root):
    trip = pa.table({"pickup_datetime": pa.array([1, 2], pa.timestamp("us")),
                     "PULocationID": pa.array([1, 2], pa.int64())})
    for m in (1, 2, 3):
        write(f"{root}/for_hire/fhv_tripdata_2025-0{m}.parquet", trip)
    write(f"{root}/Green_Taxi/2025/a.parquet", trip)
    write(f"{root}/Green_Taxi/2025/b.PRQ", trip)
    os.makedirs(f"{root}/test", exist_ok=True)
    os.makedirs(f"{root}/broken", exist_ok=True)
    with open(f"{root}/broken/bad.parquet", "w") as f:
        f.write("this is not parquet")
    write(f"{root}/loose.parquet", trip)


def test_register_folders_summary_and_rerun(spark, tmp):
    trip_tree(tmp)
    s = {r["folder"]: r for r in register_folders(spark, tmp, "nyc_t1").collect()}
    assert s["for_hire"]["status"] == "created" and s["for_hire"]["n_files"] == 3
    assert s["for_hire"]["n_rows"] == 6
    assert s["Green_Taxi"]["table"] == "green_taxi" and s["Green_Taxi"]["n_files"] == 2
    assert s["broken"]["status"] == "error" and "bad.parquet" in s["broken"]["error"]
    assert "loose.parquet" not in s
    assert s["test"]["status"] == "skipped" and s["test"]["table"] is None
    assert spark.table("nyc_t1.green_taxi").count() == 4
    again = {r["folder"]: r["status"] for r in register_folders(spark, tmp, "nyc_t1").collect()}
    assert again["for_hire"] == "refreshed"
    assert spark.table("nyc_t1.for_hire").count() == 6   # not appended twice
    m = file_manifest(spark, tmp)
    assert m.filter("error IS NULL").groupBy().sum("n_rows").first()[0] == 10
    assert sorted(list_tables(spark, "nyc_t1")) == ["for_hire", "green_taxi"]


def test_case_collision_becomes_view(spark, tmp):
    trip = pa.table({"a": pa.array([1, 2, 3], pa.int64())})
    write(f"{tmp}/Yellow/one.parquet", trip)
    write(f"{tmp}/yellow/two.parquet", trip)
    register_folders(spark, tmp, "nyc_t2")
    assert spark.table("nyc_t2.yellow").count() == 6
    assert "yellow" in list_views(spark, "nyc_t2")


def test_catalog_report_with_orphan_view(spark, tmp):
    trip_tree(tmp)
    register_folders(spark, tmp, "nyc_t3")
    spark.sql("CREATE OR REPLACE VIEW nyc_t3.v AS SELECT * FROM nyc_t3.for_hire")
    spark.sql(f"CREATE TABLE nyc_t3.tmp_t USING parquet LOCATION '{tmp}/for_hire'")
    spark.sql("CREATE OR REPLACE VIEW nyc_t3.orphan AS SELECT * FROM nyc_t3.tmp_t")
    spark.sql("DROP TABLE nyc_t3.tmp_t")
    rep = {r["name"]: r for r in catalog_report(spark, "nyc_t3").collect()}
    assert rep["for_hire"]["kind"] == "table" and rep["for_hire"]["n_rows"] == 6
    assert rep["for_hire"]["n_files"] == 3 and rep["for_hire"]["bytes"] > 0
    assert rep["v"]["kind"] == "view" and rep["v"]["n_rows"] == 6
    assert rep["orphan"]["n_rows"] is None and "CREATE" in rep["orphan"]["definition"]
    assert run_sql(spark, "SELECT count(*) FROM for_hire", "nyc_t3").first()[0] == 6
    assert catalog_report(spark, "nyc_t3").count() == 4


def test_mixed_schema_folder_is_flagged(spark, tmp):
    write(f"{tmp}/yellow_taxi/one.parquet", pa.table({"c": pa.array([1, 2], pa.int32())}))
    write(f"{tmp}/yellow_taxi/two.parquet", pa.table({"c": pa.array([3], pa.uint64())}))
    s = register_folders(spark, tmp, "nyc_t4").first()
    assert s["status"] == "created" and s["n_rows"] == 3
    assert s["error"] == "mixed schemas: 2 distinct"


def test_create_table_drops_and_recreates(spark):
    from tablewatch.sources.ingest import create_table
    ident = create_table(spark, "table_name", "id INT NOT NULL, data STRING", namespace="ns_demo")
    spark.sql(f"INSERT INTO {ident} VALUES (1, 'a')")
    create_table(spark, "table_name", "id INT NOT NULL, data STRING", namespace="ns_demo")
    assert spark.table(ident).count() == 0
    assert [f.name for f in spark.table(ident).schema] == ["id", "data"]


def test_footer_census_runs_where_workers_lack_the_package(tmp):
    """Executors need not have the package: the task function ships with the
    job.  The driver here finds the package only through its own sys.path."""
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    counters_tree(f"{tmp}/data")
    code = (f"import sys; sys.path.insert(0, {root!r})\n"
            "from pyspark.sql import SparkSession\n"
            "spark = SparkSession.builder.master('local[2]').getOrCreate()\n"
            "from tablewatch.sources.footers import schema_census\n"
            f"print('ROWS', schema_census(spark, {tmp + '/data'!r}).count())\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp, env=env, capture_output=True,
                         text=True, timeout=300)
    assert "ROWS 8" in out.stdout, out.stderr[-2000:]


def test_folder_names_with_spaces_become_valid_tables(spark, tmp):
    write(f"{tmp}/My Folder/sub dir/x y.parquet", pa.table({"a": pa.array([1, 2], pa.int64())}))
    write(f"{tmp}/My-Folder/z.parquet", pa.table({"a": pa.array([3], pa.int64())}))
    s = {r["folder"]: r for r in register_folders(spark, tmp, "nyc_t5").collect()}
    assert s["My Folder"]["table"] == "my_folder" and s["My Folder"]["status"] == "created"
    # 'My-Folder' maps to the same name: both become one view over two tables
    assert spark.table("nyc_t5.my_folder").count() == 3


def test_sanitize_then_ingest_command_lines(tmp):
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    counters_tree(f"{tmp}/in")
    env = dict(os.environ, PYTHONPATH=root)
    run = lambda *a: subprocess.run([sys.executable, "-m", *a], env=env, cwd=tmp,
                                    capture_output=True, text=True, timeout=600)
    out = run("tablewatch.sources.sanitize", "--in", f"{tmp}/in", "--out", f"{tmp}/out")
    assert out.returncode == 0, out.stderr[-2000:]
    assert os.path.isdir(f"{tmp}/out/counters")
    out = run("tablewatch.sources.ingest", f"{tmp}/out", "--namespace", "nyc")
    assert out.returncode == 0 and "created" in out.stdout, out.stderr[-2000:]


def test_relative_root_is_resolved_from_the_working_directory(spark, tmp, monkeypatch):
    write(f"{tmp}/data/events/a.parquet", pa.table({"a": pa.array([1, 2, 3], pa.int64())}))
    monkeypatch.chdir(tmp)
    s = register_folders(spark, "data", "nyc_t6").first()
    assert s["status"] == "created" and s["n_rows"] == 3
    assert spark.table("nyc_t6.events").count() == 3


def test_sanitize_can_rewrite_unchanged_files_too(spark, tmp):
    src, out = f"{tmp}/in", f"{tmp}/out"
    counters_tree(src)
    report = sanitize(spark, src, out, only_changed=False)
    assert report.filter("written").count() == 3          # casts of the changed files
    other = spark.read.parquet(f"{out}/other")              # unchanged file copied as is
    assert dict(other.dtypes)["timestamp"] == "decimal(20,2)" and other.count() == 1


def test_sanitised_files_keep_names_nullability_and_metadata(spark, tmp):
    schema = pa.schema([pa.field("id", pa.uint64(), nullable=False, metadata={"unit": "id"}),
                        pa.field("timestamp", pa.uint64()), pa.field("a.b", pa.int32(), nullable=False)],
                       metadata={"owner": "ops"})
    rows = pa.table([pa.array(range(5000), pa.uint64()), pa.array([None] * 5000, pa.uint64()),
                     pa.array([7] * 5000, pa.int32())], schema=schema)
    write(f"{tmp}/in/x y/deep/one.PRQ", rows)
    write(f"{tmp}/in/x y/none.parquet", rows.slice(0, 0))
    report = sanitize(spark, f"{tmp}/in", f"{tmp}/out")
    assert report.filter("written").count() == 4
    for rel, n in (("x y/deep/one.PRQ", 5000), ("x y/none.parquet", 0)):
        got = pq.ParquetFile(f"{tmp}/out/{rel}")
        fields = got.schema_arrow
        assert got.metadata.num_rows == n
        assert (fields.field("id").nullable, fields.field("id").metadata[b"unit"]) == (False, b"id")
        assert str(fields.field("timestamp").type) == "timestamp[us, tz=UTC]" and not fields.field("a.b").nullable
        assert fields.metadata[b"owner"] == b"ops"
    assert os.listdir(f"{tmp}/out/x y/deep") == ["one.PRQ"]          # nothing half-written is left


def test_sanitiser_keeps_the_types_spark_noted_and_instants(spark, tmp):
    spark.conf.set("spark.sql.parquet.outputTimestampType", "INT96")
    spark.sql("SELECT CAST(1700000000000000 AS DECIMAL(20,0)) AS timestamp, "
              "TIMESTAMP'2024-01-02 03:04:05.678901' AS seen, 1 AS k").write.parquet(f"{tmp}/in/f")
    spark.conf.unset("spark.sql.parquet.outputTimestampType")
    sanitize(spark, f"{tmp}/in", f"{tmp}/out")
    got = spark.read.parquet(f"{tmp}/out/f")
    assert dict(got.dtypes) == {"timestamp": "timestamp", "seen": "timestamp", "k": "int"}
    assert got.selectExpr("unix_micros(timestamp)", "CAST(seen AS STRING)").first()[:] == \
        (1700000000000000, "2024-01-02 03:04:05.678901")


def test_overwriting_replaces_files_and_spares_others(spark, tmp):
    write(f"{tmp}/in/a.parquet", pa.table({"u": pa.array([1], pa.uint64())}))
    write(f"{tmp}/out/other.parquet", pa.table({"u": pa.array([9], pa.int64())}))
    sanitize(spark, f"{tmp}/in", f"{tmp}/out")
    write(f"{tmp}/in/a.parquet", pa.table({"u": pa.array([1, 2], pa.uint64())}))
    with pytest.raises(FileExistsError):
        sanitize(spark, f"{tmp}/in", f"{tmp}/out")
    sanitize(spark, f"{tmp}/in", f"{tmp}/out", overwrite=True)
    assert pq.read_table(f"{tmp}/out/a.parquet").num_rows == 2 and os.path.exists(f"{tmp}/out/other.parquet")


def test_catalog_report_reads_all_tables_together(spark, tmp):
    import shutil
    spark.sql("CREATE DATABASE IF NOT EXISTS tw_rep")
    for n in range(6):
        write(f"{tmp}/t{n}/x y/a.parquet", pa.table({"a": list(range(n))}))
    for name, folder in [*((f"t{n}", f"t{n}") for n in range(6)), ("again", "t3"), ("part", "t4/x y")]:
        spark.sql(f"CREATE TABLE tw_rep.{name} (a BIGINT) USING parquet LOCATION '{tmp}/{folder}'")
    shutil.rmtree(f"{tmp}/t5")
    os.remove(f"{tmp}/t2/x y/a.parquet")
    report = catalog_report(spark, "tw_rep")
    got = {r["name"]: (r["n_files"], r["n_rows"]) for r in report.collect()}
    assert got == {"t0": (1, 0), "t1": (1, 1), "t2": (0, 0), "t3": (1, 3), "again": (1, 3), "t4": (1, 4),
                   "part": (1, 4), "t5": (None, None)}
    plan = report._jdf.queryExecution().toString()
    assert plan.split("== Optimized")[1].split("== Physical")[0].count("MapInPandas") == 1
    spark.sql("DROP DATABASE tw_rep CASCADE")


def test_rewriting_holds_a_stretch_of_a_file(tmp):
    """Few encoded bytes may decode to many: rows bound a stretch, too."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    from tablewatch.sources.sanitize import _rewrite_file
    n = 600_000
    values = pa.DictionaryArray.from_arrays(pa.array([0] * n, pa.int32()), pa.array(["x" * 300]))
    pq.write_table(pa.table({"id": pa.array(range(n), pa.uint64()), "v": values.cast(pa.string())}), f"{tmp}/in.parquet")
    usual = pa.default_memory_pool()
    pool = pa.proxy_memory_pool(usual)
    pa.set_memory_pool(pool)
    try:
        assert _rewrite_file(f"file:{tmp}/in.parquet", f"{tmp}/out.parquet", {"id": TO_DECIMAL}, "snappy") == n
    finally:
        pa.set_memory_pool(usual)
    assert pool.max_memory() < 100 << 20
    got = pq.ParquetFile(f"{tmp}/out.parquet")
    assert got.metadata.num_rows == n
    assert got.schema_arrow.field("id").type == pa.decimal128(20, 0)
    assert got.read(["id"]).column("id").cast(pa.int64()).to_pylist() == list(range(n))
