"""Warehouse loads, file sources/sinks and the streaming ingest."""

from __future__ import annotations

import csv
import datetime as dt
import os
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillroll.plans.warehouse import Warehouse
from tillroll.sources import files
from tillroll.streaming.ingest import start_fact_ingest


def _files_in(folder):
    """Names in a folder, without the local file system's checksums."""
    return sorted(f for f in os.listdir(folder) if not f.startswith("."))


def _raw(spark, rows):
    return spark.createDataFrame(rows, files.RAW_TRANSACTIONS)


def _txn(order_id, customer="CUST_0001", product="PROD_BEA_01", day="2025-01-05", net="90.00",
         profit="30.00", qty=1):
    d = dt.date.fromisoformat(day)
    return (order_id, customer, product, day, d.month, d.strftime("%B"), f"Q{(d.month - 1) // 3 + 1}", d.year,
            "West", "Regular", "Beauty", "Beauty Item 1", qty, Decimal("100.00"), 10, Decimal("10.00"),
            Decimal("100.00"), Decimal(net) if net else None, Decimal("60.00"),
            Decimal(profit) if profit else None, 0, "PayPal")


@pytest.fixture()
def wh(spark):
    w = Warehouse(spark, tempfile.mkdtemp(prefix="wh-"), fact_keys=("order_id",))
    w.create_tables()
    cust = spark.createDataFrame([("CUST_0001", "Customer_0001", "Regular", "West", "City_1", None)],
                                 "customer_id string, customer_name string, segment string, region string, "
                                 "city string, joined_date date")
    prod = spark.createDataFrame([("PROD_BEA_01", "Beauty Item 1", "Beauty", Decimal("100.00"),
                                   Decimal("45.00"), 55.0)],
                                 "product_id string, product_name string, category string, "
                                 "unit_price decimal(18,2), cost_price decimal(18,2), margin_pct double")
    w.load_dimension("dim_customer", cust)
    w.load_dimension("dim_product", prod)
    return w


def test_create_tables_is_idempotent(spark, wh):
    wh.create_tables()
    assert wh.table("dim_customer").count() == 1


def test_fact_load_twice_equals_once(spark, wh):
    batch = _raw(spark, [_txn("ORD_000001"), _txn("ORD_000002"), _txn("ORD_000001", net="1.00")])
    sales = batch.withColumn("date_id", F.col("order_date"))
    assert wh.load_fact(sales) == 2
    assert wh.load_fact(sales) == 0
    kept = {r.order_id: r.net_revenue for r in wh.table("fact_sales").collect()}
    # the first line to arrive wins, whatever its values
    assert kept == {"ORD_000001": Decimal("90.00"), "ORD_000002": Decimal("90.00")}


def test_first_arrival_wins_in_dimensions(spark, wh):
    batch = spark.createDataFrame([("CUST_0009", "zed", "Regular", "West", "c", None), ("CUST_0009", "abe", "Regular", "West", "c", None)],
                                  "customer_id string, customer_name string, segment string, region string, city string, joined_date date")
    assert wh.load_dimension("dim_customer", batch) == 1
    assert {r.customer_name for r in wh.table("dim_customer").where("customer_id = 'CUST_0009'").collect()} == {"zed"}


def test_null_keys_are_refused_however_often_they_come(spark, wh):
    batch = spark.createDataFrame([(None, "a", "Regular", "West", "c", None), (None, "b", "Regular", "West", "c", None)],
                                  "customer_id string, customer_name string, segment string, region string, city string, joined_date date")
    assert [wh.load_dimension("dim_customer", batch) for _ in range(2)] == [0, 0]
    sales = _raw(spark, [_txn("ORD_000001", customer=None), _txn("ORD_000002")]).withColumn("date_id", F.col("order_date"))
    assert [wh.load_fact(sales, batch_id="b") for _ in range(2)] == [1, 0]
    assert [r.reason for r in wh.table("fact_rejects").collect()] == ["missing or invalid customer_id"]


def test_text_dates_are_rejected_not_raised(spark, wh):
    good, bad = _txn("ORD_000001"), list(_txn("ORD_000002"))
    bad[3] = "garbage"
    sales = _raw(spark, [good, tuple(bad)])
    assert wh.load_fact(sales) == 1
    assert wh.load_fact(_raw(spark, [_txn("ORD_000003"), _txn("ORD_000004")]).withColumn(
        "date_id", F.when(F.col("order_id") == "ORD_000003", F.lit("2025-1-5x")).otherwise(F.col("order_date")))) == 1
    rejects = wh.table("fact_rejects").collect()
    assert {r.reason for r in rejects} == {"missing or invalid date_id"} and all("ORD_00000" in r.row for r in rejects)
    assert wh.star().fact.count() == wh.table("fact_sales").count() == 2


def test_empty_warehouse_gives_an_empty_star(spark):
    w = Warehouse(spark, tempfile.mkdtemp(prefix="wh-"), fact_keys=("order_id",))
    w.create_tables()
    star = w.star()
    assert star.fact.count() == 0 and star.dim_date.count() == 0


def test_orphans_and_bad_rows_go_to_rejects(spark, wh):
    batch = _raw(spark, [_txn("ORD_000010", product="PROD_XXX_99"), _txn("ORD_000011", net=None),
                         _txn("ORD_000012")]).withColumn("date_id", F.col("order_date"))
    assert wh.load_fact(batch) == 1
    reasons = sorted(r.reason for r in wh.table("fact_rejects").collect())
    assert reasons == ["missing or invalid net_revenue", "unknown product_id"]


def test_dimension_first_wins(spark, wh):
    dup = spark.createDataFrame([("CUST_0001", "Other name", "Premium", "East", "X", None),
                                 ("CUST_0002", "Customer_0002", "Premium", "East", "City_2", None)],
                                "customer_id string, customer_name string, segment string, region string, "
                                "city string, joined_date date")
    assert wh.load_dimension("dim_customer", dup) == 1
    names = {r.customer_id: r.customer_name for r in wh.table("dim_customer").collect()}
    assert names == {"CUST_0001": "Customer_0001", "CUST_0002": "Customer_0002"}


def test_kpi_snapshots_append_and_run_log(spark, wh):
    monthly = spark.createDataFrame([(2025, 1, "January", "Q1", 1.0, 1.0, 1, 1.0, 1.0, None, 1.0)],
                                    "year long, month long, month_name string, quarter string, total_revenue double, "
                                    "total_profit double, total_orders long, avg_order_value double, "
                                    "profit_margin_pct double, mom_growth_pct double, ytd_revenue double")
    regional = spark.createDataFrame([("West", 1.0, 1.0, 1, 1.0, 0.0, "Average")],
                                     "region string, total_revenue double, total_profit double, total_orders long, "
                                     "profit_margin double, vs_avg_pct double, performance string")
    wh.append_kpis(monthly, regional)
    wh.append_kpis(monthly, regional)
    assert wh.table("agg_monthly_kpis").count() == 2
    newest = wh.latest("agg_monthly_kpis")
    assert newest.count() == 1 and {f.split("load_id=")[1].split("/")[0] for f in newest.inputFiles()} == {wh.commits()[-1][1]["folders"]["agg_monthly_kpis"][0]}
    assert newest.first().created_at == wh.table("agg_monthly_kpis").agg(F.max("created_at")).first()[0]
    wh.log_run("db_load", "SUCCESS", 5, duration=1.5)
    log = wh.table("pipeline_run_log").first()
    assert (log.stage, log.status, log.records_processed) == ("db_load", "SUCCESS", 5)


def test_latest_batch_and_exports(spark):
    raw = tempfile.mkdtemp(prefix="raw-")
    files.write_raw_batch(_raw(spark, [_txn("ORD_000001")]), raw, "transactions", "20250101_000000")
    files.write_raw_batch(_raw(spark, [_txn("ORD_000002"), _txn("ORD_000003")]), raw, "transactions",
                          "20250102_000000")
    latest = files.read_latest_batch(spark, raw, "transactions", files.RAW_TRANSACTIONS)
    assert sorted(r.order_id for r in latest.collect()) == ["ORD_000002", "ORD_000003"]
    out = tempfile.mkdtemp(prefix="out-")
    assert files.export_report(latest.limit(0), out, "Empty", "ts") is None
    path = files.export_report(latest.repartition(4).orderBy("order_id"), out, "PowerBI_Test", "ts")
    assert path == f"{out}/PowerBI_Test_ts.csv" and _files_in(out) == ["PowerBI_Test_ts.csv"]
    with open(path, newline="") as fh:
        table = list(csv.reader(fh))
    assert table[0] == latest.columns and [r[0] for r in table[1:]] == ["ORD_000002", "ORD_000003"]
    with pytest.raises(FileExistsError):
        files.export_report(latest, out, "PowerBI_Test", "ts")
    written = files.export_for_bi({"regional": latest}, out, "t2")
    assert list(written) == ["PowerBI_Regional_KPIs"]
    saved = files.save_all({"a": latest}, out, "t3")
    assert spark.read.parquet(saved["a"]).count() == 2


def test_streaming_ingest_is_exactly_once(spark, wh):
    raw = tempfile.mkdtemp(prefix="raw-")
    ckpt = tempfile.mkdtemp(prefix="ckpt-")
    files.write_raw_batch(_raw(spark, [_txn("ORD_000001"), _txn("ORD_000002")]), raw, "transactions", "b1")
    q = start_fact_ingest(spark, raw, wh, ckpt)
    q.awaitTermination(120)
    assert wh.table("fact_sales").count() == 2
    # a second batch repeating one order, then a restart from the same checkpoint
    files.write_raw_batch(_raw(spark, [_txn("ORD_000002"), _txn("ORD_000003", qty=0),
                                       _txn("ORD_000004")]), raw, "transactions", "b2")
    q = start_fact_ingest(spark, raw, wh, ckpt)
    q.awaitTermination(120)
    assert sorted(r.order_id for r in wh.table("fact_sales").collect()) == ["ORD_000001", "ORD_000002", "ORD_000004"]
    assert wh.star().fact.count() == 3          # the days of all lines are known
    logs = [(r.records_processed, r.error_message) for r in wh.table("pipeline_run_log").orderBy("run_timestamp").collect()]
    assert logs == [(2, "0 of 2 lines dropped by the cleaner"), (1, "1 of 3 lines dropped by the cleaner")]


def test_stream_takes_the_older_batch_first_and_replays_once(spark, wh):
    raw, ckpt = tempfile.mkdtemp(prefix="raw-"), tempfile.mkdtemp(prefix="ckpt-")
    files.write_raw_batch(_raw(spark, [_txn("ORD_000001", net="10.00", day="2025-02-05"), _txn("ORD_000005", customer="CUST_9999")]),
                          raw, "transactions", "20250202_000000")
    files.write_raw_batch(_raw(spark, [_txn("ORD_000001", net="90.00", day="2025-01-05")]), raw, "transactions", "20250101_000000")
    start_fact_ingest(spark, raw, wh, ckpt).awaitTermination(120)
    assert [(r.order_id, r.net_revenue, r.date_id) for r in wh.table("fact_sales").collect()] == [("ORD_000001", Decimal("90.00"), "2025-01-05")]
    assert wh.star().fact.count() == 1 and wh.table("fact_rejects").count() == 1
    # the same micro-batch once more, as after a crash before the commit
    from tillroll.streaming.ingest import raw_transaction_stream, to_sales_lines  # noqa: F401
    again = files.read_batches(spark, raw, "transactions", files.RAW_TRANSACTIONS)
    batch_id = wh.table("fact_rejects").first().batch_id
    assert wh.load_fact(to_sales_lines(again), order=[files.BATCH_COL], batch_id=batch_id) == 0
    assert wh.table("fact_rejects").count() == 1 and wh.star().fact.count() == wh.table("fact_sales").count() == 1


def test_batch_run_end_to_end_twice(spark):
    from conftest import SF_SMALL
    from tillroll.plans.batch import run_batch
    root = tempfile.mkdtemp(prefix="batch-")
    first = run_batch(spark, SF_SMALL, root, ts="r1")
    wh = Warehouse(spark, f"{root}/warehouse")
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    distinct_keys = lines.select("l_orderkey", "l_linenumber").distinct().count()
    assert first.fact_rows_added == distinct_keys == wh.table("fact_sales").count()
    assert wh.table("dim_customer").count() == spark.read.parquet(f"{SF_SMALL}/customer.parquet").count()
    assert len(first.exports) == 8 and first.rows_dropped == 0 and set(first.kpi_paths) >= {"monthly_kpis", "rfm", "customers"}
    assert all(os.path.isfile(path) and spark.read.option("header", True).csv(path).count() > 0 for path in first.exports.values())
    assert _files_in(f"{root}/outputs") == sorted(f"{name}_r1.csv" for name in first.exports)
    assert [name[:11] for name in first.exports] == [f"PowerBI_0{i}_" for i in range(1, 9)]
    assert first.insights["best_month"].count() == 3
    second = run_batch(spark, SF_SMALL, root, ts="r2")
    assert second.fact_rows_added == 0
    assert wh.table("fact_sales").count() == distinct_keys
    months = wh.table("agg_monthly_kpis")
    assert months.count() == 2 * months.select("year", "month").distinct().count()
    assert [r.status for r in wh.table("pipeline_run_log").collect()] == ["SUCCESS", "SUCCESS"]
    assert wh.table("fact_rejects").count() == 0


def _customers(spark, ids, name="c"):
    return spark.createDataFrame([(i, f"{name}{i}", "Regular", "West", "x", None) for i in ids], "customer_id string, customer_name string, "
                                 "segment string, region string, city string, joined_date date")


def test_first_file_wins_whatever_its_size(spark, wh):
    """A small file before a large one, and a file that is read in several splits."""
    folder = tempfile.mkdtemp(prefix="files-")
    cols = wh.table("dim_customer").columns
    for name, rows in (("a.csv", [("K1", "first"), ("K2", "first")]),
                       ("b.csv", [(f"F{i}", "x") for i in range(2000)] + [("K1", "later"), ("K3", "early")] + [(f"G{i}", "x") for i in range(6000)] + [("K3", "late")]),
                       ("c.csv", [("K3", "last"), ("K4", "own")])):
        with open(f"{folder}/{name}", "w", newline="") as fh:
            w = csv.writer(fh)
            w.writerow(cols)
            w.writerows([(k, n, "Regular", "West", "x", None) for k, n in rows])
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        batch = spark.read.schema(wh.table("dim_customer").schema).option("header", True).csv(folder)
        assert batch.rdd.getNumPartitions() > 3
        assert wh.load_dimension("dim_customer", batch.where("customer_id is not null")) == 8004
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    names = {r.customer_id: r.customer_name for r in wh.table("dim_customer").where("customer_id like 'K%'").collect()}
    assert names == {"K1": "first", "K2": "first", "K3": "early", "K4": "own"}


def test_a_load_reads_its_target_where_it_lies(spark, wh):
    """No exchange over the fact or a dimension in the plan of a load's anti join."""
    import contextlib
    import io

    from tillroll.operators.dedupe import insert_or_ignore
    wh.load_fact(_raw(spark, [_txn(f"ORD_{i:06d}") for i in range(50)]).withColumn("date_id", F.col("order_date")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, key, batch in (("fact_sales", "order_id", spark.range(90).selectExpr("printf('ORD_%06d', id) as order_id", "id as _arrival")),
                                 ("dim_customer", "customer_id", spark.range(9).selectExpr("printf('CUST_%04d', id) as customer_id", "id as _arrival"))):
            new = insert_or_ignore(wh.table(name), batch, [key], ["_arrival"])
            out = io.StringIO()
            with contextlib.redirect_stdout(out):
                new.explain()
            plan = out.getvalue().split("== Initial Plan ==")[0].splitlines()
            at = next(n for n, line in enumerate(plan) if "Scan parquet" in line and "wh_" in line)
            assert "Bucketed: true" in plan[at]
            depth = len(plan[at]) - len(plan[at].lstrip(" :+-"))
            above = []                                  # the operators over the target, up to the join
            for line in reversed(plan[:at]):
                d = len(line) - len(line.lstrip(" :+-"))
                if d < depth:
                    depth = d
                    above.append(line)
                    if "Join" in line:
                        break
            assert "Join" in above[-1] and not any("Exchange" in line for line in above), above
            assert new.count() == (40 if name == "fact_sales" else 8)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("failing", [0, 4, 7])
def test_a_load_that_fails_at_any_write_leaves_nothing(spark, wh, monkeypatch, failing):
    """Fail at the n-th append (or at the commit), run again: the state of one run."""
    sales = _raw(spark, [_txn("ORD_000001"), _txn("ORD_000002"), _txn("ORD_000003", product="PROD_X")]).withColumn("date_id", F.col("order_date"))
    monthly = spark.createDataFrame([(2025, 1)], "year long, month long").selectExpr("*", *[
        f"cast(null as {t}) {c}" for c, t in (("month_name", "string"), ("quarter", "string"), ("total_revenue", "double"), ("total_profit", "double"),
                                              ("total_orders", "long"), ("avg_order_value", "double"), ("profit_margin_pct", "double"),
                                              ("mom_growth_pct", "double"), ("ytd_revenue", "double"))])
    regional = spark.createDataFrame([("West",)], "region string").selectExpr("*", *[
        f"cast(null as {t}) {c}" for c, t in (("total_revenue", "double"), ("total_profit", "double"), ("total_orders", "long"),
                                              ("profit_margin", "double"), ("vs_avg_pct", "double"), ("performance", "string"))])
    tables = ("dim_customer", "dim_product", "dim_date", "dim_region", "fact_sales", "fact_rejects", "agg_monthly_kpis")
    count = lambda: {t: wh.table(t).count() for t in tables}
    before, calls, plain = count(), [], Warehouse._append

    def append(self, name, df):
        rows = plain(self, name, df)
        if self._load and name != "pipeline_run_log":
            calls.append(name)
            if len(calls) == failing + 1:
                raise RuntimeError("lost")
        return rows
    monkeypatch.setattr(Warehouse, "_append", append)
    run = lambda: wh.run_load(sales, _customers(spark, ["CUST_0002"]), wh.table("dim_product"), monthly, regional)
    with pytest.raises(RuntimeError):
        run()
    assert len(calls) == failing + 1 and count() == before
    monkeypatch.setattr(Warehouse, "_append", plain)
    assert run() == 2
    assert count() == {"dim_customer": 2, "dim_product": 1, "dim_date": 1, "dim_region": 1, "fact_sales": 2, "fact_rejects": 1, "agg_monthly_kpis": 1}
    assert [r.status for r in wh.table("pipeline_run_log").orderBy("run_timestamp").collect()] == ["FAILED", "SUCCESS"]
    assert wh.remove_orphans() == 0 and count()["fact_sales"] == 2


def test_two_loads_at_once_add_a_key_once(spark, wh, monkeypatch):
    """Another session commits the same keys after this load has read the tables: it runs again."""
    other = Warehouse(spark, wh.root, fact_keys=("order_id",))
    plain, met = Warehouse._write_commit, []

    def commit(self, number, record):
        if self is wh and not met:
            met.append(number)
            assert other.load_dimension("dim_customer", _customers(spark, ["N1", "N2"], "other ")) == 2
        return plain(self, number, record)
    monkeypatch.setattr(Warehouse, "_write_commit", commit)
    assert wh.load_dimension("dim_customer", _customers(spark, ["N1", "N2", "N3"], "own ")) == 1
    names = sorted(r.customer_name for r in wh.table("dim_customer").where("customer_id like 'N%'").collect())
    assert names == ["other N1", "other N2", "own N3"] and sorted(r.customer_name for r in other.table("dim_customer").where(
        "customer_id like 'N%'").collect()) == names
    assert wh.remove_orphans() == 0


def test_a_stream_that_fails_is_logged(spark, wh, monkeypatch):
    raw, ckpt = tempfile.mkdtemp(prefix="raw-"), tempfile.mkdtemp(prefix="ckpt-")
    files.write_raw_batch(_raw(spark, [_txn("ORD_000001")]), raw, "transactions", "b1")
    plain = Warehouse._load_fact
    monkeypatch.setattr(Warehouse, "_load_fact", lambda *a: (_ for _ in ()).throw(RuntimeError("no disk")))
    q = start_fact_ingest(spark, raw, wh, ckpt)
    with pytest.raises(Exception, match="no disk"):
        q.awaitTermination(120)
    monkeypatch.setattr(Warehouse, "_load_fact", plain)
    start_fact_ingest(spark, raw, wh, ckpt).awaitTermination(120)
    log = [(r.status, r.records_processed) for r in wh.table("pipeline_run_log").orderBy("run_timestamp").collect()]
    assert log == [("FAILED", 0), ("SUCCESS", 1)] and wh.table("fact_sales").count() == 1


def test_work_folder_follows_the_session_checkpoint_dir(spark):
    from tillroll.session import ensure_checkpoint_dir, work_path
    root = ensure_checkpoint_dir(spark)
    assert root == spark.sparkContext.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert root.removeprefix("file:").startswith(configured.removeprefix("file:"))
    assert work_path(spark, "tables", "t").startswith(root)


def test_replaced_input_gives_a_new_star(spark):
    import os
    import shutil

    import pyarrow.parquet as pq
    from conftest import SF_SMALL
    from tillroll.plans.registry import queries
    d = tempfile.mkdtemp(prefix="sf-")
    for t in ("region", "nation", "customer", "orders", "lineitem", "part"):
        shutil.copy(f"{SF_SMALL}/{t}.parquet", d)
        os.chmod(f"{d}/{t}.parquet", 0o644)
    totals = lambda: queries()["fact_totals"](spark, d).first().transactions
    before = totals()
    pq.write_table(pq.read_table(f"{SF_SMALL}/lineitem.parquet").slice(0, 100), f"{d}/lineitem.parquet")
    assert before == 6000 and totals() == 100


def test_other_masters_need_a_shared_folder():
    from types import SimpleNamespace
    from tillroll.session import ensure_checkpoint_dir
    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="yarn", setCheckpointDir=lambda d: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda *a: None)))


def test_cli_list_and_show(spark, capsys):
    from conftest import SF_SMALL
    from tillroll.__main__ import main
    assert main(["list"]) == 0
    assert "rpt_monthly_growth" in capsys.readouterr().out
    assert main(["show", "var_region_summary", "--sf-dir", SF_SMALL, "-n", "2"]) == 0
    assert "total_revenue" in capsys.readouterr().out


def test_drop_work_removes_a_work_folder(spark):
    from tillroll.session import drop_work, work_path
    spark.range(5).write.parquet(work_path(spark, "drop-test", "t"))
    assert drop_work(spark, "drop-test") is True
    assert drop_work(spark, "drop-test") is False


def test_latest_flat_csv_file(spark):
    import csv
    import os
    raw = tempfile.mkdtemp(prefix="flat-")
    cols = [f.name for f in files.RAW_TRANSACTIONS.fields]
    for ts, ids in (("20250101_000000", ["ORD_000001"]), ("20250301_000000", ["ORD_000007", "ORD_000008"]),
                    ("20250201_000000", ["ORD_000004"])):
        with open(os.path.join(raw, f"transactions_{ts}.csv"), "w", newline="") as fh:
            w = csv.writer(fh)
            w.writerow(cols)
            for i in ids:
                w.writerow(_txn(i))
    df = files.read_latest_csv(spark, raw, "transactions", files.RAW_TRANSACTIONS)
    assert sorted(r.order_id for r in df.collect()) == ["ORD_000007", "ORD_000008"]
    assert files.read_latest_csv(spark, raw, "customers", files.RAW_TRANSACTIONS).count() == 0


def test_streaming_ingest_flat_files(spark, wh):
    import csv
    import os
    raw = tempfile.mkdtemp(prefix="flatstream-")
    ckpt = tempfile.mkdtemp(prefix="ckpt-")
    cols = [f.name for f in files.RAW_TRANSACTIONS.fields]

    def put(ts, ids):
        with open(os.path.join(raw, f"transactions_{ts}.csv"), "w", newline="") as fh:
            w = csv.writer(fh)
            w.writerow(cols)
            for i in ids:
                w.writerow(_txn(i))

    put("20250101_000000", ["ORD_000001", "ORD_000002"])
    start_fact_ingest(spark, raw, wh, ckpt, layout="flat").awaitTermination(120)
    put("20250102_000000", ["ORD_000002", "ORD_000003"])
    start_fact_ingest(spark, raw, wh, ckpt, layout="flat").awaitTermination(120)
    assert sorted(r.order_id for r in wh.table("fact_sales").collect()) == ["ORD_000001", "ORD_000002", "ORD_000003"]


def test_reports_over_a_warehouse_loaded_from_raw_transactions(spark, wh):
    from tillroll.plans import reports
    from tillroll.streaming.ingest import to_sales_lines
    raw = _raw(spark, [_txn("ORD_000001", day="2025-01-05"), _txn("ORD_000002", day="2025-02-10", net="45.00"),
                       _txn("ORD_000003", day="2025-02-11", qty=0)])
    sales = to_sales_lines(raw)
    wh.load_dimensions(sales, wh.table("dim_customer"), wh.table("dim_product"))
    assert wh.load_fact(sales) == 2
    star = wh.star()
    months = reports.monthly_growth(star).collect()
    assert [(m.month_name, m.total_revenue, m.mom_growth_pct) for m in months] == [
        ("January", 90.0, None), ("February", 45.0, -50.0)]
    top = reports.top_customers(star).collect()
    assert [(t.customer_id, t.total_revenue, t.region_rank) for t in top] == [("CUST_0001", 135.0, 1)]
