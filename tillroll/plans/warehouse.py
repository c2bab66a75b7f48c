"""Persistent star schema: create, load idempotently, append snapshots, log.

Tables are Parquet folders under one root (a shared, durable location on a
cluster).  Loads are set based:

* dimensions and facts are *insert-or-ignore*: the first row to arrive per
  key, minus keys already present (loading twice equals loading once); rows
  without a key are refused;
* facts are cast with ``try_cast``; rows that fail a cast, miss a key, hold a
  date that is no ISO day or name a customer/product the dimensions do not
  hold go to ``fact_rejects`` with a reason instead of being silently dropped
  (the declared foreign keys are enforced, so every report sees conformed
  keys); the days and regions of accepted lines enter their dimensions first;
* KPI tables are append-only snapshots stamped ``created_at``; the latest
  snapshot is the folder that the last commit with one names;
* ``pipeline_run_log`` gets one row per stage run.

A load writes each table into a folder of its own (``load_id=...``) and becomes
visible by one commit record, written last (``_commits/<number>.json``, by a
rename that fails if the number is taken).  Readers see the folders that
the records name and no others, so a load that fails at any point leaves the
tables as they were; a load that finds its number taken has read an older
state, and runs again on the newer one, so two loads at once cannot both
add a key.

Facts and dimensions are bucketed by their keys: a load shuffles its batch to the
target's buckets and reads the target where it lies.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import calendar_columns
from ..operators.dedupe import ARRIVAL, ARRIVAL_COLUMNS, insert_or_ignore, note_arrivals, number_arrivals
from ..operators.ordering import BROADCAST_ROWS
from ..operators.ordering import materialize as _materialize
from ..session import path_exists, remove_path, shuffle_partitions, unique_name, work_path

S, I, L, D, M = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.DecimalType(18, 2)


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SCHEMAS: dict[str, T.StructType] = {
    "dim_customer": _schema(("customer_id", S), ("customer_name", S), ("segment", S), ("region", S),
                            ("city", S), ("joined_date", T.DateType())),
    "dim_product": _schema(("product_id", S), ("product_name", S), ("category", S), ("unit_price", M),
                           ("cost_price", M), ("margin_pct", D)),
    "dim_date": _schema(("date_id", S), ("month", I), ("month_name", S), ("quarter", S), ("year", I),
                        ("is_holiday", I)),
    "dim_region": _schema(("region_name", S), ("performance", S)),
    "fact_sales": _schema(("order_id", S), ("line_number", I), ("customer_id", S), ("product_id", S),
                          ("date_id", S), ("region", S), ("quantity", L), ("unit_price", M),
                          ("discount_pct", I), ("discount_amt", M), ("gross_revenue", M),
                          ("net_revenue", M), ("cost", M), ("profit", M), ("is_returned", I),
                          ("payment_method", S), ("ingested_at", T.TimestampType())),
    "fact_rejects": _schema(("reason", S), ("row", S), ("batch_id", S), ("rejected_at", T.TimestampType())),
    "agg_monthly_kpis": _schema(("year", L), ("month", L), ("month_name", S), ("quarter", S),
                                ("total_revenue", D), ("total_profit", D), ("total_orders", L),
                                ("avg_order_value", D), ("profit_margin_pct", D), ("mom_growth_pct", D),
                                ("ytd_revenue", D), ("created_at", T.TimestampType())),
    "agg_regional_kpis": _schema(("region", S), ("total_revenue", D), ("total_profit", D),
                                 ("total_orders", L), ("profit_margin", D), ("vs_avg_pct", D),
                                 ("performance", S), ("created_at", T.TimestampType())),
    "pipeline_run_log": _schema(("run_timestamp", T.TimestampType()), ("stage", S), ("status", S),
                                ("records_processed", L), ("error_message", S), ("duration_sec", D)),
}

KEYS = {"dim_customer": ["customer_id"], "dim_product": ["product_id"], "dim_date": ["date_id"],
        "dim_region": ["region_name"]}


def _iso_day(column: str):
    """The ISO text of a day, or null if the column's text is none."""
    text = F.col(column).cast("string")
    day = F.try_to_date(text, "yyyy-MM-dd")
    return F.when(F.date_format(day, "yyyy-MM-dd") == text, text)


def _plain(schema: T.StructType, columns) -> bool:
    """All columns are of types that Parquet gives back as they were."""
    return all(isinstance(schema[c].dataType, (T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampType)) for c in columns)


class _Conflict(Exception):
    """Another load has committed since this one read the tables."""


@dataclass
class _Load:
    base: int                                          #: number of the last commit that the load has read
    id: str
    folders: dict[str, list[str]] = field(default_factory=dict)


@dataclass
class Warehouse:
    """``fact_keys``: ``("order_id",)`` for one line per order (the raw
    transaction model), ``("order_id", "line_number")`` for multi-line orders.
    ``buckets`` of the keyed tables are chosen when the tables are created."""
    spark: SparkSession
    root: str
    fact_keys: tuple[str, ...] = ("order_id", "line_number")
    enforce_foreign_keys: bool = True
    buckets: int | None = None
    _load: _Load | None = field(default=None, repr=False)
    _known: dict[str, set[str]] = field(default_factory=dict, repr=False)

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def keys(self, table: str) -> list[str]:
        return list(self.fact_keys) if table == "fact_sales" else KEYS.get(table, [])

    # commits ----------------------------------------------------------------
    def _files(self):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path("_commits"))
        return jvm, path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def commits(self) -> list[tuple[int, dict]]:
        """The commit records, by number; the first names the buckets."""
        jvm, path, fs = self._files()
        if not fs.exists(path):
            return []
        names = sorted(st.getPath().getName() for st in fs.listStatus(path) if st.getPath().getName().endswith(".json"))
        out = []
        for name in names:
            stream = fs.open(jvm.org.apache.hadoop.fs.Path(path, name))
            try:
                out.append((int(name[:-5]), json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))))
            finally:
                stream.close()
        return out

    def _write_commit(self, number: int, record: dict) -> None:
        jvm, path, fs = self._files()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        rough = jvm.org.apache.hadoop.fs.Path(path, f"_{unique_name('rough')}")
        stream = fs.create(rough, False)
        stream.write(json.dumps(record).encode())
        stream.close()
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(rough, jvm.org.apache.hadoop.fs.Path(path, f"{number:012d}.json"), options)
        except Py4JJavaError as taken:
            fs.delete(rough, False)
            if "FileAlreadyExists" not in str(taken.java_exception):
                raise
            raise _Conflict(f"commit {number}") from taken

    def transact(self, work: Callable, attempts: int = 5):
        """Run ``work()``, whose appends become visible together when it ends, or
        not at all.  It runs again if another load has committed meanwhile."""
        if self._load:
            return work()
        for attempt in range(attempts):
            commits = self.commits()
            self._load = _Load(commits[-1][0] if commits else -1, unique_name("load"))
            try:
                result = work()
                self._write_commit(self._load.base + 1, {"load": self._load.id, "folders": self._load.folders})
                return result
            except BaseException as failure:
                for name, folders in self._load.folders.items():
                    for folder in folders:
                        remove_path(self.spark, f"{self.path(name)}/load_id={folder}")
                if not isinstance(failure, _Conflict) or attempt == attempts - 1:
                    raise
            finally:
                self._load = None

    def _visible(self, name: str) -> list[list[str]]:
        """Folders of a table: for each commit with some, and the running load's own."""
        found = [r["folders"][name] for _, r in self.commits() if r["folders"].get(name)]
        own = self._load.folders.get(name) if self._load else None
        return [*found, own] if own else found

    # S7 -------------------------------------------------------------------
    def create_tables(self) -> None:
        """Create every table that does not exist yet (empty, typed)."""
        if self.commits():
            return
        _, path, fs = self._files()
        for name in SCHEMAS:
            fs.mkdirs(path.getParent().suffix(f"/{name}"))
        fs.mkdirs(path)
        try:
            self._write_commit(0, {"buckets": self.buckets or shuffle_partitions(self.spark), "folders": {}})
        except _Conflict:
            pass                                        # another session has just created them

    def _catalog_name(self, name: str) -> str:
        return f"wh_{hashlib.sha1(self.root.rstrip('/').encode()).hexdigest()[:12]}_{name}"

    def _buckets(self) -> int:
        return int(self.commits()[0][1]["buckets"])

    def _in_catalog(self, name: str, folders: list[str]) -> str:
        """The table under its catalog name (Spark knows buckets by catalog
        only), with these folders as partitions."""
        table, location = self._catalog_name(name), self.path(name)
        if name not in self._known or not self.spark.catalog.tableExists(table):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in SCHEMAS[name].fields)
            clustered = f"CLUSTERED BY ({', '.join(self.keys(name))}) INTO {self._buckets()} BUCKETS" if self.keys(name) else ""
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, load_id string) USING parquet "
                           f"PARTITIONED BY (load_id) {clustered} LOCATION '{location}'")
            self._known[name] = set()
        new = [f for f in folders if f not in self._known[name]]
        if new:
            parts = " ".join(f"PARTITION (load_id = '{f}') LOCATION '{location}/load_id={f}'" for f in new)
            self.spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")
            self._known[name] |= set(new)
        return table

    def table(self, name: str) -> DataFrame:
        """The committed rows, and those that the running load has added."""
        folders = [f for commit in self._visible(name) for f in commit]
        return self._rows(name, folders)

    def _rows(self, name: str, folders: list[str]) -> DataFrame:
        table = self._in_catalog(name, folders)
        return self.spark.table(table).where(F.col("load_id").isin(folders) if folders else F.lit(False)).drop("load_id")

    def _dealt(self, name: str, rows: DataFrame) -> DataFrame:
        """Rows for a keyed table, shuffled to its buckets."""
        return rows.repartition(self._buckets(), *self.keys(name))

    def _append(self, name: str, df: DataFrame) -> int:
        """The rows of a keyed table should be in its buckets' partitions (see
        :meth:`_dealt`); if not, every task writes a file for each bucket."""
        if not self._load:
            return self.transact(lambda: self._append(name, df))
        written = self._load.folders.setdefault(name, [])
        folder = f"{self._load.id}-{len(written)}"
        path = f"{self.path(name)}/load_id={folder}"
        rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMAS[name].fields])
        written.append(folder)
        if self.keys(name):
            # Spark writes buckets through the catalog; the name is given up again, the files stay.
            buckets, once = self._buckets(), unique_name("write").replace("-", "_")
            rows.write.bucketBy(buckets, *self.keys(name)).option("path", path).option("compression", "zstd").saveAsTable(once)
            self.spark.sql(f"DROP TABLE {once}")
        else:
            rows.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(SCHEMAS[name]).parquet(path).count()

    def remove_orphans(self) -> int:
        """Delete folders that no commit names, left by loads that were killed;
        call it while no load runs.  Returns how many there were."""
        jvm, path, fs = self._files()
        gone = 0
        for name in SCHEMAS:
            kept = {f"load_id={f}" for commit in self._visible(name) for f in commit}
            for st in fs.listStatus(jvm.org.apache.hadoop.fs.Path(self.path(name))):
                if st.getPath().getName() not in kept:
                    gone += bool(fs.delete(st.getPath(), True))
        return gone

    # S8-S10 ---------------------------------------------------------------
    def load_dimension(self, name: str, batch: DataFrame, order=()) -> int:
        """Append new keys; the first row to arrive wins (by the ``order``
        columns, if given, then by file and place in it).  Rows with a null key
        are refused."""
        return self.transact(lambda: self._load_dimension(name, batch, order))

    def _load_dimension(self, name: str, batch: DataFrame, order) -> int:
        batch = note_arrivals(batch)
        typed = batch.select(
            *[F.col(f.name).try_cast(f.dataType).alias(f.name) if f.name in batch.columns
              else F.lit(None).cast(f.dataType).alias(f.name) for f in SCHEMAS[name].fields],
            *ARRIVAL_COLUMNS, *[F.col(c).alias(f"_order_{c}") for c in order]).dropna(subset=KEYS[name])
        typed, _ = _materialize(typed, name)
        new = insert_or_ignore(self.table(name), number_arrivals(typed), KEYS[name], [*[f"_order_{c}" for c in order], ARRIVAL])
        return self._append(name, self._dealt(name, new))

    def load_calendar(self, dates: DataFrame) -> int:
        """Days of ``dates(date_id)``, ISO text, into the date dimension."""
        day = F.to_date("date_id", "yyyy-MM-dd")
        cal = calendar_columns(day)
        return self.load_dimension("dim_date", dates.select("date_id").distinct().select(
            "date_id", *[v.alias(k) for k, v in cal.items()], F.lit(0).alias("is_holiday")))

    def load_regions(self, regions: DataFrame) -> int:
        return self.load_dimension("dim_region", regions.select(F.col("region").alias("region_name")).distinct())

    def load_dimensions(self, sales: DataFrame, customers: DataFrame, products: DataFrame) -> dict[str, int]:
        dates = sales.select("date_id").where(_iso_day("date_id").isNotNull())
        return {
            "dim_customer": self.load_dimension("dim_customer", customers),
            "dim_product": self.load_dimension("dim_product", products),
            "dim_date": self.load_calendar(dates),
            "dim_region": self.load_regions(sales),
        }

    # S11 ------------------------------------------------------------------
    def load_fact(self, sales: DataFrame, order=(), batch_id: str | None = None) -> int:
        """Insert-or-ignore sales lines; returns the number actually added.

        The first line to arrive per key wins (by the ``order`` columns, if
        given, then by file and place in it).  Rejects of a ``batch_id`` are
        written once, however often the batch comes.  Days, regions, rejects and
        lines become visible together."""
        return self.transact(lambda: self._load_fact(sales, order, batch_id))

    def _load_fact(self, sales: DataFrame, order, batch_id: str | None) -> int:
        schema = SCHEMAS["fact_sales"]
        sales = note_arrivals(sales)
        raw = [c for c in sales.columns if c not in ARRIVAL_COLUMNS]
        if "date_id" not in sales.columns and "order_date" in sales.columns:
            sales = sales.withColumn("date_id", F.date_format(F.try_to_date(F.col("order_date").cast("string")), "yyyy-MM-dd"))
        typed = sales.select(
            *[F.col(f.name).try_cast(f.dataType).alias(f.name) if f.name in sales.columns
              else F.lit(None).cast(f.dataType).alias(f.name)
              for f in schema.fields if f.name not in ("ingested_at", "date_id")],
            _iso_day("date_id").alias("date_id"), *ARRIVAL_COLUMNS, *[F.col(c).alias(f"_order_{c}") for c in order],
            F.struct(*raw).alias("_orig"))
        reason = None
        for c in dict.fromkeys([*self.fact_keys, "customer_id", "product_id", "date_id", "net_revenue"]):
            cond = F.when(F.col(c).isNull(), F.lit(f"missing or invalid {c}"))
            reason = cond if reason is None else F.coalesce(reason, cond)
        # The raw row is kept for rejected rows only, as columns where Parquet can hold them, and not for a batch whose rejects are there.
        wanted = batch_id is None or self.table("fact_rejects").where(F.col("batch_id") == batch_id).isEmpty()
        plain = _plain(sales.schema, raw)
        # Of a rejected line nothing else is kept, nor the line itself if its rejects are there.
        typed = typed.withColumn("_reason", reason)
        kept = [c for c in typed.columns if c not in (*ARRIVAL_COLUMNS, "_reason", "_orig")]
        raw_row = F.when(F.col("_reason").isNotNull(), F.col("_orig") if plain else F.to_json("_orig")).alias("_raw")
        typed = typed.select(*[F.when(F.col("_reason").isNull(), F.col(c)).alias(c) for c in kept], *ARRIVAL_COLUMNS, "_reason",
                             *([raw_row] if wanted else []))
        typed, _ = _materialize(typed if wanted else typed.where("_reason is null"), "fact_batch")
        typed = number_arrivals(typed)
        good = typed.where("_reason is null").drop("_reason", "_raw")
        lines = [c for c in good.columns if c != ARRIVAL and not c.startswith("_order_")]
        unknown = None
        if self.enforce_foreign_keys:
            good, unknown = self._known_keys(good, lines)
        self.load_calendar(good)
        self.load_regions(good)
        if wanted:
            rejects = typed.where("_reason is not null").select(
                F.col("_reason").alias("reason"), (F.to_json("_raw") if plain else F.col("_raw")).alias("row"))
            rejects = rejects if unknown is None else rejects.unionByName(unknown)
            self._append("fact_rejects", rejects.withColumn("batch_id", F.lit(batch_id).cast("string"))
                         .withColumn("rejected_at", F.current_timestamp()))
        return self._append_first(good, [*[f"_order_{c}" for c in order], ARRIVAL])

    def _known_keys(self, good: DataFrame, lines: list[str]) -> tuple[DataFrame, DataFrame]:
        """Lines whose customer and product the dimensions hold, and the rejects
        ``(reason, row)`` of the others.  The distinct keys meet the
        dimensions; those not found are broadcast to the lines, which stay where
        they are, or joined by key and the lines written, if there are many."""
        reason, many = None, False
        for dim, key in (("dim_customer", "customer_id"), ("dim_product", "product_id")):
            absent, count = _materialize(good.select(key).distinct().join(self.table(dim).select(key), key, "left_anti")
                                         .withColumn(f"_no_{key}", F.lit(True)), "unknown_keys")
            many |= count > BROADCAST_ROWS
            good = good.join(absent if count > BROADCAST_ROWS else F.broadcast(absent), key, "left")
            cond = F.when(F.col(f"_no_{key}"), F.lit(f"unknown {key}"))
            reason = cond if reason is None else F.coalesce(reason, cond)
        good = good.withColumn("_reason", reason).drop("_no_customer_id", "_no_product_id")
        if many:
            good, _ = _materialize(good, "fact_keys")
        rejects = good.where("_reason is not null").select(F.col("_reason").alias("reason"), F.to_json(F.struct(*lines)).alias("row"))
        return good.where("_reason is null").drop("_reason"), rejects

    def _append_first(self, good: DataFrame, order: list[str]) -> int:
        """Append the first line of each key that the fact does not hold.  Keys
        and order alone decide, and are written; then the lines are
        shuffled once, to the fact's buckets."""
        keys = list(self.fact_keys)
        won, n = _materialize(insert_or_ignore(self.table("fact_sales"), good.select(*keys, *order), keys, order), "fact_winners")
        if not n:
            return self._append("fact_sales", good.sparkSession.createDataFrame([], SCHEMAS["fact_sales"]))
        buckets = self._buckets()
        won = won.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(ARRIVAL).alias("_won"))
        mine = F.lit(True)
        for i, k in enumerate(keys):
            mine = mine & (F.col(k) == F.col(f"_k{i}"))
        new = (self._dealt("fact_sales", good).join(won.repartition(buckets, *[f"_k{i}" for i in range(len(keys))]), mine)
               .where(F.col(ARRIVAL) == F.col("_won")))
        return self._append("fact_sales", new.withColumn("ingested_at", F.current_timestamp()))

    # S12-S13 --------------------------------------------------------------
    def append_kpis(self, monthly: DataFrame, regional: DataFrame) -> dict[str, int]:
        now = F.current_timestamp()
        return self.transact(lambda: {
            "agg_monthly_kpis": self._append("agg_monthly_kpis", monthly.withColumn("created_at", now)),
            "agg_regional_kpis": self._append("agg_regional_kpis", regional.withColumn("created_at", now))})

    def latest(self, name: str) -> DataFrame:
        """The newest snapshot: the folder that the last commit with one names; no other is read."""
        return self._rows(name, (self._visible(name) or [[]])[-1][-1:])

    # S14 ------------------------------------------------------------------
    def log_run(self, stage: str, status: str, records: int = 0, error: str | None = None,
                duration: float | None = None) -> None:
        row = [(None, stage, status, int(records), error, None if duration is None else float(duration))]
        df = self.spark.createDataFrame(row, SCHEMAS["pipeline_run_log"]).withColumn(
            "run_timestamp", F.current_timestamp())
        self._append("pipeline_run_log", df)

    # reports over the warehouse ---------------------------------------------
    def star(self, root: str | None = None):
        """The warehouse as the wide star every report reads: the fact joined
        once to its dimensions (inner joins on the dimension keys, so the
        reports see conformed rows), written under ``root`` (default: a fresh
        folder in the session's checkpoint folder)."""
        from .star import Star, write_star
        f = self.table("fact_sales")
        dates = self.table("dim_date").select("date_id", "year", "month", "month_name", "quarter")
        cust = self.table("dim_customer").select("customer_id", "segment")
        prod = self.table("dim_product").select("product_id", "product_name", "category")
        wide = (f.join(dates, "date_id").join(cust, "customer_id").join(prod, "product_id")
                .withColumn("order_date", F.to_date("date_id")))
        star = Star(fact=wide, dim_customer=self.table("dim_customer"), dim_product=self.table("dim_product"),
                    dim_date=self.table("dim_date"), dim_region=self.table("dim_region"))
        return write_star(star, root or work_path(self.spark, "star", unique_name("warehouse")))

    # S15 ------------------------------------------------------------------
    def run_load(self, sales: DataFrame, customers: DataFrame, products: DataFrame,
                 monthly: DataFrame, regional: DataFrame) -> int:
        """Create, load dimensions and facts, append KPI snapshots and log, in one
        commit.  A failure leaves no rows; it is logged as FAILED and re-raised."""
        t0 = time.time()

        def load() -> int:
            self.load_dimensions(sales, customers, products)
            n = self.load_fact(sales)
            self.append_kpis(monthly, regional)
            self.log_run("db_load", "SUCCESS", n, duration=round(time.time() - t0, 2))
            return n

        self.create_tables()
        try:
            return self.transact(load)
        except Exception as e:
            self.log_run("db_load", "FAILED", error=str(e))
            raise
