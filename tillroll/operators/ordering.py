"""Window ranking without a single-task window.

``RANK() OVER (ORDER BY x)`` with no ``PARTITION BY`` (or partitioned by a
handful of regions) makes Spark move every row into one task.  For millions
of customers or products that task is the job.  :func:`ranked_by` computes the
same numbers from counts per bucket, with one plan for every size:

1. A bounded sample of the sort keys, *including the rows' unique key*, gives
   cut points, so that bucket ``b`` holds a contiguous slice of the global order
   and even a value shared by a third of all rows is cut into many buckets.
2. One aggregate counts each bucket's rows, sums and distinct values, and the
   rows that hold the value of the cut before or after it.  Windows over
   these counts (a row for each bucket and partition) give what lies before
   each bucket, and where the groups that cross a cut begin and end.
3. Windows within a bucket rank its rows; a row's global value is its local one
   plus the bucket's offset.  All outputs of one order share one exchange, by
   bucket, and none of it is written.

The counts are written, so their size is known: up to :data:`BROADCAST_ROWS`
they are broadcast, beyond that they are joined by key.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import cmp_to_key, reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shuffle_partitions, unique_name, work_path

Order = Sequence[tuple[str, bool]]  # (column, ascending)

BUCKET_ROWS = 1_000_000    # target rows per bucket
SAMPLE = 60                # sampled keys per bucket, on the driver
BROADCAST_ROWS = 200_000   # counts that are broadcast, at most


def materialize(df: DataFrame, label: str = "table") -> tuple[DataFrame, int]:
    """Write ``df`` once as Parquet in the shared checkpoint folder and return
    a reader over it plus its exact row count (observed during the write, no
    extra pass).  Cuts the lineage and makes later reads deterministic."""
    spark = df.sparkSession
    path = work_path(spark, "tables", unique_name(label))
    obs = Observation(unique_name("rows"))
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), int(obs.get["rows"])


def bucket_count(spark, rows: int | None) -> int:
    """Two buckets for each shuffle partition (buckets are dealt to tasks by
    hash), and more when ``rows`` would put over BUCKET_ROWS in one."""
    return max(2 * shuffle_partitions(spark), -(-(rows or 0) // BUCKET_ROWS))


def _sorted(col: str, asc: bool) -> Column:
    return F.col(col).asc() if asc else F.col(col).desc()


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _follows(order: Order):
    """Python's comparison of sampled keys, as Spark sorts them: nulls first
    when ascending, last when descending; NaN above all numbers."""
    def weight(v):
        return (v is not None, v != v, 0 if v is None or v != v else v)

    def compare(a, b) -> int:
        for x, y, (_, asc) in zip(a, b, order, strict=True):
            x, y = weight(x), weight(y)
            if x != y:
                return (-1 if x < y else 1) * (1 if asc else -1)
        return 0
    return cmp_to_key(compare)


def cut_points(keys: Sequence[tuple], order: Order, buckets: int) -> list[tuple]:
    """Up to ``buckets - 1`` different keys that cut the sampled ``keys`` evenly."""
    ordered = sorted(keys, key=_follows(order))
    cuts = [ordered[len(ordered) * i // buckets] for i in range(1, buckets)] if ordered else []
    return [c for i, c in enumerate(cuts) if not i or c != cuts[i - 1]]


def literal(value, kind: T.DataType) -> str:
    """A sampled value as SQL text."""
    if value is None:
        return f"CAST(NULL AS {kind.simpleString()})"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"CAST('{text}' AS {kind.simpleString()})"


def bucket_of(df: DataFrame, order: Order, cuts: Sequence[tuple]) -> Column:
    """The bucket of a row: how many cuts its key has reached, by bisection.
    As SQL text, which the driver forms much faster than column objects."""
    kinds = [df.schema[c].dataType for c, _ in order]

    def before(cut) -> str:
        """The row's key precedes the cut."""
        out = "false"
        for (c, asc), v, kind in reversed(list(zip(order, cut, kinds, strict=True))):
            x, value = f"`{c}`", literal(v, kind)
            if v is None:
                less = "false" if asc else f"{x} IS NOT NULL"
            else:
                less = f"({x} IS NULL OR {x} < {value})" if asc else f"coalesce({x} > {value}, false)"
            out = f"({less} OR ({x} <=> {value} AND {out}))"
        return out

    def pick(low: int, high: int) -> str:
        if low == high:
            return str(low)
        mid = (low + high) // 2
        return f"CASE WHEN {before(cuts[mid])} THEN {pick(low, mid)} ELSE {pick(mid + 1, high)} END"
    return F.expr(pick(0, len(cuts)))


class _Slices:
    """One order of ``df``, cut into buckets (column ``name``)."""

    def __init__(self, df: DataFrame, order: Order, tie: Sequence[str], keys: Sequence[tuple], buckets: int, name: str):
        self.order, self.name = list(order), name
        full = [*order, *[(c, True) for c in tie]]
        cuts = cut_points(keys, full, buckets)
        self.bucket = bucket_of(df, full, cuts)
        # the values of the cuts (without the tie); runs of cuts that share them
        values = [c[:len(order)] for c in cuts]
        runs = [0] * len(values)
        for i in range(1, len(values)):
            runs[i] = runs[i - 1] if values[i] == values[i - 1] else i
        self.columns = [F.expr(f"array({', '.join(literal(v[k], df.schema[c].dataType) for v in values)})") for k, (c, _) in enumerate(order)]
        self.runs = F.expr(f"array({', '.join(map(str, runs))})") if runs else None
        self.tie = list(tie)

    def at_cut(self, after: bool) -> Column:
        """The row holds the value of the cut after (or before) its bucket."""
        if self.runs is None:
            return F.lit(False)
        b = F.col(self.name)
        place = b if after else b - 1
        same = _all([F.col(c).eqNullSafe(F.get(values, place)) for values, (c, _) in zip(self.columns, self.order, strict=True)])
        return same & (place >= 0) & F.get(self.runs, place).isNotNull()

    def run(self, after: bool) -> Column:
        """Which run of cuts of one value the cut after (before) the bucket is in."""
        if self.runs is None:
            return F.lit(None).cast("int")
        return F.get(self.runs, F.col(self.name) if after else F.col(self.name) - 1)

    def counts(self, df: DataFrame, part: Sequence[str], sums: Sequence[str], distinct: bool) -> DataFrame:
        """A row for each partition and bucket: what the rows' local values need to become global."""
        b = self.name
        keys = [*part, b]
        rows = df.withColumn(b, self.bucket).withColumns({"_head": self.at_cut(False), "_tail": self.at_cut(True)})
        adds = [F.count(F.lit(1)).alias("_n"), F.sum(F.col("_head").cast("long")).alias("_heads"),
                F.sum(F.col("_tail").cast("long")).alias("_tails"), *[F.sum(c).alias(f"_s_{c}") for c in sums]]
        if distinct:      # values first, then buckets: no expansion of the rows
            held = ["_n", "_heads", "_tails", *[f"_s_{c}" for c in sums]]
            rows = rows.groupBy(*keys, *[c for c, _ in self.order if c not in part]).agg(*adds)
            adds = [*[F.sum(c).alias(c) for c in held], F.count(F.lit(1)).alias("_d")]
        w = Window.partitionBy(*part).orderBy(b)
        before = w.rowsBetween(Window.unboundedPreceding, -1)
        here = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        zero = F.lit(0).cast("long")
        t = rows.groupBy(*keys).agg(*adds).withColumns({"_off": F.coalesce(F.sum("_n").over(before), zero), "_t": self.run(True), "_h": self.run(False)})
        # A value crosses a cut where the rows before hold it too; between two cuts of one value there is nothing else.
        t = t.withColumn("_cont", (F.col("_heads") > 0) & F.coalesce((F.lag("_t").over(w) == F.col("_h")) & (F.lag("_tails").over(w) > 0), F.lit(False)))
        whole = F.coalesce((F.col("_h") == F.col("_t")) & (F.col("_tails") == F.col("_n")), F.lit(False))
        t = t.withColumns({"_whole": whole, "_next": F.coalesce(F.lead("_cont").over(w), F.lit(False))})
        t = t.withColumn("_start", F.last(F.when(~(F.col("_whole") & F.col("_cont")), F.col("_off") + F.col("_n") - F.col("_tails") + 1), ignorenulls=True).over(here))
        back = Window.partitionBy(*part).orderBy(F.col(b).desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        t = t.withColumn("_end", F.last(F.when(~(F.col("_whole") & F.col("_next")), F.col("_off") + F.col("_heads")), ignorenulls=True).over(back))
        out = {"_first": F.when(F.col("_cont"), F.lag("_start").over(w)), "_last": F.when(F.col("_next"), F.lead("_end").over(w)),
               "_all": F.sum("_n").over(Window.partitionBy(*part)), **{f"_soff_{c}": F.sum(f"_s_{c}").over(before) for c in sums}}
        if distinct:
            out["_doff"] = F.coalesce(F.sum(F.col("_d") - F.col("_cont").cast("long")).over(before), zero) - F.col("_cont").cast("long")
        return t.select(*keys, "_off", *[c.alias(n) for n, c in out.items()])

    def add(self, df: DataFrame, counts: DataFrame, few: bool, spec: dict) -> DataFrame:
        """``df``, which holds the bucket, with one spec's outputs."""
        part, sums, outputs = list(spec.get("partition", ())), list(spec.get("sums", ())), spec["outputs"]
        order, tie = [_sorted(c, a) for c, a in self.order], [F.col(c).asc() for c in self.tie]
        w = Window.partitionBy(self.name, *part)
        keys = [*part, self.name]
        side = counts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *counts.columns[len(keys):])
        met = df.join(F.broadcast(side) if few else side, _all([F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]))
        off = F.col("_off")
        parts = {
            "_rank": lambda: F.when(self.at_cut(False) & F.col("_first").isNotNull(), F.col("_first")).otherwise(off + F.rank().over(w.orderBy(*order))),
            "_pos": lambda: off + F.row_number().over(w.orderBy(*order, *tie)),
            "_rank_last": lambda: F.when(self.at_cut(True) & F.col("_last").isNotNull(), F.col("_last")).otherwise(
                off + F.rank().over(w.orderBy(*order)) + F.count(F.lit(1)).over(Window.partitionBy(self.name, *part, *[c for c, _ in self.order])) - 1),
            "_dense": lambda: F.col("_doff") + F.dense_rank().over(w.orderBy(*order)),
            "_n": lambda: F.col("_all"),
            **{f"_cum_{c}": lambda c=c: F.when(F.col(f"_soff_{c}").isNull(), F.sum(c).over(self._running(w, order, tie))).otherwise(
                F.col(f"_soff_{c}") + F.coalesce(F.sum(c).over(self._running(w, order, tie)), F.lit(0))) for c in sums}}
        wanted = list(dict.fromkeys(p for what in outputs.values() for p in _parts(what)))
        met = met.withColumns({p: parts[p]().cast("long") if not p.startswith("_cum_") else parts[p]() for p in wanted})
        return met.select(*df.columns, *[_output(what).alias(name) for name, what in outputs.items()])

    @staticmethod
    def _running(w, order, tie):
        return w.orderBy(*order, *tie).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def ntile(n: int, pos: str = "_pos", count: str = "_n") -> Column:
    """NTILE(n) from a 1-based row position and the partition size: the
    first ``count % n`` tiles hold one row more."""
    p, cnt = F.col(pos), F.col(count)
    size = F.floor(cnt / F.lit(n)).cast("long")
    rem = (cnt - size * n).cast("long")
    cut = rem * (size + 1)
    small = F.floor((p - 1) / (size + 1)).cast("long") + 1
    large = rem + F.floor((p - cut - 1) / F.greatest(size, F.lit(1))).cast("long") + 1
    return F.when(p <= cut, small).otherwise(large).cast("long")


def percent_rank(rank: str = "_rank", count: str = "_n") -> Column:
    """(rank - 1) / (n - 1); 0 for a single-row partition."""
    return F.when(F.col(count) <= 1, F.lit(0.0)).otherwise(
        (F.col(rank) - 1).cast("double") / (F.col(count) - 1).cast("double"))


def average_rank_int(rank: str = "_rank", last: str = "_rank_last") -> Column:
    """pandas ``rank(method='average')`` truncated to int: the mean of the
    first and last tied positions, floored."""
    return F.floor((F.col(rank) + F.col(last)) / 2).cast("long")


def _parts(what: str) -> list[str]:
    """The numbers that an output is made of."""
    if what.startswith("ntile"):
        return ["_pos", "_n"]
    if what.startswith("cum_"):
        return [f"_{what}"]
    made_of = {"rank": ["_rank"], "dense_rank": ["_dense"], "row_number": ["_pos"], "percent_rank": ["_rank", "_n"],
               "average_rank": ["_rank", "_rank_last"], "count": ["_n"], "rank_desc": ["_n", "_rank_last"]}
    if what not in made_of:
        raise ValueError(f"unknown ranking output {what!r}")
    return made_of[what]


def _output(what: str) -> Column:
    if what.startswith("ntile"):
        return ntile(int(what[5:]))
    return {"percent_rank": percent_rank, "average_rank": average_rank_int,
            "rank_desc": lambda: F.col("_n") - F.col("_rank_last") + 1}.get(what, lambda: F.col(_parts(what)[0]))()


def ranked(df: DataFrame, order: Order, tie: Sequence[str] = (), partition: Sequence[str] = (),
           outputs: dict[str, str] | None = None, sums: Sequence[str] = (),
           buckets: int | None = None, rows: int | None = None) -> DataFrame:
    """``df`` with one more column for each of ``outputs``, which maps its
    name to one of ``rank, dense_rank, row_number, percent_rank,
    average_rank, count, rank_desc, ntile<N>`` or ``cum_<c>``.  ``tie`` is
    the rows' unique key."""
    return ranked_by(df, tie, [dict(order=order, partition=partition, outputs=outputs or {}, sums=sums)], buckets, rows)


def ranked_by(df: DataFrame, tie: Sequence[str], orders: Sequence[dict], buckets: int | None = None,
              rows: int | None = None) -> DataFrame:
    """Several orders of one table (see :func:`ranked`).  ``df`` is read once
    for the sample, once for each order's counts and once for the result, so
    pass a written table and its number of ``rows``; the counts are independent
    small jobs and are submitted together.  Specs that give the same ``order``
    share its buckets and their exchange."""
    tie, spark = list(tie), df.sparkSession
    rows = df.count() if rows is None else rows
    nb = int(buckets or bucket_count(spark, rows))
    groups: dict[tuple, list[dict]] = {}
    for spec in orders:
        groups.setdefault(tuple(spec["order"]), []).append(spec)
    needed = list(dict.fromkeys([*[c for order in groups for c, _ in order], *tie]))
    sample = df.select(*needed).sample(min(1.0, SAMPLE * nb / max(rows, 1)), 7).collect()
    slices = [_Slices(df, order, tie, [tuple(r[c] for c in [*[c for c, _ in order], *tie]) for r in sample], nb, f"_b{i}")
              for i, order in enumerate(groups)]
    todo = [(s, spec) for s, specs in zip(slices, groups.values(), strict=True) for spec in specs]

    def count(job: tuple[_Slices, dict]) -> tuple[DataFrame, int]:
        s, spec = job
        distinct = any("_dense" in _parts(what) for what in spec["outputs"].values())
        return materialize(s.counts(df, list(spec.get("partition", ())), list(spec.get("sums", ())), distinct), "bucket_counts")

    with ThreadPoolExecutor(max_workers=max(1, len(todo))) as pool:
        counted = list(pool.map(count, todo))
    out = df
    for s in slices:
        out = out.withColumn(s.name, s.bucket)
        for (owner, spec), (counts, size) in zip(todo, counted, strict=True):
            if owner is s:
                out = s.add(out, counts, size <= BROADCAST_ROWS, spec)
        out = out.drop(s.name)
    return out
