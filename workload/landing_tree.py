"""The landing tree, written once per session and scale."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet import model
from rivulet.plans.bronze import landing_load
from rivulet.plans.landing_run import run_landing
from rivulet.session import scratch
from rivulet.sources import landing
from rivulet.sources.buckets import BucketStore
from rivulet.sources.control_store import ControlStore
from rivulet.sources.sinks import balanced
from rivulet.streaming.landing_watch import LandingWatch, batch_states
from workload.catalog import query
from workload.changes import RUN, as_of
from workload.inputs import Inputs

_TREES: dict[tuple[str, str], str] = {}


def tree(i: Inputs) -> str:
    """Landing folders of this scale; the write balances big folders over tasks."""
    at = (i.spark.sparkContext.applicationId, i.dir)
    if at not in _TREES:
        path = scratch(i.spark, "landing")
        balanced(i.f_landing, *landing.PARTS).write.partitionBy(*landing.PARTS).parquet(path)
        _TREES[at] = path
    return _TREES[at]


@query(
    "q_landing_scan",
    """SELECT tenant_id, schema_name, table_name, batch_id, l_orderkey, l_linenumber, price, quantity, shipped
       FROM f_landing WHERE tenant_id = 1 AND table_name = 'open_lines' AND batch_id IN (19960101000000, 19980101000000)""",
)
def _(i: Inputs) -> DataFrame:
    return landing.read_landing(
        i.spark, tree(i), tenant_id=1, schema_name="shop", table_name="open_lines",
        batches=[19960101000000, 19980101000000],
    )


_BATCHES = "SELECT DISTINCT tenant_id, schema_name, table_name, batch_id FROM f_landing"


@query("q_landing_batches", _BATCHES)
def _(i: Inputs) -> DataFrame:
    return landing.landing_batches(i.spark, tree(i))


@query("q_landing_inventory")
def _(i: Inputs) -> DataFrame:
    """File counts and sizes depend on the writer, so there is no SQL to compare with."""
    return landing.landing_inventory(i.spark, tree(i))


@query(
    "q_landing_diff",
    """SELECT tenant_id, schema_name, table_name,
              CASE WHEN tenant_id = 2 THEN 'TO_COPY' ELSE 'SKIPPED_SAME' END AS status
       FROM (SELECT DISTINCT tenant_id, schema_name, table_name FROM f_landing) x""",
)
def _(i: Inputs) -> DataFrame:
    """The destination holds everything but tenant 2."""
    here = landing.landing_inventory(i.spark, tree(i))
    return landing.landing_diff(here, here.filter("tenant_id <> 2")).drop("files", "dest_files")


@query(
    "q_pending_batches",
    """SELECT b.tenant_id, b.schema_name, b.table_name, b.batch_id FROM d_batches b
       LEFT JOIN f_watermark w ON w.tenant_id = b.tenant_id AND w.schema_name = b.schema_name AND w.source_table = b.table_name
       WHERE w.last_batch_id IS NULL OR b.batch_id > w.last_batch_id""",
    {"d_batches": _BATCHES},
)
def _(i: Inputs) -> DataFrame:
    return landing.pending_batches(landing.landing_batches(i.spark, tree(i)), i.f_watermark)


@query(
    "q_replay_range",
    """SELECT tenant_id, schema_name, table_name, batch_id FROM d_batches WHERE batch_id >= 19970101000000""",
    {"d_batches": _BATCHES},
)
def _(i: Inputs) -> DataFrame:
    return landing.replay_range(landing.landing_batches(i.spark, tree(i)), first=19970101000000)


@query(
    "q_landing_load",
    """WITH pending AS (
           SELECT f.* FROM f_landing f LEFT JOIN f_watermark w
             ON w.tenant_id = f.tenant_id AND w.schema_name = f.schema_name AND w.source_table = f.table_name
           WHERE f.table_name = 'open_lines' AND (w.last_batch_id IS NULL OR f.batch_id > w.last_batch_id)),
         ranked AS (
           SELECT *, row_number() OVER (PARTITION BY tenant_id, l_orderkey, l_linenumber
               ORDER BY batch_id DESC, price, quantity, shipped) AS rn FROM pending),
         fresh AS (SELECT * FROM ranked WHERE rn = 1),
         loaded AS (
           SELECT tenant_id, l_orderkey, l_linenumber, min(price) AS price, min(quantity) AS quantity, min(shipped) AS shipped,
                  min(batch_id) AS batch_id
           FROM f_landing WHERE table_name = 'filed_lines' GROUP BY tenant_id, l_orderkey, l_linenumber)
       SELECT coalesce(s.tenant_id, t.tenant_id) AS tenant_id, coalesce(s.l_orderkey, t.l_orderkey) AS l_orderkey,
              coalesce(s.l_linenumber, t.l_linenumber) AS l_linenumber, coalesce(s.price, t.price) AS price,
              coalesce(s.quantity, t.quantity) AS quantity, coalesce(s.shipped, t.shipped) AS shipped,
              coalesce(s.batch_id, t.batch_id) AS batch_id, CASE WHEN s.tenant_id IS NULL THEN 'OLD' ELSE 'I' END AS _op
       FROM loaded t FULL JOIN fresh s
         ON t.tenant_id = s.tenant_id AND t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber""",
)
def _(i: Inputs) -> DataFrame:
    """All pending batches of one table in one plan, merged into rows loaded earlier."""
    base = tree(i)
    rows = landing.read_landing(i.spark, base, schema_name="shop", table_name="open_lines")
    todo = landing.pending_batches(landing.landing_batches(i.spark, base), i.f_watermark)
    pending = rows.join(todo, landing.PARTS, "left_semi").drop("schema_name", "table_name")
    target = i.sql(
        """SELECT tenant_id, l_orderkey, l_linenumber, min(price) AS price, min(quantity) AS quantity,
                  min(shipped) AS shipped, min(batch_id) AS batch_id, 'OLD' AS _op
           FROM f_landing WHERE table_name = 'filed_lines' GROUP BY tenant_id, l_orderkey, l_linenumber"""
    )
    # the tie-break inside a batch goes by the columns in this order
    pending = pending.select("tenant_id", "l_orderkey", "l_linenumber", "price", "quantity", "shipped", "batch_id")
    return landing_load(target, pending, ["l_orderkey", "l_linenumber"], run_id=RUN, as_of=as_of())


_RUN_PENDING = """
    SELECT f.tenant_id, f.schema_name, f.table_name, f.batch_id, count(*) AS n FROM f_landing f
    LEFT JOIN f_watermark w ON w.tenant_id = f.tenant_id AND w.schema_name = f.schema_name AND w.source_table = f.table_name
    WHERE w.last_batch_id IS NULL OR f.batch_id > w.last_batch_id GROUP BY ALL"""


@query(
    "q_landing_cycle",
    """SELECT 'result' AS kind, tenant_id, table_name AS name, batch_id, n AS value,
              CASE WHEN table_name = 'open_lines' THEN 'SUCCESS' ELSE 'SKIPPED' END AS status FROM
           (SELECT tenant_id, table_name, batch_id, CASE WHEN table_name = 'open_lines' THEN n ELSE 0 END AS n FROM d_pending)
       UNION ALL
       SELECT 'mark', tenant_id, name, max(batch_id), NULL, NULL FROM (
           SELECT tenant_id, table_name AS name, batch_id FROM d_pending WHERE table_name = 'open_lines'
           UNION ALL SELECT tenant_id, source_table, last_batch_id FROM f_watermark) GROUP BY ALL
       UNION ALL
       SELECT 'gate', NULL, NULL, batch_id, NULL, NULL FROM (
           SELECT DISTINCT batch_id FROM d_pending WHERE table_name = 'open_lines' AND batch_id > 19940101000000
           UNION SELECT 19940101000000)""",
    {"d_pending": _RUN_PENDING},
)
def _(i: Inputs) -> DataFrame:
    """A landing run over the tree: one table is registered, the other is skipped; marks and gate move on."""
    spark = i.spark
    registry = spark.createDataFrame([("shop", "open_lines", "lines", "l_orderkey,l_linenumber", True)], model.REGISTRY)
    gate = spark.createDataFrame([(19940101000000, None, "before")], model.GATE)
    target = i.sql(
        """SELECT tenant_id, l_orderkey, l_linenumber, price, quantity, shipped, batch_id, 'OLD' AS _op
           FROM f_landing WHERE table_name = 'filed_lines' AND l_linenumber < 0"""
    )
    marks = i.f_watermark.withColumn("updated_on", as_of())
    run = run_landing(tree(i), registry, {"lines": target}.get, marks, gate, run_id=RUN, as_of=as_of())
    none = F.lit(None)
    result = run.results.select(
        F.lit("result").alias("kind"), "tenant_id", F.col("source_table").alias("name"), "batch_id",
        F.col("inserted_rows").alias("value"), "status",
    )
    mark = run.watermarks.select(
        F.lit("mark"), "tenant_id", "source_table", "last_batch_id", none.cast("bigint"), none.cast("string")
    )
    opened = run.gate.select(
        F.lit("gate"), none.cast("int"), none.cast("string"), "batch_id", none.cast("bigint"), none.cast("string")
    )
    return result.union(mark).union(opened)


LINES = model.shape(
    "tenant_id int, l_orderkey bigint, l_linenumber int, price double, quantity int, shipped timestamp_ntz, batch_id bigint, _op string"
)


@query(
    "q_landing_widen",
    """SELECT tenant_id, l_orderkey, l_linenumber, price, CAST(quantity AS DECIMAL(21,2)) AS quantity, shipped, batch_id, 'I' AS _op FROM (
           SELECT *, row_number() OVER (PARTITION BY tenant_id, l_orderkey, l_linenumber
                                        ORDER BY batch_id DESC, price, quantity, shipped) AS rn
           FROM f_landing WHERE table_name = 'open_lines') x WHERE rn = 1""",
)
def _(i: Inputs) -> DataFrame:
    """Batches bring the quantity as int, later as long, later as decimal: the table's column grows with them."""
    base = scratch(i.spark, "landing-types")
    lines = i.f_landing.filter("table_name = 'open_lines'")
    for kind, years in (("int", "< 1996"), ("bigint", "= 1996"), ("decimal(12,2)", "> 1996")):
        part = lines.filter(f"batch_id div 10000000000 {years}").withColumn("quantity", F.col("quantity").cast(kind))
        balanced(part, *landing.PARTS).write.mode("append").partitionBy(*landing.PARTS).parquet(base)
    tables = BucketStore(i.spark, f"{base}-bronze", {"lines": LINES}, {"lines": ["l_orderkey", "l_linenumber"]}, 8)
    registry = i.spark.createDataFrame([("shop", "open_lines", "lines", "l_orderkey,l_linenumber", True)], model.REGISTRY)
    kept = ControlStore(i.spark, f"{base}-control")
    run_landing(base, registry, tables, run_id=RUN, as_of=as_of(), kept=kept)
    return tables.read("lines")


_WATCHED = """
    SELECT DISTINCT tenant_id, schema_name, table_name, batch_id,
           CASE WHEN tenant_id = 1 AND batch_id < 19950101000000 THEN 1 WHEN batch_id > 19970101000000 THEN 1 ELSE 0 END AS look
    FROM f_landing WHERE table_name = 'open_lines'"""


@query(
    "q_landing_watch",
    """SELECT w.tenant_id, w.schema_name, w.table_name, w.batch_id, CAST(w.look AS BIGINT) AS look,
              CASE WHEN w.look = 0 THEN 'LOADED' WHEN w.batch_id <= t.top THEN 'LATE' ELSE 'PENDING' END AS state
       FROM d_watched w LEFT JOIN (SELECT tenant_id, max(batch_id) AS top FROM d_watched WHERE look = 0 GROUP BY tenant_id) t
            ON t.tenant_id = w.tenant_id""",
    {"d_watched": _WATCHED},
)
def _(i: Inputs) -> DataFrame:
    """Two looks at a growing tree. What the first one found is loaded; of the second one's, some came below the mark."""
    base = scratch(i.spark, "landing-watch")
    lines = i.f_landing.filter("table_name = 'open_lines'").join(i.sql("SELECT * FROM d_watched", {"d_watched": _WATCHED}), landing.PARTS)
    watch = LandingWatch(i.spark, f"{base}/tree", f"{base}/state")
    for look in (0, 1):
        balanced(lines.filter(F.col("look") == look).drop("look"), *landing.PARTS).write.mode("append").partitionBy(*landing.PARTS).parquet(f"{base}/tree")
        new = watch.look()
    loaded = watch.found().filter("look = 0")
    marks = loaded.groupBy("tenant_id", "schema_name", F.col("table_name").alias("source_table")).agg(F.max("batch_id").alias("last_batch_id"))
    assert new.filter("look = 0").isEmpty()
    return batch_states(watch.found(), loaded, marks).join(watch.found().select(*landing.PARTS, "look"), landing.PARTS)


@query(
    "q_landing_files",
    """SELECT tenant_id, schema_name, table_name, count(DISTINCT batch_id) AS files, TRUE AS sized
       FROM f_landing GROUP BY tenant_id, schema_name, table_name""",
)
def _(i: Inputs) -> DataFrame:
    """Where the writer puts each batch into one file, the inventory's file counts are those of the batches."""
    path = scratch(i.spark, "landing-files")
    i.f_landing.repartition(*landing.PARTS).write.partitionBy(*landing.PARTS).parquet(path)
    found = landing.landing_inventory(i.spark, path)
    return found.select("tenant_id", "schema_name", "table_name", "files", (F.col("bytes") > 0).alias("sized"))
