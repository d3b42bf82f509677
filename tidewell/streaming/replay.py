"""Run streaming jobs over the input tables, in several micro-batches, to their end.

Used by the named queries `stream_*`: the same tables arrive as streams, cut into slices of
rising time that come one micro-batch each, the streaming operators process them with state
carried from batch to batch, and the stored result is returned.  A last record far in the
future moves the watermarks past everything; results leave it out.
"""

from __future__ import annotations

import datetime
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell import schemas as s
from tidewell.operators import logs
from tidewell.plans import trade
from tidewell.sinks.batches import BATCH, collect_garbage, hadoop
from tidewell.sinks.keyed import KeyedTable
from tidewell.sinks.messages import append
from tidewell.sources import tables
from tidewell.streaming import jobs
from tidewell.streaming.meet import meet

SLICES = 4
TIMES = {"events": "ts", "orders": "o_orderdate", "lineitem": "l_shipdate"}
END = datetime.datetime(2100, 1, 1)
FLUSH = {
    "events": (-1, END, -1, "view", 0.0, '{"k": 99}'),
    "orders": (-1, 0, "P", 0.0, END, ""),
    "lineitem": (-1, 0, 0, -1, 1.0, 0.0, 0.09, 0.0, "R", "F", END),
}
# The test tables have order lines days after their orders, so records meet within years.
BOUND = "7300 days"


def work_folder(spark: SparkSession) -> str:
    """A new folder below the cluster's shared checkpoint folder.

    Only a session of one machine may lack that setting; it gets a folder below its warehouse.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    shared = shared or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/replay-{uuid.uuid4().hex}"


@dataclass(frozen=True)
class Tables(jobs.Warehouse):
    """A warehouse whose raw topics are the input tables; all else is as it is in production."""

    replay: Replay | None = None

    def pages(self) -> DataFrame:
        return tables.page_views(self.spark, self.replay.folder, self.replay.sliced, items=True)

    def messages(self, name: str) -> DataFrame:
        return tables.log_messages(self.spark, self.replay.folder, self.replay.sliced)

    def changes(self, table: str) -> DataFrame:
        return tables.change_feed(self.spark, self.replay.folder, self.replay.sliced)(table)

    def dictionary(self, spark: SparkSession) -> DataFrame:
        return tables.base_dic(spark)


class Replay:
    """The streaming jobs over one folder of tables."""

    def __init__(self, spark: SparkSession, folder: str, size: str = "1 day"):
        self.spark = spark
        self.folder = folder
        root = work_folder(spark)
        self.input = f"{root}/tables"
        self.files: dict[str, int] = {}
        self.w = Tables(
            spark, root, size=size, order_bound=BOUND, refund_bound=BOUND,
            trigger={"availableNow": True}, replay=self,
        )

    # -- input ------------------------------------------------------------
    def sliced(self, name: str) -> DataFrame:
        """The table as a stream: one slice of rising time to a micro-batch."""
        if name not in self.files:
            rows = tables.table(self.spark, self.folder, name)
            path = f"{self.input}/{name}.parquet"
            self.files[name] = rows.rdd.getNumPartitions()
            if name not in TIMES:
                rows.write.parquet(path)
            else:
                at = F.unix_micros(F.col(TIMES[name]).cast("timestamp"))
                shares = [i / SLICES for i in range(1, SLICES)]
                marks = rows.select(at.cast("double").alias("at")).approxQuantile("at", shares, 0.01)
                for lo, hi in zip([None, *marks], [*marks, None]):
                    # Rows without a time come with the first slice.
                    part = rows if lo is None else rows.where(at >= lo)
                    part = part if hi is None else part.where((at < hi) | (at.isNull() if lo is None else F.lit(False)))
                    part.write.mode("append").parquet(path)
                last = self.spark.createDataFrame([FLUSH[name]], rows.schema)
                last.write.mode("append").parquet(path)
        return tables.table(self.spark, self.input, name, self.files[name])

    # -- running ----------------------------------------------------------
    def run(self, *names: str) -> None:
        """Run jobs to their end, one after the other."""
        for name in names:
            jobs.JOBS[name](self.w).awaitTermination()
            self.forget()

    def forget(self) -> None:
        """Drop the state, offsets and shuffles of the jobs that have ended; none is started again."""
        fs, at = hadoop(self.spark, self.w.checkpoint(""))
        fs.delete(at, True)
        collect_garbage(self.spark)

    def detail(self, *names: str) -> DataFrame:
        """The detail of the last of these jobs, without the record that moves the watermarks."""
        self.run(*names)
        key = "order_id" if "order_id" in jobs.DETAILS[names[-1]] else jobs.DETAILS[names[-1]][0]
        return self.w.detail(names[-1], stream=False).where(F.col(key) != "-1")

    def window(self, *names: str) -> DataFrame:
        """The summary of the last of these jobs."""
        self.run(*names)
        return self.w.summary(names[-1]).read(self.spark).where(F.col("stt") < F.lit(END))

    def visits(self, name: str) -> DataFrame:
        self.run(name)
        return self.w.rows(name, s.PAGE_VIEW, stream=False).where("seq >= 0")

    def routed_topics(self) -> DataFrame:
        self.run("traffic")
        return self.w.rows("traffic", s.TOPIC_MESSAGE, stream=False).where("seq >= 0")

    def dirty(self) -> DataFrame:
        self.run("dirty")
        return self.w.rows(logs.DIRTY, s.MESSAGE, stream=False)

    def upserted(self, name: str, *before: str) -> DataFrame:
        """One row per key, as the keyed table holds it."""
        self.run(*before, name, f"{name}_keyed")
        return self.w.upserted(name).where("order_id <> '-1'")

    def paid_near_update(self, bound: str) -> DataFrame:
        """Payments and order updates that meet in the stateful join."""
        updates = trade.order_versions(self.w.changes).where("type = 'update'").select(
            "oi_id", "order_status", F.col("event_time").alias("oi_time")
        )
        paid = trade.payments(self.w.changes).select("pay_order", "callback_time", "pay_time")
        met = meet(paid, updates, ("pay_order", "oi_id"), ("pay_time", "oi_time"), bound)
        path = self.w.folder("paid_near_update")
        append(met, path, self.w.checkpoint("paid_near_update"), trigger=self.w.trigger).awaitTermination()
        rows = self.spark.read.schema(met.schema).parquet(path).where("oi_id <> '-1'")
        return rows.select(F.col("pay_order").alias("order_id"), "callback_time", "order_status")

    def merged(self, rows: DataFrame, keys: list[str], rules: dict[str, str], times: int = 2) -> DataFrame:
        """A stream added to a keyed table by merge rules; its batches come `times` times."""
        table = KeyedTable(self.w.folder("merged"), rows.schema, keys, rules=rules, version=["event_id"], fold_every=2)

        def write(batch: DataFrame, number: int) -> None:
            for _ in range(times):
                table.write(batch, number)

        rows.writeStream.foreachBatch(write).option("checkpointLocation", table.checkpoint).trigger(
            **self.w.trigger
        ).start().awaitTermination()
        return table.read(self.spark)

    def summed_changes(self, *names: str) -> DataFrame:
        """What the batches of a summary held, read as a stream out of its keyed table."""
        self.run(*names)
        table = self.w.summary(names[-1])
        path = self.w.folder("summed_changes")
        rows = table.changes(self.spark).drop(BATCH)
        append(rows, path, self.w.checkpoint("summed_changes"), trigger=self.w.trigger).awaitTermination()
        metrics = [c for c in table.schema.names if c not in table.keys]
        found = self.spark.read.schema(table.schema).parquet(path).where(F.col("stt") < F.lit(END))
        return found.groupBy(*table.keys).agg(*[F.sum(m).alias(m) for m in metrics])

    # -- dimensions -------------------------------------------------------
    def dimensions(self) -> DataFrame:
        changes = tables.master_change_log(self.spark, self.folder, self.sliced)
        jobs.sync_dimensions(self.w, changes, tables.dim_config_log).awaitTermination()
        return self.w.dimensions().read(self.spark)

    def dimension_tables(self) -> DataFrame:
        """The cells of all tables that the configuration has made in the catalog."""
        self.w = replace(self.w, catalog=f"dims_{uuid.uuid4().hex}")
        self.dimensions()
        made = self.w.dimension_tables()
        cells = None
        for entry in self.spark.catalog.listTables(self.w.catalog):
            columns = made.columns(self.spark, entry.name)
            rows = self.spark.table(made.name(entry.name)).select("_pk", *columns)
            part = rows.unpivot(["_pk"], columns, "name", "value").select(
                F.lit(entry.name).alias("sink_table"), F.col("_pk").alias("pk"), "name", "value"
            )
            cells = part if cells is None else cells.unionByName(part)
        return cells
