"""The prediction log: rows with ids 1, 2, 3, ... in order of arrival, each batch written once.

Layout: `rows/batch=...` holds what was appended, each row with the task that wrote it and its place in that task;
`ledger/batch=...` holds, per task and kind, the first id and the number of rows, and sum, lowest and highest score. A batch
counts once its ledger entry is there, so one that broke off is written anew, and one that comes again (a stream
repeats its last batch after a restart) changes nothing. Ids are first id plus place: two levels of offsets instead of a
sort or a counter. Summaries merge the ledger and never read rows; the latest rows are found from it.

One writer at a time: several streams into one log must be joined into one.

Nulls and corner cases: null kinds are a kind of their own, null scores count in `n` alone. Empty batches are entered, too, and
take no id. Without any batch all readers give empty frames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PREDICTION = "kind string, input_summary string, score double, created_at timestamp"
_ROWS = f"part int, place long, {PREDICTION}, batch string"
_LEDGER = "part int, kind string, first_id long, n long, scores long, total double, lowest double, highest double, batch string"


class PredictionLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def ledger(self) -> DataFrame:
        """One row per batch, writing task and kind; a batch without rows has one row with n = 0."""
        return self._read("ledger", _LEDGER)

    def append(self, predictions: DataFrame, batch: str, order: Sequence[str] = ()) -> bool:
        """Add `predictions` (the columns of `PREDICTION`) under the name `batch`; False if that batch is already there.

        Ids follow the columns `order` if given, else the order of tasks and their rows. What reaches the driver is one
        row per task and kind.
        """
        if not self.ledger().where(F.col("batch") == batch).isEmpty():
            return False
        if order:
            n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            predictions = predictions.repartitionByRange(n, *order).sortWithinPartitions(*order)
        place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        columns = [c.split()[0] for c in PREDICTION.split(", ")]
        folder = f"{self.path}/rows/batch={batch}"
        predictions.select(F.spark_partition_id().alias("part"), place.alias("place"), *columns).write.mode("overwrite").parquet(folder)

        written = self.spark.read.schema(_ROWS.removesuffix(", batch string")).parquet(folder)
        sums = written.groupBy("part", "kind").agg(
            F.count(F.lit(1)).alias("n"),
            F.count("score").alias("scores"),
            F.sum("score").alias("total"),
            F.min("score").alias("lowest"),
            F.max("score").alias("highest"),
        )
        entries = sorted(sums.collect(), key=lambda r: r["part"])
        next_id = 1 + (self._parts().agg(F.max(F.col("first_id") + F.col("n") - 1)).first()[0] or 0)
        first: dict[int, int] = {}
        sizes: dict[int, int] = {}
        for r in entries:
            sizes[r["part"]] = sizes.get(r["part"], 0) + r["n"]
        for part, n in sizes.items():
            first[part] = next_id
            next_id += n
        rows = [(r["part"], r["kind"], first[r["part"]], *r[2:]) for r in entries]
        # A task's entries share its first id.
        if not rows:
            rows = [(0, None, next_id, 0, 0, None, None, None)]
        schema = _LEDGER.removesuffix(", batch string")
        self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("error").parquet(f"{self.path}/ledger/batch={batch}")
        return True

    def _parts(self) -> DataFrame:
        """(batch, part, first_id, n) of the tasks that wrote rows."""
        by_part = self.ledger().groupBy("batch", "part")
        return by_part.agg(F.min("first_id").alias("first_id"), F.sum("n").alias("n")).where("n > 0")

    def rows(self) -> DataFrame:
        """All predictions with their ids."""
        found = self._read("rows", _ROWS).join(self._parts(), ["batch", "part"])
        return found.select((F.col("first_id") + F.col("place")).alias("id"), "kind", "input_summary", "score", "created_at")

    def summary(self) -> DataFrame:
        """Per kind: number, mean, lowest and highest score, from the ledger alone."""
        return self.ledger().where("n > 0").groupBy("kind").agg(
            F.sum("n").alias("n"),
            F.try_divide(F.sum("total"), F.sum("scores")).alias("avg_score"),
            F.min("lowest").alias("min_score"),
            F.max("highest").alias("max_score"),
        )

    def recent(self, limit: int = 25) -> DataFrame:
        """The latest predictions, newest first. Only files of the batches that hold them are read."""
        ends = self._parts().select("batch", "part", (F.col("first_id") + F.col("n") - 1).alias("last_id"))
        latest = ends.orderBy(F.desc("last_id")).limit(limit).collect()
        if not latest:
            return self.rows().limit(0)
        above = latest[0]["last_id"] - limit
        held = [r for r in latest if r["last_id"] > above]
        wanted = F.col("batch").isin(sorted({r["batch"] for r in held})) & F.col("part").isin(sorted({r["part"] for r in held}))
        found = self._read("rows", _ROWS).where(wanted).join(F.broadcast(self._parts().where(wanted)), ["batch", "part"])
        with_id = found.select((F.col("first_id") + F.col("place")).alias("id"), "kind", "input_summary", "score", "created_at")
        return with_id.where(F.col("id") > above).orderBy(F.desc("id"))
