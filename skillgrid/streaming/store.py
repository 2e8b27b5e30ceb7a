"""Statistics and their averages that follow new, late and replaced cells.

A store holds cells, the statistics of each date and lead, a ledger with how complete each is, and the state
of the averages: sums and counts, to which the statistics of a date are added and from which they are subtracted. So averages over
all dates (A13), their global means (A14) and averages of several stores (A19) are renewed by reading only the dates that a batch
touches. Sums are exact decimals: what was added can be taken away again without a trace, in any order.

Every batch writes a version of its own and is then committed by one row. What is not committed is not
read, so a batch that failed, or that a stream hands over twice, may be repeated.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.align import small
from ..operators.statistics import weighted_mean

#: Sums hold 18 digits before the point and 20 after it.
SUM_TYPE = "decimal(38,20)"


def contribution(stats: DataFrame, keys: list[str], values: list[str], sign: int = 1) -> DataFrame:
    """(keys, stat, total, n, missing) of statistics of some dates: what averages gain by them, or lose (``sign`` -1)."""
    long = stats.unpivot(keys, values, "stat", "value")
    x = F.col("value")
    return long.groupBy(*keys, "stat").agg(
        (F.sum(F.coalesce(x, F.lit(0.0)).cast(SUM_TYPE)) * sign).cast(SUM_TYPE).alias("total"), (F.count(x) * sign).alias("n"), (F.count_if(x.isNull()) * sign).alias("missing")
    )


def merged(states: list[DataFrame], keys: list[str]) -> DataFrame:
    """States of disjoint dates, and contributions, as one; keys without dates are gone."""
    every = reduce(lambda a, b: a.unionByName(b), states)
    total = every.groupBy(*keys, "stat").agg(F.sum("total").cast(SUM_TYPE).alias("total"), F.sum("n").alias("n"), F.sum("missing").alias("missing"))
    return total.where("n <> 0 OR missing <> 0")


def averages(state: DataFrame, keys: list[str], strict: bool = False) -> DataFrame:
    """(keys, stat, n, avg): averages over dates, skipping what is missing (A13), or missing where any date is."""
    mean = F.try_divide(F.col("total").cast("double"), F.col("n"))
    return state.select(*keys, "stat", "n", (F.when(F.col("missing") == 0, mean) if strict else mean).alias("avg"))


def global_means(state: DataFrame, weights: DataFrame, keys: list[str], cell: tuple[str, ...] = ("lat_idx", "lon_idx")) -> DataFrame:
    """(keys, stat, glo): weighted means over cells of the averages (A14); weights (cell, weight)."""
    maps = averages(state, [*keys, *cell]).join(small(weights), list(cell))
    return maps.groupBy(*keys, "stat").agg(weighted_mean(F.col("avg"), F.col("weight")).alias("glo"))


class VerificationStore:
    """A folder of cells, statistics and averages.

    ``compute`` makes statistics (keys, group, values) of cells (keys, cell, ...). ``expected`` has the number of cells (keys, n_expected)
    of a whole date and lead; those not in it, and a number of null, count as whole with any number.
    """

    def __init__(
        self, spark: SparkSession, path: str, compute: Callable[[DataFrame], DataFrame], expected: DataFrame, keys: tuple[str, str] = ("init_date", "lead"),
        cell: tuple[str, ...] = ("lat_idx", "lon_idx"), group: tuple[str, ...] = ("region",), values: tuple[str, ...] = ("rms", "acorr"),
    ) -> None:
        self.spark, self.path, self.compute, self.expected = spark, path, compute, expected
        self.keys, self.cell, self.group, self.values = list(keys), list(cell), list(group), list(values)
        #: Averages are by everything but the date.
        self.average_keys = [*self.keys[1:], *self.group]

    def _read(self, what: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.path}/{what}")
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return None

    def version(self) -> int:
        """The number of the last committed batch, 0 before the first."""
        commits = self._read("commits")
        return 0 if commits is None else commits.agg(F.max("version")).first()[0] or 0

    def _batches(self) -> set[str]:
        commits = self._read("commits")
        return set() if commits is None else {r["batch"] for r in commits.where("batch IS NOT NULL").select("batch").distinct().collect()}

    def _at(self, what: str, version: int) -> DataFrame | None:
        return self._read(f"{what}/version={version}") if version else None

    def ledger(self) -> DataFrame | None:
        """(keys, n_expected, n_stored, whole, made): how complete each date and lead is, and the version that holds its statistics."""
        return self._at("ledger", self.version())

    def state(self) -> DataFrame | None:
        return self._at("state", self.version())

    def open_keys(self) -> DataFrame | None:
        """Dates and leads that still lack cells."""
        found = self.ledger()
        return None if found is None else found.where("NOT whole").select(*self.keys, "n_expected", "n_stored")

    def statistics(self) -> DataFrame | None:
        """Statistics of all dates and leads, whole or not, as of the last commit."""
        found = self._read("statistics")
        return None if found is None else found.join(small(self.ledger().select(*self.keys, F.col("made").alias("version"))), [*self.keys, "version"]).drop("version")

    def _stored_cells(self, touched: DataFrame, version: int) -> DataFrame | None:
        found = self._read("cells")
        if found is None or not version:
            return None
        # folders of other dates and leads, and of what failed, are pruned
        return found.where(F.col("version") <= version).join(F.broadcast(touched), self.keys)

    def add(self, cells: DataFrame, batch: str | None = None) -> None:
        """Takes in cells: of new dates and leads, late ones of known ones, or new values of known cells.

        Only the dates and leads that come are read again. A batch that was committed under its name is passed over. Of a cell that comes
        twice in one batch, the row with the greatest values counts.
        """
        if batch is not None and batch in self._batches():
            return
        spark, keys, version = self.spark, self.keys, self.version()
        new = version + 1
        values = [c for c in cells.columns if c not in (*keys, *self.cell)]
        once = cells.groupBy(*keys, *self.cell).agg(F.max(F.struct(*values)).alias("__v")).select(*keys, *self.cell, "__v.*")
        folder = f"version={new}"
        once.repartition(*keys).write.mode("overwrite").partitionBy(*keys).parquet(f"{self.path}/cells/{folder}")
        own = spark.read.schema(once.schema).parquet(f"{self.path}/cells/{folder}")
        touched = own.select(*keys).distinct()
        known = self._stored_cells(touched, version)
        whole = own.withColumn("version", F.lit(new))
        if known is not None:
            every = known.select(*whole.columns).unionByName(whole)
            whole = every.groupBy(*keys, *self.cell).agg(F.max_by(F.struct(*values), "version").alias("__v")).select(*keys, *self.cell, "__v.*")
        else:
            whole = whole.drop("version")
        self.compute(whole).select(*keys, *self.group, *self.values).write.mode("overwrite").partitionBy(*keys).parquet(f"{self.path}/statistics/{folder}")
        made = spark.read.schema(self._statistics_schema(whole)).parquet(f"{self.path}/statistics/{folder}")
        counts = whole.groupBy(*keys).agg(F.count("*").alias("n_stored")).join(self.expected.select(*keys, "n_expected"), keys, "left")
        counts = counts.select(*keys, "n_expected", "n_stored", (F.col("n_stored") >= F.coalesce("n_expected", F.lit(0))).alias("whole"), F.lit(new).alias("made"))
        before, states = self._at("ledger", version), [contribution(made, self.average_keys, self.values)]
        if before is not None:
            old = before.join(F.broadcast(touched), keys)
            gone = self._read("statistics").join(F.broadcast(old.select(*keys, F.col("made").alias("version"))), [*keys, "version"])
            states += [self._at("state", version), contribution(gone, self.average_keys, self.values, -1)]
            counts = counts.unionByName(before.join(F.broadcast(touched), keys, "left_anti"))
        merged(states, self.average_keys).write.mode("overwrite").parquet(f"{self.path}/state/{folder}")
        counts.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/ledger/{folder}")  # a row a date and lead
        spark.createDataFrame([(new, batch)], "version int, batch string").coalesce(1).write.mode("append").parquet(f"{self.path}/commits")

    def _statistics_schema(self, cells: DataFrame) -> str:
        plan = self.compute(cells).select(*self.group, *self.values, *self.keys)
        return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plan.schema)

    def averages(self, strict: bool = False) -> DataFrame:
        return averages(self.state(), self.average_keys, strict)

    def follow(self, source: str, schema: str, checkpoint: str) -> StreamingQuery:
        """Takes in a folder of cells as a stream (T1); a batch that is handed over again after a failure is passed over."""
        stream = self.spark.readStream.schema(schema).parquet(source)
        return stream.writeStream.foreachBatch(lambda df, k: self.add(df, f"stream-{k}")).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
