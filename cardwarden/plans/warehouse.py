"""Warehouse tables: declared types, full refresh, additive changes, run log."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwarden import schemas


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns, in order and type; absent ones are null. A value that does not fit its type is an
    error that names the column and the value, as a database would raise it; it is never stored as null."""
    held = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[_fitted(f, held.get(f.name)).alias(f.name) for f in schema.fields])


def _fitted(field: T.StructField, held: T.DataType | None) -> Column:
    if held is None:
        return F.lit(None).cast(field.dataType)
    given = F.col(field.name)
    if held == field.dataType:
        return given
    fitted = given.try_cast(field.dataType)
    told = F.concat(F.lit(f"{field.name} does not fit {field.dataType.simpleString()}: "), given.cast("string"))
    return F.when(given.isNotNull() & fitted.isNull(), F.raise_error(told).cast(field.dataType)).otherwise(fitted)


def conform_facts(facts: DataFrame) -> DataFrame:
    return conform(facts, schemas.FACT)


def conform_card_types(by_card_type: DataFrame) -> DataFrame:
    """An unknown chip is stored as no chip; the rows are not merged."""
    known = by_card_type.withColumn("has_chip", F.coalesce("has_chip", F.lit(False)))
    return conform(known, schemas.BY_CARD_TYPE)


def conform_profiles(profiles: DataFrame) -> DataFrame:
    """NaN is stored as null and an unknown number of cards as zero."""
    doubles = [f.name for f in profiles.schema.fields if isinstance(f.dataType, T.DoubleType)]
    no_nan = {c: F.when(~F.isnan(c), F.col(c)) for c in doubles}
    cards = {"num_cards": F.coalesce("num_cards", F.lit(0))}
    return conform(profiles.withColumns(no_nan | cards), schemas.USER_PROFILES)


def insert_if_absent(target: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """``target`` plus one row for every key of ``rows`` it does not hold yet; the target wins."""
    fresh = rows.join(target.select(key), key, "left_anti").dropDuplicates([key])
    return target.unionByName(fresh, allowMissingColumns=True)


def upsert(target: DataFrame, updates: DataFrame, key: str, newest: str) -> DataFrame:
    """``target`` with the rows of ``updates`` replacing or joining it; of several updates to one
    key the one with the greatest ``newest`` counts."""
    row = F.struct(*updates.columns)
    latest = updates.groupBy(key).agg(F.max_by(row, newest).alias("row")).select("row.*")
    kept = target.join(latest.select(key), key, "left_anti")
    return kept.unionByName(latest)


def newer_than(source: DataFrame, column: str, high_water: Column) -> DataFrame:
    return source.where(F.col(column) > high_water)


def add_columns(df: DataFrame, columns: dict[str, tuple[str, object]]) -> DataFrame:
    """Adds each ``name: (type, default)`` that is missing; running it again changes nothing."""
    return df.select(
        "*",
        *[
            F.lit(default).cast(kind).alias(name)
            for name, (kind, default) in columns.items()
            if name not in df.columns
        ],
    )


SEGMENT_ADDITIONS = {
    "total_suspicious": ("bigint", 0),
    "amount_suspicious": ("decimal(18,2)", 0),
}
FACT_ADDITIONS = {"fraud_score": ("int", None), "card_txn_count": ("bigint", None)}
CONFUSION_ADDITIONS = {
    name: ("bigint", None) for name in ("true_positives", "true_negatives", "false_positives", "false_negatives")
}
STAMP = {"computed_at": ("timestamp_ntz", None)}
# What each table gained since its first layout; a run that lacks a column is read with its default.
ADDITIONS = {
    "transactions_processed": FACT_ADDITIONS,
    "fraud_metrics_global": CONFUSION_ADDITIONS | STAMP,
    "fraud_by_mcc": SEGMENT_ADDITIONS | STAMP,
    "fraud_by_card_type": SEGMENT_ADDITIONS | STAMP,
    "fraud_by_state": SEGMENT_ADDITIONS | STAMP,
    "fraud_by_merchant": SEGMENT_ADDITIONS | STAMP,
    "user_profiles": STAMP,
}


def stamped(metrics: DataFrame) -> DataFrame:
    """A metric table with the time at which it was computed."""
    return metrics.withColumn("computed_at", F.current_timestamp().cast("timestamp_ntz"))


def upgraded(df: DataFrame, name: str) -> DataFrame:
    """A stored table in today's layout: missing columns with their defaults, declared columns first and in their
    declared types, so that tables of old and new runs can be put together."""
    whole = add_columns(df, ADDITIONS.get(name, {}))
    declared = {f.name: f.dataType for f in schemas.WAREHOUSE[name].fields} if name in schemas.WAREHOUSE else {}
    first = [F.col(c).cast(t).alias(c) for c, t in declared.items() if c in whole.columns]
    return whole.select(*first, *[c for c in whole.columns if c not in declared])


class Warehouse:
    """Tables under one folder.

    A refresh writes all its tables into a folder of its own and then creates one marker file.
    Readers use the newest marked folder, so all tables change together, and a refresh that dies
    leaves the old tables in place.
    """

    MARKER = "_COMPLETE"

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- storage -------------------------------------------------------------------------------

    def _path(self, location: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(location)

    def _fs(self):
        return self._path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def runs(self) -> list[str]:
        """Complete refreshes, oldest first."""
        base = self._path(f"{self.root}/runs")
        fs = self._fs()
        if not fs.exists(base):
            return []
        names = sorted(status.getPath().getName() for status in fs.listStatus(base))
        return [n for n in names if fs.exists(self._path(f"{self.root}/runs/{n}/{self.MARKER}"))]

    def new_run(self) -> str:
        return f"run-{time.time_ns():020d}"

    def publish(self, run: str) -> None:
        self._fs().create(self._path(f"{self.root}/runs/{run}/{self.MARKER}"), True).close()

    def expire_staging(self) -> None:
        """Deletes what complete refreshes before the newest staged. Refreshes that still run keep theirs."""
        for run in self.runs()[:-1]:
            self.discard(run, "staging")

    def discard(self, run: str, *parts: str) -> None:
        for part in parts:
            self._fs().delete(self._path(f"{self.root}/{part}/{run}"), True)

    def expire_runs(self, keep: int = 2) -> None:
        """Deletes all but the newest complete refreshes, and what they staged."""
        for run in self.runs()[:-keep]:
            self.discard(run, "runs", "staging")

    def location(self, table: str, run: str | None = None) -> str:
        if run is None:
            complete = self.runs()
            if not complete:
                raise FileNotFoundError(f"no complete refresh under {self.root}")
            run = complete[-1]
        return f"{self.root}/runs/{run}/{table}"

    # -- tables --------------------------------------------------------------------------------

    def table(self, name: str, run: str | None = None) -> DataFrame:
        """In today's layout, whatever layout the run had."""
        return upgraded(self.spark.read.parquet(self.location(name, run)), name)

    def record_schemas(self, run: str) -> None:
        """Stores which columns the tables of a run have: one row per table and column."""
        rows = [
            (name, place, field.name, field.dataType.simpleString())
            for name in schemas.WAREHOUSE
            for place, field in enumerate(self.spark.read.parquet(self.location(name, run)).schema.fields)
        ]
        kinds = "table_name string, position int, column_name string, column_type string"
        self.spark.createDataFrame(rows, kinds).coalesce(1).write.mode("overwrite").parquet(self.location("schema_record", run))

    def schema_record(self, run: str | None = None) -> DataFrame:
        return self.spark.read.parquet(self.location("schema_record", run))

    def write(self, run: str, name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(self.location(name, run))
        return self.table(name, run)

    def write_clustered(self, run: str, name: str, df: DataFrame, by: Sequence[str], dealt: bool = False) -> DataFrame:
        """Ranges of ``by`` per file, sorted inside, so that file and page statistics find a user's
        rows. A hot user is cut into several ranges by the later columns. ``dealt`` says that ``df`` is in ranges."""
        ranges = df if dealt else df.repartitionByRange(*by)
        return self.write(run, name, ranges.sortWithinPartitions(*by))

    # -- run log -------------------------------------------------------------------------------

    def log_run(
        self, status: str, counts: DataFrame | None = None, seconds: float | None = None, notes: str = ""
    ) -> None:
        """Appends one row; ``counts`` is the one-row (total, fraud) result of the quality check."""
        source = counts if counts is not None else self.spark.range(1)
        row = source.select(
            F.current_timestamp().cast("timestamp_ntz").alias("run_at"),
            F.lit(status).alias("status"),
            (F.col("total") if counts is not None else F.lit(None)).alias("rows_processed"),
            (F.col("fraud") if counts is not None else F.lit(None)).alias("rows_fraud"),
            F.lit(seconds).alias("duration_secs"),
            F.lit(notes).alias("notes"),
        )
        conform(row, schemas.RUN_LOG).coalesce(1).write.mode("append").parquet(self._log_path())

    def _log_path(self) -> str:
        return f"{self.root}/pipeline_run_log"

    def run_log(self) -> DataFrame:
        return self.spark.read.schema(schemas.RUN_LOG).parquet(self._log_path())
