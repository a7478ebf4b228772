"""Daily tables kept up to date by a stream of sales."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from shelfcast.schema import DATE, N_ROWS, PRICE, QUANTITY

DELAY = "1 day"


def daily_schema(key: str, quantity: T.DataType | None = None) -> T.StructType:
    return T.StructType(
        [
            T.StructField(key, T.LongType()),
            T.StructField(DATE, T.DateType()),
            T.StructField(PRICE, T.DoubleType()),
            T.StructField(QUANTITY, quantity or T.DoubleType()),
            T.StructField(N_ROWS, T.LongType()),
        ]
    )


def daily_stream(sales: DataFrame, key: str, *, time: str = "ts", delay: str = DELAY) -> DataFrame:
    """The daily table of a sales stream. In append mode a day comes out once the watermark has passed its
    end, in update mode (:func:`upsert_to_table`) whenever it changes, the newest days included.

    Days are those of the session's time zone: windows are cut in UTC, so the clock time of ``time`` is
    read as UTC first. Rows later than ``delay`` are dropped by the watermark; :func:`late_rows` counts them.
    """
    clock = F.from_utc_timestamp(F.col(time).cast("timestamp"), F.current_timezone())
    timed = sales.withColumn(time, clock).withWatermark(time, delay)
    day = F.floor(F.unix_seconds("__day.start") / F.lit(86_400)).cast("int")
    return (
        timed.groupBy(F.window(time, "1 day").alias("__day"), key)
        .agg(
            F.avg(PRICE).alias(PRICE),
            F.coalesce(F.sum(F.col(QUANTITY).cast("double")), F.lit(0.0)).alias(QUANTITY),
            F.count(F.lit(1)).alias(N_ROWS),
        )
        .select(key, F.date_from_unix_date(day).alias(DATE), PRICE, QUANTITY, N_ROWS)
    )


def append_to_table(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write what is available now as Parquet; a restart with the same checkpoint goes on from there."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def upsert_to_table(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write every change to what is available now; :func:`current_rows` reads the latest state of each day.

    A batch has a folder of its own and replaces it when it is run again, so a restart repeats nothing.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        stream.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_rows(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The last version of every (key, day) written by :func:`upsert_to_table`."""
    versions = spark.read.schema(daily_schema(key).add("batch", T.LongType())).parquet(path)
    last = F.max_by(F.struct(PRICE, QUANTITY, N_ROWS), "batch").alias("last")
    return versions.groupBy(key, DATE).agg(last).select(key, DATE, "last.*")


def late_rows(query: StreamingQuery) -> int:
    """Rows that the watermark has dropped, over the batches the query still remembers."""
    return sum(op["numRowsDroppedByWatermark"] for batch in query.recentProgress for op in batch["stateOperators"])
