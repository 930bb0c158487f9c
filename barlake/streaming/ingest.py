"""Incremental load: only payload files not seen before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from barlake.plans.pipeline import loaded, new_batch_id, refresh_silver, touched_days
from barlake.sources.payloads import payload_stream
from barlake.sources.staging import path_exists


def _id_of(spark: SparkSession, checkpoint: str, epoch: int, warehouse: str, fmt: str):
    """The batch id of a micro-batch, and whether it was given one before.

    It is kept beside the stream's own state before anything is loaded, so a
    micro-batch that is repeated after a failure has the same one again.
    """
    path = f"{checkpoint.rstrip('/')}/batch_ids/{epoch}"
    if path_exists(spark, f"{path}/_SUCCESS"):
        return spark.read.schema("id long").parquet(path).first()[0], True
    batch_id = new_batch_id(spark, warehouse, fmt)
    spark.range(batch_id, batch_id + 1, 1, 1).write.mode("overwrite").parquet(path)
    return batch_id, False


def ingest_stream(
    spark: SparkSession,
    landing: str,
    warehouse: str,
    checkpoint: str,
    layout: str = "files",
    refresh: bool = True,
    on_fail: str = "report",
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    trigger: dict | None = None,
    database: str | None = None,
    store: str = "all",
    untimed: str = "store",
) -> StreamingQuery:
    """Start loading new payload files; by default stop when all are loaded.

    Each micro-batch goes to bronze under its own batch id and, with ``refresh``,
    the days it has bars for are recomputed in silver, which is how late bars are
    taken in: no event-time state is kept. A micro-batch that is repeated after a
    failure replaces what it had stored. With ``database`` the catalog tables are
    told about the days written.

    With ``on_fail="raise"`` a batch that fails its checks stops the stream, and
    again at each start, until its files are mended or the policy is changed. With ``"divert"``
    its payloads go to the quarantine table and the stream goes on; days whose silver fails
    are held back. ``store`` and ``untimed`` are as in ``load_bronze``. Without ``refresh`` the days stay pending for a
    later run.
    """

    def load(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        # The stream's own 0, 1, 2... would count as older than any batch load.
        batch_id, again = _id_of(session, checkpoint, epoch, warehouse, fmt)
        with loaded(
            batch, warehouse, batch_id, on_fail, fmt, database, again, store, untimed
        ) as done:
            if not refresh:
                return
            with touched_days(session, done, warehouse) as days:
                if days is not None:
                    refresh_silver(
                        session,
                        warehouse,
                        days=days,
                        on_fail=on_fail,
                        fmt=fmt,
                        database=database,
                    )

    return (
        payload_stream(spark, landing, layout, max_files_per_trigger)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
