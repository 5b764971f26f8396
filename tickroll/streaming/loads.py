"""Table loads as a stream of landed payloads.

Each micro-batch of payload files goes through the same ``load_run`` as a
scheduled run: code list and company table are static sides that the stream
joins, read anew for every batch, so a code listed between two batches counts
from the next one on. A batch commits as (stream id, batch id): a replay is not
applied again. Inserts (policy 'nothing') keep the first landed batch's row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tickroll.plans.jobs import LoadRun, load_run
from tickroll.sources.keyed_table import KeyedTable
from tickroll.streaming.ingest import RETAIN_HOURS, stream_id


def dead_letter_table(spark: SparkSession, path: str) -> KeyedTable:
    """Payloads without records; the same payload landed again is one row."""
    return KeyedTable(spark, path, ["seq", "_kind", "_payload"], retain_hours=RETAIN_HOURS)


def run_load(spark: SparkSession, name: str, source_dir: str, schema: str | StructType, table: KeyedTable, checkpoint_location: str, *,
             codes: Callable[[], DataFrame] | None = None, companies: Callable[[], DataFrame] | None = None,
             dead: KeyedTable | None = None, fmt: str = "parquet", max_files_per_trigger: int | None = None,
             **options) -> list[LoadRun]:
    """Load every landed payload file not yet seen, then stop (availableNow).

    ``codes`` and ``companies`` give the static sides and are asked once per
    batch; ``dead`` keeps the payloads that gave no records; ``options`` go to
    ``load_run``. Returns what each batch did.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    runs: list[LoadRun] = []

    def on_batch(df: DataFrame, batch_id: int) -> None:
        commit = (stream_id(spark, checkpoint_location), batch_id)
        run = load_run(spark, name, df, table, codes=codes and codes(), companies=companies and companies(), commit=commit, **options)
        if dead is not None:
            dead.merge(run.dead.distinct(), "update", unique=True, commit=commit)
        runs.append(run)

    q = (reader.load(source_dir).writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint_location)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return runs
