"""Scoring a stream of items with the active models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from feedloom.plans.scoring import load_models, score
from feedloom.sources import ledger


def score_stream(
    items: DataFrame,
    ledger_path: str,
    output_path: str,
    checkpoint_path: str,
    keep: list[str],
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start a query that scores each micro-batch and writes it under ``output_path``.

    The active run is looked up per batch, so a promotion takes effect with the next one; its models
    are loaded once. A batch writes its own folder in overwrite mode: repeated after a failure, it
    replaces itself.
    """
    loaded: dict = {}

    def write(batch: DataFrame, batch_id: int) -> None:
        entry = ledger.active(batch.sparkSession, ledger_path)
        run = entry and entry["run_id"]
        if run not in loaded:
            loaded.clear()
            loaded[run] = load_models(entry)
        models = loaded[run]
        target = f"{output_path}/batch_id={batch_id}"
        score(batch, models, keep).write.mode("overwrite").parquet(target)

    return (
        items.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint_path)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )
