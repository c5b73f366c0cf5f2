"""The same export for each micro-batch of a stream."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from parquill.operators.sink import write_parquet
from parquill.plans.resolve import project
from parquill.settings import Settings
from parquill.types import PgType


def export_stream(stream: DataFrame, folder: str, checkpoint: str, *, types: Mapping[str, PgType | str] | None = None, settings: Settings | None = None, available_now: bool = True, **writing) -> StreamingQuery:
    """A folder for each batch, named by its number, so that a batch done again replaces itself."""

    def one(batch: DataFrame, number: int) -> None:
        write_parquet(project(batch, types, settings), f"{folder}/batch={number}", single_file=False, **writing)

    writer = stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
