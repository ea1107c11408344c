"""Batch scoring (I21) applied to a stream of incoming files.

The reference has no streaming; its scoring job reads a finished file.  The
same fitted model — a logistic weight vector or a tree, both compiled to
Column expressions — scores a ``readStream`` source unchanged, because the
expressions are stateless: no watermark or state store is involved, and the
query's progress lives in its own checkpoint location (on the shared
checkpoint folder by default), so it restarts after executor or driver loss.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from quarry.session import checkpoint_dir


def read_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", **options) -> DataFrame:
    """A file stream; ``maxFilesPerTrigger`` bounds each micro-batch."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def scored_stream(stream: DataFrame, prediction: Column, keep: Sequence[str], output: str = "prediction") -> DataFrame:
    """Project ``keep`` columns plus the model's prediction expression."""
    return stream.select(*keep, prediction.alias(output))


def write_stream(
    scored: DataFrame,
    path: str,
    checkpoint: str | None = None,
    fmt: str = "parquet",
    trigger_once: bool = False,
) -> StreamingQuery:
    """Append scored rows to ``path``; exactly-once via the file sink log."""
    spark = scored.sparkSession
    checkpoint = checkpoint or os.path.join(checkpoint_dir(spark), "streams", uuid.uuid4().hex)
    writer = scored.writeStream.format(fmt).option("checkpointLocation", checkpoint).outputMode("append")
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)
