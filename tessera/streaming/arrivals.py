"""Candidates for arriving target records against a static index of source-1 records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import records as rec
from tessera.sources.io import PAIR


def candidates(stream: DataFrame, index: DataFrame, key: str = "name_norm") -> DataFrame:
    """Exact-key pairs of a stream of raw records (with source) and key_index rows of source 1.

    A stream-static equi-join without state: each record is matched once, as it arrives.
    """
    rows = rec.key_index(rec.normalise(stream), key)
    return rows.join(index.where("source = 'S1'").select(F.col("entity_id").alias("source1_entity_id"), "country_norm", "block_key"), ["country_norm", "block_key"]).select(PAIR[0], F.col("entity_id").alias(PAIR[1]), F.col("source").alias(PAIR[2]))


def write(stream: DataFrame, path: str, checkpoint: str):
    """The pairs appended as Parquet; all that has arrived is handled, then the query ends."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
