"""Score records as they arrive, with fitted generators and a stored model.

The fitted statistics are constants or small tables, so a stream needs no state: each
micro-batch is projected, joined with broadcast tables and scored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from featurepipe.operators.features import FittedGenerators
from featurepipe.operators.lag import LagFeatures
from featurepipe.operators.model import ScoringModel


def score_stream(stream: DataFrame, generators: FittedGenerators, model: ScoringModel) -> DataFrame:
    """The stream with features and score added. Lag features need the rows before a record, so they are refused."""
    if any(isinstance(g, LagFeatures) for g in generators.generators):
        raise ValueError("Lag features need ordered history and cannot be computed on a stream.")
    return model.score(generators.transform(stream))


def start_scoring(
    stream: DataFrame,
    generators: FittedGenerators,
    model: ScoringModel,
    output_uri: str,
    checkpoint_uri: str,
    available_now: bool = False,
) -> StreamingQuery:
    """Append scored records to a Parquet table. A query restarted with the same checkpoint continues exactly once."""
    scored = score_stream(stream, generators, model)
    writer = scored.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint_uri)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(output_uri)
