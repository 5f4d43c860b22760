"""Extension: score new target records against a fixed anchor table as they arrive."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rowkin.config import LinkageConfig
from rowkin.functions.normalize import normalize_table
from rowkin.functions.tokens import with_tokens
from rowkin.operators import blocking, features, models


def match_batch(batch: DataFrame, anchors: DataFrame, model: PipelineModel, config: LinkageConfig) -> DataFrame:
    """(s1_id, cand_id, p) of a batch's matches. anchors: prepared S1 records. Bucket caps hold within the batch."""
    targets = with_tokens(normalize_table(batch))
    targets = targets if "ord" in targets.columns else targets.withColumn("ord", F.xxhash64("entity_id"))
    pairs = blocking.candidates(anchors, targets, config.blocking)
    table = features.pair_features(features.paired(pairs.select("s1_id", "cand_id"), anchors, targets))
    return models.with_probability(model, table).select("s1_id", "cand_id", "p").filter(F.col("p") >= config.threshold)


def match_stream(stream: DataFrame, anchors: DataFrame, model: PipelineModel, out_path: str, checkpoint: str, config: LinkageConfig | None = None, **trigger) -> StreamingQuery:
    """Append each micro-batch's matches, one folder a batch id: a batch that is repeated after a failure overwrites its own."""
    config = config or LinkageConfig()

    def score(batch: DataFrame, number: int) -> None:
        match_batch(batch, anchors, model, config).write.mode("overwrite").parquet(f"{out_path}/batch={number}")

    return stream.writeStream.foreachBatch(score).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
