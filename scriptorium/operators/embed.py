"""Text to vectors, with a pluggable embedder."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.ml.feature import HashingTF, Normalizer, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from scriptorium.schemas import EMBEDDING_DIM, EMBEDDING_MODEL


def pending(
    inputs: DataFrame, embeddings: DataFrame, model: str | None = None, recompute: bool = False
) -> DataFrame:
    """Inputs that have no vector yet (of the given model, if one is named)."""
    if recompute:
        return inputs
    done = embeddings if model is None else embeddings.filter(F.col("model_used") == model)
    return inputs.join(done.select("paper_id"), "paper_id", "left_anti")


@dataclass(frozen=True)
class HashingEmbedder:
    """Deterministic stand-in for a model: hashed word counts, unit length.

    Runs on Spark ML feature transformers, wholly in the JVM.
    """

    dim: int = EMBEDDING_DIM

    def apply(self, df: DataFrame) -> DataFrame:
        words = Tokenizer(inputCol="text", outputCol="words")
        counts = HashingTF(inputCol="words", outputCol="counts", numFeatures=self.dim)
        scaled = Normalizer(inputCol="counts", outputCol="scaled", p=2.0)
        df = df.withColumn("text", F.coalesce("text", F.lit("")))
        for stage in (words, counts, scaled):
            df = stage.transform(df)
        return df.select("paper_id", vector_to_array("scaled", "float32").alias("embedding"))


@dataclass(frozen=True)
class ClientEmbedder:
    """Any model behind a callable ``texts -> vectors``.

    ``connect`` runs once per task, so one client serves all of its batches.
    """

    connect: Callable[[], Callable[[list[str]], Sequence[Sequence[float]]]]
    batch: int = 64

    def apply(self, df: DataFrame) -> DataFrame:
        connect, batch = self.connect, self.batch

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            client = connect()
            for frame in frames:
                for low in range(0, len(frame), batch):
                    rows = frame.iloc[low : low + batch]
                    vectors = [[float(x) for x in v] for v in client(rows["text"].tolist())]
                    yield pd.DataFrame({"paper_id": rows["paper_id"].tolist(), "embedding": vectors})

        schema = "paper_id bigint, embedding array<float>"
        return df.select("paper_id", "text").mapInPandas(run, schema)


def embed(
    df: DataFrame,
    embedder: HashingEmbedder | ClientEmbedder | None = None,
    model: str = EMBEDDING_MODEL,
    partitions: int | None = None,
) -> DataFrame:
    """(paper_id, text) to (paper_id, embedding, model_used).

    ``partitions`` spreads the texts first. It pays for slow models, since
    Spark sizes its partitions by bytes and not by calls; a cheap embedder is
    best left where the texts are.
    """
    embedder = embedder or HashingEmbedder()
    if partitions is not None:
        df = df.repartition(partitions, "paper_id")
    return embedder.apply(df).withColumn("model_used", F.lit(model))
