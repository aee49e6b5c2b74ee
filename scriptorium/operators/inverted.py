"""An inverted file of vectors: nearest neighbours from a few buckets only.

Vectors are stored by their nearest centroid, with the least and the largest
angle to it per bucket. By the triangle inequality on the sphere no member of
a bucket is nearer to a query than the query's angle to the centroid less the
largest one (or the least one less the query's): buckets are read in the order
of that bound until it passes the k-th distance, so the answer is exact.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from scriptorium.functions import vector as V
from scriptorium.operators.search import knn

MOST_BUCKETS = 4096  # bounds the bucket table, which a search reads whole
SAMPLE = 50_000  # vectors the centroids are fitted on, at most about so many
NO_DIRECTION = -1  # the bucket of null and zero vectors and those of another length
SLACK = 1e-6  # radians; arccos loses half of the digits near 0


def fit_centroids(corpus: DataFrame, dim: int, buckets: int, id_col: str, vector_col: str, seed: int) -> np.ndarray:
    """Spherical k-means over a sample by the hash of the ids."""
    vector = F.col(vector_col)
    units = corpus.filter(V.has_dim(vector, dim) & V.has_direction(vector)).select(
        id_col, V.unit(vector).alias("unit"))
    rows = units.count()
    if rows == 0:
        return np.zeros((0, dim))
    share = min(1.0, SAMPLE / rows)
    drawn = units.filter(F.pmod(F.xxhash64(id_col, F.lit(seed)), F.lit(1 << 30)) <= int(share * (1 << 30)))
    wanted = buckets or min(MOST_BUCKETS, max(1, round(rows**0.5)))
    if wanted < 2 or rows < 2:
        centers = [list(units.agg(*[F.avg(F.get("unit", i)) for i in range(dim)]).first())]
    else:
        model = KMeans(k=wanted, distanceMeasure="cosine", initMode="random", maxIter=8, seed=seed)
        points = drawn.select(array_to_vector("unit").alias("features"))
        centers = model.fit(points).clusterCenters()
    centers = np.array(centers, dtype="float64")
    sizes = np.linalg.norm(centers, axis=1)
    return centers[sizes > 0] / sizes[sizes > 0, None]


def place_by(centers: np.ndarray) -> Callable[[str], Column]:
    """Bucket and angle to its centroid of a column of vectors."""
    dim = centers.shape[1]

    @F.arrow_udf("struct<bucket: int, angle: double>")
    def place(vectors: pa.Array) -> pa.Array:
        bucket, angle = np.full(len(vectors), NO_DIRECTION, dtype="int32"), np.full(len(vectors), np.nan)
        fits = pc.fill_null(pc.equal(pc.list_value_length(vectors), dim), False)
        flat = vectors.filter(fits).flatten().to_numpy(zero_copy_only=False)
        matrix = flat.astype("float64").reshape(-1, dim)
        with np.errstate(divide="ignore", invalid="ignore"):
            cosines = (matrix / np.linalg.norm(matrix, axis=1, keepdims=True)) @ centers.T
        usable = np.isfinite(cosines).all(axis=1) & (len(centers) > 0)
        at = np.flatnonzero(fits.to_numpy(zero_copy_only=False))[usable]
        if len(at):
            own = cosines[usable].argmax(axis=1)
            bucket[at] = own
            angle[at] = np.arccos(np.clip(cosines[usable][np.arange(len(at)), own], -1, 1))
        return pa.StructArray.from_arrays(
            [pa.array(bucket), pa.array(angle, mask=np.isnan(angle))], names=["bucket", "angle"])

    return place


def write_inverted(
    corpus: DataFrame, path: str, dim: int, buckets: int = 0, id_col: str = "paper_id",
    vector_col: str = "embedding", seed: int = 42,
) -> None:
    """Store all rows by bucket under ``path``, and the table of buckets.

    ``buckets`` is by default the square root of the number of rows, at most
    ``MOST_BUCKETS``. A bucket with a large share of all rows is split over
    several files.
    """
    spark = corpus.sparkSession
    centers = fit_centroids(corpus, dim, buckets, id_col, vector_col, seed)
    placed = corpus.select(id_col, vector_col, place_by(centers)(vector_col).alias("place"))
    (
        placed.select(id_col, vector_col, "place.angle", "place.bucket")
        .hint("rebalance", "bucket")
        .write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/rows")
    )
    spans = spark.read.parquet(f"{path}/rows").groupBy("bucket").agg(
        F.min("angle").alias("low"), F.max("angle").alias("high"), F.count(F.lit(1)).alias("n"))
    rows = [
        (r["bucket"], r["low"], r["high"], r["n"], centers[r["bucket"]].tolist() if r["bucket"] >= 0 else None)
        for r in spans.collect()  # one row per bucket
    ]
    spark.createDataFrame(rows, "bucket int, low double, high double, n long, center array<double>").write.mode(
        "overwrite").parquet(f"{path}/buckets")


@dataclass(frozen=True)
class Inverted:
    """A stored inverted file."""

    spark: SparkSession
    path: str
    id_col: str = "paper_id"
    vector_col: str = "embedding"

    def rows(self, buckets: Sequence[int] | None = None) -> DataFrame:
        stored = self.spark.read.parquet(f"{self.path}/rows")
        return stored if buckets is None else stored.filter(F.col("bucket").isin(list(buckets)))

    def bounds(self, query: Sequence[float]) -> list[tuple[float, float, int, int]]:
        """(least angle a member can have, angle to the centroid, bucket, rows),
        nearest first; vectors without a direction come last."""
        target = np.asarray(query, dtype="float64")
        target = target / np.linalg.norm(target)
        out = []
        for r in self.spark.read.parquet(f"{self.path}/buckets").collect():
            if r["center"] is None or len(r["center"]) != len(target):
                out.append((np.inf, np.inf, r["bucket"], r["n"]))
                continue
            angle = float(np.arccos(np.clip(np.asarray(r["center"]) @ target, -1, 1)))
            out.append((max(0.0, angle - r["high"], r["low"] - angle), angle, r["bucket"], r["n"]))
        return sorted(out)

    def needed(self, query: Sequence[float], k: int) -> list[int]:
        """The buckets that hold the ``k`` nearest rows for certain. Each step
        reads as many rows as all before it, until the next bound passes the
        k-th distance."""
        ordered = self.bounds(query)
        nearest: list[float] = []
        done, wanted = 0, k
        while done < len(ordered):
            if len(nearest) >= k:
                angle = np.arccos(np.clip(1 - nearest[k - 1], -1, 1))
                if ordered[done][0] > angle + SLACK:
                    break
            upto, held = done, 0
            while upto < len(ordered) and held < wanted:
                held += ordered[upto][3]
                upto += 1
            found = knn(self.rows([o[2] for o in ordered[done:upto]]), query, k, self.id_col, self.vector_col)
            new = [r["distance"] for r in found.collect()]  # at most k rows
            nearest = sorted(nearest + [d for d in new if d is not None])[:k]
            done, wanted = upto, 2 * wanted
        return [o[2] for o in ordered[:done]]

    def search(self, query: Sequence[float], k: int = 100) -> DataFrame:
        """The ``k`` nearest rows, exactly as ``knn`` over the whole corpus.
        A query without a direction is at no distance from any row."""
        if not np.linalg.norm(np.asarray(query, dtype="float64")):
            return knn(self.rows(), query, k, self.id_col, self.vector_col)
        return knn(self.rows(self.needed(query, k)), query, k, self.id_col, self.vector_col)

    def search_some(self, query: Sequence[float], k: int = 100, share: float = 0.1) -> DataFrame:
        """About the ``k`` nearest rows: from the buckets whose centroids are
        nearest, until they hold ``share`` of all rows (and ``k`` at least)."""
        ordered = sorted(self.bounds(query), key=lambda o: o[1:3])
        least = max(k, share * sum(o[3] for o in ordered))
        held = np.cumsum([o[3] for o in ordered])
        some = [o[2] for o, before in zip(ordered, [0, *held]) if before < least]
        return knn(self.rows(some), query, k, self.id_col, self.vector_col)
