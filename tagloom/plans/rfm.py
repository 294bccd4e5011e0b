"""Customer value: recency, frequency and money scores, clustered by K-means."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

import numpy as np
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession, functions as F

from tagloom import labels as L
from tagloom.functions.casting import suffix_id, to_double, to_long
from tagloom.functions.ladders import bin_ladder
from tagloom.functions.timing import recency_days
from tagloom.operators.metrics import aggregate, latest, latest_label

SCORES = ["recency", "frequency", "money"]
LADDERS = (L.RFM_RECENCY, L.RFM_FREQUENCY, L.RFM_MONEY)


def rfm_metrics(orders: DataFrame, as_of: str) -> DataFrame:
    """Per member: days since the last finished order, orders, total spent."""
    per_member = orders.groupBy("memberId").agg(
        F.max(F.expr(to_long("finishTime"))).alias("lastFinish"),
        F.count("orderSn").alias("frequency"),
        F.sum(F.expr(to_double("orderAmount"))).alias("money"))
    return per_member.withColumn("recency", F.expr(recency_days(as_of, "lastFinish")))


def rfm_scores(metrics: DataFrame, recency=L.RFM_RECENCY, frequency=L.RFM_FREQUENCY,
               money=L.RFM_MONEY) -> DataFrame:
    """Each metric as a score of 1 to 5; a value between two rungs has none."""
    ladders = {"recency": recency, "frequency": frequency, "money": money}
    return metrics.selectExpr("memberId", "lastFinish", *[
        f"{bin_ladder(name, ladder)} AS {name}" for name, ladder in ladders.items()])


def _vectors(scores: DataFrame) -> DataFrame:
    assembler = VectorAssembler(inputCols=SCORES, outputCol="features", handleInvalid="skip")
    return assembler.transform(scores)


def score_points(scores: DataFrame) -> DataFrame:
    """Distinct complete score triples with the members on each.

    Three scores of five values make at most 125 points however many members there are,
    so the clustering costs one aggregation of the members. Sorted, the input order and
    with it the numbering of the clusters does not depend on the partitioning.
    """
    complete = scores.dropna(subset=SCORES)
    return complete.groupBy(*SCORES).agg(F.count(F.lit(1)).cast("double").alias("members")).orderBy(*SCORES)


def fit_segments(scores: DataFrame, settings: dict = L.RFM_KMEANS) -> KMeansModel:
    points = _vectors(score_points(scores).coalesce(1))
    solver = KMeans(featuresCol="features", predictionCol="cluster", weightCol="members", **settings)
    return solver.fit(points)


def least_cost(costs: np.ndarray) -> list[int]:
    """The column of each row in the assignment of rows to columns with the least total cost.

    Rows enter one by one, each along the cheapest chain of re-assignments; prices on rows and columns keep
    what is left of every cost at least 0. Clusters are few: the table is k by k.
    """
    k = len(costs)
    row_price, column_price, owner = np.zeros(k), np.zeros(k), np.full(k, -1)
    for entering in range(k):
        reach, came, tight = np.full(k, np.inf), np.full(k, -1), np.zeros(k, dtype=bool)
        row, column, spent = entering, -1, 0.0
        while True:
            left = spent + costs[row] - row_price[row] - column_price
            nearer = ~tight & (left < reach)
            reach[nearer], came[nearer] = left[nearer], column
            column = int(np.where(tight, np.inf, reach).argmin())
            spent = float(reach[column])
            if owner[column] < 0:
                break
            tight[column], row = True, owner[column]
        row_price[entering] += spent
        for held in np.flatnonzero(tight):
            row_price[owner[held]] += spent - reach[held]
            column_price[held] -= spent - reach[held]
        while column >= 0:  # back along the chain
            before = came[column]
            owner[column] = entering if before < 0 else owner[before]
            column = before
    columns = [0] * k
    for column, row in enumerate(owner):
        columns[row] = column
    return columns


def names_after_refit(book: dict[str, str], before: list[list[float]], after: list[list[float]], limit: float) -> dict[str, str]:
    """The book for new centres: each gets the name of the old centre it is matched with, so that the distances of
    all pairs together are least. Refused when a matched centre moved further than ``limit``: then the
    name would no longer say what it said."""
    if len(before) != len(after):
        raise ValueError(f"{len(before)} clusters were named, the refit has {len(after)}")
    old, new = np.array(before, dtype=float), np.array(after, dtype=float)
    distances = np.sqrt(((new[:, None, :] - old[None, :, :]) ** 2).sum(-1))
    matched = least_cost(distances)
    far = {i: round(float(distances[i, j]), 3) for i, j in enumerate(matched) if distances[i, j] > limit}
    if far:
        raise ValueError(f"centres further than {limit} from every free old one, name the clusters anew: {far}")
    return {str(i): book[str(j)] for i, j in enumerate(matched)}


@dataclass(frozen=True)
class Segments:
    """A fitted model with the book that names its clusters. Cluster numbers mean nothing
    without the fit they came from, so the two are stored and loaded together."""

    model: KMeansModel
    book: dict[str, str]

    def __post_init__(self):
        clusters = {str(i) for i in range(len(self.model.clusterCenters()))}
        if set(self.book) != clusters:
            raise ValueError(f"the book names {sorted(self.book)}, the model has {sorted(clusters)}")

    def refitted(self, model: KMeansModel, limit: float) -> Segments:
        """The names of this fit for the clusters of another one, whatever their numbers."""
        before, after = ([centre for _, *centre in segment_centers(m)] for m in (self.model, model))
        return Segments(model, names_after_refit(self.book, before, after, limit))

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(str(i), self.book[str(i)], centre) for i, *centre in segment_centers(self.model)]
        self.model.write().overwrite().save(f"{path}/model")
        spark.createDataFrame(rows, "cluster string, label string, centre array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/book")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Segments:
        """Fails without a book, and when the model was fitted anew since the book was stored."""
        model = KMeansModel.load(f"{path}/model")
        rows = spark.read.parquet(f"{path}/book").collect()  # a row per cluster
        if {r.cluster: list(r.centre) for r in rows} != {str(i): centre for i, *centre in segment_centers(model)}:
            raise ValueError(f"{path}: the book was made for another fit; name the clusters anew")
        return cls(model, {r.cluster: r.label for r in rows})


def score_grid(spark: SparkSession, *ladders: list[L.Bin]) -> DataFrame:
    """Every score triple the ladders can give: 125 rows for five rungs each."""
    triples = list(product(*[sorted({b.label for b in ladder}) for ladder in ladders]))
    return spark.createDataFrame(triples, ", ".join(f"{name} int" for name in SCORES))


def assign_segments(scores: DataFrame, model: KMeansModel, ladders=LADDERS) -> DataFrame:
    """Cluster per member, null where a score is missing.

    The model runs on the grid of possible triples and members look theirs up: one pass
    over the members. Spark broadcasts the grid where its size allows it.
    """
    grid = model.transform(_vectors(score_grid(scores.sparkSession, *ladders)))
    points = grid.select(*SCORES, F.col(model.getPredictionCol()).alias("cluster"))
    return scores.join(points, SCORES, "left")


def user_value(scores: DataFrame, segments: Segments, id_digits: int | None, ladders=LADDERS) -> DataFrame:
    """Value label per customer id; ``ladders`` are the ones the scores came from. Members sharing an id: the latest buyer's label counts,
    equal times the smaller cluster number."""
    if not isinstance(segments, Segments):
        raise TypeError("a fitted model needs a book that names its clusters: Segments(model, book)")
    model, book = segments.model, segments.book
    labels = [*[book[str(i)] for i in range(len(book))], L.UNKNOWN]
    keyed = (assign_segments(scores, model, ladders)
             .withColumn("id", F.expr(suffix_id("memberId", id_digits)))
             .where("id IS NOT NULL"))
    newest = latest("lastFinish", f"coalesce(cluster, {len(book)})", len(labels))
    per_id = aggregate(keyed, "id", {"segment_latest": newest})
    return per_id.selectExpr("id", f"{latest_label('segment_latest', labels)} AS userValue")


def segment_centers(model: KMeansModel) -> list[tuple[int, float, float, float]]:
    """Cluster centres: k rows, k being a setting."""
    return [(i, *[float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
