"""Customer segmentation with KMeans (M1-M8, C7): batched Lloyd runs or ``pyspark.ml``.

* M1  feature matrix: 7 features, missing -> 0, log1p on three skewed ones
* M2  standardisation with the *population* standard deviation (as the
      reference's scaler; a zero deviation scales by 1), computed by one
      global aggregate and broadcast as a 1-row frame
* M3  k sweep; every k is fitted from ``n_init`` seeds and the lowest cost
      wins.  By default all (k, seed) runs advance together, one pass over
      the points per iteration (``operators/multikmeans``); ``engine="ml"``
      fits each run with ``pyspark.ml`` KMeans instead
* M4  inertia = sum of squared distances to the final centres
* M5  Euclidean silhouette (``operators/silhouette``): in the sweep from a cell tree, with a proven
      bound on its error (all pairs are quadratic in the customers), with ``tolerance=0`` from all
      pairs; and from the same pass the squared-distance one
* M6-M8 suggested k (largest Euclidean silhouette), final model, elbow table

The scaled matrix is written once to the checkpoint folder and cached, so the
iterative fits re-read a short lineage.  Predictions and silhouettes are JVM
expressions over the centres (k x 7 terms).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from basketry.functions.flags import stable_mean
from basketry.operators.scalar import attach
from basketry.operators.silhouette import Score, euclidean_silhouettes
from basketry.session import checkpoint_dir

CLUSTER_FEATURES = ["recency_days", "frequency", "monetary", "avg_order_value",
                    "avg_basket_size", "discount_usage_rate", "category_diversity"]
LOG_FEATURES = ["monetary", "frequency", "avg_order_value"]


def _transformed(c: str) -> F.Column:
    x = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    return F.log1p(x) if c in LOG_FEATURES else x


def feature_matrix(features: DataFrame) -> DataFrame:
    return features.select("customer_id", *[_transformed(c).alias(c) for c in CLUSTER_FEATURES])


def standardize_cols(df: DataFrame, cols) -> DataFrame:
    """Replace ``cols`` by (x - mean) / population std (a zero std scales by
    1), statistics from one global aggregate attached as a 1-row frame."""
    stats = df.groupBy().agg(*[F.avg(c).alias(f"_mu_{c}") for c in cols],
                             *[F.stddev_pop(c).alias(f"_sd_{c}") for c in cols])
    out = attach(df, stats)
    for c in cols:
        sd = F.col(f"_sd_{c}")
        scale = F.when(sd.isNull() | (sd == 0), F.lit(1.0)).otherwise(sd)
        out = out.withColumn(c, (F.col(c) - F.col(f"_mu_{c}")) / scale)
    return out.drop(*[f"_mu_{c}" for c in cols], *[f"_sd_{c}" for c in cols])


def standardize(matrix: DataFrame) -> DataFrame:
    return standardize_cols(matrix, CLUSTER_FEATURES).select("customer_id", *CLUSTER_FEATURES)


# standardised copies of the cluster features, kept next to the feature
# columns so that assigning clusters is a projection, not a join
Z_FEATURES = [f"z_{c}" for c in CLUSTER_FEATURES]


def with_scaled(features: DataFrame) -> DataFrame:
    wide = features.select("*", *[_transformed(c).alias(f"z_{c}") for c in CLUSTER_FEATURES])
    return standardize_cols(wide, Z_FEATURES)


def assemble(scaled: DataFrame, cols=CLUSTER_FEATURES) -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol="features") \
        .transform(scaled).select("customer_id", "features")


def center_tolerance(k: int, rel_tol: float = 1e-4, mean_variance: float = 1.0) -> float:
    """Spark's ``tol`` for the reference's convergence rule.

    The reference stops when the *summed* squared shift of all centres is at
    most ``rel_tol * mean feature variance``; Spark stops when *every*
    centre moved at most ``tol`` (a distance).  Requiring each squared shift
    to be at most ``rel_tol * var / k`` implies the summed rule, so
    ``tol = sqrt(rel_tol * var / k)``.  Standardised features have variance 1.
    """
    return (rel_tol * mean_variance / k) ** 0.5


def _fit(data: DataFrame, k: int, seed: int, max_iter: int, tol: float | None) -> KMeansModel:
    tol = center_tolerance(k) if tol is None else tol
    return KMeans(k=k, seed=seed, maxIter=max_iter, tol=tol, initMode="k-means||",
                  featuresCol="features", predictionCol="cluster").fit(data)


def fit_best_many(data: DataFrame, ks, n_init: int = 10, seed: int = 42,
                  max_iter: int = 300, tol: float | None = None, parallel: int = 16) -> dict[int, KMeansModel]:
    """Per k, the lowest-cost model of ``n_init`` seeded fits (first seed wins
    ties).  All (k, seed) fits are independent Spark jobs submitted from a
    thread pool: each fit is a chain of short jobs, so running them side by
    side keeps the executors busy when the customer table is small, and costs
    nothing extra when it is large."""
    tasks = [(k, seed + i) for k in ks for i in range(n_init)]
    with ThreadPoolExecutor(max_workers=max(1, min(parallel, len(tasks)))) as pool:
        models = list(pool.map(lambda t: _fit(data, t[0], t[1], max_iter, tol), tasks))
    best: dict[int, KMeansModel] = {}
    for (k, _), m in zip(tasks, models):
        if k not in best or m.summary.trainingCost < best[k].summary.trainingCost:
            best[k] = m
    return best


def fit_best(data: DataFrame, k: int, n_init: int = 10, seed: int = 42,
             max_iter: int = 300, tol: float | None = None, parallel: int = 16) -> KMeansModel:
    return fit_best_many(data, [k], n_init, seed, max_iter, tol, parallel)[k]


def predict_expr(centers: list[list[float]], cols=CLUSTER_FEATURES) -> F.Column:
    """Index of the nearest centre as a JVM expression (k x dims terms, first
    index on ties): ``least`` over (distance, index) structs."""
    parts = []
    for j, c in enumerate(centers):
        d = None
        for x, cx in zip(cols, c):
            t = (F.col(x) - F.lit(float(cx))) * (F.col(x) - F.lit(float(cx)))
            d = t if d is None else d + t
        parts.append(F.struct(d.alias("d"), F.lit(j).alias("j")))
    return (F.least(*parts) if len(parts) > 1 else parts[0])["j"].cast("int")


def assign(scaled: DataFrame, centers: list[list[float]]) -> DataFrame:
    """``scaled`` (with the z_ columns) + cluster: the nearest centre."""
    return scaled.withColumn("cluster", predict_expr(centers, Z_FEATURES))


def inertia(scaled: DataFrame, centers: list[list[float]]) -> float:
    """Sum of squared distances to the nearest centres."""
    near = None
    for c in centers:
        d = sum(((F.col(x) - F.lit(float(v))) * (F.col(x) - F.lit(float(v))) for x, v in zip(Z_FEATURES, c)), F.lit(0.0))
        near = d if near is None else F.least(near, d)
    return scaled.agg(F.sum(near)).first()[0] or 0.0


def squared_silhouette(scaled: DataFrame, centers: list[list[float]]) -> float:
    """Silhouette over squared Euclidean distances (not the Euclidean one)."""
    pred = VectorAssembler(inputCols=Z_FEATURES, outputCol="features").transform(assign(scaled, centers))
    return ClusteringEvaluator(featuresCol="features", predictionCol="cluster", metricName="silhouette",
                               distanceMeasure="squaredEuclidean").evaluate(pred)


def silhouettes(scaled: DataFrame, centers: dict[int, list[list[float]]], **options) -> dict[int, Score]:
    """Euclidean silhouette of the nearest-centre clusters of each k, all in one pass; ``tolerance=0`` measures all pairs."""
    ks = list(centers)
    names = [f"_c{k}" for k in ks]
    labelled = scaled.select(*Z_FEATURES, *[predict_expr(centers[k], Z_FEATURES).alias(n) for k, n in zip(ks, names)])
    return dict(zip(ks, euclidean_silhouettes(labelled, Z_FEATURES, names, **options)))


def renumbered(scaled: DataFrame, centers: list[list[float]]) -> DataFrame:
    """Feature table + canonical cluster id: clusters renumbered by mean spend (desc), then mean
    recency, then the centre's place, so positional labels do not depend on arbitrary ids."""
    # the staged input holds the feature columns too: a projection, no join
    joined = scaled.withColumn("_raw", predict_expr(centers, Z_FEATURES)).drop(*Z_FEATURES)
    order = joined.groupBy("_raw").agg(stable_mean("monetary").alias("_m"), F.avg("recency_days").alias("_r"))
    renum = order.select("_raw", (F.row_number().over(
        Window.orderBy(F.desc("_m"), F.asc("_r"), F.asc("_raw"))) - 1).cast("int").alias("cluster"))
    return joined.join(F.broadcast(renum), "_raw", "inner").drop("_raw")


def fit_from(scaled: DataFrame, centers: list[list[float]], steps: int) -> list[list[float]]:
    """Centres after ``steps`` Lloyd steps from the given ones."""
    from basketry.operators import multikmeans as mk
    run = mk.Run(k=len(centers), seed=0, centers=[list(c) for c in centers])
    return mk.fit_runs(mk.prepare(scaled, "customer_id", Z_FEATURES), [run], max_iter=steps, tol=-1.0)[0].centers


def elbow_row(k: int, cost: float, silhouette: float) -> tuple:
    """k, inertia and silhouette with the digits of the elbow table."""
    return k, round(float(cost), 2), round(float(silhouette), 4)


def fixed_centers(k: int) -> list[list[float]]:
    """Documented centres for checks: coordinate d of centre j is ((7j + 3d) mod 5 - 2) * 0.6."""
    return [[((7 * j + 3 * d) % 5 - 2) * 0.6 for d in range(len(CLUSTER_FEATURES))] for j in range(k)]


class Segmentation:
    """Sweep k over ``ks`` (``n_init`` seeds each), keep the best model per k,
    label the final k.

    ``engine="batched"`` (default) fits all (k, seed) runs together, one pass
    over the points per Lloyd iteration (``operators/multikmeans``);
    ``engine="ml"`` fits each run with ``pyspark.ml.clustering.KMeans``
    (k-means|| init), concurrently."""

    def __init__(self, spark: SparkSession, features: DataFrame, ks=range(2, 9), final_k: int = 5,
                 n_init: int = 10, seed: int = 42, stage=None, engine: str = "batched"):
        self.spark = spark
        self.features = features
        self.ks = list(ks)
        self.final_k = final_k
        self.n_init = n_init
        self.seed = seed
        self.engine = engine
        scaled = with_scaled(features)
        # every iteration re-plans over this input: always cut its lineage,
        # as a staged parquet table or a reliable checkpoint (shared folder)
        if stage is not None:
            scaled = stage("kmeans_input", scaled)
        else:
            checkpoint_dir(spark)
            scaled = scaled.checkpoint(eager=True)
        self.scaled = scaled.persist(StorageLevel.MEMORY_AND_DISK)
        self.centers: dict[int, list[list[float]]] = {}
        self.metrics: dict[int, tuple[float, Score]] = {}

    def _vectors(self) -> DataFrame:
        return assemble(self.scaled, Z_FEATURES)

    def fit_all(self) -> None:
        todo = [k for k in dict.fromkeys(self.ks + [self.final_k]) if k not in self.centers]
        if not todo:
            return
        if self.engine == "ml":
            data = self._vectors().persist(StorageLevel.MEMORY_AND_DISK)
            fitted = fit_best_many(data, todo, self.n_init, self.seed)
            data.unpersist()
            found = {k: ([list(c) for c in m.clusterCenters()], m.summary.trainingCost)
                     for k, m in fitted.items()}
        else:
            from basketry.operators import multikmeans as mk
            pts = mk.prepare(self.scaled, "customer_id", Z_FEATURES)
            runs = mk.fit_runs(pts, mk.make_runs(todo, self.n_init, self.seed))
            found = {k: (r.centers, r.inertia) for k, r in mk.best_per_k(runs).items()}
        scores = silhouettes(self.scaled, {k: found[k][0] for k in todo})
        for k in todo:
            self.centers[k] = found[k][0]
            self.metrics[k] = (found[k][1], scores[k])

    def sweep(self) -> DataFrame:
        """Elbow table (k, inertia, euclidean_silhouette, silhouette_error, squared_silhouette, suggested)."""
        self.fit_all()
        rows = []
        for k in self.ks:
            cost, score = self.metrics[k]
            rows.append((*elbow_row(k, cost, score.silhouette or 0.0), round(score.error or 0.0, 4), round(score.squared or 0.0, 4)))
        best = max(self.ks, key=lambda k: (self.metrics[k][1].silhouette or 0.0, -k))
        return self.spark.createDataFrame(
            [(*r, r[0] == best) for r in rows],
            "k int, inertia double, euclidean_silhouette double, silhouette_error double, squared_silhouette double, suggested boolean")

    def clustered(self) -> DataFrame:
        """Feature table + canonical cluster id of the final k (``renumbered``)."""
        self.fit_all()
        return renumbered(self.scaled, self.centers[self.final_k])
