"""Spark ML jobs: elastic-net linear regression with RMSE, and ALS
matrix-factorisation recommendations.

Solvers are Spark ML's (distributed statistics / block-partitioned factor
updates); this module only assembles inputs, splits, and shapes outputs.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import materialize

# Fixed solver settings of the original jobs.
REG_PARAM = 0.3
ELASTIC_NET = 0.8
MAX_ITER = 100
TOL = 1e-6
ALS_ITER = 5
ALS_REG = 0.01
ALS_TOP = 15


def assemble(df: DataFrame, label: str, features: list[str]) -> DataFrame:
    """M1: ``(label, features)`` with a dense feature vector."""
    va = VectorAssembler(inputCols=features, outputCol="features")
    return va.transform(df.select(F.col(label).cast("double").alias("label"),
                                  *[F.col(f).cast("double").alias(f) for f in features])) \
        .select("label", "features")


def split(df: DataFrame, train_when: Column | None = None, weights=(0.7, 0.3),
          seed: int = 42):
    """M2: train/test split.  With ``train_when`` the split is keyed (rows
    where it holds train, the rest test: reproducible across engines);
    otherwise ``randomSplit`` with a fixed seed."""
    if train_when is not None:
        flagged = df.withColumn("_train", train_when)
        return (flagged.where("_train").drop("_train"),
                flagged.where(~F.col("_train")).drop("_train"))
    a, b = df.randomSplit(list(weights), seed)
    return a, b


def content_split(df: DataFrame, weights=(0.7, 0.3), seed: int = 42):
    """M2, random: like ``randomSplit``, but a row's side depends on its content
    alone: the first eight hex digits of ``md5(seed|columns|k)`` for the k-th copy
    of a row.  The split is the same however the rows are partitioned or recomputed.

    Copies are counted (combined map-side) and dealt out anew, so many copies
    of one row need no common sort."""
    bound = f"{min(int(weights[0] / sum(weights) * (1 << 32)), (1 << 32) - 1):08x}"
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in df.columns]
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    # copies in steps of 2^16, so that one row's copies can be dealt out over tasks
    steps = copies.withColumn("_step", F.explode(F.expr("sequence(0L, (_n - 1) div 65536)")))
    each = steps.withColumn("_k", F.explode(F.expr("sequence(_step * 65536 + 1, least(_n, (_step + 1) * 65536))")))
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), *cells, F.col("_k").cast("string")))
    flagged = each.withColumn("_train", F.substring(key, 1, 8) < bound)
    return (flagged.where("_train").select(*df.columns), flagged.where(~F.col("_train")).select(*df.columns))


def fit_linear(train: DataFrame, reg_param: float = REG_PARAM,
               elastic_net: float = ELASTIC_NET, max_iter: int = MAX_ITER, tol: float = TOL):
    """M3: elastic-net linear regression."""
    lr = LinearRegression(maxIter=max_iter, regParam=reg_param,
                          elasticNetParam=elastic_net, tol=tol,
                          featuresCol="features", labelCol="label")
    return lr.fit(train)


def rmse(model, test: DataFrame) -> DataFrame:
    """``(n, rmse)`` of the model on the test rows, one
    distributed aggregate over the predictions."""
    pred = model.transform(test)
    err = F.col("prediction") - F.col("label")
    return pred.agg(F.count(F.lit(1)).alias("n"),
                    F.sqrt(F.avg(err * err)).alias("rmse"))


def gram(df: DataFrame) -> tuple[int, list[list[float]]]:
    """``(n, moments)`` of assembled rows in one pass: the means of all products of
    (1, features, label)."""
    n = int(df.schema["features"].metadata.get("ml_attr", {}).get("num_attrs") or len(df.first()["features"]))
    x = vector_to_array("features")
    cells = [F.lit(1.0), *[F.get(x, F.lit(k)) for k in range(n)], F.col("label")]
    pairs = [(i, j) for i in range(n + 2) for j in range(i, n + 2)]
    row = df.agg(F.count(F.lit(1)), *[F.avg(cells[i] * cells[j]) for i, j in pairs]).collect()[0]   # one row
    m = [[0.0] * (n + 2) for _ in range(n + 2)]
    for (i, j), v in zip(pairs, row[1:]):
        m[i][j] = m[j][i] = v
    return row[0], m


def kkt_residuals(model, train: DataFrame, reg_param: float = REG_PARAM, elastic_net: float = ELASTIC_NET) -> DataFrame:
    """M3: ``(feature, coef, residual)``: how far each coefficient is from meeting the
    stationarity condition of the elastic net, in units of the label's deviation.

    With features and label in standard deviations, correlations c with the label, R among the
    features, weights w and penalties l1, l2 (in units of the label's deviation): ``c - R w - l2 w = l1
    sign(w)`` where w is not zero, and at most l1 in size where it is."""
    _, m = gram(train)
    k = len(m) - 1
    mean = m[0]
    dev = [math.sqrt(max(0.0, m[i][i] - mean[i] ** 2)) for i in range(k + 1)]
    corr = lambda i, j: (m[i][j] - mean[i] * mean[j]) / (dev[i] * dev[j])
    used = [i for i in range(1, k) if dev[i] > 0]
    w = {i: float(model.coefficients[i - 1]) * dev[i] / dev[k] for i in used}
    l1, l2 = elastic_net * reg_param / dev[k], (1 - elastic_net) * reg_param / dev[k]
    rows = []
    for i in used:
        slope = corr(i, k) - sum(corr(i, j) * w[j] for j in used) - l2 * w[i]
        rows.append((i - 1, float(model.coefficients[i - 1]),
                     abs(slope - math.copysign(l1, w[i])) if w[i] else max(0.0, abs(slope) - l1)))
    return train.sparkSession.createDataFrame(rows, "feature int, coef double, residual double")


def coefficients(model, spark) -> DataFrame:
    """``(coef, intercept)`` of a one-feature model as a one-row table."""
    return spark.createDataFrame(
        [(float(model.coefficients[0]), float(model.intercept))],
        "coef double, intercept double")


def dense_index(ids: DataFrame, col: str, out: str, dtype: str = "int") -> DataFrame:
    """``(col, out)``: the distinct values of ``col`` numbered 0..n-1.

    Distributed: the distinct ids are written once (so partition numbers and
    in-partition positions are fixed), per-partition counts (one row per
    partition, a bounded table) are turned into offsets by a running sum,
    and each id's number is its partition offset plus its position.  No
    global sort and no single-task window over the ids.
    """
    pos = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)
    d = ids.select(col).distinct().select(
        col, F.spark_partition_id().alias("_p"), pos.alias("_i"))
    d = materialize(d, "dense-ids")
    per_part = d.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    offsets = per_part.select(
        "_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_off"))
    # one row per input partition: a proven bound for the broadcast
    return d.join(F.broadcast(offsets), "_p").select(
        col, (F.col("_off") + F.col("_i")).cast(dtype).alias(out))


class ALSFit:
    """An ALS model plus the id maps used when ids exceed the int range, and the
    ratings it was fitted on (``user, item, rating`` in the model's ids)."""

    def __init__(self, model, users: DataFrame | None, items: DataFrame | None, ratings: DataFrame):
        self.model = model
        self.ratings = ratings
        self.user_map = users      # (user, user_ix) or None
        self.item_map = items      # (item, item_ix) or None


def fit_als(ratings: DataFrame, user: str, item: str, rating: str,
            max_iter: int = ALS_ITER, reg_param: float = ALS_REG, seed: int = 42,
            rank: int = 10) -> ALSFit:
    """M6: ALS on ``(user, item, rating)``.

    Spark's ALS takes int ids.  Columns of an int type are used as they are;
    wider ids are always renumbered with ``dense_index`` and mapped back in
    ``recommend``, whatever values they hold.  The ratings feed the two id
    maps and the fit, so they are written once.
    """
    r = ratings.select(F.col(user).alias("user"), F.col(item).alias("item"),
                       F.col(rating).cast("float").alias("rating"))
    dense_ids = not {t for c, t in r.dtypes if c in ("user", "item")} <= {"int", "smallint", "tinyint"}
    if dense_ids:
        r = materialize(r, "als-ratings")
    als = ALS(maxIter=max_iter, regParam=reg_param, rank=rank, seed=seed,
              userCol="user", itemCol="item", ratingCol="rating")
    if not dense_ids:
        data = r.select(F.col("user").cast("int").alias("user"),
                        F.col("item").cast("int").alias("item"), "rating")
        return ALSFit(als.fit(data), None, None, data)
    users = dense_index(r, "user", "user_ix")
    items = dense_index(r, "item", "item_ix")
    data = (r.join(users, "user").join(items, "item")
            .select(F.col("user_ix").alias("user"), F.col("item_ix").alias("item"), "rating"))
    return ALSFit(als.fit(data), users, items, data)


def recommend(fit: ALSFit, users: DataFrame, k: int = ALS_TOP) -> DataFrame:
    """Top ``k`` items for each user of ``users (user)`` as rows
    ``(user, rank, item, rating)``, rank 1 = best, in the caller's ids."""
    if fit.user_map is not None:
        users = users.join(fit.user_map, "user").select(F.col("user_ix").alias("user"))
    else:
        users = users.select(F.col("user").cast("int").alias("user"))
    recs = fit.model.recommendForUserSubset(users, k)
    out = recs.select("user", F.posexplode("recommendations").alias("pos", "rec")) \
        .select("user", (F.col("pos") + 1).alias("rank"),
                F.col("rec.item").alias("item"), F.col("rec.rating").alias("rating"))
    if fit.user_map is not None:
        out = (out.withColumnRenamed("user", "user_ix").withColumnRenamed("item", "item_ix")
               .join(fit.user_map, "user_ix").join(fit.item_map, "item_ix")
               .select("user", "rank", "item", "rating"))
    return out.select(F.col("user").cast("bigint").alias("user"), "rank",
                      F.col("item").cast("bigint").alias("item"), "rating")


def normal_residuals(fit: ALSFit, reg_param: float = ALS_REG) -> DataFrame:
    """M6: ``(user, residual)`` in the model's ids.  Users are solved last, so
    each user's factors x must meet ``sum of v (r - v.x) = reg * n * x`` over the n
    ratings r of items with factors v; the residual is the largest component's gap
    as a share of the largest component of ``sum of |v r|``."""
    rank = fit.model.rank
    users = fit.model.userFactors.select(F.col("id").alias("user"), F.col("features").alias("x"))
    items = fit.model.itemFactors.select(F.col("id").alias("item"), F.col("features").alias("v"))
    dot = F.aggregate(F.zip_with("v", "x", lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0),
                      lambda s, y: s + y)
    rows = (fit.ratings.join(items, "item").join(users, "user")
            .withColumn("gap", F.col("rating").cast("double") - dot))
    part = lambda c, k: F.get(F.col(c), F.lit(k)).cast("double")
    sums = rows.groupBy("user").agg(
        *[F.sum(part("v", k) * F.col("gap") - reg_param * part("x", k)).alias(f"g{k}") for k in range(rank)],
        *[F.sum(F.abs(part("v", k) * F.col("rating"))).alias(f"s{k}") for k in range(rank)])
    return sums.select("user", (F.greatest(*[F.abs(f"g{k}") for k in range(rank)])
                                / F.greatest(*[F.col(f"s{k}") for k in range(rank)])).alias("residual"))
