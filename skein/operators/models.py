"""Classifiers with time-ordered evaluation, on Spark ML, and the reasons for their scores."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import Bucketizer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..steps import materialize


def time_split(df: DataFrame, month: str) -> dict[str, DataFrame]:
    """history, fit, validation and test: the last four months, in order. The months are a handful of driver values."""
    months = [r[0] for r in df.select(month).filter(F.col(month).isNotNull()).distinct().orderBy(F.desc(month)).limit(4).collect()][::-1]
    names = ("history", "fit", "validation", "test")[-len(months) :] if months else ()
    return {n: df.filter(F.col(month) == m) for n, m in zip(names, months, strict=True)}


#: Buckets of a histogram round, and values that are looked at on the driver to settle a median.
BUCKETS, FEW = 1024, 4096


def medians(df: DataFrame, numeric: list[str]) -> dict[str, float]:
    """Exact medians, the mean of the two middle values of an even count; 0 for a column of nulls.

    All columns at once: histograms (``BUCKETS`` counts for each column) narrow the range in which the
    middle lies until it holds ``FEW`` rows at most, or one value. No task sees a whole column.
    """
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in numeric])).alias("x")).select("x.c", "x.v").filter("v IS NOT NULL AND NOT isnan(v)") if numeric else None
    ends = {r["c"]: r for r in long.groupBy("c").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n")).collect()} if numeric else {}
    out = dict.fromkeys(numeric, 0.0)
    wanted = {(c, k): [r["lo"], r["hi"], k, r["n"]] for c, r in ends.items() for k in sorted({(r["n"] + 1) // 2, r["n"] // 2 + 1})}  # range, rank in it, rows in it
    found: dict[tuple, float] = {}
    while wanted:
        listed = df.sparkSession.createDataFrame([(c, k, w[0], w[1]) for (c, k), w in wanted.items()], "c string, k long, lo double, hi double")
        rows = long.join(F.broadcast(listed), "c").filter("v >= lo AND v <= hi")
        if all(w[3] <= FEW or w[0] == w[1] for w in wanted.values()):
            some = [(key, w) for key, w in wanted.items() if w[0] != w[1]]
            values: dict[tuple, list] = {key: [] for key, _ in some}
            for r in rows.filter("lo < hi").select("c", "k", "v").collect() if some else []:
                values[r["c"], r["k"]].append(r["v"])
            found |= {key: w[0] if w[0] == w[1] else sorted(values[key])[w[2] - 1] for key, w in wanted.items()}
            break
        bucket = F.when(F.col("hi") > F.col("lo"), F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * BUCKETS), F.lit(BUCKETS - 1))).otherwise(0)
        counts: dict[tuple, list] = {}
        for r in rows.groupBy("c", "k", bucket.alias("b")).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("c", "k", "b").collect():
            counts.setdefault((r["c"], r["k"]), []).append((r["lo"], r["hi"], r["n"]))
        for key, w in wanted.items():
            for lo, hi, n in counts[key]:
                if w[2] <= n:
                    w[0], w[1], w[3] = lo, hi, n
                    break
                w[2] -= n
    for c, r in ends.items():
        out[c] = (found[c, (r["n"] + 1) // 2] + found[c, r["n"] // 2 + 1]) / 2
    return out


def impute(df: DataFrame, values: dict[str, float]) -> DataFrame:
    """Nulls become the given values; ``<name>_missing`` says where."""
    return df.withColumns({f"{c}_missing": F.col(c).isNull().cast("double") for c in values} | {c: F.coalesce(F.col(c).cast("double"), F.lit(v)) for c, v in values.items()})


def fit_logistic(train: DataFrame, numeric: list[str], categorical: list[str], label: str, *, c: float = 1.0, weighted: bool = False, values: dict[str, float] | None = None) -> tuple[PipelineModel, dict[str, float]]:
    """Median imputation with indicators, scaling, one-hot of all levels, then L2 logistic regression.

    The penalty is ``1 / (c * rows)``, the same objective as an inverse strength of c on summed losses. ``values``: the medians, where known.
    """
    values = {x: values[x] for x in numeric} if values else medians(train, numeric)
    d = impute(train, values).withColumn("__y", F.col(label).cast("double"))
    n, positives = d.agg(F.count("*"), F.coalesce(F.sum("__y"), F.lit(0.0))).first()
    weight = F.when(F.col("__y") == 1, n / (2 * max(positives, 1))).otherwise(n / (2 * max(n - positives, 1))) if weighted else F.lit(1.0)
    stages = [StringIndexer(inputCol=x, outputCol=f"{x}_ix", handleInvalid="keep") for x in categorical]
    stages += [OneHotEncoder(inputCols=[f"{x}_ix" for x in categorical], outputCols=[f"{x}_hot" for x in categorical], dropLast=False)] if categorical else []
    stages += [
        VectorAssembler(inputCols=numeric + [f"{x}_missing" for x in numeric], outputCol="num_raw"), StandardScaler(inputCol="num_raw", outputCol="num_std", withMean=True, withStd=True),
        VectorAssembler(inputCols=["num_std"] + [f"{x}_hot" for x in categorical], outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol="__y", weightCol="__w", regParam=1.0 / (c * max(n, 1)), standardization=False, maxIter=200, tol=1e-8),
    ]
    return Pipeline(stages=stages).fit(d.withColumn("__w", weight)), values


#: Bins of a tree's column.
BINS = 64


def bin_edges(df: DataFrame, numeric: list[str], bins: int = BINS) -> list[list[float]]:
    """Lower edges of each column's bins but the first: a bin for each value where there are ``bins`` at most, else quantiles over all rows."""
    if not numeric:
        return []
    cut = lambda c: F.percentile_approx(c, [k / bins for k in range(1, bins)], 100 * bins)
    found = df.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(numeric) for n, f in (("n", F.approx_count_distinct), ("top", F.max), ("q", cut))]).first()
    few = [i for i in range(len(numeric)) if found[f"n{i}"] <= 2 * bins]  # the count is approximate
    values = df.agg(*[F.collect_set(numeric[i]).alias(f"v{i}") for i in few]).first() if few else {}
    edges = []
    for i in range(len(numeric)):
        v = sorted(set(values[f"v{i}"])) if i in few else None
        if v is None or len(v) > bins:
            some = [math.nextafter(q, math.inf) for q in sorted(set(found[f"q{i}"])) if q < found[f"top{i}"]]
        else:
            some = [m if a < (m := a / 2 + b / 2) else b for a, b in zip(v, v[1:], strict=False)]
        edges.append(some or [math.nextafter(found[f"top{i}"] or 0.0, math.inf)])  # one value: all in the first bin
    return edges


def fit_trees(train: DataFrame, numeric: list[str], categorical: list[str], label: str, *, trees: int = 40, depth: int = 5, rate: float = 0.1, seed: int = 42, grouped: bool = False) -> tuple[PipelineModel, dict[str, float]]:
    """Gradient-boosted trees; nulls become a value below all others, with an indicator.

    With ``grouped``, rows equal in all bins and the label are one row that weighs as many, written once: for columns whose bins
    have fewer combinations than there are rows. Its bins come from all rows; Spark's own come from a sample of 10,000.
    """
    values = dict.fromkeys(numeric, -1e6)
    d = impute(train, values).withColumn("__y", F.col(label).cast("double"))
    stages = [StringIndexer(inputCol=x, outputCol=f"{x}_ix", handleInvalid="keep") for x in categorical]
    missing, index = [f"{x}_missing" for x in numeric], [f"{x}_ix" for x in categorical]
    trained = GBTClassifier(featuresCol="features", labelCol="__y", maxIter=trees, maxDepth=depth, stepSize=rate, maxBins=BINS, seed=seed)
    if not grouped:
        return Pipeline(stages=[*stages, VectorAssembler(inputCols=numeric + missing + index, outputCol="features"), trained]).fit(d), values
    codes = [f"{x}_bin" for x in numeric]
    stages += [Bucketizer(splitsArray=[[-math.inf, *e, math.inf] for e in bin_edges(d, numeric)], inputCols=numeric, outputCols=codes)] if numeric else []
    coded = Pipeline(stages=stages).fit(d)
    plain = [F.col(c).alias(c, metadata={}) for c in codes]  # numbers with an order: the stage calls them categories
    rows = materialize(coded.transform(d).groupBy(*plain, *missing, *index, "__y").agg(F.count("*").cast("double").alias("__n")), "binned-rows")
    fitted = Pipeline(stages=[VectorAssembler(inputCols=codes + missing + index, outputCol="features"), trained.setWeightCol("__n")]).fit(rows)
    return PipelineModel(stages=coded.stages + fitted.stages), values


def score(model: tuple[PipelineModel, dict[str, float]], df: DataFrame, name: str) -> DataFrame:
    """``df`` with the probability of the label."""
    fitted, values = model
    original = [F.col(c).alias(f"__keep_{c}") for c in df.columns]
    d = impute(df.select("*", *original), values)
    out = fitted.transform(d).withColumn(name, vector_to_array("probability")[1])
    return out.select(*[F.col(f"__keep_{c}").alias(c) for c in df.columns], name)


def gain_importance(model: tuple[PipelineModel, dict[str, float]], numeric: list[str], categorical: list[str]) -> list[tuple[str, float]]:
    """Split-gain shares of the trees' features, largest first; a column and its indicator count together."""
    names = numeric + numeric + categorical
    shares: dict[str, float] = {}
    for name, x in zip(names, model[0].stages[-1].featureImportances.toArray().tolist(), strict=True):
        shares[name] = shares.get(name, 0.0) + x
    return sorted(shares.items(), key=lambda x: (-x[1], x[0]))


def contributions(df: DataFrame, weights: dict[str, float], means: dict[str, float], name: str = "contributions") -> DataFrame:
    """Each feature's part of a linear score, against the mean: exact Shapley values of a linear model. Array of (feature, value, part)."""
    parts = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"), F.coalesce((F.col(c).cast("double") - F.lit(means[c])) * w, F.lit(0.0)).alias("part")) for c, w in weights.items()])
    return df.withColumn(name, parts)


def linear_parts(model: tuple[PipelineModel, dict[str, float]], numeric: list[str]) -> tuple[dict[str, float], dict[str, float]]:
    """A fitted logistic model's weight and mean of each numeric column, in the columns' own units."""
    scaler, fitted = (next(s for s in model[0].stages if type(s).__name__ == n) for n in ("StandardScalerModel", "LogisticRegressionModel"))
    spread, means, weights = scaler.std.toArray(), scaler.mean.toArray(), fitted.coefficients.toArray()
    return {c: float(weights[i] / spread[i]) if spread[i] else 0.0 for i, c in enumerate(numeric)}, {c: float(means[i]) for i, c in enumerate(numeric)}


def top_reasons(parts: str = "contributions", n: int = 3, unknown: dict[str, str] | None = None, text: bool = False) -> Column:
    """Text of the n parts that move the score most, either way, by absolute value; ties by the order of the features.

    A null value reads as the parts' ``text`` where they have one and it is not null, then as the words that ``unknown`` gives for the feature, else "n/a".
    """
    own = lambda x: x["text"] if text else F.lit(None).cast("string")
    order = F.array_sort(F.transform(parts, lambda x, i: F.struct((-F.abs(x["part"])).alias("k"), i.alias("i"), x["feature"].alias("feature"), x["value"].alias("value"), x["part"].alias("part"), own(x).alias("text"))))
    words = F.create_map(*[F.lit(v) for kv in (unknown or {"": ""}).items() for v in kv])
    shown = lambda x: F.coalesce(F.when(x["value"].isNotNull(), F.format_string("%.1f", x["value"])), x["text"], F.try_element_at(words, x["feature"]), F.lit("n/a"))
    return F.array_join(F.transform(F.slice(order, 1, n), lambda x: F.concat(x["feature"], F.lit(" = "), shown(x), F.lit(" ("), F.format_string("%+.3f", x["part"]), F.lit(")"))), "; ")


def mean_contribution(df: DataFrame, groups: dict[str, str], parts: str = "contributions", rows: str | None = None) -> DataFrame:
    """Sum of the absolute parts of each feature group, and its share of all; ``rows``: how many rows each stands for."""
    times = F.col(rows) if rows else F.lit(1)
    x = df.select(F.explode(parts).alias("x"), times.alias("times")).select(F.col("x.feature").alias("feature"), (F.abs(F.col("x.part")) * F.col("times")).alias("a"))
    name = reduce(lambda acc, kv: acc.when(F.col("feature") == kv[0], kv[1]), list(groups.items())[1:], F.when(F.col("feature") == list(groups)[0], list(groups.values())[0])).otherwise(F.col("feature"))
    by = x.groupBy(name.alias("feature_group")).agg(F.sum("a").alias("total"))
    return by.withColumn("all", F.sum("total").over(Window.partitionBy(F.lit(0)))).select("feature_group", "total", F.when(F.col("all") > 0, F.col("total") / F.col("all")).alias("share"))


def suspicious(auc: float | None, limit: float = 0.92) -> bool:
    """A test AUC too good to be true points to leakage."""
    return auc is not None and auc > limit


def rules(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Rules as scorers: (every column, model, score), a row for each rule; a column is its rule's score, with nothing to fit."""
    made = F.array(*[F.struct(F.lit(n).alias("model"), F.col(c).cast("double").alias("score")) for n, c in columns.items()])
    return df.withColumn("__x", F.explode(made)).select(*df.columns, "__x.model", "__x.score")


def ablation(fit: DataFrame, validation: DataFrame, variants: dict[str, list[str]], categorical: list[str], label: str, *, trees: int = 40, depth: int = 5) -> DataFrame:
    """ROC AUC and average precision of both models for each feature list, on rows that they were not fitted on."""
    from .evaluation import curve_metrics

    parts, values = [], medians(fit, sorted({c for v in variants.values() for c in v}))  # a column's median is the same in each list
    for name, numeric in variants.items():
        for model, fitted in (("logistic", fit_logistic(fit, numeric, categorical, label, values=values)), ("trees", fit_trees(fit, numeric, categorical, label, trees=trees, depth=depth))):
            scored = score(fitted, validation, "__score").select("__score", label)
            parts.append(curve_metrics(scored, "__score", label).select(F.lit(name).alias("variant"), F.lit(len(numeric) + len(categorical)).alias("n_features"), F.lit(model).alias("model"), F.round("roc_auc", 4).alias("roc_auc"), F.round("average_precision", 4).alias("average_precision")))
    return reduce(DataFrame.unionByName, parts)


def save(model: tuple[PipelineModel, dict[str, float]], path: str) -> None:
    """Writes the stages, and the imputed values as a small table beside them."""
    fitted, values = model
    fitted.write().overwrite().save(f"{path}/stages")
    SparkSession.active().createDataFrame(sorted(values.items()), "feature string, value double").write.mode("overwrite").parquet(f"{path}/values")


def load(spark: SparkSession, path: str) -> tuple[PipelineModel, dict[str, float]]:
    values = {r["feature"]: r["value"] for r in spark.read.parquet(f"{path}/values").collect()}
    return PipelineModel.load(f"{path}/stages"), values
