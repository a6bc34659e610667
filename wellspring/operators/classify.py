"""Cell classes: the classifier interface, a rule-based one, trained ones on MLlib, calibration and label bookkeeping."""

from __future__ import annotations

from abc import ABC, abstractmethod

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, OneVsRest, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, StringIndexer, UnivariateFeatureSelector, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.ml.stat import Correlation
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wellspring.functions.barcodes import canon_plate, canon_well
from wellspring.functions.stats import clean, cumulative, exact_quantiles
from wellspring.session import materialize


class CellClassifier(ABC):
    """Subclass and implement classify_cells: rows in, the same rows with a class and a confidence out."""

    @abstractmethod
    def classify_cells(self, df: DataFrame) -> DataFrame: ...


class ThresholdClassifier(CellClassifier):
    """One feature, robustly scaled ((x - median) / IQR); over the cutoff it's the positive class.

    The confidence is the row's rank in its class over the class's size.
    """

    def __init__(self, feature: str, cutoff: float = 4.5, positive: str = "mitotic", negative: str = "interphase", keys: list[str] | None = None):
        self.feature, self.cutoff, self.positive, self.negative, self.keys = feature, cutoff, positive, negative, keys or []

    def classify_cells(self, df: DataFrame) -> DataFrame:
        v = clean(F.col(self.feature).cast("double"))
        q1, q2, q3 = exact_quantiles(df, v, [0.25, 0.5, 0.75])
        if q2 is None:
            return df.withColumns({"class": F.lit(None).cast("string"), "confidence": F.lit(None).cast("double")})
        scaled = (v - q2) / ((q3 - q1) or 1.0)
        out = df.withColumn("class", F.when(scaled > self.cutoff, self.positive).otherwise(self.negative))
        if self.keys:
            return _rank_share(out, "class", self.feature, self.keys)
        # Equal values are told apart by a number that is written with the rows.
        return _rank_share(materialize(out.withColumn("id_", F.monotonically_increasing_id()), "classes"), "class", self.feature, ["id_"]).drop("id_")


def _rank_share(df: DataFrame, group: str, value: str, keys: list[str]) -> DataFrame:
    """df with confidence (rank / size in the group). One order over all rows, by group and value, cumulated over range
    partitions: no task sorts a whole group. A group's ranks start where the groups before it end."""
    each = df.withColumns({"o_": F.struct(F.col(group), clean(F.col(value).cast("double")).alias("v"), *keys), "one_": F.lit(1)})
    before, confidence = 0, F.lit(None).cast("double")
    for r in sorted(df.groupBy(group).agg(F.count("*").alias("n")).collect(), key=lambda r: (r[0] is not None, r[0])):  # two classes
        confidence = F.when(F.col(group).eqNullSafe(r[0]), (F.col("r_") - before) / r[1]).otherwise(confidence)
        before += r[1]
    return cumulative(each, "o_", "one_", "r_").withColumn("confidence", confidence).drop("o_", "one_", "r_")


MODELS = {
    "lr": lambda label: LogisticRegression(labelCol=label, featuresCol="scaled_", maxIter=100, regParam=1e-3),
    "rf": lambda label: RandomForestClassifier(labelCol=label, featuresCol="scaled_", numTrees=100, seed=42),
    "gbt": lambda label: OneVsRest(classifier=GBTClassifier(featuresCol="scaled_", maxIter=20, seed=42), labelCol=label, featuresCol="scaled_"),
}


class TrainedClassifier(CellClassifier):
    """An MLlib pipeline over numeric features. Rows with a missing feature are left out when it classifies."""

    def __init__(self, model: PipelineModel, features: list[str], classes: list[str]):
        self.model, self.features, self.classes = model, features, classes

    def classify_cells(self, df: DataFrame) -> DataFrame:
        present = df.where(_all_present(self.features))
        out = self.model.transform(present)
        name = F.get(F.array(*map(F.lit, self.classes)), F.col("prediction").cast("int"))
        out = out.withColumn("class", name)
        if "probability" in out.columns:
            out = out.withColumn("p_", vector_to_array("probability")).withColumn("confidence", F.array_max("p_"))
            out = out.withColumns({f"prob_{c}": F.col("p_")[k] for k, c in enumerate(self.classes)}).drop("p_")
        return out.drop("raw_", "scaled_", "rawPrediction", "probability", "prediction")

    @staticmethod
    def train(df: DataFrame, features: list[str], label: str, kind: str = "lr", scale: bool = True, grid: dict | None = None, folds: int = 5, k_best: int | None = None) -> tuple[TrainedClassifier, float]:
        """The classifier fitted on all rows, and its balanced accuracy on about 30 % of each class, held out by a hash."""
        df = df.where(_all_present(features) & F.col(label).isNotNull()).withColumn("label_", F.col(label).cast("string"))
        indexer = StringIndexer(inputCol="label_", outputCol="label_index_", stringOrderType="alphabetAsc").fit(df)
        steps = [VectorAssembler(inputCols=features, outputCol="unselected_" if k_best else "raw_")]
        if k_best:
            steps.append(UnivariateFeatureSelector(featuresCol="unselected_", outputCol="raw_", labelCol="label_index_", selectionMode="numTopFeatures").setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(k_best))
        steps.append(StandardScaler(inputCol="raw_", outputCol="scaled_", withMean=scale, withStd=scale))
        model = MODELS[kind]("label_index_")
        data = indexer.transform(df)
        # By a hash of the row: about that share of each class, and no class has to be sorted.
        split = data.withColumn("r_", F.pmod(F.xxhash64(*features), F.lit(1000)) / 1000)
        judge = MulticlassClassificationEvaluator(labelCol="label_index_", metricName="weightedRecall")
        weights = split.groupBy("label_index_").agg(F.count("*").alias("n_"))
        split = split.join(F.broadcast(weights), "label_index_").withColumn("weight_", 1 / F.col("n_"))
        judge = judge.setWeightCol("weight_")
        pipeline = Pipeline(stages=[*steps, model])
        if grid:
            builder = ParamGridBuilder()
            for name, values in grid.items():
                builder = builder.addGrid(model.getParam(name), values)
            fitted = CrossValidator(estimator=pipeline, estimatorParamMaps=builder.build(), evaluator=judge, numFolds=folds, seed=42).fit(split.where("r_ >= 0.3"))
            test, final = fitted.bestModel, Pipeline(stages=[*steps, model.copy({model.getParam(k): fitted.bestModel.stages[-1].getOrDefault(k) for k in grid})])
        else:
            test, final = pipeline.fit(split.where("r_ >= 0.3")), pipeline
        accuracy = judge.evaluate(test.transform(split.where("r_ < 0.3")))
        return TrainedClassifier(final.fit(data), features, list(indexer.labels)), float(accuracy)


def _all_present(features: list[str]) -> Column:
    ok = F.lit(True)
    for f in features:
        ok = ok & clean(F.col(f).cast("double")).isNotNull()
    return ok


def enhance_features(df: DataFrame, features: list[str], label: str | None = None, variance: float = 0.01, correlation: float = 0.95, k_best: int | None = None) -> list[str]:
    """Features with more than this variance, without the later of each highly correlated pair, and of these the k best by ANOVA."""
    row = df.agg(*[F.var_pop(clean(F.col(f).cast("double"))).alias(f) for f in features]).first()
    kept = [f for f in features if row[f] is not None and row[f] > variance]
    if len(kept) > 1:
        x = VectorAssembler(inputCols=kept, outputCol="vector_", handleInvalid="skip").transform(df.select(*[F.col(f).cast("double").alias(f) for f in kept]))
        r = Correlation.corr(x, "vector_").first()[0].toArray()
        gone = {j for j in range(len(kept)) for i in range(j) if abs(r[i, j]) > correlation}
        kept = [f for k, f in enumerate(kept) if k not in gone]
    if k_best and label and len(kept) > k_best:
        from wellspring.functions.stats import anova_f

        long = df.select(label, *[F.col(f).cast("double").alias(f) for f in kept]).unpivot([label], kept, "feature", "value")
        best = {r.feature for r in anova_f(long, "value", label, ["feature"]).orderBy(F.desc_nulls_last("f"), "feature").limit(k_best).collect()}
        kept = [f for f in kept if f in best]
    return kept


def calibrate(classified: DataFrame, manual: DataFrame, keys: list[str], class_col: str = "class", confidence: str = "confidence", label: str = "label", method: str = "isotonic", least: int = 50) -> DataFrame:
    """classified with confidences replaced by the calibrated chance that the class is right, learned where labels exist.

    Isotonic regression; logistic where any class has fewer than `least` labels.
    """
    known = classified.join(manual.select(*keys, F.col(label).alias("label_")), keys).withColumn("right_", (F.col(class_col).cast("string") == F.col("label_").cast("string")).cast("double"))
    smallest = known.groupBy("label_").count().agg(F.min("count")).first()[0]
    if smallest is None:
        return classified
    if method == "isotonic" and smallest >= least:
        model = IsotonicRegression(featuresCol=confidence, labelCol="right_").fit(known.withColumn(confidence, F.col(confidence).cast("double")))
        x, y = list(model.boundaries), list(model.predictions)
        c = F.col(confidence)
        # Linear between the model's boundaries, which are few steps of a monotone function.
        out = F.lit(float(y[-1]))
        for k in range(len(x) - 1, 0, -1):
            slope = (float(y[k]) - float(y[k - 1])) / (float(x[k]) - float(x[k - 1])) if x[k] > x[k - 1] else 0.0
            out = F.when(c < float(x[k]), float(y[k - 1]) + (c - float(x[k - 1])) * slope).otherwise(out)
        out = F.when(c <= float(x[0]), F.lit(float(y[0]))).otherwise(out)
    else:
        both = known.agg(F.min("right_"), F.max("right_")).first()
        if both[0] == both[1]:
            out = F.lit(float(both[0]))
        else:
            x = VectorAssembler(inputCols=[confidence], outputCol="x_").transform(known)
            m = LogisticRegression(featuresCol="x_", labelCol="right_", standardization=False).fit(x)
            out = 1 / (1 + F.exp(-(F.col(confidence) * float(m.coefficients[0]) + float(m.intercept))))
    return classified.withColumn(confidence, F.when(F.col(confidence).isNotNull(), out))


def map_categories(df: DataFrame, label: str, mapping: dict, category: str = "category", default: str | None = None) -> DataFrame:
    pairs = F.create_map(*[F.lit(x) for k, v in mapping.items() for x in (str(k), v)])
    return df.withColumn(category, F.coalesce(F.element_at(pairs, F.col(label).cast("string")), F.lit(default)))


def class_mapping(names: list[str], remove: list[str] | None = None) -> dict[int, str]:
    """Labels from 1 in the given order, without the removed ones."""
    return {k: n for k, n in enumerate([n for n in names if n not in (remove or [])], 1)}


def normalize_keys(df: DataFrame, plate: str = "plate", well: str = "well", ids: list[str] | None = None) -> DataFrame:
    """Plates and wells in one spelling; ids as whole numbers, null where they aren't any."""
    out = df.withColumns({plate: canon_plate(plate), well: canon_well(well)})
    return out.withColumns({c: F.expr(f"try_cast(try_cast(`{c}` AS double) AS bigint)") for c in ids or []})


def latest_labels(manual: DataFrame, keys: list[str], order: str, source: DataFrame | None = None) -> DataFrame:
    """The last label of each key; with a source each must match exactly one of its rows."""
    last = manual.withColumn("k_", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))).where("k_ = 1").drop("k_")
    if source is not None:
        n = source.join(last.select(*keys), keys, "left_semi").groupBy(*keys).count()
        bad = last.select(*keys).join(n, keys, "left").where("count IS NULL OR count <> 1")
        if not bad.isEmpty():
            raise ValueError(f"labels without exactly one source row: {bad.limit(5).collect()}")
    return last


def class_rank(df: DataFrame, class_col: str, confidence: str, keys: list[str]) -> DataFrame:
    """Rank of each row within its class, most confident last."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(class_col).orderBy(confidence, *keys)))


def split_by_class(df: DataFrame, class_col: str, confidence: str, thresholds: dict[str, float] | None = None) -> dict[str, DataFrame]:
    """A lazy frame for "all" and for each class, of rows at or over the class's confidence."""
    names = [r[0] for r in df.select(class_col).where(F.col(class_col).isNotNull()).distinct().orderBy(class_col).collect()]
    out = {"all": df}
    for n in names:
        low = (thresholds or {}).get(str(n))
        mine = df.where(F.col(class_col) == n)
        out[str(n)] = mine if low is None else mine.where(F.col(confidence) >= low)
    return out
