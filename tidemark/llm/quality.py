"""Quality by co-training: a content view and a metadata view teach each other, then vote."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizer, FeatureHasher, RegexTokenizer, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.joins import measured
from tidemark.llm.common import saved

# Bound of the labelled sample; all documents without label are the pool, all documents are scored.
MAX_LABELLED = 20_000
ROUNDS = 3
# Pseudo-labels need this certainty.
CONFIDENT = 0.97
VOCABULARY = 20_000
MIN_DOCS = 5
HELD_OUT = 0.2
KEEP = 0.5
VIEWS = ("content", "metadata")


def rated(docs: DataFrame, *more: str) -> DataFrame:
    """The columns both views read, nulls filled: other columns of the table stay out, but for those named."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    size = F.coalesce(F.col("n_chars").cast("double"), F.length(text).cast("double")) if "n_chars" in docs.columns else (
        F.length(text).cast("double"))
    lines = F.size(F.split(text, "\n", -1)).cast("double")

    def name(c: str) -> Column:
        return (F.coalesce(F.col(c).cast("string"), F.lit("?")) if c in docs.columns else F.lit("?")).alias(c)

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), name("lang"), name("source"),
        F.floor(F.log2(size + 1)).cast("string").alias("size_class"),
        F.floor(F.log2(size / lines + 1)).cast("string").alias("line_class"), *more,
    )


def goodness(labels: DataFrame) -> DataFrame:
    """``(doc_id, label)``: 1 for good and not toxic, 0 else; unlabelled ids stay out, the worst label counts."""
    good = F.when((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0), 1.0).otherwise(0.0)
    return labels.where("doc_id is not null and quality is not null").groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(good).alias("label"))


@dataclass
class CoTrained:
    content: PipelineModel
    metadata: PipelineModel
    classifiers: dict[str, LogisticRegressionModel]
    # Per view: slope and intercept of the calibrated log-odds; then the log-odds of the prior.
    calibration: dict[str, tuple[float, float]]
    prior: float

    def features(self, docs: DataFrame) -> DataFrame:
        return self.metadata.transform(self.content.transform(docs))

    def score(self, docs: DataFrame, *more: str) -> DataFrame:
        """``(doc_id, p_content, p_metadata, p_good)`` and the columns named, calibrated; the views' log-odds add up over the prior's."""
        df = self.features(rated(docs, *more))
        odds = {}
        for view in VIEWS:
            df = self.classifiers[view].transform(df)
            slope, intercept = self.calibration[view]
            odds[view] = F.lit(intercept) + F.lit(slope) * vector_to_array(F.col(f"{view}_raw"))[1]
        both = odds["content"] + odds["metadata"] - F.lit(self.prior)

        def p(x: Column) -> Column:
            return 1 / (1 + F.exp(-x))

        return df.select("doc_id", p(odds["content"]).alias("p_content"), p(odds["metadata"]).alias("p_metadata"),
                         p(both).alias("p_good"), *more)


def _classifier(view: str) -> LogisticRegression:
    return LogisticRegression(
        featuresCol=f"{view}_x", labelCol="label", rawPredictionCol=f"{view}_raw", probabilityCol=f"{view}_p",
        predictionCol=f"{view}_y", regParam=1e-3, maxIter=30, aggregationDepth=2)


def _sample(ids: DataFrame, rows: int) -> DataFrame:
    """So many ids, in the order of a hash: the same on every run."""
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def _platt(scored: DataFrame, view: str) -> tuple[float, float]:
    """Slope and intercept that turn a view's margin into log-odds."""
    margin = scored.select("label", vector_to_array(F.col(f"{view}_raw"))[1].alias("m"))
    fitted = LogisticRegression(featuresCol="x", labelCol="label", regParam=1e-4).fit(
        VectorAssembler(inputCols=["m"], outputCol="x").transform(margin))
    return float(fitted.coefficients[0]), float(fitted.intercept)


def co_train(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS, max_labelled: int = MAX_LABELLED) -> CoTrained | None:
    """Fit both views; None if the labels show fewer than two classes.

    The labelled sample is at most ``max_labelled`` documents, a fifth of it
    held out to calibrate. The pool is every document without label, those with
    a null or repeated id too. In each round each view scores the whole pool and
    the other one also learns from all documents it is ``CONFIDENT`` about.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    known = goodness(labels).join(ids, "doc_id")
    labelled = _sample(known, max_labelled)
    sample = saved(rated(docs).join(measured(labelled), "doc_id").dropDuplicates(["doc_id"]), "quality-sample")
    held_out = (F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(1000)) < int(HELD_OUT * 1000))

    train = sample.where(~held_out)
    if train.select("label").distinct().count() < 2:
        return None
    words = RegexTokenizer(inputCol="text", outputCol="words", pattern=r"\p{L}+|[^\p{L}\s]+", gaps=False, toLowercase=True)
    # A word that all documents have: the vocabulary is never empty.
    mark = SQLTransformer(statement="SELECT *, concat(words, array('')) AS marked FROM __THIS__")
    bag = CountVectorizer(inputCol="marked", outputCol="content_x", vocabSize=VOCABULARY, binary=True)
    facts = FeatureHasher(inputCols=["lang", "source", "size_class", "line_class"], outputCol="metadata_x", numFeatures=1 << 12)
    content = Pipeline(stages=[words, mark, bag.setMinDF(float(min(MIN_DOCS, train.count())))]).fit(train)
    metadata = Pipeline(stages=[facts]).fit(train)
    vectors = saved(metadata.transform(content.transform(sample)).select(
        "doc_id", "label", held_out.alias("held_out"), "content_x", "metadata_x"), "quality-vectors")
    train = vectors.where("not held_out")
    # An outer join, so that vectors travel where the labels are many: an anti join would be moved below them, to the texts.
    told_ids = measured(goodness(labels).select("doc_id", F.lit(True).alias("told")))
    pool = saved(metadata.transform(content.transform(rated(docs))).select("doc_id", "content_x", "metadata_x").join(
        told_ids, "doc_id", "left").where("told is null").select("content_x", "metadata_x"), "quality-pool")

    told = {view: None for view in VIEWS}
    classifiers: dict[str, LogisticRegressionModel] = {}
    for _ in range(rounds):
        for view in VIEWS:
            rows = train.select("label", f"{view}_x")
            if told[view] is not None:
                rows = rows.unionByName(told[view].select("label", f"{view}_x"))
            classifiers[view] = _classifier(view).fit(rows)
        for view, other in (VIEWS, VIEWS[::-1]):
            p = vector_to_array(F.col(f"{view}_p"))[1]
            told[other] = classifiers[view].transform(pool).withColumn("label", F.round(p)).where(
                (p >= CONFIDENT) | (p <= 1 - CONFIDENT))

    check = vectors.where("held_out")
    if check.select("label").distinct().count() < 2:
        check = train
    for view in VIEWS:
        check = classifiers[view].transform(check)
    share = min(max(check.agg(F.avg("label")).first()[0], 1e-6), 1 - 1e-6)
    return CoTrained(content, metadata, classifiers, {v: _platt(check, v) for v in VIEWS}, math.log(share / (1 - share)))


def rate(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, p_content, p_metadata, p_good, kept)``, one row per document.

    A document is kept if it is good with probability ``KEEP``. Null text and
    metadata count as empty and unknown; rows that repeat an id each get a row.
    Without labels of two classes nothing is rejected and the scores are null.
    """
    model = co_train(docs, labels)
    if model is None:
        none = F.lit(None).cast("double")
        return rated(docs).select("doc_id", none.alias("p_content"), none.alias("p_metadata"), none.alias("p_good"),
                                  F.lit(True).alias("kept"))
    return model.score(docs).withColumn("kept", F.col("p_good") >= KEEP)


def good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that ``rate`` keeps, all columns: each row by its own score, whatever others have its id."""
    model = co_train(docs, labels)
    if model is None:
        return docs
    whole = docs.withColumn("whole_row", F.struct(*docs.columns))
    return model.score(whole, "whole_row").where(F.col("p_good") >= KEEP).select("whole_row.*")
