"""Sentiment classifier: bigram TF-IDF and three numbers into a logistic regression."""

import math
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (
    IDF,
    CountVectorizerModel,
    ElementwiseProduct,
    StandardScaler,
    VectorAssembler,
)
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.fixed_values import (
    BIGRAM_MIN_DF,
    BIGRAM_VOCABULARY,
    CV_FOLDS,
    ELASTIC_NET_PARAMS,
    LOGISTIC_MAX_ITER,
    REG_PARAMS,
)
from revlens.operators import tokens
from revlens.operators.prepare import NUMERIC_INPUTS
from revlens.operators.quality import classifier_metrics, confusion
from revlens.operators.splits import with_fold, with_split
from revlens.runtime import materialized

MODEL_INPUTS = ["text_combined", "sentiment_label", *NUMERIC_INPUTS]


def fit_features(train: DataFrame) -> PipelineModel:
    """Everything before the classifier, fitted on the training rows."""
    counter = tokens.vectorizer(
        tokens.with_bigrams(train), "bigrams", "raw_features", BIGRAM_VOCABULARY, BIGRAM_MIN_DF
    )
    return Pipeline(stages=[
        tokens.tokenizer(),
        tokens.stop_word_remover(),
        tokens.bigrams(),
        counter,
        IDF(inputCol="raw_features", outputCol="text_features"),
        VectorAssembler(inputCols=NUMERIC_INPUTS, outputCol="numeric_features"),
        StandardScaler(inputCol="numeric_features", outputCol="scaled_numeric",
                       withMean=True, withStd=True),
        VectorAssembler(inputCols=["text_features", "scaled_numeric"], outputCol="features"),
    ]).fit(train)


def classifier() -> LogisticRegression:
    return LogisticRegression(
        labelCol="sentiment_label", featuresCol="features", maxIter=LOGISTIC_MAX_ITER
    )


def full_grid() -> list:
    lr = LogisticRegression
    return (
        ParamGridBuilder()
        .addGrid(lr.regParam, REG_PARAMS)
        .addGrid(lr.elasticNetParam, ELASTIC_NET_PARAMS)
        .build()
    )


def _ready(features: PipelineModel, rows: DataFrame, label: str) -> DataFrame:
    """Label and features, written once: every iteration of every fit reads them again."""
    scored = features.transform(rows)
    return materialized(scored.select("sentiment_label", "features"), label)


def _without_summary(model):
    """The model alone. The summary of its training holds the session, which would go to every task
    with the model, and cannot once rows have been observed in it."""
    model._java_obj.setSummary(model._java_obj.getClass().getClassLoader().loadClass(
        "scala.None$").getField("MODULE$").get(None))
    return model


def _fit_all(train: DataFrame, grid: list, parallel: int) -> list:
    """One model per setting, a few at a time, on features already computed."""
    models = [None] * len(grid)
    pending = classifier().fitMultiple(train, grid)
    with ThreadPool(min(parallel, len(grid))) as pool:
        for index, model in pool.imap_unordered(lambda _: next(pending), grid):
            models[index] = _without_summary(model)
    return models


def _fold_scores(models: list, validation: DataFrame) -> DataFrame:
    """Metrics of all models from one pass over the validation rows."""
    scored = validation
    for i, model in enumerate(models):
        model.setPredictionCol(f"_p{i}").setRawPredictionCol("").setProbabilityCol("")
        scored = model.transform(scored)
    predictions = F.array(*[
        F.struct(F.lit(i).alias("setting"), F.col(f"_p{i}").alias("prediction"))
        for i in range(len(models))
    ])
    rows = scored.select("sentiment_label", F.inline(predictions))
    return classifier_metrics(
        confusion(rows, "sentiment_label", "prediction", by=("setting",)), by=("setting",)
    )


def fold_statistics(words: DataFrame) -> DataFrame:
    """Per term: occurrences and documents in each fold, as arrays; the NULL term counts all
    documents. A training part's counts are those of all folds less its own."""
    found = tokens.term_counts_by(tokens.bigrams().transform(words), "bigrams", "fold")
    by_fold = F.map_from_entries(F.collect_list(F.struct("fold", F.struct("term_count", "doc_count"))))
    counts = found.groupBy("term").agg(by_fold.alias("by_fold"))

    def each(name):
        return F.array(*[
            F.coalesce(F.try_element_at("by_fold", F.lit(fold))[name], F.lit(0))
            for fold in range(CV_FOLDS)])

    return materialized(
        counts.select("term", each("term_count").alias("term_counts"),
                      each("doc_count").alias("doc_counts")), "fold-statistics")


def _outside(counts: str, fold: int):
    """The sum over all folds but one."""
    return sum((F.col(counts)[i] for i in range(CV_FOLDS) if i != fold), F.lit(0))


def fold_terms(statistics: DataFrame, fold: int) -> DataFrame:
    """term, term_count, doc_count: the vocabulary of one training part."""
    part = statistics.filter(F.col("term").isNotNull()).select(
        "term", _outside("term_counts", fold).alias("term_count"),
        _outside("doc_counts", fold).alias("doc_count"))
    return tokens.most_frequent(
        part.filter(F.col("doc_count") >= BIGRAM_MIN_DF), BIGRAM_VOCABULARY)


def fold_features(train: DataFrame, key: str):
    """The rows of all folds as vectors of counts over the folds' vocabularies together, written
    once, and for each fold the weights of the terms, 0 for those its training part leaves out.

    Texts are split into words once; counts, vocabularies and vectors come from the stored words.
    """
    folded = with_fold(train, key)
    for stage in (tokens.tokenizer(), tokens.stop_word_remover()):
        folded = stage.transform(folded)
    words = materialized(
        folded.select("fold", "sentiment_label", "words_filtered", *NUMERIC_INPUTS), "fold-words")
    statistics = fold_statistics(words)
    whole = statistics.filter(F.col("term").isNull()).first()
    documents = list(whole["doc_counts"]) if whole else [0] * CV_FOLDS
    terms: dict[str, int] = {}
    chosen = []
    for fold in range(CV_FOLDS):
        total = sum(documents) - documents[fold]
        rows = fold_terms(statistics, fold).orderBy(F.desc("term_count"), "term").collect()
        chosen.append([(terms.setdefault(r["term"], len(terms)),
                        math.log((total + 1.0) / (r["doc_count"] + 1.0))) for r in rows])
    weights = []
    for pairs in chosen:
        weight = [0.0] * len(terms)
        for place, idf in pairs:
            weight[place] = idf
        weights.append(weight)
    counter = CountVectorizerModel.from_vocabulary(
        list(terms), inputCol="bigrams", outputCol="raw_features")
    assembled = VectorAssembler(inputCols=NUMERIC_INPUTS, outputCol="numeric_features").transform(
        counter.transform(tokens.bigrams().transform(words)))
    return materialized(assembled.select(
        "fold", "sentiment_label", "raw_features", "numeric_features"), "fold-vectors"), weights


def _weighted(rows: DataFrame, weights: list, scaler) -> DataFrame:
    """Label and features of one fold, without the metadata of each term."""
    product = ElementwiseProduct(
        scalingVec=Vectors.dense(weights), inputCol="raw_features", outputCol="text_features")
    joined = VectorAssembler(inputCols=["text_features", "scaled_numeric"], outputCol="features")
    ready = joined.transform(scaler.transform(product.transform(rows)))
    return ready.select("sentiment_label", F.col("features").alias("features", metadata={}))


def grid_search(train: DataFrame, key: str, grid: list, parallel: int = 4) -> DataFrame:
    """Mean weighted F1 of each setting over the folds; best first.

    Terms are counted once, by fold; each fold weights the same stored vectors by what its
    training part alone knows. The result has one row per setting.
    """
    spark = train.sparkSession
    vectors, weights = fold_features(train, key)
    scores = []
    for fold in range(CV_FOLDS):
        fitting, held_out = (vectors.filter(F.col("fold") != fold),
                             vectors.filter(F.col("fold") == fold))
        if not weights[fold]:
            raise ValueError("no term occurs in enough training documents")
        scaler = StandardScaler(inputCol="numeric_features", outputCol="scaled_numeric",
                                withMean=True, withStd=True).fit(fitting)
        # stored, because each iteration ships the plan of its rows: with the weights in it, that took
        # most of the time of a fit
        ready = materialized(_weighted(fitting, weights[fold], scaler), "fold-fit")
        models = _fit_all(ready, grid, parallel)
        rows = _fold_scores(models, _weighted(held_out, weights[fold], scaler)).select(
            "setting", "f1_score").collect()
        scores += [(row["setting"], fold, row["f1_score"]) for row in rows]
    settings = [
        (i, *[float(values[p]) for p in (LogisticRegression.regParam,
                                         LogisticRegression.elasticNetParam)])
        for i, values in enumerate(grid)
    ]
    per_fold = spark.createDataFrame(scores, "setting int, fold int, f1 double")
    named = spark.createDataFrame(settings, "setting int, reg_param double, elastic_net double")
    return (
        per_fold.groupBy("setting").agg(F.avg("f1").alias("mean_f1"), F.count("*").alias("folds"))
        .join(named, "setting")
        .orderBy(F.desc("mean_f1"), "setting")
    )


def train_sentiment(prepared: DataFrame, key: str, grid: list | None = None, parallel: int = 4):
    """Best model of the grid refitted on the training part, and its validation metrics.

    The test part stays untouched. `prepared` should be stored: every feature fit reads
    its texts again, and filtering the parts out costs only a hash per row.
    """
    parts = with_split(prepared.select(key, *MODEL_INPUTS), key)
    train = parts.filter("split = 'train'").drop("split")
    grid = grid or full_grid()
    best = grid_search(train, key, grid, parallel).first() if len(grid) > 1 else {"setting": 0}
    features = fit_features(train)
    model = _without_summary(
        classifier().fit(_ready(features, train, "sentiment-fit"), grid[best["setting"]]))
    pipeline = PipelineModel(stages=[*features.stages, model])
    predictions = pipeline.transform(parts.filter("split = 'validation'"))
    metrics = classifier_metrics(confusion(predictions, "sentiment_label", "prediction"))
    return pipeline, metrics.first().asDict()
