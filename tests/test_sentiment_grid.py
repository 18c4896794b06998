"""Cross-validation: words once, counts by fold, every training part by subtraction."""

import math

import pytest
from pyspark.sql import functions as F

from revlens.fixed_values import BIGRAM_MIN_DF, BIGRAM_VOCABULARY, CV_FOLDS
from revlens.operators import tokens
from revlens.operators.splits import with_fold
from revlens.plans import train_sentiment


@pytest.fixture(scope="module")
def rows(prepared):
    return prepared.select("review_id", *train_sentiment.MODEL_INPUTS)


def test_texts_are_split_into_words_once(rows, monkeypatch):
    made = []
    tokenizer = tokens.tokenizer

    def counted():
        made.append(1)
        return tokenizer()

    monkeypatch.setattr(tokens, "tokenizer", counted)
    vectors, weights = train_sentiment.fold_features(rows, "review_id")
    assert len(made) == 1 and len(weights) == CV_FOLDS
    plan = vectors._jdf.queryExecution().toString()
    assert "UDF" not in plan and "words" not in plan  # reads the stored vectors
    assert vectors.count() == rows.count()


def test_each_fold_knows_its_training_part_alone(rows):
    vectors, weights = train_sentiment.fold_features(rows, "review_id")
    folded = with_fold(rows, "review_id")
    for fold in range(CV_FOLDS):
        part = tokens.with_bigrams(folded.filter(F.col("fold") != fold))
        terms, total = tokens.vocabulary_of(part, "bigrams", BIGRAM_VOCABULARY, BIGRAM_MIN_DF)
        assert total == folded.filter(F.col("fold") != fold).count()
        expected = sorted(math.log((total + 1) / (r.doc_count + 1)) for r in terms.collect())
        assert sorted(w for w in weights[fold] if w) == pytest.approx([e for e in expected if e])


def test_grid_of_two_settings(rows):
    grid = train_sentiment.full_grid()[:2]
    scores = train_sentiment.grid_search(rows, "review_id", grid, parallel=2).collect()
    assert sorted(r.setting for r in scores) == [0, 1]
    assert all(r.folds == CV_FOLDS and 0 < r.mean_f1 <= 1 for r in scores)


def test_fits_read_stored_vectors(rows, monkeypatch):
    plans = []
    fit_all = train_sentiment._fit_all

    def seen(train, grid, parallel):
        plans.append(train._jdf.queryExecution().toString())
        return fit_all(train, grid, parallel)

    monkeypatch.setattr(train_sentiment, "_fit_all", seen)
    grid = train_sentiment.full_grid()[:1]
    assert train_sentiment.grid_search(rows, "review_id", grid).count() == 1
    assert len(plans) == CV_FOLDS and not any("UDF" in plan for plan in plans)
