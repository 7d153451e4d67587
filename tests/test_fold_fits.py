"""Logistic models of all folds at once, against one Spark fit a fold."""

import math
import random

import pytest

from priorwise.operators import fold_fits as FF, modeling as G

SCHEMA = "id long, y int, x double, z double, c string, d string"


def rows(n=240):
    rng = random.Random(4)
    out = []
    for i in range(n):
        x, z = rng.gauss(50, 9), rng.gauss(-1e6, 2.0)
        c = rng.choice("abc") if i < 120 else rng.choice("abcd")  # d is unknown to the first folds
        y = int(rng.random() < 1 / (1 + math.exp(-(0.1 * (x - 50) + 0.4 * (z + 1e6) + (c == "b")))))
        out.append((i, y, x, z, None if i % 17 == 0 else c, "same"))
    return out


def folds(spark, n=240):
    """Expanding folds: trained on what is before, validated on the next part."""
    return spark.createDataFrame([(i, f, "TRAIN" if i < 60 * f else "VALIDATION") for f in (1, 2, 3) for i in range(min(n, 60 * (f + 1)))], "id long, fold_id int, role string")


def test_all_folds_in_one_fit_equal_a_fit_a_fold(spark):
    df, f = spark.createDataFrame(rows(), SCHEMA), folds(spark)
    got = {(r.id, r.fold_id): (r.y, r.p) for r in G.oof_scores(df, f, "id", ["x", "z"], ["c", "d"]).collect()}
    assert len(got) == 180
    for fold in (1, 3):
        of = df.join(f.filter(f.fold_id == fold), "id")
        # column d is constant and must have no effect
        model = G.fit_classifier(of.filter("role = 'TRAIN'"), ["x", "z"], ["c"], tol=1e-13)
        want = G.score(model, of.filter("role = 'VALIDATION'"), ["id", "y"]).collect()
        assert len(want) == 60
        for r in want:
            y, p = got[(r.id, fold)]
            assert y == r.y and p == pytest.approx(r.p, abs=1e-6)


def test_missing_numbers_take_the_folds_median(spark):
    some = [(i, y, None if i % 5 == 0 else math.nan if i % 7 == 0 else x, z, c, d) for i, y, x, z, c, d in rows(120)]
    f = folds(spark, 120).filter("fold_id = 1")
    table, ids = FF.fold_rows(spark.createDataFrame(some, SCHEMA), f, "id", ["x"], [])
    fits = FF.fit_folds(table, ids, ["x"], [])
    seen = sorted(r[2] for r in some[:60] if r[2] is not None and not math.isnan(r[2]))
    assert fits.fill[0, 0] in seen[len(seen) // 2 - 1 : len(seen) // 2 + 1]
    want = 1 / (1 + math.exp(-(fits.fill[0, 0] * fits.coefficients[0, 0] + fits.intercepts[0])))
    got = {r.id: r.p for r in FF.score_folds(table, fits, "id").collect()}
    assert got[60] == pytest.approx(want) and got[63] == pytest.approx(want)


def test_one_label_no_train_rows_and_empty_tables(spark):
    data = [(i, None if i == 3 else 1 if i < 20 else i % 2, float(i), 1.0, "a", None) for i in range(60)]
    df = spark.createDataFrame(data, SCHEMA)
    f = spark.createDataFrame([(i, 1, "TRAIN" if i < 20 else "VALIDATION") for i in range(60)] + [(i, 2, "VALIDATION") for i in range(5)] + [(999, 1, "VALIDATION")], "id long, fold_id int, role string")
    got = {(r.id, r.fold_id): r.p for r in G.oof_scores(df, f, "id", ["x", "z"], ["c", "d"]).collect()}
    assert len(got) == 45
    assert all(got[(i, 1)] == 1.0 for i in range(20, 60)) and all(got[(i, 2)] is None for i in range(5))
    assert G.oof_scores(df.limit(0), f, "id", ["x"], ["c"]).count() == 0
    assert G.oof_scores(df, f.limit(0), "id", ["x"], ["c"]).count() == 0


def test_wide_designs_are_fitted_fold_by_fold(spark, monkeypatch):
    monkeypatch.setattr(FF, "MOST_WIDTH", 2)
    table, ids = FF.fold_rows(spark.createDataFrame(rows(), SCHEMA), folds(spark), "id", ["x"], ["c"])
    assert FF.fit_folds(table, ids, ["x"], ["c"]) is None
