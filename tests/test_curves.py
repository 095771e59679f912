"""Curves and areas against plain loops."""

import math
import random

import pytest

from colfit.operators import curves
from colfit.operators.curves import class_scores, confusion, curve_areas, threshold_curve


def frame(spark, rows):
    return spark.createDataFrame(rows, "s double, y double").repartition(5)


def some_rows(seed, n, levels):
    chosen = random.Random(seed)
    return [(chosen.randrange(levels) / 7, float(chosen.random() < 0.4)) for _ in range(n)]


def share(a, b):
    return a / b if b else math.nan


def same(a, b):
    return (math.isnan(a) and math.isnan(b)) or a == pytest.approx(b)


def plain(rows, threshold):
    tp = sum(1 for s, y in rows if s >= threshold and y == 1)
    fp = sum(1 for s, y in rows if s >= threshold and y != 1)
    fn = sum(1 for s, y in rows if s < threshold and y == 1)
    return tp, fp, fn, len(rows) - tp - fp - fn, share(tp, tp + fp), share(tp, tp + fn), share(2 * tp, 2 * tp + fp + fn)


@pytest.mark.parametrize("levels", [1, 4, 500])
@pytest.mark.parametrize("ranges", [1_000_000, 9])
def test_every_threshold(spark, monkeypatch, levels, ranges):
    monkeypatch.setattr(curves, "RANGE_SCORES", ranges)
    rows = some_rows(levels, 300, levels)
    found = {r[0]: tuple(r)[1:] for r in threshold_curve(frame(spark, rows), "s", "y").collect()}
    assert set(found) == {s for s, _ in rows}
    for threshold, own in found.items():
        assert all(map(same, own, plain(rows, threshold)))
        one = tuple(confusion(frame(spark, rows), "s", "y", threshold).first()) if levels < 5 else own
        assert all(map(same, one, own))


@pytest.mark.parametrize("levels", [1, 4, 500])
def test_areas(spark, monkeypatch, levels):
    monkeypatch.setattr(curves, "RANGE_SCORES", 20)
    rows = some_rows(levels, 200, levels)
    hits, misses = ([s for s, y in rows if (y == 1) == side] for side in (True, False))
    wins = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in hits for b in misses)
    best = max((plain(rows, s)[6], s) for s, _ in rows)
    precision, before = 0.0, 0
    for threshold in sorted({s for s, _ in rows}, reverse=True):
        tp, *_, at, _, _ = plain(rows, threshold)
        precision, before = precision + (tp - before) / len(hits) * at, tp
    found = curve_areas(frame(spark, rows), "s", "y").first()
    assert found["roc_area"] == pytest.approx(wins / len(hits) / len(misses))
    assert found["average_precision"] == pytest.approx(precision)
    assert (found["best_f_score"], found["best_threshold"]) == pytest.approx(best)


def test_classes(spark):
    chosen = random.Random(3)
    rows = [(float(chosen.randrange(4)), float(chosen.choice([0, 1, 2, 9]))) for _ in range(200)]
    found = {r["class"]: tuple(r)[1:] for r in class_scores(frame(spark, rows), "s", "y").collect()}
    assert set(found) == {x for r in rows for x in r}
    for c, own in found.items():
        tp = sum(p == c == y for p, y in rows)
        fp, fn = sum(p == c != y for p, y in rows), sum(p != c == y for p, y in rows)
        assert all(map(same, own, (tp, fp, fn, share(tp, tp + fp), share(tp, tp + fn), share(2 * tp, 2 * tp + fp + fn))))


def test_special_scores_and_labels(spark):
    nan, inf = math.nan, math.inf
    rows = [(nan, 1.0), (inf, 0.0), (-inf, 1.0), (0.0, 1.0), (-0.0, 0.0), (nan, 2.0)]
    found = threshold_curve(frame(spark, rows), "s", "y").orderBy("threshold", ascending=False).collect()
    assert [(r["tp"], r["fp"]) for r in found] == [(1, 1), (1, 2), (2, 3), (3, 3)]
    assert threshold_curve(frame(spark, rows), "s", "y", positive=2.0).where("tp = 1").count() == 4
    holes = [*rows, (None, 1.0), (1.0, None)]
    for function in (threshold_curve, curve_areas, class_scores):
        with pytest.raises(ValueError, match="nulls"):
            function(frame(spark, holes), "s", "y").collect()
        assert function(frame(spark, holes), "s", "y", handle_invalid="skip").count() == function(frame(spark, rows), "s", "y").count()


def test_nothing_and_one_class(spark):
    empty = frame(spark, [(1.0, 1.0)]).limit(0)
    assert threshold_curve(empty, "s", "y").count() == class_scores(empty, "s", "y").count() == 0
    assert all(map(math.isnan, curve_areas(empty, "s", "y").first()))
    assert tuple(confusion(empty, "s", "y", 0.5).first())[:4] == (0, 0, 0, 0)
    only = curve_areas(frame(spark, [(0.2, 1.0), (0.4, 1.0)]), "s", "y").first()
    assert math.isnan(only["roc_area"]) and only["average_precision"] == 1.0
    none = curve_areas(frame(spark, [(0.2, 0.0)]), "s", "y").first()
    assert math.isnan(none["average_precision"]) and none["best_f_score"] == 0.0


def test_names_that_clash(spark):
    rows = some_rows(1, 50, 6)
    odd = frame(spark, rows).selectExpr("s AS hits", "y AS part", "1 AS score", "2 AS tp", "'x' AS hit")
    plain_rows = sorted(map(tuple, threshold_curve(frame(spark, rows), "s", "y").collect()))
    assert sorted(map(tuple, threshold_curve(odd, "hits", "part").collect())) == plain_rows
