import random
from dataclasses import replace
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from coursepulse.operators.recommend import AlsSettings, fit_recommender
from coursepulse.plans import Tables, recommendation_job
from helpers import at, interactions, rows_of


def day(number):
    return (datetime(2024, 1, 1) + timedelta(days=number)).isoformat(" ")


def feed(students=3, courses=6, seed=1):
    """Random interactions, each student's last one on a day of its own; one more student has
    seen every course."""
    chance = random.Random(seed)
    rows = []
    for s in range(students):
        for c in range(courses):
            rows += [(f"S{s}", f"C{c}", "course_viewed", day(c))] * chance.randrange(0, 4)
        rows.append((f"S{s}", f"C{s % courses}", "course_viewed", day(100 + s)))
    return rows + [(f"S{students}", f"C{c}", "x", day(0)) for c in range(courses)]


@pytest.fixture(scope="module")
def fitted(spark):
    return fit_recommender(spark, interactions(spark, feed()))


def by_student(rows):
    found = {}
    for r in sorted(rows.collect(), key=lambda r: (r.student_id, r.rank)):
        found.setdefault(r.student_id, []).append(r)
    return found


def test_five_per_student_best_first(fitted):
    found = by_student(fitted.recommendations(5))
    assert set(found) == {"S0", "S1", "S2", "S3"}
    for recs in found.values():
        assert [r.rank for r in recs] == [1, 2, 3, 4, 5]
        assert len({r.course_code for r in recs}) == 5
        ratings = [r.rating for r in recs]
        assert ratings == sorted(ratings, reverse=True)


def test_factors_solve_their_equations(spark, fitted):
    """The residuals against dense algebra, and of factors that were moved."""
    found = {r.student_index: r for r in fitted.residuals().collect()}
    assert len(found) == 4
    items = {r.id: np.array(r.features, float) for r in fitted.model.itemFactors.collect()}
    users = {r.id: np.array(r.features, float) for r in fitted.model.userFactors.collect()}
    rated = {}
    for r in fitted.ratings.collect():
        rated.setdefault(r.student_index, []).append((items[r.course_index], float(r.rating)))
    for index, pairs in rated.items():
        v, r = np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])
        left = (v.T @ v + 0.01 * len(r) * np.eye(v.shape[1])) @ users[index]
        row = found[index]
        assert row.ratings == len(r)
        assert np.isclose(row.scale, np.linalg.norm(v.T @ r))
        assert np.isclose(row.residual, np.linalg.norm(left - v.T @ r), atol=1e-6 * row.scale)
        assert row.residual <= 1e-3 * row.scale
    moved = replace(fitted, ratings=fitted.ratings.withColumn("rating", F.col("rating") + 1))
    assert all(r.residual > 1e-3 * r.scale for r in moved.residuals().collect())
    with pytest.raises(ValueError):
        replace(fitted, settings=AlsSettings(implicit=True)).residuals()


def test_time_is_the_last_interaction(fitted):
    for student, recs in by_student(fitted.recommendations(5)).items():
        wanted = day(0) if student == "S3" else day(100 + int(student[1:]))
        assert {r.recommendation_time for r in recs} == {at(wanted)}


def factor_scores(fitted):
    users = {r.id: np.array(r.features) for r in fitted.model.userFactors.collect()}
    items = {r.id: np.array(r.features) for r in fitted.model.itemFactors.collect()}
    user_of = {r.student_id: r.student_index for r in fitted.students.collect()}
    item_of = {r.course_code: r.course_index for r in fitted.courses.collect()}
    return {s: {c: float(users[u] @ items[i]) for c, i in item_of.items()}
            for s, u in user_of.items()}


@pytest.mark.parametrize("shape", [(12, 30), (40, 9)])
def test_top_n_against_brute_force(spark, shape):
    """With and without seen courses; one student has seen every course, some only one."""
    rows = feed(*shape, seed=5) + [("solo", "C0", "x", day(0))]
    fitted = fit_recommender(spark, interactions(spark, rows))
    scores = factor_scores(fitted)
    seen = {(r.student_id, r.course_code) for r in fitted.pairs.collect()}
    for exclude in (False, True):
        found = by_student(fitted.recommendations(4, exclude_seen=exclude))
        for student, courses in scores.items():
            open_courses = {c: v for c, v in courses.items()
                            if not (exclude and (student, c) in seen)}
            best = sorted(open_courses.values(), reverse=True)[:4]
            recs = found.get(student, [])
            assert [r.rating for r in recs] == pytest.approx(best, abs=1e-4)
            for r in recs:
                assert r.rating == pytest.approx(open_courses[r.course_code], abs=1e-4)


@pytest.mark.parametrize("exclude", [False, True])
def test_some_students_only(spark, fitted, exclude):
    some = spark.createDataFrame([("S0",), ("S2",), ("S0",), ("unknown",)], "student_id string")
    everyone = fitted.recommendations(2, exclude)
    wanted = everyone.filter("student_id in ('S0', 'S2')")
    assert rows_of(fitted.recommendations(2, exclude, some)) == rows_of(wanted)
    nobody = some.filter("student_id = 'unknown'")
    assert fitted.recommendations(2, exclude, nobody).count() == 0


def test_same_seed_same_rows_after_repartition(spark, fitted):
    again = fit_recommender(spark, interactions(spark, feed()).repartition(5))
    assert rows_of(again.recommendations(5)) == rows_of(fitted.recommendations(5))


def test_settings_reach_the_model(spark):
    other = fit_recommender(spark, interactions(spark, feed()), AlsSettings(rank=3, seed=7))
    assert other.model.rank == 3


def test_unidentified_rows_are_left_out(spark, fitted):
    extra = feed() + [(None, "C0", "x", "2024-01-01 00:00:00"),
                      ("S0", None, "x", "2024-01-01 00:00:00")]
    again = fit_recommender(spark, interactions(spark, extra))
    assert rows_of(again.pairs) == rows_of(fitted.pairs)


@pytest.mark.parametrize("students", [5, 400])
def test_blocks_do_not_follow_the_data(spark, monkeypatch, students):
    from coursepulse.operators import recommend
    made = []
    als = recommend.ALS
    monkeypatch.setattr(recommend, "ALS", lambda **given: made.append(given) or als(**given))
    rows = [(f"S{s}", f"C{s % 7}", "x", day(1)) for s in range(students)] + [
        (f"S{s}", f"C{s % 5 + 7}", "x", day(2)) for s in range(students)]
    recommend.fit_recommender(spark, interactions(spark, rows), AlsSettings(max_iter=1)).discard()
    recommend.fit_recommender(
        spark, interactions(spark, rows), AlsSettings(max_iter=1, blocks=3)).discard()
    assert [(m["numUserBlocks"], m["numItemBlocks"]) for m in made] == [(10, 10), (3, 3)]


def test_job_is_idempotent_and_keeps_history(spark, tmp_path):
    tables = Tables(spark, f"{tmp_path}")
    first = rows_of(recommendation_job(spark, interactions(spark, feed()), tables))
    assert len(first) == 20
    assert rows_of(recommendation_job(spark, interactions(spark, feed()), tables)) == first
    later = feed() + [("S0", "C5", "x", day(200))]
    grown = recommendation_job(spark, interactions(spark, later), tables)
    times = {r.recommendation_time for r in grown.collect() if r.student_id == "S0"}
    assert times == {at(day(100)), at(day(200))}
