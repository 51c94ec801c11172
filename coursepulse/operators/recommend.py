"""Top courses per student from explicit-feedback ALS on interaction counts."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from uuid import uuid4

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coursepulse.operators.best_products import best_products
from coursepulse.operators.counts import dense_index, interaction_counts, last_seen
from coursepulse.workspace import delete_folder, ensure_rdd_checkpoints, stored, working_dir

USER, ITEM, RECS = "student_index", "course_index", "recommendations"

# Students are grouped by seen courses in powers of this when the seen ones are to be left out.
SEEN_TIER_BASE = 4


@dataclass(frozen=True)
class AlsSettings:
    """Factorisation settings.

    ``blocks`` is the number of user and of item blocks. The start factors depend on it, so it is a
    plain setting that follows neither data nor cluster: the same data and settings give the same
    factors anywhere, and more data never another number. Raise it for large tables, so that a block
    of ratings, about ``ratings / blocks`` of 12 bytes, fits into a task's memory.
    """

    rank: int = 10
    max_iter: int = 10
    reg_param: float = 0.01
    seed: int = 42
    implicit: bool = False
    nonnegative: bool = False
    blocks: int = 10


@dataclass(frozen=True)
class Recommender:
    """A fitted model with the tables that translate its indexes. All parts are read from files
    in the shared folder, so losing an executor never repeats the fit."""

    pairs: DataFrame      # student_id, course_code, interaction_count, timestamp
    students: DataFrame   # student_id, student_index
    courses: DataFrame    # course_code, course_index
    ratings: DataFrame    # student_index, course_index, rating
    model: ALSModel
    folder: str
    settings: AlsSettings = AlsSettings()

    def discard(self) -> None:
        """Delete the files behind all of the above."""
        delete_folder(self.pairs.sparkSession, self.folder)

    def indexes_of(self, students: DataFrame) -> DataFrame:
        """``student_index`` of the known ones among these ``student_id``s."""
        return self.students.join(students, "student_id", "left_semi").select(USER)

    def top_n(self, n: int = 5, students: DataFrame | None = None) -> DataFrame:
        """``student_index, recommendations``: the n best courses, seen ones included, for all
        students or only for the ``student_id``s given."""
        if students is None:
            return self.model.recommendForAllUsers(n)
        return self.model.recommendForUserSubset(self.indexes_of(students), n)

    def top_n_by_length(self, n: int = 5, students: DataFrame | None = None) -> DataFrame:
        """:meth:`top_n` with a column ``scored``: the same courses, found without scoring all, see
        :mod:`~coursepulse.operators.best_products`."""
        users = self.model.userFactors
        if students is not None:
            users = users.join(self.indexes_of(students).select(F.col(USER).alias("id")), "id", "left_semi")
        return best_products(users, self.model.itemFactors, n, USER, ITEM)

    def top_n_unseen(self, n: int = 5, students: DataFrame | None = None) -> DataFrame:
        """The n best courses without an interaction, exactly.

        A student with s seen courses needs the best n + s. Students are tiered by s, each
        tier fetches n plus its largest s, and an anti join takes the seen ones out. The candidates
        stay within a constant factor of the ratings table, whatever the heaviest student does.
        """
        tier = F.ceil(F.log(float(SEEN_TIER_BASE), F.col("seen").cast("double"))).cast("int")
        ratings = self.ratings
        if students is not None:
            ratings = ratings.join(self.indexes_of(students), USER, "left_semi")
        seen = ratings.groupBy(USER).agg(F.count(F.lit(1)).alias("seen"))
        tiered = stored(
            seen.select(USER, tier.alias("tier")), f"{self.folder}/seen-{uuid4().hex}")
        # At most log(courses) distinct tiers; each is one scoring pass over its own students.
        tiers = [row.tier for row in tiered.select("tier").distinct().collect()]
        courses = self.courses.count()
        candidates = self.ratings.select(USER, ITEM, "rating").limit(0)
        for number in sorted(tiers):
            wanted = min(n + SEEN_TIER_BASE ** number, courses)
            peers = tiered.filter(F.col("tier") == number).select(USER)
            candidates = candidates.unionAll(
                self.model.recommendForUserSubset(peers, wanted)
                .select(USER, F.inline(RECS)))
        best = Window.partitionBy(USER).orderBy(F.desc("rating"), F.asc(ITEM))
        return (
            candidates.join(self.ratings.select(USER, ITEM), [USER, ITEM], "left_anti")
            .withColumn("rank", F.row_number().over(best))
            .filter(F.col("rank") <= n)
            .groupBy(USER)
            .agg(F.sort_array(F.collect_list(F.struct("rank", ITEM, "rating"))).alias(RECS))
            .select(USER, F.transform(
                RECS, lambda r: F.struct(r[ITEM].alias(ITEM), r["rating"].alias("rating"))
            ).alias(RECS))
        )

    def residuals(self) -> DataFrame:
        """``student_index, ratings, residual, scale``: how well each student's factors solve the
        equations that define them.

        The last half of a fit's last step is over the students: given the courses' factors v and a
        student's n ratings r, the factors u are the solution of ``(sum v v' + reg n) u = sum r v``.
        ``scale`` is the length of the right side, ``residual`` that of the difference. One join per
        side and sums per student; no matrix is built.
        """
        if self.settings.implicit or self.settings.nonnegative:
            raise ValueError("these are the equations of explicit, unconstrained factors")
        users = self.model.userFactors.select(F.col("id").alias(USER), F.col("features").alias("u"))
        items = self.model.itemFactors.select(F.col("id").alias(ITEM), F.col("features").alias("v"))
        places = range(self.model.rank)
        u, v = ([F.col(name)[at].cast("double") for at in places] for name in "uv")
        rating = F.col("rating").cast("double")
        miss = reduce(Column.__add__, [a * b for a, b in zip(u, v)]) - rating
        sums = self.ratings.join(items, ITEM).join(users, USER).withColumn("miss", miss).groupBy(
            USER).agg(
            F.count(F.lit(1)).alias("ratings"), F.any_value("u").alias("u"),
            *[F.sum(F.col("miss") * v[at]).alias(f"miss_{at}") for at in places],
            *[F.sum(rating * v[at]).alias(f"right_{at}") for at in places])
        rest = [F.col(f"miss_{at}") + self.settings.reg_param * F.col("ratings") * u[at]
                for at in places]
        return sums.select(
            USER, "ratings", _length(rest).alias("residual"),
            _length([F.col(f"right_{at}") for at in places]).alias("scale"))

    def recommendations(
        self, n: int = 5, exclude_seen: bool = False, students: DataFrame | None = None
    ) -> DataFrame:
        """Labelled recommendations, see :func:`assemble`."""
        recs = self.top_n_unseen(n, students) if exclude_seen else self.top_n(n, students)
        return assemble(recs, self.pairs, self.students, self.courses)


def _length(vector: list[Column]) -> Column:
    return F.sqrt(reduce(Column.__add__, [part * part for part in vector]))


def fit_recommender(
    spark: SparkSession,
    interactions: DataFrame,
    settings: AlsSettings = AlsSettings(),
    folder: str | None = None,
) -> Recommender:
    """Count, index and factorise. Runs jobs; intermediate tables go to ``folder``."""
    return fit_counts(spark, interaction_counts(interactions), settings, folder)


def fit_counts(
    spark: SparkSession,
    counts: DataFrame,
    settings: AlsSettings = AlsSettings(),
    folder: str | None = None,
) -> Recommender:
    """Index and factorise counts per (student, course), for instance those of ``DayCounts``.

    Interactions without a student or course cannot be indexed and are left out. A course
    contributes one pair per student however many events it has, so hot courses are already small
    when they reach the factorisation.
    """
    folder = folder or working_dir(spark, "recommender")
    ensure_rdd_checkpoints(spark)
    # Filtered on reading: a filter before the counts would be evaluated below the expressions that
    # make the two columns, and so evaluate them twice.
    pairs = stored(counts, f"{folder}/pairs").filter(
        F.col("student_id").isNotNull() & F.col("course_code").isNotNull())
    students = dense_index(pairs, "student_id", USER, f"{folder}/students")
    courses = dense_index(pairs, "course_code", ITEM, f"{folder}/courses")
    ratings = stored(index_pairs(pairs, students, courses), f"{folder}/ratings")
    als = ALS(
        rank=settings.rank, maxIter=settings.max_iter, regParam=settings.reg_param,
        seed=settings.seed, implicitPrefs=settings.implicit, nonnegative=settings.nonnegative,
        numUserBlocks=settings.blocks, numItemBlocks=settings.blocks,
        userCol=USER, itemCol=ITEM, ratingCol="rating", coldStartStrategy="drop",
    )
    als.fit(ratings).write().save(f"{folder}/model")
    return Recommender(pairs, students, courses, ratings, ALSModel.load(f"{folder}/model"), folder,
                       settings)


def index_pairs(pairs: DataFrame, students: DataFrame, courses: DataFrame) -> DataFrame:
    """``student_index, course_index, rating`` of every pair.

    Plain equi joins: Spark broadcasts a label table only below its size threshold, and adaptive
    execution splits a hot course's pairs when it has to shuffle them.
    """
    return (
        pairs.join(students, "student_id").join(courses, "course_code")
        .select(USER, ITEM, F.col("interaction_count").cast("float").alias("rating"))
    )


def assemble(
    recs: DataFrame,
    pairs: DataFrame,
    students: DataFrame,
    courses: DataFrame,
) -> DataFrame:
    """``student_id, course_code, recommendation_time, rating, rank`` from indexed recommendations.

    The time is the student's last interaction, so unchanged data gives unchanged keys. It is
    aggregated to one row per student before the join; students without recommendations vanish.
    """
    return (
        last_seen(pairs).join(students, "student_id").join(recs, USER, "left")
        .select("student_id", F.col("timestamp").alias("recommendation_time"),
                F.posexplode(RECS).alias("position", "rec"))
        .join(courses, F.col(f"rec.{ITEM}") == courses[ITEM])
        .select("student_id", "course_code", "recommendation_time",
                F.col("rec.rating").alias("rating"), (F.col("position") + 1).alias("rank"))
    )
