"""

The queries run over the whole ``events`` table (and ``nation`` for countries), lifted to
learner-course interactions by ``coursepulse.sources.events``. Instants are returned without a
zone, in UTC, as the SQL side has them.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coursepulse import model
from coursepulse.functions import course_category, engagement_score
from coursepulse.operators import counts as cnt
from coursepulse.operators import ingest, profiles, sketches
from coursepulse.operators import popularity as pop
from coursepulse.operators.latest import latest_by_key
from coursepulse.operators.recommend import (
    ITEM,
    RECS,
    USER,
    assemble,
    fit_recommender,
    index_pairs,
)
from coursepulse.plans import Tables, ingest_landed, popularity_job
from coursepulse.sinks import BucketedTable, DayCounts, KeyedTable, land
from coursepulse.sinks.external import messages, renamed
from coursepulse.sources import events as ev
from coursepulse.sources import read_landed
from coursepulse.streaming import (
    LateEvents,
    PopularityStore,
    await_all,
    start_interaction_log,
    start_late_events,
    start_popularity,
    start_quarantine,
)
from coursepulse.streaming.state import windows_in_state
from coursepulse.workspace import stored, working_dir

SMOKE_DIR = "/root/testdata/sf0.001"
AS_OF, HISTORY_CUT, SECOND_CUT = "2024-01-30", "2024-01-15", "2024-01-25"
LATE_FROM, LATE_UNTIL = "2024-01-10", "2024-01-20"
ONCE = {"availableNow": True}

Query = Callable[[SparkSession, str], DataFrame]

try:
    import corpus_pipeline

    from coursepulse.llm import queries as llm
except ModuleNotFoundError as missing:
    # the corpus operators, or packages that they alone need, aren't installed here
    name = (missing.name or "").split(".")
    if name[:2] != ["coursepulse", "llm"] and name[0] not in (
            "corpus_pipeline", "public_tokenizers", "regex", "xxhash"):
        raise
    warnings.warn(f"no corpus queries: {missing}", stacklevel=1)
    llm = None


def _instant(text: str):
    """A time in the session's zone, which is UTC here, whatever the host's."""
    return F.lit(text).cast("timestamp")


# --- inputs ---------------------------------------------------------------------------------


def _interactions(spark: SparkSession, folder: str, *keep: str, country: bool = False):
    nations = ev.read_nations(spark, folder) if country else None
    return ev.lift(ev.read_events(spark, folder), nations, *keep)


def _feed(spark: SparkSession, folder: str) -> DataFrame:
    """The interactions as a stream of JSON messages, the stand-in for a topic: the event id is
    the offset in a single partition, the event time the time of arrival."""
    lifted = ev.lift(ev.stream_events(spark, folder), ev.read_nations(spark, folder), "event_id")
    return lifted.select(
        ingest.encode_event().alias("value"), "timestamp",
        F.lit(0).alias("partition"), F.col("event_id").alias("offset"))


def _log_rows(spark: SparkSession, folder: str, country: bool = False) -> DataFrame:
    """Interactions with their position in the feed, which decides between two writes of a key."""
    return _interactions(spark, folder, "event_id", country=country).withColumnRenamed(
        "event_id", "ingest_offset")


def _faulty_feed(spark: SparkSession, folder: str, stream: bool = False) -> DataFrame:
    """All messages, with those of ``error`` events damaged in three ways."""
    events = ev.stream_events(spark, folder) if stream else ev.read_events(spark, folder)
    lifted = ev.lift(events, ev.read_nations(spark, folder), "event_type", "value", "props")
    damaged = F.col("event_type") == "error"
    anonymous = damaged & (F.col("value") >= 10)
    lifted = lifted.withColumn(
        "student_id", F.when(anonymous, F.lit(None)).otherwise(F.col("student_id")))
    text = ingest.encode_event()
    value = (
        F.when(damaged & (F.col("value") < 2), F.lit(None))
        .when(damaged & (F.col("value") < 10), F.concat(F.lit("#"), F.col("props")))
        .otherwise(text)
    )
    return lifted.select(value.cast("binary").alias("value"))


def _misfit_feed(spark: SparkSession, folder: str) -> DataFrame:
    """All messages, with a field of ``error`` events that doesn't fit its type."""
    lifted = _interactions(spark, folder, "event_type", "value", country=True)
    text, value = ingest.encode_event(), F.col("value")
    misfit = (
        F.when(value < 2, F.regexp_replace(text, '"duration":null', '"duration":"long"'))
        .when(value < 5, F.regexp_replace(text, '"duration":null', '"duration":12.5'))
        .when(value < 8, F.regexp_replace(text, '"timestamp":"[^"]*"', '"timestamp":"soon"'))
        .when(value < 12, F.regexp_replace(text, '"location":\\{[^}]*\\}', '"location":"PERU"'))
        .otherwise(text))
    return lifted.select(
        F.when(F.col("event_type") == "error", misfit).otherwise(text).alias("value"))


# --- parsing, filters, scores ---------------------------------------------------------------


def parse_interactions(spark, folder):
    value = ingest.encode(_interactions(spark, folder, country=True)).select(
        F.col("value").cast("binary").alias("value"))
    return ingest.decode(value)


def valid_interactions(spark, folder):
    return ingest.interactions_from(_faulty_feed(spark, folder))


def _by_reason(rejected):
    return rejected.groupBy("reason").agg(
        F.count(F.lit(1)).alias("messages"), F.count("payload").alias("with_payload"))


def unusable_messages(spark, folder):
    return _by_reason(ingest.unusable(_faulty_feed(spark, folder)))


def field_faults(spark, folder):
    """Fields of usable messages that became null, by what they held."""
    return ingest.field_faults(_misfit_feed(spark, folder)).groupBy(
        "field", "expected", "found", "reason", "text").agg(F.count(F.lit(1)).alias("messages"))


def published_messages(spark, folder):
    return messages(_interactions(spark, folder, country=True))


def recent_interactions(spark, folder):
    return ingest.recent(_interactions(spark, folder), _instant(AS_OF))


def engagement_scores(spark, folder):
    return _interactions(spark, folder, "event_id").select(
        "event_id", "interaction_type", engagement_score().alias("engagement_score"))


# --- popularity -----------------------------------------------------------------------------


def course_popularity_hourly(spark, folder):
    return pop.popularity(_interactions(spark, folder))


def course_popularity_daily(spark, folder):
    return pop.popularity(_interactions(spark, folder), "1 day")


def course_popularity_approx(spark, folder):
    return pop.popularity(_interactions(spark, folder), exact=False)


def approx_error_check(spark, folder):
    """Windows, and windows whose sketch is off by more than one student and 15 %."""
    interactions = _interactions(spark, folder)
    by = ["course_code", "window_start"]
    exact = pop.popularity(interactions, "1 day").select(*by, "active_users", "engagement_score")
    approx = pop.popularity(interactions, "1 day", exact=False).select(
        *by, F.col("active_users").alias("estimate"), F.col("engagement_score").alias("score"))
    off = F.abs(F.col("estimate") - F.col("active_users"))
    return exact.join(approx, by, "full").agg(
        F.count(F.lit(1)).alias("windows"),
        F.count_if(
            off.isNull() | (off > F.greatest(F.lit(1.0), F.col("active_users") * 0.15))
        ).alias("off_limits"),
        F.count_if(~F.col("score").eqNullSafe(F.col("engagement_score"))).alias("other_scores"),
    )


def _hourly_sketches(spark, folder):
    """Hourly sketches, written once; all else is merged from them."""
    return stored(sketches.hourly_sketches(_interactions(spark, folder)),
                  working_dir(spark, "sketches"))


def course_popularity_daily_merged(spark, folder):
    """Daily popularity from hourly sketches, which are exact for as few students as here."""
    return sketches.estimated(sketches.merged(_hourly_sketches(spark, folder), "1 day"))


def sketch_rollup_check(spark, folder):
    """Days, and days whose merged sketch differs from one over the events, or by more than one student
    and 6 % from the exact count; the same for days of course categories."""
    interactions, hourly = _interactions(spark, folder), _hourly_sketches(spark, folder)
    category = course_category().alias("category")

    def compared(by, rows, parts):
        keys = [by, "window_start"]
        merged = sketches.merged(parts, "1 day", (by,))
        direct = sketches.hourly_sketches(rows, "1 day", (by,))
        exact = pop.popularity(rows, "1 day", (by,)).select(*keys, "active_users")
        both = merged.select(*keys, F.col("students").alias("merged")).join(
            direct.select(*keys, F.col("students").alias("direct")), keys, "full").join(
            exact, keys, "full")
        off = F.abs(sketches.active_users("merged") - F.col("active_users"))
        return both.agg(
            F.lit(by).alias("by"), F.count(F.lit(1)).alias("windows"),
            F.count_if(~F.coalesce(sketches.same_students("merged", "direct"), F.lit(False)))
            .alias("different"),
            F.count_if(off.isNull() | (off > F.greatest(F.lit(1.0), F.col("active_users") * 0.06)))
            .alias("off_limits"))
    return compared("course_code", interactions, hourly).unionByName(compared(
        "category", interactions.select("*", category), hourly.select("*", category)))


def course_popularity_current(spark, folder):
    return pop.published(pop.current_popularity(pop.popularity(_interactions(spark, folder))))


def course_popularity_ranked(spark, folder):
    rows = pop.ranked(pop.popularity(_interactions(spark, folder)))
    return cnt.numbered(rows, "place", working_dir(spark, "ranked"), first=1)


def top_courses(spark, folder):
    return pop.top_courses(pop.popularity(_interactions(spark, folder), "1 day"), 10)


def category_popularity_hourly(spark, folder):
    return pop.category_popularity(_interactions(spark, folder))


# --- counts, indexes, keyed tables ----------------------------------------------------------


def interaction_counts(spark, folder):
    return cnt.interaction_counts(_interactions(spark, folder))


def student_last_seen(spark, folder):
    return cnt.last_seen(cnt.interaction_counts(_interactions(spark, folder)))


def _pairs(spark, folder):
    """Counts per pair, written once and read by each step that needs them."""
    return stored(cnt.interaction_counts(_interactions(spark, folder)),
                  working_dir(spark, "pairs"))


def student_index(spark, folder):
    return cnt.dense_index(_pairs(spark, folder), "student_id", "student_index")


def course_index(spark, folder):
    return cnt.dense_index(_pairs(spark, folder), "course_code", "course_index")


def indexed_pairs(spark, folder):
    pairs = _pairs(spark, folder)
    return index_pairs(pairs, cnt.dense_index(pairs, "student_id", USER),
                       cnt.dense_index(pairs, "course_code", ITEM))


def interaction_log_latest(spark, folder):
    """Last interaction per student and day: many writes share a key."""
    rows = _interactions(spark, folder, "event_id").withColumn("day", F.to_date("timestamp"))
    return latest_by_key(rows, ["student_id", "day"], ["timestamp", "event_id"])


def interaction_log_upsert(spark, folder):
    """A keyed log written twice and compacted in between; the second write wins."""
    table = Tables(spark, working_dir(spark, "log")).interaction_logs
    rows = _log_rows(spark, folder, country=True)
    corrected = rows.filter(F.col("interaction_type") != "profile_updated")
    table.write_batch(rows.withColumn("interaction_type", F.lit("search_performed")), 0)
    table.compact()
    table.write_batch(corrected, 1)
    table.write_batch(corrected, 1)
    return table.latest()


def student_timelines(spark, folder):
    table = Tables(spark, working_dir(spark, "log")).interaction_logs
    table.append(_log_rows(spark, folder))
    return cnt.numbered(table.in_key_order(), "place", working_dir(spark, "timelines"), first=1)


def log_two_writers(spark, folder):
    """One log from a load, a compaction, a stream, and a stream that began again elsewhere; the
    last one corrects what the one before it wrote."""
    root = working_dir(spark, "writers")
    table = Tables(spark, root).interaction_logs
    table.append(_log_rows(spark, folder).filter(F.col("timestamp") < _instant(HISTORY_CUT)))
    table.compact()
    feed = ev.lift(ev.stream_events(spark, folder), None, "event_id").withColumnRenamed(
        "event_id", "ingest_offset").filter(F.col("timestamp") >= _instant(HISTORY_CUT))
    await_all(start_interaction_log(feed, table, f"{root}/first", ONCE))
    corrected = feed.filter(F.col("timestamp") >= _instant(SECOND_CUT)).withColumn(
        "interaction_type", F.lit("search_performed"))
    await_all(start_interaction_log(corrected, table, f"{root}/second", ONCE))
    table.compact()
    return table.latest()


def snapshot_after_restart(spark, folder):
    """The snapshots of a stream that lost its checkpoint: the new one's first is the newest."""
    root = working_dir(spark, "snapshots")
    store = PopularityStore(spark, f"{root}/popularity", "complete", exact=True, keep=1)
    early = ev.lift(ev.stream_events(spark, folder)).filter(
        F.col("timestamp") < _instant(HISTORY_CUT))
    old = pop.popularity(_interactions(spark, folder).filter(
        F.col("timestamp") < _instant(HISTORY_CUT)))
    store.table.write_version(old, 100)
    for feed, checkpoint in ((early, "first"), (ev.lift(ev.stream_events(spark, folder)), "second")):
        await_all(start_popularity(feed, store, f"{root}/{checkpoint}", trigger=ONCE,
                                   state_partitions=_state_partitions(spark)))
    return store.windows()


def _bucketed_log(spark, folder, buckets=16):
    """The log in buckets, from two writes of which the second corrects the first."""
    table = BucketedTable(spark, working_dir(spark, "bucketed-log"), model.INTERACTION_LOGS,
                          buckets=buckets)
    rows = _log_rows(spark, folder)
    table.add(rows.filter(F.col("timestamp") < _instant(HISTORY_CUT)).withColumn(
        "interaction_type", F.lit("search_performed")))
    table.add(rows)
    return table


def bucketed_timeline(spark, folder):
    """All events of the student who has the most, from one bucket."""
    table = _bucketed_log(spark, folder)
    table.compact()
    most = table.rows().groupBy("student_id").agg(F.count(F.lit(1)).alias("events")).orderBy(
        F.desc("events"), "student_id").first()
    return table.lookup(most.student_id)


def bucketed_recommendations(spark, folder):
    """Stored recommendations beside their students' last events: a join of two bucketed tables."""
    log = _bucketed_log(spark, folder)
    recommended = BucketedTable(
        spark, working_dir(spark, "bucketed-recommendations"), model.STUDENT_RECOMMENDATIONS,
        buckets=log.buckets)
    recommended.add(_frequent_recommendations(_pairs(spark, folder)))
    seen = log.rows().groupBy("student_id").agg(
        F.max("timestamp").alias("last_seen"), F.count(F.lit(1)).alias("events"))
    return recommended.rows().join(seen, "student_id").select(
        "student_id", "course_code", "rating", "last_seen", "events")


def counts_in_arrivals(spark, folder):
    """Counts by day after three arrivals, the last one late: only days with new files are read."""
    root = working_dir(spark, "arrivals")
    counts, rows, day = DayCounts(spark, f"{root}/counts"), _interactions(spark, folder), F.col("timestamp")
    late_from, late_until = _instant(LATE_FROM), _instant(LATE_UNTIL)
    for part in (day < late_from, day >= late_until, (day >= late_from) & (day < late_until)):
        land(rows.filter(part), f"{root}/landing", by_date=True, rebalance=True)
        counts.update(f"{root}/landing")
    return counts.counts()


def student_logs(spark, folder):
    """The log under the column name of its row-at-a-time variant."""
    return renamed(_interactions(spark, folder, country=True),
                   {"timestamp": "timestamp_interaction"})


def landed_interactions(spark, folder):
    path = working_dir(spark, "landing")
    land(_interactions(spark, folder, country=True), path, by_date=True, rebalance=True)
    return read_landed(spark, path)


def landed_quarantine(spark, folder):
    """What became of each line of a damaged landing: taken, or set aside with a reason."""
    root = working_dir(spark, "damaged")
    lines = _faulty_feed(spark, folder).select(F.col("value").cast("string")).filter(
        F.col("value").isNotNull())
    lines.write.text(f"{root}/landing")
    tables = Tables(spark, f"{root}/tables")
    moved = ingest_landed(spark, f"{root}/landing", tables)
    aside = spark.read.parquet(f"{moved.folder}/*").groupBy("reason").agg(
        F.count("payload").alias("lines"))
    return aside.unionByName(spark.createDataFrame(
        [("taken", moved.taken)], "reason string, lines long"))


# --- recommendations ------------------------------------------------------------------------


def _most_frequent(pairs, students, courses, n=5):
    """Each student's n most frequent courses in the shape the factorisation recommends in."""
    best = Window.partitionBy(USER).orderBy(F.desc("rating"), F.asc(ITEM))
    return (
        index_pairs(pairs, students, courses)
        .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n)
        .groupBy(USER)
        .agg(F.sort_array(F.collect_list(F.struct("rank", ITEM, "rating"))).alias(RECS))
        .select(USER, F.transform(
            RECS, lambda r: F.struct(r[ITEM].alias(ITEM), r["rating"].alias("rating"))
        ).alias(RECS))
    )


def _frequent_recommendations(pairs):
    students = cnt.dense_index(pairs, "student_id", USER)
    courses = cnt.dense_index(pairs, "course_code", ITEM)
    return assemble(_most_frequent(pairs, students, courses), pairs, students, courses)


def recommendation_assembly(spark, folder):
    """Index, join, explode and label steps over recommendations that SQL can state."""
    return _frequent_recommendations(_pairs(spark, folder))


def recommendation_history(spark, folder):
    """Recommendations stored at two points in time, the second batch replayed."""
    table = Tables(spark, working_dir(spark, "recommendations")).student_recommendations
    rows = _interactions(spark, folder)
    early = cnt.interaction_counts(rows.filter(F.col("timestamp") < _instant(HISTORY_CUT)))
    table.append(_frequent_recommendations(stored(early, working_dir(spark, "early"))))
    now = _frequent_recommendations(_pairs(spark, folder))
    table.write_batch(now, *table.append(now))
    return table.latest()


def recommendations_top5(spark, folder):
    return fit_recommender(spark, _interactions(spark, folder)).recommendations(5)


def recommendations_unseen_top5(spark, folder):
    return fit_recommender(spark, _interactions(spark, folder)).recommendations(
        5, exclude_seen=True)


def _recommendation_facts(recommender, rows):
    """What must hold for recommendations whatever the factors are, as one row."""
    seen = cnt.last_seen(recommender.pairs).withColumnsRenamed({"timestamp": "seen_at"})
    known = recommender.pairs.select("student_id", "course_code", F.lit(1).alias("was_seen"))
    ordered = Window.partitionBy("student_id").orderBy("rank")
    checked = (
        rows.withColumn("before", F.lag("rating").over(ordered))
        .join(seen, "student_id", "full")
        .join(known, ["student_id", "course_code"], "left")
    )
    return checked.agg(
        F.count("course_code").alias("recommendations"),
        F.max("rank").alias("last_rank"),
        F.count_if(F.col("rating") > F.col("before")).alias("rating_rises"),
        F.count_if(F.col("course_code").isNotNull()
                   & ~F.col("recommendation_time").eqNullSafe(F.col("seen_at")))
        .alias("wrong_times"),
        F.count("was_seen").alias("already_seen"),
    )


def recommendation_check(spark, folder):
    recommender = fit_recommender(spark, _interactions(spark, folder))
    return _recommendation_facts(recommender, recommender.recommendations(5)).drop("already_seen")


def recommendation_unseen_check(spark, folder):
    recommender = fit_recommender(spark, _interactions(spark, folder))
    return _recommendation_facts(recommender, recommender.recommendations(5, exclude_seen=True))


def recommendation_length_check(spark, folder):
    """The five best found in the order of the factors' lengths, against the library's scoring of every
    pair: places that differ, and whether fewer pairs were scored."""
    recommender = fit_recommender(spark, _interactions(spark, folder))
    found, all_scored = recommender.top_n_by_length(5), recommender.top_n(5)
    both = found.select(USER, F.posexplode(RECS).alias("place", "found")).join(
        all_scored.select(USER, F.posexplode(RECS).alias("place", "wanted")), [USER, "place"], "full")
    off = F.abs(F.col("found.rating") - F.col("wanted.rating"))
    different = both.agg(F.count_if(
        F.coalesce(off > 1e-4 * F.greatest(F.lit(1.0), F.abs("wanted.rating")), F.lit(True)))
        .alias("different"))
    return found.agg(
        F.count(F.lit(1)).alias("students"),
        (F.sum("scored") < F.count(F.lit(1)) * recommender.courses.count()).alias("fewer"),
    ).join(different)  # one row each


def als_residual_check(spark, folder):
    """Whether the fitted factors are right: students whose factors miss the equations of their ratings
    by more than a thousandth."""
    found = fit_recommender(spark, _interactions(spark, folder)).residuals()
    missed = F.col("residual") > 1e-3 * F.col("scale") + 1e-9
    return found.agg(F.count(F.lit(1)).alias("students"), F.sum("ratings").alias("ratings"),
                     F.count_if(F.coalesce(missed, F.lit(True))).alias("unsolved"))


def recommendation_proof(spark, folder):
    """Whether the five are the best: ratings that aren't the product of the factors, and courses
    left out that rate higher than one returned. The other courses' ratings come from a listing of
    all courses of each student, scored in the library's blocks."""
    recommender = fit_recommender(spark, _interactions(spark, folder))
    returned = recommender.top_n(5).select(USER, F.inline(RECS))
    users = recommender.model.userFactors.select(F.col("id").alias(USER), F.col("features").alias("u"))
    items = recommender.model.itemFactors.select(F.col("id").alias(ITEM), F.col("features").alias("i"))
    product = F.aggregate(
        F.zip_with("u", "i", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, x: s + x)
    wrong = returned.join(users, USER).join(items, ITEM).agg(
        F.count(F.lit(1)).alias("checked"),
        F.count_if(F.abs(product - F.col("rating")) > 1e-3 * F.greatest(F.lit(1.0), F.abs(product)))
        .alias("wrong_ratings"))
    least = returned.groupBy(USER).agg(F.min("rating").alias("least"))
    listed = recommender.top_n(recommender.courses.count()).select(USER, F.inline(RECS))
    better = listed.join(returned.select(USER, ITEM), [USER, ITEM], "left_anti").join(
        least, USER).agg(F.count(F.lit(1)).alias("left_out"),
                         F.count_if(F.col("rating") > F.col("least")).alias("better_left_out"))
    return wrong.join(better)  # one row each


# --- profiles -------------------------------------------------------------------------------


def cohort_category_affinity(spark, folder):
    return profiles.cohort_affinity(_interactions(spark, folder)).withColumn(
        "share", F.round("share", 6))


def daypart_profile(spark, folder):
    return profiles.daypart_profile(_interactions(spark, folder)).withColumn(
        "share", F.round("share", 6))


def interaction_quality(spark, folder):
    return profiles.quality_report(_interactions(spark, folder))


def damaged_feed_quality(spark, folder):
    return profiles.quality_report(ingest.decode(_faulty_feed(spark, folder)))


# --- streams --------------------------------------------------------------------------------


def _state_partitions(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def stream_interaction_log(spark, folder):
    root = working_dir(spark, "stream-log")
    table = Tables(spark, root).interaction_logs
    await_all(start_interaction_log(
        ingest.interactions_from(_feed(spark, folder)), table, f"{root}/checkpoint", ONCE))
    return table.latest()


def stream_quarantine(spark, folder):
    root = working_dir(spark, "stream-quarantine")
    await_all(start_quarantine(
        ingest.unusable(_faulty_feed(spark, folder, stream=True)), f"{root}/quarantine",
        f"{root}/checkpoint", ONCE))
    return _by_reason(spark.read.parquet(f"{root}/quarantine"))


def _stream_popularity(spark, folder, mode: str, exact: bool) -> DataFrame:
    root = working_dir(spark, f"stream-{mode}")
    store = PopularityStore(spark, f"{root}/popularity", mode, exact)
    interactions = ev.lift(ev.stream_events(spark, folder))
    await_all(start_popularity(
        interactions, store, f"{root}/checkpoint", trigger=ONCE,
        state_partitions=_state_partitions(spark)))
    return store.windows()


def stream_popularity_complete(spark, folder):
    return _stream_popularity(spark, folder, "complete", exact=True)


def stream_popularity_update(spark, folder):
    return _stream_popularity(spark, folder, "update", exact=True)


def stream_popularity_append(spark, folder):
    return _stream_popularity(spark, folder, "append", exact=True)


def stream_popularity_approx(spark, folder):
    return _stream_popularity(spark, folder, "complete", exact=False)


def _popularity_in_three_runs(spark, folder, mode: str, repaired: bool = False) -> DataFrame:
    """One checkpoint and three runs: events before, after, and last those between, a week and more
    behind the watermark by then."""
    root = working_dir(spark, f"runs-{mode}")
    store = PopularityStore(spark, f"{root}/popularity", mode, exact=True)
    late = LateEvents(spark, f"{root}/late", aligned=True)
    events = ev.read_events(spark, folder)
    day = F.col("ts")
    late_from, late_until = (F.lit(t).cast("timestamp_ntz") for t in (LATE_FROM, LATE_UNTIL))
    for part in (day < late_from, day >= late_until, (day >= late_from) & (day < late_until)):
        events.filter(part).write.mode("append").parquet(f"{root}/events")
        feed = ev.lift(spark.readStream.schema(ev.EVENTS_SCHEMA).option(
            "maxFilesPerTrigger", 4).parquet(f"{root}/events"))
        await_all(start_popularity(feed, store, f"{root}/checkpoint", trigger=ONCE,
                                   state_partitions=_state_partitions(spark)))
        if repaired:
            await_all(start_late_events(feed, late, f"{root}/late-checkpoint", ONCE))
    if repaired:
        late.repair(store, _interactions(spark, folder))
    return store.windows()


def stream_late_complete(spark, folder):
    return _popularity_in_three_runs(spark, folder, "complete")


def stream_late_update(spark, folder):
    return _popularity_in_three_runs(spark, folder, "update")


def stream_late_repaired(spark, folder):
    """Update mode, and the windows of what it dropped counted anew: the same as complete mode."""
    return _popularity_in_three_runs(spark, folder, "update", repaired=True)


def stream_log_last_wins(spark, folder):
    """Repeats dropped inside the stream, the last one kept, where a student's events of an hour share a
    key; the last hour's are still held back."""
    root = working_dir(spark, "stream-last")
    feed = ingest.interactions_from(_feed(spark, folder)).withColumn(
        "timestamp", F.date_trunc("hour", "timestamp"))

    def write(batch, number):
        batch.select(*model.INTERACTION_SCHEMA.names).write.mode("overwrite").parquet(
            f"{root}/rows/batch={number}")
    await_all(start_interaction_log(feed, write, f"{root}/checkpoint", ONCE, "1 hour", "last"))
    return spark.read.parquet(f"{root}/rows").drop("batch")


def stream_state(spark, folder):
    """Keys in the state per window after all events: all of them in complete mode, and only those of
    windows that the watermark has not passed in update mode."""
    found = None
    for mode in ("complete", "update"):
        root = working_dir(spark, f"state-{mode}")
        store = PopularityStore(spark, f"{root}/popularity", mode, exact=True)
        await_all(start_popularity(
            ev.lift(ev.stream_events(spark, folder)), store, f"{root}/checkpoint", trigger=ONCE,
            state_partitions=_state_partitions(spark)))
        held = windows_in_state(spark, f"{root}/checkpoint").withColumn("mode", F.lit(mode))
        found = held if found is None else found.unionByName(held)
    return found


def stream_approx_check(spark, folder):
    """The sketch a stream keeps must give the very numbers of the batch sketch."""
    by = ["course_code", "window_start"]
    streamed = stream_popularity_approx(spark, folder).select(
        *by, "timestamp", F.col("total_popularity").alias("total"))
    batch = pop.popularity(_interactions(spark, folder), exact=False).select(
        *by, F.col("timestamp").alias("last"), "total_popularity")
    same = F.col("total").eqNullSafe(F.col("total_popularity")) & (
        F.col("timestamp").eqNullSafe(F.col("last")))
    return streamed.join(batch, by, "full").agg(
        F.count(F.lit(1)).alias("windows"), F.count_if(~same).alias("different"))


def stream_popularity_job(spark, folder):
    """Both queries of the popularity job over one JSON feed; the course table they maintain."""
    root = working_dir(spark, "stream-job")
    tables = Tables(spark, root)
    await_all(*popularity_job(
        ingest.interactions_from(_feed(spark, folder)), tables, f"{root}/checkpoints",
        mode="update", exact=True,
        trigger=ONCE, state_partitions=_state_partitions(spark)))
    logged = tables.interaction_logs.latest().groupBy("course_code").agg(
        F.count(F.lit(1)).alias("logged"))
    return tables.course_popularity("update", True).current().join(logged, "course_code")


# --- registry -------------------------------------------------------------------------------

_QUERIES: tuple[Query, ...] = (
    parse_interactions,
    valid_interactions,
    unusable_messages,
    field_faults,
    published_messages,
    recent_interactions,
    engagement_scores,
    course_popularity_hourly,
    course_popularity_daily,
    course_popularity_approx,
    approx_error_check,
    course_popularity_daily_merged,
    sketch_rollup_check,
    course_popularity_current,
    course_popularity_ranked,
    top_courses,
    category_popularity_hourly,
    interaction_counts,
    student_last_seen,
    student_index,
    course_index,
    indexed_pairs,
    interaction_log_latest,
    interaction_log_upsert,
    student_timelines,
    log_two_writers,
    snapshot_after_restart,
    bucketed_timeline,
    bucketed_recommendations,
    counts_in_arrivals,
    student_logs,
    landed_interactions,
    landed_quarantine,
    recommendation_assembly,
    recommendation_history,
    recommendations_top5,
    recommendations_unseen_top5,
    recommendation_check,
    recommendation_unseen_check,
    als_residual_check,
    recommendation_length_check,
    recommendation_proof,
    cohort_category_affinity,
    daypart_profile,
    interaction_quality,
    damaged_feed_quality,
    stream_interaction_log,
    stream_quarantine,
    stream_popularity_complete,
    stream_popularity_update,
    stream_popularity_append,
    stream_popularity_approx,
    stream_approx_check,
    stream_popularity_job,
    stream_late_complete,
    stream_late_update,
    stream_late_repaired,
    stream_log_last_wins,
    stream_state,
)


def _ensure_shared_folder(spark: SparkSession) -> None:
    """A folder for a session in one process that names none; on a cluster the setting is needed."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named and spark.sparkContext.master.split("[")[0] == "local":
        folder = tempfile.mkdtemp(prefix="coursepulse-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(folder)


def _prepared(query: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        _ensure_shared_folder(spark)
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        rows = query(spark, folder.rstrip("/"))
        instants = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.TimestampType)]
        return rows.withColumns({name: F.col(name).cast("timestamp_ntz") for name in instants})
    return run


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: exact hourly course popularity."""
    return _prepared(course_popularity_hourly)(spark, SMOKE_DIR)


def queries() -> dict[str, Query]:
    found = {query.__name__: _prepared(query) for query in _QUERIES}
    if llm is not None:
        found |= {query.__name__: _prepared(query) for query in llm.QUERIES}
        found["pipeline"] = _prepared(corpus_pipeline.run)
    return found


# --- SQL counterparts -----------------------------------------------------------------------

_PREFIX_LIST = ", ".join(f"'{p}'" for p in model.COURSE_PREFIXES)
_TYPE_CASE = " ".join(f"when '{e}' then '{i}'" for e, i in ev.INTERACTION_OF.items())
_SCORE = "case interaction_type " + " ".join(
    f"when '{kind}' then {weight}" for kind, weight in model.ENGAGEMENT_WEIGHTS.items()
) + " else 0 end"
_CATEGORY = "case " + " ".join(
    "when course_code[1:2] in ({}) then '{}'".format(
        ", ".join(f"'{p}'" for p in prefixes), category)
    for category, prefixes in model.COURSE_CATEGORIES.items()
) + f" else '{model.OTHER_CATEGORY}' end"

_LIFT = f"""
lifted as (
  select 'S' || cast(10000 + user_id as varchar) as student_id,
         [{_PREFIX_LIST}][k % 15 + 1] || cast(100 + k as varchar) as course_code,
         case event_type {_TYPE_CASE} end as interaction_type,
         ts as "timestamp",
         case when event_type = 'click' then cast(floor(value) as integer) end as duration,
         n_name as location_country,
         cast(null as varchar) as location_city,
         event_id, event_type, value, props
  from (select *, cast(json_extract_string(props, '$.k') as integer) as k from events)
  left join nation on n_nationkey = user_id % 25
)"""

_FLAT = ('student_id, course_code, interaction_type, "timestamp", duration, '
         "location_country, location_city")
_FLAT_WIRE = _FLAT.replace('"timestamp"', """date_trunc('second', "timestamp") as "timestamp\"""")
_FLAT_NO_COUNTRY = _FLAT.replace(
    "location_country", "cast(null as varchar) as location_country")


def _windows_sql(grain: str, by: str = "course_code", source: str = "lifted") -> str:
    return f"""
  select {by}, date_trunc('{grain}', "timestamp") as window_start,
         max("timestamp") as "timestamp",
         cast(count(distinct student_id) as integer) as active_users,
         cast(sum({_SCORE}) as integer) as engagement_score,
         cast(count(distinct student_id) + sum({_SCORE}) as integer) as total_popularity
  from {source} group by {by}, date_trunc('{grain}', "timestamp")"""


_PAIRS = """
pairs as (
  select student_id, course_code, count(interaction_type) as interaction_count,
         max("timestamp") as "timestamp"
  from lifted group by student_id, course_code
)"""


def _index_sql(label: str, index: str, pairs: str = "pairs") -> str:
    return f"""select {label},
         cast(row_number() over (order by count(*) desc, {label}) - 1 as integer) as {index}
  from {pairs} group by {label}"""


def _frequent_sql(pairs: str) -> str:
    return f"""
  select p.student_id, p.course_code,
         max(p."timestamp") over (partition by p.student_id) as recommendation_time,
         cast(interaction_count as float) as rating,
         cast(row_number() over (
           partition by p.student_id order by interaction_count desc, course_index) as integer)
           as rank
  from {pairs} p join ({_index_sql("course_code", "course_index", pairs)}) c
    on p.course_code = c.course_code
  qualify rank <= 5"""




def _logged_sql(columns: str, at: str, late_first: str = "event_id desc") -> str:
    """The keyed log: one row per (student, ``at``), the last one in the feed."""
    return f"""
  select {columns} from lifted
  qualify row_number() over (partition by student_id, {at} order by {late_first}) = 1"""


_SECOND = """date_trunc('second', "timestamp")"""

_CURRENT = """
  select course_code, "timestamp", active_users, engagement_score, total_popularity
  from ({windows})
  qualify row_number() over (partition by course_code order by window_start desc) = 1"""

_REPORT = """
  select count(*) as interactions,
         count(*) filter (student_id is null) as null_student,
         count(*) filter (course_code is null) as null_course,
         count(*) filter (interaction_type is null) as null_type,
         count(*) filter ("timestamp" is null) as null_timestamp,
         count(*) filter (not regexp_full_match(student_id, 'S[0-9]{{5}}')) as malformed_student,
         count(*) filter (interaction_type not in ({types})) as unknown_type,
         count(*) filter (interaction_type = 'video_watched' and duration is null)
           as missing_duration,
         count(*) filter (interaction_type is distinct from 'video_watched'
           and duration is not null) as unexpected_duration,
         count(*) filter (duration < 20 or duration > 7200) as duration_out_of_range
  from {source}"""

_FAULTY = """
faulty as (
  select case when value < 10 then null else student_id end as id, *
  from lifted where event_type = 'error'
), received as (
  select student_id, course_code, interaction_type, "timestamp", duration
  from lifted where event_type <> 'error'
  union all
  select null, case when value >= 10 then course_code end,
         case when value >= 10 then interaction_type end,
         case when value >= 10 then date_trunc('second', "timestamp") end, null
  from lifted where event_type = 'error'
)"""


def oracle_sql() -> dict[str, str]:
    found = _own_sql()
    if llm is not None:
        found |= llm.SQL
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def _own_sql() -> dict[str, str]:
    hourly, daily = _windows_sql("hour"), _windows_sql("day")
    types = ", ".join(f"'{t}'" for t in model.INTERACTION_TYPES)
    lift, pairs = f"with {_LIFT}", f"with {_LIFT}, {_PAIRS}"
    flat = f"{lift} select {_FLAT} from lifted"
    flat_wire = f"{lift} select {_FLAT_WIRE} from lifted"
    wire_windows = _windows_sql("hour").replace(
        'max("timestamp")', """max(date_trunc('second', "timestamp"))""")
    rejected = f"""{lift}
  select case when value < 2 then 'null_payload' when value < 10 then 'malformed'
              else 'no_student' end as reason,
         count(*) as messages,
         count(*) filter (value >= 2) as with_payload
  from lifted where event_type = 'error' group by 1"""
    return {
        "parse_interactions": flat_wire,
        "valid_interactions": f"{flat_wire} where event_type <> 'error'",
        "unusable_messages": rejected,
        "field_faults": f"""{lift}
  select *, count(*) as messages
  from (select case when value < 5 then 'duration' when value < 8 then 'timestamp'
                    else 'location' end as field,
               case when value < 5 then 'int' when value < 8 then 'timestamp'
                    else 'object' end as expected,
               case when value >= 2 and value < 5 then 'DECIMAL(3,1)' else 'STRING' end as found,
               case when value < 2 then 'ill_typed' when value < 5 then 'out_of_range'
                    when value < 8 then 'no_time' else 'ill_typed' end as reason,
               case when value < 2 then 'long' when value < 5 then '12.5' when value < 8 then 'soon'
                    else 'PERU' end as text
        from lifted where event_type = 'error' and value < 12) group by all""",
        "published_messages": f"""{lift}
  select student_id as "key",
         '{{"student_id":"' || student_id || '","course_code":"' || course_code
         || '","interaction_type":"' || interaction_type
         || '","timestamp":"' || strftime("timestamp", '%Y-%m-%d %H:%M:%S')
         || '","duration":' || coalesce(cast(duration as varchar), 'null')
         || ',"location":{{"country":"' || location_country || '","city":null}}}}' as "value"
  from lifted""",
        "recent_interactions": f"""{lift} select {_FLAT_NO_COUNTRY} from lifted
  where "timestamp" >= timestamp '2024-01-29 23:00:00'""",
        "engagement_scores": f"""{lift}
  select event_id, interaction_type, cast({_SCORE} as integer) as engagement_score
  from lifted""",
        "course_popularity_hourly": lift + hourly,
        "course_popularity_daily": lift + daily,
        "approx_error_check": f"""{lift}
  select count(*) as windows, cast(0 as bigint) as off_limits, cast(0 as bigint) as other_scores
  from ({daily})""",
        "course_popularity_daily_merged": lift + daily,
        "sketch_rollup_check": f"""{lift}
  select 'course_code' as "by", count(*) as windows, cast(0 as bigint) as different,
         cast(0 as bigint) as off_limits from ({daily})
  union all
  select 'category', count(*), 0, 0
  from (select distinct {_CATEGORY}, date_trunc('day', "timestamp") from lifted)""",
        "course_popularity_current": lift + _CURRENT.format(windows=hourly),
        "course_popularity_ranked": f"""{lift} select *, row_number() over (
    order by total_popularity desc, course_code, window_start desc) as place from ({hourly})""",
        "top_courses": f"""{lift} {daily}
  order by total_popularity desc, course_code, window_start desc limit 10""",
        "category_popularity_hourly": lift + _windows_sql(
            "hour", "category", f"(select *, {_CATEGORY} as category from lifted)"),
        "interaction_counts": f"{pairs} select * from pairs",
        "student_last_seen":
            f'{lift} select student_id, max("timestamp") as "timestamp" from lifted group by 1',
        "student_index": f"{pairs} {_index_sql('student_id', 'student_index')}",
        "course_index": f"{pairs} {_index_sql('course_code', 'course_index')}",
        "indexed_pairs": f"""{pairs}
  select student_index, course_index, cast(interaction_count as float) as rating
  from pairs join ({_index_sql('student_id', 'student_index')}) using (student_id)
             join ({_index_sql('course_code', 'course_index')}) using (course_code)""",
        "interaction_log_latest": f"""{lift}
  select {_FLAT_NO_COUNTRY}, event_id, cast("timestamp" as date) as day from lifted
  qualify row_number() over (
    partition by student_id, cast("timestamp" as date)
    order by "timestamp" desc, event_id desc) = 1""",
        "interaction_log_upsert": lift + _logged_sql(
            """student_id, course_code,
         case interaction_type when 'profile_updated' then 'search_performed'
              else interaction_type end as interaction_type,
         "timestamp", duration, location_country, location_city""",
            '"timestamp"', "interaction_type = 'profile_updated', event_id desc"),
        "student_timelines": f"""{lift} select *, row_number() over (
    order by student_id, "timestamp") as place
  from ({_logged_sql(_FLAT_NO_COUNTRY, '"timestamp"')})""",
        "log_two_writers": lift + _logged_sql(
            f"""student_id, course_code,
         case when "timestamp" >= timestamp '{SECOND_CUT}' then 'search_performed'
              else interaction_type end as interaction_type,
         "timestamp", duration, cast(null as varchar) as location_country, location_city""",
            '"timestamp"'),
        "snapshot_after_restart": lift + hourly,
        "bucketed_timeline": f"""{lift}, logged as ({_logged_sql(_FLAT_NO_COUNTRY, '"timestamp"')})
  select * from logged where student_id = (
    select student_id from logged group by 1 order by count(*) desc, student_id limit 1)""",
        "bucketed_recommendations": f"""{pairs},
  logged as ({_logged_sql('student_id, "timestamp"', '"timestamp"')}),
  seen as (select student_id, max("timestamp") as last_seen, count(*) as events
           from logged group by 1)
  select student_id, course_code, rating, last_seen, events
  from ({_frequent_sql('pairs')}) join seen using (student_id)""",
        "counts_in_arrivals": f"""{pairs}
  select * replace (date_trunc('second', "timestamp") as "timestamp") from pairs""",
        "landed_quarantine": f"""{lift}
  select case when event_type <> 'error' then 'taken' when value < 10 then 'malformed'
              else 'no_student' end as reason, count(*) as lines
  from lifted where event_type <> 'error' or value >= 2 group by 1""",
        "student_logs":
            flat.replace('"timestamp", duration', '"timestamp" as timestamp_interaction, duration'),
        "landed_interactions": flat_wire,
        "recommendation_assembly": f"{pairs} {_frequent_sql('pairs')}",
        "recommendation_history": f"""{pairs}, early as (
    select student_id, course_code, count(interaction_type) as interaction_count,
           max("timestamp") as "timestamp"
    from lifted where "timestamp" < timestamp '2024-01-15' group by student_id, course_code
  ), written as (
    select *, 0 as batch from ({_frequent_sql('early')})
    union all select *, 1 as batch from ({_frequent_sql('pairs')})
  )
  select student_id, course_code, rating, recommendation_time from written
  qualify row_number() over (
    partition by student_id, course_code, recommendation_time order by batch desc) = 1""",
        "recommendation_check": f"""{pairs}
  select cast(count(distinct student_id) * least(5, count(distinct course_code)) as bigint)
           as recommendations,
         cast(least(5, count(distinct course_code)) as integer) as last_rank,
         cast(0 as bigint) as rating_rises, cast(0 as bigint) as wrong_times
  from pairs""",
        "recommendation_unseen_check": f"""{pairs}, open as (
    select least(5, (select count(distinct course_code) from pairs) - count(*)) as places
    from pairs group by student_id
  )
  select cast(sum(places) as bigint) as recommendations,
         cast(max(nullif(places, 0)) as integer) as last_rank,
         cast(0 as bigint) as rating_rises, cast(0 as bigint) as wrong_times,
         cast(0 as bigint) as already_seen
  from open""",
        "als_residual_check": f"""{pairs}
  select count(distinct student_id) as students, count(*) as ratings,
         cast(0 as bigint) as unsolved from pairs""",
        "recommendation_length_check": f"""{pairs}
  select count(distinct student_id) as students, cast(0 as bigint) as different, true as fewer
  from pairs""",
        "recommendation_proof": f"""{pairs}, sizes as (
    select count(distinct student_id) as s, count(distinct course_code) as c from pairs
  )
  select cast(s * least(5, c) as bigint) as checked, cast(0 as bigint) as wrong_ratings,
         cast(s * (c - least(5, c)) as bigint) as left_out, cast(0 as bigint) as better_left_out
  from sizes""",
        "cohort_category_affinity": f"""{lift}, tallied as (
    select case when n % 3 = 0 then 'technical' when n % 4 = 0 then 'humanities'
                else 'uniform' end as cohort,
           {_CATEGORY} as category, count(*) as interactions
    from (select *, cast(student_id[2:] as integer) as n from lifted) group by 1, 2
  )
  select cohort, category, interactions,
         round(interactions / cast(sum(interactions) over (partition by cohort) as double), 6)
           as share
  from tallied""",
        "daypart_profile": f"""{lift}, tallied as (
    select case when clock between 61200 and 79200 then 'evening'
                when clock between 28800 and 57600 then 'daytime' else 'other' end as daypart,
           count(*) as interactions
    from (select hour("timestamp") * 3600 + minute("timestamp") * 60
                 + second("timestamp") as clock from lifted) group by 1
  )
  select daypart, interactions,
         round(interactions / cast(sum(interactions) over () as double), 6) as share
  from tallied""",
        "interaction_quality": lift + _REPORT.format(types=types, source="lifted"),
        "damaged_feed_quality":
            f"{lift}, {_FAULTY}" + _REPORT.format(types=types, source="received"),
        "stream_interaction_log": lift + _logged_sql(_FLAT_WIRE, _SECOND),
        "stream_quarantine": rejected,
        "stream_popularity_complete": lift + hourly,
        "stream_popularity_update": lift + hourly,
        "stream_late_complete": lift + hourly,
        "stream_late_repaired": lift + hourly,
        "stream_log_last_wins": f"""{lift}, hours as (
    select * replace (date_trunc('hour', "timestamp") as "timestamp"), "timestamp" as arrival
    from lifted)
  select {_FLAT} from hours
  where "timestamp" <= (select max("timestamp") from hours) - interval 1 hour
  qualify row_number() over (partition by student_id, "timestamp"
                             order by arrival desc, event_id desc) = 1""",
        "stream_state": f"""{lift}, held as (
    select date_trunc('hour', "timestamp") as window_start,
           count(distinct (course_code, student_id)) as keys
    from lifted group by 1)
  select 'complete' as mode, window_start, keys from held
  union all
  select 'update', window_start, keys from held
  where window_start + interval 1 hour > (select max("timestamp") from lifted) - interval 1 hour""",
        "stream_late_update": lift + _windows_sql("hour", source=f"""(select * from lifted
    where "timestamp" < timestamp '{LATE_FROM}' or "timestamp" >= timestamp '{LATE_UNTIL}')"""),
        "stream_approx_check": f"""{lift}
  select count(*) as windows, cast(0 as bigint) as different from ({hourly})""",
        "stream_popularity_append": f"""{lift} select * from ({hourly})
  where window_start + interval 1 hour
        <= (select max("timestamp") from lifted) - interval 1 hour""",
        "stream_popularity_job": f"""{lift}, logged as (
    select course_code, count(*) as logged
    from ({_logged_sql("course_code", _SECOND)})
    group by 1
  )
  select * from ({_CURRENT.format(windows=wire_windows)}) join logged using (course_code)""",
    }
