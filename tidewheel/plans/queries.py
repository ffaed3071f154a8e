"""One named query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel import functions as fn
from tidewheel.operators import (
    cleaning,
    events,
    follow,
    indexing,
    intervals,
    lattice,
    models,
    ordered,
    paths,
    ranking,
    recommend,
    scoring,
    sessions,
    sketches,
    skew,
    summary,
    versions,
    windows,
)
from tidewheel.plans.views import CUT_MILLIS, ITEM_SLIDE, ITEM_WINDOW, USER_SLIDE, USER_WINDOW, VISIT_GAP, Views
from tidewheel.session import written
from tidewheel.sources import messages
from tidewheel.streaming import decay

Query = Callable[[Views], DataFrame]

_QUERIES: dict[str, Query] = {}


def _query(make: Query) -> Query:
    _QUERIES[make.__name__] = make
    return make


def _rounded(df: DataFrame, *names: str, digits: int = 4) -> DataFrame:
    return df.withColumns({name: F.round(F.col(name), digits) for name in names})


def _zone_less(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the tables hold them."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else f.name
            for f in df.schema
        ]
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(make: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: _zone_less(make(Views(spark, folder)))

    return {name: bind(make) for name, make in _QUERIES.items()}


# Cleaning


@_query
def project_ratings(v: Views) -> DataFrame:
    return cleaning.project_ratings(v.ratings_raw())


@_query
def drop_incomplete(v: Views) -> DataFrame:
    return v.ratings_raw().transform(cleaning.project_ratings).transform(cleaning.drop_incomplete)


@_query
def valid_ratings(v: Views) -> DataFrame:
    return v.ratings_raw().transform(cleaning.project_ratings).transform(cleaning.valid_ratings)


@_query
def latest_per_pair(v: Views) -> DataFrame:
    complete = v.ratings_raw().transform(cleaning.project_ratings).transform(cleaning.drop_incomplete)
    return cleaning.latest_per_pair(complete)


@_query
def clean_ratings(v: Views) -> DataFrame:
    return v.cleaned()


@_query
def cleaning_report(v: Views) -> DataFrame:
    return cleaning.cleaning_report(v.ratings_raw())


@_query
def bernoulli_sample(v: Views) -> DataFrame:
    return cleaning.bernoulli_sample(v.cleaned(), 0.1)


@_query
def train_test_split(v: Views) -> DataFrame:
    train, test = cleaning.train_test_split(v.cleaned())
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


# Ids, titles, lookups


def _stored_ratings(v: Views) -> DataFrame:
    """Cleaned ratings as a stored table, for queries that read them more than once."""
    return written(v.ratings(), "ratings")


@_query
def fit_dense_index(v: Views) -> DataFrame:
    return indexing.fit_dense_index(v.cleaned(), "user_id")


@_query
def apply_dense_index(v: Views) -> DataFrame:
    ratings = written(v.cleaned(), "cleaned")
    users = indexing.fit_dense_index(ratings, "user_id")
    items = indexing.fit_dense_index(ratings, "item_id")
    both = indexing.apply_dense_index(ratings, users, "user_id", "user_idx")
    return indexing.apply_dense_index(both, items, "item_id", "item_idx")


@_query
def item_titles(v: Views) -> DataFrame:
    return indexing.item_titles(v.items(), v.item_metadata(), "record_order")


@_query
def short_title(v: Views) -> DataFrame:
    return v.table("documents").select("doc_id", fn.short_title(F.col("text")).alias("title"))


@_query
def with_titles(v: Views) -> DataFrame:
    titles = indexing.item_titles(v.items(), v.item_metadata(), "record_order")
    rated = v.ratings_raw().select("l_orderkey", "l_linenumber", _item_number().alias("item_id"))
    # Some lines name items that no part stands for.
    item = F.when(F.col("l_linenumber") == 7, -F.col("item_id")).otherwise(F.col("item_id"))
    shown = rated.withColumn("item_id", item)
    return indexing.with_titles(written(shown, "shown"), titles)


def _item_number() -> Column:
    return F.expr("substring(parent_asin, 2)").cast("int")


@_query
def ratings_with_segment(v: Views) -> DataFrame:
    return indexing.ratings_with_segment(_stored_ratings(v), v.partial_segments())


@_query
def known_users(v: Views) -> DataFrame:
    return indexing.known_users(v.router_users(), v.factors())


@_query
def unknown_users(v: Views) -> DataFrame:
    return indexing.unknown_users(v.router_users(), v.factors())


@_query
def segment_label(v: Views) -> DataFrame:
    numbered = v.table("customer").select("c_custkey", (F.col("c_nationkey") % 6).alias("segment"))
    return indexing.segment_label(numbered)


# Summaries


@_query
def dataset_summary(v: Views) -> DataFrame:
    return summary.dataset_summary(v.cleaned()).transform(_rounded, "sparsity", digits=6)


@_query
def rating_distribution(v: Views) -> DataFrame:
    return summary.rating_distribution(v.cleaned()).transform(_rounded, "percent")


@_query
def segment_distribution(v: Views) -> DataFrame:
    return summary.segment_distribution(v.segments()).transform(_rounded, "percent")


@_query
def segment_item_stats(v: Views) -> DataFrame:
    return summary.segment_item_stats(_stored_ratings(v), v.segments()).transform(_rounded, "avg_rating")


@_query
def segment_profile(v: Views) -> DataFrame:
    profile = summary.segment_profile(_stored_ratings(v), v.segments())
    return _rounded(profile, "avg_rating", "ratings_per_user")


@_query
def item_metrics(v: Views) -> DataFrame:
    return summary.item_metrics(v.events()).transform(_rounded, "avg_rating")


@_query
def user_activity(v: Views) -> DataFrame:
    return summary.user_activity(v.events()).transform(_rounded, "avg_rating")


@_query
def stream_kpis(v: Views) -> DataFrame:
    return summary.stream_kpis(v.events()).transform(_rounded, "avg_rating")


@_query
def rating_histogram(v: Views) -> DataFrame:
    return summary.rating_histogram(v.events())


@_query
def most_active_user(v: Views) -> DataFrame:
    return summary.most_active_user(v.events())


@_query
def event_mix(v: Views) -> DataFrame:
    return summary.event_mix(v.validated()).transform(_rounded, "percent")


# Rankings


def segment_top(v: Views, min_ratings: int = summary.MIN_RATINGS, segments: DataFrame | None = None) -> DataFrame:
    stats = summary.segment_item_stats(_stored_ratings(v), v.segments() if segments is None else segments, min_ratings)
    return ranking.segment_top_n(stats)


@_query
def segment_top_n(v: Views) -> DataFrame:
    return segment_top(v).transform(_rounded, "avg_rating")


def _window_metrics(v: Views) -> DataFrame:
    return windows.windowed_item_metrics(v.events(), ITEM_WINDOW, ITEM_SLIDE)


def _window_activity(v: Views) -> DataFrame:
    return windows.windowed_user_activity(v.events(), USER_WINDOW, USER_SLIDE)


@_query
def top_engagement(v: Views) -> DataFrame:
    return ranking.top_engagement(summary.item_metrics(v.events()), 10).transform(_rounded, "avg_rating")


def _stored_events(v: Views) -> DataFrame:
    """The clean events as a stored table, for queries that read them more than once."""
    return written(v.events(), "clean-events")


def _alerts(v: Views) -> DataFrame:
    stored = _stored_events(v)
    metrics = windows.windowed_item_metrics(stored, ITEM_WINDOW, ITEM_SLIDE)
    activity = windows.windowed_user_activity(stored, USER_WINDOW, USER_SLIDE)
    return windows.alert_feed(windows.trending_alerts(metrics), windows.spike_alerts(activity))


@_query
def latest_alerts(v: Views) -> DataFrame:
    return ranking.latest_alerts(_alerts(v), 50)


# Scalar functions


@_query
def engagement_score(v: Views) -> DataFrame:
    count, rating = F.col("event_id") % 50, F.col("value")
    return v.table("events").select("event_id", fn.engagement_score(count, rating).alias("score"))


@_query
def parse_event_json(v: Views) -> DataFrame:
    return v.messages().select(fn.parse_event_json(F.col("value")).alias("d")).select(
        "d.user_id", "d.item_id", "d.rating", "d.timestamp"
    )


@_query
def parse_event_time(v: Views) -> DataFrame:
    parsed = events.parse_events(v.messages())
    return parsed.select("timestamp", fn.parse_event_time(F.col("timestamp")).alias("event_time"))


@_query
def display_affinity(v: Views) -> DataFrame:
    balance = v.table("customer").select("c_custkey", F.col("c_acctbal").alias("score"))
    return balance.withColumn("affinity", F.round(fn.display_affinity(F.col("score") / 100), 6))


@_query
def alert_message(v: Views) -> DataFrame:
    metrics = summary.item_metrics(v.events())
    return metrics.select(
        "item_id",
        fn.trending_message(F.col("item_id"), F.col("engagement_score")).alias("trending"),
        fn.spike_message(F.col("item_id")).alias("spike"),
    )


@_query
def dot_product(v: Views) -> DataFrame:
    """Each vector with the one after it."""
    here = v.factors()
    after = here.select((F.col("id") - 1).alias("id"), F.col("features").alias("next"))
    score = F.round(fn.dot_product(F.col("features"), F.col("next")), 6)
    return here.join(after, "id").select("id", score.alias("score"))


@_query
def kafka_records(v: Views) -> DataFrame:
    return messages.to_kafka_records(events.parse_events(v.messages()))


# Events and windows


@_query
def validate_events(v: Views) -> DataFrame:
    return v.validated()


@_query
def clean_events(v: Views) -> DataFrame:
    return events.split_dead_letters(v.validated())[0]


@_query
def dead_letters(v: Views) -> DataFrame:
    return events.split_dead_letters(v.validated())[1]


@_query
def windowed_item_metrics(v: Views) -> DataFrame:
    return _window_metrics(v).transform(_rounded, "avg_rating")


@_query
def windowed_user_activity(v: Views) -> DataFrame:
    return _window_activity(v)


@_query
def trending_alerts(v: Views) -> DataFrame:
    return windows.trending_alerts(_window_metrics(v)).transform(_rounded, "avg_rating")


@_query
def spike_alerts(v: Views) -> DataFrame:
    return windows.spike_alerts(_window_activity(v))


@_query
def alert_feed(v: Views) -> DataFrame:
    return _alerts(v)


@_query
def trailing_snapshot(v: Views) -> DataFrame:
    return windows.trailing_snapshot(_stored_events(v), "3 days", "6 days")


@_query
def user_activity_timeline(v: Views) -> DataFrame:
    return windows.user_activity_timeline(_stored_events(v), ITEM_SLIDE, 3)


@_query
def throughput(v: Views) -> DataFrame:
    return windows.throughput(v.events(), "1 hour").transform(
        _rounded, "events_per_second", "percent_change", digits=6
    )


@_query
def ingest_latency(v: Views) -> DataFrame:
    return windows.ingest_latency(v.events()).transform(_rounded, "share_under_target", digits=6)


# Joins and sums along time


@_query
def asof_prior_rating(v: Views) -> DataFrame:
    """Each event with the user's latest rating before it."""
    stored = _stored_events(v)
    prior = {"prior_item": F.col("item_id"), "prior_rating": F.col("rating"), "prior_time": F.col("event_time")}
    return ordered.asof_join(
        stored, stored, ["user_id"], "event_time", "event_time", prior, ["item_id", "rating"], strict=True
    )


@_query
def asof_order(v: Views) -> DataFrame:
    """Each rating with the user's latest order at its time or up to 90 days before."""
    orders = v.table("orders").select(
        F.concat(F.lit("U"), F.col("o_custkey").cast("string")).alias("user_id"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("ordered"),
        "o_orderkey",
    )
    take = {"o_orderkey": F.col("o_orderkey"), "ordered": F.col("ordered")}
    days = F.lit(90 * 86_400_000)
    return ordered.asof_join(
        v.cleaned(), orders, ["user_id"], "timestamp", "ordered", take, ["o_orderkey"], tolerance=days
    )


@_query
def trending_alert_events(v: Views) -> DataFrame:
    """The events in the window of each trending alert."""
    stored = _stored_events(v)
    alerts = windows.trending_alerts(windows.windowed_item_metrics(stored, ITEM_WINDOW, ITEM_SLIDE))
    alerts = alerts.select("item_id", "window_start", "window_end")
    take = {name: F.col(name) for name in ("user_id", "rating", "event_time")}
    return intervals.interval_join(alerts, stored, ["item_id"], "window_start", "window_end", "event_time", take)


@_query
def spike_alert_events(v: Views) -> DataFrame:
    """The events in the window of each activity alert."""
    stored = _stored_events(v)
    alerts = windows.spike_alerts(windows.windowed_user_activity(stored, USER_WINDOW, USER_SLIDE))
    take = {name: F.col(name) for name in ("item_id", "rating", "event_time")}
    return intervals.interval_join(alerts, stored, ["user_id"], "window_start", "window_end", "event_time", take)


@_query
def alert_followups(v: Views) -> DataFrame:
    """Each activity alert with what its user did in the day after the window."""
    stored = _stored_events(v)
    alerts = windows.spike_alerts(windows.windowed_user_activity(stored, USER_WINDOW, USER_SLIDE))
    return follow.followed_by(alerts, stored, "1 day")


@_query
def decayed_activity(v: Views) -> DataFrame:
    return decay.decayed_activity(v.events(), "12 hours", VISIT_GAP).transform(_rounded, "activity", digits=6)


@_query
def user_sessions(v: Views) -> DataFrame:
    visits = sessions.user_sessions(v.events(), VISIT_GAP)
    rated = F.round(F.col("avg_rating") * F.col("n_events"), 2)
    return visits.withColumn("rating_sum", rated).drop("avg_rating")


def _event_totals() -> dict[str, Column]:
    return {"n_events": F.lit(1).cast("bigint"), "rating_sum": F.col("rating").cast("decimal(12,2)")}


@_query
def running_user_totals(v: Views) -> DataFrame:
    """Events and ratings of each user up to each of the user's event times."""
    totals = ordered.totals_by_time(v.events(), ["user_id"], "event_time", _event_totals())
    return totals.withColumn("rating_sum", F.col("rating_sum").cast("double"))


@_query
def trailing_user_totals(v: Views) -> DataFrame:
    """The same over the nine days before."""
    span = F.expr(f"INTERVAL {USER_WINDOW}")
    totals = ordered.trailing_totals(v.events(), ["user_id"], "event_time", span, _event_totals())
    return totals.withColumn("rating_sum", F.col("rating_sum").cast("double"))


# Groupings, versions, sketches, paths


def _segment_ratings(v: Views) -> DataFrame:
    return indexing.ratings_with_segment(_stored_ratings(v), v.partial_segments())


def _rating_totals() -> dict[str, tuple[str, Column]]:
    rating = F.col("rating")
    return {
        "n_ratings": ("count", F.lit(1)),
        "rating_sum": ("sum", rating.cast("decimal(12,1)")),
        "lowest": ("min", rating),
        "latest": ("max", F.col("timestamp")),
    }


def _as_double(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.col(name).cast("double"))


@_query
def rating_cube(v: Views) -> DataFrame:
    """Ratings by segment, item and stars, by any two or one of them, and in all."""
    return _as_double(lattice.cube(_segment_ratings(v), ["segment", "item_idx", "rating"], _rating_totals()), "rating_sum")


@_query
def rating_rollup(v: Views) -> DataFrame:
    """Ratings by segment and stars, by segment, and in all."""
    return _as_double(lattice.rollup(_segment_ratings(v), ["segment", "rating"], _rating_totals()), "rating_sum")


@_query
def rating_grouping_sets(v: Views) -> DataFrame:
    """Raw ratings, some without stars, by stars and by user."""
    rows = v.ratings_raw().select("user_id", F.col("rating").cast("float").alias("rating"), "timestamp")
    sets = [("user_id",), ("rating",), ()]
    return _as_double(lattice.grouping_sets(rows, ["user_id", "rating"], sets, _rating_totals()), "rating_sum")


def _versions(v: Views) -> tuple[DataFrame, DataFrame]:
    """Raw ratings of items, some without stars, as they were given up to a day and after it."""
    raw = written(v.ratings_raw(), "raw-ratings")
    rows = raw.select(F.col("parent_asin").alias("item_id"), F.col("rating").cast("int").alias("rating"), "timestamp")
    early = F.col("timestamp") < CUT_MILLIS
    return rows.filter(early).drop("timestamp"), rows.filter(~early).drop("timestamp")


@_query
def rating_change_feed(v: Views) -> DataFrame:
    return versions.change_feed(*_versions(v))


@_query
def rating_difference(v: Views) -> DataFrame:
    return versions.multiset_difference(*_versions(v))


@_query
def rating_intersection(v: Views) -> DataFrame:
    return versions.multiset_intersection(*_versions(v))


@_query
def trailing_sketches(v: Views) -> DataFrame:
    """Users, items and delay marks of each day with the two before, from stored sketches of days."""
    days = written(sketches.window_sketches(v.events(), "1 day"), "sketches")
    found = sketches.estimates(sketches.trailing_sketches(days, 3))
    return found.withColumns({name: F.round(name).cast("bigint") for name in ("n_users", "n_items")})


@_query
def item_steps(v: Views) -> DataFrame:
    return paths.item_steps(v.events())


@_query
def path_counts(v: Views) -> DataFrame:
    return paths.path_counts(paths.item_steps(v.events()))


@_query
def ratings_full_segments(v: Views) -> DataFrame:
    """Every rating and every segment, together where the user has both."""
    ratings = _stored_ratings(v).select("user_idx", "item_idx", "rating")
    segments = written(v.partial_segments().select("user_idx", "segment"), "segments")
    heavy, heavy_right = skew.heavy_keys(ratings, "user_idx"), skew.heavy_keys(segments, "user_idx")
    return skew.salted_outer_join(ratings, segments, "user_idx", heavy, heavy_right)


@_query
def reconciled_index(v: Views) -> DataFrame:
    """User numbers fitted on the ratings up to a day, carried on to the ratings after it."""
    ratings = written(v.cleaned(), "cleaned")
    early = F.col("timestamp") < CUT_MILLIS
    old = indexing.fit_dense_index(ratings.filter(early), "user_id").select("user_id", "idx")
    counts = ratings.filter(~early).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return indexing.reconciled_index(old, counts, "user_id")


# Models


def _fitted(v: Views):
    ratings = _stored_ratings(v)
    train, test = cleaning.train_test_split(ratings)
    return ratings, test, models.fit_als(train)


@_query
def fit_als(v: Views) -> DataFrame:
    _, test, model = _fitted(v)
    return models.predict(written(test, "test"), model.userFactors, model.itemFactors)


@_query
def rmse(v: Views) -> DataFrame:
    return models.rmse(v.predictions()).transform(_rounded, "rmse")


@_query
def training_summary(v: Views) -> DataFrame:
    _, test, model = _fitted(v)
    return models.training_summary(model, models.model_rmse(model, written(test, "test")))


@_query
def assign_segments(v: Views) -> DataFrame:
    model = models.fit_segments(v.factors())
    return models.assign_segments(model, v.factors())


@_query
def segment_by_history(v: Views) -> DataFrame:
    return models.segment_by_history(_stored_ratings(v), v.partial_segments())


# Recommendations


@_query
def top_k_by_factors(v: Views) -> DataFrame:
    return scoring.top_k_by_factors(v.factors(), v.factors()).transform(_rounded, "score")


@_query
def top_k_by_model(v: Views) -> DataFrame:
    ratings, _, model = _fitted(v)
    return scoring.top_k_by_model(model, ratings.select("user_idx").distinct())


@_query
def global_trending_top_k(v: Views) -> DataFrame:
    return recommend.global_trending_top_k(_window_metrics(v))


@_query
def segment_fallback(v: Views) -> DataFrame:
    return recommend.segment_fallback(v.router_users(), v.partial_segments(), segment_top(v)).transform(
        _rounded, "score"
    )


@_query
def default_fallback(v: Views) -> DataFrame:
    users = indexing.unknown_users(v.router_users(), v.partial_segments(), key="user_idx")
    return recommend.default_fallback(users, segment_top(v)).transform(_rounded, "score")


def _recommendations(v: Views) -> DataFrame:
    # Stored tables, as the batch and the stream leave them.
    best = written(segment_top(v), "segment-top")
    metrics = written(_window_metrics(v), "window-metrics")
    return recommend.recommend(
        v.router_users(), v.factors(), v.factors(), v.partial_segments(), best, metrics
    )


@_query
def recommend_users(v: Views) -> DataFrame:
    return _recommendations(v).transform(_rounded, "score")


@_query
def nest_recommendations(v: Views) -> DataFrame:
    """The nested lists, written as text so that any engine can compare them."""

    def entry(e: Column) -> Column:
        score = F.round(e["score"] * 10_000).cast("bigint")
        return F.concat_ws(":", e["rank"].cast("string"), e["item_id"].cast("string"), score.cast("string"))

    nested = recommend.nest_recommendations(_recommendations(v))
    return nested.select(
        "user_id", "path", F.concat_ws(",", F.transform("recommendations", entry)).alias("list")
    )
