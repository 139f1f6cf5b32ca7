from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from murmur.functions.times import utc_literal
from murmur.operators import checks, retention
from murmur.plans import daily_report, intermediate, marts, registry, serving, staging
from murmur.schemas import raw_schema
from murmur.settings import Settings
from murmur.sources.ledger import Layout, Ledger
from murmur.sources.tables import CommitRefused

SETTINGS = Settings(salt="s")
DAY = "2024-01-15"
AT = datetime(2024, 1, 15, 10, 30)
NOON = datetime(2024, 1, 16, 12, 0)


def lineage(deleted=False, at=AT):
    return (1, "d" if deleted else "c", at, deleted)


def raw_tables(spark, posts=(), likes=(), reposts=(), follows=(), blocks=(), users=()):
    def table(entity, rows):
        return spark.createDataFrame([(*r, *lineage()) if len(r) == width(entity) else r for r in rows],
                                     raw_schema(entity))

    def width(entity):
        return len(raw_schema(entity)) - 4

    given = dict(posts=posts, likes=likes, reposts=reposts, follows=follows, blocks=blocks, users=users,
                 profile_updates=())
    return {entity: table(entity, rows) for entity, rows in given.items()}


def post(user, key, at=AT, language="en", tags=()):
    return (user, key, at, language, 5, list(tags), False, False, False)


def like(user, key, target="a", target_key="p1", at=AT):
    return (user, key, at, target, target_key)


@pytest.fixture(scope="module")
def raw(spark):
    return raw_tables(
        spark,
        posts=[post("a", "p1", tags=["A", "a", "B"]), post("a", "p2", NOON, "de"),
               post("a", "p3", language=""), post("b", "p1", tags=[""]),
               (*post("b", "gone"), *lineage(True))],
        likes=[like("b", "l1"), like("a", "l2"), like("c", "l3", None, None),
               like("c", "l4", "a", "missing"), (*like("c", "l5"), *lineage(True))],
        reposts=[like("c", "x1", "b", "p1")],
        follows=[("c", "f1", AT, "a"), ("c", "f2", NOON, "b")],
        blocks=[("c", "b1", AT, "a")],
        users=[("a", AT, NOON), ("b", AT, AT), ("c", AT, AT), ("d", AT, AT)],
    )


@pytest.fixture(scope="module")
def staged(raw):
    return staging.stage_all(raw)


def test_staging_hides_deleted_rows(staged):
    rows = staged["posts"].orderBy("post_id").collect()
    assert [r.post_id for r in rows] == ["a::p1", "a::p2", "a::p3", "b::p1"]
    assert rows[0].occurred_date == date(2024, 1, 15)


def test_daily_activity(staged):
    rows = {(r.user_id_hash, str(r.activity_date)): r for r in
            intermediate.user_daily_activity(staged).collect()}
    assert set(rows) == {("a", DAY), ("a", "2024-01-16"), ("b", DAY), ("c", DAY), ("c", "2024-01-16")}
    assert (rows["a", DAY].post_count, rows["a", DAY].like_count) == (2, 1)
    assert rows["c", DAY].total_activity_count == 5


def test_main_language_ties_go_to_the_smallest(staged):
    rows = {r.user_id_hash: r.language for r in intermediate.main_language(staged["posts"]).collect()}
    assert rows == {"a": "", "b": "en"}


def test_summary_and_segments(staged):
    settings = Settings(salt="s", creator_min_posts=3, engager_min_actions=4)
    rows = {r.user_id_hash: r for r in intermediate.user_activity_summary(staged, settings).collect()}
    assert {u: r.segment for u, r in rows.items()} == {
        "a": "creator", "b": "lurker", "c": "engager", "d": "lurker"}
    assert rows["a"].main_language == "" and rows["c"].main_language is None
    assert (rows["c"].total_likes, rows["c"].total_blocks, rows["d"].total_posts) == (2, 1, 0)
    assert rows["a"].last_seen_at == NOON


def test_engagement(staged):
    rows = {r.post_id: (r.like_count, r.repost_count, r.engagement_count) for r in
            marts.mart_engagement(staged["posts"], staged["likes"], staged["reposts"]).collect()}
    assert rows == {"a::p1": (2, 0, 2), "a::p2": (0, 0, 0), "a::p3": (0, 0, 0), "b::p1": (0, 1, 1)}


def test_trending_counts_both_spellings(staged):
    rows = {r.hashtag: (r.usage_count, r.hour_bucket) for r in
            marts.mart_trending_hashtags(staged["posts"]).collect()}
    assert rows == {"a": (2, datetime(2024, 1, 15, 10)), "b": (1, datetime(2024, 1, 15, 10))}
    assert {r.hashtag for r in marts.dim_hashtag(staged["posts"]).collect()} == {"a", "b"}
    assert {r.language for r in marts.dim_language(staged["posts"]).collect()} == {"", "en", "de"}


def summary(spark, *rows):
    return spark.createDataFrame(
        [(u, AT, last, f, n) for u, last, f, n in rows],
        "user_id_hash string, first_seen_at timestamp_ntz, last_seen_at timestamp_ntz,"
        " total_follows long, total_likes long",
    )


def test_anomalies_compare_unrounded_rates(spark):
    hour = datetime(2024, 1, 15, 11, 30)
    rows = {r.user_id_hash: r for r in marts.mart_anomalous_accounts(summary(
        spark, ("limit", hour, 30, 60), ("follows", hour, 31, 0), ("likes", hour, 0, 61),
        ("both", AT, 1, 2), ("back", datetime(2024, 1, 15, 9), 0, 0)), SETTINGS).collect()}
    assert (rows["limit"].reason, rows["limit"].anomaly_score, rows["limit"].is_anomalous) == (None, 0, False)
    assert rows["follows"].reason == "high follow rate"
    assert rows["likes"].reason == "high like rate"
    assert (rows["both"].reason, rows["both"].anomaly_score) == ("high follow rate, high like rate", 2)
    assert (rows["both"].follows_per_hour, rows["both"].account_age_hours) == (60.0, 0.02)
    assert rows["back"].account_age_hours == 0.02


def test_calendar(spark):
    days = marts.dim_date(spark)
    assert days.count() == 2557
    row = days.filter("date_day = date'2024-01-15'").first()
    assert (row.day_of_week, row.day_name, row.month_name) == (1, "Monday", "January")


def test_incremental_interactions(spark, staged):
    everything = marts.fct_interactions(staged)
    assert everything.filter("interaction_type = 'follow'").count() == 2
    target = everything.filter(F.col("occurred_at") < utc_literal("2024-01-16 00:00:00"))
    moved = staging.stage_all(raw_tables(
        spark,
        likes=[like("b", "l1", "z", "p9"), like("n", "late", at=datetime(2024, 1, 15, 8, 29)),
               like("n", "inside", at=datetime(2024, 1, 15, 8, 31))],
        follows=[("c", "f2", NOON, "b")]))
    merged = marts.incremental_interactions(target, marts.fct_interactions(moved), SETTINGS)
    keys = {(r.user_id_hash, r.record_key): r.target_user_id_hash for r in merged.collect()}
    assert keys["b", "l1"] == "z"
    assert ("n", "inside") in keys and ("n", "late") not in keys
    assert ("c", "b1") in keys, "rows deleted upstream stay"
    assert ("c", "f2") in keys and merged.count() == len(keys)
    empty = marts.incremental_interactions(everything.limit(0), everything, SETTINGS)
    assert empty.count() == everything.count()


def test_daily_summary_has_a_zero_row(staged):
    daily = intermediate.user_daily_activity(staged)
    row = marts.daily_summary(daily, DAY).first()
    assert (row.total_posts, row.total_likes, row.active_users) == (3, 4, 3)
    row = marts.daily_summary(daily, "2023-01-01").first()
    assert (row.total_posts, row.active_users) == (0, 0)


def test_retention(spark):
    table = spark.createDataFrame([(AT,), (NOON,), (None,)], "occurred_at timestamp_ntz")
    as_of = utc_literal("2024-01-22 10:30:00")
    assert retention.keep_recent(table, "occurred_at", as_of, 7).count() == 3
    later = utc_literal("2024-01-22 10:30:01")
    assert retention.keep_recent(table, "occurred_at", later, 7).count() == 2
    [row] = retention.retention_counts({"t": (table, "occurred_at")}, later, 7).collect()
    assert (row.kept_rows, row.deleted_rows) == (2, 1)


def test_checks(spark):
    table = spark.createDataFrame([("x", 1), ("x", None), (None, 2)], "k string, n long")
    results = checks.report([
        checks.unique("t", table, "k"), checks.not_null("t", table, "k"),
        checks.not_null("t", table, "n"), checks.accepted("t", table, "k", ("x",)),
        checks.relationship("t", table, "n", spark.range(2), "id"),
    ])
    assert {r.check_name: (r.violations, r.status) for r in results.collect()} == {
        "unique_t_k": (1, "fail"), "not_null_t_k": (1, "fail"), "not_null_t_n": (1, "fail"),
        "accepted_values_t_k": (0, "pass"), "relationships_t_n": (1, "warn"),
    }
    with pytest.raises(checks.QualityFailure, match="not_null_t_k=1"):
        checks.enforce(results)
    assert len(checks.enforce(results.filter("status <> 'fail'"))) == 1


def test_partition_gate_counts_nulls_as_duplicates(spark):
    day = date(2024, 1, 15)
    daily = spark.createDataFrame([("a", day), (None, day), ("a", day)], "user_id_hash string, activity_date date")
    row = checks.partition_gate(daily, DAY, 1).first()
    assert (row.row_count, row.null_keys, row.duplicate_keys, row.passed) == (3, 1, 2, False)
    assert checks.partition_gate(daily.limit(0), DAY, 0).first().passed
    assert not checks.partition_gate(daily.limit(0), DAY, 1).first().passed


def test_daily_run_publishes_once_and_replaces(spark, raw, store):
    for _ in range(2):
        daily_report.run_daily(spark, store, raw, DAY, "2024-01-17 00:00:00", SETTINGS)
    daily_report.run_daily(spark, store, raw, "2024-01-16", "2024-01-17 00:00:00", SETTINGS)
    published = spark.read.parquet(store.location("mart_daily_summary")).collect()
    assert {str(r.report_date): r.total_posts for r in published} == {DAY: 3, "2024-01-16": 1}
    assert len(published) == 2
    assert daily_report.read_run_log(store).filter("status = 'success'").count() == 18
    segments = serving.segment_distribution(daily_report.read(store, "dim_user")).collect()
    assert {r.segment: r.users for r in segments} == {"engager": 1, "lurker": 3}
    assert len(daily_report.ledger(store).numbers()) == 2, "older commits are gone"
    book = daily_report.ledger(store)
    emptied = registry.reset(book, registry.DAILY)
    assert set(emptied) == {"snapshots.dim_user_snapshot", *(f"marts.{m}" for m in registry.MODELS)}
    assert daily_report.read(store, "fct_posts").count() == 0
    assert daily_report.read(store, "dim_user").columns == daily_report.read(store, "dim_user_snapshot").drop("scd_id").columns + ["is_current"]
    assert daily_report.read(store, "dim_date").count() == 2557
    assert registry.reset(book, registry.DAILY) == [], "a reset can run again"


def test_registry_derives_reset_and_retention():
    tables = {t.name: t for t in registry.all_tables()}
    assert len(tables) == 33 and sum(t.reset for t in tables.values()) == 30
    assert {n for n, t in tables.items() if not t.reset} == {
        "marts.dim_date", "marts.mart_daily_summary", "marts.pipeline_runs"}
    aged = {t.name for t in registry.retained_tables(registry.CHANGES)}
    assert len(aged) == 12 and "raw.users" not in aged
    assert len(registry.retained_tables(registry.FEED)) == 6
    assert registry.retained_tables(registry.DAILY) == []


def runs(store, table):
    return dict(daily_report.ledger(store).snapshot().parts(table))


def test_history_appends_closed_versions_and_replaces_the_open_part(spark, raw, store):
    def run(tables, at):
        daily_report.run_models(spark, store, tables, at, SETTINGS)

    def with_posts(user, n):
        more = raw_tables(spark, posts=[post(user, f"n{i}") for i in range(n)])["posts"]
        return {**raw, "posts": raw["posts"].unionByName(more)}

    run(raw, "2024-01-17 00:00:00")
    first = runs(store, "dim_user_snapshot")
    assert set(first) == {(None,)}
    run(with_posts("b", 5), "2024-01-18 00:00:00")
    second = runs(store, "dim_user_snapshot")
    assert set(second) == {(None,), ("2024-01",)} and second[None,] != first[None,]
    run(with_posts("d", 5), "2024-02-02 00:00:00")
    third = runs(store, "dim_user_snapshot")
    assert third["2024-01",] == second["2024-01",], "closed months are not written again"
    assert set(third) == {(None,), ("2024-01",), ("2024-02",)}
    whole = daily_report.read(store, "dim_user_snapshot")
    versions = sorted((r.user_id_hash, r.segment, r.valid_to is None) for r in whole.collect())
    assert versions == sorted([
        ("a", "lurker", True), ("c", "engager", True), ("b", "lurker", False), ("b", "creator", False),
        ("b", "lurker", True), ("d", "lurker", False), ("d", "creator", True)])
    users = daily_report.read(store, "dim_user")
    assert users.count() == 7 and users.filter("is_current").count() == 4


def test_of_two_overlapping_runs_one_is_refused(spark, raw, store, monkeypatch):
    """A run that ends while another is at work leaves history with one writer's rows."""
    inner = daily_report.snapshot_changes

    def slow(book, base, current, run_at):
        if run_at == "2024-01-17 00:00:00":
            with monkeypatch.context() as patch:
                patch.setattr(daily_report, "snapshot_changes", inner)
                daily_report.run_models(spark, store, raw, "2024-01-17 00:00:03", SETTINGS)
        return inner(book, base, current, run_at)

    monkeypatch.setattr(daily_report, "snapshot_changes", slow)
    with pytest.raises(CommitRefused):
        daily_report.run_models(spark, store, raw, "2024-01-17 00:00:00", SETTINGS)
    monkeypatch.undo()
    history = daily_report.read(store, "dim_user_snapshot")
    assert checks.users_with_many_current_rows(daily_report.read(store, "dim_user")).count() == 0
    assert {str(r.valid_from) for r in history.collect()} == {"2024-01-17 00:00:03"}


def test_interactions_are_replaced_by_touched_days(spark, store, staged):
    book = daily_report.ledger(store)

    def run(rows):
        base = book.snapshot()
        book.commit(base, {"fct_interactions": daily_report.interaction_changes(book, base, rows, SETTINGS)})
        return runs(store, "fct_interactions")

    old = [like("o", f"k{i}", at=datetime(2024, 1, day, 9)) for i, day in enumerate(range(1, 9))]
    everything = marts.fct_interactions(staged)
    before = run(everything.unionByName(marts.fct_interactions(staging.stage_all(raw_tables(spark, likes=old)))))
    assert len(before) == 10
    moved = staging.stage_all(raw_tables(
        spark, likes=[like("o", "k3", "z", "p9", datetime(2024, 1, 16, 11)),
                      like("n", "new", at=datetime(2024, 1, 17, 1))]))
    after = run(marts.fct_interactions(moved))
    changed = {p[0] for p in set(before) | set(after) if before.get(p) != after.get(p)}
    assert changed == {"2024-01-04", "2024-01-16", "2024-01-17"}
    rows = daily_report.read(store, "fct_interactions")
    assert rows.filter("record_key = 'k3'").first().target_user_id_hash == "z"
    assert rows.count() == everything.count() + 8 + 1
    plan = rows.filter("user_id_hash = 'n'")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_run_stops_where_the_stream_has_not_caught_up(spark, raw, store):
    asked = []
    impatient = Settings(salt="s", catch_up_limit_seconds=0)
    with pytest.raises(checks.QualityFailure, match="caught up"):
        daily_report.run_daily(
            spark, store, raw, DAY, "2024-01-17 00:00:00", impatient,
            caught_up=lambda: asked.append(1) or False)
    log = {r.task: r.status for r in daily_report.read_run_log(store).collect()}
    assert log == {"load_raw_partition": "failed"} and asked == [1]
    pauses = []
    answers = iter([False, False, True])
    daily_report.wait_until(lambda: next(answers), SETTINGS, pauses.append)
    assert pauses == [5, 5]
    with pytest.raises(checks.QualityFailure):
        daily_report.wait_until(lambda: False, SETTINGS, pauses.append)
    assert len(pauses) == 2 + 60


RULES = {"t": Layout(("day",))}


def test_retention_drops_parts_and_leaves_kept_files_alone(spark, store):
    book = Ledger(store, RULES)
    rows = spark.createDataFrame(
        [(i, datetime(2024, 1, 1 + i, 12)) for i in range(10)] + [(99, None)], "n int, at timestamp_ntz")
    base = book.snapshot()
    book.commit(base, {"t": book.replace_all(base, "t", rows.withColumn("day", F.to_date("at")))})
    before = book.snapshot()
    held = retention.Retained("x.t", "t", lambda part: True, F.col("at"), "at")

    def kept(snapshot):
        return sorted(r.n for r in book.read(snapshot, "t").collect())

    after, deleted = retention.apply_retention(book, [held], "2024-01-11 00:00:00", 7)
    assert kept(after) == [3, 4, 5, 6, 7, 8, 9, 99]
    assert [(r.table_name, r.deleted_rows) for r in deleted.collect()] == [("x.t", 3)]
    assert all(before.parts("t")[part] == run for part, run in after.parts("t").items())
    # A limit within a day rewrites that day only, and only if it holds older rows.
    half, deleted = retention.apply_retention(book, [held], "2024-01-11 18:00:00", 7)
    assert kept(half) == [4, 5, 6, 7, 8, 9, 99] and deleted.first().deleted_rows == 1
    early, _ = retention.apply_retention(book, [held], "2024-01-12 06:00:00", 7)
    assert dict(early.parts("t")) == {p: r for p, r in after.parts("t").items() if p != ("2024-01-04",)}
    assert kept(before) == list(range(10)) + [99], "readers of the commit before still see it"
    assert book.vacuum(keep=1) > 0 and kept(book.snapshot()) == [4, 5, 6, 7, 8, 9, 99]


def test_ledger_prunes_folders_and_keeps_schemas(spark, store):
    book = Ledger(store, RULES)
    with pytest.raises(FileNotFoundError):
        book.read(book.snapshot(), "t")
    rows = spark.range(6).withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")))
    base = book.snapshot()
    book.commit(base, {"t": book.replace_all(base, "t", rows)})
    found = Ledger(store, RULES)
    table = found.read(found.snapshot(), "t")
    assert table.schema["day"].dataType.simpleString() == "date"
    plan = table.filter("day = date'2024-01-03'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert table.filter("day = date'2024-01-03'").count() == 1
    found.commit(found.snapshot(), {"t": {part: () for part in found.snapshot().parts("t")}})
    assert found.read(found.snapshot(), "t").count() == 0
    assert found.read(found.snapshot(), "t").columns == ["id", "day"]


def test_failed_gate_publishes_nothing(spark, raw, store):
    with pytest.raises(checks.QualityFailure):
        daily_report.run_daily(
            spark, store, raw, DAY, "2024-01-17 00:00:00", SETTINGS, min_rows=1000)
    assert not store.path_exists(store.location("mart_daily_summary"))
    log = {r.task: r.status for r in daily_report.read_run_log(store).collect()}
    assert log["check_partition_quality"] == "failed"


def test_source_rows_missing_in_raw_fail_the_run(spark, raw, store):
    source = spark.createDataFrame([("posts", 5)], "entity string, row_count long")
    with pytest.raises(checks.QualityFailure, match="raw has none"):
        daily_report.run_daily(
            spark, store, raw, "2023-05-05", "2024-01-17 00:00:00", SETTINGS, source_counts=source)


def test_table_store_versions(spark, store):
    with pytest.raises(FileNotFoundError):
        store.read("t")
    store.write("t", spark.range(3))
    held = store.read("t")
    store.write("t", held.union(held))
    assert (held.count(), store.read("t").count(), store.read("t", version=0).count()) == (3, 6, 3)


def test_of_two_writers_of_one_version_one_is_refused(spark, store):
    store.write("t", spark.range(3))
    store.claim("t", 1)
    with pytest.raises(CommitRefused):
        store.claim("t", 1)
    assert store.write("t", spark.range(4)) == 2, "a claim that broke off is skipped"
    assert store.read("t").count() == 4
