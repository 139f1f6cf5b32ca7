from pyspark.sql import functions as F

from murmur.functions.times import utc_literal
from murmur.operators import checks, history
from murmur.plans import marts

T1, T2, T3 = "2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"


def current(spark, *rows):
    return spark.createDataFrame(
        list(rows),
        "user_id_hash string, total_posts long, main_language string, segment string",
    )


def shown(table):
    return sorted(
        (r.user_id_hash, r.total_posts, r.main_language, r.segment, str(r.valid_from),
         str(r.valid_to) if r.valid_to else None)
        for r in table.collect()
    )


def test_three_runs(spark):
    one = history.first_snapshot(
        current(spark, ("a", 1, None, "lurker"), ("b", 9, "en", "creator")), utc_literal(T1)
    )
    two = history.snapshot(
        one,
        current(spark, ("a", 2, None, "lurker"), ("b", 10, "de", "creator"), ("c", 0, None, "lurker")),
        utc_literal(T2),
    )
    three = history.snapshot(two, current(spark, ("a", 7, "en", "creator")), utc_literal(T3))
    assert shown(three) == [
        ("a", 1, None, "lurker", T1, T3),
        ("a", 7, "en", "creator", T3, None),
        ("b", 9, "en", "creator", T1, T2),
        ("b", 10, "de", "creator", T2, None),
        ("c", 0, None, "lurker", T2, None),
    ]
    assert three.select("scd_id").distinct().count() == 5
    assert checks.users_with_many_current_rows(marts.dim_user(three)).count() == 0


def test_rerun_changes_nothing(spark):
    rows = current(spark, ("a", 1, None, "lurker"))
    one = history.first_snapshot(rows, utc_literal(T1))
    assert shown(history.snapshot(one, rows, utc_literal(T2))) == shown(one)


def test_repair_of_overlapping_runs(spark):
    rows = current(spark, ("a", 1, None, "lurker"), ("b", 2, "en", "creator"))
    one = history.first_snapshot(rows, utc_literal(T1))
    late = history.first_snapshot(rows.filter("user_id_hash = 'a'"), utc_literal(T2))
    damaged = one.unionByName(one).unionByName(late).unionByName(late)
    repaired = history.repair_history(damaged)
    assert shown(repaired) == [
        ("a", 1, None, "lurker", T1, T2),
        ("a", 1, None, "lurker", T2, None),
        ("b", 2, "en", "creator", T1, None),
    ]
    assert checks.users_with_many_current_rows(marts.dim_user(damaged)).count() > 0
    assert repaired.filter(F.col("valid_to").isNull()).count() == 2
