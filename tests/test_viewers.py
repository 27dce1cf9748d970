"""Viewers kept by day against a full recount."""

import os
import random

from playlake.operators import gold, viewers

FACT = "title_key long, episode int, user_key long, watch_date string"


def rows_of(df):
    return sorted(tuple(r) for r in df.select("title_key", "ep1_viewers", "ep2_viewers").collect())


def some_day(rng, day, n):
    return [(rng.randint(1, 5), rng.choice([1, 1, 2, 3, None]), rng.choice([None, rng.randint(1, 60), rng.randint(1, 90000), -rng.randint(1, 40000)]), day)
            for _ in range(n)]


def test_appended_days_equal_a_recount(spark, tmp):
    rng, path, all_rows = random.Random(3), os.path.join(tmp, "days"), []
    for day in ("2025-01-01", "2025-01-02", "2025-01-03"):
        rows = some_day(rng, day, 400)
        all_rows += rows
        fact = spark.createDataFrame(rows * 2, FACT)  # repeated rows
        viewers.append_days(fact, path)
        if day.endswith("1"):
            before = {f: os.path.getmtime(os.path.join(path, "watch_date=2025-01-01", f)) for f in os.listdir(os.path.join(path, "watch_date=2025-01-01"))}
        full = spark.createDataFrame(all_rows, FACT)
        for strict in (False, True):
            got = viewers.episode_viewers(viewers.stored_days(spark, path), strict_cohort=strict)
            assert rows_of(got) == rows_of(gold.episode_viewers(full, strict_cohort=strict))
    after = {f: os.path.getmtime(os.path.join(path, "watch_date=2025-01-01", f)) for f in before}
    assert before == after  # a new day leaves the others' files alone
    viewers.append_days(spark.createDataFrame([r for r in all_rows if r[3] == "2025-01-02"], FACT), path)  # a rerun
    days = viewers.stored_days(spark, path)
    assert rows_of(viewers.episode_viewers(days)) == rows_of(gold.episode_viewers(full))
    two = full.filter("watch_date >= '2025-01-02'")
    window = viewers.episode_viewers(days, since="2025-01-02", until="2025-01-03")
    assert rows_of(window) == rows_of(gold.episode_viewers(two))
    assert "PartitionFilters: [isnotnull(watch_date" in window._jdf.queryExecution().executedPlan().toString()


def test_empty_nulls_and_clashing_columns(spark, tmp):
    path = os.path.join(tmp, "days")
    assert viewers.episode_viewers(viewers.stored_days(spark, path)).count() == 0
    viewers.append_days(spark.createDataFrame([], FACT), path)
    rows = [(1, 1, None, "2025-01-01", 7, "x"), (None, 2, 4, None, 8, "y"), (1, 2, 0, "2025-01-01", 9, None)]
    viewers.append_days(spark.createDataFrame(rows, FACT + ", bucket int, viewers string"), path)
    got = viewers.episode_viewers(viewers.stored_days(spark, path))
    assert sorted(map(tuple, got.collect()), key=str) == [(1, 0, 1), (None, 0, 1)]
