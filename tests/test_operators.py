import datetime
import random

import pytest
from pyspark.sql import functions as F

from addrloom.operators import staging
from addrloom.operators.overlap import best_overlapping, day_or_first, day_or_open
from addrloom.operators.ranking import best_per_key
from addrloom.operators.skew import NO_HOT_KEYS, HotKeys, find_hot_keys, lookup_join, tasks_needed


def test_best_per_key_breaks_ties_by_the_rest(spark):
    rows = [(1, 2, "b", None), (1, 1, "z", "x"), (1, 1, "a", "x"), (1, 1, "a", None), (None, 5, "n", "n")]
    df = spark.createDataFrame(rows, "k int, rank int, name string, more string")
    got = {tuple(row) for row in best_per_key(df, ["k"], ["rank"]).collect()}
    assert got == {(1, 1, "a", None), (None, 5, "n", "n")}


def test_best_per_key_limits_groups_before_the_exchange(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id")
    plan = best_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_find_hot_keys_lists_null_apart(spark):
    df = spark.createDataFrame([(7,)] * 25 + [(None,)] * 11 + [(1,), (2,)], "k bigint")
    hot = find_hot_keys(df, rows_per_task=10)
    assert hot.groups == {7: 3} and hot.null_groups == 2
    assert not find_hot_keys(df, rows_per_task=100)
    assert not find_hot_keys(df.where("false"))
    assert find_hot_keys(df.where("k IS NULL"), rows_per_task=10).null_groups == 2


def test_find_hot_keys_counts_the_rows(spark):
    df = spark.createDataFrame([(7,)] * 25 + [(None,)] * 11 + [(1,), (2,)], "k bigint")
    assert find_hot_keys(df, rows_per_task=10).rows == find_hot_keys(df).rows == 38
    assert find_hot_keys(df.where("false")).rows == 0


@pytest.mark.parametrize("hot", [NO_HOT_KEYS, HotKeys({7: 3}, null_groups=2)])
def test_lookup_join_deals_rows_to_the_tasks_needed(spark, many_partitions, hot):
    big = spark.range(20_000).selectExpr("CASE WHEN id % 50 = 0 THEN 7 ELSE id END AS k", "id AS v")
    lookup = spark.range(0, 20_000, 3).selectExpr("id AS k", "-id AS other")
    tasks = tasks_needed(spark, 20_000, 1000)
    assert tasks == 20 and tasks_needed(spark, 20_000, 1) == 40
    assert tasks_needed(spark, 20_000, 20_000) == tasks_needed(spark, 0, 1000) == 0
    joined = lookup_join(big, lookup.hint("merge"), ["k"], hot, tasks=tasks)
    assert joined.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 2000
    assert sorted(joined.collect(), key=repr) == sorted(lookup_join(big, lookup, ["k"], NO_HOT_KEYS).collect(), key=repr)


def test_hot_keys_are_found_among_many_keys(spark):
    df = spark.range(600_000).selectExpr("CASE WHEN id % 4 = 0 THEN -1 ELSE id END AS k")
    hot = find_hot_keys(df, rows_per_task=100_000)
    assert hot.groups == {-1: 2} and hot.null_groups == 1


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_lookup_join_with_hot_keys_equals_plain_join(spark, how):
    rows = [(7, i) for i in range(40)] + [(None, i) for i in range(30)] + [(1, 0), (2, 0)]
    big = spark.createDataFrame(rows, "k bigint, v int").repartition(5)
    lookup = spark.createDataFrame([(7, "a"), (7, "b"), (1, "c"), (None, "d")], "k bigint, name string")
    hot = find_hot_keys(big.select("k"), rows_per_task=10)
    assert hot

    def rows_of(chosen):
        return sorted(map(tuple, lookup_join(big, lookup, ["k"], chosen, how).collect()), key=repr)

    assert rows_of(hot) == rows_of(NO_HOT_KEYS)


def test_hot_rows_are_spread(spark):
    big = spark.range(1000).selectExpr("7L AS k", "id % 10 AS v")
    lookup = spark.createDataFrame([(7, "a")], "k bigint, name string")
    joined = lookup_join(big, lookup.hint("merge"), ["k"], HotKeys({7: 4}))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(row["count"] for row in sizes) == 1000 and len(sizes) > 1


def _brute(names, addresses):
    far = datetime.date.max
    expected = set()
    for key, start, end in names:
        ranked = sorted(
            (
                0
                if (first is None or end >= first)
                and (last is None or (start is not None and start <= last))
                else 1,
                candidate,
            )
            for other, first, last, candidate in addresses
            if other == key
        )
        if ranked:
            expected.add((key, start or far, end, ranked[0][1]))
    return expected


@pytest.mark.parametrize("small_key", [0, 5, 64])
@pytest.mark.parametrize("hot", [NO_HOT_KEYS, HotKeys({0: 3, 2: 2})])
def test_best_overlapping_against_brute_force(spark, small_key, hot):
    rng = random.Random(7)
    origin = datetime.date(1990, 1, 1)
    edges = [datetime.date(1, 1, 1), datetime.date(9999, 12, 31)]

    def day(missing):
        if rng.random() < missing:
            return None
        return rng.choice(edges) if rng.random() < 0.1 else origin + datetime.timedelta(rng.randrange(60))

    # Ends may lie before starts, as in real records.
    addresses = [(rng.randrange(6), day(0.2), day(0.2), i) for i in range(120)]
    names = [(rng.randrange(8), day(0.2), day(0)) for _ in range(300)]
    queries = spark.createDataFrame(names, "k int, start date, end date").selectExpr(
        "k", f"{day_or_open('start')} AS from_day", f"{day_or_first('end')} AS to_day"
    )
    intervals = spark.createDataFrame(addresses, "k int, start date, end date, candidate int").selectExpr(
        "k", f"{day_or_first('start')} AS start_day", f"{day_or_open('end')} AS end_day", "candidate"
    )
    found = best_overlapping(queries, intervals, "k", hot, small_key)
    first_day, open_day = datetime.date(1, 1, 1), (1 << 22) - 1

    def number(date):
        return open_day if date is None else (date - first_day).days

    want = set()
    for key, start, end in names:
        best = [c for k, s, e, c in _brute([(key, start, end)], addresses)]
        if best:
            want.add((key, number(start), number(end), best[0]))
    rows = [tuple(row) for row in found.collect()]
    assert set(rows) == want
    # Repeated queries are answered each.
    assert len(rows) == sum(any(key == k for k, *_ in addresses) for key, *_ in names)


def test_staged_rows_live_in_the_shared_folder(spark):
    folder = spark.conf.get(staging.FOLDER_SETTING)
    df = staging.staged(spark.range(10).selectExpr("id", "id % 2 AS k"))
    assert df.count() == 10
    assert all(folder in name for name in df.inputFiles())


def test_no_cell_of_a_hot_key_is_left_whole(spark, monkeypatch):
    """One key with many spans and queries: no join group holds many of its queries."""
    from addrloom.operators import overlap

    seen = []

    def watched(big, lookup, on, hot, how="left", where="true"):
        if "start_cell" in on:
            spread = hot.counted(big, on[0], where).selectExpr("*", "pmod(xxhash64(from_day, to_day), join_groups) AS g")
            seen.append(spread.groupBy(*on, "g").count().agg(F.max("count")).first()[0])
        return lookup_join(big, lookup, on, hot, how, where)

    monkeypatch.setattr(overlap, "lookup_join", watched)
    queries = spark.range(4000).selectExpr("1L AS k", "CAST(700000 + id * 7 % 9000 AS INT) AS from_day").selectExpr("*", "from_day + 30 AS to_day")
    intervals = spark.range(200).selectExpr("1L AS k", "CAST(700000 + id * 45 AS INT) AS start_day", "CAST(700040 + id * 45 AS INT) AS end_day", "id AS candidate")
    whole = best_overlapping(queries, intervals, "k", NO_HOT_KEYS, small_key=5)
    split = best_overlapping(queries, intervals, "k", HotKeys({1: 40}, rows_per_task=100), small_key=5, spread_from=8)
    assert sorted(whole.collect()) == sorted(split.collect())
    assert seen[0] == 4000 and seen[1] <= 300


def test_a_cluster_must_name_its_folder(spark, monkeypatch):
    monkeypatch.setattr(staging, "FOLDER_SETTING", "no.such.setting")
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    with pytest.raises(RuntimeError, match="no.such.setting"):
        staging.staging_folder(spark)


def test_no_caps_on_hot_keys(spark):
    df = spark.range(30_000).selectExpr("id % 3000 AS k")
    assert len(find_hot_keys(df, rows_per_task=5).groups) == 3000


def test_a_hot_key_has_no_more_groups_than_a_shuffle_has_partitions(spark):
    df = spark.range(30_000).selectExpr("id % 3 AS k")
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert set(find_hot_keys(df, rows_per_task=5).groups.values()) == {most}


@pytest.mark.parametrize("candidate", ["int", "struct<rank: int, text: string>"])
def test_spans_within_a_better_one_are_left_out(spark, candidate):
    from addrloom.operators import overlap

    rng = random.Random(3)
    spans = {(rng.randrange(2), rng.randrange(-3, 30) + 40, rng.randrange(30) + 40): rng.randrange(6) for _ in range(400)}
    rows = [(*place, best if candidate == "int" else (best, None if best % 2 else "x")) for place, best in spans.items()]
    df = spark.createDataFrame(rows, f"k int, start_day int, end_day int, candidate {candidate}")
    left = {tuple(row) for row in overlap._undominated(df, "k").select("k", "start_day", "end_day").collect()}

    def is_within(place, other):
        return other != place and other[0] == place[0] and other[1] <= place[1] and other[2] >= place[2]

    assert left == {p for p, best in spans.items() if not any(is_within(p, o) and other <= best for o, other in spans.items())}


def test_many_spans_within_few_need_no_cells(spark, monkeypatch):
    from addrloom.operators import overlap

    monkeypatch.setattr(overlap, "_by_cells", lambda *_: pytest.fail("planned by cells"))
    queries = spark.range(50).selectExpr("1L AS k", "CAST(700 + id AS INT) AS from_day", "CAST(720 + id AS INT) AS to_day")
    intervals = spark.range(500).selectExpr("1L AS k", "CAST(id AS INT) AS start_day", "CAST(9000 - id % 7 AS INT) AS end_day", "id AS candidate")
    assert {row["candidate"] for row in best_overlapping(queries, intervals, "k", NO_HOT_KEYS).collect()} == {0}
