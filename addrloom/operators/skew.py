"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# A key with more rows than one task should hold is split into groups of about this size.
ROWS_PER_TASK = 2_000_000


@dataclass(frozen=True)
class HotKeys:
    """How many groups each crowded value of a key column is split into.

    There are at most rows / rows_per_task of them. It only steers where rows go; a missing
    or needless entry changes no result. ``rows`` is how many rows were counted, 0 if none were.
    """

    groups: dict = field(default_factory=dict)
    null_groups: int = 1
    rows_per_task: int = ROWS_PER_TASK
    rows: int = 0

    def __bool__(self) -> bool:
        return bool(self.groups) or self.null_groups > 1

    def counted(self, df: DataFrame, key: str, where: str) -> DataFrame:
        """``df`` with the number of groups of its key in ``join_groups``, 1 where not ``where``."""
        kind = df.schema[key].dataType.simpleString()
        table = df.sparkSession.createDataFrame(list(self.groups.items()), f"hot_key {kind}, hot_groups int")
        # Small by its bound: some bytes for as many rows as fill a task.
        met = df.join(F.broadcast(table), F.col(key) == F.col("hot_key"), "left")
        groups = f"CASE WHEN NOT ({where}) THEN 1 WHEN {key} IS NULL THEN {self.null_groups} ELSE coalesce(hot_groups, 1) END"
        return met.selectExpr(*[f"`{name}`" for name in df.columns], f"{groups} AS join_groups")


NO_HOT_KEYS = HotKeys()


def find_hot_keys(keys: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> HotKeys:
    """All values of a one-column DataFrame that are too frequent for one task.

    Runs one job now: an exact count per value, summed in the map tasks first, so that
    a crowded value is a row per task. More groups than a shuffle has partitions would spread
    a value no further, and each repeats the rows that it is joined to; so there are no more.
    """
    (key,) = keys.columns
    most = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    crowded = F.when(F.col("count") > rows_per_task, F.struct(F.col(key), F.col("count")))
    found = keys.groupBy(key).count().agg(F.sum("count").alias("rows"), F.collect_list(crowded).alias("crowded")).first()
    groups = {row[0]: min(-(-row[1] // rows_per_task), most) for row in found["crowded"]}
    return HotKeys(groups, groups.pop(None, 1), rows_per_task, found["rows"] or 0)


def tasks_needed(spark: SparkSession, rows: int, rows_per_task: int) -> int:
    """How many tasks an exchange of so many rows has to feed; 0 where Spark may choose.

    Spark joins small partitions until they hold so many compressed bytes, which may be a great many
    repetitive rows. It leaves one for each core, so only more tasks than that are asked for. They
    are no more than a shuffle has partitions: set these by the size of the tables.
    """
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = -(-rows // rows_per_task)
    return min(tasks, partitions) if tasks > min(spark.sparkContext.defaultParallelism, partitions) else 0


def lookup_join(
    big: DataFrame,
    lookup: DataFrame,
    on: list[str],
    hot: HotKeys,
    how: str = "left",
    where: str = "true",
    tasks: int = 0,
) -> DataFrame:
    """Join ``big`` to ``lookup``; rows of hot values of ``on[0]`` are spread over groups.

    Without hot keys this is a plain join and its partitioning can be reused. With
    them, each hot row picks one group from its own content and map partition (the
    same again if the task is retried, while copies in other partitions pick others)
    and the lookup rows of that key are repeated once per group. They should be few
    per key; ``where``, a condition on the join columns, limits the spreading to such.
    With ``tasks`` the rows are dealt to at least as many tasks, else Spark chooses.
    """

    def dealt(df: DataFrame, keys: list[str]) -> DataFrame:
        return df.repartition(tasks, *keys) if tasks else df

    if not hot:
        return dealt(big, on).join(lookup, on, how)
    spread = f"pmod(xxhash64({', '.join(big.columns)}, spark_partition_id()), join_groups)"
    group = f"CASE WHEN join_groups > 1 THEN CAST({spread} AS INT) ELSE 0 END AS join_group"
    grouped = hot.counted(big, on[0], where).selectExpr("*", group).drop("join_groups")
    known = hot.counted(lookup.where(f"{on[0]} IS NOT NULL"), on[0], where)
    repeated = known.selectExpr("*", "explode(sequence(0, join_groups - 1)) AS join_group").drop("join_groups")
    return dealt(grouped, [*on, "join_group"]).join(repeated, [*on, "join_group"], how).drop("join_group")
