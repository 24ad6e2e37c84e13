"""Best interval that overlaps a queried one, without pairing everything per key.

An interval ``[start, end]`` overlaps a query ``[from, to]`` when ``start <= to`` and
``end >= from``. A key with few spans has them as one array, which a query looks up with its
key and searches on its own row; so queries meet one row each, whatever their number.

For a key with many spans the two comparisons, a point under a corner in a plane, are said
with equalities. For non-negative whole numbers ``p < m`` holds exactly when, at one and only
one bit position ``k``, bit ``k`` of ``m`` is set and ``p >> k`` is ``(m >> k) - 1``. So a number
is replaced by the few cells it lies in, a limit by the few cells it covers, and the
comparison is an equi-join on cells that meets once at most. Cells keep only their best
interval, so the join is a lookup: the cost per row is fixed by the calendar and not by the
other rows of its key.

Before that, a key with many spans is rid of those that cannot be an answer: where one span
lies within another that has no worse candidate, every query it overlaps has the other one.
What remains mostly fits an array again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from addrloom.operators.skew import NO_HOT_KEYS, HotKeys, find_hot_keys, lookup_join
from addrloom.operators.staging import staged

# Years 1 to 9999 fit in 22 bits of days; the last day number stands for "open".
_BITS = 22
_OPEN = (1 << _BITS) - 1
_FIRST_DAY = -719162

# Keys with more spans than this go by cells; the others have an array of at most so many.
SMALL_KEY = 64

# Cells that can meet more than 2^20 distinct queries of a key are split like the key.
SPREAD_FROM = 20


def day_or_first(date: str) -> str:
    """Day number of an interval's start; NULL has always begun."""
    return f"coalesce(unix_date({date}) - ({_FIRST_DAY}), 0)"


def day_or_open(date: str) -> str:
    """Day number of an interval's end, NULL being open; or of a query's start.

    A query without a start so meets open-ended intervals only.
    """
    return f"coalesce(unix_date({date}) - ({_FIRST_DAY}), {_OPEN})"


def _cells(number: str, parity: int, cell: str) -> str:
    """One cell per level at which the shifted number has the parity."""
    levels = f"filter(sequence(0, {_BITS}), k -> shiftright({number}, k) % 2 = {parity})"
    return f"transform({levels}, k -> shiftleft(k, {_BITS + 1}) | ({cell}))"


def _cells_of(number: str) -> str:
    """Cells a point lies in. Odd ones are never covered by a limit."""
    return _cells(number, 0, f"shiftright({number}, k)")


def _cells_below(limit: str) -> str:
    """Cells that together hold exactly the numbers below the limit."""
    return _cells(limit, 1, f"shiftright({limit}, k) - 1")


def _with_numbers(spans: DataFrame, key: str, hot: HotKeys) -> DataFrame:
    """Spans with how many their key has. A key that is not hot is counted where its spans are."""
    if not hot:
        return spans.withColumn("spans", F.count("*").over(Window.partitionBy(key)))
    return lookup_join(spans, spans.groupBy(key).agg(F.count("*").alias("spans")), [key], hot, "inner")


def _undominated(spans: DataFrame, key: str) -> DataFrame:
    """Spans without those that lie within another one of their key with no worse candidate.

    First among spans with the same start, then among those with the same end; what is left
    is compared by cells of the start: a span asks for the best one that has begun and that
    ends no earlier, and stays if that is itself. The first two groups hold at most a row per day.
    """
    before = (Window.unboundedPreceding, -1)
    for same, order in (("start_day", F.desc("end_day")), ("end_day", F.asc("start_day"))):
        wider = F.min("candidate").over(Window.partitionBy(key, same).orderBy(order).rowsBetween(*before))
        spans = spans.withColumn("wider", wider).where("wider IS NULL OR candidate < wider").drop("wider")
    # Of equal candidates the wider span comes first, so that of several one stays.
    ranked = spans.selectExpr("*", "struct(candidate, start_day, -end_day AS width) AS rank")
    lies = f"transform({_cells_of('start_day')}, c -> struct(c AS cell, false AS asks))"
    covers = f"transform({_cells_below('(start_day + 1)')}, c -> struct(c AS cell, true AS asks))"
    met = ranked.selectExpr("*", f"inline(concat({lies}, {covers}))")
    so_far = Window.partitionBy(key, "cell").orderBy(F.desc("end_day"), "asks").rowsBetween(Window.unboundedPreceding, 0)
    best = met.withColumn("best", F.min(F.expr("CASE WHEN NOT asks THEN rank END")).over(so_far)).where("asks")
    grouped = best.groupBy(key, "start_day", "end_day").agg(F.min("best").alias("best"), F.first("candidate").alias("candidate"))
    return grouped.where("best.start_day = start_day AND best.width = -end_day").drop("best")


def best_overlapping(
    queries: DataFrame,
    intervals: DataFrame,
    key: str,
    hot: HotKeys,
    small_key: int = SMALL_KEY,
    spread_from: int = SPREAD_FROM,
) -> DataFrame:
    """Each row of ``queries`` with the smallest ``candidate`` of its key, overlapping ones first.

    ``queries`` holds the key, ``from_day``, ``to_day`` and columns that go along; ``intervals``
    the key, ``start_day``, ``end_day`` and an orderable ``candidate``. If none overlaps, the
    best of the key is taken; rows whose key has no interval are left out. ``small_key`` and
    ``spread_from`` steer the work and not the result: keys of at most so many spans are
    searched as arrays, and cells of more than so many levels (about 2 to that power of
    queries) are spread for hot keys. Spans and answered rows are written once, as both
    ways read them; where no key has many spans left the second way is not planned.
    """
    best = F.min("candidate").alias("candidate")
    spans = staged(_with_numbers(intervals.groupBy(key, "start_day", "end_day").agg(best), key, hot))
    is_small = f"spans <= {small_key}"
    if not spans.where(f"NOT ({is_small})").isEmpty():
        left = _undominated(spans.where(f"NOT ({is_small})").drop("spans"), key)
        columns = [key, "start_day", "end_day", "candidate", "spans"]
        spans = spans.where(is_small).select(columns).unionByName(staged(_with_numbers(left, key, hot)).select(columns))
    # At most ``small_key`` structs of a key are collected; null ones are not.
    few = F.collect_list(F.expr(f"CASE WHEN {is_small} THEN struct(start_day, end_day, candidate) END"))
    directory = spans.groupBy(key).agg(F.first("spans").alias("spans"), F.min("candidate").alias("any_candidate"), few.alias("few"))
    overlapping = "filter(few, s -> s.start_day <= to_day AND s.end_day >= from_day)"
    found = f"coalesce(array_min(transform({overlapping}, s -> s.candidate)), any_candidate) AS candidate"
    met = lookup_join(queries, directory, [key], hot, "inner")
    if spans.where(f"NOT ({is_small})").isEmpty():
        return met.selectExpr(*queries.columns, found)
    answered = staged(met.selectExpr(*queries.columns, "spans", "any_candidate", found))
    small = answered.where(is_small).select(*queries.columns, "candidate")
    many = answered.where(f"NOT ({is_small})").drop("candidate", "spans")
    return small.unionByName(_by_cells(many, spans.where(f"NOT ({is_small})"), key, hot, spread_from))


def _by_cells(queries: DataFrame, spans: DataFrame, key: str, hot: HotKeys, spread_from: int) -> DataFrame:
    """``best_overlapping`` for keys with many spans; queries have their key's ``any_candidate``."""
    asking = [key, "from_day", "to_day"]
    cells = (
        spans.selectExpr("*", f"explode({_cells_of('start_day')}) AS start_cell")
        .selectExpr("*", f"explode({_cells_of(f'({_OPEN} - end_day)')}) AS end_cell")
        .groupBy(key, "start_cell", "end_cell")
        .agg(F.min("candidate").alias("candidate"))
    )
    asked = (
        queries.select(*asking).distinct()
        .selectExpr("*", f"explode({_cells_below('(to_day + 1)')}) AS start_cell")
        .selectExpr("*", f"explode({_cells_below(f'({_OPEN + 1} - from_day)')}) AS end_cell")
    )
    # Queries are distinct, so a cell of levels a and b meets at most 2^(a + b) of them. Where
    # that may be many, a hot key's queries are spread; there are few such cells, so that they
    # can be repeated per group.
    levels = f"shiftright(start_cell, {_BITS + 1}) + shiftright(end_cell, {_BITS + 1})"
    met = lookup_join(asked, cells, [key, "start_cell", "end_cell"], hot, "inner", where=f"{levels} > {spread_from}")
    found = met.groupBy(*asking).agg(F.min("candidate").alias("candidate"))
    if hot:
        # Rows go back to the answer of their query. A hot key may ask many queries, so what
        # counts here is how many rows share one.
        numbered = ["*", f"xxhash64({', '.join(asking)}) AS query"]
        queries, found = queries.selectExpr(*numbered), found.selectExpr(*numbered)
        shared = find_hot_keys(queries.select("query"), hot.rows_per_task)
        named = lookup_join(queries, found, ["query", *asking], shared, "left").drop("query")
    else:
        named = lookup_join(queries, found, asking, NO_HOT_KEYS, "left")
    kept = [c for c in queries.columns if c not in ("any_candidate", "query")]
    return named.select(*kept, F.coalesce("candidate", "any_candidate").alias("candidate"))
