"""Delivery-error bursts and the pauses they cause.

Both look back a fixed time. Nothing is cut by time: rows are range partitioned by key and time, so slices hold about
equally many rows however densely they lie, and a key that holds a third of all rows, or a second that does, is many
slices. What a row needs from before or after its slice comes from totals per slice, or from a step function of it.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartstream.operators.metrics import MICROS, from_micros, micros
from cartstream.operators.ordered import join_groups
from cartstream.session import cut_lineage


def _slices(df: DataFrame, rows: int | None) -> int:
    """How many slices to cut: one per shuffle partition, or as many as slices of `rows` rows make."""
    return -(-df.count() // rows) or 1 if rows else int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _shared(sliced: DataFrame, key: list[str]) -> DataFrame:
    """Keys that lie in several slices: fewer than there are slices, as neighbouring ones share at most one."""
    return sliced.groupBy(*key).agg(F.min("_slice").alias("_a"), F.max("_slice").alias("_b")).filter("_a < _b").select(*key)


def _same(left: DataFrame, right: DataFrame, columns: list[str], how: str) -> DataFrame:
    """`left` joined with broadcast rows of slices (bounded by their number), NULL keys like any other."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in columns else F.col(c) for c in right.columns])
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in columns])
    return left.join(F.broadcast(renamed), on, how).drop(*[f"_r_{c}" for c in columns])


LISTED = 1000  # errors of one instant listed at once
TICK, BEHIND, AHEAD = 1, 2, 0  # at one moment, look-ups ahead come first and look-ups behind last


def _around(instants: DataFrame, key: list[str], value: str, window_us: int, ahead_us: int | None, n: int) -> DataFrame:
    """(key…, _us, _slice, n_at, n_window[, _next]) of instants (key…, _us, value), one row each, dealt to `n` slices.

    Every instant asks for the key's running sum at the moment just before its window, and with `ahead_us` for the first
    instant that much later. Questions and instants are ordered together; a running sum and the next instant of each slice, shifted by
    what the key's other slices hold, answer them. The slices are written, so that a retried task cannot move rows between them.
    """
    zero = F.lit(0).cast("bigint")
    asked = [
        F.struct(F.col("_us").alias("_at"), F.lit(TICK).alias("_kind"), F.col(value).alias("_v")),
        F.struct((F.col("_us") - window_us - 1).alias("_at"), F.lit(BEHIND).alias("_kind"), zero.alias("_v")),
    ]
    if ahead_us is not None:
        asked.append(F.struct((F.col("_us") + ahead_us).alias("_at"), F.lit(AHEAD).alias("_kind"), zero.alias("_v")))
    points = instants.filter("_us IS NOT NULL").select(*key, "_us", F.explode(F.array(*asked)).alias("_p")).select(*key, "_us", "_p.*")
    order = [*key, "_at", "_kind"]
    sliced = cut_lineage(points.repartitionByRange(n, *order).withColumn("_slice", F.spark_partition_id()))

    tick_at = F.when(F.col("_kind") == TICK, F.col("_at"))
    totals = sliced.groupBy(*key, "_slice").agg(F.sum("_v").alias("_total"), F.min(tick_at).alias("_first"))
    before = Window.partitionBy(*key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    beyond = Window.partitionBy(*key).orderBy(F.desc("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select(*key, "_slice", F.sum("_total").over(before).alias("_shift"), F.min("_first").over(beyond).alias("_later"))
    shifts = shifts.filter("_shift IS NOT NULL OR _later IS NOT NULL")  # less than two for each slice
    # Frames only grow: looking ahead runs backwards.
    within = Window.partitionBy("_slice", *key)
    read = sliced.withColumn("_upto", F.sum("_v").over(within.orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)))
    if ahead_us is not None:
        backwards = within.orderBy(F.desc("_at"), F.desc("_kind")).rowsBetween(Window.unboundedPreceding, 0)
        read = read.withColumn("_on", F.min(tick_at).over(backwards))
    read = _same(read, shifts, [*key, "_slice"], "left").withColumn("_upto", F.col("_upto") + F.coalesce("_shift", F.lit(0)))
    of = lambda kind, c: F.max(F.when(F.col("_kind") == kind, c))
    answers = [
        of(TICK, F.col("_slice")).alias("_slice"), of(TICK, F.col("_v")).alias("n_at"),
        (of(TICK, F.col("_upto")) - of(BEHIND, F.col("_upto"))).alias("n_window"),
    ]
    if ahead_us is not None:
        answers.append(of(AHEAD, F.coalesce("_on", "_later")).alias("_next"))
    return read.groupBy(*key, "_us").agg(*answers)


def trailing_count(
    df: DataFrame, key: list[str], ts: str, window: int, block: int | None = None
) -> DataFrame:
    """(key…, ts, n_at, n_window): rows at this instant and in the closed last `window` seconds.

    Rows of one key and instant are added up before anything is ordered. `block` is the number of rows a slice should hold.
    """
    instants = df.groupBy(*key, F.col(ts).alias("_ts")).agg(F.count("*").alias("_n")).withColumn("_us", micros(F.col("_ts")))
    counted = _around(instants.drop("_ts"), key, "_n", window * MICROS, None, _slices(instants, block))
    moment = F.timestamp_micros("_us").cast(df.schema[ts].dataType)
    return counted.select(*key, moment.alias(ts), "n_at", "n_window")


def error_burst(
    errors: DataFrame, key: list[str], ts: str = "ts", window: int = 10, threshold: int = 5,
    block: int | None = None,
) -> DataFrame:
    """(key…, ts, n_window, burst), one row per error: is the error window at its threshold at this error?

    The window slides with the time of evaluation, so old errors never count. Errors of one instant share their window; they are
    listed by blocks of `LISTED`, which are dealt out, so an instant of very many errors fills neither a list nor a task.
    """
    counted = trailing_count(errors, key, ts, window, block)
    blocks = counted.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_at") - 1, F.lit(LISTED).cast("bigint"))).alias("_done"))
    size = F.least(F.lit(LISTED), F.col("n_at") - F.col("_done")).cast("int")
    each = blocks.repartition(*key, ts, "_done").select("*", F.explode(F.array_repeat(F.lit(1), size)).alias("_one"))
    return each.select(*key, ts, "n_window", (F.col("n_window") >= threshold).alias("burst"))


# -- pauses ------------------------------------------------------------------

NEVER = 2**62
FAN = 16  # step functions put together by one task


def pause_candidates(
    ticks: DataFrame, key: list[str], is_error: str, ts: str, window: int, threshold: int, cooldown: int,
    n: int,
) -> DataFrame:
    """(key…, _us, _slice, _resume): ticks that would start a pause, the tick that would end it, and its slice of `n`."""
    err = F.coalesce(F.col(is_error).cast("bigint"), F.lit(0))
    instants = ticks.groupBy(*key, micros(F.col(ts)).alias("_us")).agg(F.sum(err).alias("_n"))
    around = _around(instants, key, "_n", window * MICROS, cooldown * MICROS, n)
    return around.filter(F.col("n_window") >= threshold).select(
        *key, "_us", "_slice", F.coalesce("_next", F.lit(NEVER)).alias("_resume")
    )


class Steps:
    """What a run of candidates does to the resume tick it is entered with, as a step function.

    Entered with x, the first of `at` that is later than x pauses, and `leaves` at its place is the resume tick carried on; with none
    later, x is. Such functions can be put together in any grouping. A pause begun earlier resumes at the latest at
    the first tick after `reach` (the first candidate and the cooldown), so only steps up to there, and the two that follow, count.
    """

    def __init__(self, at: np.ndarray, leaves: np.ndarray, reach: int):
        keep = int(np.searchsorted(at, reach, side="left")) + 2
        at, leaves = at[:keep], leaves[:keep]
        last = np.append(leaves[:-1] != leaves[1:], True) if len(at) else np.zeros(0, bool)
        self.at, self.leaves, self.reach = at[last], leaves[last], reach

    def __call__(self, x: np.ndarray) -> np.ndarray:
        k = np.searchsorted(self.at, x, side="right")
        return np.where(k < len(self.at), np.append(self.leaves, 0)[k], x)

    def then(self, later: Steps) -> Steps:
        beyond = later.at > (self.at[-1] if len(self.at) else -NEVER)
        return Steps(np.append(self.at, later.at[beyond]), np.append(later(self.leaves), later.leaves[beyond]), self.reach)


def _following(codes: np.ndarray, us: np.ndarray, resume: np.ndarray) -> np.ndarray:
    """For candidates in the order of key code and time: the next one later than the resume tick, or their number."""
    n = len(us)
    order = np.lexsort((np.repeat([0, 1], n), np.append(us, resume), np.append(codes, codes)))
    counts = np.cumsum(order < n)
    nxt = np.empty(n, np.int64)
    nxt[order[order >= n] - n] = counts[order >= n]
    other = nxt < n
    other[other] = codes[nxt[other]] != codes[other]
    return np.where(other, n, nxt)


def _ordered(pdf: pd.DataFrame, keys: list[str]) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
    """A slice by key and time, the key codes, and where each key begins."""
    codes = pdf.groupby(keys, dropna=False, sort=False).ngroup().to_numpy()
    order = np.lexsort((pdf["_us"].to_numpy(), codes))
    codes = codes[order]
    return pdf.iloc[order], codes, np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))


def _steps(pdf: pd.DataFrame, keys: list[str], cooldown_us: int) -> pd.DataFrame:
    """The step functions of a slice's keys."""
    pdf, codes, first = _ordered(pdf, keys)
    us, resume = pdf["_us"].to_numpy(), pdf["_resume"].to_numpy()
    n, nxt = len(us), _following(codes, us, resume)
    # Where each chain ends, by pointer jumping.
    end = np.where(nxt < n, nxt, np.arange(n))
    while (end != end[end]).any():
        end = end[end]
    leaves, out = resume[end], pdf.iloc[first][[*keys, "_slice"]].copy()
    runs = [Steps(us[a:b], leaves[a:b], int(us[a]) + cooldown_us) for a, b in zip(first, np.append(first[1:], n), strict=True)]
    return out.assign(at=[r.at for r in runs], leaves=[r.leaves for r in runs], reach=[r.reach for r in runs])


def _together(pdf: pd.DataFrame, keys: list[str]) -> pd.DataFrame:
    """One step function for up to `FAN` neighbouring ones of a key."""
    pdf = pdf.sort_values("_slice")
    total = reduce(Steps.then, map(Steps, pdf["at"], pdf["leaves"], pdf["reach"]))
    out = pdf.iloc[:1][keys].copy()
    return out.assign(_slice=pdf["_up"].iloc[0], at=[total.at], leaves=[total.leaves], reach=total.reach)


def _entered(pdf: pd.DataFrame, keys: list[str]) -> pd.DataFrame:
    """The resume ticks carried into up to `FAN` neighbouring functions, given the one carried into the first."""
    pdf = pdf.sort_values("_slice")
    x, carried = np.array([pdf["_carried"].iloc[0]]), []
    for at, leaves, reach in zip(pdf["at"], pdf["leaves"], pdf["reach"], strict=True):
        carried.append(int(x[0]))
        x = Steps(at, leaves, reach)(x)
    return pdf[[*keys, "_slice"]].assign(_carried=carried)


def _walk(pdf: pd.DataFrame, keys: list[str]) -> pd.DataFrame:
    """Pauses of one slice, given the resume tick carried into each of its keys."""
    pdf, codes, first = _ordered(pdf, keys)
    us, resume, n = pdf["_us"].to_numpy(), pdf["_resume"].to_numpy(), len(pdf)
    nxt = np.append(_following(codes, us, resume), n)
    carried = pdf["_carried"].fillna(-NEVER).to_numpy().astype(np.int64)
    # Of each key, the first candidate later than what is carried in; then all that follow from them, by doubling.
    open_ = us > carried
    starts = np.flatnonzero(open_)
    picked = starts[np.append(True, codes[starts[1:]] != codes[starts[:-1]])] if len(starts) else starts
    while True:
        more = nxt[picked]
        more = more[more < n]
        if not len(np.setdiff1d(more, picked)):
            break
        picked, nxt = np.union1d(picked, more), nxt[nxt]
    return pdf.iloc[picked][[*keys, "_us", "_resume"]]


def carried_in(functions: DataFrame, key: list[str], n: int) -> DataFrame:
    """(key…, _slice, _carried): the resume tick each step function is entered with, of functions (key…, _slice, at, leaves, reach).

    `FAN` neighbours become one function, round by round; then the rounds are gone back and each hands its entry down.
    """
    fields = ", ".join(f"`{k}` {functions.schema[k].dataType.simpleString()}" for k in key)
    function = f"{fields}, _slice bigint, at array<bigint>, leaves array<bigint>, reach bigint"
    entry = f"{fields}, _slice bigint, _carried bigint"
    up = F.call_function("div", F.col("_slice"), F.lit(FAN))
    levels = [functions if n <= FAN else cut_lineage(functions)]
    while FAN ** len(levels) < n:
        below = levels[-1].withColumn("_up", up)
        levels.append(cut_lineage(below.groupBy(*key, "_up").applyInPandas(lambda pdf: _together(pdf, key), function)))
    entries = None
    for level in reversed(levels):
        asked = level.withColumn("_up", up)
        if entries is None:
            asked = asked.withColumn("_carried", F.lit(-NEVER))
        else:
            asked = join_groups(asked, entries.withColumnRenamed("_slice", "_up"), [*key, "_up"])
        entries = asked.groupBy(*key, "_up").applyInPandas(lambda pdf: _entered(pdf, key), entry)
    return entries


def pause_intervals(
    ticks: DataFrame, key: list[str], is_error: str, ts: str = "ts", window: int = 10, threshold: int = 5,
    cooldown: int = 5, block: int | None = None, after: DataFrame | None = None,
) -> DataFrame:
    """(key…, paused_at, resumes_at, resumed_tick): the pauses of each key's event sequence.

    Every row is a tick. When not paused, a tick at which the last `window` seconds
    hold at least `threshold` errors starts a pause. Ticks are skipped until
    `cooldown` seconds have passed; the first one after that resumes and is not
    tested itself (`resumed_tick` is NULL if there is none).

    Which tick starts the next pause depends on the previous pause, but only through
    its resume tick. So the candidates are cut into slices of about equal size; of a key that lies in several, each slice works
    out in parallel what it would do to any resume tick carried into it. Putting these step functions together
    gives each slice its entry; then all slices list their pauses in parallel.

    `is_error` may also be a number of errors. With after(key…, after_us), one row per
    key, only ticks later than that are tested; earlier ones still count as errors. `block` is the number of rows a slice
    should hold.
    """
    cool_us, n = cooldown * MICROS, _slices(ticks, block)
    found = pause_candidates(ticks, key, is_error, ts, window, threshold, cooldown, n)
    if after is not None:
        known = join_groups(found, after, key, "left")
        found = known.filter(F.col("_us") > F.coalesce("after_us", F.lit(-NEVER))).drop("after_us")
    found = cut_lineage(found)
    fields = ", ".join(f"`{k}` {found.schema[k].dataType.simpleString()}" for k in key)

    spanning = _same(found, _shared(found, key), key, "left_semi")
    functions = spanning.groupBy("_slice").applyInPandas(
        lambda pdf: _steps(pdf, key, cool_us), f"{fields}, _slice bigint, at array<bigint>, leaves array<bigint>, reach bigint"
    )
    entries = carried_in(functions, key, n)
    pauses = _same(found, entries, [*key, "_slice"], "left").groupBy("_slice").applyInPandas(
        lambda pdf: _walk(pdf, key), f"{fields}, _us bigint, _resume bigint"
    )
    return pauses.select(
        *key, from_micros(F.col("_us")).alias("paused_at"),
        from_micros(F.col("_us") + cool_us).alias("resumes_at"),
        F.when(F.col("_resume") < NEVER, from_micros(F.col("_resume"))).alias("resumed_tick"),
    )
