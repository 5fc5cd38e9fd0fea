"""Trailing time-window z-score per sensor (A1), built for hot sensors.

Semantics: rows of one sensor ordered by ``(event_ts, tie)``; the window of a
row holds every row at or before it in that order whose time is within
``window_seconds`` (both ends closed, the row itself included).  Mean and
*population* standard deviation over the window; rows with fewer than two
window rows, a zero deviation or a non-finite value in the window are never
flagged; a row is flagged when ``|z| > threshold`` (strict).

Partitioning: one sensor may carry a third of all rows, so work is never
keyed by sensor alone.  Rows are split into ``(sensor, time block)``
partitions; a row in the last ``window_seconds`` of a block is also copied,
as context only, into the next block, so every window is complete inside
one partition.  With ``block_seconds = 4 h`` and a 1 h window the copies add
a quarter to the shuffled rows, and a partition holds at most 5 h of one
sensor.

Two interchangeable implementations:

* ``method="sweep"`` (default): every row emits an *enter* event at its time
  and a *leave* event just past ``time + window``; running sums over the
  events (``ROWS UNBOUNDED PRECEDING``) give count, sum and sum of squares of
  the window in one sort, O(n log n) instead of O(n * window).  Values are
  centred per partition; the round-off of the sums is bounded by the sum of
  squares of the terms added *so far*, so one later outlier or a busy block
  doesn't blur the windows before it.  A window is constant if the last two
  differing neighbours don't both lie in it: compared exactly, no arithmetic.
  Where round-off could decide the outcome (|z| within the bound of the
  threshold, or a variance below its bound in a window that isn't constant),
  that row alone is recomputed by a band join to its own window rows.
* ``method="frame"``: a RANGE frame on a composite key, Spark's exact
  aggregate per frame; O(n * window) -- the reference for tests only.

``block_seconds`` below the window (it must divide it) switches the sweep to
the offset layout (:func:`_offset_sweep`): no context copies, a task holds one
short block of one sensor however dense the sensor is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorflow import rules, session

_EPS = 2.220446049250313e-16
_TIE_BITS = 2048          # frame form: key = micros * 2048 + rank among equal times
_MAX_TIES = 1023
_HASH_MASK = 0x7FFFFFFF


def _prepare(df: DataFrame, tie: str | None, window_us: int, block_us: int) -> DataFrame:
    v = F.col("value").cast("double")
    bad = v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
    micros = F.unix_micros(F.col("event_ts"))
    tie_c = F.coalesce(F.col(tie).cast("long"), F.lit(0)) if tie else F.lit(0).cast("long")
    out = (df.filter(F.col("event_ts").isNotNull())
             .withColumn("_micros", micros)
             .withColumn("_tie", tie_c)
             .withColumn("_v", v)
             .withColumn("_bad", bad))
    return out.withColumn("_blk_own", _block(F.col("_micros"), block_us))


def _block(micros: Column, length: int) -> Column:
    """Number of the block a time lies in, rounded down before 1970 as well.

    The dividend is a multiple of ``length``, so the quotient is a whole double, exact below 2^53.
    """
    return ((micros - F.pmod(micros, F.lit(length))) / F.lit(length)).cast("long")


def _with_copies(prep: DataFrame, window_us: int, block_us: int) -> DataFrame:
    """Owner copy in its own block + context copy in the next block when needed."""
    in_tail = F.col("_micros") >= (F.col("_blk_own") + 1) * block_us - window_us
    shifts = F.when(in_tail, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (prep.withColumn("_shift", F.explode(shifts))
                .withColumn("_blk", F.col("_blk_own") + F.col("_shift"))
                .withColumn("_owner", F.col("_shift") == 0)
                .drop("_shift"))


def _hash(c: Column, seed: int) -> Column:
    z = F.when(c == 0.0, F.lit(0.0)).otherwise(c)  # -0.0 and 0.0 are one value
    if seed == 1:
        return F.hash(z).bitwiseAND(F.lit(_HASH_MASK)).cast("long")
    return F.xxhash64(z).bitwiseAND(F.lit(_HASH_MASK)).cast("long")


def _partitioned_copies(prep: DataFrame, window_us: int, block_us: int) -> DataFrame:
    """Owner + context copies, hash-partitioned by (sensor, block): the one shuffle."""
    return _with_copies(prep, window_us, block_us).repartition("sensor_id", "_blk")


def _sweep(copies: DataFrame, window_us: int, block_us: int) -> DataFrame:
    """Enter/leave events + running sums; each window spec one pass over sorted rows."""
    end = (F.col("_blk") + 1) * block_us
    byrow = Window.partitionBy("sensor_id", "_blk").orderBy("_micros", "_tie")
    # time of the row before, where its value differs: a window that starts later may be constant
    before, when = F.lag("_v").over(byrow), F.lag("_micros").over(byrow)
    copies = copies.withColumn("_was", F.when(~F.coalesce(before == F.col("_v"), F.lit(False)), when))
    copies = copies.withColumn("_changed", F.last("_was", ignorenulls=True).over(
        byrow.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    events = F.array(
        F.struct(F.lit(0).alias("k"), F.col("_micros").alias("o")),
        F.struct(F.lit(1).alias("k"), (F.col("_micros") + window_us).alias("o")))
    ev = (copies.withColumn("_e", F.explode(events))
                .withColumn("_kind", F.col("_e.k")).withColumn("_ord", F.col("_e.o")).drop("_e")
                .filter((F.col("_kind") == 0) | (F.col("_ord") < end)))
    order = [F.col("_ord"), F.col("_kind"), F.col("_tie")]
    part = Window.partitionBy("sensor_id", "_blk").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    run = Window.partitionBy("sensor_id", "_blk").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    good_v = F.when((F.col("_kind") == 0) & ~F.col("_bad"), F.col("_v"))
    ev = ev.select("*", F.coalesce(F.avg(good_v).over(part), F.lit(0.0)).alias("_centre"))
    s = F.when(F.col("_kind") == 0, F.lit(1)).otherwise(F.lit(-1)).cast("long")
    sd = s.cast("double")
    c = F.when(F.col("_bad"), F.lit(0.0)).otherwise(F.col("_v") - F.col("_centre"))
    ev = ev.withColumn("_c", c)
    return ev.select("*",
                     F.sum(s).over(run).alias("_n"),
                     F.sum(F.when(F.col("_bad"), s).otherwise(F.lit(0))).over(run).alias("_nbad"),
                     F.sum(sd * F.col("_c")).over(run).alias("_s1"),
                     F.sum(sd * F.col("_c") * F.col("_c")).over(run).alias("_s2"),
                     F.count(F.lit(1)).over(run).alias("_terms"),
                     F.sum(F.col("_c") * F.col("_c")).over(run).alias("_abs2"))


def _state(n: Column, nbad: Column, c: Column, s1: Column, s2: Column, terms: Column, abs2: Column,
           constant: Column, threshold: float) -> tuple[Column, Column, Column, Column]:
    """``(state, z, mean - centre, std)`` of one window; state none, flag or recheck.

    ``terms`` values were added up, ``abs2`` is the sum of their squares: a sum of
    squares is off by at most ``4 eps terms abs2``, a plain sum by its root's share.
    """
    # try_divide: a zero divisor gives NULL instead of an ANSI error
    n = n.cast("double")
    mean_c = F.try_divide(s1, n)
    var = F.greatest(F.try_divide(s2, n) - mean_c * mean_c, F.lit(0.0))
    std = F.sqrt(var)
    z = F.try_divide(c - mean_c, std)
    m2_tol = F.lit(4 * _EPS) * terms * abs2
    s1_tol = F.lit(4 * _EPS) * terms * F.sqrt(n * abs2)
    unreliable = n * var <= F.lit(16) * m2_tol
    zdelta = F.lit(1e-9) + F.try_divide(m2_tol, n * var) + F.try_divide(s1_tol, n * std)
    near = F.coalesce(F.abs(F.abs(z) - F.lit(threshold)) <= F.lit(threshold) * zdelta, F.lit(True))
    state = (F.when(~((n >= 2) & (nbad == 0)) | constant, F.lit("none"))
              .when(unreliable | near, F.lit("recheck"))
              .when(F.coalesce(F.abs(z) > F.lit(threshold), F.lit(False)), F.lit("flag"))
              .otherwise(F.lit("none")))
    return state, z, mean_c, std


def _frame_stats(df: DataFrame, window_us: int) -> DataFrame:
    """Exact per-row window stats by a RANGE frame on ``micros * 2048 + tie rank``.

    ``df`` must hold every row of each (sensor, block) partition it covers
    (owner rows and context copies).
    """
    p = Window.partitionBy("sensor_id", "_blk")
    rn = F.row_number().over(p.orderBy("_micros", "_tie"))
    rk = F.rank().over(p.orderBy("_micros"))
    df = df.withColumn("_rank", rn - rk)
    df = df.withColumn("_rank", F.when(F.col("_rank") > _MAX_TIES, F.raise_error(
        F.lit(f"more than {_MAX_TIES + 1} readings of one sensor at one microsecond"))).otherwise(F.col("_rank")))
    df = df.withColumn("_o", F.col("_micros") * _TIE_BITS + F.col("_rank"))
    frame = p.orderBy("_o").rangeBetween(-(window_us * _TIE_BITS + _MAX_TIES), 0)
    return df.select("*",
                     F.count(F.lit(1)).over(frame).alias("_xn"),
                     F.count_if(F.col("_bad")).over(frame).alias("_xbad"),
                     F.avg("_v").over(frame).alias("_xmean"),
                     F.stddev_pop("_v").over(frame).alias("_xstd"))


def _frame(prep: DataFrame, window_us: int, block_us: int) -> DataFrame:
    out = _frame_stats(_partitioned_copies(prep, window_us, block_us), window_us)
    return out.filter(F.col("_owner")).select(
        "*", F.col("_xn").alias("_wn"), F.col("_xbad").alias("_wbad"),
        F.col("_xmean").alias("_mean"), F.col("_xstd").alias("_std"))


def _offset_sweep(prep: DataFrame, cols: list[str], window_us: int, k: int, threshold: float,
                  materialize: bool = True) -> DataFrame:
    """Sweep with blocks shorter than the window (``window = k * block``), no copies.

    Each row emits an *enter* event into the block of its time and a *leave*
    event into the block of ``time + window``; the events are shuffled once by
    (sensor, block).  A row's window = what was inside at the start of its
    block (*offset*) + the running sums inside the block.  Because the window
    is exactly ``k`` blocks long, the offset of block ``b`` is the sum of the
    *enter* totals of blocks ``b-k .. b-1`` -- a per-block aggregate (one row
    per sensor-block) combined with the parallel-variance identity around the
    block's own mean, so every term is non-negative and round-off stays at the
    scale of the window, not of the sensor's history.  A task holds one block
    of one sensor whatever the sensor's density.
    """
    block_us = window_us // k
    payload = [c for c in cols if c != "sensor_id"]
    enter = F.col("_e.k") == 0
    ev = prep.select("sensor_id", *payload, "_tie", "_v", "_bad", F.explode(F.array(
        F.struct(F.lit(0).alias("k"), F.col("_micros").alias("o")),
        F.struct(F.lit(1).alias("k"), (F.col("_micros") + window_us).alias("o")))).alias("_e"))
    ev = ev.select("sensor_id", *[F.when(enter, F.col(c)).alias(c) for c in payload], "_tie", "_v", "_bad",
                   F.col("_e.k").alias("_kind"), F.col("_e.o").alias("_ord"),
                   _block(F.col("_e.o"), block_us).alias("_eblk"))
    sh = ev.repartition("sensor_id", "_eblk")
    if materialize:
        # several consumers below (block totals, window pass, band join): cut
        # the lineage once in the shared checkpoint folder so none of them
        # recomputes the input plan
        session.checkpoint_dir(sh.sparkSession)
        sh = sh.checkpoint(eager=True)

    # per-block enter totals: count, bad count, mean and M2 of good values, hash sums
    good_v = F.when(~F.col("_bad"), F.col("_v"))
    blocks = (sh.filter(F.col("_kind") == 0).groupBy("sensor_id", "_eblk").agg(
        F.count(F.lit(1)).alias("bn"), F.count_if(F.col("_bad")).alias("bbad"),
        F.count(good_v).alias("bg"), F.avg(good_v).alias("bmean"),
        F.coalesce(F.var_pop(good_v) * F.count(good_v), F.lit(0.0)).alias("bm2"),
        F.coalesce(F.sum(F.when(~F.col("_bad"), _hash(F.col("_v"), 1))), F.lit(0)).alias("bh1"),
        F.coalesce(F.sum(F.when(~F.col("_bad"), _hash(F.col("_v"), 2))), F.lit(0)).alias("bh2")))
    centre = blocks.select("sensor_id", "_eblk", F.coalesce(F.col("bmean"), F.lit(0.0)).alias("_a"))
    prev = blocks.select("sensor_id", F.explode(F.sequence(F.col("_eblk") + 1, F.col("_eblk") + k)).alias("_eblk"),
                         "bn", "bbad", "bg", "bmean", "bm2", "bh1", "bh2")
    d = F.coalesce(F.col("bmean") - F.col("_a"), F.lit(0.0))
    offsets = (prev.join(centre, ["sensor_id", "_eblk"], "inner").groupBy("sensor_id", "_eblk", "_a").agg(
        F.sum("bn").alias("_on"), F.sum("bbad").alias("_obad"),
        F.sum(F.col("bg") * d).alias("_os1"),
        F.sum(F.col("bm2") + F.col("bg") * d * d).alias("_os2"),
        F.sum("bh1").alias("_oh1"), F.sum("bh2").alias("_oh2")))
    zero = {"_on": 0, "_obad": 0, "_os1": 0.0, "_os2": 0.0, "_oh1": 0, "_oh2": 0}
    withc = (sh.join(centre, ["sensor_id", "_eblk"], "left")
               .join(offsets.drop("_a"), ["sensor_id", "_eblk"], "left")
               .fillna(zero).fillna({"_a": 0.0}))

    order = [F.col("_ord"), F.col("_kind"), F.col("_tie")]
    run = Window.partitionBy("sensor_id", "_eblk").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    part = Window.partitionBy("sensor_id", "_eblk").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    s = F.when(F.col("_kind") == 0, F.lit(1)).otherwise(F.lit(-1)).cast("long")
    sd = s.cast("double")
    c = F.when(F.col("_bad"), F.lit(0.0)).otherwise(F.col("_v") - F.col("_a"))
    good_s = F.when(F.col("_bad"), F.lit(0)).otherwise(s)
    w = withc.withColumn("_c", c).select(
        "*",
        F.count(F.lit(1)).over(part).alias("_pn"),
        (F.col("_on") + F.sum(s).over(run)).alias("_n"),
        (F.col("_obad") + F.sum(F.when(F.col("_bad"), s).otherwise(F.lit(0))).over(run)).alias("_nbad"),
        (F.col("_os1") + F.sum(sd * F.col("_c")).over(run)).alias("_s1"),
        (F.col("_os2") + F.sum(sd * F.col("_c") * F.col("_c")).over(run)).alias("_s2"),
        (F.col("_os2") + F.sum(F.col("_c") * F.col("_c")).over(run)).alias("_abs2"),
        (F.col("_oh1") + F.sum(good_s * _hash(F.col("_v"), 1)).over(run)).alias("_h1"),
        (F.col("_oh2") + F.sum(good_s * _hash(F.col("_v"), 2)).over(run)).alias("_h2"))
    w = w.filter(F.col("_kind") == 0)

    # equal 31-bit hash sums for both hashes: constant, up to a collision (about 2^-62)
    constant = ((F.col("_h1") == F.col("_n") * _hash(F.col("_v"), 1))
                & (F.col("_h2") == F.col("_n") * _hash(F.col("_v"), 2)))
    state, z, mean_c, std = _state(F.col("_n"), F.col("_nbad"), F.col("_c"), F.col("_s1"), F.col("_s2"),
                                   F.col("_pn") + F.lit(k + 2), F.col("_abs2"), constant, threshold)
    decided = w.select(*cols, F.col("_ord").alias("_micros"), "_tie", "_v", state.alias("_state"),
                       z.alias("_z"), (F.col("_a") + mean_c).alias("_mean"), std.alias("_std"),
                       F.col("_n").alias("_wn"))
    rows = sh.filter(F.col("_kind") == 0).select("sensor_id", F.col("_ord").alias("_micros"), "_tie", "_v", "_bad")
    return _with_rescored(decided, rows, cols, window_us, threshold)


def _with_rescored(decided: DataFrame, rows: DataFrame, cols: list[str], window_us: int, threshold: float) -> DataFrame:
    """Flagged rows, and the undecided ones that an exact pass over their own window flags.

    The window's rows come by a band join on (sensor, slot of one eighth of a window), so
    only undecided rows and the rows of their windows meet.
    """
    # the small decided set is read by two branches through one shuffle, so the
    # window pass above runs once
    keep = decided.filter(F.col("_state") != "none").repartition("sensor_id", "_micros")
    flagged = keep.filter(F.col("_state") == "flag").select(*cols, "_z", "_mean", "_std", "_wn")
    cands = keep.filter(F.col("_state") == "recheck")
    slot = max(1, window_us // 8)
    lo, hi = _block(F.col("_micros") - window_us, slot), _block(F.col("_micros"), slot)
    cx = cands.select("sensor_id", "_micros", "_tie", F.explode(F.sequence(lo, hi)).alias("_slot"))
    rows = rows.select(
        F.col("sensor_id").alias("_r_sensor"), _block(F.col("_micros"), slot).alias("_r_slot"),
        F.col("_micros").alias("_r_micros"), F.col("_tie").alias("_r_tie"), F.col("_v").alias("_r_v"),
        F.col("_bad").alias("_r_bad"))
    cond = ((cx["sensor_id"] == rows["_r_sensor"]) & (cx["_slot"] == rows["_r_slot"])
            & (rows["_r_micros"] >= cx["_micros"] - window_us)
            & ((rows["_r_micros"] < cx["_micros"])
               | ((rows["_r_micros"] == cx["_micros"]) & (rows["_r_tie"] <= cx["_tie"]))))
    # Spark's frame aggregates in (time, tie) order -- the same arithmetic as
    # the frame form, so a tie at the threshold is decided the same way
    # every run (a grouped aggregate would merge partial sums in any order).
    cw = Window.partitionBy("sensor_id", "_micros", "_tie").orderBy("_r_micros", "_r_tie").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    stats = (cx.join(rows, cond, "inner")
               .select("sensor_id", "_micros", "_tie", "_r_micros", "_r_tie",
                       F.count(F.lit(1)).over(cw).alias("_xn"),
                       F.count_if(F.col("_r_bad")).over(cw).alias("_xbad"),
                       F.avg("_r_v").over(cw).alias("_xmean"),
                       F.stddev_pop("_r_v").over(cw).alias("_xstd"))
               .filter((F.col("_r_micros") == F.col("_micros")) & (F.col("_r_tie") == F.col("_tie")))
               .drop("_r_micros", "_r_tie"))
    xz = F.try_divide(F.col("_v") - F.col("_xmean"), F.col("_xstd"))
    rechecked = (cands.join(stats, ["sensor_id", "_micros", "_tie"], "inner")
                      .filter(_flag(F.col("_xn"), F.col("_xbad"), F.col("_xstd"), xz, threshold))
                      .select(*cols, xz.alias("_z"), F.col("_xmean").alias("_mean"), F.col("_xstd").alias("_std"),
                              F.col("_xn").alias("_wn")))
    return flagged.unionByName(rechecked)


def _flag(n: Column, nbad: Column, std: Column, z: Column, threshold: float) -> Column:
    return F.coalesce((n >= 2) & (nbad == 0) & std.isNotNull() & (std != 0) & ~F.isnan(z)
                      & (F.abs(z) > F.lit(threshold)), F.lit(False))


def rolling_zscore(df: DataFrame, *, window_seconds: int = rules.ZSCORE_WINDOW_SECONDS,
                   threshold: float = rules.ZSCORE_THRESHOLD, tie: str | None = "raw_event_id",
                   block_seconds: int = 4 * 3600, method: str = "sweep",
                   materialize: bool = True) -> DataFrame:
    """Flagged rows of ``df`` with ``_z``, ``_mean``, ``_std`` and ``_wn`` (window rows).

    ``df`` needs ``sensor_id``, ``event_ts`` (timestamp) and ``value``; ``tie``
    orders rows with equal times (later ids see earlier peers).
    """
    if block_seconds < window_seconds and window_seconds % block_seconds:
        raise ValueError("block_seconds must divide window_seconds or be at least as long")
    tie = tie if tie and tie in df.columns else None
    window_us = int(window_seconds) * 1_000_000
    block_us = int(block_seconds) * 1_000_000
    cols = df.columns
    if method == "frame":
        block_us = max(block_us, window_us)
        fr = _frame(_prepare(df, tie, window_us, block_us), window_us, block_us)
        z = F.try_divide(F.col("_v") - F.col("_mean"), F.col("_std"))
        out = fr.withColumn("_z", z).filter(_flag(F.col("_wn"), F.col("_wbad"), F.col("_std"), F.col("_z"), threshold))
        return out.select(*cols, "_z", "_mean", "_std", "_wn")
    if method != "sweep":
        raise ValueError(f"unknown method {method!r}")
    prep = _prepare(df, tie, window_us, block_us)
    if block_seconds < window_seconds:
        return _offset_sweep(prep, cols, window_us, window_seconds // block_seconds, threshold, materialize)
    ev = _sweep(_partitioned_copies(prep, window_us, block_us), window_us, block_us)
    ev = ev.filter(F.col("_owner") & (F.col("_kind") == 0))
    constant = ~F.coalesce(F.col("_changed") >= F.col("_micros") - window_us, F.lit(False))
    state, z, mean_c, std = _state(F.col("_n"), F.col("_nbad"), F.col("_c"), F.col("_s1"), F.col("_s2"),
                                   F.col("_terms"), F.col("_abs2"), constant, threshold)
    decided = ev.select(*cols, "_micros", "_tie", "_v", state.alias("_state"), z.alias("_z"),
                        (F.col("_centre") + mean_c).alias("_mean"), std.alias("_std"), F.col("_n").alias("_wn"))
    return _with_rescored(decided, prep.select("sensor_id", "_micros", "_tie", "_v", "_bad"), cols, window_us, threshold)
