"""Request-log questions: successes, calls per minute, failures, quota
admission and first success among retries (P18, A7, A8, W7, W8).

The reference throttles and retries live inside a polling client; here the
same rules are asked of a log ``ts, event_id, client, request_id, attempt,
status`` (status null = the call failed without a response).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed values equal to the reference's: 60 calls per key and minute, 3 tries
# per call, status 200 accepted.
CALLS_PER_MINUTE = 60
MAX_TRIES = 3
OK_STATUS = 200


def successful_responses(log: DataFrame, body: str | None = None) -> DataFrame:
    """Calls answered with status 200 (and a body, when the log has one)."""
    ok = F.col("status") == OK_STATUS
    if body:
        ok = ok & F.col(body).isNotNull()
    return log.where(ok)


def calls_per_minute(log: DataFrame, key: str = "client") -> DataFrame:
    """Calls per key and one-minute tumbling window (``minute_start`` in epoch seconds)."""
    return (log.groupBy(F.window("ts", "1 minute"), key).agg(F.count(F.lit(1)).alias("n"))
            .select(key, F.unix_seconds(F.col("window.start")).alias("minute_start"), "n"))


def failure_counts(log: DataFrame, key: str = "client") -> DataFrame:
    """Calls, failures (no response) and successes per key."""
    return log.groupBy(key).agg(F.count(F.lit(1)).alias("calls"),
                                F.count_if(F.col("status").isNull()).alias("failed"),
                                F.count_if(F.col("status") == OK_STATUS).alias("ok"))


def first_success(log: DataFrame, attempts: int = MAX_TRIES) -> DataFrame:
    """Per request the first attempt (within ``attempts``) that got 200.

    A grouped minimum over ``(attempt, event_id)`` packed into one decimal, so
    the hash aggregate keeps one row per request and task before the shuffle;
    the winning event is then joined to its client. ``attempt`` must be below
    1000, ``event_id`` in 0..10**18 (a row beyond fails the job).
    """
    ok = log.where((F.col("status") == OK_STATUS) & (F.col("attempt") <= int(attempts)))
    fits = F.col("attempt").between(0, 999) & F.col("event_id").between(0, 10 ** 18 - 1)
    packed = F.when(F.coalesce(fits, F.lit(False)), F.concat(
        F.col("attempt").cast("string"), F.lpad(F.col("event_id").cast("string"), 18, "0"))).otherwise(
        F.raise_error(F.lit("first_success: attempt or event_id out of range"))).cast("decimal(38,0)")
    first = ok.groupBy("request_id").agg(F.min(packed).alias("_f"))
    text = F.lpad(F.col("_f").cast("string"), 21, "0")
    first = first.select("request_id", F.substring(text, 1, 3).cast("int").alias("_a"),
                         F.substring(text, 4, 18).cast("long").alias("event_id"))
    client = ok.select("request_id", "event_id", F.col("attempt").alias("_a"), "client")
    return (first.join(client, ["request_id", "event_id", "_a"])
            .select("request_id", F.col("_a").cast(log.schema["attempt"].dataType).alias("attempt"),
                    F.col("event_id").cast(log.schema["event_id"].dataType).alias("event_id"), "client"))


def gave_up(log: DataFrame, attempts: int = MAX_TRIES) -> DataFrame:
    """Requests that got nothing: ``attempts`` tries made, none answered with
    200 (the reference then returns no reading). ``request_id, tries, unanswered``."""
    early = log.where(F.col("attempt") <= int(attempts))
    return (early.groupBy("request_id")
            .agg(F.count(F.lit(1)).alias("tries"), F.count_if(F.col("status").isNull()).alias("unanswered"),
                 F.count_if(F.col("status") == OK_STATUS).alias("_ok"))
            .where((F.col("_ok") == 0) & (F.col("tries") >= int(attempts))).drop("_ok"))


def running_failures(log: DataFrame, key: str = "client") -> DataFrame:
    """A8 as a running total: after each call, the key's failures so far in
    ``(ts, event_id)`` order. Offsets come from per-second counts, so a window
    over raw calls spans one key and second only."""
    failed = F.col("status").isNull().cast("int")
    x = log.withColumn("_sec", F.unix_seconds(F.col("ts"))).withColumn("_f", failed)
    per_sec = x.groupBy(key, "_sec").agg(F.sum("_f").alias("_fs"))
    run = Window.partitionBy(key).orderBy("_sec").rowsBetween(Window.unboundedPreceding, 0)
    per_sec = per_sec.select(key, "_sec", (F.sum("_fs").over(run) - F.col("_fs")).alias("_before"))
    local = Window.partitionBy(key, "_sec").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return (x.join(per_sec, [key, "_sec"])
            .withColumn("failures", (F.col("_before") + F.sum("_f").over(local)).cast("long"))
            .drop("_sec", "_f", "_before"))


def pooled_quota(log: DataFrame, keys: int, cap: int = CALLS_PER_MINUTE) -> DataFrame:
    """W7 with one shared total: all calls queue together under ``cap * keys``
    calls per minute, whoever makes them."""
    if keys < 1:
        raise ValueError("keys must be >= 1")
    return quota_admission(log.withColumn("_pool", F.lit(0)), key="_pool", cap=int(cap) * int(keys)).drop("_pool")


def quota_admission(log: DataFrame, key: str = "client", cap: int = CALLS_PER_MINUTE) -> DataFrame:
    """Minute each call is admitted under ``cap`` calls per key and minute.

    Calls queue per key in ``(ts, event_id)`` order; a call waits for the next
    minute with a free slot. With ``i`` the call's 0-based rank, ``m_j`` the
    arrival minute of call ``j``, the admitted slot is
    ``s_i = i + max_{j<=i}(m_j*cap - j)`` and the minute ``floor(s_i/cap)``.

    Within one arrival minute ``m_j*cap - j`` falls with ``j``, so the running
    maximum only changes at the first call of a minute: it is computed over
    per-minute counts. Ranks come from per-second counts plus a row number
    inside one key and second. No window ever holds a key's raw calls.
    """
    cap = int(cap)
    x = (log.withColumn("_sec", F.unix_seconds(F.col("ts")))
         .withColumn("_min", F.floor(F.col("_sec") / 60)))
    per_sec = x.groupBy(key, "_min", "_sec").agg(F.count(F.lit(1)).alias("_ns"))
    per_min = per_sec.groupBy(key, "_min").agg(F.sum("_ns").alias("_nm"))
    run_m = Window.partitionBy(key).orderBy("_min").rowsBetween(Window.unboundedPreceding, 0)
    per_min = (per_min.withColumn("_om", F.sum("_nm").over(run_m) - F.col("_nm"))
               .withColumn("_cm", F.max(F.col("_min") * cap - F.col("_om")).over(run_m)))
    run_s = Window.partitionBy(key, "_min").orderBy("_sec").rowsBetween(Window.unboundedPreceding, 0)
    per_sec = per_sec.withColumn("_os", F.sum("_ns").over(run_s) - F.col("_ns"))
    offs = per_sec.join(per_min, [key, "_min"]).select(
        key, "_sec", "_min", (F.col("_om") + F.col("_os")).alias("_o"), "_cm")
    local = Window.partitionBy(key, "_sec").orderBy("ts", "event_id")
    i = F.col("_o") + F.row_number().over(local) - 1
    out = (x.drop("_min").join(offs, [key, "_sec"])
           .withColumn("rank", i.cast("long"))
           .withColumn("admitted_minute", F.floor((F.col("rank") + F.col("_cm")) / F.lit(cap)).cast("long")))
    return (out.withColumn("minute", F.col("_min").cast("long"))
            .withColumn("delay_min", F.col("admitted_minute") - F.col("minute"))
            .drop("_sec", "_min", "_o", "_cm"))
