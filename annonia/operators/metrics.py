"""Roll-ups, rankings and alerts over run events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Thresholds: errors in a row, blocks, captchas, successes between progress marks.
ERRORS, BLOCKS, CAPTCHAS, PROGRESS = 10, 5, 3, 100


def run_totals(results: DataFrame) -> DataFrame:
    """Items and errors by site, category and overall; level 0: site, 1: category, 3: all."""
    return results.rollup("category", "site").agg(F.sum("items").alias("items"), F.sum("errors").alias("errors"), F.grouping_id().alias("level"))


def category_stats(runs: DataFrame) -> DataFrame:
    return runs.groupBy("category").agg(F.sum("items").alias("items"), F.sum("errors").alias("errors"), F.max("ended").alias("last_run"), F.max_by("duration", F.struct("ended", "duration")).alias("last_duration"))


def cycle_summary(runs: DataFrame, categories: list[str]) -> DataFrame:
    """Items by category in each cycle, with total and duration."""
    wide = runs.groupBy("cycle").agg(*(F.coalesce(F.sum(F.when(F.col("category") == c, F.col("items"))), F.lit(0)).alias(c) for c in categories), F.sum("items").alias("total"), F.sum("duration").alias("duration"))
    return wide


def save_stats(outcomes: DataFrame) -> DataFrame:
    return outcomes.agg(F.count_if("ok").alias("success"), F.count_if(~F.col("ok")).alias("errors"))


def endpoint_stats(requests: DataFrame) -> DataFrame:
    """Counts and mean success latency; a failure also counts as blocked."""
    ok = F.col("ok")
    return requests.groupBy("endpoint").agg(
        F.count_if(ok).alias("successes"), F.count_if(~ok).alias("failures"), F.count_if(F.col("blocked") | ~ok).alias("blocked"), F.avg(F.when(ok, F.col("latency"))).alias("latency")
    )


def endpoint_score(stats: DataFrame) -> DataFrame:
    score = 100 - 10 * F.coalesce("latency", F.lit(5.0)) - 20 * F.col("blocked") - 5 * F.col("failures")
    return stats.withColumn("score", F.greatest(F.lit(1.0), score))


def score_of(endpoints: DataFrame, scores: DataFrame) -> DataFrame:
    """Score of each endpoint asked for; 50 for one never seen."""
    return endpoints.join(scores.select("endpoint", "score"), "endpoint", "left").withColumn("score", F.coalesce("score", F.lit(50.0)))


def top_endpoints(scores: DataFrame, n: int = 20) -> DataFrame:
    return scores.orderBy(F.desc("score"), "endpoint").limit(n)


#: Events of a category are cut into slices of so many hours, so a window's size follows time, not the whole log.
SLICE_HOURS = 24


def running_counts(events: DataFrame) -> DataFrame:
    """Events with their category's counts so far of each kind (n_error, n_block, n_captcha, n_success), and n_error at the last success so far (``cleared``, null before the first).

    Only five categories exist, so a plain window would sort a fifth of the log in one task. Counts are computed
    in slices of time: those within the slice, plus those of the slices before."""
    kinds = ("error", "block", "captcha", "success")
    cut = events.withColumn("slice", F.floor(F.unix_timestamp("ts") / (SLICE_HOURS * 3600)))
    inside = Window.partitionBy("category", "slice").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    run = cut.withColumns({f"r_{k}": F.count_if(F.col("kind") == k).over(inside) for k in kinds})
    run = run.withColumn("r_cleared", F.max(F.when(F.col("kind") == "success", F.col("r_error"))).over(inside))
    before = Window.partitionBy("category").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = run.groupBy("category", "slice").agg(*(F.max(f"r_{k}").alias(f"t_{k}") for k in kinds), F.max("r_cleared").alias("t_cleared"))
    offsets = totals.select("category", "slice", "t_cleared", *(F.coalesce(F.sum(f"t_{k}").over(before), F.lit(0)).alias(f"o_{k}") for k in kinds))
    offsets = offsets.withColumn("o_cleared", F.max(F.col("t_cleared") + F.col("o_error")).over(before)).drop("t_cleared")
    joined = run.join(offsets, ["category", "slice"])
    out = joined.withColumns({f"n_{k}": F.col(f"r_{k}") + F.col(f"o_{k}") for k in kinds} | {"cleared": F.coalesce(F.col("r_cleared") + F.col("o_error"), F.col("o_cleared"))})
    return out.drop("slice", *(f"{p}_{k}" for p in "ro" for k in (*kinds, "cleared")))


def error_streaks(events: DataFrame, threshold: int = ERRORS) -> DataFrame:
    """Errors with their place in the current streak; ``alert`` at every ``threshold``-th. A source that only fails is counted in slices, too."""
    counted = running_counts(events).where("kind = 'error'")
    streak = (F.col("n_error") - F.coalesce("cleared", F.lit(0))).cast("int")
    return counted.select(*events.columns, streak.alias("streak")).withColumn("alert", F.col("streak") % threshold == 0)


def threshold_alerts(events: DataFrame, kind: str, n: int) -> DataFrame:
    """Every n-th event of a kind in its category."""
    counted = running_counts(events.where(F.col("kind") == kind))
    return counted.select(*events.columns, F.col(f"n_{kind}").alias("nth")).where(F.col("nth") % n == 0)


def progress_marks(events: DataFrame, every: int = PROGRESS) -> DataFrame:
    return threshold_alerts(events, "success", every)


def alerts(events: DataFrame, errors: int = ERRORS, blocks: int = BLOCKS, captchas: int = CAPTCHAS, every: int = PROGRESS, carried: DataFrame | None = None) -> DataFrame:
    """Error streaks, block and captcha thresholds and progress marks in one pass: category, event_id, ts, kind, reached.

    ``carried`` has the counters (category, errors, blocks, captchas, successes) of the events before."""
    counted = running_counts(events)
    if carried is None:
        counted = counted.withColumns({c: F.lit(0).cast("long") for c in ("errors", "blocks", "captchas", "successes")})
    else:
        counted = counted.join(carried, "category", "left").fillna(0, ["errors", "blocks", "captchas", "successes"])
    streak = F.col("n_error") - F.coalesce(F.col("cleared"), -F.col("errors"))
    rules = {
        "error": (streak, errors), "block": (F.col("n_block") + F.col("blocks"), blocks), "captcha": (F.col("n_captcha") + F.col("captchas"), captchas),
        "success": (F.col("n_success") + F.col("successes"), every),
    }
    reached, due = F.lit(None).cast("long"), F.lit(False)
    for kind, (value, n) in rules.items():
        reached = F.when(F.col("kind") == kind, value).otherwise(reached)
        due = due | ((F.col("kind") == kind) & (value % n == 0))
    name = F.when(F.col("kind") == "success", "progress").otherwise(F.col("kind")).alias("kind")
    return counted.where(due).select("category", "event_id", "ts", name, reached.alias("reached"))


def counters(events: DataFrame, carried: DataFrame | None = None) -> DataFrame:
    """The counters after these events: the errors of the streak that is still on, and all blocks, captchas and successes."""
    order = F.struct("ts", "event_id")
    kind = F.col("kind")
    last = events.groupBy("category").agg(
        F.count_if(kind == "block").alias("b"), F.count_if(kind == "captcha").alias("c"), F.count_if(kind == "success").alias("s"), F.max(F.when(kind == "success", order)).alias("last")
    )
    late = events.where("kind = 'error'").join(last.select("category", "last"), "category").where(F.col("last").isNull() | (order > F.col("last")))
    now = last.join(late.groupBy("category").agg(F.count("*").alias("e")), "category", "left")
    if carried is None:
        carried = events.sparkSession.createDataFrame([], "category string, errors long, blocks long, captchas long, successes long")
    both = now.join(carried, "category", "full_outer")

    def total(new: str, old: str) -> Column:
        return (F.coalesce(new, F.lit(0)) + F.coalesce(old, F.lit(0))).alias(old)

    errors = F.when(F.coalesce("s", F.lit(0)) > 0, F.coalesce("e", F.lit(0))).otherwise(total("e", "errors")).cast("long").alias("errors")
    return both.select("category", errors, total("b", "blocks"), total("c", "captchas"), total("s", "successes"))


def health_report(events: DataFrame, threshold: int = ERRORS, blocks: int = BLOCKS) -> DataFrame:
    """Items, current error streak, blocks since the last alert and last success, by category."""
    order = F.struct("ts", "event_id")
    last = events.groupBy("category").agg(F.count_if(F.col("kind") == "success").alias("items"), F.count_if(F.col("kind") == "block").alias("b"), F.max(F.when(F.col("kind") == "success", order)).alias("last"))
    after = events.where("kind = 'error'").join(last.select("category", "last"), "category").where(F.col("last").isNull() | (order > F.col("last")))
    errors = after.groupBy("category").agg(F.count("*").alias("e"))
    return last.join(errors, "category", "left").select(
        "category", "items", (F.coalesce("e", F.lit(0)) % threshold).alias("error_streak"), (F.col("b") % blocks).alias("blocks_since_alert"), F.col("last.ts").alias("last_success")
    )


def scrape_log_counts(logs: DataFrame) -> DataFrame:
    return logs.groupBy("category", "site").agg(F.count_if(F.col("level") == "INFO").alias("ok"), F.count_if(F.col("level") == "ERROR").alias("failed"))
