"""Short-gap repair on raw rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeloom.functions.times import epoch_us
from gaugeloom.schema import STATION, TIME, VALUE

BLOCK_MINUTES = 60
#: Model output has minutes to days between its times: in blocks of 90 days a block is many rows, not one.
MODEL_BLOCK_MINUTES = 90 * 1440


def linear(p: Column, pt: Column, n: Column, nt: Column, t: Column) -> Column:
    """The value at `t` on the line through `(pt, p)` and `(nt, n)`."""
    return p + (n - p) * (epoch_us(t) - epoch_us(pt)) / (epoch_us(nt) - epoch_us(pt))


def with_blocks(df: DataFrame, minutes: int = BLOCK_MINUTES) -> DataFrame:
    """Add `_block`, the start of the row's block of the clock.

    The cut is an expression of the row alone: every block is treated alike, whatever it holds, and
    a recomputed task finds the same ones. Times are unique within a station, so an hour at a
    thousand samples a second is 3.6 million rows. Rows without station or time belong to no block.
    """
    return df.where(F.col(STATION).isNotNull()).withColumn("_block", F.window(TIME, f"{minutes} minutes")["start"])


def interpolate_linear(
    df: DataFrame,
    limit: int = 1,
    block_minutes: int = BLOCK_MINUTES,
) -> DataFrame:
    """Fill at most the first `limit` NULLs of each gap on the line between its neighbours in time.

    Gives `(station, time, value)`. Nothing is filled before a station's first or after its last
    valid point. Times must be unique within a station (`dedupe_keep_first`).

    A station's history is never one task: windows run inside `(station, block)`, and what a
    block needs from outside it (the state just before it, the next valid point after it) comes
    from a table with one row per block. Both sides have the same columns, so they read one
    exchange.
    """
    columns = [STATION, TIME, VALUE]
    keys = [STATION, "_block"]
    rows = with_blocks(df.select(*columns), block_minutes).repartition(*keys)
    v, t = F.col(VALUE), F.col(TIME)
    inside = Window.partitionBy(*keys).orderBy(TIME)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    along = Window.partitionBy(STATION).orderBy("_block")

    valid_t = F.when(v.isNotNull(), t)
    edges = rows.groupBy(*keys).agg(
        F.min_by(v, valid_t).alias("first_v"),
        F.min(valid_t).alias("first_t"),
        F.max_by(v, valid_t).alias("last_v"),
        F.max(valid_t).alias("last_t"),
        F.max(t).alias("end_t"),
    )
    if limit == 1:
        # Only the row just before matters: it is usable when it is itself a valid point.
        open_end = F.col("last_t") == F.col("end_t")
        edges = edges.select(
            *keys,
            F.when(open_end, F.col("last_v")).alias("last_v"),
            F.col("end_t").alias("last_t"),
            "first_v", "first_t",
        )
        carry = edges.select(
            *keys,
            F.lag("last_v").over(along).alias("_cv"),
            F.lag("last_t").over(along).alias("_ct"),
            F.expr("lead(first_v) ignore nulls").over(along).alias("_nv"),
            F.expr("lead(first_t) ignore nulls").over(along).alias("_nt"),
        )
        joined = rows.join(carry, keys, "left")
        lag_t = F.lag(t).over(inside)
        prev_t = F.coalesce(lag_t, "_ct")
        prev_v = F.when(lag_t.isNotNull(), F.lag(v).over(inside)).otherwise(F.col("_cv"))
        near = F.lit(True)
    else:
        # Rows since the last valid point decide whether a NULL is within the limit.
        numbered = rows.withColumn("_rn", F.row_number().over(inside))
        tails = numbered.groupBy(*keys).agg(
            (F.max("_rn") - F.coalesce(F.max(F.when(v.isNotNull(), F.col("_rn"))), F.lit(0))).alias("tail"),
            F.max(v.isNotNull()).alias("any_valid"),
        )
        edges = edges.join(tails, keys)
        so_far = along.rowsBetween(Window.unboundedPreceding, -1)
        islands = edges.withColumn("_isl", F.sum(F.col("any_valid").cast("int")).over(
            along.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        run = Window.partitionBy(STATION, "_isl").orderBy("_block")
        carry = (
            islands.withColumn("_run_tail", F.sum("tail").over(
                run.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
            .select(
                *keys,
                F.last("last_v", ignorenulls=True).over(so_far).alias("_cv"),
                F.last("last_t", ignorenulls=True).over(so_far).alias("_ct"),
                F.coalesce(F.lag("_run_tail").over(along), F.lit(0)).alias("_tail"),
                F.expr("lead(first_v) ignore nulls").over(along).alias("_nv"),
                F.expr("lead(first_t) ignore nulls").over(along).alias("_nt"),
            )
        )
        joined = numbered.join(carry, keys, "left")
        own_rn = F.max(F.when(v.isNotNull(), F.col("_rn"))).over(before)
        prev_t = F.coalesce(F.last(valid_t, ignorenulls=True).over(before), "_ct")
        prev_v = F.coalesce(F.last(v, ignorenulls=True).over(before), "_cv")
        place = F.when(own_rn.isNotNull(), F.col("_rn") - own_rn).otherwise(F.col("_rn") + F.col("_tail"))
        near = place <= limit

    next_v = F.coalesce(F.expr(f"lead({VALUE}) ignore nulls").over(inside), "_nv")
    next_t = F.coalesce(
        F.expr(f"lead(case when {VALUE} is not null then {TIME} end) ignore nulls").over(inside), "_nt"
    )
    found = joined.select(
        *columns,
        prev_v.alias("_p"), prev_t.alias("_pt"), next_v.alias("_n"), next_t.alias("_ntime"),
        near.alias("_near"),
    )
    fillable = v.isNull() & F.col("_near") & F.col("_p").isNotNull() & F.col("_n").isNotNull()
    filled = F.when(
        fillable, linear(F.col("_p"), F.col("_pt"), F.col("_n"), F.col("_ntime"), t)
    ).otherwise(v)
    return found.withColumn(VALUE, filled).select(*columns)


def gap_runs(df: DataFrame, block_minutes: int = BLOCK_MINUTES) -> DataFrame:
    """Number the NULLs of each gap: adds `gap_id` and `gap_pos` (NULL on valid rows).

    `gap_id` is the count of valid points before the gap; `gap_pos` starts at 1. Same block
    scheme as `interpolate_linear`: local counts plus the totals carried in from earlier blocks.
    """
    columns = [STATION, TIME, VALUE]
    keys = [STATION, "_block"]
    rows = with_blocks(df.select(*columns), block_minutes).repartition(*keys)
    valid = F.col(VALUE).isNotNull()
    inside = Window.partitionBy(*keys).orderBy(TIME)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = rows.withColumn("_rn", F.row_number().over(inside)).withColumn(
        "_valid", F.count_if(valid).over(upto)
    ).withColumn("_at", F.max(F.when(valid, F.col("_rn"))).over(upto))
    along = Window.partitionBy(STATION).orderBy("_block")
    tails = numbered.groupBy(*keys).agg(
        F.max("_valid").alias("n_valid"),
        (F.max("_rn") - F.coalesce(F.max("_at"), F.lit(0))).alias("tail"),
    )
    upto_block = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    islands = tails.withColumn(
        "_isl", F.sum((F.col("n_valid") > 0).cast("int")).over(upto_block)
    )
    run = Window.partitionBy(STATION, "_isl").orderBy("_block").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    carry = islands.withColumn("_run_tail", F.sum("tail").over(run)).select(
        *keys,
        F.coalesce(F.sum("n_valid").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.coalesce(F.lag("_run_tail").over(along), F.lit(0)).alias("_tail"),
    )
    place = F.when(F.col("_at").isNotNull(), F.col("_rn") - F.col("_at")).otherwise(
        F.col("_rn") + F.col("_tail")
    )
    return numbered.join(carry, keys, "left").select(
        *columns,
        F.when(~valid, F.col("_valid") + F.col("_before")).alias("gap_id"),
        F.when(~valid, place).cast("bigint").alias("gap_pos"),
    )
