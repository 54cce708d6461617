"""Exact ranks inside groups without putting a whole group in one task
(X14, X15, X19).

``count_below`` gives, for every row, the summed weight of the rows in the
same group whose key is strictly smaller.  With weight 1 that is
``rank() - 1``; with weight 1 on a reference tier only, it is the number of
reference entities below each row.

How it runs:

1. group by (group, key) and sum the weights - ties collapse in the
   map-side combine, so one value held by a third of the rows becomes one
   row;
2. range-partition the distinct keys on (group, key): a big group spreads
   over many tasks, each holding a contiguous key range;
3. inside each task a streamed running sum (pandas on Arrow batches, O(1)
   state) gives the weight below each key within the task; the result is
   checkpointed to the shared folder, so its partition ids are stable;
4. per (task, group) totals - at most tasks + groups rows - give the
   offset of every task within its group;
5. the rows are joined back on (group, key).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.common import bounded
from tidemark.session import shared_dir


def _running_below(group_cols):
    def fn(batches):
        prev, carry = None, 0
        for pdf in batches:
            if len(pdf) == 0:
                yield pdf.assign(_lb=pd.Series(dtype="int64"))
                continue
            c = pdf["_c"].to_numpy(dtype=np.int64)
            n = len(pdf)
            if group_cols:
                g = pdf[list(group_cols)]
                changed = (g != g.shift()).any(axis=1).to_numpy()
                first = tuple(g.iloc[0])
                changed[0] = prev is None or first != prev
                last = tuple(g.iloc[-1])
            else:
                changed = np.zeros(n, dtype=bool)
                changed[0] = prev is None
                last = ()
            run = np.cumsum(changed)
            excl = np.cumsum(c) - c
            run_start = pd.Series(excl).groupby(run).transform("first").to_numpy()
            lb = excl - run_start
            continues = not changed[0]
            if continues:
                lb[run == run[0]] += carry
            last_run = run == run[-1]
            carry = int(c[last_run].sum()) + (carry if continues and run[-1] == run[0] else 0)
            prev = last
            yield pdf.assign(_lb=lb)
    return fn


def count_below(df: DataFrame, group_cols, key: str, weight: str | None = None,
                out: str = "below", n_out: str | None = "n_group",
                group_bound: int | None = None, next_out: str | None = None) -> DataFrame:
    """Add ``out`` = summed weight of same-group rows with a smaller key
    and ``n_out`` = summed weight of the group (both NULL for a NULL key)."""
    if next_out and weight:
        raise ValueError("next_out needs unit weights")
    spark = df.sparkSession
    group_cols = list(group_cols)
    w = F.col(weight) if weight else F.lit(1)
    vc = (df.filter(F.col(key).isNotNull())
          .groupBy(*group_cols, F.col(key).alias("_k"))
          .agg(F.sum(w).cast("long").alias("_c")))
    # Partition count left to AQE: coalescing merges adjacent ranges, so
    # partition ids stay in key order.  The session setting bounds it.
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rp = (vc.repartitionByRange(*group_cols, "_k")
          .sortWithinPartitions(*group_cols, "_k")
          .withColumn("_pid", F.spark_partition_id()))
    schema = T.StructType(rp.schema.fields + [T.StructField("_lb", T.LongType())])
    shared_dir(spark)  # make sure a reliable checkpoint folder is set
    local = rp.mapInPandas(_running_below(group_cols), schema).checkpoint()
    tot = local.groupBy("_pid", *group_cols).agg(F.sum("_c").alias("_t"))
    before = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group_cols)
    off = (tot.withColumn("_off", F.coalesce(F.sum("_t").over(before), F.lit(0)))
           .withColumn("_n", F.sum("_t").over(whole)).drop("_t"))
    off_bound = None if group_bound is None else n_parts + group_bound
    ranked = (local.join(bounded(off, off_bound), ["_pid", *group_cols])
              .select(*group_cols, F.col("_k").alias(key),
                      (F.col("_lb") + F.col("_off")).alias(out), F.col("_n"), F.col("_c")))
    if next_out:
        # With unit weights the next larger key is the distinct key whose
        # count below equals this key's count below plus its multiplicity:
        # one equi-join of the distinct keys with themselves.
        nxt = ranked.select(*group_cols, F.col(out).alias("_at"), F.col(key).alias(next_out))
        ranked = (ranked.withColumn("_at", F.col(out) + F.col("_c"))
                  .join(nxt, [*group_cols, "_at"], "left").drop("_at"))
    res = df.join(ranked.drop("_c"), [*group_cols, key], "left")
    # the group total travels with every ranked key (NULL for a NULL key)
    return res.withColumnRenamed("_n", n_out) if n_out else res.drop("_n")


def value_rank(df: DataFrame, group_cols, key: str, descending: bool = False,
               group_bound: int | None = None, next_out: str | None = None) -> DataFrame:
    """SQL ``rank()`` (1 + rows strictly ahead) and ``percent_rank`` of
    ``key`` within each group; NULL keys get NULL."""
    k = key
    if descending:
        df = df.withColumn("_neg", -F.col(key))
        k = "_neg"
    r = count_below(df, group_cols, k, out="_below", n_out="_n",
                    group_bound=group_bound, next_out=next_out)
    nn = F.col("_n")
    r = (r.withColumn("rank", (F.col("_below") + 1).cast("int"))
         .withColumn("percent_rank",
                     F.when(F.col("_below").isNull(), F.lit(None).cast("double"))
                     .when(nn <= 1, F.lit(0.0))
                     .otherwise(F.col("_below") / (nn - 1))))
    return r.drop("_below", "_n", "_neg")
