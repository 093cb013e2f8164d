"""Previous-row lookups that stay balanced under any key skew.

``Window.partitionBy(g).orderBy(t)`` sends a whole group to one task. When a
group, or any time bucket of it, may hold a large share of all rows, the
previous row is found instead over a *global* range-partitioned order:

1. rows are range-partitioned and sorted by (group, order...), so the
   sampled boundaries split a hot group (even a hot instant, through the
   tie-break columns) across many partitions;
2. the sorted frame is checkpointed to the shared checkpoint folder, which
   fixes the partitions for the passes below (and survives executor loss);
3. the last row of every partition (one row per partition) is collected and
   broadcast;
4. a narrow, Arrow-batched pass shifts values within each partition and
   seeds its first row from the last row of the nearest non-empty earlier
   partition when that row belongs to the same group.

No task ever holds more than one range partition, whatever the skew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def previous_values(df: DataFrame, group: str, order: list[str], values: list[str],
                    prefix: str = "prev_") -> DataFrame:
    """Add ``prev_<v>`` = value of ``v`` on the previous row of the same group
    in ``order`` (null on a group's first row)."""
    import pyarrow as pa
    import pyarrow.compute as pc

    from oddsline.session import reliable_checkpoint

    spark = df.sparkSession
    ck = reliable_checkpoint(df, [group, *order])
    tagged = ck.withColumn("_pid", F.spark_partition_id())
    last = F.max_by(F.struct(F.col(group).alias("g"), *[F.col(v).alias(v) for v in values]),
                    F.struct(*[F.col(c) for c in [group, *order]]))
    tails = {r["_pid"]: r["_l"] for r in tagged.groupBy("_pid").agg(last.alias("_l")).collect()}
    carry, prev_tail = {}, None
    for pid in range(max(tails) + 1 if tails else 0):  # one entry per partition
        carry[pid] = prev_tail
        if pid in tails:
            t = tails[pid]
            prev_tail = (t["g"], *[t[v] for v in values])
    carry_b = spark.sparkContext.broadcast(carry)

    out_schema = T.StructType(tagged.schema.fields +
                              [T.StructField(prefix + v, tagged.schema[v].dataType, True) for v in values])

    def shift(batches):
        tail, started = None, False
        for rb in batches:  # one partition's record batches, in sorted order
            if rb.num_rows == 0:
                continue
            if not started:
                tail = carry_b.value.get(rb.column("_pid")[0].as_py())
                started = True
            cols = {name: rb.column(name) for name in rb.schema.names}
            g = cols[group]
            head_g = pa.array([tail[0] if tail else None], type=g.type)
            prev_g = pa.concat_arrays([head_g, g.slice(0, rb.num_rows - 1)])
            # Null groups compare equal (as window partitions do), but a
            # partition with no earlier row has no predecessor at all.
            same = pc.or_(pc.fill_null(pc.equal(g, prev_g), False),
                          pc.and_(pc.is_null(g), pc.is_null(prev_g)))
            if tail is None:
                same = pa.concat_arrays([pa.array([False]), same.slice(1)])
            new = []
            for i, v in enumerate(values):
                a = cols[v]
                head = pa.array([tail[i + 1] if tail else None], type=a.type)
                prev = pa.concat_arrays([head, a.slice(0, rb.num_rows - 1)])
                new.append(pc.if_else(same, prev, pa.nulls(rb.num_rows, type=a.type)))
            last_i = rb.num_rows - 1
            tail = (g[last_i].as_py(), *[cols[v][last_i].as_py() for v in values])
            yield pa.RecordBatch.from_arrays(list(rb.columns) + new,
                                             names=rb.schema.names + [prefix + v for v in values])

    return tagged.mapInArrow(shift, out_schema).drop("_pid")
