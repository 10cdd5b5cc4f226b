"""Places of rows in an order, found in parallel whatever the order's values are."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W


def numbered(rows: DataFrame, group: str, order: Sequence[str], base: str) -> DataFrame:
    """``rows`` plus ``rank`` (from 0) of each row in its group by ``order``, and the group's ``total``.

    Range partitions are sorted and numbered in one pass and written; a
    partition's offset in a group is the sum of the counts of those before it.
    """
    tie = F.monotonically_increasing_id().alias("tie")
    by = [F.col(c).asc_nulls_first() for c in (group, *order, "tie")]
    ranged = rows.select("*", tie).repartitionByRange(*by).sortWithinPartitions(*by).drop("tie")
    schema = T.StructType([*ranged.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("pos", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held, count = None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            g = batch.column(batch.schema.get_field_index(group))
            same = np.zeros(n, dtype=bool)
            if n > 1:
                a, b = g.slice(0, n - 1), g.slice(1)
                equal = np.asarray(pc.fill_null(pc.equal(a, b), False))
                same[1:] = equal | (np.asarray(a.is_null()) & np.asarray(b.is_null()))
            first = g[0].as_py()
            same[0] = held is not None and held[0] == first
            starts = np.where(same, -1, np.arange(n))
            begin = np.maximum.accumulate(starts)
            pos = np.where(begin < 0, np.arange(n) + count, np.arange(n) - begin)
            held, count = (g[n - 1].as_py(),), int(pos[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(pos.astype(np.int64))],
                                             [*batch.schema.names, "part", "pos"])

    path = f"{base}/numbered-{uuid.uuid4().hex}"
    ranged.mapInArrow(run, schema).write.parquet(path)
    spark = rows.sparkSession
    written = spark.read.schema(schema).parquet(path)
    counts = written.groupBy(group, "part").agg((F.max("pos") + 1).alias("n"))
    within = W.partitionBy(group)
    offsets = counts.select(F.col(group).alias("_g"), F.col("part").alias("_p"), F.sum("n").over(within).alias("total"),
                            F.coalesce(F.sum("n").over(within.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    joined = written.join(offsets, written[group].eqNullSafe(F.col("_g")) & (F.col("part") == F.col("_p")))
    return joined.withColumn("rank", F.col("before") + F.col("pos")).drop("part", "pos", "_g", "_p", "before")
