"""Run packing and row numbering while tasks fail on their first attempt
(``local[4,4]`` retries them); prints one JSON line of results."""

import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import pandas as pd  # noqa: E402
from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def flaky_codepoints(s: pd.Series) -> pd.Series:
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 1:
        raise RuntimeError("injected task failure")
    return s.map(lambda t: [ord(c) for c in t])


def main():
    spark = (SparkSession.builder.master("local[4,4]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "6")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="scriptorium-retry-"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("WARN")
    from scriptorium.operators import pack as P
    from scriptorium.operators.ordering import global_row_index
    from scriptorium.session import ship_package

    ship_package(spark)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(6, "doc_id")
    toks = docs.select(F.col("doc_id").alias("ord"), flaky_codepoints(F.col("text")).alias("input_ids"))
    packed = P.pack_sequences(toks, 300, n_buckets=5).orderBy("seq_id").collect()
    flat = [x for r in packed for x in r.input_ids]
    ranked = global_row_index(docs.select("doc_id", flaky_codepoints(F.col("text")).alias("ids")),
                              ["doc_id"], n_buckets=5).select("doc_id", "row_index").collect()
    print(json.dumps({"flat": flat, "n": len(packed), "ranks": sorted((r.doc_id, r.row_index) for r in ranked)}))


if __name__ == "__main__":
    main()
