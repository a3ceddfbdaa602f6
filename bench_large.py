"""Exact sums and sliced ranks against their plain forms, on generated rows.

``BENCH_ROWS`` rows (30 million unless set), one key of which holds a third. Prints one JSON line per
comparison: seconds of the plain form, of ours and their ratio, each the best of ``BENCH_RUNS`` runs.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketfold.functions import amount_mean, amount_sum, amount_total
from marketfold.operators.ranking import add_dense_rank
from marketfold.session import build_session, settings_for


def main() -> None:
    rows = int(os.environ.get("BENCH_ROWS", "30000000"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    scratch = tempfile.mkdtemp(prefix="bench-large-")
    settings = settings_for(rows * 24) | {"spark.sql.shuffle.partitions": str(4 * int(cpus))}
    spark = build_session(
        "marketfold-bench-large",
        master=f"local[{cpus}]",
        **settings,
        **{
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": f"{scratch}/checkpoints",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(rows).selectExpr(
        "IF(id % 3 = 0, 0L, id % 997) AS key",
        "ROUND(RAND(1) * 1e5, 2) AS amount",
        "RAND(2) * 1e9 AS value",
    ).write.parquet(f"{scratch}/rows")
    table = spark.read.parquet(f"{scratch}/rows")

    def plain_sums() -> DataFrame:
        return table.groupBy("key").agg(F.sum("amount").alias("t"), F.avg("amount").alias("m"))

    def exact_sums() -> DataFrame:
        sums = table.groupBy("key").agg(amount_sum("amount").alias("s"))
        return sums.select("key", amount_total("s").alias("t"), amount_mean("s").alias("m"))

    def plain_rank() -> DataFrame:
        return table.withColumn("place", F.dense_rank().over(Window.orderBy(F.desc("value"))))

    def sliced_rank() -> DataFrame:
        return add_dense_rank(table, "place", by="value")

    def plain_group_rank() -> DataFrame:
        window = Window.partitionBy("key").orderBy(F.desc("value"))
        return table.withColumn("place", F.dense_rank().over(window))

    def sliced_group_rank() -> DataFrame:
        return add_dense_rank(table, "place", by="value", within=["key"])

    pairs = {
        "sum and mean by key": (plain_sums, exact_sums),
        "global rank": (plain_rank, sliced_rank),
        "rank by key": (plain_group_rank, sliced_group_rank),
    }
    for name, forms in pairs.items():
        plain, ours = (min(_seconds(form) for _ in range(runs)) for form in forms)
        print(
            json.dumps(
                {
                    "comparison": name,
                    "rows": rows,
                    "plain_s": round(plain, 2),
                    "ours_s": round(ours, 2),
                    "ratio": round(ours / plain, 2),
                }
            ),
            flush=True,
        )
    spark.stop()


def _seconds(form) -> float:
    start = time.perf_counter()
    form().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


if __name__ == "__main__":
    main()
