"""Own operators against the plain form of the same work; prints one JSON line.

    python tools/naive_baseline.py [folder [case ...]]

The plain forms are a row number over all rows in one window, SQL's NOT IN, and a
lineage loop that joins one level of conversions after the other and keeps nothing.
Both forms of a case have to give the same rows, compared by hashes; each time is one
run after a warm-up, to the noop sink.
"""

from __future__ import annotations

import json
import sys
import tempfile
import time
from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shopfloor import views  # noqa: E402
from yieldmill import build_session  # noqa: E402
from yieldmill.operators import joins, keys, lineage  # noqa: E402
from yieldmill.session import drop_scratch  # noqa: E402

LINE = ["l_shipdate", "l_orderkey", "l_linenumber"]


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def keys_plain(spark: SparkSession, folder: str) -> DataFrame:
    rows = read(spark, folder, "lineitem").select(*LINE, "l_quantity")
    return rows.withColumn("key", F.row_number().over(Window.orderBy(*LINE)).cast("long"))


def keys_own(spark: SparkSession, folder: str) -> DataFrame:
    rows = read(spark, folder, "lineitem").select(*LINE, "l_quantity")
    return keys.number_rows(rows, LINE, "key")


def returned(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "lineitem").where("l_returnflag = 'R'").select("l_orderkey")


def not_in_plain(spark: SparkSession, folder: str) -> DataFrame:
    read(spark, folder, "orders").createOrReplaceTempView("_orders")
    returned(spark, folder).createOrReplaceTempView("_returned")
    return spark.sql("SELECT o_orderkey FROM _orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM _returned)")


def not_in_own(spark: SparkSession, folder: str) -> DataFrame:
    orders = read(spark, folder, "orders").select("o_orderkey")
    return joins.not_in(orders, "o_orderkey", returned(spark, folder))


def lineage_plain(spark: SparkSession, folder: str) -> DataFrame:
    links = views.edges(spark, folder).select("RUN_NO", "FROM_RUN").dropna().distinct()
    levels = [links]
    while True:
        step = links.select(F.col("FROM_RUN").alias("_mid"), F.col("RUN_NO").alias("_run"))
        last = levels[-1].join(step, F.col("RUN_NO") == F.col("_mid")).select(F.col("_run").alias("RUN_NO"), "FROM_RUN")
        if last.isEmpty():
            break
        levels.append(last)
    return reduce(DataFrame.unionByName, levels).groupBy("FROM_RUN").agg(F.max("RUN_NO").alias("RUN_NO"))


def lineage_own(spark: SparkSession, folder: str) -> DataFrame:
    links = views.edges(spark, folder).select("RUN_NO", "FROM_RUN").dropna()
    return lineage.last_descendants(links).select("FROM_RUN", "RUN_NO")


CASES: dict[str, tuple[Callable, Callable]] = {
    "dense_keys": (keys_plain, keys_own),
    "not_in": (not_in_plain, not_in_own),
    "lineage": (lineage_plain, lineage_own),
}


def digest(rows: DataFrame) -> tuple:
    columns = sorted(rows.columns)
    value = F.xxhash64(*columns).cast("decimal(38,0)")
    return tuple(rows.agg(F.count("*"), F.sum(value)).first())


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    settings = {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false",
                "spark.checkpoint.dir": tempfile.mkdtemp(prefix="baseline-")}
    spark = build_session("baseline", "local[8]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in sys.argv[2:] or CASES:
        forms = CASES[name]
        if digest(forms[0](spark, folder)) != digest(forms[1](spark, folder)):
            raise SystemExit(f"{name}: the two forms differ")
        times[name] = []
        for form in forms:
            start = time.perf_counter()
            form(spark, folder).write.format("noop").mode("overwrite").save()
            times[name].append(round(time.perf_counter() - start, 2))
    print(json.dumps({"seconds, plain and own": times, "sf": Path(folder).name}))
    drop_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
