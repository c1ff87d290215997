from __future__ import annotations

from pyspark.sql import functions as F

from reviewmill.operators import profiling

COLUMNS = ["id", "few", "one", "none", "many"]


def table(spark, low, high):
    return spark.range(low, high).select(
        "id", (F.col("id") % 7).alias("few"), F.lit("x").alias("one"), F.lit(None).cast("string").alias("none"),
        F.when(F.col("id") % 10 > 0, F.floor(F.col("id") / 3)).alias("many"),
    )


def test_merged_loads_stay_within_the_error_of_the_exact_inventory(spark, tmp_path):
    loads = [(0, 30_000), (20_000, 50_000), (50_000, 50_000)]
    for k, (low, high) in enumerate(loads):
        profiling.column_sketches(table(spark, low, high), COLUMNS).write.mode("append").parquet(str(tmp_path / "sketches"))
    stored = spark.read.parquet(str(tmp_path / "sketches"))
    got = {r["column"]: r for r in profiling.approximate_inventory(profiling.merged_sketches(stored), {"few": "group"}).collect()}
    union = table(spark, *loads[0]).unionByName(table(spark, *loads[1]))
    exact = {r["column"]: r for r in profiling.column_inventory(union, COLUMNS, {"few": "group"}).collect()}
    for c in COLUMNS:
        assert abs(got[c]["unique"] - exact[c]["unique"]) <= 3 * profiling.SKETCH_ERROR * exact[c]["unique"]
        for name in ("dtype", "nulls", "pct_null", "constant", "role"):
            assert got[c][name] == exact[c][name]
    assert not got["id"]["unique_key"]  # 10,000 ids came twice


def test_one_load(spark):
    df = table(spark, 0, 20_000)
    got = {r["column"]: r for r in profiling.column_inventory(df, COLUMNS, approximate=True).collect()}
    assert got["id"]["unique_key"] and got["id"]["role"] == "key" and got["none"]["unique"] == 0
    assert not got["many"]["unique_key"] and got["few"]["unique"] == 7
    empty = profiling.column_inventory(df.where("id < 0"), COLUMNS, approximate=True).collect()
    assert all(r["unique"] == 0 and not r["unique_key"] for r in empty)
