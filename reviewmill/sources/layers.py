"""Bronze, silver and gold layers as Parquet tables.

Silver and gold are written once and then only read, so a split refers to the same rows in every
later run. Rows are addressed by ``row_id``, never by position.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.functions.labels import scheme_labels
from reviewmill.operators.cleaning import clean_reviews
from reviewmill.operators.contract import check_contract
from reviewmill.operators.splitting import leading_shares, place_rows, split_cuts
from reviewmill.schema import ROW_ID, SEED, SENTIMENT, SPLIT, SPLITS
from reviewmill.sources.workspace import materialise, path_exists


# The cut points of the splits, in a folder that partition discovery passes over.
CUTS = "_cuts"


class SchemeError(ValueError):
    """The stored labels do not belong to the requested scheme."""


class IncompleteTable(RuntimeError):
    """A folder whose write did not finish."""


def is_present(spark: SparkSession, path: str) -> bool:
    """Whether a finished table is at ``path``; a folder that a broken write left behind is an error."""
    if not path_exists(spark, path):
        return False
    if not path_exists(spark, f"{path}/_SUCCESS"):
        raise IncompleteTable(f"{path} has no _SUCCESS file: its write did not finish; remove it and build it again")
    return True


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None if there is no such path."""
    return spark.read.parquet(path) if is_present(spark, path) else None


def bronze_table(raw: DataFrame, path: str) -> DataFrame:
    """Turn the CSV scan into Parquet once: multi-line CSV cannot be split, Parquet can.

    The rating contract is checked on the Parquet column, so the CSV is read a single time: scan it
    with ``validate=False``.
    """
    found = read_if_present(raw.sparkSession, path)
    if found is None:
        raw.write.mode("errorifexists").parquet(path)
        found = raw.sparkSession.read.schema(raw.schema).parquet(path)
    check_contract(found)
    return found


def build_silver(raw: DataFrame, path: str, *, scheme: str = "three_class", overwrite: bool = False) -> None:
    """Clean the raw reviews and write them; an existing table is an error unless ``overwrite``."""
    mode = "overwrite" if overwrite else "errorifexists"
    clean_reviews(raw, scheme).write.mode(mode).parquet(path)


def load_silver(
    spark: SparkSession,
    path: str,
    *,
    scheme: str = "three_class",
    raw: Callable[[], DataFrame] | None = None,
) -> DataFrame:
    """Read silver, building it from ``raw()`` if absent; labels of another scheme are an error."""
    expected = scheme_labels(scheme)
    silver = read_if_present(spark, path)
    if silver is None:
        if raw is None:
            raise FileNotFoundError(f"no silver table at {path} and no raw table to build it from")
        build_silver(raw(), path, scheme=scheme)
        silver = spark.read.parquet(path)
    stored = silver.agg(F.sort_array(F.collect_set(SENTIMENT)).alias("labels")).first()["labels"]
    if stored != expected:
        raise SchemeError(f"{path} holds labels {stored}; scheme {scheme!r} has {expected}")
    return silver


def save_splits(assigned: DataFrame, path: str, *, seed: int = SEED) -> None:
    """Write ``(row_id, seed)`` partitioned by split, so that one split is read without the others."""
    keys = assigned.select(ROW_ID, F.lit(seed).alias("seed"), SPLIT)
    keys.write.mode("errorifexists").partitionBy(SPLIT).parquet(path)


def load_splits(spark: SparkSession, path: str) -> DataFrame:
    """``(row_id, split, seed)`` as saved."""
    if not is_present(spark, path):
        raise FileNotFoundError(f"no splits at {path}")
    schema = f"{ROW_ID} long, seed int, {SPLIT} string"
    return spark.read.schema(schema).parquet(path).select(ROW_ID, SPLIT, "seed")


def build_splits(
    spark: SparkSession,
    silver_path: str,
    gold_path: str,
    *,
    scheme: str = "three_class",
    seed: int = SEED,
    raw: Callable[[], DataFrame] | None = None,
) -> DataFrame:
    """Silver and gold, each written only if absent; returns silver as read back from storage."""
    silver = load_silver(spark, silver_path, scheme=scheme, raw=raw)
    if not is_present(spark, gold_path):
        keys = silver.select(ROW_ID, SENTIMENT).where(F.col(SENTIMENT).isin(*scheme_labels(scheme)))
        cuts = materialise(split_cuts(keys, leading_shares(0.15, 0.15), seed=seed), "split-cuts")
        save_splits(place_rows(keys, cuts, seed=seed), gold_path, seed=seed)
        cuts.withColumn("seed", F.lit(seed)).coalesce(1).write.parquet(f"{gold_path}/{CUTS}")
    return silver


def with_saved_splits(silver: DataFrame, gold_path: str) -> DataFrame:
    """Silver with the saved ``split`` of each row, found while silver is scanned.

    The cut points beside the splits place a row by its hash, so no text is shuffled for it.
    """
    spark = silver.sparkSession
    if not is_present(spark, f"{gold_path}/{CUTS}"):
        raise FileNotFoundError(f"no cut points at {gold_path}/{CUTS}")
    cuts = spark.read.parquet(f"{gold_path}/{CUTS}")
    seed = cuts.select("seed").first()
    return place_rows(silver, cuts.drop("seed"), seed=seed["seed"] if seed else SEED)


def split_rows(silver: DataFrame, splits: DataFrame, name: str) -> DataFrame:
    """The silver rows of one split: by its own ``split`` column if it has one, else by key lookup."""
    if name not in SPLITS:
        raise ValueError(f"unknown split {name!r}; known: {list(SPLITS)}")
    if SPLIT in silver.columns:
        return silver.where(F.col(SPLIT) == name).drop(SPLIT)
    return silver.join(splits.where(F.col(SPLIT) == name).select(ROW_ID), ROW_ID)


def all_split_rows(silver: DataFrame, splits: DataFrame) -> DataFrame:
    """Silver with the split of each row."""
    if SPLIT in silver.columns:
        return silver
    return silver.join(splits.select(ROW_ID, SPLIT), ROW_ID)
