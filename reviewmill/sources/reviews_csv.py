"""Bronze scan: Latin-1 review CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.operators.contract import check_contract
from reviewmill.schema import REVIEW_COLUMNS, REVIEW_SCHEMA, ROW_ID

ENCODING = "ISO-8859-1"

# Texts a pandas CSV reader takes for NULL by default.
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def largest_csv(spark: SparkSession, folder: str, *, recursive: bool = True) -> DataFrame:
    """The largest ``*.csv`` below ``folder`` as one row ``(path, length)``.

    Only the file listing is read; the content column is pruned from the scan.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", str(recursive).lower())
        .load(folder)
        .select("path", "length")
    )
    biggest = listing.agg(F.max_by(F.struct("path", "length"), F.struct("length", "path")).alias("file"))
    return biggest.where("file is not null").select("file.path", "file.length")


def scan_reviews(
    spark: SparkSession, path: str, *, validate: bool = True, multi_line: bool = True
) -> DataFrame:
    """Read review CSV files with the declared types and a ``row_id`` in file order.

    Quoted line breaks need ``multi_line``, which makes every file one task, so a landing folder
    should hold many files and be turned into Parquet once (see ``layers.bronze_table``).
    """
    as_text = spark.read.options(
        header=True, encoding=ENCODING, multiLine=multi_line, quote='"', escape='"', nullValue="\u0000",
        emptyValue="", enforceSchema=False,
    )
    found = as_text.csv(path)
    if validate:
        check_contract(found, ratings=False)
    nulls = [F.lit(token) for token in NULL_TOKENS]
    typed = [
        F.when(~F.col(f.name).isin(*nulls), F.col(f.name)).cast(f.dataType).alias(f.name)
        for f in REVIEW_SCHEMA.fields
    ]
    rows = found.select(F.monotonically_increasing_id().alias(ROW_ID), *typed)
    if validate:
        check_contract(rows)
    return rows


def write_reviews_csv(df: DataFrame, path: str, *, overwrite: bool = False) -> None:
    """Write the six review columns as Latin-1 CSV; refuses to replace a file unless told to."""
    (
        df.select(*REVIEW_COLUMNS)
        .write.mode("overwrite" if overwrite else "errorifexists")
        .options(
            header=True,
            encoding=ENCODING,
            quote='"',
            escape='"',
            quoteAll=True,
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )
        .csv(path)
    )
