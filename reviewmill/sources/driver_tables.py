"""Review-shaped view over a generic ``documents`` table.

The benchmark tables hold no reviews, so the six review columns are derived from the documents:
the rating follows the language, the month and the branch follow the id, and every fiftieth
document appears twice so that fully duplicated rows occur. Every fortieth document brings one further row
with a fault or an oddity, so that no quality check compares nothing with nothing. No document is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.schema import BRANCH, LOCATION, RATING, REVIEW_ID, ROW_ID, TEXT, YEAR_MONTH
from reviewmill.sources.workspace import spread_small_scan


#: odd rows in order of their kind: the column that is replaced, and by what
ODDITIES = (
    (TEXT, None),
    (TEXT, ""),
    (TEXT, " \t "),
    (TEXT, "123 !!! 45"),
    (RATING, 9),
    (RATING, None),
    (YEAR_MONTH, "2019-13"),
    (TEXT, "SEE https://example.org/a and WWW.example.org \U0001F600"),
    (YEAR_MONTH, "19-4"),
)
EVERY_ODD, FIRST_ODD = 40, 7


def reviews_from_documents(spark: SparkSession, folder: str, *, odd_rows: bool = True) -> DataFrame:
    """The review view of ``documents.parquet`` with a stable ``row_id``; ``odd_rows=False`` leaves out the
    further rows."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang", "source", "text")
    docs = spread_small_scan(docs, "doc_id")
    doc_id, lang = F.col("doc_id"), F.col("lang")
    copies = F.when(doc_id % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    if odd_rows:
        copies = F.when(doc_id % EVERY_ODD == FIRST_ODD, F.concat(copies, F.array(F.lit(2)))).otherwise(copies)
    copied = docs.select("*", F.explode(copies).alias("copy"))
    year = (F.lit(2010) + F.floor((doc_id % 120) / F.lit(12))).cast("int").cast("string")
    month = (F.lit(1) + doc_id % 12).cast("string")
    odd = F.col("copy") == 2
    plain = copied.select(
        F.when(odd, -1 - doc_id).otherwise(doc_id * 2 + F.col("copy")).alias(ROW_ID),
        F.when(odd, F.floor(doc_id / EVERY_ODD) % len(ODDITIES)).alias("kind"),
        doc_id.alias(REVIEW_ID),
        F.when((lang == "en") & (doc_id % 3 == 0), 4)
        .when(lang == "en", 5)
        .when((lang == "es") & (doc_id % 2 == 0), 1)
        .when(lang == "es", 2)
        .otherwise(3)
        .alias(RATING),
        F.when(doc_id % 16 == 0, F.lit("missing"))
        .otherwise(F.concat(year, F.lit("-"), month))
        .alias(YEAR_MONTH),
        F.col("source").alias(LOCATION),
        F.col("text").alias(TEXT),
        F.when(doc_id % 9 < 4, "park_a").when(doc_id % 9 < 7, "park_b").otherwise("park_c").alias(BRANCH),
    )
    kinds = dict(plain.dtypes)

    def replaced(name: str) -> Column:
        value = F.col(name)
        for kind, (column, odd_value) in enumerate(ODDITIES):
            if column == name:
                value = F.when(F.col("kind") == kind, F.lit(odd_value).cast(kinds[name])).otherwise(value)
        return value.alias(name)

    return plain.select(*[replaced(c) for c in plain.columns if c != "kind"])
