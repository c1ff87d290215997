"""Review-table analytics expressed as Spark DataFrame, SQL and ``pyspark.ml`` jobs."""
