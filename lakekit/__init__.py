"""lakekit: DataFrame operators for building and checking lakehouse data on stock Apache Spark."""
