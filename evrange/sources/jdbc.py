"""Reading and writing through JDBC; connection settings are the caller's."""

from pyspark.sql import DataFrame, SparkSession

from .staging import Staging

BATCH_ROWS = 1000  # fixed value: rows per insert batch


def read_jdbc(spark: SparkSession, options: dict, table: str, schema: str = None,
              split: tuple = None, fetch_rows: int = 10_000) -> DataFrame:
    """A database table. Filters and column lists of later steps are pushed into its query.

    `split` = (column, lower, upper, partitions) reads in parallel, which large tables
    need: without it one task reads everything. `schema` is a DDL string that overrides
    the types the driver reports.
    """
    reader = (spark.read.format("jdbc").options(**options)
              .option("dbtable", table).option("fetchsize", str(fetch_rows)))
    if schema is not None:
        reader = reader.option("customSchema", schema)
    if split is not None:
        column, lower, upper, partitions = split
        reader = (reader.option("partitionColumn", column).option("lowerBound", str(lower))
                  .option("upperBound", str(upper)).option("numPartitions", str(partitions)))
    return reader.load()


def append_jdbc(rows: DataFrame, options: dict, table: str, connections: int = 16,
                batch_rows: int = BATCH_ROWS) -> None:
    """Append in insert batches over a bounded number of connections.

    `numPartitions` coalesces: the stage before the write runs in as many tasks as there are
    connections. Use `append_jdbc_staged` where that stage is more than a read.
    """
    (rows.write.format("jdbc").options(**options)
     .option("dbtable", table).option("batchsize", str(batch_rows))
     .option("numPartitions", str(connections)).mode("append").save())


def append_jdbc_staged(rows: DataFrame, options: dict, table: str, connections: int = 16,
                       batch_rows: int = BATCH_ROWS, append=append_jdbc) -> None:
    """As `append_jdbc`, for rows that take work: they are written through the shared folder
    first, by as many tasks as they need, and the connections only read and insert."""
    with Staging(rows.sparkSession) as staging:
        append(staging.write_through(rows, "rows"), options, table, connections, batch_rows)
