"""Tables in which rows are looked up by a join."""

from pyspark.sql import DataFrame

# Rows of a table that Spark may still send to every task, by way of the driver's memory. It judges a
# table by its stored bytes, and compressed records take some fifty times as much there.
BROADCAST_ROWS = 100_000


def looked_up(df: DataFrame, n_rows: int, join: str = "shuffle_hash") -> DataFrame:
    """The table as the next join is to take it: as Spark likes if it is small, else by a shuffle.

    ``n_rows`` is the number of its rows, or more. A hash table per partition needs keys that
    are not repeated often; a ``merge`` join may spill.
    """
    return df if n_rows <= BROADCAST_ROWS else df.hint(join)
