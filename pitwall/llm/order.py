"""A total order of rows: a unique, non-null number that ascends with a table's id."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.llm.tables import stored


def ordered(
    rows: DataFrame, id_name: str = "doc_id", payload: str = "text", kind: str = "string", whole: bool = False
) -> DataFrame:
    """The id (long), the payload, and ``ord``: the id itself where ids are unique and never null.

    With whole, ``row`` holds all columns of the given row.

    Else rows are numbered in order of id (nulls first) and then of payload (nulls first), so
    rows with one id are rows of their own, one after the other.
    """
    row = [F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("row")] if whole else []
    rows = rows.select(F.col(id_name).cast("long").alias(id_name), F.col(payload).cast(kind).alias(payload), *row)
    odd = rows.groupBy(id_name).count().where(f"count > 1 OR {id_name} IS NULL")
    if odd.isEmpty():
        return rows.withColumn("ord", F.col(id_name))
    keys = [F.asc_nulls_first(id_name), F.asc_nulls_first(payload)]
    in_order = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return stored(in_order.withColumn("ord", F.monotonically_increasing_id()), "ordered")
