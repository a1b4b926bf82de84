"""Global order of rows that repeat often (Q8)."""

from pyspark.sql import DataFrame

from pitwall.functions.conditions import smallest_first
from pitwall.operators.copies import fold_copies, split_chunks, unfold


def sorted_rows(df: DataFrame, order: list[str]) -> DataFrame:
    """All rows of the columns ``order``, sorted by them, NULL last.

    Only distinct rows with counts are shuffled and sorted; chunks of copies may
    fall into different tasks, so a value that holds most rows does not end up in one.
    """
    chunks = split_chunks(fold_copies(df, order))
    in_order = chunks.orderBy(*[smallest_first(chunks[c]) for c in [*order, "chunk_start"]])
    return unfold(in_order, "_place").select(*order)
