"""What several test modules need besides fixtures."""

from datetime import datetime


def at(text: str | None):
    """'03-02 15:00' as a time in 2024."""
    return None if text is None else datetime.strptime(f"2024-{text}", "%Y-%m-%d %H:%M")


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)


def executed_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
