"""Rows of a DataFrame as plain values."""


def by(df, *order):
    """Rows as plain tuples in a fixed order."""
    return [tuple(r) for r in df.orderBy(*order).collect()]
