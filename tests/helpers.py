"""Helpers of the tests."""


def values(df, *order):
    """Collected rows as tuples, sorted by the given columns or by text."""
    out = [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
    return out if order else sorted(out, key=str)
