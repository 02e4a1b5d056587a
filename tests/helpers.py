"""What several test files use."""


def rows(df, *order):
    """Collected rows as tuples, sorted."""
    got = [tuple(r) for r in (df.select(*order) if order else df).collect()]
    return sorted(got, key=lambda t: tuple((v is None, str(type(v)), v) for v in t))
