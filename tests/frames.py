"""What the tests share besides fixtures."""


def rows(df):
    """The rows as plain tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
