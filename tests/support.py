"""What several test modules share."""


def values(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
