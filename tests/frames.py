"""Reading results in tests."""


def rows(df, *order):
    return [row.asDict(recursive=True) for row in (df.orderBy(*order) if order else df).collect()]
