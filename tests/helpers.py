"""What several test modules share; not in conftest, whose module name other test folders use too."""

SF_DIR = "/root/testdata/sf0.001"


def rows_of(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]
