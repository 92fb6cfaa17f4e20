"""Helper of the test modules, importable by its own name from every test folder."""


def rows(df):
    return [tuple(r) for r in df.collect()]
