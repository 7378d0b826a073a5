"""Order-insensitive comparison of a Spark result with a DuckDB result."""

import pandas as pd


def _text(v):
    if v is None or v is pd.NA or v is pd.NaT or isinstance(v, float) and v != v:
        return None
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)) or hasattr(v, "dtype"):
        return repr(round(float(v), 6)) if str(v) not in ("True", "False") else str(v)
    if isinstance(v, (list, tuple)):
        return str([_text(x) for x in v])
    return str(v)


def rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(_text(v) for v in r) for r in df[names].astype(object).itertuples(index=False)), key=str)


def assert_same(got, expected):
    a, b = rows(got), rows(expected)
    assert a[0] == b[0]
    assert len(a[1]) == len(b[1])
    assert [x for x, y in zip(a[1], b[1], strict=True) if x != y][:3] == [y for x, y in zip(a[1], b[1], strict=True) if x != y][:3]
