"""What tests share."""

import math

SMALL, DATA = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def plain(v):
    """Values alike in both engines."""
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return int(v) if v == int(v) else round(v, 9)
    return v


def same(df, duck, sql):
    """Asserts that a frame and a statement have the same columns and rows."""
    cols = sorted(df.columns)
    other = duck.sql(sql)
    assert sorted(other.columns) == cols
    ours = sorted(repr(tuple(map(plain, r))) for r in df.select(*[f"`{c}`" for c in cols]).collect())
    theirs = sorted(repr(tuple(map(plain, r))) for r in other.select(*[f'"{c}"' for c in cols]).fetchall())
    assert ours == theirs
