"""Compare a DataFrame with SQL."""

from pathlib import Path

import duckdb
from conftest import SF


def plain(value):
    return round(value, 9) if isinstance(value, float) else value


def order(row):
    return tuple((v is None, str(v)) for v in row)


def agrees(df, sql, tables=None):
    """Rows of ``df``, equal to ``sql`` over ``tables`` (or those of the smallest data)."""
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    for name, arrow in (tables or {}).items():
        con.execute(f"drop view {name}")
        con.register(name, arrow)
    columns = sorted(df.columns)
    got = [tuple(plain(r[c]) for c in columns) for r in df.collect()]
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = [tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall()]
    assert sorted(got, key=order) == sorted(want, key=order)
    return got
