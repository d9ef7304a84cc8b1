"""Compares a query's rows with its SQL's, in any order."""

import datetime
import decimal


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return float(f"{v:.10g}")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def ordered(rows):
    return sorted((tuple(plain(x) for x in r) for r in rows), key=lambda r: [(x is None, str(x)) for x in r])


def same(df, con, sql):
    columns = sorted(df.columns)
    found = con.sql(sql)
    assert columns == sorted(found.columns)
    ours = ordered(df.select(*[f"`{c}`" for c in columns]).collect())
    theirs = ordered(con.sql("SELECT " + ", ".join(f'"{c}"' for c in columns) + f" FROM ({sql})").fetchall())
    assert ours == theirs
