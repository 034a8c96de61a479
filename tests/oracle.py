"""Running a query and its SQL twin on the same folder and comparing rows."""

import decimal
import glob
import math
import os


def plain(v):
    if v is None or isinstance(v, bool):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def compare(spark, folder, query, sql):
    import duckdb

    con = duckdb.connect()
    for f in glob.glob(folder + "/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    df = query(spark, folder)
    columns = sorted(df.columns)
    ours = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    cursor = con.execute(sql)
    names = [x[0] for x in cursor.description]
    assert sorted(names) == columns
    theirs = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall()), key=repr)
    assert ours == theirs
