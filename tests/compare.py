"""Run registered queries in Spark and their oracle SQL in DuckDB, and
compare row count, column names and values (order-insensitive).

    python tests/compare.py /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


# Spark type names -> DuckDB type names, for the schema check
SPARK_TO_DUCK = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT", "binary": "BLOB", "date": "DATE",
    "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP",
}


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        if v.is_integer() and abs(v) < 2**53:
            return (4, str(int(v)))
        return (1, f"{v:.9g}")
    if isinstance(v, (bytes, bytearray, memoryview)):
        return (2, bytes(v).hex())
    if isinstance(v, bool):
        return (3, str(v))
    return (4, str(v))


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(None if (isinstance(x, float) and math.isnan(x) and False) else x) for x in rec))
    return cols, sorted(out)


def compare(spark, con, sf_dir: str, key: str, fn, sql: str | None) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    pdf = sdf.toPandas()
    t1 = time.time()
    res = {"key": key, "spark_rows": len(pdf), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    rel = con.sql(sql)
    otypes = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    stypes = dict(sdf.dtypes)
    type_diff = [c for c in sorted(set(otypes) | set(stypes)) if SPARK_TO_DUCK.get(stypes.get(c), stypes.get(c)) != otypes.get(c)]
    odf = rel.df()
    res["oracle_rows"] = len(odf)
    res["oracle_sec"] = round(time.time() - t1, 2)
    # pandas turns NULL ints into floats with NaN: normalise both sides alike
    pdf = pdf.astype(object).where(pdf.notna(), None)
    odf = odf.astype(object).where(odf.notna(), None)
    sc, sr = rows_of(pdf)
    oc, orows = rows_of(odf)
    if sc != oc:
        res["status"] = f"columns differ: {sc} vs {oc}"
    elif type_diff:
        res["status"] = f"types differ: {[(c, stypes.get(c), otypes.get(c)) for c in type_diff]}"
    elif len(sr) != len(orows):
        res["status"] = "row count differs"
    elif sr != orows:
        diff = [(a, b) for a, b in zip(sr, orows) if a != b][:2]
        res["status"] = f"values differ, e.g. {diff}"
    else:
        res["status"] = "ok"
    return res


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from bucketvote.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    if os.environ.get("COMPARE_PLAIN_SESSION"):
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
    else:
        spark = local_session(8)
    con = duck(sf_dir)
    qs, os_ = queries(), oracle_sql()
    bad = 0
    for k in keys or list(qs):
        try:
            r = compare(spark, con, sf_dir, k, qs[k], os_.get(k))
        except Exception as e:  # report and go on
            r = {"key": k, "status": f"error: {type(e).__name__}: {str(e)[:300]}"}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"mismatches: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
