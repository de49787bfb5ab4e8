"""Run a registered query on Spark and its oracle on DuckDB, then compare
row count, column names and the multiset of rows (floats to 6 places)."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT",
                 "date": "DATE", "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP"}


def compare(spark, con, name: str, sf_dir: str, query, sql: str) -> dict:
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in sdf.schema.fields}
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.sql(sql)
    d_cols = list(res.columns)
    d_types = {c: str(t) for c, t in zip(res.columns, res.types)}
    d_rows = res.fetchall()
    t2 = time.time()
    out = {"name": name, "spark_rows": len(s_rows), "duck_rows": len(d_rows),
           "cols_match": sorted(s_cols) == sorted(d_cols), "spark_s": round(t1 - t0, 2),
           "duck_s": round(t2 - t1, 2)}
    out["types_match"] = s_types == d_types
    if not out["types_match"]:
        out["types"] = {c: (s_types.get(c), d_types.get(c)) for c in s_types if s_types.get(c) != d_types.get(c)}
    if out["cols_match"]:
        a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
        out["values_match"] = a == b
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:1]
            out["first_diff"] = repr(diff)[:600]
    else:
        out["values_match"] = False
        out["cols"] = (s_cols, d_cols)
    return out


def main(argv):
    sys.path.insert(0, ".")
    from parallex.plans.oracle import ORACLE
    from parallex.plans.queries import QUERIES
    from parallex.session import get_spark
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2].split(",") if len(argv) > 2 else list(QUERIES)
    spark = get_spark("local[8]", 8)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        if n not in ORACLE:
            print(f"SKIP {n} (no oracle)", flush=True)
            continue
        try:
            r = compare(spark, con, n, sf_dir, QUERIES[n], ORACLE[n])
        except Exception as e:  # report and continue
            r = {"name": n, "error": f"{type(e).__name__}: {str(e)[:800]}"}
        ok = r.get("values_match") and r.get("types_match") and r.get("spark_rows") == r.get("duck_rows")
        bad += not ok
        print(("PASS " if ok else "FAIL ") + repr(r), flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
    return bad


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
