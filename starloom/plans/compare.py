"""Side-by-side check of a registered query against its SQL oracle (DuckDB).

Used by the tests and by ``python -m starloom.plans.compare``. Rows are
compared as multisets with columns sorted by name, like the driver does.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import re
import sys
import time
from collections import Counter
from decimal import Decimal

from starloom.sources.tables import TABLES

ORACLE_TABLES = TABLES + ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def _norm(v):
    if isinstance(v, Decimal):
        return ("dec", str(v.normalize()) if v == v.to_integral_value() else str(v))
    if isinstance(v, float):
        return ("f", repr(v))
    if isinstance(v, dt.datetime):
        return ("ts", v.isoformat())
    if isinstance(v, dt.date):
        return ("d", v.isoformat())
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("i", v)
    return ("s", v)


def _multiset(cols: list[str], rows: list[tuple]) -> tuple[list[str], Counter]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], Counter(tuple(_norm(r[i]) for i in order) for r in rows)


_DUCK_TO_SPARK = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "SMALLINT": "smallint",
    "VARCHAR": "string",
    "DATE": "date",
    "BOOLEAN": "boolean",
    "DOUBLE": "double",
    "TIMESTAMP": "timestamp_ntz",
}


def _spark_type_name(duck_type: str) -> str:
    m = re.match(r"DECIMAL\((\d+),\s*(\d+)\)", duck_type)
    return f"decimal({m.group(1)},{m.group(2)})" if m else _DUCK_TO_SPARK.get(duck_type, duck_type)


def _connect(root: str):
    import duckdb

    con = duckdb.connect()
    for t in ORACLE_TABLES:
        path = f"{root.rstrip('/')}/{t}.parquet"
        try:
            con.execute(f"create view {t} as select * from read_parquet('{path}')")
        except Exception:  # table absent at this scale
            pass
    return con


def oracle_rows(root: str, sql: str) -> tuple[list[str], list[tuple]]:
    cur = _connect(root).execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def oracle_types(root: str, sql: str) -> dict[str, str]:
    """Oracle column types, named as Spark names them."""
    rel = _connect(root).sql(sql)
    return {c: _spark_type_name(str(t)) for c, t in zip(rel.columns, rel.types)}


def compare_one(spark, root: str, name: str) -> dict:
    from starloom.plans.registry import REGISTRY

    fn, sql = REGISTRY[name]
    out: dict = {"query": name}
    t0 = time.time()
    df = fn(spark, root)
    rows = [tuple(r) for r in df.collect()]
    out["spark_sec"] = round(time.time() - t0, 2)
    out["spark_rows"] = len(rows)
    if sql is None:
        out["oracle"] = None
        return out
    ocols, orows = oracle_rows(root, sql)
    scols, sset = _multiset(df.columns, rows)
    oc, oset = _multiset(ocols, orows)
    out["oracle_rows"] = len(orows)
    out["columns_match"] = scols == oc
    stypes = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    out["types_match"] = stypes == oracle_types(root, sql)
    out["values_match"] = sset == oset
    if not out["columns_match"]:
        out["spark_columns"], out["oracle_columns"] = scols, oc
    if out["columns_match"] and not out["values_match"]:
        only_s = list((sset - oset).elements())[:3]
        only_o = list((oset - sset).elements())[:3]
        out["only_spark"], out["only_oracle"] = repr(only_s), repr(only_o)
    return out


def main(argv: list[str] | None = None) -> int:
    from starloom.plans.registry import REGISTRY
    from starloom.session import build_session

    ap = argparse.ArgumentParser()
    ap.add_argument("--root", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args(argv)
    spark = build_session()
    names = args.names or list(REGISTRY)
    bad = 0
    for n in names:
        try:
            r = compare_one(spark, args.root, n)
        except Exception as e:  # report and continue
            r = {"query": n, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        ok = r.get("values_match", r.get("oracle", 0) is None and "error" not in r)
        bad += not ok
        print(json.dumps(r, default=str), flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
