"""Runs queries beside their SQL on DuckDB and compares rows; python -m tests.oracle SF [NAME...]."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb


def canonical(frame):
    frame = frame[sorted(frame.columns)]
    out = []
    for row in frame.itertuples(index=False, name=None):
        out.append(tuple(None if v is None or v != v else round(float(v), 6) if isinstance(v, float) else int(v) if hasattr(v, "__index__") and not isinstance(v, bool) else str(v)[:10] if hasattr(v, "isoformat") and str(v).endswith("00:00:00") else str(v) for v in row))
    return sorted(out, key=repr)


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


def compare(spark, name, query, sql, sf_dir, con) -> str:
    started = time.time()
    got = query(spark, sf_dir).toPandas()
    took = time.time() - started
    rel = con.execute(sql).fetch_df()
    if sorted(got.columns) != sorted(rel.columns):
        return f"columns {sorted(got.columns)} / {sorted(rel.columns)}"
    a, b = canonical(got), canonical(rel.astype(object).where(rel.notna(), None))
    if a != b:
        in_a, in_b = set(a), set(b)
        only_a, only_b = [x for x in a if x not in in_b][:3], [x for x in b if x not in in_a][:3]
        return f"rows {len(a)} / {len(b)}: only here {only_a}, only in SQL {only_b}"
    kinds = {c: (str(got[c].dtype), str(rel[c].dtype)) for c in got.columns if str(got[c].dtype) != str(rel[c].dtype)}
    return f"ok {len(a)} rows, {took:.1f} s" + (f" types {kinds}" if kinds else "")


if __name__ == "__main__":
    import __spark_entry__ as entry
    from annalith.session import build_session

    spark = build_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/{sys.argv[1]}"
    con, queries, oracle = connect(sf_dir), entry.queries(), entry.oracle_sql()
    for name in sys.argv[2:] or oracle:
        try:
            print(name, compare(spark, name, queries[name], oracle[name], sf_dir, con), flush=True)
        except Exception as e:
            print(name, "ERROR", str(e)[:400].replace("\n", " "), flush=True)
