"""Run registered queries beside their SQL and compare the rows."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def _rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    return sorted((tuple(str(v) if v is not None else "\0" for v in r) for r in frame.itertuples(index=False)))


def difference(spark_frame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both have the same columns and rows, else a short description."""
    types = {f.name: f.dataType.simpleString() for f in spark_frame.schema}
    got = pd.DataFrame([tuple(r) for r in spark_frame.collect()], columns=spark_frame.columns, dtype=object)
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    kinds = {c[0]: str(c[1]).lower() for c in result.description}
    want = pd.DataFrame(result.fetchall(), columns=names, dtype=object)
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(set(got.columns) ^ set(want.columns))}"
    matching = {"bigint": {"bigint", "number"}, "int": {"integer", "number", "int"}}
    for n in names:
        if types[n] in matching and kinds[n] not in matching[types[n]]:
            return f"type of {n}: {types[n]} / {kinds[n]}"
    a, b = _rows(got), _rows(want)
    if a == b:
        return None
    only_a = [r for r in a if r not in set(b)][:2]
    only_b = [r for r in b if r not in set(a)][:2]
    return f"rows {len(a)} / {len(b)}\n  columns {sorted(names)}\n  spark {only_a}\n  sql   {only_b}"


def main(sf_dir: str, picked: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from grainmill.plans.catalog import CATALOG
    from grainmill.session import local_session

    spark, con, bad = local_session(8), connect(sf_dir), 0
    for name, query in CATALOG.items():
        if picked and name not in picked:
            continue
        start = time.time()
        try:
            frame = query.run(spark, sf_dir)
            problem = difference(frame, con, query.sql) if query.sql else f"no SQL, {frame.count()} rows"
            n = None
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:32s} {time.time() - start:6.2f}s {'ok' if problem is None else problem}", flush=True)
    print(f"{bad} of {len(picked or CATALOG)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
