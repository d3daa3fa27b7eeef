"""Run registered queries next to their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


def difference(con, df, sql: str) -> str | None:
    got_cols, got = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    want_cols, want = [d[0] for d in cur.description], cur.fetchall()
    if sorted(got_cols) != sorted(want_cols):
        return f"columns {sorted(got_cols)} != {sorted(want_cols)}"
    a, b = _rows(got_cols, got), _rows(want_cols, want)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}; first got {a[:2]} want {b[:2]}"
    for x, y in zip(a, b):
        if x != y or [type(v) for v in x] != [type(v) for v in y]:
            return f"got {x} want {y}"
    return None


def main(sf_dir: str, only: list[str]) -> int:
    from logweir.plans import all_oracles, all_queries
    from logweir.session import build_session

    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = oracle(sf_dir), all_oracles(), 0
    for name, build in all_queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        start = time.time()
        try:
            df = build(spark, sf_dir)
            found = difference(con, df, sqls[name]) if name in sqls else f"no SQL, {df.count()} rows"
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += name in sqls and found is not None
        print(f"{name:45s} {time.time() - start:6.1f}s  {found or 'same'}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.path.insert(0, ".")
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
