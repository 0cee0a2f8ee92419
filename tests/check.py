"""Run registered queries against their check SQL in DuckDB: python tests/check.py [prefix ...]."""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None:
        return "\0"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return "0" if v == 0 else f"{v:.10g}"
    if hasattr(v, "is_finite"):
        return f"{float(v):.10g}"
    return str(v)


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else a short description of the difference."""
    got_cols, got = canon(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_cols, want = canon([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
         "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def type_notes(df, con, sql: str) -> str:
    """Columns whose types differ between the two engines."""
    theirs = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return ", ".join(f"{c}: {t} / {theirs[c]}" for c, t in df.dtypes if TYPES.get(t, t) != theirs.get(c))


def main(prefixes) -> int:
    import __spark_entry__ as entry
    from fabspark.session import build_session
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8",
                                                  "spark.driver.memory": "8g",
                                                  "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(SF_DIR)
    oracles, failed = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            df = fn(spark, SF_DIR)
            if name in oracles:
                problem = compare(df, con, oracles[name])
                note = f"ok {con.execute(f'SELECT count(*) FROM ({oracles[name]})').fetchone()[0]}" if problem is None else "DIFF " + problem
                types = type_notes(df, con, oracles[name])
                note += f" (types {types})" if types else ""
            else:
                note = f"ok rows-only {df.count()}"
        except Exception as e:  # report and go on
            note = f"ERROR {type(e).__name__}: {str(e)[:700]}"
        failed += not note.startswith("ok")
        print(f"{time.time() - start:6.2f}s {name}: {note}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
