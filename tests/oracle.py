"""Compare registered queries with their SQL on DuckDB, value by value."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES.split():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    cells = []
    for name in frame.columns:
        column = frame[name]
        if pd.api.types.is_datetime64_any_dtype(column):
            column = column.astype("datetime64[us]").astype(str)
        cells.append(["NULL" if pd.isna(v) else _text(v) for v in column])
    return sorted(zip(*cells)) if cells else []


def _text(value) -> str:
    if isinstance(value, (bool,)) or type(value).__name__ == "bool_":
        return str(bool(value))
    if isinstance(value, float) or type(value).__name__.startswith("float"):
        return repr(float(value) + 0.0)
    if type(value).__name__.startswith("int"):
        return repr(float(value))
    return str(value)


KINDS = {"b": "bool", "i": "int", "u": "int", "f": "float", "M": "time", "O": "object"}


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(sql_frame.columns)}"
    a, b = _rows(spark_frame), _rows(sql_frame)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)} rows"
    for x, y in zip(a, b):
        if x != y:
            return f"{sorted(spark_frame.columns)}: {x} != {y}"
    return None


def schema_note(df, con, sql: str) -> str:
    """Spark and SQL types side by side, where they differ in kind."""
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
            "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}
    described = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    odd = [f"{c}:{t}/{described.get(c)}" for c, t in df.dtypes if same.get(t) != described.get(c)]
    return f" types {odd}" if odd else ""


def main(argv: list[str]) -> None:
    from __spark_entry__ import oracle_sql, queries
    from tests.conftest import make_session

    sf_dir, wanted = argv[0], argv[1:]
    spark, con, sqls = make_session(), connect(sf_dir), oracle_sql()
    bad = 0
    skip = {a[1:] for a in wanted if a.startswith("-")}
    wanted = [w for w in wanted if not w.startswith("-")]
    for name, run in queries().items():
        if sys.modules[run.__module__].__name__.rsplit(".", 1)[-1] in skip:
            continue
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            frame = df.toPandas()
            took = time.time() - start
            note = "rows only"
            if name in sqls:
                start = time.time()
                note = difference(frame, con.execute(sqls[name]).df()) or "ok"
                note += schema_note(df, con, sqls[name]) + f" [sql {time.time() - start:.1f}s]"
        except Exception as error:  # report every query
            took, note = time.time() - start, f"ERROR {type(error).__name__}: {str(error)[:1500]}"
            frame = pd.DataFrame()
        bad += not note.startswith(("ok", "rows only"))
        print(f"{name:36s} {len(frame):7d} rows {took:6.1f}s  {note}", flush=True)
    print(f"{bad} failing")


if __name__ == "__main__":
    main(sys.argv[1:])
