"""Run registered queries and their SQL side by side.

    python -m tests.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def frame(columns: list[str], rows: list) -> pd.DataFrame:
    df = pd.DataFrame([tuple(r) for r in rows], columns=columns)
    df = df[sorted(columns)].astype(object)
    df = df.where(df.notna(), None)
    key = df.map(lambda v: (v is None, str(type(v)), v if v is not None else 0)).apply(
        lambda r: str(list(r)), axis=1
    )
    return df.loc[key.sort_values(kind="stable").index].reset_index(drop=True)


def rows_of(con: duckdb.DuckDBPyConnection, sql: str) -> pd.DataFrame:
    con.execute(sql)
    names = [d[0] for d in con.description]
    return frame(names, con.fetchall())


def same(spark_df, con, sql: str) -> tuple[bool, str]:
    ours = frame(spark_df.columns, spark_df.collect())
    theirs = rows_of(con, sql)
    if list(ours.columns) != list(theirs.columns):
        return False, f"columns {list(ours.columns)} / {list(theirs.columns)}"
    if len(ours) != len(theirs):
        return False, f"rows {len(ours)} / {len(theirs)}"
    differing = (ours != theirs) & ~(ours.isna() & theirs.isna())
    if differing.to_numpy().any():
        at = differing.any(axis=1).idxmax()
        return False, f"row {at}: {ours.loc[at].tolist()} / {theirs.loc[at].tolist()}"
    types = [type(v).__name__ for v in ours.iloc[0]] if len(ours) else []
    others = [type(v).__name__ for v in theirs.iloc[0]] if len(theirs) else []
    if types != others:
        return False, f"types {types} / {others}"
    return True, f"{len(ours)} rows"


def main(argv: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry_module
    from tidepair.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session(
        master="local[8]",
        shuffle_partitions=8,
        extra={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql = entry_module.oracle_sql()
    failed = 0
    for name, query in entry_module.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        begin = time.time()
        if name in sql:
            ok, note = same(query(spark, sf_dir), con, sql[name])
        else:
            ok, note = True, f"{query(spark, sf_dir).count()} rows, no SQL"
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:30} {time.time() - begin:6.2f}s {note}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
