"""Runs registered queries beside their SQL and compares the values.

``python tests/compare.py [sf_dir] [query …]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from datetime import datetime
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
         "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, datetime):
        return value.replace(tzinfo=None)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda r: [(v is None, str(v)) for v in r])


def differences(df, con, sql: str) -> list[str]:
    relation = con.sql(sql)
    spark_types = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    sql_types = dict(zip(relation.columns, map(str, relation.types)))
    found = [] if spark_types == sql_types else [f"types {spark_types} / {sql_types}"]
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    theirs = _rows(relation.columns, relation.fetchall())
    if len(ours) != len(theirs):
        found.append(f"rows {len(ours)} / {len(theirs)}")
    unequal = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if unequal:
        found.append(f"{len(unequal)} rows differ, first {unequal[0]}")
    return found


def main() -> None:
    from plumbline import catalog, oracle
    from tests.sessions import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con, sqls = local_session(), connect(sf_dir), oracle.oracle_sql()
    bad = 0
    for key in sys.argv[2:] or catalog.QUERIES:
        start = time.time()
        try:
            found = differences(catalog.QUERIES[key](spark, sf_dir), con, sqls[key])
        except Exception as error:
            found = [str(error)[:600]]
        bad += bool(found)
        print(f"{'DIFF' if found else 'ok  '} {key} {time.time() - start:.2f}s {' | '.join(found)[:900]}", flush=True)
    print("different:", bad, "missing sql:", set(catalog.QUERIES) - set(sqls), "extra:", set(sqls) - set(catalog.QUERIES))


if __name__ == "__main__":
    main()
