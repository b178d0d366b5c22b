"""Run registered queries on Spark and DuckDB and compare names, types and every value.

    python tests/parity.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
SAME_TYPE = {"bigint": {"BIGINT"}, "int": {"INTEGER"}, "double": {"DOUBLE"}, "string": {"VARCHAR"},
             "date": {"DATE"}, "boolean": {"BOOLEAN"}}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    key = lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r)
    return [names[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=key)


def compare(df, con, sql: str) -> list[str]:
    """Differences; empty when the results are the same."""
    result = con.execute(sql)
    duck_types = {d[0]: str(d[1]) for d in result.description}
    duck_names, duck = _rows(list(duck_types), result.fetchall())
    spark_names, spark = _rows(df.columns, [tuple(r) for r in df.collect()])
    if duck_names != spark_names:
        return [f"columns {spark_names} != {duck_names}"]
    problems = [f"type of {f.name}: {f.dataType.simpleString()} != {duck_types[f.name]}" for f in df.schema.fields
                if duck_types[f.name] not in SAME_TYPE.get(f.dataType.simpleString(), {duck_types[f.name]})]
    if len(spark) != len(duck):
        problems.append(f"rows {len(spark)} != {len(duck)}")
    different = [(a, b) for a, b in zip(spark, duck) if a != b]
    return problems + [f"{a} != {b}" for a, b in different[:4]]


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from plumbline.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, oracles = connect(sf_dir), entry.queries(), entry.oracle_sql()
    bad = 0
    for name, query in queries.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            if name in oracles:
                problems = compare(query(spark, sf_dir), con, oracles[name])
            else:
                problems = [] if query(spark, sf_dir).collect() is not None else ["no result"]
        except Exception as error:  # report and go on
            problems = [f"{type(error).__name__}: {str(error)[:700]}"]
        bad += bool(problems)
        note = "" if name in oracles else " (no SQL)"
        print(f"{'FAIL' if problems else 'ok  '} {name}{note} {time.time() - start:.1f}s", *problems, sep="\n     ",
              flush=True)
    print(f"{bad} different; SQL without query: {sorted(set(oracles) - set(queries))}")
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    sys.exit(main(args[0] if args else "/root/testdata/sf0.01", args[1:]) > 0)
