"""Run queries against their SQL on DuckDB: ``python -m workload.check [names]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb

from rateflow.session import build_session
from workload.oracle import oracle_sql
from workload.queries import REGISTRY

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def main(names: list[str]) -> int:
    sf_dir = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    spark = build_session(
        master=f"local[{os.environ.get('BENCH_CPUS', '8')}]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS FROM '{sf_dir}/{table}.parquet'")
    failures = 0
    for name in names or list(REGISTRY):
        start = time.time()
        try:
            message = compare(spark, connection, name, sf_dir)
        except Exception as error:  # report and go on to the next query
            message = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        failures += not message.startswith("ok")
        print(f"{name:32s} {time.time() - start:6.2f}s {message}", flush=True)
    print(f"{failures} failures")
    return failures


def compare(spark, connection, name: str, sf_dir: str) -> str:
    ours = REGISTRY[name](spark, sf_dir).toArrow()
    theirs = connection.sql(oracle_sql()[name]).to_arrow_table()
    columns = sorted(ours.column_names)
    if columns != sorted(theirs.column_names):
        return f"COLUMNS {columns} / {sorted(theirs.column_names)}"
    types = [
        f"{c}: {ours.schema.field(c).type} / {theirs.schema.field(c).type}"
        for c in columns
        if ours.schema.field(c).type != theirs.schema.field(c).type
        and {str(ours.schema.field(c).type), str(theirs.schema.field(c).type)} != {"string", "large_string"}
    ]
    if types:
        return f"TYPES {types}"
    a = sorted(map(repr, zip(*[ours.column(c).to_pylist() for c in columns])))
    b = sorted(map(repr, zip(*[theirs.column(c).to_pylist() for c in columns])))
    if a != b:
        only = [x for x in zip(a, b) if x[0] != x[1]]
        return f"ROWS {len(a)} / {len(b)}; first difference {only[:2]}"
    return f"ok {len(a)} rows"


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1:])))
