"""Compare output column types of every query with its oracle SQL.

    python tools/schema_check.py [sf_dir] [name ...]

Types are compared by family (integer width, floating, string, boolean,
date, timestamp, list, map); prints mismatches only.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from barsmith import get_session  # noqa: E402
from barsmith.plans.registry import all_oracles, all_queries  # noqa: E402
from barsmith.sources.tables import TABLES  # noqa: E402

SPARK = {"bigint": "int64", "int": "int32", "smallint": "int16", "tinyint": "int8", "double": "float64",
         "float": "float32", "string": "string", "boolean": "bool", "date": "date",
         "timestamp": "timestamp", "timestamp_ntz": "timestamp"}
DUCK = {"BIGINT": "int64", "INTEGER": "int32", "SMALLINT": "int16", "TINYINT": "int8", "DOUBLE": "float64",
        "FLOAT": "float32", "VARCHAR": "string", "BOOLEAN": "bool", "DATE": "date", "TIMESTAMP": "timestamp",
        "HUGEINT": "int128", "DECIMAL": "decimal", "UBIGINT": "uint64"}


def fam_spark(t: str) -> str:
    if t.startswith("array<"):
        return "list<" + fam_spark(t[6:-1]) + ">"
    if t.startswith("map<"):
        return "map"
    return SPARK.get(t, t)


def fam_duck(t: str) -> str:
    if t.endswith("[]"):
        return "list<" + fam_duck(t[:-2]) + ">"
    if t.startswith("MAP("):
        return "map"
    if t.startswith("DECIMAL"):
        return "decimal"
    return DUCK.get(t, t)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 and os.path.isdir(sys.argv[1]) else "/root/testdata/sf0.01"
    names = [a for a in sys.argv[1:] if not os.path.isdir(a)]
    spark = get_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, os_ = all_queries(), all_oracles()
    bad = 0
    for name, sql in os_.items():
        if names and name not in names:
            continue
        df = qs[name](spark, sf)
        s = {f.name: fam_spark(f.dataType.simpleString()) for f in df.schema.fields}
        rel = con.sql(sql)
        d = {c: fam_duck(str(t)) for c, t in zip(rel.columns, rel.types)}
        diff = {c: (s.get(c), d.get(c)) for c in set(s) | set(d) if s.get(c) != d.get(c)}
        if diff:
            bad += 1
            print(f"TYPES {name}: {diff}", flush=True)
    print(f"type mismatches in {bad} of {len(names) if names else len(os_)} queries")


if __name__ == "__main__":
    main()
