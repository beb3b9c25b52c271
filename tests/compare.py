"""Runs registered queries and their SQL on the same tables and compares the rows."""

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(rows):
    def cell(v):
        if isinstance(v, float):
            return None if math.isnan(v) else repr(v + 0.0)
        return v if v is None or isinstance(v, (str, bool)) else repr(v)

    return sorted(map(str, (tuple(cell(v) for v in row) for row in rows)))


def compare(spark, con, sf_dir, make, sql):
    """None if equal, else what differs."""
    df = make(spark, sf_dir)
    names = sorted(df.columns)
    ours = normal(tuple(r) for r in df.select(names).collect())
    if sql is None:
        return None if ours is not None else "no rows"
    result = con.sql(sql)
    if sorted(result.columns) != names:
        return f"columns {names} / {sorted(result.columns)}"
    theirs = normal(result.select(", ".join(f'"{n}"' for n in names)).fetchall())
    if ours != theirs:
        only = [r for r in ours if r not in set(theirs)][:3], [r for r in theirs if r not in set(ours)][:3]
        return f"rows {len(ours)} / {len(theirs)}; only ours {only[0]}; only theirs {only[1]}"
    kinds = {n: df.schema[n].dataType.simpleString() for n in names}
    want = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}
    odd = {n: (kinds[n], str(t)) for n, t in zip(result.columns, result.types) if want.get(str(t), str(t)) != kinds[n]}
    return f"types {odd}" if odd else None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from landstrata.session import local_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark, con = local_session(8), connect(sf_dir)
    sqls, bad = entry.oracle_sql(), 0
    for name, make in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        began = time.time()
        try:
            problem = compare(spark, con, sf_dir, make, sqls.get(name))
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        print(f"{name:32s} {'ok' if problem is None else 'BAD ' + problem} {time.time() - began:.1f}s{'' if name in sqls else ' (rows only)'}", flush=True)
    print("bad:", bad)
