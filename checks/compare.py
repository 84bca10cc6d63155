"""Run queries and their SQL side by side: python -m checks.compare [folder] [name ...]"""

import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def difference(spark, query, sql: str, db, folder: str) -> str | None:
    """What differs between both results, or None."""
    df = query(spark, folder)
    ours = df.collect()
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    theirs = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} and {len(theirs)} rows"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN"}
    types = dict(zip(names, (str(d[1]) for d in result.description), strict=True))
    for name, kind in df.dtypes:
        if kinds.get(kind, kind) != types[name]:
            return f"{name} is {kind} and {types[name]}"
    a, b = _rows(df.columns, ours), _rows(names, theirs)
    for x, y in zip(a, b, strict=True):
        if x != y:
            return f"{sum(p != q for p, q in zip(a, b, strict=True))} rows differ, first\n  {x[:300]}\n  {y[:300]}"
    return None


def main() -> None:
    from checks.oracles import oracle_sql
    from checks.queries import QUERIES
    from flowtide.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, db, sql = local_session(), database(folder), oracle_sql()
    bad = 0
    for name in names:
        start = time.time()
        try:
            if name in sql:
                outcome = difference(spark, QUERIES[name], sql[name], db, folder) or "ok"
            else:
                outcome = f"ok, {len(QUERIES[name](spark, folder).collect())} rows, no SQL"
        except Exception as error:  # noqa: BLE001 - report and go on with the next
            outcome = f"{type(error).__name__}: {str(error)[:600]}"
        bad += not outcome.startswith("ok")
        print(f"{name:28s} {time.time() - start:6.2f} s  {outcome}", flush=True)
    print(f"{len(names) - bad} of {len(names)} fine")


if __name__ == "__main__":
    main()
