"""Run a query and its SQL side by side and compare rows as multisets."""

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def kind(duck_or_spark):
    """Type names of both engines on one scale."""
    name = str(duck_or_spark).lower()
    names = {"string": "varchar", "int": "integer", "timestamp_ntz": "timestamp"}
    return names.get(name, name)


def compare(spark, sf_dir, query, sql):
    """Differences between both results; empty when they agree."""
    df = query(spark, sf_dir)
    names = sorted(df.columns)
    df = df.select(*[f"`{name}`" for name in names])
    con = connect(sf_dir)
    relation = con.sql(f"select {', '.join(f'{chr(34)}{name}{chr(34)}' for name in names)} from ({sql})")
    problems = []
    if sorted(con.sql(sql).columns) != names:
        problems.append(f"columns {names} / {sorted(con.sql(sql).columns)}")
    types = [(n, kind(a.dataType.simpleString()), kind(b)) for n, a, b in zip(names, df.schema, relation.types)]
    problems += [f"type of {n}: {a} / {b}" for n, a, b in types if a != b]
    got, wanted = Counter(map(tuple, df.collect())), Counter(relation.fetchall())
    if got != wanted:
        extra, missing = got - wanted, wanted - got
        problems.append(f"rows {got.total()} / {wanted.total()}, {extra.total()} differ")
        problems += [f"  spark  {row}" for row in sorted(extra, key=str)[:4]]
        problems += [f"  duckdb {row}" for row in sorted(missing, key=str)[:4]]
    return got.total(), problems


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as contract
    from tillmark.session import local_session

    sf_dir, only = sys.argv[1], sys.argv[2:]
    session = local_session(8)
    sqls = contract.oracle_sql()
    for name, query in contract.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        if name not in sqls:
            print(f"{'ROWS':5} {name} {query(session, sf_dir).count()} rows")
            continue
        try:
            rows, found = compare(session, sf_dir, query, sqls[name])
        except Exception as error:  # report and go on with the next query
            rows, found = 0, [f"{type(error).__name__}: {str(error)[:1500]}"]
        print(f"{'FAIL' if found else 'ok':5} {name} {rows} rows, {time.time() - start:.1f}s", *found, sep="\n", flush=True)
