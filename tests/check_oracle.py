"""Run registered queries next to their SQL: python -m tests.check_oracle [sf dir] [name part ...]"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

from queries.common import REGISTRY, TABLES
from tallymark.session import build_session


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(row) -> tuple:
    def one(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else (0.0 if value == 0 else value)
        return value

    return tuple(one(v) for v in row)


def compare(query, spark, con, sf_dir: str) -> tuple[str, str]:
    """A verdict (ok, near, rows, FAIL) and what differs."""
    names = sorted(c for c, _ in query.out)
    df = query.run(spark, sf_dir).select(*names)
    got = [canonical(r) for r in df.collect()]
    if query.sql is None:
        return "rows", f"{len(got)} rows, no SQL"
    result = con.execute(f"SELECT {', '.join(names)} FROM ({query.oracle()})")
    want = [canonical(r) for r in result.fetchall()]
    if Counter(got) == Counter(want):
        return "ok", f"{len(got)} rows"
    loose = [Counter(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows) for rows in (got, want)]
    verdict = "near" if loose[0] == loose[1] else "FAIL"
    only_got, only_want = Counter(got) - Counter(want), Counter(want) - Counter(got)
    return verdict, f"{len(got)} vs {len(want)} rows, {names}\n   spark {list(only_got)[:2]}\n   sql   {list(only_want)[:2]}"


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    tally = Counter()
    for name, query in REGISTRY.items():
        if wanted and not any(part in name for part in wanted):
            continue
        start = time.time()
        try:
            verdict, detail = compare(query, spark, con, sf_dir)
        except Exception as error:  # noqa: BLE001 - reported per query
            verdict, detail = "ERROR", f"{type(error).__name__}: {str(error)[:600]}"
        tally[verdict] += 1
        print(f"{verdict:5} {time.time() - start:5.1f}s {name}: {detail}", flush=True)
    print(dict(tally))


if __name__ == "__main__":
    main()
