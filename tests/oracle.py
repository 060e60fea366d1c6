"""Compare registered queries with their SQL twins: ``python tests/oracle.py sf_dir [names...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0
    return value


def _kind(text: str) -> str:
    text = str(text).lower()
    if any(w in text for w in ("bigint", "long")):
        return "bigint"
    if "int" in text:
        return text if "huge" in text else "int"
    if any(w in text for w in ("double", "float")):
        return "fraction"
    if any(w in text for w in ("char", "string")):
        return "text"
    return text.split("(")[0]


def compare(df, con, sql: str) -> list[str]:
    """Differences between a Spark result and a SQL result; empty when they agree."""
    rows = [tuple(r) for r in df.collect()]
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: _kind(d[1]) for d in cursor.description}
    expected = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    problems = [
        f"type of {c}: {t} against {kinds[c]}" for c, t in df.dtypes if _kind(t) != kinds[c]
    ]
    order = sorted(names)

    def normal(data, columns):
        places = [columns.index(c) for c in order]
        return sorted((tuple(_plain(r[p]) for p in places) for r in data), key=repr)

    left, right = normal(rows, df.columns), normal(expected, names)
    if len(left) != len(right):
        problems.append(f"{len(left)} rows against {len(right)}")
    if left != right:
        only = [r for r in left if r not in set(right)][:3]
        missing = [r for r in right if r not in set(left)][:3]
        problems.append(f"rows differ ({order}): ours {only} theirs {missing}")
    return problems


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from yieldlens.session import build_session

    spark = build_session("oracle", cores="8", shuffle_partitions=8)
    con = connect(sf_dir)
    oracles, bad = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in oracles:
                problems = compare(df, con, oracles[name])
            else:
                problems = [] if df.count() > 0 else ["no rows"]
        except Exception as e:  # report and go on with the next query
            problems = [f"{type(e).__name__}: {str(e)[:1500]}"]
        bad += bool(problems)
        mark = "SQL " if name in oracles else "rows"
        print(f"{'FAIL' if problems else 'ok  '} {mark} {name} {time.time() - start:.1f}s", *problems, sep="\n     " if problems else " ")
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
