"""Side-by-side comparison of registered queries with their SQL form.

``python -m tests.oracle [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    return None if v is None else f"{type(v).__name__}:{v}"


def _rows(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(_plain(r[i]) for i in order) for r in rows], key=repr)


def difference(con, df, sql: str) -> str | None:
    """None when both sides hold the same rows, else a short explanation."""
    got_names = df.columns
    got = _rows([tuple(r) for r in df.collect()], got_names)
    rel = con.execute(sql)
    want_names = [c[0] for c in rel.description]
    want = _rows(rel.fetchall(), want_names)
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(got_names)} against {sorted(want_names)}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ in {sorted(got_names)}, first {bad[0][0]} against {bad[0][1]}"
    return None


def main(argv):
    from tests.session import make_session
    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark, con = make_session(), connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in argv[1:] or queries:
        started = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name not in oracles:
                note = f"no oracle, {df.count()} rows"
            else:
                note = difference(con, df, oracles[name])
                note = f"ok {df.count()} rows" if note is None else f"FAIL {note}"
        except Exception as e:  # report and go on with the next query
            note = f"FAIL {type(e).__name__} {str(e)[:600]}"
        failed += note.startswith("FAIL")
        print(f"{name:32s} {time.time() - started:6.2f}s {note}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main(sys.argv[1:])
