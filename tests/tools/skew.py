"""Writes a skewed copy of a data folder: one key of each kind holds a third of the rows.

    python tests/tools/skew.py /root/testdata/sf0.01 /tmp/run-x/sf0.01 [--nulls]
"""

import shutil
import sys
from pathlib import Path

import duckdb

HOT = {
    "orders": "* REPLACE (CASE WHEN hash(o_orderkey) % 3 = 0 THEN 5 ELSE o_custkey END AS o_custkey,"
    " CASE WHEN hash(o_orderkey + 1) % 3 = 0 THEN TIMESTAMP '2001-07-20' ELSE o_orderdate END AS o_orderdate)",
    "lineitem": "* REPLACE (CASE WHEN hash(l_partkey, l_orderkey, l_linenumber) % 3 = 0 THEN 11 ELSE l_orderkey END AS l_orderkey,"
    " CASE WHEN hash(l_orderkey, l_partkey) % 3 = 0 THEN 3 ELSE l_partkey END AS l_partkey)",
    "events": "* REPLACE (CASE WHEN hash(event_id) % 3 = 0 THEN 7 ELSE user_id END AS user_id,"
    " CASE WHEN hash(event_id + 1) % 3 = 0 THEN 'error' ELSE event_type END AS event_type)",
}
NULLS = {
    "orders": "* REPLACE (CASE WHEN hash(o_orderkey) % 50 = 0 THEN NULL ELSE o_custkey END AS o_custkey)",
    "lineitem": "* REPLACE (CASE WHEN hash(l_orderkey, l_partkey) % 50 = 0 THEN NULL ELSE l_orderkey END AS l_orderkey,"
    " CASE WHEN hash(l_partkey, l_linenumber) % 50 = 0 THEN NULL ELSE l_partkey END AS l_partkey)",
    "part": "* REPLACE (CASE WHEN hash(p_partkey) % 50 = 0 THEN NULL ELSE p_type END AS p_type)",
    "events": "* REPLACE (CASE WHEN hash(event_id) % 50 = 0 THEN NULL ELSE user_id END AS user_id,"
    " CASE WHEN hash(event_id) % 40 = 0 THEN '{}' ELSE props END AS props)",
}


def main(source: str, target: str, changes: dict) -> None:
    con = duckdb.connect()
    Path(target).mkdir(parents=True, exist_ok=True)
    for file in sorted(Path(source).glob("*.parquet")):
        out = Path(target) / file.name
        if file.stem in changes:
            con.execute(f"COPY (SELECT {changes[file.stem]} FROM read_parquet('{file}')) TO '{out}' (FORMAT parquet)")
        else:
            shutil.copy(file, out)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2], NULLS if "--nulls" in sys.argv else HOT)
