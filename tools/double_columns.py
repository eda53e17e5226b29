"""Rewrite lakemart/plans/double_columns.py: per query, the result columns that DuckDB types as DECIMAL.

usage: python tools/double_columns.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import duckdb  # noqa: E402

from lakemart.plans import registry  # noqa: E402
from lakemart.plans.tables import TABLES  # noqa: E402

HEADER = '"""Result columns of each query\'s SQL that are DECIMAL (written by tools/double_columns.py)."""\n\n'


def found(sf_dir: str) -> dict[str, list[str]]:
    registry.load_all()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    out = {}
    for name, e in registry.REGISTRY.items():
        if e.sql:
            cols = [r[0] for r in con.execute(f"DESCRIBE SELECT * FROM ({e.sql}) AS _q").fetchall()
                    if str(r[1]).upper().startswith("DECIMAL")]
            if cols:
                out[name] = cols
    return out


def text(columns: dict[str, list[str]]) -> str:
    rows = "".join(f"    {name!r}: {cols!r},\n" for name, cols in sorted(columns.items())).replace("'", '"')
    return HEADER + "DOUBLE_COLUMNS: dict[str, list[str]] = {\n" + rows + "}\n"


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    with open(os.path.join(ROOT, "lakemart", "plans", "double_columns.py"), "w") as f:
        f.write(text(found(sf)))
