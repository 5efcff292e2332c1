"""Compare a Spark query with its SQL on the same tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd


def _rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]

    def plain(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
            return None
        if isinstance(v, (bool, str, bytes)):
            return v
        return round(float(v), 6) if hasattr(v, "__float__") else str(v)

    return sorted((tuple(plain(v) for v in r) for r in frame.itertuples(index=False, name=None)), key=repr)


def differences(spark, sf_dir: str, query, sql: str) -> str:
    """'' if both have the same columns and rows, else what is the first difference."""
    with duckdb.connect() as db:
        for p in Path(sf_dir).glob("*.parquet"):
            db.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
        rows = db.execute(sql).fetchall()
        theirs = pd.DataFrame(rows, columns=[d[0] for d in db.description], dtype=object)
    ours = query(spark, sf_dir).toArrow().to_pandas()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} and {sorted(theirs.columns)}"
    a, b = _rows(ours), _rows(theirs)
    if len(a) != len(b):
        return f"{len(a)} and {len(b)} rows"
    return next((f"{x} and {y}"[:600] for x, y in zip(a, b, strict=True) if x != y), "")
