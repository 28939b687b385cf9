"""Compares a registered query with its SQL, value by value."""

from checks import compare
from strata.llm.queries import ORACLES, QUERIES


def difference(spark, folder: str, name: str) -> str | None:
    df = QUERIES[name](spark, folder)
    cursor = compare.duck(folder).execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    got = compare._normal(df.columns, df.collect())
    want = compare._normal(columns, cursor.fetchall())
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    return f"{len(got)} rows against {len(want)}; {bad[:3]}" if bad or len(got) != len(want) else None
