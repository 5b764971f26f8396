"""Order-insensitive comparison of a Spark result with a DuckDB result."""

import pandas as pd


def _norm(v):
    if v is None:
        return None
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return v + 0.0          # exact; -0.0 and 0.0 compare equal
    if isinstance(v, bool):
        return int(v)
    return v


def rows_of(df: pd.DataFrame):
    cols = sorted(df.columns)
    out = [tuple(_norm(v) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame):
    assert sorted(spark_pdf.columns) == sorted(duck_pdf.columns), (
        f"columns differ: {sorted(spark_pdf.columns)} vs {sorted(duck_pdf.columns)}")
    assert len(spark_pdf) == len(duck_pdf), f"row count {len(spark_pdf)} vs {len(duck_pdf)}"
    a, b = rows_of(spark_pdf), rows_of(duck_pdf)
    for i, (x, y) in enumerate(zip(a, b)):
        assert x == y, f"row {i} differs:\n spark {x}\n duck  {y}"
