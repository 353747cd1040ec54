import math

import numpy as np
import pandas as pd


def norm(v):
    if v is None or v is pd.NaT:
        return None
    if isinstance(v, (float, np.floating)):
        return None if math.isnan(v) else float(v)
    if isinstance(v, np.integer):
        return int(v)
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(norm(x) for x in v)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime()
    return v


def rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(norm(r[c]) for c in cols) for r in pdf.to_dict("records")), key=repr)


def close(a, b, tol=1e-9):
    if isinstance(a, tuple) and isinstance(b, tuple):
        return len(a) == len(b) and all(close(x, y, tol) for x, y in zip(a, b))
    if isinstance(a, float) or isinstance(b, float):
        if a is None or b is None:
            return a is None and b is None
        return abs(a - b) <= tol * max(1.0, abs(a), abs(b))
    return a == b


def assert_frames_match(spark_pdf, duck_pdf, tol=1e-9):
    sc, sr = rows(spark_pdf)
    dc, dr = rows(duck_pdf)
    assert sc == dc, (sc, dc)
    assert len(sr) == len(dr), (len(sr), len(dr))
    bad = [(x, y) for x, y in zip(sr, dr) if not close(x, y, tol)]
    assert not bad, bad[:3]
