"""Order-insensitive comparison of a Spark result with an oracle result (used by tests and the
local check script): same column names, same row count, same multiset of normalised rows."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return str(v)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    if hasattr(v, "item"):
        try:
            return norm(v.item())
        except Exception:  # noqa: BLE001
            pass
    return v


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    normed = sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)
    return [cols[i] for i in order], hashlib.sha256(repr(normed).encode()).hexdigest()[:16], normed


def compare(spark_cols, spark_rows, oracle_cols, oracle_rows) -> tuple[bool, str]:
    sc, sh, sn = digest(spark_cols, spark_rows)
    oc, oh, on = digest(oracle_cols, oracle_rows)
    if sc != oc:
        return False, f"columns {sc} vs {oc}"
    if len(sn) != len(on):
        return False, f"rows {len(sn)} vs {len(on)}"
    if sh != oh:
        extra = [r for r in sn if r not in set(on)][:2]
        return False, f"values differ, e.g. {extra}"
    return True, "ok"
