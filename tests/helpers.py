from __future__ import annotations

import contextlib
import io
from collections import Counter


def bag(df) -> Counter:
    """The rows as a multiset."""
    return Counter(tuple(r) for r in df.collect())


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()
