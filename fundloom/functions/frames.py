"""Frames handed back from Python to Spark."""

from __future__ import annotations

import pandas as pd


def frame(**columns) -> pd.DataFrame:
    """A frame whose columns keep Python objects: the string type of pandas has no Arrow form when empty."""
    return pd.DataFrame({k: pd.Series(list(v), dtype=object) for k, v in columns.items()})
