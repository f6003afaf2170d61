"""Column selection with a lineage column kept last."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.functions.names import col, index_ci

_PLAIN_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def select_columns(df: DataFrame, columns: list, lineage_col: str | None = "filename") -> DataFrame:
    """Configured columns in configured order, then the lineage column (if the input has it).

    Entries are column names; an entry that is not a column of ``df`` is read as a SQL
    expression (``"CAST(x AS INT) AS y"``). A lineage column listed explicitly is emitted once,
    last. All plain names that do not exist are reported together.
    """
    wrong = [c for c in columns if not isinstance(c, str)]
    if wrong:
        raise ValueError(f"columns are given by name or as SQL text; not understood: {wrong}")
    exprs = list(columns)
    idx = index_ci(df.columns)
    lineage = lineage_col.lower() if lineage_col else None
    missing = [e for e in exprs if _PLAIN_NAME.match(e) and e.lower() not in idx]
    if missing:
        raise KeyError(f"configured columns not in the source: {missing}")
    picked = []
    for e in exprs:
        if lineage is not None and e.lower() == lineage:
            continue
        picked.append(col(idx[e.lower()]) if e.lower() in idx else F.expr(e))
    if lineage is not None and lineage in idx:
        picked.append(col(idx[lineage]))
    return df.select(*picked)
