"""Functions that SQL text can call, registered in a session under their names."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quern.functions import canonical, code

#: Name: (what a value becomes, type of the result).
SCALARS = {
    "code_structure": (code.structure_hash, "string"),
    "code_parses": (lambda c: code.parse(c) is not None, "boolean"),
    "code_cheats": (code.cheat_issues, "array<string>"),
    "canonical_json": (canonical.canonical, "string"),
}


def register(spark: SparkSession, extra: dict | None = None) -> list[str]:
    """Register SCALARS and further functions of the same form; null stays null.  Returns the names."""
    names = []
    for name, (f, kind) in (SCALARS | (extra or {})).items():
        run = code._per_text(f)
        spark.udf.register(name, F.pandas_udf(lambda s, run=run: pd.Series(run(s)), kind))
        names.append(name)
    return names
