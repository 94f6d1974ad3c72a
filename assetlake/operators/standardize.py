"""Standardisation sheets: column names, rename rules per wave, NaN as NULL."""

from __future__ import annotations

import warnings
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean_name

# Per wave, optional renames and required columns with their new names.
RENAME_RULES: Mapping[str, tuple[dict[str, str], dict[str, str]]] = {
    "653": ({"UME_RECEITA": "RECEITA_UME"}, {}),
    "673": ({"UME_FATURAMENTO": "RECEITA_UME"}, {}),
    "674": ({"UME_RENTAB": "RECEITA_UME"}, {}),
    "684": ({"UME_TRAFEGO": "RECEITA_UME"}, {"TCOGER": "DSSGER"}),
    "702": ({"UME_DISPONIB": "RECEITA_UME"}, {"GRW": "DSSGER"}),
    "781": ({"CONEXAO_TORPEDO_NP": "CONEXAO_TORPEDO_NP"}, {"DWHSTG": "DWHSTG"}),
}


def clean_columns(df: DataFrame) -> DataFrame:
    """The frame with every column name cleaned."""
    return df.toDF(*[clean_name(c) for c in df.columns])


def apply_rename_rules(df: DataFrame, wave: str, rules=RENAME_RULES) -> DataFrame:
    """Columns renamed by the wave's rules.

    A missing optional column warns, a missing required column raises.
    """
    optional, required = rules.get(wave, ({}, {}))
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"wave {wave}: required column(s) missing: {', '.join(missing)}")
    for column in optional:
        if column not in df.columns:
            warnings.warn(f"wave {wave}: column {column} not found", stacklevel=2)
    return df.withColumnsRenamed({**optional, **required})


def nan_to_null(df: DataFrame) -> DataFrame:
    """Floating-point NaN turned into NULL."""
    floats = [f.name for f in df.schema if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(F.col(c)), F.col(c)) for c in floats})
