"""Naming rules, anomaly rows, reject split and load counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stamps import run_stamp

# Legal name prefixes, names never checked, and the anomaly texts.
VALID_PREFIXES = [
    "agg_", "exp_", "fil_", "jnr_", "rtr_", "seq_", "str_",
    "trc_", "uni_", "srt_", "nor_", "tgt_", "src_", "lkp_",
]
IGNORED_NAMES = ["BI_CTRL_TRANSFORMACAO"]
IGNORED_PREFIX = "ff_"
ANOMALY_CODE = 5000
ANOMALY_OBJECT_TYPE = "Map"
NOTE_BEFORE_NAME = "As 3 primeiras posições de "
NOTE_AFTER_NAME = (
    " devem seguir os prefixos válidos: " + ", ".join(VALID_PREFIXES)
    + ". Nomes ignorados: " + ", ".join(IGNORED_NAMES) + " e prefixo 'ff_'"
)


def naming_ok(name: Column) -> Column:
    """True for an empty or ignored name and for one with a legal prefix (any case)."""
    prefixes = "|".join([IGNORED_PREFIX, *VALID_PREFIXES])
    legal = name.isin(IGNORED_NAMES) | (name == "") | name.rlike(f"(?i)^({prefixes})")
    return F.coalesce(legal, F.lit(True))


def naming_anomalies(transformations: DataFrame, run_ts) -> DataFrame:
    """One anomaly row per transformation whose name breaks the rule."""
    return transformations.filter(~naming_ok(F.col("name"))).select(
        "CodOnda",
        F.lit(ANOMALY_CODE).alias("InconsistencyCode"),
        F.concat(F.lit(NOTE_BEFORE_NAME), F.col("name"), F.lit(NOTE_AFTER_NAME)).alias("Note"),
        F.col("content_name").alias("ProcessName"),
        F.lit(ANOMALY_OBJECT_TYPE).alias("ObjectType"),
        "CodProcess",
        run_stamp(run_ts).alias("DateIns"),
    )


def naming_summary(transformations: DataFrame, has_adapter: Column, by: str = "CodOnda") -> DataFrame:
    """Per wave: transformations, good and bad names, adapters found."""
    ok = naming_ok(F.col("name"))
    return transformations.groupBy(by).agg(
        F.count("*").alias("total"),
        F.count_if(ok).alias("valid_names"),
        F.count_if(~ok).alias("invalid_names"),
        F.count_if(has_adapter).alias("adapters"),
    )


def split_rejects(df: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """Usable rows without the error column, and the rows that failed."""
    return df.filter(F.col(error).isNull()).drop(error), df.filter(F.col(error).isNotNull())


def load_audit(
    outcomes: DataFrame,
    table: str = "table_name",
    source: str = "source_path",
    outcome: str = "outcome",
) -> DataFrame:
    """Counters per table and in total.

    ``outcomes`` has one row per record read, its ``outcome`` being ``written``,
    ``ignored`` or ``failed``.  Rows are first reduced per source, so the totals work on
    one row per source.  A table succeeded when something was written and nothing failed.
    """
    per_source = outcomes.groupBy(table, source).agg(
        F.count("*").alias("records_read"),
        *[
            F.count_if(F.col(outcome) == kind).alias(kind)
            for kind in ("written", "ignored", "failed")
        ],
    )
    return (
        per_source.rollup(table)
        .agg(
            F.count("*").alias("sources"),
            *[
                F.sum(c).alias(c)
                for c in ("records_read", "written", "ignored", "failed")
            ],
        )
        .withColumn("success", (F.col("failed") == 0) & (F.col("written") > 0))
    )
