"""Session settings the library expects."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Run-time settings that suit large inputs.  Hot join keys are split by adaptive execution;
# a JSON object with a repeated key keeps the last value, as usual JSON readers do; packages
# are small files, and a lower opening cost puts about a hundred into one task.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.files.openCostInBytes": "1MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# The un-nesting of documents makes long methods, which HotSpot never compiles beyond 8,000 bytes;
# beyond this limit Spark runs an operator's expressions as several short methods instead.
METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")


def limit_methods(spark: SparkSession) -> SparkSession:
    """Keeps the methods that Spark generates short enough to be compiled; results are the same."""
    spark.conf.set(*METHOD_LIMIT)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Applies the run-time settings to a session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return limit_methods(spark)


def local_session(cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """A local session for tests, checks and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("assetlake")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark
