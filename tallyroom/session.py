"""Session settings the operators count on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings.  Adaptive execution sizes shuffle partitions and splits
# skewed join keys, also where the split costs one more exchange.  The JVM never
# compiles a method beyond 8000 bytes of bytecode, which fused code for a table
# of thirty columns can exceed; below the limit Spark splits it into operators.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Stream state lives on disk, not in the heap, however many keys it holds.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Folders of days are listed in this many tasks at most, not in one task a folder.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    # What an action shuffled goes when it ends, not when the driver next collects garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Row ids, days and stamps as text are defined in UTC, whatever the caller's zone.
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", name: str = "tallyroom", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        # Small files are worth a task each on one machine.
        .config("spark.sql.files.openCostInBytes", "65536")
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**RUNTIME, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
