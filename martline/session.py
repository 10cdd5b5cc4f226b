"""SparkSession helpers.

Library code never builds its own session: every operator takes DataFrames.
These helpers exist for scripts, tests and the bench.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job in this package assumes: UTC so dates derived from
# TIMESTAMP_NTZ never shift, AQE on so joins/partition counts re-plan at
# runtime, and ANSI left on (division guards use try_divide).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", app: str = "martline",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _session_key(spark: SparkSession):
    try:
        return id(spark), spark.sparkContext.applicationId
    except Exception:  # Spark Connect sessions have no SparkContext
        return id(spark), getattr(spark, "session_id", None)


def per_session(fn):
    """Memoise a plan builder ``fn(spark, *args)`` per session.

    DataFrames are plan descriptions, so reusing the object a view or fact
    builder returned is safe: memoised builders neither cache nor checkpoint.
    It only saves rebuilding the same plan through the Python<->JVM bridge
    when several parts of a query share it; ``forget_plans`` runs before each
    registered query, so a rewritten table is listed anew.
    """
    memo: dict = {}

    def wrapper(spark: SparkSession, *args):
        key = (_session_key(spark), args)
        if key not in memo:
            memo[key] = fn(spark, *args)
        return memo[key]
    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    wrapper.__wrapped__ = fn
    _MEMOS.append(memo)
    return wrapper


_MEMOS: list[dict] = []


def forget_plans() -> None:
    """Drop all memoised plans (after tables were rewritten)."""
    for memo in _MEMOS:
        memo.clear()


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared checkpoint folder of the session.

    On a cluster the folder named by ``spark.checkpoint.dir`` (or one already
    set on the context) is used.  Only a ``local`` master without either gets
    a scratch folder; any other master raises, since executors could not read
    each other's files in a local one.
    """
    context = spark.sparkContext
    held = context.getCheckpointDir()
    # the context keeps its own folder below the one it was given
    known = spark.conf.get("spark.checkpoint.dir", None) or _given.get(held) or held
    if known is None and fallback is None and not context.master.startswith("local") or (known is None and context.master.startswith("local-cluster")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = known or fallback or tempfile.mkdtemp(prefix="martline-ckpt-")
    if held is None:
        context.setCheckpointDir(path)
        _given[context.getCheckpointDir()] = path
    return path


_given: dict[str, str] = {}


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized to the input, for large clusters (a starting point, not a tuning oracle).

    * shuffle partitions: enough that each holds about ``target_partition_bytes``
      of input and there are at least 3 waves of tasks over all cores, so a
      partition fits in executor memory without spilling everything;
    * AQE coalesces small partitions back to the same advisory size and splits
      skewed ones (a key holding a large share of rows) at 5x the median;
    * scans split files at 256 MiB;
    * broadcast joins stay below the bound ``operators.joins.BROADCAST_LIMIT_BYTES``.
    """
    from martline.operators.joins import BROADCAST_LIMIT_BYTES
    parts = max(3 * total_cores, int(input_bytes // target_partition_bytes) + 1, 200)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(BROADCAST_LIMIT_BYTES),
        "spark.sql.session.timeZone": "UTC",
    }
