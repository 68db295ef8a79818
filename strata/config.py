"""Fixed values shared by the layers, and session helpers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# ---------------------------------------------------------------------------
# Fixed values. These must equal the original application's settings for the
# results to match; they are the defaults of the operator parameters.
# ---------------------------------------------------------------------------
TOPIC_START = "dwd_start_log"
TOPIC_PAGE = "dwd_page_log"
TOPIC_DISPLAY = "dwd_display_log"
TOPIC_UNIQUE_VISIT = "dwm_unique_visit"
TOPIC_USER_JUMP = "dwm_user_jump_detail"
TOPIC_ORDER_WIDE = "dwm_order_wide"
TOPIC_PAYMENT_WIDE = "dwm_payment_wide"
TOPIC_BAD_LOG = "bad_base_log"  # own additions: records that can't be read
TOPIC_BAD_DB = "bad_base_db"
SINK_TYPE_HBASE = "hbase"
SINK_TYPE_KAFKA = "kafka"
SINK_TYPE_CLICKHOUSE = "clickhouse"
OP_BOOTSTRAP_INSERT = "bootstrap-insert"
OP_INSERT = "insert"
DEFAULT_PK = "id"
DIM_TABLE_PREFIX = "DIM_"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
DAY_FORMAT = "yyyyMMdd"
WATERMARK_DELAY = "3 seconds"
STATS_WINDOW = "10 seconds"
BOUNCE_WITHIN_MS = 10_000
ORDER_LINE_LOWER_MS = -5
ORDER_LINE_UPPER_MS = 5
PAYMENT_LOWER_MS = -1_800_000
PAYMENT_UPPER_MS = 0
VISIT_STATE_TTL_MS = 86_400_000
CHECKPOINT_INTERVAL = "5 seconds"
GENDER_MALE_CODE = "M"
GENDER_MALE_LABEL = "男"
GENDER_FEMALE_LABEL = "女"
MS_PER_DAY = 86_400_000
DAYS_PER_YEAR = 365
# ---------------------------------------------------------------------------

def get_session(master: str = "local[8]", shuffle_partitions: int = 8,
                app_name: str = "strata", extra: dict | None = None) -> SparkSession:
    """Session with AQE (coalescing + skew join), UTC time, no UI."""
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
         .config("spark.sql.adaptive.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "16g")))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application, so that its
    functions load there whatever their working directory is."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="strata-ship-"), "strata-package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(here):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("strata", os.path.relpath(full, here)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def gone_on_exit(spark: SparkSession, path: str) -> str:
    """Have a folder of intermediate tables removed when the session ends; returns it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def use_utc(spark: SparkSession) -> None:
    """Day strings and time texts follow the session zone; fixtures are UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    A fresh scratch folder is set only when the session names none (tests,
    local runs); on a cluster the configured shared folder is always used.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        d = tempfile.mkdtemp(prefix="strata-ckpt-")  # local mode only (tests, a laptop)
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")
