"""Session settings and the shared scratch folder."""

from __future__ import annotations

import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import SparkSession

# Settings the results depend on, or that decide whether a plan scales.
RUNTIME_SETTINGS = {
    # naive times are UTC everywhere
    "spark.sql.session.timeZone": "UTC",
    # a repeated JSON key keeps its last value
    "spark.sql.variant.allowDuplicateKeys": "true",
    # keep the map-side top-k for batch sizes above 1000
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a Python worker and the JVM beside it hold some copies of a batch each
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    # conditions on folder and uid reach a Python data source
    "spark.sql.python.filterPushdown.enabled": "true",
    # ids and marks take far fewer bytes in a file than in the driver: what is larger there than a
    # sixteenth of the broadcast threshold is shuffled, and broadcast if its rows turn out to be few
    "spark.sql.sources.fileCompressionFactor": "16.0",
}
# Long texts, which files compress far less.
TEXT_SETTINGS = {"spark.sql.sources.fileCompressionFactor": "1.0"}

# Settings a session has to be built with.  Plans here are long, and looking up a call site
# for every column costs the driver more than many a job.
BUILD_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

# The scratch folder of each local application that names none.
_LOCAL_DIRS: dict[str, str] = {}


def configure(spark: SparkSession, changed: dict[str, str] | None = None) -> SparkSession:
    """Set the runtime settings on an existing session, some of them ``changed``, and return it.

    Functions that run in tasks are sent along by value, so executors need no copy of
    this package.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__package__])
    for key, value in {**RUNTIME_SETTINGS, **(changed or {})}.items():
        spark.conf.set(key, value)
    return spark


def session(app: str = "ledgerflow", master: str | None = None, **settings: str) -> SparkSession:
    """Build (or get) a session with the runtime settings applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**BUILD_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        # a static setting of a running session, so the folder is kept here
        application = spark.sparkContext.applicationId
        if application not in _LOCAL_DIRS:
            _LOCAL_DIRS[application] = tempfile.mkdtemp(prefix="ledgerflow-")
        return _LOCAL_DIRS[application]
    raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")


def new_run_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/ledgerflow/{name}-{uuid.uuid4().hex}"
