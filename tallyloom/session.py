"""Local session for tests and measurements, and the folder for intermediate tables."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: str = "8", app: str = "tallyloom", shuffle_partitions: int = 8) -> SparkSession:
    """A local session; on a cluster the session comes from the submitter instead."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_dirs: dict[str, str] = {}  # by application; the setting itself cannot change in a running session


def shared_dir(spark: SparkSession) -> str:
    """Folder the cluster names for intermediate tables (``spark.checkpoint.dir``).

    A temporary folder is used only where the setting is absent *and* the master is
    local, so that a cluster never writes to one machine's disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    application = spark.sparkContext.applicationId
    if application not in _local_dirs:
        _local_dirs[application] = tempfile.mkdtemp(prefix="tallyloom-")
    return _local_dirs[application]


def drop_staged(spark: SparkSession, application: str | None = None) -> None:
    """Remove the staged tables of an application, by default of this one once it is done.

    A scheduler calls it after a run; tables of a run that was killed go by its id.
    """
    folder = f"{shared_dir(spark).rstrip('/')}/tables/{application or spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def staged_path(spark: SparkSession, name: str) -> str:
    """A new path for one staged table, below a folder of this application."""
    return f"{shared_dir(spark).rstrip('/')}/tables/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stage_table(df, name: str):
    """Write ``df`` once to the shared folder and read it back.

    Used where several jobs need the same small result: it cuts the lineage, survives
    lost executors, and gives the planner true file sizes. The folder carries the
    application id, so what a finished application left can be dropped as a whole.
    """
    spark = df.sparkSession
    path = staged_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
