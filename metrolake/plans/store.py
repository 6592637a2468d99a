"""The measurement store: Parquet tables under one folder, committed by manifest.

Every load writes its rows under its own ``load_id`` (a partition of every
table) and becomes visible by one act: creating the next version file in
``_versions``, which succeeds only if that file is absent (S13). So of two
loads that started from one version one commits and the other learns that it
lost (``Conflict``) and starts again from the new version; an interrupted load
leaves rows that no version names. A reader looks the version up once per
frame, or pins one (``pinned``), and sees exactly the loads up to it.

``measurements`` is partitioned by the measurement date too, so the lookback
filters of the analytics prune whole partitions. ``hour_index`` holds, for each
version, the number of committed measurements per hour and their running
total (V5b): a load adds its own hours to the index it started from.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..operators.analytics import MEASUREMENT_FRAME_COLUMNS
from ..operators.validation import hour_counts, running_hours

VERSION_SCHEMA = "version long, load_id string"


class Conflict(RuntimeError):
    """Another load has committed the version that this one wanted."""


class Store:
    def __init__(self, spark: SparkSession, root: str, version: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.version = version  # None: the latest at each look
        self.load_id = uuid.uuid4().hex  # of rows that this object appends

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    # ---- file system -------------------------------------------------------
    def _local(self, path: str) -> str | None:
        path = path[len("file:"):] if path.startswith("file:") else path
        return None if "://" in path else path

    def _hadoop(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self, name: str) -> list[str]:
        """Names in a folder of the store; none if it is absent."""
        if (p := self._local(self.path(name))) is not None:
            return os.listdir(p) if os.path.isdir(p) else []
        fs, hp = self._hadoop(self.path(name))
        return [s.getPath().getName() for s in fs.listStatus(hp)] if fs.exists(hp) else []

    def _exists(self, name: str) -> bool:
        return any(not f.startswith((".", "_")) or f == "_SUCCESS" for f in self._names(name))

    def _create(self, path: str, text: str) -> None:
        """Create a whole file at ``path``; Conflict if there is one. Never shows a part of it."""
        tmp = f"{path}.{self.load_id}.tmp"
        if (p := self._local(path)) is not None:
            t = self._local(tmp)
            os.makedirs(os.path.dirname(p), exist_ok=True)
            with open(t, "w", encoding="utf-8") as f:
                f.write(text)
            try:
                os.link(t, p)  # fails if p exists
            except FileExistsError:
                raise Conflict(path) from None
            finally:
                os.unlink(t)
            return
        jvm, (fs, hp) = self.spark._jvm, self._hadoop(path)
        tp = jvm.org.apache.hadoop.fs.Path(tmp)
        out = fs.create(tp, True)
        out.write(bytearray(text.encode()))
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(hp.toUri(), self.spark._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            context.rename(tp, hp, none)  # does not replace
        except Exception as e:  # noqa: BLE001 - the JVM's FileAlreadyExistsException
            fs.delete(tp, False)
            if "FileAlreadyExists" in str(e):
                raise Conflict(path) from None
            raise

    # ---- versions ------------------------------------------------------------
    def latest(self) -> int:
        """Number of the last committed version, 0 for none."""
        return max((int(f[:-len(".json")]) for f in self._names("_versions") if f.endswith(".json")), default=0)

    def pinned(self) -> "Store":
        """This store as it is now, for any number of reads."""
        return Store(self.spark, self.root, self.latest())

    def _now(self) -> int:
        return self.latest() if self.version is None else self.version

    def commits(self, version: int | None = None) -> DataFrame:
        """(version, load_id) up to a version."""
        version = self._now() if version is None else version
        if not version:
            return self.spark.createDataFrame([], VERSION_SCHEMA)
        return (self.spark.read.schema(VERSION_SCHEMA).json(f"{self.path('_versions')}/*.json")
                .filter(F.col("version") <= version))

    def commit(self) -> int:
        """Make this object's rows visible as the version after the pinned one; Conflict if that one is taken."""
        version = self._now() + 1
        self._create(f"{self.path('_versions')}/{version:020d}.json",
                     json.dumps({"version": version, "load_id": self.load_id}))
        return version

    # ---- tables --------------------------------------------------------------
    def table(self, name: str) -> DataFrame:
        """All rows of a stored table, committed or not, or an empty frame of its schema."""
        sch = S.TABLES[name]
        if self._exists(name):
            return self.spark.read.schema(sch).parquet(self.path(name))
        return self.spark.createDataFrame([], sch)

    def committed(self, name: str, version: int | None = None) -> DataFrame:
        """Rows of a table's committed loads (one row a load to join, which prunes partitions)."""
        return self.table(name).join(self.commits(version).select("load_id"), "load_id", "left_semi")

    def append(self, name: str, df: DataFrame) -> None:
        df = df.withColumn("load_id", F.lit(self.load_id))
        df = df.select(*[F.col(f.name).cast(f.dataType) for f in S.TABLES[name].fields])
        if name == "measurements":
            # Rows of a date meet before the write, so that a date gets few files; AQE splits large dates
            # and merges small ones by measured size.
            df.hint("rebalance", F.col("ts_date")).write.mode("append").partitionBy("load_id", "ts_date").parquet(
                self.path(name))
        else:
            df.write.mode("append").partitionBy("load_id").parquet(self.path(name))

    # ---- the hour index (V5b) ---------------------------------------------------
    def hour_index(self) -> DataFrame:
        """(h, c, cum) of the committed measurements: the index that the last load wrote."""
        version = self._now()
        last = self.commits(version).filter(F.col("version") == version).select("load_id")
        return self.table("hour_index").join(last, "load_id", "left_semi").select("h", "c", "cum")

    def append_hours(self, measurements: DataFrame) -> None:
        """Write the pinned version's index with the hours of ``measurements`` added."""
        both = self.hour_index().select("h", "c").unionByName(hour_counts(measurements))
        self.append("hour_index", running_hours(both.groupBy("h").agg(F.sum("c").alias("c"))))

    # ---- committed views ---------------------------------------------------
    def ledger(self) -> DataFrame:
        return self.committed("file_imports")

    def committed_runs(self) -> DataFrame:
        return self.committed("runs")

    def validation_results(self) -> DataFrame:
        """Check results of committed loads."""
        return self.committed("validation_results")

    def measurements(self) -> DataFrame:
        return self.committed("measurements")

    def measurement_frame(self, run_ids=None, with_partition: bool = True) -> DataFrame:
        """Committed measurements joined to their runs (the 11 columns,
        plus the ``ts_date`` partition column so lookback filters prune)."""
        version = self._now()
        m, r = self.committed("measurements", version), self.committed("runs", version)
        if run_ids is not None:
            ids = list(run_ids)
            m = m.filter(F.col("run_id").isin(ids))
            r = r.filter(F.col("run_id").isin(ids))
        cols = MEASUREMENT_FRAME_COLUMNS + (["ts_date"] if with_partition else [])
        return (m.join(r.select("run_id", "equipment_id", "operator"), "run_id")
                 .select(*cols))

    def max_id(self, name: str, col: str) -> int:
        """Largest id in a table's committed loads (0 when empty): one aggregate, one number."""
        v = self.committed(name).agg(F.max(col)).first()[0]
        return int(v or 0)
