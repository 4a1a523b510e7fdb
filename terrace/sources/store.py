"""Whole-snapshot table store: gate, then publish; read the current snapshot.

A snapshot is written once, to a version folder of its own under the table, while an
``Observation`` counts rows and null keys on the same pass. Only when every gate passes is
it published: by creating ``_published/<number>``, which must not exist yet and whose
content is the version. The greatest number is the current version. Of several publishers
one gets a number, the others see that it is taken, look again and try the next: none
overwrites another, and who published later is current. A mark without content is of a
publisher that is not done (or was lost); readers pass over it. Nothing is moved, so a
reader opened before a publish finishes on its own version, and a failed gate or a lost
driver leaves the previous version current. ``drop_old`` removes versions that no reader
needs any more. The schema is replaced, never merged.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.operators.quality import enforce, observe_gates, report_from_metrics
from terrace.sources import files

# Fixed value: folder of the publish marks (underscore names are skipped by readers).
PUBLISHED = "_published"


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fmt = fmt

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def marks(self, table: str) -> list[tuple[int, str]]:
        """``(number, version)`` of every publish mark, oldest first; an empty version is not published."""
        folder = f"{self.path(table)}/{PUBLISHED}"
        numbers = [int(name) for name in files.names_in(self.spark, folder)]
        if not numbers:
            return []
        found = self.spark.read.format("binaryFile").load(folder)  # files without content are not read
        rows = found.select(F.substring_index("path", "/", -1).cast("int"), F.decode("content", "UTF-8")).collect()
        return sorted({**dict.fromkeys(numbers, ""), **dict(map(tuple, rows))}.items())

    def versions(self, table: str) -> list[str]:
        """Published versions, oldest first."""
        return [version for _, version in self.marks(table) if version]

    def exists(self, table: str) -> bool:
        return bool(self.versions(table))

    def current(self, table: str) -> str:
        """Folder of the current snapshot."""
        versions = self.versions(table)
        if not versions:
            raise FileNotFoundError(f"no published snapshot of {self.path(table)}")
        return f"{self.path(table)}/{versions[-1]}"

    def read(self, table: str) -> DataFrame:
        """The whole current snapshot (no filter on the reference date)."""
        return self.spark.read.format(self.fmt).load(self.current(table))

    def publish(self, df: DataFrame, table: str, required: str | None = None) -> dict:
        """Gate ``df`` and make it the current ``table``; returns the gate metrics (row count, null keys).

        Raises ``QualityError`` (table unchanged) when a gate fails.
        """
        gated, obs = observe_gates(df, table, required)
        version = f"v-{uuid.uuid4().hex}"
        gated.write.format(self.fmt).mode("errorifexists").save(f"{self.path(table)}/{version}")
        metrics = obs.get
        try:
            enforce(report_from_metrics(table, required, metrics))
        except Exception:
            files.remove(self.spark, f"{self.path(table)}/{version}")
            raise
        while True:
            number = max((n for n, _ in self.marks(table)), default=-1) + 1
            if files.create_new(self.spark, f"{self.path(table)}/{PUBLISHED}/{number:012d}", version):
                return metrics

    def drop_old(self, table: str, keep: int = 1) -> list[str]:
        """Remove all but the newest ``keep`` published versions; returns those removed. Numbers are not used again."""
        published = [m for m in self.marks(table) if m[1]]
        for number, version in published[: -max(keep, 1)]:
            files.remove(self.spark, f"{self.path(table)}/{PUBLISHED}/{number:012d}")
            files.remove(self.spark, f"{self.path(table)}/{version}")
        return [version for _, version in published[: -max(keep, 1)]]
