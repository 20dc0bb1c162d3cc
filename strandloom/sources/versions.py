"""Tables on disk whose parts are replaced one by one, and tables of rows replaced by key on top of them.

<path>/data/<run>/_part=<name>/ holds what one run wrote of a part, and
<path>/versions/<number>.json names the folder of each part. A run writes
the parts it replaces, then one such file; readers follow the newest complete
one, so they see all of a run or nothing, and a run that died leaves no trace
but unused folders, which ``vacuum`` removes. A number that is taken is an
error: of two runs at a time one has to start again.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import pin
from . import files


class PartitionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _state(self) -> dict:
        names = sorted((x.name for x in files.listed(self.spark, f"{self.path}/versions") if x.name.endswith(".json")), reverse=True)
        for name in names:
            text = files.read_text(self.spark, f"{self.path}/versions/{name}")
            try:
                return json.loads(text) | {"version": int(name.removesuffix(".json"))}
            except ValueError:  # not complete yet
                continue
        return {"version": 0, "parts": {}, "notes": {}, "schema": None}

    @property
    def version(self) -> int:
        return self._state()["version"]

    def parts(self) -> dict[str, str]:
        """Part -> the folder that holds it now."""
        return self._state()["parts"]

    def notes(self) -> dict[str, str]:
        """Part -> what the run that wrote it noted."""
        return self._state()["notes"]

    def read(self, parts: list[str] | None = None) -> DataFrame | None:
        """The rows, of some parts if asked for; only their folders are touched. None if nothing was ever written."""
        state = self._state()
        if state["schema"] is None:
            return None
        schema = StructType.fromJson(state["schema"])
        folders = [f"{self.path}/data/{f}" for p, f in sorted(state["parts"].items()) if parts is None or p in parts]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def replace(self, rows: DataFrame, part: Column, parts: list[str], notes: dict[str, str] | None = None) -> int:
        """Put ``rows``, each in the part that ``part`` tells, in place of all rows of ``parts``; parts that get no row are gone. Returns the version."""
        state, run = self._state(), uuid.uuid4().hex
        rows.withColumn("_part", part).write.partitionBy("_part").parquet(f"{self.path}/data/{run}")
        written = {x.name.removeprefix("_part="): f"{run}/{x.name}" for x in files.listed(self.spark, f"{self.path}/data/{run}") if x.name.startswith("_part=")}
        if strange := sorted(set(written) - set(parts)):
            raise ValueError(f"rows of other parts: {', '.join(strange)}")
        kept = {p: f for p, f in state["parts"].items() if p not in parts}
        noted = {p: n for p, n in state["notes"].items() if p in kept} | {p: n for p, n in (notes or {}).items() if p in parts}
        version = state["version"] + 1
        now = {"parts": kept | written, "notes": noted, "schema": json.loads(rows.schema.json())}
        files.create_text(self.spark, f"{self.path}/versions/{version:012d}.json", json.dumps(now))
        return version

    def vacuum(self) -> int:
        """Remove folders that the newest version does not name; not while older ones are read or a run writes. Returns how many."""
        used = set(self.parts().values())
        gone = 0
        for run in files.listed(self.spark, f"{self.path}/data"):
            inside = [x for x in files.listed(self.spark, run.path) if x.is_folder]
            left = [x for x in inside if f"{run.name}/{x.name}" not in used]
            for x in left:
                files.remove(self.spark, x.path)
            gone += len(left)
            if len(left) == len(inside):
                files.remove(self.spark, run.path)
        return gone


class KeyedTable:
    """Rows that are replaced by key; keys are dealt to a fixed number of hash parts, of which a run rewrites those it touches."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = 64):
        self.table, self.keys, self.buckets = PartitionedTable(spark, path), keys, buckets

    def _part(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(self.buckets)).cast("string")

    def _touched(self, rows: DataFrame) -> list[str]:
        return sorted(r[0] for r in rows.select(self._part()).distinct().collect())

    def upsert(self, rows: DataFrame) -> int:
        """Put ``rows`` in place of those with equal keys. Of several rows with one key the one with the largest other columns counts; null keys are an error. Returns how many parts were rewritten."""
        rest = [c for c in rows.columns if c not in self.keys]
        one = pin(rows.groupBy(*self.keys).agg(F.max(F.struct(*rest)).alias("_r")).select(*self.keys, "_r.*"))
        if not one.filter(" OR ".join(f"`{k}` IS NULL" for k in self.keys)).isEmpty():
            raise ValueError("a key is null")
        touched = self._touched(one)
        if not touched:
            return 0
        old = self.table.read(touched)
        if old is not None:
            one = old.join(one.select(*self.keys), self.keys, "left_anti").unionByName(one, allowMissingColumns=True)
        self.table.replace(one, self._part(), touched)
        return len(touched)

    def read(self) -> DataFrame | None:
        return self.table.read()

    def lookup(self, wanted: DataFrame) -> DataFrame | None:
        """The rows with the keys in ``wanted``; only the parts that may hold them are read."""
        keys = pin(wanted.select(*self.keys).distinct())
        rows = self.table.read(self._touched(keys))
        return None if rows is None else rows.join(keys, self.keys, "left_semi")
