"""A table of results with one current row for each key: added to, compacted and cleaned up while others read it.

Rows lie in parts, folders of Parquet files by bucket of their key's hash. A manifest names the parts that count; each change
writes new parts first and then the next manifest, which must not be there yet. So a job that dies between its steps leaves the table as it
was, two that commit at once do not lose each other's rows, and a reader sees one manifest's parts, whatever happens meanwhile.
The last row of a key by the table's order counts, wherever it lies; merging any parts keeps that.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as S

BUCKET = "_bucket"


class ResultTable:
    """keys, order and number of buckets are fixed when the table is made and read from its manifest afterwards."""

    def __init__(self, spark: SparkSession, folder: str, keys: list[str] | None = None, order: str = "finished_at", buckets: int = 16):
        self.spark, self.folder = spark, folder.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        known = self.manifest()
        if known is None and not keys:
            raise ValueError(f"{folder} is no table of results; one is made with keys")
        if known is not None and keys and (keys != known["keys"] or order != known["order"]):
            raise ValueError(f"{folder} has keys {known['keys']} and order {known['order']}")
        self.keys, self.order, self.buckets = (known["keys"], known["order"], known["buckets"]) if known else (list(keys), order, buckets)

    def manifest(self) -> dict | None:
        """The newest manifest: generation, parts, keys, order, buckets; None for a table without any."""
        at = self._path(f"{self.folder}/manifests")
        if not self._fs.exists(at):
            return None
        names = sorted(n for n in (s.getPath().getName() for s in self._fs.listStatus(at)) if n.endswith(".json"))
        if not names:
            return None
        stream = self._fs.open(self._path(f"{self.folder}/manifests/{names[-1]}"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _commit(self, gone: list[str], new: str, schema: S.StructType) -> dict:
        """The next manifest: without the parts that are gone and with the new one, whatever others have committed since."""
        while True:
            now = self.manifest() or {"generation": 0, "parts": [], "schemas": {}}
            if not set(gone) <= set(now["parts"]):
                raise RuntimeError("another job has merged these parts")
            parts = [*(p for p in now["parts"] if p not in gone), new]
            schemas = {p: s for p, s in (now["schemas"] | {new: schema.jsonValue()}).items() if p in parts}
            made = {"generation": now["generation"] + 1, "parts": parts, "schemas": schemas, "keys": self.keys, "order": self.order, "buckets": self.buckets}
            target, part = self._path(f"{self.folder}/manifests/{made['generation']:012d}.json"), self._path(f"{self.folder}/manifests/.{uuid.uuid4().hex}.tmp")
            stream = self._fs.create(part, False)
            stream.write(bytearray(json.dumps(made).encode()))
            stream.close()
            if not self._fs.exists(target) and self._fs.rename(part, target):
                return made
            self._fs.delete(part, False)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame) -> str:
        name = uuid.uuid4().hex
        rows.withColumn(BUCKET, self._bucket()).repartition(self.buckets, BUCKET).write.partitionBy(BUCKET).parquet(f"{self.folder}/data/{name}")
        return name

    def _last(self, rows: DataFrame) -> DataFrame:
        """The last row of each key; maxima are combined before the shuffle. Rows that are equal in the order go by a hash of all."""
        rest = [c for c in rows.columns if c not in self.keys]
        last = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), F.struct(self.order, F.xxhash64(*rest))).alias("_r"))
        return last.select(*self.keys, "_r.*").select(*rows.columns)

    def _parts(self, names: list[str], schemas: dict) -> DataFrame | None:
        """Rows of parts, each read by its own path: their buckets are folders, and a part without rows has none."""
        out = None
        for n in names:
            schema = S.StructType.fromJson(schemas[n]).add(BUCKET, S.IntegerType())
            part = self.spark.read.schema(schema).option("basePath", f"{self.folder}/data/{n}").parquet(f"{self.folder}/data/{n}")
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
        return out

    def add(self, rows: DataFrame) -> dict:
        """Adds rows, whose keys may be there already, as one part."""
        return self._commit([], self._write(rows), rows.schema)

    def current(self, wanted: DataFrame | None = None) -> DataFrame:
        """The current row of each key, or of the keys in `wanted`."""
        now = self.manifest() or {"parts": [], "schemas": {}}
        rows = self._parts(now["parts"], now["schemas"])
        if rows is None:
            raise ValueError(f"{self.folder} holds no results yet")
        if wanted is not None:
            keys = wanted.select(*self.keys).distinct().withColumn(BUCKET, self._bucket())
            rows = rows.join(keys, [*self.keys, BUCKET], "left_semi")
        return self._last(rows.drop(BUCKET))

    def compact(self, parts: list[str] | None = None) -> dict | None:
        """Merges the given parts, or all, into one that holds their keys' last rows, and reads no others. None if there is
        nothing to merge. The merged folders stay for those who read them, until clean()."""
        now = self.manifest() or {"parts": [], "schemas": {}}
        parts = now["parts"] if parts is None else parts
        if not set(parts) <= set(now["parts"]):
            raise RuntimeError("another job has merged these parts")
        if len(parts) < 2:
            return None
        merged = self._last(self._parts(parts, now["schemas"]).drop(BUCKET))
        return self._commit(parts, self._write(merged), merged.schema)

    def clean(self) -> list[str]:
        """Deletes the parts that the newest manifest does not name, of dead jobs and merged ones, and says which. For times at which
        nobody writes, or reads by an older manifest."""
        keep, at = set((self.manifest() or {"parts": []})["parts"]), self._path(f"{self.folder}/data")
        gone = sorted(n for n in (s.getPath().getName() for s in self._fs.listStatus(at)) if n not in keep) if self._fs.exists(at) else []
        for n in gone:
            self._fs.delete(self._path(f"{self.folder}/data/{n}"), True)
        return gone
