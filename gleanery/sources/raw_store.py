"""The folder of raw responses as a data source: spark.read.format("raw_store").load(folder).

A response is a body and its metadata, named after its URL's hash (`files.save_raw`). The driver lists names and sizes and deals
them out by size; tasks read metadata and bodies. An equality with a URL, or a list of them, is a name and needs no listing; other
filters are left to Spark, and bodies are read only where they are asked for. A task that runs again reads the same names, and what is still
being written, or has lost its body, is no row.
"""

from __future__ import annotations

import hashlib
import json
import os

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

META = ".meta.json"
SCHEMA = "url string, raw_file string, content_hash string, content_type string, size long, about string"
SPLIT = 128 << 20  # bytes of bodies in a partition


def stem(url: str) -> str:
    """The name of a URL's files, without ending."""
    return hashlib.sha256(url.encode()).hexdigest()[:20]


class Names(InputPartition):
    def __init__(self, names: list[str]):
        super().__init__(names)
        self.names = names


class RawReader(DataSourceReader):
    def __init__(self, folder: str, split: int, bodies: bool):
        self.folder, self.split, self.bodies = folder, split, bodies
        self.urls: set[str] | None = None

    def pushFilters(self, filters: list[Filter]):
        """Takes equalities with URLs; yields the filters that are left to Spark."""
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("url",):
                mine = {v for v in ([f.value] if isinstance(f, EqualTo) else f.value) if v is not None}
                self.urls = mine if self.urls is None else self.urls & mine
            else:
                yield f

    def partitions(self) -> list[Names]:
        if self.urls is not None:
            names = sorted({stem(u) for u in self.urls})
            names = [(n, 0) for n in names if os.path.exists(os.path.join(self.folder, n + META))]
        else:
            size, metas = {}, []
            with os.scandir(self.folder) as found:
                for e in found:
                    if e.name.endswith(META):
                        metas.append(e.name[: -len(META)])
                    elif e.is_file() and not e.name.endswith(".tmp"):
                        size[e.name.split(".")[0]] = e.stat().st_size
            names = [(n, size[n]) for n in sorted(metas) if n in size]
        out, held, total = [], [], 0
        for n, s in names:
            if held and (total + s > self.split or len(held) >= 10_000):
                out.append(Names(held))
                held, total = [], 0
            held.append(n)
            total += s
        return [*out, Names(held)]

    def read(self, partition: Names):
        for name in partition.names:
            try:
                with open(os.path.join(self.folder, name + META), encoding="utf-8") as f:
                    meta = json.load(f)
                body = os.path.join(self.folder, os.path.basename(meta["raw_file"]))
                size = os.path.getsize(body)
                data = [open(body, "rb").read()] if self.bodies else []
            except FileNotFoundError:
                continue
            if self.urls is None or meta["url"] in self.urls:
                more = {k: v for k, v in meta.items() if k not in ("url", "raw_file", "content_hash", "content_type")}
                yield (meta["url"], body, meta.get("content_hash"), meta.get("content_type"), size, json.dumps(more, ensure_ascii=False, sort_keys=True), *data)


class RawStore(DataSource):
    """Options: path; split, the bytes of bodies in a partition; bodies, true for a column `body`."""

    @classmethod
    def name(cls) -> str:
        return "raw_store"

    def _bodies(self) -> bool:
        return self.options.get("bodies", "false").lower() == "true"

    def schema(self) -> str:
        return SCHEMA + (", body binary" if self._bodies() else "")

    def reader(self, schema) -> RawReader:
        return RawReader(self.options["path"], int(self.options.get("split", SPLIT)), self._bodies())


def register(spark: SparkSession) -> None:
    """Makes the format known to a session, with filters handed to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(RawStore)
