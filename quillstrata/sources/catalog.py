"""Data folders: discovery by structure, versions, changes, snapshots, annotations with sidecars (SRC13, SRC14, SRC16, STR2, STR5, STR6, STR10, SNK5).

Folders are listed through Spark's file system, so that any store that Spark reads will do. Listings are of files, a few
hundred at most, and live on the driver.
"""

from __future__ import annotations

import json
import re
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FORMATS = {".jsonl": "json", ".jsonl.gz": "json", ".parquet": "parquet"}
_VERSION = re.compile(r"^(?P<name>.+?)-(?P<date>[0-9]{8})(?P<rest>[^/]*)$")


@dataclass(frozen=True)
class File:
    path: str
    size: int
    modified: int

    @property
    def name(self) -> str:
        return self.path.rstrip("/").rsplit("/", 1)[-1]

    @property
    def ending(self) -> str | None:
        return next((e for e in sorted(FORMATS, key=len, reverse=True) if self.name.endswith(e)), None)

    @property
    def stem(self) -> str:
        return self.name[: -len(self.ending)] if self.ending else self.name


class Store:
    """Spark's file system."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def listed(self, path: str) -> list[File]:
        """What a folder holds, by name; nothing if it isn't there. A folder's size and time are those of its newest part."""
        fs, p = self._at(path)
        if not fs.exists(p):
            return []
        out = []
        for s in fs.listStatus(p):
            own = s.getPath().toString()
            if s.isDirectory():
                inner = [x for x in fs.listStatus(s.getPath()) if not x.isDirectory() and not x.getPath().getName().startswith(("_", "."))]
                out.append(File(own, sum(x.getLen() for x in inner), max([s.getModificationTime(), *[x.getModificationTime() for x in inner]])))
            elif not s.getPath().getName().startswith(("_", ".")):
                out.append(File(own, s.getLen(), s.getModificationTime()))
        return sorted(out, key=lambda f: f.name)

    def folders(self, path: str) -> list[str]:
        fs, p = self._at(path)
        return sorted(s.getPath().toString() for s in fs.listStatus(p) if s.isDirectory() and not s.getPath().getName().startswith((".", "_"))) if fs.exists(p) else []

    def text(self, path: str) -> str | None:
        fs, p = self._at(path)
        return "\n".join(r[0] for r in self.spark.read.option("wholetext", "true").text(path).collect()) if fs.exists(p) else None

    def write_text(self, path: str, text: str) -> None:
        """In one step: a new file that takes the place of the old one."""
        fs, p = self._at(path)
        out = fs.create(p, True)
        out.write(bytearray(text.encode()))
        out.close()

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def rename(self, path: str, to: str) -> None:
        fs, p = self._at(path)
        fs.rename(p, self._at(to)[1])


def open_table(spark: SparkSession, file: File, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read.option("inferTimestamp", "false").option("prefersDate", "false") if FORMATS[file.ending] == "json" else spark.read
    return (reader.schema(schema) if schema else reader).format(FORMATS[file.ending]).load(file.path)


def picked(files: list[File]) -> dict[str, File]:
    """SRC14: of each stem the newest file; of equally new ones jsonl before jsonl.gz before parquet."""
    order = list(FORMATS)
    out: dict[str, File] = {}
    for f in files:
        if f.ending and (f.stem not in out or (f.modified, -order.index(f.ending)) > (out[f.stem].modified, -order.index(out[f.stem].ending))):
            out[f.stem] = f
    return out


@dataclass
class Dataset:
    """SRC13: a folder with a table that has an id and a text; its versions by date, its annotations by level, and what was left aside."""

    folder: str
    versions: dict[str, File] = field(default_factory=dict)
    annotations: dict[str, tuple[File, str]] = field(default_factory=dict)
    ignored: dict[str, str] = field(default_factory=dict)

    @property
    def newest(self) -> File | None:
        return self.versions[max(self.versions)] if self.versions else None


def discover(spark: SparkSession, root: str) -> dict[str, Dataset]:
    """SRC13: the datasets below root, by what their files hold, not by what they are called."""
    store, out = Store(spark), {}
    for folder in store.folders(root):
        ds = Dataset(folder.rstrip("/").rsplit("/", 1)[-1])
        for f in picked(store.listed(folder)).values():
            columns = set(open_table(spark, f).columns)
            if {"id", "text"} <= columns:
                m = _VERSION.match(f.stem)
                ds.versions[m["date"] if m else ""] = f
            else:
                ds.ignored[f.stem] = "no id and text"
        for f in picked(store.listed(f"{folder}/annotations")).values():
            columns = set(open_table(spark, f).columns)
            if "id" in columns:
                ds.annotations[f.stem] = (f, "paragraph" if "para" in columns else "article")
            else:
                ds.ignored[f"annotations/{f.stem}"] = "no id"
        if ds.versions:
            out[ds.folder] = ds
    return out


def with_columns(rows: DataFrame, expected: str) -> tuple[DataFrame, list[str]]:
    """SRC16: rows with all expected columns, those that it lacks as nulls, and the names of these."""
    kinds = T._parse_datatype_string(expected)
    missing = [f.name for f in kinds.fields if f.name not in rows.columns]
    return rows.select(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name in missing else F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in kinds.fields]), missing


class Watch:
    """STR2: tables of a folder that are read again only when their files have changed.

    A file that can't be read keeps its last good table, with the error beside it; vanished files go; between two looks lie at
    least `pause` seconds unless they are forced.
    """

    def __init__(self, spark: SparkSession, folder: str, pause: float = 0.5):
        self.store, self.folder, self.pause = Store(spark), folder, pause
        self.tables: dict[str, tuple[File, DataFrame]] = {}
        self.errors: dict[str, str] = {}
        self._looked = -1e9

    def refresh(self, force: bool = False) -> dict[str, str]:
        """What has happened to each file since the last look: new, changed, kept, broken or gone."""
        if not force and time.monotonic() - self._looked < self.pause:
            return {}
        self._looked = time.monotonic()
        said, now = {}, {f.name: f for f in self.store.listed(self.folder) if f.ending}
        for name in set(self.tables) - set(now):
            del self.tables[name]
            self.errors.pop(name, None)
            said[name] = "gone"
        for name, f in now.items():
            old = self.tables.get(name)
            if old and old[0] == f and name not in self.errors:
                said[name] = "kept"
                continue
            try:
                table = open_table(self.store.spark, f)
                if "_corrupt_record" in table.columns or not table.columns:
                    raise ValueError("no rows that can be read")
                self.errors.pop(name, None)
                self.tables[name] = (f, table)
                said[name] = "changed" if old else "new"
            except Exception as e:  # noqa: BLE001 (whatever the reader says: the last good table stays)
                self.errors[name] = str(e)[:200]
                said[name] = "broken"
        return said


def state_of(df: DataFrame) -> str:
    """A table's row count and an order-free hash of its rows."""
    r = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)]).cast("decimal(38,0)")).alias("h")).first()
    return f"{r['n']}-{r['h'] or 0}"


def stale(made: dict[str, dict[str, str]], now: dict[str, str]) -> dict[str, bool]:
    """STR6: whether any source of a cache is no longer what it was made from. made: cache -> source -> state."""
    return {cache: any(now.get(source) != state for source, state in sources.items()) for cache, sources in made.items()}


def resumable(spark: SparkSession, place: str, source: DataFrame) -> bool:
    """STR5: whether a checkpoint is there whose manifest names this input; a new manifest is written if not."""
    store, state = Store(spark), state_of(source)
    text = store.text(f"{place}/manifest.json")
    if text and json.loads(text) == {"input": state}:
        return True
    store.write_text(f"{place}/manifest.json", json.dumps({"input": state}))
    return False


def publish(df: DataFrame, root: str) -> str:
    """STR10: a table as the next snapshot below root. Older ones stay as they are for those who read them."""
    store = Store(df.sparkSession)
    n = max([int(f.rsplit("/", 1)[-1][1:]) for f in store.folders(root)], default=0) + 1
    path = f"{root}/v{n:08d}"
    df.write.parquet(path)
    return path


def snapshot(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(max(Store(spark).folders(root)))


def write_annotation(rows: DataFrame, path: str, key: list[str], meta: dict, now: str) -> dict:
    """SNK5: rows as JSON lines sorted by key, with a sidecar. Keys must be whole and unique; `created` stays as it was if the rows are the same."""
    bad = rows.groupBy(*key).agg(F.count("*").alias("n")).where((F.col("n") > 1) | F.greatest(*[F.col(k).isNull().cast("int") for k in key], F.lit(0)).cast("boolean"))
    if not bad.isEmpty():
        raise ValueError("keys must be whole and unique")
    store, state = Store(rows.sparkSession), state_of(rows)
    text = store.text(f"{path}.meta.json")
    before = json.loads(text) if text else {}
    side = {**meta, "columns": rows.columns, "state": state, "created": before["created"] if before.get("state") == state else now}
    if before.get("state") != state:
        rows.orderBy(*key).write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}.jsonl")
    store.write_text(f"{path}.meta.json", json.dumps(side, ensure_ascii=False, sort_keys=True))
    return side
