"""Published versions of a set of tables: manifests over folders that are written once (copy on write).

Layout under ``root``::

    root/<layer>/<table>/load=v000002/[<part>/]*.parquet   what load 2 wrote of a table, by part (a month, a block of ids)
    root/v=000002/manifest/                                every file of every table of version 2, with its rows and key ranges
    root/v=000002/tables/                                  schema, digest and part columns of each table
    root/_CURRENT                                          names the published version

A load writes only the parts it changes. Its manifest names the new files of those
parts and, for all other parts, the files that the version before it named, so
they are neither read nor copied. Readers resolve the pointer once; it is swapped after
manifest and data are complete, so a load that fails leaves the old version live.
What a reader holds on the driver is a folder per (table, part), bounded by the
calendar and the number of id blocks; the list of files stays a table.
``vacuum`` deletes the folders that no kept manifest names.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINTER = "_CURRENT"

#: Keys whose range each file's entry holds, by the columns that carry them.
KEYS = {"order": ("order_id", "id"), "customer": ("customer_id",)}

#: Entries of a manifest that the driver may hold to look files up; a larger manifest is filtered as a table.
HELD_FILES = 20_000

_ENTRY = ("layer string, table string, part string, folder string, file string, rows long, order_low long, order_high long, "
          "customer_low long, customer_high long")
_TABLE = "layer string, table string, schema string, parts string, digest string, whole string"


# -- files ---------------------------------------------------------------------------------
def _fs(path: str):
    """Hadoop FileSystem + Path for ``path`` (local disk, HDFS or an object store alike)."""
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()  # writer threads have no active session
    hp = spark._jvm.org.apache.hadoop.fs.Path(path)
    return spark, hp.getFileSystem(spark._jsc.hadoopConfiguration()), hp


def exists(path: str) -> bool:
    _, fs, hp = _fs(path)
    return bool(fs.exists(hp))


def names_in(path: str) -> list[str]:
    _, fs, hp = _fs(path)
    return [s.getPath().getName() for s in fs.listStatus(hp)] if fs.exists(hp) else []


def current_version(root: str) -> str | None:
    spark, fs, hp = _fs(f"{root.rstrip('/')}/{POINTER}")
    if not fs.exists(hp):
        return None
    jio = spark._jvm.java.io
    reader = jio.BufferedReader(jio.InputStreamReader(fs.open(hp), "UTF-8"))
    try:
        return reader.readLine().strip()
    finally:
        reader.close()


def next_version(root: str) -> str:
    _, fs, hp = _fs(root)
    fs.mkdirs(hp)
    nums = [int(d[2:]) for d in names_in(root) if d.startswith("v=") and d[2:].isdigit()]
    version = f"v={max(nums, default=0) + 1:06d}"
    fs.mkdirs(_fs(f"{root.rstrip('/')}/{version}")[2])  # a load that fails keeps its number
    return version


def publish(root: str, version: str) -> None:
    """Point readers at ``version``: write a small temp file, then rename it over the pointer (atomic on HDFS and local disks)."""
    spark, fs, tmp = _fs(f"{root.rstrip('/')}/{POINTER}.tmp")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(version.encode("utf-8")))
    finally:
        out.close()
    hfs = spark._jvm.org.apache.hadoop.fs
    dst = hfs.Path(f"{root.rstrip('/')}/{POINTER}")
    fc = hfs.FileContext.getFileContext(dst.toUri(), spark._jsc.hadoopConfiguration())
    opts = spark.sparkContext._gateway.new_array(hfs.Options.Rename, 1)
    opts[0] = hfs.Options.Rename.OVERWRITE
    fc.rename(fs.makeQualified(tmp), fs.makeQualified(dst), opts)


# -- digests --------------------------------------------------------------------------------
def digest_of(df: DataFrame) -> Column:
    """An order-free digest of all rows as one aggregate: count, sum and xor of row hashes (columns by name)."""
    row = F.xxhash64(*[F.col(c) for c in sorted(df.columns)])
    return F.concat_ws(":", F.count(F.lit(1)), F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0)), F.coalesce(F.bit_xor(row), F.lit(0)))


def digests(tables: dict[str, DataFrame]) -> dict[str, str]:
    """Digest of each table; all are aggregated in one job."""
    if not tables:
        return {}
    each = [df.agg(digest_of(df).alias("digest")).select(F.lit(name).alias("name"), "digest") for name, df in tables.items()]
    return {r["name"]: r["digest"] for r in reduce(DataFrame.unionByName, each).collect()}


# -- readers --------------------------------------------------------------------------------
class Version:
    """One version of the tables under ``root``."""

    def __init__(self, spark: SparkSession, root: str, version: str):
        self.spark, self.root, self.version = spark, root.rstrip("/"), version

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> "Version":
        version = current_version(root)
        if version is None:
            raise FileNotFoundError(f"no published version under {root}")
        return cls(spark, root, version)

    @property
    def path(self) -> str:
        return f"{self.root}/{self.version}"

    @cached_property
    def entries(self) -> DataFrame:
        """The manifest: a row per file."""
        return self.spark.read.schema(_ENTRY).parquet(f"{self.path}/manifest")

    @cached_property
    def _tables(self) -> dict[tuple[str, str], dict]:
        rows = self.spark.read.schema(_TABLE).parquet(f"{self.path}/tables").collect()  # a row per table
        return {(r.layer, r.table): {"schema": T.StructType.fromJson(json.loads(r.schema)), "parts": [p for p in r.parts.split(",") if p],
                                     "digest": r.digest, "whole": r.whole} for r in rows}

    @cached_property
    def _folders(self) -> dict[tuple[str, str], dict[str, str]]:
        out: dict[tuple[str, str], dict[str, str]] = {key: {} for key in self._tables}
        for r in self.entries.select("layer", "table", "part", "folder").distinct().collect():  # months and blocks, not files
            out[r.layer, r.table][r.part] = r.folder
        return out

    def tables(self) -> list[tuple[str, str]]:
        return list(self._tables)

    def schema(self, layer: str, table: str) -> T.StructType:
        return self._tables[layer, table]["schema"]

    def digest(self, layer: str, table: str) -> str | None:
        return self._tables[layer, table]["digest"]

    def parts(self, layer: str, table: str) -> dict[str, str]:
        """Folder of each part."""
        return self._folders[layer, table]

    def _scan(self, layer: str, table: str, paths: list[str]) -> DataFrame:
        about = self._tables[layer, table]
        if not paths:
            return self.spark.createDataFrame([], about["schema"])
        base = f"{self.root}/{layer}/{table}"
        types = {f.name: f for f in about["schema"].fields}
        found = T.StructType([f for f in about["schema"].fields if f.name not in about["parts"]] + [types[p] for p in about["parts"]])
        return self.spark.read.schema(found).option("basePath", base).parquet(*paths).select(*about["schema"].names)

    def read(self, layer: str, table: str, parts: Iterable[str] | None = None) -> DataFrame:
        """A table, or those of its ``parts`` that it has; part columns are columns of it and prune folders."""
        folders = self.parts(layer, table)
        if parts is not None:
            return self._scan(layer, table, sorted(f"{self.root}/{folders[p]}" for p in parts if p in folders))
        known = self.__dict__.setdefault("_frames", {})
        if (layer, table) not in known:  # a version does not change, so its folders are listed once
            whole = self._tables[layer, table]["whole"]
            paths = [f"{self.root}/{whole}"] if whole and folders else sorted(f"{self.root}/{f}" for f in folders.values())
            known[layer, table] = self._scan(layer, table, paths)
        return known[layer, table]

    @cached_property
    def _held(self) -> list | None:
        """The manifest's files of tables in parts, where they are few enough to be held by the driver."""
        rows = self.entries.where("order_low IS NOT NULL OR customer_low IS NOT NULL").limit(HELD_FILES + 1).collect()
        return rows if len(rows) <= HELD_FILES else None

    def candidates(self, layer: str, table: str, key: str, values: list[int], parts: Iterable[str] | None = None) -> list[str]:
        """Files that may hold one of the few ``values`` of ``key`` (order or customer): the manifest filtered by its ranges."""
        if self._held is not None:
            wanted = None if parts is None else set(parts)
            mine = [r for r in self._held if (r.layer, r.table) == (layer, table) and (wanted is None or r.part in wanted)]
            return sorted(r.file for r in mine if any(r[f"{key}_low"] <= v <= r[f"{key}_high"] for v in values))
        low, high = F.col(f"{key}_low"), F.col(f"{key}_high")
        hit = reduce(lambda a, b: a | b, [(low <= v) & (high >= v) for v in values], F.lit(False))
        rows = self.entries.where((F.col("layer") == layer) & (F.col("table") == table) & hit)
        if parts is not None:
            rows = rows.where(F.col("part").isin(list(parts)))
        return sorted(r.file for r in rows.select("file").collect())

    def lookup(self, layer: str, table: str, key: str, values: list[int], parts: Iterable[str] | None = None) -> DataFrame:
        """Rows whose ``key`` is one of a few ``values``, from the candidate files only (Bloom filters skip their row groups)."""
        files = self.candidates(layer, table, key, values, parts)
        found = self._scan(layer, table, [f"{self.root}/{f}" for f in files])
        column = next(c for c in KEYS[key] if c in found.columns)
        return found.where(F.col(column).isin(values) if len(values) > 1 else F.col(column) == values[0])


# -- loads ----------------------------------------------------------------------------------
class Load(Version):
    """A version being written: new folders for what changes, the previous version's for the rest."""

    def __init__(self, spark: SparkSession, root: str, version: str, previous: Version | None = None):
        super().__init__(spark, root, version)
        self.previous = previous
        #: (layer, table) -> parts of the previous version that this load replaces (None: all).
        self._replaced: dict[tuple[str, str], set[str] | None] = {}
        self.__dict__["_tables"] = dict(previous._tables) if previous else {}
        self.__dict__["_folders"] = {k: dict(v) for k, v in previous._folders.items()} if previous else {}

    def _folder(self, layer: str, table: str) -> str:
        return f"{layer}/{table}/load={self.version[2:]}"

    def write(self, df: DataFrame, layer: str, table: str, parts: tuple[str, ...] = (), replaces: Iterable[str] | None = None,
              digest: str | None = None, bloom: Iterable[str] = (), ids: int | None = None) -> None:
        """Write ``df`` as the new content of the table, or of the parts that it ``replaces`` (those may come to be empty).

        ``ids``: different ids that a file may hold, for the size of its Bloom filters (else each takes Parquet's most, 1 MB)."""
        folder = self._folder(layer, table)
        out = df.write.mode("overwrite").option("compression", "zstd")
        for column in bloom:
            out = out.option(f"parquet.bloom.filter.enabled#{column}", "true")
            if ids:
                out = out.option(f"parquet.bloom.filter.expected.ndv#{column}", str(ids))
        if parts:
            out = out.partitionBy(*parts)
        out.parquet(f"{self.root}/{folder}")
        key = (layer, table)
        self._replaced[key] = None if replaces is None else set(replaces)
        # ``whole``: the folder of one load that is all of the table, so that it need not be read part by part
        self._tables[key] = {"schema": df.schema, "parts": list(parts), "digest": digest, "whole": folder if replaces is None else None}
        self.__dict__.get("_frames", {}).pop(key, None)
        kept = {} if replaces is None else {p: f for p, f in self._folders.get(key, {}).items() if p not in self._replaced[key]}
        self._folders[key] = {**kept, **{p: f"{folder}/{p}".rstrip("/") for p in self._written(folder, parts)}}

    def note_digest(self, layer: str, table: str, digest: str) -> None:
        self._tables[layer, table]["digest"] = digest

    def _written(self, folder: str, parts: tuple[str, ...]) -> list[str]:
        """Parts that exist under a folder of this load."""
        found = [""]
        for column in parts:
            found = [f"{p}/{name}".lstrip("/") for p in found for name in names_in(f"{self.root}/{folder}/{p}".rstrip("/")) if name.startswith(f"{column}=")]
        return found

    def _files(self, layer: str, table: str) -> DataFrame:
        """Entries of the files that this load wrote of a table. Ranges of its keys, where rows are looked up (tables in parts), come
        from one column-pruned aggregate; other tables are listed."""
        folder = self._folder(layer, table)
        about = self._tables[layer, table]
        if not about["parts"]:
            names = [n for n in names_in(f"{self.root}/{folder}") if n.endswith(".parquet")]
            none = (None,) * 5
            return self.spark.createDataFrame([(layer, table, "", folder, f"{folder}/{n}", *none) for n in names], _ENTRY)
        inner = T.StructType([f for f in about["schema"].fields if f.name not in about["parts"]])
        rows = self.spark.read.schema(inner).option("recursiveFileLookup", "true").parquet(f"{self.root}/{folder}")
        rows = rows.select("*", F.col("_metadata.file_path").alias("_path"))
        ranges = []
        for key, columns in KEYS.items():
            column = next((c for c in columns if c in inner.names and isinstance(inner[c].dataType, T.LongType)), None)
            if key == "order" and column == "id" and table != "orders":
                column = None
            ranges += [(F.min(column) if column else F.lit(None).cast("long")).alias(f"{key}_low"),
                       (F.max(column) if column else F.lit(None).cast("long")).alias(f"{key}_high")]
        each = rows.groupBy("_path").agg(F.count(F.lit(1)).alias("rows"), *ranges)
        below = F.regexp_extract("_path", f"/load={self.version[2:]}/(.*)$", 1)
        part = F.regexp_replace(F.regexp_replace(below, "[^/]*$", ""), "/$", "")
        return each.select(F.lit(layer).alias("layer"), F.lit(table).alias("table"), part.alias("part"),
                           F.when(part == "", folder).otherwise(F.concat(F.lit(f"{folder}/"), part)).alias("folder"),
                           F.concat(F.lit(f"{folder}/"), below).alias("file"), "rows", "order_low", "order_high", "customer_low", "customer_high")

    def finish(self) -> None:
        """Write tables and manifest; the version can then be read and published."""
        rows = [(layer, table, a["schema"].json(), ",".join(a["parts"]), a["digest"], a["whole"]) for (layer, table), a in self._tables.items()]
        self.spark.createDataFrame(rows, _TABLE).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/tables")
        new = [self._files(*key) for key in self._replaced if self._folders[key]]
        if self.previous is not None:
            gone = [f"{la}/{ta}/" for (la, ta), p in self._replaced.items() if p is None]
            gone_parts = [f"{la}/{ta}/{p}" for (la, ta), ps in self._replaced.items() for p in ps or ()]
            name = F.concat_ws("/", "layer", "table", F.lit(""))
            kept = self.previous.entries.where(~name.isin(gone) & ~F.concat(name, F.col("part")).isin(gone_parts))
            new.append(kept)
        entries = reduce(DataFrame.unionByName, new) if new else self.spark.createDataFrame([], _ENTRY)
        entries.coalesce(8).write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/manifest")
        self.__dict__.pop("entries", None)

    def wrote(self) -> DataFrame:
        """Entries of this load's own files (after ``finish``)."""
        return self.entries.where(F.col("folder").contains(f"/load={self.version[2:]}"))


def run_parallel(jobs: list[tuple], step, threads: int = 8) -> None:
    """Run independent write steps from a few driver threads (Spark runs their jobs side by side)."""
    if jobs:
        with ThreadPoolExecutor(max_workers=min(threads, len(jobs))) as ex:
            for f in [ex.submit(step, *j) for j in jobs]:
                f.result()


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete the folders that neither the published version nor the ``keep`` newest versions with a manifest name; returns them.

    Run it while no load writes. Versions older than those kept can no longer be opened."""
    root = root.rstrip("/")
    finished = [v for v in sorted(names_in(root)) if v.startswith("v=") and "manifest" in names_in(f"{root}/{v}") and "_SUCCESS" in names_in(f"{root}/{v}/manifest")]
    now = current_version(root)
    kept = set(finished[-keep:] if keep else []) | ({now} if now else set())
    used = {folder for v in kept for folders in Version(spark, root, v)._folders.values() for folder in folders.values()}
    loads = {"/".join(f.split("/")[:3]) for f in used}
    gone = []
    for layer in names_in(root):
        if layer.startswith(("v=", "_", ".")):
            continue
        for table in names_in(f"{root}/{layer}"):
            for load in names_in(f"{root}/{layer}/{table}"):
                base = f"{layer}/{table}/{load}"
                if not load.startswith("load="):
                    continue
                if base not in loads:
                    gone.append(base)
                    continue
                mine = {f for f in used if f == base or f.startswith(f"{base}/")}
                if base not in mine:  # its parts, down to the folders that hold files
                    depth = max(f.count("/") for f in mine) - 2
                    found = [base]
                    for _ in range(depth):
                        found = [f"{p}/{n}" for p in found for n in names_in(f"{root}/{p}") if "=" in n]
                    gone += [f for f in found if f not in mine]
    for folder in gone:
        _, fs, hp = _fs(f"{root}/{folder}")
        fs.delete(hp, True)
    for v in names_in(root):
        if v.startswith("v=") and v not in kept and v in finished:
            _, fs, hp = _fs(f"{root}/{v}")
            fs.delete(hp, True)
            gone.append(v)
    return gone
