"""Sharding by size-tiered compaction.

Arrivals are appended as small immutable shards. Shards of similar size form a tier; a
tier with enough of them is merged into larger shards, up to the target size, so every
row is rewritten about once a tier. What the store holds is told by a manifest alone:
each change writes the next version under a name of its own and moves it into place in
one step that fails if that version exists, and then starts over from the newer one.
An arrival that was already committed (a replayed micro-batch) is not added again.

Scale: a merge reads whole small files, packed into tasks by size, and writes one
shard a task, with no shuffle; sizes and counts of shards come from the files' own
listing and footers. The manifest has a row per shard and is the only thing that the driver
holds. Files that no retained version names are deleted after the commit, never before.

Defined results: rows are kept as they are, repeated rows, nulls and all columns included; an
empty arrival adds no shard but is remembered as committed; a document is in exactly one shard.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh import scratch


@dataclass(frozen=True)
class Shard:
    number: int
    path: str
    bytes: int
    generation: int  # merges behind it


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    shards: tuple[Shard, ...] = ()
    arrivals: tuple[str, ...] = ()
    next_number: int = 0
    schema: str = ""


@dataclass
class ShardStore:
    """Shards and manifests under ``base``, a folder that the whole cluster can reach."""

    spark: SparkSession
    base: str
    target_bytes: int = 64 << 20
    fanout: int = 4
    retained: int = 1
    compression: str = "zstd"
    _fs: object = field(default=None, repr=False)

    def __post_init__(self) -> None:
        self._jvm = self.spark._jvm
        self._conf = self.spark._jsc.hadoopConfiguration()
        self._fs = self._path(self.base).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _list(self, folder: str) -> list[tuple[str, int]]:
        where = self._path(folder)
        if not self._fs.exists(where):
            return []
        return sorted((s.getPath().toString(), s.getLen()) for s in self._fs.listStatus(where) if not s.getPath().getName().startswith(("_", ".")))

    # the manifest

    def manifest(self, version: int | None = None) -> Manifest:
        """The newest committed version, or the one told."""
        found = [p for p, _ in self._list(f"{self.base}/manifest") if p.endswith(".json")]
        if version is not None:
            found = [p for p in found if p.endswith(f"/{version:012d}.json")]
        if not found:
            return Manifest()
        stream = self._fs.open(self._path(found[-1]))
        try:
            got = json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()
        return Manifest(**got | {"shards": tuple(Shard(**s) for s in got["shards"]), "arrivals": tuple(got["arrivals"])})

    def _commit(self, new: Manifest) -> bool:
        """Whether ``new`` became its version; False if another writer was first."""
        draft = self._path(f"{self.base}/manifest/.{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        out.write(bytearray(json.dumps(asdict(new)).encode()))
        out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self._conf)
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        never_over = self.spark.sparkContext._gateway.new_array(rename, 0)
        try:
            context.rename(context.makeQualified(draft), context.makeQualified(self._path(f"{self.base}/manifest/{new.version:012d}.json")), never_over)
        except Exception as e:
            self._fs.delete(draft, False)
            if "FileAlreadyExists" in str(e):
                return False
            raise
        return True

    # changes

    def append(self, arrival: DataFrame, name: str | None = None) -> Manifest:
        """Adds the rows as small shards; ``name`` tells a replay of the same arrival."""
        name = name or uuid.uuid4().hex
        if name in self.manifest().arrivals:
            return self.manifest()
        written = self._write(arrival)
        while True:
            old = self.manifest()
            if name in old.arrivals:
                return old
            shards = [Shard(old.next_number + k, p, n, 0) for k, (p, n) in enumerate(written)]
            new = replace(
                old,
                version=old.version + 1,
                shards=(*old.shards, *shards),
                arrivals=(*old.arrivals, name),
                next_number=old.next_number + len(shards),
                schema=old.schema or arrival.schema.json(),
            )
            if self._commit(new):
                return new

    def _write(self, rows: DataFrame) -> list[tuple[str, int]]:
        folder = f"{self.base}/shards/{uuid.uuid4().hex}"
        rows.write.option("compression", self.compression).parquet(folder)
        return self._list(folder)

    def tier(self, shard: Shard) -> int:
        """The number of times that the fan-out goes into the target over the shard's size; shards of half the target and over have none."""
        t, size = 0, max(shard.bytes, 1)
        while size * 2 < self.target_bytes and t < 12:
            size *= self.fanout
            t += 1
        return t

    def compact(self) -> Manifest:
        """Merges the fullest tier again and again, until none has as many shards as the fan-out."""
        while True:
            old = self.manifest()
            tiers: dict[int, list[Shard]] = {}
            for s in old.shards:
                if t := self.tier(s):
                    tiers.setdefault(t, []).append(s)
            ready = {t: s for t, s in tiers.items() if len(s) >= self.fanout}
            if not ready:
                return old
            chosen = ready[max(ready)]
            with self._packed():
                merged = self._write(self.read(old, chosen))
            if len(merged) >= len(chosen):  # the session's settings keep files apart
                return old
            gone = {s.number for s in chosen}
            number = old.next_number
            shards = [Shard(number + k, p, n, 1 + max(s.generation for s in chosen)) for k, (p, n) in enumerate(merged)]
            kept = tuple(s for s in old.shards if s.number not in gone)
            new = replace(old, version=old.version + 1, shards=(*kept, *shards), next_number=number + len(shards))
            if self._commit(new):
                self.vacuum()

    @contextmanager
    def _packed(self) -> Iterator[None]:
        """Scans pack whole files up to the target into a task."""
        want = {"spark.sql.files.maxPartitionBytes": str(self.target_bytes), "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
        before = {k: self.spark.conf.get(k, None) for k in want}
        for k, v in want.items():
            self.spark.conf.set(k, v)
        try:
            yield
        finally:
            for k, v in before.items():
                self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)

    def vacuum(self) -> None:
        """Deletes shard folders that none of the last ``retained`` versions names, and older manifests."""
        newest = self.manifest().version
        held = {s.path.rsplit("/", 2)[1] for v in range(max(1, newest - self.retained + 1), newest + 1) for s in self.manifest(v).shards}
        known = {s.path.rsplit("/", 2)[1] for p, _ in self._list(f"{self.base}/manifest") for s in self.manifest(int(p[-17:-5])).shards}
        for folder in known - held:  # folders that no version ever named may be another writer's
            self._fs.delete(self._path(f"{self.base}/shards/{folder}"), True)
        for p, _ in self._list(f"{self.base}/manifest"):
            if int(p[-17:-5]) <= newest - self.retained:
                self._fs.delete(self._path(p), False)

    # reading

    def read(self, manifest: Manifest | None = None, shards: list[Shard] | None = None) -> DataFrame:
        """The rows of a version, or of some of its shards."""
        from pyspark.sql.types import StructType

        manifest = manifest or self.manifest()
        schema = StructType.fromJson(json.loads(manifest.schema)) if manifest.schema else StructType()
        paths = [s.path for s in (manifest.shards if shards is None else shards)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def ingest(self, source: str, schema, files_per_arrival: int, checkpoint: str) -> Manifest:
        """Streams in the files of a folder (or a single one), so many an arrival, compacting after each; resumes from its
        checkpoint."""
        pattern = f"{source[:-1]}[{source[-1]}]"  # a stream reads a single file only by a pattern
        stream = self.spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_arrival).parquet(pattern)

        def arrive(batch: DataFrame, number: int) -> None:
            self.append(batch, f"{checkpoint.rsplit('/', 1)[-1]}-{number}")
            self.compact()

        query = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(arrive).start()
        query.awaitTermination()
        return self.manifest()

    def located(self, *columns: str) -> DataFrame:
        """The columns told, with the shard's number, generation and size, of every row of the newest version."""
        now = self.manifest()
        places = [(s.path.rsplit("/", 2)[1] + "/" + s.path.rsplit("/", 1)[1], s.number, s.generation, s.bytes) for s in now.shards]
        rows = self.read(now)
        place = scratch.free_name("__qm_place", rows)
        of = self.spark.createDataFrame(places, f"{place} string, shard bigint, generation int, shard_bytes bigint")
        if not places:
            return rows.select(*columns).join(of.drop(place), F.lit(False))
        file = rows.metadataColumn("_metadata")
        at = F.element_at(F.split(file.getField("file_path"), "/"), -2)
        rows = rows.select(*columns, F.concat(at, F.lit("/"), file.getField("file_name")).alias(place))
        return rows.join(of, place).drop(place).withColumn("version", F.lit(now.version).cast("long"))
