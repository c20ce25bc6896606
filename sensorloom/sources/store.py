"""Tables kept as immutable pieces by partition, behind a versioned manifest.

A piece is what one load wrote for one value of a table's partition column. The manifest names the
pieces that count, with their rows; each change writes new pieces and then a new manifest, in one
step for all its tables. So a load reads and rewrites only the partitions that it touches, all other
files stay as they are, rows are known without counting them, and a reader never meets half a load.
"""

import json
import uuid
from collections.abc import Callable, Collection, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from sensorloom.functions.columns import column
from sensorloom.operators.dedup import first_per_key

# A partition of so many pieces is written anew as one when rows are added to it.
MOST_PIECES = 8
MANIFESTS, STAGING = "_manifests", "_staging"


@dataclass(frozen=True)
class Piece:
    """The rows of one partition in the folder of one load."""

    load: str
    rows: int


@dataclass(frozen=True)
class TableState:
    """A table's columns and the pieces of each partition, oldest first."""

    partition: str
    schema: StructType
    pieces: dict[str, tuple[Piece, ...]]

    @property
    def rows(self) -> int:
        return sum(piece.rows for pieces in self.pieces.values() for piece in pieces)


@dataclass(frozen=True)
class Manifest:
    """All tables as of one version, and the last micro-batch that has been taken in."""

    version: int = 0
    batch: int | None = None
    tables: dict[str, TableState] = field(default_factory=dict)

    def to_json(self) -> str:
        tables = {
            name: {
                "partition": state.partition,
                "schema": state.schema.jsonValue(),
                "pieces": {v: [[p.load, p.rows] for p in pieces] for v, pieces in state.pieces.items()},
            }
            for name, state in self.tables.items()
        }
        return json.dumps({"version": self.version, "batch": self.batch, "tables": tables})

    @staticmethod
    def from_json(text: str) -> "Manifest":
        given = json.loads(text)
        tables = {
            name: TableState(
                state["partition"],
                StructType.fromJson(state["schema"]),
                {v: tuple(Piece(*p) for p in pieces) for v, pieces in state["pieces"].items()},
            )
            for name, state in given["tables"].items()
        }
        return Manifest(given["version"], given["batch"], tables)


class ConflictError(RuntimeError):
    """Another change has been committed since this one began."""


class PieceStore:
    """The tables in one folder, which all executors see. Partition columns are dates, numbers or
    plain words without NULLs."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, *names: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *names]))
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def children(self, *names: str) -> list[str]:
        path, files = self._path(*names)
        return sorted(s.getPath().getName() for s in files.listStatus(path)) if files.exists(path) else []

    def delete(self, *names: str) -> None:
        path, files = self._path(*names)
        files.delete(path, True)

    def versions(self) -> list[int]:
        names = self.children(MANIFESTS)
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != ".")

    def manifest(self, version: int | None = None) -> Manifest:
        """The newest manifest or that of a version; an empty one before the first change."""
        if version is None:
            version = max(self.versions(), default=0)
        if version == 0:
            return Manifest()
        path, files = self._path(MANIFESTS, f"{version}.json")
        stream = files.open(path)
        try:
            return Manifest.from_json(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def publish(self, manifest: Manifest) -> None:
        """Write a manifest whole under a name of its own, then give it its number. Of two changes
        that began with the same version only one gets it."""
        draft, files = self._path(MANIFESTS, f".{uuid.uuid4().hex}")
        stream = files.create(draft, False)
        stream.write(bytearray(manifest.to_json().encode()))
        stream.close()
        final, _ = self._path(MANIFESTS, f"{manifest.version}.json")
        if files.exists(final) or not files.rename(draft, final):
            files.delete(draft, False)
            raise ConflictError(f"version {manifest.version} of {self.folder} exists")

    def read(self, name: str, values: Collection[str] | None = None, version: int | None = None) -> DataFrame | None:
        """A table, or its partitions of some values; None if the store has no such table."""
        state = self.manifest(version).tables.get(name)
        return None if state is None else self.pieces(name, state, values)

    def pieces(self, name: str, state: TableState, values: Collection[str] | None = None) -> DataFrame:
        """The rows of a table's pieces. Only the folders of the named values are listed."""
        chosen = state.pieces if values is None else [v for v in values if v in state.pieces]
        loads = [(piece.load, v) for v in chosen for piece in state.pieces[v]]
        return self.folders(name, state, loads)

    def folders(self, name: str, state: TableState, loads: Sequence[tuple[str, str]]) -> DataFrame:
        if not loads:
            return self.spark.createDataFrame([], state.schema)
        paths = [f"{self.folder}/{name}/load={load}/{state.partition}={value}" for load, value in loads]
        reader = self.spark.read.schema(state.schema).option("basePath", f"{self.folder}/{name}")
        return reader.parquet(*paths).select(*[column(n) for n in state.schema.names])

    def begin(self, batch: int | None = None) -> "Change | None":
        """A new change; None if a micro-batch of this or a later number has been taken in."""
        manifest = self.manifest()
        if batch is not None and manifest.batch is not None and batch <= manifest.batch:
            return None
        return Change(self, manifest, batch)

    def vacuum(self, keep: int = 2) -> int:
        """Remove all but the newest ``keep`` manifests and the pieces that none of those names;
        the number of pieces removed. No change may be under way, and readers of older versions
        lose their files."""
        versions = self.versions()
        kept = [self.manifest(version) for version in versions[-keep:]]
        used = {
            (name, piece.load, value)
            for manifest in kept
            for name, state in manifest.tables.items()
            for value, pieces in state.pieces.items()
            for piece in pieces
        }
        for version in versions[:-keep]:
            self.delete(MANIFESTS, f"{version}.json")
        self.delete(STAGING)
        removed = 0
        for name in self.children():
            for load in self.children(name) if not name.startswith("_") else ():
                values = [v for v in self.children(name, load) if "=" in v]
                gone = [v for v in values if (name, load.removeprefix("load="), v.split("=", 1)[1]) not in used]
                for value in gone if len(gone) < len(values) else ():
                    self.delete(name, load, value)
                if len(gone) == len(values):
                    self.delete(name, load)
                removed += len(gone)
        return removed


class Change:
    """Pieces written for one new version of a store. Nothing counts before ``commit``."""

    def __init__(self, store: PieceStore, base: Manifest, batch: int | None) -> None:
        self.store, self.base, self.batch = store, base, batch
        self.tables = dict(base.tables)
        self.staged: list[str] = []

    def _write(
        self, name: str, rows: DataFrame, partition: str, keys: Sequence[str] = ()
    ) -> tuple[TableState, list[str]]:
        """Write rows by partition and tell which values came. Rows of a value are gathered into
        few files sorted by ``keys``, and a value of very many rows is split."""
        load = uuid.uuid4().hex
        folder = f"{self.store.folder}/{name}/load={load}"
        spread = rows.hint("rebalance", partition).sortWithinPartitions(*[column(c) for c in (partition, *keys)])
        spread.write.partitionBy(partition).parquet(folder)
        names = self.store.children(name, f"load={load}")
        values = [n.split("=", 1)[1] for n in names if n.startswith(f"{partition}=")]
        state = TableState(partition, rows.schema, {v: (Piece(load, -1),) for v in values})
        return state, values

    def _counted(self, name: str, written: TableState, values: Collection[str]) -> dict[str, Piece]:
        """The new pieces of some values with their rows, which Parquet keeps apart from the data."""
        if not values:
            return {}
        rows = self.store.pieces(name, written, values)
        key = F.col(f"`{written.partition}`").cast("string")
        counts = {r["value"]: r["count"] for r in rows.groupBy(key.alias("value")).count().collect()}
        return {v: Piece(written.pieces[v][0].load, counts.get(v, 0)) for v in values}

    def _drop(self, name: str, written: TableState, values: Collection[str]) -> None:
        for value in values:
            self.store.delete(name, f"load={written.pieces[value][0].load}", f"{written.partition}={value}")

    def _state(self, name: str, written: TableState) -> TableState:
        state = self.tables.get(name)
        if state is None:
            return TableState(written.partition, written.schema, {})
        if state.partition != written.partition or state.schema.names != written.schema.names:
            raise ValueError(f"{name} has other columns or another partition column")
        return state

    def _take(self, name: str, state: TableState, added: dict[str, Piece], replaced: dict[str, Piece]) -> int:
        """Put pieces into a table; by how many rows it has grown."""
        pieces = dict(state.pieces)
        for value, piece in added.items():
            pieces[value] = (*pieces.get(value, ()), piece)
        for value, piece in replaced.items():
            pieces[value] = (piece,)
        self.tables[name] = TableState(state.partition, state.schema, pieces)
        return self.tables[name].rows - state.rows

    def append(self, name: str, rows: DataFrame, partition: str) -> int:
        """Add rows as they are."""
        written, values = self._write(name, rows, partition)
        return self._take(name, self._state(name, written), self._counted(name, written, values), {})

    def insert_new(
        self,
        name: str,
        rows: DataFrame,
        keys: Sequence[str],
        partition: str,
        order: Sequence[str] = (),
        most_pieces: int = MOST_PIECES,
    ) -> int:
        """Add the first row by ``order`` of each key that the table lacks; how many were added.

        The partition column must follow from the keys. Rows are reduced to one per key and written
        once; where their partitions are new that is all. Else the keys of those partitions alone
        are read and the rows without them are written again. A partition that has ``most_pieces``
        pieces is then rewritten as one, so no read opens more. A NULL key is never in a table.
        """
        written, values = self._write(name, first_per_key(rows, keys, order), partition, keys)
        state = self._state(name, written)
        known = [v for v in values if v in state.pieces]
        added = self._counted(name, written, [v for v in values if v not in state.pieces])
        replaced: dict[str, Piece] = {}
        if known:
            stored = self.store.pieces(name, state, known)
            fresh = self.store.pieces(name, written, known).join(
                stored.select(*[column(k) for k in keys]), list(keys), "left_anti"
            ).select(*[column(c) for c in written.schema.names])
            full = [v for v in known if len(state.pieces[v]) >= most_pieces]
            if full:
                fresh = fresh.union(self.store.pieces(name, state, full))
            again, come = self._write(name, fresh, partition, keys)
            pieces = self._counted(name, again, come)
            added |= {v: piece for v, piece in pieces.items() if v not in full}
            replaced = {v: piece for v, piece in pieces.items() if v in full}
            self._drop(name, written, known)
        return self._take(name, state, added, replaced)

    def upsert(
        self, name: str, rows: DataFrame, keys: Sequence[str], partition: str, order: Sequence[str] = ()
    ) -> int:
        """Add the last row by ``order`` of each key, in place of the row that the table has; by how
        many rows it has grown. The partition column must follow from the keys."""
        load = "_load"
        while load in rows.columns:
            load += "_"

        def newer(old: DataFrame, new: DataFrame) -> DataFrame:
            both = old.withColumn(load, F.lit(0)).union(new.withColumn(load, F.lit(1)))
            return first_per_key(both, keys, [load], last=True).drop(load)

        return self._rewrite(name, first_per_key(rows, keys, order, last=True), keys, partition, newer)

    def merge(
        self,
        name: str,
        rows: DataFrame,
        keys: Sequence[str],
        partition: str,
        combine: Callable[[DataFrame], DataFrame],
    ) -> int:
        """Merge partial results into those that the table has. ``combine`` makes one row per key of
        any rows of the table's columns, the same whatever their order and grouping."""
        return self._rewrite(name, combine(rows), keys, partition, lambda old, new: combine(old.union(new)))

    def _rewrite(
        self,
        name: str,
        rows: DataFrame,
        keys: Sequence[str],
        partition: str,
        combined: Callable[[DataFrame, DataFrame], DataFrame],
    ) -> int:
        """Write rows and put them together with the stored rows of their partitions; partitions
        without incoming rows are neither read nor written."""
        written, values = self._write(name, rows, partition, keys)
        state = self._state(name, written)
        known = [v for v in values if v in state.pieces]
        added = self._counted(name, written, [v for v in values if v not in state.pieces])
        replaced: dict[str, Piece] = {}
        if known:
            both = combined(self.store.pieces(name, state, known), self.store.pieces(name, written, known))
            again, come = self._write(name, both.select(*[column(c) for c in written.schema.names]), partition, keys)
            replaced = self._counted(name, again, come)
            self._drop(name, written, known)
        return self._take(name, state, added, replaced)

    def stage(self, rows: DataFrame) -> DataFrame:
        """Rows written once for the tables of this change that derive from them; they go when it
        is committed."""
        self.staged.append(uuid.uuid4().hex)
        folder = f"{self.store.folder}/{STAGING}/{self.staged[-1]}"
        rows.write.parquet(folder)
        return self.store.spark.read.schema(rows.schema).parquet(folder)

    def commit(self) -> Manifest:
        """Make all that was written count at once."""
        batch = self.base.batch if self.batch is None else self.batch
        manifest = Manifest(self.base.version + 1, batch, self.tables)
        self.store.publish(manifest)
        for name in self.staged:
            self.store.delete(STAGING, name)
        return manifest
