"""Tables in versions: new files beside old ones, made visible by one small file.

    <path>/data/__load=<id>/<partition>=<value>/   rows of one load, never changed
    <path>/index/__load=<id>/<partition>=<value>/  hashes of the keys those rows can be found by
    <path>/versions/<number>.json                which folders make up a version, and of what it was made

A version becomes visible when its file is renamed into place. A writer that stops before leaves
the version before, one that stops after leaves its own; no reader sees a partition
twice or not at all. A reader keeps the files of the version it began with until :meth:`vacuum`
removes them. One writer at a time: a second one that takes the same number fails and changes nothing.

The index holds one 64-bit hash per distinct key and partition, so that finding the partitions a batch
depends on reads neither the rows nor the key columns of the table. Equal hashes of different
keys open a partition too many and change no result.
"""

from __future__ import annotations

import datetime
import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from admere.operators.versions import latest_version
from admere.session import release, remove_folder, stable

#: Key columns by which rows of a batch find rows of the table, and a condition in SQL those rows meet.
Link = tuple[Sequence[str], str | None]

#: Fixed value: the folder name of a partition without a value.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"

#: Hashes of a batch that are broadcast at most; beyond that the join with the index is shuffled.
BROADCAST_ROWS = 1_000_000


@dataclass
class Difference:
    """Rows that differ between two versions of a table, with the column ``added`` (else a row was removed).

    ``compared`` come from folders of partitions both versions changed, each once. ``whole`` are all rows of the other folders that only one
    version names, read from there; ``fresh`` lists those of them the newer version has.
    """

    compared: DataFrame
    whole: DataFrame | None
    fresh: list[list[str]]

    def rows(self) -> DataFrame:
        return self.compared if self.whole is None else self.compared.unionByName(self.whole)


class VersionedTable:
    """A partitioned table below ``path``.

    ``links`` lists the keys to index, ``cluster`` the columns rows are sorted by inside files, and ``mark`` a date whose
    greatest value so far each version keeps.
    """

    def __init__(self, spark: SparkSession, path: str, partition: str, links: Sequence[Link] = (), cluster: Sequence[str] = (), mark: str | None = None):
        self.spark, self.path, self.partition, self.cluster = spark, path.rstrip("/"), partition, tuple(cluster)
        self.mark = mark
        self.links = {_link_name(keys, condition): (tuple(keys), condition) for keys, condition in links}

    # ------------------------------------------------------------------ versions

    def versions(self) -> list[int]:
        """Numbers of the versions that can be read, oldest first."""
        fs, folder = self._fs(f"{self.path}/versions")
        if not fs.exists(folder):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_")))

    def manifest(self, version: int | None = None) -> dict[str, Any] | None:
        """What makes up a version (default: the newest); None if there is none.

        ``folders`` holds pairs of partition folder and load, ``links`` the links indexed by each load.
        """
        if version is None:
            version = max(self.versions(), default=None)
            if version is None:
                return None
        fs, file = self._fs(f"{self.path}/versions/{version:010d}.json")
        stream = fs.open(file)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def newest_mark(self) -> datetime.date | None:
        """Greatest value of the ``mark`` column in any load of the newest version or those before it; reads no rows."""
        found = self.manifest()
        return datetime.date.fromisoformat(found["mark"]) if found and found["mark"] else None

    def read(self, version: int | None = None, only: Iterable[Any] | None = None) -> DataFrame | None:
        """The rows of a version (default: the newest); None before the first load.

        ``only`` names partition values, and no other folder is listed or opened.
        """
        found = self.manifest(version)
        return None if found is None else self._rows(found, found["folders"] if only is None else self._pick(found, only))

    def _rows(self, manifest: dict[str, Any], folders: list[list[str]]) -> DataFrame:
        schema = StructType.fromJson(manifest["schema"])
        if not folders:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path}/data/__load={load}/{folder}" for folder, load in folders]
        reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/data")
        return reader.parquet(*paths).select(*schema.names)

    def _pick(self, manifest: dict[str, Any], values: Iterable[Any]) -> list[list[str]]:
        wanted = {self._folder(v) for v in values}
        return [entry for entry in manifest["folders"] if entry[0] in wanted]

    def _folder(self, value: Any) -> str:
        if value is None:
            return f"{self.partition}={_NO_VALUE}"
        text = str(value).lower() if isinstance(value, bool) else str(value)
        escape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        return f"{escape(self.partition)}={escape(text)}"

    def version(self) -> int | None:
        """Number of the newest version; None before the first load."""
        return max(self.versions(), default=None)

    def notes(self) -> dict[str, int]:
        """What the last writer noted with its rows: here the versions of the tables they were made from."""
        return (self.manifest() or {}).get("notes") or {}

    # ------------------------------------------------------------------ keys and changes

    def lookup(self, wanted: DataFrame, keys: Sequence[str], version: int | None = None, besides: Sequence[list[str]] = ()) -> DataFrame:
        """Rows whose ``keys`` are among those of ``wanted``; NULL is a key like any other.

        Opens only the partitions the index names. ``wanted`` is read several times, so hand in a stored table. Folders in
        ``besides`` are left out, for callers who take all their rows anyway.
        """
        found = self.manifest(version)
        rest = {**found, "folders": [entry for entry in found["folders"] if entry not in besides]} if besides else found
        return matching(self._rows(rest, self._pick(rest, self.holding(wanted, keys, rest))), wanted, keys)

    def holding(self, wanted: DataFrame, keys: Sequence[str], manifest: dict[str, Any] | None = None) -> set:
        """Partition values in which a key of ``wanted`` occurs, by the index if the keys have a link.

        Without a link, the key columns of the table are read.
        """
        manifest = manifest or self.manifest()
        return self._found(wanted.select(*keys), keys, None, manifest, manifest["folders"], (False, True))

    def within(self, folders: list[list[str]], version: int | None = None) -> DataFrame:
        """All rows of some folders of a version."""
        return self._rows(self.manifest(version), folders)

    def changes(self, since: int, columns: Sequence[str] | None = None, until: int | None = None) -> DataFrame | None:
        """Rows that differ between two versions: ``columns`` and ``added`` (else it was removed). None if version ``since`` is gone."""
        found = self.difference(since, columns, until)
        return found and found.rows()

    def difference(self, since: int, columns: Sequence[str] | None = None, until: int | None = None) -> Difference | None:
        """What differs between two versions; None if version ``since`` is gone.

        Reads the folders only one of them names, as folders never change. With the partition among ``columns``, a row can equal rows of
        its own partition only, so where just one version has such a folder there is nothing to compare.
        """
        if since not in self.versions():
            return None
        old, new = self.manifest(since), self.manifest(until)
        columns = list(columns or StructType.fromJson(new["schema"]).names)
        gone = [f for f in old["folders"] if f not in new["folders"]]
        come = [f for f in new["folders"] if f not in old["folders"]]
        names = {f for f, _ in gone}, {f for f, _ in come}
        shared = names[0] & names[1] if self.partition in columns else names[0] | names[1]
        part = lambda manifest, folders, both: self._rows(manifest, [f for f in folders if (f[0] in shared) == both])
        before = part(old, gone, True).select(*columns, F.lit(-1).alias("__side"))
        after = part(new, come, True).select(*columns, F.lit(1).alias("__side"))
        differ = before.unionByName(after).groupBy(*columns).agg(F.sum("__side").alias("__side")).filter(F.col("__side") != 0)
        compared = differ.select(*columns, (F.col("__side") > 0).alias("added"))
        sides = [
            part(manifest, folders, False).select(*columns, F.lit(added).alias("added"))
            for manifest, folders, added in ((old, gone, False), (new, come, True))
            if any(f not in shared for f, _ in folders)
        ]
        whole = None if not sides else sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])
        return Difference(compared, whole, [f for f in come if f[0] not in shared])

    # ------------------------------------------------------------------ writers

    def replace(self, rows: DataFrame, notes: dict[str, int] | None = None) -> int:
        """A version of these rows alone."""
        load, folders = self._write(rows)
        return self._publish(self.manifest(), rows.schema, folders, {load: self._indexed()}, notes or {})

    def exchange(self, gone: DataFrame, rows: DataFrame, keys: Sequence[str], notes: dict[str, int] | None = None, settled: DataFrame | None = None) -> int:
        """A version without the rows whose ``keys`` are in ``gone``, and with ``rows`` and ``settled``.

        Partitions that lose no row stay as they are, also those that gain some. ``gone`` is read several times, so hand in
        a stored table; its keys may repeat. ``settled`` are rows read from folders of the same partitions, which are
        written as they lie there instead of being shuffled by partition.
        """
        before = self.manifest()
        if before is None:
            return self.replace(rows if settled is None else rows.unionByName(settled), notes)
        gone = gone.select(*keys)
        chosen = self._pick(before, self.holding(gone, keys, before))
        kept = matching(self._rows(before, chosen), gone, keys, "left_anti")
        load, folders = self._write(kept.select(*rows.columns).unionByName(rows), settled)
        rest = [entry for entry in before["folders"] if entry not in chosen]
        return self._publish(before, StructType.fromJson(before["schema"]), rest + folders, before["links"] | {load: self._indexed()}, notes)

    def append(self, rows: DataFrame) -> int:
        """A version with these rows added to the newest one."""
        before = self.manifest()
        load, folders = self._write(rows)
        old, links = (before["folders"], before["links"]) if before else ([], {})
        return self._publish(before, rows.schema, old + folders, links | {load: self._indexed()})

    def upsert(
        self,
        batch: DataFrame,
        keys: Sequence[str],
        newest: Sequence[str] = (),
        rebuild: Callable[[DataFrame], DataFrame] | None = None,
        links: Sequence[Link] | None = None,
    ) -> int:
        """A version in which the rows of ``batch`` replace those with the same key.

        The partitions the batch falls in, and those the index finds by ``links`` (default: the keys), are
        built anew from their rows and the batch; all others stay as they are. ``rebuild`` turns the union into the
        final rows (default: latest version of ``keys`` by ``newest``). Running a batch again gives the same rows.
        """
        rebuild = rebuild or (lambda rows: latest_version(rows, keys, newest))
        before = self.manifest()
        if before is None:
            return self.replace(rebuild(batch))
        batch = stable(batch)
        touched = self.touched(batch, [(keys, None)] if links is None else links, before)
        chosen = self._pick(before, touched)
        rows = self._rows(before, chosen).select(*batch.columns).unionByName(batch)
        load, folders = self._write(rebuild(rows))
        kept = [entry for entry in before["folders"] if entry not in chosen]
        version = self._publish(before, StructType.fromJson(before["schema"]), kept + folders, before["links"] | {load: self._indexed()})
        release(batch)
        return version

    def touched(self, batch: DataFrame, links: Sequence[Link], manifest: dict[str, Any] | None = None) -> set:
        """Partition values a batch falls in, or finds rows in; the driver holds no more than these."""
        manifest = manifest or self.manifest()
        values = {row[0] for row in batch.select(self.partition).distinct().collect()}
        known = self._pick(manifest, values)
        others = [entry for entry in manifest["folders"] if entry not in known]
        for keys, condition in links:
            if self.partition in keys or not others:
                continue
            values |= self._found(batch, keys, condition, manifest, others)
        return values

    def _found(
        self, batch: DataFrame, keys: Sequence[str], condition: str | None, manifest: dict[str, Any], among: list[list[str]], kinds: Sequence[bool] = (False,)
    ) -> set:
        """Values of those partitions ``among`` the given ones that may hold a key of the batch; ``kinds`` says whether keys without (False) or with (True) a NULL part count."""
        if not among:
            return set()
        lacking = _lacking(keys)
        numbers = batch.agg(F.count_if(~lacking), F.count_if(lacking)).first()
        values: set = set()
        for missing in kinds:
            number, left = numbers[int(missing)], among
            if number > BROADCAST_ROWS:
                # Hashes are spread evenly, so those below a bound are a like share of both sides. The partitions they find need no full search.
                bound = -(2**63) + 2**64 * BROADCAST_ROWS // number
                values |= self._search(batch, keys, condition, manifest, left, missing, F.col("hash") < bound, True)
                known = {self._folder(v) for v in values}
                left = [entry for entry in among if entry[0] not in known]
            if number and left:
                values |= self._search(batch, keys, condition, manifest, left, missing, F.lit(True), number <= BROADCAST_ROWS)
        return values

    def _search(
        self, batch: DataFrame, keys: Sequence[str], condition: str | None, manifest: dict[str, Any], among: list[list[str]], missing: bool, some: Column, few: bool
    ) -> set:
        """Values of the partitions ``among`` the given ones that hold a hash of the batch that meets ``some``."""
        name = _link_name(keys, condition, missing)
        indexed = [entry for entry in among if name in manifest["links"].get(entry[1], ())]
        wanted = _hashes(batch, keys, None, missing=missing).filter(some).distinct()
        wanted = F.broadcast(wanted) if few else wanted
        found, values = [], set()
        if indexed:
            found.append(self._index(manifest, indexed).filter(F.col("link") == name).select(self.partition, "hash"))
        if len(indexed) < len(among):
            # Loads made without this link: look at their key columns.
            rest = self._rows(manifest, [entry for entry in among if entry not in indexed])
            found.append(_hashes(rest, keys, condition, self.partition, missing=missing))
        for place in found:
            values |= {row[0] for row in place.filter(some).join(wanted, "hash", "left_semi").select(self.partition).distinct().collect()}
        return values

    def _indexed(self) -> list[str]:
        """Names of what a load is indexed by."""
        return [*self.links, *[_link_name(keys, None, True) for keys, condition in self.links.values() if condition is None]]

    def _index(self, manifest: dict[str, Any], folders: list[list[str]]) -> DataFrame:
        kind = StructType.fromJson(manifest["schema"])[self.partition].dataType.simpleString()
        reader = self.spark.read.schema(f"link string, hash long, `{self.partition}` {kind}").option("basePath", f"{self.path}/index")
        fs, _ = self._fs(self.path)
        paths = [f"{self.path}/index/__load={load}/{folder}" for folder, load in folders]
        there = [p for p in paths if fs.exists(self._hadoop(p))]  # a partition may hold no row that meets a condition
        return reader.parquet(*there) if there else self.spark.createDataFrame([], f"link string, hash long, `{self.partition}` {kind}")

    def _write(self, rows: DataFrame, settled: DataFrame | None = None) -> tuple[str, list[list[str]]]:
        """Files of a new load and its index; nobody reads them yet."""
        load = uuid.uuid4().hex
        place = f"{self.path}/data/__load={load}"
        shaped = rows.hint("rebalance", self.partition)
        if settled is not None:
            shaped = shaped.unionByName(settled)
        if self.cluster:
            shaped = shaped.sortWithinPartitions(self.partition, *self.cluster)
        shaped.write.partitionBy(self.partition).parquet(place)
        fs, folder = self._fs(place)
        names = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]
        folders = [[name, load] for name in sorted(names)]
        if self.links and folders:
            written = self._rows({"schema": json.loads(rows.schema.json())}, folders)
            # Whole keys of a link and, unless it has a condition, keys with a NULL part: all links in one pass, by number until they are written.
            links = list(self.links.values())
            names = [n for keys, condition in links for n in (_link_name(keys, condition), _link_name(keys, None, True))]
            entry = lambda n: F.struct(F.lit(n).alias("number"), _hash(links[n // 2][0]).alias("hash"))
            entries = []
            for i, (keys, condition) in enumerate(links):
                entries.append(F.when(_lacking(keys), entry(2 * i + 1)).otherwise(entry(2 * i)) if condition is None else F.when(F.expr(condition) & ~_lacking(keys), entry(2 * i)))
            every = written.select(self.partition, F.inline(F.array(*entries))).filter(F.col("number").isNotNull())
            index = every.distinct().hint("rebalance", self.partition).sortWithinPartitions(self.partition, "number", "hash")
            index = index.select(F.get(F.array(*map(F.lit, names)), F.col("number")).alias("link"), "hash", self.partition)
            index.write.partitionBy(self.partition).parquet(f"{self.path}/index/__load={load}")
        return load, folders

    def _publish(self, before: dict[str, Any] | None, schema: StructType, folders: list[list[str]], links: dict[str, list[str]], notes: dict[str, int] | None = None) -> int:
        """Make a version visible by renaming its file into place. Without ``notes`` those of the version before stay."""
        number = before["version"] + 1 if before else 1
        used = {load for _, load in folders}
        mark = max(filter(None, [before and before["mark"], self._newest(schema, [f for f in folders if not before or f not in before["folders"]])]), default=None)
        kept = (before or {}).get("notes") if notes is None else notes
        text = json.dumps({"version": number, "mark": mark, "schema": json.loads(schema.json()), "folders": folders, "links": {k: v for k, v in links.items() if k in used}, "notes": kept})
        fs, draft = self._fs(f"{self.path}/versions/_{uuid.uuid4().hex}")
        stream = fs.create(draft)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context.rename(draft, self._hadoop(f"{self.path}/versions/{number:010d}.json"), none)
        return number

    def _newest(self, schema: StructType, folders: list[list[str]]) -> str | None:
        if not self.mark or not folders:
            return None
        newest = self._rows({"schema": json.loads(schema.json())}, folders).agg(F.max(self.mark)).first()[0]
        return newest and newest.isoformat()

    def vacuum(self, keep: int = 2) -> None:
        """Remove all but the newest ``keep`` versions, and files no kept version names.

        Readers of older versions, and writers at work, must have ended.
        """
        numbers = self.versions()
        kept = numbers[-max(keep, 1) :]
        named = {(load, folder) for v in kept for folder, load in self.manifest(v)["folders"]}
        for v in numbers[: len(numbers) - len(kept)]:
            remove_folder(self.spark, f"{self.path}/versions/{v:010d}.json")
        for kind in ("data", "index"):
            fs, top = self._fs(f"{self.path}/{kind}")
            for place in fs.listStatus(top) if fs.exists(top) else ():
                load = place.getPath().getName().removeprefix("__load=")
                inside = [s.getPath().getName() for s in fs.listStatus(place.getPath()) if s.isDirectory()]
                gone = [f for f in inside if (load, f) not in named]
                if len(gone) == len(inside):
                    fs.delete(place.getPath(), True)
                else:
                    for f in gone:
                        remove_folder(self.spark, f"{place.getPath()}/{f}")

    # ------------------------------------------------------------------ file system

    def _hadoop(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        folder = self._hadoop(path)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()), folder


def matching(rows: DataFrame, wanted: DataFrame, keys: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Rows whose keys are (``left_semi``) or are not (``left_anti``) among the wanted ones; NULL equals NULL."""
    renamed = wanted.select(*[F.col(k).alias(f"__wanted_{i}") for i, k in enumerate(keys)])
    equal = F.lit(True)
    for i, k in enumerate(keys):
        equal = equal & F.col(k).eqNullSafe(F.col(f"__wanted_{i}"))
    return rows.join(renamed, equal, how)


def _link_name(keys: Sequence[str], condition: str | None, missing: bool = False) -> str:
    return ",".join(keys) + ("" if condition is None else f" where {condition}") + (" with NULL" if missing else "")


def _hashes(rows: DataFrame, keys: Sequence[str], condition: str | None, *more: str, missing: bool = False) -> DataFrame:
    """Hash of the key of each row that has one, or with ``missing`` of each key with a NULL part; as text, so that a key's type may widen."""
    among = rows if condition is None else rows.filter(condition)
    whole = among.filter(_lacking(keys) if missing else ~_lacking(keys))
    return whole.select(_hash(keys).alias("hash"), *more)


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k).cast("string") for k in keys])


def _lacking(keys: Sequence[str]) -> Column:
    lacking = F.lit(False)
    for k in keys:
        lacking = lacking | F.col(k).isNull()
    return lacking
