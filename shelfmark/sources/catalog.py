"""Tables by name under one root, in three layouts: single, dated parts, hash buckets with a manifest.

A bucketed table's rows lie in folders `_b=<hex>` by the md5 of their key. A merge rewrites the buckets that its batch
touches, under a new version, and then adds the manifest of that version, which lists live folders; readers see one
version or the next. A version's manifest is a file of its own that must not be there yet, so of two writers of one
version the second fails, and its folders are removed.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType

from ..functions.keys import bucket
from ..functions.text import present
from ..operators.joins import last_of_key, upsert
from ..operators.windows import fold_latest
from . import footers
from .files import Store

TYPES = {"string": StringType(), "float64": DoubleType(), "int64": LongType(), "bool": BooleanType()}
CHANGELOG = 200
KEPT_MANIFESTS = 20


class Conflict(RuntimeError):
    """Another writer swapped the manifest first."""


def declared(fields: dict[str, str]) -> StructType:
    return StructType([StructField(n, TYPES[t]) for n, t in fields.items()])


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of a declared schema; missing ones are null, values that do not convert are null, others are left out."""
    have = set(df.columns)
    return df.select(*[((F.col(f.name) if isinstance(f.dataType, StructType) else F.col(f.name).try_cast(f.dataType)) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


class _Consumed:
    """Which parts a fold has consumed: of each whole day how many parts it had and a digest of their names, and names only of
    days that are not whole yet. What is kept grows with days, not with parts. A part that comes late into a whole day
    opens the day, whose parts are folded again, which changes nothing but for the late one."""

    def __init__(self, held: dict | list):
        self.days: dict[str, str] = {} if isinstance(held, list) else held.get("days", {})
        self.names = set(held if isinstance(held, list) else held.get("parts", []))

    @staticmethod
    def _day(part: str) -> str:
        return part[:10] if len(part) > 9 and part[4] == part[7] == "-" else part

    @classmethod
    def _by_day(cls, parts: list[str]) -> dict[str, list[str]]:
        out: dict[str, list[str]] = {}
        for p in parts:
            out.setdefault(cls._day(p), []).append(p)
        return out

    @staticmethod
    def _digest(parts: list[str]) -> str:
        return f"{len(parts)}:{hashlib.sha256(chr(10).join(sorted(parts)).encode()).hexdigest()[:32]}"

    def open(self, parts: list[str]) -> list[str]:
        todo = []
        for day, some in self._by_day(parts).items():
            if self.days.get(day) != self._digest(some):
                todo += [p for p in some if p not in self.names]
        return sorted(todo)

    def after(self, parts: list[str], done: list[str]) -> dict:
        names = self.names | set(done)
        days, left = dict(self.days), []
        for day, some in self._by_day(parts).items():
            if days.get(day) == self._digest(some):
                continue
            days.pop(day, None)
            if names.issuperset(some):
                days[day] = self._digest(some)
            else:
                left += [p for p in some if p in names]
        return {"days": days, "parts": sorted(left)}


class Catalog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.store = spark, root.rstrip("/"), Store(spark)

    def _path(self, name: str, *more: str) -> str:
        return "/".join((self.root, name, *more))

    # ---- layouts
    def manifest(self, name: str) -> dict | None:
        """The newest manifest; one that is still being written is passed over."""
        for file in reversed(self.store.names(self._path("_manifest", name))):
            try:
                return self.store.read_json(self._path("_manifest", name, file))
            except ValueError:
                continue
        return None

    def layout(self, name: str) -> str | None:
        if self.manifest(name):
            return "bucketed"
        if self.store.exists(self._path(name, "_parts")):
            return "parts"
        return "single" if self.store.exists(self._path(name, "data")) else None

    def table(self, name: str) -> DataFrame:
        """The table, whatever its layout. A name that is not there raises; an empty table is empty."""
        layout = self.layout(name)
        if layout == "bucketed":
            m = self.manifest(name)
            schema = StructType.fromJson(m["schema"])
            paths = [self._path(name, p) for p in m["files"].values()]
            return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        if layout == "parts":
            return self.spark.read.option("mergeSchema", "true").option("basePath", self._path(name, "_parts")).parquet(self._path(name, "_parts"))
        if layout == "single":
            return self.spark.read.parquet(self._path(name, "data"))
        raise FileNotFoundError(name)

    def names(self) -> list[str]:
        return sorted({n for n in self.store.names(self.root) if not n.startswith("_")} | set(self.store.names(self._path("_manifest"))))

    def columns(self, name: str) -> list[tuple[str, str]]:
        return self.table(name).dtypes

    def _folders(self, name: str) -> list[str]:
        m = self.manifest(name)
        return [self._path(name, f) for f in m["files"].values()] if m else [self._path(name, "_parts" if self.layout(name) == "parts" else "data")]

    def row_groups(self, name: str) -> DataFrame:
        """What the footers of the table's files tell: a row for each column of each row group."""
        return footers.row_groups(self.spark, self._folders(name) if self.layout(name) else [])

    def row_count(self, name: str) -> int:
        """0 where there is no table; a table that cannot be read raises, as unknown is not zero. Rows are counted from
        footers; in a store that only Spark reads, by Spark."""
        if not self.layout(name):
            return 0
        folders = self._folders(name)
        return footers.row_count(self.spark, folders) if all(map(footers.reachable, folders)) else self.table(name).count()

    def attach(self, name: str, view: str = "t") -> DataFrame:
        df = self.table(name)
        df.createOrReplaceTempView(view)
        return df

    def query(self, name: str, sql: str = "SELECT * FROM t", args: dict | None = None) -> DataFrame:
        self.attach(name)
        return self.spark.sql(sql, args or {})

    def sample(self, name: str, n: int = 20) -> DataFrame:
        return self.table(name).limit(n)

    def cached_sample(self, name: str, n: int = 20) -> list[dict]:
        """Rows for a preview, kept as a document beside the table until the table changes."""
        place = self._path("_doc", f"sample-{name}-{n}.json")
        m = self.manifest(name)
        mark = m["version"] if m else self.parts(name) or self.store.changed(self._path(name, "data"))
        held = self.store.read_json(place)
        if held is None or held["mark"] != mark:
            rows = [r["j"] for r in self.sample(name, n).select(F.to_json(F.struct("*")).alias("j")).collect()]
            held = {"mark": mark, "rows": rows}
            self.store.write_json(place, held)
        return [json.loads(r) for r in held["rows"]]

    def read_expr(self, name: str) -> str:
        """The table as an expression that Spark SQL reads without a view: its folders, whatever the layout."""
        files = self._folders(name)
        if not files:
            raise FileNotFoundError(f"{name} is empty")
        return " UNION ALL ".join(f"SELECT * FROM parquet.`{f}`" for f in files) if len(files) > 1 else f"parquet.`{files[0]}`"

    # ---- single
    def write(self, name: str, df: DataFrame, fields: list[str] | None = None, allow_empty: bool = False) -> None:
        """Overwrites. Nothing over something is refused, and so is a bucketed table."""
        if self.layout(name) == "bucketed":
            raise ValueError(f"{name} is bucketed; use rebuild or merge")
        df = df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in fields]) if fields else df
        next_path = self._path(name, f".next-{uuid.uuid4().hex}")
        df.write.parquet(next_path)
        if not allow_empty and self.layout(name) and self.spark.read.parquet(next_path).isEmpty() and not self.table(name).isEmpty():
            self.store.delete(next_path)
            raise ValueError(f"an empty result must not replace {name}")
        self.store.move(next_path, self._path(name, "data"))

    def from_csv(self, name: str, path: str, fields: list[str]) -> None:
        """All columns as strings, as declared."""
        schema = StructType([StructField(c, StringType()) for c in fields])
        self.write(name, self.spark.read.schema(schema).option("header", "true").csv(path))

    # ---- parts
    def write_part(self, name: str, part: str, df: DataFrame, schema: StructType | None = None) -> None:
        """Appends or replaces one part; a part's name is its identity, so that writing it again changes nothing."""
        df = conform(df, schema) if schema else df
        next_path = self._path(name, f".next-{uuid.uuid4().hex}")
        df.write.parquet(next_path)
        self.store.move(next_path, self._path(name, "_parts", f"part={part}"))

    def land(self, name: str, df: DataFrame, schema: StructType, day: str | None = None, shard: int = 0, seq: int = 0) -> str:
        """A declared append: part <day>_s<shard>_b<seq>; shards are disjoint writers."""
        part = f"{day or dt.date.today().isoformat()}_s{shard:02d}_b{seq:04d}"
        self.write_part(name, part, df, schema)
        return part

    def parts(self, name: str) -> list[str]:
        return [p.removeprefix("part=") for p in self.store.names(self._path(name, "_parts")) if p.startswith("part=")]

    def newest_parts(self, name: str, most: int = 60) -> list[str]:
        """The newest parts, whole days only, and all undated ones."""
        dated: dict[str, list[str]] = {}
        undated = []
        for p in self.parts(name):
            day = p[:10]
            (dated.setdefault(day, []) if len(day) == 10 and day[4] == day[7] == "-" else undated).append(p)
        out: list[str] = []
        for day in sorted(dated, reverse=True):
            if out and len(out) + len(dated[day]) > most:
                break
            out += dated[day]
        return sorted(out) + sorted(undated)

    def read_parts(self, name: str, parts: list[str]) -> DataFrame:
        base = self._path(name, "_parts")
        return self.spark.read.option("mergeSchema", "true").option("basePath", base).parquet(*[f"{base}/part={p}" for p in parts])

    # ---- buckets
    def create_bucketed(self, name: str, keys: list[str], schema: StructType, digits: int = 2) -> None:
        if self.manifest(name):
            raise ValueError(f"{name} exists")
        self._swap(name, {"keys": keys, "digits": digits, "schema": schema.jsonValue(), "version": 0, "files": {}, "changelog": []}, None)

    def _swap(self, name: str, manifest: dict, expected: int | None) -> None:
        """Adds the next version's manifest. It is refused if the newest is not the expected one, or if another writer
        adds the same version first."""
        now = (self.manifest(name) or {}).get("version")
        place = self._path("_manifest", name)
        if now != expected or not self.store.create_json(f"{place}/{manifest['version']:09d}.json", manifest):
            raise Conflict(f"{name}: version {manifest['version']} does not follow {now}")
        for old in self.store.names(place)[:-KEPT_MANIFESTS]:
            self.store.delete(f"{place}/{old}")

    def _write_buckets(self, name: str, df: DataFrame, m: dict, version: int) -> dict[str, str]:
        """One folder a bucket; returns bucket -> folder. A bucket is dealt to as many tasks, and has as many files, as its
        size asks for: adaptive execution parts large ones and joins small ones to the session's advisory size."""
        folder = f"v{version:06d}-{uuid.uuid4().hex[:8]}"
        placed = df.withColumn("_b", bucket([F.col(k) for k in m["keys"]], m["digits"]))
        placed.hint("rebalance", F.col("_b")).write.partitionBy("_b").parquet(self._path(name, folder))
        return {p.removeprefix("_b="): f"{folder}/{p}" for p in self.store.names(self._path(name, folder)) if p.startswith("_b=")}

    def rebuild(self, name: str, df: DataFrame, allow_empty: bool = False) -> None:
        """Overwrites and keeps the layout."""
        m = self.manifest(name)
        if not m:
            return self.write(name, df, allow_empty=allow_empty)
        files = self._write_buckets(name, conform(df, StructType.fromJson(m["schema"])), m, m["version"] + 1)
        if not files and m["files"] and not allow_empty:
            raise ValueError(f"an empty result must not replace {name}")
        self._commit(name, m, files, sorted(set(files) | set(m["files"])))

    def _commit(self, name: str, m: dict, files: dict[str, str], touched: list[str], schema: StructType | None = None) -> None:
        entry = {"version": m["version"] + 1, "at": dt.datetime.now(dt.UTC).isoformat(), "buckets": touched}
        new = m | {"version": m["version"] + 1, "files": files, "changelog": [*m["changelog"], entry][-CHANGELOG:]}
        if schema is not None:
            new["schema"] = schema.jsonValue()
        try:
            self._swap(name, new, m["version"])
        except Conflict:
            for folder in {f.split("/")[0] for f in files.values()} - {f.split("/")[0] for f in m["files"].values()}:
                self.store.delete(self._path(name, folder))
            raise

    def merge(self, name: str, batch: DataFrame, keys: list[str] | None = None) -> None:
        """Rows of the batch replace rows of equal keys. New columns widen the schema; none is dropped or retyped. Of rows of
        the batch that share a key one comes in, the greatest by its other columns, so that keys stay unique; `last_of_key`
        chooses by another order before."""
        m = self.manifest(name)
        if keys or m:
            batch = last_of_key(batch, m["keys"] if m else keys)
        if not m:
            return self.write(name, upsert(self.table(name), batch, keys) if self.layout(name) else batch)
        schema = StructType.fromJson(m["schema"])
        known = {f.name for f in schema.fields}
        wide = StructType(schema.fields + [f for f in batch.schema.fields if f.name not in known])
        b = bucket([F.col(k) for k in m["keys"]], m["digits"])
        incoming = conform(batch, wide).withColumn("_b", b).persist()
        try:
            touched = sorted(r["_b"] for r in incoming.select("_b").distinct().collect())  # 16 or 256 values at most
            olds = [self._path(name, m["files"][t]) for t in touched if t in m["files"]]
            rows = incoming.drop("_b")
            if olds:
                rows = upsert(conform(self.spark.read.schema(schema).parquet(*olds), wide), rows, m["keys"])
            files = self._write_buckets(name, rows, m, m["version"] + 1)
        finally:
            incoming.unpersist()
        self._commit(name, m, {**m["files"], **files}, touched, wide)

    def migrate(self, name: str, keys: list[str], digits: int = 2) -> None:
        """Single to bucketed; rows and distinct keys must agree before the manifest is written."""
        df = self.table(name)
        m = {"keys": keys, "digits": digits, "schema": df.schema.jsonValue(), "version": 0, "files": {}, "changelog": []}
        files = self._write_buckets(name, df, m, 1)
        new = self.spark.read.schema(df.schema).parquet(*[self._path(name, p) for p in files.values()])
        count = lambda d: tuple(d.agg(F.count(F.lit(1)), F.count_distinct(bucket([F.col(k) for k in keys], 32))).first())
        if count(df) != count(new):
            raise ValueError(f"{name}: the bucketed copy differs")
        self._swap(name, m | {"version": 1, "files": files}, None)

    def rollback(self, name: str) -> None:
        df = self.table(name)
        next_path = self._path(name, f".next-{uuid.uuid4().hex}")
        df.write.parquet(next_path)
        self.store.move(next_path, self._path(name, "data"))
        self.store.delete(self._path("_manifest", name))

    def changes(self, name: str, since: int = 0) -> list[dict]:
        return [e for e in (self.manifest(name) or {"changelog": []})["changelog"] if e["version"] > since]

    # ---- fold
    def fold(self, parts_table: str, target: str, keys: list[str], columns: list[str], limit: int | None = None, digits: int = 2) -> list[str]:
        """Folds parts that are not consumed yet into the target: per key and column the latest present value, by part
        name, kept with its part so that a late part never overwrites a newer value. The watermark is written last: a
        fold that ends early is done again and gives the same rows."""
        mark = self._path("_doc", f"fold-{parts_table}-{target}.json")
        known = _Consumed(self.store.read_json(mark, {}))
        there = self.parts(parts_table)
        todo = known.open(there)[:limit]
        if not todo:
            return []
        # A column's state is its value and the part it came from.
        parts = self.read_parts(parts_table, todo)
        stamped = parts.select(*keys, *[F.struct(F.col("part").alias("p"), F.col(c).alias("v")).alias(c) for c in columns])
        held = lambda c: present(F.col(f"{c}.v"))
        fresh = stamped.groupBy(*keys).agg(*[F.max(F.when(held(c), F.col(c))).alias(c) for c in columns])
        self.fold_state(target, keys, columns, fresh, digits)
        self.store.write_json(mark, known.after(there, todo))
        return todo

    def fold_state(self, target: str, keys: list[str], columns: list[str], fresh: DataFrame, digits: int = 2) -> None:
        """Merges newer states (a struct p, v a column) into the state and the target. Both lie in 16 ** digits buckets,
        of which only those that the fresh rows touch are read and written."""
        state = f"_{target}_state"
        if not self.manifest(state):
            self.create_bucketed(state, keys, fresh.schema, digits)
            plain = StructType([*fresh.select(*keys).schema.fields, *[StructField(c, fresh.schema[c].dataType["v"].dataType) for c in columns]])
            self.create_bucketed(target, keys, plain, digits)
        b = bucket([F.col(k) for k in keys], self.manifest(state)["digits"])
        touched = sorted(r["b"] for r in fresh.select(b.alias("b")).distinct().collect())  # 256 values at most
        olds = [self._path(state, f) for k, f in self.manifest(state)["files"].items() if k in touched]
        if olds:
            fresh = self.spark.read.schema(StructType.fromJson(self.manifest(state)["schema"])).parquet(*olds).unionByName(fresh)
            fresh = fresh.groupBy(*keys).agg(*[F.max(c).alias(c) for c in columns])
        self.merge(state, fresh)
        newest = [self._path(state, f) for k, f in self.manifest(state)["files"].items() if k in touched]
        self.merge(target, self.spark.read.schema(StructType.fromJson(self.manifest(state)["schema"])).parquet(*newest).select(*keys, *[F.col(f"{c}.v").alias(c) for c in columns]))

    # ---- repair
    def audit_parts(self, name: str) -> dict[str, list[str]]:
        """Parts by their schema's signature; more than one signature means that types drifted."""
        out: dict[str, list[str]] = {}
        for p in self.parts(name):
            kinds = ",".join(f"{n}:{t}" for n, t in sorted(self.spark.read.parquet(self._path(name, "_parts", f"part={p}")).dtypes))
            out.setdefault(kinds, []).append(p)
        return out

    def repair_part(self, name: str, part: str, schema: StructType, spill: dict[str, str]) -> None:
        """Rewrites a part on the declared schema; a value that does not convert goes to the spill column."""
        df = self.spark.read.parquet(self._path(name, "_parts", f"part={part}"))
        for column, other in spill.items():
            kind = schema[column].dataType
            lost = F.col(column).isNotNull() & F.col(column).try_cast(kind).isNull()
            before = F.col(other) if other in df.columns else F.lit(None).cast("string")
            df = df.withColumn(other, F.when(lost, F.col(column).cast("string")).otherwise(before))
        fixed = conform(df, schema)
        next_path = self._path(name, f".next-{uuid.uuid4().hex}")
        fixed.write.parquet(next_path)
        self.store.move(next_path, self._path(name, "_parts", f"part={part}"))


__all__ = ["Catalog", "Conflict", "conform", "declared", "fold_latest"]
