"""A folder of named tables, kept as plain partitioned parquet.

All tables lie under one root and are partitioned by table, schema version,
bin position (0 but for the inverted layout), part (a hash of the table's key)
and batch.  So one Spark write can take rows of several tables: slices and
their posting rows become visible together, or, if the job dies, not at all.

Every append has a batch of its own and is written by dynamic partition
overwrite, whose staging folder belongs to one job: writers at once do not
disturb each other, and a named batch that is written again replaces itself.
``copy_to`` merges many small batches.  A delete rewrites the folders that hold rows
to be removed, and no others, each file's rows in their order; nothing is kept
of a removed row, so reads are plain scans, and a key that is added again is
read again.  While a delete runs, no other writer should write the same part.

A table's schema is that of an empty file written when the table is made; its
key, number of parts and sort order are metadata of the fields.  ``evolve``
adds a schema version and rewrites nothing: rows of earlier versions are read
by the names and types they were written with.

Ids come from claimed ranges (``reserve``): a claim is a small file that only
one writer can make, holding the end of its range, so writers that work at
once, or again after a failure, never share an Id.
"""

from __future__ import annotations

import contextlib
import json
import threading
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import KEYS
from ..session import parts_for, scratch_path
from . import files

TABLE, VERSION, POSITION, PART, BATCH = FOLDERS = ("bv_table", "bv_version", "HashTable", "bv_part", "bv_batch")
#: Default number of parts of a table with a key; for large stores about the
#: table's bytes by what one delete may rewrite.
PARTS = 16

#: Words of 64 keys (16 bytes each) that are broadcast.
BROADCAST_WORDS = 1_000_000

_KEY, _SORT, _NAMES = "bv_parts", "bv_sort", "bv_names"


def _with(field: T.StructField, **more) -> T.StructField:
    return T.StructField(field.name, field.dataType, True, {**field.metadata, **more})


def _names(field: T.StructField) -> list:
    """[[version, name], ...]: what the column is called from a version on."""
    return json.loads(field.metadata[_NAMES]) if _NAMES in field.metadata else [[0, field.name]]


def _name_at(field: T.StructField, version: int) -> str | None:
    held = [name for since, name in _names(field) if since <= version]
    return held[-1] if held else None


class Store:
    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = (root or scratch_path(spark, "store")).rstrip("/")
        self._schemas: dict[tuple[str, int], T.StructType] = {}

    # ---- tables and their schemas -------------------------------------------
    def _at(self, *values) -> str:
        return "/".join([self.root, *(f"{c}={v}" for c, v in zip(FOLDERS, values))])

    def versions(self, name: str) -> list[int]:
        return sorted(int(x.split("=")[1]) for x in files.names(self.spark, self._at(name)) if x.startswith(f"{VERSION}="))

    def has(self, name: str) -> bool:
        return bool(self.versions(name))

    def _schema(self, name: str, version: int) -> T.StructType:
        found = self._schemas.get((name, version))
        if found is None:
            found = self._schemas[name, version] = self.spark.read.parquet(self._at(name, version, 0, 0, "schema")).schema
        return found

    def _newest(self, name: str) -> int:
        held = self.versions(name)
        if not held:
            raise KeyError(f"no table {name!r} in store {self.root}")
        return held[-1]

    def schema(self, name: str) -> T.StructType:
        return self._schema(name, self._newest(name))

    def _set_schema(self, name: str, version: int, fields: list[T.StructField], mode: str) -> None:
        empty = self.spark.createDataFrame([], T.StructType(fields))
        empty.coalesce(1).write.mode(mode).parquet(self._at(name, version, 0, 0, "schema"))

    def create(self, name: str, schema: T.StructType, key: str | None = None, sort_within: Sequence[str] = (), parts: int = PARTS) -> None:
        """Make an empty table, unless it is there.  Rows are dealt into
        ``parts`` folders by a hash of ``key`` (without a key into one)."""
        if not self.has(name):
            fields = [_with(f, **({_KEY: parts} if f.name == key else {}), **({_SORT: list(sort_within).index(f.name)} if f.name in sort_within else {})) for f in schema.fields]
            self._set_schema(name, 0, fields, "ignore")

    def evolve(self, name: str, add: Mapping[str, str] | None = None, drop: Sequence[str] | None = None, rename: Mapping[str, str] | None = None, cast: Mapping[str, str] | None = None) -> int:
        """S5 on a stored table: the changes of ``reshape.evolve_schema`` as a
        new schema version, from which on rows are written with the new
        columns.  No file is rewritten.  Rows of earlier versions are read with
        added columns NULL, dropped ones left out (also if the name is added
        again later), renamed ones under the new name and retyped ones cast.
        Changes that change nothing make no version.  Returns the version."""
        from ..operators.reshape import evolve_schema

        version = self._newest(name)
        old = {f.name.lower(): f for f in self._schema(name, version).fields}
        after = evolve_schema(self.spark.createDataFrame([], self._schema(name, version)), add, drop, rename, cast).schema
        came = {new.lower(): before.lower() for before, new in (rename or {}).items()}
        fields = []
        for f in after.fields:
            was = old.get(f.name.lower()) or old.get(came.get(f.name.lower(), ""))
            history = [[version + 1, f.name]] if was is None else _names(was) + ([[version + 1, f.name]] if was.name != f.name else [])
            fields.append(_with(T.StructField(f.name, f.dataType, True, was.metadata if was else {}), **{_NAMES: json.dumps(history)}))
        if [(f.name, f.dataType) for f in fields] == [(f.name, f.dataType) for f in old.values()]:
            return version
        lost = {f.name for f in old.values() if _KEY in f.metadata} - {_name_at(f, version) for f in fields}
        if lost:
            raise ValueError(f"the key {lost} of table {name!r} cannot be dropped")
        self._set_schema(name, version + 1, fields, "errorifexists")
        return version + 1

    # ---- read ------------------------------------------------------------------
    def _stored(self, name: str, version: int) -> DataFrame:
        """Rows of one schema version as they were written, with their folders."""
        own = [f for f in self._schema(name, version).fields if f.name != POSITION]
        folders = [T.StructField(POSITION, T.IntegerType()), T.StructField(PART, T.IntegerType()), T.StructField(BATCH, T.StringType())]
        rows = self.spark.read.schema(T.StructType([*own, *folders])).parquet(self._at(name, version))
        return rows.withColumns({TABLE: F.lit(name), VERSION: F.lit(version)})

    def rows(self, name: str) -> DataFrame:
        """All rows of a table in its newest schema, with their part."""
        newest = self._newest(name)
        target = self._schema(name, newest).fields

        def then(field: T.StructField, version: int) -> Column:
            own = _name_at(field, version)
            return (F.lit(None) if own is None else F.col(own)).cast(field.dataType).alias(field.name)

        frames = [self._stored(name, v).select(*[F.col(f.name) if v == newest else then(f, v) for f in target], PART) for v in self.versions(name)]
        return reduce(DataFrame.unionByName, frames)

    def read(self, name: str) -> DataFrame:
        return self.rows(name).drop(PART)

    # ---- write -----------------------------------------------------------------
    def _laid_out(self, name: str, df: DataFrame, batch: str) -> tuple[DataFrame, list[str]]:
        """Rows with their folders, and the columns that they are sorted by."""
        version = self._newest(name)
        fields = self._schema(name, version).fields
        key = next((f for f in fields if _KEY in f.metadata), None)
        part = F.col(PART) if PART in df.columns else self.part_of(F.col(key.name), key) if key else F.lit(0)
        position = F.col(POSITION).cast("int") if POSITION in df.columns else F.lit(0)
        own = [F.col(f.name).cast(f.dataType).alias(f.name) for f in fields if f.name != POSITION]
        folders = [F.lit(name).alias(TABLE), F.lit(version).alias(VERSION), position.alias(POSITION), part.cast("int").alias(PART), F.lit(batch).alias(BATCH)]
        return df.select(*own, *folders), self._sorted_by(fields)

    @staticmethod
    def _sorted_by(fields: Sequence[T.StructField]) -> list[str]:
        sort = [f.name for f in sorted((f for f in fields if _SORT in f.metadata), key=lambda f: f.metadata[_SORT])]
        return sort or [next((f for f in fields if _KEY in f.metadata), fields[0]).name]

    @staticmethod
    def part_of(value: Column, key: T.StructField) -> Column:
        return F.pmod(F.xxhash64(value.cast(key.dataType)), F.lit(key.metadata[_KEY]))

    def append(self, name: str, df: DataFrame, batch: str | None = None) -> None:
        """Add rows.  With ``batch``, a repeated append of this name replaces
        the first."""
        self.append_together({name: df}, batch)

    def append_together(self, tables: Mapping[str, DataFrame], batch: str | None = None) -> None:
        """Add rows to several tables by one write, so that they are seen
        together.  Columns that two of the tables share have one type."""
        batch = batch or uuid.uuid4().hex
        self._write([self._laid_out(name, df, batch) for name, df in tables.items()])

    def aside(self, df: DataFrame) -> tuple[DataFrame, str]:
        """``df`` in files of its own, and their folder: columns in few bytes,
        of which a job reads those that it needs."""
        at = scratch_path(self.spark, "aside")
        df.write.parquet(at)
        return self.spark.read.schema(df.schema).parquet(at), at

    def arranged(self, name: str, df: DataFrame) -> DataFrame:
        """Rows of a table, with their part, in files as ``append_arranged``
        takes them: dealt by part and by the table's order."""
        fields = self.schema(name).fields
        key, sort = next((f for f in fields if _KEY in f.metadata), None), self._sorted_by(fields)
        df = df.withColumn(PART, (self.part_of(F.col(key.name), key) if key else F.lit(0)).cast("int"))
        return self.aside(df.repartitionByRange(parts_for(self.spark, df.count()), PART, *sort).sortWithinPartitions(PART, *sort))[0]

    def append_arranged(self, tables: Mapping[str, Sequence[DataFrame]], batch: str | None = None) -> None:
        """As ``append_together``, for frames whose tasks hold few parts each,
        so that no row moves."""
        batch, laid = batch or uuid.uuid4().hex, []
        for name, frames in tables.items():
            sort = self._sorted_by(self.schema(name).fields)
            laid += [(self._laid_out(name, df.sortWithinPartitions(PART, *sort), batch)[0], []) for df in frames]
        self._write(laid)

    def _write(self, laid: list[tuple[DataFrame, list[str]]]) -> None:
        """Rows of tables with the columns to sort them by.  Where none has
        any, rows lie in their tasks and order already and do not move."""
        if not any(sort for _, sort in laid):
            with many_files(self.spark):
                return self._save(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df for df, _ in laid]))
        # ranges of (folders, sort columns): balanced tasks of few folders each, never one task a folder
        by = [*FOLDERS, *dict.fromkeys(c for _, sort in laid for c in sort if c not in FOLDERS)]
        # a table's rows move as one column, which the other tables' rows lack: most are long ones, of two columns
        own = [[c for c in df.columns if c not in FOLDERS] for df, _ in laid]
        narrow = [df.select(*[F.col(c) for c in by if c in df.columns], F.struct(*own[i]).alias(f"_bv_{i}")) for i, (df, _) in enumerate(laid)]
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), narrow)
        n = parts_for(self.spark, sum(df.count() for df, _ in laid))
        rows = rows.repartitionByRange(n, *by).sortWithinPartitions(*by)
        names = dict.fromkeys(c for cols in own for c in cols)
        self._save(rows.select(*FOLDERS, *[F.coalesce(*[F.col(f"_bv_{i}.{c}") for i, cols in enumerate(own) if c in cols]).alias(c) for c in names]))

    def _save(self, out: DataFrame) -> None:
        # the second format's pages hold the differences of sorted Ids
        w = out.write.option("parquet.writer.version", "PARQUET_2_0")
        # a filter is as large as a file's keys need: its largest size in a file of few rows is most of the file
        w = w.option("parquet.bloom.filter.adaptive.enabled", "true").option("parquet.bloom.filter.candidates.number", "8")
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        for key in {k for keys in KEYS.values() for k in keys} & set(out.columns) - {POSITION}:
            w = w.option(f"parquet.bloom.filter.enabled#{key}", "true")  # a lookup by key skips row groups
        w.partitionBy(*FOLDERS).parquet(self.root)

    def delete_rows(self, name: str, keys: DataFrame, on: str) -> int:
        """Remove the rows whose column ``on`` is among those of ``keys``;
        returns their number."""
        return self.delete_together({name: (keys, on)})[name]

    def delete_together(self, tables: Mapping[str, tuple[DataFrame, str]]) -> dict[str, int]:
        """Remove rows of several tables by one write of the folders that hold
        such rows.  ``keys`` with a column ``bv_part`` say in which parts."""
        removed, left, emptied = dict.fromkeys(tables, 0), [], []
        for name, (keys, on) in tables.items():
            for version in self.versions(name):
                field = next(f for f in self.schema(name).fields if f.name == on)
                own = _name_at(field, version)
                if own is None:
                    continue
                stored = self._stored(name, version)
                key = next(f for f in self._schema(name, version).fields if f.name == own)
                parts = keys.select(F.col(PART) if PART in keys.columns else self.part_of(F.col(on), key)) if PART in keys.columns or _KEY in key.metadata else None
                if parts is not None:  # at most as many as the table has parts
                    stored = stored.filter(F.col(PART).isin([r[0] for r in parts.distinct().collect()]))
                gone = _Gone(keys.select(F.col(on).cast(key.dataType).alias("_bv_gone")).distinct())
                counts = gone(stored, own).groupBy(*FOLDERS).agg(F.count("*").alias("n"), F.count_if("_bv_gone").alias("removed"))
                folders = counts.filter("removed > 0").checkpoint()
                touched = folders.collect()  # one row a folder
                if not touched:
                    continue
                removed[name] += sum(r["removed"] for r in touched)
                emptied += [tuple(r[c] for c in FOLDERS) for r in touched if r["removed"] == r["n"]]
                touched = [r for r in touched if r["removed"] < r["n"]]
                for c in (POSITION, PART, BATCH):  # read no other folders ...
                    stored = stored.filter(F.col(c).isin(sorted({r[c] for r in touched})))
                # ... and write no others: one of these values in each column does not make a touched folder
                stored = stored.join(F.broadcast(folders.filter("removed < n").select(*FOLDERS)), list(FOLDERS), "left_semi")
                if touched:
                    left.append((gone(stored, own).filter("not _bv_gone").drop("_bv_gone"), self._sorted_by(self._schema(name, version).fields), gone.in_place))
        if all(in_place for *_, in_place in left):
            # each file's rows are read and written in their order; folders are replaced when all are written
            left = [(df, []) for df, *_ in left]
        else:
            left = [(df.checkpoint(), sort) for df, sort, _ in left]
        if left:
            self._write(left)
        for folder in emptied:
            files.remove(self.spark, self._at(*folder))
        return removed

    def copy_to(self, root: str, names: Sequence[str]) -> Store:
        """A new store at ``root`` with the same rows in few files; for stores
        of many small appends."""
        other = Store(self.spark, root)
        for name in names:
            fields = self.schema(name).fields
            other._set_schema(name, 0, [T.StructField(f.name, f.dataType, True, {k: v for k, v in f.metadata.items() if k != _NAMES}) for f in fields], "errorifexists")
            other.append(name, self.rows(name))
            end = self._claimed(name)[1]
            if end is not None:
                files.create_new(self.spark, f"{other.root}/ids/{name}/{1:012d}", f"{end} {uuid.uuid4().hex}")
        return other

    # ---- ids -------------------------------------------------------------------
    def _claimed(self, name: str) -> tuple[int, int | None]:
        """Number of the last claim, and the last Id that is claimed."""
        held = [x for x in files.names(self.spark, f"{self.root}/ids/{name}") if not x.startswith(".")]
        return (int(held[-1]), int(files.read_text(self.spark, f"{self.root}/ids/{name}/{held[-1]}").split()[0])) if held else (0, None)

    def reserve(self, name: str, n: int, tag: str | None = None) -> int:
        """Claim ``n`` Ids of a table for this writer: it may use the Ids after
        the returned number.  A repeated call with the same ``tag`` returns the
        same range."""
        if tag is not None:
            note = f"{self.root}/ids/{name}-{tag}"
            if files.read_text(self.spark, note) is None:
                files.create_new(self.spark, note, str(self.reserve(name, n)))
            return int(files.read_text(self.spark, note))
        while True:
            number, end = self._claimed(name)
            if end is None:
                end = self.read(name).agg(F.max("Id")).first()[0] or 0
            if files.create_new(self.spark, f"{self.root}/ids/{name}/{number + 1:012d}", f"{end + n} {uuid.uuid4().hex}"):
                return end


class _Gone:
    """Marks (``_bv_gone``) the rows whose key is among ``wanted`` (distinct, in
    its one column).  Whole numbers are broadcast as the bits of words of 64 of
    them, so that no row moves; other keys, or numbers so far apart that the
    words are many, are joined, which may deal the rows anew."""

    def __init__(self, wanted: DataFrame):
        self.wanted, (key,) = wanted, wanted.schema.fields
        self.in_place = False
        if isinstance(key.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            words = wanted.filter(F.col(key.name).isNotNull()).groupBy(self._word(F.col(key.name)).alias("_bv_word"))
            self.words = words.agg(F.bit_or(self._bit(F.col(key.name))).alias("_bv_bits")).checkpoint()
            self.in_place = self.words.limit(BROADCAST_WORDS + 1).count() <= BROADCAST_WORDS

    @staticmethod
    def _word(c: Column) -> Column:
        return F.shiftright(c.cast("long"), 6)

    @staticmethod
    def _bit(c: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), c.cast("long").bitwiseAND(63).cast("int"))

    def __call__(self, rows: DataFrame, own: str) -> DataFrame:
        if self.in_place:
            held = rows.join(F.broadcast(self.words), self._word(F.col(own)) == F.col("_bv_word"), "left").drop("_bv_word")
            return held.withColumn("_bv_gone", F.coalesce(F.col("_bv_bits").bitwiseAND(self._bit(F.col(own))) != 0, F.lit(False))).drop("_bv_bits")
        wanted = self.wanted.withColumn("_bv_in", F.lit(True))
        held = rows.join(wanted, rows[own] == wanted["_bv_gone"], "left").drop("_bv_gone")
        return held.withColumn("_bv_gone", F.coalesce("_bv_in", F.lit(False))).drop("_bv_in")


#: Files that a task may have open at once, where it writes rows as they lie.
OPEN_FILES = 32
_OPEN: dict[int, list] = {}


@contextlib.contextmanager
def many_files(spark: SparkSession):
    """While it holds, tasks that write keep the files of several folders open,
    so Spark does not sort their rows anew by folder."""
    conf, of = "spark.sql.maxConcurrentOutputFileWriters", spark._jsparkSession.hashCode()
    with _LOCK:
        held = _OPEN.setdefault(of, [0, spark.conf.get(conf, None)])
        held[0] += 1
        spark.conf.set(conf, str(OPEN_FILES))
    try:
        yield
    finally:
        with _LOCK:
            held[0] -= 1
            if not held[0]:
                del _OPEN[of]
                spark.conf.unset(conf) if held[1] is None else spark.conf.set(conf, held[1])


_CACHE: dict[tuple[int, str], TestdataStore] = {}
_LOCK = threading.Lock()


class TestdataStore:
    """Tables built from the driver's parquet tables on first use (one Spark
    job a table), then read back as parquet."""

    __test__ = False

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self.root = scratch_path(spark, "tables").rstrip("/")
        self._built: dict[str, T.StructType] = {}

    def get(self, name: str) -> DataFrame:
        at = f"{self.root}/{name}"
        if name not in self._built:
            from . import tables

            df, layout = tables.BUILDERS[name](self.spark, self.sf_dir)
            folders, sort = layout.get("partition_by", []), layout.get("sort_within", [])
            # tasks of bounded rows: ranges by the sort columns, and by what cuts a value of them that is common
            by = [*folders, *sort, *layout.get("cut_by", [])]
            moved, then = layout.get("moved", df), layout.get("then", lambda rows: rows)
            out = then(moved.repartitionByRange(parts_for(self.spark, moved.count()), *by).sortWithinPartitions(*folders, *sort)) if sort else df
            out.write.partitionBy(*folders).parquet(at)
            self._built[name] = df.schema
        schema = self._built[name]
        return self.spark.read.schema(schema).parquet(at).select(*schema.names)


def testdata_store(spark: SparkSession, sf_dir: str) -> TestdataStore:
    key = (id(spark), sf_dir.rstrip("/"))
    with _LOCK:
        st = _CACHE.get(key)
        if st is None:
            st = TestdataStore(spark, sf_dir)
            _CACHE[key] = st
        return st
