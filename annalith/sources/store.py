"""Tables under a root folder, by version and kind: publishing, resolving, versioned reads and the log of versions.

Layout: ``root/<version>/<kind>/<name>`` holds what a version published or dropped, ``root/runs.json`` the log of
versions, ``root/LATEST/<kind>/<name>.json`` a pointer to the newest published version. Versions are texts
'major.mmm'; as numbers they are thousandths. Folders are listed by the file system of the root, so a store may lie
on any that Spark can read.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.keys import surrogate_id, with_bucket
from ..operators.versioning import BY, FROM, as_of, replay
from .readers import empty, filtered, listing, read_parquet, safe_select
from .sinks import write_counted

DROP, FACT, DIM, SYN, META, MAP = "DROP", "FACT", "DIM", "SYN", "META", "MAP"


def milli(version: str) -> int:
    """Thousandths of a version text."""
    major, _, minor = version.partition(".")
    return int(major) * 1000 + int((minor + "000")[:3])


def text(version: int) -> str:
    return f"{version // 1000}.{version % 1000:03d}"


def previous(version: int) -> int:
    return version - 1


class Store:
    def __init__(self, spark: SparkSession, root: str, base: int = 0):
        self.spark, self.root, self.base = spark, root.rstrip("/"), base

    # folders

    def _fs(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def path(self, version: int, kind: str, name: str) -> str:
        return f"{self.root}/{text(version)}/{kind.lower()}/{name.lower()}"

    def exists(self, path: str) -> bool:
        fs, where = self._fs(path)
        return bool(fs.exists(where))

    def move(self, old: str, new: str) -> None:
        """Renames a folder in one step; what was at the new place is gone."""
        fs, where = self._fs(old)
        target = self.spark._jvm.org.apache.hadoop.fs.Path(new)
        fs.mkdirs(target.getParent())
        fs.delete(target, True)
        if not fs.rename(where, target):
            raise OSError(f"{old} can't be moved to {new}")

    def backup(self, path: str) -> str:
        """Moves a folder aside, once; a second backup leaves the first as it is and removes the folder."""
        aside = path.rstrip("/") + ".bkup"
        if self.exists(path):
            if self.exists(aside):
                fs, where = self._fs(path)
                fs.delete(where, True)
            else:
                self.move(path, aside)
        return aside

    def copy(self, old: str, new: str) -> None:
        fs, where = self._fs(old)
        self.spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, where, fs, self.spark._jvm.org.apache.hadoop.fs.Path(new), False, self.spark._jsc.hadoopConfiguration())

    def write_text(self, path: str, lines: str) -> None:
        fs, where = self._fs(path)
        out = fs.create(where, True)
        out.write(bytearray(lines.encode()))
        out.close()

    def read_text(self, path: str) -> str | None:
        if not self.exists(path):
            return None
        return "\n".join(r[0] for r in self.spark.read.text(path, wholetext=True).collect())

    # versions

    def versions(self, kind: str, name: str, at_most: int | None = None) -> list[int]:
        """Versions that hold a table, in order."""
        found = sorted(milli(v) for v in listing(self.spark, self.root) if v.replace(".", "").isdigit() and self.exists(self.path(milli(v), kind, name)))
        return [v for v in found if at_most is None or v <= at_most]

    def latest(self, kind: str, name: str, at_most: int | None = None) -> int | None:
        return max(self.versions(kind, name, at_most), default=None)

    def last(self, kind: str, name: str, version: int) -> int | None:
        """The newest version before this one."""
        return self.latest(kind, name, version - 1)

    # writing

    def publish(self, df: DataFrame, kind: str, name: str, version: int, skip_if_exists: bool = False) -> int:
        """Writes a table of a version, parted by its version columns if it has any; returns its rows, counted while writing.

        It is written aside and moved into place when its files hold as many rows as went in, as their footers say;
        then the pointer to the newest one is set. With ``skip_if_exists`` a table that is there stays, and counts.
        """
        path = self.path(version, kind, name)
        if skip_if_exists and self.exists(path):
            return self.spark.read.parquet(path).count()
        parts = [c for c in (FROM, BY) if c in df.columns]
        n = write_counted(df, path + ".new", parts)
        found = self.spark.read.parquet(path + ".new").count() if n else 0  # a count reads footers only
        if found != n:
            raise ValueError(f"{path}: wrote {n} rows, found {found}")
        self.move(path + ".new", path)
        self.write_text(f"{self.root}/LATEST/{kind.lower()}/{name.lower()}.json", json.dumps({"version": text(version), "rows": n}))
        return n

    def publish_changes(self, kept: str, df: DataFrame, kind: str, name: str) -> None:
        """Rewrites only the version partitions that ``df`` has rows of, in the table at ``kept``; the others stay as they are."""
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(FROM, BY).parquet(kept)

    def newest(self, kind: str, name: str) -> dict | None:
        """What the pointer says of the newest published table: its version and rows."""
        said = self.read_text(f"{self.root}/LATEST/{kind.lower()}/{name.lower()}.json")
        return json.loads(said) if said else None

    def write_stats(self, stats: dict, kind: str, name: str, version: int) -> None:
        self.write_text(f"{self.root}/{text(version)}/stats/{kind.lower()}_{name.lower()}.json", json.dumps(stats, sort_keys=True))

    def stats(self, kind: str, name: str, version: int) -> dict | None:
        said = self.read_text(f"{self.root}/{text(version)}/stats/{kind.lower()}_{name.lower()}.json")
        return json.loads(said) if said else None

    # reading

    def table(self, kind: str, name: str, version: int) -> DataFrame | None:
        """The files of one version as they are; None if it has none."""
        df = read_parquet(self.spark, self.path(version, kind, name))
        return None if df is None else df.withColumns({c: F.col(c).cast("bigint") for c in (FROM, BY) if c in df.columns})

    def read(self, kind: str, name: str, version: int | None = None, columns: Sequence[str] = (), filters: dict[str, list] | None = None, latest_only: bool = True, buckets: tuple[str, int] | None = None, ids: dict[str, Sequence[str]] | None = None) -> DataFrame | None:
        """A versioned table as it stood at a version (default: now); None if no version has it.

        The newest published table is read, whichever version it is of; an older version is asked of its rows'
        own versions. Then come the active rows, IN filters, bucket and derived ids where columns ask for them or
        no columns are named, and the projection.
        """
        newest = self.latest(kind, name)
        if newest is None:
            return None
        df = self.table(kind, name, newest)
        if version is not None and version < newest:
            df = as_of(df, version)
        if latest_only:
            df = df.filter(F.col(BY) == 0)
        df = filtered(df, None, filters)
        wanted = lambda c: not columns or c in columns
        if buckets and wanted("bucket_id"):
            df = with_bucket(df, buckets[0], buckets[1])
        for out, of in (ids or {}).items():
            if wanted(out) and out not in df.columns:
                df = df.withColumn(out, surrogate_id(df, of))
        return df.select(*columns) if columns else df

    def read_replayed(self, name: str, key: str, version: int | None = None, columns: Sequence[str] = (), filters: dict[str, list] | None = None, latest_only: bool = True) -> DataFrame | None:
        """The newest published table and the drops of later versions, with what these superseded: the newest map names their versions.

        Drops (kind DROP) have no version columns; the map (kind MAP) has key, valid_from, superseded_by of every
        drop's rows. A published row that is active and whose key is dropped again is superseded by that version.
        """
        start = self.latest(FACT, name, version)
        published = self.read(FACT, name, start, (), filters, latest_only=False) if start is not None else None
        after = [v for v in self.versions(DROP, name, version) if start is None or v > start]
        if not after:
            whole = published
        else:
            drops = [filtered(self.table(DROP, name, v), None, filters).withColumn("__v", F.lit(v).cast("bigint")) for v in after]
            union = drops[0]
            for d in drops[1:]:
                union = union.unionByName(d, allowMissingColumns=True)
            maps = self.table(MAP, name, max(after)).select(key, F.col(FROM).alias("__v"), BY)
            stamped = union.join(maps, [key, "__v"], "left").withColumnRenamed("__v", FROM).withColumn(BY, F.coalesce(F.col(BY), F.lit(0)).cast("bigint"))
            changes = union.select(key, F.col("__v").alias(BY))
            whole = stamped if published is None else replay(published, stamped.select(*published.columns), changes, key)
        if whole is None:
            return None
        whole = whole.filter(F.col(BY) == 0) if latest_only else whole
        return safe_select(whole, columns) if columns else whole

    def read_or_empty(self, kind: str, name: str, schema: T.StructType | str, version: int | None = None, **how) -> DataFrame:
        """The table, that of an older version, or no rows of the schema: for maps that the first run hasn't made yet."""
        found = self.read(kind, name, version, **how) if self.latest(kind, name) is not None else None
        return empty(self.spark, schema) if found is None else found

    def choose(self, name: str, version: int, columns: Sequence[str] = (), sample: int | None = None) -> DataFrame | None:
        """The raw drop of a version if it has one with all columns, else the published table; ``sample`` takes so many rows of it, for trial runs."""
        raw = self.table(DROP, name, version)
        found = raw if raw is not None and set(columns) <= set(raw.columns) else self.read(FACT, name, version)
        if found is None or (columns and not set(columns) <= set(found.columns)):
            return None
        found = found.select(*columns) if columns else found
        return found.limit(sample) if sample else found

    def by_mode(self, name: str, mode: str, version: int) -> DataFrame | None:
        """'full' and 'first': all that is active; 'refresh': what was active before; 'delta': that and the version's drop."""
        before = self.read(FACT, name, previous(version)) if mode in ("refresh", "delta") else self.read(FACT, name, version)
        if mode != "delta":
            return before
        drop = self.table(DROP, name, version)
        return drop if before is None else before if drop is None else before.unionByName(drop, allowMissingColumns=True)

    # the log of versions

    def runs(self) -> dict[str, dict]:
        said = self.read_text(f"{self.root}/runs.json")
        return json.loads(said) if said else {}

    def log_run(self, version: int, **facts) -> dict[str, dict]:
        """Adds to what the log says of a version; its status is CREATED at first."""
        runs = self.runs()
        runs[text(version)] = {"STATUS": "CREATED"} | runs.get(text(version), {}) | facts
        self.write_text(f"{self.root}/runs.json", json.dumps(dict(sorted(runs.items(), key=lambda r: milli(r[0]))), sort_keys=False))
        return runs

    def create_run(self, incoming: Iterable[str], manifest: Iterable[tuple[str, int]]) -> int:
        """The next version: one after the newest, for files that no earlier manifest names; its manifest is written. 0 if nothing is new."""
        known = {line.rsplit("|", 1)[0] for v in self.runs() for line in (self.read_text(f"{self.root}/{v}/manifest.txt") or "").splitlines()}
        batch = dict(manifest)
        fresh = sorted(f for f in incoming if f not in known)
        if not fresh:
            return 0
        version = max((milli(v) for v in self.runs()), default=self.base - 1) + 1
        self.write_text(f"{self.root}/{text(version)}/manifest.txt", "\n".join(f"{f}|{batch.get(f, 0)}" for f in fresh) + "\n")
        self.log_run(version, FILES=len(fresh))
        return version

    def manifest(self, version: int) -> list[str]:
        return (self.read_text(f"{self.root}/{text(version)}/manifest.txt") or "").splitlines()

    def release(self, version: int) -> None:
        """Marks a version as done; it must have published something."""
        if not any(n in listing(self.spark, f"{self.root}/{text(version)}") for n in ("fact", "dim", "syn", "map", "meta")):
            raise ValueError(f"version {text(version)} has published nothing")
        self.log_run(version, STATUS="SUCCESS")

    # gates

    def source_changed(self, names: Iterable[str], version: int) -> bool:
        """Whether a version has a drop of any of the tables."""
        return any(self.exists(self.path(version, DROP, n)) for n in names)

    def first_run(self, kind: str, name: str) -> bool:
        return self.latest(kind, name) is None

    def located(self, name: str, tag: str, roots: Sequence[int]) -> DataFrame:
        """An enrichment (kind META) in the first of the versions that has it; its stats must bear the tag."""
        for v in roots:
            if self.exists(self.path(v, META, name)):
                said = self.stats(META, name, v) or {}
                if said.get("tag") != tag:
                    raise ValueError(f"{name} of {text(v)} has tag {said.get('tag')}, not {tag}")
                return self.table(META, name, v)
        raise ValueError(f"no enrichment {name}")


def resolve(wanted: str, tables: Sequence[str], big: Sequence[str] = (), enriched: Sequence[str] = (), skipped: Sequence[str] = ()) -> list[str]:
    """A list of tables from a word: ALL, BIG, NOTBIG, ENRICHED, names by comma, or names with ~ to be left out of all. Small tables come first, by name, big ones last."""
    def ordered(names: Iterable[str]) -> list[str]:
        chosen = {n for n in names if n not in skipped}
        return sorted(chosen - set(big)) + [b for b in big if b in chosen]

    word = wanted.strip().upper()
    sets = {"ALL": tables, "BIG": [t for t in tables if t in big], "NOTBIG": [t for t in tables if t not in big], "ENRICHED": [t for t in tables if t in enriched]}
    if word in sets:
        return ordered(sets[word])
    names = [n.strip() for n in word.split(",") if n.strip()]
    if any(n.startswith("~") for n in names):
        left_out = {n.lstrip("~") for n in names}
        return [t for t in ordered(tables) if t not in left_out]
    return names


class TableJob:
    """A job on one table of a version: get, transform, output and validate, each to be given."""

    def __init__(self, get: Callable[[], DataFrame | None], transform: Callable[[DataFrame], DataFrame], output: Callable[[DataFrame], int], validate: Callable[[int], None] | None = None):
        self.get, self.transform, self.output, self.validate = get, transform, output, validate

    def run(self) -> int | None:
        """Rows written; None where there was nothing to get."""
        df = self.get()
        if df is None:
            return None
        n = self.output(self.transform(df))
        if self.validate:
            self.validate(n)
        return n


READERS: dict[str, Callable[..., DataFrame]] = {}
"""Readers of raw deliveries by the name of their provider."""


def provider(name: str) -> Callable[[Callable[..., DataFrame]], Callable[..., DataFrame]]:
    def register(reader: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        READERS[name.upper()] = reader
        return reader

    return register


def read_provider(name: str, *args, **how) -> DataFrame:
    if name.upper() not in READERS:
        raise ValueError(f"no reader for provider {name}; there are {sorted(READERS)}")
    return READERS[name.upper()](*args, **how)


def keys_to_rows(spark: SparkSession, keyed: dict[str, dict], columns: Sequence[str], valid: str = "is_valid", sep: str = "_") -> DataFrame:
    """The valid entries of a dictionary as rows: its keys 'a_b' split into the columns."""
    rows = [tuple(k.split(sep)) for k, v in keyed.items() if v.get(valid)]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))


def transformed(df: DataFrame, schema: Sequence[str], copies: dict[str, str] | None = None, constants: dict[str, object] | None = None, maps: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """A frame brought to a target schema by a configuration: columns copied under new names, constants, maps of columns by name; what is missing is null."""
    made: dict[str, Column] = {out: F.col(of) for out, of in (copies or {}).items()}
    made |= {out: F.lit(value) for out, value in (constants or {}).items()}
    for out, of in (maps or {}).items():
        pairs = [x for c in of for x in (F.lit(c), F.col(c).cast("string"))]
        made[out] = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    for c in schema:
        if c not in df.columns and c not in made:
            made[c] = F.lit(None).cast("string")
    return df.withColumns(made).select(*schema)


def front(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """The named columns first, those that exist."""
    lead = [c for c in first if c in df.columns]
    return df.select(*lead, *(c for c in df.columns if c not in lead))


def aliased(df: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """Columns under their legacy names too, unless these exist."""
    return df.withColumns({new: F.col(old) for new, old in aliases.items() if new not in df.columns and old in df.columns})


def release(store: Store, kind: str, name: str, version: int, columns: Sequence[str] = (), aliases: dict[str, str] | None = None, renames: dict[str, str] | None = None) -> int:
    """Publishes a table of all versions anew: read with its history, columns repaired and put in order, written as the version's."""
    df = store.read_replayed(name, "row_key", version, latest_only=False) if kind == FACT and store.versions(DROP, name, version) else store.read(kind, name, version, latest_only=False)
    if df is None:
        raise ValueError(f"no {kind} table {name}")
    df = aliased(df.withColumnsRenamed(renames or {}), aliases or {})
    kept = [*columns, *(c for c in (FROM, BY) if c in df.columns and c not in columns)] if columns else df.columns
    return store.publish(df.select(*kept), kind, name, version)


def write_enrichment(store: Store, df: DataFrame, name: str, version: int, columns: Sequence[str], tag: str, diff: tuple[str, str, str] | None = None) -> dict:
    """Writes an enrichment's declared columns with its tag and counts; with ``diff`` (entity, row id, guid) also the map of rows it changed."""
    n = store.publish(df.select(*columns), META, name, version)
    stats = {"tag": tag, "rows": n, "version": text(version)}
    if diff:
        stats["map_rows"] = store.publish(df.select(*diff), MAP, name, version)
    store.write_stats(stats, META, name, version)
    return stats


def publish_dictionary(store: Store, dictionary: DataFrame, name: str, version: int, entity: str, id_col: str, value: str, interim: Sequence[str] = ()) -> int:
    """Publishes a dictionary per entity after a check that ids and values are one to one in each; interim folders go."""
    per = dictionary.groupBy(entity).agg(F.count("*").alias("n"), F.countDistinct(id_col).alias("ids"), F.countDistinct(value).alias("vals")).filter("n <> ids or n <> vals")
    if not per.isEmpty():
        raise ValueError(f"{name}: ids and values collide for {entity} {per.first()[0]}")
    n = store.publish(dictionary, MAP, name, version)
    for path in interim:
        fs, where = store._fs(path)
        fs.delete(where, True)
    return n
