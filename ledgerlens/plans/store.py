"""Stored star schema: landing batches, an atomically switched manifest, persistent views.

A store is a folder. Every landing batch writes its tables below ``data/<batch>/`` once and never
touches them again: the five tables of the star schema and the risk mart, each bucketed and
sorted by ``customer_id`` with the store's bucket count, and the batch's segment cells (counts
and exact sums per combination of report labels). A version of the store is one small JSON
manifest ``log/<version>.json`` that names the batches, the bucket count, the next free id and
the text of the views. It is written aside and renamed into place without overwriting, so a
reader sees a whole version or the one before; a load that dies half-way leaves folders that no
manifest names, and of two loads at once one fails and can be repeated.

* ``rebuild`` replaces all batches (idempotent), ``append`` adds one: it reads the new accounts
  only, and reports merge the cells of all batches, since each cell holds mergeable sums.
* Accounts without ids get the next ones in the given order (high-water allocation): loads
  continue the sequence and never renumber.
* ``open`` binds the tables of any version to a session: reports, audits and views then run
  without rebuilding. Buckets of all batches line up, so grouping or joining by customer,
  within a batch or over their union, moves no rows.
* ``views``: SELECT statements over the stored tables, kept in the manifest and bound on open.

A rename that does not overwrite is atomic on HDFS and local disks; on an object store without
one, run a single loader at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import features, positions
from ..operators.segments import build_cube, merge_cells
from ..schema import RAW_COLUMNS
from ..session import compiled
from . import kpi
from .mart import Portfolio

TABLES = ("staging_raw_credit_data", "dim_customers", "fact_repayment_history", "fact_statements", "fact_credit_risk")
MART, CELLS, KEY = "risk_mart", "segment_cells", "customer_id"
#: Accounts in a bucket, about: a bucket's rows (six an account in the long facts) are sorted by one
#: task, in memory.
BUCKET_ROWS = 1 << 18


class ConcurrentLoad(RuntimeError):
    """Another load published this version first; nothing of this one is visible."""


def buckets_for(staging: DataFrame) -> int:
    """Buckets for a stored landing table: the shuffle partitions, more if it is large."""
    return max(int(staging.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-staging.count() // BUCKET_ROWS))


class StarStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    # ---- manifests -----------------------------------------------------------------

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _children(self, *parts: str) -> list[str]:
        fs, path = self._fs(), self._path(*parts)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def versions(self) -> list[int]:
        """Numbers of the published versions, oldest first."""
        return sorted(int(n[:-5]) for n in self._children("log") if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int | None = None) -> dict:
        """The manifest of a version (the newest, if none is named)."""
        known = self.versions()
        if not known:
            raise FileNotFoundError(f"{self.root} holds no published version")
        version = known[-1] if version is None else version
        if version not in known:
            raise FileNotFoundError(f"{self.root} holds no version {version}; there are {known}")
        text = self.spark.read.text(f"{self.root}/log/{version:08d}.json", wholetext=True).first()[0]
        return json.loads(text)

    def _publish(self, manifest: dict) -> int:
        """Switch to ``manifest``: written aside, then renamed to the next number."""
        jvm, version = self.spark._jvm, manifest["version"]
        aside, final = self._path("log", f".{uuid.uuid4().hex}"), self._path("log", f"{version:08d}.json")
        fs = self._fs()
        out = fs.create(aside, False)
        out.write(bytearray(json.dumps(manifest, indent=1).encode()))
        out.close()
        no_overwrite = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getConf()).rename(fs.makeQualified(aside), fs.makeQualified(final), no_overwrite)
        except Py4JJavaError as e:
            fs.delete(aside, False)
            raise ConcurrentLoad(f"version {version} of {self.root} was not published: {e.java_exception}") from e
        return version

    # ---- loads ---------------------------------------------------------------------

    def _bucketed(self, df: DataFrame, batch: str, name: str, buckets: int, dealt: bool = False) -> None:
        """One file a bucket, sorted by the key (``dealt``: the rows lie by bucket already). The
        catalog entry that bucketed writing needs is dropped again; the files stay."""
        entry, path = f"ll_{batch}_{name}", f"{self.root}/data/{batch}/{name}"
        rows = df if dealt else df.repartition(buckets, KEY)
        with compiled(df.sparkSession):
            rows.write.format("parquet").bucketBy(buckets, KEY).sortBy(KEY).option("path", path).saveAsTable(entry)
        self.spark.sql(f"DROP TABLE {entry}")

    def _write(self, accounts: DataFrame, buckets: int, lenient: bool, high: int = 0, tables: dict[str, DataFrame] | None = None,
               batch: str | None = None, dealt: Iterable[str] = ()) -> dict:
        """Stage a batch: landing rows dealt into buckets (one shuffle), the mart derived bucket by
        bucket from what was stored, the other tables from both. ``tables`` stand in for derived
        ones; those in ``dealt`` lie by bucket already. Nothing refers to the batch yet."""
        batch = batch or uuid.uuid4().hex[:12]
        landing = accounts.select(*RAW_COLUMNS)
        schemas = {TABLES[0]: landing.schema}
        with self._by_bucket():
            self._bucketed(landing, batch, TABLES[0], buckets, dealt=TABLES[0] in dealt)
        rows, first, last = self._registered(batch, TABLES[0], landing.schema, buckets).agg(F.count(F.lit(1)), F.min(KEY), F.max(KEY)).first()
        if high and first is not None and first <= high:
            self._fs().delete(self._path("data", batch), True)
            raise ValueError(f"ids up to {high} are taken; the new accounts start at {first}")
        with self._by_bucket():
            stored = self._registered(batch, TABLES[0], landing.schema, buckets)
            mart = features.risk_mart(stored, lenient)
            schemas[MART] = mart.schema
            self._bucketed(mart, batch, MART, buckets, dealt=True)
            pf = Portfolio(staging=stored, mart=self._registered(batch, MART, mart.schema, buckets), lenient=lenient)
            for name, df in pf.tables().items():
                other = tables is not None and name in tables
                df = tables[name] if other else df
                schemas[name] = df.schema
                if name != TABLES[0]:
                    self._bucketed(df, batch, name, buckets, dealt=not other or name in dealt)
        build_cube(self._registered(batch, MART, schemas[MART], buckets)).write.parquet(f"{self.root}/data/{batch}/{CELLS}")
        return {"id": batch, "rows": rows, "first_id": first, "last_id": last, "lenient": lenient, "schemas": {n: s.jsonValue() for n, s in schemas.items()}}

    @contextmanager
    def _by_bucket(self) -> Iterator[None]:
        """Scans inside keep a table's buckets though no join asks for them."""
        scan = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
        before = self.spark.conf.get(scan)
        self.spark.conf.set(scan, "false")
        try:
            yield
        finally:
            self.spark.conf.set(scan, before)

    def _first(self, staged: dict, views: dict[str, str]) -> int:
        known = self.versions()
        return self._publish({"version": (known[-1] if known else 0) + 1, "buckets": self.buckets, "next_id": (staged["last_id"] or 0) + 1,
                              "batches": [staged], "views": views})

    def _views(self) -> dict[str, str]:
        return self.manifest()["views"] if self.versions() else kpi.VIEW_SQL

    def publish(self, pf: Portfolio, tables: dict[str, DataFrame] | None = None) -> int:
        """A version with one batch, a built portfolio; ``tables`` stand in for derived ones of
        the same name. Earlier versions stay readable until ``vacuum``."""
        landing = (tables or {}).get(TABLES[0], pf.staging)
        return self._first(self._write(landing, self.buckets, pf.lenient, tables=tables), self._views())

    def publish_edited(self, pf: Portfolio, edit: Callable[[dict[str, DataFrame]], dict[str, DataFrame]], rekeyed: Iterable[str] = ()) -> int:
        """``publish`` with the portfolio's tables as ``edit`` returns them. The landing rows are
        dealt once, and the tables derived and edited bucket by bucket; only the ``rekeyed``
        ones, whose rows may get other keys, are dealt by themselves."""
        batch, origin, rekeyed = uuid.uuid4().hex[:12], "origin", frozenset(rekeyed)
        landing = pf.staging.select(*RAW_COLUMNS)
        self._bucketed(landing, batch, origin, self.buckets)
        lying = self._registered(batch, origin, landing.schema, self.buckets)
        in_place = edit(Portfolio(staging=lying, mart=features.risk_mart(lying, pf.lenient), lenient=pf.lenient).tables())
        moved = edit(pf.tables())
        tables = {name: (moved if name in rekeyed else in_place)[name] for name in TABLES}
        staged = self._write(tables[TABLES[0]], self.buckets, pf.lenient, tables=tables, batch=batch, dealt=frozenset(TABLES) - rekeyed)
        self.spark.sql(f"DROP TABLE ll_{batch}_{origin}")
        self._fs().delete(self._path("data", batch, origin), True)
        return self._first(staged, self._views())

    def rebuild(self, accounts: DataFrame, order_by: list[str] | None = None, lenient: bool = False) -> int:
        """A version that holds these accounts only. Without a ``customer_id`` column they are
        numbered from 1 in the order of ``order_by``."""
        if KEY not in accounts.columns:
            accounts = allocate_ids(accounts, KEY, order_by, 0)
        return self._first(self._write(accounts, self.buckets, lenient), self._views())

    def append(self, accounts: DataFrame, order_by: list[str] | None = None, lenient: bool = False) -> int:
        """The newest version and one more batch. Only the new accounts are read; without a
        ``customer_id`` column they get the next ids."""
        if not self.versions():
            return self.rebuild(accounts, order_by, lenient)
        now = self.manifest()
        high = now["next_id"] - 1
        if KEY not in accounts.columns:
            accounts = allocate_ids(accounts, KEY, order_by, high)
        staged = self._write(accounts, now["buckets"], lenient, high)
        after = max(now["next_id"], (staged["last_id"] or 0) + 1)
        return self._publish(now | {"version": now["version"] + 1, "next_id": after, "batches": [*now["batches"], staged]})

    def compact(self) -> int:
        """A version with the same accounts in one batch."""
        now = self.manifest()
        pf = self.open()
        staged = self._write(pf.staging, now["buckets"], pf.lenient)
        return self._publish(now | {"version": now["version"] + 1, "batches": [staged]})

    def put_view(self, name: str, sql: str | None) -> int:
        """CREATE OR REPLACE VIEW (DROP VIEW without a statement): a version that differs in
        its views only."""
        now = self.manifest()
        views = {k: v for k, v in now["views"].items() if k != name} | ({name: sql} if sql is not None else {})
        return self._publish(now | {"version": now["version"] + 1, "views": views})

    def vacuum(self, keep: int = 1) -> list[str]:
        """Delete all but the newest ``keep`` versions, and batch folders that none of those
        names (loads that died; run it while no load is running). Returns the folders' names."""
        fs, known = self._fs(), self.versions()
        kept = known[-max(1, keep):]
        used = {b["id"] for v in kept for b in self.manifest(v)["batches"]}
        for v in known[:-len(kept)] if kept else []:
            fs.delete(self._path("log", f"{v:08d}.json"), False)
        gone = [n for n in self._children("data") if n not in used]
        for name in gone:
            fs.delete(self._path("data", name), True)
        return gone

    # ---- reading -------------------------------------------------------------------

    def _registered(self, batch: str, name: str, schema: T.StructType, buckets: int) -> DataFrame:
        """A batch's table, known to the session as bucketed by the key."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS ll_{batch}_{name} ({columns}) USING parquet CLUSTERED BY ({KEY}) SORTED BY ({KEY}) "
                       f"INTO {buckets} BUCKETS LOCATION '{self.root}/data/{batch}/{name}'")
        return self.spark.table(f"ll_{batch}_{name}")

    def _table(self, manifest: dict, name: str) -> DataFrame:
        """The union of the batches' tables; Spark keeps their common partitioning."""
        parts = [self._registered(b["id"], name, T.StructType.fromJson(b["schemas"][name]), manifest["buckets"]) for b in manifest["batches"]]
        return reduce(DataFrame.unionByName, parts)

    def cells(self, version: int | None = None) -> DataFrame:
        """The segment cube of a version: one scan of all batches' cells, merged."""
        paths = [f"{self.root}/data/{b['id']}/{CELLS}" for b in self.manifest(version)["batches"]]
        return merge_cells(self.spark.read.parquet(*paths))

    def open(self, version: int | None = None) -> Portfolio:
        """The portfolio of a version (the newest, if none is named)."""
        m = self.manifest(version)
        tables = {name: self._table(m, name) for name in TABLES}
        pf = Portfolio(staging=tables[TABLES[0]], mart=self._table(m, MART), lenient=any(b["lenient"] for b in m["batches"]), stored=tables)
        pf._cube = self.cells(m["version"])
        pf._star = (tables["fact_credit_risk"], tables["dim_customers"])
        return pf

    def bind_views(self, version: int | None = None, prefix: str = "") -> list[str]:
        """Make a version's tables and views known to the session by name."""
        m = self.manifest(version)
        for name in (*TABLES, MART):
            self._table(m, name).createOrReplaceTempView(prefix + name)
        self.cells(m["version"]).createOrReplaceTempView(prefix + CELLS)
        names = {n: f"`{prefix}{n}`" for n in (*TABLES, MART, CELLS)}
        for view, sql in m["views"].items():
            self.spark.sql(sql.format(**names)).createOrReplaceTempView(prefix + view)
        return [prefix + v for v in m["views"]]


def allocate_ids(df: DataFrame, id_col: str, order_by: Iterable[str] | None, high: int) -> DataFrame:
    """S7 as a sequence: the rows of a load get ``high`` + 1, ``high`` + 2, ... in the given
    order; rows that have an id keep it by not being part of the load."""
    order = list(order_by or [])
    if not order:
        raise ValueError("order_by: ids follow an explicit order")
    return positions.with_row_number(df, id_col, order_by=order).withColumn(id_col, F.col(id_col) + F.lit(high).cast("bigint"))
