"""End-to-end normalization (raw rows → nine tables) and the flat load.

Tables are built parents first; each one is written as Parquet under the run
folder and read back before its children use it, exactly as a database would
insert into a parent table and then select from it. The written tables cut the
lineage, so a lost executor costs one table's tasks, not the whole chain.
Intermediate files (the staged raw rows, the dense-key stages) live under
``<run_dir>/_staging`` and are not part of the published tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import path_exists, remove_path, stage_path, write_stored
from ..operators.buckets import by_bucket, even, write_bucketed
from ..operators.dedup import keep_first
from ..operators.integrity import duplicate_keys
from ..operators.keymap import KeyMap
from ..schemas import RAW_ORDERS_SCHEMA, TABLE_ORDER, TABLES
from . import entities as E
from .metrics import Journal, TableMetrics, observed_write


# Tables each builder reads (FK parents that are only checked are not inputs).
BUILD_INPUTS = {
    "product": (), "addresses": (), "type_ship": (), "people": (), "customers": (),
    "orders": ("people", "type_ship", "addresses"),
    "date_ship": ("type_ship",),
    "order_details": ("product",),
    "returns": ("orders", "order_details"),
}


# The facts that are joined on order_id.
BUCKETED = ("orders", "order_details")


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet at ``path`` and return the written table."""
    write_stored(df, path)
    return df.sparkSession.read.parquet(path)


class KeyViolation(ValueError):
    """A natural primary key or a lookup key is not unique (strict mode)."""


def check_keys(name: str, table: DataFrame, sample: int = 5) -> None:
    """Strict mode: raise if the table's natural primary key, or the natural key
    its children look it up by, occurs twice (NULL lookup keys never match and
    are ignored). Only a handful of offending keys reach the driver."""
    spec = TABLES[name]
    checks = []
    if spec.surrogate is None:
        checks.append(("primary key", spec.primary_key, table))
    if spec.lookup_key:
        non_null = table
        for k in spec.lookup_key:
            non_null = non_null.filter(F.col(k).isNotNull())
        checks.append(("lookup key", spec.lookup_key, non_null))
    for kind, key, df in checks:
        bad = duplicate_keys(df, key).take(sample)
        if bad:
            shown = ", ".join(str(tuple(r[k] for k in key)) for r in bad)
            raise KeyViolation(f"{name}: {kind} {key} not unique, e.g. {shown}")


class Normalizer:
    """Builds the nine tables on demand, parents first, each written once.

    ``raw_orders`` is staged as Parquet first (when ``stage_raw``), so the
    builders read just their columns from a columnar copy instead of repeating
    the upstream scan or join; the four dimensions in it come from one scan. With ``strict`` a table whose natural or lookup
    key is not unique stops the load (``KeyViolation``), as a primary key
    constraint would; otherwise such rows are kept and the validation report
    flags them.

    ``metrics`` has each table's figures, gathered while it was written. They are
    kept in the run's journal; with ``resume`` the tables that the journal of
    ``run_dir`` names are taken up as they are (``resumed``) and only the others
    (``written``) are built; so is its staged copy of the raw rows, if it was finished.
    The inputs must be those of the first attempt.

    ``key_dir`` names a folder of key maps: surrogate keys given there by earlier
    loads are kept, new rows are numbered after them.

    With ``buckets`` orders, lines and the returned orders are stored in that many
    buckets by order_id, so that the joins on it need no shuffle; a table whose buckets
    turn out uneven (a hot order) is read as plain files, whose joins can be split.
    """

    def __init__(self, raw_orders: DataFrame, raw_people: DataFrame, raw_returns: DataFrame,
                 run_dir: str | None = None, stage_raw: bool = True,
                 num_partitions: int | None = None, strict: bool = False, resume: bool = False,
                 key_dir: str | None = None, buckets: int | None = None):
        self.spark = raw_orders.sparkSession
        self.run_dir = (run_dir or stage_path(self.spark, "run")).rstrip("/")
        self.num_partitions = num_partitions
        self._raw_orders = raw_orders
        self._staged_raw: DataFrame | None = None if stage_raw else raw_orders
        self.raw_people = raw_people
        self.raw_returns = raw_returns
        self.strict = strict
        self.resume = resume
        self.key_dir = key_dir
        self.buckets = buckets
        self._grains: dict[str, DataFrame] | None = None
        self._returned: DataFrame | None = None
        self.tables: dict[str, DataFrame] = {}
        self.metrics: dict[str, TableMetrics] = {}
        self.written: list[str] = []
        self.resumed: list[str] = []
        self.journal = Journal(self.spark, self.run_dir)
        if resume:
            for name, figures in self.journal.done().items():
                self.tables[name] = self.spark.read.parquet(self.path(name))
                self.metrics[name] = figures
                self.resumed.append(name)

    @property
    def raw_orders(self) -> DataFrame:
        if self._staged_raw is None:
            rows = self._raw_orders.select(*[f.name for f in RAW_ORDERS_SCHEMA.fields if f.name in self._raw_orders.columns])
            path = f"{self.run_dir}/_staging/raw_orders"
            copy = self._taken_up(rows, path)
            self._staged_raw = stage(rows, path) if copy is None else copy
        return self._staged_raw

    def _taken_up(self, rows: DataFrame, path: str) -> DataFrame | None:
        """The copy of ``rows`` that the first attempt of a resumed run finished, if any: a
        write that ended has a ``_SUCCESS``."""
        if not self.resume or not path_exists(self.spark, f"{path}/_SUCCESS"):
            return None
        copy = self.spark.read.parquet(path)
        same = [(f.name, f.dataType) for f in copy.schema] == [(f.name, f.dataType) for f in rows.schema]
        return copy if same else None

    @property
    def grains(self) -> dict[str, DataFrame]:
        """The distinct rows of the dimensions that come from the orders, all from
        one scan of them."""
        if self._grains is None:
            self._grains = E.stage_dimensions(self.raw_orders, f"{self.run_dir}/_staging/dimensions")
        return self._grains

    def _steps(self, name: str) -> str:
        """Folder of the files that are written on the way to table ``name``."""
        return f"{self.run_dir}/_staging/{name}"

    def _known(self, name: str) -> KeyMap | None:
        return KeyMap(self.spark, f"{self.key_dir.rstrip('/')}/{name}") if self.key_dir else None

    def _builders(self) -> dict[str, Callable[[], DataFrame]]:
        n = self.num_partitions
        s = self._steps
        t = self.table
        k = self._known
        return {
            "product": lambda: E.keyed(self.grains["product"], "product", n, s("product"), k("product")),
            "addresses": lambda: E.keyed(self.grains["addresses"], "addresses", n, s("addresses"), k("addresses")),
            "type_ship": lambda: E.keyed(self.grains["type_ship"], "type_ship", n, s("type_ship"), k("type_ship")),
            "people": lambda: E.build_people(self.raw_people, n, s("people"), k("people")),
            "customers": lambda: E.conform_table(self.grains["customers"], "customers"),
            "orders": lambda: self._order(E.build_orders(
                self.raw_orders, t("people"), t("type_ship"), t("addresses"))),
            "date_ship": lambda: E.build_date_ship(self.raw_orders, t("type_ship"), n, s("date_ship"), k("date_ship")),
            "order_details": lambda: E.build_order_details(self.raw_orders, t("product"), n, s("order_details"), k("order_details")),
            "returns": lambda: E.build_returns(self.returned, t("orders"), t("order_details"),
                                               n, s("returns"), k("returns")),
        }

    def _order(self, orders: DataFrame) -> DataFrame:
        return orders if self.buckets else E.sort_orders(orders)

    @property
    def returned(self) -> DataFrame:
        """The raw returns, bucketed like the facts if these are."""
        if not self.buckets:
            return self.raw_returns
        if self._returned is None:
            rows = by_bucket(E.returned_orders(self.raw_returns), "order_id", self.buckets)
            path = f"{self.run_dir}/_staging/returned"
            self._returned = self._if_even(write_bucketed(rows, path, "order_id", self.buckets, "returned"), path)
        return self._returned

    def _if_even(self, table: DataFrame, path: str) -> DataFrame:
        return table if even(table, self.buckets) else self.spark.read.parquet(path)

    def path(self, name: str) -> str:
        return f"{self.run_dir}/{name}"

    def cleanup_staging(self) -> bool:
        """Delete ``<run_dir>/_staging`` (staged raw rows, dense-key stages).
        The written tables do not read from it; ``raw_orders`` is staged again
        if asked for afterwards."""
        if self._staged_raw is not None and self._staged_raw is not self._raw_orders:
            self._staged_raw = None
        self._grains = self._returned = None
        # the mark goes first: a copy that is removed in part must not be taken up
        remove_path(self.spark, f"{self.run_dir}/_staging/raw_orders/_SUCCESS")
        return remove_path(self.spark, f"{self.run_dir}/_staging")

    def table(self, name: str) -> DataFrame:
        if name not in self.tables:
            built = self._builders()[name]()
            bucket = ("order_id", self.buckets) if self.buckets and name in BUCKETED else None
            written, figures = observed_write(built, self.path(name), name, bucket)
            if bucket is not None:
                written = self._if_even(written, self.path(name))
            if self.strict:
                check_keys(name, written)
            self.journal.record(name, figures)
            self.metrics[name] = figures
            self.written.append(name)
            remove_path(self.spark, self._steps(name))  # the written table doesn't read them
            self.tables[name] = written
        return self.tables[name]

    def build(self, names: Iterable[str] = TABLE_ORDER, parallel: bool = True) -> dict[str, DataFrame]:
        """Build ``names`` and the tables they are built from.

        With ``parallel`` every table starts, from its own thread, as soon as
        the tables it reads are written; independent Spark jobs (the small
        dimensions, the three fact tables) then share the cluster instead of
        queuing one after another.
        """
        wanted: list[str] = []

        def need(name: str) -> None:
            for parent in BUILD_INPUTS[name]:
                need(parent)
            if name not in wanted:
                wanted.append(name)

        for name in names:
            need(name)
        pending = [n for n in TABLE_ORDER if n in wanted and n not in self.tables]
        if any(n != "people" for n in pending):
            self.raw_orders  # stage the shared input once, before the builders start
        if any(n in E.DIMENSION_GRAINS for n in pending):
            self.grains
        if not parallel or len(pending) < 2:
            for n in pending:
                self.table(n)
        else:
            with ThreadPoolExecutor(max_workers=len(pending)) as pool:
                futures = {}

                def run(name: str) -> DataFrame:
                    for dep in BUILD_INPUTS[name]:
                        if dep in futures:
                            futures[dep].result()
                    return self.table(name)

                for n in pending:  # TABLE_ORDER lists inputs before their users
                    futures[n] = pool.submit(run, n)
                for f in futures.values():
                    f.result()
        return {name: self.tables[name] for name in TABLE_ORDER if name in self.tables}


def normalize(raw_orders: DataFrame, raw_people: DataFrame, raw_returns: DataFrame,
              run_dir: str | None = None, stage_raw: bool = True,
              num_partitions: int | None = None, strict: bool = False) -> dict[str, DataFrame]:
    """All nine tables, written under ``run_dir`` (a fresh folder under the
    checkpoint root by default), as DataFrames over the written files. The
    run's staging folder is removed afterwards."""
    normalizer = Normalizer(raw_orders, raw_people, raw_returns, run_dir, stage_raw,
                            num_partitions, strict)
    try:
        return normalizer.build()
    finally:
        normalizer.cleanup_staging()


def flat_load(raw_orders: DataFrame, raw_people: DataFrame, raw_returns: DataFrame,
              people_seq: str = "seq", returns_seq: str = "seq",
              out_dir: str | None = None) -> dict[str, DataFrame]:
    """The flat three-table load: orders as read, people de-duplicated by
    region and returns by order id, each keeping the first row by sheet
    position (the ``*_seq`` columns). With ``out_dir`` the three tables replace
    any earlier copy there (``overwrite``) and are returned as written."""
    frames = {
        "orders": raw_orders.select(*[f.name for f in RAW_ORDERS_SCHEMA.fields
                                      if f.name in raw_orders.columns]),
        "people": keep_first(raw_people, ["region"], people_seq, ["person", "region"]),
        "returns": keep_first(raw_returns, ["order_id"], returns_seq, ["returned", "order_id"]),
    }
    if out_dir is None:
        return frames
    return {name: stage(df, f"{out_dir.rstrip('/')}/{name}") for name, df in frames.items()}


__all__ = ["KeyViolation", "Normalizer", "TABLES", "check_keys", "flat_load", "normalize", "stage"]
