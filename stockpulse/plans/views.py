"""The eight composed outputs, each built once per run.

The source re-inlines every upstream view (view 7 expands views 5 and 4
again, view 4 reads view 2 twice).  Here each output is one DataFrame built
once, and the outputs with several consumers -- view 1 in ledger order (rows and
chunk totals of the balance), view 2 (the ledger and its dates), view 3
(supply timeline and PO timing), view 4 (views 5 and 7, deficits), safety stock
(views 6 and 7), and views 6 and 7 (the report queries) -- are materialised
once per run:

  materialize="table"       written once as Parquet, to ``output_path`` for the
                            published outputs if one is given, else to a folder
                            of this run under the cluster's shared
                            ``spark.checkpoint.dir``; later stages scan it with
                            column pruning, pushed filters and statistics, and a
                            lost executor re-reads instead of recomputing.
  materialize="persist"     MEMORY_AND_DISK cache; a lost executor's blocks
                            are recomputed from lineage.
                            The steps of views 1, 2 and 4 (core ledger, ranked issues,
                            rows before their order; rows with stock; rows with
                            supply) are stored too until the view is there.
                            Each write removes its shuffle files when it ends, so a
                            run holds its tables and the exchanges of one step.
                            Views 1, 2, 4 and 5 and the deficit rows are made in ``slices`` of their
                            orders or items, one after another, so that it holds the
                            exchanges and steps of one slice; the tables are read once
                            per slice.  By default one more per 64 MB of demand, up to 4.
  materialize=None          fully lazy (each consumer recomputes).
  materialize="auto"        (default) table when the session names a
                            checkpoint folder or an output path is given, else
                            persist.

``split="hot"`` (the registered queries) deals the ledger out by item once: items of up to
``HOT_ROWS`` rows get stock, balance, supply and re-attach where they lie, only larger ones go through
the ordered layout and its bounded pieces, into the same tables.  View 4 then comes from view 1,
and views 6 and 7 and the reports read a table of the columns they need (``decisions``).

``release()`` drops the caches and the run's folder (not ``output_path``).
"""

from __future__ import annotations

import contextlib
import dataclasses
import functools
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockpulse.functions import norm_key
from stockpulse.operators import action, buyer, demand, overlay, quarantine, risk, safety, suppress
from stockpulse.operators.slices import WHOLE, Slice
from stockpulse.params import Params
from stockpulse.sources.publish import LAYOUT, laid_out


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder that the session names in ``spark.checkpoint.dir``, if any."""
    return spark.conf.get("spark.checkpoint.dir", None)


#: Spark's setting by which a query's shuffle files go when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Spark's setting by which joins need rows dealt out by all their keys; without it rows that lie
#: by one of the keys stay where they are.
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"

#: Tables are made in one more slice per so many bytes of demand, at most so many.
SLICE_BYTES, MAX_SLICES = 64 << 20, 4
#: Spark's size of a table of which it knows none.
UNKNOWN_BYTES = 1 << 60


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the stored tables that ``df`` reads, 0 if Spark does not know them."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    total = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return total if total < UNKNOWN_BYTES else 0


#: ``split="hot"``: items of up to so many rows are worked whole, in one exchange by item; larger
#: ones are scanned in bounded pieces.
HOT, HOT_ROWS = "hot", 1 << 21

#: Outputs that ``output_path`` receives as they are built.  ``materialize_all`` adds the
#: demand ledger and the suppressed ledger, projections of tables that the run stores.
OUTPUTS = ("quarantine_pipe", "extended_ledger", "supply_action", "safety_stock",
           "run_risk", "buyer_control")


#: Columns of view 4 that views 6 and 7, the reports and the checks read.
DECISION_COLUMNS = [c for c in overlay.V4_COLUMNS if c in {
    *action.ACTION_INPUTS, *risk.DEFICIT_COLUMNS, "Suppression_Status", "WFQ_Extended_Status"}]


class LedgerRun:
    """All outputs of one run over one snapshot of the sources."""

    def __init__(self, tables: dict[str, DataFrame], params: Params, materialize: str | None = "auto",
                 split: bool | str = True, output_path: str | None = None, layout: bool = False, slices: int | None = None):
        if materialize not in (None, "auto", "persist", "table"):
            raise ValueError(f"materialize={materialize!r}")
        self.spark = next(iter(tables.values())).sparkSession
        shared = checkpoint_dir(self.spark) or output_path
        if materialize == "auto":
            materialize = "table" if shared else "persist"
        if materialize == "table" and not shared:
            raise ValueError("materialize='table' needs spark.checkpoint.dir or output_path")
        self.t = tables
        self.p = params
        self.materialize = materialize
        if split not in (True, False, HOT):
            raise ValueError(f"split={split!r}")
        self.split = split  # scan per-item orders in bounded pieces: of every item, of none, or of hot ones only
        self.output_path = output_path
        self.layout = layout  # lay published outputs out by their lookup keys
        if slices is None:
            slices = min(MAX_SLICES, 1 + stored_bytes(tables["planning"]) // SLICE_BYTES) if materialize == "table" else 1
        self.slices = slices  # wide tables are made in so many slices, one after another
        self._scratch = f"{shared}/ledger-run-{uuid.uuid4().hex}" if materialize == "table" else None
        self._held: list[DataFrame] = []
        self._cleanup = self.spark.conf.get(SHUFFLE_CLEANUP, None)  # the session's own settings
        self._all_keys = self.spark.conf.get(ALL_KEYS, None)

    def _cut(self, df: DataFrame, name: str) -> DataFrame:
        if self.materialize is None:
            return df
        if self.materialize == "persist":
            df = df.persist(StorageLevel.MEMORY_AND_DISK)
            self._held.append(df)
            return df
        return self._store(df, name)

    def _sliced(self, build: Callable[[Slice], DataFrame], name: str, *steps: str) -> DataFrame:
        """A table built slice by slice, so that disk holds one slice's exchanges and ``steps``.

        A table for ``output_path`` is written at once, so that it is there whole or not at all."""
        if self.materialize != "table":
            return self._cut(build(WHOLE), name)
        n = self.slices if self._base(name) == self._scratch else 1
        for i in range(n):
            df = self._store(build(Slice(i, n)), name, "append" if i else "overwrite")
            self._drop(*steps)
        return df

    def _base(self, name: str) -> str:
        return self.output_path if self.output_path and name in OUTPUTS else self._scratch

    def _store(self, df: DataFrame, name: str, mode: str = "overwrite") -> DataFrame:
        base = self._base(name)
        if self.layout and base == self.output_path:
            df = laid_out(df, LAYOUT.get(name, ()))
        writer = df.write.mode(mode)
        if base == self._scratch:
            writer = writer.option("compression", "zstd")
        self.spark.conf.set(SHUFFLE_CLEANUP, "true")
        try:
            writer.parquet(f"{base}/{name}")
        finally:
            self._restore_cleanup()
        return self.spark.read.schema(df.schema).parquet(f"{base}/{name}")

    def _restore_cleanup(self) -> None:
        self._restore(SHUFFLE_CLEANUP, self._cleanup)

    def _restore(self, name: str, value: str | None) -> None:
        if value is None:
            self.spark.conf.unset(name)
        else:
            self.spark.conf.set(name, value)

    @contextlib.contextmanager
    def _rows_stay(self) -> Iterator[None]:
        """Joins of what is stored meanwhile leave rows that are dealt out by one of their keys."""
        self.spark.conf.set(ALL_KEYS, "false")
        try:
            yield
        finally:
            self._restore(ALL_KEYS, self._all_keys)

    def _step(self, df: DataFrame, name: str) -> DataFrame:
        """A step stored for the next one only, where the run stores tables."""
        return self._store(df, name) if self.materialize == "table" else df

    def _drop(self, *names: str) -> None:
        """Delete the tables of steps that are done with."""
        if self.materialize == "table":
            for name in names:
                self._delete(f"{self._scratch}/{name}")

    def _delete(self, path: str) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def release(self) -> None:
        """Drop persisted intermediates and the run's own folder."""
        for df in self._held:
            df.unpersist()
        self._held.clear()
        if self._scratch:
            self._delete(self._scratch)

    def release_quietly(self) -> None:
        """``release`` for the end of a program, when the session may be gone."""
        with contextlib.suppress(Exception):
            self.release()

    @functools.cached_property
    def v1_full(self) -> DataFrame:
        """Demand ledger, in ledger order with the row's position where the balance is
        split; read twice by the skew-safe balance."""
        def rows(part: Slice) -> DataFrame:
            return demand.demand_ledger(self.t, self.p, self._step, part)

        def dealt(part: Slice) -> DataFrame:
            return demand.demand_ledger_dealt(self.t, self.p, self._step, part)
        if self.split == HOT:
            with self._rows_stay():
                return self._sliced(dealt, "demand_ledger_full", "ranked_issues")
        steps = ["core_ledger", "ranked_issues"]
        if not self.split:
            return self._sliced(rows, "demand_ledger_full", *steps)
        if self.materialize != "table":
            cut = None if self.materialize is None else lambda df: self._cut(df, "demand_ledger_full")
            return suppress.ledger_layout(rows(WHOLE), self.p, cut)
        # laying out reads its rows several times (split points, exchange)
        made = self._sliced(rows, "demand_rows", *steps)
        v1 = self._sliced(lambda part: suppress.ledger_layout(made, self.p, lambda df: df, part), "demand_ledger_full")
        self._drop("demand_rows")
        return v1

    @functools.cached_property
    def v1(self) -> DataFrame:
        """Demand ledger (31 columns)."""
        return self.v1_full.select(*demand.V1_COLUMNS)

    @functools.cached_property
    def _hot(self) -> list[str] | None:
        """The keys of the items to split, None if all are."""
        return suppress.hot_items(self.v1_full, self.p, HOT_ROWS) if self.split == HOT else None

    def _items(self, hot: bool, part: Slice = WHOLE) -> DataFrame:
        """View 1 of the hot items, or of the others in a slice."""
        key = norm_key(F.col("ITEMNMBR"), self.p.case_insensitive)
        rows = suppress.item_slice(self.v1_full, self.p, part)
        if not self._hot:
            return rows
        return rows.where(F.coalesce(key.isin(self._hot), F.lit(False)) == hot)

    @functools.cached_property
    def _hot_v2(self) -> DataFrame:
        """View 2 of the hot items, scanned in bounded pieces."""
        laid = suppress.ledger_layout(self._items(True), self.p, lambda df: self._cut(df, "hot_layout"))
        return self._cut(suppress.suppressed_ledger_full(laid, self.t["bin_stock"], self.p, cut=self._step), "hot_ledger")

    def _by_item(self, build: Callable[[DataFrame], DataFrame], hot: Callable[[], DataFrame], name: str) -> DataFrame:
        """A table of the ledger's items: in slices by ``build`` from view 1, the hot items by ``hot``."""
        whole = self.materialize != "table" or self._base(name) != self._scratch
        if self._hot and whole:
            rows = build(self._items(False))
            return self._cut(rows.unionByName(hot().select(*rows.columns)), name)
        with self._rows_stay():
            df = self._sliced(lambda part: build(self._items(False, part)), name)
        if not self._hot:
            return df
        return self._store(hot().select(*[F.col(f.name).cast(f.dataType) for f in df.schema]), name, "append")

    @functools.cached_property
    def v2_full(self) -> DataFrame:
        """View 2 plus internal columns (sequences, flags)."""
        if self.split == HOT and self._hot is not None:
            def rows(v1: DataFrame) -> DataFrame:
                v2, _, added = suppress.by_item(v1, self.t["bin_stock"], self.p)
                return v2.drop(*added)
            return self._by_item(rows, lambda: self._hot_v2, "suppressed_ledger_full")
        if self.split == HOT:
            laid = self._sliced(lambda part: suppress.ledger_layout(self.v1_full, self.p, lambda df: df, part), "demand_layout")
            return self._suppressed(laid)
        return self._suppressed(self.v1_full)

    def _suppressed(self, laid: DataFrame) -> DataFrame:
        return self._sliced(lambda part: suppress.suppressed_ledger_full(
            suppress.item_slice(laid, self.p, part), self.t["bin_stock"], self.p, split=bool(self.split), cut=self._step),
            "suppressed_ledger_full", "stocked_ledger")

    @functools.cached_property
    def v2(self) -> DataFrame:
        """Suppressed ledger (37 columns)."""
        return self.v2_full.select(*suppress.V2_COLUMNS)

    @functools.cached_property
    def v3(self) -> DataFrame:
        """Quarantine pipe (12 columns); feeds the supply timeline and PO timing."""
        return self._cut(quarantine.quarantine_pipe(self.t["lots"], self.t["item_master"], self.p),
                         "quarantine_pipe")

    def _extended(self, name: str, columns: list[str]) -> DataFrame:
        """View 4, or some of its columns, with hot items apart."""
        return self._by_item(
            lambda v1: overlay.extended_ledger_by_item(v1, self.t["bin_stock"], self.v3, self.p, columns),
            lambda: overlay.extended_ledger(self._hot_v2, self.v3, self.p, self._step).select(*columns), name)

    @functools.cached_property
    def v4(self) -> DataFrame:
        """Extended ledger (35 columns)."""
        if self.split == HOT and self._hot is not None:
            return self._extended("extended_ledger", overlay.V4_COLUMNS)
        return self._sliced(lambda part: overlay.extended_ledger(
            suppress.item_slice(self.v2_full, self.p, part), self.v3, self.p, self._step), "extended_ledger", "covered_ledger")

    @functools.cached_property
    def v5(self) -> DataFrame:
        """Supply action (45 columns)."""
        return self._sliced(lambda part: action.supply_action(suppress.item_slice(self.v4, self.p, part), self.v3, self.p),
                            "supply_action")

    @functools.cached_property
    def _decisions(self) -> DataFrame:
        return self._extended("decision_ledger", DECISION_COLUMNS)

    @property
    def decisions(self) -> DataFrame:
        """Every row of view 4 with the columns that views 6 and 7, the reports and the checks read
        (``DECISION_COLUMNS``): view 4 itself where the run has it or makes it anyway."""
        whole = "v4" in self.__dict__ or self.output_path or self.split != HOT or self._hot is None
        return self.v4 if whole else self._decisions

    @property
    def action_rows(self) -> DataFrame:
        """View 5 in all its rows, with ``DECISION_COLUMNS`` and the columns that it adds; not stored."""
        return action.actions(self.decisions, self.v3, self.p)

    @property
    def v5_rows(self) -> DataFrame:
        """Supply action over the stored view 4, not stored: for a single reader."""
        return action.supply_action(self.v4, self.v3, self.p)

    @functools.cached_property
    def deficits(self) -> DataFrame:
        """The deficit rows that views 6 and 7 share, from view 4."""
        return self._sliced(lambda part: risk.deficit_rows(suppress.item_slice(self.decisions, self.p, part), self.v3, self.p),
                            "deficit_rows")

    @functools.cached_property
    def risk_without_copies(self) -> DataFrame:
        """View 6 of the run with ``dedupe_timing``: every ledger row counts once.  Only
        the deficit rows and what follows differ, so the stored view 4 serves both."""
        once = dataclasses.replace(self.p, dedupe_timing=True)
        return risk.run_risk(risk.deficit_rows(self.decisions, self.v3, once), self.vs, once)

    @functools.cached_property
    def vs(self) -> DataFrame:
        """Safety stock (16 columns)."""
        t = self.t
        return self._cut(safety.safety_stock_calc(t["ss_items"], t["receipts"],
                                                  t["receipt_lines"], t["consumption"], self.p),
                         "safety_stock")

    def vs_first(self) -> "LedgerRun":
        """The run with its safety stock: the exchanges of receipts and consumption are large against
        their tables, so a run holds less disk if they come before the ledger's tables."""
        self.vs  # noqa: B018
        return self

    @functools.cached_property
    def v6(self) -> DataFrame:
        """Run risk (12 columns); feeds reports P1-P3 and check D2."""
        return self._cut(risk.run_risk(self.vs_first().deficits, self.vs, self.p), "run_risk")

    @functools.cached_property
    def _v7_rows(self) -> DataFrame:
        rows = buyer.buyer_control(self.vs_first().deficits, self.vs, self.decisions, self.t["receipt_lines"], self.p,
                                   sort=False, cut=lambda df: self._cut(df, "buyer_rows"))
        return self._cut(rows, "buyer_control")

    def v7(self, sort: bool = True) -> DataFrame:
        """Buyer control (22 columns), in presentation order unless ``sort=False``;
        feeds reports P4-P6 and checks D1-D2."""
        return buyer.buyer_sort(self._v7_rows, self.p) if sort else self._v7_rows

    def _project(self, df: DataFrame, name: str) -> None:
        """Write a projection of a stored table to ``output_path``, if there is one."""
        if self.output_path:
            df.write.mode("overwrite").parquet(f"{self.output_path}/{name}")

    @functools.cached_property
    def _v1_out(self) -> None:
        self._project(self.v1, "demand_ledger")

    @functools.cached_property
    def _v2_out(self) -> None:
        self._project(self.v2, "suppressed_ledger")

    # dependency waves: everything in a wave only needs earlier waves
    WAVES = (("v1_full", "v3", "vs"), ("v2_full", "_v1_out"), ("v4", "_v2_out"), ("deficits", "v5"), ("v6", "_v7_rows"))
    NEEDS = {"v1_full": (), "v3": (), "vs": (), "v2_full": ("v1_full",), "v4": ("v2_full", "v3"),
             "_v1_out": ("v1_full",), "_v2_out": ("v2_full",),
             "v5": ("v4", "v3"), "deficits": ("v4", "v3"), "v6": ("deficits", "vs"),
             "_v7_rows": ("deficits", "vs", "v4")}

    def materialize_all(self, workers: int = 3, only: str | None = None) -> "LedgerRun":
        """Build every output (or ``only`` one and what it needs), submitting
        independent ones as concurrent Spark jobs (stages of small outputs
        leave the cluster's cores idle otherwise).  With an ``output_path`` all eight
        outputs are there afterwards.  Each wave only needs the
        waves before it, so nothing is built twice."""
        want = set(self.NEEDS)
        if only is not None:
            want, todo = set(), [only]
            while todo:
                name = todo.pop()
                if name not in want:
                    want.add(name)
                    todo.extend(self.NEEDS[name])
        with ThreadPoolExecutor(max_workers=workers) as pool:
            for wave in self.WAVES:
                list(pool.map(lambda name: getattr(self, name), [n for n in wave if n in want]))
        return self

    def outputs(self) -> dict[str, DataFrame]:
        return {"demand_ledger": self.v1, "suppressed_ledger": self.v2,
                "quarantine_pipe": self.v3, "extended_ledger": self.v4,
                "supply_action": self.v5, "safety_stock": self.vs, "run_risk": self.v6,
                "buyer_control": self.v7()}
