"""Names to DataFrames, and DataFrames to stored tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from copy import copy
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession, functions as F

from carrymark.functions.dates import AsOf
from carrymark.operators.reporting import SnapshotPolicy
from carrymark.sources.layout import store, store_view
from carrymark.sources.schemas import INPUTS, SEEDS, input_schema
from carrymark.sources.seeds import read_seed

if TYPE_CHECKING:
    from carrymark.plans.core import Projection

InputReader = Callable[[str], DataFrame]
#: Where inputs are stored that a permanent view needs and that have no place yet.
INPUT_DATABASE = "curated"


def _with_seeds(spark: SparkSession, read: InputReader, folder: str | None) -> InputReader:
    return lambda name: (read_seed(spark, name, f"{folder}/{name}.csv")
                         if folder and name in SEEDS else read(name))


class Catalog:
    """Resolves input relations, models and marts by name.

    ``inputs`` is a mapping or a function from input name to DataFrame. Every
    input is narrowed to its declared columns and types. ``as_of`` is the
    valuation date of all marts; ``None`` means today. ``policy`` picks one fund
    or instrument snapshot where several report the same period; by default
    every snapshot counts.
    """

    def __init__(self, spark: SparkSession, inputs: Mapping[str, DataFrame] | InputReader,
                 *, as_of: AsOf = None, policy: SnapshotPolicy | None = None):
        self.spark = spark
        self.as_of = as_of
        self.policy = policy
        self._read: InputReader = inputs.__getitem__ if isinstance(inputs, Mapping) else inputs
        self._resolved: dict[str, DataFrame] = {}
        # What SQL reads an input from, where it is stored.
        self._places: dict[str, str] = {}
        self.stored: set[str] = set()
        self.given: set[str] = set()

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str, *, seeds: str | None = None,
                     **settings) -> Catalog:
        """Inputs stored as ``<root>/<input name>`` parquet directories.

        ``seeds`` is the folder of the seeds' CSV files, if they come as such.
        """
        catalog = cls(spark, _with_seeds(
            spark, lambda name: spark.read.parquet(f"{root}/{name}"), seeds), **settings)
        return catalog._placed(lambda name: f"parquet.`{root}/{name}`", seeds)

    @classmethod
    def from_database(cls, spark: SparkSession, database: str, *, seeds: str | None = None,
                      **settings) -> Catalog:
        """Inputs stored as metastore tables of one database; ``seeds`` as above."""
        catalog = cls(spark, _with_seeds(
            spark, lambda name: spark.table(f"{database}.{name}"), seeds), **settings)
        return catalog._placed(lambda name: f"`{database}`.`{name}`", seeds)

    def _placed(self, place: Callable[[str], str], seeds: str | None) -> Catalog:
        self._places = {n: place(n) for n in INPUTS if not (seeds and n in SEEDS)}
        return self

    def table(self, name: str, *, ordered: bool = False) -> DataFrame:
        """A relation by name; marts have no row order unless ``ordered``.

        ``ordered`` sorts by the columns that the registry declares, nulls last.
        """
        if name not in self._resolved:
            self._resolved[name] = self.input(name) if name in INPUTS else self._model(name)
        return self._in_order(name) if ordered else self._resolved[name]

    def _in_order(self, name: str) -> DataFrame:
        from carrymark.plans.registry import TABLES

        order = TABLES[name].order if name in TABLES else ()
        if not order:
            raise ValueError(f"no order is declared for {name}")
        return self._resolved[name].orderBy(*[F.col(c).asc_nulls_last() for c in order])

    def replace(self, name: str, df: DataFrame) -> Catalog:
        """Use ``df`` for ``name`` from now on, e.g. a stored copy of a mart.

        What was built from ``name`` before is built anew when it is next asked for.
        """
        self._resolved = {n: kept for n, kept in self._resolved.items() if n in self.given}
        self._resolved[name] = df
        self._places.pop(name, None)
        self.given.add(name)
        return self

    def copy(self) -> Catalog:
        """A catalog of the same tables; what is replaced in one stays in the other."""
        other = copy(self)
        other._resolved, other._places = dict(self._resolved), dict(self._places)
        other.stored, other.given = set(self.stored), set(self.given)
        return other

    def use_stored(self, *names: str, database: str | None = None) -> Catalog:
        """Read the tables that ``save`` left, in an earlier session perhaps.

        Without names, every table that is there; a named one must be.
        """
        from carrymark.plans.registry import TABLES

        for name in names or TABLES:
            place = f"`{database or TABLES[name].namespace}`.`{name}`"
            if names or self.spark.catalog.tableExists(place):
                self.replace(name, self.spark.table(place))
                self.stored.add(name)
        return self

    def preferred(self, snapshots: DataFrame, entity: str, row_id: str) -> DataFrame:
        """The snapshots that count under the catalog's policy."""
        return self.policy.choose(snapshots, entity, row_id) if self.policy else snapshots

    def input(self, name: str) -> DataFrame:
        """An input relation as delivered, narrowed to its declared columns."""
        source, declared = self._read(name), input_schema(name)
        delivered = {f.name: f.dataType for f in source.schema.fields}
        return source.select(*[
            f"`{f.name}`" if delivered.get(f.name) == f.dataType
            else F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in declared.fields
        ])

    def _model(self, name: str) -> DataFrame:
        from carrymark.plans.registry import TABLES

        if name not in TABLES:
            raise KeyError(f"unknown table {name!r}")
        return TABLES[name].build(self)

    def register_views(self, *names: str) -> None:
        """Expose tables as temporary views, so SQL can query them by name."""
        from carrymark.plans.registry import TABLES

        for name in names or TABLES:
            self.table(name).createOrReplaceTempView(name)

    def save(self, name: str, *, buckets: int | None = None, partition_by: Sequence[str] = (),
             database: str | None = None) -> DataFrame:
        """Materialize one table the way its spec says and read it from there on.

        Tables go to ``<namespace>.<name>``. Views become permanent views of that
        name over the stored input: they have no layout and no rows of their own, and
        every session of the metastore reads them. An input that is stored nowhere yet
        goes to the database ``curated`` first. Inlined helpers stay plans. ``buckets`` asks for
        bucketing by the key the table is joined on, so that later joins need no shuffle.
        ``partition_by`` lets filters on those columns, such as the period, skip whole
        folders.
        """
        from carrymark.plans.registry import TABLES

        spec = TABLES[name]
        if spec.stored_as != "table" and (buckets or partition_by):
            raise ValueError(f"{name} is not stored as a table, so it has no layout")
        if spec.stored_as == "view":
            query = self._view_query(spec.build)
            self.replace(name, store_view(self.spark, query, database or spec.namespace, name))
            self.stored.add(name)
        elif spec.stored_as == "table":
            self.replace(name, store(spec.build(self), database or spec.namespace, name,
                                     buckets=buckets, partition_by=partition_by))
            self.stored.add(name)
        return self.table(name)

    def _view_query(self, projection: Projection) -> str:
        """The SQL of a model that is a projection of one stored input."""
        source = projection.source
        if source not in self._places:
            self.save_inputs(source, database=INPUT_DATABASE)
        place = self._places[source]
        delivered = self.spark.sql(f"select * from {place}").schema
        kinds = {f.name: f.dataType for f in delivered.fields}
        columns = {f.name: f"`{f.name}`" if kinds.get(f.name) == f.dataType
                   else f"cast(`{f.name}` as {f.dataType.simpleString()})"
                   for f in input_schema(source).fields}
        return projection.sql(place, columns)

    def save_all(self, *names: str, buckets: int | None = None) -> None:
        """Materialize tables in dependency order, so marts read stored tables."""
        from carrymark.plans.registry import TABLES

        wanted = set(names or TABLES)
        for name in (n for n in TABLES if n in wanted):
            self.save(name, buckets=buckets if TABLES[name].stored_as == "table" else None)

    def save_inputs(self, *names: str, database: str, buckets: int | None = None,
                    partition_by: Mapping[str, Sequence[str]] | None = None) -> None:
        """Store input relations, bucketed alike, and read them from there on.

        ``partition_by`` names columns for some of the relations, the period for
        instance.

        ``Catalog.from_database`` opens them again in another session.
        """
        for name in names or INPUTS:
            df = self._resolved[name] if name in self.given else self.input(name)
            self.replace(name, store(df, database, name, buckets=buckets,
                                     partition_by=(partition_by or {}).get(name, ())))
            self._places[name] = f"`{database}`.`{name}`"
