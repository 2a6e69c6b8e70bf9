"""Where the ERP's relations come from: a name-to-DataFrame catalog filled on first use."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


class Catalog(Mapping[str, DataFrame]):
    """Source relations by name. A relation is opened when it is first asked for."""

    def __init__(self, loaders: Mapping[str, Callable[[], DataFrame]]):
        self._loaders = dict(loaders)
        self._opened: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self._loaders[name]()
        return self._opened[name]

    def __contains__(self, name: object) -> bool:
        return name in self._loaders

    def __iter__(self) -> Iterator[str]:
        return iter(self._loaders)

    def __len__(self) -> int:
        return len(self._loaders)

    def first_of(self, *names: str) -> DataFrame:
        """The first relation of ``names`` that the source has."""
        for name in names:
            if name in self:
                return self[name]
        raise KeyError(f"source has none of {names}")

    def has_column(self, relation: str, column: str) -> bool:
        return relation in self and column in self[relation].columns

    def without(self, relations: Iterable[str] = (), columns: Mapping[str, Iterable[str]] = {}) -> Catalog:
        """The catalog of a source that lacks the given relations and columns."""
        gone = set(relations)
        loaders = {name: loader for name, loader in self._loaders.items() if name not in gone}
        for name, cols in columns.items():
            if name in loaders:
                loaders[name] = lambda name=name, cols=tuple(cols): self[name].drop(*cols)
        return Catalog(loaders)

    def replacing(self, **relations: DataFrame) -> Catalog:
        """The catalog with some relations given as DataFrames."""
        return Catalog(self._loaders | {name: (lambda df=df: df) for name, df in relations.items()})


def utc(spark: SparkSession) -> SparkSession:
    """Source timestamps carry no zone and mean UTC, so the session must read them as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def parquet_catalog(spark: SparkSession, root: str, names: Iterable[str]) -> Catalog:
    """Relations stored as ``<root>/<name>`` Parquet, on any Hadoop file system."""
    utc(spark)
    return Catalog({n: (lambda n=n: spark.read.parquet(f"{root}/{n}")) for n in names})


FETCH_ROWS = "10000"


def jdbc_catalog(
    spark: SparkSession,
    url: str,
    names: Iterable[str],
    partitions: int,
    key_ranges: Mapping[str, tuple[int, int]] | None = None,
    schema: str = "public",
    **options: str,
) -> Catalog:
    """Relations read over JDBC, those with an ``id`` in parallel slices of it.

    The first and last id are asked of the database, unless ``key_ranges`` has them. An empty relation, or one
    without ``id``, such as a link table, is read in one slice.
    """
    utc(spark)

    def loader(name: str) -> Callable[[], DataFrame]:
        def load() -> DataFrame:
            table = f"{schema}.{name}"
            common = {"url": url, "fetchsize": FETCH_ROWS} | options
            reader = spark.read.format("jdbc").options(**common, dbtable=table)
            span = (key_ranges or {}).get(name)
            if span is None and "id" in (whole := reader.load()).columns:
                ends = spark.read.format("jdbc").options(**common, query=f"SELECT min(id) AS low, max(id) AS high FROM {table}")
                span = tuple(ends.load().first())
            if span is None or span[0] is None:
                return whole
            low, high = span
            return reader.options(
                partitionColumn="id", lowerBound=low, upperBound=high + 1, numPartitions=partitions
            ).load()

        return load

    return Catalog({n: loader(n) for n in names})


def view_catalog(spark: SparkSession, names: Iterable[str]) -> Catalog:
    """Relations that are already tables or views of the session."""
    utc(spark)
    return Catalog({n: (lambda n=n: spark.table(n)) for n in names})


@dataclass(frozen=True)
class Erp:
    """A source to export from: its relations, its version (``"18"`` or ``"19"``), languages and installed modules.

    Without ``modules`` they are not looked at; ``operators.profile.modules`` reads them.
    """

    tables: Catalog
    variant: str = "19"
    languages: tuple[str, ...] = ("en_US",)
    price_key: str | None = None
    modules: tuple[str, ...] | None = None

    def __post_init__(self) -> None:
        if self.variant not in ("18", "19"):
            raise ValueError(f"unsupported source version {self.variant!r}")

    def __getitem__(self, relation: str) -> DataFrame:
        return self.tables[relation]

    def lang(self, n: int) -> str | None:
        """The n-th active language; the first falls back to ``en_US``."""
        if n <= len(self.languages):
            return self.languages[n - 1]
        return "en_US" if n == 1 else None
