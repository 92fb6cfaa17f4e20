"""Catalog: the named DataFrames every operator reads."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from .schemas import TABLES
from .sources.projections import PROJECTIONS


class Catalog(Mapping[str, DataFrame]):
    """Immutable mapping ``table name -> DataFrame``.

    Operators never mutate a catalog; write and delete jobs return a new one
    (``replace``), which a caller may persist with ``sources.files.save_catalog``.
    """

    def __init__(
        self,
        tables: Mapping[str, DataFrame | Callable[[], DataFrame]],
        sources: Mapping[str, DataFrame] | None = None,
        projections: Mapping[str, DataFrame | Callable[[], DataFrame]] | None = None,
        gram_counts: Mapping[str, DataFrame | Callable[[], DataFrame]] | None = None,
        as_of: int = 0,
    ):
        # A callable opens its table when it is first asked for.
        self._tables = dict(tables)
        # Raw feeds the catalog was derived from (e.g. an event log); write
        # jobs read their request batches from here.
        self._sources = dict(sources or {})
        # Tables stored once more in another order (sources.projections), and
        # the number of rows per trigram of those for searches.
        self._projections = dict(projections or {})
        self._gram_counts = dict(gram_counts or {})
        # Commit number of the stored catalog this one was read from.
        self.as_of = as_of

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            raise KeyError(f"catalog has no table {name!r}")
        return _opened(self._tables, name)

    def __iter__(self) -> Iterator[str]:
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._tables:
            raise AttributeError(name)
        return self[name]

    @property
    def spark(self) -> SparkSession:
        return self[next(iter(self._tables))].sparkSession

    def replace(self, **tables: DataFrame) -> Catalog:
        unknown = set(tables) - set(TABLES) - set(self._tables)
        if unknown:
            raise KeyError(f"unknown tables {sorted(unknown)}")
        merged = dict(self._tables)
        merged.update(tables)
        # A projection of a replaced table no longer shows its rows.
        kept = {n: df for n, df in self._projections.items() if PROJECTIONS[n].table not in tables}
        return Catalog(merged, self._sources, kept, self._gram_counts, self.as_of)

    def source(self, name: str) -> DataFrame:
        try:
            return self._sources[name]
        except KeyError:
            raise KeyError(f"catalog has no source {name!r}") from None

    def with_sources(self, sources: Mapping[str, DataFrame]) -> Catalog:
        merged = dict(self._sources)
        merged.update(sources)
        return Catalog(self._tables, merged, self._projections, self._gram_counts, self.as_of)

    def projection(self, name: str) -> DataFrame | None:
        """A second copy of a table in another order, if the catalog has it."""
        return _opened(self._projections, name) if name in self._projections else None

    def gram_counts(self, name: str) -> DataFrame | None:
        """(gram, n) of a search projection, if stored."""
        return _opened(self._gram_counts, name) if name in self._gram_counts else None

    def with_projections(self, *names: str) -> Catalog:
        """Add projections built from this catalog's tables (lazily, not stored)."""
        built = {n: PROJECTIONS[n].build(self[PROJECTIONS[n].table]) for n in names}
        return Catalog(self._tables, self._sources, self._projections | built, self._gram_counts, self.as_of)

    def register_views(self, prefix: str = "") -> None:
        """Expose every table as a temp view (``prefix + name``) for ``spark.sql``."""
        for name, df in self.items():
            df.createOrReplaceTempView(prefix + name)


def _opened(frames: dict, name: str) -> DataFrame:
    if callable(frames[name]):
        frames[name] = frames[name]()
    return frames[name]
