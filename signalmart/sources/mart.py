"""The tables of a mart by name, each opened or built when first used."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame


class Mart(Mapping):
    """Read-only name -> DataFrame mapping over lazy builders."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    @classmethod
    def of(cls, **tables: DataFrame) -> Mart:
        return cls({}).with_tables(**tables)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def with_tables(self, **tables: DataFrame) -> Mart:
        """The same mart with some tables replaced or added."""
        replaced = {name: (lambda df=df: df) for name, df in tables.items()}
        kept = {name: (lambda name=name: self[name]) for name in self._builders}
        return Mart({**kept, **replaced})
