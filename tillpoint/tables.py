"""A lazy name -> DataFrame mapping handed to every analysis."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame


class Tables(Mapping):
    """Retail tables by name. Each table is built on first use and then reused,
    so an analysis only plans the tables it touches."""

    def __init__(self, factories: Mapping[str, Callable[[], DataFrame]] | None = None, **frames: DataFrame):
        self._factories: dict[str, Callable[[], DataFrame]] = dict(factories or {})
        self._built: dict[str, DataFrame] = dict(frames)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            if name not in self._factories:
                raise KeyError(name)
            self._built[name] = self._factories[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(dict.fromkeys([*self._built, *self._factories]))

    def __len__(self) -> int:
        return len(set(self._built) | set(self._factories))

    def with_table(self, name: str, df: DataFrame) -> "Tables":
        out = Tables(self._factories, **self._built)
        out._built[name] = df
        return out
