"""What a transform step is, and the catalogue of relations it works on."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

RESOLUTIONS = (8, 9, 10)


class Relations(Mapping[str, DataFrame]):
    """Relations by name; what exists decides which optional columns and layers a step makes."""

    def __init__(self, found: Mapping[str, DataFrame] | None = None):
        self._found = dict(found or {})

    def __getitem__(self, name: str) -> DataFrame:
        return self._found[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._found)

    def __len__(self) -> int:
        return len(self._found)

    def put(self, name: str, df: DataFrame, replace: bool = True) -> None:
        if replace or name not in self._found:
            self._found[name] = df


@dataclass(frozen=True)
class Step:
    """``build`` gives the outputs by name; ``outputs`` their names for what is at hand; ``inputs`` the extracts it reads."""

    name: str
    build: Callable[[Relations, tuple[int, ...]], dict[str, DataFrame]]
    outputs: Callable[[Relations, tuple[int, ...]], list[str]]
    depends_on: tuple[str, ...] = ()
    inputs: tuple[str, ...] = field(default=())
