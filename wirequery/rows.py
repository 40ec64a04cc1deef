"""Result rows: a mapping by name that can be read by position and slice too."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from typing import Any

_TOTALS = "this record only parts the rows from the totals of a query WITH TOTALS"


class Record(Mapping):
    """A row. Iteration and length are over names; of equal names the last counts. An empty record marks totals."""

    __slots__ = ("_index", "_values")

    def __init__(self, index: dict[str, int], values: tuple = ()):
        self._index, self._values = index, values

    def __getitem__(self, key: str | int | slice) -> Any:
        if isinstance(key, str):
            if not self._values:
                raise KeyError(_TOTALS)
            if key not in self._index:
                raise KeyError(f"no field '{key}' in {list(self._index)}")
            return self._values[self._index[key]]
        if not self._values and not isinstance(key, slice):
            raise IndexError(_TOTALS)
        try:
            return self._values[key]
        except IndexError as e:
            raise IndexError(f"no field {key} in a row of {len(self._values)}") from e

    def get(self, key, default=None):
        try:
            return self[key]
        except (KeyError, IndexError):
            return default

    def __iter__(self) -> Iterator[str]:
        return iter(self._index if self._values else ())

    def __len__(self) -> int:
        return len(self._index) if self._values else 0

    def values(self):
        return list(self._values)

    def __repr__(self) -> str:
        return f"Record({dict(self)})"
