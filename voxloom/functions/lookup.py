"""A bounded table of strings inside an expression, found by hash.

A map literal is searched entry by entry. Here each key stands in one of the two slots that its
hashes name, so a look-up inside a row costs the same whatever the size of the table: no join, no
shuffle, no worker. The table is part of the plan, hence the bound.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LIMIT = 200_000
_END, _VACANT = "\n", "\0"   # stand in no key and no value


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value made once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), 0)


class InlineTable:
    """``rows`` has unique, non-null strings in ``key``; other columns are values, found by place."""

    def __init__(self, rows: DataFrame, key: str, values: Sequence[str] = (), limit: int = LIMIT):
        schema = rows.select(key, *values).schema
        found = rows.select(key, *values, *_hashes(F.col(key))).limit(limit + 1).collect()
        if len(found) > limit:
            raise ValueError(f"more than {limit} rows; join such a table instead")
        self.size = len(found)
        self.slots, places = _placed([(row["_first"], row["_second"]) for row in found])

        def spread(name: str, empty: str) -> Column:
            out = [empty] * self.slots
            for row, place in zip(found, places, strict=True):
                out[place] = str(row[name])
            # One foldable string: the optimizer makes it an array literal once per query.
            return F.split(F.lit(_END.join(out)), _END, -1)

        self._keys = spread(key, _VACANT)
        self._values = {}
        for v in values:
            kind = schema[v].dataType
            whole = spread(v, "" if isinstance(kind, T.StringType) else "0")
            self._values[v] = whole if isinstance(kind, T.StringType) else whole.cast(T.ArrayType(kind))

    def find(self, key: Column) -> Column:
        """Place of a key in the table, null if it is not there."""
        if not self.size:
            return F.lit(None).cast("int")
        first, second = (F.pmod(h, F.lit(self.slots)).cast("int") for h in _hashes(key))
        return F.when(F.get(self._keys, first) == key, first).when(F.get(self._keys, second) == key, second)

    def value(self, place: Column, name: str) -> Column:
        return F.get(self._values[name], place)


def _hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key).alias("_first"), F.hash(key).alias("_second")


def _placed(hashes: list[tuple[int, int]]) -> tuple[int, list[int]]:
    """(number of slots, a slot of its own for each key among the two of its hashes): cuckoo hashing."""
    slots = 1 << (2 * max(len(hashes), 1) - 1).bit_length()
    while True:
        held: dict[int, int] = {}
        for i in range(len(hashes)):
            at = hashes[i][0] % slots
            for _ in range(500):
                i, held[at] = held.get(at, -1), i
                if i < 0:
                    break
                one, two = (h % slots for h in hashes[i])
                at = two if at == one else one
            else:
                break
        else:
            place = {i: at for at, i in held.items()}
            return slots, [place[i] for i in range(len(hashes))]
        slots *= 2
