"""Packs of fixed capacity along a space-filling curve.

Texts are hashed to word vectors, projected to a few dimensions and ordered by
Hilbert key over range partitions, so that neighbours in a pack are alike.
Each range is packed on its own with a short look-ahead: a pack starts with
the curve's next text and is filled with the largest of the nearby texts that
still fits.  What the ranges leave half full is packed again over ever larger
groups of neighbouring ranges.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from math import erf, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from .words import words_of

DIMENSIONS, LEVELS = 3, 8
#: Texts near the curve's front that may fill a pack.
LOOK_AHEAD = 192
#: Neighbouring ranges whose leftovers are packed together at a time.
GROUP = 16
#: An over-long text is cut at a blank within this last share of the capacity, else at the capacity.
CUT_SEARCH = 0.01

_places: dict[str, int] = {}
_table = np.zeros((1 << 10, DIMENSIONS))


def _places_of(words: list[str]) -> list[int]:
    """Rows of the words' hashed vectors in the worker's table, which is emptied when it gets large."""
    global _table
    if len(_places) > 500_000:
        _places.clear()
    for w in words:
        if w not in _places:
            n = len(_places)
            if n == len(_table):
                _table = np.concatenate([_table, np.zeros_like(_table)])
            raw = hashlib.blake2b(w.encode(), digest_size=2 * DIMENSIONS).digest()
            _table[n] = (np.frombuffer(raw, np.uint16) / 32767.5 - 1.0) * sqrt(3)
            _places[w] = n
    return [_places[w] for w in words]


def hilbert_key(point: list[int], levels: int = LEVELS) -> int:
    """Position on the Hilbert curve of a point with coordinates below 2**levels.

    Walks the levels from coarse to fine; ``start`` and ``axis`` describe the
    orientation of the current cell (entry corner and main direction).
    """
    n = len(point)
    mask = (1 << n) - 1
    key, start, axis = 0, 0, 0
    for level in range(levels - 1, -1, -1):
        corner = sum(((x >> level) & 1) << i for i, x in enumerate(point))
        turned = corner ^ start
        turned = ((turned >> (axis + 1)) | (turned << (n - axis - 1))) & mask
        step = turned
        shift = 1
        while shift < n:  # inverse Gray code
            step ^= step >> shift
            shift <<= 1
        key = (key << n) | step
        entry = 0 if step == 0 else ((step - 1) & ~1) ^ (((step - 1) & ~1) >> 1)
        entry = ((entry << (axis + 1)) | (entry >> (n - axis - 1))) & mask
        trailing = 0
        if step:
            odd = step if step & 1 else step - 1
            while odd & 1:
                trailing, odd = trailing + 1, odd >> 1
        start ^= entry
        axis = (axis + trailing + 1) % n
    return key


def curve_keys(texts: list[str]) -> list[int]:
    """Hilbert keys of the texts' projected word vectors."""
    sums = np.zeros((len(texts), DIMENSIONS))
    for n, text in enumerate(texts):
        words = words_of(text)
        if words:
            places = _places_of(words)
            sums[n] = _table[places].sum(0) / sqrt(len(words))
    cells = [[min((1 << LEVELS) - 1, int((1 << LEVELS) * 0.5 * (1 + erf(x / sqrt(2))))) for x in row] for row in sums.tolist()]
    return [hilbert_key(cell) for cell in cells]


def pieces(text: str, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the parts of a text, one unless it exceeds the capacity."""
    out, at = [], 0
    reach = max(1, int(capacity * CUT_SEARCH))
    while len(text) - at > capacity:
        end = at + capacity
        blank = max(text.rfind(" ", end - reach, end), text.rfind("\n", end - reach, end))
        end = blank + 1 if blank > at else end
        out.append((at, end - at))
        at = end
    out.append((at, len(text) - at))
    return out


class _Filler:
    """Packs a stream of (size, item): gives (items, used) of each closed pack."""

    def __init__(self, capacity: int, look_ahead: int):
        self.capacity, self.look_ahead = capacity, look_ahead
        self.waiting: list[tuple[int, int, object]] = []  # sorted by size
        self.by_number: dict[int, tuple[int, int, object]] = {}
        self.count = 0
        self.front = 0
        self.total = 0

    def push(self, size: int, item: object) -> list[tuple[list[object], int]]:
        """Takes an item in; closes packs while more waits than the look-ahead and a full pack's worth."""
        entry = (size, self.count, item)
        insort(self.waiting, entry, key=lambda x: x[:2])
        self.by_number[self.count] = entry
        self.count += 1
        self.total += size
        return [self.close()] if len(self.waiting) > self.look_ahead and self.total >= self.capacity else []

    def _take(self, place: int) -> tuple[int, int, object]:
        entry = self.waiting.pop(place)
        del self.by_number[entry[1]]
        self.total -= entry[0]
        return entry

    def close(self) -> tuple[list[object], int]:
        while self.front not in self.by_number:
            self.front += 1
        first = self.by_number[self.front]
        self._take(bisect_right(self.waiting, first[:2], key=lambda x: x[:2]) - 1)
        items, used = [first[2]], first[0]
        while self.waiting:
            place = bisect_right(self.waiting, self.capacity - used, key=lambda x: x[0]) - 1
            if place < 0:
                break
            entry = self._take(place)
            items.append(entry[2])
            used += entry[0]
        return items, used

    def rest(self) -> Iterator[tuple[list[object], int]]:
        while self.waiting:
            yield self.close()


_ITEM = "pack_kind string, capacity bigint, table_name string, rec_no bigint, piece_no int, start int, chars int, curve bigint, tie bigint"


def items_of(texts: DataFrame, limits: list[tuple[str, int]]) -> DataFrame:
    """Pieces of every non-empty text for each capacity, with curve key and an even tie-break.

    Lengths are in Unicode characters.  The tie-break spreads copies of one
    text, which share a key, over range partitions.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for name, rec, text, curve in zip(batch["table_name"], batch["rec_no"], batch["text"], curve_keys(batch["text"].to_list())):
                tie = int.from_bytes(hashlib.blake2b(f"{name}|{rec}".encode(), digest_size=8).digest(), "little", signed=True)
                for kind, capacity in limits:
                    out += [(kind, capacity, name, rec, n, a, size, curve, tie) for n, (a, size) in enumerate(pieces(text, capacity))]
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _ITEM.split(", ")])

    return texts.where("text is not null and text <> '' and rec_no is not null").select("table_name", "rec_no", "text").mapInPandas(run, _ITEM)


_PACKED = "pack_kind string, pack_id string, closed boolean, capacity bigint, table_name string, rec_no bigint, piece_no int, start int, chars int, curve bigint, tie bigint, part int"
_PACKED_NAMES = [c.split()[0] for c in _PACKED.split(", ")]


def _pack(label: str, look_ahead: int, keep_open: bool):
    """Packing of sorted rows; with ``keep_open`` what is left at the end of a range stays open."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fillers: dict[str, _Filler] = {}
        numbers: dict[str, int] = {}
        part = None

        def rows(kind: str, capacity: int, pack: tuple[list[tuple], int], closed: bool) -> list[tuple]:
            numbers[kind] = numbers.get(kind, 0) + 1
            name = f"{kind}-{label}{part}-{numbers[kind]}"
            return [(kind, name, closed, capacity, *item, part) for item in pack[0]]

        columns = ["table_name", "rec_no", "piece_no", "start", "chars", "curve", "tie"]
        for batch in batches:
            out = []
            for row in batch[["pack_kind", "capacity", "part", *columns]].itertuples(index=False, name=None):
                kind, capacity, part = row[:3]
                filler = fillers.setdefault(kind, _Filler(capacity, look_ahead))
                for pack in filler.push(row[7], row[3:]):
                    out += rows(kind, capacity, pack, True)
            yield pd.DataFrame(out, columns=_PACKED_NAMES)
        out = []
        for kind, filler in fillers.items():
            for pack in filler.rest():
                out += rows(kind, filler.capacity, pack, not keep_open)
        yield pd.DataFrame(out, columns=_PACKED_NAMES)

    return run


def pack(texts: DataFrame, limits: DataFrame, *, look_ahead: int = LOOK_AHEAD, scratch: Scratch | None = None) -> DataFrame:
    """Packs of every non-empty text for each capacity.

    ``texts``: ``table_name, rec_no, text`` (the first two identify a text);
    ``limits``: ``pack_kind, capacity_chars``.  Returns ``pack_kind, pack_id,
    table_name, rec_no, piece_no, start, chars``; a text within the capacity is
    one piece.  Null and empty texts are in no pack, repeated texts in one each,
    no texts or no limits give an empty result.
    """
    spark = texts.sparkSession
    scratch = scratch or Scratch(spark, "packing")
    kinds = [(r[0], int(r[1])) for r in limits.where("pack_kind is not null and capacity_chars > 0").select("pack_kind", "capacity_chars").distinct().orderBy("pack_kind").collect()]
    items = scratch.save(items_of(texts, kinds), "items")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = items.repartitionByRange(parts, "pack_kind", "curve", "tie").sortWithinPartitions("pack_kind", "curve", "tie").withColumn("part", F.spark_partition_id())
    first = scratch.save(ranged.mapInPandas(_pack("r", look_ahead, True), _PACKED), "first")
    # at most the look-ahead and one pack of each kind and range are left; a task takes those of a bounded number of ranges
    done, level = first.where("closed"), 0
    left = first.where("not closed")
    while True:
        level, parts = level + 1, -(-parts // GROUP)
        last = parts <= 1
        grouped = left.drop("pack_id", "closed").withColumn("part", F.floor(F.col("part") / GROUP).cast("int")).repartition(parts, "part").sortWithinPartitions("pack_kind", "curve", "tie")
        again = grouped.mapInPandas(_pack(f"l{level}-", 4 * look_ahead, not last), _PACKED)
        if last:
            break
        again = scratch.save(again, f"left{level}")
        done, left = done.unionByName(again.where("closed")), again.where("not closed")
    columns = ["pack_kind", "pack_id", "table_name", "rec_no", "piece_no", "start", "chars"]
    return done.select(*columns).unionByName(again.select(*columns))


def pack_report(packed: DataFrame, limits: DataFrame) -> DataFrame:
    """Packs, texts and unused share of each kind."""
    used = packed.groupBy("pack_kind").agg(F.count_distinct("pack_id").alias("packs"), F.count_distinct("table_name", "rec_no").alias("texts"), F.sum("chars").alias("chars"))
    return used.join(F.broadcast(limits), "pack_kind").select(
        "pack_kind", "packs", "texts", "chars", F.round(1 - F.col("chars") / (F.col("packs") * F.col("capacity_chars")), 5).alias("unused")
    )
