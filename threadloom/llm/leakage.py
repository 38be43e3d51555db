"""Evaluation passages in a corpus, by a prefix-filtered set join.

The held-out items are few and fixed; they are a stated query set that goes to
the executors in blocks of bounded size and is joined with every document where
it lies, so no document is shuffled.  A window of an item is a set of word
shingles.  Shingles are ordered by rarity in the whole corpus, and only those
needed are joined: if at most E of a window's S shingles may be lost, one of
its E + 1 rarest must occur (the prefix).  Each hit gives an item and a shift
between both texts; a positional bound then asks for the shingles that must
survive, all within one window near that shift.  What is left is verified
exactly over item-sized windows.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from .words import words_of

SHINGLE = 3
WINDOW, ERRORS = 18, 0.1
#: Items looked up at once; more are done block by block.
BLOCK_ITEMS = 20_000
#: How far a match may drift from its diagonal (dropped or added words), and how far within one window (three dropped and three added words).
BAND, DRIFT = 6, 6

_MARKUP = re.compile(r"<[^<>\n]*>|\]\([^()\s]*\)|&(?:#\d+|#x[0-9a-f]+|[a-z]+);|https?://\S+|\\[a-z]+\*?(?=\{)", re.I)


def plain_words(text: str | None) -> list[str]:
    """Words without case, punctuation, blanks, line breaks and markup; hyphens at line ends join."""
    if not text:
        return []
    text = re.sub(r"(?<=\w)[-‐]\s*\n\s*(?=\w)|­", "", text) if "-\n" in text or "­" in text else text
    if "<" in text or "&" in text or "](" in text or "\\" in text or "http" in text:
        text = _MARKUP.sub(" ", text)
    if "_" in text or "*" in text:
        text = text.replace("*", "").replace("_", " ")
    return words_of(text.replace("’", "").replace("'", ""))


def _shingles(words: list[str]) -> zip:
    return zip(*[words[k:] for k in range(SHINGLE)])


def aligned(doc: list[str], item: list[str], shift: int, band: int = BAND) -> tuple[list[bool], list[int]]:
    """Which item words are matched when item word q lies near doc word q + shift; and doc words added before each.

    Edit distance inside the band: replaced, dropped and added words cost one.
    """
    m, width = len(item), 2 * band + 1
    inf = 1 << 30
    cost = [[inf] * width for _ in range(m + 1)]
    move = [[""] * width for _ in range(m + 1)]
    for k in range(width):
        cost[0][k] = 0  # the match may begin anywhere in the band
    for q in range(1, m + 1):
        row, above = cost[q], cost[q - 1]
        for k in range(width):
            p = q - 1 + shift + k - band  # doc word beside item word q - 1
            best, how = inf, ""
            if 0 <= p < len(doc):
                c = above[k] + (doc[p] != item[q - 1])
                if c < best:
                    best, how = c, "m" if doc[p] == item[q - 1] else "s"
            else:
                c = above[k] + 1
                if c < best:
                    best, how = c, "s"
            if k + 1 < width and above[k + 1] + 1 < best:
                best, how = above[k + 1] + 1, "d"
            if k and row[k - 1] + 1 < best:
                best, how = row[k - 1] + 1, "i"
            row[k], move[q][k] = best, how
    k = min(range(width), key=lambda x: cost[m][x])
    matched, added = [False] * m, [0] * m
    q = m
    while q:
        how = move[q][k]
        if how == "i":
            if q < m:
                added[q] += 1
            k -= 1
            continue
        matched[q - 1] = how == "m"
        q -= 1
        if how == "d":
            k += 1
    return matched, added


def longest_stretch(matched: list[bool], added: list[int], window: int = WINDOW, errors: float = ERRORS) -> int:
    """Most item words in a stretch with at most that share replaced or dropped; 0 below ``window``."""
    lost, extra = [0], [0]
    for ok, more in zip(matched, added):
        lost.append(lost[-1] + (not ok))
        extra.append(extra[-1] + more)
    best = 0
    for a in range(len(matched)):
        if not matched[a]:
            continue
        for b in range(len(matched), a + max(window, best) - 1, -1):
            n = b - a
            if matched[b - 1] and lost[b] - lost[a] <= errors * n + 1e-9 and extra[b] - extra[a + 1] <= errors * n + 1e-9:
                best = max(best, n)
                break
    return best


def surviving(window: int, errors: float) -> int:
    """Shingles of a window that surely survive, errors at a cluster's edge included."""
    return max(1, window - SHINGLE + 1 - SHINGLE * (int(window * errors) + 2))


def _near(at: dict[object, list[int]], own: list[object], shift: int, size: int, least: int) -> bool:
    """Whether some ``size`` neighbouring shingles of an item have ``least`` near their place in the document."""
    places = [q for q, s in enumerate(own) if s in at and any(abs(p - q - shift) <= DRIFT for p in at[s])]
    return any(places[k + least - 1] - places[k] < size for k in range(len(places) - least + 1))


def _longest(doc: list[str], at: dict[object, list[int]], item: list[str], own: list[object], shifts: set[int], window: int, errors: float) -> int:
    """Length of the longest stretch of the item near one of the shifts, 0 if there is none of ``window`` words."""
    best, done = 0, []
    for shift in sorted(shifts):
        if any(abs(shift - d) <= 1 for d in done) or not _near(at, own, shift, window - SHINGLE + 1, surviving(window, errors)):
            continue
        done.append(shift)
        best = max(best, longest_stretch(*aligned(doc, item, shift), window, errors))
        if best == len(item):
            break
    return best


def held(doc: list[str], item: list[str], window: int = WINDOW, errors: float = ERRORS) -> int:
    """Length of the longest stretch of the item in the document, 0 if there is none of ``window`` words."""
    if len(item) < window or len(doc) < window * (1 - errors) - 1:
        return 0
    at = defaultdict(list)
    for p, s in enumerate(_shingles(doc)):
        at[s].append(p)
    own = list(_shingles(item))
    return _longest(doc, at, item, own, {p - q for q, s in enumerate(own) for p in at.get(s, ())}, window, errors)


class _Items:
    """A block of items with its shingles; bounded by ``BLOCK_ITEMS``."""

    def __init__(self, rows: list[tuple[int, str]], window: int, errors: float):
        self.window, self.errors = window, errors
        self.words = {i: w for i, t in rows if len(w := plain_words(t)) >= window}
        self.codes: dict[tuple[str, ...], int] = {}
        self.own = {i: [self.codes.setdefault(s, len(self.codes)) for s in _shingles(w)] for i, w in self.words.items()}
        self.prefix: dict[int, list[tuple[int, int]]] = {}

    def order(self, frequency: dict[int, int]) -> None:
        """Keep of each window's shingles those needed, by corpus rarity, with the items and places they stand for."""
        size = self.window - SHINGLE + 1
        length = size - surviving(self.window, self.errors) + 1
        out: dict[int, set[tuple[int, int]]] = defaultdict(set)
        for i, codes in self.own.items():
            for a in range(max(1, len(codes) - size + 1)):
                part = sorted(range(a, min(a + size, len(codes))), key=lambda q: (frequency.get(codes[q], 0), codes[q], q))
                for q in part[:length]:
                    if codes[q] in frequency:
                        out[codes[q]].add((i, q))
        self.prefix = {c: sorted(s) for c, s in out.items()}

    def found_in(self, doc: list[str]) -> list[tuple[int, int]]:
        """(item, longest stretch) of the items the document holds."""
        if len(doc) < self.window * (1 - self.errors) - 1:
            return []
        at: dict[int, list[int]] = defaultdict(list)
        shifts: dict[int, set[int]] = defaultdict(set)
        code_of, prefix = self.codes.get, self.prefix
        for p, s in enumerate(_shingles(doc)):
            c = code_of(s)
            if c is not None:
                at[c].append(p)
                for i, q in prefix.get(c, ()):
                    shifts[i].add(p - q)
        return [(i, n) for i, near in shifts.items() if (n := _longest(doc, at, self.words[i], self.own[i], near, self.window, self.errors))]


def leaked_items(documents: DataFrame, items: DataFrame, *, window: int = WINDOW, errors: float = ERRORS, block_items: int = BLOCK_ITEMS, scratch: Scratch | None = None) -> DataFrame:
    """``doc_id, item_id, words``: items of which a document holds a stretch, and its length.

    ``documents``: ``doc_id, text``; ``items``: ``item_id, text``.  Null and
    empty texts hold nothing, items shorter than ``window`` cannot be held;
    repeated rows give one row each.  The driver holds one block of items at a
    time; documents are read twice for each block and never shuffled.
    """
    spark = documents.sparkSession
    scratch = scratch or Scratch(spark, "leakage")
    known = items.where("item_id is not null and text is not null").select("item_id", "text").distinct()
    blocks = max(1, -(-known.count() // block_items))
    docs = documents.where("text is not null and doc_id is not null").select("doc_id", "text")
    found = spark.createDataFrame([], "doc_id bigint, item_id bigint, words int")
    for k in range(blocks):
        rows = known.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).collect()
        block = _Items(sorted((r["item_id"], r["text"]) for r in rows), window, errors)
        part = _joined(docs, block)
        found = found.unionByName(part if blocks == 1 else scratch.save(part, f"found{k}"))
    return found.groupBy("doc_id", "item_id").agg(F.max("words").alias("words"))


def _joined(docs: DataFrame, block: _Items) -> DataFrame:
    context = docs.sparkSession.sparkContext
    codes = context.broadcast(block.codes)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code_of, n = codes.value.get, Counter()
        for batch in batches:
            for text in batch["text"]:
                n.update({c for s in _shingles(plain_words(text)) if (c := code_of(s)) is not None})
        yield pd.DataFrame({"code": list(n), "n": list(n.values())}).astype("int64")

    # documents of each shingle of the items in the whole corpus: as many rows as the block has shingles at most
    counted = docs.select("text").mapInPandas(count, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n"))
    block.order({r["code"]: r["n"] for r in counted.collect()})
    shared = context.broadcast(block)

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items = shared.value
        for batch in batches:
            out = [(doc, i, n) for doc, text in zip(batch["doc_id"], batch["text"]) for i, n in items.found_in(plain_words(text))]
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "words"]).astype({"doc_id": "int64", "item_id": "int64", "words": "int32"})

    return docs.mapInPandas(join, "doc_id bigint, item_id bigint, words int")
