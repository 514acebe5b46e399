"""Benchmark leaks in texts: pieces of test items found exactly, then verified by edit distance.

An occurrence with at most k edits leaves at least one of k + 1 pieces of the item untouched, so a
search for the pieces misses none. Each hit fixes where the item would lie; Myers' bit-parallel
distance decides.
"""

from __future__ import annotations

import itertools
import math
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import reduce

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.tables import ddl, exact, restored, settled

#: Edits allowed, as a share of an item's characters.
MAX_ERROR = 0.05
#: UTF-8 bytes of items that one search holds; a larger benchmark is searched block by block.
BLOCK_BYTES = 16 << 20
KIND = "array<struct<item_id:bigint,edits:int,start:int,end:int>>"


def normalise(text: str) -> str:
    """Lower case, and one space for each run of white space."""
    return " ".join(text.lower().split())


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` pieces of nearly equal length that make up the item, with their places."""
    n, k = len(item), errors + 1
    cuts = [n * i // k for i in range(k + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Pattern:
    """An item prepared for Myers' bit-parallel search."""

    def __init__(self, item: str) -> None:
        self.length = len(item)
        self.bits: dict[str, int] = {}
        for i, c in enumerate(item):
            self.bits[c] = self.bits.get(c, 0) | 1 << i

    def best_end(self, text: str) -> tuple[int, int]:
        """Least edits of the item against any substring of ``text``, and where the first such ends."""
        m = self.length
        full, high = (1 << m) - 1, 1 << (m - 1)
        up, down, score = full, 0, m
        best, end = m, 0
        get = self.bits.get
        for i, c in enumerate(text):
            eq = get(c, 0)
            x = eq | down
            diagonal = (((x & up) + up) ^ up) | x
            rise = down | (full & ~(diagonal | up))
            fall = up & diagonal
            if rise & high:
                score += 1
            elif fall & high:
                score -= 1
            rise = (rise << 1) & full
            up = ((fall << 1) & full) | (full & ~(x | rise))
            down = rise & x
            if score < best:
                best, end = score, i + 1
        return best, end


def within_word(a: str, b: str) -> bool:
    """Whether two neighbouring characters belong to one word. Scripts from Thai to Myanmar, Khmer, and
    all from the Chinese radicals on (kana, ideographs, Hangul, whose particles follow directly) set
    no blanks at the ends of words, so there no two characters do."""

    def spaced(c: str) -> bool:
        n = ord(c)
        return c.isalnum() and not (0x0E00 <= n < 0x10A0 or 0x1780 <= n < 0x1800 or 0x2E80 <= n < 0xD800 or 0xF900 <= n < 0xFB00 or n >= 0x20000)

    return spaced(a) and spaced(b)


class LeakSearch:
    """Finds items of one block in texts."""

    def __init__(self, items: list[tuple[int, str]], max_error: float) -> None:
        self.items: dict[int, tuple[str, int]] = {}
        self.patterns: dict[tuple[int, bool], Pattern] = {}
        self.automaton = ahocorasick.Automaton()
        where: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for key, text in items:
            item = normalise(text)
            errors = math.floor(len(item) * max_error)
            self.items[key] = (item, errors)
            for at, piece in pieces(item, errors):
                where[piece].append((key, at))
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        if where:
            self.automaton.make_automaton()
        self.empty = not where

    def pattern(self, key: int, backwards: bool) -> Pattern:
        if (key, backwards) not in self.patterns:
            item = self.items[key][0]
            self.patterns[key, backwards] = Pattern(item[::-1] if backwards else item)
        return self.patterns[key, backwards]

    def __call__(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item, edits, start, end) of the best occurrence of each leaked item, by item; places
        are in the normalised text."""
        if self.empty or not text:
            return []
        text = normalise(text)
        starts: dict[int, set[int]] = defaultdict(set)
        for last, (size, places) in self.automaton.iter(text):
            for key, at in places:
                begin = last - size + 1 - at
                if self.items[key][1]:
                    starts[key].add(begin)
                elif key not in starts and not (
                    begin and within_word(text[begin - 1], text[begin]) or last + 1 < len(text) and within_word(text[last], text[last + 1])
                ):  # without errors the first hit is the best
                    starts[key].add(begin)
        found = []
        for key, begins in sorted(starts.items()):
            item, errors = self.items[key]
            m, best = len(item), None
            for low, high in self.runs(sorted(begins), errors):
                if text[max(low, 0) : max(low, 0) + m] == item:
                    occurrence = (0, max(low, 0), max(low, 0) + m)
                else:
                    a, b = max(low - errors, 0), min(high + m + errors, len(text))
                    edits, end = self.pattern(key, False).best_end(text[a:b])
                    if edits > errors:
                        continue
                    back, size = self.pattern(key, True).best_end(text[a : a + end][::-1])
                    occurrence = (back, a + end - size, a + end)
                if best is None or occurrence < best:
                    best = occurrence
            if best:
                found.append((key, *best))
        return found

    @staticmethod
    def runs(begins: list[int], errors: int) -> Iterator[tuple[int, int]]:
        """Neighbouring supposed starts, which one search covers."""
        low = high = begins[0]
        for b in begins[1:]:
            if b - high > errors:
                yield low, high
                low = b
            high = b
        yield low, high


#: The searches of the block that this worker process meets now, by the block's name.
_SEARCHES: dict[str, list[LeakSearch]] = {}


def searches_of(name: str, items: list[tuple[int, str]], max_error: float) -> list[LeakSearch]:
    """Searches of a block, made once for each worker; texts that share an id go to different ones."""
    if name not in _SEARCHES:
        _SEARCHES.clear()
        made, rest = [], items
        while rest:
            now, later, seen = [], [], set()
            for item in rest:
                (later if item[0] in seen else now).append(item)
                seen.add(item[0])
            made.append(LeakSearch(now, max_error))
            rest = later
        _SEARCHES[name] = made
    return _SEARCHES[name]


def best_leaks(searches: list[LeakSearch], text: str | None) -> list[dict]:
    """The best occurrence of each item in a text, by item."""
    best: dict[int, tuple[int, int, int]] = {}
    for search in searches:
        for key, *occurrence in search(text):
            best[key] = min(best.get(key, tuple(occurrence)), tuple(occurrence))
    return [{"item_id": k, "edits": e, "start": a, "end": b} for k, (e, a, b) in sorted(best.items())]


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """The distinct items, in parts of about ``block_bytes`` bytes, one part at a time."""
    items = benchmark.where(F.col(item_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(item_col).cast("long").alias("item"), F.col(text_col).alias("text")
    )
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(total / block_bytes))
    for i in range(parts):
        # ids of one text may repeat, so the text takes part in the deal
        block = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == i) if parts > 1 else items
        rows = sorted({(r["item"], r["text"]) for r in block.collect() if normalise(r["text"])})
        if rows:
            yield rows


def mark_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    max_error: float = MAX_ERROR,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``documents`` with ``leaks``: for each benchmark item found in a whole text (item_id, edits,
    start, end), by item.

    Texts and items are compared in lower case with white space collapsed; ``edits`` is the least
    Levenshtein distance of the item to any part of the text, at most ``max_error`` of the item's
    characters, so items of fewer than ``1 / max_error`` characters are found verbatim only, and not in the
    middle of a word (where the script sets words apart); ``start`` and ``end`` bound the first best part in the collapsed text. Every item with a
    text is searched, in words or not; null and blank items and null item ids are not. An item id with
    several texts is found by any of them. Null and empty texts have no leaks; repeated rows have
    the same ones; empty tables are served; a column ``leaks`` of the input is replaced.

    Documents stay where they lie: only items travel, at most ``block_bytes`` of them at a time. For a
    larger benchmark the texts are searched once for each block; the marks of a block (a hash of the
    text, the leaks) are written to the shared folder before the next block is read, and meet the
    documents in one join at the end, in which texts without leaks have no partner.
    """
    kept = [c for c in documents.columns if c != "leaks"]
    given = documents.select(*[F.col(f"`{c}`") for c in kept])
    plain = given.toDF(*[f"_c{i}" for i in range(len(kept))])  # the input's names may be any
    plain_text = f"_c{kept.index(text_col)}"
    blocks = _blocks(benchmark, item_col, item_text_col, block_bytes)
    first, second = next(blocks, None), next(blocks, None)
    if first is None:
        return given.withColumn("leaks", F.expr(f"cast(array() as {KIND})"))
    if second is None:
        sent = exact(plain, plain.columns)
        out = sent.mapInPandas(_marker(first, max_error, plain_text, plain.columns), f"{ddl(sent)}, leaks {KIND}")
        return restored(out, plain.schema).toDF(*kept, "leaks")
    texts = plain.select(F.col(plain_text).alias("text")).where("text is not null")
    keyed = texts.select(F.sha2("text", 256).alias("_text"), "text")
    written = []
    for block in itertools.chain([first, second], blocks):
        marks = keyed.mapInPandas(_marker(block, max_error, "text", ["_text"]), f"_text string, leaks {KIND}")
        written.append(settled(marks.where(F.size("leaks") > 0).dropDuplicates(["_text"]), "leaks"))
    found = (
        reduce(DataFrame.union, written)
        .select("_text", F.inline("leaks"))
        .groupBy("_text", "item_id")
        .agg(F.min(F.struct("edits", "start", "end")).alias("b"))
        .groupBy("_text")
        .agg(F.sort_array(F.collect_list(F.struct("item_id", "b.edits", "b.start", "b.end"))).alias("_leaks"))
    )
    joined = plain.join(found, F.sha2(F.col(plain_text), 256) == F.col("_text"), "left")
    none = F.expr(f"cast(array() as {KIND})")
    return joined.select(*plain.columns, F.coalesce(F.col("_leaks"), none).alias("leaks")).toDF(*kept, "leaks")


def _marker(
    items: list[tuple[int, str]], max_error: float, text_col: str, keep: list[str]
) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The function that adds the leaks of one block to batches of texts."""
    name = uuid.uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        searches = searches_of(name, items, max_error)
        for batch in batches:
            texts = [t if isinstance(t, str) else None for t in batch[text_col]]
            yield batch[keep].assign(leaks=[best_leaks(searches, t) for t in texts])

    return run


def leak_report(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and each benchmark item found in it."""
    found = mark_leaks(documents.select("doc_id", "text"), benchmark).where(F.size("leaks") > 0)
    return found.select("doc_id", F.explode("leaks").alias("leak")).select(
        "doc_id", "leak.item_id", "leak.edits", "leak.start", "leak.end"
    )
