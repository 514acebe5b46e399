"""Language-model scores of texts by context-tree weighting over bytes.

A text is its words with one blank between them and a line end after the last. Each byte is read as
eight binary decisions; every decision has a context tree over the bytes before it, whose nodes hold
Krichevsky-Trofimov estimates. The weighted probability of a tree mixes the estimates of all depths:
P(node) = KT(node) / 2 + (product of P over the node's children) / 2, and KT(node) at full depth.

Counting and scoring go over texts in blocks, with arrays; everything between is rows of nodes that
Spark groups and joins, so that the model may be of any size. A block receives the code lengths of
just the byte runs that it holds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.tables import settled
from tillpoint.llm.textops import WordHasher, signed
from tillpoint.session import ensure_checkpoint_dir

#: Bytes of context. A run of DEPTH + 1 bytes is one key, so at most 6.
DEPTH = 5
#: Bytes of text in a block; its distinct byte runs and words are what a task holds.
BLOCK_BYTES = 64 << 20
#: Bytes of text worked on at a time (one text at least), as arrays of eight bytes for each of them.
PIECE_BYTES = 256 << 10
#: Keys collected before they are merged, and rows of a batch handed to Spark.
MERGE_KEYS, ROWS = 1 << 18, 1 << 16
END = 10
_LN_2, _LN_PI, _HALF_LN_TAU = math.log(2), math.log(math.pi), math.log(2 * math.pi) / 2


class Spelling:
    """Bytes and words of a batch of texts: ``stream`` (all texts as modelled, ``size`` bytes each),
    and for every word its ``hash``, ``doc`` and bytes ``data[start:end]``."""

    def __init__(self, texts: pa.Array, hasher: WordHasher) -> None:
        joined = "\n".join([*texts.to_pylist(), ""])
        words = hasher(joined)
        self.data, self.start, self.end, self.hash = words.data, words.start, words.end, signed(words.hash)
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        edge = np.cumsum(sizes + 1) - 1
        self.doc = np.searchsorted(edge, self.start)
        white = (self.data == 32) | ((self.data >= 9) & (self.data <= 13))
        keep = ~white
        keep[edge] = True
        keep[self.end[:-1][self.doc[1:] == self.doc[:-1]]] = True
        out = np.where(white, np.uint8(32), self.data)
        out[edge] = END
        self.stream = out[keep]
        last = np.cumsum(keep)[edge]
        self.size = np.diff(np.concatenate(([0], last)))

    def runs(self, depth: int) -> np.ndarray:
        """For every byte the ``depth`` bytes before it in its text, the nearest first (zeros before
        the beginning), and itself, packed into one number."""
        x = self.stream.astype(np.int64)
        before = np.concatenate((np.zeros(depth, np.int64), x))
        key = x.copy()
        for j in range(1, depth + 1):
            key |= before[depth - j : depth - j + len(x)] << (8 * (depth + 1 - j))
        first = np.cumsum(self.size) - self.size
        mask = 255
        for i in range(depth):
            key[first[self.size > i] + i] &= mask
            mask |= 255 << (8 * (depth - i))
        return key


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about ``PIECE_BYTES`` bytes of text."""
    ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False), dtype=np.int64)
    begin = 0
    while begin < len(ends):
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + PIECE_BYTES, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


class _Counter:
    """Distinct keys of a block with how often its training texts have them (0: others only), and the
    words that they stand for, if they are words."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray, pa.Array | None]] = []
        self.held = self.merged = 0

    def add(self, key: np.ndarray, count: np.ndarray, words: pa.Array | None = None) -> None:
        self.parts.append((key, count, words))
        self.held += len(key)
        if self.held > max(MERGE_KEYS, self.merged // 4):
            self.all()

    def all(self) -> tuple[np.ndarray, np.ndarray, pa.Array | None]:
        """Keys in ascending order, their counts and words."""
        if len(self.parts) > 1:
            keys, counts, words = zip(*self.parts, strict=True)
            self.parts = []
            key = np.concatenate(keys)
            order = np.argsort(key, kind="stable")
            key = key[order]
            head = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))[: len(key)]
            count = np.add.reduceat(np.concatenate(counts)[order], head) if len(key) else np.zeros(0, np.int64)
            kept = None if words[0] is None else pa.concat_arrays(words).take(pa.array(order[head]))
            self.parts, self.merged = [(key[head], count, kept)], len(head)
        self.held = 0
        return self.parts[0]


def _cut(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The runs of bytes ``[start, end)`` as an Arrow array."""
    size = end - start
    offset = np.concatenate(([0], np.cumsum(size)))
    held = data[np.repeat(start - offset[:-1], size) + np.arange(offset[-1])]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offset.astype(np.int64)), pa.py_buffer(held)])


_PAIR_SCHEMA = "block int, key long, word binary, n long"


def _gathered(depth: int):
    """Distinct byte runs (word null) and words of each block, with their training counts."""
    flag = 8 * (depth + 1)

    def rows(block: int, key: np.ndarray, n: np.ndarray, words: pa.Array | None) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(key), ROWS):
            part = key[i : i + ROWS]
            word = pa.nulls(len(part), pa.binary()) if words is None else words.slice(i, ROWS).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(part), block, np.int32)), pa.array(part), word, pa.array(n[i : i + ROWS])],
                names=["block", "key", "word", "n"],
            )

    def count(part: pa.RecordBatch, hasher: WordHasher, runs: _Counter, words: _Counter) -> None:
        trains = part.column("trains").to_numpy(zero_copy_only=False).astype(np.int64)
        text = Spelling(part.column("text"), hasher)
        key, n = np.unique(text.runs(depth) | (np.repeat(trains, text.size) << flag), return_counts=True)
        runs.add(key & ((1 << flag) - 1), n * (key >> flag))
        key, first, inverse = np.unique(text.hash, return_index=True, return_inverse=True)
        n = np.bincount(inverse, weights=trains[text.doc], minlength=len(key)).astype(np.int64)
        words.add(key, n, _cut(text.data, text.start[first], text.end[first]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        held: dict[int, tuple[_Counter, _Counter]] = {}
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            for block in np.unique(blocks).tolist():  # one, as a partition is a block
                counters = held.setdefault(block, (_Counter(), _Counter()))
                for part in _pieces(batch.filter(pa.array(blocks == block))):
                    count(part, hasher, *counters)
        while held:
            block, counters = held.popitem()
            for counter in counters:
                yield from rows(block, *counter.all())

    return run


def _ln_gamma(x: Column) -> Column:
    """Stirling's series after seven steps upwards; for x of 1/2 or more."""
    y = x + 7
    product = x
    for k in range(1, 7):
        product = product * (x + k)
    series = F.lit(1.0) / (y * 12) - F.lit(1.0) / (y * y * y * 360) + F.lit(1.0) / (y * y * y * y * y * 1260)
    return (y - 0.5) * F.ln(y) - y + _HALF_LN_TAU + series - F.ln(product)


def _ln_kt(zeros: Column, ones: Column) -> Column:
    """Log of the Krichevsky-Trofimov probability of a sequence with so many zeros and ones."""
    return _ln_gamma(zeros + 0.5) + _ln_gamma(ones + 0.5) - _LN_PI - _ln_gamma(zeros + ones + 1.0)


def _decisions(key: Column) -> list[tuple[Column, Column]]:
    """The eight (node of the byte's binary tree, bit) of the byte in a key."""
    byte = key.bitwiseAND(F.lit(255).cast("long"))
    out = []
    for k in range(8):
        node = (F.shiftright(byte, 8 - k) + F.lit(1 << k)).cast("int")
        out.append((node, F.shiftright(byte, 7 - k).bitwiseAND(F.lit(1).cast("long")).cast("int")))
    return out


def _parent(node: Column) -> Column:
    """The node of the same decision with one byte of context less."""
    return F.shiftleft(F.shiftright(node, 16), 8) + node.bitwiseAND(F.lit(255).cast("long"))


def grow_tree(runs: DataFrame, depth: int) -> list[DataFrame]:
    """Nodes by depth (``node``: context and place in the byte's tree; ``p``: probability of a one for
    a text whose context is known just so far; ``share``, ``left``: what its children inherit).

    ``runs``: distinct ``key`` with its training count ``n``. Each depth is one grouping of the depth
    below and, on the way back, one join with the depth above. A node has at most 256 children.
    """
    bits = F.array(*[F.struct(v.alias("v"), b.alias("b")) for v, b in _decisions(F.col("key"))])
    spread = (
        runs.where("n > 0").withColumn("context", F.shiftright("key", 8)).repartition("context").select("context", "n", F.explode(bits).alias("d"))
    )
    counts = spread.groupBy("context", "d.v").agg(
        F.sum(F.when(F.col("d.b") == 0, F.col("n")).otherwise(0)).cast("double").alias("zeros"),
        F.sum(F.when(F.col("d.b") == 1, F.col("n")).otherwise(0)).cast("double").alias("ones"),
    )
    leaf = counts.select((F.shiftleft("context", 8) + F.col("v")).alias("node"), "zeros", "ones")
    levels = [settled(leaf.withColumn("weighted", _ln_kt(F.col("zeros"), F.col("ones"))).withColumn("odds", F.lit(None).cast("double")), "ctw-nodes")]
    for _ in range(depth):
        summed = levels[0].groupBy(_parent(F.col("node")).alias("node")).agg(
            F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("below")
        )
        own = summed.withColumn("kt", _ln_kt(F.col("zeros"), F.col("ones")))
        most = F.greatest("kt", "below")
        both = most + F.log1p(F.exp(F.least("kt", "below") - most)) - _LN_2
        levels.insert(0, settled(own.select("node", "zeros", "ones", both.alias("weighted"), (F.col("kt") - F.col("below")).alias("odds")), "ctw-nodes"))
    ready: list[DataFrame] = []
    for level in levels:
        one = (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1.0)
        weight = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("odds")))
        if ready:
            above = ready[-1].select(F.col("node").alias("up"), "share", "left")
            own = level.withColumn("up", _parent(F.col("node"))).join(above, "up")
        else:
            own = level.withColumn("share", F.lit(0.0)).withColumn("left", F.lit(1.0))
        ready.append(
            settled(
                own.select(
                    "node",
                    (F.col("share") + F.col("left") * one).alias("p"),
                    (F.col("share") + F.col("left") * weight * one).alias("share"),
                    (F.col("left") * (F.lit(1.0) - weight)).alias("left"),
                ),
                "ctw-shares",
            )
        )
    return ready


def code_lengths(runs: DataFrame, tree: list[DataFrame]) -> DataFrame:
    """``key`` and ``val``, the log10 probability of its byte after its context, for every key of
    ``runs``. A decision takes the mixture down to the deepest node seen in training."""
    depth = len(tree) - 1
    entry = F.struct(F.col("node").bitwiseAND(F.lit(255).cast("long")).cast("int").alias("v"), "p")
    deepest = tree[-1].groupBy(F.shiftright("node", 8).alias("context")).agg(F.map_from_entries(F.collect_list(entry)).alias("known"))
    own = runs.select("key", F.shiftright("key", 8).alias("context")).join(deepest, "context", "left")
    said = lambda p, bit: F.log10(F.when(bit == 1, p).otherwise(F.lit(1.0) - p))
    steps = [(v, b, F.try_element_at("known", v)) for v, b in _decisions(F.col("key"))]
    direct = sum((F.coalesce(said(p, b), F.lit(0.0)) for _, b, p in steps[1:]), F.coalesce(said(steps[0][2], steps[0][1]), F.lit(0.0)))
    lacking = F.filter(
        F.array(*[F.when(p.isNull(), F.struct(v.alias("v"), b.alias("b"))) for v, b, p in steps]), lambda s: s.isNotNull()
    )
    first = settled(own.select("key", direct.alias("val"), lacking.alias("lacking")), "ctw-lengths")
    # The few decisions not seen after the whole context: look at every shorter one, take the longest seen.
    open_ones = first.where(F.size("lacking") > 0).select("key", F.explode("lacking").alias("s")).select("key", "s.*")
    shorter = [
        F.struct(
            F.lit(d).alias("depth"),
            (F.shiftleft(F.shiftright("key", 8 * (depth - d + 1)), 8) + F.col("v")).alias("node"),
        )
        for d in range(depth)
    ]
    asked = open_ones.select("key", "v", "b", F.explode(F.array(*shorter)).alias("at")).select("key", "v", "b", "at.*")
    known = tree[0].select(F.lit(0).alias("depth"), "node", "p")
    for d in range(1, depth):
        known = known.unionByName(tree[d].select(F.lit(d).alias("depth"), "node", "p"))
    answered = (
        asked.join(known, ["depth", "node"], "left")
        .groupBy("key", "v", "b")
        .agg(F.max_by("p", F.when(F.col("p").isNotNull(), F.col("depth"))).alias("p"))
    )
    rest = answered.groupBy("key").agg(F.sum(said(F.coalesce("p", F.lit(0.5)), F.col("b"))).alias("more"))
    return first.join(rest, "key", "left").select("key", (F.col("val") + F.coalesce("more", F.lit(0.0))).alias("val"))


class _Table:
    """Values by key; keys come ascending, repeated ones with one value. A missing key has ``default``."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray]], default: float) -> None:
        key = np.concatenate([np.zeros(0, np.int64), *[k for k, _ in parts]])
        val = np.concatenate([np.zeros(0), *[v for _, v in parts]])
        own = np.concatenate(([True], key[1:] != key[:-1]))[: len(key)]
        self.places, self.values = pd.Index(key[own]), np.append(val[own], default)

    def __getitem__(self, key: np.ndarray) -> np.ndarray:
        return self.values[self.places.get_indexer(key)]  # -1, the last value, where it is missing


def _scored(depth: int, tokens: int, kinds: int, ends: int):
    """Scores of a block's texts, which follow the code lengths of its byte runs and its words' counts."""
    names = ["id", "trains", "n_tokens", "n_known", "base_score", "score"]
    whole = tokens + 0.5 * (kinds + 1)
    end_score = math.log10((ends + 0.5) / whole)

    def scored(part: pa.RecordBatch, hasher: WordHasher, lengths: _Table, counts: _Table) -> pa.RecordBatch:
        text, docs_n = Spelling(part.column("text"), hasher), part.num_rows
        bits, held = lengths[text.runs(depth)], counts[text.hash]
        each = lambda w: np.bincount(text.doc, weights=w, minlength=docs_n)
        columns = [
            part.column("id"),
            part.column("trains"),
            pa.array(np.bincount(text.doc, minlength=docs_n) + 1),
            pa.array(each(held > 0).astype(np.int64) + (ends > 0)),
            pa.array(each(np.log10((held + 0.5) / whole)) + end_score),
            pa.array(np.add.reduceat(bits, np.cumsum(text.size) - text.size)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, block = WordHasher(), None
        parts: tuple[list, list] = ([], [])
        tables: tuple[_Table, _Table] | None = None
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            for here in np.unique(blocks).tolist():
                part = batch.filter(pa.array(blocks == here))
                if here != block:
                    block, parts, tables = here, ([], []), None
                kind = part.column("kind").to_numpy()
                for k in (0, 1):
                    own = part.filter(pa.array(kind == k))
                    if own.num_rows:
                        parts[k].append((own.column("key").to_numpy(), own.column("val").to_numpy()))
                part = part.filter(pa.array(kind == 2))
                if not part.num_rows:
                    continue
                if tables is None:
                    tables = _Table(parts[0], math.nan), _Table(parts[1], 0.0)
                    parts = ([], [])
                for piece in _pieces(part):
                    yield scored(piece, hasher, *tables)

    return run


def context_tree_scores(
    df: DataFrame, trains: Column, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH
) -> DataFrame:
    """Scores of every text by models of those texts for which ``trains`` is true.

    Returns ``id_col``, ``trains``, ``n_tokens`` (words and one end), ``n_known`` (tokens that the
    training texts have), ``train_tokens``, ``base_score`` (log10 probability by token frequencies with
    half a count added, one unseen token allowed for) and ``score`` (log10 probability by the context
    tree). Minus ``score`` times log2(10) over the bytes is the code length per byte.

    Null texts are empty; an empty text is scored by its end alone. A null ``trains`` counts as false;
    null ids are passed on; repeated rows are counted and scored each; without training texts every
    bit has probability one half. An empty table gives no rows. Only the given columns are read.

    Texts go to blocks by a hash of id and text, so copies under many ids are spread. Every distinct
    byte run and word of the training texts is counted, without bounds on their number. Words of a
    block are told apart by 64-bit hashes, in the corpus by their bytes.
    """
    if not 1 <= depth <= 6:
        raise ValueError("depth must be 1 to 6")
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    given = df.select(F.col(id_col).alias("id"), text.alias("text"), F.coalesce(trains, F.lit(False)).alias("trains"))
    total, ends = given.agg(F.sum(F.octet_length("text") + 1), F.count_if("trains")).first()
    n_blocks = max(spark.sparkContext.defaultParallelism, -(-(total or 0) // BLOCK_BYTES))
    given = given.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks)).cast("int"))
    texts = given.repartitionById(n_blocks, "block")
    pairs = settled(texts.select("block", "text", "trains").mapInArrow(_gathered(depth), _PAIR_SCHEMA), "ctw-pairs")
    words = settled(pairs.where("word is not null").groupBy("word").agg(F.sum("n").alias("n")).where("n > 0"), "ctw-words")
    n_words, kinds = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    runs = settled(pairs.where("word is null").groupBy("key").agg(F.sum("n").alias("n")), "ctw-runs")
    lengths = code_lengths(runs, grow_tree(runs, depth))
    nothing = [F.lit(None).cast(given.schema[c].dataType).alias(c) for c in ("id", "text", "trains")]
    asked = pairs.where("word is null").select("block", "key").join(lengths, "key")
    heard = pairs.where("word is not null").select("block", "key", "word").join(words, "word")
    rows = (
        asked.select("block", F.lit(0).alias("kind"), "key", "val", *nothing)
        .unionByName(heard.select("block", F.lit(1).alias("kind"), "key", F.col("n").cast("double").alias("val"), *nothing))
        .unionByName(given.select("block", F.lit(2).alias("kind"), F.lit(None).cast("long").alias("key"), F.lit(None).cast("double").alias("val"), "id", "text", "trains"))
    )
    kind = given.schema["id"].dataType
    schema = f"id {kind.simpleString()}, trains boolean, n_tokens long, n_known long, base_score double, score double"
    scored = (
        rows.repartitionById(n_blocks, "block")
        .sortWithinPartitions("block", "kind", "key")
        .mapInArrow(_scored(depth, n_words + ends, kinds + (ends > 0), ends), schema)
    )
    return scored.select(
        F.col("id").alias(id_col), "trains", "n_tokens", "n_known", F.lit(n_words + ends).cast("long").alias("train_tokens"), "base_score", "score"
    )


def language_model_report(documents: DataFrame) -> DataFrame:
    """Scores of every document, learned from those whose crc32 of the decimal doc_id modulo 5 is not 1
    (so also from rows without an id)."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))
    scored = context_tree_scores(documents, ~held_out)
    return scored.select(
        "doc_id", (~F.col("trains")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
