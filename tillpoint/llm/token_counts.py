"""Token counts of every prefix of every text, by dynamic programming over byte prefixes."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

#: Distinct pieces a worker remembers; beyond it the memory starts anew (speed only, never results).
REMEMBERED = 600_000
#: Bytes of text per output batch (one text at least).
BATCH_BYTES = 1 << 20

# Fixed values of the vocabulary format: the split into pieces of text in the commonest alphabets
# (others are split by the vocabulary's library), and the longer contractions in it.
PIECES = re.compile(r"'(?:s|t|re|ve|m|ll|d)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
UNCOMMON = re.compile("[\x1c-\x1f\xb2\xb3\xb9\xbc-\xbe]|[^\x00-\u024f]")
BLANKS = re.compile(r"\s\s")
CONTRACTIONS = ("'re", "'ve", "'ll")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary file."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixCounter(dict):
    """Piece of text -> little-endian uint32 counts, one for each of its byte prefixes.

    The encoding of a prefix ends in exactly one token whose removal leaves the encoding of a
    shorter prefix, namely the suffix token that may stand after that encoding's last token.
    So ``count[i] = count[i - len(token)] + 1`` needs only the last token of each prefix.
    """

    def __init__(self, path: str | None = None) -> None:
        super().__init__()
        path = path or default_vocabulary()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path).pre_tokenizer
        if spec.get("normalizer") or spec["model"]["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("a byte-level BPE vocabulary without normaliser is needed")
        letter = byte_letters()
        self.ids = {}
        for word, number in spec["model"]["vocab"].items():
            if all(c in letter for c in word):
                self.ids[bytes(letter[c] for c in word)] = number
        self.bytes_of = {number: word for word, number in self.ids.items()}
        self.rank = {}
        for i, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[bytes(letter[c] for c in left), bytes(letter[c] for c in right)] = i
        added = [t["content"] for t in spec.get("added_tokens", [])]
        self.added = re.compile("(" + "|".join(re.escape(t) for t in sorted(added, key=len, reverse=True)) + ")") if added else None
        self.ids = {word: number for word, number in self.ids.items() if self.merge(word) == [word]}
        self.longest = max(map(len, self.ids))
        self.made_by = {a + b: (rank, (a, b)) for (a, b), rank in self.rank.items()}
        self.edges: tuple[dict, dict] = ({}, {})
        self.follows: dict[tuple[int, int], bool] = {}

    def merge(self, word: bytes) -> list[bytes]:
        """The definition of the encoding: join the neighbours of lowest rank until none is left."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            ranks = [self.rank.get(p, 1 << 60) for p in zip(parts, parts[1:], strict=False)]
            i = min(range(len(ranks)), key=ranks.__getitem__)
            if ranks[i] == 1 << 60:
                break
            best, joined, k = (parts[i], parts[i + 1]), [], 0
            while k < len(parts):
                if k + 1 < len(parts) and (parts[k], parts[k + 1]) == best:
                    joined.append(parts[k] + parts[k + 1])
                    k += 2
                else:
                    joined.append(parts[k])
                    k += 1
            parts = joined
        return parts

    def edge(self, token: int, side: int) -> list[tuple[bytes, float]]:
        """The parts of a token that touch its left (0) or right (1) end, from the single byte up
        to the whole, each with the rank of the merge that swallows it."""
        if (known := self.edges[side].get(token)) is None:
            word = self.bytes_of[token]
            swallowed = float("inf")
            known = [(word, swallowed)]
            while len(word) > 1:
                swallowed, pair = self.made_by[word]
                word = pair[side]
                known.append((word, swallowed))
            known.reverse()
            self.edges[side][token] = known
        return known

    def may_follow(self, left: int, right: int) -> bool:
        """Whether ``right`` after ``left`` stays as it is: at no time is the merge across the
        border the next one due. Of equal merges the leftmost comes first."""
        key = (left, right)
        if (known := self.follows.get(key)) is None:
            a, b, i, k = self.edge(left, 1), self.edge(right, 0), 0, 0
            while True:
                (x, x_until), (y, y_until) = a[i], b[k]
                across = self.rank.get((x, y))
                if across is not None and across < x_until and across <= y_until:
                    known = False
                    break
                if x_until == y_until == float("inf"):
                    known = True
                    break
                i, k = i + (x_until <= y_until), k + (y_until <= x_until)
            self.follows[key] = known
        return known

    def counts(self, word: bytes) -> list[int]:
        last, count = [-1] * (len(word) + 1), [0] * (len(word) + 1)
        get, follows = self.ids.get, self.follows.get
        for end in range(1, len(word) + 1):
            for begin in range(max(0, end - self.longest), end):
                token = get(word[begin:end])
                if token is None:
                    continue
                if begin:
                    before = last[begin]
                    good = follows((before, token))
                    if good is None:
                        good = self.may_follow(before, token)
                    if not good:
                        continue
                last[end], count[end] = token, count[begin] + 1
                break
        return count[1:]

    def __missing__(self, piece: str) -> bytes:
        found = self.counts(piece.encode("utf-8"))
        if piece in CONTRACTIONS:  # a shorter prefix is an apostrophe and a letter
            found[1] = 2
        if len(self) >= REMEMBERED:
            self.clear()
        out = self[piece] = np.array(found, dtype="<u4").tobytes()
        return out

    def prefixes(self, text: str) -> np.ndarray:
        """Token count of every byte prefix of ``text`` (uint32; the last is the total)."""
        if not text:
            return np.zeros(0, np.uint32)
        if self.added and self.added.search(text):
            parts, base, before = [], 0, ""
            for i, part in enumerate(self.added.split(text)):
                if i % 2:  # until it is whole, its beginning is ordinary text
                    counts = self.plain(before + part)[len(before.encode()) :] + np.uint32(base)
                    base += int(self.plain(before)[-1]) if before else 0
                    counts[-1] = base = base + 1
                    parts.append(counts)
                else:
                    parts.append(self.plain(part) + np.uint32(base))
                    before = part
            return np.concatenate(parts)
        return self.plain(text)

    def pieces(self, text: str) -> list[str]:
        if UNCOMMON.search(text):
            return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]
        return PIECES.findall(text)

    def plain(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        pieces = self.pieces(text)
        parts = list(map(self.__getitem__, pieces))
        inside = np.frombuffer(b"".join(parts), dtype="<u4")
        size = np.fromiter(map(len, parts), np.int64, len(parts)) >> 2
        end = np.cumsum(size)
        last = inside[end - 1]
        base = np.cumsum(last, dtype=np.uint32) - last
        out = inside + np.repeat(base, size)
        for i, piece in enumerate(pieces[:-1] if BLANKS.search(text) else ()):
            if piece.isspace() and pieces[i + 1][0].isspace():  # a prefix that ends here has all blanks in one piece
                run = piece + pieces[i + 1][0]
                counts = np.frombuffer(self[run], dtype="<u4")
                at = end[i] + len(pieces[i + 1][0].encode())
                out[at - 1] = base[i] + counts[-1]
        return out


@lru_cache(maxsize=2)
def prefix_counter(vocabulary: str | None) -> PrefixCounter:
    """One counter for each worker process, kept between tasks."""
    return PrefixCounter(vocabulary)


def whole_characters(counts: np.ndarray, text: str) -> np.ndarray:
    """``counts`` by byte, with -1 at the bytes that do not end a character."""
    if text.isascii():
        return counts
    following = np.frombuffer(text.encode(), dtype=np.uint8)[1:]
    out = counts.astype(np.int32)
    out[:-1][(following & 0xC0) == 0x80] = -1
    return out


def prefix_token_counts(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None
) -> DataFrame:
    """Exact token counts at every byte prefix of every text.

    Returns ``id_col``, ``n_bytes``, ``n_tokens`` and ``prefix_tokens`` (array<int>, one count for
    each byte; ``prefix_tokens[i]`` is the number of tokens of the text's first ``i + 1`` bytes, -1 where
    these end inside a character). ``tokens_at`` and ``bytes_within`` answer questions about
    truncation and budgets from the stored array without encoding anything again.

    Null and empty texts have 0 bytes, 0 tokens and an empty array; a null id is passed on, repeated
    rows give repeated results, an empty table an empty one, other columns are not read. Strings of
    special tokens inside a text count as the one token that the vocabulary's library makes of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = prefix_counter(vocabulary)

        def flush(ids: list, counts: list[np.ndarray]) -> pa.RecordBatch:
            size = np.array([len(c) for c in counts], dtype=np.int64)
            offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
            values = np.concatenate([*counts, np.zeros(0, np.uint32)]).astype(np.int32)
            total = np.array([int(c[-1]) if len(c) else 0 for c in counts], dtype=np.int64)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, type=id_type),
                    pa.array(size),
                    pa.array(total),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                ],
                names=[id_col, "n_bytes", "n_tokens", "prefix_tokens"],
            )

        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            id_type, held, counts, size = ids.type, [], [], 0
            for key, text in zip(ids.to_pylist(), texts, strict=True):
                whole = text.as_py() or ""
                counts.append(whole_characters(counter.prefixes(whole), whole))
                held.append(key)
                size += len(counts[-1])
                if size >= BATCH_BYTES:
                    yield flush(held, counts)
                    held, counts, size = [], [], 0
            if held:
                yield flush(held, counts)

    kind = df.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_bytes long, n_tokens long, prefix_tokens array<int>"
    return df.select(id_col, text_col).mapInArrow(run, schema)


def tokens_at(prefix_tokens: Column | str, n_bytes: Column | int) -> Column:
    """Tokens of the whole characters among the first ``n_bytes`` bytes (0 bytes: none; beyond the end: all)."""
    array = F.col(prefix_tokens) if isinstance(prefix_tokens, str) else prefix_tokens
    at = F.least(n_bytes if isinstance(n_bytes, Column) else F.lit(n_bytes), F.size(array))
    ends = [F.when(at > k, F.nullif(F.get(array, at - 1 - k), F.lit(-1))) for k in range(4)]  # a character has up to 4 bytes
    return F.when(array.isNotNull(), F.coalesce(*ends, F.lit(0)))


def bytes_within(prefix_tokens: Column | str, budget: int) -> Column:
    """The longest prefix of whole characters, in bytes, of at most ``budget`` tokens."""
    array = F.col(prefix_tokens) if isinstance(prefix_tokens, str) else prefix_tokens
    fits = F.filter(F.sequence(F.lit(1), F.size(array)), lambda i: F.get(array, i - 1).between(0, budget))
    return F.when(F.size(array) == 0, F.lit(0)).otherwise(F.coalesce(F.array_max(fits), F.lit(0)))


def token_limit_report(df: DataFrame, limit: int = 512, vocabulary: str | None = None) -> DataFrame:
    """Per document its bytes, its tokens and whether they are more than ``limit``."""
    counted = prefix_token_counts(df, vocabulary=vocabulary)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
