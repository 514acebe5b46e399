"""Toxicity of texts: obfuscated words are decoded, then the restored text is scored.

A character language model of the whole corpus is the source of a noisy channel; the channel writes
letters as look-alike digits and signs, repeats them, or spreads a word out with separators. Each
suspicious token becomes a lattice of readings, and Viterbi decoding picks the likeliest.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.tables import ddl, exact
from tillpoint.llm.tables import restored as as_before
from tillpoint.llm.textops import mix64

#: Labelled rows that the classifier is fitted on, at most.
TRAINING_ROWS = 12_000
#: Score from which a document counts as toxic.
THRESHOLD = 0.7
#: Symbols of the character model: 0 is anything but a letter, 1-26 are a-z, others by remainder.
SYMBOLS = 64
#: Buckets of hashed word features.
BUCKETS = 1 << 22
#: Longest word beginning that is a feature.
BEGINNING = 10
#: Decoded tokens a worker remembers (speed only).
REMEMBERED = 100_000

# Letters that look like a digit or sign.
LOOKALIKES = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l",
}

# What the channel does, as log probabilities.
AS_LETTER, AS_IT_IS, LEFT_OUT = math.log(0.5), math.log(0.002), math.log(0.3)


_LETTER = r"[^\W\d_]"
_LOOK = "[0-9@$!|+€£]"
_END = "[@$|+€£]"  # look-alikes that seldom end a plain word, as ! and digits do
#: Tokens with more than one reading: letters spread out by one or two separators; look-alikes between or
#: before letters (or digits after them), or at the end; signs between letters; a letter three times
#: in a row, or three letters doubled one after the other.
SPREAD = re.compile(rf"(?<!\w)(?:{_LETTER}|{_LOOK})(?:([ ._*\-])\1?(?:{_LETTER}|{_LOOK})){{2,}}(?!\w)")
MIXED = re.compile(
    rf"(?:{_LOOK}|{_LETTER})*(?:{_LETTER}[*#_.\-]?{_LOOK}+{_LETTER}|{_LOOK}{_LETTER}|{_LETTER}[0-9]|{_LETTER}!*{_END}"
    rf"|{_LETTER}[*#_]+{_LETTER}|({_LETTER})\1\1|(?:({_LETTER})\2){{3}})(?:{_LOOK}|{_LETTER}|[*#_](?={_LETTER}))*"
)


def _symbol_table() -> np.ndarray:
    table = np.zeros(0x110000, dtype=np.uint8)
    for c in range(0x110000):
        if chr(c).isalpha():
            table[c] = c - 96 if 97 <= c <= 122 else 27 + c % 37
    return table


class Symbols:
    """Per-character tables, built once for each worker process."""

    _table: np.ndarray | None = None

    @classmethod
    def table(cls) -> np.ndarray:
        if cls._table is None:
            cls._table = _symbol_table()
        return cls._table


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def trigram_counts(texts: list[str]) -> np.ndarray:
    """Counts of symbol trigrams in lower-cased texts, each between blanks."""
    code = codes("\n\n" + "\n\n".join(texts).lower() + "\n\n")
    s = Symbols.table()[code].astype(np.int32)
    return np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS**3)


class CharacterModel:
    """Log probabilities of a symbol after two others, mixed with those after one and none."""

    def __init__(self, counts: np.ndarray) -> None:
        three = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(np.float64)
        two, one = three.sum(axis=0), three.sum(axis=(0, 1))
        p1 = (one + 1) / (one.sum() + SYMBOLS)
        p2 = (two + 5 * p1) / (two.sum(axis=1, keepdims=True) + 5)
        p3 = (three + 5 * p2[None]) / (three.sum(axis=2, keepdims=True) + 5)
        self.log = np.log(p3).tolist()
        self.known: dict[str, str] = {}

    @staticmethod
    def lattice(token: str) -> list[list[tuple[str, float]]]:
        """For each place of ``token`` its readings, each with the channel's log probability: signs as the
        letters they look like, separators left out, runs of a letter as one or two of it. Pairs are
        runs only in a token that doubles most of its letters, so that plain double letters stay."""
        runs = [len(m[0]) for m in re.finditer(rf"({_LETTER})\1*", token)]
        shortest = 2 if len(runs) > 2 and 2 * sum(n > 1 for n in runs) > len(runs) else 3
        places, i = [], 0
        while i < len(token):
            c = token[i]
            run = i
            while run < len(token) and token[run] == c:
                run += 1
            if c.isalpha() and run - i >= shortest:
                places.append([(c, AS_LETTER), (c * 2, LEFT_OUT if run - i > 2 else AS_IT_IS), (c * (run - i), AS_IT_IS)])
                i = run
                continue
            if c in LOOKALIKES:
                places.append([(x, AS_LETTER) for x in LOOKALIKES[c]] + [(c, AS_IT_IS)])
            elif c.isalnum():
                places.append([(c, 0.0)])
            else:
                places.append([("", LEFT_OUT), (c, AS_IT_IS)])
            i += 1
        return places

    def decode(self, token: str) -> str:
        """The likeliest reading of a token between blanks (Viterbi over the last two symbols)."""
        if (known := self.known.get(token)) is not None:
            return known
        table = Symbols.table()
        best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for readings in self.lattice(token):
            ahead: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (score, path) in best.items():
                for text, channel in readings:
                    x, y, s = a, b, score + channel
                    for c in text:
                        z = int(table[ord(c)])
                        s += self.log[x][y][z]
                        x, y = y, z
                    old = ahead.get((x, y))
                    if old is None or s > old[0]:
                        ahead[x, y] = (s, (text, path))
            best = ahead
        score, path = max(((s + self.log[a][b][0], p) for (a, b), (s, p) in best.items()), key=lambda r: r[0])
        parts = []
        while path is not None:
            parts.append(path[0])
            path = path[1]
        out = "".join(reversed(parts))
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        self.known[token] = out
        return out


class Restorer:
    """Finds suspicious tokens by array operations and replaces them by their decoded reading."""

    def __init__(self, model: CharacterModel) -> None:
        self.model = model
        self.look = np.zeros(0x110000, dtype=bool)
        self.look[[ord(c) for c in LOOKALIKES] + [ord("2")] + [ord(c) for c in "*#_"]] = True

    def spots(self, code: np.ndarray) -> np.ndarray:
        """Places of lower-cased text at which a token has more than one reading."""
        letter = Symbols.table()[code] > 0
        look = self.look[code]
        n = len(code)
        if n < 3:
            return np.zeros(0, dtype=np.int64)
        odd = np.zeros(n, dtype=bool)
        odd[1:] |= letter[:-1] & look[1:] & ~np.isin(code[1:], (42, 35, 33, 95))
        odd[2:] |= letter[:-2] & (code[1:-1] == 33) & look[2:] & ~np.isin(code[2:], (42, 35, 33, 95))
        odd[:-1] |= look[:-1] & letter[1:]
        odd[2:] |= letter[2:] & (code[2:] == code[1:-1]) & (code[1:-1] == code[:-2])
        alone = letter | look
        edge = np.concatenate(([False], alone, [False]))
        alone = alone & ~edge[:-2] & ~edge[2:]
        if n >= 5:
            odd[4:] |= alone[4:] & alone[2:-2] & alone[:-4]
        if n >= 7:
            odd[6:] |= alone[6:] & alone[3:-3] & alone[:-6]
        pair = letter[1:] & (code[1:] == code[:-1])  # a place and the one after it
        if n >= 6:
            odd[5:] |= pair[4:] & pair[2:-2] & pair[:-4]
        return np.flatnonzero(odd)

    def __call__(self, text: str) -> str:
        """The text in lower case with every suspicious token replaced by its best reading."""
        text = text.lower()
        spots = self.spots(codes(text))
        if not len(spots):
            return text
        parts, done = [], 0
        for at in spots.tolist():
            if at < done:
                continue
            begin, end = self.around(text, at, done)
            piece = text[begin:end]
            piece = SPREAD.sub(lambda m: self.model.decode(m[0]), piece)
            piece = MIXED.sub(lambda m: self.model.decode(m[0]), piece)
            parts += [text[done:begin], piece]
            done = end
        parts.append(text[done:])
        return "".join(parts)

    @staticmethod
    def around(text: str, at: int, done: int) -> tuple[int, int]:
        """The tokens around a place, as far as single characters go on before and after, one or two
        blanks apart."""
        begin, end = at, at
        while begin > done and not text[begin - 1].isspace():
            begin -= 1
        while step := next((k for k in (1, 2) if Restorer.lone(text, begin - k - 1, done) and text[begin - k : begin] == " " * k), 0):
            begin -= step + 1
        while end < len(text) and not text[end].isspace():
            end += 1
        while step := next((k for k in (1, 2) if Restorer.lone(text, end + k, done) and text[end : end + k] == " " * k), 0):
            end += step + 1
        return begin, end

    @staticmethod
    def lone(text: str, at: int, done: int) -> bool:
        """Whether a single character stands between blanks at a place not passed yet."""
        return (
            done <= at < len(text) and not text[at].isspace()
            and (at == done or text[at - 1].isspace()) and (at + 1 == len(text) or text[at + 1].isspace())
        )


@dataclass
class Features:
    """Hashed word features of several texts, word by word: ``doc`` is the place of the text."""

    doc: np.ndarray
    bucket: np.ndarray
    words: np.ndarray


def word_features(texts: list[str]) -> Features:
    """The beginnings (of 2 to ``BEGINNING`` letters) of all words, and the shorter words whole."""
    code = codes("\n".join(texts) + "\n")
    breaks = np.cumsum([len(t) + 1 for t in texts]) - 1
    letter = Symbols.table()[code] > 0
    edge = np.diff(np.concatenate(([0], letter.view(np.int8), [0])))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    doc = np.searchsorted(breaks, start)
    length = end - start
    words = np.bincount(doc, minlength=len(texts))
    docs, buckets = [], []
    value = np.zeros(len(start), dtype=np.uint64)
    mask = np.uint64(BUCKETS - 1)
    with np.errstate(over="ignore"):
        for k in range(BEGINNING):
            more = length > k
            if not more.all():
                start, doc, length, value = start[more], doc[more], length[more], value[more]
            if not len(start):
                break
            value = (value + code[start + k].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            value ^= value >> np.uint64(29)
            if k:
                docs.append(doc)
                buckets.append((mix64(value) & mask).astype(np.int32))
            whole = length == k + 1
            docs.append(doc[whole])
            buckets.append((mix64(value[whole] + np.uint64(77)) & mask).astype(np.int32))
    if not docs:
        return Features(np.zeros(0, np.int64), np.zeros(0, np.int32), words)
    return Features(np.concatenate(docs), np.concatenate(buckets), words)


def summary(weights: np.ndarray, features: Features) -> np.ndarray:
    """For each text: the strongest feature, how many different strong ones there are, and how many a word."""
    n = len(features.words)
    strongest = np.zeros(n)
    hit = np.flatnonzero(weights[features.bucket] > 0)
    pair = np.unique(features.doc[hit].astype(np.int64) * BUCKETS + features.bucket[hit])
    doc, w = pair // BUCKETS, weights[pair % BUCKETS]
    np.maximum.at(strongest, doc, w)
    strong = np.bincount(doc, weights=w >= 0.5 * weights.max(initial=0.0), minlength=n)
    return np.column_stack((np.ones(n), strongest, np.log1p(strong), strong / np.maximum(features.words, 1)))


def chunks(texts: list[str], size: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about ``size`` characters, one text at least."""
    total = np.cumsum([len(t) for t in texts])
    begin = 0
    while begin < len(texts):
        end = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + size)))
        yield begin, end
        begin = end


@dataclass
class ToxicityModel:
    """All that scoring needs: character counts, feature weights, and the last logistic step."""

    trigrams: np.ndarray
    bucket: np.ndarray
    weight: np.ndarray
    final: np.ndarray

    def weights(self) -> np.ndarray:
        out = np.zeros(BUCKETS, dtype=np.float32)
        out[self.bucket] = self.weight
        return out


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Regularised logistic regression by Newton's method."""
    beta = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (y - p) - penalty @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def log_odds(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Smoothed log ratio of a feature's document frequencies in toxic and clean texts."""
    rate = n_toxic / max(n_toxic + n_clean, 1)
    return np.log((toxic + 2 * rate) / (n_toxic + 2)) - np.log((clean + 2 * (1 - rate)) / (n_clean + 2))


def learn_characters(df: DataFrame, text_col: str = "text") -> np.ndarray:
    """Symbol trigram counts over every whole text (at most ``SYMBOLS ** 3`` sums come back)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros(SYMBOLS**3, dtype=np.int64)
        for batch in batches:
            texts = [t for t in batch["text"] if isinstance(t, str)]
            for begin, end in chunks(texts):
                n += trigram_counts(texts[begin:end])
        at = np.flatnonzero(n)
        yield pd.DataFrame({"trigram": at, "n": n[at]})

    rows = df.select(F.col(text_col).alias("text")).mapInPandas(count, "trigram long, n long")
    total = rows.groupBy("trigram").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(SYMBOLS**3, dtype=np.int64)
    out[total["trigram"].to_numpy(np.int64)] = total["n"].to_numpy(np.int64)
    return out


def learn_toxicity(
    documents: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    rows: int = TRAINING_ROWS,
) -> ToxicityModel:
    """Character model of all ``documents``; classifier from at most ``rows`` rows of ``labels``.

    The rows are those of least id hash among labels 0 and 1 with an id; a document labelled twice
    counts as toxic if any label says so, and of several texts of an id the one of least hash teaches, so
    ``rows`` bounds the texts too. Labels without a document, and documents without text,
    teach nothing. Features are counted on the executors. Each training text's own summary is taken
    with itself left out of the counts, so that the last step sees what unseen texts will show.
    """
    trigrams = learn_characters(documents, text_col)
    sample = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.max(label_col).cast("int").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(rows)
    )
    train = (
        documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
        .where("text is not null")
        .join(F.broadcast(sample), "_id")
        .groupBy("_id", "_label")
        .agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    )

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restore = Restorer(CharacterModel(trigrams))
        for batch in batches:
            texts = batch["text"].tolist()
            for begin, end in chunks(texts):
                found = word_features([restore(t) for t in texts[begin:end]])
                pair = np.unique(found.doc.astype(np.int64) * BUCKETS + found.bucket)
                parts = np.split((pair % BUCKETS).astype(np.int32), np.searchsorted(pair // BUCKETS, np.arange(1, end - begin)))
                yield pd.DataFrame({"label": batch["_label"].iloc[begin:end].to_numpy(np.int32), "words": found.words.astype(np.int32), "buckets": parts})

    shown = train.select("_label", "text").mapInPandas(extract, "label int, words int, buckets array<int>").checkpoint()
    sizes = {r["label"]: r["count"] for r in shown.groupBy("label").count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        prior = (n_toxic + 0.5) / (n_toxic + n_clean + 1)
        final = np.array([math.log(prior / (1 - prior)) if n_toxic + n_clean else -3.0, 0.0, 0.0, 0.0])
        return ToxicityModel(trigrams, np.zeros(0, np.int64), np.zeros(0), final)
    counted = (
        shown.select("label", F.explode("buckets").alias("bucket"))
        .groupBy("bucket")
        .agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))
        .where((F.col("toxic") >= 3) & (F.col("toxic") * n_clean > 3 * F.col("clean") * n_toxic))
        .toPandas()
    )
    bucket = counted["bucket"].to_numpy(np.int64)
    toxic, clean = counted["toxic"].to_numpy(np.float64), counted["clean"].to_numpy(np.float64)
    weight = log_odds(toxic, clean, n_toxic, n_clean)

    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with_all = np.zeros(BUCKETS, dtype=np.float32)
        without = np.zeros(BUCKETS, dtype=np.float32)
        with_all[bucket] = weight
        without[bucket] = np.where(toxic - 1 >= 3, log_odds(toxic - 1, clean, n_toxic - 1, n_clean), 0)
        for batch in batches:
            found = []
            for label, words, buckets in zip(batch["label"], batch["words"], batch["buckets"], strict=True):
                own = Features(np.zeros(len(buckets), np.int64), np.asarray(buckets, dtype=np.int64), np.array([words]))
                found.append(summary(without if label else with_all, own)[0].tolist())
            yield pd.DataFrame({"label": batch["label"], "x": found})

    seen = shown.select("label", "words", "buckets").mapInPandas(summarise, "label int, x array<double>").toPandas()
    x, y = np.array(seen["x"].tolist()), seen["label"].to_numpy(np.float64)
    return ToxicityModel(trigrams, bucket, weight, fit_logistic(x, y))


def score_texts(
    df: DataFrame,
    model: ToxicityModel,
    keep: list[Column | str],
    text_col: str = "text",
    threshold: float = THRESHOLD,
    restored: bool = True,
) -> DataFrame:
    """Columns ``keep`` with ``restored`` (the decoded text, if wanted), ``score`` (0 to 1) and
    ``predicted``.

    Only the text is looked at. Null and empty texts are scored as texts without any word (restored:
    empty). Repeated rows give repeated results; an empty table an empty one.
    """
    rows = df.select(*keep, F.col(text_col).alias("_text"))
    kept = rows.columns[:-1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restore, weights = Restorer(CharacterModel(model.trigrams)), model.weights()
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["_text"]]
            for begin, end in chunks(texts):
                read = [restore(t) for t in texts[begin:end]]
                x = summary(weights, word_features(read))
                score = 1 / (1 + np.exp(-np.clip(x @ model.final, -30, 30)))
                out = batch.iloc[begin:end][kept].copy()
                if restored:
                    out["restored"] = read
                out["score"] = score
                out["predicted"] = (score >= threshold).astype(np.int32)
                yield out

    sent = exact(rows, rows.columns)
    schema = ddl(sent.drop("_text")) + ", restored string" * restored
    return as_before(sent.mapInPandas(run, f"{schema}, score double, predicted int"), rows.schema)


def held_out(id_col: str) -> Column:
    """Whether crc32 of the id as text leaves the remainder 1 when divided by 3 (a null id: no)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def toxicity_report(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents, learned from the labels that are not held out."""
    model = learn_toxicity(documents, labels.where(~held_out("doc_id")))
    scored = score_texts(documents, model, ["doc_id", held_out("doc_id").alias("held_out")])
    return scored.select("doc_id", "held_out", "score", "predicted")
