"""Exact Jaccard self-join of documents on word shingles, by prefix filters under several orders."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.llm.components import connected_components
from tillpoint.llm.tables import exact, release_shuffles
from tillpoint.llm.textops import WordHasher, mix64, shingles, signed

#: Words of a shingle, and the similarity from which documents link, in hundredths.
WIDTH, SIMILARITY = 5, 75
#: Share of a set (in hundredths) by which prefixes are longer than the least: linked documents then
#: share that much of their prefixes, not one shingle only.
EXTRA = 15
#: A shingle is common if it is in this share of the documents of a task (and in four at least).
#: Common shingles come last in every order; this decides speed, never results.
COMMON_SHARE = 1 / 500
SLOT_BITS = 20
#: Posting lists from this length on are compared block against block, not pair by pair.
LONG_LIST = 64
#: Documents of a block.
BLOCK = 128
#: Multipliers that make different orders of the shingles from one hash.
ORDERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def needed(n: np.ndarray | int, similarity: int = SIMILARITY) -> np.ndarray | int:
    """Least overlap of a set of ``n`` shingles with any set that it links to."""
    return -(-similarity * n // 100)


def extra(n: np.ndarray | int) -> np.ndarray | int:
    """How many shingles of their prefixes linked sets share at least."""
    return -(-EXTRA * n // 100)


class Order:
    """A total order of shingles: by class (common ones last), then by a hash of its own."""

    def __init__(self, classes: np.ndarray, number: int) -> None:
        self.classes, self.factor = classes, np.uint64(ORDERS[number])

    def prefix(self, tokens: np.ndarray, similarity: int) -> np.ndarray:
        n = len(tokens)
        size = min(n, n - needed(n, similarity) + extra(n))
        if size >= n:
            return tokens
        with np.errstate(over="ignore"):
            key = mix64(tokens * self.factor) >> np.uint64(6)
        key |= self.classes[(tokens >> np.uint64(64 - SLOT_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(58)
        return tokens[np.argpartition(key, size - 1)[:size]]


def signature(tokens: np.ndarray) -> int:
    """One number for a whole set."""
    with np.errstate(over="ignore"):
        total = np.add.reduce(mix64(tokens + np.uint64(0xA5A5A5A5)), dtype=np.uint64)
    return int(signed(mix64(np.array([total + np.uint64(len(tokens))], dtype=np.uint64)))[0])


def text_sets(texts: pd.Series, width: int) -> Iterator[np.ndarray]:
    hasher = WordHasher()
    for t in texts:
        yield shingles(hasher(t).hash, width) if isinstance(t, str) else np.zeros(0, np.uint64)


def survey(docs: DataFrame, width: int) -> DataFrame:
    """One pass over (id, text): per document its set's size and signature, per task its common slots.

    A task reports the slots of hashes that a given share of its documents hit, clearly above the
    mean; a shingle that common overall is so in one task at least.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, docs = np.zeros(1 << SLOT_BITS, dtype=np.int64), 0
        for batch in batches:
            sizes, signatures = [], []
            for own in text_sets(batch["text"], width):
                np.add.at(seen, (own >> np.uint64(64 - SLOT_BITS)).astype(np.int64), 1)
                sizes.append(len(own))
                signatures.append(signature(own))
            docs += len(sizes)
            yield pd.DataFrame({"id": batch["id"], "n": sizes, "key": signatures})
        at = np.flatnonzero(seen >= max(4, docs * COMMON_SHARE) + 4 * seen.mean())
        yield pd.DataFrame({"id": pd.Series([None] * len(at), dtype=object), "n": -seen[at], "key": at})

    told = exact(docs, ["id", "text"]).mapInPandas(run, "id string, n long, key long")
    return told.withColumn("id", F.col("id").cast("long")).checkpoint()


def common_classes(surveyed: DataFrame) -> np.ndarray:
    """For each slot the logarithm of how often it was reported (at most ``2 ** SLOT_BITS`` sums)."""
    rows = surveyed.where("n < 0").groupBy("key").agg((-F.sum("n")).alias("n")).toPandas()
    classes = np.zeros(1 << SLOT_BITS, dtype=np.uint8)
    if len(rows):
        classes[rows["key"].to_numpy(np.int64)] = np.minimum(np.log2(rows["n"].to_numpy(np.float64)) + 1, 60)
    return classes


def prefix_rows(docs: DataFrame, classes: np.ndarray, width: int, similarity: int) -> DataFrame:
    """(token, n, sig) for the prefix of every set under the first order; within a batch of rows
    copies of a set count once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        order = Order(classes, 0)
        for batch in batches:
            done, parts, size = set(), [], 0
            for own in text_sets(batch["text"], width):
                if not len(own) or (sig := signature(own)) in done:
                    continue
                done.add(sig)
                prefix = order.prefix(own, similarity)
                parts.append((signed(prefix), len(own), sig))
                size += len(prefix)
                if size > 1 << 18:
                    yield _table(parts)
                    parts, size = [], 0
            if parts:
                yield _table(parts)

    return docs.select("text").mapInPandas(run, "token long, n long, sig long")


def _table(parts: list[tuple[np.ndarray, int, int]]) -> pd.DataFrame:
    times = [len(p) for p, _, _ in parts]
    return pd.DataFrame(
        {
            "token": np.concatenate([p for p, _, _ in parts]),
            "n": np.repeat([n for _, n, _ in parts], times),
            "sig": np.repeat(np.array([s for _, _, s in parts], dtype=np.int64), times),
        }
    )


def _runs(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Rows of sorted batches regrouped so that no run of equal keys is cut (for short runs only)."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        keys = batch[key].to_numpy()
        cut = int(np.searchsorted(keys, keys[-1], side="left"))
        if cut or (held and held[-1][key].iloc[-1] != keys[0]):
            whole = pd.concat([*held, batch.iloc[:cut]], ignore_index=True) if held else batch.iloc[:cut]
            if len(whole):
                yield whole
            held = [batch.iloc[cut:]]
        else:
            held.append(batch)
    if held:
        yield pd.concat(held, ignore_index=True)


def tagged_lists(batches: Iterator[pd.DataFrame], long_list: int) -> Iterator[pd.DataFrame]:
    """Rows, sorted by token and signature, of tokens that two different sets hold at least, each
    once; ``long`` tells those that ``long_list`` sets hold. Of a list no more rows wait than it
    takes to tell: a long one goes on batch by batch."""
    held, last = None, None  # the last token's rows while its list is short, else its last row's keys
    for batch in batches:
        part = batch if held is None else pd.concat([held, batch], ignore_index=True)
        token, sig = part["token"].to_numpy(), part["sig"].to_numpy()
        new = np.ones(len(part), dtype=bool)
        new[1:] = (token[1:] != token[:-1]) | (sig[1:] != sig[:-1])
        if last is not None and len(part):
            new[0] = (token[0], sig[0]) != last
        part, token, sig = part[new], token[new], sig[new]
        if not len(part):
            continue
        begin = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
        size = np.diff(np.concatenate((begin, [len(token)])))
        long = size >= long_list
        long[0] |= last is not None and token[0] == last[0]
        out = np.repeat(long | (size > 1), size)
        if long[-1]:
            held, last = None, (token[-1], sig[-1])
        else:
            held, last = part.iloc[begin[-1] :], None
            out[begin[-1] :] = False
        if out.any():
            yield part[out].assign(long=np.repeat(long, size)[out])
    if held is not None and len(held) > 1:
        yield held.assign(long=False)


def shared_rows(rows: DataFrame) -> DataFrame:
    """The rows of tokens that two different sets hold at least, each once; ``long`` tells the
    tokens of long posting lists."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from tagged_lists(batches, LONG_LIST)

    schema = ", ".join(f"{c} long" for c in rows.columns)
    return rows.repartition("token").sortWithinPartitions("token", "sig").mapInPandas(run, f"{schema}, long boolean")


def listed_pairs(rows: DataFrame, similarity: int) -> DataFrame:
    """The pairs of sets of fitting size in short posting lists, with the number of lists (``c``)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _runs(batches, "token"):
            token, n, sig = (part[c].to_numpy() for c in ("token", "n", "sig"))
            left, right = [], []
            for k in range(1, min(LONG_LIST, len(part))):
                i = np.flatnonzero(token[k:] == token[:-k])
                if not len(i):
                    break
                left.append(i)
                right.append(i + k)
            if not left:
                continue
            i, j = np.concatenate(left), np.concatenate(right)
            fits = 100 * np.minimum(n[i], n[j]) >= similarity * np.maximum(n[i], n[j])
            i, j = i[fits], j[fits]
            if not len(i):
                continue
            swap = sig[i] > sig[j]
            i, j = np.where(swap, j, i), np.where(swap, i, j)
            found = pd.DataFrame({"a": sig[i], "b": sig[j], "na": n[i], "nb": n[j]})
            yield found.groupby(["a", "b", "na", "nb"], as_index=False).size().rename(columns={"size": "c"})

    schema = "a long, b long, na long, nb long, c long"
    short = rows.where("not long").select("token", "n", "sig")
    return short.repartition("token").sortWithinPartitions("token").mapInPandas(run, schema)


def blocks_of(long: DataFrame, share: int = 0) -> tuple[DataFrame, DataFrame]:
    """Members (sig, n, token) of long posting lists in blocks of bounded size, and the pairs of
    blocks that meet in lists. The home of a set is its least long list, so like sets sit together.

    Sets that link have ``share`` hundredths of their size of long lists in common (one at least);
    sets in fewer, and blocks that meet in fewer, are left out.
    """
    least = F.greatest(F.lit(1), F.ceil(F.col("n") * share / 100))
    home = long.groupBy("sig", "n").agg(F.min("token").alias("home"), F.count("*").alias("lists")).where(F.col("lists") >= least)
    blocks = home.groupBy("home").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / (8192 * BLOCK))).alias("blocks")
    )
    members = home.join(blocks, "home").select(
        "sig", F.xxhash64("home", F.pmod(F.xxhash64("sig"), "blocks")).alias("block"), least.alias("least")
    )
    by_token = long.join(members, "sig").groupBy("token", "block").agg(F.min("least").alias("least"))
    pairs = (
        by_token.select("token", F.col("block").alias("p"), F.col("least").alias("lp"))
        .join(by_token.select("token", F.col("block").alias("q"), F.col("least").alias("lq")), "token")
        .where("p <= q")
        .groupBy("p", "q")
        .agg(F.count("*").alias("lists"), F.min(F.least("lp", "lq")).alias("least"))
        .where("lists >= least")
        .select("p", "q")
    )
    return members.drop("least"), pairs


def unpack(tokens: bytes) -> np.ndarray:
    return np.frombuffer(tokens, dtype=np.uint64)


def links(a: np.ndarray, b: np.ndarray, similarity: int) -> bool:
    """Whether two sorted sets are at least ``similarity`` hundredths alike."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= similarity * (len(a) + len(b) - both)


def verify_pairs(pairs: DataFrame, sets: DataFrame, classes: np.ndarray | None, similarity: int) -> DataFrame:
    """Pairs (a, b) that really link; with ``classes``, those first that share enough of their
    prefixes under all further orders."""
    second = sets.select(F.col("sig").alias("b"), F.col("tokens").alias("tokens_b"))
    first = sets.select(F.col("sig").alias("a"), F.col("tokens").alias("tokens_a"))
    both = pairs.select("a", "b").join(second, "b").join(first, "a")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        orders = [Order(classes, i) for i in range(1, len(ORDERS))] if classes is not None else []
        for batch in batches:
            good = []
            for a, b in zip(batch["tokens_a"], batch["tokens_b"], strict=True):
                a, b = unpack(a), unpack(b)
                least = min(extra(len(a)), extra(len(b)))
                good.append(
                    all(
                        np.isin(o.prefix(a, similarity), o.prefix(b, similarity), assume_unique=True).sum() >= least
                        for o in orders
                    )
                    and links(a, b, similarity)
                )
            yield pd.DataFrame({"u": batch["a"][good], "v": batch["b"][good]})

    return both.mapInPandas(run, "u long, v long")


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Numbers of common tokens of all sets of one block with all of another."""
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    tokens = np.concatenate([*left, *right])
    token, at = np.unique(tokens, return_inverse=True)
    row = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in (*left, *right)])
    for begin in range(0, len(token), 8192):
        here = (at >= begin) & (at < begin + 8192)
        table = np.zeros((len(left) + len(right), min(8192, len(token) - begin)), dtype=np.float32)
        table[row[here], at[here] - begin] = 1
        out += table[: len(left)] @ table[len(left) :].T
    return out.astype(np.int64)


def verify_blocks(members: DataFrame, block_pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Links inside and between blocks of long posting lists, as spanning edges of each block pair."""
    owned = members.join(sets, "sig").select("block", "sig", "tokens")
    first = block_pairs.join(owned.withColumnRenamed("block", "p"), "p").withColumn("side", F.lit(0))
    second = block_pairs.where("p <> q").join(owned.withColumnRenamed("block", "q"), "q").withColumn("side", F.lit(1))
    both = first.unionByName(second)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        left, right = group[group["side"] == 0], group[group["side"] == 1]
        if not len(right):
            right = left
        a, b = [unpack(t) for t in left["tokens"]], [unpack(t) for t in right["tokens"]]
        both = _overlaps(a, b)
        na, nb = np.array([len(s) for s in a])[:, None], np.array([len(s) for s in b])[None, :]
        i, j = np.nonzero(100 * both >= similarity * (na + nb - both))
        u, v = left["sig"].to_numpy()[i], right["sig"].to_numpy()[j]
        top: dict[int, int] = {}

        def find(x: int) -> int:
            while top.setdefault(x, x) != x:
                top[x] = x = top[top[x]]
            return x

        kept = []
        for x, y in zip(u.tolist(), v.tolist(), strict=True):
            if x != y and find(x) != find(y):
                top[find(x)] = find(y)
                kept.append((x, y))
        return pd.DataFrame(kept, columns=["u", "v"], dtype=np.int64)

    return both.groupBy("p", "q").applyInPandas(run, "u long, v long")


def jaccard_components(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    similarity: int = SIMILARITY,
) -> DataFrame:
    """``id_col``, ``n_shingles`` and ``component_id`` for every row of ``df``.

    The exact join: a set and another link when they share ``similarity`` hundredths of their union;
    a component is named by the least id in it. A text of fewer words than ``width`` is one shingle;
    null texts and texts without words have an empty set and link with nothing, so each is its own
    component. A row without an id is returned with a null component; rows that share an id are one
    document (their sets belong to one component) and each is returned; an empty table gives no
    rows; other columns are not read. Ids are integers.

    Copies of a set are one set from the first step on. Prefixes are a fixed share longer than the
    least that linked sets must have in common, so linked sets share that share of them: sets, then
    pairs, with fewer common prefix shingles go before any text is fetched. The other orders filter
    again where the sets meet. Long posting lists are compared in blocks that emit spanning edges.
    """
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    surveyed = survey(docs, width)
    classes = common_classes(surveyed)
    info = surveyed.where("n >= 0")
    representative = info.where("n > 0 and id is not null").groupBy(F.col("key").alias("sig")).agg(F.min("id").alias("rep"), F.max("n").alias("n"))

    known = docs.where("id is not null")
    shared = shared_rows(prefix_rows(known, classes, width, similarity)).checkpoint()
    release_shuffles(df.sparkSession)
    own = F.count("*").over(Window.partitionBy("sig"))
    enough = shared.withColumn("own", own).where(F.col("own") >= F.ceil(F.col("n") * EXTRA / 100)).drop("own").checkpoint()
    listed = listed_pairs(enough, similarity)

    # of their common prefix shingles, linked sets have half in short lists or half in long ones
    least = F.ceil(F.least("na", "nb") * EXTRA / 200)
    pairs = listed.groupBy("a", "b", "na", "nb").agg(F.sum("c").alias("c")).where(F.col("c") >= least).select("a", "b")
    long = enough.where("long").select("sig", "token", "n")
    members, block_pairs = blocks_of(long, EXTRA // 2)
    pairs, members = pairs.checkpoint(), members.checkpoint()
    wanted = pairs.select(F.col("a").alias("sig")).union(pairs.select("b")).union(members.select("sig")).distinct()
    wanted = wanted.join(representative, "sig").select("sig", F.col("rep").alias("id")).checkpoint()

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [own for own in text_sets(batch["text"], width)]
            yield pd.DataFrame({"sig": [signature(own) for own in found], "tokens": [own.tobytes() for own in found]})

    fetched = known.join(wanted.select("id").distinct(), "id", "left_semi").select("text")
    sets = fetched.mapInPandas(load, "sig long, tokens binary")
    sets = sets.join(wanted.select("sig"), "sig", "left_semi").dropDuplicates(["sig"]).checkpoint()
    release_shuffles(df.sparkSession)
    edges = verify_pairs(pairs, sets, classes, similarity).unionByName(verify_blocks(members, block_pairs, sets, similarity))

    reps = representative.select("sig", "rep")
    edges = (
        edges.join(reps.select(F.col("sig").alias("u"), F.col("rep").alias("ru")), "u")
        .join(reps.select(F.col("sig").alias("v"), F.col("rep").alias("rv")), "v")
        .select(F.col("ru").alias("u"), F.col("rv").alias("v"))
    )
    placed = info.join(reps, F.col("key") == F.col("sig"), "left").select(
        "id", "n", F.when(F.col("n") > 0, F.col("rep")).otherwise(F.col("id")).alias("rep")
    )
    same_id = placed.where("id is not null").groupBy("id").agg(F.min("rep").alias("v"), F.max("rep").alias("w")).where("v <> w")
    again = placed.join(same_id, "id").select(F.col("rep").alias("u"), "v")
    parts = connected_components(edges.unionByName(again))
    return placed.join(parts, F.col("rep") == F.col("node"), "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("component", "rep")).alias("component_id")
    )
