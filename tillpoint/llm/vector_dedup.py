"""Near-duplicate embeddings: p-stable hashing of normalised vectors, then exact cosines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.components import connected_components
from tillpoint.llm.textops import mix64, signed

COSINE = 0.98
#: Hash tables, projections in each, and the width of a quantised projection. Unit vectors of cosine
#: 0.98 lie 0.2 apart and fall together in one projection with probability 0.84, so that a table
#: finds them with 0.175 and all tables together with 0.999. Unlike vectors fall together in one
#: projection with 0.27, in a table with two in a million.
TABLES, PROJECTIONS, CELL = 36, 10, 1.0
#: Vectors of a block; a fuller bucket is compared block against block. Buckets of up to SMALL vectors
#: are compared many at a time.
BLOCK, SMALL = 512, 8
SEED = 41


def bucket_keys(unit: np.ndarray, labels: np.ndarray, tables: int, projections: int, cell: float) -> np.ndarray:
    """A key for each vector and table: equal where label, dimension and all quantised projections are."""
    n, dim = unit.shape
    rng = np.random.default_rng([SEED, dim])
    directions = rng.standard_normal((dim, tables * projections))
    offsets = rng.uniform(0, cell, tables * projections)
    codes = np.floor((unit @ directions + offsets) / cell).astype(np.int64).view(np.uint64)
    codes = codes.reshape(n, tables, projections)
    with np.errstate(over="ignore"):
        key = mix64(labels.astype(np.int64).view(np.uint64) * np.uint64(2 * dim + 1))[:, None] + mix64(np.arange(tables, dtype=np.uint64))
        for k in range(projections):
            key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + codes[:, :, k])
    return signed(key)


def compare(group: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Links of one block of a bucket, or between two: per vector how many, and spanning edges.

    A pair counts in the first table in which it falls together, so once over all buckets.
    """
    table = int(group["table"].iloc[0])
    same = group["i"].iloc[0] == group["j"].iloc[0]
    left = group if same else group[group["salt"] == group["i"]]
    right = group if same else group[group["salt"] == group["j"]]
    if not len(left) or not len(right):
        return pd.DataFrame({"u": [], "v": [], "n": []}, dtype=np.int64)
    a, b = (np.frombuffer(b"".join(s["unit"]), dtype=np.float64).reshape(len(s), -1) for s in (left, right))
    i, j = np.nonzero(a @ b.T >= cosine)
    if same:
        i, j = i[i < j], j[i < j]
    ka, kb = (np.frombuffer(b"".join(s["keys"]), dtype=np.int64).reshape(len(s), -1) for s in (left, right))
    if table:
        new = ~(ka[i, :table] == kb[j, :table]).any(axis=1)
        i, j = i[new], j[new]
    u, v = left["rep"].to_numpy(), right["rep"].to_numpy()
    counted = [
        pd.DataFrame({"u": u, "v": u, "n": np.bincount(i, weights=right["copies"].to_numpy()[j], minlength=len(u))}),
        pd.DataFrame({"u": v, "v": v, "n": np.bincount(j, weights=left["copies"].to_numpy()[i], minlength=len(v))}),
    ]
    out = pd.concat(counted).astype(np.int64)
    out = out[out["n"] > 0]
    top: dict[int, int] = {}

    def find(x: int) -> int:
        while top.setdefault(x, x) != x:
            top[x] = x = top[top[x]]
        return x

    edges = []
    for x, y in zip(u[i].tolist(), v[j].tolist(), strict=True):
        if (p := find(x)) != (q := find(y)):
            top[p] = q
            edges.append((x, y, 0))
    return pd.concat([out, pd.DataFrame(edges, columns=["u", "v", "n"], dtype=np.int64)])


def compare_small(members: pd.DataFrame, first: np.ndarray, size: np.ndarray, cosine: float) -> pd.DataFrame:
    """The same for many small whole buckets at once: rows ``first`` to ``first + size`` are one each."""
    place = np.arange(len(members)) - np.repeat(first, size)
    right = np.repeat(np.arange(len(members)), place)  # every row against those before it in its bucket
    ends = np.cumsum(place)
    left = np.arange(len(right)) - np.repeat(ends - place, place) + np.repeat(np.repeat(first, size), place)
    unit = np.frombuffer(b"".join(members["unit"]), dtype=np.float64).reshape(len(members), -1)
    near = np.flatnonzero(np.einsum("ij,ij->i", unit[left], unit[right]) >= cosine)
    left, right = left[near], right[near]
    keys = np.frombuffer(b"".join(members["keys"]), dtype=np.int64).reshape(len(members), -1)
    table = members["table"].to_numpy()
    earlier = (keys[left] == keys[right]) & (np.arange(keys.shape[1]) < table[left][:, None])
    new = ~earlier.any(axis=1)
    left, right = left[new], right[new]
    rep, copies = members["rep"].to_numpy(), members["copies"].to_numpy()
    none = np.zeros(len(left), np.int64)
    return pd.DataFrame(
        {
            "u": np.concatenate([rep[left], rep[right], rep[left]]),
            "v": np.concatenate([rep[left], rep[right], rep[right]]),
            "n": np.concatenate([copies[right], copies[left], none]),
        }
    )


def compare_sorted(batches: Iterator[pd.DataFrame], cosine: float) -> Iterator[pd.DataFrame]:
    """Links of blocks that come one after the other, each whole but cut anywhere by the batches."""
    carried: list[pd.DataFrame] = []

    def linked(members: pd.DataFrame) -> Iterator[pd.DataFrame]:
        members = members.reset_index(drop=True)
        where = members[["bucket", "i", "j"]].to_numpy()
        first = np.flatnonzero(np.concatenate(([True], (where[1:] != where[:-1]).any(axis=1))))
        size = np.diff(np.append(first, len(members)))
        small = (size <= SMALL) & (where[first, 1] == where[first, 2])
        length = members["unit"].map(len).to_numpy()
        for n in np.unique(length[first[small]]).tolist():  # a bucket holds vectors of one length
            own = small & (length[first] == n)
            rows = members[np.repeat(own, size)].reset_index(drop=True)
            sizes = size[own]
            yield compare_small(rows, np.cumsum(sizes) - sizes, sizes, cosine)
        for at, n in zip(first[~small].tolist(), size[~small].tolist(), strict=True):
            yield compare(members.iloc[at : at + n], cosine)

    for batch in batches:
        if not len(batch):
            continue
        carried.append(batch)
        where = batch[["bucket", "i", "j"]].to_numpy()
        fresh = np.flatnonzero((where != where[-1]).any(axis=1))
        if len(fresh):  # all blocks before the batch's last one are whole
            cut = int(fresh[-1]) + 1
            yield from linked(pd.concat([*carried[:-1], batch.iloc[:cut]]))
            carried = [batch.iloc[cut:]]
    if carried:
        yield from linked(pd.concat(carried))


def near_vectors(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str | None = "label",
    cosine: float = COSINE,
    tables: int = TABLES,
    projections: int = PROJECTIONS,
    cell: float = CELL,
) -> DataFrame:
    """``id_col``, ``n_links``, ``component_id`` and ``kept`` for every row.

    Vectors link when their labels are equal and not null and their cosine, in double precision, is
    at least ``cosine``; the candidates are vectors that share a bucket of any table. Vectors that
    are null, empty, zero, or hold null or non-finite components, and rows without a label or an id,
    link with nothing: they are components of their own (null for a null id, not kept). Equal
    vectors of one label are compared once and counted in full; a repeated row is a vector of its
    own with the same id. Vectors of different length never link. Ids are integers.

    Only buckets that hold two vectors receive their components, and full ones are cut into blocks
    of bounded size; what leaves a block are counts and spanning edges, never all its pairs.
    """
    vector = F.col(vector_col).cast("array<double>")
    label = F.col(label_col).cast("long") if label_col else F.lit(0).cast("long")
    rows = df.select(F.col(id_col).cast("long").alias("id"), vector.alias("vector"), label.alias("label"))
    fine = ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("vector", lambda x: x != 0)
    usable = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & fine & some
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    rows = rows.withColumn("h1", F.xxhash64("vector")).withColumn("h2", F.xxhash64(F.reverse("vector"), F.lit(1)))
    copies = (
        rows.where("usable")
        .groupBy("label", "h1", "h2")
        .agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
    )

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, part in batch.groupby(batch["vector"].map(len)):
                x = np.stack(part["vector"].to_list()).astype(np.float64)
                x /= np.abs(x).max(axis=1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                keys = bucket_keys(x, part["label"].to_numpy(), tables, projections, cell)
                out = part[["label", "h1", "h2", "rep", "copies"]].copy()
                out["unit"], out["keys"] = [v.tobytes() for v in x], [k.tobytes() for k in keys]
                out["buckets"] = list(keys)
                yield out

    schema = "label long, h1 long, h2 long, rep long, copies long, unit binary, keys binary, buckets array<long>"
    known = copies.mapInPandas(hashed, schema).checkpoint()
    spread = known.select("label", "h1", "h2", F.posexplode("buckets").alias("table", "bucket"))
    full = spread.groupBy("bucket").agg(F.count("*").alias("held")).where("held > 1")
    placed = (
        spread.join(full, "bucket")
        .withColumn("blocks", F.ceil(F.col("held") / BLOCK).cast("int"))
        .withColumn("salt", F.pmod(F.xxhash64("h1", "h2", "table"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("salt", "other"))
        .withColumn("j", F.greatest("salt", "other"))
    )
    members = placed.join(known.select("label", "h1", "h2", "rep", "copies", "unit", "keys"), ["label", "h1", "h2"])
    found = members.select("bucket", "i", "j", "table", "salt", "rep", "copies", "unit", "keys")
    found = found.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    found = found.mapInPandas(lambda batches: compare_sorted(batches, cosine), "u long, v long, n long").checkpoint()
    linked = found.where("n > 0").groupBy(F.col("u").alias("rep")).agg(F.sum("n").alias("n"))
    parts = connected_components(found.where("n = 0").select("u", "v"))
    groups = (
        known.select("label", "h1", "h2", "rep", "copies")
        .join(linked, "rep", "left")
        .join(parts, F.col("rep") == F.col("node"), "left")
        .select(
            "label",
            "h1",
            "h2",
            F.lit(True).alias("usable"),
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    out = rows.drop("vector").join(groups, ["label", "h1", "h2", "usable"], "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
