"""Language identification by rank-order n-gram profiles and out-of-place distance."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.llm.tables import ddl, exact, restored

#: Ranks of a profile, of a document as of a language.
PROFILE = 300
#: Labelled rows (in expectation) from which the language profiles are counted.
TRAINING_ROWS = 20_000
#: Languages that a set of profiles may hold; more is an error, since profiles go to every task.
MOST_LANGUAGES = 2_000
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def grams(text: str) -> np.ndarray:
    """Codes of all runs of one to three characters; whatever is not a letter is one blank (0)."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    code[~_letters()[code]] = 0
    code = np.concatenate(([0], code, [0]))
    code = code[np.concatenate(([True], (code[1:] != 0) | (code[:-1] != 0)))]
    if len(code) < 3:
        return code[code > 0]
    one, two = code[code > 0], code[:-1] | code[1:] << 21
    return np.concatenate((one, two, code[:-2] | code[1:-1] << 21 | code[2:] << 42))


def top_grams(text: str, size: int) -> np.ndarray:
    """The most frequent n-grams in order; among equals the lower code first."""
    code, n = np.unique(grams(text), return_counts=True)
    return code[np.argsort(-n, kind="stable")[:size]]


class Profiles:
    """Language profiles in one table: the rank of each n-gram in each language."""

    def __init__(self, profiles: dict[str, list[int]], size: int = PROFILE) -> None:
        self.languages = sorted(profiles)
        self.size = size
        self.codes = np.unique(np.array([g for p in profiles.values() for g in p], dtype=np.int64))
        self.rank = np.full((len(self.languages), len(self.codes) + 1), -1, dtype=np.int32)
        for row, name in enumerate(self.languages):
            known = np.array(profiles[name], dtype=np.int64)
            self.rank[row, np.searchsorted(self.codes, known)] = np.arange(len(known))

    def distances(self, text: str) -> np.ndarray | None:
        """Out-of-place distance to each language, as a share of the largest possible."""
        own = top_grams(text, self.size)
        if not len(own) or not self.languages:
            return None
        at = np.minimum(np.searchsorted(self.codes, own), max(len(self.codes) - 1, 0))
        at[self.codes[at] != own] = len(self.codes)
        rank = self.rank[:, at]
        place = np.where(rank < 0, self.size, np.abs(rank - np.arange(len(own))))
        return place.sum(axis=1) / (len(own) * self.size)

    def predict(self, text: str | None) -> tuple[str, float]:
        """The nearest language (the first by name among equals), and the distance of the second
        as a share of both: 0.5 if they are as near, 1 if the first fits exactly."""
        far = self.distances(text) if text else None
        if far is None:
            return UNKNOWN, 0.0
        order = np.argsort(far, kind="stable")
        first = float(far[order[0]])
        second = float(far[order[1]]) if len(far) > 1 else 1.0
        return self.languages[order[0]], second / (first + second) if first + second else 0.5


def learn_profiles(
    labelled: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    id_col: str = "doc_id",
    size: int = PROFILE,
    rows: int = TRAINING_ROWS,
) -> dict[str, list[int]]:
    """Rank-order profiles of the languages in ``labelled``.

    N-grams are counted on the executors over about ``rows`` rows, chosen by a hash of the id
    (all rows if there are fewer). Rows without text, id or language are left out. What comes to
    the driver is ``size`` n-grams a language.
    """
    known = labelled.where(F.col(text_col).isNotNull() & F.col(id_col).isNotNull() & F.col(lang_col).isNotNull())
    n = known.count()
    if n > rows:
        share = rows / n
        known = known.where(F.xxhash64(F.col(id_col), F.lit(4)) < F.lit(int(-(2**63) + share * (2**64 - 1))))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                found = [np.unique(grams(t), return_counts=True) for t in texts]
                code, at = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
                n = np.bincount(at, weights=np.concatenate([k for _, k in found]), minlength=len(code))
                yield pd.DataFrame({"lang": lang, "gram": code, "n": n.astype(np.int64)})

    counts = (
        known.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
        .mapInPandas(count, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
    listed = top.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("rank", "gram"))).alias("grams"))
    found = listed.limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages in {lang_col}")
    return {r["lang"]: [g["gram"] for g in r["grams"]] for r in found}


def identify(
    df: DataFrame, profiles: dict[str, list[int]], keep: list[Column | str], text_col: str = "text", size: int = PROFILE
) -> DataFrame:
    """Columns ``keep`` of ``df`` with ``lang_pred`` and ``score`` (0 to 1) for every whole text.

    Only the text is looked at. A null text, or one without a letter, is ``und`` with score 0.0,
    as is every text if there are no profiles. Repeated rows give repeated results.
    """
    rows = df.select(*keep, F.col(text_col).alias("_text"))
    kept = rows.columns[:-1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = Profiles(profiles, size)
        for batch in batches:
            found = [model.predict(t if isinstance(t, str) else None) for t in batch["_text"]]
            out = batch[kept].copy()
            out["lang_pred"], out["score"] = [f[0] for f in found], [float(f[1]) for f in found]
            yield out

    sent = exact(rows, rows.columns)
    return restored(sent.mapInPandas(run, f"{ddl(sent.drop('_text'))}, lang_pred string, score double"), rows.schema)


def held_out(id_col: str, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder ``part`` (a null id: no)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % parts == part, F.lit(False))


def language_report(documents: DataFrame) -> DataFrame:
    """Predictions for all documents, learned from those that are not held out."""
    aside = held_out("doc_id", 4, 2)
    profiles = learn_profiles(documents.where(~aside))
    return identify(documents, profiles, ["doc_id", aside.alias("held_out")])
