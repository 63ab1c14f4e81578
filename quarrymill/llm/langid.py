"""Language identification by rank-order profiles.

A language's profile is the list of its most frequent character n-grams (one to three letters, words padded with a
blank); a document's list is compared to each profile by the out-of-place distance: the sum over the document's n-grams
of how far the rank differs, n-grams that a profile lacks counting as the profile's length. The nearest profile wins.

An n-gram's code holds the lower-cased code points themselves, 21 bits each, so letters of any script stay apart and no
two n-grams share a code. Profiles are counted over all training documents on the executors, which hand on their counts
whenever they hold `HELD` n-grams: memory is bounded whatever the number of languages. The driver gets at most `SIZE`
codes for each language.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.llm.common import arrow_blobs, worker_cache

SIZE = 300  # n-grams of a profile and of a document
HELD = 1 << 21  # n-grams that a task holds uncounted
SPREAD = 6.0  # standard deviations above the mean distance of training documents beyond which a language is not known
UNKNOWN = "und"
BLANK = 1


def letters() -> np.ndarray:
    """For each code point: its lower-case form (the first code point of it) for a letter, 0 for anything else."""
    cache = worker_cache()
    if "letters" not in cache:
        table = np.zeros(0x110000, np.int64)
        for cp in range(0x110000):
            if unicodedata.category(chr(cp))[0] == "L":
                table[cp] = ord(chr(cp).lower()[0])
        cache["letters"] = table
    return cache["letters"]


def ngram_codes(raw: bytes) -> np.ndarray:
    """Codes of all n-grams of the UTF-8 text, n from 1 to 3; those of blanks alone are left out."""
    points = np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    found = letters()[points]
    keep = np.ones(len(found), bool)
    keep[1:] = (found[1:] > 0) | (found[:-1] > 0)  # runs of other characters are one blank
    padded = np.concatenate([[0], found[keep], [0]])
    there = padded > 0
    padded[~there] = BLANK
    two = (padded[:-1] << 21) | padded[1:]
    three = (two[:-1] << 21) | padded[2:]
    return np.concatenate([padded[there], two[there[:-1] | there[1:]], three[there[1:-1]]])  # one of three has a letter within


def counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different codes, sorted, and how often each occurs."""
    codes = np.sort(codes)
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
    return codes[first], np.diff(first, append=len(codes))


def ranked(counts: np.ndarray, codes: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The `size` most frequent codes, most frequent first, ties to the smaller code."""
    if len(codes) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        near = counts >= least
        counts, codes = counts[near], codes[near]
    return codes[np.lexsort((codes, -counts))][:size]


def is_training() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) != 2


def train(docs: DataFrame, size: int = SIZE) -> dict[str, np.ndarray]:
    """The profile of each language of docs (columns text and lang), over all its rows; rows with null lang are left out.

    The driver receives at most `size` codes per language.
    """
    schema = pa.schema([("lang", pa.string()), ("code", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[np.ndarray]] = {}
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, parts in waiting.items():
                codes, n = counted(np.concatenate(parts))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(n)], schema=schema)
            waiting.clear()

        for batch in batches:
            for lang, raw in zip(batch.column(0).to_pylist(), arrow_blobs(batch.column(1)), strict=True):
                waiting.setdefault(lang, []).append(ngram_codes(raw))
                held += len(waiting[lang][-1])
                if held > HELD:
                    yield from flush()
                    held = 0
        yield from flush()

    sums = docs.where("lang IS NOT NULL").select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    top = sums.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size).select("lang", "rank", "code")
    profiles: dict[str, np.ndarray] = {}
    for lang, codes in top.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("rank", "code"))).alias("c")).orderBy("lang").collect():
        profiles[lang] = np.array([c.code for c in codes], np.int64)
    return profiles


class Scorer:
    """The nearest profile of a text. Holds a list of (language, rank) for each code that some profile has, so its size is
    the sum of the profiles'."""

    def __init__(self, profiles: dict[str, np.ndarray], size: int):
        self.names, self.size = sorted(profiles), size
        codes = np.concatenate([profiles[n] for n in self.names] or [np.zeros(0, np.int64)])
        places = np.concatenate([np.arange(len(profiles[n])) for n in self.names] or [np.zeros(0, np.int64)])
        owner = np.repeat(np.arange(len(self.names)), [len(profiles[n]) for n in self.names])
        order = np.argsort(codes, kind="stable")
        self.codes, self.places, self.owner = codes[order], places[order], owner[order]

    def distances(self, raw: bytes) -> tuple[np.ndarray, int]:
        """The distance to each profile, and the number of the text's n-grams that count."""
        codes, counts = counted(ngram_codes(raw))
        own = ranked(counts, codes, self.size)
        low, high = (np.searchsorted(self.codes, own, side=side) for side in ("left", "right"))
        many = high - low
        at = np.arange(many.sum()) + np.repeat(low - np.cumsum(many) + many, many)  # all entries of all own codes
        nearer = self.size - np.abs(self.places[at] - np.repeat(np.arange(len(own)), many))
        return len(own) * self.size - np.bincount(self.owner[at], weights=nearer, minlength=len(self.names)).astype(np.int64), len(own)

    def nearest(self, raw: bytes) -> tuple[str, float, float]:
        """Language, margin over the next one, and the distance as a share of the largest possible."""
        distance, many = self.distances(raw)
        if not many or not self.names:
            return UNKNOWN, 0.0, 1.0
        order = np.argsort(distance, kind="stable")
        most = self.size * many
        best = int(distance[order[0]])
        rival = int(distance[order[1]]) if len(self.names) > 1 else most
        return self.names[order[0]], (rival - best) / rival if rival else 0.0, best / most


def predict(docs: DataFrame, profiles: dict[str, np.ndarray], size: int = SIZE) -> DataFrame:
    """doc_id, lang_pred, score and distance for every row of docs, one pass without a shuffle.

    score is the margin of the nearest profile over the next, as a share of the next one's distance (with one profile:
    how much nearer than the farthest possible); distance is a share of the farthest possible. Text that is null or has no
    letter: `und` with score 0 and distance 1; so is every text when no profile was learnt. Equal distances go to the
    first language by name. Texts of any length count whole.
    """
    scorer = Scorer(profiles, size)
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("distance", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scorer.nearest(raw) for raw in arrow_blobs(batch.column(1))]
            columns = [pa.array([x[i] for x in found], f.type) for i, f in enumerate(list(schema)[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double, distance double")


def identify(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """Learns from the training rows of docs (crc32 of doc_id as text, modulo 4, is not 2; lang not null) and predicts
    the language of every row: doc_id, held_out, lang_pred, score, distance. A null doc_id counts as held out. Rows that
    repeat give equal results; other columns are left aside; an empty table gives an empty result."""
    profiles = train(docs.where(is_training()), size)
    found = predict(docs, profiles, size)
    return found.select("doc_id", F.coalesce(~is_training(), F.lit(True)).alias("held_out"), "lang_pred", "score", "distance")


def farthest(docs: DataFrame, profiles: dict[str, np.ndarray], size: int = SIZE, spread: float = SPREAD) -> float:
    """The distance, as a share, beyond which a text is in none of the languages: `spread` standard deviations above the
    mean of docs, which are all training rows with a letter, and at least halfway from that mean to the farthest."""
    own = predict(docs.where("lang IS NOT NULL"), profiles, size).where(F.col("lang_pred") != UNKNOWN)
    mean, deviation = own.agg(F.avg("distance"), F.stddev_pop("distance")).first()
    return 1.0 if mean is None else max(mean + spread * deviation, (1 + mean) / 2)


def keep_known(docs: DataFrame, size: int = SIZE, spread: float = SPREAD) -> DataFrame:
    """docs without the rows whose language is not known: texts that are null or have no letter, and texts whose distance
    to the nearest profile is beyond that of training documents (`farthest`), such as other languages and random letters.

    All columns are kept and no row is changed; rows that repeat stay or go together. The verdict depends on text alone.
    Where nothing can be learnt (no row, or no lang), every text counts as unknown, and an empty table stays empty.
    """
    training = docs.where(is_training())
    profiles = train(training, size)
    scorer, limit = Scorer(profiles, size), farthest(training, profiles, size, spread)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scorer.nearest(raw) for raw in arrow_blobs(batch.column(batch.schema.get_field_index("text")))]
            yield batch.filter(pa.array([lang != UNKNOWN and distance <= limit for lang, _, distance in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
