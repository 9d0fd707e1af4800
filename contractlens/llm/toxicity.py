"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; any other text is unlabelled, so a missing
mark is no proof of a clean text. The class prior corrects the risk of the unlabelled
texts for the toxic ones among them, and where the corrected risk turns negative (a
classifier that memorises its positives), the step goes the other way. A linear
classifier over hashed words and word beginnings, in numpy.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contractlens.llm.bpe import Memo
from contractlens.llm.common import id_and_text, per_worker, slices
from contractlens.session import cut_lineage

#: Weights: the bound of what is broadcast.
FEATURES = 1 << 18
#: Training texts at most, of each kind; all documents are scored.
POSITIVES, UNLABELLED = 4_000, 8_000
#: Standard errors that a feature's shares must differ by.
LEAST_Z = 5.0
#: Word beginnings that count as features of their own.
BEGINNINGS = (4, 5, 6)
#: ASCII signs and digits separate words, as white space does.
_TABLE = bytes(
    c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256)
)


def word_features(word: bytes) -> tuple[int, ...]:
    text = word.decode("utf-8", "ignore")
    parts = {text, *(text[:n] + "*" for n in BEGINNINGS if len(text) >= n)}
    return tuple(1 + zlib.crc32(p.encode()) % (FEATURES - 1) for p in sorted(parts))


def features(text: str) -> np.ndarray:
    """Numbers of the features that a text has; 0, the bias, is always there."""
    memo = per_worker("toxicity", ("words",), lambda: Memo(word_features))
    words = set(text.lower().encode().translate(_TABLE).split())
    found = set(chain.from_iterable(map(memo.__getitem__, words)))
    found.add(0)
    return np.fromiter(found, np.uint32, len(found))


@dataclass
class Sample:
    """Texts as rows of feature numbers, one after the other."""

    numbers: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, rows: list[np.ndarray]) -> Sample:
        lengths = np.array([len(r) for r in rows], np.int64)
        numbers = np.concatenate(rows) if rows else np.zeros(0, np.uint32)
        return cls(numbers, np.concatenate([[0], np.cumsum(lengths)]))

    def only(self, chosen: np.ndarray, place: np.ndarray) -> Sample:
        """The chosen features, renumbered."""
        keep = chosen[self.numbers]
        before = np.concatenate([[0], np.cumsum(keep)])
        return Sample(place[self.numbers[keep]], before[self.starts])

    def __len__(self) -> int:
        return len(self.starts) - 1


def margins(weights: np.ndarray, rows: Sample) -> np.ndarray:
    """The margin of every text; positive means toxic."""
    if not len(rows):
        return np.zeros(0)
    return np.add.reduceat(weights[rows.numbers], rows.starts[:-1])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _gradient(rows: Sample, slopes: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(rows.numbers, np.repeat(slopes, np.diff(rows.starts)), minlength=size)


def telling(positives: Sample, unlabelled: Sample, least: float = LEAST_Z) -> np.ndarray:
    """Which features to learn: the shares of texts that have them differ clearly.

    A two-sample test between positives and unlabelled texts, feature by feature. The
    others get no weight, so a long text doesn't gather the noise of its many words.
    """
    p = np.bincount(positives.numbers, minlength=FEATURES).astype(float)
    u = np.bincount(unlabelled.numbers, minlength=FEATURES).astype(float)
    n, m = len(positives), len(unlabelled)
    share = (p + u + 1) / (n + m + 2)
    z = np.abs(p / n - u / m) / np.sqrt(share * (1 - share) * (1 / n + 1 / m))
    chosen = z >= least
    chosen[0] = True
    return chosen


def train(
    positives: Sample, unlabelled: Sample, prior: float, steps: int = 300, rate: float = 0.05,
    decay: float = 0.1,
) -> np.ndarray:
    """Weights that minimise the non-negative risk with the logistic loss, by Adam.

    Without positives (or without any text) nothing can be learned: all weights are
    zero but the bias, which says clean.
    """
    weights = np.zeros(FEATURES)
    weights[0] = -2.0
    if not len(positives) or not len(unlabelled):
        return weights
    chosen = telling(positives, unlabelled)
    used = np.flatnonzero(chosen)
    place = np.zeros(FEATURES, np.uint32)
    place[used] = np.arange(len(used))
    p, u = (rows.only(chosen, place) for rows in (positives, unlabelled))
    own = weights[used]
    mean, square = np.zeros(len(used)), np.zeros(len(used))
    for step in range(1, steps + 1):
        mp, mu = margins(own, p), margins(own, u)
        # the logistic loss of calling a text clean is log(1 + exp(m)); toxic, log(1 + exp(-m))
        clean = np.logaddexp(0, mu).mean() - prior * np.logaddexp(0, mp).mean()
        up, uu = prior * _sigmoid(mp) / len(p), _sigmoid(mu) / len(u)
        if clean >= 0:
            slopes = -prior * _sigmoid(-mp) / len(p) - up, uu
        else:  # the step that takes the corrected risk back up
            slopes = up, -uu
        gradient = _gradient(p, slopes[0], len(used)) + _gradient(u, slopes[1], len(used)) + decay * own / len(used)
        mean += 0.1 * (gradient - mean)
        square += 0.01 * (gradient * gradient - square)
        own -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    weights[:] = 0
    weights[used] = own
    return weights


def held_out(doc_id: Column) -> Column:
    """Rows whose marks are never learned from. Rows without an id are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _some(ids: DataFrame, bound: int) -> DataFrame:
    """At most `bound` ids, the same on every run, spread evenly."""
    share = min(1.0, 1.2 * bound / max(1, ids.count()))
    place = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30))
    few = ids.filter(place <= int(share * (1 << 30)))
    return few.orderBy(place, "doc_id").limit(bound)


def _sampled(docs: DataFrame, ids: DataFrame) -> Sample:
    """Features of the documents with these ids, of which there is a bounded number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [features(text).tobytes() for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(rows, pa.binary())], ["doc_id", "numbers"])

    plain = docs.join(F.broadcast(cut_lineage(ids)), "doc_id").select("doc_id", "text")
    kind = dict(plain.dtypes)["doc_id"]
    rows = plain.mapInArrow(run, f"doc_id {kind}, numbers binary").collect()
    rows.sort(key=lambda r: (r.doc_id, r.numbers))
    return Sample.of([np.sort(np.frombuffer(r.numbers, np.uint32)) for r in rows])


def fit(
    docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED,
    id_col: str = "doc_id", text_col: str = "text",
) -> np.ndarray:
    """Weights of a classifier, learned from documents that are not held out.

    `labels` has doc_id and toxic. At most `positives` texts marked toxic and at most
    `unlabelled` texts of any kind, both chosen by a hash of the id, come to the
    driver as feature numbers; the class prior is the share of toxic marks among all
    marks that may be learned from.
    """
    plain = id_and_text(docs, id_col, text_col)
    usable = ~held_out(F.col("doc_id"))
    marks = labels.select("doc_id", "toxic").filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(usable)
    marks = cut_lineage(marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    prior = marks.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0]
    toxic = marks.filter("toxic = 1").select("doc_id")
    others = plain.select("doc_id").filter("doc_id IS NOT NULL").filter(usable).distinct()
    return train(
        _sampled(plain, _some(toxic, positives)), _sampled(plain, _some(others, unlabelled)), prior or 0.0
    )


def score_udf(spark: SparkSession, weights: np.ndarray):
    """A column function: the probability that a text is toxic. Null counts as empty."""
    shared = spark.sparkContext.broadcast(weights)

    def score(texts: pd.Series) -> pd.Series:
        values = [float(shared.value[features(text or "")].sum()) for text in texts]
        return pd.Series(_sigmoid(np.array(values, float)))

    return F.pandas_udf(score, "double")


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 if score >= 0.5) of every document.

    Only texts enter a score. No shuffle of texts; the weights are broadcast.

    Defined cases: a null text counts as empty, and an empty text has the score that the
    bias gives; repeated rows are scored each; marks of unknown documents count for the
    prior only; a document marked twice is toxic if one mark says so; without any toxic
    mark all documents are clean; further columns are left out; an empty table
    gives no rows.
    """
    weights = fit(docs, labels, id_col=id_col, text_col=text_col)
    score = score_udf(docs.sparkSession, weights)
    plain = id_and_text(docs, id_col, text_col)
    scored = plain.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents that are not predicted to be toxic, with all their columns.

    Defined cases: a null text counts as empty, and an empty text stays or goes by the
    bias alone, which says clean; a text of any length is scored whole; repeated rows are
    decided alike; rows without an id are scored like others; without any toxic mark, and
    with an empty table, nothing goes; further columns pass through.
    """
    score = score_udf(docs.sparkSession, fit(docs, labels, id_col=id_col, text_col=text_col))
    return docs.filter(score(F.col(text_col)) < 0.5)
