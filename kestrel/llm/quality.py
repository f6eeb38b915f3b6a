"""Quality classifier: similarity-weighted votes of the nearest labelled documents.

A bounded sample of labelled rows is turned into hashed term counts (words, word shapes,
pairs of shapes, repeated words), weighted by inverse document frequency and projected on
its leading singular directions: the latent-semantic space. The labelled vectors are
broadcast (``max_labelled`` x ``dims`` numbers, whatever the corpus) and every document's
cosine with all of them is computed exactly, in blocks; the labels of the nearest vote
with a weight that grows with the similarity.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import digest52, key_text

MAX_LABELLED = 4096   # documented bound of the labelled sample
TERMS = 4096          # hashed terms
DIMS = 64             # latent dimensions
NEIGHBOURS = 9
SHARPNESS = 16        # a neighbour votes with similarity ** SHARPNESS
PRIOR_VOTES = 0.5     # votes for the labelled mean: decides where nothing is similar
THRESHOLD = 0.7
BLOCK = 512           # documents per block of cosine products
STYLE = 256           # the first terms are word shapes
STYLE_SHARE, WORD_SHARE = 1.0, 0.4  # lengths of the two parts of a term vector
TERM_MEMO = 200_000   # words whose terms a worker remembers; only saves time


_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _shape(word: str) -> tuple[str, str]:
    """Case and final punctuation of a word: ``THE!!`` -> A, !!; ``are.***`` -> a, .***."""
    body = word.strip(_PUNCTUATION)
    tail = word[len(word.rstrip(_PUNCTUATION)):] if body else word
    case = "-" if not body else "0" if body.isdigit() else "A" if len(body) > 1 and body.isupper() \
        else "c" if body[0].isupper() else "a"
    return case, tail[:4]


def _bucket(term: str, least: int, most: int) -> int:
    return least + zlib.crc32(term.encode("utf-8", "replace")) % (most - least)


class Terms:
    """Hashed term weights of texts: sublinear counts, styles and words each scaled to unit
    length so that neither drowns the other."""

    def __init__(self):
        self.memo: dict[str, tuple[int, int, int]] = {}

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        words = (text or "").split()
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.float32)
        memo = self.memo
        if len(memo) > TERM_MEMO:
            memo.clear()
        style: Counter = Counter()
        meant: Counter = Counter()
        for w, n in Counter(words).items():
            ids = memo.get(w)
            if ids is None:
                case, tail = _shape(w)
                odd = "" if len(tail) < 2 else "2"  # more than a sentence's punctuation
                ids = memo[w] = (_bucket(case + tail, 8, STYLE), _bucket("c" + case + odd, 8, STYLE),
                                 _bucket("w" + w.lower().strip(_PUNCTUATION), STYLE, TERMS))
            style[ids[0]] += n
            style[ids[1]] += n
            meant[ids[2]] += n
        style[0] = 2 * sum(map(eq, words, words[1:]))  # repeats of the word before
        out_i, out_v = [], []
        for counts, share in ((style, STYLE_SHARE), (meant, WORD_SHARE)):
            v = np.sqrt(np.fromiter(counts.values(), np.float32, len(counts)))
            out_i.append(np.fromiter(counts.keys(), np.int64, len(counts)))
            out_v.append(v * (share / max(1e-9, float(np.sqrt((v * v).sum())))))
        return np.concatenate(out_i), np.concatenate(out_v).astype(np.float32)


def _held_out(doc_id):
    return F.crc32(key_text(doc_id).cast("binary")) % 4 == 2


class Space:
    """The fitted classifier: idf, projection, labelled vectors, labels."""

    def __init__(self, idf, projection, vectors, labels):
        self.idf, self.projection, self.vectors, self.labels = idf, projection, vectors, labels
        self.prior = float(labels.mean()) if len(labels) else 0.5

    def project(self, rows) -> np.ndarray:
        z = np.stack([(v * self.idf[i]) @ self.projection[i] if len(i)
                      else np.zeros(self.projection.shape[1], np.float32) for i, v in rows]) \
            if rows else np.zeros((0, self.projection.shape[1]), np.float32)
        norm = np.sqrt((z * z).sum(axis=1, keepdims=True))
        return np.divide(z, norm, out=np.zeros_like(z), where=norm > 1e-12)

    def scores(self, rows) -> np.ndarray:
        """Votes of the nearest labelled vectors; the labelled mean where nothing is similar."""
        out = np.full(len(rows), self.prior)
        if not len(self.labels):
            return out
        k = min(NEIGHBOURS, len(self.labels))
        for at in range(0, len(rows), BLOCK):
            cosine = self.project(rows[at:at + BLOCK]) @ self.vectors.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            votes = np.maximum(np.take_along_axis(cosine, near, axis=1), 0.0) ** SHARPNESS
            out[at:at + BLOCK] = ((votes * self.labels[near]).sum(axis=1) + PRIOR_VOTES * self.prior) \
                / (votes.sum(axis=1) + PRIOR_VOTES)
        return np.clip(out, 0.0, 1.0)


def fit_space(rows, labels, dims: int = DIMS, seed: int = 7) -> Space:
    """Latent-semantic space of the sample by a randomised singular value decomposition."""
    labels = np.asarray(labels, np.float64)

    def blocks():
        """Dense rows of the sample, a block at a time: the whole matrix never exists."""
        for at in range(0, len(rows), BLOCK):
            some = rows[at:at + BLOCK]
            x = np.zeros((len(some), TERMS), np.float32)
            own = np.repeat(np.arange(len(some)), [len(i) for i, _ in some])
            np.add.at(x, (own, np.concatenate([i for i, _ in some])), np.concatenate([v for _, v in some]))
            yield slice(at, at + len(some)), x

    df = sum(((x > 0).sum(axis=0) for _, x in blocks()), np.zeros(TERMS, np.int64))
    idf = np.log((1.0 + len(rows)) / (1.0 + df)).astype(np.float32) + 1.0

    def times(right: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros((0, right.shape[1]), np.float32)] + [(x * idf) @ right for _, x in blocks()])

    def transposed_times(right: np.ndarray) -> np.ndarray:
        return sum(((x * idf).T @ right[at] for at, x in blocks()), np.zeros((TERMS, right.shape[1]), np.float32))

    rank = max(1, min(dims, len(rows), TERMS))
    probe = np.random.default_rng(seed).standard_normal((TERMS, rank + 16)).astype(np.float32)
    basis = times(probe)
    for _ in range(3):
        basis = times(transposed_times(np.linalg.qr(basis)[0]))
    basis = np.linalg.qr(basis)[0]
    _, _, vt = np.linalg.svd(transposed_times(basis).T, full_matrices=False)
    projection = np.ascontiguousarray(vt[:rank].T, np.float32)
    space = Space(idf, projection, np.zeros((0, rank), np.float32), labels)
    space.vectors = space.project(rows)
    return space


def labelled_sample(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED,
                    label_col: str = "quality") -> DataFrame:
    """text and label of at most ``max_labelled`` rows that may be learnt from: the first by
    a hash of doc_id, held-out rows and null labels left out."""
    chosen = labels.where(F.col(label_col).isNotNull() & ~_held_out("doc_id")) \
                   .select(F.col("doc_id").alias("_id"), F.col(label_col).cast("double").alias("label"),
                           digest52(F.concat(F.lit("label:"), key_text("doc_id"))).alias("_h")) \
                   .orderBy("_h", "_id").limit(max_labelled)
    # At most ``max_labelled`` short rows: broadcast, so that no text is shuffled.
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")) \
                .select("text", "label", "_h") \
                .orderBy("_h", "text").limit(max_labelled).drop("_h")


def learn(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Space:
    """Fit on the bounded sample, in the one task that its ordering ends in: the driver gets
    the fitted numbers, neither texts nor terms."""

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of, rows, marks = Terms(), [], []
        for batch in batches:
            rows += [of(t) for t in batch["text"]]
            marks += batch["label"].tolist()
        space = fit_space(rows, marks)
        yield pd.DataFrame({"idf": [space.idf.tobytes()], "projection": [space.projection.tobytes()],
                            "vectors": [space.vectors.tobytes()], "labels": [space.labels.tobytes()]})

    found = labelled_sample(docs, labels, max_labelled).coalesce(1) \
        .mapInPandas(fit, "idf binary, projection binary, vectors binary, labels binary").collect()
    if not found:  # no partition, hence no row
        return fit_space([], [])
    idf, projection, vectors = (np.frombuffer(found[0][c], np.float32) for c in ("idf", "projection", "vectors"))
    marks = np.frombuffer(found[0].labels, np.float64)
    projection = projection.reshape(TERMS, -1)  # of no columns, if there are no rows
    return Space(idf, projection, vectors.reshape(len(marks), projection.shape[1]), marks)


def scorer(docs: DataFrame, space: Space):
    """Series of texts -> Series of scores, with the fitted space as a broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(space)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = Terms()
        for texts in batches:
            yield pd.Series(shared.value.scores([of(t) for t in texts]))

    return score


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
             max_labelled: int = MAX_LABELLED) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Only the text enters a score. Empty, null and wordless texts have no direction and get
    the labelled mean; without any labels every score is 0.5. Repeated rows get equal
    scores, whole texts are read however long, and other columns don't matter.
    """
    score = scorer(docs, learn(docs, labels, max_labelled))
    return docs.select("doc_id", _held_out("doc_id").alias("held_out"),
                       score(F.col("text").cast("string")).alias("score")) \
               .withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
              max_labelled: int = MAX_LABELLED) -> DataFrame:
    """The rows that the classifier doesn't reject, with the columns of ``docs``."""
    score = scorer(docs, learn(docs, labels, max_labelled))
    return docs.where(score(F.col("text").cast("string")) >= threshold)
