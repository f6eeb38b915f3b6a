"""Text cleaning as Spark column expressions and jobs.

The rules are those of the pandas half of the reference: lower-case, keep only ``a-z``
and space (newlines and hyphens vanish and join their neighbours), split on spaces,
Porter-stem every word, then drop stop words - after stemming, so stems such as
``thi`` (from "this") survive the filter.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.functions import porter, porter_sql
from kestrel.functions.stopwords import ENGLISH_STOP_WORDS

KNOWN_WORDS = 1 << 18  # words whose stems a task keeps

for _module in (sys.modules[__name__], porter):  # executors need no copy of the package
    cloudpickle.register_pickle_by_value(_module)


def text_lower(col: str | Column) -> Column:
    """T1."""
    return F.lower(F.col(col) if isinstance(col, str) else col)


def keep_letters(col: str | Column) -> Column:
    """T1 + T2: lower-case, then delete every character outside ``a-z`` and space."""
    return F.regexp_replace(text_lower(col), "[^a-z ]", "")


def tokenize(col: str | Column) -> Column:
    """Split on runs of spaces; no empty tokens."""
    c = F.col(col) if isinstance(col, str) else col
    return F.filter(F.split(c, " +"), lambda t: t != F.lit(""))


def letter_tokens(col: str | Column) -> Column:
    """T1 -> T2 -> T3 as one expression."""
    return tokenize(keep_letters(col))


def is_stopword(token: Column, words=ENGLISH_STOP_WORDS) -> Column:
    """Membership test planned as ``InSet`` (a hash lookup), not a scan of the list."""
    return token.isin(list(words))


def remove_stopwords(tokens: str | Column, words=ENGLISH_STOP_WORDS) -> Column:
    """T5: keep order and repeats (``array_except`` would also de-duplicate)."""
    c = F.col(tokens) if isinstance(tokens, str) else tokens
    return F.filter(c, lambda t: ~is_stopword(t, words))


def join_tokens(tokens: str | Column) -> Column:
    """T6."""
    return F.array_join(F.col(tokens) if isinstance(tokens, str) else tokens, " ")


def porter_stems(tokens_col: str) -> Column:
    """T4: the Porter stem of every word of an array column, in the JVM (``porter_sql``)."""
    return F.expr(porter_sql.stems(f"`{tokens_col}`"))


def stem_vocabulary(tokens: DataFrame, token_col: str = "token", times: int = 1
                    ) -> DataFrame:
    """``(word, stem)`` for every distinct word, stemmed ``times`` times.

    The distinct step is a partial aggregation, so a word that fills a third of the
    corpus is one row per task before the shuffle; a word is stemmed once.
    """
    d = tokens.select(F.col(token_col).alias("word")).distinct() \
              .withColumn("_stems", F.array("word"))
    for _ in range(times):
        d = d.withColumn("_stems", porter_stems("_stems"))
    return d.select("word", F.element_at("_stems", 1).alias("stem"))


def explode_tokens(docs: DataFrame, key: str, tokens_col: str) -> DataFrame:
    """(key, pos, token); a document without tokens keeps one row with null token."""
    return docs.select(key, F.posexplode_outer(tokens_col).alias("pos", "token"))


def stemmed_by_dictionary(column: str, times: int = 1):
    """A function for mapInArrow: batches with the words of an array column replaced by stems."""
    one = porter.stem.__wrapped__  # its cache can't be sent to tasks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {}
        for batch in batches:
            at = batch.schema.get_field_index(column)
            arrays = batch.column(at)
            words = arrays.flatten().dictionary_encode()
            stems = []
            for word in words.dictionary.to_pylist():
                s = known.get(word)
                if s is None and word is not None:
                    s = word
                    for _ in range(times):
                        s = one(s)
                    if len(known) >= KNOWN_WORDS:
                        known.clear()
                    known[word] = s
                stems.append(s)
            values = pa.array(stems, pa.string()).take(words.indices)
            sizes = pc.fill_null(pc.list_value_length(arrays), 0).to_numpy(zero_copy_only=False)
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            stemmed = pa.ListArray.from_arrays(offsets, values, mask=arrays.is_null())
            yield pa.RecordBatch.from_arrays(
                [stemmed if i == at else c for i, c in enumerate(batch.columns)], names=batch.schema.names)
    return run


def stem_tokens(docs: DataFrame, key: str = "doc_id", tokens_col: str = "tokens",
                out: str = "stems", times: int = 1, strategy: str = "inline",
                keep: Sequence[str] = ()) -> DataFrame:
    """Replace each token array by its stems, keeping token order (T4 applied).

    ``inline`` (default): the arrays are stemmed where they are; no token crosses the
    network.
    ``dictionary``: the same arrays, but a task stems a distinct word once and looks it up
    after that (``porter.stem``, at most ``KNOWN_WORDS`` words kept); nothing is shuffled.
    ``vocabulary``: tokens -> (key, pos, token) -> join the stemmed distinct vocabulary
    -> rebuild each array in position order. A distinct word is stemmed once, but every
    token is shuffled twice (join, regroup).
    ``keep`` names columns carried through unchanged (not with ``vocabulary``).
    """
    if strategy == "dictionary":
        d = docs.select(key, *keep, F.col(tokens_col).alias(out))
        return d.mapInArrow(stemmed_by_dictionary(out, times), d.schema)
    if strategy == "inline":
        d = docs.select(key, *keep, F.col(tokens_col).alias("_stems"))
        for _ in range(times):
            d = d.withColumn("_stems", porter_stems("_stems"))
        return d.select(key, *keep, F.col("_stems").alias(out))
    if keep:
        raise ValueError("keep is not supported by the vocabulary strategy")
    exploded = explode_tokens(docs, key, tokens_col)
    vocab = stem_vocabulary(exploded.where(F.col("token").isNotNull()), "token", times)
    stemmed = exploded.join(vocab, exploded["token"] == vocab["word"], "left")
    item = F.when(F.col("stem").isNotNull(), F.struct("pos", "stem"))
    rebuilt = stemmed.groupBy(key).agg(F.array_sort(F.collect_list(item)).alias("_ps"))
    return rebuilt.select(key, F.transform("_ps", lambda x: x["stem"]).alias(out))


def clean_text(docs: DataFrame, key: str = "doc_id", text_col: str = "text",
               out: str = "clean_tokens", strategy: str = "inline",
               keep: Sequence[str] = ()) -> DataFrame:
    """Lower -> letters -> split -> stem -> stop words, as ``(key, keep..., out)``."""
    toks = docs.select(key, *keep, letter_tokens(text_col).alias("tokens"))
    stemmed = stem_tokens(toks, key, "tokens", "stems", strategy=strategy, keep=keep)
    return stemmed.select(key, *keep, remove_stopwords("stems").alias(out))
