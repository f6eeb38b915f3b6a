"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

The pieces and log scores of a vocabulary file are laid out as a double-array trie over
UTF-8 bytes. A text becomes ``▁`` + text with every space as ``▁``; pieces hold ``▁`` only
in front, so the best segmentation splits before every ``▁`` that follows another
character, and the words of a batch are segmented once each, all of them at the same time:
the trie is walked from every character of every word in step, then the Viterbi recursion
advances one byte position at a time over all words. A character without a piece of its
own costs ``least score - 10`` and falls back to the byte pieces ``<0x00>`` to ``<0xFF>``.
Decoding joins the pieces, turns byte pieces into bytes and ``▁`` into spaces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARK = "▁"
DISABLED = -1e8         # pieces with scores as low as this are in no best segmentation
UNKNOWN_PENALTY = 10.0  # below the least score, as SentencePiece has it
WORD_CACHE = 400_000    # distinct words a worker remembers; only saves time
SLICE = 1 << 20         # characters encoded together


class DoubleArray:
    """Trie over bytes: the child of node n by byte b is base[n] + b, if check[] there is n."""

    def __init__(self, keys: dict[bytes, int]):
        children: list[dict[int, int]] = [{}]
        value = [-1]
        for key, v in keys.items():
            node = 0
            for b in key:
                nxt = children[node].get(b)
                if nxt is None:
                    nxt = len(children)
                    children[node][b] = nxt
                    children.append({})
                    value.append(-1)
                node = nxt
            value[node] = v
        size = 4 * len(children) + 4096
        base, check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
        self.value = np.full(size, -1, np.int32)
        used = np.zeros(size, bool)
        used[0] = True
        # Wide nodes first, while there is room; each search goes on where the last one of
        # its width ended.
        where = {0: 0}
        wide = sorted((n for n in range(len(children)) if children[n]),
                      key=lambda n: -len(children[n]))
        bases, resume = {}, {}
        for node in wide:
            codes = np.array(sorted(children[node]))
            lo = resume.get(len(codes), 1)
            while True:  # first place in this window where all children fit
                window = np.ones(2048, bool)
                for c in codes:
                    window &= ~used[lo + c:lo + c + 2048]
                fit = np.flatnonzero(window)
                if len(fit):
                    break
                lo += 2048
            at = lo + int(fit[0])
            resume[len(codes)] = at
            bases[node] = at
            used[at + codes] = True
        for node in range(len(children)):  # parents come before their children
            slot = where[node]
            self.value[slot] = value[node]
            if node in bases:
                base[slot] = bases[node]
                for b, child in children[node].items():
                    where[child] = bases[node] + b
                    check[bases[node] + b] = slot
        last = int(np.flatnonzero(used)[-1]) + 257
        self.base, self.check, self.value = base[:last], check[:last], self.value[:last]

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Children of nodes by bytes; -1 where there is none."""
        child = self.base[node] + byte
        return np.where(self.check[child] == node, child, -1)


class Model:
    """Pieces with log scores, the trie over them, and the ids of the byte pieces."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[str]):
        normal = [i for i, k in enumerate(kinds) if k == "normal"]
        self.pieces = pieces
        self.scores = np.array(scores, np.float64)
        self.trie = DoubleArray({pieces[i].encode("utf-8"): i for i in normal})
        self.longest = max((len(pieces[i].encode("utf-8")) for i in normal), default=1)
        self.unknown = float(min((scores[i] for i in normal if scores[i] > DISABLED), default=0.0)) - UNKNOWN_PENALTY
        self.byte_id = np.full(256, -1, np.int64)
        for i, k in enumerate(kinds):
            if k == "byte":
                self.byte_id[int(pieces[i][1:-1], 16)] = i
        self.unk_id = kinds.index("unknown") if "unknown" in kinds else 0
        self.fallback = bool((self.byte_id >= 0).all())
        self.separable = not any(MARK in pieces[i].lstrip(MARK) for i in normal)
        self.byte_of = {int(i): b for b, i in enumerate(self.byte_id) if i >= 0}


def load_model(path: str) -> Model:
    """The vocabulary of a SentencePiece file; only pieces, scores and kinds are used."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    kinds = ["byte" if sp.is_byte(i) else "unknown" if sp.is_unknown(i)
             else "control" if sp.is_control(i) or sp.is_unused(i) else "normal"
             for i in range(sp.get_piece_size())]
    scores = log_scores([sp.get_score(i) for i in range(len(kinds))], kinds)
    return Model([sp.id_to_piece(i) for i in range(len(kinds))], scores, kinds)


def log_scores(scores: list[float], kinds: list[str]) -> list[float]:
    """Scores whose sum is a log likelihood. Files of unigram models hold them; files of merge
    models hold minus the rank of the merge (0, -1, -2, ...), whose sum means nothing. Their
    pieces get the probabilities that Zipf's law gives to ranks, 1 / (rank + 2) over the sum of
    all: a rule on the installed vocabulary, nothing is trained."""
    normal = [i for i, kind in enumerate(kinds) if kind == "normal" and scores[i] > DISABLED]
    ranks = -np.array([scores[i] for i in normal], np.float64)
    if not len(ranks) or ranks.min() < 0 or (ranks % 1).any() or len(np.unique(ranks)) < len(ranks):
        return scores
    out = list(scores)
    logs = -np.log(ranks + 2.0) - np.log((1.0 / (ranks + 2.0)).sum())
    for i, score in zip(normal, logs.tolist()):
        out[i] = score
    return out


def segment(model: Model, words: list[str], block: int = 16_384) -> list[np.ndarray]:
    """Piece ids of each word (a string that already has its ``▁``), best score first; of
    equal scores the segmentation whose last piece is longest wins."""
    order, ids, counts = _segment_all(model, words, block)
    out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(words)
    for i, end, n in zip(order.tolist(), np.cumsum(counts).tolist(), counts.tolist()):
        out[i] = ids[end - n:end]
    return out


def _segment_all(model: Model, words: list[str], block: int = 16_384) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of the words by falling length, their piece ids one after another in that
    order, and the number of ids of each."""
    raw = [w.encode("utf-8", "replace") for w in words]
    lens = np.fromiter(map(len, raw), np.int64, len(raw))
    order = np.argsort(-lens, kind="stable")
    found, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    at = 0
    while at < len(order):  # words of about the same length; one very long word alone
        longest = max(1, int(lens[order[at]]))
        take = order[at:at + max(1, min(block, block * 32 // longest))]
        ids, n = _segment_block(model, [raw[i] for i in take.tolist()])
        found.append(ids)
        counts.append(n)
        at += len(take)
    return order, np.concatenate(found), np.concatenate(counts)


def _segment_block(model: Model, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words and how many each has. The words come in the order of falling
    length: row p of every table is byte position p."""
    count, lens = len(raw), np.array([len(r) for r in raw])
    top = int(lens[0])
    if not top:
        return np.zeros(0, np.int32), np.zeros(count, np.int64)
    text = np.frombuffer(b"".join(r.ljust(top, b"\0") for r in raw), np.uint8) \
             .reshape(count, top).T.astype(np.int32)
    best = np.full((top + 1, count), -np.inf)
    best[0] = 0.0
    via = np.full((top + 1, count), -1, np.int32)
    came = np.zeros((top + 1, count), np.int32)
    longer = np.searchsorted(-lens, -np.arange(top + 1), side="left")  # words with len > p
    base, check, value = model.trie.base, model.trie.check, model.trie.value
    for p in range(top):
        n = longer[p]
        lead = text[p, :n]
        start = np.flatnonzero((lead & 0xC0) != 0x80)
        if not len(start):
            continue
        width = np.ones(len(start), np.int32)
        first = lead[start]
        width += (first >= 0xC0).astype(np.int32) + (first >= 0xE0) + (first >= 0xF0)
        lone = np.zeros(count, bool)
        reach = np.zeros(count, np.int32)
        reach[start] = width
        here = best[p]
        idx, node = start, np.zeros(len(start), np.int32)
        for depth in range(1, min(model.longest, top - p) + 1):
            child = base[node] + text[p + depth - 1, idx]
            ok = check[child] == node
            idx, node = idx[ok], child[ok]
            if not len(idx):
                break
            piece = value[node]
            hit = piece >= 0
            to, got = idx[hit], piece[hit]
            lone[to[reach[to] == depth]] = True
            score = here[to] + model.scores[got]
            better = score > best[p + depth, to]
            to = to[better]
            best[p + depth, to] = score[better]
            via[p + depth, to] = got[better]
            came[p + depth, to] = p
            more = lens[idx] > p + depth
            idx, node = idx[more], node[more]
        odd = start[~lone[start]]
        for size in (1, 2, 3, 4):  # characters without a piece of their own
            to = odd[reach[odd] == size]
            if len(to):
                score = here[to] + model.unknown
                to, score = to[(w := score > best[p + size, to])], score[w]
                best[p + size, to] = score
                via[p + size, to] = -1
                came[p + size, to] = p
    # Walk back from the ends of all words in step.
    at, alive = lens.copy(), np.flatnonzero(lens > 0)
    words_of, ids_of, step_of = [], [], []
    step = 0
    while len(alive):
        end = at[alive]
        got, frm = via[end, alive], came[end, alive]
        known = got >= 0
        words_of.append(alive[known])
        ids_of.append(got[known])
        step_of.append(np.full(int(known.sum()), 8 * step))
        for w, a, b in zip(alive[~known], frm[~known], end[~known]):
            # a character as bytes, the last byte first
            own = model.byte_id[text[a:b, w][::-1]] if model.fallback else [model.unk_id]
            words_of.append(np.full(len(own), w))
            ids_of.append(np.asarray(own, np.int32))
            step_of.append(8 * step + np.arange(len(own)))
        at[alive] = frm
        alive = alive[frm > 0]
        step += 1
    w, p, s = np.concatenate(words_of), np.concatenate(ids_of), np.concatenate(step_of)
    by = np.lexsort((-s, w))
    return p[by].astype(np.int32), np.bincount(w, minlength=count)


def marked_words(text: str) -> list[str]:
    """``▁`` + text with spaces as ``▁``, cut before every ``▁`` after another character."""
    if not text:
        return []
    s = MARK + text.replace(" ", MARK)
    if MARK * 2 not in s:
        return [MARK + w for w in s[1:].split(MARK)]
    out, run = [], ""
    for w in s[1:].split(MARK):
        run += MARK
        if w:
            out.append(run + w)
            run = ""
    if run:
        out.append(run)
    return out


class Encoder:
    """Encodes batches; a bounded memo spares repeated words the recursion, the count of
    their byte pieces and the test whether they decode to themselves."""

    def __init__(self, model: Model):
        self.model = model
        self.spoken = np.array([p.replace(MARK, " ") for p in model.pieces], dtype=object)
        self.raw = np.array([bytes([model.byte_of[i]]) if i in model.byte_of else p.encode("utf-8", "surrogatepass")
                             for i, p in enumerate(self.spoken)], dtype=object)
        self.size = np.array([len(r) for r in self.raw], np.int64)
        self.is_byte = np.zeros(len(model.pieces), bool)
        self.is_byte[model.byte_id[model.byte_id >= 0]] = True
        self._forget()

    def _forget(self) -> None:
        """``memo`` numbers the words: word i has the ``count[i]`` ids before ``end[i]``."""
        self.memo: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.end, self.count, self.n_bytes = (np.zeros(0, np.int64) for _ in range(3))
        self.exact = np.zeros(0, bool)

    def _learn(self, words: list[str]) -> None:
        order, ids, count = _segment_all(self.model, words)
        words = [words[i] for i in order.tolist()]
        end = np.cumsum(count)
        n_bytes = np.diff(np.concatenate([[0], np.cumsum(self.is_byte[ids])])[np.concatenate([[0], end])])
        said = [w.replace(MARK, " ") for w in words]
        exact = self._decode_to(said, ids, end, count, n_bytes)
        self.memo.update(zip(words, range(len(self.memo), len(self.memo) + len(words))))
        self.end = np.concatenate([self.end, end + len(self.ids)])
        self.ids = np.concatenate([self.ids, ids])
        self.count = np.concatenate([self.count, count])
        self.n_bytes = np.concatenate([self.n_bytes, n_bytes])
        self.exact = np.concatenate([self.exact, exact])

    def _decode_to(self, said: list[str], ids: np.ndarray, end: np.ndarray, count: np.ndarray,
                   n_bytes: np.ndarray) -> np.ndarray:
        """Whether the ids of each word decode to it. All words are decoded at once, as bytes:
        they do if all together give all words and each has its word's length."""
        want = [w.encode("utf-8", "surrogatepass") for w in said]
        size = np.concatenate([[0], np.cumsum(self.size[ids])])
        exact = size[end] - size[end - count] == np.fromiter(map(len, want), np.int64, len(want))
        if not exact.all() or b"".join(self.raw[ids]) != b"".join(want):
            exact[:] = [self.decodes_to(ids[e - n:e], b, w[1:])
                        for e, n, b, w in zip(end.tolist(), count.tolist(), n_bytes.tolist(), said)]
        return exact

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return self.encode_and_check(texts)[0]

    def encode_and_check(self, texts: list[str]) -> tuple[list[np.ndarray], list[int], list[bool]]:
        """Piece ids of each text, the number of byte pieces among them, and whether they
        decode to the text."""
        if not self.model.separable:
            found = segment(self.model, [MARK + t.replace(" ", MARK) if t else "" for t in texts])
            n_bytes = [int(self.is_byte[i].sum()) for i in found]
            return found, n_bytes, [self.decodes_to(i, n, t) for i, n, t in zip(found, n_bytes, texts)]
        split = [marked_words(t) for t in texts]
        words = list(chain.from_iterable(split))
        different = set(words)
        new = different.difference(self.memo)
        if len(self.memo) + len(new) > WORD_CACHE:
            self._forget()
            new = different
        if new:
            self._learn(list(new))
        word = np.fromiter(map(self.memo.__getitem__, words), np.int64, len(words))
        count = self.count[word]
        behind = np.cumsum(count)
        total = int(behind[-1]) if len(word) else 0
        ids = self.ids[np.repeat(self.end[word] - behind, count) + np.arange(total)]
        last = np.cumsum([len(w) for w in split])  # of each text's words
        first = last - [len(w) for w in split]

        def sums(of_word: np.ndarray) -> np.ndarray:
            before = np.concatenate([[0], np.cumsum(of_word)])
            return before[last] - before[first]

        n_tokens, n_bytes, odd = sums(count), sums(self.n_bytes[word]).tolist(), sums(~self.exact[word])
        ends = np.cumsum(n_tokens)
        found = [ids[e - n:e] for e, n in zip(ends.tolist(), n_tokens.tolist())]
        # Words that decode to themselves make a text that does, but for its own marks.
        exact = [MARK not in t if not o else self.decodes_to(i, n, t)
                 for i, n, o, t in zip(found, n_bytes, odd.tolist(), texts)]
        return found, n_bytes, exact

    def decodes_to(self, ids: np.ndarray, n_bytes: int, text: str) -> bool:
        if n_bytes:
            at = np.flatnonzero(self.is_byte[ids])
            out, last = [], 0
            # joins the plain stretches at once; only byte runs go through ``decode``
            for run in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1):
                out.append("".join(self.spoken[ids[last:run[0]]]))
                out.append(bytes(self.model.byte_of[int(i)] for i in ids[run[0]:run[-1] + 1])
                           .decode("utf-8", "replace"))
                last = run[-1] + 1
            out.append("".join(self.spoken[ids[last:]]))
            got = "".join(out)
        else:
            got = "".join(self.spoken[ids])
        return (got[1:] if got.startswith(" ") else got) == text


def decode(model: Model, ids) -> str:
    """The text of piece ids: bytes joined (invalid ones as U+FFFD), marks as spaces, and
    the space that encoding put in front taken off."""
    out, run = [], bytearray()
    for i in ids:
        b = model.byte_of.get(int(i))
        if b is not None:
            run.append(b)
            continue
        if run:
            out.append(run.decode("utf-8", "replace"))
            run = bytearray()
        out.append(model.pieces[int(i)])
    if run:
        out.append(run.decode("utf-8", "replace"))
    text = "".join(out).replace(MARK, " ")
    return text[1:] if text.startswith(" ") else text


def _shared(spark: SparkSession, path: str):
    """The model as a broadcast: its size is the vocabulary's and doesn't grow with the data."""
    return spark.sparkContext.broadcast(load_model(path))


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """doc_id, ids (array<int>), n_tokens, n_bytes (byte pieces among them) and exact:
    whether decoding gives the text back, for every row.

    Null texts are encoded as empty ones: no ids. A ``▁`` in a text decodes to a space, so
    such texts aren't exact. Repeated rows repeat; other columns are ignored.
    """
    shared = _shared(docs.sparkSession, model_path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(shared.value)
        for doc_ids, texts in _slices(batches):
            ids, n_bytes, exact = encoder.encode_and_check(texts)
            yield pd.DataFrame({"doc_id": doc_ids, "ids": ids,
                                "n_tokens": [len(i) for i in ids], "n_bytes": n_bytes,
                                "exact": exact})

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
               .withColumn("doc_id", F.col("doc_id").cast("string")) \
               .mapInPandas(run, "doc_id string, ids array<int>, n_tokens int, n_bytes int, exact boolean") \
               .withColumn("doc_id", F.col("doc_id").cast(kind))


def _slices(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[list, list[str]]]:
    """Doc ids and texts in runs of about ``SLICE`` characters: bounds a worker's memory."""
    for batch in batches:
        ids, texts, size = [], [], 0
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            ids.append(doc_id)
            texts.append(text if isinstance(text, str) else "")
            size += len(texts[-1])
            if size >= SLICE:
                yield ids, texts
                ids, texts, size = [], [], 0
        if ids:
            yield ids, texts


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id and the text of its ``ids``; null ids give a null text."""
    shared = _shared(encoded.sparkSession, model_path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text": [
                None if i is None else decode(shared.value, i) for i in batch["ids"]]})

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select(F.col("doc_id").cast("string"), "ids") \
                  .mapInPandas(run, "doc_id string, text string") \
                  .withColumn("doc_id", F.col("doc_id").cast(kind))
