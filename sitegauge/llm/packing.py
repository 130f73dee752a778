"""Vector best-fit packing of documents into sequences.

A document is its token ids and one separator id. Documents longer than ``max_tokens`` are cut into
full pieces and a rest. Full pieces are sequences of their own. All others are dealt at random to
groups of about ``group_pieces``, and each group is packed by best fit, longest piece first.

A sequence has three residual capacities: tokens, documents and attention cost (the sum of squared
piece lengths). A piece may go to a sequence only where all three suffice. Among these it takes the
one with the highest score: ``"norm"`` leaves the smallest weighted norm of the residual vector,
``"dot"`` has the largest weighted dot product of piece and residual. A sequence whose residual
tokens are below the shortest piece of its group is closed.

With the defaults a sequence of 2048 tokens can hold any number of documents and any attention cost
(at most 2048 squared), so only tokens bind and as few sequences as possible are opened; lower
limits are parameters.

Word ids are remembered: the tokenizer drops white space and its merges never cross it, so the ids
of a text are those of its words in order. It ignores case and never merges a letter or digit with a
mark, so a new word is looked up in lower case and without a final full stop or comma first.

Defined results: a null or empty text is the separator alone; rows with equal ids are packed each
for itself; a null id is kept; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import cut_lineage, texts_of

#: Words whose ids a Python worker remembers in each of two generations, some 200 bytes each.
CACHED_WORDS = 500_000


def core_of(word: bytes) -> tuple[bytes, bytes]:
    """A word in lower case without a final mark that follows an ASCII letter or digit; the mark."""
    word = word.lower()
    if word[-1:] in (b".", b",") and word[-2:-1].isalnum():
        return word[:-1], word[-1:]
    return word, b""


class Words:
    """Token ids of words as little-endian bytes, by a tokenizer read on the worker."""

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        self.cached = cached
        # A task has one core; the library reads this when it is first used.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.recent: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.cores: dict[bytes, bytes] = {}
        self.marks = dict(zip((b".", b","), self.encode([b".", b","])))

    def encode(self, words: list[bytes]) -> list[bytes]:
        out = []
        for i in range(0, len(words), 20_000):
            out += [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(
                [w.decode() for w in words[i:i + 20_000]], add_special_tokens=False)]
        return out

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as unsigned 32-bit little-endian numbers.

        Words used lately stay known: a full generation becomes the older one, and words move back
        from there when they come again.
        """
        if len(self.recent) > self.cached:
            self.older, self.recent = self.recent, {}
        split = [t.split() for t in texts]
        known = self.recent
        new = []
        for w in set().union(*split).difference(known):
            if w in self.older:
                known[w] = self.older[w]
            else:
                new.append(w)
        if len(self.cores) > self.cached:
            self.cores.clear()
        parts = [core_of(w) for w in new]
        fresh = list({core for core, _ in parts if core not in self.cores})
        self.cores.update(zip(fresh, self.encode(fresh)))
        for w, (core, mark) in zip(new, parts):
            known[w] = self.cores[core] + self.marks[mark] if mark else self.cores[core]
        return [b"".join([known[w] for w in words]) for words in split]


_words: dict[tuple[str, int], Words] = {}


def words_of(path: str, cached: int = CACHED_WORDS) -> Words:
    if (path, cached) not in _words:
        _words[path, cached] = Words(path, cached)
    return _words[path, cached]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(batches: Iterator[pa.RecordBatch], path: str, cached: int, max_tokens: int,
            separator: int) -> Iterator[pa.RecordBatch]:
    end = np.array([separator], "<u4").tobytes()
    words, width = words_of(path, cached), 4 * max_tokens
    for batch in batches:
        for first in range(0, batch.num_rows, 256):
            part = batch.slice(first, 256)
            at, piece, start, length, crc = [], [], [], [], []
            for row, ids in enumerate(words.ids(texts_of(part.column(1)))):
                ids += end
                for k, i in enumerate(range(0, len(ids), width)):
                    cut = ids[i:i + width]
                    at.append(row)
                    piece.append(k)
                    start.append(i // 4)
                    length.append(len(cut) // 4)
                    crc.append(zlib.crc32(cut))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(at, pa.int32())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"])


def best_fit(lengths: np.ndarray, max_tokens: int, max_docs: int, max_cost: int,
             score: str, weights: tuple[float, float, float]) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; ``lengths`` go from long to short."""
    n = len(lengths)
    caps = np.array([max_tokens, max_docs, max_cost], np.float64)
    scale = np.asarray(weights, np.float64) / caps ** 2
    rest = np.empty((3, n))  # residual capacities of open bins, compact
    name = np.empty(n, np.int64)
    bins, offsets = np.empty(n, np.int64), np.empty(n, np.int64)
    n_open = n_bins = 0
    least = float(lengths[-1]) if n else 0.0
    for i in range(n):
        need = np.array([lengths[i], 1.0, float(lengths[i]) ** 2])[:, None]
        free = rest[:, :n_open]
        at = np.flatnonzero((free[0] >= need[0]) & (free[1] >= 1) & (free[2] >= need[2]))
        if len(at):
            value = (scale @ (free[:, at] - need) ** 2 if score == "norm"
                     else -(scale * need[:, 0]) @ free[:, at])
            k = at[int(np.argmin(value))]
        else:
            k = n_open
            rest[:, k], name[k] = caps, n_bins
            n_open, n_bins = n_open + 1, n_bins + 1
        bins[i], offsets[i] = name[k], max_tokens - rest[0, k]
        rest[:, k] -= need[:, 0]
        if rest[0, k] < least or rest[1, k] < 1:  # closed: the last open bin takes its place
            n_open -= 1
            rest[:, k], name[k] = rest[:, n_open], name[n_open]
    return bins, offsets


def pack(docs: DataFrame, tokenizer: str | None = None, max_tokens: int = 2048, separator: int = 0,
         max_docs: int = 2048, max_cost: int = 2048 ** 2, score: str = "norm",
         weights: tuple[float, float, float] = (1.0, 0.0, 0.0),
         group_pieces: int = 8000, cached_words: int = CACHED_WORDS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset, one row per piece."""
    if max_docs < 1 or max_cost < max_tokens ** 2:
        raise ValueError("a full piece must fit into an empty sequence")
    path = tokenizer or default_tokenizer()
    pieces = cut_lineage(
        docs.select("doc_id", "text")
        .mapInArrow(lambda it: _pieces(it, path, cached_words, max_tokens, separator), PIECES)
        .withColumn("uid", F.monotonically_increasing_id()))
    full = pieces.filter(F.col("length") == max_tokens)
    rest = pieces.filter(F.col("length") < max_tokens)
    groups = max(1, -(-rest.count() // group_pieces))
    schema = PIECES + ", sequence_id long, offset long"

    def pack_group(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "uid"], ascending=[False, True], ignore_index=True)
        bins, offsets = best_fit(rows["length"].to_numpy(), max_tokens, max_docs, max_cost, score, weights)
        rows["sequence_id"] = (int(key[0]) << 32) + bins
        rows["offset"] = offsets
        return rows.drop(columns=["uid", "part"])

    packed = (rest.withColumn("part", F.pmod(F.xxhash64("uid"), F.lit(groups)))
              .groupBy("part").applyInPandas(pack_group, schema))
    # A full piece is its own sequence; negative numbers keep these apart.
    alone = full.select("doc_id", "piece", "start", "length", "ids_crc32",
                        (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(alone)


def op4(docs: DataFrame) -> DataFrame:
    return pack(docs)
