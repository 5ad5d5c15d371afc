"""Packing: order-preserving dynamic programming over cut positions.

The texts of a partition are tokenised in their order and laid end to end, each
followed by its end id. The stream is cut into windows of at most ``window``
ids. A window's cost is its padding plus a penalty for the place of its cut:
none at the end of a document, SENTENCE_CUT ids at the end of a sentence,
OTHER_CUT elsewhere. With c the cut positions,

    best[j] = penalty[j] + window - c[j] + min(best[i] + c[i] : c[j] - c[i] <= window)

and the minimum over the sliding range comes from a monotone queue, so every
candidate is pushed and popped once. Short windows of a length that needs no
padding (a power of two) are not sought: they would multiply the windows.

The stream is handled in bounded slices; the last, open window of a slice is
carried into the next one, so only the last window of a partition can be short.
No row is shuffled: the order is the order of the input's partitions, and a
lost task repeats its own partition. ``sequence_id`` is the partition's number
times 2^32 plus a counter.

A null or empty text is the end id alone. Repeated rows are packed repeatedly,
an empty table gives no row, a long text is cut into many pieces, and columns
beside key and text are ignored. A null key is kept as a null key.
"""

from __future__ import annotations

import os
import zlib
from collections import deque
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackwise.llm.batches import documents, small_batches, text_slices, worker_state

WINDOW = 2048
END_ID = 1
SENTENCE_CUT, OTHER_CUT = 3, 10
#: where no sentence ends, a cut is possible after so many ids
STRIDE = 32
#: entries that stay in a worker's cache of tokenised words; a full cache keeps the
#: words it has (the early ones are the frequent ones) until more than STALE of a
#: slice's words are new to it
CACHE_WORDS = 600_000
STALE = 0.2

PIECE = "{key} {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class WordTokenizer:
    """Ids of white-space separated words, each distinct word encoded once.

    The tokenizer lower-cases and drops white space, so the ids of a text are
    those of its words one after the other; and in a word that ends in letters
    and then full stops or commas these are separate too.
    """

    def __init__(self, path: str):
        import re

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.encoder = Tokenizer.from_file(path)
        self.tail = re.compile(rb"([a-z])([.,]+)(?=[ \n])")
        # words that the normaliser keeps and the pre-tokeniser does not split
        self.plain = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+").fullmatch
        # byte-level alphabet: bytes without a printable Latin-1 character are U+0100 and up
        blank = [*range(0x21), *range(0x7F, 0xA1), 0xAD]
        self.alphabet = {b: 0x100 + i for i, b in enumerate(blank)}
        self.reset()

    def reset(self) -> None:
        self.index: dict = {None: 0}                      # None: the end of a document
        self.flat = np.array([END_ID], np.uint32)
        self.start, self.size, self.kind = (np.array([x], np.int64) for x in (0, 1, 0))

    def words(self, text: bytes) -> list[bytes]:
        if b"<|" in text:                                 # special tokens are told by their case
            return text.split()
        return self.tail.sub(rb"\1 \2", text.lower()).split()

    def word_ids(self, word: bytes) -> list[int] | None:
        """Ids of a plain word by the model alone; None for others."""
        if not self.plain(word.decode("utf-8", "replace")):
            return None
        symbols = word.decode() if word.isascii() else word.decode("latin-1").translate(self.alphabet)
        return [t.id for t in self.encoder.model.tokenize(symbols)]

    def add(self, new: list[bytes]) -> None:
        if not new:
            return
        ids = list(map(self.word_ids, new))
        other = [i for i, x in enumerate(ids) if x is None]
        for i, e in zip(other, self.encoder.encode_batch_fast([new[i].decode("utf-8", "replace") for i in other],
                                                              add_special_tokens=False)):
            ids[i] = e.ids
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        start = len(self.flat) + np.cumsum(size) - size
        self.flat = np.concatenate([self.flat, np.fromiter((i for x in ids for i in x), np.uint32, int(size.sum()))])
        kind = np.fromiter((1 if w.rstrip(b"\"')]").endswith((b".", b"!", b"?")) else 2 for w in new), np.int64, len(new))
        n = len(self.start)
        self.start, self.size, self.kind = (np.concatenate(x) for x in
                                            ((self.start, start), (self.size, size), (self.kind, kind)))
        self.index.update(zip(new, range(n, n + len(new))))

    def forget(self, keep: int) -> None:
        """Drop the entries after the first ``keep``."""
        for w in list(islice(self.index, keep, None)):
            del self.index[w]
        self.flat = self.flat[:self.start[keep]].copy()
        self.start, self.size, self.kind = (x[:keep].copy() for x in (self.start, self.size, self.kind))

    def encode(self, texts: list[bytes]):
        """(ids of all texts, each followed by the end id; ids per text; end
        positions of all words; their kinds: 0 document, 1 sentence, 2 word)."""
        words, counts = [], []
        for text in texts:
            own = self.words(text)
            words += own
            words.append(None)
            counts.append(len(own) + 1)
        at = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        miss = np.flatnonzero(at < 0)
        if len(miss) > STALE * len(words) and len(self.index) >= CACHE_WORDS:
            self.reset()
            at = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
            miss = np.flatnonzero(at < 0)
        new = [words[i] for i in miss]
        known = len(self.index)
        if new:
            self.add(list(dict.fromkeys(new)))
            at[miss] = np.fromiter(map(self.index.get, new), np.int64, len(new))
        size = self.size[at]
        ends = np.cumsum(size)
        ids = self.flat[np.repeat(self.start[at] - (ends - size), size) + np.arange(int(ends[-1]))]
        docs = np.diff(ends[np.cumsum(counts) - 1], prepend=0)
        kinds = self.kind[at]
        if len(self.index) > max(known, CACHE_WORDS):
            self.forget(max(known, CACHE_WORDS))
        return ids, docs, ends, kinds


def candidates(ends: np.ndarray, kinds: np.ndarray, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray]:
    """Cut positions and their kinds: ends of documents and sentences, and
    every ``stride`` ids where they are further apart."""
    keep = (kinds < 2) & (np.diff(ends, prepend=0) > 0)
    pos, kind = ends[keep], kinds[keep]
    gap = np.diff(pos, prepend=0)
    more = np.maximum(0, (gap - 1) // stride)
    if not more.any():
        return pos, kind
    nth = np.arange(int(more.sum())) - np.repeat(np.cumsum(more) - more, more) + 1
    extra = np.repeat(pos - gap, more) + nth * stride
    pos, kind = np.concatenate([pos, extra]), np.concatenate([kind, np.full(len(extra), 2)])
    order = np.argsort(pos, kind="stable")
    return pos[order], kind[order]


def best_cuts(pos: np.ndarray, kind: np.ndarray, window: int = WINDOW,
              penalties: tuple[int, int, int] = (0, SENTENCE_CUT, OTHER_CUT)) -> list[int]:
    """The cheapest cuts of [0, pos[-1]]: ascending positions, the last one included."""
    c = [0, *pos.tolist()]
    cost = np.array(penalties)[kind]
    cost[-1] = 0
    pen = [0, *cost.tolist()]
    best, back = [0] * len(c), [0] * len(c)
    queue: deque[tuple[int, int]] = deque([(0, 0)])       # (best + position, index), ascending
    for j in range(1, len(c)):
        here, least = c[j], c[j] - window
        while c[queue[0][1]] < least:
            queue.popleft()
        value, i = queue[0]
        value += window - here
        value += pen[j]
        best[j], back[j] = value, i
        value += here
        while queue and queue[-1][0] > value:
            queue.pop()
        queue.append((value, j))
    cuts, j = [], len(c) - 1
    while j:
        cuts.append(c[j])
        j = back[j]
    return cuts[::-1]


def _pack_partition(batches, path: str, window: int, key_type: pa.DataType):
    from pyspark import TaskContext

    serial = TaskContext.get().partitionId() << 32
    state = worker_state()
    if ("tokenizer", path) not in state:
        state["tokenizer", path] = WordTokenizer(path)
    tokens = state["tokenizer", path]
    ids, spans = np.empty(0, np.uint32), []               # carried: ids, (key, start in the document, length, ids of the document)
    pos, kind = np.empty(0, np.int64), np.empty(0, np.int64)

    def pieces(cuts: list[int]):
        """Rows of the windows that end at the cuts."""
        nonlocal serial
        lengths = np.array([s[2] for s in spans], np.int64)
        begins = np.cumsum(lengths) - lengths
        marks = np.unique(np.concatenate([begins[begins < cuts[-1]], [0], cuts]))
        of = np.searchsorted(begins, marks[:-1], "right") - 1
        seq = np.searchsorted(cuts, marks[:-1], "right")
        left = np.array([0, *cuts])[seq]
        rows = [[] for _ in range(7)]
        for a, b, d, s, x in zip(marks[:-1].tolist(), marks[1:].tolist(), of.tolist(), seq.tolist(), left.tolist()):
            key, start, _, total = spans[d]
            for col, v in zip(rows, (key, start + a - int(begins[d]), b - a,
                                     zlib.crc32(ids[a:b].astype("<u4").tobytes()), total, serial + s, a - x)):
                col.append(v)
        serial += len(cuts)
        names = ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        return pa.RecordBatch.from_arrays([pa.array(rows[0], key_type), *(pa.array(r, pa.int64()) for r in rows[1:])], names)

    for keys, texts in text_slices(batches, "key", "text"):
        new, docs, ends, kinds = tokens.encode(texts)
        p, k = candidates(ends, kinds)
        pos, kind = np.concatenate([pos, p + len(ids)]), np.concatenate([kind, k])
        spans += [(key, 0, n, n) for key, n in zip(keys, docs.tolist())]
        ids = np.concatenate([ids, new])
        cuts = best_cuts(pos, kind, window)[:-1]
        if not cuts:
            continue
        yield pieces(cuts)
        done, rest, at = cuts[-1], [], 0
        for key, start, n, total in spans:
            if at + n > done:
                skip = max(0, done - at)
                rest.append((key, start + skip, n - skip, total))
            at += n
        keep = pos > done
        ids, spans, pos, kind = ids[done:], rest, pos[keep] - done, kind[keep]
    if spans:
        yield pieces([len(ids)])


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per piece: (key, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    ``tokenizer`` is the path of a tokenizer file that every executor can read.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType
    key_type = to_arrow_type(kind)
    packed = rows.mapInArrow(lambda it: _pack_partition(it, tokenizer, window, key_type),
                             PIECE.format(key="key", kind=kind.simpleString()))
    return packed.withColumnRenamed("key", key)


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), default_tokenizer())
