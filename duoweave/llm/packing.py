"""Packing by lexical retrieval.

Documents are tokenized once, in the scan's own tasks.  Each run of at most
``BLOCK_DOCS`` documents of a scan split is one shard with its own BM25
inverted index over the documents' last, unfilled windows.  A seed document's
window is filled greedily with its best unused neighbours in the shard; the
last neighbour is cut to fit and its rest stays unused.  What is left over in
a shard is cut into powers of two, so no sequence needs padding.  Nothing is
shuffled, and a task holds one shard.

Defined results: a null text is empty (one id, the terminator); rows with
equal keys are documents of their own; texts longer than a window fill windows
of their own first; an empty table gives an empty table; ties in score go to
the earlier document of the shard.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

WINDOW = 1024
#: A shard has at most so many documents, and ends early beyond so many ids.
BLOCK_DOCS = 1024
BLOCK_IDS = 4_000_000
#: BM25's usual parameters.
K1, B = 1.2, 0.75
#: Where every Unicode version agrees on classes, the rank file gives the ids of the tokenizer file.
PLAIN = re.compile("[^\x00-ɏ‐-‧€]")
SPECIAL = "<|endoftext|>"
SEPARATOR = 0


class Encoder:
    """Ids of texts by the byte-level vocabulary.

    Plain text goes through the same vocabulary as ranks, several times faster
    with equal ids; text with rare characters or the special token's string
    goes through the tokenizer file itself.
    """

    def __init__(self, vocabulary: str, ranks: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks, "rb") as f:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={})
        self.vocabulary, self.load, self.slow = vocabulary, Tokenizer.from_file, None

    def __call__(self, text: str) -> list[int]:
        if SPECIAL not in text and (text.isascii() or not PLAIN.search(text)):
            return self.fast.encode_ordinary(text)
        self.slow = self.slow or self.load(self.vocabulary)
        return self.slow.encode(text, add_special_tokens=False).ids


def default_vocabulary() -> tuple[str, str, str]:
    import public_tokenizers as P

    return P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN


class Index:
    """BM25 over the documents of a shard; documents are arrays of ids."""

    def __init__(self, docs: list[np.ndarray]):
        n = len(docs)
        lengths = np.array([len(d) for d in docs], np.int64)
        owner = np.repeat(np.arange(n), lengths)
        terms = np.concatenate(docs).astype(np.int64) if n else np.zeros(0, np.int64)
        self.vocabulary, inverse = np.unique(terms, return_inverse=True)
        pairs, tf = np.unique(inverse * max(n, 1) + owner, return_counts=True)
        term, self.owner = pairs // max(n, 1), pairs % max(n, 1)
        df = np.bincount(term, minlength=len(self.vocabulary))
        self.first = np.concatenate([[0], np.cumsum(df)])
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * lengths / max(1.0, lengths.mean() if n else 1.0))
        self.weight = idf[term] * tf * (K1 + 1) / (tf + norm[self.owner])
        self.n = n
        order = np.argsort(self.owner, kind="stable")
        self.terms_of = np.split(term[order], np.cumsum(np.bincount(self.owner, minlength=n))[:-1]) if n else []

    def scores(self, doc: int) -> np.ndarray:
        """BM25 of every document for the query of ``doc``'s distinct terms."""
        t = self.terms_of[doc]
        start, count = self.first[t], self.first[t + 1] - self.first[t]
        at = np.arange(count.sum()) + np.repeat(start - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
        return np.bincount(self.owner[at], self.weight[at], self.n)


def pack_block(docs: list[np.ndarray], window: int = WINDOW) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) for a shard; documents are arrays of ids, none empty."""
    seq = 0
    start = np.zeros(len(docs), np.int64)
    for d, ids in enumerate(docs):
        while len(ids) - start[d] >= window:
            yield d, int(start[d]), window, seq, 0
            start[d] += window
            seq += 1
    size = np.array([len(ids) for ids in docs], np.int64)
    tails = Index([ids[s:-1] for ids, s in zip(docs, start)])
    for seed in range(len(docs)):
        if start[seed] == size[seed]:
            continue
        if (size - start).sum() < window:
            break
        filled = int(size[seed] - start[seed])
        yield seed, int(start[seed]), filled, seq, 0
        start[seed] = size[seed]
        score = tails.scores(seed)
        unused = np.flatnonzero(start < size)
        for d in unused[np.argsort(-score[unused], kind="stable")]:
            take = int(min(size[d] - start[d], window - filled))
            yield int(d), int(start[d]), take, seq, filled
            start[d] += take
            filled += take
            if filled == window:
                break
        seq += 1
    left = int((size - start).sum())
    room, filled = 0, 0
    for d in np.flatnonzero(start < size):
        while start[d] < size[d]:
            if filled == room:
                seq += bool(room)
                room, filled = 1 << (left.bit_length() - 1), 0
            take = int(min(size[d] - start[d], room - filled))
            yield int(d), int(start[d]), take, seq, filled
            start[d] += take
            filled += take
            left -= take


def pack(df: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, with_ids: bool = False,
         vocabulary: tuple[str, str, str] | None = None) -> DataFrame:
    """Pieces of packed sequences: key, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids)."""
    files = vocabulary or default_vocabulary()
    kind = df.schema[key].dataType.simpleString()
    names = [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids

    def run(batches):
        encode = Encoder(*files)
        sequences = TaskContext.get().partitionId() << 40
        keys, docs, held, key_type = [], [], 0, None

        def packed():
            nonlocal sequences
            out, last = [], -1
            for d, start, length, seq, offset in pack_block(docs, window):
                ids = docs[d][start:start + length].astype("<u4")
                out.append((keys[d], start, length, zlib.crc32(ids.tobytes()), len(docs[d]), sequences + seq, offset,
                            *([ids.astype(np.int32)] if with_ids else [])))
                last = max(last, seq)
            sequences += last + 1
            cols = list(zip(*out)) or [()] * len(names)
            kinds = [key_type, *[pa.int64()] * 6, *[pa.list_(pa.int32())] * with_ids]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names)

        for b in batches:
            key_type = b.schema.field(0).type
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                for k, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = encode(t or "")
                    ids.append(SEPARATOR)
                    keys.append(k)
                    docs.append(np.array(ids, np.uint32))
                    held += len(ids)
                    if len(docs) >= BLOCK_DOCS or held >= BLOCK_IDS:
                        yield packed()
                        keys, docs, held = [], [], 0
        if docs:
            yield packed()

    return df.select(f"`{key}`", f"`{text}`").mapInArrow(
        run, f"`{key}` {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
             "sequence_id bigint, offset bigint" + ", ids array<int>" * with_ids)
