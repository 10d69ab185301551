"""Packing (operator 4): lexical retrieval with a BM25 index over the whole table.

Every hundredth document is a query, looked up in the whole table
(``neighbours``); documents that score best for one query lie together, best
BM25 score first. A window starts with a seed document; what was found with it
fills the window, then the unused documents of the memory slice that share the
seed's rarest words (``Shard``). The document that overflows is cut, and its
rest is the next seed. Slices bound a task's memory and not the search. An
unfinished window goes on into the partition's next slice; the last one is cut
into sequences of powers of two, so no sequence is padded.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skirmish.llm.bpe import vocabulary
from skirmish.llm.neighbours import B, K1, gathered, is_query, node
from skirmish.llm.tokens import WORD_LEVEL, UnitEncoder, slices, spread


class Shard:
    """BM25 inverted index over the documents of one shard."""

    def __init__(self, terms: np.ndarray, offsets: np.ndarray, query_terms: int):
        """``terms``: word numbers of all documents, flat; -1 is no word."""
        self.n, self.query_terms = len(offsets) - 1, query_terms
        doc = np.repeat(np.arange(self.n), np.diff(offsets))
        key = np.sort((terms * self.n + doc)[terms >= 0])
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        tf = np.diff(np.r_[first, len(key)])
        term, self.doc = np.divmod(key[first], max(self.n, 1))
        size = np.diff(offsets)
        norm = K1 * (1 - B + B * size[self.doc] / max(size.mean() if self.n else 1, 1e-9))
        df = np.bincount(term) if len(term) else np.zeros(1, np.int64)
        idf = np.log1p((self.n - df + 0.5) / (df + 0.5))
        self.weight = idf[term] * tf * (K1 + 1) / (tf + norm)
        self.begin = np.r_[0, np.cumsum(df)]
        self.df = df
        # Forward lists: the terms of each document that another one has too, rarest first.
        shared = np.flatnonzero(df[term] > 1)
        rarity = np.argsort(df, kind="stable")
        place = np.empty(len(df), np.int64)
        place[rarity] = np.arange(len(df))
        key = np.sort(self.doc[shared] * len(df) + place[term[shared]])
        self.forward = rarity[key % len(df)]
        self.forward_at = np.searchsorted(key, np.arange(self.n + 1) * len(df))

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused documents that share query terms with the seed, best first
        (ties by position)."""
        query = self.forward[self.forward_at[seed]:self.forward_at[seed + 1]][:self.query_terms]
        if not len(query):
            return query
        at = spread(self.begin[query], self.df[query])
        at = at[unused[self.doc[at]]]
        docs, back = np.unique(self.doc[at], return_inverse=True)
        return docs[np.lexsort((docs, -np.bincount(back, self.weight[at], len(docs))))]


class Packer:
    """Fills windows of one partition; ``pieces`` is (shard's document, start,
    length, sequence, offset)."""

    def __init__(self, window: int, first_sequence: int):
        self.window, self.sequence, self.filled = window, first_sequence, 0
        self.pieces: list[tuple[int, int, int, int, int]] = []
        self.open: list[int] = []  # lengths in the open window

    def put(self, doc: int, start: int, length: int) -> None:
        """Lay a document's ids from ``start`` on into windows."""
        while length:
            part = min(length, self.window - self.filled)
            self.pieces.append((doc, start, part, self.sequence, self.filled))
            start, length, self.filled = start + part, length - part, self.filled + part
            if self.filled == self.window:
                self.sequence, self.filled = self.sequence + 1, 0

    def pack(self, shard: Shard, sizes: list[int], near: list[list[int]]) -> None:
        """``near``: the documents of the slice that each one has as
        neighbours in the whole table, best first."""
        unused = np.ones(shard.n, bool)
        for seed in range(shard.n):
            if unused[seed]:
                unused[seed] = False
                self.put(seed, 0, sizes[seed])
                last = seed
                while self.filled:  # fill the window that the seed has opened
                    window = self.sequence
                    linked = [d for d in near[last] if unused[d]]
                    for doc in linked or shard.neighbours(last, unused).tolist():
                        unused[doc] = False
                        self.put(doc, 0, sizes[doc])
                        last = doc
                        if self.sequence != window:
                            break  # full: the cut document's rest is the next seed
                    else:
                        break  # no neighbour is left: go on with the next unused document


def powers_of_two(pieces, filled: int, sequence: int):
    """Cut the pieces of an unfinished window into sequences whose lengths are
    the powers of two that make up ``filled``."""
    sizes = [1 << b for b in range(filled.bit_length() - 1, -1, -1) if filled >> b & 1]
    begins = np.r_[0, np.cumsum(sizes)].tolist()
    for doc, start, length, _, offset in pieces:
        while length:
            k = int(np.searchsorted(begins, offset, side="right")) - 1
            part = min(length, begins[k + 1] - offset)
            yield doc, start, part, sequence + k, offset - begins[k]
            start, length, offset = start + part, length - part, offset + part


def pack_documents(df: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text",
                   window: int = 2048, end_id: int = 1, query_terms: int = 24, with_ids: bool = False) -> DataFrame:
    """Pack all documents into sequences of at most ``window`` ids.

    A document's ids are those of the word-level vocabulary at ``vocab_path``
    (no special tokens added) and then ``end_id``. Returns one row per piece:
    ``id_col``, start, length, ids_crc32 (of the ids as little-endian unsigned
    32-bit numbers), doc_tokens, sequence_id, offset; ``with_ids`` adds the
    ids themselves. A null or empty text is the single ``end_id``; a null id
    stays null; repeated rows are packed each; a text longer than a window
    spans several; other columns are not read; an empty table gives no row.
    ``query_terms`` is the number of the seed's rarest shared words that are
    looked up; any other unused document still follows.
    Sequence ids are the partition number times 2^33 plus a counter.
    """
    id_type = df.schema[id_col].dataType.simpleString()
    schema = (f"`{id_col}` {id_type}, start long, length long, ids_crc32 long, doc_tokens long, "
              "sequence_id long, offset long" + (", ids array<int>" if with_ids else ""))

    def linked(part):
        """Positions in the slice of each document's copies, and of those found
        by the same query for the first one of them."""
        nodes, groups = (part.column(c).to_numpy(zero_copy_only=False) for c in ("node", "group"))
        near = [range(0)] * len(nodes)
        for values in (nodes, groups):  # equal ones lie together
            begin = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]).tolist()
            for start, stop in zip(begin, [*begin[1:], len(values)], strict=True):
                if values is groups:
                    near[start] = range(start, stop)
                elif stop - start > 1:
                    near[start:stop] = [range(start, stop)] * (stop - start)
        return near

    def pack(batches):
        encoder = UnitEncoder(vocabulary(vocab_path), WORD_LEVEL, spaces=False)
        packer = Packer(window, TaskContext.get().partitionId() << 33)
        held: list[tuple] = []  # finished columns of the pieces in the open window
        for batch in batches:
            for part in slices(batch, "text"):
                ids, starts, counts, words, rows, offsets = encoder.encode(part.column("text"))
                total = np.r_[0, np.cumsum(counts[rows])]
                sizes = total[offsets[1:]] - total[offsets[:-1]] + 1
                begin = np.r_[0, np.cumsum(sizes)]
                flat = np.full(begin[-1], end_id, np.uint32)
                inner = np.ones(begin[-1], bool)
                inner[begin[1:] - 1] = False
                flat[inner] = ids[spread(starts[rows], counts[rows])]
                packer.pieces = []
                packer.pack(Shard(words[rows], offsets, query_terms), sizes.tolist(), linked(part))
                names = part.column("id").to_pylist()
                done = held + [(names[d], s, n, int(sizes[d]), q, o, flat[begin[d] + s:begin[d] + s + n])
                               for d, s, n, q, o in packer.pieces]
                cut = len(done)
                while cut and packer.filled and done[cut - 1][4] == packer.sequence:
                    cut -= 1
                held = [(*h[:6], h[6].copy()) for h in done[cut:]]
                yield emit(done[:cut])
        rest = powers_of_two([(i, 0, h[2], h[4], h[5]) for i, h in enumerate(held)], packer.filled, packer.sequence)
        yield emit([(held[i][0], held[i][1] + s, n, held[i][3], q, o, held[i][6][s:s + n]) for i, s, n, q, o in rest])

    def emit(pieces):
        name, start, length, size, sequence, offset, ids = zip(*pieces, strict=True) if pieces else [()] * 7
        columns = [pa.array(name, arrow_id), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                   pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array(size, pa.int64()),
                   pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())]
        if with_ids:
            columns.append(pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(columns, names=names_out)

    from pyspark.sql.pandas.types import to_arrow_type

    arrow_id = to_arrow_type(df.schema[id_col].dataType)
    names_out = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), node(F.col(text_col)).alias("node"),
                      is_query(df, id_col).alias("query"))
    return gathered(texts, query_terms).mapInArrow(pack, schema)
