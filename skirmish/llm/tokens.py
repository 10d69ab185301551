"""Token counts (operator 3): rank-synchronous merging over ragged arrays.

Texts are cut at isolated spaces, which always start a new pre-token, so a
slice becomes a dictionary of distinct units and an index array (both made by
Arrow). Only the distinct pre-tokens of those units are merged (``bpe.merge``);
a document's count is the sum over its index range. Nothing is shuffled: one
narrow pass over the texts.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skirmish.llm.bpe import Vocabulary, vocabulary

# The pre-token patterns of the two vocabularies.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_RUN = re.compile(r"\s{2,}")
_RUN_RE2 = r"[\x01\x02]|[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]{2}"
_HELD = "\x01"  # stands for a space inside a run of white space while a text is cut
_SLICE = 8 << 20
_PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # without the apostrophe, which can start a pre-token


class UnitEncoder:
    """Token ids of texts, found once per distinct unit of a slice.

    A unit of letters with a tail of punctuation is two pre-tokens, cut by
    Arrow; any other unit goes through the pre-token pattern.
    """

    def __init__(self, vocab: Vocabulary, pattern: str, spaces: bool):
        """``spaces``: a unit keeps the space before it, and white space
        counts (byte level); else units are brought to ``lower_nfc``."""
        self.vocab, self.spaces = vocab, spaces
        self.find = regex.compile(pattern).findall
        self.split = re.compile("(" + "|".join(map(re.escape, vocab.special)) + ")").split
        self.marks = tuple(vocab.special)

    def _words(self, unit: str) -> list[str]:
        """Pre-tokens of one unit in order; special tokens stay whole."""
        prepare = (lambda x: x) if self.spaces else lower_nfc
        if not any(m in unit for m in self.marks):
            return self.find(prepare(unit))
        out: list[str] = []
        for part in self.split(unit):
            out += [part] if part in self.vocab.special else self.find(prepare(part))
        return out

    def _pieces(self, texts: pa.Array):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if self.spaces:
            odd = pc.match_substring_regex(texts, _RUN_RE2)
            if pc.any(odd).as_py():
                texts = _hold(texts, odd)
        pieces = pc.split_pattern(texts, " ")
        offsets = pieces.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
        coded = pieces.flatten().dictionary_encode()
        return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), offsets - offsets[0]

    def encode(self, texts: pa.Array):
        """(ids, starts, counts, words, rows, offsets): text i is the units
        ``rows[offsets[i]:offsets[i + 1]]``; unit u has the ids from
        ``starts[u]`` on, ``counts[u]`` of them, and is the word ``words[u]``
        (-1: none): its core, or itself if it has several pre-tokens."""
        units, rows, offsets = self._pieces(texts)
        cores = units if self.spaces else pc.utf8_lower(units)
        trimmed = pc.utf8_rtrim(cores, characters=_PUNCTUATION)
        plain = pc.utf8_is_alpha(trimmed)
        if not self.spaces:
            plain = pc.and_not(plain, pc.match_substring(units, "İ"))  # its lower case is two letters
        plain = plain.to_numpy(zero_copy_only=False)
        if not self.spaces:
            other = np.flatnonzero(~pc.string_is_ascii(units).to_numpy(zero_copy_only=False))
            plain = plain.copy()
            plain[other] &= np.fromiter((unicodedata.is_normalized("NFC", u) for u in units.take(pa.array(other)).to_pylist()),
                                        bool, len(other))
        tails = _drop_heads(cores.cast(pa.large_binary()), pc.binary_length(trimmed).to_numpy(zero_copy_only=False))
        if self.spaces:
            space, none = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
            trimmed = pc.binary_join_element_wise(space, trimmed, none)
        # Irregular units, and the first units of the texts (no space before them), in Python.
        odd = np.flatnonzero(~plain)
        names = units.take(pa.array(odd)).to_pylist()
        if self.spaces:
            first_rows = rows[offsets[:-1]]
            first, back = np.unique(first_rows, return_inverse=True)
            names = [" " + u.replace(_HELD, " ") for u in names] + [_whole(u) for u in units.take(pa.array(first)).to_pylist()]
            rows[offsets[:-1]] = len(units) + back
        marked = any(pc.any(pc.match_substring(units, m)).as_py() for m in self.marks)
        words = [self._words(u) for u in names] if marked or self.spaces else [self.find(lower_nfc(u)) for u in names]
        flat = pa.array([w.encode("utf-8", "replace") for ws in words for w in ws], pa.large_binary())
        n_words = np.fromiter(map(len, words), np.int64, len(words))
        return self._ids(trimmed.cast(pa.large_binary()), tails, plain, odd, flat, n_words) + (rows, offsets)

    def _ids(self, cores, tails, plain, odd, flat, n_words):
        n, extra = len(plain), len(n_words) - len(odd)
        keep = pa.array(plain)
        known = pa.concat_arrays([cores.filter(keep), tails.filter(keep), flat]).dictionary_encode()
        code = known.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        ids, per_word = self.vocab.encode(known.dictionary)
        for name, special in self.vocab.special.items():  # a special token is one id, whatever it would merge to
            at = pc.index(known.dictionary, pa.scalar(name.encode(), pa.large_binary())).as_py()
            if at >= 0:
                begin = int(per_word[:at].sum())
                ids = np.r_[ids[:begin], [special], ids[begin + per_word[at]:]]
                per_word[at] = 1
        word_start = np.r_[0, np.cumsum(per_word)]
        m = int(plain.sum())
        sizes = np.full(n + extra, 2, np.int64)
        sizes[odd], sizes[n:] = n_words[:len(odd)], n_words[len(odd):]
        begin = np.cumsum(sizes) - sizes
        order = np.zeros(int(sizes.sum()), np.int64)
        regular = np.flatnonzero(plain)
        order[begin[regular]], order[begin[regular] + 1] = code[:m], code[m:2 * m]
        order[spread(np.r_[begin[odd], begin[n:]], n_words)] = code[2 * m:]
        per = per_word[order]
        total = np.r_[0, np.cumsum(per)]
        counts = total[begin + sizes] - total[begin]
        words = np.where(sizes > 0, np.r_[order, -1][begin], -1)
        several = odd[n_words[:len(odd)] > 1]
        words[several] = len(per_word) + several
        return ids[spread(word_start[order], per)], total[begin], counts, words


def spread(starts, sizes):
    """The positions of all ranges [start, start + size), one after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def _drop_heads(values: pa.Array, heads) -> pa.Array:
    """Each binary value without its first ``heads`` bytes."""
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset:values.offset + len(values) + 1]
    raw = np.frombuffer(values.buffers()[2] or b"", np.uint8)
    sizes = np.diff(offsets) - heads
    out = raw[spread(offsets[:-1] + heads, sizes)]
    return pa.Array.from_buffers(pa.large_binary(), len(values),
                                 [None, pa.py_buffer(np.r_[0, np.cumsum(sizes)].astype(np.int64)), pa.py_buffer(out)])


def _hold(texts: pa.Array, odd: pa.Array) -> pa.Array:
    """Spaces in runs of white space become a stand-in, so only isolated
    spaces cut. A text that holds the stand-in or the mark \\x02 itself is left
    uncut: all its spaces become stand-ins, its own ones are written marked."""
    out = texts.to_pylist()
    for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)):
        if _HELD in out[i] or "\x02" in out[i]:
            out[i] = "\x02" + out[i].replace("\x02", "\x02b").replace(_HELD, "\x02a").replace(" ", _HELD)
        else:
            out[i] = _RUN.sub(lambda m: m.group().replace(" ", _HELD), out[i])
    return pa.array(out, pa.large_string())


def _whole(unit: str) -> str:
    """The first unit of a text as it was before ``_hold``."""
    if unit.startswith("\x02"):
        return unit[1:].replace(_HELD, " ").replace("\x02a", _HELD).replace("\x02b", "\x02")
    return unit.replace(_HELD, " ")


def slices(batch: pa.RecordBatch, column: str, most: int = _SLICE) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``most`` bytes of text each (one row at least)."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        base = size[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(size, base + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def lower_nfc(text: str) -> str:
    """The word vocabulary's normal form: NFC, lower case letter by letter."""
    return text.lower() if text.isascii() else unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def count_tokens(df: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 1024) -> DataFrame:
    """Tokens of every whole text with the byte-level vocabulary at ``vocab_path``.

    Returns ``id_col``, n_bytes (UTF-8), n_tokens, over_limit (n_tokens >
    ``limit``). Null and empty texts have 0 bytes and 0 tokens; a null id stays
    null; repeated rows are counted each; special strings inside a text are one
    token; other columns are not read. An empty table gives an empty result.
    """
    id_type = df.schema[id_col].dataType.simpleString()

    def count(batches):
        encoder = UnitEncoder(vocabulary(vocab_path), BYTE_LEVEL, spaces=True)
        for batch in batches:
            for part in slices(batch, "text"):
                _, _, counts, _, rows, offsets = encoder.encode(part.column("text"))
                total = np.r_[0, np.cumsum(counts[rows])]
                n = total[offsets[1:]] - total[offsets[:-1]]
                n_bytes = pc.fill_null(pc.binary_length(part.column("text")), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("id"), n_bytes, pa.array(n, pa.int64())],
                                                 names=[id_col, "n_bytes", "n_tokens"])

    counted = (df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
               .mapInArrow(count, f"`{id_col}` {id_type}, n_bytes long, n_tokens long"))
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
