"""Byte-level BPE encoding and decoding with numpy matrices.

The texts of an Arrow batch are split by the tokenizer's pattern; each distinct piece is encoded once.  Pieces go into
buckets by length (powers of two), each bucket is a padded matrix of token ids, and in every round each row merges its
leftmost pair of minimum rank: a hash table gives the ranks of all adjacent pairs at once, the merge writes the new id
and the row is compacted.  A row without a mergeable pair leaves the matrix.  Rows longer than ``LONG`` bytes merge
every occurrence of their minimum-rank pair in a round (left to right, without overlaps), which gives the same ids and
keeps the number of rounds at the number of distinct merges.

Ranks come from a file of lines ``base64(token) rank``, read on the driver and sent once to each executor; the file has
a fixed size (a vocabulary).  Decoding joins the ids' bytes; bytes that aren't UTF-8 become U+FFFD in ``decoded``.

Edge cases: null counts as empty, an empty text has no ids; repeated rows are encoded each; other columns pass through
and a column named like a result column is replaced; a text of any length is encoded whole.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from panelcast.llm.common import append_columns, table, texts_of
from panelcast.llm.registry import query

LONG = 256
MATRIX_CELLS = 1 << 21
GROUP_CHARS = 4 << 20
_NONE = np.int64(1) << np.int64(40)
_EMPTY = np.int64(-1)


class PairTable:
    """Open-addressing hash table from a pair of ids to the merged id (its rank)."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray, n_ids: int):
        self.n_ids = np.int64(n_ids)
        self.shift = np.uint64(64 - max(4, int(len(merged) * 3).bit_length()))
        self.mask = (1 << (64 - int(self.shift))) - 1
        self.keys = np.full(self.mask + 1, _EMPTY)
        self.values = np.full(self.mask + 1, _NONE)
        keys = left.astype(np.int64) * self.n_ids + right
        slot, todo, self.probes = self._slot(keys), np.arange(len(keys)), 0
        while len(todo):
            free = todo[self.keys[slot[todo]] == _EMPTY]
            self.keys[slot[free]] = keys[free]  # of several in one slot, the last stays
            won = self.keys[slot[todo]] == keys[todo]
            self.values[slot[todo[won]]] = merged[todo[won]]
            todo = todo[~won]
            slot[todo] = (slot[todo] + 1) & self.mask
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``_NONE`` if it isn't one."""
        keys = left * self.n_ids + right
        slot = self._slot(keys)
        got = self.keys[slot]
        out = np.where(got == keys, self.values[slot], _NONE)
        todo = np.flatnonzero((got != keys) & (got != _EMPTY))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self.mask
            got = self.keys[slot[todo]]
            same = got == keys[todo]
            out[todo[same]] = self.values[slot[todo[same]]]
            todo = todo[~same & (got != _EMPTY)]
        return out


class Vocabulary:
    """Tokens by rank, as flat bytes with offsets, and the pair table of all ways to split a token into two."""

    def __init__(self, tokens: list[bytes]):
        rank = {t: i for i, t in enumerate(tokens)}
        self.byte_id = np.array([rank[bytes([b])] for b in range(256)], np.int64)
        pairs = [(rank[t[:i]], rank[t[i:]], r) for r, t in enumerate(tokens) for i in range(1, len(t)) if t[:i] in rank and t[i:] in rank]
        left, right, merged = np.array(pairs, np.int64).reshape(-1, 3).T
        self.pairs = PairTable(left, right, merged, len(tokens))
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.at = np.r_[0, np.cumsum([len(t) for t in tokens])].astype(np.int64)

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after another, and the n + 1 offsets."""
        lengths = np.array([len(p) for p in pieces], np.int64)
        out: list = [None] * len(pieces)
        bucket = np.ceil(np.log2(np.maximum(lengths, 1))).astype(int)
        for b in np.unique(bucket):
            rows = np.flatnonzero(bucket == b)
            step = max(1, MATRIX_CELLS >> int(b))
            for i in range(0, len(rows), step):
                self._bucket(pieces, rows[i : i + step], lengths, out)
        counts = np.array([len(x) for x in out], np.int64)
        return np.concatenate(out) if out else np.zeros(0, np.int64), np.r_[0, np.cumsum(counts)]

    def _bucket(self, pieces, rows: np.ndarray, lengths: np.ndarray, out: list) -> None:
        if int(lengths[rows].max()) > LONG:
            for r in rows:
                out[r] = self._long(self.byte_id[np.frombuffer(pieces[r], np.uint8)])
            return
        size = lengths[rows].copy()
        width = max(1, int(size.max()))
        ids = np.full((len(rows), width), _EMPTY)
        ids[np.arange(width) < size[:, None]] = self.byte_id[np.frombuffer(b"".join([pieces[r] for r in rows]), np.uint8)]
        pair = np.full((len(rows), max(1, width - 1)), _NONE)
        if width > 1:
            inside = np.arange(width - 1) < (size - 1)[:, None]
            pair[inside] = self.pairs.rank(ids[:, :-1][inside], ids[:, 1:][inside])
        while len(rows):
            best = pair.argmin(axis=1)  # the first of equal minima: the leftmost
            new = pair[np.arange(len(rows)), best]
            done = new == _NONE
            if done.any():
                for r, x, n in zip(rows[done], ids[done], size[done]):
                    out[r] = x[:n].copy()
                go = ~done
                rows, ids, pair, size, best, new = rows[go], ids[go], pair[go], size[go], best[go], new[go]
                if not len(rows):
                    break
                width = int(size.max())
                ids, pair = ids[:, :width], pair[:, : max(1, width - 1)]
            line = np.arange(len(rows))
            # compaction: everything right of the merged pair moves one place to the left
            ids[line, best] = new
            cols = np.arange(width)
            source = np.minimum(cols + (cols > best[:, None]), width - 1)
            ids = np.take_along_axis(ids, source, axis=1)
            size -= 1
            cols = np.arange(pair.shape[1])
            source = np.minimum(cols + (cols > best[:, None]), pair.shape[1] - 1)
            pair = np.take_along_axis(pair, source, axis=1)
            pair[cols >= (size - 1)[:, None]] = _NONE
            for shift in (0, -1):  # the two pairs that hold the new id
                at = best + shift
                ok = (at >= 0) & (at + 1 < size)
                pair[line[ok], at[ok]] = self.pairs.rank(ids[line[ok], at[ok]], ids[line[ok], at[ok] + 1])

    def _long(self, ids: np.ndarray) -> np.ndarray:
        pair = self.pairs.rank(ids[:-1], ids[1:])
        while len(pair) and (new := pair.min()) != _NONE:
            at = np.flatnonzero(pair == new)
            run = np.cumsum(np.r_[True, np.diff(at) > 1]) - 1  # of overlapping pairs (aaa), every second merges
            begin = np.flatnonzero(np.r_[True, np.diff(at) > 1])
            at = at[(at - at[begin][run]) % 2 == 0]
            ids = ids.copy()
            ids[at] = new
            ids = np.delete(ids, at + 1)
            at = at - np.arange(len(at))
            pair = np.delete(pair, np.minimum(at + np.arange(len(at)) + 1, len(pair) - 1)) if len(pair) else pair
            pair = pair[: len(ids) - 1]
            near = np.unique(np.r_[at - 1, at])
            near = near[(near >= 0) & (near < len(ids) - 1)]
            pair[near] = self.pairs.rank(ids[near], ids[near + 1])
        return ids

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of all ids, one after another."""
        return gather(self.bytes, self.at, ids)[0]


def gather(values: np.ndarray, at: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenation of the ranges ``picks`` of a flat array with offsets ``at``; offsets of the result."""
    n = (at[1:] - at[:-1])[picks]
    ends = np.cumsum(n)
    where = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(at[picks] - (ends - n), n)
    return values[where], np.r_[0, ends]


@lru_cache(maxsize=2)
def _built(ranks: bytes) -> Vocabulary:
    rows = sorted((int(r), base64.b64decode(t)) for t, r in map(bytes.split, ranks.splitlines()) if t)
    return Vocabulary([t for _, t in rows])


class _Codes(dict):
    """Distinct pieces, numbered as they come."""

    def __missing__(self, piece: str) -> int:
        self[piece] = n = len(self)
        return n


def encode_texts(texts: list[str], vocabulary: Vocabulary, split) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another, and the n + 1 offsets."""
    codes = _Codes()
    per_text = [np.fromiter(map(codes.__getitem__, split(t)), np.int64) for t in texts]
    ids, at = vocabulary.encode([p.encode("utf-8", "surrogatepass") for p in codes])
    counts = np.r_[0, np.cumsum([len(x) for x in per_text])].astype(np.int64)
    flat, offsets = gather(ids, at, np.concatenate(per_text) if per_text else np.zeros(0, np.int64))
    return flat, offsets[counts]


def _groups(texts: list[str]):
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size > GROUP_CHARS:
            yield texts[start : i + 1]
            start, size = i + 1, 0
    if start < len(texts):
        yield texts[start:]


ENCODED = "ids array<int>, n_tokens long"
DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def _operator(df: DataFrame, ranks_path: str, pattern: str, text_col: str, schema, rows) -> DataFrame:
    with open(ranks_path, "rb") as f:
        ranks = df.sparkSession.sparkContext.broadcast(f.read())

    def run(batch):
        vocabulary, split = _built(ranks.value), regex.compile(pattern).findall
        made = []
        for texts in _groups(texts_of(batch.column(text_col))):
            made += rows(vocabulary, *encode_texts(texts, vocabulary, split))
        return list(zip(*made)) if made else [[] for _ in schema.names]

    return append_columns(df, schema, run)


def encode(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``df`` with ``ids`` and ``n_tokens``."""
    def rows(vocabulary, ids, at):
        return [(ids[a:b].astype(np.int32), int(b - a)) for a, b in zip(at, at[1:])]

    return _operator(df, ranks_path, pattern, text_col, T._parse_datatype_string(ENCODED), rows)


def decode(df: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """``df`` with ``decoded``, the text of ``ids_col`` (null counts as no ids)."""
    with open(ranks_path, "rb") as f:
        ranks = df.sparkSession.sparkContext.broadcast(f.read())

    def run(batch):
        vocabulary = _built(ranks.value)
        lists = [np.array(x if x is not None else [], np.int64) for x in batch.column(ids_col).to_pylist()]
        return [[vocabulary.decode(x).tobytes().decode("utf-8", "replace") for x in lists]]

    return append_columns(df, "decoded string", run)


def round_trip_digests(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``df`` with the number of ids and SHA-256 of the ids (little-endian uint32) and of the bytes decoded from them."""
    def rows(vocabulary, ids, at):
        wide = ids.astype("<u4")
        data, ends = gather(vocabulary.bytes, vocabulary.at, ids)
        ends = ends[at]
        return [(int(b - a), hashlib.sha256(wide[a:b]).hexdigest(), hashlib.sha256(data[x:y]).hexdigest())
                for a, b, x, y in zip(at, at[1:], ends, ends[1:])]

    return _operator(df, ranks_path, pattern, text_col, T._parse_datatype_string(DIGESTS), rows)


@query("op5_byte_bpe")
def op5_byte_bpe(spark, sf_dir):
    import public_tokenizers as P

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip_digests(docs, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).drop("text")
