"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

``fit`` takes a bounded sample of labelled rows (``max_examples``, lowest digests of the id; equal texts count once) and
indexes all their words: none is cut.  Document frequencies of the words are counted over all documents.  A word's IDF
is multiplied by its relevance, the logarithm of its odds of label 1 relative to all examples (lower bound at two
standard deviations, at least 0) plus ``REST``: words that speak for label 1 weigh most, the others still tell
near copies, and a word seen once hardly gains.  The examples' normalised vectors go into an inverted index.

A query adds up the short posting lists.  The long lists lie in groups; by Cauchy-Schwarz a group adds at most the norm of
the query's weights in it times that of the example's.  Examples that can't reach with all groups the k-th best of those
whose bounds lead are out.  Few others get the rest one by one, many by a product of dense rows: the k nearest are exact (to
1e-6), ties go to the example that comes first in the index, in order of their norms.  Votes are weighted by 1 / (distance + 0.1).  They are calibrated to probabilities by
monotone regression over 20 bins, on votes that each half of the examples gets from the other half, relevance included:
an example's own label has no part in its vote.  ``evidence`` holds the neighbours' similarities and labels.

The index has at most ``max_examples`` sparse rows, so it is sent to the executors once.

Edge cases: null counts as empty; a text without any word of an example gets the smoothed share of label 1 among such examples;
null labels don't count, of several labels of an id the largest does; labels without a row are left out; without
examples every score is 0; repeated rows are scored each; extra columns pass through, one named like a result is
replaced.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections import Counter
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from panelcast.llm.common import append_columns, boxed, table, texts_of
from panelcast.llm.registry import query
from panelcast.session import materialize

MAX_EXAMPLES = 20_000
#: Relevance of words that don't speak for label 1.
REST = 0.3
NEIGHBOURS = 15
#: Posting lists longer than this share of the examples are also kept as dense rows, in so many groups with norms by example.
LONG = 1 / 12
GROUPS = 40
#: Posting lists up to this length are short enough to be looked up together.
FEW = 100
#: At least so many examples of the largest bounds set the least score of the others.
LEAD = 64
#: So many texts' dense parts are multiplied together.
TOGETHER = 32
BINS = 20
LEAST_SCORE = 0.7
_WORD = re.compile(r"[^\W_]+")
#: So many texts become numbers, or are scored, at a time.
PIECE = 256
#: Rows that a worker numbers or scores before it hands them back.
ROWS = 2048
SCORED = "score double, evidence array<struct<similarity:double,label:int>>"


#: Latin-1 characters that belong to no word, as spaces.
_SPACED = bytes(c if _WORD.fullmatch(chr(c)) else 0x20 for c in range(256))


def words_of(text: str) -> list[str]:
    low = text.lower()
    try:  # the same words, in less time
        return low.encode("latin-1").translate(_SPACED).decode("latin-1").split()
    except UnicodeEncodeError:
        return _WORD.findall(low)


def _distinct_terms(batches):
    """The words of a partition's texts; sent on when they get many."""
    terms: set = set()
    for b in batches:
        for text in texts_of(b.column("text")):
            terms.update(words_of(text))
            if len(terms) > 500_000:
                yield pa.RecordBatch.from_arrays([pa.array(list(terms), pa.string())], names=["term"])
                terms.clear()
    yield pa.RecordBatch.from_arrays([pa.array(list(terms), pa.string())], names=["term"])


class Numbers:
    """Sorted words and their numbers.  The driver and the broadcasts hold an Arrow array; a worker makes the look-up table
    once, keeps only the last one, and forgets it where it scores: scoring takes numbers."""

    _last: tuple[str, dict] = ("", {})

    def __init__(self, words: pa.Array):
        self.words = words.take(pa.compute.array_sort_indices(words))
        self.key = uuid.uuid4().hex

    def __len__(self) -> int:
        return len(self.words)

    def __iter__(self):
        return iter(self.words.to_pylist())

    @property
    def known(self) -> dict:
        if Numbers._last[0] != self.key:
            Numbers._last = ("", {})
            Numbers._last = (self.key, {w: i for i, w in enumerate(self.words.to_pylist())})
        return Numbers._last[1]

    @staticmethod
    def forget() -> None:
        Numbers._last = ("", {})


def table_of(known: dict | Numbers) -> dict:
    return known.known if isinstance(known, Numbers) else known


def counted(text: str, known: dict) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of a text's known words, ascending, and how often each occurs."""
    ids, counts = np.unique(np.array([known.get(w, -1) for w in words_of(text)], np.int64), return_counts=True)
    unknown = int(len(ids) > 0 and ids[0] < 0)
    return ids[unknown:], counts[unknown:]


def counted_all(texts: list[str], known: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """:func:`counted` of many texts, one after another: how many numbers each has, the numbers, the counts."""
    sizes, ids, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    wide, get = max(len(known), 1), known.get
    for i in range(0, len(texts), PIECE):
        found = [Counter(words_of(t)) for t in texts[i : i + PIECE]]
        row = np.repeat(np.arange(len(found)), [len(c) for c in found])
        word = np.array([get(w, -1) for c in found for w in c], np.int64)
        n = np.array([x for c in found for x in c.values()], np.int32)
        key = row * wide + word
        order = np.argsort(key)
        order = order[word[order] >= 0]
        sizes.append(np.bincount(row[order], minlength=len(found)))
        ids.append(word[order].astype(np.int32))
        counts.append(n[order])
    return np.concatenate(sizes), np.concatenate(ids), np.concatenate(counts)


def lists(sizes, values: pa.Array, kind: pa.DataType) -> pa.Array:
    """Lists of ``sizes`` values, one after another."""
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), values, type=kind)


def idf_of(n_docs: int, freq: np.ndarray) -> np.ndarray:
    return np.log((n_docs + 1) / (freq + 1)) + 1e-6


def examples_of(docs: DataFrame, labels: DataFrame, max_examples: int) -> DataFrame:
    """(text, label) of a bounded sample of the labelled documents, equal texts once; docs (id, text), labels (id, label)."""
    picked = (labels.filter("id IS NOT NULL AND label IS NOT NULL").groupBy("id").agg(F.max("label").alias("label"))
              .orderBy(F.md5(F.col("id").cast("string")), "id").limit(max_examples))
    rows = docs.join(F.broadcast(picked), "id")  # at most max_examples rows of two numbers
    text = F.coalesce(F.col("text"), F.lit(""))
    return rows.groupBy(F.sha2(text, 256).alias("key")).agg(F.first(text).alias("text"), F.max("label").cast("int").alias("label"))


def relevance(d: np.ndarray, t: np.ndarray, n: int, ones: int) -> np.ndarray:
    """Factor per term: log of its odds of label 1 (a sure lower bound) relative to all examples, at least 0, plus ``REST``.

    ``d`` of the ``n`` examples hold the term, ``t`` of them with label 1."""
    if not 0 < ones < n:
        return np.full(len(d), REST)
    d, z = np.maximum(d, 1), 2.0
    share = t / d
    low = (share + z * z / (2 * d) - z * np.sqrt(share * (1 - share) / d + z * z / (4 * d * d))) / (1 + z * z / d)
    odds = low / (1 - low + 1e-9) / (ones / (n - ones))
    return np.log(np.maximum(odds, 1.0)) + REST


def numbered_docs(df: DataFrame, sent, text_col: str = "text") -> DataFrame:
    """``df`` without its text, but with the text's word numbers (broadcast ``sent``) and counts; written, as counts and scores read it."""
    numbers = T._parse_datatype_string("terms array<int>, counts array<int>")
    kinds = [f.type for f in to_arrow_schema(numbers)]

    def run(batch):
        sizes, ids, counts = counted_all(texts_of(batch.column(text_col)), table_of(sent.value))
        return [lists(sizes, pa.array(x), kind) for x, kind in zip((ids, counts), kinds)]

    with_numbers = append_columns(df, numbers, run, ROWS)
    return materialize(with_numbers.select(*[F.col(f"`{c}`") for c in with_numbers.columns if c != text_col]), "toxicity-numbers")


def _document_frequencies(docs: DataFrame, n_terms: int, sent=None) -> tuple[int, np.ndarray]:
    """Number of documents, and of those that hold each term; counted over all documents: by their ``terms``, or with the
    broadcast words ``sent`` by their ``text``, whose numbers are then not written."""

    def terms_of(b):
        return b.column("terms").flatten().to_numpy() if sent is None else counted_all(texts_of(b.column("text")), table_of(sent.value))[1]

    def count(batches):
        n, freq = 0, np.zeros(n_terms, np.int64)
        for b in batches:
            n += b.num_rows
            for i in range(0, b.num_rows, ROWS):
                freq += np.bincount(terms_of(b.slice(i, ROWS)), minlength=n_terms)
        ids = np.flatnonzero(freq)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, ids], pa.int64()), pa.array(np.r_[n, freq[ids]], pa.int64())], names=["term", "n"])

    rows = docs.select("terms" if sent is None else "text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # one row per term
    term, n = rows.column("term").to_numpy(), rows.column("n").to_numpy()
    freq = np.zeros(n_terms, np.int64)
    freq[term[term >= 0]] = n[term >= 0]
    return int(n[term < 0].sum()), freq


@dataclass
class Index:
    """Postings of the examples' weighted TF-IDF vectors."""

    known: dict | Numbers
    idf: np.ndarray  # times relevance
    labels: np.ndarray
    starts: np.ndarray  # postings of term t: starts[t] up to the next
    example: np.ndarray
    weight: np.ndarray
    block_max: np.ndarray  # term x 1
    calibration: np.ndarray | None = None
    prior: float = 0.0
    _dense: tuple | None = None

    @classmethod
    def build(cls, terms: list[str], n_docs: int, freq: np.ndarray, texts: list[str], labels: list[int], factor: np.ndarray | None = None) -> Index:
        known = {t: i for i, t in enumerate(terms)}
        found = [counted(t, known) for t in texts]
        sizes = [len(t) for t, _ in found]
        ids = np.concatenate([t for t, _ in found]) if found else np.zeros(0, np.int64)
        counts = np.concatenate([c for _, c in found]) if found else np.zeros(0, np.int64)
        return cls.of(known, idf_of(n_docs, freq) * (1.0 if factor is None else factor), np.array(sizes, np.int64), ids, counts, np.array(labels, np.int8))

    @classmethod
    def of(cls, known: dict, idf: np.ndarray, sizes: np.ndarray, ids: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> Index:
        """From the examples' terms, one after another (``sizes`` terms each), and how often each occurs."""
        bare = labels[sizes == 0]
        prior = (float(bare.sum()) + labels.sum() / max(1, len(labels))) / (len(bare) + 1) if len(labels) else 0.0
        n = int((sizes > 0).sum())
        row = np.repeat(np.arange(n, dtype=np.uint16 if n < 1 << 16 else np.int32), sizes[sizes > 0])
        weight = (1 + np.log(counts, dtype=np.float32)) * idf.astype(np.float32)[ids]
        norm = np.sqrt(np.bincount(row, weight * weight, n)).astype(np.float32)
        weight /= norm[row]
        by_norm = np.argsort(norm, kind="stable")
        rank = np.zeros(n, row.dtype)
        rank[by_norm] = np.arange(n)
        row = rank[row]
        order = np.lexsort((row, ids))
        starts = np.r_[0, np.cumsum(np.bincount(ids, minlength=len(idf)))]
        weight, row = weight[order], row[order]
        most = np.zeros((len(idf), 1), np.float32)
        has = np.flatnonzero(np.diff(starts))
        if len(has):
            most[has, 0] = np.maximum.reduceat(weight, starts[has])
        return cls(known, idf, labels[sizes > 0][by_norm], starts, row, weight, most, None, float(prior))

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Terms and normalised weights of a text."""
        return self.weigh(*counted(text, table_of(self.known)))

    def weigh(self, terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        weights = (1 + np.log(counts)) * self.idf[terms] if len(terms) else np.zeros(0)
        return terms, weights / np.sqrt((weights**2).sum()) if len(terms) else weights

    def _long(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Column of each term with a long posting list (or -1), examples x these terms, longest list first, the group of each
        column, the norms of the examples' weights by group; once per process."""
        if self._dense is None:
            n, sizes = len(self.labels), np.diff(self.starts)
            terms = np.flatnonzero(sizes > max(LONG * n, 16))
            terms = terms[np.argsort(-sizes[terms], kind="stable")]
            rows, at = np.zeros((n, len(terms)), np.float32), np.full(len(self.idf), -1)
            for i, t in enumerate(terms):
                a, z = self.starts[t], self.starts[t + 1]
                rows[self.example[a:z], i] = self.weight[a:z]
            at[terms] = np.arange(len(terms))
            n_groups = min(GROUPS, len(terms))
            group = np.arange(len(terms)) * n_groups // max(len(terms), 1)
            norms = np.zeros((n_groups, n), np.float32)
            for g in range(n_groups):
                norms[g] = np.sqrt((rows[:, group == g] ** 2).sum(axis=1))
            self._dense = at, rows, group, norms
        return self._dense

    def _short_sums(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        first, last = self.starts[terms], self.starts[terms + 1]
        sizes = last - first
        many, few = np.flatnonzero(sizes > FEW), np.flatnonzero(sizes <= FEW)  # few postings are looked up, many are sliced
        sums = np.zeros(len(self.labels))
        if len(few):
            size = sizes[few]
            at = np.arange(size.sum()) + np.repeat(first[few] - np.cumsum(size) + size, size)
            sums += np.bincount(self.example[at], self.weight[at] * np.repeat(weights[few], size), len(sums))
        if len(many):
            weight, example, ends = self.weight, self.example, list(zip(first[many].tolist(), last[many].tolist()))
            pulls = np.repeat(weights[many], sizes[many])
            pulls *= np.concatenate([weight[a:z] for a, z in ends])
            sums += np.bincount(np.concatenate([example[a:z] for a, z in ends]), pulls, len(sums))
        return sums

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest examples and their cosines, exact."""
        return self.nearest_all([(terms, weights)], k)[0]

    def nearest_all(self, vectors: list, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """``nearest`` of several texts, whose dense parts are multiplied together."""
        at, rows, group, norms = self._long()
        n = len(self.labels)

        def best(near, scores):
            full = scores > 1e-9
            near, scores = near[full], np.round(scores[full], 6)
            if len(near) > k:
                most = scores >= np.partition(scores, len(near) - k)[len(near) - k]
                near, scores = near[most], scores[most]
            order = np.lexsort((near, -scores))[:k]
            return near[order], np.minimum(scores[order], 1.0)

        def multiply(open_, dense):
            for (j, scores), more in zip(open_, dense[: len(open_)] @ rows.T):
                out[j] = best(np.arange(n), scores + more)

        dense, open_, out = np.zeros((TOGETHER, rows.shape[1]), np.float32), [], [None] * len(vectors)
        for i in range(0, len(vectors), TOGETHER):
            some = vectors[i : i + TOGETHER]
            squares = np.zeros((len(some), len(norms)))
            for j, (terms, weights) in enumerate(some):
                row = at[terms]
                np.add.at(squares[j], group[row[row >= 0]], weights[row >= 0] ** 2)
            reach = np.sqrt(squares).astype(np.float32) @ norms
            for j, (terms, weights) in enumerate(some):
                row = at[terms]
                scores = self._short_sums(terms[row < 0], weights[row < 0])
                query, has_long = dense[len(open_)], (row >= 0).any()
                query[:] = 0.0
                query[row[row >= 0]] = weights[row >= 0]
                upper, lead = scores.astype(np.float32) + reach[j], scores[:0]
                if n >= LEAD * LEAD and LEAD >= k:  # at least LEAD of the largest bounds: those from the LEAD-th of the maxima of n // 16 classes
                    tops = upper[: n // 16 * 16].reshape(16, -1).max(axis=0)
                    lead = np.flatnonzero(upper >= np.partition(tops, len(tops) - LEAD)[len(tops) - LEAD])
                if 0 < len(lead) <= n // 8:  # their k-th best is no more than the k-th best of all
                    least = np.partition(scores[lead] + rows[lead] @ query, len(lead) - k)[len(lead) - k]
                else:
                    least = np.partition(scores, n - k)[n - k] if n > k else 0.0
                near = np.flatnonzero(upper >= np.float32(least - 3e-6))  # scores are rounded to 1e-6
                if len(near) <= n // 8 or not has_long:
                    out[i + j] = best(near, scores[near] + (rows[near] @ query if has_long else 0.0))
                else:
                    open_.append((i + j, scores))
                    if len(open_) == TOGETHER:
                        multiply(open_, dense)
                        open_ = []
        if open_:
            multiply(open_, dense)
        return out

    def vote(self, near: np.ndarray, cosine: np.ndarray) -> float:
        pull = 1 / (1 - cosine + 0.1)
        return float((pull * self.labels[near]).sum() / pull.sum())

    def calibrated(self, vote: float) -> float:
        return float(self.calibration[min(BINS - 1, int(vote * BINS))])

    def scores(self, vectors: list, k: int = NEIGHBOURS) -> list:
        """(score, similarities and labels of the nearest examples) of each vector."""
        full = [v for v in vectors if len(v[0])] if len(self.labels) else []
        nearest = iter(self.nearest_all(full, k))
        none = np.zeros(0), np.zeros(0, np.int32)
        return [self._scored(*next(nearest)) if len(v[0]) and full else (self.prior, *none) for v in vectors]

    def _scored(self, near: np.ndarray, cosine: np.ndarray):
        score = self.calibrated(self.vote(near, cosine)) if len(near) else self.prior
        return score, cosine.astype(np.float64), self.labels[near].astype(np.int32)

    def calibrate(self, votes: list[tuple[float, int]]) -> None:
        """Monotone regression (pool adjacent violators) of labels over binned votes, one pseudo-example at the bin's middle."""
        mid = (np.arange(BINS) + 0.5) / BINS
        n, ones = np.ones(BINS), mid.copy()
        for vote, y in votes:
            b = min(BINS - 1, int(vote * BINS))
            n[b] += 1
            ones[b] += y
        pools: list[list[float]] = []
        for size, one in zip(n, ones):
            pools.append([size, one, 1])
            while len(pools) > 1 and pools[-2][1] / pools[-2][0] > pools[-1][1] / pools[-1][0]:
                s, o, c = pools.pop()
                pools[-1] = [pools[-1][0] + s, pools[-1][1] + o, pools[-1][2] + c]
        self.calibration = np.concatenate([[o / s] * int(c) for s, o, c in pools])


def fit(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES) -> Index:
    """``docs`` (id, text), ``labels`` (id, label 0/1): only the labels given are learnt from."""
    return fit_numbered(docs, labels, max_examples, written=False)[0]


def fit_numbered(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES, written: bool = True) -> tuple[Index, DataFrame | None]:
    """The index and the documents as word numbers (``docs`` without ``text``, plus ``terms, counts``), if they are to be ``written``."""
    spark = docs.sparkSession
    examples = materialize(examples_of(docs.select("id", "text"), labels, max_examples), "toxicity-examples")
    words = examples.select("text").mapInArrow(_distinct_terms, "term string").distinct().toArrow().column("term").combine_chunks()
    known = Numbers(words if isinstance(words, pa.Array) else pa.array([], pa.string()))
    del words
    sent = spark.sparkContext.broadcast(known)
    rows = numbered_docs(docs, sent) if written else None
    n_docs, freq = _document_frequencies(rows, len(known)) if written else _document_frequencies(docs, len(known), sent)
    numbered = numbered_docs(examples.select("key", "label", "text"), sent)  # an example is needed as its words' numbers only
    sent.destroy()
    got = numbered.toArrow()  # at most max_examples texts' terms
    got = got.take(pa.array(np.argsort(got.column("key").to_numpy()))) if got.num_rows else got
    flat = lambda c: np.concatenate([np.zeros(0, np.int32)] + [x.flatten().to_numpy() for x in got.column(c).chunks])
    y, ids, counts = got.column("label").to_numpy().astype(np.int8), flat("terms"), flat("counts")
    sizes = pa.compute.list_value_length(got.column("terms")).to_numpy().astype(np.int64)
    half = np.array([half_of(k) for k in got.column("key").to_pylist()], np.int64)
    idf = idf_of(n_docs, freq)
    del got
    pa.default_memory_pool().release_unused()

    def part(mine: np.ndarray) -> Index:
        at = np.repeat(mine, sizes)
        d = np.bincount(ids[at], minlength=len(known))
        t = np.bincount(ids[at], np.repeat(y[mine], sizes[mine]), len(known))
        weighted = idf * relevance(d, t, int(mine.sum()), int(y[mine].sum())) * (d > 0)  # words it hasn't seen don't count
        return Index.of({}, weighted, sizes[mine], ids[at], counts[at], y[mine])

    sent_halves = [spark.sparkContext.broadcast(part(half != h)) for h in (0, 1)]
    votes = _left_out_votes(numbered, sent_halves) if len(y) else []
    for x in sent_halves:
        x.destroy()
    index = part(np.ones(len(y), bool))
    index.known = known
    index.calibrate(votes)
    return index, rows


def half_of(key: str) -> int:
    return int(key[0], 16) % 2


def _left_out_votes(numbered: DataFrame, halves: list) -> list[tuple[float, int]]:
    """(vote, label) of every example from its nearest in the other half (``halves[h]`` is without half h), on the executors."""

    def votes(batches):
        Numbers.forget()
        for b in batches:
            keys, out = [half_of(k) for k in b.column("key").to_pylist()], np.full(b.num_rows, np.nan)
            for h in (0, 1):
                idx, mine, vectors = halves[h].value, [], []
                for i in np.flatnonzero(np.array(keys) == h):
                    terms, counts = b.column("terms")[i].values.to_numpy(), b.column("counts")[i].values.to_numpy()
                    seen = idx.idf[terms] > 0
                    if seen.any():
                        mine.append(i)
                        vectors.append(idx.weigh(terms[seen].astype(np.int64), counts[seen]))
                for i, (near, cosine) in zip(mine, idx.nearest_all(vectors, NEIGHBOURS)):
                    out[i] = idx.vote(near, cosine) if len(near) else np.nan
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.float64()), b.column("label")], names=["vote", "label"])

    got = numbered.mapInArrow(votes, "vote double, label int").filter("NOT isnan(vote)").toArrow()  # at most max_examples pairs
    return list(zip(got.column("vote").to_pylist(), got.column("label").to_pylist()))


def score_texts(df: DataFrame, index: Index, text_col: str = "text") -> DataFrame:
    """``df`` plus ``score`` (0 to 1) and ``evidence`` (the nearest examples' similarities and labels).

    Texts become word numbers first, which are written: a worker holds the words or the index, not both."""
    sent = df.sparkSession.sparkContext.broadcast(index.known)
    rows = numbered_docs(df.select(boxed(df, "score", "evidence"), F.col(f"`{text_col}`").alias("_text")), sent, "_text")
    sent.destroy()
    return score_numbered(rows, index).select("row.*", "score", "evidence")


def score_numbered(rows: DataFrame, index: Index) -> DataFrame:
    """``rows`` of :func:`fit_numbered` with ``score`` and ``evidence`` in place of the numbers: their texts aren't read again."""
    sent = rows.sparkSession.sparkContext.broadcast(replace(index, known={}))

    scored = T._parse_datatype_string(SCORED)
    evidence = to_arrow_schema(scored).field("evidence").type

    def run(batch):
        Numbers.forget()
        idx, terms, counts = sent.value, batch.column("terms"), batch.column("counts")
        edges = terms.offsets.to_numpy().tolist()
        ids, n = terms.values.to_numpy(), counts.values.to_numpy()
        first, at, made, waiting = {}, [], [], []
        for a, b in zip(edges[:-1], edges[1:]):
            key = hashlib.blake2b(ids[a:b].tobytes() + n[a:b].tobytes(), digest_size=16).digest()
            if key not in first:
                first[key] = len(made) + len(waiting)
                waiting.append(idx.weigh(ids[a:b], n[a:b]))
                if len(waiting) == PIECE:
                    made += idx.scores(waiting)
                    waiting = []
            at.append(first[key])
        made += idx.scores(waiting)
        similar = pa.array(np.concatenate([np.zeros(0), *(made[i][1] for i in at)]))
        label = pa.array(np.concatenate([np.zeros(0, np.int32), *(made[i][2] for i in at)]))
        pairs = pa.StructArray.from_arrays([similar, label], fields=list(evidence.value_type))
        return [np.array([made[i][0] for i in at], np.float64), lists([len(made[i][1]) for i in at], pairs, evidence)]

    return append_columns(rows, scored, run, ROWS).drop("terms", "counts")


def remainder(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string")) % 3


def learnt_labels(spark, sf_dir: str) -> DataFrame:
    """(id, label) of the labelled rows whose id's CRC-32 leaves no remainder of 1 by 3."""
    return table(spark, sf_dir, "labels").filter(remainder() != 1).select(F.col("doc_id").alias("id"), F.col("toxic").alias("label"))


def toxicity_scores(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` scored by the labelled rows of ``documents`` that may be learnt from."""
    known = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return score_texts(docs, fit(known, learnt_labels(spark, sf_dir)))


@query("op1_toxicity")
def op1_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", "doc_id")
    index, rows = fit_numbered(docs, learnt_labels(spark, sf_dir))
    return score_numbered(rows, index).select("doc_id", F.coalesce(remainder() == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= LEAST_SCORE).cast("int").alias("predicted"))
