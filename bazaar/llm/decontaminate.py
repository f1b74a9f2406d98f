"""Benchmark decontamination by latent semantic retrieval.

Passages are windows of two segments of SEGMENT words, one starting at each
segment, so they cover every text whole.  Their terms are the words of the
benchmark; other words don't count, so the cosine of a passage and an item is
the same whatever the size of the corpus.

1. Statistics: one pass counts in how many segments of the corpus each term
   occurs.  Every term keeps a weight of MIN_IDF at least, so that a heavily
   leaked item doesn't remove its own words.
2. Distributed randomised SVD of the TF-IDF passages A: every partition adds
   up its part of A^T (A G) for a Gaussian G, the parts are summed, and the
   Nystrom formula turns the sum into the leading right singular vectors.  The
   benchmark's own passages weigh as much as the corpus.
3. Candidate search: passages and benchmark items meet in the latent space;
   pairs with enough latent cosine are compared by the cosine of their whole
   TF-IDF vectors.
4. Checks: the longest common subsequence of the item's words with the words
   around the passage, and the same for the item's answer (its last
   ANSWER_SHARE).  An item counts as leaked if nearly all of its words are
   found in order, or most of them together with the answer (a paraphrase).

The benchmark is a stated query set: it is taken in blocks of at most
BLOCK_ITEMS items, whose words and vectors are sent to the tasks.  What the
driver holds is bounded by terms x rank, whatever the corpus size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEGMENT = 16
MIN_IDF = 0.1
RANK, OVERSAMPLE = 64, 8
#: The rank is at least one to so many items of a block.
RANK_ITEMS = 16
LATENT = 0.5
COSINE = 0.3
LCS_SURE, LCS_MOST, ANSWER = 0.8, 0.6, 0.7
ANSWER_SHARE = 0.3
BLOCK_ITEMS = 2000
SEED = 11

#: Words handled at a time in a task.
BLOCK_WORDS = 1 << 17
#: Rows of a matrix handled at a time, so that the temporaries stay in cache.
SLAB = 512
#: The tasks' parts of the sketch are summed SUM_FAN at a time, in SUM_LEVELS.
SUM_FAN, SUM_LEVELS = 16, 4

#: Every ASCII character that is no letter or digit becomes a space.
_TABLE = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words: runs of ASCII letters and digits and other scripts."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_TABLE).split()


def lcs(masks: dict, n: int, words) -> int:
    """Longest common subsequence with the item of ``masks`` (bit-parallel)."""
    v = full = (1 << n) - 1
    for w in words:
        u = v & masks.get(w, 0)
        v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def masks_of(words) -> dict:
    out: dict = {}
    for k, w in enumerate(words):
        out[w] = out.get(w, 0) | (1 << k)
    return out


@dataclass
class Space:
    """A block of the benchmark in term and latent space."""

    items: list[tuple[int, list[bytes]]]
    terms: dict[bytes, int] = field(default_factory=dict)
    idf: np.ndarray | None = None  # above 0
    query_item: np.ndarray | None = None  # item of each query passage
    weights: np.ndarray | None = None  # (terms, queries): whole TF-IDF, unit columns
    basis: np.ndarray | None = None  # (terms, rank)
    latent: np.ndarray | None = None  # (rank, queries), unit columns

    @property
    def rank(self) -> int:
        return max(RANK, len(self.items) // RANK_ITEMS)

    def ids(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.terms.get, words, repeat(-1)), np.int32, len(words))


def _blocks(space: Space, texts) -> Iterator[tuple[np.ndarray, np.ndarray, list]]:
    """(ids as segments, document of each segment, documents) by block.

    A document's last segment is filled up with -2, which is no word.
    """
    ids, segments, docs, size = [], [], [], 0
    fill = [np.full(k, -2, np.int32) for k in range(SEGMENT)]

    def block():
        return np.concatenate(ids).reshape(-1, SEGMENT), np.repeat(np.arange(len(docs)), segments), docs

    for key, text in texts:
        words = words_of(text)
        if not words:
            continue
        pad = -len(words) % SEGMENT
        ids += [space.ids(words), fill[pad]]
        segments.append((len(words) + pad) // SEGMENT)
        docs.append((key, text))
        size += len(words)
        if size >= BLOCK_WORDS:
            yield block()
            ids, segments, docs, size = [], [], [], 0
    if docs:
        yield block()


def _pairs(batches: Iterator[pd.DataFrame]):
    for pdf in batches:
        yield from zip(pdf["doc_id"], pdf["text"], strict=True)


def count_terms(docs: DataFrame, space: Space) -> tuple[np.ndarray, int]:
    """Segments of the corpus in which each term occurs, and all segments."""
    n_terms = len(space.terms)

    def part(batches):
        df, n = np.zeros(n_terms + 1, np.int64), 0
        for ids, _, _ in _blocks(space, _pairs(batches)):
            rows = np.sort(ids, axis=1)
            new = np.ones(rows.shape, bool)
            new[:, 1:] = rows[:, 1:] != rows[:, :-1]
            df[:n_terms] += np.bincount(rows[new & (rows >= 0)], minlength=n_terms)
            n += len(ids)
        df[n_terms] = n
        at = np.flatnonzero(df)
        yield pd.DataFrame({"term": at, "n": df[at]})

    rows = docs.mapInPandas(part, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(n_terms + 1, np.int64)
    df[rows["term"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return df[:n_terms], int(df[n_terms])


def _norms(space: Space, ids: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """1 / norm of the window starting at each segment; whether it has two."""
    square = np.concatenate([space.idf ** 2, [0.0, 0.0]]).astype(np.float32)
    own = square[ids].sum(axis=1)  # index -2 is no word, -1 a word outside the benchmark
    two = np.zeros(len(ids), bool)
    two[:-1] = owner[1:] == owner[:-1]
    total = own + np.where(two, np.append(own[1:], 0), 0)
    return 1 / np.sqrt(np.maximum(total, 1e-6)), two


def _project(space: Space, ids: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Sum over each segment of the weighted rows of ``matrix`` (terms first)."""
    rows = np.concatenate([matrix, np.zeros((2, matrix.shape[1]), np.float32)])  # for ids -2 and -1
    out = np.empty((len(ids), matrix.shape[1]), np.float32)
    word = np.empty((SLAB, matrix.shape[1]), np.float32)
    for s in range(0, len(ids), SLAB):
        part, total = ids[s:s + SLAB], out[s:s + SLAB]
        np.take(rows, part[:, 0], axis=0, out=total, mode="wrap")
        for k in range(1, SEGMENT):
            total += np.take(rows, part[:, k], axis=0, out=word[:len(part)], mode="wrap")
    return out


def _add_by_term(total: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
    """Add the row of each segment to those of its terms in ``total``."""
    flat = ids.ravel()
    hit = np.flatnonzero(flat >= 0)
    order = hit[np.argsort(flat[hit], kind="stable")]
    buffer = np.empty((SLAB * SEGMENT, rows.shape[1]), np.float32)
    for s in range(0, len(order), len(buffer)):
        at = order[s:s + len(buffer)]
        term = flat[at]
        first = np.flatnonzero(np.append(True, term[1:] != term[:-1]))
        part = np.take(rows, at // SEGMENT, axis=0, out=buffer[:len(at)], mode="wrap")
        total[term[first]] += np.add.reduceat(part, first, axis=0)


def _windows(x: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Rows of the windows: a segment and, if its text goes on, the next."""
    out = x.copy()
    out[:-1] += np.where(two[:-1, None], x[1:], 0)
    return out


def sketch(docs: DataFrame, space: Space) -> tuple[np.ndarray, np.ndarray, float]:
    """(G, A^T A G, squared norm of A) over all passages of the corpus."""
    n_terms, width = len(space.terms), space.rank + OVERSAMPLE
    gauss = np.random.default_rng(SEED).normal(size=(n_terms, width)).astype(np.float32)

    def part(batches):
        weighted = (gauss * space.idf[:, None]).astype(np.float32)
        total, mass = np.zeros((n_terms, width)), 0.0
        for ids, owner, _ in _blocks(space, _pairs(batches)):
            scale, two = _norms(space, ids, owner)
            y = _windows(_project(space, ids, weighted), two) * (scale ** 2)[:, None]
            back = y.copy()  # a segment lies in the window it starts and in the one before
            back[1:] += np.where(two[:-1, None], y[:-1], 0)
            _add_by_term(total, ids, back)
            mass += len(ids)
        total *= space.idf[:, None]
        yield pd.DataFrame({"part": [TaskContext.get().partitionId() % SUM_FAN ** SUM_LEVELS], "mass": [mass],
                            "z": [total.astype(np.float32).tobytes()]})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        z = sum(np.frombuffer(b, np.float32).astype(np.float64) for b in pdf["z"])
        return pd.DataFrame({"part": pdf["part"][:1], "mass": [pdf["mass"].sum()], "z": [z.astype(np.float32).tobytes()]})

    kind = "part long, mass double, z binary"
    parts = docs.mapInPandas(part, kind)
    for _ in range(SUM_LEVELS):
        up = parts.withColumn("part", F.floor(F.col("part") / SUM_FAN).cast("long"))
        parts = up.groupBy("part").applyInPandas(add, kind)
    z = np.zeros((n_terms, width))
    parts = parts.collect()  # one row
    for r in parts:
        z += np.frombuffer(r["z"], np.float32).reshape(z.shape)
    return gauss.astype(np.float64), z, float(sum(r["mass"] for r in parts))


def nystrom(gauss: np.ndarray, z: np.ndarray, rank: int) -> np.ndarray:
    """Leading eigenvectors of M = A^T A from G and Z = M G."""
    shift = 1e-6 * max(np.linalg.norm(z), 1e-12)
    z = z + shift * gauss
    core = gauss.T @ z
    value, vector = np.linalg.eigh((core + core.T) / 2)
    keep = value > max(value.max(), 0) * 1e-9
    if not keep.any():
        return np.zeros((len(z), 1))
    left, size, _ = np.linalg.svd(z @ vector[:, keep] / np.sqrt(value[keep]), full_matrices=False)
    return left[:, :rank][:, size[:rank] > 0]


def _queries(space: Space) -> None:
    """Passages of the items: the item, or its windows if it is long."""
    columns, owner = [], []
    for k, (_, words) in enumerate(space.items):
        ids = space.ids(words)
        long = len(ids) > 3 * SEGMENT
        for s in range(0, len(ids) - SEGMENT, SEGMENT) if long else (0,):
            cut = ids[s:s + 2 * SEGMENT] if long else ids
            columns.append(np.bincount(cut, minlength=len(space.terms)) * space.idf)
            owner.append(k)
    w = np.array(columns, np.float32).T
    space.weights = w / np.maximum(np.linalg.norm(w, axis=0), 1e-6)
    space.query_item = np.array(owner)


def fit(docs: DataFrame, items: list[tuple[int, list[bytes]]]) -> Space:
    """Term weights and latent space from all passages of the corpus."""
    space = Space(items)
    for _, words in items:
        for w in words:
            space.terms.setdefault(w, len(space.terms))
    df, n = count_terms(docs, space)
    idf = np.log((n + 1.0) / (df + 1.0))
    space.idf = np.maximum(idf, MIN_IDF)
    _queries(space)
    gauss, z, mass = sketch(docs, space)
    own = space.weights.astype(np.float64)
    z += own @ (own.T @ gauss) * (max(mass, 1.0) / max(own.shape[1], 1))
    basis = nystrom(gauss, z, space.rank)
    space.basis = (basis * space.idf[:, None]).astype(np.float32)
    latent = (basis.T @ own).astype(np.float32)
    space.latent = latent / np.maximum(np.linalg.norm(latent, axis=0), 1e-6)
    return space


def _candidates(space: Space, ids: np.ndarray, owner: np.ndarray):
    """(window, query, cosine) pairs that pass both cosines."""
    scale, two = _norms(space, ids, owner)
    x = _windows(_project(space, ids, space.basis), two)
    size = np.linalg.norm(x, axis=1)
    some = np.flatnonzero(size > 1e-6)
    idf = np.append(space.idf, [0.0, 0.0]).astype(np.float32)
    weights = np.concatenate([space.weights, np.zeros((2, space.weights.shape[1]), np.float32)])
    follow = np.full_like(ids, -2)
    follow[:-1][two[:-1]] = ids[1:][two[:-1]]
    queries = space.latent.shape[1]
    for at in range(0, len(some), SLAB):
        rows = some[at:at + SLAB]
        win, query = np.divmod(np.flatnonzero((x[rows] / size[rows, None]) @ space.latent >= LATENT), queries)
        win = rows[win]
        for k in range(0, len(win), 1 << 15):
            w, q = win[k:k + (1 << 15)], query[k:k + (1 << 15)]
            both = np.concatenate([ids[w], follow[w]], axis=1)
            cosine = (weights[both, q[:, None]] * idf[both]).sum(axis=1) * scale[w]
            good = cosine >= COSINE
            yield from zip(w[good], q[good], cosine[good], strict=True)


def search(docs: DataFrame, space: Space) -> DataFrame:
    """(doc_id, item_id, cosine, lcs, answer, at_word) of the leaked items."""
    schema = "doc_id long, item_id long, cosine double, lcs double, answer double, at_word long"

    def part(batches):
        masks = [masks_of(w) for _, w in space.items]
        tails = [w[-max(1, round(ANSWER_SHARE * len(w))):] for _, w in space.items]
        tail_masks = [masks_of(t) for t in tails]
        for ids, owner, docs_ in _blocks(space, _pairs(batches)):
            begin = np.searchsorted(owner, np.arange(len(docs_)))
            best: dict = {}
            texts: dict = {}
            for w, q, cosine in _candidates(space, ids, owner):
                doc, item = int(owner[w]), int(space.query_item[q])
                if doc not in texts:
                    texts[doc] = words_of(docs_[doc][1])
                n, words = len(space.items[item][1]), texts[doc]
                mid = int(w - begin[doc]) * SEGMENT + SEGMENT
                near = words[max(0, mid - SEGMENT - n):mid + SEGMENT + n]
                share = lcs(masks[item], n, near) / n
                tail = lcs(tail_masks[item], len(tails[item]), near) / len(tails[item])
                if share >= LCS_SURE or (share >= LCS_MOST and tail >= ANSWER):
                    row = (float(cosine), share, tail, max(0, mid - SEGMENT))
                    best[doc, item] = max(best.get((doc, item), row), row)
            if best:
                yield pd.DataFrame(
                    [(docs_[d][0], space.items[i][0], *row) for (d, i), row in sorted(best.items())],
                    columns=[c.split()[0] for c in schema.split(", ")])

    return docs.mapInPandas(part, schema)


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document and leaked item.

    Null and empty texts have no passage; items without a word are never
    leaked.  A null id is kept as null.  Rows that repeat an id are searched
    each, and the best match of an id and item is returned.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    items = benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(item_text_col).alias("t")).distinct()
    count = items.count()
    blocks = max(1, -(-count // BLOCK_ITEMS))
    found = None
    for b in range(blocks):
        rows = (items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b)
                .orderBy("i", "t").collect())  # one block of the query set
        block = [(r["i"], w) for r in rows if (w := words_of(r["t"]))]
        if not block:
            continue
        part = search(docs, fit(docs, block))
        found = part if found is None else found.unionByName(part)
    if found is None:
        return docs.sparkSession.createDataFrame(
            [], "doc_id long, item_id long, cosine double, lcs double, answer double, at_word long")
    best = F.max(F.struct("cosine", "lcs", "answer", "at_word")).alias("m")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "m.*")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a leaked item, all columns.

    A row is matched to its leaks by a hash of id and text, so of rows that
    repeat an id only those with the leak go.
    """
    key = F.xxhash64(F.col(id_col), F.col(text_col))
    rows = docs.select(key.alias("k"), F.struct("*").alias("row"))
    found = leaks(docs.select(key.alias("k"), F.col(text_col).alias("t")), benchmark, "k", "t")
    return rows.join(found.select(F.col("doc_id").alias("k")).distinct(), "k", "left_anti").select("row.*")
