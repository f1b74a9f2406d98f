"""Importance resampling towards a target distribution, over distinct lines.

Hashed n-gram counts of the corpus and of a target set give every bucket a
gain; a document's weight is the mean gain of its features, and Gumbel noise
from its id turns the draw without replacement into a top-k by score.

Words never reach over a separator, and newline is one.  So a text is cut into
lines, the features of each distinct line are counted once, and the counts are
multiplied by the line's occurrences.  N-grams that begin in one line and end
in another are found per document and added separately (none for single
words).

Ranks are counted per score (a table with one row per integer score), so no
task sees all documents in order.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaar.llm.common import stored

#: Bytes of words once A-Z are lower case (every byte beyond ASCII belongs to one).
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str) -> list[bytes]:
    """Words of a text; only A-Z are lower-cased."""
    return WORD.findall(text.encode().lower())


# ---------------------------------------------------------------- features

def _chains(words: list[bytes], n: int) -> list[np.ndarray]:
    """CRC-32 of all runs of 1..n words; entry m-1 has the runs of m words by start."""
    crcs = list(map(zlib.crc32, words))
    out = [np.array(crcs, np.uint32)]
    spaced = [b" " + w for w in words] if n > 1 else []
    for m in range(2, n + 1):
        crcs = [zlib.crc32(w, c) for w, c in zip(spaced[m - 1:], crcs, strict=False)]
        out.append(np.array(crcs, np.uint32))
    return out


def line_features(line: str, n: int, buckets: int) -> np.ndarray:
    """Buckets of all runs of 1..n words inside a line, repeats kept."""
    return np.concatenate(_chains(words_of(line), n)) % np.uint32(buckets)


def cross_features(text: str, n: int, buckets: int) -> np.ndarray:
    """Buckets of the runs that begin in one line of a text and end in a later one."""
    lines = [words_of(x) for x in text.split("\n")]
    words = [w for x in lines for w in x]
    line = np.repeat(np.arange(len(lines)), [len(x) for x in lines])
    found = [c[line[:len(c)] != line[m:]] for m, c in enumerate(_chains(words, n)) if m]
    return np.concatenate(found) % np.uint32(buckets) if found else np.zeros(0, np.uint32)


def _width(buckets: int) -> np.dtype:
    return np.dtype("<u2" if buckets <= 1 << 16 else "<u4")


def _feature_rows(df: DataFrame, text: str, features, n: int, buckets: int) -> DataFrame:
    """Replace the column ``text`` by n_words, n_features and the packed buckets."""
    keep = [f for f in df.schema if f.name != text]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in keep]
                       + ["n_words long", "n_features long", "buckets binary"])
    kind, names = _width(buckets), [f.name for f in keep]

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [features(t or "", n, buckets) for t in b.column(text).to_pylist()]
            sizes = [len(f) for f in found]
            words = sizes if n == 1 else [len(words_of(t or "")) for t in b.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in names], pa.array(words, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array([f.astype(kind).tobytes() for f in found], pa.binary())],
                names=[*names, "n_words", "n_features", "buckets"])

    return df.mapInArrow(part, schema)


def _bucket_counts(features: DataFrame, buckets: int) -> DataFrame:
    """(bucket, n): counts weighted by ``times``; one dense table per task is summed up."""
    kind = _width(buckets)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        seen, times, waiting = [], [], 0

        def add() -> None:
            sizes = [len(x) for x in seen]
            np.add.at(total, np.concatenate(seen), np.repeat(np.array(times, np.int64), sizes))

        for b in batches:
            for raw, t in zip(b.column("buckets"), b.column("times").to_pylist(), strict=True):
                seen.append(np.frombuffer(raw.as_buffer(), kind))
                times.append(t)
                waiting += len(seen[-1])
                if waiting > 1 << 20:
                    add()
                    seen, times, waiting = [], [], 0
        if seen:
            add()
        here = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(here, pa.int64()), pa.array(total[here])], names=["bucket", "n"])

    return (features.select("buckets", "times").mapInArrow(part, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def _lines(df: DataFrame, text: Column, *more: Column) -> DataFrame:
    """Every line of every text, with the columns ``more``; null is one empty line."""
    return df.select(*more, F.posexplode(F.split(F.coalesce(text, F.lit("")), "\n")).alias("place", "line"))


def _key(c: Column) -> Column:
    """16 bytes of SHA-256."""
    return F.unhex(F.substring(F.sha2(c, 256), 1, 32))


class Features:
    """Line and cross-line features of a set of texts, both in the shared folder."""

    def __init__(self, texts: DataFrame, n: int, buckets: int):
        """``texts`` has doc and text; ``doc`` may be null or repeat."""
        self.texts, self.buckets = texts, buckets
        distinct = _lines(texts, F.col("text")).groupBy("line").agg(F.count(F.lit(1)).alias("times"))
        keyed = distinct.select(_key(F.col("line")).alias("key"), "times", "line")
        self.lines = stored(_feature_rows(keyed, "line", line_features, n, buckets), "line-features")
        self.cross = None
        if n > 1:
            own = texts.select("doc", _key(F.coalesce("text", F.lit(""))).alias("content"), "text")
            self.cross = stored(_feature_rows(own, "text", cross_features, n, buckets)
                                .withColumn("times", F.lit(1)), "cross-features")

    def counts(self) -> DataFrame:
        """(bucket, n) of all texts."""
        parts = _bucket_counts(self.lines, self.buckets)
        if self.cross is not None:
            parts = parts.unionByName(_bucket_counts(self.cross, self.buckets))
        return parts.groupBy("bucket").agg(F.sum("n").alias("n"))

    def sums(self, gains: np.ndarray) -> DataFrame:
        """(doc, content, copies, n_words, n_features, gain) of every different (doc, content).

        A line's sum is computed once and joined to its uses, where adaptive
        execution splits a line that very many texts have.
        """
        def of(df: DataFrame) -> DataFrame:
            return _gain_sums(df, gains, self.buckets)

        uses = _lines(self.texts, F.col("text"), F.col("doc"),
                      _key(F.coalesce("text", F.lit(""))).alias("content"))
        uses = uses.select("doc", "content", _key(F.col("line")).alias("key"),
                           (F.col("place") == 0).cast("long").alias("first"))
        each = uses.join(of(self.lines).select("key", "n_words", "n_features", "gain"), "key").drop("key")
        if self.cross is not None:
            each = each.unionByName(of(self.cross).select("doc", "content", "n_features", "gain",
                                                          F.lit(0).cast("long").alias("n_words"),
                                                          F.lit(0).cast("long").alias("first")))
        total = each.groupBy("doc", "content").agg(
            F.sum("first").alias("copies"), *[F.sum(c).alias(c) for c in ("n_words", "n_features", "gain")])
        # rows that repeat id and text have been added up; each has an equal share
        return total.select("doc", "content", "copies",
                            *[F.expr(f"{c} div copies").alias(c) for c in ("n_words", "n_features", "gain")])


def _gain_sums(features: DataFrame, gains: np.ndarray, buckets: int) -> DataFrame:
    """Replace the packed buckets by the sum of their gains."""
    keep = [f for f in features.schema if f.name not in ("buckets", "times")]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in keep] + ["gain long"])
    kind, names = _width(buckets), [f.name for f in keep]

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sums = [int(gains[np.frombuffer(x.as_buffer(), kind)].sum()) for x in b.column("buckets")]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], pa.array(sums, pa.int64())],
                                             names=[*names, "gain"])

    return features.select(*names, "buckets").mapInArrow(part, schema)


# -------------------------------------------------------------------- gains

def bucket_gains(source: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """Gain of every bucket, floor(1000 ln of the ratio of the smoothed shares).

    ``buckets`` numbers reach the driver, whatever the size of the input.
    """
    both = (source.select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t"))
            .unionByName(target.select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t")))
            .groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).toArrow())
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    at = both["bucket"].to_numpy()
    s[at], t[at] = both["s"].to_numpy(), both["t"].to_numpy()
    ratio = (t + 1.0) * float(s.sum() + buckets) / ((s + 1.0) * float(t.sum() + buckets))
    return np.floor(1000.0 * np.log(ratio)).astype(np.int64)


# --------------------------------------------------------------------- draw

def gumbel(doc: Column, seed: int) -> Column:
    """Integer Gumbel noise of a document's id (null: the empty text)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def draw(scored: DataFrame, min_words: int, share: tuple[int, int]) -> DataFrame:
    """Expand (doc, content, copies, ...) to one row per copy, with its rank.

    Of the N rows with at least ``min_words`` words the floor(a*N/b) highest
    scores get ranks 1, 2, ..., ties to the smaller id (null first).
    """
    fit = F.col("n_words") >= min_words
    per_score = scored.where(fit).groupBy("score").agg(F.sum("copies").alias("here"))
    higher = Window.orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, -1)
    # one row per integer score: its range is that of the gains and the noise, not the data's
    offsets = per_score.select("score", F.coalesce(F.sum("here").over(higher), F.lit(0)).alias("above"),
                               F.expr(f"{share[0]} * sum(here) over () div {share[1]}").alias("drawn"))
    ties = (Window.partitionBy("score").orderBy(F.col("doc").asc_nulls_first(), "content")
            .rowsBetween(Window.unboundedPreceding, -1))
    placed = (scored.where(fit).join(offsets, "score")
              .withColumn("before", F.col("above") + F.coalesce(F.sum("copies").over(ties), F.lit(0))))
    rest = scored.where(~fit).withColumns({"before": F.lit(None).cast("long"), "drawn": F.lit(None).cast("long")})
    out = placed.drop("above").unionByName(rest)
    out = out.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    rank = F.col("before") + F.col("copy")
    return out.withColumn("rank", F.when(rank <= F.col("drawn"), rank)).drop("before", "drawn", "copy", "copies")


def resample(docs: DataFrame, target: DataFrame, n: int = 1, buckets: int = 10000, min_words: int = 20,
             share: tuple[int, int] = (10, 100), seed: int = 2024, id_col: str = "doc_id", text_col: str = "text",
             target_text: str = "text") -> DataFrame:
    """Importance weight, score and rank of every row of ``docs``.

    Null and empty texts have no features and weight 0.  Rows that repeat an id
    have its noise, each with its own weight; rows that repeat id and text get
    ranks one after the other.  An empty target or an empty table is fine.  No
    other column of ``docs`` is looked at.
    """
    corpus = Features(docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")), n, buckets)
    aim = Features(target.select(F.lit(None).cast("long").alias("doc"), F.col(target_text).alias("text")), n, buckets)
    gains = bucket_gains(corpus.counts(), aim.counts(), buckets)
    weight = F.when(F.col("n_features") == 0, F.lit(0)).otherwise(
        F.expr("(gain - pmod(gain, nullif(n_features, 0))) div nullif(n_features, 0)"))
    scored = corpus.sums(gains).withColumn("weight", weight)
    scored = stored(scored.withColumn("score", F.col("weight") + gumbel(F.col("doc"), seed)), "scores")
    return draw(scored, min_words, share).select(F.col("doc").alias("doc_id"), "n_features", "weight", "score", "rank")
