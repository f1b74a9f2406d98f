"""Substring dedup by suffix arrays of shards.

A byte goes if a string of ``length`` bytes that covers it also starts in a
document with a smaller id.

1. Documents are packed into shards of about SHARD_BYTES, written once to a
   table bucketed by shard, so that later steps join shards without moving
   the text again.
2. Every window of ``length`` bytes has an anchor, the least hash of its
   GRAM-byte runs.  Equal windows have equal anchors, so a window whose anchor
   is in one document only cannot repeat.  Shards exchange their distinct
   anchors by hash range and learn which are shared.
3. Each shard sorts the suffixes of its shared passages by Larsson-Sadakane
   refinement in numpy up to ``length`` bytes; common prefixes of neighbours
   give the classes of equal windows, each with its smallest document.
4. Snippets (consecutive windows with one anchor, each distinct one once per
   shard) go to the anchor's range.  There the shards' sorted runs of window
   hashes are merged by binary search and verified byte by byte; every shard
   gets back the smallest document of each window.
5. Each shard marks the covered bytes of its documents.

A passage that a third of all documents share is one snippet per shard, so no
task sees its copies.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import shuffle_parts, stored
from bazaar.llm.winnow import ranges, run_starts, window_hashes, window_keys
from bazaar.session import scratch_path

LENGTH = 50
GRAM = 16
SHARD_BYTES = 4 << 20
#: The buckets are merged in so many turns, each with the shuffle files of its own snippets only.
TURNS = 4

#: Orders a null id: no id is larger, and the table notes which ids are null.
LAST = np.iinfo(np.int64).max


# ------------------------------------------------------------------ shards

def pack(docs: DataFrame, id_col: str, text_col: str, shard_bytes: int) -> DataFrame:
    """One row per shard: ids, byte lengths and bytes of its documents, and
    the bits of those whose id is null.

    Every task fills shards from its own part of the input, so the text is not
    shuffled; the written table fixes the numbering.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").cast("string").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def fill(batches):
        number = TaskContext.get().partitionId() << 32
        ids, nameless, data, size = [], [], [], 0

        def shard():
            return pd.DataFrame({"shard": [number], "ids": [np.array(ids, np.int64)],
                                 "sizes": [np.array([len(b) for b in data], np.int64)], "data": [b"".join(data)],
                                 "nameless": [np.packbits(nameless).tobytes()]})
        for pdf in batches:
            # digits, as a column of numbers with nulls would become floats
            for i, t in zip(pdf["doc_id"], pdf["text"], strict=True):
                nameless.append(i is None)
                ids.append(LAST if i is None else int(i))
                data.append(t.encode("utf-8", "surrogatepass"))
                size += len(data[-1])
                if size >= shard_bytes:
                    yield shard()
                    number, ids, nameless, data, size = number + 1, [], [], [], 0
        if ids:
            yield shard()

    packed = rows.mapInPandas(fill, "shard long, ids array<long>, sizes array<long>, data binary, nameless binary")
    name = f"shards_{uuid.uuid4().hex}"
    (packed.write.bucketBy(shuffle_parts(spark), "shard").option("path", scratch_path(spark, "shards"))
     .option("compression", "zstd").saveAsTable(name))
    table = spark.table(name)
    table.schema  # resolved now; the catalog entry is no longer needed, the files stay
    spark.sql(f"DROP TABLE {name}")
    return table


def null_ids(left: pd.DataFrame) -> list[np.ndarray]:
    """By shard: which of its ids are null."""
    return [np.unpackbits(np.frombuffer(b, np.uint8), count=len(i)).astype(bool)
            for b, i in zip(left["nameless"], left["ids"], strict=True)]


def _anchors(data: np.ndarray, sizes: np.ndarray, length: int, gram: int):
    """(anchor, first window, windows, document) of every run of windows with
    one anchor, at most ``length - gram + 1`` windows in a run."""
    empty = (np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3)))
    keys = window_keys(data, length, gram)
    if not len(keys):
        return empty
    ends = np.cumsum(sizes)
    # a run ends with its anchor, its document or the document's last window
    edge = np.append(True, keys[1:] != keys[:-1])
    cut = np.concatenate([ends - sizes, np.maximum(ends - sizes, ends - length + 1)])
    edge[cut[cut < len(keys)]] = True
    first = np.flatnonzero(edge)
    n = np.diff(np.append(first, len(keys)))
    doc = np.searchsorted(ends, first, side="right")
    inside = first + length <= ends[doc]
    first, n, doc = first[inside], n[inside], doc[inside]
    if not len(first):
        return empty
    most = length - gram + 1
    pieces = -(-n // most)  # long runs (repetitive text) are cut
    k = ranges(np.zeros(len(n), np.int64), pieces)
    run = np.repeat(np.arange(len(n)), pieces)
    return keys[first][run], first[run] + k * most, np.minimum(n[run] - k * most, most), doc[run]


def _rows_of(pdf: pd.DataFrame) -> Iterator[tuple]:
    for shard, ids, sizes, data in zip(pdf["shard"], pdf["ids"], pdf["sizes"], pdf["data"], strict=True):
        yield int(shard), np.asarray(ids, np.int64), np.asarray(sizes, np.int64), np.frombuffer(data, np.uint8)


# ---------------------------------------------------------- shared anchors

def shared_anchors(shards: DataFrame, buckets: int, length: int, gram: int) -> DataFrame:
    """(shard, anchors): the shard's anchors that two documents have."""
    def offer(batches):
        for pdf in batches:
            for shard, ids, sizes, data in _rows_of(pdf):
                key, _, _, doc = _anchors(data, sizes, length, gram)
                if not len(key):
                    continue
                order = np.argsort(key)
                key, owner = key[order], ids[doc[order]]
                first = run_starts(key)
                many = np.minimum.reduceat(owner, first) != np.maximum.reduceat(owner, first)
                key = key[first]
                bucket = (key % np.uint64(buckets)).astype(np.int64)
                by = np.argsort(bucket, kind="stable")
                cut = run_starts(bucket[by])
                for s, e in zip(cut, np.append(cut[1:], len(by)), strict=True):
                    yield pd.DataFrame({"bucket": [bucket[by[s]]], "shard": [shard], "anchors": [_short(key[by[s:e]])],
                                        "many": [np.packbits(many[by[s:e]]).tobytes()]})

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        runs = [_long(a) for a in pdf["anchors"]]
        many = [np.unpackbits(np.frombuffer(m, np.uint8), count=len(r)).astype(bool) for m, r in zip(pdf["many"], runs, strict=True)]
        every = np.sort(np.concatenate(runs))
        twice = every[1:][every[1:] == every[:-1]]
        out = [_short(r[m | _among(r, twice)]) for r, m in zip(runs, many, strict=True)]
        return pd.DataFrame({"shard": pdf["shard"].to_numpy(), "anchors": out})

    return (shards.mapInPandas(offer, "bucket long, shard long, anchors binary, many binary")
            .groupBy("bucket").applyInPandas(meet, "shard long, anchors binary"))


LOW = np.uint64((1 << 40) - 1)


def _short(anchors: np.ndarray) -> bytes:
    """The low five bytes of each anchor.  Two anchors that agree in them count
    as shared: that only sets fewer windows aside."""
    return anchors.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _long(blob: bytes) -> np.ndarray:
    out = np.zeros((len(blob) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(blob, np.uint8).reshape(-1, 5)
    return out.reshape(-1).view("<u8").astype(np.uint64)


def _among(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which of ``x`` are in the sorted ``table`` (binary search)."""
    if not len(table):
        return np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(table, x), len(table) - 1)
    return table[at] == x


# ------------------------------------------------------------ suffix arrays

def _refine(starts: np.ndarray, value: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, whether it differs from the one before) of slots that are
    sorted by ``value`` (of so many bits) inside each group; ``starts`` has the
    groups' first slots and the number of slots.

    Group, value and slot are packed into one number, as numpy sorts numbers
    much faster than it finds their order; so groups go some at a time.
    """
    room = (64 - bits) // 2  # every group has two slots at least
    by, new = np.empty(len(value), np.int64), np.empty(len(value), bool)
    g = 0
    while g < len(starts) - 1:
        lo = starts[g]
        end = int(np.searchsorted(starts, lo + (1 << room), side="right")) - 1
        if end == g:  # one group larger than that
            end = g + 1
            order = np.argsort(value[lo:starts[end]])
            key = value[lo:starts[end]][order]
        else:
            hi = starts[end]
            group = np.repeat(np.arange(end - g), np.diff(starts[g:end + 1]))
            key = (((group << bits) | value[lo:hi]) << room) | np.arange(hi - lo)
            key.sort()
            order = key & ((1 << room) - 1)
            key >>= room
        by[lo:starts[end]] = order + lo
        new[lo] = True
        new[lo + 1:starts[end]] = key[1:] != key[:-1]
        g = end
    return by, new


def suffix_order(text: np.ndarray, length: int) -> np.ndarray:
    """Positions of ``text`` sorted by their first ``length`` bytes.

    Larsson-Sadakane: suffixes are sorted by 8 bytes, then by doubled lengths;
    only groups that are still unsorted are refined, and a suffix's rank is
    the place of its group.  Positions past the end count as zero bytes.
    """
    n = len(text)
    pad = np.concatenate([text, np.zeros(length + 8, np.uint8)]).astype(np.uint64)
    key, width = pad, 1
    while width < 8:
        key = (key[:-width] << np.uint64(8 * width)) | key[width:]
        width *= 2
    size = n + length  # ranks of the padding are needed as well
    key = key[:size]
    order = np.argsort(key)
    sorted_key = key[order]
    slots, u = np.arange(size), order
    new = np.append(True, sorted_key[1:] != sorted_key[:-1])
    rank = np.empty(size, np.int64)
    have = 8
    while True:
        # a group's rank is its first slot; groups of one slot are in place
        first = np.flatnonzero(new)
        counts = np.diff(np.append(first, len(slots)))
        rank[u] = np.repeat(slots[first], counts)
        many = counts > 1
        live = np.repeat(many, counts)
        slots, u = slots[live], u[live]
        if have >= length or not len(slots):
            return order[order < n]
        step = min(have, length - have)
        starts = np.append(0, np.cumsum(counts[many]))
        by, new = _refine(starts, rank[np.minimum(u + step, size - 1)], size.bit_length())
        u = u[by]
        order[slots] = u
        have += step


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place of ``text`` as one number."""
    pad = np.concatenate([text, np.zeros(8, np.uint8)])
    return np.ndarray((len(text),), np.uint64, pad.data, strides=(1,))


def neighbour_prefixes(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Whether each suffix shares ``length`` bytes with the one before it.

    Kasai's common prefixes, cut off at ``length`` and computed for all
    neighbours at once, eight bytes a step; pairs that differ drop out.
    """
    word = _words(np.concatenate([text, np.zeros(length, np.uint8)]))
    same = np.zeros(len(order), bool)
    live = np.arange(1, len(order))
    for k in range(0, length, 8):
        k = min(k, length - 8) if length >= 8 else k
        live = live[word[order[live] + k] == word[order[live - 1] + k]]
    same[live] = True
    return same


def window_classes(text: np.ndarray, starts: np.ndarray, owner: np.ndarray, length: int):
    """(class of each start, smallest owner of each class)."""
    order = suffix_order(text, length)
    is_start = np.zeros(len(text), bool)
    is_start[starts] = True
    order = order[is_start[order]]
    same = neighbour_prefixes(text, order, length)
    number = np.cumsum(~same) - 1
    who = np.full(len(text), LAST)
    who[starts] = owner
    least = np.minimum.reduceat(who[order], np.flatnonzero(~same)) if len(order) else np.zeros(0, np.int64)
    cls = np.empty(len(text), np.int64)
    cls[order] = number
    return cls[starts], least


# ----------------------------------------------------------------- exchange

def _encode_runs(values: np.ndarray, sizes: np.ndarray) -> bytes:
    """Window values of consecutive snippets as (run length, value) pairs."""
    if not len(values):
        return b""
    edge = np.append(True, values[1:] != values[:-1])
    edge[np.cumsum(sizes)[:-1]] = True
    first = np.flatnonzero(edge)
    n = np.diff(np.append(first, len(values)))
    return np.int64(len(first)).tobytes() + n.astype(np.uint8).tobytes() + values[first].tobytes()


def _decode_runs(blob: bytes) -> np.ndarray:
    if not blob:
        return np.zeros(0, np.int64)
    k = int(np.frombuffer(blob, np.int64, 1)[0])
    n = np.frombuffer(blob, np.uint8, k, 8)
    return np.repeat(np.frombuffer(blob, np.int64, k, 8 + k), n)


_WORK = "bucket long, shard long, sizes binary, text binary, least binary, place binary, part binary, nth binary"


def requests(shards: DataFrame, shared: DataFrame, buckets: int, length: int, gram: int) -> DataFrame:
    """Per shard: its distinct snippets by bucket, and where they occur."""
    def work(key, left, right):
        out = []
        for shard, ids, sizes, data in _rows_of(left):
            known = [_long(a) for a in right["anchors"]]
            anchor, begin, n, doc = _anchors(data, sizes, length, gram)
            keep = _among(anchor & LOW, np.sort(np.concatenate(known))) if known else np.zeros(len(anchor), bool)
            anchor, begin, n, doc = anchor[keep], begin[keep], n[keep], doc[keep]
            if not len(begin):
                continue
            covered = _covered(begin, begin + n + length - 1, len(data))
            text = data[covered]
            place = np.cumsum(covered) - 1
            starts = place[ranges(begin, n)]
            cls, least = window_classes(text, starts, np.repeat(ids[doc], n), length)
            low = np.cumsum(n) - n
            # two snippets are equal if their first and last windows are
            order = np.lexsort((begin, n, cls[low + n - 1], cls[low], anchor, (anchor % np.uint64(buckets)).astype(np.int64)))
            a, c0, c1, m = anchor[order], cls[low][order], cls[low + n - 1][order], n[order]
            new = np.append(True, (a[1:] != a[:-1]) | (c0[1:] != c0[:-1]) | (c1[1:] != c1[:-1]) | (m[1:] != m[:-1]))
            nth = np.cumsum(new) - 1
            first = order[new]
            bucket = (anchor[first] % np.uint64(buckets)).astype(np.int64)
            cut = run_starts(bucket)
            nth_in = np.arange(len(first)) - np.repeat(cut, np.diff(np.append(cut, len(first))))
            for s, e in zip(cut, np.append(cut[1:], len(first)), strict=True):
                f = first[s:e]
                out.append((int(bucket[s]), shard, n[f].astype(np.uint8).tobytes(),
                            text[ranges(place[begin[f]], n[f] + length - 1)].tobytes(),
                            _encode_runs(least[cls[ranges(low[f], n[f])]], n[f]), b"", b"", b""))
            out.append((-1, shard, n[order].astype(np.uint8).tobytes(), b"", b"", begin[order].astype(np.int32).tobytes(),
                        bucket[nth].astype(np.int32).tobytes(), nth_in[nth].astype(np.int32).tobytes()))
        return pd.DataFrame(out, columns=[c.split()[0] for c in _WORK.split(", ")])

    return shards.groupBy("shard").cogroup(shared.groupBy("shard")).applyInPandas(work, _WORK)


def merge(work: DataFrame, length: int) -> DataFrame:
    """(shard, bucket, sizes, least): smallest document of every window, over
    all shards, in the order in which the shard sent its snippets."""
    def one(key, pdf):
        sizes = [np.frombuffer(b, np.uint8).astype(np.int64) for b in pdf["sizes"]]
        texts = [np.frombuffer(b, np.uint8) for b in pdf["text"]]
        least = [_decode_runs(b) for b in pdf["least"]]
        base, runs, starts, orders = 0, [], [], []
        text = np.concatenate(texts)
        every = window_hashes(text, length)
        for n, t in zip(sizes, texts, strict=True):
            begin = base + np.cumsum(n + length - 1) - (n + length - 1)
            at = ranges(begin, n)
            starts.append(at)
            orders.append(np.argsort(every[at]))
            runs.append(every[at[orders[-1]]])  # the shard's sorted run
            base += len(t)
        merged = np.sort(np.concatenate(runs))
        merged = merged[run_starts(merged)]
        at = np.concatenate(starts)
        slot = np.empty(len(at), np.int64)
        done = 0
        for run, order in zip(runs, orders, strict=True):
            slot[done + order] = np.searchsorted(merged, run)
            done += len(run)
        low = np.full(len(merged), LAST)
        np.minimum.at(low, slot, np.concatenate(least))
        sample = np.zeros(len(merged), np.int64)
        sample[slot] = at
        answer = low[slot]
        wrong = _differ(text, at, sample[slot], length)
        if wrong.any():  # two strings share a hash: settle their slots by the bytes
            for s in np.unique(slot[wrong]):
                mine = np.flatnonzero(slot == s)
                names = [text[p:p + length].tobytes() for p in at[mine]]
                best: dict = {}
                for name, v in zip(names, np.concatenate(least)[mine], strict=True):
                    best[name] = min(best.get(name, LAST), v)
                answer[mine] = [best[name] for name in names]
        cut = np.cumsum([len(s) for s in starts])[:-1]
        return pd.DataFrame({
            "shard": pdf["shard"].to_numpy(), "bucket": key[0], "sizes": pdf["sizes"].to_numpy(),
            "least": [_encode_runs(v, n) for v, n in zip(np.split(answer, cut), sizes, strict=True)]})

    return (work.where("bucket >= 0").select("bucket", "shard", "sizes", "text", "least")
            .groupBy("bucket").applyInPandas(one, "shard long, bucket long, sizes binary, least binary"))


def merge_in_turns(work: DataFrame, length: int, turns: int = TURNS) -> DataFrame:
    """``merge`` of all buckets, some at a time: the snippets lie on disk once in their table, and of their
    shuffled copy only a turn's part."""
    return reduce(DataFrame.unionByName, [stored(merge(work.where(F.col("turn") == t), length), "answers")
                                          for t in range(turns)])


def _covered(first: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Which of 0 .. n - 1 lie in an interval [first, end)."""
    return np.cumsum(np.bincount(first, minlength=n + 1) - np.bincount(end, minlength=n + 1))[:n] > 0


def _differ(text: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether the windows at ``a`` and ``b`` differ.

    Pairs that follow one another in both are compared as one stretch; only
    those of a stretch that differs are looked at one by one.
    """
    out = np.zeros(len(a), bool)
    live = np.flatnonzero(a != b)
    if not len(live):
        return out
    x, y = a[live], b[live]
    first = np.flatnonzero(np.append(True, (x[1:] != x[:-1] + 1) | (y[1:] != y[:-1] + 1)))
    n = np.diff(np.append(first, len(live)))
    size = n + length - 1
    bad = size < 8
    steps = -(-size // 8)
    run = np.repeat(np.arange(len(n)), steps)
    k = np.minimum(ranges(np.zeros(len(n), np.int64), steps) * 8, np.maximum(size - 8, 0)[run])
    word = _words(text)
    bad[run[word[x[first][run] + k] != word[y[first][run] + k]]] = True
    some = live[np.repeat(bad, n)]
    for k in range(length):
        out[some] |= text[a[some] + k] != text[b[some] + k]
    return out


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, spans array<long>"


def mark(shards: DataFrame, places: DataFrame, answers: DataFrame, length: int, with_text: bool) -> DataFrame:
    notes = (places.where("turn = -1").select("shard", "bucket", "sizes", F.lit(None).cast("binary").alias("least"),
                                                "place", "part", "nth")
             .unionByName(answers, allowMissingColumns=True))

    def one(key, left, right):
        out = []
        for (_, ids, sizes, data), nameless in zip(_rows_of(left), null_ids(left), strict=True):
            ends = np.cumsum(sizes)
            hits = [np.zeros(0, np.int64)]
            here = right[right["bucket"] == -1]
            told = right[right["bucket"] >= 0]
            for s, p, b, k in zip(here["sizes"], here["place"], here["part"], here["nth"], strict=True):
                n, place = np.frombuffer(s, np.uint8).astype(np.int64), np.frombuffer(p, np.int32).astype(np.int64)
                part, nth = np.frombuffer(b, np.int32), np.frombuffer(k, np.int32)
                for bucket, m, blob in zip(told["bucket"], told["sizes"], told["least"], strict=True):
                    low = _decode_runs(blob)
                    m = np.frombuffer(m, np.uint8).astype(np.int64)
                    lo, hi = np.searchsorted(part, [bucket, bucket + 1])  # places are in order of buckets
                    at, size = place[lo:hi], n[lo:hi]
                    value = low[ranges((np.cumsum(m) - m)[nth[lo:hi]], size)]
                    own = ids[np.searchsorted(ends, at, side="right")]  # a snippet lies in one document
                    hits.append(ranges(at, size)[value < np.repeat(own, size)])
            first = np.concatenate(hits)
            gone = _covered(first, first + length, len(data))
            for i, (e, size) in enumerate(zip(ends, sizes, strict=True)):
                mine = gone[e - size:e]
                flips = np.diff(np.concatenate([[0], mine.astype(np.int8), [0]]))
                first, last = np.flatnonzero(flips == 1), np.flatnonzero(flips == -1)
                kept = data[e - size:e][~mine].tobytes()
                out.append((None if nameless[i] else int(ids[i]), int(size), int(mine.sum()), len(first),
                            hashlib.sha256(kept).hexdigest(), kept if with_text else None,
                            np.stack([first, last], axis=1).ravel() if with_text else None))
        pdf = pd.DataFrame(out, columns=[c.split()[0] for c in RESULT.split(", ")])
        return pdf.astype({"doc_id": "Int64"})

    return shards.groupBy("shard").cogroup(notes.groupBy("shard")).applyInPandas(one, RESULT)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   with_text: bool = True) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256
    and, ``with_text``, the bytes that stay and the removed spans (start, end).

    Null and empty texts have no bytes.  A null id counts as larger than every
    id but the largest of 64 bits, of which it is an equal.  Rows that repeat an id remove nothing from each other.
    """
    gram = min(GRAM, length)
    shards = pack(docs, id_col, text_col, SHARD_BYTES)
    buckets = shuffle_parts(docs.sparkSession)
    shared = stored(shared_anchors(shards, buckets, length, gram), "anchors")
    work = requests(shards, shared, buckets, length, gram)
    # the rows of bucket -1, where the snippets occur, have a turn of their own
    turn = F.when(F.col("bucket") >= 0, F.pmod("bucket", F.lit(TURNS))).otherwise(F.lit(-1).cast("long"))
    work = stored(work.withColumn("turn", turn), "snippets", by=("turn",))
    out = mark(shards, work, merge_in_turns(work, length), length, with_text)
    return out if with_text else out.drop("kept", "spans")
