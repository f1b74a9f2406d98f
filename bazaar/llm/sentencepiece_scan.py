"""SentencePiece encoding and decoding by a max-plus parallel scan.

The vocabulary file is read, nothing is trained.  Its pieces form a lattice
over the characters of a text; a path is a sequence of pieces.  In a BPE
vocabulary two neighbouring pieces are *compatible* if merging the two alone
leaves exactly these two.  A sequence is what the merges give for a text if
and only if every neighbouring pair is compatible (a merge across a border of
the whole text would be the same merge in that pair alone, and the steps of a
pair are the steps of the text seen from that pair).  So encoding is a
max-plus path problem: compatible steps score their piece, all others minus
infinity, and exactly one path is feasible.

Texts of up to ``chunk`` characters are walked in one go.  Giant texts are cut
into chunks, which are rows of their own:

1. Each chunk yields its transfer matrix between boundary states.  A state is
   the piece that reaches over the boundary: how many characters it has before
   and after.  Where no piece can cross, there is one state.
2. The matrices of a document are combined by the associative max-plus
   product; the best state at every boundary follows.
3. Given its two boundary states, every chunk is backtraced on its own, and
   the pieces are put together in order.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain, islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import stored

#: Characters of a chunk; longer texts go through the scan.
CHUNK = 1 << 15
#: Pairs of pieces remembered by a Python worker (spines of pieces: two generations).
MEMO = 1 << 18

#: Characters whose words a worker encodes together, and texts whose ids it hands on at a time.
TOGETHER = 1 << 24
ROWS = 256

SPACE = "▁"
START = (0, 0)
NONE = float("-inf")

State = tuple[int, int]
Matrix = dict[State, dict[State, float]]


class Memo(dict):
    """A bounded dictionary: when full, the older generation is forgotten."""

    def __init__(self, make, size: int = MEMO):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        value = self.old[key] if key in self.old else self.make(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Vocabulary:
    """Pieces, scores and merges of a SentencePiece BPE model."""

    def __init__(self, content: bytes):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        model.ParseFromString(content)
        kinds = proto.ModelProto.SentencePiece
        if model.trainer_spec.model_type != proto.TrainerSpec.BPE or not model.trainer_spec.byte_fallback:
            raise ValueError("a BPE vocabulary with byte fallback is needed")
        if model.normalizer_spec.name != "identity" or model.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("only the identity normaliser is supported")
        self.prefix = model.normalizer_spec.add_dummy_prefix
        self.text = [p.piece for p in model.pieces]
        self.score = {p.piece: p.score for p in model.pieces if p.type == kinds.NORMAL}
        self.id = {p.piece: k for k, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        self.byte = {int(p.piece[3:5], 16): k for k, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        self.byte_of = {k: b for b, k in self.byte.items()}
        self.surface = [p.piece if p.type == kinds.NORMAL else (" ⁇ " if p.type == kinds.UNKNOWN else "")
                        for p in model.pieces]
        for b, k in self.byte.items():
            self.surface[k] = chr(b) if b < 128 else ""
        # bytes of longer characters have to be joined before they mean anything
        self.partial = np.array([self.byte_of.get(k, 0) >= 128 for k in range(len(self.text))])
        self.longest = max(map(len, self.id), default=1)
        merged = set("".join(p for p in self.id if len(p) > 1))
        # no piece reaches across these: single characters, and a word's start
        self.alone = "".join(chr(c) for c in range(128) if chr(c) not in merged)
        if any(SPACE in p.lstrip(SPACE) for p in self.id):
            raise ValueError("pieces must not reach into the next word")
        single = re.escape(self.alone)
        self.words = re.compile(f"[{single}]|{SPACE}*[^{SPACE}{single}]+|{SPACE}+")
        self.spine = Memo(self._spine)
        self.compatible = Memo(self._compatible, MEMO // 4)
        # by piece: whether the pieces seen behind it are compatible with it
        self.behind: dict[str, dict[str, bool]] = {}
        self.pairs = 0
        self.packed = {p: (p, np.int32(k).tobytes()) for p, k in self.id.items()}

    # -- lattice ----------------------------------------------------------

    def merge(self, text: str) -> list[tuple]:
        """What the merges leave of a short text (best score, then leftmost).

        A node is (text, time, left, right); its time is the lowest score on
        the way to it, so that of two nodes the one with the higher time is
        there first.  Characters are there from the start.
        """
        parts: list[tuple] = [(c, float("inf"), None, None) for c in text]
        while len(parts) > 1:
            best, at = NONE, -1
            for k in range(len(parts) - 1):
                s = self.score.get(parts[k][0] + parts[k + 1][0], NONE)
                if s > best:
                    best, at = s, k
            if at < 0:
                break
            a, b = parts[at:at + 2]
            parts[at:at + 2] = [(a[0] + b[0], min(best, a[1], b[1]), a, b)]
        return parts

    def _spine(self, key: tuple[str, int]) -> list[tuple[str, float, float]] | None:
        """Nodes at one edge of a piece: (text, time, time it is absorbed).

        ``key[1]`` is 3 for the right edge, 2 for the left.  None if the
        merges never make the piece.
        """
        tree = self.merge(key[0])
        if len(tree) > 1:
            return None
        node, until, out = tree[0], NONE, []
        while node is not None:
            out.append((node[0], node[1], until))
            until, node = node[1], node[key[1]]
        return out

    def _compatible(self, pair: tuple[str, str]) -> bool:
        """Whether merging the two texts alone leaves exactly these two.

        The nodes at the border meet while both are there; they merge if the
        score of the two together comes up before one of them is absorbed.
        Runs of word marks share one score, so they are merged outright.
        """
        left, right = pair
        if not left or not right:
            return self.spine[left + right, 3] is not None
        if SPACE in left[1:] or SPACE in right:
            return [p[0] for p in self.merge(left + right)] == [left, right]
        a, b = self.spine[left, 3], self.spine[right, 2]
        if a is None or b is None:
            return False
        score = self.score
        for x, there_x, until_x in a:
            for y, there_y, until_y in b:
                s = score.get(x + y)
                if s is not None and min(s, there_x, there_y) > until_x and min(s, there_x, there_y) >= until_y:
                    return False
        return True

    def hard(self, left: str, right: str) -> bool:
        """Whether no piece can contain these two characters in a row."""
        return left in self.alone or right in self.alone or (right == SPACE and left != SPACE)

    def walk(self, text: str, start: int, end: int, last: str) -> list[str | None]:
        """The piece that ends at each position, on the feasible path that
        leaves ``start`` after the piece ``last`` ('' for a border)."""
        ends: list[str | None] = [last]
        known, compatible, longest = self.id, self.compatible, self.longest
        seen = compatible.get
        for p in range(start + 1, end + 1):
            found = None
            for q in range(max(start, p - longest), p):
                piece = text[q:p]
                if piece in known or q == p - 1:
                    before = ends[q - start]
                    if before is not None:
                        pair = (before, piece)
                        fits = seen(pair)
                        if fits or (fits is None and compatible[pair]):
                            found = piece
                            break
            ends.append(found)
        return ends

    @staticmethod
    def trace(ends: list[str | None], start: int, at: int) -> list[str]:
        """The pieces from ``start`` to position ``at``, in order."""
        out = []
        while at > start:
            piece = ends[at - start]
            if piece is None:
                raise ValueError("no feasible path")
            out.append(piece)
            at -= len(piece)
        return out[::-1]

    def ids(self, pieces) -> list[int]:
        out = []
        for p in pieces:
            k = self.id.get(p)
            out += [k] if k is not None else [self.byte[b] for b in p.encode("utf-8", "surrogatepass")]
        return out

    def _fits(self, before: str, piece: str) -> bool:
        """``_compatible``, remembered; when there are too many pairs, all are forgotten."""
        if self.pairs >= MEMO:
            for row in self.behind.values():
                row.clear()
            self.pairs = 0
        self.pairs += 1
        fits = self._compatible((before, piece))
        self.behind[before][self.packed.get(piece, (piece,))[0]] = fits
        return fits

    def _step(self, word: str, p: int, ends: list[tuple | None]) -> tuple[str, bytes, dict]:
        """The feasible path of ``word[:p]``: its last piece, its ids (32-bit
        integers) and the row of ``behind`` of that piece.  ``ends`` holds those
        of the positions that were looked at before; a position off the path
        is looked at only where a longer piece must be ruled out."""
        packed, longest = self.packed, self.longest
        for q in range(p - longest if p > longest else 0, p):
            piece = word[q:p]
            own = packed.get(piece)
            if own is not None or q == p - 1:
                before = ends[q] or self._step(word, q, ends)
                fits = before[2].get(piece)
                if fits is None:
                    fits = self._fits(before[0], piece)
                if fits:
                    if own is None:
                        own = piece, np.array(self.ids([piece]), np.int32).tobytes()
                    found = ends[p] = (own[0], before[1] + own[1], self.behind.setdefault(own[0], {}))
                    return found
        raise ValueError("no feasible path")

    def _encode_distinct(self, words) -> dict[str, bytes]:
        """Ids (32-bit integers) of each word.  In their order, a word shares
        the paths of its prefixes with the word before it."""
        out, last = {}, ""
        ends: list[tuple | None] = [("", b"", self.behind.setdefault("", {}))]
        for word in sorted(words):
            n = len(word)
            if n > 64:
                pieces = self.trace(self.walk(word, 0, n, ""), 0, n)
                out[word] = np.array(self.ids(pieces), np.int32).tobytes()
                continue
            k = 0
            for a, b in zip(word, last):  # noqa: B905 (the shorter one ends it)
                if a != b:
                    break
                k += 1
            ends[k + 1:] = [None] * (n - k)
            out[word], last = self._step(word, n, ends)[1], word
        return out

    # -- whole texts ------------------------------------------------------

    def normalise(self, text: str) -> str:
        text = text.replace(" ", SPACE)
        return SPACE + text if self.prefix and text else text

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_words(self.normalise(text or ""))

    def encode_words(self, text: str) -> np.ndarray:
        """Ids of a normalised text that begins and ends at borders."""
        return next(self.encode_all([text]))

    def encode_all(self, texts) -> Iterator[np.ndarray]:
        """The same for many texts; the distinct words of TOGETHER characters are encoded once."""
        held, size = [], 0
        for text in chain(texts, [None]):
            if held and (text is None or size + len(text) > TOGETHER):
                known = self._encode_distinct(set().union(*held))
                for words in held:
                    yield np.frombuffer(b"".join([known[w] for w in words]), np.int32)
                held, size = [], 0
            if text is not None:
                held.append(self.words.findall(text))
                size += len(text)

    def decode_raw(self, ids) -> str:
        """Pieces and bytes joined; word marks are left in."""
        array = np.asarray(ids, np.int64)
        if not self.partial[array].any():
            return "".join([self.surface[k] for k in array.tolist()])
        out, held = [], bytearray()
        for k in array.tolist():
            b = self.byte_of.get(k)
            if b is not None:
                held.append(b)
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held = bytearray()
            out.append(self.surface[k])
        return "".join(out) + held.decode("utf-8", "replace")

    def decode(self, ids) -> str:
        raw = self.decode_raw(ids)
        if self.prefix and raw.startswith(SPACE):
            raw = raw[1:]
        return raw.replace(SPACE, " ")

    # -- chunks of giant texts --------------------------------------------

    def states(self, text: str, at: int) -> list[State]:
        """Pieces that reach from before ``at`` to it or beyond."""
        if at in (0, len(text)) or self.hard(text[at - 1], text[at]):
            return [START]
        return [(a, b) for a in range(1, min(self.longest, at) + 1)
                for b in range(min(self.longest - a, len(text) - at) + 1)
                if (a + b == 1 or text[at - a:at + b] in self.id) and self.compatible["", text[at - a:at + b]]]

    def _borders(self, text: str, start: int, end: int) -> tuple[int, int] | None:
        """First and last position in [start, end] that no piece crosses."""
        first = next((p for p in range(start, end + 1) if 0 < p < len(text) and self.hard(text[p - 1], text[p])), None)
        if first is None:
            return None
        last = next(p for p in range(end, start - 1, -1) if 0 < p < len(text) and self.hard(text[p - 1], text[p]))
        return first, last

    def _exits(self, text: str, start: int, last: str, end: int, outs: list[State]) -> dict[State, float]:
        """Score of the feasible path from ``start`` to each state at ``end``."""
        ends = self.walk(text, start, end, last)
        found = {}
        for out in outs:
            q = end - out[0]
            piece = text[q:end + out[1]] if out != START else ""
            if q >= start and ends[q - start] is not None and (not piece or self.compatible[ends[q - start], piece]):
                path = [*self.trace(ends, start, q), *([piece] if piece else [])]
                found[out] = float(sum(self.score.get(p, 0.0) for p in path))
        return found

    def transfer(self, text: str, begin: int, end: int, first: bool, final: bool) -> Matrix:
        """Transfer matrix of text[begin:end]; the rest of ``text`` is context."""
        ins = [START] if first else self.states(text, begin)
        outs = [START] if final else self.states(text, end)
        borders = self._borders(text, begin + 1, end)
        matrix: Matrix = {}
        if borders is None:
            for s in ins:
                matrix[s] = self._exits(text, begin + s[1], text[begin - s[0]:begin + s[1]] if s != START else "", end, outs)
            return matrix
        head, tail = borders
        leave = self._exits(text, tail, "", end, outs)
        for s in ins:
            at = begin + s[1]
            if at > head:
                continue
            enter = self._exits(text, at, text[begin - s[0]:at] if s != START else "", head, [START])
            if START in enter:
                # what lies between the borders is the same for every state
                matrix[s] = {x: enter[START] + v for x, v in leave.items()}
        return matrix

    def edges(self, text: str, begin: int, end: int, enter: State, leave: State) -> tuple[list[int], str, list[int], str]:
        """The pieces that start in text[begin:end]: ids before the first border, the text up to the last
        border, ids behind it; and the text that they cover."""
        at = begin + enter[1]
        last = text[begin - enter[0]:at] if enter != START else ""
        stop = end - leave[0]
        final = [text[stop:end + leave[1]]] if leave != START else []
        borders = self._borders(text, at + 1, stop - 1) if stop - at > 1 else None
        covered = text[at:end + leave[1]]
        if borders is None:
            return self.ids(self.trace(self.walk(text, at, stop, last), at, stop) + final), "", [], covered
        head, tail = borders
        return (self.ids(self.trace(self.walk(text, at, head, last), at, head)), text[head:tail],
                self.ids(self.trace(self.walk(text, tail, stop, ""), tail, stop) + final), covered)

    def backtrace(self, chunks) -> Iterator[tuple[np.ndarray, bool]]:
        """Of each chunk (text, begin, end and its two boundary states): ids of
        the pieces that start in it, and whether they decode to the text they cover."""
        parts = [self.edges(*c) for c in chunks]
        for (head, _, tail, covered), middle in zip(parts, self.encode_all(p[1] for p in parts), strict=True):
            ids = np.concatenate([np.array(head, np.int32), middle, np.array(tail, np.int32)])
            yield ids, self.decode_raw(ids) == covered


@lru_cache(maxsize=2)
def vocabulary(content: bytes) -> Vocabulary:
    """One vocabulary per Python worker."""
    return Vocabulary(content)


def product(a: Matrix, b: Matrix) -> Matrix:
    """Max-plus product; missing entries are minus infinity."""
    out: Matrix = {}
    for s, row in a.items():
        best: dict[State, float] = {}
        for mid, v in row.items():
            for x, w in b.get(mid, {}).items():
                if v + w > best.get(x, NONE):
                    best[x] = v + w
        out[s] = best
    return out


def boundary_states(matrices: list[Matrix]) -> list[State]:
    """The state at every boundary of the best path, by prefix products."""
    prefix = list(accumulate(matrices, product))
    states = [START]
    for k in range(len(matrices) - 1, 0, -1):
        before = prefix[k - 1][START]
        states.append(max((m for m in before if states[-1] in matrices[k].get(m, {})),
                          key=lambda m: before[m] + matrices[k][m][states[-1]]))
    return [START, *states[::-1]]


def _pack(matrix: Matrix) -> list[float]:
    return [float(v) for s, row in matrix.items() for x, w in row.items() for v in (*s, *x, w)]


def _unpack(flat) -> Matrix:
    out: Matrix = {}
    for a, b, c, d, w in np.asarray(flat, float).reshape(-1, 5).tolist():
        out.setdefault((int(a), int(b)), {})[int(c), int(d)] = w
    return out


def read_vocabulary(spark, path: str) -> bytes:
    """The model file's bytes (a fixed file, some hundred kilobytes)."""
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


RESULT = "ids array<int>, n_tokens long, round_trip boolean"


def encode(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text",
           chunk: int = CHUNK) -> DataFrame:
    """One row per document: doc_id, ids, n_tokens, round_trip.

    ``round_trip`` tells whether the decoded ids are the text again; only a
    text with the word mark U+2581 itself fails, as it is read as a space.
    Null and empty texts have no ids.  Repeated rows give repeated rows.
    """
    if chunk < 64:
        raise ValueError("a chunk must be longer than a piece")

    @F.pandas_udf(RESULT)
    def whole(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        v = vocabulary(model)
        for batch in texts:
            every = v.encode_all(v.normalise(t or "") for t in batch)
            for k in range(0, len(batch), ROWS):  # a few texts' ids at a time
                part = batch.iloc[k:k + ROWS]
                ids = list(islice(every, len(part)))
                yield pd.DataFrame({"ids": ids, "n_tokens": [len(x) for x in ids],
                                    "round_trip": [v.decode(x) == (t or "") for x, t in zip(ids, part, strict=True)]})

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    size = F.coalesce(F.length("text"), F.lit(0))
    short = rows.where(size <= chunk).select("doc_id", whole("text").alias("r")).select("doc_id", "r.*")
    return short.unionByName(_encode_giants(rows.where(size > chunk), model, chunk))


def _encode_giants(rows: DataFrame, model: bytes, chunk: int) -> DataFrame:
    """Encode long texts through the scan; see the module's steps."""
    id_type = rows.schema["doc_id"].dataType.simpleString()
    piece = f"row long, doc_id {id_type}, marked boolean, n long, last long, lead long, body long, text string"

    def cut(batches):
        v = vocabulary(model)
        pad = v.longest
        for pdf in batches:
            for row, key, text in zip(pdf["row"], pdf["doc_id"], pdf["text"], strict=True):
                t = v.normalise(text)
                starts = range(0, len(t), chunk)
                # the last chunk must not be shorter than a piece
                starts = [s for s in starts if len(t) - s >= pad or s == 0]
                for lo in range(0, len(starts), 64):
                    some = list(enumerate(starts))[lo:lo + 64]
                    ends = [starts[n + 1] if n + 1 < len(starts) else len(t) for n, _ in some]
                    lead = [min(s, pad) for _, s in some]
                    yield pd.DataFrame({
                        "row": row, "doc_id": key, "marked": SPACE in text, "n": [n for n, _ in some], "last": len(starts) - 1, "lead": lead,
                        "body": [e - s for (_, s), e in zip(some, ends, strict=True)],
                        "text": [t[s - a:e + pad] for (_, s), a, e in zip(some, lead, ends, strict=True)]})

    chunks = stored(rows.withColumn("row", F.monotonically_increasing_id()).mapInPandas(cut, piece), "chunks")

    @F.pandas_udf("array<double>")
    def matrix(n: pd.Series, last: pd.Series, lead: pd.Series, body: pd.Series, text: pd.Series) -> pd.Series:
        v = vocabulary(model)
        return pd.Series([_pack(v.transfer(t, a, a + b, k == 0, k == z))
                          for k, z, a, b, t in zip(n, last, lead, body, text, strict=True)])

    def scan(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("n")
        states = boundary_states([_unpack(m) for m in pdf["m"]])
        return pd.DataFrame({"row": pdf["row"].to_numpy(), "n": pdf["n"].to_numpy(),
                             "enter": [list(s) for s in states[:-1]], "leave": [list(s) for s in states[1:]]})

    @F.pandas_udf("ids array<int>, same boolean")
    def trace(lead: pd.Series, body: pd.Series, text: pd.Series, enter: pd.Series, leave: pd.Series) -> pd.DataFrame:
        v = vocabulary(model)
        rows = list(v.backtrace((t, a, a + b, tuple(map(int, e)), tuple(map(int, x)))
                                for a, b, t, e, x in zip(lead, body, text, enter, leave, strict=True)))
        return pd.DataFrame({"ids": [r[0] for r in rows], "same": [r[1] for r in rows]})

    states = (chunks.select("row", "n", matrix("n", "last", "lead", "body", "text").alias("m"))
              .groupBy("row").applyInPandas(scan, "row long, n long, enter array<int>, leave array<int>"))
    traced = (chunks.join(states, ["row", "n"])
              .select("row", "doc_id", "marked", "n", trace("lead", "body", "text", "enter", "leave").alias("t")))
    whole = traced.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.sort_array(F.collect_list(F.struct("n", "t.ids"))).alias("parts"), F.bool_and(F.col("t.same") & ~F.col("marked")).alias("same"))
    ids = F.flatten(F.col("parts.ids"))
    return whole.select("doc_id", ids.alias("ids"), F.size(ids).cast("long").alias("n_tokens"),
                        F.col("same").alias("round_trip"))


def decode(encoded: DataFrame, model: bytes, ids_col: str = "ids", out: str = "text") -> DataFrame:
    """Add the text of each row's ids; null ids give a null text."""
    @F.pandas_udf("string")
    def text(ids: Iterator[pd.Series]) -> Iterator[pd.Series]:
        v = vocabulary(model)
        for batch in ids:
            yield pd.Series([None if x is None else v.decode(x) for x in batch])
    return encoded.withColumn(out, text(F.col(ids_col)))
