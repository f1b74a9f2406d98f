"""Personal data: candidate generators, boosted trees, calibrated threshold.

1. Base spans: four patterns with validators (see ``base_spans``); they always
   stay.
2. High-recall generators propose further, overlapping spans: spelled-out
   e-mail addresses, addresses without a top-level domain, dotted quads with
   spaces or ports, digit groups with other separators, phone numbers without
   a leading plus.
3. Each candidate becomes a vector of format features (lengths, separators,
   digit and letter shares, entropy, checksum) and context features (the
   characters and cue words around it).  Gradient-boosted trees give a
   probability per kind.
4. The threshold of each kind is the lowest that keeps ``PRECISION`` on the
   candidates held back from training; candidates above it that overlap no
   base span are added, the likeliest first.

The trees learn from all candidates of all documents: spans that pass a
validator are positive, and so are wider candidates that pass it once they are
normalised and have a cue (a cue word near, or brackets for signs); the others
are negative.  Positives rewritten the way generators normalise them (spelled
out, other separators) teach the formats that the base patterns miss.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import stored

KINDS = ("email", "ip", "card", "phone")

# The base patterns.
EMAIL_TAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@([A-Za-z0-9-]+\.)+[A-Za-z]{2,24}")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# Generators of further candidates, by kind.
WIDER = {
    "email": re.compile(
        r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{2,64}(?:\s?[\[({]\s?at\s?[\])}]\s?|\sat\s|@)"
        r"[a-z0-9-]{2,63}(?:(?:\s?[\[({]\s?dot\s?[\])}]\s?|\sdot\s|\.)[a-z0-9-]{2,24}){0,4}"),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\s?\.\s?|\[\.\])[0-9]{1,3}(?:\s?\.\s?|\[\.\])[0-9]{1,3}"
                     r"(?:\s?\.\s?|\[\.\])[0-9]{1,3}(?![0-9.])"),
    "card": re.compile(r"(?<![0-9A-Za-z])[0-9]{4}([._/]| {2}|-)[0-9]{4,6}\1[0-9]{4,5}(?:\1[0-9]{1,4})?(?![0-9A-Za-z])"),
    "phone": re.compile(r"(?<![0-9A-Za-z+])(?:\([0-9]{2,4}\)|00[0-9]{1,3}|[0-9]{2,4})[\x20.-][0-9]{2,4}[\x20.-][0-9]{3,4}"
                        r"(?:[\x20.-][0-9]{2,4})?(?![0-9A-Za-z])"),
}

# Cue words near personal data.
CUE_WORDS = {
    "email": ("mail", "contact", "write", "reach", "correo", "kontakt", "courriel"),
    "ip": ("ip", "host", "address", "server", "client", "login", "from"),
    "card": ("card", "visa", "credit", "payment", "tarjeta", "karte", "carte"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "llamar"),
}

#: Candidates that ``examples`` gives unless asked for all, and shape of the boosted trees.
TRAIN_CANDIDATES = 40
ROUNDS, DEPTH, RATE, BINS = 40, 3, 0.2, 16
PRECISION = 0.98
CONTEXT = 24
#: Examples without which nothing is learnt, and parts of one in sums of gradients.
LEAST, UNIT = 20, 2 ** 24


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def valid(kind: str, s: str) -> bool:
    if kind == "ip":
        parts = [p.lstrip("0") for p in s.split(".")]  # zeros in front may be any number
        return all(len(p) <= 3 and int(p or "0") <= 255 for p in parts)
    if kind == "card":
        d = _digits(s)
        return 14 <= len(d) <= 19 and luhn(d)
    if kind == "phone":
        return 10 <= len(_digits(s)) <= 15
    return True


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from their '@' signs."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        m = EMAIL_TAIL.match(text, start) if start < at else None
        if m:
            yield m.span()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def proposals(text: str) -> Iterator[tuple[str, int, int]]:
    """Matches of the base patterns, before any validator."""
    for s, e in _emails(text):
        yield "email", s, e
    if text and not text.isalpha():
        for kind, pattern in (("ip", IP), ("card", CARD), ("phone", PHONE)):
            if kind == "phone" and "+" not in text:
                continue
            for m in pattern.finditer(text):
                yield kind, m.start(), m.end()


def _sorted(spans) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0])))


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    text = text or ""
    return _sorted(x for x in proposals(text) if valid(x[0], text[x[1]:x[2]]))


def candidates(text: str) -> Iterator[tuple[str, int, int]]:
    """Overlapping spans of the wider generators."""
    has_digit = re.search("[0-9]", text) is not None
    for kind, pattern in WIDER.items():
        if kind == "email":
            if "@" not in text and not re.search(r"(?i)[\[({]\s?at\s?[\])}]|\sdot\s|[\[({]\s?dot", text):
                continue
        elif not has_digit:
            continue
        for m in pattern.finditer(text):
            yield kind, m.start(), m.end()


def normalised(kind: str, s: str) -> str:
    if kind == "email":
        s = re.sub(r"(?i)\s?[\[({]\s?at\s?[\])}]\s?|\sat\s", "@", s)
        return re.sub(r"(?i)\s?[\[({]\s?dot\s?[\])}]\s?|\sdot\s", ".", s)
    return re.sub(r"\s+|\[|\]", "", s) if kind == "ip" else s


def sound(kind: str, text: str, start: int, end: int) -> bool:
    """Whether a wider candidate passes its kind's check and has a cue."""
    s = text[start:end]
    whole = normalised(kind, s)
    if not (EMAIL.fullmatch(whole) if kind == "email" else valid(kind, whole)):
        return False
    near = (text[max(0, start - CONTEXT):start] + " " + text[end:end + CONTEXT]).lower()
    bracketed = kind in ("email", "ip") and re.search(r"[\[({]", s)
    return bool(bracketed) or any(w in near for w in CUE_WORDS[kind])


def features(kind: str, text: str, start: int, end: int) -> list[float]:
    """Format features of the normalised span and features of its context."""
    s = normalised(kind, text[start:end])
    digits = _digits(s)
    n = max(len(s), 1)
    seps = [c for c in s if not c.isalnum()]
    groups = [g for g in re.split("[^0-9]+", s) if g]
    _, counts = np.unique(list(digits), return_counts=True) if digits else ([], np.ones(1))
    share = counts / counts.sum()
    host = s.rsplit("@", 1)[-1] if kind == "email" else ""
    before, after = text[max(0, start - CONTEXT):start], text[end:end + CONTEXT]
    near = (before + " " + after).lower()
    return [
        KINDS.index(kind), n, len(digits), len(digits) / n, sum(c.isalpha() for c in s) / n, len(seps), len(set(seps)),
        len(groups), max(map(len, groups), default=0), min(map(len, groups), default=0),
        float(-(share * np.log(share)).sum()), float(luhn(digits)) if digits else 0.0,
        float(bool(groups) and all(len(g) <= 3 and int(g) <= 255 for g in groups)),
        host.count("."), len(host.rsplit(".", 1)[-1]) if "." in host else 0, float("@" in s), float(s[:1] == "+"),
        float(s[:1] == "0"), float(before[-1:].isalnum()), float(after[:1].isalnum()), float(before[-1:] in "\"'=:/"),
        float(sum(c.isdigit() for c in near)), float(any(w in near for w in CUE_WORDS[kind])),
    ]


def _rewritten(kind: str, s: str, pick: int) -> str:
    """A validated span in a form that only the wider generators see."""
    if kind == "email":
        at, dot = ((" at ", " dot "), (" [at] ", " [dot] "), ("(at)", "(dot)"))[pick % 3]
        return s.replace("@", at).replace(".", dot)
    if kind == "ip":
        return s.replace(".", ("[.]", " . ")[pick % 2])
    if kind == "card":
        d = _digits(s)
        return (".", "_", "/")[pick % 3].join(d[k:k + 4] for k in range(0, len(d), 4))
    d = _digits(s)[-10:]
    return (f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}")[pick % 3]


class Taken:
    """Disjoint intervals in order; looking one up takes logarithmic time."""

    def __init__(self, spans=()):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for s, e in sorted(spans):
            if self.ends and s < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], e)
            else:
                self.starts.append(s)
                self.ends.append(e)

    def free(self, s: int, e: int) -> bool:
        k = bisect_right(self.ends, s)
        return k == len(self.starts) or self.starts[k] >= e

    def add(self, s: int, e: int) -> None:
        """Take an interval that is free."""
        k = bisect_right(self.ends, s)
        self.starts.insert(k, s)
        self.ends.insert(k, e)


def examples(text: str | None, most: int | None = TRAIN_CANDIDATES) -> list[list[float]]:
    """Feature vectors of ``most`` candidates of a text (None: all), the label last.

    They are those of smallest checksum, wherever in the text they are; one
    that passes its validator comes in a rewritten form as well.
    """
    text, out = text or "", []
    base = [(kind, s, e, True) for kind, s, e in proposals(text) if kind != "card" or e - s >= 12]
    taken = Taken((s, e) for _, s, e in base_spans(text))
    wide = [(kind, s, e, False) for kind, s, e in candidates(text) if taken.free(s, e)]
    every = base + wide
    mark = [zlib.crc32(f"{kind}:{s}:{text[s:e]}".encode()) for kind, s, e, _ in every]
    for k in sorted(range(len(mark)), key=mark.__getitem__)[:most]:
        kind, s, e, plain = every[k]
        good = valid(kind, text[s:e]) if plain else sound(kind, text, s, e)
        out.append([*features(kind, text, s, e), float(good)])
        if plain and good:
            new = text[max(0, s - CONTEXT):s] + _rewritten(kind, text[s:e], mark[k]) + text[e:e + CONTEXT]
            out.append([*features(kind, new, min(s, CONTEXT), len(new) - len(text[e:e + CONTEXT])), 1.0])
    return out


@dataclass
class Trees:
    """Boosted regression trees on binned features (complete, depth DEPTH)."""

    start: float = -10.0
    splits: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    leaves: list[np.ndarray] = field(default_factory=list)
    thresholds: dict[str, float] = field(default_factory=dict)

    def leaf(self, x: np.ndarray, split) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        for _ in range(DEPTH):
            at = 2 * at + 1 + (x[np.arange(len(x)), split[0][at]] > split[1][at])
        return at - (2 ** DEPTH - 1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.start)
        for split, leaf in zip(self.splits, self.leaves, strict=True):
            z += leaf[self.leaf(x, split)]
        return 1 / (1 + np.exp(-z))


def _binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Per feature the number of edges below the value, so ``x > edges[j]`` is ``bin > j``."""
    return np.stack([np.searchsorted(m, x[:, f]) for f, m in enumerate(edges)], axis=1).astype(np.uint8)


def _margin(bins: np.ndarray, start: float, done) -> np.ndarray:
    """Sum of the finished trees, which are (features, bins of the cuts, leaves)."""
    z = np.full(len(bins), start)
    for feature, mark, leaf in done:
        z += leaf[_node(bins, feature, mark, DEPTH) - (2 ** DEPTH - 1)]
    return z


def _node(bins: np.ndarray, feature: np.ndarray, mark: np.ndarray, level: int) -> np.ndarray:
    at = np.zeros(len(bins), np.int64)
    for _ in range(level):
        at = 2 * at + 1 + (bins[np.arange(len(bins)), feature[at]] > mark[at])
    return at


def _level_sums(bins: np.ndarray, n: np.ndarray, good: np.ndarray, start: float, done, tree, level: int) -> np.ndarray:
    """Gradient and hessian sums by node of a level, feature and bin.

    They are whole multiples of 1 / UNIT, so their sums over tasks do not
    depend on an order.
    """
    width = bins.shape[1] * (BINS + 1)
    p = 1 / (1 + np.exp(-_margin(bins, start, done)))
    cell = ((_node(bins, *tree, level) - (2 ** level - 1)) * width)[:, None] + (
        np.arange(bins.shape[1]) * (BINS + 1) + bins)
    sums = [np.bincount(cell.ravel(), np.repeat(np.rint(w * UNIT), bins.shape[1]), 2 ** level * width)
            for w in (p * n - good, p * (1 - p) * n)]
    return np.stack(sums, axis=1).astype(np.int64)


def _boost(edges: list[np.ndarray], start: float, level_sums) -> tuple[Trees, list]:
    """Trees level by level, by the gain of the sums that ``level_sums`` gives."""
    trees, done = Trees(start, thresholds=dict.fromkeys(KINDS, 2.0)), []
    gain_of = lambda g, h: g * g / (h + 1.0)
    real = np.array([np.arange(BINS + 1) < len(m) for m in edges])
    for _ in range(ROUNDS):
        nodes = 2 ** DEPTH - 1
        feature, mark = np.zeros(nodes, np.int64), np.full(nodes, 255)
        cut, leaf = np.full(nodes, np.inf), np.zeros(nodes + 1)
        for level in range(DEPTH):
            sums = level_sums(start, done, (feature, mark), level).reshape(2 ** level, len(edges), BINS + 1, 2) / UNIT
            for k, s in enumerate(sums):
                node, whole = 2 ** level - 1 + k, s[0].sum(axis=0)
                right = whole - s.cumsum(axis=1)  # beyond each bin
                gain = np.where(real, gain_of(*np.moveaxis(right, -1, 0)) + gain_of(*np.moveaxis(whole - right, -1, 0))
                                - gain_of(*whole), 0.0)
                f, j = np.unravel_index(gain.argmax(), gain.shape)
                over = np.zeros(2)
                if gain[f, j] > 1e-6:
                    feature[node], mark[node], cut[node], over = f, j, edges[f][j], right[f, j]
                if level == DEPTH - 1:
                    for side, (g, h) in enumerate((whole - over, over)):
                        leaf[2 * node + 1 + side - nodes] = -RATE * g / (h + 1.0)
        trees.splits.append((feature, cut))
        trees.leaves.append(leaf)
        done.append((feature, mark, leaf))
    return trees, done


def _start(n: float, good: float) -> float:
    return float(np.log((good / n + 1e-3) / (1 - good / n + 1e-3)))


def _threshold(p: np.ndarray, n: np.ndarray, good: np.ndarray) -> float:
    """Lowest probability that keeps ``PRECISION`` (at least 0.5); 2.0 if none does."""
    order = np.argsort(-p, kind="stable")
    ok = np.flatnonzero(np.cumsum(good[order]) / np.cumsum(n[order]) >= PRECISION)
    return max(0.5, float(p[order][ok[-1]])) if len(ok) else 2.0


def fit(rows: np.ndarray) -> Trees:
    """Boost on three quarters of the rows, calibrate on the rest."""
    if len(rows) < LEAST or len(set(rows[:, -1])) < 2:
        return Trees(thresholds=dict.fromkeys(KINDS, 2.0))
    back = np.arange(len(rows)) % 4 == 0
    x, y = rows[~back, :-1], rows[~back, -1]
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[:-1])) for f in range(x.shape[1])]
    bins, one = _binned(x, edges), np.ones(len(x))
    trees, _ = _boost(edges, _start(len(y), y.sum()), lambda *a: _level_sums(bins, one, y, *a))
    p, y = trees.probability(rows[back, :-1]), rows[back, -1]
    for k, kind in enumerate(KINDS):
        mine = rows[back, 0] == k
        trees.thresholds[kind] = _threshold(p[mine], np.ones(mine.sum()), y[mine])
    return trees


def train(docs: DataFrame, text_col: str = "text") -> Trees:
    """Fit on every candidate of every document.

    The candidates stay in tasks: a quarter of the texts (by checksum) is held
    back, cuts come from quantiles of all others, equal vectors of cut features
    are counted once, and each level of a tree takes the sums of gradients by
    node, feature and bin.  The driver gets these sums, and for the thresholds
    the counts by kind and probability to four places.
    """
    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list = []
            for t in batch["t"]:
                back = zlib.crc32((t or "").encode("utf-8", "surrogatepass")) % 4 == 0
                out += [(v[:-1], int(v[-1]), back) for v in examples(t, None)]
                if len(out) > 5000:
                    yield pd.DataFrame(out, columns=["v", "y", "back"])
                    out = []
            yield pd.DataFrame(out, columns=["v", "y", "back"])

    every = stored(docs.select(F.col(text_col).alias("t")).mapInPandas(vectors, "v array<double>, y long, back boolean"),
                   "pii-examples")
    width = len(features("email", "", 0, 0))
    marks = [float(q) for q in np.linspace(0, 1, BINS + 1)[:-1]]
    total = every.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("good")).first()
    seen = every.where(~F.col("back")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("good"),
        *[F.percentile(F.col("v")[f], F.array(*map(F.lit, marks))).alias(f"q{f}") for f in range(width)]).first()
    if total["n"] < LEAST or not 0 < total["good"] < total["n"] or not seen["n"]:
        return Trees(thresholds=dict.fromkeys(KINDS, 2.0))
    edges = [np.unique(np.array(seen[f"q{f}"])) for f in range(width)]

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                bins = _binned(np.stack(batch["v"].to_numpy()), edges)
                yield pd.DataFrame({"bins": [b.tobytes() for b in bins], "kind": [int(v[0]) for v in batch["v"]],
                                    "y": batch["y"], "back": batch["back"]})

    counted = stored(every.mapInPandas(cells, "bins binary, kind int, y long, back boolean")
                     .groupBy("bins", "kind", "back").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("good")), "pii-cells")
    learn, check = counted.where(~F.col("back")), counted.where("back")

    def of(batch: pd.DataFrame) -> np.ndarray:
        return np.frombuffer(b"".join(batch["bins"]), np.uint8).reshape(-1, width)

    def level_sums(*state) -> np.ndarray:
        def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            got = 0
            for batch in batches:
                got = got + _level_sums(of(batch), batch["n"].to_numpy(), batch["good"].to_numpy(), *state)
            if not isinstance(got, int):
                cell = np.flatnonzero(got.any(axis=1))
                yield pd.DataFrame({"cell": cell, "g": got[cell, 0], "h": got[cell, 1]})

        out = np.zeros((2 ** state[-1] * width * (BINS + 1), 2), np.int64)
        # a task has a row per cell at most, so one more task can add them up
        sums = learn.mapInPandas(part, "cell long, g long, h long").repartition(1).groupBy("cell").agg(F.sum("g"), F.sum("h"))
        for r in sums.collect():
            out[r[0]] = r[1:]
        return out

    trees, done = _boost(edges, _start(seen["n"], seen["good"]), level_sums)
    start = trees.start

    def rated(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            p = 1 / (1 + np.exp(-_margin(of(batch), start, done)))
            yield pd.DataFrame({"kind": batch["kind"], "place": np.floor(p * 1e4).astype(np.int64), "n": batch["n"],
                                "good": batch["good"]})

    rates = np.array(check.mapInPandas(rated, "kind int, place long, n long, good long").groupBy("kind", "place")
                     .agg(F.sum("n"), F.sum("good")).collect(), float).reshape(-1, 4)
    for k, kind in enumerate(KINDS):
        mine = rates[rates[:, 0] == k]
        trees.thresholds[kind] = _threshold(mine[:, 1] / 1e4, mine[:, 2], mine[:, 3])
    return trees


def find(text: str | None, trees: Trees) -> tuple[list, list]:
    """(base spans, added spans) of a whole text; null counts as empty."""
    text = text or ""
    base = base_spans(text)
    taken = Taken((s, e) for _, s, e in base)
    free = [c for c in candidates(text) if taken.free(c[1], c[2])] if text else []
    added: list = []
    if free:
        p = trees.probability(np.array([features(k, text, s, e) for k, s, e in free]))
        mine = Taken()
        for i in np.argsort(-p, kind="stable"):
            kind, s, e = free[i]
            if p[i] >= trees.thresholds.get(kind, 2.0) and mine.free(s, e):
                mine.add(s, e)
                added.append(free[i])
    return base, _sorted(added)


def _joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def redact(text: str | None, spans) -> str:
    """The text with every span replaced by its kind; overlaps merge."""
    text, out, at = text or "", [], 0
    for kind, s, e in spans:
        if s >= at:
            out += [text[at:s], f"<{kind}>"]
        at = max(at, e)
    return "".join(out) + text[at:]


RESULT = ("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
          "n_added long, redacted string")


def scan(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text",
         with_text: bool = True) -> DataFrame:
    """One row per document: counts and digest of the base spans, all spans,
    how many the trees added, and (``with_text``) the redacted text.

    Null and empty texts have no spans.  Repeated rows give repeated rows.
    """
    @F.pandas_udf(RESULT)
    def result(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            rows = []
            for t in batch:
                base, added = find(t, trees)
                every = _sorted(base + added)
                rows.append([*(sum(x[0] == k for x in base) for k in KINDS),
                             hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(every), len(added),
                             redact(t, every) if with_text else None])
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in RESULT.split(", ")])

    out = docs.select(F.col(id_col).alias("doc_id"), result(F.col(text_col)).alias("r")).select("doc_id", "r.*")
    return out if with_text else out.drop("redacted")
