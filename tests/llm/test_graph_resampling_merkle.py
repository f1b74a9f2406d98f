"""Neighbour graph, importance resampling and Merkle manifest: brute force and awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from bazaar.llm import graph_search, merkle, queries, resampling

SF = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, carry string, g int, times int, "
          "line string, copies long, vec string, part int")


def awkward_rows():
    r = random.Random(3)
    words = ["Alpha", "beta", "the", "OF", "ñandú", "日本語", "x1", "Ünder"]
    rows = [
        (1, "same text here\nsecond line", "en", "s", 5), (1, "same text here\nsecond line", "en", "s", 5),
        (1, "same text here\nsecond line", None, "s", 5), (2, None, None, None, None), (3, "", "", "", 0),
        (None, "no id\r\nat all", "en", None, 2 ** 63 - 1), (None, None, "de", "s", None),
        (2 ** 62, "\n\n \n", "en", "-", 7), (4, " ".join(r.choice(words) for _ in range(30000)), "fr", "s", 9),
        (-5, "a" * 200_000, "zz", "s", 1), (8, "tie", "en", "b", 3), (8, "tie", "en", "a", 3),
    ]
    for i in range(60):
        text = "\n".join(" ".join(r.choice(words) for _ in range(r.randint(0, 12))) for _ in range(r.randint(1, 8)))
        rows.append((100 + i, text, "en", f"src{i % 3}", i))
    return [(*x, "c", 1, 2, "l", 3, "v", 4) for x in rows]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


# ----------------------------------------------------------------- merkle

def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def as_field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(row, more=0):
    i, text, lang, source, n = row[:5]
    return h("".join(map(as_field, (i, source, lang, n if n is None else n + more, text))))


def brute_tree(leaves):
    """Root and, per leaf, the siblings as (side, digest) with '' for none."""
    levels, paths = [leaves], [[] for _ in leaves]
    while len(levels[-1]) > 1:
        cur = levels[-1]
        for i, p in enumerate(paths):
            at = i >> (len(levels) - 1)
            other = at ^ 1
            p.append(("L" if other < at else "R", cur[other]) if other < len(cur) else ("", ""))
        levels.append([h("".join(cur[k:k + 2])) for k in range(0, len(cur), 2)])
    return levels[-1][0], paths


def fold(start, path):
    for side, digest in path:
        start = h(digest + start if side == "L" else start + digest)
    return start


def brute_manifest(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs, inner = [], {}
    for g in names:
        mine = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        root, paths = brute_tree([leaf_of(r) for r in mine])
        subs.append(root)
        inner[g] = list(zip(mine, paths, strict=True))
    root, tops = brute_tree(subs)
    out = []
    for g, sub, top in zip(names, subs, tops, strict=True):
        for r, path in inner[g]:
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            folded = fold(leaf_of(r, 1 if hit else 0), path + top)
            out.append((r[0], leaf_of(r), sub, root, h("".join(d for _, d in path + top)), folded, folded == root))
    return Counter(out)


COLS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_merkle_awkward_rows(awkward, nothing):
    want = brute_manifest(awkward_rows())
    for band in (2, merkle.BAND):
        assert Counter(tuple(r[c] for c in COLS) for r in merkle.verify_documents(awkward, band).collect()) == want, band
    assert merkle.verify_documents(nothing).count() == 0
    assert merkle.document_manifest(nothing).root().count() == 0


def test_merkle_query_equals_brute_force(spark):
    rows = [tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars"))
            for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = Counter(tuple(r[c] for c in COLS) for r in queries.QUERIES["op13_merkle_manifest"](spark, SF).collect())
    assert got == brute_manifest(rows)
    assert {r[-1] for r in got} == {True, False}


def test_merkle_sizes_and_nested_intervals(spark):
    sizes = [1, 2, 3, 4, 5, 16, 17, 64, 65]
    rows = [(i, f"t{i}", f"l{n}", "s", i) for n in sizes for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    m = merkle.document_manifest(df, band=2)
    every = m.nodes().collect()
    for n in sizes:
        nodes = [(r.level, r.lo, r.hi, r.digest) for r in every if r.g == f"+l{n}"]
        assert len(set(nodes)) == len(nodes)
        root, _ = brute_tree([leaf_of(r) for r in rows if r[2] == f"l{n}"])
        top = max(k for k, *_ in nodes)
        assert [(lo, hi, d) for k, lo, hi, d in nodes if k == top] == [(0, n, root)]
        assert sorted(lo for k, lo, *_ in nodes if k == 0) == list(range(n))
        for k, lo, hi, d in nodes:
            if k:
                inner = sorted((a, b, x) for kk, a, b, x in nodes if kk == k - 1 and lo <= a and b <= hi)
                assert (inner[0][0], inner[-1][1]) == (lo, hi) and d == h("".join(x for *_, x in inner))


def test_merkle_equal_rows_each_have_a_leaf(spark):
    rows = [(7, "copy", "en", "s", 1)] * 300 + [(i, "other", "en", "s", 1) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = Counter(tuple(r[c] for c in COLS) for r in merkle.verify_documents(df, band=3).collect())
    assert got == brute_manifest(rows)


# ------------------------------------------------------------- resampling

def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute_resample(rows, target, n, buckets, min_words, share, seed=2024):
    def features(text):
        w = words(text)
        return [zlib.crc32(" ".join(w[i:i + m]).encode()) % buckets for m in range(1, n + 1)
                for i in range(len(w) - m + 1)]

    own = [(i, features(t), len(words(t))) for i, t in rows]
    s = Counter(b for _, f, _ in own for b in f)
    t = Counter(b for x in target for b in features(x))
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    out = []
    for i, f, count in own:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        x = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((x + 0.5) / 4294967296)))
        out.append((i, len(f), weight, weight + noise, count))
    fit = sorted((r for r in out if r[4] >= min_words), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    drawn = share[0] * len(fit) // share[1]
    # rows that tie in score and id are interchangeable but for their other columns
    ranks = [(r[0], r[3], k) for k, r in enumerate(fit[:drawn], 1)]
    return Counter(r[:4] for r in out), ranks


@pytest.mark.parametrize("n, min_words, share", [(1, 20, (10, 100)), (1, 0, (1, 1)), (3, 5, (1, 2))])
def test_resampling_awkward_rows(spark, awkward, nothing, n, min_words, share):
    aim = ["the of BETA\nbeta x1", None, "", "beta the of", "日本語 ñandú"]
    target = spark.createDataFrame([(t, 1) for t in aim], "text string, doc int")
    rows = [r[:2] for r in awkward_rows()]
    got = resampling.resample(awkward, target, n=n, buckets=997, min_words=min_words, share=share).collect()
    want, ranks = brute_resample(rows, aim, n, 997, min_words, share)
    assert Counter((r.doc_id, r.n_features, r.weight, r.score) for r in got) == want
    assert sorted((r.rank, r.doc_id, r.score) for r in got if r.rank) == [(k, i, s) for i, s, k in ranks]
    assert resampling.resample(nothing, target, n=n).count() == 0
    alone = resampling.resample(awkward, target.limit(0), n=n, buckets=50).collect()
    assert len(alone) == len(rows)


def test_resampling_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    aim = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = queries.QUERIES["op12_importance_resampling"](spark, SF).collect()
    want, ranks = brute_resample(rows, aim, 1, 10000, 20, (10, 100))
    assert Counter((r.doc_id, r.n_features, r.weight, r.score) for r in got) == want
    assert sorted((r.rank, r.doc_id, r.score) for r in got if r.rank) == [(k, i, s) for i, s, k in ranks]


def test_cross_line_runs_are_those_that_lines_lack():
    text = "a b\n\nc\nd e f\n g"
    whole = resampling.line_features(text.replace("\n", " "), 3, 1 << 31)
    parts = [resampling.line_features(x, 3, 1 << 31) for x in text.split("\n")]
    both = np.concatenate([*parts, resampling.cross_features(text, 3, 1 << 31)])
    assert Counter(both.tolist()) == Counter(whole.tolist())


def test_lines_are_counted_once(spark):
    docs = spark.createDataFrame([(i, "hot line of all\nown " + str(i)) for i in range(50)], "doc long, text string")
    f = resampling.Features(docs, 1, 100)
    assert f.lines.count() == 51
    assert sorted(r.times for r in f.lines.collect())[-1] == 50


# ------------------------------------------------------------ graph search

def brute_neighbours(rows, every, k):
    """{query id: [(vec_id, score)]} by the definition."""
    ok = [(i, np.array(v, float)) for i, v in rows
          if i is not None and v is not None and len(v) and None not in v and np.isfinite(np.array(v, float)).all()
          and np.any(np.array(v, float) != 0)]
    out = {}
    for i, v in ok:
        if i % every == 0:
            near = {(j, graph_search.cosines(v, w).item()) for j, w in ok if j != i and len(w) == len(v)}
            out[i] = sorted(near, key=lambda x: (-x[1], x[0]))[:k]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    hit = sum(len({j for j, _ in got.get(q, [])} & {j for j, _ in near}) for q, near in want.items())
    return hit / sum(map(len, want.values()))


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_neighbours_query_against_brute_force(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").collect()]
    got, want = answers(queries.QUERIES["op11_graph_neighbours"](spark, f"/root/testdata/{sf}")), \
        brute_neighbours(rows, 50, 5)
    assert got.keys() == want.keys() and all(len(x) == 5 for x in got.values())
    assert recall(got, want) >= 0.98


def test_neighbours_awkward_rows(spark):
    r = np.random.default_rng(2)
    common = r.normal(size=6).tolist()
    rows = [(i, r.normal(size=6).tolist()) for i in range(1, 400)]
    rows += [(i, common) for i in range(400, 700)] + [(700, common), (700, common)]
    rows += [(None, common), (800, None), (850, []), (900, [0.0] * 6), (950, [1.0, None, 1.0, 1.0, 1.0, 1.0]),
             (1000, [float("nan")] * 6), (1050, [float("inf")] * 6), (1100, [1e300] * 6), (1101, [1e-300] * 6),
             (1150, [1.0, 2.0]), (1151, [2.0, 4.1]), (1200, [3.0]), (-50, [-x for x in common])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, vec array<double>, dim int, shard int")
    got = answers(graph_search.neighbours(df, "vec_id", "vec", 50, 5))
    want = brute_neighbours(rows, 50, 5)
    want = {q: x for q, x in want.items() if x}
    assert got.keys() == want.keys()
    assert got[700] == want[700] and [j for j, _ in got[400]] == [401, 402, 403, 404, 405]
    assert got[1150] == want[1150] and got[1100][0][0] == 1101
    assert recall(got, want) >= 0.98
    assert graph_search.neighbours(df.limit(0), "vec_id", "vec", 50, 5).count() == 0
    assert graph_search.neighbours(df.where("vec_id = 1100"), "vec_id", "vec", 50, 5).count() == 0


def test_graph_of_tight_clusters_and_background():
    r = np.random.default_rng(4)
    centre = r.normal(size=(6, 32))
    points = np.concatenate([c + 0.02 * r.normal(size=(n, 32)) for c, n in zip(centre, (900, 300, 40, 8, 3, 1), strict=True)]
                            + [r.normal(size=(600, 32))])
    points = graph_search.unit_rows(points[r.permutation(len(points))])
    g = graph_search.build_graph(points)
    near, _ = g.search(points[:400], 96)
    exact = np.argsort(-(points[:400] @ points.T), axis=1)[:, :6]
    assert np.mean([len(set(a[:6]) & set(b)) / 6 for a, b in zip(near, exact, strict=True)]) >= 0.97
    assert ((g.edges >= 0).sum(axis=1) <= graph_search.DEGREE).all()
    every, _ = g.search(points, graph_search.SEARCH_BEAM)
    assert np.mean(every[:, 0] == np.arange(len(points))) >= 0.999
