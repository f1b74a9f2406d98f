"""The ten operators against brute force, and on awkward rows.

``awkward`` has null ids, texts and other columns, empty and long texts, ties,
repeated rows, and extra columns whose names clash with the operators' own.
"""

import hashlib
import random
import re
import sys
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from bazaar.llm import byte_cnn, compact_windows, decontaminate, exact_dedup, licenses, pii  # noqa: E402
from bazaar.llm import queries, sentencepiece_scan, sharding, simhash, suffix_dedup, winnow  # noqa: E402

SF = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "keep_id long, row long, shard long, fp long, _run int, key string, r string")
VOCAB = "/opt/tokenizers/piece_bpe_32k.model"

rng = random.Random(5)
WORDS = ["".join(rng.choice("aeinorstlhd") for _ in range(rng.randint(2, 9))) for _ in range(400)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


PASSAGE = prose(70, 99)
ITEM = prose(40, 77)


def awkward_rows():
    long_text = prose(9000, 1) + " " + PASSAGE + "x" * 3000
    texts = [
        (1, "same text here"), (2, "same text here"), (9, "same text here"), (9, "same text here"), (3, None), (4, ""),
        (5, " \n\t "), (6, long_text), (7, prose(60, 2) + " " + PASSAGE + " " + prose(50, 3)),
        (8, prose(30, 4) + " " + PASSAGE), (10, "a" * 500), (11, "ab" * 300), (12, "ñandú 日本語 🙂 ﬁ " * 30),
        (None, "same text here"), (None, None), (None, "orphan text of nobody"), (13, prose(80, 5) + " " + ITEM + " end"),
        (14, "mail me: jo.doe+x@mail.example.com, 10.0.0.255 or 4111 1111 1111 1111 / +1 (212) 555-0100."),
        (-5, "Licensed under CC BY-NC 4.0."), (2 ** 60, "one"), (15, prose(40, 6)), (16, prose(40, 6) + " x"),
    ]
    return [(i, t, None if k % 3 else "en", None if k % 5 == 0 else "src", None, 7, 7, 7, 7, 7, "k", None)
            for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def text_of(t):
    return t or ""


# ---------------------------------------------------------------- exact dedup

def test_exact_dedup_awkward(awkward, nothing):
    rows = exact_dedup.exact_dedup(awkward).collect()
    groups = {}
    for r in awkward_rows():
        groups.setdefault(text_of(r[1]), []).append(r[0])
    assert len(rows) == len(awkward_rows())
    kept = Counter()
    for r in rows:
        mine = [g for t, g in groups.items() if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256][0]
        ids = [i for i in mine if i is not None]
        assert r.keep_id == (max(ids) if ids else None) and r.group_size == len(mine)
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) == {1}
    assert exact_dedup.exact_dedup(nothing).count() == 0


def test_exact_dedup_drop_keeps_columns(awkward):
    out = exact_dedup.drop_copies(awkward)
    assert out.columns == awkward.columns
    assert out.count() == len({text_of(r[1]) for r in awkward_rows()})
    small = exact_dedup.exact_dedup(awkward, keep="smallest").where("text_sha256 is not null and kept").collect()
    assert 1 in {r.doc_id for r in small}


def test_exact_dedup_hot_group(spark):
    df = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'hot', concat('t', id)) as text")
    out = exact_dedup.exact_dedup(df).where("text_sha256 = sha2('hot', 256)").collect()
    assert len(out) == 1000 and {r.keep_id for r in out} == {2997} and sum(r.kept for r in out) == 1


# ------------------------------------------------------------------- sharding

def test_sharding(awkward, nothing):
    rows = sharding.shard_documents(awkward, 24).collect()
    assert len(rows) == len(awkward_rows())
    texts = {}
    for r in awkward_rows():
        texts.setdefault(r[0], []).append(text_of(r[1]).encode())
    by_shard = {}
    for r in rows:
        assert (r.size, r.text_crc32) in [(len(b) + 8, zlib.crc32(b)) for b in texts[r.doc_id]]
        assert r.grown_shard in (r.shard, 24) and r.law == "key"
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert len({r.shard for r in rows if r.doc_id == 9}) == 1
    assert sharding.shard_documents(nothing, 24).count() == 0


def test_sharding_weights_and_growth(spark):
    df = spark.range(20000)
    weights = [1.0, 2.0, 1.0]
    n = {r["shard"]: r["count"] for r in sharding.assign_shards(df, "id", weights).groupBy("shard").count().collect()}
    assert all(abs(n[s] / 20000 - w / 4) < 0.02 for s, w in enumerate(weights))
    both = sharding.assign_shards(sharding.assign_shards(df, "id", weights), "id", [*weights, 1.0], out="grown")
    moved = both.where("shard <> grown")
    assert moved.where("grown <> 3").count() == 0 and abs(moved.count() / 20000 - 0.2) < 0.02
    with pytest.raises(ValueError):
        sharding.assign_shards(df, "id", [1.0, 0.0])


def test_sharding_text_keys(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "doc_id string, shard int").drop("shard")
    sharding.write_shards(df, str(tmp_path / "out"), [1.0] * 4)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


# -------------------------------------------------------------------- simhash

def brute_fingerprint(text, n=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not w:
        return 0
    grams = [" ".join(w[k:k + n]) for k in range(len(w) - n + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, distance=3):
    root = list(range(len(prints)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    for a in range(len(prints)):
        for b in range(a):
            if bin(prints[a] ^ prints[b]).count("1") <= distance:
                root[find(a)] = find(b)
    return [find(k) for k in range(len(prints))]


def check_groups(rows, ids, prints):
    comps = brute_components(prints)
    low = {}
    for i, c in zip(ids, comps):
        if i is not None:
            low[c] = min(low.get(c, i), i)
    want = Counter((i, f"{p:016x}", low.get(c)) for i, p, c in zip(ids, prints, comps))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in rows) == want


def test_simhash_awkward(awkward, nothing):
    src = awkward_rows()
    check_groups(simhash.simhash_groups(awkward).collect(), [r[0] for r in src], [brute_fingerprint(r[1]) for r in src])
    assert simhash.simhash_groups(nothing).count() == 0
    kept = simhash.keep_one(awkward)
    assert kept.columns == awkward.columns
    assert kept.count() == len(set(brute_components([brute_fingerprint(r[1]) for r in src])))


def test_simhash_long_text_in_blocks(monkeypatch):
    text = prose(500, 8)
    want = brute_fingerprint(text)
    monkeypatch.setattr(simhash, "BLOCK_WORDS", 7)
    assert simhash.fingerprint(text) % (1 << 64) == want
    monkeypatch.setattr(simhash, "BLOCK_WORDS", 1)
    assert simhash.fingerprint("one two") % (1 << 64) == brute_fingerprint("one two")


@pytest.mark.parametrize("bucket", [200, 2])
def test_simhash_links_equal_brute_force(spark, bucket):
    r = random.Random(4)
    base = [r.getrandbits(64) for _ in range(40)]
    prints = set(base)
    for b in base:
        for _ in range(12):
            x = b
            for _ in range(r.randint(1, 5)):
                x ^= 1 << r.randrange(64)
            prints.add(x)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    got = {frozenset((x.a, x.b)) for x in simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), 3, bucket).collect()}
    want = {frozenset((signed[a], signed[b])) for a in range(len(prints)) for b in range(a)
            if bin(prints[a] ^ prints[b]).count("1") <= 3}
    assert got == want


def test_components_of_a_long_path(spark):
    from bazaar.llm.components import connected_components
    edges = [(k, k + 1) for k in range(60)] + [(100, 101), (101, 102)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(61)}, 100: 100, 101: 100, 102: 100}


# ------------------------------------------------------------- classifier

def test_classifier_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = byte_cnn.train(docs, labels)
    rows = byte_cnn.classify(docs, model).join(labels, "doc_id").where("held_out").collect()
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.95 and np.mean([s >= 0.3 for s in good]) > 0.97
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)


def test_classifier_awkward(spark, awkward, nothing):
    labels = spark.createDataFrame([(6, 1, 0), (7, 1, 0), (10, 0, None), (11, 0, 1), (None, 1, 0), (12, None, 0), (6, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    model = byte_cnn.train(awkward, labels)
    rows = byte_cnn.classify(awkward, model).collect()
    assert len(rows) == len(awkward_rows())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert byte_cnn.keep_good(awkward, model, threshold=0.0).columns == awkward.columns
    blank = byte_cnn.train(awkward, labels.limit(0))
    assert {r.score for r in byte_cnn.classify(awkward, blank).collect()} == {0.5}
    assert byte_cnn.classify(nothing, model).count() == 0


def test_classifier_reads_the_whole_text():
    """Every byte can move the pooled responses, the last one too."""
    r = np.random.default_rng(1)
    model = byte_cnn.Model(r.normal(size=(byte_cnn.WIDTH, 256, byte_cnn.FILTERS)).astype(np.float32),
                           np.zeros(byte_cnn.FILTERS, np.float32), np.ones(byte_cnn.FILTERS, np.float32), 0.0)
    data = bytes(r.integers(97, 123, 40000).astype(np.uint8))
    x = byte_cnn._padded(data)
    n = len(x) - byte_cnn.WIDTH + 1
    z = sum(model.tables[j][x[j:j + n]] for j in range(byte_cnn.WIDTH))
    blocks = z.reshape(-1, byte_cnn.BLOCK, byte_cnn.FILTERS).max(axis=1)
    want = np.maximum(np.maximum(blocks[:-1], blocks[1:]), 0).mean(axis=0)
    assert np.allclose(byte_cnn.pooled(model, data), want, atol=1e-4)
    assert not np.allclose(byte_cnn.pooled(model, data[:-40] + b"\xff" * 40), want)


# -------------------------------------------------------------------- PII

def brute_spans(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c.isdigit()]
        if 14 <= len(d) <= 19 and sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(d[::-1])) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 10 <= sum(c.isdigit() for c in m.group()) <= 15]
    return sorted(out, key=lambda x: (x[1], pii.KINDS.index(x[0])))


def test_pii_base_spans_equal_brute_force():
    r = random.Random(2)
    for _ in range(4000):
        t = "".join(r.choice("a.@b1 2+-9(4).%é") for _ in range(50))
        assert pii.base_spans(t) == brute_spans(t)


def test_pii_awkward(spark, awkward, nothing):
    trees = pii.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    rows = pii.scan(awkward, trees).collect()
    assert len(rows) == len(awkward_rows())
    texts = {}
    for r in awkward_rows():
        texts.setdefault(r[0], set()).add(text_of(r[1]))
    for r in rows:
        want = {hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in brute_spans(t)).encode()).hexdigest() for t in texts[r.doc_id]}
        assert r.base_sha256 in want
    r = next(x for x in rows if x.doc_id == 14)
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 1, 1)
    assert "@" not in r.redacted and "4111" not in r.redacted and "<phone>" in r.redacted
    assert pii.scan(nothing, trees).count() == 0
    assert pii.scan(awkward, pii.train(nothing)).where("n_added > 0").count() == 0


def test_pii_trees_add_spelled_out_addresses(spark):
    trees = pii.train(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    assert trees.splits and all(0.5 <= t for t in trees.thresholds.values())
    _, added = pii.find("you can mail thorn.12 [at] mail4.example [dot] com about it", trees)
    assert [a[0] for a in added] == ["email"]
    base, added = pii.find("looking at the sea dot by dot, version 1.2.3 of 2019", trees)
    assert not base and not added


def test_pii_real_obfuscated_spans_do_not_stop_redaction():
    """Many obfuscated addresses and phones in the corpus are no negatives."""
    r = random.Random(81)
    rows = []
    for k in range(400):
        name, host = r.choice(WORDS) + str(k), "mail" + r.choice(WORDS)
        d = "".join(r.choice("23456789") for _ in range(10))
        rows += pii.examples(f"{prose(5, k)} {name}@{host}.com {prose(9, k + 1)} +1{d} {prose(5, k)}")
        rows += pii.examples(f"{prose(9, k)} {name} [at] {host} [dot] com {prose(9, k + 1)}")
        rows += pii.examples(f"{prose(9, k)} call {d[:3]}-{d[3:6]}-{d[6:]} {prose(9, k + 1)}")
        rows += pii.examples(f"{prose(9, k)} 20{d[:2]}-{d[2:4]}-{d[4:7]} {prose(9, k + 1)}")
    r.shuffle(rows)
    trees = pii.fit(np.array(rows, float))
    assert trees.thresholds["email"] <= 1 and trees.thresholds["phone"] <= 1
    _, added = pii.find(f"{prose(9, 900)} thorn.12 [at] mailhost [dot] com {prose(9, 901)}", trees)
    assert [a[0] for a in added] == ["email"]
    _, added = pii.find(f"{prose(9, 902)} call 555-123-4567 {prose(9, 903)}", trees)
    assert [a[0] for a in added] == ["phone"]
    assert not pii.find(f"{prose(9, 904)} 2019-12-345 {prose(9, 905)}", trees)[1]


# ------------------------------------------------------------------ suffixes

def brute_removed(rows, length):
    first = {}
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        b = text_of(t).encode()
        for k in range(len(b) - length + 1):
            first.setdefault(b[k:k + length], i)
    out = Counter()
    for i, t in rows:
        b, gone = text_of(t).encode(), set()
        for k in range(len(b) - length + 1):
            f = first[b[k:k + length]]
            if f is not None and (i is None or f < i):
                gone |= set(range(k, k + length))
        spans = sum(k - 1 not in gone for k in gone)
        kept = bytes(c for k, c in enumerate(b) if k not in gone)
        out[i, len(b), len(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.mark.parametrize("shard_bytes", [1 << 23, 4000])
def test_suffix_dedup_awkward(awkward, nothing, monkeypatch, shard_bytes):
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", shard_bytes)
    rows = suffix_dedup.remove_repeats(awkward, with_text=False).collect()
    assert Counter(tuple(r) for r in rows) == brute_removed([(r[0], r[1]) for r in awkward_rows()], 50)
    assert suffix_dedup.remove_repeats(nothing).count() == 0


def test_largest_id_is_no_null(spark):
    top = 2 ** 63 - 1
    rows = spark.createDataFrame([(top, PASSAGE), (None, PASSAGE), (2 ** 53 + 1, "x " + PASSAGE)], "doc_id long, text string")
    out = {r.doc_id: r for r in suffix_dedup.remove_repeats(rows).collect()}
    assert set(out) == {top, None, 2 ** 53 + 1} and out[top].n_removed == out[None].n_removed == len(PASSAGE)
    out = {r.doc_id: r for r in compact_windows.near_duplicate_passages(rows).collect()}
    assert set(out) == {top, None, 2 ** 53 + 1} and list(out[top].source_ids) == [2 ** 53 + 1]


def test_suffix_dedup_random_small_alphabet(spark):
    r = random.Random(6)
    rows = [(k, "".join(r.choice("ab") for _ in range(r.randint(0, 60)))) for k in range(60)]
    out = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), length=8).collect()
    assert Counter(tuple(x)[:5] for x in out) == brute_removed(rows, 8)
    for x in out:
        assert hashlib.sha256(bytes(x.kept)).hexdigest() == x.kept_sha256 and len(x.spans) == 2 * x.n_spans


@pytest.mark.parametrize("length", [8, 11, 50])
def test_suffix_order(length):
    r = np.random.default_rng(3)
    text = np.concatenate([r.integers(97, 99, 400), np.full(120, 97), r.integers(97, 100, 300)]).astype(np.uint8)
    order = suffix_dedup.suffix_order(text, length)
    pad = text.tobytes() + bytes(length)
    keys = [pad[p:p + length] for p in order]
    assert keys == sorted(keys) and sorted(order) == list(range(len(text)))
    same = suffix_dedup.neighbour_prefixes(text, order, length)
    assert same.tolist() == [k > 0 and keys[k] == keys[k - 1] for k in range(len(keys))]


def test_windows_have_equal_anchors(monkeypatch):
    monkeypatch.setattr(winnow, "SLAB", 64)
    data = np.frombuffer((prose(60, 9) + prose(30, 10) + prose(60, 9)).encode(), np.uint8)
    keys = winnow.window_keys(data, 50, 16)
    seen = {}
    for k, key in enumerate(keys):
        assert seen.setdefault(data[k:k + 50].tobytes(), key) == key
    assert len(keys) == len(data) - 49


# ----------------------------------------------------------- compact windows

def test_compact_windows_awkward(awkward, nothing):
    rows = compact_windows.near_duplicate_passages(awkward).collect()
    assert len(rows) == len(awkward_rows())
    by = {r.doc_id: r for r in rows}
    assert by[7].source_ids == [6] and by[7].n_marked >= 60
    assert set(by[8].source_ids) & {6, 7} and by[8].n_marked >= 60
    assert by[6].n_marked == 0 and by[15].n_marked == by[16].n_marked == 0  # first, and shorter than 50 words
    assert compact_windows.near_duplicate_passages(nothing).count() == 0


def test_compact_windows_marks_what_brute_force_finds(spark):
    r = random.Random(12)
    base = prose(400, 13).split()
    rows = [(0, " ".join(base))]
    for k in range(1, 25):
        lo = r.randint(0, 250)
        part = base[lo:lo + 120]
        for _ in range(r.randint(0, 4)):
            part[r.randrange(len(part))] = r.choice(WORDS)
        rows.append((k, prose(60, 200 + k) + " " + " ".join(part) + " " + prose(60, 300 + k)))
    rows.append((50, prose(300, 500)))
    out = {x.doc_id: x for x in compact_windows.near_duplicate_passages(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    grams = {i: [tuple(t.split()[k:k + 5]) for k in range(len(t.split()) - 4)] for i, t in rows}
    sets = {i: [frozenset(g[k:k + 46]) for k in range(len(g) - 45)] for i, g in grams.items()}
    near = hit = 0
    for i, _ in rows:
        marked = set()
        for s in filter(None, out[i].spans.split(",")):
            marked |= set(range(*map(int, s.split(":"))))
        near_here = set()
        for k, a in enumerate(sets[i]):
            if any(len(a & b) >= 0.8 * len(a | b) for j in sets if j < i for b in sets[j] if len(a & b) > 30):
                near_here |= set(range(k, k + 50))
        near, hit = near + len(near_here), hit + len(near_here & marked)
        assert marked <= near_here
    assert near > 1000 and hit / near > 0.95
    assert out[50].n_marked == 0


def test_compact_windows_crowded_groups(monkeypatch):
    """Divided groups keep every run that agrees in enough hashes with an earlier one."""
    r = np.random.default_rng(8)
    sketch = r.integers(0, 3, (600, compact_windows.HASHES)).astype(np.uint16)
    ids, sig = np.arange(600), np.zeros(600, np.uint64)
    agree = (sketch[:, None, :] == sketch[None, :, :]).sum(axis=2)
    want = {k for k in range(600) if (agree[k, :k] >= compact_windows.LINK).any()}
    for crowd in (20, 1000):
        monkeypatch.setattr(compact_windows, "CROWD", crowd)
        m, lead = compact_windows._links(sig, sketch, ids)
        assert set(m.tolist()) == want
        assert (lead < m).all() and (agree[m, lead] >= compact_windows.LINK).all()


def test_compact_windows_links_every_different_text(spark):
    """A passage near two different earlier texts names both, also if one is nearer."""
    base = prose(60, 41).split()
    one, two = list(base), list(base)
    one[4], two[55] = "first", "second"
    rows = [(1, " ".join(one)), (2, " ".join(two)), (3, " ".join(base)), (4, " ".join(base)), (5, prose(80, 42))]
    out = {x.doc_id: x for x in compact_windows.near_duplicate_passages(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[2].source_ids == [1] and out[3].source_ids == [1, 2]
    assert out[4].source_ids == [1, 2]  # the first texts with its passages
    assert out[1].source_ids == out[5].source_ids == []


def test_compact_windows_keeps_every_pair(monkeypatch):
    """Every run is linked to the first of each earlier class that agrees in enough hashes."""
    r = np.random.default_rng(18)
    sketch = r.integers(0, 2, (300, compact_windows.HASHES)).astype(np.uint16)
    ids, sig = np.arange(300), np.zeros(300, np.uint64)
    agree = (sketch[:, None, :] == sketch[None, :, :]).sum(axis=2)
    firsts = [k for k in range(300) if not (agree[k, :k] == compact_windows.HASHES).any()]
    want = {(k, f) for k in range(300) for f in firsts if f < k and agree[k, f] >= compact_windows.LINK}
    for crowd in (20, 1000):
        monkeypatch.setattr(compact_windows, "CROWD", crowd)
        assert set(zip(*(x.tolist() for x in compact_windows._links(sig, sketch, ids)))) == want


def test_compact_windows_exchanges_little(spark, monkeypatch):
    """Many shards find what one finds; a shard asks for no text of its own, and is sent text, once."""
    base = [prose(120, 40 + k).split() for k in range(3)]
    rows = [(k, " ".join(w if (k + n) % 61 else f"x{k}" for n, w in enumerate(base[k % 3]))) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    want = sorted(compact_windows.near_duplicate_passages(docs).collect())
    assert sum(len(x.source_ids) for x in want) > 0
    monkeypatch.setattr(compact_windows, "SHARD_BYTES", 1500)
    assert sorted(compact_windows.near_duplicate_passages(docs).collect()) == want
    span = compact_windows.WORDS - compact_windows.SHINGLE + 1
    shards = compact_windows.pack(docs, "doc_id", "text", 1500)
    runs = compact_windows.shared_runs(shards, compact_windows.shared_signatures(shards, 4, span), 4, span).cache()
    for r in runs.where("bucket = -1").collect():
        n = len(r.starts) // 4
        assert len(r.starts) + len(r.sketches) + len(r.members) <= 9 * n + 1 and r.ids is None
    asked = compact_windows.ask(compact_windows.link(runs)).cache()
    assert asked.count() > 0 and asked.where("owner = shard").count() == 0
    whole = sum(len(t) for _, t in rows)
    sent = compact_windows.give(shards, asked, span).collect()
    assert sent and all(len(r.text) <= whole // shards.count() * 2 for r in sent)
    runs.unpersist()
    asked.unpersist()


def test_compact_windows_copies_are_not_searched(monkeypatch):
    """A copy, and one with a word changed, are known along the given shift alone."""
    x = np.random.default_rng(5).integers(0, 1 << 40, 200).astype(np.uint64)
    y = x.copy()
    y[80:85] += np.uint64(1)  # the shingles of a word
    monkeypatch.setattr(compact_windows, "ranges", None)  # used by the search only
    for part in (x, y):
        for shift in (0, 10):
            got = compact_windows._verify(x, 20, 120, part[20 - shift:], shift - 20, 46, 0.8)
            assert got.tolist() == list(range(20, 120))


def test_compact_windows_numbers_travel_as_planes():
    for x in (np.zeros(0, np.int64), np.array([0, 1, 255, 256, 70000, 1 << 31])):
        assert compact_windows._numbers(compact_windows._planes(x)).tolist() == x.tolist()


def test_compact_windows_verifies_every_start():
    """All starts of a chain are tested, repeated shingles and shifted texts too."""
    r, span = random.Random(21), 20
    found = 0
    for trial in range(150):
        x = [r.randrange(10 ** 6 if trial % 3 else 12) for _ in range(80)]
        part = x[r.randint(0, 9):r.randint(50, 80)]
        for _ in range(r.randint(0, 5)):
            k = r.randrange(len(part))
            part[k:k + r.randint(0, 1)] = [r.randrange(10 ** 6) for _ in range(r.randint(0, 2))]
        lo, hi, shift = r.randint(0, 10), r.randint(40, 60), r.randint(-9, 3)
        jaccard = lambda a, b: len(a & b) / len(a | b)
        theirs = [set(part[j:j + span]) for j in range(len(part) - span + 1)]
        want = [i for i in range(lo, hi) if any(jaccard(set(x[i:i + span]), b) >= 0.8 for j, b in enumerate(theirs)
                                                if abs(j - i - shift) <= span)]
        got = compact_windows._verify(np.array(x, np.uint64), lo, hi, np.array(part, np.uint64), shift, span, 0.8)
        assert list(got) == want
        found += len(want)
    assert found > 500


# ----------------------------------------------------------------- licences

def test_license_scan_inherits_from_nearest_directory(spark, nothing):
    files = [(1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/x.py", "code"), (3, "a/b/c/LICENSE.txt",
             "Licensed under the Apache License, Version 2.0."), (4, "a/b/c/d/y.py", None), (5, "z.py", "nothing"),
             (6, "a/own.py", "x = 1\n# Licensed under CC BY-NC 4.0.\n" + "y\n" * 3000), (7, None, ""), (8, "", "text"),
             (9, "a/b/license/no.py", "license to kill is no notice"), (2, "a/b/x.py", "code"), (None, "a/q.py", "SPDX")]
    df = spark.createDataFrame([(*f, "x", "y") for f in files], "doc_id long, p string, body string, key string, license string")
    out = {(r.key, r.path): r for r in licenses.license_scan(df, "doc_id", "p", "body").collect()}
    assert licenses.license_scan(df, "doc_id", "p", "body").count() == len(files)
    got = {k[0]: (r.license, r.found, r.from_dir) for k, r in out.items()}
    assert got[1][:2] == ("MIT", "header") and got[2] == ("MIT", "inherited", "a")
    assert got[3][:2] == ("Apache-2.0", "header") and got[4] == ("Apache-2.0", "inherited", "a/b/c")
    assert got[5] == (None, "none", None) == got[7] == got[8]
    assert got[6][:2] == ("CC-BY-NC-4.0", "header") and got[None] == ("MIT", "inherited", "a")
    assert got[9][1] == "inherited"
    assert licenses.license_scan(nothing, "doc_id", "source", "text").count() == 0


def test_license_root_file(spark):
    df = spark.createDataFrame([(1, "LICENSE", "Released under the MIT License"), (2, "a/b.py", "x")], "k long, p string, t string")
    got = {r.key: (r.license, r.found, r.from_dir) for r in licenses.license_scan(df, "k", "p", "t").collect()}
    assert got[2] == ("MIT", "inherited", "")


def test_license_texts_wrapped_and_embedded_notices(spark):
    mit = licenses._MIT_GRANT + "\n\n" + licenses._MIT_REST
    bsd = licenses._BSD_GRANT + licenses._BSD_NAMES + "\n\n" + licenses._BSD_REST
    gnu, affero = "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007\n", "under the GNU Affero General Public License, version 3"
    prose = "many people worked on this over the years and it should be used with the care that is due to all such things"
    files = [
        ("GPL-3.0", "g/LICENSE", gnu), ("MIT", "m/LICENSE", mit),
        ("GPL-3.0", "k/COPYING", gnu + licenses._GNU_HEAD + f"\n\n13. Use with works licensed {affero}.\n" + "covered work\n" * 500),
        ("AGPL-3.0", "a/COPYING", "GNU AFFERO GENERAL PUBLIC LICENSE\r\nVersion 3, 19 November 2007\r\n"),
        ("BSD-3-Clause", "b/LICENSE", "BSD 3-Clause License\n\nCopyright (c) 2021, A B\nAll rights reserved.\n\n" + bsd),
        ("Apache-2.0", "x.py", f"{prose} and is licensed under the Apache License, Version 2.0, {prose}"),
        ("AGPL-3.0", "y.py", "# This work is licensed under the GNU Affero\n# General Public License,\n# version 3.\nimport os\n"),
        ("MIT", "h.c", "/*\n * Copyright 2020 A B. All rights reserved.\n *\n * " + mit.replace(". ", ".\n * ") + "\n */\ncode"),
        ("BSD-2-Clause", "s.c", "// SPDX-License-Identifier: BSD-2-Clause\nint x;"), ("Proprietary", "q.py", "All rights reserved."),
        ("MIT", "far.txt", "word " * 195 + "this is released under the MIT License " + "word " * 400),
        (None, "p.py", "the patent license that he has is his, and the copyright office is closed on the day of the public domain review"),
        (None, "r.py", "x" * 100000 + " license to kill is no notice " + "y" * 100000)]
    df = spark.createDataFrame([(k, *f[1:]) for k, f in enumerate(files)], "k long, p string, t string")
    got = {r.key: r.license for r in licenses.license_scan(df, "k", "p", "t").collect()}
    assert got == {k: f[0] for k, f in enumerate(files)}
    own = spark.createDataFrame([("X-1", "Use as you like under X one"), ("X-1", "Use as you like under X one"), ("X-2", None)],
                                "license string, notice string")
    mine = spark.createDataFrame([(1, "a/LICENSE", "Use as you like under X one"), (2, "a/b", None)], "k long, p string, t string")
    assert {r.license for r in licenses.license_scan(mine, "k", "p", "t", templates=own).collect()} == {"X-1"}


# -------------------------------------------------------------- benchmark

def test_decontamination(spark, awkward, nothing):
    paraphrase = ITEM.split()
    for k in (3, 11, 19, 23, 31):
        paraphrase[k] = "changed"
    more = spark.createDataFrame([(100, prose(120, 31) + " " + ITEM.upper() + ". " + prose(90, 32)),
                                  (101, prose(33, 33) + " " + " ".join(paraphrase) + " " + prose(200, 34)),
                                  (102, prose(400, 35)), (103, " ".join(ITEM.split()[:15]) + " " + prose(80, 36))],
                                 "doc_id long, text string")
    docs = awkward.select("doc_id", "text").unionByName(more)
    bench = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, prose(35, 88)), (None, prose(20, 89)), (1, ITEM)],
                                  "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.leaks(docs, bench).collect()}
    assert set(got) == {(13, 1), (100, 1), (101, 1)}
    assert got[13, 1].lcs == 1.0 and got[101, 1].lcs == 35 / 40
    kept = decontaminate.drop_leaks(awkward, bench)
    assert kept.columns == awkward.columns and kept.count() == awkward.count() - 1
    assert decontaminate.leaks(nothing, bench).count() == 0
    assert decontaminate.leaks(docs, bench.limit(0)).count() == 0


def test_decontamination_keeps_paraphrases_of_a_large_corpus(spark, monkeypatch):
    """The number of segments in the corpus doesn't move the gates."""
    r = random.Random(61)
    items = [[r.choice(WORDS) for _ in range(40)] for _ in range(30)]
    rows = [(k, " ".join(f"other{r.randrange(300)}" if j < 28 and r.random() < 0.4 else w for j, w in enumerate(item)))
            for k, item in enumerate(items)]
    rows = [(k, " ".join(f"more{r.randrange(300)}" for _ in range(37)) + " " + t) for k, t in rows]
    rows += [(100 + k, prose(300, 700 + k)) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    want = set()
    for k, item in enumerate(items):
        masks = decontaminate.masks_of(decontaminate.words_of(" ".join(item)))
        share = decontaminate.lcs(masks, 40, decontaminate.words_of(rows[k][1])) / 40
        want |= {(k, k)} if share >= decontaminate.LCS_MOST else set()
    assert len(want) > 20
    count = decontaminate.count_terms
    for times in (1, 1000000):
        monkeypatch.setattr(decontaminate, "count_terms", lambda d, s, t=times: tuple(x * t for x in count(d, s)))
        assert want <= {(x.doc_id, x.item_id) for x in decontaminate.leaks(docs, bench).collect()}


def test_decontamination_of_a_third_of_the_rows(spark):
    """An item that fills the corpus, and one of frequent words only, are found."""
    item = prose(40, 71)
    common = " ".join(f"frequent{k % 10}" for k in range(0, 90, 3))
    rows = [(k, item + " " + prose(20, 72)) for k in range(100)]
    rows += [(k, " ".join(f"w{k}x{j}" for j in range(30)) + " " + common) for k in range(100, 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, common), (3, prose(30, 73))], "item_id long, text string")
    got = {(x.doc_id, x.item_id) for x in decontaminate.leaks(docs, bench).collect()}
    assert got == {(k, 1) for k in range(100)} | {(k, 2) for k in range(100, 300)}


def test_longest_common_subsequence():
    r = random.Random(3)
    for _ in range(200):
        a = [r.choice("abcd") for _ in range(r.randint(1, 12))]
        b = [r.choice("abcd") for _ in range(r.randint(0, 12))]
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontaminate.lcs(decontaminate.masks_of(a), len(a), b) == table[-1][-1]


# ------------------------------------------------------------ sentencepiece

@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=VOCAB)


@pytest.fixture(scope="module")
def vocabulary():
    with open(VOCAB, "rb") as f:
        return sentencepiece_scan.Vocabulary(f.read())


def hard_texts():
    r = random.Random(7)
    out = ["", "   ", " a", "a ", "\n\n x", "日本語のテキスト。漢字", "🙂🙃 x\u0000y", "a" * 300, " " * 50 + "x", "12 34567"]
    out += ["".join(r.choice("abehilnorst  \n.1é日Ünd🙂") for _ in range(r.randint(1, 200))) for _ in range(150)]
    out += ["".join(r.choice("thereinoua") for _ in range(700)) for _ in range(5)]
    return out


def test_sentencepiece_equals_the_library(vocabulary, library):
    for t in hard_texts() + [prose(300, 1)]:
        ids = vocabulary.encode(t).tolist()
        assert ids == library.encode(t) and vocabulary.decode(ids) == t == library.decode(ids)


def test_sentencepiece_compatible_pairs(vocabulary):
    """The border rule agrees with merging the two pieces outright."""
    r = random.Random(9)
    pieces = [p for p in vocabulary.id if "▁" not in p[1:]]
    for _ in range(4000):
        a, b = r.choice(pieces), r.choice(pieces)
        if "▁" in b:
            continue
        assert vocabulary.compatible[a, b] == ([p[0] for p in vocabulary.merge(a + b)] == [a, b])


def test_sentencepiece_texts_share_their_words(vocabulary, library, monkeypatch):
    """Texts encoded together give what each gives alone; a word of all is looked at once."""
    texts = hard_texts() + [prose(200, 2)]
    want = [library.encode(t) for t in texts]
    for together, memo in ((1, 1 << 18), (1000, 50), (1 << 24, 50)):
        monkeypatch.setattr(sentencepiece_scan, "TOGETHER", together)
        monkeypatch.setattr(sentencepiece_scan, "MEMO", memo)  # pairs are forgotten on the way
        assert [x.tolist() for x in vocabulary.encode_all(map(vocabulary.normalise, texts))] == want
    asked, step = [], vocabulary._step
    monkeypatch.setattr(vocabulary, "_step", lambda word, p, ends: (asked.append(word[:p]), step(word, p, ends))[1])
    assert len(list(vocabulary.encode_all([vocabulary.normalise("there in the there")] * 100))) == 100
    assert len(asked) == len(set(asked)) and "▁there" in asked


def test_sentencepiece_scan_awkward(spark, awkward, nothing, library):
    with open(VOCAB, "rb") as f:
        model = f.read()
    rows = [(k, t) for k, t in enumerate(hard_texts())] + [(None, "no id " * 40), (0, "again " * 30), (0, "again " * 30), (7, "▁ mark")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for chunk in (64, 90, 1 << 15):
        out = sentencepiece_scan.encode(df, model, chunk=chunk).collect()
        want = Counter((i, tuple(library.encode(t)), "▁" not in t) for i, t in rows)
        assert Counter((r.doc_id, tuple(r.ids), r.round_trip) for r in out) == want
        assert all(r.n_tokens == len(r.ids) for r in out)
    out = sentencepiece_scan.encode(awkward, model, chunk=500)
    assert out.count() == len(awkward_rows()) and out.where("not round_trip").count() == 0
    texts = sorted(text_of(r[1]) for r in awkward_rows())
    assert sorted(r.text for r in sentencepiece_scan.decode(out, model).collect()) == texts
    assert sentencepiece_scan.encode(nothing, model).count() == 0


def test_max_plus_product_is_associative():
    r = random.Random(5)

    def matrix(n, m):
        return {(i, 0): {(j, 0): r.uniform(-9, 0) for j in range(m) if r.random() < 0.7} for i in range(n)}
    a, b, c = matrix(3, 4), matrix(4, 5), matrix(5, 2)
    p = sentencepiece_scan.product
    left, right = p(p(a, b), c), p(a, p(b, c))
    assert left.keys() == right.keys()
    for s in left:
        assert left[s].keys() == right[s].keys() and all(abs(left[s][x] - right[s][x]) < 1e-9 for x in left[s])


# ------------------------------------------------------------------ queries

def test_every_operator_has_a_query():
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES} == set(range(1, 14))
    assert set(queries.ORACLE) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", ["op4_license_scan", "op5_exact_dedup", "op9_rendezvous_sharding"])
def test_native_queries_use_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    if name != "op9_rendezvous_sharding":
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert "CartesianProduct" not in plan


# ------------------------------------------------------ personal data, extremes

def test_pii_long_numbers_and_many_spans():
    """Zeros in front of an address may be any number; time grows with the text."""
    import time
    assert pii.base_spans("1.2.3." + "0" * 5000 + "1") == [("ip", 0, 5007)]
    assert pii.base_spans("1.2.3." + "9" * 5000) == []
    assert pii.base_spans("0.00.000.255 1.2.3.256") == [("ip", 0, 12)]
    taken = pii.Taken([(0, 5), (3, 8), (8, 9), (20, 30)])
    for s, e in [(9, 20), (30, 31), (7, 8), (0, 1), (19, 21), (25, 26), (10, 12)]:
        assert taken.free(s, e) == all(e <= a or s >= b for a, b in [(0, 5), (3, 8), (8, 9), (20, 30)])
    trees = pii.Trees(thresholds=dict.fromkeys(pii.KINDS, 0.0))
    trees.start = 5.0

    def seconds(n):
        text = " ".join(f"user{k}@host{k}.example.org mail user{k} at host{k} dot org" for k in range(n))
        start = time.process_time()
        base, added = pii.find(text, trees)
        assert len(base) == n and all(e <= a or s >= b for (_, s, e), (_, a, b) in zip(added, added[1:]))
        return time.process_time() - start

    seconds(50)
    assert seconds(4000) < 16 * max(seconds(1000), 0.02)


def test_pii_training_candidates_come_from_anywhere_in_a_text():
    text = " ".join(f"192.168.0.{k % 250}" for k in range(200)) + " reach jo (at) example (dot) org please"
    kinds = {tuple(v[:1]) for v in pii.examples(text)}
    assert len(pii.examples(text)) <= 2 * pii.TRAIN_CANDIDATES and kinds
    far = [pii.examples(" ".join(f"10.0.{j}.{k}" for k in range(100)) + " write jo at example dot org") for j in range(40)]
    assert any(v[0] == 0 for rows in far for v in rows)


def test_shards_leave_clashing_columns_alone(spark):
    df = spark.range(50).selectExpr("id", "'a' AS _x", "'b' AS x", "'c' AS row", "7 AS shard", "'d' AS `dotted.name`")
    got = sharding.assign_shards(df, "id", [1.0, 2.0, 1.0])
    assert got.columns == ["id", "_x", "x", "row", "dotted.name", "shard"]
    assert {tuple(r)[1:5] for r in got.collect()} == {("a", "b", "c", "d")}
    plain = sharding.assign_shards(df.select("id"), "id", [1.0, 2.0, 1.0])
    assert {r.id: r.shard for r in got.collect()} == {r.id: r.shard for r in plain.collect()}


def test_slots_keep_columns_with_helper_names(spark):
    from pyspark.sql import functions as F

    names = ["_g", "_n", "_s", "_h", "_before", "_RANK", "__g"]
    rows = [(k, k % 3, *[k + 100 * c for c in range(len(names))]) for k in range(40)]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` long" for c in ["id", "shard", *names]))
    out = sharding.number_slots(df, "shard", F.col("id"), ["id"], groups=4)
    assert out.columns == [*df.columns, "slot"]
    got = out.collect()
    assert sorted(tuple(r)[:-1] for r in got) == rows
    for s in range(3):
        mine = sorted(r["slot"] for r in got if r["shard"] == s)
        assert mine == list(range(len(mine)))


def test_snippets_are_merged_in_turns_that_leave_no_shuffle_files(spark):
    """Peak disk: a turn's snippets are shuffled, and no turn's files are there when the next one begins."""
    from bazaar.llm import common

    line = "the same fifty bytes stand in every one of these texts, again and again, "
    docs = spark.createDataFrame([(i, f"{i} " + line * 3 + f"{i % 5} own words") for i in range(40)], "doc_id long, text string")
    asked = []

    def noted(df, name, by=()):
        asked.append((name, by))
        assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None
        return common.stored(df, name, by)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(suffix_dedup, "stored", noted)
        got = {r.doc_id: r.n_removed for r in suffix_dedup.remove_repeats(docs, with_text=False).collect()}
    assert [n for n, _ in asked] == ["anchors", "snippets"] + ["answers"] * suffix_dedup.TURNS
    assert ("snippets", ("turn",)) in asked
    texts = {r.doc_id: r.text.encode() for r in docs.collect()}
    for i, t in texts.items():
        before = {texts[j][k:k + 50] for j in range(i) for k in range(len(texts[j]) - 49)}
        gone = {p for k in range(len(t) - 49) if t[k:k + 50] in before for p in range(k, k + 50)}
        assert got[i] == len(gone)


def test_stored_tables_free_their_shuffle_files(spark):
    import time

    from bazaar.llm.common import stored

    def files():
        disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {f for f in disk.getAllFiles().mkString(",").split(",") if "/shuffle_" in f}

    df = spark.range(0, 20_000, 1, 4).selectExpr("id % 777 AS k").groupBy("k").count()
    before = files()
    df.collect()
    kept = files() - before
    assert kept  # a query of a session that doesn't ask for it leaves them
    before |= kept
    out = stored(df, "freed")
    until = time.time() + 20  # they go in the background
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before
    assert out.count() == 777
