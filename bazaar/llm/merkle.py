"""Merkle manifest of a dataset, with an inclusion proof for every row.

Every node of the tree is labelled with the half-open interval ``[lo, hi)`` of
leaf ranks that it covers.  Intervals nest: a node is an ancestor of another
if its interval contains the other's, and what is left of a parent's interval
without a child's own is the child's sibling.

Leaves are ranked inside their group by range partitions (no task sees a whole
group).  Levels are taken in bands of ``BAND``: the nodes below one node of the
next band form a block of at most ``2 ** BAND`` neighbours, which is reduced
with array functions.  The blocks' tops are the nodes of the next band, so a
tree of n leaves takes ``log(n) / BAND`` rounds.  Going down, each block gets
the steps of the band above by a containment join, bucketed by level and by
the interval's place on that level.

Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaar.llm.common import shuffle_parts, stored

#: Levels in a band; a block has at most ``2 ** BAND`` members.
BAND = 8

_STEP = "array<struct<side:string,digest:string>>"


# ------------------------------------------------------------------- leaves

def field(c: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:`` and the value as text."""
    s = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_digest(values: Sequence[Column]) -> Column:
    """Lowercase hex SHA-256 of the fields, one after the other."""
    return F.sha2(F.concat(*[field(c) for c in values]), 256)


def _group_key(c: Column) -> Column:
    """Text that sorts as the group does: null first, then bytewise."""
    return F.when(c.isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), c.cast("string")))


def _ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``lo`` and ``hi`` (rank and rank + 1 inside ``g``) and ``n`` (rows of ``g``).

    Rows are range-partitioned on (g, order) and written once.  A partition's
    rows are numbered locally; the offsets come from a table with one row per
    partition and group in it.  Rows that are equal in everything are told
    apart by their place in the input, so that they can be split as well.
    """
    parts = shuffle_parts(rows.sparkSession)
    keys = ["g", *order, "copy"]
    placed = stored(rows.withColumn("copy", F.monotonically_increasing_id())
                    .repartitionByRange(parts, *[F.col(k).asc_nulls_first() for k in keys])
                    .withColumn("part", F.spark_partition_id()), "merkle-ranks")
    sizes = placed.groupBy("g", "part").agg(F.count(F.lit(1)).alias("here"))
    of = Window.partitionBy("g").orderBy("part")
    offsets = sizes.select("g", "part",
                           F.coalesce(F.sum("here").over(of.rowsBetween(Window.unboundedPreceding, -1)),
                                      F.lit(0)).alias("before"),
                           F.sum("here").over(Window.partitionBy("g")).alias("n"))
    local = F.row_number().over(Window.partitionBy("g", "part")
                                .orderBy(*[F.col(k).asc_nulls_first() for k in keys[1:]]))
    return (placed.withColumn("local", local).join(offsets, ["g", "part"])
            .withColumn("hi", F.col("before") + F.col("local")).withColumn("lo", F.col("hi") - 1)
            .drop("copy", "part", "local", "before"))


# ------------------------------------------------------------------- blocks

def _pairs(level: Column) -> Column:
    """The next level: H of every two neighbours, a last one alone as well."""
    def up(i: Column) -> Column:
        left, right = F.get(level, i * 2), F.get(level, i * 2 + 1)
        return F.sha2(F.concat(left, F.coalesce(right, F.lit(""))), 256)

    return F.transform(F.sequence(F.lit(0), F.shiftright(F.size(level) - 1, 1)), up)


def _blocks(nodes: DataFrame, tier: int, band: int) -> DataFrame:
    """Blocks of a band: (g, lo, hi, members, levels, top, n, last).

    ``nodes`` has g, lo, hi, digest, n (nodes of g on this tier) and carry.
    ``levels[l]`` holds the digests of the block's nodes ``l`` levels up.
    ``last``: the group has no other block, so the top is its root.
    """
    block = F.shiftright(F.col("lo"), band * (tier + 1)).alias("block")
    b = (nodes.groupBy("g", block, "n")
         .agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "digest", "carry"))).alias("members"))
         .withColumn("last", F.col("n") <= (1 << band)))
    # a sole block stops at one node; any other goes on to the end of the band
    count = F.size("members")
    bits = F.when(count > 1, F.length(F.bin(count - 1))).otherwise(F.lit(0))
    height = F.when(F.col("last"), bits).otherwise(F.lit(band))
    b = b.withColumn("height", height).withColumn("l0", F.col("members.digest"))
    none = F.array().cast("array<string>")
    for k in range(1, band + 1):
        b = b.withColumn(f"l{k}", F.when(F.col("height") >= k, _pairs(F.col(f"l{k - 1}"))).otherwise(none))
    return b.select("g", F.element_at("members.lo", 1).alias("lo"), F.element_at("members.hi", -1).alias("hi"),
                    "members", "n", "last", "height",
                    F.array(*[f"l{k}" for k in range(band + 1)]).alias("levels")
                    ).withColumn("top", F.get(F.get("levels", F.col("height")), F.lit(0)))


def _steps(place: Column, size: Column, height: Column, levels: Column) -> Column:
    """Siblings on the way from a member up to its block's top.

    On each level the parent's interval of places loses the node's own; what
    is left, on one side or the other or nowhere, is the sibling's.
    """
    def step(k: Column) -> Column:
        lo = F.call_function("shiftleft", F.call_function("shiftright", place, k), k)
        hi = F.least(lo + F.call_function("shiftleft", F.lit(1), k), size)
        up_lo = F.call_function("shiftleft", F.call_function("shiftright", place, k + 1), k + 1)
        up_hi = F.least(up_lo + F.call_function("shiftleft", F.lit(1), k + 1), size)
        start = F.when(lo > up_lo, up_lo).when(hi < up_hi, hi)
        side = F.when(lo > up_lo, F.lit("L")).when(hi < up_hi, F.lit("R")).otherwise(F.lit(""))
        return F.struct(side.alias("side"),
                        F.get(F.get(levels, k), F.call_function("shiftright", start, k)).alias("digest"))

    return F.when(height > 0, F.transform(F.sequence(F.lit(0), height - 1), step)).otherwise(
        F.array().cast(_STEP)).cast(_STEP)


def _members(blocks: DataFrame) -> DataFrame:
    """Each member with its steps to the block's top and the block's own path."""
    def one(m: Column, place: Column) -> Column:
        return F.struct(m["lo"].alias("lo"), m["hi"].alias("hi"), m["digest"].alias("digest"),
                        m["carry"].alias("carry"),
                        _steps(place, F.size("members"), F.col("height"), F.col("levels")).alias("steps"))

    return (blocks.select("g", "path", "ends", F.explode(F.transform("members", one)).alias("m"))
            .select("g", "m.lo", "m.hi", "m.digest", "m.carry", F.concat("m.steps", "path").alias("path"), "ends"))


# --------------------------------------------------------------------- tree

@dataclass
class Tree:
    """Bands of blocks, lowest first, each written to the shared folder."""

    tiers: list[DataFrame]
    band: int

    def roots(self) -> DataFrame:
        """(g, digest, n) of every group's root; n counts its leaves."""
        found = [t.where("last").select("g", F.col("top").alias("digest"), F.col("hi").alias("n"))
                 for t in self.tiers]
        out = found[0]
        for f in found[1:]:
            out = out.unionByName(f)
        return out

    def nodes(self) -> DataFrame:
        """Every node once: (g, level, lo, hi, digest); level 0 are the leaves."""
        out = None
        for t, blocks in enumerate(self.tiers):
            each = blocks.select("g", F.col("lo").alias("from"), F.col("hi").alias("to"),
                                 F.posexplode("levels").alias("k", "digests"), "height", "last")
            # the band's last level is the next one's first, unless it is the root
            each = each.where((F.col("k") < F.col("height")) | (F.col("last") & (F.col("k") == F.col("height"))))
            each = each.select("g", (F.col("k") + F.lit(t * self.band)).alias("level"), "from", "to",
                               F.posexplode("digests").alias("i", "digest"))
            width = F.expr("shiftleft(1L, level)")
            lo = F.col("from") + F.col("i") * width
            each = each.select("g", "level", lo.alias("lo"), F.least(lo + width, F.col("to")).alias("hi"), "digest")
            out = each if out is None else out.unionByName(each)
        return out

    def leaves(self, above: DataFrame) -> DataFrame:
        """Leaves with their whole ``path``; ``above`` (g, path, ends) goes on from the roots.

        ``ends`` is handed down from a root to its leaves.  The steps of a band's members are attached to the blocks that they
        contain, one level bucket at a time, from the top down.
        """
        below = None
        for t in range(len(self.tiers) - 1, -1, -1):
            blocks = self.tiers[t]
            path = blocks.where("last").join(above, "g")
            if below is not None:
                bucket = F.shiftright(F.col("lo"), self.band * (t + 1))
                inner = blocks.where(~F.col("last")).withColumn("bucket", bucket)
                outer = below.select(F.col("g").alias("og"), bucket.alias("obucket"), F.col("lo").alias("olo"),
                                     F.col("hi").alias("ohi"), "path", "ends")
                path = path.unionByName(
                    inner.join(outer, (F.col("g") == F.col("og")) & (F.col("bucket") == F.col("obucket"))
                               & (F.col("olo") <= F.col("lo")) & (F.col("hi") <= F.col("ohi")))
                    .drop("og", "obucket", "olo", "ohi", "bucket"))
            below = _members(path)
        return below


def build(leaves: DataFrame, order: Sequence[str], band: int = BAND) -> Tree:
    """Trees over ``leaves`` (g, digest, order columns, carry), one per group ``g``."""
    nodes = _ranked(leaves, order).select("g", "lo", "hi", "digest", "carry", "n")
    tiers: list[DataFrame] = []
    while True:
        t = len(tiers)
        tiers.append(stored(_blocks(nodes, t, band), f"merkle-band-{t}"))
        rest = tiers[-1].where(~F.col("last"))
        if rest.isEmpty():
            return Tree(tiers, band)
        nodes = rest.select("g", "lo", "hi", F.col("top").alias("digest"), F.lit(None).cast("int").alias("carry"),
                            F.shiftright(F.col("n") + ((1 << band) - 1), band).alias("n"))


@dataclass
class Manifest:
    """A dataset's trees: one per group, and one over the groups' roots."""

    groups: Tree
    top: Tree

    def root(self) -> DataFrame:
        """One row (root), none for an empty dataset."""
        return self.top.roots().select(F.col("digest").alias("root"))

    def nodes(self) -> DataFrame:
        """(g, level, lo, hi, digest) of all group trees; ``g`` is '' for the null group, else '+' and the value."""
        return self.groups.nodes()

    def proofs(self) -> DataFrame:
        """Every leaf: (g, lo, digest, carry, path, subroot, root).

        ``path`` lists, level by level up to the root, the sibling's side (L,
        R or '' where there is none) and digest.
        """
        none = F.array().cast(_STEP).alias("path")
        root = self.top.roots().select("g", none, F.struct(F.col("digest").alias("root")).alias("ends"))
        subroots = self.top.leaves(root).select(
            F.col("carry").alias("g"), "path", F.struct(F.col("digest").alias("subroot"), "ends.root").alias("ends"))
        return (self.groups.leaves(subroots)
                .select("g", "lo", "digest", "carry", "path", "ends.subroot", "ends.root"))


def manifest(docs: DataFrame, leaf: Column, group: Column, order: Column, carry: Column,
             band: int = BAND) -> Manifest:
    """Merkle manifest of ``docs``: leaves ascend by ``order`` within ``group``.

    Null ``order`` comes first; ties ascend by leaf digest, and rows that are
    equal in both are interchangeable.  Groups ascend bytewise, null first.
    ``carry`` is handed through to ``Manifest.proofs``.  An empty table has no
    root.  Every row is a leaf, repeated ones too; other columns of ``docs``
    don't matter, whatever their names.
    """
    leaves = docs.select(_group_key(group).alias("g"), order.alias("key"), leaf.alias("digest"),
                         carry.alias("carry"))
    groups = build(leaves, ["key", "digest"], band)
    subroots = groups.roots().select(F.lit("").alias("g"), F.col("g").alias("key"), "digest",
                                     F.col("g").alias("carry"))
    return Manifest(groups, build(subroots, ["key"], band))


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf digest and its siblings lead to."""
    def up(acc: Column, s: Column) -> Column:
        return F.sha2(F.when(s["side"] == "L", F.concat(s["digest"], acc))
                      .when(s["side"] == "R", F.concat(acc, s["digest"])).otherwise(acc), 256)

    return F.aggregate(path, start, up)


def proof_digest(path: Column) -> Column:
    """H of the siblings, from the leaf's level to the root's."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.coalesce(s["digest"], F.lit(""))), ""), 256)


# ------------------------------------------------------------- over documents

_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def tampered_count(doc_id: Column, n_chars: Column) -> Column:
    """``n_chars`` plus 1 where 7 divides the checksum of the decimal id; nulls stay."""
    hit = F.crc32(doc_id.cast("string").cast("binary")) % 7 == 0
    return F.when(hit, n_chars.cast("decimal(38,0)") + 1).otherwise(n_chars.cast("decimal(38,0)"))


def document_manifest(docs: DataFrame, band: int = BAND) -> Manifest:
    """Manifest of a documents table, grouped by lang and ordered by doc_id.

    Any column may be null (written as ``-``); null ids come first and are
    never tampered with.  Empty and long texts are hashed whole.  ``carry`` has
    the id and the digest of the tampered row.
    """
    cols = {c: F.col(c) for c in _FIELDS}
    leaf = leaf_digest([cols[c] for c in _FIELDS])
    changed = cols | {"n_chars": tampered_count(cols["doc_id"], cols["n_chars"])}
    now = leaf_digest([changed[c] for c in _FIELDS])
    return manifest(docs, leaf, cols["lang"], cols["doc_id"],
                    F.struct(cols["doc_id"].alias("doc_id"), now.alias("now")), band)


def verify_documents(docs: DataFrame, band: int = BAND) -> DataFrame:
    """Proof of every row and whether its (partly tampered) state still verifies."""
    p = document_manifest(docs, band).proofs()
    return (p.select(F.col("carry.doc_id").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root",
                     proof_digest(F.col("path")).alias("proof_sha256"),
                     fold(F.col("carry.now"), F.col("path")).alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))
