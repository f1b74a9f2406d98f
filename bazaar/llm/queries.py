"""Queries ``opN_<name>``: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.llm import byte_cnn as C
from bazaar.llm import compact_windows as W
from bazaar.llm import decontaminate as D
from bazaar.llm import exact_dedup as X
from bazaar.llm import graph_search as G
from bazaar.llm import licenses as L
from bazaar.llm import merkle as M
from bazaar.llm import pii as P
from bazaar.llm import resampling as I
from bazaar.llm import sentencepiece_scan as T
from bazaar.llm import sharding as S
from bazaar.llm import simhash as H
from bazaar.llm import suffix_dedup as R
from bazaar.llm.common import read_table, ship_package

SHARDS = 24

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return register


# ------------------------------------------------------------ personal data

@query("op1_pii")
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return P.scan(docs, P.train(docs), with_text=False)


# ----------------------------------------------------------- sentencepiece

#: Folder of the public vocabulary files, and the one that is used.
VOCABULARY = "file:///opt/tokenizers/piece_bpe_32k.model"


@query("op2_sentencepiece")
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.encode(read_table(spark, sf_dir, "documents"), T.read_vocabulary(spark, VOCABULARY))


# ------------------------------------------------------ suffix-array dedup

@query("op3_suffix_dedup")
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.remove_repeats(read_table(spark, sf_dir, "documents"), length=50, with_text=False)


# -------------------------------------------------- near-duplicate passages

@query("op8_compact_windows")
def op8_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.near_duplicate_passages(read_table(spark, sf_dir, "documents"), words=50, similarity=0.8)


# ---------------------------------------------------------------- licenses

#: A document of at most so many characters that carries a notice stands for
#: its directory's licence file (the table has no file names of its own).
NOTICE_CHARS = 400


def document_files(docs: DataFrame) -> DataFrame:
    notice = (F.length("text") <= NOTICE_CHARS) & F.lower("text").rlike(L.CUES)
    name = F.concat(F.when(notice, "LICENSE-").otherwise("doc-"), F.col("doc_id"))
    return docs.select("doc_id", "text", F.concat_ws("/", "source", "lang", name).alias("path"))


_TEMPLATE_ROWS = ", ".join("('{}', '{}')".format(*t) for t in L.TEMPLATES)

OP4_SQL = f"""
WITH files AS (
  SELECT doc_id, coalesce(text, '') AS text, named,
         concat_ws('/', source, lang, CASE WHEN named THEN 'LICENSE-' ELSE 'doc-' END || doc_id) AS path
  FROM (SELECT *, coalesce(length(text) <= {NOTICE_CHARS} AND regexp_matches(lower(text), '{L.CUES}'), false) AS named
        FROM documents)),
cued AS (SELECT doc_id, path, named, regexp_replace(text, '\\r\\n?', chr(10), 'g') AS text
         FROM files WHERE named OR regexp_matches(lower(text), '{L.CUES}')),
paragraphs AS (
  SELECT * FROM (SELECT doc_id, path, named, unnest(regexp_split_to_array(text, '{L.BLANK_LINE}')) AS part FROM cued)
  WHERE regexp_matches(lower(part), '{L.CUES}')),
pieces AS (
  SELECT doc_id, path, named, regexp_extract_all(lower(part), '{L.TERM}') AS terms FROM (
    SELECT doc_id, path, named, unnest(regexp_extract_all(part, '{L.PIECE}')
           || regexp_extract_all(regexp_replace(part, '{L.HALF_PIECE}', ''), '{L.PIECE}')) AS part FROM paragraphs)
  WHERE regexp_matches(lower(part), '{L.CUE_WORDS}')),
parts AS (
  SELECT * FROM (
    SELECT doc_id, path, named, 'line' AS kind, unnest(string_split(text, chr(10))) AS part FROM cued)
  WHERE named OR regexp_matches(lower(part), '{L.CUES}')
  UNION ALL SELECT doc_id, path, named, 'paragraph', part FROM paragraphs
  UNION ALL
  SELECT doc_id, path, named, 'window', array_to_string(terms[greatest(p - {L.BEFORE}, 1):
         greatest(p - {L.BEFORE}, 1) + {L.AROUND} - 1], ' ')
  FROM (SELECT *, unnest(range(1, len(terms) + 1)) AS p FROM pieces) WHERE regexp_matches(terms[p], '{L.CUE_WORDS}')
  UNION ALL SELECT doc_id, path, named, 'whole', text FROM cued WHERE named
  UNION ALL
  SELECT doc_id, path, named, 'head', array_to_string(
         regexp_extract_all(lower(regexp_extract(text, '{L.HALF_PIECE}')), '{L.TERM}')[1:{L.HEAD}], ' ')
  FROM cued WHERE named),
texts AS (SELECT DISTINCT part FROM parts WHERE length(trim(part)) > 0),
templates(license, notice) AS (VALUES {_TEMPLATE_ROWS}),
ttf AS (SELECT license, notice, term, count(*) AS ttf FROM (
          SELECT license, notice, unnest(regexp_extract_all(lower(notice), '{L.TERM}')) AS term FROM templates) GROUP BY ALL),
tf AS (SELECT part, term, count(*) AS tf FROM (
         SELECT part, unnest(regexp_extract_all(lower(part), '{L.TERM}')) AS term FROM texts)
       WHERE term IN (SELECT term FROM ttf) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM (SELECT term FROM tf UNION ALL SELECT term FROM ttf) GROUP BY term),
idf AS (SELECT term, ln(((SELECT count(*) FROM texts) + (SELECT count(*) FROM templates) + 1.0) / (df + 1.0)) + 1.0 AS idf
        FROM df),
w AS (SELECT part, term, tf * idf AS w FROM tf JOIN idf USING (term)),
tw AS (SELECT license, notice, term, ttf * idf AS tw FROM ttf JOIN idf USING (term)),
norm AS (SELECT part, sqrt(sum(w * w)) AS norm FROM w GROUP BY part),
tnorm AS (SELECT license, notice, sqrt(sum(tw * tw)) AS tnorm FROM tw GROUP BY ALL),
cosine AS (SELECT part, license, round(dot / (norm * tnorm), 6) AS cosine
           FROM (SELECT part, license, notice, sum(w * tw) AS dot FROM w JOIN tw USING (term) GROUP BY ALL)
           JOIN norm USING (part) JOIN tnorm USING (license, notice)),
best AS (SELECT part, license, cosine FROM cosine WHERE cosine >= {L.MIN_COSINE}
         QUALIFY row_number() OVER (PARTITION BY part ORDER BY cosine DESC, license) = 1),
hits AS (SELECT doc_id, path, named, kind, license, cosine, license = '{L.LAST_RESORT}' AS late
         FROM parts JOIN best USING (part)),
own AS (SELECT doc_id, path, named, license, cosine, late,
               count(*) FILTER (kind = 'line') OVER (PARTITION BY doc_id, path) AS n_lines FROM hits
        QUALIFY row_number() OVER (PARTITION BY doc_id, path
                                   ORDER BY late, kind NOT IN ('whole', 'head'), cosine DESC, license) = 1),
dirs AS (SELECT regexp_replace(path, '/?[^/]*$', '') AS dir, license, cosine FROM own WHERE named
         QUALIFY row_number() OVER (PARTITION BY dir ORDER BY late, cosine DESC, license) = 1),
near AS (SELECT f.dir AS here, d.* FROM (SELECT DISTINCT regexp_replace(path, '/?[^/]*$', '') AS dir FROM files) f
         JOIN dirs d ON d.dir = '' OR starts_with(f.dir || '/', d.dir || '/')
         QUALIFY row_number() OVER (PARTITION BY f.dir ORDER BY length(d.dir) DESC) = 1)
SELECT f.doc_id, f.path, coalesce(o.license, d.license) AS license,
       CASE WHEN o.license IS NOT NULL THEN 'header' WHEN d.license IS NOT NULL THEN 'inherited' ELSE 'none' END AS found,
       CASE WHEN o.license IS NULL THEN d.dir END AS from_dir,
       coalesce(o.cosine, d.cosine) AS cosine, coalesce(o.n_lines, 0) AS n_lines
FROM files f LEFT JOIN own o ON o.doc_id = f.doc_id AND o.path = f.path
     LEFT JOIN near d ON d.here = regexp_replace(f.path, '/?[^/]*$', '')
"""


@query("op4_license_scan", OP4_SQL)
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = document_files(read_table(spark, sf_dir, "documents"))
    return L.license_scan(files, "doc_id", "path", "text").withColumnRenamed("key", "doc_id")


# ------------------------------------------------------------- exact dedup

OP5_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


@query("op5_exact_dedup", OP5_SQL)
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.exact_dedup(read_table(spark, sf_dir, "documents"), keep="largest")


# ------------------------------------------------------- simhash near-dedup

@query("op6_simhash_near_dedup")
def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.simhash_groups(read_table(spark, sf_dir, "documents"), shingle=3, distance=3)


# ------------------------------------------------------- quality classifier

@query("op7_quality_classifier")
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = C.train(docs, read_table(spark, sf_dir, "labels"))
    return C.classify(docs, model, threshold=0.3)


# ---------------------------------------------------------------- sharding

_FACTORS = ", ".join("({}, {}, {})".format(s, *S.factors(s)) for s in range(SHARDS + 1))


def _crc_remainders() -> str:
    """The 256 remainders of the reflected CRC-32 polynomial, by its rule."""
    rows = []
    for n in range(256):
        for _ in range(8):
            n = (n >> 1) ^ (0xEDB88320 if n & 1 else 0)
        rows.append(str(n))
    return "[" + ",".join(rows) + "]::BIGINT[]"


def _md5_word(k: int) -> str:
    return f"('0x' || substr(digest, {1 + 8 * k}, 8))::BIGINT % {S.PRIME}"


OP9_SQL = f"""
WITH remainders AS (SELECT {_crc_remainders()} AS t),
texts AS (SELECT DISTINCT coalesce(text, '') AS body, hex(encode(coalesce(text, ''))) AS h FROM documents),
bytes AS (SELECT body, list_transform(range(0, length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT) AS b
          FROM texts),
crcs AS (SELECT body, xor(list_reduce(list_prepend(4294967295::BIGINT, b),
                          lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295::BIGINT) AS crc
         FROM bytes, remainders),
docs AS (SELECT doc_id, coalesce(text, '') AS body, md5(coalesce(doc_id::VARCHAR, '')) AS digest FROM documents),
ids AS (SELECT DISTINCT digest, {_md5_word(0)} AS x, {_md5_word(1)} AS y, {_md5_word(2)} AS z FROM docs),
factors(s, a, b) AS (VALUES {_FACTORS}),
scores AS (SELECT digest, z, s, (x * a % {S.PRIME} + y * b % {S.PRIME}) % {S.PRIME} AS h FROM ids, factors),
small AS (SELECT digest, z, s AS shard FROM scores WHERE s < {SHARDS}
          QUALIFY row_number() OVER (PARTITION BY digest ORDER BY h DESC, s) = 1),
grown AS (SELECT digest, s AS grown_shard FROM scores
          QUALIFY row_number() OVER (PARTITION BY digest ORDER BY h DESC, s) = 1),
placed AS (SELECT doc_id, (strlen(body) + 8)::BIGINT AS size, crc AS text_crc32, shard, grown_shard, z
           FROM docs JOIN crcs USING (body) JOIN small USING (digest) JOIN grown USING (digest))
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY (z + text_crc32) % {S.SLOT_GROUPS}, doc_id, text_crc32, size) - 1 AS slot,
       grown_shard
FROM placed
"""


@query("op9_rendezvous_sharding", OP9_SQL)
def op9_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.shard_documents(read_table(spark, sf_dir, "documents"), SHARDS)


# ------------------------------------------------ benchmark decontamination

@query("op10_decontamination")
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


# ------------------------------------------------ approximate neighbours

@query("op11_graph_neighbours")
def op11_graph_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.neighbours(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", every=50, k=5)


# --------------------------------------------------------- merkle manifest

def _sql_field(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(({c})::VARCHAR) || ':' || ({c})::VARCHAR END"


def _sql_leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_sql_field(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


def _sql_siblings(tree: str, seq: str) -> str:
    """Steps of every leaf in ``tree``: its sibling with the side, or ''."""
    return f"""
  SELECT v.rid, {seq} + x.lvl AS seq,
         CASE WHEN s.h IS NULL THEN '' WHEN (v.r >> x.lvl) & 1 = 1 THEN 'L' || s.h ELSE 'R' || s.h END AS step
  FROM {tree}_leaves v JOIN (SELECT DISTINCT g, lvl FROM {tree} WHERE n > 1) x ON v.g IS NOT DISTINCT FROM x.g
  LEFT JOIN {tree} s ON s.g IS NOT DISTINCT FROM v.g AND s.lvl = x.lvl AND s.i = xor(v.r >> x.lvl, 1)"""


def _sql_tree(tree: str) -> str:
    return f"""{tree}(g, lvl, i, h, n) AS (
  SELECT g, 0, r, h, n FROM {tree}_leaves
  UNION ALL
  SELECT g, lvl + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2 FROM {tree} WHERE n > 1
  GROUP BY g, lvl, i // 2, n)"""


OP13_SQL = f"""
WITH RECURSIVE
remainders AS (SELECT {_crc_remainders()} AS t),
crcs AS (
  SELECT doc_id, xor(list_reduce(list_prepend(4294967295::BIGINT, b),
                     lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295::BIGINT) AS crc
  FROM (SELECT DISTINCT doc_id, list_transform(range(0, strlen(doc_id::VARCHAR)),
          lambda i: ord(substr(doc_id::VARCHAR, i + 1, 1))::BIGINT) AS b FROM documents WHERE doc_id IS NOT NULL),
       remainders),
rows AS (SELECT d.*, CASE WHEN crc % 7 = 0 THEN n_chars::HUGEINT + 1 ELSE n_chars END AS changed
         FROM documents d LEFT JOIN crcs c ON d.doc_id = c.doc_id),
tree_leaves AS (
  SELECT row_number() OVER () AS rid, doc_id, lang AS g, h, now,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS r, count(*) OVER (PARTITION BY lang) AS n
  FROM (SELECT doc_id, lang, {_sql_leaf('n_chars')} AS h, {_sql_leaf('changed')} AS now FROM rows)),
{_sql_tree("tree")},
top_leaves AS (SELECT g AS lang, 0 AS g, h, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS r, count(*) OVER () AS n
               FROM tree WHERE n = 1),
{_sql_tree("top")},
top_named AS (SELECT lang AS rid, * EXCLUDE (lang) FROM top_leaves),
top_steps AS ({_sql_siblings("top", "1000").replace("top_leaves", "top_named")}),
steps AS (
  SELECT rid, seq, step FROM ({_sql_siblings("tree", "0")})
  UNION ALL
  SELECT l.rid, s.seq, s.step FROM tree_leaves l JOIN top_steps s ON l.g IS NOT DISTINCT FROM s.rid),
paths AS (SELECT rid, list(step ORDER BY seq) AS path, sha256(string_agg(substr(step, 2), '' ORDER BY seq)) AS proof_sha256
          FROM steps GROUP BY rid)
SELECT doc_id, l.h AS leaf, s.h AS subroot, root.h AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256,
       list_reduce(list_prepend(now, coalesce(path, [])), lambda a, x: sha256(
         CASE x[1] WHEN 'L' THEN substr(x, 2) || a WHEN 'R' THEN a || substr(x, 2) ELSE a END)) AS folded_root,
       folded_root = root.h AS verified
FROM tree_leaves l LEFT JOIN paths USING (rid)
JOIN top_leaves s ON l.g IS NOT DISTINCT FROM s.lang, (SELECT h FROM top WHERE n = 1) root
"""


@query("op13_merkle_manifest", OP13_SQL)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.verify_documents(read_table(spark, sf_dir, "documents"))


# -------------------------------------------------- importance resampling

def _sql_words(table: str) -> str:
    """(text, word, n): words of every distinct text, only A-Z lower-cased."""
    return f"""
  SELECT text, word, count(*) AS n FROM (
    SELECT text, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
    FROM (SELECT DISTINCT text FROM {table} WHERE text IS NOT NULL)) GROUP BY ALL"""


OP12_SQL = f"""
WITH remainders AS (SELECT {_crc_remainders()} AS t),
corpus AS ({_sql_words("documents")}),
aim AS ({_sql_words("benchmark")}),
bytes AS (SELECT word, list_transform(range(0, length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT) AS b
          FROM (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM corpus UNION SELECT word FROM aim))),
crcs AS (SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, b),
                          lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295::BIGINT) % 10000 AS bucket
         FROM bytes, remainders),
source AS (SELECT bucket, sum(n * copies)::DOUBLE AS s FROM corpus JOIN crcs USING (word)
           JOIN (SELECT text, count(*) AS copies FROM documents GROUP BY text) USING (text) GROUP BY bucket),
target AS (SELECT bucket, sum(n * copies)::DOUBLE AS t FROM aim JOIN crcs USING (word)
           JOIN (SELECT text, count(*) AS copies FROM benchmark GROUP BY text) USING (text) GROUP BY bucket),
totals AS (SELECT coalesce((SELECT sum(s) FROM source), 0) AS s_all, coalesce((SELECT sum(t) FROM target), 0) AS t_all),
gains AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1) * (s_all + 10000) / ((coalesce(s, 0) + 1) * (t_all + 10000))))::BIGINT
            AS gain FROM source FULL JOIN target USING (bucket), totals),
sums AS (SELECT text, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS gain
         FROM corpus JOIN crcs USING (word) JOIN gains USING (bucket) GROUP BY text),
scored AS (
  SELECT doc_id, n_features, weight,
         weight + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
                                        / 4294967296::DOUBLE)))::BIGINT AS score
  FROM (SELECT doc_id, coalesce(n_features, 0) AS n_features,
               CASE WHEN coalesce(n_features, 0) = 0 THEN 0
                    ELSE (gain - ((gain % n_features) + n_features) % n_features) // n_features END AS weight
        FROM documents LEFT JOIN sums USING (text))),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS FIRST) AS place,
                  (count(*) FILTER (n_features >= 20) OVER ()) * 10 // 100 AS drawn FROM scored)
SELECT doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight, score::BIGINT AS score,
       CASE WHEN n_features >= 20 AND place <= drawn THEN place END AS rank FROM ranked
"""


@query("op12_importance_resampling", OP12_SQL)
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"),
                      n=1, buckets=10000, min_words=20, share=(10, 100), seed=2024)
