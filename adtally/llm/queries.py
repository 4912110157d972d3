"""The registered queries of this subpackage and, where SQL can say the same, their twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import configure, scratch_path
from . import archives, chains, chat, decontaminate, jaccard, manifest, mixing, negatives, neighbours, passages, quality, rules, shards

Plan = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Plan] = {}
ORACLE: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _query(plan: Plan) -> Plan:
    QUERIES[plan.__name__] = lambda spark, sf_dir: plan(configure(spark), sf_dir)
    return plan


@_query
def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings, formatted and read back."""
    planted = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    done = chat.format_chat(turns).withColumns({"formatted": chat.formatted(F.col("segments")),
                                                "loss": chat.loss_text(F.col("segments"))})
    back = done.withColumn("turns", chat.read_back(F.col("formatted")))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
                       F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       F.length("formatted").cast("bigint").alias("formatted_chars"), "n_blocks")


# Marks: one text segment per turn; [NEXT] between turns of a role, else the closing mark, the
# opening one, the role's name and a line feed.
ORACLE["op1_chat_formatting"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') r, coalesce(text, '') x FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
w AS (
  SELECT *, lag(r) OVER o before, lead(r) OVER o IS NULL AS ends,
         row_number() OVER o AS n,
         length(regexp_replace(x, '([<\[])(\\*)(/?s>|/?INST\]|NEXT\]|NL\])', '\1\\\2\3', 'g')) e,
         CASE r WHEN 'assistant' THEN 3 ELSE 6 END + length(r) + 1 opened,
         CASE r WHEN 'assistant' THEN 4 ELSE 7 END closed
  FROM t WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r, x))
SELECT conv_id, count(*) n_turns, sha256(string_agg(r || chr(10) || x || chr(10), '' ORDER BY n)) turns_sha256,
       coalesce(sum(length(x)) FILTER (r = 'assistant'), 0)::BIGINT loss_chars,
       sha256(coalesce(string_agg(x, '' ORDER BY n) FILTER (r = 'assistant'), '')) loss_sha256,
       sum(e + CASE WHEN before = r THEN 6 ELSE opened + closed END)::BIGINT formatted_chars,
       sum(CASE WHEN before = r THEN 0 ELSE 1 END)::BIGINT n_blocks
FROM w GROUP BY conv_id"""


@_query
def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to 150 % of their words, weights 3, 1, 2 in turn, at most twice each."""
    return mixing.mix(_table(spark, sf_dir, "documents")).drop("blocks")


@_query
def op9_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards, and where each would be with 41."""
    return shards.shard_documents(_table(spark, sf_dir, "documents"), 40)


@_query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against 13-word windows of the benchmark."""
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        decontaminate.items_digest(F.col("items")).alias("items_sha256"), "contaminated")


ORACLE["op2_decontamination"] = r"""
WITH lowered AS (
  SELECT 'd' side, doc_id id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') x FROM documents
  UNION ALL SELECT 'b', item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
split AS (SELECT side, id, regexp_extract_all(coalesce(x, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws FROM lowered),
windows AS (
  SELECT DISTINCT id item, least(13, len(ws)) size, array_to_string(ws[i:i + least(13, len(ws)) - 1], ' ') win
  FROM (SELECT id, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) i FROM split WHERE side = 'b' AND len(ws) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT id, size, i, array_to_string(ws[i:i + size - 1], ' ') win
  FROM (SELECT id, ws, size, unnest(range(1, len(ws) - size + 2)) i FROM split, sizes WHERE side = 'd' AND len(ws) >= size)),
hits AS (SELECT p.id, p.i, p.size, w.item FROM places p JOIN windows w USING (size, win)),
words AS (SELECT id, count(DISTINCT p) n_hit FROM (SELECT id, unnest(range(i, i + size)) p FROM hits) GROUP BY id),
items AS (SELECT id, count(*) n_items, string_agg(item, ',' ORDER BY item) list
          FROM (SELECT DISTINCT id, CAST(item AS VARCHAR) item FROM hits) GROUP BY id)
SELECT s.id doc_id, len(ws)::BIGINT n_words, coalesce(n_hit, 0)::BIGINT n_hit, coalesce(n_items, 0)::BIGINT n_items,
       sha256(coalesce(list, '')) items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) contaminated
FROM split s LEFT JOIN words USING (id) LEFT JOIN items USING (id) WHERE side = 'd'"""


@_query
def op3_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages through ARC and WARC files, equal payloads stored once."""
    return archives.pages_through_warc(_table(spark, sf_dir, "pages"), scratch_path(spark, "warc")).drop("url")


# Base32: of every five hex digits, four groups of five bits.
ORACLE["op3_arc_to_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') x FROM pages),
h AS (
  SELECT page_id, strlen(x) n, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (('0x' || substr(sha1(x), (i // 4 * 5 + 1)::INTEGER, 5))::BIGINT // [32768, 1024, 32, 1][i % 4 + 1] % 32 + 1)::INTEGER, 1)), '') digest
  FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) first FROM h)
SELECT page_id, n payload_bytes, digest payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END record_type,
       CASE WHEN page_id <> first THEN first END refers_to FROM f"""


@_query
def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents by shingle similarity of 0.85 and more."""
    return jaccard.linked_documents(_table(spark, sf_dir, "documents"))


ORACLE["op5_ngram_jaccard"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') g
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) i FROM w WHERE len(ws) > 0)),
n AS (SELECT w.doc_id, count(g) n_shingles FROM w LEFT JOIN s USING (doc_id) GROUP BY 1),
meet AS (SELECT a.doc_id x, b.doc_id y, count(*) c FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM meet JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
          WHERE 100 * c >= 85 * (p.n_shingles + q.n_shingles - c)),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least_ AS (SELECT x doc_id, min(y) y FROM reach GROUP BY 1)
SELECT doc_id, n_shingles, least(doc_id, coalesce(y, doc_id)) component_id FROM n LEFT JOIN least_ USING (doc_id)"""


@_query
def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the class of those that repeat passages of 50 words and more."""
    return passages.repeated_passages(_table(spark, sf_dir, "documents")).drop("spans")


@_query
def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every 20th vector."""
    vectors = _table(spark, sf_dir, "embeddings")
    return neighbours.nearest_neighbours(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


@_query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a network fitted on labelled ones that are not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality.train(docs, _table(spark, sf_dir, "labels")))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted")


CATEGORIES = ["unfit", "toxic"]


def toxicity(docs: DataFrame, labels: DataFrame, whole: bool = False) -> tuple[DataFrame, float]:
    """Documents with the chain's probabilities, of low quality first, then of being toxic, and the bound from which they are toxic.

    The bound comes from out-of-fold scores of the sample; held-out rows have no part in it.
    """
    marked = labels.select("doc_id", (1 - F.col("quality")).alias("unfit"), "toxic")
    models = chains.train(docs, marked, CATEGORIES)
    return chains.score(docs, models, CATEGORIES, whole=whole), models[-1].bound


@_query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the probabilities of a classifier chain and its verdict."""
    scored, bound = toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", F.col("unfit").alias("unfit_score"), F.col("toxic").alias("toxic_score"),
                         (F.col("toxic") >= bound).cast("int").alias("predicted"))


@_query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Merkle manifest of all documents, checked against rows of which a third lost their capitals."""
    docs = _table(spark, sf_dir, "documents")
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return manifest.manifest(docs, changed={"text": F.when(hit, lowered).otherwise(F.col("text"))})


def _level_sql(name: str, number: int) -> str:
    """Nodes of the next level and, per node of this one, its siblings."""
    now, after = f"{name}{number}", f"{name}{number + 1}"
    return f"""{after} AS (
  SELECT tree, pos // 8 pos, (max(nodes) + 7) // 8 nodes, sha256(string_agg(digest, '' ORDER BY pos)) digest FROM {now} WHERE nodes > 1 GROUP BY ALL
  UNION ALL SELECT * FROM {now} WHERE nodes = 1),
{now}_beside AS (
  SELECT a.tree, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') l,
         coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') r
  FROM {now} a JOIN {now} b ON a.tree = b.tree AND a.pos // 8 = b.pos // 8 WHERE a.nodes > 1 GROUP BY ALL)"""


def _folded_sql(name: str, levels: int, rows: str, place: str) -> str:
    """``rows`` (tree, proof, digest ...) led up ``levels`` of a tree, one nested query per level."""
    for i in range(levels):
        rows = f"""(SELECT x.* REPLACE (proof || coalesce(l || r, '') AS proof, CASE WHEN l IS NULL THEN digest ELSE sha256(l || digest || r) END AS digest)
 FROM {rows} x LEFT JOIN {name}{i}_beside s ON s.tree = x.{place[0]} AND s.pos = x.{place[1:]} // {8 ** i})"""
    return rows


_LEVELS, _UPPER = 11, 5  # 8 ^ 11 rows of a language and 8 ^ 5 languages
ORACLE["op12_merkle_manifest"] = f"""
WITH RECURSIVE bits AS (
  SELECT range n, range c, 0 k FROM range(256)
  UNION ALL SELECT n, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY n) t FROM bits WHERE k = 8),
marked AS (
  SELECT *, coalesce(xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: ascii(d)::BIGINT)),
                                     lambda a, b: xor(a // 256, t[xor(a, b) % 256 + 1])), 4294967295) % 3 = 0, FALSE) hit
  FROM documents, crc),
named AS (
  SELECT doc_id, lang, concat_ws('', coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                   coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')) head,
         text, CASE WHEN hit THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END now FROM marked),
hashed AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) leaf, sha256(head || coalesce(strlen(now) || ':' || now, '-')) seen FROM named),
trees AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 tree, count(*) OVER () n FROM (SELECT DISTINCT lang FROM hashed)),
placed AS (
  SELECT tree t, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 p, count(*) OVER (PARTITION BY tree) nodes, 0 z, h.*
  FROM hashed h JOIN trees ON h.lang IS NOT DISTINCT FROM trees.lang),
n0 AS (SELECT t tree, p pos, nodes, leaf digest FROM placed),
{", ".join(_level_sql("n", i) for i in range(_LEVELS))},
m0 AS (SELECT 0 tree, n{_LEVELS}.tree pos, n nodes, digest FROM n{_LEVELS} JOIN trees ON trees.tree = n{_LEVELS}.tree),
{", ".join(_level_sql("m", i) for i in range(_UPPER))},
started AS (SELECT *, '' proof, seen digest FROM placed),
lower_ AS (SELECT * FROM {_folded_sql("n", _LEVELS, "started", "tp")}),
done AS (SELECT * FROM {_folded_sql("m", _UPPER, "lower_", "zt")})
SELECT doc_id, leaf, s.digest subroot, r.digest root, sha256(proof) proof_sha256, d.digest folded_root, d.digest = r.digest verified
FROM done d JOIN n{_LEVELS} s ON s.tree = d.t CROSS JOIN m{_UPPER} r"""


@_query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; the label of every seventh is moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=moved)


ORACLE["op13_hard_negatives"] = """
WITH v AS (
  SELECT row_number() OVER () r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END l,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(256 * x::DOUBLE))) = 0),
s AS (
  SELECT a.r, a.vec_id anchor_id, b.r other, b.vec_id, a.l = b.l same,
         list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i]))::BIGINT score
  FROM v a JOIN v b ON a.r <> b.r AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.anchor_id, p.vec_id positive_id, s.vec_id negative_id, p.score positive_score, s.score negative_score,
         row_number() OVER (PARTITION BY p.r, p.other ORDER BY s.score DESC, s.vec_id) n
  FROM p JOIN s ON s.r = p.r AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT anchor_id, positive_id, n::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE n <= 5"""


@_query
def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents judged by fixed rules and by trees fitted on labelled ones that are not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = rules.score(docs, rules.train(docs, _table(spark, sf_dir, "labels")))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")
