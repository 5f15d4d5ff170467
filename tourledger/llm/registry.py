"""The queries of the training-data operators and, where SQL can say it, their results in SQL."""

from __future__ import annotations

import os
import sys
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tourledger.llm.chat import formatted_conversations
from tourledger.llm.common import pick, table
from tourledger.llm.decontamination import contamination
from tourledger.llm.hidden_markov import language_model_scores
from tourledger.llm.language_id import languages
from tourledger.llm.manifest import document_manifest, folded, siblings
from tourledger.llm.mixing import mix_sources
from tourledger.llm.near_dedup import near_duplicates
from tourledger.llm.piece_encoding import decoded, encoded
from tourledger.llm.spelling import spelling_variants
from tourledger.llm.substring_dedup import repeat_digests
from tourledger.llm.topk import top_k
from tourledger.llm.toxicity import toxicity
from tourledger.llm.warc import archived_pages

ROOT = Path(__file__).resolve().parents[2]


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formatted_conversations(table(spark, sf_dir, "conversations"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(table(spark, sf_dir, "documents"), "doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(table(spark, sf_dir, "pages"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model_scores(table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digests(table(spark, sf_dir, "documents"))


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = document_manifest(table(spark, sf_dir, "documents"))
    root = folded(F.coalesce("changed", "leaf"), F.col("path"))
    rows = rows.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"), root.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    tokens = encoded(table(spark, sf_dir, "documents"), path, ["doc_id"])
    tokens = tokens.withColumn("ids_sha256", F.sha2("ids", 256))
    texts = decoded(tokens, path, ["doc_id", "n_tokens", "ids_sha256"])
    return texts.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


_QUERIES = (
    op1_chat_formatting, op2_source_mixing, op3_decontamination, op4_near_duplicates, op5_warc, op6_toxicity,
    op7_language_model, op8_substring_dedup, op9_top_k, op10_language_id, op11_spelling_variants, op12_manifest, op13_sentencepiece,
)


def _ship(spark: SparkSession) -> None:
    """Let Python workers import the package where neither their path nor their folder has it."""
    if os.getcwd() == str(ROOT) or str(ROOT) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    done = f"{ROOT.name}-{spark.sparkContext.applicationId}.zip"
    if any(path.endswith(done) for path in sys.path):
        return
    path = Path(tempfile.mkdtemp()) / done
    with zipfile.ZipFile(path, "w") as archive:
        for file in [*ROOT.glob("tourledger/**/*.py"), ROOT / "corpus_pipeline.py"]:
            archive.write(file, file.relative_to(ROOT))
    spark.sparkContext.addPyFile(str(path))


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _ship(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: _shipped(query) for query in _QUERIES} | {"pipeline": _shipped(corpus_pipeline.run)}


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), marked AS (
  SELECT *, replace(replace(role, '\', '\\'), chr(10), '\n') AS plain_role FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum(24 + length(regexp_replace(plain_role, '<(\\*)\|', '<\1\\|', 'g')) + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g'))) AS BIGINT) AS formatted_chars,
  CAST(0 AS BIGINT) AS rewrites
FROM marked GROUP BY conv_id
"""

MIXING = r"""
WITH rows AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
), entries AS (
  SELECT doc_id, source, size, count(*) AS copies,
    md5('1|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || CAST(size AS VARCHAR)) AS ord
  FROM rows GROUP BY doc_id, source, size
), many AS (SELECT CAST(greatest(1, ceil(count(*) / 20000.0)) AS BIGINT) AS shards FROM entries),
dealt AS (SELECT e.*, CAST('0x' || substr(ord, 1, 8) AS BIGINT) % shards AS shard FROM entries e, many),
shards AS (SELECT source, shard, CAST(sum(size * copies) AS BIGINT) AS shard_size FROM dealt GROUP BY source, shard),
sizes AS (SELECT source, CAST(sum(shard_size) AS BIGINT) AS source_size FROM shards GROUP BY source),
weighted AS (SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS w, sum(source_size) OVER () AS total FROM sizes),
ordered AS (SELECT *, source_size * 3.0 AS cap, row_number() OVER (ORDER BY source_size * 3.0 / w, source NULLS LAST) AS k FROM weighted),
levels AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM ordered
), targets AS (SELECT source, source_size, total, least(cap, w * max(level) OVER ()) AS target FROM levels),
source_quotients AS (
  SELECT source, target / (2 * k - 1) AS q, k FROM (
    SELECT source, target, unnest(range(1, CAST(ceil(source_size * 3 / 16.0) AS BIGINT) + 1)) AS k FROM targets WHERE target > 0)
), source_won AS (
  SELECT source, count(*) AS seats FROM (
    SELECT source, row_number() OVER (ORDER BY q DESC, source NULLS LAST, k) AS r FROM source_quotients)
  WHERE r <= (SELECT floor(max(total) / 16) FROM targets) GROUP BY source
), quotas AS (
  SELECT s.source, s.shard, s.shard_size, t.source_size, t.target, coalesce(w.seats, 0) AS seats
  FROM shards s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source LEFT JOIN source_won w ON w.source IS NOT DISTINCT FROM s.source
), shard_quotients AS (
  SELECT source, shard, seats, shard_size / (2.0 * k - 1) AS q, k FROM (
    SELECT source, shard, seats, shard_size, unnest(range(1, CAST(ceil(shard_size * 3 / 16.0) AS BIGINT) + 1)) AS k FROM quotas)
), shard_won AS (
  SELECT source, shard, count(*) AS quota FROM (
    SELECT source, shard, seats, row_number() OVER (PARTITION BY source ORDER BY q DESC, shard, k) AS r FROM shard_quotients)
  WHERE r <= seats GROUP BY source, shard
), turns AS (
  SELECT q.*, CAST(least(coalesce(w.quota, 0) * 16, q.shard_size * 3) AS BIGINT) AS tokens,
    CAST('0x' || substr(md5('start 1|' || coalesce(q.source, '') || '|' || CAST(q.shard AS VARCHAR)), 1, 8) AS BIGINT)
      % CAST(greatest(1, floor(q.shard_size / 16.0)) AS BIGINT) * 16 AS run_start
  FROM quotas q LEFT JOIN shard_won w ON w.source IS NOT DISTINCT FROM q.source AND w.shard = q.shard
), placed AS (
  SELECT d.*, CAST(coalesce(sum(size * copies) OVER (PARTITION BY source, shard ORDER BY ord, doc_id NULLS FIRST, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS begin_at FROM dealt d
), copied AS (
  SELECT *, begin_at + (unnest(range(1, copies + 1)) - 1) * size AS place FROM placed
)
SELECT c.doc_id, c.size, t.source_size, t.target,
  CAST(tokens // greatest(shard_size, 1) * size
    + greatest(0, least(place + size, least(run_start + tokens % greatest(shard_size, 1), shard_size)) - greatest(place, run_start))
    + greatest(0, least(place + size, greatest(0, run_start + tokens % greatest(shard_size, 1) - shard_size)) - greatest(place, 0)) AS BIGINT) AS taken
FROM copied c JOIN turns t ON c.source IS NOT DISTINCT FROM t.source AND c.shard = t.shard
"""

DECONTAMINATION = f"""
WITH items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(list_slice(w, k, k + least(13, len(w)) - 1), ' ') AS win
  FROM (SELECT item, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS k FROM items WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM windows),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
places AS (
  SELECT r, n, k, array_to_string(list_slice(w, k, k + n - 1), ' ') AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM docs, sizes WHERE len(w) >= n)
), hits AS (SELECT r, k, p.n, item FROM places p JOIN windows w ON p.win = w.win AND p.n = w.n),
covered AS (SELECT r, count(DISTINCT word) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS word FROM hits) GROUP BY r),
found AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN found USING (r)
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
f AS (SELECT html, max(page_id) AS first FROM p WHERE n >= 1000 GROUP BY html HAVING count(*) > 1)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(p.html) AS payload_digest,
  CASE WHEN first IS NOT NULL AND first IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.html = f.html
"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT DISTINCT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
), ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

# CRC32 by the table of its remainders, a byte at a time.
_CRC_TABLE = """(SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)),
  lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS remainders)"""
_CRC = "xor(list_reduce(list_prepend(4294967295, {}), lambda c, b: xor(c >> 8, remainders[(xor(c, b) & 255) + 1])), 4294967295)"
_DIGITS = "list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), ''), ''), lambda x: CAST(ord(x) AS BIGINT))"


def _field_sql(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(map(_field_sql, ["doc_id", "source", "lang", "n_chars", text])) + ")"


def _tree_sql(name: str, levels: int) -> str:
    """From NAME0 (tree, slot, d, n) the nodes of each level, and the runs under each parent."""
    steps = []
    for k in range(levels):
        steps.append(f"""{name}_runs{k} AS (
  SELECT tree, slot // 8 AS parent, any_value(n) AS n, list(d ORDER BY slot) AS ds FROM {name}{k} GROUP BY tree, slot // 8
), {name}{k + 1} AS (
  SELECT tree, parent AS slot, CASE WHEN n > 1 THEN sha256(array_to_string(ds, '')) ELSE ds[1] END AS d, (n + 7) // 8 AS n FROM {name}_runs{k}
)""")
    return ", ".join(steps)


def _path_sql(name: str, before: str, levels: int) -> str:
    """From BEFORE (r, tree, s, f, proof) up the levels of a tree: what is folded, and the siblings."""
    steps = []
    for k in range(levels):
        low, high = "coalesce(array_to_string(ds[1:s % 8], ''), '')", "coalesce(array_to_string(ds[s % 8 + 2:], ''), '')"
        steps.append(f"""{name}_paths{k + 1} AS (
  SELECT r, p.tree, s // 8 AS s, CASE WHEN n > 1 THEN sha256({low} || f || {high}) ELSE f END AS f,
    CASE WHEN n > 1 THEN proof || {low} || {high} ELSE proof END AS proof
  FROM {before if k == 0 else f"{name}_paths{k}"} p JOIN {name}_runs{k} q ON p.tree = q.tree AND p.s // 8 = q.parent
)""")
    return ", ".join(steps)


_LEVELS = 8
MANIFEST = f"""
WITH crc AS {_CRC_TABLE}, rows AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf_sql("text")} AS leaf,
    CASE WHEN {_CRC.format(_DIGITS)} % 3 = 0 THEN {_leaf_sql(_LOWER.format("text"))} END AS changed
  FROM documents, crc
), leaves AS (
  SELECT *, row_number() OVER () AS r, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, changed) - 1 AS slot FROM rows
), node0 AS (SELECT tree, slot, leaf AS d, count(*) OVER (PARTITION BY tree) AS n FROM leaves), {_tree_sql("node", _LEVELS)},
top AS (SELECT tree AS of, row_number() OVER (ORDER BY tree) - 1 AS slot, d, count(*) OVER () AS n FROM node{_LEVELS}),
lang0 AS (SELECT '' AS tree, slot, d, n FROM top), {_tree_sql("lang", _LEVELS)},
own AS (SELECT r, tree, slot AS s, coalesce(changed, leaf) AS f, '' AS proof FROM leaves), {_path_sql("node", "own", _LEVELS)},
over AS (SELECT r, '' AS tree, slot AS s, f, proof FROM node_paths{_LEVELS} p JOIN top ON p.tree = top.of), {_path_sql("lang", "over", _LEVELS)}
SELECT doc_id, leaf, top.d AS subroot, l.d AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = l.d AS verified
FROM leaves JOIN lang_paths{_LEVELS} p USING (r) JOIN top ON leaves.tree = top.of, lang{_LEVELS} l
"""

_RUN_BYTES = """flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
  lambda x: CASE WHEN ord(x) < 128 THEN [CAST(ord(x) AS BIGINT)] ELSE [CAST(192 + ord(x) // 64 AS BIGINT), CAST(128 + ord(x) % 64 AS BIGINT)] END))"""
SPELLING = f"""
WITH RECURSIVE crc AS {_CRC_TABLE}, runs AS (
  SELECT doc_id, run, count(*) AS c FROM (
    SELECT doc_id, unnest(regexp_extract_all({_LOWER.format("text")}, '[a-zÀ-ÿ]+')) AS run FROM documents)
  GROUP BY doc_id, run
), hashed AS (SELECT run, c, length(run) AS len, {_CRC.format(_RUN_BYTES)} AS h FROM runs, crc WHERE length(run) >= 5),
words AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % len) || substr(run, h % len + 2) ELSE run END AS word, CAST(sum(c) AS BIGINT) AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND sum(c) >= 3
), shorter AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM shorter a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM shorter a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS k FROM near
), found AS (
  SELECT w.word, w.n, CASE WHEN near_n >= 2 * w.n THEN near END AS form, CASE WHEN near_n >= 2 * w.n THEN near_n END AS form_n, coalesce(n_near, 0) AS n_near
  FROM words w LEFT JOIN best b ON w.word = b.word AND k = 1
), chains AS (
  SELECT word, word AS root FROM found
  UNION ALL SELECT c.word, f.form FROM chains c JOIN found f ON c.root = f.word WHERE f.form IS NOT NULL
), roots AS (SELECT c.word, c.root FROM chains c JOIN found f ON c.root = f.word WHERE f.form IS NULL)
SELECT word, n, form, form_n, root, n_near FROM found JOIN roots USING (word)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_chat_formatting": CHAT, "op2_source_mixing": MIXING, "op3_decontamination": DECONTAMINATION, "op5_warc": WARC,
        "op9_top_k": TOP_K, "op11_spelling_variants": SPELLING, "op12_manifest": MANIFEST,
    }
