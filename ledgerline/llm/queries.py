"""One registered query per operator, and the corpus pipeline.

Each takes (spark, sf_dir), applies its operator with production parameters
to the whole table and returns the full result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (ann, decontaminate, html_text, langid, license_scan, lm_score, merkle, near_dedup, packing, pii,
                            secret_scan, spelling, token_count)
from ledgerline.llm.common import read, spans_text

PACKING_TOKENIZER = "word_bpe_49k.json"
PIECE_VOCABULARY = "byte_bpe_50k.tiktoken"


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read(spark, sf_dir, "documents"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"), near_dedup.Rule(width=3, percent=85))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path(PACKING_TOKENIZER))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages"))


def _digest(spans: Column, base: tuple[str, ...]) -> list[Column]:
    """Counts of the ``base`` kinds, the digest of their spans, and all spans as text."""
    of_base = F.filter(spans, lambda s: s["kind"].isin(*base))

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return [*map(count, base), F.sha2(spans_text(of_base).cast("binary"), 256).alias("base_sha256"), spans_text(spans).alias("spans")]


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(read(spark, sf_dir, "documents"))
    return found.select("doc_id", *_digest(F.col("findings"), secret_scan.BASE))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read(spark, sf_dir, "documents"))


def op7_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_VOCABULARY))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.containment_pairs(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read(spark, sf_dir, "embeddings"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan(read(spark, sf_dir, "documents"))
    return found.select("doc_id", *_digest(F.col("spans"), pii.BASE))


def op11_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(read(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.without_line_ends(read(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_license_scan, op2_near_dedup, op3_packing, op4_html_text, op5_secret_scan, op6_language_id, op7_token_count,
    op8_decontamination, op9_nearest, op10_personal_data, op11_lm_score, op12_merkle_manifest, op13_spelling_variants, pipeline)}

def _crc32_sql(text: str) -> str:
    """DuckDB SQL for the unsigned crc32 of a text's UTF-8 bytes: four bits at
    a time over its hexadecimal digits, the lower four of each byte first."""

    def entry(k: int) -> int:
        for _ in range(4):
            k = k >> 1 ^ (0xEDB88320 if k & 1 else 0)
        return k

    table = [entry(k) for k in range(16)]
    digits = f"hex(encode({text}))"
    nibbles = (f"list_transform(range(len({digits})), lambda k: "
               f"(instr('0123456789ABCDEF', substr({digits}, (xor(k, 1) + 1)::BIGINT, 1)) - 1)::BIGINT)")
    step = f"xor(a >> 4, ({table}::BIGINT[])[(xor(a, b) & 15) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {nibbles}), lambda a, b: {step}), 4294967295)"


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _leaf_sql(text: str) -> str:
    parts = [f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c} END"
             for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(parts)})"


# DuckDB SQL, where SQL can state the whole result.
ORACLE: dict[str, str] = {
    "op8_decontamination": r"""
WITH w AS (SELECT 'd' AS side, doc_id AS id, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
           FROM documents
           UNION ALL
           SELECT 'b', item_id, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') FROM benchmark),
g AS (SELECT DISTINCT side, id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS gram FROM w
      WHERE len(w) >= 5),
i AS (SELECT id AS item_id, gram, count(*) OVER (PARTITION BY id) AS n_item FROM g WHERE side = 'b')
SELECT d.id AS doc_id, item_id, any_value(n_item) AS n_item, count(*) AS n_common, count(*) / any_value(n_item) AS containment
FROM i JOIN g d ON d.side = 'd' AND d.gram = i.gram
GROUP BY d.id, item_id
HAVING count(*) * 100 >= any_value(n_item) * 80
""",
    "op12_merkle_manifest": f"""
WITH RECURSIVE d AS (
  SELECT *, {_leaf_sql("text")} AS leaf, CASE WHEN {_crc32_sql("doc_id::VARCHAR")} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS later
  FROM documents),
leaves AS (
  SELECT doc_id, leaf, {_leaf_sql("later")} AS now, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n FROM d),
lower_nodes(tree, level, idx, n, hash) AS (
  SELECT tree, 0, idx, n, leaf FROM leaves
  UNION ALL
  SELECT tree, level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(hash, '' ORDER BY idx)) FROM lower_nodes WHERE n > 1
  GROUP BY tree, level, n, idx // 3),
subroots AS (SELECT tree, hash AS subroot FROM lower_nodes WHERE n = 1),
upper_nodes(level, idx, n, hash) AS (
  SELECT 0, tree, (SELECT count(*) FROM subroots), subroot FROM subroots
  UNION ALL
  SELECT level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(hash, '' ORDER BY idx)) FROM upper_nodes WHERE n > 1
  GROUP BY level, n, idx // 3),
nodes AS (SELECT tree, level, idx, n, hash FROM lower_nodes UNION ALL SELECT -1, level, idx, n, hash FROM upper_nodes),
siblings AS (
  SELECT tree, level, idx,
         coalesce(string_agg(hash, '') OVER (PARTITION BY tree, level, idx // 3 ORDER BY idx ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(hash, '') OVER (PARTITION BY tree, level, idx // 3 ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING), '') AS r
  FROM nodes WHERE n > 1),
steps AS (
  SELECT a.tree, a.idx, s.level AS k, l, r FROM leaves a JOIN siblings s ON s.tree = a.tree AND s.idx = a.idx // (3 ** s.level)::BIGINT
  UNION ALL
  SELECT a.tree, a.idx, 1000 + s.level, l, r FROM leaves a JOIN siblings s ON s.tree = -1 AND s.idx = a.tree // (3 ** s.level)::BIGINT),
numbered AS (SELECT *, row_number() OVER (PARTITION BY tree, idx ORDER BY k) AS step FROM steps),
folded(tree, idx, step, hash) AS (
  SELECT tree, idx, 0, now FROM leaves
  UNION ALL
  SELECT f.tree, f.idx, f.step + 1, sha256(s.l || f.hash || s.r) FROM folded f JOIN numbered s ON s.tree = f.tree AND s.idx = f.idx AND s.step = f.step + 1),
ends AS (SELECT tree, idx, arg_max(hash, step) AS folded_root FROM folded GROUP BY ALL),
proofs AS (SELECT tree, idx, sha256(string_agg(l || r, '' ORDER BY k)) AS proof FROM steps GROUP BY ALL)
SELECT doc_id, leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN subroots USING (tree) JOIN ends USING (tree, idx) LEFT JOIN proofs USING (tree, idx)
CROSS JOIN (SELECT hash AS root FROM upper_nodes WHERE n = 1)
""",
    "op13_spelling_variants": rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, {_LOWER.format("r")} AS r, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]{{7,}}')) AS r FROM documents) GROUP BY ALL),
hashed AS (SELECT r, n, coalesce({_crc32_sql("(doc_id || ':' || r)")}, 1) AS h FROM runs),
words AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(r, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word, sum(n)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 7 AND sum(n) >= 2),
cuts AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
longer AS (SELECT DISTINCT a.word AS a, b.word AS b, a.n AS a_n, b.n AS b_n FROM words a JOIN cuts b ON a.word = b.rest),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION ALL SELECT a, b, b_n FROM longer UNION ALL SELECT b, a, a_n FROM longer),
best AS (SELECT word, count(*) AS n_near, max(other_n) AS best_n FROM near GROUP BY word),
chosen AS (SELECT near.word, min(near.other) AS other FROM near JOIN best ON best.word = near.word AND near.other_n = best.best_n GROUP BY near.word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * w.n THEN other END AS form, CASE WHEN best_n >= 10 * w.n THEN best_n END AS form_n
  FROM words w LEFT JOIN best USING (word) LEFT JOIN chosen USING (word)),
followed(word, last, step) AS (
  SELECT word, word, 0 FROM forms
  UNION ALL
  SELECT f.word, g.form, step + 1 FROM followed f JOIN forms g ON g.word = f.last WHERE g.form IS NOT NULL)
SELECT forms.word, form, root, n, n_near, form_n FROM forms JOIN (SELECT word, arg_max(last, step) AS root FROM followed GROUP BY word) USING (word)
""",
}
