"""The registered queries of the training-data operators: each applies one
operator, with production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pmflow.llm import (
    decontaminate,
    hnsw,
    html_extract,
    merkle,
    minhash,
    order_minhash,
    quality,
    shards,
    spelling,
    token_counts,
    tokenizer,
    toxicity,
    url_filter,
)
from pmflow.llm.common import documents
from pmflow.session import scratch_path

#: Rules of the registered URL query: verdict, host, path.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
#: The id that the multi-language vocabulary leaves free ends a document.
END_TOKEN = 50256
#: Tokens beyond which a document is over the limit.
TOKEN_LIMIT = 512


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return minhash.near_duplicates(documents(spark, sf_dir))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded bytes of every document, as digests."""
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = documents(spark, sf_dir).select("doc_id", "text")
    coded = tokenizer.encode(docs, vocabulary, public_tokenizers.PATTERN)
    coded = tokenizer.decode(coded, vocabulary, public_tokenizers.PATTERN)
    return coded.select("doc_id", tokenizer.n_tokens().alias("n_tokens"),
                        tokenizer.sha256("ids").alias("ids_sha256"),
                        tokenizer.sha256("decoded").alias("decoded_sha256"))


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return html_extract.extract(pages).select("page_id", "url", "text",
                                              F.char_length("text").cast("long").alias("n_chars"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words and items in every document."""
    found = decontaminate.find_contamination(documents(spark, sf_dir).select("doc_id", "text"),
                                             spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every document."""
    counts = token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
                                       public_tokenizers.PATTERN)
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op6_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as shards of sequences in training order, under the shared
    checkpoint folder: one row per sequence."""
    return shards.write_shards(documents(spark, sf_dir), scratch_path(spark, "shards"),
                               public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
                               END_TOKEN)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    judged = toxicity.judge(documents(spark, sf_dir).select("doc_id", "text"),
                            spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged.select("doc_id", "held_out", "score", "predicted")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    judged = quality.judge(documents(spark, sf_dir).select("doc_id", "text", "n_chars"),
                           spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged.select("doc_id", "held_out", "score", "predicted")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    values = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS rules(verdict, host, path)")
    return url_filter.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules)


def op10_hnsw_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest vectors of every twentieth one."""
    return hnsw.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, proof and root, and the root that a tampered leaf folds to."""
    def text(n_chars):
        return F.concat(merkle.field(F.col("doc_id")), merkle.field(F.col("source")), merkle.field(F.col("lang")),
                        merkle.field(n_chars), merkle.field(F.col("text")))

    n = F.col("n_chars")
    tampered = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & n.isNotNull()
    rows = merkle.verify(documents(spark, sf_dir), "doc_id", "lang", text(n),
                         F.when(tampered, text(n.cast("decimal(38,0)") + 1)))
    return rows.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root",
                       F.sha2(F.col("proof").cast("binary"), 256).alias("proof_sha256"),
                       F.col("folded").alias("folded_root"), "verified")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, some misspelt on purpose, with the form that each goes by."""
    words = spelling.count_words(documents(spark, sf_dir), misspell_every=199)
    return spelling.group_variants(words).select("word", "form", "root", "n", "n_near", "form_n")


def op13_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    found = order_minhash.edited(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        F.col("key").alias("doc_id"), F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        order_minhash.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        order_minhash.likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"), "next_key")


QUERIES = {f.__name__: f for f in (
    op1_minhash_dedup, op2_byte_bpe, op3_html_extract, op4_decontaminate, op5_token_counts,
    op6_token_shards, op7_toxicity, op8_quality, op9_url_filter, op10_hnsw_search,
    op11_merkle_manifest, op12_spelling_variants, op13_order_minhash)}

def _crc32(text: str) -> str:
    """DuckDB expression: unsigned crc32 of a text's UTF-8 bytes."""
    bit = "xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)"  # fixed value: the CRC-32 polynomial
    step = "xor(a, b)"
    for _ in range(8):
        step = f"list_transform([{step}], lambda x: {bit})[1]"
    digits = f"hex(encode({text}))"
    data = (f"list_transform(range(1, strlen({digits}) // 2 + 1), "
            f"lambda i: CAST('0x' || substr({digits}, 2 * i - 1, 2) AS BIGINT))")
    return f"xor(list_reduce(list_prepend(4294967295, {data}), lambda a, b: {step}), 4294967295)"


def _leaf(n_chars: str) -> str:
    """DuckDB expression: a document's leaf."""
    return "sha256(" + " || ".join(
        f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
        for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


ORACLE: dict[str, str] = {
    "op4_decontaminate": r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
grams AS (
  SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM docs, (SELECT DISTINCT n FROM windows) AS k, unnest(range(1, len(w) - n + 2)) AS t(i)),
found AS (SELECT r, i, grams.n, item FROM grams JOIN windows ON grams.n = windows.n AND grams.win = windows.win),
hits AS (SELECT r, count(DISTINCT p) AS n_hit FROM found, unnest(range(i, i + n)) AS t(p) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits ON docs.r = hits.r LEFT JOIN named ON docs.r = named.r
""",
    "op9_url_filter": """
WITH parts AS (
  SELECT row_number() OVER () AS r, page_id,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(verdict, rhost, rpath) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fits AS (
  SELECT r, rhost || rpath AS rule, verdict,
         row_number() OVER (PARTITION BY r ORDER BY length(rhost || rpath) DESC, verdict DESC, rhost || rpath) AS k
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN fits ON parts.r = fits.r AND k = 1
""",
    "op11_merkle_manifest": f"""
WITH RECURSIVE rows_ AS (
  SELECT doc_id, lang, {_leaf('n_chars')} AS leaf,
         CASE WHEN n_chars IS NOT NULL AND {_crc32('CAST(doc_id AS VARCHAR)')} % 7 = 0
              THEN {_leaf('(n_chars + 1)')} END AS changed
  FROM documents),
leaves AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         row_number() OVER () AS r
  FROM rows_),
low AS (
  SELECT tree, 0 AS level, pos, leaf AS hash, count(*) OVER (PARTITION BY tree) AS n FROM leaves
  UNION ALL
  SELECT tree, level + 1, pos // 2, sha256(string_agg(hash, '' ORDER BY pos)), (n + 1) // 2
  FROM low WHERE n > 1 GROUP BY tree, level, pos // 2, n),
top AS (
  SELECT -1 AS tree, 0 AS level, tree AS pos, hash, count(*) OVER () AS n FROM low WHERE n = 1
  UNION ALL
  SELECT tree, level + 1, pos // 2, sha256(string_agg(hash, '' ORDER BY pos)), (n + 1) // 2
  FROM top WHERE n > 1 GROUP BY tree, level, pos // 2, n),
nodes AS (SELECT * FROM low UNION ALL SELECT * FROM top),
climb AS (
  SELECT r, tree, 0 AS level, pos, '' AS proof, coalesce(changed, leaf) AS folded FROM leaves
  UNION ALL
  SELECT r, CASE WHEN m.n = 1 THEN -1 ELSE c.tree END, CASE WHEN m.n = 1 THEN 0 ELSE c.level + 1 END,
         CASE WHEN m.n = 1 THEN c.tree ELSE c.pos // 2 END, proof || coalesce(s.hash, ''),
         CASE WHEN m.n = 1 THEN folded WHEN s.hash IS NULL THEN sha256(folded)
              WHEN c.pos % 2 = 1 THEN sha256(s.hash || folded) ELSE sha256(folded || s.hash) END
  FROM climb c JOIN nodes m ON c.tree = m.tree AND c.level = m.level AND c.pos = m.pos
  LEFT JOIN nodes s ON c.tree = s.tree AND c.level = s.level AND xor(c.pos, 1) = s.pos
  WHERE c.tree >= 0 OR m.n > 1)
SELECT doc_id, leaf, u.hash AS subroot, t.hash AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
       folded = t.hash AS verified
FROM leaves JOIN low u ON leaves.tree = u.tree AND u.n = 1 JOIN top t ON t.n = 1
JOIN climb c ON leaves.r = c.r AND c.tree = -1 AND c.level = t.level
""",
    "op12_spelling_variants": f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
  FROM documents),
own AS (
  SELECT run, count(*) AS n, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS label
  FROM runs WHERE length(run) >= 6 GROUP BY doc_id, run),
hashed AS (SELECT run, n, {_crc32('label')} AS h FROM own),
words AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
         CAST(sum(n) AS BIGINT) AS n
  FROM hashed GROUP BY 1 HAVING sum(n) >= 5 AND length(word) >= 6),
less AS (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest
  FROM words, unnest(range(1, length(word) + 1)) AS t(i)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word != b.word),
best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS top FROM near GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 5 * w.n THEN top END AS form_n,
         (SELECT min(other) FROM near WHERE near.word = w.word AND other_n = top AND top >= 5 * w.n) AS form
  FROM words w LEFT JOIN best ON w.word = best.word),
way AS (
  SELECT word, word AS root FROM forms
  UNION ALL SELECT way.word, form FROM way JOIN forms ON way.root = forms.word AND form IS NOT NULL)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n
FROM forms f JOIN way r ON f.word = r.word JOIN forms e ON r.root = e.word AND e.form IS NULL
""",
}
