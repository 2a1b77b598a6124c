"""Training-corpus pipeline over ``documents``, stage by stage:

1. quality: the factorisation machine's rejects go;
2. toxicity: what the clause grammar finds toxic goes;
3. near_dedup: of each group of near duplicates the least doc_id's row stays;
4. decontaminate: benchmark passages are cut out of the texts (a document that
   is nothing else goes); n_chars follows the text;
5. tokenise: ids by byte-level BPE, with the digests of ids and decoded bytes.

``run`` applies them to the documents of a folder, each on all that the stage
before kept. Between stages the rows are a Parquet table in the shared folder
(``spark.checkpoint.dir``), so a lost executor costs a stage's tasks at most.
All but the last stage return the columns that they were given. Null texts are
empty. near_dedup goes by rows: those without doc_id come last in their group,
rows that share a doc_id stay if their texts aren't near each other. No SQL can
say what stages 1 and 2 decide.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pmflow.llm import decontaminate as contamination
from pmflow.llm import minhash, tokenizer, toxicity
from pmflow.llm import quality as quality_model
from pmflow.llm.common import column, documents, materialise

ORACLE_SQL = None


def _plain(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select(*[column(c) for c in docs.columns])


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model predicts to be good."""
    model = quality_model.train(docs, _labels(spark, sf_dir))
    scored = quality_model.score(docs, model, out="_quality")
    return _plain(scored.where(F.col("_quality") >= quality_model.THRESHOLD), docs)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar doesn't predict to be toxic."""
    grammar = toxicity.learn(docs, _labels(spark, sf_dir))
    scored = toxicity.score(docs, grammar, out="_toxicity")
    return _plain(scored.where(F.col("_toxicity") < toxicity.THRESHOLD), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: rows are told apart by a
    number of their own, so only those go whose text is near another's."""
    row = F.struct(column("doc_id").isNull().alias("none"), column("doc_id").alias("id"),
                   F.monotonically_increasing_id().alias("at"))
    rows = materialise(docs.withColumn("_row", row), "rows")
    found = minhash.near_duplicates(rows.select("_row", "text"), "_row")
    gone = materialise(found.where("not kept").select(F.col("_row.at").alias("at")), "gone")
    return _plain(rows.withColumn("at", F.col("_row.at")).join(gone, "at", "left_anti"), docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the benchmark's passages."""
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = contamination.find_contamination(docs, bench, clean=True)
    hit = F.col("n_hit") > 0
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        found = found.withColumn("n_chars", F.when(hit, F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))
    return _plain(found.where(~hit | (F.col("n_hit") < F.col("n_words"))), docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, with digests; the text stays beside them."""
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = tokenizer.encode(docs, vocabulary, public_tokenizers.PATTERN, keep_text=True)
    coded = tokenizer.decode(coded, vocabulary, public_tokenizers.PATTERN)
    return coded.select(
        *[column(c) for c in docs.columns], tokenizer.n_tokens().alias("n_tokens"),
        tokenizer.sha256("ids").alias("ids_sha256"), tokenizer.sha256("decoded").alias("decoded_sha256"))


STAGES = [("quality", quality), ("toxicity", toxic), ("near_dedup", near_dedup),
          ("decontaminate", decontaminate), ("tokenise", tokenise)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages' result for the documents of ``sf_dir``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
