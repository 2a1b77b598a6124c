"""Market dimension: JSON / parquet normalization (D7, D8), upsert (J7),
and the fixture dimension used by the trade jobs.

Strict JSON typing uses VARIANT: ``parse_json`` once per document, then
``schema_of_variant`` guards so a number never passes where the reference
demands a string (``try_variant_get`` alone would convert 5 -> '5').
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pmflow.functions.exprs import first_nonempty, iso_to_timestamp
from pmflow.functions.taxonomy import topic_of
from pmflow.operators.merge import pick_per_key, upsert

DIM_COLUMNS = ["market_id", "condition_id", "market_slug", "question", "answer1", "answer2", "neg_risk",
               "token1", "token2", "volume", "ticker", "closed_time", "created_at", "category_raw",
               "topic_primary", "fetched_at", "enrich_gamma_fetched_at", "enrich_gamma_failed_at",
               "enrich_gamma_attempts", "enrich_gamma_last_error"]
# Columns an ingest replaces; the rest (category, topic, enrichment state) survive an upsert.
INGEST_COLUMNS = ["condition_id", "market_slug", "question", "answer1", "answer2", "neg_risk", "token1",
                  "token2", "volume", "ticker", "closed_time", "created_at", "fetched_at"]
VOLUME_TYPE = "decimal(38,9)"


def dim_from_categories(markets: DataFrame) -> DataFrame:
    """A minimal dimension (market_id, token1, token2, category_raw, topic_primary)."""
    return markets.select("market_id", "token1", "token2", "category_raw",
                          topic_of(F.col("category_raw")).alias("topic_primary"))


# ---------------------------------------------------------------- JSON

def _vtype(v: Column, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(v, path, "variant"))


def _vstr(v: Column, path: str) -> Column:
    """String value at path only when the JSON value is a string."""
    return F.when(_vtype(v, path) == "STRING", F.try_variant_get(v, path, "string"))


def _vbool(v: Column, path: str) -> Column:
    return F.when(_vtype(v, path) == "BOOLEAN", F.try_variant_get(v, path, "boolean"))


def _vnumeric(v: Column, path: str) -> Column:
    """number or numeric string -> DECIMAL."""
    t = _vtype(v, path)
    num = F.try_variant_get(v, path, VOLUME_TYPE)
    return F.when(t.startswith("DECIMAL") | t.isin("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT")
                  | (t == "STRING"), num)


def _strings(elements: Column) -> Column:
    """The string elements of an array of variants, others left out."""
    return F.transform(F.filter(elements, lambda e: F.schema_of_variant(e) == "STRING"),
                       lambda e: F.try_variant_get(e, "$", "string"))


def _encoded_strings(text: Column) -> Column:
    """A text that holds a JSON array of nothing but strings, else NULL."""
    elements = F.try_variant_get(F.try_parse_json(text), "$", "array<variant>")
    return F.when(F.forall(elements, lambda e: F.schema_of_variant(e) == "STRING"), _strings(elements))


def _varray(v: Column, path: str) -> Column:
    """the strings of a real JSON array, or of a text that holds an array
    of strings only; else []."""
    t = _vtype(v, path)
    real = _strings(F.try_variant_get(v, path, "array<variant>"))
    arr = F.when(F.startswith(t, F.lit("ARRAY")), real).when(t == "STRING", _encoded_strings(_vstr(v, path)))
    return F.coalesce(arr, F.array().cast("array<string>"))


def _ts_from(c: Column) -> Column:
    """F8: RFC3339 text -> TIMESTAMP (UTC) with its fraction, else NULL."""
    return iso_to_timestamp(c)


def explode_market_pages(pages: DataFrame, *, page_col: str = "page") -> DataFrame:
    """Landed API pages (a JSON array of market objects each) -> one
    JSON document per market (``doc``). A page that is not an array yields
    nothing; the page is parsed once and each element re-serialized."""
    arr = F.try_variant_get(F.try_parse_json(F.col(page_col)), "$", "array<variant>")
    order = [c for c in ("source_file", "row_index") if c in pages.columns]
    return pages.select(*order, F.posexplode(arr).alias("pos", "m")).select(F.to_json("m").alias("doc"), *order, "pos")


def normalize_markets_json(docs: DataFrame, *, doc_col: str = "doc", as_of: int) -> DataFrame:
    """One market row per JSON document with a string ``id``.

    ``as_of`` stands for the reference's ``now()`` in fetched_at.
    """
    v = F.try_parse_json(F.col(doc_col))
    order = [c for c in ("source_file", "row_index", "pos") if c in docs.columns]
    d = docs.select(v.alias("v"), *order)
    v = F.col("v")
    outcomes = _varray(v, "$.outcomes")
    tokens = _varray(v, "$.clobTokenIds")
    question = F.coalesce(_vstr(v, "$.question"), _vstr(v, "$.title"), F.lit(""))
    out = d.select(
        _vstr(v, "$.id").alias("market_id"),
        F.coalesce(_vstr(v, "$.conditionId"), F.lit("")).alias("condition_id"),
        F.coalesce(_vstr(v, "$.slug"), F.lit("")).alias("market_slug"),
        question.alias("question"),
        F.coalesce(F.get(outcomes, 0), F.lit("")).alias("answer1"),
        F.coalesce(F.get(outcomes, 1), F.lit("")).alias("answer2"),
        (F.coalesce(_vbool(v, "$.negRiskAugmented"), F.lit(False))
         | F.coalesce(_vbool(v, "$.negRiskOther"), F.lit(False))).alias("neg_risk"),
        F.coalesce(F.get(tokens, 0), F.lit("")).alias("token1"),
        F.coalesce(F.get(tokens, 1), F.lit("")).alias("token2"),
        _vnumeric(v, "$.volume").alias("volume"),
        F.coalesce(_vstr(v, "$.events[0].ticker"), F.lit("")).alias("ticker"),
        _ts_from(_vstr(v, "$.closedTime")).alias("closed_time"),
        _ts_from(_vstr(v, "$.createdAt")).alias("created_at"),
        F.timestamp_seconds(F.lit(as_of)).alias("fetched_at"), *order)
    return out.filter(F.coalesce(F.col("market_id"), F.lit("")) != "")


# ------------------------------------------------------------- parquet

# Column aliases of the raw markets parquet, in preference order.
PARQUET_ALIASES = {
    "id": ["id", "market_id"],
    "conditionId": ["conditionId", "condition_id"],
    "slug": ["slug", "market_slug"],
    "question": ["question", "title"],
    "clobTokenIds": ["clobTokenIds", "clob_token_ids"],
    "negRisk": ["negRiskAugmented", "neg_risk", "negRisk"],
    "closedTime": ["closedTime", "closed_time"],
    "createdAt": ["createdAt", "created_at"],
}


def _text_alias(df: DataFrame, names) -> Column:
    present = [n for n in names if n in df.columns]
    if not present:
        return F.lit(None).cast("string")
    return first_nonempty(*[F.col(n).cast("string") for n in present])


def normalize_markets_parquet(df: DataFrame, *, as_of: int, ref_alias_bug: bool = False) -> DataFrame:
    """Raw markets parquet rows -> market rows (aliases, JSON-text arrays).

    ``ref_alias_bug=True`` reproduces the reference: the boolean aliases are
    consulted only if the first one exists (Q6).
    """
    bool_names = [n for n in PARQUET_ALIASES["negRisk"] if n in df.columns]
    if ref_alias_bug and PARQUET_ALIASES["negRisk"][0] not in df.columns:
        bool_names = []
    neg = F.coalesce(*[F.col(n).cast("boolean") for n in bool_names], F.lit(False)) if bool_names \
        else F.lit(False)
    outcomes = F.coalesce(_encoded_strings(_text_alias(df, ["outcomes"])), F.array().cast("array<string>"))
    tokens = F.coalesce(_encoded_strings(_text_alias(df, PARQUET_ALIASES["clobTokenIds"])),
                        F.array().cast("array<string>"))
    vol = F.col("volume").cast("string").try_cast("double").try_cast(VOLUME_TYPE) \
        if "volume" in df.columns and dict(df.dtypes)["volume"] == "string" else F.lit(None).cast(VOLUME_TYPE)
    out = df.select(
        _text_alias(df, PARQUET_ALIASES["id"]).alias("market_id"),
        F.coalesce(_text_alias(df, PARQUET_ALIASES["conditionId"]), F.lit("")).alias("condition_id"),
        F.coalesce(_text_alias(df, PARQUET_ALIASES["slug"]), F.lit("")).alias("market_slug"),
        F.coalesce(_text_alias(df, PARQUET_ALIASES["question"]), F.lit("")).alias("question"),
        F.coalesce(F.get(outcomes, 0), F.lit("")).alias("answer1"),
        F.coalesce(F.get(outcomes, 1), F.lit("")).alias("answer2"),
        neg.alias("neg_risk"),
        F.coalesce(F.get(tokens, 0), F.lit("")).alias("token1"),
        F.coalesce(F.get(tokens, 1), F.lit("")).alias("token2"),
        vol.alias("volume"),
        F.lit("").alias("ticker"),
        _ts_from(_text_alias(df, PARQUET_ALIASES["closedTime"])).alias("closed_time"),
        _ts_from(_text_alias(df, PARQUET_ALIASES["createdAt"])).alias("created_at"),
        F.timestamp_seconds(F.lit(as_of)).alias("fetched_at"),
        *[c for c in ("source_file", "row_index") if c in df.columns])
    return out.filter(F.coalesce(F.col("market_id"), F.lit("")) != "")


# -------------------------------------------------------------- upsert

def empty_dim_columns(df: DataFrame) -> DataFrame:
    """Add the dimension's enrichment columns (NULL / 0) to normalized rows."""
    defaults = {
        "category_raw": F.lit(None).cast("string"), "topic_primary": F.lit(None).cast("string"),
        "enrich_gamma_fetched_at": F.lit(None).cast("timestamp"),
        "enrich_gamma_failed_at": F.lit(None).cast("timestamp"),
        "enrich_gamma_attempts": F.lit(0), "enrich_gamma_last_error": F.lit(None).cast("string"),
    }
    cols = [F.col(c) if c in df.columns else defaults[c].alias(c) for c in DIM_COLUMNS]
    return df.select(*cols)


def upsert_markets(existing: DataFrame | None, incoming: DataFrame, *, order=None,
                   mark: str | None = None) -> DataFrame:
    """Incoming markets replace the ingest columns; category, topic and the
    enrichment state of existing rows survive. Duplicate ids in one batch:
    the last in ``order`` wins (a later upsert overwrites an earlier one).
    ``mark`` names a column that says inserted, updated or kept."""
    if order is None:
        writer = [c for c in ("source_file", "row_index", "pos") if c in incoming.columns]
        order = writer + [c for c in incoming.columns if c not in ("market_id", *writer)]
    inc = pick_per_key(incoming, ["market_id"], order, last=True)
    inc = empty_dim_columns(inc)
    if existing is None:
        return inc.withColumn(mark, F.lit("inserted")) if mark else inc
    return upsert(existing.select(*DIM_COLUMNS), inc, ["market_id"], INGEST_COLUMNS, mark=mark)
