"""Category -> topic rollup (F1 normalize_key, F2 topic_of) as Column expressions.

The rules are data, evaluated in order; the first match wins. They compile to
one CASE expression, so the rollup stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# These rules must equal the reference's for identical topics.
# Each entry: (topic, exact keys, substrings, substrings that veto the rule).
# Evaluated top to bottom on the normalized key; first match wins.
TOPIC_RULES = [
    ("sports", ["sports", "sport", "soccer"], ["nba", "nfl", "ncaa"], []),
    ("iran", ["iran"], ["iranian", "khamenei", "tehran"], []),
    ("elections", ["elections", "election", "us-election", "midterms", "primaries"], [], []),
    ("mentions", ["mentions", "mention"], [], []),
    ("politics", ["trump", "biden", "harris", "obama", "macron", "sunak", "merkel"], [], []),
    ("geopolitics", [], ["geopolitic", "ukraine", "russia", "china", "israel", "middle-east", "nato"], []),
    ("politics", [], ["politic", "election", "congress", "senate", "white-house",
                      "us-current-affairs", "current-affairs"], ["geopolitic"]),
    ("crypto", [], ["crypto", "bitcoin", "ethereum", "defi", "nft"], []),
    ("ai", ["ai"], ["artificial-intelligence", "openai", "llm"], []),
    ("tech", ["tech", "technology"], ["technology", "big-tech"], []),
    ("finance", [], ["finance", "fed", "stocks", "commodities", "forex"], []),
    ("economy", [], ["economy", "inflation", "gdp", "recession"], []),
    ("pop-culture", [], ["pop-culture", "movies", "music", "celebrity", "entertainment"], []),
    ("culture", ["culture"], ["literature"], []),
    ("weather", [], ["weather", "hurricane"], []),
]
DEFAULT_TOPIC = "other"


def unicode_trim(c: Column) -> Column:
    """Trim Unicode whitespace on both ends (Spark's trim strips only spaces).

    The regex runs only when an end character is a control/space or
    non-ASCII code point; for the usual clean value it is two ``ascii`` calls.
    """
    first, last = F.ascii(c), F.ascii(F.right(c, F.lit(1)))
    suspicious = (first <= 32) | (first >= 128) | (last <= 32) | (last >= 128)
    return F.when(suspicious, F.regexp_replace(c, r"(?U)^\s+|\s+$", "")).otherwise(c)


def normalize_key(c: Column | str) -> Column:
    """trim, lowercase, then each whitespace char or '_' becomes '-' (1:1)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.lower(unicode_trim(c)), r"(?U)[\s_]", "-")


def _rule_predicate(n: Column, exact, contains, veto) -> Column:
    pred = None
    if exact:
        pred = n.isin(*exact)
    for s in contains:
        p = n.contains(s)
        pred = p if pred is None else (pred | p)
    for v in veto:
        pred = pred & ~n.contains(v)
    return pred


def topic_of(category: Column | str) -> Column:
    """rollup of a raw category to one topic; NULL or blank -> 'other'."""
    c = F.col(category) if isinstance(category, str) else category
    n = normalize_key(c)
    expr = None
    for topic, exact, contains, veto in TOPIC_RULES:
        pred = _rule_predicate(n, exact, contains, veto)
        expr = F.when(pred, F.lit(topic)) if expr is None else expr.when(pred, F.lit(topic))
    expr = expr.otherwise(F.lit(DEFAULT_TOPIC))
    blank = c.isNull() | (unicode_trim(c) == "")
    return F.when(blank, F.lit(DEFAULT_TOPIC)).otherwise(expr)


def topic_case_sql(col_sql: str) -> str:
    """The same rollup as a DuckDB SQL CASE over an already-normalized key expr.

    Used by the oracle queries; it is generated from TOPIC_RULES so both
    engines read one rule table.
    """
    parts = []
    for topic, exact, contains, veto in TOPIC_RULES:
        preds = []
        if exact:
            preds.append(f"{col_sql} IN (" + ", ".join(f"'{e}'" for e in exact) + ")")
        preds += [f"contains({col_sql}, '{s}')" for s in contains]
        cond = "(" + " OR ".join(preds) + ")"
        for v in veto:
            cond += f" AND NOT contains({col_sql}, '{v}')"
        parts.append(f"WHEN {cond} THEN '{topic}'")
    return "CASE " + " ".join(parts) + f" ELSE '{DEFAULT_TOPIC}' END"
