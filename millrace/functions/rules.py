"""Ordered rule chains as single Column expressions, so they stay inside codegen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from millrace.functions.names import base_type, norm, trim

# ---- fixed values: patterns, names and layers that decide results -------------------------

TYPE_RULES = [
    ("DATEDIFF(", None, "NUMBER"),
    ("DATEADD(", None, "DATE"),
    ("CURRENT_DATE", None, "DATE"),
    ("CURRENT_TIMESTAMP", None, "TIMESTAMP_NTZ(9)"),
    ("COUNT(DISTINCT", None, "NUMBER"),
    ("COUNT(", None, "NUMBER"),
    ("SUM(", None, "NUMBER(38,4)"),
    ("AVG(", None, "NUMBER(38,4)"),
    ("STDDEV(", None, "NUMBER(38,4)"),
    ("VARIANCE(", None, "NUMBER(38,4)"),
    ("MIN(", "_TS", "TIMESTAMP_NTZ(9)"),
    ("MAX(", "_TS", "TIMESTAMP_NTZ(9)"),
    ("MIN(", "_DATE", "DATE"),
    ("MAX(", "_DATE", "DATE"),
    ("CONCAT(", None, "VARCHAR"),
    ("UPPER(", None, "VARCHAR"),
    ("LOWER(", None, "VARCHAR"),
    ("TRIM(", None, "VARCHAR"),
    ("SUBSTR(", None, "VARCHAR"),
    ("LEFT(", None, "VARCHAR"),
    ("RIGHT(", None, "VARCHAR"),
    ("CASE", None, "VARCHAR"),
    ("ROW_NUMBER()", None, "NUMBER"),
    ("RANK()", None, "NUMBER"),
    ("DENSE_RANK()", None, "NUMBER"),
]

AGGREGATE_CALLS = ["COUNT(", "SUM(", "AVG(", "MIN(", "MAX(", "STDDEV(", "VARIANCE(", "LISTAGG(", "ARRAY_AGG("]
WINDOW_CALLS = ["ROW_NUMBER()", "RANK()", "DENSE_RANK()", "LEAD(", "LAG(", "FIRST_VALUE(", "LAST_VALUE("]
AGGREGATE_PATTERN = r"(?i)\b(COUNT|SUM|AVG|MIN|MAX|STDDEV|VARIANCE|LISTAGG|ARRAY_AGG)\s*\("
WINDOW_PATTERN = r"(?i)\b(ROW_NUMBER|RANK|DENSE_RANK|LEAD|LAG|FIRST_VALUE|LAST_VALUE)\s*\(|\bOVER\s*\("

FAMILY_PATTERNS = [
    ("persistent-stage", r"(^|[\s_-])persistent\s*stage([\s_-]|$)|persistentstage"),
    ("stage", r"(^|[\s_-])stage([\s_-]|$)|\bstg\b"),
    ("view", r"(^|[\s_-])view([\s_-]|$)|\bvw\b"),
    ("work", r"(^|[\s_-])work([\s_-]|$)|\bwrk\b|\bcwrk\b"),
    ("dimension", r"(^|[\s_-])dimension([\s_-]|$)|\bdim\b"),
    ("fact", r"(^|[\s_-])fact([\s_-]|$)|\bfct\b"),
    ("hub", r"(^|[\s_-])hub([\s_-]|$)"),
    ("satellite", r"(^|[\s_-])satellite([\s_-]|$)|(^|[\s_-])sat([\s_-]|$)"),
    ("link", r"(^|[\s_-])link([\s_-]|$)"),
]
FAMILY_PREFIXES = {
    "stage": "STG",
    "persistent-stage": "PSTG",
    "view": "VW",
    "work": "WRK",
    "dimension": "DIM",
    "fact": "FACT",
    "hub": "HUB",
    "satellite": "SAT",
    "link": "LNK",
}
KNOWN_NAME_PREFIX = r"(?i)^(SRC[_-]?|STG[_-]?|DIM[_-]?|FACT[_-]?|FCT[_-]?|INT[_-]?|WORK[_-]?|VW[_-]?)"

LAYER_PATTERNS = [
    ("bronze", r"^(RAW_|SRC_|LANDING_|L0_)"),
    ("staging", r"^(STG_|STAGE_|CLEAN_|L1_)"),
    ("intermediate", r"^(INT_|TMP_|WORK_|TRANSFORM_)"),
    ("mart", r"^(DIM_|DIMENSION_|FACT_|FCT_|MART_|RPT_)"),
]
LAYER_ORDER = {"bronze": 0, "staging": 1, "intermediate": 2, "mart": 3}

TIMESTAMP_NAME = r"(?i)_TS$|_TIMESTAMP$|TIMESTAMP_"
DATE_NAME = r"(?i)_DATE$|_DT$|DATE_"
KEY_NAME = r"(?i)_(ID|KEY|CODE|NUM)$|^(ID|KEY|CODE)_"
SYSTEM_NAME = r"(?i)^(SYS_|DW_|ETL_|LOAD_|CREATED_|UPDATED_|MODIFIED_|INSERT_|UPDATE_)"
START_NAME = r"(?i)START_DATE|EFFECTIVE_DATE"
END_NAME = r"(?i)END_DATE|EXPIRY_DATE"
CURRENT_NAME = r"(?i)IS_CURRENT|CURRENT_FLAG"

# ---- expressions ---------------------------------------------------------------------------


def first_match(rules: list[tuple[Column, object]], default: object = None) -> Column:
    """Value of the first rule whose condition holds."""
    head, *rest = rules
    chain = reduce(lambda acc, r: acc.when(r[0], r[1]), rest, F.when(head[0], head[1]))
    return chain.otherwise(F.lit(default)) if default is not None else chain


def infer_type(expression: Column) -> Column:
    text = F.upper(expression)
    rules = []
    for token, context, result in TYPE_RULES:
        hit = F.contains(text, F.lit(token))
        if context:
            hit = hit & F.contains(text, F.lit(context))
        rules.append((hit, result))
    return first_match(rules)


def is_aggregate(expression: Column, strict: bool = True) -> Column:
    """``strict`` asks for a whole-word call outside a window; otherwise any substring counts."""
    if strict:
        return expression.rlike(AGGREGATE_PATTERN) & ~expression.rlike(r"(?i)\bOVER\s*\(")
    return _contains_any(expression, AGGREGATE_CALLS)


def is_window(expression: Column, strict: bool = True) -> Column:
    return expression.rlike(WINDOW_PATTERN) if strict else _contains_any(expression, WINDOW_CALLS)


def _contains_any(expression: Column, tokens: list[str]) -> Column:
    text = F.upper(expression)
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(t)) for t in tokens])


def is_passthrough(transform: Column, name: Column) -> Column:
    """A column taken over as it is: no text, its own name, or its own name behind a qualifier."""
    text = trim(F.coalesce(transform, F.lit("")))
    upper, target = F.upper(text), norm(F.coalesce(name, F.lit("")))
    aliased = F.regexp_extract(text, r'^"[^"]+"\s*\.\s*"([^"]+)"$', 1)
    referenced = F.regexp_extract(text, r'(?i)^\{\{\s*ref\s*\([^)]*\)\s*\}\}\s*\.\s*"([^"]+)"$', 1)
    return (
        (text == "")
        | (upper == target)
        | (upper == F.concat(F.lit('"'), target, F.lit('"')))
        | ((aliased != "") & (F.upper(aliased) == target))
        | ((referenced != "") & (F.upper(referenced) == target))
    )


def family(signal: Column) -> Column:
    text = F.lower(F.coalesce(signal, F.lit("")))
    return first_match([(text.rlike(p), name) for name, p in FAMILY_PATTERNS], "unknown")


def layer(name: Column, node_type: Column) -> Column:
    upper = F.upper(name)
    by_name = [(upper.rlike(p), label) for label, p in LAYER_PATTERNS]
    return first_match([*by_name, (base_type(node_type).isin("Dimension", "Fact"), "mart")], "unknown")


def layer_rank(layer_name: Column) -> Column:
    return first_match([(layer_name == k, F.lit(v)) for k, v in LAYER_ORDER.items()], -1)
