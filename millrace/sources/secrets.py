"""Taking credentials out of catalogue data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

# ---- fixed values ----
CREDENTIAL_FIELDS = {
    "userCredentials",
    "snowflakeKeyPairKey",
    "snowflakeKeyPairPass",
    "snowflakePassword",
    "gitToken",
    "accessToken",
}
SENSITIVE_KEYS = {"token", "accesstoken", "refreshtoken", "password", "passphrase", "secret", "apikey", "pat"}
REDACTED = "<redacted>"


def drop_credential_fields(df: DataFrame) -> DataFrame:
    """Remove credential fields at any depth, by walking the schema once."""
    kept = [f for f in df.schema.fields if f.name not in CREDENTIAL_FIELDS]
    return df.select(*[_without(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in kept])


def _holds_credentials(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(f.name in CREDENTIAL_FIELDS or _holds_credentials(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _holds_credentials(kind.elementType)
    if isinstance(kind, T.MapType):
        return _holds_credentials(kind.valueType) or isinstance(kind.keyType, T.StringType)
    return False


def _without(c: Column, kind: T.DataType) -> Column:
    if not _holds_credentials(kind):
        return c
    if isinstance(kind, T.StructType):
        fields = [f for f in kind.fields if f.name not in CREDENTIAL_FIELDS]
        built = F.struct(*[_without(c[f.name], f.dataType).alias(f.name) for f in fields])
        return F.when(c.isNotNull(), built)
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _without(x, kind.elementType))
    safe = F.map_filter(c, lambda k, v: ~k.isin(*CREDENTIAL_FIELDS)) if isinstance(kind.keyType, T.StringType) else c
    return F.transform_values(safe, lambda k, v: _without(v, kind.valueType))


# A JSON text, and one that is not empty. All repetition is possessive, so that matching neither goes back nor deeper into the
# stack, however long a text is.
_TEXT = r'"[^"\\]*+(?:\\[\s\S][^"\\]*+)*+"'
_FILLED = r'"(?=[^"])[^"\\]*+(?:\\[\s\S][^"\\]*+)*+"'
_COLON = r"\s*+:\s*+"


def _named(keys: set[str]) -> str:
    """Any of the names between quotes, in any case, with any hyphens and underscores."""
    return '"(?i:' + "|".join("[_-]*" + "[_-]*".join(k) + "[_-]*" for k in sorted(keys)) + ')"'


_NAME = rf'"name"{_COLON}{_named(SENSITIVE_KEYS)}'
_DETAIL = rf'"detail"{_COLON}{_FILLED}'
#: What a JSON text is cut into: members that matter, brackets of objects, and stretches of anything else.
_PIECES = "|".join([_NAME, _DETAIL, rf'(?:[^"{{}}]++|(?!"(?:name|detail)"{_COLON}){_TEXT})++', _TEXT, r'[{}"]'])
_OPEN, _CLOSE, _IS_NAME, _IS_DETAIL = 1, 2, 3, 4
_FRAME = "struct<named:boolean,details:array<int>>"


def _details(pieces: Column) -> Column:
    """Positions of the ``detail`` members that stand in one object with a ``name`` that is a sensitive key.

    One pass over brackets and members with a stack of the open objects. What is left open at the end, and members outside any
    object, count too: the text may be a part of a document.
    """
    kind = lambda p: (
        F.when(p == "{", _OPEN).when(p == "}", _CLOSE).when(p.rlike(f"^{_NAME}$"), _IS_NAME).when(p.rlike(f"^{_DETAIL}$"), _IS_DETAIL)
    )
    events = F.filter(F.transform(pieces, lambda p, i: F.struct(i.alias("at"), kind(p).alias("kind"))), lambda e: e["kind"].isNotNull())
    frame = lambda named, details: F.struct(named.alias("named"), details.alias("details"))
    no_details, empty = F.array().cast("array<int>"), frame(F.lit(False), F.array().cast("array<int>"))
    found_in = lambda f: F.when(f["named"], f["details"]).otherwise(no_details)

    def step(state: Column, e: Column) -> Column:
        stack, found = state["stack"], state["found"]
        top = F.element_at(stack, -1)
        below = F.slice(stack, 1, F.size(stack) - 1)
        put = lambda f: F.concat(below, F.array(f))
        outermost = F.size(stack) == 1
        new_stack = (
            F.when(e["kind"] == _OPEN, F.concat(stack, F.array(empty)))
            .when(e["kind"] == _IS_NAME, put(frame(F.lit(True), top["details"])))
            .when(e["kind"] == _IS_DETAIL, put(frame(top["named"], F.concat(top["details"], F.array(e["at"])))))
            .when(outermost, stack)
            .otherwise(below)
        )
        closed = (e["kind"] == _CLOSE) & ~outermost & top["named"] & (F.size(top["details"]) > 0)
        return F.struct(new_stack.alias("stack"), F.when(closed, F.concat(found, top["details"])).otherwise(found).alias("found"))

    start = F.struct(F.array(empty).cast(f"array<{_FRAME}>").alias("stack"), no_details.alias("found"))
    return F.aggregate(events, start, step, lambda s: F.concat(s["found"], F.flatten(F.transform(s["stack"], found_in))))


def _without_details(text: Column) -> Column:
    """The text with the ``detail`` beside each sensitive ``name`` masked, at any depth."""
    pieces = F.regexp_extract_all(text, F.lit(_PIECES), F.lit(0))

    def rewritten(p: Column) -> Column:
        # pieces and masks in order of position; a mask takes the place of the piece before it
        own = F.transform(p, lambda x, i: F.struct(i.alias("at"), F.lit(0).alias("mask"), x.alias("piece")))
        masks = F.transform(_details(p), lambda i: F.struct(i.alias("at"), F.lit(1).alias("mask"), F.lit("").alias("piece")))
        both = F.array_sort(F.concat(own, masks))

        def shown(all_: Column) -> Column:
            prefix = lambda x: F.regexp_extract(x, rf'^"detail"{_COLON}', 0)
            masked = lambda x, i: F.coalesce(F.get(all_, i + 1)["at"] == x["at"], F.lit(False))
            return F.transform(all_, lambda x, i: F.when(masked(x, i), F.concat(prefix(x["piece"]), F.lit(f'"{REDACTED}"'))).otherwise(x["piece"]))

        return F.array_join(_let(both, shown), "")

    return _let(pieces, rewritten)


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def redact_sensitive(df: DataFrame, json_column: str) -> DataFrame:
    """Mask secrets inside a JSON text column and add ``did_redact``.

    A filled text under a sensitive key is replaced, and so is ``detail`` beside a ``name`` that is a sensitive key, in either
    order and whatever stands between the two, at any depth. All else in the text stays as it is written. The rules work on the
    text, so they also find secrets in JSON that is cut off or broken. A null stays null.
    """
    before = F.col(json_column)
    text = F.regexp_replace(before, rf"({_named(SENSITIVE_KEYS)}{_COLON}){_FILLED}", f'$1"{REDACTED}"')
    both = text.rlike(_NAME) & text.rlike(_DETAIL)  # few documents need to be cut into pieces
    after = F.when(both, _without_details(text)).otherwise(text)
    return df.withColumn("__after", after).withColumn("did_redact", F.coalesce(F.col("__after") != before, F.lit(False))).withColumn(json_column, F.col("__after")).drop("__after")
