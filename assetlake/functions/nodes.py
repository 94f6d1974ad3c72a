"""Reading loosely typed JSON through VARIANT columns.

A node is a VARIANT column.  A key that is absent gives SQL NULL, a key holding a JSON
null gives a variant null, so "missing" and "null" stay apart.  Kinds are told from the
node's JSON text by one pattern each: few expressions keep the generated code small and
do not derive the schema of a whole node.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_node(df: DataFrame, column: str) -> Column:
    """``column`` as VARIANT: parsed when it holds text, untouched when already parsed."""
    if df.schema[column].dataType.typeName() == "variant":
        return F.col(column)
    return F.try_parse_json(F.col(column))


def member(node: Column, name: str) -> Column:
    """Child node (dotted names descend); NULL when absent."""
    path = "$" + "".join(f"['{part}']" for part in name.split("."))
    return F.try_variant_get(node, path, "variant")


def open_keys(node: Column, names: Sequence[str]) -> Column:
    """The named keys of an object as a struct of nodes; NULL for no object.

    One pass over the object: cheaper than :func:`member` where many keys are read.
    """
    return node.try_cast(_opened(names))


def _opened(names: Sequence[str]) -> str:
    return f"struct<{', '.join(f'`{name}` variant' for name in names)}>"


def is_object(node: Column) -> Column:
    """True for a JSON object."""
    return node.try_cast("struct<>").isNotNull()


def typed(node: Column, dtype: str = "string", default=None) -> Column:
    """Typed node: ``default`` when it is absent, NULL when it is JSON null."""
    value = node.try_cast(dtype)
    if default is None:
        return value
    return F.when(node.isNull(), F.lit(default)).otherwise(value)


def truthy(node: Column) -> Column:
    """False for absent, null, empty text, zero, false and empty containers."""
    empty = F.to_json(node).rlike(r'^(null|""|false|\{\}|\[\]|-?[0.]+(E.*)?)$')
    # JSON text is costly to make and needed only where the bare text may stand for something empty
    text = node.try_cast("string")
    doubtful = text.rlike(r"^(false|\{\}|\[\]|-?[0.]*(E.*)?)$")
    return F.when(doubtful, F.coalesce(~empty, F.lit(False))).otherwise(text.isNotNull())


def is_text_or_absent(node: Column) -> Column:
    """True for a JSON string and for an absent key."""
    return F.coalesce(F.to_json(node).startswith('"'), F.lit(True))


def is_number(node: Column) -> Column:
    """True for a JSON number."""
    return F.coalesce(F.to_json(node).rlike("^[-0-9]"), F.lit(False))


def json_text(node: Column, default: str | None = None) -> Column:
    """JSON text of a node; ``default`` when absent, the text ``null`` for JSON null."""
    return F.to_json(node) if default is None else F.coalesce(F.to_json(node), F.lit(default))


def json_or_null(node: Column) -> Column:
    """JSON text of a node, NULL when the node is absent or empty."""
    return F.when(truthy(node), F.to_json(node))


def _plain(node: Column, title_bool: bool) -> Column:
    """Text of a node: strings bare, containers as JSON, floats keeping their ``.0``."""
    text = node.try_cast("string")
    kind = F.schema_of_variant(node)
    plain = F.when(
        text.rlike("^-?[0-9]{1,16}$") & kind.startswith("DECIMAL"), F.concat(text, F.lit(".0"))
    )
    if title_bool:
        plain = plain.when(text.isin("true", "false") & (kind == "BOOLEAN"), F.initcap(text))
    return plain.otherwise(text)


def value_to_string(node: Column, bool_style: str = "json") -> Column:
    """Text of a property value: '' for absent or null, JSON for containers.

    ``bool_style`` is ``json`` (``true``) or ``title`` (``True``).
    """
    return F.coalesce(_plain(node, bool_style == "title"), F.lit(""))


# The spellings of "yes" that flag columns accept (any case).
FLAG01_WORDS = ["true", "1", "yes"]
FLAG_TEXT_WORDS = ["true", "1", "yes", "on"]

_NON_ZERO = r"-?[0-9.]*[1-9][0-9.]*(E.*)?"
_BLANKS = r"(\s|\\[nrtf])*"


def _is_yes(node: Column, words: list[str], around: str) -> Column:
    word = f'"{around}({"|".join(words)}){around}"'
    return F.coalesce(F.to_json(node).rlike(f"(?i)^(true|{word}|{_NON_ZERO})$"), F.lit(False))


def flag01(node: Column) -> Column:
    """1 for true, a non-zero number or a yes-word; else 0."""
    return _is_yes(node, FLAG01_WORDS, "").cast("int")


def flag_text(node: Column) -> Column:
    """'true' or 'false' by the rule of :func:`flag01`, with trimmed words and ``on``."""
    return _is_yes(node, FLAG_TEXT_WORDS, _BLANKS).cast("string")


def is_true_literal(node: Column) -> Column:
    """True only for the JSON string "true"; JSON true does not count."""
    return F.coalesce(F.to_json(node) == '"true"', F.lit(False))


def json_or_default(node: Column, default: str) -> Column:
    """JSON text; text that already looks like JSON passes as is, other text is quoted."""
    json, text = F.to_json(node), node.try_cast("string")
    return (
        F.when(text.isNull(), F.lit(default))
        .when(json.startswith('"') & ~text.rlike(r"^\s*[\[{]"), json)
        .otherwise(_plain(node, title_bool=True))
    )


def input_sorted_text(node: Column) -> Column:
    """Text of the many-typed ``inputSorted`` key, outer double quotes stripped."""
    json = F.to_json(node)
    return (
        F.when(node.isNull(), F.lit(""))
        .when(json == "null", F.lit("None"))
        .when(json.rlike(r"^[\[{]"), json)
        .otherwise(F.btrim(_plain(node, title_bool=False), F.lit('"')))
    )


def class_int(node: Column) -> Column:
    """Class number: digit text as int, other text 0, absent 0, JSON null NULL."""
    text = node.try_cast("string")
    digits = F.when(text.rlike("^[0-9]+$"), text.try_cast("int"))
    return (
        F.when(node.isNull(), F.lit(0))
        .when(F.to_json(node).startswith('"'), F.coalesce(digits, F.lit(0)))
        .otherwise(text.try_cast("int"))
    )


def elements_of(
    node: Column, inner_key: str | None = None, own_kind: str | None = None, keys: Sequence[str] | None = None
) -> Column:
    """A node as an array of nodes: an array as is, an object as its only element.

    ``inner_key`` names a key of a wrapping object whose array is taken instead of the
    object; ``own_kind`` is the ``@type`` of objects that are never unwrapped.  Other
    scalars and unparsable text give NULL.  With ``keys``, elements are the structs of
    :func:`open_keys`, so an element is read in one pass; one that is no object is NULL.
    """
    array = "array<variant>" if keys is None else f"array<{_opened(keys)}>"
    as_object = F.when(is_object(node), F.array(node if keys is None else open_keys(node, keys)))
    if inner_key is not None:
        inner = member(node, inner_key)
        wrapped = inner.isNotNull()
        if own_kind is not None:
            own = F.try_variant_get(node, "$['@type']", "string") == own_kind
            wrapped = wrapped & ~F.coalesce(own, F.lit(False))
        as_object = F.when(wrapped, inner.try_cast(array)).otherwise(as_object)
    return F.coalesce(node.try_cast(array), as_object)


def explode_elements(
    df: DataFrame, column: str, keep: Sequence[Column | str], elements=elements_of
) -> DataFrame:
    """One row per element of a JSON column: the kept columns, ``_pos`` and ``_node``.

    The column is parsed once, in a projection of its own below the generator.
    """
    parsed = df.select(*keep, as_node(df, column).alias("_root"))
    kept = [c for c in parsed.columns if c != "_root"]
    return parsed.select(*kept, F.posexplode(elements(F.col("_root"))).alias("_pos", "_node"))


def first_object(df: DataFrame, column: str, keep: Sequence[Column | str]) -> DataFrame:
    """One row where a JSON column holds a non-empty object, or an array that starts with one.

    Gives the kept columns and the object in ``_node``.
    """
    first = explode_elements(df, column, keep, lambda root: F.slice(elements_of(root), 1, 1))
    return first.drop("_pos").filter(is_object(F.col("_node")) & truthy(F.col("_node")))
