"""JSON messages as variants: documents, type field, message structs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_TYPE = "unknown"
TYPE_FIELD = "product_type"
STRICT_TYPE_FIELD = "ProductType"
VALID_TYPE_PATTERN = "^[a-z0-9_-]+$"


def documents(message: Column) -> Column:
    """array<variant> of a message: the elements of an array, or the one document.

    NULL if the text is not JSON. Explode it to get one row per document.
    """
    return elements(F.try_parse_json(message))


def elements(parsed: Column) -> Column:
    """array<variant> of a parsed message; NULL for NULL."""
    inside = F.try_variant_get(parsed, "$", "array<variant>")
    return F.when(parsed.isNotNull(), F.coalesce(inside, F.array(parsed)))


def document_type(document: Column, field: str = TYPE_FIELD) -> Column:
    """Lower-cased type field of a variant; ``unknown`` if absent or JSON null."""
    value = F.try_variant_get(document, f"$.{field}", "string")
    return F.lower(F.coalesce(value, F.lit(UNKNOWN_TYPE)))


def is_valid_type(kind: Column) -> Column:
    """True if the type can name a destination; never NULL."""
    return F.coalesce(kind.rlike(VALID_TYPE_PATTERN), F.lit(False))


def textual_field(message: Column, field: str = STRICT_TYPE_FIELD) -> Column:
    """The field of a JSON object if it is text, else NULL (case is kept)."""
    value = F.variant_get(F.try_parse_json(message), f"$.{field}", "variant")
    return F.when(F.schema_of_variant(value) == "STRING", value.try_cast("string"))


def typed_message(message: Column, field: str = STRICT_TYPE_FIELD) -> Column:
    """Struct {originalValue, productType}; NULL for NULL or non-JSON input."""
    return F.when(
        F.try_parse_json(message).isNotNull(),
        F.struct(
            message.alias("originalValue"), textual_field(message, field).alias("productType")
        ),
    )


def with_constant(message: Column, name: str, value) -> Column:
    """The message struct with one more field of a constant value; NULL stays NULL."""
    return message.withField(name, F.lit(value))


def dead_letter_body(message: Column, error: Column, **where: Column) -> Column:
    """JSON envelope with the original text, the reason and its position."""
    fields = [message.alias("original_message"), error.alias("error")]
    fields += [column.alias(name) for name, column in where.items()]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
