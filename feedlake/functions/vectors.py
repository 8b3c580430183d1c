"""Vector arithmetic, namespaces and vector metadata, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake import fixed
from feedlake.functions.chunks import bind
from feedlake.functions.feeds import plain_time_text
from feedlake.functions.text import ANY_SPACE

EDGE_SPACES = f"^{ANY_SPACE}+|{ANY_SPACE}+$"


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def norm(v: Column) -> Column:
    return F.sqrt(_sum(F.transform(v.cast("array<double>"), lambda x: x * x)))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors, 0.0 if either is all zeros; unequal lengths are an error."""
    dot = _sum(F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: x * y))
    scale = norm(a) * norm(b)
    score = F.when(scale == 0, F.lit(0.0)).otherwise(F.try_divide(dot, scale))
    return F.when(F.size(a) == F.size(b), score).otherwise(
        F.raise_error(F.lit("vectors of unequal length"))
    )


def l2_normalize(v: Column) -> Column:
    """The vector at length one; a vector of zeros stays as it is."""
    exact = v.cast("array<double>")
    return bind(
        norm(v),
        lambda n: F.transform(exact, lambda x: F.when(n == 0, x).otherwise(F.try_divide(x, n))),
    )


def zero_vector(dim: int = fixed.EMBEDDING_DIM) -> Column:
    return F.array_repeat(F.lit(0.0), dim)


def namespace(region: Column) -> Column:
    name = F.replace(F.lower(F.regexp_replace(region, EDGE_SPACES, "")), F.lit(" "), F.lit("_"))
    return F.coalesce(F.nullif(name, F.lit("")), F.lit(fixed.DEFAULT_NAMESPACE))


def json_text(value: Column) -> Column:
    """One value as JSON."""
    wrapped = F.to_json(F.struct(value.alias("v")))
    return F.substring(wrapped, F.lit(6), F.length(wrapped) - 6)


def json_object(fields: dict[str, Column]) -> Column:
    """A JSON object in the given key order, blanks after ':' and ','; NULL fields are left out."""
    parts = [
        F.when(v.isNotNull(), F.concat(F.lit(f'"{k}": '), json_text(v))) for k, v in fields.items()
    ]
    return F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*parts)), ", "), F.lit("}"))


def vector_metadata(
    extra: dict[str, Column] | None = None, text_chars: int | None = None
) -> Column:
    """Metadata of a chunk row as JSON: six fixed keys, time and url where known, the text.

    ``extra`` adds keys, or replaces the value of one of the others. The text is whole
    unless ``text_chars`` asks for its first characters only.
    """
    fields = {
        k: F.col(k)
        for k in ("chunk_id", "article_id", "feed_id", "region", "language", "chunk_index")
    }
    fields["published_at"] = plain_time_text(F.col("published_at"))
    fields["source_url"] = F.nullif(F.col("source_url"), F.lit(""))
    text = F.col("chunk_text")
    fields["chunk_text"] = text if text_chars is None else F.substring(text, 1, text_chars)
    return json_object({**fields, **(extra or {})})
