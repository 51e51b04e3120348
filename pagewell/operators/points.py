"""Points of documents."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewell import schemas
from pagewell.functions.ids import point_id
from pagewell.operators.embed import Embedder, embed_text
from pagewell.operators.newest import newest_with_copies


def _payload(**given: Column) -> Column:
    return F.struct(*(
        given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schemas.PAYLOAD.fields))


def _points(rows: DataFrame, payload: Column) -> DataFrame:
    extra = {"part": F.lit(0), "copies": F.lit(1)}
    return rows.select(
        "point_id", "vector", payload.alias("payload"), F.col("ordinal").cast("long"),
        *((F.col(n) if n in rows.columns else e).cast("long").alias(n)
          for n, e in extra.items()))


def points_from_documents(documents: DataFrame, embedder: Embedder | None = None) -> DataFrame:
    """Points of parsed documents; the id is that of the source."""
    rows = embed_text(
        documents.withColumn("point_id", point_id(F.col("source"))), "content", embedder)
    return _points(rows, _payload(**{n: F.col(n) for n in (
        "source", "title", "content", "metadata", "timestamp", "source_type")}))


def with_text_ids(texts: DataFrame) -> DataFrame:
    """Adds the point id of the text, and an empty map for missing metadata."""
    given = F.col("metadata") if "metadata" in texts.columns else F.lit(None)
    empty = F.create_map().cast(schemas.STRING_MAP)
    return texts.withColumn("point_id", point_id(F.col("text"))).withColumn(
        "metadata", F.coalesce(given.cast(schemas.STRING_MAP), empty))


def points_from_texts(
    texts: DataFrame, embedder: Embedder | None = None, distinct: bool = False,
) -> DataFrame:
    """Points of text documents (`ordinal, text` and maybe `metadata`).

    The id is that of the text. With `distinct`, only the last document of each text
    is embedded, and `copies` says how many it stands for.
    """
    rows = with_text_ids(texts)
    if distinct:
        rows = newest_with_copies(rows, ["point_id"], ["ordinal"])
    rows = embed_text(rows, "text", embedder)
    return _points(rows, _payload(text=F.col("text"), metadata=F.col("metadata")))


def batch_plan(points: DataFrame, batch_size: int = 32) -> DataFrame:
    """Adds `batch`: points in input order, `batch_size` in each batch but the last."""
    from pagewell.operators.ordering import number_by_ordinal

    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    numbered = number_by_ordinal(points, "_position")
    return numbered.withColumn(
        "batch", F.floor(F.col("_position") / batch_size)).drop("_position")
