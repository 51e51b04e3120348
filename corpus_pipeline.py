"""From documents to packed sequences: quality, language, near-duplicates, mixture, packing."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewell import ship
from pagewell.llm import langid, mixing, packing, quality, simhash
from pagewell.llm.shared import materialise


def _renamed(docs: DataFrame, *used: str):
    """The rows with only the columns `used` under their names, so that none of the others
    clashes with what is added, and the columns that give the names back."""
    names = {c: c if c in used else f"_c{i}" for i, c in enumerate(docs.columns)}
    return (docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items())),
            {c: F.col(n).alias(c) for c, n in names.items()})


def quality_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the thresholds of their own corpus keep.

    Texts are measured twice, for the thresholds and for the verdicts, so that no text is
    shuffled or written in between. Null texts fail the base rules.
    """
    ship(spark)
    named, back = _renamed(docs, "text", "lang", "source")
    fences = quality.fit(quality.measure(docs.select("text", "lang", "source")))
    judged = quality.judge(quality.measure(named), fences)
    return judged.where("kept").select(*back.values())


def language_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; a missing label is filled in.

    A text is rejected if it has no letter or fewer of its n-grams are known than in texts of
    the language that it is nearest to. That bound is taken, per language, from one text in
    `langid.FOLDS` by hash, which the filters do not learn from. Without any labelled text
    there is nothing to reject by, and all stay.
    """
    ship(spark)
    apart = F.pmod(F.xxhash64("text"), F.lit(langid.FOLDS)) == 0
    filters = langid.train(docs.where(~apart))
    if not filters.languages:
        return docs
    least = langid.bounds(filters, docs.where(apart).select("text", "lang"))
    named, back = _renamed(docs, "text", "lang")
    told = langid.known(langid.predict(named, filters), least)
    return told.select(*(back | {"lang": F.coalesce("lang", "lang_pred").alias("lang")}).values())


def near_duplicate_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near-duplicates."""
    ship(spark)
    return simhash.drop_near_duplicates(docs).select(*docs.columns)


def mixing_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them: a document taken twice is two rows."""
    ship(spark)
    named = docs.select("source", "doc_id", "text", F.struct("*").alias("_doc"))
    taken = mixing.emit(mixing.mix(named))
    return taken.select(*(F.col(f"_doc.`{c}`") for c in docs.columns))


def packing_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    ship(spark)
    return packing.pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]
#: Filters, fingerprints and tokenizers are beyond SQL; tests compare with plain versions.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    """The stages one after another over the documents; each result is written and read again."""
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
