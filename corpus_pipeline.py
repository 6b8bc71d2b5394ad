"""From raw documents to token ids: five stages, each on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a frame, which ``run`` writes as Parquet in
the shared folder and reads again. All but the last return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom.llm import decontaminate, language_id, near_dup, pieces, toxicity
from stockloom.llm.common import Work, table

# A text is rejected when less than this share of its grams belongs to any language.
LEAST_LANGUAGE = 0.3

# No SQL counterpart: the classifiers and the vocabulary cannot be expressed there.
ORACLE_SQL = None


def _aside(docs: DataFrame) -> tuple[DataFrame, list[str], DataFrame]:
    """The columns under names that cannot clash, with ``text`` beside them."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    renamed = docs.toDF(*names)
    at = {c.lower(): n for c, n in zip(docs.columns, names, strict=True)}
    return renamed.withColumn("text", F.col(at["text"])), names, docs


def _back(rows: DataFrame, names: list[str], docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts in no language that was learned: without letters, or of unknown grams."""
    model = language_id.fit(language_id.train_rows(docs))
    rows, names, _ = _aside(docs)
    seen = language_id.identify(rows, model, names)
    # A text too short for a gram cannot be judged; it has score 0 and stays.
    short = F.length(F.regexp_replace(F.coalesce(F.col(names[docs.columns.index("text")]), F.lit("")),
                                      r"[^\p{L}]", "")) < 3
    kept = seen.filter((F.col("lang_pred") != language_id.UNKNOWN)
                       & ((F.col("score") >= LEAST_LANGUAGE) | short))
    return _back(kept, names, docs)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that are more likely toxic than not."""
    labels = toxicity.train_labels(table(spark, sf_dir, "labels"))
    model = toxicity.fit(docs, labels)
    rows, names, _ = _aside(docs)
    return _back(toxicity.score(rows, model, names).filter("score < 0.5"), names, docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates."""
    return near_dup.deduplicated(docs)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that hold a benchmark item, also with other numbers or names in it."""
    return decontaminate.cleaned(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_chars, and the ids of the text."""
    return pieces.encode(docs, ["doc_id", "lang", "source", "n_chars"], pieces.load())


STAGES = [
    ("language ID", language),
    ("toxicity", toxic),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", clean_of_benchmark),
    ("SentencePiece", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Work(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = work.keep(stage(spark, docs, sf_dir), f"stage{number}")
        if number:
            work.drop(f"stage{number - 1}")
    return docs
