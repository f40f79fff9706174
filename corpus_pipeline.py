"""A corpus pipeline: toxicity, near duplicates, benchmark decontamination, tokens.

Each stage takes the documents that the one before kept and, but for the last, returns those it keeps
with the columns of ``documents``. What every stage returns is written and read again. Decisions are about rows: where an
operator reports on ids, it is given a hash of the whole row as id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halfstar.llm import bpe, decontamination, jaccard_join, toxicity
from halfstar.llm.queries import TOXIC_FROM, read, toxicity_model, vocabulary
from halfstar.llm.tables import few, stored

#: Shingles of the near-duplicate stage, and the similarity from which documents count as one.
WIDTH, PERCENT = 5, 80


def free_name(docs: DataFrame, name: str) -> str:
    """A name that no column has."""
    while name in docs.columns:
        name = f"_{name}"
    return name


def with_row(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a number for each row's content, of all columns and which of them are NULL, and its name."""
    name = free_name(docs, "_row")
    return docs.withColumn(name, F.xxhash64(*(x for c in docs.columns for x in (F.col(c), F.col(c).isNull())))), name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject; all their columns as they were.

    Each row is decided by its own whole text, so repeated rows and ids are decided alike or apart as their texts are;
    a NULL or empty text has the score of no features. An empty table gives an empty one.
    """
    model = toxicity_model(docs, read(spark, sf_dir, "labels"))
    own = free_name(docs, "_score")  # the model's column has the name without the bar
    scored = toxicity.score(docs.withColumnRenamed("score", own), model).where(F.col("score") < TOXIC_FROM)
    return scored.drop("score").withColumnRenamed(own, "score").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents exactly one row: that of the smallest id.

    Rows are told apart by all their columns, so an id that occurs in several components has a row in each that it is the
    smallest of. Rows without an id come after all others, rows of one id in the order of a hash. Repeated rows are one, also if they have no
    text; other rows with a NULL or empty text are similar to nothing and stay. Texts of any length are compared whole.
    """
    keyed, row = with_row(docs)
    found = jaccard_join.similar_components(keyed.select(F.col(row).alias("doc_id"), "text"), WIDTH, PERCENT)
    found = stored(found.select(F.col("doc_id").alias(row), "component_id"), "components")
    n_rows = found.count()
    rows = found.groupBy("component_id", row).agg(F.count("*").alias("copies"))
    # components of one row need no choice
    several = rows.groupBy("component_id").agg(F.count("*").alias("rows"), F.max("copies").alias("copies"))
    several = stored(few(several.where("rows > 1 or copies > 1"), n_rows), "groups")
    inside = found.distinct().join(several.select("component_id"), "component_id", "left_semi")
    inside = stored(few(inside, n_rows), "grouped_rows")
    named = keyed.select(row, "doc_id").join(inside, row).distinct()
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", F.col(row).alias("row"))
    chosen = named.groupBy("component_id").agg(F.min(order).alias("first")).select("component_id", F.col("first.row").alias(row))
    others = inside.join(chosen, ["component_id", row], "left_anti").select(row)
    others = stored(few(others, n_rows), "near_duplicates")
    kept = keyed.join(others, row, "left_anti")
    repeated = stored(few(rows.where("copies > 1").select(row), n_rows), "repeated")
    if not repeated.isEmpty():  # only their texts need to move to be told apart
        once = kept.join(repeated, row, "left_semi").dropDuplicates([row])
        kept = kept.join(repeated, row, "left_anti").unionByName(once)
    return kept.select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, decided row by row.

    Rows with a NULL or empty text hold none and stay, also without an id; repeated rows go or stay together. Items of less
    than five words count by their whole sequence. An empty table of either kind leaves the documents as they are.
    """
    keyed, row = with_row(docs)
    found = decontamination.contaminated(keyed.select(F.col(row).alias("doc_id"), "text"), read(spark, sf_dir, "benchmark"), short_items=True)
    found = stored(found.select(F.col("doc_id").alias(row)), "contaminated_pairs")
    others = stored(few(found.distinct(), found.count()), "contaminated")
    return keyed.join(others, row, "left_anti").select(*docs.columns)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document, and the digest of the bytes that they decode to.

    A row for each row; a NULL or empty text has no ids and decodes to nothing. Texts of any length are encoded whole; columns beside those of documents
    are left out. An empty table gives an empty one.
    """
    docs = docs.select("doc_id", "lang", "source", "text")
    return bpe.round_trip(docs, vocabulary()).select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("byte_bpe", to_tokens),
]

#: A trained classifier and BPE are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
