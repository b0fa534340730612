"""The corpus pipeline: language ID, line dedup, near-duplicates, benchmark decontamination, token ids.

Each stage takes what its predecessor kept, written as Parquet and read again, and returns a DataFrame; all
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardmill.llm import byte_bpe, decontamination, language_id, line_dedup, near_duplicates
from wardmill.llm.common import id_of, stored, table
from wardmill.llm.registry import op5_digest, tokenizer_path
from wardmill.session import scratch_path

#: A document is in no language if its most probable one, as a mean over its bytes, is not this share of the way from
#: chance (all languages alike) to certainty.
LEAST_SCORE = 0.05

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language can be told: those without a letter go, and those whose best language is
    hardly more probable than chance (``LEAST_SCORE``; not asked where only one language was learned). Where nothing could be learned, because no usable row has a label, every
    document with a letter stays. Each row is judged by its own text."""
    net = language_id.learn_from(docs)
    if net is None:
        return docs.where(F.col("text").cast("string").rlike(r"\p{L}"))
    found = language_id.predict(docs, net, through=docs.columns)
    chance = 1 / len(net.languages)
    least = chance + LEAST_SCORE * (1 - chance) if chance < 1 else 0.0
    known = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= least)
    return found.where(known).select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the runs of lines that occur earlier; one that has lost all of its lines goes."""
    cut = line_dedup.without_repeats(docs)
    cut = cut.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    own = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return cut.select(*[own.get(c.lower(), F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents, stored, with a number for each row in a column of a new name. Stages that drop rows judge them
    by it: an id may be null, stand for several texts, or stand in repeated rows."""
    name = "row"
    while name.lower() in map(str.lower, docs.columns):
        name += "_"
    return stored(docs.withColumn(name, F.monotonically_increasing_id())), name


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest doc_id, none coming last, and of
    equal ids the one whose text has the smallest hash. Every row is a document: of rows repeated in full one
    stays, and rows of one id with unlike texts are judged apart. Documents without words are in no group and stay."""
    rows, row = _numbered(docs)
    found = near_duplicates.near_duplicates(rows.select(F.col(row).alias("doc_id"), "text"))
    found = stored(found.select(F.col("doc_id").alias("n"), F.col("component_id").alias("group")))
    groups = found.groupBy("group").agg(F.count("*").alias("held")).where("held > 1").select("group")
    members = found.join(groups, "group")
    ranked = rows.select(F.col(row).alias("n"), F.struct(id_of(), F.xxhash64("text"), F.col(row)).alias("place"))
    members = stored(members.join(ranked, "n"))
    first = members.groupBy("group").agg(F.min("place").alias("first"))
    gone = stored(members.join(first, "group").where(F.col("place") != F.col("first")).select(F.col("n").alias(row)))
    return rows.join(gone, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold too much of the benchmark. Every row is judged by its own text, whatever its id:
    a contaminated row without an id goes, and a clean one stays although another row of its id goes."""
    rows, row = _numbered(docs)
    found = decontamination.contamination(rows.select(F.col(row).alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    gone = stored(found.where("contaminated").select(F.col("doc_id").alias(row)))
    return rows.join(gone, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digests of the token ids and of the text that they decode to."""
    return op5_digest(byte_bpe.encode(docs, tokenizer_path(), decoded=True))


STAGES: list[tuple[str, Stage]] = [
    ("language ID", identify_language),
    ("line dedup", drop_repeated_lines),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("byte-level BPE encoding and decoding", encode_and_decode),
]

#: SQL can express neither the network of the first stage nor the merges of the last.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result is a table of its own in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES, 1):
        path = scratch_path(spark, f"corpus-{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
