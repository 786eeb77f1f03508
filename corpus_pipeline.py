"""From raw documents to encoded training text.

Each stage gets the documents its predecessor kept and returns those it keeps, with the columns
of ``documents``; the last returns token ids.  A stage judges its whole input.  Rows that are
equal in all columns are separate rows until the near-duplicate stage, which keeps one.
Null texts count as empty texts; the language stage rejects them, since they have no letters.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obsengine.llm import bpe, jaccard, langid, mixing, toxicity
from obsengine.llm.columns import row_digest
from obsengine.llm.queries import (
    BYTE_BPE,
    MIX_LEVELS,
    MIX_WEIGHTS,
    language_model,
    toxicity_lexicon,
    with_tree,
)
from obsengine.session import fresh_folder

#: The models of two stages are learned, so SQL cannot express the rows of ``run``.
ORACLE_SQL = None

#: Share of the tokens that reach the mixing stage which it keeps.
MIX_SHARE = 0.8


def _judged(docs: DataFrame, judge) -> DataFrame:
    """Rows that ``judge`` keeps; its columns never meet those of ``docs`` by name."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = judge(docs.toDF(*names), names[docs.columns.index("text")])
    return plain.select(*names).toDF(*docs.columns)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose toxicity score reaches 0.5."""
    lexicon = toxicity_lexicon(spark, sf_dir, docs)
    return _judged(docs, lambda rows, text: toxicity.score(rows, lexicon, text).where("predicted = 0"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters or unlike every language learned from the others."""
    model = language_model(docs)
    return _judged(docs, lambda rows, text: langid.predict(rows, model, text).where("not rejected"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of similar texts, the one with the smallest id."""
    return jaccard.first_of_groups(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what the target weights choose; the last text of a leaf is cut to its words."""
    leaf = [F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("")) for c in ("lang", "source")]
    marked = docs.withColumn("__row", F.md5(F.concat_ws("/", row_digest("doc_id", "text"), *leaf)))
    tree = with_tree(marked, "__row")
    chosen = mixing.mix(tree, MIX_LEVELS, MIX_WEIGHTS, MIX_SHARE, key="__row")
    # Rows equal in id, text and leaf share a digest: as many of them are kept as were chosen.
    chosen = chosen.groupBy("__row").agg(
        F.count(F.lit(1)).alias("__chosen"),
        F.min("taken").alias("__least"),
        F.max("n_tokens").alias("__words"),
    )
    turn = F.row_number().over(Window.partitionBy("__row").orderBy("__row"))
    rows = (
        marked.join(chosen, "__row").withColumn("__turn", turn).where("__turn <= __chosen")
    )
    words = F.regexp_extract_all("text", F.lit("[ \\t\\n\\r\\f\\x0B]*[^ \\t\\n\\r\\f\\x0B]+"), F.lit(0))
    cut = F.array_join(F.slice(words, F.lit(1), F.col("__least").cast("int")), "")
    last = (F.col("__turn") == F.col("__chosen")) & (F.col("__least") < F.col("__words"))
    return (
        rows.withColumn("text", F.when(last, cut).otherwise(F.col("text")))
        .withColumn("n_chars", F.when(last, F.length("text")).otherwise(F.col("n_chars")))
        .select(*docs.columns)
    )


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text that is left, with digests of the ids and of the decoded text."""
    rows = docs.select("doc_id", "lang", "source", "text")
    return bpe.round_trip_digests(rows, BYTE_BPE, with_ids=True)


STAGES = [
    ("toxicity", toxicity_stage),
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("bpe", encode_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = fresh_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
