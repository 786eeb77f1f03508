"""The operators of this package applied to whole test tables."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsengine.llm import (
    bpe,
    embeddings,
    extraction,
    jaccard,
    langid,
    licenses,
    merkle,
    mixing,
    rans,
    rollup,
    spotsigs,
    toxicity,
    trie,
)
from obsengine.llm.columns import id_remainder
from obsengine.llm.components import settled
from obsengine.session import fresh_folder

Query = Callable[[SparkSession, str], DataFrame]

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_rans(spark, folder):
    documents = _table(spark, folder, "documents")
    files = rans.write_folder(documents, fresh_folder(spark, "rans"), BYTE_BPE, end_id=2)
    return rans.read_folder(spark, files, with_ids=False)


def op2_embeddings(spark, folder):
    return embeddings.near_duplicates(_table(spark, folder, "embeddings"))


def op3_licenses(spark, folder):
    return licenses.summarise(_table(spark, folder, "documents"))


#: Target weights of the mix; sources that are not named weigh the same.
MIX_LEVELS = ["domain", "lang", "source"]
MIX_WEIGHTS = {
    "domain": {"web": 4, "books": 3, "code": 2, "news": 1},
    "lang": {"en": 5, "de": 2, "fr": 2, "es": 1},
}
#: The domain of a source, by the number in its name.
DOMAIN = """case try_cast(regexp_extract(source, '([0-9]+)$', 1) as int) % 4
  when 0 then 'web' when 1 then 'books' when 2 then 'code' when 3 then 'news' end"""


def with_tree(documents: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key``, the levels of the tree and the number of words of every document."""
    return documents.select(
        key,
        F.expr(DOMAIN).alias("domain"),
        "lang",
        "source",
        mixing.word_count(F.col("text")).alias("n_tokens"),
    )


def op4_mixing(spark, folder):
    documents = with_tree(_table(spark, folder, "documents"))
    return mixing.mix(documents, MIX_LEVELS, MIX_WEIGHTS, share=0.6, max_epochs=3)


#: Patterns whose matches are the tokens of two tokenizer versions.
SPACED = "[^ \\t\\n\\r\\f\\x0B]+"
MARKED = "[^ \\t\\n\\r\\f\\x0B.,!?]+|[.,!?]"


def op6_rollup(spark, folder):
    """Loads all documents under two versions, withdraws later copies, revises texts with digits.

    The second batch is delivered twice.  Revised texts count every digit by itself.
    Null texts are copies of each other; of rows that share a text and an id one stays.
    """
    work = fresh_folder(spark, "rollup")
    text = F.col("text")
    spaced, marked = (
        F.coalesce(F.regexp_count(text, F.lit(p)), F.lit(0)).cast("long")
        for p in (SPACED, MARKED)
    )
    digits = F.coalesce(F.regexp_count(text, F.lit("[0-9]")), F.lit(0)).cast("long")
    _table(spark, folder, "documents").select(
        "doc_id", "source", "lang", F.coalesce(F.md5(text), F.lit("")).alias("digest"),
        F.monotonically_increasing_id().alias("row"),
        spaced.alias("spaced"), marked.alias("marked"), digits.alias("digits"),
    ).write.parquet(f"{work}/counts")
    counts = spark.read.parquet(f"{work}/counts")
    # The first row of a digest; rows of one id are told apart by their written number.
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))["row"]
    repeated = counts.groupBy("digest").agg(least.alias("first"), F.count(F.lit(1)).alias("n"))
    # Written first, so that the join meets two plain shuffles and a digest of many copies splits.
    repeated = settled(repeated.where("n > 1").drop("n"), f"{work}/repeated")
    marked_copies = settled(counts.join(repeated, "digest", "left"), f"{work}/marked")
    copies = marked_copies.where("row <> first")
    originals = marked_copies.where("(first is null or row = first) and digits > 0")
    none = F.lit(None).cast("long")

    def both(rows: DataFrame, op: str, old: bool) -> DataFrame:
        version = F.explode(
            F.array(
                F.struct(F.lit("spaced-1").alias("version"), F.col("spaced").alias("n")),
                F.struct(F.lit("marked-1").alias("version"), F.col("marked").alias("n")),
            )
        )
        flat = rows.select("source", "lang", version.alias("v"))
        new, gone = (none, F.col("v.n")) if old else (F.col("v.n"), none)
        return flat.select(
            F.lit(op).alias("op"), "source", "lang", "v.version",
            new.alias("n_tokens"), gone.alias("old_tokens"),
        )

    revised = originals.select(
        F.lit("revise").alias("op"), "source", "lang", F.lit("marked-1").alias("version"),
        (F.col("marked") + F.col("digits")).alias("n_tokens"), F.col("marked").alias("old_tokens"),
    )
    totals = rollup.TokenRollup(spark, f"{work}/totals")
    totals.apply("load", both(counts, "insert", old=False))
    totals.apply("copies", both(copies, "delete", old=True))
    totals.compact()
    totals.apply("copies", both(copies, "delete", old=True))
    totals.apply("digits", revised)
    return totals.totals()


def language_model(documents: DataFrame) -> langid.Model:
    """Fitted on the documents that are not held out (crc32 of the id modulo 4 is not 2)."""
    return langid.fit(documents.where(id_remainder("doc_id", 4) != 2))


def op5_langid(spark, folder):
    documents = _table(spark, folder, "documents")
    rows = documents.select(
        "doc_id", (id_remainder("doc_id", 4) == 2).alias("held_out"), "text"
    )
    return langid.predict(rows, language_model(documents)).drop("text")


def op7_bpe(spark, folder):
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    return bpe.round_trip_digests(documents, BYTE_BPE)


def toxicity_lexicon(spark: SparkSession, folder: str, documents: DataFrame) -> toxicity.Lexicon:
    """Learned from the labels that are not held out (crc32 of the id modulo 5 is not 0)."""
    labels = _table(spark, folder, "labels").where(id_remainder("doc_id", 5) != 0)
    return toxicity.fit(documents.select("doc_id", "text"), labels)


def op8_toxicity(spark, folder):
    documents = _table(spark, folder, "documents")
    rows = documents.select(
        "doc_id", (id_remainder("doc_id", 5) == 0).alias("held_out"), "text"
    )
    return toxicity.score(rows, toxicity_lexicon(spark, folder, documents)).drop("text")


def op9_jaccard(spark, folder):
    return jaccard.jaccard_groups(_table(spark, folder, "documents"))


def op10_spotsigs(spark, folder):
    documents = _table(spark, folder, "documents")
    # A slice is sorted by id in one task: about 4,000 documents, more from 400 million on.
    slices = min(100_000, max(1, round(documents.count() / 4000)))
    rows = spotsigs.with_next(
        documents, slices, derive=lambda d: spotsigs.with_signatures(d, "text", "own")
    )
    edit = spotsigs.edited(F.col("text"), F.col("next_text"))
    texts = rows.select(
        "doc_id", "own", "next_own", F.length("text").cast("long").alias("n_chars"),
        edit.alias("edited"),
    )
    compared = spotsigs.with_signatures(texts, "edited", "changed").withColumn(
        "edited_sha256", F.sha2(F.col("edited").cast("binary"), 256)
    )
    return compared.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        spotsigs.fingerprint(F.col("own")).alias("fingerprint"),
        spotsigs.fingerprint(F.col("changed")).alias("edited_fingerprint"),
        spotsigs.likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        spotsigs.likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )


MERKLE_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op11_merkle(spark, folder):
    """A third of the rows, by crc32 of the id, are altered after the manifest is made."""
    lowered = F.when(id_remainder("doc_id", 3) == 0, F.translate("text", _UPPER, _LOWER))
    documents = _table(spark, folder, "documents")
    manifest = merkle.manifest_of(documents, "doc_id", "lang", MERKLE_FIELDS, {"text": lowered})
    return merkle.prove(manifest).withColumnRenamed("id", "doc_id")


def op12_trie(spark, folder):
    turns = _table(spark, folder, "conversations")
    convs = settled(trie.sequences(turns), f"{fresh_folder(spark, 'conversations')}")
    rebuilt = trie.with_shared_starts(convs, id_remainder("conv_id", 6), most=5)
    return trie.nodes(rebuilt)


def op13_extraction(spark, folder):
    pages = _table(spark, folder, "pages").select("page_id", "url", "html")
    return extraction.extract(pages, weights=extraction.fit(pages)).drop("html")


QUERIES: dict[str, Query] = {
    "op1_rans": op1_rans,
    "op2_embeddings": op2_embeddings,
    "op3_licenses": op3_licenses,
    "op4_mixing": op4_mixing,
    "op5_langid": op5_langid,
    "op6_rollup": op6_rollup,
    "op7_bpe": op7_bpe,
    "op8_toxicity": op8_toxicity,
    "op9_jaccard": op9_jaccard,
    "op10_spotsigs": op10_spotsigs,
    "op11_merkle": op11_merkle,
    "op12_trie": op12_trie,
    "op13_extraction": op13_extraction,
}
