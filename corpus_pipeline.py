"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the last return the columns
of documents. `run` writes each stage's result as Parquet in the shared folder and reads it back for the next.
"""

from __future__ import annotations

from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm import decontaminate, line_dedup, packing, simhash_dedup, toxicity
from tallyweave.llm.common import Scratch, free_name, read_table, with_row_keys
from tallyweave.llm.queries import MAX_TOKENS, PACK_END_ID, SIMHASH_BITS, SIMHASH_WORDS, toxicity_chain, word_tokenizer

#: Folders that the stages of a run have made; the run removes them once the stage's result is written, or has failed.
_made: ContextVar[list[Scratch] | None] = ContextVar("made", default=None)


def _scratch(spark: SparkSession, name: str) -> Scratch:
    scratch = Scratch(spark, f"pipeline-{name}")
    if (made := _made.get()) is not None:
        made.append(scratch)
    return scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain doesn't find toxic.

    Null and empty texts are scored as texts without words. Each row is judged by its text alone, so equal rows go or
    stay together, whatever their ids. A long text costs time in proportion. An empty table gives an empty one.
    """
    return toxicity.without_toxic(docs, toxicity_chain(spark, docs, sf_dir, _scratch(spark, "toxicity")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat an earlier one; a document whose lines all went goes too, one that was blank stays.

    Rows are documents of their own, also where they share an id or have none: of equal rows with text one stays. Null, empty and
    long texts, ties and empty tables are treated as `line_dedup.without_repeated_lines` states.
    """
    held = free_name(docs, "held_n_dropped")
    cut = line_dedup.without_repeated_lines(docs.withColumnRenamed("n_dropped", held), _scratch(spark, "lines"))
    changed = F.col("n_dropped") > 0
    kept = cut.where(~(changed & (F.trim(F.regexp_replace("text", r"\s+", " ")) == "")))
    kept = kept.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return kept.drop("n_dropped").withColumnRenamed(held, "n_dropped").select(*(f"`{c}`" for c in docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash group: that with the smallest id, then the first; rows without an id come last.

    Rows are told apart by a key of their own, so a row goes only if itself resembles another: rows that share an id don't
    go together, and of equal rows one stays. Null and empty texts have fingerprint zero and are one group. A long text
    costs time in proportion. An empty table gives an empty one.
    """
    scratch = _scratch(spark, "simhash")
    keyed, key = with_row_keys(docs, scratch)
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id"), F.col(key).alias("key"))
    groups = simhash_dedup.simhash_groups(keyed.select(place.alias("place"), "text"), SIMHASH_WORDS, SIMHASH_BITS, scratch, id_column="place")
    gone = groups.where("place <> component_id").select(F.col("place.key").alias(key))
    return keyed.join(gone, key, "left_anti").select(*(f"`{c}`" for c in docs.columns))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark passage is found.

    Null and empty texts hold none and stay; each row is judged by its text alone, whatever its id. A long text costs time in
    proportion. An empty table gives an empty one; with an empty benchmark all rows stay.
    """
    return decontaminate.without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of related ones.

    Null, empty and long texts, repeated rows, ties and empty tables are treated as `packing.pack_documents` states.
    """
    return packing.pack_documents(docs, word_tokenizer(), PACK_END_ID, MAX_TOKENS, _scratch(spark, "packing"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("packing", pack_sequences),
]

#: SQL has neither the classifier, nor XXH64, nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result, read from the shared folder. Nothing else that the run wrote is left, also when it fails."""
    results, made = Scratch(spark, "pipeline"), []
    held = _made.set(made)
    try:
        docs = read_table(spark, sf_dir, "documents")
        for number, (_, stage) in enumerate(STAGES):
            docs = results.write(stage(spark, docs, sf_dir), str(number))
            while made:
                made.pop().remove()
            if number:
                results.remove(str(number - 1))
        return docs
    except BaseException:
        results.remove()
        raise
    finally:
        _made.reset(held)
        while made:
            made.pop().remove()
