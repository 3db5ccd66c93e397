"""Composite pipelines of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trisieve.functions import text as t
from trisieve.functions.keys import numbered, pair_hash, stable_id
from trisieve.functions.similarity import overlap_ratio
from trisieve.operators import chunk, quality
from trisieve.operators.lexical import lexical_negatives
from trisieve.operators.select import best_per_key, row_index, top_per_key
from trisieve.runtime import materialize


def clean_english(df: DataFrame, version: str = "v1") -> DataFrame:
    """Every row with cleaned texts, `reason` (null if accepted), ids, lexical score and `changed`."""
    fields = ["anchor", "positive", "hard_negative"]
    out = df.select("data_id", "source", "source_revision", "source_split", F.col("source_row_index").cast("string").alias("source_row_index"), "domain", "task_type", *fields, *[t.mended(F.coalesce(F.col(c), F.lit(""))).alias(f"_{c}") for c in fields])
    a, p, n = (F.col(f"_{c}") for c in fields)
    changed = ~(a.eqNullSafe(F.col("anchor")) & p.eqNullSafe(F.col("positive")) & n.eqNullSafe(F.col("hard_negative")))
    out = out.withColumns({"reason": quality.reject_reason(a, p, n), "changed": changed, "pair_hash": pair_hash(F.col("source"), a, p), "hard_negative_score": overlap_ratio(a, n), "cleaning_version": F.lit(version)})
    out = out.withColumn("clean_id", F.concat(F.lit("en_clean_"), F.substring("pair_hash", 1, 24)))
    return out.drop(*fields).withColumnsRenamed({f"_{c}": c for c in fields})


def best_english(cleaned: DataFrame) -> DataFrame:
    """Of the accepted rows the one with the highest score for each pair; ties go to source and row order."""
    rows = cleaned.filter("reason IS NULL")
    return best_per_key(rows, ["pair_hash"], [F.desc("hard_negative_score"), F.col("source"), F.col("source_row_index").cast("bigint"), F.col("data_id")])


def one_per_title(df: DataFrame, preferred: str) -> DataFrame:
    """Legal candidates without repeats of a pair or a title, with their ranking columns."""
    a, p, title = F.col("anchor"), F.col("positive"), F.col("title")
    rows = df.filter(quality.legal_pair(title, a, p)).select("data_id", "source", "title", "anchor", "positive", quality.mentions_title(title, p).alias("title_in_positive"), quality.ends_sentence(p, ".!…").alias("ends_sentence"), F.md5("data_id").alias("stable_order"))
    tail = [F.desc("title_in_positive"), F.desc("ends_sentence")]
    rows = best_per_key(rows, ["anchor", "positive"], [*tail, F.col("stable_order")])
    rows = rows.withColumn("_title", F.lower(t.collapse(F.col("title"))))
    return best_per_key(rows, ["_title"], [F.when(F.col("source") == preferred, 0).otherwise(1), *tail, F.abs(F.length("positive") - 450), F.col("stable_order")]).drop("_title")


def hybrid_rows(selected: DataFrame, table: str, task: str, synthetic: bool, score: int) -> DataFrame:
    """Selected pairs in the form of the hybrid training table."""
    return selected.filter(quality.clean_pair(t.nfc_collapsed(F.col("anchor")), t.nfc_collapsed(F.col("positive")))).select(
        stable_id("hybrid_", F.lit(table), F.col("source"), F.col("data_id")).alias("data_id"), F.lit("train").alias("split"), F.lit(task).alias("task_type"), F.lit(synthetic).alias("is_synthetic"), F.lit(score).alias("quality_score"),
        F.lit(table).alias("source_table"), "source", F.col("data_id").alias("source_data_id"), F.nullif(F.trim("title"), F.lit("")).alias("title"), t.nfc_collapsed(F.col("anchor")).alias("anchor"), t.nfc_collapsed(F.col("positive")).alias("positive"), F.lit(None).cast("string").alias("hard_negative"),
    )


def clean_export(df: DataFrame, order_by: list[str]) -> DataFrame:
    """Plain texts with `reason`; accepted repeats after the first get the reason 'duplicate'."""
    from trisieve.functions.keys import folded_digest

    fields = ["anchor", "positive", "hard_negative"]
    out = df.select(*[c for c in df.columns if c not in fields], *[t.plain_text(F.col(c)).alias(c) for c in fields])
    out = out.withColumn("reason", quality.export_reason(*[F.col(c) for c in fields]))
    out = out.withColumn("_key", F.when(F.col("reason").isNull(), folded_digest(*[F.col(c) for c in fields])))
    ranked = top_per_key(out.filter("reason IS NULL"), ["_key"], [F.col(c) for c in order_by], 1 << 62, rank="_rank")
    ranked = ranked.withColumn("reason", F.when(F.col("_rank") > 1, "duplicate")).drop("_rank")
    return ranked.unionByName(out.filter("reason IS NOT NULL")).drop("_key")


def rebuild_documents(df: DataFrame, size: int = 384, overlap: int = 48, least: int = 80, profile: str = "document") -> DataFrame:
    """General rows rebuilt: islands of one title are stitched, cleaned, chunked anew and get questions and negatives.

    Rows of a source are ordered by id; a blank title makes a document of its own. Output: data_id,
    source, title, topic, anchor, positive, hard_negative.
    """
    rows = chunk.islands(df, ["title"], ["data_id"], ["source"], blank_key="title")
    stitched = chunk.stitch(rows, ["source", "island"], ["data_id"], "positive", overlap, 32)
    heads = rows.groupBy("source", "island").agg(F.min_by(F.struct("title", "topic", "anchor"), "data_id").alias("head"), F.min("data_id").alias("first_id"))
    docs = stitched.join(heads, ["source", "island"]).select("source", "first_id", "head.*", t.wiki_clean(F.col("document"), profile).alias("document"))
    docs = docs.withColumn("chunks", chunk.word_chunks(size, overlap, least)(F.col("document"))).filter(F.size("chunks") > 0)
    docs = materialize(row_index(docs, ["first_id", "source"], "doc"), "rebuilt")
    negatives = lexical_negatives(docs.withColumn("passage", F.col("chunks")[0]), "doc", "title", "document", "passage").select(F.col("id").alias("doc"), "hard_negative")
    anchor = quality.title_question(F.col("title"), F.col("anchor"))
    cut = docs.join(negatives, "doc").select("doc", "source", "title", "topic", anchor.alias("anchor"), "hard_negative", F.posexplode("chunks").alias("k", "positive"))
    data_id = F.concat(numbered("data_clean_", F.col("doc") + 1, 7), F.lit("_"), F.lpad((F.col("k") + 1).cast("string"), 4, "0"))
    return cut.select(data_id.alias("data_id"), "source", "title", "topic", "anchor", "positive", "hard_negative")
