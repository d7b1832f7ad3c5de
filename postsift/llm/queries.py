"""One query per operator, over the whole table it is meant for; each derives its digest columns from the operator's output."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postsift.llm import bpe, convrepair, htmltext, lexsearch, linededup, nearvec, ngramjoin, packing, quality, suffixdedup, tokencounts, topk, warc
from postsift.llm.common import Scratch, by_key, table

#: Documents below this quality score are rejected.
KEEP_SCORE = 0.3
LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    LLM_QUERIES[f.__name__] = f
    return f


@query
def op1_line_dedup(spark, sf):
    """Drop long lines that five documents or more hold, but in the last of them."""
    docs = by_key(table(spark, sf, "documents"), {"doc_id": "doc_id", "text": "text"})
    done = linededup.line_dedup(docs)
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op2_bpe(spark, sf):
    """Encode every text with the lower-casing vocabulary and decode the ids again."""
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = by_key(table(spark, sf, "documents"), {"doc_id": "doc_id", "text": "text"})
    ids = bpe.encode(docs, path).select("doc_id", "ids")
    done = bpe.decode(ids, path)
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op3_html(spark, sf):
    """Main text of every page."""
    pages = by_key(table(spark, sf, "pages"), {"page_id": "page_id", "url": "url", "html": "html"})
    done = htmltext.extract(pages).select("page_id", "url", "text")
    return done.withColumn("n_chars", F.length("text").cast("long"))


@query
def op4_near_vectors(spark, sf):
    """Links and components of vectors of the same label with a cosine of 0.98 or more."""
    return nearvec.near_duplicates(table(spark, sf, "embeddings")).withColumnRenamed("id", "vec_id")


@query
def op5_warc(spark, sf):
    """Archive every page, payloads once, and read the archives back."""
    scratch = Scratch(spark, "warc")
    html = F.coalesce(F.col("html"), F.lit(""))
    pages = table(spark, sf, "pages").select("page_id", "url", F.encode(html, "UTF-8").alias("payload"))
    marked = warc.mark_revisits(pages, "page_id", "payload", scratch.written)

    def urn(c):
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))

    archived = marked.select(
        urn("page_id").alias("record_id"),
        "record_type",
        F.col("url").alias("target_uri"),
        F.lit("2026-01-01T00:00:00Z").alias("date"),
        F.when(F.col("refers_to").isNotNull(), urn("refers_to")).alias("refers_to"),
        F.concat(F.lit("sha1:"), F.col("payload_digest")).alias("payload_digest"),
        F.length("payload").cast("long").alias("payload_length"),
        "payload",
    )
    warc.write_warc(archived, scratch.path("archive"))
    back = warc.read_warc(spark, scratch.path("archive")).where(F.col("record_type").isin("response", "revisit"))

    def page(c):
        return F.regexp_extract(c, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")

    whole = F.col("record_type") == "response"
    return back.select(
        page("record_id").alias("page_id"),
        F.when(whole, F.length("payload")).otherwise(F.col("payload_length")).cast("long").alias("payload_bytes"),
        F.when(whole, warc.base32_sha1(F.col("payload"))).otherwise(F.substring("payload_digest", 6, 32)).alias("payload_digest"),
        "record_type",
        page("refers_to").alias("refers_to"),
    )


@query
def op6_top_k(spark, sf):
    """The ten best partners, by integer inner product, of every hundredth vector."""
    vectors = by_key(table(spark, sf, "embeddings"), {"vec_id": "vec_id", "embedding": "embedding"})
    return topk.top_k(vectors, F.col("vec_id") % 100 == 0)


@query
def op7_quality(spark, sf):
    """Score every document by rules learned from the labelled ones."""
    scratch = Scratch(spark, "quality")
    docs = by_key(table(spark, sf, "documents"), {"doc_id": "doc_id", "text": "text"})
    stats = scratch.written(quality.with_statistics(docs).drop("text"), "statistics", waves=8)
    model = quality.fit(stats, table(spark, sf, "labels"))
    scored = stats.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= KEEP_SCORE).cast("int"))


@query
def op8_token_counts(spark, sf):
    """Documents and tokens over, and tokens left within, every context limit."""
    scratch = Scratch(spark, "counts")
    docs = by_key(table(spark, sf, "documents"), {"text": "text"})
    lengths = tokencounts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json")).select("n_tokens")
    return tokencounts.limits(scratch.written(tokencounts.histogram(lengths), "histogram", waves=2))


@query
def op9_packing(spark, sf):
    """Pack all documents into sequences of at most 2048 tokens."""
    scratch = Scratch(spark, "packing")
    pieces = packing.cut(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    pieces = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(scratch.written(pieces, "pieces", waves=8))


@query
def op10_ngram_join(spark, sf):
    """Components of documents whose sets of five-word shingles are similar."""
    return ngramjoin.jaccard_join(table(spark, sf, "documents")).withColumnRenamed("doc", "doc_id")


@query
def op11_conversation_repair(spark, sf):
    """Damage every conversation, find its faults and repair it."""
    whole = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    space = F.lit(" ")
    conv, turn = (F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn"))
    damage = whole.withColumn("damage", F.crc32(F.encode(F.concat(conv, F.lit(":"), turn), "UTF-8")) % 20).where("damage <> 0")
    role, text = (F.coalesce(F.col(c).cast("string"), space) for c in ("role", "text"))
    text = F.when(F.col("damage") == 1, "").when(F.col("damage") == 2, F.translate(text, ".!?", "")).otherwise(text)
    rows = damage.select("conv_id", "turn", F.when(F.col("damage") == 4, "user").otherwise(role).alias("role"), text.alias("text"), "damage")
    rows = rows.union(rows.where("damage = 3")).drop("damage")  # a copy has its row's turn, and so its place
    done = convrepair.repair(rows, listed=whole.select("conv_id"))
    digests = done.digests().withColumnRenamed("conv", "c")
    found = done.conversations.join(digests, F.col("conv").eqNullSafe(F.col("c"))).drop("c")
    return found.withColumnRenamed("conv", "conv_id")


@query
def op12_suffix_dedup(spark, sf):
    """Remove what strings of 400 bytes that start twice cover."""
    done = suffixdedup.remove_repeats(table(spark, sf, "documents"))
    spans, digest = F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    return done.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", spans, digest)


@query
def op13_lexical_search(spark, sf):
    """The ten documents that match each benchmark item best."""
    found = lexsearch.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.withColumnsRenamed({"item": "item_id", "doc": "doc_id"})
