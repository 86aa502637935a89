"""Registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tripledger.llm import (
    decontam,
    dedup,
    langid,
    licenses,
    mixing,
    neighbours,
    periodic,
    pii,
    resampling,
    simhash,
    trie_lm,
    urlfilter,
    warc,
)
from tripledger.llm.common import full_text, stage, table
from tripledger.llm.oracle import ORACLE

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
_REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(function):
    _REGISTRY[function.__name__] = function
    return function


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_REGISTRY)


@_query
def op1_warc(spark, folder):
    """A record per page, written to archives in the shared folder and read back."""
    warc.register(spark)
    path = stage(spark).path("warc")
    warc.page_records(table(spark, folder, "pages")).write.format("warc").mode("append").save(path)
    return warc.read_pages(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query
def op2_lm_score(spark, folder):
    """Every text under the trigram model of four fifths of them."""
    docs = table(spark, folder, "documents")
    levels = trie_lm.learn(docs.where(~trie_lm.held_out(F.col("doc_id"))), stage(spark))
    return trie_lm.score(docs, levels)


@_query
def op3_personal_data(spark, folder):
    """All spans of every text; the four base kinds are counted and hashed."""
    found = pii.find(table(spark, folder, "documents"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("found", lambda s: s["kind"].isin(*pii.ALWAYS))

    def count(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, pii.ALWAYS), F.sha2(F.encode(joined(base), "UTF-8"), 256).alias("base_sha256"),
                        joined(F.col("found")).alias("spans"))


@_query
def op4_exact_dedup(spark, folder):
    """One row per document, the largest doc_id of equal texts stays."""
    return dedup.marked(table(spark, folder, "documents"), stage(spark), largest=True)


@_query
def op5_decontamination(spark, folder):
    """Every pair of a document and a benchmark item that it holds, up to a fifth of its words."""
    found = decontam.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"),
                                  stage(spark))
    return found.select("doc_id", "item_id").distinct()


@_query
def op6_language_id(spark, folder):
    """The language of every document, from its text, its declared one and its source."""
    found = langid.documents(table(spark, folder, "documents"), stage(spark))
    return found.select("doc_id", "declared", "language", F.round("confidence", 6).alias("confidence"), "kept")


@_query
def page_language(spark, folder):
    """The language of every page, from its text, the one its markup declares, its address and its
    host, under the model of the documents."""
    docs = table(spark, folder, "documents")
    model = langid.fit(docs.select("text", F.lower("lang").alias("label")), stage(spark))
    found = langid.identify(langid.page_rows(table(spark, folder, "pages")), model, stage(spark))
    return found.select("page_id", "declared", "host", "suffix", "language",
                        F.round("confidence", 6).alias("confidence"), "kept")


@_query
def op7_url_filter(spark, folder):
    """Every page's url against the rules and a list. The tables hold no list; it is made of the
    canonical URLs, over all pages, whose MD5 starts with a zero, about one in sixteen."""
    pages = table(spark, folder, "pages")
    listed = pages.where(F.substring(F.md5(F.encode(urlfilter.canonical(F.col("url")), "UTF-8")),
                                     1, 1) == "0").select("url")
    return urlfilter.judge(pages, listed, RULES, stage(spark)).select(
        "page_id", "host", "path", "rule", "verdict")


@_query
def op8_simhash(spark, folder):
    """Fingerprints of 4-word shingles, linked at up to four differing bits."""
    found = simhash.classes(table(spark, folder, "documents"), stage(spark), width=4, radius=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        "component_id")


@_query
def op9_source_mix(spark, folder):
    """All documents mixed to weights 3, 1, 2 in turn, 150 % of all words, at most two copies."""
    found = mixing.mix(table(spark, folder, "documents"), stage(spark), weights=[3, 1, 2],
                       share=1.5, cap=2.0)
    return found.select("doc_id", "size", "source_size", "target",
                        (F.col("size") * F.col("copies")).alias("taken"))


@_query
def op10_license_scan(spark, folder):
    """Words, base phrases and all labels of every text."""
    return licenses.scan(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"),
        "score")


@_query
def op11_importance_resampling(spark, folder):
    """Weight and score of every document towards the benchmark's words, and the tenth drawn."""
    return resampling.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"), stage(spark))


@_query
def op12_nearest_neighbours(spark, folder):
    """The ten nearest of all vectors to each whose id is divisible by 100."""
    rows = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return neighbours.nearest(rows, rows.where("id % 100 = 0"), stage(spark), k=10)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with runs planted into the texts of about a tenth of the ids, as the query
    on runs asks: from word a on, a stretch of p words is repeated to the end. A null id is left."""
    h = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    words = F.filter(F.split(full_text(), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    n, a = F.size("words"), (F.col("g") % F.size("words")).cast("int")
    rows = rows.select("doc_id", "text", "g", "words", F.when(n > 0, a).alias("a"))
    p = (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    rows = rows.select("doc_id", "text", "words", "a", p.alias("p"))
    again = F.transform(F.sequence(F.lit(0), F.size("words") - F.col("a") - 1),
                        lambda k: F.element_at("words", F.col("a") + k % F.col("p") + 1))
    planted = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), again), " ")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


@_query
def op13_periodic_runs(spark, folder):
    """Runs of every document, with planted ones, and the digest of the text without them."""
    found = periodic.find(with_planted_runs(table(spark, folder, "documents")), stage(spark))
    # The greatest length / period, compared as whole numbers; ties to the first in order.
    best = F.aggregate("runs", F.element_at("runs", 1), lambda b, r: F.when(
        r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    some = F.size("runs") > 0
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.when(some, best).alias("best"),
                        F.sha2(F.encode(lines, "UTF-8"), 256).alias("runs_sha256"), F.col("digest").alias("collapsed_sha256"))
    return rows.select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                       F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
                       "runs_sha256", "collapsed_sha256")


@_query
def pipeline(spark, folder):
    """All stages of the corpus pipeline."""
    return corpus_pipeline.run(spark, folder)


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, sql in ORACLE.items() if name in _REGISTRY}
