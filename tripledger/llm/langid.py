"""Language identification by Bayesian fusion of evidence.

For each language, four kinds of evidence add up as log probabilities: the text under a naive
Bayes model of byte trigrams, the declared markup language, the suffix of the address, and a
prior of the host. Neighbouring trigrams repeat each other, so the text counts as ``weight``
trigrams at most. Host priors come from one grouped aggregation of the texts' own posteriors over
all rows: a host is smoothed towards its parent domain, and that towards the whole table.
One more class, ``und``, holds text that is no language: each trigram is equally likely there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripledger.llm.common import full_text, row_key, without
from tripledger.llm.tokens import ALNUM, slices
from tripledger.llm.urlfilter import host_of
from tripledger.staging import Staging

BUCKETS = 1 << 15
NONE = "und"
PIECE = 1 << 20
LETTERS = np.zeros(256, np.uint32)
LETTERS[ALNUM] = np.flatnonzero(ALNUM)
LETTERS[48:58] = 0
# Languages an address suffix speaks for; other suffixes say nothing.
SUFFIXES = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "it": "it", "pt": "pt",
            "br": "pt", "nl": "nl", "pl": "pl", "ru": "ru", "jp": "ja", "cn": "zh", "uk": "en", "us": "en",
            "au": "en", "ie": "en"}


def markup_language(html: Column) -> Column:
    """The primary code in ``lang`` of the first ``html`` element, wherever it stands, in lower case;
    null without one."""
    found = F.lower(F.regexp_extract(html, r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z]{2,3})""", 1))
    return F.when(found != "", found)


def suffix_language(host: Column) -> Column:
    suffix = F.lower(F.element_at(F.split(host, r"\."), -1))
    table = F.create_map(*[F.lit(x) for pair in SUFFIXES.items() for x in pair])
    return F.try_element_at(table, suffix)


def _trigrams(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The bucket of the trigram that starts at each byte, ``BUCKETS`` where there is none: over
    the end of a text, or with fewer than two letters. All others count as one blank."""
    codes = LETTERS[data]
    found = np.full(len(data), BUCKETS, np.int32)
    if len(data) > 2:
        a, b, c = codes[:-2], codes[1:-1], codes[2:]
        key = ((a << np.uint32(16)) | (b << np.uint32(8)) | c) * np.uint32(2654435761)
        found[:-2] = np.where((a | c) * b | (a & c) != 0, (key >> np.uint32(17)).astype(np.int32), BUCKETS)
        ends = bounds[1:]
        for back in (1, 2):
            at = ends - back
            found[at[at >= bounds[:-1]]] = BUCKETS
    return found


def _chosen(labelled: DataFrame, rows: int, seed: int, staging: Staging) -> DataFrame:
    """At most ``rows`` distinct texts of each label, those of the least hashes, once each. Only
    hashes are ranked, and each task passes on no more than ``rows`` of a label."""
    hashed = labelled.select("label", F.xxhash64(F.lit(seed), "text").alias("hash"))
    best = Window.partitionBy("label").orderBy("hash")
    some = hashed.distinct().withColumn("_place", F.row_number().over(best)).where(F.col("_place") <= rows)
    some = staging.put(some.select(F.col("label").alias("_label"), F.col("hash").alias("_hash")), "chosen")
    own = labelled.select("label", "text", F.xxhash64(F.lit(seed), "text").alias("hash"))
    return own.join(some, (F.col("label") == F.col("_label")) & (F.col("hash") == F.col("_hash")), "left_semi").groupBy(
        "label", "hash").agg(F.first("text").alias("text")).select("label", "text")


def fit(labelled: DataFrame, staging: Staging, rows: int = 5_000, seed: int = 5) -> dict[str, np.ndarray]:
    """Log probabilities of the buckets for each language of ``text`` and ``label``.

    Fitted on at most ``rows`` distinct texts of each label, chosen by a hash of the text, so every
    label that occurs is learned at any size, and copies count once. Null texts and labels are left
    out; an empty table gives a model of ``und`` alone. Counts are added up by Spark; languages
    times ``BUCKETS`` numbers reach the driver.
    """
    chosen = _chosen(labelled.where("label IS NOT NULL AND text IS NOT NULL"), rows, seed, staging)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            labels = np.array(batch.column("label").to_pylist(), dtype=object)
            for lo, hi, data, bounds in slices(batch.column("text"), PIECE):
                buckets = _trigrams(data, bounds)
                own = np.repeat(np.arange(lo, hi), np.diff(bounds))
                for label in set(labels[lo:hi]):
                    mine = buckets[labels[own] == label] if hi - lo > 1 else buckets
                    add = np.bincount(mine, minlength=BUCKETS + 1)[:BUCKETS]
                    totals[label] = totals.get(label, 0) + add
        for label, n in totals.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([label] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())],
                names=["label", "bucket", "n"])

    counted = chosen.select("text", "label").mapInArrow(count, "label string, bucket int, n long")
    found: dict[str, np.ndarray] = {}
    for label, bucket, n in counted.groupBy("label", "bucket").agg(F.sum("n")).toLocalIterator():
        found.setdefault(label, np.full(BUCKETS, 0.5))[bucket] += n
    model = {k: np.append(np.log(v / v.sum()), 0).astype(np.float32) for k, v in sorted(found.items())}
    model[NONE] = np.append(np.full(BUCKETS, -np.log(BUCKETS)), 0).astype(np.float32)
    return model


def text_evidence(rows: DataFrame, model: dict[str, np.ndarray], weight: int) -> DataFrame:
    """``rows`` with ``text`` replaced by ``grams`` and ``ll``: log likelihoods in the model's order.
    ``rows`` has no other columns of these names."""
    tables = list(model.values())
    keep = [c for c in rows.columns if c != "text"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = np.zeros(batch.num_rows, np.int64)
            sums = np.zeros((batch.num_rows, len(tables)))
            for lo, hi, data, bounds in slices(batch.column("text"), PIECE):
                buckets = _trigrams(data, bounds)
                full = np.flatnonzero(np.diff(bounds)) + lo
                at = bounds[:-1][full - lo]
                if not len(at):
                    continue
                grams[full] = np.add.reduceat((buckets < BUCKETS).astype(np.int64), at)
                for k, one in enumerate(tables):
                    sums[full, k] = np.add.reduceat(one[buckets], at, dtype=np.float64)
            sums *= np.minimum(1.0, weight / np.maximum(grams, 1))[:, None]
            out = [batch.column(c) for c in keep] + [
                pa.array(grams), pa.array(list(sums), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(out, names=[*keep, "grams", "ll"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema.fields)
    return rows.select(*keep, "text").mapInArrow(work, f"{schema}, grams long, ll array<double>")


def _softmax(logs: Column) -> Column:
    top = F.array_max(logs)
    raised = F.transform(logs, lambda x: F.exp(x - top))
    total = F.aggregate(raised, F.lit(0.0), lambda s, x: s + x)
    return F.transform(raised, lambda x: x / total)


def identify(rows: DataFrame, model: dict[str, np.ndarray], staging: Staging, weight: int = 60,
             declared_right: float = 0.8, suffix_right: float = 0.6, smoothing: float = 20.0,
             least: float = 0.5) -> DataFrame:
    """Columns of ``rows`` without ``text``, and ``language``, ``confidence``, ``kept``.

    ``rows`` has ``text``, ``declared``, ``host`` and ``suffix`` besides any others; each may be
    null and then says nothing (a null text is empty). Columns that are called like the three
    results give way to them. A row is kept if a language, not ``und``, has at least ``least`` of
    the posterior. A text without letters has no evidence of its own and is not kept. Repeated rows
    are judged alike. An empty table gives no rows.
    """
    names = list(model)
    keep = [c for c in rows.columns if c not in ("text", "language", "confidence", "kept")]
    # The columns of the caller stay together, apart from those this function works with.
    evidence = rows.select(F.struct(*keep).alias("row"), full_text().alias("text"), "declared", "host", "suffix")
    scored = staging.put(text_evidence(evidence, model, weight), "evidence")
    own = _softmax(F.col("ll"))
    parent = F.when(F.col("host").contains("."), F.regexp_replace("host", r"^[^.]*\.", ""))
    soft = scored.where("grams > 0").select(F.col("host"), parent.alias("parent"), own.alias("p"))
    sums = [F.sum(F.col("p")[i]).alias(f"s{i}") for i in range(len(names))]
    hosts = staging.put(soft.groupBy("host", "parent").agg(*sums), "hosts")

    def counts():
        return F.array(*[F.col(f"s{i}") for i in range(len(names))])

    def again(df: DataFrame, *keys: str) -> DataFrame:
        return df.groupBy(*keys).agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(len(names))])

    def smoothed(n: Column, towards: Column) -> Column:
        total = F.aggregate(n, F.lit(0.0), lambda s, x: s + x)
        return F.zip_with(n, towards, lambda x, t: (x + smoothing * t) / (total + smoothing))
    # The prior of the whole table is one number for each language.
    all_ = [float(x or 0.0) for x in again(hosts).select(*[f"s{i}" for i in range(len(names))]).first()]
    whole = F.array(*[F.lit((x + smoothing / len(names)) / (sum(all_) + smoothing)) for x in all_])
    parents = again(hosts.where("parent IS NOT NULL"), "parent").select(
        F.col("parent").alias("_parent"), smoothed(counts(), whole).alias("above"))
    # Written, so that its size is known: hosts are broadcast only below the session's threshold,
    # and beyond it adaptive execution can split a host that very many rows have.
    priors = staging.put(hosts.where("host IS NOT NULL").join(
        parents, F.col("parent") == F.col("_parent"), "left").select(
        F.col("host").alias("_host"), smoothed(counts(), F.coalesce(F.col("above"), whole)).alias("prior")), "priors")
    joined = scored.join(priors, F.col("host") == F.col("_host"), "left")

    def says(column: str, right: float) -> list[Column]:
        wrong = (1 - right) / max(1, len(names) - 2)
        known = F.col(column).isin(*[n for n in names if n != NONE])
        return [F.when(F.col(column).isNull() | ~known, 0.0).otherwise(
            F.when(F.col(column) == n, float(np.log(right))).otherwise(float(np.log(wrong))))
            if n != NONE else F.when(F.col(column).isNull() | ~known, 0.0).otherwise(
                float(np.log(1 / max(1, len(names) - 1)))) for n in names]
    declared, suffix = says("declared", declared_right), says("suffix", suffix_right)
    prior = F.coalesce(F.col("prior"), whole)
    logs = F.array(*[F.col("ll")[i] + declared[i] + suffix[i] + F.log(prior[i]) for i in range(len(names))])
    # Written, so that a filter on the result does not have Spark write the fusion out once more
    # for each column that the filter needs.
    fused = staging.put(joined.select("row", "grams", _softmax(logs).alias("posterior")), "fused")
    best = F.array_max("posterior")
    language = F.element_at(F.array(*map(F.lit, names)), F.array_position("posterior", best).cast("int"))
    language = F.when(F.col("grams") > 0, language).otherwise(NONE)
    return fused.select("row.*", language.alias("language"), best.alias("confidence"),
                        ((language != NONE) & (best >= least)).alias("kept"))


def document_rows(docs: DataFrame) -> DataFrame:
    """Documents as evidence: ``lang`` is what they declare and ``source`` is their host. Nulls stay
    null; a row for every row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key(*_told(docs)).alias("key"),
                       F.col("text"), F.lower("lang").alias("declared"), F.col("source").alias("host"),
                       suffix_language(F.col("source")).alias("suffix"))


def _told(docs: DataFrame) -> list[Column]:
    """What decides on a document besides its text."""
    return [F.lower("lang"), F.col("source")]


def page_rows(pages: DataFrame) -> DataFrame:
    """Pages as evidence: the html without its elements, the language it declares, the host of the
    url and its suffix. Null html has no text, a null or odd url no host."""
    bare = F.regexp_replace(F.col("html"), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    host = F.nullif(host_of(F.col("url")), F.lit(""))
    return pages.select("page_id", bare.alias("text"), markup_language(F.col("html")).alias("declared"),
                        host.alias("host"), suffix_language(host).alias("suffix"))


def documents(docs: DataFrame, staging: Staging, **how) -> DataFrame:
    """``doc_id``, ``key``, ``declared``, ``host``, ``suffix``, ``language``, ``confidence`` and ``kept`` of every
    row, under a model fitted on the rows' own ``lang``. Nulls, empty texts, repeated rows and empty
    tables as in ``identify``."""
    model = fit(docs.select("text", F.lower("lang").alias("label")), staging)
    return identify(document_rows(docs), model, staging, **how)


def drop_rejected(docs: DataFrame, staging: Staging, **how) -> DataFrame:
    """The rows of ``docs`` whose language is told, with all their columns. Rows without two letters
    in a row go; repeated rows go or stay together; an empty table gives no rows."""
    gone = documents(docs, staging, **how).where("NOT kept").select(F.col("doc_id").alias("id"), "key")
    return without(docs, gone, staging, *_told(docs))
