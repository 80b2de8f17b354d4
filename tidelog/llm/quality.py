"""Quality rules: heuristics, then a hashed n-gram log-likelihood ratio of trusted text against the corpus.

Two multinomials over hashed words and word pairs are counted: one from trusted documents, one from
all documents. A document's score is the mean over its features of log p(trusted) - log p(corpus);
it is kept if no heuristic fails and the score reaches the threshold. Both counts and the verdict
cover whole texts of every document.

p(trusted) holds a fixed share of the corpus, so the scale doesn't depend on the amount of trusted text.
The threshold comes from the trusted documents that pass the heuristics, each scored as if it weren't
trusted (its own counts are taken off): it lies below their 1st percentile, by half of the distance
from there to their 25th. So documents like the trusted ones stay, however few or many these are.

Every labelled row of quality counts as trusted, however many there are. A bitmap of fixed size over their ids' hashes finds them
among the documents; a second one, of other documents' ids that hit it, tells where the first isn't sure. Only texts whose bit is in
both are shuffled, for an exact join: hardly any while ids are few for the bitmap, and at most as many as the first one finds. The percentiles are taken over the numbers of documents by score, in steps of ``STEP``, so what is
gathered for them has a bound that no input moves.

Defined cases: a null text has no words and fails the heuristics; a document without words scores 0;
without any trusted document all scores are 0 and only the heuristics decide, as they do if no trusted
document passes them. A label without an id trusts nothing. Rows without an id and repeated rows are counted
and judged each; a very long text is counted whole; an empty table gives no rows; other columns don't matter,
and ``keep_good`` returns them as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm import _text as t

BUCKETS = 1 << 16
SLICE = 1 << 11
#: the threshold's percentiles are exact on scores of this step
STEP = 1e-4
#: bits of the bitmap, and of one of its pieces
BITS, PIECE = 1 << 26, 1 << 15
#: the corpus' share in the trusted distribution, which bounds what a feature can cost
CORPUS_SHARE = 0.2
#: percentiles of the trusted scores that the threshold follows from, see above
LOW, QUARTER = 0.01, 0.25

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word starts, ends, borders and hashes; buckets of words and pairs, and the text of each."""
    start, end, border = t.words(data, off)
    h = t.span_hash(t.prefix_hash(data), start, end)
    pair, at = t.windows(h, border, 2)
    doc = t.doc_of(border, len(h))
    bucket = np.concatenate((h, pair)) & np.uint64(BUCKETS - 1)
    return start, end, border, h, bucket.astype(np.int64), np.concatenate((doc, doc[at]))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The ids of all rows with quality 1 and not toxic, each once."""
    return labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()


def _bitmap(ids: DataFrame) -> np.ndarray:
    """The bits of the ids' hashes, of fixed size however many ids there are."""
    pieces = ids.select(_bit()).groupBy(F.floor(F.col("_bit") / PIECE).cast("int").alias("piece")).agg(F.bitmap_construct_agg(F.col("_bit") % PIECE).alias("bits"))
    out = np.zeros((BITS // PIECE, PIECE // 8), np.uint8)
    for r in pieces.collect():  # as many as the bitmap has, at most
        out[r["piece"]] = np.frombuffer(r["bits"], np.uint8)
    return out.reshape(-1)


def _bit() -> Column:
    """The place of the row's id in a bitmap, -1 without an id."""
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(BITS))
    return F.when(F.col("doc_id").isNotNull(), place).otherwise(-1).alias("_bit")


def _set(bitmap: np.ndarray, at: pa.Array) -> np.ndarray:
    """Which of these places the bitmap has."""
    at = at.to_numpy(zero_copy_only=False)
    return (at >= 0) & (bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _of(rows: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """The rows whose id's bit is set."""
    sent = rows.sparkSession.sparkContext.broadcast(bitmap)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.select(range(b.num_columns - 1)).filter(pa.array(_set(sent.value, b.column(b.num_columns - 1))))

    return rows.select("*", _bit()).mapInArrow(keep, rows.schema)


def _trusted_docs(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, DataFrame | None]:
    """A bitmap that only trusted documents hit, and the texts of those it lacks. Ids alone are joined first; only
    texts whose bit trusted and other ids share are joined themselves."""
    ids = trusted_ids(labels)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    marked = _bitmap(ids)
    shared = _bitmap(_of(rows.select("doc_id"), marked).join(ids, "doc_id", "left_anti"))
    # dealt before the join, so that no task runs two Python workers at once, one before and one after it
    rest = _of(rows, shared).repartition("doc_id").join(ids, "doc_id", "left_semi").select("text") if shared.any() else None
    return marked & ~shared, rest


def _counted(rows: DataFrame, bitmap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each bucket occurs in all texts, and in those whose bit is set: vectors of fixed size whatever the input."""
    sent = rows.sparkSession.sparkContext.broadcast(bitmap)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS), np.int64)
        for b in batches:
            own = _set(sent.value, b.column(1))
            for lo, hi, data, off in t.chunks(b.column(0)):
                *_, bucket, doc = _features(data, off)
                total[0] += np.bincount(bucket, minlength=BUCKETS)
                total[1] += np.bincount(bucket[own[lo:hi][doc]], minlength=BUCKETS)
        slices = total.reshape(-1, SLICE)
        yield pa.record_batch([pa.array(range(len(slices)), pa.int32()), pa.array([x.tobytes() for x in slices], pa.binary())], ["slice", "blob"])

    out = np.zeros((2 * BUCKETS // SLICE, SLICE), np.int64)
    for r in t.sum_vectors(rows.select("text", _bit()).mapInArrow(count, "slice int, blob binary"), 8).collect():
        out[r[0]] = np.frombuffer(r[1], np.int64)
    sent.unpersist()
    return tuple(out.reshape(2, -1).astype(float))


def _ratio(trusted: np.ndarray, total: np.ndarray | float, prior: np.ndarray) -> np.ndarray:
    return np.log((1 - CORPUS_SHARE) * trusted / np.maximum(total, 1) + CORPUS_SHARE * prior) - np.log(prior)


def log_ratio(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """log p(trusted) - log p(corpus) of each bucket, of fixed size whatever the input, and the threshold."""
    t.tuned(docs.sparkSession)
    sure, rest = _trusted_docs(docs, labels)
    corpus, trusted = _counted(docs, sure)
    if rest is not None:
        trusted += _counted(rest.select(F.lit(None).cast("long").alias("doc_id"), "text"), sure)[0]
    if not trusted.sum():
        return np.zeros(BUCKETS), -np.inf
    prior = (corpus + 1) / (corpus.sum() + BUCKETS)
    return _ratio(trusted, trusted.sum(), prior), _threshold(docs, sure, rest, trusted, prior)


def _threshold(docs: DataFrame, sure: np.ndarray, rest: DataFrame | None, trusted: np.ndarray, prior: np.ndarray) -> float:
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((sure, trusted, prior))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sure, trusted, prior = sent.value
        for b in batches:
            b = b.filter(pa.array(_set(sure, b.column(1)))) if b.num_columns == 2 else b
            texts = b.column(0).to_pylist()
            for lo, hi, data, off in t.chunks(b.column(0)):
                passed = ~_stats(data, off, texts[lo:hi], np.zeros(BUCKETS))["base_failed"]
                yield pa.record_batch([pa.array(_without_own(data, off, trusted, prior)[passed])], ["score"])

    scores = docs.select("text", _bit()).mapInArrow(score, "score double")
    if rest is not None:
        scores = scores.unionByName(rest.mapInArrow(score, "score double"))
    by_score = scores.groupBy((F.round(F.col("score") / STEP) * STEP).alias("score")).agg(F.count("*").alias("n"))
    low, quarter = by_score.agg(F.percentile("score", F.lit(LOW), F.col("n")), F.percentile("score", F.lit(QUARTER), F.col("n"))).first()
    sent.unpersist()
    return -np.inf if low is None else low - (quarter - low) / 2 - 1e-9


def _without_own(data: np.ndarray, off: np.ndarray, trusted: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """Scores of trusted documents, each with its own features taken off the trusted counts."""
    n = len(off) - 1
    *_, bucket, doc = _features(data, off)
    key, times = np.unique(doc * BUCKETS + bucket, return_counts=True)
    doc, bucket = np.divmod(key, BUCKETS)
    feats = np.bincount(doc, times, n)
    ratio = _ratio(trusted[bucket] - times, trusted.sum() - feats[doc], prior[bucket])
    return np.bincount(doc, ratio * times, n) / np.maximum(feats, 1)


def _stats(data: np.ndarray, off: np.ndarray, texts: list[str | None], ratio: np.ndarray) -> dict[str, np.ndarray]:
    n = len(off) - 1
    start, end, border, h, bucket, doc = _features(data, off)
    chars = t.per_doc(t.NOT_SPACE[data] & ((data & 0xC0) != 0x80), off)
    repeat = np.zeros(len(h), bool)
    tri, at = t.windows(h, border, 3)
    if len(tri):
        own = t.mix(tri + t.doc_of(border, len(h))[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(own)
        same = own[order][1:] == own[order][:-1]
        twice = np.zeros(len(own), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        for k in range(3):
            repeat[at[twice] + k] = True
    dup = np.zeros(n, np.int64)
    for k, x in enumerate(texts):
        if x and "\n" in x:
            lines = [y for y in x.split("\n") if y.strip(" \t\n\v\f\r")]
            dup[k] = len(lines) - len(set(lines))
    feats = np.bincount(doc, minlength=n)
    score = np.bincount(doc, ratio[bucket], n) / np.maximum(feats, 1)
    n_words = np.diff(border)
    n_repeat = t.per_doc(repeat, border)
    return {
        "n_words": n_words, "word_chars": chars, "n_symbols": t.per_doc(_SYMBOL[data], off), "n_dup_lines": dup, "n_repeat_words": n_repeat,
        "base_failed": (n_words < 50) | (100 * n_repeat > 50 * n_words), "score": score,
    }


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float | None = None) -> DataFrame:
    """One row per document: the heuristics' counts, the score and the verdict; a given threshold replaces the labels'."""
    ratio, least = log_ratio(docs, labels)
    ratio, least = docs.sparkSession.sparkContext.broadcast(ratio), least if threshold is None else threshold

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            for lo, hi, data, off in t.chunks(b.column(1)):
                s = _stats(data, off, texts[lo:hi], ratio.value)
                s["kept"] = ~s["base_failed"] & (s["score"] >= least)
                yield pa.record_batch([b.column(0).slice(lo, hi - lo), *map(pa.array, s.values())], ["doc_id", *s])

    return docs.select("doc_id", "text").mapInArrow(score, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, score double, kept boolean")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float | None = None) -> DataFrame:
    """The documents that ``quality_scores`` keeps, with all their columns, in the same pass over them."""
    ratio, least = log_ratio(docs, labels)
    ratio, least = docs.sparkSession.sparkContext.broadcast(ratio), least if threshold is None else threshold
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(at).to_pylist()
            for lo, hi, data, off in t.chunks(b.column(at)):
                s = _stats(data, off, texts[lo:hi], ratio.value)
                yield b.slice(lo, hi - lo).filter(pa.array(~s["base_failed"] & (s["score"] >= least)))

    return docs.mapInArrow(keep, docs.schema)
