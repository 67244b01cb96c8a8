"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams (n = 1..3, hashed into a fixed number of columns) per
label in Spark; the log-probability matrix (columns x labels, a few MB
whatever the corpus) is broadcast, and texts are scored batch by batch in
numpy as sums of matrix rows.  Whole texts are scored; a long text is taken
in chunks, so memory does not grow with it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = 1 << 16
NGRAMS = 3
CHUNK = 1 << 18
# Bound of the labelled documents of each label that the counts are learnt from (expected number).
SAMPLE_ROWS = 5_000
# The matrix takes 256 KB a label.
MAX_LABELS = 500
UNKNOWN = "und"


@dataclass
class Model:
    labels: list[str]
    log_prob: np.ndarray   # [COLUMNS, labels], float32
    log_prior: np.ndarray  # [labels]


def held_out(doc_id: Column) -> Column:
    """crc32 of the id's decimal text, modulo 4, is 2 (NULL id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def ngram_columns(text: str) -> Iterator[np.ndarray]:
    """Hashed columns of all 1..3-grams of the lowered text, chunk by chunk."""
    text = f" {text.lower()} "
    for at in range(0, max(1, len(text) - NGRAMS + 1), CHUNK):
        piece = text[at:at + CHUNK + NGRAMS - 1]
        last = at + CHUNK + NGRAMS - 1 >= len(text)
        c = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        h = np.zeros(len(c), dtype=np.uint64)
        for n in range(1, NGRAMS + 1):
            size = len(c) - n + 1
            if size <= 0:
                break
            h = (h[:size] * np.uint64(0x9E3779B97F4A7C15) + c[n - 1:n - 1 + size] + np.uint64(n))
            # The overlap of two chunks belongs to the next one.
            own = size if last else min(size, CHUNK)
            mixed = h[:own] ^ (h[:own] >> np.uint64(29))
            yield ((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(48)).astype(np.int64)


def has_letter(text: str | None) -> bool:
    return text is not None and any(ch.isalpha() for ch in text)


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, smoothing: float = 0.1) -> Model | None:
    """Learns from ``text`` and non-NULL ``lang`` of the documents not held out.

    A label with more than ``sample_rows`` documents is thinned by a hash of
    id and text to about that many, so a rare label is learnt from all of
    its documents; equal rows are taken or left together.  Priors count all
    documents.  No labelled text: no model (None).
    """
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
             .limit(MAX_LABELS + 1).collect()}
    if len(sizes) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels")
    if not sizes:
        return None
    sample = labelled
    thinned = {lang: int(sample_rows / n * (1 << 31)) for lang, n in sizes.items() if n > sample_rows}
    if thinned:
        cuts = F.create_map(*[F.lit(v) for pair in thinned.items() for v in pair])
        cut = F.coalesce(F.try_element_at(cuts, F.col("lang")), F.lit(1 << 31))
        place = F.pmod(F.xxhash64(F.lit("langid"), F.isnull("doc_id"), "doc_id", "text"), F.lit(1 << 31))
        sample = labelled.filter(place < cut)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"]):
                into = seen.setdefault(lang, np.zeros(COLUMNS, dtype=np.int64))
                for cols in ngram_columns(text):
                    into += np.bincount(cols, minlength=COLUMNS)
        for lang, into in seen.items():
            cols = np.flatnonzero(into)
            yield pd.DataFrame({"lang": lang, "col": cols, "n": into[cols]})

    # At most COLUMNS cells a label after the sum; the driver reads one label at a time.
    cells = (sample.select("text", "lang").mapInPandas(count, "lang string, col long, n long")
             .groupBy("lang", "col").agg(F.sum("n").alias("n"))
             .groupBy("lang").agg(F.collect_list("col").alias("cols"), F.collect_list("n").alias("ns")))
    labels = sorted(sizes)
    log_prob = np.empty((COLUMNS, len(labels)), dtype=np.float32)
    log_prob[:] = -np.log(COLUMNS)       # a label none of whose documents was sampled
    for row in cells.toLocalIterator():
        column = np.full(COLUMNS, smoothing)
        column[np.array(row.cols, dtype=np.int64)] += np.array(row.ns, dtype=np.float64)
        log_prob[:, labels.index(row.lang)] = np.log(column / column.sum())
    prior = np.array([sizes[lang] for lang in labels], dtype=np.float64)
    return Model(labels, log_prob, np.log(prior / prior.sum()))


def score_text(labels: list[str], log_prob: np.ndarray, log_prior: np.ndarray, text: str) -> tuple[str, float]:
    total = log_prior.copy()
    for cols in ngram_columns(text):
        total += log_prob[cols].sum(axis=0, dtype=np.float64)
    best = int(total.argmax())
    return labels[best], float(1.0 / np.exp(total - total[best]).sum())


def judgement(spark: SparkSession, model: Model | None, text: Column) -> Column:
    """struct(lang_pred, score) of a text column; without a model all texts get ``und`` and 0."""
    if model is None:
        return F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast((model.labels, model.log_prob, model.log_prior))

    @F.pandas_udf("lang_pred string, score double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for texts in batches:
            rows = [score_text(*own, t) if has_letter(t) else (UNKNOWN, 0.0) for t in texts]
            yield pd.DataFrame(rows, columns=["lang_pred", "score"])

    return judge(text)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` plus lang_pred and score (posterior of the best label, 0 to 1).

    Of labels equally likely the first by code point wins.

    A text that is NULL or has no letter gets ``und`` and 0; so does every
    text without a model.  Only ``text`` goes into a prediction.  Columns of
    these names in ``docs`` are replaced.
    """
    judged = docs.withColumn("__judged", judgement(docs.sparkSession, model, F.col("text")))
    return judged.withColumns({"lang_pred": F.col("__judged.lang_pred"),
                               "score": F.col("__judged.score")}).drop("__judged")


def identify_languages(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    return predict(docs, train(docs, sample_rows))


def keep_identified(docs: DataFrame, least_score: float = 0.5, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` without the documents that are in no known language.

    Rejected are texts that are NULL or without a letter, and those whose
    best label is less likely than ``least_score``.  Without any labelled
    document nothing is known about languages, and only letters are asked for.
    """
    model = train(docs, sample_rows)
    if model is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    judged = docs.withColumn("__judged", judgement(docs.sparkSession, model, F.col("text")))
    known = (F.col("__judged.lang_pred") != UNKNOWN) & (F.col("__judged.score") >= least_score)
    return judged.filter(known).select(*docs.columns)
