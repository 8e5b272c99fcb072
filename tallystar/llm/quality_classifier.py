"""Quality of documents: a classifier's evidence over priors of their site, learned by empirical Bayes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.llm.spans import Texts, hash_spans, texts
from tallystar.llm.tables import first_by_hash, plain, table, unused
from tallystar.llm.text_stats import CHAR_CLASSES, base_counts, char_classes
from tallystar.sources.scratch import pin

#: Labelled documents the classifier is fitted on, at most.
MOST_LABELLED = 4000
WORD_BINS = 128
RIDGE = 1.0
LEAST_QUALITY = 0.5
#: Strength of a prior, in documents, where sites do not differ more than by chance, and the least one.
MOST_STRENGTH, LEAST_STRENGTH = 1e6, 1.0
#: Probabilities are kept so far from 0 and 1.
_EDGE = 1e-6


# --- the classifier of single documents --------------------------------------------------


def features(t: Texts) -> np.ndarray:
    """Shares of kinds of characters, of repeats and of hashed words, for each text."""
    starts, ends, first = t.words()
    words = hash_spans(t.buf, starts, ends)
    counts = base_counts(t, starts, first, words)
    chars = char_classes(t).astype(np.float64)
    n_words, n_chars = np.maximum(counts["n_words"], 1), np.maximum(chars.sum(axis=1), 1)
    lines = np.diff(t.lines()[2])
    text = np.repeat(np.arange(len(t)), np.diff(first))
    bins = np.bincount(text * WORD_BINS + (words & np.uint64(WORD_BINS - 1)).astype(np.int64), minlength=len(t) * WORD_BINS)
    return np.column_stack(
        [
            np.sqrt(chars / n_chars[:, None]),
            counts["word_chars"] / n_words / 10,
            counts["n_symbols"] / n_words,
            counts["n_dup_lines"] / lines,
            counts["n_repeat_words"] / n_words,
            np.log1p(counts["n_words"]) / 10,
            n_words / lines / 100,
            np.sqrt(bins.reshape(len(t), -1) / n_words[:, None]),
        ]
    )


class Logistic:
    """Ridge logistic regression on standardised features, fitted by Newton's method."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = RIDGE):
        width = len(CHAR_CLASSES) + 6 + WORD_BINS
        if not len(y):
            x, y = np.zeros((1, width)), np.full(1, 0.5)
        self.mean, self.spread = x.mean(axis=0), x.std(axis=0) + 1e-3
        z = self._scaled(x)
        self.w = np.zeros(z.shape[1])
        hold = np.full(z.shape[1], ridge)
        hold[-1] = 1e-3
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(z @ self.w, -30, 30)))
            step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(hold), z.T @ (y - p) - hold * self.w)
            # Short enough for the next step to stay where the model is curved.
            self.w += step / max(1.0, np.abs(z @ step).max() / 4)
            if np.abs(step).max() < 1e-8:
                break

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.clip((x - self.mean) / self.spread, -8, 8), np.ones(len(x))])

    def logits(self, x: np.ndarray) -> np.ndarray:
        return self._scaled(x) @ self.w


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Logistic:
    """A classifier from at most ``most`` labelled documents, those whose ids come first by hash."""
    labelled = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("__id"))
    chosen = first_by_hash(pin(labelled.agg(F.max("quality").cast("double").alias("__y"))), "__id", most)
    # At most ``most`` rows.
    labelled = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("__id")).select("text", "__y", "doc_id")

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in texts(batch.column(0)):
                x = features(t).astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row.tobytes() for row in x], pa.binary()), *(c.slice(t.rows.start, len(t)) for c in batch.columns[1:])], ["x", "y", "doc_id"]
                )

    rows = labelled.mapInArrow(featured, "x binary, y double, doc_id long").dropDuplicates(["doc_id"]).orderBy("doc_id").collect()
    x = np.stack([np.frombuffer(r["x"], np.float32) for r in rows]).astype(np.float64) if rows else np.zeros((0, 1))
    return Logistic(x, np.array([r["y"] for r in rows]))


# --- sites -------------------------------------------------------------------------------


def _strength(rate: Column, n: Column, around: Column) -> Column:
    """An aggregate: documents a prior is worth, from how far rates of groups scatter around it (method of moments).

    The variance of rates beyond chance is around (1 - around) / (strength + 1).
    """
    chance = around * (1 - around)
    beyond = F.sum(n * ((rate - around) * (rate - around) - chance / n)) / F.sum(n)
    usual = F.sum(n * chance) / F.sum(n)
    return F.when(beyond > usual / MOST_STRENGTH, F.greatest(usual / beyond - 1, F.lit(LEAST_STRENGTH))).otherwise(F.lit(MOST_STRENGTH))


def _logit(p: Column) -> Column:
    inside = F.least(F.greatest(p, F.lit(_EDGE)), F.lit(1 - _EDGE))
    return F.log(inside / (1 - inside))


def with_sites(scored: DataFrame) -> DataFrame:
    """Documents (host, path, logit, p) with ``site_rate``, ``quality`` and ``prior``.

    Rates of good documents: of all, of a host shrunk towards that, and of a path
    shrunk towards its host's; each as strongly as rates at that level agree. The
    document itself is left out of its site's counts. Its quality is its own evidence, freed from the
    general rate, over its site's rate. Counts are grouped sums, so a host with
    most of the documents is summed early, and its documents meet one row.
    """
    paths = scored.groupBy("host", "path").agg(F.count(F.lit(1)).cast("double").alias("n_path"), F.sum("p").alias("k_path"))
    hosts = paths.groupBy("host").agg(F.sum("n_path").alias("n_host"), F.sum("k_path").alias("k_host"))
    hosts = pin(hosts)
    overall = hosts.agg((F.sum("k_host") / F.sum("n_host")).alias("prior")).first()["prior"]
    prior = F.lit(0.5 if overall is None else float(overall))
    m_host = hosts.agg(_strength(F.col("k_host") / F.col("n_host"), F.col("n_host"), prior)).first()[0] or MOST_STRENGTH
    sites = pin(paths.join(hosts, "host"))
    host_rate = (F.col("k_host") + m_host * prior) / (F.col("n_host") + m_host)
    m_path = sites.agg(_strength(F.col("k_path") / F.col("n_path"), F.col("n_path"), host_rate)).first()[0] or MOST_STRENGTH
    others = scored.join(sites, ["host", "path"])
    host_rate = (F.col("k_host") - F.col("p") + m_host * prior) / (F.col("n_host") - 1 + m_host)
    site_rate = (F.col("k_path") - F.col("p") + m_path * host_rate) / (F.col("n_path") - 1 + m_path)
    others = others.withColumn("prior", prior).withColumn("host_rate", host_rate).withColumn("site_rate", site_rate)
    posterior = F.col("logit") - _logit(prior) + _logit(F.col("site_rate"))
    return others.withColumn("quality", 1 / (1 + F.exp(-posterior))).drop("n_path", "k_path", "n_host", "k_host")


def judge(
    docs: DataFrame, labels: DataFrame, least: float = LEAST_QUALITY, most_labelled: int = MOST_LABELLED, host: str = "source", path: str = "lang"
) -> DataFrame:
    """Per document its classifier's ``logit``, ``host_rate``, ``site_rate``, ``quality`` and ``kept``.

    ``labels`` (doc_id, quality 0 or 1) teach the classifier, on at most
    ``most_labelled`` documents; all documents are scored, and all count for the
    rates of their host and path. Documents have no address, so
    the source is the host and the language the path within it. A document is kept if its quality is
    at least ``least``.

    Null or empty text is scored by its counts, which are 0. Null hosts or paths are ''. Without labels all
    evidence is 0. Rows that share an id are scored one by one; the one label
    of an id with several is the largest. Columns of ``docs`` other than these
    are not read; an empty table gives an empty result.
    """
    model = fit(docs.select(plain("doc_id").cast("long").alias("doc_id"), plain("text").alias("text")), labels, most_labelled)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in texts(batch.column(0)):
                logit = model.logits(features(t))
                p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
                rest = [c.slice(t.rows.start, len(t)) for c in batch.columns[1:]]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(logit), pa.array(p)], ["doc_id", "sum", "host", "path", "logit", "p"])

    words = F.coalesce(plain("text"), F.lit(""))
    scored = docs.select(
        words.alias("text"),
        plain("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(words).alias("sum"),
        *[F.coalesce(plain(c).cast("string"), F.lit("")).alias(n) for c, n in ((host, "host"), (path, "path"))],
    ).mapInArrow(score, "doc_id long, sum long, host string, path string, logit double, p double")
    return with_sites(pin(scored)).withColumn("kept", F.col("quality") >= least)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of sufficient quality."""
    id_name, sum_name = unused(docs.columns, "__id", "__sum")
    kept = judge(docs, table(spark, sf_dir, "labels")).where("kept").select(F.col("doc_id").alias(id_name), F.col("sum").alias(sum_name))
    on = plain("doc_id").cast("long").eqNullSafe(F.col(id_name)) & (F.xxhash64(F.coalesce(plain("text"), F.lit(""))) == F.col(sum_name))
    return docs.join(kept, on, "left_semi")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "host", "path", "logit", "host_rate", "site_rate", "quality", "kept")
