"""Quality rules: how far a document's characters and common words are from its language's."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.llm.spans import LOWER, hash_spans, texts
from tallystar.llm.tables import plain, table
from tallystar.llm.text_stats import CHAR_CLASSES, base_counts, char_classes
from tallystar.sources.scratch import pin

#: Largest Jensen-Shannon distance (0 to 1) from the language, and how much more is
#: allowed for a short text: the spread / sqrt(number counted).
MOST_CHAR_DISTANCE, CHAR_SPREAD = 0.2, 2.0
MOST_WORD_DISTANCE, WORD_SPREAD = 0.2, 1.5
#: Texts with fewer are not judged by the distance.
LEAST_CHARS = 200
LEAST_WORDS = 50

# The most frequent function words of four languages.
COMMON_WORDS = """
the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which
one you were all her she there would their we him been has when who will no more if out so up
de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont avec son aux
der die und den von zu das mit sich auf für ist im dem nicht ein eine als auch es werden aus er hat dass sie nach
wird bei el y los del las por con una su para al lo como más o pero sus ha me si sin sobre este ya
""".split()


def _common() -> np.ndarray:
    """Hashes of the common words, sorted."""
    raw = [w.encode() for w in dict.fromkeys(COMMON_WORDS)]
    ends = np.cumsum([len(w) for w in raw])
    return np.sort(hash_spans(np.frombuffer(b"".join(raw), np.uint8), ends - [len(w) for w in raw], ends))


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    common = _common()
    for batch in batches:
        for t in texts(batch.column(2)):
            starts, ends, first = t.words()
            counts = base_counts(t, starts, first, hash_spans(t.buf, starts, ends))
            lowered = hash_spans(LOWER[t.buf], starts, ends)
            at = np.minimum(np.searchsorted(common, lowered), len(common) - 1)
            kind = np.where(common[at] == lowered, at, len(common))
            text = np.repeat(np.arange(len(t)), np.diff(first))
            bins = len(common) + 1
            words = np.bincount(text * bins + kind, minlength=len(t) * bins)
            chars = char_classes(t)
            yield pa.RecordBatch.from_arrays(
                [
                    *(c.slice(t.rows.start, len(t)) for c in batch.columns[:2]),
                    *(pa.array(counts[c].astype(np.int64)) for c in _COUNTS),
                    pa.array(chars.sum(axis=1)),
                    _lists(chars.ravel(), len(CHAR_CLASSES), len(t)),
                    _lists(words, bins, len(t)),
                ],
                ["doc_id", "lang", *_COUNTS, "n_chars", "chars", "words"],
            )


def _lists(values: np.ndarray, width: int, rows: int) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * width), pa.array(values.astype(np.int64)))


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of both histograms, one after the other, per language: what a task has read."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        both = np.hstack([np.array(c.flatten()).reshape(batch.num_rows, -1) for c in batch.columns[1:]])
        for lang in dict.fromkeys(langs):
            sums[lang] = sums.get(lang, 0) + both[langs == lang].sum(axis=0)
    for lang, values in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(values), pa.string()), pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], ["lang", "at", "n"]
        )


def _references(counted: DataFrame) -> DataFrame:
    """The histograms of each language."""
    sums = counted.select("lang", "chars", "words").mapInArrow(_sum, "lang string, at int, n long")
    ordered = F.array_sort(F.collect_list(F.struct("at", "n")))
    both = sums.groupBy("lang", "at").agg(F.sum("n").alias("n")).groupBy(F.col("lang").alias("ref_lang")).agg(F.transform(ordered, lambda x: x["n"]).alias("n"))
    classes = len(CHAR_CLASSES)
    sliced = both.select("ref_lang", F.slice("n", 1, classes).alias("ref_chars"), F.slice("n", classes + 1, len(_common()) + 1).alias("ref_words"))
    return sliced.select("*", *[F.aggregate(f"ref_{c}", F.lit(0).cast("long"), lambda a, x: a + x).alias(f"ref_n_{c}") for c in ("chars", "words")])


def _distance(p: str, p_total: Column, q: str, q_total: Column) -> Column:
    """Jensen-Shannon distance, with logarithms to base 2, of two arrays of counts with known sums."""

    def half(share: Column, other: Column) -> Column:
        return F.when(share > 0, share * F.log2(share * 2 / (share + other))).otherwise(0.0)

    def term(a: Column, b: Column) -> Column:
        x, y = a / F.greatest(p_total, F.lit(1)), b / F.greatest(q_total, F.lit(1))
        return half(x, y) + half(y, x)

    return F.sqrt(F.greatest(F.aggregate(F.zip_with(p, q, term), F.lit(0.0), lambda s, x: s + x) / 2, F.lit(0.0)))


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Per document its counts, its two distances from its language, and ``kept``.

    The reference of a language is the sum of the histograms (classes of
    characters; common words and all others) over all its documents, so no
    outside data is needed and no document is left out. A document fails the base
    rule with under 50 words or if over half of its words are in runs of three
    words that occur twice. Otherwise it is kept if both Jensen-Shannon distances
    are within their limits; each limit holds only from a least length on and
    is wider for short texts, whose histograms vary by chance.

    Null text has no words. Documents without a language are a language of their
    own. Each row is judged by itself, so repeated rows get equal verdicts. Other columns are
    not read. The distances of an empty text are 1 at most and not used.

    One pass over the text; then one row of sums per language and task.
    """
    counted = pin(
        docs.select(plain(key).cast("long").alias("doc_id"), F.coalesce(plain(lang).cast("string"), F.lit("")).alias("lang"), plain(text).alias("text")).mapInArrow(
            _count, "doc_id long, lang string, " + ", ".join(f"{c} long" for c in [*_COUNTS, "n_chars"]) + ", chars array<long>, words array<long>"
        )
    )
    # One row per language, written, so that the planner knows its size and joins without a shuffle by language.
    judged = counted.join(pin(_references(counted)), F.col("lang") == F.col("ref_lang")).select(
        "doc_id", *_COUNTS, _distance("chars", F.col("n_chars"), "ref_chars", F.col("ref_n_chars")).alias("char_distance"),
        _distance("words", F.col("n_words"), "ref_words", F.col("ref_n_words")).alias("word_distance"),

    )
    fails = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    far_chars = (F.col("word_chars") >= LEAST_CHARS) & (F.col("char_distance") > MOST_CHAR_DISTANCE + CHAR_SPREAD / F.sqrt("word_chars"))
    far_words = (F.col("n_words") >= LEAST_WORDS) & (F.col("word_distance") > MOST_WORD_DISTANCE + WORD_SPREAD / F.sqrt("n_words"))
    return judged.withColumn("base_failed", fails).withColumn("kept", ~(fails | far_chars | far_words))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))
