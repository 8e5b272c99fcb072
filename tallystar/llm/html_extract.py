"""Main text of web pages."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystar.llm.block_labeller import Vectors, train
from tallystar.llm.html_blocks import blocks
from tallystar.llm.tables import by_position, first_by_hash, plain, table

#: Pages the labeller is taught with, and the longest of these in characters.
MOST_PAGES = 200
LONGEST_PAGE = 100_000
#: Pages labelled together, in characters of HTML.
_CHARS = 4 << 20


def main_text(pages: DataFrame, most_pages: int = MOST_PAGES, key: str = "page_id", html: str = "html") -> DataFrame:
    """``pages`` with ``__text``, the blocks of the main text joined by line breaks.

    A block is the text between block elements, decoded, with white space as
    single spaces. A recurrent network reads the blocks of a whole page in both
    directions, each as a vector of the names above it and of its hashed words, and
    tells main text from menus, adverts, comments and the like. It is taught here, on
    the driver, with layouts made up around the paragraphs of at most ``most_pages`` pages (those whose
    ids come first by hash, of at most 100,000 characters) and with those that mark their text by ``article`` or ``main``.

    Null and empty pages, and pages without text, give the empty text. Broken markup never fails. Rows are
    independent of each other; equal rows get equal texts. Other columns stay, but for an earlier ``__text``, which is replaced.
    """
    pages = pages.drop("__text")
    short = pages.where(F.length(plain(html)) <= LONGEST_PAGE)
    # At most ``most_pages`` rows.
    sample = [r[html] for r in first_by_hash(short.select(plain(key), plain(html)), key, most_pages).collect()]
    model = train(sample)
    names = pages.columns
    at = names.index(html)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = Vectors()
        for batch in batches:
            column = batch.column(at).to_pylist()
            out: list[str] = []
            while len(out) < len(column):
                begin = end = len(out)
                chars = 0
                while end < len(column) and (end == begin or chars + len(column[end] or "") <= _CHARS):
                    chars += len(column[end] or "")
                    end += 1
                read = [blocks(p or "") for p in column[begin:end]]
                for page, main in zip(read, model.label(vectors(read)), strict=True):
                    out.append("\n".join(b.text for b, m in zip(page, main, strict=True) if m))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], [*names, "__text"])

    schema = T.StructType([*pages.schema.fields, T.StructField("__text", T.StringType())])
    return by_position(pages).mapInArrow(extract, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", F.col("__text").alias("text"), F.length("__text").cast("long").alias("n_chars"))
