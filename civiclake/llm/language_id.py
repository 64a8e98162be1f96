"""Language identification by compression.

Every language has a raw-content zstandard dictionary made of a bounded sample
of labelled texts. A text is compressed with each dictionary; the language whose
dictionary gives the smallest output is predicted, and a prediction is rejected
when the runner-up is almost as small. A text is compressed in pieces that each
start from the dictionary, so that a long text's own history does not take its
place and the relative difference does not fall with length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civiclake.llm.arrow_rows import table_batch
from civiclake.session import small_batches

UNDETERMINED = "und"
#: bytes of a text compressed at a time
PIECE = 4_096


def letters(text: str) -> bytes:
    """Lower-case words of letters and their marks, one space around each: what is
    compressed. Without a letter (digits, fractions, circled numbers, marks alone)
    there are none."""
    if not regex.search(r"\p{L}", text):
        return b"  "
    return (" " + regex.sub(r"[^\p{L}\p{M}]+", " ", text.lower()).strip() + " ").encode()


@dataclass(frozen=True)
class Model:
    """Dictionaries by language, the most frequent language first."""

    dictionaries: tuple[tuple[str, bytes], ...]
    level: int = 6


def train(labelled: DataFrame, *, text_col: str = "text", lang_col: str = "lang", seed_col: str = "doc_id", dict_bytes: int = 65_536,
          sample_docs: int = 64, sample_chars: int = 8_192, max_languages: int = 256, level: int = 6) -> Model:
    """Fit on a bounded sample: per language the ``sample_docs`` labelled texts
    that come first by a hash of ``seed_col``, at most ``sample_chars`` characters
    of each, cut to ``dict_bytes``. The ``max_languages`` most frequent labels
    are learned. The driver receives at most ``max_languages * sample_docs *
    sample_chars`` characters. Rows without text or label are not learned from.
    """
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.col(seed_col).alias("seed")).filter(
        "lang is not null and text is not null")
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(max_languages)
    langs = [r["lang"] for r in counts.collect()]
    order = Window.partitionBy("lang").orderBy(F.xxhash64("seed", F.length("text")), "text")
    sample = (rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= sample_docs)
              .filter(F.col("lang").isin(langs)).select("lang", "place", F.substring("text", 1, sample_chars).alias("text")))
    texts: dict[str, list] = {}
    for r in sample.collect():
        texts.setdefault(r["lang"], []).append((r["place"], letters(r["text"])))
    per_doc = max(1, 2 * dict_bytes // sample_docs)
    made = []
    for lang in langs:
        parts = [t for _, t in sorted(texts.get(lang, []))]
        # short shares of many texts first, what is left of them after that
        blob = b"".join(p[:per_doc] for p in parts) + b"".join(p[per_doc:] for p in parts)
        made.append((lang, blob[:dict_bytes]))
    return Model(tuple(made), level)


class Classifier:
    def __init__(self, model: Model) -> None:
        import zstandard as zstd

        self.by_lang = []
        for lang, content in model.dictionaries:
            d = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=model.level)
            self.by_lang.append((lang, zstd.ZstdCompressor(level=model.level, dict_data=d, write_content_size=False,
                                                           write_checksum=False, write_dict_id=False)))

    def __call__(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, margin). The margin is how much larger the second
        smallest output is, as a share of it; the score is 1 for a clear choice
        and 0 for a tie."""
        data = letters(text or "")
        if data == b"  " or not self.by_lang:
            return UNDETERMINED, 0.0, 0.0
        pieces = [data[i:i + PIECE] for i in range(0, len(data), PIECE)]
        sizes = [sum(len(c.compress(p)) for p in pieces) for _, c in self.by_lang]
        best = min(range(len(sizes)), key=sizes.__getitem__)  # at a tie the more frequent language
        if len(sizes) == 1:
            return self.by_lang[0][0], 1.0, 1.0
        second = min(s for i, s in enumerate(sizes) if i != best)
        margin = (second - sizes[best]) / second
        return self.by_lang[best][0], min(1.0, 10 * margin), margin


def predict(docs: DataFrame, model: Model, *, text_col: str = "text", min_margin: float = 0.002,
            keep: dict[str, Column] | None = None) -> DataFrame:
    """(*keep, lang_pred, score, rejected), one row per row of ``docs``.

    ``keep`` names the columns to carry along; only the text takes part in a
    prediction. Whole texts are compressed, piece by piece, whatever their length. Null texts and
    texts without a letter are ``und`` with score 0 and rejected; a margin under
    ``min_margin`` is rejected too. Repeated rows are predicted one by one; an
    empty table gives an empty result.
    """
    keep = {c: F.col(c) for c in docs.columns if c not in (text_col, "lang_pred", "score", "rejected")} if keep is None else keep
    small_batches(docs.sparkSession)
    cols = docs.select(*[c.alias(k) for k, c in keep.items()], F.col(text_col).cast("string").alias("_text"))
    spec = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cols.schema.fields[:-1])
    added = [("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(model)
        for b in batches:
            got = [classify(t) for t in b.column(b.num_columns - 1).to_pylist()]
            schema = pa.schema([*list(b.schema)[:-1], *[pa.field(*x) for x in added]])
            yield table_batch(schema, [*b.columns[:-1], [g[0] for g in got], [g[1] for g in got],
                                       [g[0] == UNDETERMINED or g[2] < min_margin for g in got]])

    return cols.mapInArrow(run, f"{spec}, lang_pred string, score double, rejected boolean")
