"""Language identification by compression.

For each language a zstandard dictionary of raw content is put together from a bounded, hash-ordered sample of labelled
documents. A text is cut into blocks; each block is compressed once with each dictionary, and the language with the
smallest sum wins. The score is the relative margin to the second; ``accepted`` says whether it reaches ``min_margin``.
Whole texts are classified, whatever their length; a worker holds one text and one compressor per language.

Training sample (documented bounds): at most ``DOCS_PER_LANGUAGE`` documents per language, ``BYTES_PER_DOC`` bytes of each,
``DICTIONARY_BYTES`` in all. Only these reach the driver.

Edge cases: a null text, or one without a letter, is ``und`` with score 0, as is everything where no language was
learned; with a single learned language the score is 1; equal sums go to the first language by name with score 0; labels
that are null teach nothing; input columns named like an output column are replaced.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import bounded_batches, table

DOCS_PER_LANGUAGE, BYTES_PER_DOC, DICTIONARY_BYTES = 64, 2048, 65_536
BLOCK, LEVEL = 4096, 6
#: Dictionaries are held by the driver and every worker, so languages are counted first.
MAX_LANGUAGES, PARTS = 256, 64
MIN_MARGIN = 0.01
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_OTHERS = re.compile(r"[\W\d_]+")


def dictionaries(labelled: DataFrame, text: str = "text", language: str = "lang", docs: int = DOCS_PER_LANGUAGE, per_doc: int = BYTES_PER_DOC, total: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """Raw content per language.

    Copies count once: only hashes of texts are made distinct and ranked, first within ``PARTS`` parts of a language, so that
    no task reads all of a common one, then among the ``docs`` that each part keeps; a second pass fetches the chosen texts.
    """
    rows = labelled.filter(F.col(text).isNotNull() & (F.length(text) > 0) & F.col(language).isNotNull())
    rows = rows.select(F.col(language).cast("string").alias("lang"), F.substring(text, 1, per_doc).alias("text"), F.xxhash64(F.col(text)).alias("h"))
    hashes = rows.select("lang", "h", F.pmod("h", F.lit(PARTS)).alias("part")).distinct()
    kept = hashes.withColumn("n", F.row_number().over(Window.partitionBy("lang", "part").orderBy("h"))).filter(F.col("n") <= docs)
    chosen = kept.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).filter(F.col("n") <= docs).select("lang", "h", "n")
    languages = labelled.select(F.col(language)).distinct().limit(MAX_LANGUAGES + 1).count()
    if languages > MAX_LANGUAGES:
        raise ValueError(f"over {MAX_LANGUAGES} languages: dictionaries are held by the driver and by every worker")
    rows = rows.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "n").agg(F.min("text").alias("text"))
    out: dict[str, bytes] = {}
    for row in rows.orderBy("lang", "n").collect():  # at most docs rows of per_doc characters for each language
        out[row.lang] = (out.get(row.lang, b"") + letters(row.text)[:per_doc] + b" ")[:total]
    return out


def has_letter(text: str) -> bool:
    # the class also takes numerals that aren't digits
    return any(m.group().isalpha() for m in _LETTER.finditer(text))


def letters(text: str) -> bytes:
    """Lower-case words of letters with one space between: digits and marks say little about the language."""
    return _OTHERS.sub(" ", text.lower()).encode()


class Classifier:
    def __init__(self, content: dict[str, bytes], level: int = LEVEL, block: int = BLOCK):
        import zstandard

        self.block = block
        self.languages = sorted(content)
        self.compressors = []
        for language in self.languages:
            own = zstandard.ZstdCompressionDict(content[language], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            own.precompute_compress(level=level)
            self.compressors.append(zstandard.ZstdCompressor(dict_data=own, write_checksum=False, write_content_size=False, write_dict_id=False).compress)

    def sizes(self, text: str) -> list[int]:
        data = letters(text)
        blocks = [data[i : i + self.block] for i in range(0, len(data), self.block)]
        return [sum([len(compress(b)) for b in blocks]) for compress in self.compressors]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        if len(self.languages) == 1:
            return self.languages[0], 1.0
        first, second = sorted(zip(self.sizes(text), self.languages))[:2]
        return first[1], (second[0] - first[0]) / second[0]


def identify(df: DataFrame, content: dict[str, bytes], text: str = "text", min_margin: float = MIN_MARGIN) -> DataFrame:
    """``df`` without its text, with lang_pred, score and accepted; one pass without a shuffle."""
    new = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("accepted", T.BooleanType())]
    fields = [f for f in df.schema.fields if f.name.lower() not in {"lang_pred", "score", "accepted"}]
    df = df.select(*[f.name for f in fields])
    names = [f.name for f in fields if f.name != text]
    bounded_batches(df.sparkSession)
    shipped = df.sparkSession.sparkContext.broadcast(content)  # DICTIONARY_BYTES per language
    schema = T.StructType([*[f for f in fields if f.name != text], *new])

    def run(batches):
        own = Classifier(shipped.value)
        for batch in batches:
            said = [own.predict(x.as_py()) for x in batch.column(batch.schema.get_field_index(text))]
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            columns += [pa.array([x for x, _ in said], pa.string()), pa.array([s for _, s in said], pa.float64()), pa.array([x != UNKNOWN and s >= min_margin for x, s in said], pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "lang_pred", "score", "accepted"])

    return df.mapInArrow(run, schema)


def op8_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2
    content = dictionaries(docs.filter(~held_out).select("text", "lang"))
    return identify(docs.select("doc_id", "text", held_out.alias("held_out")), content)
