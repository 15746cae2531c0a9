"""Helpers shared by the operators on training records."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm import sketches
from tidewright.runtime import latest_by

#: Names of languages in metadata beside their two-letter code, by code. Fixed values.
LANGUAGE_NAMES = {
    "en": "eng english", "de": "deu ger german deutsch", "fr": "fra fre french français francais", "es": "spa spanish español espanol castellano", "zh": "zho chi cmn chinese mandarin 中文 汉语", "it": "ita italian italiano",
    "pt": "por portuguese português portugues", "nl": "nld dut dutch nederlands", "sv": "swe swedish svenska", "da": "dan danish dansk", "no": "nor nob nb nn norwegian norsk", "fi": "fin finnish suomi", "pl": "pol polish polski",
    "cs": "ces cze czech čeština", "ro": "ron rum romanian română", "hu": "hun hungarian magyar", "tr": "tur turkish türkçe", "ru": "rus russian русский", "uk": "ukr ukrainian українська", "bg": "bul bulgarian български",
    "el": "ell gre greek ελληνικά", "he": "heb hebrew iw עברית", "ar": "ara arabic العربية", "fa": "fas per persian farsi فارسی", "ur": "urd urdu اردو", "hi": "hin hindi हिन्दी", "bn": "ben bengali বাংলা", "ta": "tam tamil தமிழ்",
    "th": "tha thai ไทย", "vi": "vie vietnamese tiếng", "id": "ind indonesian bahasa", "ja": "jpn japanese 日本語", "ko": "kor korean 한국어",
}
#: Codes that say that the language is not known. Fixed values.
NO_LANGUAGE = ("und", "unk", "xx", "xxx", "zxx", "mul", "mis", "nan", "nil", "na")


def language_code(column: Column) -> Column:
    """Code of a language spelt in any of the known ways (``en-US``, ``English``, ``eng``); other codes of two or three letters stay, else null."""
    head = F.lower(F.regexp_extract(F.trim(column), r"^([^\s_-]+)", 1))
    known = F.create_map(*[F.lit(x) for code, names in LANGUAGE_NAMES.items() for name in (code, *names.split()) for x in (name, code)])
    return F.coalesce(F.try_element_at(known, head), F.when(head.rlike(r"^[a-z]{2,3}$") & ~head.isin(*NO_LANGUAGE), head))


def label(column: Column) -> Column:
    """A categorical value in lower case without outer blanks; blank and null become ``unknown``."""
    return F.coalesce(F.nullif(F.lower(F.trim(column)), F.lit("")), F.lit("unknown"))


def latest_deliveries(samples: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """(sample_id, columns) of the latest delivery of each sample; null ids are dropped.

    Only rows whose sample_id may be there again (by a partition-merged filter of the ids) are shuffled, so wide columns of
    single deliveries stay where they are.
    """
    there = samples.where("sample_id is not null")
    cells = sketches.filter_cells(there.count())
    key = F.xxhash64("sample_id")
    again = sketches.may_repeat(there, sketches.repeat_filter(there.select(key.alias("_s")), ["_s"], cells), cells)
    marked = there.withColumn("_again", again(key))
    once = marked.where("not _again").select("sample_id", *[c.alias(n) for n, c in columns.items()])
    return once.unionByName(latest_by(marked.where("_again"), "sample_id", "ingested_at", columns))


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``mapInArrow`` with a function of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
