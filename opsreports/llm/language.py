"""Language identification by compression with one zstandard dictionary per language."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opsreports.llm.common import lean


UNKNOWN = "und"
#: Shorter texts are repeated up to this many bytes: zstandard stores what it can't make smaller, and sizes would tie.
LEAST = 256
# Everything of ASCII but letters becomes a space, so that digits, signs and lines carry no weight.
_LETTERS = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def normal(text: str) -> bytes:
    """Small letters with single spaces between words, as the dictionaries and the texts are compared."""
    return b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_LETTERS).split()) + b" "


@dataclass(frozen=True)
class LanguageModel:
    """Raw-content dictionaries by language, most frequent language first."""

    dictionaries: dict[str, bytes]
    level: int = 6
    chunk: int = 16_384


def learn(
    df: DataFrame, label_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", dict_bytes: int = 32_768,
    per_text: int = 1000, texts: int = 200,
) -> LanguageModel:
    """Fits one dictionary per language on a bounded sample of labelled rows.

    The sample is the bound: of each language the ``texts`` rows with the smallest hash of their id (ties: the smaller
    id), ``per_text`` characters of each, ``dict_bytes`` in all. Rows without label or text are no
    sample. Labels are counted over all rows; their order settles ties later.
    """
    rows = df.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    ranked = rows.select(F.col(label_col).alias("label"), F.xxhash64(F.col(id_col)).alias("h"), F.col(id_col).alias("id")).withColumn(
        "rank", F.row_number().over(Window.partitionBy("label").orderBy("h", "id"))
    ).where(F.col("rank") <= texts)
    chosen = {(r["label"], r["id"]) for r in ranked.select("label", "id").collect()}
    ids = sorted({i for _, i in chosen if i is not None})
    counts = {r["label"]: r["count"] for r in rows.groupBy(F.col(label_col).alias("label")).count().collect()}
    heads = rows.where(F.col(id_col).isin(ids)).select(
        F.col(label_col).alias("label"), F.xxhash64(F.col(id_col)).alias("h"), F.col(id_col).alias("id"),
        F.substring(text_col, 1, per_text).alias("head"),
    ).distinct().collect()
    out: dict[str, bytes] = {}
    for label in sorted(counts, key=lambda k: (-counts[k], k)):
        own = sorted((r["h"], r["id"], r["head"]) for r in heads if (r["label"], r["id"]) in chosen and r["label"] == label)
        out[label] = b"".join(normal(head) for _, _, head in own)[:dict_bytes]
    return LanguageModel({k: v for k, v in out.items() if v.strip()})


def identify(
    df: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", margin: float = 0.01,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rows (id, lang_pred, score, rejected): each whole text gets the language whose dictionary makes it smallest.

    Texts are compressed in chunks of ``model.chunk`` bytes, all of them, with each dictionary. ``score`` is how
    much smaller the best is than the second, against the second (0 to 1). ``rejected``: that margin
    is below ``margin``, or nothing could be told. Equal sizes: the language with more labelled rows.

    Null texts and texts without a letter: ``und``, score 0, rejected. With a single language learned its
    score is 1; with none all are ``und``. Repeated rows come out each for itself, a null id stays null,
    other columns are ignored but for those named in ``keep``, which come first as they are.
    """
    kept = df.select(*keep, F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-2])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        settings = zstandard.ZstdCompressionParameters.from_level(
            model.level, write_content_size=False, write_checksum=False, write_dict_id=False
        )
        makers = []
        for name, raw in model.dictionaries.items():
            own = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            own.precompute_compress(compression_params=settings)
            makers.append((name, zstandard.ZstdCompressor(dict_data=own, compression_params=settings)))

        def predict(text: str | None) -> tuple[str, float, bool]:
            if not text or not makers or not any(map(str.isalpha, text)):
                return UNKNOWN, 0.0, True
            data = normal(text)
            if len(data) < LEAST:
                data *= LEAST // len(data) + 1
            chunks = [data[i : i + model.chunk] for i in range(0, len(data), model.chunk)]
            sizes = [sum(len(maker.compress(c)) for c in chunks) for _, maker in makers]
            best = min(range(len(sizes)), key=sizes.__getitem__)
            second = min((s for i, s in enumerate(sizes) if i != best), default=None)
            score = 1.0 if second is None else (second - sizes[best]) / second
            return makers[best][0], score, score < margin

        for batch in (whole.slice(lo, 500) for whole in batches for lo in range(0, whole.num_rows, 500)):
            got = [predict(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()),
                 pa.array([g[2] for g in got], pa.bool_())],
                names=[*batch.schema.names[:-1], "lang_pred", "score", "rejected"],
            )

    id_kind = df.schema[id_col].dataType.simpleString()
    found = kept.mapInArrow(lean(run), f"{kinds}{', ' if keep else ''}_id {id_kind}, lang_pred string, score double, rejected boolean")
    return found.drop("_id") if id_col in keep else found.withColumnRenamed("_id", id_col)
