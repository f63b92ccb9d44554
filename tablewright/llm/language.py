"""Language ID by compression.

Every language has a raw-content dictionary made of pieces of sampled texts,
taken from all over each text. A text is brought to lower-case letters and
encoded with each dictionary in blocks; the language whose dictionary gives the
fewest bytes wins. The prediction is marked as rejected where the runner-up
needs hardly more.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from tablewright.llm.naming import unused
from tablewright.session import cut_lineage

DICTIONARY = 48 << 10  # bytes per language
TEXTS = 64  # texts per language the dictionary is cut from
PIECE = 256  # bytes taken from one place of a text
BLOCK = 4 << 10  # bytes encoded at once, so that the dictionary stays near in long texts
LEVEL = 5  # lower levels miss matches of four bytes, which tell languages apart
MARGIN = 0.01
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
FOREIGN = re.compile(r"[\W\d_]+")


def normalised(text: str) -> bytes:
    """Lower-case letters with one space for everything between them."""
    return FOREIGN.sub(" ", text.lower()).encode()


def pieces(body: bytes, share: int, seed: int) -> bytes:
    """At most ``share`` bytes of a text, from seeded places that are spread over the whole of it."""
    if len(body) <= share:
        return body
    count = max(1, share // (PIECE + 1))
    size = min(PIECE, share)
    pick = random.Random(seed)
    stride = len(body) / count
    places = [int(i * stride + pick.random() * max(0.0, stride - size)) for i in range(count)]
    return b" ".join(body[a:a + size] for a in places)[:share]


def shares(lengths: Sequence[int], size: int) -> list[int]:
    """How many bytes to take of each text: an equal share, and what short texts leave goes to the longer ones."""
    out, left = [0] * len(lengths), size
    for number, at in enumerate(sorted(range(len(lengths)), key=lambda k: (lengths[k], k))):
        out[at] = min(lengths[at], left // (len(lengths) - number))
        left -= out[at]
    return out


def learn(
    docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang",
    size: int = DICTIONARY, texts: int = TEXTS,
) -> dict[str, bytes]:
    """A dictionary of at most ``size`` bytes for every language.

    Of each language the ``texts`` ids that come first by hash are taken (a
    bounded sample of rows), of repeated rows of an id the one whose text comes
    first by hash. Each text gives pieces from all over it, an equal share of
    the dictionary and more where others are short. Rows without language, id
    or text are left out. At most ``size`` bytes a language reach the driver.
    """
    known = docs.where(F.col(lang).isNotNull() & F.col(id).isNotNull() & (F.length(text) > 0))
    order = Window.partitionBy("_lang").orderBy("_order", "_id")
    # ids alone are ranked; what is broadcast has at most ``texts`` rows per language
    # stored, so that every task ranks its own ids and only the first ones are shuffled by language
    ids = cut_lineage(
        known.select(F.col(lang).alias("_lang"), F.col(id).alias("_id"), F.xxhash64(id, F.lit(11)).alias("_order")).distinct()
    )
    chosen = ids.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= texts)

    @F.arrow_udf("binary")
    def clean(bodies: pa.Array) -> pa.Array:
        return pa.array([normalised(b.as_py()) for b in bodies], pa.binary())

    found = cut_lineage(
        known.select(F.col(lang).alias("_l"), F.col(id).alias("_i"), F.col(text).alias("_t"))
        .join(F.broadcast(chosen.select("_lang", "_id", "_rank")), (F.col("_l") == F.col("_lang")) & (F.col("_i") == F.col("_id")))
        .groupBy("_lang", "_rank").agg(F.min_by("_t", F.struct(F.xxhash64("_t"), "_t")).alias("_t"))
        .select(F.col("_lang").alias("lang"), F.col("_rank").alias("rank"), clean("_t").alias("body"))
    )
    lengths: dict[str, list[tuple[int, int]]] = {}
    for row in found.select("lang", "rank", F.octet_length("body").alias("n")).orderBy("lang", "rank").collect():
        lengths.setdefault(row["lang"], []).append((row["rank"], row["n"]))
    # a byte for the line feed between two texts
    granted = {
        (name, rank): share for name, rows in lengths.items()
        for (rank, _), share in zip(rows, shares([n for _, n in rows], size - len(rows) + 1))
    }

    @F.arrow_udf("binary")
    def cut(names: pa.Array, ranks: pa.Array, bodies: pa.Array) -> pa.Array:
        return pa.array([
            pieces(b.as_py(), granted[(n.as_py(), r.as_py())], r.as_py()) for n, r, b in zip(names, ranks, bodies)
        ], pa.binary())

    taken = found.select("lang", "rank", cut("lang", "rank", "body").alias("part")).collect()
    out: dict[str, list[tuple[int, bytes]]] = {}
    for row in taken:
        out.setdefault(row["lang"], []).append((row["rank"], bytes(row["part"])))
    return {name: b"\n".join(part for _, part in sorted(parts)) for name, parts in sorted(out.items())}


def encoders(dictionaries: Mapping[str, bytes]) -> dict[str, zstandard.ZstdCompressor]:
    made = {}
    for name, body in dictionaries.items():
        content = zstandard.ZstdCompressionDict(body, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        settings = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, source_size=BLOCK, dict_size=len(body), min_match=4,
            write_checksum=False, write_content_size=False, write_dict_id=False,
        )
        made[name] = zstandard.ZstdCompressor(compression_params=settings, dict_data=content)
    return made


def classify(text: str | None, known: Mapping[str, zstandard.ZstdCompressor]) -> tuple[str, float, bool]:
    """Language, score and whether the margin is too narrow, for one text."""
    if not text or not known or not LETTER.search(text):
        return UNKNOWN, 0.0, True
    body = normalised(text)
    blocks = [body[i:i + BLOCK] for i in range(0, len(body), BLOCK)]
    sizes = sorted((sum(len(c.compress(b)) for b in blocks), name) for name, c in known.items())
    best, name = sizes[0]
    if len(sizes) == 1:
        return name, 1.0, False
    margin = (sizes[1][0] - best) / sizes[1][0]
    return name, float(1.0 - 0.5 * np.exp(-margin / MARGIN)), margin < MARGIN


def identify(docs: DataFrame, dictionaries: Mapping[str, bytes], text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and rejected, in place of columns of these names.

    NULL texts and texts without a letter give ``und`` with score 0, as does
    everything if no language was learned. Ties go to the first language by
    name, with score 0.5. ``rejected`` says that the margin is narrow; the best
    language is returned all the same.
    """
    shared = docs.sparkSession.sparkContext.broadcast(dict(dictionaries))

    @F.arrow_udf("lang_pred string, score double, rejected boolean")
    def found(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = encoders(shared.value)
        for part in texts:
            names, scores, narrow = zip(*(classify(t.as_py(), known) for t in part))
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(narrow, pa.bool_())],
                ["lang_pred", "score", "rejected"],
            )

    made, inside = ("lang_pred", "score", "rejected"), unused(docs.columns, "_found")
    return docs.withColumn(inside, found(F.col(text))).select(
        *[F.col(f"`{c}`") for c in docs.columns if c.lower() not in made], F.col(f"{inside}.*")
    )
