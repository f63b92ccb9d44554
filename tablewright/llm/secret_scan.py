"""Secret scan with corpus-wide ownership.

Patterns give spans; the hash of every span's value is counted over the
corpus by distinct repositories and owners. A value that many owners have is a
copied example, one of few owners looks live. Values that look random but
stand under no telling name ("opaque") are reported only if few own them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tablewright.session import cut_lineage

# fixed values: the patterns of the contract
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{24,}+={0,2}+(?![A-Za-z0-9+/_=-])")
KINDS = ("assign", "access", "hex", "opaque")
MAX_OWNERS = 2


def spans(text: str) -> list[tuple[str, int, int, str]]:
    """Kind, start, end and value of all candidates, by start and then kind; offsets in code points."""
    out = []
    lower = text.lower()
    if any(name in lower for name in NAMES):
        out += [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    base = [(a, b) for _, a, b, _ in out]
    for m in OPAQUE.finditer(text):
        value = m[0]
        if (
            any(c.isdigit() for c in value) and any(c.islower() for c in value) and any(c.isupper() for c in value)
            and not any(a < m.end() and m.start() < b for a, b in base)
        ):
            out.append(("opaque", m.start(), m.end(), value))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _candidates(docs: DataFrame) -> DataFrame:
    """``_id``, ``_repo``, ``_owner`` and the spans of every text, with hashes in place of values."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("h", pa.binary())]))
        for batch in batches:
            found = [
                [
                    {"kind": k, "start": a, "end": b, "h": hashlib.sha256(v.encode()).digest()[:16]}
                    for k, a, b, v in spans(t.as_py() or "")
                ]
                for t in batch.column(3)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(found, kind)], ["_id", "_repo", "_owner", "spans"]
            )

    kinds = {c: docs.schema[c].dataType.simpleString() for c in ("_id", "_repo", "_owner")}
    return docs.select("_id", "_repo", "_owner", "_text").mapInArrow(
        work, ", ".join(f"{c} {k}" for c, k in kinds.items())
        + ", spans array<struct<kind:string,start:int,end:int,h:binary>>",
    )


def scan(
    docs: DataFrame, id: str = "doc_id", text: str = "text", repository: str = "doc_id", owner: str = "source",
    max_owners: int = MAX_OWNERS,
) -> tuple[DataFrame, DataFrame]:
    """Findings per row, and ownership per value.

    Findings: id and ``spans``, an array of kind, start, end, live (few owners).
    Spans of the kinds assign, access and hex are always there; opaque ones
    only while live. NULL and empty texts have none; repeated rows each get
    their own, and count as one repository. A missing repository or owner is
    one of its own kind. Ownership: hash, repositories, owners, places, live.
    """
    found = cut_lineage(
        _candidates(docs.select(
            F.col(id).alias("_id"), F.col(repository).alias("_repo"), F.col(owner).alias("_owner"), F.col(text).alias("_text")
        )).withColumn("row", F.monotonically_increasing_id())
    )
    places = found.select("row", "_repo", "_owner", F.explode("spans").alias("s")).select("row", "_repo", "_owner", "s.*")
    ownership = cut_lineage(
        # each step combines before its shuffle, so a value that is everywhere stays small
        places.groupBy("h", "_owner", "_repo").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("h", "_owner").agg(F.count(F.lit(1)).alias("repos"), F.sum("n").alias("n"))
        .groupBy("h").agg(F.sum("repos").alias("repositories"), F.count(F.lit(1)).alias("owners"), F.sum("n").alias("places"))
        .withColumn("live", F.col("owners") <= max_owners)
    )
    judged = (
        places.join(ownership.select("h", "live"), "h")
        .where((F.col("kind") != "opaque") | F.col("live"))
        .withColumn("_kind", F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")))
        .groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "_kind", "kind", "end", "live"))).alias("spans"))
    )
    none = F.array().cast("array<struct<start:int,_kind:bigint,kind:string,end:int,live:boolean>>")
    findings = found.select("row", "_id").join(judged, "row", "left").select(
        F.col("_id").alias(id), F.coalesce("spans", none).alias("spans")
    )
    return findings, ownership
