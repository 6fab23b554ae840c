"""Secrets, told from examples by who owns them.

1. One scan proposes spans. ``assign``, ``access`` and ``hex`` are the base kinds and stay. Further
   candidates are private keys, tokens of known forms, credentials in addresses and long strings of
   high entropy.
2. Over the whole corpus the hash of each candidate's value is counted by distinct repositories and
   owners (partial sums before every shuffle, so a key pasted everywhere is a few rows per task).
3. A value of at most ``LIVE_OWNERS`` owners is specific to them and looks live; one with more is a
   widely copied example, as is one that says so (``example``, ``changeme``, one repeated sign ...).
   Candidates that look live are added to the spans.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm.work import small_batches, stored

LIVE_OWNERS = 2
#: Least bits per character of a string without a known form, and its least length.
ENTROPY = 3.5
LONG = 24

BASE_KINDS = ("assign", "access", "hex")
ADDED_KINDS = ("pem", "vendor", "url", "entropy")

_ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_PEM = re.compile(r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]{0,32}PRIVATE KEY-----")
_VENDOR = re.compile(
    r"\b(?:gh[pousr]_[A-Za-z0-9]{30,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}"
    r"|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})"
)
_URL = re.compile(r"[a-z][a-z0-9+.-]{1,15}://[^\s:/@]{1,64}:([^\s:/@]{4,128})@")
_LONG = re.compile(rf"[A-Za-z0-9+/_=-]{{{LONG},}}")
_EXAMPLE = re.compile(r"example|changeme|placeholder|your[_-]|dummy|sample|x{6,}|(.)\1{7,}", re.I)


def _entropy(text: str) -> float:
    _, n = np.unique(np.frombuffer(text.encode(), dtype=np.uint8), return_counts=True)
    share = n / n.sum()
    return float(-(share * np.log2(share)).sum())


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """``(start, end, kind, value)`` of the base kinds, by start and then kind."""
    found = []
    low = text.find
    if low("=") >= 0 or low(":") >= 0:
        found += [
            (m.start(), m.end(), "assign", m.group(1))
            for m in _ASSIGN.finditer(text)
            if m.end(1) - m.start(1) >= 12
        ]
    if low("AKIA") >= 0:
        found += [
            (m.start(), m.end(), "access", m.group())
            for m in _ACCESS.finditer(text)
            if m.end() - m.start() >= 18
        ]
    found += [(m.start(), m.end(), "hex", m.group()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], BASE_KINDS.index(x[2])))


def further_candidates(text: str, taken: list[tuple]) -> list[tuple[int, int, str, str]]:
    """The other candidates; none within a span that is taken."""
    found = []
    if "-----BEGIN" in text:
        found += [(m.start(), m.end(), "pem", m.group()) for m in _PEM.finditer(text)]
    found += [(m.start(), m.end(), "vendor", m.group()) for m in _VENDOR.finditer(text)]
    if "://" in text:
        found += [(m.start(1), m.end(1), "url", m.group(1)) for m in _URL.finditer(text)]
    for m in _LONG.finditer(text):
        value = m.group()
        mixed = any(c.isdigit() for c in value) and any(c.isalpha() for c in value)
        if mixed and _entropy(value) >= ENTROPY:
            found.append((m.start(), m.end(), "entropy", value))
    spans = sorted((a, b) for a, b, *_ in taken)
    starts = [a for a, _ in spans]
    ends = list(accumulate((b for _, b in spans), max))  # the last end of all spans up to one
    out, last = [], 0
    for x in sorted(found, key=lambda x: (x[0], ADDED_KINDS.index(x[2]))):
        before = bisect_left(starts, x[1])  # so many spans begin before this one ends
        if x[0] >= last and not (before and ends[before - 1] > x[0]):
            out.append(x)
            last = x[1]
    return out


_CANDIDATE = pa.struct(
    [
        ("start", pa.int64()),
        ("end", pa.int64()),
        ("kind", pa.string()),
        ("base", pa.bool_()),
        ("example", pa.bool_()),
        ("hash", pa.binary()),
    ]
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column("text").to_pylist():
            base = base_spans(text)
            rows.append(
                [
                    {
                        "start": a,
                        "end": b,
                        "kind": kind,
                        "base": kind in BASE_KINDS,
                        "example": _EXAMPLE.search(value) is not None,
                        "hash": hashlib.sha256(value.encode()).digest(),
                    }
                    for a, b, kind, value in [*base, *further_candidates(text, base)]
                ]
            )
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(k) for k in ("row", "doc_id", "repo", "owner")), pa.array(rows, pa.list_(_CANDIDATE))],
            ["row", "doc_id", "repo", "owner", "candidates"],
        )


def secrets(
    docs: DataFrame, repo: str = "source", owner: str = "source", live_owners: int = LIVE_OWNERS
) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied, secrets)`` for
    every row of ``docs``.

    ``spans`` lists ``kind:start:end`` by start and then kind: the base ones, and the added ones that
    look live. ``secrets`` holds every candidate with its counts of repositories, owners and documents.
    Null texts are empty, a null owner or repository is one of its own. Rows that repeat a ``doc_id``
    are told apart by a number that the scan gives them. No input: no rows.
    """
    small_batches(docs.sparkSession)
    named = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.coalesce(F.col(repo).cast("string"), F.lit("")).alias("repo"),
        F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
    )
    candidate = (
        "struct<start: bigint, end: bigint, kind: string, base: boolean, example: boolean, hash: binary>"
    )
    scanned = stored(
        named.mapInArrow(
            _scan,
            f"row long, doc_id long, repo string, owner string, candidates array<{candidate}>",
        ),
        "scanned",
    )
    each = scanned.select("row", "repo", "owner", F.explode("candidates").alias("c"))
    # Repositories and owners are counted one after the other, each after its own partial sums.
    spread = (
        each.groupBy(F.col("c.hash").alias("hash"), "owner", "repo")
        .agg(F.count("*").alias("n"))
        .groupBy("hash", "owner")
        .agg(F.count("*").alias("repos"), F.sum("n").alias("n"))
        .groupBy("hash")
        .agg(
            F.sum("repos").alias("repos"),
            F.count("*").alias("owners"),
            F.sum("n").alias("occurrences"),
        )
    )
    spread = stored(spread, "spread")
    live = (F.col("owners") <= live_owners) & ~F.col("c.example")
    judged = (
        each.join(spread, each["c"]["hash"] == spread["hash"])
        .select(
            "row",
            F.struct(
                F.col("c.start").alias("start"),
                F.col("c.end").alias("end"),
                F.col("c.kind").alias("kind"),
                F.col("c.base").alias("base"),
                "repos",
                "owners",
                "occurrences",
                live.alias("live"),
            ).alias("secret"),
        )
        .groupBy(F.col("row").alias("of"))
        .agg(F.array_sort(F.collect_list("secret")).alias("secrets"))
    )
    kinds = F.array(*(F.lit(k) for k in (*BASE_KINDS, *ADDED_KINDS)))
    told = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    order = lambda s: F.struct(
        s["start"].alias("start"), F.array_position(kinds, s["kind"]).alias("at"), told(s).alias("told")
    )
    list_of = lambda spans: F.array_join(
        F.transform(F.array_sort(F.transform(spans, order)), lambda x: x["told"]), ","
    )
    base = F.filter("candidates", lambda c: c["base"])
    count = lambda kind: F.size(F.filter(base, lambda c: c["kind"] == kind)).cast("long")
    return scanned.join(judged, scanned["row"] == judged["of"], "left").select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in BASE_KINDS),
        F.sha2(list_of(base), 256).alias("base_sha256"),
        list_of(F.filter("secrets", lambda s: s["base"] | s["live"])).alias("spans_or_null"),
        F.size(F.filter("secrets", lambda s: s["live"])).cast("long").alias("live_or_null"),
        F.size(F.filter("secrets", lambda s: ~s["live"])).cast("long").alias("copied_or_null"),
        "secrets",
    ).select(
        "doc_id",
        *(f"n_{k}" for k in BASE_KINDS),
        "base_sha256",
        F.coalesce("spans_or_null", F.lit("")).alias("spans"),
        F.when(F.col("secrets").isNull(), 0).otherwise(F.col("live_or_null")).alias("n_live"),
        F.when(F.col("secrets").isNull(), 0).otherwise(F.col("copied_or_null")).alias("n_copied"),
        "secrets",
    )
