"""Secret scans: named patterns, and sliding-window Shannon entropy over candidate strings.

A candidate is a run of the letters of base64, in either alphabet. Its class is the smallest that holds
all its characters: letters of one case or both, with digits or without, base64 or its form for URLs;
runs of hexadecimal digits within it are a class of their own. A window of fixed width slides over it;
the counts of its characters, and with them its entropy, change by one character that leaves and one
that enters. Windows at or above the class's threshold are joined to spans. An allow-list of patterns
names candidates that are known to be harmless.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landstrata.session import ship

# Bits a character from which a window of WIDTH characters is dense, by class. Nine in ten random keys of 32
# characters have such a window; those of words, which use few letters often, do not.
THRESHOLDS = {
    "entropy_hex": 3.0, "entropy_lower": 3.6, "entropy_upper": 3.6, "entropy_letters": 3.85, "entropy_lower_digits": 3.7,
    "entropy_upper_digits": 3.7, "entropy_alnum": 3.9, "entropy_base64": 3.9, "entropy_base64url": 3.9,
}
KINDS = ("assign", "access", "hex", *THRESHOLDS)
BASE = KINDS[:3]

# The patterns of the base kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_WORDS = ("passw", "secret", "token", "api")  # one of them is in every text that the first pattern matches

WIDTH = 20
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{WIDTH},}}")
HEX_RUN = re.compile(rf"[0-9A-Fa-f]{{{WIDTH},}}")
CLASSES = tuple(
    (f"entropy_{name}", re.compile(rf"[{letters}]+=*"))
    for name, letters in (
        ("lower", "a-z"), ("upper", "A-Z"), ("letters", "A-Za-z"), ("lower_digits", "a-z0-9"), ("upper_digits", "A-Z0-9"),
        ("alnum", "A-Za-z0-9"), ("base64", "A-Za-z0-9+/"), ("base64url", "A-Za-z0-9_-"),
    )
)

# Harmless candidates: UUIDs, counting alphabets, placeholders, file paths, and snake, kebab or camel names of words.
ALLOWED = (
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
    r"(?i).*(abcdefghij|0123456789|example|placeholder|changeme|redacted|your[_-]).*",
    r"/?([A-Za-z]{1,14}[0-9]{0,4}[/_=-]+)+[A-Za-z]{0,14}[0-9]{0,4}",
    r"[a-z]*([A-Z][a-z]{2,})+[0-9]{0,4}",
)


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """(key, found): for every row the spans found, as structs (kind, start, end), by start and then kind.

    Positions count code points; the end is exclusive. `assign`, `access` and `hex` are the leftmost
    matches, not overlapping, of their patterns, without those that are too short; they stay whatever
    the allow-list says. Spans of the entropy kinds are left out where they lie within one of those. A
    text that is null or empty has no spans; one may be of any length. Repeated rows and null keys are
    kept, and an empty table gives an empty result. Other columns are not looked at.
    """
    ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    schema = f"doc_id {kind}, found array<struct<kind:string,start:long,end:long>>"
    return rows.mapInArrow(partial(_found, allowed=allowed), schema).withColumnRenamed("doc_id", key)


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """(key, n_assign, n_access, n_hex, base_sha256, spans): counts, a digest of the base spans, all spans.

    A span is written kind:start:end; spans are joined by commas. See `find`.
    """
    rows = find(docs, key, text, allowed)
    said = lambda s: F.concat_ws(":", s.kind, s.start, s.end)
    base = F.filter("found", lambda s: s.kind.isin(*BASE))
    count = lambda kind: F.size(F.filter("found", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    digest = F.sha2(F.array_join(F.transform(base, said), ",").cast("binary"), 256).alias("base_sha256")
    return rows.select(key, *map(count, BASE), digest, F.array_join(F.transform("found", said), ",").alias("spans"))


# ---- inside a task -------------------------------------------------------------------------------


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = []
    lower = text.lower()
    if any(word in lower for word in ASSIGN_WORDS):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    return out


def dense_windows(run: str, threshold: float, width: int = WIDTH) -> list[tuple[int, int]]:
    """Spans of `run` covered by windows whose entropy is at least `threshold`, by incremental counts."""
    weight = [c * math.log2(c) if c else 0.0 for c in range(width + 2)]
    counts: dict[str, int] = {}
    total, out = 0.0, []
    limit = (math.log2(width) - threshold) * width + 1e-9  # entropy = log2(width) - total / width
    for at, c in enumerate(run):
        n = counts.get(c, 0)
        total += weight[n + 1] - weight[n]
        counts[c] = n + 1
        if at >= width:
            gone = run[at - width]
            n = counts[gone]
            total += weight[n - 1] - weight[n]
            counts[gone] = n - 1
        if at >= width - 1 and total <= limit:
            a = at - width + 1
            if out and a <= out[-1][1]:
                out[-1] = (out[-1][0], at + 1)
            else:
                out.append((a, at + 1))
    return out


def entropy_spans(run: str, allowed: list[re.Pattern]) -> list[tuple[str, int, int]]:
    """Dense parts of one candidate. A number is none."""
    if any(p.fullmatch(run) for p in allowed):
        return []
    out, taken = [], []
    for m in HEX_RUN.finditer(run):
        if any(c.isdigit() for c in m[0]) and not m[0].isdigit():
            taken.append(m.span())
            out += [("entropy_hex", m.start() + a, m.start() + b) for a, b in dense_windows(m[0], THRESHOLDS["entropy_hex"])]
    if any(c.isalpha() for c in run):
        # Letters of both alphabets of base64 in one run: the larger class.
        kind = next((name for name, letters in CLASSES if letters.fullmatch(run)), "entropy_base64")
        for a, b in dense_windows(run, THRESHOLDS[kind]):
            if not any(x <= a and b <= y for x, y in taken):
                out.append((kind, a, b))
    return out


def spans(text: str, allowed: list[re.Pattern]) -> list[tuple[str, int, int]]:
    """All spans of a text, by start and then kind."""
    out = base_spans(text)
    runs = [(m.start(), m[0]) for m in CANDIDATE.finditer(text)]  # a long run of hex is part of such a run
    for at, run in runs:
        if len(run) >= 24:
            out += [("hex", at + m.start(), at + m.end()) for m in HEX.finditer(run) if len(m[0]) >= 24]
    base = list(out)
    for at, run in runs:
        for kind, a, b in entropy_spans(run, allowed):
            if not any(x <= at + a and at + b <= y for _, x, y in base):
                out.append((kind, at + a, at + b))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def _found(batches: Iterator[pa.RecordBatch], allowed: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    patterns = [re.compile(p) for p in allowed]
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        rows = [[{"kind": k, "start": a, "end": b} for k, a, b in spans(t or "", patterns)] for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, kind)], ["doc_id", "found"])
