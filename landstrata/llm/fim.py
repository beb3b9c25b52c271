"""Fill-in-the-middle: a text's middle is moved to its end, behind sentinels, and moved back.

Two cuts at token borders give prefix, middle and suffix. Sentinels are put in front of the three in
one bytearray; the parts change places by rotations of three reversals each, inside that bytearray.
The way back finds the sentinels, rotates the parts to where they were, and takes the sentinels out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from landstrata.llm.text import slices, utf8
from landstrata.session import ship

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)
# Bytes that a reversal swaps at once; all it holds beside the text.
SWAP = 1 << 16

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True


def rearranged(
    docs: DataFrame, seed: str = "1", changed: int = 90, suffix_first: int = 20, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output) of every row.

    A text is cut into n tokens: runs of A-Z and a-z, and every other character by itself. The first
    four 32-bit numbers of the SHA-256 of `seed`:`key` choose two cuts among the n + 1 borders, whether
    the text is changed (below `changed` in 100), and its form: `spm`, suffix first (below
    `suffix_first` in 100), else `psm`. A text stays `plain` if it is not chosen, is empty, or holds a
    sentinel; then it has no parts, and their sizes in characters are null.

    Null texts are empty. A null key counts as no digits. Repeated rows give equal rows. Texts may be
    as long as a column allows: a task holds one batch of them. Other columns are not looked at, and
    an empty table gives an empty result.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    schema = f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    out = rows.mapInArrow(partial(_rearranged, seed=seed, changed=changed, suffix_first=suffix_first), schema)
    return out.withColumnRenamed("doc_id", key)


def restored(rows: DataFrame, output: str = "output", form: str = "form", into: str = "restored") -> DataFrame:
    """`rows` with the texts that `rearranged` began with, from its `output` and `form` alone.

    A null output counts as an empty text, a null form as plain; an output that lacks its form's
    sentinels is returned as it is. The column `into` is added, or replaced if it is there.
    """
    ship(rows.sparkSession)
    kept = [c for c in rows.columns if c != into]
    nested = rows.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"), F.col(output).alias("output"), F.col(form).alias("form"))
    schema = StructType([*nested.schema.fields, StructField("restored", StringType())])
    out = nested.mapInArrow(_restored, schema)
    return out.select(*(F.col("row")[c].alias(c) for c in kept), F.col("restored").alias(into))


# ---- inside a task -------------------------------------------------------------------------------


def numbers(seed: str, keys: list) -> np.ndarray:
    """Four 32-bit numbers for each key."""
    head = f"{seed}:".encode()
    said = b"".join(hashlib.sha256(head + (b"" if k is None else str(k).encode())).digest()[:16] for k in keys)
    return np.frombuffer(said, dtype=">u4").reshape(len(keys), 4).astype(np.int64)


def token_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a token begins at each byte, and whether a character does."""
    character = (data & 0xC0) != 0x80
    letter = _LETTER[data]
    goes_on = np.zeros(len(data), dtype=bool)
    goes_on[1:] = letter[1:] & letter[:-1]
    goes_on[offsets[:-1][np.diff(offsets) > 0]] = False
    return character & ~goes_on, character


def cuts(data: np.ndarray, offsets: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n, bytes, characters): each text's number of tokens, and what lies before its two cuts."""
    starts, character = token_starts(data, offsets)
    before = np.concatenate([[0], np.cumsum(character)])
    at = np.flatnonzero(starts)
    first = np.searchsorted(at, offsets)
    n = np.diff(first)
    places = np.sort(draws[:, :2] % (n + 1)[:, None], axis=1)
    where = np.append(at, len(data))[np.minimum(first[:-1, None] + places, len(at))]
    where = np.where(places == n[:, None], offsets[1:, None], where)
    return n, where - offsets[:-1, None], before[where] - before[offsets[:-1]][:, None]


def reverse(view: np.ndarray, a: int, b: int) -> None:
    """view[a:b] back to front, in place."""
    while b - a > 1:
        k = min((b - a) // 2, SWAP)
        head = view[a : a + k][::-1].copy()
        view[a : a + k] = view[b - k : b][::-1]
        view[b - k : b] = head
        a, b = a + k, b - k


def rotate(view: np.ndarray, a: int, m: int, b: int) -> None:
    """view[a:m] and view[m:b] change places: each is reversed, then both together."""
    reverse(view, a, m)
    reverse(view, m, b)
    reverse(view, a, b)


def rearrange(text: bytes, first: int, second: int, suffix_first: bool) -> bytearray:
    """The output for a text with cuts in front of bytes `first` and `second`."""
    out = bytearray(text)
    out[second:second] = SUFFIX
    out[first:first] = MIDDLE
    out[0:0] = PREFIX
    middle, suffix = first + len(PREFIX), second + len(PREFIX) + len(MIDDLE)
    view = np.frombuffer(out, dtype=np.uint8)
    rotate(view, 0 if suffix_first else middle, suffix, len(out))
    return out


def restore(output: bytes, form: str | None) -> bytes:
    """The text that `rearrange` was given."""
    if form not in ("psm", "spm"):
        return output
    leading, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    inner = output.find(second, len(leading))
    middle = output.find(MIDDLE, inner + len(second))
    if not output.startswith(leading) or inner < 0 or middle < 0:
        return output
    out = bytearray(output)
    view = np.frombuffer(out, dtype=np.uint8)
    if form == "psm":  # prefix, suffix, middle: the last two change places
        rotate(view, inner, middle, len(out))
        first, suffix = inner, len(out) - (middle - inner)
    else:  # suffix, prefix, middle: the first goes behind the others
        rotate(view, 0, inner, len(out))
        first, suffix = middle - inner, len(out) - inner
    del view
    del out[suffix : suffix + len(SUFFIX)]
    del out[first : first + len(MIDDLE)]
    del out[: len(PREFIX)]
    return bytes(out)


def _texts(pieces: list) -> pa.Array:
    return pa.array(pieces, type=pa.binary()).cast(pa.string())


def _rearranged(batches: Iterator[pa.RecordBatch], seed: str, changed: int, suffix_first: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        for a, b in slices(np.diff(offsets)):
            keys = batch.column("doc_id").slice(a, b - a)
            own, bounds = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            draws = numbers(seed, keys.to_pylist())
            n, where, chars = cuts(own, bounds, draws)
            texts = [own[x:y].tobytes() for x, y in zip(bounds[:-1], bounds[1:])]
            plain = [not t or h >= changed or any(s in t for s in SENTINELS) for t, h in zip(texts, (draws[:, 2] % 100).tolist())]
            last = (draws[:, 3] % 100 < suffix_first).tolist()
            out = [t if p else bytes(rearrange(t, x, y, s)) for t, p, (x, y), s in zip(texts, plain, where.tolist(), last)]
            form = ["plain" if p else "spm" if s else "psm" for p, s in zip(plain, last)]
            sizes = (pa.array(v, mask=np.array(plain, dtype=bool)) for v in (chars[:, 0], chars[:, 1] - chars[:, 0]))
            yield pa.RecordBatch.from_arrays([keys, pa.array(n), pa.array(form), *sizes, _texts(out)], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def _restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column("output"))
        for a, b in slices(np.diff(offsets)):
            forms = batch.column("form").slice(a, b - a).to_pylist()
            outputs = (data[x:y].tobytes() for x, y in zip(offsets[a:b], offsets[a + 1 : b + 1]))
            part = batch.slice(a, b - a)
            yield pa.RecordBatch.from_arrays([*part.columns, _texts([restore(o, f) for o, f in zip(outputs, forms)])], [*part.schema.names, "restored"])
