"""Filling containers of fixed capacity with texts: neighbours along a space-filling curve are packed together.

Each text's tokens are hashed to random directions; their normalised sum is a point on a sphere of few dimensions,
whose cell on a Hilbert curve is the sort key. The texts are range-sorted by the key (ties by id, so that copies of one
text don't fill one task) and each range is packed in that order: a text goes into the fullest of the last ``OPEN``
containers that still holds it, so a container holds texts from one stretch of the curve. A text longer than a
container fills whole containers first; only such texts are split, and only their rest is packed like another text.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.runtime import cut, map_rows

CAPACITY = 2048
#: Dimensions of the points and bits of each on the curve.
DIMENSIONS, BITS = 4, 12
#: Containers that stay open along the curve.
OPEN = 64
#: Containers that a range holds at least, so that those left open at its end don't count.
RANGE = 2048
#: Cells of the curve in which tokens are counted to find the ranges.
CELL_BITS = 16
CELLS = 1 << CELL_BITS


def vocabulary(name: str = "byte_bpe_multi_50k.tiktoken") -> str:
    """Path of a public tokenizer's file, from the installed package that holds them."""
    import public_tokenizers  # noqa: PLC0415

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def _encoding(path: str):  # noqa: ANN202
    import public_tokenizers  # noqa: PLC0415
    import tiktoken  # noqa: PLC0415

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def directions(n: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    """A pseudo-random direction for every token id, the same everywhere."""
    return np.random.default_rng(20_240_229).standard_normal((n, dimensions)).astype(np.float32)


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row of integer coordinates below 2 ** bits."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the excess work of the curve's rotations, from the coarsest cell to the finest
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            t = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ t)
            x[i] ^= t
        q >>= 1
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def sized(documents: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(key, tokens, place): size in tokens of a public tokenizer and place on the curve of every text."""
    path = path or vocabulary()
    id_type = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoding(path)
        towards = directions(enc.n_vocab + 1)
        for b in batches:
            sums = np.zeros((len(b), DIMENSIONS), np.float32)
            sizes = np.zeros(len(b), np.int64)
            for i, t in enumerate(b.column(1).to_pylist()):
                if t:
                    ids = enc.encode_ordinary(t)
                    sizes[i] = len(ids)
                    sums[i] = towards[ids].sum(axis=0)
            norm = np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
            cells = np.clip(((sums / norm + 1) / 2 * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes), pa.array(hilbert(cells))], names=[key, "tokens", "place"])

    return documents.select(F.col(key), F.col(text).cast("string")).mapInArrow(run, f"{key} {id_type}, tokens long, place long")


class Packer:
    """Containers along the curve: the last ``open_most`` that aren't full, by the room left in each."""

    def __init__(self, capacity: int = CAPACITY, open_most: int = OPEN) -> None:
        self.capacity, self.open_most, self.next = capacity, open_most, 0
        self.room: dict[int, int] = {}

    def put(self, size: int) -> Iterator[tuple[int, int, int, int]]:
        """(container, piece, from token, tokens) of the next text."""
        at = piece = 0
        while size - at > self.capacity:
            yield self.next, piece, at, self.capacity
            at, piece, self.next = at + self.capacity, piece + 1, self.next + 1
        rest = size - at
        fits = [(room, c) for c, room in self.room.items() if room >= rest]
        if fits:
            c = min(fits)[1]
        else:
            if len(self.room) >= self.open_most:  # the fullest is the least likely to take another
                self.room.pop(min(self.room, key=lambda x: (self.room[x], x)))
            c, self.next = self.next, self.next + 1
            self.room[c] = self.capacity
        self.room[c] -= rest
        if not self.room[c]:
            del self.room[c]
        yield c, piece, at, rest


def _ranges(rows: DataFrame, key: str, capacity: int) -> DataFrame:
    """rows with ``range``: stretches of the curve of about ``RANGE`` containers' tokens each, the same in every run.

    Tokens are counted in cells of the curve (``CELLS`` at most, so the counts are broadcast) and summed along it. A cell
    that holds more than a range, as copies of one text do, is dealt to several ranges by the id.
    """
    target = capacity * RANGE
    cell = F.shiftright("place", DIMENSIONS * BITS - CELL_BITS)
    counted = rows.groupBy(cell.alias("cell")).agg(F.sum("tokens").alias("tokens"))
    along = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    start = counted.withColumn("at", F.coalesce(F.sum("tokens").over(along), F.lit(0)))
    start = start.select("cell", F.floor(F.col("at") / target).alias("first"), F.greatest(F.lit(1), F.ceil(F.col("tokens") / target)).alias("many"))
    spread = F.pmod(F.xxhash64(key), F.col("many"))
    return rows.withColumn("cell", cell).join(F.broadcast(start), "cell").withColumn("range", F.col("first") + spread).drop("cell", "first", "many")


def pack(documents: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """One row (key, piece, container, start_token, tokens) per text, and per piece of a text longer than a container.

    NULL, empty and blank texts have the tokens that the tokenizer gives them, none for NULL and empty ones, which take
    up no room; copies are packed each; container numbers are unique over the whole table and the same in every run over
    the same rows, not dense (rows that repeat a key and a text may trade places); an empty table gives no rows; extra
    columns are ignored.
    """
    rows = cut(sized(documents, key, text, path))
    ranged = _ranges(rows, key, capacity)
    many = rows.agg(F.sum("tokens")).first()[0] or 0
    # a task may hold several ranges; each is packed by itself
    ordered = ranged.repartition(max(1, int(many // (capacity * RANGE))), "range").sortWithinPartitions("range", "place", key, "tokens")

    def make() -> Callable[..., Iterable[tuple]]:
        packers: dict[int, Packer] = {}

        def step(ranges: list, ids: list, sizes: list) -> Iterable[tuple]:
            for r, k, size in zip(ranges, ids, sizes):
                if r not in packers:
                    packers.clear()  # ranges come one after the other
                    packers[r] = Packer(capacity)
                for c, piece, at, n in packers[r].put(size):
                    yield k, piece, (r << 32) + c, at, n

        return step

    id_type = documents.schema[key].dataType.simpleString()
    return map_rows(ordered.select("range", key, "tokens"), make, f"{key} {id_type}, piece int, container long, start_token long, tokens long")
