"""Column expressions on bit fields and fixed-width vectors."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from plumbwright.functions.fixed import NUMBER_LABELS


# Feature bits that share one non-negative bigint.
WORD_BITS = 63


def bit_features(n: Column, width: int = 10) -> Column:
    """The lowest ``width`` bits of an integer, least significant first."""
    return F.array(*[F.shiftright(n, i).bitwiseAND(F.lit(1)).cast("int") for i in range(width)])


def number_class(n: Column) -> Column:
    """3 for multiples of 15, 2 for 5, 1 for 3, otherwise 0."""
    return F.when(n % 15 == 0, 3).when(n % 5 == 0, 2).when(n % 3 == 0, 1).otherwise(0)


def decode_class(n: Column, cls: Column) -> Column:
    """The class name, or the number itself for class 0."""
    names = F.array(*[F.lit(x) for x in NUMBER_LABELS])
    return F.when(cls == 0, n.cast("string")).otherwise(F.element_at(names, cls + 1))


def pack_parities(features: Column) -> Column:
    """Fold an integer array into words that hold each element's parity bit, any number of them."""
    zero = F.lit(0).cast("bigint")

    def word(w: Column) -> Column:
        part = F.slice(features, w * WORD_BITS + 1, WORD_BITS)
        bits = F.transform(part, lambda x, i: F.call_function("shiftleft", F.abs(x).cast("bigint") % 2, i))
        return F.aggregate(bits, zero, lambda acc, b: acc.bitwiseOR(b))

    last = F.floor((F.greatest(F.size(features), F.lit(1)) - 1) / F.lit(WORD_BITS)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), word)


def subset_mask(indices) -> list[int]:
    """Bit masks by word of the chosen features; an index listed twice cancels out."""
    mask: list[int] = []
    for i in indices:
        if i < 0:
            raise ValueError("a feature index must not be negative")
        word, bit = divmod(i, WORD_BITS)
        mask += [0] * (word + 1 - len(mask))
        mask[word] ^= 1 << bit
    return mask


def masked_parity(words: Column, mask: Sequence[int]) -> Column:
    """Parity of the masked bits: a population count for each word in which the mask has bits."""
    zero = F.lit(0).cast("bigint")
    # Words that are not there hold no bits.
    counts = [F.bit_count(F.coalesce(F.get(words, i), zero).bitwiseAND(F.lit(m))) for i, m in enumerate(mask) if m]
    return reduce(lambda a, b: a + b, counts) % 2 if counts else F.lit(0)


def parity_predict(bits: Column, indices, flip: Column | int = 0) -> Column:
    """Parity of the chosen features, flipped when ``flip`` is 1."""
    parity = masked_parity(bits, subset_mask(indices))
    return parity.bitwiseXOR(flip if isinstance(flip, Column) else F.lit(flip))


def vector_add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def vector_set(a: Column, index: int, value) -> Column:
    """A copy of the vector with one element replaced."""
    return F.transform(a, lambda x, i: F.when(i == index, F.lit(value)).otherwise(x))


def describe(df: DataFrame, column: str) -> DataFrame:
    """Widths, rank, type and row counts of an array column."""
    c = F.col(column)
    shapes = df.groupBy(F.size(c).alias("width")).agg(F.count(F.lit(1)).alias("n"))
    dtype = df.schema[column].dataType
    rank, inner = 0, dtype
    while isinstance(inner, ArrayType):
        rank, inner = rank + 1, inner.elementType
    return shapes.select(
        "width", F.lit(rank).alias("rank"), F.lit(dtype.simpleString()).alias("dtype"), "n"
    )
