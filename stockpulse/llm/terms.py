"""A membership filter over terms whose size does not depend on their number.

The filter is a bit table of fixed length, addressed by the term's XXH64.  It may
let other terms through (all of them, when very many are listed), never keeps a
listed one out; whoever uses it joins on the exact terms afterwards.  So what is
broadcast is bounded by ``BITS`` however large the list of terms grows.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the table: 2^22 bits are 512 KB.
BITS = 1 << 22
#: Verdicts a worker remembers before it forgets them all.
REMEMBERED = 500_000


def term_bits(terms: DataFrame, column: str) -> np.ndarray:
    """The bit table of a column of terms; at most ``BITS / 63`` rows reach the driver."""
    at = F.pmod(F.xxhash64(F.col(column)), F.lit(BITS))
    words = (terms.where(F.col(column).isNotNull()).select(at.alias("at"))
             .groupBy(F.expr("at div 63").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 63 as int))"))
                                                             .alias("bits")))
    table = np.zeros(BITS // 63 + 1, dtype=np.int64)
    found = words.toPandas()
    table[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return table


class TermFilter:
    """Asks the bit table whether a term (UTF-8 bytes) may be listed; remembers the answers."""

    def __init__(self, table: np.ndarray):
        self.table = table.tolist()
        self.known: dict[bytes, bool] = {}

    def __call__(self, term: bytes) -> bool:
        verdict = self.known.get(term)
        if verdict is None:
            word, bit = divmod(xxhash.xxh64_intdigest(term, 42) % BITS, 63)
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            verdict = self.known[term] = bool(self.table[word] >> bit & 1)
        return verdict
