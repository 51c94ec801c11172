"""Benchmark decontamination by size-partitioned MinHash containment search.

A test item is short, a document may be thousands of times longer, and their Jaccard similarity is
then near zero even where the item is contained whole. So documents are partitioned by the size of
their shingle set, and a partition's signature has a number of bins in proportion to its sizes: a
shingle falls into one bin, and a bin keeps the smallest hash. A contained shingle then agrees with
the document's bin with the same probability at every size. Documents that agree with an item in any
bin are candidates; the containment of all of the item's shingles decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursepulse.llm.text import SHINGLE_WORDS, overlap, shingles, words

CONTAINMENT = 0.8
#: Bins per shingle at the upper end of a partition: a contained shingle agrees in its bin with
#: probability 0.79 or more, and an item of 11 shingles that is contained to 0.8 is missed once in
#: a million documents.
BINS = 2
#: Items with fewer shingles are looked up by all of their shingles instead.
FEWEST = 8
#: Shingles of test items that one pass over the documents may carry, 8 bytes each.
MOST_CARRIED = 1_000_000


class ItemIndex:
    """Signatures of test items for each partition of document sizes.

    ``items`` are (number, shingles, words of a shingle). Items of few shingles are looked up by all of
    them; those of fewer than five words by the runs of as many words.
    """

    def __init__(self, items: list[tuple[int, np.ndarray, int]]):
        items = [item for item in items if len(item[1])]
        self.long = [item for item in items if len(item[1]) >= FEWEST]
        self._tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        #: Items of few shingles, by the words of these.
        self.short: dict[int, list[tuple[int, np.ndarray, int]]] = {}
        for item in items:
            if len(item[1]) < FEWEST:
                self.short.setdefault(item[2], []).append(item)
        self._whole = {size: self._table([found for _, found, _ in held])
                       for size, held in self.short.items()}

    @staticmethod
    def bins(size: int) -> int:
        """Bins for a document of ``size`` shingles: the partition's upper bound times BINS."""
        return BINS << max(size - 1, 0).bit_length()

    @staticmethod
    def signature(found: np.ndarray, bins: int) -> np.ndarray:
        """The smallest hash of each bin that has one; the hash tells its bin."""
        least = np.zeros(bins, np.uint64)
        used = np.zeros(bins, bool)
        at = (found & np.uint64(bins - 1)).astype(np.int64)[::-1]
        least[at] = found[::-1]  # ascending order, so the smallest is written last
        used[at] = True
        return least[used]

    @staticmethod
    def _table(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes, ascending, and the places of the parts they are from."""
        hashes = np.concatenate(parts) if parts else np.empty(0, np.uint64)
        owner = np.repeat(np.arange(len(parts)), [len(part) for part in parts])
        order = np.argsort(hashes, kind="stable")
        return hashes[order], owner[order]

    def table(self, bins: int) -> tuple[np.ndarray, np.ndarray]:
        """The signatures of the items with many shingles for a partition."""
        if bins not in self._tables:
            self._tables[bins] = self._table(
                [self.signature(found, bins) for _, found, _ in self.long])
        return self._tables[bins]

    def search(self, text: str | None, containment: float) -> list[tuple[int, int, int]]:
        """``(item, shared shingles, item's shingles)`` of the items a document contains."""
        found = shingles(text)
        if not len(found):
            return []
        result = []
        if self.long:
            bins = self.bins(len(found))
            result += self._verified(self.long, self.table(bins), self.signature(found, bins),
                                     found, containment)
        for size, held in self.short.items():
            runs = found if size == SHINGLE_WORDS else shingles(text, size)
            result += self._verified(held, self._whole[size], runs, runs, containment)
        return result

    @staticmethod
    def _verified(items, table, probes, found, containment):
        """Of the items whose hashes are among the probes, those of which enough is in ``found``."""
        hashes, owner = table
        low, high = np.searchsorted(hashes, probes), np.searchsorted(hashes, probes, "right")
        hit = high > low
        if not hit.any():
            return
        candidates = np.unique(np.concatenate(
            [owner[a:b] for a, b in zip(low[hit], high[hit], strict=True)]))
        for at in candidates:
            number, item, _ = items[at]
            shared = overlap(item, found)
            if shared >= containment * len(item) - 1e-9:
                yield number, shared, len(item)


def contaminated(documents: DataFrame, benchmark: DataFrame,
                 containment: float = CONTAINMENT) -> DataFrame:
    """``doc_id, item_id, shared, item_shingles, containment``: one row per document and test item of
    whose five-word shingles the document holds a share of ``containment`` or more.

    An item of fewer than five words is one shingle of as many words, and found in any text that has
    these words in a row.

    ``doc_id, text`` and ``item_id, text`` are read, other columns ignored. Null or wordless texts
    contain and are contained in nothing. Of repeated rows of an item or document one counts; an id
    with several texts counts by each of them, the largest share is returned. Rows without an id are
    left out. Large benchmarks are searched in blocks, each in a pass over the documents.
    """
    found = benchmark.filter(F.col("item_id").isNotNull()).select("item_id", "text").distinct()
    size = found.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-size // (4 * MOST_CARRIED)))  # a shingle takes four characters or more
    items = found.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    texts = documents.select("doc_id", "text").filter(F.col("doc_id").isNotNull())
    passes = []
    for block in range(blocks):
        rows = items.filter(F.col("block") == block).collect()
        passes.append(_search(texts, sorted((row["item_id"], row["text"] or "") for row in rows),
                              containment))
    return reduce(DataFrame.unionAll, passes).groupBy("doc_id", "item_id").agg(
        F.max(F.struct("containment", "shared", "item_shingles")).alias("best")
    ).select("doc_id", "item_id", "best.shared", "best.item_shingles", "best.containment")


def _search(texts: DataFrame, items: list[tuple[int, str]], containment: float) -> DataFrame:
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = ItemIndex([(number, shingles(text), min(SHINGLE_WORDS, max(1, len(words(text)))))
                           for number, text in items])
        for batch in batches:
            rows = [(doc, item, shared, size, shared / size)
                    for doc, text in zip(batch["doc_id"], batch["text"], strict=True)
                    for item, shared, size in index.search(text, containment)]
            yield pd.DataFrame(
                rows, columns=["doc_id", "item_id", "shared", "item_shingles", "containment"])

    return texts.mapInPandas(
        search, "doc_id long, item_id long, shared long, item_shingles long, containment double")


def drop_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that contain no test item, all columns and repeated rows as they are."""
    leaks = contaminated(documents, benchmark).select("doc_id").distinct()
    return documents.join(leaks, "doc_id", "left_anti")
