"""Ranked lexical search over a sharded inverted index, by Block-Max MaxScore.

A shard holds some documents' postings: per term, documents and occurrences in compressed blocks, each
with its last document, its most occurrences and the least length of its documents. From the latter two
follows the block's greatest contribution under any statistics of the corpus, and from the blocks' the
list's.

A query's lists in a shard are put in order of their bounds. The lists whose bounds together stay below
the tenth best score so far are not essential: a document in none of the others can't be among the best.
Candidates come from the essential lists only. For each of the others, from the greatest bound down, a
candidate is rejected once its score, the block's maximum at its place and the bounds of the lists left
don't reach the tenth best; only the blocks that still hold candidates are decompressed. Documents are
gone through in windows of doubling size, between which the threshold rises. Each shard yields its best
documents, which are then merged.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from coursepulse.llm.folders import working_dir
from coursepulse.workspace import stored

#: Characters and documents of a shard, after which the next one begins.
SHARD_CHARS, SHARD_DOCS = 6_000_000, 1 << 16
#: Postings of a block, and documents of a query's first and widest window.
BLOCK, FIRST_WINDOW, MOST_WINDOW = 64, 256, 8192
#: Bytes of a text that are cut into terms at once.
SLICE = 1 << 20
#: Terms of all queries that one group compares with a shard.
QUERY_TERMS = 200_000

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Lower-cases A-Z and turns every byte that no term holds into a blank.
_FOLD = bytes(
    byte + 32 if 65 <= byte <= 90 else byte if byte >= 128 or chr(byte).isalnum() else 32
    for byte in range(256))
_BLANK = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a whole text, as UTF-8, a slice at a time."""
    data = (text or "").encode()
    start = 0
    while start < len(data):
        cut = _BLANK.search(data, start + SLICE) if len(data) - start > SLICE else None
        end = cut.start() if cut else len(data)
        yield data[start:end].translate(_FOLD).split()
        start = end


# --- index ----------------------------------------------------------------------------------

_LONGS = pa.list_(pa.int64())
_INDEX = pa.schema([
    ("shard", pa.int64()), ("term", pa.string()), ("df", pa.int64()), ("blocks", pa.binary()),
    ("data", pa.binary()), ("ids", _LONGS), ("lengths", _LONGS)])
#: What is known of a block without decompressing it; ``base`` is its start in the list's data, followed
#: by the gaps between documents and the occurrences, of so many bytes each.
_BLOCK_TYPE = np.dtype([("last", "<i4"), ("most", "<i8"), ("least", "<i8"), ("base", "<i8"),
                        ("size", "<i4"), ("gap_bytes", "u1"), ("times_bytes", "u1")])


class _Numbers(dict):
    """Numbers of terms in order of appearance."""

    def __missing__(self, term: bytes) -> int:
        number = self[term] = len(self)
        return number


class _Shard:
    """Documents that become a shard."""

    def __init__(self) -> None:
        self.numbers, self.ids, self.lengths = _Numbers(), [], array("q")
        self.codes, self.times, self.sizes, self.chars = array("q"), array("q"), array("q"), 0

    def add(self, doc_id: int | None, text: str | None) -> None:
        counts: Counter[bytes] = Counter()
        for part in terms(text):
            counts.update(part)
        self.codes.extend(map(self.numbers.__getitem__, counts))
        self.times.extend(counts.values())
        self.sizes.append(len(counts))
        self.ids.append(doc_id)
        self.lengths.append(counts.total())
        self.chars += len(text or "")

    @property
    def full(self) -> bool:
        return self.chars >= SHARD_CHARS or len(self.ids) >= SHARD_DOCS

    def rows(self, shard: int) -> Iterator[pa.RecordBatch]:
        """One row for the documents, one per term."""
        lengths = np.array(self.lengths, np.int64)
        yield _batch(shard=pa.array([shard]), ids=pa.array([self.ids], _LONGS),
                     lengths=pa.array([lengths], _LONGS))
        if not self.codes:
            return
        codes = np.array(self.codes, np.int64)
        order = np.argsort(codes, kind="stable")
        docs = np.repeat(np.arange(len(self.ids)), self.sizes)[order]
        times = np.array(self.times, np.int64)[order]
        df = np.bincount(codes, minlength=len(self.numbers))
        packed, first, offsets = _pack(docs, times, lengths[docs], df)
        names = pa.array(list(self.numbers), pa.binary()).cast(pa.string())
        most = 50_000
        for at in range(0, len(df), most):
            end = min(at + most, len(df))
            size = _BLOCK_TYPE.itemsize
            yield _batch(
                shard=pa.array(np.full(end - at, shard)), term=names[at:end],
                df=pa.array(df[at:end]),
                blocks=_slices(packed[0], first[at : end + 1] * size),
                data=_slices(packed[1], offsets[at : end + 1]))


def _batch(**columns: pa.Array) -> pa.RecordBatch:
    rows = len(columns["shard"])
    return pa.record_batch([columns[field.name] if field.name in columns
                            else pa.nulls(rows, field.type) for field in _INDEX], schema=_INDEX)


def _slices(data: bytes, offsets: np.ndarray) -> pa.Array:
    """The parts of ``data`` between ``offsets``."""
    part = data[offsets[0] : offsets[-1]]
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [
        None, pa.py_buffer((offsets - offsets[0]).astype(np.int64)), pa.py_buffer(part),
    ]).cast(pa.binary())


def _width(values: np.ndarray) -> np.ndarray:
    return np.where(values < 1 << 8, 1, np.where(values < 1 << 16, 2, 4))


def _pack(docs, times, lengths, df):
    """Blocks of all lists, which lie one behind the other: their table and data as bytes, the first
    block of each list, and the start of each list's data."""
    starts = np.cumsum(df) - df
    within = np.arange(len(docs)) - np.repeat(starts, df)
    heads = np.flatnonzero(within % BLOCK == 0)
    sizes = np.diff(np.append(heads, len(docs)))
    gaps = np.diff(docs, prepend=0)
    gaps[heads] = docs[heads]  # a block is read without the one before
    table = np.empty(len(heads), _BLOCK_TYPE)
    table["last"], table["size"] = docs[heads + sizes - 1], sizes
    table["most"] = np.maximum.reduceat(times, heads)
    table["least"] = np.minimum.reduceat(lengths, heads)
    table["gap_bytes"] = _width(np.maximum.reduceat(gaps, heads))
    table["times_bytes"] = _width(table["most"])
    room = sizes * (table["gap_bytes"].astype(np.int64) + table["times_bytes"])
    ends = np.cumsum(room)
    block = np.repeat(np.arange(len(heads)), sizes)
    place = np.arange(len(docs)) - heads[block]
    data = np.zeros(int(ends[-1]), np.uint8)
    low = (ends - room)[block]
    for values, name, at in (
            (gaps, "gap_bytes", low),
            (times, "times_bytes", low + (sizes * table["gap_bytes"].astype(np.int64))[block])):
        width = table[name].astype(np.int64)[block]
        at = at + place * width
        for byte in range(4):
            wide = width > byte
            data[at[wide] + byte] = (values[wide] >> (8 * byte)) & 255
    blocks = -(-df // BLOCK)
    first = np.append(0, np.cumsum(blocks))
    offsets = np.append(0, ends[first[1:] - 1])
    table["base"] = (ends - room) - np.repeat(offsets[:-1], blocks)
    return (table.tobytes(), data.tobytes()), first, offsets


def _index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number, held = TaskContext.get().partitionId() << 32, _Shard()
    for batch in batches:
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            held.add(doc_id.as_py(), text.as_py())
            if held.full:
                yield from held.rows(number)
                number, held = number + 1, _Shard()
    if held.ids:
        yield from held.rows(number)


# --- search ---------------------------------------------------------------------------------


class _List:
    """A term's postings in a shard, under the corpus' statistics."""

    def __init__(self, weight: int, blocks: bytes, data: bytes, norms: np.ndarray, norm) -> None:
        self.weight, self.data, self.norms = weight, data, norms
        self.blocks = np.frombuffer(blocks, _BLOCK_TYPE)
        self.last = self.blocks["last"]
        self.most = weight * _quotient(self.blocks["most"], norm(self.blocks["least"]))
        self.bound = int(self.most.max())
        self.read: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, at: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and contributions of a block, decompressed once."""
        found = self.read.get(at)
        if found is None:
            row = self.blocks[at]
            size, base = int(row["size"]), int(row["base"])
            gaps = np.frombuffer(self.data, f"<u{row['gap_bytes']}", size, base)
            times = np.frombuffer(self.data, f"<u{row['times_bytes']}", size,
                                  base + size * int(row["gap_bytes"])).astype(np.int64)
            docs = np.cumsum(gaps, dtype=np.int64)
            found = self.read[at] = docs, self.weight * _quotient(times, self.norms[docs])
        return found


def _quotient(times: np.ndarray, norms: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * times // (1000 * times + 8 * norms)


class Searcher:
    """Answers queries from one shard.

    ``postings`` yields ``(term, weight, blocks, data)``; ``documents`` and ``length`` are the corpus'
    numbers of documents and of terms.
    """

    def __init__(self, lengths, postings, documents: int, length: int) -> None:
        def norm(lengths):
            return 25 + 75 * lengths.astype(np.int64) * documents // length

        self.size = len(lengths)
        norms = norm(np.asarray(lengths, np.int64))
        self.lists = {term: _List(weight, blocks, data, norms, norm)
                      for term, weight, blocks, data in postings if weight > 0}
        self.opened = 0

    def best(self, query: dict[str, int], ids, most: int = 10) -> list[tuple[int, int]]:
        """(document's place, score) of the ``most`` best, equal scores by ``ids``, nulls last."""
        lists = sorted(((times * self.lists[term].bound, times, self.lists[term])
                        for term, times in query.items() if term in self.lists),
                       key=lambda one: one[0])
        below = np.cumsum([0, *[bound for bound, _, _ in lists]])
        heap: list[tuple[int, bool, int, int]] = []  # sort key, place last; ascending is best first
        low, width = 0, FIRST_WINDOW
        while low < self.size and lists:
            high = min(low + width, self.size)
            least = -heap[-1][0] if len(heap) == most else 1
            essential = int(np.searchsorted(below[1:], least))  # the lists before can't reach it
            if essential == len(lists):
                break
            docs, scores = self._window(lists, below, essential, low, high, least, most)
            for doc, score in zip(docs.tolist(), scores.tolist()):
                heap.append((-score, ids[doc] is None, ids[doc] or 0, doc))
            heap = sorted(heap)[:most]
            low, width = high, min(2 * width, MOST_WINDOW)
        return [(doc, -score) for score, _, _, doc in heap]

    def _window(self, lists, below, essential, low, high, least, most):
        """Documents from ``low`` to ``high`` of at least the score ``least``, with all that are among
        the window's ``most`` best ones."""
        totals = np.zeros(high - low, np.int64)
        for _, times, one in lists[essential:]:
            first, end = np.searchsorted(one.last, [low, high])
            for at in range(int(first), min(int(end) + 1, len(one.last))):
                docs, values = one.block(at)
                if at == first or at == end:
                    inside = slice(*np.searchsorted(docs, [low, high]))
                    docs, values = docs[inside], values[inside]
                totals[docs - low] += times * values
        docs = np.flatnonzero(totals)
        scores = totals[docs]
        for place in range(essential - 1, -1, -1):
            least = _raised(scores, least, most)
            held = scores + below[place + 1] >= least
            docs, scores = docs[held], scores[held]
            if not len(docs):
                break
            docs, scores = self._add(lists[place], docs, scores, low, int(below[place]), least)
        held = scores >= _raised(scores, least, most)
        return docs[held] + low, scores[held]

    def _add(self, entry, docs, scores, low, rest, least):
        """The candidates that a list that isn't essential leaves, with its contributions."""
        _, times, one = entry
        block = np.searchsorted(one.last, docs + low)
        inside = block < len(one.last)
        most = np.zeros(len(docs), np.int64)
        most[inside] = times * one.most[block[inside]]
        held = scores + most + rest >= least
        docs, scores, block = docs[held], scores[held].copy(), block[held]
        for at in np.unique(block[block < len(one.last)]).tolist():
            self.opened += 1
            found, values = one.block(at)
            mine = np.flatnonzero(block == at)
            place = np.searchsorted(found, docs[mine] + low)
            hit = found[place] == docs[mine] + low  # the block's last one isn't before any of them
            scores[mine[hit]] += times * values[place[hit]]
        return docs, scores


def _raised(scores: np.ndarray, least: int, most: int) -> int:
    """The ``most``-th best score so far, if that is more than ``least``."""
    if len(scores) < most:
        return least
    return max(least, int(np.partition(scores, len(scores) - most)[len(scores) - most]))


_FOUND = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _searching(documents: int, length: int, most: int):
    """Answers one block of queries from one shard."""
    def search(lists: pa.Table, shards: pa.Table) -> pa.Table:
        found = []
        for shard in shards.to_pylist():
            queries: dict[int | None, dict[str, int]] = {}
            for one in shard["queries"]:
                queries.setdefault(one["item_id"], {})[one["term"]] = one["times"]
            searcher = Searcher(shard["lengths"], zip(*(
                lists[name].to_pylist() for name in ("term", "weight", "blocks", "data"))),
                documents, length)
            ids = shard["ids"]
            for item, query in queries.items():
                found += [(item, ids[doc], score) for doc, score in searcher.best(query, ids, most)]
        columns = list(zip(*found)) or [()] * len(_FOUND)
        return pa.table([pa.array(column, field.type) for column, field in zip(columns, _FOUND)],
                        schema=_FOUND)
    return search


class LexicalIndex:
    """An index of ``doc_id, text``; other columns are ignored.

    Each row is a document, whatever its id: repeated rows are found as often, and a document without
    an id is found without one, after others of its score. A null text has no terms. Nothing is left
    out: all terms of all rows are indexed. An empty table has an empty index.
    """

    def __init__(self, documents: DataFrame):
        self.spark = documents.sparkSession
        rows = documents.select("doc_id", "text").mapInArrow(_index_rows, from_arrow_schema(_INDEX))
        path = working_dir(self.spark, "index")
        rows = stored(rows, path)
        self.postings = rows.filter(F.col("term").isNotNull()).select(
            "shard", "term", "df", "blocks", "data")
        self.shards = self.spark.read.schema(rows.schema).parquet(path).filter(
            F.col("term").isNull()).select("shard", "ids", "lengths")

    def statistics(self) -> tuple[int, int]:
        """The number of documents with a term, and of their terms."""
        long = F.aggregate("lengths", F.lit(0).cast("long"), lambda total, n: total + n)
        found = self.shards.agg(
            F.sum(F.size(F.filter("lengths", lambda n: n > 0)).cast("long")), F.sum(long)).first()
        return found[0] or 0, found[1] or 0

    def search(self, queries: DataFrame, most: int = 10) -> DataFrame:
        """``item_id, rank, doc_id, score``: the ``most`` best documents of each of ``queries``
        (``item_id, text``), with a score above 0.

        Rows of one ``item_id`` are one query of all its different texts; a missing id is one too.
        """
        documents, length = self.statistics()
        wanted, blocks = self._wanted(queries)
        found = self.postings.select("term", "df").join(
            wanted.select("term").distinct(), "term", "left_semi")
        weight = F.floor(1000 * F.ln(
            F.lit(float(2 * documents + 2)) / (2 * F.col("df") + 1).cast("double")))
        weights = stored(
            found.groupBy("term").agg(F.sum("df").alias("df")).select("term", weight.alias("weight"))
            .filter("weight > 0"), working_dir(self.spark, "weights"))
        needed = stored(wanted.join(weights, "term").select("block", "term", "weight").distinct(),
                        working_dir(self.spark, "query-terms"))
        lists = self.postings.drop("df").join(needed, "term")
        asked = stored(wanted.groupBy("block").agg(
            F.collect_list(F.struct("item_id", "term", "times")).alias("queries")),
            working_dir(self.spark, "query-blocks"))
        every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
        shards = self.shards.withColumn("block", every).join(asked, "block")
        best = lists.groupBy("shard", "block").cogroup(
            shards.groupBy("shard", "block")).applyInArrow(
            _searching(documents, length, most), from_arrow_schema(_FOUND))
        order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        return best.withColumn("rank", F.row_number().over(order)).filter(
            F.col("rank") <= most).select("item_id", "rank", "doc_id", "score")

    def _wanted(self, queries: DataFrame) -> tuple[DataFrame, int]:
        """``block, item_id, term, times``, and the number of blocks. A query is in one block, of about
        ``QUERY_TERMS`` rows."""
        found = F.explode(F.regexp_extract_all("text", F.lit(TERM), F.lit(0)))
        rows = stored(
            queries.select("item_id", "text").distinct()
            .select("item_id", found.alias("found"))
            .select("item_id", F.translate("found", _UPPER, _LOWER).alias("term"))
            .groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("times")),
            working_dir(self.spark, "queries"))
        blocks = max(1, -(-rows.count() // QUERY_TERMS))
        return rows.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int")), blocks


def search(documents: DataFrame, queries: DataFrame, most: int = 10) -> DataFrame:
    """Indexes ``documents`` and answers ``queries``, see :class:`LexicalIndex`."""
    return LexicalIndex(documents).search(queries, most)
