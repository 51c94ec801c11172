"""Near-duplicate documents by DartMinHash signatures and a banded join.

A document is a weighted set of shingles. Darts fall on each shingle's strip of (weight, rank) at
random, seeded by the shingle alone, so that every document holding it sees the same darts. A
document keeps the darts below its weights; each dart belongs to one coordinate of the signature,
and the earliest per coordinate is its value. Two documents agree in a coordinate with the
probability of their weighted Jaccard similarity. The number of darts looked at depends on the
signature's length, not on the number of shingles times it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_128_intdigest

from coursepulse.llm.folders import working_dir
from coursepulse.llm.graph import components
from coursepulse.llm.text import mix, overlap, runs_of, shingles
from coursepulse.workspace import session_conf, stored

SIMILARITY = 0.8
#: 56 bands of 8 coordinates find a pair of similarity 0.8 with probability 1 - 3e-5, and one of 0.5
#: (short texts around a common passage) only in a bucket out of five.
BANDS, ROWS = 56, 8
#: Bits of two sketches, one bit per coordinate, that may differ: 10 % are expected to at similarity
#: 0.8, and more than this at most 4e-6 of such pairs have.
MOST_APART = int(BANDS * ROWS * 0.1 + 4.4 * (BANDS * ROWS * 0.1 * 0.9) ** 0.5)
#: Leaders of a band's bucket, and of a rare shingle's texts in each of its passes.
LEADERS, KEY_LEADERS = 2, (2, 8)
#: Texts of a rare shingle that one key of the last join holds from either side.
BLOCK = 1000
#: Frequent shingles that a broadcast may hold, 16 bytes each, and the least number of texts of one.
MOST_FREQUENT, LEAST_FREQUENT = 1_000_000, 4
#: Pairs of whole texts, or whole texts, that a task holds at once.
BATCH = 256
#: Ids that a broadcast may hold, 8 bytes each.
MOST_SENT = 2_000_000

_U64 = np.uint64
_CELL, _TURN, _PLACE = _U64(0xD6E8FEB86659FD93), _U64(0xA0761D6478BD642F), _U64(0xE7037ED1A0B428DB)


def dart_signatures(elements: Sequence[np.ndarray], weights: Sequence[np.ndarray] | None = None,
                    length: int = BANDS * ROWS) -> np.ndarray:
    """Signatures of weighted sets, one row each; sets without positive weight get zeros.

    ``elements`` are distinct 64-bit hashes; ``weights`` default to one each.
    """
    signatures = np.zeros((len(elements), length), _U64)
    sizes = np.array([len(found) for found in elements], dtype=np.int64)
    if not sizes.sum():
        return signatures
    flat = np.concatenate(elements).astype(_U64)
    weight = np.ones(len(flat)) if weights is None else np.concatenate(weights).astype(float)
    owner = np.repeat(np.arange(len(elements)), sizes)
    held = weight > 0
    flat, weight, owner = flat[held], weight[held], owner[held]
    total = np.bincount(owner, weight, len(elements))
    # strips are cut into cells [0, 1), [1, 2), [2, 4), ... of the weight axis
    cells = np.where(weight <= 1, 1, 1 + np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64))
    strip = np.repeat(np.arange(len(flat)), cells)
    cell = np.arange(len(strip)) - np.repeat(np.cumsum(cells) - cells, cells)
    low = np.where(cell == 0, 0.0, 2.0 ** (cell - 1))
    width = np.where(cell == 0, 1.0, low)
    seed = mix(flat[strip] + cell.astype(_U64) * _CELL)
    owner, weight = owner[strip], weight[strip]
    least = np.full(len(elements) * length, np.inf)
    # with this many darts expected, one coordinate in e^4 * length stays empty
    reach = np.where(total > 0, length * (np.log(length) + 4) / np.maximum(total, 1e-300), 0)
    todo = np.flatnonzero(total > 0)
    while len(todo):
        chosen = np.isin(owner, todo) if len(todo) < len(elements) else slice(None)
        _throw(seed[chosen], owner[chosen], low[chosen], width[chosen], weight[chosen], reach,
               least, length)
        short = ~np.isfinite(least.reshape(-1, length)).all(axis=1)
        todo = todo[short[todo]]
        reach[todo] *= 2
    full = np.flatnonzero(total > 0)
    signatures[full] = least.reshape(-1, length)[full].view(_U64)
    return signatures


def _throw(seed, owner, low, width, weight, reach, least, length) -> None:
    """Throws the darts of all cells up to their document's reach, a run of turns at a time; ranks
    in a cell arrive like a Poisson process of its width."""
    rank = np.zeros(len(seed))
    active = np.arange(len(seed))
    turn = 0
    while len(active):
        run = int(np.clip(8192 // len(active), 1, 512))
        turns = (np.arange(turn, turn + run, dtype=_U64) + _U64(1)) * _TURN
        hashed = mix(seed[active][:, None] + turns[None, :])
        gap = -np.log(((hashed >> _U64(11)).astype(float) + 0.5) * 2.0 ** -53)
        gap /= width[active][:, None]
        gap[:, 0] += rank[active]  # added one by one, a rank is the same however runs are cut
        ranks = np.cumsum(gap, axis=1)
        rank[active] = ranks[:, -1]
        second = mix(hashed ^ _PLACE)
        place = low[active][:, None] + width[active][:, None] * (
            (second & _U64(0xFFFFFFFF)).astype(float) * 2.0 ** -32)
        hit = (ranks <= reach[owner[active]][:, None]) & (place < weight[active][:, None])
        coordinate = ((second >> _U64(32)) * _U64(length)) >> _U64(32)
        row = np.broadcast_to(owner[active][:, None], hit.shape)[hit]
        np.minimum.at(least, row * length + coordinate[hit].astype(np.int64), ranks[hit])
        active = active[rank[active] <= reach[owner[active]]]
        turn += run


def band_keys(signatures: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per signature and band."""
    parts = signatures.reshape(len(signatures), bands, rows)
    key = mix(np.arange(bands, dtype=_U64))[None, :].repeat(len(signatures), 0)
    for row in range(rows):
        key = mix(key ^ parts[:, :, row])
    return key.view(np.int64)


def sketch_bits(signatures: np.ndarray) -> np.ndarray:
    """One bit of each coordinate, in 64-bit words."""
    bits = (mix(signatures) & _U64(1)).astype(np.uint8)
    missing = -bits.shape[1] % 64
    return np.packbits(np.pad(bits, ((0, 0), (0, missing))), axis=1).view(np.int64)


_SKETCH = "doc_id long, high long, low long, size int, bits array<long>, bands array<long>"


def _sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per document: a 128-bit digest of its shingle set, and its band keys; nulls without words."""
    for batch in batches:
        ids = batch["doc_id"].to_numpy()
        start = 0
        for texts in runs_of(batch["text"]):
            found = [shingles(text) for text in texts]
            signatures = dart_signatures(found)
            keys = band_keys(signatures)
            digest = [xxh3_128_intdigest(one.tobytes()) for one in found]
            yield pd.DataFrame({
                "doc_id": ids[start : start + len(texts)],
                "high": _whole(_signed(d >> 64) if len(f) else None for d, f in zip(digest, found)),
                "low": _whole(_signed(d & (2 ** 64 - 1)) if len(f) else None
                              for d, f in zip(digest, found)),
                "size": [len(f) for f in found],
                "bits": list(sketch_bits(signatures)),
                "bands": [key if len(f) else None for key, f in zip(keys, found)],
            })
            start += len(texts)


def _whole(values) -> pd.api.extensions.ExtensionArray:
    """Whole numbers, or nulls, with all their digits."""
    return pd.array(list(values), dtype="Int64")


def _least_texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The texts whose digest is their id's smallest."""
    for batch in batches:
        digests = [xxh3_128_intdigest(shingles(text).tobytes()) for text in batch["text"]]
        held = [_signed(d >> 64) == high and _signed(d & (2 ** 64 - 1)) == low
                for d, high, low in zip(digests, batch["high"], batch["low"])]
        yield batch.loc[held, ["doc_id", "text"]]


def _signed(value: int) -> int:
    return value - 2 ** 64 if value >= 2 ** 63 else value


def _similarities(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Adds the exact Jaccard similarity of two texts' shingle sets to their pair."""
    known: dict[int, np.ndarray] = {}

    def of(number: int, text: str) -> np.ndarray:
        found = known.get(number)
        if found is None:
            if len(known) >= 256:
                known.clear()
            found = known[number] = shingles(text)
        return found

    for batch in batches:
        values = []
        for a, text_a, b, text_b in zip(batch["a"], batch["text_a"], batch["b"], batch["text_b"]):
            first, second = of(a, text_a), of(b, text_b)
            if min(len(first), len(second)) < SIMILARITY * max(len(first), len(second)):
                values.append(0.0)
                continue
            shared = overlap(first, second)
            values.append(shared / max(1, len(first) + len(second) - shared))
        yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "similarity": values})


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document, its shingles, sorted."""
    for batch in batches:
        found = [shingles(text.as_py()).view(np.int64) for text in batch["text"]]
        yield pa.record_batch([batch["doc_id"], pa.array(found, pa.list_(pa.int64()))],
                              names=["id", "shingles"])


def looked_at(size: int, similarity: float) -> int:
    """How many of a set's first elements have to be looked at, in an order that is the same for all
    sets, so that a set that is similar enough has one of them among its own first ones."""
    return size - math.ceil(similarity * size - 1e-6) + 1


def _rare(frequent: np.ndarray, similarity: float):
    """Rows of the rarest shingles of each set; ``frequent`` are the others, the rarest first."""
    known = np.argsort(frequent)
    ordered = frequent[known]

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, held in zip(batch["id"].to_pylist(), batch["shingles"]):
                values = held.values.to_numpy(zero_copy_only=False)
                at = np.searchsorted(ordered, values)
                at[at == len(ordered)] = 0
                often = ordered[at] == values if len(ordered) else np.zeros(len(values), bool)
                rank = np.where(often, known[at] if len(ordered) else 0, -1)
                first = np.argsort(rank, kind="stable")[:looked_at(len(values), similarity)]
                yield pa.record_batch([
                    pa.array(np.full(len(first), number)), pa.array(values[first]),
                    pa.array(np.arange(len(first)))], names=["id", "bucket", "place"])
    return keys


_RECORDS = "spark.sql.execution.arrow.maxRecordsPerBatch"


class NearDuplicates:
    """The links between a table's different texts, and the classes they form.

    ``doc_id, text`` are read; other columns are ignored. Rows without an id get no class. Documents
    whose sets of five-word shingles are equal are one text; a text without words is like no other. An id
    with several texts has the one with the smallest digest; one without words counts only alone.
    """

    def __init__(self, documents: DataFrame, similarity: float = SIMILARITY):
        self.spark = documents.sparkSession
        self.texts = documents.select("doc_id", "text").filter(F.col("doc_id").isNotNull())
        self.similarity = similarity
        self._members = self._classes()
        self.links = self._find()

    def _stored(self, rows: DataFrame, label: str) -> DataFrame:
        return stored(rows, working_dir(self.spark, label))

    def _classes(self) -> DataFrame:
        """``doc_id, text_id``: the smallest id with the same shingles; keeps the texts' band keys."""
        sketched = self._stored(self.texts.mapInPandas(_sketch, _SKETCH), "sketches")
        worded = sketched.filter(F.col("high").isNotNull())
        digest = F.struct("high", "low")
        self._repeated = self._stored(
            worded.groupBy("doc_id").agg(F.min(digest).alias("least"), F.count(F.lit(1)).alias("rows"))
            .filter("rows > 1").select("doc_id", "least"), "repeated")
        worded = worded.join(self._repeated, "doc_id", "left").filter(
            F.col("least").isNull() | (F.col("least") == digest)).drop("least")
        # written, so that the join below it is a plain one, in which Spark can split a large class
        first = self._stored(
            worded.groupBy("high", "low").agg(F.min("doc_id").alias("text_id")), "texts")
        joined = self._stored(worded.join(first, ["high", "low"]).select(
            "doc_id", "text_id", "size", "bits",
            F.when(F.col("doc_id") == F.col("text_id"), F.col("bands")).alias("bands")), "classes")
        self._bands = joined.filter(F.col("bands").isNotNull()).dropDuplicates(["doc_id"])
        alone = sketched.filter(F.col("high").isNull()).select("doc_id").join(
            joined.select("doc_id"), "doc_id", "left_anti")
        return joined.select("doc_id", "text_id").unionAll(
            alone.select("doc_id", F.col("doc_id").alias("text_id"))).distinct()

    def _texts_of(self, ids: DataFrame) -> DataFrame:
        """``doc_id, text`` of these ids, one row each; of an id with several texts the one that counts."""
        if ids.count() <= MOST_SENT:  # then the texts that aren't asked for needn't be shuffled
            ids = F.broadcast(ids)
        texts = self.texts.join(ids, "doc_id", "left_semi")
        if self._repeated.isEmpty():
            return texts
        repeated = texts.join(self._repeated, "doc_id").select("doc_id", "text", "least.*").mapInPandas(
            _least_texts, "doc_id long, text string").dropDuplicates(["doc_id"])
        return texts.join(self._repeated, "doc_id", "left_anti").unionAll(repeated)

    def _find(self) -> DataFrame:
        """Verified links ``a, b, similarity`` between texts, each pair once.

        In each band's bucket all texts are compared with the bucket's few most central ones, those that
        share the most buckets with others. So copies of one another become one component at a cost in
        proportion to their number. That says nothing of the texts that aren't alike these, and a bucket
        may hold many which have just a frequent passage in common. What may still be missing are links
        between components, and two texts that are similar enough share one of their rarest shingles. So
        the texts of each rare shingle are compared further: with its most central ones, in passes, and
        at last all that are in different components. Nothing is capped.
        """
        rows = self._bands.select(
            F.col("doc_id").alias("id"), "size", F.explode("bands").alias("bucket"))
        shared = self._stored(self._met(rows), "buckets")
        sketches = self._bands.select(F.col("doc_id").alias("id"), "size", "bits")
        self._tried = self._found = None
        links = self._led(shared, sketches, LEADERS)
        keys = self._rare_keys(shared)
        for leaders in KEY_LEADERS:
            mixed = self._mixed(keys)
            if mixed.isEmpty():
                return links
            more = self._led(mixed, sketches, leaders, links)
            if more.isEmpty():
                break
            links = links.unionAll(more)
        pairs = self._untried(self._across(keys, sketches))
        checked = self._checked(pairs)
        if not checked.isEmpty():
            links = links.unionAll(checked)
            self._found = self._stored(components(links), "found")
        return links

    @staticmethod
    def _met(rows: DataFrame) -> DataFrame:
        """The rows of buckets with more than one text, with their number."""
        texts = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1")
        return rows.join(texts, "bucket")

    def _led(self, shared: DataFrame, sketches: DataFrame, leaders_each: int,
             links: DataFrame | None = None) -> DataFrame:
        """New links of each bucket's texts with its most central ones."""
        central = shared.groupBy("id").agg(F.sum("texts").alias("degree")).join(sketches, "id")
        members = self._stored(self._component_of(
            shared.select("bucket", "id").join(central, "id"), "id"), "buckets")
        first = Window.partitionBy("bucket").orderBy(F.desc("degree"), "id")
        leaders = self._stored(members.withColumn("place", F.row_number().over(first)).filter(
            F.col("place") <= leaders_each).select(
            "bucket", F.col("id").alias("other"), F.col("size").alias("length"),
            F.col("bits").alias("their_bits"), F.col("component").alias("theirs")), "leaders")
        pairs = members.join(leaders, "bucket").filter(
            (F.col("component") != F.col("theirs")) & self._alike())
        checked = self._checked(self._untried(self._ordered(pairs)))
        if self._found is None or not checked.isEmpty():
            all_links = checked if links is None else links.unionAll(checked)
            self._found = self._stored(components(all_links), "found")
        return checked

    def _alike(self) -> Column:
        """Sets whose sizes or sketches differ by more aren't similar enough."""
        apart = reduce(Column.__add__, [
            F.bit_count(F.col("bits")[at].bitwiseXOR(F.col("their_bits")[at]))
            for at in range(-(-BANDS * ROWS // 64))])
        return (apart <= MOST_APART) & (
            F.least("size", "length") >= self.similarity * F.greatest("size", "length"))

    @staticmethod
    def _ordered(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.least("id", "other").alias("a"),
                            F.greatest("id", "other").alias("b")).distinct()

    def _untried(self, pairs: DataFrame) -> DataFrame:
        """Stores the pairs that no earlier pass has compared, and remembers them."""
        if self._tried is not None:
            pairs = pairs.join(self._tried, ["a", "b"], "left_anti")
        pairs = self._stored(pairs, "pairs")
        self._tried = pairs if self._tried is None else self._tried.unionAll(pairs)
        return pairs

    def _component_of(self, rows: DataFrame, name: str) -> DataFrame:
        """Adds the ``component`` that the text in column ``name`` is in by now."""
        if self._found is None:
            return rows.withColumn("component", F.col(name))
        found = self._found.select(F.col("id").alias(name), F.col("component").alias("now"))
        return rows.join(found, name, "left").withColumn(
            "component", F.coalesce("now", name)).drop("now")

    def _rare_keys(self, shared: DataFrame) -> DataFrame:
        """``bucket, id, place, texts``: shingles that two similar texts of those that share a band's
        bucket can't all miss, and their place in the order of the text's.

        Any order of the shingles would do, as long as it is one for all texts; the fewer texts the first
        ones are in, the fewer pairs meet. So the frequent ones come last, by their number of texts.
        """
        ids = self._stored(shared.select(F.col("id").alias("doc_id")).distinct(), "compared")
        with session_conf(self.spark, {_RECORDS: BATCH}):
            sets = self._stored(self._texts_of(ids).mapInArrow(
                _shingled, "id long, shingles array<long>"), "shingles")
        counted = self._stored(
            sets.select(F.explode("shingles").alias("shingle")).groupBy("shingle").agg(
                F.count(F.lit(1)).alias("texts")).filter(F.col("texts") >= LEAST_FREQUENT), "counts")
        frequent = counted.filter(F.col("texts") >= self._frequent_from(counted)).orderBy(
            "texts", "shingle").select("shingle")
        ranked = frequent.toArrow()["shingle"].to_numpy()
        with session_conf(self.spark, {_RECORDS: BATCH}):
            keys = self._stored(sets.mapInArrow(
                _rare(ranked, self.similarity), "id long, bucket long, place long"), "keys")
        return self._stored(self._met(keys), "keys")

    @staticmethod
    def _frequent_from(counted: DataFrame) -> int:
        """The least number of texts from which on shingles are few enough for a broadcast."""
        power = F.length(F.bin("texts")) - 1
        powers = {row[0]: row[1] for row in counted.groupBy(power).count().collect()}  # 64 at most
        least, held = 63, 0
        while 2 ** least > LEAST_FREQUENT and held + powers.get(least - 1, 0) <= MOST_FREQUENT:
            least -= 1
            held += powers.get(least, 0)
        return 2 ** least

    def _mixed(self, keys: DataFrame) -> DataFrame:
        """The rows of those keys whose texts aren't all in one component."""
        members = self._component_of(keys, "id")
        several = members.groupBy("bucket").agg(
            F.min("component").alias("least"), F.max("component").alias("most")).filter(
            F.col("least") < F.col("most")).select("bucket")
        return self._stored(keys.join(several, "bucket", "left_semi"), "mixed")

    def _across(self, keys: DataFrame, sketches: DataFrame) -> DataFrame:
        """Pairs ``a, b`` of texts that share a key and no component, and that are alike.

        The first key that two texts share has all that they share behind it, in either's order. So the
        smaller of what they have left from there on has to be as many as similar texts of their sizes
        share. That leaves out texts whose common part is a frequent passage: it comes late in both.

        One of the two is outside the key's largest component. Those of it are compared with all of the
        key, in blocks, so that no task's key holds all of them.
        """
        members = self._stored(self._component_of(keys.drop("texts"), "id"), "buckets")
        parts = members.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("texts"))
        mixed = parts.groupBy("bucket").agg(
            F.max(F.struct("texts", "component")).alias("main"), F.sum("texts").alias("texts"),
        ).filter(F.col("texts") > F.col("main.texts")).select(
            "bucket", F.col("main.component").alias("main"),
            F.ceil(F.col("texts") / BLOCK).alias("rows"),
            F.ceil((F.col("texts") - F.col("main.texts")) / BLOCK).alias("columns"))
        members = self._stored(members.join(mixed, "bucket").join(sketches, "id"), "buckets")
        every = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))
        each = members.withColumn("row", F.pmod(F.xxhash64("id"), F.col("rows"))).withColumn(
            "column", every("columns")).select(
            "bucket", "row", "column", "id", "size", "bits", "place", "component", "main")
        others = members.filter(F.col("component") != F.col("main")).withColumn(
            "column", F.pmod(F.xxhash64("id"), F.col("columns"))).withColumn(
            "row", every("rows")).select(
            "bucket", "row", "column", F.col("id").alias("other"), F.col("size").alias("length"),
            F.col("bits").alias("their_bits"), F.col("place").alias("their_place"),
            F.col("component").alias("theirs"))
        left = F.least(F.col("size") - F.col("place"), F.col("length") - F.col("their_place"))
        enough = left * (1 + self.similarity) >= (
            self.similarity * (F.col("size") + F.col("length")) - 1e-6)
        pairs = each.join(others, ["bucket", "row", "column"]).filter(
            (F.col("component") != F.col("theirs")) & enough & self._alike()
            & ((F.col("component") == F.col("main")) | (F.col("id") < F.col("other"))))
        return self._ordered(pairs)

    def _checked(self, pairs: DataFrame) -> DataFrame:
        """The pairs that are similar enough by their whole texts, stored."""
        ids = self._stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(),
                           "compared")
        texts = self._texts_of(ids)
        both = pairs.join(
            texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a"
        ).join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
        found = both.mapInPandas(_similarities, "a long, b long, similarity double")
        with session_conf(self.spark, {_RECORDS: BATCH}):
            return self._stored(found.filter(F.col("similarity") >= self.similarity).groupBy(
                "a", "b").agg(F.max("similarity").alias("similarity")), "links")

    def classes(self) -> DataFrame:
        """``doc_id, text_id, class_id, kept``, one row per id: the smallest id among documents of
        the same shingles, the smallest reachable through links, and whether it is the id itself."""
        found = self._found.select(
            F.col("id").alias("text_id"), F.col("component").alias("class_id"))
        joined = self._members.join(found, "text_id", "left")
        class_id = F.coalesce("class_id", "text_id")
        return joined.select("doc_id", "text_id", class_id.alias("class_id"),
                             (F.col("doc_id") == class_id).alias("kept"))


def drop_near_duplicates(documents: DataFrame) -> DataFrame:
    """One document of each class of near duplicates, with all its columns.

    Repeated rows of one id are one document, of which one row stays. Rows without an id can be no
    one's copy by number and stay.
    """
    dropped = NearDuplicates(documents).classes().filter(~F.col("kept")).select("doc_id")
    spark = documents.sparkSession
    named = documents.filter(F.col("doc_id").isNotNull())
    kept = named.join(stored(dropped, working_dir(spark, "dropped")), "doc_id", "left_anti")
    repeated = stored(
        named.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
        .select("doc_id"), working_dir(spark, "repeated"))
    return (
        kept.join(repeated, "doc_id", "left_anti")
        .unionByName(kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"]))
        .unionByName(documents.filter(F.col("doc_id").isNull()))
    ).select(*documents.columns)
