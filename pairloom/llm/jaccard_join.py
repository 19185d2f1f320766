"""N-gram Jaccard join: parity sketches, pigeonhole keys per size band, exact verification.

A document's set is the distinct shingles of its text. Two sets of sizes ``a <= b`` with Jaccard
similarity ``t`` or more differ in at most ``(1 - t) / (1 + t) * (a + b)`` shingles. Shingles are
dealt to the blocks of a sketch, and each shingle toggles (XOR) its own code in its block, so the
number of blocks in which two sketches differ is a lower bound of the sets' difference. A size
band has more blocks than sets in it may differ in, so two similar sets agree in some block.
Keys are the blocks' values; sets that meet in a key are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.llm.arrow_rows import map_batches
from pairloom.llm.components import components
from pairloom.llm.key_filter import may_be_in
from pairloom.llm.scratch import keep, release, remove
from pairloom.llm.text_words import SPACED_LOWER, groups, mix, ngrams, words_of

WORDS = 4
PERCENT = 85
#: Growth of the size bands' bounds, in percent.
BAND_PERCENT = 140
#: Groups of more classes than this are thinned.
LARGE = 16
#: Classes of one group in a tile of sketch comparisons.
TILE = 2048
#: Groups, the largest first, by which a class's pairs are told to have met before.
EARLIER = 8
#: Shingles for which the key shuffle has one bucket, and keys that a bucket's task sorts at once.
BUCKET_SHINGLES, SLICE_KEYS = 1 << 22, 1 << 19
#: Bits of a key that are sent, beside its bucket.
SENT_BITS = 32
#: Sets compared with a hub in one task's run.
SALT_SETS = 512


def shingle_sets(texts: list[bytes | None], n: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words is one shingle."""
    words = words_of(texts, SPACED_LOWER)
    at, value = ngrams(words, n)
    cuts = np.searchsorted(at, words.first)
    out = []
    for k in range(len(texts)):
        low, high = words.first[k], words.first[k + 1]
        if high - low >= n:
            out.append(np.unique(value[cuts[k] : cuts[k + 1]]))
        elif high > low:
            code = np.uint64(high - low)
            for h in words.hash[low:high]:
                code = mix(np.array([code]))[0] ^ h
            out.append(mix(np.array([code], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def class_code(values: np.ndarray) -> int:
    """A 64-bit code of a whole set, as a signed number."""
    code = np.add.reduce(mix(values + np.uint64(1))) + np.uint64(len(values))
    return int(mix(np.array([code], dtype=np.uint64)).view(np.int64)[0])


def parity_sketch(values: np.ndarray) -> np.ndarray:
    """Bits, two per shingle or more, each the parity of the shingles that fall on it."""
    bits = 64
    while bits < 2 * len(values):
        bits *= 2
    place = (mix(values ^ np.uint64(0x5555)) % np.uint64(bits)).astype(np.int64)
    return np.packbits(np.bincount(place, minlength=bits).astype(np.uint8) & 1, bitorder="little").view(np.uint64)


def folded(sketch: np.ndarray, words: int) -> np.ndarray:
    """The same parities over fewer bits: places that meet add up."""
    while sketch.shape[-1] > words:
        half = sketch.shape[-1] // 2
        sketch = sketch[..., :half] ^ sketch[..., half:]
    return sketch


def links(a: int, b: int, shared: int, percent: int = PERCENT) -> bool:
    """Whether sets of sizes ``a`` and ``b`` with ``shared`` common shingles are similar."""
    return 100 * shared >= percent * (a + b - shared) and shared > 0


class Bands:
    """Size bands and the number of blocks of their sketches."""

    def __init__(self, percent: int = PERCENT):
        self.percent = percent
        self.share = Fraction(100 - percent, 100 + percent)

    def bounds(self, largest: int) -> list[tuple[int, int]]:
        out, low = [], 1
        while low <= largest:
            high = max(low, low * BAND_PERCENT // 100)
            out.append((low, high))
            low = high + 1
        return out

    def blocks(self, high: int) -> tuple[int, int]:
        """Blocks of a band's sketches, and how many of them are beyond the pigeonhole's need.

        Similar sets agree in one block more than these spare ones.
        """
        most = int(self.share * 2 * high)
        spare = 2 + most // 2
        return most + 1 + spare, spare

    def least(self, low: int) -> int:
        """The smallest set similar to one of size ``low``."""
        return -(-low * self.percent // 100)


def sketch_keys(
    sets: list[np.ndarray], percent: int = PERCENT, sent: int = SENT_BITS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(set, key, tag)`` for each block that a set must be found by, in all its bands.

    Blank blocks are left out as long as they are no more than the spare ones: similar sets then
    still agree in a block that is not blank. The tag is ``band * 65536`` plus the number of keys
    that the set may yet do without in that band. Keys of a set that are alike in their ``sent`` low
    bits may become one where only these are sent, so the number is less by those.
    """
    bands = Bands(percent)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    owner, keys, tags = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
    if not len(sizes) or not sizes.max():
        return owner[0], keys[0], tags[0]
    for number, (low, high) in enumerate(bands.bounds(-(-int(sizes.max()) * 100 // percent))):
        if int(bands.share * 2 * high) == 0:
            continue  # only equal sets are similar at these sizes
        inside = np.flatnonzero((sizes >= bands.least(low)) & (sizes <= high))
        if not len(inside):
            continue
        m, spare = bands.blocks(high)
        flat = np.concatenate([sets[i] for i in inside])
        block = (mix(flat ^ np.uint64(number + 1)) % np.uint64(m)).astype(np.int64)
        cell = np.repeat(np.arange(len(inside)) * m, sizes[inside]) + block
        sketch = np.zeros(len(inside) * m, dtype=np.uint64)
        np.bitwise_xor.at(sketch, cell, flat)
        sketch = sketch.reshape(len(inside), m)
        blank = sketch == 0
        left = spare - blank.sum(axis=1)
        row, column = np.nonzero(~blank | (left < 0)[:, None])
        place = np.arange(m, dtype=np.uint64) + np.uint64((number + 1) << 32)
        owner.append(inside[row])
        made = mix(sketch ^ mix(place)[None, :])
        low_bits = made.astype(np.uint32) & np.uint32((1 << sent) - 1)
        low_bits.sort(axis=1)
        left -= (low_bits[:, 1:] == low_bits[:, :-1]).sum(axis=1)
        keys.append(made[row, column])
        tags.append((number << 16) + np.minimum(np.maximum(left, 0), 65535)[row])
    return np.concatenate(owner), np.concatenate(keys), np.concatenate(tags)


def _classes(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``(doc_id, row_key, n, cid, sketch)`` of every row: its key, and size, class and parity sketch of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for batch in batches:
            ids, keys = batch.column("doc_id"), batch.column("row_key")
            for low, high, texts in groups(batch):
                sets = shingle_sets(texts, words)
                n = np.array([len(s) for s in sets], dtype=np.int64)
                code = np.array([class_code(s) for s in sets], dtype=np.int64)
                sketch = pa.array([parity_sketch(s).tobytes() for s in sets], pa.binary())
                columns = [ids.slice(low, high - low), keys.slice(low, high - low), n, code, sketch]
                yield pa.record_batch(columns, ["doc_id", "row_key", "n", "cid", "sketch"])

    own = [*[T.StructField(c, T.LongType()) for c in ("row_key", "n", "cid")], T.StructField("sketch", T.BinaryType())]
    schema = T.StructType([docs.schema["doc_id"], *own])
    return map_batches(docs.select("doc_id", "text", _row_key()), run, schema)


def _row_key() -> Column:
    """A stable key of a row, which needs no id: of rows with one key any will do, if of the class meant."""
    return F.xxhash64("doc_id", "text").alias("row_key")


def _key_rows(docs: DataFrame, words: int, percent: int, buckets: int) -> DataFrame:
    """Keys and classes, packed per bucket of keys and batch of documents.

    Of a key its bucket and 32 bits are sent, with its class's place in a list of the classes that
    the bucket gets from the batch. The longer a bucket, the more keys share an entry of that list.
    Different keys that become one are one meeting more, no link less.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, texts in groups(batch):
                sets = shingle_sets(texts, words)
                code = np.array([class_code(s) for s in sets], dtype=np.int64)
                _, first = np.unique(code, return_index=True)
                sets, code = [sets[i] for i in first], code[first]
                owner, keys, tags = sketch_keys(sets, percent)
                bucket = ((keys >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
                full = np.flatnonzero(np.diff(edges))
                parts = [order[edges[b] : edges[b + 1]] for b in full]
                # Few classes make many keys, so a key carries its class's place in a list.
                used = [np.unique(owner[p], return_inverse=True) for p in parts]
                columns = [
                    [(keys[p] & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes() for p in parts],
                    [code[u].tobytes() for u, _ in used],
                    [_small(at.astype(np.uint32)) for _, at in used],
                    [_small(tags[p].astype(np.uint32)) for p in parts],
                ]
                yield pa.record_batch([full, *[pa.array(c, pa.binary()) for c in columns]], ["bucket", *_KEYED])

    return map_batches(docs.select("text"), run, "bucket long, " + ", ".join(f"{c} binary" for c in _KEYED))


_KEYED = ["keys", "cids", "owners", "tags"]


def _small(values: np.ndarray) -> bytes:
    """32-bit values as compressed planes of bytes."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), 4).T.tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _large(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:8], "little")
    data = pa.decompress(raw[8:], 4 * n, "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(4, n).T).view(np.uint32).ravel()


def _meetings(rows: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame]:
    """``(meeting, cid, n)``: classes that share ``n`` keys.

    Equal groups of classes are one meeting. Similar classes share at least one key of a band more
    than either may do without, so each class leaves out that many of its most crowded keys, as
    the prefix filter of set joins does: by crowd and group, the rarest key that two such classes
    share stays with both. This frees groups that only a common passage holds together, and
    classes that share too few keys with all others meet none of them.
    """

    def shared(keys: np.ndarray, cids: np.ndarray, tags: np.ndarray) -> tuple[np.ndarray, ...] | None:
        """Sizes, keys, classes and tags of the groups of more than one class, by key."""
        order = np.lexsort((cids, keys))
        keys, cids, tags = keys[order], cids[order], tags[order]
        fresh = np.append(True, (keys[1:] != keys[:-1]) | (cids[1:] != cids[:-1]))
        keys, cids, tags = keys[fresh], cids[fresh], tags[fresh]
        edges = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        sizes = np.diff(np.append(edges, len(keys)))
        more = np.repeat(sizes > 1, sizes)
        return (sizes[sizes > 1], keys[edges[sizes > 1]], cids[more], tags[more]) if more.any() else None

    def flush(bucket: int, held: list[dict]) -> pa.RecordBatch | None:
        listed = np.concatenate([np.frombuffer(h["cids"], dtype=np.int64) for h in held])
        ends = np.cumsum([len(h["keys"]) // 4 for h in held])
        keys, owners, tags = (np.empty(ends[-1], dtype=np.uint32) for _ in range(3))
        start = 0
        for low, high, h in zip([0, *ends], ends, held):
            keys[low:high] = np.frombuffer(h["keys"], dtype="<u4")
            owners[low:high] = _large(h["owners"])
            owners[low:high] += np.uint32(start)
            tags[low:high] = _large(h["tags"])
            start += len(h["cids"]) // 8
        held.clear()
        # Sorted slice by slice, for memory; equal keys are in one slice.
        bits = max(0, len(keys) - 1).bit_length() - (SLICE_KEYS - 1).bit_length()
        slices = 1 << max(0, min(bits, 8))
        slice_of = (keys >> np.uint32(24)).astype(np.uint8) >> np.uint8(9 - slices.bit_length())
        found = []
        for k in range(slices):
            at = np.flatnonzero(slice_of == k)
            whole = keys[at] | ((tags[at] >> 16).astype(np.uint64) << np.uint64(32))  # a key is of one band
            if len(at) and (some := shared(whole, listed[owners[at]], tags[at])) is not None:
                found.append(some)
        if not found:
            return None
        sizes, keys, cids, tags = (np.concatenate(c) for c in zip(*found))
        begins = np.cumsum(sizes) - sizes
        # A small group's code depends on its members alone, so equal groups are one meeting.
        code = mix(np.add.reduceat(mix(cids.view(np.uint64) + np.uint64(7)), begins) + sizes.astype(np.uint64))
        code = np.where(sizes > LARGE, mix(keys ^ mix(np.array([bucket + 1], dtype=np.uint64))), code)
        own = mix(code ^ mix((tags[begins] >> 16).astype(np.uint64)))  # counted for each band
        _, first, count = np.unique(own, return_index=True, return_counts=True)
        times = np.zeros(len(sizes), dtype=np.int64)
        times[first] = count
        at = np.repeat(times > 0, sizes)
        columns = [np.repeat(code.view(np.int64), sizes), cids, np.repeat(times, sizes), np.repeat(sizes, sizes), tags.astype(np.int64)]
        return pa.record_batch([c[at] for c in columns], ["meeting", "cid", "n", "crowd", "tag"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            buckets = batch.column("bucket").to_pylist()
            for k, bucket in enumerate(buckets):
                if bucket != now and held:
                    if (found := flush(now, held)) is not None:
                        yield found
                    held = []
                now = bucket
                held.append({c: memoryview(batch.column(c)[k].as_buffer()) for c in _KEYED})
        if held and (found := flush(now, held)) is not None:
            yield found

    dealt = rows.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    found = keep(map_batches(dealt, run, "meeting long, cid long, n long, crowd long, tag long"), "meetings", "zstd")
    release(rows.sparkSession)  # the keys, before groups are shuffled
    band, spare = F.shiftright("tag", 16), F.col("tag").bitwiseAND(65535)
    # A small group may come from several buckets: the sum to a group holds all keys of it.
    crowded = Window.partitionBy("cid", "band").orderBy(F.desc("crowd"), "meeting")
    held = found.withColumn("band", band).withColumn("keys", F.sum("n").over(crowded)).where(F.col("keys") > spare)
    return held.groupBy("meeting", "cid").agg(F.sum("n").alias("n")), found


def _packed_texts(docs: DataFrame, classes: DataFrame, cids: DataFrame, words: int) -> DataFrame:
    """``(cid, packed)``: the compressed text of one document for each class in ``cids``.

    A compressed text is a third as large as its set.
    """
    wanted = classes.groupBy("cid").agg(F.min("row_key").alias("row_key")).join(cids, "cid", "left_semi")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, texts in groups(batch):
                part = batch.slice(low, high - low)
                # Rows of one key may differ in text: the class says which is meant.
                code = np.array([class_code(s) for s in shingle_sets(texts, words)], dtype=np.int64)
                right = code == part.column("cid").to_numpy()
                cids, texts = part.column("cid").filter(pa.array(right)), [t for t, r in zip(texts, right) if r]
                small = [len(t).to_bytes(8, "little") + pa.compress(t, codec="zstd", asbytes=True) for t in texts]
                yield pa.record_batch([cids, pa.array(small, pa.binary())], ["cid", "packed"])

    wanted = keep(wanted, "wanted")
    near = may_be_in(wanted, "row_key")
    texts = docs.select(_row_key(), "text").where(near("row_key")).join(wanted, "row_key")
    return map_batches(texts, packed, "cid long, packed binary").dropDuplicates(["cid"])


def _verified(texts: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """``(u, v)``: the pairs ``(cid, hub)`` of classes whose sets are similar.

    ``texts`` go to the hubs they are compared with. A hub with many partners is copied to
    several runs, so none grows with the hub.
    """
    load = pairs.groupBy("hub").agg(F.count(F.lit(1)).alias("load"))
    salts = F.ceil(F.col("load") / SALT_SETS)
    member = pairs.join(load, "hub").select(
        "cid", "hub", F.pmod(F.xxhash64("cid"), salts).cast("long").alias("salt"), F.lit(False).alias("own")
    )
    runs = F.explode(F.sequence(F.lit(0).cast("long"), (salts - 1).cast("long")))
    own = load.select(F.col("hub").alias("cid"), "hub", runs.alias("salt"), F.lit(True).alias("own"))
    sends = member.union(own)
    dealt = sends.join(texts, "cid").repartition("hub", "salt").sortWithinPartitions("hub", "salt", F.desc("own"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, hub_set = None, None
        for batch in batches:
            raw = [p.as_py() for p in batch.column("packed")]
            columns = [batch.column(c).to_pylist() for c in ("cid", "hub", "salt", "own")]
            u, v = [], []
            for at in range(0, len(raw), 64):
                texts = [pa.decompress(r[8:], int.from_bytes(r[:8], "little"), "zstd", asbytes=True) for r in raw[at : at + 64]]
                for k, values in enumerate(shingle_sets(texts, words)):
                    cid, to, salt, own = (c[at + k] for c in columns)
                    if own:
                        hub, hub_set = (to, salt), values
                        continue
                    assert hub == (to, salt)
                    place = np.searchsorted(hub_set, values).clip(max=len(hub_set) - 1)
                    if links(len(values), len(hub_set), int((hub_set[place] == values).sum()), percent):
                        u.append(cid)
                        v.append(to)
            yield pa.record_batch([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return map_batches(dealt.select("cid", "hub", "salt", "own", "packed"), compare, "u long, v long")


def similar_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every row of ``docs (doc_id, text)``.

    ``component_id`` is the smallest ``doc_id`` reachable by links between similar sets, a
    document without words being linked with nothing. Equal sets are one class and are compared
    once. The smallest class of each key's group is its hub, and each class is first compared
    with the hub that it shares most groups with, which settles groups of near copies without
    forming their pairs. What is left are the pairs of one group that lie in different
    components. Tiles of their sketches find those whose Hamming distance allows a link, and
    each class is compared with the nearest one, then, in what is still apart, with the nearest
    4, 16 and so on until no pair is left that could be a link. So links join components after
    a few comparisons a class, and no link between components is missed.

    A null text is an empty one. Rows with a null ``doc_id`` link as all others do, and keep a
    null component where no row of it has an id. Repeated rows and repeated ids keep a
    row each and are linked only if their sets are. Other columns are ignored; an empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    classes = keep(_classes(docs, words, percent), "classes")
    total = classes.where("n > 0").agg(F.sum("n").alias("n")).first().n or 0
    buckets = max(1, total // BUCKET_SHINGLES, min(total // SLICE_KEYS, spark.sparkContext.defaultParallelism))
    thinned, found = _meetings(_key_rows(docs, words, percent, buckets), buckets)
    meetings = keep(thinned, "meetings")
    remove(spark, found)
    release(spark)
    hubs = meetings.groupBy("meeting").agg(F.min("cid").alias("hub"))
    shared = meetings.join(hubs, "meeting").where("cid != hub").groupBy("cid", "hub").agg(F.sum("n").alias("n"))
    first = keep(shared.groupBy("cid").agg(F.min_by("hub", F.struct(-F.col("n"), "hub")).alias("hub")), "pairs")
    texts = keep(_packed_texts(docs, classes, meetings.select("cid").distinct(), words), "texts")
    met = classes.join(meetings.select("cid").distinct(), "cid", "left_semi").select("cid", "n", "sketch")
    sketches = keep(met.dropDuplicates(["cid"]), "sketches")
    edges = keep(_verified(texts, first, words, percent), "links")
    release(spark)
    labels = keep(components(edges), "labels")
    tried, nearest, rows = first, 1, meetings
    while True:
        open_rows = keep(_open(rows, labels), "open")
        near = keep(_nearest(open_rows, sketches, percent, nearest), "near")
        pairs = near.where("other IS NOT NULL").select(
            F.greatest("cid", "other").alias("cid"), F.least("cid", "other").alias("hub")
        ).distinct()
        rest = keep(pairs.join(tried, ["cid", "hub"], "left_anti"), "pairs")
        if not rest.isEmpty():
            more = keep(_verified(texts, rest, words, percent), "links")
            labels = keep(_joined(labels, more), "labels")
            tried = tried.union(rest)
        # A pair that is not tried yet is beyond the nearest ones of both its classes.
        rows = open_rows.join(keep(near.where("left").select("cid"), "left"), "cid", "left_semi")
        release(spark)
        if rows.isEmpty():
            break
        rows = keep(rows.select("meeting", "cid"), "rows")
        remove(spark, open_rows, near)
        nearest *= 4
    remove(spark, meetings, texts, sketches)
    return _labelled(classes, labels)


def _joined(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` after ``edges (u, v)`` join components: only these are gone through again."""
    of = labels.select(F.col("node").alias("u"), F.col("component").alias("cu"))
    to = labels.select(F.col("node").alias("v"), F.col("component").alias("cv"))
    ends = edges.join(of, "u", "left").join(to, "v", "left")
    found = components(ends.select(F.coalesce("cu", "u").alias("u"), F.coalesce("cv", "v").alias("v")))
    found = keep(found.withColumnRenamed("component", "better"), "joined")
    old = labels.join(found.withColumnRenamed("node", "component"), "component", "left")
    new = found.join(labels.select("node"), "node", "left_anti")
    return old.select("node", F.coalesce("better", "component").alias("component")).union(new.select("node", "better"))


def _open(meetings: DataFrame, labels: DataFrame) -> DataFrame:
    """``(meeting, cid, component, crowd)`` of groups whose classes are not all in one component."""
    rows = meetings.join(labels.withColumnRenamed("node", "cid"), "cid", "left").select(
        "meeting", "cid", F.coalesce("component", "cid").alias("component")
    )
    mixed = rows.groupBy("meeting").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("crowd")
    )
    return rows.join(mixed.where("low != high").select("meeting", "crowd"), "meeting")


def _nearest(open_rows: DataFrame, classes: DataFrame, percent: int, most: int) -> DataFrame:
    """``(cid, other, left)``: each class with those of other components that are nearest to it.

    Classes of one group are compared by their sizes and sketches: pairs whose sketches differ in
    more bits than similar sets can differ in shingles are none. Of the rest, a class has its ``most``
    nearest ones, and ``left`` is true in a row (``other`` null) where it has more. So what is
    written grows with the classes and not with the pairs of a group.
    """
    # The same pair may come from several groups.
    once = _tile_pairs(open_rows, classes, percent, most).groupBy("cid", "other").agg(F.min("apart").alias("apart"))
    place = F.row_number().over(Window.partitionBy("cid").orderBy("apart", "other"))
    ranked = once.withColumn("place", place).where(F.col("place") <= most + 1)
    beyond = F.col("place") > most
    return ranked.select("cid", F.when(~beyond, F.col("other")).alias("other"), beyond.alias("left"))


def _tile_pairs(open_rows: DataFrame, classes: DataFrame, percent: int, most: int) -> DataFrame:
    """``(cid, other, apart)``: the ``most`` nearest classes and one more, of each class in a tile.

    A group is dealt to blocks of about ``TILE`` classes, and each pair of blocks is one tile, so
    no task holds a group.

    Near copies meet in many groups. Each class knows its ``EARLIER`` largest ones, and a pair with
    one of these in common that is larger than the group at hand is left to that one.
    """
    sketches = classes.select("cid", "n", "sketch").dropDuplicates(["cid"])
    block, other = F.col("block"), F.col("other")
    rank = F.struct((-F.col("crowd")).alias("size"), "meeting")
    largest = F.row_number().over(Window.partitionBy("cid").orderBy(F.desc("crowd"), "meeting"))
    firsts = open_rows.withColumn("place", largest).where(F.col("place") <= EARLIER)
    firsts = firsts.groupBy("cid").agg(F.collect_list(rank).alias("firsts"))
    before = F.filter("firsts", lambda x: x < F.struct((-F.col("crowd")).alias("size"), "meeting"))
    rows = (
        open_rows.join(firsts, "cid")
        .withColumn("before", F.transform(before, lambda x: x["meeting"]))
        .withColumn("blocks", F.ceil(F.col("crowd") / TILE))
        .withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .join(sketches, "cid")
        .select(
            "meeting", F.least(block, other).alias("left"), F.greatest(block, other).alias("right"),
            (block <= other).alias("rows"), (block >= other).alias("columns"), "cid", "component", "n", "sketch", "before",
        )
    )
    order = ["meeting", "left", "right", "cid"]
    dealt = rows.repartition("meeting", "left", "right").sortWithinPartitions(*order)
    share = Bands(percent).share

    def tile(held: list[tuple]) -> np.ndarray:
        """``(cid, other, apart)`` of one tile, whose rows are runs of Arrow batches.

        A class with more than ``most`` near ones has one row beyond them.
        """

        def whole(name: str) -> np.ndarray:
            return np.concatenate([b.column(name).to_numpy(zero_copy_only=False)[i:j] for b, i, j in held])

        cid, component, n, over, under = (whole(c) for c in ("cid", "component", "n", "rows", "columns"))
        before = _padded(pa.concat_arrays([b.column("before").slice(i, j - i) for b, i, j in held]))
        raw = [v.as_py() for b, i, j in held for v in b.column("sketch")[i:j]]
        width = np.fromiter((len(v) // 8 for v in raw), dtype=np.int64, count=len(raw))
        members = {w: np.flatnonzero(width == w) for w in np.unique(width).tolist()}
        sketches = {w: np.stack([np.frombuffer(raw[i], dtype=np.uint64) for i in at]) for w, at in members.items()}
        found = []
        for w, rows in members.items():
            # Widths are powers of two: more than the sizes' ratio, doubled, lies beyond the limit.
            fitting = [v for v in members if percent * max(v, w) <= 200 * min(v, w)]
            for at in range(0, len(rows), 16):
                part, fits, aparts, others = rows[at : at + 16], [], [], []
                for v in fitting:
                    columns, least = members[v], min(v, w)
                    own, its = folded(sketches[w][at : at + 16], least), folded(sketches[v], least)
                    apart = np.bitwise_count(own[:, None, :] ^ its[None, :, :]).sum(axis=2, dtype=np.int64)
                    a, b = n[part][:, None], n[columns][None, :]
                    fit = (apart <= (a + b) * share.numerator // share.denominator) & (component[part][:, None] != component[columns][None, :])
                    fit &= 100 * np.minimum(a, b) >= percent * np.maximum(a, b)
                    fit &= (over[part][:, None] & under[columns][None, :]) | (under[part][:, None] & over[columns][None, :])
                    row, column = np.nonzero(fit)
                    mine, its = before[part[row]][:, :, None], before[columns[column]][:, None, :]
                    fit[row, column] = ~((mine == its) & (mine >= 0)).any(axis=(1, 2))
                    fits.append(fit)
                    aparts.append(apart)
                    others.append(cid[columns])
                fit, apart, other = np.concatenate(fits, axis=1), np.concatenate(aparts, axis=1), np.concatenate(others)
                for k in np.flatnonzero(fit.any(axis=1)).tolist():
                    near = np.flatnonzero(fit[k])
                    near = near[np.lexsort((other[near], apart[k, near]))][: most + 1]
                    found.append(np.stack([np.full(len(near), cid[part[k]]), other[near], apart[k, near]], axis=1))
        return np.concatenate(found) if found else np.zeros((0, 3), dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            keys = [batch.column(c).to_numpy() for c in ("meeting", "left", "right")]
            if not batch.num_rows:
                continue
            starts = np.flatnonzero(np.append(True, np.any([k[1:] != k[:-1] for k in keys], axis=0)))
            found: list[np.ndarray] = []
            for low, high in zip(starts.tolist(), np.append(starts[1:], batch.num_rows).tolist()):
                key = tuple(k[low] for k in keys)
                if held and key != now:
                    found.append(tile(held))
                    held = []
                now = key
                held.append((batch, low, high))
            yield _distances(found, most)
        if held:
            yield _distances([tile(held)], most)

    return map_batches(
        dealt.select("meeting", "left", "right", "rows", "columns", "cid", "component", "n", "sketch", "before"), run,
        "cid long, other long, apart long",
    )


def _padded(lists: pa.ListArray) -> np.ndarray:
    """Lists of up to ``EARLIER`` values as rows of one array: a small number for each value, -1 beyond the end."""
    size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.full((len(lists), EARLIER), -1, dtype=np.int32)
    place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(np.arange(len(lists)), size), place] = np.unique(lists.flatten().to_numpy(), return_inverse=True)[1]
    return out


def _distances(found: list[np.ndarray], most: int) -> pa.RecordBatch:
    """Distinct pairs of some tiles, no class with more than ``most`` and one beyond them."""
    rows = np.unique(np.concatenate([np.zeros((0, 3), dtype=np.int64), *found]), axis=0)
    rows = rows[np.lexsort((rows[:, 1], rows[:, 2], rows[:, 0]))]
    starts = np.flatnonzero(np.diff(rows[:, 0], prepend=rows[0, 0] - 1)) if len(rows) else np.zeros(0, dtype=np.int64)
    place = np.arange(len(rows)) - np.repeat(starts, np.diff(np.append(starts, len(rows))))
    rows = rows[place <= most]
    return pa.record_batch([rows[:, k] for k in range(3)], ["cid", "other", "apart"])


def _labelled(classes: DataFrame, linked: DataFrame) -> DataFrame:
    """Each row with the smallest ``doc_id`` of its component of classes."""
    full = classes.where("n > 0")
    own = full.groupBy("cid").agg(F.min("doc_id").alias("doc_id"))
    nodes = own.join(linked.withColumnRenamed("node", "cid"), "cid", "left").select(
        "cid", "doc_id", F.coalesce("component", "cid").alias("component")
    )
    least = nodes.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    names = nodes.join(least, "component").select("cid", "component_id")
    with_words = full.join(names, "cid").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = classes.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return with_words.union(alone)


def keep_representatives(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group of similar ones: that with the smallest id.

    Rows without words or without an id stay, and so do all rows that share the smallest id.
    """
    found = keep(similar_components(docs, words, percent), "components")
    stays = F.coalesce(F.expr("n_shingles = 0 OR doc_id IS NULL OR doc_id = component_id"), F.lit(False))
    # Fewer ids go than stay. A row that is not like any of them stays where it is.
    gone = keep(found.groupBy("doc_id").agg(F.max(stays).alias("stays")).where("NOT stays").select("doc_id"), "gone")
    near = may_be_in(gone, "doc_id")("doc_id")
    return docs.where(~near).union(docs.where(near).join(gone, "doc_id", "left_anti").select(*docs.columns))
