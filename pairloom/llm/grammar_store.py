"""Token ids in grammar-compressed shards (Re-Pair), written in ascending document order."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.arrow_rows import map_batches
from pairloom.llm.scratch import new_folder
from pairloom.llm.token_ids import word_bpe

END = 1
#: Ids per shard; a shard holds whole documents, so one may be longer by its last document.
SHARD_IDS = 1 << 20
#: A rule holds three numbers and saves one wherever its pair is replaced. Neighbouring rules take
#: some of these places, so a pair is taken to pay from here on.
LEAST = 6

_SHARD = (
    "part long, shard long, n_ids long, doc_ids array<long>, doc_lengths binary, "
    "terminals long, rounds binary, rules binary, lengths binary, sequence binary"
)
_NAMES = ["part", "shard", "n_ids", "doc_ids", "doc_lengths", "terminals", "rounds", "rules", "lengths", "sequence"]


def compress(ids: np.ndarray, ends: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(terminals, first rule of each round, rules, expansion lengths, sequence)``.

    Each round counts neighbouring pairs, gives a new symbol to each that occurs ``LEAST`` times
    or more, and replaces them from left to right, until no pair pays. After the first round
    only pairs with a symbol of the last one can have become frequent, so no others are
    counted again. Pairs across documents (``ends`` marks last ids) are left alone, so every
    document begins at a symbol.
    """
    sequence, ends = ids.astype(np.int64), ends.copy()
    terminals = int(sequence.max(initial=0)) + 1
    total, rounds, rules = terminals, [], [np.zeros((0, 2), dtype=np.int64)]
    at = np.flatnonzero(~ends[:-1])
    while len(at):
        pair = (sequence[at] << 32) | sequence[at + 1]
        chosen = _frequent(pair)
        if not len(chosen):
            break
        # Slots of a table find a pair's rule; of pairs in one slot, one gets a rule, and all
        # others there are counted again.
        bits = min(20, len(chosen).bit_length() + 5)
        table = np.full(1 << bits, -1, dtype=np.int32)
        table[_slot(chosen, bits)] = np.arange(len(chosen), dtype=np.int32)
        rule = table[_slot(pair, bits)]
        hit = rule >= 0
        hit[hit] = chosen[rule[hit]] == pair[hit]
        place = at[hit]
        begins = np.zeros(len(sequence), dtype=bool)
        begins[at[(rule >= 0) & ~hit]] = True
        # Of overlapping hits every other one counts, from the left.
        opens = np.append(True, np.diff(place) != 1)
        start = np.maximum.accumulate(np.where(opens, np.arange(len(place)), 0))
        used = (np.arange(len(place)) - start) % 2 == 0
        place = place[used]
        sequence[place] = total + rule[hit][used]
        ends[place] = ends[place + 1]
        fresh = np.zeros(len(sequence), dtype=bool)
        fresh[place] = True
        left = np.ones(len(sequence), dtype=bool)
        left[place + 1] = False
        sequence, ends, fresh, begins = sequence[left], ends[left], fresh[left], begins[left]
        begins |= fresh
        begins[:-1] |= fresh[1:]
        at = np.flatnonzero(begins[:-1] & ~ends[:-1])
        rounds.append(total)
        rules.append(np.stack([chosen >> 32, chosen & 0xFFFFFFFF], axis=1))
        total += len(chosen)
    rules = np.concatenate(rules)
    lengths = np.ones(total, dtype=np.int64)
    for begin, own in _by_round(terminals, rounds, rules):
        lengths[begin : begin + len(own)] = lengths[own].sum(axis=1)
    return terminals, np.array(rounds, dtype=np.int64), rules, lengths[terminals:], sequence


def _frequent(pair: np.ndarray) -> np.ndarray:
    """The distinct pairs that occur ``LEAST`` times or more, ascending."""
    ordered = np.sort(pair)
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    return ordered[first[np.diff(np.append(first, len(ordered))) >= LEAST]]


def _slot(pair: np.ndarray, bits: int) -> np.ndarray:
    return ((pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def _by_round(terminals: int, rounds, rules: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The first symbol and the rules of each round."""
    for begin, to in zip(rounds, [*rounds[1:], terminals + len(rules)]):
        yield int(begin), rules[begin - terminals : to - terminals]


def expand(terminals: int, rounds: np.ndarray, rules: np.ndarray, sequence: np.ndarray) -> np.ndarray:
    """The ids of a run of symbols, undoing the latest round first."""
    for begin in rounds[::-1]:
        made = sequence >= begin
        at = np.cumsum(1 + made) - 1 - made
        out = np.empty(len(sequence) + int(made.sum()), dtype=np.int64)
        out[at[~made]] = sequence[~made]
        pairs = rules[sequence[made] - terminals]
        out[at[made]], out[at[made] + 1] = pairs[:, 0], pairs[:, 1]
        sequence = out
    return sequence


def expand_all(terminals: int, rounds: np.ndarray, rules: np.ndarray, lengths: np.ndarray, sequence: np.ndarray) -> np.ndarray:
    """The ids of a whole sequence, from a table of what every symbol stands for.

    ``lengths`` are those of the rules. As each rule's pair occurred several times in the shard,
    the table is a few times as long as the shard's ids at most, however deep the rules go.
    """
    lengths = np.concatenate([np.ones(terminals, dtype=np.int64), lengths])
    starts = np.cumsum(lengths) - lengths
    table = np.empty(int(lengths.sum()), dtype=np.int64)
    table[:terminals] = np.arange(terminals)

    def spelled(symbols: np.ndarray) -> np.ndarray:
        size = lengths[symbols]
        shift = starts[symbols] - (np.cumsum(size) - size)
        return table[np.arange(int(size.sum())) + np.repeat(shift, size)]

    for begin, own in _by_round(terminals, rounds, rules):
        ids = spelled(own.ravel())
        table[starts[begin] : starts[begin] + len(ids)] = ids
    return spelled(sequence)


def _grammar(shard: dict) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What ``compress`` returned, from a shard's row."""
    rules, lengths, sequence = (np.frombuffer(shard[c], dtype="<i4").astype(np.int64) for c in ("rules", "lengths", "sequence"))
    return shard["terminals"], np.frombuffer(shard["rounds"], dtype="<i8"), rules.reshape(-1, 2), lengths, sequence


def read_range(shard: dict, start: int, n: int) -> np.ndarray:
    """Ids ``start`` to ``start + n`` of a shard, expanding only the symbols that hold them."""
    terminals, rounds, rules, lengths, sequence = _grammar(shard)
    lengths = np.concatenate([np.ones(terminals, dtype=np.int64), lengths])
    begins = np.cumsum(lengths[sequence]) - lengths[sequence]
    n = max(0, min(n, shard["n_ids"] - start))
    if not n:
        return np.zeros(0, dtype=np.int64)
    low = int(np.searchsorted(begins, start, side="right")) - 1
    high = int(np.searchsorted(begins, start + n, side="left"))
    found = expand(terminals, rounds, rules, sequence[low:high])
    return found[start - begins[low] :][:n]


def write_ids(docs: DataFrame, tokenizer: str, path: str) -> None:
    """Encode ``docs (doc_id, text)`` in ascending ``doc_id`` order into shards below ``path``.

    One row per shard: its documents and their lengths, the grammar's rules with the length
    each expands to, and the compressed sequence. Each document ends with id 1; a null text is
    that id alone. Repeated and null ids are kept (null first), ties ordered by text. Ids are
    cast to long: a text that is no number fails the job (with ANSI mode off it becomes null).
    An empty table gives no shards; other columns are ignored. Texts are
    range-partitioned by id and encoded after that; a task holds one shard.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard = TaskContext.get().partitionId(), 0
        encode = word_bpe(tokenizer).encode
        end = np.array([END], dtype="<u4").tobytes()
        doc_ids: list = []
        texts: list[bytes] = []
        size = 0

        def packed() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(texts), dtype="<u4")
            lengths = np.array([len(t) // 4 for t in texts], dtype="<i8")
            ends = np.zeros(len(ids), dtype=bool)
            ends[np.cumsum(lengths) - 1] = True
            terminals, rounds, rules, expansions, sequence = compress(ids, ends)
            row = [
                part, shard, len(ids), doc_ids, lengths.tobytes(), terminals, rounds.astype("<i8").tobytes(),
                rules.astype("<i4").tobytes(), expansions.astype("<i4").tobytes(), sequence.astype("<i4").tobytes(),
            ]
            kinds = [pa.int64()] * 3 + [pa.list_(pa.int64()), pa.binary(), pa.int64()] + [pa.binary()] * 4
            return pa.record_batch([pa.array([v], k) for v, k in zip(row, kinds)], _NAMES)

        for batch in batches:
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text").to_pylist(), end)):
                doc_ids.append(doc_id)
                texts.append(raw)
                size += len(raw) // 4
                if size >= SHARD_IDS:
                    yield packed()
                    shard, size = shard + 1, 0
                    doc_ids, texts = [], []
        if texts:
            yield packed()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    map_batches(ordered, run, _SHARD).write.option("compression", "zstd").parquet(path)


def shard_starts(shards: DataFrame) -> DataFrame:
    """``(part, shard, before)``: ids in all earlier shards, by sums per part and over parts."""
    sizes = shards.select("part", "shard", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("long")).alias("base"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum("n_ids").over(inside), F.lit(0).cast("long"))
    return sizes.withColumn("own", own).join(parts, "part").select("part", "shard", (F.col("base") + F.col("own")).alias("before"))


def read_documents(spark, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` decoded from the shards below ``path``."""
    shards = spark.read.schema(_SHARD).parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                lengths = np.frombuffer(row["doc_lengths"], dtype="<i8")
                raw = expand_all(*_grammar(row)).astype("<u4").tobytes()
                ends = np.cumsum(lengths)
                crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
                columns = [np.full(len(ends), row["part"]), np.full(len(ends), row["shard"]), pa.array(row["doc_ids"], pa.int64()), ends - lengths, lengths, np.array(crc, dtype=np.int64)]
                yield pa.record_batch(columns, ["part", "shard", "doc_id", "at", "n_tokens", "ids_crc32"])

    rows = map_batches(shards, run, "part long, shard long, doc_id long, at long, n_tokens long, ids_crc32 long")
    return rows.join(shard_starts(shards), ["part", "shard"]).select(
        "doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the ids of ``docs`` and read every document back."""
    spark = docs.sparkSession
    path = new_folder(spark, "token-shards")
    write_ids(docs, tokenizer, path)
    return read_documents(spark, path)
