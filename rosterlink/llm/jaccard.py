"""Documents whose sets of word shingles are similar, joined by token-combination prefixes.

With similarity ``t`` or more, of a set of ``n`` tokens at most
``e = n - ceil(t n)`` are not shared. So of the first ``e + m`` tokens in any
fixed order at least ``m`` are. The join uses this twice:

* Tokens ordered by hash: each set gives its extended prefix, ``e + m`` tokens
  with ``m`` near ``e``. How many sets hold a token is counted among these only.
* The tokens of the extended prefix ordered by that count: as two similar sets
  share ``m`` of them, they share one of the rarest ``e + 1`` or so. Only these
  are indexed; those of one set alone are dropped.

Equal sets are one class and only its least document takes part. A few rounds
first compare every set with one other of its rarest tokens, the one most
tokens agree on, and join what is similar; tokens whose sets are all in one
component are then done. Of the rest, rare tokens are indexed alone, frequent
ones in combinations of two, for which each set gives one token more. Pairs of
different components that meet in few are listed and verified. Where many meet
(near copies that are just not similar enough), sets are verified block by
block instead, so that no group's pairs become rows.

Documents without words have no set, size 0, and link with nothing; with fewer
words than a shingle the whole sequence is one. Of rows with one id but
different sets, only one set takes part: that with the least key of those the
id is the least document of. Null ids take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..store import numbered, settled
from . import bits
from .components import components
from .neardup import forest
from .words import chunks, mix, sequence_hashes, text_buffers, word_hashes

WORDS, PERCENT = 3, 90
# Rounds of comparing with one other set each.
ROUNDS = 2
# A token held by more sets is frequent; sets with more frequent tokens than the second index each alone.
FREQUENT, MOST_COMBINED = 32, 8
# Sets of a block, and tokens multiplied at once.
BLOCK_SETS, _COLUMNS = 128, 1 << 14
# Bits of the hash that stand for a token in the index; sets are compared with all 64.
_TOKEN_MASK = np.uint64((1 << 47) - 1)
_FILTER_BITS = 1 << 25


def unshared(size: int, percent: int) -> int:
    """Tokens of a set of this size that a similar set can lack."""
    return size - -(-size * percent // 100)


def prefix_sizes(size: int, percent: int) -> tuple[int, int]:
    """Lengths of the extended prefix and of the part of it to index singly."""
    def more(n: int) -> int:
        return max(1, unshared(n, percent))

    lack = unshared(size, percent)
    least = more(-(-size * percent // 100))
    return min(lack + more(size), size), lack + more(size) - least + 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    hashes, rows = word_hashes(data, offsets)
    runs = sequence_hashes(hashes, words)
    rows = rows.tolist()
    for a, b in zip(rows, rows[1:]):
        if b - a >= words:
            yield np.unique(runs[a: b - words + 1])
        elif b > a:
            yield mix(sequence_hashes(hashes[a:b], b - a) + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)


def _sets(batch: pa.RecordBatch, words: int) -> Iterator[tuple[int, np.ndarray]]:
    data, offsets = text_buffers(batch.column(1))
    for low, high in chunks(offsets):
        found = shingle_sets(data[offsets[low]: offsets[high]], offsets[low: high + 1] - offsets[low], words)
        yield from enumerate(found, low)


def signatures(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``id, n_shingles, key, prefix``: size and digest of each set, and its extended prefix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, prefixes = [], [], []
            for _, tokens in _sets(batch, words):
                sizes.append(len(tokens))
                keys.append(xxhash.xxh3_128_digest(tokens.tobytes()) if len(tokens) else None)
                length = prefix_sizes(len(tokens), percent)[0] if len(tokens) else 0
                prefixes.append((tokens[:length] >> np.uint64(17) & _TOKEN_MASK).astype(np.int64))
            if sizes:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(prefixes, pa.list_(pa.int64()))],
                    names=["id", "n_shingles", "key", "prefix"])

    return docs.mapInArrow(run, T.StructType([
        docs.schema["id"], T.StructField("n_shingles", T.LongType()), T.StructField("key", T.BinaryType()),
        T.StructField("prefix", T.ArrayType(T.LongType()))]))


def indexed_tokens(classes: DataFrame, percent: int) -> DataFrame:
    """``id, n, tokens``: of each set the tokens to index, as ``(sets, token)`` from rare to frequent, and one more.

    Tokens that no other set holds only fill places. Sets all of whose places
    they fill can have no similar set and are dropped.
    """
    tokens = classes.select("id", "n", F.explode("prefix").alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("sets")).where("sets > 1")
    held = tokens.join(shared, "token").groupBy("id", "n").agg(
        F.array_sort(F.collect_list(F.struct("sets", "token"))).alias("tokens"))
    lack = F.col("n") - F.ceil(F.col("n") * percent / 100)
    partner = F.ceil(F.col("n") * percent / 100)
    least = F.greatest(F.lit(1), partner - F.ceil(partner * percent / 100))
    length = F.least(lack + F.greatest(F.lit(1), lack), F.col("n"))
    alone = length - F.size("tokens")
    places = F.least(lack + F.greatest(F.lit(1), lack) - least + 1, length)
    held = held.withColumn("single", (places - alone).cast("int")).where("single > 0")
    return held.select("id", "n", "single", (least > 1).alias("pairable"), F.slice("tokens", 1, F.col("single") + 1).alias("tokens"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose sets are similar enough."""
    sized = pairs.join(sets.select(F.col("id").alias("a"), F.col("tokens").alias("ta")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("tokens").alias("tb")), "b").select("a", "b", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for i, (one, two) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (one, two))
                both = np.concatenate([x, y])
                both.sort()
                same = int((both[1:] == both[:-1]).sum())
                if 100 * same >= percent * (len(both) - same):
                    kept.append(i)
            if kept:
                yield pa.RecordBatch.from_arrays([batch.column(k).take(pa.array(kept)) for k in (0, 1)], names=["a", "b"])

    return sized.mapInArrow(run, T.StructType([sized.schema["a"], sized.schema["b"]]))


def _id_filter(wanted: DataFrame) -> np.ndarray:
    """A filter of the ids: tasks set the bits, the driver gets the merged slices only."""
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = np.zeros(_FILTER_BITS // 8, np.uint8)
        for batch in batches:
            places = batch.column(0).to_numpy()
            np.bitwise_or.at(state, places >> 3, (1 << (places & 7)).astype(np.uint8))
        yield from bits.slices(TaskContext.get().partitionId(), state)

    placed = wanted.select(F.pmod(F.xxhash64("id"), F.lit(_FILTER_BITS)).cast("long").alias("at"))
    tasks = placed.rdd.getNumPartitions()
    return bits.collected(bits.merged(placed.mapInArrow(gather, bits.SCHEMA), tasks, np.bitwise_or), _FILTER_BITS // 8)


def _chosen_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``id, key, tokens`` of the documents in ``wanted`` and a few more: a Bloom filter of fixed size spares the others a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(_id_filter(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column(2).to_numpy()
            maybe = np.flatnonzero(shared.value[places >> 3] >> (places & 7).astype(np.uint8) & 1)
            few = pa.RecordBatch.from_arrays([batch.column(k).take(pa.array(maybe)) for k in (0, 1)], names=["id", "text"])
            packed = [tokens.tobytes() for _, tokens in _sets(few, words)]
            keys = [xxhash.xxh3_128_digest(p) for p in packed]
            yield pa.RecordBatch.from_arrays(
                [few.column(0), pa.array(keys, pa.binary()), pa.array(packed, pa.binary())], names=["id", "key", "tokens"])

    placed = docs.withColumn("at", F.pmod(F.xxhash64("id"), F.lit(_FILTER_BITS)).cast("long"))
    return placed.mapInArrow(run, T.StructType([
        docs.schema["id"], T.StructField("key", T.BinaryType()), T.StructField("tokens", T.BinaryType())]))


def _with_component(members: DataFrame, links: DataFrame | None) -> DataFrame:
    """Members with the component of their document so far."""
    if links is None:
        return members.withColumn("component", F.col("id"))
    known = components(links).select(F.col("node").alias("id"), "component")
    return members.join(known, "id", "left").withColumn("component", F.coalesce("component", "id"))


def _open(members: DataFrame) -> DataFrame:
    """Members of tokens whose sets are not all in one component."""
    apart = members.groupBy("token").agg(F.min("component").alias("_low"), F.max("component").alias("_high"))
    return members.join(apart.where("_low <> _high").select("token"), "token")


def _one_each(members: DataFrame, draw: int) -> DataFrame:
    """For each document the one of another component that most of its tokens lead to."""
    leader = F.min(F.struct(F.xxhash64("id", F.lit(draw)).alias("draw"), F.col("id").alias("id"), F.col("component").alias("component")))
    leaders = members.groupBy("token").agg(leader.alias("leader"))
    met = members.join(leaders, "token").where(F.col("component") != F.col("leader.component"))
    votes = met.groupBy("id", F.col("leader.id").alias("other")).agg(F.count("*").alias("votes"))
    best = votes.groupBy("id").agg(F.max(F.struct(F.col("votes"), F.col("other"))).alias("best"))
    return best.select(F.greatest("id", "best.other").alias("a"), F.least("id", "best.other").alias("b")).distinct()


def _units(members: DataFrame) -> DataFrame:
    """What open sets meet in: rare tokens, combinations of two frequent ones, and frequent ones that cannot be combined."""
    sizes = members.groupBy("token").agg(F.count("*").alias("held"))
    classed = members.join(sizes, "token").withColumn("frequent", F.col("held") > FREQUENT)
    per_set = classed.where("frequent").groupBy("id").agg(F.count("*").alias("number"))
    classed = settled(classed.join(per_set, "id", "left"))
    # A frequent token is combined only if every set that holds it has few of them and shares two tokens with similar ones.
    combined = classed.where("frequent").groupBy("token").agg(F.max("number").alias("most"), F.min("pairable").alias("pairable")).where(
        (F.col("most") <= MOST_COMBINED) & F.col("pairable")).select("token", F.lit(True).alias("combined"))
    classed = classed.join(combined, "token", "left")
    alone = classed.where(F.col("combined").isNull()).select("token", "id", "n", "component")
    together = classed.where(F.col("combined")).groupBy("id", "n", "component").agg(F.array_sort(F.collect_set("token")).alias("tokens"))
    combos = F.flatten(F.transform("tokens", lambda x, i: F.transform(
        F.slice("tokens", i + 2, F.size("tokens")), lambda y: F.xxhash64(x, y))))
    together = together.select(F.explode(combos).alias("token"), "id", "n", "component")
    units = _open(alone.unionByName(together))
    return units.join(units.groupBy("token").agg(F.count("*").alias("held")), "token")


def _pairs(units: DataFrame, percent: int) -> DataFrame:
    """All pairs of different components that meet in a unit of few sets."""
    few = units.where(F.col("held") <= FREQUENT)
    other = few.select("token", *[F.col(c).alias(f"{c}_b") for c in ("id", "n", "component")])
    met = few.join(other, "token").where(
        (F.col("id") > F.col("id_b")) & (F.col("component") != F.col("component_b"))
        & (F.least("n", "n_b") * 100 >= F.greatest("n", "n_b") * percent))
    return met.select(F.col("id").alias("a"), F.col("id_b").alias("b")).distinct()


def _block_links(units: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of sets that meet in a unit of many: sets are cut into blocks, and blocks with a common unit are compared whole.

    Sets that lead to the same least document stand side by side, so a group
    of near copies fills few blocks; a block pair gives a forest of its links.
    """
    many = units.where(F.col("held") > FREQUENT).select("token", "id", "component")
    least = many.groupBy("token").agg(F.min("id").alias("least"))
    placed = many.join(least, "token").groupBy("id", "component").agg(F.min("least").alias("least"))
    placed = numbered(placed, [F.col("least"), F.col("id")], "place").select(
        "id", "component", F.expr(f"place div {BLOCK_SETS}").alias("block"))
    held = many.join(placed.select("id", "block"), "id").select("token", "block").distinct()
    pairs = held.join(held.withColumnRenamed("block", "other"), "token").where("block <= other").select("block", "other").distinct()
    packed = placed.join(sets, "id").groupBy("block").agg(F.collect_list(F.struct("id", "component", "tokens")).alias("sets"))
    both = pairs.join(packed, "block").withColumnRenamed("sets", "one").join(
        packed.select(F.col("block").alias("other"), F.col("sets").alias("two")), "other").select("one", "two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one, two = (batch.column(k).slice(i, 1).flatten() for k in (0, 1))
                (ids, parts, rows), (others, other_parts, other_rows) = (
                    (x.field("id").to_pylist(), np.array(x.field("component").to_pylist()),
                     [np.frombuffer(t.as_buffer(), np.uint64) for t in x.field("tokens")]) for x in (one, two))
                a, b = np.nonzero(block_similar(rows, other_rows, percent) & (parts[:, None] != other_parts[None, :]))
                links = _forest_ids(a, b, ids, others)
                if links:
                    yield pa.RecordBatch.from_arrays([pa.array(c, one.field("id").type) for c in zip(*links)], names=["a", "b"])

    kind = sets.schema["id"].dataType
    return both.mapInArrow(run, T.StructType([T.StructField("a", kind), T.StructField("b", kind)]))


def _forest_ids(a: np.ndarray, b: np.ndarray, ids: list, others: list) -> list[tuple]:
    """Enough of the links to join what they join; a set in both blocks is one."""
    names = {name: k for k, name in enumerate(dict.fromkeys([*ids, *others]))}
    back = list(names)
    own, other = np.array([names[x] for x in ids], np.int64), np.array([names[x] for x in others], np.int64)
    return [(back[x], back[y]) for x, y in forest(own[a], other[b])]


def block_similar(one: list[np.ndarray], two: list[np.ndarray], percent: int) -> np.ndarray:
    """Which sets of two blocks are similar enough, by products of 0/1 matrices over the tokens of both."""
    sizes, other_sizes = (np.array([len(r) for r in rows], np.int64) for rows in (one, two))
    shared = np.intersect1d(np.unique(np.concatenate(one)), np.unique(np.concatenate(two)), assume_unique=True)
    same = np.zeros((len(one), len(two)), np.float64)
    cells = []
    for rows in (one, two):
        owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        values = np.concatenate(rows)
        at = np.minimum(np.searchsorted(shared, values), max(len(shared) - 1, 0))
        on = shared[at] == values if len(shared) else np.zeros(len(values), bool)
        cells.append((owner[on], at[on]))
    for low in range(0, len(shared), _COLUMNS):
        grids = []
        for rows, (owner, at) in zip((one, two), cells):
            grid = np.zeros((len(rows), min(_COLUMNS, len(shared) - low)), np.float32)
            inside = (at >= low) & (at < low + _COLUMNS)
            grid[owner[inside], at[inside] - low] = 1
            grids.append(grid)
        same += grids[0] @ grids[1].T
    return 100 * same >= percent * (sizes[:, None] + other_sizes[None, :] - same)


def similar_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT,
) -> DataFrame:
    """The id column, ``n_shingles`` and ``component_id`` (least id reachable by links) of each document."""
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    signed = settled(signatures(narrow, words, percent))
    able = signed.where("n_shingles > 0 AND id IS NOT NULL")
    keyed = able.groupBy("key").agg(F.min("id").alias("rep"))
    twice = keyed.groupBy("rep").agg(F.count("*").alias("sets"), F.min("key").alias("first")).where("sets > 1")
    beside = keyed.join(twice, "rep").where("key <> first").select("key")
    classes = able.groupBy("key").agg(F.min("id").alias("id"), F.first("n_shingles").alias("n"), F.first("prefix").alias("prefix"))
    classes = settled(classes.join(beside, "key", "left_anti"))
    held = settled(indexed_tokens(classes, percent))
    members = settled(held.select("id", "n", "single", "pairable", F.posexplode("tokens").alias("at", "token")).select(
        "id", "n", "pairable", F.col("token.token").alias("token"), (F.col("at") < F.col("single")).alias("own")))
    sets = _chosen_sets(narrow, held, words).join(classes.select("id", "key"), ["id", "key"], "left_semi")
    sets = settled(sets.dropDuplicates(["id"]).select("id", "tokens"))
    singles, links = members.where("own"), None
    for draw in range(ROUNDS):
        found = settled(_verified(_one_each(_open(_with_component(singles, links)), draw), sets, percent))
        links = found if links is None else links.unionByName(found)
    known = settled(_with_component(members, links))
    still = known.join(_open(known.where("own")).select("id").distinct(), "id")
    units = settled(_units(_open(still)))
    found = settled(_verified(_pairs(units, percent), sets, percent))
    blocked = settled(_block_links(units, sets, percent))
    joined = components(links.unionByName(found).unionByName(blocked)).select(F.col("node").alias("rep"), "component")
    reps = keyed.join(joined, "rep", "left").select("key", F.coalesce("component", "rep").alias("component_id"))
    return (signed.join(reps, "key", "left")
            .select(F.col("id").alias(id_col), "n_shingles", F.coalesce("component_id", "id").alias("component_id")))
