"""N-gram Jaccard join with set-relation skipping.

A document's set holds the fingerprints of its distinct word shingles, in one order for all documents (by
value). Two sets link if their Jaccard similarity reaches a threshold (nine tenths, if none is given), so they differ
in few elements.

* **Index lists by position.** The order is cut into position blocks, one more than the number of elements in
  which linked sets of a size class may differ. A list is addressed by size class, block and the digest of the
  block's elements. Linked sets agree in a whole block, so all lists of other positions or other contents are
  skipped before they are read.
* **Answers from a similar set's answers.** Each list has one lead set. The difference of two members follows from
  their differences from the lead (``x ^ y = dx ^ dy`` with ``dx = x ^ lead``), so their sets are not read again.
  Members outside the largest component of a lead's members are open. Where they are many, some are picked as further
  leads, each compared with all members, which joins most of what can be joined; those still open are counted against
  the other members, block by block.
* **Sketches before sets.** A sketch holds the parities of a set's elements by bucket, two to four bits an element. Two
  sets differ in at least as many elements as their sketches in bits, so most pairs are known to be apart before any
  element is sent; sets are only cut for the pairs that are left.

Equal sets are one node. A picked lead writes a row a member at most, and two blocks a spanning forest of their
components, so a group of m copies costs about m rows; no link between different sets is lost, as every pair in a common
list is linked, already connected, or counted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from math import gcd

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .arrays import PLAIN, Words, chunks, mix, window_hashes
from .components import components
from .shared import Stages

SHINGLE = 3
#: Linked: 100 * intersection >= PERCENT * union.
PERCENT = 90
#: Ratio of the bounds of a size class, where the largest ratio of the sizes of linked sets is not above it.
_CLASS_RATIO = 1.25
#: Members in a block of the difference products, and how often an open member is picked as a further lead before them.
MEMBERS, TURNS = 512, 2
#: Bits of the table that holds back texts nobody asks for.
KEY_BITS = 24


def _per_difference(percent: int) -> tuple[int, int]:
    """``(p, q)``: with s the sum of the sizes, sets are linked if ``p * |x ^ y| <= q * s``."""
    shared = gcd(100 + percent, 100 - percent)
    return (100 + percent) // shared, (100 - percent) // shared


@lru_cache
def _bounds(largest: int, percent: int) -> np.ndarray:
    bounds = [(percent - 1) // (100 - percent)]
    while bounds[-1] < largest:
        bounds.append(max(int(bounds[-1] * _CLASS_RATIO), bounds[-1] * 100 // percent + 1))
    return np.array(bounds)


def size_classes(largest: int, percent: int = PERCENT) -> np.ndarray:
    """Upper bounds of the size classes up to ``largest``; the same for every table.

    Sets of the first class link only if they are equal.
    """
    return _bounds(1 << largest.bit_length(), percent)


def position_blocks(bound: int, percent: int = PERCENT) -> tuple[int, int]:
    """Position blocks of the class up to ``bound``, and how many of them are spare.

    The others are one more than the differences of linked sets. There are the more spare ones the fewer elements a
    block has, that is the lower the threshold.
    """
    needed = bound * (100 - percent) // percent + 1
    spare = 2 + needed * max(0, 9 * (100 - percent) - percent) // (2 * percent)
    return needed + spare, spare


def list_keys(elements: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Keys of the index lists of one set (sorted distinct unsigned fingerprints).

    Blocks with few elements are equal by chance, so as many as are spare are left out: all that are smaller than the
    smallest size that must stay. Linked sets agree in one more block than are spare, so also in one that is left
    out by neither: the set with the larger smallest size leaves out no more than the spare ones, and the other none
    of the rest. Sets of the first class are in no list.
    """
    n = len(elements)
    bounds = size_classes(n + 1, percent)
    own = int(np.searchsorted(bounds, n))
    keys = []
    for group in (own - 1, own):
        # the lists of a group hold its class, and of the next class the sets that can link with one in it
        if group < 0 or own == 0 or group < own and percent * n > 100 * bounds[group]:
            continue
        blocks, spare = position_blocks(int(bounds[group]), percent)
        place = (elements >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)
        edges = np.searchsorted(place, np.arange(blocks + 1, dtype=np.uint64))
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(elements), dtype=np.uint64)))
        digest = total[edges[1:]] - total[edges[:-1]]
        address = np.uint64(group) << np.uint64(40) | np.arange(blocks, dtype=np.uint64)
        key = mix(digest + mix(address + np.uint64(1)))
        sizes = np.diff(edges)
        keys.append(key[sizes >= np.partition(sizes, spare)[spare]])
    return np.concatenate(keys) if keys else np.zeros(0, np.uint64)


def shingle_sets(texts: pa.Array, n: int = SHINGLE) -> list[np.ndarray]:
    """The set of each text: sorted distinct fingerprints of its ``n``-word shingles, ASCII letters lower-cased."""
    words = Words(texts, PLAIN, lower=True)
    named, out = words.hashes(), []
    for first, stop in zip(words.bounds[:-1], words.bounds[1:]):
        if stop == first:
            out.append(np.zeros(0, np.uint64))
            continue
        size = min(n, int(stop - first))
        own = named[first:stop]
        out.append(np.unique(window_hashes(own, np.arange(len(own) - size + 1), size)))
    return out


def set_id(elements: np.ndarray) -> int:
    """A 64-bit name of a set; equal sets have equal names."""
    low = int(np.bitwise_xor.reduce(mix(elements))) ^ len(elements) * 0x9E3779B97F4A7C15
    both = mix(np.array([(low + 3 * int(np.sum(mix(elements ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64))) & 0xFFFFFFFFFFFFFFFF], np.uint64))
    return int(both.view(np.int64)[0])


def sketch(elements: np.ndarray) -> np.ndarray:
    """The parities of a set by bucket, as bytes; as many buckets as the power of two from twice its size on, 64 at least."""
    buckets = max(64, 1 << (2 * len(elements) - 1).bit_length())
    at = (mix(elements) & np.uint64(buckets - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=buckets).astype(np.uint8) & 1)


def folded(parities: np.ndarray, size: int) -> np.ndarray:
    """Sketches, one a row or a single one, of ``size`` bytes and no more: half as many buckets are the sum of both halves."""
    while parities.shape[-1] > size:
        half = parities.shape[-1] // 2
        parities = parities[..., :half] ^ parities[..., half:]
    return parities


def least_apart(x: np.ndarray, y: np.ndarray) -> int:
    """In so many elements at least two sets differ, by their sketches."""
    size = min(len(x), len(y))
    return int(np.bitwise_count(folded(x, size) ^ folded(y, size)).sum())


def text_key() -> Column:
    """A name of the text that is never null: with it a row is told from others of the same or no ``doc_id``."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def first_owner() -> Column:
    """The smallest ``doc_id`` with its text's ``key``; a null id only where there is no other."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key"))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", text_key().alias("key"), F.col("text").cast("string").alias("text"))


def with_owners(docs: DataFrame, owners: DataFrame, how: str) -> DataFrame:
    """Join rows with ``doc_id, key`` to owners; a null id is equal to a null id."""
    named = owners.withColumnsRenamed({"doc_id": "_owner_id", "key": "_owner_key"})
    return docs.join(named, F.col("doc_id").eqNullSafe(F.col("_owner_id")) & (F.col("key") == F.col("_owner_key")), how)


def _sets_of(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``doc_id, key, n_shingles, set_id, sketch binary, lists array<long>``; an empty set has a null name and no lists.

    Sets without lists have no sketch.
    """

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                sets = shingle_sets(part.column("text"), shingle)
                seen: set[int] = set()
                names, lists = [], []
                for s in sets:
                    own = set_id(s) if len(s) else None
                    names.append(own)
                    lists.append(list_keys(s, percent).view(np.int64) if own is not None and own not in seen else np.zeros(0, np.int64))
                    seen.add(own)
                bounds = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int32)
                sketches = pa.array([sketch(s).tobytes() if len(x) else None for s, x in zip(sets, lists)], pa.binary())
                flat = pa.array(np.concatenate(lists), pa.int64())
                yield pa.record_batch(
                    [part.column("doc_id"), part.column("key"), pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.int64()), sketches, pa.ListArray.from_arrays(pa.array(bounds), flat)],
                    ["doc_id", "key", "n_shingles", "set_id", "sketch", "lists"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _keyed(docs).mapInArrow(name, f"doc_id {kind}, key long, n_shingles long, set_id long, sketch binary, lists array<long>")


def _maybe_wanted(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Leave out texts whose ``key`` is certainly not wanted before any is sent: by one bit a key in a table of fixed size."""
    bit = f"key & {(1 << KEY_BITS) - 1}"
    words = wanted.selectExpr(f"CAST(shiftright({bit}, 6) AS int) AS word", f"shiftleft(1L, CAST({bit} & 63 AS int)) AS bit")
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()  # at most a word for 64 bits of the table
    table = np.zeros(1 << KEY_BITS - 6, np.uint64)
    table[found.word.to_numpy(np.int64)] = found.bits.to_numpy(np.int64).view(np.uint64)
    shared = texts.sparkSession.sparkContext.broadcast(table)

    @F.arrow_udf("boolean")
    def maybe(keys: pa.Array) -> pa.Array:
        at = keys.to_numpy(zero_copy_only=False).view(np.uint64) & np.uint64((1 << KEY_BITS) - 1)
        return pa.array((shared.value[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool))

    return texts.where(maybe("key"))


def _elements(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """``set_id, elements binary`` of the wanted sets (``set_id, doc_id, key`` of one text each)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                sets = shingle_sets(part.column("text"), shingle)
                same = [bool(len(s)) and set_id(s) == own for s, own in zip(sets, part.column("set_id").to_pylist())]
                out = pa.record_batch([part.column("set_id"), pa.array([s.tobytes() for s in sets], pa.binary())], ["set_id", "elements"])
                yield out.filter(pa.array(same))

    # a row may stand several times, or two texts may have one key; only the named set's text counts
    texts = with_owners(_maybe_wanted(_keyed(docs), wanted), wanted, "inner").select("set_id", "text")
    return texts.mapInArrow(cut, "set_id long, elements binary").dropDuplicates(["set_id"])


def _compare(pairs: DataFrame) -> DataFrame:
    """Add to pairs with both sets the difference from the lead: ``lead, member, n_lead, n_member, diff binary``."""

    def subtract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, at in ((b, i) for b in batches for i in range(0, b.num_rows, MEMBERS)):
            batch = whole.slice(at, MEMBERS)
            leads, members = (batch.column(c).to_pylist() for c in ("lead_elements", "elements"))
            n_lead, n_member, diff = [], [], []
            for a, b in zip(leads, members):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                n_lead.append(len(a))
                n_member.append(len(b))
                diff.append(np.setxor1d(a, b, assume_unique=True).tobytes())
            yield pa.record_batch(
                [batch.column("lead"), batch.column("member"), pa.array(n_lead, pa.int64()), pa.array(n_member, pa.int64()), pa.array(diff, pa.binary())],
                ["lead", "member", "n_lead", "n_member", "diff"],
            )

    return pairs.mapInArrow(subtract, "lead long, member long, n_lead long, n_member long, diff binary")


def _linked(left: list[np.ndarray], right: list[np.ndarray], n_left: np.ndarray, n_right: np.ndarray, percent: int) -> np.ndarray:
    """Which sets of two sides are linked, from their sizes and their differences (sorted) from one lead."""
    per, each = _per_difference(percent)
    sizes = [np.array([len(d) for d in side]) for side in (left, right)]
    flats = [np.concatenate(side) for side in (left, right)]
    owners = [np.repeat(np.arange(len(n)), n) for n in sizes]
    columns = np.intersect1d(*flats)
    shared = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, len(columns), 4096):
        own = columns[at : at + 4096]
        parts = []
        for side, flat, owner in zip((left, right), flats, owners):
            place = np.minimum(np.searchsorted(own, flat), len(own) - 1)
            hit = own[place] == flat
            dense = np.zeros((len(side), len(own)), np.float32)
            dense[owner[hit], place[hit]] = 1
            parts.append(dense)
        shared += parts[0] @ parts[1].T
    apart = sizes[0][:, None] + sizes[1][None, :] - 2 * shared.astype(np.int64)
    return per * apart <= each * (n_left[:, None] + n_right[None, :])


def _block_links(percent: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Links between open members and members of two blocks: a spanning forest of their components, no more."""

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        left, right = rows[rows.open_side], rows[~rows.open_side]
        found: list[tuple[int, int]] = []
        if len(left) and len(right):
            sides = [[np.frombuffer(d, np.uint64) for d in side["diff"]] for side in (left, right)]
            both = _linked(*sides, left.n_member.to_numpy(), right.n_member.to_numpy(), percent)
            own = [side.component.to_numpy() for side in (left, right)]
            i, j = np.nonzero(both & (own[0][:, None] != own[1][None, :]))
            root: dict[int, int] = {}

            def find(x: int) -> int:
                while root.get(x, x) != x:
                    root[x] = x = root.get(root[x], root[x])
                return x

            for a, b in zip(own[0][i].tolist(), own[1][j].tolist()):
                if find(a) != find(b):
                    root[find(a)] = find(b)
                    found.append((a, b))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return links


def _maybe_linked(pairs: DataFrame, percent: int) -> DataFrame:
    """``lead, member`` of the pairs (``lead, member, n_lead, n_member, lead_sketch, sketch``) that their sketches leave open."""
    per, each = _per_difference(percent)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, MEMBERS) for b in batches for i in range(0, b.num_rows, MEMBERS)):
            sides = ([np.frombuffer(x, np.uint8) for x in batch.column(c).to_pylist()] for c in ("lead_sketch", "sketch"))
            apart = np.array([least_apart(x, y) for x, y in zip(*sides)], np.int64)
            total = batch.column("n_lead").to_numpy() + batch.column("n_member").to_numpy()
            yield batch.select(["lead", "member"]).filter(pa.array(per * apart <= each * total))

    return pairs.select("lead", "member", "n_lead", "n_member", "lead_sketch", "sketch").mapInArrow(near, "lead long, member long")


def _maybe_in_blocks(percent: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """``lead, member`` of the members in two blocks that may be linked with one of another component, by their sketches."""
    per, each = _per_difference(percent)

    def found(rows: pd.DataFrame) -> pd.DataFrame:
        size = min(map(len, rows["sketch"]))
        parities = np.stack([folded(np.frombuffer(x, np.uint8), size) for x in rows["sketch"]]).view(np.uint64)
        component, n = rows["component"].to_numpy(), rows["n_member"].to_numpy()
        own, others = (np.flatnonzero(rows["open_side"] == side) for side in (True, False))
        hit = np.zeros(len(rows), bool)
        for at in own:
            apart = np.bitwise_count(parities[others] ^ parities[at]).sum(axis=1, dtype=np.int64)
            near = others[(per * apart <= each * (n[others] + n[at])) & (component[others] != component[at])]
            hit[near] = True
            hit[at] = len(near) > 0
        return rows.loc[hit, ["lead", "member"]]

    return found


def _placed(members: DataFrame, parts: DataFrame, column: str) -> DataFrame:
    """Members (``lead, member, n_member`` and ``column``) with their components, of the leads whose members are in several.

    ``open``: not in the largest one. Components only grow, so rows that were placed before can be placed anew.
    """
    own = parts.select(F.col("node").alias("member"), "component")
    rows = members.select("lead", "member", "n_member", column).join(own, "member", "left").withColumn("component", F.coalesce("component", "member"))
    shares = rows.groupBy("lead", "component").agg(F.count(F.lit(1)).alias("n"))
    main = shares.groupBy("lead").agg(F.max(F.struct("n", "component")).alias("main"), F.sum("n").alias("n"))
    main = main.select("lead", "n", F.col("main.component").alias("main"), (F.col("n") - F.col("main.n")).alias("n_open")).where("n_open > 0")
    return rows.join(main, "lead").withColumn("open", F.col("component") != F.col("main")).drop("main")


def _picked(rows: DataFrame, turn: int) -> DataFrame:
    """Pairs of a member that is picked for each lead from the open ones with the lead's members of other components."""
    chance = F.struct(F.xxhash64("member", F.lit(turn)), "member")
    picked = rows.where("open").groupBy("lead").agg(F.min(chance).getField("member").alias("member")).join(rows, ["lead", "member"])
    picked = picked.select(
        F.col("lead").alias("of"), F.col("member").alias("lead"), F.col("n_member").alias("n_lead"), F.col("sketch").alias("lead_sketch"), F.col("component").alias("lead_part")
    )
    pairs = rows.withColumnRenamed("lead", "of").join(picked, "of").where("component <> lead_part")
    return pairs.select("lead", "member", "n_lead", "n_member", "lead_sketch", "sketch")


def _block_pairs(rows: DataFrame, column: str) -> DataFrame:
    """Every open member with every member of its lead, in pairs of blocks: ``lead, open_block, member_block``.

    Open members and all members of a lead are dealt into blocks, so a task holds two blocks at a time; members are
    copied once for each block of open ones.
    """
    rows = rows.withColumn("open_blocks", F.ceil(F.col("n_open") / MEMBERS)).withColumn("blocks", F.ceil(F.col("n") / MEMBERS))
    own = lambda name: F.pmod(F.xxhash64("member"), F.col(name))
    every = lambda name: F.explode(F.sequence(F.lit(0).cast("long"), F.col(name) - 1))
    columns = ["lead", "member", "n_member", column, "component"]
    right = rows.select(*columns, every("open_blocks").alias("open_block"), own("blocks").alias("member_block"), F.lit(False).alias("open_side"))
    left = rows.where("open").select(*columns, own("open_blocks").alias("open_block"), every("blocks").alias("member_block"), F.lit(True).alias("open_side"))
    # rows are dealt by lead here; deal them by block pair, or all blocks of a large lead would meet in one task
    return left.union(right).repartition("lead", "open_block", "member_block")


def _maybe_members(rows: DataFrame, percent: int) -> DataFrame:
    """``lead, member``: members that by their sketches may be linked with one of another component of the same lead."""
    blocks = _block_pairs(rows, "sketch").groupBy("lead", "open_block", "member_block")
    return blocks.applyInPandas(_maybe_in_blocks(percent), "lead long, member long").distinct()


def _member_links(rows: DataFrame, percent: int) -> DataFrame:
    """``a, b``: components linked by two members of one lead, counted on their differences from it."""
    blocks = _block_pairs(rows, "diff").groupBy("lead", "open_block", "member_block")
    return blocks.applyInPandas(_block_links(percent), "a long, b long").distinct()


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leads and members of the lists in one range of sorted ``list, set_id``: ``list, lead, member``.

    The lead is the first set of a list in the range. ``list`` is given where the list may go beyond the range: for all
    rows of the first list, and for the lead of the last one, which also stand as members of themselves.
    """
    first = held = lead = last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        lists, sets = (batch.column(c).to_numpy() for c in ("list", "set_id"))
        begins = np.concatenate(([held != lists[0]], lists[1:] != lists[:-1]))
        again = np.concatenate(([held == lists[0] and last == sets[0]], ~begins[1:] & (sets[1:] == sets[:-1])))
        at = np.maximum.accumulate(np.where(begins, np.arange(len(lists)), -1))
        leads = np.where(at >= 0, sets[at], sets[0] if lead is None else lead)
        first = lists[0] if first is None else first
        held, lead, last = lists[-1], leads[-1], sets[-1]
        outer = (lists == first) & ~again
        inner = (lists != first) & ~begins & ~again
        pairs = np.unique(np.column_stack((leads[inner], sets[inner])), axis=0)
        columns = [np.concatenate((pairs[:, 0], leads[outer])), np.concatenate((pairs[:, 1], sets[outer]))]
        names = pa.array(np.concatenate((np.zeros(len(pairs), np.int64), lists[outer])), mask=np.arange(len(columns[0])) < len(pairs))
        yield pa.record_batch([names, *map(pa.array, columns)], ["list", "lead", "member"])
    if held is not None and held != first:
        yield pa.record_batch([pa.array([x], pa.int64()) for x in (held, lead, lead)], ["list", "lead", "member"])


def _lead_pairs(sets: DataFrame, stages: Stages) -> DataFrame:
    """``lead, member``: the lead of each index list, its smallest set name, with each other set of the list.

    Drops the stage ``listed``, which ``sets`` is read from.

    One exchange by ranges of (list, set): a list with very many sets goes over several ranges, and what one task gets
    does not depend on how often a list is used. The leads of lists at the ends of ranges, two a range, are put right afterwards.
    """
    entries = sets.select(F.explode("lists").alias("list"), "set_id")
    runs = entries.repartitionByRange("list", "set_id").sortWithinPartitions("list", "set_id").mapInArrow(_runs, "list long, lead long, member long")
    runs = stages.keep(runs, "runs")
    stages.drop("listed")
    stages.release()
    ends = runs.where("list IS NOT NULL AND lead = member").groupBy("list").agg(F.min("lead").alias("true_lead"))
    outer = runs.where("list IS NOT NULL").join(F.broadcast(ends), "list").select(F.col("true_lead").alias("lead"), "member")
    pairs = stages.keep(runs.where("list IS NULL").select("lead", "member").union(outer).where("lead <> member").distinct(), "pairs")
    stages.drop("runs")
    return pairs


def near_sets(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """The sets of the documents and the classes of linked sets.

    Sets: a row per document, ``doc_id, key, n_shingles, set_id``. Classes: a row per set that is not empty, ``set_id,
    component`` and in ``owner`` the ``doc_id`` and ``key`` of its first document.
    """
    if not 50 <= percent <= 99:
        raise ValueError(f"percent is {percent}, not 50 to 99")
    docs = docs.select("doc_id", "text")
    stages = Stages(docs.sparkSession)
    listed = stages.keep(_sets_of(docs, shingle, percent), "listed")
    sets = stages.keep(listed.drop("lists"), "sets")
    named = sets.where(F.col("set_id").isNotNull()).groupBy("set_id").agg(first_owner().alias("owner"))
    pairs = _lead_pairs(listed, stages)
    stages.release()
    ends = lambda some: some.select(F.col("lead").alias("set_id")).union(some.select(F.col("member").alias("set_id"))).distinct()
    known = sets.where("sketch IS NOT NULL").select("set_id", F.col("n_shingles").alias("n"), "sketch")
    known = stages.keep(known.join(ends(pairs), "set_id", "left_semi").dropDuplicates(["set_id"]), "sketches")
    member = known.select(F.col("set_id").alias("member"), F.col("n").alias("n_member"), "sketch")
    lead = known.select(F.col("set_id").alias("lead"), F.col("n").alias("n_lead"), F.col("sketch").alias("lead_sketch"))
    maybe = stages.keep(_maybe_linked(pairs.join(member, "member").join(lead, "lead"), percent), "maybe")
    stages.release()
    per, each = _per_difference(percent)

    def elements(some: DataFrame, name: str) -> DataFrame:
        """The sets of pairs."""
        cut = stages.keep(_elements(docs, named.join(ends(some), "set_id").select("set_id", "owner.doc_id", "owner.key"), shingle), name)
        stages.release()
        return cut

    def compare(some: DataFrame, cut: DataFrame) -> DataFrame:
        """The differences of pairs."""
        of_lead = cut.select(F.col("set_id").alias("lead"), F.col("elements").alias("lead_elements"))
        return _compare(some.join(cut.withColumnRenamed("set_id", "member"), "member").join(of_lead, "lead"))

    def joined(parts: DataFrame | None, some: DataFrame, cut: DataFrame, name: str) -> DataFrame:
        """The components with the links among some pairs."""
        near = per * F.length("diff") / 8 <= each * (F.col("n_lead") + F.col("n_member"))
        links = stages.keep(compare(some, cut).where(near).select(F.col("lead").alias("a"), F.col("member").alias("b")), f"links-{name}")
        stages.release()
        return grown(parts, links, name)

    def grown(parts: DataFrame | None, links: DataFrame, name: str) -> DataFrame:
        every = links if parts is None else parts.select(F.col("node").alias("a"), F.col("component").alias("b")).union(links)
        return stages.keep(components(every, stages, f"steps-{name}"), f"parts-{name}")

    parts = joined(None, maybe, elements(maybe, "elements"), "leads")
    stages.drop("maybe", "elements")
    rows = stages.keep(_placed(pairs.join(member, "member"), parts, "sketch"), "rows-0")
    stages.drop("pairs", "sketches")
    for turn in range(1, TURNS + 1):
        # a few open members meet the others in one block below
        some = stages.keep(_maybe_linked(_picked(rows.where(F.col("n_open") > MEMBERS), turn), percent).distinct(), f"picked-{turn}")
        if some.isEmpty():
            break
        parts = joined(parts, some, elements(some, f"elements-{turn}"), f"turn-{turn}")
        rows = stages.keep(_placed(rows, parts, "sketch"), f"rows-{turn}")
        stages.drop(f"rows-{turn - 1}", f"picked-{turn}", f"elements-{turn}")
    open_members = stages.keep(_maybe_members(rows, percent), "open")
    stages.release()
    if not open_members.isEmpty():
        compared = stages.keep(compare(open_members, elements(open_members, "elements-open")), "compared")
        stages.release()
        links = stages.keep(_member_links(_placed(compared, parts, "diff"), percent), "links-open")
        parts = grown(parts, links, "open")
    stages.drop("open", "elements-open", "compared", *(f"rows-{turn}" for turn in range(TURNS + 1)))
    owned = named.join(parts.withColumnRenamed("node", "set_id"), "set_id", "left")
    classes = stages.keep(owned.select("set_id", "owner", F.coalesce("component", "set_id").alias("component")), "classes")
    return sets.drop("sketch"), classes


def ngram_jaccard_join(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``.

    Texts link if their sets of ``shingle``-word shingles have a Jaccard similarity of ``percent`` hundredths (50 to 99).
    ``component_id`` is the smallest ``doc_id`` reachable by links, the document itself included. Null and empty
    texts have empty sets and are linked with nothing. A null ``doc_id`` links like others and is never the smallest
    while there is another. Repeated rows give repeated rows; texts with fewer words than a shingle are one shingle;
    extra columns are ignored; an empty table gives no rows.
    """
    sets, classes = near_sets(docs, shingle, percent)
    smallest = classes.groupBy("component").agg(F.min("owner.doc_id").alias("component_id"))
    ids = classes.join(smallest, "component").select("set_id", "component_id")
    return sets.join(ids, "set_id", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
