"""Near-duplicate documents: minhash signatures joined by Hamming distance.

A document is the set of its word shingles. Its signature has 64 positions of 16 bits,
each the lowest hash of the set under another function. Signatures that differ in at
most 25 positions are all found: cut into 13 chunks, two of them differ in at most one
position of some chunk (26 errors are needed for two in each), so every chunk is stored
once for each position that may be wrong, with that position left out, and documents
that share such a key are candidates. Two sets of similarity 0.8 fail to share a key
with probability below 1e-7, and differ in more than 28 positions with one below 1e-5.
Candidates beyond that distance are dropped; all others are confirmed on the full sets.

Documents with equal sets form a class first and are represented by one of them. Within
a bucket of candidates pairs are not spelled out: each member is confirmed against one
pivot, a few times over with other pivots, which connects nearly all that is linked.
What is connected needs no more comparing. The members of a bucket that are still apart
from its main component are then compared with all others in it, in blocks inside the
tasks: signatures first, then what near ones lack and add against the full set that
stands for the main component, which tells exactly whether they are linked. Only links
leave, and no more than join the components of a block. Pairs to be confirmed are dealt
into cells of a checked size, and a set is sent once to each cell that needs it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm import tokens
from tidemill.llm.common import column, stage
from tidemill.llm.components import extend

POSITIONS, CHUNKS = 64, 13
FOUND, CONFIRMED = 2 * CHUNKS - 1, 28  # distances
# Rounds in which every member that is apart is confirmed against one more pivot.
ROUNDS = 3
# Members of a bucket that are compared in one block, and rows that a cell aims at.
BLOCK_ROWS, CELL_ROWS = 1024, 8192
# Shingles of the pairs that a cell aims at when they are confirmed, and parts of hubs.
CELL_SHINGLES, MIN_PARTS = 4_000_000, 8

_rng = np.random.Generator(np.random.PCG64(20240229))
_FACTORS = _rng.integers(1 << 63, size=POSITIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(1 << 63, size=POSITIONS, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, one after the other, and set sizes.

    Words are lower-cased from A to Z. A text of fewer words is one shingle; a text
    without words, or null, has an empty set.
    """
    import xxhash

    words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    ends = words.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    coded = words.flatten().dictionary_encode()
    names = coded.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in names), np.uint64, len(names))
    real = np.fromiter((w != "" for w in names), bool, len(names))
    at = coded.indices.to_numpy(zero_copy_only=False)
    kept = real[at]
    flat = hashes[at[kept]]
    before = np.concatenate([[0], np.cumsum(kept)])[ends - ends[0]]
    sets = []
    for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
        own = flat[a:b]
        k = min(size, b - a)
        if not k:
            sets.append(own)
            continue
        h = np.full(len(own) - k + 1, 1469598103934665603 + k, np.uint64)
        for j in range(k):
            h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + own[j : len(own) - k + 1 + j])
        sets.append(np.unique(h))
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), sizes


def minhashes(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A row of 16-bit positions per non-empty set."""
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    out = np.zeros((len(starts), POSITIONS), np.uint16)
    for i in range(POSITIONS):
        low = np.minimum.reduceat(flat * _FACTORS[i] + _SHIFTS[i], starts)
        out[:, i] = _mix(low) >> np.uint64(48)
    return out


def chunk_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key per position: its chunk with that position left out."""
    out = np.zeros((len(signatures), POSITIONS), np.uint64)
    for chunk in np.array_split(np.arange(POSITIONS), CHUNKS):
        for left_out in chunk:
            key = np.zeros(len(signatures), np.uint64)
            for p in chunk:
                if p != left_out:
                    key = (key << np.uint64(16)) | signatures[:, p]
            salt = np.uint64(0x9E3779B97F4A7C15 * (int(left_out) + 1) % (1 << 64))
            out[:, left_out] = _mix(key + salt)
    return out


def _signed(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, digest and signature (null for an empty set)."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in rows:
            for a, b in tokens.slices(batch.column(2)):
                part = batch.slice(a, b - a)
                flat, sizes = shingle_sets(part.column(2), size)
                cuts = np.cumsum(sizes) - sizes
                digests = [xxhash.xxh3_128_digest(flat[c : c + n]) if n else None for c, n in zip(cuts.tolist(), sizes.tolist(), strict=True)]
                rows_of = iter(minhashes(flat, sizes))
                signatures = [next(rows_of).tobytes() if n else None for n in sizes.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(sizes), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())],
                    ["doc_id", "text_hash", "n_shingles", "digest", "signature"],
                )

    return docs.mapInArrow(run, "doc_id long, text_hash long, n_shingles long, digest binary, signature binary")


def _classes(signed: DataFrame) -> DataFrame:
    """digest, rep, signature, and the id and text_hash of one row, for each distinct set.

    rep stands for the class: its smallest id, or numbers made of the digests where an
    id has several texts that would share it.
    """
    first = F.min(F.struct(F.col("doc_id").alias("id"), F.col("text_hash").alias("id_hash"))).alias("first")
    usable = signed.filter("digest is not null and doc_id is not null")
    classes = usable.groupBy("digest").agg(first, F.min("signature").alias("signature"))
    classes = stage(classes.select("digest", "first.*", "signature"), "classes")
    rep, salt = F.col("id"), 0
    while not classes.groupBy(rep.alias("rep")).count().filter("count > 1").isEmpty():
        salt += 1
        # One bit less, as numbers are negated.
        rep = F.shiftrightunsigned(F.xxhash64("digest", F.lit(salt)), 1)
    return classes.withColumn("rep", rep)


def _matrix(signatures: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(signatures.to_pylist()), np.uint16).reshape(-1, POSITIONS)


def _keyed(classes: DataFrame) -> DataFrame:
    """key, the position that it leaves out, and rep."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            if batch.num_rows:
                keys = chunk_keys(_matrix(batch.column(1))).view(np.int64)
                reps = np.repeat(batch.column(0).to_numpy(), POSITIONS)
                places = np.tile(np.arange(POSITIONS, dtype=np.int32), batch.num_rows)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(places), pa.array(reps)], ["key", "pos", "rep"])

    return classes.select("rep", "signature").mapInArrow(run, "key long, pos int, rep long")


def _close(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs whose signatures are near enough to be worth confirming."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            if batch.num_rows:
                apart = (_matrix(batch.column(2)) != _matrix(batch.column(3))).sum(axis=1)
                near = pa.array(apart <= CONFIRMED)
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(near), batch.column(1).filter(near)], ["a", "b"])

    of = lambda x: classes.select(F.col("rep").alias(f"{x}_rep"), F.col("signature").alias(f"{x}_sig"))
    joined = pairs.join(of("a"), F.col("a") == F.col("a_rep")).join(of("b"), F.col("b") == F.col("b_rep"))
    return joined.select("a", "b", "a_sig", "b_sig").mapInArrow(run, "a long, b long")


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """rep, pairs, n and shingles (sorted hashes) of the classes in `wanted`, each from its own row."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in rows:
            for a, b in tokens.slices(batch.column(3)):
                part = batch.slice(a, b - a)
                flat, sizes = shingle_sets(part.column(3), size)
                ends = np.cumsum(sizes)
                digests = part.column(2).to_pylist()
                own = [flat[e - n : e] for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
                mine = [i for i, s in enumerate(own) if len(s) and xxhash.xxh3_128_digest(s) == digests[i]]
                sets = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(sizes[mine])]), pa.int32()),
                    pa.array(np.concatenate([own[i] for i in mine]).view(np.int64) if mine else np.zeros(0, np.int64)),
                )
                taken = pa.array(mine, pa.int64())
                columns = [part.column(0).take(taken), part.column(1).take(taken), pa.array(sizes[mine]), sets]
                yield pa.RecordBatch.from_arrays(columns, ["rep", "pairs", "n", "shingles"])

    own_row = (F.col("doc_id") == F.col("id")) & (F.col("text_hash") == F.col("id_hash"))
    texts = docs.join(wanted, own_row).select("rep", "pairs", "digest", "text")
    return texts.mapInArrow(run, "rep long, pairs long, n long, shingles array<long>").dropDuplicates(["rep"])


def _celled(near: DataFrame, sets: DataFrame, a_is_hub: bool = False) -> DataFrame:
    """Pairs as hub and other, with the part and the block of the cell where they meet.

    A cell holds the pairs of some hubs with some others, so a set is sent to it once,
    however many pairs it has there. The hub of a pair is the one with more pairs: others
    then have few (at most the root of twice the number of all pairs). A part of hubs gets
    blocks by the shingles of its pairs, so one hub with most of the pairs has many cells.
    With `a_is_hub` the first of a pair is its hub.
    """
    of = lambda x: sets.select(F.col("rep").alias(f"{x}_rep"), F.struct("pairs", "rep").alias(f"{x}_by"), F.col("n").alias(f"{x}_n"))
    sized = near.join(of("a"), F.col("a") == F.col("a_rep")).join(of("b"), F.col("b") == F.col("b_rep"))
    hub, other = (F.col("a"), F.col("b")) if a_is_hub else (F.greatest("a_by", "b_by")["rep"], F.least("a_by", "b_by")["rep"])
    hubs = sized.select(
        hub.alias("hub"),
        other.alias("other"),
        (F.col("a_n") + F.col("b_n")).alias("volume"),
    )
    hubs = stage(hubs, "hubs")
    cells = (hubs.agg(F.sum("volume")).first()[0] or 0) / CELL_SHINGLES
    part = F.pmod(F.xxhash64("hub"), F.lit(max(MIN_PARTS, math.ceil(cells**0.5)))).cast("int")
    blocks = F.ceil(F.sum("volume") / CELL_SHINGLES).cast("int").alias("blocks")
    parts = hubs.groupBy(part.alias("of")).agg(blocks)
    dealt = hubs.withColumn("part", part).join(parts, F.col("part") == F.col("of"))
    return dealt.select("part", F.pmod(F.xxhash64("other"), F.col("blocks")).cast("int").alias("block"), "hub", "other")


def shared_counts(hub: np.ndarray, other: np.ndarray, flat: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Hashes that two sets share, for every pair of places of sorted sets in `flat`."""
    out = np.zeros(len(hub), np.int64)
    order = np.argsort(hub, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(hub[order])) + 1):
        if len(rows):
            own = flat[cuts[hub[rows[0]]] : cuts[hub[rows[0]] + 1]]
            theirs = [flat[cuts[o] : cuts[o + 1]] for o in other[rows].tolist()]
            values = np.concatenate(theirs)
            found = own[np.minimum(np.searchsorted(own, values), len(own) - 1)] == values
            lengths = np.fromiter(map(len, theirs), np.int64, len(theirs))
            out[rows] = np.add.reduceat(found, np.cumsum(lengths) - lengths, dtype=np.int64)
    return out


def _in_cells(
    near: DataFrame,
    docs: DataFrame,
    classes: DataFrame,
    size: int,
    found: Callable[..., pa.Table],
    schema: str,
    a_is_hub: bool = False,
) -> DataFrame:
    """`found` of the pairs of every cell: ids and places of hubs and others, sets and cuts."""
    reps = near.select(F.col("a").alias("of")).unionAll(near.select("b")).groupBy("of").agg(F.count("*").alias("pairs"))
    wanted = reps.join(classes, F.col("of") == F.col("rep")).select("rep", "pairs", "digest", "id", "id_hash")
    sets = stage(_sets(docs, wanted, size), "sets")
    dealt = stage(_celled(near, sets, a_is_hub), "dealt")
    needed = dealt.select("part", "block", F.col("hub").alias("of")).unionAll(dealt.select("part", "block", "other")).distinct()
    sent = needed.join(sets, F.col("of") == F.col("rep"))
    sent = sent.select(F.col("part").alias("s_part"), F.col("block").alias("s_block"), "rep", "shingles")

    def meet(pairs: pa.Table, sets: pa.Table) -> pa.Table:
        hub, other = pairs["hub"].to_numpy(), pairs["other"].to_numpy()
        sets = sets.sort_by("rep")
        rep, lists = sets["rep"].to_numpy(), sets["shingles"].combine_chunks()
        flat, cuts = lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy()
        at = [np.searchsorted(rep, side) for side in (hub, other)]
        return found((hub, other), at, flat, cuts)

    cells = dealt.groupBy("part", "block").cogroup(sent.groupBy("s_part", "s_block"))
    return cells.applyInArrow(meet, schema)


def _confirm(near: DataFrame, docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """Links among pairs: percent of the union's shingles at least are shared."""

    def linked(names: tuple, at: list[np.ndarray], flat: np.ndarray, cuts: np.ndarray) -> pa.Table:
        shared = shared_counts(*at, flat, cuts)
        sizes = np.diff(cuts).astype(np.int64)
        enough = 100 * shared >= percent * (sizes[at[0]] + sizes[at[1]] - shared)
        return pa.table({"a": pa.array(names[0][enough]), "b": pa.array(names[1][enough])})

    return stage(_in_cells(near, docs, classes, size, linked, "a long, b long"), "links")


def _changes(pairs: DataFrame, docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """pivot, rep, changes and excess of pairs of a pivot `a` and another `b`.

    changes are the shingles that only one of the two sets holds, sorted. Let x and y lack
    d and add e shingles of a pivot of n, and t be the changes that they share. They share
    n - d(x) - d(y) + t shingles, so they are linked if
    (100 + percent) * t >= 100 * (d(x) + d(y)) + percent * (e(x) + e(y)) - (100 - percent) * n,
    and excess is twice the part that one of them has in this.
    """

    def run(names: tuple, at: list[np.ndarray], flat: np.ndarray, cuts: np.ndarray) -> pa.Table:
        lists, excess = [], []
        for hub, other in zip(at[0].tolist(), at[1].tolist(), strict=True):
            own, theirs = flat[cuts[hub] : cuts[hub + 1]], flat[cuts[other] : cuts[other + 1]]
            changed = np.setxor1d(own, theirs, assume_unique=True)
            lacked = (len(changed) + len(own) - len(theirs)) // 2
            lists.append(changed.view(np.int64))
            excess.append(200 * lacked + 2 * percent * (len(changed) - lacked) - (100 - percent) * len(own))
        columns = [pa.array(names[0]), pa.array(names[1]), pa.array(lists, pa.list_(pa.int64())), pa.array(excess, pa.int64())]
        return pa.table(columns, names=["pivot", "rep", "changes", "excess"])

    schema = "pivot long, rep long, changes array<long>, excess long"
    return stage(_in_cells(pairs, docs, classes, size, run, schema, a_is_hub=True), "changes")


def _component(of: DataFrame, components: DataFrame | None, name: str, node: Column) -> DataFrame:
    """`of` with the component of a node, itself if it has no links."""
    if components is None:
        return of.withColumn(name, node)
    own = components.select(F.col("node").alias(f"{name}_node"), F.col("component").alias(f"{name}_c"))
    joined = of.join(own, node == F.col(f"{name}_node"), "left")
    return joined.withColumn(name, F.coalesce(f"{name}_c", node)).drop(f"{name}_node", f"{name}_c")


def _open(members: DataFrame, components: DataFrame) -> DataFrame:
    """Members, with their component c, of buckets that are not all connected."""
    colored = stage(_component(members.drop("c"), components, "c", F.col("rep")), "colored")
    spread = colored.groupBy("bucket").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).filter("c0 < c1")
    still = spread.select(F.col("bucket").alias("of"))
    return stage(colored.join(still, F.col("bucket") == F.col("of")).drop("of"), "members")


def _main(members: DataFrame) -> DataFrame:
    """bucket, the component with most members there, and the first of these."""
    sizes = members.groupBy("bucket", "c").agg(F.count("*").alias("k"), F.min("rep").alias("first"))
    most = F.max(F.struct(F.col("k"), (-F.col("c")).alias("c"), F.col("first"))).alias("most")
    picked = sizes.groupBy("bucket").agg(most)
    return picked.select("bucket", (-F.col("most.c")).alias("main"), F.col("most.first").alias("pivot"))


def shared_with(own: np.ndarray, rows: np.ndarray, flat: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """How many values of each of some lists in `flat` a sorted list holds."""
    lengths = cuts[rows + 1] - cuts[rows]
    if not len(own) or not lengths.sum():
        return np.zeros(len(rows), np.int64)
    of = np.repeat(np.arange(len(rows)), lengths)
    values = flat[np.arange(len(of)) - np.repeat(np.cumsum(lengths) - lengths - cuts[rows], lengths)]
    held = own[np.minimum(np.searchsorted(own, values), len(own) - 1)] == values
    return np.bincount(of[held], minlength=len(rows))


def spanning(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of links that join all that these links connect, each joining something new."""
    up: dict[int, int] = {}

    def find(x: int) -> int:
        while (over := up.get(x, x)) != x:
            up[x] = up.get(over, over)
            x = over
        return x

    places = []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        x, y = find(x), find(y)
        if x != y:
            up[x] = y
            places.append(i)
    return np.array(places, np.int64)


def _apart(members: DataFrame, docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """Links between different components that share a bucket, as many as join them.

    Members outside the main component of their bucket meet all members of the bucket.
    A pair is looked at only in the bucket of the first key that it shares. The pivot of a
    bucket is the smallest node of its main component: a member is sent with what changes
    from that set to its own, and the changes that two members share tell what they share.
    """
    main = stage(_main(members).select(F.col("bucket").alias("of"), "main"), "mains")
    full = stage(members.join(main, F.col("bucket") == F.col("of")).drop("of"), "open")
    changes = _changes(full.select(F.col("main").alias("a"), F.col("rep").alias("b")).distinct(), docs, classes, size, percent)
    own = changes.select(F.col("pivot").alias("p"), F.col("rep").alias("q"), "changes", "excess")
    its = (F.col("main") == F.col("p")) & (F.col("rep") == F.col("q"))
    # Blocks of a bucket and cells of many, by their rows and by what is sent with these.
    volumes = full.join(own.select("p", "q", F.size("changes").alias("volume")), its)
    held = stage(volumes.groupBy("bucket").agg(F.sum("volume").alias("volume"), F.count("*").alias("k")), "held")
    total = held.agg(F.sum("volume").alias("volume"), F.sum("k").alias("k")).first()
    cells = max(16, -(-total["k"] // CELL_ROWS), -(-total["volume"] // CELL_SHINGLES))
    blocks = F.ceil(F.greatest(F.col("k") / BLOCK_ROWS, F.col("volume") / CELL_SHINGLES)).cast("int")
    full = full.join(held.select(F.col("bucket").alias("of"), blocks.alias("blocks")), F.col("bucket") == F.col("of"))
    signature = classes.select(F.col("rep").alias("r"), "signature")
    full = full.join(own, its).join(signature, F.col("rep") == F.col("r"))

    def celled(df: DataFrame) -> DataFrame:
        return df.withColumn("cell", F.pmod(F.xxhash64("bucket", "block"), F.lit(cells)).cast("int"))

    columns = ["cell", "bucket", "block", "pos", "rep", "c", "signature", "changes", "excess"]
    right = celled(full.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))).select(*columns)
    left = full.filter("c <> main").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # Under names of its own, as both sides come from the same rows.
    left = celled(left).select(*[F.col(c).alias(f"l_{c}") for c in columns])
    chunk_of = np.repeat(np.arange(CHUNKS), [len(c) for c in np.array_split(np.arange(POSITIONS), CHUNKS)])
    starts = np.flatnonzero(np.diff(chunk_of, prepend=-1))
    sizes = np.bincount(chunk_of)

    def first_shared(same: np.ndarray) -> np.ndarray:
        """The first position that can be left out of a chunk for two rows to share it."""
        errors = sizes - np.add.reduceat(same, starts, axis=1, dtype=np.int64)
        usable = (errors[:, chunk_of] == 0) | (errors[:, chunk_of] == 1) & ~same
        return np.argmax(usable, axis=1)

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        if left.num_rows and right.num_rows:
            left = left.rename_columns(columns)
            code = lambda t: t["bucket"].to_numpy() * np.int64(31) + t["block"].to_numpy()
            lc, rc = code(left), code(right)
            order = np.argsort(rc, kind="stable")
            ls, rs = (_matrix(t["signature"].combine_chunks()) for t in (left, right))
            l_c, r_c, pos = left["c"].to_numpy(), right["c"].to_numpy(), left["pos"].to_numpy()
            l_excess, r_excess = left["excess"].to_numpy(), right["excess"].to_numpy()
            lists = [t["changes"].combine_chunks() for t in (left, right)]
            l_flat, flat = (x.values.to_numpy().view(np.uint64) for x in lists)
            l_cuts, cuts = (x.offsets.to_numpy().astype(np.int64) for x in lists)
            begin, end = (np.searchsorted(rc[order], lc, side) for side in ("left", "right"))
            for i in range(len(lc)):
                rows = order[begin[i] : end[i]]
                rows = rows[r_c[rows] != l_c[i]]
                own = l_flat[l_cuts[i] : l_cuts[i + 1]]
                needed = l_excess[i] + r_excess[rows]
                possible = 2 * (100 + percent) * np.minimum(len(own), cuts[rows + 1] - cuts[rows]) >= needed
                rows, needed = rows[possible], needed[possible]
                same = rs[rows] == ls[i]
                near = same.sum(axis=1) >= POSITIONS - CONFIRMED
                rows, needed, same = rows[near], needed[near], same[near]
                if len(rows):
                    first = first_shared(same) == pos[i]
                    rows, needed = rows[first], needed[first]
                    linked = rows[2 * (100 + percent) * shared_with(own, rows, flat, cuts) >= needed]
                    out.append((np.full(len(linked), i), linked))
        l, r = (np.concatenate([o[i] for o in out]) for i in (0, 1))
        if len(l):
            kept = spanning(l_c[l], r_c[r])
            l, r = left["rep"].to_numpy()[l[kept]], right["rep"].to_numpy()[r[kept]]
        return pa.table({"a": pa.array(np.minimum(l, r)), "b": pa.array(np.maximum(l, r))})

    return left.groupBy("l_cell").cogroup(right.groupBy("cell")).applyInArrow(meet, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    size: int = 5,
    percent: int = 80,
    doc_id: str = "doc_id",
    text: str = "text",
    hash_as: str | None = None,
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id, kept.

    Documents are linked if they share at least `percent` per cent of the union of
    their shingles of `size` words. component_id is the smallest id that can be reached
    over links. Texts that are null, empty or without words link with nothing. Rows
    without an id link with nothing either, have no component and are kept. Repeated
    rows share their component; rows of one id with other texts go by their own text.
    Of a component the rows of the smallest id are kept, and if that has several texts
    in it, those of one set of shingles. `hash_as` names a column for xxhash64 of the
    text, which tells rows of one id apart.
    """
    docs = docs.select(
        column(doc_id).cast("long").alias("doc_id"), F.xxhash64(column(text)).alias("text_hash"), column(text).alias("text")
    )
    signed = stage(_signed(docs, size), "signed")
    classes = _classes(signed)
    keys = _keyed(classes)
    buckets = keys.groupBy("key").agg(F.count("*").alias("n"), F.min("rep").alias("low")).filter("n > 1")
    buckets = stage(buckets.withColumnRenamed("key", "bucket"), "buckets")
    members = stage(
        keys.join(buckets, F.col("key") == F.col("bucket")).select("bucket", "pos", "n", "low", "rep"), "members"
    )
    tested = components = None
    for number in range(ROUNDS):
        if number == 0:
            offered = members.filter("rep <> low").select(F.col("low").alias("a"), F.col("rep").alias("b"))
        else:
            # The pivot of a bucket is now one of its main component.
            pivots = _main(members).select(F.col("bucket").alias("of"), F.col("pivot").alias("a"), "main")
            apart = members.join(pivots, F.col("bucket") == F.col("of")).filter("c <> main")
            offered = apart.select("a", F.col("rep").alias("b"))
        shared = offered.groupBy("a", "b").agg(F.count("*").alias("shared"))
        if tested is not None:
            shared = shared.join(tested, ["a", "b"], "left_anti")
        best = shared.groupBy("b").agg(F.max(F.struct(F.col("shared"), (-F.col("a")).alias("a"))).alias("best"))
        fresh = stage(best.select((-F.col("best.a")).alias("a"), "b"), "fresh")
        tested = fresh if tested is None else tested.unionByName(fresh)
        found = _confirm(stage(_close(fresh, classes), "near"), docs, classes, size, percent)
        components = extend(components, found)
        members = _open(members, components)
    if not members.isEmpty():
        components = extend(components, stage(_apart(members, docs, classes, size, percent), "links"))
    # A component goes by the smallest id of its classes.
    owner = stage(_component(classes.select("digest", "id", "rep"), components, "c", F.col("rep")), "owners")
    first = owner.groupBy("c").agg(F.min(F.struct("id", "digest")).alias("first"))
    first = first.select(F.col("c").alias("of_c"), F.col("first.id").alias("component_id"), F.col("first.digest").alias("leads"))
    owner = owner.join(first, F.col("c") == F.col("of_c"))
    owner = owner.select(F.col("digest").alias("of"), "component_id", (F.col("digest") == F.col("leads")).alias("leads"))
    out = signed.join(owner, (F.col("digest") == F.col("of")) & F.col("doc_id").isNotNull(), "left")
    own = F.coalesce("component_id", F.col("doc_id"))
    return out.select(
        F.col("doc_id").alias(doc_id),
        "n_shingles",
        own.alias("component_id"),
        F.coalesce((F.col("doc_id") == own) & F.coalesce("leads", F.lit(True)), F.lit(True)).alias("kept"),
        *([] if hash_as is None else [F.col("text_hash").alias(hash_as)]),
    )
