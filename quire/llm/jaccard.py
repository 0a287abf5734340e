"""Exact n-gram Jaccard join as a metric-space join.

Jaccard distance is a metric, so distances to pivots bound distances between documents. Documents of equal
shingle sets are one class. Most texts have nothing in common, so all distances between them are 1 and cells
around pivots would part nothing; supports are split first: two sets within the radius share a shingle of
their prefixes (in one common order, rare shingles first). The class with most shared shingles among those
that hold a prefix shingle is its pivot, and the region of a pivot takes in every class that shares such a
shingle with it, so any two classes that may link meet in a region. Bits of their sets then tell which of a region's
classes cannot link at all, before any text moves. A region of bounded size is joined
exactly in one task. A larger one gets pivots of its own: every class goes to the cell of the nearest,
classes within the window of the triangle inequality (twice the radius) of another cell are replicated into
it, the core of a cell (within the radius of its pivot, so in one component) goes no further unless the
boundary may reach it, and cells are joined in the same way again. Where pivots part nothing, pairs of tiles
of the region are joined instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import distinct, give_back, most_frequent, released, rolled, set_aside, stored, table, word_codes
from quire.llm.components import components

SHINGLE, PERCENT = 5, 80
RADIUS = 1 - PERCENT / 100
#: Regions of so many classes (and shingles) at most are joined in one task; larger ones get pivots.
SMALL, SMALL_SHINGLES = 48, 2_000_000
#: Pivots of a large region, and how often its cells are divided before tiles of TILE classes meet.
PIVOTS, DEPTH = 16, 6
TILE = 32
#: Frequent shingles that the order of prefixes puts last. A bound of what travels to the tasks; which
#: shingles are among them changes the cost, never the result.
FREQUENT = 65_536
#: Shingles that a task counts at a time, postings that it holds, and postings of a bucket.
COUNTED, HELD, BUCKET = 2_000_000, 1_500_000, 1_500_000
#: A shingle of so many sets is hot: its pivot is found by an aggregate and sent to its classes.
HOT = 200_000
#: Classes of one shingle that are checked against each other before texts move; more are kept unchecked.
CHECKED = 64
#: Rows of 8 bytes that may be broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 2_000_000
#: Classes whose signatures meet in a task, and tiles of so many that a region may have; larger regions go on whole.
SIGNED, SIGNED_TILES = 512, 32


def shingle_set(text: bytes | None) -> np.ndarray:
    return distinct(rolled(word_codes((text or b"").lower()), SHINGLE))


def class_code(shingles: np.ndarray) -> int:
    """64-bit code of a set, as a signed number."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def prefix_length(n: int) -> int:
    """Of n shingles, so many that a set of similarity PERCENT or more must share one of the first."""
    return n - -(-PERCENT * n // 100) + 1


def frequent_shingles(texts: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """The most frequent shingles in order of hash, FREQUENT at most, their counts, and the prefix shingles of all
    texts; counted over all texts.

    A task passes on what it saw in two different sets at least, so one that is rare everywhere costs nothing.
    A histogram of the counts gives the least count that stays, so no more than FREQUENT rows are collected.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        sets: list[np.ndarray] = []
        held = total = 0

        def told() -> pa.RecordBatch:
            s = np.sort(np.concatenate([*sets, np.zeros(0, np.uint64)]))
            first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)
            n = np.diff(np.append(first, len(s)))
            return pa.RecordBatch.from_arrays([pa.array(s[first[n > 1]].view(np.int64)), pa.array(n[n > 1])], ["key", "n"])

        for batch in batches:
            for raw in batch.column(0):
                s = shingle_set(raw.as_py())
                if len(s) and (code := class_code(s)) not in seen:
                    seen.add(code)
                    sets.append(s)
                    held += len(s)
                    total += prefix_length(len(s))
                    if held > COUNTED:
                        yield told()
                        seen.clear()
                        sets, held = [], 0
        yield told()
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.array([total], pa.int64())], ["key", "n"])

    counts = stored(texts.mapInArrow(released(count), "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")), "shingle-counts")
    whole = counts.where("key is null").agg(F.sum("n")).first()[0] or 0
    rows = most_frequent(counts.where("key is not null"), "n", FREQUENT)
    keys = np.array([r.key for r in rows], np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], np.array([r.n for r in rows], np.int64)[order], whole


def signature(shingles: np.ndarray) -> bytes:
    """Bits of a set: two to four a shingle, a power of two in all, so a longer signature folds into a shorter one."""
    bits = np.zeros(max(64, 1 << (2 * len(shingles) - 1).bit_length()), bool)
    bits[(shingles & np.uint64(len(bits) - 1)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def sketched(texts: DataFrame) -> DataFrame:
    """``texts`` (column raw and others) with n, class and signature (both null without shingles) in the place of raw."""
    keep = [c for c in texts.columns if c != "raw"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, codes, signed = [], [], []
            for raw in batch.column("raw"):
                s = shingle_set(raw.as_py())
                n.append(len(s))
                codes.append(class_code(s) if len(s) else None)
                signed.append(signature(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(n, pa.int64()), pa.array(codes, pa.int64()), pa.array(signed, pa.binary())], [*keep, "n", "class", "signature"])

    kinds = dict(texts.dtypes)
    return texts.mapInArrow(released(run), ", ".join([*[f"`{c}` {kinds[c]}" for c in keep], "n bigint, class bigint, signature binary"]))


def _planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte: all their first bytes, all second ones and so on. Sorted or small numbers are alike in
    some, which compression takes away."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _joined_planes(planes: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(planes, np.uint8).reshape(size, -1).T.copy().view(kind).ravel()


def shared_keys(texts: DataFrame, keys: np.ndarray, counts: np.ndarray, total: int) -> DataFrame:
    """(key, class, n): prefix shingles that two classes or more have, with these classes.

    Tasks send postings in sorted runs, a run for each bucket of shingles, and each bucket is one group whose
    size does not depend on the input: there are as many buckets as postings ask for. Hot shingles are salted
    by class; their parts may hold single classes.
    """
    buckets = total // BUCKET + 1
    salts = np.maximum(1, counts // HOT)
    place = np.arange(len(keys))[np.lexsort((keys, counts))].argsort() if len(keys) else np.zeros(0, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        prefixes: list[np.ndarray] = []
        codes: list[int] = []
        sizes: list[int] = []
        held = 0

        def told() -> Iterator[pa.RecordBatch]:
            key = np.concatenate([*prefixes, np.zeros(0, np.uint64)])
            who = np.repeat(np.arange(len(codes)), list(map(len, prefixes)))
            code, size = np.array(codes, np.int64), np.array(sizes, np.int32)
            at = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
            parts = np.where(keys[at] == key, salts[at], 1) if len(keys) else np.ones(len(key), np.int64)
            salt = code[who].view(np.uint64) % parts.astype(np.uint64)
            bucket = ((key + salt * np.uint64(0x9E3779B1)) % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((key, bucket))
            key, who, bucket, salted = key[order], who[order], bucket[order], parts[order] > 1
            edges = np.searchsorted(bucket, np.arange(buckets + 1))
            rows = []
            for b in np.flatnonzero(np.diff(edges)):
                part = slice(edges[b], edges[b + 1])
                own, back = np.unique(who[part], return_inverse=True)
                rows.append((int(b), _planes(key[part]), np.packbits(salted[part]).tobytes(), _planes(back.astype(np.uint32)), code[own].tobytes(), size[own].tobytes()))
            for at in range(0, len(rows), 64):
                columns = list(zip(*rows[at : at + 64], strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), *[pa.array(c, pa.binary()) for c in columns[1:]]], ["bucket", "keys", "salted", "who", "codes", "sizes"])

        for batch in batches:
            for raw in batch.column(0):
                s = shingle_set(raw.as_py())
                # Fewer than four shingles: only an equal set is similar enough.
                if len(s) < 4 or (code := class_code(s)) in seen:
                    continue
                seen.add(code)
                at = np.minimum(np.searchsorted(keys, s), max(len(keys) - 1, 0))
                often = keys[at] == s if len(keys) else np.zeros(len(s), bool)
                prefixes.append(np.concatenate([s[~often], s[often][np.argsort(place[at[often]])]])[: prefix_length(len(s))])
                codes.append(code)
                sizes.append(len(s))
                held += len(prefixes[-1])
                if held > HELD:
                    yield from told()
                    seen.clear()
                    prefixes, codes, sizes, held = [], [], [], 0
        if prefixes:
            yield from told()

    def meet(group: pa.Table) -> pa.Table:
        key, code, size, hot = [], [], [], []
        for r in group.to_pylist():
            key.append(_joined_planes(r["keys"], np.uint64))
            who = _joined_planes(r["who"], np.uint32)
            code.append(np.frombuffer(r["codes"], np.int64)[who])
            size.append(np.frombuffer(r["sizes"], np.int32)[who])
            hot.append(np.unpackbits(np.frombuffer(r["salted"], np.uint8), count=len(who)).astype(bool))
        key, code, size, hot = map(np.concatenate, (key, code, size, hot))
        order = np.lexsort((code, key))
        key, code, size, hot = key[order], code[order], size[order], hot[order]
        fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (code[1:] != code[:-1])])
        key, code, size, hot = key[fresh], code[fresh], size[fresh], hot[fresh]
        same = key[1:] == key[:-1]
        good = hot | np.concatenate([[False], same]) | np.concatenate([same, [False]])
        out = pa.table([pa.array(key[good].view(np.int64)), pa.array(code[good]), pa.array(size[good]), pa.array(hot[good])], ["key", "class", "n", "hot"])
        give_back()
        return out

    runs = texts.mapInArrow(released(run), "bucket bigint, keys binary, salted binary, who binary, codes binary, sizes binary")
    return stored(runs.groupBy("bucket").applyInArrow(meet, "key bigint, class bigint, n int, hot boolean"), "shared-keys")


def _may_link(na: np.ndarray, nb: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Sets of sizes na and nb that share c prefix shingles at most can still be similar enough."""
    pa_, pb = na - -(-PERCENT * na // 100) + 1, nb - -(-PERCENT * nb // 100) + 1
    most = c + np.maximum(np.minimum(na - pa_, nb - c), np.minimum(nb - pb, na - c))
    return (np.minimum(na, nb) * 100 >= np.maximum(na, nb) * PERCENT) & (most * 100 >= (na + nb - most) * PERCENT)


def first_regions(shared: DataFrame) -> DataFrame:
    """(pivot, class): of each prefix shingle the class with most shared shingles is the pivot of the others.

    Classes that no other class of the shingle can be similar to, as sizes and numbers of shared shingles
    tell, are left out. Rows of a shingle come in order with its pivot first, so they pass one by one.
    """
    own = shared.groupBy("class").agg(F.max("n").alias("n"), F.collect_list(F.when(~F.col("hot"), F.col("key"))).alias("keys"), F.collect_list(F.when(F.col("hot"), F.col("key"))).alias("hots"), F.count("*").alias("s"))
    own = stored(own, "own-keys")
    rows = own.select(F.explode("keys").alias("key"), "class", "n", "s")
    rows = rows.repartition(F.col("key")).sortWithinPartitions("key", F.desc("s"), "class")

    def attach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("key", "class", "n", "s")
        held = {k: np.zeros(0, np.int64) for k in names}
        open_key = open_pivot = None

        def pairs(key: np.ndarray, code: np.ndarray, n: np.ndarray, s: np.ndarray) -> pa.RecordBatch:
            nonlocal open_key, open_pivot
            first = np.concatenate([[True], key[1:] != key[:-1]])
            size = np.diff(np.append(np.flatnonzero(first), len(key)))
            wide = np.repeat(size > CHECKED, size) | (key == open_key if open_key is not None else np.zeros(len(key), bool))
            ok = wide.copy()
            for off in range(1, min(int(size.max()), CHECKED)):
                a = np.flatnonzero((key[:-off] == key[off:]) & ~wide[:-off])
                a = a[_may_link(n[a], n[a + off], np.minimum(s[a], s[a + off]))]
                ok[a] = ok[a + off] = True
            key, code = key[ok], code[ok]
            if not len(key):
                return pa.RecordBatch.from_arrays([pa.array([], pa.int64()), pa.array([], pa.int64())], ["pivot", "class"])
            start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            pivot = np.repeat(code[start], np.diff(np.append(start, len(key))))
            if open_key is not None:
                pivot[key == open_key] = open_pivot
            open_key, open_pivot = int(key[-1]), int(pivot[-1])
            both = np.stack([pivot, code], 1)[pivot != code]
            both = both[np.lexsort((both[:, 1], both[:, 0]))]
            both = both[np.concatenate([[True], (both[1:] != both[:-1]).any(1)])] if len(both) else both
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], ["pivot", "class"])

        for batch in batches:
            held = {k: np.concatenate([held[k], batch.column(k).to_numpy().astype(np.int64)]) for k in names}
            last = int(np.searchsorted(held["key"], held["key"][-1])) if len(held["key"]) else 0
            # The last shingle may go on; where it is long already, what came of it goes ahead of the rest.
            cut = len(held["key"]) if len(held["key"]) - last > 100_000 else last
            if cut:
                yield pairs(*[held[k][:cut] for k in names])
                held = {k: v[cut:] for k, v in held.items()}
        if len(held["key"]):
            yield pairs(*[held[k] for k in names])

    found = rows.mapInArrow(released(attach), "pivot bigint, class bigint")
    hot = own.where(F.size("hots") > 0).select(F.explode("hots").alias("key"), "class", "s")
    leaders = hot.groupBy("key").agg(F.max(F.struct("s", "class")).alias("t")).select("key", F.col("t.class").alias("pivot"))
    # As many leaders as FREQUENT at most.
    found = found.union(hot.join(F.broadcast(leaders), "key").where("pivot <> class").select("pivot", "class"))
    return stored(found.distinct(), "regions")


def _signed_pairs(n: np.ndarray, signed: list[bytes]) -> np.ndarray:
    """Which pairs of sets of sizes ``n`` can link, by their signatures: a bit that only one has stands for a shingle that
    the other lacks. Lengths of sets that can link differ by a factor of two at most."""
    m, length = len(n), np.array(list(map(len, signed)))
    near = np.zeros((m, m), bool)
    for size in np.unique(length):
        at = np.flatnonzero((length == size) | (length == 2 * size))
        rows = [np.frombuffer(signed[i], np.uint8) for i in at]
        rows = np.stack([r if len(r) == size else r[:size] | r[size:] for r in rows])
        own = np.zeros(len(at), np.float64)
        both = np.zeros((len(at), len(at)), np.float64)
        for k in range(0, int(size), 512):
            bits = np.unpackbits(rows[:, k : k + 512], axis=1).astype(np.float32)
            own += bits.sum(1)
            both += bits @ bits.T
        # Of a's shingles b has as many at most; and the other way round.
        most = n[at][:, None] - own[:, None] + both
        most = np.minimum(most, most.T)
        own_length = length[at] == size
        here = (own_length[:, None] | own_length[None]) & ((100 + PERCENT) * most >= PERCENT * (n[at][:, None] + n[at][None]))
        near[np.ix_(at, at)] |= here
    np.fill_diagonal(near, False)
    return near


def _parted(group: pa.Table) -> pa.Table:
    """(region, class, n) of the classes of a tile, or of two, that another one of them can link with. Where the region is
    one tile, each of its parts that hang together becomes a region of its own."""
    rows = group.select(["region", "mine", "tiles", "class", "n", "signature"]).to_pydict()
    near = _signed_pairs(np.array(rows["n"], np.float64), rows["signature"])
    if rows["tiles"][0] > 1:
        mine = np.array(rows["mine"])
        # A pair of one tile is looked at where that tile meets itself.
        near &= (mine[:, None] != mine[None]) | (mine.min() == mine.max())
        at, part = np.flatnonzero(near.any(1)), None
    else:
        part = np.full(len(near), -1)
        for root in np.flatnonzero(near.any(1)):
            todo = [root] if part[root] < 0 else []
            part[todo] = root
            while todo:
                new = np.flatnonzero(near[todo.pop()] & (part < 0))
                part[new] = root
                todo += new.tolist()
        at = np.flatnonzero(part >= 0)
    name = rows["region"][0]
    names = [name if part is None else f"{name}:{rows['class'][part[i]]}" for i in at]
    return pa.table([pa.array(names, pa.string()), pa.array([rows["class"][i] for i in at], pa.int64()), pa.array([rows["n"][i] for i in at], pa.int64())], ["region", "class", "n"])


def parted(members: DataFrame, signed: DataFrame) -> DataFrame:
    """Regions (region, class, n) without classes that no other of the region can link with, and in parts where signatures
    part them, so that texts move only to others that they may be similar to. Most classes share a shingle by chance,
    and with more texts more do.

    ``signed`` has class and signature. Tiles of a region of more than SIGNED classes meet in pairs; one of more than
    SIGNED_TILES tiles is left as it is, and pivots part it.
    """
    sizes = members.groupBy("region").agg(F.ceil(F.count("*") / SIGNED).cast("int").alias("tiles"))
    rows = stored(members.join(sizes, "region"), "region-sizes")
    mine = F.pmod(F.xxhash64("class", F.lit(-3)), "tiles").cast("int")
    each = rows.where(F.col("tiles") <= SIGNED_TILES).withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    each = each.join(signed, "class").select("region", "tiles", "mine", F.least("mine", "other").alias("t"), F.greatest("mine", "other").alias("u"), "class", "n", "signature")
    found = each.groupBy("region", "t", "u").applyInArrow(_parted, "region string, class bigint, n bigint").distinct()
    return stored(found.union(rows.where(F.col("tiles") > SIGNED_TILES).select("region", "class", "n")), "parts")


def _similar(a: np.ndarray, b: np.ndarray) -> tuple[float, bool]:
    """Distance of two sets, and whether they link."""
    shared = int((a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b).sum())
    union = len(a) + len(b) - shared
    return 1 - shared / union, 100 * shared >= PERCENT * union


def linked(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that hold the components of ``sets`` together (a spanning forest), all pairs compared."""
    m = len(sets)
    if m == 2:
        return [(0, 1)] if _similar(*sets)[1] else []
    size = np.array(list(map(len, sets)))
    value, owner = np.concatenate(sets), np.repeat(np.arange(m), size)
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    column = np.cumsum(np.concatenate([[0], value[1:] != value[:-1]]))
    often = np.bincount(column)[column] > 1
    column, owner = column[often], owner[often]
    shared = np.zeros((m, m), np.float64)
    at = 0
    while at < len(column):
        end = int(np.searchsorted(column, column[at] + 4096))
        has = np.zeros((m, 4096), np.float32)
        has[owner[at:end], column[at:end] - column[at]] = 1
        shared += has @ has.T
        at = end
    near = 100 * shared >= PERCENT * (size[:, None] + size[None] - shared)
    out, seen = [], np.zeros(m, bool)
    for root in range(m):
        todo = [] if seen[root] else [root]
        seen[root] = True
        while todo:
            i = todo.pop()
            for j in np.flatnonzero(near[i] & ~seen):
                seen[j] = True
                out.append((i, int(j)))
                todo.append(int(j))
    return out


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of classes, compressed: they are exchanged once or more."""
    codec = pa.Codec("zstd")
    for batch in batches:
        packed = [None if raw.as_py() is None else len(raw.as_py()).to_bytes(8, "little") + codec.compress(raw.as_py(), asbytes=True) for raw in batch.column("raw")]
        yield pa.RecordBatch.from_arrays([batch.column("class"), pa.array(packed, pa.binary())], ["class", "raw"])


def _packed_set(packed: bytes) -> np.ndarray:
    """The shingles of a text that _packed compressed."""
    return shingle_set(pa.Codec("zstd").decompress(packed[8:], int.from_bytes(packed[:8], "little"), asbytes=True))


def _joined_whole(group: pa.Table) -> pa.Table:
    group = group.combine_chunks().sort_by("class")
    codes = group.column("class").to_numpy()
    found = linked([_packed_set(raw.as_py()) for raw in group.column("raw")])
    return pa.table([pa.array([int(codes[i]) for i, _ in found], pa.int64()), pa.array([int(codes[j]) for _, j in found], pa.int64())], ["a", "b"])


def _celled(group: pa.Table) -> pa.Table:
    """Classes of one part of a region in the cells of its pivots: the nearest one's, and those within the window."""
    rows = group.to_pylist()
    pivots: list[tuple[int, np.ndarray]] = []
    for r in sorted((r for r in rows if r["is_pivot"]), key=lambda r: r["class"]):
        s = _packed_set(r["raw"])
        # Pivots within the radius of each other would have the same cell.
        if not any(_similar(p, s)[1] for _, p in pivots):
            pivots.append((r["class"], s))
    out = []
    for r in rows:
        if r["is_pivot"]:
            continue
        s = _packed_set(r["raw"])
        told = [(*_similar(p, s), code) for code, p in pivots]
        nearest = min(told)
        out += [(r["region"], code, r["class"], r["n"], d, near, code == nearest[2]) for d, near, code in told if code == nearest[2] or d <= nearest[0] + 2 * RADIUS + 1e-9]
    columns = list(zip(*out, strict=True)) or [()] * 7
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.bool_(), pa.bool_()]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["region", "pivot", "class", "n", "d", "near", "home"])


def _with_texts(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """``rows`` with the text of their class; where they are few they go to the texts, not the texts to them."""
    few = rows.count() <= BROADCAST_ROWS
    return texts.join(F.broadcast(rows) if few else rows, "class")


def region_links(regions: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b): links that hold the components together, from ``regions`` (region, class, n) joined recursively.

    ``texts`` (class, raw) has one text of each class, compressed. Each level writes the cells of regions that are still
    too large; their number is that of classes in such regions, not of all.
    """
    links = None
    whole = []
    tiled = []
    now = regions
    for level in range(DEPTH + 1):
        sizes = now.groupBy("region").agg(F.count("*").alias("m"), F.sum("n").alias("total")).where("m > 1")
        fits = (F.col("m") <= SMALL) & (F.col("total") <= SMALL_SHINGLES) | (F.col("m") == 2)
        now = stored(now.join(sizes, "region").withColumn("fits", fits), "level")
        whole.append(now.where("fits").select("region", "class"))
        large = now.where("not fits")
        if large.isEmpty():
            break
        if level == DEPTH:
            tiled.append(large.select("region", "class", "n", "m", "total"))
            break
        h = F.xxhash64("class", F.lit(level))
        parts = F.greatest(F.ceil(F.col("m") / TILE), F.ceil(F.col("total") / SMALL_SHINGLES)).cast("int")
        chosen = large.groupBy("region", F.pmod(h, F.lit(PIVOTS)).alias("bin")).agg(F.min(F.struct(h.alias("h"), "class")).alias("t"), F.max(parts).alias("parts")).select("region", F.col("t.class").alias("class"), "parts")
        members = large.select("region", F.pmod(F.xxhash64("class", F.lit(-1)), parts).cast("int").alias("part"), "class", "n", F.lit(False).alias("is_pivot"))
        leaders = chosen.select("region", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "class", F.lit(0).cast("bigint").alias("n"), F.lit(True).alias("is_pivot"))
        told = _with_texts(stored(members.union(leaders), "asked"), texts).groupBy("region", "part").applyInArrow(_celled, "region string, pivot bigint, class bigint, n bigint, d double, near boolean, home boolean")
        cells = stored(told, "cells")
        own = cells.where("near and class <> pivot").select(F.col("class").alias("a"), F.col("pivot").alias("b"))
        links = own if links is None else links.union(own)
        # The boundary of a cell, and how much of its core the boundary can reach.
        cell = ["region", "pivot"]
        reach = cells.groupBy(*cell).agg(F.min(F.when(~F.col("near"), F.col("d"))).alias("edge"))
        rows = cells.join(reach, cell).where("not near or d >= edge - %r" % (RADIUS + 1e-9))
        span = rows.where("home").groupBy(*cell).agg(*[f(F.when(c, F.col("d"))).alias(n) for n, f, c in (("lo", F.min, F.lit(True)), ("hi", F.max, F.lit(True)), ("far_lo", F.min, ~F.col("near")), ("far_hi", F.max, ~F.col("near")))])
        lo, hi = (F.when(F.col("near"), F.col(f"far_{k}")).otherwise(F.col(k)) for k in ("lo", "hi"))
        rows = rows.join(span, cell).where(F.col("home") | F.col("d").between(lo - (RADIUS + 1e-9), hi + (RADIUS + 1e-9)))
        rows = stored(rows.select("region", "pivot", "class", "n"), "left")
        grown = rows.groupBy("region", "pivot").agg(F.count("*").alias("c")).groupBy("region").agg(F.sum("c").alias("all"), F.max("c").alias("most"))
        before = sizes.join(grown, "region")
        stuck = before.where("all > 2 * m or most > 0.9 * m").select("region")
        tiled.append(large.join(stuck, "region", "left_semi").select("region", "class", "n", "m", "total"))
        now = rows.join(stuck, "region", "left_anti").select(F.concat_ws("/", "region", "pivot").alias("region"), "class", "n")

    groups = [w.select("region", F.lit(0).alias("t"), F.lit(0).alias("u"), "class") for w in whole]
    for t in tiled:
        tiles = F.greatest(F.ceil(F.col("m") / TILE), F.ceil(F.col("total") * 2 / SMALL_SHINGLES)).cast("int")
        mine = F.pmod(F.xxhash64("class", F.lit(-2)), tiles).cast("int")
        each = t.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
        groups.append(each.select("region", F.least("mine", "other").alias("t"), F.greatest("mine", "other").alias("u"), "class"))
    every = groups[0]
    for g in groups[1:]:
        every = every.union(g)
    found = _with_texts(every, texts).groupBy("region", "t", "u").applyInArrow(_joined_whole, "a bigint, b bigint")
    return stored((found if links is None else found.union(links)).distinct(), "links")


def joined(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a row of ``docs``: row, doc_id, n_shingles, n_copies (rows of the same set), component_id, component.

    component_id is the smallest doc_id reachable by links, its own included. Null texts and texts without
    words have no shingles and are linked with nothing; a text of fewer than five words is one shingle.
    Repeated rows are copies of each other. Null ids are passed over as component ids unless a component
    has no other. ``row`` numbers the rows as monotonically_increasing_id() does; ``component`` is null without
    shingles. Words, shingles and sets are told apart by 64-bit codes. Texts are found again by their
    content, so the rows may come in another order when ``docs`` is read again.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("bigint").alias("doc_id"), F.xxhash64(body).alias("h"), body.cast("binary").alias("raw"))
    sketches = stored(sketched(rows), "sketches")
    classes = stored(sketches.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("least"), F.count("*").alias("n_copies"), F.min("h").alias("h"), F.max("n").alias("n")), "classes")

    frequent, counts, total = frequent_shingles(rows.select("raw"))
    regions = first_regions(shared_keys(rows.select("raw"), frequent, counts, total))
    member = regions.select("pivot", "class").union(regions.select("pivot", F.col("pivot").alias("class")).distinct())
    regions = stored(member.join(classes, "class").select(F.col("pivot").cast("string").alias("region"), "class", "n"), "members")
    signed = sketches.join(regions.select("class").distinct(), "class", "left_semi").select("class", "signature").dropDuplicates(["class"])
    regions = parted(regions, signed)
    wanted = stored(regions.select("class").distinct().join(classes, "class").select("class", "h", (F.col("n_copies") == 1).alias("alone")), "wanted")
    few = wanted.count() <= BROADCAST_ROWS
    found = rows.select("h", "raw").join(F.broadcast(wanted) if few else wanted, "h").select("class", "alone", "raw")
    # Of copies one text is enough; those that have none need no exchange.
    single, copies = (found.where(c).select("class", "raw").mapInArrow(released(_packed), "class bigint, raw binary") for c in ("alone", "not alone"))
    texts = stored(single.union(copies.groupBy("class").agg(F.min("raw").alias("raw"))), "texts")
    label = components(region_links(regions, texts))

    named = classes.join(label.select(F.col("node").alias("class"), "label"), "class", "left").withColumn("label", F.coalesce("label", "class"))
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    named = named.join(least, "label").select("class", "n_copies", "component_id", "label")
    out = sketches.select("row", "doc_id", "n", "class").join(named, "class", "left")
    return out.select("row", "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_copies", F.lit(1)).alias("n_copies"), F.col("label").alias("component"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join over all documents, as ``joined`` gives it."""
    return joined(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "n_copies")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component the row of the smallest doc_id (of its smallest row number) stays.

    Rows without shingles (null and empty texts) stay; repeated rows are copies, of which one stays. ``docs``
    is a stored table, so its rows are numbered alike each time it is read.
    """
    columns = docs.columns
    found = stored(joined(docs).where("component is not null").select("row", "doc_id", "component"), "joined")
    stay = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("m")).select("component", F.col("m.row").alias("stays"))
    gone = stored(found.join(stay, "component").where("row <> stays").select("row"), "gone")
    gone = gone.withColumnRenamed("row", "_row")
    few = gone.count() <= BROADCAST_ROWS
    renamed, back = set_aside(docs, "_row")
    kept = renamed.withColumn("_row", F.monotonically_increasing_id()).join(F.broadcast(gone) if few else gone, "_row", "left_anti")
    return back(kept.drop("_row")).select(*columns)


_ORACLE = """
with recursive w as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as ws from documents),
s as (select distinct doc_id, array_to_string(ws[p:p+4], ' ') as g from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) as p from w where len(ws) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
c as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by all),
e as (select a, b from c join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)),
r(a, b) as (select doc_id, doc_id from documents union select r.a, e.b from r join e on r.b = e.a),
sets as (select doc_id, md5(string_agg(g, chr(10) order by g)) as h from s group by doc_id),
copies as (select doc_id, count(*) over (partition by h) as n_copies from sets)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, m.component_id, coalesce(k.n_copies, 1)::bigint as n_copies
from documents d join (select a, min(b) as component_id from r group by a) m on m.a = d.doc_id left join n on n.doc_id = d.doc_id left join copies k on k.doc_id = d.doc_id"""

QUERIES = {"op3_ngram_jaccard_join": op3_ngram_jaccard_join}
ORACLES = {"op3_ngram_jaccard_join": _ORACLE}
