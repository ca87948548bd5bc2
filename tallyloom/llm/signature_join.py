"""Similarity join of word shingle sets with signature trees.

Two sets link when ``percent`` of their union is shared. Sets that could link are first brought
together: if the hash of a shingle deals both sets into more parts than shingles they can differ
in, some part is equal in both, so equal parts (hashed, per size class) are the only candidates. Sets
of a shared passage can have such a part, too, so a bound on what two sets share, from counts of
their shingles in a few buckets, drops pairs that can't link. Candidates that then hang together
form clusters. Within a cluster a signature tree is built: a leaf
holds a few sets, and every node the OR of its sets' token bitmaps and the range of their sizes.
A traversal of pairs of nodes drops those whose largest possible overlap is too small, and those
whose sets are all in one component already; what is left is counted exactly.

Equal sets are one node from the start, so groups of copies cost one row for each task. A cluster
too large for one task is cut into chunks that share one leading set; only what does not hang
together with that set is compared with all chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.common import doc_text, lean, lean_group, partitions
from tallyloom.llm.connected import components, local_components
from tallyloom.llm.words import Words, blank_separated, gram_places, grams, mix, steps
from tallyloom.session import ship_by_value, stored

ship_by_value(__name__)

#: Sets that one task compares at most at a time.
CHUNK = 3000
BLOCKS_PER_PARTITION = 3
PACKS_PER_PARTITION = 4
LEAF = 8
#: Further ways to deal a set into parts if too many parts stay empty; then all such sets meet.
DEALS = 4
#: Shingles that a bucket of a set's counting signature holds on average, at most.
SHINGLES_PER_BUCKET = 4


class ShingleSets:
    """Distinct shingles of each row: sorted hashes, with the bounds of every row's part."""

    def __init__(self, texts: pa.Array, size: int):
        words = Words(texts, blank_separated(), lower=True)
        hashes = words.hashes()
        places = gram_places(words, size)
        found, rows = [grams(hashes, size)[places]], [words.owner[places]]
        for k in range(1, size):  # texts of fewer words are one shingle
            short = np.flatnonzero(words.counts == k)
            at = words.firsts[short]
            whole = np.zeros(len(at), np.uint64)
            for j in range(k):
                whole = mix(whole * np.uint64(0x2545F4914F6CDD1D) + hashes[at + j])
            found.append(mix(whole + np.uint64(k)))
            rows.append(short)
        tokens, owner = np.concatenate(found), np.concatenate(rows)
        order = np.argsort(tokens)
        kind = np.uint16 if words.rows < 65536 else np.int64
        order = order[np.argsort(owner[order].astype(kind), kind="stable")]
        tokens, owner = tokens[order], owner[order]
        new = np.ones(len(tokens), bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
        self.tokens, self.owner = tokens[new], owner[new]
        self.bounds = np.searchsorted(self.owner, np.arange(words.rows + 1))
        self.sizes = np.diff(self.bounds)
        totals = np.zeros(words.rows, np.uint64)
        np.add.at(totals, self.owner, mix(self.tokens ^ np.uint64(0x5851F42D4C957F2D)))
        #: One number for each set, the same for equal sets only (64 bits).
        self.nodes = mix(totals + self.sizes.astype(np.uint64)).view(np.int64)

    def of(self, row: int) -> np.ndarray:
        return self.tokens[self.bounds[row] : self.bounds[row + 1]]


def size_classes(largest: int, percent: int) -> np.ndarray:
    """Lower bounds of size classes: sets that link are in one class or in neighbouring ones."""
    bounds = [0, 1]
    while bounds[-1] <= largest:
        bounds.append(max(bounds[-1] + 1, (bounds[-1] - 1) * 100 // percent + 1))
    return np.array(bounds + [(bounds[-1] - 1) * 100 // percent + 1])


def parts_of(largest: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Parts for sets up to a size, and how many of them may be empty without loss."""
    differ = 2 * largest * (100 - percent) // (100 + percent)
    spare = np.where(differ < 3, 0, 1 + (differ + 1) // 10)
    return differ + 1 + spare, spare


def part_keys(sets: ShingleSets, rows: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the non-empty parts of these rows' sets: (key, row) pairs."""
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    rows = rows[sets.sizes[rows] > 0]
    if not len(rows):
        return none
    bounds = size_classes(int(sets.sizes[rows].max()), percent)
    own = np.searchsorted(bounds, sets.sizes[rows], "right") - 1
    keys, owners = [], []
    for step in (0, 1):  # as a set of its class, and as the smaller partner of the next one
        left, group = rows, own + step
        for deal in range(DEALS + 1):
            if not len(left):
                break
            parts, spare = parts_of(bounds[group + 1] - 1, percent)
            if deal == DEALS:
                keys.append(mix(mix(group.astype(np.uint64)) + np.uint64(0x9FB21C651E98DF25)))
                owners.append(left)
                break
            first = np.cumsum(parts) - parts
            slot = np.full(len(sets.sizes), -1)
            slot[left] = np.arange(len(left))
            at = slot[sets.owner]
            mine = np.flatnonzero(at >= 0)
            at, tokens = at[mine], sets.tokens[mine]
            part = (mix(tokens + np.uint64(deal * 0x632BE59BD9B4E019 % 2**64)) % parts[at].astype(np.uint64)).astype(np.int64)
            total = int(parts.sum())
            sums = np.zeros(total, np.uint64)
            np.add.at(sums, first[at] + part, tokens)
            full = np.bincount(first[at] + part, minlength=total) > 0
            which = np.repeat(np.arange(len(left)), parts)
            number = np.arange(total) - first[which]
            salt = (group[which] << 36) + (number << 4) + deal
            keys.append(mix(mix(sums) + mix(salt.astype(np.uint64)))[full])
            owners.append(left[which[full]])
            empty = parts - np.bincount(which[full], minlength=len(left))
            again = empty > spare
            left, group = left[again], group[again]
    return np.concatenate(keys), np.concatenate(owners)


def _send_keys(size: int, percent: int, blocks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column("doc_id").is_valid())
            seen: set[int] = set()
            for part in steps(batch):
                sets = ShingleSets(part.column("text"), size)
                rows = [i for i, node in enumerate(sets.nodes.tolist()) if not (node in seen or seen.add(node))]
                keys, owner = part_keys(sets, np.array(rows, np.int64), percent)
                block = (keys % np.uint64(blocks)).astype(np.int64)
                order = np.argsort(block)
                low = (keys >> np.uint64(32)).astype(np.uint32)[order]
                nodes = sets.nodes[owner][order]
                cuts = np.searchsorted(block[order], np.arange(blocks + 1))
                used = np.flatnonzero(np.diff(cuts)).tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(used, pa.int32()),
                        pa.array([low[cuts[b] : cuts[b + 1]].tobytes() for b in used], pa.binary()),
                        pa.array([nodes[cuts[b] : cuts[b + 1]].tobytes() for b in used], pa.binary()),
                    ],
                    ["block", "keys", "nodes"],
                )

    return run


def _meet(table: pa.Table) -> pa.Table:
    """(group, node): the distinct sets of nodes that share a key of this block, two at least.

    Groups of equal members, as near copies give for most of their keys, come once. One too large
    to be compared at a time is dealt into slices; every two slices make a group of their own.
    """
    keys = np.concatenate([np.frombuffer(v.as_buffer(), np.uint32) for v in table.column("keys")])
    nodes = np.concatenate([np.frombuffer(v.as_buffer(), np.int64) for v in table.column("nodes")])
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
    keys, nodes = keys[new], nodes[new]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(first, len(keys)))
    first, sizes = first[sizes > 1], sizes[sizes > 1]
    if not len(first):
        return pa.table({"group": pa.array([], pa.int64()), "node": pa.array([], pa.int64())})
    total = np.append(np.uint64(0), np.cumsum(mix(nodes.view(np.uint64))))
    names = mix(total[first + sizes] - total[first] + sizes.astype(np.uint64)).view(np.int64)
    names, once = np.unique(names, return_index=True)
    first, sizes = first[once], sizes[once]
    small = sizes <= CHUNK
    count = sizes[small]
    inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    groups, members = [np.repeat(names[small], count)], [nodes[np.repeat(first[small], count) + inside]]
    for name, at, size in zip(names[~small].tolist(), first[~small].tolist(), sizes[~small].tolist()):
        parts = np.array_split(nodes[at : at + size], -(-2 * size // CHUNK))
        for i in range(len(parts)):
            for j in range(i + 1, len(parts)):
                both = np.concatenate([parts[i], parts[j]])
                cell = mix(np.array([name + (i << 20) + j]).view(np.uint64)).view(np.int64)
                groups.append(np.repeat(cell, len(both)))
                members.append(both)
    return pa.table({"group": pa.array(np.concatenate(groups)), "node": pa.array(np.concatenate(members))})


def signature_of(sets: ShingleSets) -> list[bytes]:
    """Per row: how many shingles fall into each of a power of two of buckets, a byte a bucket.

    Two sets share at most the sum of the smaller counts of each bucket. Neighbouring buckets of a
    signature add up to those of half the length. One with a count beyond a byte is left empty.
    """
    width = np.full(len(sets.sizes), 16)
    while (short := width * SHINGLES_PER_BUCKET < sets.sizes).any():
        width[short] *= 2
    start = np.cumsum(width) - width
    bucket = (mix(sets.tokens + np.uint64(0x2127599BF4325C37)) >> np.uint64(32)).astype(np.int64)
    # the leading bits tell the bucket, so that halves of a signature are neighbours
    at = start[sets.owner] + ((bucket * width[sets.owner]) >> 32)
    counts = np.bincount(at, minlength=int(width.sum()))
    high = np.maximum.reduceat(counts, start) > 255 if len(start) else np.zeros(0, bool)
    flat = np.minimum(counts, 255).astype(np.uint8).tobytes()
    return [b"" if h else flat[i : i + w] for h, i, w in zip(high.tolist(), start.tolist(), width.tolist())]


def _signatures(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column("doc_id").is_valid())
            seen: set[int] = set()
            for part in steps(batch):
                sets = ShingleSets(part.column("text"), size)
                rows = [i for i, node in enumerate(sets.nodes.tolist()) if not (node in seen or seen.add(node))]
                signs = signature_of(sets)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(sets.nodes[rows]),
                        pa.array(sets.sizes[rows].astype(np.int64)),
                        pa.array([signs[i] for i in rows], pa.binary()),
                    ],
                    ["node", "n", "signature"],
                )

    return run


def _promising(percent: int):
    """Of the members of each group, those that signatures allow to link, as edges."""

    def run(table: pa.Table) -> pa.Table:
        table = table.select(["group", "node", "n", "signature"]).combine_chunks()
        group, node, n = (table.column(c).to_numpy() for c in ("group", "node", "n"))
        order = np.lexsort((n, group))
        group, node, n = group[order], node[order], n[order]
        signs = table.column("signature").take(pa.array(order)).to_pylist()
        width = np.array([len(s) for s in signs])
        # per width: the signatures of that width, and those of twice the width halved
        stacks, place = {}, {}
        for w in np.unique(width[width > 0]).tolist():
            for rows, fold in ((np.flatnonzero(width == w), False), (np.flatnonzero(width == w), True)):
                level = w // 2 if fold else w
                block = np.frombuffer(b"".join(signs[i] for i in rows), np.uint8).reshape(-1, w).astype(np.uint16)
                if fold:
                    block = block.reshape(len(rows), level, 2).sum(axis=2, dtype=np.uint16)
                at = place.setdefault(level, np.full(len(signs), -1))
                at[rows] = sum(len(x) for x in stacks.get(level, []))  + np.arange(len(rows))
                stacks.setdefault(level, []).append(block)
        stacks = {k: np.concatenate(v) for k, v in stacks.items()}
        last = np.searchsorted(group, group, "right") - 1
        us, vs = [], []
        live, d = np.arange(len(group)), 0
        while len(live):
            d += 1
            live = live[last[live] - live >= d]
            u, v = live, live + d
            near = 100 * n[u] >= percent * n[v]
            u, v = u[near], v[near]
            level = np.minimum(width[u], width[v])
            good = level == 0
            for w in np.unique(level[level > 0]).tolist():
                own = np.flatnonzero(level == w)
                for k in range(0, len(own), max(1, 4_000_000 // w)):
                    some = own[k : k + max(1, 4_000_000 // w)]
                    x, y = place[w][u[some]], place[w][v[some]]
                    most = np.minimum(stacks[w][x], stacks[w][y]).sum(axis=1, dtype=np.int64)
                    good[some] = most * (100 + percent) >= percent * (n[u[some]] + n[v[some]])
            us.append(u[good])
            vs.append(v[good])
        u, v = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (us, vs))
        names, at = np.unique(np.concatenate([node[u], node[v]]), return_inverse=True)
        label = local_components(len(names), at[: len(u)], at[len(u) :])
        far = np.flatnonzero(label != np.arange(len(names)))
        return pa.table({"u": pa.array(names[far]), "v": pa.array(names[label[far]])})

    return run


class _Tree:
    """A node of the signature tree over some sets."""

    __slots__ = ("children", "members", "bits", "low", "high", "most", "one")

    def __init__(self, members: list[int], children: list[_Tree], bits: int, low: int, high: int, most: int):
        self.members, self.children, self.bits = members, children, bits
        self.low, self.high, self.most, self.one = low, high, most, False


class SignatureTree:
    """Finds which of the given distinct sets (sorted hash arrays) hang together by links.

    A set's bitmap has a bit for each shingle that another of the sets has as well, so two sets
    share as many shingles as their bitmaps share bits.
    """

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent = percent
        self.parent = list(range(len(sets)))
        self.sizes = [len(s) for s in sets]
        every = np.sort(np.concatenate(sets))
        again = np.flatnonzero(every[1:] == every[:-1])
        shared = every[again[np.flatnonzero(np.concatenate([[True], np.diff(again) > 1]))]] if len(again) else every[:0]
        self.bits = []
        for s in sets:
            marks = np.zeros(len(shared), bool)
            if len(shared):
                at = np.minimum(np.searchsorted(shared, s), len(shared) - 1)
                marks[at[shared[at] == s]] = True
            self.bits.append(int.from_bytes(np.packbits(marks).tobytes(), "big"))
        order = sorted(range(len(sets)), key=lambda i: (int(sets[i][0]), self.sizes[i], i))
        level = [self._leaf(order[i : i + LEAF]) for i in range(0, len(order), LEAF)]
        while len(level) > 1:
            level = [self._over(level[i : i + LEAF]) for i in range(0, len(level), LEAF)]
        self.root = level[0]

    def _leaf(self, members: list[int]) -> _Tree:
        bits = 0
        for i in members:
            bits |= self.bits[i]
        sizes = [self.sizes[i] for i in members]
        return _Tree(members, [], bits, min(sizes), max(sizes), max(self.bits[i].bit_count() for i in members))

    def _over(self, children: list[_Tree]) -> _Tree:
        bits = 0
        for c in children:
            bits |= c.bits
        low, high = min(c.low for c in children), max(c.high for c in children)
        return _Tree([], children, bits, low, high, max(c.most for c in children))

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = i = self.parent[self.parent[i]]
        return i

    def _one(self, x: _Tree) -> int:
        """The component of all sets below, or -1 if there are several."""
        if x.one:
            while x.children:
                x = x.children[0]
            return self.find(x.members[0])
        roots = (self._one(c) for c in x.children) if x.children else (self.find(i) for i in x.members)
        first = next(roots)
        if first < 0 or any(r != first for r in roots):
            return -1
        x.one = True
        return first

    def _hopeless(self, x: _Tree, y: _Tree) -> bool:
        """Whether no set below x can link to one below y: the sizes or bitmaps rule it out."""
        p = self.percent
        if 100 * x.high < p * y.low or 100 * y.high < p * x.low:
            return True
        most = min(x.most, y.most, (x.bits & y.bits).bit_count())
        return most * (100 + p) < p * (x.low + y.low)

    def _link(self, i: int, j: int) -> None:
        both = (self.bits[i] & self.bits[j]).bit_count()
        if both * (100 + self.percent) >= self.percent * (self.sizes[i] + self.sizes[j]):
            a, b = self.find(i), self.find(j)
            if a != b:
                self.parent[max(a, b)] = min(a, b)

    def roots(self) -> list[int]:
        """The smallest place of each set's component."""
        todo = [(self.root, self.root)]
        while todo:
            x, y = todo.pop()
            own = x is y
            if not own and self._hopeless(x, y):
                continue
            one = self._one(x)
            if one >= 0 and (own or self._one(y) == one):
                continue
            if x.children or y.children:
                if own:
                    c = x.children
                    todo += [(c[i], c[j]) for i in range(len(c)) for j in range(i + 1, len(c))]
                    todo += [(k, k) for k in c]
                else:
                    todo += [(i, j) for i in x.children or [x] for j in y.children or [y]]
            else:
                for k, i in enumerate(x.members):
                    for j in x.members[k + 1 :] if own else y.members:
                        self._link(i, j)
        return [self.find(i) for i in range(len(self.sizes))]


def _join_pack(size: int, percent: int):
    """Links within each cluster of a pack, as edges to one set of each component."""

    def run(table: pa.Table) -> pa.Table:
        table = table.select(["cluster", "node", "text"]).combine_chunks()
        members: dict[int, dict[int, np.ndarray]] = {}
        for batch in table.to_batches():
            for part in steps(batch):
                sets = ShingleSets(part.column("text"), size)
                wanted = part.column("node").to_pylist()
                for i, cluster in enumerate(part.column("cluster").to_pylist()):
                    if sets.nodes[i] == wanted[i]:
                        members.setdefault(cluster, {})[wanted[i]] = sets.of(i).copy()
        us, vs = [], []
        for own in members.values():
            if len(own) > 1:
                nodes = sorted(own)
                roots = SignatureTree([own[n] for n in nodes], percent).roots()
                for i, r in enumerate(roots):
                    if i != r:
                        us.append(nodes[i])
                        vs.append(nodes[r])
        return pa.table({"u": pa.array(us, pa.int64()), "v": pa.array(vs, pa.int64())})

    return run


def _sets_table(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch):
                sets = ShingleSets(part.column("text"), size)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sets.nodes), pa.array(sets.sizes.astype(np.int64))],
                    ["doc_id", "node", "n_shingles"],
                )

    return run


def shingle_sets(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, node, n_shingles) of each document; equal sets have equal nodes."""
    return doc_text(docs).mapInArrow(lean(_sets_table(size)), "doc_id long, node long, n_shingles long")


def _links(docs: DataFrame, sets: DataFrame, size: int, percent: int, chunk: int) -> DataFrame:
    """Edges (u, v) between nodes such that links and edges give the same components."""
    spark = docs.sparkSession
    text = doc_text(docs)
    blocks = BLOCKS_PER_PARTITION * partitions(spark)
    packs = PACKS_PER_PARTITION * partitions(spark)
    groups = (
        text.mapInArrow(lean(_send_keys(size, percent, blocks)), "block int, keys binary, nodes binary")
        .groupBy("block")
        .applyInArrow(lean_group(_meet), "group long, node long")
        .distinct()
    )
    signed = text.mapInArrow(lean(_signatures(size)), "node long, n long, signature binary")
    signed = signed.groupBy("node").agg(F.max("n").alias("n"), F.max("signature").alias("signature"))
    near = (
        groups.join(signed, "node")
        .withColumn("pack", F.pmod(F.xxhash64("group"), F.lit(packs)))
        .groupBy("pack")
        .applyInArrow(lean_group(_promising(percent)), "u long, v long")
    )
    clusters = components(near, "candidates").withColumnRenamed("component", "cluster")
    # one document stands for each node; those with more than one node in their cluster remain
    stands = sets.filter("doc_id IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("doc_id")).join(clusters, "node")
    sizes = stands.groupBy("cluster").agg(F.count("*").alias("n"), F.min("node").alias("leader"))
    stands = stands.join(sizes, "cluster")
    members = stored(text.join(stands, "doc_id"), "members")
    slices = F.ceil(F.col("n") / chunk)
    small = members.filter(F.col("n") <= chunk).withColumn("pack", F.pmod(F.xxhash64("cluster"), F.lit(packs)))
    large = members.filter(F.col("n") > chunk)
    dealt = large.withColumn("slice", F.explode(F.when(F.col("node") == F.col("leader"), F.sequence(F.lit(0).cast("long"), slices - 1)).otherwise(F.array(F.pmod(F.xxhash64("node"), slices)))))
    join = lean_group(_join_pack(size, percent))
    columns = ["pack", "cluster", "node", "text"]
    first = small.select(columns).unionByName(
        dealt.withColumn("pack", F.xxhash64("cluster", "slice")).select(columns)
    )
    edges = stored(first.groupBy("pack").applyInArrow(join, "u long, v long"), "links")
    if large.isEmpty():
        return edges
    # what does not hang together with the leader of a large cluster meets all of its chunks
    known = components(edges, "known")
    placed = large.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    leading = placed.filter("node = leader").groupBy("cluster").agg(F.max("component").alias("main"))
    placed = placed.join(leading, "cluster").withColumn("apart", F.col("component") != F.col("main"))
    counts = placed.groupBy("cluster").agg(F.sum(F.col("apart").cast("long")).alias("rest"))
    placed = placed.join(counts.filter("rest > 0"), "cluster")
    rests = F.ceil(F.col("rest") / chunk)
    own, own_rest = F.pmod(F.xxhash64("node"), slices), F.pmod(F.xxhash64("node"), rests)
    along = F.transform(F.sequence(F.lit(0).cast("long"), rests - 1), lambda r: F.struct(r.alias("r"), own.alias("s")))
    across = F.transform(F.sequence(F.lit(0).cast("long"), slices - 1), lambda s: F.struct(own_rest.alias("r"), s.alias("s")))
    pairs = F.when(F.col("apart"), F.array_union(along, across)).otherwise(along)
    second = placed.withColumn("cell", F.explode(pairs)).withColumn("pack", F.xxhash64("cluster", "cell.r", "cell.s"))
    return edges.unionByName(second.select(columns).groupBy("pack").applyInArrow(join, "u long, v long"))


def linked_documents(docs: DataFrame, size: int = 4, percent: int = 85, chunk: int = CHUNK) -> DataFrame:
    """Per document: ``n_shingles``, its set's ``node`` and ``component_id``.

    Words are runs without white space, ASCII letters in lower case; a text of fewer words than
    ``size`` is one shingle. Documents link when the sets share ``percent`` per cent of their
    union or more; ``component_id`` is the smallest id reachable. Null and empty texts, and rows
    without id, link with nothing: their component is their own id. Repeated rows are copies.
    Other columns are ignored; an empty table gives no rows. Sets are told apart by 64-bit hashes.
    """
    sets = stored(shingle_sets(docs, size), "sets")
    linked = components(_links(docs, sets, size, percent, chunk), "linked")
    joining = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    nodes = sets.filter(joining).groupBy("node").agg(F.min("doc_id").alias("smallest"))
    nodes = nodes.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = nodes.groupBy("component").agg(F.min("smallest").alias("component_id"))
    named = nodes.join(lowest, "component").select("node", "component_id")
    # a node with very many copies is a skewed key of this join, which Spark splits
    return (
        sets.join(named, "node", "left")
        .withColumn("component_id", F.when(joining, F.col("component_id")).otherwise(F.col("doc_id")))
        .select("doc_id", "n_shingles", "component_id", "node")
    )


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80, chunk: int = CHUNK) -> DataFrame:
    """The documents, with all their columns, that are the first of their component.

    First is the smallest id, and of rows with that id the one of the smallest set number; rows
    that repeat id and text count once. Rows without id, and rows without words, all stay.
    """
    sets = stored(shingle_sets(docs, size), "sets")
    linked = components(_links(docs, sets, size, percent, chunk), "linked")
    own, keep_id, keep_node = (_free_name(docs, c) for c in ("set_node", "keep_id", "keep_node"))
    nodes = (
        sets.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
        .groupBy("node")
        .agg(F.min("doc_id").alias("smallest"))
    )
    nodes = nodes.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    firsts = nodes.groupBy("component").agg(F.min(F.struct("smallest", "node")).alias("first"))
    firsts = firsts.select(F.col("first.smallest").alias(keep_id), F.col("first.node").alias(keep_node))
    schema = T.StructType([*docs.schema.fields, T.StructField(own, T.LongType())])
    numbered = docs.mapInArrow(lean(_numbered(size, own)), schema)
    free = numbered.filter(F.col(own).isNull())
    named = numbered.filter(F.col(own).isNotNull())
    kept = named.join(
        firsts, (named["doc_id"].cast("long") == firsts[keep_id]) & (named[own] == firsts[keep_node])
    ).drop(keep_id, keep_node)
    return kept.dropDuplicates(["doc_id", own]).unionByName(free).drop(own)


def _free_name(docs: DataFrame, name: str) -> str:
    """A column name that the documents do not have in any case."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _numbered(size: int, name: str):
    """Adds each row's set number; null where the row has no id or no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch):
                sets = ShingleSets(part.column("text").cast(pa.string()), size)
                known = (sets.sizes > 0) & part.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
                node = pa.array(sets.nodes, mask=~known)
                yield pa.RecordBatch.from_arrays([*part.columns, node], [*part.schema.names, name])

    return run
