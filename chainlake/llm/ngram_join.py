"""Documents whose sets of word n-grams nearly agree, found through prefix trees.

Two similar sets share so many n-grams that a set most of whose n-grams occur nowhere else
is similar to none. N-grams are counted first, packed by ranges of their hashes; only sets
with enough n-grams that come again are read again and go on.

What is left is kept in one global order, rare n-grams last. Similar sets share one of the
last few of each (as many as a set may lack, and one more), so sets that share one of these
form groups; a large group is taken by itself as if it were all there is, which splits it
further. Within a group the ordered sets are stored in a prefix tree, whose paths share what
sets have in common. A set walks the tree with what it shares so far and leaves a subtree as
soon as what lacks on either side exceeds what sets of these lengths may lack. At the end of
a path the overlap is exact.

Links are needed as far as they connect: subtrees of sets known to be connected are skipped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlake.llm.anchors import digest, gram_hashes, sources
from chainlake.llm.base import by_batch, dropped, gathered, written
from chainlake.llm.chunks import ranges
from chainlake.llm.components import components
from chainlake.llm.words import coded, document_of

WORDS = 4
PERCENT = 85
# Bytes of text whose n-grams are counted together, and rows at the most.
GATHER = 8 << 20
ROWS = 60_000
# Bytes of text for which there is one range of hashes, and ranges at least.
RANGE = 16 << 20
RANGES = 64
# Stands for sets of several groups.
MIXED = -1
# An n-gram of several sets of one block.
SEVERAL = 0xFFFF
# Sets of one group, and n-grams of them, that are compared in a single task; larger groups
# are cut to blocks, and each pair of blocks is a task.
BLOCK = 2048
BLOCK_GRAMS = 4_000_000


def gram_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """The sorted hashes of each text's distinct n-grams, A-Z in lower case. A text of fewer
    words has its whole sequence as its only n-gram; without words the set is empty."""
    codes, bounds, vocabulary = coded([t.lower() for t in texts])
    table = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in vocabulary), np.uint64, len(vocabulary))
    hashes = table[codes]
    docs = document_of(bounds)
    n = max(0, len(hashes) - words + 1)
    grams = gram_hashes(hashes, words)[:n].astype(np.int64) if n else np.zeros(0, np.int64)
    inside = docs[:n] == docs[words - 1 :][:n]
    grams, docs = grams[inside], docs[:n][inside]
    order = np.lexsort((grams, docs))
    grams, docs = grams[order], docs[order]
    new = np.ones(len(grams), dtype=bool)
    new[1:] = (grams[1:] != grams[:-1]) | (docs[1:] != docs[:-1])
    grams, docs = grams[new], docs[new]
    sets = np.split(grams, np.searchsorted(docs, np.arange(1, len(texts)))) if texts else []
    for i in np.flatnonzero((np.diff(bounds) > 0) & (np.diff(bounds) < words)).tolist():
        whole = b" ".join(texts[i].lower().split())
        sets[i] = np.array([xxhash.xxh3_64_intdigest(whole, seed=words)], dtype=np.uint64).astype(np.int64)
    return sets


def packed(docs: DataFrame, words: int, parts: int, id: str, text: str) -> DataFrame:
    """A row per document: ``rid, doc_id, digest`` of the text, ``same`` (digest of the set),
    ``n`` (its size) and ``again`` (how many of its n-grams occur in another document of its
    block); and rows of packed n-grams per block (``base``, its first document) and range: per
    n-gram 32 bits of its hash and the only document with it (or SEVERAL)."""
    source = sources(docs, id, text).withColumn("rid", F.monotonically_increasing_id())
    kind = source.schema["doc_id"].dataType.simpleString()
    names = ["base", "rid", "doc_id", "digest", "same", "n", "again", "part", "lows", "owners"]

    def block(got: pa.Table) -> Iterator[pa.RecordBatch]:
        texts = [bytes(t) for t in got["_utf8"].to_pylist()]
        sets = gram_sets(texts, words)
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        flat = np.concatenate(sets).view(np.uint64)
        owner = np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        new = np.concatenate([[True], flat[1:] != flat[:-1]]) if len(flat) else np.zeros(0, bool)
        begin = np.flatnonzero(new)
        times = np.diff(np.concatenate([begin, [len(flat)]]))
        several = np.repeat(times > 1, times)
        again = np.bincount(owner[several], minlength=len(sets))
        rid = got["rid"].combine_chunks()
        n = len(texts)
        base = rid[0].as_py()
        yield pa.RecordBatch.from_arrays([
            pa.array([base] * n, pa.int64()), rid, got["doc_id"].combine_chunks(), pa.array([hashlib.md5(t).digest() for t in texts], pa.binary()),
            pa.array([hashlib.md5(s.tobytes()).digest() for s in sets], pa.binary()), pa.array(sizes), pa.array(again, pa.int64()),
            pa.array(np.arange(n) % parts, pa.int32()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()),
        ], names=names)
        flat, owner = flat[begin], np.where(times > 1, SEVERAL, owner[begin]).astype(np.uint16)
        part = ((flat >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        lows = flat.astype(np.uint32)
        cuts = np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))
        full = np.flatnonzero(np.diff(cuts)).tolist()
        k = len(full)
        yield pa.RecordBatch.from_arrays([
            pa.array([base] * k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, got.schema.field("doc_id").type), pa.nulls(k, pa.binary()), pa.nulls(k, pa.binary()),
            pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.array(full, pa.int32()),
            pa.array([lows[cuts[i] : cuts[i + 1]].tobytes() for i in full], pa.binary()),
            pa.array([owner[cuts[i] : cuts[i + 1]].tobytes() for i in full], pa.binary()),
        ], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in gathered(batches, "_utf8", GATHER):
            for at in range(0, got.num_rows, ROWS):
                yield from block(got.slice(at, ROWS))

    schema = f"base long, rid long, doc_id {kind}, digest binary, same binary, n long, again long, part int, lows binary, owners binary"
    return source.mapInArrow(run, schema)


def seen_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by range. Documents pass; the packed n-grams of a range become, per block, its
    documents with n-grams that occur in other blocks (``owners``) and how many (``lows``)."""
    key, bases, lows, owners = None, [], [], []
    names = ["base", "rid", "doc_id", "digest", "same", "n", "again", "lows", "owners"]
    types: list[pa.DataType] = []

    def solved() -> pa.RecordBatch | None:
        if len(lows) < 2:
            return None
        low = np.concatenate(lows)
        order = np.argsort(low, kind="stable")
        ranked = low[order]
        same = ranked[1:] == ranked[:-1]
        hit = np.zeros(len(low), dtype=bool)
        hit[order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]] = True
        made, cuts = [], np.cumsum([len(x) for x in lows])[:-1]
        for base, owner, again in zip(bases, owners, np.split(hit, cuts)):
            owner = owner[again]
            found, times = np.unique(owner[owner != SEVERAL], return_counts=True)
            if len(found):
                made.append((base, times.astype(np.uint32).tobytes(), found.astype(np.uint16).tobytes()))
        if not made:
            return None
        base, times, found = zip(*made)
        empty = [pa.nulls(len(made), t) for t in types]
        return pa.RecordBatch.from_arrays([pa.array(base, pa.int64()), *empty, pa.array(times, pa.binary()), pa.array(found, pa.binary())], names=names)

    for batch in batches:
        types = [batch.schema.field(c).type for c in names[1:7]]
        held = batch.column("lows").is_valid()
        plain = batch.filter(pc.invert(held))
        if plain.num_rows:
            yield plain.select(names)
        some = batch.filter(held)
        for part, base, low, owner in zip(*[some.column(c).to_pylist() for c in ("part", "base", "lows", "owners")]):
            if part != key:
                if (made := solved()) is not None:
                    yield made
                key, bases, lows, owners = part, [], [], []
            bases.append(base)
            lows.append(np.frombuffer(low, dtype=np.uint32))
            owners.append(np.frombuffer(owner, dtype=np.uint16))
    if (made := solved()) is not None:
        yield made


def added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by block, packed counts before documents: each document's ``again`` with what
    all ranges have found."""
    key, more = None, np.zeros(0, np.int64)
    for batch in batches:
        kept, again = [], []
        columns = [batch.column(c).to_pylist() for c in ("base", "rid", "again", "lows", "owners")]
        for i, (base, rid, times, low, owner) in enumerate(zip(*columns)):
            if base != key:
                key, more = base, np.zeros(SEVERAL, dtype=np.int64)
            if rid is None:
                more[np.frombuffer(owner, dtype=np.uint16)] += np.frombuffer(low, dtype=np.uint32)
            else:
                kept.append(i)
                again.append(times + int(more[rid - base]))
        if kept:
            rows = batch.select(["rid", "doc_id", "digest", "same", "n"]).take(pa.array(kept))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(again, pa.int64())], names=[*rows.schema.names, "again"])


def counted(docs: DataFrame, words: int, id: str, text: str) -> DataFrame:
    """Per document ``rid, doc_id, digest, same, n, again``: how many n-grams of its set occur in
    another document (a few more may be counted: 32 bits and the range are compared)."""
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`").cast("string"))).alias("bytes")).first()["bytes"] or 0
    kind = docs.schema[id].dataType.simpleString()
    dealt = packed(docs, words, max(size // RANGE, RANGES), id, text).repartition("part").sortWithinPartitions("part")
    schema = f"base long, rid long, doc_id {kind}, digest binary, same binary, n long, again long"
    found = dealt.mapInArrow(seen_again, f"{schema}, lows binary, owners binary")
    blocks = found.repartition("base").sortWithinPartitions("base", F.col("rid").asc_nulls_first())
    return blocks.mapInArrow(added_up, schema.removeprefix("base long, "))


def may_lack(n, m, percent: int):
    """N-grams of a set of size ``n`` that a similar set of size ``m`` may lack."""
    return n + (-percent * (n + m)) // (100 + percent)


class Groups:
    """Which sets are connected so far."""

    def __init__(self):
        self.above: dict[int, int] = {}

    def top(self, x: int) -> int:
        above = self.above
        root = x
        while (up := above.get(root, root)) != root:
            root = up
        while x != root:
            above[x], x = root, above.get(x, x)
        return root

    def join(self, x: int, y: int) -> bool:
        a, b = self.top(x), self.top(y)
        if a == b:
            return False
        self.above[max(a, b)] = min(a, b)
        return True


def may_lack(n, m, percent: int):
    """N-grams of a set of size ``n`` that a similar set of size ``m`` may lack."""
    return n + (-percent * (n + m)) // (100 + percent)


class Tree:
    """A prefix tree of ordered sets, its paths kept in one array. Per node: where the n-grams that
    lead to it begin and how many they are, the size of the largest set below, one of the sets
    below if all are in one group (or MIXED), the sets that end here, and the nodes below."""

    def __init__(self, sets: int, grams: int):
        self.flat = np.zeros(grams, dtype=np.int32)
        self.used = 0
        self.start, self.size, self.most = (np.zeros(2 * sets + 1, dtype=np.int64) for _ in range(3))
        self.member = [MIXED]
        self.ends: list[list[tuple[int, int]]] = [[]]
        self.below: list[dict[int, int]] = [{}]

    def node(self, start: int, size: int, most: int, member: int) -> int:
        made = len(self.member)
        self.start[made], self.size[made], self.most[made] = start, size, most
        self.member.append(member)
        self.ends.append([])
        self.below.append({})
        return made

    def plant(self, grams: np.ndarray, rid: int, groups: Groups) -> None:
        """Store a set. Sets come from large to small, so the first one's size bounds a node's."""
        node, at, n, top = 0, 0, len(grams), groups.top(rid)
        while True:
            if self.member[node] != MIXED and groups.top(self.member[node]) != top:
                self.member[node] = MIXED
            if at == n:
                break
            first = int(grams[at])
            child = self.below[node].get(first)
            if child is None:
                rest = n - at
                self.flat[self.used : self.used + rest] = grams[at:]
                self.below[node][first] = node = self.node(self.used, rest, n, rid)
                self.used += rest
                break
            start, size = int(self.start[child]), int(self.size[child])
            width = min(size, n - at)
            same = self.flat[start : start + width] == grams[at : at + width]
            shared = width if same.all() else int(same.argmin())
            if shared < size:
                # The path parts here.
                upper = self.node(start, shared, int(self.most[child]), self.member[child])
                self.start[child], self.size[child] = start + shared, size - shared
                self.below[upper][int(self.flat[start + shared])] = child
                self.below[node][first] = child = upper
            node, at = child, at + shared
        self.ends[node].append((rid, n))

    def walk(self, grams: np.ndarray, held: np.ndarray, rid: int, percent: int, groups: Groups) -> None:
        """Connect a set with those in the tree, none smaller, that are similar to it, level by
        level; sets known to be connected with it are left out. ``held`` marks its n-grams."""
        n = len(grams)
        largest, mine, top = n * 100 // percent, may_lack(n, n, percent), groups.top(rid)
        front, depth, shared = [0], np.zeros(1, np.int64), np.zeros(1, np.int64)
        while front:
            below: list[int] = []
            above: list[int] = []
            for place, node in enumerate(front):
                member = self.member[node]
                if member != MIXED and groups.top(member) == top:
                    continue
                for other, size in self.ends[node]:
                    if (100 + percent) * int(shared[place]) >= percent * (n + size) and groups.join(rid, other):
                        top = groups.top(rid)
                below.extend(self.below[node].values())
                above.extend([place] * len(self.below[node]))
            if not below:
                return
            at, up = np.array(below), np.array(above)
            lens = self.size[at]
            ends = np.cumsum(lens)
            passing = self.flat[ranges(self.start[at], lens)]
            both = shared[up] + np.add.reduceat(held[passing], ends - lens)
            deep = depth[up] + lens
            # Of the n-grams up to a node all but the shared ones lack on either side.
            passed = np.searchsorted(grams, passing[ends - 1], "right")
            good = (passed - both <= mine) & (deep - both <= may_lack(np.minimum(self.most[at], largest), n, percent))
            front, depth, shared = at[good].tolist(), deep[good], both[good]


def linked(rids: list[int], sets: list[np.ndarray], percent: int, groups: Groups) -> None:
    """Connect similar sets. Every set seeks larger ones in the tree before it is stored itself."""
    flat = np.concatenate(sets)
    _, place, times = np.unique(flat, return_inverse=True, return_counts=True)
    rank = np.empty(len(times), dtype=np.int32)
    rank[np.argsort(-times, kind="stable")] = np.arange(len(times), dtype=np.int32)
    ordered = [np.sort(part) for part in np.split(rank[place], np.cumsum([len(s) for s in sets])[:-1])]
    held = np.zeros(len(times), dtype=np.int64)
    tree = Tree(len(sets), len(flat))
    for i in sorted(range(len(rids)), key=lambda i: (len(sets[i]), rids[i]), reverse=True):
        held[ordered[i]] = 1
        tree.walk(ordered[i], held, rids[i], percent, groups)
        held[ordered[i]] = 0
        tree.plant(ordered[i], rids[i], groups)


def compare_groups(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Compare the sets of each group; rows come in the order of group and blocks. Links lead
    from each set to the smallest it is connected with here."""
    key, rows = None, {}

    def done() -> pa.RecordBatch | None:
        groups = Groups()
        for rid, (_, known) in rows.items():
            groups.join(rid, known)
        if len({groups.top(rid) for rid in rows}) < 2:
            return None
        linked(list(rows), [r[0] for r in rows.values()], percent, groups)
        links = [(rid, groups.top(rid)) for rid in rows if groups.top(rid) != rid]
        if not links:
            return None
        a, b = zip(*links)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    names = ("grp", "left", "right", "rid", "known", "grams")
    for batch in batches:
        *columns, lists = [batch.column(c) for c in names]
        flat, cuts = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
        for i, (group, left, right, rid, known) in enumerate(zip(*[c.to_pylist() for c in columns])):
            if key != (group, left, right):
                if (made := done()) is not None:
                    yield made
                key, rows = (group, left, right), {}
            rows[rid] = (flat[cuts[i] : cuts[i + 1]].copy(), known)
    if (made := done()) is not None:
        yield made


def grouped(sets: DataFrame, percent: int) -> DataFrame:
    """Groups of sets (``grp, rid, n, grams``) that share one of their rarest n-grams, taken
    among the sets of their present group: ``rid, grp`` of all that are in one with others.

    Sets with too few n-grams that come again in the group are in none. The rarest n-grams
    are so many that a similar set shares one of them; those of no other set need no look.
    """
    each = sets.select("grp", "rid", "n", F.explode("grams").alias("gram"))
    often = each.groupBy("grp", "gram").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    least = F.ceil(F.lit(percent) * F.col("n") / 100)
    # Of the rarest n - least + 1 n-grams those that occur once are left out.
    tails = written(
        each.join(often, ["grp", "gram"]).groupBy("grp", "rid", "n").agg(F.sort_array(F.collect_list(F.struct("times", "gram"))).alias("all"))
        .where(F.size("all") >= least)
        .select("grp", "rid", F.explode(F.slice("all", F.lit(1), (F.size("all") - least + 1).cast("int"))["gram"]).alias("gram")), "tails",
    )
    first = tails.groupBy("grp", "gram").agg(F.min("rid").alias("b"))
    links = tails.join(first, ["grp", "gram"]).select(F.col("rid").alias("a"), "b").where("a != b").distinct()
    found = components(links)
    dropped(tails)
    return found.select(F.col("node").alias("rid"), F.col("component").alias("grp")).unionByName(
        found.select(F.col("component").alias("rid"), F.col("component").alias("grp")).distinct()
    )


def placed(sets: DataFrame, percent: int) -> DataFrame:
    """Sets (``rid, n, grams``) with the group in which they are to be compared and its number of
    blocks: groups that are too large are split as long as that makes them smaller."""
    ready, rest, before = None, sets.withColumn("grp", F.lit(0).cast("long")), None
    while True:
        groups = written(grouped(rest, percent), "groups")
        sized = rest.drop("grp").join(groups, "rid")
        sizes = sized.groupBy("grp").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("all"))
        blocks = F.ceil(F.greatest(F.col("size") / BLOCK, F.col("all") / BLOCK_GRAMS)).cast("int")
        held = sized.join(sizes.select("grp", blocks.alias("blocks")), "grp")
        left = written(held, "grouped")
        now = left.where("blocks > 1").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("grp").alias("groups")).first()
        if now["n"] == 0 or now == before:
            return left if ready is None else ready.unionByName(left.select(ready.columns))
        small = left.where("blocks = 1")
        ready = small if ready is None else ready.unionByName(small.select(ready.columns))
        rest, before = left.where("blocks > 1").select("rid", "n", "grams", "grp"), now


def true_links(sets: DataFrame, percent: int) -> DataFrame:
    """Links within groups of candidates. Large groups are cut to blocks: first each block is
    compared with itself and the first one; what this leaves unconnected is compared block
    by block."""
    cut = placed(sets, percent).withColumn("block", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int"))
    hub = F.when(F.col("block") == 0, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))
    first = cut.select("grp", F.lit(0).alias("left"), F.explode(hub).alias("right"), "rid", F.col("rid").alias("known"), "grams")

    def compared(at: DataFrame) -> DataFrame:
        dealt = at.repartition("grp", "left", "right").sortWithinPartitions("grp", "left", "right", "rid")
        return dealt.mapInArrow(lambda b: compare_groups(b, percent), "a long, b long")

    near = written(compared(first), "links")
    large = cut.where("blocks > 1")
    if large.isEmpty():
        return near
    known = large.join(components(near), F.col("rid") == F.col("node"), "left").withColumn("known", F.coalesce("component", "rid"))
    open_groups = known.groupBy("grp").agg((F.min("known") != F.max("known")).alias("open")).where("open").select("grp")
    pairs = F.filter(
        F.flatten(F.transform(F.sequence(F.lit(1), F.col("blocks") - 1), lambda other: F.array(
            F.struct(F.least("block", other).alias("left"), F.greatest("block", other).alias("right"))
        ))), lambda pair: (pair["left"] > 0) & (pair["left"] < pair["right"])
    )
    rest = known.join(open_groups, "grp").select("grp", "rid", "known", "grams", F.inline(F.array_distinct(pairs)))
    return near.unionByName(compared(rest.select("grp", "left", "right", "rid", "known", "grams")))


def whole_sets(docs: DataFrame, kinds: DataFrame, words: int, id: str, text: str) -> DataFrame:
    """The sets of the documents ``kinds`` (``rid, doc_id, digest``): ``rid, n, grams``."""
    keyed = sources(docs, id, text).withColumn("digest", digest("_utf8"))
    on = keyed["doc_id"].eqNullSafe(kinds["doc_id"]) & (keyed["digest"] == kinds["digest"])
    rows = keyed.join(kinds, on, "inner").select("rid", "_utf8").dropDuplicates(["rid"])

    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = gram_sets([bytes(t) for t in batch.column(1).to_pylist()], words)
        sizes = pa.array([len(s) for s in made], pa.int64())
        return pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(made, pa.list_(pa.int64()))], names=["rid", "n", "grams"])

    return by_batch(rows, sets, "rid long, n long, grams array<long>")


def similar(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Group documents whose sets have a Jaccard similarity of at least ``percent``:
    ``doc_id, n_shingles, component_id`` (the smallest id reachable by links).

    Documents without words, null texts among them, have empty sets and are linked with
    nothing: they are their own component. Equal sets are one set with several documents.
    N-grams are told apart by 64 bits of a hash. One row per input row; rows that repeat an id
    and a text are one document, null ids are one id, smaller than all others. An empty
    table gives no rows.
    """
    rows = written(counted(docs, words, id, text), "rows")
    # A similar set shares so many n-grams; equal sets share all.
    may = (F.col("n") > 0) & (100 * F.col("again") >= percent * F.col("n"))
    kinds = written(
        rows.where(may).groupBy("same", "n").agg(F.min(F.struct("rid", "doc_id", "digest")).alias("first"))
        .select("same", "first.rid", "first.doc_id", "first.digest", "n"), "kinds",
    )
    sets = written(whole_sets(docs, kinds.select("rid", "doc_id", "digest"), words, id, text), "sets")
    true = components(true_links(sets, percent))
    named = kinds.join(true, F.col("rid") == F.col("node"), "left").select("same", "n", F.coalesce("component", "rid").alias("part"))
    # The smallest id among all rows of the component, copies included.
    with_part = rows.select("rid", "doc_id", "same", "n").join(named, ["same", "n"], "left")
    least = with_part.where("part is not null").groupBy("part").agg(F.min(F.struct("doc_id"))["doc_id"].alias("component_id"))
    # Rows without a part have keys of their own, so that they don't meet in one task.
    spread = with_part.withColumn("key", F.coalesce("part", -1 - F.col("rid")))
    return spread.join(least.withColumnRenamed("part", "key"), "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("part").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
