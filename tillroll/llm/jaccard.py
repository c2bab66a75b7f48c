"""N-gram Jaccard join by a MinHash LSH forest.

1. Texts with equal word sequences form a *class*; everything below works on
   one text a class, so thousands of copies cost one row.
2. A class has a signature of :data:`DEEPEST` MinHash values for each of
   :data:`TREES` trees, taken from its word shingles.  The signatures of all
   trees are sorted once, by ranges of (tree, signature, class): neighbours in
   that order share the longest prefixes, so each tree is a prefix trie laid
   flat, and a node is a run of equal prefixes.  A run of any length spreads over
   as many partitions as it fills; runs that cross a border meet by their prefix.
3. Classes of a node are linked to its first class (never to each other); the
   components of the links at the shortest prefix are the candidate clusters.  The
   forest is first matched at the full depth: pairs of a cluster that
   share a whole signature of some tree are verified exactly.  Each link found
   has a similarity, hence a known chance to be met at any depth, so the found
   links say how many were missed.  While the recall so estimated is under the
   target, all prefixes are shortened to the longest that would reach it, and
   the pairs that meet only then are verified.  It ends at the latest at the depth
   at which a pair just at the threshold meets with the target recall
   (:func:`prefix_length`).
4. Verification intersects shingle sets of classes that meet in a node.  A
   cluster of more than :data:`BLOCK` classes is cut into blocks, or taken node
   by node where that copies fewer sets, and only nodes above the block size are
   cut; so a cluster of any size stays bounded in memory.  A pair is verified
   once: in the first tree in which it meets, at the depth at which it first
   does.  A task returns, for each class, the number of documents it is
   linked to, and a spanning forest of its links; pairs are never rows.

Shingles are ``n`` consecutive words (``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``
after lower-casing A-Z); a text of fewer words has one shingle, all of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bytesops import U64, column_bytes, mix, powers, slices, symbols, word_bytes, words
from .common import components, pieces, row_key, stored

WORDS = 5
THRESHOLD = 0.8
TREES = 16
DEEPEST = 6
VALUE = 2                                #: bytes kept of a MinHash value
RECALL = 0.9997
BLOCK = 1000
BRANCHES = 40_000                        #: sorted signatures of a task, about
_LINKS = "class binary, head binary, depth int, fresh boolean, border binary"
_SEEDS = np.random.default_rng(64).integers(0, 1 << 63, (TREES, DEEPEST), dtype=U64) * U64(2) + U64(1)


def prefix_length(threshold: float, recall: float, trees: int = TREES, deepest: int = DEEPEST) -> int:
    """The longest prefix at which a pair at the threshold meets in one of the
    tries with chance ``recall`` (1 if none does)."""
    length = deepest
    while length > 1 and 1 - (1 - threshold ** length) ** trees < recall:
        length -= 1
    return length


def meeting_chance(similarity, depth: int, trees: int = TREES):
    """The chance that a pair shares a prefix of ``depth`` values in some tree."""
    return 1 - (1 - similarity ** depth) ** trees


def row_shingles(h: np.ndarray, edges: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all rows in order, and where each row's begin."""
    many = np.diff(edges)
    if len(h) >= n:
        s = h[:len(h) - n + 1] * symbols()[0]
        for k in range(1, n):
            s = s + h[k:len(h) - n + 1 + k] * symbols()[k]
        inside = np.zeros(len(s) + 1, np.int32)
        low, high = edges[:-1][many >= n], edges[1:][many >= n] - n + 1
        np.add.at(inside, low, 1)
        np.add.at(inside, high, -1)
        s = mix(s)
        keep = np.cumsum(inside)[:-1] > 0
    else:
        s, keep = np.zeros(0, U64), np.zeros(0, bool)
    short = np.flatnonzero((many > 0) & (many < n))
    counts = np.where(many >= n, many - n + 1, (many > 0).astype(np.int64))
    starts = np.concatenate([[0], np.cumsum(counts)])
    out = np.empty(starts[-1], U64)
    from_short = np.zeros(starts[-1], bool)
    from_short[starts[short]] = True
    out[~from_short] = s[keep]
    for r in short:
        own = h[edges[r]:edges[r + 1]]
        out[starts[r]] = mix(np.sum(own * symbols()[8:8 + len(own)], keepdims=True, dtype=U64))[0]
    return out, starts


def row_classes(h: np.ndarray, edges: np.ndarray) -> list[bytes | None]:
    """128 bits of each row's word sequence; None without words."""
    halves = []
    for twist in (U64(0), U64(0xA0761D6478BD642F)):
        forward, back = powers(len(h) + 1)
        total = np.concatenate([np.zeros(1, U64), np.cumsum(mix(h ^ twist) * forward[:-1])])
        halves.append(mix((total[edges[1:]] - total[edges[:-1]]) * back[edges[:-1]] + np.diff(edges).astype(U64)))
    both = np.column_stack(halves)
    return [both[i].tobytes() if n else None for i, n in enumerate(np.diff(edges))]


def signatures(shingles: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each row its MinHash values, ``(row, tree, level)``: 16 bits each,
    high byte first, so that bytes sort as values do (zero without shingles)."""
    full = np.flatnonzero(np.diff(starts) > 0)
    out = np.zeros((len(starts) - 1, TREES, DEEPEST), ">u2")
    if len(full):
        at = starts[:-1][full]
        for tree in range(TREES):
            for level in range(DEEPEST):
                out[full, tree, level] = mix(np.minimum.reduceat(shingles * _SEEDS[tree, level], at)) >> U64(48)
    return out


def prefixes(values: np.ndarray, depth: int) -> np.ndarray:
    """64 bits of the first ``depth`` values of each signature (last axis)."""
    node = np.zeros(values.shape[:-1], U64)
    for level in range(depth):
        node = mix(node * symbols()[level] + values[..., level].astype(U64) + U64(1))
    return node


def _fixed(values: np.ndarray, width: int) -> pa.Array:
    """Rows of ``width`` bytes as a binary column."""
    data = np.ascontiguousarray(values).tobytes()
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(data) // width, [None, pa.py_buffer(data)]).cast(pa.binary())


def _signed(docs: DataFrame, n: int) -> DataFrame:
    """``key, doc_id, class, signature`` of each row."""
    def sign(batches):
        for batch in batches:
            data, off = column_bytes(batch.column("text"))
            for low, high, part, at in slices(data, off):
                h, edges = words(part, at, word_bytes("term"))
                shingles, starts = row_shingles(h, edges, n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(low, high - low), batch.column("doc_id").slice(low, high - low),
                     pa.array(row_classes(h, edges), pa.binary()),
                     _fixed(signatures(shingles, starts), TREES * DEEPEST * VALUE)],
                    names=["key", "doc_id", "class", "signature"])

    return docs.mapInArrow(sign, f"key long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, class binary, signature binary")


def _branch(tree, depth: int = DEEPEST):
    """The first ``depth`` values of the signature in a tree."""
    return F.substring(F.col("signature"), tree * (DEEPEST * VALUE) + 1, F.lit(depth * VALUE))


def sorted_tries(classes: DataFrame, shortest: int) -> DataFrame:
    """The nodes of two classes or more of all tries, as links ``(class, head,
    depth, fresh)`` for each depth down to ``shortest``; ``fresh`` says that the
    class opens a branch of the node which the next deeper prefix doesn't join."""
    depths = range(shortest, DEEPEST + 1)

    def runs(batches):
        def links(a, b, depth, fresh, border=None):
            return pa.RecordBatch.from_arrays(
                [_fixed(a, 16), _fixed(b, 16), pa.array(np.full(len(a), depth, np.int32)), pa.array(fresh, pa.bool_()),
                 pa.nulls(len(a), pa.binary()) if border is None else pa.array(border, pa.binary())],
                names=["class", "head", "depth", "fresh", "border"])

        def border(heads, row):
            for d in depths:
                yield links(heads[d], heads[d], d, [True], [row[:1 + d * VALUE].tobytes()])

        before, heads = None, {}
        for batch in batches:
            if not batch.num_rows:
                continue
            trees = batch.column("tree").to_numpy(zero_copy_only=False).astype(np.uint8)
            branch = column_bytes(batch.column("branch"))[0].reshape(len(trees), -1)
            names = column_bytes(batch.column("class"))[0].reshape(len(trees), 16)
            rows = np.column_stack([trees, branch])
            opening = before is None
            last = rows[:1] if opening else before
            same = np.logical_and.accumulate(rows == np.concatenate([last, rows[:-1]]), axis=1)
            shared = {d: same[:, d * VALUE] for d in depths}
            for d in depths:
                joined = shared[d].copy()
                if opening:
                    joined[0] = False
                at = np.maximum.accumulate(np.where(joined, -1, np.arange(len(rows))))
                head = names[at]
                if not opening:
                    head[at < 0] = heads[d]
                some = np.flatnonzero(joined)
                if len(some):
                    fresh = ~shared[d + 1][some] if d < DEEPEST else np.ones(len(some), bool)
                    yield links(names[some], head[some], d, fresh)
                heads[d] = head[-1:].copy()
            if opening:
                yield from border({d: names[:1] for d in depths}, rows[0])
            before = rows[-1:].copy()
        if before is not None:
            yield from border(heads, before[0])

    laid = (classes.select("class", "signature", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
            .select("tree", _branch(F.col("tree")).alias("branch"), "class")
            .repartitionByRange(pieces(TREES * classes.count(), BRANCHES), "tree", "branch", "class").sortWithinPartitions("tree", "branch", "class"))
    found = stored(laid.mapInArrow(runs, _LINKS), "forest")
    ends = found.where("border is not null").select("class", "depth", "border").distinct()       # two a partition and depth
    first = ends.groupBy("depth", "border").agg(F.min("class").alias("head"))
    crossing = (ends.join(first, ["depth", "border"]).where("class <> head")
                .select("class", "head", "depth", F.lit(True).alias("fresh")))
    return found.where("border is null and class <> head").select("class", "head", "depth", "fresh").unionByName(crossing)


def _shingle_sets(texts: DataFrame, n: int) -> DataFrame:
    """``class, copies, signature, shingles`` of ``texts(class, copies,
    signature, text)``; repeated rows of a text count once."""
    def shingled(batches):
        for batch in batches:
            data, off = column_bytes(batch.column("text"))
            keep, out = [], []
            names = batch.column("class").to_pylist()
            for low, high, part, at in slices(data, off):
                h, edges = words(part, at, word_bytes("term"))
                s, starts = row_shingles(h, edges, n)
                for r, own in zip(range(low, high), row_classes(h, edges), strict=True):
                    if own == names[r]:
                        keep.append(r)
                        out.append(np.unique(s[starts[r - low]:starts[r - low + 1]]).tobytes())
            some = batch.drop_columns(["text"]).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*some.columns, pa.array(out, pa.binary())], names=[*some.schema.names, "shingles"])

    return texts.mapInArrow(shingled, "class binary, copies long, signature binary, shingles binary").dropDuplicates(["class"])


def _groups(cluster: DataFrame, sets: DataFrame, depth: int) -> DataFrame:
    """The groups in which ``cluster(node, root)`` is verified, ``part, tree, i,
    j, block`` beside the columns of ``sets``: a cluster, or where that copies
    fewer sets its nodes (``tree`` is -1 for a cluster), in pairs of blocks."""
    member = cluster.select(F.col("node").alias("class"), F.col("root").alias("cluster")).join(sets, "class")
    blocks = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
    sizes = cluster.groupBy(F.col("root").alias("cluster")).agg(F.count(F.lit(1)).alias("size"))
    large = stored(sizes.where(F.col("size") > BLOCK), "large-clusters")
    whole = member.join(sizes.withColumn("blocks", blocks), "cluster").select("*", F.lit(-1).alias("tree"), F.col("cluster").alias("part"))
    if not large.isEmpty():
        tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
        place = F.concat(F.unhex(F.lpad(F.hex("tree"), 2, "0")), _branch(F.col("tree"), depth))
        of_large = member.join(large.select("cluster"), "cluster", "left_semi")
        nodes = (of_large.select("cluster", "signature", tree).groupBy("cluster", place.alias("part"))
                 .agg(F.count(F.lit(1)).alias("size")).where("size > 1"))
        nodes = stored(nodes.withColumn("blocks", blocks), "large-nodes")
        cost = nodes.groupBy("cluster").agg(F.sum(F.col("size") * F.col("blocks")).alias("cost"))
        split = stored(large.join(cost, "cluster").where(F.col("cost") < F.col("size") * blocks).select("cluster"), "split-clusters")
        by_node = (of_large.join(split, "cluster", "left_semi").select("*", tree).withColumn("part", place)
                   .join(nodes, ["cluster", "part"]))
        whole = whole.join(split, "cluster", "left_anti").unionByName(by_node)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    return (whole.withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")).select("*", other)
            .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
            .select("part", "tree", "i", "j", "block", "class", "copies", "signature", "shingles"))


def _verified(members: DataFrame, threshold: float, depth: int, before: int, depths: list[int]) -> DataFrame:
    """``(class, linked, root, links, unseen)`` of :func:`_groups`, from the
    pairs that meet at ``depth`` and not at ``before``: a row for each class that
    has links in the group; ``links`` counts those on which it comes first,
    ``unseen`` estimates for each of ``depths`` how many like them don't meet."""
    def verify(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        names = table["class"].to_pylist()
        block, copies = table["block"].to_numpy(), table["copies"].to_numpy()
        values = column_bytes(table["signature"])[0].view(">u2").reshape(-1, TREES, DEEPEST)
        nodes = prefixes(values, depth)
        deeper = prefixes(values, before) if before <= DEEPEST else None
        tree = table["tree"][0].as_py()
        i, j = table["i"][0].as_py(), table["j"][0].as_py()
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        sets = [np.frombuffer(b, U64) for b in table["shingles"].to_pylist()]
        size = np.array([len(s) for s in sets])
        meet = np.full((len(left), len(right)), tree >= 0)
        for t in range(TREES):
            same = nodes[left, t][:, None] == nodes[right, t][None, :]
            if tree < 0:
                meet |= same
            elif t < tree:
                meet &= ~same
        if deeper is not None:
            for t in range(TREES):
                meet &= deeper[left, t][:, None] != deeper[right, t][None, :]
        meet &= (left[:, None] < right[None, :]) if i == j else True
        big, small = np.maximum(size[left][:, None], size[right][None, :]), np.minimum(size[left][:, None], size[right][None, :])
        meet &= small >= threshold * big - 1e-9
        linked, links, unseen = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64), np.zeros((len(names), len(depths)))
        a, b = np.nonzero(meet)
        if len(a):
            a, b = left[a], right[b]
            if len(a) <= 4 * len(names):
                both = np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(a, b, strict=True)])
            else:
                rows = np.unique(np.concatenate([a, b]))
                shared, where = np.unique(np.concatenate([sets[r] for r in rows]), return_inverse=True)
                often = np.bincount(where) > 1
                where = np.where(often, np.cumsum(often) - 1, -1)[where]
                owner = np.repeat(rows, size[rows])
                product = np.zeros((len(names), len(names)), np.float32)
                for low in range(0, int(often.sum()), 4096):
                    pick = (where >= low) & (where < low + 4096)
                    held = np.zeros((len(names), 4096), np.float32)
                    held[owner[pick], where[pick] - low] = 1
                    product += held @ held.T
                both = product[a, b].astype(np.int64)
            union = size[a] + size[b] - both
            yes = both >= threshold * union - 1e-9
            a, b, similar = a[yes], b[yes], both[yes] / union[yes]
            np.add.at(linked, a, copies[b])
            np.add.at(linked, b, copies[a])
            np.add.at(links, a, 1)
            for column, d in enumerate(depths):
                np.add.at(unseen[:, column], a, 1 / meeting_chance(similar, d) - 1)
        root = np.arange(len(names))
        while len(a):
            low = np.minimum(root[a], root[b])
            settled = root.copy()
            np.minimum.at(root, root[a], low)
            np.minimum.at(root, root[b], low)
            root = root[root]
            if (root == settled).all() and (root[a] == root[b]).all():
                break
        some = np.flatnonzero(linked)
        return pa.table({"class": pa.array([names[x] for x in some], pa.binary()), "linked": linked[some],
                         "root": pa.array([names[root[x]] for x in some], pa.binary()), "links": links[some],
                         "unseen": pa.array(list(unseen[some]), pa.list_(pa.float64()))})

    return members.groupBy("part", "i", "j").applyInArrow(verify, "class binary, linked long, root binary, links long, unseen array<double>")


def forest_links(classes: DataFrame, texts: DataFrame, n: int, threshold: float, recall: float) -> DataFrame:
    """``(class, linked, root)`` of all verified links of ``classes(class,
    copies, key, signature)``, whose texts are ``texts(key, text)``: the forest is
    matched at its full depth and then at shorter prefixes, until the recall
    estimated from the links found reaches ``recall``, or a pair at the
    threshold meets with that chance."""
    shortest = prefix_length(threshold, recall)
    depths = list(range(shortest, DEEPEST + 1))
    links = sorted_tries(classes, shortest)
    some = links.where(F.col("depth") == shortest)
    met = some.select("class").unionByName(some.select(F.col("head").alias("class"))).distinct()
    asked = classes.join(met, "class", "left_semi")
    sets = stored(_shingle_sets(asked.join(texts, "key").select("class", "copies", "signature", "text"), n), "shingle-sets")
    cluster = stored(components(some.select(F.col("class").alias("a"), F.col("head").alias("b")), "candidate-links"), "clusters")
    found, before, depth = None, DEEPEST + 1, DEEPEST
    while True:
        fresh = links.where(F.col("depth").between(depth, before - 1) & F.col("fresh")).select(F.col("class").alias("node")).distinct()
        here = cluster.join(cluster.join(fresh, "node").select("root").distinct(), "root", "left_semi").select("node", "root")
        new = stored(_verified(_groups(here, sets, depth), threshold, depth, before, depths), "links")
        found = new if found is None else found.unionByName(new)
        seen, *unseen = found.agg(F.coalesce(F.sum("links"), F.lit(0)),
                                  *[F.coalesce(F.sum(F.col("unseen")[k]), F.lit(0.0)) for k in range(len(depths))]).first()
        left = [d for d in depths if d <= depth and seen and
                seen >= recall * (seen + unseen[d - shortest] + 1 / meeting_chance(threshold, d) - 1)]
        before, depth = depth, max(left, default=shortest)
        if depth == before:
            break
    return found.select("class", "linked", "root")


def near_duplicates(docs: DataFrame, n: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row for each row of ``docs(doc_id, text)``: ``key`` (64 bits of the
    row), ``doc_id``, ``group_root`` (the group of documents joined by links;
    null without words), ``class_id`` (the group's smallest doc_id; its own
    without words) and ``n_links`` (other documents at or above the threshold,
    copies included).

    Null and empty texts, or texts without words, have no links.  Repeated
    rows are copies of each other and linked.  An empty table gives no rows.
    Texts of any length are read whole; other columns are not read."""
    keyed = docs.select("doc_id", "text").withColumn("key", row_key("doc_id", "text"))
    signed = stored(_signed(keyed.select("key", "doc_id", "text"), n), "signatures")
    classes = stored(signed.where("class is not null").groupBy("class")
                     .agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("key", "signature")).alias("one"))
                     .select("class", "copies", "one.key", "one.signature"), "classes")
    found = forest_links(classes, keyed.select("key", "text"), n, threshold, recall)
    groups = components(found.select(F.col("class").alias("a"), F.col("root").alias("b")), "verified-links")
    linked = found.groupBy("class").agg(F.sum("linked").alias("linked"))
    # Both sides of the next two joins are read from files, so that a class or group with a third of all rows can be split.
    of_class = stored(classes.select("class", "copies").join(linked, "class", "left")
                .join(groups.select(F.col("node").alias("class"), "root"), "class", "left")
                .select("class", F.coalesce("root", "class").alias("group_root"),
                        (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).cast("long").alias("n_links")), "class-links")
    rows = stored(signed.select("key", "doc_id", "class").join(of_class, "class", "left"), "near-duplicates")
    first = stored(rows.where("group_root is not null").groupBy("group_root").agg(F.min("doc_id").alias("class_id")), "group-ids")
    return (rows.join(first, "group_root", "left")
            .select("key", "doc_id", "group_root", F.when(F.col("group_root").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))


def one_of_each(docs: DataFrame, n: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each group does:
    that of the smallest doc_id (nulls last), one row if it is repeated.
    Documents without words stay.  All columns are kept."""
    groups = stored(near_duplicates(docs, n, threshold, recall), "groups")
    winner = (groups.where("group_root is not null").groupBy("group_root")
              .agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")).alias("w")).select(F.col("w.key").alias("__winner")))
    alone = groups.where("group_root is null").select(F.col("key").alias("__winner"))
    rows = docs.withColumn("__winner", row_key("doc_id", "text"))
    place = F.row_number().over(Window.partitionBy("__winner").orderBy("__winner"))
    kept = rows.join(winner.distinct(), "__winner").withColumn("__winner_row", place).where("__winner_row = 1").drop("__winner_row")
    return kept.unionByName(rows.join(alone.distinct(), "__winner", "left_semi")).select(*docs.columns)
