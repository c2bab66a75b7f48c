"""Merkle manifest of a dataset with Octopus multiproofs.

1. Every row is a leaf: a digest of its fields.  The leaves of a group (one
   tree each) ascend by id; a range partitioning numbers them, so that a group
   with a third of all rows, or an id that repeats, spans many tasks.
2. Every :data:`FAN` consecutive nodes become their digest.  A task holds a
   block of consecutive nodes and derives :data:`DEPTH` levels;
   the block tops are the next round's nodes, until each tree has one node,
   its *subroot*.  The subroots, by group, are the leaves of one more tree,
   whose last node is the *root*.
3. A proof is a leaf's siblings, level by level up to the root.  A partition of
   leaves first computes which coordinates its proofs need and its own leaves
   cannot give (the smallest union: level by level the children of all parents
   on a path, less the nodes on a path), fetches those once, derives the
   interior nodes that its leaves share, and expands the single proofs from
   them without any further reading.

A digest is the lowercase hex SHA-256; inputs are concatenated, digests as hex
text.  A field is ``-`` if null, else its UTF-8 byte count, ``:`` and its value.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lower_ascii, pieces, stored

FAN = 8
DEPTH = 4                       # levels that one task derives, from FAN ** DEPTH consecutive nodes
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ROOT_TREE = ""                  # the tree of the subroots; groups are "-" (null) or "=" and their name


def field(c: Column | str) -> Column:
    """A field as its digest reads it."""
    text = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(fields: Sequence[Column | str]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in fields]).cast("binary"), 256)


def tree_name(group: Column | str) -> Column:
    """Names whose byte order is the groups' order, null first."""
    return F.coalesce(F.concat(F.lit("="), F.col(group) if isinstance(group, str) else group), F.lit("-"))


def heights(n: int) -> list[int]:
    """Nodes on each level of a tree of ``n`` leaves, up to the single one."""
    out = [n]
    while out[-1] > 1:
        out.append(-(-out[-1] // FAN))
    return out


def derive(known: dict[int, bytes], missing: dict[int, bytes]) -> tuple[dict[int, bytes], dict[int, bytes]]:
    """The next level: ``parent -> its run of digests`` and ``parent -> its
    digest`` from the nodes on a path and the fetched ones."""
    runs: dict[int, list[bytes]] = {}
    for at in sorted([*known, *missing]):
        runs.setdefault(at // FAN, []).append(known[at] if at in known else missing[at])
    joined = {p: b"".join(run) for p, run in runs.items()}
    return joined, {p: sha256(run).hexdigest().encode() for p, run in joined.items()}


def missing_nodes(at: np.ndarray, n: int) -> list[tuple[int, np.ndarray]]:
    """The Octopus step: for leaves ``at`` of a tree of ``n``, the coordinates
    (level, places) that their proofs need and that they cannot derive."""
    out, at = [], np.unique(at)
    for level, wide in enumerate(heights(n)[:-1]):
        parents = np.unique(at // FAN)
        children = (parents[:, None] * FAN + np.arange(FAN)[None, :]).ravel()
        children = children[children < wide]
        out.append((level, np.setdiff1d(children, at, assume_unique=True)))
        at = parents
    return [(level, places) for level, places in out if len(places)]


@dataclass
class Manifest:
    """``leaves(tree, at, n, leaf, *row)``: places in the trees; ``nodes(tree,
    level, at, digest)``: interior nodes and subroots; ``trees(tree, n, at)``:
    leaves of each group and its place among the groups; ``root``: null if there
    are no rows; ``depth``: levels above the leaves that one partition derives."""
    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame
    groups: int
    root: str | None
    depth: int


def _numbered(leaves: DataFrame, order: Sequence[str], rows: int, block: int) -> DataFrame:
    """``leaves`` with ``at``, the place in its tree (from 0), and ``n``, the
    tree's leaves.  Rows that tie in all of ``order`` are equal; any order of
    them gives the same trees, so a number spreads them over the tasks."""
    given = leaves.columns
    sort = ["tree", *order, "__spread"]
    ranged = (leaves.withColumn("__spread", F.monotonically_increasing_id())
              .repartitionByRange(pieces(rows, 8 * block, 2), *sort).sortWithinPartitions(*sort)
              .withColumn("__m", F.monotonically_increasing_id())
              .select(*given, F.shiftright("__m", 33).alias("__part"), "__m"))
    ranged = stored(ranged, "ordered-leaves")
    # a row for each part and tree: parts are of a chosen size, and most hold one tree
    spans = ranged.groupBy("tree", "__part").agg(F.count(F.lit(1)).alias("here"), F.min("__m").alias("first"))
    ahead = Window.partitionBy("tree").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(F.col("tree").alias("__tree"), F.col("__part").alias("__p"),
                         (F.coalesce(F.sum("here").over(ahead), F.lit(0)) - F.col("first")).alias("shift"),
                         F.sum("here").over(Window.partitionBy("tree")).alias("n"))
    return (ranged.join(stored(spans, "leaf-spans"), (F.col("tree") == F.col("__tree")) & (F.col("__part") == F.col("__p")))
            .select(*given, (F.col("__m") + F.col("shift")).alias("at"), "n"))


def _block_levels(base: int, depth: int):
    """Derive up to ``depth`` levels above the block's nodes of level ``base``."""
    def levels(table: pa.Table) -> pa.Table:
        wide = heights(table["n"][0].as_py())
        nodes = dict(zip(table["at"].to_pylist(), (d.encode() for d in table["digest"].to_pylist()), strict=True))
        out = []
        for level in range(base + 1, min(base + depth, len(wide) - 1) + 1):
            _, nodes = derive(nodes, {})
            out += [(level, at, d.decode()) for at, d in nodes.items()]
        size = len(out)
        return pa.table({"tree": pa.array([table["tree"][0].as_py()] * size, pa.string()), "n": pa.array([table["n"][0].as_py()] * size, pa.int64()),
                         "level": pa.array([o[0] for o in out], pa.int32()), "at": pa.array([o[1] for o in out], pa.int64()),
                         "digest": pa.array([o[2] for o in out], pa.string())})
    return levels


def _interior(leaves: DataFrame, most: int, depth: int) -> list[DataFrame]:
    """Interior nodes above ``leaves(tree, at, n, digest)`` in rounds of
    ``depth`` levels; ``most`` is the largest tree."""
    found, nodes, base = [], leaves, 0
    while base < len(heights(most)) - 1:
        block = nodes.withColumn("__block", F.floor(F.col("at") / F.lit(FAN ** depth))).groupBy("tree", "__block")
        derived = stored(block.applyInArrow(_block_levels(base, depth), "tree string, n long, level int, at long, digest string"), "tree-nodes")
        found.append(derived)
        base += depth
        nodes = derived.where(F.col("level") == base)
    return found


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def build(rows: DataFrame, fields: Sequence[str] = FIELDS, group: str = "lang", order: str = "doc_id",
          changed: Column | None = None, depth: int = DEPTH) -> Manifest:
    """The manifest of ``rows``: one tree for each value of ``group`` (null is
    one), its leaves by ``order`` (null first, equal ids by digest), and the
    tree of the subroots.  With ``changed`` (another digest for some rows, else
    null) the leaves carry it as ``other``.

    Null fields and null ids are digested as ``-``; empty texts and texts of
    any length are digested whole, inside Spark; repeated rows are leaves of
    equal digest.  No rows give no nodes and a null root.  Other columns
    are not read."""
    spark = rows.sparkSession
    leaves = stored(rows.select(tree_name(group).alias("tree"), F.col(order).alias("id"), leaf_digest(fields).alias("leaf"),
                                (F.lit(None).cast("string") if changed is None else changed).alias("other")), "leaves")
    leaves = stored(_numbered(leaves, ["id", "leaf"], leaves.count(), FAN ** depth), "manifest-leaves")
    trees = stored(leaves.groupBy("tree").agg(F.max("n").alias("n")), "trees")
    groups, most = trees.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0))).first()
    none = spark.createDataFrame([], "tree string, n long, level int, at long, digest string")
    if not groups:
        return Manifest(leaves, none, trees.withColumn("at", F.lit(0).cast("long")), 0, None, depth)
    digests = leaves.select("tree", "at", "n", F.col("leaf").alias("digest"))
    inner = [none, *_interior(digests, most, depth)]
    # A tree of n > 1 leaves ends on the one level that has a single node, at place 0.
    top = _union(inner).where("at = 0").groupBy("tree").agg(F.max_by("digest", "level").alias("digest"))
    single = digests.where("n = 1").select("tree", "digest")
    subroots = stored(top.unionByName(single).select(F.lit(ROOT_TREE).alias("tree"), F.col("tree").alias("name"), "digest"), "subroots")
    placed = stored(_numbered(subroots, ["name"], groups, FAN ** depth), "manifest-subroots")
    upper = _interior(placed.select("tree", "at", "n", "digest"), groups, depth)
    last = _union(upper).orderBy(F.desc("level")).select("digest").first() if upper else placed.select("digest").first()
    nodes = _union([*inner, *upper, placed.select("tree", "n", F.lit(0).alias("level"), "at", "digest")])
    trees = stored(trees.join(placed.select(F.col("name").alias("tree"), "at", F.col("digest").alias("subroot")), "tree"), "manifest-trees")
    return Manifest(leaves, nodes, trees, groups, last[0], depth)


def _requests(batches: Iterator[pa.RecordBatch], groups: int, whole: bool, size: int) -> Iterator[pa.RecordBatch]:
    """Coordinates to fetch for each partition of leaves."""
    for batch in batches:
        for row in batch.to_pylist():
            at = (np.arange(row["block"] * size, min(row["n"], (row["block"] + 1) * size)) if whole
                  else np.array(row["places"], np.int64))
            asked = [(row["tree"], *m) for m in missing_nodes(at, row["n"])]
            asked += [(ROOT_TREE, *m) for m in missing_nodes(np.array([row["place"]]), groups)]
            many = [len(m) for _, _, m in asked]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["tree"]] * sum(many), pa.string()), pa.array([row["block"]] * sum(many), pa.int64()),
                 pa.array([t for (t, _, m) in asked for _ in m], pa.string()),
                 pa.array([level for (_, level, m) in asked for _ in m], pa.int32()),
                 pa.array(np.concatenate([np.zeros(0, np.int64), *[m for _, _, m in asked]]), pa.int64())],
                names=["owner", "block", "tree", "level", "at"])


def _expand(groups: int, root: str):
    """Proofs of one partition of leaves from its leaves and what it fetched."""
    def climb(path: dict[int, bytes], fetched: dict[int, dict[int, bytes]], levels: int):
        """Runs of digests by level and parent, and the last node."""
        runs = []
        for level in range(levels):
            run, path = derive(path, fetched.get(level, {}))
            runs.append(run)
        return runs, path

    def siblings(run: bytes, at: int) -> bytes:
        low = at % FAN * 64
        return run[:low] + run[low + 64:]

    def expand(leaves: pa.Table, found: pa.Table) -> pa.Table:
        fetched: dict[str, dict[int, dict[int, bytes]]] = {}
        for tree, level, at, digest in zip(*(found[c].to_pylist() for c in ("tree", "level", "at", "digest")), strict=True):
            fetched.setdefault(tree, {}).setdefault(level, {})[at] = digest.encode()
        n, place, tree = leaves["n"][0].as_py(), leaves["place"][0].as_py(), leaves["tree"][0].as_py()
        at, leaf = leaves["at"].to_pylist(), [d.encode() for d in leaves["leaf"].to_pylist()]
        own, shared = len(heights(n)) - 1, len(heights(groups)) - 1
        runs, top = climb(dict(zip(at, leaf, strict=True)), fetched.get(tree, {}), own)
        subroot = top[0]
        upper, last = climb({place: subroot}, fetched.get(ROOT_TREE, {}), shared)
        # The siblings above each node are those of all leaves below it: from the top down.
        above = b"".join(siblings(upper[level][place // FAN ** (level + 1)], place // FAN ** level) for level in range(shared))
        rest = {0: above}
        for level in range(own - 1, 0, -1):
            rest = {c: siblings(run, c) + rest[p] for p, run in runs[level].items() for c in range(p * FAN, p * FAN + len(run) // 64)}
        proofs, folded = [], []
        for a, d, other in zip(at, leaf, leaves["other"].to_pylist(), strict=True):
            proof = siblings(runs[0][a // FAN], a) + rest[a // FAN] if own else above
            proofs.append(sha256(proof).hexdigest())
            if other is None or other.encode() == d:
                folded.append(last[place // FAN ** shared].decode())
                continue
            node = other.encode()
            for levels, where in ((runs, a), (upper, place)):
                for run in levels:
                    low, r = where % FAN * 64, run[where // FAN]
                    node = sha256(r[:low] + node + r[low + 64:]).hexdigest().encode()
                    where //= FAN
            folded.append(node.decode())
        size = len(at)
        return pa.table({"id": leaves["id"], "leaf": leaves["leaf"], "subroot": pa.array([subroot.decode()] * size, pa.string()),
                         "root": pa.array([root] * size, pa.string()), "proof_sha256": pa.array(proofs, pa.string()),
                         "folded_root": pa.array(folded, pa.string()), "verified": pa.array([f == root for f in folded], pa.bool_())})
    return expand


def prove(manifest: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """Proofs of all leaves, or of the ``wanted`` rows of ``manifest.leaves``:
    ``id, leaf, subroot, root, proof_sha256`` (the digest of the siblings up to
    the root), ``folded_root`` (the root recomputed from ``other``, if it is
    not null, else from the leaf) and ``verified`` (that it is the root)."""
    whole, groups, size = wanted is None, manifest.groups, FAN ** manifest.depth
    id_type = manifest.leaves.schema["id"].dataType.simpleString()
    out = (f"id {id_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    if not groups:
        return manifest.leaves.sparkSession.createDataFrame([], out)
    in_tree = manifest.trees.select("tree", F.col("at").alias("place"))
    rows = ((manifest.leaves if whole else wanted).join(in_tree, "tree")
            .select("tree", "place", "id", "leaf", "other", "at", "n", F.floor(F.col("at") / F.lit(size)).cast("long").alias("block")))
    if whole:
        owners = manifest.trees.select("tree", F.col("at").alias("place"), "n",
                                       F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / F.lit(size)).cast("long"))).alias("block"))
    else:
        owners = rows.groupBy("tree", "block").agg(F.first("place").alias("place"), F.first("n").alias("n"), F.collect_set("at").alias("places"))
    asked = owners.mapInArrow(lambda b: _requests(b, groups, whole, size), "owner string, block long, tree string, level int, at long")
    nodes = manifest.nodes.select("tree", "level", "at", "digest")
    if not whole:     # proofs of all leaves never lack a leaf
        nodes = nodes.unionByName(manifest.leaves.select("tree", F.lit(0).alias("level"), "at", F.col("leaf").alias("digest")))
    fetched = asked.join(nodes, ["tree", "level", "at"]).select("owner", "block", "tree", "level", "at", "digest")
    fetched = stored(fetched, "fetched-nodes")
    return (rows.groupBy("tree", "block").cogroup(fetched.groupBy("owner", "block"))
            .applyInArrow(_expand(groups, manifest.root), out))


def tampered_leaf(fields: Sequence[str] = FIELDS, text: str = "text", when: Column | None = None) -> Column:
    """The digest of a row whose ``text`` has A-Z lower-cased; null where
    ``when`` doesn't hold."""
    digest = leaf_digest([lower_ascii(c).alias(c) if c == text else c for c in fields])
    return digest if when is None else F.when(when, digest)
