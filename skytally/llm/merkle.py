"""A Merkle manifest of a table, kept as a postorder append log.

Rows are leaves; per language they ascend by id and every ``FANOUT``
consecutive nodes become their hash until one is left, the subroot.  The
subroots, ordered by language, are hashed up to the root by the same rule.

* Numbers.  Leaves are sorted by a range partitioning; counts of each
  (partition, tree) give every leaf its number in its tree, so a language that
  holds most rows is spread over partitions like any other.
* Build.  An *aligned builder* owns ``FANOUT ** LEVELS`` consecutive nodes of one
  tree and writes the nodes above them in the order in which they are
  completed.  Builders of the next round own the tops of this round's.
* Positions.  In the log of a tree, a node is completed right after the last
  leaf below it and the nodes between.  Full subtrees of height k have
  ``1 + F + ... + F**k`` nodes, so the number of nodes completed before a leaf
  follows from the digits of its number, and a node's position is that of its last
  leaf plus its level, for full and for short runs.
* Proofs.  From the top round down, each builder's group reads its part of
  the log, addresses the siblings of its nodes by these positions and hands every node its
  siblings up to the root; the lowest round folds them.

Each group has at most ``FANOUT ** LEVELS`` children, whatever the table holds.

Edge cases: null ids sort first, equal ids by leaf hash; repeated rows are
leaves of their own; a null language is a tree of its own, before all others;
null fields hash as ``-``; a row with a null id is never tampered; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import string
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .shared import parts, ship, written

FANOUT = 8
LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

LOG = "tree string, n long, level int, idx long, pos long, digest binary, top boolean"
PATH = "tree string, idx long, before array<string>, after array<string>"


# -- closed forms ---------------------------------------------------------------

def completed_before(leaf: int) -> int:
    """Nodes that are in the log before leaf number ``leaf``: one full subtree for each unit of each digit."""
    total, size = 0, 1
    while leaf:
        leaf, digit = divmod(leaf, FANOUT)
        total += digit * size
        size = size * FANOUT + 1
    return total


def position(level: int, idx: int, n: int) -> int:
    """Place in the log of node ``idx`` of ``level`` in a tree of ``n`` leaves."""
    return completed_before(min((idx + 1) * FANOUT ** level, n) - 1) + level


def width(level: int, n: int) -> int:
    return -(-n // FANOUT ** level)


def height(n: int) -> int:
    h = 0
    while n > 1:
        n, h = -(-n // FANOUT), h + 1
    return h


def node_hash(hexes: list[str]) -> str:
    return hashlib.sha256("".join(hexes).encode()).hexdigest()


# -- leaves -----------------------------------------------------------------------

def _field(col: Column) -> Column:
    s = col.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_hash(fields: dict[str, Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[_field(c) for c in fields.values()]).cast("binary"), 256))


def lower_cased_text(id_col: str = "doc_id", text: str = "text") -> Column:
    """The tampering of the registered query: A-Z of the text in lower case where 3 divides crc32(id)."""
    hit = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 0, F.lit(False))
    return F.when(hit, F.translate(F.col(text), string.ascii_uppercase, string.ascii_lowercase)).otherwise(F.col(text))


def _leaves(docs: DataFrame, fields, presented: dict[str, Column]) -> DataFrame:
    own = {f: F.col(f) for f in fields}
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("tree"),
        F.col("doc_id"), leaf_hash(own).alias("digest"), leaf_hash(own | presented).alias("presented"))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``idx``, the number in its ``tree`` by ``order`` (ties: any), and ``n``, the tree's size."""
    spark = rows.sparkSession
    rows = rows.withColumn("tie", F.monotonically_increasing_id())  # equal rows may not gather in one partition
    keys = ["tree", *order, "tie"]
    spread = written(
        rows.repartitionByRange(parts(spark), *keys).sortWithinPartitions(*keys).drop("tie")
        .withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), "merkle-leaves")
    runs = spread.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("here"))
    so_far = F.sum("here").over(Window.partitionBy("tree").orderBy("part"))
    runs = runs.select("tree", "part", (so_far - F.col("here") - F.col("first")).alias("shift"),
                       F.sum("here").over(Window.partitionBy("tree")).alias("n"))
    return (spread.join(runs, ["tree", "part"])
            .withColumn("idx", F.col("at") + F.col("shift")).drop("part", "at", "shift"))


# -- build --------------------------------------------------------------------------

def _build(first_round: bool, base: int, span: int):
    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by("idx")
        tree, n = group.column("tree")[0].as_py(), group.column("n")[0].as_py()
        first = group.column("idx")[0].as_py()
        level, tall = base, height(n)
        nodes = {(base, first + i): d.hex() for i, d in enumerate(group.column("digest").to_pylist())}
        row = [(first + i) for i in range(len(nodes))]
        made = list(nodes) if first_round else []
        while level < min(tall, base + span):
            ups = list(dict.fromkeys(i // FANOUT for i in row))
            for u in ups:
                nodes[level + 1, u] = node_hash([nodes[level, i] for i in range(u * FANOUT, min((u + 1) * FANOUT, width(level, n)))])
                made.append((level + 1, u))
            level, row = level + 1, ups
        made = sorted((position(lv, i, n), lv, i) for lv, i in made)
        return pa.table({
            "tree": pa.array([tree] * len(made), pa.string()), "n": pa.array([n] * len(made), pa.int64()),
            "level": pa.array([m[1] for m in made], pa.int32()), "idx": pa.array([m[2] for m in made], pa.int64()),
            "pos": pa.array([m[0] for m in made], pa.int64()),
            "digest": pa.array([bytes.fromhex(nodes[m[1:]]) for m in made], pa.binary()),
            "top": pa.array([m[1] == tall for m in made], pa.bool_())})
    return build


def _with_block(nodes: DataFrame, round_: int) -> DataFrame:
    """``nodes`` with ``block``, the builder of round ``round_`` that owns each."""
    span = F.pow(F.lit(float(FANOUT)), F.lit((round_ + 1) * LEVELS) - F.col("level")).cast("long")
    return nodes.withColumn("block", ((F.col("idx") - F.pmod(F.col("idx"), span)) / span).cast("long"))


@dataclass
class Trees:
    """Trees over numbered leaves: the log's rounds, each a written table of nodes."""

    leaves: DataFrame
    rounds: list[DataFrame]

    @property
    def tops(self) -> DataFrame:
        """tree, digest of each subroot."""
        return reduce(DataFrame.unionByName, self.rounds).filter("top").select("tree", "digest")


def build_trees(leaves: DataFrame, label: str) -> Trees:
    """The log of the trees over ``leaves`` (tree, n, idx, digest)."""
    spark = leaves.sparkSession
    most = leaves.agg(F.max("n")).first()[0] or 0
    rounds: list[DataFrame] = []
    for r in range(max(1, -(-height(most) // LEVELS))):
        base = leaves.withColumn("level", F.lit(0)) if r == 0 else rounds[-1].filter((F.col("level") == r * LEVELS) & ~F.col("top"))
        nodes = (_with_block(base, r).select("tree", "block", "n", "idx", "digest").groupBy("tree", "block")
                 .applyInArrow(_build(r == 0, r * LEVELS, LEVELS), LOG))
        rounds.append(written(nodes, f"merkle-{label}-log"))
    return Trees(leaves, rounds)


# -- proofs -------------------------------------------------------------------------

class Siblings:
    """Paths of a builder's nodes to the root: at each level the siblings before and after, as joined hex text."""

    def __init__(self, nodes: pa.Table, before: list[str], after: list[str], base: int, span: int):
        self.n, self.base = nodes.column("n")[0].as_py(), base
        digests = nodes.column("digest").to_pylist()
        self.at = dict(zip(nodes.column("pos").to_pylist(), digests))
        self.top = min(height(self.n), base + span)
        self.above = list(zip(before, after))
        self.known: dict[tuple[int, int], list[tuple[str, str]]] = {}

    def run(self, level: int, idx: int) -> list[str]:
        """The run of siblings that holds a node, itself included, addressed by their positions in the log."""
        start = idx // FANOUT * FANOUT
        end = min(start + FANOUT, width(level, self.n))
        return [self.at[position(level, i, self.n)].hex() for i in range(start, end)]

    def path(self, level: int, idx: int) -> list[tuple[str, str]]:
        if level >= self.top:
            return self.above
        key = (level, idx)
        if key not in self.known:
            run, own = self.run(level, idx), idx % FANOUT
            self.known[key] = [("".join(run[:own]), "".join(run[own + 1:])), *self.path(level + 1, idx // FANOUT)]
        return self.known[key]


def _split(group: pa.Table) -> tuple[pa.Table, list[str], list[str]]:
    """A group's part of the log, and its own path from above (the row without a digest)."""
    own = pc.is_valid(group.column("digest"))
    upper = group.filter(pc.invert(own))
    before = upper.column("before")[0].as_py() if upper.num_rows else []
    after = upper.column("after")[0].as_py() if upper.num_rows else []
    return group.filter(own), before, after


def _paths(base: int, span: int):
    def paths(group: pa.Table) -> pa.Table:
        nodes, before, after = _split(group)
        s = Siblings(nodes, before, after, base, span)
        ids = nodes.filter(pc.equal(nodes.column("level"), base)).column("idx").to_pylist()
        got = [s.path(base, i) for i in ids]
        tree = group.column("tree")[0].as_py()
        return pa.table({
            "tree": pa.array([tree] * len(ids), pa.string()), "idx": pa.array(ids, pa.int64()),
            "before": pa.array([[b for b, _ in p] for p in got], pa.list_(pa.string())),
            "after": pa.array([[a for _, a in p] for p in got], pa.list_(pa.string()))})
    return paths


def _group_rows(trees: Trees, r: int, upper: DataFrame) -> DataFrame:
    """What the builders of round ``r`` need: their nodes but the top one, and a row with the path above (block, before, after)."""
    low, high = r * LEVELS, (r + 1) * LEVELS - 1
    near = [trees.rounds[r], *([trees.rounds[r - 1]] if r else [])]
    nodes = reduce(DataFrame.unionByName, near).filter(F.col("level").between(low, high))
    if r:  # trees that ended below this round have their whole path there
        nodes = nodes.filter(~((F.col("level") == low) & F.col("top")))
    nodes = _with_block(nodes, r).select("tree", "block", "n", "level", "idx", "pos", "digest")
    return nodes.unionByName(upper.select("tree", "block", "before", "after"), allowMissingColumns=True)


def upper_paths(trees: Trees, above: DataFrame) -> DataFrame:
    """tree, block, before, after: the path above each lowest builder.  ``above`` has those above each tree's top (tree, before, after)."""
    paths = None
    for r in reversed(range(len(trees.rounds))):
        ended = trees.rounds[r].filter("top").select("tree").join(above, "tree").withColumn("block", F.lit(0).cast("long"))
        upper = ended if paths is None else ended.unionByName(paths.withColumnRenamed("idx", "block"))
        if r == 0:
            return upper
        paths = written(_group_rows(trees, r, upper).groupBy("tree", "block").applyInArrow(_paths(r * LEVELS, LEVELS), PATH), "merkle-paths")


def all_paths(trees: Trees, above: DataFrame) -> DataFrame:
    """tree, idx, before, after for every leaf of ``trees``."""
    rows = _group_rows(trees, 0, upper_paths(trees, above))
    return rows.groupBy("tree", "block").applyInArrow(_paths(0, LEVELS), PATH)


def _fold(root: str, kind: pa.DataType, span: int, with_proofs: bool):
    def fold(leaves: pa.Table, group: pa.Table) -> pa.Table:
        nodes, before, after = _split(group)
        s = Siblings(nodes, before, after, 0, span)
        top_level = height(s.n)
        out: list[list] = [[] for _ in range(8)]
        rest: dict[tuple[int, str], str] = {}  # folded values from level 1 on, of the leaves of one run
        tails: dict[int, str] = {}
        shown = nodes.filter(pc.equal(nodes.column("level"), 0))
        hexes = dict(zip(shown.column("idx").to_pylist(), [d.hex() for d in shown.column("digest").to_pylist()]))
        subroot = ""
        for i, other in zip(leaves.column("idx").to_pylist(), leaves.column("presented").to_pylist()):
            path, leaf, h = s.path(0, i), hexes[i], other.hex()
            run = i // FANOUT
            if run not in tails:
                tails[run] = "".join(b + a for b, a in path[1:])
            if path:
                b, a = path[0]
                proof = hashlib.sha256((b + a + tails[run]).encode()).hexdigest()
                h = node_hash([b, h, a])
                if (run, h) not in rest:
                    up = h
                    for b, a in path[1:]:
                        up = node_hash([b, up, a])
                    rest[run, h] = up
                h = rest[run, h]
            else:
                proof = hashlib.sha256(b"").hexdigest()
            if not subroot:
                subroot = leaf
                for b, a in path[:top_level]:
                    subroot = node_hash([b, subroot, a])
            for col, v in zip(out, (leaf, subroot, root, proof, h, h == root, [b for b, _ in path], [a for _, a in path])):
                col.append(v)
        got = {"doc_id": leaves.column("doc_id").cast(kind)}
        for name, col in zip(("leaf", "subroot", "root", "proof_sha256", "folded_root"), out):
            got[name] = pa.array(col, pa.string())
        got["verified"] = pa.array(out[5], pa.bool_())
        if with_proofs:
            got["before"], got["after"] = (pa.array(c, pa.list_(pa.string())) for c in out[6:])
        return pa.table(got)
    return fold


def merkle_manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, presented: dict[str, Column] | None = None,
                    with_proofs: bool = False) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for each row of ``docs``.

    ``presented`` has the fields (by name) that the verifier sees in place of the
    stored ones; by default nothing is tampered.  ``with_proofs`` adds the siblings of
    each level, joined hex text ``before`` and ``after`` the node.
    """
    spark = docs.sparkSession
    ship(spark)
    kind = docs.schema["doc_id"].dataType
    leaves = written(numbered(written(_leaves(docs, fields, presented or {}), "merkle-hashes"), ["doc_id", "digest"]), "merkle-numbered")
    lower = build_trees(leaves, "leaves")

    tops = lower.tops.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    upper = build_trees(written(numbered(tops, ["name"]), "merkle-tops"), "tops")
    got = upper.tops.first()
    root = got.digest.hex() if got else ""
    none = upper.tops.select("tree", F.array().cast("array<string>").alias("before"), F.array().cast("array<string>").alias("after"))
    above = written(all_paths(upper, none).join(upper.leaves.select("tree", "idx", "name"), ["tree", "idx"])
                    .select(F.col("name").alias("tree"), "before", "after"), "merkle-above")

    rows = _group_rows(lower, 0, upper_paths(lower, above))
    owned = _with_block(lower.leaves.withColumn("level", F.lit(0)), 0).select("tree", "block", "doc_id", "idx", "presented")
    schema = (f"doc_id {kind.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
              + (", before array<string>, after array<string>" if with_proofs else ""))
    return (owned.groupBy("tree", "block").cogroup(rows.groupBy("tree", "block"))
            .applyInArrow(_fold(root, to_arrow_type(kind), LEVELS, with_proofs), schema))
