"""A manifest of a dataset as a persistent Merkle tree, with a version per altered leaf."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordflow.llm.common import Stages, as_batch, on_workers
from recordflow.llm.ordering import positions

#: Children of a node.
FAN = 8
#: A block holds so many levels, FAN ** LEVELS nodes at its foot; one task step sees one block.
LEVELS = 4
BLOCK = FAN**LEVELS


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value) -> bytes:
    """``-`` for null, else the UTF-8 byte count, a colon, the value."""
    if value is None:
        return b"-"
    raw = value if isinstance(value, bytes) else str(value).encode()
    return b"%d:%s" % (len(raw), raw)


class Tree:
    """Digests of consecutive nodes and everything above them, up to ``levels`` levels or, if that is None, to one node.

    Nodes never change. :meth:`version` gives the nodes that a tree with another
    leaf does not share with this one: the leaf and its ancestors.
    """

    def __init__(self, foot: list[str], levels: int | None = None):
        self.levels = [foot]
        while len(self.levels) <= levels if levels is not None else len(self.levels[-1]) > 1:
            row = self.levels[-1]
            self.levels.append([digest(*row[i : i + FAN]) for i in range(0, len(row), FAN)])

    @property
    def top(self) -> str:
        return self.levels[-1][0]

    def siblings(self, leaf: int) -> list[tuple[list[str], list[str]]]:
        """The others of the leaf's run and of its ancestors' runs, before and after it, from below."""
        out = []
        for row in self.levels[:-1]:
            low = leaf - leaf % FAN
            out.append((row[low:leaf], row[leaf + 1 : low + FAN]))
            leaf //= FAN
        return out

    def version(self, leaf: int, changed: str) -> list[str]:
        """The new digests of the leaf and its ancestors, from below; every other node is this tree's."""
        return climb(changed, self.siblings(leaf))


def climb(node: str, path: list[tuple[list[str], list[str]]]) -> list[str]:
    """The node and its ancestors along ``path``."""
    out = [node]
    for before, after in path:
        out.append(digest(*before, out[-1], *after))
    return out


_LEAF = [("doc_id", pa.int64()), ("tree", pa.string()), ("digest", pa.string()), ("changed", pa.string())]


def leaves(docs: DataFrame, alter: Callable[[int | None, bytes | None], bytes | None] | None) -> DataFrame:
    """``(doc_id, tree, digest, changed)``: each row's leaf, and its leaf with the altered text where ``alter`` gives one."""
    schema = pa.schema(_LEAF)

    def build(batches):
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[:4]]
            out = []
            for doc_id, source, lang, n_chars, cell in zip(*columns, batch.column(4).cast(pa.binary())):
                text = cell.as_py()
                head = b"".join(map(field, (doc_id, source, lang, n_chars)))
                leaf = hashlib.sha256(head + field(text)).hexdigest()
                other = alter(doc_id, text) if alter else None
                out.append((doc_id, lang, leaf, None if other is None else hashlib.sha256(head + field(other)).hexdigest()))
            if out:
                yield as_batch(out, schema)

    kinds = [("doc_id", "long"), ("source", "string"), ("lang", "string"), ("n_chars", "long"), ("text", "string")]
    rows = docs.select(*[F.col(name).cast(kind).alias(name) for name, kind in kinds])
    return rows.mapInArrow(build, "doc_id long, tree string, digest string, changed string")


_PATH = "path array<struct<before: array<string>, after: array<string>>>"
_STEP = pa.struct([("before", pa.list_(pa.string())), ("after", pa.list_(pa.string()))])


def _blocks(batches) -> Iterator[tuple[dict, list[dict]]]:
    """``(header, rows)`` of each block from rows sorted by tree, block and position; the header has position -1."""
    header, rows, now = None, [], None
    for batch in batches:
        for row in batch.to_pylist():
            key = (row["tree"], row["block"])
            if key != now:
                if rows:
                    yield header, rows
                header, rows, now = None, [], key
            if row["pos"] < 0:
                header = row
            else:
                rows.append(row)
    if rows:
        yield header, rows


def _dealt(nodes: DataFrame) -> DataFrame:
    """Nodes by block: at most BLOCK rows (and a header) share a key, whatever the size of a tree."""
    return nodes.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")


def _roots(nodes: DataFrame) -> DataFrame:
    """``(tree, pos, n, digest)``: the top of each block of ``nodes(tree, block, pos, n, digest)``, numbered within the tree."""
    schema = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("digest", pa.string())])

    def build(batches):
        for _, rows in _blocks(batches):
            n = rows[0]["n"]
            tree = Tree([r["digest"] for r in rows], LEVELS if n > BLOCK else None)
            yield as_batch([(rows[0]["tree"], rows[0]["block"], -(-n // BLOCK), tree.top)], schema)

    return _dealt(nodes.select("tree", "block", "pos", "n", "digest")).mapInArrow(build, "tree string, pos long, n long, digest string")


def _blocked(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.shiftright("pos", (BLOCK - 1).bit_length()))


def paths(nodes: DataFrame, stages: Stages) -> DataFrame:
    """``(tree, pos, root, path)`` of every node of ``nodes(tree, pos, n, digest)``: its way up, block by block.

    Used for the tops of blocks, a 4096th of the level below, until one block is left.
    """
    nodes = stages.write(_blocked(nodes), "nodes")
    schema = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("root", pa.string()), ("path", pa.list_(_STEP))])

    def build(batches):
        for header, rows in _blocks(batches):
            n = rows[0]["n"]
            tree = Tree([r["digest"] for r in rows], LEVELS if n > BLOCK else None)
            above = header["path"] if header else []
            root = header["root"] if header else tree.top
            out = []
            for i, row in enumerate(rows):
                own = [{"before": b, "after": a} for b, a in tree.siblings(i)]
                out.append((row["tree"], row["pos"], root, own + above))
            yield as_batch(out, schema)

    rows = nodes.select("tree", "block", "pos", "n", "digest", F.lit(None).cast("string").alias("root"), F.expr(f"cast(null as {_PATH[5:]})").alias("path"))
    if not nodes.where(F.col("n") > BLOCK).isEmpty():
        rows = rows.unionByName(_headers(paths(_roots(nodes), stages)), allowMissingColumns=True)
    return stages.write(_dealt(rows).mapInArrow(build, f"tree string, pos long, root string, {_PATH}"), "paths")


def _headers(above: DataFrame) -> DataFrame:
    """The way up from each block's top, as a row before the block's nodes."""
    return above.withColumnRenamed("pos", "block").withColumn("pos", F.lit(-1).cast("long"))


def manifest(docs: DataFrame, alter: Callable[[int | None, bytes | None], bytes | None] | None = None) -> DataFrame:
    """A Merkle tree over all rows of ``docs(doc_id, source, lang, n_chars, text, ...)``, and a check of each leaf.

    A leaf is the sha256 of the row's five fields; the leaves of a language, by
    doc_id, form a tree of fan 8, and the languages' roots, by name, the last
    tree. One row per row of ``docs``: doc_id, leaf, subroot, root, proof (the
    siblings along the way up, from the leaf to the root, left to right),
    folded_root and verified.

    ``alter(doc_id, text)`` may return another text for a row: this leaf then
    starts a version of the tree that copies the leaf's ancestors and shares all
    other nodes. folded_root is the top of the version, or of the tree itself.

    Blocks of 8^4 aligned nodes are worked on one by one; the tops of blocks are
    the leaves of the next block level, so a tree of any size takes a few rounds
    and no task sees more than a block of it. A row's version goes on above its
    block with the way up of the block's top, which all rows of the block share.
    Nulls: a null field is ``-``; null languages are a tree of their own, which
    comes first; null doc_ids come first in a tree. Rows that share a doc_id are
    ordered by their digests. Other columns are ignored; no rows give no rows.
    """
    on_workers(docs.sparkSession)
    stages = Stages(docs.sparkSession, "merkle")
    found = stages.write(leaves(docs, alter), "leaves")
    # Equal rows may change places: they have equal leaves and equal alterations.
    order = [F.asc_nulls_first("doc_id"), F.asc("digest")]
    placed = stages.write(_blocked(positions(found, ["tree"], order, stages)), "placed")
    within = paths(_roots(placed), stages)
    # One root per tree; the trees are the leaves of the last tree.
    tops = stages.write(within.where("pos = 0").select("tree", F.col("root").alias("digest")), "subroots")
    named = positions(tops.withColumnRenamed("tree", "name"), [], [F.asc_nulls_first("name")], stages)
    last = paths(named.withColumn("tree", F.lit("")).select("tree", "pos", "n", "digest"), stages)
    named = named.select("name", F.col("digest").alias("subroot"), F.col("pos").alias("at"))
    upper = named.join(last.select(F.col("pos").alias("at"), F.col("root").alias("top"), F.col("path").alias("rest")), "at")
    way = within.join(upper, F.col("tree").eqNullSafe(F.col("name")))
    headers = way.select("tree", "pos", F.col("top").alias("root"), "subroot", F.concat("path", "rest").alias("path"))

    schema = pa.schema(
        [("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string())]
        + [("proof", pa.list_(pa.string())), ("folded_root", pa.string()), ("verified", pa.bool_())]
    )

    def build(batches):
        for header, rows in _blocks(batches):
            n = rows[0]["n"]
            tree = Tree([r["digest"] for r in rows], LEVELS if n > BLOCK else None)
            above = [(s["before"], s["after"]) for s in header["path"]]
            ahead = [d for b, a in above for d in (*b, *a)]
            out = []
            for i, row in enumerate(rows):
                proof = [d for b, a in tree.siblings(i) for d in (*b, *a)] + ahead
                top = tree.top if row["changed"] is None else tree.version(i, row["changed"])[-1]
                folded = header["root"] if top == tree.top else climb(top, above)[-1]
                out.append((row["doc_id"], row["digest"], header["subroot"], header["root"], proof, folded, folded == header["root"]))
            yield as_batch(out, schema)

    both = placed.unionByName(_headers(headers), allowMissingColumns=True)
    types = "doc_id long, leaf string, subroot string, root string, proof array<string>, folded_root string, verified boolean"
    return _dealt(both).mapInArrow(build, types)


def lowered_third(doc_id: int | None, text: bytes | None) -> bytes | None:
    """The tampering of the bound query: where 3 divides the crc32 of the id, A-Z of the text become a-z."""
    if text is None or doc_id is None or zlib.crc32(str(doc_id).encode()) % 3:
        return None
    return text.lower()


def manifest_report(checked: DataFrame) -> DataFrame:
    """Digest columns of :func:`manifest`."""
    proof = F.sha2(F.array_join("proof", "").cast("binary"), 256).alias("proof_sha256")
    return checked.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", "verified")
