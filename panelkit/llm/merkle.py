"""Merkle manifest of a table, with octopus multiproofs.

Rows are leaves. The leaves of every group (say, a source) form a tree of
fan-out 16, and the groups' roots form one more tree. Leaves are stored in
range partitions of (group, order), so a partition holds at most one
consecutive piece of each group it meets:

* every partition folds its pieces upwards as far as they reach and hands on
  only the nodes at their edges; the few nodes that lie across partitions are
  joined level by level;
* for the proofs, every partition lists the coordinates it cannot derive from
  its own leaves (siblings of its edges: at most 15 a side and level), fetches
  each once, derives all shared interiors, and expands the proofs of its
  leaves from them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from panelkit.llm.common import stored

RUN = 16                     # children of a node
ROWS_PER_PARTITION = 16_384  # leaves in a range partition, about
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_digest(columns: list[Column]) -> Column:
    """Lower-case hex SHA-256 of the columns: ``-`` for null, else UTF-8 byte count, ``:``, value."""
    parts = []
    for column in columns:
        value = column.cast("string")
        parts.append(F.when(column.isNull(), F.lit("-"))
                     .otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _hash(parts: bytes) -> bytes:
    """Hex SHA-256 of concatenated hex digests."""
    return hashlib.sha256(parts).hexdigest().encode()


def parents(first: int, nodes: list[bytes], size: int) -> tuple[int, list[bytes], int, int]:
    """What a piece [first, first + len(nodes)) of a level of ``size`` nodes can fold by itself.

    Returns the first parent, the parents, and the bounds (positions in
    ``nodes``) of the children they use up; outside of those lie the edges.
    """
    end = first + len(nodes)
    low = -(-first // RUN)
    high = -(-size // RUN) if end == size else end // RUN
    if high <= low:
        return low, [], 0, 0
    made = [_hash(b"".join(nodes[max(RUN * j - first, 0):RUN * (j + 1) - first])) for j in range(low, high)]
    return low, made, RUN * low - first, min(RUN * high, size) - first


def missing(first: int, end: int, size: int) -> list[tuple[int, int]]:
    """Coordinates (level, index) that a piece [first, end) of ``size`` leaves cannot derive for its proofs.

    At every level these are the siblings of its two edges, in one minimal
    union for all leaves of the piece.
    """
    out, level = [], 0
    while size > 1:
        stop = min(size, RUN * ((end - 1) // RUN + 1))
        out += [(level, k) for k in (*range(first // RUN * RUN, first), *range(end, stop))]
        first, end, size, level = first // RUN, (end - 1) // RUN + 1, -(-size // RUN), level + 1
    return out


def expand(first: int, leaves: list[bytes], size: int, fetched: dict[tuple[int, int], bytes]
           ) -> tuple[bytes, list[list[tuple[bytes, bytes]]]]:
    """(root, proof of every leaf) of a piece; a proof lists (left, right) siblings by level.

    Interiors are derived once; leaves share their ancestors' entries.
    """
    levels: list[tuple[int, list[tuple[bytes, bytes]]]] = []
    nodes, start, level = leaves, first, 0
    while size > 1:
        end = start + len(nodes)
        low, stop = start // RUN * RUN, min(size, RUN * ((end - 1) // RUN + 1))
        row = ([fetched[level, k] for k in range(low, start)] + nodes
               + [fetched[level, k] for k in range(end, stop)])
        sides, made = [], []
        for at in range(0, len(row), RUN):
            run = row[at:at + RUN]
            sides += [(b"".join(run[:k]), b"".join(run[k + 1:])) for k in range(len(run))]
            made.append(_hash(b"".join(run)))
        levels.append((start, sides[start - low:end - low]))
        nodes, start, size, level = made, low // RUN, -(-size // RUN), level + 1
    proofs = []
    for k in range(first, first + len(leaves)):
        proof, at = [], k
        for begin, sides in levels:
            proof.append(sides[at - begin])
            at //= RUN
        proofs.append(proof)
    return nodes[0], proofs


def fold(leaf: bytes, proof: list[tuple[bytes, bytes]]) -> bytes:
    """The root that a leaf and its siblings give."""
    for left, right in proof:
        leaf = _hash(left + leaf + right)
    return leaf


# Rows that meet in one leaf partition: its pieces (kind 0), fetched nodes (1) and leaves (2).
_ROW = ("pid int, kind int, grp string, seq long, first long, size long, level int, idx long, "
        "digest string, claimed string, above array<string>")


def _padded(df: DataFrame, extra: dict | None = None) -> DataFrame:
    """``df`` in the common row form; absent columns are null."""
    fields = StructType.fromDDL(_ROW).fields + list((extra or {}).values())
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in fields])


class Forest:
    """The trees of all groups over leaves (grp, leaf, claimed and the ``order`` columns).

    ``grp`` is a string or null (a group of its own, first in order); leaves
    of one group ascend by the order columns, nulls first, then by digest.
    """

    def __init__(self, leaves: DataFrame, order: list[str]):
        spark = leaves.sparkSession
        rows = leaves.count()
        self.partitions = max(1, -(-rows // ROWS_PER_PARTITION))
        keys = [F.col(c).asc_nulls_first() for c in ["grp", *order, "leaf"]]
        placed = (leaves.repartitionByRange(self.partitions, *keys).sortWithinPartitions(*keys)
                  .withColumn("pid", F.spark_partition_id()).withColumn("seq", F.monotonically_increasing_id()))
        self.leaves = stored(placed, "leaves")
        counts = self.leaves.groupBy("pid", "grp").agg(F.count("*").alias("n"))
        before = Window.partitionBy("grp").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
        self.pieces = stored(counts.select(
            "pid", "grp", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"),
            F.sum("n").over(Window.partitionBy("grp")).alias("size")), "pieces")
        most = self.pieces.agg(F.max("size")).first()[0] or 1
        self.height = 0
        while RUN ** self.height < most:
            self.height += 1
        self.nodes = self._nodes()

    def _grouped(self, rows: DataFrame):
        """Rows brought together by leaf partition, one partition to a task where Spark's sample allows."""
        return rows.repartitionByRange(self.partitions, "pid").groupBy("pid")

    def _nodes(self) -> DataFrame:
        """(grp, level, idx, size, digest): every node that some leaf partition cannot derive, and all group roots.

        Edges from the partitions' own folding, then parents across
        partitions level by level: a parent that no partition could fold has
        all its children here.
        """
        rows = _padded(self.pieces.withColumn("kind", F.lit(0))).unionByName(
            _padded(self.leaves.withColumn("kind", F.lit(2)).withColumnRenamed("leaf", "digest")))

        def edges(table: pa.Table) -> pa.Table:
            out: list[tuple] = []
            for grp, first, size, piece, _, _ in _pieces(table):
                nodes, level = [r["digest"].encode() for r in piece], 0
                while True:
                    up, made, a, b = parents(first, nodes, size) if size > 1 else (0, [], 0, 0)
                    kept = [*range(a), *range(b, len(nodes))]
                    out += [(grp, level, first + k, size, nodes[k].decode()) for k in kept]
                    if not made:
                        break
                    nodes, first, size, level = made, up, -(-size // RUN), level + 1
            return pa.Table.from_arrays(
                [pa.array([r[k] for r in out], t) for k, t in enumerate(
                    (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string()))],
                ["grp", "level", "idx", "size", "digest"])

        found = stored(self._grouped(rows).applyInArrow(
            edges, "grp string, level int, idx long, size long, digest string"), "edges")
        whole, made = found, None
        for level in range(self.height):
            here = found.where(F.col("level") == level)
            here = here if made is None else here.unionByName(made)
            made = (here.where("size > 1").groupBy("grp", "size", F.expr(f"idx div {RUN}").alias("idx"))
                    .agg(F.array_sort(F.collect_list(F.struct(F.col("idx").alias("k"), "digest"))).alias("run")))
            made = stored(made.select(
                "grp", F.lit(level + 1).alias("level"), "idx", F.expr(f"(size + {RUN - 1}) div {RUN}").alias("size"),
                F.sha2(F.array_join(F.transform("run", lambda x: x["digest"]), "").cast("binary"), 256)
                .alias("digest")), "merged")
            whole = whole.unionByName(made)
        return whole

    def roots(self) -> DataFrame:
        """(grp, digest) of every group."""
        return self.nodes.where("size = 1").select("grp", "digest")

    def proofs(self, above: DataFrame | None, passed: list[str], listed: bool) -> DataFrame:
        """Proof digests and folded roots of all leaves, with the ``passed`` columns of the leaf table.

        ``above`` has, per group, the levels over the group's root (if any)
        as ``above``: left, right, left, right and so on. ``listed`` adds the
        proofs themselves in the same form.
        """
        types = {f.name: f for f in self.leaves.schema.fields}
        extra = {c: StructField(f"passed_{c}", types[c].dataType) for c in passed}
        asked = stored(self.pieces.mapInArrow(_asked, "pid int, grp string, level int, idx long"), "asked")
        nodes = self.nodes.select(F.col("grp").alias("g"), F.col("level").alias("l"), F.col("idx").alias("i"), "digest")
        fetched = stored(asked.join(nodes, F.col("grp").eqNullSafe(F.col("g")) & (F.col("level") == F.col("l"))
                                    & (F.col("idx") == F.col("i"))).select("pid", "grp", "level", "idx", "digest"),
                         "fetched")
        pieces = self.pieces
        if above is not None:
            tops = above.select(F.col("grp").alias("g"), "above")
            pieces = stored(pieces.join(tops, F.col("grp").eqNullSafe(F.col("g"))).drop("g"), "pieces-above")
        leaves = self.leaves.withColumnRenamed("leaf", "digest").withColumnsRenamed(
            {c: f"passed_{c}" for c in passed})
        rows = _padded(pieces.withColumn("kind", F.lit(0)), extra).unionByName(
            _padded(fetched.withColumn("kind", F.lit(1)), extra)).unionByName(
            _padded(leaves.withColumn("kind", F.lit(2)), extra))
        out = StructType([types[c] for c in passed] + StructType.fromDDL(
            "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
            + (", proof array<string>" if listed else "")).fields)

        def run(table: pa.Table) -> pa.Table:
            made: dict[str, list] = {f.name: [] for f in out.fields}
            for _, first, size, piece, nodes, over in _pieces(table):
                leaves = [r["digest"].encode() for r in piece]
                subroot, proofs = expand(first, leaves, size, nodes)
                top = [(over[k].encode(), over[k + 1].encode()) for k in range(0, len(over), 2)]
                root = fold(subroot, top)
                for row, leaf, proof in zip(piece, leaves, proofs):
                    sides = proof + top
                    folded = fold((row["claimed"] or row["digest"]).encode(), sides)
                    siblings = b"".join(left + right for left, right in sides)
                    for c in passed:
                        made[c].append(row[f"passed_{c}"])
                    made["leaf"].append(row["digest"])
                    made["subroot"].append(subroot.decode())
                    made["root"].append(root.decode())
                    if listed:
                        made["proof"].append([x.decode() for side in sides for x in side])
                    made["proof_sha256"].append(_hash(siblings).decode())
                    made["folded_root"].append(folded.decode())
                    made["verified"].append(folded == root)
            return pa.Table.from_pydict(made, schema=_arrow(out))

        return self._grouped(rows).applyInArrow(run, out)


def _arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The missing coordinates of every piece."""
    for batch in batches:
        out = [(p["pid"], p["grp"], level, k) for p in batch.to_pylist()
               for level, k in missing(p["first"], p["first"] + p["n"], p["size"])]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(
            (pa.int32(), pa.string(), pa.int32(), pa.int64()))], ["pid", "grp", "level", "idx"])


def _pieces(table: pa.Table) -> Iterator[tuple]:
    """(grp, first, size, leaf rows in order, fetched nodes, levels above) of every piece in a leaf partition."""
    pieces: dict = {}
    for row in table.to_pylist():
        piece = pieces.setdefault(row["grp"], ([], {}, []))
        if row["kind"] == 0:
            piece[2].append(row)
        elif row["kind"] == 1:
            piece[1][row["level"], row["idx"]] = row["digest"].encode()
        else:
            piece[0].append(row)
    for grp, (leaves, nodes, head) in pieces.items():
        leaves.sort(key=lambda r: r["seq"])
        yield grp, head[0]["first"], head[0]["size"], leaves, nodes, head[0]["above"] or []


def manifest(docs: DataFrame, columns: list[str], group: str, order: str,
             claimed: dict[str, Column] | None = None, when: Column | None = None,
             listed: bool = False) -> DataFrame:
    """Leaf, roots, proof and verification of every row of ``docs``.

    The leaf is the digest of ``columns``. ``claimed`` replaces columns where
    ``when`` holds: these are the rows to be checked against the untampered
    tree. Returns ``order``, leaf, subroot (of the row's group), root,
    proof_sha256 (digest of all siblings), folded_root (from the claimed row
    and the proof), verified and, where ``listed``, proof (the concatenated
    left and right siblings, level by level).

    Defined cases: nulls are marked in leaves; a null group is the first
    group; rows of one order value (or null, which goes first) ascend by leaf
    digest, so equal rows are equal leaves; a lone row has an empty proof; an
    empty table gives an empty result; other columns are ignored, whatever
    their names.
    """
    leaf = leaf_digest([F.col(c) for c in columns])
    told = leaf_digest([(claimed or {}).get(c, F.col(c)) for c in columns])
    rows = stored(docs.select(
        F.col(group).cast("string").alias("grp"), F.col(order).alias("place"), leaf.alias("leaf"),
        (F.when(when, told) if when is not None else F.lit(None).cast("string")).alias("claimed")), "digests")
    forest = Forest(rows, ["place"])
    top = Forest(forest.roots().select(F.lit("").alias("grp"), F.col("grp").alias("name"), F.col("digest").alias("leaf"),
                                       F.lit(None).cast("string").alias("claimed")), ["name"])
    above = stored(top.proofs(None, ["name"], True).select(F.col("name").alias("grp"), F.col("proof").alias("above")), "above")
    return forest.proofs(above, ["place"], listed).withColumnRenamed("place", order)


def lower_ascii(column: Column) -> Column:
    """The text with A-Z lower-cased, and nothing else."""
    return F.translate(column, UPPER, LOWER)
