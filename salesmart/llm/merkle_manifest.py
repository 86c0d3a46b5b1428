"""Merkle manifest of a dataset by butterfly exchange.

A row is a leaf: the hash H (lower-case hex SHA-256) of its fields, each ``-``
where null, else its UTF-8 byte count, ``:`` and its value.  Within a source
the leaves ascend by id; while several nodes remain, every ``FANOUT``
consecutive ones become the H of their digests.  What remains is the subroot
of the source; the subroots, ordered by source, give the root the same way.

1. Leaves are hashed where they are read; only digests move from there on.
   One range sort numbers them, with offsets by range partition.
2. Leaves are dealt into aligned blocks of ``FANOUT ** HEIGHT``.  Each block
   is hashed up to its own root by one task.
3. Butterfly exchange: in each round the blocks below up to ``FANOUT`` sibling
   subtrees swap the roots of these subtrees.  Every block of a subtree has a
   lane; the blocks of one lane meet, each brings the root of its subtree, and
   each hashes the parent for itself.  Where a subtree has fewer blocks than
   its largest sibling, its blocks serve several lanes.  So after each round
   every block holds the next part of its upper proof, and nothing travels
   down again.  The exchange first runs within the sources, then over them.
4. Each block puts its own levels and its upper proof together, folds every
   leaf, or the changed leaf that a row claims, up to a root, and compares.

Bounds: a block has at most 4,096 leaves, a meeting 16 members, a proof 15
digests a level.  The driver sees only the number of rounds.

Defined cases: a null field counts as ``-``, an empty one as ``0:``; a null
source is a source of its own and comes first; null ids come first within
their source; rows with equal source and id are ordered by their digests, and
wholly equal rows are leaves of their own (in any order, as they are alike); a
source with one leaf has it as subroot; a table with one source has its
subroot as root; an empty table gives an empty result; other columns are never
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import forget, staged

#: Fixed value: children of a node.
FANOUT = 16
#: Levels of a block: its leaves are FANOUT ** HEIGHT at most.
HEIGHT = 3
#: Characters of a digest.
DIGITS = 64


def field(value: Column) -> Column:
    """One field of a leaf as text."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*fields: Column) -> Column:
    """The digest of a row, as hex text."""
    return F.sha2(F.concat(*map(field, fields)), 256)


def numbered(rows: DataFrame, order: list[str], weight: str | None = None) -> DataFrame:
    """``rows`` (stored) with ``part``, the range they fell into, and ``place``.

    ``place`` counts the rows before a row in the given order, or adds up
    their ``weight``.  Only one count for each range is put in sequence.
    """
    part = F.spark_partition_id()
    spread = staged(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("*", part.alias("part"), (F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33)).alias("place")),
        "ranges",
    )
    if weight is None:
        counted = F.count(F.lit(1))
    else:
        counted = F.sum(weight)
        before = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
        spread = spread.withColumn("place", F.coalesce(F.sum(weight).over(before), F.lit(0)))
    # a row for each range: as many as shuffle partitions
    ranges = spread.groupBy("part").agg(counted.alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    return spread.join(offsets, "part").withColumn("place", F.col("place") + F.col("offset")).drop("offset")


def placed(leaves: DataFrame, height: int) -> DataFrame:
    """The leaves with their block (numbered over all sources) and their place in it.

    With them come the rank and size of their source and ``node``, the place of
    the block in it.
    """
    ordered = staged(numbered(leaves, ["source", "id", "leaf", "row"]), "ordered")
    spans = staged(ordered.groupBy("source", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")), "spans")
    sources = spans.groupBy("source").agg(F.min("first").alias("first"), F.sum("n").alias("size"))
    sources = sources.withColumn("blocks", F.ceil(F.col("size") / FANOUT**height))
    ranked = staged(numbered(staged(sources, "sources"), ["first"]).withColumnRenamed("place", "rank").drop("part"), "ranked")
    ranked = staged(numbered(ranked, ["first"], "blocks").withColumnRenamed("place", "block0").drop("part"), "blocks")
    # by source and range, so that a hot source is not one key
    where = spans.select("source", "part").join(
        ranked.select(F.col("source").alias("s"), "first", "size", "block0", "rank"), F.col("source").eqNullSafe(F.col("s"))
    )
    where = where.drop("source").withColumnRenamed("part", "p")
    at = F.col("place") - F.col("first")
    found = ordered.join(where, (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s"))).select(
        "rank",
        F.floor(at / FANOUT**height).alias("node"),
        (F.col("block0") + F.floor(at / FANOUT**height)).alias("block"),
        F.pmod(at, F.lit(FANOUT**height)).cast("int").alias("at"),
        "size",
        "id",
        "leaf",
        "claimed",
    )
    return staged(found, "placed")


def H(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def local_levels(size: int, height: int) -> int:
    """Levels that a block of a source with ``size`` leaves has below its root."""
    levels = 0
    while levels < height and FANOUT**levels < size:
        levels += 1
    return levels


def climb(digests: list[str], levels: int) -> tuple[list[list[str]], str]:
    """The joined digests of each run, level by level, and the root of the block."""
    runs = []
    for _ in range(levels):
        joined = ["".join(digests[i : i + FANOUT]) for i in range(0, len(digests), FANOUT)]
        runs.append(joined)
        digests = [H(run) for run in joined]
    return runs, digests[0]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of each block, across the borders of batches; the rows come ordered by block."""
    rest: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if rest and row["block"] != rest[0]["block"]:
                yield rest
                rest = []
            rest.append(row)
    if rest:
        yield rest


def block_roots(batches: Iterator[pa.RecordBatch], height: int) -> Iterator[pa.RecordBatch]:
    """(rank, size, node, block, digest): the root of each block."""
    for rows in _blocks(batches):
        head = rows[0]
        _, root = climb([r["leaf"].hex() for r in rows], local_levels(head["size"], height))
        yield pa.RecordBatch.from_pydict(
            {c: pa.array([head[c]], pa.int64()) for c in ("rank", "size", "node", "block")} | {"digest": [root]}
        )


def butterfly(state: DataFrame, level: int) -> list[DataFrame]:
    """The rounds in which the blocks of each tree come to know their siblings.

    ``state`` has tree, node (the subtree a block stands below), nodes (of the
    tree at this level), lane (of the block among those below its node), held
    (blocks below its node), block and digest (of the node).  Each round is a
    table of the same columns one level up, with level, left and right.
    Rows of trees that are whole before the first round are in none.
    """
    rounds = []
    most = state.agg(F.max("nodes")).first()[0] or 1
    state = state.where("nodes > 1").withColumn("parent", F.floor(F.col("node") / FANOUT))
    while most > 1:
        # the subtrees of a parent differ in the blocks below them where sources do
        lanes = state.groupBy("tree", "parent").agg(F.max("held").alias("lanes"))
        sent = state.join(lanes, ["tree", "parent"]).withColumn(
            "meets", F.explode(F.expr("sequence(lane, lanes - 1, held)"))
        )
        member = F.struct("node", "digest", "held", "lane", "block")
        met = sent.groupBy("tree", "parent", "meets", "nodes").agg(F.array_sort(F.collect_list(member)).alias("members"))

        def joined(some: Column) -> Column:
            return F.concat_ws("", F.transform(some, lambda m: m["digest"]))

        def blocks(some: Column) -> Column:
            return F.aggregate(some, F.lit(0).cast("long"), lambda a, m: a + m["held"])

        earlier = F.slice("members", F.lit(1), F.col("place"))
        later = F.slice("members", F.col("place") + 2, F.lit(FANOUT))
        state = staged(
            met.withColumn("whole", joined(F.col("members")))
            .withColumn("digest", F.sha2("whole", 256))
            .select("*", F.posexplode("members").alias("place", "own"))
            .where("own.lane = meets")  # a block that only serves this lane has its answer in its own
            .select(
                "tree",
                F.col("parent").alias("node"),
                F.ceil(F.col("nodes") / FANOUT).alias("nodes"),
                (F.col("own.lane") + blocks(earlier)).alias("lane"),
                blocks(F.col("members")).alias("held"),
                F.col("own.block").alias("block"),
                "digest",
                F.lit(level).alias("level"),
                joined(earlier).alias("left"),
                joined(later).alias("right"),
            ),
            "round",
        )
        rounds.append(state)
        level += 1
        most = -(-most // FANOUT)
        state = state.where("nodes > 1").withColumn("parent", F.floor(F.col("node") / FANOUT)).drop("level", "left", "right")
    return rounds


def proofs(roots: DataFrame, height: int) -> DataFrame:
    """(block, subroot, root, path): what each block holds after the exchange.

    ``roots`` has the rows of :func:`block_roots` and should be a stored table.
    """
    columns = ["tree", "node", "nodes", "lane", "held", "block", "digest"]
    start = roots.withColumns(
        {"tree": F.col("rank"), "nodes": F.ceil(F.col("size") / FANOUT**height), "lane": F.lit(0).cast("long"),
         "held": F.lit(1).cast("long")}
    ).select(columns)
    within = butterfly(start, 0)
    done = start.where("nodes = 1")
    for some in within:
        done = done.unionByName(some.where("nodes = 1").select(columns))
    done = staged(done, "subroots")
    sources = roots.where("node = 0").count()
    over = done.withColumns({"node": F.col("tree"), "tree": F.lit(0).cast("long"), "nodes": F.lit(sources).cast("long")})
    across = butterfly(over.select(columns), len(within))
    result = done.select("block", F.col("digest").alias("subroot"))
    top = across[-1] if across else done
    result = result.join(top.select("block", F.col("digest").alias("root")), "block")
    step = F.struct("level", "left", "right")
    steps = [some.select("block", step.alias("step")) for some in [*within, *across]]
    if steps:
        every = steps[0]
        for some in steps[1:]:
            every = every.unionByName(some)
        result = result.join(every.groupBy("block").agg(F.array_sort(F.collect_list("step")).alias("path")), "block", "left")
    else:
        result = result.withColumn("path", F.lit(None).cast("array<struct<level:int,left:string,right:string>>"))
    result = staged(result, "proofs")
    forget(done, *within, *across)
    return result


def merkle_manifest(
    docs: DataFrame,
    id: str = "doc_id",
    source: str = "source",
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    claims: dict[str, Column] | None = None,
    claimed: Column | None = None,
    height: int = HEIGHT,
) -> DataFrame:
    """One row for each row of ``docs``: the id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``proof_sha256`` is the H of the siblings of a row, level by level up to
    the root.  Rows for which ``claimed`` holds are verified not as they are but
    with the fields that ``claims`` gives; ``folded_root`` is the root that
    follows from them and the original siblings.  ``height`` is the number of
    levels of a block.
    """
    kind = docs.schema[id].dataType
    own = leaf(*(F.col(c) for c in fields))
    changed = leaf(*((claims or {}).get(c, F.col(c)) for c in fields))
    other = F.when(claimed, F.unhex(changed)) if claimed is not None else F.lit(None).cast("binary")
    leaves = staged(
        docs.select(
            F.col(id).alias("id"), F.col(source).cast("string").alias("source"), F.unhex(own).alias("leaf"), other.alias("claimed"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "leaves",
    )
    dealt = placed(leaves, height)
    in_order = dealt.drop("id", "claimed").repartition("block").sortWithinPartitions("block", "at")
    roots = in_order.mapInArrow(
        lambda batches: block_roots(batches, height), "rank long, size long, node long, block long, digest string"
    )
    held = proofs(staged(roots, "roots"), height)
    # the proof of a block comes before its leaves
    path = held.select("block", F.lit(-1).alias("at"), "subroot", "root", "path")
    rows = dealt.unionByName(path, allowMissingColumns=True).repartition("block").sortWithinPartitions("block", "at")
    out = T.StructType(
        [T.StructField(id, kind)]
        + [T.StructField(c, T.StringType()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]
        + [T.StructField("verified", T.BooleanType())]
    )

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_type = None
        for batch in _typed(batches, seen := []):
            id_type = id_type or seen[0].field("id").type
            head, members = batch[0], batch[1:]
            path = [(s["left"], s["right"]) for s in head["path"] or ()]
            upper = "".join(left + right for left, right in path)
            runs, _ = climb([r["leaf"].hex() for r in members], local_levels(members[0]["size"], height))
            found = {name: [] for name in out.names}
            for at, row in enumerate(members):
                siblings, node = [], at
                for level in runs:
                    run, cut = level[node // FANOUT], node % FANOUT * DIGITS
                    siblings.append((run[:cut], run[cut + DIGITS :]))
                    node //= FANOUT
                digest = (row["claimed"] or row["leaf"]).hex()
                for left, right in (*siblings, *path):
                    digest = H(left + digest + right)
                proof = "".join(left + right for left, right in siblings) + upper
                values = (row["id"], row["leaf"].hex(), head["subroot"], head["root"], H(proof), digest, digest == head["root"])
                for name, value in zip(out.names, values):
                    found[name].append(value)
            found[id] = pa.array(found[id], id_type)
            yield pa.RecordBatch.from_pydict(found)

    return rows.mapInArrow(folded, out)


def _typed(batches: Iterator[pa.RecordBatch], seen: list) -> Iterator[list[dict]]:
    """The blocks of the batches; ``seen`` gets their schema."""

    def noted() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not seen:
                seen.append(batch.schema)
            yield batch

    return _blocks(noted())
