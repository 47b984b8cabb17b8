"""A Merkle manifest of a table: one tree per group and one over the groups, and every row's proof by pointer jumping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardtide.llm.common import HIDDEN, landed
from cardtide.operators.skew import join_spread

ID, GROUP, LEAF, ALTERED, SUBROOT, ROOT, PROOF = (f"{HIDDEN}{x}" for x in ("id", "tree", "leaf", "altered", "subroot", "root", "proof"))

#: Nodes of one run, which have one parent.
ARITY = 16

#: The tree over the groups; the groups' own trees are '' (null) and '=' before the name.
_TOP = "top"
_STEP = "struct<before:string,after:string>"
_NODE = ["tree", "level", "idx"]


def leaf_hash(fields: Sequence[Column]) -> Column:
    """Lowercase hex SHA-256 of the values one after another: ``-`` for a null, else UTF-8 byte count, ``:`` and value."""
    parts = []
    for field in fields:
        value = field.cast("string")
        parts.append(F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*parts), 256)


def proof_hash(proof: Column) -> Column:
    """The hash of all siblings of a proof, level by level and from left to right."""
    return F.sha2(F.concat_ws("", F.transform(proof, lambda s: F.concat(s["before"], s["after"]))), 256)


def folded(start: Column, proof: Column) -> Column:
    """The root that a leaf and a proof give."""
    return F.aggregate(proof, start, lambda h, s: F.sha2(F.concat(s["before"], h, s["after"]), 256))


def _placed(rows: DataFrame, key: str, by: Sequence[str], purpose: str) -> DataFrame:
    """``rows`` with ``place``, their number from 0 among those of their ``key`` in the order of ``by``, and ``width``, the number of those.

    Ranges of the order are numbered each by itself; only the ranges' sizes, of which a key has as many as there are
    ranges at most, are added up. So a key of any size is numbered by many tasks.
    """
    ranged = rows.repartitionByRange(key, *by).sortWithinPartitions(key, *by).withColumn("at", F.monotonically_increasing_id())
    ranged = landed(ranged, purpose).withColumn("part", F.shiftright("at", 33))
    parts = ranged.groupBy(key, "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = {"before": F.coalesce(F.sum("n").over(earlier), F.lit(0)), "width": F.sum("n").over(Window.partitionBy(key))}
    parts = landed(parts.withColumns(sums).drop("n"), f"{purpose}-ranges")
    placed = ranged.join(parts, [key, "part"]).withColumn("place", F.col("at") - F.col("first") + F.col("before"))
    return placed.drop("at", "part", "first", "before")


def _siblings(hashes: Column, place: Column) -> Column:
    """The step past the node of a place (from 0) in its run."""
    return F.struct(
        F.concat_ws("", F.slice(hashes, F.lit(1), place)).alias("before"),
        F.concat_ws("", F.slice(hashes, place + 2, F.lit(ARITY))).alias("after"),
    )


def _climbed(runs: DataFrame, purpose: str) -> tuple[DataFrame, DataFrame, int]:
    """All nodes above the leaves from runs of leaves (tree, idx, hashes, width).

    Gives (tree, level, idx, up_level, up_idx, step) of every node that has a parent in its tree; (tree, level, hash)
    of the trees' last nodes; and the number of levels. Each level is a grouping of the one below by runs, a sixteenth
    of its size. A tree of a single leaf has that leaf for its node of level 1.
    """
    whole = F.when(F.col("width") > 1, F.sha2(F.concat_ws("", "hashes"), 256)).otherwise(F.col("hashes")[0])
    nodes = runs.select("tree", "idx", "width", whole.alias("hash"))
    widest = runs.agg(F.max("width")).first()[0] or 0
    links, tops, level, span = None, None, 1, ARITY
    while True:
        last = nodes.where(F.col("width") <= span).select("tree", F.lit(level).alias("level"), "hash")
        tops = last if tops is None else tops.unionAll(last)
        if widest <= span:
            break
        above = (
            nodes.where(F.col("width") > span)
            .groupBy("tree", "width", F.shiftright("idx", 4).alias("idx"))
            .agg(F.array_sort(F.collect_list(F.struct("idx", "hash"))).getField("hash").alias("hashes"))
        )
        above = landed(above, f"{purpose}-level-{level + 1}")
        children = above.select("tree", "idx", "hashes", F.posexplode("hashes").alias("place", "hash"))
        step = children.select(
            "tree", F.lit(level).alias("level"), (F.col("idx") * ARITY + F.col("place")).alias("idx"),
            F.lit(level + 1).alias("up_level"), F.col("idx").alias("up_idx"), _siblings(F.col("hashes"), F.col("place")).alias("step"),
        )
        links = step if links is None else links.unionAll(step)
        # Trees that have ended stay out of the next level.
        nodes = above.select("tree", "idx", "width", F.sha2(F.concat_ws("", "hashes"), 256).alias("hash"))
        level, span = level + 1, span * ARITY
    if links is None:
        links = runs.where("false").select(
            "tree", F.lit(0).alias("level"), "idx", F.lit(0).alias("up_level"), F.col("idx").alias("up_idx"), F.lit(None).cast(_STEP).alias("step")
        )
    return links, tops, level


def manifest(docs: DataFrame, fields: Sequence[str], id_col: str = "doc_id", group_col: str = "source", altered: Column | None = None) -> DataFrame:
    """Every row's proof: ID, GROUP, LEAF, ALTERED, SUBROOT, ROOT and PROOF (array of siblings before and after, from the leaf up).

    A leaf is the hash of a row's ``fields`` (``leaf_hash``). In a group the leaves stand by ``id_col``; rows of one
    id, null ids first, by their hash. As long as there are several nodes, every 16 in a row, and what is left at the
    end, become the hash of their hashes; the last is the group's SUBROOT. The subroots, of the null group first and
    then by the bytes of the names, are put together likewise and give ROOT. ALTERED is ``altered`` (a leaf made of
    other values, or null), passed on.

    Proofs are made by pointer jumping. Every node above the leaves points to its parent and holds the step past its
    siblings; in each round it takes over the pointer of the node it points to, and that one's steps behind its own,
    so distances double and the rounds grow with the logarithm of the height. A leaf, as a member of its run, then
    puts its own step before those of the run's node: proofs of whole rows are made where they are given out, and
    never shuffled. Rows alone of what is put in are shuffled: ids and hashes, no texts.

    Repeated rows are leaves each. An empty table has no rows.
    """
    name = F.col(group_col).cast("string")
    leaves = docs.select(
        F.when(name.isNull(), "").otherwise(F.concat(F.lit("="), name)).alias("tree"),
        F.col(id_col).alias("id"),
        leaf_hash([F.col(c) for c in fields]).alias("leaf"),
        (F.lit(None).cast("string") if altered is None else altered).alias("altered"),
    )
    # Lists of 16 at most.
    runs = (
        _placed(leaves, "tree", ["id", "leaf"], "leaves")
        .groupBy("tree", "width", F.shiftright("place", 4).alias("idx"))
        .agg(F.array_sort(F.collect_list(F.struct("place", "id", "leaf", "altered"))).alias("members"))
    )
    runs = landed(runs.withColumn("hashes", F.col("members.leaf")), "runs")
    links, tops, height = _climbed(runs.select("tree", "idx", "width", "hashes"), "trees")
    subroots = landed(tops.select("tree", "level", "hash"), "subroots")

    n_groups = subroots.count()
    top_runs = (
        _placed(subroots.withColumn("all", F.lit(_TOP)), "all", ["tree"], "groups")
        .groupBy(F.col("all").alias("tree"), "width", F.shiftright("place", 4).alias("idx"))
        .agg(F.array_sort(F.collect_list(F.struct("place", "tree", "level", "hash"))).alias("members"))
    )
    top_runs = landed(top_runs.withColumn("hashes", F.col("members.hash")), "runs-of-groups")
    top_links, top, top_height = _climbed(top_runs.select("tree", "idx", "width", "hashes"), "top")
    found = top.select("hash").first()
    root = found[0] if found else None

    same = [F.col("tree").alias("up_tree"), "up_level", "up_idx", F.array("step").alias("path")]
    pointers = links.unionAll(top_links).select(*_NODE, *same)
    if n_groups > 1:
        member = top_runs.select("idx", "hashes", F.posexplode("members").alias("place", "member"))
        own = [F.col("member.tree").alias("tree"), F.col("member.level").alias("level"), F.lit(0).cast("long").alias("idx")]
        up = [F.lit(_TOP).alias("up_tree"), F.lit(1).alias("up_level"), F.col("idx").alias("up_idx")]
        pointers = pointers.unionAll(member.select(*own, *up, F.array(_siblings(F.col("hashes"), F.col("place"))).alias("path")))
    last = top.select("tree", "level") if n_groups > 1 else subroots.select("tree", "level")
    none = {c: F.lit(None).cast(t) for c, t in (("up_tree", "string"), ("up_level", "int"), ("up_idx", "long"), ("path", f"array<{_STEP}>"))}
    ends = last.select("tree", "level", F.lit(0).cast("long").alias("idx"), *[v.alias(c) for c, v in none.items()])
    pointers = landed(pointers.unionAll(ends.withColumn("path", F.array().cast(f"array<{_STEP}>"))), "pointers-1")
    reach, depth = 1, height - 1 + (top_height if n_groups > 1 else 0)
    while reach < depth:
        pointers = landed(_jumped(pointers), f"pointers-{2 * reach}")
        reach *= 2

    # Runs of leaves with the way from their node to the root; the root itself and nodes below it have arrived by now.
    ways = pointers.where((F.col("level") == 1) & (F.col("tree") != _TOP)).select("tree", "idx", "path")
    own = F.when(F.col("width") > 1, F.array(_siblings(F.col("hashes"), F.col("at")))).otherwise(F.array().cast(f"array<{_STEP}>"))
    return (
        join_spread(runs, subroots.select("tree", F.col("hash").alias(SUBROOT)), ["tree"], ["idx"])
        .join(ways, ["tree", "idx"])
        .select("tree", "width", "hashes", "path", SUBROOT, F.posexplode("members").alias("at", "member"))
        .select(
            F.col("member.id").alias(ID),
            F.when(F.col("tree") != "", F.substring("tree", 2, 1 << 30)).alias(GROUP),
            F.col("member.leaf").alias(LEAF),
            F.col("member.altered").alias(ALTERED),
            SUBROOT,
            F.lit(root).cast("string").alias(ROOT),
            F.concat(own, "path").alias(PROOF),
        )
    )


def _jumped(pointers: DataFrame) -> DataFrame:
    """Every pointer moved on to where the node it leads to points, with that node's steps behind its own."""
    over = ["up_tree", "up_level", "up_idx"]
    # Nodes of level 1 are above leaves only.
    passed = pointers.where((F.col("level") > 1) | (F.col("tree") == _TOP))
    named = [F.col(c).alias(u) for c, u in zip(_NODE, over, strict=True)]
    passed = passed.select(*named, *[F.col(u).alias(f"next_{u}") for u in over], F.col("path").alias("next_path"))
    under_way = join_spread(pointers.where("up_level is not null"), passed, over, _NODE)
    moved = under_way.select(*_NODE, *[F.col(f"next_{u}").alias(u) for u in over], F.concat("path", "next_path").alias("path"))
    return pointers.where("up_level is null").unionAll(moved)
