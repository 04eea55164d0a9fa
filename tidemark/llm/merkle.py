"""A Merkle manifest of a table: a hash tree for each group of rows, a tree over the groups' roots, and each row's proof.

Every level is a table of nodes (tree, place, digest). A level joins itself: each node meets its siblings by their computed places
(``place XOR 1`` in a binary tree, otherwise the other slots of its run one by one). The joined level is written; its
rows in slot zero then give the parents. A last run may be shorter, and one node alone still gets a parent; a tree ends at
its only node. Proofs come down the same levels: a node's path is its own step and its parent's path, so each level is joined
once with the one above, half as large, and no row is joined with every level.

Rows are numbered in each group by a global sort in ranges, so a group of any size is spread over all tasks. The
driver holds the root, the number of levels and the size of the largest group.

Edge cases: a null group is a group of its own and the first; null keys come first in a group. Rows of equal group and
key stand in the order of their leaves. An empty table gives no rows. The kept columns stay inside a struct, so their names
cannot clash.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.ordinal import with_ordinal
from tidemark.session import settle

#: Levels whose paths are joined in one plan before they are written.
PATH_LEVELS = 5
STEP = "array<struct<before: string, after: string>>"


def digest(*parts: Column) -> Column:
    """The lowercase hex SHA-256 of the concatenated parts."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf(*columns: Column | str) -> Column:
    """A row's digest: of each column, ``-`` if null, else its UTF-8 byte count, ``:`` and its value as text."""
    texts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def _div(a: Column | str, b: int) -> Column:
    """``a`` divided by ``b``, rounded down; ``a`` is not negative."""
    a = F.col(a) if isinstance(a, str) else a
    return F.call_function("div", a, F.lit(b).cast("long"))


def _with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """``nodes`` with the digests of their run that stand before and after each, concatenated."""
    slot = F.pmod("place", F.lit(arity))
    found = nodes
    for shift in range(1, arity):
        other = F.col("place").bitwiseXOR(F.lit(1).cast("long")) if arity == 2 else F.col("place") - slot + F.pmod(slot + shift, F.lit(arity))
        near = nodes.select(F.col("tree").alias("of_tree"), F.col("place").alias("of_place"), F.col("digest").alias(f"near_{shift}"))
        # The computed place is a column of its own, so that both sides are hashed by it and the tree.
        found = found.withColumn("other", other).join(near, (F.col("tree") == F.col("of_tree")) & (F.col("other") == F.col("of_place")), "left")
        found = found.drop("of_tree", "of_place", "other")
    # Sibling places rise with the shift up to the end of the run and then start again at slot zero.
    siblings = [(F.pmod(slot + shift, F.lit(arity)), F.col(f"near_{shift}")) for shift in range(1, arity)]
    by_slot = [reduce(F.coalesce, [F.when(at == s, near) for at, near in siblings]) for s in range(arity)]
    before = F.concat(F.lit(""), *[F.coalesce(F.when(F.lit(s) < slot, by_slot[s]), F.lit("")) for s in range(arity - 1)])
    after = F.concat(F.lit(""), *[F.coalesce(F.when(F.lit(s) > slot, by_slot[s]), F.lit("")) for s in range(1, arity)])
    return found.withColumns({"before": before, "after": after}).drop(*[f"near_{shift}" for shift in range(1, arity)])


def levels(leaves: DataFrame, largest: int, arity: int = 2) -> tuple[list[DataFrame], DataFrame]:
    """The levels of all trees, from the leaves up, and their roots (tree, digest).

    ``leaves`` has ``tree``, ``place`` from 0, ``digest`` and ``size``, the number of nodes of the tree on this level, and on the
    first level any other columns. A level has the nodes of trees with more than one, and their siblings' digests.
    """
    made, current, roots = [], leaves, []
    while True:
        roots.append(current.filter("size = 1").select("tree", "digest"))
        if largest <= 1:
            return made, reduce(DataFrame.unionByName, roots)
        made.append(settle(_with_siblings(current.filter("size > 1"), arity)))
        parents = made[-1].filter(F.pmod("place", F.lit(arity)) == 0)
        own = digest(F.col("before"), F.col("digest"), F.col("after")).alias("digest")
        current = parents.select("tree", _div("place", arity).alias("place"), own, _div(F.col("size") + (arity - 1), arity).alias("size"))
        largest = -(-largest // arity)


def paths(made: list[DataFrame], above: DataFrame, sizes: DataFrame, arity: int, carried: Sequence[str] = ()) -> DataFrame:
    """Each leaf with ``path``: the steps up to the root of its tree, then those of ``above`` (tree, path, carried).

    ``sizes`` (tree, size) tells on which level a tree ends. The result has the columns of the first level.
    """
    own = F.array(F.struct(F.col("before"), F.col("after")))
    path_columns = ["tree", "place", "path", *carried]

    def roots(level: int) -> DataFrame:
        """The trees whose only node stands on this level."""
        least, most = arity ** (level - 1) + 1 if level else 1, arity**level
        here = above.join(sizes.filter(F.col("size").between(least, most)).drop("size"), "tree")
        return here.withColumn("place", F.lit(0).cast("long")).select(path_columns)

    current = roots(len(made))
    for level in range(len(made) - 1, -1, -1):
        higher = current.select(F.col("tree").alias("up_tree"), F.col("place").alias("up_place"), F.col("path").alias("up_path"), *carried)
        nodes = made[level].withColumn("up", _div("place", arity))
        joined = nodes.join(higher, (F.col("tree") == F.col("up_tree")) & (F.col("up") == F.col("up_place")))
        joined = joined.withColumn("path", F.concat(own, F.col("up_path"))).drop("up", "up_tree", "up_place", "up_path", "before", "after", "digest", "size")
        if level == 0:
            return joined
        current = joined.select(path_columns).unionByName(roots(level))
        if level % PATH_LEVELS == 0:
            current = settle(current)
    return current


def folded(start: Column, path: Column) -> Column:
    """The root that a digest and its path lead to."""
    return F.aggregate(path, start, lambda node, step: digest(step["before"], node, step["after"]))


def proof(path: Column) -> Column:
    """The digest of all siblings on a path, from the leaf up and from left to right."""
    return digest(F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), ""))


def manifest(rows: DataFrame, group: str, key: str, own: str, keep: Sequence[str], arity: int = 2) -> DataFrame:
    """The columns ``keep`` of each row in a struct ``row``, with its ``leaf``, ``subroot``, ``root`` and ``path``.

    ``own`` names the leaves' digests. A group's leaves stand in the order of ``key``, the groups in their own order (null
    first, text by bytes).
    """
    name = lambda c: F.col(f"`{c}`")
    kept = F.struct(*[name(c) for c in keep]).alias("row")
    prepared = rows.select(kept, name(group).alias("group"), name(key).alias("key"), name(own).alias("digest"))
    # The number makes equal rows different, so that the sort in ranges can part them.
    stored = settle(prepared.withColumn("number", F.monotonically_increasing_id()))
    numbered = with_ordinal(stored, ["group", "key", "digest", "number"], "ordinal").drop("key", "number")
    groups = numbered.groupBy("group").agg(F.min("ordinal").alias("first"), F.count("*").alias("size"))
    groups = settle(with_ordinal(groups, ["group"], "tree"))
    n_groups, largest = groups.agg(F.count("*"), F.max("size")).first()
    ends = groups.select(F.col("group").alias("of_group"), "first", "size", "tree")
    leaves = numbered.join(ends, F.col("group").eqNullSafe(F.col("of_group"))).withColumn("place", F.col("ordinal") - F.col("first"))
    leaves = leaves.withColumn("leaf", F.col("digest")).drop("group", "of_group", "ordinal", "first")
    no_steps = F.array().cast(STEP).alias("path")
    if not n_groups:
        return leaves.select("row", "leaf", F.col("digest").alias("subroot"), F.col("digest").alias("root"), no_steps)

    made, subroots = levels(leaves, largest, arity)
    subroots = settle(subroots)
    size = F.lit(n_groups).cast("long").alias("size")
    top = subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), "digest", size, F.col("tree").alias("of"), F.col("digest").alias("subroot"))
    top_made, roots = levels(top, n_groups, arity)
    root = roots.first()["digest"]
    if top_made:
        zero = rows.sparkSession.range(1).select(F.col("id").alias("tree"), no_steps, size)
        above = paths(top_made, zero.drop("size"), zero.drop("path"), arity).select(F.col("of").alias("tree"), "path", "subroot")
    else:
        above = subroots.select("tree", no_steps, F.col("digest").alias("subroot"))
    above = settle(above)
    columns = ["row", "leaf", "subroot", "path"]
    found = leaves.filter("size = 1").join(above, "tree").select(columns)
    if made:
        found = found.unionByName(paths(made, above, groups.select("tree", "size"), arity, ["subroot"]).select(columns))
    return found.select("row", "leaf", "subroot", F.lit(root).alias("root"), "path")
