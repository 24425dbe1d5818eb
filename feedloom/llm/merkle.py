"""A Merkle manifest of a dataset: a leaf per row, a tree per group, a tree over the groups, and for
each leaf the proof that leads to the root.

Trees are built by lag and lead windows. A tile is a run of 512 consecutive nodes of a group, and
all three levels inside it are columns of the same sorted rows: the node of level k lies on the row
whose place is a multiple of 8^k, and lag and lead at the fixed offsets j x 8^k, masked by the slot
and the length of the run, are its siblings. The first child of a run hashes the parent. The tops
of the tiles are the rows of the next round, so a tree of n leaves takes log512(n) rounds, whose
number alone the driver decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedloom.llm.common import placed, stored

#: Children of a node, and levels of a tile.
ARITY, LEVELS = 8, 3
TILE = ARITY**LEVELS

PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts one after the other; null if any is."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def encoded(value: Column) -> Column:
    """A field of a leaf: a dash for null, otherwise its length in UTF-8 bytes, a colon, itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*fields: Column) -> Column:
    return digest(*[encoded(f) for f in fields])


def group_key(value: Column) -> Column:
    """A non-null string in the order of the groups: null before all others, these by UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def climbed(nodes: DataFrame, *carried: str) -> DataFrame:
    """The rows of ``nodes`` (g, place, members, h) with the levels of their tiles.

    Level k has ``h{k}`` on the rows that are nodes of it, and on every row the siblings ``left{k}``
    and ``right{k}`` of its ancestor there (null above the group's top, where there is no run).
    ``h{LEVELS}`` is on the first row of a tile.
    """
    rows = nodes.select(
        "g", "place", "members", F.expr(f"place div {TILE}").alias("tile"), F.col("h").alias("h0"), *carried)
    tile = Window.partitionBy("g", "tile").orderBy("place")
    for k in range(LEVELS):
        step = ARITY**k
        here = F.col(f"h{k}")
        slot = F.expr(f"cast((place div {step}) % {ARITY} as int)")
        # Nodes of this level in the group, and in the run of a node.
        count = F.expr(f"(members + {step - 1}) div {step}")
        length = F.least(F.lit(ARITY), count - (F.expr(f"place div {step}") - slot))
        is_node = F.col("place") % step == 0
        has_run = is_node & (count > 1)
        left = [F.when(slot >= j, F.lag(here, j * step).over(tile)).otherwise("") for j in range(ARITY - 1, 0, -1)]
        right = [F.when(slot + j < length, F.lead(here, j * step).over(tile)).otherwise("") for j in range(1, ARITY)]
        rows = rows.withColumns({
            "own_left": F.when(has_run, F.concat(*left)), "own_right": F.when(has_run, F.concat(*right))})
        parent = F.when(slot == 0, digest(here, F.col("own_right")))
        upto = tile.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rows = rows.withColumns({
            f"h{k + 1}": F.when(has_run, parent).when(is_node & (slot == 0), here),
            # The last node of the level at or before a row is the row's ancestor.
            f"left{k}": F.last("own_left", ignorenulls=True).over(upto),
            f"right{k}": F.last("own_right", ignorenulls=True).over(upto),
        }).drop("own_left", "own_right")
    return rows


def tops(nodes: DataFrame) -> DataFrame:
    """The nodes that are LEVELS above ``nodes``."""
    return climbed(nodes).where(F.col("place") % TILE == 0).select(
        "g", F.col("tile").alias("place"),
        F.expr(f"(members + {TILE - 1}) div {TILE}").alias("members"), F.col(f"h{LEVELS}").alias("h"))


def rounds(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The nodes at the foot of each round of tiles, at least one, and the groups' tops (g, h)."""
    feet = []
    while True:
        feet.append(nodes)
        nodes = stored(tops(nodes))
        if (nodes.agg(F.max("members")).head()[0] or 0) <= 1:
            return feet, nodes.select("g", "h")


def with_paths(feet: list[DataFrame], above: DataFrame, *carried: str) -> DataFrame:
    """``carried`` and ``h0`` of the lowest of ``feet`` with ``path``: the siblings of the ancestors from
    the leaf up to the group's top and then on as in ``above`` (g, path and more, which stay).

    Each round is joined to the one above by tile, the key by which its windows are laid out too.
    """
    path = above.withColumn("tile", F.lit(0).cast("bigint"))
    for depth in reversed(range(len(feet))):
        own = carried if depth == 0 else ()
        levels = F.filter(
            F.array(*[F.struct(F.col(f"left{k}").alias("left"), F.col(f"right{k}").alias("right"))
                      for k in range(LEVELS)]),
            lambda level: level["left"].isNotNull())
        rest = [c for c in path.columns if c not in ("g", "tile", "path")]
        found = climbed(feet[depth], *own).join(path, ["g", "tile"])
        path = found.select("g", F.col("place").alias("tile"), "h0", *own, *rest,
                            F.concat(levels, F.col("path")).cast(PATH).alias("path"))
        if depth:
            path = path.drop("h0")
    return path.drop("tile")


def folded(start: Column, path: Column) -> Column:
    """The root that ``start`` and the siblings lead to."""
    return F.aggregate(path, start, lambda h, level: digest(level["left"], h, level["right"]))


def siblings(path: Column) -> Column:
    return F.array_join(F.transform(path, lambda level: F.concat(level["left"], level["right"])), "")


def manifest(docs: DataFrame, group: str, order: str, fields: list[str],
             tampered: Column | None = None) -> DataFrame:
    """A row per row of ``docs``: ``grp``, ``id`` (its values of ``group`` and ``order``), ``leaf``, ``subroot``,
    ``root``, ``path`` (left and right siblings per level, from the leaf to the root), ``proof_sha256``,
    ``folded_root`` and ``verified``.

    A leaf is the digest of ``fields``. The leaves of a ``group``, null being one, stand by ``order``,
    null first, and those of equal order by their digest, so that repeated rows have neighbouring
    places; the groups' tops stand by group. ``tampered`` is the digest that is held against the
    manifest instead of the leaf where it isn't null. A row alone in the table is its own root and
    its path is empty. Empty and very long texts are fields like others. An empty table gives an
    empty one. No other column of ``docs`` is read, whatever its name.

    Whole rows are read once, for their digests; all that moves is a narrow row for each.
    """
    own = leaf(*[F.col(f"`{f}`") for f in fields])
    leaves = stored(docs.select(
        F.col(f"`{group}`").alias("grp"), F.col(f"`{order}`").alias("id"), own.alias("h"),
        (F.lit(None).cast("string") if tampered is None else tampered).alias("tampered"))
        .withColumn("g", group_key(F.col("grp"))))
    feet, subroots = rounds(placed(leaves, "g", F.col("id").asc_nulls_first(), "h"))
    names = subroots.select(F.lit("").alias("g"), F.col("g").alias("name"), "h")
    group_feet, root = rounds(placed(names, "g", "name"))
    top = root.select("g", F.col("h").alias("root"), F.array().cast(PATH).alias("path"))
    groups = with_paths(group_feet, top, "name").select(
        F.col("name").alias("g"), F.col("h0").alias("subroot"), "root", "path")
    rows = with_paths(feet, groups, "grp", "id", "tampered")
    return rows.select(
        "grp", "id", F.col("h0").alias("leaf"), "subroot", "root", "path",
        F.sha2(siblings(F.col("path")).cast("binary"), 256).alias("proof_sha256"),
        folded(F.coalesce("tampered", "h0"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
