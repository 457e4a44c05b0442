"""Pools, quotas, weights and seeded draws of node bundles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PRIORITIZERS = {"inverse_frequency": lambda sampled, alpha: 1 / (1 + alpha * sampled)}


def weight(name: str, sampled: Column, alpha: float = 1.0) -> Column:
    if name not in PRIORITIZERS:
        raise ValueError(f"unknown prioritizer {name!r}; known: {sorted(PRIORITIZERS)}")
    return PRIORITIZERS[name](sampled, alpha)


def breadth_pool(nodes: DataFrame) -> DataFrame:
    """Live nodes no deeper than the median level."""
    own = nodes.where("status <> 'merged'")
    middle = own.agg(F.percentile("level", F.lit(0.5)).alias("m"))  # one row
    return own.crossJoin(F.broadcast(middle)).where("level <= m").select("id")


def depth_pool(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Atomic nodes; leaves if there are none."""
    own = nodes.where("status <> 'merged'")
    atomic = own.where("status = 'atomic'").select("id")
    leaves = own.join(edges.where("relation = 'is_subconcept'").select(F.col("parent").alias("id")), "id", "left_anti").select("id")
    return leaves if atomic.isEmpty() else atomic


def joint_pool(nodes: DataFrame, edges: DataFrame, most: int = 4) -> DataFrame:
    """Distinct groups of 2 to `most` live children of one parent, in order of id."""
    child = edges.where("relation = 'is_subconcept'").join(nodes.where("status <> 'merged'").select(F.col("id").alias("child")), "child").select("parent", "child").distinct()
    group, out = child.select("parent", F.array("child").alias("members")), None
    for _ in range(most - 1):
        group = group.join(child, "parent").where(F.col("child") > F.element_at("members", -1)).select("parent", F.concat("members", F.array("child")).alias("members"))
        out = group if out is None else out.unionByName(group)
    return out.select("members").distinct()


def split_quota(n: int, breadth: float, depth: float, joint: float) -> dict[str, int]:
    """Bundles by intent: breadth and depth are rounded down, joint gets the rest."""
    a, b, c = (max(0.0, x) for x in (breadth, depth, joint))
    total = a + b + c
    if total <= 0:
        return {"breadth": 0, "depth": 0, "joint": n}
    first, second = int(n * a / total), int(n * b / total)
    return {"breadth": first, "depth": second, "joint": n - first - second}


def split_columns(n: Column, breadth: Column, depth: Column, joint: Column) -> Column:
    """split_quota for each row: struct(breadth, depth, joint)."""
    a, b, c = (F.greatest(F.lit(0.0), x) for x in (breadth, depth, joint))
    total = F.when(a + b + c > 0, a + b + c).otherwise(1.0)
    first, second = F.floor(n * a / total).cast("bigint"), F.floor(n * b / total).cast("bigint")
    return F.struct(first.alias("breadth"), second.alias("depth"), (n - first - second).cast("bigint").alias("joint"))


def seeded(seed: int, *values: Column | str) -> Column:
    """A uniform number in (0, 1) from an MD5 of the values, the same on every run and engine."""
    text = F.concat_ws("|", F.lit(str(seed)), *[(F.col(v) if isinstance(v, str) else v).cast("string") for v in values])
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("bigint") + 0.5) / float(1 << 52)


def _arrivals(seed: int, name: str, weight_: Column, most: Column) -> Column:
    """Times of a unit's picks 1, 2, ... `most`: sums of exponential waits of rate weight, so the next pick of all units is a weighted choice."""
    waits = F.transform(F.sequence(F.lit(1), most), lambda i: -F.log(seeded(seed, name, i)) / F.greatest(weight_, F.lit(1e-12)))
    step = lambda a, x: F.struct((a["t"] + x).alias("t"), F.concat(a["all"], F.array(a["t"] + x)).alias("all"))
    return F.aggregate(waits, F.struct(F.lit(0.0).alias("t"), F.array().cast("array<double>").alias("all")), step, lambda a: a["all"])


def _left(pool: DataFrame, used: DataFrame | None, cap: int) -> DataFrame:
    """pool with `left`, how often each id may still be picked; used(id, n) are earlier picks, of other intents too."""
    if used is None:
        return pool.withColumn("left", F.lit(cap))
    return pool.join(used.select("id", "n"), "id", "left").withColumn("left", (F.lit(cap) - F.coalesce("n", F.lit(0))).cast("int")).drop("n").where("left > 0")


def draw(pool: DataFrame, sampled: DataFrame, n: int, *, seed: int, cap: int, alpha: float = 1.0, used: DataFrame | None = None, prioritizer: str = "inverse_frequency") -> DataFrame:
    """(id, pick, ord): n picks at most, of a node `cap` at most less what was used; ord is their order.

    First each node once, in a seeded order; then picks by weight with replacement, until the nodes' caps. Weights stay as they were.
    """
    w = weight(prioritizer, F.coalesce("times_sampled", F.lit(0)), alpha)
    own = _left(pool.select("id").distinct(), used, cap).join(sampled, "id", "left").withColumn("w", w)
    times = F.when(F.col("left") > 1, _arrivals(seed, "id", F.col("w"), F.col("left") - 1)).otherwise(F.array().cast("array<double>"))
    keys = F.concat(F.array(seeded(seed, "id")), F.transform(times, lambda t: t + 1))
    picks = own.select("id", F.posexplode(keys).alias("pick", "ord"))
    return picks.orderBy("ord", "id", "pick").limit(n).select("id", (F.col("pick") + 1).alias("pick"), "ord")


def draw_groups(pool: DataFrame, sampled: DataFrame, n: int, *, seed: int, cap: int, alpha: float = 1.0, used: DataFrame | None = None, prioritizer: str = "inverse_frequency") -> DataFrame:
    """(members, pick, ord): n picks of groups at most, such that no node is in more than `cap` picks less what was used.

    First groups in a seeded order that share no node with one taken before; then picks by the sum of the members' weights with
    replacement, each taken if all its members have room. Both go by rounds: a round takes all picks that come first for each of their
    members, as far as the members' rooms allow, so rounds follow the groups that hang together, and the result is that of one pass.
    """
    from lodestone.plans.durable import durable

    w = weight(prioritizer, F.coalesce("times_sampled", F.lit(0)), alpha)
    one = pool.select("members", F.explode("members").alias("id"))
    rooms = durable(_left(one.select("id").distinct(), used, cap), "rooms")
    own = one.join(sampled, "id", "left").join(rooms, "id", "left").groupBy("members").agg(F.sum(w).alias("w"), F.min(F.coalesce("left", F.lit(0))).alias("left")).where("left > 0")
    own = durable(own.withColumn("name", F.array_join("members", "|")), "groups")

    # the coverage pass: each node in one group at most
    first = _by_rounds(own.select("members", F.lit(0).alias("pick"), seeded(seed, "name").alias("ord")), rooms.select("id", F.lit(1).alias("left")), n)
    have = first.count()
    if have >= n:
        return first.orderBy("ord", "members").limit(n)
    taken = first.select(F.explode("members").alias("id")).groupBy("id").agg(F.count("*").alias("c"))
    rest = durable(rooms.join(taken, "id", "left").select("id", (F.col("left") - F.coalesce("c", F.lit(0))).alias("left")), "rooms")
    times = own.select("members", F.posexplode(_arrivals(seed + 1, "name", F.col("w"), F.col("left"))).alias("pick", "ord"))
    more = _by_rounds(times.select("members", (F.col("pick") + 1).alias("pick"), (F.col("ord") + 1).alias("ord")), rest, n - have)
    return first.unionByName(more.orderBy("ord", "members", "pick").limit(n - have))


def _by_rounds(picks: DataFrame, rooms: DataFrame, n: int) -> DataFrame:
    """Of picks(members, pick, ord) those that one pass by ord takes, each if all its members have room in rooms(id, left)."""
    from lodestone.plans.durable import durable

    open_, taken = durable(picks, "picks"), None
    while True:
        each = open_.select("members", "pick", "ord", F.explode("members").alias("id"))
        place = F.row_number().over(Window.partitionBy("id").orderBy("ord", "members", "pick"))
        ranked = each.withColumn("place", place).join(rooms, "id", "left").withColumn("fits", F.col("place") <= F.coalesce("left", F.lit(0)))
        now = durable(ranked.groupBy("members", "pick", "ord").agg(F.min("fits").alias("fits")).where("fits").drop("fits"), "taken")
        taken = now if taken is None else taken.unionByName(now)
        gone = now.select(F.explode("members").alias("id")).groupBy("id").agg(F.count("*").alias("c"))
        rooms = durable(rooms.join(gone, "id", "left").select("id", (F.col("left") - F.coalesce("c", F.lit(0))).alias("left")), "rooms")
        full = open_.select("members", F.explode("members").alias("id")).join(rooms.where("left > 0"), "id", "left_anti").select("members").distinct()
        open_ = durable(open_.join(full, "members", "left_anti").join(now.select("members", "pick"), ["members", "pick"], "left_anti"), "picks")
        if open_.isEmpty():
            return taken


def draw_all(nodes: DataFrame, edges: DataFrame, sampled: DataFrame, quota: dict[str, int], *, seed: int, cap: int, alpha: float = 1.0, max_group: int = 4, prioritizer: str = "inverse_frequency") -> DataFrame:
    """(intent, nodes, pick): breadth, then depth, then joint, with one cap of picks of a node over all three."""
    from lodestone.plans.durable import durable

    weight(prioritizer, F.lit(0))
    how = {"seed": seed, "cap": cap, "alpha": alpha, "prioritizer": prioritizer}
    out, used = None, None
    for intent in ("breadth", "depth", "joint"):
        if intent == "joint":
            found = draw_groups(joint_pool(nodes, edges, max_group), sampled, quota[intent], used=used, **how).select(F.col("members").alias("nodes"), "pick")
        else:
            pool = breadth_pool(nodes) if intent == "breadth" else depth_pool(nodes, edges)
            found = draw(pool, sampled, quota[intent], used=used, **how).select(F.array("id").alias("nodes"), "pick")
        found = durable(found.select(F.lit(intent).alias("intent"), "nodes", "pick"), "drawn")
        out = found if out is None else out.unionByName(found)
        used = durable(out.select(F.explode("nodes").alias("id")).groupBy("id").agg(F.count("*").alias("n")), "used")
    return out


def count_samples(nodes: DataFrame, drawn: DataFrame) -> DataFrame:
    """nodes with times_sampled grown by the picks of each."""
    picks = drawn.select(F.explode("nodes").alias("id")).groupBy("id").agg(F.count("*").alias("_picks"))
    old = F.col("times_sampled") if "times_sampled" in nodes.columns else F.lit(0)
    return nodes.join(picks, "id", "left").withColumn("times_sampled", (F.coalesce(old, F.lit(0)) + F.coalesce("_picks", F.lit(0))).cast("bigint")).drop("_picks")


def assemble(bundles: DataFrame, nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """bundles(bundle_id, intent, nodes) with level (the deepest member's) and ancestor_paths, a map from node to path."""
    one = bundles.select("bundle_id", "intent", "nodes", F.explode("nodes").alias("id")).join(nodes.select("id", "level"), "id").join(paths, "id", "left")
    path = F.coalesce("path", F.array().cast("array<string>"))
    return one.groupBy("bundle_id").agg(F.first("intent").alias("intent"), F.first("nodes").alias("nodes"), F.max("level").alias("level"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("id", path.alias("path"))))).alias("ancestor_paths"))


def frontier_order(queue: DataFrame, policy: str) -> DataFrame:
    """queue(id, seed, level, seq) with pos, the order in which nodes are taken.

    bfs: first in, first out; dfs: last in, first out; balanced: the seeds in turn, and for each its deepest node first.
    """
    if policy not in ("bfs", "dfs", "balanced"):
        raise ValueError(f"queue_policy must be bfs, dfs or balanced, not {policy!r}")
    first = queue.withColumn("_n", F.row_number().over(Window.partitionBy("id").orderBy("seq"))).where("_n = 1").drop("_n")
    if policy == "balanced":
        turn = F.row_number().over(Window.partitionBy("seed").orderBy(F.desc("level"), "seq"))
        bucket = F.min("seq").over(Window.partitionBy("seed"))
        first = first.withColumn("_t", turn).withColumn("_b", bucket)
        order = ["_t", "_b"]
    else:
        order = ["seq" if policy == "bfs" else F.desc("seq")]
    from lodestone.plans.durable import numbered

    return numbered(first, [*order, "id"], "pos").drop("_t", "_b")


def is_atomic(level: Column, n_materials: Column, rate: Column, overlap: Column, *, max_depth: int = 6, min_materials: int = 5, min_rate: float = 0.7, max_overlap: float = 0.5) -> Column:
    enough = (n_materials >= min_materials) & (rate.isNull() | (rate >= min_rate)) & (overlap.isNull() | (overlap < max_overlap))
    return (level >= max_depth) | enough
