"""Communities of a weighted graph: rounds of modularity-improving label moves, refined before levels are joined.

A move can take away the node that held a community together. So communities are not joined as they are: inside each one
nodes grow together again from single ones, along links only, and the parts found become the nodes of the next level. At the
end what is not connected inside a community is told apart by components, which only raises the modularity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.operators.lineage import materialize, stage
from cellweave.operators.skew import SMALL_ROWS
from cellweave.operators.structures import connected

# Fixed value: default resolution of the modularity.
RESOLUTION = 0.5
# No level needs nearly as many rounds; one that does is an error and not a result.
_TOO_MANY_ROUNDS = 2_000


def _totals(state: DataFrame) -> DataFrame:
    return state.groupBy("label").agg(F.sum("degree").alias("label_degree"))


def _moving(node: Column, turn: int) -> Column:
    return F.pmod(F.xxhash64(node, F.lit(turn)), F.lit(2)) == 0


def _move(edges: DataFrame, state: DataFrame, two_m: float, resolution: float, turn: int, small: bool) -> DataFrame:
    """One round: half of the nodes go to the neighbouring label with the best gain.

    Taking turns by a hash keeps two nodes from swapping labels for ever. ``small`` says the
    number of nodes, and with it that of labels, is within the broadcast bound.
    """
    def sized(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if small else df

    # Links are added up per node and label before any further join. A joined node's inner
    # links go where it goes, so they favour no label.
    labels = state.select(F.col("node").alias("dst"), F.col("label").alias("to"))
    links = (edges.where("src <> dst").join(sized(labels), "dst")
             .groupBy(F.col("src").alias("node"), "to").agg(F.sum("weight").alias("links")))
    totals = _totals(state)
    own = state.select("node", F.col("label").alias("own"), "degree")
    stay = state.select("node", F.col("label").alias("to"), F.lit(0.0).alias("links"))
    options = (links.unionByName(stay).join(sized(own), "node")
               .join(sized(totals.withColumnRenamed("label", "to")), "to"))
    stays = F.col("to") == F.col("own")
    without = F.col("label_degree") - F.when(stays, F.col("degree")).otherwise(0.0)
    gain = F.col("links") - F.lit(resolution) * F.col("degree") * without / F.lit(two_m)
    best = (options.withColumn("gain", gain).groupBy("node", "own", "degree")
            .agg(F.max(F.struct(F.round("gain", 12).alias("gain"), (-F.col("to")).alias("order"))).alias("best"),
                 F.max(F.when(stays, F.round("gain", 12))).alias("stay_gain")))
    my_turn = _moving(F.col("node"), turn)
    wants = (F.col("best.gain") > F.col("stay_gain")) & (-F.col("best.order") != F.col("own"))
    return best.select("node", F.when(my_turn & wants, -F.col("best.order")).otherwise(F.col("own")).alias("label"), "degree",
                       wants.alias("wants"))


def _grow(inner: DataFrame, now: DataFrame, two_m: float, resolution: float, turn: int, small: bool) -> DataFrame:
    """One round of refinement: half of the nodes still alone join the linked part with the best gain.

    Only nodes that are alone move, and never to the part of one that may itself move in this round. A part so never loses a
    node, each new one is linked to it, and parts stay connected. Node and part have to be tied to the rest of their
    community by at least what chance would give.
    """
    def sized(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if small else df

    places = now.select("node", "part")
    links = (inner.join(sized(places.select(F.col("node").alias("dst"), F.col("part").alias("to"))), "dst")
             .groupBy(F.col("src").alias("node"), "to").agg(F.sum("weight").alias("links")))
    out = links.join(sized(places), "node").where("to <> part").groupBy("part").agg(F.sum("links").alias("out"))
    parts = now.groupBy("part", "label_degree").agg(F.sum("degree").alias("part_degree"), F.count(F.lit(1)).alias("n"))
    known = parts.join(out, "part", "left").select(
        "part", "part_degree", "n", _tied(F.col("out"), F.col("part_degree"), two_m, resolution).alias("open"))
    alone = (now.where("tied").join(sized(known.where("n = 1").select("part")), "part", "left_semi")
             .select("node", "degree", F.col("part").alias("own")))
    gain = F.round(F.col("links") - F.lit(resolution) * F.col("degree") * F.col("part_degree") / F.lit(two_m), 12)
    options = (links.join(sized(alone), "node").where("to <> own")
               .join(sized(known.where("open").withColumnRenamed("part", "to")), "to").withColumn("gain", gain).where("gain > 0"))
    # A part of one node has that node's number.
    stays = (F.col("n") > 1) | ~_moving(F.col("to"), turn)
    best = options.groupBy("node").agg(F.max(F.when(stays, F.struct("gain", (-F.col("to")).alias("order")))).alias("best"))
    joins = F.col("best").isNotNull() & _moving(F.col("node"), turn)
    return (now.join(best.withColumn("wants", F.lit(True)), "node", "left")
            .select("node", "label", "degree", "label_degree", "tied",
                    F.when(joins, -F.col("best.order")).otherwise(F.col("part")).alias("part"), F.coalesce("wants", F.lit(False)).alias("wants")))


def _tied(links: Column, degree: Column, two_m: float, resolution: float) -> Column:
    """Whether links to the rest of the community are as many as chance would give."""
    chance = F.lit(resolution) * degree * (F.col("label_degree") - degree) / F.lit(two_m)
    return F.round(F.coalesce(links, F.lit(0.0)) - chance, 12) >= 0


def refine(edges: DataFrame, state: DataFrame, two_m: float, resolution: float = RESOLUTION) -> tuple[DataFrame, bool]:
    """(node, label, part) for nodes with labels and degrees: every label's connected parts, and whether any has two nodes."""
    state = stage(state)
    small = state.count() <= SMALL_ROWS
    homes = state.select("node", "label")
    inner = materialize(
        edges.where("src <> dst").join(homes.select(F.col("node").alias("src"), "label"), "src")
        .join(homes.select(F.col("node").alias("dst"), F.col("label").alias("there")), "dst")
        .where("label = there").select("src", "dst", "weight"))
    reach = inner.groupBy(F.col("src").alias("node")).agg(F.sum("weight").alias("reach"))
    now = materialize(
        state.join(_totals(state), "label").join(reach, "node", "left")
        .select("node", "label", "degree", "label_degree",
                _tied(F.col("reach"), F.col("degree"), two_m, resolution).alias("tied"), F.col("node").alias("part")))
    for turn in range(_TOO_MANY_ROUNDS):
        grown = materialize(_grow(inner, now, two_m, resolution, turn, small))
        if grown.where("wants").isEmpty():
            return now.select("node", "label", "part"), not now.where("part <> node").isEmpty()
        now = materialize(grown.drop("wants"))
    raise RuntimeError("parts keep growing; no communities at this resolution")


def connected_parts(edges: DataFrame, member: DataFrame) -> DataFrame:
    """(node, community): the components inside each community, by their smallest member."""
    homes = member.select("node", "community")
    inside = (edges.where("src <> dst").join(homes.select(F.col("node").alias("src"), "community"), "src")
              .join(homes.select(F.col("node").alias("dst"), F.col("community").alias("there")), "dst").where("community = there"))
    roots = connected(inside.select(F.col("src").alias("a"), F.col("dst").alias("b")))
    return member.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("community"))


def twins(graph: DataFrame, two_m: float, resolution: float = RESOLUTION) -> DataFrame:
    """(node, twin): ``twin`` is the smallest node with the same links as the node, which is itself linked to it.

    Two such nodes have a link of their own heaviest weight w and one degree d. Of the two moves that bring them together the
    gains add up to 2 w - 2 resolution d d / 2m, so where that is not below 0 no best labelling needs them apart: they are
    taken for one node. Lists of links are compared by their numbers and by sums of 128 bits of hashes.
    """
    own = (graph.groupBy("src").agg(F.sum("weight").alias("degree"), F.max(F.when(F.col("src") != F.col("dst"), F.col("weight"))).alias("most"))
           .where(F.col("most") * F.lit(two_m) >= F.lit(resolution) * F.col("degree") * F.col("degree")))
    halves = lambda *of: [h for salt in (1, 2) for m in (F.xxhash64(*of, F.lit(salt)),)
                          for h in (m.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(m, 32))]
    marks = [f"mark_{i}" for i in range(4)]
    links = graph.where("src <> dst").groupBy("src").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(h).alias(m) for h, m in zip(halves("dst", "weight"), marks, strict=True)])
    # With itself at its heaviest weight in the list, a node's list is that of its twin.
    closed = links.join(own, "src").select(
        F.col("src").alias("node"), "n", "degree", "most",
        *[(F.col(m) + h).alias(m) for h, m in zip(halves("src", "most"), marks, strict=True)])
    closed = materialize(closed)
    same = ["n", "degree", "most", *marks]
    first = closed.groupBy(*same).agg(F.min("node").alias("twin"), F.count(F.lit(1)).alias("size")).where("size > 1")
    return closed.join(first, same).select("node", "twin")


def _joined(graph: DataFrame, names: DataFrame) -> DataFrame:
    """The graph of the parts of ``names`` (node, part); links inside a part become its link to itself."""
    return materialize(
        graph.join(names.select(F.col("node").alias("src"), F.col("part").alias("a")), "src")
        .join(names.select(F.col("node").alias("dst"), F.col("part").alias("b")), "dst")
        .groupBy(F.col("a").alias("src"), F.col("b").alias("dst")).agg(F.sum("weight").alias("weight")))


def communities(edges: DataFrame, resolution: float = RESOLUTION, refined: bool = True) -> DataFrame:
    """(node, community) from undirected edges (src, dst, weight), listed both ways.

    Within a level labels move until no node gains by moving; each community is refined, its parts become the nodes of the
    next level and start with the community they came from, until no parts grow together. Every community is connected and
    has the number of its smallest member. Without ``refined`` whole communities are joined, as they are. Nodes with the same
    links that are linked to each other are one node from the start.
    """
    graph = first = materialize(edges.select("src", "dst", F.col("weight").cast("double").alias("weight")))
    two_m = graph.agg(F.sum("weight")).first()[0]
    member = graph.select(F.col("src").alias("node")).distinct().withColumn("community", F.col("node"))
    if not two_m:
        return member
    found = materialize(twins(graph, two_m, resolution))
    alike = None
    if not found.isEmpty():
        alike = materialize(member.join(found, "node", "left").select("node", F.coalesce("twin", "node").alias("part")))
        graph = first = _joined(graph, alike)
        member = graph.select(F.col("src").alias("node")).distinct().withColumn("community", F.col("node"))
    start = None
    while True:
        state = graph.groupBy(F.col("src").alias("node")).agg(F.sum("weight").alias("degree"))
        state = state.withColumn("label", F.col("node")) if start is None else state.join(start, "node")
        state = materialize(state.select("node", "label", "degree"))
        small = state.count() <= SMALL_ROWS
        turn = 0
        while True:
            moved = materialize(_move(graph, state, two_m, resolution, turn, small))
            if moved.where("wants").isEmpty():
                break
            state, turn = moved.drop("wants"), turn + 1
            if turn > _TOO_MANY_ROUNDS:
                raise RuntimeError("labels keep moving; no communities at this resolution")
        if refined:
            parts, grown = refine(graph, state, two_m, resolution)
        else:
            parts, grown = state.select("node", "label", F.col("label").alias("part")), turn > 0
        whole = parts.select(F.col("node").alias("community"), "label", "part")
        member = materialize(member.join(whole, "community").select("node", F.col("part" if grown else "label").alias("community")))
        if not grown:
            break
        start = parts.select(F.col("part").alias("node"), "label").distinct() if refined else None
        names = parts.select("node", "part")
        graph = _joined(graph, names)
    if refined:
        member = connected_parts(first, member)
    else:
        smallest = member.groupBy("community").agg(F.min("node").alias("first"))
        member = member.join(smallest, "community").select("node", F.col("first").alias("community"))
    if alike is None:
        return member
    return alike.join(member.withColumnRenamed("node", "part"), "part").select("node", "community")


def modularity(edges: DataFrame, member: DataFrame, resolution: float = RESOLUTION) -> float:
    """Modularity of a labelling of the same undirected graph."""
    names = member.select("node", "community")
    placed = (edges.join(names.select(F.col("node").alias("src"), F.col("community").alias("a")), "src")
              .join(names.select(F.col("node").alias("dst"), F.col("community").alias("b")), "dst"))
    two_m = edges.agg(F.sum("weight")).first()[0]
    inside = placed.where("a = b").agg(F.coalesce(F.sum("weight"), F.lit(0.0))).first()[0]
    squares = (placed.groupBy("a").agg(F.sum("weight").alias("d"))
               .agg(F.sum(F.col("d") * F.col("d"))).first()[0])
    return inside / two_m - resolution * squares / (two_m * two_m)
