"""Road graph: endpoint snapping, degrees, spurs, dangling ends, components, issues and actions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from wayfold.operators import components as CC, greedy as GR, tiles as T
from wayfold.operators.joins import within
from wayfold.operators.ordered import with_one_row
from wayfold.session import checkpoint, shuffled


def endpoints(lines: DataFrame) -> DataFrame:
    """Two rows per line (edge_id, ax, ay, bx, by_): end_id = 2*edge_id + side, in file order."""
    side = lambda s, x, y: F.struct(F.lit(s).alias("side"), F.col(x).alias("x"), F.col(y).alias("y"))
    e = lines.select("edge_id", F.explode(F.array(side(0, "ax", "ay"), side(1, "bx", "by_"))).alias("e")).select("edge_id", "e.*")
    return e.withColumn("end_id", (F.col("edge_id") * 2 + F.col("side")).cast("long"))


def snap_endpoints(ends: DataFrame, snap_m: float) -> DataFrame:
    """First-come nodes: an endpoint takes the earliest node within ``snap_m``, else it becomes a node.

    Endpoints further apart than a chain of snap distances never interact, so components that lie inside a tile are walked
    there, by the task that finds them, and only those that cross a border or lie in a crowded tile per component.
    """
    rows, hot, alone = T.tiled(ends, "end_id", snap_m, [], "x", "y")
    lab = CC.whole_parts(T.linked_parts(rows, "end_id", snap_m, "x", "y", owners=True), hot, "end_id", snap_m, [], "x", "y")
    names = ends.columns
    near = lambda a, b: F.hypot(a("x") - b("x"), a("y") - b("y")) <= snap_m
    open_ = checkpoint(lab.filter("_open").select(*names, F.col("label").alias("_grp")))
    walked = GR.greedy_keep(open_, "end_id", ["_grp"], [-F.col("end_id")], snap_m, near).withColumnRenamed("owner", "node_id").select(*names, "node_id")
    return lab.filter("not _open").select(*names, F.col("_owner").alias("node_id")).unionByName(walked).unionByName(alone.withColumn("node_id", F.col("end_id")))


def node_pairs(snapped: DataFrame) -> DataFrame:
    """(edge_id, from_node, to_node) of snapped endpoints."""
    return snapped.groupBy("edge_id").agg(F.max(F.when(F.col("side") == 0, F.col("node_id"))).alias("from_node"), F.max(F.when(F.col("side") == 1, F.col("node_id"))).alias("to_node"))


def degrees(edges: DataFrame) -> DataFrame:
    """Edge ends per node (a loop counts twice)."""
    return edges.select(F.explode(F.array("from_node", "to_node")).alias("node_id")).groupBy("node_id").agg(F.count(F.lit(1)).alias("degree"))


def junctions(edges: DataFrame, min_degree: int, kind: str) -> DataFrame:
    """Nodes with at least ``min_degree`` distinct neighbours, with incident edges and edge kinds."""
    e = edges.filter("from_node <> to_node")
    both = e.select(F.explode(F.array(F.struct(F.col("from_node").alias("node_id"), F.col("to_node").alias("nbr")), F.struct(F.col("to_node").alias("node_id"), F.col("from_node").alias("nbr")))).alias("p"), "edge_id", kind).select("p.*", "edge_id", kind)
    j = both.groupBy("node_id").agg(F.countDistinct("nbr").alias("degree"), F.countDistinct("edge_id").alias("incident"), F.array_sort(F.collect_set(kind)).alias("kinds"))
    return j.filter(F.col("degree") >= min_degree)


def with_degrees(edges: DataFrame) -> DataFrame:
    d = degrees(edges)
    f = d.select(F.col("node_id").alias("from_node"), F.col("degree").alias("deg_from"))
    t = d.select(F.col("node_id").alias("to_node"), F.col("degree").alias("deg_to"))
    return edges.join(shuffled(f), "from_node").join(shuffled(t), "to_node")


def spur_flag(edges: DataFrame, spur_len: float) -> DataFrame:
    """Short dead ends: one end of degree 1 and length under ``spur_len``."""
    d = with_degrees(edges)
    return d.withColumn("spur", ((F.col("deg_from") == 1) | (F.col("deg_to") == 1)) & (F.col("length_m") < spur_len))


def removal_records(removed: DataFrame, spur_len: float) -> tuple[DataFrame, DataFrame]:
    """Issue and action rows of removed spurs; an action names its issue."""
    issue = F.concat(F.lit("spur_"), F.col("edge_id").cast("string"))
    nodes = F.array(F.col("from_node"), F.col("to_node"))
    issues = removed.select(issue.alias("issue_id"), F.array("edge_id").alias("involved_edges"), nodes.alias("involved_nodes"), F.lit("DanglingEnd").alias("rule_failed"),
                            F.lit("S1").alias("severity"), F.array(F.lit("remove_spur")).alias("recommend_actions"), F.lit("E08").alias("error_code"))
    actions = removed.select(F.concat(F.lit("act_"), issue).alias("action_id"), F.lit("RemoveEdge").alias("action_type"), F.lit("DanglingEnd").alias("reason_rule"), nodes.alias("nodes_before"),
                             F.array("edge_id").alias("edges_before"), F.create_map(F.lit("length_m"), F.col("length_m"), F.lit("spur_len_m"), F.lit(float(spur_len))).alias("metrics"), F.array(issue).alias("related_issue_ids"))
    return issues, actions


def merge_dangling(edges: DataFrame, nodes: DataFrame, spur_len: float, merge_tol: float, bucket: str) -> DataFrame:
    """Long dead ends move to the nearest node of the same bucket within ``merge_tol``, by edge id.

    A merge raises the degree of its target, which may cancel the target's own merge later. Such
    chains only run along (dead end -> nearest node) links, so the fold is keyed by the components
    of those links.
    """
    d = with_degrees(edges).filter((F.col("length_m") >= spur_len) & ((F.col("deg_from") == 1) | (F.col("deg_to") == 1)))
    ends = d.select("edge_id", F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(n).alias("node_id"), F.col(g).alias("deg")) for s, n, g in ((0, "from_node", "deg_from"), (1, "to_node", "deg_to"))])).alias("e")).select("edge_id", "e.*").filter("deg = 1")
    here = ends.join(shuffled(nodes), "node_id")
    there = nodes.select(bucket, F.col("node_id").alias("target"), F.col("x").alias("rx"), F.col("y").alias("ry"))
    near = within(here, there, merge_tol, [bucket]).filter("node_id <> target")
    best = near.groupBy("edge_id", "side", "node_id").agg(F.min(F.struct("dist", "target")).alias("m")).select("edge_id", "side", "node_id", F.col("m.target").alias("target"), F.col("m.dist").alias("dist"))
    # both ends of one edge and (dead end -> target) links decide together
    node = lambda c: F.concat(F.lit("n"), F.col(c).cast("string"))
    edge = F.concat(F.lit("e"), F.col("edge_id").cast("string"))
    links = best.select(edge.alias("src"), node("node_id").alias("dst")).unionByName(best.select(node("node_id").alias("src"), node("target").alias("dst")))
    # an end without a target still takes its turn: it shields the other end of its edge
    turn = ends.select("edge_id", "side", "node_id").join(best.select("edge_id").distinct(), "edge_id", "left_semi").join(best, ["edge_id", "side", "node_id"], "left")
    lab = CC.connected_components(links).filter(F.col("id").startswith("e")).select(F.expr("cast(substring(id, 2) as long)").alias("edge_id"), F.col("label").alias("grp"))

    def step(seen, row):
        if row.edge_id == seen.get("edge") or row.node_id in seen["raised"]:
            return None
        seen["edge"] = row.edge_id
        if row.target < 0:
            return None
        seen["raised"].add(row.target)
        return row.edge_id, row.side, row.node_id, row.target, row.dist

    src = turn.join(lab, "edge_id").select("grp", "edge_id", "side", "node_id", F.coalesce("target", F.lit(-1)).alias("target"), F.coalesce("dist", F.lit(0.0)).alias("dist"))
    return GR.ordered_fold(src, ["grp"], ["edge_id", "side"], lambda: {"raised": set()}, step, "edge_id long, side int, node_id long, target long, dist double")


def component_sizes(edges: DataFrame) -> DataFrame:
    cc = CC.connected_components(edges, "from_node", "to_node")
    return cc.groupBy("label").agg(F.count(F.lit(1)).alias("nodes"))


def checks(nodes: DataFrame, edges: DataFrame, issues: DataFrame, actions: DataFrame) -> DataFrame:
    """Summary invariants as rows (check, ok, detail)."""
    deg = degrees(edges)
    one = lambda d, c: d.agg(c.alias("v"))
    n_edges = edges.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("edge_id").alias("u"))
    total = deg.agg(F.sum("degree").alias("s"))
    ends = edges.select(F.explode(F.array("from_node", "to_node")).alias("node_id")).distinct()
    orphan = one(ends.join(nodes.select("node_id"), "node_id", "left_anti"), F.count(F.lit(1)))
    refs = actions.select(F.explode("related_issue_ids").alias("issue_id")).distinct().join(issues.select("issue_id"), "issue_id", "left_anti")
    loose = one(refs, F.count(F.lit(1)))
    row = lambda d, name, ok, detail: d.select(F.lit(name).alias("check"), ok.alias("ok"), detail.cast("long").alias("detail"))
    return (row(n_edges, "edge_ids_unique", F.col("n") == F.col("u"), F.col("n") - F.col("u"))
            .unionByName(row(with_one_row(n_edges, total), "degree_sum", F.col("s") == 2 * F.col("n"), F.col("s")))
            .unionByName(row(orphan, "edge_nodes_exist", F.col("v") == 0, F.col("v")))
            .unionByName(row(loose, "actions_reference_issues", F.col("v") == 0, F.col("v"))))
