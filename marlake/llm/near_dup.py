"""Near duplicates by bottom-k sketches: inverted lists give candidates, sketches filter them, whole sets verify them.

One hash function maps each five-word shingle to 64 bits. A document's sketch is the ``k``
smallest values of its set. Two sets with Jaccard similarity t or more share at least
``least_shared`` sketch values (surely if both sets are no larger than k, else but for a chance of about
1e-8), so they share one of the first values of either sketch in any common order. Taking the
rarest values first keeps the lists of shared passages short.

* Lists of up to ``LIST`` documents give their pairs; the sketch of the union estimates each
  pair's similarity, and pairs that may reach t are compared on their whole sets.
* Documents in longer lists (large groups of near copies, shared passages) are indexed again by
  the rarest values of their whole sets, which is exact. In each of these lists every document
  is first compared with one hub, the document with the least of its own; then only documents
  outside the hub's component are compared with those of other components.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlake.llm.common import lower_ascii, small_side, words
from marlake.session import stage

SHINGLE = 5
PERCENT = 85
SKETCH = 64
LIST = 64
SIGMAS = 6


def shingle_set(w: str, size: int = SHINGLE) -> Column:
    """Sorted distinct hashes of the shingles of the array column ``w``; fewer words make one shingle, none make none."""
    at = F.col(w)
    n = F.size(at)
    each = F.transform(F.sequence(F.lit(0), n - size), lambda i: F.xxhash64(*[at[i + j] for j in range(size)]))
    whole = F.array(F.xxhash64(F.lit("short"), F.concat_ws(" ", at)))
    return F.when(n >= size, F.sort_array(F.array_distinct(each))).when(n > 0, whole).otherwise(F.array().cast("array<bigint>"))


def sets_of(docs: DataFrame, size: int) -> DataFrame:
    """Adds ``_set`` to rows that have ``_t``."""
    return docs.withColumn("_w", words(lower_ascii(F.col("_t")))).withColumn("_set", shingle_set("_w", size)).drop("_w")


def least_shared(n: Column, k: int, percent: int) -> Column:
    """Fewest sketch values that a set of ``n`` shares with any set that it is linked with."""
    t = percent / 100
    sampled = math.floor(k * t - SIGMAS * math.sqrt(k * t * (1 - t)))
    certain = F.ceil(n * percent / 100) - F.greatest(F.lit(0), F.floor(n * 100 / percent) - k)
    return F.when(n <= k, F.greatest(F.lit(1), certain)).otherwise(max(1, sampled)).cast("int")


def index(sets: DataFrame, prefix: Column, values: str) -> DataFrame:
    """Inverted lists over the rarest values: (value, node, n, own, pos), one row per list entry.

    ``values`` is an array column of distinct hashes; the first ``prefix`` values of each row, in
    ascending order of frequency, are indexed. Values that no other row has need no list; they
    only move the others back (``own`` counts them).
    """
    each = sets.select("node", F.explode(values).alias("value"))
    common = each.groupBy("value").count().where("count > 1")
    shared = each.join(common, "value").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("count", "value"))).alias("_v"))
    listed = shared.join(sets.select("node", "n", F.size(values).alias("_m"), prefix.alias("_prefix")), "node")
    own = F.col("_m") - F.size("_v")
    placed = listed.withColumn("own", own).select("node", "n", "own", "_m", "_prefix", F.posexplode("_v").alias("_i", "_x"))
    return placed.where(F.col("own") + F.col("_i") < F.col("_prefix")).select(
        F.col("_x.value").alias("value"), "node", "n", "own", (F.col("own") + F.col("_i")).alias("pos"), F.col("_m").alias("m")
    )


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    a = sets.select(F.col("node").alias("a"), F.col("_set").alias("_a"))
    b = sets.select(F.col("node").alias("b"), F.col("_set").alias("_b"))
    both = F.size(F.array_intersect("_a", "_b"))
    linked = pairs.join(a, "a").join(b, "b").withColumn("_both", both)
    return linked.where(F.col("_both") * 100 >= (F.size("_a") + F.size("_b") - F.col("_both")) * percent).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each node of an edge reaches. Labels spread to neighbours and jump; every round is written."""
    both = stage(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).where("a <> b").distinct(), "edges")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_b")).select("node", F.least("node", "_b").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("_l")), "b").groupBy(F.col("a").alias("node")).agg(F.min("_l").alias("_l"))
        spread = labels.join(near, "node").select("node", F.col("label").alias("_old"), F.least("label", "_l").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("_next"))
        moved = stage(spread.join(jump, "label", "left").select("node", "_old", F.least("label", F.coalesce("_next", "label")).alias("label")), "labels")
        done = moved.where("label <> _old").limit(1).count() == 0
        labels = moved.drop("_old")
        if done:
            return labels


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    sketch: int = SKETCH,
    most_in_list: int = LIST,
    with_rows: bool = False,
) -> DataFrame:
    """Component of every document row: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.

    Two documents are linked if 100 * intersection >= ``percent`` * union for their sets of
    distinct ``shingle``-word shingles (A-Z lower-cased). ``component_id`` is the smallest id that is reached,
    ``kept`` marks the document that bears it. Documents with equal sets are one node from
    the start, so a group of any number of copies costs one row per task.

    Null or empty text, or text without a word, has the empty set and is linked with nothing: its
    component is its own id. Fewer than ``shingle`` words make one shingle. Repeated rows each get
    a row, all with the verdict of their id. A null id can link others but never names a component unless all
    ids in it are null; such a row is kept only then as null (unknown). An empty table gives no
    rows; other columns are ignored. ``with_rows`` adds ``text_hash`` (null text has its own) and ``label``, which names
    a component without regard to ids and is null for the empty set.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("_t"))
    rows = rows.withColumn("_th", F.xxhash64("_t"))
    whole = F.col("_set")
    base = stage(
        sets_of(rows, shingle).select(
            F.monotonically_increasing_id().alias("_row"),
            "doc_id",
            "_th",
            F.size(whole).alias("n"),
            F.xxhash64(whole).alias("_x1"),
            F.xxhash64(F.lit(1), whole).alias("_x2"),
            F.slice(whole, 1, sketch).alias("_sketch"),
        ),
        "sketches",
    )
    same = ["_x1", "_x2", "n"]
    lead = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col("_row").alias("node"), "_th"))
    classes = stage(base.where("n > 0").groupBy(*same).agg(lead.alias("_lead")).select(*same, "_lead.doc_id", "_lead.node", "_lead._th"), "classes")
    nodes = base.select(F.col("_row").alias("node"), "n", "_sketch").join(small_side(classes.select("node")), "node")

    keep = F.size("_sketch") - least_shared(F.col("n"), sketch, percent) + 1
    lists = stage(index(nodes, keep, "_sketch"), "lists")
    sizes = lists.groupBy("value").agg(F.count("*").alias("_of")).where("_of > 1")
    sized = stage(lists.join(sizes, "value"), "lists")
    short, long = sized.where(F.col("_of") <= most_in_list), sized.where(F.col("_of") > most_in_list)

    candidates = stage(estimated(list_pairs(short, percent, sketch), nodes, percent, sketch), "candidates")
    hot = stage(long.select("node").distinct(), "hot")
    wanted = candidates.select(F.col("a").alias("node")).union(candidates.select(F.col("b"))).union(hot).distinct()
    leads = stage(classes.join(wanted, "node").select("node", F.col("doc_id").alias("_id"), F.col("_th").alias("_lt")), "wanted")
    found = rows.join(small_side(leads), F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("_th").eqNullSafe(F.col("_lt")))
    sets = stage(sets_of(found.groupBy("node").agg(F.first("_t").alias("_t")), shingle).select("node", F.size("_set").alias("n"), "_set"), "sets")

    edges = stage(verified(candidates, sets, percent).union(hot_edges(sets.join(hot, "node", "left_semi"), percent)), "links")
    labels = components(edges)
    named = classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    names = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    known = stage(named.join(names, "label").select(*same, "label", "component_id"), "components")
    out = base.select("doc_id", "_th", *same).join(known, same, "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    more = [F.col("_th").alias("text_hash"), "label"] if with_rows else []
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"), (F.col("doc_id") == component).alias("kept"), *more)


def may_link(a: str, b: str, percent: int, k: int | None = None) -> Column:
    """Whether two list entries can still belong to linked documents: by size, and by how much stands behind the shared value."""
    n_a, n_b = F.col(f"{a}.n"), F.col(f"{b}.n")
    alike = (F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * percent)
    behind = F.least(F.col(f"{a}.m") - F.col(f"{a}.pos"), F.col(f"{b}.m") - F.col(f"{b}.pos"))
    need = F.ceil((n_a + n_b) * percent / (100 + percent))
    if k is None:
        return alike & (behind >= need)
    sampled = F.least(least_shared(n_a, k, percent), least_shared(n_b, k, percent))
    return alike & (behind >= F.when(F.greatest(n_a, n_b) <= k, need).otherwise(sampled))


def list_pairs(lists: DataFrame, percent: int, k: int) -> DataFrame:
    """Distinct pairs (a, b), a < b, that share a list and may be linked. Lists are of bounded length."""
    a, b = lists.alias("x"), lists.alias("y")
    on = (F.col("x.value") == F.col("y.value")) & (F.col("x.node") < F.col("y.node")) & may_link("x", "y", percent, k)
    return a.join(b, on).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def estimated(pairs: DataFrame, nodes: DataFrame, percent: int, k: int) -> DataFrame:
    """Pairs whose similarity, estimated on the k smallest values of their union, may reach the limit.

    If both sketches hold their whole sets, the estimate is exact; else it may fall short by
    ``SIGMAS`` standard deviations.
    """
    t = percent / 100
    a = nodes.select(F.col("node").alias("a"), F.col("n").alias("_na"), F.col("_sketch").alias("_sa"))
    b = nodes.select(F.col("node").alias("b"), F.col("n").alias("_nb"), F.col("_sketch").alias("_sb"))
    both = pairs.join(a, "a").join(b, "b")
    exact = (F.col("_na") <= k) & (F.col("_nb") <= k)
    union = F.sort_array(F.array_union("_sa", "_sb"))
    both = both.withColumn("_u", F.when(exact, union).otherwise(F.slice(union, 1, k)))
    shared = F.size(F.array_intersect("_u", F.array_intersect("_sa", "_sb")))
    least = F.when(exact, F.lit(t)).otherwise(t - SIGMAS * math.sqrt(t * (1 - t) / k))
    return both.where(shared >= F.size("_u") * least - 1e-9).select("a", "b")


def hot_edges(sets: DataFrame, percent: int) -> DataFrame:
    """Links among the documents of long lists, enough to give their components.

    Their whole sets are indexed by the rarest values, as many as a linked pair must share one of.
    """
    keep = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    lists = stage(index(sets, keep, "_set"), "hot_lists")
    hubs = lists.groupBy("value").agg(F.min(F.struct((F.col("own") / F.col("n")).alias("o"), "node", "n", "m", "pos")).alias("h"), F.count("*").alias("_of"))
    hubs = stage(hubs.where("_of > 1").select("value", F.col("h.node").alias("node"), F.col("h.n").alias("n"), F.col("h.m").alias("m"), F.col("h.pos").alias("pos")), "hubs")
    x, y = lists.alias("x"), hubs.alias("y")
    on = (F.col("x.value") == F.col("y.value")) & (F.col("x.node") != F.col("y.node")) & may_link("x", "y", percent)
    star = stage(x.join(y, on).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct(), "star")
    links = stage(verified(star, sets, percent), "star_links")

    labels = components(links)
    marked = lists.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    hub_label = hubs.select("value", "node").join(labels, "node", "left").select("value", F.coalesce("label", "node").alias("_hub"))
    marked = stage(marked.join(hub_label, "value"), "marked")
    x, y = marked.where("label <> _hub").alias("x"), marked.alias("y")
    on = (F.col("x.value") == F.col("y.value")) & (F.col("x.label") != F.col("y.label")) & may_link("x", "y", percent)
    rest = x.join(y, on).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
    rest = rest.join(star, ["a", "b"], "left_anti")
    return links.union(verified(stage(rest, "rest"), sets, percent))
