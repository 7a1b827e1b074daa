"""K-d tree sharding by bytes over metadata of the documents.

Items are groups of equal texts (a group of more than a twentieth of a shard and more than the largest
document is cut into pieces by a hash of the id, so that no group forces a shard's size).  Each item is a
point of metadata: text length, source and language.  A node of the tree that stands for k shards is split at the
weighted quantile floor(k/2)/k along its widest dimension, width being the range of the dimension's values inside
the node over that in the whole table; leaves have reached the target bytes.  A text dimension enters by the rank of the
whole value among the distinct values (numbered over the cluster, joined back).

Quantiles are found over the cluster: a row's place along a dimension is its value with a hash of the item
as the tie breaker, one 62-bit number; a histogram of the weights over 4096 ranges for every open node is
narrowed around the quantile until the range holds one item or under a ten-thousandth of the node.  Only
such histograms (at most 4096 rows for each node of a level) reach the driver.

Rows: the size of a null text is 1 and its crc32 0; null metadata come first; null ids and repeated rows are
rows like any other; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.order import bucketed_position, global_position
from ..session import materialize, shuffle_partitions

BINS = 4096
BITS = 31


def _spread(c: Column) -> Column:
    """A number as one of at most 31 bits that follows its size (null: 0)."""
    return F.coalesce((F.log1p(F.abs(c.cast("double"))) / F.lit(45.0) * F.lit(2.0**BITS - 1)).cast("long"), F.lit(0))


def ranked(rows: DataFrame, col: str, name: str) -> DataFrame:
    """``rows`` with ``name`` in place of the text column ``col``: the rank from 1 of its value among the distinct ones (null: 0), spread
    over 31 bits where there are more."""
    places = global_position(rows.select(F.col(col).alias("_v")).where("_v IS NOT NULL").distinct(), ["_v"], name="_p", with_count="_n")
    over = F.expr(f"greatest(1L, (_n >> {BITS - 1}))")
    places = materialize(places.select("_v", (F.floor(F.col("_p") / over) + 1).cast("long").alias(name)), "kd-ranks")
    out = rows.join(places, F.col(col) == F.col("_v"), "left").drop("_v", col)
    return out.withColumn(name, F.coalesce(name, F.lit(0).cast("long")))


def items(df: DataFrame, id_col: str, text_col: str, dims: list[str], shards: int) -> tuple[DataFrame, DataFrame]:
    """Rows (id, size, crc32, group, piece) and items (group, piece, weight, one number for each dimension)."""
    kinds = dict(df.dtypes)
    text = F.col(f"`{text_col}`").cast("string")
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("_id"),
                     (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
                     F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
                     F.xxhash64(text).alias("g1"), F.xxhash64(F.lit(1), text).alias("g2"),
                     *[F.col(f"`{d}`").alias(f"v{i}") if kinds[d] == "string" else _spread(F.col(f"`{d}`")).alias(f"d{i}") for i, d in enumerate(dims)])
    rows = materialize(rows, "kd-values")
    for i, d in enumerate(dims):
        if kinds[d] == "string":
            rows = ranked(rows, f"v{i}", f"d{i}")
    rows = materialize(rows, "kd-rows")
    total, largest = rows.agg(F.sum("size"), F.max("size")).first()
    limit = max((total or 0) / shards / 20, largest or 1)
    groups = rows.groupBy("g1", "g2").agg(F.sum("size").alias("w"))
    cut = groups.where(F.col("w") > limit).select("g1", "g2", F.ceil(F.col("w") / F.lit(limit / 2)).alias("pieces"))
    rows = rows.join(cut, ["g1", "g2"], "left")
    rows = rows.withColumn("piece", F.when(F.col("pieces").isNull(), 0).otherwise(F.pmod(F.xxhash64("_id"), "pieces")).cast("int")).drop("pieces")
    least = [F.min(f"d{i}").alias(f"d{i}") for i in range(len(dims))]
    points = rows.groupBy("g1", "g2", "piece").agg(F.sum("size").alias("w"), *least)
    tie = F.xxhash64("g1", "g2", "piece").bitwiseAND(F.lit((1 << BITS) - 1))
    places = [F.shiftleft(F.col(f"d{i}"), BITS).bitwiseOR(tie).alias(f"d{i}") for i in range(len(dims))]
    return rows, materialize(points.select("g1", "g2", "piece", "w", *places), "kd-items")


def split_points(points: DataFrame, n_dims: int, shards: int) -> list[dict]:
    """Inner nodes of the tree, parents first: node, dimension, cut (places below it go left) and children;
    a leaf is the number of its shard."""
    spans = points.agg(*[f(f"d{i}") for i in range(n_dims) for f in (F.min, F.max)]).first()
    whole = [((spans[2 * i + 1] or 0) >> BITS) - ((spans[2 * i] or 0) >> BITS) for i in range(n_dims)]      # of the values, without tie breakers
    tree: list[dict] = []
    level = [{"node": 1, "k": shards, "first": 0}]
    while level := [n for n in level if n["k"] > 1]:
        at = with_node(points, tree)
        live = at.where(F.col("node").isin([n["node"] for n in level]))
        stats = {r["node"]: r for r in live.groupBy("node").agg(F.sum("w").alias("w"), *[f(f"d{i}").alias(f"{n}{i}") for i in range(n_dims) for n, f in (("lo", F.min), ("hi", F.max))]).collect()}
        searches = []
        for n in level:
            s = stats.get(n["node"])
            if s is None:  # fewer items than shards
                n |= {"dim": 0, "cut": 0}
                continue
            wide = [((s[f"hi{i}"] >> BITS) - (s[f"lo{i}"] >> BITS)) / whole[i] if whole[i] else 0.0 for i in range(n_dims)]
            d = max(range(n_dims), key=lambda i: wide[i])
            n |= {"dim": d, "lo": s[f"lo{d}"], "hi": s[f"hi{d}"] + 1, "below": 0, "w": s["w"], "want": s["w"] * (n["k"] // 2) / n["k"]}
            searches.append(n)
        _narrow(live, searches)
        for n in level:
            left, k = n["k"] // 2, n["k"]
            tree.append({"node": n["node"], "dim": n["dim"], "cut": n["cut"], "left": left, "right": k - left, "first": n["first"]})
        level = [c for n in level for c in ({"node": 2 * n["node"], "k": n["k"] // 2, "first": n["first"]}, {"node": 2 * n["node"] + 1, "k": n["k"] - n["k"] // 2, "first": n["first"] + n["k"] // 2})]
    return tree


def _narrow(live: DataFrame, searches: list[dict]) -> None:
    """Set ``cut`` of every search: the place nearest to its wanted weight."""
    todo = searches
    while todo:
        bin_of, inside = F.lit(None).cast("long"), F.lit(False)
        for n in todo:
            step = max(1, -(-(n["hi"] - n["lo"]) // BINS))
            n["step"] = step
            place = F.col(f"d{n['dim']}")
            mine = (F.col("node") == n["node"]) & (place >= n["lo"]) & (place < n["hi"])
            bin_of = F.when(mine, F.expr(f"(d{n['dim']} - {n['lo']}L) div {step}L")).otherwise(bin_of)
            inside = inside | mine
        found = live.where(inside).groupBy("node", bin_of.alias("bin")).agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("n")).collect()
        by: dict = {}
        for r in found:
            by.setdefault(r["node"], []).append((r["bin"], r["w"], r["n"]))
        again = []
        for n in todo:
            run = n["below"]
            for b, w, count in sorted(by.get(n["node"], [])):
                if run + w >= n["want"]:
                    lo, step = n["lo"] + b * n["step"], n["step"]
                    if count == 1 or step == 1 or w <= n["w"] * 1e-4:
                        n["cut"] = lo if n["want"] - run < run + w - n["want"] else lo + step
                    else:
                        n |= {"lo": lo, "hi": min(lo + step, n["hi"]), "below": run}
                        again.append(n)
                    break
                run += w
            else:
                n["cut"] = n["hi"]
        todo = again


def with_node(points: DataFrame, tree: list[dict]) -> DataFrame:
    """Points with the number of the tree's node that holds them (children of node i are 2i and 2i + 1)."""
    node = F.lit(1)
    depth = max((t["node"].bit_length() for t in tree), default=0)
    for d in range(1, depth + 1):
        to = node
        for t in tree:
            if t["node"].bit_length() == d:
                to = F.when(node == t["node"], F.when(F.col(f"d{t['dim']}") < t["cut"], 2 * t["node"]).otherwise(2 * t["node"] + 1)).otherwise(to)
        points = points.withColumn("node", to)
        node = F.col("node")
    return points if depth else points.withColumn("node", node)


def shard(df: DataFrame, shards: int | None = None, target_bytes: int | None = None, id_col: str = "doc_id", text_col: str = "text",
          dims: tuple[str, ...] = ("n_chars", "source", "lang")) -> DataFrame:
    """``id_col, size, text_crc32, shard, slot`` of every row, for a number of shards or for their target bytes."""
    if (shards is None) == (target_bytes is None):
        raise ValueError("give either shards or target_bytes")
    if shards is None:
        total = df.agg(F.sum(F.coalesce(F.octet_length(F.col(f"`{text_col}`").cast("string")), F.lit(0)) + 1)).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    rows, points = items(df, id_col, text_col, list(dims), shards)
    tree = split_points(points, len(dims), shards)
    node_shard = {1: 0} if not tree else {}
    for t in tree:
        for child, k, first in ((2 * t["node"], t["left"], t["first"]), (2 * t["node"] + 1, t["right"], t["first"] + t["left"])):
            if k == 1:
                node_shard[child] = first
    to = F.create_map(*[F.lit(x) for kv in node_shard.items() for x in kv])
    placed = with_node(points, tree).select("g1", "g2", "piece", F.element_at(to, F.col("node")).cast("int").alias("shard"))
    out = materialize(rows.join(placed, ["g1", "g2", "piece"]).select("_id", "size", "text_crc32", "shard"), "kd-shards")
    n = max(4, shuffle_partitions(df.sparkSession))
    out = bucketed_position(out, F.pmod(F.xxhash64("_id", "text_crc32"), F.lit(n)), ["_id", "text_crc32", "size"], "shard", "slot")
    return out.select(F.col("_id").alias(id_col), "size", "text_crc32", "shard", "slot")
