"""Sharding by a hierarchical weighted hash tree, in DataFrame expressions only.

A row descends region, rack and shard. On each level every child of the node reached so
far makes a hash draw from the row's key, ``-ln(u) / weight``; the smallest draw wins, so a
child gets a share in proportion to its weight. The draws of other children do not depend on
a changed one: a heavier child only gains rows, a lighter one only loses them, and what moves
stays inside the subtrees whose weights change. A new subtree beside the old regions
therefore takes rows only into itself.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that one task numbers at most, on average.
ROWS_PER_BUCKET = 50_000


@dataclass(frozen=True)
class Node:
    """A region or rack with its children, or a shard (no children); names are unique."""

    name: str
    weight: float
    children: tuple[Node, ...] = ()


def branch(name: str, *children: Node) -> Node:
    """A node that weighs as much as its children."""
    return Node(name, sum(c.weight for c in children), children)


def shard_tree(shards: int, base: int = 16, racks: int = 2, per_rack: int = 2) -> Node:
    """A tree of equally heavy shards named by their numbers.

    The first ``base`` fill regions of ``racks`` racks; each further shard comes as a
    region of its own, so it takes rows only into itself.
    """
    regions = []
    step = racks * per_rack
    for first in range(0, min(shards, base), step):
        own = [Node(str(s), 1.0) for s in range(first, min(first + step, shards, base))]
        cut = [own[i : i + per_rack] for i in range(0, len(own), per_rack)]
        region = f"region{first // step}"
        regions.append(
            branch(region, *(branch(f"{region}.rack{i}", *part) for i, part in enumerate(cut)))
        )
    for s in range(base, shards):
        region = f"region{s - base + base // step}"
        regions.append(branch(region, branch(f"{region}.rack0", Node(str(s), 1.0))))
    return branch("", *regions)


def levels(tree: Node) -> list[list[Node]]:
    """The inner nodes by depth."""
    found, level = [], [tree]
    while level := [n for n in level if n.children]:
        found.append(level)
        level = [c for n in level for c in n.children]
    return found


def key_text(key: Column) -> Column:
    """What is hashed of a key; a null key counts as the text ``null``."""
    return F.coalesce(key.cast("string"), F.lit("null"))


def _digits(text: Column, first: int, count: int) -> Column:
    return F.conv(F.substring(F.md5(text), first, count), 16, 10).cast("long")


def draw(key: Column, name: Column, weight: Column) -> Column:
    """The draw of a child: exponential with the rate ``weight``, fixed by key and name."""
    u = (_digits(F.concat(key, F.lit("/"), name), 1, 13) + 0.5) / F.lit(float(1 << 52))
    return -F.log(u) / weight


def descend(df: DataFrame, key: Column, tree: Node, into: str = "shard") -> DataFrame:
    """Add the number of the shard that each row's key reaches.

    Depth of the tree times its fan-out draws per row; no shuffle. Children without
    weight are never reached. Equal keys reach equal shards, null keys share one.
    """
    key = key_text(key)
    at = F.lit(tree.name)
    for level in levels(tree):
        children = F.create_map(
            *(
                x
                for n in level
                for x in (
                    F.lit(n.name),
                    F.array(
                        *(
                            F.struct(F.lit(c.name).alias("name"), F.lit(c.weight).alias("weight"))
                            for c in n.children
                            if c.weight > 0
                        )
                    ),
                )
            )
        )
        # a node that has no children is a shard already
        drawn = F.transform(
            F.element_at(children, at),
            lambda c: F.struct(draw(key, c["name"], c["weight"]).alias("draw"), c["name"].alias("name")),
        )
        df = df.withColumn(into, F.coalesce(F.array_min(drawn)["name"], at))
        at = F.col(into)
    return df.withColumn(into, F.col(into).cast("int"))


def with_slots(df: DataFrame, key: Column, order: list[str], shard: str = "shard") -> DataFrame:
    """Number the rows of each shard from 0 without gaps.

    Each shard is cut into buckets by a hash of the key and the columns ``order``, as many as keep a bucket
    near ``ROWS_PER_BUCKET`` rows; the counts before a bucket are its first slot and its rows are
    numbered by ``order``, so rows of one key are spread, too. Rows that are equal in all columns are counted
    before they are shuffled and written out again afterwards, very many of them by several tasks.
    """
    sizes = df.groupBy(shard).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    buckets = max(1, math.ceil(sizes / ROWS_PER_BUCKET))
    name = F.concat_ws("/", key_text(key), *(F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in order))
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("_equal"))
    groups = groups.withColumn("_bucket", F.pmod(_digits(name, 14, 12), F.lit(buckets)))
    counts = groups.groupBy(shard, "_bucket").agg(F.sum("_equal").alias("_n"))
    before = Window.partitionBy(shard).orderBy("_bucket")
    first = counts.select(
        shard, "_bucket", (F.sum("_n").over(before) - F.col("_n")).alias("_first")
    )
    inside = Window.partitionBy(shard, "_bucket").orderBy(*order, *(c for c in df.columns if c not in order))
    numbered = groups.join(first, [shard, "_bucket"]).withColumn(
        "_first", F.col("_first") + F.sum("_equal").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_equal")
    )

    def written_out(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_nth", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_equal") - 1)))

    step = F.lit(ROWS_PER_BUCKET).cast("long")
    many = numbered.where(F.col("_equal") > step).withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_equal") - 1, step)))
    many = many.withColumn("_first", F.col("_first") + F.col("_from")).withColumn("_equal", F.least(step, F.col("_equal") - F.col("_from")))
    all_rows = written_out(numbered.where(F.col("_equal") <= step)).unionByName(
        written_out(many.repartition(shard, "_first").drop("_from"))
    )
    return all_rows.withColumn("slot", F.col("_first") + F.col("_nth")).drop("_bucket", "_first", "_equal", "_nth")


def shard_documents(
    docs: DataFrame, shards: int = 16, tree: Node | None = None, grown: Node | None = None
) -> DataFrame:
    """Place documents by ``doc_id`` and number them inside their shards.

    Returns ``doc_id, size, text_crc32, law, shard, slot, grown_shard``: ``size`` is the
    UTF-8 length plus 1 (null text: 1, with the checksum of no bytes), ``grown_shard`` the
    place in the tree with one more shard. Empty input gives no rows, rows with one doc_id
    share a shard, equal ones in any order; other columns are not read. Texts of any length are measured whole.
    """
    tree, grown = tree or shard_tree(shards), grown or shard_tree(shards + 1)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    placed = descend(descend(rows, F.col("doc_id"), tree), F.col("doc_id"), grown, "grown_shard")
    order = ["doc_id", "text_crc32", "size"]
    return with_slots(placed, F.col("doc_id"), order).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )


# ----------------------------------------------------------------------- query


def query(spark, folder: str) -> DataFrame:
    return shard_documents(spark.read.parquet(f"{folder}/documents.parquet"))


def _descent_sql(tree: Node, into: str) -> str:
    before = f"SELECT doc_id, key, '{tree.name}' AS node FROM keyed"
    for level in levels(tree):
        edges = ", ".join(
            f"('{n.name}', '{c.name}', {c.weight!r})" for n in level for c in n.children if c.weight > 0
        )
        before = f"""
          SELECT k.doc_id, k.key, arg_min(e.child, -ln((('0x' || substr(md5(k.key || '/' || e.child), 1, 13))::BIGINT
                 + 0.5) / 4503599627370496.0) / e.weight) AS node
          FROM ({before}) k JOIN (VALUES {edges}) e(parent, child, weight) ON e.parent = k.node
          GROUP BY ALL"""
    return f"{into} AS (SELECT doc_id, node::INTEGER AS shard FROM ({before}))"


def oracle() -> str:
    """DuckDB has no CRC-32: the usual table is built and folded over the bytes."""
    rounds = "SELECT i, i AS c FROM range(256) t(i)"
    for _ in range(8):
        rounds = f"SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END AS c FROM ({rounds})"
    return f"""
      WITH crc AS (SELECT list(c ORDER BY i) AS t FROM ({rounds})),
      keyed AS (SELECT doc_id, coalesce(doc_id::VARCHAR, 'null') AS key FROM documents),
      {_descent_sql(shard_tree(16), "placed")},
      {_descent_sql(shard_tree(17), "grown")},
      body AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
      sized AS (
        SELECT doc_id, (length(h) // 2 + 1)::BIGINT AS size,
          xor(4294967295, list_reduce(
            list_prepend(4294967295::BIGINT, list_transform(range(length(h) // 2), lambda j:
              (position(substr(h, 2 * j + 1, 1) IN '0123456789ABCDEF') - 1) * 16
              + position(substr(h, 2 * j + 2, 1) IN '0123456789ABCDEF') - 1)),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))::BIGINT AS text_crc32
        FROM body, crc),
      n AS (SELECT greatest(1, ceil(max(n) / {ROWS_PER_BUCKET}))::BIGINT AS buckets
            FROM (SELECT count(*) AS n FROM placed GROUP BY shard))
      SELECT doc_id, size, text_crc32, 'key' AS law, p.shard,
        row_number() OVER (PARTITION BY p.shard ORDER BY
          ('0x' || substr(md5(concat_ws('/', doc_id, doc_id, text_crc32, size)), 14, 12))::BIGINT % (SELECT buckets FROM n), doc_id) - 1 AS slot,
        g.shard AS grown_shard
      FROM sized JOIN placed p USING (doc_id) JOIN grown g USING (doc_id)"""
