"""Sharding by a hierarchical weighted hash tree.

Shards hang below racks and racks below regions.  A row descends the tree: at
each level every child draws ``-ln(u) / weight`` with ``u`` hashed from the
row's key and the child's name, and the smallest draw wins, so a child is
chosen in proportion to its weight.  A child's draw does not depend on its
siblings.  Changing weights in one subtree therefore moves rows only into or
out of that subtree, and a shard that arrives as a region of its own takes rows
only into itself.

Only SQL expressions are used.  The slot of a row inside its shard is found in
two steps, so that no shard passes through one task: rows are counted per
(shard, bucket), running totals of these few counts give each bucket's first
slot, and rows are numbered within their bucket only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets of a shard.  The table of bucket counts has shards x BUCKETS rows at most.
BUCKETS = 1024


@dataclass(frozen=True)
class Topology:
    """``regions[i][j]`` lists the (shard id, weight) pairs of a rack."""

    regions: tuple[tuple[tuple[tuple[int, float], ...], ...], ...]

    @staticmethod
    def regular(shards: int, shards_per_rack: int = 4, racks_per_region: int = 3) -> Topology:
        racks = [
            tuple((s, 1.0) for s in range(a, min(a + shards_per_rack, shards)))
            for a in range(0, shards, shards_per_rack)
        ]
        return Topology(
            tuple(tuple(racks[a : a + racks_per_region]) for a in range(0, len(racks), racks_per_region))
        )

    def grown(self, weight: float = 1.0) -> Topology:
        """One more shard, as a region of its own: rows move only into it."""
        return Topology((*self.regions, (((self.shards(), weight),),)))

    def shards(self) -> int:
        return sum(len(rack) for region in self.regions for rack in region)

    def region_weights(self) -> list[float]:
        return [sum(w for rack in region for _, w in rack) for region in self.regions]

    def rack_weights(self) -> list[list[float]]:
        return [[sum(w for _, w in rack) for rack in region] for region in self.regions]


def _literal(value) -> Column:
    return F.array(*map(_literal, value)) if isinstance(value, (list, tuple)) else F.lit(value)


def hash52(key: Column) -> Column:
    """The first 52 bits of the key's MD5, as a double."""
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double")


def _descend(weights: Column, key: Column) -> Column:
    """Index of the child whose weighted draw is smallest."""

    def draw(w: Column, i: Column) -> Column:
        u = (hash52(F.concat(key, F.lit("/"), i.cast("string"))) + 0.5) / float(2**52)
        return F.struct((-F.log(u) / w).alias("draw"), i.alias("child"))

    return F.array_min(F.transform(weights, draw))["child"]


def shard_of(key: Column, topology: Topology) -> Column:
    """Shard of a string key."""
    region = _descend(_literal(topology.region_weights()), key)
    at_region = F.concat(key, F.lit("/"), region.cast("string"))
    rack = _descend(F.get(_literal(topology.rack_weights()), region), at_region)
    at_rack = F.concat(at_region, F.lit("/"), rack.cast("string"))
    leaves = [[[w for _, w in rack] for rack in region] for region in topology.regions]
    shards = [[[s for s, _ in rack] for rack in region] for region in topology.regions]
    leaf = _descend(F.get(F.get(_literal(leaves), region), rack), at_rack)
    return F.get(F.get(F.get(_literal(shards), region), rack), leaf)


def assign(docs: DataFrame, topology: Topology, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shard, slot, size and checksum of every row of ``docs``.

    Returns ``doc_id, size, text_crc32, shard, grown_shard, slot``.  A null
    text has no bytes; rows with a null id share one key and so one shard.
    Repeated ids fall into the same shard and get slots of their own, ordered
    by checksum and size; further columns of ``docs`` are ignored.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    bucket = F.pmod(hash52(F.concat(key, F.lit("/slot"))), F.lit(float(BUCKETS))).cast("int")
    ids = docs.select(F.col(id_col).alias("doc_id"))
    counts = ids.select(shard_of(key, topology).alias("shard"), bucket.alias("bucket")).groupBy("shard", "bucket").count()
    # One row for each shard and bucket that has rows: bounded by the topology, not by the data.
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    data = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    rows = (
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(data) + 8).cast("bigint").alias("size"),
            F.crc32(data).alias("text_crc32"),
        )
        .withColumn("shard", shard_of(key, topology))
        .withColumn("grown_shard", shard_of(key, topology.grown()))
        .withColumn("bucket", bucket)
    )
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("nth", F.row_number().over(inside))
        .join(F.broadcast(first), ["shard", "bucket"])
        .select(
            "doc_id", "size", "text_crc32", "shard", "grown_shard", (F.col("first") + F.col("nth") - 1).alias("slot")
        )
    )


def sharding_query(spark, sf_dir: str) -> DataFrame:
    """op9: all documents in 24 shards by the ``key`` law."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return assign(docs, Topology.regular(24)).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def _sql_shard(key: str, t: Topology) -> str:
    def draw(weights: str, at: str) -> str:
        u = f"((('0x' || substr(md5({at} || '/' || (i - 1)), 1, 13))::BIGINT)::DOUBLE + 0.5) / {2**52}.0"
        return f"list_transform({weights}, lambda w, i: -ln({u}) / w)"

    def pick(of: str) -> str:
        return f"(list_position({of}, list_min({of})) - 1)"

    leaves = [[[w for _, w in rack] for rack in region] for region in t.regions]
    shards = [[[s for s, _ in rack] for rack in region] for region in t.regions]
    return f"""(SELECT {shards}[r + 1][k + 1][{pick('ld')} + 1] FROM (
        SELECT *, {draw(f'{leaves}[r + 1][k + 1]', f"{key} || '/' || r || '/' || k")} AS ld FROM (
        SELECT *, {pick('kd')} AS k FROM (
        SELECT *, {draw(f'{t.rack_weights()}[r + 1]', f"{key} || '/' || r")} AS kd FROM (
        SELECT *, {pick('rd')} AS r FROM (SELECT {draw(str(t.region_weights()), key)} AS rd))))))"""


def sharding_sql() -> str:
    """The same tree, and checksums byte by byte from a table of the 256 bytes' own."""
    t = Topology.regular(24)
    return f"""
WITH RECURSIVE steps AS (
  SELECT i::BIGINT AS byte, i::BIGINT AS v, 0 AS k FROM range(256) t(i)
  UNION ALL SELECT byte, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM steps WHERE k < 8),
crc AS MATERIALIZED (SELECT list(v ORDER BY byte) AS t FROM steps WHERE k = 8),
sums AS MATERIALIZED (
  SELECT data, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, octet_length(data)),
    lambda i: ('0x' || h[2 * i + 1:2 * i + 2])::BIGINT)), lambda s, b: xor(t[xor(s & 255, b) + 1], s >> 8)), 4294967295) AS sum
  FROM (SELECT DISTINCT encode(coalesce(text, '')) AS data, hex(encode(coalesce(text, ''))) AS h FROM documents), crc),
keyed AS (
  SELECT doc_id, encode(coalesce(text, '')) AS data, coalesce(doc_id::VARCHAR, '') AS key FROM documents),
placed AS (
  SELECT doc_id, data, octet_length(data) + 8 AS size, {_sql_shard('key', t)} AS shard, {_sql_shard('key', t.grown())} AS grown_shard,
    (('0x' || substr(md5(key || '/slot'), 1, 13))::BIGINT) % {BUCKETS} AS bucket
  FROM keyed)
SELECT doc_id, size::BIGINT AS size, sum AS text_crc32, 'key' AS law, shard, grown_shard,
  row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id) - 1 AS slot
FROM placed JOIN sums USING (data)"""
