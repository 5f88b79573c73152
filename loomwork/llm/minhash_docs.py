"""Operator 2, near-duplicate documents by a signature-coordinate inverted join.

A document is the set of its distinct word shingles; documents whose sets agree
to ``num / den`` or more (intersection over union) are linked.

1. Documents with equal sets form a class; its smallest id stands for it.
2. A signature has ``coordinates`` minima.  Each is posted under its coordinate
   and value.  Values that only one class has cannot match and are left out.
3. Two signatures that match in ``matches`` of the coordinates share a posting
   among the ``coordinates - matches + 1`` rarest of either (the prefix), so only
   those are merged.  In each posting the most central member is the hub; a
   member that matches the hub often enough joins its family.  Members of one
   family need no further comparison here (skip merging); postings in which
   several families remain are compared in blocks.
4. Inside a family links are confirmed on the full shingle sets, in tiles of two
   blocks.  Pairs already connected inside a tile are skipped, so a tile yields a
   spanning forest and never all its pairs.
5. Components of the confirmed links give the groups.

A pair of exactly the least similarity fails to match often enough with
probability about 1e-6 (binomial tail at 32 coordinates, 14 matches); every
reported link is confirmed exactly on 64-bit shingle hashes.

Null and empty texts have no shingles, are linked with nothing and are kept.
Rows that share an id count as one document: each is a row of the result, and
what either is linked with, both are.  A row without an id is kept.  An empty table gives an empty result.  Only the key
and text columns are used, so further columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm import vectorwords as vw
from loomwork.llm.components import components
from loomwork.session import materialize

SHINGLE = 4
COORDINATES, MATCHES = 32, 14
BLOCK = 512           # classes on one side of a tile
BUCKET = 4_096        # rows of tiles that one call handles
_TAG = np.int64(~63)  # the low bits of a coordinate's value name the coordinate
_STEP = 1 << 15


def signature(hashes: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Per coordinate the least remixed hash, tagged with the coordinate."""
    low = np.full(len(factors), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), _STEP):
        part = hashes[at:at + _STEP]
        np.minimum(low, (factors[:, None] * (part ^ (part >> np.uint64(29)))[None, :]).min(axis=1), out=low)
    return (vw.as_long(vw.mix(low)) & _TAG) | np.arange(len(factors), dtype=np.int64)


def factors_of(coordinates: int) -> np.ndarray:
    if not 0 < coordinates <= 64:
        raise ValueError("1 to 64 coordinates")
    return vw.mix(np.arange(1, coordinates + 1, dtype=np.uint64) * np.uint64(0x9E37)) | np.uint64(1)


def signatures(docs: DataFrame, key: str, text: str, shingle: int, coordinates: int) -> DataFrame:
    """(id, n_shingles, k1, k2, sig): set size, 128 bits that identify the set, signature (null for no shingles)."""
    def work(batches):
        factors = factors_of(coordinates)
        for batch in vw.slices(batches):
            sets = vw.shingle_sets(batch.column(1), shingle)
            keys = vw.set_keys(sets)
            sigs = [signature(s, factors) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(keys[:, 0]), pa.array(keys[:, 1]),
                 pa.array(sigs, pa.list_(pa.int64()))], ["id", "n_shingles", "k1", "k2", "sig"])

    return docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(
        work, "id bigint, n_shingles bigint, k1 bigint, k2 bigint, sig array<bigint>")


def prefix_postings(classes: DataFrame, coordinates: int, matches: int) -> DataFrame:
    """(token, id, heat, sig): the shared values among each signature's rarest; heat is how common its values are."""
    tokens = classes.select("id", F.explode("sig").alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    held = tokens.join(shared, "token").groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct("df", "token"))).alias("held"),
        F.sum("df").alias("heat"))
    # the values that nothing shares are the rarest and come first in the prefix
    rest = coordinates - matches + 1 - (F.lit(coordinates) - F.size("held"))
    return (held.where(rest > 0)
            .select("id", "heat", F.explode(F.slice("held", 1, rest)).alias("t"))
            .select("t.token", "id", "heat"))


def _matching(a: str, b: str):
    return F.size(F.array_intersect(a, b))


def tiles(members: DataFrame, group: str, block: int) -> DataFrame:
    """The rows (``group``, id, main, ...) once for every tile they belong to.

    Main members of a group are known to be connected, so only minor ones are
    compared: with the main ones in tiles ``kind`` 0 and with each other in tiles
    ``kind`` 1.  A tile has about ``block`` rows of either side; ``side`` tells them
    apart (in a tile of one block with itself all rows have the same side).
    Groups without minor members need no tile.  ``bucket`` collects whole tiles to
    about ``BUCKET`` rows, so small tiles share the cost of a call.
    """
    sizes = materialize(
        members.groupBy(group).agg(F.count_if("main").alias("n_main"), F.count_if(~F.col("main")).alias("n_minor"))
        .where("n_minor > 0 and n_main + n_minor > 1"), "sizes")
    main_blocks = F.ceil(F.col("n_main") / block).cast("long")
    minor_blocks = F.ceil(F.col("n_minor") / block).cast("long")
    rows = sizes.agg(F.sum(F.col("n_main") * minor_blocks + F.col("n_minor") * (main_blocks + minor_blocks))).first()[0]
    buckets = max(1, (rows or 0) // BUCKET)
    own = F.pmod(F.xxhash64("id", F.lit(7)), F.when(F.col("main"), main_blocks).otherwise(minor_blocks))
    placed = members.join(sizes, group).withColumn("own", own)

    def tile(kind, low, high, side):
        return F.struct(F.lit(kind).alias("kind"), low.alias("low"), high.alias("high"), side.alias("side"))

    def upto(n):  # 0..n-1
        return F.filter(F.sequence(F.lit(-1).cast("long"), n - 1), lambda x: x >= 0)

    mine = F.col("own")
    crossed = F.when(F.col("main"), F.transform(upto(minor_blocks), lambda j: tile(0, mine, j, F.lit(0).cast("long")))
                     ).otherwise(F.transform(upto(main_blocks), lambda i: tile(0, i, mine, F.lit(1).cast("long"))))
    among = F.when(F.col("main"), F.array().cast("array<struct<kind:int,low:bigint,high:bigint,side:bigint>>")
                   ).otherwise(F.transform(upto(minor_blocks), lambda j: tile(
                       1, F.least(mine, j), F.greatest(mine, j), mine)))
    return (placed.withColumn("tile", F.explode(F.concat(crossed, among)))
            .select("*", "tile.*").drop("tile", "own", "n_main", "n_minor")
            .withColumn("bucket", F.pmod(F.xxhash64(group, "kind", "low", "high"), F.lit(buckets))))


def per_tile(tiled: DataFrame, group: str, columns: list[str], links) -> DataFrame:
    """(a, b): what ``links(rows, crossed)`` finds in each tile; crossed tiles compare their two sides only."""
    key = [group, "kind", "low", "high"]

    def work(bucket: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int]] = []
        for (_, kind, low, high), rows in bucket.groupby(key, sort=False):
            found += links(rows, kind == 0 or low != high)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return tiled.select("bucket", *key, *columns).groupBy("bucket").applyInPandas(work, "a bigint, b bigint")


class Forest:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return int(i)

    def roots(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if np.array_equal(up, self.parent):
                return up
            self.parent = up

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        self.parent[max(a, b)] = min(a, b)


def family_links(rows: pd.DataFrame, matches: int) -> list[tuple[int, int]]:
    """One link (id, id) for each two families with a pair of members that match often enough."""
    names, at = np.unique(rows["family"].to_numpy(), return_inverse=True)
    links = []
    if len(names) < 2:
        return links
    sigs = np.stack(rows["sig"].to_numpy()) if matches else None
    ids = rows["id"].to_numpy()
    forest = Forest(len(names))
    for i in np.flatnonzero(~rows["main"].to_numpy(dtype=bool)):
        strangers = np.flatnonzero(forest.roots()[at] != forest.root(at[i]))
        enough = strangers[(sigs[strangers] == sigs[i]).sum(axis=1) >= matches] if matches else strangers
        for j in enough:
            if forest.root(at[i]) != forest.root(at[j]):
                forest.join(at[i], at[j])
                links.append((int(ids[i]), int(ids[j])))
    return links


def similar_links(ids: np.ndarray, sets: list[np.ndarray], main: np.ndarray, num: int, den: int,
                  sides: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the pairs with den * intersection >= num * union, beside what connects ``main``.

    Counts all intersections of one member at once through dense shingle numbers.
    With ``sides`` only pairs from different sides are compared.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    _, dense = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    mark = np.zeros(int(dense.max()) + 1, dtype=bool)
    forest = Forest(len(sets))
    hubs = np.flatnonzero(main)
    forest.parent[hubs] = hubs[:1]
    links = []
    for i in np.flatnonzero(~main):
        open_ = forest.roots() != forest.root(i)
        if sides is not None:
            open_ &= sides != sides[i]
        if not open_.any():
            continue
        own = dense[starts[i]:starts[i] + sizes[i]]
        mark[own] = True
        common = np.add.reduceat(mark[dense], starts, dtype=np.int64)
        mark[own] = False
        near = den * common >= num * (sizes + sizes[i] - common)
        for j in np.flatnonzero(near & open_):
            if forest.root(i) != forest.root(int(j)):
                forest.join(i, int(j))
                links.append((int(ids[i]), int(ids[j])))
    return links


def families(postings: DataFrame, classes: DataFrame, matches: int, block: int) -> DataFrame:
    """(id, component, heat): classes that must be compared with each other have one component.

    Without ``matches`` a shared posting is enough, and signatures are not read.
    """
    postings = materialize(postings, "postings")
    hubs = materialize(postings.groupBy("token").agg(
        F.max(F.struct("heat", "id"))["id"].alias("hub"), F.count("*").alias("n"))
        .where("n > 1").select("token", "hub"), "hubs")
    pairs = postings.join(hubs, "token").where("id != hub").select("id", "hub").distinct()
    sigs = classes.select("id", "sig")
    tested = pairs
    if matches:
        tested = pairs.join(sigs, "id").join(
            sigs.select(F.col("id").alias("hub"), F.col("sig").alias("hub_sig")), "hub")
        tested = tested.where(_matching("sig", "hub_sig") >= matches).select("id", "hub")
    near = materialize(tested, "near")
    joined = materialize(components(near, "id", "hub"), "families")
    # postings in which several families remain: members of the hub's family are the main ones
    family = F.coalesce("component", "id")
    placed = postings.join(joined, "id", "left").select("token", "id", family.alias("family"))
    open_ = placed.groupBy("token").agg(F.min("family").alias("x"), F.max("family").alias("y")).where("x != y")
    centre = materialize(
        open_.join(hubs, "token").join(joined.withColumnRenamed("id", "hub"), "hub", "left")
        .select("token", F.coalesce("component", "hub").alias("centre")), "open")
    rest = tiles(placed.join(centre, "token").withColumn("main", F.col("family") == F.col("centre")), "token", block)

    signed, columns = (rest.join(sigs, "id"), ["sig"]) if matches else (rest, [])
    more = materialize(per_tile(signed, "token", ["id", "family", "main", *columns],
                                lambda rows, _: family_links(rows, matches)).distinct(), "bridges")
    found = components(near.select(F.col("id").alias("a"), F.col("hub").alias("b")).union(more))
    return found.join(postings.groupBy("id").agg(F.max("heat").alias("heat")), "id")


def confirmed_links(sets: DataFrame, members: DataFrame, num: int, den: int, block: int) -> DataFrame:
    """(a, b): a spanning forest of the similar pairs of each family.

    ``sets`` has id, family and shingles, ``members`` id, family and heat.
    """
    hubs = materialize(members.groupBy("family").agg(F.max(F.struct("heat", "id"))["id"].alias("id")), "hubs")
    hub_sets = materialize(
        sets.join(hubs, ["family", "id"]).groupBy("family", F.col("id").alias("hub"))
        .agg(F.first("shingles").alias("hub_shingles")), "hub-sets")
    common = _matching("shingles", "hub_shingles")
    tested = sets.join(hub_sets, "family").select(
        "family", "id", "hub", "shingles",
        (den * common >= num * (F.size("shingles") + F.size("hub_shingles") - common)).alias("main"))
    tested = materialize(tested, "tested")

    def confirm(rows, crossed):
        return similar_links(rows["id"].to_numpy(), list(rows["shingles"]), rows["main"].to_numpy(dtype=bool),
                             num, den, rows["side"].to_numpy() if crossed else None)

    rest = per_tile(tiles(tested.drop("hub"), "family", block), "family", ["side", "id", "main", "shingles"], confirm)
    return tested.where("main").select(F.col("id").alias("a"), F.col("hub").alias("b")).union(rest)


def shingle_column(rows: DataFrame, shingle: int) -> DataFrame:
    """(id, family, shingles) from (id, family, text)."""
    def hashed(batches):
        for batch in vw.slices(batches):
            sets = [vw.as_long(s) for s in vw.shingle_sets(batch.column(2), shingle)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sets, pa.list_(pa.int64()))],
                ["id", "family", "shingles"])

    return rows.select("id", "family", "text").mapInArrow(hashed, "id bigint, family bigint, shingles array<bigint>")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    num: int = 80, den: int = 100, coordinates: int = COORDINATES, matches: int = MATCHES,
                    block: int = BLOCK) -> DataFrame:
    """(key, n_shingles, class_id, component_id, kept) per document; see the module."""
    signed = materialize(signatures(docs, key, text, shingle, coordinates), "signatures")
    classes = materialize(
        signed.where("n_shingles > 0 and id is not null").groupBy("k1", "k2", "n_shingles")
        .agg(F.min(F.struct("id", "sig")).alias("s")).select("k1", "k2", "n_shingles", "s.id", "s.sig"), "classes")
    grouped = families(prefix_postings(classes, coordinates, matches), classes, matches, block)
    members = materialize(grouped.select("id", F.col("component").alias("family"), "heat"), "members")
    texts = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"))
    sets = materialize(shingle_column(texts.join(members.select("id", "family"), "id"), shingle), "sets")
    links = materialize(confirmed_links(sets, members, num, den, block), "similar")
    found = components(links).select(F.col("id").alias("class_id"), "component")
    classes = classes.select("k1", "k2", "n_shingles", F.col("id").alias("class_id"))
    named = classes.join(found, "class_id", "left").select(
        "k1", "k2", "n_shingles", "class_id", F.coalesce("component", "class_id").alias("component_id"))
    rows = signed.select("id", "n_shingles", "k1", "k2").join(named, ["k1", "k2", "n_shingles"], "left")
    own = F.col("id")
    return rows.select(
        own.alias(key), "n_shingles",
        F.when(own.isNotNull(), F.coalesce("class_id", "id")).alias("class_id"),
        F.when(own.isNotNull(), F.coalesce("component_id", "id")).alias("component_id"),
        F.coalesce(F.coalesce("component_id", "id") == own, F.lit(True)).alias("kept"))
