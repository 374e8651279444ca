"""MinHash near-duplicates: classes of documents linked by similar sets of word shingles.

1. Each text becomes its set of shingle hashes (64 bits), a digest of the set, and a sketch of ``BINS`` coordinates
   by fast similarity sketching: in every round each element draws one bin and a value there, the round standing in
   the value's high bits; a bin keeps its smallest value. Rounds go on until every bin is filled; from round
   ``BINS`` on all elements fall into one given bin each, so at most 2 * BINS rounds are needed. Coordinates of two
   sketches agree with probability equal to the similarity, and sums of them keep Chernoff bounds.
2. Texts with equal sets become one node; everything below works on nodes.
3. Bands of some coordinates each give buckets; the asked similarity decides how many (``Terms``). Two sets at that
   similarity miss each other with probability below ``BAND_ODDS``; at 0.85 and 24 bands of 5, sets at 0.9 below 1e-9.
4. First each node is compared with one pivot, of its buckets' smallest nodes the one in most of them; a pair that
   passes the sketch (``Terms.agree`` coordinates) and is similar by its full sets is a link, and joins two components.
5. In buckets that hold several components, pairs across components are compared by sketch (a pair at the threshold fails it with probability below ``AGREE_ODDS``). They connect components to families of
   texts that may belong together. In each family all pairs across components that pass the sketch are decided on their
   full sets. Both steps work in cells of bounded size; the largest component of a group is not compared with
   itself, and a pair whose nodes have been joined in the cell needs no look, so a cell gives fewer links than it has
   components, however many pairs are similar.

So links are exact, and only pairs may be missed, with the odds stated. Sets travel once for each pivot pair and about
once for each member of a family, whatever the number of buckets.

Defined results: null and empty texts, and texts without words, have an empty set and are linked with nothing;
texts of fewer words than a shingle have one element, the whole sequence; equal rows are in one class; rows
with a null id are classed but cannot name a class (a class of such rows alone has a null id). Only the key and text
columns are used, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streetloom.llm.common import WORD_HASHES, map_batches, texts_of
from streetloom.llm.components import connected_components
from streetloom.session import checkpointed

SHINGLE = 3
PERCENT = 85  # of intersection to union
BINS = 120
BAND_ODDS, AGREE_ODDS = 1e-6, 5e-6  # that a pair at the threshold shares no band, or fails the sketch
BLOCK = 2048  # nodes of one side that are compared at once
BLOCK_ELEMENTS = 1_000_000  # and elements of their sets, where these take part
MAX_BROADCAST_KEYS = 1_000_000  # of rows looked up again by a broadcast join

_M1, _M2, _M3 = (np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
_S29, _S32 = np.uint64(29), np.uint64(32)


@dataclass(frozen=True)
class Terms:
    """Words of a shingle and per cent of intersection to union that make texts similar, and what follows for sketches.

    Below 11 per cent even bands of one coordinate miss a pair at the threshold more often than ``BAND_ODDS``.
    """

    size: int = SHINGLE
    percent: int = PERCENT

    def __post_init__(self) -> None:
        if self.size < 1 or not 11 <= self.percent <= 100:
            raise ValueError("size must be at least 1 and percent from 11 to 100")

    @property
    def rows(self) -> int:
        """Most coordinates of a band that keep the odds."""
        alike = self.percent / 100
        return max(r for r in range(1, 7) if r == 1 or (1 - alike**r) ** (BINS // r) <= BAND_ODDS)

    @property
    def bands(self) -> int:
        return BINS // self.rows

    @property
    def agree(self) -> int:
        """Most coordinates that a pair at the threshold fails to reach with no more than the odds."""
        alike, below = self.percent / 100, 0.0
        for k in range(BINS):
            below += math.comb(BINS, k) * alike**k * (1 - alike) ** (BINS - k)
            if below > AGREE_ODDS:
                return k
        return BINS


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> _S32)) * _M1
    values = (values ^ (values >> _S29)) * _M2
    return values ^ (values >> _S32)


def shingle_set(text: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text's lower-cased words."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(WORD_HASHES.__getitem__, words), np.uint64, len(words))
    width = min(size, len(words))
    with np.errstate(over="ignore"):
        out = np.full(len(words) - width + 1, np.uint64(width))
        for k in range(width):
            out = _mixed(out * _M3 + hashes[k : len(words) - width + 1 + k])
    return np.unique(out)


def sketch(elements: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Coordinates, as 16-bit prints of the values drawn, of a set that is not empty.

    Unequal values have equal prints once in 65,536 times, which can only add candidates.
    """
    best = np.full(bins, np.uint64(0xFFFFFFFFFFFFFFFF))
    at = 0
    with np.errstate(over="ignore"):
        while at < 2 * bins and (at == 0 or (best >> np.uint64(52) == np.uint64(4095)).any()):
            # several rounds at once for small sets; rounds beyond the last needed one change nothing that is filled
            rounds = np.arange(at, min(2 * bins, at + max(1, 256 // len(elements))), dtype=np.uint64)
            drawn = _mixed(elements[None, :] + (rounds[:, None] + np.uint64(1)) * _M3)
            bin_of = (drawn % np.uint64(bins)).astype(np.int64)
            late = rounds >= bins
            bin_of[late] = (rounds[late].astype(np.int64) - bins)[:, None]
            values = (rounds[:, None] << np.uint64(52)) | (_mixed(drawn) >> np.uint64(12))
            np.minimum.at(best, bin_of.ravel(), values.ravel())
            at += len(rounds)
        return (_mixed(best) >> np.uint64(48)).astype(np.uint16)


def _node_key(elements: np.ndarray) -> bytes:
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest()


def _row_key(doc_id: str, text: str) -> Column:
    """Finds a row again; what collides is told apart by its node."""
    return F.xxhash64(F.col(doc_id), F.col(text))


def _twin_key(doc_id: str, text: str) -> Column:
    """A second hash, for lookups where a collision would lose a row."""
    return F.xxhash64(F.lit(1), F.col(text), F.col(doc_id))


def _described(docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """doc_id, row, twin, n_shingles, node and sketch of every row; node and sketch are null for an empty set."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, nodes, sketches = [], [], []
        for content in texts_of(batch.column("_text")):
            elements = shingle_set(content, size)
            counts.append(len(elements))
            nodes.append(_node_key(elements) if len(elements) else None)
            sketches.append(sketch(elements).tobytes() if len(elements) else None)
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(counts, pa.int64()), pa.array(nodes, pa.binary()), pa.array(sketches, pa.binary())],
            ["doc_id", "row", "twin", "n_shingles", "node", "sketch"],
        )

    keys = [F.col(doc_id).alias("doc_id"), _row_key(doc_id, text).alias("row"), _twin_key(doc_id, text).alias("twin")]
    read = docs.select(*keys, F.col(text).alias("_text"))
    kind = docs.schema[doc_id].dataType.simpleString()
    return map_batches(read, work, f"doc_id {kind}, row bigint, twin bigint, n_shingles bigint, node binary, sketch binary")


def _buckets(nodes: DataFrame, terms: Terms) -> DataFrame:
    """One row for each node and band."""
    width = 2 * terms.rows
    bands = [F.xxhash64(F.lit(b), F.substring("sketch", b * width + 1, width)) for b in range(terms.bands)]
    return nodes.select("node", F.explode(F.array(*bands)).alias("bucket"))


def _agreeing(pairs: DataFrame, nodes: DataFrame, terms: Terms) -> DataFrame:
    """Pairs (a, b) with sketch agreement and size ratio good enough."""
    for side in ("a", "b"):
        right = nodes.select(F.col("node").alias(side), F.col("sketch").alias(f"s{side}"), F.col("n").alias(f"n{side}"))
        pairs = pairs.join(right, side)
    least = terms.agree

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        first, second = (_matrix(batch.column(c).to_pylist()) for c in ("sa", "sb"))
        return batch.select(["a", "b"]).filter(pa.array((first == second).sum(axis=1) >= least))

    close = (100 * F.least("na", "nb")) >= (terms.percent * F.greatest("na", "nb"))
    return map_batches(pairs.where(close).select("a", "b", "sa", "sb"), work, "a binary, b binary")


def _matrix(sketches: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), np.uint16).reshape(len(sketches), BINS)


def _full_sets(asked: DataFrame, nodes: DataFrame, docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """node and elements of the asked nodes; one text of each is read again."""
    rows = checkpointed(asked.join(nodes, "node").select(F.col("row").alias("_row")).distinct())
    if rows.count() <= MAX_BROADCAST_KEYS:
        rows = F.broadcast(rows)
    found = docs.select(_row_key(doc_id, text).alias("_row"), F.col(text).alias("_text")).join(rows, "_row", "left_semi")

    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [shingle_set(t, size) for t in texts_of(batch.column("_text"))]
        return pa.RecordBatch.from_arrays(
            [pa.array([_node_key(m) for m in made], pa.binary()), pa.array([m.tobytes() for m in made], pa.binary())], ["node", "elements"]
        )

    full = map_batches(found.select("_text"), sets, "node binary, elements binary")
    return checkpointed(full.groupBy("node").agg(F.first("elements").alias("elements")))


def _similar(shared: np.ndarray, first: np.ndarray, second: np.ndarray, percent: int) -> np.ndarray:
    return 100 * shared >= percent * (first + second - shared)


def _confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, doc_id: str, text: str, terms: Terms) -> DataFrame:
    """Pairs (a, b), at most one for each a, whose full sets are similar enough."""
    pairs = checkpointed(pairs)
    asked = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    full = _full_sets(asked, nodes, docs, doc_id, text, terms.size)
    percent = terms.percent
    sided = pairs
    for side in ("a", "b"):
        sided = sided.join(full.select(F.col("node").alias(side), F.col("elements").alias(f"e{side}")), side)

    def check(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for left, right in zip(batch.column("ea").to_pylist(), batch.column("eb").to_pylist(), strict=True):
            first, second = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
            shared = len(np.intersect1d(first, second, assume_unique=True))
            keep.append(bool(_similar(shared, len(first), len(second), percent)))
        return batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return checkpointed(map_batches(sided.select("a", "b", "ea", "eb"), check, "a binary, b binary"))


def _pivot_pairs(buckets: DataFrame) -> DataFrame:
    """Each node (a) with the one smallest node of its buckets (b) with which it shares most of them."""
    pivots = buckets.groupBy("bucket").agg(F.min("node").alias("b"))
    met = buckets.join(pivots, "bucket").where("node <> b")
    shared = met.groupBy("node", "b").agg(F.count("*").alias("shared"))
    best = F.max_by("b", "shared").alias("b")
    return shared.groupBy(F.col("node").alias("a")).agg(best)


def _cells(groups: DataFrame) -> DataFrame:
    """Cells of bounded size in which all nodes of a ``group`` with different ``label`` meet.

    ``groups`` has group, node, label and part, the share of a block that the node fills. The most frequent label of a group is its top: its nodes form blocks of their
    own, which meet the blocks of the others (kind t) but not each other; the others' blocks meet among
    themselves (kind o). Groups of one label have no cell.
    """
    sizes = groups.groupBy("group", "label").agg(F.sum("part").alias("n"))
    several = (
        sizes.groupBy("group")
        .agg(F.sum("n").alias("all"), F.max(F.struct("n", "label")).alias("top"), F.count("*").alias("labels"))
        .where("labels > 1")
        .select(
            "group",
            F.col("top")["label"].alias("top"),
            F.ceil(F.col("top")["n"]).cast("int").alias("tops"),
            F.greatest(F.lit(1), F.ceil(F.col("all") - F.col("top")["n"] - 1e-6)).cast("int").alias("others"),
        )
    )
    placed = groups.join(several, "group").withColumn("is_top", F.col("label") == F.col("top"))
    blocks = F.when(F.col("is_top"), F.col("tops")).otherwise(F.col("others"))
    placed = placed.withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int"))

    def cell(kind: str, left: Column, right: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), left.alias("left"), right.alias("right"))

    others = F.sequence(F.lit(0), F.col("others") - 1)
    top_cells = F.transform(others, lambda j: cell("t", F.col("own"), j))
    other_cells = F.concat(
        F.transform(F.sequence(F.lit(0), F.col("tops") - 1), lambda i: cell("t", i, F.col("own"))),
        F.transform(others, lambda j: cell("o", F.least(j, "own"), F.greatest(j, "own"))),
    )
    return placed.select(
        "group", "node", "label", "is_top", F.explode(F.when(F.col("is_top"), top_cells).otherwise(other_cells)).alias("cell")
    )


def _links_in_cells(cells: DataFrame, nodes: DataFrame, terms: Terms) -> DataFrame:
    """Links (a, b) that join the labels of each cell as far as its similar pairs do, and no more than that.

    Nodes have a sketch and, if a pair's sets are to decide and not its sketches, their elements. A pair is looked
    at only while its nodes are not yet joined, so a cell gives fewer links than it has labels.
    """
    exact = "elements" in nodes.columns
    percent, least = terms.percent, terms.agree
    fields = ["label", "is_top", "node", "n", "sketch", *(["elements"] if exact else [])]
    met = (
        cells.join(nodes, "node")
        .groupBy("group", "cell")
        .agg(F.collect_list(F.struct(*fields)).alias("members"), F.min("label").alias("low"), F.max("label").alias("high"))
        .where("low <> high")
        .select(F.col("cell")["kind"].alias("kind"), "members")
    )

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        left: list[bytes] = []
        right: list[bytes] = []
        for kind, members in zip(batch.column("kind").to_pylist(), batch.column("members"), strict=True):
            for a, b in _joins(kind == "t", members.values, exact, percent, least):
                left.append(a)
                right.append(b)
        return pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], ["a", "b"])

    return map_batches(met, work, "a binary, b binary")


def _joins(across: bool, members: pa.StructArray, exact: bool, percent: int, least: int) -> list[tuple[bytes, bytes]]:
    """Links of one cell; ``across``: only between top and other nodes."""
    ids, sizes = members.field("node").to_pylist(), members.field("n").to_numpy(zero_copy_only=False)
    top = members.field("is_top").to_numpy(zero_copy_only=False).astype(bool)
    rows = _matrix(members.field("sketch").to_pylist())
    joined = np.unique(np.array(members.field("label").to_pylist(), dtype=object), return_inverse=True)[1].reshape(-1)
    if exact:
        flat = np.frombuffer(b"".join(members.field("elements").to_pylist()), np.uint64)
        numbers = np.unique(flat, return_inverse=True)[1].reshape(-1)
        sets = np.split(numbers, np.cumsum(sizes)[:-1])
        mark = np.zeros(int(numbers.max()) + 1, bool)
    links = []
    for i in range(len(ids) - 1) if not across else np.flatnonzero(~top).tolist():
        # across, each other node meets all tops; else all later nodes
        others = top if across else np.arange(len(ids)) > i
        may = others & (joined != joined[i]) & (100 * np.minimum(sizes, sizes[i]) >= percent * np.maximum(sizes, sizes[i]))
        places = np.flatnonzero(may)
        if len(places):
            places = places[(rows[places] == rows[i]).sum(axis=1) >= least]
        if len(places) and exact:
            mark[sets[i]] = True
            starts = np.concatenate(([0], np.cumsum(sizes[places])[:-1]))
            shared = np.add.reduceat(mark[np.concatenate([sets[p] for p in places.tolist()])], starts, dtype=np.int64)
            mark[sets[i]] = False
            places = places[_similar(shared, sizes[i], sizes[places], percent)]
        for p in places.tolist():
            if joined[p] != joined[i]:
                joined[joined == joined[p]] = joined[i]
                links.append((ids[i], ids[p]))
    return links


def _classed(docs: DataFrame, doc_id: str, text: str, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """``_described`` rows, stored, and (node, doc_id, label): the class of every node and its smallest id."""
    terms = Terms(size, percent)
    described = checkpointed(_described(docs, doc_id, text, size))
    nodes = checkpointed(
        described.where("node is not null")
        .groupBy("node")
        .agg(F.min("doc_id").alias("doc_id"), F.min("row").alias("row"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
    )
    buckets = _buckets(nodes, terms)
    several = buckets.groupBy("bucket").agg(F.count("*").alias("many")).where("many > 1").select("bucket")
    buckets = checkpointed(buckets.join(several, "bucket", "left_semi"))
    links = _confirmed(_agreeing(_pivot_pairs(buckets), nodes, terms), nodes, docs, doc_id, text, terms)
    labels = connected_components(links)
    # families: what pairs that pass the sketch connect, in buckets that hold several components
    labelled = buckets.join(labels, "node", "left").select(F.col("bucket").alias("group"), "node", F.coalesce("label", "node").alias("label"))
    labelled = labelled.withColumn("part", F.lit(1.0 / BLOCK))
    kin = checkpointed(_links_in_cells(_cells(labelled), nodes.select("node", "n", "sketch"), terms))
    families = connected_components(links.unionByName(kin))
    # each family is settled on full sets
    heads = families.select(F.col("label").alias("node")).distinct()
    members = families.select("node", F.col("label").alias("group")).unionByName(heads.select("node", F.col("node").alias("group")))
    members = members.join(labels, "node", "left").join(nodes.select("node", "n"), "node")
    part = F.greatest(F.lit(1.0 / BLOCK), F.col("n") / float(BLOCK_ELEMENTS))
    members = members.select("group", "node", F.coalesce("label", "node").alias("label"), part.alias("part"))
    cells = checkpointed(_cells(members))
    full = _full_sets(cells.select("node").distinct(), nodes, docs, doc_id, text, size)
    rest = _links_in_cells(cells, nodes.select("node", "n", "sketch").join(full, "node"), terms)
    labels = connected_components(links.unionByName(rest))
    classed = nodes.select("node", "doc_id").join(labels, "node", "left")
    return described, classed.select("node", "doc_id", F.coalesce("label", "node").alias("label"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest id of the row's class, for every row."""
    described, classed = _classed(docs, doc_id, text, size, percent)
    named = classed.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    by_node = classed.join(named, "label").select("node", "component_id")
    joined = described.select("doc_id", "n_shingles", "node").join(by_node, "node", "left")
    return joined.select(
        "doc_id", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def _told_apart(docs: DataFrame, *names: str) -> list[str]:
    """The names, lengthened where ``docs`` has such columns."""
    taken = {c.lower() for c in docs.columns}
    made = []
    for name in names:
        while name in taken:
            name += "_"
        made.append(name)
    return made


def _small(keys: DataFrame) -> DataFrame:
    """Stored keys, broadcast behind a count: then no text is shuffled."""
    keys = checkpointed(keys)
    return F.broadcast(keys) if keys.count() <= MAX_BROADCAST_KEYS else keys


def keep_one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of each class, with all columns; rows without words are in no class and stay.

    Rows decide, not ids: the row with the smallest id stays (a null id comes last; of different texts with that id the one
    with the smallest hash; of rows with equal id and text the first by their other columns), all others of the class go.
    So an id on two texts that are not alike keeps both, and copies without an id leave one.
    """
    described, classed = _classed(docs.select(doc_id, text), doc_id, text, size, percent)
    rows = described.where("node is not null").join(classed.select("node", "label"), "node")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row", "twin")
    counted = rows.groupBy("label", place.alias("place")).agg(F.count("*").alias("copies"))  # equal rows collapse first
    first = counted.groupBy("label").agg(F.min("place").alias("first"), F.sum("copies").alias("all")).where(F.col("all") > 1)
    keys, number = _told_apart(docs, "_row", "_twin"), *_told_apart(docs, "_number")
    named = [F.col("place")[part].alias(key) for part, key in zip(("row", "twin"), keys, strict=True)]
    told = counted.join(first, "label").select(*named, (F.col("place") == F.col("first")).alias("stays"), "copies")
    told = checkpointed(told.where(~F.col("stays") | (F.col("copies") > 1)))
    gone = _small(told.where(~F.col("stays")).select(*keys))
    keyed = docs.withColumns(dict(zip(keys, (_row_key(doc_id, text), _twin_key(doc_id, text)), strict=True)))
    kept = keyed.join(gone, keys, "left_anti")
    copied = told.where("stays").select(*keys)
    if copied.isEmpty():
        return kept.select(*docs.columns)
    copied = _small(copied)
    others = F.xxhash64(*[f.name for f in docs.schema if not isinstance(f.dataType, T.MapType)])
    equal = kept.join(copied, keys, "left_semi").withColumn(number, F.row_number().over(Window.partitionBy(*keys).orderBy(others)))
    return kept.join(copied, keys, "left_anti").unionByName(equal.where(F.col(number) == 1).drop(number)).select(*docs.columns)
