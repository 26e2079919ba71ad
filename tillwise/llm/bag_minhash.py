"""Near-duplicates by BagMinHash signatures of word shingles with their counts.

A text is a bag of five-word shingles. Each shingle has a Poisson process of points over time
and weight; a point falls to one component of the signature, and the component keeps its
first point whose weight lies below the shingle's count. Two bags then agree in a component
with the probability of their weighted Jaccard similarity, sum of minima over sum of maxima.
The weights are cut into the intervals [0, 1), [1, 2), [2, 4), [4, 8) and so on with a process each:
only the last one that a count reaches into has to be thinned, and no process runs past
the moment when all components have an earlier point.

Signatures are cut into bands; texts that share a band meet in a bucket. Each bucket is
verified around its centres, on the bags themselves, until no two of its texts that are in
different classes are left uncompared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tillwise.llm import vocabulary
from tillwise.llm.components import components
from tillwise.llm.text import SPACED, Words, mix, pieces, release, texts_of, window_hash
from tillwise.staging import scratch, stage

SHINGLE = 5
SIMILARITY = 0.8
#: 24 bands of 5 find a pair of similarity 0.8 with a probability of 0.99993.
BANDS, BAND_ROWS = 24, 5
SIZE = BANDS * BAND_ROWS
#: Centres of a bucket that are compared with its other texts in the second round. The first
#: has one, which most of a group is near to; later ones have twice as many each time.
CENTRES = 8
#: A shingle of so many texts at most is rare.
RARE = 64
#: Bits of a bitmap of ids for each id, the most of all (as a power of two: 8 MB), and those of a piece.
_BITS_PER_ID, _MOST_BITS, _PIECE_BITS = 64, 26, 1 << 15
#: Bytes of text that are signed at a time: an atom of a shingle takes some 70 bytes.
_SIGNED_BYTES = 1 << 20
_U = np.uint64


# ------------------------------------------------------------------- signatures


def bags(words: Words, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, shingle and count of every distinct shingle, ordered by text and shingle.

    A text of fewer words is one shingle; a text without words has none.
    """
    counts = words.counts
    size = np.minimum(counts, shingle)[words.text]
    starts = np.flatnonzero(np.repeat(words.first[1:], counts) - np.arange(len(words)) >= size)
    hashes = window_hash(words.hash, shingle, 2)
    short = (counts > 0) & (counts < shingle)
    for text in np.flatnonzero(short):
        a, b = words.first[text], words.first[text + 1]
        hashes[a] = window_hash(words.hash[a:b], int(b - a), 3)[0]
    text, key = words.text[starts], hashes[starts]
    order = np.lexsort((key, text))
    text, key = text[order], key[order]
    head = np.flatnonzero(
        np.concatenate([[True], (key[1:] != key[:-1]) | (text[1:] != text[:-1])])[: len(key)]
    )
    return text[head], key[head], np.diff(np.append(head, len(key)))


def signatures(text: np.ndarray, key: np.ndarray, count: np.ndarray, texts: int, size: int = SIZE) -> np.ndarray:
    """A 64-bit name for each component of each text's signature (zeros for an empty bag)."""
    first = np.full((texts, size), np.inf)
    names = np.zeros((texts, size), np.uint64)
    flat_first, flat_names = first.reshape(-1), names.reshape(-1)
    filled = np.zeros(texts, bool)
    filled[text] = True
    bound = np.where(filled, np.inf, 0.0)
    with np.errstate(over="ignore"):
        # an atom for each shingle and each interval of weights that its count reaches into
        reach = np.ceil(np.log2(count)).astype(np.int64) + 1
        owner = np.repeat(np.arange(len(key)), reach)
        level = np.arange(len(owner)) - np.repeat(np.cumsum(reach) - reach, reach)
        low = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0)
        length = np.where(level > 0, 1 << np.maximum(level - 1, 0), 1).astype(float)
        state = mix(key[owner] + (level.astype(np.uint64) + _U(1)) * _U(0x9E3779B97F4A7C15))
        doc, weight, time = text[owner], count[owner], np.zeros(len(owner))
        step = 0
        while len(state):
            step += 1
            x = mix(state + _U(step * 0xD1342543DE82EF95 % 2**64))
            time = time - np.log1p(-(x >> _U(11)).astype(float) * 2.0**-53) / (size * length)
            near = time < bound[doc]
            if not near.all():
                state, doc, weight, low, length, time, x = (
                    a[near] for a in (state, doc, weight, low, length, time, x)
                )
            y = mix(x + _U(0x8CB92BA72F3D8DD7))
            component = ((y >> _U(40)) * _U(size) >> _U(24)).astype(np.int64)
            inside = low + ((y & _U(0xFFFFFF)).astype(float) * 2.0**-24 * length).astype(np.int64) < weight
            cell, when, name = (doc * size + component)[inside], time[inside], y[inside]
            np.minimum.at(flat_first, cell, when)
            won = flat_first[cell] == when
            flat_names[cell[won]] = name[won]
            if step < 8 or step % 8 == 0:
                bound = np.where(filled, first.max(axis=1), 0.0)
    return names


def band_hashes(names: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """``[text, band]``: one hash for the components of each band."""
    rows = names.reshape(len(names), bands, -1)
    with np.errstate(over="ignore"):
        out = np.zeros(rows.shape[:2], np.uint64) + (np.arange(bands, dtype=np.uint64) + _U(1)) * _U(0xA24BAED4963EE407)
        for k in range(rows.shape[2]):
            out = mix(out + rows[:, :, k])
    return out


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    vocabulary.forget()
    for batch in batches:
        for piece in pieces(batch, limit=_SIGNED_BYTES):
            words = Words(*texts_of(piece.column("text")), SPACED)
            text, key, count = bags(words)
            bands = band_hashes(signatures(text, key, count, piece.num_rows)).view(np.int64)
            full = words.counts > 0
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    pa.array(_text_keys(words), pa.binary()),
                    pa.array([b if f else None for b, f in zip(bands, full)], pa.list_(pa.int64())),
                    pa.array(np.bincount(text, count, piece.num_rows).astype(np.int64)),
                ],
                names=["doc_id", "key", "bands", "total"],
            )


def _text_keys(words: Words) -> list[bytes]:
    """128 bits that equal word sequences share."""
    halves = []
    with np.errstate(over="ignore"):
        for seed in (1, 2):
            nth = (np.arange(len(words)) - np.repeat(words.first[:-1], words.counts)).astype(np.uint64)
            parts = mix(words.hash + mix(nth + _U(seed << 32)))
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(parts, dtype=np.uint64)])
            halves.append(mix(sums[words.first[1:]] - sums[words.first[:-1]] + words.counts.astype(np.uint64)))
    both = np.stack(halves, axis=1).astype("<u8").tobytes()
    return [both[i : i + 16] for i in range(0, len(both), 16)]


# ----------------------------------------------------------------- verification


def _pack_bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch):
            words = Words(*texts_of(piece.column("text")), SPACED)
            text, key, count = bags(words)
            at = pa.array(np.searchsorted(text, np.arange(piece.num_rows + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    pa.array(_text_keys(words), pa.binary()),
                    pa.ListArray.from_arrays(at, pa.array(key.view(np.int64))),
                    pa.ListArray.from_arrays(at, pa.array(count.astype(np.int32))),
                ],
                names=["doc_id", "key", "shingles", "counts"],
            )


def overlap(a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray) -> float:
    """Weighted Jaccard similarity of two bags given as sorted shingles and counts."""
    total = int(n.sum() + m.sum())
    if not total:
        return 0.0
    at = np.searchsorted(b, a)
    hit = at < len(b)
    hit[hit] = b[at[hit]] == a[hit]
    shared = int(np.minimum(n[hit], m[at[hit]]).sum())
    return shared / (total - shared)


def _verify(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for name in ("a", "b"):
                shingles, counts = batch.column(f"{name}_shingles"), batch.column(f"{name}_counts")
                at = shingles.offsets.to_numpy()
                keys, numbers = shingles.values.to_numpy().view(np.uint64), counts.values.to_numpy()
                sides.append((at, keys, counts.offsets.to_numpy(), numbers))
            similar = np.zeros(batch.num_rows, bool)
            for row in range(batch.num_rows):
                bags_ = [x for i, k, j, n in sides for x in (k[i[row] : i[row + 1]], n[j[row] : j[row + 1]])]
                similar[row] = overlap(*bags_) >= similarity
            yield batch.select(["a", "b"]).filter(pa.array(similar))
            release()

    return run


def _links(pairs: DataFrame, held: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``a, b`` whose bags are similar enough."""

    def side(name: str) -> DataFrame:
        return held.select(
            F.col("key").alias(name), F.col("shingles").alias(f"{name}_shingles"), F.col("counts").alias(f"{name}_counts")
        )

    both = pairs.select("a", "b").join(side("b"), "b").join(side("a"), "a")
    return stage(both.mapInArrow(_verify(similarity), "a binary, b binary"), "similar")


# --------------------------------------------------------------------- classes


def text_classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, key, label`` of every row: the key of its text and that of the text's class.

    Texts with equal words have equal keys; classes are what links of at least ``similarity``
    between texts connect, whatever ids their rows have. Texts without words have no label, and rows
    without doc_id neither.
    """
    spark = docs.sparkSession
    with scratch(spark):
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        signed = stage(rows.mapInArrow(_sign, "doc_id long, key binary, bands array<long>, total long"), "signed")
        filled = signed.where("doc_id IS NOT NULL AND bands IS NOT NULL")
        # rows of one key have equal words, so equal bands and totals
        texts = filled.groupBy("key").agg(
            F.min("doc_id").alias("doc_id"), F.any_value("total").alias("total"), F.any_value("bands").alias("bands")
        )
        buckets = texts.select("key", "doc_id", "total", F.posexplode("bands").alias("band", "hash")).select(
            "key", "doc_id", "total", F.xxhash64("band", "hash").alias("bucket")
        )
        buckets = stage(buckets, "buckets")
        shared = buckets.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
        members = stage(buckets.join(shared, "bucket"), "members")
        # texts with many neighbours are the first centres: most of a group is near to its origin
        rank = members.groupBy("key").agg(F.sum("size").alias("rank"), F.min("doc_id").alias("doc_id"))
        rank = stage(rank, "rank")
        held = rows.join(rank.select("doc_id").distinct(), "doc_id", "left_semi").mapInArrow(
            _pack_bags, "doc_id long, key binary, shingles array<long>, counts array<int>"
        )
        held = stage(held.join(rank.select("key"), "key", "left_semi").drop("doc_id").dropDuplicates(["key"]), "bags")
        members = members.join(rank.select("key", "rank"), "key").select("bucket", "key", "total", "rank")
        members = stage(members.withColumn("label", F.col("key")), "members")
        labels = _resolved(members, held, similarity)
        # the bands stay out of the join
        rows = signed.select("doc_id", "key", (F.col("doc_id").isNotNull() & F.col("bands").isNotNull()).alias("_judged"))
        found = rows.join(labels, rows["key"] == labels["node"], "left").select(
            "doc_id", "key", F.when(F.col("_judged"), F.coalesce("label", "key")).alias("label")
        )
        return stage(found, "text-classes", outlive=True)


def _resolved(members: DataFrame, held: DataFrame, similarity: float) -> DataFrame:
    """``node, label`` of the texts in classes of several, from ``bucket, key, total, rank, label``."""
    labels = members.sparkSession.createDataFrame([], "node binary, label binary")
    centres = 1
    while True:
        centred = stage(_centres(members, centres), "centres")
        pairs = _centre_pairs(members, centred, similarity, bounded=centres > 1)
        labels = _merged(labels, _links(pairs, held, similarity))
        # centres have met everyone in their bucket; what is left there must agree. Buckets of one class are done with
        left = _open(_labelled(members.drop("label"), labels))
        met = centred.select("bucket", F.col("a").alias("key"))
        left = stage(left.join(met, ["bucket", "key"], "left_anti"), "left")
        if centres == 1:
            # from here on only texts in open buckets matter
            nodes = left.groupBy("key", "label", "total").agg(F.collect_set("bucket").alias("buckets"))
            nodes = stage(nodes, "nodes")
            rare = stage(_rare_shingles(held.join(nodes.select("key"), "key", "left_semi")), "rare")
            labels = _merged(labels, _links(_rare_pairs(nodes, rare, similarity), held, similarity))
            left = stage(_labelled(left.drop("label"), labels).join(_commons(nodes, rare), "key"), "left")
        members = stage(_open(_hopeful(_open(left), similarity)), "members")
        if not members.limit(1).count():
            return labels
        centres = max(CENTRES, 2 * centres)


def near_classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Return ``doc_id, class_id`` for every row.

    Classes are what links of at least ``similarity`` connect, named by their smallest
    doc_id. Texts with equal words are one text with all its documents. Null and empty
    texts, and texts of white space, have empty bags: such documents are alone in their
    class. Rows with one doc_id are one document, near to whatever one of them is near to.
    Rows without doc_id link to nothing and have no class. No rows give no rows; other columns
    are not read. A text of any length is one bag; ties between centres go by the text's key.
    """
    with scratch(docs.sparkSession):
        found = text_classes(docs, similarity)
        filled = found.where("label IS NOT NULL").select("doc_id", "label").distinct()
        # a document whose rows are in several classes makes them one
        several = filled.groupBy("doc_id").agg(F.min("label").alias("a"), F.max("label").alias("_z")).where("a < _z")
        links = filled.join(several, "doc_id").select("a", F.col("label").alias("b")).where("a <> b").distinct()
        links = stage(links, "one-id")
        if links.limit(1).count():
            joined = stage(components(links), "classes")
            filled = filled.join(joined, filled["label"] == joined["node"], "left").select(
                "doc_id", F.coalesce(joined["label"], filled["label"]).alias("label")
            ).distinct()
        least = filled.groupBy("label").agg(F.min("doc_id").alias("class_id"))
        # documents without a word are alone
        classes = filled.join(least, "label").select("doc_id", "class_id")
        all_rows = found.select("doc_id").join(classes, "doc_id", "left")
        return stage(all_rows.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id")), "near-classes", outlive=True)


def _rare_shingles(held: DataFrame) -> DataFrame:
    """``shingle, key, weight, texts`` of the shingles that at most ``RARE`` texts have."""
    parts = held.select("key", F.explode(F.arrays_zip("shingles", "counts")).alias("x")).select(
        "key", F.col("x.shingles").alias("shingle"), F.col("x.counts").alias("weight")
    )
    texts = parts.groupBy("shingle").agg(F.count("*").alias("texts")).where(F.col("texts") <= RARE)
    return parts.join(texts, "shingle")


def _commons(nodes: DataFrame, rare: DataFrame) -> DataFrame:
    """``key, common``: a bag's weight without its rare shingles."""
    weights = rare.groupBy("key").agg(F.sum("weight").alias("_rare"))
    return nodes.join(weights, "key", "left").select(
        "key", (F.col("total") - F.coalesce("_rare", F.lit(0))).alias("common")
    )


def _hopeful(members: DataFrame, similarity: float) -> DataFrame:
    """Members that may be near to a text of their bucket by the bound of :func:`_centre_pairs`.

    Whatever the other text is, it is no lighter than the lightest of the bucket.
    """
    lightest = members.groupBy("bucket").agg(F.min("total").alias("_least"))
    may = F.col("common") >= similarity * (F.greatest(F.col("_least") + F.col("total") - F.col("common"), F.col("total")))
    return members.join(lightest, "bucket").where(may).drop("_least")


def _centre_pairs(members: DataFrame, centred: DataFrame, similarity: float, bounded: bool) -> DataFrame:
    """Pairs ``a, b`` of centres and members of their buckets that have to be verified.

    Bags of too different weights are not similar. Rounds after the first are ``bounded`` more closely: there,
    ``common`` is a bag's weight without its rare shingles. Two bags that share no rare shingle overlap in no
    more than the smaller common weight, and their union holds one bag and the rare part
    of the other. This bounds the similarity from above; pairs that do share a rare shingle
    are found by it (:func:`_rare_pairs`). In a large group of copies that have all changed
    in their own way hardly a pair is left.
    """
    may = F.col("label") != F.col("a_label")
    if bounded:
        rare, a_rare = F.col("total") - F.col("common"), F.col("a_total") - F.col("a_common")
        union = F.greatest(F.col("total") + a_rare, F.col("a_total") + rare)
        may &= F.least("common", "a_common") >= similarity * union
    else:
        may &= _weigh_alike("total", "a_total", similarity)
    return _once(members.join(centred, "bucket").where(may).select("a", F.col("key").alias("b")))


def _weigh_alike(a: str, b: str, similarity: float) -> Column:
    return F.least(a, b) >= similarity * F.greatest(a, b)


def _rare_pairs(nodes: DataFrame, rare: DataFrame, similarity: float) -> DataFrame:
    """Pairs ``a, b`` of texts ``key, label, total, buckets`` of different classes in one bucket that share a rare shingle.

    A bag lacks at most ``1 - similarity`` of its weight in the overlap with a near one, so
    its rarest shingles up to just beyond that weight hold one of the shared, if those are
    rare at all. Each shingle has few texts, so these are few pairs; most of them meet in no
    bucket and their bags are never moved.
    """
    known = rare.where("texts > 1").join(nodes.select("key", "label", "total"), "key")
    rarest = known.groupBy("key", "label", "total").agg(
        F.sort_array(F.collect_list(F.struct("texts", "shingle"))).alias("all")
    )
    size = F.floor(F.col("total") * (1 - similarity)).cast("int") + 1
    probes = rarest.select(
        F.col("key").alias("a"),
        F.col("label").alias("a_label"),
        F.col("total").alias("a_total"),
        F.explode(F.slice("all", F.lit(1), size)).alias("x"),
    ).select("a", "a_label", "a_total", F.col("x.shingle").alias("shingle"))
    met = known.select("shingle", F.col("key").alias("b"), "label", "total").join(probes, "shingle")
    pairs = _once(met.where((F.col("label") != F.col("a_label")) & _weigh_alike("total", "a_total", similarity)).select("a", "b"))
    a, b = (nodes.select(F.col("key").alias(n), F.col("buckets").alias(f"_{n}")) for n in ("a", "b"))
    return pairs.join(a, "a").join(b, "b").where(F.arrays_overlap("_a", "_b")).select("a", "b")


def _once(pairs: DataFrame) -> DataFrame:
    """Every pair once, whichever way round, as ``a, b``; written."""
    both = pairs.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"), "a")
    once = stage(both.groupBy("x", "y").agg(F.max("a").alias("a")), "pairs")
    return once.select("a", F.when(F.col("a") == F.col("x"), F.col("y")).otherwise(F.col("x")).alias("b"))


def _open(members: DataFrame) -> DataFrame:
    """The members of buckets that hold more than one class."""
    several = members.groupBy("bucket").agg(F.min("label").alias("_a"), F.max("label").alias("_z")).where("_a < _z")
    return members.join(several.select("bucket"), "bucket")


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members with the label of their class, so far."""
    found = members.join(labels.withColumnRenamed("node", "key"), "key", "left")
    return found.withColumn("label", F.coalesce("label", "key"))


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels ``node, label`` when ``links`` are added.

    Only links between different classes count, and of these only the classes.
    """
    for side in ("a", "b"):
        known = labels.select(F.col("node").alias(side), F.col("label").alias(f"{side}_label"))
        links = links.join(known, side, "left").withColumn(f"{side}_label", F.coalesce(f"{side}_label", side))
    new = stage(links.select(F.col("a_label").alias("a"), F.col("b_label").alias("b")).where("a <> b").distinct(), "new")
    if not new.limit(1).count():
        return labels
    classes = stage(components(new), "classes")
    changed = classes.select(F.col("node").alias("label"), F.col("label").alias("root"))
    kept = labels.join(changed, "label", "left").select("node", F.coalesce("root", "label").alias("label"))
    # classes that were single texts so far are no nodes of the labels yet
    fresh = classes.join(labels.select("node"), "node", "left_anti").select("node", "label")
    return stage(kept.unionByName(fresh), "labels")


def _centres(members: DataFrame, count: int) -> DataFrame:
    """Up to ``count`` centres ``bucket, a, a_label`` of each bucket.

    They come from the smallest classes of the bucket, which are done with soonest, and
    have many neighbours.
    """
    sizes = members.groupBy("bucket", "label").agg(F.count("*").alias("_n"))
    order = Window.partitionBy("bucket").orderBy("_n", F.desc("rank"), "key")
    return (
        members.join(sizes, ["bucket", "label"])
        .withColumn("_nth", F.row_number().over(order))
        .where(F.col("_nth") <= count)
        .select(
            "bucket",
            *(
                F.col(c).alias({"key": "a"}.get(c, f"a_{c}"))
                for c in ("key", "label", "common", "total")
                if c in members.columns
            ),
        )
    )


def drop_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of each class of texts, the one with the smallest doc_id, with all its columns.

    Unlike texts that share a doc_id are judged apart, each with its own near copies. Of rows with
    one doc_id and equal words one stays, also of those without a word. Rows without doc_id all stay.
    """
    found = text_classes(docs, similarity)
    known = found.where("doc_id IS NOT NULL").groupBy("doc_id", "key").agg(F.max("label").alias("label"), F.count("*").alias("_n"))
    first = known.where("label IS NOT NULL").groupBy("label").agg(F.min(F.struct("doc_id", "key")).alias("_first"))
    judged = known.join(first, "label", "left")
    stays = F.col("label").isNull() | ((F.col("_first.doc_id") == F.col("doc_id")) & (F.col("_first.key") == F.col("key")))
    judged = stage(judged.select("doc_id", "key", "_n", stays.alias("stays")), "judged")
    # an id of one row is decided by itself; rows that share an id are told apart by their texts
    again = judged.groupBy("doc_id").agg(F.sum("_n").alias("_n")).where("_n > 1").select("doc_id")
    again = stage(again, "again")
    gone = judged.where("NOT stays").select("doc_id").distinct()
    if not again.limit(1).count():
        return _without(docs, gone)
    single = _without(docs, gone.unionByName(again).distinct())
    name = "_key"
    while name in docs.columns:
        name += "_"
    keyed = docs.join(again, "doc_id", "left_semi").select(docs.columns)
    schema = StructType([*keyed.schema.fields, StructField(name, BinaryType())])
    keyed = keyed.mapInArrow(_with_key(name), schema)
    kept = judged.where("stays").select("doc_id", F.col("key").alias(name))
    once = keyed.join(kept, ["doc_id", name], "left_semi").dropDuplicates(["doc_id", name])
    return single.unionByName(once.select(docs.columns))


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose doc_id is not among ``ids``; only rows that may have one of them are shuffled.

    The ids set bits in a bitmap of bounded size, in pieces of 4 KB that are broadcast. A row whose bit is
    not set stays where it is; the others are joined with the ids themselves. With more ids than the bitmap
    is made for more rows are joined, with the same result.
    """
    ids = stage(ids, "without")
    bits = 1 << max(15, min(_MOST_BITS, (_BITS_PER_ID * ids.count()).bit_length()))

    # longer than any column, so of another name
    new = "_" * (1 + max(map(len, docs.columns)))
    piece, bit, held, byte = (new + c for c in ("piece", "bit", "held", "byte"))

    def placed(frame: DataFrame) -> DataFrame:
        slot = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(bits))
        return frame.withColumns({piece: (slot / _PIECE_BITS).cast("long"), bit: slot % _PIECE_BITS})

    held_bits = placed(ids).groupBy(piece).agg(F.bitmap_construct_agg(bit).alias(held))
    marked = placed(docs).join(F.broadcast(held_bits), piece, "left")
    eight = F.substring(F.col(held), (F.col(bit) / 8).cast("int") + 1, F.lit(1))
    marked = marked.withColumn(byte, F.conv(F.hex(eight), 16, 10).cast("int"))
    is_set = F.coalesce(F.getbit(byte, (F.col(bit) % 8).cast("int")) == 1, F.lit(False))
    stay, maybe = (marked.where(which).select(docs.columns) for which in (~is_set, is_set))
    return stay.unionByName(maybe.join(ids, "doc_id", "left_anti").select(docs.columns))


def _with_key(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                words = Words(*texts_of(piece.column("text")), SPACED)
                yield piece.append_column(name, pa.array(_text_keys(words), pa.binary()))

    return run


# ----------------------------------------------------------------------- query


def query(spark, folder: str) -> DataFrame:
    return near_classes(spark.read.parquet(f"{folder}/documents.parquet"))
