"""Near-duplicate detection by fast similarity sketching, banding and exact verification.

Sketch: the elements of a set are thrown into T bins by a fresh hash each round; a bin keeps its
first round's smallest value. From round T on, round T+k throws every element into bin k, so every
coordinate is filled after 2T rounds at most, mostly after one or two for long texts. The share of
equal coordinates estimates the similarity with concentration bounds.

Steps: (1) texts with the same shingle set form a class and are represented by their smallest id;
(2) bands of the sketches give buckets of classes; (3) each bucket's members are verified against
its smallest one, and links make components; (4) buckets that still hold several components are
worked through completely, in blocks of bounded size: members outside a bucket's main component
(visitors) meet all others (residents) of the same main component's buckets. No pair list is
written, only confirmed links. With 5 rows and 36 bands a pair at the threshold of 0.8 is missed
with probability 6e-7, less above.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import components, in_arrow, links_of_shared_ids, small, stored
from murmur.llm.textbytes import BLANKS, LOWER, U64, chunks, mix, spans, word_hashes

ROWS, BANDS = 5, 36
BLOCK = 256
_FULL = np.uint64(2**64 - 1)


def shingle_sets(buf: np.ndarray, starts: np.ndarray, words: int) -> list[np.ndarray]:
    """Per document the sorted distinct hashes of its `words`-word shingles (the whole sequence if
    it has fewer words; empty without words)."""
    low = LOWER[buf]
    a, b = spans(~BLANKS[low])
    w = word_hashes(low, a, b)
    at = np.searchsorted(a, starts)
    rolled = np.zeros(max(len(w) - words + 1, 0), U64)
    for k in range(words):
        rolled *= U64(0xD1342543DE82EF95)
        rolled += w[k:k + len(rolled)]
    rolled = mix(rolled)
    out = []
    for x, y in zip(at[:-1].tolist(), at[1:].tolist()):
        if y - x >= words:
            out.append(np.unique(rolled[x:y - words + 1]))
        elif y > x:
            h = np.zeros(1, U64)
            for v in w[x:y]:
                h = h * U64(0xD1342543DE82EF95) + v
            out.append(mix(h + U64(y - x)))
        else:
            out.append(w[:0])
    return out


def sketches(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """One row of `bins` coordinates per set; rows of empty sets stay at the largest value."""
    n = len(sets)
    out = np.full(n * bins, _FULL, U64)
    at = np.repeat(np.arange(n) * bins, [len(s) for s in sets])
    el = np.concatenate(sets) if n else np.empty(0, U64)
    for k in range(2 * bins):
        if not len(el):
            break
        x = mix(el + U64((0x9E3779B97F4A7C15 * (k + 1)) % 2**64))
        low = x & U64(0xFFFFFFFF)
        slot = (((x >> U64(32)) * U64(bins)) >> U64(32)).astype(np.int64) if k < bins else k - bins
        np.minimum.at(out, at + slot, (U64(k) << U64(40)) | low)
        empty = (out.reshape(n, bins) == _FULL).any(1)
        keep = empty[at // bins]
        at, el = at[keep], el[keep]
    return out.reshape(n, bins)


def band_keys(sketch: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key of each band, the band's number included."""
    n, bins = sketch.shape
    parts = mix(sketch + U64(1)).reshape(n, bins // rows, rows)
    key = np.arange(bins // rows, dtype=U64)[None, :] * U64(0xA24BAED4963EE407) + U64(1)
    for k in range(rows):
        key = mix(key * U64(0xD1342543DE82EF95) + parts[:, :, k])
    return key.view(np.int64)


def _digest(elements: np.ndarray) -> bytes:
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest()


def _features(words: int, rows: int, bands: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("same", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for at, n, buf, starts in chunks(batch.column(1)):
                sets = shingle_sets(buf, starts, words)
                keys = band_keys(sketches(sets, rows * bands), rows)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(at, n), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_digest(s) for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(np.arange(0, n * bands + 1, bands, dtype=np.int32), keys.ravel())], schema=schema)
    return run


def _sets(words: int):
    schema = pa.schema([("same", pa.binary()), ("elements", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            for _, _, buf, starts in chunks(batch.column(0)):
                sets = shingle_sets(buf, starts, words)
                yield pa.RecordBatch.from_arrays([pa.array([_digest(s) for s in sets], pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], schema=schema)
    return run


def overlaps(a: list[np.ndarray], b: list[np.ndarray], width: int = 8192) -> np.ndarray:
    """Intersection sizes of all sets of `a` with all of `b`, by products of 0/1 blocks over the
    elements that both sides have."""
    out = np.zeros((len(a), len(b)), np.float64)
    ea, eb = np.concatenate(a), np.concatenate(b)
    common = np.intersect1d(ea, eb)
    if not len(common):
        return out

    def placed(el, sets):
        at = np.searchsorted(common, el)
        at[at == len(common)] = 0
        hit = common[at] == el
        return np.repeat(np.arange(len(sets)), [len(s) for s in sets])[hit], at[hit]
    (ra, ca), (rb, cb) = placed(ea, a), placed(eb, b)
    oa, ob = np.argsort(ca, kind="stable"), np.argsort(cb, kind="stable")
    ra, ca, rb, cb = ra[oa], ca[oa], rb[ob], cb[ob]
    for lo in range(0, len(common), width):
        hi = min(lo + width, len(common))
        x, y = np.zeros((len(a), hi - lo), np.float32), np.zeros((len(b), hi - lo), np.float32)
        i, j = np.searchsorted(ca, [lo, hi])
        x[ra[i:j], ca[i:j] - lo] = 1
        i, j = np.searchsorted(cb, [lo, hi])
        y[rb[i:j], cb[i:j] - lo] = 1
        out += x @ y.T
    return out


def _block_links(percent: int):
    """Rows sorted by unit, visitors' block and residents' block -> confirmed links between different components."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(group):
        visit = [r for r in group if r[1]]
        stay = [r for r in group if not r[1]]
        if not visit or not stay:
            return
        va, vb = [r[4] for r in visit], [r[4] for r in stay]
        na, nb = np.array([len(s) for s in va]), np.array([len(s) for s in vb])
        inter = overlaps(va, vb)
        ca, cb = np.array([r[3] for r in visit]), np.array([r[3] for r in stay])
        ok = (100 * inter >= percent * (na[:, None] + nb[None, :] - inter)) & (ca[:, None] != cb[None, :])
        for i, j in zip(*np.nonzero(ok)):
            yield visit[i][2], stay[j][2]

    def run(batches):
        key, group = None, []
        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(6)]
            sets = batch.column(6)
            found = []
            for i in range(batch.num_rows):
                k = (cols[0][i], cols[1][i], cols[2][i])
                if k != key:
                    found += links(group)
                    key, group = k, []
                group.append((k, cols[3][i], cols[4][i], cols[5][i], sets[i].values.to_numpy(zero_copy_only=False)))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], schema=schema)
        if found := list(links(group)):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], schema=schema)
    return run


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, rows: int = ROWS, bands: int = BANDS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of `docs`: doc_id, n_shingles, component_id, kept.

    A document's set holds its distinct `words`-word shingles over lower-cased (A-Z) words between
    blanks, or the whole sequence if it has fewer words. Documents are linked when the sets'
    intersection is at least `percent` per cent of their union; component_id is the smallest id
    reachable. Null, empty and wordless texts have an empty set and are linked with nothing. Rows
    with the same id are one node, whatever their texts: each of these is compared. A null id keeps a null component and kept = false. Other
    columns are ignored; an empty table gives an empty result.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    feats = stored(docs.transform(in_arrow, _features(words, rows, bands), "doc_id long, n_shingles long, same binary, bands array<long>"), "sketch")
    linked = feats.where("n_shingles > 0 and doc_id is not null")
    classes = stored(linked.groupBy("same").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
                     .withColumn("id", F.monotonically_increasing_id()), "classes")
    one_node = links_of_shared_ids(linked, classes)

    rows_of = classes.select("id", "n", F.explode("bands").alias("key"))
    many = rows_of.groupBy("key").agg(F.count("*").alias("c"), F.min("id").alias("pivot")).where("c > 1").select("key", "pivot")
    members = stored(rows_of.join(many, "key"), "buckets")

    wanted = stored(members.select("id").distinct().join(classes.select("id", "same", "doc_id"), "id"), "wanted")
    sets = docs.join(small(wanted.select("doc_id").distinct()), "doc_id", "left_semi").select("text").transform(in_arrow, _sets(words), "same binary, elements array<long>")
    sets = stored(sets.join(small(wanted.select("same", "id")), "same").select("id", "elements").dropDuplicates(["id"]), "sets")

    sizes = members.select("id", "n").distinct()
    pairs = (members.where("id <> pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b"), F.col("n").alias("nb")).distinct()
             .join(sizes.select(F.col("id").alias("a"), F.col("n").alias("na")), "a")
             .where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")))
    one, two = sets.select(F.col("id").alias("a"), F.col("elements").alias("ea")), sets.select(F.col("id").alias("b"), F.col("elements").alias("eb"))
    inter = F.size(F.array_intersect("ea", "eb"))
    star = stored(pairs.join(two, "b").join(one, "a").where(100 * inter >= percent * (F.col("na") + F.col("nb") - inter)).select("a", "b"), "links")

    known = star.union(one_node)
    nodes = components(known)
    named = members.join(nodes.withColumnRenamed("node", "id"), "id", "left").select("key", "id", F.coalesce("root", "id").alias("comp"))
    live = named.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    rest = stored(named.join(live, "key", "left_semi"), "live")
    counts = rest.groupBy("key", "comp").agg(F.count("*").alias("c"))
    main = counts.groupBy("key").agg(F.max(F.struct("c", "comp"))["comp"].alias("unit"))
    met = stored(rest.join(main, "key").groupBy("unit", "id", "comp").agg(F.lit(1).alias("x")).select("unit", "id", "comp", (F.col("comp") != F.col("unit")).alias("away")), "met")
    size = met.groupBy("unit").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("nr"), F.ceil(F.sum(F.col("away").cast("int")) / BLOCK).cast("int").alias("nv"))
    met = met.join(size, "unit")
    of = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    blocks = F.sequence(F.lit(0), F.col("nr") - 1), F.sequence(F.lit(0), F.col("nv") - 1)
    visit = met.where("away").select("unit", of("nv").alias("vb"), F.explode(blocks[0]).alias("rb"), F.lit(True).alias("visits"), "id", "comp")
    stay = met.select("unit", F.explode(blocks[1]).alias("vb"), of("nr").alias("rb"), F.lit(False).alias("visits"), "id", "comp")
    found = (visit.unionByName(stay).join(sets, "id")
             .select("unit", "vb", "rb", "visits", "id", "comp", "elements")
             .repartition("unit", "vb", "rb").sortWithinPartitions("unit", "vb", "rb")
             .transform(in_arrow, _block_links(percent), "a long, b long"))

    final = classes.select("id", "same", "doc_id").join(components(known.union(found)).withColumnRenamed("node", "id"), "id", "left").select("same", "doc_id", F.coalesce("root", "id").alias("root"))
    reps = final.join(final.groupBy("root").agg(F.min("doc_id").alias("component_id")), "root").select("same", "component_id")
    out = feats.select("doc_id", "n_shingles", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("same")).alias("same")) \
        .join(reps, "same", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))
