"""Exact Jaccard join of word n-gram sets: inverted lists over rare prefixes, with set relations to skip work.

Texts with the same set are one class. The elements of a set are ordered by rarity (a count of all
elements in SLOTS hash slots, then the hash): two sets over the threshold share an element of their
prefixes, the first n - ceil(t n) + 1 elements, so an inverted list holds prefix elements only.

Skipping in lists: a list is cut into blocks by set size, each as wide as sizes may differ. A set
visits its own block and, if its position in the list still allows an overlap large enough, the next
one; a position deep in the prefix rules out all larger partners at once.

Skipping by answers: each set is compared with the first set of most of its blocks. If they are linked,
that one answers for it, and it keeps only what it lacks and what it adds (`minus`, `plus`). An overlap with such a set is the overlap with its
leader, less that with `minus`, plus that with `plus`; where the leader's answer already shows that
the bound is out of reach, nothing more is compared. Lists whose sets are all in one component by then
are done; in the others, sets outside the main component meet all others, in blocks of bounded size,
first with parity bitmaps, whose difference bounds that of the sets, then in full where these allow it.
No pair list is written, only confirmed links.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import components, in_arrow, links_of_shared_ids, small, stored
from murmur.llm.minhash import overlaps, shingle_sets
from murmur.llm.phrases import bitmap, has
from murmur.llm.textbytes import U64, chunks

#: Hash slots in which elements are counted for the order (2 MB, broadcast).
SLOTS = 1 << 18
BLOCK = 256
#: Bits of a set's parity bitmap: two bitmaps differ in at most as many bits as the sets in elements.
PARITY = 4096


def _slot(elements: np.ndarray, slots: int) -> np.ndarray:
    return (elements & U64(slots - 1)).astype(np.int64)


def _slot_counts(words: int, slots: int):
    schema = pa.schema([("slot", pa.int32()), ("c", pa.int64())])

    def run(batches):
        counts = np.zeros(slots, np.int64)
        for batch in batches:
            for _, _, buf, starts in chunks(batch.column(0)):
                counts += np.bincount(_slot(np.concatenate(shingle_sets(buf, starts, words)), slots), minlength=slots)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(counts[used])], schema=schema)
    return run


def _digest(elements: np.ndarray) -> bytes:
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest()


def _features(words: int, percent: int, shared):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("same", pa.binary()), ("prefix", pa.list_(pa.int64()))])

    def run(batches):
        counts = shared.value
        for batch in batches:
            for at, n, buf, starts in chunks(batch.column(1)):
                sets = shingle_sets(buf, starts, words)
                sizes = np.array([len(s) for s in sets], np.int64)
                flat = np.concatenate(sets)
                owner = np.repeat(np.arange(n), sizes)
                flat = flat[np.lexsort((flat, counts[_slot(flat, len(counts))], owner))]
                take = np.where(sizes > 0, sizes - -(-percent * sizes // 100) + 1, 0)
                place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                prefix = flat[place < np.repeat(take, sizes)].view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, n), pa.array(sizes), pa.array([_digest(s) for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(take))).astype(np.int32), prefix)], schema=schema)
    return run


def _shared_elements(shared):
    """Of each prefix the elements that other prefixes hold too (as far as the bitmap tells) and how much of
    the set lies from each of them on."""
    schema = pa.schema([("same", pa.binary()), ("elements", pa.list_(pa.int64())), ("reach", pa.list_(pa.int64()))])

    def run(batches):
        bits = shared.value
        for batch in batches:
            prefix = batch.column(2).combine_chunks() if isinstance(batch.column(2), pa.ChunkedArray) else batch.column(2)
            flat = prefix.flatten().to_numpy().view(U64)
            held = np.diff(prefix.offsets.to_numpy())
            n = batch.column(1).to_numpy()
            place = np.arange(len(flat)) - np.repeat(np.cumsum(held) - held, held)
            ok = has(bits, flat)
            row = np.repeat(np.arange(len(held)), held)[ok]
            count = np.bincount(row, minlength=len(held))
            some = np.flatnonzero(count)
            offsets = np.concatenate(([0], np.cumsum(count[some]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(some)), pa.ListArray.from_arrays(offsets, flat[ok].view(np.int64)),
                                              pa.ListArray.from_arrays(offsets, n[row] - place[ok])], schema=schema)
    return run


def _parity(elements: np.ndarray) -> np.ndarray:
    odd = np.bincount(((elements >> U64(20)) & U64(PARITY - 1)).astype(np.int64), minlength=PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sets(words: int, of):
    """(same, values): of each text's set the digest and what `of` makes of it."""
    schema = pa.schema([("same", pa.binary()), ("values", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            for _, _, buf, starts in chunks(batch.column(0)):
                sets = shingle_sets(buf, starts, words)
                yield pa.RecordBatch.from_arrays([pa.array([_digest(s) for s in sets], pa.binary()), pa.array([of(s) for s in sets], pa.list_(pa.int64()))], schema=schema)
    return run


def _signed(elements: np.ndarray) -> np.ndarray:
    return elements.view(np.int64)


VISITOR, RESIDENT, LEADER = 0, 1, 2


def _grouped(batches, plain: tuple[str, ...], arrays: tuple[str, ...]):
    """Lists of row dicts with equal (unit, vb, rb) of sorted batches; `arrays` as numpy."""
    key, group = None, []
    for batch in batches:
        names = batch.schema.names
        values = {c: batch.column(names.index(c)).to_pylist() for c in ("unit", "vb", "rb", *plain)}
        lists = {c: batch.column(names.index(c)) for c in arrays}
        for i in range(batch.num_rows):
            row = {c: v[i] for c, v in values.items()}
            k = row["unit"], row["vb"], row["rb"]
            if k != key:
                if group:
                    yield group
                key, group = k, []
            group.append(row | {c: v[i].values.to_numpy(zero_copy_only=False) for c, v in lists.items()})
    if group:
        yield group


def _batches(pairs, schema: pa.Schema, size: int = 1 << 14):
    held = []
    for pair in pairs:
        held.append(pair)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*held)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*held)], schema=schema)


def _possible(percent: int):
    """Blocks of visitors and residents with parity bitmaps -> (unit, id) of those with a partner that the bitmaps allow."""
    def alive(group):
        visit, stay = ([r for r in group if r["kind"] == k] for k in (VISITOR, RESIDENT))
        if not visit or not stay:
            return
        x, y = (np.unpackbits(np.stack([r["bits"] for r in rows]).view(np.uint8), axis=1).astype(np.float32) * 2 - 1 for rows in (visit, stay))
        (na, ca), (nb, cb) = ((np.array([r["n"] for r in rows]), np.array([r["comp"] for r in rows])) for rows in (visit, stay))
        apart = (PARITY - (x @ y.T).astype(np.int64)) // 2
        ok = (apart * (100 + percent) <= (100 - percent) * (na[:, None] + nb[None, :])) & (ca[:, None] != cb[None, :])
        ids = {visit[i]["id"] for i in np.flatnonzero(ok.any(1))} | {stay[j]["id"] for j in np.flatnonzero(ok.any(0))}
        yield from ((group[0]["unit"], i) for i in ids)

    def run(batches):
        groups = _grouped(batches, ("kind", "id", "comp", "n"), ("bits",))
        yield from _batches((p for g in groups for p in alive(g)), pa.schema([("unit", pa.int64()), ("id", pa.int64())]))
    return run


def _block_links(percent: int):
    """Blocks of visitors, residents and the residents' leaders -> links, one for each visitor and
    component that it is linked with."""
    def enough(inter, na, nb):
        return 100 * inter >= percent * (na[:, None] + nb[None, :] - inter)

    def links(group):
        visit, stay, lead = ([r for r in group if r["kind"] == k] for k in (VISITOR, RESIDENT, LEADER))
        if not visit or not stay:
            return
        place = {r["id"]: i for i, r in enumerate(lead)}
        sets = [r["plus"] for r in visit]
        na, nb = (np.array([r["n"] for r in x]) for x in (visit, stay))
        ca, cb = (np.array([r["comp"] for r in x]) for x in (visit, stay))
        answer = overlaps(sets, [r["plus"] for r in lead])[:, [place[r["leader"]] for r in stay]]
        best = np.minimum(answer + np.array([len(r["plus"]) for r in stay]), np.minimum(na[:, None], nb[None, :]))
        open_ = np.flatnonzero((enough(best, na, nb) & (ca[:, None] != cb[None, :])).any(0))
        if not len(open_):
            return
        inter = answer[:, open_] - overlaps(sets, [stay[j]["minus"] for j in open_]) + overlaps(sets, [stay[j]["plus"] for j in open_])
        ok = enough(inter, na, nb[open_]) & (ca[:, None] != cb[open_][None, :])
        i, j = np.nonzero(ok)
        _, first = np.unique(np.stack([i, cb[open_][j]]), axis=1, return_index=True)
        for x in first:
            yield visit[i[x]]["id"], stay[open_[j[x]]]["id"]

    def run(batches):
        groups = _grouped(batches, ("kind", "id", "comp", "n", "leader"), ("minus", "plus"))
        yield from _batches((p for g in groups for p in links(g)), pa.schema([("a", pa.int64()), ("b", pa.int64())]))
    return run


def _in_blocks(met: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Visitors (members outside their unit's main component) and residents (all members), each with the blocks it is in."""
    away = F.col("comp") != F.col("unit")
    size = met.groupBy("unit").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("nr"), F.ceil(F.sum(away.cast("int")) / BLOCK).cast("int").alias("nv"))
    met = met.join(size, "unit")
    of = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    return (met.where(away).select("unit", of("nv").alias("vb"), every("nr").alias("rb"), F.lit(VISITOR).alias("kind"), "id", "comp", "n"),
            met.select("unit", every("nv").alias("vb"), of("nr").alias("rb"), F.lit(RESIDENT).alias("kind"), "id", "comp", "n"))


def jaccard_components(docs: DataFrame, words: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """Per row of `docs`: doc_id, n_shingles, component_id.

    A document's set holds its distinct `words`-word shingles over lower-cased (A-Z) words between
    blanks, or the whole sequence if it has fewer words. Documents are linked when the sets'
    intersection is at least `percent` per cent of their union; component_id is the smallest id
    reachable. Null, empty and wordless texts have an empty set and are linked with nothing. Rows
    that share an id are one node, whatever their texts; a null id is linked with nothing and keeps
    a null component. The links of a document are not counted: inside a component only as many are
    confirmed as hold it together, so that a large family costs no square of its size. Other
    columns are ignored; an empty table gives an empty result.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent must be within 1 and 100")
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counts = np.zeros(slots, np.int64)
    for r in docs.select("text").transform(in_arrow, _slot_counts(words, slots), "slot int, c long").groupBy("slot").agg(F.sum("c").alias("c")).collect():
        counts[r.slot] = r.c
    feats = stored(docs.transform(in_arrow, _features(words, percent, spark.sparkContext.broadcast(counts)), "doc_id long, n long, same binary, prefix array<long>"), "prefixes")
    linked = feats.where("n > 0 and doc_id is not null")
    classes = stored(linked.groupBy("same").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n")).withColumn("id", F.monotonically_increasing_id()), "classes")
    one_node = links_of_shared_ids(linked, classes)

    # inverted lists of elements that several prefixes hold, cut into blocks by size
    several = linked.select(F.explode("prefix").alias("h")).groupBy("h").agg(F.count("*").alias("c")).where("c > 1").select("h")
    bits = spark.sparkContext.broadcast(bitmap(stored(several, "several")))
    held = linked.select("same", "n", "prefix").transform(in_arrow, _shared_elements(bits), "same binary, elements array<long>, reach array<long>")
    held = held.groupBy("same").agg(F.first(F.struct("elements", "reach")).alias("p")).join(classes, "same")
    entries = held.select("id", "n", F.explode(F.arrays_zip("p.elements", "p.reach")).alias("e")).select("id", "n", F.col("e.elements").alias("element"), F.col("e.reach").alias("reach"))
    width = max(math.log(100 / percent), 1e-6) * (1 + 1e-9)  # partners' sizes lie in neighbouring bands
    band: Column = lambda c: F.floor(F.log(c) / F.lit(width)).cast("int")
    largest = F.floor((100 + percent) * F.col("reach") / percent).cast("long") - F.col("n")  # size of a partner that the position allows
    lists = entries.withColumn("band", band(F.col("n")))
    lists = lists.select("element", "id", "n", "reach", F.explode(
        F.when((largest > 0) & (band(F.greatest(largest, F.lit(1))) > F.col("band")), F.array("band", F.col("band") + 1)).otherwise(F.array("band"))).alias("band"))
    lists = stored(lists, "lists")
    first = lists.groupBy("element", "band").agg(F.min(F.struct("n", "id", "reach")).alias("p"), F.count("*").alias("c")).where("c > 1") \
        .select("element", "band", F.col("p.id").alias("a"), F.col("p.n").alias("na"), F.col("p.reach").alias("ra"))
    members = stored(lists.join(first, ["element", "band"]), "members")

    def made(ids: DataFrame, of, name: str) -> DataFrame:
        """(id, values) of these classes, made from the text of one of each class's rows."""
        wanted = stored(ids.select("id").distinct().join(classes.select("id", "same", "doc_id"), "id"), "wanted")
        out = docs.join(small(wanted.select("doc_id").distinct()), "doc_id", "left_semi").select("text").transform(in_arrow, _sets(words, of), "same binary, values array<long>")
        out = stored(out.join(small(wanted.select("same", "id")), "same").select("id", F.col("values").alias(name)), name)
        return stored(out.dropDuplicates(["id"]), name) if out.count() > wanted.count() else out  # rows repeated with one id

    parity = made(members, _parity, "bits")
    # each set is compared with the first set of most of its blocks
    fits = (100 * F.least("na", "n") >= percent * F.greatest("na", "n")) & (percent * (F.col("na") + F.col("n")) <= (100 + percent) * F.least("ra", "reach"))
    pairs = members.where((F.col("id") != F.col("a")) & fits).groupBy("id", "n", "a", "na").agg(F.count("*").alias("c")).groupBy("id", "n").agg(F.max(F.struct("c", (-F.col("a")).alias("a"), "na")).alias("m"))
    pairs = stored(pairs.select((-F.col("m.a")).alias("a"), "m.na", F.col("id").alias("b"), F.col("n").alias("nb")), "pairs")
    bits = lambda c: parity.select(F.col("id").alias(c), F.col("bits").alias(f"{c}_bits"))
    apart = F.aggregate(F.zip_with("a_bits", "b_bits", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
    pairs = stored(pairs.join(bits("b"), "b").join(bits("a"), "a").where(apart * (100 + percent) <= (100 - percent) * (F.col("na") + F.col("nb"))).select("a", "na", "b", "nb"), "pairs")
    leaders = stored(pairs.select("a").distinct(), "leaders")
    sets = made(pairs.select(F.col("a").alias("id")).union(pairs.select("b")), _signed, "elements")
    pairs = sets.select(F.col("id").alias("b"), F.col("elements").alias("eb")).join(small(pairs), "b") \
        .join(sets.select(F.col("id").alias("a"), F.col("elements").alias("ea")).join(small(leaders), "a", "left_semi"), "a")
    inter = F.col("na") - F.size("minus")
    star = stored(pairs.withColumn("minus", F.array_except("ea", "eb")).where(100 * inter >= percent * (F.col("na") + F.col("nb") - inter))
                  .select("a", "b", "minus", F.array_except("eb", "ea").alias("plus")), "links")
    known = star.select("a", "b").union(one_node)

    nodes = components(known)
    named = members.join(nodes.withColumnRenamed("node", "id"), "id", "left").select("element", "band", "id", "n", F.coalesce("root", "id").alias("comp"))
    live = named.groupBy("element", "band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("element", "band")
    rest = stored(named.join(live, ["element", "band"], "left_semi"), "live")
    main = rest.groupBy("element", "band", "comp").agg(F.count("*").alias("c")).groupBy("element", "band").agg(F.max(F.struct("c", "comp"))["comp"].alias("unit"))
    met = stored(rest.join(main, ["element", "band"]).select("unit", "id", "n", "comp").distinct(), "met")
    visit, stay = _in_blocks(met)
    alive = stored(visit.unionByName(stay).join(parity, "id").repartition("unit", "vb", "rb").sortWithinPartitions("unit", "vb", "rb")
                   .transform(in_arrow, _possible(percent), "unit long, id long").distinct(), "alive")
    visit, stay = _in_blocks(met.join(alive, ["unit", "id"], "left_semi"))
    none = F.array().cast("array<long>")
    answers = star.select(F.col("b").alias("id"), F.col("a").alias("leader"), "minus", "plus")
    stay = stay.join(answers, "id", "left").withColumn("leader", F.coalesce("leader", "id")).withColumn("minus", F.coalesce("minus", none)).withColumn("plus", F.coalesce("plus", none))
    lead = stay.select("unit", "vb", "rb", F.lit(LEADER).alias("kind"), F.col("leader").alias("id")).distinct().select("*", F.lit(0).cast("long").alias("comp"), F.lit(0).cast("long").alias("n"))
    sets = made(visit.select("id").union(lead.select("id")), _signed, "elements")
    full = visit.unionByName(lead).join(sets.select("id", F.col("elements").alias("plus")), "id").withColumn("leader", F.col("id")).withColumn("minus", none)
    found = stay.unionByName(full).repartition("unit", "vb", "rb").sortWithinPartitions("unit", "vb", "rb").transform(in_arrow, _block_links(percent), "a long, b long")

    final = classes.select("id", "same", "doc_id").join(components(known.union(found)).withColumnRenamed("node", "id"), "id", "left") \
        .select("same", "doc_id", F.coalesce("root", "id").alias("root"))
    least = final.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = final.join(least, "root").select("same", "component_id")
    out = feats.select("doc_id", F.col("n").alias("n_shingles"), F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("same")).alias("same")).join(named, "same", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
