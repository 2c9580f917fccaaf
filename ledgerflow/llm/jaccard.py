"""N-gram Jaccard join by a blocked sparse product of the document by n-gram incidence.

Links: documents whose sets of word n-grams have Jaccard similarity of at least
``percent`` / 100, decided in whole numbers on the exact sets (64-bit hashes of n-grams).

1. Classes. Documents with the same set are one row of the matrix from here on, named by 64
   bits of the set's digest.
2. Size-derived bound on single rows. A partner of a set of n n-grams shares at least
   n * percent / 100 of them, so at most n * (100 - percent) / 100 occur nowhere else.
   The n-grams of a fixed part of the hash space, twice that share of it, are counted over
   all documents, and rows with more unshared ones than the bound are left out: exact, and
   in ordinary text most rows.
3. Blocks. Remaining rows are cut to the columns that can meet a partner: n-grams in order
   of document frequency, the first n - ceil(n * percent / 100) + 1, without those that
   occur once. Rows that have a column in common form a block.
4. Product. Within a block the overlap counts of all rows are accumulated as a product of
   incidence matrices, pairs whose sizes or counts are below the bound dropped. First every
   row meets only the block's row of the smallest doc_id; links found so are merged into components, and
   blocks whose rows are in one component are finished. The others are dealt out as tiles
   of about 2 * ``TILE`` rows of sizes that can link, so that a block of any size is never in
   one task and rows of far sizes never meet. A tile is
   multiplied twice: first over columns folded to parities, ``BITS`` or more for long rows,
   which bounds the difference of two sets from below, then, with the rows that still have a partner in
   another component, over the columns themselves. It puts out a spanning forest of its
   links, never all its pairs.

Cases: null and empty texts have no n-grams, link with nothing and are their own
component; texts with fewer words than n have their whole word sequence as the only
n-gram; repeated rows are one class; a repeated doc_id is one document with several texts,
whose links it joins (a text without words stays its own component); rows without a doc_id are
linked like others, their component is the smallest doc_id in it, null where none has one;
extra columns are ignored. ``keep_first`` decides by texts: a doc_id with two unlike texts keeps
both.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import components, cut, discard, mix64, texts

TILE, BITS = 512, 2048
#: N-grams of a part of a tile, about, and those multiplied in one go.
CELLS, STEP = 4_000_000, 400_000
#: Hashes of n-grams counted together, and rows whose counts are added up together.
BUCKET, SHARE = 2_000_000, 100_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < 600_000:
            self[word] = h
        return h


@functools.lru_cache(maxsize=1)
def _hashes() -> _Hashes:
    return _Hashes()


def shingle_set(text: str, n: int) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams of ``text``, A-Z lower-cased."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(_hashes().__getitem__, words), np.uint64, len(words))
    width = min(n, len(w))
    h = np.full(len(w) - width + 1, np.uint64(width))
    for k in range(width):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + w[k: len(w) - width + 1 + k])
    return np.unique(h)


def _sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for b in batches:
        yield b, [shingle_set(t, n) for t in b.column("text").to_pylist()]


def _digest(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def _cls(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, key): a row is known by its doc_id, which may be null, and a hash of its text."""
    return texts(docs).withColumn("key", F.xxhash64("text"))


def document_sets(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(doc_id, key, n_shingles, digest, cls, zone): a hash of the text, the set's size, a 128-bit
    digest and half of it as a number, and the low 48 bits of the set's hashes in the counted
    part of the hash space, the lowest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = np.uint64(min(2 ** 64 - 1, 2 ** 64 * 2 * (100 - percent) // 100))
        for b, sets in _sets(batches, n):
            digests = [_digest(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("key"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()),
                 pa.array([_cls(d) for d in digests], pa.int64()),
                 pa.array([_packed48(s[: np.searchsorted(s, top)]) for s in sets], pa.binary())],
                ["doc_id", "key", "n_shingles", "digest", "cls", "zone"])

    return _keyed(docs).mapInArrow(run, "doc_id long, key long, n_shingles long, digest binary, cls long, zone binary")


def _packed48(h: np.ndarray) -> bytes:
    """The low 48 bits of 64-bit values."""
    return h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpacked48(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def unshared(own: DataFrame) -> DataFrame:
    """(cls, alone): how many n-grams of a class's zone no other class has.

    Hashes go to buckets in packs of many documents, eight bytes each, and a bucket, whose
    number follows the data, is counted in one task; the buckets' counts are added up by
    shares of the classes. Two n-grams that agree in 48 bits count
    as one shared: that keeps a row longer and loses none."""
    hashes = own.agg(F.sum(F.length("zone")).alias("n")).first()["n"] or 0
    buckets = 1 + hashes // 6 // BUCKET
    shares = 1 + own.count() // SHARE

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                zones = part.column("zone").to_pylist()
                h = _unpacked48(b"".join(zones))
                row = np.repeat(np.arange(len(zones), dtype=np.uint16), [len(z) // 6 for z in zones])
                bucket = (h % np.uint64(buckets)).astype(np.int64)
                by = np.argsort(bucket, kind="stable")
                edge = np.searchsorted(bucket[by], np.arange(buckets + 1))
                cls = part.column("cls").to_numpy()
                out = []
                for k, (x, y) in enumerate(zip(edge, edge[1:])):
                    if y > x:
                        mine, place = np.unique(row[by[x:y]], return_inverse=True)
                        out.append((k, cls[mine].tobytes(), place.astype(np.uint16).tobytes(), _packed48(h[by[x:y]])))
                if out:
                    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                                     ["bucket", "classes", "places", "hashes"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, ["bucket"]):
            h = np.concatenate([_unpacked48(x.as_py()) for x in t.column("hashes")])
            cls = np.concatenate([np.frombuffer(c.as_py(), np.int64)[np.frombuffer(p.as_py(), np.uint16)]
                                  for c, p in zip(t.column("classes"), t.column("places"))])
            by = np.argsort(h, kind="stable")
            h, cls = h[by], cls[by]
            first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            low = np.minimum.reduceat(cls, first)
            # counted by class: the exact copies of a text do not make its n-grams shared
            found, times = np.unique(low[low == np.maximum.reduceat(cls, first)], return_counts=True)
            share = (found.view(np.uint64) % np.uint64(shares)).astype(np.int64)
            by = np.argsort(share, kind="stable")
            found, times, edge = found[by], times[by], np.searchsorted(share[by], np.arange(shares + 1))
            out = [(k, found[x:y].tobytes(), times[x:y].astype(np.uint32).tobytes())
                   for k, (x, y) in enumerate(zip(edge, edge[1:])) if y > x]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.binary(), pa.binary()))],
                                                 ["share", "classes", "times"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, ["share"]):
            cls, place = np.unique(np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in t.column("classes")]), return_inverse=True)
            alone = np.bincount(place, np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in t.column("times")]))
            yield pa.RecordBatch.from_arrays([pa.array(cls), pa.array(alone.astype(np.int64))], ["cls", "alone"])

    packs = own.select("cls", "zone").mapInArrow(pack, "bucket int, classes binary, places binary, hashes binary")
    counts = (packs.repartition("bucket").sortWithinPartitions("bucket")
              .mapInArrow(count, "share int, classes binary, times binary"))
    return counts.repartition("share").sortWithinPartitions("share").mapInArrow(total, "cls long, alone long")


def _room(percent: int):
    """How many of a row's n-grams a partner may lack."""
    return F.floor(F.col("n") * (100 - percent) / 100)


def _folded(s: np.ndarray) -> bytes:
    """The parities of a set's columns folded to ``BITS``, or for a long row to the power of two
    times that which is at least twice its length: two of these differ in no more places than
    the sets do, and those of unlike sets in many more."""
    bits = BITS << ((2 * len(s) - 1) // BITS).bit_length()
    return np.packbits(np.bincount((s % np.uint64(bits)).astype(np.int64), minlength=bits) & 1).tobytes()


def _same_width(folded: list[bytes]) -> np.ndarray:
    """Folded rows, one a line, folded on to the narrowest of them."""
    width = min(map(len, folded))
    return np.array([np.bitwise_xor.reduce(np.frombuffer(f, np.uint8).reshape(-1, width), axis=0) for f in folded]).view(np.uint64)


def candidate_rows(docs: DataFrame, own: DataFrame, classes: DataFrame, n: int, percent: int) -> DataFrame:
    """(cls, rep, n, folded, hashes) of the rows that can have a partner (step 2)."""
    likely = (classes.join(unshared(own), "cls", "left").where(F.coalesce(F.col("alone"), F.lit(0)) <= _room(percent))
              .select(F.col("low.doc_id").alias("at_id"), F.col("low.key").alias("at_key"), F.col("cls").alias("wanted"),
                      F.coalesce("low.doc_id", F.lit(2 ** 63 - 1)).alias("rep")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, sets in _sets(batches, n):
            found = [(c, i, len(s), _folded(s), s.view(np.int64)) for c, i, s in
                     zip(b.column("wanted").to_pylist(), b.column("rep").to_pylist(), sets) if _cls(_digest(s)) == c]
            if found:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found), kinds)],
                                                 ["cls", "rep", "n", "folded", "hashes"])

    rows = (_keyed(docs).join(likely, F.col("doc_id").eqNullSafe(F.col("at_id")) & (F.col("key") == F.col("at_key")))
            .select("text", "wanted", "rep").mapInArrow(run, "cls long, rep long, n long, folded binary, hashes array<long>"))
    return rows.dropDuplicates(["cls"]) if _repeated(own) else rows


def _repeated(own: DataFrame) -> bool:
    """Whether a doc_id and text come twice."""
    return bool(own.groupBy("doc_id", "key").count().where("count > 1").limit(1).count())


def block_columns(rows: DataFrame, percent: int) -> DataFrame:
    """(h, cls, rep, n): the columns in which a row can meet a partner (step 3)."""
    cells = rows.select("cls", "rep", "n", F.explode("hashes").alias("h"))
    df = cut(cells.groupBy("h").agg(F.count("*").alias("df")).where("df > 1"), "jaccard-df")
    row = Window.partitionBy("cls")
    shared = cells.join(df, "h").withColumns({
        "shared": F.count("*").over(row), "at": F.row_number().over(row.orderBy("df", "h"))})
    return shared.where(F.col("at") <= _room(percent) + 1 - (F.col("n") - F.col("shared"))).select("h", "cls", "rep", "n")


def _near(n: np.ndarray, m: np.ndarray, overlap: np.ndarray, percent: int) -> np.ndarray:
    return 100 * overlap >= percent * (n + m - overlap)


def _links_to_first(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """The pairs of classes (p, q) that link, by the exact sets, as (a, b)."""
    left = rows.select(F.col("cls").alias("p"), F.col("n").alias("na"), F.col("hashes").alias("ha"))
    right = rows.select(F.col("cls").alias("q"), F.col("n").alias("nb"), F.col("hashes").alias("hb"))
    overlap = F.size(F.array_intersect("ha", "hb"))
    return (pairs.join(right, "q").join(left, "p").select(F.col("p").alias("a"), F.col("q").alias("b"), "na", "nb", overlap.alias("o"))
            .where(100 * F.col("o") >= percent * (F.col("na") + F.col("nb") - F.col("o"))).select("a", "b"))


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key, for batches that come sorted by the keys."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        k = np.column_stack([b.column(c).to_numpy() for c in keys])
        edge = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
        for x, y in zip([0, *edge.tolist()], [*edge.tolist(), b.num_rows]):
            now = tuple(k[x])
            if held and now != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(x, y - x))
            last = now
    if held:
        yield pa.Table.from_batches(held)


def _apart(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The sizes of a tile's rows, and which pairs of them it is to look at: those of different
    components and, in a tile of two parts, of different parts."""
    n, comp, side = (t.column(c).to_numpy() for c in ("n", "comp", "side"))
    look = comp[:, None] != comp[None, :]
    if side.min() != side.max():
        look &= side[:, None] != side[None, :]
    return n, look


def _possible(t: pa.Table, percent: int) -> np.ndarray:
    """Which rows of a tile can have a link in it, by size and folded columns."""
    n, look = _apart(t)
    few, many = np.minimum(n[:, None], n[None, :]), np.maximum(n[:, None], n[None, :])
    look &= 100 * few >= percent * many
    a, b = np.nonzero(np.triu(look, 1))
    if not len(a):
        return np.zeros(len(n), bool)
    bits = _same_width(t.column("folded").to_pylist())
    ok = np.zeros(len(n), bool)
    pairs = max(1, 8192 * BITS // 64 // bits.shape[1])
    for k in range(0, len(a), pairs):
        i, j = a[k: k + pairs], b[k: k + pairs]
        differ = np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1, dtype=np.int64)
        # overlap is (n + m - difference) / 2 at most
        near = (100 + percent) * (n[i] + n[j] - differ) >= 2 * percent * (n[i] + n[j])
        ok[i[near]] = True
        ok[j[near]] = True
    return ok


def _tile_links(t: pa.Table, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among a tile's rows, by the product of their incidence
    matrices over the columns that two of them share."""
    n, look = _apart(t)
    cls, comp = t.column("cls").to_numpy(), t.column("comp").to_numpy()
    sets = t.column("hashes").combine_chunks()
    every_row = np.repeat(np.arange(len(n), dtype=np.int32), np.diff(sets.offsets.to_numpy()))
    cells = sets.flatten().to_numpy()
    overlap = np.zeros((len(n), len(n)), np.float32)
    steps = 1 + len(cells) // STEP
    step = (cells.view(np.uint64) % np.uint64(steps)).astype(np.int32)
    for k in range(steps):  # all cells of a column are in one step
        now = step == k
        _, column, times = np.unique(cells[now], return_inverse=True, return_counts=True)
        common = times[column] > 1
        row, column = every_row[now][common], column[common]
        _, column = np.unique(column, return_inverse=True)
        width = int(column.max(initial=-1)) + 1
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        for a in range(0, width, 4096):  # a block of columns at a time
            part = slice(*np.searchsorted(column, [a, a + 4096]))
            x = np.zeros((len(n), min(4096, width - a)), np.float32)
            x[row[part], column[part] - a] = 1
            overlap += x @ x.T
    near = _near(n[:, None], n[None, :], overlap.astype(np.int64), percent) & look
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    out = []
    for a, b in zip(*np.nonzero(np.triu(near, 1))):
        ca, cb = find(int(comp[a])), find(int(comp[b]))
        if ca != cb:
            root[max(ca, cb)] = min(ca, cb)
            out.append((int(cls[a]), int(cls[b])))
    return out


def _size_class(percent: int):
    """A row's size on a scale on which sizes that can link are at most two apart."""
    width = max(1e-12, math.log(100 / percent) / 2 * (1 + 1e-9))
    return F.floor(F.ln("n") / F.lit(width)).cast("long")


def _tiles(placed: DataFrame, percent: int) -> tuple[DataFrame, list[DataFrame]]:
    """(h, sa, sb, i, j, side, cls, n, comp), and the tables it reads: the rows of unfinished blocks, dealt out. The rows
    of a block fall into size classes, each dealt by hash into parts of about ``TILE`` rows, or ``CELLS`` n-grams if that is less; there
    is a tile for every two parts of size classes at most two apart, and for each part alone,
    unless all their rows are in one component."""
    sized = placed.withColumn("sc", _size_class(percent))
    groups = cut(sized.groupBy("h", "sc").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                              F.ceil(F.greatest(F.count("*") / TILE, F.sum("n") / CELLS)).cast("int").alias("parts")), "jaccard-groups")
    a = groups.select("h", F.col("sc").alias("sa"), F.col("lo").alias("la"), F.col("hi").alias("ha"), F.col("parts").alias("pa"),
                      F.explode(F.expr("sequence(sc, sc + 2)")).alias("sb"))
    b = groups.select("h", F.col("sc").alias("sb"), F.col("lo").alias("lb"), F.col("hi").alias("hb"), F.col("parts").alias("pb"))
    pairs = cut(a.join(b, ["h", "sb"]).where(F.least("la", "lb") < F.greatest("ha", "hb")).select("h", "sa", "sb", "pa", "pb"),
                "jaccard-pairs")
    first = pairs.select("h", F.col("sa").alias("sc"), F.lit(0).alias("side"), "sa", "sb", F.col("pa").alias("own"), F.col("pb").alias("parts"))
    second = (pairs.where("sa < sb")
              .select("h", F.col("sb").alias("sc"), F.lit(1).alias("side"), "sa", "sb", F.col("pb").alias("own"), F.col("pa").alias("parts")))
    # written first, so that a hot block's rows can be split over the tasks of the join
    rows = cut(sized.join(pairs.select("h").distinct(), "h", "left_semi"), "jaccard-open")
    dealt = (rows.join(first.union(second), ["h", "sc"])
             .withColumn("mine", F.pmod(F.xxhash64("cls", "h"), F.col("own")).cast("int"))
             .withColumn("theirs", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))))
    one, mine, theirs = F.col("sa") == F.col("sb"), F.col("mine"), F.col("theirs")
    tiles = dealt.select(
        "h", "sa", "sb",
        F.when(one, F.least(mine, theirs)).when(F.col("side") == 0, mine).otherwise(theirs).alias("i"),
        F.when(one, F.greatest(mine, theirs)).when(F.col("side") == 0, theirs).otherwise(mine).alias("j"),
        F.when(one, (mine > theirs).cast("int")).otherwise(F.col("side")).alias("side"), "cls", "n", "comp")
    return tiles, [groups, pairs, rows]


def links(rows: DataFrame, columns: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) of classes that connect exactly the components of all links (step 4)."""
    spark = rows.sparkSession
    first = (columns.groupBy("h").agg(F.min(F.struct("rep", "cls", "n")).alias("f"), F.count("*").alias("rows"))
             .where("rows > 1").select("h", F.col("f.cls").alias("p"), F.col("f.n").alias("np")))
    pairs = (columns.join(first, "h").where("cls <> p").where(100 * F.least("n", "np") >= percent * F.greatest("n", "np"))
             .select("p", F.col("cls").alias("q")).distinct())
    star = cut(_links_to_first(pairs, rows, percent), "jaccard-star")
    merged = components(star, "jaccard-cc")
    placed = (columns.join(merged.withColumnRenamed("id", "cls"), "cls", "left")
              .withColumn("comp", F.coalesce("comp", "cls")))
    tiles, read = _tiles(placed, percent)
    keys = ["h", "sa", "sb", "i", "j"]

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition(*keys).sortWithinPartitions(*keys, "n", "cls")

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, keys):
            ok = _possible(t, percent)
            if ok.any():
                yield from t.filter(pa.array(ok)).drop_columns(["folded"]).combine_chunks().to_batches()

    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, keys):
            if found := _tile_links(t, percent):
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], ["a", "b"])

    kind = "h long, sa long, sb long, i int, j int, side int, cls long, n long, comp long"
    folded = tiles.join(rows.select("cls", "folded"), "cls").select(*[c.split()[0] for c in kind.split(", ")], "folded")
    sifted = cut(dealt(folded).mapInArrow(sift, kind), "jaccard-sifted")
    for t in [merged, *read]:
        discard(spark, t)
    more = cut(dealt(sifted.join(rows.select("cls", "hashes"), "cls")).mapInArrow(product, "a long, b long"), "jaccard-more")
    discard(spark, sifted)
    return star.union(more)


def _classes(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows' sets (doc_id, key, n_shingles, digest, cls), the classes (digest, low, n, cls), low
    being the class's smallest row, and the links of classes (a, b)."""
    spark = docs.sparkSession
    zoned = cut(document_sets(docs, n, percent), "jaccard-zones")
    own = cut(zoned.drop("zone"), "jaccard-sets")
    classes = cut(own.where("n_shingles > 0").groupBy("digest")
                  .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")).alias("low"),
                       F.min("n_shingles").alias("n"), F.min("cls").alias("cls")), "jaccard-classes")
    rows = cut(candidate_rows(docs, zoned, classes, n, percent), "jaccard-rows")
    discard(spark, zoned)
    columns = cut(block_columns(rows, percent), "jaccard-columns")
    # only rows that share a block with another are looked at again: their sets are moved on
    met = columns.groupBy("h").agg(F.count("*").alias("rows")).where("rows > 1").select("h")
    live = cut(columns.join(met, "h", "left_semi").select("cls").distinct(), "jaccard-live")
    every, rows = rows, cut(rows.join(live, "cls", "left_semi"), "jaccard-live-rows")
    discard(spark, every)
    found = cut(links(rows, columns, percent), "jaccard-links")
    for t in (live, rows, columns):
        discard(spark, t)
    return own, classes, found


def _lowest(classes: DataFrame, edges: DataFrame) -> DataFrame:
    """(digest, low): for every class the smallest row of its component."""
    merged = components(edges, "jaccard-all").withColumnRenamed("id", "cls")
    # written first: a join straight behind an aggregation could not be split where one
    # component has very many classes
    least = cut(merged.join(classes.select("cls", "low"), "cls").groupBy("comp").agg(F.min("low").alias("least")), "jaccard-least")
    return (classes.join(merged, "cls", "left").join(least, "comp", "left")
            .select("digest", F.coalesce("least", "low").alias("low")))


def jaccard_components(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    own, classes, edges = _classes(docs, n, percent)
    # a doc_id with several texts joins their classes
    several = cut(own.where("doc_id IS NOT NULL AND n_shingles > 0").groupBy("doc_id")
                  .agg(F.min("cls").alias("a"), F.max("cls").alias("last")).where("a < last").select("doc_id", "a"), "jaccard-several")
    same = own.where("n_shingles > 0").join(several, "doc_id").select("a", F.col("cls").alias("b")).where("a <> b").distinct()
    # written first, like the frequencies above, so that the join can be split where one set
    # has very many documents
    of_class = cut(_lowest(classes, edges.union(same)).select("digest", F.col("low.doc_id").alias("component_id")), "jaccard-components")
    return (own.select("doc_id", "n_shingles", "digest").join(of_class, "digest", "left")
            .select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def keep_first(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row, all columns, of each component of texts: that of the smallest doc_id, rows without
    one last, and of its texts that of the smallest hash. All rows without words stay."""
    own, classes, edges = _classes(docs, n, percent)
    first = _lowest(classes, edges).select(F.col("low.doc_id").alias("_kept_id"), F.col("low.key").alias("_kept_key"), F.lit(True).alias("_words"))
    bare = own.where("n_shingles = 0").select("doc_id", "key", F.lit(False))
    wanted = cut(first.union(bare).distinct(), "jaccard-kept")
    kept = docs.join(wanted, docs["doc_id"].cast("long").eqNullSafe(wanted["_kept_id"])
                     & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == wanted["_kept_key"]))
    if _repeated(own.where("n_shingles > 0")):
        order = Window.partitionBy("_kept_id", "_kept_key").orderBy("_kept_key")
        once = kept.where("_words").withColumn("_kept_at", F.row_number().over(order)).where("_kept_at = 1").drop("_kept_at")
        kept = once.union(kept.where("NOT _words"))
    return kept.drop("_kept_id", "_kept_key", "_words")
