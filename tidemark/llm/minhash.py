"""Near duplicates by MinHash: an inverted join over signature coordinates, confirmed on full shingle sets.

A signature has ``HASHES`` minimum hashes, two for each of its ``COORDINATES``. Each (coordinate, value)
pair is a posting list; two values in a coordinate keep the lists of unlike texts short. A pair of sets at
the similarity threshold agrees in a coordinate with probability 0.64; pairs agreeing in fewer than
``MATCHES`` coordinates or ``LIKELY`` hashes are not kept (at similarity 0.8 that loses fewer than one pair
in 10^6, see ``expected_loss``). Skip merging: in any fixed order of the lists two sets that agree in
MATCHES coordinates share at least ``SHARED`` of their first ``COORDINATES - MATCHES + SHARED`` lists; the
order is by list length, so the long lists are never merged.

Groups of copies: exact copies are one class before any list is built. A first round compares each class
with a few leaders: the first members of its lists in some fixed orders, which are the same few texts in
all lists of a group. List members that are in one component after that are not compared again (they could
add no new connection), so a group of n near copies costs about n comparisons. The second round merges
what is left of the lists completely: classes that share enough lists with other components are compared
by their rarest shingles, an exact bound that rules out the many pairs of a group that are alike but not
enough.
"""

from __future__ import annotations

import math

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, arrow_map, batch_map, components

HASHES = 128
COORDINATES = HASHES // 2
MATCHES = 20
SHARED = 3
LIKELY = 72
ORDERS = 4
LEADERS, BEST, BRIDGES = 6, 4, 8
#: Ids up to this many are sent to all tasks (16 MB) to pick their texts; more are joined.
SENT_IDS = 1_000_000
SEED = 20240501
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Distinct word shingles of a text as sorted 64-bit hashes; words are runs of non-space bytes, A-Z lower-cased."""

    def __init__(self, width: int, cache: int = 200_000):
        self.width, self.cache, self.known = width, cache, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        known = self.known
        if len(known) > self.cache:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        width = min(self.width, len(words))
        out = mix(h[: len(h) - width + 1] + np.uint64(width))
        for k in range(1, width):
            out = mix(out * np.uint64(3) + h[k : len(h) - width + 1 + k])
        return np.unique(out)


def coefficients(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, n).astype(np.uint64)


def signature(hashes: np.ndarray, a: np.ndarray, b: np.ndarray, step: int = 8192) -> np.ndarray:
    """Minimum of each of the hash functions over the set, in blocks of bounded size."""
    low = np.full(len(a), 2**32 - 1, np.uint64)
    for start in range(0, len(hashes), step):
        part = hashes[start : start + step]
        low = np.minimum(low, ((part[None, :] * a[:, None] + b[:, None]) >> np.uint64(32)).min(1))
    return low.astype(np.uint32)


def _sets(docs: DataFrame, width: int, with_set: bool) -> DataFrame:
    """doc, n, fp (128-bit fingerprint of the set), and the signature or the set itself."""
    def rows(source):
        shingle, (a, b) = Shingler(width), coefficients(HASHES, SEED)
        for row in source:
            s = shingle(row["text"])
            raw = s.tobytes()
            fp = xxhash.xxh3_128_digest(raw) if len(s) else None
            yield row["doc"], len(s), fp, (raw if with_set else signature(s, a, b).tobytes() if len(s) else None)

    return arrow_map(docs, "doc long, n long, fp binary, data binary", rows, size=200)


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: ``id_col``, n_shingles, component_id (smallest id reachable over links), kept.

    Two documents are linked if 100 * |intersection| >= percent * |union| of their shingle sets
    (``width`` words; fewer words: the whole sequence as one). Texts that are null, empty or white space
    have no set and are linked with nothing. A row without id is counted but takes no part: component_id
    and kept are null. Rows that repeat an id are one document, linked with all that its rows are linked
    with. Other columns, whatever their names, are ignored; an empty table gives no rows.
    """
    # Threshold below 80 needs fewer matches, above it the stricter set check decides.
    if percent < 80:
        raise ValueError("the match threshold is set for a similarity of 0.8 or more")
    scratch = Scratch(docs.sparkSession, "minhash")
    source = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    signed = scratch.keep(_sets(source, width, with_set=False))
    classes = scratch.keep(signed.where("doc is not null and fp is not null").groupBy("fp").agg(F.min("doc").alias("rep"), F.first("n").alias("n"), F.first("data").alias("sig")).withColumn("c", F.monotonically_increasing_id()))
    rows = scratch.keep(signed.select("doc", "n", "fp"))
    scratch.drop(signed)
    posts = _postings(classes, scratch)

    # the class that is in the longest lists is near the centre of its group
    orders = [-F.col("weight") if k == 0 else F.xxhash64("c", F.lit(k)) for k in range(ORDERS)]
    leader = posts.groupBy("key").agg(*[F.min(F.struct(o.alias("o"), "c", "n")).alias(f"l{k}") for k, o in enumerate(orders)])
    leader = scratch.keep(leader.select("key", F.array_distinct(F.array(*[F.struct(f"l{k}.c", f"l{k}.n") for k in range(ORDERS)])).alias("leads")))
    star = posts.join(leader, "key").select("c", "n", F.explode("leads").alias("lead")).where((F.col("c") != F.col("lead.c")) & _near("n", "lead.n", percent))
    star = star.groupBy("c", F.col("lead.c").alias("l")).agg(F.count("*").alias("hits"))
    # a class has at most ORDERS leaders in each of its lists
    star = star.groupBy("c").agg(F.slice(F.sort_array(F.collect_list(F.struct("hits", "l")), asc=False), 1, LEADERS).alias("best")).select("c", F.explode("best.l").alias("l"))
    first = scratch.keep(_confirm(star.select(F.col("c").alias("a"), F.col("l").alias("b"), F.col("c").alias("g")), classes, source, width, percent, scratch, best=BEST))

    ids = rows.where("doc is not null and fp is not null").select("doc", "fp").distinct().join(classes.select("fp", "c"), "fp")
    ids = ids.groupBy("doc").agg(F.min("c").alias("a"), F.max("c").alias("z"), F.collect_set("c").alias("all")).where("a <> z")
    first = scratch.keep(first.unionByName(ids.select("a", F.explode("all").alias("b"))))
    found = scratch.keep(components(first, scratch))

    open_ = _open_lists(posts, found, scratch)
    bridges = _confirm(_bridges(open_, percent), classes, source, width, percent, scratch, best=BRIDGES)
    found = _joined(found, bridges, scratch)
    open_ = _open_lists(open_.drop("component"), found, scratch)
    # a pair of different components shares SHARED lists, all of them open
    active = open_.groupBy("c", "n", "component").agg(F.count("*").alias("lists")).where(F.col("lists") >= SHARED).select("c", "n", "component")
    active = scratch.keep(active)
    full = scratch.keep(_full(active.select(F.col("c").alias("doc")), classes, source, width, scratch))
    pairs = _open_pairs(active, full, percent, scratch)
    second = scratch.keep(_confirm(pairs, classes, source, width, percent, scratch, full))
    scratch.drop(open_, leader, posts, active)
    found = _joined(found, second, scratch)
    place = scratch.keep(classes.select("fp", "rep", F.col("c").alias("node")).join(found, "node", "left").withColumn("component", F.coalesce("component", "node")))
    least = scratch.keep(place.groupBy("component").agg(F.min("rep").alias("place")))
    place = scratch.keep(place.join(least, "component").select("fp", "place"))
    out = rows.join(place, "fp", "left").withColumn("component_id", F.when(F.col("doc").isNotNull(), F.coalesce("place", "doc")))
    return out.select(F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), "component_id", (F.col("doc") == F.col("component_id")).alias("kept"))


def _near(a: str, b: str, percent: int):
    """Length bound: sets that differ more in size can't reach the threshold."""
    return 100 * F.least(F.col(a), F.col(b)) >= percent * F.greatest(F.col(a), F.col(b))


def _postings(classes: DataFrame, scratch: Scratch) -> DataFrame:
    """key, c, n, weight, the postings of each class that are among its first ones by list length and are shared."""
    def run(source):
        import pyarrow as pa

        for batch in source:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                values = np.frombuffer(b"".join(part.column("sig").to_pylist()), np.uint32).astype(np.uint64).reshape(-1, HASHES)
                keys = mix(mix(values[:, ::2] + (values[:, 1::2] << np.uint64(32))) + np.arange(COORDINATES, dtype=np.uint64))
                c = np.repeat(np.array(part.column("c").to_pylist(), np.int64), COORDINATES)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64).ravel()), pa.array(c)], names=["key", "c"])

    wide = scratch.keep(batch_map(classes.select("c", "sig"), run, "key long, c long"))
    lists = scratch.keep(wide.groupBy("key").agg(F.count("*").alias("df")).where("df > 1"))
    shared = wide.join(lists, "key")
    prefix = COORDINATES - MATCHES + SHARED
    own = shared.groupBy("c").agg(F.sort_array(F.collect_list(F.struct("df", "key"))).alias("p"))
    # lists that hold only this class come first in the order and are shared with nothing
    room = F.lit(prefix - COORDINATES) + F.size("p")
    weight = F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + x.df).alias("weight")
    own = own.where(room > 0).select("c", weight, F.slice("p", F.lit(1), room).alias("p")).join(classes.select("c", "n"), "c")
    out = scratch.keep(own.select("c", "n", "weight", F.explode("p").alias("q")).select(F.col("q.key").alias("key"), "c", "n", "weight"))
    scratch.drop(wide, lists)
    return out


def _open_lists(posts: DataFrame, found: DataFrame, scratch: Scratch) -> DataFrame:
    """Postings, with component, of the lists that hold classes of more than one component."""
    labelled = scratch.keep(posts.join(found.withColumnRenamed("node", "c"), "c", "left").withColumn("component", F.coalesce("component", "c")))
    mixed = scratch.keep(labelled.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("key"))
    out = scratch.keep(labelled.join(mixed, "key", "left_semi"))
    scratch.drop(labelled, mixed)
    return out


def _bridges(open_: DataFrame, percent: int) -> DataFrame:
    """a, b, g: in every open list each class outside the list's main component with one class inside, another one in each list."""
    main = open_.groupBy("key", "component").agg(F.count("*").alias("places"), F.min(F.struct(F.xxhash64("c", "key").alias("o"), "c", "n")).alias("to")).groupBy("key")
    main = main.agg(F.max(F.struct("places", "component", "to")).alias("m")).select("key", F.col("m.component").alias("main"), F.col("m.to.c").alias("b"), F.col("m.to.n").alias("nb"))
    pairs = open_.join(main, "key").where((F.col("component") != F.col("main")) & _near("n", "nb", percent))
    return pairs.select(F.col("c").alias("a"), "b", F.col("component").alias("g")).distinct()


def _joined(found: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """Components after further links."""
    if links.isEmpty():
        return found
    return scratch.keep(components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links), scratch))


def _open_pairs(active: DataFrame, full: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """a, b: pairs of different components that can reach the threshold, by their rarest shingles.

    Shingles of a set are ordered by how many open sets hold them. Two sets at the threshold share one of
    their first ``n - ceil(percent n / 100) + 1``, and behind the first that they share there must be room
    for the whole intersection. Sets of the component that holds most of a shingle's places are not
    compared with each other.
    """
    held = scratch.keep(arrow_map(full, "h long, c long", lambda rows_: ((h, r["doc"]) for r in rows_ for h in np.frombuffer(r["data"], np.int64).tolist()), size=20_000))
    rarity = scratch.keep(held.groupBy("h").agg(F.count("*").alias("df")))
    order = held.join(rarity, "h").groupBy("c").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("t"))
    first = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    first = active.join(order, "c").select("c", "n", "component", F.posexplode(F.slice("t", F.lit(1), first.cast("int"))).alias("at", "s"))
    first = scratch.keep(first.where("s.df > 1").select(F.col("s.h").alias("h"), "c", "n", "component", "at"))
    main = first.groupBy("h", "component").agg(F.count("*").alias("places")).groupBy("h")
    main = main.agg(F.max_by("component", F.struct("places", "component")).alias("main"), F.count("*").alias("kinds")).where("kinds > 1").select("h", "main")
    first_open = scratch.keep(first.join(scratch.keep(main), "h"))
    x, y = (first_open.select("h", "main", *[F.col(k).alias(f"{k}_{side}") for k in ("c", "n", "component", "at")]) for side in "xy")
    room = (100 + percent) * F.least(F.col("n_x") - F.col("at_x"), F.col("n_y") - F.col("at_y")) >= percent * (F.col("n_x") + F.col("n_y"))
    pairs = x.where("component_x <> main").join(y.drop("main"), "h").where((F.col("component_x") != F.col("component_y")) & _near("n_x", "n_y", percent) & room)
    pairs = scratch.keep(pairs.select(F.least("c_x", "c_y").alias("a"), F.greatest("c_x", "c_y").alias("b")).distinct())
    scratch.drop(held, rarity, first, first_open)
    return pairs


def _full(wanted: DataFrame, classes: DataFrame, source: DataFrame, width: int, scratch: Scratch) -> DataFrame:
    """doc, data: the full sets of the wanted classes, from the texts of their representatives."""
    wanted = scratch.keep(wanted.withColumnRenamed("doc", "c").join(classes.select("c", "rep", "fp"), "c"))
    ids = scratch.keep(wanted.select(F.col("rep").alias("doc")).distinct())
    full = _sets(source.join(F.broadcast(ids) if ids.count() <= SENT_IDS else ids, "doc", "left_semi"), width, with_set=True).where("fp is not null")
    # rows that repeat an id may hold other texts; a row that repeats the text is one too many
    full = full.join(wanted.select(F.col("rep").alias("doc"), "fp", "c"), ["doc", "fp"])
    return full.dropDuplicates(["c"]).select(F.col("c").alias("doc"), "data")


def _most_alike(pairs: DataFrame, best: int) -> DataFrame:
    """a, b of up to ``best`` pairs of each group: the most alike of each of ``best`` slots, as a group may be large."""
    parts = pairs.withColumn("slot", F.pmod(F.xxhash64("a", "b"), F.lit(best))).groupBy("g", "slot")
    return parts.agg(F.max(F.struct("n", "a", "b")).alias("p")).select("p.a", "p.b")


def _confirm(pairs: DataFrame, classes: DataFrame, source: DataFrame, width: int, percent: int, scratch: Scratch, full: DataFrame | None = None, best: int | None = None) -> DataFrame:
    """Pairs (a, b), of each group g only the ``best`` most alike ones if given, whose signatures agree in enough coordinates and whose full sets reach the threshold."""
    sig = classes.select("c", F.col("sig"))
    both = pairs.join(sig.select(F.col("c").alias("a"), F.col("sig").alias("x")), "a").join(sig.select(F.col("c").alias("b"), F.col("sig").alias("y")), "b")

    def agree(source):
        for r in source:
            n = int((np.frombuffer(r["x"], np.uint32) == np.frombuffer(r["y"], np.uint32)).sum())
            if n >= LIKELY:
                yield r["a"], r["b"], r["g"], n

    likely = arrow_map(both.select("a", "b", F.col("g") if best else F.lit(None).cast("long").alias("g"), "x", "y"), "a long, b long, g long, n long", agree)
    if best:
        likely = _most_alike(likely, best)
    likely = scratch.keep(likely.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    if full is None:
        full = scratch.keep(_full(likely.select(F.explode(F.array("a", "b")).alias("doc")).distinct(), classes, source, width, scratch))
    both = likely.join(full.select(F.col("doc").alias("a"), F.col("data").alias("x")), "a").join(full.select(F.col("doc").alias("b"), F.col("data").alias("y")), "b")

    def linked(source):
        for r in source:
            x, y = np.frombuffer(r["x"], np.uint64), np.frombuffer(r["y"], np.uint64)
            inter = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * inter >= percent * (len(x) + len(y) - inter):
                yield r["a"], r["b"]

    out = scratch.keep(arrow_map(both.select("a", "b", "x", "y"), "a long, b long", linked).distinct())
    scratch.drop(likely, full)
    return out


def expected_loss(similarity: float) -> float:
    """Bound on the chance that a pair of this similarity is not kept."""
    tail = lambda n, p, least: sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(least))
    return tail(COORDINATES, similarity**2, MATCHES) + tail(HASHES, similarity, LIKELY)
