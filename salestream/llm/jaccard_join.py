"""N-gram Jaccard join by PartEnum signatures: texts whose sets of five-word shingles have a similarity of ``4 / 5`` or more.

Two such sets of sizes a <= b have b <= 5 a / 4 and differ in at most (a + b) / 9 shingles, so in at most a / 4 as
seen from the smaller and 2 b / 9 as seen from the larger one.

1. Sizes are cut into bands, each half as long again as the one before. Each band has an instance of the scheme, for pairs whose smaller set is
   in the band: a set takes part in the instance of its band and, where it can be the larger one, in that of the band below.
2. An instance cuts the domain of shingles into more partitions than a pair may differ in. The enumerated subsets are the single
   partitions: a pair agrees on all but as many as it differs in. A set's signature for a partition is a hash of the
   shingles it has there. Empty partitions have none. A set with more occupied partitions than it may
   differ in shares a signature with every partner. One with fewer also takes part in a further instance of the
   same band with another cut, until it has enough; two such sets meet there.
3. Signatures that one set alone has are dropped after the one shuffle of all signatures; very frequent ones are found by a
   sketch, and their rows spread over several parts. A set probes with its least frequent signatures only: it agrees with a
   partner on so many that it can leave out as many of the most frequent ones as it has to spare, less one. What very many
   texts share, such as a passage, is thus compared only by sets that are made mostly of such things.
4. Candidates pass exact filters inside the join: sizes, a 256-bit parity sketch, in which each differing shingle flips
   one bit, and a wider one that grows with the sets, as large sets fill 256 bits. Only signatures in which components still meet are
   given sketches. Those left are compared by their whole sets of shingles.
5. For components, pairs within a group are not listed: each set is first compared with the least sets of its
   signatures (a linear number), those it shares most with, then with a member of the largest component of a signature, and at last
   only sets that still are in different components are.

``similar_pairs`` lists all links between different sets. Equal sets are one node throughout, so exact copies cost
nothing.

Shingles and sets are known by 64-bit hashes. Defined results: null and empty texts have no shingles and are linked with nothing,
each row a component of its own; texts of one to five words have one shingle. Null ids keep their rows and are
never the least. Rows that repeat id and text are one member. An empty table gives no rows. Other columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from salestream.llm.common import fits_broadcast, in_parts, remove, stored, table, write_path
from salestream.llm.simhash import components, shingle_hashes

SHINGLE = 5
#: Sizes below have no partner of another size or content at 4 / 5.
LEAST_SIZE = 4
#: Partitions for each difference allowed; more than 1, as some stay empty.
SPARE = 1.2
#: Heads of its signatures that a set is compared with at first.
FIRST_LINKS = 2
#: Signatures that the sketch names, its counters, the least count to name one, and the parts their rows are spread over.
NAMED, COUNTERS, LEAST_NAMED = 4096, 16384, 1000
SALTS = 64
#: Up to so many rows are handed to every task; more are shuffled.
MOST_KEYS = 200_000
SKETCH = ("s0", "s1", "s2", "s3")
#: Bits of the wide sketch for each shingle of a band's largest set, and the most of them.
WIDE, MOST_WIDE = 2, 1 << 14

_SEEDS = 16
_odd = np.random.default_rng(12).integers(0, 1 << 63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: bytes) -> np.ndarray:
    return np.unique(np.array(shingle_hashes(text, SHINGLE), dtype=np.uint64))


def band_of(size: int) -> tuple[int, int, int]:
    """(number, least size, least size of the next) of the band."""
    number, low = 0, LEAST_SIZE
    while True:
        above = low * 3 // 2
        if size < above:
            return number, low, above
        number, low = number + 1, above


def instances(size: int) -> list[tuple[int, int, int]]:
    """(band, partitions, differences allowed) of the instances that a set of this size takes part in."""
    if size < LEAST_SIZE:
        return []
    partitions = lambda above: int(((above - 1) // 4 + 1) * SPARE) + 1
    number, low, above = band_of(size)
    out = [(number, partitions(above), size // 4)]
    if number and -(-4 * size // 5) < low:  # a partner may be in the band below
        out.append((number - 1, partitions(low), 2 * size // 9))
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def signatures(shingles: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
    """(instance, spare, signatures): spare says how many of the signatures the set can do without.

    The last twelve bits of a signature are those of its instance (band and cut).
    """
    out = []
    for band, n_partitions, allowed in instances(len(shingles)):
        cut = 0
        while True:
            instance = (band * _SEEDS + cut) % 4096
            part = ((shingles * _odd[instance]) >> np.uint64(32)) % np.uint64(n_partitions)
            sums = np.zeros(n_partitions, dtype=np.uint64)
            np.add.at(sums, part, _mixed(shingles + _odd[instance]))
            held = np.flatnonzero(np.bincount(part.astype(np.int64), minlength=n_partitions))
            signed = _mixed(sums[held] + _odd[held % 4096] * (held + 1).astype(np.uint64))
            signed = (signed & ~np.uint64(4095)) | np.uint64(instance)
            out.append((instance, len(held) - allowed, signed.view(np.int64)))
            if len(held) > allowed:
                break
            cut += 1
            if cut == _SEEDS:  # by chance never; then every set of the band would need more cuts
                raise ValueError(f"no cut spreads a set of {len(shingles)} shingles")
    return out


def sketch(shingles: np.ndarray) -> np.ndarray:
    """256 bits; each is the parity of the shingles that hash to it."""
    odd = np.bincount((shingles >> np.uint64(56)).astype(np.int64), minlength=256) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def wide_sketch(shingles: np.ndarray) -> np.ndarray:
    """Like ``sketch``, of a power of two of bits by the band; a partner's is as wide, or half or twice as wide and folds."""
    n_bits, wanted = 256, min(MOST_WIDE, WIDE * band_of(len(shingles))[2])
    while n_bits < wanted:
        n_bits *= 2
    odd = np.bincount((shingles & np.uint64(n_bits - 1)).astype(np.int64), minlength=n_bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= 80 * (len(a) + len(b) - both)


_GROUPS = pa.list_(pa.struct([("instance", pa.int32()), ("spare", pa.int32()), ("sigs", pa.list_(pa.int64()))]))
_SIGNED = ("doc_id long, text_key long, node long, size long, s0 long, s1 long, s2 long, s3 long, wide array<bigint>, "
           "groups array<struct<instance:int,spare:int,sigs:array<bigint>>>")


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()  # copies within a task are signed once
    for batch in in_parts(batches):
        nodes, sizes, sketches, wides, groups = [], [], [], [], []
        for text in batch.column(2):
            shingles = shingle_set(text.as_py() or b"")
            node = xxhash.xxh64_intdigest(shingles.tobytes())
            nodes.append(node)
            sizes.append(len(shingles))
            sketches.append(sketch(shingles))
            wides.append(wide_sketch(shingles))
            groups.append([] if node in seen else [
                {"instance": i, "spare": spare, "sigs": sigs} for i, spare, sigs in signatures(shingles)])
            seen.add(node)
        bits = np.array(sketches, dtype=np.int64).reshape(-1, 4)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(np.array(nodes, dtype=np.uint64).view(np.int64)),
             pa.array(sizes, pa.int64()), *(pa.array(bits[:, i].copy()) for i in range(4)),
             pa.array(wides, pa.list_(pa.int64())), pa.array(groups, _GROUPS)],
            names=["doc_id", "text_key", "node", "size", *SKETCH, "wide", "groups"])


def _keep_similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[int, np.ndarray] = {}

    def of(node: int, text: bytes | None) -> np.ndarray:
        if node not in known:
            if len(known) >= 64:
                known.clear()
            known[node] = shingle_set(text or b"")
        return known[node]

    for batch in in_parts(batches, 64):
        a, b, text_a, text_b = (batch.column(i).to_pylist() for i in range(4))
        hits = [similar(of(*x), of(*y)) for x, y in zip(zip(a, text_a, strict=True), zip(b, text_b, strict=True), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(hits, pa.bool_()))


def _text_key(text_col: str):
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def _row_key(doc_id, text_key):
    return F.concat_ws(":", doc_id.cast("string"), text_key.cast("string"))


def _near():
    """Whether sizes and sketches of a and b allow a link; exact for every linked pair."""
    flipped = sum((F.bit_count(F.col(f"{s}_a").bitwiseXOR(F.col(f"{s}_b"))) for s in SKETCH[1:]),
                  F.bit_count(F.col("s0_a").bitwiseXOR(F.col("s0_b"))))
    a, b = F.col("size_a"), F.col("size_b")
    return (F.least(a, b) * 5 >= F.greatest(a, b) * 4) & (flipped * 9 <= a + b)


def _near_wide():
    """The same of wide sketches, the wider one of two folded."""
    words = F.least(F.size("wide_a"), F.size("wide_b"))
    xor = lambda x, y: x.bitwiseXOR(y)
    folded = lambda c: F.when(F.size(c) > words, F.zip_with(
        F.slice(c, 1, words), F.slice(c, words + 1, words), xor)).otherwise(F.col(c))
    flipped = F.aggregate(F.zip_with(folded("wide_a"), folded("wide_b"), xor), F.lit(0), lambda n, x: n + F.bit_count(x))
    return flipped * 9 <= F.col("size_a") + F.col("size_b")


def _shared(flat: DataFrame) -> DataFrame:
    """sig, node, spare, head, n: rows of the signatures that several nodes of ``flat`` (sig, node, spare) have.

    head is the least node of the signature, n how many rows it has. A sketch names the most frequent signatures; their rows are
    spread over ``SALTS`` parts, each with its own head, so no task gets all rows of one. All other rows meet by
    signature after one shuffle. Which are named changes the work only.
    """
    top = flat.agg(F.expr(f"approx_top_k(sig, {NAMED}, {COUNTERS})").alias("top")).first()["top"]  # at most NAMED
    named = F.col("sig").isin([t["item"] for t in top or [] if t["count"] >= LEAST_NAMED])
    part = W.partitionBy("sig", F.pmod(F.xxhash64("sig", "node"), F.lit(SALTS)))
    heavy = flat.where(named).distinct().withColumns(
        {"head": F.min("node").over(part), "n": F.count("*").over(part) * SALTS})
    same = W.partitionBy("sig")
    others = (
        flat.where(~named)
        .withColumns({"head": F.min("node").over(same), "last": F.max("node").over(same), "n": F.count("*").over(same)})
        .where("head <> last").drop("last").distinct()
    )
    return heavy.unionByName(others)


class Join:
    """The join of one table of texts with itself, up to its candidates."""

    def __init__(self, df: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
        slim = df.select(F.col(id_col).cast("long").alias("doc_id"), _text_key(text_col).alias("text_key"),
                         F.col(text_col).cast("binary").alias("text"))
        self.texts = slim.select(_row_key(F.col("doc_id"), F.col("text_key")).alias("row_key"), "text")
        path = write_path(slim.mapInArrow(_sign, _SIGNED), "jaccard-signatures")
        rows = df.sparkSession.read.schema(_SIGNED).parquet(path)
        self.rows = stored(rows.select("doc_id", "node", "size"), "jaccard-rows")
        best = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")).alias("best")
        #: node, size, sketch, best (its least row); one row for each different set that is not empty
        self.nodes = stored(rows.where("size > 0").groupBy("node").agg(
            best, *(F.min(c).alias(c) for c in ("size", *SKETCH, "wide"))), "jaccard-nodes")
        signed = rows.select("node", F.explode("groups").alias("g"))
        flat = signed.select(F.explode("g.sigs").alias("sig"), "node", "g.spare")
        self.members = stored(_shared(flat), "jaccard-members")
        remove(df.sparkSession, path)

    def _facts(self, side: str) -> DataFrame:
        return self.nodes.select(F.col("node").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in ("size", *SKETCH)))

    def links(self, pairs: DataFrame) -> DataFrame:
        """Those of ``pairs`` (a, b) whose whole sets are similar, stored."""
        spark = pairs.sparkSession
        wide = lambda side: self.nodes.select(
            F.col("node").alias(side), F.col("size").alias(f"size_{side}"), F.col("wide").alias(f"wide_{side}"))
        near = pairs.join(wide("a"), "a").join(wide("b"), "b").where(_near_wide()).select("a", "b")
        paths = [write_path(near, "jaccard-pairs")]
        pairs = spark.read.schema("a long, b long").parquet(paths[0])
        wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        keys = self.nodes.select("node", _row_key(F.col("best.doc_id"), F.col("best.text_key")).alias("row_key"))
        wanted = stored(keys.join(wanted, "node", "left_semi"), "jaccard-wanted")
        wanted = F.broadcast(wanted) if fits_broadcast(wanted, MOST_KEYS) else wanted
        paths.append(write_path(self.texts.join(wanted, "row_key").select("node", "text").dropDuplicates(["node"]), "jaccard-texts"))
        texts = spark.read.schema("node long, text binary").parquet(paths[1])
        of = lambda side: texts.select(F.col("node").alias(side), F.col("text").alias(f"text_{side}"))
        full = pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "text_a", "text_b")
        links = stored(full.mapInArrow(_keep_similar, "a long, b long"), "jaccard-links")
        remove(spark, *paths)
        return links

    def _most_shared(self, heads: DataFrame) -> DataFrame:
        """a, b: of rows a, b (one for each shared signature) the few b for each a that it shares most with."""
        counted = heads.groupBy("a", "b").agg(F.count("*").alias("n"))
        near = counted.join(self._facts("a"), "a").join(self._facts("b"), "b").where(_near())
        best = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("less"), "b")))
        few = near.groupBy("a").agg(F.slice(best, 1, FIRST_LINKS).alias("bs"))
        return few.select("a", F.explode("bs.b").alias("b"))

    def first_pairs(self) -> DataFrame:
        """a, b: sets and the heads of their signatures."""
        return self._most_shared(self.members.where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b")))

    def next_pairs(self, roots: DataFrame) -> DataFrame:
        """a, b: sets outside the largest component of a signature, and a member of that component."""
        known = stored(self.members.select("sig", "node").join(roots, "node"), "jaccard-rooted")
        by_root = known.groupBy("sig", "root").agg(F.count("*").alias("n"), F.max("node").alias("head"))
        top = by_root.groupBy("sig").agg(F.max(F.struct("n", "root", "head")).alias("top"), F.count("*").alias("n_roots"))
        top = top.where("n_roots > 1").select("sig", "top.root", "top.head").withColumnRenamed("root", "top_root")
        outside = known.join(top, "sig").where("root <> top_root")
        return self._most_shared(outside.select(F.col("node").alias("a"), F.col("head").alias("b")))

    def cross_pairs(self, roots: DataFrame) -> DataFrame:
        """a, b: candidates with different roots; roots: node, root.

        A set probes with all rows of ``members`` but, for each instance, the most frequent it can do without.
        """
        own = W.partitionBy("node", F.col("sig").bitwiseAND(4095)).orderBy(F.desc("n"), "sig")
        rooted = self.members.join(roots, "node").withColumn("probe", F.row_number().over(own) >= F.col("spare"))
        path = write_path(rooted.select("sig", "node", "root", "probe"), "jaccard-known")
        known = roots.sparkSession.read.schema("sig long, node long, root long, probe boolean").parquet(path)
        mixed = (
            known.groupBy("sig", "root").agg(F.count("*").alias("n"))
            .groupBy("sig").agg(F.max(F.struct("n", "root")).alias("top"), F.count("*").alias("n_roots"))
            .where("n_roots > 1").select("sig", F.col("top.root").alias("top"))
        )
        met = stored(known.join(mixed, "sig"), "jaccard-mixed")
        remove(roots.sparkSession, path)
        facts = self.nodes.select("node", "size", *SKETCH, "wide")
        named = lambda side: [F.col(c).alias(f"{c}_{side}") for c in ("size", *SKETCH, "wide", "root")]
        right = met.join(facts, "node").select("sig", F.col("node").alias("b"), *named("b"))
        left = met.where("probe AND root <> top").join(facts, "node").select("sig", F.col("node").alias("a"), *named("a"), "top")
        # two rows outside the largest component meet twice, once is enough
        once = (F.col("root_b") == F.col("top")) | (F.col("a") < F.col("b"))
        pairs = left.join(right, "sig").where(once & (F.col("root_a") != F.col("root_b")) & _near() & _near_wide())
        return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def roots(self) -> DataFrame:
        """node, root."""
        names = self.nodes.select("node")
        links = self.links(self.first_pairs())
        roots = stored(components(links, names), "jaccard-components")
        links = links.union(self.links(self.next_pairs(roots)))
        roots = stored(components(links, names), "jaccard-components")
        links = links.union(self.links(self.cross_pairs(roots)))
        return stored(components(links, names), "jaccard-components")


def similar_pairs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """a, b: every link between different sets, as the least ids of their rows, the least first. Null ids last."""
    join = Join(df, id_col, text_col)
    links = join.links(join.cross_pairs(join.nodes.select("node", F.col("node").alias("root"))))
    named = lambda side: join.nodes.select(F.col("node").alias(side), F.col("best.doc_id").alias(f"id_{side}"))
    both = links.join(named("a"), "a").join(named("b"), "b")
    either = F.col("id_a").isNull() | F.col("id_b").isNull()
    return both.select(
        F.when(either, F.coalesce("id_a", "id_b")).otherwise(F.least("id_a", "id_b")).alias("a"),
        F.when(~either, F.greatest("id_a", "id_b")).alias("b"))


def jaccard_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: doc_id, n_shingles, component_id (least doc_id reachable)."""
    join = Join(df, id_col, text_col)
    labelled = join.nodes.join(join.roots(), "node").select("node", "root", "best.doc_id")
    least = labelled.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    by_node = stored(labelled.join(least, "root").select("node", "component_id"), "jaccard-groups")
    rows = join.rows.select("doc_id", "node", F.col("size").alias("n_shingles"))
    full = rows.where("n_shingles > 0").join(by_node, "node").select("doc_id", "n_shingles", "component_id")
    return full.unionByName(rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents"))


# All pairs that share a shingle, then what is reachable from each document.
SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) BETWEEN 1 AND 4 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words)),
hashed AS (SELECT doc_id, hash(s) AS s FROM shingles),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM hashed a JOIN hashed b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)
"""
