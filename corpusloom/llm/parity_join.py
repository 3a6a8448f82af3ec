"""N-gram Jaccard join by parity sketches.

A document is the set of its distinct word shingles. XOR-ing the hashes of a set's elements bit by
bit gives a parity sketch; the XOR of two sketches is the sketch of the symmetric difference, so
two sketches never differ more than the sets do. Here the elements are dealt over ``k`` blocks by
hash, each block keeps one 64-bit parity word, and a differing element can spoil one block only.

Two sets with Jaccard >= t, of sizes a <= b, differ in at most (1-t)/(1+t) * (a+b) elements, hence in
at most that many blocks (pigeonhole). ``k`` is fixed per size band [2^i, 2^(i+1)); a set close to the
upper bound is entered in the next band too, so that any two sets that may link share a band. All
blocks are put in one global order and each set enters only its first d+1, where d bounds the
differences it may have; two linked sets then share an entered block (prefix principle). The
order (blocks found to be frequent last, then blocks of more elements first) only decides how much
work there is; the result is exact for any order. Empty blocks come last of all: they are blocks on which
two sets may agree, so a set with fewer than d+1 others enters them too. As that happens often to
small sets only, each shingle of those is a block of its own, which leaves no block empty: two linked sets
share a shingle, and each has at most d that the other lacks.

Of blocks that the same sets enter one is kept. Groups of equal blocks are never expanded to all pairs. Each set is first compared with the one that
leads most of its blocks, and the links found are contracted to components. Then, in rounds, one set of each
component meets one of its block's main component, until no round finds a link. Only what is still apart
after that is compared pair by pair, after a Hamming test on a 256-bit sketch and, for large sets, one that grows with them; a pair is passed over
where it is seen to share an earlier block.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.bloom import build_bloom, in_bloom
from corpusloom.llm.byte_words import WordHasher, distinct_per_text, mix, signed, text_buffer, text_groups, word_grams
from corpusloom.llm.components import connected_components
from corpusloom.session import BROADCAST_ROWS, materialize, small_enough

SHINGLE_WORDS = 5
SIMILARITY = Fraction(4, 5)
# Bits of the sketch that candidate pairs are tested with.
SKETCH_WORDS = 4
# Sets of this size band and beyond have a wider sketch too, of two bits for each element of the band's smallest set up
# to so many words, because the short one says little about them. Pairs of large sets are tested with both.
WIDE_BAND, WIDE_WORDS = 8, 64
# Up to this size band (31 shingles) every shingle is a block.
PLAIN_BAND = 4
# Blocks listed as frequent; the list only orders blocks.
FREQUENT_LIST = 1 << 17
# Earlier blocks of a set that are known where pairs are listed, so that a pair is not listed for each block it shares.
EARLIER = 8
# A block is reported as frequent by a task if this many different sets of one Arrow batch have it.
FREQUENT_IN_BATCH = 8


def _sets(column: pa.Array, words: int, seed: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, shingles, their row from there) for pieces of a batch."""
    hasher = WordHasher(seed)
    at, raw = text_buffer(column)
    for a, b in text_groups(at):
        h, _, _, text = hasher.words(at[a:b + 1], raw)
        grams, first = word_grams(h, text, words)
        yield (a, b - a, *distinct_per_text(grams, text[first]))


def _sums(values: np.ndarray, rows: np.ndarray, n: int, op=np.add) -> np.ndarray:
    out = np.zeros(n, np.uint64)
    if len(values):
        heads = np.flatnonzero(np.diff(rows, prepend=-1))
        out[rows[heads]] = op.reduceat(values, heads)
    return out


def _names(shingles: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit name of each set."""
    with np.errstate(over="ignore"):
        return mix(_sums(mix(shingles, 11), rows, n) + np.bincount(rows, minlength=n).astype(np.uint64))


def wide_sketches(shingles: np.ndarray, rows: np.ndarray, n: int) -> list:
    """Parity sketch words of each large set, None for others. Half a sketch of twice the length, folded by XOR, is the shorter one."""
    sizes = np.bincount(rows, minlength=n)
    band = np.floor(np.log2(np.maximum(sizes, 1))).astype(np.int64)
    large = band >= WIDE_BAND
    if not large.any():
        return [None] * n
    length = np.where(large, np.minimum(1 << np.maximum(band - 5, 0), WIDE_WORDS), 0)
    base = np.concatenate([[0], np.cumsum(length)]) * 64
    mine = large[rows]
    bit = mix(shingles[mine], 14) & (length[rows[mine]] * 64 - 1).astype(np.uint64)
    odd = np.bincount(base[rows[mine]] + bit.astype(np.int64), minlength=base[-1]) & 1
    packed = np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)
    return [packed[a // 64:b // 64] if b > a else None for a, b in zip(base[:-1], base[1:])]


def _frequent_keys(fresh: list, similarity: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """Blocks that many of a batch's different sets have, and how many."""
    keys = [block_keys(shingles, rows, n, up, similarity)[0] for shingles, rows, n in fresh for up in (False, True)]
    key, count = np.unique(np.concatenate(keys), return_counts=True) if keys else (np.zeros(0, np.int64),) * 2
    often = count >= FREQUENT_IN_BATCH
    return key[often], count[often].astype(np.int64)


def _describe(words: int, seed: int, similarity: Fraction):
    """Facts of each row's set; the first row of a batch also lists the batch's frequent blocks."""

    def run(batches):
        for batch in batches:
            n_rows = batch.num_rows
            fresh, seen = [], np.zeros(0, np.uint64)
            names, checks = np.zeros(n_rows, np.uint64), np.zeros(n_rows, np.uint64)
            sizes, sketch = np.zeros(n_rows, np.int64), np.zeros((SKETCH_WORDS, n_rows), np.uint64)
            wide = []
            for a, n, shingles, rows in _sets(batch.column("text"), words, seed):
                sizes[a:a + n] = np.bincount(rows, minlength=n)
                names[a:a + n] = _names(shingles, rows, n)
                checks[a:a + n] = _sums(mix(shingles, 12), rows, n, np.bitwise_xor)
                wide += wide_sketches(shingles, rows, n)
                once, seen = _fresh(names[a:a + n], seen)
                fresh.append((shingles[once[rows]], rows[once[rows]], n))
                bit = mix(shingles, 13)
                for w in range(SKETCH_WORDS):
                    mine = (bit >> np.uint64(6)) % np.uint64(SKETCH_WORDS) == w
                    sketch[w, a:a + n] = _sums(np.where(mine, np.uint64(1) << (bit & np.uint64(63)), np.uint64(0)), rows, n, np.bitwise_xor)
            often = [pa.array([x, *[None] * (n_rows - 1)][:n_rows], pa.list_(pa.int64())) for x in _frequent_keys(fresh, similarity)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_a"), batch.column("text_b"), *(pa.array(signed(x)) for x in (names, checks)),
                 pa.array(sizes), *(pa.array(signed(x)) for x in sketch), pa.array(wide, pa.list_(pa.int64())), *often],
                ["doc_id", "text_a", "text_b", "node", "check", "n", *(f"s{w}" for w in range(SKETCH_WORDS)), "wide", "often", "often_sets"],
            )

    return run


def band_blocks(band: np.ndarray) -> np.ndarray:
    """Blocks of each size band: 3/4 of the band's smallest size."""
    return np.maximum(1, -(-3 * (1 << band) // 4))


def entered_blocks(n: np.ndarray, similarity: Fraction) -> np.ndarray:
    """d + 1, where a set of size n and any set linked with it differ in at most d elements.

    The other set has at most n/t elements, so d <= (1-t)/(1+t) * (n + n/t) = n * (1-t)/t.
    """
    gap = (1 - similarity) / similarity
    return n * gap.numerator // gap.denominator + 1


def block_keys(shingles: np.ndarray, rows: np.ndarray, n: int, up: bool, similarity: Fraction):
    """(key, elements, row) of blocks, in each set's own band or in the next one up.

    These are all blocks that have elements, and for a set that has fewer of them than it enters,
    as many empty ones (0 elements) as it lacks, in order of the key.
    """
    sizes = np.bincount(rows, minlength=n)
    band = np.floor(np.log2(np.maximum(sizes, 1))).astype(np.int64)
    allowed = entered_blocks(sizes, similarity)
    there = sizes > 0
    if up:  # only sets that may link with one of the next band
        there &= sizes * similarity.denominator >= similarity.numerator * (1 << (band + 1))
        mine = there[rows]
        shingles, rows, band = shingles[mine], rows[mine], band + 1
    plain = band <= PLAIN_BAND
    blocks = np.where(plain, sizes, band_blocks(band))
    base = np.concatenate([[0], np.cumsum(blocks)])
    heads = np.searchsorted(rows, np.arange(n))
    block = np.where(
        plain[rows], np.arange(len(rows)) - heads[rows],
        (mix(shingles, 21) % np.maximum(1, blocks[rows]).astype(np.uint64)).astype(np.int64),
    )
    place = base[rows] + block
    order = np.argsort(place, kind="stable")
    place, values = place[order], mix(shingles, 22)[order]
    heads = np.flatnonzero(np.diff(place, prepend=-1))
    if not len(heads):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    parity = np.bitwise_xor.reduceat(values, heads)
    count = np.diff(np.append(heads, len(values)))
    row = np.searchsorted(base, place[heads], "right") - 1
    block = np.where(plain[row], 0, place[heads] - base[row])
    key = _block_key(band[row], block, parity, count)
    lacks = allowed - np.bincount(row, minlength=n)
    own = row
    for i in np.flatnonzero(there & ~plain & (lacks > 0)):
        empty = np.setdiff1d(np.arange(blocks[i]), block[own == i])
        more = np.sort(_block_key(np.full(len(empty), band[i]), empty, np.zeros(len(empty), np.uint64), np.zeros(len(empty), np.int64)))[:lacks[i]]
        key, count, row = np.append(key, more), np.append(count, np.zeros(len(more), np.int64)), np.append(row, np.full(len(more), i))
    return key, count, row


def _block_key(band: np.ndarray, block: np.ndarray, parity: np.ndarray, count: np.ndarray) -> np.ndarray:
    where = (band * (1 << 40) + block).astype(np.uint64)
    with np.errstate(over="ignore"):
        key = mix(parity ^ mix(where, 23)) + count.astype(np.uint64)
    return signed(mix(key))


def _fresh(names: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which names are met for the first time, and all that were met."""
    keep = np.zeros(len(names), bool)
    keep[np.unique(names, return_index=True)[1]] = True
    keep &= ~np.isin(names, seen)
    return keep, np.concatenate([seen, names[keep]])


def _distinct_sets(column, words, seed):
    """As ``_sets``, with each set of the batch once and its name."""
    seen = np.zeros(0, np.uint64)
    for _, n, shingles, rows in _sets(column, words, seed):
        names = _names(shingles, rows, n)
        fresh, seen = _fresh(names, seen)
        mine = fresh[rows]
        yield shingles[mine], rows[mine], n, names


def _entries(words: int, seed: int, similarity: Fraction, frequent):
    """(node, keys): the blocks that each set enters, in lists by the pieces that a batch is hashed in."""

    def run(batches):
        late = frequent.value
        for batch in batches:
            node_parts, size_parts, key_parts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for shingles, rows, n, names in _distinct_sets(batch.column("text"), words, seed):
                allowed = entered_blocks(np.bincount(rows, minlength=n), similarity)
                for up in (False, True):
                    key, count, row = block_keys(shingles, rows, n, up, similarity)
                    if not len(key):
                        continue
                    last = late[np.minimum(np.searchsorted(late, key), len(late) - 1)] == key if len(late) else np.zeros(len(key), bool)
                    order = np.lexsort((key, -count, last & (count > 0), count == 0, row))
                    key, row = key[order], row[order]
                    heads = np.flatnonzero(np.diff(row, prepend=-1))
                    place = np.arange(len(row)) - np.repeat(heads, np.diff(np.append(heads, len(row))))
                    keep = place < allowed[row]
                    entered = np.bincount(row[keep], minlength=n)
                    key_parts.append(key[keep])
                    node_parts.append(signed(names)[entered > 0])
                    size_parts.append(entered[entered > 0])
            ends = np.cumsum(np.concatenate([[0], *size_parts]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(node_parts)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(key_parts)))],
                ["node", "keys"],
            )

    return run


def _entries_in(only):
    """(key, node) of the entries that the filter may contain."""

    def run(batches):
        for batch in batches:
            keys = batch.column("keys")
            flat = keys.flatten().to_numpy(zero_copy_only=False)
            node = np.repeat(batch.column("node").to_numpy(zero_copy_only=False), np.diff(keys.offsets.to_numpy()))
            keep = in_bloom(only.value, flat)
            yield pa.RecordBatch.from_arrays([pa.array(flat[keep]), pa.array(node[keep])], ["key", "node"])

    return run


def _rows_in(wanted, column: str):
    """The rows whose ``column`` the filter may contain."""

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(in_bloom(wanted.value, batch.column(column).to_numpy(zero_copy_only=False))))

    return run


def _verified(words: int, seed: int, similarity: Fraction):
    """(a, b) of the pairs of texts whose sets really are that similar."""

    def run(batches):
        for batch in batches:
            left = [s for s in _one_by_one(batch.column("a_text"), words, seed)]
            right = [s for s in _one_by_one(batch.column("b_text"), words, seed)]
            linked = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(left, right)):
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked[i] = both * similarity.denominator >= similarity.numerator * (len(x) + len(y) - both)
            yield batch.select(["a", "b"]).filter(pa.array(linked))

    return run


def _one_by_one(column, words, seed):
    for _, n, shingles, rows in _sets(column, words, seed):
        edges = np.searchsorted(rows, np.arange(n + 1))
        for i in range(n):
            yield shingles[edges[i]:edges[i + 1]]


def _pairs_checked(pairs: DataFrame, texts: DataFrame, words: int, seed: int, similarity: Fraction) -> DataFrame:
    """Those of ``pairs`` (a, b), a written table, that are similar."""
    # Few pairs need few texts; then the others stay where they are.
    named = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    n_named = named.count()
    if n_named <= BROADCAST_ROWS:
        texts = texts.join(small_enough(named, n_named), "node", "left_semi")
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("a_text"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("b_text"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "a_text", "b_text").mapInArrow(
        _verified(words, seed, similarity), "a bigint, b bigint",
    )


def _different_blocks(members: DataFrame) -> DataFrame:
    """``members`` (key, node) of one block of those that the same sets enter: (key, node, lead, blocks).

    ``lead`` is the block's smallest set, ``blocks`` the number of blocks it stands for. Such blocks have the same pairs.
    A set has the same number of rows in each of its blocks, so repeats do not matter.
    """
    def added(mark: int) -> Column:
        # As a sum of halves, which cannot overflow.
        h = F.xxhash64("node", F.lit(mark))
        return F.struct(F.sum(F.shiftrightunsigned(h, 32)), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))))

    held = members.groupBy("key").agg(F.min("node").alias("lead"), F.max("node").alias("_last"), F.count("*").alias("_rows"), added(1).alias("_one"), added(2).alias("_two"))
    one = (
        held.filter("lead <> _last").groupBy("lead", "_last", "_rows", "_one", "_two").agg(F.min("key").alias("key"), F.count("*").alias("blocks"))
        .select("key", "lead", "blocks")
    )
    # Written before repeats go, which would otherwise tie the join's tasks to whole blocks.
    return materialize(members.join(small_enough(materialize(one, "blocks")), "key"), "kept").distinct()


def _open_blocks(placed: DataFrame) -> DataFrame:
    """Rows (key, node, comp, ...) of blocks whose sets are in several components, with the largest as ``main``."""
    per_comp = placed.groupBy("key", "comp").agg(F.count("*").alias("_rows"))
    main = per_comp.groupBy("key").agg(F.max(F.struct("_rows", "comp")).alias("_main"), F.count("*").alias("_comps"))
    main = materialize(main.filter("_comps > 1").select("key", F.col("_main.comp").alias("main")), "split-blocks")
    return placed.join(small_enough(main), "key")


def _merged(placed: DataFrame, links: DataFrame) -> DataFrame:
    """``placed`` with components joined by further links between their sets."""
    at = placed.select("node", "comp").distinct()
    edges = (
        links.join(at.select(F.col("node").alias("a"), F.col("comp").alias("_x")), "a")
        .join(at.select(F.col("node").alias("b"), F.col("comp").alias("_y")), "b")
        .select(F.col("_x").alias("a"), F.col("_y").alias("b"))
    )
    # Few components merge; the rows of the blocks then stay where they are.
    new = small_enough(connected_components(edges).select(F.col("node").alias("comp"), F.col("comp").alias("_new")))
    return placed.join(new, "comp", "left").withColumn("comp", F.coalesce("_new", "comp")).drop("_new")


def _wide_differ(x: Column, y: Column) -> Column:
    """Differing bits of two wide sketches; the longer one is folded to the length of the other."""
    def fitted(a: Column, b: Column) -> Column:
        half = (F.size(a) / 2).cast("int")
        folded = F.zip_with(F.slice(a, 1, half), F.slice(a, half + 1, half), lambda u, v: u.bitwiseXOR(v))
        return F.when(F.size(a) > F.size(b), folded).otherwise(a)

    bits = F.zip_with(fitted(x, y), fitted(y, x), lambda u, v: F.bit_count(u.bitwiseXOR(v)))
    return F.aggregate(bits, F.lit(0), lambda total, one: total + one)


def _with_earlier(placed: DataFrame) -> DataFrame:
    """``placed`` with ``earlier``: the last few of a set's blocks before this one, smaller blocks first."""
    sizes = small_enough(materialize(placed.groupBy("key").agg(F.count("*").alias("_held")), "sizes"))
    order = Window.partitionBy("node").orderBy("_held", "key")
    ahead = F.collect_list("key").over(order.rowsBetween(-EARLIER, -1))
    return placed.join(sizes, "key").withColumn("earlier", ahead).drop("_held")


def _near_pairs(left: DataFrame, right: DataFrame, similarity: Fraction) -> DataFrame:
    """(a, b) of the sets of two tables (key, comp, node, n, sketch) that share a block, are in different components and may link.

    A pair is listed for each block that it shares.

    With ``earlier``, the tables are all rows of some blocks and, on the left, those outside the block's ``main`` component. A pair then
    is listed once a block, and not where it is known to share an earlier one: in the first block of all it is listed.
    """
    columns = ["comp", "node", "n", *(f"s{w}" for w in range(SKETCH_WORDS)), *(c for c in ("wide", "main", "earlier") if c in left.columns)]
    x = left.select("key", *[F.col(c).alias(f"x_{c}") for c in columns])
    y = right.select("key", *[F.col(c).alias(f"y_{c}") for c in columns])
    num, den = similarity.numerator, similarity.denominator
    differ = sum((F.bit_count(F.col(f"x_s{w}").bitwiseXOR(F.col(f"y_s{w}"))) for w in range(1, SKETCH_WORDS)),
                 F.bit_count(F.col("x_s0").bitwiseXOR(F.col("y_s0"))))
    # Sketches differ in no more bits than the sets in elements.
    near = differ * (den + num) <= (F.col("x_n") + F.col("y_n")) * (den - num)
    if "wide" in left.columns:
        wide = _wide_differ(F.col("x_wide"), F.col("y_wide")) * (den + num) <= (F.col("x_n") + F.col("y_n")) * (den - num)
        known = F.col("x_wide").isNotNull() & F.col("y_wide").isNotNull()
        near = F.when(near & known, wide).otherwise(near)
    if "earlier" in left.columns:
        once = (F.col("y_comp") == F.col("y_main")) | (F.col("x_node") < F.col("y_node"))
        near = once & near & ~F.arrays_overlap("x_earlier", "y_earlier")
    return (
        x.join(y, "key")
        .filter((F.col("x_comp") != F.col("y_comp")) & (F.col("x_n") * den >= F.col("y_n") * num) & (F.col("y_n") * den >= F.col("x_n") * num))
        .filter(near)
        .select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b"))
    )


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
                       similarity: Fraction = SIMILARITY) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    Words are runs of characters other than ``[\\x20\\x09-\\x0D]`` with A-Z lower-cased. A set holds the
    distinct ``words``-word shingles, or the whole sequence where there are fewer words. Sets link when
    their Jaccard similarity is at least ``similarity``; component_id is the smallest id reachable.

    - NULL, empty and blank texts have n_shingles 0 and are linked with nothing: component_id is their own id.
    - Equal sets (exact copies, repeated rows) are one node and never compared.
    - Rows with a NULL id take part; they get the smallest id that is not NULL in their component, or NULL.
    - An empty table gives no rows. Other columns, whatever their names, are not read.
    - Shingles are compared as 64-bit hashes. Sets are named by 64 bits; should two different sets ever get
      one name, which a second hash shows, all is done again with other hashes.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    # Two hashes of a text, by which it is found again without reading its words.
    marked = slim.withColumns({"text_a": F.xxhash64("text"), "text_b": F.xxhash64(F.lit(1), "text")})
    sketch = [f"s{w}" for w in range(SKETCH_WORDS)]
    seed = 0
    while True:
        described = materialize(
            marked.mapInArrow(
                _describe(words, seed, similarity),
                ", ".join(f"{c} bigint" for c in ("doc_id", "text_a", "text_b", "node", "check", "n", *sketch))
                + ", wide array<bigint>, often array<bigint>, often_sets array<bigint>",
            ),
            "sets",
        )
        nodes = described.filter("n > 0").groupBy("node").agg(
            F.min("doc_id").alias("first_id"), F.min("check").alias("_low"), F.max("check").alias("_high"), F.max("n").alias("n"),
            F.min(F.struct("text_a", "text_b")).alias("_text"), *[F.max(c).alias(c) for c in sketch],
        )
        nodes = materialize(nodes, "nodes")
        if not nodes.filter("_low <> _high").take(1):
            break
        seed += 1

    frequent = (
        described.filter("often IS NOT NULL").select(F.inline(F.arrays_zip("often", "often_sets")))
        .groupBy(F.col("often").alias("key")).agg(F.sum("often_sets").alias("sets")).orderBy(F.desc("sets"), "key").limit(FREQUENT_LIST)
        .select("key").toArrow()["key"].to_numpy()
    )
    frequent = spark.sparkContext.broadcast(np.sort(frequent))

    # Who enters which blocks, then blocks that at least two sets enter.
    entered = materialize(slim.mapInArrow(_entries(words, seed, similarity, frequent), "node bigint, keys array<bigint>"), "entries")
    shared = materialize(
        entered.select("node", F.explode("keys").alias("key")).groupBy("key").agg(F.min("node").alias("lead"), F.max("node").alias("_last"))
        .filter("lead <> _last").select("key"), "shared",
    )
    only = spark.sparkContext.broadcast(build_bloom(shared, "key"))
    met = materialize(entered.mapInArrow(_entries_in(only), "key bigint, node bigint"), "met")
    members = materialize(_different_blocks(met), "members")

    # One text of each of their sets.
    chosen = nodes.join(members.select("node").distinct(), "node", "left_semi").select("node", "_text.*")
    chosen = materialize(chosen, "chosen")
    wanted = spark.sparkContext.broadcast(build_bloom(chosen, "text_a"))
    texts = materialize(
        marked.select("text_a", "text_b", "text").mapInArrow(_rows_in(wanted, "text_a"), "text_a bigint, text_b bigint, text string")
        .dropDuplicates(["text_a", "text_b"]).join(chosen, ["text_a", "text_b"]).select("node", "text"), "texts",
    )

    # Each set against the one that leads most of its blocks.
    star = (
        members.filter("node <> lead").groupBy("node", "lead").agg(F.sum("blocks").alias("_blocks"))
        .groupBy("node").agg(F.max(F.struct("_blocks", (-F.col("lead")).alias("_minus"))).alias("_best"))
        .select(F.col("node").alias("a"), (-F.col("_best._minus")).alias("b"))
    )
    links = materialize(_pairs_checked(materialize(star, "star"), texts, words, seed, similarity), "links")
    facts = nodes.select("node", "n", *sketch)
    placed = members.select("key", "node").join(connected_components(links), "node", "left").select(
        "key", "node", F.coalesce("comp", "node").alias("comp"))
    open_rows = materialize(_open_blocks(placed).join(facts, "node"), "open")
    tried = None
    while open_rows.take(1):
        # One pair for each block and component: its smallest set against that of the block's main component.
        first = open_rows.groupBy("key", "comp", "main").agg(F.min(F.struct("node", "n", *sketch)).alias("_set"))
        pairs = _near_pairs(
            first.filter("comp <> main").select("key", "comp", "_set.*"), first.filter("comp = main").select("key", "comp", "_set.*"), similarity,
        ).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        tried = pairs if tried is None else tried.union(pairs)
        found = materialize(_pairs_checked(pairs, texts, words, seed, similarity), "found")
        if not found.take(1):
            break
        links = links.union(found)
        open_rows = materialize(_open_blocks(_merged(open_rows.drop("main"), found)), "open")
    # Then all pairs that share a block and are still apart. The main component of a block meets only the others.
    if open_rows.take(1):
        wide = described.filter("wide IS NOT NULL").select("node", "wide").join(open_rows.select("node").distinct(), "node", "left_semi")
        sketched = materialize(_with_earlier(open_rows).join(wide.dropDuplicates(["node"]), "node", "left"), "sketched")
        apart = _near_pairs(sketched.filter("comp <> main"), sketched, similarity).distinct()
        if tried is not None:
            apart = apart.join(tried, ["a", "b"], "left_anti")
        links = links.union(materialize(_pairs_checked(materialize(apart, "apart"), texts, words, seed, similarity), "more-links"))
    comps = connected_components(links)

    # Smallest id of each component, counted over all rows.
    placed_nodes = nodes.select("node", "first_id").join(comps, "node", "left").select(
        "node", "first_id", F.coalesce("comp", "node").alias("comp"))
    least = placed_nodes.groupBy("comp").agg(F.min("first_id").alias("component_id"))
    ids = placed_nodes.join(least, "comp").select("node", "component_id")
    filled = described.filter("n > 0").select("doc_id", "n", "node").join(ids, "node")
    return filled.select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(
        described.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")),
    )
