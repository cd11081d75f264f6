"""SimHash near-duplicates: fingerprints, a binary-trie self-join, and components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import give_back, ids_and_text, join_copies, per_row, staged
from stationflow.llm.graph import connected_components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: A block of 64 bits for each of MAX_BITS + 1 tries: two fingerprints that differ in at
#: most MAX_BITS bits agree in a whole block, so some trie has both below one node.
BLOCK_ENDS = (13, 26, 39, 52, 64)
#: A trie node with more fingerprints than this is dealt out as pairs of its 8 grandchildren.
HOT_NODE = 100_000
LEAF = 24
#: Of the 128 bits of two check words, how many may differ in a link, and in fingerprints that are equal and stand for each other; rounds of the latter.
CHECK_BITS, COLLAPSE_BITS, ROUNDS = 40, 8, 16
PAIRS_AT_ONCE = 1 << 20


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of one text; 0 if it has no word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[: -shingle].tolist()]
    hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts, (ends[shingle - 1 :] - 1).tolist(), strict=True)], ">u8")
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        votes += np.unpackbits(hashes[at : at + 4096].view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp``: a signed long holding the SimHash bits of every whole text."""

    def run(ids: list, texts: list) -> tuple[list, ...]:
        got = np.array([fingerprint(t, shingle) for t in texts], np.uint64)
        return ids, got.view(np.int64)

    return per_row(ids_and_text(docs, id_col, text_col), run, "doc_id long, fp long", pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())]))


def _split(v: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int) -> np.ndarray:
    """Where the children of the trie nodes ``v[lo:hi]`` part, at bit ``depth`` from the top."""
    shift = np.uint64(63 - depth)
    middle = ((v[lo] >> shift) | np.uint64(1)) << shift
    return np.clip(np.searchsorted(v, middle), lo, hi)


def _settle(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the classes of the linked positions ``a, b``; labels stay each class's smallest position."""
    while True:
        x, y = label[a], label[b]
        if np.array_equal(x, y):
            return
        low = np.minimum(x, y)
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        while not np.array_equal(up := label[label], label):
            label[:] = up


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many bits of two rows of words differ."""
    return np.bitwise_count(x ^ y).sum(-1, dtype=np.int64)


def _leaves(v: np.ndarray, pairs: list[np.ndarray], label: np.ndarray, max_bits: int, check: np.ndarray | None) -> None:
    """Compare what lies below small node pairs, skipping pairs that are one class already."""
    lo1, hi1, lo2, hi2 = pairs
    turns = np.concatenate([[0], np.cumsum(label[1:] != label[:-1])])
    one = (turns[hi1 - 1] == turns[lo1]) & (turns[hi2 - 1] == turns[lo2]) & (label[lo1] == label[lo2])
    lo1, hi1, lo2, hi2 = (x[~one] for x in (lo1, hi1, lo2, hi2))
    width = hi2 - lo2
    count = (hi1 - lo1) * width
    if not len(count):
        return
    which = np.repeat(np.arange(len(count)), count)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    a, b = lo1[which] + nth // width[which], lo2[which] + nth % width[which]
    near = np.flatnonzero((a != b) & (np.bitwise_count(v[a] ^ v[b]) <= max_bits))
    if check is not None:
        near = near[_apart(check[a[near]], check[b[near]]) <= CHECK_BITS]
    _settle(label, a[near], b[near])


def collapsed(v: np.ndarray, check: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the sorted ``v`` that stand for others, and for each position which one stands for it.

    Without check words equal fingerprints are one; with them, only where these differ in COLLAPSE_BITS at most. What
    is left after ROUNDS rounds stands for itself.
    """
    stands, rest = np.arange(len(v)), np.arange(len(v))
    for _ in range(ROUNDS):
        head = np.flatnonzero(np.concatenate([[True], v[rest[1:]] != v[rest[:-1]]]))
        first = rest[np.repeat(head, np.diff(np.append(head, len(rest))))]
        one = np.ones(len(rest), bool) if check is None else _apart(check[rest], check[first]) <= COLLAPSE_BITS
        stands[rest[one]] = first[one]
        rest = rest[~one]
        if not len(rest):
            break
    return np.flatnonzero(stands == np.arange(len(v))), stands


def trie_links(v: np.ndarray, roots: list[tuple[int, int, int, int]], depth: int, max_bits: int = MAX_BITS, check: np.ndarray | None = None) -> np.ndarray:
    """The class of each of the sorted fingerprints ``v``, as its smallest position; with ``check`` words, only pairs near in these too are linked.

    ``roots`` are pairs of trie nodes at ``depth`` bits whose bits above agree. Node
    pairs go down together, carrying how many bits differ so far; a pair goes when
    that exceeds ``max_bits``. Small nodes are compared outright.
    """
    label = np.arange(len(v))
    stack = [(depth, *(np.array(x, np.int64) for x in zip(*roots, strict=True)), np.zeros(len(roots), np.int64))] if roots else []
    while stack:
        depth, lo1, hi1, lo2, hi2, differ = stack.pop()
        count = (hi1 - lo1) * (hi2 - lo2)
        if len(lo1) > 1 and count.sum() > PAIRS_AT_ONCE:  # the first half is done first
            half = len(lo1) // 2
            parts = (lo1, hi1, lo2, hi2, differ)
            stack += [(depth, *(x[half:] for x in parts)), (depth, *(x[:half] for x in parts))]
            continue
        small = (count <= LEAF * LEAF) | (depth >= 64)
        _leaves(v, [x[small] for x in (lo1, hi1, lo2, hi2)], label, max_bits, check)
        lo1, hi1, lo2, hi2, differ = (x[~small] for x in (lo1, hi1, lo2, hi2, differ))
        if not len(lo1):
            continue
        mid1, mid2, same = _split(v, lo1, hi1, depth), _split(v, lo2, hi2, depth), lo1 == lo2
        other = ~same  # of a node with itself, one of the two crossings is enough
        parts = [(lo1, mid1, lo2, mid2, differ), (mid1, hi1, mid2, hi2, differ), (lo1, mid1, mid2, hi2, differ + 1), (mid1[other], hi1[other], lo2[other], mid2[other], differ[other] + 1)]
        lo1, hi1, lo2, hi2, differ = (np.concatenate(x) for x in zip(*parts, strict=True))
        keep = (lo1 < hi1) & (lo2 < hi2) & (differ <= max_bits)
        if keep.any():
            stack.append((depth + 1, *(x[keep] for x in (lo1, hi1, lo2, hi2, differ))))
    return label


def near_links(fps: DataFrame, max_bits: int = MAX_BITS, hot_node: int = HOT_NODE) -> DataFrame:
    """``src, dst``: links between the nodes of ``fps`` (``node, fp``, and ``word`` if there are several) that join all whose fingerprints are near.

    A fingerprint enters one trie for each block, turned so that the block comes
    first, and only pairs that agree in that block are followed there: within ``max_bits``
    of 4 or fewer these are all near pairs, of a larger budget those that some whole block
    leaves alone. What leaves a task is a forest of its classes, never all pairs. A block value
    with more than ``hot_node`` fingerprints is dealt out as pairs of subtrees three bits below.
    Fingerprints of different ``word`` never meet. With columns ``c1, c2`` (two more words of the same texts)
    a pair is linked only if at most CHECK_BITS of these 128 bits differ too, so that fingerprints that are near by chance aren't.
    """
    checks = [c for c in ("c1", "c2") if c in fps.columns]
    starts = (0, *BLOCK_ENDS[:-1])
    word = F.col("word") if "word" in fps.columns else F.lit(0)
    turned = [F.struct((word * len(starts) + k).cast("int").alias("trie"), (F.shiftleft("fp", s).bitwiseOR(F.shiftrightunsigned("fp", 64 - s)) if s else F.col("fp")).alias("key")) for k, s in enumerate(starts)]
    width = F.when(F.col("trie") % len(starts) == len(starts) - 1, BLOCK_ENDS[-1] - BLOCK_ENDS[-2]).otherwise(BLOCK_ENDS[0])
    rows = fps.select("node", *checks, F.explode(F.array(*turned)).alias("t")).select("node", *checks, "t.*").withColumn("block", F.expr("shiftrightunsigned(key, 51)"))
    rows = rows.withColumn("block", F.when(width == 12, F.col("block").bitwiseAND(F.lit(~1))).otherwise(F.col("block")))
    sizes = rows.groupBy("trie", "block").agg(F.count("*").alias("n"))  # 5 * 8192 rows for each word at most
    below = F.when(width == 12, F.shiftrightunsigned("key", 49)).otherwise(F.shiftrightunsigned("key", 48))  # right under the block
    child = below.bitwiseAND(F.lit(7))
    low, high = F.least(F.col("o"), F.col("child")), F.greatest(F.col("o"), F.col("child"))
    rows = (
        rows.join(F.broadcast(sizes.where(F.col("n") > hot_node)), ["trie", "block"], "left")
        .withColumn("child", child)
        .withColumn("o", F.explode(F.when(F.col("n").isNull(), F.array(F.lit(-1).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), F.lit(7).cast("long")))))
        .select("trie", "block", F.when(F.col("o") < 0, F.lit(-1)).otherwise(low * 8 + high).cast("int").alias("part"), "key", "node", *checks)
        .repartition("trie", "block", "part")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(batches)
        if not whole.num_rows:
            return
        trie, part, key, node = (whole.column(c).to_numpy() for c in ("trie", "part", "key", "node"))
        order = np.lexsort((node, key.view(np.uint64), part, trie))
        trie, part, key, node = trie[order], part[order], key[order].view(np.uint64), node[order]
        words = np.stack([whole.column(c).to_numpy()[order].view(np.uint64) for c in checks], 1) if checks else None
        cuts = np.flatnonzero(np.concatenate([[True], (trie[1:] != trie[:-1]) | (part[1:] != part[:-1])]))
        for x, y in zip(cuts, np.append(cuts[1:], len(trie)), strict=True):
            k, q = int(trie[x]) % len(starts), int(part[x])
            v, own = key[x:y], node[x:y]
            head, stands = collapsed(v, None if words is None else words[x:y])
            v, check = v[head], None if words is None else words[x:y][head]
            deep = BLOCK_ENDS[k] - starts[k]
            top = v >> np.uint64(64 - deep)
            lo = np.flatnonzero(np.concatenate([[True], top[1:] != top[:-1]]))
            hi = np.append(lo[1:], len(v))
            if q < 0 or q // 8 == q % 8:
                roots = list(zip(lo, hi, lo, hi, strict=True))
            else:  # two subtrees of a hot node, against each other
                second = np.array([l + np.searchsorted((v[l:h] >> np.uint64(61 - deep)) & np.uint64(7), q % 8) for l, h in zip(lo, hi, strict=True)])
                roots = [(l, m, m, h) for l, m, h in zip(lo, second, hi, strict=True) if l < m < h]
            label = trie_links(v, [r for r in roots if r[3] - r[0] > 1], deep, max_bits, check)
            found = label[np.searchsorted(head, stands)]
            least = np.full(len(v), np.iinfo(np.int64).max)
            np.minimum.at(least, found, own)  # a class's links go to its smallest node, so that tries that find the same class give the same links
            moved = own != least[found]
            yield _links(own[moved], least[found[moved]])
        del whole, trie, part, key, node, words
        give_back()

    return rows.select("trie", "part", "key", "node", *checks).mapInArrow(run, "src long, dst long")


def _links(src: np.ndarray, dst: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], ["src", "dst"])


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, fingerprint, component_id, n_links`` for every row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over fingerprints that differ in
    at most ``max_bits`` bits; ``n_links`` is how many distinct other fingerprints
    the component has. Null and empty texts have fingerprint zero and are linked
    like any other; repeated rows stay, one result row each; rows without an id
    get their component's smallest id (null if it has none); other columns are
    left out; an empty table gives an empty result.
    """
    if max_bits >= len(BLOCK_ENDS):
        raise ValueError(f"at most {len(BLOCK_ENDS) - 1} differing bits can be found without loss")
    marks = staged(fingerprints(docs, id_col, text_col, shingle))
    fps = marks.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"))
    roots = staged(connected_components(near_links(fps.select("fp", F.col("fp").alias("node")), max_bits)))
    least = fps.join(roots, fps["fp"] == roots["node"]).groupBy("root").agg(F.min("first_id").alias("component_id"), F.count("*").alias("n"))
    linked = roots.join(least, "root").select(F.col("node").alias("fp"), "component_id", "n")
    classes = staged(fps.join(linked, "fp", "left").select("fp", "copies", F.coalesce("component_id", "first_id").alias("component_id"), F.coalesce(F.col("n") - 1, F.lit(0)).alias("n_links")))
    found = join_copies(marks, classes, "fp", marks.count())
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "n_links")
